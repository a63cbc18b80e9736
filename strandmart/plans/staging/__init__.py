"""Staging models: each ``run(tables) -> DataFrame``."""
