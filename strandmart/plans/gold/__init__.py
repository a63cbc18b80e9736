"""Report models: each ``run(tables, …) -> DataFrame``."""
