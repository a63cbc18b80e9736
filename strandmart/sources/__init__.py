"""Readers, inventories, report parsers and table writers."""
