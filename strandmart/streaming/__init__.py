"""Incremental append of the event log."""
