"""Silver specifications, upsert keys, staging and report models, and their order."""
