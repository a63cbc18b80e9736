"""Pure Column -> Column functions (scalar helpers and classification rules)."""
