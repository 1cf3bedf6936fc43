"""Files, tables and staged intermediate tables."""
