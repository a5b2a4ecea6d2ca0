"""Reading sources, reading and writing target tables, sheets and scopes."""
