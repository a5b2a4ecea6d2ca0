"""The given test tables in the shape of the source tables, and one checked query per operator."""
