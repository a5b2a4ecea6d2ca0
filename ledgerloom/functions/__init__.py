"""Column expressions. Every function takes and returns ``Column`` and stays JVM-side."""
