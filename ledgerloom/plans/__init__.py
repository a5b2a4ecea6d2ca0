"""Pipelines (PIP1-PIP30): compositions of operators, one function per target table."""
