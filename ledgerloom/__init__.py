"""Record consolidation on Spark: scope, roll up, clean, merge, re-key, reshape, load, reconcile."""
