"""Clinical analytics on Spark: bronze -> silver -> gold, quality gate, reports."""
__version__ = "0.1.0"
