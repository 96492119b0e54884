"""siltstone: a medallion analytics toolkit for messy reference data on PySpark."""

__version__ = "0.1.0"
