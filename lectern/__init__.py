"""lectern: content-operations analytics as PySpark DataFrame and stream operators."""

__version__ = "0.1.0"
