"""PySpark-native document-to-vector search, table sync and event matching."""

__version__ = "0.1.0"
