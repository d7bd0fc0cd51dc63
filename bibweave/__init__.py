"""bibweave: a PySpark-native engine for screening streams of bibliographic records."""

__version__ = "0.1.0"
