"""strataloom: a PySpark-native engine for token-level authorship datasets."""

__version__ = "0.1.0"
