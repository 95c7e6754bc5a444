"""revlens: a PySpark-native engine for review analytics and corpus preparation."""

__version__ = "0.1.0"
