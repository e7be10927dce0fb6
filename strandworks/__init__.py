"""strandworks: a PySpark-native engine for preparing, auditing, searching and scoring structured knowledge data."""

__version__ = "0.1.0"
