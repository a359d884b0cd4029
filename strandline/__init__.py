"""strandline: a Spark-native engine for a versioned, partitioned Parquet archive."""

__version__ = "0.1.0"
