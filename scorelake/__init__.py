"""scorelake: Spark-native feature, evaluation and drift analytics for scoring models."""

__version__ = "0.1.0"
