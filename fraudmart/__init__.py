"""fraudmart: a Spark-native daily fraud-mart engine."""

__version__ = "0.1.0"
