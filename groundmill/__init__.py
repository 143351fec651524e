"""Spark-native engine that turns document collections into verified question/answer datasets."""

__version__ = "0.1.0"
