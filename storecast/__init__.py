"""Spark-native retail sales analytics and store forecasting."""

__version__ = "0.1.0"
