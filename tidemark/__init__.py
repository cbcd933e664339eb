"""Spark-native candle, feature and corpus analytics."""
