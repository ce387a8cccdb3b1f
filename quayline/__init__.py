"""Spark-native analytics over news text and OHLCV bars."""
