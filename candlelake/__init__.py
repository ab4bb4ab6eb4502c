"""Spark-native engine for market-candle lakes: Raw, Bronze, Silver, Gold and serving layers."""
