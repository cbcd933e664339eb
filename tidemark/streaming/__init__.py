"""Candles, latency and recursive filters over streams."""
