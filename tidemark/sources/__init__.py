"""Sources and sinks: raw klines, candles, ticks, feature tables, manifests, configuration."""
