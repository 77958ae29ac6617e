"""Point-in-time market data on Spark: store, scan, clean, resample, align and check."""
