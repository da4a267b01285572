"""DataFrame to DataFrame jobs over candles."""
