"""Candlestick history on Spark: one table of candles for every exchange,
symbol and interval, with jobs that load, check, repair and read it."""

from candlewick.history import CandleHistory

__all__ = ["CandleHistory"]
