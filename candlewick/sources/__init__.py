"""Landed inputs: API payloads, archives, symbol catalogs, live candles."""
