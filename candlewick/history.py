"""The candle history as one object: a store and the jobs on it."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from candlewick import store
from candlewick.dims import EXCHANGES, INTERVALS
from candlewick.operators import check as checks
from candlewick.operators import profile as profiles
from candlewick.operators import reader, repair, streams
from candlewick.plans.backfill import backfill_plan
from candlewick.plans.manifest import archive_manifest
from candlewick.schema import ERROR, KEY, SERIES, SPOT
from candlewick.session import staged
from candlewick.sources import archives, catalog
from candlewick.sources.live import live_tail
from candlewick.sources.payloads import LAYOUTS, normalise, split_payloads
from candlewick.streaming import archives as archive_stream
from candlewick.streaming import live as live_stream

RESULTS = ("frame", "streams", "nested_streams")


class CandleHistory:
    """Candles of all series below one root folder.

    Results are DataFrames. ``as_of`` (epoch seconds) stands for "now" and
    defaults to the clock.
    """

    def __init__(self, spark: SparkSession, root: str, trading_type: str = SPOT):
        self.spark = spark
        self.root = root.rstrip("/")
        self.trading_type = trading_type
        store.create(spark, self.root)

    def candles(self, exchange: str | None = None, symbol: str | None = None, interval: str | None = None) -> DataFrame:
        return store.scan(self.spark, self.root, exchange, symbol, interval, self.trading_type)

    def _requests(self, requests: DataFrame) -> DataFrame:
        if "trading_type" in requests.columns:
            return requests
        return requests.selectExpr("*", f"'{self.trading_type}' as trading_type")

    # Load

    def upsert(self, candles: DataFrame, order: tuple[str, ...] = ()) -> None:
        """Merge candles; see ``store.upsert``."""
        store.upsert(self.spark, self.root, candles, order)

    def load_payloads(self, landed: DataFrame, layouts: DataFrame | None = None) -> DataFrame:
        """Merge the candles of API payloads; later requests win. Returns payloads that are no JSON. ``layouts`` are those of ``dims.layout_rows``,
        with rows for other exchanges."""
        # Bodies that are no JSON give no candles, so all are parsed once here.
        self.upsert(normalise(landed, LAYOUTS if layouts is None else layouts), ("request_start", "payload_id", "pos"))
        return split_payloads(landed)[1]

    def load_archives(self, folder: str, symbols: DataFrame, manifest: DataFrame | None = None) -> None:
        """Merge the candles of the verified archives below ``folder``, all or those of a
        ``manifest``. ``symbols`` has a unified ``symbol`` per ``native_symbol``."""
        zips, sums = archives.landed_files(self.spark, folder)
        if manifest is not None:
            zips = zips.join(manifest.select("file").distinct(), "file", "left_semi")
        candles = archives.archive_candles(archives.verified(zips, sums), symbols)
        # Daily files, whose names are longer, win over monthly ones.
        self.upsert(candles.selectExpr("*", "length(file) as detail"), ("detail", "file", "pos"))

    def follow_archives(
        self,
        folder: str,
        symbols: DataFrame,
        checkpoint: str,
        files: int = archive_stream.FILES,
        within: str = archive_stream.WITHIN,
        **trigger,
    ) -> StreamingQuery:
        """Merge archives that land below ``folder`` once their checksum is there, ``files`` at a time; each file is read and hashed once.
        Started again with the same ``checkpoint``, it goes on where it ended; see ``streaming.archives``."""
        zips, sums = archive_stream.landing(self.spark, folder, files)
        contents = archive_stream.landed_contents(self.spark)
        return archive_stream.load(zips, sums, contents, symbols, self.root, checkpoint, within, **trigger)

    def load_live(self, elements: DataFrame) -> None:
        """Merge the closed candles of a buffer of live elements (with ``seq``), the last element of each."""
        self.upsert(live_tail(elements))

    # Read

    def read(
        self,
        exchange: str,
        symbol: str,
        interval: str,
        start_from: int = 0,
        until_to: int | None = None,
        result: str = "frame",
        lenient: bool = False,
        feed: str | None = None,
    ) -> DataFrame:
        """Candles of a series in a time range, in time order, prices as numbers.

        ``result``: ``frame`` for all candles, ``streams`` for runs of
        consistent candles numbered by ``stream_no``, ``nested_streams`` for
        the runs as arrays. With ``feed`` the closed candles in the log of that
        feed are read as well, as if they were merged.
        """
        if exchange not in EXCHANGES:
            raise ValueError(f"unknown exchange {exchange!r}")
        if interval not in EXCHANGES[exchange].intervals:
            raise ValueError(f"{exchange} has no interval {interval!r}")
        if not isinstance(symbol, str):
            raise ValueError("symbol is a text")
        if result not in RESULTS:
            raise ValueError(f"result is one of {RESULTS}")
        until_to = int(time.time()) if until_to is None else until_to
        series = {"exchange": exchange, "symbol": symbol, "interval": interval, "trading_type": self.trading_type}
        candles = store.scan(self.spark, self.root, **series) if feed is None else store.current(self.spark, self.root, feed, **series)
        found = reader.in_range(candles, start_from, until_to)
        if result == "frame":
            return reader.typed(found, lenient).orderBy("open_time")
        runs = reader.typed(streams.consistent_streams(found), lenient)
        if result == "streams":
            return runs.orderBy("stream_no", "open_time")
        return streams.nested_streams(runs).orderBy("stream_no", "segment_no")

    def exists(self, requests: DataFrame) -> DataFrame:
        """Requested (exchange, symbol, interval) with ``present``."""
        asked = self._requests(requests)
        return profiles.series_exists(asked, store.profile(self.spark, self.root, asked))

    def map_streams(
        self, exchange: str, symbol: str, interval: str, work, schema: str, segment: int = streams.SEGMENT, overlap: int = 0, **limits
    ) -> DataFrame:
        """Run pandas ``work`` on the streams of a series, segment by segment; see ``operators.streams``. ``limits`` as in ``read``."""
        return streams.map_streams(self._named(exchange, symbol, interval, **limits), work, schema, segment, overlap)

    def _named(self, exchange: str, symbol: str, interval: str, **limits) -> DataFrame:
        """The streams of a series with the columns that name it."""
        found = self.read(exchange, symbol, interval, result="streams", **limits)
        series = zip(SERIES, (exchange, self.trading_type, symbol, interval))
        return found.selectExpr(*(f"'{value}' as {name}" for name, value in series if name not in found.columns), "*")

    def map_whole_streams(self, exchange: str, symbol: str, interval: str, work, schema: str, **limits) -> DataFrame:
        """Run Arrow ``work`` on each whole stream of a series, batch by batch in time order; see ``operators.streams``. ``limits`` as in ``read``."""
        return streams.map_whole_streams(self._named(exchange, symbol, interval, **limits), work, schema)

    # Live

    def follow(
        self, elements: DataFrame, checkpoint: str, feed: str = store.FEED, merge_every: int = 0, repeats: str | None = None, **trigger
    ) -> StreamingQuery:
        """Log the closed candles of a streaming feed as they come; ``read(feed=...)`` sees them, ``merge_live`` merges them.
        Elements delivered again within ``repeats`` (say "1 hour") are logged once."""
        return live_stream.refresh(elements, self.root, checkpoint, merge_every, feed=feed, repeats=repeats, **trigger)

    def merge_live(self, feed: str = store.FEED) -> int:
        """Merge what the log of a feed holds by now; returns the last batch merged, -1 if there is none."""
        last = store.logged_upto(self.spark, self.root, feed)
        store.merge_log(self.spark, self.root, last, feed)
        return last

    # Extent

    def profile(self, requests: DataFrame | None = None) -> DataFrame:
        """First and last times, first unchecked and oldest valid time, counts per series."""
        if requests is None:
            return store.profile(self.spark, self.root).where(F.col("trading_type") == self.trading_type)
        asked = self._requests(requests)
        return profiles.for_requests(asked, store.profile(self.spark, self.root, asked))

    def first_listed(self, requests: DataFrame, as_of: int | None = None) -> DataFrame:
        return profiles.first_listed(self.profile(requests), self._now(as_of))

    def backfill_plan(self, requests: DataFrame, as_of: int | None = None) -> DataFrame:
        """Requests that bring the stale ones of the series up to date."""
        now = self._now(as_of)
        marked = profiles.with_high_water(self.first_listed(requests, now))
        return backfill_plan(profiles.with_staleness(marked, now, "high_water"), now)

    def archive_manifest(
        self, requests: DataFrame, as_of: int | None = None, available: DataFrame | None = None, force_daily: bool = False
    ) -> DataFrame:
        """Archive files that cover the series."""
        now = self._now(as_of)
        return archive_manifest(self.first_listed(requests, now), now, available, force_daily)

    # Check and repair

    def check(self, start_from: int = 0, as_of: int | None = None, last_n: int | None = None) -> DataFrame:
        """The verdict on every stored candle, or on the last ``last_n`` intervals."""
        start = start_from if last_n is None else repair.recheck_start(self._now(as_of), last_n)
        return checks.check(self.candles(), start)

    def check_and_store(self, start_from: int = 0, as_of: int | None = None, last_n: int | None = None) -> DataFrame:
        """Check, write the changed statuses, and return the errors. ``fold`` after a first check, and now and then."""
        checked = self.check(start_from, as_of, last_n)
        # Errors and changes come from one pass; the rest of the candles is not kept.
        found = checked.select(*KEY, "close_time", "status", "next_open", "checked")
        found = staged(found.where(f"checked = '{ERROR}' or not (checked <=> status)"), "checked")
        store.write_status(self.spark, self.root, checks.status_changes(found))
        return checks.errors(found)

    def report(self, start_from: int = 0, as_of: int | None = None, last_n: int | None = None) -> DataFrame:
        """Per series the number of errors and the last candle looked at."""
        return checks.summary(self.check(start_from, as_of, last_n))

    def repair(self, errors: DataFrame, candidates: DataFrame) -> DataFrame:
        """Merge the acceptable answers to ``errors`` and return the merged candles.

        ``candidates`` are normalised candles with ``request_start`` and
        ``pos``, or one candle per key without them.
        """
        requests = repair.repair_requests(errors)
        if "request_start" in candidates.columns:
            good = repair.accepted_candles(requests, candidates)
        else:
            good = repair.accepted_from_pool(requests, candidates)
        good = staged(good, "repair")
        self.upsert(good)
        return good

    def fold(self) -> None:
        """Move the statuses written since the last time into the table, so that reads need no join."""
        store.fold_status(self.spark, self.root)

    def recover(self) -> None:
        """Finish or undo the write of a process that is gone; see ``store``."""
        store.recover(self.spark, self.root)

    def check_and_repair(
        self, candidates: DataFrame, as_of: int | None = None, last_n: int | None = None
    ) -> DataFrame:
        """Check all or the last ``last_n`` intervals, repair the errors, return them."""
        errors = self.check_and_store(as_of=as_of, last_n=last_n)
        self.repair(errors, candidates)
        return errors

    # Requests

    def validate(self, requests: DataFrame, infos: DataFrame) -> DataFrame:
        """Requests (exchange, symbol, interval) with ``reason``, null if they can be fetched, by exchange-info payloads."""
        return catalog.validate(requests, catalog.symbol_catalog(infos))

    # Metadata

    def meta(self, requests: DataFrame) -> DataFrame:
        return store.lookup_meta(self._requests(requests), store.meta(self.spark, self.root))

    def upsert_meta(self, rows: DataFrame) -> None:
        store.upsert_meta(self.spark, self.root, self._requests(rows))

    @staticmethod
    def supported_intervals(exchange: str | None = None) -> tuple[str, ...]:
        return INTERVALS if exchange is None else EXCHANGES[exchange].intervals

    @staticmethod
    def supported_exchanges() -> tuple[str, ...]:
        return tuple(EXCHANGES)

    @staticmethod
    def _now(as_of: int | None) -> int:
        return int(time.time()) if as_of is None else as_of


