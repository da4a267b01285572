"""Registered queries: every job of the package on candles made from the test tables."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick import fixtures as fx
from candlewick import store
from candlewick.dims import EXCHANGES, Layout, layout_rows
from candlewick.functions import calendar as cal
from candlewick.functions import text as names
from candlewick.history import CandleHistory
from candlewick.operators import check as checks
from candlewick.operators import merge, profile, reader, repair, streams
from candlewick.plans.backfill import backfill_plan as plan_backfill
from candlewick.plans.manifest import archive_manifest as plan_archives
from candlewick.schema import KEY, KLINE_COLUMNS, META_KEY, PRICES, SERIES, SPOT
from candlewick.session import new_dir, staged
from candlewick.sources import archives, catalog, live, payloads
from candlewick.streaming import archives as archive_stream
from candlewick.streaming import continuity
from candlewick.streaming import live as live_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# 2024-01-31 00:00:00, just after the last event.
NOW = 1706659200
# A range that cuts through the events and one that cuts through the orders.
EVENT_RANGE = (1704412800, 1705622400)
CHECK_FROM = 978307200


def query(run: Query) -> Query:
    def in_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return run(spark, sf_dir)

    in_utc.__doc__ = run.__doc__
    QUERIES[run.__name__] = in_utc
    return in_utc


# Reads


@query
def range_read(spark, sf):
    """A time range of all series, typed."""
    found = reader.in_range(store.with_part(fx.checked_history(spark, sf)), *EVENT_RANGE)
    return reader.typed(found)


@query
def typed_read(spark, sf):
    return reader.typed(fx.history(spark, sf))


@query
def table_read(spark, sf):
    """Write the table, check it, fold the statuses in, then read one exchange and interval in a range from it."""
    root = new_dir(spark, "table_read")
    store.create(spark, root)
    store.upsert(spark, root, fx.history(spark, sf))
    store.write_status(spark, root, checks.status_changes(checks.check(store.scan(spark, root))))
    store.fold_status(spark, root)
    return reader.typed(reader.in_range(store.scan(spark, root, "bybit", None, "1d"), 852076800, 915148800))


@query
def status_filters(spark, sf):
    """Counts of unchecked and of not-OK candles per series."""
    stored = fx.part_checked(fx.history(spark, sf))
    parts = {"unchecked": reader.unchecked(stored), "not_ok": reader.not_ok(stored)}
    counted = [
        df.groupBy(*SERIES).agg(F.expr("count(*) as n")).selectExpr("*", f"'{kind}' as kind") for kind, df in parts.items()
    ]
    return reduce(DataFrame.unionByName, counted)


# Check


@query
def consistency_check(spark, sf):
    checked = checks.check(fx.dented(fx.history(spark, sf)))
    return checked.select(*KEY, "close_time", "next_open", "checked")


@query
def check_errors(spark, sf):
    return checks.errors(checks.check(fx.dented(fx.history(spark, sf))))


@query
def check_summary(spark, sf):
    return checks.summary(checks.check(fx.part_checked(fx.dented(fx.history(spark, sf)))))


@query
def check_from(spark, sf):
    """Check from the start of 2001 on, with the look-back."""
    checked = checks.check(fx.dented(fx.history(spark, sf)), CHECK_FROM)
    return checked.select(*KEY, "next_open", "checked")


@query
def recheck_window(spark, sf):
    """Check the last 100 intervals."""
    checked = checks.check(fx.dented(fx.history(spark, sf)), repair.recheck_start(NOW, 100))
    return checked.select(*KEY, "next_open", "checked")


@query
def status_changes(spark, sf):
    return checks.status_changes(checks.check(fx.part_checked(fx.dented(fx.history(spark, sf)))))


@query
def status_writeback(spark, sf):
    """Stored candles after statuses are set, folded into the table, and changed by a check, which is met at the read."""
    root = new_dir(spark, "status_writeback")
    store.create(spark, root)
    candles = fx.dented(fx.history(spark, sf))
    store.upsert(spark, root, candles)
    store.write_status(spark, root, fx.part_checked(candles))
    store.fold_status(spark, root)
    store.write_status(spark, root, checks.status_changes(checks.check(store.scan(spark, root))))
    return store.scan(spark, root).select(*KEY, "close_time", "status")


# Streams


@query
def consistent_streams(spark, sf):
    checked = checks.with_verdict(checks.check(fx.dented(fx.history(spark, sf))), keep_chunk=True)
    return streams.consistent_streams(checked).select(*KEY, "close_time", "close_price", "stream_no")


def _highest_of_three(candles: pd.DataFrame) -> pd.DataFrame:
    """The highest price of each candle and the two before it in the stream."""
    price = candles.close_price.astype(float)
    highest = price.rolling(3, min_periods=1).max()
    out = candles[[*KEY, "stream_no"]].assign(highest=highest)
    return out[~candles.carried.astype(bool)]


@query
def stream_windows(spark, sf):
    """A rolling value over hourly streams, worked out in pandas segment by segment."""
    checked = checks.with_verdict(checks.check(fx.dented(fx.event_candles(spark, sf, "1h", "binance"))), keep_chunk=True)
    schema = ", ".join([f"{c} string" for c in SERIES]) + ", open_time long, stream_no long, highest double"
    return streams.map_streams(streams.consistent_streams(checked), _highest_of_three, schema, segment=20_000, overlap=7200)


def _highest_so_far(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The highest price of the stream up to each candle, and how many candles that is."""
    highest, seen = -math.inf, 0
    for batch in batches:
        prices = batch.column("close_price").cast(pa.float64()).to_numpy()
        top = np.maximum(np.maximum.accumulate(prices), highest)
        own = [batch.column(c) for c in (*KEY, "stream_no")]
        yield pa.RecordBatch.from_arrays(
            [*own, pa.array(top), pa.array(np.arange(seen + 1, seen + len(top) + 1))], names=[*KEY, "stream_no", "highest", "candle_no"]
        )
        highest, seen = float(top[-1]), seen + len(top)


@query
def stream_running_high(spark, sf):
    """A value that depends on the whole stream before each hourly candle, worked out batch by batch."""
    checked = checks.with_verdict(checks.check(fx.dented(fx.event_candles(spark, sf, "1h", "binance"))), keep_chunk=True)
    schema = ", ".join(f"{c} {'long' if c == 'open_time' else 'string'}" for c in KEY) + ", stream_no long, highest double, candle_no long"
    narrow = streams.consistent_streams(checked).select(*KEY, "stream_no", "close_price")
    return streams.map_whole_streams(narrow, _highest_so_far, schema)


@query
def streams_in_range(spark, sf):
    """Streams of stored statuses in a time range."""
    found = reader.in_range(store.with_part(fx.part_checked(fx.history(spark, sf))), *EVENT_RANGE)
    return reader.typed(streams.consistent_streams(found))


@query
def consistent_streams_nested(spark, sf):
    """Nested streams, shown by size and ends."""
    nested = streams.nested_streams(streams.consistent_streams(fx.checked_history(spark, sf)))
    return nested.selectExpr(
        *SERIES,
        "stream_no",
        "segment_no",
        "cast(size(candles) as bigint) as n",
        "candles[0].open_time as first_open",
        "element_at(candles, -1).close_time as last_close",
        "element_at(candles, -1).close_price as last_price",
    )


# Extent


@query
def series_profile(spark, sf):
    return profile.series_profile(fx.part_checked(fx.history(spark, sf)))


def _requests(spark: SparkSession, sf: str) -> DataFrame:
    """Every stored series, and every nation as a symbol nothing is stored of."""
    present = fx.history(spark, sf).select(*SERIES).distinct()
    absent = spark.read.parquet(f"{sf}/nation.parquet").selectExpr(
        "if(n_nationkey % 2 = 0, 'binance', 'kucoin') as exchange",
        f"'{SPOT}' as trading_type",
        "n_name || '/USD' as symbol",
        "'1h' as interval",
    )
    return present.unionByName(absent)


def _profile(spark: SparkSession, sf: str) -> DataFrame:
    return profile.for_requests(_requests(spark, sf), profile.series_profile(fx.history(spark, sf)))


@query
def min_valid_historical(spark, sf):
    """Newest candle that is not OK, else the oldest, else 0."""
    figures = profile.series_profile(fx.checked_history(spark, sf))
    return profile.for_requests(_requests(spark, sf), figures).select(*SERIES, "min_valid", "min_unchecked")


@query
def first_listed(spark, sf):
    return profile.first_listed(_profile(spark, sf), NOW).select(
        *SERIES, "first_year", "first_month", "first_month_time"
    )


@query
def staleness(spark, sf):
    marked = profile.with_high_water(profile.first_listed(_profile(spark, sf), NOW))
    return profile.with_staleness(marked, NOW, "high_water").select(*SERIES, "high_water", "stale")


@query
def series_exists(spark, sf):
    return profile.series_exists(_requests(spark, sf), fx.history(spark, sf))


# Merge


def _incoming(candles: DataFrame) -> DataFrame:
    """Two versions of every candle whose price moved, and of a new candle a minute later."""
    versions = (
        candles.where("high <> low")
        .selectExpr("*", "explode(array(1, 2)) as seq")
        .selectExpr("*", "explode(array(0, 1)) as shift")
    )
    return fx.replaced(
        versions, open_time="open_time + shift * 60", volume="volume || ':' || seq", low="if(seq = 1, low, null)"
    ).drop("shift")


@query
def dedupe_last_wins(spark, sf):
    return merge.last_wins(_incoming(fx.history(spark, sf)), ["seq"])


@query
def upsert_merge(spark, sf):
    stored = fx.part_checked(fx.history(spark, sf))
    return merge.merge_klines(stored, merge.last_wins(_incoming(fx.history(spark, sf)), ["seq"]))


@query
def upsert_store(spark, sf):
    """The same merge through the table, folder by folder."""
    return store.scan(spark, _upserted(spark, sf, "upsert_store")).select(*KLINE_COLUMNS)


def _upserted(spark: SparkSession, sf: str, label: str) -> str:
    """A table whose candles got statuses, then new versions."""
    root = new_dir(spark, label)
    store.create(spark, root)
    store.upsert(spark, root, fx.history(spark, sf))
    store.write_status(spark, root, fx.part_checked(fx.history(spark, sf)))
    store.upsert(spark, root, _incoming(fx.history(spark, sf)), ["seq"])
    return root


@query
def table_profile(spark, sf):
    """The profile of that table out of the extents kept by its writes; the daily statuses are folded in, the others not."""
    root = _upserted(spark, sf, "table_profile")
    store.fold_status(spark, root)
    store.write_status(spark, root, fx.part_checked(fx.history(spark, sf)).where("interval <> '1d'"))
    return store.profile(spark, root)


def _first_months(spark: SparkSession, sf: str) -> DataFrame:
    first = fx.history(spark, sf).groupBy(*SERIES).agg(F.expr("min(open_time) as t"))
    return first.selectExpr(*SERIES, f"{cal.date_of('t')} as first")


def _meta_rows(rows: DataFrame, date: str) -> DataFrame:
    data = f"to_json(named_struct('year', year({date}), 'month', month({date}))) as data"
    return rows.selectExpr(*SERIES, "'first_year_month_listed' as cache_type", data)


@query
def meta_upsert(spark, sf):
    """First-listed months, corrected for the orders, with the lookup key."""
    first = _first_months(spark, sf)
    corrected = _meta_rows(first.where("exchange <> 'binance'"), "add_months(first, 2)")
    return store.with_meta_key(merge.merge_meta(_meta_rows(first, "first"), corrected))


@query
def meta_lookup(spark, sf):
    wanted = _requests(spark, sf).selectExpr("*", "'first_year_month_listed' as cache_type")
    return store.lookup_meta(wanted, _meta_rows(_first_months(spark, sf), "first")).select(*META_KEY, "data")


# Payloads


def _normalise_query(exchange: str) -> None:
    def run(spark, sf):
        candles = fx.event_candles(spark, sf, "1h", exchange)
        found = payloads.normalise(fx.payloads(candles, exchange))
        plain = [c for c in KLINE_COLUMNS if not (exchange == "bingx" and c in PRICES)]
        # Numbers lose trailing zeros on their way through JSON, so they compare as decimals.
        prices = [f"cast(cast({c} as decimal(18,2)) as string) as {c}" for c in PRICES if c not in plain]
        return found.selectExpr("payload_id", "cast(pos as bigint) as pos", *plain, *prices)

    run.__name__ = f"payload_normalise_{exchange}"
    run.__doc__ = f"Candles out of {exchange} payloads."
    query(run)


for _name in EXCHANGES:
    _normalise_query(_name)


@query
def payload_new_exchange(spark, sf):
    """An exchange that the package doesn't know, its layout given as a row beside the others."""
    candles = fx.event_candles(spark, sf, "1h", "newcomer")
    own = Layout("$.reply.rows", 8, 2, 7, (5, 4, 3, 1, 0), unit_ms=False, tail="flag", flag=6, success=("$.reply.state", "fine"))
    layouts = layout_rows(spark).unionByName(layout_rows(spark, {"newcomer": own}))
    found = payloads.normalise(fx.payloads(candles, "newcomer"), layouts)
    return found.selectExpr("payload_id", "cast(pos as bigint) as pos", *KLINE_COLUMNS)


_AS_TEXT = "regexp_replace(props, ': ([0-9]+)', ': \"$1\"')"


def _bodies(spark: SparkSession, sf: str) -> DataFrame:
    """Event properties as payloads; every seventh is cut short, every fifth day has a text value."""
    return (
        spark.read.parquet(f"{sf}/events.parquet")
        .selectExpr("event_id", "event_type", "props", f"{fx.seconds('ts')} as received")
        .selectExpr("*", f"if(floor(received / 86400) % 5 = 0, {_AS_TEXT}, props) as whole")
        .selectExpr(
            "cast(event_id as string) as payload_id",
            "event_type as exchange",
            "received",
            "if(event_id % 7 = 0, left(whole, 4), whole) as body",
        )
    )


@query
def payload_quarantine(spark, sf):
    good, bad = payloads.split_payloads(_bodies(spark, sf))
    counted = [
        df.groupBy("exchange").agg(F.expr("count(*) as n")).selectExpr("*", f"{ok} as json")
        for df, ok in ((good, "true"), (bad, "false"))
    ]
    return reduce(DataFrame.unionByName, counted)


@query
def payload_drift(spark, sf):
    """Days on which the shape of an exchange's payloads changed."""
    good, _ = payloads.split_payloads(_bodies(spark, sf))
    return payloads.drift(good).selectExpr("exchange", "cast(day as string) as day", "drifted")


@query
def payload_parity(spark, sf):
    """Whether each event's properties have the shape of the same body with a text value."""
    events = spark.read.parquet(f"{sf}/events.parquet")
    other = f"if(event_id % 3 = 0, {_AS_TEXT}, props)"
    shapes = events.selectExpr("event_id", f"{names.structure('props')} as a", f"{names.structure(other)} as b")
    return shapes.select("event_id", names.same_structure("a", "b").alias("same"))


# Catalogs and requests


def _infos(spark: SparkSession, sf: str) -> DataFrame:
    """Exchange-info payloads: nations are base assets, regions quote assets."""
    nation = spark.read.parquet(f"{sf}/nation.parquet")
    region = spark.read.parquet(f"{sf}/region.parquet")
    pairs = nation.join(region, F.expr("n_regionkey = r_regionkey")).selectExpr(
        "n_nationkey", "lower(n_name) as base", "replace(r_name, ' ') as quote"
    )
    parts = []
    for name, exchange in EXCHANGES.items():
        shape = exchange.catalog
        if shape.joined:
            entry = f"""format_string('{{"{shape.joined}":"%s-%s"}}', base, quote)"""
        else:
            entry = f"""format_string('{{"{shape.base}":"%s","{shape.quote}":"%s","n":1}}', base, quote)"""
        opening, closing = {
            "$.symbols": ('{"symbols":', "}"),
            "$.result.list": ('{"retCode":0,"result":{"list":', "}}"),
            "$.data": ('{"code":"%s","data":' % (shape.success or ("", "0"))[1], "}"),
            "$.data.symbols": ('{"code":0,"data":{"symbols":', "}}"),
        }[shape.root]
        # 25 nations.
        entries = f"transform(array_sort(collect_list(struct(n_nationkey, {entry} as e))), x -> x.e)"
        body = f"""concat('{opening}[{{"other":"x"}},', concat_ws(',', {entries}), ']{closing}') as body"""
        parts.append(pairs.groupBy(F.expr(f"'{name}' as exchange")).agg(F.expr(body)))
    return reduce(DataFrame.unionByName, parts)


@query
def symbol_catalog(spark, sf):
    return catalog.symbol_catalog(_infos(spark, sf))


@query
def symbol_list(spark, sf):
    """Each exchange's symbols in order, numbered."""
    lists = catalog.symbol_lists(catalog.symbol_catalog(_infos(spark, sf)))
    return lists.selectExpr("exchange", "posexplode(symbols) as (place, symbol)")


def _customer_natives(spark: SparkSession, sf: str) -> DataFrame:
    """A native symbol per customer: nation and market segment's region, some unlisted."""
    customer = spark.read.parquet(f"{sf}/customer.parquet")
    nation = spark.read.parquet(f"{sf}/nation.parquet")
    region = spark.read.parquet(f"{sf}/region.parquet")
    listed = ", ".join(f"'{name}'" for name in sorted(EXCHANGES))
    return (
        customer.join(nation, F.expr("c_nationkey = n_nationkey"))
        .join(region, F.expr("n_regionkey = r_regionkey"))
        .selectExpr(
            "c_custkey",
            f"array({listed})[c_custkey % {len(EXCHANGES)}] as exchange",
            "upper(n_name) as base",
            "if(c_custkey % 5 = 0, 'NONE', replace(r_name, ' ')) as quote",
        )
    )


@query
def symbol_map(spark, sf):
    """Native symbols to unified ones."""
    natives = _customer_natives(spark, sf).selectExpr(
        "c_custkey",
        "exchange",
        "concat(base, if(exchange in ('okx', 'kucoin', 'bingx'), '-', ''), quote) as native_symbol",
    )
    return catalog.with_unified_symbol(natives, catalog.symbol_catalog(_infos(spark, sf)))


@query
def native_symbols(spark, sf):
    """Unified symbols to native ones."""
    unified = _customer_natives(spark, sf).selectExpr("c_custkey", "exchange", "base || '/' || quote as symbol")
    return catalog.with_native_symbol(unified, catalog.symbol_catalog(_infos(spark, sf)))


@query
def interval_codes(spark, sf):
    """Every exchange's code for the intervals of the stored series."""
    series = fx.history(spark, sf).select("symbol", "interval").distinct()
    listed = ", ".join(f"'{name}'" for name in EXCHANGES)
    return catalog.with_native_interval(series.selectExpr("*", f"explode(array({listed})) as exchange"))


@query
def fetch_spec_validate(spark, sf):
    """Which customers' fetch requests are fit to run."""
    specs = _customer_natives(spark, sf).selectExpr(
        "c_custkey",
        "if(c_custkey % 11 = 0, 'nowhere', exchange) as exchange",
        "if(exchange = 'bingx', lower(base), base) || '/' || quote as symbol",
        "array('1m', '8h', '3d', '1mo', '7m')[c_custkey % 7 % 5] as interval",
    )
    return catalog.validate(specs, catalog.symbol_catalog(_infos(spark, sf)))


# Plans


@query
def backfill_plan(spark, sf):
    marked = profile.with_high_water(profile.first_listed(_profile(spark, sf), NOW))
    return plan_backfill(profile.with_staleness(marked, NOW, "high_water"), NOW)


def _event_series(spark: SparkSession, sf: str) -> DataFrame:
    """The hourly series, one of them as if nothing were stored of it."""
    figures = profile.series_profile(fx.event_candles(spark, sf, "1h", "binance"))
    return fx.replaced(profile.first_listed(figures, NOW), last_open="if(symbol = 'CLICK/USD', 0, last_open)")


_FILES = (*SERIES, "cast(month as string) as month", "kind", "file")


@query
def archive_manifest(spark, sf):
    """Candidate files per series at 2024-03-20 16:00."""
    return plan_archives(_event_series(spark, sf), 1710950400).selectExpr(*_FILES)


@query
def archive_manifest_landed(spark, sf):
    """Files to load where the January files and those of each month's tenth on have landed."""
    requests = _event_series(spark, sf)
    every = plan_archives(requests, 1710950400)
    landed = every.where("if(kind = 'monthly', month(month) = 1, left(right(file, 6), 2) >= '10')").select("file")
    return plan_archives(requests, 1710950400, landed).selectExpr(*_FILES)


@query
def archive_ingest(spark, sf):
    """Candles of the archives whose checksum is right."""
    zips, sums = fx.archives(fx.event_candles(spark, sf, "1h", "binance"))
    found = archives.archive_candles(archives.verified(zips, sums), _event_symbols(spark, sf))
    return found.select(*KLINE_COLUMNS)


def _event_symbols(spark: SparkSession, sf: str) -> DataFrame:
    return (
        spark.read.parquet(f"{sf}/events.parquet")
        .selectExpr("upper(event_type) || '/USD' as symbol")
        .distinct()
        .selectExpr("symbol", "replace(symbol, '/') as native_symbol")
    )


@query
def archive_stream_load(spark, sf):
    """The same archives as they land, in three runs of a stream: checksums come before, with or after them, some too late, some never."""
    folder, root = new_dir(spark, "landed"), new_dir(spark, "archive_stream")
    store.create(spark, root)
    zips, sums = fx.landing_archives(fx.event_candles(spark, sf, "1h", "binance"))
    zips, sums = staged(zips, "zips"), staged(sums, "sums")
    for days in fx.DECADES:
        feeds = []
        for name, part in (("zips", zips), ("sums", sums)):
            part.where(days.format("unix_seconds(landed)")).write.mode("append").parquet(f"{folder}/{name}")
            feeds.append(spark.readStream.schema(part.schema).parquet(f"{folder}/{name}"))

        def contents(paths: list[str]) -> DataFrame:
            return spark.read.parquet(f"{folder}/zips").where(F.col("path").isin(paths)).select("file", "content")

        archive_stream.load(*feeds, contents, _event_symbols(spark, sf), root, f"{root}/checkpoint", availableNow=True).awaitTermination()
    return store.scan(spark, root).select(*KLINE_COLUMNS)


# Repair


def _repair(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    clean = fx.history(spark, sf)
    stored = fx.part_checked(fx.dented(clean))
    requests = repair.repair_requests(checks.errors(checks.check(stored)))
    return clean, stored, requests


@query
def repair_accept(spark, sf):
    """The verdict on each fetched batch."""
    clean, _, requests = _repair(spark, sf)
    return repair.batch_verdicts(fx.repair_batches(requests, clean)).select(*repair.BATCH, "accepted")


@query
def repair_apply(spark, sf):
    """Stored candles after the accepted batches are merged."""
    clean, stored, requests = _repair(spark, sf)
    good = repair.accepted_candles(requests, fx.repair_batches(requests, clean))
    return merge.merge_klines(stored, good)


@query
def repair_from_pool(spark, sf):
    """Replacement candles taken from a pool that does not know the requests."""
    clean, _, requests = _repair(spark, sf)
    return repair.accepted_from_pool(requests, clean)


# Live


@query
def live_tail(spark, sf):
    """Closed candles among the newest of a feed with the flag, one without and a one-minute feed; each candle comes several times."""
    return live.live_tail(_feeds(spark, sf), live.LAST_N, live.LAST_N_1M)


def _feeds(spark: SparkSession, sf: str) -> DataFrame:
    feeds = [
        fx.live_elements(fx.event_candles(spark, sf, "1h", "binance"), f"{fx.HOUR} % 4 <> 0"),
        fx.live_elements(fx.event_candles(spark, sf, "1h", "kucoin"), "null"),
        fx.live_elements(fx.event_candles(spark, sf, "1m", "okx"), "null"),
    ]
    last = reduce(DataFrame.unionByName, feeds)
    # Before the last element, one of each candle that is not closed, and two with other volumes.
    early = last.withColumn("no", F.expr("explode(array(1L, 2L, 3L))"))
    early = early.withColumns({"volume": F.lit("early"), "is_closed": F.expr("no > 1"), "seq": F.expr("no - 4")})
    return last.unionByName(early.select(*last.columns))


@query
def load_live(spark, sf):
    """All closed candles of the feeds, merged into a new store."""
    root = new_dir(spark, "load_live")
    history = CandleHistory(spark, root)
    history.load_live(_feeds(spark, sf))
    return store.scan(spark, root).select(*KLINE_COLUMNS)


@query
def stream_upsert(spark, sf):
    """A feed streamed into the log and merged: open candles, then corrections."""
    feed, root = new_dir(spark, "feed"), new_dir(spark, "stream_upsert")
    store.create(spark, root)
    flagged = fx.event_candles(spark, sf, "1h", "binance")
    unflagged = fx.event_candles(spark, sf, "1h", "kucoin")
    first = fx.live_elements(flagged, f"{fx.HOUR} % 4 <> 0").unionByName(fx.live_elements(unflagged, "null"))
    corrected = fx.replaced(flagged.where("high <> low"), volume="'corrected'")
    second = fx.live_elements(corrected, "true", seq=1)
    for part in (first, second):
        part.write.mode("append").json(feed)
        live_stream.refresh(
            live_stream.json_feed(spark, feed), root, f"{root}/checkpoint", merge_every=1, availableNow=True
        ).awaitTermination()
    return store.scan(spark, root).select(*KLINE_COLUMNS)


@query
def stream_continuity(spark, sf):
    """Verdicts given while the candles stream in, ten days at a time."""
    landed, root = new_dir(spark, "candles"), new_dir(spark, "continuity")
    candles = fx.dented(fx.event_candles(spark, sf, "1h", "binance")).selectExpr("*", "0L as seq")
    for days in fx.DECADES:
        part = candles.where(days.format("open_time"))
        part.write.mode("append").parquet(landed)
        feed = spark.readStream.schema(part.schema).parquet(landed)
        continuity.watch(feed, root, f"{root}/checkpoint", availableNow=True).awaitTermination()
    return continuity.verdicts(spark, root)


@query
def stream_verdict_revisions(spark, sf):
    """Every fifth hour comes late and splits pairs judged before: the verdicts that hold, and those first given."""
    landed, root = new_dir(spark, "candles"), new_dir(spark, "revisions")
    candles = fx.dented(fx.event_candles(spark, sf, "1h", "binance")).selectExpr("*", "0L as seq")
    for hours in (f"{fx.HOUR} % 5 <> 0", f"{fx.HOUR} % 5 = 0"):
        part = candles.where(hours)
        part.write.mode("append").parquet(landed)
        feed = spark.readStream.schema(part.schema).parquet(landed)
        continuity.watch(feed, root, f"{root}/checkpoint", availableNow=True).awaitTermination()
    firsts = continuity.revised(spark, root).select(*KEY, "first_next_open", "first_checked")
    return (
        continuity.verdicts(spark, root)
        .join(firsts, [*KEY], "left")
        .selectExpr(*continuity.VERDICT_COLUMNS, "coalesce(first_next_open, next_open) as first_next_open", "coalesce(first_checked, checked) as first_checked")
    )


# Expressions


@query
def calendar_exprs(spark, sf):
    """Calendar arithmetic on order dates."""
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    shifted = orders.selectExpr("o_orderkey as k", f"{fx.seconds('o_orderdate')} + o_orderkey % 86400 as t")
    dated = shifted.selectExpr("*", f"{cal.date_of('t')} as d", "(k % 4 + 1) || 'mo' as months")
    today = "date'1998-07-15'"
    columns = {
        "o_orderkey": "k",
        "text": cal.time_text("t"),
        "year": cal.year_of("t"),
        "month": cal.month_of("t"),
        "day": cal.day_of("t"),
        "month_seconds": cal.interval_seconds("'1mo'", "t"),
        "months_seconds": cal.interval_seconds("months", "t"),
        "plain_months_seconds": cal.interval_seconds("months"),
        "weeks_seconds": cal.interval_seconds("concat(k % 9 + 1, 'w')"),
        "next_month_time": cal.next_month_time("t"),
        "previous_month": cal.previous_month("d"),
        "next_month": cal.next_month("d"),
        "next_month_until": cal.next_month_until("d", today),
        "previous_day": cal.previous_day("d"),
        "next_day": cal.next_day_until("d", today),
        "since_midnight": cal.seconds_from_midnight("d", "900000000L"),
        "months_ago": cal.months_ago("d", today),
        "rounded": cal.rounded_seconds("t * 1000 + k * 37 % 1000"),
        "from_micros": cal.archive_seconds("t * 1000000 + 999999"),
        "from_millis": cal.archive_seconds("t * 1000 + 499"),
    }
    dates = ("previous_month", "next_month", "next_month_until", "previous_day", "next_day")
    texts = {name: f"cast({e} as string)" if name in dates else e for name, e in columns.items()}
    return dated.selectExpr(*[f"{e} as {name}" for name, e in texts.items()])


@query
def series_names(spark, sf):
    """Series and partition names and metadata keys."""
    years = (
        fx.history(spark, sf).groupBy(*SERIES, F.expr(f"{cal.year_of('open_time')} as year")).agg(F.expr("count(*) as n"))
    )
    name = names.series_name()
    return years.selectExpr(
        *SERIES,
        "year",
        "n",
        f"{name} as series_name",
        f"{names.partition_name(name)} as partition_name",
        f"{names.meta_key(repr('kind'))} as key",
    )
