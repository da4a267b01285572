"""The physical plans are the ones meant."""

from __future__ import annotations

import re

import pytest
from helpers import epoch
from pyspark.sql import functions as F

from candlewick import CandleHistory, store
from candlewick import fixtures as fx
from candlewick.operators import check as checks
from candlewick.operators import merge, profile, reader, repair, streams
from candlewick.operators.chunks import nearest
from candlewick.queries import QUERIES
from candlewick.sources import live, payloads

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("plans"))
    store.create(spark, folder)
    store.upsert(spark, folder, fx.history(spark, SF))
    return folder


@pytest.fixture(scope="module", autouse=True)
def no_broadcast(spark):
    """Plans as for sides too big to broadcast."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.debug.maxToStringFields": "1000",
        "spark.sql.maxMetadataStringLength": "10000",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name in settings:
        spark.conf.unset(name)


def windows(text: str) -> set[str]:
    """Partition columns of the windows, without numbers."""
    found = set()
    for line in text.splitlines():
        if "Window [" in line:
            lists = re.findall(r"\[([^\[\]]*)\]", line)
            found.add(re.sub(r"#\d+L?", "", lists[-2] if "NULLS" in lists[-1] else lists[-1]))
    return found


def test_range_read_prunes(spark, root):
    df = reader.in_range(store.scan(spark, root, "binance", "CLICK/USD", "1h"), epoch(2024, 1, 3), epoch(2024, 1, 9))
    scan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in scan
    filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters: \[(.*?)\]", scan)
    for name in ("exchange", "interval", "part", "bucket"):
        assert name in filters[1]
    assert "EqualTo(symbol,CLICK/USD)" in filters[2]


def test_folders_out_of_range_are_not_read(spark, root):
    assert reader.in_range(store.scan(spark, root), epoch(2030, 1, 1)).where("interval = '1h'").inputFiles()
    found = reader.in_range(store.scan(spark, root, interval="1h"), epoch(2030, 1, 1), epoch(2031, 1, 1))
    assert "numFiles" not in plan(found) and found.count() == 0


def test_check_reads_narrow_and_splits_series(spark, root):
    text = plan(checks.errors(checks.check(store.scan(spark, root))))
    assert "open_price" not in text and "volume" not in text
    # Rows are windowed by chunk; only chunk summaries by series.
    by_chunk = "exchange, trading_type, symbol, interval, chunk"
    by_series = "exchange, trading_type, symbol, interval"
    assert windows(text) == {by_chunk, by_series}
    for line in text.splitlines():
        if "Window [" in line and "chunk" not in line.split("windowspecdefinition(")[1].split("specifiedwindowframe")[0]:
            assert "tail" in line, "a window over a series works on summaries"


def test_streams_add_no_shuffle_of_candles(spark, root):
    checked = checks.with_verdict(checks.check(store.scan(spark, root)), keep_chunk=True)
    text = plan(streams.consistent_streams(checked))
    # The wide rows carry prices: count the shuffles below which prices are read.
    wide = [part for part in text.split("Exchange ")[1:] if re.match(r"hashpartitioning\(.*chunk", part)]
    lines = text.splitlines()
    depth = [i for i, line in enumerate(lines) if "FileScan" in line and "open_price" in line]
    assert len(depth) == 1
    indent = lines[depth[0]].index("FileScan")
    above, last = 0, indent
    for line in reversed(lines[: depth[0]]):
        start = re.search(r"[A-Za-z]", line).start()
        if start < last:
            last = start
            above += "Exchange" in line
    assert above == 1 and wide


def test_whole_streams_are_sorted_once(spark, root):
    """Also where columns are constant, as those of a series read by name."""
    numbered = store.scan(spark, root).selectExpr("* except (exchange)", "'binance' as exchange", "open_time div 10 as stream_no")
    text = plan(streams.map_whole_streams(numbered, lambda batches: batches, numbered.schema))
    assert text.count("Exchange ") == 1 and text.count("Sort [") == 1


def test_live_tail_cuts_before_the_shuffle(spark, root):
    text = plan(live.live_tail(fx.live_elements(store.scan(spark, root), "null"), 9, 27))
    assert text.count("Exchange") == 1
    assert re.search(r"WindowGroupLimit .*27, Partial", text)


def test_aggregates_combine_before_the_shuffle(spark, root):
    text = plan(profile.series_profile(store.scan(spark, root)))
    assert text.count("Exchange") == 1 and "partial_min" in text and "SortAggregate" not in text
    assert "partial_max_by" in plan(merge.last_wins(store.scan(spark, root).selectExpr("*", "1 as seq"), ["seq"]))


def test_normalise_has_no_shuffle(spark):
    packed = fx.payloads(fx.event_candles(spark, SF), "bybit")
    before, after = plan(packed), plan(payloads.normalise(packed))
    assert after.count("Exchange") == before.count("Exchange")


def test_a_payload_is_parsed_once(spark, tmp_path):
    fx.payloads(fx.event_candles(spark, SF), "bybit").write.parquet(f"{tmp_path}/bodies")
    text = plan(payloads.normalise(spark.read.parquet(f"{tmp_path}/bodies")))
    assert text.count("parseJson") == 1 and "from_json" not in text and "Exchange" not in text


def test_repair_pairs_by_key(spark, root):
    stored = store.scan(spark, root)
    requests = repair.repair_requests(checks.errors(checks.check(stored)))
    text = plan(repair.accepted_from_pool(requests, stored))
    assert "NestedLoop" not in text and "Cartesian" not in text


@pytest.mark.parametrize(
    "name", sorted(n for n in QUERIES if not n.startswith(("stream_", "table_", "upsert_store")))
)
def test_no_query_pairs_all_rows(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_candles_are_never_windowed_by_series(spark):
    """In every query, a window over whole series sees chunk summaries only."""
    for name in ("consistency_check", "consistent_streams", "streams_in_range", "repair_from_pool", "check_from"):
        for line in plan(QUERIES[name](spark, SF)).splitlines():
            if "Window [" not in line or "windowspecdefinition" not in line:
                continue
            spec = line.split("windowspecdefinition(")[1]
            assert "chunk" in spec or "tail" in line, (name, line[:200])


def shares(df) -> float:
    """Rows of the fullest task against an even share, without adaptive changes."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        counts = [r[1] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    return max(counts) / (sum(counts) / 16)


@pytest.fixture(scope="module")
def one_series(spark):
    """One series that is the whole table: two thousand days, an hour each."""
    return spark.range(48_000).selectExpr(
        "'binance' as exchange", "'SPOT' as trading_type", "'HOT/USD' as symbol", "'1h' as interval",
        "1500000000 + id * 3600 as open_time", "'1' as open_price", "1500003600 + id * 3600 as close_time",
        "'1' as close_price", "'1' as low", "'1' as high", "'1' as volume", "'__OK__' as status",
    )


def test_one_series_is_spread_over_tasks(one_series):
    span = 1 << 18
    assert shares(checks.check(one_series, span=span)) < 2
    assert shares(streams.consistent_streams(one_series, span=span)) < 2
    pool = nearest(one_series.selectExpr("*", "1 as tie"), "open_time", "near", "tie", span=span)
    assert shares(pool) < 2


def test_one_folder_is_written_by_many_tasks(one_series):
    days = one_series.selectExpr(*[f"'1d' as {c}" if c == "interval" else c for c in one_series.columns])
    assert shares(store.placed(store.with_part(days), 16)) < 2


def test_upsert_shuffles_the_table_once(spark, root):
    rows = store.scan(spark, root).drop("part").where("open_time % 7 = 0")
    merged = store._merged(store.scan(spark, root), rows, None)
    text = plan(merged.sortWithinPartitions(*store.ORDER))
    assert text.count("Exchange") == 1 and "Exchange rangepartitioning" in text


def test_copies_of_one_key_are_reduced_before_the_shuffle(spark, one_series):
    columns = [f"1500000000L as {c}" if c == "open_time" else c for c in one_series.columns]
    copies = one_series.selectExpr(*columns, "close_time as seq")
    (row,) = merge.last_wins(copies.repartition(8), ["seq"]).collect()
    assert row.close_time == 1500003600 + 47_999 * 3600


def test_pool_is_read_once(spark, root, monkeypatch):
    """The pool is cut to the requests' buckets before anything is windowed, and written; the store isn't read again."""
    pool = store.scan(spark, root)
    requests = repair.repair_requests(checks.errors(checks.check(pool))).where("exchange = 'okx'")
    written, staged = {}, repair.staged
    monkeypatch.setattr(repair, "staged", lambda rows, label: written.setdefault(label, staged(rows, label)))
    found = repair.accepted_from_pool(requests, pool)
    assert sorted(written) == ["accepted", "pool"] and not any("/klines/" in f for f in found.inputFiles())
    assert 0 < written["pool"].count() < pool.count() and {r.exchange for r in written["pool"].select("exchange").distinct().collect()} == {"okx"}


def test_requests_read_no_candles(spark, root):
    """Where every status is folded in, what is kept of a series comes from its extents, in the folders asked for."""
    history = CandleHistory(spark, root)
    requests = history.candles("binance", interval="1h").select("exchange", "symbol", "interval").distinct().limit(1).toPandas()
    requests = spark.createDataFrame(requests)
    for found in (history.profile(requests), history.exists(requests), history.first_listed(requests)):
        assert found.inputFiles() and all("/extents/" in f for f in found.inputFiles())
        scans = [line for line in plan(found).splitlines() if "FileScan" in line]
        assert any(re.search(r"PartitionFilters: \[.*exchange#\d+ = binance.*interval#\d+ = 1h", line) for line in scans), scans
    assert history.exists(requests).first().present
    assert history.profile(requests).first().n_candles > 0


def test_a_changed_status_moves_no_price(spark, root, monkeypatch):
    """Neither the write of statuses nor what is shuffled of them at a read holds a price."""
    changes = checks.status_changes(checks.check(store.scan(spark, root)))
    assert "open_price" not in plan(changes.select(*checks.KEY, "status").repartitionByRange("open_time"))
    text = plan(store._with_status(store.scan(spark, root), changes.selectExpr("*", "0L as batch")).select("open_time", "status"))
    assert "open_price" not in text
