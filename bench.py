"""Benchmark of the jobs on a stored table. Prints one JSON line.

The table holds hourly candles of every user of ``events`` and daily candles
of every supplier of ``lineitem``; making it is not timed. Every job is run
once on the same data to warm up and then timed once, results are discarded.
"""

from __future__ import annotations

import json
import os
import tempfile
import time
from collections.abc import Callable

from candlewick import CandleHistory, store
from candlewick import fixtures as fx
from candlewick.operators import check as checks
from candlewick.operators import merge, profile, reader, repair, streams
from candlewick.plans.backfill import backfill_plan
from candlewick.queries import NOW
from candlewick.schema import KEY, SERIES
from candlewick.session import build_session, new_dir, staged
from candlewick.sources import archives, live, payloads
from candlewick.streaming import continuity

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = build_session(
        "bench",
        **{
            "spark.master": f"local[{CPUS}]",
            "spark.driver.memory": "12g",
            "spark.sql.shuffle.partitions": CPUS,
            "spark.ui.enabled": "false",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="candlewick-bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    root = new_dir(spark, "bench")
    store.create(spark, root)
    hours = fx.event_candles(spark, SF_DIR, "1h", "binance", "user_id")
    days = fx.lineitem_candles(spark, SF_DIR)
    clean = staged(hours.unionByName(days), "bench-clean")
    store.upsert(spark, root, fx.dented(clean))
    table = lambda: store.scan(spark, root)
    store.write_status(spark, root, checks.status_changes(checks.check(table())))
    store.fold_status(spark, root)
    candles = table().count()

    packed = {
        name: staged(fx.payloads(clean.where("interval = '1h'"), name), f"bench-{name}")
        for name in ("binance", "kucoin", "okx")
    }
    incoming = staged(
        clean.where("open_time >= 1706400000 or open_time between 852076800 and 873000000").selectExpr(
            "*", "explode(array(1, 2)) as seq"
        ),
        "bench-incoming",
    )
    feed = staged(fx.live_elements(clean, "null"), "bench-feed")
    zips, sums = fx.archives(clean.where("interval = '1h'"))
    zips, sums = staged(zips, "bench-zips"), staged(sums, "bench-sums")
    listed = table().select("symbol").distinct().selectExpr("symbol", "replace(symbol, '/') as native_symbol")
    symbols = staged(listed, "bench-symbols")
    requests = staged(repair.repair_requests(checks.errors(checks.check(table()))), "bench-requests")
    answers = staged(fx.repair_batches(requests, clean), "bench-answers")

    def upsert() -> None:
        store.upsert(spark, root, incoming, ["seq"])

    changes = staged(checks.errors(checks.check(table())).selectExpr(*KEY, "status"), "bench-changes")

    def stream() -> None:
        folder = new_dir(spark, "bench-stream")
        rows = clean.where("interval = '1h'").selectExpr("*", "0L as seq")
        rows.write.parquet(f"{folder}/in")
        source = spark.readStream.schema(rows.schema).parquet(f"{folder}/in")
        continuity.watch(source, f"{folder}/out", f"{folder}/checkpoint", availableNow=True).awaitTermination()

    def fold() -> None:
        store.write_status(spark, root, changes)
        store.fold_status(spark, root)

    def plan() -> None:
        marked = profile.with_high_water(profile.first_listed(profile.series_profile(table()), NOW))
        run(backfill_plan(profile.with_staleness(marked, NOW, "high_water"), NOW))

    jobs: dict[str, Callable[[], None]] = {
        "range_read": lambda: run(reader.typed(reader.in_range(table(), 1704412800, 1705622400))),
        "series_read": lambda: run(
            reader.typed(reader.in_range(store.scan(spark, root, "bybit", "77/USD", "1d"), 852076800, 915148800))
        ),
        "typed_read": lambda: run(reader.typed(table())),
        "consistency_check": lambda: run(checks.check(table()).select(*SERIES, "open_time", "next_open", "checked")),
        "check_errors": lambda: run(checks.errors(checks.check(table()))),
        "recheck_window": lambda: run(checks.errors(checks.check(table(), repair.recheck_start(NOW, 100)))),
        "consistent_streams": lambda: run(streams.consistent_streams(table())),
        "nested_streams": lambda: run(streams.nested_streams(streams.consistent_streams(table()))),
        "series_profile": lambda: run(profile.series_profile(table())),
        "table_profile": lambda: run(store.profile(spark, root)),
        "backfill_plan": plan,
        "dedupe_last_wins": lambda: run(merge.last_wins(incoming, ["seq"])),
        "upsert_merge": lambda: run(merge.merge_klines(table(), merge.last_wins(incoming, ["seq"]))),
        "upsert_store": upsert,
        "status_writeback": lambda: store.write_status(spark, root, changes),
        "check_and_store": lambda: run(CandleHistory(spark, root).check_and_store()),
        "fold_status": fold,
        "repair_accept": lambda: run(repair.accepted_candles(requests, answers)),
        "repair_from_pool": lambda: run(repair.accepted_from_pool(requests, clean)),
        "live_tail": lambda: run(live.live_tail(feed, live.LAST_N, live.LAST_N_1M)),
        "payload_normalise": lambda: [run(payloads.normalise(p)) for p in packed.values()],
        "archive_ingest": lambda: run(archives.archive_candles(archives.verified(zips, sums), symbols)),
        "stream_continuity": stream,
    }
    times = {}
    for name, job in jobs.items():
        job()
        start = time.perf_counter()
        job()
        times[name] = round(time.perf_counter() - start, 3)

    touched, files = incoming.count(), zips.count()
    print(
        json.dumps(
            {
                "metric": "total time of the jobs",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
                "candles": candles,
                "check_candles_per_sec": round(candles / times["consistency_check"]),
                "upsert_candles_per_sec": round(touched / times["upsert_store"]),
                "archive_files_per_sec": round(files / times["archive_ingest"]),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
