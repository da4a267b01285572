from __future__ import annotations

from helpers import candle, epoch, frame, plain_check, random_series

from candlewick import CandleHistory, store
from candlewick.schema import KEY, KLINE_COLUMNS
from candlewick.streaming import continuity, live

T = epoch(2024, 1, 1)


def watch(spark, landed, root, rows, **options):
    df = frame(spark, rows).selectExpr("*", "0L as seq")
    df.write.mode("append").parquet(landed)
    feed = spark.readStream.schema(df.schema).parquet(landed)
    continuity.watch(feed, root, f"{root}/checkpoint", availableNow=True, **options).awaitTermination()


def found_verdicts(spark, root):
    return {tuple(r[c] for c in KEY): (r.next_open, r.checked) for r in continuity.verdicts(spark, root).collect()}


def test_continuity_equals_batch_check(spark, tmp_path):
    rows = sorted(random_series(5, 12), key=lambda r: r[4])
    landed, root = str(tmp_path / "in"), str(tmp_path / "out")
    for i in range(4):
        watch(spark, landed, root, rows[i * len(rows) // 4 : (i + 1) * len(rows) // 4])
    assert found_verdicts(spark, root) == {k: v for k, v in plain_check(rows).items() if v[0] is not None}
    assert continuity.revised(spark, root).count() == 0


def test_any_order_gives_the_verdicts_of_a_batch_check(spark, tmp_path):
    """Candles in random order, small spans, each run a restart; verdicts given meanwhile are those on the candles there are."""
    rows = random_series(7, 8)
    landed, root = str(tmp_path / "in"), str(tmp_path / "out")
    for i in range(5):
        watch(spark, landed, root, rows[i * len(rows) // 5 : (i + 1) * len(rows) // 5], width=7200 * 2)
        so_far = rows[: (i + 1) * len(rows) // 5]
        assert found_verdicts(spark, root) == {k: v for k, v in plain_check(so_far).items() if v[0] is not None}
    assert continuity.revised(spark, root).count() > 0
    assert continuity.judged(spark, root, "late").count() == 0


def test_late_candles_revise_verdicts(spark, tmp_path):
    landed, root = str(tmp_path / "in"), str(tmp_path / "out")
    seed = frame(spark, [candle(T)])
    watch(spark, landed, root, [candle(T + 3600), candle(T + 10800)], seed=seed)
    watch(spark, landed, root, [candle(T + 7200), candle(T + 14400)])
    assert {k[4]: v for k, v in found_verdicts(spark, root).items()} == {T + 3600 * n: (T + 3600 * (n + 1), "__OK__") for n in range(4)}
    revised = [(r.open_time, r.first_next_open, r.next_open, r.first_checked, r.checked) for r in continuity.revised(spark, root).collect()]
    assert revised == [(T + 3600, T + 10800, T + 7200, "__ERROR__", "__OK__")]


def test_candles_before_the_kept_ones_are_set_aside(spark, tmp_path):
    landed, root = str(tmp_path / "in"), str(tmp_path / "out")
    hours = [candle(T + 3600 * n) for n in range(40) if n not in (3, 30)]
    watch(spark, landed, root, hours, keep=15, width=7200)
    watch(spark, landed, root, [candle(T + 3600 * 3), candle(T + 3600 * 30), candle(T + 3600 * 40)], keep=15, width=7200)
    assert [r.open_time for r in continuity.judged(spark, root, "late").collect()] == [T + 3600 * 3]
    wrong = {k[4]: v for k, v in found_verdicts(spark, root).items() if v[1] != "__OK__"}
    assert wrong == {T + 3600 * 2: (T + 3600 * 4, "__ERROR__")}


def test_no_folder_per_batch(spark, tmp_path):
    landed, root = str(tmp_path / "in"), str(tmp_path / "out")
    for n in range(3):
        watch(spark, landed, root, [candle(T + 3600 * n)])
    assert sorted(p.name for p in tmp_path.joinpath("out").iterdir()) == ["checkpoint", "judged"]
    assert [p.name for p in tmp_path.joinpath("out/judged").iterdir() if p.is_dir()] == ["_spark_metadata"]


def test_refresh(spark, tmp_path):
    from candlewick import fixtures as fx

    history = CandleHistory(spark, str(tmp_path / "store"))
    feed = str(tmp_path / "feed")

    def run(rows, closed, **options):
        fx.live_elements(frame(spark, rows), closed).write.mode("append").json(feed)
        live.refresh(
            live.json_feed(spark, feed, files_per_batch=100), history.root, str(tmp_path / "checkpoint"), availableNow=True, **options
        ).awaitTermination()

    run([candle(T), candle(T + 3600)], f"open_time = {T}")
    assert history.candles().count() == 0
    assert {r.open_time for r in store.current(spark, history.root).collect()} == {T}
    run([candle(T, price="8"), candle(T + 3600, price="8")], "true", merge_every=1)
    assert {(r.open_time, r.open_price) for r in history.candles().collect()} == {(T, "8"), (T + 3600, "8")}
    run([candle(T - 3600)], "null", merge_every=1)  # late
    assert sorted(r.open_time for r in history.candles().select(*KLINE_COLUMNS).collect()) == [T - 3600, T, T + 3600]


def test_correction_of_the_newest_candle_replaces_it(spark, tmp_path):
    """The tail comes again with another end: the verdict is on the new values."""
    landed, root = str(tmp_path / "landed"), str(tmp_path / "root")
    batches = [[candle(T, T + 60)], [candle(T, volume="right"), candle(T + 3600)], [candle(T + 7200)]]
    for rows in batches:
        part = frame(spark, rows).selectExpr("*", "0L as seq")
        part.write.mode("append").parquet(landed)
        continuity.watch(spark.readStream.schema(part.schema).parquet(landed), root, f"{root}/checkpoint", availableNow=True).awaitTermination()
    found = {r.open_time: r.checked for r in continuity.verdicts(spark, root).collect()}
    assert found == {T: "__OK__", T + 3600: "__OK__"}
    assert continuity.judged(spark, root, "late").count() == 0
    revised = {r.open_time: (r.first_checked, r.checked) for r in continuity.revised(spark, root).collect()}
    assert revised == {}


def test_correction_of_a_judged_candle_revises_it(spark, tmp_path):
    landed, root = str(tmp_path / "landed"), str(tmp_path / "root")
    for rows in ([candle(T, T + 60), candle(T + 3600)], [candle(T)]):
        watch(spark, landed, root, rows)
    assert [(r.open_time, r.first_checked, r.checked) for r in continuity.revised(spark, root).collect()] == [(T, "__ERROR__", "__OK__")]


def test_live_candles_on_the_object(spark, tmp_path):
    history = CandleHistory(spark, str(tmp_path / "store"))
    from candlewick import fixtures as fx

    history.upsert(frame(spark, [candle(T, volume="stored")]))
    feed = str(tmp_path / "feed")
    elements = fx.live_elements(frame(spark, [candle(T, volume="corrected"), candle(T + 3600), candle(T + 7200)]), f"open_time < {T + 7200}")
    elements.write.json(feed)
    assert history.merge_live() == -1
    history.follow(live.json_feed(spark, feed), str(tmp_path / "checkpoint"), availableNow=True).awaitTermination()

    def read(**options):
        return [(r.open_time, r.volume) for r in history.read("binance", "A/USD", "1h", until_to=T + 10**6, lenient=True, **options).collect()]

    assert [t for t, _ in read()] == [T]
    assert [t for t, _ in read(feed="live")] == [T, T + 3600]
    assert history.merge_live() == 0
    assert [t for t, _ in read()] == [T, T + 3600]


def test_elements_that_come_again_are_logged_once(spark, tmp_path):
    from candlewick import fixtures as fx

    history = CandleHistory(spark, str(tmp_path / "store"))
    feed, checkpoint = str(tmp_path / "feed"), str(tmp_path / "checkpoint")

    def run(rows):
        fx.live_elements(frame(spark, rows), "true").write.mode("append").json(feed)
        history.follow(live.json_feed(spark, feed, files_per_batch=100), checkpoint, repeats="1 hour", availableNow=True).awaitTermination()
        logged = spark.read.option("recursiveFileLookup", "true").parquet(f"{history.root}/log/live")
        return sorted((r.open_time, r.open_price) for r in logged.collect())

    assert run([candle(T), candle(T), candle(T + 3600)]) == [(T, "1.5"), (T + 3600, "1.5")]
    assert run([candle(T)]) == [(T, "1.5"), (T + 3600, "1.5")]
    assert run([candle(T, price="8"), candle(T - 10**7)]) == [(T - 10**7, "1.5"), (T, "1.5"), (T, "8"), (T + 3600, "1.5")]
    history.merge_live()
    assert {r.open_time: r.open_price for r in history.candles().collect()} == {T - 10**7: "1.5", T: "8", T + 3600: "1.5"}
