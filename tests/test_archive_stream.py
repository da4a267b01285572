from __future__ import annotations

import hashlib
import os

import pytest
from helpers import epoch
from test_sources import line, put

from candlewick import CandleHistory
from candlewick.streaming import archives as stream

T = epoch(2024, 1, 1)
DAY = 86400


@pytest.fixture
def history(spark, tmp_path):
    return CandleHistory(spark, str(tmp_path / "table"))


@pytest.fixture
def landed(tmp_path):
    folder = tmp_path / "landed" / "deep"
    folder.mkdir(parents=True)
    return folder


def run(spark, history, tmp_path, **options):
    symbols = spark.createDataFrame([("AUSD", "A/USD")], "native_symbol string, symbol string")
    query = history.follow_archives(str(tmp_path / "landed"), symbols, str(tmp_path / "checkpoint"), availableNow=True, **options)
    query.awaitTermination()
    return query.recentProgress


def stored(history):
    return {r.open_time: r.volume for r in history.candles(symbol="A/USD").collect()}


def at(path, seconds):
    os.utime(path, (seconds, seconds))


def test_checksums_before_after_wrong_and_missing(spark, history, tmp_path, landed):
    put(landed, "AUSD-1h-2024-01-01.zip", [line(T)])
    put(landed, "AUSD-1h-2024-01-02.zip", [line(T + DAY)], checksum=None)
    put(landed, "AUSD-1h-2024-01-03.zip", [line(T + 2 * DAY)], checksum="wrong")
    put(landed, "AUSD-1h-2024-01-04.zip", [line(T + 3 * DAY)])
    early = landed / "AUSD-1h-2024-01-04.zip"
    content = early.read_bytes()
    early.unlink()
    run(spark, history, tmp_path)
    assert stored(history) == {T: "7"}

    early.write_bytes(content)
    digest = hashlib.sha256((landed / "AUSD-1h-2024-01-02.zip").read_bytes()).hexdigest()
    (landed / "AUSD-1h-2024-01-02.zip.CHECKSUM").write_text(digest)
    progress = run(spark, history, tmp_path)
    assert stored(history) == {T: "7", T + DAY: "7", T + 3 * DAY: "7"}
    assert sum(p.numInputRows for p in progress) == 2

    assert sum(p.numInputRows for p in run(spark, history, tmp_path)) == 0
    assert len(stored(history)) == 3


def test_small_batches_and_odd_names(spark, history, tmp_path, landed):
    odd = landed / "a b{1}[x]"
    odd.mkdir()
    for n in range(5):
        put(odd if n % 2 else landed, f"AUSD-1h-2024-01-0{n + 1}.zip", [line(T + n * DAY)])
    run(spark, history, tmp_path, files=2)
    assert sorted(stored(history)) == [T + n * DAY for n in range(5)]


def test_daily_files_win_over_the_month_they_come_with(spark, history, tmp_path, landed):
    put(landed, "AUSD-1h-2024-01.zip", [line(T, volume="month"), line(T + 3600, volume="month")])
    put(landed, "AUSD-1h-2024-01-01.zip", [line(T, volume="day")])
    run(spark, history, tmp_path)
    assert stored(history) == {T: "day", T + 3600: "month"}


def test_files_that_land_too_far_apart_leave_the_state(spark, history, tmp_path, landed):
    for n in range(1, 10):
        name = f"AUSD-1h-2024-01-0{n}.zip"
        put(landed, name, [line(T + (n - 1) * DAY)])
        at(landed / name, T + n * DAY)
        at(landed / f"{name}.CHECKSUM", T + n * DAY + (3 * DAY if n == 4 else 3600))
    progress = run(spark, history, tmp_path, files=1, within="2 days")
    assert sorted(stored(history)) == [T + (n - 1) * DAY for n in range(1, 10) if n != 4]
    # A file of each kind a day: a few days of them stay in the state.
    assert max(s.numRowsTotal for p in progress for s in p.stateOperators) < 18


def test_hashes_without_content_wait(spark, tmp_path, landed):
    """What meets in the join, and so its state, has no content."""
    join = stream.verified(*stream.landing(spark, str(tmp_path / "landed")))._jdf.queryExecution().analyzed().child()
    sides = [[c.split("#")[0] for c in side.output().mkString(" ").split()] for side in (join.left(), join.right())]
    assert sides == [["path", "hash", "archive_landed"], ["of_path", "expected", "sum_landed"]]
