"""The candle table: one Parquet table for all series.

Layout under a root folder::

    klines/exchange=/interval=/part=/bucket=/   the table, files sorted by symbol and time
    extents/exchange=/interval=/part=/bucket=/  first and last times and counts of each series in that folder
    status/batch=N/                             changed statuses not folded into the table yet
    log/<feed>/folder=/batch=N/                 candles of live batches
    held/<feed>/batch=N/                        candles held back when batch N was merged
    merged/<feed>/batch=N/                      how far the log has been merged
    meta/                                       metadata of series
    writing, pending/                           of the write under way

Symbols are dealt to ``BUCKETS`` folders, so an upsert rewrites, and a read of one symbol lists, one in so many of them.

A status is written without its candle: changes are appended to ``status`` by key, and ``scan`` puts the last one in the place of the
stored one. ``fold_status`` moves them into the table now and then; until then a read joins the candles it asks for with
their changes, after that with none. Extents are written with their folder, from its own rows; ``profile`` adds them up and
reads candles of those series only that have changed statuses in a folder.

A write of the table holds ``writing``, from before it reads what it merges with until its folders are in place, so two
writers can't lose each other's candles; the second one fails. The new folders are written below ``pending`` first.
``pending/READY`` makes them valid; from then on they are moved into place one by one, and what a crash leaves undone
``recover`` does. Before that marker the table hasn't been touched.
"""

from __future__ import annotations

import time
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from candlewick.files import Files
from candlewick.functions.calendar import part_of
from candlewick.functions.text import meta_key
from candlewick.operators.merge import last_wins, merge_klines, merge_meta, merge_status
from candlewick.operators.profile import extents, together
from candlewick.schema import EXTENT, EXTENT_FIGURES, KEY, KLINE, KLINE_COLUMNS, META, META_KEY, PARTITION, SERIES, STATUS, STORED
from candlewick.session import staged
from candlewick.sources.live import without_tail

HELD_SCHEMA = "seq long, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in KLINE)
LOG_SCHEMA = "batch long, " + HELD_SCHEMA


# Folders that the symbols of an exchange, interval and part are dealt to.
BUCKETS = 16
_BUCKET = f"cast(pmod(xxhash64(symbol), {BUCKETS}) as int)"


def klines_path(root: str) -> str:
    return f"{root}/klines"


def _extents_path(root: str) -> str:
    return f"{root}/extents"


def create(spark: SparkSession, root: str, table: str | None = None) -> None:
    """Make an empty store; ``table`` also registers the candles in the catalog, with the statuses folded so far."""
    spark.createDataFrame([], STORED).write.mode("ignore").partitionBy(*PARTITION).parquet(klines_path(root))
    spark.createDataFrame([], EXTENT).write.mode("ignore").partitionBy(*PARTITION).parquet(_extents_path(root))
    if table:
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in STORED)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet "
            f"PARTITIONED BY ({', '.join(PARTITION)}) LOCATION '{klines_path(root)}'"
        )


def scan(
    spark: SparkSession,
    root: str,
    exchange: str | None = None,
    symbol: str | None = None,
    interval: str | None = None,
    trading_type: str | None = None,
) -> DataFrame:
    """Stored candles with ``part`` and ``bucket``, and their last statuses; exchange, interval and the symbol's bucket prune
    folders, the symbol skips row groups."""
    wanted = {"exchange": exchange, "interval": interval, "symbol": symbol, "trading_type": trading_type}
    candles = _of_series(_in_folders(spark, root), wanted)
    changes = status_changes(spark, root)
    return candles if changes is None else _with_status(candles, _of_series(changes, wanted))


def _of_series(rows: DataFrame, wanted: dict[str, str | None]) -> DataFrame:
    for name, value in wanted.items():
        if value is not None:
            rows = rows.where(F.col(name) == value)
            if name == "symbol" and "bucket" in rows.columns:
                rows = rows.where(F.col("bucket") == F.expr(_BUCKET.replace("symbol", repr(value))))
    return rows


def _in_folders(spark: SparkSession, root: str) -> DataFrame:
    """Candles as the folders have them, without the statuses not folded yet."""
    return spark.read.schema(STORED).parquet(klines_path(root))


def _with_status(candles: DataFrame, changes: DataFrame) -> DataFrame:
    last = last_wins(changes, ["batch"]).select(*KEY, F.struct("status").alias("_changed"))
    status = F.expr("if(_changed is null, status, _changed.status)").alias("status")
    return candles.join(last, [*KEY], "left").select(*[status if c == "status" else c for c in candles.columns])


# Folder, then sort order within files. The rest of the candle key follows the
# columns that rows are placed by, so grouping by it needs no further shuffle.
ORDER = (*PARTITION, "symbol", "open_time")
STORED_KEY = (*ORDER, "trading_type")


def with_part(rows: DataFrame) -> DataFrame:
    return rows.drop("part", "bucket").selectExpr("*", f"{part_of('interval', 'open_time')} as part", f"{_BUCKET} as bucket")


def placed(rows: DataFrame, partitions: int | None = None) -> DataFrame:
    """Rows cut into tasks by ranges of the sort order.

    Ranges follow the data, so a folder that holds much of the table is spread
    over many tasks, a task writes into few folders, and every file covers
    few symbols. All rows of a candle key come together.
    """
    return rows.repartitionByRange(partitions, *ORDER) if partitions else rows.repartitionByRange(*ORDER)


class BusyError(RuntimeError):
    """Another write of the table is under way, or was when it crashed."""


@contextmanager
def writing(spark: SparkSession, root: str) -> Iterator[None]:
    """Hold the table of ``root`` for one write. A write that fails before its folders are valid leaves nothing behind;
    one that fails later leaves the table held, for ``recover`` to finish."""
    files = Files(spark, root)
    if not files.claim("writing"):
        raise BusyError(f"{root} is being written; if that write has crashed, run recover")
    try:
        yield
    finally:
        if not files.exists("pending/READY"):
            files.delete("pending")
            files.delete("writing")


def recover(spark: SparkSession, root: str) -> None:
    """Finish or undo the write of a writer that is gone."""
    files = Files(spark, root)
    if files.exists("pending/READY"):
        _publish(files)
    files.delete("pending")
    files.delete("writing")


def _publish(files: Files) -> None:
    """Move the valid folders into place. Folders moved before are no longer there, so it can be done again."""
    for table in ("klines", "extents"):
        for folder in files.folders(f"pending/{table}", len(PARTITION)):
            files.move(folder, folder.removeprefix("pending/"))
    if files.exists("pending/meta"):
        files.move("pending/meta", "meta")
    files.delete("pending/READY")


def _write(candles: DataFrame, root: str) -> None:
    """Replace the folders the placed candles fall in, leave the others. The caller holds the table.

    A candle that closes before it opens fails the write.
    """
    files = Files(candles.sparkSession, root)
    files.delete("pending")
    (
        candles.where("assert_true(close_time >= open_time, 'a candle closes before it opens') is null")
        .sortWithinPartitions(*ORDER)
        .write.partitionBy(*PARTITION)
        .parquet(klines_path(f"{root}/pending"))
    )
    written = extents(_in_folders(candles.sparkSession, f"{root}/pending"), [*SERIES, *(c for c in PARTITION if c not in SERIES)])
    written.repartition(*PARTITION).write.partitionBy(*PARTITION).parquet(_extents_path(f"{root}/pending"))
    files.claim("pending/READY")
    _publish(files)


def touched(rows: DataFrame) -> str:
    """Condition for the stored folders that ``rows`` fall in.

    Collects the folder numbers: exchanges x intervals x months x buckets.
    """
    # First down to a row per day and bucket, then to folders.
    days = rows.selectExpr("exchange", "interval", f"{_BUCKET} as bucket", "floor(open_time / 86400) * 86400 as open_time").distinct()
    places = days.selectExpr("exchange", "interval", f"{part_of('interval', 'open_time')} * {BUCKETS} + bucket as place")
    folders = places.groupBy("exchange", "interval").agg(F.expr("collect_set(place) as places")).collect()
    conditions = [
        f"(exchange = {f.exchange!r} and interval = {f.interval!r} and part * {BUCKETS} + bucket in ({', '.join(map(str, f.places))}))"
        for f in folders
    ]
    return " or ".join(conditions) or "false"


def upsert(
    spark: SparkSession,
    root: str,
    incoming: DataFrame,
    order: Sequence[str] = (),
    partitions: int | None = None,
) -> None:
    """Merge candles into the table, rewriting only the folders they fall in.

    ``order`` columns rank candles of the same key, the last one wins; without
    it a key that comes twice fails the write. The folders are replaced when all tasks are
    done, one after the other; readers that need all at once use ``snapshot``.
    While another write is under way it fails with ``BusyError``.
    ``partitions`` is the number of write tasks, by default the session's
    number of shuffle partitions.
    """
    rows = staged(last_wins(incoming, order) if order else incoming.select(*KLINE_COLUMNS), "incoming")
    with writing(spark, root):
        _write(_merged(_in_folders(spark, root).where(touched(rows)), rows, partitions), root)


def _merged(stored: DataFrame, rows: DataFrame, partitions: int | None) -> DataFrame:
    """One shuffle merges the rows and lays them out for the write."""
    return merge_klines(stored, with_part(rows), STORED_KEY, lambda both: placed(both, partitions))


def snapshot(
    spark: SparkSession,
    root: str,
    incoming: DataFrame,
    target: str,
    order: Sequence[str] = (),
    partitions: int | None = None,
) -> None:
    """As ``upsert``, but write the whole merged table to a new root."""
    rows = staged(last_wins(incoming, order) if order else incoming.select(*KLINE_COLUMNS), "incoming")
    with writing(spark, target):
        _write(_merged(scan(spark, root), rows, partitions), target)


def write_status(spark: SparkSession, root: str, changes: DataFrame) -> None:
    """Set the status of the keys in ``changes`` (unique by key): appends them, no candle is read or written.

    A status of a key that isn't stored does nothing. Of several changes of a key the last by the writer's clock counts.
    """
    rows = changes.select(*KEY, "status").repartitionByRange(*KEY).sortWithinPartitions(*KEY)
    rows.write.parquet(f"{root}/status/batch={time.time_ns()}")


def _status_batches(spark: SparkSession, root: str) -> list[str]:
    return sorted(Files(spark, root).folders("status", 1))


def status_changes(spark: SparkSession, root: str) -> DataFrame | None:
    """Statuses not folded yet, with the ``batch`` they came in; None if there is none."""
    return _read_status(spark, root, _status_batches(spark, root))


def _read_status(spark: SparkSession, root: str, batches: list[str]) -> DataFrame | None:
    if not batches:
        return None
    return spark.read.schema(STATUS).option("basePath", f"{root}/status").parquet(*[f"{root}/{name}" for name in batches])


def fold_status(spark: SparkSession, root: str, partitions: int | None = None) -> None:
    """Move the changed statuses into the table; folders without a change stay untouched. What is appended meanwhile waits for
    the next time, and after a crash the same fold gives the same table."""
    batches = _status_batches(spark, root)
    changes = _read_status(spark, root, batches)
    if changes is None:
        return
    rows = staged(last_wins(changes, ["batch"]), "changes")
    with writing(spark, root):
        stored = _in_folders(spark, root).where(touched(rows))
        _write(merge_status(stored, with_part(rows), STORED_KEY, lambda both: placed(both, partitions)), root)
    for name in batches:
        Files(spark, root).delete(name)


def series_extents(spark: SparkSession, root: str, requests: DataFrame | None = None) -> DataFrame:
    """Figures of every (requested) series in each folder; see ``profile``."""

    def asked(rows: DataFrame) -> DataFrame:
        if requests is None:
            return rows
        # Exchanges x intervals, 84 rows at most; other folders aren't read.
        pairs = requests.select("exchange", "interval").dropna().distinct().collect()
        inside = " or ".join(f"(exchange = {p.exchange!r} and interval = {p.interval!r})" for p in pairs) or "false"
        return rows.where(inside).join(requests.select(*SERIES).distinct(), [*SERIES], "left_semi")

    group = [*SERIES, *(c for c in PARTITION if c not in SERIES)]
    kept = asked(spark.read.schema(EXTENT).parquet(_extents_path(root))).select(*group, *EXTENT_FIGURES)
    changes = status_changes(spark, root)
    if changes is None:
        return kept
    changed = with_part(asked(changes)).select(*group).distinct()
    rows = _in_folders(spark, root).join(changed, group, "left_semi")
    return kept.join(changed, group, "left_anti").unionByName(extents(_with_status(rows, asked(changes)), group))


def profile(spark: SparkSession, root: str, requests: DataFrame | None = None) -> DataFrame:
    """``series_profile`` of the table out of the kept extents. Only of series with changed statuses candles are read."""
    return together(series_extents(spark, root, requests))


# Live batches are appended to a log and merged in bulk, so that a few new
# candles do not rewrite a month of all symbols. Each feed (one streaming query
# with one checkpoint) has a log of its own: its batches are counted from 0.

FEED = "live"
# Log batches per log folder, so that a read lists recent folders only.
LOG_FOLDER = 1000


def _log_path(root: str, feed: str, folder: int) -> str:
    return f"{root}/log/{feed}/folder={folder}"


def append_log(candles: DataFrame, root: str, batch: int, feed: str = FEED) -> None:
    """Write the candles (with ``seq``) of one live batch; a replayed batch replaces itself."""
    path = f"{_log_path(root, feed, batch // LOG_FOLDER)}/batch={batch}"
    candles.select("seq", *KLINE_COLUMNS).write.mode("overwrite").parquet(path)


def _found(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame | None:
    """A dataset, None if it is not there."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _read(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    found = _found(spark, path, schema)
    return spark.createDataFrame([], schema) if found is None else found


def merged_upto(spark: SparkSession, root: str, feed: str = FEED) -> int:
    """The last log batch that is in the table, -1 if none is."""
    found = _read(spark, f"{root}/merged/{feed}", "upto long").agg(F.expr("max(upto)")).first()[0]
    return -1 if found is None else found


def logged_upto(spark: SparkSession, root: str, feed: str = FEED) -> int:
    """The last batch in the log of a feed, or the last merged one if there is none after it."""
    last = merged_upto(spark, root, feed)
    names = [folder.rpartition("=")[2] for folder in Files(spark, root).folders(f"log/{feed}", 2)]
    return max([last, *map(int, names)])


def pending(spark: SparkSession, root: str, upto: int | None = None, feed: str = FEED) -> DataFrame:
    """Latest candle per key of the log batches not merged yet, and of those held back."""
    done = merged_upto(spark, root, feed)
    rows = _read(spark, f"{root}/held/{feed}/batch={done}", HELD_SCHEMA).selectExpr(f"{done}L as batch", "*")
    folder = max(done + 1, 0) // LOG_FOLDER
    while (log := _found(spark, _log_path(root, feed, folder), LOG_SCHEMA)) is not None:
        last = "" if upto is None else f" and batch <= {upto}"
        rows = rows.unionByName(log.where(f"batch > {done}{last}"))
        folder += 1
    return last_wins(rows, ["batch", "seq"])


def merge_log(
    spark: SparkSession, root: str, upto: int, feed: str = FEED, partitions: int | None = None
) -> None:
    """Merge the log of a feed up to and including batch ``upto`` into the table.

    On exchanges whose feed has no closed flag the newest candle of a series
    may still change; it is held back until a newer one arrives. Run again
    after a failure, the merge gives the same table. Feeds may merge at the
    same time if they do not share folders, say if each has its own exchange.

    What the merge before this one made superfluous is deleted, so log, held candles and marks stay as large as two merges
    make them; who began to read the log before this merge still finds it.
    """
    if upto <= merged_upto(spark, root, feed):
        return
    rows = staged(pending(spark, root, upto, feed), "pending")
    final = without_tail(rows)
    held = rows.join(final, [*KEY], "left_anti")
    held.selectExpr("-1L as seq", *KLINE_COLUMNS).write.mode("overwrite").parquet(f"{root}/held/{feed}/batch={upto}")
    upsert(spark, root, final, partitions=partitions)
    spark.createDataFrame([(upto,)], "upto long").write.mode("overwrite").parquet(f"{root}/merged/{feed}/batch={upto}")
    expire_log(spark, root, feed)


def _numbered(folders: Iterator[str]) -> list[tuple[int, str]]:
    return sorted((int(name.rpartition("=")[2]), name) for name in folders)


def expire_log(spark: SparkSession, root: str, feed: str = FEED) -> None:
    """Delete batches, held candles and marks that neither the last merge of a feed nor the one before it needs."""
    files = Files(spark, root)
    marks = _numbered(files.folders(f"merged/{feed}", 1))
    if len(marks) < 2:
        return
    before = marks[-2][0]
    for number, name in _numbered(files.folders(f"log/{feed}", 1)):
        if (number + 1) * LOG_FOLDER <= before + 1:
            files.delete(name)
        elif number * LOG_FOLDER <= before:
            for batch, inner in _numbered(files.folders(name, 1)):
                if batch <= before:
                    files.delete(inner)
    for batch, name in [*_numbered(files.folders(f"held/{feed}", 1)), *marks]:
        if batch < before:
            files.delete(name)


def current(spark: SparkSession, root: str, feed: str = FEED, **series: str) -> DataFrame:
    """The table as it will be once the log of a feed is merged; ``series`` as in ``scan``."""
    waiting = without_tail(pending(spark, root, feed=feed))
    for name, value in series.items():
        waiting = waiting.where(F.col(name) == value)
    stored, inside = scan(spark, root, **series), touched(waiting)
    # Folders without a new candle take no part in the merge.
    outside = stored.where(f"not ({inside})").select(*KLINE_COLUMNS)
    return merge_klines(stored.where(inside), waiting).unionByName(outside)


# Metadata: one row per series and kind, a few columns.


def meta(spark: SparkSession, root: str) -> DataFrame:
    return with_meta_key(_read(spark, f"{root}/meta", META))


def with_meta_key(rows: DataFrame) -> DataFrame:
    return rows.selectExpr("*", f"{meta_key()} as key_sha256_hash")


def upsert_meta(spark: SparkSession, root: str, incoming: DataFrame) -> None:
    """Merge metadata rows (unique by key), as one write of the table."""
    files = Files(spark, root)
    with writing(spark, root):
        files.delete("pending")
        merge_meta(meta(spark, root), incoming).select(*META_KEY, "data").write.parquet(f"{root}/pending/meta")
        files.claim("pending/READY")
        _publish(files)


def lookup_meta(requests: DataFrame, stored: DataFrame) -> DataFrame:
    """Metadata of the requested (series, cache_type), null where there is none."""
    return requests.join(stored.select(*META_KEY, "data"), [*META_KEY], "left")

