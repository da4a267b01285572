"""Landed archives as a stream: each file is hashed once and loaded when its checksum is there, whichever of the two lands first."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from candlewick import store
from candlewick.schema import KLINE_COLUMNS
from candlewick.sources.archives import CHECKSUM, archive_candles, expected_sums

# Columns of Spark's binary file source.
_FILE = "path string, modificationTime timestamp, length long, content binary"

# An archive and its checksum land within this time of each other.
WITHIN = "7 days"
# Files of each kind that one batch takes up.
FILES = 1000


def landing(spark: SparkSession, folder: str, files: int = FILES) -> tuple[DataFrame, DataFrame]:
    """Streams of the archives (path, landed, content) and checksum files (path, landed, expected) below ``folder``, ``files`` of each a batch.

    A file is read once: one written anew under its old name isn't seen again.
    """

    def stream(pattern: str) -> DataFrame:
        reader = spark.readStream.format("binaryFile").schema(_FILE).option("recursiveFileLookup", "true")
        return reader.option("pathGlobFilter", pattern).option("maxFilesPerTrigger", files).load(folder)

    archives = stream("*.zip").selectExpr("path", "modificationTime as landed", "content")
    return archives, expected_sums(stream("*" + CHECKSUM), "modificationTime as landed")


def landed_contents(spark: SparkSession) -> Callable[[list[str]], DataFrame]:
    """Reads archives (file, content) by their paths."""

    def read(paths: list[str]) -> DataFrame:
        # Names, not patterns: marks that Spark's reader would expand are escaped.
        names = ["".join(f"\\{c}" if c in "\\*?[]{}" else c for c in path) for path in paths]
        return spark.read.format("binaryFile").load(names).selectExpr("element_at(split(path, '/'), -1) as file", "content")

    return read


def verified(archives: DataFrame, sums: DataFrame, within: str = WITHIN) -> DataFrame:
    """Paths of the archives whose SHA-256 is the expected one, as a stream.

    Archives (path, landed, content) and checksums (path, landed, expected) wait for each other as rows of a path and a hash, without
    content, until the watermark is ``within`` past them, so the state holds what landed in that time. Of the files that land further apart, and of those
    that come to the stream later than that, none is verified here; ``CandleHistory.load_archives`` finds them.
    """
    hashed = archives.selectExpr("path", "sha2(content, 256) as hash", "landed as archive_landed").withWatermark("archive_landed", within)
    known = sums.selectExpr("path as of_path", "expected", "landed as sum_landed").withWatermark("sum_landed", within)
    near = f"archive_landed between sum_landed - interval {within} and sum_landed + interval {within}"
    return hashed.join(known, F.expr(f"path = of_path and hash = expected and {near}")).select("path")


def load(
    archives: DataFrame,
    sums: DataFrame,
    contents: Callable[[list[str]], DataFrame],
    symbols: DataFrame,
    root: str,
    checkpoint: str,
    within: str = WITHIN,
    **trigger,
) -> StreamingQuery:
    """Merge the candles of archives into the table at ``root`` as they are verified.

    ``contents`` reads (file, content) of the paths of a batch, of which there are no more than files that came with it. Daily files win over
    monthly ones of their batch; between batches the later one wins. A batch run again after a failure merges the same candles.
    """
    spark = archives.sparkSession

    def merge(batch: DataFrame, number: int) -> None:
        paths = sorted({row.path for row in batch.collect()})
        if paths:
            candles = archive_candles(contents(paths), symbols).selectExpr(*KLINE_COLUMNS, "length(file) as detail", "file", "pos")
            store.upsert(spark, root, candles, ("detail", "file", "pos"))

    return (
        verified(archives, sums, within)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )
