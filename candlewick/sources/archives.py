"""Candles out of checksum-verified archive files."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.functions.calendar import archive_seconds
from candlewick.schema import KLINE_COLUMNS, SPOT, UNCHECKED

CHECKSUM = ".CHECKSUM"

# Places of the fields in an archive line.
_FIELDS = {"open_time": 0, "open_price": 1, "high": 2, "low": 3, "close_price": 4, "volume": 5, "close_time": 6}

# Bytes of text handed back to Spark at a time.
_BLOCK = 1 << 20
# Checksums are broadcast up to so many, so that archives stay where they are read.
BROADCAST_ROWS = 1_000_000


def _blocks(content: bytes) -> Iterator[tuple[int, str]]:
    """The first member of an archive in blocks of whole lines, each with the number of its first line."""
    with zipfile.ZipFile(io.BytesIO(content)) as archive, archive.open(archive.infolist()[0]) as member:
        first, rest = 0, b""
        while part := member.read(_BLOCK):
            lines, end, rest = (rest + part).rpartition(b"\n")
            if end:
                yield first, lines.decode("utf-8")
                first += lines.count(b"\n") + 1
        if rest:
            yield first, rest.decode("utf-8")


def _unzip(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Blocks of all archives; small ones are handed back together."""
    rows, held = [], 0
    for batch in batches:
        for file, content in zip(batch["file"], batch["content"]):
            for first, text in _blocks(content):
                rows.append((file, first, text))
                held += len(text)
                if held >= _BLOCK:
                    yield pd.DataFrame(rows, columns=["file", "first", "text"])
                    rows, held = [], 0
    if rows:
        yield pd.DataFrame(rows, columns=["file", "first", "text"])


def expected_sums(files: DataFrame, *columns: str) -> DataFrame:
    """Checksum files as (path of the archive, ``columns``, expected)."""
    return files.selectExpr(
        f"regexp_replace(path, '{CHECKSUM.replace('.', '[.]')}$', '') as path",
        *columns,
        r"get(split(trim(decode(content, 'UTF-8')), '[ \t\r\n]+'), 0) as expected",
    )


def landed_files(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Archives (path, file, content) and checksum files (path, expected) below ``folder``."""

    def files(pattern: str) -> DataFrame:
        reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        return reader.option("pathGlobFilter", pattern).load(folder)

    archives = files("*.zip").selectExpr("path", "element_at(split(path, '/'), -1) as file", "content")
    return archives, expected_sums(files("*" + CHECKSUM))


def verified(archives: DataFrame, sums: DataFrame) -> DataFrame:
    """Archives whose SHA-256 is the expected one; without a checksum file none is.

    An archive is hashed where it is read and meets the checksum of the same
    path, so of two files of one name each has its own. Up to
    ``BROADCAST_ROWS`` checksums are sent to the archives; beyond that, archives
    are shuffled by path.
    """
    hashed = archives.withColumn("expected", F.sha2("content", 256))
    known = F.broadcast(sums) if sums.count() <= BROADCAST_ROWS else sums
    return hashed.join(known, ["path", "expected"], "left_semi").drop("expected")


def archive_candles(files: DataFrame, symbols: DataFrame, exchange: str = "binance") -> DataFrame:
    """Candles of verified archives.

    The file name ``SYMBOL-interval-YYYY-MM[-DD].zip`` gives the interval and
    the native symbol, which ``symbols`` (native_symbol, symbol; one row each)
    turns into the unified one. Files of unknown symbols keep the native name.
    """
    blocks = files.select("file", "content").mapInPandas(_unzip, "file string, first long, text string")
    lines = blocks.selectExpr("file", "first", r"posexplode(split(text, '\r?\n')) as (place, line)").selectExpr(
        "file", "first + place as pos", "line"
    )
    text = {c: f"trim(get(parts, {i}))" for c, i in _FIELDS.items()}
    times = ("open_time", "close_time")
    return (
        lines.selectExpr("file", "pos", "split(file, '-') as name", "split(line, ',') as parts")
        .selectExpr(
            "file",
            "pos",
            "get(name, 0) as native_symbol",
            "get(name, 1) as interval",
            *[f"try_cast({t} as bigint) as {c}" if c in times else f"{t} as {c}" for c, t in text.items()],
        )
        # Blank lines and a heading line, if a file has one, carry no time.
        .where("open_time is not null and close_time is not null")
        .join(symbols.selectExpr("native_symbol", "symbol as unified"), "native_symbol", "left")
        .selectExpr(
            "file",
            "pos",
            f"'{exchange}' as exchange",
            f"'{SPOT}' as trading_type",
            "coalesce(unified, native_symbol) as symbol",
            "interval",
            f"{archive_seconds('open_time')} as open_time",
            "open_price",
            f"{archive_seconds('close_time')} as close_time",
            "close_price",
            "low",
            "high",
            "volume",
            f"'{UNCHECKED}' as status",
        )
        .select("file", "pos", *KLINE_COLUMNS)
    )
