"""Token counts kept by deltas: additive totals by source, language and tokenizer version.

Counts are never recomputed over the corpus. A batch of changes is signed rows: +1 document and its tokens for an insert,
-1 and its tokens for a delete, both for a revised count. ``commit`` adds a batch up by key and writes one small table,
named by the batch; Spark's success marker, the last thing a write leaves, commits it. A batch that has the marker is not
written again, so a repeated commit changes nothing, and what a failed one left behind is overwritten. Totals are the
sum of the last base and of the batches that aren't part of it; ``fold`` writes a new base and leaves the old files, so
readers never miss one.

Adding up is partial in each task before the shuffle, so a source that holds most rows is a handful of rows by then.

Nulls: a null text has no tokens; a null source or language is a group of its own; a null tokenizer version too. Null
numbers count as 0. Repeated rows are counted each time. Without batches, or with empty ones, there are no totals; keys whose documents
and tokens are both 0 have no row. Other columns are not looked at.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEYS = ["source", "lang", "tokenizer"]
_DELTA = "source string, lang string, tokenizer string, documents long, tokens long"

#: What one token is in each version of the word tokenizer.
VERSIONS = {"words-1": r"[^\x20\x09-\x0D]+", "words-2": r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"}


def count(text: Column, version: str) -> Column:
    """Tokens of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(VERSIONS[version])), F.lit(0)).cast("long")


def signed(counts: DataFrame, sign: int, version: str, tokens: str) -> DataFrame:
    """Changes that insert (+1) or delete (-1) the rows of ``counts``, with ``tokens`` tokens under ``version``."""
    number = F.coalesce(F.col(tokens), F.lit(0)).cast("long") * sign
    return counts.select("source", "lang", F.lit(version).alias("tokenizer"), F.lit(sign).cast("long").alias("documents"), number.alias("tokens"))


def revised(counts: DataFrame, version: str, old: str, new: str) -> DataFrame:
    """Changes that replace the count ``old`` by ``new``."""
    return signed(counts, -1, version, old).unionByName(signed(counts, 1, version, new))


class TokenCounts:
    """The totals below one folder."""

    def __init__(self, spark, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")
        path = spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        self._files = path.getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")

    def _committed(self, kind: str) -> list[str]:
        if not self._files.exists(self._path(kind)):
            return []
        names = [s.getPath().getName() for s in self._files.listStatus(self._path(kind))]
        return sorted(n for n in names if self._files.exists(self._path(f"{kind}/{n}/_SUCCESS")))

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Write a batch of changes; False if it is there already."""
        if not batch or "/" in batch or batch[0] in "._":
            raise ValueError(f"not a batch name: {batch!r}")
        if batch in self._committed("batches") or batch in self._folded(self._base()):
            return False
        self._summed(changes).coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/batches/{batch}")
        return True

    @staticmethod
    def _summed(changes: DataFrame) -> DataFrame:
        sums = [F.sum(F.coalesce(F.col(c), F.lit(0))).cast("long").alias(c) for c in ("documents", "tokens")]
        return changes.groupBy(*KEYS).agg(*sums)

    def _base(self) -> str | None:
        """The last base; names sort in the order of folding."""
        return next(reversed(self._committed("bases")), None)

    def _folded(self, base: str | None) -> set[str]:
        """The batches that are in a base."""
        if base is None:
            return set()
        return {r[0] for r in self.spark.read.schema("batch string").parquet(f"{self.folder}/folded/{base}").collect()}

    def _added(self, base: str | None, batches: list[str]) -> DataFrame:
        """The totals of a base and of batches that aren't in it."""
        paths = [f"{self.folder}/batches/{b}" for b in batches] + ([f"{self.folder}/bases/{base}"] if base else [])
        rows = self.spark.read.schema(_DELTA).parquet(*paths) if paths else self.spark.createDataFrame([], _DELTA)
        return self._summed(rows).where("documents != 0 or tokens != 0")

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, documents and tokens."""
        base = self._base()
        folded = self._folded(base)
        return self._added(base, [b for b in self._committed("batches") if b not in folded])

    def fold(self) -> None:
        """Put all committed batches into a new base. Names of batches are kept with it, so that none counts twice: the base is made of
        the batches named, and one committed meanwhile is left for the next."""
        last = self._base()
        folded = self._folded(last)
        fresh = [b for b in self._committed("batches") if b not in folded]
        name = f"{int(last.split('-')[0]) + 1 if last else 0:08d}-{uuid.uuid4().hex[:8]}"
        self.spark.createDataFrame([(n,) for n in sorted(folded.union(fresh))], "batch string").coalesce(1).write.parquet(f"{self.folder}/folded/{name}")
        self._added(last, fresh).coalesce(1).write.parquet(f"{self.folder}/bases/{name}")
