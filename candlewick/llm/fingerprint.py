"""Document fingerprints by consistent weighted sampling, in DataFrame expressions only.

A term is a run of characters other than white space, its weight the number of times it occurs. For each of ``SAMPLES``
samples a term draws, from hashes of term and sample, r and c from Gamma(2, 1) and b from the unit interval; with
t = floor(ln(weight) / r + b), the term with the least c / exp(r (t - b) + r) is the sample, its signature a hash of term,
sample and t. Two documents agree in a sample with probability sum(min) / sum(max) of their weights, the generalised
Jaccard similarity, so the share of equal samples estimates it.

Signatures have 32 bits; a fingerprint is their hexadecimal text. A text without terms (null, empty or white space) has
the fingerprint ``ff...f``, so two of them are alike by 1.0 and others by 0.0. Repeated and null ids are kept, ordered
by id (null first) and text. Other columns of the input are not looked at, an empty table gives an empty result.

Neighbours in id order are found without a global sort: ids are cut into ranges of about ``RANGE_ROWS`` rows by
approximate percentiles, the first rows of a range are also sent to the range before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLES = 32
RANGE_ROWS, MAX_RANGES = 1024, 8192
_UNIT = 2.0**-25


def terms(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda t: t != "")


def _low(bits: Column, start: int, width: int) -> Column:
    return F.shiftrightunsigned(bits, start).bitwiseAND(F.lit((1 << width) - 1)) if start else bits.bitwiseAND(F.lit((1 << width) - 1))


def _unit(bits: Column) -> Column:
    return (bits.cast("double") + 0.5) * _UNIT


def _sample(term: str, log_weight: str, k: int) -> Column:
    """Value to minimise in the upper half of a long (31 bits of its logarithm), signature in the lower."""
    one, two = F.xxhash64(F.col(term), F.lit(2 * k)), F.xxhash64(F.col(term), F.lit(2 * k + 1))
    r = -F.ln(_unit(_low(one, 0, 25)) * _unit(_low(one, 25, 25)))
    log_c = F.ln(-F.ln(_unit(_low(two, 0, 25)) * _unit(_low(two, 25, 25))))
    b = (_low(one, 50, 14).cast("double") * 16384.0 + _low(two, 50, 14).cast("double") + 0.5) * 2.0**-28
    t = F.floor(F.col(log_weight) / r + b)
    value = log_c - r * (t - b + 1.0)
    rank = F.least(F.greatest((value + 96.0) * 2.0**24, F.lit(0.0)), F.lit(2.0**31 - 1)).cast("long")
    mark = one.bitwiseXOR(t * F.lit(2654435761)).bitwiseAND(F.lit(0xFFFFFFFF))
    return F.call_function("shiftleft", rank, F.lit(32)).bitwiseOR(mark)


def signatures(rows: DataFrame, keys: list[str], texts: dict[str, str], samples: int = SAMPLES) -> DataFrame:
    """``keys`` and, under each name in ``texts``, an array of ``samples`` numbers for the text column it stands for.

    A term that several texts of a row hold is one row, and draws once for all of them. If ``rows`` is dealt by some of the
    keys, nothing is shuffled.
    """
    kinds = range(len(texts))
    weights = [F.count_if(F.col("kind") == i).cast("double") for i in kinds]
    counted = (
        rows.select(*keys, F.posexplode(F.array(*texts.values())).alias("kind", "text"))
        .select(*keys, "kind", F.explode_outer(terms(F.col("text"))).alias("term"))
        .select(*keys, "kind", F.when(F.col("term").isNotNull(), F.xxhash64("term")).alias("term"))
        .groupBy(*keys, "term")
        # No weight where a text doesn't hold the term: its sample is null then, and the least leaves it out.
        .agg(*(F.when(F.col("term").isNotNull() & (w > 0), F.ln(w)).alias(f"w{i}") for i, w in enumerate(weights)))
    )
    least = counted.groupBy(*keys).agg(*(F.min(_sample("term", f"w{i}", k)).alias(f"s{i}_{k}") for k in range(samples) for i in kinds))

    def marks(i: int) -> Column:
        return F.array(*(F.coalesce(F.col(f"s{i}_{k}").bitwiseAND(F.lit(0xFFFFFFFF)), F.lit(0xFFFFFFFF)) for k in range(samples)))

    return least.select(*keys, *(marks(i).alias(name) for i, name in enumerate(texts)))


def as_text(signature: Column) -> Column:
    return F.array_join(F.transform(signature, lambda s: F.lpad(F.lower(F.hex(s)), 8, "0")), "")


def likeness(a: Column, b: Column, samples: int = SAMPLES) -> Column:
    """Share of equal samples."""
    same = F.filter(F.arrays_zip(a.alias("a"), b.alias("b")), lambda p: p["a"] == p["b"])
    return F.size(same) / F.lit(float(samples))


def _ranged(docs: DataFrame) -> DataFrame:
    """doc_id, text, part (a range of ids) and last (0, or 1 for the row that follows the part)."""
    n = docs.count()
    ids = docs.select(F.coalesce("doc_id", F.lit(-(2**63))).alias("at"))
    parts = max(1, min(MAX_RANGES, n // RANGE_ROWS))
    marks = ids.agg(F.percentile_approx("at", [i / parts for i in range(1, parts)] or [0.5], 20_000)).first()[0] or []
    marks = sorted(set(marks)) if parts > 1 else []
    steps = [1 << i for i in reversed(range(len(marks).bit_length()))]
    bounds = F.array(*map(F.lit, marks)) if marks else None

    def part(at: Column) -> Column:
        if bounds is None:
            return F.lit(0)
        return F.aggregate(
            F.array(*map(F.lit, steps)),
            F.lit(0),
            lambda low, step: F.when((low + step <= len(marks)) & (F.try_element_at(bounds, low + step) <= at), low + step).otherwise(low),
        )

    firsts = ids.withColumn("part", part(F.col("at"))).groupBy("part").agg(F.min("at").alias("at"))
    order = Window.orderBy("part")  # a row for each range, MAX_RANGES at most
    every = Window.partitionBy(F.lit(0))
    heads = firsts.select("at", F.coalesce(F.lag("part").over(order), F.max("part").over(every)).alias("before"))
    placed = (
        docs.select("doc_id", "text", F.coalesce("doc_id", F.lit(-(2**63))).alias("at"))
        .withColumn("part", part(F.col("at")))
        .join(F.broadcast(heads), "at", "left")
    )
    own, extra = F.struct("part", F.lit(0).alias("last")), F.struct(F.col("before").alias("part"), F.lit(1).alias("last"))
    copies = F.when(F.col("before").isNull(), F.array(own)).otherwise(F.array(own, extra))
    return placed.select("doc_id", "text", F.explode(copies).alias("p")).select("doc_id", "text", "p.part", "p.last")


def edited(docs: DataFrame) -> DataFrame:
    """Each text (null: empty) and its edited text: the last quarter replaced by the beginning of the next document.

    ``part`` and ``n`` name a row; rows with ``last`` = 1 only stand for the next document of their part.
    """
    order = Window.partitionBy("part").orderBy("last", F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), "text")
    rows = _ranged(docs).withColumn("text", F.coalesce("text", F.lit("")))
    rows = rows.select("*", F.row_number().over(order).alias("n"), F.coalesce(F.lead("text").over(order), F.lit("")).alias("next"))
    quarter = F.floor(F.length("text") / 4).cast("int")
    return rows.select(
        "part",
        "n",
        "last",
        "doc_id",
        "text",
        F.concat(F.substring("text", F.lit(1), F.length("text") - quarter), F.substring("next", F.lit(1), quarter)).alias("edited"),
    )


def fingerprints(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """Fingerprint of every text and of its edited text, and the likeness of the first to both the second and the next document's.

    A single document is its own next one.
    """
    rows = edited(docs)
    signed = signatures(rows, ["part", "n"], {"signature": "text", "edited_signature": "edited"}, samples)
    order = Window.partitionBy("part").orderBy("n")
    signed = signed.select("*", F.lead("signature").over(order).alias("next_signature"))
    facts = rows.where("last = 0").select(
        "part", "n", "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256")
    )
    return facts.join(signed, ["part", "n"]).select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(F.col("signature")).alias("fingerprint"),
        as_text(F.col("edited_signature")).alias("edited_fingerprint"),
        likeness(F.col("signature"), F.col("edited_signature"), samples).alias("near_edited"),
        likeness(F.col("signature"), F.col("next_signature"), samples).alias("near_next"),
    )
