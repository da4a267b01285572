"""Live refresh: closed candles of a feed into the store as they come."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from candlewick import store
from candlewick.schema import LIVE
from candlewick.sources.live import closed, to_candles


def json_feed(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """Feed elements landed as JSON lines."""
    reader = spark.readStream.schema(LIVE)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(folder)


def kafka_feed(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Feed elements as JSON messages; the offset orders updates of a candle,
    which a feed keyed by series keeps in one partition. Needs Spark's Kafka package."""
    messages = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .options(**options)
        .load()
    )
    element = F.from_json(F.col("value").cast("string"), LIVE).alias("element")
    return messages.select(element, "offset").select("element.*", "offset").drop("seq").withColumnRenamed("offset", "seq")


def refresh(
    elements: DataFrame,
    root: str,
    checkpoint: str,
    merge_every: int = 0,
    order: str = "seq",
    feed: str = store.FEED,
    repeats: str | None = None,
    **trigger,
) -> StreamingQuery:
    """Append the closed candles of ``elements`` to the log of ``feed``, and merge
    the log into the table every ``merge_every`` batches (0: leave that to a job).

    Candles may come late, repeatedly or corrected: the last one by batch and
    ``order`` (a number per element) wins, and a replayed batch replaces itself.
    Batches are counted by the checkpoint: a new checkpoint needs a new feed name.

    With ``repeats`` (a time such as "1 hour") a candle delivered again, with the same ``order`` and values, within that time
    of its first delivery is left out before the log. The time is that of arrival, so candles of any age still pass, as
    does a correction.
    """
    spark = elements.sparkSession
    candles = to_candles(closed(elements.withColumn("seq", F.expr(f"coalesce({order}, 0L)"))), "seq")

    if repeats:
        arrived = candles.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", repeats)
        candles = arrived.dropDuplicatesWithinWatermark(candles.columns).drop("_arrived")

    def store_batch(batch: DataFrame, number: int) -> None:
        store.append_log(batch, root, number, feed)
        if merge_every and (number + 1) % merge_every == 0:
            store.merge_log(spark, root, number, feed)

    return (
        candles.writeStream.foreachBatch(store_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )
