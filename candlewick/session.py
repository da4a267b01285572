"""Session settings and the shared work folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "candlewick", **conf: str) -> SparkSession:
    """A session with UTC time and adaptive execution; ``conf`` adds to or replaces settings."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: what ``spark.checkpoint.dir`` names, else the context's checkpoint folder, else one
    in the warehouse, which executors share as well."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/candlewick-work"
    return folder.rstrip("/")


def new_dir(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def staged(rows: DataFrame, label: str) -> DataFrame:
    """``rows`` as a written table in the shared folder: worked out once, and the
    same rows however often a later task reads them."""
    folder = new_dir(rows.sparkSession, label)
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)
