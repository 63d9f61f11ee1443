"""Durable intermediate tables in the cluster's shared folder."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables, as named by ``spark.checkpoint.dir``.

    A session that lacks that setting gets a folder below its warehouse, which Spark's tables share as well.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    return re.sub("^file:/(?=[^/])", "file:///", warehouse) + "/textpack-scratch"


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/textpack-{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, keeps column pruning.

    Unlike an in-memory cache the result survives the loss of any executor, and later readers
    scan only the columns they need.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize_by(df: DataFrame, name: str, keys: list[str]) -> DataFrame:
    """Write ``df`` as a table in buckets of its keys, one file a bucket, and read it back.

    A join on the keys then needs no shuffle of this side. Deal the rows by ``dealt`` before what makes them wide.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    table = f"textpack_{uuid.uuid4().hex}"
    (df.write.option("path", path).option("compression", "zstd").bucketBy(buckets(spark), *keys).sortBy(*keys)
     .saveAsTable(table))
    return spark.table(table)


def buckets(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def dealt(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows dealt as ``materialize_by`` buckets them, so that each of its tasks writes one file."""
    return df.repartition(buckets(df.sparkSession), *keys)
