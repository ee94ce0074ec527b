"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import posixpath

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession

from fraudmart.session import ensure_checkpoint_dir, scratch_path, ship_package

ARROW_ROWS = 256  # rows per Arrow batch: texts may be long, so batches stay small


def prepare(spark: SparkSession) -> None:
    """Session settings that the operators need (idempotent)."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: cuts the lineage and
    survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The Arrow filesystem of a URI or absolute path, and the path on it."""
    return pafs.FileSystem.from_uri(uri)


def join_path(*parts: str) -> str:
    return posixpath.join(*parts)
