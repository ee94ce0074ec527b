"""Streaming file ingestion: exactly-once staging of transactions, and daily runs.

A Structured Streaming file source with ``trigger(availableNow=True)`` reads
every file not recorded in its checkpoint, once, then stops: a crash between
loading and archiving cannot load a file twice, because the checkpoint — not
the file's location — records what was consumed.

``run_days_stream`` streams the names of all daily files. Files come in any order, so a
stage keyed by the day in their names stands before the daily job: arrivals are kept in
the warehouse, the three kinds of a day are joined, and days that are complete run in
the order of their dates, by the batch job itself (one parser; LAG is not allowed on a
streaming frame). The ledger says what was loaded, so a micro-batch that is replayed
after a crash changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudmart import schemas
from fraudmart.functions import file_date_from_name, source_name
from fraudmart.operators.enrich import DOCUMENTED
from fraudmart.plans.pipeline import run_pending, with_kind
from fraudmart.sources.delimited import header_names, read_options, typed
from fraudmart.sources.tables import Warehouse


def transactions_stream(spark: SparkSession, incoming: str, archive: str | None = None,
                        max_files: int | None = None) -> DataFrame:
    """``incoming`` is a folder or a glob such as ``.../transactions_*.txt``, with a file
    in it when the stream starts: its header gives the columns (a file with another header
    is an error). Values are typed as in the batch reader."""
    names = header_names(spark, incoming, schemas.TRANSACTIONS_FILE, read_options())
    text = T.StructType([T.StructField(c, T.StringType()) for c in names.values()])
    reader = spark.readStream.schema(text).options(**read_options(), enforceSchema=False)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    df = reader.csv(incoming)
    return (df.select(*typed(names, schemas.TRANSACTIONS_FILE), source_name(F.col("_metadata.file_path")).alias("file_name"))
              .withColumn("batch_dt", file_date_from_name("file_name")))


def ingest_available_now(spark: SparkSession, incoming: str, sink: str, checkpoint: str,
                         archive: str | None = None) -> None:
    """Append every new file under ``incoming`` to the Parquet ``sink``
    (partitioned by the batch day in the file name), then stop. ``archive``: Spark moves
    consumed files there when the next batch starts (keeping their path below it)."""
    q = (transactions_stream(spark, incoming, archive)
         .writeStream.format("parquet").option("checkpointLocation", checkpoint)
         .partitionBy("batch_dt").outputMode("append")
         .trigger(availableNow=True).start(sink))
    q.awaitTermination()


def run_days_stream(spark: SparkSession, wh: Warehouse, incoming: str, checkpoint: str, mode: str = DOCUMENTED,
                    report_dt=None, archive: str | None = None, max_files: int | None = None) -> None:
    """Take in every new file under ``incoming`` (of any kind, in any order), run the
    days that are complete, then stop. ``archive``: see ``run_pending``."""
    reader = (spark.readStream.format("binaryFile").option("pathGlobFilter", "*_[0-9][0-9][0-9][0-9][0-9][0-9][0-9][0-9].*")
              .schema("path string, modificationTime timestamp, length long, content binary"))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    q = (reader.load(incoming).select("path").writeStream.option("checkpointLocation", checkpoint)
         .foreachBatch(lambda batch, _: take_arrivals(spark, wh, batch, mode, report_dt, archive))
         .trigger(availableNow=True).start())
    q.awaitTermination()


def take_arrivals(spark: SparkSession, wh: Warehouse, paths: DataFrame, mode: str = DOCUMENTED, report_dt=None,
                  archive: str | None = None) -> list:
    """Keep new names (column ``path``), then run the days that they complete."""
    seen = wh.read("meta_arrivals")
    new = with_kind(paths).where("kind is not null").join(seen.select("file_name"), "file_name", "left_anti")
    wh.append("meta_arrivals", new.select("path", "file_name", "kind"))
    waiting = wh.read("meta_arrivals").join(wh.read("meta_ingest_log").select("file_name"), "file_name", "left_anti")
    return run_pending(spark, wh, None, mode, report_dt, archive, files=waiting)
