"""Warehouse tables as Parquet folders under one root (a shared filesystem).

A table is a set of parts, ``<table>/seg=<id>[/<partition>=<value>]``; which parts are
live is told by an append-only list of commits (``_commits``), one small file each.
Data files are written first, the commit last, so what a commit changes, in however
many tables, becomes visible at once, and a failure before it leaves the old state:

* ``read``: the live parts, or an empty frame of the table's schema on the first run;
* ``append``: one more segment (facts partitioned by day);
* ``overwrite_days``: the parts of these days give way to the new ones;
* ``replace_from``: the parts of a day and later give way (dimension histories, which
  are partitioned by the day on which a version was closed, so closed ones stay);
* ``rewrite``: all parts give way;
* ``transaction``: all of these inside it are one commit (and see each other before).

One writer at a time: a second one that publishes the same commit number fails. Folders
that no commit names any more are removed by ``vacuum``, not by the writers, so readers
of an older state are not disturbed.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from fraudmart import schemas
from fraudmart.operators.load import numbered

FACT = "dwh_fact_transactions"
#: Partition column of a table (a date), if it has one.
PARTITIONS = {FACT: "trans_dt", "rep_fraud": "batch_dt",
              **{f"{t}_hist": "closed_dt" for t in schemas.WAREHOUSE if t.startswith("dwh_dim_")}}
_COMMITS = T.StructType([T.StructField("commit", T.LongType()), T.StructField("pos", T.LongType()),
                         T.StructField("action", T.StringType()), T.StructField("table", T.StringType()),
                         T.StructField("seg", T.StringType()), T.StructField("part", T.StringType()),
                         T.StructField("made_at", T.TimestampNTZType())])
Part = tuple[str, str]  # segment, partition folder ("" if the table has none)


# ------------------------------------------------------------------ files
def _fs(spark: SparkSession, path: str):
    """Hadoop's filesystem of a path, and the path (listing, moving, removing)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder (none if it does not exist)."""
    fs, p = _fs(spark, path)
    return sorted(x.getPath().getName() for x in fs.listStatus(p) if x.isDirectory()) if fs.exists(p) else []


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files in a folder (none if it does not exist)."""
    fs, p = _fs(spark, path)
    return sorted(x.getPath().getName() for x in fs.listStatus(p) if x.isFile()) if fs.exists(p) else []


def move_file(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file, in place of an earlier one of that name; nothing if it is gone."""
    fs, p = _fs(spark, source)
    q = _fs(spark, target)[1]
    if fs.exists(p):
        fs.mkdirs(q.getParent())
        fs.delete(q, True)
        if not fs.rename(p, q):
            raise OSError(f"{source} could not be moved to {target}")


class Warehouse:
    """Parquet tables under ``root``.

    ``fact_buckets`` keeps the transaction fact as a catalog table bucketed by
    ``trans_id`` (and partitioned by segment and day): the daily insert-new check then
    reads the fact already hash-partitioned on the key and only the day's keys are
    shuffled, however large the warehouse grows. ``True`` uses the session's
    ``spark.sql.shuffle.partitions`` — the bucket count must equal the shuffle
    partitions of the other side, or Spark reshuffles the fact after all.
    """

    def __init__(self, spark: SparkSession, root: str, fact_buckets: int | bool | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        if fact_buckets is True:
            fact_buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.fact_buckets = fact_buckets or None
        self._fact_table: str | None = None
        self._live: dict[str, list[Part]] | None = None
        self._commit = 0
        self._open: list[tuple[str, str, str, str]] | None = None

    # -------------------------------------------------------------- commits
    def _state(self) -> dict[str, list[Part]]:
        """Live parts of every table: the commits replayed once per ``Warehouse`` (a few
        small rows a table and day), then kept up to date by its own commits."""
        if self._live is None:
            self._live = {}
            log = self._read_path(f"{self.root}/_commits", _COMMITS)
            for r in [] if log is None else log.orderBy("commit", "pos").collect():
                self._apply(r["action"], r["table"], r["seg"], r["part"])
                self._commit = r["commit"]
        return self._live

    def _apply(self, action: str, table: str, seg: str, part: str) -> None:
        parts = self._live.setdefault(table, [])
        if action == "add":
            parts.append((seg, part))
        else:
            parts.remove((seg, part))

    def _change(self, changes: list[tuple[str, str, str, str]]) -> None:
        """(action, table, segment, partition) rows: visible here at once, published
        now or with the transaction that is open."""
        self._state()
        for c in changes:
            self._apply(*c)
        if self._open is None:
            self._publish(changes)
        else:
            self._open += changes

    def _publish(self, changes: list[tuple[str, str, str, str]]) -> None:
        if not changes:
            return
        n, now = self._commit + 1, dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        rows = self.spark.createDataFrame([(n, i, *c, now) for i, c in enumerate(changes)], _COMMITS)
        rows.coalesce(1).write.mode("error").parquet(f"{self.root}/_commits/c={n:010d}")
        self._commit = n

    @contextmanager
    def transaction(self) -> Iterator[Warehouse]:
        """All writes inside are one commit; none of them if it raises."""
        if self._open is not None:  # part of the one around it
            yield self
            return
        self._state()
        self._open = []
        try:
            yield self
            changes, self._open = self._open, None
            self._publish(changes)
        except BaseException:
            self._open = self._live = None  # the state is read again
            raise

    def parts(self, name: str) -> list[Part]:
        return list(self._state().get(name, []))

    def days(self, name: str) -> list[dt.date]:
        """Days that a partitioned table has parts of."""
        found = {p.partition("=")[2] for _, p in self.parts(name)}
        return sorted(dt.date.fromisoformat(d) for d in found if d[:1].isdigit())

    def vacuum(self) -> int:
        """Remove the segments that no live part is in; returns how many."""
        gone, state = 0, self._state()
        for table in [t for t in list_folders(self.spark, self.root) if not t.startswith("_")]:
            live = {s for s, _ in state.get(table, [])}
            for folder in list_folders(self.spark, self.path(table)):
                if folder.startswith("seg=") and folder[4:] not in live:
                    fs, p = _fs(self.spark, f"{self.path(table)}/{folder}")
                    fs.delete(p, True)
                    gone += 1
        return gone

    # -------------------------------------------------------------- reading
    def fact_table(self) -> str | None:
        """Catalog name of the bucketed fact (registered on first use)."""
        if not self.fact_buckets:
            return None
        if self._fact_table is None:
            name = "fm_fact_" + hashlib.sha1(self.root.encode()).hexdigest()[:12]
            cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schemas.FACT_TRANSACTIONS.fields)
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {name} ({cols}, seg string) USING parquet PARTITIONED BY (seg, trans_dt) "
                f"CLUSTERED BY (trans_id) INTO {int(self.fact_buckets)} BUCKETS "
                f"LOCATION '{self.path(FACT)}'")
            if self.parts(FACT):
                # a session catalog starts without the partitions that are on disk
                self.spark.sql(f"MSCK REPAIR TABLE {name}")
            self._fact_table = name
        return self._fact_table

    def keys_of(self, name: str) -> DataFrame:
        """The table to check new keys against (the bucketed fact when set)."""
        if name == FACT and self.fact_table():
            live = sorted({s for s, _ in self.parts(FACT)})
            return self.spark.table(self.fact_table()).where(F.col("seg").isin(live) if live else F.lit(False))
        return self.read(name)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def schema(self, name: str) -> T.StructType:
        base = schemas.WAREHOUSE.get(name)
        if name == "rep_fraud":
            base = T.StructType(base.fields + [T.StructField("batch_dt", T.DateType())])
        return base

    def _read_path(self, path: str, schema: T.StructType) -> DataFrame | None:
        try:
            return self.spark.read.schema(schema).parquet(path)
        except AnalysisException as e:  # only a table that was never written is empty
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def read(self, name: str, schema: T.StructType | None = None, parts: list[Part] | None = None) -> DataFrame:
        """Current rows (or those of ``parts``); an empty typed frame if there are none."""
        schema = schema or self.schema(name)
        if schema is None:
            raise ValueError(f"table {name} has no schema")
        parts = self.parts(name) if parts is None else parts
        if not parts:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.path(name)}/seg={seg}" + (f"/{part}" if part else "") for seg, part in parts]
        by = PARTITIONS.get(name)
        stored = [*schema.fields, T.StructField("seg", T.StringType())]
        if by and by not in schema.fieldNames():
            stored.append(T.StructField(by, T.DateType()))
        df = self.spark.read.schema(T.StructType(stored)).option("basePath", self.path(name)).parquet(*paths)
        return df.select(*schema.fieldNames())

    # -------------------------------------------------------------- writing
    def _write(self, name: str, df: DataFrame) -> list[Part]:
        """The frame as a new segment that nobody sees yet."""
        seg, by = uuid.uuid4().hex[:16], PARTITIONS.get(name)
        if name == FACT and self.fact_table():
            cols = [c for c in schemas.FACT_TRANSACTIONS.fieldNames() if c != by]
            df.select(*cols, F.lit(seg).alias("seg"), by).write.insertInto(self.fact_table())
        else:
            w = df.write.partitionBy(by) if by else df.write
            w.mode("error").parquet(f"{self.path(name)}/seg={seg}")
        return [(seg, p) for p in list_folders(self.spark, f"{self.path(name)}/seg={seg}")] if by else [(seg, "")]

    def _swap(self, name: str, df: DataFrame, old: list[Part]) -> list[Part]:
        new = self._write(name, df)
        self._change([("drop", name, *p) for p in old] + [("add", name, *p) for p in new])
        return new

    def append(self, name: str, df: DataFrame) -> list[Part]:
        return self._swap(name, df, [])

    def overwrite_days(self, name: str, df: DataFrame, day=None) -> None:
        """Replace exactly the days present in ``df``; with ``day`` the frame is that
        one day, which is replaced even by no rows."""
        by = PARTITIONS[name]
        if day is not None:
            df = df.withColumn(by, F.lit(f"{day:%Y-%m-%d}").cast("date"))
        new = self._write(name, df)
        days = {p for _, p in new} | ({f"{by}={day:%Y-%m-%d}"} if day is not None else set())
        self._change([("drop", name, *p) for p in self.parts(name) if p[1] in days] + [("add", name, *p) for p in new])

    def from_day(self, name: str, day: dt.date) -> list[Part]:
        """Live parts of a day and later."""
        return [p for p in self.parts(name) if p[1] >= f"{PARTITIONS[name]}={day:%Y-%m-%d}"]

    def replace_from(self, name: str, df: DataFrame, day: dt.date) -> None:
        """The parts of ``day`` and later give way to the frame."""
        self._swap(name, df, self.from_day(name, day))

    def rewrite(self, name: str, df: DataFrame) -> None:
        """The table is exactly ``df`` afterwards."""
        self._swap(name, df, self.parts(name))

    def key_ids(self, table: str, rows: DataFrame, key: str) -> DataFrame:
        """The dictionary (key, id) of a table after the keys of ``rows`` were added.

        Ids are dense and never change: new keys, in their order, are numbered from the
        highest id on (NULL gets none). The keys that are new are written first, so ids
        do not depend on how often a task runs."""
        name, schema = f"keys_{table}", T.StructType([T.StructField(key, rows.schema[key].dataType), T.StructField("id", T.LongType())])
        with self.transaction():
            known = self.read(name, schema)
            new = rows.select(key).where(F.col(key).isNotNull()).distinct().join(known.select(key), key, "left_anti")
            self.replace(f"stg_{name}", new.orderBy(key))
            above = known.agg(F.max("id")).first()[0] or 0
            staged = self.spark.read.schema(T.StructType([schema[key]])).parquet(self.path(f"stg_{name}"))
            self.append(name, numbered(staged, key, above))
        return self.read(name, schema)

    def replace(self, name: str, df: DataFrame) -> None:
        """Staging semantics: the folder is exactly ``df`` afterwards (no commit: the
        staging of a run is its own)."""
        df.write.mode("overwrite").parquet(self.path(name))


def export_report(df: DataFrame, path: str) -> None:
    """REP_FRAUD as ``;`` text files, ordered by event time (instead of
    printing a full table scan on one machine)."""
    (df.orderBy("event_dt", "passport", "event_type")
       .write.mode("overwrite").option("sep", ";").option("header", True)
       .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path))


def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str | None = None,
              lower: int | None = None, upper: int | None = None, partitions: int = 8,
              properties: dict | None = None) -> DataFrame:
    """Reference tables straight from the bank's RDBMS, read in parallel ranges
    of ``partition_column`` (one query per range, one task each)."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partition_column:
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", lower).option("upperBound", upper)
                  .option("numPartitions", partitions))
    return reader.load()

