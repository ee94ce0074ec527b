"""The given test tables seen as bank tables.

The rules only know bank column names; these projections rename test-table
columns onto them (pure ``select``s, so pruning and pushdown reach the scan).

Chain rules: fact = ``lineitem`` (``l_shipdate`` is the transaction time) →
card = ``orders`` → account = ``customer`` → client = ``customer`` with its
``nation``. Window rules: fact = ``events`` (``user_id`` is the card, the
``props`` number ``k`` the terminal, purchase/signup are successful
operations), same dimensions.

Dates that the bank tables have and the test tables lack are derived from keys
by fixed rules (below), so Spark and the SQL oracle compute the same values.
"""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudmart.functions import ts_lit
from fraudmart.operators.enrich import Batch, Dims

# Fixed values of the adapter (mirrored in the oracle SQL of __spark_entry__).
CHAIN_BATCH = (dt.datetime(2000, 1, 1), dt.datetime(2000, 2, 1))
CITY_BATCH = (dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 20))
REPORT_DT = dt.datetime(2021, 3, 4, 10, 30, 0)
ACCOUNT_VALID_FROM, ACCOUNT_VALID_DAYS = "1999-07-01", 400     # valid_to = from + key % days
PASSPORT_VALID_FROM, PASSPORT_VALID_DAYS = "1999-10-01", 200   # NULL for HOUSEHOLD segment
NULL_PASSPORT_SEGMENT = "HOUSEHOLD"
BLACKLIST_FROM, BLACKLIST_DAYS = "1999-12-01", 62               # entry_dt for c_acctbal < 0
TERMINALS_PER_NATION = 4                                        # terminal k ↔ nation k % 25
SUCCESS_EVENTS = ("purchase", "signup")


_SCHEMAS: dict[str, object] = {}
_FRAMES: dict[tuple, object] = {}


def _memo(fn):
    """Build an adapter frame once per (session, folder): frames are immutable
    plans, so reusing them only saves the driver-side plan construction."""
    def wrapped(spark: SparkSession, sf_dir: str):
        key = (spark.sparkContext.applicationId, id(spark), fn.__name__, sf_dir)
        if key not in _FRAMES:
            _FRAMES[key] = fn(spark, sf_dir)
        return _FRAMES[key]
    wrapped.__name__, wrapped.__doc__ = fn.__name__, fn.__doc__
    return wrapped


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table. Its schema is inferred once and then passed explicitly:
    inference reads file footers in a Spark job on every ``read.parquet``."""
    path = os.path.join(sf_dir, f"{name}.parquet")
    schema = _SCHEMAS.get(path)
    if schema is None:
        df = spark.read.parquet(path)
        _SCHEMAS[path] = df.schema
        return df
    return spark.read.schema(schema).parquet(path)


def _days_after(start: str, key: str, modulus: int) -> F.Column:
    return F.date_add(F.lit(start).cast("date"), (F.col(key) % modulus).cast("int"))


@_memo
def lineitem_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("trans_id"),
        F.col("l_shipdate").alias("trans_date"),
        F.col("l_extendedprice").alias("amt"),
        F.col("l_orderkey").alias("card_num"),
        F.col("l_returnflag").alias("oper_type"),
        F.when(F.col("l_linestatus") == "F", "SUCCESS").otherwise("REJECT").alias("oper_result"),
        F.col("l_suppkey").alias("terminal"),
    )


@_memo
def events_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").alias("trans_id"),
        F.col("ts").alias("trans_date"),
        F.col("value").alias("amt"),
        F.col("user_id").alias("card_num"),
        F.col("event_type").alias("oper_type"),
        F.when(F.col("event_type").isin(*SUCCESS_EVENTS), "SUCCESS").otherwise("REJECT")
         .alias("oper_result"),
        F.get_json_object("props", "$.k").cast("bigint").alias("terminal"),
    )


@_memo
def cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("card_num"), F.col("o_custkey").alias("account_num"),
        F.to_date("o_orderdate").alias("create_dt"), F.lit(None).cast("date").alias("update_dt"))


@_memo
def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("account_num"),
        _days_after(ACCOUNT_VALID_FROM, "c_custkey", ACCOUNT_VALID_DAYS).alias("valid_to"),
        F.col("c_custkey").alias("client"),
        F.lit(None).cast("date").alias("create_dt"), F.lit(None).cast("date").alias("update_dt"))


@_memo
def clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    cu = table(spark, sf_dir, "customer")
    na = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return cu.join(na, cu.c_nationkey == na.n_nationkey, "left").select(
        F.col("c_custkey").alias("client_id"),
        F.col("c_name").alias("last_name"),
        F.col("c_mktsegment").alias("first_name"),
        F.col("n_name").alias("patronymic"),
        F.lit(None).cast("date").alias("date_of_birth"),
        F.col("c_name").alias("passport_num"),
        F.when(F.col("c_mktsegment") != NULL_PASSPORT_SEGMENT,
               _days_after(PASSPORT_VALID_FROM, "c_custkey", PASSPORT_VALID_DAYS))
         .alias("passport_valid_to"),
        F.concat(F.lit("+7 "), F.lpad(F.col("c_custkey").cast("string"), 10, "0")).alias("phone"),
        F.lit(None).cast("date").alias("create_dt"), F.lit(None).cast("date").alias("update_dt"))


@_memo
def blacklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").where(F.col("c_acctbal") < 0).select(
        F.col("c_name").alias("passport_num"),
        _days_after(BLACKLIST_FROM, "c_custkey", BLACKLIST_DAYS).alias("entry_dt"),
        F.lit(None).cast("date").alias("create_dt"), F.lit(None).cast("date").alias("update_dt"))


@_memo
def terminals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terminal ids ``n_nationkey + 25*j`` (j < 4) are located in that nation."""
    na = table(spark, sf_dir, "nation")
    j = F.explode(F.sequence(F.lit(0), F.lit(TERMINALS_PER_NATION - 1))).alias("j")
    return na.select("n_nationkey", "n_name", j).select(
        (F.col("n_nationkey") + F.lit(25) * F.col("j")).cast("bigint").alias("terminal_id"),
        F.lit("POS").alias("terminal_type"),
        F.col("n_name").alias("terminal_city"),
        F.concat(F.col("n_name"), F.lit(" "), F.col("j").cast("string")).alias("terminal_address"),
        F.lit(None).cast("date").alias("create_dt"), F.lit(None).cast("date").alias("update_dt"))


def dims(spark: SparkSession, sf_dir: str) -> Dims:
    return Dims(cards(spark, sf_dir), accounts(spark, sf_dir), clients(spark, sf_dir),
                terminals(spark, sf_dir), blacklist(spark, sf_dir))


def chain_batch(spark: SparkSession, sf_dir: str, staged: bool = False) -> Batch:
    """January 2000 of ``lineitem``; ``staged=True`` also gives the staging frame."""
    start, end = CHAIN_BATCH
    st = None
    if staged:
        st = lineitem_fact(spark, sf_dir).where(
            (F.col("trans_date") >= ts_lit(start)) & (F.col("trans_date") < ts_lit(end))
        ).select(F.col("trans_date").alias("transaction_date"))
    return Batch(start, end, st)


def city_batch(spark: SparkSession, sf_dir: str, staged: bool = False) -> Batch:
    start, end = CITY_BATCH
    st = None
    if staged:
        st = events_fact(spark, sf_dir).where(
            (F.col("trans_date") >= ts_lit(start)) & (F.col("trans_date") < ts_lit(end))
        ).select(F.col("trans_date").alias("transaction_date"))
    return Batch(start, end, st)

