"""Dimension chain and batch selection shared by the rules.

Joins are plain equi-joins: Catalyst/AQE pick broadcast when a side's measured
size is under ``spark.sql.autoBroadcastJoinThreshold`` (a checked bound) and
sort-merge otherwise, so a dimension that outgrows memory does not break.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudmart.functions import date_lit, ts_lit

DOCUMENTED, OBSERVED = "documented", "observed"


@dataclass
class Dims:
    """Warehouse dimensions (bank column names).

    ``profile`` is an optional pre-joined card → account → client table (see
    ``card_profile``); when present the chain is one join instead of three.
    """
    cards: DataFrame
    accounts: DataFrame
    clients: DataFrame
    terminals: DataFrame | None = None
    blacklist: DataFrame | None = None
    profile: DataFrame | None = None


@dataclass
class Batch:
    """What counts as "today's transactions".

    ``start``/``end`` (end exclusive) is the documented form: a time range, so
    the filter reaches the scan and the ``trans_dt`` partitions are pruned.
    ``staged`` is the staging frame (column ``transaction_date``); the observed
    form matches fact rows on the *timestamp value* of staged rows.
    """
    start: dt.datetime | None = None
    end: dt.datetime | None = None
    staged: DataFrame | None = None

    @classmethod
    def day(cls, day: dt.date, staged: DataFrame | None = None) -> "Batch":
        start = dt.datetime(day.year, day.month, day.day)
        return cls(start, start + dt.timedelta(days=1), staged)


_ts = ts_lit


def range_filter(df: DataFrame, start, end, ts: str = "trans_date",
                 part: str | None = "trans_dt") -> DataFrame:
    """``start <= ts < end`` plus the same bound on the day partition column if present."""
    cond = F.lit(True)
    if start is not None:
        cond = cond & (F.col(ts) >= _ts(start))
    if end is not None:
        cond = cond & (F.col(ts) < _ts(end))
    if part and part in df.columns:
        if start is not None:
            cond = cond & (F.col(part) >= date_lit(start))
        if end is not None:
            cond = cond & (F.col(part) <= date_lit(end))
    return df.where(cond)


def staged_times(staged: DataFrame, ts: str = "trans_date") -> DataFrame:
    """Distinct staged timestamps (partial aggregation before any shuffle)."""
    return staged.select(F.col("transaction_date").alias(ts)).where(F.col(ts).isNotNull()).distinct()


def semi_join_batch(df: DataFrame, staged: DataFrame, ts: str = "trans_date",
                    part: str = "trans_dt") -> DataFrame:
    """Rows whose timestamp equals the timestamp of some staged row (IN subquery).

    On a fact partitioned by day, a semi join on the staged *days* comes first:
    equal timestamps have equal days, so it removes nothing the timestamp match
    would keep, and Spark turns it into dynamic partition pruning of the scan.
    """
    times = staged_times(staged, ts)
    if part in df.columns:
        days = times.select(F.to_date(ts).alias(part)).distinct()
        df = df.join(days, part, "left_semi")
    return df.join(times, ts, "left_semi")


def staging_nonempty(df: DataFrame, staged: DataFrame, ts: str = "trans_date") -> DataFrame:
    """``ts IN (SELECT <outer ts> FROM staged)``: true for every non-NULL ``ts``
    as soon as staging has a row. An uncorrelated EXISTS, evaluated once."""
    return df.where(F.col(ts).isNotNull() & staged.exists())


def select_batch(fact: DataFrame, batch: Batch | None, mode: str = DOCUMENTED,
                 ts: str = "trans_date") -> DataFrame:
    if batch is None:
        return fact
    if mode == OBSERVED and batch.staged is not None:
        return semi_join_batch(fact, batch.staged, ts)
    return range_filter(fact, batch.start, batch.end, ts)


CLIENT_COLS = ["passport_num", "last_name", "first_name", "patronymic", "phone"]


def with_client(df: DataFrame, dims: Dims, how: str = "inner",
                extra: tuple[str, ...] = ()) -> DataFrame:
    """card_num -> card -> account -> client, keeping client attributes.

    ``extra`` may name ``valid_to`` (account) and/or ``passport_valid_to``.
    """
    acc_cols = ["account_num", "client"] + [c for c in extra if c == "valid_to"]
    cli_cols = CLIENT_COLS + [c for c in extra if c == "passport_valid_to"]
    if dims.profile is not None:
        return df.join(dims.profile.select("card_num", *acc_cols, *cli_cols), "card_num", how)
    cards = dims.cards.select("card_num", "account_num")
    accounts = dims.accounts.select(*acc_cols)
    clients = dims.clients.select(F.col("client_id").alias("client"), *cli_cols)
    return (df.join(cards, "card_num", how)
              .join(accounts, "account_num", how)
              .join(clients, "client", how))


def blacklisted(df: DataFrame, blacklist: DataFrame, col: str = "passport_num") -> DataFrame:
    """Semi join on passport membership (entry date not looked at)."""
    return df.join(blacklist.select(F.col("passport_num").alias(col)), col, "left_semi")


def card_profile(dims: Dims) -> DataFrame:
    """Card → account → client, pre-joined once (inner, as the rules need it).

    Rebuilt when the dimensions change and written as a table, it turns the
    three-hop chain of every report into a single join on ``card_num``; worth
    it when a day of transactions outweighs the dimensions.
    """
    cards = dims.cards.select("card_num", "account_num")
    accounts = dims.accounts.select("account_num", "client", "valid_to")
    clients = dims.clients.select(F.col("client_id").alias("client"), *CLIENT_COLS, "passport_valid_to")
    return cards.join(accounts, "account_num").join(clients, "client")
