"""The split (skew-safe) LAG equals the single-window LAG."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from fraudmart.functions import within_interval
from fraudmart.operators import lag
from fraudmart.operators.lag import lag_columns, lag_within
from fraudmart.operators.rules import AMOUNT_LAGS, ORDER, hits_amount, hits_city
from fraudmart.plans import adapters as A
from tests.conftest import SF_MID


def _rows(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


@pytest.mark.parametrize("bucket", [1, 600, 3600, 86400 * 7])
def test_split_lag_equals_plain_on_events(spark, bucket):
    ev = A.events_fact(spark, SF_MID).select("trans_id", "trans_date", "card_num", "amt", "oper_result")
    cols = ["trans_id", *AMOUNT_LAGS]
    plain = lag_columns(ev, ["card_num"], ORDER, AMOUNT_LAGS, None)
    split = lag_columns(ev, ["card_num"], ORDER, AMOUNT_LAGS, bucket, hot_rows=0)
    assert _rows(plain, cols) == _rows(split, cols)


def test_split_lag_one_hot_key_nulls_and_ties(spark):
    base = dt.datetime(2021, 3, 1)
    rows = []
    for i in range(400):  # one hot card, dense and sparse stretches, timestamp ties
        rows.append(("hot", base + dt.timedelta(seconds=(i // 2) * (1 if i < 200 else 97)), i, float(i)))
    rows += [(None, base + dt.timedelta(minutes=i), 1000 + i, 1.0) for i in range(5)]  # NULL card
    rows += [("c", None, 2000 + i, 2.0) for i in range(3)]                               # NULL time
    rows += [("lone", base, 3000, 3.0)]
    df = spark.createDataFrame(rows, "card string, ts timestamp_ntz, id long, v double")
    lags = {"l1": ("v", 1), "l2": ("id", 2), "l3": ("ts", 3)}
    plain = lag_columns(df, ["card"], ["ts", "id"], lags, None)
    for bucket in (1, 10, 60):
        split = lag_columns(df, ["card"], ["ts", "id"], lags, bucket, hot_rows=0)
        assert _rows(plain, ["id", "l1", "l2", "l3"]) == _rows(split, ["id", "l1", "l2", "l3"])


def _spread(df):
    """Largest and median group that one task sorts in a window over ``_key, _b``."""
    sizes = sorted(r["count"] for r in df.groupBy("card", "b").count().collect())
    return sizes[-1], sizes[len(sizes) // 2]


def test_only_hot_cards_take_the_split_form(spark):
    base = dt.datetime(2021, 3, 1)
    rows = [("hot" if i % 3 == 0 else f"c{i % 200}", base + dt.timedelta(seconds=37 * i), i, float(i % 7)) for i in range(3000)]
    df = spark.createDataFrame(rows, "card string, ts timestamp_ntz, id long, v double")
    lags = {"l1": ("v", 1), "l3": ("id", 3)}
    assert lag.hot_keys(df, ["card"], 500) == [df.where("card = 'hot'").select(F.xxhash64("card")).first()[0]]
    mixed = lag_columns(df, ["card"], ["ts", "id"], lags, 3600, hot_rows=500)
    plan = mixed._jdf.queryExecution().executedPlan().toString()
    assert "Union" in plan and "hashpartitioning(_key" in plan and "hashpartitioning(card" in plan
    plain = lag_columns(df, ["card"], ["ts", "id"], lags, None)
    assert _rows(plain, ["id", "l1", "l3"]) == _rows(mixed, ["id", "l1", "l3"])
    most, median = _spread(df.where("card = 'hot'").withColumn("b", lag.time_bucket(df, "ts", 3600)))
    assert most <= 1.2 * median + 1 and most < 50  # of the hot card's 1,000 rows
    calm = lag_columns(df, ["card"], ["ts", "id"], lags, 3600)._jdf.queryExecution().executedPlan().toString()
    assert "_key" not in calm and calm.count("Exchange") == 1


@pytest.mark.parametrize("limit", [1, 60, 3600])
@pytest.mark.parametrize("width", [None, 1])
def test_replicated_lag_equals_plain_within_the_limit(spark, limit, width):
    rng = random.Random(limit)
    base = dt.datetime(2021, 3, 14)
    rows = [(rng.choice(["hot", "hot", "a", None]), base + dt.timedelta(seconds=rng.choice([0.25, 0.25, 1, 7.5]) * k), k, float(k % 11))
            for k in range(600)] + [("hot", None, 900, 1.0)]
    df = spark.createDataFrame(rows, "card string, ts timestamp_ntz, id long, v double")
    lags = {"l1": ("v", 1), "t1": ("ts", 1), "l3": ("id", 3), "t3": ("ts", 3)}
    near = lambda x, t, c: F.when(within_interval("ts", t, limit), F.col(c)).alias(c)
    cols = lambda x: x.where("ts is not null").select("id", near(x, "t1", "l1"), near(x, "t3", "l3"))
    got = lag_within(df, ["card"], ["ts", "id"], lags, limit, width)
    want = lag_columns(df, ["card"], ["ts", "id"], lags, None)
    key = lambda x: sorted((str(tuple(r)) for r in cols(x).collect()))
    assert key(got) == key(want) and any("None" not in r for r in key(want))


def test_documented_rules_exchange_rows_once(spark):
    """One hash exchange under the only window of each rule, and no self-join."""
    ev, dims = A.events_fact(spark, SF_MID), A.dims(spark, SF_MID)
    for hits in (hits_amount(ev, dims, None, chain=False), hits_city(ev, dims, None, chain=False)):
        plan = hits._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Window [") == 1 and plan.count("Exchange hashpartitioning(card_num") == 1
        assert plan.count("events.parquet") <= 2 and "SortMergeJoin" not in plan  # one scan (path named twice)


def test_split_running_equals_plain(spark):
    from fraudmart.operators.lag import running_columns
    ev = A.events_fact(spark, SF_MID).select("trans_id", "trans_date", "card_num", "amt")
    aggs = {"n": ("sum", F.lit(1)), "hi": ("max", F.col("amt")), "lo": ("min", F.col("amt")),
            "s": ("sum", F.col("amt"))}
    plain = running_columns(ev, ["card_num"], ORDER, aggs, None)
    for bucket in (60, 86400):
        split = running_columns(ev, ["card_num"], ORDER, aggs, bucket, hot_rows=0)
        got = sorted((r["trans_id"], r["n"], r["hi"], r["lo"], round(r["s"], 6)) for r in split.collect())
        want = sorted((r["trans_id"], r["n"], r["hi"], r["lo"], round(r["s"], 6)) for r in plain.collect())
        assert got == want


def test_amount_chains_match_amount_rule(spark):
    from fraudmart.operators.enrich import OBSERVED
    from fraudmart.operators.rules import amount_chains
    ev = A.events_fact(spark, SF_MID)
    chains = {r["trans_id"] for r in amount_chains(ev).collect()}
    full = lambda x: sorted(map(tuple, x.collect()))
    assert full(amount_chains(ev)) == full(amount_chains(ev, hot_rows=20)) == full(amount_chains(ev, hot_rows=0))
    plan = amount_chains(ev)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan
    rule = {r["trans_id"] for r in hits_amount(ev, A.dims(spark, SF_MID), None, OBSERVED, chain=False).collect()}
    assert chains == rule and chains


def test_split_lag_is_time_zone_independent(spark):
    """Wall-clock buckets for timestamp_ntz: exact even in a daylight-saving zone."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        base = dt.datetime(2021, 3, 14, 1, 50)  # clocks jump 02:00 -> 03:00 that night
        rows = [("c", base + dt.timedelta(minutes=5 * i), i, float(i)) for i in range(30)]
        df = spark.createDataFrame(rows, "card string, ts timestamp_ntz, id long, v double")
        lags = {"l1": ("v", 1), "l3": ("id", 3)}
        plain = lag_columns(df, ["card"], ["ts", "id"], lags, None)
        split = lag_columns(df, ["card"], ["ts", "id"], lags, 600, hot_rows=0)
        assert _rows(plain, ["id", "l1", "l3"]) == _rows(split, ["id", "l1", "l3"])
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
