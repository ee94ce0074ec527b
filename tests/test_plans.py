"""Plan shape: pruning reaches the scan, lags share one window, the split LAG of hot
cards shuffles their rows once."""

import datetime as dt
import os
import re

from fraudmart.operators import rules as R
from fraudmart.operators.enrich import Batch
from fraudmart.sources.tables import Warehouse
from tests import micro


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _warehouse_fact(spark, tmp_root):
    wh = Warehouse(spark, os.path.join(tmp_root, "wh"))
    wh.append("dwh_fact_transactions", micro.fact(spark, micro.CITY_ROWS + micro.AMOUNT_ROWS))
    return wh.read("dwh_fact_transactions")


def test_window_rule_prunes_day_partitions(spark, tmp_root):
    fact = _warehouse_fact(spark, tmp_root)
    d = micro.dims(spark)
    plan = _plan(R.hits_city(fact, d, Batch.day(dt.date(2021, 3, 2))))
    assert re.search(r"PartitionFilters: \[[^\]]*trans_dt", plan)
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(trans_date,2021-03-01T23:00", plan)


def test_chain_rule_pushes_batch_to_scan(spark, tmp_root):
    fact = _warehouse_fact(spark, tmp_root)
    plan = _plan(R.hits_blacklist(fact, micro.dims(spark, blacklist=("pass-c1",)), Batch.day(dt.date(2021, 3, 1))))
    assert re.search(r"PartitionFilters: \[[^\]]*trans_dt", plan)
    assert "ReadSchema: struct<trans_id:string,trans_date:timestamp_ntz,card_num:string>" in plan


def test_amount_lags_share_one_window(spark):
    f = micro.fact(spark, micro.AMOUNT_ROWS)
    plan = _plan(R.hits_amount(f, micro.dims(spark), None, bucket_s=None))
    windows = [line for line in plan.splitlines() if re.match(r"\s*[:+\- ]*Window \[", line)]
    assert len(windows) == 1 and windows[0].count("lag(") == 7


def test_split_window_rules_reuse_row_shuffle(spark):
    """Both branches of the split LAG of hot cards read one shuffle of the rows."""
    from fraudmart.operators.enrich import OBSERVED
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        f = micro.fact(spark, micro.CITY_ROWS + micro.AMOUNT_ROWS)
        for hits in (R.hits_amount(f, micro.dims(spark), None, OBSERVED, hot_rows=0),
                     R.hits_city(f, micro.dims(spark), None, OBSERVED, hot_rows=0)):
            assert re.search(r"ReusedExchange \[_key", _plan(hits))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_observed_batch_prunes_partitions_dynamically(spark, tmp_root):
    from fraudmart.operators.enrich import OBSERVED
    fact = _warehouse_fact(spark, tmp_root)
    staged = micro.staged(spark, fact, dt.date(2021, 3, 2))
    hits = R.hits_blacklist(fact, micro.dims(spark, blacklist=("pass-c1",)), Batch(staged=staged), OBSERVED)
    assert "dynamicpruningexpression" in _plan(hits)
    assert sorted(r["trans_id"] for r in hits.collect()) == ["06", "07"]


def test_observed_window_rule_prunes_later_days(spark, tmp_root):
    from fraudmart.operators.enrich import OBSERVED
    fact = _warehouse_fact(spark, tmp_root)
    staged = micro.staged(spark, fact, dt.date(2021, 3, 1))
    hits = R.hits_city(fact, micro.dims(spark), Batch(staged=staged), OBSERVED)
    assert re.search(r"PartitionFilters: \[[^\]]*trans_dt", _plan(hits))
    assert sorted(r["trans_id"] for r in hits.collect()) == ["02", "03", "05"]


def test_card_profile_makes_the_chain_one_join(spark):
    from fraudmart.operators.enrich import card_profile, with_client
    f = micro.fact(spark, micro.CITY_ROWS)
    d = micro.dims(spark)
    joins = lambda df: len(re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin) \[", _plan(df)))
    three = joins(with_client(f, d))
    d.profile = spark.createDataFrame(card_profile(d).collect(), card_profile(d).schema)  # as a written table
    assert (three, joins(with_client(f, d))) == (3, 1)
