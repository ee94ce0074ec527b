"""Properties of SURVEY §5.4 on the sf0.01 test tables."""

import datetime as dt

from pyspark.sql import functions as F

from fraudmart.operators import rules as R
from fraudmart.operators.enrich import DOCUMENTED, OBSERVED, Batch, range_filter
from fraudmart.plans import adapters as A
from fraudmart.plans.mart import fraud_report
from fraudmart.plans.pipeline import run_days_frames
from tests.conftest import SF_MID

START, END = dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 13)


def _ids(df):
    return sorted(r["trans_id"] for r in df.select("trans_id").collect())


def test_bounded_lookback_equals_full_history(spark):
    ev, d = A.events_fact(spark, SF_MID), A.dims(spark, SF_MID)
    batch = Batch(START, END)
    for hits, full in [
        (R.hits_city(ev, d, batch, chain=False), R.hits_city(ev, d, None, chain=False)),
        (R.hits_amount(ev, d, batch, limit_s=3 * 86400, chain=False),
         R.hits_amount(ev, d, None, limit_s=3 * 86400, chain=False)),
    ]:
        assert _ids(hits) == _ids(range_filter(full, START, END, part=None))


def test_documented_is_subset_of_observed(spark):
    ev, d = A.events_fact(spark, SF_MID), A.dims(spark, SF_MID)
    staged = range_filter(ev, START, END, part=None).select(F.col("trans_date").alias("transaction_date"))
    doc = Batch(START, END)
    obs = Batch(START, END, staged)
    city_doc, city_obs = _ids(R.hits_city(ev, d, doc, DOCUMENTED)), _ids(R.hits_city(ev, d, obs, OBSERVED))
    assert set(city_doc) <= set(city_obs) and len(city_doc) < len(city_obs)
    amt_doc = _ids(R.hits_amount(ev, d, doc, DOCUMENTED, limit_s=3 * 86400))
    amt_obs = _ids(R.hits_amount(ev, d, obs, OBSERVED))
    assert set(amt_doc) <= set(amt_obs)


def test_days_one_by_one_equal_one_run_over_the_range(spark):
    """Documented mode, files in date order: the daily loop gives the same rows
    as one report over the whole range (batch day = event day)."""
    ev, d = A.events_fact(spark, SF_MID), A.dims(spark, SF_MID)
    run = dt.datetime(2021, 3, 4)
    history = range_filter(ev, None, START, part=None)
    days = [Batch.day((START + dt.timedelta(days=i)).date()) for i in range(3)]
    staged = [(b, range_filter(ev, b.start, b.end, part=None)) for b in days]
    daily = run_days_frames(staged, d, history, DOCUMENTED, run)
    once = fraud_report(ev, d, Batch(START, END), DOCUMENTED, run).withColumn(
        "batch_dt", F.to_date("event_dt"))
    assert sorted(map(tuple, daily.collect())) == sorted(map(tuple, once.select(*daily.columns).collect()))
