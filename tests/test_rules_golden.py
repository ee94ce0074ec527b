"""Golden micro-cases (FIXTURES.md §3), both modes."""

import datetime as dt

import pytest

from fraudmart.operators import rules as R
from fraudmart.operators.enrich import DOCUMENTED, OBSERVED, Batch
from tests import micro

BUCKETS = [None, 60, 3600]


def ids(df):
    return sorted(r["trans_id"] for r in df.select("trans_id").collect())


@pytest.mark.parametrize("bucket", BUCKETS)
def test_city_documented(spark, bucket):
    f, d = micro.fact(spark, micro.CITY_ROWS), micro.dims(spark)
    assert ids(R.hits_city(f, d, None, DOCUMENTED, bucket_s=bucket)) == ["02", "05"]


@pytest.mark.parametrize("bucket", BUCKETS)
def test_city_observed(spark, bucket):
    f, d = micro.fact(spark, micro.CITY_ROWS), micro.dims(spark)
    assert ids(R.hits_city(f, d, None, OBSERVED, bucket_s=bucket)) == ["02", "03", "05", "06"]


def test_city_observed_one_day(spark):
    f, d = micro.fact(spark, micro.CITY_ROWS), micro.dims(spark)
    batch = Batch.day(dt.date(2021, 3, 2), micro.staged(spark, f, dt.date(2021, 3, 2)))
    assert ids(R.hits_city(f, d, batch, OBSERVED)) == ["06"]
    # documented, day 2 only: 06 is 29 h after 05, so nothing
    assert ids(R.hits_city(f, d, batch, DOCUMENTED)) == []


def test_city_documented_day_batch_uses_history(spark):
    f, d = micro.fact(spark, micro.CITY_ROWS), micro.dims(spark)
    batch = Batch.day(dt.date(2021, 3, 1))
    assert ids(R.hits_city(f, d, batch, DOCUMENTED)) == ["02", "05"]


@pytest.mark.parametrize("bucket", BUCKETS)
def test_amount(spark, bucket):
    f, d = micro.fact(spark, micro.AMOUNT_ROWS), micro.dims(spark)
    assert ids(R.hits_amount(f, d, None, DOCUMENTED, bucket_s=bucket)) == ["14"]
    assert ids(R.hits_amount(f, d, None, OBSERVED, bucket_s=bucket)) == ["14", "24"]


def test_amount_rescans_history_in_observed_mode(spark):
    f = micro.fact(spark, micro.AMOUNT_ROWS + micro.DAY2_ROW)
    d = micro.dims(spark)
    day2 = Batch.day(dt.date(2021, 3, 2), micro.staged(spark, f, dt.date(2021, 3, 2)))
    assert ids(R.hits_amount(f, d, day2, OBSERVED)) == ["14", "24"]
    assert ids(R.hits_amount(f, d, day2, DOCUMENTED)) == []
    empty = Batch(staged=micro.staged(spark, f, dt.date(2021, 3, 9)))
    assert ids(R.hits_amount(f, d, empty, OBSERVED)) == []


@pytest.mark.parametrize("when,hit", [
    ("2021-03-01 23:59:59", False), ("2021-03-02 00:00:00", True),
    ("2021-03-02 09:00:00", True), ("2021-03-03 00:00:00", True)])
def test_expiry_boundary(spark, when, hit):
    f = micro.fact(spark, [("x", when, 1, "c1", "SUCCESS", "A1")])
    d = micro.dims(spark, valid_to=dt.date(2021, 3, 2), passport_valid_to=dt.date(2021, 3, 2))
    assert (ids(R.hits_passport_expired(f, d, None)) == ["x"]) is hit
    assert (ids(R.hits_account_expired(f, d, None)) == ["x"]) is hit


def test_expiry_null_never_fires(spark):
    f = micro.fact(spark, [("x", "2030-01-01 00:00:00", 1, "c1", "SUCCESS", "A1")])
    d = micro.dims(spark, passport_valid_to=None)
    assert ids(R.hits_passport_expired(f, d, None)) == []


def test_blacklist_ignores_entry_date_and_null_fio(spark):
    f = micro.fact(spark, [("x", "2020-01-01 10:00:00", 1, "c1", "SUCCESS", "A1"),
                           ("y", "2020-01-01 10:00:00", 1, "c2", "SUCCESS", "A1")])
    d = micro.dims(spark, blacklist=("pass-c1",), patronymic=None)
    hits = R.hits_blacklist(f, d, None)
    assert ids(hits) == ["x"]  # entry date 2021 is after the transaction: still fires
    rep = R.to_report(hits, "passport in blacklist", dt.datetime(2021, 3, 4)).collect()
    assert rep[0]["fio"] is None and rep[0]["passport"] == "pass-c1"


def test_unknown_card_never_fires(spark):
    f = micro.fact(spark, [("x", "2021-03-01 10:00:00", 1, "nope", "SUCCESS", "A1")])
    d = micro.dims(spark, blacklist=("pass-c1",), valid_to=dt.date(2000, 1, 1))
    assert ids(R.hits_blacklist(f, d, None)) == []
    assert ids(R.hits_account_expired(f, d, None)) == []


def test_observed_batch_matches_timestamp_value(spark):
    """An old transaction with the same second as a staged one is in the batch."""
    rows = [("old", "2021-03-01 10:00:00", 1, "c1", "SUCCESS", "A1"),
            ("new", "2021-03-02 10:00:00", 1, "c2", "SUCCESS", "A1")]
    f = micro.fact(spark, rows)
    d = micro.dims(spark, blacklist=("pass-c1", "pass-c2"))
    staged = spark.createDataFrame([(micro.ts("2021-03-01 10:00:00"),), (micro.ts("2021-03-02 10:00:00"),)],
                                   "transaction_date timestamp_ntz")
    b = Batch.day(dt.date(2021, 3, 2), staged)
    assert ids(R.hits_blacklist(f, d, b, OBSERVED)) == ["new", "old"]
    assert ids(R.hits_blacklist(f, d, b, DOCUMENTED)) == ["new"]


def test_passport_any_prefers_blocked(spark):
    f = micro.fact(spark, [("x", "2021-03-05 10:00:00", 1, "c1", "SUCCESS", "A1"),
                           ("y", "2021-03-05 10:00:00", 1, "c2", "SUCCESS", "A1")])
    d = micro.dims(spark, blacklist=("pass-c1",), passport_valid_to=dt.date(2021, 3, 1))
    got = {r["trans_id"]: r["event_type"] for r in R.hits_passport_any(f, d, None).collect()}
    assert got == {"x": "passport in blacklist", "y": "passport not valid"}


@pytest.mark.parametrize("mode", [DOCUMENTED, OBSERVED])
def test_fused_mart_equals_rule_by_rule(spark, mode):
    from fraudmart.plans.mart import fraud_report
    f = micro.fact(spark, micro.CITY_ROWS + micro.AMOUNT_ROWS + micro.DAY2_ROW)
    d = micro.dims(spark, blacklist=("pass-c1", "pass-c3"), valid_to=dt.date(2021, 3, 1),
                   passport_valid_to=dt.date(2021, 3, 2))
    run = dt.datetime(2021, 3, 4, 10, 30)
    for day in (dt.date(2021, 3, 1), dt.date(2021, 3, 2)):
        b = Batch.day(day, micro.staged(spark, f, day))
        fused = sorted(map(tuple, fraud_report(f, d, b, mode, run).collect()))
        plain = sorted(map(tuple, fraud_report(f, d, b, mode, run, fused=False).collect()))
        assert fused == plain and len(fused) > 0


def test_profile_chain_equals_three_joins(spark):
    from fraudmart.operators.enrich import card_profile
    from fraudmart.plans.mart import fraud_report
    f = micro.fact(spark, micro.CITY_ROWS + micro.AMOUNT_ROWS)
    d = micro.dims(spark, blacklist=("pass-c1",), valid_to=dt.date(2021, 3, 1))
    run = dt.datetime(2021, 3, 4)
    plain = sorted(map(tuple, fraud_report(f, d, None, DOCUMENTED, run).collect()))
    d.profile = card_profile(d)
    assert sorted(map(tuple, fraud_report(f, d, None, DOCUMENTED, run).collect())) == plain
