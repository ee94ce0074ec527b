"""Loads (insert new keys) and the SCD helpers (FIXTURES.md §3.4)."""

import datetime as dt

from fraudmart import schemas
from fraudmart.operators import load as L
from fraudmart.operators import scd as SCD


def _cards(spark, rows):
    return spark.createDataFrame(rows, schemas.DIM_CARDS)


def test_insert_new_semantics(spark):
    existing = _cards(spark, [("1", "a", None, None), ("2", "b", None, None)])
    staged = _cards(spark, [("2", "CHANGED", None, None), ("3", "c", None, None), ("3", "c2", None, None),
                            (None, "n1", None, None), (None, "n2", None, None)])
    got = sorted((r["card_num"] or "", r["account_num"]) for r in L.insert_new(staged, existing, "card_num").collect())
    # known key ignored even if changed; duplicates of a new key and NULL keys all go in
    assert got == [("", "n1"), ("", "n2"), ("3", "c"), ("3", "c2")]


def test_load_twice_adds_nothing(spark):
    staged = spark.createDataFrame([("1", "acc", None, None)], schemas.SEED_CARDS)
    first = L.load_new(staged, spark.createDataFrame([], schemas.DIM_CARDS), "dwh_dim_cards")
    assert first.columns == [f.name for f in schemas.DIM_CARDS.fields]
    assert L.load_new(staged, first, "dwh_dim_cards").count() == 0


def test_insert_new_plan_is_anti_join(spark):
    existing = _cards(spark, [("1", "a", None, None)])
    staged = _cards(spark, [("1", "a", None, None)])
    plan = L.insert_new(staged, existing, "card_num")._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and "LeftSemi" in plan


def test_conform_try_cast_rejects_to_null(spark):
    df = spark.createDataFrame([("t1", "not a time", "12.5x")], "trans_id string, trans_date string, amt string")
    out = L.conform(df, schemas.FACT_TRANSACTIONS).collect()[0]
    assert out["trans_date"] is None and out["amt"] is None and out["trans_id"] == "t1"


ATTRS = ["terminal_city", "terminal_address"]


def _snap(spark, rows):
    return spark.createDataFrame(rows, "terminal_id string, terminal_city string, terminal_address string")


def test_snapshot_delta(spark):
    cur = _snap(spark, [("1", "M", "a"), ("2", "M", "b"), ("3", "K", "c")])
    new = _snap(spark, [("1", "M", "a"), ("2", "M", "b2"), ("4", "K", "d")])
    got = {r["terminal_id"]: r["change"] for r in SCD.snapshot_delta(cur, new, "terminal_id", ATTRS).collect()}
    assert got == {"1": "same", "2": "changed", "3": "gone", "4": "new"}


def test_scd1_upsert(spark):
    cur = spark.createDataFrame([("1", "M", "a", dt.date(2020, 1, 1), None)],
                                "terminal_id string, terminal_city string, terminal_address string, "
                                "create_dt date, update_dt date")
    out = {r["terminal_id"]: r for r in SCD.scd1_upsert(
        cur, _snap(spark, [("1", "M", "a2"), ("2", "K", "b")]), "terminal_id", ATTRS,
        dt.date(2021, 3, 1)).collect()}
    assert out["1"]["terminal_address"] == "a2" and out["1"]["update_dt"] == dt.date(2021, 3, 1)
    assert out["1"]["create_dt"] == dt.date(2020, 1, 1)
    assert out["2"]["create_dt"] == dt.date(2021, 3, 1) and out["2"]["update_dt"] is None


def test_scd2_history(spark):
    t1, t2, t3 = dt.datetime(2021, 3, 1), dt.datetime(2021, 3, 2), dt.datetime(2021, 3, 3)
    h = SCD.scd2_init(_snap(spark, [("1", "M", "a"), ("2", "M", "b")]), "terminal_id", ATTRS, t1)
    h = SCD.scd2_step(h, _snap(spark, [("1", "M", "a2")]), "terminal_id", ATTRS, t2)
    h = SCD.scd2_step(h, _snap(spark, [("1", "M", "a2"), ("2", "M", "b")]), "terminal_id", ATTRS, t3)
    rows = sorted((r["terminal_id"], r["terminal_address"], r["effective_from"], r["effective_to"], r["deleted_flg"])
                  for r in h.collect())
    end = SCD.OPEN_END
    assert rows == [
        ("1", "a", t1, t2 - dt.timedelta(seconds=1), False),
        ("1", "a2", t2, end, False),
        ("2", "b", t1, t2 - dt.timedelta(seconds=1), False),
        ("2", "b", t2, t3 - dt.timedelta(seconds=1), True),
        ("2", "b", t3, end, False),
    ]


def test_blacklist_increment(spark):
    rows = [("p1", dt.date(2021, 3, 1)), ("p2", dt.date(2021, 3, 2)), ("p0", dt.date(2021, 2, 27))]
    month_file = spark.createDataFrame(rows, "passport_num string, entry_dt date")
    loaded = spark.createDataFrame([("p1", dt.date(2021, 3, 1))], "passport_num string, entry_dt date")
    got = [r["passport_num"] for r in SCD.blacklist_increment(loaded, month_file, dt.date(2021, 3, 2)).collect()]
    assert got == ["p2"]
