"""Rows that a daily job must not lose or double."""

import datetime as dt
import os

from fraudmart import schemas
from fraudmart.operators.load import insert_new
from fraudmart.operators.scd import scd2_init, scd2_step
from fraudmart.plans.pipeline import pending_days, run_day
from fraudmart.sources.tables import FACT, Warehouse
from tests.test_sources_pipeline import C1, _day_files, _tx_file


def test_bucketed_fact_is_found_by_the_next_application(spark, tmp_root):
    rows = spark.createDataFrame([("t1", dt.datetime(2021, 3, 1, 10), dt.date(2021, 3, 1))],
                                 "trans_id string, trans_date timestamp_ntz, trans_dt date")
    rows = rows.select(*[rows[f.name] if f.name in rows.columns else schemas_null(f) for f in schemas.FACT_TRANSACTIONS.fields])
    root = os.path.join(tmp_root, "wh")
    wh = Warehouse(spark, root, fact_buckets=4)
    wh.append(FACT, rows)
    spark.sql(f"DROP TABLE {wh.fact_table()}")  # the files stay, a new session's catalog is empty
    again = Warehouse(spark, root, fact_buckets=4)
    assert again.keys_of(FACT).count() == 1
    assert insert_new(rows, again.keys_of(FACT), "trans_id").count() == 0


def schemas_null(field):
    from pyspark.sql import functions as F
    return F.lit(None).cast(field.dataType).alias(field.name)


def test_second_snapshot_of_a_day_replaces_the_first(spark):
    snap = lambda *rows: spark.createDataFrame(rows, "k string, a string")
    one, two = dt.datetime(2021, 3, 1), dt.datetime(2021, 3, 2)
    start = scd2_init(snap(("x", "1"), ("y", "1")), "k", ["a"], one)
    wrong = scd2_step(start, snap(("x", "2")), "k", ["a"], two)
    right = snap(("x", "3"), ("y", "1"), ("z", "1"))
    rows = lambda df: sorted(map(tuple, df.collect()))
    got = rows(scd2_step(wrong, right, "k", ["a"], two))
    assert got == rows(scd2_step(start, right, "k", ["a"], two))
    assert all(r[2] <= r[3] for r in got)


def test_several_files_null_ids_and_empty_files(spark, tmp_root):
    inbox = os.path.join(tmp_root, "in")
    os.makedirs(inbox)
    day = dt.date(2021, 3, 1)
    _day_files(inbox, day, [["t1", "2021-03-01 10:00:00", "1.00", C1, "PAYMENT", "SUCCESS", "A1"]],
               [["A1", "POS", "Moscow", "a"]], [])
    _tx_file(os.path.join(inbox, "transactions_more_01032021.txt"),
             [["", "2021-03-01 11:00:00", "2.00", C1, "PAYMENT", "SUCCESS", "A1"]])
    wh = Warehouse(spark, os.path.join(tmp_root, "wh"))
    (found, files), = pending_days(spark, wh, inbox)
    assert found == day and len(files.transactions) == 2
    for _ in range(2):  # a rerun adds no ledger rows
        run_day(spark, wh, files, day, "observed", dt.datetime(2021, 3, 4))
    ids = [r["trans_id"] for r in wh.read(FACT).collect()]
    assert "t1" in ids and None in ids
    ledger = {r["file_name"]: (r["rows"], r["rejected"]) for r in wh.read("meta_ingest_log").collect()}
    assert ledger == {"transactions_01032021.txt": (1, 0), "transactions_more_01032021.txt": (1, 1),
                      "terminals_01032021.xlsx": (1, 0), "passport_blacklist_01032021.xlsx": (0, 0)}
    assert wh.read("meta_ingest_log").count() == 4
    assert pending_days(spark, wh, inbox) == []
