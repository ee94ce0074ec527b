"""Files that used to lose or change rows silently."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudmart.operators.scd import scd1_upsert, scd2_init, scd2_step
from fraudmart.sources.delimited import read_delimited
from fraudmart.sources.dump import read_insert_dump
from fraudmart.sources.workbook import excel_date

SCHEMA = T.StructType([T.StructField("transaction_id", T.StringType()), T.StructField("amount", T.DecimalType(10, 2)),
                       T.StructField("card_num", T.StringType())])


def test_header_names_and_both_decimal_marks(spark, tmp_root):
    path = os.path.join(tmp_root, "transactions_01032021.txt")
    with open(path, "w") as f:
        f.write("card_num;transaction_id;amount\n4444;t1;5849,56\n4445;t2;999.5\n")
    rows = {r["transaction_id"]: (str(r["amount"]), r["card_num"]) for r in read_delimited(spark, path, SCHEMA).collect()}
    assert rows == {"t1": ("5849.56", "4444"), "t2": ("999.50", "4445")}
    with open(path, "w") as f:
        f.write("card_num;amount\n1;2\n")
    with pytest.raises(ValueError):
        read_delimited(spark, path, SCHEMA)


def test_semicolons_and_long_literals_in_a_dump(spark, tmp_root):
    path, long = os.path.join(tmp_root, "dump.sql"), "x" * 30_000
    with open(path, "w") as f:
        f.write("create table cards (a text, b text);\n"
                f"insert into cards (a, b) values ('1;2', 'it''s'); insert into cards (a, b) values ('3', '{long}');\n"
                "insert into cards (a, b) values ('4', null), ('5', ')');\n")
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])
    got = sorted(tuple(r) for r in read_insert_dump(spark, path, "cards", schema).collect())
    assert got == [("1;2", "it's"), ("3", long), ("4", None), ("5", ")")]


def test_dates_of_workbook_cells(spark):
    df = spark.createDataFrame([("44256",), ("2021-03-01",), ("01.03.2021",), ("2021-03-01 00:00:00",), ("soon",), (None,)], "c string")
    got = [r["d"] for r in df.select(excel_date("c").alias("d")).collect()]
    assert got == [dt.date(2021, 3, 1)] * 4 + [None, None]


def test_repeated_and_missing_keys_do_not_multiply(spark):
    day = [dt.date(2021, 3, d) for d in (1, 2, 3)]
    snap = spark.createDataFrame([("a", "x"), ("a", "y"), (None, "z"), ("b", "x")], "k string, city string")
    one = spark.createDataFrame([], "k string, city string, create_dt date, update_dt date")
    for d in day:
        one = scd1_upsert(one, snap, "k", ["city"], d)
    assert sorted(r["k"] + r["city"] for r in one.collect()) == ["ay", "bx"]
    two = scd2_init(snap, "k", ["city"], dt.datetime(2021, 3, 1))
    two = scd2_step(two, snap.where(F.col("k") == "a"), "k", ["city"], dt.datetime(2021, 3, 2))
    assert sorted((r["k"], r["deleted_flg"]) for r in two.collect()) == [("a", False), ("b", False), ("b", True)]
