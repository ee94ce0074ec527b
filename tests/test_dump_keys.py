"""Dumps in byte ranges, and dense keys."""

import os
import random

import pytest

from fraudmart.sources.dump import read_insert_dump
from fraudmart.sources.tables import Warehouse
from pyspark.sql import types as T

ROW = T.StructType([T.StructField("id", T.LongType()), T.StructField("note", T.StringType()), T.StructField("day", T.DateType())])


def _lit(v):
    return "null" if v is None else "'" + str(v).replace("'", "''") + "'"


@pytest.mark.parametrize("size", [64, 997, 1 << 20])
def test_literals_over_lines_and_one_giant_insert(spark, tmp_root, size):
    rng = random.Random(size)
    bits = ["a", "O'Brien", ";", ";\n", "\n", "('x', 1)", "),\n(", "insert into other (id) values (1);", "\r\n", "é", " ", "--", "''"]
    rows = [(i, None if i % 11 == 0 else "".join(rng.choice(bits) for _ in range(rng.randint(0, 6))), "2021-03-01") for i in range(1500)]
    tuples = [f"({i}, {_lit(n)}, {_lit(d)})" for i, n, d in rows]
    text = "/* notes */\ncreate table notes(id integer, note text, day date);\n"
    text += "INSERT INTO notes (id, note,\n  day)\nVALUES " + ",\n  ".join(tuples[:1200]) + ";\n"  # one INSERT of many rows
    text += "insert into other (id) values (7); insert into other (id) values (8), (9);\n"
    text += "".join(f"insert into notes (id, note, day) \n\tvalues {t};\n" for t in tuples[1200:])
    text += "insert into other (id) values (10);"
    path = os.path.join(tmp_root, "dump.sql")
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(max(size, 2048)))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        frame = read_insert_dump(spark, path, "notes", ROW)
        got = sorted((r["id"], r["note"], str(r["day"])) for r in frame.collect())
        other = sorted(r[0] for r in read_insert_dump(spark, path, "other", T.StructType([T.StructField("id", T.LongType())])).collect())
        if size == 64:
            assert spark.read.text(path).rdd.getNumPartitions() > 10
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got == rows and other == [7, 8, 9, 10]


def test_dense_keys_stay_and_have_no_gaps(spark, tmp_root):
    wh = Warehouse(spark, os.path.join(tmp_root, "wh"))
    frame = lambda keys: spark.createDataFrame([(k,) for k in keys], "k string").repartition(5)
    first = {r["k"]: r["id"] for r in wh.key_ids("t", frame([f"b{i:03}" for i in range(300)] + [None, "b001"]), "k").collect()}
    assert sorted(first.values()) == list(range(1, 301)) and first["b000"] == 1
    again = {r["k"]: r["id"] for r in wh.key_ids("t", frame([f"a{i}" for i in range(50)] + ["b005"]), "k").collect()}
    assert {k: v for k, v in again.items() if k in first} == first
    assert sorted(again.values()) == list(range(1, 351)) and wh.key_ids("t", frame([]), "k").count() == 350
