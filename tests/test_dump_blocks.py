"""Dumps cut into blocks of lines, and histories without a window."""

import datetime as dt
import os
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import types as T

from fraudmart.operators.scd import OPEN_END, _insert_among, one_per_key, scd2_insert
from fraudmart.sources.dump import dump_units, read_insert_dump

ROW = T.StructType([T.StructField("id", T.LongType()), T.StructField("note", T.StringType())])
OTHER = T.StructType([T.StructField("id", T.LongType())])
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def _lit(v):
    return "null" if v is None else "'" + str(v).replace("'", "''") + "'"


def _written(root, text):
    path = os.path.join(root, "dump.sql")
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)
    return path


@pytest.mark.parametrize("lines", [1, 4, 1000])
def test_blocks_begin_in_literals_tuples_and_headers(spark, tmp_root, lines):
    rng = random.Random(lines)
    bits = ["a", "''", ";", ";\n", "\n", "('x', 1)", "),\n(", "insert into other (id", "\ninsert into other (id) values (1);\n", "é", "("]
    rows = [(i, None if i % 9 == 0 else "".join(rng.choice(bits) for _ in range(rng.randint(0, 5)))) for i in range(240)]
    tuples = [f"({i},\n {_lit(n)})" if i % 5 == 0 else f"({i}, {_lit(n)})" for i, n in rows]
    text = "create table notes (id numeric(10,2),\n note text);\nINSERT INTO notes (id,\n\n note)\nVALUES " + ",\n".join(tuples[:120])
    text += ";\n(99, 'of no header');\n  insert  into other (id) values (7)\ninsert into other (id)\n values (8),\n\n(9);\n"
    text += "".join(f"insert into notes (NOTE, id) \n\tvalues ({_lit(n)},\t{i});{rng.choice(['', chr(10)])}" for i, n in rows[120:])
    path, old = _written(tmp_root, text), spark.conf.get(BATCH)
    spark.conf.set(BATCH, str(lines))
    try:
        got = sorted((r["id"], r["note"]) for r in read_insert_dump(spark, path, "notes", ROW).collect())
        other = sorted(r[0] for r in read_insert_dump(spark, path, "other", OTHER).collect())
    finally:
        spark.conf.set(BATCH, old)
    assert got == rows and other == [7, 8, 9]


def test_statements_of_one_header_are_one_unit(spark, tmp_root):
    path = _written(tmp_root, "".join(f"insert into notes (id, note) \n\tvalues ({i}, 'n');\n" for i in range(4000)))
    assert dump_units(spark, path).count() < 20  # it was a row a line and a shuffle of each text a scan
    assert read_insert_dump(spark, path, "notes", ROW).distinct().count() == 4000


@pytest.mark.parametrize("values", ["(id, note) values (1, 'a', 2)", "(id, note) values (1)", "(id, id) values (1, 2)"])
def test_rows_that_do_not_fit_their_columns_fail(spark, tmp_root, values):
    with pytest.raises(PySparkException):
        read_insert_dump(spark, _written(tmp_root, f"insert into notes {values};\n"), "notes", ROW).collect()


def test_last_snapshot_is_as_by_windows(spark):
    rng, day, second = random.Random(3), lambda d: dt.datetime(2024, 1, d), dt.timedelta(seconds=1)
    hist, snap = [], []
    for i in range(400):
        start = day(rng.randint(1, 12))
        for _ in range(rng.choice([0, 1, 1, 1, 2, 3])):
            end = rng.choice([OPEN_END, max(start, day(9)) + dt.timedelta(days=rng.randint(1, 4)) - second])
            hist.append((f"k{i}", rng.choice(["x", "y", None]), start, end, rng.random() < 0.3, rng.choice([None, dt.date(2024, 1, 1)]), None))
            start = (start if end == OPEN_END else end) + second
        snap += [(rng.choice([f"k{i}", f"k{i}", None]), rng.choice(["x", "y", None])) for _ in range(rng.choice([0, 1, 1, 2]))]
    hist = spark.createDataFrame(hist, "k string, a string, effective_from timestamp_ntz, effective_to timestamp_ntz, deleted_flg boolean, "
                                       "create_dt date, update_dt date")
    snap = spark.createDataFrame(snap, "k string, a string")
    for h in (hist, hist.drop("create_dt", "update_dt"), hist.where("false")):
        want = _insert_among(h, one_per_key(snap, "k", ["a"]), "k", ["a"], day(10)).collect()
        got = scd2_insert(h, snap, "k", ["a"], day(10)).collect()
        assert sorted(map(repr, got)) == sorted(map(repr, want)) and len(got) > 200
