"""Names and days of files, at a small cost a row."""

import datetime as dt

from pyspark.sql import functions as F

from fraudmart.functions import file_date_from_name, source_name


def test_names_and_days(spark):
    want = {"file:/a/b/name=transactions_01121998.txt/part-0.csv": ("transactions_01121998.txt", dt.date(1998, 12, 1)),
            "/x/transactions_01032021.txt": ("transactions_01032021.txt", dt.date(2021, 3, 1)),
            "transactions_31022021.txt": ("transactions_31022021.txt", None), "a/b": ("b", None), "": ("", None), "x/": ("", None),
            "/p/b_12345678.c/d/e.txt": ("e.txt", None), "a=b_12345678.txt/b_87654321.csv": ("b_12345678.txt", None)}
    df = spark.createDataFrame([(p,) for p in [*want, None]], "p string").withColumn("n", source_name("p"))
    got = {r["p"]: (r["n"], r["d"]) for r in df.withColumn("d", file_date_from_name("n")).collect()}
    assert got == {**want, None: (None, None)}


def test_name_is_matched_once(spark):
    df = spark.createDataFrame([("a/b",)], "p string").select(source_name("p").alias("n"), F.lit(1).alias("k"))
    plan = df.withColumn("d", file_date_from_name("n"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract") == 2  # one for the name, one for the day
    assert plan.count("substring_index(p") <= 2
