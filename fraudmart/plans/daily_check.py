"""The production path as a check: a seed dump, then daily files of the whole events
table through ``bootstrap_dims`` and ``run_pending`` / the stream of files.

All events are put on three days (by day of the year, time of day kept); the files have
comma amounts. Every tenth event of day 1 comes with day 3's file, every seventh is
delivered again with day 2's; day 2's files come after day 3's; terminals change on day
2, and day 3's snapshot, which lacks some, is delivered twice, the first time wrong;
some passports listed on day 1 are told on day 3 only. The twin knows nothing of files:
the mart of each day with terminals and blacklist as of that day.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudmart.plans import adapters as A
from fraudmart.plans import oracle_sql as Q
from fraudmart.plans.checks import check, seed_dump
from fraudmart.plans.pipeline import bootstrap_dims, run_pending
from fraudmart.session import scratch_path
from fraudmart.sources.tables import Warehouse, list_files, move_file
from fraudmart.plans.workbook_files import write_workbook
from fraudmart.streaming.ingest import run_days_stream

FIRST = dt.date(2024, 1, 10)
DAYS = [FIRST + dt.timedelta(days=i) for i in range(3)]
TERMINAL_COLS = ["terminal_id", "terminal_type", "terminal_city", "terminal_address"]


def _events(spark: SparkSession, sf: str) -> DataFrame:
    """Daily-file rows with ``day`` (0-2) of the event."""
    ev = A.events_fact(spark, sf)
    day = (F.dayofyear("trans_date") % 3).alias("day")
    when = F.concat(F.date_add(F.lit(FIRST), F.col("day")).cast("string"), F.date_format("trans_date", " HH:mm:ss"))
    return ev.select("*", day).select(
        "day", F.col("trans_id").cast("string").alias("transaction_id"), when.alias("transaction_date"),
        F.replace(F.col("amt").cast("decimal(10,2)").cast("string"), F.lit("."), F.lit(",")).alias("amount"),
        F.col("card_num").cast("string").alias("card_num"), "oper_type", "oper_result",
        F.col("terminal").cast("string").alias("terminal"))


def _write_transactions(spark: SparkSession, sf: str, root: str) -> None:
    """All daily files in one partitioned job: a row goes to the files that deliver it."""
    n, day = F.col("transaction_id").cast("long"), F.col("day")
    files = F.when((day == 0) & (n % 10 == 0), F.array(F.lit(2))).when(
        (day == 0) & (n % 7 == 0), F.array(F.lit(0), F.lit(1))).otherwise(F.array(day))
    rows = _events(spark, sf).select("*", F.explode(files).alias("file"))
    name = F.concat(F.lit("transactions_"), F.date_format(F.date_add(F.lit(FIRST), F.col("file")), "ddMMyyyy"), F.lit(".txt"))
    (rows.withColumn("name", name).drop("day", "file").write.partitionBy("name")
         .option("sep", ";").option("header", True).csv(f"{root}/by_day"))


def _workbook_rows(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """(file, terminal columns) and (file, date, passport)."""
    term = A.terminals(spark, sf).select(*[F.col(c).cast("string") for c in TERMINAL_COLS])
    n, city = F.col("terminal_id").cast("long"), F.col("terminal_city")
    moved = F.when(n % 4 == 1, F.lit("MOVED")).otherwise(city)
    name = lambda kind, i: F.lit(f"{kind}_{DAYS[i]:%d%m%Y}.xlsx").alias("file")
    cols = lambda c: ["terminal_id", "terminal_type", c.alias("terminal_city"), "terminal_address"]
    books = (term.select(name("terminals", 0), *cols(city))
             .unionByName(term.select(name("terminals", 1), *cols(moved)))
             .unionByName(term.select(name("terminals", 2), *cols(F.lit("WRONG"))))
             .unionByName(term.where(n % 5 != 0).select(F.lit(f"terminals_again_{DAYS[2]:%d%m%Y}.xlsx").alias("file"), *cols(city))))
    own = A.table(spark, sf, "customer").where(F.col("c_acctbal") < 0).select(
        (F.col("c_custkey") % 3).cast("int").alias("entry"), F.col("c_name").alias("passport"), "c_custkey")
    told = F.when((F.col("entry") == 0) & (F.col("c_custkey") % 5 == 0), 2).otherwise(F.col("entry"))
    listed = own.select("*", F.explode(F.sequence(told, F.lit(2))).alias("f")).select(
        F.concat(F.lit("passport_blacklist_"), F.date_format(F.date_add(F.lit(FIRST), F.col("f")), "ddMMyyyy"), F.lit(".xlsx")).alias("file"),
        F.date_add(F.lit(FIRST), F.col("entry")).cast("string").alias("date"), "passport")
    return books, listed


def _write_books(rows: DataFrame, cols: list[str], root: str) -> None:
    def write(pdf):
        import os

        import pandas as pd
        path = os.path.join(root.removeprefix("file://"), pdf["file"].iloc[0])
        os.makedirs(os.path.dirname(path), exist_ok=True)  # the shared (mounted) folder
        write_workbook(path, {"sheet": [cols] + pdf[cols].values.tolist()})
        return pd.DataFrame({"path": [path]})

    rows.groupBy("file").applyInPandas(write, "path string").count()


def _place(spark: SparkSession, base: str, sub: str, names: list[str]) -> str:
    """The named files as one incoming folder; a day's transactions are as many files as
    tasks wrote them (``transactions_<k>_DDMMYYYY.txt``)."""
    target = f"{base}/{sub}"
    for name in names:
        if name.startswith("transactions_"):
            found = list_files(spark, f"{base}/by_day/name={name}")
            parts = [x for x in found if x.startswith("part-")]
            moves = [(f"{base}/by_day/name={name}/{x}", name.replace("_", f"_{k}_")) for k, x in enumerate(parts)]
        else:
            moves = [(f"{base}/books/{name}", name)]
        for source, to in moves:
            move_file(spark, source, f"{target}/{to}")
    return target


def _prepare(spark: SparkSession, sf: str) -> tuple[str, Warehouse]:
    base = scratch_path(spark, "daily-job")
    _write_transactions(spark, sf, base)
    books, listed = _workbook_rows(spark, sf)
    _write_books(books, TERMINAL_COLS, f"{base}/books")
    _write_books(listed, ["date", "passport"], f"{base}/books")
    seed_dump(spark, sf).write.text(f"{base}/seed")
    wh = Warehouse(spark, f"{base}/dwh")
    bootstrap_dims(spark, wh, f"{base}/seed", run_dt=FIRST)
    return base, wh


def _names(i: int, again: bool = False) -> list[str]:
    tag = f"{DAYS[i]:%d%m%Y}"
    if again:
        return [f"terminals_again_{tag}.xlsx"]
    return [f"transactions_{tag}.txt", f"terminals_{tag}.xlsx", f"passport_blacklist_{tag}.xlsx"]


def _mart_sql() -> str:
    secs = "date_trunc('second', trans_date) - date_trunc('day', trans_date)"
    ctes = [f"jf AS (SELECT trans_id, TIMESTAMP '{FIRST} 00:00:00' + to_days(CAST(dayofyear(trans_date) % 3 AS INTEGER)) + ({secs}) "
            "AS trans_date, CAST(amt AS DECIMAL(10,2)) AS amt, card_num, oper_result, terminal FROM ev)",
            f"jbl AS (SELECT c_name AS passport_num, DATE '{FIRST}' + CAST(c_custkey % 3 AS INTEGER) AS entry_dt "
            "FROM customer WHERE c_acctbal < 0)"]
    city = {0: "terminal_city", 1: "CASE WHEN terminal_id % 4 = 1 THEN 'MOVED' ELSE terminal_city END",
            2: "CASE WHEN terminal_id % 5 = 0 AND terminal_id % 4 = 1 THEN 'MOVED' ELSE terminal_city END"}
    parts = [Q.amount_lagged("jf", "ja")]
    reports = []
    for i, d in enumerate(DAYS):
        b = f"CAST({{t}} AS DATE) = DATE '{d}'"
        ctes.append(f"jt{i} AS (SELECT terminal_id, {city[i]} AS terminal_city FROM terminals)")
        parts += [f"jbl{i} AS (SELECT f.trans_id, f.trans_date, ch.* FROM jf f JOIN chain ch ON f.card_num = ch.card_num "
                  f"WHERE {Q.on(b, 'f.trans_date')} AND ch.passport_num IN (SELECT passport_num FROM jbl WHERE entry_dt <= DATE '{d}'))",
                  Q.hits_passport("jf", b, f"jpa{i}"), Q.hits_account("jf", b, f"jac{i}"),
                  Q.city_lagged("jf", f"jcw{i}").replace("JOIN terminals t", f"JOIN jt{i} t"),
                  Q.hits_city(True, b, f"jcw{i}", f"jci{i}"),
                  Q.hits_amount("INTERVAL 20 MINUTE", b, "ja", f"jam{i}")]
        for cte, name in ((f"jbl{i}", "blacklist"), (f"jpa{i}", "passport_expired"), (f"jac{i}", "account_expired"),
                          (f"jci{i}", "city"), (f"jam{i}", "amount")):
            reports.append(f"SELECT *, DATE '{d}' AS batch_dt FROM ({Q.report(cte, name)})")
    return Q.with_bank(*ctes, *parts) + " UNION ALL ".join(reports)


@check("daily_job_files", _mart_sql())
def daily_job_files(spark, sf):
    """Days 1 and 3, then day 2, then day 3's right terminals; the mart."""
    base, wh = _prepare(spark, sf)
    for step, names in enumerate((_names(0) + _names(2), _names(1), _names(2, again=True))):
        run_pending(spark, wh, _place(spark, base, f"in{step}", names), report_dt=A.REPORT_DT)
    return wh.read("rep_fraud")


@check("daily_job_stream", _mart_sql())
def daily_job_stream(spark, sf):
    """The same files through the stream, the last day's first; the mart."""
    base, wh = _prepare(spark, sf)
    for names in (_names(2), _names(0) + _names(1), _names(2, again=True)):
        run_days_stream(spark, wh, _place(spark, base, "in", names), f"{base}/checkpoint", report_dt=A.REPORT_DT)
    return wh.read("rep_fraud")
