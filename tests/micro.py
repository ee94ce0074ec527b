"""Hand-made bank tables for the golden cases of FIXTURES.md §3."""

import datetime as dt
from decimal import Decimal

from fraudmart import schemas
from fraudmart.operators.enrich import Dims

T = dt.datetime


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def fact(spark, rows):
    """rows: (trans_id, trans_date, amt, card_num, oper_result, terminal)."""
    data = [(tid, ts(when), Decimal(str(amt)), card, "PAYMENT", res, term, None, None, ts(when).date())
            for tid, when, amt, card, res, term in rows]
    return spark.createDataFrame(data, schemas.FACT_TRANSACTIONS)


def dims(spark, cards=("c1", "c2", "c3", "c4", "c5"), valid_to=dt.date(2030, 1, 1),
         passport_valid_to=dt.date(2030, 1, 1), blacklist=(), patronymic="Petrovich"):
    card_rows = [(c, f"acc-{c}", None, None) for c in cards]
    acc_rows = [(f"acc-{c}", valid_to, f"cl-{c}", None, None) for c in cards]
    cli_rows = [(f"cl-{c}", "Ivanov", "Ivan", patronymic, None, f"pass-{c}", passport_valid_to,
                 f"+7 900 000-00-0{i}", None, None) for i, c in enumerate(cards)]
    terms = [("A1", "POS", "Moscow", "addr 1", None, None), ("P2", "POS", "Kazan", "addr 2", None, None)]
    bl = [(p, dt.date(2021, 3, 1), None, None) for p in blacklist]
    return Dims(spark.createDataFrame(card_rows, schemas.DIM_CARDS),
                spark.createDataFrame(acc_rows, schemas.DIM_ACCOUNTS),
                spark.createDataFrame(cli_rows, schemas.DIM_CLIENTS),
                spark.createDataFrame(terms, schemas.DIM_TERMINALS),
                spark.createDataFrame(bl, schemas.FACT_BLACKLIST))


def staged(spark, fact_df, day: dt.date):
    """Staging frame of one day: the file's ``transaction_date`` column."""
    from pyspark.sql import functions as F
    return fact_df.where(F.col("trans_dt") == F.lit(day.isoformat()).cast("date")).select(
        F.col("trans_date").alias("transaction_date"))


# FIXTURES §3.1 — card c1, A1 = Moscow, P2 = Kazan, ZZ unknown terminal.
CITY_ROWS = [
    ("01", "2021-03-01 10:00:00", 100, "c1", "SUCCESS", "A1"),
    ("02", "2021-03-01 10:59:59", 100, "c1", "SUCCESS", "P2"),
    ("03", "2021-03-01 11:59:59", 100, "c1", "SUCCESS", "A1"),
    ("04", "2021-03-01 12:10:00", 100, "c1", "SUCCESS", "ZZ"),
    ("05", "2021-03-01 12:20:00", 100, "c1", "SUCCESS", "P2"),
    ("06", "2021-03-02 18:00:00", 100, "c1", "SUCCESS", "A1"),
    ("07", "2021-03-02 18:10:00", 100, "c1", "SUCCESS", "A1"),
]

# FIXTURES §3.2 — amount guessing.
AMOUNT_ROWS = [
    ("11", "2021-03-01 08:00:00", 400, "c2", "REJECT", "A1"),
    ("12", "2021-03-01 08:05:00", 300, "c2", "REJECT", "A1"),
    ("13", "2021-03-01 08:10:00", 200, "c2", "REJECT", "A1"),
    ("14", "2021-03-01 08:19:59", 100, "c2", "SUCCESS", "A1"),
    ("21", "2021-03-01 08:00:00", 400, "c3", "REJECT", "A1"),
    ("22", "2021-03-01 08:05:00", 300, "c3", "REJECT", "A1"),
    ("23", "2021-03-01 08:10:00", 200, "c3", "REJECT", "A1"),
    ("24", "2021-03-01 08:20:00", 100, "c3", "SUCCESS", "A1"),
    ("31", "2021-03-01 08:00:00", 400, "c4", "REJECT", "A1"),
    ("32", "2021-03-01 08:01:00", 300, "c4", "REJECT", "A1"),
    ("33", "2021-03-01 08:02:00", 300, "c4", "REJECT", "A1"),
    ("34", "2021-03-01 08:03:00", 100, "c4", "SUCCESS", "A1"),
    ("41", "2021-03-01 08:00:00", 300, "c5", "REJECT", "A1"),
    ("42", "2021-03-01 08:01:00", 200, "c5", "REJECT", "A1"),
    ("43", "2021-03-01 08:02:00", 100, "c5", "SUCCESS", "A1"),
]
DAY2_ROW = [("51", "2021-03-02 09:00:00", 50, "c1", "SUCCESS", "A1")]
