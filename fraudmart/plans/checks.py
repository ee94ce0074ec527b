"""Registered checks: one Spark query per operator, each with its SQL twin.

Every check reads the given test tables through ``plans.adapters`` (whole
tables, no sampling). Checks of file sources first let Spark write files
derived from the tables into the shared scratch folder, then read them back.
``CHECKS[name] = (fn(spark, sf_dir) -> DataFrame, duckdb_sql | None)``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudmart import schemas
from fraudmart.functions import EVENT_TYPES, date_lit, fio, ts_lit
from fraudmart.operators import enrich as E
from fraudmart.operators import load as L
from fraudmart.operators import rules as R
from fraudmart.operators import scd as SCD
from fraudmart.operators.lag import lag_columns
from fraudmart.plans import adapters as A
from fraudmart.plans import oracle_sql as Q
from fraudmart.plans.mart import fraud_report
from fraudmart.plans.pipeline import bootstrap_dims, ledger_pending, ledger_rows, run_days_frames
from fraudmart.session import scratch_path
from fraudmart.sources.delimited import TIMESTAMP_FORMAT, read_delimited
from fraudmart.sources.dump import read_insert_dump
from fraudmart.sources.tables import Warehouse, export_report
from fraudmart.plans.workbook_files import write_workbook
from fraudmart.sources.workbook import read_workbook

CHECKS: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}
AMOUNT_CHECK_LIMIT_S = 3 * 86400  # the 20-minute default finds nothing in the test events


def check(name: str, sql: str | None):
    def deco(fn):
        CHECKS[name] = (fn, sql)
        return fn
    return deco


def _bank(spark, sf):
    return A.lineitem_fact(spark, sf), A.events_fact(spark, sf), A.dims(spark, sf)


def _tx_file_layout(fact: DataFrame) -> DataFrame:
    """A fact in the daily file's column layout (what the bank sends)."""
    return fact.select(
        F.col("trans_id").cast("string").alias("transaction_id"),
        F.col("trans_date").alias("transaction_date"),
        F.col("amt").cast("decimal(10,2)").alias("amount"),
        F.col("card_num").cast("string").alias("card_num"),
        "oper_type", "oper_result",
        F.col("terminal").cast("string").alias("terminal"))


def _day(fact: DataFrame, day: dt.date) -> DataFrame:
    return E.range_filter(fact, dt.datetime(day.year, day.month, day.day),
                          dt.datetime(day.year, day.month, day.day) + dt.timedelta(days=1), part=None)


def _month(ts="trans_date") -> F.Column:
    return F.to_date(F.trunc(ts, "month"))


def _write_files(spark, sf, root: str) -> str:
    """The whole fact as daily files, a file a month (of its first day), in one
    partitioned job; returns a glob of the folders, each named as its file."""
    fact = A.lineitem_fact(spark, sf)
    name = F.concat(F.lit("transactions_"), F.date_format(_month("transaction_date"), "ddMMyyyy"), F.lit(".txt"))
    rows = _tx_file_layout(fact).withColumn("name", name)
    (rows.write.partitionBy("name").option("sep", ";").option("header", True)
         .option("timestampNTZFormat", TIMESTAMP_FORMAT).csv(root))
    return f"{root}/name=transactions_*"


TX_FILE_SQL = ("SELECT CAST(trans_id AS VARCHAR) AS transaction_id, trans_date AS transaction_date, "
               "CAST(amt AS DECIMAL(10,2)) AS amount, CAST(card_num AS VARCHAR) AS card_num, "
               "oper_type, oper_result, CAST(terminal AS VARCHAR) AS terminal FROM fact")
MONTH_SQL = "CAST(date_trunc('month', trans_date) AS DATE)"
HALF = dt.date(2000, 1, 1)  # cuts the table into two batches
CHAIN_SQL = Q.on(Q.CHAIN_BATCH)
CITY_SQL = Q.on(Q.CITY_BATCH)


# =============================================================== rules (R1-R5)
@check("rule_blacklist", Q.with_bank(Q.hits_blacklist()) + Q.report("h_bl", "blacklist"))
def rule_blacklist(spark, sf):
    fact, _, dims = _bank(spark, sf)
    hits = R.hits_blacklist(fact, dims, A.chain_batch(spark, sf))
    return R.to_report(hits, EVENT_TYPES["blacklist"], A.REPORT_DT)


@check("rule_passport_expired", Q.with_bank(Q.hits_passport()) + Q.report("h_pass", "passport_expired"))
def rule_passport_expired(spark, sf):
    fact, _, dims = _bank(spark, sf)
    hits = R.hits_passport_expired(fact, dims, A.chain_batch(spark, sf))
    return R.to_report(hits, EVENT_TYPES["passport_expired"], A.REPORT_DT)


@check("rule_account_expired", Q.with_bank(Q.hits_account()) + Q.report("h_acc", "account_expired"))
def rule_account_expired(spark, sf):
    fact, _, dims = _bank(spark, sf)
    hits = R.hits_account_expired(fact, dims, A.chain_batch(spark, sf))
    return R.to_report(hits, EVENT_TYPES["account_expired"], A.REPORT_DT)


@check("rule_city_documented",
       Q.with_bank(Q.city_lagged(), Q.hits_city(True)) + Q.report("h_city", "city"))
def rule_city_documented(spark, sf):
    _, ev, dims = _bank(spark, sf)
    hits = R.hits_city(ev, dims, A.city_batch(spark, sf), E.DOCUMENTED)
    return R.to_report(hits, EVENT_TYPES["city"], A.REPORT_DT)


@check("rule_city_observed",
       Q.with_bank(Q.city_lagged(), Q.hits_city(False)) + Q.report("h_city", "city"))
def rule_city_observed(spark, sf):
    _, ev, dims = _bank(spark, sf)
    hits = R.hits_city(ev, dims, A.city_batch(spark, sf, staged=True), E.OBSERVED)
    return R.to_report(hits, EVENT_TYPES["city"], A.REPORT_DT)


@check("rule_amount_observed",
       Q.with_bank(Q.amount_lagged(), Q.hits_amount(None)) + Q.report("h_amt", "amount"))
def rule_amount_observed(spark, sf):
    _, ev, dims = _bank(spark, sf)
    hits = R.hits_amount(ev, dims, A.city_batch(spark, sf, staged=True), E.OBSERVED)
    return R.to_report(hits, EVENT_TYPES["amount"], A.REPORT_DT)


@check("rule_amount_documented",
       Q.with_bank(Q.amount_lagged(), Q.hits_amount("INTERVAL 3 DAY")) + Q.report("h_amt", "amount"))
def rule_amount_documented(spark, sf):
    _, ev, dims = _bank(spark, sf)
    hits = R.hits_amount(ev, dims, None, E.DOCUMENTED, limit_s=AMOUNT_CHECK_LIMIT_S)
    return R.to_report(hits, EVENT_TYPES["amount"], A.REPORT_DT)


# ================================================================ mart (M1, X1)
_REP_SQL = (Q.with_bank(Q.hits_blacklist(), Q.hits_passport(), Q.hits_account(), Q.city_lagged(),
                        Q.hits_city(True), Q.amount_lagged(),
                        Q.hits_amount("INTERVAL 3 DAY", Q.CITY_BATCH))
            + " UNION ALL ".join([Q.report("h_bl", "blacklist"), Q.report("h_pass", "passport_expired"),
                                  Q.report("h_acc", "account_expired"), Q.report("h_city", "city"),
                                  Q.report("h_amt", "amount")]))


@check("rep_fraud", _REP_SQL)
def rep_fraud(spark, sf):
    fact, ev, dims = _bank(spark, sf)
    return fraud_report(fact, dims, A.chain_batch(spark, sf), E.DOCUMENTED, A.REPORT_DT,
                        window_fact=ev, window_batch=A.city_batch(spark, sf),
                        options={"amount": {"limit_s": AMOUNT_CHECK_LIMIT_S}})


PIPE_DAYS = [dt.date(2024, 1, 10), dt.date(2024, 1, 11), dt.date(2024, 1, 12)]


_REP_OBS_SQL = (Q.with_bank(Q.hits_blacklist(), Q.hits_passport(), Q.hits_account(), Q.city_lagged(),
                            Q.hits_city(False), Q.amount_lagged(), Q.hits_amount(None))
                + " UNION ALL ".join([Q.report("h_bl", "blacklist"),
                                      Q.report("h_pass", "passport_expired", Q.REPORT_DAY),
                                      Q.report("h_acc", "account_expired"), Q.report("h_city", "city"),
                                      Q.report("h_amt", "amount")]))


@check("rep_fraud_observed", _REP_OBS_SQL)
def rep_fraud_observed(spark, sf):
    """The mart in observed mode: batch by staged timestamp values, limits reduced
    to "a previous event exists", amount rule over all history, rule 2 stamped
    with the run date."""
    fact, ev, dims = _bank(spark, sf)
    return fraud_report(fact, dims, A.chain_batch(spark, sf, staged=True), E.OBSERVED, A.REPORT_DT,
                        window_fact=ev, window_batch=A.city_batch(spark, sf, staged=True))


def _daily_sql():
    parts, ctes = [], [Q.city_lagged("ev"), Q.amount_lagged("ev")]
    for d in PIPE_DAYS:
        nxt = d + dt.timedelta(days=1)
        b = f"{{t}} >= TIMESTAMP '{d} 00:00:00' AND {{t}} < TIMESTAMP '{nxt} 00:00:00'"
        tag = f"{d:%d}"
        ctes += [Q.hits_blacklist("ev", b, f"bl{tag}"), Q.hits_passport("ev", b, f"pa{tag}"),
                 Q.hits_account("ev", b, f"ac{tag}"), Q.hits_city(True, b, name=f"ci{tag}"),
                 Q.hits_amount("INTERVAL 20 MINUTE", b, name=f"am{tag}")]
        for cte, ev_name in [(f"bl{tag}", "blacklist"), (f"pa{tag}", "passport_expired"),
                             (f"ac{tag}", "account_expired"), (f"ci{tag}", "city"), (f"am{tag}", "amount")]:
            parts.append(f"SELECT *, DATE '{d}' AS batch_dt FROM ({Q.report(cte, ev_name)})")
    return Q.with_bank(*ctes) + " UNION ALL ".join(parts)


@check("daily_pipeline", _daily_sql())
def daily_pipeline(spark, sf):
    """Three daily batches of ``events`` through load (anti-join) and all five
    rules with their default limits; lineage is cut after each day."""
    _, ev, dims = _bank(spark, sf)
    history = E.range_filter(ev, None, dt.datetime(2024, 1, 10), part=None)
    days = [(E.Batch.day(d), _day(ev, d)) for d in PIPE_DAYS]
    return run_days_frames(days, dims, history, E.DOCUMENTED, A.REPORT_DT)


# ============================================================ loads (J1, L1-L6)
@check("anti_join_new_keys", Q.with_bank() + (
    "SELECT s.card_num, s.account_num, s.create_dt FROM cards s "
    "LEFT JOIN (SELECT card_num FROM cards WHERE create_dt < DATE '1998-01-01') d "
    "ON s.card_num = d.card_num WHERE s.create_dt >= DATE '1997-01-01' AND d.card_num IS NULL"))
def anti_join_new_keys(spark, sf):
    cards = A.cards(spark, sf).select("card_num", "account_num", "create_dt")
    staged = cards.where(F.col("create_dt") >= date_lit("1997-01-01"))
    existing = cards.where(F.col("create_dt") < date_lit("1998-01-01"))
    return L.insert_new(staged, existing, "card_num")


def _seed_cards(spark, sf):
    return A.cards(spark, sf).select(F.col("card_num").cast("string"),
                                     F.col("account_num").cast("string").alias("account"),
                                     "create_dt", "update_dt")


@check("load_dim_cards", Q.with_bank() + (
    "SELECT CAST(card_num AS VARCHAR) AS card_num, CAST(account_num AS VARCHAR) AS account_num, "
    "create_dt, CAST(NULL AS DATE) AS update_dt FROM cards WHERE create_dt >= DATE '1998-01-01'"))
def load_dim_cards(spark, sf):
    seed = _seed_cards(spark, sf)
    existing = L.conform(L.rename_columns(seed.where(F.col("create_dt") < date_lit("1998-01-01")),
                                          L.RENAMES["dwh_dim_cards"]), schemas.DIM_CARDS)
    return L.load_new(seed, existing, "dwh_dim_cards")


def _seed_accounts(spark, sf):
    return A.accounts(spark, sf).select(F.col("account_num").cast("string").alias("account"), "valid_to",
                                        F.col("client").cast("string"), "create_dt", "update_dt")


@check("load_dim_accounts", Q.with_bank() + (
    "SELECT CAST(account_num AS VARCHAR) AS account_num, valid_to, CAST(client AS VARCHAR) AS client, "
    "CAST(NULL AS DATE) AS create_dt, CAST(NULL AS DATE) AS update_dt FROM accounts "
    "WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')"))
def load_dim_accounts(spark, sf):
    seed = _seed_accounts(spark, sf)
    cust = A.table(spark, sf, "customer")
    known = cust.where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).select(
        F.col("c_custkey").cast("string").alias("account_num"))
    existing = L.conform(L.rename_columns(seed, L.RENAMES["dwh_dim_accounts"])
                         .join(known, "account_num", "left_semi"), schemas.DIM_ACCOUNTS)
    return L.load_new(seed, existing, "dwh_dim_accounts")


def _seed_clients(spark, sf):
    return L.conform(A.clients(spark, sf), schemas.SEED_CLIENTS)


@check("load_dim_clients", Q.with_bank() + (
    "SELECT CAST(client_id AS VARCHAR) AS client_id, last_name, first_name, patronymic, "
    "CAST(NULL AS DATE) AS date_of_birth, passport_num, passport_valid_to, phone, "
    "CAST(NULL AS DATE) AS create_dt, CAST(NULL AS DATE) AS update_dt FROM clients "
    "WHERE NOT (c_acctbal < 5000)"))
def load_dim_clients(spark, sf):
    seed = _seed_clients(spark, sf)
    rich = A.table(spark, sf, "customer").where(F.col("c_acctbal") < 5000).select(
        F.col("c_custkey").cast("string").alias("client_id"))
    existing = L.conform(seed.join(rich, "client_id", "left_semi"), schemas.DIM_CLIENTS)
    return L.load_new(seed, existing, "dwh_dim_clients")


def _terminal_snapshot(spark, sf):
    return A.terminals(spark, sf).select(F.col("terminal_id").cast("string"), "terminal_type",
                                         "terminal_city", "terminal_address")


@check("load_dim_terminals", Q.with_bank() + (
    "SELECT CAST(terminal_id AS VARCHAR) AS terminal_id, terminal_type, terminal_city, terminal_address, "
    "CAST(NULL AS DATE) AS create_dt, CAST(NULL AS DATE) AS update_dt FROM terminals WHERE j >= 2"))
def load_dim_terminals(spark, sf):
    snap = L.add_null_columns(_terminal_snapshot(spark, sf))
    existing = L.conform(snap.where(F.col("terminal_id").cast("bigint") < 50), schemas.DIM_TERMINALS)
    return L.load_new(snap, existing, "dwh_dim_terminals")


@check("load_fact_transactions", Q.with_bank(
    f"stg AS ({TX_FILE_SQL} WHERE {CHAIN_SQL})",
    "dwh AS (SELECT transaction_id AS trans_id FROM stg "
    "WHERE transaction_date < TIMESTAMP '2000-01-15 00:00:00')") + (
    "SELECT s.transaction_id AS trans_id, s.transaction_date AS trans_date, s.amount AS amt, s.card_num, "
    "s.oper_type, s.oper_result, s.terminal, CAST(NULL AS DATE) AS create_dt, "
    "CAST(NULL AS DATE) AS update_dt, CAST(s.transaction_date AS DATE) AS trans_dt "
    "FROM stg s LEFT JOIN dwh d ON s.transaction_id = d.trans_id WHERE d.trans_id IS NULL"))
def load_fact_transactions(spark, sf):
    fact = A.lineitem_fact(spark, sf)
    staged = _tx_file_layout(E.range_filter(fact, *A.CHAIN_BATCH, part=None))
    existing = L.conform(L.rename_columns(
        staged.where(F.col("transaction_date") < ts_lit(dt.datetime(2000, 1, 15))),
        L.RENAMES["dwh_fact_transactions"]), schemas.FACT_TRANSACTIONS)
    return L.load_new(staged, existing, "dwh_fact_transactions")


def _blacklist_file(spark, sf):
    return A.blacklist(spark, sf).select(F.col("entry_dt").alias("date"),
                                         F.col("passport_num").alias("passport"))


@check("load_fact_blacklist", Q.with_bank() + (
    "SELECT passport_num, entry_dt, CAST(NULL AS DATE) AS create_dt, CAST(NULL AS DATE) AS update_dt "
    "FROM blacklist WHERE entry_dt >= DATE '2000-01-01'"))
def load_fact_blacklist(spark, sf):
    file = _blacklist_file(spark, sf)
    existing = L.conform(L.rename_columns(file.where(F.col("date") < date_lit("2000-01-01")),
                                          L.RENAMES["dwh_fact_passport_blacklist"]),
                         schemas.FACT_BLACKLIST)
    return L.load_new(file, existing, "dwh_fact_passport_blacklist")


# ====================================================================== joins
@check("join_inner_chain", Q.with_bank() + (
    "SELECT f.trans_id, f.trans_date, f.card_num, ch.account_num, ch.client, ch.passport_num "
    f"FROM fact f JOIN chain ch ON f.card_num = ch.card_num WHERE {Q.on(Q.CHAIN_BATCH, 'f.trans_date')}"))
def join_inner_chain(spark, sf):
    fact, _, dims = _bank(spark, sf)
    tx = E.select_batch(fact, A.chain_batch(spark, sf)).select("trans_id", "trans_date", "card_num")
    return E.with_client(tx, dims).select("trans_id", "trans_date", "card_num", "account_num",
                                          "client", "passport_num")


@check("join_left_chain", Q.with_bank() + (
    "SELECT f.trans_id, f.trans_date, cl.passport_num, cl.passport_valid_to FROM fact f "
    "LEFT JOIN cards c ON f.card_num = c.card_num LEFT JOIN accounts a ON c.account_num = a.account_num "
    "LEFT JOIN clients cl ON a.client = cl.client_id "
    f"WHERE {Q.on(Q.CHAIN_BATCH, 'f.trans_date')} "
    "AND CAST(f.trans_date AS DATE) >= cl.passport_valid_to"))
def join_left_chain(spark, sf):
    """The left-outer form of rule 2: the WHERE on the client makes it inner."""
    fact, _, dims = _bank(spark, sf)
    tx = E.select_batch(fact, A.chain_batch(spark, sf)).select("trans_id", "trans_date", "card_num")
    chained = E.with_client(tx, dims, "left", extra=("passport_valid_to",))
    return (chained.where(R.expired("passport_valid_to", "trans_date"))
                   .select("trans_id", "trans_date", "passport_num", "passport_valid_to"))


@check("join_fact_terminal", Q.with_bank() + (
    "SELECT f.trans_id, f.card_num, f.trans_date, f.terminal, t.terminal_city FROM ev f "
    "JOIN terminals t ON f.terminal = t.terminal_id"))
def join_fact_terminal(spark, sf):
    _, ev, dims = _bank(spark, sf)
    terms = dims.terminals.select(F.col("terminal_id").alias("terminal"), "terminal_city")
    return ev.select("trans_id", "card_num", "trans_date", "terminal").join(terms, "terminal", "inner")


@check("semi_join_batch", Q.with_bank() + (
    "SELECT trans_id, trans_date FROM fact WHERE trans_date IN "
    f"(SELECT trans_date FROM fact WHERE {CHAIN_SQL})"))
def semi_join_batch(spark, sf):
    fact = A.lineitem_fact(spark, sf)
    staged = A.chain_batch(spark, sf, staged=True).staged
    return E.semi_join_batch(fact.select("trans_id", "trans_date"), staged)


@check("semi_join_blacklist", Q.with_bank() + (
    "SELECT client_id, passport_num FROM clients WHERE passport_num IN (SELECT passport_num FROM blacklist)"))
def semi_join_blacklist(spark, sf):
    dims = A.dims(spark, sf)
    return E.blacklisted(dims.clients.select("client_id", "passport_num"), dims.blacklist)


@check("join_on_with_in", Q.with_bank() + (
    "SELECT f.trans_id, f.trans_date, a.account_num, a.valid_to FROM fact f "
    f"JOIN cards c ON f.card_num = c.card_num AND f.trans_date IN (SELECT trans_date FROM fact WHERE {CHAIN_SQL}) "
    "JOIN accounts a ON c.account_num = a.account_num JOIN clients cl ON a.client = cl.client_id "
    "WHERE CAST(f.trans_date AS DATE) >= a.valid_to"))
def join_on_with_in(spark, sf):
    """Rule 3 with its batch IN placed in the join condition: filter first, same rows."""
    fact, _, dims = _bank(spark, sf)
    hits = R.hits_account_expired(fact, dims, A.chain_batch(spark, sf, staged=True), E.OBSERVED)
    return hits.select("trans_id", "trans_date", "account_num", "valid_to")


@check("in_outer_column", Q.with_bank() + (
    "SELECT trans_id, trans_date FROM ev WHERE trans_date IN "
    f"(SELECT ev.trans_date FROM (SELECT trans_date AS transaction_date FROM ev WHERE {CITY_SQL}) s)"))
def in_outer_column(spark, sf):
    """``ts IN (SELECT <outer ts> FROM staging)`` = staging is not empty."""
    ev = A.events_fact(spark, sf).select("trans_id", "trans_date")
    return E.staging_nonempty(ev, A.city_batch(spark, sf, staged=True).staged)


# ==================================================================== windows
def _city_lagged(spark, sf):
    _, ev, dims = _bank(spark, sf)
    terms = dims.terminals.select(F.col("terminal_id").alias("terminal"), "terminal_city")
    src = (ev.select("trans_id", "trans_date", "card_num", "terminal")
             .join(terms, "terminal", "inner").drop("terminal"))
    return lag_columns(src, ["card_num"], R.ORDER,
                       {"lag_city": ("terminal_city", 1), "lag_trans_date": ("trans_date", 1)})


def _amount_lagged(spark, sf, names=tuple(R.AMOUNT_LAGS)):
    """The amount rule's lags; a check asking for some of them computes only those."""
    lags = {n: R.AMOUNT_LAGS[n] for n in names}
    cols = ["trans_id", "trans_date", "card_num"] + sorted(
        {c for c, _ in lags.values()} - {"trans_id", "trans_date", "card_num"})
    ev = A.events_fact(spark, sf).select(*cols)
    return lag_columns(ev, ["card_num"], R.ORDER, lags)


_CITY_LAG_SQL = Q.with_bank(Q.city_lagged())
_AMT_LAG_SQL = Q.with_bank(Q.amount_lagged())


@check("lag_city", _CITY_LAG_SQL + "SELECT trans_id, card_num, trans_date, terminal_city, lag_city FROM lag_city_w")
def lag_city(spark, sf):
    return _city_lagged(spark, sf).select("trans_id", "card_num", "trans_date", "terminal_city", "lag_city")


@check("lag_event_time", _CITY_LAG_SQL + "SELECT trans_id, trans_date, lag_trans_date FROM lag_city_w")
def lag_event_time(spark, sf):
    return _city_lagged(spark, sf).select("trans_id", "trans_date", "lag_trans_date")


@check("lag3_event_time", _AMT_LAG_SQL + "SELECT trans_id, trans_date, prev_date FROM lag_amt_w")
def lag3_event_time(spark, sf):
    return _amount_lagged(spark, sf, ("prev_date",)).select("trans_id", "trans_date", "prev_date")


@check("lag_amounts", _AMT_LAG_SQL + "SELECT trans_id, amt, prev_1_amt, prev_2_amt, prev_3_amt FROM lag_amt_w")
def lag_amounts(spark, sf):
    amts = ("prev_1_amt", "prev_2_amt", "prev_3_amt")
    return _amount_lagged(spark, sf, amts).select("trans_id", "amt", *amts)


@check("lag_results", _AMT_LAG_SQL + "SELECT trans_id, oper_result, prev_1_res, prev_2_res, prev_3_res FROM lag_amt_w")
def lag_results(spark, sf):
    res = ("prev_1_res", "prev_2_res", "prev_3_res")
    return _amount_lagged(spark, sf, res).select("trans_id", "oper_result", *res)


@check("cte_lag", _AMT_LAG_SQL + (
    f"SELECT trans_id, trans_date, card_num, amt FROM lag_amt_w WHERE {Q.AMOUNT_PATTERN} "
    f"AND prev_date IS NOT NULL AND EXISTS (SELECT 1 FROM ev WHERE {CITY_SQL})"))
def cte_lag(spark, sf):
    """Rule 5 over all history as Spark SQL: guessing patterns, kept if anything is staged."""
    _amount_lagged(spark, sf).createOrReplaceTempView("fm_card_steps")
    A.city_batch(spark, sf, staged=True).staged.createOrReplaceTempView("fm_staged_times")
    return spark.sql(f"""
        WITH guessed AS (
            SELECT trans_id, trans_date, card_num, amt FROM fm_card_steps
            WHERE prev_date IS NOT NULL AND {Q.AMOUNT_PATTERN}),
        batch AS (SELECT count(*) AS n FROM fm_staged_times)
        SELECT guessed.* FROM guessed WHERE (SELECT n FROM batch) > 0""")


# ============================================================ projections etc.
@check("concat_fio", Q.with_bank() + (
    "SELECT client_id, last_name || ' ' || first_name || ' ' || patronymic AS fio FROM clients"))
def concat_fio(spark, sf):
    return A.clients(spark, sf).select("client_id", fio().alias("fio"))


@check("rename_columns", Q.with_bank() + (
    "SELECT transaction_id AS trans_id, transaction_date AS trans_date, amount AS amt, card_num, "
    f"oper_type, oper_result, terminal FROM ({TX_FILE_SQL}) s"))
def rename_columns(spark, sf):
    staged = _tx_file_layout(A.lineitem_fact(spark, sf))
    return L.rename_columns(staged, L.RENAMES["dwh_fact_transactions"])


_TAG_SQL = (Q.with_bank(Q.hits_blacklist(), Q.hits_passport(), Q.hits_account(), Q.city_lagged(),
                        Q.hits_city(True), Q.amount_lagged(), Q.hits_amount("INTERVAL 3 DAY")) +
            " UNION ALL ".join(f"SELECT CAST(trans_id AS VARCHAR) AS trans_id, '{Q.EVENT[e]}' AS event_type FROM {h}"
                               for h, e in [("h_bl", "blacklist"), ("h_pass", "passport_expired"),
                                            ("h_acc", "account_expired"), ("h_city", "city"),
                                            ("h_amt", "amount")]))


@check("tag_event_type", _TAG_SQL)
def tag_event_type(spark, sf):
    fact, ev, dims = _bank(spark, sf)
    b, cb = A.chain_batch(spark, sf), A.city_batch(spark, sf)
    parts = [(R.hits_blacklist(fact, dims, b), "blacklist"),
             (R.hits_passport_expired(fact, dims, b), "passport_expired"),
             (R.hits_account_expired(fact, dims, b), "account_expired"),
             (R.hits_city(ev, dims, cb), "city"),
             (R.hits_amount(ev, dims, None, limit_s=AMOUNT_CHECK_LIMIT_S), "amount")]
    out = None
    for hits, name in parts:
        df = hits.select(F.col("trans_id").cast("string").alias("trans_id"),
                         F.lit(EVENT_TYPES[name]).alias("event_type"))
        out = df if out is None else out.unionByName(df)
    return out


@check("stamp_report", Q.with_bank(Q.hits_passport(batch=(
    f"{{t}} IN (SELECT trans_date FROM fact WHERE {CHAIN_SQL})")))
    + Q.report("h_pass", "passport_expired", Q.REPORT_DAY))
def stamp_report(spark, sf):
    """Observed mode: rule 2 is stamped with the run date, the others with the run time."""
    fact, _, dims = _bank(spark, sf)
    rep = fraud_report(fact, dims, A.chain_batch(spark, sf, staged=True), E.OBSERVED, A.REPORT_DT,
                       rules=("passport_expired",))
    return rep


@check("star_projection", _AMT_LAG_SQL + (
    "SELECT trans_id, trans_date, card_num, amt, oper_result, prev_date, prev_1_amt, prev_2_amt, "
    f"prev_3_amt, prev_1_res, prev_2_res, prev_3_res FROM lag_amt_w WHERE {Q.AMOUNT_PATTERN} "
    "AND prev_date IS NOT NULL"))
def star_projection(spark, sf):
    """``SELECT *`` of the amount CTE, as an explicit column list."""
    lagged = _amount_lagged(spark, sf)
    return lagged.where(R.amount_pattern(None)).select(
        "trans_id", "trans_date", "card_num", "amt", "oper_result", *R.AMOUNT_LAGS)


@check("filter_eq", _AMT_LAG_SQL + (
    "SELECT trans_id FROM lag_amt_w WHERE oper_result = 'SUCCESS' AND prev_1_res = 'REJECT' "
    "AND prev_2_res = 'REJECT' AND prev_3_res = 'REJECT'"))
def filter_eq(spark, sf):
    c = F.col
    return _amount_lagged(spark, sf).where(
        (c("oper_result") == "SUCCESS") & (c("prev_1_res") == "REJECT")
        & (c("prev_2_res") == "REJECT") & (c("prev_3_res") == "REJECT")).select("trans_id")


@check("filter_cmp_columns", _AMT_LAG_SQL + (
    "SELECT trans_id, amt, prev_1_amt FROM lag_amt_w WHERE prev_1_amt > amt "
    "AND prev_2_amt > prev_1_amt AND prev_3_amt > prev_2_amt"))
def filter_cmp_columns(spark, sf):
    c = F.col
    return _amount_lagged(spark, sf).where(
        (c("prev_1_amt") > c("amt")) & (c("prev_2_amt") > c("prev_1_amt"))
        & (c("prev_3_amt") > c("prev_2_amt"))).select("trans_id", "amt", "prev_1_amt")


@check("filter_changed", _CITY_LAG_SQL + (
    "SELECT trans_id, terminal_city, lag_city FROM lag_city_w WHERE terminal_city <> lag_city"))
def filter_changed(spark, sf):
    return _city_lagged(spark, sf).where(F.col("terminal_city") != F.col("lag_city")).select(
        "trans_id", "terminal_city", "lag_city")


@check("filter_within_interval", _CITY_LAG_SQL + (
    "SELECT trans_id, trans_date, lag_trans_date FROM lag_city_w "
    "WHERE trans_date - INTERVAL 1 HOUR < lag_trans_date"))
def filter_within_interval(spark, sf):
    return _city_lagged(spark, sf).where(
        R.within_interval("trans_date", "lag_trans_date", R.CITY_LIMIT_S)).select(
        "trans_id", "trans_date", "lag_trans_date")


@check("alias_filter", Q.with_bank(Q.hits_blacklist()) + Q.report("h_bl", "blacklist"))
def alias_filter(spark, sf):
    """Rule 1 filtered on its output alias ``passport`` (project, then filter)."""
    fact, _, dims = _bank(spark, sf)
    tx = E.select_batch(fact, A.chain_batch(spark, sf)).select("trans_id", "trans_date", "card_num")
    rows = R.to_report(E.with_client(tx, dims), EVENT_TYPES["blacklist"], A.REPORT_DT)
    bl = dims.blacklist.select(F.col("passport_num").alias("passport"))
    return rows.join(bl, "passport", "left_semi")


# ================================================================== extras (X)
@check("rule_passport_any", Q.with_bank(Q.hits_blacklist(), Q.hits_passport()) + (
    "SELECT trans_id, trans_date AS event_dt, passport_num AS passport, "
    "'passport in blacklist' AS event_type FROM h_bl UNION ALL "
    "SELECT trans_id, trans_date, passport_num, 'passport not valid' FROM h_pass "
    "WHERE passport_num NOT IN (SELECT passport_num FROM blacklist)"))
def rule_passport_any(spark, sf):
    fact, _, dims = _bank(spark, sf)
    hits = R.hits_passport_any(fact, dims, A.chain_batch(spark, sf))
    return hits.select("trans_id", F.col("trans_date").alias("event_dt"),
                       F.col("passport_num").alias("passport"), "event_type")


_SCD1_SQL = Q.with_bank(
    "cur AS (SELECT CAST(account_num AS VARCHAR) AS account_num, valid_to, CAST(client AS VARCHAR) AS client, "
    "DATE '1900-01-01' AS create_dt, CAST(NULL AS DATE) AS update_dt FROM accounts "
    "WHERE c_mktsegment <> 'FURNITURE')",
    "stg AS (SELECT CAST(account_num AS VARCHAR) AS account_num, "
    "CASE WHEN c_acctbal > 5000 THEN valid_to + 365 ELSE valid_to END AS valid_to, "
    "CAST(client AS VARCHAR) AS client FROM accounts)",
    "j AS (SELECT o.account_num AS o_key, n.account_num AS n_key, o.valid_to AS o_valid_to, "
    "n.valid_to AS n_valid_to, o.client AS o_client, n.client AS n_client, o.create_dt, o.update_dt, "
    "(o.valid_to IS DISTINCT FROM n.valid_to OR o.client IS DISTINCT FROM n.client) AS diff "
    "FROM cur o FULL OUTER JOIN stg n ON o.account_num = n.account_num)") + (
    "SELECT COALESCE(o_key, n_key) AS account_num, "
    "CASE WHEN o_key IS NULL OR (n_key IS NOT NULL AND diff) THEN n_valid_to ELSE o_valid_to END AS valid_to, "
    "CASE WHEN o_key IS NULL OR (n_key IS NOT NULL AND diff) THEN n_client ELSE o_client END AS client, "
    "CASE WHEN o_key IS NULL THEN DATE '2000-01-05' ELSE create_dt END AS create_dt, "
    "CASE WHEN o_key IS NOT NULL AND n_key IS NOT NULL AND diff THEN DATE '2000-01-05' ELSE update_dt END "
    "AS update_dt FROM j")


@check("scd1_upsert", _SCD1_SQL)
def scd1_upsert(spark, sf):
    acc = A.accounts(spark, sf).join(
        A.table(spark, sf, "customer").select(F.col("c_custkey").alias("account_num"), "c_mktsegment", "c_acctbal"),
        "account_num")
    cur = acc.where(F.col("c_mktsegment") != "FURNITURE").select(
        F.col("account_num").cast("string"), "valid_to", F.col("client").cast("string"),
        date_lit("1900-01-01").alias("create_dt"), F.lit(None).cast("date").alias("update_dt"))
    stg = acc.select(F.col("account_num").cast("string"),
                     F.when(F.col("c_acctbal") > 5000, F.date_add("valid_to", 365))
                      .otherwise(F.col("valid_to")).alias("valid_to"),
                     F.col("client").cast("string"))
    return SCD.scd1_upsert(cur, stg, "account_num", ["valid_to", "client"], dt.date(2000, 1, 5))


def _snapshot(spark, sf, day: int) -> DataFrame:
    """Terminal snapshots of three days: day 2 adds terminals j=3 and re-addresses
    region 1; day 3 drops terminals j=0 and re-addresses region 2."""
    t = A.terminals(spark, sf).join(
        A.table(spark, sf, "nation").select(F.col("n_name").alias("terminal_city"), "n_regionkey"),
        "terminal_city")
    j = (F.col("terminal_id") - (F.col("terminal_id") % 25)) / 25
    if day == 1:
        t = t.where(j <= 2)
    elif day == 2:
        t = t.withColumn("terminal_address", F.when(F.col("n_regionkey") == 1,
                                                    F.concat("terminal_address", F.lit(" v2")))
                         .otherwise(F.col("terminal_address")))
    else:
        t = t.where(j >= 1).withColumn(
            "terminal_address",
            F.when(F.col("n_regionkey") == 1, F.concat("terminal_address", F.lit(" v2")))
             .when(F.col("n_regionkey") == 2, F.concat("terminal_address", F.lit(" v3")))
             .otherwise(F.col("terminal_address")))
    return t.select("terminal_id", "terminal_type", "terminal_city", "terminal_address")


_SNAP_SQL = (
    "snap AS ("
    "SELECT 1 AS d, terminal_id, terminal_type, terminal_city, terminal_address FROM terminals WHERE j <= 2 "
    "UNION ALL SELECT 2, terminal_id, terminal_type, terminal_city, "
    "CASE WHEN n_regionkey = 1 THEN terminal_address || ' v2' ELSE terminal_address END FROM terminals "
    "UNION ALL SELECT 3, terminal_id, terminal_type, terminal_city, "
    "CASE WHEN n_regionkey = 1 THEN terminal_address || ' v2' WHEN n_regionkey = 2 THEN terminal_address || ' v3' "
    "ELSE terminal_address END FROM terminals WHERE j >= 1)")
TERM_ATTRS = ["terminal_type", "terminal_city", "terminal_address"]


@check("snapshot_delta", Q.with_bank(_SNAP_SQL) + (
    "SELECT COALESCE(n.terminal_id, o.terminal_id) AS terminal_id, "
    "CASE WHEN n.terminal_id IS NULL THEN o.terminal_type ELSE n.terminal_type END AS terminal_type, "
    "CASE WHEN n.terminal_id IS NULL THEN o.terminal_city ELSE n.terminal_city END AS terminal_city, "
    "CASE WHEN n.terminal_id IS NULL THEN o.terminal_address ELSE n.terminal_address END AS terminal_address, "
    "CASE WHEN o.terminal_id IS NULL THEN 'new' WHEN n.terminal_id IS NULL THEN 'gone' "
    "WHEN o.terminal_type IS DISTINCT FROM n.terminal_type OR o.terminal_city IS DISTINCT FROM n.terminal_city "
    "OR o.terminal_address IS DISTINCT FROM n.terminal_address THEN 'changed' ELSE 'same' END AS change "
    "FROM (SELECT * FROM snap WHERE d = 1) o FULL OUTER JOIN (SELECT * FROM snap WHERE d = 3) n "
    "ON o.terminal_id = n.terminal_id"))
def snapshot_delta(spark, sf):
    return SCD.snapshot_delta(_snapshot(spark, sf, 1), _snapshot(spark, sf, 3), "terminal_id", TERM_ATTRS)


SNAP_TS = {n: dt.datetime(2021, 3, n) for n in (1, 2, 3)}
CLIENT_ATTRS = ["segment", "balance"]

# Snapshots of all customers on three days: some come on day 2, some go on day 3, some
# are away on day 2 only; segments change on day 2, balances on day 3.
_CUSTOMER_SNAP_SQL = (
    "snap AS (SELECT d, c_custkey AS client_id, "
    "CASE WHEN d >= 2 AND c_custkey % 4 = 1 THEN 'MOVED' ELSE c_mktsegment END AS segment, "
    "CASE WHEN d = 3 AND c_custkey % 3 = 1 THEN NULL ELSE c_acctbal END AS balance "
    "FROM customer CROSS JOIN (VALUES (1), (2), (3)) AS days(d) "
    "WHERE NOT (d = 1 AND c_custkey % 7 = 0) AND NOT (d = 3 AND c_custkey % 5 = 0) AND NOT (d = 2 AND c_custkey % 11 = 0))")


def _customer_snapshot(spark, sf, day: int) -> DataFrame:
    key = F.col("c_custkey")
    there = {1: key % 7 != 0, 2: key % 11 != 0, 3: key % 5 != 0}[day]
    segment = F.when((key % 4 == 1) & F.lit(day >= 2), F.lit("MOVED")).otherwise(F.col("c_mktsegment"))
    balance = F.when(~((key % 3 == 1) & F.lit(day == 3)), F.col("c_acctbal"))
    return A.table(spark, sf, "customer").where(there).select(
        key.alias("client_id"), segment.alias("segment"), balance.alias("balance"))


# History from the three snapshots: a version is a run of days with the same
# state (present with equal attributes, or absent after having been present).
_SCD2_SQL = Q.with_bank(_CUSTOMER_SNAP_SQL, (
    "grid AS (SELECT k.client_id, d.d FROM (SELECT DISTINCT client_id FROM snap) k "
    "CROSS JOIN (SELECT DISTINCT d FROM snap) d)"), (
    "st AS (SELECT g.client_id, g.d, s.client_id IS NULL AS absent, s.segment, s.balance "
    "FROM grid g LEFT JOIN snap s ON g.client_id = s.client_id AND g.d = s.d)"), (
    "seen AS (SELECT *, MIN(CASE WHEN NOT absent THEN d END) OVER (PARTITION BY client_id) AS first_d FROM st)"), (
    "live AS (SELECT * FROM seen WHERE d >= first_d)"), (
    "marked AS (SELECT *, CASE WHEN LAG(d) OVER w IS NULL OR LAG(absent) OVER w <> absent "
    "OR (NOT absent AND (LAG(segment) OVER w IS DISTINCT FROM segment "
    "OR LAG(balance) OVER w IS DISTINCT FROM balance)) THEN 1 ELSE 0 END AS brk "
    "FROM live WINDOW w AS (PARTITION BY client_id ORDER BY d))"), (
    "runs AS (SELECT *, SUM(brk) OVER (PARTITION BY client_id ORDER BY d) AS run FROM marked)"), (
    "vers AS (SELECT client_id, run, MIN(d) AS d0, BOOL_OR(absent) AS absent, "
    "ANY_VALUE({segment: segment, balance: balance}) FILTER (WHERE NOT absent) AS v FROM runs GROUP BY 1, 2)"), (
    "filled AS (SELECT client_id, d0, absent, COALESCE(v, LAG(v) OVER w) AS v, "
    "LEAD(d0) OVER w AS d1 FROM vers WINDOW w AS (PARTITION BY client_id ORDER BY run))")) + (
    "SELECT client_id, v.segment AS segment, v.balance AS balance, "
    "TIMESTAMP '2021-02-28 00:00:00' + to_days(CAST(d0 AS INTEGER)) AS effective_from, "
    "CASE WHEN d1 IS NULL THEN TIMESTAMP '9999-12-31 23:59:59' "
    "ELSE TIMESTAMP '2021-02-28 00:00:00' + to_days(CAST(d1 AS INTEGER)) - INTERVAL 1 SECOND END AS effective_to, "
    "absent AS deleted_flg FROM filled")


@check("scd2_hist", _SCD2_SQL)
def scd2_hist(spark, sf):
    """History of all customers; the second day's snapshot comes last."""
    key = "client_id"
    hist = SCD.scd2_init(_customer_snapshot(spark, sf, 1), key, CLIENT_ATTRS, SNAP_TS[1])
    hist = SCD.scd2_step(hist, _customer_snapshot(spark, sf, 3), key, CLIENT_ATTRS, SNAP_TS[3])
    return SCD.scd2_step(hist, _customer_snapshot(spark, sf, 2), key, CLIENT_ATTRS, SNAP_TS[2], SNAP_TS[3])


@check("blacklist_increment", Q.with_bank() + (
    "SELECT passport_num, entry_dt FROM blacklist "
    "WHERE entry_dt >= DATE '2000-01-11' AND entry_dt <= DATE '2000-01-15'"))
def blacklist_increment(spark, sf):
    """File of 15 Jan 2000 (month to date) after the file of 10 Jan was loaded."""
    bl = A.blacklist(spark, sf).select("passport_num", "entry_dt")
    loaded = bl.where((F.col("entry_dt") >= date_lit("2000-01-01")) & (F.col("entry_dt") <= date_lit("2000-01-10")))
    month_file = bl.where(F.col("entry_dt") <= date_lit("2000-01-15"))
    return SCD.blacklist_increment(loaded, month_file, dt.date(2000, 1, 15))


# ============================================================ files and tables
@check("read_delimited", Q.with_bank() + TX_FILE_SQL)
def read_delimited_check(spark, sf):
    files = _write_files(spark, sf, scratch_path(spark, "incoming"))
    return read_delimited(spark, files).drop("file_name", "file_dt")


@check("file_date_from_name", Q.with_bank() + (
    f"SELECT CAST(trans_id AS VARCHAR) AS transaction_id, {MONTH_SQL} AS file_dt FROM fact"))
def file_date_from_name_check(spark, sf):
    files = _write_files(spark, sf, scratch_path(spark, "incoming"))
    return read_delimited(spark, files).select("transaction_id", "file_dt")


@check("meta_ingest_log", Q.with_bank() + (
    f"SELECT 'transactions_' || strftime({MONTH_SQL}, '%d%m%Y') || '.txt' AS file_name, "
    f"'transactions' AS kind, {MONTH_SQL} AS batch_dt, COUNT(*) AS rows, "
    "COUNT(*) FILTER (WHERE trans_id IS NULL OR trans_date IS NULL OR amt IS NULL) AS rejected, "
    "MAX(trans_date) AS max_event_ts FROM fact GROUP BY 1, 2, 3"))
def meta_ingest_log(spark, sf):
    """Ledger after loading the files of one half, then the pending ones are loaded too."""
    wh = Warehouse(spark, scratch_path(spark, "wh"))
    staged = read_delimited(spark, _write_files(spark, sf, scratch_path(spark, "incoming")))

    def load(rows):
        wh.append("meta_ingest_log", ledger_rows(rows, "transactions", "transaction_date", A.REPORT_DT,
                                                 schemas.TRANSACTION_REQUIRED))
    load(staged.where(F.col("file_dt") < date_lit(HALF)))
    pending = ledger_pending(wh.read("meta_ingest_log"), staged.select("file_name").distinct())
    load(staged.join(pending, "file_name", "left_semi"))
    return wh.read("meta_ingest_log").drop("loaded_at")


@check("ingest_stream", Q.with_bank() + f"SELECT s.*, CAST(date_trunc('month', transaction_date) AS DATE) AS batch_dt FROM ({TX_FILE_SQL}) s")
def ingest_stream(spark, sf):
    from fraudmart.streaming.ingest import ingest_available_now
    base = scratch_path(spark, "stream")
    files = _write_files(spark, sf, f"{base}/incoming")
    ingest_available_now(spark, files, f"{base}/sink", f"{base}/checkpoint", archive=f"{base}/archive")
    sink_schema = T.StructType(schemas.TRANSACTIONS_FILE.fields + [T.StructField("batch_dt", T.DateType())])
    return spark.read.schema(sink_schema).parquet(f"{base}/sink")


@check("export_report", Q.with_bank(Q.hits_blacklist()) + Q.report("h_bl", "blacklist"))
def export_report_check(spark, sf):
    path = scratch_path(spark, "rep_fraud_export")
    export_report(rule_blacklist(spark, sf), path)
    return (spark.read.schema(schemas.REP_FRAUD).option("sep", ";").option("header", True)
            .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path))


@check("stage_replace", Q.with_bank() + (
    "SELECT CAST(trans_id AS VARCHAR) AS transaction_id, trans_date AS transaction_date FROM fact "
    f"WHERE trans_date >= TIMESTAMP '{HALF} 00:00:00'"))
def stage_replace(spark, sf):
    """The table in two batches: staging is the second one afterwards."""
    wh = Warehouse(spark, scratch_path(spark, "wh"))
    rows = _tx_file_layout(A.lineitem_fact(spark, sf))
    for batch in (rows.where(F.col("transaction_date") < ts_lit(HALF)), rows.where(F.col("transaction_date") >= ts_lit(HALF))):
        wh.replace("stg_transactions", batch)
    return spark.read.parquet(wh.path("stg_transactions")).select("transaction_id", "transaction_date")


@check("append_batch", Q.with_bank() + (
    f"SELECT CAST(trans_id AS VARCHAR) AS trans_id, {MONTH_SQL} AS trans_dt FROM fact"))
def append_batch(spark, sf):
    """The table in two batches (partitions of a month); the second one written again:
    its partitions are replaced."""
    wh = Warehouse(spark, scratch_path(spark, "wh"))
    rows = L.conform(L.rename_columns(_tx_file_layout(A.lineitem_fact(spark, sf)), L.RENAMES["dwh_fact_transactions"])
                     .withColumn("trans_dt", _month()), schemas.FACT_TRANSACTIONS)
    second = rows.where(F.col("trans_dt") >= date_lit(HALF))
    wh.append("dwh_fact_transactions", rows.where(F.col("trans_dt") < date_lit(HALF)))
    wh.append("dwh_fact_transactions", second)
    wh.overwrite_days("dwh_fact_transactions", second)
    return wh.read("dwh_fact_transactions").select("trans_id", "trans_dt")


@check("empty_table_first_run", Q.with_bank() + (
    "SELECT CAST(card_num AS VARCHAR) AS card_num, CAST(account_num AS VARCHAR) AS account_num, "
    "create_dt, CAST(NULL AS DATE) AS update_dt FROM cards"))
def empty_table_first_run(spark, sf):
    wh = Warehouse(spark, scratch_path(spark, "wh"))
    return L.load_new(_seed_cards(spark, sf), wh.read("dwh_dim_cards"), "dwh_dim_cards")


@check("surrogate_key", (
    "SELECT o_orderkey AS card_num, o_custkey AS account_num, "
    "CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 15) AS BIGINT) AS id FROM orders"))
def surrogate_key(spark, sf):
    """Ids from the key's MD5."""
    return L.surrogate_key(A.cards(spark, sf).select("card_num", "account_num"), "card_num")


@check("dense_key", Q.with_bank() + (
    "SELECT card_num, account_num, CASE WHEN create_dt < DATE '1998-01-01' "
    "THEN row_number() OVER (PARTITION BY create_dt < DATE '1998-01-01' ORDER BY CAST(card_num AS VARCHAR)) "
    "ELSE (SELECT count(*) FROM cards WHERE create_dt < DATE '1998-01-01') + row_number() OVER "
    "(PARTITION BY create_dt < DATE '1998-01-01' ORDER BY CAST(card_num AS VARCHAR)) END AS id FROM cards"))
def dense_key(spark, sf):
    """Ids without gaps from a kept dictionary: the older cards, all cards, all again."""
    wh = Warehouse(spark, scratch_path(spark, "wh"))
    cards = A.cards(spark, sf).select(F.col("card_num").cast("string").alias("key"), "card_num", "account_num", "create_dt")
    for rows in (cards.where(F.col("create_dt") < date_lit("1998-01-01")), cards, cards):
        ids = wh.key_ids("cards", rows, "key")
    return cards.join(ids, "key").select("card_num", "account_num", "id")


@check("bootstrap_dims", Q.with_bank() + (
    "SELECT 'cards' AS dim, CAST(card_num AS VARCHAR) AS key, CAST(account_num AS VARCHAR) AS value FROM cards UNION ALL "
    "SELECT 'accounts', CAST(account_num AS VARCHAR), CAST(client AS VARCHAR) || ' ' || CAST(valid_to AS VARCHAR) FROM accounts UNION ALL "
    "SELECT 'clients', CAST(client_id AS VARCHAR), passport_num || ' ' || coalesce(CAST(passport_valid_to AS VARCHAR), '-') || ' ' || phone FROM clients"))
def bootstrap_dims_check(spark, sf):
    """The bank's tables from an INSERT dump of them, loaded twice."""
    path, wh = scratch_path(spark, "seed"), Warehouse(spark, scratch_path(spark, "wh"))
    seed_dump(spark, sf).write.text(path)
    for _ in range(2):
        bootstrap_dims(spark, wh, path, run_dt=HALF)
    text = lambda *c: F.concat_ws(" ", *[F.coalesce(F.col(x).cast("string"), F.lit("-")) for x in c]).alias("value")
    return (wh.read("dwh_dim_cards").select(F.lit("cards").alias("dim"), F.col("card_num").alias("key"), text("account_num"))
            .unionByName(wh.read("dwh_dim_accounts").select(F.lit("accounts").alias("dim"), F.col("account_num").alias("key"), text("client", "valid_to")))
            .unionByName(wh.read("dwh_dim_clients").select(F.lit("clients").alias("dim"), F.col("client_id").alias("key"),
                                                           text("passport_num", "passport_valid_to", "phone"))))


@check("add_null_columns", Q.with_bank() + (
    "SELECT CAST(terminal_id AS VARCHAR) AS terminal_id, terminal_type, terminal_city, terminal_address, "
    "CAST(NULL AS DATE) AS create_dt, CAST(NULL AS DATE) AS update_dt FROM terminals"))
def add_null_columns(spark, sf):
    return L.add_null_columns(_terminal_snapshot(spark, sf))


def _write_terminal_workbooks(spark, sf, root: str) -> None:
    """One workbook per region, written by executors: an older first sheet and
    the current snapshot as the last sheet."""
    t = _terminal_snapshot(spark, sf).join(
        A.table(spark, sf, "nation").select(F.col("n_name").alias("terminal_city"), "n_regionkey"),
        "terminal_city")
    cols = ["terminal_id", "terminal_type", "terminal_city", "terminal_address"]

    def write(pdf):
        import os

        import pandas as pd
        folder = root.removeprefix("file://")
        os.makedirs(folder, exist_ok=True)  # executors write to the shared (mounted) folder
        region = int(pdf["n_regionkey"].iloc[0])
        rows = pdf[cols].astype(object).where(pdf[cols].notna(), None).values.tolist()
        old = [r[:3] + [str(r[3]) + " old"] for r in rows[: len(rows) // 2]]
        path = f"{folder}/terminals_r{region}_01012000.xlsx"
        write_workbook(path, {"old": [cols] + old, "current": [cols] + rows})
        return pd.DataFrame({"path": [path], "rows": [len(rows)]})

    t.groupBy("n_regionkey").applyInPandas(write, "path string, rows long").count()


@check("read_workbook", Q.with_bank() + (
    "SELECT CAST(terminal_id AS VARCHAR) AS terminal_id, terminal_type, terminal_city, terminal_address FROM terminals"))
def read_workbook_check(spark, sf):
    root = scratch_path(spark, "workbooks")
    _write_terminal_workbooks(spark, sf, root)
    return read_workbook(spark, f"{root}/*.xlsx", ["terminal_id", "terminal_type", "terminal_city",
                                                   "terminal_address"]).drop("file_name", "sheet")


def _dump_statements(df: DataFrame, table: str, cols: list[str]) -> DataFrame:
    """INSERT statements for ``df`` (text literals, NULL as null), built by Spark."""
    def lit_sql(c):
        v = F.col(c).cast("string")
        return F.when(v.isNull(), F.lit("null")).otherwise(
            F.concat(F.lit("'"), F.regexp_replace(v, "'", "''"), F.lit("'")))
    values = F.concat_ws(",\t", *[lit_sql(c) for c in cols])
    head = f"insert into {table} ({', '.join(cols)}) \n\tvalues ("
    return df.select(F.concat(F.lit(head), values, F.lit(");")).alias("value"))


def seed_dump(spark, sf) -> DataFrame:
    """Cards, accounts and clients as INSERT statements."""
    seeds = {"cards": L.conform(A.cards(spark, sf).withColumnRenamed("account_num", "account"), schemas.SEED_CARDS),
             "accounts": L.conform(A.accounts(spark, sf).withColumnRenamed("account_num", "account"), schemas.SEED_ACCOUNTS),
             "clients": L.conform(A.clients(spark, sf), schemas.SEED_CLIENTS)}
    out = None
    for name, df in seeds.items():
        part = _dump_statements(df, name, df.columns)
        out = part if out is None else out.unionByName(part)
    return out


@check("read_insert_dump", Q.with_bank() + (
    "SELECT CAST(client_id AS VARCHAR) AS client_id, last_name, first_name, patronymic, "
    "CAST(NULL AS DATE) AS date_of_birth, passport_num, passport_valid_to, phone, "
    "CAST(NULL AS DATE) AS create_dt, CAST(NULL AS DATE) AS update_dt FROM clients"))
def read_insert_dump_check(spark, sf):
    path = scratch_path(spark, "dump")
    clients = L.conform(A.clients(spark, sf), schemas.SEED_CLIENTS)
    accounts = _seed_accounts(spark, sf)
    stmts = (_dump_statements(accounts, "accounts", [f.name for f in schemas.SEED_ACCOUNTS.fields])
             .unionByName(_dump_statements(clients, "clients", [f.name for f in schemas.SEED_CLIENTS.fields])))
    stmts.write.mode("overwrite").text(path)
    return read_insert_dump(spark, path, "clients", schemas.SEED_CLIENTS)


@check("amount_chain_length", Q.with_bank(
    "l AS (SELECT *, LAG(oper_result) OVER w AS p_res, LAG(amt) OVER w AS p_amt, "
    "ROW_NUMBER() OVER w AS pos FROM ev WINDOW w AS (PARTITION BY card_num ORDER BY trans_date, trans_id))",
    "b AS (SELECT *, CASE WHEN p_res = 'REJECT' AND p_amt > amt THEN 0 ELSE 1 END AS brk FROM l)",
    "s AS (SELECT *, MAX(CASE WHEN brk = 1 THEN pos END) OVER (PARTITION BY card_num "
    "ORDER BY trans_date, trans_id ROWS UNBOUNDED PRECEDING) AS start_pos FROM b)") + (
    "SELECT s.trans_id, s.card_num, s.trans_date AS event_dt, s.pos - s.start_pos + 1 AS chain_len, "
    "st.trans_date AS chain_start_dt FROM s JOIN s st ON s.card_num = st.card_num AND st.pos = s.start_pos "
    "WHERE s.oper_result = 'SUCCESS' AND s.brk = 0 AND s.pos - s.start_pos + 1 >= 4"))
def amount_chain_length(spark, sf):
    return R.amount_chains(A.events_fact(spark, sf))


from fraudmart.plans import daily_check  # noqa: E402, F401  (registers its checks)
