"""DuckDB twins of the checks: the same bank views over the test tables.

Each string is one SELECT over the pre-registered test tables. ``BANK`` holds
the CTEs that mirror ``plans.adapters`` (fixed values must match it).
"""

from __future__ import annotations

BANK = """
fact AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS trans_id,
         l_shipdate AS trans_date, l_extendedprice AS amt, l_orderkey AS card_num,
         l_returnflag AS oper_type,
         CASE WHEN l_linestatus = 'F' THEN 'SUCCESS' ELSE 'REJECT' END AS oper_result,
         l_suppkey AS terminal
  FROM lineitem),
ev AS (
  SELECT event_id AS trans_id, ts AS trans_date, value AS amt, user_id AS card_num,
         event_type AS oper_type,
         CASE WHEN event_type IN ('purchase', 'signup') THEN 'SUCCESS' ELSE 'REJECT' END AS oper_result,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS terminal
  FROM events),
cards AS (
  SELECT o_orderkey AS card_num, o_custkey AS account_num, CAST(o_orderdate AS DATE) AS create_dt
  FROM orders),
accounts AS (
  SELECT c_custkey AS account_num, DATE '1999-07-01' + CAST(c_custkey % 400 AS INTEGER) AS valid_to,
         c_custkey AS client, c_mktsegment, c_acctbal
  FROM customer),
clients AS (
  SELECT c_custkey AS client_id, c_name AS last_name, c_mktsegment AS first_name, n_name AS patronymic,
         c_name AS passport_num,
         CASE WHEN c_mktsegment <> 'HOUSEHOLD'
              THEN DATE '1999-10-01' + CAST(c_custkey % 200 AS INTEGER) END AS passport_valid_to,
         '+7 ' || lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS phone, c_acctbal
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey),
blacklist AS (
  SELECT c_name AS passport_num, DATE '1999-12-01' + CAST(c_custkey % 62 AS INTEGER) AS entry_dt
  FROM customer WHERE c_acctbal < 0),
terminals AS (
  SELECT n_nationkey + 25 * j AS terminal_id, 'POS' AS terminal_type, n_name AS terminal_city,
         n_name || ' ' || CAST(j AS VARCHAR) AS terminal_address, n_regionkey, j
  FROM nation CROSS JOIN range(4) AS r(j)),
chain AS (
  SELECT c.card_num, c.account_num, a.client, a.valid_to, cl.passport_num, cl.passport_valid_to,
         cl.last_name || ' ' || cl.first_name || ' ' || cl.patronymic AS fio, cl.phone
  FROM cards c JOIN accounts a ON c.account_num = a.account_num
  JOIN clients cl ON a.client = cl.client_id)"""

# Batch predicates are templates over the timestamp column ``{t}``.
CHAIN_BATCH = ("{t} >= TIMESTAMP '2000-01-01 00:00:00' "
               "AND {t} < TIMESTAMP '2000-02-01 00:00:00'")
CITY_BATCH = ("{t} >= TIMESTAMP '2024-01-10 00:00:00' "
              "AND {t} < TIMESTAMP '2024-01-20 00:00:00'")


def on(batch: str, t: str = "trans_date") -> str:
    return batch.format(t=t)
REPORT_DT = "TIMESTAMP '2021-03-04 10:30:00'"
REPORT_DAY = "TIMESTAMP '2021-03-04 00:00:00'"

EVENT = {
    "blacklist": "passport in blacklist",
    "passport_expired": "passport not valid",
    "account_expired": "account not valid",
    "city": "different city",
    "amount": "selection of the amount",
}


def with_bank(*ctes: str) -> str:
    extra = "".join(f",\n{c}" for c in ctes)
    return f"WITH {BANK}{extra}\n"


def report(hits: str, event: str, stamp: str = REPORT_DT) -> str:
    """Mart projection of a hits CTE that already carries the chain columns."""
    return (f"SELECT h.trans_date AS event_dt, h.passport_num AS passport, h.fio, h.phone, "
            f"'{EVENT[event]}' AS event_type, {stamp} AS report_dt FROM {hits} h")


# ------------------------------------------------------------------ hit CTEs
def hits_blacklist(fact: str = "fact", batch: str = CHAIN_BATCH, name: str = "h_bl") -> str:
    return (f"{name} AS (SELECT f.trans_id, f.trans_date, ch.* FROM {fact} f "
            f"JOIN chain ch ON f.card_num = ch.card_num "
            f"WHERE ({on(batch, 'f.trans_date')}) "
            f"AND ch.passport_num IN (SELECT passport_num FROM blacklist))")


def hits_passport(fact: str = "fact", batch: str = CHAIN_BATCH, name: str = "h_pass") -> str:
    return (f"{name} AS (SELECT f.trans_id, f.trans_date, ch.* FROM {fact} f "
            f"JOIN chain ch ON f.card_num = ch.card_num "
            f"WHERE ({on(batch, 'f.trans_date')}) "
            f"AND CAST(f.trans_date AS DATE) >= ch.passport_valid_to)")


def hits_account(fact: str = "fact", batch: str = CHAIN_BATCH, name: str = "h_acc") -> str:
    return (f"{name} AS (SELECT f.trans_id, f.trans_date, ch.* FROM {fact} f "
            f"JOIN chain ch ON f.card_num = ch.card_num "
            f"WHERE ({on(batch, 'f.trans_date')}) "
            f"AND CAST(f.trans_date AS DATE) >= ch.valid_to)")


def city_lagged(fact: str = "ev", name: str = "lag_city_w") -> str:
    return (f"{name} AS (SELECT f.trans_id, f.trans_date, f.card_num, f.terminal, t.terminal_city, "
            f"LAG(t.terminal_city) OVER w AS lag_city, LAG(f.trans_date) OVER w AS lag_trans_date "
            f"FROM {fact} f JOIN terminals t ON f.terminal = t.terminal_id "
            f"WINDOW w AS (PARTITION BY f.card_num ORDER BY f.trans_date, f.trans_id))")


def hits_city(documented: bool, batch: str = CITY_BATCH, lagged: str = "lag_city_w",
              name: str = "h_city") -> str:
    within = ("l.trans_date - INTERVAL 1 HOUR < l.lag_trans_date" if documented
              else "l.lag_trans_date IS NOT NULL")
    return (f"{name} AS (SELECT l.trans_id, l.trans_date, ch.* FROM {lagged} l "
            f"JOIN chain ch ON l.card_num = ch.card_num "
            f"WHERE l.terminal_city <> l.lag_city AND {within} "
            f"AND ({on(batch, 'l.trans_date')}))")


def amount_lagged(fact: str = "ev", name: str = "lag_amt_w") -> str:
    return (f"{name} AS (SELECT f.*, LAG(trans_date, 3) OVER w AS prev_date, "
            f"LAG(amt, 1) OVER w AS prev_1_amt, LAG(amt, 2) OVER w AS prev_2_amt, "
            f"LAG(amt, 3) OVER w AS prev_3_amt, LAG(oper_result, 1) OVER w AS prev_1_res, "
            f"LAG(oper_result, 2) OVER w AS prev_2_res, LAG(oper_result, 3) OVER w AS prev_3_res "
            f"FROM {fact} f WINDOW w AS (PARTITION BY card_num ORDER BY trans_date, trans_id))")


AMOUNT_PATTERN = ("oper_result = 'SUCCESS' AND prev_1_res = 'REJECT' AND prev_2_res = 'REJECT' "
                  "AND prev_3_res = 'REJECT' AND prev_1_amt > amt AND prev_2_amt > prev_1_amt "
                  "AND prev_3_amt > prev_2_amt")


def hits_amount(limit: str | None, batch: str | None = None, lagged: str = "lag_amt_w",
                name: str = "h_amt") -> str:
    within = f"l.trans_date - {limit} < l.prev_date" if limit else "l.prev_date IS NOT NULL"
    cond = f" AND ({on(batch, 'l.trans_date')})" if batch else ""
    return (f"{name} AS (SELECT l.trans_id, l.trans_date, ch.* FROM {lagged} l "
            f"JOIN chain ch ON l.card_num = ch.card_num "
            f"WHERE {AMOUNT_PATTERN} AND {within}{cond})")
