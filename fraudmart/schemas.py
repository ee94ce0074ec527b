"""Explicit schemas of every input, warehouse and mart table."""

from pyspark.sql import types as T

S, D, TS = T.StringType(), T.DateType(), T.TimestampNTZType()


def struct_of(*fields):
    """Nullable columns of (name, type)."""
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


_struct = struct_of


# ---- daily input files --------------------------------------------------
TRANSACTIONS_FILE = _struct(
    ("transaction_id", S), ("transaction_date", TS), ("amount", T.DecimalType(10, 2)),
    ("card_num", S), ("oper_type", S), ("oper_result", S), ("terminal", S))
TERMINALS_FILE = _struct(
    ("terminal_id", S), ("terminal_type", S), ("terminal_city", S), ("terminal_address", S))
BLACKLIST_FILE = _struct(("date", D), ("passport", S))

STAGED_TRANSACTIONS = _struct(*[(f.name, f.dataType) for f in TRANSACTIONS_FILE.fields], ("file_name", S), ("file_dt", D))

# ---- seed tables (reference tables of the bank) --------------------------
SEED_CARDS = _struct(("card_num", S), ("account", S), ("create_dt", D), ("update_dt", D))
SEED_ACCOUNTS = _struct(("account", S), ("valid_to", D), ("client", S),
                        ("create_dt", D), ("update_dt", D))
SEED_CLIENTS = _struct(
    ("client_id", S), ("last_name", S), ("first_name", S), ("patronymic", S),
    ("date_of_birth", D), ("passport_num", S), ("passport_valid_to", D), ("phone", S),
    ("create_dt", D), ("update_dt", D))
SEED = {"cards": SEED_CARDS, "accounts": SEED_ACCOUNTS, "clients": SEED_CLIENTS}

# ---- warehouse ------------------------------------------------------------
DIM_CARDS = _struct(("card_num", S), ("account_num", S), ("create_dt", D), ("update_dt", D))
DIM_ACCOUNTS = _struct(("account_num", S), ("valid_to", D), ("client", S),
                       ("create_dt", D), ("update_dt", D))
DIM_CLIENTS = _struct(
    ("client_id", S), ("last_name", S), ("first_name", S), ("patronymic", S),
    ("date_of_birth", D), ("passport_num", S), ("passport_valid_to", D), ("phone", S),
    ("create_dt", D), ("update_dt", D))
DIM_TERMINALS = _struct(("terminal_id", S), ("terminal_type", S), ("terminal_city", S),
                        ("terminal_address", S), ("create_dt", D), ("update_dt", D))
FACT_TRANSACTIONS = _struct(
    ("trans_id", S), ("trans_date", TS), ("amt", T.DecimalType(10, 2)), ("card_num", S),
    ("oper_type", S), ("oper_result", S), ("terminal", S), ("create_dt", D), ("update_dt", D),
    ("trans_dt", D))
FACT_BLACKLIST = _struct(("passport_num", S), ("entry_dt", D), ("create_dt", D), ("update_dt", D))
REP_FRAUD = _struct(("event_dt", TS), ("passport", S), ("fio", S), ("phone", S),
                    ("event_type", S), ("report_dt", TS))
META_INGEST = _struct(("file_name", S), ("kind", S), ("batch_dt", D), ("rows", T.LongType()),
                      ("rejected", T.LongType()), ("max_event_ts", TS), ("loaded_at", TS))
META_SNAPSHOTS = _struct(("table", S), ("snapshot_dt", D))
# Files that a stream has seen, in order of arrival.
META_ARRIVALS = _struct(("path", S), ("file_name", S), ("kind", S))
# Columns a staged transaction must have (after typed parsing) to be loaded.
TRANSACTION_REQUIRED = ("transaction_id", "transaction_date", "amount")

WAREHOUSE = {
    "dwh_dim_cards": DIM_CARDS,
    "dwh_dim_accounts": DIM_ACCOUNTS,
    "dwh_dim_clients": DIM_CLIENTS,
    "dwh_dim_terminals": DIM_TERMINALS,
    "dwh_fact_transactions": FACT_TRANSACTIONS,
    "dwh_fact_passport_blacklist": FACT_BLACKLIST,
    "rep_fraud": REP_FRAUD,
    "meta_ingest_log": META_INGEST,
    "meta_snapshots": META_SNAPSHOTS,
    "meta_arrivals": META_ARRIVALS,
    "stg_rejects": STAGED_TRANSACTIONS,
}

# Business keys of the dimension and fact tables.
KEYS = {
    "dwh_dim_cards": "card_num",
    "dwh_dim_accounts": "account_num",
    "dwh_dim_clients": "client_id",
    "dwh_dim_terminals": "terminal_id",
    "dwh_fact_transactions": "trans_id",
    "dwh_fact_passport_blacklist": "passport_num",
}


def scd2_schema(dim: T.StructType) -> T.StructType:
    """SCD2 history table: dimension columns plus the validity triple."""
    extra = [T.StructField("effective_from", TS, True), T.StructField("effective_to", TS, True),
             T.StructField("deleted_flg", T.BooleanType(), True)]
    return T.StructType([f for f in dim.fields if f.name not in ("create_dt", "update_dt")] + extra)
