"""Warehouse loads: "insert only keys not seen yet" and small column helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudmart import schemas

# file/seed column -> warehouse column, per staged table.
RENAMES = {
    "dwh_dim_cards": {"account": "account_num"},
    "dwh_dim_accounts": {"account": "account_num"},
    "dwh_dim_clients": {},
    "dwh_dim_terminals": {},
    "dwh_fact_transactions": {"transaction_id": "trans_id", "transaction_date": "trans_date",
                              "amount": "amt"},
    "dwh_fact_passport_blacklist": {"passport": "passport_num", "date": "entry_dt"},
}


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """``select(col(a).alias(b))`` for every mapped column, others unchanged."""
    return df.select(*[F.col(c).alias(mapping.get(c, c)) for c in df.columns])


def add_null_columns(df: DataFrame, names=("create_dt", "update_dt"),
                     dtype: T.DataType = T.DateType()) -> DataFrame:
    """``ALTER TABLE ... ADD <name> <type>``: new all-NULL columns."""
    return df.withColumns({n: F.lit(None).cast(dtype) for n in names if n not in df.columns})


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project onto ``schema``: same order and types, missing columns NULL.

    ``try_cast``: a malformed value becomes NULL instead of failing the batch
    (ANSI mode would raise on a plain cast).
    """
    cols = []
    for f in schema.fields:
        src = F.col(f.name) if f.name in df.columns else F.lit(None)
        cols.append(src.try_cast(f.dataType).alias(f.name))
    return df.select(*cols)


def surrogate_key(df: DataFrame, key: str, name: str = "id") -> DataFrame:
    """Deterministic distributed id: 60 bits of the key's MD5 (no global ordering)."""
    return df.withColumn(name, F.conv(F.substring(F.md5(F.col(key).cast("string").cast("binary")), 1, 15), 16, 10).cast("long"))


def numbered(keys: DataFrame, key: str, above: int = 0) -> DataFrame:
    """(key, id) with ids ``above + 1, above + 2, ...`` without gaps, for a frame of
    distinct keys that was read from Parquet files: each row's place in its file plus
    the rows of the files before (prefix sums over one small row a file)."""
    placed = keys.select(key, F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    sizes = placed.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return placed.join(starts, "_file").select(key, (F.col("_row") + F.col("_start") + 1 + above).alias("id"))


def insert_new(staged: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Staged rows whose ``key`` is not in ``existing`` yet.

    Semantics of ``LEFT JOIN existing ON key WHERE existing.key IS NULL``: rows
    with a NULL key always pass, duplicates inside the batch all pass, changed
    attributes of known keys are ignored.

    Plan for a large ``existing`` (the fact grows every day): first find which
    of *today's* keys exist (``existing`` semi-joined to the distinct staged
    keys — broadcast when that key set is under the size threshold, otherwise a
    runtime bloom filter prunes the big side before its shuffle), then anti-join
    the batch against that small result. The full key column of the warehouse is
    scanned but never shuffled whole.
    """
    batch_keys = staged.select(key).where(F.col(key).isNotNull()).distinct()
    seen = existing.select(key).join(batch_keys, key, "left_semi")
    return staged.join(seen, key, "left_anti")


def load_new(staged: DataFrame, existing: DataFrame, table: str) -> DataFrame:
    """Rename the staged file columns, conform to the warehouse schema and keep
    only rows with unseen business keys: the rows to append to ``table``."""
    schema = schemas.WAREHOUSE[table]
    renamed = rename_columns(staged, RENAMES[table])
    if table == "dwh_fact_transactions" and "trans_dt" not in renamed.columns:
        renamed = renamed.withColumn("trans_dt", F.to_date("trans_date"))
    rows = conform(renamed, schema)
    return insert_new(rows, existing, schemas.KEYS[table])
