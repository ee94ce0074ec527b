"""Corpus pipeline: quality rules, near-duplicates, secrets, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as
Parquet and reread as the next stage's ``docs``. All but the last return the
columns of documents. Cases (nulls, empty texts and tables, repeated rows, extra
columns) are those of the operators; the stages keep every column they are given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudmart.llm import op2_secret_scan as op2
from fraudmart.llm import op4_simhash_near_dup as op4
from fraudmart.llm import op8_quality_rules as op8
from fraudmart.llm import op9_sentencepiece as op9
from fraudmart.llm import op10_mixing as op10
from fraudmart.llm.common import prepare, stored, table
from fraudmart.llm.queries import PIECES, domains

POLICY = "web-1"
#: Targets as multiples of each domain's present expected tokens (the rules have
#: taken out what is low, so what looks like it here stays).
SCALE = {"clean": 1.0, "low": 1.0, "toxic": 0.0}
#: No copies are made here: a rate is the chance to stay.
MOST = 1.0


def _columns(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    prepare(spark)
    named = docs.select(F.struct(*_columns(docs)).alias("doc"), F.col("text"))
    return op8.ledger(named).filter(op8.verdict(POLICY)).select("doc.*")


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__id``, one for each distinct pair of id and text: the id itself,
    and a number from the text above 2^62 for documents without an id and, where texts
    of one id differ, for all but one of them (that with the least digest)."""
    named = docs.select(*_columns(docs), F.col("doc_id").cast("long").alias("__doc"), F.xxhash64("text").alias("__digest"))
    several = named.filter("__doc is not null").groupBy("__doc").agg(
        F.min("__digest").alias("__least"), F.max("__digest").alias("__most")).filter("__least <> __most")
    joined = named.join(several.select("__doc", "__least").hint("merge"), "__doc", "left")
    own = F.col("__doc").isNotNull() & F.coalesce(F.col("__digest") == F.col("__least"), F.lit(True))
    other = F.xxhash64("__doc", "__digest").bitwiseAND(F.lit((1 << 62) - 1)) + F.lit(1 << 62)
    return joined.select(*_columns(docs), F.when(own, F.col("__doc")).otherwise(other).alias("__id"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: the one whose id names it. Repeated rows of one
    id and text stay once (the least of them); different texts of one id are documents of
    their own; any document with an id goes before those without."""
    prepare(spark)
    named = stored(_keyed(docs), "pipeline-keyed")
    found = op4.near_duplicates(named, id_col="__id", shingle=4, max_bits=4)
    keep = stored(found.filter("id = component_id").select(F.col("id").alias("__id")).distinct(), "pipeline-keep")
    rows = named.join(keep.hint("merge"), "__id", "left_semi").groupBy("__id").agg(F.min(F.struct(*_columns(docs))).alias("doc"))
    return rows.select("doc.*")


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret is replaced in its text; all documents stay."""
    found = op2.scan(docs.select(F.struct(*_columns(docs)).alias("doc"), "text"), keep=["doc"])
    clean = op2.redact(F.col("doc.text"), F.col("spans"))
    value = {"text": clean, "n_chars": F.when(F.size("spans") > 0, F.char_length(clean).cast("long")).otherwise(F.col("doc.n_chars"))}
    return found.select(*[value.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents stay by their fitted rates."""
    prepare(spark)
    names = list(SCALE)
    model = op10.fit_classifier(docs, domains(table(spark, sf_dir, "labels")), names)
    wrapped = docs.select(F.struct(*_columns(docs)).alias("doc"), "text")
    mixed = op10.mix(wrapped, model, None, names, scale=list(SCALE.values()), most=MOST)
    return mixed.filter(op10.copies(F.col("rate"), F.col("doc.doc_id")) > 0).select("doc.*")


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left, with the ids' round trip."""
    return op9.round_trip(docs, PIECES).select("doc_id", "n_tokens", "ids_crc32", "round_trip")


STAGES = [("quality_rules", quality_rules), ("simhash_near_dedup", simhash_near_dedup), ("secret_scans", secret_scans),
          ("mixing", mixing), ("sentencepiece", sentencepiece)]
ORACLE_SQL = None  # xxhash64 fingerprints and the classifier have no DuckDB form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
