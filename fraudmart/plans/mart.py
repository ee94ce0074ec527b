"""REP_FRAUD: the five rules as one cumulative mart."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudmart.functions import EVENT_TYPES, expired, fio
from fraudmart.operators.enrich import DOCUMENTED, OBSERVED, Batch, Dims, select_batch, with_client
from fraudmart.operators.rules import RULES, report_stamp, to_report

WINDOW_RULES = ("city", "amount")
CHAIN_RULES = ("blacklist", "passport_expired", "account_expired")


def run_date(stamp: F.Column) -> F.Column:
    """Midnight of the run (rule 2 stamps ``current_date`` in observed mode)."""
    return F.to_date(stamp).cast("timestamp_ntz")


def fraud_report(fact: DataFrame, dims: Dims, batch: Batch | None, mode: str = DOCUMENTED,
                 report_dt=None, rules: tuple[str, ...] = tuple(RULES),
                 window_fact: DataFrame | None = None, window_batch: Batch | None = None,
                 options: dict[str, dict] | None = None, fused: bool = True) -> DataFrame:
    """All rule hits for one batch as mart rows, stamped with one ``report_dt``.

    ``window_fact`` / ``window_batch`` let the window rules read another fact
    (the test adapter does); by default every rule reads ``fact`` and ``batch``.
    ``options`` passes per-rule keyword arguments (``limit_s``, ``bucket_s``).
    In observed mode rule 2 is stamped with the run *date*, as the original is.

    ``fused=True`` (default) scans the batch once and joins the client chain
    once for all rules; ``fused=False`` runs each rule on its own (same rows).
    """
    if fused:
        return _fused_report(fact, dims, batch, mode, report_dt, rules, window_fact, window_batch,
                             options or {})
    stamp = report_stamp(report_dt)
    options = options or {}
    parts = []
    for name in rules:
        windowed = name in WINDOW_RULES
        src = window_fact if (windowed and window_fact is not None) else fact
        b = window_batch if (windowed and window_batch is not None) else batch
        hits = RULES[name](src, dims, b, mode, **options.get(name, {}))
        st = run_date(stamp) if (mode == OBSERVED and name == "passport_expired") else stamp
        parts.append(to_report(hits, EVENT_TYPES[name], stamp=st))
    return reduce(DataFrame.unionByName, parts)


def _fused_report(fact, dims, batch, mode, report_dt, rules, window_fact, window_batch, options):
    """One chain join for the whole mart.

    Candidates are the batch transactions (for the three chain rules, tagged
    NULL) plus the matches of the window rules (tagged with their event type).
    After one card → account → client join, every chain rule is a predicate,
    and ``explode`` turns each candidate into one row per rule it fires.
    """
    cands = []
    if any(r in CHAIN_RULES for r in rules):
        tx = select_batch(fact, batch, mode).select("trans_id", "trans_date", "card_num")
        cands.append(tx.select("trans_date", "card_num", F.lit(None).cast("string").alias("_hit")))
    for name in (r for r in rules if r in WINDOW_RULES):
        src = window_fact if window_fact is not None else fact
        b = window_batch if window_batch is not None else batch
        found = RULES[name](src, dims, b, mode, chain=False, **options.get(name, {}))
        cands.append(found.select("trans_date", "card_num", F.lit(EVENT_TYPES[name]).alias("_hit")))
    chained = with_client(reduce(DataFrame.unionByName, cands), dims,
                          extra=("valid_to", "passport_valid_to"))
    from_batch = F.col("_hit").isNull()
    tags = [F.col("_hit")]
    if "blacklist" in rules:
        flags = dims.blacklist.select("passport_num").distinct().withColumn("_blocked", F.lit(True))
        chained = chained.join(flags, "passport_num", "left")
        tags.append(F.when(from_batch & F.col("_blocked").isNotNull(), EVENT_TYPES["blacklist"]))
    if "passport_expired" in rules:
        tags.append(F.when(from_batch & expired("passport_valid_to", "trans_date"),
                           EVENT_TYPES["passport_expired"]))
    if "account_expired" in rules:
        tags.append(F.when(from_batch & expired("valid_to", "trans_date"), EVENT_TYPES["account_expired"]))
    rows = chained.select("*", F.explode(F.array(*tags)).alias("event_type")).where(
        F.col("event_type").isNotNull())
    stamp = report_stamp(report_dt)
    if mode == OBSERVED:
        stamp = F.when(F.col("event_type") == EVENT_TYPES["passport_expired"],
                       run_date(stamp)).otherwise(stamp)
    return rows.select(F.col("trans_date").alias("event_dt"), F.col("passport_num").alias("passport"),
                       fio().alias("fio"), "phone", "event_type", stamp.alias("report_dt"))
