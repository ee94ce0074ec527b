"""``LAG`` and running aggregates per card, safe where one card holds a third of all rows.

Two exact forms, by what the caller needs:

* ``lag_within``: the value is used only if the row that it comes from lies less than
  a limit back (the rules of the written requirements). Each row goes to its own time
  bucket and, near the bucket's end, to the next one too (range replication); one
  window per (card, bucket) then sees every row that can count. One exchange, no join.
* ``lag_columns`` / ``running_columns``: no limit. Cards with more than ``hot_rows``
  rows are found first (a pre-aggregated count a card); the others take the plain
  window, the hot ones the split form below. Without hot cards the plan is the plain
  window alone.

Split form of the hot cards:

1. cut each card into time buckets and run the plain window per ``(card, bucket)``;
   rows deeper than ``k`` inside their bucket already have the right value;
2. keep the last ``K`` rows (``K`` = largest offset) of every bucket as a small "tail";
3. per card, over the bucket summaries only (one row per non-empty bucket), gather the
   tails of the ``K`` previous non-empty buckets: together they hold the ``K`` rows that
   precede the bucket;
4. join those back on ``(card, bucket)`` and fill the first ``k`` rows of each bucket.

Buckets only need to be non-decreasing in the sort order, which holds because they are
taken from the leading order column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NULL_BUCKET = -(2 ** 62)  # NULL timestamps sort first, so their bucket does too
HOT_ROWS = 2_000_000  # rows of one card that a task sorts without trouble
HOT_KEYS = 4096  # cards that take the split form, at most: the hottest ones
_WIDTH = 4  # bucket width of ``lag_within`` in limits: a quarter of the rows is sent twice


def wall_seconds(df: DataFrame, col: str) -> F.Column:
    """Whole seconds that never decrease along ``col``'s sort order (NULL for NULL).

    ``timestamp_ntz`` is bucketed on its wall clock (no time-zone conversion,
    which would not be monotone across a daylight-saving change), ``timestamp``
    on its instant, ``date`` on its day number.
    """
    dtype = df.schema[col].dataType
    c = F.col(col)
    if isinstance(dtype, T.TimestampNTZType):
        days = F.datediff(F.to_date(c), F.lit("1970-01-01").cast("date")).cast("long")
        return days * 86400 + F.hour(c) * 3600 + F.minute(c) * 60 + F.floor(F.second(c))
    if isinstance(dtype, T.DateType):
        return F.datediff(c, F.lit("1970-01-01").cast("date")).cast("long") * 86400
    return F.floor(F.unix_micros(c.cast("timestamp")) / F.lit(1_000_000))


def time_bucket(df: DataFrame, col: str, seconds: int) -> F.Column:
    """A bucket number that never decreases along ``col``'s sort order (NULL: the lowest)."""
    return F.coalesce(F.floor(wall_seconds(df, col) / F.lit(seconds)), F.lit(_NULL_BUCKET))


def hot_keys(df: DataFrame, by: Sequence[str], hot_rows: int) -> list[int]:
    """Hashes of the keys with more than ``hot_rows`` rows (the ``HOT_KEYS`` hottest).

    One pass over the key columns, aggregated before its shuffle; the driver receives
    the hot keys only. Equal hashes of two keys do no harm: either form is exact."""
    counts = df.groupBy(F.xxhash64(*by).alias("_h")).agg(F.count(F.lit(1)).alias("_n"))
    found = counts.where(F.col("_n") > hot_rows).orderBy(F.desc("_n")).limit(HOT_KEYS)
    return [r["_h"] for r in found.collect()]


def _by_heat(df: DataFrame, by: list[str], hot_rows: int, plain, split, heat: DataFrame | None = None) -> DataFrame:
    hot = hot_keys(df if heat is None else heat, by, hot_rows)
    if not hot:
        return plain(df)
    is_hot = F.xxhash64(*by).isin(hot)
    return plain(df.where(~is_hot)).unionByName(split(df.where(is_hot)))


def lag_within(df: DataFrame, by: Sequence[str], order: Sequence[str], lags: dict[str, tuple[str, int]],
               limit_seconds: int, width: int | None = None) -> DataFrame:
    """Rows with a time, with ``out = LAG(col, k)`` per key wherever the ``k``-th row
    before lies less than ``limit_seconds`` back; elsewhere that value or NULL.

    A row less than the limit back is in the same bucket of ``width`` seconds (the
    limit, or more) or in the last ``limit_seconds`` of the one before, and then so are
    all rows between the two."""
    by, order = list(by), list(order)
    width = max(limit_seconds, width or _WIDTH * limit_seconds)
    at = wall_seconds(df, order[0])
    own = F.floor(at / F.lit(width))
    near_end = at >= (own + 1) * width - limit_seconds
    x = df.where(F.col(order[0]).isNotNull()).select("*", own.alias("_own"), F.explode(
        F.when(near_end, F.array(own, own + 1)).otherwise(F.array(own))).alias("_b"))
    w = Window.partitionBy(*by, "_b").orderBy(*order)
    x = x.select("*", *[F.lag(c, k).over(w).alias(o) for o, (c, k) in lags.items()])
    return x.where(F.col("_b") == F.col("_own")).select(*df.columns, *lags)


def lag_columns(df: DataFrame, by: Sequence[str], order: Sequence[str], lags: dict[str, tuple[str, int]],
                bucket_seconds: int | None = 3600, hot_rows: int = HOT_ROWS, heat: DataFrame | None = None) -> DataFrame:
    """Add ``out = LAG(col, k) OVER (PARTITION BY by ORDER BY order)`` for each
    ``out -> (col, k)`` in ``lags``.

    ``bucket_seconds=None`` gives the plain single-window form for all keys; else keys
    with more than ``hot_rows`` rows take the split form in buckets of so many seconds,
    with identical results. ``order[0]`` must be a timestamp or date column. Keys are
    counted in ``heat`` if given: a frame with no fewer rows a key that is cheaper to read.
    """
    by, order = list(by), list(order)
    plain = lambda x: _plain_lag(x, by, order, lags)
    if not bucket_seconds:
        return plain(df)
    return _by_heat(df, by, hot_rows, plain, lambda x: _split_lag(x, by, order, lags, bucket_seconds), heat)


def _plain_lag(df, by, order, lags):
    w = Window.partitionBy(*by).orderBy(*order)
    return df.select("*", *[F.lag(c, k).over(w).alias(o) for o, (c, k) in lags.items()])


def _split_lag(df, by, order, lags, bucket_seconds):
    depth = max(k for _, k in lags.values())
    bucket = time_bucket(df, order[0], bucket_seconds)
    # The partition columns travel inside one non-NULL struct key: NULL card
    # numbers still meet their own group in the join below, window and join
    # share one hash partitioning, and both branches read the same columns, so
    # Spark reuses the single shuffle of the rows (ReusedExchange).
    x = df.select(F.struct(*by).alias("_key"), bucket.alias("_b"),
                  *[F.col(c) for c in df.columns if c not in by])
    carried = [c for c in x.columns if c not in ("_key", "_b")]

    w_sorted = Window.partitionBy("_key", "_b").orderBy(*order)
    w_group = Window.partitionBy("_key", "_b")
    x = x.select("*",
                 F.row_number().over(w_sorted).alias("_rn"),
                 F.count(F.lit(1)).over(w_group).alias("_cnt"),
                 *[F.lag(c, k).over(w_sorted).alias(o) for o, (c, k) in lags.items()])

    tail_row = F.struct(F.col("_b"), F.col("_rn"), *[F.col(c) for c in carried])
    tails = (x.where(F.col("_rn") > F.col("_cnt") - depth)
              .groupBy("_key", "_b")
              .agg(F.collect_list(tail_row).alias("_tail")))
    w_prev = Window.partitionBy("_key").orderBy("_b").rowsBetween(-depth, -1)
    prev = tails.select("_key", "_b",
                        F.sort_array(F.flatten(F.collect_list("_tail").over(w_prev))).alias("_prev"))

    y = x.join(prev, ["_key", "_b"], "left")
    fills = {}
    for out, (c, k) in lags.items():
        from_prev = F.try_element_at(F.col("_prev"), F.col("_rn") - F.lit(k + 1)).getField(c)
        fills[out] = F.when(F.col("_rn") > F.lit(k), F.col(out)).otherwise(from_prev)
    fills.update({b: F.col("_key").getField(b) for b in by})
    return y.withColumns(fills).select(*df.columns, *lags)


_RUNNING = {"sum": F.sum, "max": F.max, "min": F.min}


def running_columns(df: DataFrame, by: Sequence[str], order: Sequence[str],
                    aggs: dict[str, tuple[str, F.Column]], bucket_seconds: int | None = 3600,
                    hot_rows: int = HOT_ROWS) -> DataFrame:
    """Add running aggregates ``out = fn(expr) OVER (PARTITION BY by ORDER BY
    order ROWS UNBOUNDED PRECEDING)`` for ``out -> (fn, expr)``, fn in
    sum / max / min (associative, so the split form is exact).

    Split form (hot keys): the running value inside each ``(key, time bucket)`` plus the
    aggregate of all earlier buckets of the key, taken from a window over the
    per-bucket totals (one small row per bucket) — no key sorted in one task.
    """
    by, order = list(by), list(order)
    plain = lambda x: _plain_running(x, by, order, aggs)
    if not bucket_seconds:
        return plain(df)
    return _by_heat(df, by, hot_rows, plain, lambda x: _split_running(x, by, order, aggs, bucket_seconds))


def _plain_running(df, by, order, aggs):
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.select("*", *[_RUNNING[fn](e).over(w).alias(o) for o, (fn, e) in aggs.items()])


def _split_running(df, by, order, aggs, bucket_seconds):
    bucket = time_bucket(df, order[0], bucket_seconds)
    inputs = {f"_in_{o}": e for o, (_, e) in aggs.items()}
    x = df.select(F.struct(*by).alias("_key"), bucket.alias("_b"),
                  *[F.col(c) for c in df.columns if c not in by],
                  *[e.alias(n) for n, e in inputs.items()])
    w_local = Window.partitionBy("_key", "_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    w_group = Window.partitionBy("_key", "_b")
    x = x.select("*", *[_RUNNING[fn](F.col(f"_in_{o}")).over(w_local).alias(f"_loc_{o}")
                        for o, (fn, _) in aggs.items()],
                 *[_RUNNING[fn](F.col(f"_in_{o}")).over(w_group).alias(f"_tot_{o}")
                   for o, (fn, _) in aggs.items()])
    totals = x.groupBy("_key", "_b").agg(*[F.first(f"_tot_{o}").alias(f"_tot_{o}") for o in aggs])
    w_before = Window.partitionBy("_key").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    prefix = totals.select("_key", "_b", *[_RUNNING[fn](F.col(f"_tot_{o}")).over(w_before).alias(f"_pre_{o}")
                                          for o, (fn, _) in aggs.items()])
    y = x.join(prefix, ["_key", "_b"], "left")
    outs = {}
    for o, (fn, _) in aggs.items():
        loc, pre = F.col(f"_loc_{o}"), F.col(f"_pre_{o}")
        if fn == "sum":
            outs[o] = F.when(loc.isNull() & pre.isNull(), None).otherwise(
                F.coalesce(loc, F.lit(0)) + F.coalesce(pre, F.lit(0)))
        else:
            outs[o] = (F.greatest if fn == "max" else F.least)(loc, pre)
    outs.update({b: F.col("_key").getField(b) for b in by})
    return y.withColumns(outs).select(*df.columns, *aggs)
