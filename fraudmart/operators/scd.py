"""Dimension maintenance the written requirements ask for.

* ``scd1_upsert``: current-state dimension with ``create_dt`` / ``update_dt``;
* ``scd2_insert``: one full snapshot put into a history table (``effective_from``,
  ``effective_to``, ``deleted_flg``) at its day, in whatever order snapshots come;
  ``scd2_step`` is the same at the end of the history;
* ``snapshot_delta``: classify a full snapshot against the current state;
* ``blacklist_increment``: month-to-date file → only rows not loaded yet.

All work by the business key (one shuffle of each side, or a broadcast of the
smaller one). Parquet tables have no MERGE, so the result replaces the parts of the
table that it was made from.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fraudmart.functions import date_lit, ts_lit

OPEN_END = dt.datetime(9999, 12, 31, 23, 59, 59)  # effective_to of the open version


def _changed(attrs, left: str = "o", right: str = "n") -> F.Column:
    cond = F.lit(False)
    for a in attrs:
        cond = cond | ~F.col(f"{left}.{a}").eqNullSafe(F.col(f"{right}.{a}"))
    return cond


def one_per_key(snapshot: DataFrame, key: str, attrs) -> DataFrame:
    """One row per key of a delivered snapshot: of repeated keys the row with the
    largest attributes (in order); rows without a key are left out."""
    return (snapshot.where(F.col(key).isNotNull()).groupBy(key)
            .agg(F.max(F.struct(*attrs)).alias("__row")).select(key, "__row.*"))


def snapshot_delta(current: DataFrame, snapshot: DataFrame, key: str, attrs) -> DataFrame:
    """Every key of either side with ``change`` in new / changed / gone / same.

    Columns: key, the snapshot's attributes (the current ones for ``gone``), change.
    """
    o, n = current.select(key, *attrs).alias("o"), one_per_key(snapshot, key, attrs).alias("n")
    j = o.join(n, F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")
    change = (F.when(F.col(f"o.{key}").isNull(), "new")
               .when(F.col(f"n.{key}").isNull(), "gone")
               .when(_changed(attrs), "changed").otherwise("same"))
    gone = F.col(f"n.{key}").isNull()
    return j.select(F.coalesce(F.col(f"n.{key}"), F.col(f"o.{key}")).alias(key),
                    *[F.when(gone, F.col(f"o.{a}")).otherwise(F.col(f"n.{a}")).alias(a) for a in attrs],
                    change.alias("change"))


def scd1_upsert(current: DataFrame, staged: DataFrame, key: str, attrs, run_dt) -> DataFrame:
    """New version of an SCD1 dimension: insert new keys, overwrite changed ones.

    New rows get ``create_dt = run_dt``; changed rows keep ``create_dt`` and get
    ``update_dt = run_dt``; untouched rows are carried over as they are. Keys
    absent from ``staged`` stay (a delta file does not delete).
    """
    run = date_lit(run_dt)
    o = current.select(key, *attrs, "create_dt", "update_dt").alias("o")
    n = one_per_key(staged, key, attrs).alias("n")
    j = o.join(n, F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")
    is_new, only_old = F.col(f"o.{key}").isNull(), F.col(f"n.{key}").isNull()
    changed = ~is_new & ~only_old & _changed(attrs)
    take_new = is_new | changed
    return j.select(
        F.coalesce(F.col(f"o.{key}"), F.col(f"n.{key}")).alias(key),
        *[F.when(take_new, F.col(f"n.{a}")).otherwise(F.col(f"o.{a}")).alias(a) for a in attrs],
        F.when(is_new, run).otherwise(F.col("o.create_dt")).alias("create_dt"),
        F.when(changed, run).otherwise(F.col("o.update_dt")).alias("update_dt"),
    )


def scd2_insert(hist: DataFrame, snapshot: DataFrame, key: str, attrs, run_ts, until_ts=None) -> DataFrame:
    """Put a full snapshot taken at ``run_ts`` into a history: it tells the state of
    every key from ``run_ts`` until the next snapshot that was loaded (``until_ts``;
    None: it is the last one).

    ``hist`` are the versions that end at ``run_ts - 1 s`` or later (earlier ones do not
    change and need not be read); the result takes their place. Per key, what the
    versions say of the span gives way to the snapshot; they are cut at its ends, and
    neighbours of one state become one version. A key missing from the snapshot after
    it was there has a ``deleted_flg`` version with its last attributes; absence before
    the first appearance has none. So the history is that of the snapshots in the order
    of their days, however they came; a second one of the same day replaces the first.
    With columns ``create_dt`` and ``update_dt`` in ``hist`` the first appearance and
    the last change of attributes, as of each version, are kept there.

    A key with one version in ``hist`` at most, in the last snapshot, needs no window
    (``_insert_last``); a window holds the versions of one other key from ``run_ts`` on.
    """
    if until_ts is not None:
        return _insert_among(hist, one_per_key(snapshot, key, attrs), key, attrs, run_ts, until_ts)
    new = one_per_key(snapshot, key, attrs)
    # mostly none: after an exchange of its own Spark sees that, and drops what is joined to it
    many = hist.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(key, F.lit(True).alias("_many")).hint("rebalance")
    of_many = lambda df: df.join(many, key).drop("_many")
    others = lambda df: df.join(many, key, "left").where(F.col("_many").isNull()).drop("_many")
    return _insert_last(others(hist), others(new), key, attrs, run_ts).unionByName(
        _insert_among(of_many(hist), of_many(new), key, attrs, run_ts))


def _insert_last(hist: DataFrame, new: DataFrame, key: str, attrs, run_ts) -> DataFrame:
    """``scd2_insert`` of the last snapshot (one row a key) for keys with one version in
    ``hist`` at most: that version goes on, or ends and another one follows."""
    ts, end, second = ts_lit(run_ts), ts_lit(OPEN_END), F.expr("INTERVAL 1 SECOND")
    dated, none = "create_dt" in hist.columns, F.lit(None).cast("date")
    v = F.struct(*[F.col(a) for a in attrs])
    old = hist.select(key, v.alias("_o"), F.col("effective_from").alias("_f"), F.col("effective_to").alias("_t"), F.col("deleted_flg").alias("_d"),
                      *([F.col("create_dt").alias("_c"), F.col("update_dt").alias("_u")] if dated else [none.alias("_c"), none.alias("_u")]))
    both = old.join(new.select(key, v.alias("_v")), key, "full_outer")
    was, now, state = F.coalesce(F.col("_f") < ts, F.lit(False)), F.col("_v").isNotNull(), F.coalesce("_v", "_o")
    same = was & F.coalesce(F.col("_o").eqNullSafe(state) & (F.col("_d") == ~now), F.lit(False))
    first = F.coalesce(F.col("_c"), F.to_date("_f"))
    piece = lambda v, f, t, d, c, u: F.struct(v.alias("v"), f.alias("f"), t.alias("t"), d.alias("d"), c.alias("c"), u.alias("u"))
    before = piece(F.col("_o"), F.col("_f"), F.when(same, end).otherwise(F.least("_t", ts - second)), F.col("_d"), first, F.col("_u"))
    after = piece(state, ts, end, ~now, F.when(was, first).otherwise(F.to_date(ts)),
                  F.when(was, F.when(~F.col("_o").eqNullSafe(state), F.to_date(ts)).otherwise(F.col("_u"))))
    pieces = F.array(F.when(was, before), F.when((was | now) & ~same, after))
    cut = both.select(key, F.explode(F.filter(pieces, lambda x: x.isNotNull())).alias("p"))
    return cut.select(key, *[F.col(f"p.v.{a}").alias(a) for a in attrs], F.col("p.f").alias("effective_from"), F.col("p.t").alias("effective_to"),
                      F.col("p.d").alias("deleted_flg"), *([F.col("p.c").alias("create_dt"), F.col("p.u").alias("update_dt")] if dated else []))


def _insert_among(hist: DataFrame, new: DataFrame, key: str, attrs, run_ts, until_ts=None) -> DataFrame:
    """``scd2_insert`` of a snapshot of one row a key, for any versions: one exchange by key."""
    ts, end, second = ts_lit(run_ts), ts_lit(OPEN_END), F.expr("INTERVAL 1 SECOND")
    until = ts_lit(until_ts) if until_ts is not None else None
    dated = "create_dt" in hist.columns
    none = F.lit(None).cast("date")

    def piece(origin: str, start: F.Column, to: F.Column, deleted: F.Column, gone: F.Column | None = None) -> F.Column:
        """``gone``: the piece has no attributes of its own (it takes those before it)."""
        own = F.struct(*[F.col(a) for a in attrs])
        return F.struct(F.lit(origin).alias("o"), (F.when(~gone, own) if gone is not None else own).alias("v"), start.alias("f"),
                        to.alias("t"), deleted.alias("d"))

    old = hist.select(key, *attrs, "effective_from", "effective_to", "deleted_flg",
                      *([F.col("create_dt").alias("_c"), F.col("update_dt").alias("_u")] if dated else [none.alias("_c"), none.alias("_u")]))
    new = new.select(key, *attrs, ts.alias("effective_from"), end.alias("effective_to"), F.lit(False).alias("deleted_flg"),
                     none.alias("_c"), none.alias("_u"))
    rows = old.withColumn("_new", F.lit(False)).unionByName(new.withColumn("_new", F.lit(True)))
    f, t, deleted, is_new = (F.col(c) for c in ("effective_from", "effective_to", "deleted_flg", "_new"))
    left = ~is_new & (f < ts)
    right = ~is_new & (t >= until) if until is not None else F.lit(False)
    per_key = Window.partitionBy(key)
    rows = rows.withColumns({"_left": F.max(left).over(per_key), "_mid": F.max(is_new).over(per_key),
                             "_next": F.min(F.when(right, F.greatest(f, until) if until is not None else f)).over(per_key)})
    mid_end = until - second if until is not None else end
    pieces = [F.when(left, piece("left", f, F.least(t, ts - second), deleted)),
              F.when(is_new, piece("mid", ts, mid_end, F.lit(False))),
              F.when(left & ~F.col("_mid"), piece("mid", ts, mid_end, F.lit(True), F.lit(True)))]
    if until is not None:
        pieces += [F.when(right, piece("right", F.greatest(f, until), t, deleted, deleted)),
                   F.when(is_new & ~F.col("_left") & (F.coalesce(F.col("_next") > until, F.lit(True))), piece(
                       "right", until, F.coalesce(F.col("_next") - second, end), F.lit(True), F.lit(True)))]
    cut = rows.select(key, "_c", "_u", F.explode(F.filter(F.array(*pieces), lambda x: x.isNotNull())).alias("p")).select(
        key, "_c", "_u", "p.*")
    by_time = Window.partitionBy(key).orderBy("f")
    so_far = by_time.rowsBetween(Window.unboundedPreceding, 0)
    filled = cut.withColumn("v", F.last("v", ignorenulls=True).over(so_far)).where(F.col("v").isNotNull())
    same = F.coalesce(F.lag("v").over(by_time).eqNullSafe(F.col("v")) & (F.lag("d").over(by_time) == F.col("d")), F.lit(False))
    runs = filled.withColumn("_same", same).withColumn("_run", F.sum(F.when(F.col("_same"), 0).otherwise(1)).over(so_far))
    merged = runs.groupBy(key, "_run").agg(
        F.min_by("v", "f").alias("v"), F.min("f").alias("f"), F.max("t").alias("t"), F.min_by("d", "f").alias("d"),
        F.min_by(F.struct("o", "_c", "_u"), "f").alias("s"))
    first = F.lag("f").over(by_time).isNull()
    known = F.col("s.o") == "left"  # the version was there before, with dates that hold
    create = F.when(first, F.when(known, F.coalesce("s._c", F.to_date("f"))).otherwise(F.to_date("f")))
    change = F.when(first, F.when(known, F.col("s._u"))).when(~F.lag("v").over(by_time).eqNullSafe(F.col("v")), F.to_date("f"))
    out = merged.withColumns({"create_dt": create, "update_dt": change}).withColumns({
        "create_dt": F.last("create_dt", ignorenulls=True).over(so_far), "update_dt": F.last("update_dt", ignorenulls=True).over(so_far)})
    return out.select(key, *[F.col(f"v.{a}").alias(a) for a in attrs], F.col("f").alias("effective_from"),
                      F.col("t").alias("effective_to"), F.col("d").alias("deleted_flg"), *(["create_dt", "update_dt"] if dated else []))


def scd2_step(hist: DataFrame, snapshot: DataFrame, key: str, attrs, run_ts, until_ts=None) -> DataFrame:
    """The whole history after a snapshot of ``run_ts`` (see ``scd2_insert``): versions
    that ended before pass through untouched."""
    cols = [key, *attrs, "effective_from", "effective_to", "deleted_flg"]
    ended = F.col("effective_to") < ts_lit(run_ts) - F.expr("INTERVAL 1 SECOND")
    return hist.where(ended).select(*cols).unionByName(
        scd2_insert(hist.where(~ended), snapshot, key, attrs, run_ts, until_ts).select(*cols))


def scd2_init(snapshot: DataFrame, key: str, attrs, run_ts) -> DataFrame:
    """History from a first snapshot: every row one open version."""
    return one_per_key(snapshot, key, attrs).select(key, *attrs,
                           ts_lit(run_ts).alias("effective_from"),
                           ts_lit(OPEN_END).alias("effective_to"),
                           F.lit(False).alias("deleted_flg"))


def blacklist_increment(loaded: DataFrame, month_file: DataFrame, file_day) -> DataFrame:
    """Rows of a month-to-date blacklist file not loaded before.

    The file repeats every entry since the 1st; an entry is identified by
    (passport, date). Only entries of the file's month up to its day count.
    """
    day = date_lit(file_day)
    in_month = (F.col("entry_dt") >= F.trunc(day, "month")) & (F.col("entry_dt") <= day)
    rows = month_file.where(in_month)
    seen = loaded.select("passport_num", "entry_dt")
    return rows.join(seen, ["passport_num", "entry_dt"], "left_anti")
