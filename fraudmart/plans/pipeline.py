"""The daily job: stage the day's files, load new keys, build the reports they change.

``run_day`` works on the Parquet warehouse; what a day writes (fact, blacklist,
dimensions, reports, ledger) is one commit. In documented mode the mart depends on
what was delivered, not on when: a report sees the dimensions and the blacklist as of
its day, a snapshot goes to its place in the history, and the days whose report can
change through late rows are found from the loaded keys and built again.
``run_days_frames`` is the load and report flow on DataFrames only, for checks; it cuts
lineage with ``checkpoint()`` in the shared checkpoint folder after each day.
"""

from __future__ import annotations

import datetime as dt
import posixpath
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudmart import schemas
from fraudmart.functions import date_lit, file_date_from_name, source_name, ts_lit
from fraudmart.operators.enrich import DOCUMENTED, OBSERVED, Batch, Dims, card_profile
from fraudmart.operators.load import RENAMES, add_null_columns, conform, insert_new, load_new, rename_columns
from fraudmart.operators.rules import AMOUNT_LIMIT_S, CITY_LIMIT_S
from fraudmart.operators.scd import OPEN_END, blacklist_increment, scd2_insert
from fraudmart.plans.mart import fraud_report
from fraudmart.session import ensure_checkpoint_dir
from fraudmart.sources.delimited import read_delimited
from fraudmart.sources.dump import dump_rows, dump_units
from fraudmart.sources.tables import FACT, Part, Warehouse, move_file
from fraudmart.sources.workbook import excel_date, read_workbook

SEED_TARGETS = {"cards": "dwh_dim_cards", "accounts": "dwh_dim_accounts", "clients": "dwh_dim_clients"}


@dataclass
class DayFiles:
    """A path, or all paths of the day, per kind (none: that kind came before)."""
    transactions: str | list[str]
    terminals: str | list[str]
    blacklist: str | list[str]


def bootstrap_dims(spark: SparkSession, wh: Warehouse, dump_path: str, mode: str = DOCUMENTED,
                   run_dt: dt.date | None = None) -> dict[str, int]:
    """Load the bank's reference tables from the INSERT dump; returns row counts.

    ``observed`` (the original load): new keys only, reruns add nothing.
    ``documented``: each table is a full snapshot kept as SCD1 (current state,
    ``create_dt`` / ``update_dt``) plus SCD2 history ``<table>_hist``.
    """
    counts = {}
    wh.replace("stg_seed_dump", dump_units(spark, dump_path))  # read once for all tables
    units = spark.read.parquet(wh.path("stg_seed_dump"))
    with wh.transaction():
        for seed, table in SEED_TARGETS.items():
            staged = dump_rows(units, seed, schemas.SEED[seed])
            if mode == DOCUMENTED:
                rows = conform(rename_columns(staged, RENAMES[table]), schemas.WAREHOUSE[table])
                load_dim_scd(wh, table, rows, run_dt or dt.date.today())
            else:
                wh.append(table, load_new(staged, wh.read(table), table))
        for table in SEED_TARGETS.values():
            counts[table] = wh.read(table).count()
    return counts


def stage_day(spark: SparkSession, files: DayFiles, mode: str = DOCUMENTED):
    """The three staging frames of one day, typed. Documented mode reads every sheet
    of a workbook; the observed load replaced its table sheet by sheet (last one)."""
    sheets = "all" if mode == DOCUMENTED else "last"
    if files.transactions:
        tx = read_delimited(spark, files.transactions)
    else:
        tx = spark.createDataFrame([], schemas.STAGED_TRANSACTIONS)
    book = lambda path, cols: read_workbook(spark, path, cols, sheets) if path else spark.createDataFrame(
        [], ", ".join(f"{c} string" for c in ["file_name", "sheet", *cols]))
    term = add_null_columns(book(files.terminals, ["terminal_id", "terminal_type", "terminal_city", "terminal_address"]))
    bl = book(files.blacklist, ["date", "passport"])
    bl = bl.select(excel_date("date").alias("date"), "passport", "file_name")
    return tx, term, bl


def ledger_pending(ledger: DataFrame, files: DataFrame) -> DataFrame:
    """Files (column ``file_name``) not recorded as loaded yet, oldest day first."""
    return (files.join(ledger.select("file_name"), "file_name", "left_anti")
                 .withColumn("batch_dt", file_date_from_name("file_name"))
                 .orderBy("batch_dt", "file_name"))


def rejected(required=schemas.TRANSACTION_REQUIRED) -> F.Column:
    """A staged row whose required fields did not parse (PERMISSIVE reads give NULL)."""
    cond = F.lit(False)
    for c in required:
        cond = cond | F.col(c).isNull()
    return cond


def ledger_rows(staged: DataFrame, kind: str, ts_col: str | None, loaded_at,
                required: tuple[str, ...] = ()) -> DataFrame:
    """One ledger row per staged file: rows, rejected rows, last event time
    (the high-water mark)."""
    agg = [F.count(F.lit(1)).alias("rows"),
           F.count(F.when(rejected(required), 1)).alias("rejected")]
    agg.append(F.max(ts_col).alias("max_event_ts") if ts_col
               else F.lit(None).cast("timestamp_ntz").alias("max_event_ts"))
    return (staged.groupBy("file_name").agg(*agg)
                  .select("file_name", F.lit(kind).alias("kind"),
                          file_date_from_name("file_name").alias("batch_dt"),
                          "rows", "rejected", "max_event_ts",
                          ts_lit(loaded_at).alias("loaded_at")))


def load_blacklist_increment(wh: Warehouse, bl: DataFrame, batch_dt: dt.date) -> list[Part]:
    """Month-to-date blacklist file: append only entries (passport, date) of
    this month up to the file day that are not loaded yet; returns what was added."""
    rows = rename_columns(bl, RENAMES["dwh_fact_passport_blacklist"])
    rows = conform(rows, schemas.FACT_BLACKLIST)
    new = blacklist_increment(wh.read("dwh_fact_passport_blacklist"), rows, batch_dt)
    return wh.append("dwh_fact_passport_blacklist", new)


def _midnight(day: dt.date) -> dt.datetime:
    return dt.datetime(day.year, day.month, day.day)


def _hist_type(schema):
    """Columns of a stored history: SCD2, the SCD1 dates as of each version, and the day
    from which a version no longer holds (its partition)."""
    return schemas.struct_of(*[(f.name, f.dataType) for f in schemas.scd2_schema(schema).fields],
                             ("create_dt", schemas.D), ("update_dt", schemas.D), ("closed_dt", schemas.D))


OPEN_DAY = OPEN_END.date()  # partition of the versions that hold


def snapshot_days(wh: Warehouse, table: str) -> list[dt.date]:
    """Days of the loaded snapshots of a dimension (one small row each)."""
    rows = wh.read("meta_snapshots").where(F.col("table") == table).select("snapshot_dt").distinct()
    return sorted(r[0] for r in rows.collect())


def load_dim_scd(wh: Warehouse, table: str, snapshot: DataFrame, batch_dt: dt.date) -> dt.date | None:
    """A full snapshot of a dimension, in whatever order of days: SCD2 history
    ``<table>_hist`` (effective_from / effective_to / deleted_flg) and SCD1 current state
    (create_dt / update_dt; removed keys keep their last attributes), which is the
    history's open versions. A second snapshot of a day replaces the first.

    The history is partitioned by the day on which versions ended: a snapshot reads and
    writes the open versions and those ended on its day or later, so the bytes written a
    day do not grow with the history. Returns the day of the next loaded snapshot."""
    schema, key = schemas.WAREHOUSE[table], schemas.KEYS[table]
    hist, kind = f"{table}_hist", _hist_type(schema)
    attrs = [f.name for f in schema.fields if f.name not in (key, "create_dt", "update_dt")]
    with wh.transaction():
        days = snapshot_days(wh, table)
        later = min([d for d in days if d > batch_dt], default=None)
        held = wh.read(hist, kind, wh.from_day(hist, batch_dt)).drop("closed_dt")
        rows = scd2_insert(held, conform(snapshot, schema).select(key, *attrs), key, attrs, _midnight(batch_dt),
                           _midnight(later) if later else None)
        ends = F.when(F.col("effective_to") == ts_lit(OPEN_END), date_lit(OPEN_DAY)).otherwise(
            F.to_date(F.col("effective_to") + F.expr("INTERVAL 1 SECOND")))
        wh.replace_from(hist, rows.withColumn("closed_dt", ends).select(*kind.fieldNames()), batch_dt)
        wh.rewrite(table, conform(wh.read(hist, kind, wh.from_day(hist, OPEN_DAY)), schema))
        if batch_dt not in days:
            wh.append("meta_snapshots", wh.spark.createDataFrame([(table, batch_dt)], schemas.META_SNAPSHOTS))
    return later


def terminals_as_of(wh: Warehouse, day: dt.date) -> DataFrame:
    """The terminals' state on a day (also those removed, with their last attributes).
    Only versions that ended after the day are read."""
    hist = "dwh_dim_terminals_hist"
    rows = wh.read(hist, _hist_type(schemas.DIM_TERMINALS), wh.from_day(hist, day + dt.timedelta(days=1)))
    held = rows.where((F.col("effective_from") <= ts_lit(_midnight(day))) & (F.col("effective_to") >= ts_lit(_midnight(day))))
    return conform(held, schemas.DIM_TERMINALS)


def dims_as_of(wh: Warehouse, day: dt.date | None) -> Dims:
    """Cards, accounts and clients as they are; terminals and blacklist entries as of a
    day (None: as they are)."""
    dims = Dims(wh.read("dwh_dim_cards"), wh.read("dwh_dim_accounts"), wh.read("dwh_dim_clients"),
                wh.read("dwh_dim_terminals"), wh.read("dwh_fact_passport_blacklist"))
    if day is not None:
        if wh.parts("dwh_dim_terminals_hist"):
            dims.terminals = terminals_as_of(wh, day)
        dims.blacklist = dims.blacklist.where(F.coalesce(F.col("entry_dt") <= date_lit(day), F.lit(True)))
    return dims


def affected_days(wh: Warehouse, batch_dt: dt.date, new_rows: DataFrame, new_entries: DataFrame,
                  next_snapshot: dt.date | None, lookback_s: int = max(CITY_LIMIT_S, AMOUNT_LIMIT_S)) -> list[dt.date]:
    """The batch day and the days whose report what was loaded can change:

    * days of new transactions, and the days that begin less than the lookback after one
      (it may be, or come between, what a later one is compared with);
    * reported days with a transaction of a newly listed passport, from its entry date on;
    * reported days that the terminals' snapshot now tells of, up to the next snapshot.

    Days after the batch day count only if they were reported already: their own run is
    still to come. One small row a day comes to the driver.
    """
    reported = set(wh.days("rep_fraud"))
    spill = F.to_date(F.col("trans_date") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(lookback_s)))
    days = new_rows.where(F.col("trans_date").isNotNull()).select(
        F.explode(F.sequence(F.to_date("trans_date"), spill)).alias("d")).distinct()
    others = sorted(reported - {batch_dt})
    if others:
        fact = wh.read(FACT).where((F.col("trans_dt") >= date_lit(others[0])) & (F.col("trans_dt") <= date_lit(others[-1])))
        listed = new_entries.where(F.col("entry_dt") <= date_lit(others[-1])).groupBy("passport_num").agg(F.min("entry_dt").alias("entry_dt"))
        cards = (wh.read("dwh_dim_clients").join(listed, "passport_num").select(F.col("client_id").alias("client"), "entry_dt")
                 .join(wh.read("dwh_dim_accounts"), "client").select("account_num", "entry_dt")
                 .join(wh.read("dwh_dim_cards"), "account_num").select("card_num", "entry_dt"))
        seen = fact.select("card_num", "trans_dt").join(cards, "card_num").where("trans_dt >= entry_dt")
        days = days.unionByName(seen.select(F.col("trans_dt").alias("d"))).distinct()
    found = {r["d"] for r in days.collect()} | {batch_dt}
    if next_snapshot is not None:
        found |= {d for d in reported if batch_dt < d < next_snapshot}
    return sorted(d for d in found if d <= batch_dt or d in reported)


def run_day(spark: SparkSession, wh: Warehouse, files: DayFiles, batch_dt: dt.date,
            mode: str = DOCUMENTED, report_dt=None, profile: bool = False) -> list[dt.date]:
    """Load one day's files and write the reports they change, as one commit
    (idempotent per day); returns the days reported.

    Documented mode keeps terminals as SCD1 + SCD2 (full snapshot) and loads
    the blacklist month-to-date increment; observed mode loads new keys only and
    reports the batch day. ``profile=True`` materialises the card → client chain once.
    """
    report_dt = report_dt or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    tx, term, bl = stage_day(spark, files, mode)
    # Staging is written once and read back: the loads and the report see the
    # same rows even if the source files are replaced meanwhile.
    staged = []
    for name, df in (("stg_transactions", tx), ("stg_terminals", term), ("stg_passport_blacklist", bl)):
        wh.replace(name, df)
        staged.append(spark.read.schema(df.schema).parquet(wh.path(name)))
    tx, term, bl = staged
    with wh.transaction():
        return _load_day(spark, wh, files, batch_dt, tx, term, bl, mode, report_dt, profile)


def _load_day(spark, wh, files, batch_dt, tx, term, bl, mode, report_dt, profile) -> list[dt.date]:
    done = wh.read("meta_ingest_log").select("file_name")
    # Rows whose id, time or amount did not parse are kept aside, once a file; only
    # observed mode loads them all the same, as the original does.
    wh.append("stg_rejects", tx.where(rejected()).join(done, "file_name", "left_anti"))
    good = tx if mode == OBSERVED else tx.where(~rejected())

    loaded = wh.append(FACT, load_new(good, wh.keys_of(FACT), FACT))
    days, later = [batch_dt], None
    if mode == DOCUMENTED:
        listed = load_blacklist_increment(wh, bl, batch_dt)
        if files.terminals:
            later = load_dim_scd(wh, "dwh_dim_terminals", term, batch_dt)
        days = affected_days(wh, batch_dt, wh.read(FACT, parts=loaded),
                             wh.read("dwh_fact_passport_blacklist", parts=listed), later)
    else:
        # Insert-only loads keyed on passport / terminal id, as the original does.
        wh.append("dwh_fact_passport_blacklist",
                  load_new(bl, wh.read("dwh_fact_passport_blacklist"), "dwh_fact_passport_blacklist"))
        wh.append("dwh_dim_terminals", load_new(term, wh.read("dwh_dim_terminals"), "dwh_dim_terminals"))

    chain = None
    if profile:
        wh.replace("stg_card_profile", card_profile(dims_as_of(wh, None)))
        chain = spark.read.parquet(wh.path("stg_card_profile"))
    for day in days:
        dims = dims_as_of(wh, day if mode == DOCUMENTED else None)
        dims.profile = chain
        wh.overwrite_days("rep_fraud", fraud_report(wh.read(FACT), dims, Batch.day(day, good), mode, report_dt), day)

    ledger = (ledger_rows(tx, "transactions", "transaction_date", report_dt, schemas.TRANSACTION_REQUIRED)
              .unionByName(ledger_rows(term, "terminals", None, report_dt))
              .unionByName(ledger_rows(bl, "passport_blacklist", None, report_dt)))
    wh.append("meta_ingest_log", with_empty_files(spark, ledger, paths_of(files), batch_dt, report_dt).join(
        done, "file_name", "left_anti"))
    return days


def paths_of(files: DayFiles) -> list[tuple[str, str]]:
    """(kind, path) of every file of a day."""
    return [(kind, path) for kind, paths in zip(KINDS, (files.transactions, files.terminals, files.blacklist))
            for path in ([paths] if isinstance(paths, str) else paths or [])]


def with_empty_files(spark: SparkSession, ledger: DataFrame, named, batch_dt: dt.date, loaded_at) -> DataFrame:
    """The ledger rows, with a zero row for every delivered file that holds no rows."""
    delivered = None
    for kind, path in named:
        files = spark.read.format("binaryFile").load(path).select(
            source_name(F.col("path")).alias("file_name"), F.lit(kind).alias("kind"))
        delivered = files if delivered is None else delivered.unionByName(files)
    empty = delivered.distinct().join(ledger.select("file_name"), "file_name", "left_anti").select(
        "file_name", "kind", F.coalesce(file_date_from_name("file_name"), date_lit(batch_dt)).alias("batch_dt"),
        F.lit(0).cast("long").alias("rows"), F.lit(0).cast("long").alias("rejected"),
        F.lit(None).cast("timestamp_ntz").alias("max_event_ts"), ts_lit(loaded_at).alias("loaded_at"))
    return ledger.unionByName(empty)


def run_days_frames(staged_days: list[tuple[Batch, DataFrame]], dims: Dims,
                    fact: DataFrame | None = None, mode: str = DOCUMENTED, report_dt=None,
                    rules=None, checkpoint: bool = True) -> DataFrame:
    """Daily loop on frames: each ``(batch, staged rows)`` (warehouse column
    names already) is anti-joined into the fact on ``trans_id``, then reported.
    Returns the union of the daily reports.
    """
    spark = dims.cards.sparkSession
    if checkpoint:
        ensure_checkpoint_dir(spark)
    reports = None
    for batch, staged in staged_days:
        new = insert_new(staged, fact, "trans_id") if fact is not None else staged
        if checkpoint:
            # Only the day's increment is materialised (reliable checkpoint in
            # the shared folder): the plan of day N no longer re-derives days
            # 1..N-1, and the history itself is never copied.
            new = new.checkpoint(eager=True)
        fact = new if fact is None else fact.unionByName(new)
        kwargs = {"rules": rules} if rules else {}
        day = fraud_report(fact, dims, batch, mode, report_dt, **kwargs).withColumn(
            "batch_dt", date_lit(batch.start))
        reports = day if reports is None else reports.unionByName(day)
    return reports


KINDS = {"transactions": "transactions_*.txt", "terminals": "terminals_*.xlsx",
         "passport_blacklist": "passport_blacklist_*.xlsx"}


def listed_files(spark: SparkSession, incoming: str) -> DataFrame:
    """path, file_name and kind of the daily files in a folder (only paths are listed:
    ``binaryFile`` with the content column pruned)."""
    found = None
    for kind, pattern in KINDS.items():
        files = with_kind(spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(incoming).select("path"))
        found = files if found is None else found.unionByName(files)
    return found


def with_kind(paths: DataFrame) -> DataFrame:
    """path, file_name and kind (NULL: none of the daily files)."""
    name = source_name(F.col("path"))
    kind = F.lit(None).cast("string")
    for k, pattern in KINDS.items():
        begin, end = pattern.split("*")
        kind = F.when(name.startswith(begin) & name.endswith(end), k).otherwise(kind)
    return paths.select("path", name.alias("file_name"), kind.alias("kind"))


def pending_days(spark: SparkSession, wh: Warehouse, incoming: str | None = None,
                 files: DataFrame | None = None) -> list[tuple[dt.date, DayFiles]]:
    """Days with files (under ``incoming``, or ``files`` of ``with_kind``) not recorded in
    the ledger, oldest first, if every kind of the day is there or was loaded before: a
    further file of a loaded day makes a run of its own. The driver receives one row per
    pending day."""
    ledger = wh.read("meta_ingest_log")
    todo = ledger_pending(ledger, listed_files(spark, incoming) if files is None else files.where("kind is not null"))
    new = (todo.groupBy("batch_dt").pivot("kind", list(KINDS)).agg(F.sort_array(F.collect_set("path")))
               .where(F.col("batch_dt").isNotNull()))
    old = ledger.groupBy("batch_dt").agg(F.collect_set("kind").alias("had"))
    out = []
    for r in new.join(old, "batch_dt", "left").orderBy("batch_dt").collect():  # one small row per day
        if all(r[k] or k in (r["had"] or ()) for k in KINDS):
            out.append((r["batch_dt"], DayFiles(*[r[k] or [] for k in KINDS])))
    return out


def run_pending(spark: SparkSession, wh: Warehouse, incoming: str | None = None, mode: str = DOCUMENTED,
                report_dt=None, archive: str | None = None, files: DataFrame | None = None) -> list[dt.date]:
    """Process every complete pending day in date order; returns the days run.
    A crash leaves the state before the day, so the next call resumes there. A day that
    fails does not hold up the ones after it; the first failure is raised at the end.
    ``archive``: loaded files are moved there as ``<name>.backup`` after the commit (and,
    if the job died between the two, by the next call)."""
    done, failure = [], None
    if archive:
        _archive_loaded(spark, wh, incoming, files, archive)
    for day, own in pending_days(spark, wh, incoming, files):
        try:
            run_day(spark, wh, own, day, mode, report_dt)
        except Exception as e:  # the day's commit did not happen
            failure = failure or e
            continue
        done.append(day)
        for _, path in paths_of(own) if archive else []:
            move_file(spark, path, posixpath.join(archive, posixpath.basename(path) + ".backup"))
    if failure is not None:
        raise failure
    return done


def _archive_loaded(spark, wh, incoming, files, archive) -> None:
    """Move files that the ledger has already (one small row each, normally none)."""
    here = listed_files(spark, incoming) if files is None else files
    for r in here.join(wh.read("meta_ingest_log").select("file_name"), "file_name", "left_semi").select("path").collect():
        move_file(spark, r["path"], posixpath.join(archive, posixpath.basename(r["path"]) + ".backup"))
