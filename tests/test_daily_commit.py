"""The daily job: one commit a day, late rows, days in any order, further files."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from fraudmart import schemas
from fraudmart.plans.pipeline import bootstrap_dims, load_dim_scd, run_day, run_pending
from fraudmart.sources.tables import FACT, Warehouse
from tests.test_sources_pipeline import C1, C2, SEED_DUMP, _day_files, _tx_file

RUN = dt.datetime(2021, 3, 9)
TABLES = [FACT, "dwh_fact_passport_blacklist", "dwh_dim_terminals", "rep_fraud", "meta_ingest_log", "meta_snapshots", "stg_rejects"]


def _day(n):
    return dt.date(2021, 3, n)


def _seeded(spark, root):
    dump = os.path.join(os.path.dirname(root), "seed.sql")
    with open(dump, "w", encoding="utf-8") as f:
        f.write(SEED_DUMP)
    wh = Warehouse(spark, root)
    bootstrap_dims(spark, wh, dump, run_dt=_day(1))
    return wh


def _state(spark, root):
    wh = Warehouse(spark, root)
    hist = wh.read("dwh_dim_terminals_hist", schemas.scd2_schema(schemas.DIM_TERMINALS))
    return {**{t: sorted(map(str, wh.read(t).collect())) for t in TABLES}, "hist": sorted(map(str, hist.collect()))}


def _three_days(inbox):
    """Day 1's row u1 comes with day 2 and lies between two others; day 2's row x2 comes
    with day 1; day 2's terminals differ; C2's passport is listed on day 2, told on day 3."""
    os.makedirs(inbox)
    t = lambda i, d, time, card, term: [i, f"2021-03-0{d} {time}", "10,50", card, "PAYMENT", "SUCCESS", term]
    a, b = ["A1", "POS", "Moscow", "a"], ["B2", "POS", "Kazan", "b"]
    return {1: _day_files(inbox, _day(1), [t("t1", 1, "10:00:00", C1, "A1"), t("v1", 1, "10:40:00", C1, "A1"),
                                           t("w1", 1, "23:50:00", C2, "A1"), t("x2", 2, "00:05:00", C2, "B2")], [a, b], [[44256, "1234 567890"]]),
            2: _day_files(inbox, _day(2), [t("t2", 2, "10:00:00", C2, "A1"), t("u1", 1, "10:20:00", C1, "B2"),
                                           t("u2", 2, "10:30:00", C2, "B2"), t("t1", 1, "10:00:00", C1, "A1")],
                          [a, ["B2", "POS", "Moscow", "b"]], [[44256, "1234 567890"]]),
            3: _day_files(inbox, _day(3), [t("t3", 3, "10:00:00", C1, "A1"), t("u3", 3, "10:30:00", C1, "B2"),
                                           t("?", 3, "99:99:99", C1, "A1")],
                          [a, b], [[44256, "1234 567890"], [44257, "9999 000001"]])}


def test_a_failure_after_any_write_leaves_the_old_state(spark, tmp_root, monkeypatch):
    root = os.path.join(tmp_root, "wh")
    _seeded(spark, root)
    files = _three_days(os.path.join(tmp_root, "in"))[3]
    before, writes, real = _state(spark, root), [], Warehouse._write

    def counted(self, name, df, fail=None):
        if len(writes) == fail:
            raise OSError("disk")
        writes.append(name)
        return real(self, name, df)

    monkeypatch.setattr(Warehouse, "_write", counted)
    run_day(spark, Warehouse(spark, os.path.join(tmp_root, "other")), files, _day(3), report_dt=RUN)
    points = list(writes)
    assert len(points) == 8 and points[0] == "stg_rejects" and points[-1] == "meta_ingest_log"
    for k in range(len(points)):
        writes.clear()
        monkeypatch.setattr(Warehouse, "_write", lambda self, name, df, k=k: counted(self, name, df, k))
        wh = Warehouse(spark, root)
        with pytest.raises(OSError):
            run_day(spark, wh, files, _day(3), report_dt=RUN)
        assert wh.read(FACT).count() == 0  # the same object reads the old state too
    monkeypatch.setattr(Warehouse, "_write", real)
    with monkeypatch.context() as m:
        m.setattr(Warehouse, "_publish", lambda *a: (_ for _ in ()).throw(OSError("commit")))
        with pytest.raises(OSError):
            run_day(spark, Warehouse(spark, root), files, _day(3), report_dt=RUN)
    assert _state(spark, root) == before
    run_day(spark, Warehouse(spark, root), files, _day(3), report_dt=RUN)
    after = _state(spark, root)
    assert len(after[FACT]) == 2 and len(after["stg_rejects"]) == 1 and len(after["meta_ingest_log"]) == 3
    wh = Warehouse(spark, root)
    assert wh.vacuum() > 5 and _state(spark, root) == after and wh.vacuum() == 0


def test_days_in_any_order_give_one_mart(spark, tmp_root):
    days, states = _three_days(os.path.join(tmp_root, "in")), []
    for order in ((1, 2, 3), (3, 1, 2)):
        root = os.path.join(tmp_root, "".join(map(str, order)), "wh")
        os.makedirs(os.path.dirname(root))
        wh = _seeded(spark, root)
        reported = [run_day(spark, wh, days[n], _day(n), report_dt=RUN) for n in order]
        if order == (1, 2, 3):
            assert reported[1] == [_day(1), _day(2)] and _day(1) not in reported[2]
        states.append(_state(spark, root))
    run_day(spark, wh, days[1], _day(1), report_dt=RUN)  # again: nothing changes
    assert _state(spark, root) == states[-1]
    names = [t for t in states[0] if t != "meta_snapshots"]
    assert all({t: s[t] for t in names} == {t: states[0][t] for t in names} for s in states)
    rows = {(r["batch_dt"].day, r["event_dt"].strftime("%H:%M"), r["event_type"])
            for r in Warehouse(spark, root).read("rep_fraud").collect()}
    assert {r for r in rows if r[2] == "different city"} == {
        (1, "10:20", "different city"), (1, "10:40", "different city"),  # the late row and the one after it
        (3, "10:30", "different city")}  # on day 2 both terminals are in Moscow, at its own 00:05 too
    assert {(d, t) for d, t, e in rows if e == "passport in blacklist"} == {
        (1, "10:00"), (1, "10:20"), (1, "10:40"), (2, "00:05"), (2, "10:00"), (2, "10:30"), (3, "10:00"), (3, "10:30")}
    assert len(rows) == Warehouse(spark, root).read("rep_fraud").count()


def test_further_file_failed_day_and_archive(spark, tmp_root):
    inbox, archive, root = (os.path.join(tmp_root, x) for x in ("in", "archive", "wh"))
    _three_days(inbox)
    with open(os.path.join(inbox, "terminals_02032021.xlsx"), "wb") as f:
        f.write(b"no workbook")
    wh = _seeded(spark, root)
    with pytest.raises(Exception):
        run_pending(spark, wh, inbox, report_dt=RUN, archive=archive)
    assert {r["batch_dt"].day for r in wh.read("meta_ingest_log").collect()} == {1, 3}  # day 2 holds up nothing
    assert sorted(os.listdir(archive)) == sorted(f"{k}_0{n}032021.{e}.backup" for n in (1, 3) for k, e in (
        ("transactions", "txt"), ("terminals", "xlsx"), ("passport_blacklist", "xlsx")))
    _tx_file(os.path.join(inbox, "transactions_more_01032021.txt"),
             [["m1", "2021-03-01 10:50:00", "1.00", C1, "PAYMENT", "SUCCESS", "B2"]])
    days = _three_days(os.path.join(tmp_root, "again"))
    os.replace(days[2].terminals, os.path.join(inbox, "terminals_02032021.xlsx"))
    assert run_pending(spark, wh, inbox, report_dt=RUN, archive=archive) == [_day(1), _day(2)]
    assert [f for f in os.listdir(inbox) if not f.endswith(".crc")] == []
    cities = [r["event_dt"].strftime("%H:%M") for r in wh.read("rep_fraud").where("event_type = 'different city'").collect()]
    assert sorted(cities) == ["10:20", "10:30", "10:40", "10:50"]


def test_corrected_snapshot_and_bytes_written(spark, tmp_root):
    root = os.path.join(tmp_root, "wh")
    wh, cols = Warehouse(spark, root), "terminal_id string, terminal_type string, terminal_city string, terminal_address string"
    snap = lambda *rows: spark.createDataFrame([(k, "POS", c, "x") for k, c in rows], cols)
    load_dim_scd(wh, "dwh_dim_terminals", snap(("P1", "A")), _day(1))
    load_dim_scd(wh, "dwh_dim_terminals", snap(("P1", "B"), ("P2", "A")), _day(2))
    load_dim_scd(wh, "dwh_dim_terminals", snap(("P1", "A")), _day(2))  # the right one
    now = [tuple(r) for r in wh.read("dwh_dim_terminals").select("terminal_id", "terminal_city", "create_dt", "update_dt").collect()]
    assert now == [("P1", "A", _day(1), None)]
    # a dimension that changes wholly each day: the closed versions are not written again
    sizes = []
    for n in range(3, 9):
        load_dim_scd(wh, "dwh_dim_terminals", snap(*[(f"T{i}", f"{n}") for i in range(50)]), _day(n))
        newest = wh.from_day("dwh_dim_terminals_hist", _day(n))
        sizes.append(wh.read("dwh_dim_terminals_hist", schemas.scd2_schema(schemas.DIM_TERMINALS), newest).count())
    assert sizes[-1] == sizes[-2] == sizes[2] <= 102  # 50 ended, 50 and P1's marker hold
    assert wh.read("dwh_dim_terminals_hist", schemas.scd2_schema(schemas.DIM_TERMINALS)).where(
        F.col("terminal_id") == "T7").count() == 6
