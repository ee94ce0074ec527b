"""Sources (delimited, workbook, dump), the file-based daily job, streaming ingest."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fraudmart import schemas
from fraudmart.functions import file_date_from_name
from fraudmart.plans.pipeline import DayFiles, bootstrap_dims, run_day
from fraudmart.sources.delimited import read_delimited
from fraudmart.sources.dump import read_insert_dump
from fraudmart.sources.tables import Warehouse
from fraudmart.plans.workbook_files import write_workbook
from fraudmart.sources.workbook import excel_date, read_workbook

SEED_DUMP = """/*
cards
*/
create table cards(
\tcard_num varchar(128),
\taccount varchar(128),
\tcreate_dt date,
\tupdate_dt date
);

insert into cards (card_num, account, create_dt, update_dt)
values ('1111 0000 0000 0001', \t'40817810000000000001', '2001-01-01', null);
insert into cards (card_num, account, create_dt, update_dt)
values ('1111 0000 0000 0002', \t'40817810000000000002', '2001-01-01', null);

create table accounts(account varchar(128), valid_to date, client integer, create_dt date, update_dt date);
insert into accounts (account, valid_to, client, create_dt, update_dt)
\tvalues ('40817810000000000001',\t\t'2021-03-02',\t\t'1001', '1900-01-01', null);
insert into accounts (account, valid_to, client, create_dt, update_dt)
\tvalues ('40817810000000000002',\t\t'2025-01-01',\t\t'VIP-1002', '1900-01-01', null);

insert into clients (client_id, last_name, first_name, patronymic, date_of_birth, passport_num, passport_valid_to, phone, create_dt, update_dt)
\tvalues ('1001'     , 'Иванов',     'Пётр',     'Сергеевич',  '1980-01-01', '1234 567890', null , '+7 900 111-22-33', '1900-01-01', null);
insert into clients (client_id, last_name, first_name, patronymic, date_of_birth, passport_num, passport_valid_to, phone, create_dt, update_dt)
\tvalues ('VIP-1002' , 'O''Brien',    'Анна',     'Ивановна',   '1990-05-05', '9999 000001', '2021-03-01', '+7 900 444-55-66', '1900-01-01', null);
"""

C1, C2 = "1111 0000 0000 0001", "1111 0000 0000 0002"


def _tx_file(path, rows):
    with open(path, "w", encoding="utf-8") as f:
        f.write("transaction_id;transaction_date;amount;card_num;oper_type;oper_result;terminal\n")
        for r in rows:
            f.write(";".join(r) + "\n")


def _day_files(root, day, tx_rows, terminals, blacklist):
    tag = day.strftime("%d%m%Y")
    tx = os.path.join(root, f"transactions_{tag}.txt")
    term = os.path.join(root, f"terminals_{tag}.xlsx")
    bl = os.path.join(root, f"passport_blacklist_{tag}.xlsx")
    _tx_file(tx, tx_rows)
    write_workbook(term, {"Sheet1": [["terminal_id", "terminal_type", "terminal_city", "terminal_address"]]
                          + terminals})
    write_workbook(bl, {"blacklist": [["date", "passport"]] + blacklist})
    return DayFiles(tx, term, bl)


def test_read_delimited_comma_decimals_and_file_date(spark, tmp_root):
    p = os.path.join(tmp_root, "transactions_01032021.txt")
    _tx_file(p, [["1", "2021-03-01 10:00:00", "5849,56", C1, "PAYMENT", "SUCCESS", "A1"]])
    row = read_delimited(spark, p, decimal_comma=True).collect()[0]
    assert row["amount"] == Decimal("5849.56")
    assert row["file_dt"] == dt.date(2021, 3, 1) and row["file_name"] == "transactions_01032021.txt"
    assert row["transaction_date"] == dt.datetime(2021, 3, 1, 10, 0, 0)


def test_file_date_from_name(spark):
    df = spark.createDataFrame([("a/transactions_03032021.txt",), ("x/terminals_31022021.xlsx",),
                                ("no_date.txt",)], "f string")
    got = [r[0] for r in df.select(file_date_from_name("f")).collect()]
    assert got == [dt.date(2021, 3, 3), None, None]


def test_read_workbook_last_sheet_and_dates(spark, tmp_root):
    p = os.path.join(tmp_root, "passport_blacklist_01032021.xlsx")
    write_workbook(p, {"old": [["date", "passport"], [44255, "0000 000000"]],
                       "cur": [["passport", "date"], ["1234 567890", 44256], ["5555 555555", "2021-03-01"]]})
    last = read_workbook(spark, p, ["date", "passport"]).select(excel_date("date").alias("d"), "passport")
    assert sorted((r["passport"], r["d"]) for r in last.collect()) == [
        ("1234 567890", dt.date(2021, 3, 1)), ("5555 555555", dt.date(2021, 3, 1))]
    every = read_workbook(spark, p, ["date", "passport"], sheets="all")
    assert every.count() == 3


def test_read_insert_dump_handmade(spark, tmp_root):
    p = os.path.join(tmp_root, "seed.sql")
    with open(p, "w", encoding="utf-8") as f:
        f.write(SEED_DUMP)
    clients = {r["client_id"]: r for r in read_insert_dump(spark, p, "clients", schemas.SEED_CLIENTS).collect()}
    assert set(clients) == {"1001", "VIP-1002"}
    assert clients["VIP-1002"]["last_name"] == "O'Brien"
    assert clients["1001"]["passport_valid_to"] is None
    assert clients["1001"]["last_name"] == "Иванов"
    assert read_insert_dump(spark, p, "cards", schemas.SEED_CARDS).count() == 2


SEED_FILE = os.environ.get("FRAUDMART_SEED_DUMP", "")


@pytest.mark.skipif(not os.path.isfile(SEED_FILE), reason="set FRAUDMART_SEED_DUMP to the bank seed dump")
def test_read_insert_dump_seed_profile(spark):
    """The bank seed read as data: 195 cards, 77 accounts, 50 clients."""
    cards = read_insert_dump(spark, SEED_FILE, "cards", schemas.SEED_CARDS)
    accounts = read_insert_dump(spark, SEED_FILE, "accounts", schemas.SEED_ACCOUNTS)
    clients = read_insert_dump(spark, SEED_FILE, "clients", schemas.SEED_CLIENTS)
    assert (cards.count(), accounts.count(), clients.count()) == (195, 77, 50)
    vip = accounts.where(F.col("client").startswith("VIP-"))
    assert (vip.count(), vip.select("client").distinct().count()) == (6, 4)
    assert clients.where(F.col("passport_valid_to").isNull()).count() == 21
    assert cards.select("card_num").distinct().count() == 195
    assert accounts.where(F.col("valid_to") == F.lit("2021-03-02").cast("date")).count() == 1


def test_daily_job_end_to_end(spark, tmp_root):
    inbox = os.path.join(tmp_root, "in")
    os.makedirs(inbox)
    dump = os.path.join(tmp_root, "seed.sql")
    with open(dump, "w", encoding="utf-8") as f:
        f.write(SEED_DUMP)
    wh = Warehouse(spark, os.path.join(tmp_root, "wh"))
    assert bootstrap_dims(spark, wh, dump) == {"dwh_dim_cards": 2, "dwh_dim_accounts": 2, "dwh_dim_clients": 2}
    assert bootstrap_dims(spark, wh, dump)["dwh_dim_cards"] == 2  # rerun adds nothing

    terms = [["A1", "POS", "Moscow", "a"], ["P2", "POS", "Kazan", "b"]]
    d1 = _day_files(inbox, dt.date(2021, 3, 1), [
        ["t1", "2021-03-01 10:00:00", "100.00", C1, "PAYMENT", "SUCCESS", "A1"],
        ["t2", "2021-03-01 10:30:00", "90.00", C1, "PAYMENT", "SUCCESS", "P2"],
        ["t3", "2021-03-01 11:00:00", "10.00", C2, "PAYMENT", "SUCCESS", "A1"],
    ], terms, [[44256, "1234 567890"]])
    d2 = _day_files(inbox, dt.date(2021, 3, 2), [
        ["t4", "2021-03-02 00:00:00", "5.00", C1, "PAYMENT", "SUCCESS", "A1"],
        ["t1", "2021-03-01 10:00:00", "100.00", C1, "PAYMENT", "SUCCESS", "A1"],  # delivered again
        ["t9", "2021-03-02 25:61:00", "5,00.x", C1, "PAYMENT", "SUCCESS", "A1"],  # does not parse
    ], terms, [[44256, "1234 567890"], [44257, "5555 555555"]])
    run_dt = dt.datetime(2021, 3, 4, 12, 0, 0)
    run_day(spark, wh, d1, dt.date(2021, 3, 1), report_dt=run_dt)
    run_day(spark, wh, d2, dt.date(2021, 3, 2), report_dt=run_dt)
    run_day(spark, wh, d2, dt.date(2021, 3, 2), report_dt=run_dt, profile=True)  # rerun: idempotent

    assert wh.read("dwh_fact_transactions").count() == 4
    assert wh.read("dwh_fact_passport_blacklist").count() == 2
    assert wh.read("dwh_dim_terminals").count() == 2
    rep = {(r["batch_dt"].day, r["event_type"], r["event_dt"].hour) for r in wh.read("rep_fraud").collect()}
    assert rep == {
        (1, "passport in blacklist", 10),      # t1, t2: client 1001 is blacklisted
        (1, "different city", 10),             # t2: Kazan 30 min after Moscow
        (1, "passport not valid", 11),         # t3: VIP-1002 passport ended 2021-03-01
        (2, "passport in blacklist", 0),       # t4
        (2, "account not valid", 0),           # t4 at 00:00 of valid_to day 2021-03-02
    }
    assert wh.read("rep_fraud").count() == 6
    ledger = wh.read("meta_ingest_log")
    assert ledger.where(F.col("kind") == "transactions").select("file_name").count() == 2
    day2 = ledger.where(F.col("file_name") == "transactions_02032021.txt").first()
    assert (day2["rows"], day2["rejected"]) == (3, 1)
    assert [r["transaction_id"] for r in wh.read("stg_rejects", schemas.TRANSACTIONS_FILE).collect()] == ["t9"]


def test_stream_ingest_exactly_once(spark, tmp_root):
    from fraudmart.streaming.ingest import ingest_available_now
    inbox, sink, ckpt, archive = (os.path.join(tmp_root, x) for x in ("in", "sink", "ckpt", "archive"))
    os.makedirs(inbox)
    _tx_file(os.path.join(inbox, "transactions_01032021.txt"),
             [["1", "2021-03-01 10:00:00", "1.00", C1, "PAYMENT", "SUCCESS", "A1"]])
    ingest_available_now(spark, inbox, sink, ckpt, archive=archive)
    _tx_file(os.path.join(inbox, "transactions_02032021.txt"),
             [["2", "2021-03-02 10:00:00", "2.00", C1, "PAYMENT", "SUCCESS", "A1"]])
    ingest_available_now(spark, inbox, sink, ckpt, archive=archive)
    ingest_available_now(spark, inbox, sink, ckpt, archive=archive)  # nothing new
    out = spark.read.parquet(sink)
    assert sorted(r["transaction_id"] for r in out.collect()) == ["1", "2"]
    assert {r["batch_dt"] for r in out.collect()} == {dt.date(2021, 3, 1), dt.date(2021, 3, 2)}
    archived = [f for _, _, fs in os.walk(archive) for f in fs]
    assert "transactions_01032021.txt" in archived  # moved when the next batch started


def test_daily_job_keeps_terminal_history(spark, tmp_root):
    inbox = os.path.join(tmp_root, "in")
    os.makedirs(inbox)
    dump = os.path.join(tmp_root, "seed.sql")
    with open(dump, "w", encoding="utf-8") as f:
        f.write(SEED_DUMP)
    wh = Warehouse(spark, os.path.join(tmp_root, "wh"))
    bootstrap_dims(spark, wh, dump)
    tx = [["t1", "2021-03-01 10:00:00", "1.00", C1, "PAYMENT", "SUCCESS", "A1"]]
    d1 = _day_files(inbox, dt.date(2021, 3, 1), tx, [["A1", "POS", "Moscow", "a"], ["P2", "POS", "Kazan", "b"]],
                    [[44256, "1234 567890"]])
    d2 = _day_files(inbox, dt.date(2021, 3, 2), tx, [["A1", "POS", "Tver", "a"]],
                    [[44256, "1234 567890"], [44256, "7777 777777"]])
    run_day(spark, wh, d1, dt.date(2021, 3, 1), report_dt=dt.datetime(2021, 3, 4))
    run_day(spark, wh, d2, dt.date(2021, 3, 2), report_dt=dt.datetime(2021, 3, 4))
    cur = {r["terminal_id"]: r for r in wh.read("dwh_dim_terminals").collect()}
    assert cur["A1"]["terminal_city"] == "Tver" and cur["A1"]["update_dt"] == dt.date(2021, 3, 2)
    assert cur["A1"]["create_dt"] == dt.date(2021, 3, 1) and cur["P2"]["terminal_city"] == "Kazan"
    hist = sorted((r["terminal_id"], r["terminal_city"], r["deleted_flg"], r["effective_to"].year)
                  for r in wh.read("dwh_dim_terminals_hist", schemas.scd2_schema(schemas.DIM_TERMINALS)).collect())
    assert hist == [("A1", "Moscow", False, 2021), ("A1", "Tver", False, 9999),
                    ("P2", "Kazan", False, 2021), ("P2", "Kazan", True, 9999)]
    # month-to-date file: a second passport dated the 1st arrives with the 2nd's file
    bl = sorted(r["passport_num"] for r in wh.read("dwh_fact_passport_blacklist").collect())
    assert bl == ["1234 567890", "7777 777777"]


def test_run_pending_days_in_order_once(spark, tmp_root):
    from fraudmart.plans.pipeline import run_pending
    inbox = os.path.join(tmp_root, "in")
    os.makedirs(inbox)
    dump = os.path.join(tmp_root, "seed.sql")
    with open(dump, "w", encoding="utf-8") as f:
        f.write(SEED_DUMP)
    wh = Warehouse(spark, os.path.join(tmp_root, "wh"))
    bootstrap_dims(spark, wh, dump)
    terms = [["A1", "POS", "Moscow", "a"], ["P2", "POS", "Kazan", "b"]]
    _day_files(inbox, dt.date(2021, 3, 2), [["t2", "2021-03-02 10:00:00", "1.00", C1, "PAYMENT", "SUCCESS", "P2"]],
               terms, [[44256, "1234 567890"]])
    _day_files(inbox, dt.date(2021, 3, 1), [["t1", "2021-03-01 10:00:00", "1.00", C1, "PAYMENT", "SUCCESS", "A1"]],
               terms, [[44256, "1234 567890"]])
    _tx_file(os.path.join(inbox, "transactions_03032021.txt"), [])  # incomplete day: waits
    assert run_pending(spark, wh, inbox, report_dt=dt.datetime(2021, 3, 4)) == [dt.date(2021, 3, 1), dt.date(2021, 3, 2)]
    assert run_pending(spark, wh, inbox) == []
    assert sorted(r["trans_id"] for r in wh.read("dwh_fact_transactions").collect()) == ["t1", "t2"]
    assert {r["batch_dt"] for r in wh.read("rep_fraud").collect()} == {dt.date(2021, 3, 1), dt.date(2021, 3, 2)}


def test_stream_of_files_runs_days_in_order(spark, tmp_root):
    """Files of three days, the last day's first, one file a micro-batch, comma amounts:
    the mart of the batch job."""
    from fraudmart.plans.pipeline import run_pending
    from fraudmart.streaming.ingest import run_days_stream
    inbox = os.path.join(tmp_root, "in")
    os.makedirs(inbox)
    dump = os.path.join(tmp_root, "seed.sql")
    with open(dump, "w", encoding="utf-8") as f:
        f.write(SEED_DUMP)
    cities = {1: "Moscow", 2: "Tver", 3: "Kazan"}
    for at, n in enumerate((3, 1, 2)):
        day = dt.date(2021, 3, n)
        made = _day_files(inbox, day, [[f"t{n}", f"{day} 10:00:00", "5849,56", C1, "PAYMENT", "SUCCESS", "A1"],
                                       [f"u{n}", f"{day} 10:20:00", "7,00", C1, "PAYMENT", "SUCCESS", "B2"]],
                          [["A1", "POS", cities[n], "a"], ["B2", "POS", "Kazan", "b"]], [[44255 + n, "1234 567890"]])
        for k, path in enumerate((made.blacklist, made.transactions, made.terminals)):
            os.utime(path, (1_600_000_000 + 10 * at + k,) * 2)
    run_dt, results = dt.datetime(2021, 3, 4), []
    for way in ("stream", "batch"):
        wh = Warehouse(spark, os.path.join(tmp_root, way))
        bootstrap_dims(spark, wh, dump, run_dt=dt.date(2021, 3, 1))
        for _ in range(2):  # nothing new the second time
            if way == "stream":
                run_days_stream(spark, wh, inbox, os.path.join(tmp_root, "ckpt"), report_dt=run_dt, max_files=1)
            else:
                run_pending(spark, wh, inbox, report_dt=run_dt)
        amounts = sorted((r["trans_id"], r["amt"]) for r in wh.read("dwh_fact_transactions").collect())
        hist = sorted(map(str, wh.read("dwh_dim_terminals_hist", schemas.scd2_schema(schemas.DIM_TERMINALS)).collect()))
        results.append((amounts, sorted(map(str, wh.read("rep_fraud").collect())), hist,
                        sorted(map(str, wh.read("meta_ingest_log").collect()))))
    assert results[0] == results[1]
    assert results[0][0][0] == ("t1", Decimal("5849.56")) and len(results[0][0]) == 6
    assert sum("different city" in r for r in results[0][1]) == 2 and len(results[0][3]) == 9


def test_bootstrap_documented_keeps_dimension_history(spark, tmp_root):
    wh = Warehouse(spark, os.path.join(tmp_root, "wh"))
    dump = os.path.join(tmp_root, "seed.sql")
    with open(dump, "w", encoding="utf-8") as f:
        f.write(SEED_DUMP)
    counts = bootstrap_dims(spark, wh, dump, mode="documented", run_dt=dt.date(2021, 3, 1))
    assert counts == {"dwh_dim_cards": 2, "dwh_dim_accounts": 2, "dwh_dim_clients": 2}
    with open(dump, "w", encoding="utf-8") as f:  # next snapshot: a new phone number
        f.write(SEED_DUMP.replace("+7 900 111-22-33", "+7 900 999-99-99"))
    bootstrap_dims(spark, wh, dump, mode="documented", run_dt=dt.date(2021, 3, 2))
    cli = {r["client_id"]: r for r in wh.read("dwh_dim_clients").collect()}
    assert cli["1001"]["phone"] == "+7 900 999-99-99" and cli["1001"]["update_dt"] == dt.date(2021, 3, 2)
    assert cli["VIP-1002"]["update_dt"] is None and cli["VIP-1002"]["create_dt"] == dt.date(2021, 3, 1)
    hist = wh.read("dwh_dim_clients_hist", schemas.scd2_schema(schemas.DIM_CLIENTS))
    assert sorted((r["client_id"], r["phone"]) for r in hist.collect()) == [
        ("1001", "+7 900 111-22-33"), ("1001", "+7 900 999-99-99"), ("VIP-1002", "+7 900 444-55-66")]


def test_bucketed_fact_same_results_without_fact_shuffle(spark, tmp_root):
    inbox = os.path.join(tmp_root, "in")
    os.makedirs(inbox)
    dump = os.path.join(tmp_root, "seed.sql")
    with open(dump, "w", encoding="utf-8") as f:
        f.write(SEED_DUMP)
    terms = [["A1", "POS", "Moscow", "a"], ["P2", "POS", "Kazan", "b"]]
    d1 = _day_files(inbox, dt.date(2021, 3, 1), [
        ["t1", "2021-03-01 10:00:00", "100.00", C1, "PAYMENT", "SUCCESS", "A1"],
        ["t2", "2021-03-01 10:30:00", "90.00", C1, "PAYMENT", "SUCCESS", "P2"]], terms, [[44256, "1234 567890"]])
    d2 = _day_files(inbox, dt.date(2021, 3, 2), [
        ["t3", "2021-03-02 09:00:00", "5.00", C2, "PAYMENT", "SUCCESS", "A1"],
        ["t1", "2021-03-01 10:00:00", "100.00", C1, "PAYMENT", "SUCCESS", "A1"]], terms, [[44256, "1234 567890"]])
    results = []
    for buckets in (None, True):
        wh = Warehouse(spark, os.path.join(tmp_root, f"wh{buckets}"), fact_buckets=buckets)
        bootstrap_dims(spark, wh, dump, run_dt=dt.date(2021, 3, 1))
        for files, day in ((d1, dt.date(2021, 3, 1)), (d2, dt.date(2021, 3, 2))):
            run_day(spark, wh, files, day, report_dt=dt.datetime(2021, 3, 4))
        fact = sorted(r["trans_id"] for r in wh.read("dwh_fact_transactions").collect())
        rep = sorted(tuple(r) for r in wh.read("rep_fraud").collect())
        results.append((fact, rep))
        if buckets:
            from fraudmart.operators.load import insert_new
            staged = wh.read("dwh_fact_transactions").limit(0).unionByName(
                wh.read("dwh_fact_transactions"))
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
            try:
                plan = insert_new(staged, wh.keys_of("dwh_fact_transactions"), "trans_id")._jdf \
                    .queryExecution().executedPlan().toString()
            finally:
                spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
            assert "Bucketed: true" in plan
    assert results[0] == results[1] and results[0][0] == ["t1", "t2", "t3"]


def test_command_line_runs_seed_and_pending_days(spark, tmp_root):
    from fraudmart.__main__ import main
    inbox = os.path.join(tmp_root, "in")
    os.makedirs(inbox)
    dump = os.path.join(tmp_root, "seed.sql")
    with open(dump, "w", encoding="utf-8") as f:
        f.write(SEED_DUMP)
    _day_files(inbox, dt.date(2021, 3, 1), [["t1", "2021-03-01 10:00:00", "1.00", C1, "PAYMENT", "SUCCESS", "A1"]],
               [["A1", "POS", "Moscow", "a"]], [[44256, "1234 567890"]])
    root = os.path.join(tmp_root, "wh")
    out = main(["--warehouse", root, "--incoming", inbox, "--seed", dump])
    assert out == {"dimensions": {"dwh_dim_cards": 2, "dwh_dim_accounts": 2, "dwh_dim_clients": 2},
                   "days": ["2021-03-01"]}
    assert main(["--warehouse", root, "--incoming", inbox])["days"] == []
    assert Warehouse(spark, root).read("rep_fraud").count() == 1
