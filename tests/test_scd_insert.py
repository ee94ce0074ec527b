"""Snapshots in any order give the history of the snapshots in order."""

import datetime as dt
import itertools
import random

import pytest

from fraudmart.operators.scd import scd2_init, scd2_insert, scd2_step

END = dt.datetime(9999, 12, 31, 23, 59, 59)
HIST = ("k string, a string, b int, effective_from timestamp_ntz, effective_to timestamp_ntz, deleted_flg boolean, "
        "create_dt date, update_dt date")


def day(n):
    return dt.datetime(2021, 3, n)


def replay(snaps):
    """Plain history of {day: {key: attributes}}, key by key in the order of days."""
    out, days = [], sorted(snaps)
    for key in sorted({k for s in snaps.values() for k in s}):
        versions, create, update = [], None, None
        for d in days:
            now = snaps[d].get(key)
            last = versions[-1] if versions else None
            if last is None:
                if now is not None:
                    create = d
                    versions.append([now, d, END, False, create, None])
                continue
            state = (now if now is not None else last[0], now is None)
            if state != (last[0], last[3]):
                if state[0] != last[0]:
                    update = d
                last[2] = day(d) - dt.timedelta(seconds=1)
                versions.append([state[0], d, END, state[1], create, update])
        out += [(key, *v, day(f), t, gone, day(c).date(), day(u).date() if u else None) for v, f, t, gone, c, u in versions]
    return sorted(out, key=str)


def loaded(spark, snaps, order):
    hist, done = spark.createDataFrame([], HIST), []
    for d in order:
        rows = [(k, *v) for k, v in snaps[d].items()] if d in snaps else []
        snap = spark.createDataFrame(rows, "k string, a string, b int")
        later = [x for x in done if x > d]
        before = day(d) - dt.timedelta(seconds=1)
        stay = hist.where(hist.effective_to < before)
        made = scd2_insert(hist.where(hist.effective_to >= before), snap, "k", ["a", "b"], day(d), day(min(later)) if later else None)
        hist = spark.createDataFrame(stay.unionByName(made).collect(), HIST)
        done.append(d)
    return sorted(map(tuple, hist.collect()), key=str)


@pytest.mark.parametrize("order", list(itertools.permutations([1, 3, 5])))
def test_every_order_of_three_snapshots(spark, order):
    rng = random.Random(3)
    states = [None, ("x", 1), ("y", None)]
    keys = {f"k{i}{j}{m}": (states[i], states[j], states[m]) for i in range(3) for j in range(3) for m in range(3)}
    snaps = {d: {k: v[n] for k, v in keys.items() if v[n] is not None} for n, d in enumerate((1, 3, 5))}
    assert rng and loaded(spark, snaps, order) == replay(snaps)


def test_a_second_snapshot_of_a_day_replaces_the_first(spark):
    old = {1: {"p": ("x", 1), "q": ("x", 1)}, 2: {"p": ("wrong", 1), "r": ("x", 1)}, 3: {"p": ("z", 1)}}
    new = {**old, 2: {"p": ("x", 1), "q": ("x", 1)}}
    hist = spark.createDataFrame(loaded(spark, old, [1, 2, 3]), HIST)
    snap = spark.createDataFrame([("p", "x", 1), ("q", "x", 1)], "k string, a string, b int")
    before = day(2) - dt.timedelta(seconds=1)
    made = hist.where(hist.effective_to < before).unionByName(
        scd2_insert(hist.where(hist.effective_to >= before), snap, "k", ["a", "b"], day(2), day(3)))
    assert sorted(map(tuple, made.collect()), key=str) == replay(new)


def test_random_orders_of_many_days(spark):
    rng = random.Random(8)
    snaps = {d: {k: (rng.choice("xy"), rng.choice([1, 2])) for k in "abcdefgh" if rng.random() < 0.6} for d in (1, 2, 4, 5, 8, 9)}
    order = list(snaps)
    rng.shuffle(order)
    assert loaded(spark, snaps, order) == replay(snaps)


def test_step_on_frames_without_dates(spark):
    snap = lambda *rows: spark.createDataFrame(rows, "k string, a string")
    rows = lambda df: sorted(map(tuple, df.collect()))
    one, two, three = snap(("x", "1"), ("y", "1")), snap(("x", "2")), snap(("x", "2"), ("y", "1"))
    in_order = scd2_step(scd2_step(scd2_init(one, "k", ["a"], day(1)), two, "k", ["a"], day(2)), three, "k", ["a"], day(3))
    late = scd2_step(scd2_step(scd2_init(one, "k", ["a"], day(1)), three, "k", ["a"], day(3)), two, "k", ["a"], day(2), day(3))
    assert rows(in_order) == rows(late) and len(rows(late)) == 5
