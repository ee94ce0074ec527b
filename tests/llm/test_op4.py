"""SimHash near-duplicates against brute force."""

import random

import xxhash
from pyspark.sql import functions as F

import pytest

from fraudmart.llm import op4_simhash_near_dup as op4


def slow_print(text, shingle=4):
    words, word = [], ""
    for c in (text or "") + " ":
        if c in " \t\n\x0b\x0c\r":
            words, word = words + ([word] if word else []), ""
        else:
            word += c.lower() if "A" <= c <= "Z" else c
    if not words:
        return 0
    grams = [" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    prints = [slow_print(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 4 and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {}
    for (key, _), g in zip(rows, group):
        if key is not None:
            least[g] = min(key, least.get(g, key))
    return sorted(((k, p, least.get(g)) for (k, _), p, g in zip(rows, prints, group)), key=str)


@pytest.mark.parametrize("hot", [0, 20, 1024])  # no component looked up, some, all
def test_texts_against_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(op4, "HOT", hot)
    rng = random.Random(1)
    base = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(120)) for _ in range(12)]
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "One"), (6, "a b c"), (7, "Ünï a b ÉÉ c"), (None, "one"),
            (None, "solo text without any id at all"), (8, "x" * 5000), (9, "dup"), (9, "dup")]
    for i, b in enumerate(base):
        for k in range(6):
            words = b.split()
            for _ in range(k):
                words[rng.randrange(len(words))] = "zz"
            rows.append((100 - i * 6 - k, " ".join(words)))
    df = spark.createDataFrame([(k, t, 1, "x") for k, t in rows], "doc_id long, text string, fp int, component_id string")
    got = [(r["id"], r["fp"] % (1 << 64), r["component_id"]) for r in op4.near_duplicates(df).collect()]
    assert sorted(got, key=str) == brute(rows)
    assert op4.near_duplicates(df.filter(F.lit(False))).count() == 0


def test_links_of_fingerprints_against_brute_force(spark):
    rng = random.Random(2)
    prints = set()
    for _ in range(6):  # a chain and a crowd around each centre
        c = rng.getrandbits(64)
        prints.add(c)
        for _ in range(40):
            prints.add(c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))))
        for _ in range(8):
            c ^= sum(1 << b for b in rng.sample(range(64), 4))
            prints.add(c)
    prints = sorted(op4._signed(p) for p in prints)
    nodes = spark.createDataFrame([(p,) for p in prints], "fp long")
    got = {r["fp"]: r["root"] for r in op4.link(nodes).collect()}
    group = {p: p for p in prints}
    for i, a in enumerate(prints):
        for b in prints[:i]:
            if bin((a ^ b) % (1 << 64)).count("1") <= 4 and group[a] != group[b]:
                old, new = max(group[a], group[b]), min(group[a], group[b])
                group = {k: new if g == old else g for k, g in group.items()}
    assert {p: got.get(p, p) for p in prints} == group


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (7, 7)], "a long, b long")
    got = dict(op4.components(edges, "chain").collect())
    assert got == {**{i: 0 for i in range(201)}, 500: 500, 501: 500}


def test_only_large_components_are_broadcast(spark, monkeypatch):
    plans, kept, old = [], op4.stored, spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()

    def stored(df, name):
        plans.append((name, plan(df)))
        return kept(df, name)

    monkeypatch.setattr(op4, "stored", stored)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1g")
    try:
        df = spark.createDataFrame([(i, " ".join(f"w{i // 3 * 7 + k}" for k in range(60)) + " x" * (i % 3)) for i in range(60)],
                                   "doc_id long, text string")
        found = op4.near_duplicates(df)
        plans.append(("result", plan(found)))
        assert found.count() == 60
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert {n for n, p in plans if "BroadcastHashJoin" in p or "BroadcastNestedLoop" in p} <= {"simhash-names"}
