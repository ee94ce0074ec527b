"""Merkle manifests against a plain recursive build, and their proofs."""

import hashlib
import random
import zlib

import duckdb
import pytest

from fraudmart.llm import op11_merkle_manifest as op11
from fraudmart.llm import queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string"


def H(s):
    return hashlib.sha256(s.encode()).hexdigest()


def frame(row):
    return "".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row)


def tree(hashes):
    """Root and, per leaf, its (left, right) siblings from the bottom up."""
    paths, at = [[] for _ in hashes], list(range(len(hashes)))
    while len(hashes) > 1:
        for i, a in enumerate(at):
            run = hashes[a // 8 * 8:a // 8 * 8 + 8]
            paths[i].append(("".join(run[:a % 8]), "".join(run[a % 8 + 1:])))
            at[i] = a // 8
        hashes = [H("".join(hashes[i:i + 8])) for i in range(0, len(hashes), 8)]
    return hashes[0], paths


def slow(rows):
    """rows: (doc_id, text, lang, source, n_chars) -> sorted result rows."""
    groups = {}
    for doc, text, lang, source, n in rows:
        groups.setdefault(lang, []).append((doc, source, lang, n, text))
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    made, out = {}, []
    for g in langs:
        own = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, H(frame(r))))
        made[g] = (own, *tree([H(frame(r)) for r in own]))
    root, over = tree([made[g][1] for g in langs])
    for g, up in zip(langs, over):
        own, sub, paths = made[g]
        for r, path in zip(own, paths):
            path, cur = path + up, r
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None:
                cur = r[:4] + ("".join(c.lower() if "A" <= c <= "Z" else c for c in r[4]),)
            fold = H(frame(cur))
            for left, right in path:
                fold = H(left + fold + right)
            out.append((r[0], H(frame(r)), sub, root, H("".join(a + b for a, b in path)), fold, fold == root))
    return sorted(out, key=str)


def ours(spark, rows, monkeypatch):
    docs = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)
    monkeypatch.setattr(queries, "table", lambda *a: docs)
    return sorted((tuple(r) for r in queries.op11_merkle_manifest(spark, "").collect()), key=str)


def test_against_plain_build(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(i, rng.choice(["Aa É", "", None, "x" * 3000]), rng.choice(["en", "de", None, "é"]),
             rng.choice(["s", None]), rng.choice([1, None])) for i in range(700)]
    rows += [rows[3], rows[3], (None, "No id", "en", "s", 1), (None, "No id", "en", None, 1), (701, "Lone", "zz", "s", 4)]
    assert ours(spark, rows, monkeypatch) == slow(rows)


@pytest.mark.parametrize("size", [0, 1, 7, 8, 9, 65])
def test_sizes_of_one_group(spark, monkeypatch, size):
    rows = [(i, f"T{i}", "en", "s", 1) for i in range(size)]
    assert ours(spark, rows, monkeypatch) == (slow(rows) if size else [])


def test_many_groups_make_a_deep_top(spark, monkeypatch):
    rows = [(i, "T", f"g{i % 70}", "s", 1) for i in range(150)]
    assert ours(spark, rows, monkeypatch) == slow(rows)


def test_tampering_is_seen_and_kept_columns_stay(spark):
    docs = spark.createDataFrame([(i, f"t{i}", "en", "s", 1, "clash") for i in range(20)], SCHEMA)
    got = op11.build(docs, ["doc_id", "text"], "lang", "doc_id", keep=["doc_id", "leaf"]).collect()
    assert got[0].asDict().keys() == {"doc_id", "leaf", "position", "path", "subroot", "root"}
    assert sorted(r["position"] for r in got) == list(range(20))
    for r in got:
        fold, wrong = r["leaf"], H("other")
        for left, right in r["path"]:
            fold, wrong = H(left + fold + right), H(left + wrong + right)
        assert fold == r["root"] != wrong


def test_sql_twin_on_given_rows(spark):
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM read_parquet('/root/testdata/sf0.001/documents.parquet')")
    cols = "doc_id, leaf, subroot, root, proof_sha256, folded_root, verified"
    want = con.execute(f"SELECT {cols} FROM ({queries.ORACLES['op11_merkle_manifest']})").fetchall()
    got = [tuple(r) for r in queries.op11_merkle_manifest(spark, "/root/testdata/sf0.001").collect()]
    assert sorted(got) == sorted(want) and len(got) > 0
    assert {r[-1] for r in got} == {True, False}
