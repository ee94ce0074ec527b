"""The toxicity network: gradients, windows, pieces and held-out accuracy."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from fraudmart.llm import op13_toxicity as op13
from fraudmart.llm import queries


def test_gradients_match_differences():
    net = op13.Network([b"aa", b"bb", b"cc"], dtype=np.float64)
    pool = op13.Pool()
    rng = random.Random(1)
    for i in range(3):
        pool.add(i, [rng.choice([b"aa", b"bb", b"cc", b"dddd", b"e"]) for _ in range([5, 40, 0][i])])
    words, at, mask, of = pool.taken()
    mask = mask.astype(float)
    weight = np.linspace(0.5, 1.5, len(of))

    def loss():
        return float((weight * net.logits(net.gates(net.inputs(words)[0]), at, mask)).sum())

    g, _ = net.gradients(words, at, mask, lambda z: weight)
    assert set(g) == set(net.p)
    pick = np.random.default_rng(2)
    for name, value in net.p.items():
        flat, grad = value.reshape(-1), g[name].reshape(-1)
        places = np.unique(np.append(np.argsort(-np.abs(grad))[:3], pick.integers(0, flat.size, 3)))
        for k in places:
            old, step = flat[k], 1e-5
            flat[k] = old + step
            up = loss()
            flat[k] = old - step
            down = loss()
            flat[k] = old
            assert grad[k] == pytest.approx((up - down) / (2 * step), rel=1e-4, abs=1e-7), name


def test_training_stays_narrow():
    net = op13.Network([b"vile"]).fit([[b"vile"], [b"good"]] * 20, np.array([1, 0] * 20), steps=3)
    assert {v.dtype for v in net.p.values()} == {np.dtype(np.float32)}


def test_windows_cover_all_words():
    for n in (0, 1, 31, 32, 33, 48, 49, 200):
        starts = op13.window_starts(n)
        seen = {w for s in starts for w in range(s, min(n, s + op13.WIDTH))}
        assert seen == set(range(n)) and (np.diff(starts) == op13.STRIDE).all()
        pool = op13.Pool()
        pool.add(4, [b"%d" % k for k in range(n)])
        words, at, mask, of = pool.taken()
        assert of.tolist() == [4] * len(starts)
        for k, s in enumerate(starts):
            got = [words[a] for a, m in zip(at[:, k], mask[:, k]) if m]
            assert got == [b"%d" % w for w in range(s, min(n, s + op13.WIDTH))]


def test_pieces_and_pools_change_nothing(monkeypatch):
    rng = random.Random(2)
    texts = [" ".join("w%d" % rng.randrange(300) for _ in range(n)) for n in (0, 5, 33, 900, 64, 31)] + [None, "", "...", "x" * 5000]
    net = op13.Network([b"w1", b"w2"])
    whole = net.scores(texts)
    assert ((whole > 0) & (whole < 1)).all()
    monkeypatch.setattr(op13, "PIECE", 50)
    monkeypatch.setattr(op13, "POOL", 40)
    monkeypatch.setattr(op13, "WINDOWS", 3)
    assert net.scores(texts) == pytest.approx(whole, abs=1e-5)
    assert net.scores([texts[3]])[0] == pytest.approx(whole[3], abs=1e-5)
    assert whole[6] == whole[7] == pytest.approx(whole[0]) == pytest.approx(whole[8])
    assert "".join(op13.pieces("ab cd ef", 3)) == "ab cd ef"


def test_learns_marked_words_in_long_texts(spark):
    rng = random.Random(4)
    plain = ["".join(rng.choice(["ra", "to", "mi", "ke", "su"]) for _ in range(3)) for _ in range(300)]

    def text(bad, n):
        words = [rng.choice(plain) for _ in range(n)]
        for _ in range(rng.randint(2, 4) if bad else 0):
            words[rng.randrange(n)] = rng.choice(["zzug" + rng.choice(plain), "vile"])
        return " ".join(words)

    rows = [(i, text(i % 4 == 0, rng.randint(20, 300)), int(i % 4 == 0)) for i in range(600)]
    docs = spark.createDataFrame([(i, t, "clash") for i, t, _ in rows], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i < 400] + [(None, 1), (1, 1), (5, None)], "doc_id long, label int")
    got = {r.doc_id: r for r in op13.score(docs, op13.fit(docs, labels)).collect()}
    assert len(got) == 600 and set(got[0].asDict()) == {"doc_id", "text", "score", "predicted"}
    wrong = sum(got[i].predicted != y for i, _, y in rows if i >= 400)
    assert wrong <= 10


def test_cases_without_labels(spark):
    docs = spark.createDataFrame([(1, "a"), (1, "a"), (None, None), (2, "")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, label int")
    assert {r.score for r in op13.score(docs, op13.fit(docs, none)).collect()} == {0.5}
    one = spark.createDataFrame([(1, 0)], "doc_id long, label int")
    assert {(r.score, r.predicted) for r in op13.score(docs, op13.fit(docs, one)).collect()} == {(0.0, 0)}
    assert op13.score(docs.limit(0), op13.fit(docs, none)).collect() == []


def test_query_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    got = queries.op13_toxicity(spark, folder)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = got.join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
               and r.predicted == (r.score >= 0.3) for r in rows)
    far = [r for r in rows if r.held_out]
    assert np.mean([r.predicted for r in far if r.toxic == 1]) >= 0.6
    assert np.mean([r.predicted for r in far if r.toxic == 0]) <= 0.06
    assert got.count() == spark.read.parquet(f"{folder}/documents.parquet").select(F.count("*")).first()[0]
