"""SentencePiece scan: against the library, one pass, and chunked giants."""

import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from fraudmart.llm import op9_sentencepiece as op9

PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    with open(PIECES, "rb") as f:
        return op9.Model(f.read())


def ids(raw):
    return np.frombuffer(raw, "<i4").tolist()


def words(rng, n):
    parts = ["the", "onthtion", "Ofanth", "é", "你好", "ｅ", "\n", "x\ty", "  ", "▁", "12", "😀", ".", "aaaaaa"]
    return "".join(rng.choice(parts) + rng.choice([" ", " ", "", "\n"]) for _ in range(n))


def every_path(model, s):
    """All segmentations of a short marked text: (score, ids)."""
    if not s:
        return [(0.0, [])]
    out = []
    for e in range(1, len(s) + 1):
        head = s[-e:]
        if head in model.scores:
            no, score = model.scores[head]
            out += [(x + score, p + [no]) for x, p in every_path(model, s[:-e])]
        elif e == 1:
            raw = [model.byte_ids[x] for x in head.encode()]
            out += [(x + model.unknown, p + raw) for x, p in every_path(model, s[:-1])]
    return out


def test_short_texts_against_all_segmentations(model):
    rng = random.Random(3)
    for _ in range(150):
        s = model.marked(words(rng, 3))[:11]
        paths = every_path(model, s)
        best = max(x for x, _ in paths)
        got = model.segment(s)
        assert (best, got) in paths


def test_parts_segmented_together_equal_one_by_one(model):
    rng = random.Random(5)
    texts = [words(rng, rng.choice([1, 3, 30])) for _ in range(300)] + ["", " ", "a" * 64, "b" * 200, " " * 70, "\ud800"]
    parts = {p for t in texts for p in model.parts.findall(model.marked(t))}
    parts |= {p * 2 for p in parts}
    model.cache.clear()
    model.learn(parts)
    assert {p: ids(raw) for p, raw in model.cache.items()} == {p: model.part(p)[0] for p in parts}


def test_score_of_pieces_follows_the_file(model):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for piece, (no, score) in list(model.scores.items())[::101]:
        assert library.id_to_piece(no) == piece
        assert library.get_score(no) == score
    assert library.decode(ids(model.encode(["a b\n é ｅ"])[0])) == "a b\n é ｅ"


def test_parts_equal_one_pass(model):
    rng = random.Random(4)
    for _ in range(200):
        text = words(rng, rng.randint(0, 30))
        assert ids(model.encode([text])[0]) == model.segment(model.marked(text))


def test_round_trip(model):
    for text in ["", " ", "a", "  a  b ", "\n\n", "é́ ｅ", "long" * 500]:
        assert model.decode(np.frombuffer(model.encode([text])[0], "<i4")) == text


def test_matrices_are_associative_and_exact(model):
    rng = random.Random(5)
    s = model.marked(words(rng, 60))
    size, w = 37, model.longest
    cuts = range(0, len(s), size)
    mats = [model.matrix(s[a:a + size + w - 1], min(size, len(s) - a)) for a in cuts]
    left, right = mats[0], mats[-1]
    for m in mats[1:]:
        left = op9.combine(left, m)
    for m in mats[-2::-1]:
        right = op9.combine(m, right)
    assert left[0, 0] == right[0, 0] == model.forward(s, [0.0], len(s))[0][-1]


@pytest.mark.parametrize("chunk", [16, 61])
def test_giants_equal_one_pass(spark, model, chunk):
    rng = random.Random(chunk)
    texts = [words(rng, 400), "nowhitespace" * 300, "aaaaaaaa" * 200, words(rng, 300), "x" * 997]
    rows = [(i, t, 7) for i, t in enumerate(texts + texts[:1] + ["short one", "", None])]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = {r["doc_id"]: r for r in op9.encode(df, PIECES, giant=100, chunk=chunk).collect()}
    assert len(got) == len(rows)
    for i, t, _ in rows:
        assert ids(got[i]["ids"]) == (model.segment(model.marked(t)) if t else [])
        assert got[i]["n_tokens"] == len(got[i]["ids"]) // 4


def test_query_columns_and_empty(spark):
    df = spark.createDataFrame([(1, "hi there"), (None, None)], "doc_id long, text string")
    rows = op9.round_trip(df, PIECES).collect()
    assert all(r["round_trip"] for r in rows) and {r["doc_id"] for r in rows} == {1, None}
    assert op9.round_trip(df.filter(F.lit(False)), PIECES).count() == 0
