"""Token alignment against a plain walk over both libraries' tokens."""

import collections
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from fraudmart.llm import op12_token_alignment as op12

PATHS = (public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PATHS[1])


def spans(ids, pieces):
    at, out = 0, []
    for i in ids:
        out.append((at, at + len(pieces[i])))
        at += len(pieces[i])
    return out


def plain(texts, libraries):
    """Per text: counts, group text, links as (a, b) pairs; then the scores."""
    a, b = libraries
    letters = op12._byte_of_letter()
    pa = {i: bytes(letters[c] for c in t) if i < 50256 else b"" for t, i in a.get_vocab().items()}
    pb = {i: bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
          for i in range(b.get_piece_size())}
    got = []
    for t in texts:
        ia = a.encode(" " + t, add_special_tokens=False).ids if t else []
        ib = b.encode(t) if t else []
        raw = b" " + (t or "").encode()
        if not t or b"".join(pa[i] for i in ia) != raw or b"".join(pb[i] for i in ib) != raw:
            got.append((0, 0, 0, "", []))
            continue
        sa, sb = spans(ia, pa), spans(ib, pb)
        ends = sorted({y for _, y in sa} & {y for _, y in sb})
        said, start = [], 0
        for e in ends:
            said.append(",".join(str(i) for i, s in zip(ia, sa) if start <= s[0] < e) + "|"
                        + ",".join(str(i) for i, s in zip(ib, sb) if start <= s[0] < e))
            start = e
        links = [(x, y) for x, s in zip(ia, sa) for y, r in zip(ib, sb) if s[0] < r[1] and r[0] < s[1]]
        got.append((len(ia), len(ib), len(ends), ";".join(said), links))
    held = collections.Counter(p for *_, links in got for p in set(links))
    best = {}
    for (x, _), n in held.items():
        best[x] = max(n, best.get(x, 0))
    return [(na, nb, ng, len(links), sum(held[p] == best[p[0]] for p in links), sum(held[p] for p in links), said,
             hashlib.sha256(said.encode()).hexdigest() if said else "") for na, nb, ng, said, links in got]


def ours(spark, texts, **more):
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, n_a string")
    rows = op12.align(docs, PATHS, texts=True, **more)
    got = op12.score(rows, op12.piece_model(PATHS[1]).size).collect()
    assert set(got[0].asDict()) == {"doc_id", *op12.COUNTS, "n_best", "count_sum", "groups", "groups_sha256"} if got else True
    return [(r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups, r.groups_sha256)
            for r in sorted(got, key=lambda r: r.doc_id)]


def some_texts(n=40, seed=3):
    rng = random.Random(seed)
    bits = ["the", " and", "  ", "\n\n", "é", "ü", "ﬀ", "日本", "🙂", "idiot's", "<|endoftext|>", "<s>", "<0x41>", "\t", "12345", "!!", "x",
            "​", "é", "\x00", "naïve", "ſ", "\r\n", "don't", "'LL"]
    return ["".join(rng.choice(bits) for _ in range(rng.randint(1, 40))) for _ in range(n)]


def test_against_plain_walk(spark, libraries):
    texts = [None, "", " ", "a", "The cat.", "The cat.", "U+2581: ▁ here", *some_texts()]
    assert ours(spark, texts) == plain(texts, libraries)
    assert plain(["U+2581: ▁ here"], libraries)[0][0] == 0


@pytest.mark.parametrize("piece", [1, 2, 7, 64])
def test_long_texts_in_pieces(spark, libraries, piece):
    texts = ["short", *some_texts(8, piece), "▁ not spelled " * 5, None, "ab " * 60]
    assert ours(spark, texts, long=20, piece=piece) == plain(texts, libraries)


def test_blocks_with_full_dictionaries(spark, libraries, monkeypatch):
    texts = some_texts(30, 9)
    a, b = op12.byte_level(PATHS[0]), op12.piece_model(PATHS[1])
    whole = op12.Aligned(texts, a, b, piece=5)
    one = [op12.Aligned([t], a, b) for t in texts]
    assert whole.groups == [x.groups[0] for x in one]
    assert (whole.counts == np.concatenate([x.counts for x in one])).all()
    assert whole.key.tolist() == [k for x in one for k in x.key.tolist()]
    block = op12.Block(0)
    for x in one:
        block.add(x.key, np.ones(len(x.key), int))
    held = collections.Counter(k for x in one for k in x.key.tolist())
    assert {int(k): int(n) for k, n in zip(block.key, block.holders[block.code])} == held


@pytest.mark.parametrize("piece", [1, 3, 10])
def test_diagonals(piece):
    rng = np.random.default_rng(piece)
    for _ in range(50):
        a, b = (np.unique(rng.integers(1, 60, rng.integers(0, 40))) for _ in range(2))
        i, j = op12.cuts_of(a, b, piece)
        order = sorted([(x, 0) for x in a] + [(y, 1) for y in b])
        for p, q in zip(i, j):
            assert p == sum(s == 0 for _, s in order[:p + q]) and q == sum(s == 1 for _, s in order[:p + q])
        assert (np.diff(i + j) <= piece).all() and (i[-1], j[-1]) == (len(a), len(b))


def test_ids_are_the_library_s(libraries):
    rng = random.Random(8)
    vocab = list(libraries[0].get_vocab())
    letters = op12._byte_of_letter()
    texts = ["".join(bytes(letters[c] for c in rng.choice(vocab)).decode("utf-8", "ignore") for _ in range(20)) for _ in range(300)]
    texts += [chr(rng.choice([rng.randrange(1, 0xD800), rng.randrange(0xE000, 0x110000)])) + "x" for _ in range(2000)]
    got = op12.byte_level(PATHS[0]).encode(texts)
    want = libraries[0].encode_batch([" " + t for t in texts], add_special_tokens=False)
    assert all(g.tolist() == w.ids for g, w in zip(got, want))


def test_empty_table_and_other_files(spark):
    assert ours(spark, []) == []
    with pytest.raises(ValueError):
        op12.byte_level(public_tokenizers.path("word_bpe_49k.json"))
