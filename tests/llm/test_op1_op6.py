"""WARC and token files: brute force and exact round trips."""

import hashlib
import io
import random
import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fraudmart.llm import op1_warc as op1
from fraudmart.llm import op6_token_binary as op6
from fraudmart.session import scratch_path

WORDS = public_tokenizers.path("word_bpe_49k.json")


def test_warc_round_trip(spark):
    long, short = "é" * 700, "x" * 999
    rows = [(1, "http://a/\r\nX: y", long, 9), (5, None, long, 9), (3, "http://b", long, 9), (5, "http://c", long, 9),
            (None, "u", long, 9), (7, "http://d", short, 9), (8, "http://e", short, 9), (9, "http://f", None, 9),
            (10, "http://g", "", 9), (11, "h", "abc\r\n\r\n" * 60_000, 9)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, refers_to int")
    manifest = op1.write_archives(df, scratch_path(spark, "warc-test"))
    got = sorted(((r["record_id"], r["record_type"], r["refers_to"], r["payload_bytes"], r["payload_digest"], r["status"])
                  for r in op1.read_archives(manifest).collect()), key=str)
    want = []
    for key, _, html, _ in rows:
        body = (html or "").encode()
        revisit = len(body) >= 1000 and html == long and key != 5
        want.append((op1._urn(key), "revisit" if revisit else "response", op1._urn(5) if revisit else None,
                     len(body), hashlib.sha1(body).hexdigest(), "ok"))
    assert got == sorted(want, key=str)
    payloads = {r["record_id"]: r["payload"] for r in op1.read_archives(manifest, with_payload=True).collect()
                if r["record_type"] == "response"}
    assert payloads[op1._urn(11)] == rows[-1][2].encode()
    empty = op1.write_archives(df.filter(F.lit(False)), scratch_path(spark, "warc-none"))
    assert op1.read_archives(empty).count() == 0


def test_damaged_archives_are_told():
    good = [op1.member(op1.record_bytes(i, "u", b"p" * 2000, None, "d")) for i in range(3)]
    read = lambda data: [r["status"] for r in op1.records(io.BytesIO(data), "a")]
    assert read(b"".join(good)) == ["ok"] * 3
    assert read(b"".join(good)[:-9]) == ["ok", "ok", "truncated"]
    raw = op1.record_bytes(1, "u", b"p" * 2000, None, "d")
    assert read(op1.member(raw.replace(b"pppp", b"pqpp", 1)) + good[1]) == ["bad_digest", "ok"]
    assert read(op1.member(raw[:-5]) + good[1]) == ["bad_length", "ok"]
    assert read(good[0] + b"not a gzip member") == ["ok", "corrupt"]


def test_encoder_equals_the_library():
    encode, dtype = op6.encoder(WORDS)
    library, rng = Tokenizer.from_file(WORDS), random.Random(1)
    letters = "aB's 1\t\n ́ẞΣΣéIİ\x1c\x85　你😀<|endoftext|>.,!_-'re"
    for i in range(3000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) + rng.choice(["", "<|endoftext|> X.", "a.", "A,"])
        assert np.frombuffer(encode([text])[0], dtype).tolist() == library.encode(text, add_special_tokens=False).ids


def test_token_files_round_trip(spark):
    texts = ["Hello, world. it's", None, "", " \n", "The the THE.", "word " * 3000, "Hello, world. it's"]
    rows = [(i * 7 % 5 if i < 5 else i, t, 3) for i, t in enumerate(texts)] + [(None, "no id", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, start int")
    library = Tokenizer.from_file(WORDS)
    got = sorted((r.asDict() for r in op6.read_shards(op6.write_shards(
        df, scratch_path(spark, "tokens-test"), WORDS, 2, shards=3), with_ids=True).collect()), key=lambda r: r["start"])
    assert [r["id"] for r in got] == sorted((r[0] for r in rows), key=lambda k: (k is not None, k))
    by_id, start = {k: t for k, t, _ in rows}, 0
    for r in got:
        ids = library.encode(by_id[r["id"]] or "", add_special_tokens=False).ids + [2]
        assert r["ids"] == ids and r["n_tokens"] == len(ids) and r["start"] == start
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    assert op6.round_trip(df.filter(F.lit(False)), WORDS, 2).count() == 0


def test_capitals_composed_in_lower_case_only():
    texts = [c + mark + rest for c in "HTJWYA" for mark in "\u0331\u0308\u030c\u030a" for rest in ("", "aram.", "ARAM, x")]
    texts += ["Plain H\u0331aram AND T\u0308o, J\u030cO."]
    encode, dtype = op6.encoder(WORDS)
    library = Tokenizer.from_file(WORDS)
    got = [np.frombuffer(x, dtype).tolist() for x in encode(texts)]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert got[texts.index("H\u0331aram.")][:4] == [327, 136, 365, 21473]


def test_words_of_letters_and_other_files(spark):
    rng = random.Random(12)
    bits = ["Straße", "İstanbul", "H̱aram", "ﬀ", "don't", "x.", "日本語", "ab1c", "É", "é", "ǅ", "ΣΑΣ", "<|endoftext|>", "a,b", "naïve."]
    texts = [" ".join(rng.choice(bits + ["".join(rng.choice("abcdéüñ") for _ in range(5))]) for _ in range(rng.randint(0, 3000)))
             for _ in range(12)] + [None, ""]
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):  # words apart, and whole texts
        path = public_tokenizers.path(name)
        encode, dtype = op6.encoder(path)
        library = Tokenizer.from_file(path)
        got = [np.frombuffer(x, dtype).tolist() for x in encode(texts)]
        assert got == [library.encode(t or "", add_special_tokens=False).ids for t in texts]
