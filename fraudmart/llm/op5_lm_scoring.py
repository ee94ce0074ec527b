"""Cross-entropy difference between a target and a background n-gram model.

Two bigram models of the same form over all words of the corpus: Dirichlet
smoothing towards the unigrams, with the background's counts scaled to the
target's token total so that smoothing weighs alike in both. Counts come from
every document (the target's from every labelled good one) and grow with the
corpus. Each document gets its mean loss per token under both models and the
difference; lower is closer to the target.

Documents are encoded once into stored blocks of about ``BLOCK`` words: a block's
distinct words, and its texts as numbers of them. Each block's distinct words and
bigrams, with their counts, go to hash buckets as packed pieces; a bucket adds up
its blocks' pieces and answers each in its own order; a block takes its answers and
scores its documents. So a bigram moves once a block, however many documents hold
it (no key is hot), and the number of buckets follows from the tokens.

A word or bigram is named by 64 hash bits within its bucket, whose number comes
from 64 other bits: among n distinct bigrams about n^2 / (2^65 buckets) pairs would
be counted as one (10^-6 at 10^7 bigrams, 10^-3 at 10^10).

``size`` names a smaller vocabulary: the ``size - 1`` most frequent words, all
others being one unknown word.

Cases: a null or blank text has no tokens and scores 0; label rows with nulls
name no target, contradicting ones neither; without any target document both
models are equal and every difference is 0; repeated rows count and are scored
one by one; an empty table gives no rows; other input columns are ignored; a
word or bigram that the model never saw has the smoothed loss of a count of 0;
a very long text is a block of its own.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudmart.llm.common import prepare, stored

PRIOR = 16.0  # weight of the unigrams, in tokens
HELD = 400_000  # distinct words a task holds before it passes its counts on
BLOCK = 1 << 20  # words, or a sixteenth as many documents, of a block
BUCKET = 1 << 20  # words of the corpus for each bucket
BATCH_BYTES = "64m"  # of blocks handed to a task's Python at once
MARKS = 64 << 20  # bytes of target ids that are sent to all executors; more are joined by shuffle
# words are in lower case and not empty, so these are none
START, UNKNOWN = b"", b"UNKNOWN"
WORD, PAIR = 0, 1


class Model(NamedTuple):
    """``blocks``: the counted documents, stored; the rest are numbers, or bounded."""

    docs: DataFrame
    columns: tuple[str, str]
    blocks: DataFrame
    totals: tuple[float, float]  # tokens: target, background
    size: int | None  # None: all words and one unknown
    prior: float
    vocab: frozenset[bytes] | None


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").lower().split()


def vocabulary(texts: DataFrame, size: int) -> frozenset[bytes]:
    """The size - 1 most frequent words of all rows of ``texts`` (column t)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def flush():
            keys = list(held)
            for at in range(0, len(keys), 1 << 14):
                part = keys[at:at + (1 << 14)]
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.binary()), pa.array([held[w] for w in part], pa.int64())], ["w", "n"])
            held.clear()

        for batch in batches:
            for t in batch.column(0).to_pylist():
                held.update(words_of(t))
            if len(held) > HELD:
                yield from flush()
        yield from flush()

    top = (texts.select("t").mapInArrow(count, "w binary, n long").groupBy("w").agg(F.sum("n").alias("n"))
           .orderBy(F.desc("n"), "w").limit(size - 1).collect())
    return frozenset(bytes(r["w"]) for r in top)


def known(text: str | None, vocab: frozenset[bytes] | None) -> list[bytes]:
    words = words_of(text)
    return words if vocab is None else [w if w in vocab else UNKNOWN for w in words]


def packed(x: np.ndarray) -> bytes:
    """Unsigned integers as planes of bytes, no more than the largest needs, compressed;
    before them their number and that of the planes."""
    width = max(1, (int(x.max()).bit_length() + 7) // 8) if len(x) else 1
    planes = x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()
    return len(x).to_bytes(8, "little") + bytes([width]) + pa.Codec("zstd", 1).compress(planes, asbytes=True)


def opened(data: bytes) -> np.ndarray:
    n, width = int.from_bytes(data[:8], "little"), data[8]
    out = np.zeros((n, 8), np.uint8)
    planes = pa.Codec("zstd").decompress(data[9:], n * width, asbytes=True)
    out[:, :width] = np.frombuffer(planes, np.uint8).reshape(width, -1).T
    return out.view("<u8").ravel()


def encode(rows: DataFrame, vocab: frozenset[bytes] | None) -> DataFrame:
    """Stored blocks of all rows (id, t, target boolean)."""
    prepare(rows.sparkSession)
    sent = rows.sparkSession.sparkContext.broadcast(vocab)
    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("ids", T.ArrayType(rows.schema["id"].dataType)),
                           *[T.StructField(c, T.BinaryType()) for c in ("target", "lengths", "words", "tokens")],
                           *[T.StructField(c, T.LongType()) for c in ("n", "n_target")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        vocab = sent.value

        def fresh():
            index = defaultdict()
            index.default_factory = index.__len__
            return index, [], [], []

        def block() -> pa.RecordBatch:
            tokens = np.concatenate(texts)
            lengths, target = np.array([len(t) for t in texts]), np.array(marks, np.int64)
            rank = np.argsort(-np.bincount(tokens, minlength=len(index)), kind="stable")
            words = list(index)
            place = np.empty(len(rank), np.int64)
            place[rank] = np.arange(len(rank))
            ids = pa.concat_arrays(held)
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                 *[pa.array([x], pa.binary()) for x in (packed(target), packed(lengths), b"\n".join(words[i] for i in rank),
                                                        packed(place[tokens]))],
                 pa.array([len(tokens)], pa.int64()), pa.array([int(lengths @ target)], pa.int64())], schema.names)

        index, texts, marks, held = fresh()
        size = 0
        for batch in batches:
            for i, t in enumerate(batch.column(1)):
                words = known(t.as_py(), vocab)
                texts.append(np.fromiter(map(index.__getitem__, words), np.int64, len(words)))
                marks.append(batch.column(2)[i].as_py())
                held.append(batch.column(0).slice(i, 1))
                size += len(words)
                if size >= BLOCK or len(texts) >= BLOCK // 16:
                    yield block()
                    number += 1
                    index, texts, marks, held = fresh()
                    size = 0
        if texts:
            yield block()

    return stored(rows.select("id", "t", "target").mapInArrow(run, schema), "lm-blocks")


def mixed(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Hash bits of an ordered pair of hashes."""
    z = x * np.uint64(0x9E3779B97F4A7C15) + (y ^ (y >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    z = (z ^ (z >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return z ^ (z >> np.uint64(29))


class Opened:
    """A block's documents, distinct words (the start of a text is the last) and bigrams."""

    def __init__(self, lengths: bytes, words: bytes, tokens: bytes):
        self.lengths, self.tokens = opened(lengths).astype(np.int64), opened(tokens).astype(np.int64)
        names = [*(words.split(b"\n") if len(self.tokens) else []), START]
        self.n_words = len(names)
        first = (np.cumsum(self.lengths) - self.lengths)[self.lengths > 0]
        self.before = np.roll(self.tokens, 1)
        self.before[first] = self.n_words - 1
        pairs, self.pair_of, self.times = np.unique(self.before * self.n_words + self.tokens, return_inverse=True, return_counts=True)
        self.a, self.b = np.divmod(pairs, self.n_words)
        self._hash = np.frombuffer(b"".join(xxhash.xxh3_128_digest(w) for w in names), "<u8").reshape(-1, 2)

    def pieces(self, kind: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(order, buckets, keys): what is sent, by bucket and key."""
        key, side = self._hash.T
        if kind == PAIR:
            key, side = mixed(key[self.a], key[self.b]), mixed(side[self.a], side[self.b])
        bucket = (side % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((key, bucket))
        return order, bucket[order], key[order]

    def counts(self, kind: int, target: np.ndarray) -> list[np.ndarray]:
        """n, n_target (of words: as word, then as context)."""
        hit = np.repeat(target, self.lengths)
        if kind == PAIR:
            return [self.times, np.bincount(self.pair_of, hit, len(self.a))]
        return [np.bincount(x, w, self.n_words) for x in (self.tokens, self.before) for w in (None, hit)]


_PIECE = "block long, kind int, bucket long, asked boolean, keys binary, counts array<binary>"
_ANSWER = "block long, kind int, bucket long, counts array<binary>, distinct long"


def _send(buckets: int, counted: bool, asked: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                own = Opened(r["lengths"], r["words"], r["tokens"])
                for kind in (WORD, PAIR):
                    order, bucket, keys = own.pieces(kind, buckets)
                    counts = [c[order].astype(np.int64) for c in own.counts(kind, opened(r["target"]).astype(np.int64))] if counted else []
                    cuts = np.flatnonzero(np.diff(bucket, prepend=-1)).tolist()
                    out = [{"block": r["block"], "kind": kind, "bucket": int(bucket[s]), "asked": asked,
                            "keys": packed(np.diff(keys[s:e], prepend=np.uint64(0))), "counts": [packed(c[s:e]) for c in counts]}
                           for s, e in zip(cuts, [*cuts[1:], len(bucket)])]
                    for at in range(0, len(out), 1 << 10):
                        yield pa.RecordBatch.from_pylist(out[at:at + (1 << 10)], schema=_ARROW_PIECE)
    return run


_ARROW_PIECE = pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("bucket", pa.int64()), ("asked", pa.bool_()),
                          ("keys", pa.binary()), ("counts", pa.list_(pa.binary()))])
_ARROW_ANSWER = pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("bucket", pa.int64()), ("counts", pa.list_(pa.binary())),
                           ("distinct", pa.int64())])


def _add_up(pieces: pa.Table) -> pa.Table:
    """All pieces of a bucket: the totals of each asked piece's keys, and a row of no
    block with the number of distinct counted keys."""
    kind, bucket = pieces.column("kind")[0].as_py(), pieces.column("bucket")[0].as_py()
    keys = [np.cumsum(opened(k.as_py())) for k in pieces.column("keys")]
    at = np.concatenate([[0], np.cumsum([len(k) for k in keys])])
    distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
    totals = [np.zeros(len(distinct)) for _ in range(2 if kind == PAIR else 4)]
    for i, counts in enumerate(pieces.column("counts")):
        for total, c in zip(totals, counts.as_py()):  # a piece's keys are distinct but for equal hashes
            np.add.at(total, place[at[i]:at[i + 1]], opened(c))
    out = [{"block": None, "kind": kind, "bucket": bucket, "counts": None, "distinct": int((totals[0] > 0).sum())}]
    for i, (block, asked) in enumerate(zip(pieces.column("block").to_pylist(), pieces.column("asked").to_pylist())):
        if asked:
            out.append({"block": block, "kind": kind, "bucket": bucket, "distinct": None,
                        "counts": [packed(t[place[at[i]:at[i + 1]]].astype(np.int64)) for t in totals]})
    return pa.Table.from_pylist(out, schema=_ARROW_ANSWER)


def _scored(totals: tuple[float, float], size: int, prior: float, buckets: int, names: list[str]):
    scale = totals[0] / max(1.0, totals[1])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        """left: a block, right: its answers."""
        r = left.select(["lengths", "words", "tokens"]).to_pylist()[0]
        own = Opened(r["lengths"], r["words"], r["tokens"])
        answers = right.sort_by("bucket")
        got = {}
        for kind in (WORD, PAIR):
            parts = [c for k, c in zip(answers.column("kind").to_pylist(), answers.column("counts").to_pylist()) if k == kind]
            order = own.pieces(kind, buckets)[0]
            for no, x in enumerate(zip(*parts)):
                got[kind, no] = np.empty(len(order))
                got[kind, no][order] = np.concatenate([opened(p) for p in x])
        n = len(own.lengths)
        doc = np.repeat(np.arange(n), own.lengths)
        loss = []
        for side, x in ((1, 1.0), (0, scale)):
            bits = np.zeros(0)
            if len(doc):
                one = (got[WORD, side] * x + 0.5) / (totals[0] + 0.5 * size) * prior
                bits = np.log2(got[WORD, 2 + side][own.a] * x + prior) - np.log2(got[PAIR, side] * x + one[own.b])
            loss.append(np.bincount(doc, bits[own.pair_of], n) / np.maximum(own.lengths, 1))
        return pa.Table.from_arrays([left.column("ids").combine_chunks().flatten(), pa.array(own.lengths, pa.int64()),
                                     *[pa.array(x, pa.float64()) for x in (*loss, loss[0] - loss[1])]], names)
    return run


def _texts(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("t"))


def fit(docs: DataFrame, targets: DataFrame, id_col: str = "doc_id", text: str = "text",
        size: int | None = None, prior: float = PRIOR) -> Model:
    """Both models from the counts of ``docs``; ``targets``: distinct ids (id)."""
    prepare(docs.sparkSession)
    texts = _texts(docs, id_col, text)
    vocab = vocabulary(texts, size) if size else None
    marks = stored(targets.select("id", F.lit(True).alias("hit")), "lm-targets")
    held = marks.agg(F.sum(F.octet_length(F.col("id").cast("string")) + 16)).first()[0] or 0
    marked = texts.join(F.broadcast(marks) if held <= MARKS else marks, "id", "left")
    blocks = encode(marked.select("id", "t", F.coalesce("hit", F.lit(False)).alias("target")), vocab)
    every, hit = blocks.agg(F.sum("n"), F.sum("n_target")).first()
    return Model(docs, (id_col, text), blocks, (float(hit or 0), float(every or 0)), size, prior, vocab)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text", size: int | None = None) -> DataFrame:
    """(id, n_tokens, loss_target, loss_background, ce_diff) of every row."""
    spark = docs.sparkSession
    prepare(spark)
    if size not in (None, model.size):
        raise ValueError(f"the model's vocabulary has {model.size} words, not {size}")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    same = docs is model.docs and (id_col, text) == model.columns
    asked = model.blocks if same else encode(_texts(docs, id_col, text).withColumn("target", F.lit(False)), model.vocab)
    tokens = model.totals[1] + (0 if same else asked.agg(F.sum("n")).first()[0] or 0)
    buckets = int(tokens // BUCKET) + 1
    packs = ["block", "target", "lengths", "words", "tokens"]
    pieces = model.blocks.select(*packs).mapInArrow(_send(buckets, True, same), _PIECE)
    if not same:
        pieces = pieces.unionByName(asked.select(*packs).mapInArrow(_send(buckets, False, True), _PIECE))
    answers = stored(pieces.groupBy("kind", "bucket").applyInArrow(_add_up, _ANSWER), "lm-answers")
    distinct = answers.filter((F.col("kind") == WORD) & F.col("block").isNull()).agg(F.sum("distinct")).first()[0]
    schema = T.StructType([T.StructField("id", asked.schema["ids"].dataType.elementType), T.StructField("n_tokens", T.LongType()),
                           *[T.StructField(c, T.DoubleType()) for c in ("loss_target", "loss_background", "ce_diff")]])
    run = _scored(model.totals, model.size or (distinct or 0) + 1, model.prior, buckets, schema.names)
    return (asked.select("block", "ids", "lengths", "words", "tokens").groupBy("block")
            .cogroup(answers.filter("block is not null").select(F.col("block").alias("of"), "kind", "bucket", "counts").groupBy("of"))
            .applyInArrow(run, schema))


def good_ids(labels: DataFrame) -> DataFrame:
    """Ids labelled good and not toxic in every row."""
    return (labels.groupBy(F.col("doc_id").alias("id"))
            .agg(F.min(F.coalesce("quality", F.lit(0))).alias("q"), F.max(F.coalesce("toxic", F.lit(1))).alias("x"))
            .filter("id is not null and q = 1 and x = 0").select("id"))
