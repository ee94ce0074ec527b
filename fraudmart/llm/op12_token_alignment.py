"""Alignment of two tokenizers' tokens over the same bytes, by merge paths.

Both tokenizers encode space+text; their tokens' byte ends are two ascending lists.
Merging them is cut into pieces of equal work: a binary search on each diagonal of
the merge matrix finds how many ends of either list come before it, so the pieces
are independent. A piece emits the overlaps of its ends (each distinct end of the
merged lists is one A-B pair) and the common ends, which cut the texts into groups;
groups that run over a piece's edge are stitched. Texts of a batch are merged as one
list, for their own ends are common; a text above LONG bytes is cut into rows of
PIECE ends that Spark deals out over tasks, and stitched by document.

An id pair counts the documents that hold it linked. Documents are written in blocks
with a dictionary of the block's pairs and numbers into it, so what is shuffled for
the counts is each block's distinct pairs, not each document's; a block takes its
pairs' counts back (cogroup) and sums them over its documents' links.

Cases: a text that is null or empty, or whose joined A or B token bytes differ from
space+text, has no tokens: zeros and an empty group text; repeated rows are documents
of their own; an empty table gives no rows; input columns named like the result are
replaced. A whole text must fit in the memory of the task that encodes it (one string
in either library); its merging and its groups are spread.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from fraudmart.llm.common import prepare, stored

LONG = 1 << 16  # bytes of text above which a document's pieces are spread over tasks
PIECE = 1 << 16  # merged ends of one piece
CHUNK = 1 << 20  # bytes of text merged at once
CODES = 1 << 16  # pairs of a block's dictionary (only one chunk may have more)
BLOCK = 1 << 24  # bytes of links of a block, and one chunk more
COUNTS = ("n_a", "n_b", "n_groups", "n_links")

#: The splitting pattern of byte-level BPE (a fixed value of that format).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


# ---------------------------------------------------------------- tokenizers
class Codec:
    """An encoder of whole texts and the bytes of each of its ids."""

    def __init__(self, encode, pieces: list[bytes]):
        self.encode, self.size = encode, len(pieces)
        self.length = np.array([len(p) for p in pieces], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.flat = np.frombuffer(b"".join(pieces), np.uint8)

    def spelled(self, ids: np.ndarray) -> np.ndarray:
        """The joined bytes of ids."""
        n = self.length[ids]
        ends = np.cumsum(n)
        return self.flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.start[ids] - ends + n, n)]


def _byte_of_letter() -> dict[str, int]:
    """Byte-level alphabet: printable bytes stand for themselves, the others for the
    characters from 256 on, in order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(rest)}}


@lru_cache(2)
def byte_level(path: str) -> Codec:
    """A byte-level BPE file, for texts with a space before them. Where ids rise in the
    order of the merges, the rank encoder gives the same ids and is four times as
    fast; else the library of the file itself encodes."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, split = spec["model"], spec.get("pre_tokenizer") or {}
    if model["type"] != "BPE" or spec.get("normalizer") or split.get("type") != "ByteLevel" or split.get("add_prefix_space"):
        raise ValueError(f"{path} is no byte-level BPE without normalizer and prefix space")
    letters = _byte_of_letter()
    spell = lambda token: bytes(letters[c] for c in token)
    pieces = [b""] * (1 + max([*model["vocab"].values(), *(t["id"] for t in spec["added_tokens"])]))
    for token, i in model["vocab"].items():
        pieces[i] = spell(token)
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    rise = [model["vocab"][a + b] for a, b in pairs]
    plain = split.get("use_regex", True) and not model.get("ignore_merges") and not model.get("dropout")
    if plain and rise == sorted(set(rise)) and len(rise) + 256 == len(model["vocab"]):
        ranks = {spell(token): i for token, i in model["vocab"].items()}
        quick = tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        return Codec(lambda texts: [quick.encode_to_numpy(" " + t, disallowed_special=()).astype(np.int64) for t in texts], pieces)
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    return Codec(lambda texts: [np.array(e.ids, np.int64) for e in library.encode_batch(
        [" " + t for t in texts], add_special_tokens=False)], pieces)


@lru_cache(2)
def piece_model(path: str) -> Codec:
    """A piece model; it adds the space itself. Pieces hold U+2581 for a space, or
    one byte as <0xHH>."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [bytes([int(model.id_to_piece(i)[3:-1], 16)]) if model.is_byte(i)
              else model.id_to_piece(i).replace("▁", " ").encode() for i in range(model.get_piece_size())]
    return Codec(lambda texts: [np.array(x, np.int64) for x in model.encode(texts, num_threads=1)], pieces)


# ---------------------------------------------------------------- merge path
def cuts_of(a: np.ndarray, b: np.ndarray, piece: int) -> tuple[np.ndarray, np.ndarray]:
    """How many ends of ``a`` and of ``b`` lie before each diagonal ``0, piece, ...,
    len(a) + len(b)``; of equal ends that of ``a`` comes first."""
    total = len(a) + len(b)
    d = np.append(np.arange(0, total, piece), total)
    low, high = np.maximum(0, d - len(b)), np.minimum(d, len(a))
    while (open_ := low < high).any():
        mid = (low + high) // 2
        # the end a[mid] is before the diagonal if it goes before b[d - mid - 1]
        before = np.zeros(len(d), bool)
        before[open_] = a[mid[open_]] <= b[d[open_] - mid[open_] - 1]
        low, high = np.where(open_ & before, mid + 1, low), np.where(open_ & ~before, mid, high)
    return low, d - low


def overlaps(a: np.ndarray, b: np.ndarray, last: int = 0) -> tuple[np.ndarray, ...]:
    """One piece of the merge: ends of either list and the last end of A before it.
    Returns the overlapping tokens (places in ``a`` and ``b``; len(a) or len(b) is the
    first token after the piece) and the places after each common end."""
    at_b, at_a = np.searchsorted(b, a), np.searchsorted(a, b)
    same = np.append(a, -1)[at_a] == b  # an end of A here, which has the pair already
    if len(b):
        edge = b[0] == last
        same[0] |= edge
    own = np.flatnonzero(~same)
    cut_b = np.flatnonzero(same)
    cut_a = at_a[cut_b] + 1
    if len(b) and edge:
        cut_a[0] = 0
    return np.concatenate([np.arange(len(a)), at_a[own]]), np.concatenate([at_b, own]), cut_a, cut_b + 1


class Names:
    """Decimal ids with the mark that follows them, as one table."""

    def __init__(self, a: int, b: int):
        self.b = 2 * a
        self.table = np.array([b"%d%c" % (i, c) for size, end in ((a, 124), (b, 59)) for i in range(size) for c in (44, end)], object)

    def order(self, a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> np.ndarray:
        """Codes of whole groups' ids, in the order of the text: A's of a group, then B's."""
        if not len(cut_a):
            return np.zeros(0, np.int64)
        end_a, end_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        end_a[cut_a - 1] = end_b[cut_b - 1] = 1
        out = np.empty(len(a) + len(b), np.int64)
        out[np.arange(len(a)) + np.repeat(np.append(0, cut_b[:-1]), np.diff(cut_a, prepend=0))] = 2 * a + end_a
        out[np.arange(len(b)) + np.repeat(cut_a, np.diff(cut_b, prepend=0))] = self.b + 2 * b + end_b
        return out

    def text(self, codes: np.ndarray) -> bytes:
        """Groups joined by ';', one after each, also the last."""
        return b"".join(self.table[codes].tolist())


@lru_cache(2)
def names(a: int, b: int) -> Names:
    return Names(a, b)


class Aligned:
    """Texts of one chunk: counts, group texts (bytes, '' without tokens) and the
    distinct pairs of each text with their links."""

    def __init__(self, texts: list[str | None], a: Codec, b: Codec, piece: int = PIECE):
        n = len(texts)
        self.counts, self.groups = np.zeros((n, 4), np.int64), [b""] * n
        some = [i for i, t in enumerate(texts) if t]
        ids_a, ids_b = a.encode([texts[i] for i in some]), b.encode([texts[i] for i in some])
        keep = [k for k, i in enumerate(some) if _spells(a, ids_a[k], texts[i]) and _spells(b, ids_b[k], texts[i])]
        rows = np.array([some[k] for k in keep], np.int64)
        ids_a, ids_b = [ids_a[k] for k in keep], [ids_b[k] for k in keep]
        n_a, n_b = np.array([len(x) for x in ids_a], np.int64), np.array([len(x) for x in ids_b], np.int64)
        self.key = self.times = self.doc = np.zeros(0, np.int64)
        if not keep:
            return
        all_a, all_b = np.concatenate(ids_a), np.concatenate(ids_b)
        ends_a, ends_b = np.cumsum(a.length[all_a]), np.cumsum(b.length[all_b])
        i, j = cuts_of(ends_a, ends_b, piece)
        found = [overlaps(ends_a[p:q], ends_b[r:s], ends_a[p - 1] if p else 0) for p, q, r, s in zip(i, i[1:], j, j[1:])]
        link_a, link_b, cut_a, cut_b = (np.concatenate([x[c] + at for x, at in zip(found, off)])
                                        for c, off in enumerate((i, j, i, j)))
        doc_a = np.repeat(np.arange(len(keep)), n_a)
        n_groups = np.bincount(doc_a[cut_a - 1], minlength=len(keep))
        key, self.times = np.unique((doc_a[link_a] * a.size + all_a[link_a]) * b.size + all_b[link_b], return_counts=True)
        self.doc, self.key = rows[key // (a.size * b.size)], key % (a.size * b.size)
        self.counts[rows] = np.stack([n_a, n_b, n_groups, n_a + n_b - n_groups], 1)
        say = names(a.size, b.size)
        codes, at = say.order(all_a, all_b, cut_a, cut_b), 0
        for row, size in zip(rows.tolist(), (n_a + n_b).tolist()):
            self.groups[row] = say.text(codes[at:at + size])[:-1]
            at += size


def _spells(codec: Codec, ids: np.ndarray, text: str) -> bool:
    raw = b" " + text.encode("utf-8", "surrogatepass")
    return int(codec.length[ids].sum()) == len(raw) and bool((codec.spelled(ids) == np.frombuffer(raw, np.uint8)).all())


# ---------------------------------------------------------------- rows
class Block:
    """A growing dictionary of pairs with the documents that hold them."""

    def __init__(self, number: int):
        self.number, self.bytes = number, 0
        self.key, self.code, self.holders = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def fresh(self, keys: np.ndarray) -> np.ndarray:
        return np.setdiff1d(keys, self.key, assume_unique=True)

    def add(self, keys: np.ndarray, holders: np.ndarray) -> None:
        """Distinct ascending keys of a chunk and how many of its documents hold each."""
        new = self.fresh(keys)
        code = np.append(self.code, len(self.code) + np.arange(len(new)))
        key = np.append(self.key, new)
        order = np.argsort(key, kind="stable")
        self.key, self.code = key[order], code[order]
        self.holders = np.append(self.holders, np.zeros(len(new), np.int64))
        self.holders[self.codes(keys)] += holders

    def codes(self, keys: np.ndarray) -> np.ndarray:
        return self.code[np.searchsorted(self.key, keys)]

    def row(self, doc: pa.DataType) -> pa.RecordBatch:
        schema, key = _schema(doc), self.key[np.argsort(self.code)]
        made = {"block": pa.array([self.number]), "pairs": pa.array([key], pa.list_(pa.int64())),
                "holders": pa.array([self.holders], pa.list_(pa.int64()))}
        return pa.RecordBatch.from_arrays([made[f.name] if f.name in made else pa.nulls(1, f.type) for f in schema], schema=schema)


def _schema(doc: pa.DataType) -> pa.Schema:
    """Arrow form of ``_rows_type`` for the kept columns as they came."""
    long = pa.int64()
    return pa.schema([("block", long), ("doc", doc), *[(c, long) for c in COUNTS], ("groups", pa.string()),
                      ("groups_sha256", pa.string()), ("at", pa.binary()), ("times", pa.binary()),
                      ("pairs", pa.list_(long)), ("holders", pa.list_(long))])


def _rows_type(doc: T.StructType) -> T.StructType:
    long = T.LongType()
    return T.StructType([T.StructField("block", long), T.StructField("doc", doc), *[T.StructField(c, long) for c in COUNTS],
                         T.StructField("groups", T.StringType()), T.StructField("groups_sha256", T.StringType()),
                         T.StructField("at", T.BinaryType()), T.StructField("times", T.BinaryType()),
                         T.StructField("pairs", T.ArrayType(long)), T.StructField("holders", T.ArrayType(long))])


def _document_rows(block: Block, doc: pa.Array, counts: np.ndarray, groups: list[bytes], texts: bool,
                   at: list[np.ndarray], times: list[np.ndarray]) -> pa.RecordBatch:
    schema, width = _schema(doc.type), np.uint16 if len(block.key) <= CODES else np.uint32
    made = {"block": pa.array(np.full(len(doc), block.number)), "doc": doc,
            **{c: pa.array(counts[:, k]) for k, c in enumerate(COUNTS)},
            "groups_sha256": pa.array([hashlib.sha256(g).hexdigest() if g else "" for g in groups], pa.string()),
            "at": pa.array([x.astype(width).tobytes() for x in at], pa.binary()),
            "times": pa.array([x.astype(np.uint32).tobytes() for x in times], pa.binary())}
    if texts:
        made["groups"] = pa.array([g.decode() for g in groups], pa.string())
    block.bytes += sum(len(x) for x in at) * 6
    return pa.RecordBatch.from_arrays([made.get(f.name, pa.nulls(len(doc), f.type)) for f in schema], schema=schema)


def _chunks(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    first = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= CHUNK:
            yield first, i + 1
            first, size = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


def _align_short(paths: tuple[str, str], texts: bool, piece: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = byte_level(paths[0]), piece_model(paths[1])
        number = TaskContext.get().partitionId() << 24
        block, kind = Block(number), None
        for batch in batches:
            text, kind = batch.column("text").to_pylist(), batch.column("doc").type
            for first, end in _chunks(text):
                got = Aligned(text[first:end], a, b, piece)
                keys, holders = np.unique(got.key, return_counts=True)
                if block.bytes > BLOCK or (len(block.key) and len(block.key) + len(block.fresh(keys)) > CODES):
                    yield block.row(kind)
                    number += 1
                    block = Block(number)
                block.add(keys, holders)
                edge = np.searchsorted(got.doc, np.arange(end - first + 1))
                code = block.codes(got.key)
                yield _document_rows(block, batch.column("doc").slice(first, end - first), got.counts, got.groups, texts,
                                     [code[p:q] for p, q in zip(edge, edge[1:])],
                                     [got.times[p:q] for p, q in zip(edge, edge[1:])])
        if kind is not None:
            yield block.row(kind)
    return run


# ids and ends (after the last end of A before the piece) are 32-bit integers
_PIECES = ("uid long, piece long, n_a long, n_b long, a binary, a_ends binary, b binary, b_ends binary, next_a long, "
           "next_b long")
_PART = ("uid long, piece long, n_a long, n_b long, cut boolean, n_cuts long, head_a binary, head_b binary, middle binary, "
         "tail_a binary, tail_b binary, key binary, times binary")


def _packed(x: np.ndarray) -> bytes:
    return x.astype(np.int32).tobytes()


def _open(x: bytes) -> np.ndarray:
    return np.frombuffer(x, np.int32).astype(np.int64)


def _pieces_of_long(paths: tuple[str, str], piece: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = byte_level(paths[0]), piece_model(paths[1])
        for batch in batches:
            for uid, text in zip(batch.column("uid"), batch.column("text")):
                text = text.as_py()
                (ids_a,), (ids_b,) = a.encode([text]), b.encode([text])
                if not (_spells(a, ids_a, text) and _spells(b, ids_b, text)):
                    continue
                ends_a, ends_b = np.cumsum(a.length[ids_a]), np.cumsum(b.length[ids_b])
                i, j = cuts_of(ends_a, ends_b, piece)
                for k, (p, q, r, s) in enumerate(zip(i, i[1:], j, j[1:])):
                    last = ends_a[p - 1] if p else 0
                    yield pa.RecordBatch.from_pylist([{
                        "uid": uid.as_py(), "piece": k, "n_a": len(ids_a), "n_b": len(ids_b),
                        "a": _packed(ids_a[p:q]), "a_ends": _packed(ends_a[p:q] - last), "b": _packed(ids_b[r:s]),
                        "b_ends": _packed(ends_b[r:s] - last), "next_a": int(ids_a[q]) if q < len(ids_a) else 0,
                        "next_b": int(ids_b[s]) if s < len(ids_b) else 0}])
    return run


def _align_pieces(sizes: tuple[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        say = names(*sizes)
        for batch in batches:
            for r in batch.to_pylist():
                a, b = _open(r["a"]), _open(r["b"])
                link_a, link_b, cut_a, cut_b = overlaps(_open(r["a_ends"]), _open(r["b_ends"]))
                key, times = np.unique(np.append(a, r["next_a"])[link_a] * sizes[1] + np.append(b, r["next_b"])[link_b],
                                       return_counts=True)
                cut = len(cut_a) > 0
                (p, q), (s, t) = ((x[0], x[-1]) if cut else (len(y), len(y)) for x, y in ((cut_a, a), (cut_b, b)))
                middle = say.text(say.order(a[p:q], b[s:t], cut_a[1:] - p, cut_b[1:] - s)) if cut else b""
                yield pa.RecordBatch.from_pylist([{
                    **{c: r[c] for c in ("uid", "piece", "n_a", "n_b")}, "cut": cut, "n_cuts": len(cut_a),
                    "head_a": _packed(a[:p]), "head_b": _packed(b[:s]), "middle": middle, "tail_a": _packed(a[q:]),
                    "tail_b": _packed(b[t:]), "key": key.tobytes(), "times": times.tobytes()}])
    return run


def _stitch(texts: bool):
    def one_group(a: list[bytes], b: list[bytes]) -> bytes:
        say = lambda parts: b",".join(b"%d" % i for i in _open(b"".join(parts)).tolist())
        return say(a) + b"|" + say(b) + b";"

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        """left: the pieces of one document, right: its kept columns (one row)."""
        uid, doc = right.column("uid")[0].as_py(), right.column("doc").combine_chunks()
        block, groups, counts = Block(-1 - uid), [], np.zeros((1, 4), np.int64)
        key, times, open_a, open_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [], []
        for r in left.sort_by("piece").to_pylist():
            open_a.append(r["head_a"])
            open_b.append(r["head_b"])
            if r["cut"]:
                groups += [one_group(open_a, open_b), r["middle"]]
                open_a, open_b = [r["tail_a"]], [r["tail_b"]]
            counts += [[0, 0, r["n_cuts"], 0]]
            counts[0, :2] = r["n_a"], r["n_b"]
            key.append(np.frombuffer(r["key"], np.int64))
            times.append(np.frombuffer(r["times"], np.int64))
        counts[0, 3] = counts[0, 0] + counts[0, 1] - counts[0, 2]
        keys, back = np.unique(np.concatenate(key), return_inverse=True)
        block.add(keys, np.ones(len(keys), np.int64))
        links = np.bincount(back, np.concatenate(times), len(keys)).astype(np.int64)
        own = _document_rows(block, doc, counts, [b"".join(groups)[:-1]], texts, [block.codes(keys)], [links])
        return pa.Table.from_batches([own, block.row(doc.type)])
    return run


def align(docs: DataFrame, paths: tuple[str, str], text: str = "text", texts: bool = False, long: int = LONG,
          piece: int = PIECE) -> DataFrame:
    """Stored rows: of documents (``doc``: the input columns without the text) with
    their counts, ``groups`` (with ``texts``), its SHA-256 and their links, and of
    blocks with their pairs and how many documents hold them. ``paths``: a byte-level
    BPE file (A) and a piece model (B) that every executor has."""
    prepare(docs.sparkSession)
    kept = [F.col(f"`{c}`").alias(c) for c in docs.columns if c != text]
    rows = docs.select(F.struct(*kept, F.lit(1).alias("__one")).alias("doc"), F.col(f"`{text}`").alias("text"))
    # Arrow results are held to nullability too, and frames read back may be null
    own = T.StructType.fromJson(json.loads(re.sub(r'("nullable"|"containsNull"|"valueContainsNull"):false', r"\1:true",
                                                  rows.schema["doc"].dataType.json())))
    rows, kind = rows.withColumn("doc", F.col("doc").cast(own)), _rows_type(own)
    is_long = F.coalesce(F.octet_length("text") > long, F.lit(False))
    short = rows.filter(~is_long).mapInArrow(_align_short(paths, texts, piece), kind)
    # the numbers are stored, so that both sides of the stitching agree
    spread = stored(rows.filter(is_long).withColumn("uid", F.monotonically_increasing_id()), "align-long")
    pieces = spread.select("uid", "text").mapInArrow(_pieces_of_long(paths, piece), _PIECES)
    sizes = (byte_level(paths[0]).size, piece_model(paths[1]).size)
    parts = pieces.repartition("uid", "piece").mapInArrow(_align_pieces(sizes), _PART)
    whole = parts.groupBy("uid").cogroup(spread.select("uid", "doc").groupBy("uid")).applyInArrow(
        _stitch(texts), kind)
    return stored(short.unionByName(whole), "align-rows")


def pair_counts(rows: DataFrame, size_b: int) -> DataFrame:
    """(pair, n_docs, best) of all pairs: ``pair`` is A id * size_b + B id; best: no
    pair of its A id is in more documents."""
    held = rows.filter("pairs is not null").select(F.explode(F.arrays_zip("pairs", "holders")).alias("p"))
    total = held.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.holders").alias("n_docs"))
    own = Window.partitionBy(F.floor(F.col("pair") / size_b))  # at most size_b rows
    return total.withColumn("best", F.col("n_docs") == F.max("n_docs").over(own))


def _scored(left: pa.Table, right: pa.Table) -> pa.Table:
    """left: a block's documents, right: its pairs' places, counts and marks."""
    n = right.num_rows
    count, best = np.zeros(n, np.int64), np.zeros(n, np.int64)
    place = right.column("place").to_numpy()
    count[place], best[place] = right.column("n_docs").to_numpy(), right.column("best").to_numpy()
    sums = []
    for at, times in zip(left.column("at").to_pylist(), left.column("times").to_pylist()):
        t = np.frombuffer(times, np.uint32).astype(np.int64)
        p = np.frombuffer(at, np.uint16 if len(at) * 2 == len(times) else np.uint32)
        sums.append((int((t * best[p]).sum()), int((t * count[p]).sum())))
    out = left.drop_columns(["block", "at", "times"])
    for c, k in (("n_best", 0), ("count_sum", 1)):
        out = out.append_column(c, pa.array([x[k] for x in sums], pa.int64()))
    return out


def score(rows: DataFrame, size_b: int) -> DataFrame:
    """Documents of ``align`` with ``n_best`` (links whose pair is their A id's best)
    and ``count_sum`` (their pairs' documents, summed over links)."""
    given = rows.filter("pairs is not null").select("block", F.posexplode("pairs").alias("place", "pair")).join(
        pair_counts(rows, size_b), "pair").select(F.col("block").alias("of"), "place", "n_docs", "best")
    own = ["doc", *COUNTS, "groups", "groups_sha256"]
    docs = rows.filter("doc is not null").select("block", *own, "at", "times")
    kind = T.StructType([*[docs.schema[c] for c in own], T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])
    out = docs.groupBy("block").cogroup(given.groupBy("of")).applyInArrow(_scored, kind)
    names_ = [c for c in docs.schema["doc"].dataType.fieldNames() if c not in kind.fieldNames() and c != "__one"]
    return out.select(*[F.col(f"doc.`{c}`") for c in names_], *[c for c in kind.fieldNames() if c != "doc"])
