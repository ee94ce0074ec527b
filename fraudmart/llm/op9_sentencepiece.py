"""SentencePiece encoding and decoding as a max-plus scan.

A model file gives pieces and scores; the best segmentation of a text is the
path of largest total score (ties: the longest last piece), so encoding is a
product of matrices over (max, +). Characters without a piece are byte pieces.

* Ordinary texts are one chunk. White-space marks and characters without a piece
  are forced boundaries, so the path splits there exactly and each distinct part
  is segmented once per worker (a bounded cache); new parts of one length are
  segmented together, as arrays.
* Giant texts are cut into chunks of ``chunk`` characters. A boundary state is
  the distance from the cut to the first piece boundary behind it. Each chunk
  yields its transfer matrix between the states of its two cuts; matrices are
  combined associatively (groups of GROUP chunks, then the groups); each chunk
  then knows the scores of its entry states, maps every exit to the entry it is
  reached from, and after the maps are composed from the end, backtraces
  independently. Scores are kept as exact doubles, so the result equals one pass
  over the whole text, ties included.

The public model file given here was trained for merges; its pieces and scores
are used as the weights of the lattice, so ids differ from the library's merges;
the library decodes them to the same text. Tests hold the result against all
segmentations of short texts.

Cases: a null or empty text has no ids and decodes to the empty text; the
white-space mark itself decodes to a space; repeated texts that are giant are
encoded once; an empty table gives no rows; columns of the input are kept, the
result's columns replace any of the same name. Giant texts are handled whole,
bounded by what a row may hold (2 GiB).
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudmart.llm.common import prepare, stored

MARK = "▁"
NORMAL, USER = 1, 4
USER_SCORE = -0.125  # always preferred, exact in binary
UNKNOWN_PENALTY = 10.0
CACHE = 1 << 18  # parts kept by a worker, at most
SHORT = 64  # characters of a part that is segmented together with others
BLOCK = 1 << 14  # parts that are segmented together, at most
GROUP = 64
ENCODED = "struct<n_tokens:bigint,ids:binary>"


def _fields(data: bytes, at: int, end: int) -> Iterator[tuple[int, int, int, int]]:
    """(field, wire type, start, end) of a protobuf message's fields."""
    def varint(i: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            value |= (data[i] & 127) << shift
            shift, i = shift + 7, i + 1
            if data[i - 1] < 128:
                return value, i
    while at < end:
        tag, at = varint(at)
        if tag & 7 == 0:
            stop = varint(at)[1]
        elif tag & 7 == 2:
            size, at = varint(at)
            stop = at + size
        else:
            stop = at + (8 if tag & 7 == 1 else 4)
        yield tag >> 3, tag & 7, at, stop
        at = stop


class Model:
    """Pieces and scores of a model file; exact segmentation of parts and chunks."""

    def __init__(self, data: bytes):
        self.scores: dict[str, tuple[int, float]] = {}
        self.bytes_of: list[bytes] = []
        self.byte_ids = [0] * 256
        low = 0.0
        for field, _, at, end in _fields(data, 0, len(data)):
            if field == 1:
                text, score, kind = "", 0.0, NORMAL
                for f, _, a, b in _fields(data, at, end):
                    if f == 1:
                        text = data[a:b].decode()
                    elif f == 2:
                        score = struct.unpack("<f", data[a:b])[0]
                    else:
                        kind = data[a]
                no = len(self.bytes_of)
                raw = b""
                if kind in (NORMAL, USER):
                    raw = text.replace(MARK, " ").encode()
                    self.scores[text] = no, (score if kind == NORMAL else USER_SCORE)
                    low = min(low, score) if kind == NORMAL else low
                elif kind == 6:  # <0xAB>
                    raw = bytes([int(text[3:5], 16)])
                    self.byte_ids[raw[0]] = no
                self.bytes_of.append(raw)
        self.unknown = low - UNKNOWN_PENALTY
        self.longest = max(map(len, self.scores))
        self.single = {p for p in self.scores if len(p) == 1}
        heads = {p[:i] for p in self.scores for i in range(1, len(p) + 1)}
        self.heads = heads
        # marks only ever lead a piece (or make it up), so a run of them is a boundary
        free = all(MARK not in p.lstrip(MARK) for p in self.scores)
        plain = "".join(sorted(self.single - {MARK}))
        inside = "[" + re.escape(plain) + "]"
        self.parts = re.compile(f"{MARK}+{inside}*|{inside}+|." if free else ".+", re.S)
        # every head of a piece; -inf where it is none itself
        self.table = {h: self.scores[h][1] if h in self.scores else -np.inf for h in heads}
        self._index()
        self.cache: dict[str, bytes] = {}
        self.known: dict[str, tuple[list[int], float]] = {}

    def _index(self) -> None:
        """The heads as a sorted array of (parent, character) keys; the head at place i
        is number i + 1, the empty one 0, so that the first ones are the characters."""
        letters = sorted(self.single)
        code = {c: i for i, c in enumerate(letters)}
        self.code = np.full(0x110000, -1, np.int64)
        self.code[[ord(c) for c in letters]] = np.arange(len(letters))
        levels: list[list[str]] = [[] for _ in range(self.longest + 1)]
        for h in self.heads:
            if all(c in code for c in h):
                levels[len(h)].append(h)
        number, keys, scores, ids = {"": 0}, [], [-np.inf], [-1]
        for level in levels:
            for key, h in sorted((number[h[:-1]] * len(letters) + code[h[-1]], h) for h in level):
                keys.append(key)
                number[h] = len(keys)
                no, score = self.scores.get(h, (-1, -np.inf))
                ids.append(no)
                scores.append(score)
        self.keys, self.head_score, self.head_id = np.array(keys, np.int64), np.array(scores), np.array(ids, np.int32)
        self.letters = len(letters)

    def arcs(self, s: str, at: int, end: int) -> list[tuple[int, int, float]]:
        """(end, id, score) of the pieces that start at a position; id -1: bytes."""
        out, heads, scores = [], self.heads, self.scores
        for e in range(at + 1, min(end, at + self.longest) + 1):
            piece = s[at:e]
            if piece not in heads:
                break
            if piece in scores:
                out.append((e, *scores[piece]))
        if not out or out[0][0] != at + 1:
            out.append((at + 1, -1, self.unknown))
        return out

    def spell(self, s: str, steps: list[tuple[int, int, int]]) -> list[int]:
        """Ids of (start, end, id) steps; bytes where there is no piece."""
        out: list[int] = []
        for a, e, no in steps:
            if no >= 0:
                out.append(no)
            else:
                out += [self.byte_ids[x] for x in s[a:e].encode("utf-8", "replace")]
        return out

    def forward(self, s: str, entry: list[float], stop: int) -> tuple[list[float], list[tuple[int, int] | None]]:
        """Best scores and arrivals of every position; pieces start before ``stop``."""
        n = len(s)
        best = [-np.inf] * (n + 1)
        came: list[tuple[int, int] | None] = [None] * (n + 1)
        best[:len(entry)] = entry[:n + 1]
        for at in range(stop):
            here = best[at]
            if here == -np.inf:
                continue
            for e, no, score in self.arcs(s, at, n):
                if here + score > best[e]:
                    best[e], came[e] = here + score, (at, no)
        return best, came

    def back(self, came, at: int) -> tuple[int, list[tuple[int, int, int]]]:
        """(entry position, steps) of the best path that ends at a position."""
        steps = []
        while came[at] is not None:
            start, no = came[at]
            steps.append((start, at, no))
            at = start
        return at, steps[::-1]

    def segment(self, s: str) -> list[int]:
        """Ids of a marked text in one pass."""
        return self.spell(s, self.back(self.forward(s, [0.0], len(s))[1], len(s))[1])

    def marked(self, text: str | None) -> str:
        return MARK + text.replace(" ", MARK) if text else ""

    def part(self, s: str) -> tuple[list[int], float]:
        """Ids and score of a short part: ``segment`` without its bookkeeping."""
        n, get, single, unknown = len(s), self.table.get, self.single, self.unknown
        best, came = [0.0] + [-np.inf] * n, [0] * (n + 1)
        for at in range(n):
            here = best[at]
            for e in range(at + 1, n + 1):
                score = here + get(s[at:e], np.inf)
                if score > 0:  # no piece starts like this
                    break
                if score > best[e]:
                    best[e], came[e] = score, at
            if s[at] not in single and here + unknown > best[at + 1]:
                best[at + 1], came[at + 1] = here + unknown, at
        steps, scores = [], self.scores
        while n:
            at = came[n]
            steps.append((at, n, scores[s[at:n]][0] if n - at > 1 or s[at] in single else -1))
            n = at
        return self.spell(s, steps[::-1]), best[len(s)]

    def parts_of_length(self, parts: list[str], n: int) -> list[bytes]:
        """Id bytes of parts of ``n`` characters, all of them pieces: ``part`` for each."""
        points = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), "<u4")
        codes = self.code[points].reshape(-1, n).T.copy()
        every = np.arange(len(parts))
        best = np.full((n + 1, len(parts)), -np.inf)
        came, no = np.zeros(best.shape, np.int16), np.zeros(best.shape, np.int32)
        best[0] = 0.0
        for at in range(n):
            rows, head = every, codes[at] + 1
            for e in range(at + 1, n + 1):
                if e > at + 1:  # one character on; what no piece starts like ends
                    key = head * self.letters + codes[e - 1][rows]
                    place = np.searchsorted(self.keys, key)
                    place[place == len(self.keys)] = 0
                    here = self.keys[place] == key
                    rows, head = rows[here], place[here] + 1
                    if not rows.size:
                        break
                score = best[at][rows] + self.head_score[head]
                more = score > best[e][rows]
                better = rows[more]
                best[e][better], came[e][better], no[e][better] = score[more], at, self.head_id[head[more]]
        ids, first, at, rows = np.zeros((len(parts), n), "<i4"), np.full(len(parts), n), np.full(len(parts), n), every
        while rows.size:
            first[rows] -= 1
            ids[rows, first[rows]] = no[at[rows], rows]
            at[rows] = came[at[rows], rows]
            rows = rows[at[rows] > 0]
        raw = ids.tobytes()
        return [raw[4 * (i * n + f):4 * (i + 1) * n] for i, f in enumerate(first.tolist())]

    def learn(self, new: set[str]) -> None:
        """Put parts into the cache."""
        lengths: dict[int, list[str]] = {}
        for p in new:
            if 1 < len(p) <= SHORT and self.single.issuperset(p):
                lengths.setdefault(len(p), []).append(p)
            else:
                ids, _ = self.part(p)
                self.cache[p] = struct.pack(f"<{len(ids)}i", *ids)
        for n, parts in lengths.items():
            for i in range(0, len(parts), BLOCK):
                block = parts[i:i + BLOCK]
                self.cache.update(zip(block, self.parts_of_length(block, n)))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids as little-endian int32 bytes, part by part."""
        split = [self.parts.findall(self.marked(t)) for t in texts]
        new = {p for ps in split for p in ps}.difference(self.cache)
        if len(self.cache) + len(new) > CACHE:
            self.cache.clear()
            new = {p for ps in split for p in ps}
        self.learn(new)
        return [b"".join(map(self.cache.__getitem__, ps)) for ps in split]

    def decode(self, ids: np.ndarray) -> str:
        raw = b"".join(map(self.bytes_of.__getitem__, ids.tolist()))
        return raw[1:].decode("utf-8", "replace")  # the leading mark

    # chunks of giant texts: ``s`` runs from the cut to ``longest - 1`` characters
    # beyond the next cut, ``size`` is the distance between the cuts

    # Between the first forced boundary behind the entry states and the last one
    # before the cut, every path is the same parts; only the ends are searched.

    def inner(self, s: str, size: int) -> tuple[int, int, list[str]] | None:
        """(first, last forced boundary, parts between them) of a chunk, if any."""
        found = [m for m in self.parts.finditer(s[:size + 1]) if self.longest <= m.start() <= size]
        if not found:
            return None
        return found[0].start(), found[-1].start(), [m.group() for m in found[:-1]]

    def scored(self, part: str) -> tuple[list[int], float]:
        if part not in self.known:
            if len(self.known) >= CACHE // 4:
                self.known.clear()
            self.known[part] = self.part(part)
        return self.known[part]

    def columns(self, s: str, size: int) -> np.ndarray:
        """best[position, entry] of every position that a piece from before ``size`` reaches."""
        states, n = self.longest, len(s)
        best = np.full((n + states + 1, states), -np.inf)
        best[np.arange(states), np.arange(states)] = 0.0
        for at in range(size):
            row = best[at]
            if row.max() == -np.inf:
                continue
            for e, _, score in self.arcs(s, at, n):
                np.maximum(best[e], row + score, out=best[e])
        return best

    def matrix(self, s: str, size: int) -> np.ndarray:
        """[entry, exit] best scores between boundary states."""
        states, n, inner = self.longest, len(s), self.inner(s, size)
        if inner is None:
            out = self.columns(s, size)[size:size + states].T.copy()
        else:
            first, last, parts = inner
            head = self.columns(s[:first], first)[first]
            best, _ = self.forward(s[last:], [0.0], size - last)
            tail = np.full(states, -np.inf)
            ends = best[size - last:size - last + states]
            tail[:len(ends)] = ends
            out = (head + sum(self.scored(p)[1] for p in parts))[:, None] + tail
        out[:, n - size + 1:] = -np.inf  # no text there
        return out

    def exits(self, s: str, size: int, entry: np.ndarray) -> np.ndarray:
        """For each exit state, the entry state its best path comes from (-1: none)."""
        inner = self.inner(s, size)
        out = np.full(self.longest, -1, np.int16)
        if inner is not None:  # every path leaves through the first forced boundary
            out[:] = self.back(self.forward(s[:inner[0]], list(entry), inner[0])[1], inner[0])[0]
            return out
        best, came = self.forward(s, list(entry), size)
        for j in range(min(self.longest, len(s) - size + 1)):
            if best[size + j] != -np.inf:
                out[j] = self.back(came, size + j)[0]
        return out

    def chunk_ids(self, s: str, size: int, entry: np.ndarray, leave: int) -> list[int]:
        """Ids of the pieces that start in the chunk, given where it is left."""
        path = lambda s, entry, stop, end: self.spell(s, self.back(self.forward(s, entry, stop)[1], end)[1])
        inner = self.inner(s, size)
        if inner is None:
            return path(s, list(entry), size, size + leave)
        first, last, parts = inner
        out = path(s[:first], list(entry), first, first)
        for p in parts:
            out += self.scored(p)[0]
        return out + path(s[last:], [0.0], size - last, size - last + leave)


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product (associative)."""
    return (a[:, :, None] + b[None]).max(axis=1)


_MODELS: dict[bytes, Model] = {}


def _model(data: bytes) -> Model:
    """One model per worker process."""
    key = data[-64:] + len(data).to_bytes(8, "little")
    if key not in _MODELS:
        _MODELS[key] = Model(data)
    return _MODELS[key]


def encode_column(text: Column, model) -> Column:
    """Struct (n_tokens, ids) of a text column; ``model`` is a broadcast file."""

    @F.arrow_udf(ENCODED)
    def run(texts: pa.Array) -> pa.Array:
        ids = _model(model.value).encode(texts.to_pylist())
        return pa.StructArray.from_arrays(
            [pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())], ["n_tokens", "ids"])

    return run.asNondeterministic()(text)


def giant_ids(texts: DataFrame, model, chunk: int) -> DataFrame:
    """(key, __ids) of distinct giant texts (key, text), by the chunk scan."""
    states = _model(model.value).longest
    marked = texts.select("key", F.concat(F.lit(MARK), F.replace("text", F.lit(" "), F.lit(MARK))).alias("s"))
    size = F.char_length("s")
    cut = F.explode(F.sequence(F.lit(0), F.floor((size - 1) / chunk).cast("int"))).alias("no")
    chunks = stored(marked.select("key", "s", size.alias("n"), cut).select(
        "key", "no", F.substring("s", F.col("no") * chunk + 1, F.lit(chunk + states - 1)).alias("s"),
        F.least(F.lit(chunk), F.col("n") - F.col("no") * chunk).alias("size")), "piece-chunks")
    spread = lambda df: df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), "key", "no")

    def each(schema: str, value):
        names = [x.split()[0] for x in schema.split(", ")]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            m = _model(model.value)
            for batch in batches:
                rows = batch.to_pylist()
                made = [value(m, r) for r in rows]
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0), batch.column(1), pa.array(made, pa.binary())], names)
        return run

    square = lambda raw: np.frombuffer(raw, "<f8").reshape(states, states)
    matrices = stored(spread(chunks).mapInArrow(each(
        "key string, no int, t binary", lambda m, r: m.matrix(r["s"], r["size"]).astype("<f8").tobytes()),
        "key string, no int, t binary"), "piece-matrices")

    def product(pdf: pd.DataFrame) -> pd.DataFrame:  # GROUP matrices at most
        pdf = pdf.sort_values("no")
        total = square(pdf.t.iloc[0])
        for raw in pdf.t.iloc[1:]:
            total = combine(total, square(raw))
        return pd.DataFrame({"key": pdf.key.iloc[:1], "grp": pdf.no.iloc[:1] // GROUP, "t": [total.astype("<f8").tobytes()]})

    def entries(pdf: pd.DataFrame) -> pd.DataFrame:  # 2 GiB / (GROUP * chunk) products at most
        pdf, v, out = pdf.sort_values("grp"), np.full(states, -np.inf), []
        v[0] = 0.0
        for raw in pdf.t:
            out.append(v.astype("<f8").tobytes())
            v = (v[:, None] + square(raw)).max(axis=0)
        return pd.DataFrame({"key": pdf.key, "grp": pdf.grp, "v": out})

    def inner(pdf: pd.DataFrame) -> pd.DataFrame:  # GROUP matrices and one entry vector
        pdf = pdf.sort_values("no")
        v, out = np.frombuffer(pdf.v.iloc[0], "<f8"), []
        for raw in pdf.t:
            out.append(v.astype("<f8").tobytes())
            v = (v[:, None] + square(raw)).max(axis=0)
        return pd.DataFrame({"key": pdf.key, "no": pdf.no, "v": out})

    grouped = matrices.withColumn("grp", F.floor(F.col("no") / GROUP).cast("int"))
    blocks = grouped.groupBy("key", "grp").applyInPandas(product, "key string, grp int, t binary")
    starts = blocks.groupBy("key").applyInPandas(entries, "key string, grp int, v binary")
    entry = (grouped.join(starts, ["key", "grp"]).groupBy("key", "grp")
             .applyInPandas(inner, "key string, no int, v binary"))
    ready = stored(chunks.join(entry, ["key", "no"]), "piece-entries").select("key", "no", "s", "size", "v")
    vector = lambda r: np.frombuffer(r["v"], "<f8")
    maps = spread(ready).mapInArrow(each(
        "key string, no int, f binary", lambda m, r: m.exits(r["s"], r["size"], vector(r)).astype("<i2").tobytes()),
        "key string, no int, f binary")

    def leave(pdf: pd.DataFrame) -> pd.DataFrame:  # a few bytes per chunk of one text
        pdf, at, out = pdf.sort_values("no", ascending=False), 0, []
        for raw in pdf.f:
            out.append(at)
            at = int(np.frombuffer(raw, "<i2")[at])
        return pd.DataFrame({"key": pdf.key, "no": pdf.no, "j": out})

    exits = maps.groupBy("key").applyInPandas(leave, "key string, no int, j int")
    last = stored(ready.join(exits, ["key", "no"]), "piece-exits").select("key", "no", "s", "size", "v", "j")
    done = spread(last).mapInArrow(each(
        "key string, no int, ids binary",
        lambda m, r: np.array(m.chunk_ids(r["s"], r["size"], vector(r), r["j"]), "<i4").tobytes()),
        "key string, no int, ids binary")
    joined = F.array_sort(F.collect_list(F.struct("no", "ids")))  # one text, as in its row
    whole = F.aggregate(joined, F.lit(b""), lambda s, x: F.concat(s, x["ids"]))
    return stored(done.groupBy("key").agg(whole.alias("__ids")), "piece-giants")


def encode(docs: DataFrame, model_file: str, text: str = "text", giant: int = 1 << 16,
           chunk: int = 1 << 14) -> DataFrame:
    """Input columns with ``n_tokens`` and ``ids`` (little-endian int32)."""
    spark = docs.sparkSession
    prepare(spark)
    with open(model_file, "rb") as f:  # half a megabyte
        model = spark.sparkContext.broadcast(f.read())
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    kept = [c for c in docs.columns if c not in ("n_tokens", "ids", "__key", "__e") or c == text]
    rows = docs.select(*[F.col(f"`{c}`") for c in kept],
                       F.when(F.char_length(body) > giant, F.sha2(body.cast("binary"), 256)).alias("__key"))
    big = rows.filter(F.col("__key").isNotNull())
    distinct = big.groupBy(F.col("__key").alias("key")).agg(F.first(F.col(f"`{text}`")).alias("text"))
    found = giant_ids(distinct, model, chunk)
    giants = big.join(found, F.col("__key") == F.col("key")).select(
        *[F.col(f"`{c}`") for c in kept], (F.octet_length("__ids") / 4).cast("long").alias("n_tokens"),
        F.col("__ids").alias("ids"))
    plain = rows.filter(F.col("__key").isNull()).withColumn("__e", encode_column(F.col(f"`{text}`"), model))
    return plain.select(*[F.col(f"`{c}`") for c in kept], "__e.n_tokens", "__e.ids").unionByName(giants)


def decode_column(ids: Column, model) -> Column:
    @F.arrow_udf("string")
    def run(column: pa.Array) -> pa.Array:
        m = _model(model.value)
        return pa.array([m.decode(np.frombuffer(x or b"", "<i4")) for x in column.to_pylist()], pa.string())

    return run(ids)


def checks_column(text: Column, ids: Column, model) -> Column:
    """Struct (ids_crc32, round_trip) without returning the decoded text."""

    @F.arrow_udf("struct<ids_crc32:bigint,round_trip:boolean>")
    def run(texts: pa.Array, column: pa.Array) -> pa.Array:
        m, crc, same = _model(model.value), [], []
        for t, x in zip(texts.to_pylist(), column.to_pylist()):
            crc.append(zlib.crc32(x))
            same.append(m.decode(np.frombuffer(x, "<i4")) == (t or "").replace(MARK, " "))
        return pa.StructArray.from_arrays([pa.array(crc, pa.int64()), pa.array(same)], ["ids_crc32", "round_trip"])

    return run(text, ids)


def round_trip(docs: DataFrame, model_file: str, text: str = "text") -> DataFrame:
    """Encode and decode: ``n_tokens``, ``ids_crc32`` and whether the text came back."""
    made = encode(docs, model_file, text)
    with open(model_file, "rb") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())
    out = [c for c in made.columns if c not in ("ids", "ids_crc32", "round_trip", text)]
    checked = made.select(*[F.col(f"`{c}`") for c in out], checks_column(F.col(f"`{text}`"), F.col("ids"), model).alias("__c"))
    return checked.select(*[F.col(f"`{c}`") for c in out], "__c.ids_crc32", "__c.round_trip")
