"""Token ids as flat unsigned integer files with 64-bit document offsets.

Documents are range-partitioned by id, encoded, and each partition writes one
shard: ``.bin`` (ids, little-endian uint16, or uint32 for a vocabulary above
65,536), ``.idx`` (int64 offsets into it, one more than documents) and ``.doc``
(int64 document ids, then one validity byte each). The manifest holds each
shard's counts; the id base of a shard is the prefix sum over the shards before
it. Shards are read by memory map (local or mounted folders) or an open file.

Encoding: where the file's normalizer and pre-tokenizer show that white space is
dropped, case folded and letters split from full stops and commas (``by_words``,
like the public word-level file used here), texts are cut at ASCII white space and
each distinct piece is encoded by the library once per worker (a bounded cache),
words of letters many at a time: their tokens are told apart by the tokens that end
a word. This equals encoding the text. With any other file whole texts are encoded.

Cases: a null or blank text has only the end id; null ids come first; equal ids
are ordered by a hash of the text (equal texts have equal ids); an empty table
gives no shards; other columns are ignored.
"""

from __future__ import annotations

import json
import os
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fraudmart.llm.common import filesystem, join_path, prepare, stored
from fraudmart.session import scratch_path

CACHE = 1 << 19  # distinct pieces kept per worker process, some 100 MB; executors hold several
JOINED = 1024  # words of letters encoded as one text
#: Steps of the tokenizers whose words can be encoded apart (fixed values of their format).
FOLDS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLITS = [{"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
           "behavior": "Removed", "invert": True},
          {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]


_ENCODERS: dict[str, tuple] = {}


def by_words(spec: dict) -> bool:
    """Whether a tokenizer file drops white space and then treats each word by itself."""
    model = spec["model"]
    return ((spec.get("normalizer") or {}).get("normalizers") == FOLDS and (spec.get("pre_tokenizer") or {}).get("pretokenizers") == SPLITS
            and model["type"] == "BPE" and model.get("end_of_word_suffix") == "</w>" and not model.get("dropout"))


def encoder(vocab: str) -> tuple[Callable[[list[str]], list[bytes]], str]:
    """(texts -> ids as raw little-endian bytes, dtype) for a tokenizer file; one per
    worker process."""
    if vocab in _ENCODERS:
        return _ENCODERS[vocab]
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(vocab)
    dtype = "<u2" if tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
    kind = "H" if dtype == "<u2" else "I"
    pack = lambda ids: struct.pack(f"<{len(ids)}{kind}", *ids)
    with open(vocab, encoding="utf-8") as f:
        spec = json.load(f)
    if not by_words(spec):
        def whole(texts: list[str | None]) -> list[bytes]:
            return [pack(e.ids) for e in tokenizer.encode_batch_fast([t or "" for t in texts], add_special_tokens=False)]

        _ENCODERS[vocab] = whole, dtype
        return _ENCODERS[vocab]
    ends = np.zeros(tokenizer.get_vocab_size(), bool)
    ends[[i for token, i in spec["model"]["vocab"].items() if token.endswith("</w>")]] = True
    width = int(dtype[-1])
    cache: dict[bytes, bytes] = {}

    def learn(words: set[bytes]) -> None:
        # a last full stop or comma behind a letter is a token of its own
        stems = {w: w[:-1] for w in words if w.endswith((b".", b",")) and w[-2:-1].isalpha()}
        plain = words.difference(stems)
        plain.update(stems.values(), (b".", b","))
        plain = plain.difference(cache)  # walks the words, difference_update would walk the cache
        letters = [w for w in plain if w.isalpha() or not w.isascii() and w.decode().isalpha()]
        others = list(plain.difference(letters))
        for at in range(0, len(letters), JOINED):
            part = letters[at:at + JOINED]
            text = b" ".join(part).decode()
            ids = np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype)
            edge = ((np.flatnonzero(ends[ids]) + 1) * width).tolist()
            if len(edge) != len(part):  # some are more than one word to the tokenizer
                others += part
                continue
            raw = ids.tobytes()
            cache.update(zip(part, [raw[a:b] for a, b in zip([0, *edge], edge)]))
        for at in range(0, len(others), 1 << 14):
            part = others[at:at + (1 << 14)]
            made = tokenizer.encode_batch_fast([w.decode() for w in part], add_special_tokens=False)
            cache.update(zip(part, [pack(e.ids) for e in made]))
        cache.update([(w, cache[stem] + cache[w[-1:]]) for w, stem in stems.items()])

    def cut(raw: bytes) -> list[bytes]:
        # the tokenizer ignores case, but for its special tokens; it composes letters before it
        # lowers them, some in one case only, with marks that begin with these bytes
        if b"<|" in raw:
            return raw.split()
        if b"\xcc" in raw or b"\xcd" in raw:
            return [w.lower() if w.isascii() else w for w in raw.split()]
        return raw.lower().split()

    def encode(texts: list[str | None]) -> list[bytes]:
        words = [cut((t or "").encode("utf-8", "replace")) for t in texts]
        every = set().union(*words)
        new = every.difference(cache)
        if len(cache) + len(new) > CACHE:
            cache.clear()
            new = every
        learn(new)
        return [b"".join(map(cache.__getitem__, ws)) for ws in words]

    _ENCODERS[vocab] = encode, dtype
    return _ENCODERS[vocab]


def write_shards(docs: DataFrame, folder: str, vocab: str, end_id: int, id_col: str = "doc_id",
                 text: str = "text", shards: int | None = None) -> DataFrame:
    """Write the shards; returns the manifest with ``base`` (ids before the shard)."""
    spark = docs.sparkSession
    prepare(spark)
    if not shards:  # one for each part of the input, so their number grows with its bytes
        shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), docs.rdd.getNumPartitions())
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    order = [F.asc_nulls_first("id"), F.asc("tie")]
    rows = rows.repartitionByRange(shards, *order).sortWithinPartitions(*order).select("id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, dtype = encoder(vocab)
        end, width = np.array([end_id], dtype).tobytes(), int(dtype[-1])
        fs, base = filesystem(folder)
        fs.create_dir(base, recursive=True)
        name, total, ids, lengths, out = uuid.uuid4().hex, 0, [], [np.zeros(1, np.int64)], None
        for batch in batches:
            if not batch.num_rows:
                continue
            out = out or fs.open_output_stream(join_path(base, name + ".bin"))
            made = encode(batch.column(1).to_pylist())
            for m in made:
                out.write(m + end)
            lengths.append(np.fromiter((len(m) // width + 1 for m in made), np.int64, len(made)))
            ids.append(batch.column(0))
        if out is None:
            return
        out.close()
        offsets = np.cumsum(np.concatenate(lengths)).astype("<i8")
        total = int(offsets[-1])
        keys = pa.chunked_array(ids)
        with fs.open_output_stream(join_path(base, name + ".idx")) as f:
            f.write(offsets.tobytes())
        with fs.open_output_stream(join_path(base, name + ".doc")) as f:
            f.write(keys.fill_null(0).to_numpy().astype("<i8").tobytes())
            f.write(keys.is_valid().to_numpy().astype("u1").tobytes())
        yield pa.RecordBatch.from_pydict({
            "part": pa.array([TaskContext.get().partitionId()], pa.int32()), "shard": [join_path(folder, name)],
            "dtype": [dtype], "n_docs": [len(keys)], "n_tokens": [total]})

    manifest = stored(rows.mapInArrow(write, "part int, shard string, dtype string, n_docs long, n_tokens long"),
                      "token-manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    return stored(manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))), "token-bases")


def _open(uri: str):
    fs, path = filesystem(uri)
    if isinstance(fs, pafs.LocalFileSystem) and fs.get_file_info(path).size:
        return pa.memory_map(path)
    return fs.open_input_file(path)


def read_shards(manifest: DataFrame, with_ids: bool = False, step: int = 1024) -> DataFrame:
    """One row per document: id, start (of all shards), n_tokens, ids_crc32 and, if
    asked for, the ids."""
    schema = "id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                n, width = r["n_docs"], int(r["dtype"][-1])
                with _open(r["shard"] + ".idx") as idx, _open(r["shard"] + ".doc") as doc, _open(r["shard"] + ".bin") as ids:
                    for at in range(0, n, step):
                        k = min(step, n - at)
                        offsets = np.frombuffer(idx.read_at((k + 1) * 8, at * 8), "<i8")
                        keys = np.frombuffer(doc.read_at(k * 8, at * 8), "<i8")
                        valid = np.frombuffer(doc.read_at(k, n * 8 + at), "u1")
                        first, last = int(offsets[0]), int(offsets[-1])
                        chunk = np.frombuffer(ids.read_at((last - first) * width, first * width), r["dtype"]).astype("<u4")
                        spans = [chunk[a:b] for a, b in zip((offsets[:-1] - first).tolist(), (offsets[1:] - first).tolist())]
                        columns = [pa.array(keys, mask=valid == 0), pa.array(offsets[:-1] + r["base"]),
                                   pa.array(np.diff(offsets)),
                                   pa.array([zlib.crc32(s) for s in spans], pa.int64())]
                        names = ["id", "start", "n_tokens", "ids_crc32"]
                        if with_ids:
                            columns.append(pa.array([s.tolist() for s in spans], pa.list_(pa.int64())))
                            names.append("ids")
                        yield pa.RecordBatch.from_arrays(columns, names)

    wanted = manifest.select("shard", "dtype", "n_docs", "base")
    return wanted.repartition(max(1, manifest.count())).mapInArrow(read, schema)


def round_trip(docs: DataFrame, vocab: str, end_id: int) -> DataFrame:
    """Write the shards to the shared folder and read them back."""
    folder = scratch_path(docs.sparkSession, "tokens")
    return read_shards(write_shards(docs, folder, vocab, end_id))
