"""SimHash near-duplicates with deletion-variant signatures.

A fingerprint is cut into ``max_bits // 2 + 1`` segments, so that two
fingerprints within ``max_bits`` differ by at most one bit in some segment.
Each segment is indexed once per bit with that bit masked (one-wildcard
variants); an equality join on (bit, masked segment) gives every candidate and
the bit distance verifies it.

Equal fingerprints are one node, so copies are never paired. Dense groups are
linked in two steps: every member of a bucket to the bucket's smallest member,
then only pairs that are still in different components. Both give the same
components as all pairs. Components are found by large-star / small-star rounds
over a stored edge table; nothing is collected. All joins but that with the few
large components are merge joins, whatever size Spark would broadcast: tables of
fingerprints, edges and keys grow with the input and never pass through the driver.

Cases: a null or blank text has fingerprint zero and links like any other;
repeated rows are kept; null ids take part but never name a component unless
all its ids are null; an empty table gives no rows; other input columns are
ignored.
"""

from __future__ import annotations

from itertools import accumulate, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudmart.llm.common import prepare, stored

SEED = 42
HOT = 1024  # components of this share of all fingerprints or more are looked up, not joined
CROWD = 16  # members from which a bucket of one component is set aside


def simhash(text: str | None, shingle: int = 4) -> int:
    """Unsigned 64-bit fingerprint of one whole text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z only
    if not words:
        return 0
    joined, k = b" ".join(words), min(shingle, len(words))
    ends = [e - 1 for e in accumulate(len(w) + 1 for w in words)]
    starts = [0, *(e + 1 for e in ends[:-1])]
    n = len(words) - k + 1
    pieces = map(joined.__getitem__, map(slice, starts[:n], ends[k - 1:]))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, pieces, repeat(SEED)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 15):
        block = hashes[at:at + (1 << 15)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def simhash_of(text: Column, shingle: int = 4) -> Column:
    """Fingerprints of a text column as signed longs (the same 64 bits)."""

    @F.arrow_udf("bigint")
    def run(texts: pa.Array) -> pa.Array:
        prints = np.fromiter((simhash(t, shingle) for t in texts.to_pylist()), np.uint64, len(texts))
        return pa.array(prints.view(np.int64))

    return run.asNondeterministic()(text)


def segments(max_bits: int) -> list[tuple[int, int]]:
    """(first bit, width) of the segments: one differs by at most one bit."""
    m = max_bits // 2 + 1
    cuts = [round(i * 64 / m) for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _key(fp: Column, max_bits: int) -> Column:
    """Array of (bit, masked segment) keys: 64 per fingerprint."""
    out = []
    for first, width in segments(max_bits):
        for bit in range(first, first + width):
            mask = (((1 << width) - 1) << first) & ~(1 << bit)
            out.append(F.struct(F.lit(bit).cast("byte").alias("bit"),
                                fp.bitwiseAND(F.lit(_signed(mask))).alias("masked")))
    return F.array(*out)


def variants(nodes: DataFrame, max_bits: int) -> DataFrame:
    """One row per key; dealt out first, since a small file grows 64-fold here."""
    nodes = nodes.repartition(int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp")
    return (nodes.select("*", F.explode(_key(F.col("fp"), max_bits)).alias("k"))
            .select("k.bit", "k.masked", *nodes.columns))


def _merged(df: DataFrame) -> DataFrame:
    """To be joined by merging: not sent whole through the driver to all executors."""
    return df.hint("merge")


def _near(a: Column, b: Column, max_bits: int) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= max_bits


def _first_shared(diff: Column, bit: Column, max_bits: int) -> Column:
    """True for one of the keys that a pair shares, so that it is found once: in the
    first segment with at most one differing bit, at that bit (or the segment's first)."""
    out = F.lit(False)
    for first, width in reversed(segments(max_bits)):
        ones = F.bit_count(diff.bitwiseAND(F.lit(_signed(((1 << width) - 1) << first))))
        here = bit.between(first, first + width - 1) & ((ones == 1) | (bit == first))
        out = F.when(ones <= 1, here).otherwise(out)
    return out


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, root) of every node of an edge list (a, b): root is the smallest node.

    Alternating large-star and small-star rounds; the edge table is stored after
    each round, and a round that changes nothing ends it."""
    tidy = lambda e: e.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e = stored(tidy(edges), f"{name}-edges")
    mark = lambda e: e.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first()
    before = mark(e)
    while before[0]:
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = tidy(both.filter("b > a").join(_merged(least), "a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(_merged(down), "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            down.select("a", F.col("m").alias("b")))
        e = stored(tidy(small), f"{name}-round")
        now = mark(e)
        if now == before:
            break
        before = now
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def link(nodes: DataFrame, max_bits: int = 4) -> DataFrame:
    """(fp, root) for the distinct fingerprints of ``nodes`` that link to another."""
    # 1. members of a bucket to its smallest member
    v = variants(nodes.select("fp"), max_bits)
    least = (v.groupBy("bit", "masked").agg(F.min("fp").alias("m"), F.count("*").alias("n"))
             .filter("n > 1").drop("n"))
    star = (v.join(_merged(least), ["bit", "masked"]).filter((F.col("fp") != F.col("m")) & _near(F.col("fp"), F.col("m"), max_bits))
            .select(F.col("fp").alias("a"), F.col("m").alias("b")).distinct())
    first = stored(components(star, "simhash-star").select(F.col("node").alias("fp"), "root"), "simhash-first")
    # 2. pairs of different components only; crowded buckets of one component are done
    rooted = stored(nodes.select("fp").join(_merged(first), "fp", "left")
                    .select("fp", F.coalesce("root", "fp").alias("root")), "simhash-rooted")
    v = variants(rooted, max_bits)
    done = stored(v.groupBy("bit", "masked").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("n"))
                  .filter(f"lo = hi and n > {CROWD}").select("bit", "masked"), "simhash-done")
    v = v.join(_merged(done), ["bit", "masked"], "left_anti")
    x, y = v.alias("x"), v.alias("y")
    cross = (x.join(_merged(y), (F.col("x.bit") == F.col("y.bit")) & (F.col("x.masked") == F.col("y.masked"))
                    & (F.col("x.root") < F.col("y.root"))
                    & _near(F.col("x.fp"), F.col("y.fp"), max_bits)
                    & _first_shared(F.col("x.fp").bitwiseXOR(F.col("y.fp")), F.col("x.bit"), max_bits))
             .select(F.col("x.root").alias("b"), F.col("y.root").alias("a")).distinct())
    second = components(cross, "simhash-cross")
    ends = (first.select("root").union(second.select(F.col("node").alias("root"))).distinct()
            .join(_merged(second.select(F.col("node").alias("root"), F.col("root").alias("top"))), "root", "left")
            .select("root", F.coalesce("top", "root").alias("top")))
    return (rooted.join(_merged(ends), "root").select("fp", F.col("top").alias("root")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
                    shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """(id, fp long, component_id): one row per input row."""
    prepare(docs.sparkSession)
    prints = stored(docs.select(F.col(f"`{id_col}`").alias("id"), simhash_of(F.col(f"`{text}`"), shingle).alias("fp")),
                    "simhash-prints")
    nodes = stored(prints.groupBy("fp").agg(F.min("id").alias("first")), "simhash-nodes")
    roots = stored(link(nodes, max_bits), "simhash-roots")
    named = nodes.join(_merged(roots), "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    names = stored(named.groupBy("root").agg(F.min("first").alias("component_id"), F.count("*").alias("n")), "simhash-components")
    # at most HOT rows
    hot = names.filter(F.col("n") * HOT >= nodes.count()).select("root", F.col("component_id").alias("large"), F.lit(True).alias("hot"))
    marked = named.join(F.broadcast(hot), "root", "left")
    rest = marked.filter("hot is null").select("fp", "root").join(_merged(names.drop("n")), "root").select("fp", "component_id")
    by_print = stored(rest.unionByName(marked.filter("hot").select("fp", F.col("large").alias("component_id"))),
                      "simhash-names")
    return prints.join(_merged(by_print), "fp").select("id", "fp", "component_id")
