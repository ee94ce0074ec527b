"""Nearest neighbours by collision counting over single projections.

Each block of vectors keeps, per random projection, the sorted projected values.
A query opens a window centred on its own projected value in every array;
virtual rehashing widens the windows by a constant factor of the radius, and a
vector whose collisions reach a threshold is verified by its exact distance. A
block is done when its k-th best distance is within the radius (or the windows
hold everything); nothing caps the candidates. The best of the blocks are merged.

The number of projections and the threshold follow from the radius factor and
the error rates: at distance R a vector collides with probability P1 in a window
for R, and the threshold lies between P1 and the probability at twice R.

Queries are taken in blocks of ``query_block``; each is broadcast (a bounded size)
and meets all rows.

Cases: vectors that are null, zero, or hold null or non-finite components take no
part, as query or candidate; vectors of another length than the query's are no
candidates for it; rows with the query's own id are not its neighbours; repeated
rows are candidates each, repeated equal queries are answered once (queries with
one id and different vectors each give rows); ties go to the smaller id; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fraudmart.llm.common import prepare, stored

GROW = 1.25  # radius factor of a round
APART = 2.0  # distance ratio that the threshold tells apart
MISS, FALSE = 0.01, 0.02  # error rates that set the number of projections
BLOCK_ROWS = 1 << 15


def parameters() -> tuple[int, int, float]:
    """(projections, threshold, window width at radius 1)."""
    c = APART
    width = math.sqrt(8 * c * c * math.log(c) / (c * c - 1))
    inside = lambda x: math.erf(x / math.sqrt(2))  # noqa: E731  P(|N| <= x)
    p1, p2 = inside(width / 2), inside(width / 2 / c)
    a, b = math.sqrt(math.log(2 / FALSE)), math.sqrt(math.log(1 / MISS))
    m = math.ceil((a + b) ** 2 / (2 * (p1 - p2) ** 2))
    share = (a * p1 + b * p2) / (a + b)
    return m, math.ceil(share * m), width


class Block:
    """Sorted projections of some vectors of one length."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, seed: int):
        self.ids, self.x = ids, vectors
        self.m, self.threshold, self.width = parameters()
        dim = vectors.shape[1]
        self.axes = np.random.default_rng(seed + dim).standard_normal((dim, self.m))
        h = (vectors @ self.axes).T
        self.order = np.argsort(h, axis=1, kind="stable")
        self.sorted = np.take_along_axis(h, self.order, 1)
        pick = np.random.default_rng(seed).integers(0, len(ids), (2, 64))
        apart = np.sqrt(((vectors[pick[0]] - vectors[pick[1]]) ** 2).sum(1))
        self.first_radius = float(np.median(apart)) / 4 or 1e-6

    def search(self, own: int, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, distances) of the k nearest found, nearest first."""
        n, at, radius = len(self.ids), q @ self.axes, self.first_radius
        hits = np.zeros(n, np.int32)
        seen = self.ids == own
        lo = hi = np.array([np.searchsorted(self.sorted[j], at[j]) for j in range(self.m)])
        ids, dist = np.zeros(0, np.int64), np.zeros(0)
        while True:
            half = self.width * radius / 2
            new_lo = np.array([np.searchsorted(s, a - half, "left") for s, a in zip(self.sorted, at)])
            new_hi = np.array([np.searchsorted(s, a + half, "right") for s, a in zip(self.sorted, at)])
            new_lo, new_hi = np.minimum(new_lo, lo), np.maximum(new_hi, hi)
            ring = [o[a:b] for o, a, b in zip(self.order, new_lo, lo)] + [o[a:b] for o, a, b in zip(self.order, hi, new_hi)]
            hits += np.bincount(np.concatenate(ring), minlength=n)
            lo, hi = new_lo, new_hi
            fresh = np.flatnonzero((hits >= self.threshold) & ~seen)
            if len(fresh):
                seen[fresh] = True
                ids = np.concatenate([ids, self.ids[fresh]])
                dist = np.concatenate([dist, np.sqrt(((self.x[fresh] - q) ** 2).sum(1))])
                best = np.lexsort((ids, dist))[:k]
                ids, dist = ids[best], dist[best]
            if (len(ids) == k and dist[-1] <= radius) or (lo.max() == 0 and hi.min() == n):
                return ids, dist
            radius *= GROW


def usable(vectors: DataFrame, id_col: str, vec: str) -> DataFrame:
    """(id, v array<double>) of the vectors that take part."""
    v = F.col(f"`{vec}`")
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), v.cast("array<double>").alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.filter(F.col("v").isNotNull() & F.col("id").isNotNull() & ~bad & F.exists("v", lambda x: x != 0))


def _matrix(column: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """dimension -> (row numbers, matrix)."""
    sizes = np.asarray(column.value_lengths())
    flat, ends = np.asarray(column.flatten()), np.cumsum(sizes)
    out = {}
    for dim in np.unique(sizes):
        rows = np.flatnonzero(sizes == dim)
        out[int(dim)] = rows, flat[(ends[rows] - dim)[:, None] + np.arange(dim)]
    return out


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vec: str = "embedding",
            query_block: int = 4096, seed: int = 7) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest found for each query row."""
    spark = vectors.sparkSession
    prepare(spark)
    rows = usable(vectors, id_col, vec)
    asked = stored(usable(queries, id_col, vec).distinct()
                   .withColumn("part", F.xxhash64("id", "v")), "ann-queries")
    blocks = max(1, math.ceil(asked.count() / query_block))
    found = None
    for b in range(blocks):
        # about query_block rows: the part is a hash of distinct rows
        ask = [(r["id"], np.array(r["v"])) for r in asked.filter(F.pmod("part", F.lit(blocks)) == b)
               .orderBy("id", "part").select("id", "v").collect()]
        sent = spark.sparkContext.broadcast(ask)

        def search(batches: Iterator[pa.RecordBatch], sent=sent, b=b) -> Iterator[pa.RecordBatch]:
            def answer(ids: list, columns: list):
                every = np.concatenate([np.asarray(i) for i in ids])
                out = [[], [], [], []]
                for dim, (at, x) in _matrix(pa.concat_arrays(columns)).items():
                    index = Block(every[at], x, seed)
                    for no, (own, q) in enumerate(sent.value):
                        if len(q) == dim:
                            near, dist = index.search(own, q, k)
                            for o, v in zip(out, (np.full(len(near), no), np.full(len(near), own), near, dist)):
                                o.append(v)
                cols = [np.concatenate(o) if o else np.zeros(0) for o in out]
                return pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.float64()))],
                    ["no", "query_id", "vec_id", "score"])

            ids, columns, held = [], [], 0
            for batch in batches:
                if batch.num_rows:
                    ids.append(batch.column(0))
                    columns.append(batch.column(1))
                    held += batch.num_rows
                if held >= BLOCK_ROWS:
                    yield answer(ids, columns)
                    ids, columns, held = [], [], 0
            if held:
                yield answer(ids, columns)

        part = rows.mapInArrow(search, "no long, query_id long, vec_id long, score double").withColumn("part", F.lit(b))
        found = part if found is None else found.unionByName(part)
    order = Window.partitionBy("part", "no", "query_id").orderBy("score", "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
