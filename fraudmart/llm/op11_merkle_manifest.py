"""Merkle manifest of a dataset: a leaf a row, a tree a group, a tree of the trees.

Leaves of a group ascend by the order column; while a level of a tree has more
than one node, every FANOUT consecutive ones (the last run may be shorter) become
the hash of their joined digests. The groups' roots, in the order of their names
(null first, UTF-8 bytewise), make the top tree in the same way.

Per level, fixed-offset lag and lead columns over the runs, masked by slot and run
length, supply each node's siblings, and the row of the first child hashes the
parent. A window holds one run, so at most FANOUT rows, whatever the size of a
group. Dense positions come from one range-partitioned, sorted and stored table and
prefix sums over its parts; texts are hashed before that and never shuffled. Levels
above the leaves are stored tables, an eighth of the one below; proofs go down from
the top, one equi-join of parents and their runs a level.

Cases: null fields are hashed as '-' (see ``framed``); rows with a null order value
come first in their group, rows of a null group make a group of their own; rows of
equal group and order stand in the order of their leaves, equal leaves are
interchangeable; a group of one row is its own root; an empty table gives no rows;
a carried column named like one of the result is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fraudmart.llm.common import prepare, stored

FANOUT = 8
MADE = ("leaf", "position", "path", "subroot", "root")
#: Parts of the sorted leaves that are joined by broadcast, at most (80 bytes each).
PARTS = 1 << 16
_PART = 33  # bits of a row's number within its partition in monotonically_increasing_id
_PATH = "array<struct<left:string,right:string>>"


def digest(value: Column) -> Column:
    """Lowercase hex SHA-256 of a string in UTF-8."""
    return F.sha2(value.cast("binary"), 256)


def framed(*fields: Column) -> Column:
    """Fields as one string that can be read back: '-' for null, else the count of
    UTF-8 bytes, a colon and the value (numbers in decimal)."""
    def one(c: Column) -> Column:
        s = c.cast("string")
        return F.when(c.isNull(), "-").otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))
    return F.concat(*[one(c) for c in fields])


def lower_ascii(text: Column) -> Column:
    """A-Z of a text in lower case, all else as it is."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def positions(rows: DataFrame, order: list[Column]) -> DataFrame:
    """Rows (column ``tree``) with ``pos``, dense from 0 within their tree, and ``n``, its size."""
    tie = rows.withColumn("__tie", F.monotonically_increasing_id())
    by = [F.col("tree"), *order, F.col("__tie")]
    placed = stored(tie.repartitionByRange(*by).sortWithinPartitions(*by)
                    .withColumn("__at", F.monotonically_increasing_id()), "merkle-sorted")
    part = F.shiftright("__at", _PART).alias("__part")
    first = placed.groupBy("tree", part).agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__rows"))
    whole = Window.partitionBy("tree")
    before = whole.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = stored(first.select("tree", "__part", F.sum("__rows").over(whole).alias("n"), (
        F.coalesce(F.sum("__rows").over(before), F.lit(0)) - F.col("__first")).alias("__shift")), "merkle-parts")
    few = parts.limit(PARTS + 1).count() <= PARTS
    out = placed.withColumn("__part", part).join(F.broadcast(parts) if few else parts, ["tree", "__part"])
    return out.withColumn("pos", F.col("__at") + F.col("__shift")).drop("__at", "__part", "__shift", "__tie")


def siblings(nodes: DataFrame) -> DataFrame:
    """Nodes (tree, pos, n, hash) with ``run``, ``slot`` and the joined digests of the
    run's nodes to their ``left`` and ``right``."""
    slot, run = F.col("pos") % FANOUT, F.floor(F.col("pos") / FANOUT)
    cut = nodes.withColumns({"run": run, "slot": slot, "__len": F.least(F.lit(FANOUT), F.col("n") - run * FANOUT)})
    w = Window.partitionBy("tree", "run").orderBy("slot")
    far = range(1, FANOUT)
    lags = {f"__lag{d}": F.when(F.col("slot") >= d, F.lag("hash", d).over(w)).otherwise("") for d in far}
    leads = {f"__lead{d}": F.when(F.col("slot") + d < F.col("__len"), F.lead("hash", d).over(w)).otherwise("") for d in far}
    out = cut.withColumns({**lags, **leads})
    left = F.concat(*[F.col(f"__lag{d}") for d in reversed(far)])
    return out.withColumns({"left": left, "right": F.concat(*[F.col(f"__lead{d}") for d in far])}).drop(
        "__len", *lags, *leads)


def parents(nodes: DataFrame) -> DataFrame:
    """The next level of every tree that has more than one node: the row of the first
    child hashes its run."""
    first = siblings(nodes.filter("n > 1").select("tree", "pos", "n", "hash")).filter("slot = 0")
    return first.select("tree", F.col("run").alias("pos"), F.ceil(F.col("n") / FANOUT).alias("n"),
                        digest(F.concat("hash", "right")).alias("hash"))


def grow(leaves: DataFrame) -> list[DataFrame]:
    """The levels of all trees, leaves first, each above them a stored table."""
    levels, size = [leaves], leaves.agg(F.max("n")).first()[0] or 0
    while size > 1:
        levels.append(stored(parents(levels[-1]), f"merkle-level-{len(levels)}"))
        size = -(-size // FANOUT)
    return levels


def roots(levels: list[DataFrame]) -> DataFrame:
    """(tree, hash): the one node on the last level of each tree."""
    out = None
    for level in levels:
        top = level.filter("n = 1").select("tree", "hash")
        out = top if out is None else out.unionByName(top)
    return out


def proofs(levels: list[DataFrame], above: DataFrame | None = None) -> DataFrame:
    """The rows of the lowest level with ``path``: the siblings of the node and of each
    node above it, on to the top. ``above`` gives each tree (``tree``) the path from
    its root on and further columns."""
    extra = [c for c in above.columns if c not in ("tree", "path")] if above is not None else []
    over = None
    for level in reversed(levels):
        own = [F.col(f"n.`{c}`") for c in level.columns]
        ends = level.filter("n = 1").alias("n")
        if above is None:
            ends = ends.select(*own, F.col("n.hash").alias("apex"), F.array().cast(_PATH).alias("path"))
        else:
            ends = ends.join(above.alias("a"), F.col("n.tree") == F.col("a.tree")).select(
                *own, F.col("n.hash").alias("apex"), "a.path", *[f"a.{c}" for c in extra])
        if over is None:
            over = ends
            continue
        step = F.array(F.struct("n.left", "n.right"))
        up = over.select("tree", F.col("pos").alias("run"), "apex", "path", *extra).alias("p")
        inner = siblings(level.filter("n > 1")).alias("n").join(
            up, (F.col("n.tree") == F.col("p.tree")) & (F.col("n.run") == F.col("p.run")))
        over = inner.select(*own, "p.apex", F.concat(step, F.col("p.path")).alias("path"),
                            *[f"p.{c}" for c in extra]).unionByName(ends)
    return over


def build(docs: DataFrame, fields: list[str], group: str, order: str, keep: list[str] = (),
          carry: dict[str, Column] | None = None) -> DataFrame:
    """The manifest: ``keep`` columns and ``carry`` expressions of each row with its
    ``leaf`` (hash of ``fields``), ``position`` in its group, ``path`` (an array of
    the joined digests left and right of the node, from the leaf's run to the top
    one), ``subroot`` (its group's root) and ``root``."""
    prepare(docs.sparkSession)
    col = lambda c: F.col(f"`{c}`")
    name = F.when(col(group).isNull(), "").otherwise(F.concat(F.lit("="), col(group).cast("string")))
    carried = F.struct(*[col(c).alias(c) for c in keep if c not in MADE], *[e.alias(c) for c, e in (carry or {}).items()],
                       F.lit(1).alias("__one"))
    hashed = stored(docs.select(name.alias("tree"), col(order).alias("__order"), carried.alias("__row"),
                                digest(framed(*[col(c) for c in fields])).alias("hash")), "merkle-leaves")
    leaves = positions(hashed, [F.col("__order"), F.col("hash")]).drop("__order")
    levels = grow(leaves)
    ends = roots(levels).select(F.col("tree").alias("group"), F.lit("").alias("tree"), "hash")
    tops = grow(positions(ends, [F.col("group")]))
    above = stored(proofs(tops).select(F.col("group").alias("tree"), "path", F.col("apex").alias("root")), "merkle-tops")
    names = [c for c in hashed.schema["__row"].dataType.fieldNames() if c != "__one"]
    return proofs(levels, above).select(*[F.col(f"__row.`{c}`") for c in names], F.col("hash").alias("leaf"),
                                        F.col("pos").alias("position"), "path", F.col("apex").alias("subroot"), "root")


def joined(path: Column) -> Column:
    """All sibling digests of a path, level by level, left to right."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf gives with the siblings of a path."""
    return F.aggregate(path, leaf, lambda acc, s: digest(F.concat(s["left"], acc, s["right"])))
