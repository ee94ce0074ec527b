"""Seed tables from a SQL ``INSERT`` dump, read as data (never executed).

The text source cuts the files into byte ranges, so a large dump, also one INSERT with
very many rows, is read by many tasks. Lines that follow each other in a range are put
into blocks of about ``BLOCK`` bytes. What a line means depends on all lines before it
(is it inside a literal, in a tuple, of which INSERT), so three things are carried over
the blocks as prefix scans, of one small row a block:

* the parity of quotes: whether a block begins inside a literal;
* the depth of parentheses outside literals, which a block sums up for both parities;
* the INSERT header that unit follows, until a ``;`` outside literals ends it.

A piece ends after a ``;`` outside literals and before a line that begins outside
literals and tuples, and a header is looked for where a piece begins. With its state
known a block is cut into pieces on its own; only those at its edges are put together
with their neighbours. The text itself is moved once, to its block's state. Literals may
hold ``;`` and line ends. Comments that hold a quote are not supported.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudmart.session import scratch_path

# Fixed patterns of the dump grammar: INSERT header, one parenthesised tuple,
# one literal (quoted text with '' escapes, or a bare token such as null / 12).
HEADER = r"insert\s+into\s+(\w+)\s*\(([^)]*)\)"
HEADER_RE = rf"(?is)^\s*{HEADER}"
#: The header at a place; only its first word is consumed, so a text that looks like
#: the begin of one hides none.
HEADER_AT = re.compile(rb"(?i)insert(?=\s+into\s+(\w+)\s*\(([^)]*)(\)))")
# Possessive, so that long literals need no regex stack.
QUOTED = r"'(?:[^']++|'')*+'"
TUPLE_RE = rf"\(((?:[^()']++|{QUOTED})*+)\)"
LITERAL_RE = rf"{QUOTED}|[^,\s]++"

BLOCK = 1 << 18  # bytes of a block of lines (a longer line is a block of its own)
BLOCKS = "_file string, _range long, _line long, text string, quotes long, depth_out long, depth_in long"
PIECES = ("_file string, _range long, _line long, _k long, kind string, starts boolean, table string, cols string, "
          "bodies array<string>")

_RANGE = ["_file", "_range"]


def _before(order: str):
    """Rows of a range before a row, and ranges of a file before a range."""
    rows = Window.partitionBy(*_RANGE).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    ranges = Window.partitionBy("_file").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    return rows, ranges


def _sum_before(df: DataFrame, value: str, out: str) -> DataFrame:
    """``out``: the sum of ``value`` over all rows of the file before a row."""
    rows, ranges = _before("_line")
    total = df.groupBy(*_RANGE).agg(F.sum(value).alias("_t"))
    carried = total.select(*_RANGE, F.coalesce(F.sum("_t").over(ranges), F.lit(0)).alias("_carried"))
    own = df.withColumn("_own", F.coalesce(F.sum(value).over(rows), F.lit(0)))
    return own.join(carried, _RANGE).withColumn(out, F.col("_own") + F.col("_carried")).drop("_own", "_carried")


def _last_before(df: DataFrame, value: str, out: str) -> DataFrame:
    """``out``: the last ``value`` that is not NULL, of all rows of the file before a row."""
    rows, ranges = _before("_line")
    last = df.groupBy(*_RANGE).agg(F.max_by(value, F.when(F.col(value).isNotNull(), F.col("_line"))).alias("_t"))
    carried = last.select(*_RANGE, F.last("_t", ignorenulls=True).over(ranges).alias("_carried"))
    own = df.withColumn("_own", F.last(value, ignorenulls=True).over(rows))
    return own.join(carried, _RANGE).withColumn(out, F.coalesce("_own", "_carried")).drop("_own", "_carried")


def _arrow_strings(values: list):
    """An Arrow array of byte strings, as they are (a dump may hold broken UTF-8)."""
    import pyarrow as pa
    made = pa.array(values, pa.binary())
    return pa.Array.from_buffers(pa.string(), len(made), made.buffers(), made.null_count)


def _marks(text: bytes, inside: int):
    """Places of quotes, parentheses, ``;`` and line ends, their bytes, and whether a
    literal is open after each."""
    import numpy as np
    is_mark = np.zeros(256, dtype=bool)
    is_mark[list(b"'();\n")] = True
    codes = np.frombuffer(text, dtype=np.uint8)
    at = np.flatnonzero(is_mark[codes])
    codes = codes[at]
    return at, codes, (np.cumsum(codes == 39) + inside) % 2 == 1


def _blocks(batches):
    """Lines of a task, in their order, as blocks of one byte range each, with their
    quotes and the depth of parentheses they add, begun outside and inside a literal."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc
    for batch in batches:
        n, files, ranges, lines = batch.num_rows, batch["_file"], batch["_range"].to_numpy(), batch["value"]
        if n == 0:
            continue
        ends = np.cumsum(pc.binary_length(lines).to_numpy() + 1, dtype=np.int64) // BLOCK
        cut = (ends[1:] != ends[:-1]) | (ranges[1:] != ranges[:-1])
        cut |= pc.not_equal(files.slice(1), files.slice(0, n - 1)).to_numpy(zero_copy_only=False)
        first = np.concatenate([[0], np.flatnonzero(cut) + 1])
        texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.append(first, n), pa.int32()), lines), "\n")
        sums = []
        for text in texts:
            _, codes, open_ = _marks(text.as_buffer(), 0)
            step = (codes == 40).astype(np.int64) - (codes == 41)
            sums.append((int((codes == 39).sum()), int(step[~open_].sum()), int(step[open_].sum())))
        take = pa.array(first)
        yield pa.RecordBatch.from_arrays([files.take(take), batch["_range"].take(take), batch["_line"].take(take), texts, *[
            pa.array(x, pa.int64()) for x in zip(*sums)]], names=["_file", "_range", "_line", "text", "quotes", "depth_out", "depth_in"])


def _cut_block(text: bytes, inside: int, depth: int) -> list[tuple]:
    """(_k, kind, starts, table, cols, bodies) of a block whose state is known:

    * ``edge``: its first piece (if it goes on from the block before) and its last;
    * ``done``: what follows a header among the others, up to a ``;`` or the next header;
    * ``open``: what comes before the first header and ``;`` of these;
    * ``after``: the header that holds after them ("": none), if they tell it.
    """
    import numpy as np
    starts = not inside and depth <= 0
    if not starts:
        text = b"\n" + text
    at, codes, open_ = _marks(text, inside)
    below = np.cumsum(((codes == 40).astype(np.int64) - (codes == 41)) * ~open_) + depth <= 0
    semi = (codes == 59) & ~open_
    line = (codes == 10) & ~open_ & below
    if not starts:
        line[0] = False  # the line end put before it
    cuts, semis = at[semi | line] + 1, at[semi] + 1
    if not len(cuts):
        return [(0, "edge", starts, None, None, [text])]
    low, high = 0 if starts else int(cuts[0]), int(cuts[-1])
    rows = [] if starts else [(0, "edge", False, None, None, [text[:low]])]
    begins = np.append(low, cuts[cuts > low])  # of the pieces, and the end of the last whole one
    found = [m for m in HEADER_AT.finditer(text, low, high)]
    piece = np.searchsorted(begins, [m.start() for m in found], side="right") - 1
    heads = [(int(begins[p]), m.end(3), m[1].lower(), m[2]) for m, p in zip(found, piece)
             if m.end(3) <= begins[p + 1] and not text[begins[p]:m.start()].strip()]
    semis = semis[semis > low]
    closed = [high, *semis.tolist()][1 if len(semis) else 0]
    first = min(closed, heads[0][0] if heads else high)
    if first > low:
        rows.append((1, "open", True, None, None, [text[low:first]]))
    ends = np.append(semis, high)[np.searchsorted(semis, [h[0] for h in heads], side="right")] if heads else []
    key = None
    for i, (_, begin, table, cols) in enumerate(heads):
        end = min(int(ends[i]), heads[i + 1][0] if i + 1 < len(heads) else high)
        if key != (table, cols):
            key, bodies = (table, cols), []
            rows.append((2, "done", True, table, cols, bodies))
        bodies.append(text[begin:end])
    if heads and not (len(semis) and semis[-1] > heads[-1][0]):
        rows.append((3, "after", True, heads[-1][2], heads[-1][3], []))
    elif len(semis):
        rows.append((3, "after", True, b"", b"", []))
    return [*rows, (4, "edge", True, None, None, [text[high:]])]


def _pieces(batches):
    """The pieces of blocks (``_cut_block``), a batch a block."""
    import numpy as np
    import pyarrow as pa
    for batch in batches:
        for i in range(batch.num_rows):
            rows = _cut_block(batch["text"][i].as_buffer().to_pybytes(), batch["_q"][i].as_py() % 2, batch["_d"][i].as_py())
            k, kind, starts, table, cols, bodies = zip(*rows)
            same = pa.array(np.full(len(rows), i))
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, bodies)]), pa.int32()),
                                             _arrow_strings([x for b in bodies for x in b]))
            yield pa.RecordBatch.from_arrays(
                [*[batch[c].take(same) for c in ("_file", "_range", "_line")], pa.array(k, pa.int64()), pa.array(kind), pa.array(starts),
                 _arrow_strings(table), _arrow_strings(cols), lists],
                names=["_file", "_range", "_line", "_k", "kind", "starts", "table", "cols", "bodies"])


def _kept(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared checkpoint folder and read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dump_units(spark: SparkSession, path) -> DataFrame:
    """(table, cols, bodies): table in lower case and column list of INSERT headers that
    follow each other, and texts of whole tuples that belong to them."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_range"),
        F.monotonically_increasing_id().alias("_line"))
    blocks = _kept(lines.mapInArrow(_blocks, BLOCKS), "dump-blocks")
    state = _sum_before(blocks.drop("text"), "quotes", "_q")
    state = state.withColumn("_depth", F.when(F.col("_q") % 2 == 1, F.col("depth_in")).otherwise(F.col("depth_out")))
    state = _sum_before(state, "_depth", "_d").select(*_RANGE, "_line", "_q", "_d")
    placed = blocks.select(*_RANGE, "_line", "text").join(state, [*_RANGE, "_line"])
    pieces = _kept(placed.mapInArrow(_pieces, PIECES), "dump-pieces")
    ordered = pieces.select(*_RANGE, F.struct("_line", "_k").alias("_line"), "kind", "starts", "table", "cols",
                            F.get("bodies", F.lit(0)).alias("text"))
    # a piece over the edges of blocks: the last of a block and those that go on from it
    edges = _sum_before(ordered.where("kind = 'edge'").withColumn("_new", F.col("starts").cast("long")), "_new", "_u")
    whole = edges.groupBy("_file", (F.col("_u") + F.col("_new")).alias("_piece")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_range", "_line", "text"))), lambda x: x["text"]), "").alias("text"),
        F.min(F.struct("_range", "_line")).alias("_at"))
    table, cols = F.lower(F.regexp_extract("text", HEADER_RE, 1)), F.regexp_extract("text", HEADER_RE, 2)
    head = lambda t, c: F.struct(t.alias("table"), c.alias("cols"))
    own = F.when(table != "", head(table, cols))
    whole = whole.select("_file", F.col("_at._range").alias("_range"), F.col("_at._line").alias("_line"), own.alias("_head"), "text")
    whole = whole.withColumn("_after", F.when(F.col("text").endswith(";"), head(F.lit(""), F.lit(""))).otherwise(F.col("_head")))
    inner = ordered.where("kind in ('open', 'after')").select(
        *_RANGE, "_line", F.lit(None).cast(whole.schema["_head"].dataType).alias("_head"), "text",
        F.when(F.col("kind") == "after", head(F.col("table"), F.col("cols"))).alias("_after"))
    rest = _last_before(whole.unionByName(inner), "_after", "_state").where(F.col("text").isNotNull())
    held = F.coalesce("_head", "_state")
    return pieces.where("kind = 'done'").select("table", "cols", "bodies").unionByName(rest.select(
        held["table"].alias("table"), held["cols"].alias("cols"), F.array(F.regexp_replace("text", HEADER_RE, "")).alias("bodies")).where(
        F.col("table") != ""))


def read_insert_dump(spark: SparkSession, path, table: str, schema: T.StructType) -> DataFrame:
    """Rows of ``table`` in an INSERT dump, typed by ``schema`` (``try_cast``)."""
    return dump_rows(dump_units(spark, path), table, schema)


def dump_rows(units: DataFrame, table: str, schema: T.StructType) -> DataFrame:
    """Rows of ``table`` from the units of a dump."""
    names = F.transform(F.split(F.col("cols"), ","), lambda c: F.lower(F.trim(F.regexp_replace(c, r"\s+", " "))))
    # a unit holds very many tuples: dealt evenly, and its columns are looked up once
    units = units.where(F.col("table") == table.lower()).repartition("cols", "bodies").select(names.alias("names"), "bodies")
    twice = F.size(F.array_distinct("names")) < F.size("names")
    units = units.select("bodies", F.when(twice, F.raise_error(F.concat(F.lit("columns named twice: "), F.array_join("names", ", ")))).otherwise(
        F.size("names")).cast("int").alias("n"), *[F.nullif(F.array_position("names", F.lit(f.name.lower())), F.lit(0)).cast("int").alias(f"p{i}")
                                      for i, f in enumerate(schema.fields)])
    places = [f"p{i}" for i in range(len(schema.fields))]
    # generators, not projections: a projection would be copied to each place that uses it
    values = F.transform(F.regexp_extract_all("body", F.lit(TUPLE_RE), F.lit(1)), lambda t: F.regexp_extract_all(t, F.lit(LITERAL_RE), F.lit(0)))
    rows = units.select("n", *places, F.explode("bodies").alias("body")).select("n", *places, F.explode(values).alias("toks"))
    wrong = F.raise_error(F.concat(F.lit("not one value a column: "), F.array_join("toks", ", ")))
    rows = rows.where(F.when(F.size("toks") == F.col("n"), F.lit(True)).otherwise(wrong))
    return rows.select(*[_literal_expr(F.get("toks", F.col(f"p{i}") - 1)).try_cast(f.dataType).alias(f.name)
                         for i, f in enumerate(schema.fields)])


def _literal_expr(tok: F.Column) -> F.Column:
    inner = F.when(tok.endswith("'"), F.replace(F.substring(tok, F.lit(2), F.char_length(tok) - 2), F.lit("''"), F.lit("'"))).otherwise("")
    return (F.when(F.lower(tok) == "null", F.lit(None).cast("string"))
             .when(tok.startswith("'"), inner).otherwise(tok))
