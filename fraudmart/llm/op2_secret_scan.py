r"""Secret scans: fixed patterns plus a battery of randomness tests, in DataFrame
functions only.

Patterns (kinds ``assign``, ``access``, ``hex``) give the base spans. Every other
long token that no base span touches is tested. Its encoding (hex, base32,
base36, base62, base64) is inferred from its characters, and gives the alphabet
size k. Two hypotheses are then tested:

* it is random in that encoding: chi-squared uniformity (through its collision
  count, whose mean n(n-1)/2k is exact at every length), runs above/below the
  middle of the alphabet, and lag-1 serial correlation, joined by Fisher's
  method; a token that fails this is no key;
* it is ordinary text, names of words joined by signs or capitals included: too few
  collisions for a language (index of coincidence, its spread calibrated by length)
  and too many runs of character classes, joined likewise. Those p-values go
  through Benjamini-Hochberg per (encoding, length octave), over all tokens of
  the corpus: lengths at which the tests have no power find nothing.

A token that is not rejected by the first and discovered by the second is a span
of kind ``random``. The p-values are ranked on a fixed grid (tenths of -log10),
so the control needs one bounded count table and no global sort.

Spans are code points, end exclusive. Cases: a null text is an empty one (no
spans, digest of the empty string); repeated rows are scanned one by one; an
empty table gives no rows; columns of the input named like the result are
replaced. Long texts are scanned whole; running offsets are built in blocks, so
many matches in one text stay near linear.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fraudmart.llm.common import prepare, stored

KINDS = ["assign", "access", "hex", "random"]
# fixed patterns of the base spans
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}+"  # the runs of AKIA[A-Z0-9]+ with 20 characters or more
HEX = r"[0-9a-f]{24,}+"  # a run cannot start inside another
TOKEN = r"[A-Za-z0-9+/_-]{20,}+={0,2}"
ALPHABET = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/-_"
TEXT_COLLISION = 0.06  # index of coincidence of European languages, words joined by capitals
TEXT_SPREAD = 0.036  # growth of its variance with the length, 2 (s3 - s2^2) / (s2 - s2^2) of letter shares' powers
TEXT_SWITCH = 0.3  # changes of character class per character in names of words (two a word)
RANDOM_LEVEL = 0.005  # a random token fails the battery this often
FDR = 0.01
GRID, TOP = 10, 300  # tenths of -log10 p, up to 1e-30
BLOCK = 256


def running_starts(lengths: Column) -> Column:
    """Exclusive running sums of an array of longs, in blocks of BLOCK."""
    n_blocks = F.ceil(F.size(lengths) / F.lit(BLOCK)).cast("int")
    blocks = F.when(F.size(lengths) > 0, F.transform(
        F.sequence(F.lit(0), n_blocks - 1), lambda b: F.slice(lengths, b * BLOCK + 1, BLOCK)))
    step = lambda s, x: F.struct((s["at"] + x).alias("at"), F.array_append(s["out"], s["at"]).alias("out"))
    scan = lambda xs, start: F.aggregate(
        xs, F.struct(start.alias("at"), F.array().cast("array<bigint>").alias("out")), step)["out"]
    zero = F.lit(0).cast("bigint")
    sums = F.transform(blocks, lambda b: F.aggregate(b, zero, lambda s, x: s + x))
    return F.coalesce(F.flatten(F.transform(F.arrays_zip(blocks.alias("b"), scan(sums, zero).alias("s")),
                                            lambda z: scan(z["b"], z["s"]))), F.array().cast("array<bigint>"))


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """array<struct<start, end, body>> of the leftmost non-overlapping matches;
    ``body`` is the given group."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)  # one more than matches
    steps = F.zip_with(F.slice(gaps, 1, F.size(whole)), whole,
                       lambda g, m: (F.char_length(g) + F.char_length(m)).cast("bigint"))
    body = whole if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    parts = F.arrays_zip(running_starts(steps).alias("at"), gaps.alias("gap"), whole.alias("whole"), body.alias("body"))
    found = F.when(F.size(whole) > 0, F.transform(
        F.slice(parts, 1, F.size(whole)),
        lambda x: F.struct((x["at"] + F.char_length(x["gap"])).alias("start"),
                           (x["at"] + F.char_length(x["gap"]) + F.char_length(x["whole"])).alias("end"),
                           x["body"].alias("body"))))
    return F.coalesce(found, F.array().cast("array<struct<start:bigint,end:bigint,body:string>>"))


def _named(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that it names many times: the plan holds the value once, where
    a column put in by itself is copied at each place."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _tail(z: Column) -> Column:
    """Upper tail of the normal distribution, within 0.4 % at any z above -2: a logistic form
    in the middle, beyond 2 the continued fraction of the Mills ratio (exact in the limit)."""

    def of(z: Column) -> Column:
        middle = 1 / (1 + F.exp(1.5976 * z + 0.07056 * z * z * z))
        far = F.greatest(z, F.lit(2.0))
        ratio = far
        for i in range(12, 0, -1):
            ratio = far + i / ratio
        density = F.exp(-z * z / 2) / F.lit((2 * math.pi) ** 0.5)
        return F.greatest(F.when(z > 2, density / ratio).otherwise(middle), F.lit(1e-40))

    return _named(z, of)


def _counts(body: Column) -> Column:
    """Struct of what the tests need of one token (padding stripped)."""
    n = F.char_length(body).cast("double")
    symbols = F.array(*[F.lit(c) for c in ALPHABET])
    pairs = F.aggregate(symbols, F.lit(0.0), lambda s, c: s + _named(
        n - F.char_length(F.replace(body, c, F.lit(""))), lambda m: m * (m - 1) / 2))
    is_ = lambda p: body.rlike(p)
    encoding = (F.when(is_("^([0-9a-f]+|[0-9A-F]+)$"), "hex").when(is_("^[A-Z2-7]+$"), "base32")
                .when(is_("^([a-z0-9]+|[A-Z0-9]+)$"), "base36").when(is_("^[A-Za-z0-9]+$"), "base62")
                .otherwise("base64"))
    switches = F.char_length(F.regexp_replace(body, "[a-z]+|[A-Z]+|[0-9]+|[^a-zA-Z0-9]+", "x")) - 1
    values = F.transform(F.filter(F.split(body, "", -1), lambda c: c != ""),
                         lambda c: (F.instr(F.lit(ALPHABET), c) - 1).cast("double"))
    return F.struct(n.alias("n"), pairs.alias("pairs"), encoding.alias("encoding"),
                    switches.cast("double").alias("switches"), values.alias("values"))


def _battery(x: Column) -> Column:
    """Struct (encoding, octave, random, bin) from the counts of one token."""
    n, pairs, enc, values = x["n"], x["pairs"], x["encoding"], x["values"]
    k = F.when(enc == "hex", 16.0).when(enc == "base32", 32.0).when(enc == "base36", 36.0).when(enc == "base62", 62.0).otherwise(64.0)
    root = lambda c: F.sqrt(c + 0.375)  # noqa: E731  evens out the variance of counts
    expect = n * (n - 1) / 2
    p_uniform = _tail(2 * (root(pairs) - root(expect / k)))

    def serial(mean: Column) -> Column:
        square = F.aggregate(values, F.lit(0.0), lambda s, v: s + (v - mean) * (v - mean))
        cross = F.aggregate(F.zip_with(F.slice(values, 1, F.size(values) - 1), F.slice(values, 2, F.size(values)),
                                       lambda a, b: (a - mean) * (b - mean)), F.lit(0.0), lambda s, v: s + v)
        r = _named(square, lambda q: F.when(q > 0, cross / q).otherwise(1.0))
        return F.least(2 * _tail(F.abs((r + 1 / n) * F.sqrt(n))), F.lit(1.0))

    def runs(mean: Column) -> Column:
        high = F.array_join(F.transform(values, lambda v: F.when(v >= mean, "1").otherwise("0")), "")
        return _named(high, lambda h: F.struct(F.char_length(F.replace(h, F.lit("0"), F.lit(""))).cast("double").alias("n1"),
                                               F.char_length(F.regexp_replace(h, "0+|1+", "x")).alias("runs")))

    def p_of_runs(y: Column) -> Column:
        return _named(1 + 2 * y["n1"] * (n - y["n1"]) / n, lambda mu: _named(
            (mu - 1) * (mu - 2) / (n - 1), lambda var: F.when(
                var > 0, F.least(2 * _tail(F.abs((y["runs"] - mu) / F.sqrt(var))), F.lit(1.0))).otherwise(1e-6)))

    mean = F.aggregate(values, F.lit(0.0), lambda s, v: s + v) / n
    p_order = _named(mean, lambda m: F.struct(serial(m).alias("serial"), _named(runs(m), p_of_runs).alias("runs")))
    # half the statistic, 6 degrees
    p_random = _named(_named(p_order, lambda p: -(F.log(p_uniform) + F.log(p["runs"]) + F.log(p["serial"]))),
                      lambda fisher: F.exp(-fisher) * (1 + fisher + fisher * fisher / 2))
    p_language = _tail(2 * (root(expect * TEXT_COLLISION) - root(pairs)) / F.sqrt(1 + TEXT_SPREAD * (n - 2)))
    p_class = _tail(2 * (root(x["switches"]) - root((n - 1) * TEXT_SWITCH)))
    # 4 degrees
    grid = _named(-(F.log(p_language) + F.log(p_class)),
                  lambda half: F.floor(GRID * (half - F.log1p(half)) / F.log(F.lit(10.0))))
    return F.struct(enc.alias("encoding"), F.floor(F.log2(n)).cast("int").alias("octave"),
                    (p_random >= RANDOM_LEVEL).alias("random"),
                    F.greatest(F.lit(0), F.least(F.lit(TOP), grid)).cast("int").alias("bin"))


def _base(text: Column) -> Column:
    kind = lambda no, found: F.transform(found, lambda m: F.struct(
        m["start"].alias("start"), F.lit(no).alias("kind"), m["end"].alias("end")))
    assign = F.filter(matches(text, ASSIGN, 2), lambda m: F.char_length(m["body"]) >= 6)
    return F.array_sort(F.concat(kind(0, assign), kind(1, matches(text, ACCESS)), kind(2, matches(text, HEX))))


def scan(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default: all but the text) with ``base`` and ``spans``:
    arrays of (start, kind number, end), in order."""
    spark = docs.sparkSession
    prepare(spark)
    keep = [c for c in docs.columns if c != text] if keep is None else keep
    keep = [c for c in keep if c not in ("base", "spans")]
    source = docs.select(F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("__text"),
                         F.struct(*[F.col(f"`{c}`") for c in keep], F.lit(1).alias("__row")).alias("__keep"))
    first = source.select("__keep", _base(F.col("__text")).alias("base"),
                          matches(F.col("__text"), TOKEN).alias("tokens"))
    free = F.filter("tokens", lambda t: ~F.exists("base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
    stripped = F.transform(free, lambda t: F.struct(
        t["start"].alias("start"), t["end"].alias("end"), F.rtrim(t["body"], F.lit("=")).alias("body")))
    tested = F.transform(F.transform(stripped, lambda t: F.struct(
        t["start"].alias("start"), t["end"].alias("end"), _counts(t["body"]).alias("x"))),
        lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"), _battery(t["x"]).alias("y")))
    first = stored(first.select("__keep", "base", tested.alias("tested")), "secret-scan")
    cut = cutoffs(first.select(F.explode("tested.y").alias("y")).select("y.*"))
    # at most 5 encodings x 31 octaves
    limits = {(r["encoding"], r["octave"]): r["bin"] for r in cut.collect()}
    table = F.create_map(*[F.lit(v) for (e, o), b in limits.items() for v in (f"{e}/{o}", b)]) if limits \
        else F.create_map().cast("map<string,int>")
    found = F.filter("tested", lambda t: t["y"]["random"] & F.coalesce(
        t["y"]["bin"] >= F.element_at(table, F.concat_ws("/", t["y"]["encoding"], t["y"]["octave"].cast("string"))),
        F.lit(False)))
    random = F.transform(found, lambda t: F.struct(t["start"].alias("start"), F.lit(3).alias("kind"), t["end"].alias("end")))
    return first.select(*[F.col(f"__keep.`{c}`").alias(c) for c in keep], "base",
                        F.array_sort(F.concat("base", random)).alias("spans"))


def cutoffs(tests: DataFrame, level: float = FDR) -> DataFrame:
    """Benjamini-Hochberg on the grid: per (encoding, octave), the smallest bin whose
    tokens are discovered."""
    counts = tests.groupBy("encoding", "octave", "bin").agg(F.count("*").alias("n"))
    whole = Window.partitionBy("encoding", "octave")  # at most TOP + 1 rows each
    ranked = counts.select("*", F.sum("n").over(whole).alias("m"),
                           F.sum("n").over(whole.orderBy(F.desc("bin"))).alias("at_least"))
    ok = F.pow(F.lit(10.0), -F.col("bin") / GRID) * F.col("m") <= level * F.col("at_least")
    return ranked.filter(ok).groupBy("encoding", "octave").agg(F.min("bin").alias("bin"))


def as_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span replaced (touching and nested ones once)."""
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

    def step(s: Column, x: Column) -> Column:
        gap = F.substring(text, (s["at"] + 1).cast("int"), (x["start"] - s["at"]).cast("int"))
        out = F.when(x["start"] >= s["at"], F.concat(s["out"], gap, F.lit(mark))).otherwise(s["out"])
        return F.struct(F.greatest(s["at"], x["end"]).alias("at"), out.alias("out"))

    done = F.aggregate(spans, start, step, lambda s: F.concat(
        s["out"], F.substring(text, (s["at"] + 1).cast("int"), F.lit(2**31 - 1))))
    return F.when(F.size(spans) > 0, done).otherwise(text)
