"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document; the ledger keeps the measurements
and one bit per failed rule, and is stored. A policy is a named, versioned set of
rules: it is applied to the stored bits (``bits & mask = 0`` keeps), so a new policy
or an ablation never reads the texts again. Ablations first count the documents of
each distinct bitmask (at most 2^rules rows), then take the rules' bits from those.

Cases: a null text counts as empty (no words: fails ``few_words``); an empty
table gives an empty ledger; repeated rows are judged one by one; columns of
the input are kept, and the ledger's columns replace any of the same name.
Texts are measured whole; a long text is one row of one task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudmart.llm.common import stored

SPACES = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
UPPER = bytes(range(65, 91))
LOWER = bytes(range(97, 123))
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "n_lines", "n_upper", "n_letters", "n_top2", "n_top3", "n_top4", "n_stop", "n_bullets", "n_ellipses", "line_bytes"]
# fixed values: frequent words of the languages, and signs that lists and cut lines show
STOP_WORDS = frozenset(w.encode() for w in (
    "the of and to in is that for with as on are be this or an by it from at "
    "der die das und ist von den zu mit ein eine auf nicht im für "
    "el la los las de y que en un una es por con para se del "
    "le les des et est une dans que pour qui sur au pas ce plus").split())
BULLETS = ("-", "*", "\u2022", "\u2023", "\u25e6", "\u00b7")
ELLIPSES = ("...", "\u2026")

#: name -> condition that FAILS, over the measurements; the bit is the position.
RULES: list[tuple[str, str]] = [
    ("few_words", "n_words < 10"),
    ("repeated_words", "100 * n_repeat_words > 20 * n_words"),
    ("symbols", "10 * n_symbols > 3 * n_words"),
    ("repeated_lines", "n_lines >= 4 AND 10 * n_dup_lines > 3 * n_lines"),
    ("word_length", "word_chars < 2 * n_words OR word_chars > 20 * n_words"),
    ("shouting", "n_letters >= 40 AND 10 * n_upper > 3 * n_letters"),
    ("top_bigram", "n_words >= 20 AND 10 * n_top2 > 3 * n_words"),
    ("top_trigram", "n_words >= 20 AND 100 * n_top3 > 28 * n_words"),
    ("top_fourgram", "n_words >= 20 AND 100 * n_top4 > 26 * n_words"),
    ("no_stop_words", "n_words >= 50 AND n_stop < 2"),
    ("bullets", "n_lines >= 4 AND 10 * n_bullets > 9 * n_lines"),
    ("ellipses", "n_lines >= 4 AND 10 * n_ellipses > 3 * n_lines"),
    ("short_lines", "n_lines >= 10 AND line_bytes < 8 * n_lines"),
]
#: Versioned policies: the rules whose failure rejects a document.
POLICIES: dict[str, list[str]] = {
    "base-1": ["few_words", "repeated_words"],
    "web-1": ["few_words", "repeated_words", "symbols", "repeated_lines", "word_length", "shouting"],
    "web-2": [name for name, _ in RULES],
}


def mask_of(policy: str | list[str]) -> int:
    names = [n for n, _ in RULES]
    return sum(1 << names.index(r) for r in (POLICIES[policy] if isinstance(policy, str) else policy))


def repeated_words(ids: np.ndarray, width: int = 5) -> tuple[int, ...]:
    """Words lying in a window of ``width`` words that occurs twice or more, and the
    words of the most frequent runs of 2 to width - 1 words (0: none occurs twice).

    Windows get exact ranks by doubling pairs (no hash collisions)."""
    n = len(ids)
    if n <= width:
        return (0,) * (width - 1)
    rank, top = ids.astype(np.int64), []
    for step in range(1, width):
        head = rank[:-1]
        pair = head * (n + 1) + ids[step:step + len(head)]
        _, rank, times = np.unique(pair, return_inverse=True, return_counts=True)
        most = int(times.max())
        top.append(min(n, most * (step + 1)) if most > 1 else 0)
    hot = times[rank] > 1
    edge = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(hot)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + width, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum()), *top[:-1]


def measure(text: str | None) -> tuple[int, ...]:
    """The measurements of one whole text, in the order of MEASURES."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # exactly the runs of bytes outside \x20 and \x09-\x0D
    lines = [x for x in raw.split(b"\n") if x.strip(SPACES)]
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    count = lambda chars: len(raw) - len(raw.translate(None, chars))
    n_upper = count(UPPER)
    bare = [x.strip(SPACES) for x in lines]
    repeats = repeated_words(ids) if len(seen) < len(words) else (0,) * 4
    return (len(words), len(text) - count(SPACES), count(SYMBOLS), len(lines) - len(set(lines)),
            repeats[0], len(lines), n_upper, n_upper + count(LOWER), *repeats[1:],
            sum(w.lower() in STOP_WORDS for w in words), sum(x.startswith(_BULLETS) for x in bare),
            sum(x.endswith(_ELLIPSES) for x in bare), sum(map(len, bare)))


_BULLETS, _ELLIPSES = (tuple(x.encode() for x in xs) for xs in (BULLETS, ELLIPSES))


def measures_of(text: Column) -> Column:
    """Struct of the measurements of a text column (Arrow batches)."""
    names = MEASURES

    @F.arrow_udf("struct<" + ",".join(f"{m}:bigint" for m in names) + ">")
    def run(texts: pa.Array) -> pa.Array:
        rows = [measure(t) for t in texts.to_pylist()]
        columns = list(zip(*rows)) if rows else [()] * len(names)
        return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    return run.asNondeterministic()(text)  # so that later filters don't evaluate it again


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """Input columns, the measurements, and ``rule_bits`` (bit i: RULES[i] failed)."""
    made = {*MEASURES, "rule_bits", "__m"}
    kept = [c for c in docs.columns if c not in made or c == text]
    base = docs.select(*[F.col(f"`{c}`") for c in kept], measures_of(F.col(f"`{text}`")).alias("__m"))
    flat = base.select(*[F.col(f"`{c}`") for c in kept], *[F.col(f"__m.{m}").alias(m) for m in MEASURES])
    bits = sum(F.when(F.expr(fails), F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long"))
               for i, (_, fails) in enumerate(RULES))
    return flat.withColumn("rule_bits", bits)


def verdict(policy: str) -> Column:
    """True where the stored bits pass a policy."""
    return F.col("rule_bits").bitwiseAND(F.lit(mask_of(policy)).cast("long")) == 0


def ablations(entries: DataFrame, policy: str) -> DataFrame:
    """Per rule, from the bits alone: how many documents fail it, how many it alone
    rejects (would be kept without it; 0 for a rule outside the policy), how many the
    policy keeps and how many of those the rule, were it added, would reject."""
    mask = F.lit(mask_of(policy)).cast("long")
    masks = entries.groupBy("rule_bits").agg(F.count("*").alias("n"))
    n, bits = F.col("n"), F.col("rule_bits")
    masked = bits.bitwiseAND(mask)
    count = lambda hit: F.when(hit, n).otherwise(0)
    per_rule = F.array(*[F.struct(
        F.lit(name).alias("rule"),
        count(bits.bitwiseAND(F.lit(1 << i).cast("long")) != 0).alias("f"),
        count(masked == (1 << i)).alias("o"),
        count(masked == 0).alias("k"),
        count((masked == 0) & (bits.bitwiseAND(F.lit(1 << i).cast("long")) != 0)).alias("a")) for i, (name, _) in enumerate(RULES)])
    return (masks.select(F.explode(per_rule).alias("r")).groupBy(F.col("r.rule").alias("rule"))
            .agg(F.sum("r.f").alias("n_failed"), F.sum("r.o").alias("n_only"), F.sum("r.k").alias("n_kept"),
                 F.sum("r.a").alias("n_added")))


def stored_ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """The ledger without the texts, written to the shared folder and read back."""
    return stored(ledger(docs, text).drop(text), "quality-ledger")


def with_sole_rule(entries: DataFrame, policy: str) -> DataFrame:
    """The ledger with ``sole_rule``, the one rule of the policy that rejects a document
    (null: none or several), and ``sole_rule_docs``, how many documents that rule alone rejects."""
    masked = F.col("rule_bits").bitwiseAND(F.lit(mask_of(policy)).cast("long"))
    sole = F.coalesce(*[F.when(masked == (1 << i), F.lit(name)) for i, (name, _) in enumerate(RULES)])
    # a row a rule
    costs = ablations(entries, policy).select(F.col("rule").alias("sole_rule"), F.col("n_only").alias("sole_rule_docs"))
    return entries.withColumn("sole_rule", sole).join(F.broadcast(costs), "sole_rule", "left")
