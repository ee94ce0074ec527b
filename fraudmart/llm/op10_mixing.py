"""Mixing to target weights with soft domain membership.

A softmax classifier is fitted on a bounded sample of the labelled table and
predicts for every document its posterior over domains. Rates r >= 0 (expected
copies of a document) are then fitted so that the expected token totals
sum_i r_i n_i p_ik match the targets: accelerated projected gradient on the
least squares, in variables scaled by sqrt(n_i) and with each domain's residual
weighed by its own Gram entry, until every domain has met its target or rests.
The gradient of a document depends only on the K residuals, so one round is one
pass that sums a few totals a domain; rates are a fold over the list of past
residuals and are never shuffled.

Cases: a null or blank text has no tokens and uniform features (its rate stays
at the start value); rows of the label table with null labels, and labelled ids
without a document, are not used; a document with several label rows counts once
per distinct domain; with no labelled rows all posteriors are equal; repeated
rows are weighed one by one; an empty table gives no rows; columns of the input
named like the result are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudmart.llm.common import prepare, stored

SHAPES = 6
STEM = 4  # leading bytes of a word
SAMPLE = 8192  # labelled documents that the classifier is fitted on, at most
NAMES = 1 << 16  # words and stems of the fitted model, at most
ROWS = 1 << 14  # narrow rows of one task and Arrow batch in a round of the gradient
PIECE = 1 << 22  # bytes of text whose word shapes are counted at once

# Kinds of bytes; white space is none. Bytes beyond ASCII count as lower case.
LOWER, UPPER, DIGIT, SYMBOL, BANG, OTHER = (1 << i for i in range(6))
KINDS = np.array([
    0 if c in b" \t\n\r\v\f" else LOWER if c > 127 or c == ord("_") or chr(c).islower() else UPPER if chr(c).isupper()
    else DIGIT if chr(c).isdigit() else SYMBOL if c in b"#*$%&|<>" else BANG if c == ord("!") else OTHER
    for c in range(256)], np.uint8)
NOT_CORE = bytes(c for c in range(128) if KINDS[c] >= SYMBOL)
SMALL = bytes(range(256)).lower()


def cores(text: bytes) -> set[bytes]:
    """Distinct words in lower case, without ASCII punctuation."""
    return set(text.translate(SMALL, NOT_CORE).split())


def shapes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Per text, its words and their shares of the shapes: no core, symbols, capitals,
    digits, exclamation, other."""
    n, share = np.zeros(len(texts), np.int64), np.zeros((len(texts), SHAPES))
    first = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= PIECE or i == len(texts) - 1:
            n[first:i + 1], share[first:i + 1] = _shapes(texts[first:i + 1])
            first, size = i + 1, 0
    return n, share


def _shapes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    kind = KINDS[np.frombuffer(b" ".join(texts) + b" ", np.uint8)]
    edge = np.diff((kind > 0).astype(np.int8), prepend=np.int8(0))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(start):
        return np.zeros(len(texts), np.int64), np.zeros((len(texts), SHAPES))
    bits = np.bitwise_or.reduceat(kind, start)
    shape = np.select([bits & (LOWER | UPPER | DIGIT) == 0, bits & SYMBOL > 0,
                       (bits & (LOWER | UPPER) == UPPER) & (end - start > 1), bits & DIGIT > 0, kind[end - 1] == BANG],
                      [0, 1, 2, 3, 4], 5)
    doc = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), start, side="right")
    counts = np.bincount(doc * SHAPES + shape, minlength=len(texts) * SHAPES).reshape(-1, SHAPES)
    n = counts.sum(1)
    return n, counts / np.maximum(1, n)[:, None]


def _bytes(texts: pa.Array) -> list[bytes]:
    return [t or b"" for t in texts.cast(pa.large_binary()).to_pylist()]


class Softmax:
    """Multinomial logistic regression over named words and stems and shape shares."""

    def __init__(self, domains: int, names: list[str] = ()):
        self.w = np.zeros((len(names), domains))
        self.s = np.zeros((SHAPES, domains))
        self.b = np.zeros(domains)
        self.place = {name: i for i, name in enumerate(names)}
        self.words = {name.encode(): i for i, name in enumerate(names) if name[0] != "^"}
        self.stems = {name[1:].encode(): i for i, name in enumerate(names) if name[0] == "^"}
        self.word_set, self.stem_set = set(self.words), set(self.stems)

    def named(self, text: bytes) -> list[int]:
        """Places of the model's words and stems that are in the text."""
        own = cores(text)
        return sorted([self.words[x] for x in own & self.word_set]
                      + [self.stems[x] for x in {x[:STEM] for x in own} & self.stem_set])

    def posterior(self, found: np.ndarray, shares: np.ndarray) -> np.ndarray:
        z = self.w[found].sum(axis=0) + 10 * shares @ self.s + self.b
        e = np.exp(z - z.max())
        return e / e.sum()

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray, int]], rounds: int = 150, rate: float = 0.3,
            penalty: float = 1e-4) -> Softmax:
        """Full-batch AdaGrad over (found, shares, domain) rows."""
        if not rows:
            return self
        y, n, k = np.array([r[2] for r in rows]), len(rows), self.b.size
        flat = np.concatenate([np.asarray(r[0], np.int64) for r in rows])
        at = np.repeat(np.arange(n), [len(r[0]) for r in rows])
        share = 10 * np.array([r[1] for r in rows])
        self.b = np.log(np.bincount(y, minlength=k) + 1.0) - np.log(n + k)
        gw, gs, gb = 1e-8, 1e-8, 1e-8
        for _ in range(rounds):
            z = np.stack([np.bincount(at, self.w[flat, j], n) for j in range(k)], 1) + share @ self.s + self.b
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(n), y] -= 1
            p /= n
            dw = np.stack([np.bincount(flat, p[at, j], len(self.w)) for j in range(k)], 1) + penalty * self.w
            ds, db = share.T @ p + penalty * self.s, p.sum(0)
            gw, gs, gb = gw + dw * dw, gs + ds * ds, gb + db * db
            self.w -= rate * dw / np.sqrt(gw)
            self.s -= rate * ds / np.sqrt(gs)
            self.b -= rate * db / np.sqrt(gb)
        return self


def telling_names(sample: DataFrame, domains: int, least: int = 5, telling: float = 30.0,
                  most: int = NAMES) -> list[str]:
    """Words and stems in ``least`` rows of the sample or more that depend on the domain
    (chi-squared above ``telling``; the ``most`` highest)."""
    here = [F.count_if(F.col("__y") == j + 1).alias(f"c{j}") for j in range(domains)]
    size = [x or 0 for x in sample.agg(*here).first()]
    if not sum(size):
        return []
    n = float(sum(size))
    seen = sample.select("__y", F.explode("f.names").alias("name")).groupBy("name").agg(
        F.count(F.lit(1)).cast("double").alias("df"), *here).filter(F.col("df") >= least)
    chi = F.lit(0.0)
    for j in range(domains):
        expect = F.greatest(F.col("df") * F.lit(size[j] / n), F.lit(1e-9))
        chi = chi + (F.col(f"c{j}") - expect) * (F.col(f"c{j}") - expect) / expect
    chi = chi / F.greatest(1 - F.col("df") / n, F.lit(1 / n))
    picked = seen.select("name", chi.alias("chi")).filter(F.col("chi") > telling).orderBy(F.desc("chi"), "name")
    return [r["name"] for r in picked.limit(most).collect()]


def fit_classifier(docs: DataFrame, labels: DataFrame, domains: list[str], id_col: str = "doc_id",
                   text: str = "text", domain: str = "domain", sample: int = SAMPLE) -> Softmax:
    """Fit on the ``sample`` labelled documents with the smallest hashed ids."""
    named = labels.select(F.col(id_col).alias("__id"), F.array_position(
        F.array(*[F.lit(d) for d in domains]), F.col(domain)).alias("__y"))
    picked = (named.filter("__id is not null and __y > 0").distinct()
              .orderBy(F.xxhash64("__id"), "__id", "__y").limit(sample))
    # the sample's bound makes this side small at every size
    rows = docs.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text}`").alias("t")).join(
        F.broadcast(stored(picked, "mix-sample")), "__id")

    @F.arrow_udf("struct<names:array<string>,shares:array<double>>")
    def sampled(texts: pa.Array) -> pa.Array:
        raw = _bytes(texts)
        names = []
        for t in raw:
            own = cores(t)
            # a stem that cuts a character has no name
            every = [x.decode("utf-8", "ignore") for x in own] + ["^" + x.decode() for x in {x[:STEM] for x in own} if _whole(x)]
            names.append(every)
        return pa.StructArray.from_arrays([pa.array(names, pa.list_(pa.string())),
                                           pa.array(shapes(raw)[1].tolist(), pa.list_(pa.float64()))], ["names", "shares"])

    seen = stored(rows.select("__id", "__y", sampled.asNondeterministic()("t").alias("f")), "mix-features")
    model = Softmax(len(domains), telling_names(seen, len(domains)))
    place = model.place

    @F.arrow_udf("array<int>")
    def found(names: pa.Array) -> pa.Array:
        return pa.array([sorted(place[x] for x in own if x in place) for own in names.to_pylist()], pa.list_(pa.int32()))

    # repeated document rows: the limit bounds what comes to the driver
    got = (seen.select("__id", "__y", found("f.names").alias("found"), "f.shares")
           .orderBy(F.xxhash64("__id"), "__id", "__y").limit(sample).collect())
    return model.fit([(r["found"], r["shares"], r["__y"] - 1) for r in got])


def _whole(x: bytes) -> bool:
    try:
        x.decode()
    except UnicodeDecodeError:
        return False
    return True


def posteriors(docs: DataFrame, model: Softmax, text: str = "text") -> DataFrame:
    """Input columns with ``n_tokens`` and ``posterior`` (array, domain order)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # NAMES rows, at most

    @F.arrow_udf("struct<n_tokens:bigint,posterior:array<double>>")
    def predict(texts: pa.Array) -> pa.Array:
        m, raw = sent.value, _bytes(texts)
        n, share = shapes(raw)
        p = [m.posterior(m.named(t), x) for t, x in zip(raw, share)]
        return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(p, pa.list_(pa.float64()))],
                                          ["n_tokens", "posterior"])

    kept = [c for c in docs.columns if c not in ("n_tokens", "posterior", "__p") or c == text]
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], predict.asNondeterministic()(F.col(f"`{text}`")).alias("__p"))
    return rows.select(*[F.col(f"`{c}`") for c in kept], "__p.n_tokens", "__p.posterior")


def fit_rates(members: DataFrame, targets: list[float], start: float = 1.0, most: float | None = None,
              rounds: int | None = None, close: float = 1e-4) -> list[tuple[float, np.ndarray]]:
    """The rounds of the projected gradient, each one pass over (n_tokens, posterior), until every
    domain's total is met or no domain's tokens move (targets out of reach), each measured by the
    domain's own target, or by its present total where it is to go; ``rounds`` ends it earlier."""
    k, goal = len(targets), np.array(targets, float)

    p = [F.get("posterior", F.lit(j)) for j in range(k)]
    n = F.col("n_tokens").cast("double")
    *sums, rows = members.agg(*[F.sum(n * p[i] * p[j]).alias(f"g{i}_{j}") for i in range(k) for j in range(k)],
                              *[F.sum(n * p[i]).alias(f"n{i}") for i in range(k)], F.count(F.lit(1)).alias("rows")).first()
    sums = np.array([x or 0.0 for x in sums], float)
    gram, now = sums[:k * k].reshape(k, k), sums[k * k:]
    narrow = members.select("n_tokens", "posterior").coalesce(max(1, -(-rows // ROWS)))  # a round's tasks are short
    # each domain's residual counts by the domain's own Gram entry, so that rare ones move as fast
    own = np.diag(gram)
    weight = np.divide(1.0, own, out=np.zeros(k), where=own > 0)
    top = float(np.linalg.eigvalsh(np.sqrt(weight)[:, None] * gram * np.sqrt(weight))[-1])
    past: list[tuple[float, np.ndarray]] = []
    if top <= 0:
        return past
    small = close * np.where(goal > close * now, goal, now)
    t = 1.0
    while rounds is None or len(past) < rounds:
        totals, ahead, moved, turn = _totals(narrow, past, start, most, k)
        if (np.abs(totals - goal) <= small).all() or past and (moved <= small).all():
            break
        if turn > 0:
            t = 1.0  # the momentum points uphill
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        past.append(((t - 1) / t_next, weight * (ahead - goal) / top))
        t = t_next
    return past


def _totals(members: DataFrame, past, start: float, most: float | None, k: int) -> tuple:
    """Expected domain totals at the rates and at the look-ahead rates, tokens of each domain that
    the last step moved, and whether its momentum points uphill (above 0)."""
    schema = ", ".join(f"t{j} double" for j in range(3 * k + 1))

    def add(batches):
        total = np.zeros(3 * k + 1)
        for b in batches:
            p, n = np.asarray(b.column(1).flatten()).reshape(-1, k), np.asarray(b.column(0), float)
            old, seen = fold_rates(p, past[:-1], start, most)
            rate, ahead = _step(p, old, seen, *past[-1], most) if past else (old, seen)
            total += np.concatenate([*[(x * n) @ p for x in (rate, ahead, np.abs(rate - seen))],
                                     [((seen - rate) * (rate - old)) @ n]])
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in total], [f"t{j}" for j in range(3 * k + 1)])

    conf, key = members.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = conf.get(key)
    conf.set(key, str(ROWS))  # no texts in these rows
    try:
        got = members.select("n_tokens", "posterior").mapInArrow(add, schema).agg(
            *[F.sum(f"t{j}") for j in range(3 * k + 1)]).first()
    finally:
        conf.set(key, before)
    got = np.array([x or 0.0 for x in got])
    return got[:k], got[k:2 * k], got[2 * k:3 * k], got[3 * k]


def _step(p: np.ndarray, rate: np.ndarray, ahead: np.ndarray, momentum: float, step: np.ndarray,
          most: float | None) -> tuple[np.ndarray, np.ndarray]:
    new = np.clip(ahead - p @ step, 0.0, most)
    return new, new + momentum * (new - rate)


def fold_rates(p: np.ndarray, past, start: float, most: float | None) -> tuple[np.ndarray, np.ndarray]:
    """(rates, look-ahead rates) of posterior rows after the past rounds."""
    rate = ahead = np.full(len(p), start)
    for momentum, step in past:
        rate, ahead = _step(p, rate, ahead, momentum, step, most)
    return rate, ahead


def mix(docs: DataFrame, model: Softmax, weights: dict[str, float] | None, domains: list[str],
        scale: list[float] | None = None, most: float | None = None, text: str = "text",
        rounds: int | None = None) -> DataFrame:
    """Input columns, n_tokens, posterior and ``rate``.

    ``weights``: target share of each domain of the present token total; or
    ``scale``: target as a multiple of each domain's present expected tokens."""
    prepare(docs.sparkSession)
    members = stored(posteriors(docs, model, text), "mix-members")
    k = len(domains)
    now = _totals(members, [], 1.0, None, k)[0]
    goal = [now.sum() * weights[d] for d in domains] if weights else [t * s for t, s in zip(now, scale)]
    past = fit_rates(members, goal, most=most, rounds=rounds)

    @F.arrow_udf("double")
    def rate(p: pa.Array) -> pa.Array:
        return pa.array(fold_rates(np.asarray(p.flatten()).reshape(-1, k), past, 1.0, most)[0])

    kept = [c for c in members.columns if c != "rate"]
    return members.select(*[F.col(f"`{c}`") for c in kept], rate.asNondeterministic()("posterior").alias("rate"))


def copies(rate: Column, *key: Column) -> Column:
    """Whole copies whose expectation is the rate, decided by a hash of the key."""
    u = F.pmod(F.xxhash64(*key), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return (F.floor(rate) + (u < rate - F.floor(rate)).cast("long")).cast("long")
