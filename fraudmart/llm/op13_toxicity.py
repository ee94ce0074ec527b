"""Toxicity by a bidirectional gated recurrent network with attention pooling.

Every word gives word and character inputs: a learned vector of the word (one for all
words outside the vocabulary), the mean of learned vectors of its hashed byte trigrams
with edges marked, and the sum of those of its first HEADS bytes. Two gated recurrent layers read a window of words forwards and backwards,
attention weighs the states, and a logistic unit scores their weighted sum. A text is
cut into overlapping windows from its first to its last word and scores as its
highest window.

The network is trained in numpy in one task, on a bounded sample of labelled texts
(at most SAMPLE rows a class, texts of at most SAMPLE_BYTES): a label belongs to a
text, so windows learn by multiple instances, first by noisy-or over a text's windows,
then by its highest one. Scoring is one pass over Arrow batches: inputs and their
products with the gates are made once for each distinct word of a pool of windows, so
a step of the recurrence is one gather and one small matrix product for all of them.

Cases: a null, empty or blank text is one window without words and scores what the
model gives to nothing; texts of any length are read in pieces of PIECE characters,
each cut at white space, with the same windows as in one go; repeated rows score
alike; without labelled rows of both classes all scores are the share of label 1 (0.5
with no rows); labels with null ids or classes and repeated labels of an id that
disagree are not used; an empty table gives no rows; input columns named like the
result are replaced.
"""

from __future__ import annotations

import pickle
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudmart.llm.common import prepare, stored

SAMPLE = 2048  # labelled rows of each class that the network is fitted on, at most
SAMPLE_BYTES = 1 << 14  # of their texts; longer ones take no part in the fitting
WORDS = 8192  # words of the vocabulary, at most (in five sampled texts or more)
GRAMS = 4096  # trigram classes
HEADS, HEAD_CLASSES = (4, 6), 1 << 14  # bytes of a word's heads, and their classes
WIDTH, STRIDE = 32, 16  # words of a window, and from one window to the next
WORD_SIZE, GRAM_SIZE, HEAD_SIZE, STATE, ATTENTION = 8, 8, 8, 12, 8
STEPS, TEXTS = 320, 48  # training steps, and texts of one
DROP, DECAY = 0.3, 0.1  # share of words that lose an input in training, and decay of all parameters
POOL, WINDOWS = 1 << 17, 1 << 10  # words of a pool, and windows that are run at once
PIECE = 1 << 20  # characters read at once
THRESHOLD = 0.3

_APART = bytes(c for c in range(128) if not (chr(c).isalnum()))
_TO_SPACE = bytes.maketrans(_APART, b" " * len(_APART))
_MIX = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)  # odd multipliers of the trigram hash


def words_of(text: str) -> list[bytes]:
    """Lower-case words between ASCII punctuation and white space, in UTF-8."""
    return text.lower().encode("utf-8", "surrogatepass").translate(_TO_SPACE).split()


def pieces(text: str, size: int) -> Iterator[str]:
    """A text in parts of about ``size`` characters, cut at ASCII white space or punctuation."""
    at = 0
    while len(text) - at > size:
        cut = at + size
        while cut < len(text) and not (text[cut] < "\x80" and not text[cut].isalnum()):
            cut += 1
        yield text[at:cut]
        at = cut
    yield text[at:]


def characters(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Classes of the byte trigrams of '^word$' for all words, how many each has, and
    classes of the words' heads (one row a word)."""
    raw = np.frombuffer(b"".join(b"^%s$" % w for w in words) + b"$" * max(HEADS), np.uint8).astype(np.uint32)
    count = np.array([len(w) for w in words], np.int64)
    first = np.cumsum(count + 2) - count - 1
    at = np.arange(count.sum()) + 2 * np.repeat(np.arange(len(words)), count)
    mixed = raw[at] * _MIX[0] + raw[at + 1] * _MIX[1] + raw[at + 2] * _MIX[2]
    heads, so_far = [], np.zeros(len(words), np.uint32)
    for k in range(max(HEADS)):
        so_far = (so_far + np.where(k < count, raw[np.minimum(first + k, len(raw) - 1)], 0).astype(np.uint32) + np.uint32(1)) * _MIX[1]
        so_far ^= so_far >> np.uint32(13)
        if k + 1 in HEADS:
            heads.append((so_far * _MIX[2] >> np.uint32(12)).astype(np.int64) % HEAD_CLASSES)
    return ((mixed ^ mixed >> np.uint32(15)) * _MIX[0] >> np.uint32(12)).astype(np.int64) % GRAMS, count, np.stack(heads, 1)


def window_starts(n: int) -> np.ndarray:
    """First words of the windows of ``n`` words: every STRIDE, to the one that reaches the end."""
    return np.arange(0, max(1, n - WIDTH + STRIDE), STRIDE)


def _sums(rows: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Rows summed by their place."""
    out = np.zeros((n, rows.shape[1]), rows.dtype)
    if len(at):
        order = np.argsort(at, kind="stable")
        own, first = np.unique(at[order], return_index=True)
        out[own] = np.add.reduceat(rows[order], first, axis=0)
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """Parameters and passes of the network. ``p``: float32 arrays by name."""

    def __init__(self, vocabulary: list[bytes] = (), seed: int = 7, dtype=np.float32):
        self.place = {w: i + 1 for i, w in enumerate(vocabulary)}
        self.prior: float | None = None  # of a network that could not be fitted
        rng, h, d = np.random.default_rng(seed), STATE, WORD_SIZE + GRAM_SIZE + HEAD_SIZE
        make = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(dtype)
        self.p = {"word": (0.1 * rng.standard_normal((len(vocabulary) + 1, WORD_SIZE))).astype(dtype),
                  "gram": (0.3 * rng.standard_normal((GRAMS, GRAM_SIZE))).astype(dtype),
                  "head": (0.1 * rng.standard_normal((HEAD_CLASSES, HEAD_SIZE))).astype(dtype),
                  "in": make(d, 6 * h), "in_b": np.zeros(6 * h, dtype), "u0": make(h, 3 * h), "u1": make(h, 3 * h),
                  "n0": np.zeros(h, dtype), "n1": np.zeros(h, dtype), "att": make(2 * h, ATTENTION),
                  "att_b": np.zeros(ATTENTION, dtype), "att_v": make(ATTENTION), "out": make(2 * h), "out_b": np.zeros(1, dtype)}

    # ------------------------------------------------------------ inputs
    def inputs(self, words: list[bytes], drop: np.random.Generator | None = None) -> tuple[np.ndarray, ...]:
        """Per distinct word its input vector, vocabulary place, trigrams, their count
        and heads (-1: left out). ``drop`` leaves out vocabulary places and heads."""
        place = np.array([self.place.get(w, 0) for w in words], np.int64)
        gram, count, head = characters(words)
        if drop is not None:
            place = np.where(drop.random(len(words)) < DROP, 0, place)
            head = np.where(drop.random(head.shape) < DROP, -1, head)
        total = np.add.reduceat(self.p["gram"][gram], np.cumsum(count) - count, axis=0)  # no word is empty
        heads = (self.p["head"][head] * (head >= 0)[:, :, None].astype(total.dtype)).sum(1)
        x = np.concatenate([self.p["word"][place], total / count[:, None].astype(total.dtype), heads], 1)
        return x, place, gram, count, head

    def gates(self, x: np.ndarray) -> list[np.ndarray]:
        """What the inputs give to the gates of either direction."""
        return [np.ascontiguousarray(g) for g in np.split(x @ self.p["in"] + self.p["in_b"], 2, axis=1)]

    # ------------------------------------------------------------ passes
    def _layer(self, own: np.ndarray, at: np.ndarray, mask: np.ndarray, k: int, keep: list | None) -> np.ndarray:
        """States of one direction, time first. ``at``: rows of its gates by time and window."""
        h, u, bias = STATE, self.p[f"u{k}"], self.p[f"n{k}"]
        state, out = np.zeros((at.shape[1], h), own.dtype), np.empty((*at.shape, h), own.dtype)
        for t in range(len(at)) if k == 0 else range(len(at) - 1, -1, -1):
            g, a = own[at[t]], state @ u
            zr = 1 / (1 + np.exp(-(g[:, :2 * h] + a[:, :2 * h])))
            z, r, inner = zr[:, :h], zr[:, h:], a[:, 2 * h:] + bias
            n = np.tanh(g[:, 2 * h:] + r * inner)
            new = (n + z * (state - n)) * mask[t][:, None]  # nothing after the last word
            if keep is not None:
                keep.append((t, state, z, r, n, inner))
            state = new
            out[t] = new
        return out

    def logits(self, gates: list[np.ndarray], at: np.ndarray, mask: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Of windows: ``at`` has their words' rows in ``gates``, by time and window."""
        kept = ([], []) if keep is not None else (None, None)
        states = np.concatenate([self._layer(gates[k], at, mask, k, kept[k]) for k in (0, 1)], 2)
        hidden = np.tanh(states @ self.p["att"] + self.p["att_b"])
        e = np.where(mask > 0, hidden @ self.p["att_v"], np.float32(-1e4))
        w = np.exp(e - e.max(0)) * mask
        w = w / np.maximum(w.sum(0), np.finfo(w.dtype).tiny)
        pooled = (w[:, :, None] * states).sum(0)
        if keep is not None:
            keep.update(kept=kept, states=states, hidden=hidden, w=w, pooled=pooled)
        return pooled @ self.p["out"] + self.p["out_b"][0]

    def gradients(self, words: list[bytes], at: np.ndarray, mask: np.ndarray, slope,
                  drop: np.random.Generator | None = None) -> tuple[dict, np.ndarray]:
        """Gradients of a loss whose derivative by the windows' logits is ``slope(logits)``."""
        x, place, gram, count, head = self.inputs(words, drop)
        keep: dict = {}
        z = self.logits(self.gates(x), at, mask, keep)
        dz = slope(z).astype(x.dtype)
        states, hidden, w = keep["states"], keep["hidden"], keep["w"]
        g = {"out": keep["pooled"].T @ dz, "out_b": dz.sum(keepdims=True)}
        d_pooled = dz[:, None] * self.p["out"]
        d_states = w[:, :, None] * d_pooled
        d_w = (states * d_pooled).sum(2)
        d_e = w * (d_w - (w * d_w).sum(0))
        d_hidden = d_e[:, :, None] * self.p["att_v"] * (1 - hidden * hidden)
        g["att_v"] = np.einsum("tbk,tb->k", hidden, d_e)
        g["att"] = np.einsum("tbi,tbk->ik", states, d_hidden, optimize=True)
        g["att_b"] = d_hidden.sum((0, 1))
        d_states = d_states + d_hidden @ self.p["att"].T
        h, d_gates = STATE, np.zeros((*at.shape, 6 * STATE), x.dtype)
        for k in (0, 1):
            u, own = self.p[f"u{k}"], d_states[:, :, h * k:h * (k + 1)]
            back, du, dn_bias = np.zeros((at.shape[1], h), x.dtype), np.zeros_like(u), np.zeros(h, x.dtype)
            for t, state, zt, r, n, inner in reversed(keep["kept"][k]):
                d = (back + own[t]) * mask[t][:, None]
                d_n = d * (1 - zt) * (1 - n * n)
                d_z = d * (state - n) * zt * (1 - zt)
                d_r = d_n * inner * r * (1 - r)
                d_a = np.concatenate([d_z, d_r, d_n * r], 1)
                du += state.T @ d_a
                dn_bias += d_a[:, 2 * h:].sum(0)
                back = d * zt + d_a @ u.T
                d_gates[t, :, 3 * h * k:3 * h * (k + 1)] = np.concatenate([d_z, d_r, d_n], 1)
            g[f"u{k}"], g[f"n{k}"] = du, dn_bias
        by_word = _sums(d_gates.reshape(-1, 6 * h), at.reshape(-1), len(words))
        g["in"], g["in_b"] = x.T @ by_word, by_word.sum(0)
        d_x = by_word @ self.p["in"].T
        g["word"] = _sums(d_x[:, :WORD_SIZE], place, len(self.p["word"]))
        each = d_x[:, WORD_SIZE:WORD_SIZE + GRAM_SIZE] / count[:, None].astype(x.dtype)
        g["gram"] = _sums(np.repeat(each, count, axis=0), gram, GRAMS)
        own = np.flatnonzero(head.reshape(-1) >= 0)
        g["head"] = _sums(d_x[own // len(HEADS), WORD_SIZE + GRAM_SIZE:], head.reshape(-1)[own], HEAD_CLASSES)
        return g, z

    # ---------------------------------------------------------- training
    def fit(self, texts: list[list[bytes]], labels: np.ndarray, steps: int = STEPS, rate: float = 0.01,
            seed: int = 11) -> Network:
        """Adam over batches of texts (as words)."""
        labels = np.asarray(labels, bool)
        if labels.all() or not labels.any():
            self.prior = float(labels.mean()) if len(labels) else 0.5
            return self
        rng, order = np.random.default_rng(seed), np.zeros(0, np.int64)
        first, second = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2))
        for step in range(steps):
            if len(order) < TEXTS:
                order = np.append(order, rng.permutation(len(texts)))
            own, order = order[:TEXTS], order[TEXTS:]
            pool = Pool()
            for i, k in enumerate(own):
                pool.add(i, texts[k])
            words, at, mask, of = pool.taken()
            y, hard = labels[own], step >= steps // 2

            def slope(z: np.ndarray) -> np.ndarray:
                p = _sigmoid(z)
                if hard:  # the highest window stands for its text
                    top = np.lexsort((np.arange(len(z)), -z, of))
                    top = top[np.searchsorted(of[top], np.arange(len(own)))]
                    out = np.zeros(len(z))
                    # texts of label 1 without a telling window count for little (wrong labels)
                    out[top] = np.where(y, -(1 - p[top]) * np.sqrt(p[top]), p[top])
                    return out / len(own)
                none = np.exp(np.bincount(of, np.log1p(-np.minimum(p, 1 - 1e-6)), len(own)))
                share = np.where(y, -none / np.maximum(1 - none, 1e-6), 1.0)
                return np.clip(share[of], -50, 1) * p / len(own)

            g, _ = self.gradients(words, at, mask, slope, rng)
            size = float(np.sqrt(sum(float((v * v).sum()) for v in g.values())))  # a numpy scalar would widen all
            lr = rate * min(1.0, (step + 1) / 20) * (1 - step / steps) ** 0.5
            for k, v in g.items():
                v = v * min(1.0, 1.0 / max(size, 1e-9))
                first[k] += 0.1 * (v - first[k])
                second[k] += 0.01 * (v * v - second[k])
                ahead, spread = first[k] / (1 - 0.9 ** (step + 1)), second[k] / (1 - 0.99 ** (step + 1))
                self.p[k] = (self.p[k] - lr * (ahead / (np.sqrt(spread) + 1e-6) + DECAY * self.p[k])).astype(v.dtype)
        return self

    # ----------------------------------------------------------- scoring
    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Highest window probability of each whole text."""
        best = np.full(len(texts), -np.inf)
        if self.prior is not None:
            return np.full(len(texts), self.prior)
        pool = Pool()

        def flush() -> None:
            words, at, mask, of = pool.taken()
            gates = self.gates(self.inputs(words)[0])
            for k in range(0, len(of), WINDOWS):
                own = slice(k, k + WINDOWS)
                np.maximum.at(best, of[own], self.logits(gates, at[:, own], mask[:, own]))

        for i, text in enumerate(texts):
            rest: list[bytes] = []
            for piece in pieces(text or "", PIECE):
                rest += words_of(piece)
                rest = pool.add(i, rest, more=True)
                if pool.size >= POOL:
                    flush()
            pool.add(i, rest)
        flush()
        return _sigmoid(best)


class Pool:
    """Windows waiting to be run: their words as places in a list of distinct words."""

    def __init__(self):
        self._clear()

    def _clear(self) -> None:
        self.place: dict[bytes, int] = defaultdict()
        self.place.default_factory = self.place.__len__
        self.rows: list[np.ndarray] = []
        self.starts: list[np.ndarray] = []
        self.texts: list[np.ndarray] = []
        self.size = 0

    def add(self, text: int, words: list[bytes], more: bool = False) -> list[bytes]:
        """The windows of a text's words. With ``more`` words to come, only whole windows
        that are not its last ones; returns the words from the next window on."""
        n = len(words)
        starts = np.arange(0, max(0, n - WIDTH - STRIDE + 1), STRIDE) if more else window_starts(n)
        if more and not len(starts):
            return words
        used = words[:starts[-1] + WIDTH]
        self.rows.append(np.fromiter(map(self.place.__getitem__, used), np.int64, len(used)))
        self.starts.append(np.stack([starts + self.size, np.minimum(WIDTH, len(used) - starts)], 1))
        self.texts.append(np.full(len(starts), text))
        self.size += len(used)
        return words[starts[-1] + STRIDE:] if more else []

    def taken(self) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
        """Distinct words, places by time and window, mask, and text of each window; the
        pool is empty afterwards. Windows of like length stand together."""
        words = list(self.place) or [b"-"]
        rows = np.append(np.concatenate(self.rows), np.zeros(WIDTH, np.int64)) if self.rows else np.zeros(WIDTH, np.int64)
        starts = np.concatenate(self.starts) if self.starts else np.zeros((0, 2), np.int64)
        texts = np.concatenate(self.texts) if self.texts else np.zeros(0, np.int64)
        t = np.arange(WIDTH)[:, None]
        mask = (t < starts[:, 1]).astype(np.float32)
        at = rows[np.minimum(starts[:, 0] + t, len(rows) - 1)] * (mask > 0)
        self._clear()
        return words, at, mask, texts


def vocabulary(texts: list[list[bytes]], most: int = WORDS, least: int = 5) -> list[bytes]:
    """Words in ``least`` texts or more, the most frequent first."""
    seen = Counter(w for t in texts for w in set(t))
    return [w for w, n in sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:most] if n >= least]


def train(texts: list[str], labels: list[int]) -> Network:
    cut = [words_of(t) for t in texts]
    return Network(vocabulary(cut)).fit(cut, np.array(labels))


def _train_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = [r for b in batches for r in b.to_pylist()]
    rows.sort(key=lambda r: (r["h"], r["id"], r["t"]))
    made = train([r["t"] for r in rows], [r["y"] for r in rows])
    yield pa.RecordBatch.from_pydict({"network": pa.array([pickle.dumps(made)], pa.binary())})


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "label",
        sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES) -> Network:
    """Fitted, in one task, on the texts of, for each class, the ``sample`` labelled ids
    with the smallest hash among texts of at most ``sample_bytes``."""
    prepare(docs.sparkSession)
    given = labels.select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("y")).filter(
        "id is not null and y in (0, 1)").groupBy("id").agg(F.min("y").alias("y"), F.max("y").alias("z")).filter("y = z")
    short = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("t")).filter(F.octet_length("t") <= sample_bytes)
    own = short.select("id", F.xxhash64("id").alias("h")).join(given.select("id", "y"), "id").distinct()
    least = lambda rows, *by: rows.filter("y = 0").orderBy("h", "id", *by).limit(sample).unionByName(
        rows.filter("y = 1").orderBy("h", "id", *by).limit(sample))
    # the sample's bound makes this side small at every size; ids may repeat in docs
    rows = stored(short.join(F.broadcast(stored(least(stored(own, "toxicity-ids")), "toxicity-sample")), "id"), "toxicity-texts")
    made = least(rows, "t").coalesce(1).mapInArrow(_train_task, "network binary").collect()  # one row
    return pickle.loads(made[0]["network"])


def score(docs: DataFrame, network: Network, text: str = "text") -> DataFrame:
    """Input columns with ``score`` (0 to 1) and ``predicted`` (1 from THRESHOLD on)."""
    prepare(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(network)  # WORDS and GRAMS bound it: 1 MB

    @F.arrow_udf("double")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array(sent.value.scores(texts.to_pylist()), pa.float64())

    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ("score", "predicted") or c == text]
    out = docs.select(*kept, run.asNondeterministic()(F.col(f"`{text}`")).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that are never learned from: unsigned CRC-32 of the decimal id is 2 mod 4."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))
