"""Quality: a regularised quadratic discriminant over statistics of the text.

A text becomes ``len(NAMES)`` statistics (sizes, shares of kinds of
characters, repeats), on log scales, so that each is roughly normal within a
class. For each class: mean and covariance of the standardised statistics,
the covariance shrunk towards a multiple of the identity by the closed-form
amount of the oracle approximating estimator (the fewer texts, the more).
The log-density difference of the classes comes from Mahalanobis distances by
Cholesky factors that the model keeps (their inverses, so scoring is one
product). ``score`` is the logistic of that difference, scaled and shifted by
two numbers fitted on the same labelled texts; 1 means good quality.

All labelled rows count (those whose crc32(id as text) mod 5 is not 0): the
fit needs each class's count, sums and products alone, and, for the two
numbers, a histogram of the differences, both folded on the executors.
Statistics are joined with labels, never texts.

Edge cases: a null text counts as empty, and an empty text has statistics of
its own (all at their floor), so it is scored like any other. Very long texts
are read whole, in numpy arrays as long as the text. A null id has no label and counts as
not held out; a null label is no label; of several labels of an id the larger
counts; rows that repeat an id all count. Without labelled rows of both
classes every score is 0 (no good ones) or 1 (no bad ones). An empty
table gives no rows; an input column with the name of an output gives way to it.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.llm.util import boxed, folded, stored, table, unboxed

THRESHOLD = 0.3
NAMES = ("words", "word_length", "word_spread", "upper", "digits", "stops", "shouts", "symbols", "bars", "marked_words",
         "lone_symbols", "distinct_words", "repeats", "distinct_pairs", "top_word", "lines", "repeated_lines",
         "byte_entropy", "longest_word")
#: Kinds of bytes: 0 space, 1 lower case or beyond ASCII, 2 upper case, 3 digit, 4 stop, 5 other symbol.
KIND = np.full(256, 5, np.uint8)
KIND[[9, 10, 11, 12, 13, 32]] = 0
KIND[97:123], KIND[128:], KIND[65:91], KIND[48:58] = 1, 1, 2, 3
KIND[[ord(c) for c in ".,;:?'\"-()"]] = 4
#: Bins of the histogram of log-density differences, and their outer edges.
BINS, REACH = 4_000, 400.0


def _floor_log(share: float) -> float:
    return float(np.log(1e-3 + share))


def statistics(text: str | None) -> list[float]:
    """The statistics of ``NAMES`` of one text."""
    text = text or ""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * 3 + [_floor_log(0.0)] * 14 + [0.0] * 2
    kind = KIND[raw]
    count = np.bincount(kind, minlength=6)
    solid = len(raw) - int(count[0])
    letters = int(count[1] + count[2])
    inside = np.concatenate([[False], kind > 0, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    size = ends - starts
    last = kind[ends - 1] if len(ends) else np.zeros(0, np.uint8)
    m = max(len(size), 1)
    seen: dict[str, int] = {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    lines = [x for x in text.split("\n") if x.strip()]
    freq = np.bincount(raw, minlength=256)
    p = freq[freq > 0] / len(raw)
    return [
        float(np.log1p(n)), float(np.log1p(size.mean())) if len(size) else 0.0,
        float(np.log1p(size.std())) if len(size) else 0.0,
        _floor_log(int(count[2]) / max(letters, 1)), _floor_log(int(count[3]) / max(solid, 1)),
        _floor_log(int(count[4]) / n), _floor_log(int(freq[33]) / n), _floor_log(int(count[5]) / n),
        _floor_log(int(freq[124]) / n), _floor_log(float((last == 5).sum()) / m),
        _floor_log(float(((last == 5) & (size == 1)).sum()) / m),
        _floor_log(len(seen) / n), _floor_log(sum(map(eq, words, words[1:])) / n),
        _floor_log(len(set(zip(words, words[1:]))) / n), _floor_log(max(seen.values()) / n),
        _floor_log(len(lines) / n), _floor_log(1 - len(set(lines)) / max(len(lines), 1)),
        float(-(p * np.log2(p)).sum()), float(np.log1p(size.max())) if len(size) else 0.0,
    ]


def held_out(id_col: str):
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def _labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(``_y``, ``_f``): class and statistics of every labelled row that may be learnt from."""
    known = (labels.select(F.col("doc_id").alias("_id"), F.col("quality").cast("int").alias("_y"))
             .where(F.col("_y").isNotNull() & F.col("_id").isNotNull() & ~held_out("_id"))
             .groupBy("_id").agg(F.max("_y").alias("_y")))
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    rows = rows.where(F.col("_id").isNotNull() & ~held_out("_id"))

    def run(batches):
        import pyarrow as pa

        for b in batches:
            made = [statistics(t) for t in b.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("_id"), pa.array(made, pa.list_(pa.float64()))],
                                             names=["_id", "_f"])

    schema = T.StructType([rows.schema["_id"], T.StructField("_f", T.ArrayType(T.DoubleType()))])
    return rows.mapInArrow(run, schema).join(known, on="_id").select("_y", "_f")


def _matrices(batches):
    """(class, statistics) arrays of each Arrow batch."""
    for b in batches:
        f = b.column("_f").flatten().to_numpy(zero_copy_only=False)
        yield b.column("_y").to_numpy(zero_copy_only=False) > 0, f.reshape(b.num_rows, len(NAMES))


class Moments:
    """Count, mean and centred products of one class's rows."""

    def __init__(self):
        self.n, self.mean, self.products = 0, np.zeros(len(NAMES)), np.zeros((len(NAMES),) * 2)

    def add(self, n: int, mean: np.ndarray, products: np.ndarray) -> None:
        if n:
            step, total = mean - self.mean, self.n + n
            self.products = self.products + products + np.outer(step, step) * (self.n * n / total)
            self.mean = self.mean + step * (n / total)
            self.n = total


def _moments(rows: DataFrame) -> tuple[Moments, Moments]:
    def take(state, part):
        good, f = part
        for c in (0, 1):
            x = f[good == bool(c)]
            if len(x):
                mean = x.mean(axis=0)
                state[c].add(len(x), mean, (x - mean).T @ (x - mean))
        return state

    def merge(state, other):
        for a, b in zip(state, other):
            a.add(b.n, b.mean, b.products)
        return state

    return folded(rows, _matrices, lambda: (Moments(), Moments()), take, merge)


def shrunk(cov: np.ndarray, n: int) -> np.ndarray:
    """Covariance of n rows pulled towards a multiple of the identity by the
    oracle approximating amount."""
    d = len(cov)
    level = np.trace(cov) / d
    t2 = float((cov * cov).sum())
    spread = (n + 1 - 2 / d) * (t2 - d * level * level)
    amount = min(1.0, ((1 - 2 / d) * t2 + d * d * level * level) / spread) if spread > 0 else 1.0
    return (1 - amount) * cov + (amount * level + 1e-6) * np.eye(d)


@dataclass
class Model:
    """``center``, ``spread``: standardisation; for the bad and the good class
    its mean, the inverse of the Cholesky factor of its covariance and the
    factor's log determinant; ``slope`` and ``shift`` of the logistic (without
    classes, ``shift`` is every score)."""
    center: np.ndarray
    spread: np.ndarray
    means: list[np.ndarray]
    factors: list[np.ndarray]
    logdets: list[float]
    slope: float
    shift: float

    def difference(self, f: np.ndarray) -> np.ndarray:
        """Log density as good less log density as bad."""
        z = (f - self.center) / self.spread
        log = []
        for mean, factor, logdet in zip(self.means, self.factors, self.logdets):
            m = (z - mean) @ factor.T
            log.append(-0.5 * (m * m).sum(axis=1) - logdet)
        return log[1] - log[0]

    def score(self, f: np.ndarray) -> np.ndarray:
        if not self.means:
            return np.full(len(f), self.shift)
        return 1 / (1 + np.exp(-np.clip(self.slope * self.difference(f) + self.shift, -500, 500)))


def _calibrated(mid: np.ndarray, bad: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic that fits a histogram of differences
    (Newton's method with halved steps, a weak pull on the slope)."""
    n, both = bad + good, bad.sum() + good.sum()

    def loss(w):
        z = mid * w[0] + w[1]
        return float((n * np.logaddexp(0, z) - good * z).sum() / both + 1e-4 * w[0] ** 2)

    w = np.array([0.1, np.log(good.sum() / bad.sum())])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(mid * w[0] + w[1], -500, 500)))
        g = np.array([((p * n - good) * mid).sum(), (p * n - good).sum()]) / both + [2e-4 * w[0], 0]
        h = n * p * (1 - p) / both
        hess = np.array([[(h * mid * mid).sum() + 2e-4, (h * mid).sum()], [(h * mid).sum(), h.sum() + 1e-9]])
        step, pace = np.linalg.solve(hess, g), 1.0
        while pace > 1e-6 and loss(w - pace * step) > loss(w):
            pace /= 2
        w = w - pace * step
        if np.abs(pace * step).max() < 1e-9:
            break
    return float(max(w[0], 0.0)), float(w[1])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    rows = stored(_labelled(docs, labels, id_col, text_col), "quality-labelled")
    classes = _moments(rows)
    total = Moments()
    for m in classes:
        total.add(m.n, m.mean, m.products)
    spread = np.sqrt(np.diag(total.products) / max(total.n, 1))
    model = Model(total.mean, np.where(spread > 1e-9, spread, 1.0), [], [], [], 0.0, 0.0)
    bad, good = classes
    if not bad.n or not good.n:
        model.shift = float(good.n > 0)
        return model
    for m in classes:
        chol = np.linalg.cholesky(shrunk(m.products / m.n / np.outer(model.spread, model.spread), m.n))
        model.means.append((m.mean - model.center) / model.spread)
        model.factors.append(np.linalg.inv(chol))
        model.logdets.append(float(np.log(np.diag(chol)).sum()))

    def count(state, part):
        isgood, f = part
        at = np.clip((model.difference(f) + REACH) / (2 * REACH) * BINS, 0, BINS - 1).astype(np.int64)
        return state + np.stack([np.bincount(at[isgood == bool(c)], minlength=BINS) for c in (0, 1)])

    histogram = folded(rows, _matrices, lambda: np.zeros((2, BINS), np.int64), count, np.add)
    mid = (np.arange(BINS) + 0.5) * (2 * REACH / BINS) - REACH
    model.slope, model.shift = _calibrated(mid, *histogram)
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` plus ``_held_out``, ``_score`` and ``_predicted``."""
    def run(batches):
        import pyarrow as pa

        for b in batches:
            texts = b.column("_doc").field(text_col).to_pylist()
            p = model.score(np.array([statistics(t) for t in texts]).reshape(len(texts), len(NAMES)))
            yield pa.RecordBatch.from_arrays([b.column("_doc"), pa.array(p)], names=["_doc", "_score"])

    rows = docs.select(boxed(docs))
    schema = T.StructType([rows.schema["_doc"], T.StructField("_score", T.DoubleType())])
    scored = rows.mapInArrow(run, schema).withColumn("_id", F.col("_doc").getField(id_col))
    return unboxed(scored, docs, {"_held_out": held_out("_id"), "_score": F.col("_score"),
                                  "_predicted": (F.col("_score") >= THRESHOLD).cast("int")})


def query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    r = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return r.select("doc_id", F.col("_held_out").alias("held_out"), F.col("_score").alias("score"),
                    F.col("_predicted").alias("predicted"))
