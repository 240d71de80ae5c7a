"""Toxicity: a factorization machine over hashed terms.

score = sigmoid(w0 + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j / n), x_i = 1
if the text has term i, n the number of its terms. Terms are lower-cased runs of word characters, hashed
to 62 bits. The pair part learns what a sum of weights cannot, such as an
insult together with the mention of a group. All terms of the model have
factors, whether or not they have a weight.

Fitted on a bounded sample of labelled rows (the ``MAX_ROWS`` first by a hash
of the id, of those whose crc32(id as text) mod 3 is not 1), over all terms
that are in two sampled texts or more; a term of one text says nothing about
others, and it and unseen terms have no weight. One task fits, so the driver
holds the model and not the sample. The
label, language, source and id of a document are no inputs of its score.

Edge cases: a null or empty text scores the model's bias; a null id counts as
not held out; a null label is no label, and of several labels for one id the
larger counts; without any labelled row, every score is 0; an empty table
gives no rows; a very long text is read whole, as the set of its terms; an input
column with the name of an output gives way to it.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.llm.util import boxed, table, unboxed

MAX_ROWS = 16_000
FACTORS = 4
#: Standard errors that a term's toxic texts must exceed, tried in turn.
PULLS = (4, 3, 2)
#: Texts in a batch of the factors, and batches taken (200 rounds at most).
BATCH, STEPS = 256, 2_000
#: Terms whose factors are summed at once (one text's at least), so that
#: memory follows neither the texts of the sample nor those of an Arrow batch.
TERMS = 1 << 16
THRESHOLD = 0.7
WORD = re.compile(r"\w+")


@dataclass
class Model:
    """``keys``: sorted term hashes; the last row of ``w`` and ``v`` (zeros) stands for other terms."""
    w0: float
    keys: np.ndarray
    w: np.ndarray
    v: np.ndarray

    def logits(self, rows: list[np.ndarray]) -> np.ndarray:
        """``rows``: indices into ``w`` and ``v`` of each text's terms."""
        out = np.full(len(rows), self.w0)
        sizes = np.array([len(r) for r in rows], dtype=np.int64)
        for first, last in _spans(sizes):
            have = first + np.flatnonzero(sizes[first:last])
            if len(have):
                idx = np.concatenate(rows[first:last])
                at = np.concatenate([[0], np.cumsum(sizes[have])[:-1]])
                v = self.v[idx]
                s, q = np.add.reduceat(v, at), np.add.reduceat(v * v, at)
                # Pairs are averaged over the text's terms, or their number would drown the weights.
                out[have] += np.add.reduceat(self.w[idx], at) + 0.5 * (s * s - q).sum(axis=1) / sizes[have]
        return out


def _spans(sizes: np.ndarray):
    """Ranges (first, last) of texts in a row with at most ``TERMS`` terms together, or one text."""
    ends, first = np.cumsum(sizes), 0
    while first < len(ends):
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + TERMS, side="right")))
        yield first, last
        first = last


def terms(text: str | None) -> set[str]:
    return set(WORD.findall((text or "").lower()))


def term_hash(word: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass")) >> 2


def held_out(id_col: str):
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def _sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The bounded training sample: ``_id``, ``_y`` and ``_terms`` (the sorted hashes' bytes)."""
    known = (labels.select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("_y"))
             .where(F.col("_y").isNotNull() & F.col("_id").isNotNull() & ~held_out("_id"))
             .groupBy("_id").agg(F.max("_y").alias("_y")))
    order = F.xxhash64("_id")
    # A top-k list of fixed length: a bounded table, broadcast.
    ids = known.orderBy(order, "_id").limit(MAX_ROWS)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(ids), on="_id")

    def hashed(batches):
        import pyarrow as pa

        for b in batches:
            packed = [np.array(sorted(map(term_hash, terms(t))), dtype=np.int64).tobytes()
                      for t in b.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("_id"), b.column("_y"), pa.array(packed, pa.binary())],
                                             names=["_id", "_y", "_terms"])

    schema = T.StructType([rows.schema["_id"], rows.schema["_y"], T.StructField("_terms", T.BinaryType())])
    # One text for each sampled id, whatever rows the table repeats.
    return (rows.select("_id", "_y", "_text").mapInArrow(hashed, schema)
            .groupBy("_id").agg(F.max("_y").alias("_y"), F.max("_terms").alias("_terms")))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    def one(sample):
        import pyarrow as pa

        order = np.argsort(sample.column("_id").to_numpy())
        y = sample.column("_y").to_numpy()[order].astype(np.float64)
        texts = [np.frombuffer(x.as_buffer(), np.int64) for x in sample.column("_terms")]  # views, no copies
        keys, rows = _coded([texts[i] for i in order])
        del sample, texts  # hashes are not needed beside their places
        m = _trained(keys, rows, y)
        return pa.table({"w0": pa.array([m.w0], pa.float64()),
                         **{n: pa.array([getattr(m, n).tobytes()], pa.binary()) for n in ("keys", "w", "v")}})

    sample = _sample(docs, labels, id_col, text_col).groupBy(F.lit(0).alias("_all"))
    got = sample.applyInArrow(one, "w0 double, keys binary, w binary, v binary").collect()
    if not got:
        return _trained(*_coded([]), np.zeros(0))
    w0, keys, w, v = got[0]
    return Model(w0, np.frombuffer(keys, np.int64), np.frombuffer(w), np.frombuffer(v).reshape(-1, FACTORS))


class _Rows:
    """Texts as flat arrays of model terms, for sums over each text and each term."""

    def __init__(self, idx: np.ndarray, who: np.ndarray, n: int):
        sizes = np.bincount(who, minlength=n)
        self.n, self.have = n, np.flatnonzero(sizes)
        self.at = np.concatenate([[0], np.cumsum(sizes[self.have])[:-1]]).astype(np.int64)
        self.idx, self.who = idx, who
        self.size = np.maximum(sizes, 1)

    @classmethod
    def of(cls, rows: list[np.ndarray]) -> _Rows:
        sizes = np.array([len(r) for r in rows], dtype=np.int64)
        return cls(np.concatenate([*rows, np.zeros(0, np.int32)]).astype(np.int32, copy=False),
                   np.repeat(np.arange(len(rows), dtype=np.int32), sizes), len(rows))

    def only(self, terms: np.ndarray) -> _Rows:
        """The texts with these terms alone (a mask), numbered anew."""
        kept, number = terms[self.idx], np.cumsum(terms, dtype=np.int32) - 1
        return _Rows(number[self.idx[kept]], self.who[kept], self.n)

    def part(self, first: int, last: int) -> _Rows:
        a, b = np.searchsorted(self.who, [first, last])
        return _Rows(self.idx[a:b], self.who[a:b] - first, last - first)

    def by_text(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros((self.n, *x.shape[1:]))
        if len(self.have):
            out[self.have] = np.add.reduceat(x, self.at)
        return out

    def pairs(self, v: np.ndarray) -> np.ndarray:
        """The pair part of each text's logit."""
        vi = v[self.idx]
        s, q = self.by_text(vi), self.by_text(vi * vi)
        return 0.5 * (s * s - q).sum(axis=1) / self.size


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _loss(z: np.ndarray, t: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, np.where(t == 1, -z, z))))


def _weights(r: _Rows, t: np.ndarray, k: int, l1: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression with an L1 pull for each term: accelerated proximal
    gradient, steps from the bound that a term's curvature has."""
    weight = np.full(len(t), 1 / len(t))
    curve = 0.25 * np.bincount(r.idx, (weight * (r.size + 1))[r.who], k) + 1e-9
    curve0 = 0.25 * (weight * (r.size + 1)).sum()
    share = min(max(t.mean(), 1e-6), 1 - 1e-6)
    w, w0 = np.zeros(k), float(np.log(share / (1 - share)))
    m, m0, pace = w, w0, 1.0
    for _ in range(300):
        g = weight * (_sigmoid(m0 + r.by_text(m[r.idx])) - t)
        step = m - np.bincount(r.idx, g[r.who], k) / curve
        w_new = np.sign(step) * np.maximum(np.abs(step) - l1 / curve, 0)
        w0_new = m0 - g.sum() / curve0
        pace_new = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        m, m0 = w_new + (pace - 1) / pace_new * (w_new - w), w0_new + (pace - 1) / pace_new * (w0_new - w0)
        w, w0, pace = w_new, w0_new, pace_new
    return w, w0


def _chosen(r: _Rows, t: np.ndarray, k: int, l1: np.ndarray) -> np.ndarray:
    """Mask of the terms that the pull leaves a weight. Terms come in as their
    gradient exceeds the pull, until none does, so the others need no steps."""
    inside, w, w0 = np.zeros(k, bool), np.zeros(k), 0.0
    for turn in range(10):
        if turn:
            w[inside], w0 = _weights(r.only(inside), t, int(inside.sum()), l1[inside])
        else:
            w0 = float(np.log(t.mean() / (1 - t.mean()))) if 0 < t.mean() < 1 else 30.0
        g = (_sigmoid(w0 + r.by_text(w[r.idx])) - t) / len(t)
        more = (np.abs(np.bincount(r.idx, g[r.who], k)) > 1.01 * l1) & ~inside
        if not more.any():
            break
        inside |= more
    return w != 0


def _factors(r: _Rows, t: np.ndarray, base: np.ndarray, held: _Rows, truth: np.ndarray, held_base: np.ndarray,
             k: int, rng) -> tuple[np.ndarray, float]:
    """Factors of all k terms on top of the weights' logits (Adagrad in
    batches) and their loss on the held texts; zeros where none lowers it."""
    parts = []
    for a in range(0, r.n, BATCH):
        p = r.part(a, min(a + BATCH, r.n))
        terms, idx = np.unique(p.idx, return_inverse=True)
        p.idx = idx.astype(np.int32)
        parts.append((p, terms, t[a:a + BATCH], base[a:a + BATCH]))
    held_parts = [held.part(a, b) for a, b in _spans(held.size)]
    v, sq = rng.normal(0, 0.1, (k, FACTORS)), np.full((k, FACTORS), 1e-6)
    best = np.zeros((k, FACTORS)), _loss(held_base, truth)
    for _ in range(min(200, -(-STEPS // len(parts)))):
        for i in rng.permutation(len(parts)):
            p, terms, y, z = parts[i]
            own = v[terms]
            vi = own[p.idx]
            s, q = p.by_text(vi), p.by_text(vi * vi)
            g = (_sigmoid(z + 0.5 * (s * s - q).sum(axis=1) / p.size) - y) / p.size / p.n
            pair = g[p.who][:, None] * (s[p.who] - vi)
            dv = np.stack([np.bincount(p.idx, pair[:, f], len(terms)) for f in range(FACTORS)], axis=1) + 1e-5 * own
            sq[terms] += dv * dv
            v[terms] = own - 0.1 * dv / np.sqrt(sq[terms])
        loss = _loss(held_base + np.concatenate([p.pairs(v) for p in held_parts]), truth)
        if loss < best[1]:
            best = v.copy(), loss
    return best


def train(texts: list[np.ndarray], y: np.ndarray, seed: int = 9) -> Model:
    """First the weights (logistic loss; an L1 pull of so many standard errors
    of a term's toxic texts, so it shrinks as rows are added), then the factors
    of all terms on what the weights leave, then the threshold. A fifth of the
    texts decides on the pull, the factors and the threshold."""
    return _trained(*_coded(texts), y, seed)


def _coded(texts: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """The hashes that two texts or more have, sorted, and each text's as places among them."""
    flat = np.concatenate([*texts, np.zeros(0, np.int64)])
    flat.sort()
    again = flat[1:] == flat[:-1]  # a text has each of its terms once
    keys = flat[:-1][again & np.concatenate([[True], ~again])[:len(again)]]
    return keys, [lookup(keys, t).astype(np.int32) for t in texts]


def _trained(keys: np.ndarray, rows: list[np.ndarray], y: np.ndarray, seed: int = 9) -> Model:
    if not len(y) or not y.any():
        return Model(-30.0, np.zeros(0, np.int64), np.zeros(1), np.zeros((1, FACTORS)))
    k = len(keys)
    rng = np.random.default_rng(seed)
    check = np.zeros(len(y), bool)
    for c in (0, 1):  # a fifth of each class, if it has as many
        of = rng.permutation(np.flatnonzero(y == c))
        check[of[:len(of) // 5]] = True
    mixed = rng.permutation(np.flatnonzero(~check))
    r, t = _Rows.of([rows[i] for i in mixed]), y[mixed]
    held = [x for x, c in zip(rows, check) if c] or rows
    truth = y[check] if check.any() else y
    h = _Rows.of(held)

    # Weights: a strong pull chooses the terms, a weak one then fits them.
    # No term with less than about three texts' evidence is chosen.
    error = np.sqrt(np.bincount(r.idx, minlength=k) * t.mean() * (1 - t.mean()))
    best = None
    for c in PULLS:
        l1 = np.maximum(c * error, 2.5) / len(t)
        chosen, w = _chosen(r, t, k, l1), np.zeros(k)
        w[chosen], w0 = _weights(r.only(chosen), t, int(chosen.sum()), l1[chosen] / 10)
        loss = _loss(w0 + h.by_text(w[h.idx]), truth)
        if best is None or loss < best[0]:
            best = loss, w, w0
    _, w, w0 = best
    model = Model(w0, keys, np.append(w, 0.0), np.zeros((k + 1, FACTORS)))
    if k:
        base, held_base = w0 + r.by_text(w[r.idx]), w0 + h.by_text(w[h.idx])
        model.v[:-1], _ = _factors(r, t, base, h, truth, held_base, k, rng)

    # Threshold: most hits less three times the false alarms on the fifth, then on all rows.
    z = model.logits(rows)
    order = np.argsort(-z, kind="stable")
    step = np.where(y[order] == 1, 1, -3)
    z = np.concatenate([[z.max() + 1], z[order], [z.min() - 1]])
    gain = np.concatenate([[0], np.cumsum(step * check[order] * (8 * len(y)) + step)])
    gain[1:-1][z[1:-2] == z[2:-1]] = gain.min() - 1  # no cut between equal scores
    at = np.flatnonzero(gain == gain.max())
    cut = (z[at[0]] + z[at[-1] + 1]) / 2
    slope = 4.0
    model.w0 = slope * (model.w0 - cut) + float(np.log(THRESHOLD / (1 - THRESHOLD)))
    model.w *= slope
    model.v *= np.sqrt(slope)
    return model


def lookup(keys: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Index of each hash among the keys; those that are not there are left out."""
    at = np.searchsorted(keys, hashes)
    hit = at < len(keys)
    hit[hit] = keys[at[hit]] == hashes[hit]
    return at[hit]


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` plus ``_held_out``, ``_score`` and ``_predicted``."""
    def run(batches):
        import pyarrow as pa

        index = dict(zip(model.keys.tolist(), range(len(model.keys))))
        known: dict[str, int] = {}  # words seen by this task, with their place in the model or -1
        for b in batches:
            rows = []
            for text in b.column("_doc").field(text_col).to_pylist():
                words = terms(text)
                if len(known) > 300_000:
                    known.clear()
                for x in words:
                    if x not in known:
                        known[x] = index.get(term_hash(x), -1)
                at = np.fromiter(map(known.__getitem__, words), dtype=np.int64, count=len(words))
                rows.append(np.sort(at[at >= 0]))
            p = _sigmoid(model.logits(rows))
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
