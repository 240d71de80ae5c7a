"""op11 and op12 against brute force, on the table and on small cases by hand."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from faultline.llm import op11_hard_negatives as op11
from faultline.llm import op12_whitening as op12
from faultline.llm import vectors

SF = "/root/testdata/sf0.01"
NAN, INF = float("nan"), float("inf")


def table_of(name=f"{SF}/embeddings.parquet"):
    rows = duckdb.sql(f"select vec_id, embedding, label from '{name}' order by 1").fetchall()
    return [r[0] for r in rows], np.array([r[1] for r in rows], dtype=np.float64), [r[2] for r in rows]


# -- the grid

def test_vectors_on_the_grid(spark):
    values = [[1.0, -0.5], [0.00390625 * 3.5, -1e-9], [300.0, 1e7], [2.0 ** 40, 0.0], None, [], [None, 1.0], [NAN, 1.0],
              [1.0, INF], [-0.0, 0.0]]
    df = spark.createDataFrame(list(enumerate(values)), "i int, `a v` array<double>")
    got = {r["i"]: (r["_dim"], vectors.unpack([bytes(r["_x"])], r["_dim"])[0].tolist())
           for r in vectors.on_grid(df, "a v", ["i"]).collect()}
    assert got == {0: (2, [256, -128]), 1: (2, [3, -1]), 2: (2, [76800, 2560000000]), 3: (2, [2 ** 48, 0]), 9: (2, [0, 0])}
    mixed = [vectors.pack(np.array(v, float)) for v in ([1, 2], [70_000, -1], [-3, 2 ** 40])]
    assert vectors.unpack(mixed, 2).tolist() == [[1, 2], [70_000, -1], [-3, 2 ** 40]]
    with pytest.raises(OverflowError):
        vectors.pack(np.array([2.0 ** 63]))


# -- op11

def mined(ids, x, labels, anchor, n_pos=5, n_neg=10):
    """{(anchor, positive, rank): (negative, positive score, negative score)} by brute force."""
    out = {}
    for a in range(len(ids)):
        if not anchor(ids[a]):
            continue
        s = [sum(int(p) * int(q) for p, q in zip(x[a], x[b])) for b in range(len(ids))]
        order = sorted((b for b in range(len(ids)) if b != a), key=lambda b: (-s[b], ids[b]))
        for p in [b for b in order if labels[b] == labels[a]][:n_pos]:
            fit = [b for b in order if labels[b] != labels[a] and 30 * s[p] <= 100 * s[b] <= 90 * s[p]]
            out |= {(ids[a], ids[p], r): (ids[b], s[p], s[b]) for r, b in enumerate(fit[:n_neg], 1)}
    return out


def found(df):
    rows = df.collect()
    out = {(r["anchor_id"], r["positive_id"], r["rank"]): (r["negative_id"], r["positive_score"], r["negative_score"])
           for r in rows}
    assert len(out) == len(rows)
    return out


def test_hard_negatives_of_the_table(spark):
    ids, x, labels = table_of()
    labels = [(y + 1) % 10 if i % 7 == 0 else y for i, y in zip(ids, labels)]
    want = mined(ids, np.floor(256 * x).astype(int), labels, lambda i: i % 100 == 0)
    assert want and found(op11.query(spark, SF)) == want


@pytest.mark.parametrize("small", [False, True])
def test_hard_negatives_clusters_ties_and_signs(spark, monkeypatch, small):
    """Norms that differ, clusters, negative and zero scores, ties; with small
    blocks and groups: a large cluster over several groups, two waves."""
    if small:
        for name, value in (("MAX_ROWS", 40), ("TASK_ROWS", 10), ("SAMPLE", 50), ("FIRST_WAVE", 3)):
            monkeypatch.setattr(op11, name, value)
    rng = np.random.default_rng(5)
    n = 260
    hubs = rng.normal(size=(4, 6))
    x = hubs[rng.choice(4, n, p=[.7, .1, .1, .1])] * rng.uniform(.2, 4, (n, 1)) + rng.normal(scale=.05, size=(n, 6))
    x[60:100] = x[60]  # copies
    x[100:120] = 0
    x[120:140] *= -1
    labels = rng.integers(0, 3, n).tolist()
    labels[7] = 99  # an anchor without positives
    ids = list(range(-20, n - 20))
    df = spark.createDataFrame([(i, v.tolist(), y) for i, v, y in zip(ids, x, labels)],
                               "vec_id long, embedding array<double>, label int")
    want = mined(ids, np.floor(256 * x).astype(int), labels, lambda i: i % 4 == 0)
    got = found(op11.hard_negatives(df.repartition(3), F.col("_id") % 4 == 0))
    assert len(want) > 500 and got == want


def test_walks_end_early_where_angles_allow():
    """Far-off rows are not multiplied once no member can still want them."""
    rng = np.random.default_rng(1)
    near = rng.integers(90, 110, (600, 4)) * np.array([1, 0, 0, 0]) + rng.integers(0, 5, (600, 4))
    far = -rng.integers(90, 110, (20_000, 4)) * np.array([1, 0, 0, 0])
    rows = np.concatenate([near, far])
    u, norm = op11._unit(rows)
    angle = op11._angles(u, np.array([[1.0, 0, 0, 0]]))[:, 0]
    bound = norm * np.cos(np.maximum(0, angle - .1)) + 1e-9
    order = np.argsort(-bound, kind="stable")
    seen = []
    original = op11._products
    try:
        op11._products = lambda a, b: seen.append(len(b)) or original(a, b)
        one = np.zeros((1, 1), np.int64)
        best = op11.walk(np.array([[100, 1, 1, 1]]), np.array([-1]), np.array([0]), one + op11.LEAST, one + op11.MOST,
                         one + op11.LEAST, rows[order], np.arange(len(rows))[order], np.zeros(len(rows), int), bound[order],
                         True, 5)
    finally:
        op11._products = original
    s = rows @ np.array([100, 1, 1, 1])
    assert best.id.tolist() == np.lexsort((np.arange(len(rows)), -s))[:5].tolist() and sum(seen) < 3_000


def test_hard_negative_edges(spark):
    rows = [(0, [1.0, 0.0], 1, "a"), (0, [1.0, 0.0], 1, "a"), (1, [1.0, 0.0], 1, "b"), (2, [0.5, 0.0], 2, "c"),
            (2, [0.5, 0.0], 2, "c"), (3, None, 2, "d"), (4, [NAN, 0.5], 2, "e"), (5, [0.5, None], 2, "f"), (6, [0.5], 2, "g"),
            (7, [], 2, "h"), (8, [0.5, 0.0], None, "i"), (None, [0.5, 0.0], 2, "j"), (9, [0.4, 9.0], 2, "k")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, _x string").withColumnRenamed(
        "_x", "rank")
    got = found(op11.hard_negatives(df, F.col("_id") == 0))
    assert got == {(0, 1, 1): (2, 65536, 32768), (0, 1, 2): (9, 65536, 256 * 102)}
    none = op11.hard_negatives(df.limit(0), F.col("_id") == 0)
    assert none.collect() == [] and none.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                                                     "negative_score"]
    assert op11.hard_negatives(df, F.col("_id") == 77).collect() == []  # no anchors


def test_exact_products():
    big = np.array([[2 ** 30, 3], [-(2 ** 30), 1]])
    assert op11._products(big, big).tolist() == [[2 ** 60 + 9, 3 - 2 ** 60], [3 - 2 ** 60, 2 ** 60 + 1]]
    with pytest.raises(OverflowError):
        op11._products(np.array([[2 ** 40]]), np.array([[2 ** 40]]))


def test_groups_hold_a_bounded_number_of_anchors(monkeypatch):
    monkeypatch.setattr(op11, "MAX_ROWS", 100)
    first, parts, n = op11._groups({0: 30, 1: 50, 2: 950, 3: 90, 5: 10})
    assert parts == {0: 1, 1: 1, 2: 10, 3: 1, 5: 1} and first == {0: 0, 1: 0, 2: 1, 3: 11, 5: 11} and n == 12


# -- op12

def whitened_by_hand(x):
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    c = fit - sums / n
    values, v = np.linalg.eigh(c.T @ c / n)
    return n, sums, values[::-1], v[:, ::-1]


def check_whitening(rows, ids, x, k, tol=1e-9):
    n, sums, values, v = whitened_by_hand(x)
    got = {(r["vec_id"], r["component"]): r for r in rows}
    assert len(rows) == len(ids) * k == len(got)
    want = (x - sums / n) @ v[:, :k] / np.sqrt(values[:k])
    mine = np.array([[got[i, c + 1]["whitened"] for c in range(k)] for i in ids])
    sign = np.sign((mine * want).sum(axis=0))
    assert np.abs(mine - want * sign).max() < tol
    for i, row in zip(ids, x):
        r = got[i, 1]
        assert r["n"] == n and r["deviation"] == sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums))
        assert r["identity_error"] < 1e-10
    for c in range(k):
        assert abs(got[ids[0], c + 1]["explained"] - values[c] / values.sum()) < 1e-12


def test_whitening_of_the_table(spark):
    ids, x, _ = table_of()
    check_whitening(op12.query(spark, SF).collect(), ids, np.floor(256 * x).astype(int), 4)


def test_whitening_edges(spark):
    rng = np.random.default_rng(3)
    x = rng.integers(-40, 40, (50, 3)) * np.array([5, 2, 1])
    x[20:40] = x[20]  # copies count once
    rows = [(i, [float(a) / 256 for a in v], "z") for i, v in enumerate(x)]
    bad = [(100, None, "z"), (101, [], "z"), (102, [1.0, None, 1.0], "z"), (103, [1.0, NAN, 1.0], "z"),
           (104, [1.0, -INF, 1.0], "z"), (105, [1.0], "z")]
    df = spark.createDataFrame([*rows, *bad], "vec_id long, embedding array<double>, n string")
    check_whitening(op12.whitening(df.repartition(40)).collect(), list(range(50)), x, 3)  # three components, many partitions
    assert op12.whitening(df.limit(0)).collect() == []
    null_id = op12.whitening(spark.createDataFrame([(None, [1.0, 2.0]), (1, [1.0, 2.0])], "vec_id long, embedding array<double>"))
    got = [tuple(r) for r in null_id.collect()]  # one distinct vector: no variance at all
    assert sorted(got, key=repr) == sorted([(i, c, 1, 0, 0.0, 0.0, 0.0) for i in (None, 1) for c in (1, 2)], key=repr)
    flat = spark.createDataFrame([(i, [i / 256, 1.0, -1.0]) for i in range(5)], "vec_id long, embedding array<double>")
    r = {(r["vec_id"], r["component"]): r for r in op12.whitening(flat).collect()}
    assert abs(abs(r[0, 1]["whitened"]) - 2 ** .5) < 1e-12 and r[0, 2]["whitened"] == 0 and r[0, 1]["explained"] == 1.0


@pytest.mark.parametrize("seed", range(4))
def test_rank_one_updates(seed):
    """Against numpy's solver: repeated and near-equal eigenvalues, directions inside the old space, tiny and large steps."""
    rng = np.random.default_rng(seed)
    d = 12
    lam = np.sort(np.repeat(rng.uniform(0, 5, 4), 3)) + (0, 1e-15, 1e-9, 0)[seed] * np.arange(d)
    q = np.linalg.qr(rng.normal(size=(d, d)))[0]
    a = q @ np.diag(lam) @ q.T
    for v, rho in ((rng.normal(size=d), 1.0), (q[:, 3] * 4, .5), (np.zeros(d), 1.0), (rng.normal(size=d) * 1e-9, 1.0),
                   (q[:, :2] @ rng.normal(size=2), 2.0), (rng.normal(size=d) * 1e5, 1.0)):
        q, lam = op12.rank_one(q, lam, v, rho)
        a = a + rho * np.outer(v, v)
        size = max(1.0, np.abs(a).max())
        assert np.abs(q @ np.diag(lam) @ q.T - a).max() < 1e-11 * size and np.abs(q.T @ q - np.eye(d)).max() < 1e-12
        assert (np.diff(lam) >= 0).all()


def test_spectra_of_parts_add_up():
    rng = np.random.default_rng(8)
    x = rng.integers(-300, 300, (900, 9))
    x[:, 4] = x[:, 5]  # rank below the dimension
    total = op12.Spectrum(9)
    for part in np.split(x, [1, 4, 300, 650]):
        s = op12.Spectrum(9)
        for chunk in np.array_split(part, 2):
            if len(chunk):
                s.rows(chunk)
        total.other(s)
    c = x - x.mean(axis=0)
    assert total.n == 900 and total.sums == x.sum(axis=0).tolist()
    assert np.abs(total.q @ np.diag(total.lam) @ total.q.T - c.T @ c).max() < 1e-9 * total.lam[-1]


def test_deviations_are_exact_beyond_floats():
    w = op12.Whitening(3, [2 ** 30, 5], np.eye(2), np.ones(2), np.ones(2), 0.0)
    x = np.array([[2 ** 28, -7], [0, 1]])
    assert w.deviations(x) == [(3 * 2 ** 28 - 2 ** 30) ** 2 + 26 ** 2, 2 ** 60 + 4]
