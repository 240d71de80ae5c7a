"""op13: held-out accuracy, the discriminant against a plain computation, edges."""

import zlib

import duckdb
import numpy as np
from pyspark.sql import functions as F

from faultline.llm import op13_quality as op13
from faultline.llm.util import table

SF = "/root/testdata/sf0.01"


def test_quality_of_held_out_documents(spark):
    got = {r["doc_id"]: r for r in op13.query(spark, SF).collect()}
    docs = duckdb.sql(f"select count(*) from '{SF}/documents.parquet'").fetchall()[0][0]
    assert len(got) == docs
    for i, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3)
    truth = dict(duckdb.sql(f"select doc_id, max(quality) from '{SF}/labels.parquet' group by 1").fetchall())
    held = [(truth[i], r["score"], r["predicted"]) for i, r in got.items() if r["held_out"] and i in truth]
    good, bad = [s for y, s, _ in held if y], [s for y, s, _ in held if not y]
    assert len(held) > 50 and bad
    auc = np.mean([(a > b) + (a == b) / 2 for a in good for b in bad])
    assert auc > 0.97 and np.mean([y == p for y, _, p in held]) > 0.95
    assert np.mean([p for y, _, p in held if y]) > 0.97  # clean documents stay


def test_held_out_labels_are_not_learnt(spark):
    docs, labels = (table(spark, SF, t) for t in ("documents", "labels"))
    a = op13.fit(docs, labels)
    turned = labels.withColumn("quality", F.when(op13.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    b = op13.fit(docs, turned)
    assert np.allclose(a.slope, b.slope) and np.allclose(a.means[0], b.means[0]) and np.allclose(a.factors[1], b.factors[1])


def test_discriminant_by_hand(spark):
    """Moments of many partitions, shrunk covariances and Mahalanobis distances without factors."""
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    model = op13.fit(docs.repartition(40), labels)
    known = dict(duckdb.sql(f"select doc_id, max(quality) from '{SF}/labels.parquet' group by 1").fetchall())
    rows = [(known[i], op13.statistics(t)) for i, t in
            duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall()
            if i in known and zlib.crc32(str(i).encode()) % 5]
    f, y = np.array([r[1] for r in rows]), np.array([r[0] for r in rows])
    std = f.std(axis=0)
    z = (f - f.mean(axis=0)) / np.where(std > 1e-9, std, 1)
    log = []
    for c in (0, 1):
        part = z[y == c]
        cov = op13.shrunk(np.cov(part.T, bias=True), len(part))
        gap = z - part.mean(axis=0)
        log.append(-.5 * np.einsum("ij,ij->i", gap @ np.linalg.inv(cov), gap) - .5 * np.linalg.slogdet(cov)[1])
    want = log[1] - log[0]
    assert np.allclose(model.difference(f), want, rtol=1e-6, atol=1e-6 * np.abs(want).max())


def test_shrinkage():
    rng = np.random.default_rng(0)
    true = np.diag([4.0, 1.0, .25, .1])
    few, many = (np.cov((rng.normal(size=(n, 4)) @ np.sqrt(true)).T, bias=True) for n in (6, 20_000))
    assert np.linalg.eigvalsh(op13.shrunk(few, 6))[0] > np.linalg.eigvalsh(few)[0]
    assert np.abs(op13.shrunk(many, 20_000) - many).max() < .01
    assert np.linalg.eigvalsh(op13.shrunk(np.zeros((4, 4)), 1))[0] > 0  # one text, or copies of one


def test_statistics_of_odd_texts():
    empty = op13.statistics(None)
    assert empty == op13.statistics("") == op13.statistics(" \n\t") and len(empty) == len(op13.NAMES)
    for text in ("a", "\x1c", " x ", "\ud800", "é" * 10, "| | |", "word " * 300_000, "x" * 2_000_000, "1\n1\n1"):
        s = op13.statistics(text)
        assert len(s) == len(op13.NAMES) and np.isfinite(s).all(), text[:5]
    name = dict(zip(op13.NAMES, op13.statistics("ab ab AB 12! |")))
    assert name["words"] == np.log1p(5) and np.isclose(name["upper"], np.log(1e-3 + 2 / 6))
    assert np.isclose(name["repeats"], np.log(1e-3 + 1 / 5)) and np.isclose(name["shouts"], np.log(1e-3 + 1 / 5))
    assert np.isclose(name["lone_symbols"], np.log(1e-3 + 1 / 5)) and np.isclose(name["longest_word"], np.log1p(3))


def test_quality_edges(spark):
    docs = spark.createDataFrame([(1, "fine words here", "q"), (1, "fine words here", "q"), (2, None, "q"), (3, "", "q"),
                                  (None, "more of it", "q")], "doc_id long, text string, _score string")
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, None), (None, 1)], "doc_id long, quality int")
    rows = op13.score(docs, op13.fit(docs, labels)).collect()
    assert len(rows) == 5 and {r["_score"] for r in rows} == {1.0}  # no bad ones among the labels
    assert all(r["_held_out"] is False for r in rows if r["doc_id"] is None)
    for none in (labels.limit(0), labels.where("quality is null")):
        assert {r["_score"] for r in op13.score(docs, op13.fit(docs, none)).collect()} == {0.0}
    assert op13.score(docs.limit(0), op13.fit(docs.limit(0), labels)).collect() == []
    both = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id long, quality int")
    scored = {r["doc_id"]: r["_score"] for r in op13.score(docs, op13.fit(docs, both)).collect()}
    assert scored[1] > scored[3] and scored[2] == scored[3]
