"""op4, op6, op8 against brute force, and their edge cases."""

import hashlib
import re

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from faultline.llm import components, op4_simhash, op6_substring_dedup, op8_exact_dedup

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, _doc string, _kept_text string, component_id int"


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def documents():
    return dict(duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall())


def fingerprint(t):
    w = words(re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
    sh = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    n = [0] * 64
    for x in sh:
        h = xxhash.xxh64(x.encode(), 42).intdigest()
        for b in range(64):
            n[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * n[b] > len(sh))


def smallest_reachable(nodes, linked):
    """{node: smallest node over links} by plain union-find."""
    up = {x: x for x in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {x: find(x) for x in nodes}


def near(ids, fps, t=2):
    a = np.array(fps, dtype=np.uint64)
    return [(ids[i], ids[j]) for i in range(len(ids)) for j in np.flatnonzero(np.bitwise_count(a ^ a[i]) <= t)]


def test_simhash_query(spark):
    docs = documents()
    ids = sorted(docs)
    fps = [fingerprint(docs[i]) for i in ids]
    comp = smallest_reachable(ids, near(ids, fps))
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in op4_simhash.query(spark, SF).collect()}
    assert got == {i: (f"{f:016x}", comp[i]) for i, f in zip(ids, fps)}


def test_simhash_loses_no_link_and_blocks_agree(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2 ** 64 - 1, 60, dtype=np.uint64)
    fps = {int(x) for x in base} | {0, 3, 2 ** 64 - 1}
    for x in base:  # chains of near fingerprints around each
        for _ in range(8):
            x = x ^ np.uint64(1 << int(rng.integers(64))) ^ np.uint64(1 << int(rng.integers(64)))
            fps.add(int(x))
    fps = sorted(fps)
    signed = [f - 2 ** 64 if f >= 2 ** 63 else f for f in fps]
    expect = smallest_reachable(signed, near(signed, fps))
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    for block in (4096, 3):
        got = {r["node"]: r["component"] for r in components.components(
            op4_simhash.links(df, 2, block), "a", "b").collect()}
        assert {x: got.get(x, x) for x in signed} == expect


def test_simhash_edges(spark):
    rows = [(5, None, "a", "b", 1), (3, "", "a", "b", 1), (7, "One two", "a", None, 2), (9, "one TWO", "x", "y", 3),
            (9, "one TWO", "x", "y", 3), (None, "one two", "n", "n", None), (1, "x" * 50_000 + " a b c", "", "", 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = op4_simhash.near_dedup(df)
    assert out.columns == [*df.columns, "_fingerprint", "_component_id", "_keep"]
    kept = sorted((r["_component_id"], r["doc_id"]) for r in out.collect() if r["_keep"])
    assert kept == [(1, 1), (3, 3), (7, 7)]  # one row of each group
    nulls = op4_simhash.near_dedup(spark.createDataFrame(
        [(None, "p q"), (None, "p q"), (4, "r s"), (4, "r s"), (None, "r s")], "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] or -1, r["text"]) for r in nulls if r["_keep"]) == [(-1, "p q"), (4, "r s")]
    got = sorted(((r["doc_id"] or -1), r["_component_id"], r["_fingerprint"]) for r in out.collect())
    low = f"{fingerprint('one two'):016x}"
    assert got == sorted([(5, 3, "0" * 16), (3, 3, "0" * 16), (7, 7, low), (9, 7, low), (9, 7, low), (-1, 7, low),
                          (1, 1, f"{fingerprint('x' * 50_000 + ' a b c'):016x}")])
    assert op4_simhash.near_dedup(df.limit(0)).collect() == []


def brute_substring(docs, n=13):
    first = {}
    for i in sorted(docs):
        w = words(docs[i])
        for k in range(len(w) - n + 1):
            first.setdefault(tuple(w[k:k + n]), i)
    out = {}
    for i, t in docs.items():
        w = words(t)
        gone = set()
        for k in range(len(w) - n + 1):
            if first[tuple(w[k:k + n])] < i:
                gone.update(range(k, k + n))
        out[i] = len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)
    return out


def test_substring_query(spark):
    expect = {i: (a, b, hashlib.sha256(t.encode()).hexdigest()) for i, (a, b, t) in brute_substring(documents()).items()}
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"])
           for r in op6_substring_dedup.query(spark, SF).collect()}
    assert got == expect and sum(x[1] for x in expect.values()) > 0
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    assert {r[0]: tuple(r[1:]) for r in duckdb.sql(op6_substring_dedup.SQL).fetchall()} == expect


def test_substring_of_a_very_long_text(spark):
    """One document of 200,000 words that repeats a passage of an earlier one, and itself."""
    passage = " ".join(f"p{i}" for i in range(60))
    docs = {1: "x y " + passage, 2: " ".join(f"w{i}" for i in range(200_000)) + " " + passage + " end " + passage, 3: passage}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    got = {r["doc_id"]: (r["_n_words"], r["_n_removed"], r["_kept_text"])
           for r in op6_substring_dedup.substring_dedup(df).collect()}
    assert got == brute_substring(docs) and got[2][1] == 120 and got[3][1] == 60


def test_substring_at_factor_borders(spark):
    a, b = [f"a{i}" for i in range(20)], [f"b{i}" for i in range(20)]
    docs = {1: " ".join(a), 2: " ".join(b), 3: " ".join(a[8:] + b[:12]),   # neither part has 13 words
            4: " ".join(a[8:] + b[:13]), 5: " ".join(a[8:] + b[:12]), 6: " ".join(a * 3),
            7: " ".join(a[:12]), 8: "\t".join(a[:13]) + "\n", 9: " ".join(["q"] * 40), 10: " ".join(["q"] * 13)}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    got = {r["doc_id"]: (r["_n_words"], r["_n_removed"], r["_kept_text"])
           for r in op6_substring_dedup.substring_dedup(df).collect()}
    assert got == brute_substring(docs)
    assert got[3][1] == 0 and got[5][1] == 24 and got[9][1] == 0 and got[10][1] == 13


def test_substring_edges(spark):
    t = " ".join(f"w{i}" for i in range(15))
    rows = [(2, t, "a", "b", 1), (2, t, "a", "b", 1), (3, t, None, None, None), (None, t, "c", "d", 2),
            (4, None, "e", "f", 3), (5, "", "g", "h", 4)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = op6_substring_dedup.substring_dedup(df)
    assert out.columns == ["doc_id", "text", "_doc", "component_id", "_n_words", "_n_removed", "_kept_text"]
    got = sorted(((r["doc_id"] or 99), r["_n_words"], r["_n_removed"]) for r in out.collect())
    assert got == [(2, 15, 0), (2, 15, 0), (3, 15, 15), (4, 0, 0), (5, 0, 0), (99, 15, 15)]
    assert op6_substring_dedup.substring_dedup(df.limit(0)).collect() == []


def test_window_hash_pieces():
    w = [f"{i}".encode() for i in range(30)]
    h = op6_substring_dedup.window_hashes(w, 13)
    assert len(h) == 18 and (op6_substring_dedup.window_hashes(w[5:18], 13) == h[5:6]).all()
    s = np.sort(h)
    assert (op6_substring_dedup._from_planes(op6_substring_dedup._planes(s)) == s).all()
    assert (np.diff(op6_substring_dedup.hash_range(s, 7)) >= 0).all()
    assert op6_substring_dedup.factors(np.array([0, 1, 1, 0, 1], bool), 3) == [(1, 4), (4, 3)]


def test_exact_query(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    assert sorted(map(tuple, op8_exact_dedup.query(spark, SF).collect())) == sorted(
        con.execute(op8_exact_dedup.SQL).fetchall())


@pytest.mark.parametrize("digest", [op8_exact_dedup.sha256, lambda c: F.substring(c, 1, 1)])
def test_exact_edges_and_weak_digest(spark, digest):
    schema = "doc_id long, text string, _digest string, _row string, epoch int"
    rows = [(1, "a", "x", "r", 1), (2, "ab", "y", "r", 2), (3, "a", "z", None, 3), (3, "a", "z", "r", 3),
            (None, None, "q", "r", 4), (5, "", "n", "r", 5), (None, "k", "z", "r", 6), (4, "a" + "b" * 100_000, "l", "r", 7)]
    df = spark.createDataFrame(rows, schema)
    out = op8_exact_dedup.exact_dedup(df, digest=digest)
    assert out.columns == ["doc_id", "text", "_row", "epoch", "_digest", "_keep_id", "_group_size", "_kept"]
    got = [(r["doc_id"], (r["text"] or "")[:3], r["_keep_id"], r["_group_size"], r["_kept"]) for r in out.collect()]
    three = [x for x in got if x[0] == 3]
    assert sorted(x[4] for x in three) == [False, True] and {x[2:4] for x in three} == {(3, 3)}
    assert sorted(map(str, (x for x in got if x[0] != 3))) == sorted(map(str, [
        (1, "a", 3, 3, False), (2, "ab", 2, 1, True), (None, "", 5, 2, False), (5, "", 5, 2, True),
        (None, "k", None, 1, True), (4, "abb", 4, 1, True)]))
    kept = op8_exact_dedup.kept_rows(df, digest=digest)
    assert kept.columns == df.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["2", "3", "4", "5", "None"]
    assert op8_exact_dedup.exact_dedup(df.limit(0), digest=digest).collect() == []


def test_components_edges(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (9, 8), (8, 7), (5, 5), (None, 4), (7, 20), (20, 30), (30, 31)],
                              "a long, b long")
    got = {r["node"]: r["component"] for r in components.components(e, "a", "b").collect()}
    assert got == {2: 1, 3: 1, 8: 7, 9: 7, 20: 7, 30: 7, 31: 7}
    assert components.components(e.limit(0), "a", "b").collect() == []


def test_substring_dedup_keeps_no_words_of_a_whole_block():
    """A block's words take several times the room of its texts: only one text
    is split at a time, so memory beyond the hashes does not grow with them."""
    import tracemalloc

    import pyarrow as pa

    from faultline.llm import op6_substring_dedup as op6

    n, each = 400, 500
    texts = [" ".join(f"w{(7 * i + k) % 9973}" for k in range(each)) for i in range(n)]
    rows = pa.table({"_doc": pa.array([{"text": t} for t in texts]), "_id": pa.array(range(n), pa.int64()),
                     "_g": pa.array([0] * n, pa.int32())})
    index = op6._index_block("text", 13, 1)(rows)
    parse, answers = op6._parse_block("text", 13), op6._merge_range(index)
    parse(rows, answers)
    tracemalloc.start()
    parse(rows, answers)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 70 * n * each, peak / (n * each)
