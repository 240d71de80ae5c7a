"""Substring dedup by relative Lempel-Ziv parsing against reference blocks.

Documents in ascending id order are cut into blocks (id ranges). Each block
is a reference: its index is the sorted list of the hashes of its windows of
``window`` words. A document is factored, left to right and greedily, against
the indexes of all blocks before its own and the smaller ids of its own block:
a factor starts where the window at that word occurs in any of them and grows
while the next window does too. So a factor is a maximal run of found windows
and may draw on several references; parts that two references have, and the
windows across their border, are each looked up, so none is missed. A factor
of r windows is ``r + window - 1`` words. Factors become spans of removed
words. This departs from parsing against one block's text after another,
which is quadratic in the blocks; equal windows are told by their hashes, and
words are not compared once more.

"Against every block" is one exchange: each block deals its sorted index out
by hash range, a task merges one hash range of all blocks, and a block gets
back one bit for each of its windows (does an earlier block have it?). A
window that a third of all documents share is one entry for each block. The
hashes have 64 bits (13 words: XXH64 of each in a polynomial modulo 2^64).

Edge cases: a null text has no words; ids that are null come after all others
and are not earlier than each other; rows of equal id do not count as earlier
than each other; a very long text is read whole, its windows as numpy arrays;
an empty table gives no rows; an input column with the name
of an output gives way to it.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.llm.util import boxed, id_bounds, id_range, n_parts, table, unboxed

#: Odd multiplier of the window polynomial.
BASE = 0x9E3779B97F4A7C15
NULL_ID = np.iinfo(np.int64).max


def window_hashes(words: list[bytes], window: int) -> np.ndarray:
    """Hash of each run of ``window`` words, by start."""
    import xxhash

    n = len(words) - window + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))
    out = np.zeros(n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for j in range(window):
            out *= np.uint64(BASE)
            out += h[j:j + n]
        # Spread the high bits, by which the index is dealt out.
        out ^= out >> np.uint64(29)
        out *= np.uint64(0xBF58476D1CE4E5B9)
    return out


def words_of(text: str | None) -> list[bytes]:
    """Words: runs of anything but ASCII white space."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def hash_range(h: np.ndarray, parts: int) -> np.ndarray:
    """Which of ``parts`` equal hash ranges, ascending with the hash."""
    return ((h >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _planes(h: np.ndarray) -> bytes:
    """Sorted hashes, byte by byte of significance: their like leading bytes compress."""
    return h.astype(">u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _from_planes(b: bytes) -> np.ndarray:
    return np.frombuffer(b, np.uint8).reshape(8, -1).T.copy().view(">u8").ravel().astype(np.uint64)


def factors(found: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Greedy factors (first word, number of words): the maximal runs of found windows."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], found.astype(np.int8), [0]])))
    return [(int(a), int(b - a) + window - 1) for a, b in zip(edge[::2], edge[1::2])]


def _texts(rows, text_col: str):
    """The texts one after another: they stay in Arrow, one at a time is a Python object."""
    import pyarrow.compute as pc

    return (t.as_py() for t in pc.struct_field(rows.column("_doc"), text_col))


def _index_block(text_col: str, window: int, parts: int):
    def run(rows):
        import pyarrow as pa

        seen = [window_hashes(words_of(t), window) for t in _texts(rows, text_col)]
        u = np.unique(np.concatenate(seen)) if seen else np.zeros(0, np.uint64)
        p = hash_range(u, parts)
        at = np.searchsorted(p, np.arange(parts + 1))
        have = np.flatnonzero(np.diff(at))
        g = rows.column("_g")[0].as_py()
        return pa.table({
            "p": pa.array(have.astype(np.int32)),
            "g": pa.array(np.full(len(have), g, np.int32)),
            "h": pa.array([_planes(u[at[i]:at[i + 1]]) for i in have], pa.binary())})

    return run


def _merge_range(rows):
    """For one hash range: of each block's entries, which an earlier block has."""
    import pyarrow as pa

    g = rows.column("g").to_numpy()
    order = np.argsort(g, kind="stable")
    blobs = rows.column("h").to_pylist()
    lists = [_from_planes(blobs[i]) for i in order]
    sizes = np.array([len(x) for x in lists])
    h = np.concatenate(lists)
    by = np.argsort(h, kind="stable")  # equal hashes stay in block order
    again = np.zeros(len(h), bool)
    again[by[1:]] = h[by[1:]] == h[by[:-1]]
    bits = [np.packbits(x).tobytes() for x in np.split(again, np.cumsum(sizes)[:-1])]
    return pa.table({"g": pa.array(g[order].astype(np.int32)), "p": rows.column("p").take(pa.array(order)),
                     "n": pa.array(sizes.astype(np.int64)), "bits": pa.array(bits, pa.binary())})


def _parse_block(text_col: str, window: int):
    def run(rows, answers):
        import pyarrow as pa

        # The words of a block take many times the room of its texts, so none are
        # kept: the texts are split a second time when their hashes are looked up.
        ids = rows.column("_id").fill_null(int(NULL_ID)).to_numpy()
        hashes = [window_hashes(words_of(t), window) for t in _texts(rows, text_col)]
        sizes = np.array([len(x) for x in hashes], dtype=np.int64)
        h = np.concatenate(hashes)
        del hashes
        found = np.zeros(0, bool)
        if len(h):
            u, inv = np.unique(h, return_inverse=True)
            del h
            of = np.repeat(ids, sizes)
            first = np.full(len(u), NULL_ID)
            np.minimum.at(first, inv, of)
            order = np.argsort(answers.column("p").to_numpy())
            n, bits = answers.column("n").to_numpy()[order], answers.column("bits").to_pylist()
            earlier = np.concatenate([np.unpackbits(np.frombuffer(bits[i], np.uint8), count=int(c))
                                      for i, c in zip(order, n)]).astype(bool)
            found = earlier[inv] | (first[inv] < of)
            del u, inv, of, first, earlier
        kept, removed, n_words = [], [], []
        for t, f in zip(_texts(rows, text_col), np.split(found, np.cumsum(sizes)[:-1])):
            w = words_of(t)
            n_words.append(len(w))
            keep = np.ones(len(w), bool)
            for at, length in factors(f, window):
                keep[at:at + length] = False
            removed.append(len(w) - int(keep.sum()))
            kept.append(b" ".join(compress(w, keep)).decode("utf-8", "surrogatepass"))
        return pa.table({"_doc": rows.column("_doc"),
                         "_n_words": pa.array(n_words, pa.int64()),
                         "_n_removed": pa.array(removed, pa.int64()),
                         "_kept_text": pa.array(kept, pa.string())})

    return run


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    window: int = 13) -> DataFrame:
    """``docs`` plus ``_n_words``, ``_n_removed`` and ``_kept_text`` (kept words, single-spaced)."""
    n = n_parts(docs.sparkSession)
    parts = n
    rows = docs.select(boxed(docs), F.col(id_col).cast("long").alias("_id"))
    # Two blocks a partition even out, and blocks times ranges stay few rows; both passes below read this one exchange.
    blocks = (rows.withColumn("_g", id_range("_id", id_bounds(docs, id_col, 2 * n)))
              .repartition(n, "_g"))
    index = blocks.groupBy("_g").applyInArrow(_index_block(text_col, window, parts), "p int, g int, h binary")
    answers = index.groupBy("p").applyInArrow(_merge_range, "g int, p int, n long, bits binary")
    schema = T.StructType([rows.schema["_doc"], T.StructField("_n_words", T.LongType()),
                           T.StructField("_n_removed", T.LongType()), T.StructField("_kept_text", T.StringType())])
    parsed = (blocks.groupBy("_g").cogroup(answers.withColumnRenamed("g", "_g").groupBy("_g"))
              .applyInArrow(_parse_block(text_col, window), schema))
    return unboxed(parsed, docs, {c: F.col(c) for c in ("_n_words", "_n_removed", "_kept_text")})


def query(spark, sf_dir):
    r = substring_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return r.select("doc_id", F.col("_n_words").alias("n_words"), F.col("_n_removed").alias("n_removed"),
                    F.sha2("_kept_text", 256).alias("kept_sha256"))


SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
),
win AS (
  SELECT doc_id, k, array_to_string(ws[k:k + 12], ' ') AS passage
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS k FROM w)
),
first AS (SELECT passage, min(doc_id) AS first_id FROM win GROUP BY passage),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(k, k + 13)) AS p FROM win JOIN first USING (passage) WHERE first_id < doc_id
),
word AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM w),
left_over AS (
  SELECT doc_id, count(g.p) AS n_removed, string_agg(word, ' ' ORDER BY p) FILTER (WHERE g.p IS NULL) AS kept
  FROM word LEFT JOIN gone g USING (doc_id, p) GROUP BY doc_id
)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN left_over l ON l.doc_id = w.doc_id
"""
