"""SimHash near-duplicates through anchors of a covering code.

Fingerprint: ASCII-lower-cased words, k-word shingles with repeats (fewer
words: the whole sequence), XXH64 with seed 42 of each; a bit is set if it is
set in more than half of them. No words: zero.

Links: the anchors are the 2^16 words of a fixed linear code of length 64.
Each distinct fingerprint x has a home, its nearest anchor, at distance r(x)
(its own covering radius). It is copied to every anchor within r(x) + t, and
at each anchor the homes are compared with the visitors. No link is lost: of
x and y at distance <= t let r(x) <= r(y); then y is within r(x) + t <= r(y) + t
of x's home. The proof needs no bound on r, so it holds for any code.

An anchor's visitors are split into blocks of bounded size, and each pair of
blocks is compared in one task, which returns a spanning forest of the links
it finds and not the links themselves: few rows, same components.

Edge cases: a null or empty text has fingerprint zero and is linked like any
other; null ids take part, but a component is named by its smallest id that
is not null; repeated rows get the same answer, but only one of them is kept; a
very long text is read whole, in one pass over its words; an empty table gives no rows;
an input column with the name of an output gives way to it.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.components import components
from faultline.llm.util import boxed, n_parts, stored, table, unboxed

#: Generator seed and dimension of the anchor code.
CODE_SEED, CODE_DIM = 20, 16
#: Homes and visitors that one task compares at once.
BLOCK = 4096


def anchors(dim: int = CODE_DIM, seed: int = CODE_SEED) -> np.ndarray:
    """All words of the binary linear code with ``dim`` random generators."""
    rows = np.random.default_rng(seed).integers(0, 2 ** 64 - 1, dim, dtype=np.uint64, endpoint=True)
    code = np.zeros(1, dtype=np.uint64)
    for g in rows:
        code = np.concatenate([code, code ^ g])
    return code


def fingerprint(text: str | None, k: int = 3) -> int:
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < k:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*[words[i:] for i in range(k)]))
    h = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(42)), dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(h), 1 << 16):  # bit counts of 65,536 hashes at a time
        bits = np.unpackbits(h[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text_col: str = "text", k: int = 3) -> DataFrame:
    """``docs`` boxed as ``_doc``, with ``_fp`` (the fingerprint's bits as a long)."""
    from pyspark.sql import types as T

    def run(batches):
        import pyarrow as pa

        for b in batches:
            fps = np.array([fingerprint(t, k) for t in b.column("_doc").field(text_col).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column("_doc"), pa.array(fps.view(np.int64))], names=["_doc", "_fp"])

    rows = docs.select(boxed(docs))
    schema = T.StructType([rows.schema["_doc"], T.StructField("_fp", T.LongType())])
    return rows.mapInArrow(run, schema)


def _visits(fps: DataFrame, t: int) -> DataFrame:
    """(anchor, fp, home): every anchor that a distinct fingerprint visits."""
    def run(batches):
        import pyarrow as pa

        code = anchors()
        for b in batches:
            fp = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            at, who, home = [], [], []
            for i, x in enumerate(fp):
                d = np.bitwise_count(code ^ x)
                r = int(d.argmin())
                near = np.nonzero(d <= d[r] + t)[0]
                at.append(near)
                who.append(np.full(len(near), i))
                home.append(near == r)
            if at:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(at).astype(np.int32)),
                     pa.array(fp[np.concatenate(who)].view(np.int64)),
                     pa.array(np.concatenate(home))], names=["anchor", "fp", "home"])

    return fps.mapInArrow(run, "anchor int, fp long, home boolean")


def forest(homes: np.ndarray, visitors: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest (node, root) of the links between homes and visitors."""
    nodes = np.unique(np.concatenate([homes, visitors]))
    label = np.arange(len(nodes))
    h, v = np.searchsorted(nodes, homes), np.searchsorted(nodes, visitors)
    links = []
    step = max(1, (1 << 21) // max(1, len(visitors)))
    for s in range(0, len(homes), step):
        i, j = np.nonzero(np.bitwise_count(homes[s:s + step, None] ^ visitors[None, :]) <= t)
        a, b = h[s + i], v[j]
        a, b = a[a != b], b[a != b]
        # A home takes the smallest label around it; later rounds finish the rest.
        if len(a):
            links.append(np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1))
            if sum(x.shape[1] for x in links) > 1 << 20:
                links = [_thin(np.concatenate(links, axis=1), label)]
    if links:
        _thin(np.concatenate(links, axis=1), label)
    out = np.nonzero(label != np.arange(len(nodes)))[0]
    return nodes[out], nodes[label[out]]


def _thin(pairs: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Join labels along the pairs (in place); returns the forest as pairs."""
    a, b = pairs
    while True:
        la, lb = label[a], label[b]
        lo, hi = np.minimum(la, lb), np.maximum(la, lb)
        if (lo == hi).all():
            break
        np.minimum.at(label, hi, lo)
        while True:
            up = label[label]
            if (up == label).all():
                break
            label[:] = up
    at = np.nonzero(label != np.arange(len(label)))[0]
    return np.stack([label[at], at])


def links(fps: DataFrame, t: int = 2, block: int = BLOCK) -> DataFrame:
    """Links (a, b) that join the same fingerprints as all pairs at distance
    <= t do. ``fps``: one long column, distinct."""
    # Visiting costs far more than reading: dealt out evenly, not by file.
    visits = stored(_visits(fps.repartition(n_parts(fps.sparkSession)), t), "visits")
    # At most 2^CODE_DIM rows of three numbers, whatever the corpus: broadcast.
    sizes = visits.groupBy("anchor").agg(
        F.ceil(F.sum(F.col("home").cast("int")) / block).cast("int").alias("nh"),
        F.ceil(F.count(F.lit(1)) / block).cast("int").alias("nv"))
    v = visits.join(F.broadcast(sizes.where("nh > 0")), on="anchor")
    # Home blocks meet visitor blocks; nearly always there is one of each.
    own = v.where("home").select("anchor", "fp", F.lit(True).alias("home"),
                                 F.pmod(F.xxhash64("fp"), F.col("nh")).cast("int").alias("hb"),
                                 F.explode(F.sequence(F.lit(0), F.col("nv") - 1)).alias("vb"))
    come = v.select("anchor", "fp", F.lit(False).alias("home"),
                    F.explode(F.sequence(F.lit(0), F.col("nh") - 1)).alias("hb"),
                    F.pmod(F.xxhash64("fp"), F.col("nv")).cast("int").alias("vb"))
    both = own.unionByName(come).select("anchor", "hb", "vb", "home", "fp")
    n = n_parts(fps.sparkSession)
    dealt = both.repartition(n, "anchor", "hb", "vb").sortWithinPartitions("anchor", "hb", "vb")

    def compare(batches):
        import pyarrow as pa

        def runs():
            """Each (anchor, hb, vb) with its rows, over batch borders."""
            held, key = [], None
            for b in batches:
                cols = [b.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
                ks = np.stack(cols[:3], axis=1)
                cut = np.nonzero((ks[1:] != ks[:-1]).any(axis=1))[0] + 1
                for lo, hi in zip([0, *cut], [*cut, len(ks)]):
                    if lo == hi:
                        continue
                    k = tuple(ks[lo])
                    if k != key and held:
                        yield held
                        held = []
                    key = k
                    held.append((cols[3][lo:hi], cols[4][lo:hi]))
            if held:
                yield held

        a, b, n_out = [], [], 0
        for rows in runs():
            home = np.concatenate([x[0] for x in rows]).astype(bool)
            fp = np.concatenate([x[1] for x in rows]).view(np.uint64)
            if home.any() and not home.all():
                node, root = forest(fp[home], fp[~home], t)
                a.append(node.view(np.int64))
                b.append(root.view(np.int64))
                n_out += len(node)
            if n_out > 100_000:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (a, b)], names=["a", "b"])
                a, b, n_out = [], [], 0
        if n_out:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (a, b)], names=["a", "b"])

    return dealt.mapInArrow(compare, "a long, b long")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               k: int = 3, t: int = 2) -> DataFrame:
    """``docs`` plus ``_fingerprint`` (16 hex digits), ``_component_id`` (the
    smallest id reachable over links of at most ``t`` differing bits) and
    ``_keep``: true for one row of each component, that of the smallest id
    (null ids last; of several, the first by its place in the stored rows)."""
    rows = stored(fingerprints(docs, text_col, k), "fingerprints")
    at = F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    rows = rows.select("_doc", "_fp", at.alias("_at"))
    doc_id = F.col("_doc").getField(id_col)
    first = F.struct(doc_id.isNull().alias("none"), doc_id.alias("id"), F.col("_at").alias("at"))
    distinct = stored(rows.groupBy("_fp").agg(F.min(first).alias("_first")), "distinct-fingerprints")
    found = components(links(distinct.select("_fp"), t), "a", "b")
    named = distinct.join(found.withColumnRenamed("node", "_fp"), on="_fp", how="left") \
        .withColumn("_c", F.coalesce("component", "_fp"))
    lows = named.groupBy("_c").agg(F.min("_first").alias("_best"))
    answer = named.join(lows, on="_c").select("_fp", "_best")
    out = rows.join(answer, on="_fp")
    return unboxed(out, docs, {"_fingerprint": F.lower(F.lpad(F.hex("_fp"), 16, "0")),
                               "_component_id": F.col("_best.id"), "_keep": F.col("_at") == F.col("_best.at")})


def query(spark, sf_dir):
    r = near_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return r.select("doc_id", F.col("_fingerprint").alias("fingerprint"), F.col("_component_id").alias("component_id"))
