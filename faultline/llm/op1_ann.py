"""Nearest neighbours by a hierarchical k-means tree, searched best bin first.

The tree is fitted on a bounded sample (``SAMPLE`` rows, the first by a hash
of the id): each node's points are split by k-means into ``BRANCH`` children
until a node has ``LEAF`` points or they are all alike. Every vector of the
table then goes down the tree to a leaf. Inner product is made a distance by
one more component, sqrt(M^2 - |x|^2), M the largest norm.

A query keeps a priority queue of tree nodes by distance to their centre. It
takes the nearest; an inner node puts its children into the queue, a leaf is
a visit. Visits widen until the number that calibration found is reached, and
until the leaves visited hold enough vectors. Calibration: the exact nearest
of ``CALIBRATION`` queries among all rows, computed in blocks, give the
number of visits by which ``RECALL`` of them are in a visited leaf.

Neighbouring leaves make a bin of at most about ``VECTORS`` vectors; a larger
leaf is cut into several bins. A query is sent once to each bin that has a
leaf it visits, with the leaves, and a bin's visitors are cut into blocks of
about ``QUERIES``. Each (bin, block) is scored in one task, which keeps the
best k of each query, so neither a leaf that holds a third of all vectors nor
one that every query visits is one task's work. A product of matrices finds
the rows that may be among the best; those are scored anew, in one order of
summing.

Cost: queries and vectors both grow with the table, and the share of leaves
that calibration asks for depends on the data alone (on vectors without any
clusters it is most of them), so the work grows with up to the square.

Edge cases: vectors that are null, zero, hold null or non-finite components,
or whose length is not the table's most common one take no part; null ids
take no part; a row is no neighbour of a row with its own id; a query id that
several rows have is one query, by the first of its vectors; such rows are
several candidates; ties go to the smaller id; with fewer candidates than k, all are returned; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultline.llm.util import stored, table

SAMPLE, BRANCH, LEAF = 20_000, 16, 64
CALIBRATION, RECALL = 200, 0.97
#: Vectors and queries that one task scores against each other.
VECTORS, QUERIES = 8192, 1024
RESULT = "query_id long, vec_id long, score double"


@dataclass
class Tree:
    """Node i has children ``kids[i]`` (none: a leaf) around ``centres[i]``."""
    scale: float
    centres: list[np.ndarray] = field(default_factory=list)
    kids: list[list[int]] = field(default_factory=list)
    leaf_of: dict[int, int] = field(default_factory=dict)

    def lift(self, x: np.ndarray) -> np.ndarray:
        gap = np.sqrt(np.maximum(self.scale ** 2 - (x * x).sum(axis=1), 0))
        return np.concatenate([x, gap[:, None]], axis=1)

    def freeze(self) -> None:
        self.leaf_of = {n: i for i, n in enumerate(n for n, k in enumerate(self.kids) if not k)}
        self.around = {n: np.stack([self.centres[c] for c in k]) for n, k in enumerate(self.kids) if k}

    def assign(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each vector, going down to the nearest child."""
        x, leaf, todo = self.lift(x), np.zeros(len(x), dtype=np.int32), [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if node in self.leaf_of:
                leaf[rows] = self.leaf_of[node]
                continue
            c = self.around[node]
            near = ((c * c).sum(axis=1) - 2 * (x[rows] @ c.T)).argmin(axis=1)
            todo += [(kid, rows[near == i]) for i, kid in enumerate(self.kids[node]) if (near == i).any()]
        return leaf

    def visits(self, q: np.ndarray):
        """Leaves in best-bin-first order."""
        q = np.append(q / np.sqrt((q * q).sum()) * self.scale, 0.0)
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            if node in self.leaf_of:
                yield self.leaf_of[node]
            else:
                d = ((self.around[node] - q) ** 2).sum(axis=1)
                for kid, x in zip(self.kids[node], d.tolist()):
                    heapq.heappush(queue, (x, kid))


def fit_tree(x: np.ndarray, scale: float, branch: int = BRANCH, leaf: int = LEAF, seed: int = 1) -> Tree:
    rng = np.random.default_rng(seed)
    tree = Tree(scale)
    x = tree.lift(x)

    def grow(points: np.ndarray) -> int:
        node = len(tree.kids)
        tree.centres.append(points.mean(axis=0) if len(points) else np.zeros(x.shape[1]))
        tree.kids.append([])
        if len(points) <= leaf:
            return node
        start = np.unique(points[rng.permutation(len(points))[:8 * branch]], axis=0)
        c = start[rng.permutation(len(start))[:branch]]
        for _ in range(8):
            near = ((c * c).sum(axis=1) - 2 * (points @ c.T)).argmin(axis=1)
            c = np.stack([points[near == i].mean(axis=0) for i in range(len(c)) if (near == i).any()])
        near = ((c * c).sum(axis=1) - 2 * (points @ c.T)).argmin(axis=1)
        groups = [points[near == i] for i in range(len(c)) if (near == i).any()]
        if len(groups) > 1:
            tree.kids[node] = [grow(g) for g in groups]
        return node

    grow(x)
    tree.freeze()
    return tree


def scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner product of each pair of rows in double precision, each summed in
    one order: equal vectors score equal."""
    return np.einsum("ij,ij->i", q, x, optimize=False)


def top(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int, allowed: np.ndarray | None = None):
    """Best k (query id, id, score) of each query among the vectors, those
    marked in ``allowed`` (query x vector) if given."""
    out = [], [], []
    slack = 1e-12 * np.sqrt((x * x).sum(axis=1).max(initial=0) * (q * q).sum(axis=1).max(initial=0)) * q.shape[1]
    for lo in range(0, len(q), 128):
        part = slice(lo, lo + 128)
        near = q[part] @ x.T
        near[q_ids[part, None] == ids] = -np.inf
        if allowed is not None:
            near[~allowed[part]] = -np.inf
        if near.shape[1] > k:  # whatever can reach the k-th score, so that ties are cut by id
            least = np.partition(near, near.shape[1] - k, axis=1)[:, near.shape[1] - k]
            who, row = np.nonzero((near >= least[:, None] - slack) & (near > -np.inf))
        else:
            who, row = np.nonzero(near > -np.inf)
        s = np.concatenate([scores(q[part][who[i:i + 65_536]], x[row[i:i + 65_536]])
                            for i in range(0, len(who), 65_536)] or [np.zeros(0)])
        order = np.lexsort((ids[row], -s, who))
        who, row, s = who[order], row[order], s[order]
        first = np.searchsorted(who, np.arange(len(near)))
        keep = np.arange(len(who)) - first[who] < k
        out[0].append(q_ids[part][who[keep]])
        out[1].append(ids[row[keep]])
        out[2].append(s[keep])
    return [np.concatenate([*c, np.zeros(0)]) for c in out]


def _matrix(column, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _result(found):
    import pyarrow as pa

    return [pa.array(found[0].astype(np.int64)), pa.array(found[1].astype(np.int64)), pa.array(found[2])]


def _best(rows: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _usable(df: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, int]:
    v = F.col(vec_col)
    ok = (F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
          & F.exists(v, lambda x: x != 0))
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where(
        F.col(id_col).isNotNull() & F.coalesce(ok, F.lit(False)))
    dim = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.col("count").desc(), "d").first()
    return (rows.where(F.size("v") == dim["d"]), dim["d"]) if dim else (rows, 0)


def bins_of(size: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """For each leaf its first bin and how many it is cut into; the number of bins."""
    first, parts, n, room = np.zeros(len(size), np.int64), np.ones(len(size), np.int64), 0, 0
    for at, held in enumerate(size.tolist()):
        parts[at] = max(-(-held // VECTORS), 1)
        if parts[at] > 1 or held > room or not n:
            first[at], n, room = n, n + parts[at], VECTORS - held if parts[at] == 1 else 0
        else:
            first[at], room = n - 1, room - held
    return first, parts, n


def search(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id",
           vec_col: str = "embedding", recall: float = RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each row whose id (as ``vec_id``) ``is_query``."""
    spark = vectors.sparkSession
    rows, dim = _usable(vectors, id_col, vec_col)
    if not dim:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    scale = float(rows.agg(F.max(norm)).first()[0])
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").toArrow()
    tree = fit_tree(_matrix(sample.column("v").combine_chunks(), dim), scale)
    n_leaves = len(tree.leaf_of)

    def to_leaf(batches):
        import pyarrow as pa

        for b in batches:
            if b.num_rows:
                leaf = tree.assign(_matrix(b.column("v"), dim))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(leaf, pa.int32())], names=["vec_id", "v", "leaf"])

    kind = rows.schema["v"].dataType.simpleString()
    placed = stored(rows.mapInArrow(to_leaf, f"vec_id long, v {kind}, leaf int"), "leaves")
    queries = placed.where(is_query).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("v").alias("v"))

    # Visits by which enough of the exact neighbours of some queries are reached.
    some = queries.orderBy(F.xxhash64("query_id"), "query_id").limit(CALIBRATION).toArrow()
    if not some.num_rows:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    q_ids = some.column("query_id").to_numpy()
    q = _matrix(some.column("v").combine_chunks(), dim)

    def exact(batches):
        import pyarrow as pa

        for b in batches:
            if b.num_rows:
                found = top(q_ids, q, b.column("vec_id").to_numpy(), _matrix(b.column("v"), dim), k)
                yield pa.RecordBatch.from_arrays(_result(found), names=["query_id", "vec_id", "score"])

    near = (_best(placed.select("vec_id", "v").mapInArrow(exact, RESULT), k).select("query_id", "vec_id")
            .join(placed.select("vec_id", "leaf"), on="vec_id").select("query_id", "leaf").toArrow())
    order = {int(i): {leaf: n for n, leaf in enumerate(tree.visits(x))} for i, x in zip(q_ids, q)}
    seen = np.sort([order[i][leaf] for i, leaf in zip(near.column(0).to_pylist(), near.column(1).to_pylist())])
    n_visits = int(seen[int(np.ceil(recall * len(seen))) - 1]) + 1 if len(seen) else n_leaves

    # Vectors in each leaf: as many numbers as the tree has leaves, which the sample bounds.
    size = np.zeros(n_leaves, dtype=np.int64)
    for r in placed.groupBy("leaf").count().collect():
        size[r["leaf"]] = r["count"]
    first, parts, _ = bins_of(size)

    def visit(batches):
        import pyarrow as pa

        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                bin_, who, leaves = [], [], []
                for i, x in enumerate(_matrix(part.column("v"), dim)):
                    held, seen = 0, {}
                    for n, at in enumerate(tree.visits(x)):
                        if n >= n_visits and held > k:
                            break
                        held += size[at]
                        for p in range(parts[at]):
                            seen.setdefault(int(first[at]) + p, []).append(at)
                    bin_ += seen
                    leaves += seen.values()
                    who += [i] * len(seen)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bin_, pa.int32()), part.column("query_id").take(pa.array(who, pa.int64())),
                     pa.array(leaves, pa.list_(pa.int32()))], names=["bin", "query_id", "leaves"])

    visiting = stored(queries.mapInArrow(visit, "bin int, query_id long, leaves array<int>"), "visits")
    per_bin = visiting.groupBy("bin").agg(F.ceil(F.count(F.lit(1)) / QUERIES).cast("int").alias("nq"))

    def to_bin(batches):
        import pyarrow as pa

        for b in batches:
            leaf, ids = b.column("leaf").to_numpy(), b.column("vec_id").to_numpy()
            mixed = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
            at = first[leaf] + (mixed % parts[leaf].astype(np.uint64)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), *b.columns], names=["bin", *b.schema.names])

    binned = placed.mapInArrow(to_bin, f"bin int, vec_id long, v {kind}, leaf int")
    left = (binned.join(per_bin, on="bin")
            .select("bin", F.explode(F.sequence(F.lit(0), F.col("nq") - 1)).alias("qb"), "vec_id", "leaf", "v"))
    right = (visiting.join(per_bin, on="bin").join(queries, on="query_id")
             .select("bin", F.pmod(F.xxhash64("query_id"), F.col("nq")).cast("int").alias("qb"), "query_id", "leaves", "v"))

    def score_block(vecs, visitors):
        import pyarrow as pa

        if not vecs.num_rows or not visitors.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()),
                             "score": pa.array([], pa.float64())})
        leaf = vecs.column("leaf").to_numpy()
        here, place = np.unique(leaf, return_inverse=True)
        asked = visitors.column("leaves").combine_chunks()
        who = np.repeat(np.arange(len(asked)), asked.value_lengths().to_numpy(zero_copy_only=False))
        want = asked.flatten().to_numpy()
        known = np.isin(want, here)
        visited = np.zeros((len(asked), len(here)), bool)
        visited[who[known], np.searchsorted(here, want[known])] = True
        found = top(visitors.column("query_id").to_numpy(), _matrix(visitors.column("v").combine_chunks(), dim),
                    vecs.column("vec_id").to_numpy(), _matrix(vecs.column("v").combine_chunks(), dim), k,
                    None if visited.all() else visited[:, place])
        return pa.table(_result(found), names=["query_id", "vec_id", "score"])

    keys = ["bin", "qb"]
    scored = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(score_block, RESULT)
    return _best(scored, k).select("query_id", "rank", "vec_id", "score")


def query(spark, sf_dir):
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
