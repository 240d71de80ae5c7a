"""Hard negatives by anchor-clustered shared lists.

Vectors become whole numbers x = floor(256 c); a row's score is its exact
inner product with the anchor. Anchors are clustered by angle (spherical
k-means). For an anchor u of the cluster with centre c and radius b (the
largest angle of a member to c), no row x scores above
|u| |x| cos(max(0, angle(x, c) - b)). Within a block of rows each cluster
sorts the rows by that bound once, and every member walks this shared list
until the bound times its own norm falls below what it still needs: then no
row further down can enter its result, and the walk ends, certified.

Two such walks: for the positives (best rows of the anchor's label), then for
the negatives (best rows of other labels whose score lies in a band of each
positive's score; one walk serves all positives of an anchor). Each walk goes
over the blocks in two waves: a sixteenth of them first, whose k-th best
scores are what rows of the other blocks must reach, so that little is sent
on from them. The answer is exact at every size; where angles prune nothing
(random directions) a walk is a blocked product of matrices.

Rows are dealt out by (block, group of clusters): a block has at most
``MAX_ROWS`` rows by a hash of the id, a group at most about as many anchors,
a large cluster being split over several groups. So a task holds a bounded
part of both, and no side is broadcast. The centres are fitted on a bounded
sample (the ``SAMPLE`` anchors first by a hash of the id); they and the radii
are what comes to the driver.

Edge cases: rows with a null id, null label, null or empty vector, or a null
or non-finite component take no part, nor do vectors of another length than
most have (ties: the longer). Several rows of one id count as one, the first
by label, length and vector. Ties in score go to the smaller id. A zero
vector scores 0 with all. An anchor without positives, and a positive with
no row in its band (such as any of negative score), give no rows. Scores
beyond 64 bits raise an error. An empty table gives no rows. Only the three
columns named are read, so others may have any name; there is no text.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.llm.util import n_parts, stored, table
from faultline.llm.vectors import main_dimension, on_grid, unpack

POSITIVES, NEGATIVES = 5, 10
#: Band of a negative's score, in percent of the positive's.
LOW, HIGH = 30, 90
#: Anchors that the centres are fitted on, and how many centres there are at most.
SAMPLE, CENTRES = 4_096, 64
#: Rows of a block and anchors of a group at most; rows worth a task of their own.
MAX_ROWS, TASK_ROWS = 262_144, 8_192
#: One block in so many belongs to the first wave.
FIRST_WAVE = 16
LEAST, MOST = -(2 ** 63), 2 ** 63 - 1


def _unit(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of length 1 (zero vectors stay zero) and their norms."""
    x = x.astype(np.float64)
    norm = np.sqrt((x * x).sum(axis=1))
    return x / np.where(norm > 0, norm, 1)[:, None], norm


def fit_centres(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Unit centres of at most k clusters of directions (spherical k-means,
    started from rows at equal steps)."""
    u, norm = _unit(x)
    u = np.unique(u[norm > 0], axis=0)
    if not len(u):
        return np.zeros((1, x.shape[1]))
    centres = u[np.linspace(0, len(u) - 1, min(k, len(u))).astype(int)]
    for _ in range(rounds):
        at = (u @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, at, u)
        sums, size = _unit(sums)
        centres = np.where(size[:, None] > 0, sums, centres)
    return centres


def _angles(u: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(u @ centres.T, -1, 1))


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole-number rows."""
    top = (int(np.abs(a).max(initial=0)) + 1) * (int(np.abs(b).max(initial=0)) + 1) * a.shape[1]
    if top < 2 ** 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if top >= 2 ** 63:
        raise OverflowError("an inner product is too large for 64 bits")
    return a.astype(np.int64) @ b.astype(np.int64).T


class _Best:
    """The k best (score, id) of every place so far, and the score each still asks for."""

    def __init__(self, ask: np.ndarray, k: int):
        self.ask, self.k = ask.copy(), k
        self.place = np.zeros(0, np.int64)
        self.score, self.id = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, place: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(place):
            return
        place = np.concatenate([self.place, place])
        score, ids = np.concatenate([self.score, score]), np.concatenate([self.id, ids])
        order = np.lexsort((ids, -score, place))
        place = place[order]
        first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
        rank = np.arange(len(place)) - np.repeat(first, np.diff(np.append(first, len(place))))
        keep = rank < self.k
        self.place, self.score, self.id = place[keep], score[order][keep], ids[order][keep]
        full = rank[keep] == self.k - 1
        np.maximum.at(self.ask, self.place[full], self.score[full])


def walk(x: np.ndarray, own: np.ndarray, label: np.ndarray, lo: np.ndarray, hi: np.ndarray, ask: np.ndarray,
         rows: np.ndarray, ids: np.ndarray, labels: np.ndarray, bound: np.ndarray, same: bool, k: int) -> _Best:
    """Members of one cluster walk one list. ``x``: members; ``lo``, ``hi``,
    ``ask`` (member x place): band and least score of each of its results;
    ``rows``: the list, sorted by falling ``bound`` (for members of norm 1)."""
    best = _Best(np.maximum(ask, lo).ravel(), k)
    places = lo.shape[1]
    open_ = lo <= hi
    norm = np.sqrt((x.astype(np.float64) ** 2).sum(axis=1)) * (1 + 1e-9)
    ceiling = np.where(open_, hi, LEAST).max(axis=1)
    at, step = 0, 512
    while at < len(rows):
        asks = best.ask.reshape(-1, places)
        need = np.where(open_, asks, MOST).min(axis=1)
        live = np.flatnonzero(open_.any(axis=1) & (norm * bound[at] >= need))
        if not len(live):
            break  # certified: no later row reaches what any member asks for
        s = _products(x[live], rows[at:at + step])
        ok = (labels[at:at + step] == label[live, None]) == same
        ok &= (s >= need[live, None]) & (s <= ceiling[live, None]) & (ids[at:at + step] != own[live, None])
        r, c = np.nonzero(ok)
        found, who, which = s[r, c], live[r], ids[at + c]
        for p in range(places):
            fits = (found >= asks[who, p]) & (found <= hi[who, p]) & open_[who, p]
            best.add(who[fits] * places + p, found[fits], which[fits])
        at, step = at + step, min(2 * step, 8_192)
    return best


def _matrix(column, places: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, places)


def _walked(anchors: DataFrame, rows: DataFrame, centres: np.ndarray, radius: np.ndarray, dim: int, same: bool,
            k: int, places: int) -> DataFrame:
    """Results (anchor, place, score, id) of every anchor in every block."""
    def task(key, left, right):
        import pyarrow as pa

        out = ([], [], [], [])
        if left.num_rows and right.num_rows:
            cand, ids = unpack(right.column("_x").combine_chunks(), dim), right.column("_id").to_numpy()
            labels = right.column("_label").to_numpy()
            u, norm = _unit(cand)
            own, cluster = left.column("_id").to_numpy(), left.column("_cluster").to_numpy()
            x, label = unpack(left.column("_x").combine_chunks(), dim), left.column("_label").to_numpy()
            lo, hi, ask = (_matrix(left.column(c), places) for c in ("_lo", "_hi", "_ask"))
            for c in np.unique(cluster):
                angle = _angles(u, centres[c:c + 1])[:, 0]
                bound = norm * np.cos(np.maximum(0, angle - radius[c])) * (1 + 1e-9) + 1e-9
                order = np.argsort(-bound, kind="stable")  # once for all members
                mine = np.flatnonzero(cluster == c)
                shared = cand[order], ids[order], labels[order], bound[order]
                for a in range(0, len(mine), 512):
                    m = mine[a:a + 512]
                    best = walk(x[m], own[m], label[m], lo[m], hi[m], ask[m], *shared, same, k)
                    for o, v in zip(out, (own[m[best.place // places]], best.place % places, best.score, best.id)):
                        o.append(v)
        cols = [np.concatenate([*o, np.zeros(0, np.int64)]).astype(np.int64) for o in out]
        return pa.table(dict(zip(("_anchor", "_place", "_score", "_id"), map(pa.array, cols))))

    kind = "_anchor long, _place long, _score long, _id long"
    keys = ("_block", "_group")
    return anchors.groupBy(*keys).cogroup(rows.groupBy(*keys)).applyInArrow(task, kind)


def _top(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("_anchor", "_place").orderBy(F.col("_score").desc(), "_id")
    return found.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= k)


def _search(anchors: DataFrame, rows: DataFrame, blocks: int, groups: int, k: int, places: int, **how) -> DataFrame:
    """The k best rows of every (anchor, place), in two waves over the blocks."""
    early = F.col("_block") % FIRST_WAVE == 0
    every = F.sequence(F.lit(0), F.lit(blocks - 1))

    def wave(who: DataFrame, first: bool) -> DataFrame:
        cond = early if first else ~early
        left = who.withColumn("_block", F.explode(every)).where(cond)
        right = rows.where(cond).withColumn("_group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
        return _walked(left, right, k=k, places=places, **how)

    one = stored(_top(wave(anchors, True), k), "hard-negatives-wave")
    asks = (one.where(F.col("_rank") == k).groupBy(F.col("_anchor").alias("_id"))
            .agg(F.map_from_entries(F.collect_list(F.struct("_place", "_score"))).alias("_known")))  # one entry a place
    slots = F.sequence(F.lit(0).cast("long"), F.lit(places - 1).cast("long"))
    asked = F.transform(slots, lambda p: F.greatest(
        F.element_at("_ask", (p + 1).cast("int")), F.coalesce(F.try_element_at("_known", p), F.lit(LEAST))))
    later = anchors.join(asks, on="_id", how="left").withColumn("_ask", asked).drop("_known")
    return _top(one.drop("_rank").unionByName(wave(later, False)), k)


def _groups(sizes: dict[int, int]) -> tuple[dict[int, int], dict[int, int], int]:
    """For each cluster its first group and how many it is split over; the number of groups."""
    first, parts, used, room = {}, {}, 0, 0
    for c, n in sorted(sizes.items()):
        parts[c] = -(-n // MAX_ROWS)
        if parts[c] > 1 or n > room:
            first[c], used, room = used, used + parts[c], (MAX_ROWS - n if parts[c] == 1 else 0)
        else:
            first[c], room = used - 1, room - n
    return first, parts, used


def hard_negatives(df: DataFrame, is_anchor: Column, id_col: str = "vec_id", label_col: str = "label",
                   vector_col: str = "embedding", n_positives: int = POSITIVES, n_negatives: int = NEGATIVES,
                   low: int = LOW, high: int = HIGH) -> DataFrame:
    """For each anchor (rows where ``is_anchor``, over the column ``_id``) and each of its
    positives the best negatives: anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    spark = df.sparkSession
    known = df.select(F.col(f"`{id_col}`").cast("long").alias("_id"), F.col(f"`{label_col}`").cast("long").alias("_label"),
                      F.col(f"`{vector_col}`").alias("_vector"))
    known = known.where(F.col("_id").isNotNull() & F.col("_label").isNotNull())
    one = on_grid(known, "_vector", ["_id", "_label"]).groupBy("_id").agg(F.min(F.struct("_label", "_dim", "_x")).alias("_r"))
    rows = stored(one.select("_id", "_r.*"), "hard-negatives-rows")
    dim, n = main_dimension(rows)
    blocks = max(-(-n // MAX_ROWS), min(n_parts(spark), -(-n // TASK_ROWS)), 1)
    block = F.pmod(F.xxhash64("_id", F.lit(11)), F.lit(blocks)).cast("int")
    rows = rows.where(F.col("_dim") == dim).select("_id", "_label", "_x", block.alias("_block"))

    anchors = rows.where(is_anchor).drop("_block")
    sample = anchors.orderBy(F.xxhash64("_id"), "_id").limit(SAMPLE).select("_x").collect()
    centres = fit_centres(unpack([bytes(r[0]) for r in sample], dim), min(CENTRES, max(1, len(sample) // 32)))

    def placed(batches):
        import pyarrow as pa

        for b in batches:
            angle = _angles(_unit(unpack(b.column("_x"), dim))[0], centres)
            near = angle.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(near.astype(np.int32)), pa.array(angle[np.arange(len(near)), near])],
                names=[*b.schema.names, "_cluster", "_angle"])

    kind = T.StructType([*anchors.schema, T.StructField("_cluster", T.IntegerType()), T.StructField("_angle", T.DoubleType())])
    anchors = stored(anchors.mapInArrow(placed, kind), "hard-negatives-anchors")
    # One row a cluster, CENTRES at most.
    seen = anchors.groupBy("_cluster").agg(F.max("_angle").alias("b"), F.count(F.lit(1)).alias("n")).collect()
    radius = np.zeros(len(centres))
    radius[[r["_cluster"] for r in seen]] = [r["b"] + 1e-9 for r in seen]
    first, parts, groups = _groups({r["_cluster"]: r["n"] for r in seen})
    lists = [F.array(*[F.lit(d.get(c, 1 if d is parts else 0)) for c in range(len(centres))]) for d in (first, parts)]
    at, split = (F.element_at(a, F.col("_cluster") + 1) for a in lists)
    anchors = anchors.withColumn("_group", at + F.pmod(F.xxhash64("_id"), split).cast("int")).drop("_angle")
    how = dict(centres=centres, radius=radius, dim=dim)

    def column(value) -> Column:
        return F.array(F.lit(value).cast("long"))

    free = anchors.withColumns({"_lo": column(LEAST), "_hi": column(MOST), "_ask": column(LEAST)})
    best = _search(free, rows, blocks, max(groups, 1), n_positives, 1, same=True, **how)
    best = stored(best.select("_anchor", "_rank", F.col("_id").alias("_positive"), F.col("_score").alias("_p")),
                  "hard-negatives-positives")

    lists = best.groupBy("_anchor").agg(F.array_sort(F.collect_list(F.struct("_rank", "_p"))).alias("_ps"))  # n_positives at most
    slots = F.sequence(F.lit(1), F.lit(n_positives))
    bands = lists.select(
        F.col("_anchor").alias("_id"),
        *[F.transform(slots, lambda i: F.coalesce(f(F.try_element_at("_ps", i)["_p"].cast("decimal(38,0)")), F.lit(none)))
          .alias(name) for name, f, none in (
              ("_lo", lambda p: F.ceil(p * low / 100).cast("long"), 1),
              ("_hi", lambda p: F.floor(p * high / 100).cast("long"), 0))])
    asking = anchors.join(bands, on="_id").withColumn("_ask", F.col("_lo"))
    found = _search(asking, rows, blocks, max(groups, 1), n_negatives, n_positives, same=False, **how)
    pairs = best.withColumn("_place", (F.col("_rank") - 1).cast("long")).drop("_rank")
    return found.join(pairs, on=["_anchor", "_place"]).select(
        F.col("_anchor").alias("anchor_id"), F.col("_positive").alias("positive_id"), F.col("_rank").alias("rank"),
        F.col("_id").alias("negative_id"), F.col("_p").alias("positive_score"), F.col("_score").alias("negative_score"))


def query(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", label), F.col("_id") % 100 == 0)


SQL = """
WITH q AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * CAST(c AS DOUBLE)) FOR c IN embedding] AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([c FOR c IN embedding IF c IS NULL OR NOT isfinite(c)]) = 0
),
s AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS other_id,
         CAST(list_dot_product(a.x, b.x) AS BIGINT) AS score
  FROM q a JOIN q b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
),
p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
),
n AS (
  SELECT p.anchor_id, p.positive_id, s.other_id AS negative_id, p.positive_score, s.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) AS INTEGER) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
   AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""
