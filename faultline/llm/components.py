"""Connected components of a stored edge list, by alternating stars.

Large-star links every larger neighbour of a node to the smallest one,
small-star does so for the smaller neighbours; repeated, every component
becomes one star around its smallest node. Each step is an aggregate (reduced
before the shuffle) and a join, so a node with very many links is no single
task's work. Rounds are checkpointed in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.session import ensure_checkpoint_dir


def _linked(edges: DataFrame, u: str, v: str) -> DataFrame:
    return edges.select(F.col(u).alias("u"), F.col(v).alias("v"))


def _star(pairs: DataFrame) -> DataFrame:
    """Each v of a node u, with the smallest node among u and its v."""
    low = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return pairs.join(low, on="u")


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the smallest node each linked node can reach. Nodes
    without a link to another do not appear. Null ends and self links count
    for nothing; an empty edge list gives no rows."""
    ensure_checkpoint_dir(edges.sparkSession)
    # Kept as (larger u, smaller v).
    now = (edges.where(F.col(a) != F.col(b))
           .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
           .checkpoint(eager=True))
    mark = None
    while True:
        both = now.union(_linked(now, "v", "u"))
        large = _star(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = _star(large)
        now = (small.select(F.col("u"), F.col("m").alias("v"))
               .union(small.select(F.col("v").alias("u"), F.col("m").alias("v")))
               .where("u <> v").distinct().checkpoint(eager=True))
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
        mark = tuple(seen)
