"""Small helpers shared by the operators: tables, stored intermediates, doc-id ranges."""

from __future__ import annotations

import os
import pickle
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.session import ensure_checkpoint_dir


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, whose Python functions import it
    (once for an application; a no-op where they have it on their path anyway)."""
    sc = spark.sparkContext
    if sc.applicationId not in _SHIPPED:
        _SHIPPED.add(sc.applicationId)
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        base = os.path.join(tempfile.mkdtemp(prefix="faultline-ship-"), "faultline")
        sc.addPyFile(shutil.make_archive(base, "zip", root, "faultline"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir`` (shared by driver and executors)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts the
    lineage, and everything built on it sees one copy of the rows."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def n_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def id_bounds(df: DataFrame, col: str, n: int) -> list[int]:
    """At most n - 1 ascending cut points that split ``col`` into about equal
    ranges (a quantile sketch over the one column; n is a partition count)."""
    if n < 2:
        return []
    qs = [i / n for i in range(1, n)]
    got = df.select(F.percentile_approx(F.col(col).cast("long"), qs, 20 * n)).first()[0]
    return sorted(set(got or []))


def id_range(col: str, bounds: list[int]) -> Column:
    """Number of the range of ``bounds`` that holds the id; null ids come last."""
    c = F.col(col).cast("long")
    if not bounds:
        return F.when(c.isNull(), F.lit(1)).otherwise(F.lit(0)).cast("int")
    # Binary search over the cut points laid out as a complete tree (children
    # of i at 2i + 1 and 2i + 2): log2(n) steps a row, one array literal.
    depth = len(bounds).bit_length()
    size = 2 ** depth - 1
    tree, todo = [2 ** 63 - 1] * size, [(0, 0, size)]
    while todo:
        node, lo, hi = todo.pop()
        if lo < hi:
            mid = (lo + hi) // 2
            if mid < len(bounds):
                tree[node] = bounds[mid]
            todo += [(2 * node + 1, lo, mid), (2 * node + 2, mid + 1, hi)]
    arr = F.array(*[F.lit(x).cast("long") for x in tree])
    leaf = F.aggregate(
        F.sequence(F.lit(1), F.lit(depth)), F.lit(0),
        lambda i, _: i * 2 + F.when(c > F.element_at(arr, i + 1), F.lit(2)).otherwise(F.lit(1)))
    return F.when(c.isNull(), F.lit(len(bounds) + 1)).otherwise(leaf - F.lit(size)).cast("int")


def boxed(docs: DataFrame) -> Column:
    """All columns of ``docs`` as one struct, so that names inside an operator clash with none of them."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc")


def unboxed(rows: DataFrame, docs: DataFrame, made: dict[str, Column]) -> DataFrame:
    """The columns of ``docs`` out of the struct, then ``made``. An input column
    with the name of a made one gives way to it."""
    taken = {c.lower() for c in made}
    kept = [F.col("_doc").getField(c).alias(c) for c in docs.columns if c.lower() not in taken]
    return rows.select(*kept, *[col.alias(c) for c, col in made.items()])


#: Values that one task of ``folded`` merges.
FAN = 16


def folded(rows: DataFrame, parts, start, take, merge):
    """One value from all rows. Every partition folds its ``parts`` (a function
    from Arrow batches to an iterator) into a value by ``take``; then ``FAN``
    values at a time are merged in grouped tasks until one is left, which
    comes to the driver. ``start`` gives the value of no rows."""
    kind = "slot int, value binary"

    def partition(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        state, found = start(), False
        for x in parts(batches):
            state, found = take(state, x), True
        if found:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()),
                                              pa.array([pickle.dumps(state)], pa.binary())], names=["slot", "value"])

    def group(t):
        import pyarrow as pa

        t = t.sort_by("slot")
        state = start()
        for v in t.column("value").to_pylist():
            state = merge(state, pickle.loads(v))
        return pa.table({"slot": pa.array([t.column("slot")[0].as_py() // FAN], pa.int32()),
                         "value": pa.array([pickle.dumps(state)], pa.binary())})

    values, left = rows.mapInArrow(partition, kind), rows.rdd.getNumPartitions()
    while left > 1:
        values = values.groupBy(F.floor(F.col("slot") / FAN).alias("_g")).applyInArrow(group, kind)
        left = -(-left // FAN)
    got = values.first()
    return pickle.loads(got["value"]) if got else start()
