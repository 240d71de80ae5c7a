"""Embeddings as exact integer vectors, packed in the fewest bytes that hold them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Scale of the integer grid: a component c becomes floor(SCALE * c).
SCALE = 256


def _whole(column) -> tuple[list[np.ndarray], np.ndarray]:
    """Components (doubles) of each usable vector of an Arrow list column, and
    the places of those rows. Null, empty vectors and vectors with a null or
    non-finite component are not usable."""
    import pyarrow as pa

    column = column.cast(pa.list_(pa.float64()))
    flat = column.flatten()
    values = flat.fill_null(float("nan")).to_numpy(zero_copy_only=False)
    sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    ok = (sizes > 0) & (bad[ends] == bad[ends - sizes])
    return [values[e - s:e] for e, s in zip(ends[ok], sizes[ok])], np.flatnonzero(ok)


def pack(x: np.ndarray) -> bytes:
    """Whole numbers (doubles) in little-endian 2, 4 or 8 bytes each."""
    top = np.abs(x).max()
    if top >= 2.0 ** 62:
        raise OverflowError("a component is too large for whole numbers of 64 bits")
    return x.astype("<i2" if top < 2 ** 15 else "<i4" if top < 2 ** 31 else "<i8").tobytes()


def unpack(packed, dim: int) -> np.ndarray:
    """Matrix (rows x dim, whole numbers) of an Arrow binary column or a list of bytes."""
    cells = packed.to_pylist() if hasattr(packed, "to_pylist") else packed
    sizes = np.array([len(c) for c in cells], dtype=np.int64) // max(dim, 1)
    kinds = np.unique(sizes)
    out = np.zeros((len(cells), dim), dtype=f"<i{kinds.max()}" if len(kinds) else "<i2")
    for size in kinds:
        at = np.flatnonzero(sizes == size)
        out[at] = np.frombuffer(b"".join(cells[i] for i in at), dtype=f"<i{size}").reshape(len(at), dim)
    return out


def on_grid(df: DataFrame, vector_col: str, keep: list[str]) -> DataFrame:
    """The rows with a usable vector: the columns ``keep``, ``_dim`` and ``_x`` (packed)."""
    rows = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{vector_col}`").alias("_v"))

    def run(batches):
        import pyarrow as pa

        for b in batches:
            vectors, at = _whole(b.column("_v"))
            cells = [pack(np.floor(v * SCALE)) for v in vectors]
            kept = b.select(keep).take(pa.array(at)) if keep else None
            cols = [kept.column(c) for c in keep] if keep else []
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array([len(v) for v in vectors], pa.int32()), pa.array(cells, pa.binary())],
                names=[*keep, "_dim", "_x"])

    schema = T.StructType([*[rows.schema[c] for c in keep], T.StructField("_dim", T.IntegerType()),
                           T.StructField("_x", T.BinaryType())])
    return rows.mapInArrow(run, schema)


def main_dimension(rows: DataFrame) -> tuple[int, int]:
    """The length that most vectors have (of several, the largest), and how many
    have it. One row a length comes to the driver: as many as there are lengths."""
    top = (rows.groupBy("_dim").agg(F.count(F.lit(1)).alias("n"))
           .orderBy(F.col("n").desc(), F.col("_dim").desc()).first())
    return (top["_dim"], top["n"]) if top else (0, 0)
