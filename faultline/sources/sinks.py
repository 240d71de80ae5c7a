"""Result sinks and the JSON result source.

Every result is written by the executors as a dataset (one directory of
part files per result); nothing is funnelled through the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Header CSV, no index column."""
    df.write.mode(mode).option("header", True).csv(path)


def write_results(results: Mapping[str, DataFrame], root: str, fmt: str = "json",
                  mode: str = "overwrite") -> None:
    """Each result under ``root/<name>`` as JSON lines (or CSV/parquet).

    JSON lines is the distributed form of the source's "one document of
    record arrays": one record per line, one directory per result field.
    Values JSON cannot hold (timestamps, decimals) are written as text.
    """
    for name, df in results.items():
        w = df.write.mode(mode)
        target = f"{root.rstrip('/')}/{name}"
        if fmt == "csv":
            w.option("header", True).csv(target)
        elif fmt == "parquet":
            w.parquet(target)
        else:
            w.option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss").json(target)


#: Records of one piece of a result document.
PIECE = 1_000


def result_document(parts: Sequence[tuple[str, DataFrame, Sequence[Column], Sequence[str]]]) -> DataFrame:
    """S5 as ordered pieces: for each (field, result, order, columns) rows
    (``name``, ``piece``, ``records``), the records of a piece as a JSON array
    of at most ``PIECE``. Pieces and the records in them are in order. The
    sort is Spark's range-partitioned one and pieces are cut inside its
    partitions, so no task holds a whole result. Piece numbers rise but need
    not be consecutive; every field starts with an empty piece -1, so a field
    without records is there too."""
    rows = None
    for name, df, order, columns in parts:
        record = F.struct(*[F.col(f"`{c}`") for c in columns])
        placed = (df.orderBy(*order) if order else df).select(
            record.alias("_r"), F.monotonically_increasing_id().alias("_at"))
        pieces = placed.groupBy(F.floor(F.col("_at") / PIECE).alias("piece")).agg(
            F.array_sort(F.collect_list(F.struct("_at", "_r"))).alias("_all"))
        first = df.sparkSession.range(1).select(F.lit(name).alias("name"), F.lit(-1).cast("long").alias("piece"),
                                                F.lit("[]").alias("records"))
        one = first.unionByName(pieces.select(
            F.lit(name).alias("name"), "piece", F.to_json(F.transform("_all", lambda x: x["_r"])).alias("records")))
        rows = one if rows is None else rows.unionByName(one)
    return rows


def document_records(document: DataFrame, name: str, schema: str) -> DataFrame:
    """The records of one field of ``result_document`` (or of what it
    wrote), in order. ``schema``: a DDL string of the field's columns."""
    pieces = document.where(F.col("name") == name).orderBy("piece")
    return pieces.select(F.inline(F.from_json("records", f"array<struct<{schema}>>")))


def read_results(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Reload one result written by ``write_results`` (JSON lines)."""
    return spark.read.json(f"{root.rstrip('/')}/{name}")


def read_document(spark: SparkSession, path: str, field: str) -> DataFrame:
    """One field (an array of records) of a multi-line JSON document,
    as rows."""
    doc = spark.read.option("multiLine", True).json(path)
    return doc.select(F.inline(F.col(f"`{field}`")))


def write_clean_log(df: DataFrame, path: str, month_col: str, doc_col: str,
                    mode: str = "overwrite", num_files: int | None = None) -> None:
    """Write a cleaned log once for many analyses: partitioned by month (a
    month filter prunes whole directories) and sorted by document inside each
    file (row-group statistics on the document key stay tight).

    Rows are range-partitioned on (month, document), not hashed on the month,
    so a month holding most rows is still split over many tasks and each
    task writes only a few month directories. Rows without a month land in
    the default partition."""
    n = num_files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (df.repartitionByRange(n, month_col, doc_col)
       .sortWithinPartitions(month_col, doc_col)
       .write.mode(mode).partitionBy(month_col).parquet(path))
