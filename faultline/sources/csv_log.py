"""Raw exception-log extracts as CSV.

The extracts are UTF-8 with a byte-order mark, have a header in which some
names repeat ("Created at", "Time Stamp"), quote fields that hold commas, and
spell missing values in many ways. Reading keeps every column as text (no
inference, so types never depend on the data); ``clean`` types them.
"""

from __future__ import annotations

import csv
from collections.abc import Sequence
from functools import reduce
from itertools import count
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from faultline.config import REFERENCE_NULL_TOKENS

#: Header line of a file without its byte-order mark or line end.
BOM = "\ufeff"


def dedupe_names(names: Sequence[str]) -> list[str]:
    """Unique column names. The first column of a name keeps it; a repeat
    takes the lowest free number behind it, and no number gives a name that
    the header itself has."""
    given, taken = [], set(names)
    for at, name in enumerate(names):
        if name in names[:at]:
            name = next(x for x in (f"{name}_{k}" for k in count(1)) if x not in taken)
            taken.add(name)
        given.append(name)
    return given


def split_header(line: str) -> list[str]:
    return next(csv.reader([line.lstrip(BOM).rstrip("\r\n")]), [])


def text_schema(header: Sequence[str]) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in dedupe_names(header)])


def csv_options(multi_line: bool = False) -> dict[str, str]:
    """Reader options of an extract, for batch and stream alike. Header lines
    are read as rows, so that ``rows_below`` can compare each file's own."""
    return {"header": "false", "encoding": "UTF-8", "quote": '"', "escape": '"',
            "multiLine": str(multi_line).lower(), "mode": "PERMISSIVE"}


def rows_below(df: DataFrame, header: Sequence[str]) -> DataFrame:
    """The rows that are not header lines. Columns are assigned by position
    (names may repeat), so a file that has the columns in another order than
    the header given must not be read silently: its header line raises an error."""
    first, *rest = [F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in df.columns]
    cells = F.array(F.regexp_replace(first, f"^{BOM}", ""), *rest)
    names = F.array(*[F.lit(n) for n in header])
    # Compared only where the first cell is a column name at all.
    candidate = cells[0].isin(*header)
    moved = candidate & (cells != names) & (F.array_sort(cells) == F.array_sort(names))
    message = F.concat(F.lit("a file has its columns in another order: "), F.array_join(cells, ","))
    return df.where(F.when(moved, F.raise_error(message).cast("boolean"))
                    .otherwise(~(candidate & (cells == names))))


def null_tokens_out(df: DataFrame, null_tokens: Sequence[str] = REFERENCE_NULL_TOKENS) -> DataFrame:
    """S3: the tokens become nulls in every column."""
    def known(c: str) -> Column:
        col = F.col(f"`{c}`")
        return F.when(~col.isin(*null_tokens), col).alias(c)

    return df.select(*[known(c) for c in df.columns])


def header_groups(spark: SparkSession, path: str | Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    """The files of each header line there is, from one scan of the text that
    keeps each file's first line (rows of a split come in file order). File
    names come to the driver, as they do in any listing."""
    lines = spark.read.text(path).select("value", "_metadata.file_path", "_metadata.file_block_start")
    first = (lines.where(F.col("file_block_start") == 0).groupBy("file_path").agg(F.first("value").alias("line"))
             .orderBy("file_path"))
    groups: dict[tuple[str, ...], list[str]] = {}
    for r in first.collect():
        groups.setdefault(tuple(split_header(r["line"])), []).append(unquote(r["file_path"]))
    return groups


def read_log_csv(spark: SparkSession, path: str | Sequence[str], names: Sequence[str] | None = None,
                 null_tokens: Sequence[str] = REFERENCE_NULL_TOKENS,
                 multi_line: bool = False) -> DataFrame:
    """S1 + S2 + S3: all-text DataFrame with unique column names and null
    tokens turned into nulls.

    Files may differ in the order of their columns or in the columns they
    have: those of one header are read together, by position, and the groups
    are united by name (a column that a file does not have is null).
    ``names`` gives the header when all files are known to share it; then no
    file is touched to plan the read, and a file with the same columns in
    another order raises an error. ``multi_line`` only for extracts whose
    quoted fields hold line breaks: such files cannot be split, so each is
    read by one task.
    """
    def group(header: Sequence[str], files: str | Sequence[str]) -> DataFrame:
        raw = spark.read.schema(text_schema(header)).options(**csv_options(multi_line)).csv(files)
        return null_tokens_out(rows_below(raw, header) if header else raw, null_tokens)

    if names is not None:
        return group(names, path if isinstance(path, str) else list(path))
    groups = header_groups(spark, path if isinstance(path, str) else list(path))
    if len(groups) < 2:
        return group(next(iter(groups), ()), path if isinstance(path, str) else list(path))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [group(h, fs) for h, fs in groups.items()])
