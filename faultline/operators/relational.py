"""Small relational building blocks shared by the analyses.

Null-safe grouping (rule 1), shares of a grouped total (G2), total-order
top-k (T1-T4), semi / anti / lookup joins (J3-J5), the dense grid (G37).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.functions import order_key, pct


def nonnull(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop rows with a null in any key: grouped results never carry null keys."""
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df if cond is None else df.where(cond)


def group_count(df: DataFrame, keys: Sequence[str], name: str = "Count") -> DataFrame:
    """``groupBy(keys).count()`` over non-null keys (partial + final aggregate)."""
    return nonnull(df, keys).groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def count_via_lookup(df: DataFrame, keys: Sequence[str], attr: str, key_col: str,
                     lookup: DataFrame, name: str = "Count") -> DataFrame:
    """``group_count(df, keys)`` where ``attr`` (one of ``keys``) is a function
    of ``key_col``, looked up in ``lookup`` (key_col -> attr).

    Counts add up, so rows are first counted per ``key_col`` (map-side
    partial aggregation), the attribute is attached to those partial counts,
    and they are summed per ``keys``. The lookup joins the pre-aggregated
    table, not the log."""
    other = [k for k in keys if k != attr]
    pre = [key_col if k == attr else k for k in keys]
    g = nonnull(df.drop(attr), other).groupBy(*pre).agg(F.count(F.lit(1)).alias("_n"))
    j = g.join(lookup, on=key_col, how="inner")
    return nonnull(j, [attr]).groupBy(*keys).agg(F.sum("_n").cast("long").alias(name))


def events_and_invoices(df: DataFrame, keys: Sequence[str], doc: str,
                        events: str = "Events", invoices: str = "Unique_Inv") -> DataFrame:
    """Event rows and distinct documents per key in one aggregate."""
    return nonnull(df, keys).groupBy(*keys).agg(
        F.count(F.col(doc)).alias(events),
        F.countDistinct(F.col(doc)).alias(invoices),
    )


def per_document_counts(df: DataFrame, doc: str, keys: Sequence[str]) -> DataFrame:
    """Rows of each (document, keys...), nulls in ``keys`` kept: what questions
    about whole documents need of the log. Combined map-side, so a document
    with very many events shrinks to its distinct keys before any window."""
    return nonnull(df, [doc]).groupBy(doc, *keys).agg(F.count(F.lit(1)).alias("_n"))


def attach_names(g: DataFrame, names: DataFrame, supplier: str, name: str) -> DataFrame:
    """Attach vendor names to a table aggregated by supplier; suppliers
    without a name drop out, as null group keys do (rule 1). Columns come
    out as (supplier, name, rest...).

    Only for a lookup with one name per supplier (a supplier master keyed by
    supplier). When the log itself carries several names for one supplier,
    group by (supplier, name) on the log instead."""
    rest = [c for c in g.columns if c != supplier]
    j = g.join(names.where(F.col(name).isNotNull()), on=supplier, how="inner")
    return j.select(supplier, name, *rest)


def grand_total(df: DataFrame, measure: str) -> Column:
    """Scalar subquery holding the sum of ``measure``: evaluated once, not a
    single-partition window over the whole result."""
    return df.select(F.sum(F.col(measure))).scalar()


def with_share(df: DataFrame, measure: str, out: str, digits: int = 2) -> DataFrame:
    """``measure / sum(measure) * 100`` rounded half-even (G2, rule 2)."""
    return df.withColumn(out, pct(F.col(measure), grand_total(df, measure), digits))


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """Sort + limit, planned as ``TakeOrderedAndProject`` (per-partition
    top-k, then a merge of k rows per partition): no global sort."""
    return df.orderBy(*order).limit(k)


def semi(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    return df.join(keys, on=on, how="left_semi")


def anti(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    return df.join(keys, on=on, how="left_anti")


def first_by_order(df: DataFrame, key: str, value: str, order: Sequence[str],
                   out: str | None = None) -> DataFrame:
    """One row per key with the value of its earliest row.

    ``min_by`` is a partial/final aggregate, so a hot key is reduced map-side
    instead of being sorted in one task.
    """
    return nonnull(df, [key]).groupBy(key).agg(
        F.min_by(F.col(value), F.struct(*[order_key(df, c).alias(c) for c in order])).alias(out or value)
    )


def dense_grid(cells: DataFrame, rows: str, cols: str, keep: Column, last: str | None = None) -> DataFrame:
    """Every pair of the kept cells' own ``rows`` and ``cols`` values with its
    cell, or nulls where there is none (G37). ``cells``: one row a pair, an
    aggregate. The values of ``cols`` (the shorter axis) are one array, which
    is exploded beside each value of ``rows``; the cells are attached by a
    join on the pair. With ``last`` set, that value of ``cols`` is left out:
    "latest" means the greatest of all cells."""
    value = F.when(keep, F.col(cols))
    kept = F.collect_set(value)
    gone = F.max(cols) if last == "latest" else F.lit(last).cast(cells.schema[cols].dataType)
    axis = cells.agg(kept.alias("_s"), gone.alias("_gone"))
    axis = axis.select(F.filter("_s", lambda c: ~c.eqNullSafe(F.col("_gone"))))
    grid = (cells.where(keep & F.col(rows).isNotNull()).select(rows).distinct()
            .select(rows, F.explode(axis.scalar()).alias(cols)))
    return grid.join(cells, on=[rows, cols], how="left")
