"""Workload concentration: running sums and ranks over a global order.

A running sum over a global order is usually written as a window without
``partitionBy``, which moves every row into one task. Here it is split:

* order = (measure desc, key asc), key unique;
* rows with a larger measure are summarised by the table of *distinct*
  measure values (value, how many rows). Its size is bounded by the data:
  if d distinct positive counts sum to at most N, then 1 + 2 + ... + d <= N,
  so d <= sqrt(2N) (about 1.4 million for 10^12 events). A window over that
  small table gives, per value, the sum and count of all larger values, and
  it is broadcast with that bound;
* inside one tie group (rows with the same measure) the position of a row
  comes from ``sequences.group_positions``, which numbers buckets of the key
  order apart (cut at keys sampled from the data), so a tie group of any size (for example every vendor with a
  single event) is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.functions import pct
from faultline.operators.sequences import BUCKET_ROWS, group_positions


def global_running_sum(df: DataFrame, measure: str, keys: Sequence[str],
                       rank_col: str = "Rank", cum_col: str = "Cumulative_Events",
                       bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Add ``rank_col`` (1..n) and ``cum_col`` (running sum of ``measure``)
    over the order (measure desc, keys asc). ``keys`` must be unique and
    non-null; ``measure`` counts (a whole-number type), which is what bounds
    the number of its distinct values."""
    if not isinstance(df.schema[measure].dataType, T.IntegralType):
        raise TypeError(f"{measure} is no count: the table of its distinct values has no bound")
    e = F.col(measure)
    # Distinct measure values: rows and sum of all strictly larger values.
    # Window without partitionBy over at most sqrt(2N) rows.
    w_before = Window.orderBy(e.desc()).rowsBetween(Window.unboundedPreceding, -1)
    levels = (df.groupBy(measure).agg(F.count(F.lit(1)).alias("_n"))
              .withColumns({
                  "_rows_gt": F.coalesce(F.sum("_n").over(w_before), F.lit(0)),
                  "_sum_gt": F.coalesce(F.sum(e * F.col("_n")).over(w_before), F.lit(0)),
              }).drop("_n"))
    # Position inside the tie group (same measure), in key order.
    ranked = group_positions(df, [measure], list(keys), pos_col="_r", bucket_rows=bucket_rows)
    out = ranked.join(F.broadcast(levels), on=measure)
    return (out.withColumns({
        rank_col: F.col("_rows_gt") + F.col("_r"),
        cum_col: F.col("_sum_gt") + e * F.col("_r"),
    }).drop("_r", "_rows_gt", "_sum_gt"))


def workload_concentration(vendors: DataFrame, keys: Sequence[str], measure: str = "Exception_Events",
                           digits: int = 2) -> DataFrame:
    """W1 + W2 (+ W3 rank): cumulative events and cumulative share per vendor."""
    total = vendors.select(F.sum(F.col(measure))).scalar()
    r = global_running_sum(vendors, measure, keys)
    return r.withColumn("Cumulative_Pct", pct("Cumulative_Events", total, digits))


def top_n_concentration(conc: DataFrame, ns: Sequence[int] = (10, 20, 50),
                        measure: str = "Exception_Events", digits: int = 1) -> DataFrame:
    """W4 + W5: share of events held by the first n vendors, and the
    cumulative share at rank n (null when there are fewer than n vendors)."""
    aggs = []
    total = F.sum(F.col(measure))
    for n in ns:
        aggs.append(pct(F.sum(F.when(F.col("Rank") <= n, F.col(measure)).otherwise(0)), total, digits)
                    .alias(f"Top{n}_Pct"))
        aggs.append(F.max(F.when(F.col("Rank") == n, F.col("Cumulative_Pct"))).alias(f"Cum_Pct_At_{n}"))
    return conc.agg(*aggs)
