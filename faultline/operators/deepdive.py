"""Per-exception deep dives and segment profiles.

One parametrised set of operators replaces three hand-copied blocks of the
source. ``src`` is the log the dive reads (the full posted log for an
immaterial id, the material log otherwise).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faultline.config import LogSchema, Params
from faultline.functions import clip_upper, pct
from faultline.operators.clean import is_material
from faultline.operators.relational import (
    attach_names, count_via_lookup, dense_grid, events_and_invoices, group_count, nonnull,
    per_document_counts, top_k, with_share,
)


def events_of(src: DataFrame, s: LogSchema, exc_id: int) -> DataFrame:
    """The events of one exception id."""
    return src.where(F.col(s.exc_id) == exc_id)


def by_category(ev: DataFrame, s: LogSchema, digits: int = 1) -> DataFrame:
    """Events, distinct invoices and share per category."""
    return with_share(events_and_invoices(ev, [s.category], s.doc), "Events", "Pct", digits)


def by_channel_category(ev: DataFrame, s: LogSchema, with_pct: bool = True,
                        digits: int = 1) -> DataFrame:
    """Events and distinct invoices per channel x category."""
    g = events_and_invoices(ev, [s.channel, s.category], s.doc)
    return with_share(g, "Events", "Pct_of_exc", digits) if with_pct else g


def by_month_category(ev: DataFrame, s: LogSchema, partial,
                      lookup: tuple[str, DataFrame] | None = None) -> DataFrame:
    """Events per month x category, undated and partial months dropped."""
    if lookup is None:
        g = group_count(ev, [s.month, s.category], "Events")
    else:
        g = count_via_lookup(ev, [s.month, s.category], s.category, lookup[0], lookup[1], "Events")
    return g if partial is None else g.where(F.col(s.month) != partial)


def by_month_category_single_pass(f: DataFrame, s: LogSchema, p: Params, exc_id: int,
                                  lookup: tuple[str, DataFrame]) -> DataFrame:
    """G20 from one pass over the full log: events of the id are counted per
    (month, lookup key), all others per month alone, which is enough for the
    last month of the log."""
    key, names = lookup
    hit = F.coalesce(F.col(s.exc_id) == exc_id, F.lit(False))
    pre = (nonnull(f.drop(s.category), [s.month]).groupBy(s.month, F.when(hit, F.col(key)).alias(key))
           .agg(F.count_if(hit).alias("_n")))
    g = (pre.join(names, on=key, how="left").groupBy(s.month, s.category)
         .agg(F.sum("_n").cast("long").alias("Events")))
    if p.partial_month is not None:
        # At most months x categories rows.
        last = F.max(s.month).over(Window.partitionBy()) if p.partial_month == "latest" else F.lit(p.partial_month)
        g = g.withColumn("_partial", last).where(F.col(s.month) != F.col("_partial")).drop("_partial")
    return nonnull(g, [s.category]).where(F.col("Events") > 0)


def dive_vendors(ev: DataFrame, s: LogSchema, k: int = 20, with_avg: bool = True,
                 names: DataFrame | None = None) -> DataFrame:
    """Top-k vendors of one exception by events (names attached to the
    per-supplier aggregate when ``names`` is given)."""
    if names is None:
        g = events_and_invoices(ev, s.vendor, s.doc)
    else:
        g = attach_names(events_and_invoices(ev, [s.supplier], s.doc), names, s.supplier, s.vendor_name)
    t = top_k(g, [F.col("Events").desc(), F.col(s.supplier), F.col(s.vendor_name)], k)
    if with_avg:
        t = t.withColumn("Avg_Exc_Per_Inv", F.bround(F.col("Events").cast("double") / F.col("Unique_Inv"), 2))
    return t


def exception_counts(rows: DataFrame, s: LogSchema) -> DataFrame:
    """(id, description) -> Count over non-null keys."""
    return group_count(rows, s.exc, "Count")


def exc_order(s: LogSchema):
    return [F.col("Count").desc(), F.col(s.exc_id), F.col(s.exc_desc)]


def cooccurring(src: DataFrame, s: LogSchema, exc_id: int, k: int = 10) -> DataFrame:
    """G22 + J3: other exceptions raised on the documents that raised
    ``exc_id``. One pass: the log is counted per (document, exception), and
    whether the document raised the id is spread over those counts."""
    pre = per_document_counts(src, s.doc, s.exc)
    e = F.col(s.exc_id)
    raised = F.max(F.coalesce(e == exc_id, F.lit(False))).over(Window.partitionBy(s.doc))
    rows = pre.withColumn("_raised", raised).where(F.col("_raised") & (e != exc_id))
    return top_k(_summed(rows, s), exc_order(s), k)


def _summed(rows: DataFrame, s: LogSchema) -> DataFrame:
    """``exception_counts`` of rows counted per document."""
    return nonnull(rows, s.exc).groupBy(*s.exc).agg(F.sum("_n").cast("long").alias("Count"))


def touches_histogram(ev: DataFrame, s: LogSchema, cap: int = 10) -> DataFrame:
    """G23 + P16 + T5: max touches per document, clipped at ``cap``, then
    documents per value."""
    per_doc = nonnull(ev, [s.doc]).groupBy(s.doc).agg(F.max(F.col(s.touches)).alias("MaxTouches"))
    clipped = per_doc.select(clip_upper("MaxTouches", cap).alias("Touches")).where(F.col("Touches").isNotNull())
    return clipped.groupBy("Touches").agg(F.count(F.lit(1)).alias("Invoice_Count"))


def exception_totals(src: DataFrame, ids: Sequence[int], s: LogSchema) -> DataFrame:
    """Events and distinct invoices of each id (0 if it has none), in one
    pass over the full log, which holds the material events too."""
    e = F.col(s.exc_id)
    pre = src.where(e.isin(*ids)).groupBy(s.doc, s.exc_id).agg(F.count(F.lit(1)).alias("_n"))
    one = pre.agg(F.array(*[F.struct(
        F.lit(x).cast("int").alias(s.exc_id),
        F.coalesce(F.sum(F.when(e == x, F.col("_n"))), F.lit(0)).cast("long").alias("Events"),
        F.count_if((e == x) & F.col(s.doc).isNotNull()).alias("Unique_Inv")) for x in ids]).alias("_all"))
    return one.select(F.explode("_all").alias("_x")).select("_x.*")


def vendor_exception_detail(m: DataFrame, s: LogSchema, k: int = 20,
                            names: DataFrame | None = None) -> DataFrame:
    """For the suppliers of the top-k vendors by events, counts per
    (vendor, exception). The semi-join is on the supplier alone, so another
    name of a top supplier is included too."""
    if names is None:
        vend = group_count(m, s.vendor, "Events")
        top = top_k(vend, [F.col("Events").desc(), F.col(s.supplier), F.col(s.vendor_name)], k)
        rows = m.join(F.broadcast(top.select(s.supplier).distinct()), on=s.supplier, how="left_semi")  # k rows
        return group_count(rows, [*s.vendor, *s.exc], "Count")
    # One pass: counts per (supplier, exception), gathered per supplier (a
    # list no longer than the exception ids there are), cut to the top k.
    counts = nonnull(m, [s.supplier]).groupBy(s.supplier, *s.exc).agg(F.count(F.lit(1)).alias("Count"))
    per = counts.groupBy(s.supplier).agg(F.sum("Count").alias("Events"),
                                         F.collect_list(F.struct(*s.exc, "Count")).alias("_d"))
    vend = attach_names(per, names, s.supplier, s.vendor_name)
    top = top_k(vend, [F.col("Events").desc(), F.col(s.supplier), F.col(s.vendor_name)], k)
    return nonnull(top.select(*s.vendor, F.explode("_d").alias("_x")).select(*s.vendor, "_x.*"), s.exc)


def top_ids_over_vendor_set(detail: DataFrame, s: LogSchema, k: int = 10) -> DataFrame:
    """Total count per exception id over the vendor-set detail, top k."""
    g = detail.groupBy(s.exc_id).agg(F.sum("Count").cast("long").alias("Count"))
    return top_k(g, [F.col("Count").desc(), F.col(s.exc_id)], k)


def segment_profile(both: DataFrame, s: LogSchema, channel: str, category: str, passed: bool) -> DataFrame:
    """G26 / G27 for two extracts: exception counts on the documents of one
    channel x category segment that failed (``passed=False``, counted in the
    material log) or passed (``passed=True``, counted in the full log).
    ``both``: ``clean.two_extracts``; no row of a log is joined."""
    w = Window.partitionBy(s.doc)
    inside = F.coalesce(~F.col("_material") & (F.col(s.channel) == channel) & (F.col(s.category) == category), F.lit(False))
    rows = both.withColumns({"_in": F.max(inside).over(w), "_failed": F.max("_material").over(w)})
    return _summed(rows.where(F.col("_in") & (F.col("_failed") != F.lit(passed)) & (F.col("_material") != F.lit(passed))), s)


def segment_profile_single_pass(f: DataFrame, s: LogSchema, p: Params, channel: str, category: str,
                                passed: bool) -> DataFrame:
    """G26 / G27 when the material log is the full log minus the immaterial
    ids: counts per (document, channel, category, exception), then whether the
    document is in the segment and whether it failed, spread by a window."""
    pre = per_document_counts(f, s.doc, [s.channel, s.category, *s.exc])
    w = Window.partitionBy(s.doc)
    inside = F.coalesce((F.col(s.channel) == channel) & (F.col(s.category) == category), F.lit(False))
    rows = pre.withColumns({"_in": F.max(inside).over(w), "_failed": F.max(is_material(s, p)).over(w)})
    rows = rows.where(F.col("_in") & (F.col("_failed") == F.lit(not passed)))
    return _summed(rows if passed else rows.where(is_material(s, p)), s)


def monthly_category_grid(f: DataFrame, s: LogSchema, p: Params, exc_id: int) -> DataFrame:
    """Dense month x category grid of one exception: its events
    (0-filled) and their share of all events of the cell (null where there
    are none). Axes are the months, but for the partial one, and the
    categories that the exception has; all from one aggregate of the log."""
    hit = F.col(s.exc_id) == exc_id
    cells = f.groupBy(s.month, s.category).agg(F.count_if(hit).alias("Events"), F.count(F.lit(1)).alias("_all"))
    # Both measures in the condition: every use of the cells is then the same aggregate, computed once.
    grid = dense_grid(cells, s.category, s.month, keep=(F.col("Events") > 0) & (F.col("_all") > 0), last=p.partial_month)
    return grid.select(s.month, s.category, F.coalesce("Events", F.lit(0)).cast("long").alias("Events"),
                       pct("Events", "_all", 1).alias("Share_Pct"))
