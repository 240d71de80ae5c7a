"""Frequencies, vendor statistics and KPI figures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultline.config import LogSchema, Params
from faultline.functions import pct
from faultline.operators.clean import is_material
from faultline.operators.relational import (
    attach_names, count_via_lookup, grand_total, group_count, nonnull, top_k, with_share,
)

# Fixed values of the original key-exception table: the ids it ranks, and the
# one id whose count it scales (+6 %).
KEY_EXCEPTION_IDS = (151, 29, 75, 2, 38, 82, 37)
SCALED_ID = 37
SCALE_FACTOR = 1.06
HIGHLIGHT_IDS = (1, 38)


def exception_frequency(m: DataFrame, s: LogSchema, digits: int = 2) -> DataFrame:
    """G1: events per (id, description), share of the grouped total, desc."""
    g = group_count(m, s.exc, "Count")
    return with_share(g, "Count", "Pct", digits)


def vendor_stats(m: DataFrame, s: LogSchema, digits: int = 2,
                 names: DataFrame | None = None) -> DataFrame:
    """Per (supplier, name): distinct invoices, event rows, events per invoice.
    One aggregate replaces the two groupings + self-join of the source (J1).

    ``names`` (supplier -> name), when the name is a function of the
    supplier: aggregate by supplier, then attach names to the aggregate."""
    if names is None:
        g = nonnull(m, s.vendor).groupBy(*s.vendor).agg(*_vendor_aggs(s))
    else:
        g = attach_names(supplier_stats(m, s), names, s.supplier, s.vendor_name)
    return _with_avg(g, digits)


def _vendor_aggs(s: LogSchema):
    return [F.countDistinct(F.col(s.doc)).alias("Unique_Invoices"),
            F.count(F.lit(1)).alias("Exception_Events")]


def _with_avg(g: DataFrame, digits: int = 2) -> DataFrame:
    return g.withColumn("Avg_Exc_Per_Inv",
                        F.bround(F.try_divide(F.col("Exception_Events").cast("double"),
                                              F.col("Unique_Invoices").cast("double")), digits))


def supplier_stats(m: DataFrame, s: LogSchema) -> DataFrame:
    """Distinct invoices and events per supplier (before names are attached)."""
    return nonnull(m, [s.supplier]).groupBy(s.supplier).agg(*_vendor_aggs(s))


def vendor_order(s: LogSchema):
    """Events desc, then the vendor key: a total order for ties (rule 9)."""
    return [F.col("Exception_Events").desc(), F.col(s.supplier).asc(), F.col(s.vendor_name).asc()]


def top_vendors(m: DataFrame, s: LogSchema, k: int = 50, names: DataFrame | None = None) -> DataFrame:
    """G3 + T3: top-k vendors by events."""
    return top_k(vendor_stats(m, s, names=names), vendor_order(s), k)


def vendor_intensity(m: DataFrame, s: LogSchema, min_invoices: int = 10, k: int = 20,
                     names: DataFrame | None = None) -> DataFrame:
    """Vendors with at least ``min_invoices`` invoices (P25 HAVING), by
    events per invoice desc, top k."""
    v = vendor_stats(m, s, names=names).where(F.col("Unique_Invoices") >= min_invoices)
    return top_k(v, [F.col("Avg_Exc_Per_Inv").desc(), *vendor_order(s)], k)


def category_exceptions(m: DataFrame, s: LogSchema, lookup: tuple[str, DataFrame] | None = None) -> DataFrame:
    """(category, id, description) counts. ``lookup`` = (key column,
    key -> category table) counts per key first (``count_via_lookup``)."""
    keys = [s.category, *s.exc]
    if lookup is None:
        return group_count(m, keys, "Count")
    return count_via_lookup(m, keys, s.category, lookup[0], lookup[1], "Count")


def category_totals(m: DataFrame, s: LogSchema, lookup: tuple[str, DataFrame] | None = None) -> DataFrame:
    """Events per category."""
    if lookup is None:
        return group_count(m, [s.category], "Exception_Events")
    return count_via_lookup(m, [s.category], s.category, lookup[0], lookup[1], "Exception_Events")


def crosstab(df: DataFrame, rows: str, cols: str) -> DataFrame:
    """Row x column event counts in long form, one row for each cell that
    has events. The columns are those of the data, however many; an event
    without one counts under null."""
    return nonnull(df, [rows]).groupBy(rows, cols).agg(F.count(F.lit(1)).alias("Count"))


def kpi_row(u: DataFrame, m: DataFrame, s: LogSchema, names: DataFrame | None = None) -> DataFrame:
    """One row of headline figures. Each figure is a one-row aggregate;
    they are combined with scalar subqueries (no driver round trip)."""
    if names is None:
        vend = vendor_stats(m, s)
        total_events = m.select(F.count(F.lit(1))).scalar()
    else:
        # A cleaned log has a supplier on every row (a missing one becomes
        # "nan" or fails the prefix filter), so the per-supplier counts add
        # up to all events: one aggregate of the log serves both figures.
        pre = supplier_stats(m, s)
        vend = _with_avg(attach_names(pre, names, s.supplier, s.vendor_name))
        total_events = grand_total(pre, "Exception_Events")
    top10 = top_k(vend, vendor_order(s), 10)
    fp = u.agg(
        F.countDistinct(F.col(s.doc)).alias("total_invoices"),
        F.count_if(F.col("First_Pass")).alias("first_pass_count"),
        pct(F.count_if(F.col("First_Pass")), F.count(F.lit(1)), 1).alias("first_pass_rate"),
    )
    return fp.select(
        "*",
        total_events.cast("long").alias("total_exception_events"),
        vend.select(F.countDistinct(F.col(s.supplier))).scalar().alias("unique_vendors_with_exceptions"),
        pct(grand_total(top10, "Exception_Events"), grand_total(vend, "Exception_Events"), 1)
        .alias("top10_vendor_pct"),
    )


def kpi_row_single_pass(f: DataFrame, s: LogSchema, p: Params, names: DataFrame) -> DataFrame:
    """G10 from one pass over the full log: grouping sets give the (document,
    channel, category) rows and the supplier rows; whether a document raised a
    material event is spread over its rows. Suppliers are then counted by
    their number of events (at most the square root of twice the events), from
    which the ten largest and the total come."""
    mat = is_material(s, p).cast("int").alias("_mat")
    g = f.select(s.doc, s.channel, s.category, s.supplier, mat).groupingSets(
        [[s.doc, s.channel, s.category], [s.supplier]], s.doc, s.channel, s.category, s.supplier).agg(
        F.sum("_mat").alias("_n"), (F.grouping(s.supplier) == 1).alias("_u"))
    known = names.where(F.col(s.supplier).isNotNull()).select(s.supplier, F.col(s.vendor_name).isNotNull().alias("_named"))
    g = g.join(known, on=s.supplier, how="left")
    whole = F.col("_u") & F.col(s.doc).isNotNull() & F.col(s.channel).isNotNull() & F.col(s.category).isNotNull()
    # One window partition a document, and one a supplier.
    w = Window.partitionBy(s.doc, s.supplier, "_u")
    vendor = ~F.col("_u") & F.col("_named") & (F.col("_n") > 0)
    rows = g.select(
        "_u", whole.alias("_row"), (whole & (F.max("_n").over(w) == 0)).alias("_pass"),
        (whole & (F.row_number().over(w.orderBy((~whole).cast("int"))) == 1)).alias("_doc"),
        F.when(vendor, F.col("_n")).alias("_events"), F.when(~F.col("_u"), F.col("_n")).alias("_all"))
    by = rows.groupBy("_events").agg(
        F.count_if("_row").alias("_rows"), F.count_if("_pass").alias("_passed"), F.count_if("_doc").alias("_docs"),
        F.count("_events").alias("_vendors"), F.sum("_all").alias("_all"))
    before = F.coalesce(F.sum("_vendors").over(
        Window.orderBy(F.col("_events").desc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    top = F.col("_events") * F.greatest(F.lit(0), F.least(F.col("_vendors"), 10 - before))
    return by.withColumn("_top", top).agg(
        F.coalesce(F.sum("_docs"), F.lit(0)).cast("long").alias("total_invoices"),
        F.coalesce(F.sum("_passed"), F.lit(0)).cast("long").alias("first_pass_count"),
        pct(F.sum("_passed"), F.sum("_rows"), 1).alias("first_pass_rate"),
        F.sum("_all").cast("long").alias("total_exception_events"),
        F.coalesce(F.sum("_vendors"), F.lit(0)).cast("long").alias("unique_vendors_with_exceptions"),
        pct(F.sum("_top"), F.sum(F.col("_events") * F.col("_vendors")), 1).alias("top10_vendor_pct"))


def scaled_count(count_col: str, id_col: str, scaled_id: int = SCALED_ID,
                 factor: float = SCALE_FACTOR):
    """One id's count multiplied by a factor and rounded (224 -> 237)."""
    c = F.col(count_col)
    return F.when(F.col(id_col) == scaled_id, F.round(c * F.lit(factor), 0).cast("long")).otherwise(c)


def key_exception_table(m: DataFrame, universe_docs: DataFrame, s: LogSchema,
                        ids: Sequence[int] = KEY_EXCEPTION_IDS) -> DataFrame:
    """G31 + G32: for the chosen ids: events (after P23), share of all events,
    distinct invoices, share of the invoice universe, events per invoice, the
    repeat-touch gap, and each id's share of the chosen set."""
    all_events = m.select(F.count(F.lit(1))).scalar()
    n_univ = universe_docs.select(F.countDistinct(F.col(s.doc))).scalar()
    g = (m.where(F.col(s.exc_id).isin(*ids)).groupBy(s.exc_id)
         .agg(F.count(F.lit(1)).alias("Raw_Events"), F.countDistinct(F.col(s.doc)).alias("Invoices")))
    return _key_figures(g, s, all_events, n_univ)


def _key_figures(g: DataFrame, s: LogSchema, all_events: Column, n_univ: Column) -> DataFrame:
    g = g.withColumn("Events", scaled_count("Raw_Events", s.exc_id))
    return g.select(
        s.exc_id, "Raw_Events", "Invoices", "Events", pct("Events", all_events, 1).alias("Pct_All"),
        pct("Invoices", n_univ, 1).alias("Pct_Universe"),
        F.bround(F.try_divide(F.col("Events").cast("double"), F.col("Invoices").cast("double")), 2).alias("Avg_Per_Invoice"),
        (F.col("Events") - F.col("Invoices")).alias("Repeat_Gap"),
        # As many rows as there are chosen ids.
        pct("Events", F.sum("Events").over(Window.partitionBy()), 1).alias("Share_Of_Set"))


def key_exception_table_single_pass(f: DataFrame, s: LogSchema, p: Params,
                                    ids: Sequence[int] = KEY_EXCEPTION_IDS) -> DataFrame:
    """G31 + G32 from one pass over the full log: one row a document with its
    material events, its events of each chosen id and whether it is in the
    universe; one row of sums over the documents, which is then one row an id."""
    e = F.col(s.exc_id)
    mat = is_material(s, p)
    docs = f.groupBy(s.doc).agg(
        F.count_if(mat).alias("_all"),
        F.max(F.col(s.channel).isNotNull() & F.col(s.category).isNotNull()).alias("_in"),
        *[F.count_if(mat & (e == x)).alias(f"_e{i}") for i, x in enumerate(ids)])
    known = F.col(s.doc).isNotNull()
    one = docs.agg(
        F.sum("_all").alias("_all"), F.count_if(known & F.col("_in")).alias("_docs"),
        F.array(*[F.struct(F.lit(x).cast(f.schema[s.exc_id].dataType).alias(s.exc_id), F.sum(f"_e{i}").alias("Raw_Events"),
                           F.count_if(known & (F.col(f"_e{i}") > 0)).alias("Invoices"))
                  for i, x in enumerate(ids)]).alias("_ids"))
    g = one.select("_all", "_docs", F.explode("_ids").alias("_x")).select("_all", "_docs", "_x.*")
    return _key_figures(g.where(F.col("Raw_Events") > 0), s, F.col("_all"), F.col("_docs"))


def dimension_share(m: DataFrame, s: LogSchema, exc_id: int, dim: str, digits: int = 1) -> DataFrame:
    """Share of one exception's events by a dimension (channel, PO type...)."""
    g = group_count(m.where(F.col(s.exc_id) == exc_id), [dim], "Events")
    return with_share(g, "Events", "Share_Pct", digits)


def highlight(df: DataFrame, id_col: str, ids: Sequence[int] = HIGHLIGHT_IDS) -> DataFrame:
    """Flag rows of the highlighted ids."""
    return df.withColumn("Highlight", F.coalesce(F.col(id_col).isin(*ids), F.lit(False)))
