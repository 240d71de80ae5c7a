"""First-pass rates and monthly trends."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faultline.config import LogSchema, Params
from faultline.functions import order_key, pct
from faultline.operators.clean import is_material
from faultline.operators.relational import first_by_order, nonnull


def first_pass_by(u: DataFrame, keys: Sequence[str], s: LogSchema, digits: int = 2,
                  count_name: str = "First_Pass_Count",
                  rate_name: str = "First_Pass_Rate") -> DataFrame:
    """Universe rows and first-pass rows per key, rate in percent.

    ``Total`` counts (document, channel, category) rows, not distinct
    documents (rule 6).
    """
    return (
        nonnull(u, keys).groupBy(*keys)
        .agg(F.count(F.col(s.doc)).alias("Total"),
             F.count_if(F.col("First_Pass")).alias(count_name))
        .withColumn(rate_name, pct(count_name, "Total", digits))
    )


def overall_first_pass(u: DataFrame, s: LogSchema, digits: int = 1) -> DataFrame:
    """One row, overall first-pass rate over universe rows."""
    return u.agg(
        F.count(F.col(s.doc)).alias("Total"),
        F.count_if(F.col("First_Pass")).alias("First_Pass_Count"),
    ).withColumn("First_Pass_Rate", pct("First_Pass_Count", "Total", digits))


def target_gap(rates: DataFrame, rate_col: str, p: Params) -> DataFrame:
    """Distance to the first-pass target and whether it is met."""
    return rates.withColumns({
        "Target_Gap": F.bround(F.lit(p.fp_target) - F.col(rate_col), 2),
        "Meets_Target": F.col(rate_col) >= F.lit(p.fp_target),
    })


def exception_invoices(rates: DataFrame, total: str = "Total",
                       fp: str = "First_Pass_Count") -> DataFrame:
    """Exception invoices = total - first-pass (complement count)."""
    return rates.withColumn("Exc_Invoices", F.col(total) - F.col(fp))


def monthly_events(m: DataFrame, s: LogSchema) -> DataFrame:
    """Material events per month (undated rows dropped)."""
    return nonnull(m, [s.month]).groupBy(s.month).agg(F.count(F.lit(1)).alias("Exception_Events"))


def monthly_invoices(df: DataFrame, s: LogSchema, name: str) -> DataFrame:
    """Distinct documents per month."""
    return nonnull(df, [s.month]).groupBy(s.month).agg(F.countDistinct(F.col(s.doc)).alias(name))


def monthly_trend(f: DataFrame, m: DataFrame, s: LogSchema, digits: int = 2) -> DataFrame:
    """Per month, all invoices vs exception invoices, rate by difference
    (J2 left join + P17 zero fill). A document seen in two months counts in both."""
    total = monthly_invoices(f, s, "Total_Invoices")
    exc = monthly_invoices(m, s, "Exc_Invoices")
    t = total.join(exc, on=s.month, how="left").na.fill(0, subset=["Exc_Invoices"])
    return t.withColumns({
        "First_Pass_Rate": pct(F.col("Total_Invoices") - F.col("Exc_Invoices"), "Total_Invoices", digits),
        "Month_str": F.col(s.month),
    })


def monthly_counts(f: DataFrame, s: LogSchema, special, name: str) -> DataFrame:
    """Per month, all documents and those with an event for which ``special``
    holds, in one pass: a (month, document) aggregate with a flag (J2, P17)."""
    pre = nonnull(f, [s.month]).groupBy(s.month, s.doc).agg(
        F.max(F.coalesce(special, F.lit(False))).alias("_special"))
    known = F.col(s.doc).isNotNull()
    return pre.groupBy(s.month).agg(F.count_if(known).alias("Total_Invoices"),
                                    F.count_if(known & F.col("_special")).alias(name))


def monthly_trend_single_pass(f: DataFrame, s: LogSchema, p: Params, digits: int = 2) -> DataFrame:
    """G17 when the material log is the full log minus the immaterial ids."""
    return monthly_counts(f, s, is_material(s, p), "Exc_Invoices").withColumns({
        "First_Pass_Rate": pct(F.col("Total_Invoices") - F.col("Exc_Invoices"), "Total_Invoices", digits),
        "Month_str": F.col(s.month),
    })


def resolve_partial_month(f: DataFrame, s: LogSchema, p: Params):
    """The partial month as a Column (literal, or the last month of ``f``)."""
    if p.partial_month is None:
        return None
    if p.partial_month == "latest":
        return f.select(F.max(F.col(s.month))).scalar()
    return F.lit(p.partial_month)


def drop_partial_month(df: DataFrame, s: LogSchema, partial) -> DataFrame:
    """Keep dated rows outside the partial month."""
    df = df.where(F.col(s.month).isNotNull())
    return df if partial is None else df.where(F.col(s.month) != partial)


def channel_monthly(u: DataFrame, f: DataFrame, s: LogSchema, p: Params, channel: str,
                    digits: int = 1) -> DataFrame:
    """One channel's universe, each document placed in the month of its
    earliest full-log row (J5 lookup, D2 keep-first), then first-pass by
    month x category; undated and partial months dropped. ``f`` only needs
    the document, month and order columns."""
    first_month = first_by_order(f, s.doc, s.month, [s.created_ts, *s.order_cols])
    cu = u.where(F.col(s.channel) == channel).join(first_month, on=s.doc, how="left")
    g = (cu.groupBy(s.month, s.category)
         .agg(F.count(F.col(s.doc)).alias("Total"),
              F.count_if(F.col("First_Pass")).alias("FP_Count"))
         .withColumn("FP_Rate", pct("FP_Count", "Total", digits)))
    g = nonnull(g, [s.category])
    return drop_partial_month(g, s, resolve_partial_month(f, s, p))


def channel_monthly_single_pass(f: DataFrame, s: LogSchema, p: Params, channel: str, digits: int = 1) -> DataFrame:
    """G28 when the material log is the full log minus the immaterial ids: one
    aggregate per (document, channel, category) has the flag, the earliest
    event and the last month; windows spread the first two over the document,
    and the last month of the log is the greatest of the small result."""
    first = F.struct(F.col(s.created_ts), *[order_key(f, c).alias(c) for c in s.order_cols],
                     F.col(s.month).alias("_m"))
    pre = f.groupBy(s.doc, s.channel, s.category).agg(
        F.max(is_material(s, p).cast("int")).alias("_mat"), F.min(first).alias("_first"),
        F.max(s.month).alias("_last"))
    w = Window.partitionBy(s.doc)
    inside = F.col(s.doc).isNotNull() & (F.col(s.channel) == channel) & F.col(s.category).isNotNull()
    rows = pre.select(F.min("_first").over(w)["_m"].alias(s.month), s.category, "_last",
                      (F.max("_mat").over(w) == 0).alias("_fp"), F.coalesce(inside, F.lit(False)).alias("_in"))
    g = rows.groupBy(s.month, s.category, "_in").agg(
        F.count(F.lit(1)).alias("Total"), F.count_if("_fp").alias("FP_Count"), F.max("_last").alias("_last"))
    # At most months x categories x 2 rows.
    last = F.max("_last").over(Window.partitionBy())
    g = g.withColumn("_partial", last if p.partial_month == "latest" else F.lit(p.partial_month).cast("string"))
    g = g.where(F.col("_in") & F.col(s.month).isNotNull())
    if p.partial_month is not None:
        g = g.where(F.col(s.month) != F.col("_partial"))
    return g.drop("_in", "_last", "_partial").withColumn("FP_Rate", pct("FP_Count", "Total", digits))


def segment_scalars(u: DataFrame, s: LogSchema, channel: str, category: str,
                    digits: int = 1) -> DataFrame:
    """Total, first-pass count and rate of one channel x category."""
    seg = u.where((F.col(s.channel) == channel) & (F.col(s.category) == category))
    return seg.agg(
        F.count(F.col(s.doc)).alias("Total"),
        F.count_if(F.col("First_Pass")).alias("First_Pass_Count"),
    ).withColumn("First_Pass_Rate", pct("First_Pass_Count", "Total", digits))


def external_first_pass(universe_docs: DataFrame, m: DataFrame, s: LogSchema,
                        digits: int = 1) -> DataFrame:
    """First-pass over an external invoice list: documents of the list
    without a material posted event, over all listed documents."""
    docs = nonnull(universe_docs.select(s.doc), [s.doc]).distinct()
    exc = m.select(s.doc).distinct().withColumn("_exc", F.lit(True))
    marked = docs.join(exc, on=s.doc, how="left")
    return marked.agg(
        F.count(F.lit(1)).alias("Universe_Invoices"),
        F.count_if(F.col("_exc").isNotNull()).alias("Exc_Invoices"),
    ).withColumns({
        "First_Pass_Count": F.col("Universe_Invoices") - F.col("Exc_Invoices"),
    }).withColumn("First_Pass_Rate", pct("First_Pass_Count", "Universe_Invoices", digits))
