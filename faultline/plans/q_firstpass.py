"""First-pass, KPI and monthly queries: G6-G10, G15-G17, G28, G29, G34, G35, P26, P27, J2, J4, J5."""

from __future__ import annotations

from pyspark.sql import functions as F

from faultline.operators import clean as C
from faultline.operators import firstpass as FP
from faultline.operators import freq as FQ
from faultline.operators.relational import first_by_order, with_share
from faultline.plans.registry import query

# Segment used for the single-channel deep dives (one channel and two of its
# categories; here values of the test data's channel and category columns).
SEG_CHANNEL = "BUILDING"
SEG_CAT_A = "PROMO"
SEG_CAT_B = "STANDARD"


@query("g06_invoice_universe", sql="""
SELECT "Channel ID", "PO category decription", count(*) AS "Rows",
       count(DISTINCT "Document Id") AS "Documents",
       count(*) FILTER (WHERE "First_Pass") AS "First_Pass_Rows"
FROM u GROUP BY 1, 2
""")
def g06(ctx):
    s = ctx.s
    return ctx.u.groupBy(s.channel, s.category).agg(
        F.count(F.lit(1)).alias("Rows"), F.countDistinct(s.doc).alias("Documents"),
        F.count_if("First_Pass").alias("First_Pass_Rows"))


@query("g07_first_pass_by_channel", sql="""
SELECT "Channel ID", count("Document Id") AS "Total",
       count(*) FILTER (WHERE "First_Pass") AS "First_Pass_Count",
       round_even(CAST(count(*) FILTER (WHERE "First_Pass") AS DOUBLE) / count("Document Id") * 100, 2) AS "First_Pass_Rate"
FROM u GROUP BY 1
""")
def g07(ctx):
    return FP.first_pass_by(ctx.u, [ctx.s.channel], ctx.s).orderBy(ctx.s.channel)


@query("g08_first_pass_by_channel_category", sql="""
SELECT "Channel ID", "PO category decription", count("Document Id") AS "Total",
       count(*) FILTER (WHERE "First_Pass") AS "First_Pass_Count",
       round_even(CAST(count(*) FILTER (WHERE "First_Pass") AS DOUBLE) / count("Document Id") * 100, 2) AS "First_Pass_Rate"
FROM u GROUP BY 1, 2
""")
def g08(ctx):
    s = ctx.s
    return FP.first_pass_by(ctx.u, [s.channel, s.category], s).orderBy(s.channel, s.category)


@query("g08b_channel_category_fp_1digit", sql="""
SELECT "Channel ID", "PO category decription", count("Document Id") AS "Total",
       count(*) FILTER (WHERE "First_Pass") AS "FP_Count",
       round_even(CAST(count(*) FILTER (WHERE "First_Pass") AS DOUBLE) / count("Document Id") * 100, 1) AS "FP_Rate"
FROM u GROUP BY 1, 2
""")
def g08b(ctx):
    s = ctx.s
    return FP.first_pass_by(ctx.u, [s.channel, s.category], s, digits=1,
                            count_name="FP_Count", rate_name="FP_Rate")


@query("g09_overall_first_pass", sql="""
SELECT count("Document Id") AS "Total", count(*) FILTER (WHERE "First_Pass") AS "First_Pass_Count",
       round_even(CAST(count(*) FILTER (WHERE "First_Pass") AS DOUBLE) / count("Document Id") * 100, 1) AS "First_Pass_Rate"
FROM u
""")
def g09(ctx):
    return FP.overall_first_pass(ctx.u, ctx.s)


@query("g10_kpi_row", sql="""
, vend AS (
  SELECT "Supplier", "Name 1", count(*) AS ev FROM m
  WHERE "Supplier" IS NOT NULL AND "Name 1" IS NOT NULL GROUP BY 1, 2
), top10 AS (SELECT ev FROM vend ORDER BY ev DESC LIMIT 10)
SELECT (SELECT count(DISTINCT "Document Id") FROM u) AS total_invoices,
       (SELECT count(*) FILTER (WHERE "First_Pass") FROM u) AS first_pass_count,
       (SELECT round_even(CAST(count(*) FILTER (WHERE "First_Pass") AS DOUBLE) / count(*) * 100, 1) FROM u) AS first_pass_rate,
       (SELECT count(*) FROM m) AS total_exception_events,
       (SELECT count(DISTINCT "Supplier") FROM vend) AS unique_vendors_with_exceptions,
       round_even(CAST((SELECT sum(ev) FROM top10) AS DOUBLE) / (SELECT sum(ev) FROM vend) * 100, 1) AS top10_vendor_pct
""")
def g10(ctx):
    return FQ.kpi_row_single_pass(ctx.f(("category", "channel")), ctx.s, ctx.p, ctx.vendor_names())


@query("g15_monthly_events", sql="""
SELECT "Month", count(*) AS "Exception_Events" FROM m WHERE "Month" IS NOT NULL GROUP BY 1
""")
def g15(ctx):
    return FP.monthly_events(ctx.m(()), ctx.s)


@query("g16_monthly_invoices", sql="""
SELECT "Month", count(DISTINCT "Document Id") AS "Total_Invoices" FROM f WHERE "Month" IS NOT NULL GROUP BY 1
""")
def g16(ctx):
    return FP.monthly_invoices(ctx.f(()), ctx.s, "Total_Invoices")


@query("g17_monthly_trend", sql="""
, t AS (SELECT "Month", count(DISTINCT "Document Id") AS "Total_Invoices" FROM f WHERE "Month" IS NOT NULL GROUP BY 1),
e AS (SELECT "Month", count(DISTINCT "Document Id") AS "Exc_Invoices" FROM m WHERE "Month" IS NOT NULL GROUP BY 1)
SELECT t."Month", t."Total_Invoices", coalesce(e."Exc_Invoices", 0) AS "Exc_Invoices",
       round_even(CAST(t."Total_Invoices" - coalesce(e."Exc_Invoices", 0) AS DOUBLE) / t."Total_Invoices" * 100, 2) AS "First_Pass_Rate",
       t."Month" AS "Month_str"
FROM t LEFT JOIN e ON t."Month" = e."Month"
""")
def g17(ctx):
    f = ctx.f(())
    return FP.monthly_trend_single_pass(f, ctx.s, ctx.p).orderBy(ctx.s.month)


@query("g28_channel_monthly_by_category", sql=f"""
, fm AS (
  SELECT "Document Id", arg_min("Month", ("Created at_dt", l_shipdate, l_linenumber, l_partkey, l_suppkey)) AS "Month"
  FROM f WHERE "Document Id" IS NOT NULL GROUP BY 1
), g AS (
  SELECT fm."Month", u."PO category decription", count(u."Document Id") AS "Total",
         count(*) FILTER (WHERE u."First_Pass") AS "FP_Count"
  FROM u LEFT JOIN fm ON u."Document Id" = fm."Document Id"
  WHERE u."Channel ID" = '{SEG_CHANNEL}' GROUP BY 1, 2
)
SELECT "Month", "PO category decription", "Total", "FP_Count",
       round_even(CAST("FP_Count" AS DOUBLE) / "Total" * 100, 1) AS "FP_Rate"
FROM g WHERE "Month" IS NOT NULL AND "Month" <> (SELECT pm FROM pm)
""")
def g28(ctx):
    return FP.channel_monthly_single_pass(ctx.f(("channel", "category")), ctx.s, ctx.p, SEG_CHANNEL)


@query("g29_segment_scalars", sql=f"""
SELECT count("Document Id") AS "Total", count(*) FILTER (WHERE "First_Pass") AS "First_Pass_Count",
       round_even(CAST(count(*) FILTER (WHERE "First_Pass") AS DOUBLE) / count("Document Id") * 100, 1) AS "First_Pass_Rate"
FROM u WHERE "Channel ID" = '{SEG_CHANNEL}' AND "PO category decription" = '{SEG_CAT_A}'
""")
def g29(ctx):
    return FP.segment_scalars(ctx.u, ctx.s, SEG_CHANNEL, SEG_CAT_A)


@query("g34_channel_volume_share", sql="""
, g AS (SELECT "Channel ID", count("Document Id") AS "Total" FROM u GROUP BY 1)
SELECT "Channel ID", "Total", round_even(CAST("Total" AS DOUBLE) / (SELECT sum("Total") FROM g) * 100, 1) AS "Share_Pct"
FROM g
""")
def g34(ctx):
    s = ctx.s
    g = FP.first_pass_by(ctx.u, [s.channel], s).select(s.channel, "Total")
    return with_share(g, "Total", "Share_Pct", 1)


@query("g35_external_universe_first_pass", sql="""
, ext AS (SELECT DISTINCT o_orderkey AS "Document Id" FROM orders
          WHERE o_orderstatus = 'F' AND upper(trim(o_orderpriority)) IN ('1-URGENT', '2-HIGH')),
mk AS (SELECT e."Document Id", x."Document Id" IS NOT NULL AS exc FROM ext e LEFT JOIN xd x ON e."Document Id" = x."Document Id")
SELECT count(*) AS "Universe_Invoices", count(*) FILTER (WHERE exc) AS "Exc_Invoices",
       count(*) - count(*) FILTER (WHERE exc) AS "First_Pass_Count",
       round_even(CAST(count(*) - count(*) FILTER (WHERE exc) AS DOUBLE) / count(*) * 100, 1) AS "First_Pass_Rate"
FROM mk
""")
def g35(ctx):
    """External invoice list = the orders table itself (status posted, valid
    priority), independent of which orders raised events."""
    s, p = ctx.s, ctx.p
    o = ctx.table("orders")
    ext = (o.where((F.col("o_orderstatus") == p.posted_status)
                   & F.upper(F.trim("o_orderpriority")).isin(*p.valid_po_types))
           .select(F.col("o_orderkey").alias(s.doc)))
    return FP.external_first_pass(ext, ctx.m(()), s)


@query("p26_target_gap", sql="""
SELECT "Channel ID", round_even(CAST(count(*) FILTER (WHERE "First_Pass") AS DOUBLE) / count("Document Id") * 100, 2) AS "First_Pass_Rate",
       round_even(80.0 - round_even(CAST(count(*) FILTER (WHERE "First_Pass") AS DOUBLE) / count("Document Id") * 100, 2), 2) AS "Target_Gap",
       round_even(CAST(count(*) FILTER (WHERE "First_Pass") AS DOUBLE) / count("Document Id") * 100, 2) >= 80.0 AS "Meets_Target"
FROM u GROUP BY 1
""")
def p26(ctx):
    s = ctx.s
    r = FP.first_pass_by(ctx.u, [s.channel], s).select(s.channel, "First_Pass_Rate")
    return FP.target_gap(r, "First_Pass_Rate", ctx.p)


@query("p27_exception_invoices_complement", sql="""
SELECT "Channel ID", count("Document Id") AS "Total", count(*) FILTER (WHERE "First_Pass") AS "First_Pass_Count",
       count("Document Id") - count(*) FILTER (WHERE "First_Pass") AS "Exc_Invoices"
FROM u GROUP BY 1
""")
def p27(ctx):
    s = ctx.s
    r = FP.first_pass_by(ctx.u, [s.channel], s).drop("First_Pass_Rate")
    return FP.exception_invoices(r)


@query("j02_left_join_fill", sql="""
, t AS (SELECT "Month", count(DISTINCT "Document Id") AS "Total_Invoices" FROM f WHERE "Month" IS NOT NULL GROUP BY 1),
e AS (SELECT "Month", count(DISTINCT "Document Id") AS "Exc_Invoices" FROM m
      WHERE "Month" IS NOT NULL AND "Exception ID" = 151 GROUP BY 1)
SELECT t."Month", t."Total_Invoices", coalesce(e."Exc_Invoices", 0) AS "Exc_Invoices"
FROM t LEFT JOIN e ON t."Month" = e."Month"
""")
def j02(ctx):
    """Months without any event of one id keep a zero row (J2 + P17)."""
    s = ctx.s
    return FP.monthly_counts(ctx.f(()), s, F.col(s.exc_id) == 151, "Exc_Invoices")


@query("p27b_monthly_first_pass_count", sql="""
, t AS (SELECT "Month", count(DISTINCT "Document Id") AS "Total_Invoices" FROM f WHERE "Month" IS NOT NULL GROUP BY 1),
e AS (SELECT "Month", count(DISTINCT "Document Id") AS "Exc_Invoices" FROM m WHERE "Month" IS NOT NULL GROUP BY 1)
SELECT t."Month", t."Total_Invoices", coalesce(e."Exc_Invoices", 0) AS "Exc_Invoices",
       t."Total_Invoices" - coalesce(e."Exc_Invoices", 0) AS "First_Pass_Count"
FROM t LEFT JOIN e ON t."Month" = e."Month"
""")
def p27b(ctx):
    t = FP.monthly_counts(ctx.f(()), ctx.s, C.is_material(ctx.s, ctx.p), "Exc_Invoices")
    return t.withColumn("First_Pass_Count", F.col("Total_Invoices") - F.col("Exc_Invoices"))


@query("j04_existence_join", sql="""
SELECT "First_Pass", count(*) AS "Rows", count(DISTINCT "Document Id") AS "Documents" FROM u GROUP BY 1
""")
def j04(ctx):
    """The explicit mark join of two extracts (full log, material log)."""
    s = ctx.s
    return ctx.u_two_logs().groupBy("First_Pass").agg(F.count(F.lit(1)).alias("Rows"),
                                           F.countDistinct(s.doc).alias("Documents"))


@query("j05_lookup_first_month", sql="""
, fm AS (
  SELECT "Document Id", arg_min("Month", ("Created at_dt", l_shipdate, l_linenumber, l_partkey, l_suppkey)) AS "Month"
  FROM f WHERE "Document Id" IS NOT NULL GROUP BY 1
)
SELECT fm."Month", count(*) AS "Documents", count(*) FILTER (WHERE u."First_Pass") AS "First_Pass_Docs"
FROM u LEFT JOIN fm ON u."Document Id" = fm."Document Id" GROUP BY 1
""")
def j05(ctx):
    s = ctx.s
    fm = first_by_order(ctx.f(()), s.doc, s.month, [s.created_ts, *s.order_cols])
    return (ctx.u.join(fm, on=s.doc, how="left").groupBy(s.month)
            .agg(F.count(F.lit(1)).alias("Documents"), F.count_if("First_Pass").alias("First_Pass_Docs")))
