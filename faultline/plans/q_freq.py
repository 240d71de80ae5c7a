"""Frequency, vendor and concentration queries: G1-G5, G24, G31-G33, G39,
W1-W5, P22-P25, T1-T3, T6, J1, J6."""

from __future__ import annotations

from pyspark.sql import functions as F

from faultline.operators import freq as FQ
from faultline.operators import pareto as PA
from faultline.operators.relational import top_k
from faultline.plans.registry import query

VEND_CTE = """
, vend AS (
  SELECT "Supplier", "Name 1", count(DISTINCT "Document Id") AS "Unique_Invoices", count(*) AS "Exception_Events",
         round_even(CAST(count(*) AS DOUBLE) / count(DISTINCT "Document Id"), 2) AS "Avg_Exc_Per_Inv"
  FROM m WHERE "Supplier" IS NOT NULL AND "Name 1" IS NOT NULL GROUP BY 1, 2
)"""

CONC_CTE = VEND_CTE + """,
conc AS (
  SELECT *, row_number() OVER w AS "Rank",
         CAST(sum("Exception_Events") OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS "Cumulative_Events"
  FROM vend WINDOW w AS (ORDER BY "Exception_Events" DESC, "Supplier", "Name 1")
),
concp AS (
  SELECT *, round_even(CAST("Cumulative_Events" AS DOUBLE) / (SELECT sum("Exception_Events") FROM vend) * 100, 2) AS "Cumulative_Pct"
  FROM conc
)"""

FREQ_SQL = """
, g AS (SELECT "Exception ID", "Exception description", count(*) AS "Count" FROM m
        WHERE "Exception ID" IS NOT NULL AND "Exception description" IS NOT NULL GROUP BY 1, 2)
SELECT *, round_even(CAST("Count" AS DOUBLE) / (SELECT sum("Count") FROM g) * 100, 2) AS "Pct" FROM g
"""


@query("g01_exception_frequency", sql=FREQ_SQL)
def g01(ctx):
    s = ctx.s
    return FQ.exception_frequency(ctx.m(()), s).orderBy(F.col("Count").desc(), s.exc_id)


@query("g02_share_of_grouped_total", sql="""
, g AS (SELECT "PO category decription", count(*) AS "Exception_Events" FROM m
        WHERE "PO category decription" IS NOT NULL GROUP BY 1)
SELECT *, round_even(CAST("Exception_Events" AS DOUBLE) / (SELECT sum("Exception_Events") FROM g) * 100, 1) AS "Pct" FROM g
""")
def g02(ctx):
    from faultline.operators.relational import with_share
    return with_share(FQ.category_totals(ctx.m(()), ctx.s, ctx.category_lookup()), "Exception_Events", "Pct", 1)


@query("g03_top_vendors", sql=VEND_CTE + """
SELECT * FROM vend ORDER BY "Exception_Events" DESC, "Supplier", "Name 1" LIMIT 50
""")
def g03(ctx):
    return FQ.top_vendors(ctx.m(()), ctx.s, 50, names=ctx.vendor_names())


@query("g04_category_by_exception", sql="""
SELECT "PO category decription", "Exception ID", "Exception description", count(*) AS "Count" FROM m
WHERE "PO category decription" IS NOT NULL AND "Exception ID" IS NOT NULL AND "Exception description" IS NOT NULL
GROUP BY 1, 2, 3
""")
def g04(ctx):
    s = ctx.s
    return FQ.category_exceptions(ctx.m(()), s, ctx.category_lookup()).orderBy(
        F.col(s.category).asc(), F.col("Count").desc(), s.exc_id)


@query("g05_category_totals", sql="""
SELECT "PO category decription", count(*) AS "Exception_Events" FROM m
WHERE "PO category decription" IS NOT NULL GROUP BY 1
""")
def g05(ctx):
    return FQ.category_totals(ctx.m(()), ctx.s, ctx.category_lookup()).orderBy(F.col("Exception_Events").desc())


@query("g24_crosstab_category_channel", sql="""
SELECT "PO category decription", "Channel ID", count(*) AS "Count"
FROM f WHERE "Exception ID" = 91 AND "PO category decription" IS NOT NULL GROUP BY 1, 2
""")
def g24(ctx):
    s = ctx.s
    f91 = ctx.f(("category", "channel")).where(F.col(s.exc_id) == 91)
    return FQ.crosstab(f91, s.category, s.channel)


@query("g31_key_exception_table", sql="""
, k AS (
  SELECT "Exception ID", count(*) AS "Raw_Events", count(DISTINCT "Document Id") AS "Invoices" FROM m
  WHERE "Exception ID" IN (151, 29, 75, 2, 38, 82, 37) GROUP BY 1
), k2 AS (
  SELECT *, CASE WHEN "Exception ID" = 37 THEN CAST(round("Raw_Events" * 1.06, 0) AS BIGINT) ELSE "Raw_Events" END AS "Events"
  FROM k
)
SELECT *, round_even(CAST("Events" AS DOUBLE) / (SELECT count(*) FROM m) * 100, 1) AS "Pct_All",
       round_even(CAST("Invoices" AS DOUBLE) / (SELECT count(DISTINCT "Document Id") FROM u) * 100, 1) AS "Pct_Universe",
       round_even(CAST("Events" AS DOUBLE) / "Invoices", 2) AS "Avg_Per_Invoice",
       "Events" - "Invoices" AS "Repeat_Gap",
       round_even(CAST("Events" AS DOUBLE) / (SELECT sum("Events") FROM k2) * 100, 1) AS "Share_Of_Set"
FROM k2
""")
def g31(ctx):
    return FQ.key_exception_table_single_pass(ctx.f(("category", "channel")), ctx.s, ctx.p)


@query("g32_repeat_touch_gap", sql="""
SELECT "Exception ID", count(*) AS "Events", count(DISTINCT "Document Id") AS "Invoices",
       count(*) - count(DISTINCT "Document Id") AS "Repeat_Gap",
       round_even(CAST(count(*) AS DOUBLE) / count(DISTINCT "Document Id"), 2) AS "Events_Per_Invoice"
FROM m WHERE "Exception ID" IS NOT NULL GROUP BY 1
""")
def g32(ctx):
    s = ctx.s
    g = ctx.m(()).where(F.col(s.exc_id).isNotNull()).groupBy(s.exc_id).agg(
        F.count(F.lit(1)).alias("Events"), F.countDistinct(s.doc).alias("Invoices"))
    return g.withColumns({
        "Repeat_Gap": F.col("Events") - F.col("Invoices"),
        "Events_Per_Invoice": F.bround(F.col("Events").cast("double") / F.col("Invoices"), 2),
    })


@query("g33_dimension_share_in_exception", sql="""
, g AS (SELECT "Channel ID", count(*) AS "Events" FROM m WHERE "Exception ID" = 151 AND "Channel ID" IS NOT NULL GROUP BY 1)
SELECT *, round_even(CAST("Events" AS DOUBLE) / (SELECT sum("Events") FROM g) * 100, 1) AS "Share_Pct" FROM g
""")
def g33(ctx):
    return FQ.dimension_share(ctx.m(("channel",)), ctx.s, 151, ctx.s.channel)


@query("g33b_po_type_share_in_exception", sql="""
, g AS (SELECT "PO Type", count(*) AS "Events" FROM m WHERE "Exception ID" = 29 AND "PO Type" IS NOT NULL GROUP BY 1)
SELECT *, round_even(CAST("Events" AS DOUBLE) / (SELECT sum("Events") FROM g) * 100, 1) AS "Share_Pct" FROM g
""")
def g33b(ctx):
    return FQ.dimension_share(ctx.m(()), ctx.s, 29, ctx.s.po_type)


@query("g39_vendor_intensity", sql=VEND_CTE + """
SELECT * FROM vend WHERE "Unique_Invoices" >= 10
ORDER BY "Avg_Exc_Per_Inv" DESC, "Exception_Events" DESC, "Supplier", "Name 1" LIMIT 20
""")
def g39(ctx):
    return FQ.vendor_intensity(ctx.m(()), ctx.s, ctx.p.min_invoices, 20, names=ctx.vendor_names())


@query("p25_having_min_invoices", sql=VEND_CTE + """
SELECT * FROM vend WHERE "Unique_Invoices" >= 10
""")
def p25(ctx):
    return FQ.vendor_stats(ctx.m(()), ctx.s, names=ctx.vendor_names()).where(F.col("Unique_Invoices") >= ctx.p.min_invoices)


@query("g07w_workload_concentration", sql=CONC_CTE + """
SELECT "Supplier", "Name 1", "Unique_Invoices", "Exception_Events", "Avg_Exc_Per_Inv",
       "Cumulative_Events", "Cumulative_Pct" FROM concp
""")
def g07w(ctx):
    s = ctx.s
    v = FQ.vendor_stats(ctx.m(()), s, names=ctx.vendor_names())
    return PA.workload_concentration(v, s.vendor).drop("Rank")


@query("w01_running_sum", sql=CONC_CTE + """
SELECT "Supplier", "Name 1", "Exception_Events", "Cumulative_Events" FROM conc
""")
def w01(ctx):
    s = ctx.s
    v = FQ.vendor_stats(ctx.m(()), s, names=ctx.vendor_names())
    return PA.global_running_sum(v, "Exception_Events", s.vendor).select(
        *s.vendor, "Exception_Events", "Cumulative_Events")


@query("w02_cumulative_share", sql=CONC_CTE + """
SELECT "Supplier", "Name 1", "Cumulative_Pct" FROM concp
""")
def w02(ctx):
    s = ctx.s
    v = FQ.vendor_stats(ctx.m(()), s, names=ctx.vendor_names())
    return PA.workload_concentration(v, s.vendor).select(*s.vendor, "Cumulative_Pct")


@query("w03_row_number", sql=CONC_CTE + """
SELECT "Supplier", "Name 1", "Rank" FROM conc
""")
def w03(ctx):
    s = ctx.s
    v = FQ.vendor_stats(ctx.m(()), s, names=ctx.vendor_names())
    return PA.global_running_sum(v, "Exception_Events", s.vendor).select(*s.vendor, "Rank")


@query("w04_top_n_concentration", sql=CONC_CTE + """
SELECT """ + ",\n".join(
    f"""round_even(CAST(sum(CASE WHEN "Rank" <= {n} THEN "Exception_Events" ELSE 0 END) AS DOUBLE)
          / sum("Exception_Events") * 100, 1) AS "Top{n}_Pct",
       max(CASE WHEN "Rank" = {n} THEN "Cumulative_Pct" END) AS "Cum_Pct_At_{n}\"""" for n in (10, 20, 50)) + """
FROM concp
""")
def w04(ctx):
    s = ctx.s
    v = FQ.vendor_stats(ctx.m(()), s, names=ctx.vendor_names())
    return PA.top_n_concentration(PA.workload_concentration(v, s.vendor))


@query("t01_sort_desc", sql=FREQ_SQL + """
ORDER BY "Count" DESC, "Exception ID"
""")
def t01(ctx):
    """The whole frequency table, single-key descending sort (ties by id)."""
    s = ctx.s
    return FQ.exception_frequency(ctx.m(()), s).orderBy(F.col("Count").desc(), F.col(s.exc_id))


@query("t06_limit_in_category_order", sql="""
SELECT "PO category decription", "Exception ID", "Exception description", count(*) AS "Count" FROM m
WHERE "PO category decription" IS NOT NULL AND "Exception ID" IS NOT NULL AND "Exception description" IS NOT NULL
GROUP BY 1, 2, 3 ORDER BY 1, 4 DESC, 2 LIMIT 60
""")
def t06(ctx):
    s = ctx.s
    return top_k(FQ.category_exceptions(ctx.m(()), s, ctx.category_lookup()),
                 [F.col(s.category).asc(), F.col("Count").desc(), F.col(s.exc_id).asc()], 60)


@query("p22_highlight_flag", sql=FREQ_SQL.replace(
    'SELECT *, round_even', 'SELECT *, coalesce("Exception ID" IN (1, 38), false) AS "Highlight", round_even'))
def p22(ctx):
    s = ctx.s
    return FQ.highlight(FQ.exception_frequency(ctx.m(()), s), s.exc_id)


@query("p23_scaled_count", sql="""
SELECT "Exception ID", count(*) AS "Count",
       CASE WHEN "Exception ID" = 37 THEN CAST(round(count(*) * 1.06, 0) AS BIGINT) ELSE count(*) END AS "Adjusted"
FROM m WHERE "Exception ID" IS NOT NULL GROUP BY 1
""")
def p23(ctx):
    s = ctx.s
    g = ctx.m(()).where(F.col(s.exc_id).isNotNull()).groupBy(s.exc_id).agg(F.count(F.lit(1)).alias("Count"))
    return g.withColumn("Adjusted", FQ.scaled_count("Count", s.exc_id))


@query("j01_vendor_join_fused", sql=VEND_CTE + """
SELECT "Supplier", "Name 1", "Unique_Invoices", "Exception_Events" FROM vend
""")
def j01(ctx):
    """The source joins two groupings of the same key; one aggregate does both."""
    return FQ.vendor_stats(ctx.m(()), ctx.s, names=ctx.vendor_names()).drop("Avg_Exc_Per_Inv")
