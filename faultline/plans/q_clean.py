"""Queries over the cleaning stage: S7, P1-P10, G36."""

from __future__ import annotations

from pyspark.sql import functions as F

from faultline.operators import clean as C
from faultline.plans.registry import query


@query("s07_cleaning_funnel", sql="""
SELECT count(*) AS full_raw,
       count(*) FILTER (WHERE NOT starts_with("Supplier", '5')) AS full_clean_any_po,
       count(*) FILTER (WHERE NOT starts_with("Supplier", '5') AND "PO Type" IN ('1-URGENT','2-HIGH')) AS full_clean,
       count(*) FILTER (WHERE NOT starts_with("Supplier", '5') AND "PO Type" IN ('1-URGENT','2-HIGH')
                        AND "_posted") AS full_posted,
       count(*) FILTER (WHERE ("Exception ID" IS NULL OR "Exception ID" NOT IN (0, 91))) AS material_raw,
       count(*) FILTER (WHERE ("Exception ID" IS NULL OR "Exception ID" NOT IN (0, 91)) AND NOT starts_with("Supplier", '5')
                        AND "PO Type" IN ('1-URGENT','2-HIGH')) AS material_clean,
       count(*) FILTER (WHERE ("Exception ID" IS NULL OR "Exception ID" NOT IN (0, 91)) AND NOT starts_with("Supplier", '5')
                        AND "PO Type" IN ('1-URGENT','2-HIGH') AND "_posted") AS material_posted
FROM cl
""")
def s07(ctx):
    return C.cleaning_funnel(ctx.log(()), ctx.s, ctx.p)


@query("p01_supplier_trim", sql="""
SELECT "Supplier", count(*) AS "Count" FROM f GROUP BY "Supplier"
""")
def p01(ctx):
    s = ctx.s
    return ctx.f(()).groupBy(s.supplier).agg(F.count(F.lit(1)).alias("Count"))


@query("p02_prefix_exclusion", sql="""
SELECT count(*) AS "Rows", count(DISTINCT "Supplier") AS "Suppliers",
       count(*) FILTER (WHERE starts_with("Supplier", '5')) AS "Excluded_Left"
FROM cl WHERE NOT starts_with("Supplier", '5')
""")
def p02(ctx):
    s, p = ctx.s, ctx.p
    df = ctx.log(()).withColumn(s.supplier, C.normalized_supplier(s, p))
    df = df.where(~F.col(s.supplier).startswith(p.transport_prefix))
    return df.agg(F.count(F.lit(1)).alias("Rows"),
                  F.countDistinct(s.supplier).alias("Suppliers"),
                  F.count_if(F.col(s.supplier).startswith(p.transport_prefix)).alias("Excluded_Left"))


@query("p03_po_type_normalise", sql="""
SELECT "PO Type", count(*) AS "Count" FROM cl GROUP BY "PO Type"
""")
def p03(ctx):
    s = ctx.s
    return (ctx.log(()).withColumn(s.po_type, C.normalized_po(s))
            .groupBy(s.po_type).agg(F.count(F.lit(1)).alias("Count")))


@query("p04_po_type_in_list", sql="""
SELECT "PO Type", count(*) AS "Count" FROM cl WHERE "PO Type" IN ('1-URGENT','2-HIGH') GROUP BY "PO Type"
""")
def p04(ctx):
    s, p = ctx.s, ctx.p
    df = ctx.log(()).withColumn(s.po_type, C.normalized_po(s)).where(F.col(s.po_type).isin(*p.valid_po_types))
    return df.groupBy(s.po_type).agg(F.count(F.lit(1)).alias("Count"))


@query("p05_optional_po_filter", sql="""
SELECT "PO Type", count(*) AS "Count" FROM cl WHERE NOT starts_with("Supplier", '5')
  AND "_posted" GROUP BY "PO Type"
""")
def p05(ctx):
    s, p = ctx.s, ctx.p
    df = C.posted(C.clean(ctx.log(()), s, p, filter_po=False), s, p)
    return df.groupBy(s.po_type).agg(F.count(F.lit(1)).alias("Count"))


@query("p06_status_filter", sql="""
SELECT "Document Status", count(*) AS "Count" FROM cl WHERE "_posted" GROUP BY 1
""")
def p06(ctx):
    s, p = ctx.s, ctx.p
    return (ctx.log(()).where(C.is_posted(s, p))
            .groupBy(s.status).agg(F.count(F.lit(1)).alias("Count")))


@query("p07_amount_parse", sql="""
SELECT "Month", count("Amount") AS "Parsed", CAST(round(sum("Amount"), 2) AS DOUBLE) AS "Amount_Sum"
FROM f WHERE "Month" IS NOT NULL GROUP BY "Month"
""")
def p07(ctx):
    s = ctx.s
    return (ctx.f(()).where(F.col(s.month).isNotNull()).groupBy(s.month)
            .agg(F.count(s.amount).alias("Parsed"),
                 F.round(F.sum(s.amount), 2).alias("Amount_Sum")))


@query("p08_timestamp_parse", sql="""
SELECT count("Created at_dt") AS "Created_Parsed", count("Document Date_dt") AS "DocDate_Parsed",
       min("Created at_dt") AS "Created_Min", max("Document Date_dt") AS "DocDate_Max"
FROM f
""")
def p08(ctx):
    s = ctx.s
    return ctx.f(()).agg(
        F.count(s.created_ts).alias("Created_Parsed"), F.count(s.doc_date_ts).alias("DocDate_Parsed"),
        F.min(s.created_ts).cast("timestamp_ntz").alias("Created_Min"),
        F.max(s.doc_date_ts).cast("timestamp_ntz").alias("DocDate_Max"))


@query("p09_month_bucket", sql="""
SELECT "Month", count(*) AS "Events" FROM f WHERE "Month" IS NOT NULL GROUP BY "Month"
""")
def p09(ctx):
    s = ctx.s
    return ctx.f(()).where(F.col(s.month).isNotNull()).groupBy(s.month).agg(F.count(F.lit(1)).alias("Events"))


@query("g36_parse_failure_rate", sql="""
SELECT count(*) AS "Rows",
       count(*) FILTER (WHERE "Gross Invoice Amount" IS NOT NULL AND "Amount" IS NULL) AS "Unparsed",
       round_even(CAST(count(*) FILTER (WHERE "Gross Invoice Amount" IS NOT NULL AND "Amount" IS NULL) AS DOUBLE)
                  / count(*) * 100, 2) AS "Unparsed_Pct",
       count(*) FILTER (WHERE "Created at" IS NOT NULL AND "Created at_dt" IS NULL) AS "Undated",
       round_even(CAST(count(*) FILTER (WHERE "Created at" IS NOT NULL AND "Created at_dt" IS NULL) AS DOUBLE)
                  / count(*) * 100, 2) AS "Undated_Pct"
FROM f
""")
def g36(ctx):
    return C.parse_failure_rate(ctx.f(()), ctx.s)
