"""Small relational rows of the inventory on the same log: P10-P17, D1-D3, T3-T5."""

from __future__ import annotations

from pyspark.sql import functions as F

from faultline.functions import clip_upper, pct
from faultline.operators import clean as C
from faultline.operators import deepdive as DD
from faultline.operators import freq as FQ
from faultline.operators.firstpass import drop_partial_month, resolve_partial_month
from faultline.operators.relational import first_by_order, top_k
from faultline.plans.q_firstpass import SEG_CAT_A, SEG_CHANNEL
from faultline.plans.registry import query


@query("p10_month_label", sql="""
SELECT DISTINCT "Month" AS "Month_str" FROM f WHERE "Month" IS NOT NULL
""")
def p10(ctx):
    s = ctx.s
    return ctx.f(()).select(F.col(s.month).alias("Month_str")).where(F.col("Month_str").isNotNull()).distinct()


@query("p11_equality_filter_on_id", sql="""
SELECT count(*) AS "Events", count(DISTINCT "Document Id") AS "Unique_Inv" FROM m WHERE "Exception ID" = 29
""")
def p11(ctx):
    s = ctx.s
    return DD.events_of(ctx.m(()), s, 29).agg(F.count(F.lit(1)).alias("Events"),
                                               F.countDistinct(s.doc).alias("Unique_Inv"))


@query("p12_exclusion_filters", sql=f"""
SELECT "Month", count(*) AS "Events" FROM m
WHERE "Month" IS NOT NULL AND "Month" <> (SELECT pm FROM pm)
  AND "Channel ID" IS NOT NULL AND "Channel ID" <> '{SEG_CHANNEL}'
  AND "PO category decription" IS NOT NULL AND "PO category decription" <> '{SEG_CAT_A}'
GROUP BY 1
""")
def p12(ctx):
    """Inequality filters with explicit null handling: a null never passes."""
    s = ctx.s
    f = ctx.f(("channel", "category"))
    m = C.material(f, s, ctx.p)
    rows = drop_partial_month(m, s, resolve_partial_month(ctx.f(()), s, ctx.p))
    rows = rows.where(F.col(s.channel).isNotNull() & (F.col(s.channel) != SEG_CHANNEL)
                      & F.col(s.category).isNotNull() & (F.col(s.category) != SEG_CAT_A))
    return rows.groupBy(s.month).agg(F.count(F.lit(1)).alias("Events"))


@query("p13_not_null_filter", sql="""
SELECT count(*) AS "Dated", count(*) FILTER (WHERE "Month" IS NULL) AS "Undated_Left" FROM m WHERE "Month" IS NOT NULL
""")
def p13(ctx):
    s = ctx.s
    d = ctx.m(()).where(F.col(s.month).isNotNull())
    return d.agg(F.count(F.lit(1)).alias("Dated"), F.count_if(F.col(s.month).isNull()).alias("Undated_Left"))


@query("p14_conjunctive_segment_filter", sql=f"""
SELECT count(*) AS "Rows", count(DISTINCT "Document Id") AS "Documents" FROM u
WHERE "Channel ID" = '{SEG_CHANNEL}' AND "PO category decription" = '{SEG_CAT_A}'
""")
def p14(ctx):
    s = ctx.s
    seg = ctx.u.where((F.col(s.channel) == SEG_CHANNEL) & (F.col(s.category) == SEG_CAT_A))
    return seg.agg(F.count(F.lit(1)).alias("Rows"), F.countDistinct(s.doc).alias("Documents"))


@query("p15_ratio_percent_rounded", sql="""
SELECT "Exception ID", count(*) AS "Events", count(DISTINCT "Document Id") AS "Invoices",
       round_even(CAST(count(DISTINCT "Document Id") AS DOUBLE) / count(*) * 100, 2) AS "Pct2",
       round_even(CAST(count(DISTINCT "Document Id") AS DOUBLE) / count(*) * 100, 1) AS "Pct1"
FROM m WHERE "Exception ID" IS NOT NULL GROUP BY 1
""")
def p15(ctx):
    s = ctx.s
    g = ctx.m(()).where(F.col(s.exc_id).isNotNull()).groupBy(s.exc_id).agg(
        F.count(F.lit(1)).alias("Events"), F.countDistinct(s.doc).alias("Invoices"))
    return g.withColumns({"Pct2": pct("Invoices", "Events", 2), "Pct1": pct("Invoices", "Events", 1)})


@query("p16_clip_upper", sql="""
SELECT least("Number of Touches", 10) AS "Touches", count(*) AS "Events" FROM m GROUP BY 1
""")
def p16(ctx):
    s = ctx.s
    return ctx.m(()).groupBy(clip_upper(s.touches, 10).alias("Touches")).agg(F.count(F.lit(1)).alias("Events"))


@query("p17_null_fill", sql="""
, t AS (SELECT DISTINCT "Month" FROM f WHERE "Month" IS NOT NULL),
e AS (SELECT "Month", count(*) AS n FROM m WHERE "Exception ID" = 38 AND "Channel ID" = 'AUTOMOBILE'
      AND "PO category decription" = 'SMALL' AND "Month" IS NOT NULL GROUP BY 1)
SELECT t."Month", coalesce(e.n, 0) AS "Events" FROM t LEFT JOIN e ON t."Month" = e."Month"
""")
def p17(ctx):
    s = ctx.s
    f = ctx.f(("channel", "category"))
    hit = (F.col(s.exc_id) == 38) & (F.col(s.channel) == "AUTOMOBILE") & (F.col(s.category) == "SMALL")
    return f.where(F.col(s.month).isNotNull()).groupBy(s.month).agg(F.count_if(hit).alias("Events"))


@query("d01_distinct_key_columns", sql="""
SELECT count(*) AS "Distinct_Rows" FROM (SELECT DISTINCT "Document Id", "Channel ID", "PO category decription" FROM f
  WHERE "Document Id" IS NOT NULL AND "Channel ID" IS NOT NULL AND "PO category decription" IS NOT NULL)
""")
def d01(ctx):
    return ctx.u.agg(F.count(F.lit(1)).alias("Distinct_Rows"))


@query("d02_keep_first_row_per_key", sql="""
SELECT "Document Id", arg_min("Month", ("Created at_dt", l_shipdate, l_linenumber, l_partkey, l_suppkey)) AS "Month"
FROM f WHERE "Document Id" IS NOT NULL GROUP BY 1
""")
def d02(ctx):
    s = ctx.s
    return first_by_order(ctx.f(()), s.doc, s.month, [s.created_ts, *s.order_cols])


@query("d03_distinct_values", sql="""
SELECT DISTINCT "PO category decription" FROM m WHERE "PO category decription" IS NOT NULL
""")
def d03(ctx):
    s = ctx.s
    return ctx.m(("category",)).select(s.category).where(F.col(s.category).isNotNull()).distinct()


@query("t03_limit_after_sort", sql="""
SELECT "Supplier", "Name 1", count(*) AS "Exception_Events" FROM m
WHERE "Supplier" IS NOT NULL AND "Name 1" IS NOT NULL GROUP BY 1, 2
ORDER BY 3 DESC, 1, 2 LIMIT 15
""")
def t03(ctx):
    s = ctx.s
    v = FQ.vendor_stats(ctx.m(()), s, names=ctx.vendor_names()).select(*s.vendor, "Exception_Events")
    return top_k(v, FQ.vendor_order(s), 15)


@query("t04_topk_first_seen_ties", sql=f"""
, fs AS (SELECT "Document Id", "Exception ID", min(("l_shipdate", l_linenumber, l_partkey, l_suppkey)) AS fo
         FROM m WHERE "Document Id" IS NOT NULL GROUP BY 1, 2),
sq AS (SELECT *, row_number() OVER w AS pos, lead("Exception ID") OVER w AS e1, lead(fo) OVER w AS f1
       FROM fs WINDOW w AS (PARTITION BY "Document Id" ORDER BY fo))
SELECT CAST("Exception ID" AS VARCHAR) || ' -> ' || CAST(e1 AS VARCHAR) AS "Pair", count(*) AS "Count"
FROM sq WHERE f1 IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, min(("Document Id", pos)) LIMIT 7
""")
def t04(ctx):
    from faultline.operators.sequences import top_ngrams
    return top_ngrams(ctx.m(()), ctx.s, 2, "Pair", 7)


@query("t05_histogram_order", sql="""
, d AS (SELECT "Document Id", max("Number of Touches") AS mt FROM f WHERE "Document Id" IS NOT NULL GROUP BY 1)
SELECT least(mt, 10) AS "Touches", count(*) AS "Invoice_Count" FROM d WHERE mt IS NOT NULL GROUP BY 1 ORDER BY 1
""")
def t05(ctx):
    return DD.touches_histogram(ctx.f(()), ctx.s).orderBy("Touches")
