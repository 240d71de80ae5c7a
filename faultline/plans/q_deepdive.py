"""Deep-dive and segment queries: G18-G23, G25-G27, G30, G37, G38, J3, P11-P14, P16, P19-P21, T2, T5."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from faultline.operators import clean as C
from faultline.operators import deepdive as DD
from faultline.operators import shape as SH
from faultline.operators.firstpass import resolve_partial_month
from faultline.operators.relational import per_document_counts
from faultline.plans.q_firstpass import SEG_CAT_A, SEG_CAT_B, SEG_CHANNEL
from faultline.plans.registry import query

# The source's three dives: 91 reads the full posted log (it is immaterial),
# 151 and 29 read the material log; 91 has no per-vendor average and no
# channel share, 151 alone has the touches histogram.
DIVES = ((91, "f"), (151, "m"), (29, "m"))
# Vendors removed from charts after their lists were cut (test-data names,
# mixed case and spacing on purpose).
EXCLUDED_VENDOR_NAMES = ("supplier#000000002 ", " SUPPLIER#000000013")


def _src(ctx, which, need):
    return ctx.f(need) if which == "f" else ctx.m(need)


def _register_dive(x: int, which: str):
    src = which

    @query(f"g18_dive{x}_by_category", sql=f"""
, g AS (SELECT "PO category decription", count("Document Id") AS "Events", count(DISTINCT "Document Id") AS "Unique_Inv"
        FROM {src} WHERE "Exception ID" = {x} AND "PO category decription" IS NOT NULL GROUP BY 1)
SELECT *, round_even(CAST("Events" AS DOUBLE) / (SELECT sum("Events") FROM g) * 100, 1) AS "Pct" FROM g
""")
    def g18(ctx):
        s = ctx.s
        return DD.by_category(DD.events_of(_src(ctx, src, ("category",)), s, x), s)

    pct_sql = (', round_even(CAST("Events" AS DOUBLE) / (SELECT sum("Events") FROM g) * 100, 1) AS "Pct_of_exc"'
               if src == "m" else "")

    @query(f"g19_dive{x}_channel_category", sql=f"""
, g AS (SELECT "Channel ID", "PO category decription", count("Document Id") AS "Events",
               count(DISTINCT "Document Id") AS "Unique_Inv"
        FROM {src} WHERE "Exception ID" = {x} AND "Channel ID" IS NOT NULL AND "PO category decription" IS NOT NULL
        GROUP BY 1, 2)
SELECT *{pct_sql} FROM g
""")
    def g19(ctx):
        s = ctx.s
        ev = DD.events_of(_src(ctx, src, ("category", "channel")), s, x)
        return DD.by_channel_category(ev, s, with_pct=(src == "m"))

    @query(f"g20_dive{x}_monthly_by_category", sql=f"""
SELECT "Month", "PO category decription", count(*) AS "Events" FROM {src}
WHERE "Exception ID" = {x} AND "Month" IS NOT NULL AND "PO category decription" IS NOT NULL
  AND "Month" <> (SELECT pm FROM pm)
GROUP BY 1, 2
""")
    def g20(ctx):
        return DD.by_month_category_single_pass(ctx.f(()), ctx.s, ctx.p, x, ctx.category_lookup())

    avg_sql = (', round_even(CAST("Events" AS DOUBLE) / "Unique_Inv", 2) AS "Avg_Exc_Per_Inv"'
               if src == "m" else "")

    @query(f"g21_dive{x}_top_vendors", sql=f"""
, g AS (SELECT "Supplier", "Name 1", count("Document Id") AS "Events", count(DISTINCT "Document Id") AS "Unique_Inv"
        FROM {src} WHERE "Exception ID" = {x} AND "Supplier" IS NOT NULL AND "Name 1" IS NOT NULL GROUP BY 1, 2
        ORDER BY "Events" DESC, "Supplier", "Name 1" LIMIT 20)
SELECT *{avg_sql} FROM g
""")
    def g21(ctx):
        s = ctx.s
        ev = DD.events_of(_src(ctx, src, ()), s, x)
        return DD.dive_vendors(ev, s, 20, with_avg=(src == "m"), names=ctx.vendor_names())

    @query(f"g22_dive{x}_cooccurring", sql=f"""
, d AS (SELECT DISTINCT "Document Id" FROM {src} WHERE "Exception ID" = {x} AND "Document Id" IS NOT NULL)
SELECT "Exception ID", "Exception description", count(*) AS "Count"
FROM {src} WHERE "Document Id" IN (SELECT "Document Id" FROM d) AND "Exception ID" <> {x}
  AND "Exception ID" IS NOT NULL AND "Exception description" IS NOT NULL
GROUP BY 1, 2 ORDER BY "Count" DESC, 1, 2 LIMIT 10
""")
    def g22(ctx):
        s = ctx.s
        rows = _src(ctx, src, ())
        return DD.cooccurring(rows, s, x, 10)


for _x, _w in DIVES:
    _register_dive(_x, _w)


@query("g23_dive151_touches_histogram", sql="""
, d AS (SELECT "Document Id", max("Number of Touches") AS mt FROM m
        WHERE "Exception ID" = 151 AND "Document Id" IS NOT NULL GROUP BY 1)
SELECT least(mt, 10) AS "Touches", count(*) AS "Invoice_Count" FROM d WHERE mt IS NOT NULL GROUP BY 1
""")
def g23(ctx):
    s = ctx.s
    return DD.touches_histogram(DD.events_of(ctx.m(()), s, 151), s).orderBy("Touches")


@query("g30_exception_totals", sql="""
SELECT 91 AS "Exception ID", count(*) AS "Events", count(DISTINCT "Document Id") AS "Unique_Inv" FROM f WHERE "Exception ID" = 91
UNION ALL
SELECT 151, count(*), count(DISTINCT "Document Id") FROM m WHERE "Exception ID" = 151
UNION ALL
SELECT 29, count(*), count(DISTINCT "Document Id") FROM m WHERE "Exception ID" = 29
""")
def g30(ctx):
    f = ctx.f(())
    return DD.exception_totals(f, (91, 151, 29), ctx.s)


VED_SQL = """
, v AS (SELECT "Supplier", "Name 1", count(*) AS ev FROM m WHERE "Supplier" IS NOT NULL AND "Name 1" IS NOT NULL
        GROUP BY 1, 2 ORDER BY ev DESC, 1, 2 LIMIT 20),
det AS (
  SELECT "Supplier", "Name 1", "Exception ID", "Exception description", count(*) AS "Count" FROM m
  WHERE "Supplier" IN (SELECT "Supplier" FROM v) AND "Name 1" IS NOT NULL
    AND "Exception ID" IS NOT NULL AND "Exception description" IS NOT NULL
  GROUP BY 1, 2, 3, 4
)"""


@query("g25_vendor_exception_detail", sql=VED_SQL + "\nSELECT * FROM det")
def g25(ctx):
    return DD.vendor_exception_detail(ctx.m(()), ctx.s, names=ctx.vendor_names()).orderBy(
        F.col(ctx.s.supplier).asc(), F.col("Count").desc())


@query("t02_multi_key_mixed_sort", sql=VED_SQL + """
SELECT * FROM det ORDER BY "Supplier" ASC, "Count" DESC, "Exception ID", "Name 1"
""")
def t02(ctx):
    """The whole detail table in (supplier asc, count desc) order."""
    s = ctx.s
    d = DD.vendor_exception_detail(ctx.m(()), s, names=ctx.vendor_names())
    return d.orderBy(F.col(s.supplier).asc(), F.col("Count").desc(), F.col(s.exc_id), F.col(s.vendor_name))


@query("g38_top_ids_over_vendor_set", sql=VED_SQL + """
SELECT "Exception ID", CAST(sum("Count") AS BIGINT) AS "Count" FROM det GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10
""")
def g38(ctx):
    s = ctx.s
    return DD.top_ids_over_vendor_set(DD.vendor_exception_detail(ctx.m(()), s, names=ctx.vendor_names()), s)


def _segment_sql(cat: str, passed: bool, src: str) -> str:
    return f"""
, d AS (SELECT DISTINCT "Document Id" FROM u WHERE "Channel ID" = '{SEG_CHANNEL}'
        AND "PO category decription" = '{cat}' AND "First_Pass" = {str(passed).lower()})
SELECT "Exception ID", "Exception description", count(*) AS "Count" FROM {src}
WHERE "Document Id" IN (SELECT "Document Id" FROM d) AND "Exception ID" IS NOT NULL AND "Exception description" IS NOT NULL
GROUP BY 1, 2
"""


@query("g26_failed_segment_profile", sql=_segment_sql(SEG_CAT_A, False, "m"))
def g26(ctx):
    return DD.segment_profile_single_pass(ctx.f(("channel", "category")), ctx.s, ctx.p, SEG_CHANNEL, SEG_CAT_A, False)


@query("g26b_failed_segment_profile_std", sql=_segment_sql(SEG_CAT_B, False, "m"))
def g26b(ctx):
    return DD.segment_profile_single_pass(ctx.f(("channel", "category")), ctx.s, ctx.p, SEG_CHANNEL, SEG_CAT_B, False)


@query("g27_passed_segment_profile", sql=_segment_sql(SEG_CAT_A, True, "f"))
def g27(ctx):
    return DD.segment_profile_single_pass(ctx.f(("channel", "category")), ctx.s, ctx.p, SEG_CHANNEL, SEG_CAT_A, True)


@query("g37_dense_month_category_grid", sql="""
, ev AS (SELECT * FROM f WHERE "Exception ID" = 91),
mo AS (SELECT DISTINCT "Month" FROM ev WHERE "Month" IS NOT NULL AND "Month" <> (SELECT pm FROM pm)),
ca AS (SELECT DISTINCT "PO category decription" FROM ev WHERE "PO category decription" IS NOT NULL),
ce AS (SELECT "Month", "PO category decription", count(*) AS "Events" FROM ev
       WHERE "Month" IS NOT NULL AND "PO category decription" IS NOT NULL GROUP BY 1, 2)
SELECT mo."Month", ca."PO category decription", coalesce(ce."Events", 0) AS "Events"
FROM mo CROSS JOIN ca LEFT JOIN ce ON mo."Month" = ce."Month" AND ca."PO category decription" = ce."PO category decription"
""")
def g37(ctx):
    return DD.monthly_category_grid(ctx.f(("category",)), ctx.s, ctx.p, 91).drop("Share_Pct")


@query("g37b_null_filled_rate_grid", sql="""
, ev AS (SELECT * FROM f WHERE "Exception ID" = 91),
mo AS (SELECT DISTINCT "Month" FROM ev WHERE "Month" IS NOT NULL AND "Month" <> (SELECT pm FROM pm)),
ca AS (SELECT DISTINCT "PO category decription" FROM ev WHERE "PO category decription" IS NOT NULL),
ce AS (SELECT "Month", "PO category decription", count(*) AS n, count(*) FILTER (WHERE "Exception ID" = 91) AS e
       FROM f WHERE "Month" IS NOT NULL AND "PO category decription" IS NOT NULL GROUP BY 1, 2)
SELECT mo."Month", ca."PO category decription", round_even(CAST(ce.e AS DOUBLE) / ce.n * 100, 1) AS "Share_Pct"
FROM mo CROSS JOIN ca LEFT JOIN ce ON mo."Month" = ce."Month" AND ca."PO category decription" = ce."PO category decription"
""")
def g37b(ctx):
    return DD.monthly_category_grid(ctx.f(("category",)), ctx.s, ctx.p, 91).drop("Events")


@query("j03_semi_join", sql="""
SELECT "Exception ID", count(*) AS "Rows" FROM f
WHERE "Document Id" IN (SELECT "Document Id" FROM m WHERE "Exception ID" = 151) GROUP BY 1
""")
def j03(ctx):
    s = ctx.s
    pre = per_document_counts(ctx.f(()), s.doc, [s.exc_id])
    raised = F.max(F.coalesce(F.col(s.exc_id) == 151, F.lit(False))).over(Window.partitionBy(s.doc))
    return (pre.withColumn("_raised", raised).where("_raised")
            .groupBy(s.exc_id).agg(F.sum("_n").cast("long").alias("Rows")))


@query("p21_drop_named_after_topk", sql=f"""
, g AS (SELECT "Supplier", "Name 1", count("Document Id") AS "Events", count(DISTINCT "Document Id") AS "Unique_Inv"
        FROM m WHERE "Exception ID" = 151 AND "Supplier" IS NOT NULL AND "Name 1" IS NOT NULL GROUP BY 1, 2
        ORDER BY "Events" DESC, "Supplier", "Name 1" LIMIT 20)
SELECT *, round_even(CAST("Events" AS DOUBLE) / "Unique_Inv", 2) AS "Avg_Exc_Per_Inv" FROM g
WHERE upper(trim("Name 1")) NOT IN ({", ".join("'" + n.strip().upper() + "'" for n in EXCLUDED_VENDOR_NAMES)})
""")
def p21(ctx):
    s = ctx.s
    top = DD.dive_vendors(DD.events_of(ctx.m(()), s, 151), s, 20, names=ctx.vendor_names())
    return SH.drop_named(top, s.vendor_name, EXCLUDED_VENDOR_NAMES)


@query("p19_exception_labels", sql="""
SELECT "Exception ID", "Exception description", count(*) AS "Count",
       CASE WHEN length('ID ' || CAST("Exception ID" AS VARCHAR) || ': ' || coalesce("Exception description", '')) > 12
            THEN substring('ID ' || CAST("Exception ID" AS VARCHAR) || ': ' || coalesce("Exception description", ''), 1, 12) || '…'
            ELSE 'ID ' || CAST("Exception ID" AS VARCHAR) || ': ' || coalesce("Exception description", '') END AS "Label",
       CASE WHEN length("Exception description") > 6 THEN substring("Exception description", 1, 6) || '…'
            ELSE "Exception description" END AS "Short_Name"
FROM m WHERE "Exception ID" IS NOT NULL AND "Exception description" IS NOT NULL GROUP BY 1, 2
""")
def p19(ctx):
    """Widths 12 and 6 so the test data's short labels are cut too; the chart
    widths (35, 45) are the defaults of the operators."""
    s = ctx.s
    g = DD.exception_counts(ctx.m(()), s)
    return SH.short_name(SH.exception_label(g, s.exc_id, s.exc_desc, width=12), s.exc_desc, width=6)


@query("p20_threshold_bands", sql="""
, g AS (SELECT "Channel ID", "PO category decription",
               round_even(CAST(count(*) FILTER (WHERE "First_Pass") AS DOUBLE) / count("Document Id") * 100, 2) AS r
        FROM u GROUP BY 1, 2)
SELECT "Channel ID", "PO category decription", r AS "First_Pass_Rate",
       CASE WHEN r >= 80 THEN 'high' WHEN r >= 50 THEN 'medium' ELSE 'low' END AS "Band",
       CASE WHEN r / 10 >= 3 THEN 'high' WHEN r / 10 >= 2 THEN 'medium' ELSE 'low' END AS "Intensity_Band"
FROM g
""")
def p20(ctx):
    from faultline.operators.firstpass import first_pass_by
    s = ctx.s
    r = first_pass_by(ctx.u, [s.channel, s.category], s).select(s.channel, s.category, "First_Pass_Rate")
    r = SH.with_band(r, "First_Pass_Rate", SH.FP_BANDS, "Band")
    r = r.withColumn("_i", F.col("First_Pass_Rate") / 10)
    return SH.with_band(r, "_i", SH.INTENSITY_BANDS, "Intensity_Band").drop("_i")


@query("p24_projection_rename", sql="""
SELECT "Channel ID" AS channel, count("Document Id") AS invoices,
       count(*) FILTER (WHERE "First_Pass") AS first_pass
FROM u GROUP BY 1
""")
def p24(ctx):
    from faultline.operators.firstpass import first_pass_by
    s = ctx.s
    r = first_pass_by(ctx.u, [s.channel], s)
    return SH.rename(r, {s.channel: "channel", "Total": "invoices", "First_Pass_Count": "first_pass"})
