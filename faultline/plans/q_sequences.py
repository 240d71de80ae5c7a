"""Sequence queries: G11-G14, A1-A5, W6, D4, P18, T4, T5."""

from __future__ import annotations

from pyspark.sql import functions as F

from faultline.operators import sequences as SQ
from faultline.operators.relational import per_document_counts
from faultline.plans.registry import query

ORDER = '("l_shipdate", l_linenumber, l_partkey, l_suppkey)'

FS_CTE = f"""
, fs AS (
  SELECT "Document Id", "Exception ID", min({ORDER}) AS fo FROM m
  WHERE "Document Id" IS NOT NULL GROUP BY 1, 2
), sq AS (
  SELECT *, row_number() OVER w AS pos, lead("Exception ID", 1) OVER w AS e1, lead("Exception ID", 2) OVER w AS e2,
         lead(fo, 1) OVER w AS f1, lead(fo, 2) OVER w AS f2
  FROM fs WINDOW w AS (PARTITION BY "Document Id" ORDER BY fo)
)"""


@query("g11_exception_count_histogram", sql="""
, d AS (SELECT "Document Id", count(*) AS n FROM m WHERE "Document Id" IS NOT NULL GROUP BY 1)
SELECT n AS "N_Exceptions", count(*) AS "Invoice_Count" FROM d GROUP BY 1
""")
def g11(ctx):
    return SQ.exceptions_per_invoice(ctx.m(()), ctx.s).orderBy("N_Exceptions")


@query("g12_exception_sequence", sql=f"""
SELECT "Document Id", row_number() OVER (PARTITION BY "Document Id" ORDER BY {ORDER}) AS "Position", "Exception ID"
FROM m WHERE "Document Id" IS NOT NULL
""")
def g12(ctx):
    return SQ.exception_sequence(ctx.m(()), ctx.s)


@query("g13_exception_pairs", sql=FS_CTE + """
SELECT CAST("Exception ID" AS VARCHAR) || ' -> ' || CAST(e1 AS VARCHAR) AS "Pair", count(*) AS "Count"
FROM sq WHERE f1 IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, min(("Document Id", pos)) LIMIT 20
""")
def g13(ctx):
    return SQ.top_ngrams(ctx.m(()), ctx.s, 2, "Pair", 20)


@query("g14_exception_triples", sql=FS_CTE + """
SELECT CAST("Exception ID" AS VARCHAR) || ' -> ' || CAST(e1 AS VARCHAR) || ' -> ' || CAST(e2 AS VARCHAR) AS "Triple",
       count(*) AS "Count"
FROM sq WHERE f2 IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, min(("Document Id", pos)) LIMIT 20
""")
def g14(ctx):
    return SQ.top_ngrams(ctx.m(()), ctx.s, 3, "Triple", 20)


@query("p18_chain_key_all_pairs", sql=FS_CTE + """
SELECT CAST("Exception ID" AS VARCHAR) || ' -> ' || CAST(e1 AS VARCHAR) AS "Pair", count(*) AS "Count"
FROM sq WHERE f1 IS NOT NULL GROUP BY 1
""")
def p18(ctx):
    return SQ.ngram_counts(ctx.m(()), ctx.s, 2, "Pair").drop("_first_seen")


@query("a03_ordered_distinct_list", sql=f"""
, fs AS (SELECT "Document Id", "Exception ID", min({ORDER}) AS fo FROM m WHERE "Document Id" IS NOT NULL GROUP BY 1, 2)
SELECT "Document Id", list("Exception ID" ORDER BY fo) AS "Exc_Seq" FROM fs GROUP BY 1
""")
def a03(ctx):
    return SQ.distinct_sequence_arrays(ctx.m(()), ctx.s)


@query("a02_list_length", sql="""
SELECT "Document Id", count(*) AS "N_Exceptions", count(DISTINCT "Exception ID") AS "N_Distinct"
FROM m WHERE "Document Id" IS NOT NULL GROUP BY 1
""")
def a02(ctx):
    s = ctx.s
    m = ctx.m(())
    pre = per_document_counts(m, s.doc, [s.exc_id])
    return pre.groupBy(s.doc).agg(F.sum("_n").cast("long").alias("N_Exceptions"),
                                  F.count(s.exc_id).alias("N_Distinct"))


@query("a04_adjacent_ngrams", sql=FS_CTE + """
SELECT "Document Id", count(*) FILTER (WHERE f1 IS NOT NULL) AS "N_Pairs",
       count(*) FILTER (WHERE f2 IS NOT NULL) AS "N_Triples"
FROM sq GROUP BY 1
""")
def a04(ctx):
    s = ctx.s
    seqs = SQ.distinct_sequence_arrays(ctx.m(()), s)
    g = SQ.ngram_arrays(SQ.ngram_arrays(seqs, "Exc_Seq", 2, "P"), "Exc_Seq", 3, "T")
    return g.select(s.doc, F.coalesce(F.size("P"), F.lit(0)).cast("long").alias("N_Pairs"),
                    F.coalesce(F.size("T"), F.lit(0)).cast("long").alias("N_Triples"))


@query("a05_flatten_and_count", sql=FS_CTE + """
SELECT CAST("Exception ID" AS VARCHAR) || ' -> ' || CAST(e1 AS VARCHAR) || ' -> ' || CAST(e2 AS VARCHAR) AS "Triple",
       count(*) AS "Count"
FROM sq WHERE f2 IS NOT NULL GROUP BY 1
""")
def a05(ctx):
    seqs = SQ.distinct_sequence_arrays(ctx.m(()), ctx.s)
    return SQ.flatten_and_count(SQ.ngram_arrays(seqs, "Exc_Seq", 3), "Grams", "Triple")


@query("d04_ordered_distinct", sql=f"""
, fs AS (SELECT "Document Id", "Exception ID", min({ORDER}) AS fo FROM m WHERE "Document Id" IS NOT NULL GROUP BY 1, 2)
SELECT "Document Id", "Exception ID", row_number() OVER (PARTITION BY "Document Id" ORDER BY fo) AS "Distinct_Position"
FROM fs
""")
def d04(ctx):
    return SQ.distinct_sequence(ctx.m(()), ctx.s)


@query("w06_adjacent_row_pairing", sql=f"""
, r AS (SELECT "Exception ID" AS "From_ID",
               lead("Exception ID") OVER (PARTITION BY "Document Id" ORDER BY {ORDER}) AS "To_ID",
               lead(1) OVER (PARTITION BY "Document Id" ORDER BY {ORDER}) AS has_next
        FROM m WHERE "Document Id" IS NOT NULL)
SELECT "From_ID", "To_ID", count(*) AS "Count" FROM r WHERE has_next IS NOT NULL GROUP BY 1, 2
""")
def w06(ctx):
    return SQ.adjacent_pairs(ctx.m(()), ctx.s)
