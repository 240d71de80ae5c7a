"""Exception log derived from the driver's TPC-H-style tables.

No test table is an exception log, so one line item becomes one exception
event on one document (order). The view is defined twice, identically: as a
lazy Spark DataFrame (``exception_log``) and as DuckDB SQL (``LOG_VIEW_SQL``)
for the oracle. Attributes that come from lookup tables (vendor name,
category, channel) are left joins, so a query that does not use an attribute
skips that join without changing its result.

Join order keeps the document key as the last join key: the lookups join the
line items first, then orders, so the log leaves the last (shuffle) join
hash-partitioned by ``l_orderkey`` = document id and every per-document
aggregate downstream reuses that partitioning.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.config import LogSchema, tpch_schema

# Fixed values of the mapping (test data only).
# Line 1 of an order is exception 0, line 2 is exception 91 (both immaterial);
# other lines get a material id picked by part key modulo 10 from this list.
MATERIAL_ID_CYCLE = (1, 2, 3, 5, 7, 11, 29, 37, 38, 151)
# Exception 7 on suppliers whose key is a multiple of 7 has no description.
NULL_DESC_ID = 7
NULL_DESC_SUPPKEY_MOD = 7

# Faults of real extracts, at fixed keys: part keys without a readable amount;
# order keys with no creation date, with one that is none, with the month
# first (remainder 1 of 4); white space of several kinds around keys and codes.
BAD_AMOUNT_MOD, UNDATED_MOD, BAD_DATE_MOD = 53, 89, 31

ROLES = ("vendor_name", "category", "channel")


# The schemas of the tables read here. Giving them saves reading
# a footer for each query; the files are listed anew by every read, so rows
# that were appended are seen.
SCHEMAS = {
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_shipdate timestamp_ntz",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "part": "p_partkey long, p_type string",
    "supplier": "s_suppkey long, s_name string",
    "customer": "c_custkey long, c_mktsegment string",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet table; only its columns that the log uses, if the name is one of ``SCHEMAS``."""
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _exc_id() -> F.Column:
    # One array lookup, not a CASE per id: the optimizer copies this
    # expression into every predicate it pushes down, so it must stay small.
    # pmod keeps the index in 1..len for any key (element_at raises under ANSI
    # for an index out of range).
    n = len(MATERIAL_ID_CYCLE)
    cyc = F.element_at(F.array(*[F.lit(v) for v in MATERIAL_ID_CYCLE]),
                       (F.pmod(F.col("l_partkey"), F.lit(n)) + 1).cast("int"))
    return (
        F.when(F.col("l_linenumber") == 1, F.lit(0))
        .when(F.col("l_linenumber") == 2, F.lit(91))
        .otherwise(cyc)
        .cast("int")
    )


def exception_log(
    spark: SparkSession,
    sf_dir: str,
    need: Iterable[str] = ROLES,
    schema: LogSchema | None = None,
) -> DataFrame:
    """Raw exception log (strings as a raw extract would hold them).

    ``need`` lists the lookup attributes to attach (``vendor_name``,
    ``category``, ``channel``); the others are null-free to skip.
    """
    s = schema or tpch_schema()
    need = set(need)
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_shipdate",
    )
    if "category" in need:
        part = read_table(spark, sf_dir, "part").select("p_partkey", "p_type")
        li = li.join(part, li.l_partkey == part.p_partkey, "left").drop("p_partkey")
    if "vendor_name" in need:
        sup = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
        li = li.join(sup, li.l_suppkey == sup.s_suppkey, "left").drop("s_suppkey")
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"
    )
    if "channel" in need:
        cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
        orders = orders.join(cust, orders.o_custkey == cust.c_custkey, "left")
    log = li.join(orders, li.l_orderkey == orders.o_orderkey, "inner")

    exc, order = _exc_id(), F.col("o_orderkey")
    cols = {
        s.doc: F.col("l_orderkey"),
        s.supplier: F.when(F.col("l_linenumber") % 2 == 0,
                           F.concat(F.lit("\t"), F.col("l_suppkey").cast("string"), F.lit("\u00a0")))
        .otherwise(F.concat(F.lit(" "), F.col("l_suppkey").cast("string"), F.lit(" "))),
        s.vendor_name: F.col("s_name") if "vendor_name" in need else F.lit(None).cast("string"),
        s.po_type: F.concat(F.lit(" "), F.lower(F.col("o_orderpriority")),
                            F.when(order % 3 == 0, F.lit("\t")).otherwise(F.lit(""))),
        s.amount_raw: F.when(F.col("l_partkey") % BAD_AMOUNT_MOD == 0, F.lit("n/a"))
        .otherwise(F.format_number(F.col("l_extendedprice"), 2)),
        s.created_at: F.when(order % UNDATED_MOD == 0, F.lit(None))
        .when(order % BAD_DATE_MOD == 0, F.lit("unknown"))
        .when(order % 4 == 1, F.date_format("o_orderdate", "MM/dd/yyyy"))
        .otherwise(F.col("o_orderdate").cast("string")),
        s.doc_date: F.col("l_shipdate").cast("string"),
        s.status: F.concat(F.col("o_orderstatus"), F.when(order % 5 == 0, F.lit("\r\n")).otherwise(F.lit(""))),
        s.exc_id: exc,
        s.exc_desc: F.when(
            (exc == NULL_DESC_ID) & (F.col("l_suppkey") % NULL_DESC_SUPPKEY_MOD == 0),
            F.lit(None).cast("string"),
        ).otherwise(F.concat(F.lit("EXC_"), exc.cast("string"))),
        s.category: F.col("p_type") if "category" in need else F.lit(None).cast("string"),
        s.channel: F.col("c_mktsegment") if "channel" in need else F.lit(None).cast("string"),
        s.touches: (F.col("l_quantity").cast("int") % 15).cast("int"),
    }
    return log.select(*[v.alias(k) for k, v in cols.items()], *s.order_cols)


def vendor_name_lookup(spark: SparkSession, sf_dir: str, schema: LogSchema | None = None) -> DataFrame:
    """Supplier (as the cleaned log spells it: trimmed key text) -> vendor name.

    In this log the name is a function of the supplier key, so vendor
    analyses can aggregate by supplier first and attach names to the
    aggregate: one row per supplier is joined instead of the whole log.
    """
    s = schema or tpch_schema()
    sup = read_table(spark, sf_dir, "supplier")
    return sup.select(F.col("s_suppkey").cast("string").alias(s.supplier),
                      F.col("s_name").alias(s.vendor_name))


def category_lookup(spark: SparkSession, sf_dir: str, schema: LogSchema | None = None) -> DataFrame:
    """``l_partkey`` -> category: counts by category can be taken per part
    key first and the category attached to the partial counts."""
    s = schema or tpch_schema()
    part = read_table(spark, sf_dir, "part")
    return part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias(s.category))


def _sql_exc_id() -> str:
    ids = ", ".join(str(v) for v in MATERIAL_ID_CYCLE)
    n = len(MATERIAL_ID_CYCLE)
    return (
        "CAST(CASE WHEN l_linenumber = 1 THEN 0 WHEN l_linenumber = 2 THEN 91 "
        f"ELSE list_extract([{ids}], CAST(((l_partkey % {n}) + {n}) % {n} + 1 AS INTEGER)) END AS INTEGER)"
    )


# DuckDB form of ``exception_log`` (all attributes attached).
LOG_VIEW_SQL = f"""
log_base AS (
  SELECT l.*, o.*, {_sql_exc_id()} AS exc
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
),
log AS (
  SELECT b.l_orderkey AS "Document Id",
         CASE WHEN b.l_linenumber % 2 = 0 THEN chr(9) || CAST(b.l_suppkey AS VARCHAR) || chr(160)
              ELSE ' ' || CAST(b.l_suppkey AS VARCHAR) || ' ' END AS "Supplier",
         s.s_name AS "Name 1",
         ' ' || lower(b.o_orderpriority) || CASE WHEN b.o_orderkey % 3 = 0 THEN chr(9) ELSE '' END AS "PO Type",
         CASE WHEN b.l_partkey % {BAD_AMOUNT_MOD} = 0 THEN 'n/a'
              ELSE format('{{:,.2f}}', b.l_extendedprice) END AS "Gross Invoice Amount",
         CASE WHEN b.o_orderkey % {UNDATED_MOD} = 0 THEN NULL WHEN b.o_orderkey % {BAD_DATE_MOD} = 0 THEN 'unknown'
              WHEN b.o_orderkey % 4 = 1 THEN strftime(b.o_orderdate, '%m/%d/%Y')
              ELSE CAST(b.o_orderdate AS VARCHAR) END AS "Created at",
         CAST(b.l_shipdate AS VARCHAR) AS "Document Date",
         b.o_orderstatus || CASE WHEN b.o_orderkey % 5 = 0 THEN chr(13) || chr(10) ELSE '' END AS "Document Status",
         b.exc AS "Exception ID",
         CASE WHEN b.exc = {NULL_DESC_ID} AND b.l_suppkey % {NULL_DESC_SUPPKEY_MOD} = 0 THEN NULL
              ELSE 'EXC_' || CAST(b.exc AS VARCHAR) END AS "Exception description",
         p.p_type AS "PO category decription",
         c.c_mktsegment AS "Channel ID",
         CAST(CAST(b.l_quantity AS INTEGER) % 15 AS INTEGER) AS "Number of Touches",
         b.l_shipdate, b.l_linenumber, b.l_partkey, b.l_suppkey
  FROM log_base b
  LEFT JOIN part p ON b.l_partkey = p.p_partkey
  LEFT JOIN supplier s ON b.l_suppkey = s.s_suppkey
  LEFT JOIN customer c ON b.o_custkey = c.c_custkey
)"""
