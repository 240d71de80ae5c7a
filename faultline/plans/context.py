"""Shared inputs of the registered queries: the log view over the driver's
tables and its standard views (F, M, U), in Spark and in DuckDB SQL."""

from __future__ import annotations

from collections.abc import Iterable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from faultline.config import LogSchema, Params, tpch_params, tpch_schema
from faultline.operators import clean as C
from faultline.functions import NUMBER, WHITE_SPACE
from faultline.sources.tpch_log import (
    LOG_VIEW_SQL, ROLES, category_lookup, exception_log, read_table, vendor_name_lookup,
)


class LogContext:
    """Lazily built views of the TPC-H-derived exception log."""

    def __init__(self, spark: SparkSession, sf_dir: str,
                 schema: LogSchema | None = None, params: Params | None = None,
                 full: DataFrame | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        self.s = schema or tpch_schema()
        self.p = params or tpch_params()
        # A cleaned log to use in place of the tables (see ``persist``).
        self.full = full

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    def log(self, need: Iterable[str] = ROLES) -> DataFrame:
        return exception_log(self.spark, self.sf_dir, need=need, schema=self.s)

    def f(self, need: Iterable[str] = ROLES) -> DataFrame:
        if self.full is not None:
            # Lookups are left joins, so the fully attached log has the same
            # rows as any lighter view.
            return self.full
        return C.full_posted(self.log(need), self.s, self.p)

    def vendor_names(self) -> DataFrame:
        """Supplier -> name lookup for late name attachment (vendor analyses)."""
        return vendor_name_lookup(self.spark, self.sf_dir, self.s)

    def category_lookup(self) -> tuple[str, DataFrame]:
        """(key column in the log, key -> category lookup) for count queries."""
        return "l_partkey", category_lookup(self.spark, self.sf_dir, self.s)

    def persist(self, mode: str = "cache") -> DataFrame:
        """Suite mode: materialise the cleaned, posted log (all attributes)
        once, so a run of many analyses scans and joins the tables once, as
        the original script does with its in-memory table. Only queries built
        from this context (``registry.suite_queries``) read it.

        ``mode="cache"`` keeps it in executor memory/disk (lost blocks are
        recomputed from lineage); ``mode="checkpoint"`` writes it to the
        cluster's shared ``spark.checkpoint.dir`` and cuts the lineage, so a
        lost executor costs a re-read, not a re-join."""
        from pyspark import StorageLevel

        from faultline.session import ensure_checkpoint_dir
        if self.full is None:
            full = C.full_posted(self.log(ROLES), self.s, self.p)
            if mode == "checkpoint":
                ensure_checkpoint_dir(self.spark)
                full = full.checkpoint(eager=True)
            else:
                full = full.persist(StorageLevel.MEMORY_AND_DISK)
                full.count()
            self.full = full
        return self.full

    def unpersist(self) -> None:
        if self.full is not None:
            self.full.unpersist()
            self.full = None

    def m(self, need: Iterable[str] = ROLES) -> DataFrame:
        return C.material(self.f(need), self.s, self.p)

    @cached_property
    def u(self) -> DataFrame:
        # M is F minus the immaterial ids here, so the universe and its
        # first-pass flag come from one pass over F (no second join branch).
        return C.universe_single_pass(self.f(("channel", "category")), self.s, self.p)

    def u_two_logs(self) -> DataFrame:
        """The general form for two separate extracts (full and material)."""
        return C.universe(self.f(("channel", "category")), self.m(()), self.s)


def _q(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def _strip(col: str) -> str:
    """DuckDB: text without white space of any kind at either end."""
    return f"trim(CAST({col} AS VARCHAR), {_q(WHITE_SPACE)})"


def _timestamp(col: str) -> str:
    return (f"CASE WHEN contains({col}, '/') THEN try_strptime({_strip(col)}, '%m/%d/%Y') "
            f"ELSE TRY_CAST({_strip(col)} AS TIMESTAMP) END")


def _amount(col: str) -> str:
    text = _strip(f"regexp_replace(CAST({col} AS VARCHAR), '[,\"]', '', 'g')")
    return f"CASE WHEN regexp_matches({text}, {_q(NUMBER)}) THEN TRY_CAST(replace({text}, '_', '') AS DOUBLE) END"


def sql_prelude(p: Params | None = None) -> str:
    """``WITH`` clause defining log, f (full posted), m (material posted),
    u (universe with First_Pass) and pm (partial month) in DuckDB."""
    p = p or tpch_params()
    valid = ", ".join(_q(v) for v in p.valid_po_types)
    imm = ", ".join(str(i) for i in p.immaterial_ids)
    return f"""WITH {LOG_VIEW_SQL},
cl AS (
  SELECT * REPLACE (coalesce({_strip('"Supplier"')}, 'nan') AS "Supplier",
                    upper({_strip('"PO Type"')}) AS "PO Type"),
         {_strip('"Document Status"')} = {_q(p.posted_status)} AS "_posted"
  FROM log
),
f AS (
  SELECT *,
    {_amount('"Gross Invoice Amount"')} AS "Amount",
    {_timestamp('"Created at"')} AS "Created at_dt",
    {_timestamp('"Document Date"')} AS "Document Date_dt",
    strftime({_timestamp('"Created at"')}, '%Y-%m') AS "Month"
  FROM cl
  WHERE NOT starts_with("Supplier", {_q(p.transport_prefix)})
    AND "PO Type" IN ({valid})
    AND "_posted"
),
m AS (SELECT * FROM f WHERE "Exception ID" IS NULL OR "Exception ID" NOT IN ({imm})),
xd AS (SELECT DISTINCT "Document Id" FROM m WHERE "Document Id" IS NOT NULL),
u AS (
  SELECT k."Document Id", k."Channel ID", k."PO category decription",
         (x."Document Id" IS NULL) AS "First_Pass"
  FROM (SELECT DISTINCT "Document Id", "Channel ID", "PO category decription" FROM f
        WHERE "Document Id" IS NOT NULL AND "Channel ID" IS NOT NULL
          AND "PO category decription" IS NOT NULL) k
  LEFT JOIN xd x ON k."Document Id" = x."Document Id"
),
pm AS (SELECT max("Month") AS pm FROM f)"""
