"""Cleaning and the standard views of the log.

``clean`` is one projection + filter, so Catalyst pushes its predicates into
the scans below and fuses it into the surrounding codegen stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faultline.config import LogSchema, Params
from faultline.functions import month_label, parse_amount, parse_timestamp, strip, whole_number


def normalized_supplier(s: LogSchema, p: Params) -> F.Column:
    sup = strip(s.supplier)  # P1
    # Text conversion turns a missing supplier into "nan", which survives the
    # prefix filter (rule 3). Plain null propagation would drop the row.
    return F.coalesce(sup, F.lit("nan")) if p.null_supplier_as_text else sup


def normalized_po(s: LogSchema) -> F.Column:
    return F.upper(strip(s.po_type))  # P3


def is_posted(s: LogSchema, p: Params) -> F.Column:
    return strip(s.status) == F.lit(p.posted_status)  # P6


def clean(log: DataFrame, s: LogSchema, p: Params, filter_po: bool = True) -> DataFrame:
    """Typed, filtered log: supplier/PO normalised, transport vendors removed,
    optional PO-type filter (P5), amount and dates parsed, month added."""
    df = log.withColumns({
        s.supplier: normalized_supplier(s, p),
        s.po_type: normalized_po(s),
        # Typed as the source's reader infers it (text extracts hold digits).
        s.exc_id: whole_number(log, s.exc_id),
    })
    df = df.where(~F.col(s.supplier).startswith(p.transport_prefix))  # P2
    if filter_po:
        df = df.where(F.col(s.po_type).isin(*p.valid_po_types))  # P4
    if s.touches in df.columns:
        df = df.withColumn(s.touches, whole_number(df, s.touches))
    df = df.withColumns(
        {
            s.amount: parse_amount(s.amount_raw),  # P7
            s.created_ts: parse_timestamp(s.created_at, p.timestamp_formats),  # P8
            s.doc_date_ts: parse_timestamp(s.doc_date, p.timestamp_formats),
        }
    )
    return df.withColumn(s.month, month_label(s.created_ts))  # P9, P10


def posted(df: DataFrame, s: LogSchema, p: Params) -> DataFrame:
    return df.where(is_posted(s, p))


def is_material(s: LogSchema, p: Params) -> F.Column:
    """Not one of the immaterial ids; an event without an id counts as material."""
    e = F.col(s.exc_id)
    return e.isNull() | ~e.isin(*p.immaterial_ids)


def material(df: DataFrame, s: LogSchema, p: Params) -> DataFrame:
    """Drop the immaterial exception ids (the material extract)."""
    return df.where(is_material(s, p))


def full_posted(log: DataFrame, s: LogSchema, p: Params) -> DataFrame:
    """F: full log, cleaned, posted, valid PO types."""
    return posted(clean(log, s, p, filter_po=True), s, p)


def material_posted(log: DataFrame, s: LogSchema, p: Params) -> DataFrame:
    """M: material log, cleaned, posted, valid PO types."""
    return material(full_posted(log, s, p), s, p)


def exception_docs(m: DataFrame, s: LogSchema) -> DataFrame:
    """Distinct documents that raised a material exception (D3)."""
    return m.where(F.col(s.doc).isNotNull()).select(s.doc).distinct()


def universe(f: DataFrame, m: DataFrame, s: LogSchema,
             base: DataFrame | None = None) -> DataFrame:
    """U: one row per distinct (document, channel, category) of the full
    posted log (G6, D1), null keys dropped, with ``First_Pass`` = the document
    has no material posted event (J4, rule 5).

    ``base`` replaces the log-derived universe by an external invoice list
    with the same three columns (G35).
    """
    keys = [s.doc, s.channel, s.category]
    u = base if base is not None else f.select(*keys)
    u = u.where(F.col(s.doc).isNotNull() & F.col(s.channel).isNotNull()
                & F.col(s.category).isNotNull()).distinct()
    marked = exception_docs(m, s).withColumn("_has_exc", F.lit(True))
    # Existence (mark) join: left join to the distinct key set; the right side
    # is at most one row per document, so the join never multiplies rows.
    return (
        u.join(marked, on=s.doc, how="left")
        .withColumn("First_Pass", F.col("_has_exc").isNull())
        .drop("_has_exc")
    )


def universe_single_pass(f: DataFrame, s: LogSchema, p: Params) -> DataFrame:
    """U when the material log is the full log minus the immaterial ids.

    Same result as ``universe(f, material(f))`` from one pass over F: group by
    (document, channel, category) keeping whether the group saw a material
    event, then spread the flag over the document with a window. The window
    runs over distinct triples, so a document has at most |channels| x
    |categories| rows in it, and the grouping, the window and the log's last
    join all share the partitioning on the document key (no extra exchange).
    """
    mat = is_material(s, p).cast("int")
    g = (f.where(F.col(s.doc).isNotNull())
         .groupBy(s.doc, s.channel, s.category).agg(F.max(mat).alias("_mat")))
    w = Window.partitionBy(s.doc)
    return (g.withColumn("First_Pass", F.max("_mat").over(w) == 0)
            .where(F.col(s.channel).isNotNull() & F.col(s.category).isNotNull())
            .drop("_mat"))


def two_extracts(f: DataFrame, m: DataFrame, s: LogSchema) -> DataFrame:
    """Both extracts counted per (document, channel, category, exception),
    ``_material`` telling which: what whole-document questions about two logs
    need, in one shuffle by document. A document with very many events
    shrinks map-side to its distinct keys."""
    keys = [s.doc, s.channel, s.category, *s.exc]
    both = (f.select(*keys, F.lit(False).alias("_material"))
            .unionByName(m.select(*keys, F.lit(True).alias("_material"))))
    return (both.where(F.col(s.doc).isNotNull()).groupBy(*keys, "_material")
            .agg(F.count(F.lit(1)).alias("_n")))


def universe_of_two(both: DataFrame, s: LogSchema) -> DataFrame:
    """U from ``two_extracts``: the material flag is spread over the document
    by a window instead of joining the logs."""
    g = both.groupBy(s.doc, s.channel, s.category).agg(
        F.max(~F.col("_material")).alias("_full"), F.max("_material").alias("_mat"))
    first = ~F.max("_mat").over(Window.partitionBy(s.doc))
    return (g.withColumn("First_Pass", first).where(
        F.col("_full") & F.col(s.channel).isNotNull() & F.col(s.category).isNotNull()).drop("_full", "_mat"))


def cleaning_funnel(log: DataFrame, s: LogSchema, p: Params) -> DataFrame:
    """Rows at each stage, for the full and the material log, in one pass."""
    sup = normalized_supplier(s, p)
    po = normalized_po(s)
    keep = ~sup.startswith(p.transport_prefix)
    valid = po.isin(*p.valid_po_types)
    post = is_posted(s, p)
    mat = is_material(s, p)

    def cnt(cond):
        return F.count_if(F.coalesce(cond, F.lit(False)))

    return log.agg(
        F.count(F.lit(1)).alias("full_raw"),
        cnt(keep).alias("full_clean_any_po"),
        cnt(keep & valid).alias("full_clean"),
        cnt(keep & valid & post).alias("full_posted"),
        cnt(mat).alias("material_raw"),
        cnt(mat & keep & valid).alias("material_clean"),
        cnt(mat & keep & valid & post).alias("material_posted"),
    )


def parse_failure_rate(f: DataFrame, s: LogSchema, digits: int = 2) -> DataFrame:
    """Share of rows whose raw amount is present but does not parse, and
    the same of the creation date."""
    raw = F.col(s.amount_raw)
    bad = raw.isNotNull() & F.col(s.amount).isNull()
    undated = F.col(s.created_at).isNotNull() & F.col(s.created_ts).isNull()
    return f.agg(
        F.count(F.lit(1)).alias("Rows"),
        F.count_if(bad).alias("Unparsed"),
        F.bround(F.try_divide(F.count_if(bad).cast("double"), F.count(F.lit(1)).cast("double"))
                 * F.lit(100.0), digits).alias("Unparsed_Pct"),
        F.count_if(undated).alias("Undated"),
        F.bround(F.try_divide(F.count_if(undated).cast("double"), F.count(F.lit(1)).cast("double"))
                 * F.lit(100.0), digits).alias("Undated_Pct"),
    )
