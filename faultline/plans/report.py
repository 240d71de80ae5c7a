"""The full result set of the original analysis, from two raw log extracts.

``core_results`` and ``extended_results`` return the same named tables the
original scripts write (frequencies, vendors, first-pass, sequences, monthly
trend, concentration, the three deep dives, segment profiles, KPIs), as lazy
DataFrames; ``run`` reads a full and a material CSV extract, computes each
result once (Parquet) and writes it with the sinks (CSV and JSON lines, one
directory per result, and the two result documents).

    python -m faultline.plans.report --full full.csv --material material.csv \
        --out results/ --channel <channel> --categories <category-a> <category-b>
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.config import LogSchema, Params
from faultline.operators import clean as C
from faultline.operators import deepdive as DD
from faultline.operators import firstpass as FP
from faultline.operators import freq as FQ
from faultline.operators import pareto as PA
from faultline.operators import sequences as SQ
from faultline.operators.relational import top_k
from faultline.operators.shape import drop_named
from faultline.sources import sinks
from faultline.sources.csv_log import read_log_csv

# The deep dives of the original: id and which log it reads ("full"/"material").
DIVE_IDS = ((91, "full"), (151, "material"), (29, "material"))


def core_results(f: DataFrame, m: DataFrame, u: DataFrame, s: LogSchema, p: Params) -> dict[str, DataFrame]:
    vend = FQ.vendor_stats(m, s)
    return {
        "01_exception_frequency": FQ.exception_frequency(m, s),
        "02_top_vendors": top_k(vend, FQ.vendor_order(s), 50),
        "03_exception_by_category": FQ.category_exceptions(m, s),
        "04_channel_firstpass": FP.first_pass_by(u, [s.channel], s),
        "04b_channel_cat_firstpass": FP.first_pass_by(u, [s.channel, s.category], s),
        "05_exception_count_dist": SQ.exceptions_per_invoice(m, s),
        "05_exception_pairs": SQ.top_ngrams(m, s, 2, "Pair", 20),
        "05_exception_triples": SQ.top_ngrams(m, s, 3, "Triple", 20),
        "06_monthly_trends": FP.monthly_trend(f, m, s),
        "07_workload_concentration": PA.workload_concentration(vend, s.vendor).drop("Rank"),
        "kpi": FQ.kpi_row(u, m, s),
        "vendor_intensity": FQ.vendor_intensity(m, s, p.min_invoices, 20),
        "cat_summary": FQ.category_totals(m, s),
    }


def extended_results(f: DataFrame, m: DataFrame, u: DataFrame, both: DataFrame, s: LogSchema, p: Params,
                     channel: str, categories: tuple[str, str]) -> dict[str, DataFrame]:
    partial = FP.resolve_partial_month(f, s, p)
    out: dict[str, DataFrame] = {}
    for x, which in DIVE_IDS:
        src = f if which == "full" else m
        ev = DD.events_of(src, s, x)
        material = which == "material"
        out[f"{x}_by_category"] = DD.by_category(ev, s)
        out[f"{x}_channel_category"] = DD.by_channel_category(ev, s, with_pct=material)
        out[f"{x}_monthly_by_cat"] = DD.by_month_category(ev, s, partial)
        out[f"{x}_top_vendors"] = DD.dive_vendors(ev, s, 20, with_avg=material)
        out[f"{x}_cooccur"] = DD.cooccurring(src, s, x, 10)
    out["151_touch_dist"] = DD.touches_histogram(DD.events_of(m, s, 151), s)
    out["exception_totals"] = DD.exception_totals(f, (91,), s).unionByName(
        DD.exception_totals(m, (151, 29), s))
    out["vendor_exc_detail"] = DD.vendor_exception_detail(m, s)
    out["cc_fp"] = FP.first_pass_by(u, [s.channel, s.category], s, digits=1,
                                    count_name="FP_Count", rate_name="FP_Rate")
    a, b = categories
    out["segment_a_fail_exc"] = DD.segment_profile(both, s, channel, a, passed=False)
    out["segment_a_pass_exc"] = DD.segment_profile(both, s, channel, a, passed=True)
    out["segment_b_fail_exc"] = DD.segment_profile(both, s, channel, b, passed=False)
    out["channel_monthly"] = FP.channel_monthly(u, f, s, p, channel)
    out["segment_a_scalars"] = FP.segment_scalars(u, s, channel, a)
    out["segment_b_scalars"] = FP.segment_scalars(u, s, channel, b)
    return out


# Fixed values of the original's two result documents: each field, the result
# it holds, its order (a leading "-" falls), its leading rows (None: all) and,
# where they are not all, its columns. "doc", "exc" and so on are the roles of
# ``LogSchema``; other names are columns of the result.
CORE_FIELDS = (
    ("kpi", "kpi", (), None, None),
    ("exc_freq", "01_exception_frequency", ("-Count", "exc_id"), 20, None),
    ("vendor_top30", "02_top_vendors", ("-Exception_Events", "supplier", "vendor_name"), 30, None),
    ("vendor_intensity", "vendor_intensity", ("-Avg_Exc_Per_Inv", "supplier", "vendor_name"), None, None),
    ("cat_summary", "cat_summary", ("-Exception_Events", "category"), None, None),
    ("cat_exc", "03_exception_by_category", ("category", "-Count", "exc_id"), 60, None),
    ("channel_fp", "04_channel_firstpass", ("channel",), None, None),
    ("channel_cat_fp", "04b_channel_cat_firstpass", ("channel", "category"), None, None),
    ("exc_dist", "05_exception_count_dist", ("N_Exceptions",), None, None),
    ("exc_pairs", "05_exception_pairs", ("-Count", "Pair"), 15, None),
    ("exc_triples", "05_exception_triples", ("-Count", "Triple"), 10, None),
    ("monthly", "06_monthly_trends", ("Month_str",), None,
     ("Month_str", "Total_Invoices", "Exc_Invoices", "First_Pass_Rate")),
    ("workload_conc", "07_workload_concentration", ("-Exception_Events", "supplier", "vendor_name"), 50,
     ("vendor_name", "supplier", "Exception_Events", "Unique_Invoices", "Cumulative_Pct")),
)
EXTENDED_FIELDS = (
    *[field for x, dist in ((91, False), (151, True), (29, False)) for field in (
        (f"e{x}_cat", f"{x}_by_category", ("-Events", "category"), None, None),
        (f"e{x}_ch_cat", f"{x}_channel_category", ("channel", "category"), None, None),
        (f"e{x}_vendors", f"{x}_top_vendors", ("-Events", "supplier", "vendor_name"), 20, None),
        (f"e{x}_monthly", f"{x}_monthly_by_cat", ("month", "category"), None, None),
        (f"e{x}_cooccur", f"{x}_cooccur", ("-Count", "exc_id"), None, None),
        *([(f"e{x}_touch_dist", f"{x}_touch_dist", ("Touches",), None, None)] if dist else []))],
    ("cc_fp", "cc_fp", ("channel", "category"), None, None),
    ("segment_a_fail_exc", "segment_a_fail_exc", ("-Count", "exc_id"), None, None),
    ("segment_a_pass_exc", "segment_a_pass_exc", ("-Count", "exc_id"), None, None),
    ("segment_b_fail_exc", "segment_b_fail_exc", ("-Count", "exc_id"), None, None),
    ("channel_monthly", "channel_monthly", ("month", "category"), None, None),
    ("vendor_exc_detail", "vendor_exc_detail", ("supplier", "-Count", "exc_id"), None, None),
    ("segment_a_scalars", "segment_a_scalars", (), None, None),
    ("segment_b_scalars", "segment_b_scalars", (), None, None),
    ("exception_totals", "exception_totals", ("exc_id",), None, None),
)
#: Vendor lists from which named vendors are taken out, after their cut.
VENDOR_LISTS = ("vendor_top30", "e91_vendors", "e151_vendors", "e29_vendors")


def document(results: dict[str, DataFrame], s: LogSchema, fields=CORE_FIELDS,
             exclude_vendors: Sequence[str] = ()) -> DataFrame:
    """A result document, its fields' records in the original's order
    (``sinks.result_document``)."""
    def column(name: str) -> str:
        return getattr(s, name, name)

    parts = []
    for field, name, order, k, columns in fields:
        df = results[name]
        by = [F.col(f"`{column(c.lstrip('-'))}`") for c in order]
        by = [c.desc() if o.startswith("-") else c.asc() for c, o in zip(by, order)]
        if k is not None:
            df = top_k(df, by, k)
        if field in VENDOR_LISTS and exclude_vendors:
            df = drop_named(df, s.vendor_name, exclude_vendors)
        parts.append((field, df, by, [column(c) for c in columns] if columns else df.columns))
    return sinks.result_document(parts)


def build_from_views(f: DataFrame, m: DataFrame, s: LogSchema, p: Params,
                     channel: str, categories: tuple[str, str], both: DataFrame | None = None) -> dict[str, DataFrame]:
    """All result tables from the cleaned full (F) and material (M) logs.
    ``both``: ``clean.two_extracts`` of them, where it is at hand."""
    both = C.two_extracts(f, m, s) if both is None else both
    u = C.universe_of_two(both, s)
    return {**core_results(f, m, u, s, p), **extended_results(f, m, u, both, s, p, channel, categories)}


def build(full_log: DataFrame, material_log: DataFrame, s: LogSchema, p: Params,
          channel: str, categories: tuple[str, str]) -> dict[str, DataFrame]:
    """All result tables from the two raw extracts."""
    return build_from_views(C.full_posted(full_log, s, p), C.full_posted(material_log, s, p),
                            s, p, channel, categories)


def run(spark: SparkSession, full_path: str, material_path: str, out_dir: str,
        channel: str, categories: tuple[str, str],
        s: LogSchema | None = None, p: Params | None = None,
        exclude_vendors: Sequence[str] = ()) -> dict[str, DataFrame]:
    """Read, clean once, write every result. The two cleaned logs and their
    counts per document are kept in executor memory/disk for the run (about 40
    results read them); lost
    blocks are recomputed from the extracts."""
    from pyspark import StorageLevel

    s = s or LogSchema()
    p = p or Params()
    f = C.full_posted(read_log_csv(spark, full_path), s, p).persist(StorageLevel.MEMORY_AND_DISK)
    m = C.full_posted(read_log_csv(spark, material_path), s, p).persist(StorageLevel.MEMORY_AND_DISK)
    both = C.two_extracts(f, m, s).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        out = out_dir.rstrip("/")
        results = build_from_views(f, m, s, p, channel, categories, both)
        # Computed once, as Parquet; the other forms are read from there.
        sinks.write_results(results, f"{out}/tables", fmt="parquet")
        results = {n: spark.read.schema(df.schema).parquet(f"{out}/tables/{n}") for n, df in results.items()}
        sinks.write_results(results, f"{out}/csv", fmt="csv")
        sinks.write_results(results, f"{out}/json", fmt="json")
        document(results, s, CORE_FIELDS, exclude_vendors).write.mode("overwrite").json(f"{out}/document")
        document(results, s, EXTENDED_FIELDS, exclude_vendors).write.mode("overwrite").json(f"{out}/document_extended")
    finally:
        both.unpersist()
        f.unpersist()
        m.unpersist()
    return results


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--full", required=True)
    ap.add_argument("--material", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--channel", required=True, help="channel of the segment dives")
    ap.add_argument("--categories", nargs=2, required=True, help="two categories of that channel")
    ap.add_argument("--exclude-vendors", nargs="*", default=[], help="names taken out of the served vendor lists")
    ap.add_argument("--partial-month", default=Params().partial_month)
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName("faultline-report").getOrCreate()
    from faultline.session import tune
    tune(spark)
    run(spark, args.full, args.material, args.out, args.channel, tuple(args.categories),
        p=Params(partial_month=args.partial_month), exclude_vendors=args.exclude_vendors)
    spark.stop()


if __name__ == "__main__":
    main()

