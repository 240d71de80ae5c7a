"""Queries of the operators and of the pipeline, with their DuckDB SQL where SQL can say the same."""

from __future__ import annotations

from importlib import import_module

from faultline.llm.util import ship

MODULES = {
    "op1_ann_kmeans_tree": "op1_ann",
    "op2_bpe_segment_tree": "op2_bpe",
    "op3_license_scan": "op3_licenses",
    "op4_simhash_near_dedup": "op4_simhash",
    "op5_token_files": "op5_token_files",
    "op6_substring_dedup": "op6_substring_dedup",
    "op7_best_fit_packing": "op7_packing",
    "op8_exact_dedup": "op8_exact_dedup",
    "op9_toxicity": "op9_toxicity",
    "op10_html_extraction": "op10_html",
    "op11_hard_negatives": "op11_hard_negatives",
    "op12_whitening": "op12_whitening",
    "op13_quality": "op13_quality",
}


def spark_queries():
    def shipped(query):
        def run(spark, sf_dir):
            ship(spark)
            return query(spark, sf_dir)
        return run

    return {name: shipped(import_module(f"faultline.llm.{mod}").query) for name, mod in MODULES.items()}


def oracle_queries():
    out = {}
    for name, mod in MODULES.items():
        sql = getattr(import_module(f"faultline.llm.{mod}"), "SQL", None)
        if sql:
            out[name] = sql
    return out
