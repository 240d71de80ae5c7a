"""Corpus preparation: toxicity, exact dedup, SimHash near-dedup, substring dedup, packing.

Each stage is a function (spark, docs, sf_dir) -> DataFrame. Its result is
written as Parquet and read back as the next stage's ``docs``. All stages but
the last return the columns of ``documents``; the last returns the packing
(one row per piece of a kept document).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import faultline.llm.op4_simhash as op4_simhash
import faultline.llm.op6_substring_dedup as op6_substring_dedup
import faultline.llm.op7_packing as op7_packing
import faultline.llm.op8_exact_dedup as op8_exact_dedup
import faultline.llm.op9_toxicity as op9_toxicity
from faultline.llm.util import ship, stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects (score >= 0.7) go."""
    scored = op9_toxicity.score(docs, op9_toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return scored.where(F.col("_predicted") == 0).select(*docs.columns)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return op8_exact_dedup.kept_rows(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints one row stays, that of the smallest
    doc_id (a null id only where the group has no other)."""
    return op4_simhash.near_dedup(docs).where("_keep").select(*docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of passages that an earlier document has are cut out; a document
    that loses none keeps its text as it is."""
    cut = op6_substring_dedup.substring_dedup(docs)
    text = F.when(F.col("_n_removed") == 0, F.col("text")).otherwise(F.col("_kept_text"))
    out = cut.withColumn("text", text)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("_n_removed") == 0, F.col("n_chars"))
                             .otherwise(F.length("text")).cast(kind))
    return out.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op7_packing.packed_pieces(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("substring_dedup", cut_repeats),
    ("best_fit_packing", pack),
]

# A trained model, iterated links and a packing heuristic are not SQL; the
# pipeline is tested against brute-force versions of its stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
