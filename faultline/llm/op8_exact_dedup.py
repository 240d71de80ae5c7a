"""Exact deduplication as stateful streaming.

Rows land as a stream of (digest, identifier, locator) records; the locator is
the file and the row in it that hold the content. A streaming aggregate keyed
by digest, with RocksDB (disk-backed) state and no expiry, retains for each
digest the largest identifier seen, the locator of that row's content and the
number of rows. Each hit (a row that is not the retained one) is then checked
against the full bytes of the retained row.

Everything is SQL functions and Structured Streaming; no Python runs on the
executors.

Edge cases: a null text counts as empty; null ids are smaller than any id;
of rows equal in id and text exactly one stays; an empty table gives an
empty result; very long texts are hashed and compared whole, and a digest's
state has none of the text; extra columns travel along untouched, and one that has
the name of an output column gives way to it. Two
different texts with one digest (not known to happen with SHA-256, tested
with a weak digest) form two groups.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.llm.util import boxed, shared_path, stored, table, unboxed

#: Disk-backed state; with one small store for each partition, none sets disk
#: space aside in advance, and a commit writes its changes and no whole copy.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def _keyed_state(landed: DataFrame, path: str, where: str) -> DataFrame:
    """Run the stream over the landed records to its present end; one row per
    digest: retained identifier and locator, number of rows."""
    spark = landed.sparkSession
    before = {k: spark.conf.get(k, None) for k in STATE_STORE}
    for k, v in STATE_STORE.items():
        spark.conf.set(k, v)
    try:
        records = (spark.readStream.schema(landed.schema).parquet(path)
                   .select("_digest", F.struct("_id", "_at").alias("_who")))
        state = records.groupBy("_digest").agg(F.max("_who").alias("_keep"), F.count(F.lit(1)).alias("_n"))

        def write(batch: DataFrame, epoch: int) -> None:
            # Rewriting an epoch after a restart replaces it: exactly once.
            batch.write.mode("overwrite").parquet(f"{where}/out/epoch={epoch}")

        q = (state.writeStream.outputMode("update").foreachBatch(write)
             .option("checkpointLocation", f"{where}/state").trigger(availableNow=True).start())
        q.awaitTermination()
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    schema = state.schema.add("epoch", T.IntegerType())
    # The newest record of a digest holds its state: both fields only grow.
    return (spark.read.schema(schema).parquet(f"{where}/out")
            .groupBy("_digest").agg(F.max("_keep").alias("_keep"), F.max("_n").alias("_n")))


def _located(docs: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column]) -> DataFrame:
    """(_digest, _id, _at, _doc): ``_at`` is the file and the row of each
    content. Rows that come from no file are written to one first; so must be,
    by the caller, rows of which several come from one row of a file."""
    def read(rows: DataFrame) -> DataFrame:
        return rows.select(digest(F.coalesce(F.col(text_col), F.lit(""))).alias("_digest"),
                           F.col(id_col).alias("_id"),  # in a struct a null id orders below every other
                           F.struct(F.col("_metadata.file_path").alias("file"),
                                    F.col("_metadata.row_index").alias("row")).alias("_at"),
                           boxed(docs))

    try:
        return read(docs)
    except AnalysisException:
        return read(stored(docs, "documents"))


def _decide(docs: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column]):
    """(rows, state, clash, mixed): the state holds for digests outside
    ``clash``; ``mixed`` has the rows of the others, grouped by their bytes."""
    where = shared_path(docs.sparkSession, "exact-dedup")
    all_rows = _located(docs, id_col, text_col, digest)
    landing = f"{where}/landing"
    all_rows.select("_digest", "_id", "_at").write.parquet(landing)
    landed = docs.sparkSession.read.parquet(landing)
    if landed.isEmpty():
        state = landed.groupBy("_digest").agg(F.max(F.struct("_id", "_at")).alias("_keep"), F.count(F.lit(1)).alias("_n"))
    else:
        state = _keyed_state(landed, landing, where)

    # Full bytes: only rows of repeated digests carry their text on.
    body = F.coalesce(F.col("_doc").getField(text_col), F.lit(""))
    rows = stored(all_rows.select("_digest", "_id", "_at", body.alias("_bytes"))
                  .join(state.where("_n > 1").select("_digest", F.col("_keep._at").alias("_keep_at")), on="_digest"),
                  "repeated")
    kept = rows.where("_at = _keep_at").select("_digest", F.col("_bytes").alias("_kept_bytes"))
    clash = (rows.where("_at <> _keep_at").join(kept, on="_digest")
             .where("_bytes <> _kept_bytes").select("_digest").distinct())
    same = Window.partitionBy("_digest", "_bytes")
    mixed = (rows.join(clash, on="_digest", how="left_semi")
             .select("_at", F.max(F.struct("_id", "_at")).over(same).alias("_keep"),
                     F.count(F.lit(1)).over(same).alias("_n")))
    return all_rows, state, clash, mixed


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """All rows and columns of ``docs`` plus ``_digest``, ``_keep_id``,
    ``_group_size`` and ``_kept`` (true for the row that stays)."""
    all_rows, state, clash, mixed = _decide(docs, id_col, text_col, digest)
    plain = all_rows.join(state.join(clash, on="_digest", how="left_anti"), on="_digest")
    rows = plain.unionByName(all_rows.join(mixed, on="_at"))
    return unboxed(rows, docs, {
        "_digest": F.col("_digest"), "_keep_id": F.col("_keep._id"),
        "_group_size": F.col("_n"), "_kept": F.col("_keep._at") == F.col("_at")})


def kept_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """The rows of ``docs`` that stay: those that go are found without their
    texts and left out."""
    all_rows, state, clash, mixed = _decide(docs, id_col, text_col, digest)
    plain = (all_rows.select("_digest", "_at")
             .join(state.where("_n > 1").join(clash, on="_digest", how="left_anti"), on="_digest"))
    gone = (plain.select("_at", "_keep").unionByName(mixed.select("_at", "_keep"))
            .where("_at <> _keep._at").select("_at"))
    return unboxed(all_rows.join(gone, on="_at", how="left_anti"), docs, {})


def query(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    r = exact_dedup(d)
    return r.select("doc_id", F.col("_keep_id").alias("keep_id"), F.col("_group_size").alias("group_size"),
                    F.col("_kept").alias("kept"), F.col("_digest").alias("text_sha256"))


SQL = """
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""
