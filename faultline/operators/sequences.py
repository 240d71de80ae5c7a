"""Exception sequences per document and their n-grams.

The source builds a Python list per document and loops over it. Here every
step is a grouped or windowed DataFrame operation, arranged so that no task
ever holds all events of one document:

* n-grams are taken over the *order-preserving distinct* sequence. A
  ``(document, id)`` aggregate keeping the first position comes first; it is
  combined map-side, so even a document holding a third of all events
  shrinks to at most one row per distinct exception id before any window
  runs. Windows then see at most |ids| rows per document.
* positions in the raw sequence (with repeats) are numbered inside
  (document, bucket of the order key) and get an offset from the small table
  of bucket sizes. The buckets are cut at keys sampled from the data, one in
  ``BUCKET_ROWS`` by a hash of the key, so a group of any size and any spread
  of its keys falls into buckets of about that many rows and many tasks.
  Adjacent raw events are paired inside buckets and across their borders.

Event order: order columns that are text sort as ``functions.order_key`` does
(numbers by value).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultline.config import LogSchema
from faultline.functions import chain_key, ngram_array, order_key
from faultline.operators.relational import nonnull, top_k


def exceptions_per_invoice(m: DataFrame, s: LogSchema) -> DataFrame:
    """Events per document, then documents per event count."""
    per_doc = nonnull(m, [s.doc]).groupBy(s.doc).agg(F.count(F.lit(1)).alias("N_Exceptions"))
    return per_doc.groupBy("N_Exceptions").agg(F.count(F.lit(1)).alias("Invoice_Count"))


#: Rows of a bucket, on average.
BUCKET_ROWS = 2 ** 18


def event_order(df: DataFrame, s: LogSchema) -> Column:
    """The order key of an event inside its document."""
    return F.struct(*[order_key(df, c).alias(c) for c in s.order_cols])


def first_seen(m: DataFrame, s: LogSchema) -> DataFrame:
    """One row per (document, id) with the order key of its first event."""
    return (nonnull(m, [s.doc]).groupBy(s.doc, s.exc_id)
            .agg(F.min(event_order(m, s)).alias("_first")))


def distinct_sequence(m: DataFrame, s: LogSchema, pos_col: str = "Distinct_Position") -> DataFrame:
    """D4 / A3 long form: (document, position among distinct ids, id)."""
    w = Window.partitionBy(s.doc).orderBy("_first")
    return first_seen(m, s).withColumn(pos_col, F.row_number().over(w).cast("long")).drop("_first")


def distinct_sequence_arrays(m: DataFrame, s: LogSchema, out: str = "Exc_Seq") -> DataFrame:
    """A1 + A3: per document the array of distinct ids in first-seen order.
    The array is bounded by the number of distinct exception ids."""
    fs = first_seen(m, s)
    return fs.groupBy(s.doc).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_first", s.exc_id))),
                    lambda x: x[s.exc_id]).alias(out))


def ngram_counts(m: DataFrame, s: LogSchema, n: int, key: str) -> DataFrame:
    """Counts of adjacent n-grams of the distinct sequences, with the
    first occurrence (document, position) kept for tie-breaking (T4)."""
    w = Window.partitionBy(s.doc).orderBy("_first")
    seq = first_seen(m, s).withColumn("_pos", F.row_number().over(w))
    nxt = {f"_n{k}": F.lead(F.col(s.exc_id), k).over(w) for k in range(1, n)}
    nxt["_last"] = F.lead(F.col("_pos"), n - 1).over(w)
    seq = seq.withColumns(nxt).where(F.col("_last").isNotNull())
    label = chain_key([F.col(s.exc_id), *[F.col(f"_n{k}") for k in range(1, n)]])
    return (seq.withColumn(key, label).groupBy(key)
            .agg(F.count(F.lit(1)).alias("Count"),
                 F.min(F.struct(order_key(m, s.doc).alias("doc"), F.col("_pos"))).alias("_first_seen")))


def top_ngrams(m: DataFrame, s: LogSchema, n: int, key: str, k: int = 20) -> DataFrame:
    """Top k n-grams by count; ties in first-seen order (``most_common``)."""
    c = ngram_counts(m, s, n, key)
    return top_k(c, [F.col("Count").desc(), F.col("_first_seen").asc()], k).drop("_first_seen")


def ngram_arrays(seqs: DataFrame, arr: str, n: int, out: str = "Grams") -> DataFrame:
    """A4: adjacent n-grams of each (bounded) distinct-sequence array."""
    return seqs.withColumn(out, ngram_array(F.col(arr), n))


def flatten_and_count(grams: DataFrame, col: str, key: str) -> DataFrame:
    """A5: explode n-gram arrays and count each n-gram."""
    return (grams.select(F.explode(F.col(col)).alias("_g"))
            .select(F.concat_ws(" -> ", F.transform("_g", lambda x: x.cast("string"))).alias(key))
            .groupBy(key).agg(F.count(F.lit(1)).alias("Count")))


def _bucket(cuts: Column, key: Column) -> Column:
    """How many of the sorted ``cuts`` are not above ``key`` (binary search); 0 without cuts."""
    steps = F.sequence(F.lit(1), F.ceil(F.log2(F.size(cuts) + 1)).cast("int"))

    def halve(at: Column, _: Column) -> Column:
        mid = F.floor((at["lo"] + at["hi"]) / 2).cast("int")
        open_ = at["lo"] < at["hi"]
        up = open_ & (F.try_element_at(cuts, mid + 1) <= key)
        return F.struct(F.when(up, mid + 1).otherwise(at["lo"]).alias("lo"),
                        F.when(open_ & ~up, mid).otherwise(at["hi"]).alias("hi"))

    start = F.struct(F.lit(0).alias("lo"), F.size(cuts).alias("hi"))
    found = F.aggregate(steps, start, halve, lambda at: at["lo"])
    return F.when(F.size(cuts) > 0, found).otherwise(0)


def _buckets(df: DataFrame, group: Sequence[str], order: Sequence[str], bucket_rows: int) -> DataFrame:
    """Rows dealt out by (group, bucket ``_b``): the buckets of one large group
    are many tasks' work. A group of n rows has about n / ``bucket_rows`` cut
    keys, which is what its row of the table of cuts holds."""
    df = nonnull(df, group)
    key = F.struct(*[F.col(c) for c in order])
    cuts = (df.select(*group, key.alias("_k")).where(F.pmod(F.xxhash64("_k"), F.lit(bucket_rows)) == 0)
            .groupBy(*group).agg(F.array_sort(F.collect_set("_k")).alias("_cuts")))
    rows = df.join(cuts, on=list(group), how="left").withColumn("_b", _bucket(F.col("_cuts"), key)).drop("_cuts")
    return rows.repartition(*[F.col(c) for c in group], F.col("_b"))


def group_positions(df: DataFrame, group: Sequence[str], order: Sequence[str],
                    pos_col: str = "Position", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Row number inside each group in ``order`` (unique within a group).

    One plan for every size: rows are numbered inside (group, bucket) and get
    the group's rows in earlier buckets from the small table of bucket sizes.
    No task needs more than one bucket of a group at a time.
    """
    rows = _buckets(df, group, order, bucket_rows)
    inside = Window.partitionBy(*group, "_b").orderBy(*[F.col(c) for c in order])
    past = Window.partitionBy(*group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy(*group, "_b").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(past), F.lit(0))).drop("_n")
    return (rows.withColumn("_at", F.row_number().over(inside)).join(offsets, on=[*group, "_b"])
            .withColumn(pos_col, F.col("_before") + F.col("_at")).drop("_b", "_before", "_at"))


def _ordered(m: DataFrame, s: LogSchema) -> tuple[DataFrame, list[str]]:
    """Document, id and the order keys as columns of their own (numbers and times sort by prefix), and their names."""
    keys = {f"_o{i}": order_key(m, c) for i, c in enumerate(s.order_cols)}
    return m.select(s.doc, s.exc_id, *[c.alias(n) for n, c in keys.items()]), list(keys)


def exception_sequence(m: DataFrame, s: LogSchema, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """G12 long form: (document, position, id) of every event, in event order."""
    rows, order = _ordered(m, s)
    return group_positions(rows, [s.doc], order, bucket_rows=bucket_rows).select(s.doc, "Position", s.exc_id)


def adjacent_pairs(m: DataFrame, s: LogSchema, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Counts of (id, next id) over raw sequences (repeats kept). Pairs
    inside a bucket come from a window over it; the pair across each border
    of a document's buckets from the table of first and last ids."""
    rows, order = _ordered(m, s)
    rows, key = _buckets(rows, [s.doc], order, bucket_rows), F.struct(*order)
    inside = Window.partitionBy(s.doc, "_b").orderBy(*order)
    pairs = (rows.select(F.col(s.exc_id).alias("From_ID"), F.lead(s.exc_id).over(inside).alias("To_ID"),
                         F.lead(F.lit(1)).over(inside).alias("_next"))
             .where(F.col("_next").isNotNull()).drop("_next"))
    ends = rows.groupBy(s.doc, "_b").agg(F.min_by(s.exc_id, key).alias("_first"), F.max_by(s.exc_id, key).alias("From_ID"))
    across = Window.partitionBy(s.doc).orderBy("_b")
    borders = (ends.select("From_ID", F.lead("_first").over(across).alias("To_ID"),
                           F.lead(F.lit(1)).over(across).alias("_next"))
               .where(F.col("_next").isNotNull()).drop("_next"))
    return pairs.union(borders).groupBy("From_ID", "To_ID").agg(F.count(F.lit(1)).alias("Count"))
