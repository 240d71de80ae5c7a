"""Best-two-fit packing of documents into sequences of a fixed number of tokens.

A document's ids (with an end id) are cut into pieces of at most ``size``
tokens. Packing needs only the pieces' lengths, of which there are at most
``size``, so the plan is made on the histogram of lengths:

* fill greedily: the longest waiting piece, then the longest that fits, and so on;
* then the smallest piece of that bin is taken out and two waiting pieces are
  sought that fit the gap so expanded more tightly; they take its place.

A bin's pattern is repeated as often as the counts allow, so the plan has a
few thousand rows at any corpus size. Pieces then get their places by rank:
the q-th piece of a length takes the q-th place planned for that length.
Ranks come from (length, hash bucket) groups and an offset table, so that one
very common length is spread over all tasks.

Edge cases: a null text is empty (one piece: the end id); null ids and
repeated rows are pieces of their own; a very long text is encoded whole and
cut into as many pieces as it needs; an empty table gives no rows; other
columns of the input are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faultline.llm.encode import encoder, vocabulary
from faultline.llm.util import n_parts, stored, table

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, vocab: str, size: int = 2048, end_id: int = 0,
                 id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Pieces of every document; ``with_ids`` adds their ids (unsigned 32-bit, little-endian)."""
    end = np.uint32(end_id).tobytes()

    def cut(batches):
        import pyarrow as pa

        enc = encoder(vocab)
        for b in batches:
            rows = [[], [], [], [], [], []]
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = enc.ids(text) + end
                for k, at in enumerate(range(0, len(ids), 4 * size)):
                    part = ids[at:at + 4 * size]
                    for col, v in zip(rows, (doc, k, at // 4, len(part) // 4, zlib.crc32(part), part if with_ids else None)):
                        col.append(v)
            cols = [pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int32()),
                    *[pa.array(r, pa.int64()) for r in rows[2:5]]]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                cols.append(pa.array(rows[5], pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names)

    schema = PIECE_SCHEMA + (", ids binary" if with_ids else "")
    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(cut, schema)


def plan(counts: np.ndarray, size: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-two-fit on a histogram: ``counts[l]`` pieces of length l.

    Rows (length, first rank, ranks, sequence, offset, copies): the pieces of
    that length with ranks [first, first + ranks) go to sequences counted from
    ``sequence``, ``copies`` to each, laid end to end from ``offset``.
    """
    left = counts.astype(np.int64).copy()
    used = np.zeros_like(left)
    rows, sequence = [], 0
    lengths = np.arange(size + 1)

    def largest(avail: np.ndarray) -> np.ndarray:
        """For each v: the largest available length <= v, or 0."""
        return np.maximum.accumulate(np.where(avail > 0, lengths, 0))

    while left.any():
        # Greedy fill of one bin.
        bin_, avail, gap = {}, left.copy(), size
        while gap > 0:
            best = int(np.where(avail[:gap + 1] > 0, lengths[:gap + 1], 0).max())
            if best == 0:
                break
            copies = min(gap // best, int(avail[best]))
            bin_[best] = copies
            avail[best] -= copies
            gap -= copies * best
        # Two waiting pieces in place of the bin's smallest, if they fill more.
        while gap > 0:
            small = min(bin_)
            room = gap + small
            fit = largest(avail)
            x = np.nonzero(avail[:room] > 0)[0]
            if not len(x):
                break
            y = fit[room - x]
            alone = (y == x) & (avail[x] < 2)
            if alone.any():  # the second must be another piece
                y[alone] = np.where(x[alone] > 0, fit[np.minimum(room - x[alone], x[alone] - 1)], 0)
            total = np.where(y > 0, x + y, 0)
            k = int(total.argmax())
            if total[k] <= small:
                break
            avail[small] += 1
            bin_[small] -= 1
            if not bin_[small]:
                del bin_[small]
            for v in (int(x[k]), int(y[k])):
                avail[v] -= 1
                bin_[v] = bin_.get(v, 0) + 1
            gap = room - int(total[k])
        times = min(int(left[v]) // c for v, c in bin_.items())
        offset = 0
        for v, c in sorted(bin_.items(), reverse=True):
            rows.append((v, int(used[v]), times * c, sequence, offset, c))
            used[v] += times * c
            left[v] -= times * c
            offset += c * v
        sequence += times
    return rows


def place(pieces: DataFrame, size: int = 2048) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to stored pieces (with a ``length``)."""
    spark = pieces.sparkSession
    counts = np.zeros(size + 1, dtype=np.int64)
    for r in pieces.groupBy("length").count().collect():  # at most ``size`` rows
        counts[r["length"]] = r["count"]
    rows = np.array(sorted(plan(counts, size)), dtype=np.int64).reshape(-1, 6)

    # Rank within a length: number the rows of each (length, bucket), then add
    # the rows of that length in earlier buckets.
    parts = F.lit(n_parts(spark))
    bucketed = pieces.withColumn("_b", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), parts))
    groups = bucketed.groupBy("length", "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = groups.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    order = Window.partitionBy("length", "_b").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (bucketed.withColumn("_r", F.row_number().over(order) - 1)
              .join(offsets, on=["length", "_b"])
              .withColumn("_rank", F.col("_before") + F.col("_r"))
              .select(*pieces.columns, "_rank"))
    at_len, at_rank = pieces.columns.index("length"), len(pieces.columns)
    span = np.int64(1) << np.int64(40)  # ranks stay below 2^40
    keys = rows[:, 0] * span + rows[:, 1] if len(rows) else np.zeros(0, np.int64)

    def assign(batches):
        import pyarrow as pa

        for b in batches:
            length = b.column(at_len).to_numpy(zero_copy_only=False)
            rank = b.column(at_rank).to_numpy(zero_copy_only=False)
            row = rows[np.searchsorted(keys, length * span + rank, side="right") - 1]
            k = rank - row[:, 1]
            names = [*b.schema.names[:-1], "sequence_id", "offset"]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(row[:, 3] + k // row[:, 5]),
                 pa.array(row[:, 4] + (k % row[:, 5]) * row[:, 0])], names)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return ranked.mapInArrow(assign, fields + ", sequence_id long, offset long")


def packed_pieces(docs: DataFrame, vocab: str | None = None, size: int = 2048, end_id: int = 0) -> DataFrame:
    """Every piece with its sequence and place."""
    vocab = vocab or vocabulary("word_bpe_49k.json")
    return place(stored(token_pieces(docs, vocab, size, end_id), "pieces"), size)


def sequences(docs: DataFrame, vocab: str | None = None, size: int = 2048, end_id: int = 0) -> DataFrame:
    """The packed sequences themselves: sequence_id, ids (unsigned 32-bit,
    little-endian), n_tokens. A sequence has at most ``size`` tokens."""
    vocab = vocab or vocabulary("word_bpe_49k.json")
    placed = place(stored(token_pieces(docs, vocab, size, end_id, with_ids=True), "pieces"), size)
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return (placed.groupBy("sequence_id").agg(parts.alias("_p"), F.sum("length").alias("n_tokens"))
            .select("sequence_id", F.aggregate("_p", F.lit(b"").cast("binary"),
                                               lambda a, x: F.concat(a, x["ids"])).alias("ids"), "n_tokens"))


def query(spark, sf_dir):
    return packed_pieces(table(spark, sf_dir, "documents"))
