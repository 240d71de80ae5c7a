"""Token files: frequency-ranked ids in byte-aligned variable-length code.

Ids are replaced by their rank in the corpus (the most frequent is 0) and
written in as many bytes as the rank needs (1 to 4, low byte first). The byte
counts stand apart, four to a control byte (two bits each, first in the low
bits), so decoding is table lookups in numpy: control byte -> four lengths,
lengths -> positions, bytes -> ranks, rank -> id.

A file record is a block: consecutive documents in ascending id order, their
ids and lengths, the control bytes and the data bytes. Blocks are numbered
``part`` (a range of ids) and ``block`` within it. The codebook (rank -> id,
at most the size of the vocabulary) is a file beside them. Files are Parquet
(pages in zstd), written and read by Spark, in the shared folder.

Edge cases: a null text encodes to the end id alone; null ids come last;
documents of equal id stand side by side; a very long text is encoded whole and
makes a block of its own size; an empty table gives files without
records; other columns of the input are not written.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from faultline.llm.encode import encoder, id_width, vocabulary
from faultline.llm.util import id_bounds, id_range, n_parts, shared_path, table

#: Ids in a block, from which a new one is begun.
BLOCK_IDS = 1 << 18
#: Chunks of text whose ids a worker keeps (some 200 bytes each).
CACHE_CHUNKS = 1_200_000
#: Row groups of some blocks: what a writer holds before it flushes. Compressed, as the plain
#: ids and the blocks, and often the shuffle between texts and plain ids, are on disk at one time.
GROUPS = {"parquet.block.size": str(16 << 20), "compression": "zstd", "parquet.compression.codec.zstd.level": "1"}
LENGTHS = np.array([[(c >> s & 3) + 1 for s in (0, 2, 4, 6)] for c in range(256)], dtype=np.uint8)


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of ranks below 2^32."""
    r = ranks.astype("<u4")
    size = 1 + (r > 0xFF).astype(np.uint8) + (r > 0xFFFF) + (r > 0xFFFFFF)
    codes = np.zeros(-(-len(r) // 4) * 4, dtype=np.uint8)
    codes[:len(r)] = size - 1
    codes = codes.reshape(-1, 4)
    control = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    at = np.cumsum(size, dtype=np.int64)
    data = np.empty(int(at[-1]) if len(at) else 0, dtype=np.uint8)
    at -= size
    data[at] = r & 0xFF
    for k in range(1, int(size.max(initial=1))):  # the rarer later bytes
        more = np.flatnonzero(size > k)
        data[at[more] + k] = r[more] >> 8 * k & 0xFF
    return control.astype(np.uint8).tobytes(), data.tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The n ranks of control and data bytes."""
    if not n:
        return np.zeros(0, dtype=np.uint32)
    size = LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n]
    at = np.cumsum(size, dtype=np.int64) - size
    raw = np.frombuffer(data, np.uint8)
    ranks = raw[at].astype(np.uint32)
    for k in range(1, int(size.max())):
        more = np.flatnonzero(size > k)
        ranks[more] |= raw[at[more] + k].astype(np.uint32) << 8 * k
    return ranks


@dataclass
class TokenFiles:
    """Where the files are."""
    spark: SparkSession
    path: str

    def codebook(self) -> np.ndarray:
        """Rank -> id; at most as long as the vocabulary."""
        rows = self.spark.read.parquet(f"{self.path}/codebook").orderBy("rank").collect()
        return np.array([r["id"] for r in rows], dtype="<u4")

    def read(self) -> DataFrame:
        """(part, block, at, doc_id, ids): documents decoded from the files;
        ids as little-endian unsigned 32-bit bytes, ``at`` the ids before it in the block."""
        ids = self.codebook()

        def decode(batches):
            import pyarrow as pa

            for b in batches:
                for i in range(b.num_rows):  # one block in memory at a time
                    row = b.slice(i, 1).to_pylist()[0]
                    lengths = np.frombuffer(row["lengths"], "<i8")
                    got = ids[unpack(row["control"], row["data"], int(lengths.sum()))] if len(ids) else ids
                    ends = np.cumsum(lengths)
                    known = np.unpackbits(np.frombuffer(row["known"], np.uint8), count=len(lengths)).astype(bool)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(lengths), row["part"], np.int32)),
                         pa.array(np.full(len(lengths), row["block"], np.int32)),
                         pa.array(ends - lengths), pa.array(np.frombuffer(row["docs"], "<i8"), mask=~known),
                         pa.array([got[e - n:e].tobytes() for e, n in zip(ends, lengths)], pa.binary())],
                        names=["part", "block", "at", "doc_id", "ids"])

        return (self.spark.read.parquet(f"{self.path}/blocks")
                .select("part", "block", "docs", "known", "lengths", "control", "data")
                .mapInArrow(decode, "part int, block int, at long, doc_id long, ids binary"))

    def starts(self) -> DataFrame:
        """(part, block, before): ids of all earlier blocks. One row a block;
        parts are summed first, so no task sees more than one part's blocks or one row a part."""
        blocks = self.spark.read.parquet(f"{self.path}/blocks").select("part", "block", "n_ids")
        parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
        past = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        parts = parts.select("part", F.coalesce(F.sum("n").over(past), F.lit(0)).alias("_p"))
        inside = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        return (blocks.withColumn("_b", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)))
                .join(parts, on="part").select("part", "block", (F.col("_p") + F.col("_b")).alias("before")))


def write_files(docs: DataFrame, vocab: str | None = None, end_id: int = 0, id_col: str = "doc_id",
                text_col: str = "text", path: str | None = None) -> TokenFiles:
    """Encode whole texts, append the end id, write blocks in ascending id order."""
    spark = docs.sparkSession
    vocab = vocab or vocabulary("byte_bpe_50k.json")
    path = path or shared_path(spark, "token-files")
    width = id_width(vocab)
    end = np.array([end_id], dtype=f"<u{width}").tobytes()
    n = n_parts(spark)

    def encode(batches):
        import pyarrow as pa

        enc = encoder(vocab, width, CACHE_CHUNKS)
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):  # bounds the ids held at once
                b = whole.slice(at, 1000)
                got = [enc.ids(t) + end for t in b.column("_text").to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column("part"), b.column("doc_id"), pa.array(got, pa.binary())],
                                                 names=["part", "doc_id", "ids"])

    def plain_blocks(batches):
        """Rows sorted by (part, id) to blocks of plain ids, with how often each id occurs."""
        import pyarrow as pa

        docs_, ids, size, part, block = [], [], 0, None, 0

        def flush():
            flat = np.frombuffer(b"".join(ids), f"<u{width}")
            if width == 2:
                times = np.bincount(flat, minlength=1 << 16)
                found = np.flatnonzero(times)
                count = times[found]
            else:
                found, count = np.unique(flat, return_counts=True)
            known = np.array([d is not None for d in docs_])
            return pa.RecordBatch.from_pylist([{
                "part": part, "block": block, "n_ids": len(flat),
                "docs": np.array([d or 0 for d in docs_], "<i8").tobytes(),
                "known": np.packbits(known).tobytes(),
                "lengths": np.array([len(x) // width for x in ids], "<i8").tobytes(),
                "ids": flat.tobytes(),
                "found": found.tolist(), "count": count.tolist()}], schema=pa.schema([
                    ("part", pa.int32()), ("block", pa.int32()), ("n_ids", pa.int64()), ("docs", pa.binary()),
                    ("known", pa.binary()), ("lengths", pa.binary()), ("ids", pa.binary()),
                    ("found", pa.list_(pa.int64())), ("count", pa.list_(pa.int64()))]))

        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                b = whole.slice(at, 500)
                for p, d, x in zip(*[b.column(i).to_pylist() for i in range(3)]):
                    if ids and (p != part or size >= BLOCK_IDS):
                        yield flush()
                        docs_, ids, size, block = [], [], 0, block + 1 if p == part else 0
                    part = p
                    docs_.append(d)
                    ids.append(x)
                    size += len(x) // width
        if ids:
            yield flush()

    rows = (docs.select(id_range(id_col, id_bounds(docs, id_col, 4 * n)).alias("part"),
                        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("_text"))
            .mapInArrow(encode, "part int, doc_id long, ids binary")
            .repartition(n, "part").sortWithinPartitions("part", F.col("doc_id").asc_nulls_last()))
    plain = ("part int, block int, n_ids long, docs binary, known binary, lengths binary, ids binary, "
             "found array<long>, count array<long>")
    rows.mapInArrow(plain_blocks, plain).write.options(**GROUPS).parquet(f"{path}/plain")
    staged = spark.read.parquet(f"{path}/plain")

    # Ranks over the whole corpus, summed from the blocks' counts.
    total = (staged.select(F.explode(F.arrays_zip("found", "count")).alias("x"))
             .groupBy(F.col("x.found").alias("id")).agg(F.sum("x.count").alias("n")))
    order = Window.orderBy(F.col("n").desc(), "id")  # at most the vocabulary's rows
    total.select((F.row_number().over(order) - 1).alias("rank"), "id", "n").write.parquet(f"{path}/codebook")
    files = TokenFiles(spark, path)
    ids = files.codebook()
    rank = np.zeros(int(ids.max()) + 1 if len(ids) else 0, dtype=np.uint32)
    rank[ids] = np.arange(len(ids), dtype=np.uint32)

    def ranked(batches):
        import pyarrow as pa

        keep = ["part", "block", "n_ids", "docs", "known", "lengths"]
        for whole in batches:
            for i in range(whole.num_rows):  # one block in memory at a time
                b = whole.slice(i, 1)
                control, data = pack(rank[np.frombuffer(b.column("ids")[0].as_py(), f"<u{width}")])
                yield pa.RecordBatch.from_arrays(
                    [*[b.column(c) for c in keep], pa.array([control], pa.binary()), pa.array([data], pa.binary())],
                    names=[*keep, "control", "data"])

    (staged.drop("found", "count")
     .mapInArrow(ranked, "part int, block int, n_ids long, docs binary, known binary, lengths binary, "
                         "control binary, data binary").write.options(**GROUPS).parquet(f"{path}/blocks"))
    return files


def query(spark, sf_dir):
    files = write_files(table(spark, sf_dir, "documents"))

    read = files.read().select("part", "block", "at", "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                               F.crc32("ids").alias("ids_crc32"))
    return (read.join(files.starts(), on=["part", "block"])
            .select("doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"))
