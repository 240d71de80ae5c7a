"""Byte-pair encoding with a segment tree over the ranks of adjacent pairs.

A word is a row of symbols; each adjacent pair has the rank of its merge (or
none). A segment tree over the pairs keeps in every node the smallest
(rank, position) below it, so the root is the leftmost lowest-rank merge.
Merging writes the new symbol, takes the right one out of a linked list and
updates three leaves, each a path of log2(n) nodes; it ends when the root
holds no mergeable pair.

The distinct words of a batch are merged side by side: words of like length
form one array with a tree in each row, and a step applies every word's root
merge at once. Long words (over ``ARRAY_MAX`` symbols) get a tree of their
own. Each distinct chunk of text is encoded once per batch and worker (a
bounded cache), as encoding a word does not depend on its neighbours.

Texts are prepared as the vocabulary file says (its normalizer, its split
pattern, its special tokens, ids of the byte alphabet, its end-of-word mark).

Edge cases: a null text is empty and encodes to no ids; null ids, repeated
rows and extra columns pass through; an empty table gives no rows; an input
column with the name of an output gives way to it.
"""

from __future__ import annotations

import json

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.llm.encode import byte_alphabet, vocabulary
from faultline.llm.util import boxed, table, unboxed

ARRAY_MAX = 64
#: Chunks kept per Python worker; the cache starts anew when it is full.
CACHE_CHUNKS = 400_000
NONE = np.iinfo(np.int64).max


class SegmentTreeBPE:
    """Encoder and decoder of one vocabulary file of the word kind."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        spec = json.load(open(path, encoding="utf-8"))
        vocab: dict[str, int] = spec["model"]["vocab"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.end = spec["model"]["end_of_word_suffix"] or ""
        names = byte_alphabet()
        self.first = np.array([vocab[names[b]] for b in range(256)], dtype=np.int64)
        self.last = np.array([vocab[names[b] + self.end] for b in range(256)], dtype=np.int64)
        # (left id, right id) -> rank and merged id; the earliest of equal pairs counts.
        left = np.array([vocab[a] for a, _ in merges], dtype=np.int64)
        right = np.array([vocab[b] for _, b in merges], dtype=np.int64)
        made = np.array([vocab[a + b] for a, b in merges], dtype=np.int64)
        keys, at = np.unique(left << 32 | right, return_index=True)
        self.keys, self.rank, self.made = keys, at.astype(np.int64), made[at]
        self.pairs = dict(zip(keys.tolist(), zip(at.tolist(), made[at].tolist())))
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, self.specials)) + ")")
        self.normal = Tokenizer.from_file(path).normalizer.normalize_str
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pieces = regex.compile(pattern).findall
        text = {i: s for s, i in vocab.items()} | {i: s for s, i in self.specials.items()}
        self.token = [text.get(i, "").encode("utf-8") for i in range(max(text) + 1)]
        self.cache: dict[str, tuple[bytes, bytes]] = {}

    # -- merging ---------------------------------------------------------

    def _pair(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (or NONE) and merged id of each pair."""
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[at] == key
        return np.where(hit, self.rank[at], NONE), self.made[at]

    def merge_rows(self, sym: np.ndarray) -> np.ndarray:
        """Merge all rows of ``sym`` (words by symbols, -1 where there is none); removed symbols become -1."""
        n_words, n = sym.shape
        leaves = 1 << max(1, (n - 1).bit_length())
        depth = leaves.bit_length() - 1
        rows = np.arange(n_words)
        # Column 0 and n + 1 of the links are sentinels.
        nxt, prv = np.tile(np.arange(1, n + 1), (n_words, 1)), np.tile(np.arange(-1, n - 1), (n_words, 1))
        sym = np.concatenate([sym, np.full((n_words, 1), -1)], axis=1)  # symbol n: past the end

        def value(w: np.ndarray, i: np.ndarray) -> np.ndarray:
            """(rank, position) of the pair at symbol i, as one number."""
            a = sym[w, i]
            b = sym[w, nxt[w, i]]
            rank, _ = self._pair(np.maximum(a, 0), np.maximum(b, 0))
            return np.where((a >= 0) & (b >= 0) & (rank != NONE), rank << 24 | i, NONE)

        tree = np.full((n_words, 2 * leaves), NONE)
        for i in range(n - 1):
            tree[:, leaves + i] = value(rows, np.full(n_words, i))
        for node in range(leaves - 1, 0, -1):
            tree[:, node] = np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1])

        def update(w: np.ndarray, i: np.ndarray, v: np.ndarray) -> None:
            node = leaves + i
            tree[w, node] = v
            for _ in range(depth):
                node = node >> 1
                tree[w, node] = np.minimum(tree[w, 2 * node], tree[w, 2 * node + 1])

        w = rows[tree[:, 1] != NONE]
        while len(w):
            i = tree[w, 1] & 0xFFFFFF
            j = nxt[w, i]
            _, sym[w, i] = self._pair(sym[w, i], sym[w, j])
            sym[w, j] = -1
            after = nxt[w, j]
            nxt[w, i] = after
            inner = after < n
            prv[w[inner], after[inner]] = i[inner]
            inner = j < n - 1
            update(w[inner], j[inner], np.full(int(inner.sum()), NONE))
            inner = i < n - 1
            update(w[inner], i[inner], value(w[inner], i[inner]))
            before = prv[w, i]
            inner = before >= 0
            update(w[inner], before[inner], value(w[inner], before[inner]))
            w = w[tree[w, 1] != NONE]
        return sym[:, :-1]

    def merge_long(self, sym: list[int]) -> list[int]:
        """One word of any length: the same tree in plain lists."""
        n, none = len(sym), (1 << 62, 0)
        leaves = 1 << max(1, (n - 1).bit_length())
        nxt, prv, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        tree = [none] * (2 * leaves)
        pairs = self.pairs

        def value(i: int):
            j = nxt[i]
            hit = pairs.get(sym[i] << 32 | sym[j]) if j < n else None
            return (hit[0], i) if hit else none

        for i in range(n - 1):
            tree[leaves + i] = value(i)
        for node in range(leaves - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

        def update(i: int, v) -> None:
            node = leaves + i
            tree[node] = v
            while node > 1:
                node >>= 1
                tree[node] = min(tree[2 * node], tree[2 * node + 1])

        while tree[1] != none:
            i = tree[1][1]
            j = nxt[i]
            sym[i] = pairs[sym[i] << 32 | sym[j]][1]
            alive[j] = False
            nxt[i] = nxt[j]
            if nxt[i] < n:
                prv[nxt[i]] = i
            update(j, none)
            update(i, value(i))
            if prv[i] >= 0:
                update(prv[i], value(prv[i]))
        return [s for s, a in zip(sym, alive) if a]

    def encode_words(self, words: list[str]) -> dict[str, list[int]]:
        """Ids of each distinct pre-token."""
        out: dict[str, list[int]] = {}
        groups: dict[int, list[tuple[str, bytes]]] = {}
        for word in words:
            raw = word.encode("utf-8", "surrogatepass")
            if len(raw) > ARRAY_MAX:
                out[word] = self.merge_long([*self.first[list(raw[:-1])].tolist(), int(self.last[raw[-1]])])
            else:
                groups.setdefault((len(raw) + 3) // 4, []).append((word, raw))
        for size, group in groups.items():
            n = 4 * size
            b = np.frombuffer(b"".join(raw.ljust(n, b"\0") for _, raw in group), np.uint8).reshape(-1, n)
            length = np.array([len(raw) for _, raw in group])
            place = np.arange(n)
            sym = np.where(place < length[:, None] - 1, self.first[b], self.last[b])
            sym = self.merge_rows(np.where(place < length[:, None], sym, -1))
            flat, counts = sym[sym >= 0].tolist(), (sym >= 0).sum(axis=1).tolist()
            at = 0
            for (word, _), c in zip(group, counts):
                out[word] = flat[at:at + c]
                at += c
        return out

    # -- texts -----------------------------------------------------------

    def _pretokens(self, chunk: str) -> list[str | int]:
        """Pre-tokens of a chunk; a special token is its id."""
        if "<" not in chunk:
            return self.pieces(self.normal(chunk))
        out: list[str | int] = []
        for part in self.split_special.split(chunk):
            if part in self.specials:
                out.append(self.specials[part])
            elif part:
                out += self.pieces(self.normal(part))
        return out

    def _learn(self, chunks: list[str]) -> None:
        cut = [self._pretokens(c) for c in chunks]
        ids_of = self.encode_words(list({p for c in cut for p in c if isinstance(p, str)}))
        for chunk, parts in zip(chunks, cut):
            ids = [i for p in parts for i in (ids_of[p] if isinstance(p, str) else (p,))]
            self.cache[chunk] = np.array(ids, dtype="<u4").tobytes(), self.decode(ids)

    def decode(self, ids) -> bytes:
        """Text of ids in UTF-8: the vocabulary names no decoder, so tokens joined by a space."""
        token = self.token
        return b" ".join([token[i] for i in ids])

    def batch(self, texts: list[str | None]) -> list[tuple[bytes, bytes]]:
        """(ids as little-endian unsigned 32-bit numbers, decoded text) of whole texts."""
        out = []
        for at in range(0, len(texts), 1024):
            # No pre-token spans a space or a line feed.
            cut = [(t or "").replace("\n", " ").split(" ") for t in texts[at:at + 1024]]
            if len(self.cache) > CACHE_CHUNKS:
                self.cache.clear()
            self._learn([c for c in set().union(*cut) if c not in self.cache])
            get = self.cache.__getitem__
            for chunks in cut:
                found = list(map(get, chunks))
                out.append((b"".join([x[0] for x in found]), b" ".join([x[1] for x in found if x[0]])))
        return out


_CODECS: dict[str, SegmentTreeBPE] = {}


def codec(path: str) -> SegmentTreeBPE:
    """The worker's codec for a vocabulary file."""
    if path not in _CODECS:
        _CODECS[path] = SegmentTreeBPE(path)
    return _CODECS[path]


def encode(docs: DataFrame, vocab: str | None = None, text_col: str = "text") -> DataFrame:
    """``docs`` plus ``_ids`` (little-endian unsigned 32-bit) and ``_decoded`` (text of those ids)."""
    vocab = vocab or vocabulary("word_bpe_49k.json")

    def run(batches):
        import pyarrow as pa

        bpe = codec(vocab)
        for b in batches:
            got = bpe.batch(b.column("_doc").field(text_col).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [b.column("_doc"), pa.array([x[0] for x in got], pa.binary()),
                 pa.array([x[1].decode("utf-8") for x in got], pa.string())], names=["_doc", "_ids", "_decoded"])

    rows = docs.select(boxed(docs))
    schema = T.StructType([rows.schema["_doc"], T.StructField("_ids", T.BinaryType()),
                           T.StructField("_decoded", T.StringType())])
    return unboxed(rows.mapInArrow(run, schema), docs, {"_ids": F.col("_ids"), "_decoded": F.col("_decoded")})


def query(spark, sf_dir):
    r = encode(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return r.select("doc_id", (F.octet_length("_ids") / 4).cast("long").alias("n_tokens"),
                    F.sha2("_ids", 256).alias("ids_sha256"), F.sha2("_decoded", 256).alias("decoded_sha256"))
