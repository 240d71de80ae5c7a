"""op2, op5, op7 against the tokenizers library and round trips."""

import hashlib
import zlib
from collections import defaultdict
from pathlib import Path

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from faultline.llm import op2_bpe, op5_token_files, op7_packing
from faultline.llm.encode import encoder, vocabulary

SF = "/root/testdata/sf0.001"
WORD, BYTE = vocabulary("word_bpe_49k.json"), vocabulary("byte_bpe_50k.json")
ODD = ["a  b", " x ", "\n\n b c \n d", "<|endoftext|> a<|startoftext|>b<", "é é ́x", "it's I'LL  ", "\t a",
       "Ǆ ΣΑΣ İ", "a   b c", "x\x1c y", "", " ", "\n", "a" * 3000, "ab" * 333 + " x", "日本語 テスト 😀😀", "!" * 100]


def documents():
    return dict(duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall())


def ids_of(path, text):
    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids if isinstance(path, str) else \
        path.encode(text or "", add_special_tokens=False).ids


def raw(ids):
    return np.array(ids, dtype="<u4").tobytes()


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_chunked_encoding_is_the_library_s(path):
    tok = Tokenizer.from_file(path)
    texts = [*ODD, None, *documents().values()]
    assert encoder(path).batch(texts) == [raw(ids_of(tok, t)) for t in texts]


@pytest.mark.parametrize("text", ["Heading\n\n\nfoo\tbar\tbaz", "a  b\u00a0c", "a \t b\tc", "x\n\ny\u3000z", " a\tb", "a\x85b "])
def test_runs_and_other_white_space_do_not_cancel(text):
    for path in (WORD, BYTE):
        assert encoder(path).batch([text]) == [raw(ids_of(path, text))]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("aAbB's.,!1 \n\t é́ßİΣ<|>  日😀")), max_size=40))
def test_any_text(text):
    word, byte = _TOKS
    assert encoder(WORD).batch([text]) == [raw(ids_of(word, text))]
    assert encoder(BYTE).batch([text]) == [raw(ids_of(byte, text))]
    ids, decoded = op2_bpe.codec(WORD).batch([text])[0]
    e = ids_of(word, text)
    assert ids == raw(e) and decoded.decode() == word.decode(e, skip_special_tokens=False)


_TOKS = Tokenizer.from_file(WORD), Tokenizer.from_file(BYTE)


def test_bpe_query(spark):
    tok = _TOKS[0]
    expect = {}
    for i, t in documents().items():
        e = ids_of(tok, t)
        text = tok.decode(e, skip_special_tokens=False)
        expect[i] = len(e), hashlib.sha256(raw(e)).hexdigest(), hashlib.sha256(text.encode()).hexdigest()
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in op2_bpe.query(spark, SF).collect()}
    assert got == expect


def test_bpe_long_words_and_edges(spark):
    tok = _TOKS[0]
    texts = [*ODD, None, "thequickbrown" * 2000]
    df = spark.createDataFrame([(i, t, "x", i) for i, t in enumerate(texts)], "doc_id long, text string, _doc string, _ids int")
    out = op2_bpe.encode(df)
    assert out.columns == ["doc_id", "text", "_doc", "_ids", "_decoded"]
    got = {r["doc_id"]: (bytes(r["_ids"]), r["_decoded"]) for r in out.collect()}
    assert got == {i: (raw(ids_of(tok, t)), tok.decode(ids_of(tok, t), skip_special_tokens=False)) for i, t in enumerate(texts)}
    assert op2_bpe.encode(df.limit(0)).collect() == []


def test_rank_code_round_trip():
    rng = np.random.default_rng(0)
    for n in (0, 1, 3, 4, 5, 1000):
        x = (rng.integers(0, 2 ** 32, n) >> rng.integers(0, 32, n)).astype(np.uint32)
        control, data = op5_token_files.pack(x)
        assert (op5_token_files.unpack(control, data, n) == x).all() and len(control) == -(-n // 4)


def test_token_files_query(spark, monkeypatch):
    monkeypatch.setattr(op5_token_files, "BLOCK_IDS", 5000)  # several blocks in a part
    at, expect = 0, {}
    for i, t in sorted(documents().items()):
        e = [*ids_of(_TOKS[1], t), 0]
        expect[i] = at, len(e), zlib.crc32(raw(e))
        at += len(e)
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in op5_token_files.query(spark, SF).collect()}
    assert got == expect


def test_token_files_edges(spark):
    df = spark.createDataFrame([(None, "a", 1), (3, None, 2), (3, "b b", 3), (1, "", 4)], "doc_id long, text string, ids int")
    files = op5_token_files.write_files(df)
    got = sorted((str(r["doc_id"]), bytes(r["ids"])) for r in files.read().collect())
    assert got == sorted((str(i), raw([*ids_of(_TOKS[1], t), 0])) for i, t in [(None, "a"), (3, None), (3, "b b"), (1, "")])
    ranks = files.spark.read.parquet(f"{files.path}/codebook").orderBy("rank").collect()
    assert ranks[0]["id"] == 0 and [r["n"] for r in ranks] == sorted((r["n"] for r in ranks), reverse=True)
    assert op5_token_files.write_files(df.limit(0)).read().collect() == []


def test_token_files_are_compressed(spark):
    files = op5_token_files.write_files(spark.read.parquet(f"{SF}/documents.parquet"))
    blocks = spark.read.parquet(f"{files.path}/blocks").selectExpr(
        "sum(n_ids)", "sum(octet_length(control) + octet_length(data))").first()
    for kind, plain in (("plain", 2 * blocks[0]), ("blocks", blocks[1])):
        assert sum(p.stat().st_size for p in Path(files.path.removeprefix("file:"), kind).glob("part-*")) < 0.9 * plain


LONG = "".join(f"Word{i % 977} and{',' if i % 5 else '  '} {'x' * (i % 13)}%%\n" for i in range(60_000))


def test_token_files_of_a_very_long_text(spark, monkeypatch):
    monkeypatch.setattr(op5_token_files, "BLOCK_IDS", 1000)
    df = spark.createDataFrame([(1, "short"), (2, LONG), (3, "b")], "doc_id long, text string")
    got = {r["doc_id"]: bytes(r["ids"]) for r in op5_token_files.write_files(df).read().collect()}
    assert got == {i: raw([*ids_of(_TOKS[1], t), 0]) for i, t in ((1, "short"), (2, LONG), (3, "b"))}


def test_packing_of_a_very_long_text(spark):
    df = spark.createDataFrame([(1, "short"), (2, LONG)], "doc_id long, text string")
    rows = op7_packing.packed_pieces(df).collect()
    ids = [*ids_of(_TOKS[0], LONG), 0]
    mine = sorted((r["start"], r["length"], r["ids_crc32"]) for r in rows if r["doc_id"] == 2)
    assert mine == [(at, len(ids[at:at + 2048]), zlib.crc32(raw(ids[at:at + 2048]))) for at in range(0, len(ids), 2048)]
    check_packing(rows)


def check_packing(rows, size=2048):
    by = defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    return len(by)


def test_packing_query(spark):
    rows = op7_packing.query(spark, SF).collect()
    expect = {}
    for i, t in documents().items():
        e = [*ids_of(_TOKS[0], t), 0]
        for k, at in enumerate(range(0, len(e), 2048)):
            expect[i, k] = at, len(e[at:at + 2048]), zlib.crc32(raw(e[at:at + 2048]))
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in rows} == expect
    assert check_packing(rows) <= -(-sum(x[1] for x in expect.values()) // 2048) * 1.01 + 1


def test_packed_sequences_hold_the_ids(spark):
    docs = [(1, "one two three"), (2, None), (2, None), (None, "four"), (3, "word " * 300)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = op7_packing.packed_pieces(df, size=64).collect()
    check_packing(rows, 64)
    seqs = {r["sequence_id"]: np.frombuffer(bytes(r["ids"]), "<u4") for r in op7_packing.sequences(df, size=64).collect()}
    assert sorted(sum((s.tolist() for s in seqs.values()), [])) == sorted(
        x for _, t in docs for x in [*ids_of(_TOKS[0], t), 0])
    assert all(len(s) <= 64 for s in seqs.values())
    assert op7_packing.packed_pieces(df.limit(0)).collect() == []


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=200))
def test_plan_places_each_piece_once(lengths):
    counts = np.bincount(np.array([*lengths, 0]), minlength=41)
    counts[0] = 0
    rows = op7_packing.plan(counts, 40)
    ranks, seqs = defaultdict(list), defaultdict(list)
    for length, first, n, seq, offset, copies in rows:
        ranks[length] += range(first, first + n)
        for k in range(n):
            seqs[seq + k // copies].append((offset + k % copies * length, length))
    assert {v: sorted(r) for v, r in ranks.items()} == {v: list(range(c)) for v, c in enumerate(counts) if c}
    for places in seqs.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 40
