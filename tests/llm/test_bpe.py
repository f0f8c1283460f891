"""Chunked BPE beside the library."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from reelgrain.llm import bpe, queries

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
SIGNS = ["a", "B", "Y", "̊", "́", "é", " ", "  ", "\n", "\t", " ", "'s", "'LL", "9", "½", "<|endoftext|>", "<|", "|>", "한",
         "ᄒ", "ᅡ", "Σ", "ß", "İ", "😀", "\x00", "\x1c", " ", "...", "-", "_", "中", "the", "tion"]


def expected(path, texts):
    library = Tokenizer.from_file(path)
    ids = [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    return [np.array(i, "<u4").tobytes() for i in ids], library.decode_batch(ids, skip_special_tokens=False)


@pytest.mark.parametrize("path", [WORD, BYTE])
@pytest.mark.parametrize("bits", [2, 4, 9])
def test_equals_library(monkeypatch, path, bits):
    monkeypatch.setattr(bpe, "CUT_BITS", bits)
    rng = random.Random(bits)
    texts = ["".join(rng.choices(SIGNS, k=rng.randrange(80))) for _ in range(1500)] + [None, "", " ", "a" * 70_000]
    texts += texts[:50]
    encoder = bpe.ChunkEncoder(path)
    ids, decoded = expected(path, texts)
    assert encoder.encode(pa.array(texts)) == ids
    assert bpe.Decoder(encoder).decode(ids).to_pylist() == decoded


def test_chunks_are_shared_and_found_by_content():
    rng = random.Random(5)
    passage = " ".join("".join(rng.choices("abcdefghij", k=rng.randrange(2, 9))) for _ in range(3000))
    encoder = bpe.ChunkEncoder(WORD)
    encoder.encode(pa.array([passage]))
    first = encoder.encoded_chunks
    assert first > 10
    encoder.encode(pa.array(["Another beginning, " + passage]))
    assert encoder.encoded_chunks - first <= 3 and encoder.reused_chunks >= first - 3


def test_a_wrong_neighbour_sends_the_whole_text_to_the_library(monkeypatch):
    monkeypatch.setattr(bpe, "CUT_BITS", 2)
    monkeypatch.setattr(bpe.ChunkEncoder, "_repair", lambda self, windows: [None] * len(windows))
    texts = ["some words that are cut into pieces", "and others"]
    assert bpe.ChunkEncoder(WORD).encode(pa.array(texts)) == expected(WORD, texts)[0]


def test_caches_are_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_BYTES", 1000)
    monkeypatch.setattr(bpe, "CACHED_WORDS", 20)
    rng = random.Random(8)
    encoder = bpe.ChunkEncoder(WORD)
    for _ in range(6):
        texts = [" ".join("".join(rng.choices("abcXYZ19é", k=5)) for _ in range(300))]
        assert encoder.encode(pa.array(texts)) == expected(WORD, texts)[0]
        assert len(encoder.chunks) < 40


def test_table(spark):
    texts = [None, "", "Plain text", "Plain text", "Y̊ x", "a <|endoftext|> b", "word " * 30_000]
    rows = [(i, t, 7, b"x") for i, t in enumerate(texts)] + [(None, "no id", 7, b"x"), (3, "again", 7, b"x")]
    docs = spark.createDataFrame(rows, "doc_id int, text string, ids int, decoded binary").repartition(3)
    out = bpe.encode(docs, WORD, decoded=True)
    assert out.columns == ["doc_id", "ids", "n_tokens", "decoded"]
    want = sorted(zip([r[0] for r in rows], *expected(WORD, [r[1] for r in rows]), strict=True), key=repr)
    assert sorted(((r.doc_id, bytes(r.ids), r.decoded) for r in out.collect()), key=repr) == want
    assert bpe.encode(docs.limit(0), WORD).count() == 0
    back = out.select(bpe.decode("ids", WORD).alias("t"), "decoded").union(
        out.limit(1).select(bpe.decode(F.lit(None).cast("binary"), WORD), F.lit(None).cast("string")))
    assert all(r.t == r.decoded for r in back.collect())


def test_query(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    ids, decoded = expected(WORD, [d.text for d in docs])
    want = {d.doc_id: (len(i) // 4, hashlib.sha256(i).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
            for d, i, t in zip(docs, ids, decoded, strict=True)}
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.QUERIES["op11_bpe"](spark, folder).collect()}
    assert got == want
