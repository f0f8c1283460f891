"""Resampling beside the plain definition."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from reelgrain.llm import queries, resample

SCHEMA = "doc_id bigint, text string, score string, rank int, weight double"


def words_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)


def grams(text):
    w = words_of(text)
    return [" ".join(w[i:i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def bucket(gram, buckets):
    return zlib.crc32(gram.encode()) % buckets


def brute(docs, target, percent, least, buckets, seed):
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(bucket(g, buckets) for g in grams(text))
    for text in target:
        t.update(bucket(g, buckets) for g in grams(text))
    n, m = s.total(), t.total()
    gain = [math.floor(1000 * math.log((t[b] + 1) * (n + buckets) / ((s[b] + 1) * (m + buckets)))) for b in range(buckets)]
    out = []
    for i, text in docs:
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[bucket(g, buckets)] for g in grams(text))
        out.append([i, len(words_of(text)), len(grams(text)), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    may = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0]))
    for rank, r in enumerate(may[:percent * len(may) // 100], 1):
        r[5] = rank
    return sorted(map(tuple, out), key=repr)


def corpus(n=150, seed=2):
    rng = random.Random(seed)
    vocabulary = ["Alpha", "beta", "gämma", "δ", "42", "x9", "İz", "中文", "o'k", "A-B", "kAPPA", "\x00nul", "é"]
    docs = [(i, " ".join(rng.choices(vocabulary, k=rng.choice((0, 1, 2, 5, 19, 20, 60))))) for i in range(n)]
    docs += [(n, None), (n + 1, ""), (n + 2, " ,;\n"), (n + 3, docs[9][1]), (n + 4, docs[9][1]), (None, "w " * 40), (9, docs[9][1]), (9, docs[9][1])]
    return docs, [" ".join(rng.choices(vocabulary[:5], k=30)) for _ in range(10)] + [None, ""]


@pytest.mark.parametrize("piece", [64, 4 << 20])
def test_features(monkeypatch, piece):
    monkeypatch.setattr(resample, "PIECE", piece)
    texts = [t for _, t in corpus()[0]] + ["solid" * 100, "one two", "a b c " * 300]
    found, row, n_words = resample.features(pa.array(texts), 97)
    assert n_words.tolist() == [len(words_of(t)) for t in texts]
    for i, t in enumerate(texts):
        assert Counter(found[row == i].tolist()) == Counter(bucket(g, 97) for g in grams(t))


def test_checksums_of_joined_texts():
    rng = random.Random(1)
    a = [rng.randbytes(rng.choice((0, 1, 9, 300))) for _ in range(200)]
    b = [rng.randbytes(rng.choice((0, 1, 2, 17, 70_000))) for _ in range(200)]
    crc = lambda v: np.array([zlib.crc32(x) for x in v], np.uint32)
    assert (resample.appended(crc(a), crc(b), np.array([len(x) for x in b])) == crc([x + y for x, y in zip(a, b)])).all()


@pytest.mark.parametrize("percent, least, ranges", [(5, 20, 4096), (30, 1, 2), (100, 0, 3), (1, 1000, 10)])
def test_equals_the_definition(spark, monkeypatch, percent, least, ranges):
    monkeypatch.setattr(resample, "RANGES", ranges)
    docs, target = corpus()
    df = spark.createDataFrame([(i, t, "s", 1, 0.5) for i, t in docs], SCHEMA).repartition(4)
    goal = spark.createDataFrame([(t, 1) for t in target], "text string, bucket int")
    out = resample.resample(df, goal, percent=percent, least_words=least, buckets=500)
    got = sorted(((r.doc_id, r.n_words, r.n_features, r.weight, r.score, r["rank"]) for r in out.collect()), key=repr)
    assert got == brute(docs, target, percent, least, 500, 42)


def test_empty_tables(spark):
    docs, target = corpus(20)
    df = spark.createDataFrame([(i, t, "s", 1, 0.5) for i, t in docs], SCHEMA)
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    assert resample.resample(df.limit(0), goal).count() == 0
    out = resample.resample(df, goal.limit(0), percent=50, least_words=1, buckets=50)
    assert sorted(((r.doc_id, r.n_words, r.n_features, r.weight, r.score, r["rank"]) for r in out.collect()), key=repr) \
        == brute(docs, [], 50, 1, 50, 42)


def test_query(spark, folder):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    target = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("text").collect()]
    want = {r[0]: (r[2], r[3], r[4], r[5]) for r in brute(docs, target, 5, 20, 10_000, 42)}
    assert {r.doc_id: (r.n_features, r.weight, r.score, r["rank"]) for r in queries.QUERIES["op13_resampling"](spark, folder).collect()} == want
