"""The stages of the corpus pipeline on odd tables, beside brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as cp
from reelgrain.llm import language, toxicity
from reelgrain.llm.queries import tokenizer_path

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
FOLDER = "/root/testdata/sf0.001"


def words(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()


@pytest.fixture(scope="module")
def rows():
    """Copies, near copies, shared passages, nulls, empties, repeated rows and ids, and rows without an id."""
    rng = random.Random(9)
    vocabulary = [a + b for a in ("ka", "Lo", "mi", "tu", "é", "ne", "sa") for b in ("r", "s", "ta", "ven", "x", "ö", "ki")]
    text = lambda n: " ".join(rng.choices(vocabulary, k=n))
    base = [(k, text(rng.choice((3, 60, 150)))) for k in range(40)]
    passage = text(70)
    base += [(50, base[1][1]), (51, base[1][1] + " end"), (52, text(40) + " " + passage), (53, passage + " " + text(30)), (54, text(5) + "  " + passage + "\n"),
             (60, None), (61, ""), (62, " \t"), (63, "one"), (64, "ONE"), (None, base[2][1]), (None, base[2][1]), (None, text(90)), (None, None),
             (5, base[5][1]), (5, base[5][1]), (6, text(80)), (70, base[5][1])]
    return base


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(k, t, None if (k or 0) % 3 else "xx", f"s{k}", 7) for k, t in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def key(r):
    return (r[0] is None, r[0] or 0, r[1] or "")


def test_near_duplicates(spark, docs, rows):
    once = sorted(set(rows), key=key)
    sets = []
    for _, t in once:
        w = words(t)
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    top = list(range(len(once)))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for i in range(len(once)):
        for j in range(i):
            same_id = once[i][0] is not None and once[i][0] == once[j][0]
            if same_id or (sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])):
                a, b = sorted((find(i), find(j)))
                top[b] = a
    # without an id the order among copies is that of a hash, so only how many stay is fixed
    first = {once[find(i)][0] for i in range(len(once))}
    kept = [once[i] for i in range(len(once)) if once[i][0] is not None and once[i][0] == once[find(i)][0]]
    nameless = len({find(i) for i in range(len(once)) if once[i][0] is None and sets[i] and once[find(i)][0] is None}) + sum(
        1 for i in range(len(once)) if once[i][0] is None and not sets[i])
    got = [(r.doc_id, r.text) for r in cp.drop_near_duplicates(spark, docs, FOLDER).collect()]
    assert sorted((r for r in got if r[0] is not None), key=key) == sorted(kept, key=key)
    assert sum(r[0] is None for r in got) == nameless and first


def test_passages(spark, docs, rows):
    found = cp.drop_passages(spark, docs, FOLDER).collect()
    split = [(2**63 - 1 if k is None else k, (t or "").encode().split()) for k, t in rows]
    first = {}
    for k, w in split:
        for i in range(len(w) - cp.PASSAGE + 1):
            at = tuple(w[i:i + cp.PASSAGE])
            first[at] = min(first.get(at, k), k)
    want = []
    for (k, t), (order, w) in zip(rows, split, strict=True):
        gone = {j for i in range(len(w) - cp.PASSAGE + 1) if first[tuple(w[i:i + cp.PASSAGE])] < order for j in range(i, i + cp.PASSAGE)}
        cut = b" ".join(x for i, x in enumerate(w) if i not in gone).decode()
        want.append((k, cut if gone else t, len(cut) if gone else 7))
    assert sorted(((r.doc_id, r.text, r.n_chars) for r in found), key=repr) == sorted(want, key=repr)
    assert any(len(t or "") < len(rows[i][1] or "") for i, (_, t, _) in enumerate(want))


def test_packing(spark, docs, rows):
    library = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    ids = lambda t: np.array(library.encode(t or "", add_special_tokens=False).ids + [2], "<u4").tobytes()
    pieces = cp.pack(spark, docs, FOLDER).collect()
    assert sorted(p.start for p in pieces if p.doc_id == 63) == sorted(p.start for p in pieces if p.doc_id == 64)
    want, got = sorted((k is None, k or 0, ids(t)) for k, t in rows), {}
    assert sum(p.length for p in pieces) == sum(len(w[2]) // 4 for w in want)
    single = {k for k, _ in rows if sum(a == k for a, _ in rows) == 1}
    for p in sorted((p for p in pieces if p.doc_id in single), key=lambda p: p.start):
        got[p.doc_id] = got.get(p.doc_id, b"") + bytes(p.ids)
    assert got == {k: ids(t) for k, t in rows if k in single}


def test_filters_are_the_operators_scores(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    rows = docs.unionByName(docs.limit(3).withColumn("text", F.lit(None).cast("string")).withColumn("doc_id", F.lit(None).cast(docs.schema["doc_id"].dataType)))
    model = toxicity.train(rows, labels, F.lit(True))
    want = toxicity.score(rows, model).where("score < 0.3").groupBy("doc_id").count().collect()
    assert sorted(map(tuple, want), key=repr) == sorted(map(tuple, cp.drop_toxic(spark, rows, FOLDER).groupBy("doc_id").count().collect()), key=repr)
    found = language.predict(rows, language.train(rows, F.lit(True))).where(f"lang_pred <> 'und' AND score > {cp.SURE}").select("doc_id")
    kept = cp.drop_unknown_language(spark, rows, FOLDER)
    assert sorted(r.doc_id for r in found.collect()) == sorted(r.doc_id for r in kept.collect())
    assert kept.where("lang IS NULL OR text IS NULL").count() == 0


def test_a_language_is_found_once(spark):
    found = cp.drop_unknown_language(spark, spark.read.parquet(f"{FOLDER}/documents.parquet"), FOLDER)
    assert found._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


def test_without_languages_all_stay(spark, docs, rows):
    blank = docs.withColumn("lang", F.lit(None).cast("string"))
    assert cp.drop_unknown_language(spark, blank, FOLDER).count() == len(rows)


def test_empty_tables(spark, empty):
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, empty, FOLDER)
        assert out.count() == 0 and tuple(out.columns) == cp.COLUMNS, name
    assert cp.pack(spark, empty, FOLDER).count() == 0


def test_run(spark):
    folder, docs = FOLDER, spark.read.parquet(f"{FOLDER}/documents.parquet")
    for name, stage in cp.STAGES[:-1]:
        before, docs = docs.count(), stage(spark, docs, folder).cache()
        assert tuple(docs.columns) == cp.COLUMNS and 0 < docs.count() <= before, name
    pieces = cp.STAGES[-1][1](spark, docs, folder)
    assert pieces.select("doc_id").distinct().count() == docs.count()
