"""Vectors that meet in blocks of bounded size, the small ones of larger tables forced here."""

import numpy as np
import pytest

from reelgrain.llm import cells, knn_join, near_vectors


def vectors(spark, kind):
    rng = np.random.default_rng(11)
    base = rng.normal(size=(150, 24))
    near = base[:60] + rng.normal(size=(60, 24)) * 0.12
    crowd = base[0] + rng.normal(size=(90, 24)) * 0.05
    rows = [(int(k), v.tolist()) for k, v in enumerate(np.concatenate([base, near, crowd, base[:30]]))]
    rows += [(900, None), (901, [0.0] * 24), (None, base[0].tolist()), (902, [1.0, 2.0]), (903, [2.0, 4.0]), (904, [-0.0] + base[3].tolist()[1:]), (905, [0.0] + base[3].tolist()[1:])]
    return spark.createDataFrame(rows, f"vec_id bigint, embedding array<{kind}>")


def known(table):
    return {r.vec_id: np.array(r.embedding, np.float64) for r in table.collect() if r.vec_id is not None and r.embedding}


@pytest.fixture()
def small_blocks(monkeypatch):
    monkeypatch.setattr(near_vectors, "BLOCK_BYTES", 4000)
    monkeypatch.setattr(knn_join, "DATA_BYTES", 1000)
    monkeypatch.setattr(knn_join, "QUERY_BYTES", 700)
    monkeypatch.setattr(knn_join, "LEAST_ROWS", 8)
    monkeypatch.setattr(cells, "CELL", 20)


@pytest.mark.parametrize("kind", ["float", "double"])
def test_links_across_blocks(spark, small_blocks, kind):
    table = vectors(spark, kind)
    x = {k: v for k, v in known(table).items() if v.any()}
    linked = {a: {b for b in x if b != a and len(x[a]) == len(x[b]) and x[a] @ x[b] >= 0.9 * np.linalg.norm(x[a]) * np.linalg.norm(x[b])} for a in x}
    top = {r.vec_id: r.vec_id for r in table.collect()}
    for _ in x:
        for a in linked:
            for b in linked[a]:
                top[a] = top[b] = min(top[a], top[b])
    got = near_vectors.near_duplicates(table).collect()
    assert len(got) == table.count()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == {k: (len(linked.get(k, ())), top[k]) for k in top}


@pytest.mark.parametrize("scale", [4, 64, 1 << 16])
def test_best_across_blocks(spark, small_blocks, scale):
    table = vectors(spark, "double")
    whole = {k: np.floor(scale * v).astype(np.int64) for k, v in known(table).items()}
    want = set()
    for q in [q for q in whole if q % 4 == 0]:
        best = sorted((-int(whole[q] @ v), k) for k, v in whole.items() if k != q and len(v) == len(whole[q]))[:9]
        want |= {(q, n + 1, k, -s) for n, (s, k) in enumerate(best)}
    assert {tuple(r) for r in knn_join.top_k(table, k=9, every=4, scale=scale).collect()} == want


def test_an_id_counts_with_its_best_vector(spark):
    rows = [(0, [1.0, 0.0]), (1, [3.0, 0.0]), (1, [4.0, 0.0]), (1, [5.0, 0.0]), (2, [2.0, 0.0])]
    got = knn_join.top_k(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), k=2, every=20, scale=1)
    assert sorted(tuple(r) for r in got.collect()) == [(0, 1, 1, 5), (0, 2, 2, 2)]
