import math

import numpy as np

from brute import cosine_links
from feedweave.llm import nearest, neardup

SCHEMA = "vec_id long, embedding array<float>, label int, n_links string, id int, vec int, cell int, score int"


def corpus(n=500, dims=16, seed=3):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((n, dims)).astype(np.float32)
    for i in range(0, n, 3):  # near and exact copies
        j = rng.integers(0, n)
        base[i] = base[j] + rng.standard_normal(dims).astype(np.float32) * rng.choice([0, 0.02, 0.3, 0.4])
    rows = [(i, base[i].tolist(), int(i % 3)) for i in range(n)]
    hot = rng.standard_normal(dims).astype(np.float32)
    rows += [(10_000 + i, hot.tolist(), 1) for i in range(60)]
    rows += [(20_000 + i, (hot + rng.standard_normal(dims).astype(np.float32) * 0.15).tolist(), 1) for i in range(80)]
    bad = [None, [0.0] * dims, [math.nan] + [1.0] * (dims - 1), [math.inf] + [1.0] * (dims - 1), [None] + [1.0] * (dims - 1), []]
    rows += [(30_000 + i, v, 1) for i, v in enumerate(bad + bad)]
    rows += [(40_000, hot.tolist(), None), (40_001, hot.tolist(), None), (40_002, hot.tolist(), 2), (40_003, [1.0, 2.0], 1), (40_004, [1.0, 2.1], 1)]
    return rows


def full(rows):
    return [(*r, "s", 1, 2, 3, 4) for r in rows]


def test_links_are_those_of_all_pairs(table, monkeypatch):
    monkeypatch.setattr(neardup, "IN_BLOCK", 16)
    monkeypatch.setattr(neardup, "IN_CELL", 8)
    rows = corpus()
    found = neardup.near_vectors(table(full(rows), SCHEMA).repartition(3))
    assert sorted(map(tuple, found.collect())) == cosine_links(rows)


def test_no_vectors_and_only_bad_ones(table):
    assert neardup.near_vectors(table([], SCHEMA)).count() == 0
    found = neardup.near_vectors(table(full([(1, None, 1), (2, [0.0, 0.0], 1), (None, [1.0, 1.0], 1)]), SCHEMA)).collect()
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in found) == [
        ("1", 0, "1", True), ("2", 0, "2", True), ("None", 0, "None", False)]


def brute_nearest(rows, queries, k):
    ok = [(i, np.array(v, np.float32).astype(float)) for i, v, _ in rows
          if v and all(x is not None and math.isfinite(x) for x in v) and any(v) and len(v) == len(rows[0][1])]
    return {i: sorted(((float((u * v).sum()), j) for j, v in ok if j != i), key=lambda x: (-x[0], x[1]))[:k]
            for i, u in ok if i in queries}


def test_recall_ranks_and_scores(table, monkeypatch):
    monkeypatch.setattr(nearest, "IN_LEAF", 40)
    rows = corpus(900)
    vectors = table(full(rows), SCHEMA).repartition(3)
    found = nearest.nearest(vectors, vectors.filter("vec_id % 20 = 0"), k=20).collect()
    wanted = brute_nearest(rows, {r[0] for r in rows if r[0] % 20 == 0}, 20)
    scores = {i: dict((j, s) for s, j in brute_nearest(rows, {i}, len(rows))[i]) for i in list(wanted)[:10]}
    got = {}
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.score, r.vec_id))
    assert set(got) == set(wanted)
    hits = sum(len({j for _, j in got[i]} & {j for _, j in wanted[i]}) for i in wanted)
    assert hits >= 0.95 * sum(map(len, wanted.values()))
    for i, best in got.items():
        assert len(best) == 20 and best == sorted(best, key=lambda x: (-x[0], x[1]))
        if i in scores:
            assert all(abs(scores[i][j] - s) < 1e-12 for s, j in best)


def test_ties_go_to_the_smaller_id_and_few_candidates(table):
    rows = [(i, [1.0, 0.0], 0) for i in (5, 3, 9, 20, 40, 7)] + [(60, [0.0, 1.0], 0), (61, None, 0)]
    vectors = table(full(rows), SCHEMA)
    found = nearest.nearest(vectors, vectors.filter("vec_id % 20 = 0"), k=3).collect()
    got = {}
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == {20: [3, 5, 7], 40: [3, 5, 7], 60: [3, 5, 7]}
    few = nearest.nearest(vectors, vectors.filter("vec_id = 20"), k=50).collect()
    assert len(few) == 6
    assert nearest.nearest(table([], SCHEMA), table([], SCHEMA)).count() == 0


def test_chi_square_bound():
    assert abs(nearest.chi_square_bound(0.05, 8) - 15.507) < 1e-2 and abs(nearest.chi_square_bound(0.01, 2) - 9.210) < 1e-2
