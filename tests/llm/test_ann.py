import heapq
import sys

import numpy as np

from tallyroom.llm import ann

SCHEMA = "vec_id long, embedding array<float>, label int, v string, cell string"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if x is None else [None if c is None else float(c) for c in x], 0, "v", "c") for i, x in rows], SCHEMA)


def exact(rows, q, k):
    v = np.array([np.float32(x) for _, x in rows], np.float64)
    ids = np.array([i for i, _ in rows])
    score = np.zeros(len(v))
    query = v[list(ids).index(q)]
    for d in range(v.shape[1]):
        score += query[d] * v[:, d]
    score[ids == q] = -np.inf
    return [(int(ids[j]), score[j]) for j in np.lexsort((ids, -score))[:k]]


def test_recall_and_exact_scores(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 16))
    rows = [(i, centres[i % 12] + rng.normal(scale=0.4, size=16)) for i in range(1500)]
    got = ann.neighbours(frame(spark, rows), every=50, k=10, share=0.1, least=100).collect()
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    recall = []
    for q in range(0, 1500, 50):
        want = exact(rows, q, 10)
        mine = sorted(by[q])
        assert [m[0] for m in mine] == list(range(1, 11))
        scores = dict(exact(rows, q, 1500))
        assert all(s == scores[v] for _, v, s in mine)
        recall.append(len({v for _, v, _ in mine} & {v for v, _ in want}) / 10)
    assert np.mean(recall) >= 0.9


def test_ties_bad_vectors_and_repeated_rows(spark):
    same = [1.0, 2.0, 3.0, 4.0]
    rows = [(i, same) for i in range(60)] + [(20, same), (100, None), (101, [0.0] * 4), (102, [1.0, None, 0.0, 0.0]),
                                            (103, [float("nan")] * 4), (104, [float("inf"), 0, 0, 1]), (None, same), (105, [1.0]), (40, same)]
    got = ann.neighbours(frame(spark, rows), every=20, k=5).collect()
    want = {q: [v for v in range(60) if v != q][:5] for q in (0, 20, 40)}
    said = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        said.setdefault(r.query_id, []).append(r.vec_id)
        assert r.score == 30.0
    assert said == want


def test_few_and_no_vectors(spark):
    got = ann.neighbours(frame(spark, [(0, [1.0, 0.0]), (1, [0.5, 0.1])])).collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 0.5)]
    assert ann.neighbours(frame(spark, [])).collect() == []
    assert ann.neighbours(frame(spark, [(0, None)])).collect() == []


def test_blocks_of_a_hot_cell(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 16)
    monkeypatch.setattr(ann, "QUERIES", 7)
    rows = [(i, [1.0, 1.0, 1.0, 1.0 + i * 1e-3]) for i in range(200)]
    got = ann.neighbours(frame(spark, rows), every=5, k=3).collect()
    assert len(got) == 120
    assert all(sorted(r.vec_id for r in got if r.query_id == q) == [i for i in range(196, 200) if i != q][-3:] for q in (0, 100, 195))


def test_walk_goes_by_the_summed_product():
    rng = np.random.default_rng(3)
    index = ann.MultiIndex(rng.normal(size=(6, 3)), rng.normal(size=(6, 3)), np.ones(36, int))
    q = rng.normal(size=6)
    cells = index.walk(q, 36)
    score = [index.left[c // 6] @ q[:3] + index.right[c % 6] @ q[3:] for c in cells]
    assert sorted(cells) == list(range(36)) and np.all(np.diff(score) <= 1e-12)


def test_recall_with_a_third_copies(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=16) + 0.5) for i in range(1400)]
    copies = [(2001 + i, [1.2] * 16) for i in range(700)]
    got = ann.neighbours(frame(spark, rows + copies), every=20, k=10, share=0.15, least=50).where("query_id < 1400").collect()
    found = {}
    for r in got:
        found.setdefault(r.query_id, set()).add(r.vec_id)
    share = [len(found.get(q, set()) & {v for v, _ in exact(rows + copies, q, 10)}) / 10 for q in range(0, 1400, 20)]
    assert np.mean(share) >= 0.95 and np.min(share) >= 0.5


def test_repeated_rows_inside_the_answer(spark):
    rows = [(i, [1.0, i * 0.01]) for i in range(1, 13)] + [(0, [1.0, 1.0])]
    repeated = rows + [(12, [1.0, 0.12])] * 20 + [(11, [1.0, 0.11]), (11, [0.11, 1.0]), (0, [1.0, 1.0])]
    got = sorted(ann.neighbours(frame(spark, repeated), every=20, k=5).collect(), key=lambda r: r["rank"])
    assert [(r["rank"], r.vec_id) for r in got] == [(1, 12), (2, 11), (3, 10), (4, 9), (5, 8)]


def test_walk_takes_the_cells_of_a_heap_in_few_calls():
    rng = np.random.default_rng(7)
    index = ann.MultiIndex(rng.normal(size=(64, 4)), rng.normal(size=(64, 4)), rng.poisson(0.7, 64 * 64))
    for wanted in (1, 40, 900, 10**6):
        q = rng.normal(size=8)
        cells = [(-(index.left[c // 64] @ q[:4] + index.right[c % 64] @ q[4:]), c) for c in np.flatnonzero(index.counts)]
        heapq.heapify(cells)
        want, held, calls = [], 0, []
        while cells and held < wanted:
            want.append(heapq.heappop(cells)[1])
            held += index.counts[want[-1]]
        sys.setprofile(lambda frame, event, arg: calls.append(event) if event == "c_call" else None)
        try:
            got = index.walk(q, wanted)
        finally:
            sys.setprofile(None)
        assert list(got) == want and len(calls) < 200


def test_rounding_of_the_matrix_product_does_not_reach_the_answer():
    exact = np.array([3.0, 2.0, 2.0, 2.0, 1.0, 5.0])
    ids = np.array([np.array(x) for x in ([7], [9], [4, 8], [5], [1], [6])] + [None], object)[:-1]
    for rough in (exact, exact + [0, 1e-9, -1e-9, 0, 0, -1e-9]):
        found, score = ann._best(rough, 2e-9, lambda top: exact[top], ids, 6, 3)
        assert found.tolist() == [7, 4, 5] and score.tolist() == [3.0, 2.0, 2.0]
