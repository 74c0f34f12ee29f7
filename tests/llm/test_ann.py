import random

import numpy as np
import pytest

from cratedig.llm.ann import Graph, nearest

SCHEMA = "vec_id long, embedding array<float>, label int, score double"


def brute(rows, queries, k):
    ids = np.array([i for i, _ in rows])
    v = np.array([x for _, x in rows], np.float32).astype(np.float64)
    out = {}
    for q, x in queries:
        x = np.array(x, np.float32).astype(np.float64)
        s = (v * x).sum(axis=1) / (np.sqrt((v * v).sum(axis=1)) * np.sqrt((x * x).sum()))
        best = sorted((-a, i) for a, i in zip(s, ids, strict=True) if i != q)[:k]
        out[q] = [(int(i), -a) for a, i in best]
    return out


def test_recall_on_clusters():
    rng = np.random.default_rng(1)
    centers = rng.normal(size=(40, 32))
    v = (centers[rng.integers(0, 40, 4000)] + 0.7 * rng.normal(size=(4000, 32))).astype(np.float32)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    g = Graph.build(v)
    q = v[:200]
    want = np.argsort(-(q @ v.T), axis=1)[:, :6]
    got = g.search(q, 96)[:, :6]
    assert np.mean([len(set(a) & set(b)) / 6 for a, b in zip(want, got, strict=True)]) > 0.95


def test_nearest_with_ties_and_bad_rows(spark):
    rng = np.random.default_rng(2)
    good = [(i, [float(x) for x in rng.normal(size=8).astype(np.float32)]) for i in range(600)]
    good += [(600 + i, good[0][1]) for i in range(30)]
    bad = [(900, None), (950, [0.0] * 8), (901, [float("nan")] * 8), (902, [None] + [1.0] * 7), (903, [float("inf")] * 8), (None, good[1][1]), (904, []), (905, [1.0])]
    frame = spark.createDataFrame([(i, v, 0, 1.0) for i, v in good + bad], SCHEMA)
    got = nearest(frame, frame.where("vec_id % 50 = 0"), shard=200).collect()
    want = brute(good, [x for x in good if x[0] % 50 == 0], 5)
    found = {q: [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == q] for q in want}
    assert {r.query_id for r in got} == set(want)
    assert all(len(x) == 5 for x in found.values())
    assert found[0] == [(i, pytest.approx(1.0)) for i in range(600, 605)]
    assert found[600][0][0] == 0
    hits = [len({i for i, _ in found[q]} & {i for i, _ in want[q]}) for q in want]
    assert sum(hits) / (5 * len(want)) >= 0.9


def test_few_and_no_rows(spark):
    frame = spark.createDataFrame([(0, [1.0, 0.0], 0, 0.0), (1, [0.0, 2.0], 0, 0.0), (2, [1.0, 1.0], 0, 0.0)], SCHEMA)
    got = nearest(frame, frame.where("vec_id = 0")).orderBy("rank").collect()
    assert [(r["rank"], r.vec_id, round(r.score, 6)) for r in got] == [(1, 2, 0.707107), (2, 1, 0.0)]
    assert nearest(frame.limit(0), frame.limit(0)).count() == 0
    assert nearest(frame, frame.limit(0)).count() == 0


def test_repeated_rows_do_not_hide_neighbours(spark):
    vector, rnd = [1.0, 2.0, 3.0], random.Random(1)
    rows = [(50, vector)] * 7 + [(51, vector), (52, vector)] + [(i, [rnd.random() for _ in range(3)]) for i in range(100, 140)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [(r["vec_id"], round(r["score"], 12)) for r in nearest(table, table.where("vec_id = 50")).orderBy("rank").collect()]
    assert got[:2] == [(51, 1.0), (52, 1.0)]
    assert len(got) == len({i for i, _ in got}) == 5
