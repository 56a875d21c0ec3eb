from __future__ import annotations

from collections import defaultdict

import numpy as np
import pytest

from duesight.llm import neighbours as N
from duesight.llm.queries import QUERIES
from tests.llm.conftest import SMALL


def brute(rows, asked, k=20):
    """rows: distinct (id, vector). The k nearest of each asked row, ties to the smaller id."""
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], dtype=np.float64)
    out = {}
    for i, v in asked:
        scores = x @ np.asarray(v, dtype=np.float64)
        order = np.lexsort((ids, -scores))
        out[i] = [(int(ids[j]), float(scores[j])) for j in order if ids[j] != i][:k]
    return out


def found(frame):
    out = defaultdict(list)
    for r in sorted(frame.collect(), key=lambda r: (r.query_id, r.rank)):
        out[r.query_id].append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def recall(got, want):
    """Share of the nearest found; one as near as the last counts."""
    shares = []
    for i, nearest in want.items():
        assert len(got[i]) == len(nearest) and len({v for v, _ in got[i]}) == len(nearest)
        scores = [s for _, s in got[i]]
        assert all(a >= b - 1e-12 for a, b in zip(scores, scores[1:], strict=False))
        if nearest:
            shares.append(sum(s >= nearest[-1][1] - 1e-9 for s in scores) / len(nearest))
    return float(np.mean(shares))


def test_given_vectors(spark):
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    got = found(QUERIES["op1_neighbours"](spark, SMALL))
    want = brute(rows, [r for r in rows if r[0] % 20 == 0])
    assert set(got) == set(want)
    assert recall(got, want) >= 0.98
    exact = dict(rows)
    for i, near in got.items():
        for j, score in near:
            assert abs(score - np.dot(np.float64(exact[i]), np.float64(exact[j]))) < 1e-12


@pytest.mark.parametrize("norms", [False, True])
def test_graph_of_many_blocks(spark, norms):
    """More nodes than a block holds, so that the rounds and the search have to find the way."""
    draw = np.random.default_rng(4)
    x = draw.standard_normal((6000, 24))
    x /= np.linalg.norm(x, axis=1)[:, None]
    if norms:
        x *= draw.uniform(0.5, 1.5, (6000, 1))
    rows = list(enumerate(x.tolist()))
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = found(N.nearest(table, table.filter("vec_id % 40 = 0"), build=N.Build(block=128)))
    assert recall(got, brute(rows, [r for r in rows if r[0] % 40 == 0])) >= 0.9


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 0.0, 0.0]) for i in range(0, 60, 2)] + [(i, [0.0, 1.0, float(i)]) for i in range(1, 30, 2)]
    bad = [(100, None), (101, [0.0, 0.0, 0.0]), (102, [1.0, None, 0.0]), (103, [nan, 1.0, 0.0]), (104, [inf, 1.0, 0.0]), (105, []), (106, [1.0, 2.0]), (None, [1.0, 1.0, 1.0])]
    table = spark.createDataFrame(rows + rows[:5] + bad, "vec_id long, embedding array<double>").selectExpr("*", "1 AS node", "2 AS q", "'x' AS vec", "0 AS score")
    got = found(N.nearest(table, table.filter("vec_id % 20 = 0 or vec_id > 99")))
    assert dict(got) == {i: [(a, pytest.approx(s)) for a, s in near] for i, near in brute(rows, [r for r in rows if r[0] % 20 == 0]).items()}


def test_few_rows(spark):
    table = spark.createDataFrame([(20, [1.0, 2.0]), (1, [2.0, 1.0]), (40, [0.5, 0.5])], "vec_id long, embedding array<double>")
    got = found(N.nearest(table, table.filter("vec_id % 20 = 0")))
    assert {i: [v for v, _ in near] for i, near in got.items()} == {20: [1, 40], 40: [1, 20]}
    assert N.nearest(table.filter("false"), table.filter("false")).collect() == []
    one = table.filter("vec_id = 20")
    assert N.nearest(one, one).collect() == []
