"""Nearest neighbours against brute force."""

import numpy as np
import pytest

from surveypulse.llm import ann
from surveypulse.llm.ann import beam_search, build_graph, nearest, robust_prune


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, v int, ids int")


def brute(rows, queries, k):
    good = [(i, np.array(v, np.float32).astype(float)) for i, v, *_ in rows if v and None not in v and np.isfinite(v).all() and any(v)]
    out = {}
    for q, v in [g for g in good if g[0] in queries]:
        found = sorted((-float(x @ v), i) for i, x in good if i != q)
        out[q] = [(i, -s) for s, i in found[:k]]
    return out


def table(n, dim=16, seed=0):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(6, dim))
    return [(i, (centre[i % 6] + rng.normal(0, 0.6, dim)).astype(np.float32).tolist(), 0, 1, 2) for i in range(n)]


def test_graph_keeps_diverse_edges():
    rng = np.random.default_rng(1)
    vecs = rng.normal(size=(900, 16)).astype(np.float32)
    graph, start = build_graph(vecs, degree=16, beam=32)
    assert graph.shape == (900, 16) and (graph != np.arange(900)[:, None]).all()
    found, dist = beam_search(graph, vecs, start, vecs[:100], 32)
    true = np.argsort(((vecs[:100, None] - vecs[None]) ** 2).sum(2), 1)[:, :10]
    assert np.mean([len(set(f[:10]) & set(t)) for f, t in zip(found, true, strict=True)]) >= 9
    assert (np.diff(dist, axis=1)[np.isfinite(dist[:, 1:])] >= 0).all()
    # Three points on a line: the far one is reached through the near one.
    line = np.array([[0.0], [1.0], [2.0], [-1.5]], np.float32)
    assert robust_prune(line, np.array([0]), np.array([[1, 2, 3, -1, 1]]), 3, 1.2).tolist() == [[1, 3, -1]]


@pytest.mark.parametrize("shard", [8192, 150])
def test_recall(spark, shard):
    rows = table(800)
    df = frame(spark, rows)
    got = {}
    for r in nearest(df, df.where("vec_id % 20 = 0"), k=20, shard=shard, beam=40).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(got[r.query_id])
    expected = brute(rows, set(range(0, 800, 20)), 20)
    assert set(got) == set(expected)
    hits = 0
    for q, best in expected.items():
        assert len(got[q]) == 20 and q not in [i for i, _ in got[q]]
        assert all(s == pytest.approx(dict(brute(rows, {q}, 800)[q])[i], abs=1e-9) for i, s in got[q][:3])
        hits += len({i for i, _ in best} & {i for i, _ in got[q]})
    assert hits >= 0.9 * 20 * len(expected)


def test_copies_odd_vectors_and_few_rows(spark):
    same = [1.0, 0.5, 0.0, 0.0]
    rows = [(i, same, 0, 0, 0) for i in range(60)] + [(100, [0.0, 1.0, 0.0, 0.0], 0, 0, 0), (120, [-1.0, 0.0, 2.0, 0.0], 0, 0, 0)]
    odd = [(140, None, 0, 0, 0), (160, [0.0] * 4, 0, 0, 0), (180, [1.0, None, 0.0, 0.0], 0, 0, 0), (200, [float("nan"), 1.0, 0.0, 0.0], 0, 0, 0),
           (220, [float("inf"), 1.0, 0.0, 0.0], 0, 0, 0), (240, [1.0, 2.0], 0, 0, 0), (260, [], 0, 0, 0), (None, same, 0, 0, 0)]
    for k, part in ((20, rows + odd), (3, rows + odd), (20, rows[-2:] + odd)):
        df = frame(spark, part)
        got = {}
        for r in nearest(df, df.where("vec_id % 20 = 0"), k=k).orderBy("query_id", "rank").collect():
            got.setdefault(r.query_id, []).append((r.vec_id, pytest.approx(r.score)))
        sound = [r for r in part if r[0] is not None and r[0] <= 120]
        assert got == brute(sound, {0, 20, 40, 100, 120}, k)
    assert nearest(frame(spark, []), frame(spark, [])).count() == 0
    df = frame(spark, odd)
    assert nearest(df, df).count() == 0


def test_pairs_of_queries_and_shards_pass_the_driver_by(spark, monkeypatch):
    """Several rows of queries, each of several blocks, met by several parts of the shards."""
    rows = table(800, seed=2) + [(1000 + i, v, 0, 1, 2) for i, v, *_ in table(40, seed=2)]
    df = frame(spark, rows)
    said = lambda found: sorted(map(tuple, found.collect()))
    one = said(nearest(df, df.where("vec_id % 20 = 0"), shard=150))
    for name, value in (("BLOCK", 4), ("TASKS", 8), ("PARTS", 2), ("ROW", 2)):
        monkeypatch.setattr(ann, name, value, raising=False)
    found = nearest(df, df.where("vec_id % 20 = 0"), shard=150)
    assert said(found) == one
    expected = brute(rows, {r[0] for r in rows if r[0] % 20 == 0}, 20)
    hits = sum(i in [j for j, _ in expected[q]] for q, _, i, _ in one)
    assert len(one) == 20 * len(expected) and hits >= 0.9 * len(one)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "Broadcast" not in plan


def test_a_hub_of_many_candidates_is_pruned_in_parts():
    rng = np.random.default_rng(6)
    vecs = rng.normal(size=(3000, 8)).astype(np.float32)
    wide = rng.integers(-1, 3000, (9, 2000))
    some = robust_prune(vecs, np.arange(9), wide, 16, 1.2)
    assert [robust_prune(vecs, np.array([i]), wide[i : i + 1], 16, 1.2)[0].tolist() for i in range(9)] == some.tolist()
    # Slowly and plainly: each candidate, nearest first, unless one kept is nearer to it by the factor.
    dist = lambda a, b: float(((vecs[a].astype(float) - vecs[b]) ** 2).sum())
    for i in range(9):
        kept = []
        for c in sorted({int(x) for x in wide[i] if x >= 0 and x != i}, key=lambda c: dist(i, c)):
            if len(kept) < 16 and all(1.44 * dist(c, x) > dist(i, c) for x in kept):
                kept.append(c)
        assert some[i][some[i] >= 0].tolist() == kept
