"""Nearest neighbours against all pairs: recall, exact scores, ties and the odd vectors."""

import numpy as np
import pytest

from tidemark.llm import queries, vector_graph

SCHEMA = "vec_id long, embedding array<float>, score string, shard int"


def slow(rows, asked, k):
    """Each query's best (score, vec_id) over all usable rows, in double precision."""
    usable = {}
    for i, v in rows:
        if i is not None and v and None not in v and np.isfinite(np.array(v, float)).all() and any(v):
            usable.setdefault(i, []).append(np.array(v, np.float32).astype(float))
    out = {}
    for i in asked:
        q = usable[i][0]
        best = {}
        for j, vs in usable.items():
            for v in vs:
                if j != i and len(v) == len(q):
                    best[j] = max(best.get(j, -2), float(v @ q / (np.sqrt(v @ v) * np.sqrt(q @ q))))
        out[i] = sorted((-round(s, 12), j) for j, s in best.items())[:k]
    return out


@pytest.mark.parametrize("rows_per_shard", [None, 300])
def test_recall_on_the_table(spark, rows_per_shard):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding)) for r in table.collect()]
    ids, vectors = np.array([i for i, _ in rows]), np.array([v for _, v in rows], float)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    if rows_per_shard is None:
        found = queries.op13_nearest_neighbours(spark, "/root/testdata/sf0.1").collect()
    else:
        found = vector_graph.nearest_neighbours(table, table.where("vec_id % 50 = 0"), 5, rows_per_shard).collect()
    place = {int(i): n for n, i in enumerate(ids)}
    by_query = {}
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        assert r.score == pytest.approx(unit[place[r.query_id]] @ unit[place[r.vec_id]], abs=1e-12)
        by_query.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert sorted(by_query) == sorted(int(i) for i in ids if i % 50 == 0)
    hits = 0
    for q, got in by_query.items():
        assert [g[0] for g in got] == [1, 2, 3, 4, 5] and sorted((-s, v) for _, v, s in got) == [(-s, v) for _, v, s in got]
        near = unit @ unit[place[q]]
        near[place[q]] = -2
        hits += len({g[1] for g in got} & set(ids[np.argsort(-near, kind="stable")[:5]].tolist()))
    assert hits >= 0.95 * 5 * len(by_query)


def test_copies_ties_and_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(40)] + [(i, [1.0, 2.0, 3.0]) for i in range(5)]  # copies and repeated rows
    rows += [(100, [3.0, 2.0, 1.0]), (101, [6.0, 4.0, 2.0]), (102, [-1.0, 0.0, 0.0]), (103, [1e30, 2e30, 3e30]), (104, [1e-30, 0.0, 0.0])]
    rows += [(200, None), (201, []), (202, [0.0, 0.0, 0.0]), (203, [nan, 1.0, 1.0]), (204, [inf, 1.0, 1.0]), (205, [None, 1.0, 1.0])]
    rows += [(None, [1.0, 2.0, 3.0]), (300, [1.0, 2.0]), (301, [2.0, 1.0]), (400, [1.0, 2.0, 3.0, 4.0])]
    docs = spark.createDataFrame([(i, v, "clash", 0) for i, v in rows], SCHEMA)
    asked = [0, 3, 39, 100, 102, 104, 300, 400]
    found = vector_graph.nearest_neighbours(docs, docs.where(docs.vec_id.isin([*asked, 200, 202, 203])), 5)
    got = {q: [] for q in asked}
    for r in sorted(found.collect(), key=lambda r: (r.query_id, r.rank)):
        got[r.query_id].append((-round(r.score, 12), r.vec_id))
    assert {q: sorted(v) for q, v in got.items()} == slow(rows, asked, 5)
    assert got[400] == [] and [v for _, v in got[300]] == [301] and [v for _, v in got[0]][:4] == [1, 2, 3, 4]
    assert vector_graph.nearest_neighbours(docs.where("vec_id > 999"), docs, 5).collect() == []


def test_every_point_is_reached():
    """Tight groups of near copies stay connected: each point finds itself."""
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(5, 16))
    points = np.concatenate([c + 1e-3 * rng.normal(size=(300, 16)) for c in centres])[rng.permutation(1500)]
    graph = vector_graph.build_graph(points)
    found = graph.search(vector_graph._unit(points))
    assert (found == np.arange(len(points))[:, None]).any(axis=1).mean() > 0.98
    for i, (layer, count) in enumerate(zip(graph.layers, vector_graph.drawn_layers(len(points)))):
        assert layer.shape == (count, vector_graph.LINKS * (1 + (i == 0))) and layer.max() < count
