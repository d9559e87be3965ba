import numpy as np
from pyspark.sql import functions as F

from matchlake.llm import vector_graph as V

DATA = "/root/testdata/sf0.1"
ROWS = "vec_id long, embedding array<float>"


def brute(ids, x, queries, k):
    out = {}
    for q in queries:
        s = x @ x[np.flatnonzero(ids == q)[0]]
        order = [t for t in np.lexsort((ids, -s)) if ids[t] != q][:k]
        out[q] = [(int(ids[t]), float(s[t])) for t in order]
    return out


def test_recall(spark):
    rows = spark.read.parquet(f"{DATA}/embeddings.parquet")
    got = V.search(V.index(rows, shard_nodes=700), rows.where(F.col("vec_id") % 20 == 0), 20).toPandas()
    frame = rows.toPandas()
    want = brute(frame.vec_id.to_numpy(), np.array(frame.embedding.tolist(), dtype=np.float64), sorted(set(got.query_id)), 20)
    hit = sum(len({i for i, _ in want[q]} & set(part.vec_id)) for q, part in got.groupby("query_id"))
    assert len(want) == 100 and hit / 2000 >= 0.95
    assert (got.groupby("query_id")["rank"].apply(sorted).apply(lambda r: r == list(range(1, 21)))).all()


def test_copies_ties_and_odd_vectors(spark):
    rng = np.random.default_rng(3)
    base = [[float(v) for v in rng.normal(size=6)] for _ in range(40)]
    data = [(k, v) for k, v in enumerate(base)] + [(100 + k, base[0]) for k in range(60)] + [(200 + k, [2 * a for a in base[1]]) for k in range(3)]
    odd = [(300, None), (301, [0.0] * 6), (302, [float("nan")] + [1.0] * 5), (303, [float("inf")] + [1.0] * 5), (304, [None] + [1.0] * 5), (305, []), (None, base[2])]
    rows = spark.createDataFrame(data + odd, ROWS).withColumn("score", F.lit("clash"))
    got = V.search(V.index(rows), rows, 20).toPandas().sort_values(["query_id", "rank"])
    ids, x = np.array([i for i, _ in data]), np.array([v for _, v in data], dtype=np.float32).astype(np.float64)
    want = brute(ids, x, ids.tolist(), 20)
    assert sorted(set(got.query_id)) == sorted(ids.tolist())
    for q, part in got.groupby("query_id"):
        assert [i for i, _ in want[q]] == part.vec_id.tolist()
        assert np.allclose([s for _, s in want[q]], part.score, rtol=1e-12)


def test_small_and_empty_tables(spark):
    none = spark.createDataFrame([], ROWS)
    assert V.search(V.index(none), none, 5).count() == 0
    two = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.5, 0.5]), (3, [1.0, 0.0, 0.0])], ROWS)
    got = V.search(V.index(two), two, 5).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == [(1, 1, 2, 0.5), (2, 1, 1, 0.5)]


def test_pruning_keeps_diverse_neighbours():
    points = np.array([[0, 0], [1, 0], [1.1, 0], [0, 2], [0, 2.1]], dtype=np.float32)
    got = V.robust_prune(points, np.array([0]), np.array([[1, 2, 3, 4]]), 4, 1.2)
    assert sorted(t for t in got[0].tolist() if t >= 0) == [1, 3]


def test_long_vectors_do_not_drown_short_ones(spark):
    import pytest
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1500, 32))
    x /= np.linalg.norm(x, axis=1)[:, None]
    x[0], x[1] = x[0] * 1e5, x[1] * 1e20
    rows = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    asked = list(range(100, 140))
    graphs = V.index(rows)
    got = V.search(graphs, rows.where(F.col("vec_id").isin(asked)), 20).toPandas()
    want = brute(np.arange(len(x)), x, asked, 20)
    hit = sum(len({i for i, _ in want[q]} & set(part.vec_id)) for q, part in got.groupby("query_id"))
    assert hit >= 0.95 * 20 * len(asked)
    with pytest.raises(ValueError, match="copies"):
        V.search(graphs, rows, 21)
