import random

import pytest
from pyspark.sql import functions as F

from matchlake.llm import toxicity
from matchlake.llm.common import fold

DATA = "/root/testdata/sf0.1"


def brute_segments(scores):
    """Maximal scoring segments by definition: the best segment, then those left and right of it."""
    best = None
    for a in range(len(scores)):
        for b in range(a + 1, len(scores) + 1):
            s = sum(scores[a:b])
            if s > 0 and (best is None or s > best[2] + 1e-12 or abs(s - best[2]) < 1e-12 and b - a < best[1] - best[0]):
                best = (a, b, s)
    if best is None:
        return []
    a, b, s = best
    left = brute_segments(scores[:a])
    right = [(x + b, y + b, z) for x, y, z in brute_segments(scores[b:])]
    return left + [(a, b, s)] + right


def test_segments_equal_definition():
    rng = random.Random(5)
    for _ in range(150):
        scores = [rng.choice([-1, 1]) * rng.random() for _ in range(rng.randint(0, 14))]
        got = toxicity.segments([(k, k + 1, v) for k, v in enumerate(scores)])
        want = brute_segments(scores)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
        assert all(abs(x[2] - y[2]) < 1e-9 for x, y in zip(got, want))


def test_chance_rate_solves_its_equation():
    import numpy as np
    v, w = np.array([-1.0, 2.0]), np.array([9.0, 1.0])
    rate = toxicity.chance_rate(v, w)
    assert abs((w / w.sum() * np.exp(rate * v)).sum() - 1) < 1e-6


@pytest.fixture(scope="module")
def model(spark):
    labels = spark.read.parquet(f"{DATA}/labels.parquet").where(fold("doc_id", 5) != 0)
    return toxicity.fit(spark.read.parquet(f"{DATA}/documents.parquet"), labels)


def test_held_out_rows(spark, model):
    labels = spark.read.parquet(f"{DATA}/labels.parquet").where(fold("doc_id", 5) == 0).select("doc_id", F.col("toxic").alias("y"))
    docs = spark.read.parquet(f"{DATA}/documents.parquet").join(labels, "doc_id")
    seen = toxicity.score(docs, model).select("y", "toxicity.score").collect()
    hit = sum(r.y == 1 and r.score >= 0.5 for r in seen)
    wrong = sum(r.y == 0 and r.score >= 0.5 for r in seen)
    assert hit / sum(r.y == 1 for r in seen) > 0.85 and wrong / sum(r.y == 0 for r in seen) < 0.02


def test_passage_is_located(make_docs, model):
    text = "on the " * 300 + "idiot moron scum loser " + "on the " * 300
    got = toxicity.score(make_docs([text]), model).select("toxicity.*").first()
    assert got.toxic and [(s.start, s.stop) for s in got.segments] == [(600, 604)]


def test_odd_texts(make_docs, model):
    docs = make_docs([None, "", "fine words here", "fine words here", "idiot " * 30000], [1, 2, 3, 3, None]).withColumn("toxicity", F.lit(1))
    got = {r.doc_id: r for r in toxicity.score(docs, model).select("doc_id", "toxicity.*").collect()}
    assert all(not got[i].toxic and got[i].segments == [] and 0 < got[i].score < 0.5 for i in (1, 2, 3)) and got[None].toxic
    kept = toxicity.keep_clean(docs, model)
    assert kept.columns == docs.columns and kept.count() == 4


def test_no_labels(spark, make_docs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit(make_docs(["a b"]), none)
    assert toxicity.score(make_docs(["a b", None]), model).where("toxicity.toxic").count() == 0
    one_kind = spark.createDataFrame([(0, 1), (None, 0), (1, None)], "doc_id long, toxic int")
    assert toxicity.fit(make_docs(["a b", "c"]), one_kind).counts == {}
