import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlake.llm import hard_negatives as hn

ROWS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("label", T.IntegerType()),
                     T.StructField("embedding", T.ArrayType(T.DoubleType())), T.StructField("list", T.StringType())])


def brute(rows, anchor, positives=5, negatives=3):
    """Every score of every anchor, in Python integers."""
    seen = {(i, g, tuple(math.floor(256 * x) for x in v)) for i, g, v in rows
            if i is not None and g is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for i, g, v in seen:
        if not anchor(i):
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, h) for j, h, w in seen if j != i and len(w) == len(v))
        for s, j, _ in [x for x in scored if x[2] == g][:positives]:
            hard = [x for x in scored if x[2] != g and 50 * -s <= 100 * -x[0] <= 95 * -s][:negatives]
            out += [(i, j, k + 1, n, -s, -t) for k, (t, n, _) in enumerate(hard)]
    return sorted(out)


def mined(spark, rows, every=5, parts=3, **more):
    df = spark.createDataFrame([(*r, "x") for r in rows], ROWS).repartition(parts)
    return sorted(tuple(r) for r in hn.mine(df, F.pmod("vec_id", F.lit(every)) == 0, **more).collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_all_scores(spark, seed):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(6, 12))
    rows = [(i, int(rng.integers(3)), (middle[i % 6] + rng.normal(size=12) * rng.choice([0.1, 0.6])).tolist()) for i in range(300)]
    rows += [(300 + i, i % 3, rows[7][2]) for i in range(120)]  # one vector on many rows, under all labels
    want = brute(rows, lambda i: i % 5 == 0)
    assert len(want) > 300 and mined(spark, rows) == want


def test_rows_that_take_no_part(spark):
    random.seed(3)
    rows = [(i, i % 2, [random.uniform(-1, 1) for _ in range(4)]) for i in range(40)]
    rows += [(100, 0, None), (105, None, [1.0] * 4), (110, 0, [1.0, None, 1.0, 1.0]), (115, 1, [math.nan, 1.0, 1.0, 1.0]),
             (120, 0, [math.inf, 0.0, 0.0, 0.0]), (None, 0, [1.0] * 4)]
    rows += [(200, 0, [0.0] * 4), (205, 1, []), (206, 1, []), (210, 0, [1.0] * 3), (211, 0, [2.0] * 3), (212, 1, [1.2] * 3)]
    rows += rows[:10] + [(0, 1, [0.5] * 4)]  # repeated rows, and one id on two rows
    assert mined(spark, rows) == brute(rows, lambda i: i % 5 == 0)


def test_large_components(spark):
    rng = np.random.default_rng(5)
    rows = [(i, i % 2, (rng.normal(size=3) * 10.0 ** rng.integers(0, 7)).tolist()) for i in range(60)]
    assert mined(spark, rows) == brute(rows, lambda i: i % 5 == 0)


def test_empty_and_alone(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(5, 1, [1.0])]) == []
    assert mined(spark, [(1, 1, [1.0]), (2, 2, [1.0])]) == []


def test_walk_certifies():
    """No row behind a step scores more than the step's bound says."""
    rng = np.random.default_rng(8)
    vectors = np.floor(rng.normal(size=(5000, 16)) * 100).astype(np.int64)
    anchors = vectors[:40] + np.floor(rng.normal(size=(40, 16)) * 3).astype(np.int64)
    anchors = anchors[np.argsort(-(anchors @ anchors[0]))[:6]]
    rows = np.arange(5000), np.zeros(5000, dtype=np.int32), vectors, hn.norms(vectors)
    scores, left = anchors @ vectors.T, np.ones(5000, dtype=bool)
    for part, bound in hn.walk(anchors, rows):
        assert (scores[:, left].max(axis=1) <= bound * hn.norms(anchors)).all()
        left[part] = False
    assert not left.any()
