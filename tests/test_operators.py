"""Operators against brute force on small frames, including hot keys."""

import random

import pytest
from match_rows import rows
from pyspark.sql import functions as F

from matchlake.functions import columns as C
from matchlake.operators import intervals, keys, quality, ranking, shape, upsert
from matchlake.operators.literals import values
from matchlake.operators.prefix import prefix_sum


def frame(spark, ddl, data):
    return spark.createDataFrame(data, ddl)


def test_casts(spark):
    df = frame(spark, "t string, d double", [("3.7", 2.5), ("2.5", 3.5), ("12", -2.5), ("abc", None), (None, 0.5)])
    got = [tuple(r) for r in df.select(C.int_from_text(F.col("t")), C.int_from_double(F.col("d"))).collect()]
    assert got == [(4, 2), (3, 4), (12, -2), (None, None), (None, 0)]
    stats = frame(spark, "v string", [("true",), ("false",), ("abc",), ("7.5",), (None,)])
    assert [r[0] for r in stats.select(C.stat_value(F.col("v"))).collect()] == [1.0, 0.0, None, 7.5, None]


def test_rounding_follows_binary_value(spark):
    df = frame(spark, "x double", [(0.145,), (0.125,), (2.5,)])
    assert [r[0] for r in df.select(C.rounded(F.col("x"), 2)).collect()] == [0.14, 0.13, 2.5]


def test_rates(spark):
    df = frame(spark, "a int, b int", [(1, 3), (5, 0), (None, 2)])
    assert [r[0] for r in df.select(C.percent(F.col("a"), F.col("b"))).collect()] == [33.3, None, None]


@pytest.mark.parametrize("bits", [0, 2, 16])
def test_prefix_sum(spark, bits):
    random.seed(1)
    data = [(random.choice("ab"), k) for k in random.sample(range(-50, 200), 80)]
    df = frame(spark, "g string, k bigint", data)
    got = {(r.g, r.k): r.s for r in prefix_sum(df, "k", F.lit(1), "s", ["g"], bits=bits).collect()}
    assert got == {(g, k): sum(1 for g2, k2 in data if g2 == g and k2 <= k) for g, k in data}


def test_dense_number_crosses_buckets(spark):
    ids = [3, 2 ** 20 + 5, 2 ** 20 + 4, 2 ** 41, -7, 2 ** 62]
    df = frame(spark, "k bigint", [(i,) for i in ids])
    got = {r.k: r.n for r in keys.dense_number(df, "k", "n", 10).collect()}
    assert got == {k: 11 + i for i, k in enumerate(sorted(ids))}


def test_merge_keeps_keys_and_unseen_rows(spark):
    first = keys.merge_scd1(None, frame(spark, "id bigint, name string", [(5, "a"), (9, "b"), (7, "c")]), "id", "sk", ["name"])
    assert rows(first) == [(1, 5, "a"), (2, 7, "c"), (3, 9, "b")]
    load = frame(spark, "id bigint, name string", [(9, "B"), (6, "new"), (5, "a")])
    with_gaps = keys.merge_scd1(first, load, "id", "sk", ["name"])
    assert rows(with_gaps) == [(1, 5, "a"), (2, 7, "c"), (3, 9, "B"), (5, 6, "new")]
    dense = keys.merge_scd1(first, load, "id", "sk", ["name"], dense=True)
    assert rows(dense) == [(1, 5, "a"), (2, 7, "c"), (3, 9, "B"), (4, 6, "new")]
    nothing = keys.merge_scd1(first, load.limit(0), "id", "sk", ["name"])
    assert rows(nothing) == rows(first)


def test_merge_overwrites_with_null(spark):
    old = frame(spark, "sk bigint, id bigint, name string", [(1, 5, "a"), (-1, None, "Unknown")])
    got = keys.merge_scd1(old, frame(spark, "id bigint, name string", [(5, None)]), "id", "sk", ["name"])
    assert rows(got) == [(1, 5, None)]


def test_sentinels(spark):
    dim = frame(spark, "sk bigint, name string", [(1, "x"), (-1, "old")])
    special = [{"sk": -1, "name": "Unknown"}, {"sk": -2, "name": "N/A"}]
    assert rows(keys.with_sentinels(dim, "sk", special)) == [(-1, "Unknown"), (-2, "N/A"), (1, "x")]
    assert rows(keys.with_sentinels(dim, "sk", special, keep_existing=True)) == [(-1, "old"), (-2, "N/A"), (1, "x")]


def test_foreign_keys(spark):
    fact = frame(spark, "k bigint, v int", [(1, 10), (2, 20), (None, 30)])
    dim = frame(spark, "id bigint, sk bigint", [(1, 100), (None, -1)])
    assert rows(keys.resolve_fk(fact, dim, "k", "id", "sk")) == [(None, 30, -1), (1, 10, 100), (2, 20, -1)]


def test_latest_per_key_nulls_last(spark):
    df = frame(spark, "k int, t int, v string", [(1, None, "n"), (1, 3, "x"), (1, 3, "y"), (2, None, "only")])
    assert rows(keys.latest_per_key(df, ["k"], ["t", "v"])) == [(1, 3, "y"), (2, None, "only")]
    assert rows(upsert.first_seen(df.filter("t IS NOT NULL"), "k", ["t", "v"])) == [(1, 3, "x")]


def test_overlay_and_alias(spark):
    df = frame(spark, "id bigint, name string", [(1, "a"), (2, "b")])
    seed = frame(spark, "id bigint, shown string, code string", [(2, "B", "BB")])
    assert rows(keys.overlay(df, seed, "id", {"name": "shown", "code": "code"})) == [(1, "a", None), (2, "B", "BB")]
    alias = frame(spark, "a bigint, c bigint", [(1, 9)])
    assert rows(keys.canonical_id(df, alias, "id", "a", "c").select("id", "name")) == [(2, "b"), (9, "a")]


def test_fallback(spark):
    master = frame(spark, "id bigint, name string", [(1, "a")])
    other = frame(spark, "id bigint", [(1,), (2,), (None,)])
    assert rows(keys.with_fallback(master, other, "id")) == [(1, "a"), (2, None)]


def test_delete_insert_keeps_batch_duplicates(spark):
    target = frame(spark, "k int, v string", [(1, "old"), (2, "keep"), (None, "null")])
    batch = frame(spark, "k int, v string", [(1, "new"), (1, "new2"), (3, "add")])
    assert rows(upsert.delete_insert(target, batch, "k")) == [
        (None, "null"), (1, "new"), (1, "new2"), (2, "keep"), (3, "add")]
    assert rows(upsert.delete_insert(target, batch.limit(0), "k")) == rows(target)


def test_high_water_of_empty_target(spark):
    docs = frame(spark, "id int, ts int", [(1, 1), (2, 5)])
    assert rows(upsert.since_high_water(docs, docs.filter("id = 1"), "ts")) == [(2, 5)]
    assert rows(upsert.since_high_water(docs, docs.limit(0), "ts")) == [(1, 1), (2, 5)]


def test_pair_opponents(spark):
    df = frame(spark, "m int, side string, team int", [(1, "home", 5), (1, "away", 6), (2, "home", 7)])
    assert rows(shape.pair_opponents(df, "m", "side", ["team"])) == [(1, "away", 6, 5), (1, "home", 5, 6)]


def test_pivot_default_clamps_negative(spark):
    df = frame(spark, "k int, c int, v double", [(1, 7, -3.0), (1, 8, 2.0), (2, 8, 1.0)])
    assert rows(shape.eav_pivot(df, ["k"], "c", "v", {7: "a", 8: "b"}, default=0.0)) == [(1, 0.0, 2.0), (2, 0.0, 1.0)]
    assert rows(shape.eav_pivot(df, ["k"], "c", "v", {7: "a"})) == [(1, -3.0), (2, None)]


def test_running_total_shares_peers(spark):
    df = frame(spark, "p string, o int, v int", [("a", 1, 5), ("a", 1, 7), ("a", 2, 1), ("b", None, 4)])
    assert rows(ranking.running_total(df, ["p"], "o", {"t": F.col("v")})) == [
        ("a", 1, 5, 12), ("a", 1, 7, 12), ("a", 2, 1, 13), ("b", None, 4, 4)]


@pytest.mark.parametrize("hot", [0.0, 0.5])
def test_pct_rank(spark, hot):
    random.seed(2)
    data = [(i, None if i % 9 == 0 else (1.0 if random.random() < hot else float(random.randint(0, 30)))) for i in range(300)]
    df = frame(spark, "id int, x double", data)
    sort = lambda desc: {v: i for i, v in reversed(list(enumerate(sorted(
        (v for _, v in data), key=lambda v: (v is None, -v if desc and v is not None else v or 0)))))}
    up, down = sort(False), sort(True)
    got = {r.id: (r.x_pct, r.y_pct) for r in ranking.pct_rank(
        df.withColumn("y", F.col("x")), "id", {"x": "asc", "y": "desc"}, buckets=7).collect()}
    assert got == {i: (up[v] / 299, down[v] / 299) for i, v in data}
    one = df.filter("id = 13")
    assert ranking.pct_rank_of(df, one, {"x": "asc"}).first()[0] == up[data[13][1]] / 299


def test_pct_rank_of_single_row(spark):
    df = frame(spark, "id int, x double", [(1, 5.0)])
    assert rows(ranking.pct_rank(df, "id", {"x": "asc"})) == [(1, 0.0)]


@pytest.mark.parametrize("bits", [1, 16])
def test_count_in_interval_hot_key(spark, bits):
    random.seed(3)
    key = lambda: "hot" if random.random() < 0.6 else random.choice("abc")
    ev = [(key(), random.randint(0, 40)) for _ in range(150)]
    probes = [(i, key(), random.randint(0, 40), random.randint(0, 45)) for i in range(80)]
    got = {r.id: r.n for r in intervals.count_in_interval(
        frame(spark, "id int, k string, lo bigint, hi bigint", probes), frame(spark, "k string, t bigint", ev), ["k"], "t",
        "lo", "hi", "n", bits=bits).collect()}
    assert got == {i: sum(1 for k2, t in ev if k2 == k and lo < t <= hi) for i, k, lo, hi in probes}


def test_date_chunks(spark):
    df = spark.sql("SELECT DATE '2024-01-01' AS a, DATE '2024-01-10' AS b")
    got = [(str(r.from_date), str(r.to_date)) for r in intervals.date_chunks(df, "a", "b", 4).collect()]
    assert got == [("2024-01-01", "2024-01-04"), ("2024-01-05", "2024-01-08"), ("2024-01-09", "2024-01-10")]


def test_top_n_and_dominant(spark):
    df = frame(spark, "k string, v string", [("x", "b"), ("x", "a"), ("x", "a"), ("y", "d"), ("y", "c"), ("z", None)])
    assert rows(shape.dominant_value(df, "k", "v", "m")) == [("x", "a"), ("y", "c")]
    nums = frame(spark, "n int", [(3,), (9,), (None,), (5,)])
    assert [tuple(r) for r in ranking.top_n(nums, 2, [F.col("n").desc_nulls_last()], "r").collect()] == [(9, 1), (5, 2)]


def test_values_quotes(spark):
    assert rows(values(spark, "a string, b int", [("it's \\", None), (None, 2)])) == [(None, 2), ("it's \\", None)]


def test_quality_checks_fire(spark):
    df = frame(spark, "k int, v int, g string", [(1, -1, "a"), (1, 5, "b"), (2, None, "z"), (None, 200, "a")])
    assert rows(quality.not_null(df, "v")) == [(2, None, "z")]
    assert rows(quality.unique(df, "k")) == [(1, 2)]
    assert rows(quality.accepted_values(df, "g", ["a", "b"])) == [("z", 1)]
    assert rows(quality.rows_per_key(df, "k", 1)) == [(1, 2)]
    assert rows(quality.missing_in(df, frame(spark, "k int", [(1,), (None,)]), "k")) == [(None, 200, "a"), (2, None, "z")]
    assert rows(quality.relationships(df, "k", frame(spark, "id int", [(1,)]), "id")) == [(2, 1)]
    assert rows(quality.negative(df, ["k"], ["v"])) == [(1, "v")]
    assert rows(quality.outside(df, "v", 0, 120)) == [(None, 200, "a"), (1, -1, "a")]
    assert rows(quality.too_few({"t": (df, None, 10), "u": (df, None, 1)})) == [("t", 4, 10)]
    got = rows(quality.summary([quality.Check("a", df.filter("k = 2"), "warn"), quality.Check("b", df.limit(0))]))
    assert got == [("a", "warn", 1, "warn"), ("b", "error", 0, "pass")]
