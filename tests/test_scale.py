"""What crosses the network, and how much of it a task holds."""

from __future__ import annotations

import pytest

from matchlake.functions import codes
from matchlake.operators import keys
from matchlake.plans import adapter, facts
from matchlake.plans.adapter import Silver
from matchlake.plans.feed import Feed
from matchlake.sources import storage

SF = "/root/testdata/sf0.001"


def executed(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_documents_cross_the_network_as_orders_and_lines(spark):
    plan = executed(Feed(Silver(spark, SF)).documents("fixtures"))
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_documents_of_repeated_orders_hold_all_their_lists(spark, tmp_path):
    """An order that comes twice lists everything twice, and its lines once for each of them, as a join would."""
    for name in ("orders", "lineitem"):
        rows = spark.read.parquet(f"{SF}/{name}.parquet").filter(f"{name[0]}_orderkey BETWEEN 1 AND 20")
        (rows.union(rows) if name == "orders" else rows).write.parquet(f"{tmp_path}/{name}.parquet")
    once, twice = Silver(spark, SF), Silver(spark, str(tmp_path))
    listed = lambda t: {r.id: tuple(r)[1:] for r in Feed(t).documents("fixtures").filter("id BETWEEN 1 AND 20").selectExpr(
        "id", *[f"size(from_json(get_json_object(raw_json, '$.{n}'), 'array<string>')) AS {n}" for n in ("lineups", "coaches", "events", "scores")]).collect()}
    one, two = listed(once), listed(twice)
    assert one and {k: tuple(2 * n for n in v) for k, v in one.items()} == two


def test_numbered_rows_cross_the_network_once(spark):
    df = spark.range(0, 1000, 1, 7).selectExpr("(id * 37) % 1000 AS k", "repeat('x', 50) AS wide")
    numbered = keys.dense_number(df, "k", "n", 5)
    assert "Window" not in executed(numbered.select("k", "wide", "n")).split("Broadcast")[0]
    assert executed(numbered).count("hashpartitioning(_range") <= 1  # the count of the ranges only
    assert sorted((r.k, r.n) for r in numbered.collect()) == [(k, k + 6) for k in range(1000)]


def test_partitions_grow_with_the_tables(spark, tmp_path, monkeypatch):
    (tmp_path / "orders.parquet").mkdir()
    (tmp_path / "orders.parquet" / "part-0").write_bytes(b"x" * 100)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        monkeypatch.setattr(storage, "DEALT_BYTES", 1)
        storage.fit_partitions(spark, f"{tmp_path}/orders.parquet", f"{tmp_path}/none.parquet")
        assert int(spark.conf.get("spark.sql.shuffle.partitions")) == max(100, int(before))
        monkeypatch.setattr(storage, "DEALT_BYTES", 50)
        storage.fit_partitions(spark, f"{tmp_path}/orders.parquet")  # what the session has more of stays
        assert int(spark.conf.get("spark.sql.shuffle.partitions")) == max(100, int(before))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("text, size", [("128MB", 128 << 20), ("134217728b", 128 << 20), ("16m", 16 << 20), ("5", 5)])
def test_sizes_as_spark_writes_them(text, size):
    assert storage._bytes(text) == size


def test_statistics_are_counted_as_integers_before_they_are_folded(spark):
    """As doubles, each was rounded and cast in the code of a folded row, which the JVM then only interprets."""
    details = spark.createDataFrame([(1, 5, 52, 2.0), (1, 5, 52, 0.5), (1, 5, 119, 90.0), (1, 5, 118, 7.25), (1, 5, 99999, 1e12), (1, 6, 52, -1.0),
                                     (1, 6, 79, None), (1, None, 52, 3.0)], "fixture_id bigint, player_id bigint, type_id int, value double")
    folded = facts.player_statistics(details)
    names = list(codes.PLAYER_STATS.values())
    assert {folded.schema[n].dataType.simpleString() for n in names} == {"int"}
    name = codes.PLAYER_STATS[52]
    got = {r.player_id: r for r in folded.selectExpr("player_id", "minutes", "rating", *facts._COUNTS).collect()}
    assert (got[5].minutes, got[5].rating, got[5][name], got[6].minutes, got[6][name]) == (90, 7.25, 2, None, 0)
    assert sorted(got) == [5, 6] and all(got[6][n] == 0 for n in names)


def test_statistics_of_a_line_are_picked_not_looked_for(spark, tmp_path):
    """The same entries as by looking at every place, also of lines without a player and of negative keys."""
    lines = [(11, 4, 1, 10.0), (12, 8, 5, 21.0), (13, None, 2, 5.0), (-14, 3, 1, 6.0), (711, 1, 3, 30.0), (15, -9, 4, 12.0)]
    spark.createDataFrame(lines, "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")
    made = adapter.Silver(spark, str(tmp_path)).lineup_details()
    assert "Filter" not in made._jdf.queryExecution().optimizedPlan().toString().split("Generate")[0]
    wanted = set()
    for order, part, number, _ in lines:
        wanted |= {(order, part, code) for code in (codes.MINUTES_STAT, codes.RATING_STAT)}
        wanted |= {(order, part, code) for code, i, _ in adapter.stat_rows() if part is not None and (order + part + i) % 4 == 0}
    got = [(r.fixture_id, r.player_id, r.type_id) for r in made.collect()]
    assert len(got) == len(wanted) and set(got) == wanted
    value = {(r.fixture_id, r.type_id): r.value for r in made.collect()}
    code, _, modulus = adapter.stat_rows()[0]
    counted = {k: v for k, v in value.items() if k[1] == code}
    assert counted == {(o, code): -1.0 if o % 700 == 11 else float((p * 3 + n + int(q)) % modulus) for o, p, n, q in lines
                       if p is not None and (o + p) % 4 == 0} and len(counted) == 2
