"""Documents to gold, in one run and step by step."""

import os

import pytest
from pyspark.sql import functions as F

from matchlake.plans import facts, marts
from matchlake.plans.adapter import Silver
from matchlake.plans.feed import Feed
from matchlake.plans.lake import DIMENSIONS, FACTS, Lake, StoredSilver, lake
from matchlake.plans.warehouse import warehouse
from matchlake.sources import journal
from matchlake.sources.storage import PLANNED_BROADCAST, write_table
from matchlake.verification.gold_queries import CUT, Earlier

SF = "/root/testdata/sf0.001"


def same(a, b):
    assert sorted(a.columns) == sorted(b.columns)
    a = a.select(*b.columns)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def files(path):
    return {os.path.relpath(os.path.join(d, f), path) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_documents_give_what_the_tables_give(spark):
    built, direct = lake(spark, SF), Silver(spark, SF)
    for name in ("fixtures", "scores", "match_referees", "coaches", "lineups", "events", "players", "referees", "stages"):
        same(StoredSilver(built).view(name), getattr(direct, name)())
    wanted = direct._matches().select(F.col("o_orderkey").alias("fixture_id"))
    same(StoredSilver(built).lineup_details(), direct.lineup_details().join(wanted, "fixture_id", "left_semi"))
    star = warehouse(spark, SF)
    for name in ("dim_match", "dim_player", "fct_team_matches", "fct_player_appearances"):
        same(built.get(name), star.get(name))


def test_refresh_visits_what_is_behind(spark):
    built = lake(spark, SF)
    assert built.refresh() == []
    built.land("venues", Feed(built.seeds).documents("venues").limit(0))  # landed again without anything new
    assert built.refresh() == ["venues", "dim_stadium", "mart_match_facts", "mart_player_facts"]


class Seeds(Silver):
    """The tables with one more correction of a score, once somebody has entered it."""
    more = False

    def score_corrections(self):
        rows = super().score_corrections()
        extra = self._teams_of(where="o_orderkey = 7").filter("side_no = 0").selectExpr("fixture_id", "team_id", "9 AS goals_scored_corrected")
        return rows.unionByName(extra) if self.more else rows


def natural(built, fact):
    """A fact under the ids of matches and players: keys of later members depend on when they came."""
    df = built.get(fact).join(built.get("dim_match").select("match_sk", "match_id"), "match_sk").drop("match_sk")
    if "player_sk" in df.columns:
        df = df.join(built.get("dim_player").select("player_sk", "player_id"), "player_sk").drop("player_sk")
    return df


def test_steps_equal_a_rebuild_and_leave_the_rest_alone(spark, tmp_path):
    seeds = Seeds(spark, SF)
    known, feed, before = Lake(spark, str(tmp_path / "lake"), seeds), Feed(seeds), Feed(Earlier(spark, SF))
    for kind in Feed.KINDS:
        docs = before.documents(kind)
        if kind == "fixtures":
            docs = docs.withColumn("_ingested_at", F.least("_ingested_at", F.expr(f"TIMESTAMP_NTZ'{CUT}' - INTERVAL 1 HOUR")))
        known.land(kind, docs)
    known.refresh(extracts=False)
    paths = {n: known.path(*n) for n in (("silver", "fixture_lineups"), ("silver", "fixture_events"), ("gold", "fct_player_appearances"))}
    old = {n: files(p) for n, p in paths.items()}
    keys = known.get("dim_player").filter("player_sk > 0").collect()
    known.land("fixtures", feed.documents("fixtures").filter(f"_ingested_at >= TIMESTAMP_NTZ'{CUT}'"))
    done = known.refresh(extracts=False)
    assert "players" not in done and "dim_team" not in done and {"fixture_events", "dim_match", *FACTS} <= set(done)
    for n, path in paths.items():
        fresh = {f.split("/")[0] for f in files(path) - old[n]}
        assert 0 < len(fresh) < len({f.split("/")[0] for f in files(path)})
        assert all(int(p.split("=")[1]) >= (2025 if n[0] == "silver" else 202506) for p in fresh)
    rebuilt = lake(spark, SF)
    for name in FACTS:
        same(natural(known, name), natural(rebuilt, name))
    same(known.silver("fixture_events"), rebuilt.silver("fixture_events").select(*known.silver("fixture_events").columns))
    after = {r.player_id: r.player_sk for r in known.get("dim_player").collect()}
    assert all(after[r.player_id] == r.player_sk for r in keys)
    # a correction that somebody enters brings its match back
    assert known.changed_matches("fct_team_matches").isEmpty() and known.build_facts() == []
    seeds.more = True
    assert [r[0] for r in known.changed_matches("fct_team_matches").collect()] == [7]
    assert known.build_facts() == list(FACTS) and known.build_facts() == []
    assert 9 in [r.goals_scored for r in natural(known, "fct_team_matches").filter("match_id = 7").collect()]


def test_a_refresh_reads_only_the_seasons_it_needs(spark):
    built = lake(spark, SF)
    some = built.silver("fixtures").filter("season_id = 2020").select(F.col("id").alias("fixture_id"))
    plan = StoredSilver(built, some, [2020]).lineup_details()._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_season_id" in plan or "PartitionFilters: [(_season_id" in plan


@pytest.mark.parametrize("step", ["staged", "journaled", "moved"])
def test_a_lost_refresh_is_taken_up_again(spark, tmp_path, monkeypatch, step):
    seeds = Silver(spark, SF)
    known, feed = Lake(spark, str(tmp_path / "lake"), seeds), Feed(seeds)
    known.land("venues", feed.documents("venues"))
    known.load("venues")

    def lose(done):
        if done == step:
            raise RuntimeError(step)
    known.land("venues", feed.documents("venues").limit(1).withColumn("_ingested_at", F.expr("TIMESTAMP_NTZ'2025-01-01 00:00:00'")))
    monkeypatch.setattr(journal, "watch", lose)
    with pytest.raises(RuntimeError):
        known.load("venues")
    monkeypatch.setattr(journal, "watch", lambda done: None)
    known.load("venues")
    rows = known.silver("venues").collect()
    assert known.load("venues") == [] and len({r.id for r in rows}) == 11 and len(rows) == 21
    assert [r.id for r in rows if str(r._ingested_at).startswith("2025")] != []


def test_documents_are_made_after_their_rows_have_met(spark):
    """What crosses the network are order lines, not line-up entries with their statistics; and it does so once."""
    docs = Feed(Silver(spark, SF)).documents("fixtures")
    plan = docs._jdf.queryExecution().optimizedPlan().toString().split("\n")
    dealt = [i for i, line in enumerate(plan) if "RepartitionByExpression" in line]
    assert len(dealt) == 1 and not any("lineup_id" in line for line in plan[dealt[0]:]) and any("lineup_id" in line for line in plan[:dealt[0]])


def test_parsed_documents_are_not_kept(spark, tmp_path, monkeypatch):
    from matchlake.plans import lake as module
    space = tmp_path / "space"
    monkeypatch.setattr(module, "workspace", lambda spark: str(space))
    tables = Silver(spark, SF)
    built = Lake(spark, str(tmp_path / "lake"), tables)
    built.land("venues", Feed(tables).documents("venues"))
    assert built.load("venues") == ["venues"] and not (space / "parsed").exists()
    same(built.silver("venues").select("id", "name"), tables.venues().select("id", "name"))


def test_season_progress_does_not_deal_wide_rows(spark):
    """The running totals are written down first, so the join with them is planned by their size."""
    plan = warehouse(spark, SF).plan("mart_match_facts")._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "cumulative_points" in plan


def exchanges(df):
    return [line for line in df._jdf.queryExecution().executedPlan().toString().split("\n") if "Exchange hashpartitioning" in line]


def test_statistics_are_folded_where_their_lines_are(spark):
    """Order lines cross the network, and nothing that is made of them."""
    direct = Silver(spark, SF)
    dealt = exchanges(facts.player_statistics(direct.lineup_details()))
    assert len(dealt) == 1 and "l_orderkey" in dealt[0] and "REPARTITION_BY_NUM" in dealt[0]
    dealt = exchanges(warehouse(spark, SF).plan("match_sheet"))
    assert dealt and not any("fixture_id" in line or "stage_id" in line for line in dealt)
    assert not any("season_id" in line for line in exchanges(warehouse(spark, SF).plan("dim_match")))


def test_lookups_do_not_carry_statistics(spark):
    plan = warehouse(spark, SF).plan("fct_player_appearances")._jdf.queryExecution().optimizedPlan().toString().split("\n")
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    folded = next(i for i, line in enumerate(plan) if "Aggregate [" in line and "AS rating" in line)
    above, at = 0, depth(plan[folded])
    for line in reversed(plan[:folded]):
        if depth(line) < at:
            above, at = above + ("Join" in line), depth(line)
    assert above == 1


def test_wide_matches_are_not_dealt_by_team(spark):
    built = warehouse(spark, SF)
    built.dims()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        dealt = exchanges(marts.mart_match_facts(built.get("fct_team_matches"), built.get("fct_player_appearances"), built.dims()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(PLANNED_BROADCAST))
    assert sum("match_sk" in line and "team_sk" in line for line in dealt) == 1


def test_seasons_are_written_side_by_side(spark, tmp_path):
    """Rows are not sorted by season before they are written, so nothing spills for that; and none is lost."""
    rows = spark.range(1000).selectExpr("id", "IF(id % 7 = 6, NULL, id % 7) AS season")
    write_table(rows, str(tmp_path / "t"), ["season"], rebalance=False)
    same(spark.read.schema("id bigint, season bigint").parquet(str(tmp_path / "t")), rows)
    assert int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) == 16
