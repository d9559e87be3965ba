"""Documents to silver tables: JSON edge cases, identity override, incremental loads."""

import json

import pytest
from match_rows import rows

from matchlake.operators.literals import values
from matchlake.plans import silver
from matchlake.sources import landing


def docs(spark, bodies, season=2024, ts="2024-05-01 10:00:00"):
    data = [(i, b if isinstance(b, str) else json.dumps(b), season, ts) for i, b in bodies]
    df = spark.createDataFrame(data, "id bigint, raw_json string, _season_id int, t string")
    return df.selectExpr("id", "raw_json", "_season_id", "CAST(NULL AS DATE) AS _fixture_date", "CAST(t AS TIMESTAMP) AS _ingested_at")


def test_every_model_is_listed_once():
    assert len(silver.MODELS) == 36


def test_array_edge_cases(spark):
    d = docs(spark, [(1, {"events": []}), (2, {}), (3, '{"events": null}'), (4, {"events": [
        {"id": 7, "minute": 90, "extra_minute": 3, "type": {"developer_name": "GOAL"}}, {"id": 8, "rescinded": True}]})])
    got = silver.build("fixture_events", d).select("id", "fixture_id", "minute", "extra_minute", "type_developer_name", "rescinded")
    assert rows(got) == [(7, 4, 90, 3, "GOAL", None), (8, 4, None, None, None, True)]


def test_statistic_values(spark):
    d = docs(spark, [(1, {"lineups": [{"details": [{"id": i, "type_id": 52, "data": {"value": v}} for i, v in enumerate(
        [True, False, "true", "abc", "7.5", 3])] + [{"id": 9, "type_id": 52}]}, {"details": []}, {}]})])
    got = silver.build("fixture_lineup_details", d).select("id", "value")
    assert rows(got) == [(0, 1.0), (1, 0.0), (2, 1.0), (3, None), (4, 7.5), (5, 3.0), (9, None)]


def test_only_real_weather_objects(spark):
    d = docs(spark, [(1, '{"weatherreport": null}'), (2, {}), (3, {"weatherreport": {"id": 5, "temperature": {"day": 11.5}}})])
    assert rows(silver.build("fixture_weather", d).select("fixture_id", "id", "temp_day")) == [(3, 5, 11.5)]


def test_fixture_without_season_is_dropped(spark):
    d = docs(spark, [(1, {"season_id": 3, "starting_at": "2024-07-01 23:30:00", "venue": {"name": "A"}}), (2, {"name": "x"})])
    got = silver.build("fixtures", d).selectExpr("id", "season_id", "CAST(starting_at AS STRING)", "venue_name")
    assert rows(got) == [(1, 3, "2024-07-01 23:30:00", "A")]


def test_referee_identity(spark):
    alias = values(spark, "referee_id bigint, canonical_referee_id bigint", [(16, 1)])
    d = docs(spark, [(9, {"referees": [{"id": 1, "referee_id": 16, "type_id": 6}, {"id": 2, "referee_id": 4, "type_id": 6}]})])
    assert rows(silver.build("fixture_referees", d, alias).select("id", "referee_id")) == [(1, 1), (2, 4)]
    assert rows(silver.build("referees", docs(spark, [(16, {}), (1, {})]), alias).select("id")) == [(1,)]


def test_standings_pivot(spark):
    d = docs(spark, [(1, {"participant_id": 8, "participant": {"name": "T"}, "details": [
        {"type_id": 129, "value": 3}, {"type_id": 130, "value": "2"}, {"type_id": 176, "value": "W2"}]}), (2, {"details": []})])
    got = silver.build("standings", d).select("id", "team_id", "team_name", "overall_played", "overall_won", "overall_draw", "streak")
    assert rows(got) == [(1, 8, "T", 3, 2, None, "W2")]


def test_parse_once_equals_single_builds(spark):
    d = docs(spark, [(1, {"season_id": 1, "scores": [{"id": 1, "participant_id": 2, "score": {"goals": 3}}],
                          "participants": [{"id": 2, "name": "A", "meta": {"location": "home"}}]})])
    names = ["fixtures", "fixture_scores", "fixture_participants"]
    for name, df in silver.build_all(d, names).items():
        assert rows(df) == rows(silver.build(name, d))


def test_incremental_refresh(spark):
    first = docs(spark, [(1, {"name": "a"}), (2, {"name": "b"})])
    target = silver.refresh("states", None, first)
    later = first.unionByName(docs(spark, [(2, {"name": "B"}), (3, {"name": "c"})], ts="2024-05-02 10:00:00"))
    once = silver.refresh("states", target, later).select("id", "name")
    assert rows(once) == [(1, "a"), (2, "B"), (3, "c")]
    again = silver.refresh("states", silver.refresh("states", target, later), later).select("id", "name")
    assert rows(again) == rows(once)


def test_season_bootstrap(spark):
    s = lambda i, y, cur=None: {"id": i, "name": f"{y}/{y + 1}", "starting_at": f"{y}-07-01", "ending_at": f"{y + 1}-05-31",
                                **({} if cur is None else {"is_current": cur})}
    d = docs(spark, [(1, {"seasons": [s(1, 2009, True), s(2, 2012), s(3, 2011)]}), (2, {"seasons": [s(4, 2020, True), s(5, 2021, False)]})])
    got = landing.bootstrap_seasons(d).select("league_id", "id", "current")
    assert rows(got) == [(1, 2, True), (1, 3, False), (2, 4, True), (2, 5, False)]


def test_manifest():
    landing.validate_manifest()
    assert len(landing.MANIFEST) == 21 and {e.scope for e in landing.MANIFEST} == landing.SCOPES
    with pytest.raises(ValueError):
        landing.validate_manifest([landing.Entry("x", "/x", "pair", "global")])
    with pytest.raises(ValueError):
        landing.load_window("daily", None)
