"""The 36 silver tables: field lists and the load itself.

Field names, JSON paths and types are fixed values of the document feed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import codes
from ..operators.flatten import Model, flatten, flatten_parsed, parse_documents
from ..operators.keys import canonical_id
from ..operators.shape import eav_pivot
from ..operators.upsert import delete_insert, since_high_water

_ID = "id=@id:bigint "
_FIXTURE = "fixture_id=@id:bigint"

MODELS: dict[str, Model] = {
    "core_continents": Model("core_continents", ("id",), _ID + "name:string code:string"),
    "core_countries": Model("core_countries", ("id",), _ID + (
        "continent_id:int name:string official_name:string fifa_name:string iso2:string iso3:string "
        "flag_image_path=image_path:string")),
    "core_regions": Model("core_regions", ("id",), _ID + "country_id:int name:string"),
    "league": Model("league", ("id",), _ID + (
        "sport_id:int country_id:int name:string short_code:string type:string sub_type:string active:boolean "
        "category:int has_jerseys:boolean last_played_at:timestamp image_path:string")),
    "seasons": Model("seasons", ("id",), _ID + (
        "league_id:int tie_breaker_rule_id:int name:string finished:boolean pending:boolean is_current:boolean "
        "starting_at:date ending_at:date games_in_current_week:boolean")),
    "stages": Model("stages", ("id",), _ID + (
        "league_id:int season_id:int type_id:int tie_breaker_rule_id:int name:string sort_order:int finished:boolean "
        "is_current:boolean starting_at:date ending_at:date games_in_current_week:boolean type_name=type.name:string "
        "type_developer_name=type.developer_name:string")),
    "rounds": Model("rounds", ("id",), _ID + (
        "league_id:int season_id:int stage_id:int name:string finished:boolean is_current:boolean starting_at:date "
        "ending_at:date games_in_current_week:boolean")),
    "states": Model("states", ("id",), _ID + (
        "state_code=state:string name:string short_name:string developer_name:string")),
    "types": Model("types", ("id",), _ID + (
        "name:string code:string developer_name:string model_type:string stat_group:string")),
    "tv_stations": Model("tv_stations", ("id",), _ID + (
        "name:string url:string image_path:string type:string related_id:int")),
    "teams": Model("teams", ("id",), _ID + (
        "country_id:int venue_id:int name:string short_code:string gender:string type:string founded:int "
        "placeholder:boolean last_played_at:timestamp image_path:string country_name=country.name:string "
        "venue_name=venue.name:string venue_city=venue.city_name:string venue_capacity=venue.capacity:int "
        "_season_id=@_season_id:int")),
    "venues": Model("venues", ("id",), _ID + (
        "country_id:int city_id:int name:string address:string zipcode:string city_name:string surface:string "
        "capacity:int latitude:double longitude:double national_team:boolean image_path:string "
        "country_name=country.name:string")),
    "players": Model("players", ("id",), _ID + (
        "sport_id:int country_id:int nationality_id:int city_id:int position_id:int detailed_position_id:int "
        "type_id:int common_name:string firstname:string lastname:string name:string display_name:string "
        "gender:string date_of_birth:date height:int weight:int image_path:string country_name=country.name:string "
        "country_iso2=country.iso2:string nationality_name=nationality.name:string city_name=city.name:string "
        "position_name=position.name:string position_code=position.code:string "
        "position_developer_name=position.developer_name:string "
        "detailed_position_name=detailedposition.name:string detailed_position_code=detailedposition.code:string")),
    "referees": Model("referees", ("id",), _ID + (
        "country_id:int city_id:int common_name:string firstname:string lastname:string display_name:string "
        "gender:string height:int weight:int date_of_birth:date country_name=country.name:string "
        "country_iso2=country.iso2:string country_fifa_name=country.fifa_name:string image_path:string "
        "nationality_name=nationality.name:string city_name=city.name:string")),
    "rivals": Model("rivals", ("id",), _ID + (
        "team_id:int rival_id:int sport_id:int team_name=team.name:string team_image_path=team.image_path:string "
        "rival_name=rival.name:string rival_image_path=rival.image_path:string")),
    "round_statistics": Model("round_statistics", ("id",), _ID + (
        "round_id=model_id:int type_id:int relation_id:int value:string stat_name=type.name:string "
        "stat_code=type.code:string stat_group=type.stat_group:string")),
    "stage_statistics": Model("stage_statistics", ("id",), _ID + (
        "stage_id=model_id:int type_id:int relation_id:int value:string stat_name=type.name:string "
        "stat_code=type.code:string stat_group=type.stat_group:string")),
    "topscorers": Model("topscorers", ("id",), _ID + (
        "season_id:int player_id:int type_id:int team_id=participant_id:int position:int total:int "
        "player_common_name=player.common_name:string player_display_name=player.display_name:string "
        "player_image_path=player.image_path:string team_name=participant.name:string stat_name=type.name:string "
        "stat_code=type.code:string season_name=season.name:string")),
    "stage_topscorers": Model("stage_topscorers", ("id",), _ID + (
        "stage_id:int player_id:int type_id:int team_id=participant_id:int participant_type:string position:int "
        "total:int player_common_name=player.common_name:string player_display_name=player.display_name:string "
        "player_image_path=player.image_path:string team_name=participant.name:string stat_name=type.name:string "
        "stat_code=type.code:string season_id=season.id:int season_name=season.name:string")),
    "fixtures": Model("fixtures", ("id",), _ID + (
        "league_id:int season_id:int stage_id:int round_id:int group_id:int aggregate_id:int venue_id:int state_id:int "
        "name:string starting_at:timestamp starting_at_timestamp:bigint result_info:string leg:string length:int "
        "placeholder:boolean has_odds:boolean venue_name=venue.name:string venue_city=venue.city_name:string "
        "venue_surface=venue.surface:string venue_capacity=venue.capacity:int state_name=state.name:string "
        "state_short_name=state.short_name:string state_developer_name=state.developer_name:string "
        "round_name=round.name:string round_finished=round.finished:boolean "
        "round_is_current=round.is_current:boolean _fixture_date=@_fixture_date:date"), required="season_id"),
    "fixture_weather": Model("fixtures", ("fixture_id",), (
        "id=weatherreport.id:int venue_id=weatherreport.venue_id:int temp_day=weatherreport.temperature.day:double "
        "temp_current=weatherreport.current.temp:double feels_like=weatherreport.current.feels_like:double "
        "wind_speed=weatherreport.wind.speed:double wind_direction=weatherreport.wind.direction:int "
        "humidity=weatherreport.humidity:string pressure=weatherreport.pressure:int clouds=weatherreport.clouds:string "
        "description=weatherreport.description:string metric=weatherreport.metric:string"),
        _FIXTURE, required="weatherreport"),
    "fixture_coaches": Model("fixtures", ("coach_id", "fixture_id"), (
        "coach_id=id:int team_id=meta.participant_id:int common_name:string display_name:string firstname:string "
        "lastname:string country_id:int nationality_id:int image_path:string"), _FIXTURE, ("coaches",)),
    "fixture_events": Model("fixtures", ("id",), (
        "id:int period_id:int team_id=participant_id:int type_id:int player_id:int related_player_id:int "
        "player_name:string related_player_name:string section:string result:string info:string addition:string "
        "minute:int extra_minute:int injured:boolean on_bench:boolean sub_type_id:int sort_order:int "
        "rescinded:boolean type_name=type.name:string type_developer_name=type.developer_name:string "
        "team_name=participant.name:string"), _FIXTURE, ("events",)),
    "fixture_formations": Model("fixtures", ("id",), (
        "id:int team_id=participant_id:int formation:string location:string"), _FIXTURE, ("formations",)),
    "fixture_lineups": Model("fixtures", ("id",), (
        "id:bigint player_id:int team_id:int position_id:int type_id:int player_name:string jersey_number:int "
        "formation_field:string formation_position:int type_name=type.name:string position_name=position.name:string "
        "position_code=position.code:string detailed_position_name=detailedposition.name:string"),
        _FIXTURE, ("lineups",)),
    "fixture_lineup_details": Model("fixtures", ("id",), (
        "id:bigint player_id:int team_id:int lineup_id:bigint type_id:int value=data.value:stat"),
        _FIXTURE, ("lineups", "details")),
    "fixture_participants": Model("fixtures", ("fixture_id", "team_id"), (
        "team_id=id:int team_name=name:string team_short_code=short_code:string team_image_path=image_path:string "
        "location=meta.location:string winner=meta.winner:boolean position=meta.position:int"),
        _FIXTURE, ("participants",)),
    "fixture_periods": Model("fixtures", ("id",), (
        "id:int type_id:int description:string sort_order:int started_timestamp=started:bigint "
        "ended_timestamp=ended:bigint counts_from:int period_length:int time_added:int minutes:int seconds:int "
        "ticking:boolean has_timer:boolean"), _FIXTURE, ("periods",)),
    "fixture_referees": Model("fixtures", ("id",), (
        "id:int referee_id:int type_id:int referee_common_name=referee.common_name:string "
        "referee_firstname=referee.firstname:string referee_lastname=referee.lastname:string "
        "referee_name=referee.name:string referee_display_name=referee.display_name:string "
        "referee_image_path=referee.image_path:string"), _FIXTURE, ("referees",)),
    "fixture_scores": Model("fixtures", ("id",), (
        "id:int type_id:int team_id=participant_id:int goals=score.goals:int side=score.participant:string "
        "description:string"), _FIXTURE, ("scores",)),
    "fixture_sidelined": Model("fixtures", ("id",), (
        "id:int team_id=participant_id:int player_id:int type_id:int"), _FIXTURE, ("sidelined",)),
    "fixture_statistics": Model("fixtures", ("id",), (
        "id:int type_id:int team_id=participant_id:int value=data.value:double location:string"),
        _FIXTURE, ("statistics",)),
    "fixture_timeline": Model("fixtures", ("id",), (
        "id:int period_id:int team_id=participant_id:int type_id:int player_id:int addition:string minute:int "
        "extra_minute:int sort_order:int"), _FIXTURE, ("timeline",)),
    "team_coaches": Model("teams", ("id",), (
        "id:int coach_id:int position_id:int active:boolean temporary:boolean start_date=start:date end_date=end:date"),
        "team_id=@id:bigint", ("coaches",)),
    "standing_details": Model("standings", ("detail_id",), (
        "detail_id=id:bigint type_id:int value:double standing_type:string"),
        "standing_id=@id:bigint season_id:int stage_id:int team_id=participant_id:int", ("details",)),
    "standings": Model("standings", ("id",), "type_id:int value:string", (
        "id=@id:bigint team_id=participant_id:int league_id:int season_id:int stage_id:int group_id:int round_id:int "
        "standing_rule_id:int position:int result:string points:int team_name=participant.name:string "
        "team_short_code=participant.short_code:string team_image_path=participant.image_path:string"), ("details",)),
}


def pivot_standings(exploded: DataFrame) -> DataFrame:
    """One row per standing document. Grouping is by id only: every other parent column depends on it."""
    attrs = [name for name, _, _ in MODELS["standings"].columns(MODELS["standings"].parent) if name != "id"]
    as_int = exploded.withColumn("_v", F.round(F.col("value").try_cast("double")).cast("int"))
    return eav_pivot(as_int, ["id"], "type_id", "_v", codes.STANDING_STATS, extra=[
        *[F.max(c).alias(c) for c in attrs],
        F.max(F.when(F.col("type_id") == codes.STREAK_STAT, F.col("value"))).alias("streak"),
        F.max("_ingested_at").alias("_ingested_at")])


def _finish(name: str, flat: DataFrame, aliases: DataFrame | None) -> DataFrame:
    if name == "standings":
        return pivot_standings(flat)
    if name == "fixture_referees" and aliases is not None:
        return canonical_id(flat, aliases, "referee_id", "referee_id", "canonical_referee_id").select(*flat.columns)
    if name == "referees" and aliases is not None:
        return flat.join(aliases.select(F.col("referee_id").alias("id")).distinct(), "id", "left_anti")
    return flat


def build(name: str, docs: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """One silver table from its bronze documents; ``aliases`` is the referee identity seed."""
    return _finish(name, flatten(docs, MODELS[name]), aliases)


def build_all(docs: DataFrame, names: list[str], aliases: DataFrame | None = None) -> dict[str, DataFrame]:
    """Several silver tables of one document type, sharing one parsed relation."""
    parsed = parse_documents(docs, [MODELS[n] for n in names])
    return {n: _finish(n, flatten_parsed(parsed, MODELS[n]), aliases) for n in names}


def refresh(name: str, target: DataFrame | None, docs: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """Incremental load: only documents past the high-water mark are flattened, then upserted by the model key."""
    if target is None:
        return build(name, docs, aliases)
    batch = build(name, since_high_water(docs, target, "_ingested_at"), aliases)
    return delete_insert(target, batch, MODELS[name].key)
