"""Publish job: metrics tables to nested entity documents and comparison tables."""

from pyspark.sql import functions as F

from ..config import lookups as lk
from ..operators import aggregate as agg, charts, shape, similarity as sim, windows as win
from ..operators.joins import embed
from ..session import job, materialize
from ..sources import sinks
from ..sources.tables import read_table, write_table

# Published profile fields.
MANAGER_FIELDS = ["ID", "Name", "FirstName", "LastName", "Country", "DateBirth", "Team"]
PLAYER_FIELDS = ["ID", "Name", "FirstName", "LastName", "DateBirth", "Country", "Team", "Rating",
                 "Potential", "Height", "PrefFoot", "ShirtNumber", "FirstPos", "SecondPos", "ThirdPos",
                 "Role", "ContractUntil", "MarketValue"]
TEAM_FIELDS = ["ID", "Name", "Abbreviation", "Country", "FoundationDate", "Manager", "EloRating",
               "PrimaryColour", "SecondaryColour", "HomeKitCol1", "HomeKitCol2", "HomeShortsCol",
               "AwayKitCol1", "AwayKitCol2", "AwayShortsCol"]
SQUAD_FIELDS = ["ID", "Name", "Country", "DateBirth", "Height", "PrefFoot", "FirstPos", "Role"]


def profiles(matches, managers, players, teams, season, top=None):
    """Published managers, players and teams with the structs they point to."""
    comps = shape.team_tournaments(shape.season_filter(matches, season), top)
    managers, players = (shape.publish(df, cols, comps) for df, cols in
                         ((managers, MANAGER_FIELDS), (players, PLAYER_FIELDS)))
    teams = shape.publish(teams, TEAM_FIELDS, comps, team="ID")
    team_ref, manager_ref = ["ID", "Name", "Abbreviation"], ["ID", "Name", "Country"]
    return (embed(managers, teams, "Team", [F.col(c) for c in team_ref]),
            embed(players, teams, "Team", [F.col(c) for c in team_ref]),
            embed(teams, managers, "Manager", [F.col(c) for c in manager_ref]).join(
                comps.withColumnRenamed("Team", "ID"), "ID", "left"))


def match_documents(rows, key, info, stats, min_matches=5, allowed=None):
    """One document row per entity and match: info, opponent and the chosen statistics."""
    enough = rows.groupBy(key).agg(F.count("*").alias("_n")).filter(F.col("_n") >= min_matches)
    rows = rows.join(enough.drop("_n"), key, "left_semi")
    values = F.create_map(*[x for c in stats for x in (F.lit(c), F.col(c).cast("double"))])
    if allowed is not None:
        values = F.map_filter(values, lambda k, v: F.array_contains(allowed, k))
    return rows.select(key, F.col("Match").alias("ID"), F.struct(*info).alias("Info"), F.struct(
        "Opponent", F.col("OpponentName").alias("Name"), F.col("OpponentAbb").alias("Abb"),
        F.col("OpponentScore").alias("Score"), F.col("OpponentElo").alias("Elo")).alias("Opponent"),
        values.alias("Stats"))


def match_info(matches, teams, season, leagues=None):
    """Both sides of the season's top-league matches with the opponent's names."""
    leagues = lk.TOP_LEAGUES if leagues is None else leagues
    rows = shape.season_filter(matches, season).filter(F.col("League").isin(leagues))
    names = shape.const_map(lk.LEAGUE_NAMES)
    rows = rows.withColumn("League", F.coalesce(F.try_element_at(names, F.col("League")), F.col("League")))
    rows = shape.to_team_rows(rows, home_elo="HomeElo", away_elo="AwayElo", keep=("League", "Date"))
    opp = teams.select(F.col("ID").alias("Opponent"), F.col("Name").alias("OpponentName"),
                       F.col("Abbreviation").alias("OpponentAbb"))
    return rows.join(opp, "Opponent", "left")


def run_publish(spark, metrics, events, out, season, as_of, slots, coords, position_metrics,
                top_leagues=None, similar=50, min_minutes=500, list_chunk=10_000):
    """Write entity documents, their nested lists and the comparison tables.

    ``position_metrics`` is {position: [metric]}.  Long lists (passes, shots,
    matches) are written as chunk rows next to the profile, so one popular
    entity never becomes one giant row.
    """
    with job(spark, "publish", metrics, events, out, season, as_of, sorted(position_metrics.items()), top_leagues, similar,
             min_minutes, list_chunk):
        return _run(spark, metrics, events, out, season, as_of, slots, coords, position_metrics, top_leagues, similar,
                    min_minutes, list_chunk)


def _run(spark, metrics, events, out, season, as_of, slots, coords, position_metrics, top_leagues, similar, min_minutes,
         list_chunk):
    t = {n: read_table(spark, f"{metrics}/{n}") for n in
         ("manager", "team", "player", "match", "player_stats", "team_stats", "agg_player", "agg_team")}
    season_rows = shape.season_filter(t["match"], season)
    managers, players, teams = profiles(t["match"], t["manager"], t["player"], t["team"], season, top_leagues)
    players, teams = materialize(players, "players"), materialize(teams, "teams")
    agg_player = t["agg_player"].filter("scope = 'season'").drop("scope")
    agg_team = t["agg_team"].filter("scope = 'season'").drop("scope")
    agg_player = materialize(agg_player.join(players.select(F.col("ID").alias("Player")), "Player", "left_semi"), "agg-player")
    agg_team = materialize(agg_team.join(teams.select(F.col("ID").alias("Team")), "Team", "left_semi"), "agg-team")

    # Profiles with statistics.
    numeric = [f.name for f in agg_player.schema.fields
               if f.dataType.typeName() in ("double", "long", "integer") and f.name != "ShirtNumber"]
    counted = [c for c in lk.COUNTED_STATS if c in numeric]
    stat_map = F.create_map(*[x for c in numeric for x in (F.lit(c), F.coalesce(F.col(c).cast("double"), F.lit(0.0)))])
    stats = agg_player.select(F.col("Player").alias("ID"), F.struct(
        *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in counted]).alias("Stats"),
        stat_map.alias("All"))
    player_docs = shape.position_columns(players.join(stats, "ID", "left"), position_metrics)
    player_docs = shape.relevant_stats(player_docs, "Allowed", "All").drop("Allowed", "All")
    team_numeric = [f.name for f in agg_team.schema.fields if f.dataType.typeName() in ("double", "long", "integer")]
    team_map = F.map_filter(F.create_map(*[x for c in team_numeric for x in (F.lit(c), F.col(c).cast("double"))]),
                            lambda k, v: v != 0)
    team_docs = teams.join(agg_team.select(F.col("Team").alias("ID"), team_map.alias("AggregatedStats")), "ID", "left")

    # Nested lists, in bounded chunks.
    def lists(child, key, name, fields, order):
        return agg.collect_nested(child, key, name, fields, order, list_chunk)

    squad = lists(players.withColumn("TeamID", F.col("Team")), "TeamID", "Squad", SQUAD_FIELDS, ["ID"])
    lineup = win.team_lineups(season_rows, t["player"], t["player_stats"].withColumns({
        c: F.col(c) if c in t["player_stats"].columns else F.lit(None).cast("double")
        for c in ("PassMeanX", "PassMeanY")}), t["team_stats"], slots, coords, season)
    lineup = lists(lineup, "Team", "Lineup", ["Player", "Name", "Position", "X", "Y", "PassMeanX", "PassMeanY"],
                   ["slot", "idx"])
    in_season = season_rows.select(F.col("ID").alias("Match"))
    passes = read_table(spark, f"{events}/pass_map").join(in_season, "Match", "left_semi")
    shots = read_table(spark, f"{events}/shot_map").join(in_season, "Match", "left_semi")
    pass_fields, shot_fields = ["IniX", "IniY", "EndX", "EndY"], ["Type", "IniX", "IniY", "BlockX", "BlockY", "GoalY", "GoalZ"]
    place = [F.xxhash64("Match"), "Match", "IniX", "IniY"]
    nested = {
        "team_squad": squad, "team_lineup": lineup,
        "team_passes": lists(passes, "Team", "Passes", [*pass_fields, "Player", "PassReceiver"], place),
        "team_shots": lists(shots, "Team", "Shots", [*shot_fields, "Player"], place),
        "player_passes": lists(passes, "Player", "Passes", [*pass_fields, "PassReceiver"], place),
        "player_shots": lists(shots, "Player", "Shots", shot_fields, place),
    }

    # Similar entities among the published ones.
    context = agg.team_context(shape.to_team_rows(season_rows, home_elo="HomeElo", away_elo="AwayElo"))
    similar_teams = sim.team_similarity(sim.team_features(context, agg_team), similar)
    ref = teams.select(F.col("ID").alias("other"), "Name", "EloRating")
    nested["team_similar"] = lists(similar_teams.join(ref, "other"), "id", "SimilarTeams",
                                   [F.col("num").alias("Num"), F.col("other").alias("Team"), "Name", "EloRating",
                                    F.col("similarity").alias("Similarity")], ["num"])
    base = [c for c in t["player_stats"].columns if c.endswith("Per90") is False]
    features = sim.similarity_features(t["match"], t["player_stats"].select(base), t["player"].join(
        players.select("ID"), "ID", "left_semi"), season, as_of, numeric, min_minutes)
    cols = [c for c in features.columns if c not in ("Player", "grp")]
    vectors = materialize(sim.feature_vectors(features, "Player", "grp", cols), "vectors")
    similar_players = materialize(sim.top_similar(vectors, similar), "similar")
    ref = players.select(F.col("ID").alias("other"), "Name", "Rating", "Potential", "FirstPos", "Role", "TeamInfo")
    nested["player_similar"] = lists(similar_players.join(ref, "other"), "id", "SimilarPlayers",
                                     [F.col("num").alias("Num"), F.col("other").alias("Player"), "Name", "Rating",
                                      "Potential", F.col("FirstPos").alias("Position"), "Role",
                                      F.col("TeamInfo").alias("Team"), F.col("similarity").alias("Similarity")], ["num"])

    # Match documents.
    rows = match_info(t["match"], t["team"], season, top_leagues)
    bosses = t["manager"].select(F.col("ID").alias("Manager"), F.col("Name").alias("ManagerName"))
    team_rows = t["team_stats"].join(bosses, "Manager", "left").join(rows, ["Match", "Team"])
    team_stats = [c for c in lk.COUNTED_STATS if c in t["team_stats"].columns] + [
        c for c in ("BallPossession", "PassAccuracy", "ShotAccuracy", "DuelWinRate") if c in t["team_stats"].columns]
    info = ["League", "Date", "HomeAway", "Score", "ScoreDiff", "Result", "Elo", "EloDiff"]
    nested["team_matches"] = match_documents(team_rows, "Team", [*info, "Formation", "Manager", "ManagerName"], team_stats)
    player_rows = shape.position_columns(t["player_stats"].join(rows, ["Match", "Team"]).join(
        players.select(F.col("ID").alias("Player"), "Team"), ["Player", "Team"], "left_semi"),
        position_metrics, ("Position",))
    present = sorted({c for cols in position_metrics.values() for c in cols if c in t["player_stats"].columns})
    nested["player_matches"] = match_documents(
        player_rows, "Player", [*info, "ShirtNumber", "Position", "MinutesPlayed", "Rating"], present,
        allowed=F.col("Allowed"))

    # Percentiles by first position and over all teams.
    firsts = players.select(F.col("ID").alias("Player"), F.col("FirstPos").alias("Position"), "Name")
    eligible = agg_player.filter("MinutesPlayed >= 300").drop("Position").join(firsts, "Player").filter(
        F.col("Position").isNotNull())
    wanted = sorted({c for cols in position_metrics.values() for c in cols if c in numeric})
    pct = win.pct_rank(eligible, "Position", "Player", wanted, lk.NEGATIVE_PLAYER_METRICS, wide=False)
    lists_by_pos = shape.position_columns(pct, position_metrics, ("Position",))
    pct = lists_by_pos.filter(F.array_contains("Allowed", F.col("metric"))).select("Position", "Player", "metric", "pct")
    pct = materialize(pct, "percentiles")
    pct_docs = pct.groupBy("Position", "Player").agg(F.map_from_entries(F.collect_list(F.struct("metric", "pct"))).alias("p"))
    comparison = eligible.select("Position", "Player", "Name", *counted).join(pct_docs, ["Position", "Player"], "left")
    comparison = comparison.select("Position", "Player", F.to_json(F.struct("Player", "Name", *counted)).alias("Metrics"),
                                   F.to_json("p").alias("Percentiles"))
    team_pct = win.pct_rank(agg_team.filter("Matches >= 5").withColumn("Position", F.lit("team")), "Position", "Team",
                            [c for c in team_numeric if c != "Matches"], lk.NEGATIVE_TEAM_METRICS)
    nested["player_similar_mean"] = charts.similar_mean(
        similar_players, pct.select(F.col("Player").alias("id"), "metric", "pct"), wanted)

    sinks.write_documents(managers, "manager", f"{out}/entities")
    sinks.write_documents(player_docs, "player", f"{out}/entities")
    sinks.write_documents(team_docs, "team", f"{out}/entities")
    for name, df in nested.items():
        write_table(df, f"{out}/nested/{name}")
    sinks.write_comparison(comparison, f"{out}/comparison/players", "Position")
    sinks.write_comparison(sinks.comparison_rows(agg_team.drop("Formation"), team_pct.drop("Position"), "Team"),
                           f"{out}/comparison/teams")
    return out
