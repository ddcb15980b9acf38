"""Metrics job: unified tables to cleaned tables, Elo, ratings, roles and aggregates."""

from pyspark.sql import functions as F

from ..config import lookups as lk
from ..config.metrics import LOCATION_COLUMNS, PLAYER_METRICS, TEAM_METRICS
from ..functions.numeric import round_even, season_start
from ..operators import aggregate as agg, rating as rat, resolve as res, roles, windows as win
from ..operators.shape import const_map
from ..session import job, materialize
from ..sources.tables import read_table, write_table

PLAYER_RULES = {**{c: "mean" for c in LOCATION_COLUMNS}, "Rating": "mean", "Position": "mode",
                "ShirtNumber": "mode"}
TEAM_RULES = {"Formation": "mode", "BallPossession": "mean", "Rating": "mean"}
PLAYER_DROP = ["Match", "Team", "League", "Season", "Date", "Matches", *agg.ratio_names(PLAYER_METRICS)]
TEAM_DROP = ["Match", "Manager", "League", "Season", "Date", "Matches", "DuelWonPercent",
             "AerialDuelsPercentage", "GroundDuelsPercentage", "DribblesPercentage", "WonTacklePercent",
             *agg.ratio_names(TEAM_METRICS)]


def with_match_info(df, matches):
    return df.join(matches.select(F.col("ID").alias("Match"), "League", "Season", "Date"), "Match", "left")


def recent_first():
    return [F.col("Date").desc_nulls_last(), F.col("Match").desc()]


def season_roles(player_stats, metric_lists, min_minutes=500, starts=20, names=None):
    """Role centroids per position from season aggregates: components, clusters, means.

    ``names`` {position: [name, ...]} names the roles in the order of ``name_roles``.

    All positions are fitted at once; a position's metrics are the vector of its rows.
    """
    main = F.coalesce(F.try_element_at(const_map(lk.ROLE_POSITION), F.col("Position")), F.col("Position"))
    df = player_stats.filter(F.col("MinutesPlayed") >= min_minutes).withColumn("Position", main)
    lists = {p: [m for m in metrics if m in df.columns] for p, metrics in metric_lists.items()}
    used = sorted({m for cols in lists.values() for m in cols})
    df = win.impute_group_mean(df.filter(F.col("Position").isin(list(lists))), "Position", used)
    vector = None
    for position, cols in lists.items():
        own = F.array(*[F.col(c).cast("double") for c in cols]).cast("array<double>")
        vector = (F.when if vector is None else vector.when)(F.col("Position") == position, own)
    rows = materialize(df.select(F.col("Player").alias("id"), F.col("Position").alias("grp"), vector.alias("v")), "role-rows")
    scores, _ = roles.pca_by_group(rows)
    found, _ = roles.kmeans_by_group(scores.withColumnRenamed("scores", "v"), starts=starts)
    named = roles.name_roles(rows.join(found, ["id", "grp"]).withColumn("sum", F.aggregate(
        "v", F.lit(0.0), lambda s, x: s + F.coalesce(x, F.lit(0.0)))), names, ["sum"], position="grp")
    return roles.role_centroids_of_vectors(named)


def last_roles(player_stats, centroids, metric_lists, last=5):
    """Nearest role of each player from the aggregate of the last matches."""
    recent = win.last_n(player_stats, "Player", recent_first(), last).drop("rn")
    df = agg.player_metrics(agg.aggregate_entity(recent, "Player", PLAYER_RULES, drop=PLAYER_DROP),
                            ids=("Player", "ShirtNumber", "Position", "Matches", "Rating"))
    main = F.coalesce(F.try_element_at(const_map(lk.ROLE_POSITION), F.col("Position")), F.col("Position"))
    df = df.withColumn("Position", main)
    out = None
    for position, metrics in metric_lists.items():
        cols = [m for m in metrics if m in df.columns]
        part = roles.assign_role(df.filter(F.col("Position") == position),
                                 centroids.filter(F.col("Position") == position), cols)
        out = part if out is None else out.unionByName(part)
    return out


def run_metrics(spark, unified, events, out, season, as_of, formation_map, metric_lists=None,
                centroids=None):
    """Clean, rate and aggregate everything; ``metric_lists`` is {position: [metric]} for roles."""
    with job(spark, "metrics", unified, events, out, season, as_of, sorted((metric_lists or {}).items())):
        return _run(spark, unified, events, out, season, as_of, formation_map, metric_lists, centroids)


def _run(spark, unified, events, out, season, as_of, formation_map, metric_lists, centroids):
    t = {n: read_table(spark, f"{unified}/{n}") for n in
         ("team", "player", "manager", "match", "player_stats", "team_stats")}
    staff = res.clean_staff(t["manager"], t["team"])
    teams = res.clean_teams(t["team"], staff)
    matches = agg.fill_scores(t["match"].drop("Round"), t["player_stats"])
    team_rows = res.clean_team_stats(t["team_stats"], t["player_stats"])
    player_rows = materialize(res.clean_player_stats(
        t["player_stats"], t["team_stats"], t["match"], formation_map, season), "player-rows")
    players = materialize(res.clean_players(t["player"], player_rows), "players")

    allowed = formation_map.withColumn("Formation", F.coalesce(
        F.try_element_at(const_map(lk.FORMATIONS), F.col("formation")), F.col("formation")))
    allowed = allowed.groupBy("Formation").agg(F.array_sort(F.collect_set("position")).alias("positions"))
    stats = res.infer_position(player_rows.drop("Date"), players, allowed)
    players, stats, _ = res.merge_identities(players, stats, matches, season)
    players = materialize(players, "players")
    stats = materialize(stats, "player-stats")

    team_stats = agg.team_metrics(agg.team_from_players(team_rows, stats))
    weight = rat.competition_weight().cast("double")
    matches, table = rat.elo(matches, rat.country_base(teams), weight=weight)
    matches = materialize(matches, "matches")
    teams = teams.join(table, "ID", "left")

    keys = ["Match", "Team", "Player"]
    for name, make in (("pass_map", agg.aggregate_passes), ("shot_map", agg.aggregate_shots)):
        stats = stats.join(make(read_table(spark, f"{events}/{name}")), keys, "left")
    stats = materialize(agg.with_metrics(stats, PLAYER_METRICS), "player-metrics")

    full = with_match_info(stats, matches)
    if metric_lists:
        season_agg = agg.player_metrics(agg.aggregate_entity(
            full.filter(F.col("Season").cast("string") == str(season)), "Player", PLAYER_RULES, drop=PLAYER_DROP),
            ids=("Player", "ShirtNumber", "Position", "Matches"))
        if centroids is None:
            centroids = season_roles(season_agg, metric_lists)
        found = last_roles(full, centroids, metric_lists).select(
            F.col("Player").alias("ID"), "Role", F.col("Position").alias("_p"))
        players = players.drop("Role").join(found, "ID", "left").withColumn(
            "Position", F.coalesce("_p", "Position")).drop("_p")
    else:
        players = players.withColumn("Role", F.lit(None).cast("string"))

    rows = rat.match_rows(matches)
    rated = rat.match_rating(stats.join(rows.select("Match", "Team", "Elo", "OpponentElo", "ScoreDiff"),
                                        ["Match", "Team"]), groups=lk.MAIN_POSITION)
    rated = materialize(rated.select("Match", "Team", "Player", "MinutesPlayed", "Rating"), "rated")
    adjusted = rat.adjust_rating(rated, rows)
    start = spark.range(1).select(season_start(as_of)).first()[0]
    periods = win.fill_periods(win.bucket_ratings(adjusted)).withColumn("MeanRating", round_even("MeanRating", 2))
    periods = materialize(periods.filter(F.col("Period") >= F.lit(start)), "periods")
    played = stats.select("Match", "Player", "MinutesPlayed").join(
        matches.select(F.col("ID").alias("Match"), "League", "Date"), "Match")
    played = played.filter(F.col("Date") >= F.lit(start)).withColumn("Weight", weight)
    value = materialize(rat.player_value(periods, rat.rating_factors(played, players, teams)), "value")
    counts = played.select("Player", "Match").distinct().groupBy("Player").agg(F.count("*").alias("PlayedMatches"))
    births = players.select(F.col("ID").alias("Player"), "DateBirth")
    potential = rat.player_potential(value, births, counts, as_of)
    stats, players = rat.apply_ratings(stats, rated, players, value, potential)
    team_stats = agg.team_rating(team_stats, stats)

    full = with_match_info(stats, matches)
    full_team = with_match_info(team_stats, matches)
    agg_player = agg.player_metrics(
        agg.aggregate_windows(full, "Player", recent_first(), season, rules=PLAYER_RULES, drop=PLAYER_DROP),
        ids=("scope", "Player", "ShirtNumber", "Position"))
    agg_team = agg.team_metrics(
        agg.aggregate_windows(full_team, "Team", recent_first(), season, rules=TEAM_RULES, drop=TEAM_DROP),
        ids=("scope", "Team", "Formation"))
    for name, df in (("manager", staff), ("team", teams), ("player", players), ("match", matches),
                     ("player_stats", stats), ("team_stats", team_stats), ("agg_player", agg_player),
                     ("agg_team", agg_team)):
        write_table(df, f"{out}/metrics/{name}")
    if centroids is not None:
        write_table(centroids, f"{out}/metrics/role_centroids")
    return f"{out}/metrics"
