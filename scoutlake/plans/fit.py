"""Fit job: how well candidate players suit candidate teams."""

from pyspark.sql import functions as F

from ..config import lookups as lk
from ..operators import aggregate as agg, shape, similarity as sim, windows as win
from ..session import job, materialize
from ..sources.tables import read_table, write_table


def candidates(players, agg_player, min_matches=10, limit=None):
    """Players (the best rated ``limit`` of them) with enough matches, a team, a rating and a potential."""
    enough = agg_player.filter(F.col("Matches") >= min_matches).select(F.col("Player").alias("ID"))
    known = players.dropna(subset=["Team", "Rating", "Potential"]).join(enough, "ID", "left_semi")
    return known if limit is None else win.top_k(known, [F.col("Rating").desc(), F.col("Potential").desc(), "ID"], limit)


def signing_teams(teams, played, leagues=None, limit=None):
    """Teams (the ``limit`` best by Elo) that play in a signing league."""
    leagues = lk.FIT_LEAGUES if leagues is None else leagues
    ok = played.filter(F.col("League").isin(leagues)).select(F.col("Team").alias("ID")).distinct()
    known = teams.join(ok, "ID", "left_semi")
    return known if limit is None else win.top_k(known, [F.col("EloRating").desc(), "ID"], limit)


def run_fit(spark, metrics, events, out, season, as_of, leagues=None, min_matches=10, min_minutes=500,
            rank_players=False, top_players=None, top_teams=None):
    """Score every candidate for every signing team other than his own.

    ``top_players`` and ``top_teams`` bound the two lists by rating and by Elo; by default all are scored.
    """
    with job(spark, "fit", metrics, events, out, season, as_of, leagues, min_matches, min_minutes, rank_players, top_players, top_teams):
        return _run(spark, metrics, events, out, season, as_of, leagues, min_matches, min_minutes, rank_players, top_players, top_teams)


def _run(spark, metrics, events, out, season, as_of, leagues, min_matches, min_minutes, rank_players, top_players, top_teams):
    t = {n: read_table(spark, f"{metrics}/{n}") for n in
         ("team", "player", "match", "player_stats", "team_stats", "agg_player", "agg_team")}
    season_rows = shape.season_filter(t["match"], season)
    league_of = season_rows.select(F.col("ID").alias("Match"), "League")
    agg_player = t["agg_player"].filter("scope = 'season'").drop("scope")
    agg_team = t["agg_team"].filter("scope = 'season'").drop("scope")

    # Who and where.
    team_played = t["team_stats"].select("Match", "Team", "Formation").join(league_of, "Match")
    player_played = t["player_stats"].select("Match", "Team", "Player").join(team_played, ["Match", "Team"])
    pool = materialize(candidates(t["player"], agg_player, min_matches, top_players), "candidates")
    clubs = materialize(signing_teams(t["team"], team_played, leagues, top_teams).select(F.col("ID").alias("team")), "clubs")
    pairs = materialize(sim.candidate_pairs(pool.select(F.col("ID").alias("player"), F.col("Team").alias("own")), clubs), "pairs")
    both = pairs.select("player", "team")

    # Context of both sides.
    def lists(df, key, tag=""):
        out = agg.distinct_lists(df, key, "Formation").join(agg.distinct_lists(df, key, "League"), key, "full_outer")
        return out.select(F.col(key).alias("k"), F.col("FormationList").alias(tag + "formations"),
                          F.col("LeagueList").alias(tag + "competitions"))

    elo = t["team"].select(F.col("ID").alias("Team"), F.col("EloRating").alias("own_elo"))
    seconds = F.unix_timestamp(F.col("DateBirth").cast("timestamp")).cast("double")
    players = pool.select("ID", "Team", F.col("Country").alias("country"), seconds.alias("birth"),
                          F.col("Rating").alias("rating"), F.col("Potential").alias("potential"))
    players = players.join(elo, "Team").join(lists(player_played, "Player").withColumnRenamed("k", "ID"), "ID", "left")
    players = players.drop("Team").withColumnRenamed("ID", "player")
    squads = t["player"].groupBy(F.col("Team").alias("team")).agg(
        F.collect_set("Country").alias("team_countries"), F.avg(seconds).alias("team_birth"),
        F.avg("Rating").alias("team_rating"), F.avg("Potential").alias("team_potential"))
    teams = clubs.join(squads, "team").join(t["team"].select(
        F.col("ID").alias("team"), F.col("Country").alias("team_country"), F.col("EloRating").alias("team_elo")), "team")
    teams = teams.join(lists(team_played, "Team", "team_").withColumnRenamed("k", "team"), "team", "left")

    # Similarities.
    numeric = [f.name for f in agg_player.schema.fields
               if f.dataType.typeName() in ("double", "long", "integer") and f.name != "ShirtNumber"]
    stats = t["player_stats"].select([c for c in t["player_stats"].columns if not c.endswith("Per90")])
    features = sim.similarity_features(t["match"], stats, t["player"], season, as_of, numeric, min_minutes)
    cols = [c for c in features.columns if c not in ("Player", "grp")]
    vectors = materialize(sim.feature_vectors(features, "Player", "grp", cols), "vectors")
    members = vectors.join(t["player"].select(F.col("ID").alias("id"), F.col("Team").alias("team")).dropna(), "id")
    context = agg.team_context(shape.to_team_rows(season_rows, home_elo="HomeElo", away_elo="AwayElo"))
    team_features = sim.team_features(context, agg_team)
    team_cols = [c for c in team_features.columns if c != "Team"]
    team_vectors = sim.feature_vectors(team_features.withColumn("_g", F.lit(0)), "Team", "_g", team_cols)
    wanted = pairs.select("own", "team").distinct()
    a = team_vectors.select(F.col("id").alias("own"), F.col("v").alias("u"))
    b = team_vectors.select(F.col("id").alias("team"), "v")
    team_sim = wanted.join(a, "own").join(b, "team").select(
        F.col("own").alias("id"), F.col("team").alias("other"), ((sim.dot("u", "v") + 1) / 2 * 100).alias("similarity"))
    squad_sim = sim.squad_similarity(members, both)

    positions = t["player"].select(F.col("ID").alias("id"), F.col("Team").alias("team"), F.array_compact(
        F.array("FirstPos", "SecondPos", "ThirdPos")).alias("positions"))
    posset = F.array_join(F.array_sort("positions"), ",").alias("posset")
    own_set = positions.select(F.col("id").alias("player"), posset).join(pool.select(F.col("ID").alias("player")), "player", "left_semi")
    sets = own_set.select("posset").distinct()
    club_players = positions.join(clubs, "team", "left_semi")
    mates = materialize(sim.position_sets(club_players, sets, vectors), "mates")
    pos_sim = sim.same_position_similarity(vectors, both.join(own_set, "player"), mates)

    passes = read_table(spark, f"{events}/pass_map").select("Player", "IniX", "IniY")
    own_cells = sim.heat_cells(passes.join(pool.select(F.col("ID").alias("Player")), "Player", "left_semi"), "Player")
    club_sets = sim.position_mates(club_players, sets)
    set_points = passes.join(club_sets.withColumnRenamed("id", "Player"), "Player").withColumn(
        "key", F.concat_ws("|", "posset", "team"))
    set_cells = sim.heat_cells(set_points, "key")
    heat_pairs = both.join(own_set, "player").select("player", "team", F.concat_ws("|", "posset", "team").alias("key"))
    corr = sim.heatmap_corr(own_cells.withColumnRenamed("Player", "player"), set_cells, heat_pairs, "player", "key")
    pass_corr = heat_pairs.join(corr, ["player", "key"]).select(
        "player", "team", ((F.col("corr") + 1) / 2 * 100).alias("PassesCorrelation"))

    style = [c for c in lk.STYLE_METRICS if c in agg_player.columns and c in agg_team.columns]
    ranked = win.pct_rank(agg_team.filter(F.col("Matches") >= min_matches).withColumn("_g", F.lit(0)).fillna(0.0, style),
                          "_g", "Team", style, decimals=9)
    zero = lambda c, by: F.coalesce(F.col(c).cast("double") / by, F.lit(0.0))
    style_teams = ranked.join(clubs.withColumnRenamed("team", "Team"), "Team", "left_semi").select(
        F.col("Team").alias("id"), F.array(*[zero(c, 100.0) for c in style]).alias("v"))
    own = agg_player.filter(F.col("MinutesPlayed") >= min_minutes)
    if rank_players:
        own = win.pct_rank(own.withColumn("_g", F.lit(0)).fillna(0.0, style), "_g", "Player", style, decimals=9)
    style_players = own.join(pool.select(F.col("ID").alias("Player")), "Player", "left_semi").select(
        F.col("Player").alias("id"), F.array(*[zero(c, 1.0) for c in style]).alias("v"))
    style_sim = sim.cross_similarity(style_players, style_teams)

    measures = materialize(sim.fit_measures(pairs, players, teams, team_sim, squad_sim, pos_sim,
                                            pass_corr, style_sim), "measures")
    scored = sim.stars(sim.fit_score(measures).select("player", "team", "Score"))
    write_table(measures, f"{out}/fit/measures")
    write_table(scored, f"{out}/fit/scores")
    docs = sim.fit_documents(scored, t["player"].select("ID", "Name"))
    write_table(docs, f"{out}/fit/documents")
    return f"{out}/fit"
