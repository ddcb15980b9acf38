"""Aggregations, pivots and the metric catalogues."""

import re

from pyspark.sql import functions as F, Window

from ..config import lookups as lk
from ..config.metrics import LOCATION_COLUMNS, PLAYER_METRICS, TEAM_METRICS, parse
from ..functions.numeric import _col, per90, round_even, safe_div
from ..functions.pitch import DIRECTIONS, ZONES
from .windows import last_n


def fill_scores(matches, stats, match="ID", home="HomeTeam", away="AwayTeam",
                home_score="HomeScore", away_score="AwayScore", goals="Goals"):
    """Missing scores from the players' goals; matches still without a score are dropped."""
    sums = stats.groupBy("Match", "Team").agg(F.sum(goals).alias("_g"))
    out = matches
    for team, score, tag in ((home, home_score, "_h"), (away, away_score, "_a")):
        side = sums.select(F.col("Match").alias(match), F.col("Team").alias(team),
                           F.col("_g").alias(tag))
        out = out.join(side, [match, team], "left")
    out = out.withColumns({home_score: F.coalesce(F.col(home_score), F.col("_h")),
                           away_score: F.coalesce(F.col(away_score), F.col("_a"))})
    return out.filter(F.col(home_score).isNotNull() & F.col(away_score).isNotNull()).select(
        matches.columns)


def team_from_players(team, players, keys=("Match", "Team"), largest=("MinutesPlayed", "GoalsConceded"),
                      skip=("Player", "ShirtNumber", "Position"),
                      keep=("Manager", "Formation", "BallPossession")):
    """Player sums per match and team next to the team's own statistics.

    On a name clash the larger value counts, null if either is null; every
    statistic that is still null becomes 0.
    """
    keys = list(keys)
    stats = [c for c in players.columns if c not in keys and c not in skip]
    rolled = players.groupBy(*keys).agg(
        *[(F.max(c) if c in largest else F.coalesce(F.sum(c), F.lit(0))).alias("_p_" + c)
          for c in stats])
    out = team.join(rolled, keys)
    cols = []
    for c in team.columns:
        if c in keys or c in keep:
            cols.append(F.col(c))
        elif c in stats:
            both = F.col(c).isNotNull() & F.col("_p_" + c).isNotNull()
            cols.append(F.coalesce(F.when(both, F.greatest(c, "_p_" + c)), F.lit(0)).alias(c))
        else:
            cols.append(F.coalesce(F.col(c), F.lit(0)).alias(c))
    cols += [F.coalesce(F.col("_p_" + c), F.lit(0)).alias(c) for c in stats if c not in team.columns]
    return out.select(cols)


def aggregate_entity(df, key, rules=None, default="sum", drop=(), matches="Matches"):
    """One pass per entity: sum (0 if all null), mean, most frequent value or maximum by column.

    Ratio and Per90 columns are dropped first, they are recomputed from the sums.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rules = rules or {}
    aggs = []
    for c in df.columns:
        if c in keys or c in drop or c.endswith("Per90"):
            continue
        rule = rules.get(c, default)
        if rule == "mean":
            agg = F.avg(c)
        elif rule == "mode":
            agg = F.mode(c, True)      # categories are few; ties give the smallest
        elif rule == "max":
            agg = F.max(c)
        else:
            agg = F.coalesce(F.sum(c), F.lit(0))
        aggs.append(agg.alias(c))
    if matches:
        aggs.append(F.count("*").alias(matches))
    return df.groupBy(*keys).agg(*aggs)


def mode_min(df, keys, col):
    """Most frequent non-null value per key, the smallest on ties, null if there is none."""
    keys = list(keys)
    counts = df.groupBy(*keys, col).agg(F.count(col).alias("_n"))
    return counts.groupBy(*keys).agg(
        F.min_by(col, F.when(F.col(col).isNotNull(), F.struct(-F.col("_n"), F.col(col)))).alias(col))


def aggregate_passes(df, keys=("Match", "Team", "Player")):
    """Pass counts, accurate counts and accuracy by zone and direction, means of the location."""
    ok = F.col("AccuratePass").cast("int")

    def block(col, values, tag):
        total, good, share = [], [], []
        for v in values:
            name = v.replace(" ", "")
            hit = F.col(col) == v
            n, a = F.count(F.when(hit, ok)), F.sum(F.when(hit, ok))
            total.append(n.alias(f"Pass{tag}{name}"))
            good.append(F.coalesce(a, F.lit(0)).alias(f"PassAcc{tag}{name}"))
            share.append(F.coalesce(F.try_divide(a, n), F.lit(0.0)).alias(f"PassPerc{tag}{name}"))
        return total + good + share

    def zero(c):
        return F.coalesce(c, F.lit(0.0))

    return df.groupBy(*keys).agg(
        zero(F.avg("Angle")).alias("PassMeanAngle"), zero(F.avg("Length")).alias("PassMeanLength"),
        zero(F.sum("Length")).alias("PassTotalLength"), zero(F.avg("IniX")).alias("PassMeanX"),
        zero(F.avg("IniY")).alias("PassMeanY"),
        *block("Zone", ZONES, "Zone"), *block("PassDirection", DIRECTIONS, "Dir"))


def aggregate_shots(df, keys=("Match", "Team", "Player")):
    """Shot means, counts by type and means of the goals; nulls become 0."""
    goal = F.col("Type") == "Goal"

    def zero(c, name):
        return F.coalesce(c, F.lit(0.0)).alias(name)

    def count(kind, name):
        return F.count_if(F.col("Type") == kind).alias(name)

    return df.groupBy(*keys).agg(
        zero(F.avg("IniX"), "ShotMeanX"), zero(F.avg("IniY"), "ShotMeanY"),
        zero(F.avg("GoalY"), "MeanGoalY"), zero(F.avg("GoalZ"), "MeanGoalZ"),
        zero(F.sum("Length"), "ShotTotalLenght"), zero(F.avg("Length"), "ShotMeanLength"),
        count("Goal", "TotalGoals"), count("Miss", "MissedShots"),
        count("Post", "ShotsOnPost"), count("Saved Shot", "SavedShots"),
        zero(F.avg(F.when(goal, F.col("IniX"))), "GoalIniX"),
        zero(F.avg(F.when(goal, F.col("IniY"))), "GoalIniY"),
        zero(F.avg(F.when(goal, F.col("GoalY"))), "GoalFinalY"),
        zero(F.avg(F.when(goal, F.col("GoalZ"))), "GoalFinalZ"),
        zero(F.avg(F.when(goal, F.col("Length"))), "GoalMeanLength"))


def team_rating(team_stats, player_stats, rating="Rating", keys=("Match", "Team")):
    """Mean player rating per match and team, joined to the team rows."""
    keys = list(keys)
    mean = player_stats.groupBy(*keys).agg(F.avg(rating).alias(rating))
    return team_stats.join(mean, keys, "left")


def distinct_lists(df, key, col):
    """Sorted distinct values per key (for categories: formations, competitions)."""
    keys = [key] if isinstance(key, str) else list(key)
    return (df.select(*keys, col).distinct().groupBy(*keys)
            .agg(F.array_sort(F.collect_set(col)).alias(col + "List")))


def teams_per_league(matches, league="League", home="HomeTeam", away="AwayTeam"):
    """Distinct (league, team) rows over both sides of the matches."""
    return matches.select(F.col(league).alias("League"),
                          F.explode(F.array(home, away)).alias("Team")).distinct()


def team_context(rows):
    """Goals by home and away role and mean Elo of both sides, from one row per side.

    Teams need at least one match in each role.
    """
    home = F.col("HomeAway") == "Home"
    out = rows.groupBy("Team").agg(
        F.sum(F.when(home, F.col("Score"))).alias("HomeGoals"),
        F.sum(F.when(home, F.col("OpponentScore"))).alias("HomeOppGoals"),
        F.sum(F.when(~home, F.col("OpponentScore"))).alias("AwayOppGoals"),
        F.sum(F.when(~home, F.col("Score"))).alias("AwayGoals"),
        F.avg("Elo").alias("Elo"), F.avg("OpponentElo").alias("OppElo"),
        F.count_if(home).alias("_h"), F.count_if(~home).alias("_a"))
    return out.filter((F.col("_h") > 0) & (F.col("_a") > 0)).drop("_h", "_a")


def scale_half(df, col, out, over=None):
    """Min-max of a column to [0.5, 1], 0.5 if flat; the limits are a scalar subquery."""
    over = df if over is None else over
    both = over.agg(F.struct(F.min(col).alias("lo"), F.max(col).alias("hi")).alias("s")).scalar()
    lo, hi = both["lo"], both["hi"]
    return df.withColumn(out, F.when(hi == lo, F.lit(0.5)).otherwise(
        0.5 + F.try_divide(F.col(col) - lo, hi - lo) * 0.5))


def match_importance(rows, player="Player", weight="Weight", league="League", match="Match",
                     minutes="MinutesPlayed"):
    """Mean and largest competition weight, competitions, matches, minutes; scaled score."""
    per_match = rows.groupBy(player, match).agg(
        F.sum(weight).alias("_ws"), F.count(weight).alias("_wn"), F.max(weight).alias("_wm"),
        F.sum(minutes).alias("_min"))
    base = per_match.groupBy(player).agg(
        (F.sum("_ws") / F.sum("_wn")).alias("MeanTournamentWeight"),
        F.max("_wm").alias("MaxTournamentWeight"), F.count("*").alias("MatchesPlayed"),
        F.sum("_min").alias("TotalMinutes"))
    comps = rows.select(player, league).filter(F.col(league).isNotNull()).distinct().groupBy(player).agg(
        F.count("*").alias("NumCompetitions"))
    out = base.join(comps, player, "left").withColumn(
        "CompetitionScore", F.col("MeanTournamentWeight") *
        (1 + 0.10 * (F.coalesce("NumCompetitions", F.lit(0)) - 1)))
    return scale_half(out, "CompetitionScore", "NormWeight")


def minutes_factor(rows, player="Player", minutes="MinutesPlayed"):
    return rows.groupBy(player).agg(F.avg(F.col(minutes) / 90).alias("Per90Factor"))


def elo_factor(players, teams, player="ID", team="Team", team_id="ID", elo="EloRating"):
    """Club Elo scaled over all clubs, for the players of a known club."""
    scaled = scale_half(teams.select(F.col(team_id).alias(team), elo), elo, "EloFactor")
    return players.select(F.col(player).alias("Player"), team).join(
        scaled.select(team, "EloFactor"), team).select("Player", "EloFactor")


def collect_nested(child, key, name, fields, order, chunk=10_000):
    """Ordered list of structs per key, in chunks of bounded size numbered from 0.

    An entity of ordinary size has chunk 0 only; a very large one is spread over
    several rows, each a bounded list, and no task ever holds the whole group.
    """
    from .windows import running_index
    keys = [key] if isinstance(key, str) else list(key)
    rows = running_index(child, keys, order, "_i")
    part = F.floor(F.col("_i") / F.lit(chunk)).cast("int").alias("part")
    return (rows.groupBy(*keys, part)
            .agg(F.array_sort(F.collect_list(F.struct("_i", F.struct(*fields).alias("v")))).alias("_l"))
            .select(*keys, "part", F.transform("_l", lambda x: x["v"]).alias(name)))


def collect_map(child, key, name, entry, value, chunk=None):
    """Map entry -> struct per key; ``chunk`` spreads the entries over that many rows."""
    keys = [key] if isinstance(key, str) else list(key)
    part = (F.pmod(F.xxhash64(entry), F.lit(chunk)) if chunk else F.lit(0)).cast("int").alias("part")
    return (child.groupBy(*keys, part).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(entry).cast("string").alias("k"),
                                                                value.alias("v"))))).alias(name)))


def first_valid(df, key, cols, order):
    """First non-null value of each column per key in an explicit order (partial aggregate)."""
    keys = [key] if isinstance(key, str) else list(key)
    pos = F.struct(*order)
    return df.groupBy(*keys).agg(
        *[F.min_by(c, F.when(F.col(c).isNotNull(), pos)).alias(c) for c in cols])


def pivot_qualifiers(events, quals, names, key=("match", "eventId"), order="qpos"):
    """First value of each known qualifier as a column, left-joined to the events."""
    key = list(key)
    known = quals.filter(F.col("name").isin(list(names)))
    pos = F.col(order)
    wide = known.groupBy(*key).agg(*[
        F.min_by("value", F.when((F.col("name") == n) & F.col("value").isNotNull(), pos)).alias(n)
        for n in names])
    return events.join(wide, key, "left")


def with_metrics(df, catalogue):
    """Append the metrics of a catalogue whose inputs exist.

    One projection per dependency level (two in practice), never one per metric.
    """
    pending = parse(catalogue)
    while pending:
        have = set(df.columns)
        names = {n for n, _, _ in pending}
        ready, later = [], []
        for name, num, den in pending:
            used = set(re.findall(r"[A-Za-z]\w*", num + " " + (den or "")))
            if used & (names - {name}):
                later.append((name, num, den))
            elif used <= have:
                ready.append((name, num, den))
        if not ready and len(later) == len(pending):
            break
        new = {n for n, _, _ in ready}
        df = df.select(*[c for c in df.columns if c not in new], *[
            (safe_div(F.expr(num), F.expr(den)) if den else F.expr(num).cast("double")).alias(n)
            for n, num, den in ready])
        pending = later
    return df


def player_metrics(df, ids=("Match", "Team", "Player", "ShirtNumber", "Position")):
    """Player catalogue and Per90 of every column that is not a location."""
    df = with_metrics(df, PLAYER_METRICS)
    cols = [c for c in df.columns if c not in ids and c not in LOCATION_COLUMNS]
    return df.select("*", *per90(cols, rounded=True))


def team_metrics(df, ids=("Match", "Team", "Manager", "Formation")):
    """Team catalogue and Per90 with the unrounded factor; null on zero minutes."""
    df = with_metrics(df, TEAM_METRICS)
    cols = [c for c in df.columns if c not in ids]
    return df.select("*", *per90(cols, rounded=False))


def ratio_names(catalogue):
    """Metrics that are recomputed after an aggregation."""
    return [n for n, _, _ in parse(catalogue)]


def aggregate_windows(df, key, order, season=None, season_col="Season", last=(10, 5, 3),
                      rules=None, drop=()):
    """All-time, season and last-n aggregates in one job, with a ``scope`` column.

    The unlimited scopes need no ordering; the last-n rows come from one ranked
    pass whose limit is applied before the shuffle.
    """
    scopes = [F.lit("all")]
    if season is not None:
        scopes.append(F.when(F.col(season_col).cast("string") == str(season), F.lit("season")))
    whole = df.withColumn("scope", F.explode(F.array_compact(F.array(*scopes))))
    recent = last_n(df, key, order, max(last), "_rn")
    recent = recent.withColumn("scope", F.explode(F.array_compact(F.array(
        *[F.when(F.col("_rn") <= n, F.lit(f"last{n}")) for n in last])))).drop("_rn")
    rows = whole.unionByName(recent)
    keys = [key] if isinstance(key, str) else list(key)
    return aggregate_entity(rows, ["scope", *keys], rules, drop=drop)
