"""Club Elo, match ratings by position, season rating and potential."""

import math

import pandas as pd
from pyspark.sql import functions as F

from ..config import lookups as lk
from ..config.weights import position_weights
from ..functions.numeric import age, age_potential, clip, norm01, round_even
from ..session import materialize
from .aggregate import elo_factor, match_importance, minutes_factor
from .shape import const_map, to_team_rows


def country_base(teams, country="Country", out="EloRating", table=None, default=1000.0):
    """Starting Elo of each team from its country."""
    table = const_map({k: float(v) for k, v in (table or lk.COUNTRY_ELO).items()})
    return teams.withColumn(out, F.coalesce(F.try_element_at(table, F.col(country)), F.lit(default)))


def competition_weight(col="League", table=None, default=lk.DEFAULT_WEIGHT):
    table = const_map(lk.COMPETITION_WEIGHT if table is None else table)
    return F.coalesce(F.try_element_at(table, F.col(col)), F.lit(default))


def _margins(diff):
    """Factor on K for the winner's goal margin; the loser and draws get 1."""
    import numpy as np

    return np.select([diff <= 1, diff == 2, diff == 3], [1.0, 1.5, 1.75], 1.75 + (diff - 3) / 8.0)


def _fold(batches, home_advantage):
    """Ratings after each match from those before the window; rows come by component, date and id, batch by batch."""
    import numpy as np
    import pyarrow as pa

    component, rating = None, {}
    for batch in batches:
        home_out, away_out = [], []
        of, home, away = (batch.column(c).to_pylist() for c in ("_c", "_home", "_away"))
        home0, away0, hs, as_, k = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_home0", "_away0", "_hs", "_as", "_k"))
        won = np.where(hs > as_, 1.0, np.where(hs == as_, 0.5, 0.0))
        at_home, at_away = k * _margins(hs - as_), k * _margins(as_ - hs)
        numbers = (x.tolist() for x in (home0, away0, won, at_home, at_away))
        for c, h, a, h0, a0, w, kh, ka in zip(of, home, away, *numbers):
            if c != component:
                component, rating = c, {}
            rh, ra = rating.get(h, h0), rating.get(a, a0)
            rating[h] = rh + kh * (w - 1.0 / (1.0 + 10.0 ** (-(rh - ra + home_advantage) / 400.0)))
            rating[a] = ra + ka * ((1.0 - w) - 1.0 / (1.0 + 10.0 ** (-(ra - rh) / 400.0)))
            home_out.append(rating[h])
            away_out.append(rating[a])
        names = ["_id", "_date", "_home", "_away"]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(home_out, pa.float64()),
                                          pa.array(away_out, pa.float64())], names=[*names, "HomeElo", "AwayElo"])


def _meeting(pdf):
    """Each team of a window's pairings with the first team of those that are connected to it."""
    low = {}

    def first(t):
        while low.setdefault(t, t) != t:
            low[t] = t = low[low[t]]
        return t

    for h, a in zip(pdf["_home"].tolist(), pdf["_away"].tolist()):
        h, a = first(h), first(a)
        low[max(h, a)] = min(h, a)
    teams = list(low)
    return pd.DataFrame({"_w": [pdf["_w"].iloc[0]] * len(teams), "_home": teams, "_c": [first(t) for t in teams]})


def elo_windows(rows, window_rows):
    """Matches in windows ``_w`` of (date, id) with ``_c``, the smallest team of those that meet in the window.

    Teams that are not connected by matches of a window cannot change each other's rating in it, so each such
    component is a fold of its own.  A window's pairings are bounded by its rows; all windows are labelled at once.
    Returns the frame and the number of windows.
    """
    windows = max(1, math.ceil(rows.count() / window_rows))
    cut = materialize(rows.repartitionByRange(windows, "_date", "_id").withColumn("_w", F.spark_partition_id()), "elo-windows")
    team = rows.schema["_home"].dataType.simpleString()
    part = cut.select("_w", "_home", "_away").distinct().groupBy("_w").applyInPandas(_meeting, f"_w int, _home {team}, _c {team}")
    # dealt by window, so that the files do not grow with windows times tasks
    return materialize(cut.join(part, ["_w", "_home"]).repartition(windows, "_w"), "elo-matches", ["_w"]), windows


def elo(matches, teams, match="ID", date="Date", home="HomeTeam", away="AwayTeam",
        home_score="HomeScore", away_score="AwayScore", weight=None, team="ID",
        start="EloRating", default=1000.0, home_advantage=100.0, window_rows=200_000, chain=20):
    """Elo over all matches in (date, id) order: post-match ratings and the final table.

    The rating is a fold over shared teams, so its length is inherent.  The
    matches are range-partitioned by (date, id) into windows of at most about
    ``chain`` times ``window_rows`` matches, written once; the windows follow one
    another, a job for each, and within one the teams that meet are folded component
    by component, sorted by Spark and read batch by batch, so a task holds one batch
    and the ratings of a component.  Between windows only one rating per team
    survives, joined to the next window by key and kept in the scratch folder, so a
    lost executor costs one window, and no task or driver holds the history.
    """
    k = weight if weight is not None else F.lit(float(lk.DEFAULT_WEIGHT))
    rows = matches.select(
        F.col(match).alias("_id"), F.col(date).alias("_date"), F.col(home).alias("_home"),
        F.col(away).alias("_away"), F.col(home_score).cast("double").alias("_hs"),
        F.col(away_score).cast("double").alias("_as"), k.cast("double").alias("_k"))
    rows = rows.dropna(subset=["_home", "_away", "_hs", "_as"])
    staged, windows = elo_windows(rows, window_rows * chain)
    state = teams.select(F.col(team).alias("_team"), F.col(start).cast("double").alias("_r"))
    state = materialize(state.filter(F.col("_team").isNotNull()).groupBy("_team")
                        .agg(F.max("_r").alias("_r")), "elo-state")
    types = {c: rows.schema[c].dataType.simpleString() for c in ("_id", "_date", "_home", "_away")}
    schema = ", ".join(f"{c} {t}" for c, t in types.items()) + ", HomeElo double, AwayElo double"
    rated = None
    for w in range(windows):
        cur = staged.filter(F.col("_w") == w)
        for side in ("_home", "_away"):
            before = state.select(F.col("_team").alias(side), F.col("_r").alias(side + "0"))
            cur = cur.join(before, side, "left")
        cur = cur.fillna(default, ["_home0", "_away0"])
        cur = cur.repartition("_c").sortWithinPartitions("_c", "_date", "_id")
        done = materialize(cur.mapInArrow(lambda batches: _fold(batches, home_advantage), schema), "elo-out")
        rated = done if rated is None else rated.unionByName(done)
        last = (done.select(F.explode(F.array(
                    F.struct(F.col("_home").alias("_team"), F.col("HomeElo").alias("_n"), "_date", "_id"),
                    F.struct(F.col("_away").alias("_team"), F.col("AwayElo").alias("_n"), "_date", "_id")
                )).alias("s")).select("s.*")
                .groupBy("_team").agg(F.max_by("_n", F.struct("_date", "_id")).alias("_n")))
        state = materialize(state.join(last, "_team", "full_outer").select(
            "_team", F.coalesce("_n", "_r").alias("_r")), "elo-state")
    rated = rated.select(F.col("_id").alias(match), "HomeElo", "AwayElo")
    return (matches.join(rated, match),
            state.select(F.col("_team").alias(team), F.col("_r").alias(start)))


def match_rating(df, weights=None, position="Position", minutes="MinutesPlayed", elo="Elo",
                 opp_elo="OpponentElo", diff="ScoreDiff", out="Rating", groups=None):
    """Rating 0-10 per row: weighted terms of the position, then Elo, minutes and score factors.

    All positions are branches of one projection; metrics the frame lacks count 0.
    """
    weights = weights or position_weights()
    present = set(df.columns)
    main = F.col(position)
    if groups is not None:
        main = F.try_element_at(const_map(groups), main)
    score = None
    for name, terms in weights.items():
        total = F.lit(6.0)
        for weight, metric, lo, hi in terms:
            x = F.coalesce(F.col(metric).cast("double"), F.lit(0.0)) if metric in present else F.lit(0.0)
            total = total + F.lit(weight) * (x if lo is None else norm01(x, lo, hi))
        score = (F.when if score is None else score.when)(main == name, clip(total, 0, 10))
    zero = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    factor = ((1 + 0.05 * ((zero(opp_elo) - zero(elo)) / 400)) * clip(zero(minutes) / 60, 0.5, 1)
              * (1 + 0.1 * zero(diff)))
    rated = df.filter(main.isin(list(weights)))
    return rated.withColumn(out, clip(score * factor, 0, 10))


def adjust_rating(ratings, rows, rating="Rating", weight="Weight", elo="Elo"):
    """Rating times the context factor of competition weight and team Elo, by match and team."""
    context = rows.select("Match", "Team", "Date", weight, elo)
    out = ratings.join(context, ["Match", "Team"])
    mod = clip(0.85 + 0.10 * norm01(weight, 20, 50) + 0.10 * norm01(elo, 500, 2500), 0.85, 1.05)
    return out.withColumn("AdjustedRating", clip(F.col(rating) * mod, 0, 10)).filter(
        F.col("AdjustedRating").isNotNull())


def player_value(periods, factors, prior=8):
    """Shrunk season rating on the 65-95 scale from period means and the three factors."""
    base = periods.groupBy("Player").agg(F.avg("MeanRating").alias("_mean"),
                                         F.sum("PlayedMatches").alias("_n"))
    overall = periods.agg(F.avg("MeanRating")).scalar()
    shrunk = (F.col("_n") * F.col("_mean") + prior * overall) / (F.col("_n") + prior)
    out = base.withColumn("_shrunk", shrunk).join(factors, "Player")
    raw = (0.65 * F.col("_shrunk") / 10 + 0.15 * F.col("Per90Factor")
           + 0.10 * F.col("EloFactor") + 0.10 * F.col("MatchImpFactor"))
    return out.withColumn("Rating", round_even(65 + raw * 30)).select(
        "Player", "Rating", "Per90Factor", "EloFactor", "MatchImpFactor")


def player_potential(value, births, played, as_of, birth="DateBirth"):
    """Potential on the 65-99 scale from rating, age, factors and the number of matches."""
    ages = births.filter(F.col(birth).isNotNull()).select(
        "Player", age_potential(age(birth, as_of)).alias("_age"))
    out = value.join(played, "Player", "left").join(ages, "Player")
    raw = (0.45 * clip((F.col("Rating") - 65) / 30, 0, 1) + 0.25 * F.col("_age")
           + 0.10 * F.col("Per90Factor") + 0.10 * F.col("EloFactor")
           + 0.05 * F.col("MatchImpFactor") + 0.05 * clip(F.col("PlayedMatches") / 20, 0, 1))
    return out.withColumn("Potential", round_even(65 + raw * 34)).drop("_age")


def rating_factors(rows, players, teams):
    """Minutes share, club Elo and competition importance per player, left-joined."""
    per90 = minutes_factor(rows)
    imp = match_importance(rows).select("Player", F.col("NormWeight").alias("MatchImpFactor"))
    known = players.filter(F.col("FirstPos").isNotNull()).select(F.col("ID").alias("Player"))
    return (known.join(per90, "Player", "left").join(elo_factor(players, teams), "Player", "left")
            .join(imp, "Player", "left"))


def apply_ratings(stats, ratings, players, value, potential):
    """Match ratings next to the statistics, rating and potential next to the profiles."""
    once = ratings.groupBy("Player", "Match").agg(F.max("Rating").alias("Rating"))
    stats = stats.drop("Rating").join(once, ["Player", "Match"], "left")
    season = value.select(F.col("Player").alias("ID"), "Rating").join(
        potential.select(F.col("Player").alias("ID"), "Potential"), "ID")
    return stats, players.drop("Rating", "Potential").join(season, "ID", "left")


def match_rows(matches):
    """Both sides of each match with Elo, competition weight and date."""
    weighted = matches.withColumn("Weight", competition_weight().cast("double"))
    return to_team_rows(weighted, home_elo="HomeElo", away_elo="AwayElo",
                        keep=("League", "Season", "Date", "Weight"))
