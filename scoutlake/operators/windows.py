"""Ranking, ordering and period operators.

A window partition is one task, so ordered groups of any size are first dealt into range partitions of (key, order),
written once.  A window inside each part, plus a small table of the parts' totals or first rows, gives the result of
a window over the whole group, and a group that holds all rows is as many tasks as any others.
"""

import pandas as pd
from pyspark.sql import functions as F, Window

from ..functions.numeric import round_even
from ..session import materialize
from .shape import const_map


#: A value that holds more than one part in this many of all rows is sent to every task.
HOT_VALUES = 2000


def ordered_parts(df, keys, order, name="ordered"):
    """``df`` in range partitions of (keys, order) with the number of each row's part as ``_part``, written once.

    Spark samples the split points, so the parts are even however the keys and values are distributed; a key
    spans neighbouring parts, most keys only one.
    """
    cut = df.repartitionByRange(*keys, *order).withColumn("_part", F.spark_partition_id())
    return materialize(cut, name)


def next_actor(df, match="match", player="player", order=("ts", "event_id"), out="next_player"):
    """Player of the following row of the match in feed order, null for the last.

    The last row of a part takes the first player of the match's next part.
    """
    df = ordered_parts(df, [match], order)
    pos = F.struct(*order)
    heads = df.groupBy(match, "_part").agg(F.min_by(F.struct(F.col(player).alias("p")), pos).alias("_h"))
    heads = heads.select(match, "_part", F.lead("_h").over(
        Window.partitionBy(match).orderBy("_part")).alias("_next"))
    inner = Window.partitionBy(match, "_part").orderBy(*order)
    df = df.withColumn("_l", F.lead(F.struct(F.col(player).alias("p"))).over(inner))
    df = df.join(heads, [match, "_part"], "left")
    return df.withColumn(out, F.coalesce("_l", "_next")["p"]).drop("_part", "_l", "_next")


def running_index(df, keys, order, out="idx"):
    """Zero-based position inside the group, in order: the place in its part behind all rows of earlier parts."""
    df = ordered_parts(df, keys, order)
    before = (df.groupBy(*keys, "_part").agg(F.count("*").alias("_n"))
              .withColumn("_before", F.sum("_n").over(
                  Window.partitionBy(*keys).orderBy("_part")) - F.col("_n")).drop("_n"))
    local = F.row_number().over(Window.partitionBy(*keys, "_part").orderBy(*order)) - 1
    return (df.withColumn("_l", local).join(before, [*keys, "_part"])
            .withColumn(out, (F.col("_before") + F.col("_l")).cast("long"))
            .drop("_part", "_l", "_before"))


def last_n(df, key, order, n, rank="rn"):
    """Newest n rows per key; the rank limit runs before the shuffle."""
    keys = [key] if isinstance(key, str) else key
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= n)


def latest(df, key, order, cols):
    """Columns of the newest row per key, as a partial aggregate."""
    keys = [key] if isinstance(key, str) else key
    best = F.max_by(F.struct(*cols), F.struct(*order)).alias("_b")
    return df.groupBy(*keys).agg(best).select(*keys, "_b.*")


def pct_rank(df, part, ids, cols, negative=(), decimals=1, wide=True):
    """Percentile rank with average ties per group and metric, reversed for negative metrics.

    Works on the histogram of distinct values: equal values collapse before the shuffle, the histogram is dealt
    into even range partitions of (group, metric, value), and the share below a part comes from the parts' totals.
    Nulls stay null and do not count.
    """
    part = [part] if isinstance(part, str) else list(part)
    ids = [ids] if isinstance(ids, str) else list(ids)
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("metric"),
                                         F.col(c).cast("double").alias("value")) for c in cols]))
    long = df.select(*part, *[c for c in ids if c not in part], pairs.alias("_p")).select(
        *part, *[c for c in ids if c not in part], "_p.metric", "_p.value")
    key = [*part, "metric"]
    hist = long.filter(F.col("value").isNotNull()).groupBy(*key, "value").agg(F.count("*").alias("_n"))
    hist = ordered_parts(hist, key, ["value"], "histogram")
    slices = hist.groupBy(*key, "_part").agg(F.sum("_n").alias("_t"))
    grown = Window.partitionBy(*key).orderBy("_part")
    slices = slices.select(*key, "_part", (F.sum("_t").over(grown) - F.col("_t")).alias("_before"),
                           F.sum("_t").over(Window.partitionBy(*key)).alias("_all"))
    inside = Window.partitionBy(*key, "_part").orderBy("value")
    ranked = hist.withColumn("_below", F.sum("_n").over(inside) - F.col("_n")).join(slices, [*key, "_part"])
    up = F.col("_before") + F.col("_below") + (F.col("_n") + 1) / 2
    rank = F.when(F.col("metric").isin(list(negative)), F.col("_all") + 1 - up).otherwise(up) \
        if negative else up
    ranked = ranked.select(*key, "value", "_n", round_even(rank / F.col("_all") * 100, decimals).alias("pct"))
    long = join_counted(long, ranked, [*key, "value"], "pct")
    if not wide:
        return long
    return long.groupBy(*part, *[c for c in ids if c not in part]).agg(
        *[F.max(F.when(F.col("metric") == c, F.col("pct"))).alias(c) for c in cols])


def join_counted(df, counted, keys, value, share=HOT_VALUES, *, total=None):
    """Left join of ``value`` by keys to a table that knows how many rows (``_n``) each key has, ``total`` in all.

    Keys with more than one part in ``share`` of all rows, at most ``share`` of them, are sent to every task; rows
    that found theirs there are spread by hash in the join with the others, so no key is one task.
    """
    most = ((counted.agg(F.sum("_n")).first()[0] or 0) if total is None else total) // share
    hot = counted.filter(F.col("_n") > most).select(*keys, F.struct(F.col(value).alias("v")).alias("_hot"))
    rest = counted.filter(F.col("_n") <= most).select(*keys, F.lit(0).alias("_salt"), F.col(value).alias("_rest"))
    spread = F.pmod(F.xxhash64(*[c for c in df.columns if c not in keys] or keys), F.lit(1 << 20)).cast("int") + 1
    df = df.join(F.broadcast(hot), keys, "left")  # at most ``share`` rows
    df = df.withColumn("_salt", F.when(F.col("_hot").isNotNull(), spread).otherwise(0))
    df = df.join(rest, [*keys, "_salt"], "left")
    return df.withColumn(value, F.when(F.col("_hot").isNotNull(), F.col("_hot.v")).otherwise(F.col("_rest"))) \
        .drop("_hot", "_salt", "_rest")


def impute_group_mean(df, part, cols):
    """Null to the mean of the row's group; the means are a small aggregate joined back."""
    part = [part] if isinstance(part, str) else list(part)
    means = df.groupBy(*part).agg(*[F.avg(c).alias("_m_" + c) for c in cols])
    out = df.join(means, part, "left")
    return out.withColumns({c: F.coalesce(F.col(c).cast("double"), F.col("_m_" + c)) for c in cols}
                           ).drop(*["_m_" + c for c in cols])


def top_positions(df, key="Player", value="Position", k=3, names=("FirstPos", "SecondPos", "ThirdPos"),
                  groups=None):
    """Most frequent values per key as columns, and the group of the first."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(key, value).agg(F.count("*").alias("_n"))
    ranked = last_n(counts, key, [F.col("_n").desc(), F.col(value)], k, "_r")
    out = ranked.groupBy(key).agg(*[F.max(F.when(F.col("_r") == i + 1, F.col(value))).alias(n)
                                    for i, n in enumerate(names[:k])])
    if groups is not None:
        out = out.withColumn("MainPos", F.try_element_at(const_map(groups), F.col(names[0])))
    return out


def bucket_ratings(df, player="Player", date="Date", match="Match", rating="AdjustedRating",
                   days=14, anchor="2024-07-02", min_matches=10):
    """Mean rating and distinct matches per player and period, for players with enough matches.

    Periods are ``days`` long from a Tuesday anchor, so they end on a Monday.
    """
    d = F.col(date).cast("date")
    period = F.date_sub(d, F.pmod(F.datediff(d, F.lit(anchor).cast("date")), F.lit(days)))
    by_match = (df.withColumn("Period", period).groupBy(player, "Period", match)
                .agg(F.sum(rating).alias("_s"), F.count(rating).alias("_c")))
    out = by_match.groupBy(player, "Period").agg(
        F.count(match).alias("PlayedMatches"),
        (F.sum("_s") / F.sum("_c")).alias("MeanRating"))
    if min_matches:
        played = (df.select(player, match).distinct().groupBy(player)
                  .agg(F.count("*").alias("_n")).filter(F.col("_n") >= min_matches))
        out = out.join(played.drop("_n"), player, "left_semi")
    return out


def fill_periods(df, key="Player", period="Period", days=14, zero=("PlayedMatches",),
                 carry=("MeanRating",)):
    """Regular period grid from each key's first to last period; counts 0, means carried on.

    Rows per key are bounded by the calendar, so the per-key window stays small.
    """
    span = df.groupBy(key).agg(F.min(period).alias("_a"), F.max(period).alias("_b"))
    grid = span.select(key, F.explode(F.sequence("_a", "_b", F.expr(f"interval {days} days"))).alias(period))
    grid = grid.withColumn(period, F.col(period).cast("date"))
    out = grid.join(df, [key, period], "left")
    w = Window.partitionBy(key).orderBy(period).rowsBetween(Window.unboundedPreceding, 0)
    return out.withColumns({**{c: F.coalesce(F.col(c), F.lit(0)) for c in zero},
                            **{c: F.last(c, ignorenulls=True).over(w) for c in carry}})


def top_k(df, order, k):
    """Global first k rows: every task keeps k, one merge."""
    return df.orderBy(*order).limit(k)


def slot_limits(slots, key):
    """(largest slot, largest total plus largest slot) over the line-ups of a slot table."""
    total = slots.groupBy(key).agg(F.sum("n").alias("_all"), F.max("n").alias("_max"))
    most = total.agg(F.max("_max"), F.max(F.col("_all") + F.col("_max"))).first()
    return most[0] or 0, most[1] or 0


def pick_lineup(squad, slots, team="Team", player="Player", name="Name", position="Position",
                score="Score", limits=None):
    """Best players per formation slot, in slot order, nobody twice.

    ``slots`` has (team, slot, position, n).  At most the sum of all slots can be
    taken before a slot is filled, so only that many more names per position can
    matter: the exact pick needs a bounded list per team.
    """
    per_name, names = limits or slot_limits(slots, team)
    cand = squad.join(slots, [team, position])
    rank = [F.col(score).desc(), F.col(player)]
    # No slot takes more than per_name rows of one name, and of the best `names`
    # names at most that many minus the slot size are taken elsewhere.
    cand = last_n(cand, [team, position, name], rank, per_name, "_q")
    best = cand.filter("_q = 1").select(team, position, name, F.col(score).alias("_s"),
                                        F.col(player).alias("_p"))
    best = last_n(best, [team, position], [F.col("_s").desc(), F.col("_p")], names, "_q2")
    cand = cand.join(best.select(team, position, name), [team, position, name], "left_semi")
    cand = cand.withColumn("_r", F.row_number().over(
        Window.partitionBy(team, position).orderBy(*rank)))
    cand = cand.select(team, "slot", position, "n", player, name, "_r")

    def pick(pdf):
        cols = [team, "slot", position, player, name, "_r", "n"]
        taken, rows = set(), []
        order = sorted(zip(*(pdf[c].tolist() for c in cols)), key=lambda r: (r[1], r[5]))
        for slot in sorted(set(r[1] for r in order)):
            free = [r for r in order if r[1] == slot and r[4] not in taken]
            best = free[:int(free[0][6])] if free else []
            taken.update(r[4] for r in best)
            rows += [r[:6] for r in best]
        return pd.DataFrame(rows, columns=cols[:6])

    schema = ", ".join(f"`{c}` {cand.schema[c].dataType.simpleString()}"
                       for c in (team, "slot", position, player, name, "_r"))
    # Few bytes but a call per team: spread them before the size-based merge.
    cand = cand.repartition(int(cand.sparkSession.conf.get("spark.sql.shuffle.partitions")), team)
    return cand.groupBy(team).applyInPandas(pick, schema).withColumnRenamed("_r", "rank")


def team_lineups(matches, players, player_stats, team_stats, slots, coords, season):
    """Line-up with slot and mean pass coordinates for every team of a season."""
    from .aggregate import mode_min
    played = matches.filter(F.col("Season").cast("string") == str(season)).select(
        F.col("ID").alias("Match"))
    stats = impute_group_mean(
        player_stats.select("Match", "Team", "Player", "Position", "MinutesPlayed",
                            "PassMeanX", "PassMeanY"), "Position", ["PassMeanX", "PassMeanY"])
    stats = stats.join(played, "Match", "left_semi").join(
        players.select(F.col("ID").alias("Player"), "Name"), "Player")
    squad = stats.groupBy("Team", "Player", "Name", "Position").agg(
        F.sum("MinutesPlayed").alias("MinutesPlayed"), F.avg("PassMeanX").alias("PassMeanX"),
        F.avg("PassMeanY").alias("PassMeanY"))
    total = squad.groupBy("Team", "Name").agg(F.sum("MinutesPlayed").alias("TotalMinutes"))
    squad = squad.join(total, ["Team", "Name"]).withColumn(
        "Score", 0.7 * F.col("TotalMinutes") + 0.3 * F.col("MinutesPlayed"))
    formation = mode_min(team_stats.join(played, "Match", "left_semi"), ["Team"], "Formation")
    per_slot = slots.select(F.col("formation").alias("Formation"), "slot",
                            F.col("position").alias("Position"), "n")
    wanted = formation.join(per_slot, "Formation").select("Team", "slot", "Position", "n")
    lineup = pick_lineup(squad, wanted, limits=slot_limits(slots, "formation"))
    lineup = lineup.withColumn("idx", F.row_number().over(
        Window.partitionBy("Team", "Position").orderBy("rank")) - 1)
    xy = coords.select(F.col("formation").alias("Formation"), F.col("position").alias("Position"),
                       "idx", "x", "y")
    return (lineup.join(formation, "Team").join(xy, ["Formation", "Position", "idx"], "left")
            .join(squad.select("Team", "Player", "Position", "PassMeanX", "PassMeanY"),
                  ["Team", "Player", "Position"], "left")
            .select("Team", "Formation", "slot", "idx", "Position", "Player", "Name",
                    F.col("x").alias("X"), F.col("y").alias("Y"), "PassMeanX", "PassMeanY"))


def dedupe_best(df, key, id_col, priority, order):
    """Best row per key, and the id map from every row to its winner.

    The winner is a partial aggregate; the map is a join of rows to winners, so a
    large group of copies is never collected.
    """
    prio = F.struct(*[p.alias(f"p{i}") for i, p in enumerate(priority)],
                    *[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])
    winner = df.groupBy(*key).agg(F.min_by(F.struct(*df.columns), prio).alias("_w"))
    best = winner.select("_w.*")
    ids = df.select(*key, F.col(id_col).alias("id")).join(
        winner.select(*key, F.col("_w")[id_col].alias("main")), key)
    return best, ids.select("id", "main")
