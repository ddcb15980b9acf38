"""Projections, filters, column reshaping and set operations."""

from functools import reduce

from pyspark.sql import functions as F, Window

from ..config import lookups as lk
from ..functions.numeric import _col, text_number
from ..functions.pitch import SHOT_TYPES, pass_direction, pitch_length, shot_length


def const_map(values):
    """Map literal of a fixed, small dictionary."""
    return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])


def conform(df, rename, order, types=None, default="double"):
    """Rename, add missing columns as null, cast with errors to null, keep a fixed order."""
    df = df.withColumnsRenamed(rename)
    types = types or {}
    present = {f.name: f.dataType.typeName() for f in df.schema.fields}
    out = []
    for c in order:
        t = types.get(c, default)
        source = F.col(f"`{c}`") if c in present else F.lit(None)
        number = present.get(c) == "string" and t not in ("string", "date", "timestamp", "boolean")
        out.append((text_number(source, t) if number else source.try_cast(t)).alias(c))
    return df.select(out)


def coalesce_columns(df, cols_map, keep=()):
    """First non-null among the candidate columns that exist; null if none does."""
    present = set(df.columns)
    out = [F.col(c) for c in keep]
    for target, candidates in cols_map.items():
        found = [F.col(c) for c in candidates if c in present]
        out.append((F.coalesce(*found) if found else F.lit(None).cast("string")).alias(target))
    return df.select(out)


def greatest_of(df, cols_map, keep=()):
    """Numeric cast with errors to null, then the largest of the sources, ignoring nulls."""
    present = {f.name: f.dataType.typeName() for f in df.schema.fields}
    out = [F.col(c) for c in keep]
    for target, candidates in cols_map.items():
        found = [text_number(c) if present[c] == "string" else F.col(c).try_cast("double")
                 for c in candidates if c in present]
        best = F.greatest(*found) if len(found) > 1 else found[0] if found else F.lit(None)
        out.append(best.cast("double").alias(target))
    return df.select(out)


def suffix(df, keys, sfx):
    """Add a suffix to all but the key columns."""
    return df.select([F.col(c) if c in keys else F.col(c).alias(c + sfx) for c in df.columns])


def to_team_rows(matches, match="ID", home="HomeTeam", away="AwayTeam", home_score="HomeScore",
                 away_score="AwayScore", home_elo=None, away_elo=None, keep=()):
    """Each match as one row per side, in one scan."""
    def side(flag, team, opp, score, opp_score, elo, opp_elo):
        fields = [F.lit(flag).alias("HomeAway"), F.col(team).alias("Team"),
                  F.col(opp).alias("Opponent"), F.col(score).alias("Score"),
                  F.col(opp_score).alias("OpponentScore")]
        if home_elo:
            fields += [F.col(elo).alias("Elo"), F.col(opp_elo).alias("OpponentElo")]
        return F.struct(*fields)

    rows = matches.select(
        F.col(match).alias("Match"), *keep,
        F.explode(F.array(side("Home", home, away, home_score, away_score, home_elo, away_elo),
                          side("Away", away, home, away_score, home_score, away_elo, home_elo),
                          )).alias("s"))
    diff = F.col("Score") - F.col("OpponentScore")
    out = rows.select("Match", *keep, "s.*")
    out = out.withColumns({
        "ScoreDiff": diff,
        "Result": F.when(diff > 0, 1).when(diff < 0, -1).otherwise(0),
        "ResultText": F.when(diff > 0, "Win").when(diff < 0, "Loss").otherwise("Draw"),
    })
    if home_elo:
        out = out.withColumn("EloDiff", F.col("Elo") - F.col("OpponentElo"))
    return out


def resolve_position(df, main="positionSW", side="position_sideSW", fallback="positionSS",
                     mapping=None, out="Position"):
    """Second provider's position and side, unless blank or Substitute; then canonical name."""
    present = set(df.columns)
    text = (F.trim(F.coalesce(F.col(main).cast("string"), F.lit("")))
            if main in present else F.lit(""))
    flank = (F.trim(F.coalesce(F.nullif(F.col(side).cast("string"), F.lit("0")), F.lit("")))
             if side in present else F.lit(""))
    other = F.col(fallback).cast("string") if fallback in present else F.lit(None).cast("string")
    raw = F.when(text.isin("", "Substitute"), other).otherwise(F.trim(F.concat_ws(" ", text, flank)))
    names = const_map(lk.POSITIONS if mapping is None else mapping)
    return df.withColumn(out, F.try_element_at(names, F.coalesce(raw, F.lit("Unknown"))))


def map_by_formation(df, formation_map, formation="Formation", position="Position",
                     canonical=None, order="position"):
    """Position by (formation, raw position), then the formation it is counted as.

    Of several positions for a pair the last by the column ``order`` of the map wins.
    """
    lookup = formation_map.groupBy(F.col("formation").alias(formation), F.col("raw_position").alias(position)).agg(
        F.max_by(F.col("position"), F.col(order)).alias("_mapped"))
    names = const_map(lk.FORMATIONS if canonical is None else canonical)
    return (df.join(lookup, [formation, position], "left")
            .withColumn(position, F.col("_mapped")).drop("_mapped")
            .withColumn(formation, F.try_element_at(names, F.col(formation))))


def repair_colours(df, white="#ffffff", dark="#919191"):
    """Fill kit colours, swap a white primary, take the first other colour, else a dark one."""
    primary, secondary = F.col("PrimaryColour"), F.col("SecondaryColour")
    kits = ["HomeKitCol1", "HomeShortsCol", "AwayKitCol1", "AwayShortsCol"]
    df = df.withColumns({c: F.coalesce(F.col(c), primary) for c in kits})
    swap = F.lower(primary) == white
    df = df.withColumns({"PrimaryColour": F.when(swap, secondary).otherwise(primary),
                         "SecondaryColour": F.when(swap, primary).otherwise(secondary)})
    others = F.array("SecondaryColour", "HomeKitCol1", "HomeKitCol2", "HomeShortsCol",
                     "AwayKitCol1", "AwayKitCol2", "AwayShortsCol")
    first = F.try_element_at(F.filter(others, lambda c: c.isNotNull() & (c != white)), F.lit(1))
    chosen = F.when(F.lower(primary) == white, F.coalesce(first, primary)).otherwise(primary)
    return df.withColumn("PrimaryColour", F.when(chosen == white, dark).otherwise(chosen))


def split_name(df, name="Name", first="FirstName", last="LastName"):
    """If both parts are null: last word to last name, the rest to first name."""
    words = F.split(F.trim(F.col(name)), r"\s+")
    missing = F.col(first).isNull() & F.col(last).isNull() & F.col(name).isNotNull()
    rest = F.array_join(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), " ")
    return df.withColumns({
        first: F.when(missing, rest).otherwise(F.col(first)),
        last: F.when(missing, F.element_at(words, -1)).otherwise(F.col(last)),
    })


def min_sample(df, col, n, strict=False):
    """Rows whose sample is known and at least n (or above n)."""
    return df.filter(F.col(col) > n if strict else F.col(col) >= n)


def exact_group_size(df, keys, n):
    """Rows of groups with exactly n rows: counts are pre-aggregated, then semi-joined."""
    sized = df.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") == n)
    return df.join(sized.drop("_n"), list(keys), "left_semi")


def season_filter(matches, season, col="Season"):
    return matches.filter(F.col(col).cast("string") == F.lit(str(season)))


def team_tournaments(matches, top=None, names=None, home="HomeTeam", away="AwayTeam",
                     league="League"):
    """Sorted competition names of each team that plays in at least one top league."""
    top = lk.TOP_LEAGUES if top is None else top
    names = const_map(lk.LEAGUE_NAMES if names is None else names)
    played = matches.select(F.explode(F.array(home, away)).alias("Team"),
                            F.col(league).alias("League")).distinct()
    grouped = played.groupBy("Team").agg(
        F.array_sort(F.collect_set("League")).alias("_codes"))   # competitions are few
    wanted = F.array(*[F.lit(x) for x in top])
    return (grouped.filter(F.arrays_overlap("_codes", wanted))
            .select("Team", F.transform("_codes", lambda c: F.coalesce(
                F.try_element_at(names, c), c)).alias("Tournaments")))


def relevant_stats(df, allowed, stats="Stats", out="AggregatedStats"):
    """Keep the entries of a stats map that are in the allowed array and not zero."""
    return df.withColumn(out, F.map_filter(
        F.col(stats), lambda k, v: F.array_contains(_col(allowed), k) & (v != 0)))


def position_columns(df, pos_cols, positions=("FirstPos", "SecondPos", "ThirdPos"), out="Allowed"):
    """Union of the metric lists of up to three positions; ``pos_cols`` is a small dict."""
    table = F.create_map(*[x for p, cols in pos_cols.items()
                           for x in (F.lit(p), F.array(*[F.lit(c) for c in cols]))])
    lists = [F.coalesce(F.try_element_at(table, F.col(p)), F.array().cast("array<string>"))
             for p in positions]
    return df.withColumn(out, reduce(F.array_union, lists))


def prune_text(c):
    """Blank text to null."""
    return F.when(F.trim(_col(c)) != "", _col(c))


def _pruned(c, dtype):
    """Expression without NaN, blank text, empty arrays, maps and structs, at any depth."""
    kind = dtype.typeName()
    if kind == "string":
        return prune_text(c)
    if kind in ("double", "float"):
        return F.when(~F.isnan(c), c)
    if kind == "array":
        kept = F.filter(F.transform(c, lambda x: _pruned(x, dtype.elementType)),
                        lambda x: x.isNotNull())
        return F.when(F.size(kept) > 0, kept)
    if kind == "map":
        kept = F.map_filter(F.transform_values(c, lambda k, v: _pruned(v, dtype.valueType)),
                            lambda k, v: v.isNotNull())
        return F.when(F.size(kept) > 0, kept)
    if kind == "struct":
        parts = {f.name: _pruned(c[f.name], f.dataType) for f in dtype.fields}
        some = reduce(lambda x, y: x | y, [p.isNotNull() for p in parts.values()])
        return F.when(some, F.struct(*[p.alias(n) for n, p in parts.items()]))
    return c


def prune(df, id_cols=()):
    """Null out everything empty, recursively; ``to_json`` then drops the fields."""
    return df.select([F.col(f.name) if f.name in id_cols
                      else _pruned(F.col(f.name), f.dataType).alias(f.name)
                      for f in df.schema.fields])


def drop_constant_columns(df, cols, keep=()):
    """Drop columns with one distinct value (null counts as one) or with any null.

    One aggregation pass: min, max and null count tell both, without distinct sets.
    """
    aggs = []
    for c in cols:
        aggs += [F.min(c).alias("lo_" + c), F.max(c).alias("hi_" + c),
                 F.count_if(F.col(c).isNull()).alias("nulls_" + c)]
    row = df.agg(*aggs).first()
    good = [c for c in cols if row["nulls_" + c] == 0 and row["lo_" + c] != row["hi_" + c]]
    return df.select(*keep, *good)


def pass_map(events, teams=None, players=None):
    """Passes with a next actor, receivers only for accurate ones, direction and length."""
    from .joins import map_column
    df = events.filter((F.col("Type") == "Pass") & F.col("next_player").isNotNull())
    if teams is not None:
        df = map_column(df, "team", teams)
    if players is not None:
        df = map_column(map_column(df, "player", players), "next_player", players)
    num = {"IniX": "x", "IniY": "y", "EndX": "Pass End X", "EndY": "Pass End Y",
           "Angle": "Angle", "Length": "Length"}
    df = df.select(F.col("match").alias("Match"), F.col("team").alias("Team"),
                   F.col("player").alias("Player"),
                   F.when(F.col("outcome") != 0, F.col("next_player")).alias("PassReceiver"),
                   F.col("outcome").alias("AccuratePass"),
                   *[F.col(f"`{c}`").try_cast("double").alias(n) for n, c in num.items()],
                   F.col("Zone").alias("Zone"))
    return df.withColumns({
        "PassDirection": pass_direction(F.col("EndX") - F.col("IniX"),
                                        F.col("EndY") - F.col("IniY")),
        "Length": pitch_length("IniX", "IniY", "EndX", "EndY"),
    })


def shot_map(events, teams=None, players=None):
    """Shots of four types with numeric coordinates and the distance to goal."""
    from .joins import map_column
    df = events.filter(F.col("Type").isin(SHOT_TYPES))
    if teams is not None:
        df = map_column(df, "team", teams)
    if players is not None:
        df = map_column(df, "player", players)
    num = {"IniX": "x", "IniY": "y", "BlockX": "Blocked X Coordinate",
           "BlockY": "Blocked Y Coordinate", "GoalY": "Goal Mouth Y Coordinate",
           "GoalZ": "Goal Mouth Z Coordinate"}
    df = df.select(F.col("match").alias("Match"), F.col("team").alias("Team"),
                   F.col("player").alias("Player"), "Type",
                   *[F.col(f"`{c}`").try_cast("double").alias(n) for n, c in num.items()],
                   F.col("Zone").alias("Zone"))
    return df.withColumn("Length", shot_length("IniX", "IniY", "GoalY"))


def fallback_positions(players, codes=None, groups=None):
    """Positions of players without matches: profile names to codes and a main group."""
    codes = const_map(lk.POSITION_CODES if codes is None else codes)
    groups = const_map(lk.MAIN_POSITION if groups is None else groups)
    df = players.withColumns({p: F.try_element_at(codes, F.col(p))
                              for p in ("FirstPos", "SecondPos", "ThirdPos")})
    df = df.withColumn("MainPos", F.try_element_at(groups, F.col("FirstPos")))
    df = df.filter(F.col("FirstPos").isNotNull() | F.col("Position").isNotNull())
    df = df.withColumn("FirstPos", F.coalesce("FirstPos", F.try_element_at(codes, F.col("Position"))))
    return df.withColumn("MainPos", F.coalesce("MainPos", "FirstPos"))


def publish(df, cols, teams, team="Team", team_id="Team"):
    """Fixed columns of the rows whose team is published."""
    wanted = teams.select(F.col(team_id).alias(team)).distinct()
    return df.join(wanted, team, "left_semi").select(cols)


def union_all(dfs):
    """Concatenate frames whose columns differ; missing columns are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def dedup(df, cols, order):
    """First row per key in an explicit order (the rank limit is applied before the shuffle)."""
    w = Window.partitionBy(*cols).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def overlap_flag(a, b, groups=None):
    """1 if two arrays share an element after mapping to groups, else 0."""
    a, b = _col(a), _col(b)
    if groups:
        table = const_map(groups)
        a = F.transform(a, lambda x: F.try_element_at(table, x))
        b = F.transform(b, lambda x: F.try_element_at(table, x))
    empty = F.array().cast("array<string>")
    return F.coalesce(F.arrays_overlap(F.coalesce(a, empty), F.coalesce(b, empty)),
                      F.lit(False)).cast("int")


def one_hot(df, cols, levels=None, prefix_sep="_"):
    """0/1 column per level of each category.

    Levels not given are found by one distinct; they become column names, so a category has as many as a schema holds.
    """
    out = [F.col(c) for c in df.columns if c not in cols]
    for c in cols:
        found = (levels or {}).get(c)
        if found is None:
            found = [r[0] for r in df.select(c).filter(F.col(c).isNotNull()).distinct().orderBy(c).collect()]
        out += [F.coalesce((F.col(c) == F.lit(v)).cast("int"), F.lit(0)).alias(f"{c}{prefix_sep}{v}")
                for v in found]
    return df.select(out)
