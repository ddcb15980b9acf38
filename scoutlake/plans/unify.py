"""Unify job: raw documents of both providers to one schema."""

from pyspark.sql import functions as F

from ..config import lookups as lk
from ..functions.text import normalize_name, stable_id
from ..operators import resolve as res
from ..operators.aggregate import teams_per_league
from ..operators.joins import map_column, outer_match
from ..operators.shape import coalesce_columns, conform, const_map
from ..session import job, materialize
from ..sources import raw
from ..sources.tables import write_table

# Target column and its sources in order of preference.
TEAM_COLUMNS = {
    "Name": ["NameSS", "NameSW"], "ShortName": ["ShortNameSS", "ShortNameSW"],
    "LongName": ["LongNameSS", "LongNameSW"], "Abbreviation": ["AbbreviationSW"],
    "Country": ["CountrySS"], "FoundationDate": ["FoundationDateSS"], "Manager": ["ManagerSS"],
    "Venue": ["VenueSS"], "PrimaryColour": ["PrimaryColourSS"],
    "SecondaryColour": ["SecondaryColourSS"], "TextColour": ["TextColourSS"],
    "HomeKitCol1": ["HomeKitCol1SW"], "HomeKitCol2": ["HomeKitCol2SW"],
    "HomeShortsCol": ["HomeShortsColSW"], "AwayKitCol1": ["AwayKitCol1SW"],
    "AwayKitCol2": ["AwayKitCol2SW"], "AwayShortsCol": ["AwayShortsColSW"],
    "IdSS": ["IdSS"], "IdSW": ["IdSW"],
}
PERSON_COLUMNS = {
    "Name": ["NameSS", "NameSW"], "ShortName": ["ShortNameSW"], "FirstName": ["FirstNameSW"],
    "LastName": ["LastNameSW"], "ShortFirstName": ["ShortFirstNameSW"],
    "ShortLastName": ["ShortLastNameSW"], "MatchName": ["ShortNameSS", "MatchNameSW"],
    "Country": ["CountrySS", "CountrySW"], "DateBirth": ["DateBirthSS"],
}
PLAYER_COLUMNS = {
    **PERSON_COLUMNS, "Height": ["HeightSS"], "PrefFoot": ["PrefFootSS"], "Position": ["PositionSW"],
    "FirstPos": ["FirstPositionSS"], "SecondPos": ["SecondPositionSS"],
    "ThirdPos": ["ThirdPositionSS"], "ContractUntil": ["ContractUntilSS"],
    "MarketValue": ["MarketValueSS"], "IdSS": ["IdSS"], "IdSW": ["IdSW"],
}
MANAGER_COLUMNS = {
    **PERSON_COLUMNS, "Type": ["TypeSW"], "Matches": ["MatchesSS"], "Wins": ["WinsSS"],
    "Draws": ["DrawsSS"], "Losses": ["LossesSS"], "GoalsFor": ["GoalsForSS"],
    "GoalsAgainst": ["GoalsAgainstSS"], "Points": ["PointsSS"], "IdSS": ["IdSS"], "IdSW": ["IdSW"],
}
MATCH_COLUMNS = {
    "League": ["League"], "Season": ["Season"], "Round": ["RoundSS"], "HomeTeam": ["HomeTeam"],
    "AwayTeam": ["AwayTeam"], "Date": ["DateSS", "DateSW"], "Time": ["TimeSS", "TimeSW"],
    "Venue": ["VenueSS"], "Referee": ["RefereeSS"], "HomeScore": ["HomeScoreSS"],
    "AwayScore": ["AwayScoreSS"], "IdSS": ["IdSS"], "IdSW": ["IdSW"],
}
# Texts that duplicates share.
DUPLICATE_TEXTS = ["Slug", "Name", "ShortName", "LongName", "Country"]


def _normalized(df, cols):
    return df.withColumns({c: normalize_name(c) for c in cols})


def unify_teams(first_matches, second_matches, first, second):
    """Teams matched inside each league, both leftovers, duplicates merged."""
    names = ["Slug", "Name", "ShortName", "LongName"]

    def side(teams, matches, id_col):
        league = teams_per_league(matches).select("League", F.col("Team").cast("string").alias(id_col))
        teams = teams.withColumn(id_col, F.col(id_col).cast("string"))
        return _normalized(teams.join(league, id_col), names)

    found = res.fuzzy_match(side(first, first_matches, "IdSS"), side(second, second_matches, "IdSW"),
                            names, 75, block="League")
    pairs = res.with_leftovers(res.one_partner(found.select("IdSS", "IdSW").distinct()), first, second)
    teams = res.unify_entity(first, second, pairs, TEAM_COLUMNS, "team")
    return res.merge_duplicates(teams, "ID", DUPLICATE_TEXTS, ["IdSS", "IdSW"], weak=["Country"]).drop("conflict")


def _people(first, second, columns, kind, threshold, block=None):
    a = first.withColumn("IdSS", F.col("IdSS").cast("string"))
    b = second.withColumn("ShortName", F.col("MatchName"))
    fields = ["Slug", "Name", "ShortName"]
    keep = [block] if block else []
    a = _normalized(a.select("IdSS", *fields, *keep).distinct(), fields[1:])
    b = _normalized(b.select("IdSW", *fields, *keep).distinct(), fields[1:])
    found = res.fuzzy_match(a, b, fields, threshold, block=block)
    pairs = res.with_leftovers(found, first, second)
    return res.unify_entity(first, second, pairs, columns, kind).withColumn(
        "LongName", F.concat("FirstName", F.lit(" "), "LastName"))


def unify_players(first, second, teams):
    """Players matched inside each unified team, positions to canonical names."""
    def team(df, provider):
        ids = teams.select(F.col(provider).cast("string").alias("key"), F.col("ID").alias("value"))
        return map_column(df.withColumn("block", F.col("Team").cast("string")), "block", ids)

    df = _people(team(first, "IdSS"), team(second, "IdSW"), PLAYER_COLUMNS, "player", 90, "block")
    names = const_map(lk.POSITIONS)
    return df.withColumns({c: F.try_element_at(names, F.col(c))
                           for c in ("Position", "FirstPos", "SecondPos", "ThirdPos")})


def unify_managers(first, second):
    df = _people(first, second, MANAGER_COLUMNS, "manager", 90)
    return res.merge_duplicates(df, "ID", DUPLICATE_TEXTS, ["IdSS", "IdSW"], weak=["Country"]).drop("conflict")


def unify_matches(first, second, teams):
    """Matches of both providers by league, season, home and away team."""
    keys = ["League", "Season", "HomeTeam", "AwayTeam"]

    def side(df, provider):
        ids = teams.select(F.col(provider).cast("string").alias("key"), F.col("ID").alias("value"))
        for c in ("HomeTeam", "AwayTeam"):
            df = map_column(df.withColumn(c, F.col(c).cast("string")), c, ids)
        return df

    a = side(first, "IdSS").withColumn("IdSS", F.col("IdSS").cast("string"))
    b = side(second, "IdSW").withColumnRenamed("IdSW", "Id")
    joined = outer_match(a, b, keys, "IdSS", "IdSW")
    df = coalesce_columns(joined, MATCH_COLUMNS)
    return df.withColumn("ID", stable_id(F.lit("match"), "IdSS", "IdSW"))


def team_statistics(team_stats, sides, matches, teams, managers):
    """Conformed team statistics in internal ids with manager, formation and average age."""
    columns = lk.team_stat_columns()
    df = conform(team_stats, {**columns, "team": "Team", "formation": "Formation"},
                 ["Match", "Team", "Formation", *columns.values()],
                 {"Match": "string", "Team": "string", "Formation": "string"})

    def ids(frame, provider):
        return frame.select(F.col(provider).cast("string").alias("key"), F.col("ID").alias("value"))

    df = map_column(map_column(df, "Match", ids(matches, "IdSS")), "Team", ids(teams, "IdSS"))
    extra = sides.select("Match", F.col("team").alias("Team"), "AverageAge", "Manager")
    extra = map_column(map_column(extra, "Match", ids(matches, "IdSW")), "Team", ids(teams, "IdSW"))
    extra = map_column(extra, "Manager", ids(managers, "IdSW"))
    return df.filter("Match IS NOT NULL").join(extra, ["Match", "Team"], "left")


def run_unify(spark, raw_root, out, as_of, seasons=("2425", "2526")):
    """Read all raw documents, resolve entities, write the unified tables."""
    with job(spark, "unify", raw_root, out, as_of, seasons):
        return _run(spark, raw_root, out, as_of, seasons)


def _run(spark, raw_root, out, as_of, seasons):
    root = f"{raw_root}/competitions"
    managers_1, teams_1, players_1 = (
        raw.scan_entities(spark, f"{raw_root}/entities/{k}/*.json", k) for k in ("manager", "team", "player"))
    matches_1 = materialize(raw.scan_matches(spark, root, seasons), "matches")
    players_2, staff_2 = raw.scan_squads(spark, root, seasons)
    teams_2 = raw.scan_teams(spark, root, seasons)
    matches_2 = materialize(raw.scan_calendar(spark, root, as_of, seasons), "calendar")

    teams = materialize(unify_teams(matches_1, matches_2, teams_1, teams_2), "teams")
    players = materialize(unify_players(players_1, players_2, teams), "players")
    managers = materialize(unify_managers(managers_1, staff_2), "managers")
    matches = materialize(unify_matches(matches_1, matches_2, teams), "matches")

    sources = lk.player_sources()
    keys_1 = sorted({c[:-2] for cols in sources.values() for c in cols if c.endswith("SS")})
    keys_2 = sorted({c[:-2] for cols in sources.values() for c in cols if c.endswith("SW")})
    team_stats, lines_1 = raw.match_stats(spark, root, matches_1, keys_1, seasons=seasons)
    docs = raw.scan_kv_lineups(spark, root, matches_2, seasons)
    player_stats = res.unify_stats(lines_1, raw.unfold_kv_lineups(docs, keys_2), matches, teams, players)
    team_stats = team_statistics(team_stats, raw.lineup_sides(docs), matches, teams, managers)

    for name, df in (("team", teams), ("player", players), ("manager", managers), ("match", matches),
                     ("player_stats", player_stats), ("team_stats", team_stats)):
        write_table(df, f"{out}/unified/{name}")
    return f"{out}/unified"
