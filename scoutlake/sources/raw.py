"""Raw JSON of the two providers and the event feed.

Every source is split in two: a scan that reads files with a declared schema,
and a function from the parsed frame to rows, which also runs on JSON held in a
column.  Broken documents are dropped by the reader.
"""

from pyspark.sql import functions as F

from ..config import lookups as lk
from ..functions.dates import epoch_date
from ..functions.numeric import text_number
from ..functions.text import slug
from ..operators.aggregate import pivot_qualifiers
from ..operators.shape import const_map
from ..operators.windows import next_actor
from ..session import materialize

# Folder names of the two match-data providers under <league>/<season>.
FIRST, SECOND = "sofascore", "scoresway"

MANAGER = """manager STRUCT<id BIGINT, name STRING, shortName STRING, country STRUCT<name STRING>,
 dateOfBirthTimestamp BIGINT, performance STRUCT<total INT, wins INT, draws INT, losses INT,
 goalsScored INT, goalsConceded INT, totalPoints INT>>"""
TEAM = """team STRUCT<id BIGINT, name STRING, shortName STRING, fullName STRING,
 manager STRUCT<id BIGINT>, venue STRUCT<id BIGINT>, country STRUCT<name STRING>,
 foundationDateTimestamp BIGINT, teamColors STRUCT<primary STRING, secondary STRING, text STRING>>"""
PLAYER = """player STRUCT<id BIGINT, name STRING, shortName STRING, team STRUCT<id BIGINT>,
 positionsDetailed ARRAY<STRING>, shirtNumber INT, height INT, preferredFoot STRING,
 dateOfBirthTimestamp BIGINT, country STRUCT<name STRING>, contractUntilTimestamp BIGINT,
 proposedMarketValue BIGINT>"""
MATCH = """event STRUCT<id BIGINT, roundInfo STRUCT<round INT>, winnerCode INT, attendance INT,
 venue STRUCT<id BIGINT>, referee STRUCT<name STRING>,
 homeTeam STRUCT<id BIGINT, manager STRUCT<id BIGINT>>,
 awayTeam STRUCT<id BIGINT, manager STRUCT<id BIGINT>>,
 homeScore STRUCT<display INT>, awayScore STRUCT<display INT>, startTimestamp BIGINT>"""
MATCH_STATS = """statistics ARRAY<STRUCT<groups ARRAY<STRUCT<statisticsItems ARRAY<STRUCT<
 key STRING, homeValue DOUBLE, awayValue DOUBLE>>>>>>"""
SQUADS = """squad ARRAY<STRUCT<contestantId STRING, contestantName STRING, contestantShortName STRING,
 contestantClubName STRING, contestantCode STRING,
 teamKits STRUCT<kit ARRAY<STRUCT<type STRING, shirtColour1 STRING, shirtColour2 STRING, shortsColour1 STRING>>>,
 person ARRAY<STRUCT<id STRING, type STRING, firstName STRING, lastName STRING, shortFirstName STRING,
 shortLastName STRING, matchName STRING, nationality STRING, position STRING, shirtNumber INT>>>>"""
CALENDAR = """match ARRAY<STRUCT<matchInfo STRUCT<id STRING, date STRING, time STRING,
 contestant ARRAY<STRUCT<id STRING>>>>>"""
KV_LINEUPS = """liveData STRUCT<lineUp ARRAY<STRUCT<averageAge DOUBLE, teamOfficial ARRAY<STRUCT<id STRING>>,
 player ARRAY<STRUCT<playerId STRING, shirtNumber INT, position STRING, positionSide STRING,
 stat ARRAY<STRUCT<type STRING, value STRING>>>>>>>"""
EVENTS = """liveData STRUCT<event ARRAY<STRUCT<id BIGINT, typeId INT, periodId INT, timeMin INT, timeSec INT,
 contestantId STRING, playerId STRING, outcome INT, x DOUBLE, y DOUBLE,
 qualifier ARRAY<STRUCT<qualifierId INT, value STRING>>>>>"""


def lineups_schema(keys):
    """Line-up documents with the wanted statistics as numbers; other kinds of values read as null."""
    stats = ", ".join(f"`{k}` DOUBLE" for k in keys)
    side = f"""STRUCT<formation STRING, players ARRAY<STRUCT<player STRUCT<id BIGINT>,
 shirtNumber STRING, position STRING, statistics STRUCT<{stats}>>>>"""
    return f"home {side}, away {side}"


def read_json(spark, path, schema):
    """One JSON object per file, with the file path; files that do not parse are dropped."""
    df = (spark.read.schema(schema + ", _broken STRING").option("multiLine", True)
          .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_broken")
          .json(path).select("*", F.col("_metadata.file_path").alias("path")))
    filled = F.coalesce(*[F.col(n).isNotNull() for n in df.columns if n not in ("_broken", "path")])
    return df.filter(F.col("_broken").isNull() & filled).drop("_broken")


def parse_json(df, col, schema, keep=()):
    """The same rows from JSON text in a column.

    The document is generated as a one-row list, so that filters and projections
    after it do not parse it again.
    """
    doc = F.array(F.from_json(col, schema, {"mode": "PERMISSIVE"}))
    return df.select(*keep, F.explode(doc).alias("_j")).select(*keep, "_j.*")


def path_part(index_from_end):
    """Directory name counted from the file, 1 is the folder the file is in."""
    return F.element_at(F.split("path", "/"), -1 - index_from_end)


def file_stem():
    """Name of a document <name>.json, which may be a file or a folder, as Spark writes one for each value of a column."""
    return F.regexp_extract("path", r"([^/=]+)\.json(?:/[^/]*)?$", 1)


# -- entity documents ---------------------------------------------------------

def managers(df):
    m = df.filter("manager IS NOT NULL").select("manager.*")
    return m.select(
        F.col("id").alias("IdSS"), slug("name").alias("Slug"), F.col("name").alias("Name"),
        F.col("shortName").alias("ShortName"), F.col("country.name").alias("Country"),
        epoch_date("dateOfBirthTimestamp").alias("DateBirth"),
        *[F.col("performance." + k).cast("long").alias(v) for k, v in (
            ("total", "Matches"), ("wins", "Wins"), ("draws", "Draws"), ("losses", "Losses"),
            ("goalsScored", "GoalsFor"), ("goalsConceded", "GoalsAgainst"),
            ("totalPoints", "Points"))]).distinct()


def teams(df):
    t = df.filter("team IS NOT NULL").select("team.*")
    return t.select(
        F.col("id").alias("IdSS"), slug("name").alias("Slug"), F.col("name").alias("Name"),
        F.col("shortName").alias("ShortName"), F.col("fullName").alias("LongName"),
        F.col("manager.id").alias("Manager"), F.col("venue.id").alias("Venue"),
        F.col("country.name").alias("Country"),
        epoch_date("foundationDateTimestamp").alias("FoundationDate"),
        F.col("teamColors.primary").alias("PrimaryColour"),
        F.col("teamColors.secondary").alias("SecondaryColour"),
        F.col("teamColors.text").alias("TextColour")).distinct()


def players(df):
    p = df.filter("player IS NOT NULL").select("player.*")
    nth = [F.get("positionsDetailed", F.lit(i)) for i in range(3)]
    return p.select(
        F.col("id").alias("IdSS"), slug("name").alias("Slug"), F.col("name").alias("Name"),
        F.col("shortName").alias("ShortName"), F.col("team.id").alias("Team"),
        nth[0].alias("FirstPosition"), nth[1].alias("SecondPosition"), nth[2].alias("ThirdPosition"),
        F.col("shirtNumber").alias("ShirtNum"), F.col("height").alias("Height"),
        F.col("preferredFoot").alias("PrefFoot"), epoch_date("dateOfBirthTimestamp").alias("DateBirth"),
        F.col("country.name").alias("Country"), epoch_date("contractUntilTimestamp").alias("ContractUntil"),
        F.col("proposedMarketValue").alias("MarketValue")).distinct()


_ENTITIES = {"manager": (MANAGER, managers), "team": (TEAM, teams), "player": (PLAYER, players)}


def scan_entities(spark, path, kind):
    schema, rows = _ENTITIES[kind]
    return rows(read_json(spark, path, schema))


# -- matches of the first provider -------------------------------------------

def winner_label(code):
    return F.when(F.col(code) == 1, "Home").when(F.col(code) == 2, "Away").otherwise("X")


def matches(df):
    """Match rows; needs ``League`` and ``Season`` columns next to ``event``."""
    at = F.timestamp_seconds("event.startTimestamp")
    return df.filter("event IS NOT NULL").select(
        F.col("event.id").alias("IdSS"), "League", "Season",
        F.col("event.roundInfo.round").alias("Round"),
        winner_label("event.winnerCode").alias("Winner"), F.col("event.attendance").alias("Attendance"),
        F.col("event.venue.id").alias("Venue"), F.col("event.referee.name").alias("Referee"),
        F.col("event.homeTeam.id").alias("HomeTeam"), F.col("event.awayTeam.id").alias("AwayTeam"),
        F.col("event.homeScore.display").alias("HomeScore"),
        F.col("event.awayScore.display").alias("AwayScore"),
        F.col("event.homeTeam.manager.id").alias("HomeManager"),
        F.col("event.awayTeam.manager.id").alias("AwayManager"),
        at.cast("date").alias("Date"), F.date_format(at, "HH:mm").alias("Time"))


def _match_files(spark, root, name, schema, seasons):
    """Files <root>/<league>/<season>/<provider>/matches/<id>/<name> of the wanted seasons."""
    pattern = "{" + ",".join(seasons) + "}"
    df = read_json(spark, f"{root}/*/{pattern}/{FIRST}/matches/*/{name}", schema)
    return df.withColumns({"IdSS": path_part(1), "Season": path_part(4), "League": path_part(5)})


def scan_matches(spark, root, seasons=("2425", "2526")):
    """League and season come from the directories."""
    return matches(_match_files(spark, root, "info.json", MATCH, seasons).drop("IdSS"))


# -- statistics of the first provider ----------------------------------------

def unfold_match_stats(df, keys=None):
    """Home and away value of each statistic to one row per side and one column per key.

    ``df`` has Match, HomeTeam, AwayTeam and the parsed ``statistics``.
    """
    keys = list(lk.TEAM_STAT_KEYS if keys is None else keys)
    items = (df.select("Match", "HomeTeam", "AwayTeam",
                       F.explode(F.col("statistics")[0]["groups"]).alias("g"))
             .select("Match", "HomeTeam", "AwayTeam", F.explode("g.statisticsItems").alias("i"))
             .filter("i.key IS NOT NULL"))
    sides = items.select("Match", F.col("i.key").alias("key"), F.explode(F.array(
        F.struct(F.col("HomeTeam").alias("team"), F.col("i.homeValue").alias("value")),
        F.struct(F.col("AwayTeam").alias("team"), F.col("i.awayValue").alias("value")))).alias("s"))
    return sides.groupBy("Match", F.col("s.team").alias("team")).agg(
        *[F.max(F.when(F.col("key") == k, F.col("s.value"))).alias(k) for k in keys])


def unfold_lineups(df, keys):
    """One row per player of both sides, one column per statistic, missing ones 0.

    Only the declared statistics are read, as numbers, so booleans and objects
    fall out; a player with nothing but zeros is dropped.
    """
    def side(name, team):
        return F.struct(F.col(team).alias("team"), F.col(name + ".players").alias("players"))

    sides = df.select("Match", F.explode(F.array(side("home", "HomeTeam"), side("away", "AwayTeam"))).alias("s"))
    rows = sides.select("Match", "s.team", F.explode("s.players").alias("p")).select(
        "Match", "team", F.col("p.player.id").alias("player"), F.col("p.shirtNumber").alias("shirt_num"),
        "p.position", *[F.col(f"p.statistics.`{k}`").alias(k) for k in keys])
    played = F.lit(False)
    for k in keys:
        played = played | (F.coalesce(F.col(k), F.lit(0.0)) != 0)
    return rows.filter(played).fillna(0.0, keys)


def formations(df):
    """Formation of each (match, team)."""
    return df.select("Match", F.explode(F.array(
        F.struct(F.col("HomeTeam").alias("team"), F.col("home.formation").alias("formation")),
        F.struct(F.col("AwayTeam").alias("team"), F.col("away.formation").alias("formation")))).alias("s")
    ).select("Match", "s.*")


def match_stats(spark, root, matches_df, lineup_keys, stat_keys=None, seasons=("2425", "2526")):
    """(team statistics with formation, player statistics) of all matches."""
    ids = matches_df.select(F.col("IdSS").cast("string").alias("IdSS"), "HomeTeam", "AwayTeam")
    stats = _match_files(spark, root, "stats.json", MATCH_STATS, seasons).join(ids, "IdSS")
    lines = _match_files(spark, root, "lineups.json", lineups_schema(lineup_keys), seasons).join(ids, "IdSS")
    stats, lines = (d.withColumnRenamed("IdSS", "Match") for d in (stats, lines))
    team = unfold_match_stats(stats, stat_keys).join(formations(lines), ["Match", "team"], "left")
    return team, unfold_lineups(lines, lineup_keys)


# -- second provider -----------------------------------------------------------

def people(df):
    """All squad persons, exploded, with team, names and the columns given next to ``squad``."""
    keep = [c for c in ("League", "Season") if c in df.columns]
    rows = df.select(*keep, F.explode("squad").alias("s")).select(
        *keep, F.col("s.contestantId").alias("Team"), F.explode("s.person").alias("p"))
    rows = rows.select(*keep, "Team", "p.*").filter("type IS NOT NULL")
    return rows.select(
        F.col("id").alias("IdSW"), "type",
        slug(F.concat("shortFirstName", F.lit(" "), "shortLastName")).alias("Slug"),
        F.concat("firstName", F.lit(" "), "lastName").alias("Name"),
        F.concat("shortFirstName", F.lit(" "), "shortLastName").alias("ShortName"),
        F.col("firstName").alias("FirstName"), F.col("lastName").alias("LastName"),
        F.col("shortFirstName").alias("ShortFirstName"), F.col("shortLastName").alias("ShortLastName"),
        F.col("matchName").alias("MatchName"), F.col("nationality").alias("Country"),
        F.col("position").alias("Position"), F.col("shirtNumber").alias("ShirtNumber"), *keep, "Team")


def squads(df):
    """(players, staff); staff keep the last team by id. Documents are parsed once, not for each use of their people."""
    rows = materialize(people(df), "squad-people")
    keep = [c for c in ("League", "Season") if c in rows.columns]
    staff = rows.filter("type <> 'player'").drop("ShirtNumber", *keep)
    last = staff.groupBy("IdSW").agg(F.max("Team").alias("Team"))
    staff = staff.drop("Team").withColumnRenamed("type", "Type").distinct().join(last, "IdSW", "left")
    return rows.filter("type = 'player'").drop("type").distinct(), staff


def kits(df):
    """Teams with the colours of the home and away kit as columns."""
    s = df.select(F.explode("squad").alias("s")).select("s.*")

    def kit(kind, field):
        of = F.filter(F.coalesce("teamKits.kit", F.array().cast(
            "array<struct<type:string,shirtColour1:string,shirtColour2:string,shortsColour1:string>>")),
            lambda k: k["type"] == kind)
        return F.try_element_at(of, F.lit(-1))[field]

    return s.select(
        F.col("contestantId").alias("IdSW"), slug("contestantClubName").alias("Slug"),
        F.col("contestantName").alias("LongName"), F.col("contestantShortName").alias("ShortName"),
        F.col("contestantClubName").alias("Name"), F.col("contestantCode").alias("Abbreviation"),
        kit("Home", "shirtColour1").alias("HomeKitCol1"), kit("Home", "shirtColour2").alias("HomeKitCol2"),
        kit("Home", "shortsColour1").alias("HomeShortsCol"),
        kit("Away", "shirtColour1").alias("AwayKitCol1"), kit("Away", "shirtColour2").alias("AwayKitCol2"),
        kit("Away", "shortsColour1").alias("AwayShortsCol")).distinct()


def _season_files(spark, root, name, schema, seasons):
    """Files <root>/<league>/<season>/<provider>/<name>."""
    pattern = "{" + ",".join(seasons) + "}"
    df = read_json(spark, f"{root}/*/{pattern}/{SECOND}/{name}", schema)
    return df.withColumns({"Season": path_part(2), "League": path_part(3)})


def scan_squads(spark, root, seasons=("2425", "2526")):
    return squads(_season_files(spark, root, "squads.json", SQUADS, seasons))


def scan_teams(spark, root, seasons=("2425", "2526")):
    return kits(_season_files(spark, root, "squads.json", SQUADS, seasons))


def played_until(df, as_of, date="date", time="time", out="Datetime"):
    """Rows whose UTC date and time are not after ``as_of``; a blank time is midnight."""
    clock = F.coalesce(F.nullif(F.col(time), F.lit("")), F.lit("00:00:00Z"))
    text = F.concat(F.regexp_replace(F.col(date), "Z", ""), F.lit(" "), F.regexp_replace(clock, "Z", ""))
    at = F.try_to_timestamp(text)
    return df.withColumn(out, at).filter(F.col(out) <= F.lit(as_of).cast("timestamp"))


def calendar(df, as_of):
    """Played matches of the calendar; needs League and Season next to ``match``."""
    rows = df.select("League", "Season", F.explode("match.matchInfo").alias("m")).filter("m IS NOT NULL")
    rows = rows.select("League", "Season", F.col("m.id").alias("IdSW"), "m.date", "m.time",
                       F.get("m.contestant", F.lit(0))["id"].alias("HomeTeam"),
                       F.get("m.contestant", F.lit(1))["id"].alias("AwayTeam"))
    return played_until(rows, as_of).select(
        "IdSW", "League", "Season", "HomeTeam", "AwayTeam", F.to_date("Datetime").alias("Date"),
        F.date_format("Datetime", "HH:mm").alias("Time")).distinct()


def scan_calendar(spark, root, as_of, seasons=("2425", "2526")):
    return calendar(_season_files(spark, root, "matches.json", CALENDAR, seasons), as_of)


def kv_lineup_rows(df):
    """Player rows of both line-ups with the statistics as a map, deny-list removed.

    A side without officials has no players, age or manager, as delivered.
    """
    sides = df.filter(F.size("liveData.lineUp") > 1).select("Match", F.explode(F.array(
        F.struct(F.col("HomeTeam").alias("team"), F.col("liveData.lineUp")[0].alias("l")),
        F.struct(F.col("AwayTeam").alias("team"), F.col("liveData.lineUp")[1].alias("l")))).alias("s"))
    sides = sides.select("Match", "s.team", "s.l").filter(F.size("l.teamOfficial") > 0)
    rows = sides.select("Match", "team", F.explode("l.player").alias("p"))
    entries = F.filter(F.coalesce("p.stat", F.array().cast("array<struct<type:string,value:string>>")),
                       lambda x: x["type"].isNotNull() & ~x["type"].isin(lk.LINEUP_DENY))
    rows = rows.select("Match", "team", F.col("p.playerId").alias("player"),
                       F.col("p.shirtNumber").alias("shirt_num"), F.col("p.position").alias("position"),
                       F.col("p.positionSide").alias("position_side"), F.transform(entries, lambda x: F.struct(
                           x["type"].alias("k"), text_number(x["value"]).alias("v"))).alias("entries"))
    rows = rows.filter(F.exists("entries", lambda x: x["v"].isNotNull() & (x["v"] != 0)))
    names = F.array_distinct(F.transform("entries", lambda x: x["k"]))
    last = F.transform(names, lambda n: F.struct(n.alias("k"), F.try_element_at(
        F.filter("entries", lambda x: x["k"] == n), F.lit(-1))["v"].alias("v")))
    once = F.when(F.size(names) == F.size("entries"), F.col("entries")).otherwise(last)
    return rows.withColumn("stats", F.map_from_entries(once)).drop("entries")


def unfold_kv_lineups(df, keys):
    """Key/value line-up statistics as columns; zero and missing values are null."""
    return kv_lineup_rows(df).select("Match", "team", "player", "shirt_num", "position", "position_side", *[
        F.nullif(F.try_element_at("stats", F.lit(k)), F.lit(0.0)).alias(k) for k in keys])


def lineup_sides(df):
    """Average age and first official of each (match, team)."""
    def one(team, i):
        line = F.get("liveData.lineUp", F.lit(i))
        boss = F.get(line["teamOfficial"], F.lit(0))["id"]
        return F.struct(F.col(team).alias("team"),
                        F.when(boss.isNotNull(), line["averageAge"]).alias("AverageAge"),
                        boss.alias("Manager"))

    return df.filter(F.size("liveData.lineUp") > 1).select(
        "Match", F.explode(F.array(one("HomeTeam", 0), one("AwayTeam", 1))).alias("s")).select("Match", "s.*")


def scan_kv_lineups(spark, root, calendar_df, seasons=("2425", "2526")):
    """Parsed line-up documents next to the match, home and away id of the calendar."""
    pattern = "{" + ",".join(seasons) + "}"
    docs = read_json(spark, f"{root}/*/{pattern}/{SECOND}/matches/*.json", KV_LINEUPS)
    ids = calendar_df.select(F.col("IdSW").alias("Match"), "HomeTeam", "AwayTeam")
    return docs.withColumn("Match", file_stem()).join(ids, "Match")


# -- event feed ------------------------------------------------------------------

def events(df, types=None, deny=None):
    """(playing events in feed order, qualifiers) of all matches.

    ``df`` has ``match`` and the parsed ``liveData``. The rows of both are written once, so documents are parsed once.
    """
    types = const_map(lk.EVENT_TYPES if types is None else types)
    deny = lk.NON_PLAYING_TYPES if deny is None else deny
    rows = materialize(df.select("match", F.posexplode("liveData.event").alias("pos", "e")), "event-rows")
    quals = rows.select("match", F.col("e.id").alias("eventId"), "pos",
                        F.posexplode("e.qualifier").alias("qpos", "q")).select(
        "match", "eventId", F.col("pos").cast("long") * 100000 + F.col("qpos").alias("qpos"),
        F.col("q.qualifierId").alias("qualifierId"), F.col("q.value").alias("value"))
    quals = quals.toDF("match", "eventId", "qpos", "qualifierId", "value")
    ev = rows.select("match", "pos", F.col("e.id").alias("eventId"), "e.typeId", "e.periodId",
                     "e.timeMin", "e.timeSec", F.col("e.contestantId").alias("team"),
                     F.col("e.playerId").alias("player"), "e.outcome", "e.x", "e.y",
                     F.try_element_at(types, F.col("e.typeId")).alias("Type"))
    kept = F.col("Type").isNull() | ~F.col("Type").isin(deny)
    return ev.filter(kept & F.col("team").isNotNull() & F.col("player").isNotNull()), quals


def enrich_events(ev, quals, names=None):
    """Qualifiers as columns and the next actor of each playing event."""
    names = lk.QUALIFIERS if names is None else names
    named = quals.withColumn("name", F.try_element_at(const_map(names), F.col("qualifierId")))
    wide = pivot_qualifiers(ev, named.filter("name IS NOT NULL"), list(names.values()))
    return next_actor(wide, order=("pos",))


def scan_events(spark, path):
    """Event documents named by match id."""
    return events(read_json(spark, path, EVENTS).withColumn("match", file_stem()))
