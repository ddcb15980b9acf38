"""Checks of the sources and sinks: raw documents built from the tables, then unfolded."""

from pyspark.sql import functions as F

from ..functions.dates import format_dmy, format_hm
from ..functions.numeric import round_even
from ..functions.text import slug
from ..operators.windows import pct_rank
from ..session import scratch_path
from ..sources import raw, sinks, tables
from .views import MATCH, matches, query, r, table


def _doc(df, keep, **fields):
    """JSON text of a document next to the kept columns."""
    return df.select(*keep, F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()])).alias("doc"))


@query("s1_entity_scan", """
SELECT c_custkey AS "IdSS", lower(replace(c_name, '#', '')) AS "Slug", c_name AS "Name", c_mktsegment AS "Country",
       DATE '1970-01-01' + (c_custkey::INT) AS "DateBirth", c_nationkey::BIGINT AS "Wins", NULL::BIGINT AS "Draws"
FROM customer WHERE c_acctbal >= 0""")
def s1(spark, sf):
    c = table(spark, sf, "customer")
    docs = _doc(c, ["c_acctbal"], manager=F.struct(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.struct(F.col("c_mktsegment").alias("name")).alias("country"),
        (F.col("c_custkey") * 86400).alias("dateOfBirthTimestamp"),
        F.struct(F.col("c_nationkey").alias("wins")).alias("performance")))
    docs = docs.withColumn("doc", F.when(F.col("c_acctbal") >= 0, F.col("doc")).otherwise(
        F.concat(F.lit("{oops "), F.col("doc"))))       # broken documents are skipped
    return raw.managers(raw.parse_json(docs, "doc", raw.MANAGER)).select(
        "IdSS", "Slug", "Name", "Country", "DateBirth", "Wins", "Draws")


def _orders(spark, sf):
    return matches(spark, sf).join(
        table(spark, sf, "orders").withColumnRenamed("o_orderkey", "ID"), "ID")


@query("s2_match_scan", f"""
WITH {MATCH}
SELECT id AS "IdSS", lower(league) AS "League", season AS "Season",
       CASE o_orderstatus WHEN 'F' THEN 'Home' WHEN 'O' THEN 'Away' ELSE 'X' END AS "Winner",
       home AS "HomeTeam", away AS "AwayTeam", hs AS "HomeScore", as_ AS "AwayScore", date AS "Date",
       strftime(o_orderdate + to_seconds(o_orderkey % 86400), '%H:%M') AS "Time"
FROM v_match JOIN orders ON o_orderkey = id""")
def s2(spark, sf):
    o = _orders(spark, sf)
    code = F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 2)
    at = F.unix_timestamp("o_orderdate") + F.col("ID") % 86400
    path = F.concat_ws("/", F.lit("raw"), F.lower("League"), "Season", F.lit("sofascore/matches"),
                       F.col("ID").cast("string"), F.lit("info.json"))
    docs = _doc(o, [path.alias("path")], event=F.struct(
        F.col("ID").alias("id"), code.alias("winnerCode"), at.alias("startTimestamp"),
        F.struct(F.col("HomeTeam").alias("id")).alias("homeTeam"),
        F.struct(F.col("AwayTeam").alias("id")).alias("awayTeam"),
        F.struct(F.col("HomeScore").alias("display")).alias("homeScore"),
        F.struct(F.col("AwayScore").alias("display")).alias("awayScore")))
    df = raw.parse_json(docs, "doc", raw.MATCH, ["path"]).withColumns(
        {"Season": raw.path_part(4), "League": raw.path_part(5)})
    out = raw.matches(df)
    return out.select("IdSS", "League", "Season", "Winner", "HomeTeam", "AwayTeam",
                      F.col("HomeScore").cast("long").alias("HomeScore"),
                      F.col("AwayScore").cast("long").alias("AwayScore"), "Date", "Time")


def _stat_docs(spark, sf):
    o = _orders(spark, sf)
    price = F.floor("o_totalprice")

    def item(key, home, away):
        return F.struct(F.lit(key).alias("key"), home.cast("double").alias("homeValue"),
                        away.cast("double").alias("awayValue"))

    groups = F.array(
        F.struct(F.array(item("fouls", price % 11, price % 13), item("offsides", price % 3, F.lit(None)),
                         ).alias("statisticsItems")),
        F.struct(F.array(item("passes", price % 600, price % 500)).alias("statisticsItems")))
    docs = _doc(o, [F.col("ID").alias("Match"), "HomeTeam", "AwayTeam"],
                statistics=F.array(F.struct(groups.alias("groups"))))
    return raw.parse_json(docs, "doc", raw.MATCH_STATS, ["Match", "HomeTeam", "AwayTeam"])


_S3 = f"""
WITH {MATCH}, base AS (SELECT *, floor(o_totalprice)::BIGINT AS price FROM v_match JOIN orders ON o_orderkey = id),
rows AS (
  SELECT id, home AS team, (price % 11)::DOUBLE AS fouls, (price % 3)::DOUBLE AS offsides, (price % 600)::DOUBLE AS passes FROM base
  UNION ALL
  SELECT id, away, (price % 13)::DOUBLE, NULL, (price % 500)::DOUBLE FROM base)"""


@query("s3_match_stats_unfold", _S3 + """
SELECT id AS "Match", team, fouls, offsides, passes FROM rows""")
def s3(spark, sf):
    return raw.unfold_match_stats(_stat_docs(spark, sf), ["fouls", "offsides", "passes"])


def _lineup_docs(spark, sf):
    o = _orders(spark, sf)

    def man(pid, goals, rating):
        return F.struct(F.struct(pid.alias("id")).alias("player"), F.lit("7").alias("shirtNumber"),
                        F.lit("M").alias("position"),
                        F.struct(goals.cast("int").alias("goals"), rating.alias("rating"),
                                 F.lit(True).alias("captain"),
                                 F.struct(F.lit(1).alias("x")).alias("detail")).alias("statistics"))

    def team(offset, formation):
        ids = F.col("o_custkey") * 4 + offset
        price = F.floor("o_totalprice")
        return F.struct(formation.alias("formation"), F.array(
            man(ids, price % 3, F.lit(0.0)), man(ids + 1, price % 2, (price % 10) / 2)).alias("players"))

    shape = F.when(F.col("o_orderstatus") == "P", F.lit("4-4-2")).otherwise("4-3-3")
    docs = _doc(o, [F.col("ID").alias("Match"), "HomeTeam", "AwayTeam"],
                home=team(0, shape), away=team(2, F.lit("3-5-2")))
    return raw.parse_json(docs, "doc", raw.lineups_schema(["goals", "rating", "captain"]),
                          ["Match", "HomeTeam", "AwayTeam"])


@query("s4_lineup_unfold", f"""
WITH {MATCH}, base AS (SELECT *, floor(o_totalprice)::BIGINT AS price FROM v_match JOIN orders ON o_orderkey = id),
rows AS (
  SELECT id, home AS team, o_custkey * 4 AS player, (price % 3)::DOUBLE AS goals, 0.0::DOUBLE AS rating FROM base
  UNION ALL SELECT id, home, o_custkey * 4 + 1, (price % 2)::DOUBLE, (price % 10) / 2.0::DOUBLE FROM base
  UNION ALL SELECT id, away, o_custkey * 4 + 2, (price % 3)::DOUBLE, 0.0::DOUBLE FROM base
  UNION ALL SELECT id, away, o_custkey * 4 + 3, (price % 2)::DOUBLE, (price % 10) / 2.0::DOUBLE FROM base)
SELECT id AS "Match", team, player, '7' AS shirt_num, 'M' AS position, goals, rating, 0.0::DOUBLE AS captain
FROM rows WHERE goals <> 0 OR rating <> 0""")
def s4(spark, sf):
    return raw.unfold_lineups(_lineup_docs(spark, sf), ["goals", "rating", "captain"])


@query("s5_match_stats_formation", _S3 + """
SELECT rows.id AS "Match", team, passes,
       CASE WHEN team <> home THEN '3-5-2' WHEN o_orderstatus = 'P' THEN '4-4-2' ELSE '4-3-3' END AS formation
FROM rows JOIN v_match ON v_match.id = rows.id JOIN orders ON o_orderkey = rows.id""")
def s5(spark, sf):
    team = raw.unfold_match_stats(_stat_docs(spark, sf), ["passes"])
    return team.join(raw.formations(_lineup_docs(spark, sf)), ["Match", "team"], "left")


def _squad_docs(spark, sf):
    o = _orders(spark, sf)

    def person(suffix, kind, last):
        pid = F.concat(F.col("ID").cast("string"), F.lit(suffix))
        return F.struct(pid.alias("id"), F.lit(kind).alias("type"), F.lit("Ann").alias("firstName"),
                        last.alias("lastName"), F.lit("A.").alias("shortFirstName"),
                        F.lit("Ódin").alias("shortLastName"), (F.col("ID") % 30).alias("shirtNumber"))

    def kit(kind, a, b):
        return F.struct(F.lit(kind).alias("type"), a.alias("shirtColour1"), b.alias("shirtColour2"))

    last = F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority"))
    docs = _doc(o, ["League", "Season"], squad=F.array(F.struct(
        F.col("ID").cast("string").alias("contestantId"), F.col("o_orderpriority").alias("contestantClubName"),
        F.struct(F.array(kit("Home", F.col("o_orderstatus"), F.lit("#fff")),
                         kit("Away", F.lit("#000"), F.lit(None).cast("string")),
                         kit("Home", F.col("o_orderpriority"), F.lit("#abc"))).alias("kit")).alias("teamKits"),
        F.array(person("p", "player", last), person("c", "coach", last),
                person("x", None, last)).alias("person"))))
    return raw.parse_json(docs, "doc", raw.SQUADS, ["League", "Season"])


@query("s6_squad_people", f"""
WITH {MATCH}, base AS (SELECT * FROM v_match JOIN orders ON o_orderkey = id)
SELECT id::VARCHAR || k AS "IdSW", kind, 'a_odin' AS "Slug",
       CASE WHEN o_orderstatus <> 'P' THEN 'Ann ' || o_orderpriority END AS "Name", id::VARCHAR AS "Team",
       CASE WHEN k = 'p' THEN league END AS "League", CASE WHEN k = 'p' THEN (id % 30)::INT END AS "ShirtNumber"
FROM base, (VALUES ('p', 'player'), ('c', 'coach')) t(k, kind)""")
def s6(spark, sf):
    people, staff = raw.squads(_squad_docs(spark, sf))
    cols = ["IdSW", "kind", "Slug", "Name", "Team", "League", "ShirtNumber"]
    a = people.withColumn("kind", F.lit("player")).select(cols)
    b = staff.withColumn("kind", F.col("Type"))
    return a.unionByName(b.select("IdSW", "kind", "Slug", "Name", "Team"), allowMissingColumns=True)


@query("s7_team_kits", """
SELECT o_orderkey::VARCHAR AS "IdSW", o_orderpriority AS "Name",
       trim(regexp_replace(regexp_replace(lower(o_orderpriority), '[^a-z0-9 ]', '', 'g'), ' ', '_', 'g'), '_') AS "Slug",
       o_orderpriority AS "HomeKitCol1", '#abc' AS "HomeKitCol2", NULL::VARCHAR AS "HomeShortsCol",
       '#000' AS "AwayKitCol1", NULL::VARCHAR AS "AwayKitCol2"
FROM orders""")
def s7(spark, sf):
    return raw.kits(_squad_docs(spark, sf)).select(
        "IdSW", "Name", "Slug", "HomeKitCol1", "HomeKitCol2", "HomeShortsCol", "AwayKitCol1", "AwayKitCol2")


@query("s8_calendar_scan", f"""
WITH {MATCH}, base AS (
  SELECT *, CASE id % 3 WHEN 0 THEN o_orderdate ELSE o_orderdate + to_seconds(id % 86400) END AS ts
  FROM v_match JOIN orders ON o_orderkey = id)
SELECT id::VARCHAR AS "IdSW", league AS "League", season AS "Season", home::VARCHAR AS "HomeTeam",
       away::VARCHAR AS "AwayTeam", ts::DATE AS "Date", strftime(ts, '%H:%M') AS "Time"
FROM base WHERE ts <= TIMESTAMP '1999-06-30 12:00:00'""")
def s8(spark, sf):
    o = _orders(spark, sf)
    at = F.timestamp_seconds(F.unix_timestamp("o_orderdate") + F.col("ID") % 86400)
    clock = F.when(F.col("ID") % 3 != 0, F.date_format(at, "HH:mm:ss'Z'")).when(F.col("ID") % 2 == 0, "")
    side = lambda c: F.struct(F.col(c).cast("string").alias("id"))
    docs = _doc(o, ["League", "Season"], match=F.array(F.struct(F.struct(
        F.col("ID").cast("string").alias("id"), F.date_format("o_orderdate", "yyyy-MM-dd'Z'").alias("date"),
        clock.alias("time"), F.array(side("HomeTeam"), side("AwayTeam")).alias("contestant")).alias("matchInfo"))))
    df = raw.parse_json(docs, "doc", raw.CALENDAR, ["League", "Season"])
    return raw.calendar(df, "1999-06-30 12:00:00")


def _kv_docs(spark, sf):
    o = _orders(spark, sf)
    price = F.floor("o_totalprice")

    def stat(name, v):
        return F.struct(F.lit(name).alias("type"), v.cast("string").alias("value"))

    def side(tag, boss):
        pid = F.concat(F.col("ID").cast("string"), F.lit(tag))
        officials = F.when(boss, F.array(F.struct(F.concat(F.lit("m"), pid).alias("id")))).otherwise(
            F.array().cast("array<struct<id:string>>"))
        return F.struct((price % 10 + 20.5).alias("averageAge"), officials.alias("teamOfficial"), F.array(F.struct(
            pid.alias("playerId"), F.lit(9).alias("shirtNumber"), F.lit("Striker").alias("position"),
            F.lit("Centre").alias("positionSide"),
            F.array(stat("goals", price % 4), stat("gameStarted", F.lit(1)),
                    stat("accuratePass", price % 70)).alias("stat"))).alias("player"))

    docs = _doc(o, [F.col("ID").alias("Match"), "HomeTeam", "AwayTeam"], liveData=F.struct(F.array(
        side("h", F.lit(True)), side("a", F.col("o_orderstatus") != "P")).alias("lineUp")))
    return raw.parse_json(docs, "doc", raw.KV_LINEUPS, ["Match", "HomeTeam", "AwayTeam"])


@query("s9_kv_lineup_unfold", f"""
WITH {MATCH}, base AS (
  SELECT *, floor(o_totalprice)::BIGINT AS price FROM v_match JOIN orders ON o_orderkey = id),
sides AS (SELECT id, home AS team, id::VARCHAR || 'h' AS player, price, TRUE AS boss FROM base
          UNION ALL SELECT id, away, id::VARCHAR || 'a', price, o_orderstatus <> 'P' FROM base)
SELECT id AS "Match", team, player, 9 AS shirt_num, 'Striker' AS position, 'Centre' AS position_side,
       nullif(price % 4, 0)::DOUBLE AS goals, nullif(price % 70, 0)::DOUBLE AS "accuratePass",
       price % 10 + 20.5::DOUBLE AS "AverageAge", 'm' || player AS "Manager"
FROM sides WHERE boss AND (price % 4 <> 0 OR price % 70 <> 0)""")
def s9(spark, sf):
    docs = _kv_docs(spark, sf)
    rows = raw.unfold_kv_lineups(docs, ["goals", "accuratePass"])
    return rows.join(raw.lineup_sides(docs), ["Match", "team"], "left")


@query("s10_event_scan", """
WITH e AS (SELECT *, json_extract(props, '$.k')::INT AS k, event_id % 20 + 1 AS type_id FROM events),
t AS (SELECT * FROM (VALUES (1,'Pass'),(2,'Offside Pass'),(3,'Take On'),(4,'Foul'),(5,'Out'),(6,'Corner Awarded'),
 (7,'Tackle'),(8,'Interception'),(9,'Turnover'),(10,'Save'),(11,'Claim'),(12,'Clearance'),(13,'Miss'),(14,'Post'),
 (15,'Saved Shot'),(16,'Goal'),(17,'Card'),(18,'Player Off'),(19,'Player on'),(20,'Player retired')) v(id, name))
SELECT strftime(ts, '%Y-%m-%d') AS match, event_id AS "eventId", name AS "Type", user_id::VARCHAR AS player,
       CASE WHEN k % 2 = 0 THEN 'Center' END AS "Zone", k::VARCHAR AS "Pass End X"
FROM e JOIN t ON t.id = type_id WHERE type_id < 18 AND k % 9 <> 0""")
def s10(spark, sf):
    e = table(spark, sf, "events")
    k = F.get_json_object("props", "$.k").cast("int")

    def qual(qid, v):
        return F.struct(F.lit(qid).alias("qualifierId"), v.cast("string").alias("value"))

    quals = F.array_compact(F.array(qual(140, k), qual(9999, F.lit("x")), qual(140, F.lit("later")),
                                    F.when(k % 2 == 0, qual(56, F.lit("Center")))))
    docs = _doc(e, [F.date_format("ts", "yyyy-MM-dd").alias("match")], liveData=F.struct(F.array(F.struct(
        F.col("event_id").alias("id"), (F.col("event_id") % 20 + 1).cast("int").alias("typeId"),
        F.lit("t").alias("contestantId"), F.when(k % 9 != 0, F.col("user_id").cast("string")).alias("playerId"),
        F.lit(1.5).alias("x"), quals.alias("qualifier"))).alias("event")))
    ev, q = raw.events(raw.parse_json(docs, "doc", raw.EVENTS, ["match"]))
    from ..config.lookups import QUALIFIERS
    from ..operators.aggregate import pivot_qualifiers
    from ..operators.shape import const_map
    named = q.withColumn("name", F.try_element_at(const_map(QUALIFIERS), F.col("qualifierId")))
    wide = pivot_qualifiers(ev, named.filter("name IS NOT NULL"), list(QUALIFIERS.values()))
    return wide.select("match", "eventId", "Type", "player", "Zone", "Pass End X")


@query("s11_delimited_round_trip", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer""")
def s11(spark, sf):
    c = table(spark, sf, "customer")
    path = scratch_path(spark, "delimited")
    tables.write_delimited(c, path)
    return tables.read_delimited(spark, path, c.schema)


@query("s12_lookup_tables", """
WITH t AS (SELECT * FROM (VALUES (1,'Pass'),(2,'Offside Pass'),(3,'Take On'),(4,'Foul'),(5,'Out'),
  (6,'Corner Awarded'),(7,'Tackle')) v(id, name))
SELECT name, count(*) AS n, sum(l_quantity)::DOUBLE AS qty FROM lineitem LEFT JOIN t ON t.id = l_linenumber GROUP BY name""")
def s12(spark, sf):
    li = table(spark, sf, "lineitem")
    names = tables.lookup(spark, "event_types")
    return li.join(names, li["l_linenumber"] == names["id"], "left").groupBy("name").agg(
        F.count("*").alias("n"), F.sum("l_quantity").alias("qty"))


@query("s13_document_sink", """
SELECT c_custkey AS "ID", c_name AS "Name", nullif(trim(CASE WHEN c_nationkey = 3 THEN '  ' ELSE c_mktsegment END), '') AS "Segment",
       c_acctbal AS "Balance"
FROM customer""")
def s13(spark, sf):
    c = table(spark, sf, "customer")
    blank = F.when(F.col("c_nationkey") == 3, F.lit("  ")).otherwise(F.col("c_mktsegment"))
    df = c.select(F.col("c_custkey").alias("ID"), F.col("c_name").alias("Name"), blank.alias("Segment"),
                  F.col("c_acctbal").alias("Balance"), F.array().cast("array<string>").alias("Tags"))
    path = scratch_path(spark, "documents")
    sinks.write_documents(df, "customer", path)
    sinks.write_documents(df, "customer", path, skip_existing=True)  # all are there: nothing is added
    back = spark.read.text(f"{path}/customer")
    return back.select(F.from_json("value", "ID BIGINT, Name STRING, Segment STRING, Balance DOUBLE").alias("d")
                       ).select("d.*")


@query("s13_document_manifest", """
SELECT c_custkey::VARCHAR AS id, 1::BIGINT AS documents FROM customer""")
def s13_manifest(spark, sf):
    """Ids of a sink that got the customers of one segment first and all of them later, and how many documents each has."""
    df = table(spark, sf, "customer").select(F.col("c_custkey").alias("ID"), F.col("c_name").alias("Name"), "c_mktsegment")
    path = scratch_path(spark, "documents")
    sinks.write_documents(df.filter("c_mktsegment = 'BUILDING'"), "customer", path, skip_existing=True)
    sinks.write_documents(df, "customer", path, skip_existing=True)
    ids = sinks.written_ids(spark, "customer", path).select("id")
    docs = spark.read.text(f"{path}/customer").select(F.get_json_object("value", "$.ID").alias("id"))
    return ids.join(docs.groupBy("id").agg(F.count("*").alias("documents")), "id", "left")


_PCT = r("(rank() OVER (PARTITION BY p_brand ORDER BY p_retailprice) + (count(*) OVER "
         "(PARTITION BY p_brand, p_retailprice) - 1) / 2.0::DOUBLE) / count(*) OVER (PARTITION BY p_brand) * 100", 1)


@query("s14_comparison_sink", f"""
SELECT p_brand AS "Position", p_partkey AS "Player", p_size::DOUBLE AS size, p_retailprice AS price, {_PCT} AS pct_price
FROM part""")
def s14(spark, sf):
    p = table(spark, sf, "part").select(F.col("p_brand").alias("Position"), F.col("p_partkey").alias("Player"),
                                        F.col("p_size").cast("double").alias("size"),
                                        F.col("p_retailprice").alias("price"))
    pct = pct_rank(p, "Position", "Player", ["price"])
    rows = sinks.comparison_rows(p, pct, "Player", "Position")
    path = scratch_path(spark, "comparison")
    sinks.write_comparison(rows, path, "Position")
    back = spark.read.schema("Position STRING, Player BIGINT, Metrics STRING, Percentiles STRING").json(path)
    num = lambda c, k: F.get_json_object(c, f"$.{k}").cast("double")
    return back.select("Position", "Player", num("Metrics", "size").alias("size"),
                       num("Metrics", "price").alias("price"), num("Percentiles", "price").alias("pct_price"))


@query("f4_slug", """
WITH t AS (SELECT doc_id, text AS t FROM documents)
SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(lower(strip_accents(
  replace(replace(replace(replace(replace(replace(replace(translate(t, 'ØøŁłĐđĦħƏə', 'OoLlDdHhEa'),
   'Æ', 'AE'), 'Œ', 'OE'), 'Þ', 'TH'), 'æ', 'ae'), 'œ', 'oe'), 'þ', 'th'), 'ß', 'ss'))),
  '[\\s\\p{Z}\\x{85}\\x{1c}-\\x{1f}]+', '_', 'g'), '[^a-z0-9_]', '', 'g'), '_+', '_', 'g'), '_') AS slug
FROM t""")
def f4(spark, sf):
    return table(spark, sf, "documents").select("doc_id", slug("text").alias("slug"))


@query("f5_normalize_name", """
SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(lower(
  replace(replace(replace(replace(replace(replace(replace(translate(text,
   'ÀÁÂÃÄÅÇÈÉÊËĖĘĚÌÍÎÏÑŃŇÒÓÔÕÖØŠŞȘȚŢÙÚÛÜÝŸŽĆČĞĦŁĐàáâãäåçèéêëėęěìíîïñńňòóôõöøšşșțţùúûüýÿžćčğħłđƏə',
   'AAAAAACEEEEEEEIIIINNNOOOOOOSSSTTUUUUYYZCCGHLDaaaaaaceeeeeeeiiiinnnoooooosssttuuuuyyzccghldEa'),
   'Æ', 'AE'), 'Œ', 'OE'), 'Þ', 'TH'), 'æ', 'ae'), 'œ', 'oe'), 'þ', 'th'), 'ß', 'ss')),
  '\\b(fc|cf|club|de|la|ud|cd|sd|fk|ac|sc)\\b', '', 'g'),
  '[^a-z0-9\\s\\p{Z}\\x{85}\\x{1c}-\\x{1f}]', '', 'g'),
  '[\\s\\p{Z}\\x{85}\\x{1c}-\\x{1f}]+', ' ', 'g')) AS name
FROM documents""")
def f5(spark, sf):
    from ..functions.text import normalize_name
    return table(spark, sf, "documents").select("doc_id", normalize_name("text").alias("name"))


@query("f8_dates", """
SELECT o_orderkey, strftime(o_orderdate, '%d/%m/%Y') AS dmy,
       strftime(o_orderdate + to_seconds(o_orderkey % 86400), '%H:%M') AS hm,
       CASE WHEN o_orderstatus <> 'P' THEN o_orderdate::DATE END AS parsed,
       DATE '1970-01-01' + ((o_orderkey * 1000) // 86400)::INT AS epoch_day
FROM orders""")
def f8(spark, sf):
    from ..functions.dates import epoch_date, parse_dmy
    o = table(spark, sf, "orders")
    text = F.when(F.col("o_orderstatus") == "P", F.lit("31/02/x")).otherwise(format_dmy("o_orderdate"))
    at = F.timestamp_seconds(F.unix_timestamp("o_orderdate") + F.col("o_orderkey") % 86400)
    return o.select("o_orderkey", format_dmy("o_orderdate").alias("dmy"), format_hm(at).alias("hm"),
                    parse_dmy(text).alias("parsed"), epoch_date(F.col("o_orderkey") * 1000).alias("epoch_day"))
