"""Checks of entity resolution."""

from pyspark.sql import functions as F

from ..functions.text import normalize_name, slug
from ..operators import resolve as res
from ..operators.windows import next_actor
from .views import MATCH, STATS, matches, query, stats, table


def _names(spark, sf, block):
    """Customers and suppliers as two providers of the same people, with noisy names."""
    words = ["alba", "bruno", "carla", "dario", "elena", "fabio", "gloria", "hugo", "irene", "jorge"]
    arr = F.array(*[F.lit(w) for w in words])

    def person(key):
        first = F.element_at(arr, (F.pmod(F.xxhash64(key, F.lit(1)), F.lit(10)) + 1).cast("int"))
        last = F.concat(F.lit("mar"), F.substring(F.sha2(key.cast("string"), 256), 1, 5))
        return first, last

    c = table(spark, sf, "customer")
    first, last = person(F.col("c_custkey"))
    a = c.select(F.col("c_custkey").cast("string").alias("IdSS"), F.col("c_nationkey").alias("block"),
                 F.concat_ws(" ", first, last).alias("Name"), last.alias("ShortName"))
    s = table(spark, sf, "supplier")
    first, last = person(F.col("s_suppkey"))
    noisy = F.concat(last, F.when(F.col("s_suppkey") % 3 == 0, F.lit("s")).otherwise(F.lit("")))
    b = s.select(F.concat(F.lit("w"), F.col("s_suppkey").cast("string")).alias("IdSW"),
                 F.col("s_nationkey").alias("block"), F.concat_ws(" ", noisy, first).alias("Name"),
                 F.when(F.col("s_suppkey") % 4 != 0, noisy).alias("ShortName"))
    return ([x.withColumns({"Name": normalize_name("Name"), "Slug": slug("Name")}) for x in (a, b)]
            if block else [x.drop("block").withColumns({"Name": normalize_name("Name"), "Slug": slug("Name")})
                           for x in (a, b)])


@query("e1_fuzzy_teams")
def e1(spark, sf):
    a, b = _names(spark, sf, True)
    found = res.fuzzy_match(a, b, ["Slug", "Name", "ShortName"], 75, block="block")
    return res.with_leftovers(res.one_partner(found.select("IdSS", "IdSW").distinct()), a, b)


@query("e2_fuzzy_players")
def e2(spark, sf):
    a, b = _names(spark, sf, True)
    return res.fuzzy_match(a, b, ["Slug", "Name", "ShortName"], 90, block="block")


@query("e3_fuzzy_managers")
def e3(spark, sf):
    """No block: partners come from shared words and edit keys."""
    a, b = _names(spark, sf, False)
    return res.fuzzy_match(a, b, ["Slug", "Name", "ShortName"], 90)


@query("e4_merge_duplicates")
def e4(spark, sf):
    """Customers entered up to three times with slips in the name; a nation, where known, must agree."""
    key = F.col("c_custkey")
    person = F.floor(key / 3)
    last = F.concat(F.lit("mar"), F.substring(F.sha2(person.cast("string"), 256), 1, 7))
    last = F.concat(last, F.when(key % 3 == 0, F.lit("s")).otherwise(F.lit("")))
    name = F.concat_ws(" ", F.substring(F.sha2((-person).cast("string"), 256), 1, 6), last)
    c = table(spark, sf, "customer").select(
        "c_custkey", name.alias("Name"), last.alias("ShortName"),
        F.when(key % 2 == 0, F.col("c_nationkey")).alias("Nation"))
    return res.merge_duplicates(c, "c_custkey", ["Name", "ShortName"], ["Nation"])


@query("e4_closure", """
WITH l AS (SELECT c_custkey AS id, c_acctbal AS bal, c_nationkey AS n,
   c_acctbal - lag(c_acctbal) OVER (PARTITION BY c_nationkey ORDER BY c_acctbal, c_custkey) AS gap FROM customer),
g AS (SELECT *, sum(CASE WHEN gap IS NULL OR gap >= 150 THEN 1 ELSE 0 END) OVER (PARTITION BY n ORDER BY bal, id) AS isl FROM l)
SELECT id AS node, min(id) OVER (PARTITION BY n, isl) AS component FROM g QUALIFY count(*) OVER (PARTITION BY n, isl) > 1""")
def e4_closure(spark, sf):
    """Customers linked to the next richer one of their nation if the gap is small."""
    me = F.struct(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("bal"))
    c = table(spark, sf, "customer").select("c_nationkey", "c_custkey", "c_acctbal", me.alias("me"))
    c = next_actor(c, "c_nationkey", "me", ("c_acctbal", "c_custkey"), "next")
    near = c.filter(F.col("next.bal") - F.col("c_acctbal") < 150)
    return res.connected_components(near.select(F.col("c_custkey").alias("src"), F.col("next.id").alias("dst")))


@query("e5_unify_stats", """
WITH a AS (SELECT l_orderkey AS m, l_partkey AS p, max(l_quantity) AS q, max(l_suppkey) AS t, min(l_linenumber) AS sh FROM lineitem WHERE l_returnflag <> 'A' GROUP BY 1, 2),
b AS (SELECT l_orderkey AS m, l_partkey AS p, max(l_quantity) + 1 AS q, max(l_suppkey) AS t FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1, 2),
j AS (SELECT coalesce(a.m, b.m) AS m, coalesce(a.t, b.t) AS t, coalesce(a.p, b.p) AS p, a.q AS aq, b.q AS bq, a.sh FROM a FULL JOIN b ON a.m = b.m AND a.p = b.p AND a.t = b.t),
k AS (SELECT *, row_number() OVER (PARTITION BY m, p ORDER BY 'T' || t) AS rn FROM j)
SELECT 'M' || m AS "Match", 'T' || t AS "Team", 'P' || p AS "Player", sh AS "ShirtNumber",
       CASE WHEN bq IS NULL THEN 'Defender' ELSE 'Goalkeeper' END AS "Position", greatest(aq, bq) AS "Goals", aq AS "Touches" FROM k WHERE rn = 1""")
def e5(spark, sf):
    li = table(spark, sf, "lineitem")

    def side(df, extra):
        return df.groupBy(F.col("l_orderkey").alias("Match"), F.col("l_partkey").alias("player")).agg(
            F.max("l_suppkey").alias("team"), (F.max("l_quantity") + extra).alias("goals"),
            F.max("l_quantity").alias("touches"), F.min("l_linenumber").alias("shirt_num"))

    a = side(li.filter("l_returnflag <> 'A'"), 0).withColumn("position", F.lit("D"))
    b = side(li.filter("l_returnflag <> 'R'"), 1).drop("touches", "shirt_num").withColumn(
        "position", F.lit("Goalkeeper")).withColumn("position_side", F.lit("Centre"))

    def ids(col, tag):
        d = li.select(F.col(col).alias("IdSS")).distinct()
        return d.select(F.col("IdSS").cast("string").alias("IdSS"), F.col("IdSS").cast("string").alias("IdSW"),
                        F.concat(F.lit(tag), F.col("IdSS").cast("string")).alias("ID"))

    return res.unify_stats(a, b, ids("l_orderkey", "M"), ids("l_suppkey", "T"), ids("l_partkey", "P"),
                           {"Goals": ["goalsSS", "goalsSW"], "Touches": ["touchesSS", "touchesSW"]})


_E6 = f"""
WITH {MATCH}, {STATS.strip()},
lt AS (SELECT player, arg_max(team, (v_match.date, match, team)) AS team FROM v_stats JOIN v_match ON id = match WHERE season = '1999' GROUP BY player),
p AS (SELECT p_partkey AS id, CASE WHEN p_size % 4 <> 0 THEN p_name END AS mn, p_brand AS slug, p_type AS country,
  coalesce(lt.team, p_size) AS team, CASE WHEN p_size > 25 THEN p_size END AS contract, CASE WHEN p_size % 3 = 0 THEN 1 END AS shirt
  FROM part LEFT JOIN lt ON lt.player = p_partkey),
k AS (SELECT *, lower(CASE WHEN mn IS NULL THEN slug ELSE mn END) || '|' || team || '|' || lower(country) AS key FROM p),
w AS (SELECT key, id AS main FROM k QUALIFY row_number() OVER (PARTITION BY key ORDER BY contract IS NULL, shirt IS NULL,
   (mn IS NOT NULL)::INT + (contract IS NOT NULL)::INT + (shirt IS NOT NULL)::INT DESC, slug, id) = 1)"""


@query("e6_merge_identities", _E6 + """
SELECT match AS "Match", shirt AS "ShirtNumber", main AS "Player" FROM v_stats JOIN k ON k.id = player JOIN w USING (key)""".replace("shirt AS", "v_stats.shirt AS"))
def e6(spark, sf):
    size = F.col("p_size")
    players = table(spark, sf, "part").select(
        F.col("p_partkey").alias("ID"), F.when(size % 4 != 0, F.col("p_name")).alias("MatchName"),
        F.col("p_brand").alias("Slug"), F.col("p_type").alias("Country"), size.cast("long").alias("Team"),
        F.when(size > 25, size).alias("ContractUntil"), F.when(size % 3 == 0, F.lit(1)).alias("ShirtNumber"))
    s = stats(spark, sf).drop("Date")
    _, moved, _ = res.merge_identities(players, s, matches(spark, sf), "1999")
    return moved.select("Match", "ShirtNumber", "Player")


@query("e7_infer_position", """
WITH p AS (SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN p_type END AS pos, CASE WHEN p_size % 2 = 0 THEN 'A' ELSE 'B' END AS form,
  list_filter([CASE WHEN p_size % 5 = 0 THEN 'X' END, CASE WHEN p_size % 4 = 0 THEN 'SMALL' END, CASE WHEN p_size % 7 = 0 THEN 'LARGE' END], lambda x: x IS NOT NULL) AS mine FROM part),
q AS (SELECT *, list_filter(mine, lambda x: list_contains(CASE form WHEN 'A' THEN ['LARGE','SMALL'] ELSE ['LARGE'] END, x)) AS fit FROM p)
SELECT p_partkey AS "Player", coalesce(pos, fit[1], mine[1]) AS "Position" FROM q WHERE coalesce(pos, fit[1], mine[1]) IS NOT NULL""")
def e7(spark, sf):
    size = F.col("p_size")
    p = table(spark, sf, "part")
    df = p.select(F.col("p_partkey").alias("Player"), F.when(size % 3 == 0, F.col("p_type")).alias("Position"),
                  F.when(size % 2 == 0, "A").otherwise("B").alias("Formation"), F.lit(None).cast("double").alias("x"))
    players = p.select(F.col("p_partkey").alias("ID"), F.when(size % 5 == 0, "X").alias("FirstPos"),
                       F.when(size % 4 == 0, "SMALL").alias("SecondPos"), F.when(size % 7 == 0, "LARGE").alias("ThirdPos"))
    allowed = spark.createDataFrame([("A", ["LARGE", "SMALL"]), ("B", ["LARGE"])], "Formation string, positions array<string>")
    return res.infer_position(df, players, allowed).select("Player", "Position")


@query("e8_clean_staff_teams", """
WITH m AS (SELECT s_nationkey AS team, max(s_suppkey) AS boss FROM supplier GROUP BY 1)
SELECT n_nationkey AS "ID", CASE WHEN n_regionkey = 1 THEN 'OWN' ELSE upper(substr(lower(n_name), 1, 3)) END AS "Abbreviation",
       CASE WHEN s_acctbal < 9000 THEN 'M' || boss END AS "Manager"
FROM nation LEFT JOIN m ON team = n_nationkey LEFT JOIN supplier ON s_suppkey = boss""")
def e8(spark, sf):
    s, n = table(spark, sf, "supplier"), table(spark, sf, "nation")
    lead = s.groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.max("s_suppkey").alias("Manager"))
    none = F.lit(None).cast("string")
    colours = {c: F.lit("#123456") for c in ("PrimaryColour", "SecondaryColour", "HomeKitCol1", "HomeKitCol2",
                                             "HomeShortsCol", "AwayKitCol1", "AwayKitCol2", "AwayShortsCol")}
    teams = n.join(lead, "n_nationkey", "left").select(
        F.col("n_nationkey").alias("ID"), F.lower("n_name").alias("Slug"),
        F.when(F.col("n_regionkey") == 1, "OWN").otherwise(none).alias("Abbreviation"), "Manager").withColumns(colours)
    staff = s.select(F.concat(F.lit("M"), F.col("s_suppkey").cast("string")).alias("ID"), F.col("s_suppkey").alias("IdSS"),
                     none.alias("Team"), F.when(F.col("s_acctbal") < 9000, "coach").otherwise("doctor").alias("Type"))
    return res.clean_teams(teams, res.clean_staff(staff, teams)).select("ID", "Abbreviation", "Manager")


@query("e9_stats_and_profile_cleaning", f"""
WITH {STATS}, {MATCH.strip()},
f AS (SELECT match, team, CASE WHEN min(shirt) % 2 = 0 THEN 'A' ELSE 'B' END AS form FROM v_stats GROUP BY 1, 2),
fm(form, raw, pos) AS (VALUES ('A', 'SMALL', 'LB'), ('A', 'LARGE', 'CB'), ('B', 'SMALL', 'ST'), ('B', 'PROMO', 'GK')),
s AS (SELECT v_stats.*, fm.pos, v_match.date AS md FROM v_stats JOIN f USING (match, team) LEFT JOIN fm ON fm.form = f.form AND fm.raw = position
      LEFT JOIN v_match ON id = match AND season = '1998' WHERE minutes > 0),
c AS (SELECT player, pos, row_number() OVER (PARTITION BY player ORDER BY count(*) DESC, pos) AS rn FROM s WHERE pos IS NOT NULL GROUP BY player, pos),
t AS (SELECT player, max(pos) FILTER (rn = 1) AS p1, max(pos) FILTER (rn = 2) AS p2 FROM c GROUP BY player),
l AS (SELECT player, arg_max(team, (md, match, team, shirt)) AS team FROM s WHERE md IS NOT NULL GROUP BY player)
SELECT p_partkey AS "ID", coalesce(p1, CASE WHEN p_size % 2 = 0 THEN 'GK' END) AS "FirstPos", p2 AS "SecondPos",
  CASE coalesce(p1, CASE WHEN p_size % 2 = 0 THEN 'GK' END) WHEN 'LB' THEN 'FB' ELSE coalesce(p1, CASE WHEN p_size % 2 = 0 THEN 'GK' END) END AS "Position",
  l.team AS "Team", split_part(p_name, ' ', 1) AS "FirstName", split_part(p_name, ' ', 2) AS "LastName"
FROM part LEFT JOIN t ON t.player = p_partkey LEFT JOIN l ON l.player = p_partkey WHERE p1 IS NOT NULL OR p_size % 2 = 0""")
def e9(spark, sf):
    s = stats(spark, sf).drop("Date", "Brand", "Name")
    ts = s.groupBy("Match", "Team").agg(F.when(F.min("ShirtNumber") % 2 == 0, "A").otherwise("B").alias("Formation"))
    fm = spark.createDataFrame([("A", "SMALL", "LB"), ("A", "LARGE", "CB"), ("B", "SMALL", "ST"), ("B", "PROMO", "GK")],
                               "formation string, raw_position string, position string")
    clean = res.clean_player_stats(s, ts, matches(spark, sf), fm, "1998")
    none = F.lit(None).cast("string")
    players = table(spark, sf, "part").select(
        F.col("p_partkey").alias("ID"), F.col("p_name").alias("Name"), none.alias("FirstName"), none.alias("LastName"),
        F.when(F.col("p_size") % 2 == 0, "Goalkeeper").alias("Position"),
        none.alias("FirstPos"), none.alias("SecondPos"), none.alias("ThirdPos"))
    return res.clean_players(players, clean).select("ID", "FirstPos", "SecondPos", "Position", "Team", "FirstName", "LastName")
