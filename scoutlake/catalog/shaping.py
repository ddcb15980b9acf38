"""Checks of projections, filters, joins, set operations and scalar functions."""

from pyspark.sql import functions as F

from ..functions import numeric as num
from ..functions.pitch import pass_direction, pitch_length
from ..functions.text import seq_ratio, stable_id, token_set_ratio
from ..operators import joins, shape
from ..operators.aggregate import aggregate_entity
from .views import FEED, MATCH, SIDES, STATS, clip01, feed, matches, query, r, ratio, stats, table


@query("f1_safe_ratio", f"""
SELECT l_orderkey, l_linenumber, {ratio('l_discount', 'l_tax')} AS by_tax,
       {ratio('l_extendedprice', 'l_quantity', 2)} AS unit_price
FROM lineitem""")
def f1(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", num.safe_div("l_discount", "l_tax").alias("by_tax"),
                     num.safe_div("l_extendedprice", "l_quantity", 2).alias("unit_price"))


@query("f2_per90", f"""
WITH {STATS}
SELECT match, shirt, player, {r("passes * " + ratio('90', 'minutes'), 6)} AS passes_player,
       {r("passes * (90.0::DOUBLE / nullif(minutes, 0))", 6)} AS passes_team
FROM v_stats""")
def f2(spark, sf):
    s = stats(spark, sf).select(F.col("Match").alias("match"), F.col("ShirtNumber").alias("shirt"),
                                F.col("Player").alias("player"), "MinutesPlayed", "Passes")
    a = num.per90(["Passes"], rounded=True)[0]
    b = num.per90(["Passes"], rounded=False)[0]
    return s.select("match", "shirt", "player", num.round_even(a, 6).alias("passes_player"),
                    num.round_even(b, 6).alias("passes_team"))


@query("f3_bounded_min_max", f"""
SELECT l_orderkey, l_linenumber, {r(clip01('(l_quantity - 5) / 40'), 9)} AS q, 0.0::DOUBLE AS flat FROM lineitem""")
def f3(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", num.round_even(num.norm01("l_quantity", 5, 45), 9).alias("q"),
        num.norm01("l_quantity", 3, 3).alias("flat"))


@query("f6_pass_direction", f"""
WITH {FEED}, d AS (SELECT event_id, CASE WHEN k % 6 <> 0 THEN end_x - x END AS dx, end_y - y AS dy FROM v_feed)
SELECT event_id, CASE
  WHEN dx > 5 AND dy > 5 THEN 'Forward Right' WHEN dx > 5 AND dy < -5 THEN 'Forward Left'
  WHEN dx > 5 AND abs(dy) <= 5 THEN 'Forward' WHEN abs(dx) <= 5 AND dy > 5 THEN 'Right'
  WHEN abs(dx) <= 5 AND dy < -5 THEN 'Left' WHEN dx < -5 AND dy > 5 THEN 'Backward Right'
  WHEN dx < -5 AND dy < -5 THEN 'Backward Left' WHEN dx < -5 AND abs(dy) <= 5 THEN 'Backward'
  ELSE 'no clear direction' END AS direction FROM d""")
def f6(spark, sf):
    v = feed(spark, sf)
    dx = F.when(F.col("k") % 6 != 0, F.col("Pass End X") - F.col("x"))
    return v.select("event_id", pass_direction(dx, F.col("Pass End Y") - F.col("y")).alias("direction"))


@query("f7_pitch_length", f"""
WITH {FEED}
SELECT event_id, {r('sqrt(power((end_x - x) * 105.0::DOUBLE / 100, 2) + power((end_y - y) * 68.0::DOUBLE / 100, 2))', 2)} AS len,
       {r('sqrt(power((100 - x) * 105.0::DOUBLE / 100, 2) + power((coalesce(goal_y, 50) - y) * 68.0::DOUBLE / 100, 2))', 2)} AS shot
FROM v_feed""")
def f7(spark, sf):
    from ..functions.pitch import shot_length
    return feed(spark, sf).select(
        "event_id", pitch_length("x", "y", F.col("Pass End X"), F.col("Pass End Y")).alias("len"),
        shot_length("x", "y", F.col("Goal Mouth Y Coordinate")).alias("shot"))


@query("f9_age_curve", f"""
WITH d AS (SELECT o_orderkey, date_diff('day', o_orderdate::DATE, DATE '2022-03-01') AS days FROM orders),
a AS (SELECT *, days / 365.25::DOUBLE AS age FROM d)
SELECT o_orderkey, {r('age', 6)} AS age, floor(days / 365.0)::BIGINT AS whole,
  CASE WHEN age <= 18 THEN 1.0 WHEN age <= 20 THEN 0.9 WHEN age <= 22 THEN 0.8 WHEN age <= 24 THEN 0.65
       WHEN age <= 26 THEN 0.45 WHEN age <= 29 THEN 0.25 WHEN age <= 31 THEN 0.1 ELSE 0.0 END::DOUBLE AS potential,
  CASE WHEN month(o_orderdate) >= 9 THEN make_date(year(o_orderdate), 8, 1)
       ELSE make_date(year(o_orderdate) - 1, 8, 1) END AS season
FROM a JOIN orders USING (o_orderkey)""")
def f9(spark, sf):
    o = table(spark, sf, "orders")
    day = F.col("o_orderdate").cast("date")
    return o.select("o_orderkey", num.round_even(num.age(day, "2022-03-01"), 6).alias("age"),
                    num.age_whole(day, "2022-03-01").cast("long").alias("whole"),
                    num.age_potential(num.age(day, "2022-03-01")).alias("potential"),
                    F.make_date(F.year(day) - F.when(F.month(day) >= 9, 0).otherwise(1),
                                F.lit(8), F.lit(1)).alias("season"))


@query("f10_one_hot", """
SELECT o_orderkey, (o_orderstatus = 'F')::INT AS "o_orderstatus_F", (o_orderstatus = 'O')::INT AS "o_orderstatus_O",
       (o_orderstatus = 'P')::INT AS "o_orderstatus_P" FROM orders""")
def f10(spark, sf):
    return shape.one_hot(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), ["o_orderstatus"])


@query("f11_stable_id", """
SELECT c_custkey, substr(sha256(c_custkey::VARCHAR || chr(1) || c_name), 1, 16) AS id FROM customer""")
def f11(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", stable_id("c_custkey", "c_name").alias("id"))


@query("f12_string_similarity")
def f12(spark, sf):
    """Each part's name against the name of its brand's first part, both scores."""
    p = table(spark, sf, "part")
    first = p.groupBy("p_brand").agg(F.min_by("p_name", "p_partkey").alias("other"))
    return p.join(first, "p_brand").select(
        "p_partkey", num.round_even(seq_ratio("p_name", "other"), 6).alias("ratio"),
        num.round_even(token_set_ratio("p_name", "other"), 6).alias("words"))


@query("p1_conform", """
SELECT l_orderkey::BIGINT AS "Match", l_partkey::BIGINT AS "Player", l_quantity AS "Minutes",
       NULL::DOUBLE AS "Missing", CASE WHEN l_returnflag = 'x' THEN 1 END::BIGINT AS "Flag"
FROM lineitem""")
def p1(spark, sf):
    return shape.conform(table(spark, sf, "lineitem"),
                         {"l_orderkey": "Match", "l_partkey": "Player", "l_quantity": "Minutes",
                          "l_returnflag": "Flag"},
                         ["Match", "Player", "Minutes", "Missing", "Flag"],
                         {"Match": "bigint", "Player": "bigint", "Flag": "bigint"})


@query("p2_coalesce_columns", """
SELECT o_orderkey AS "ID", coalesce(s_name, c_name) AS "Name", c_mktsegment AS "Segment", NULL::VARCHAR AS "Nothing"
FROM orders LEFT JOIN supplier ON s_suppkey = o_custkey LEFT JOIN customer ON c_custkey = o_custkey""")
def p2(spark, sf):
    o, s, c = (table(spark, sf, t) for t in ("orders", "supplier", "customer"))
    df = o.join(s, s["s_suppkey"] == o["o_custkey"], "left").join(c, c["c_custkey"] == o["o_custkey"], "left")
    return shape.coalesce_columns(df, {"ID": ["o_orderkey"], "Name": ["s_name", "c_name"],
                                       "Segment": ["c_mktsegment"], "Nothing": ["absent"]})


@query("p3_greatest_of", """
SELECT l_orderkey, l_linenumber, greatest(l_discount, l_tax, NULL) AS best, NULL::DOUBLE AS text, NULL::DOUBLE AS none
FROM lineitem""")
def p3(spark, sf):
    return shape.greatest_of(table(spark, sf, "lineitem"),
                             {"best": ["l_discount", "l_tax", "l_returnflag"], "text": ["l_linestatus"],
                              "none": ["absent"]}, keep=["l_orderkey", "l_linenumber"])


@query("p4_suffix", """
SELECT n_nationkey, n_name AS "n_nameSS", r_name AS "r_nameSW" FROM nation JOIN region ON n_regionkey = r_regionkey""")
def p4(spark, sf):
    n = shape.suffix(table(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey"),
                     ["n_nationkey", "n_regionkey"], "SS")
    rg = shape.suffix(table(spark, sf, "region").withColumnRenamed("r_regionkey", "n_regionkey"),
                      ["n_regionkey"], "SW")
    return n.join(rg, "n_regionkey").drop("n_regionkey")


@query("p5_team_rows", f"""
WITH {SIDES}
SELECT id AS "Match", team AS "Team", opp AS "Opponent", ha AS "HomeAway", score AS "Score", opp_score AS "OpponentScore",
       {r('elo', 6)} AS "Elo", {r('opp_elo', 6)} AS "OpponentElo", score - opp_score AS "ScoreDiff",
       CASE WHEN score > opp_score THEN 1 WHEN score < opp_score THEN -1 ELSE 0 END AS "Result",
       CASE WHEN score > opp_score THEN 'Win' WHEN score < opp_score THEN 'Loss' ELSE 'Draw' END AS "ResultText",
       {r('elo - opp_elo', 6)} AS "EloDiff"
FROM v_sides""")
def p5(spark, sf):
    out = shape.to_team_rows(matches(spark, sf), home_elo="HomeElo", away_elo="AwayElo")
    return out.withColumns({c: num.round_even(c, 6) for c in ("Elo", "OpponentElo", "EloDiff")})


@query("p6_position_fallback", """
WITH t AS (SELECT p_partkey, CASE p_type WHEN 'SMALL' THEN '' WHEN 'LARGE' THEN 'Substitute' WHEN 'PROMO' THEN NULL
             WHEN 'ECONOMY' THEN 'Striker' ELSE 'Defender ' END AS sw,
           CASE WHEN p_size % 3 = 0 THEN 'Left' WHEN p_size % 3 = 1 THEN '0' END AS side,
           CASE WHEN p_size % 2 = 0 THEN 'G' ELSE 'zz' END AS ss FROM part),
n AS (SELECT *, CASE WHEN trim(coalesce(sw, '')) IN ('', 'Substitute') THEN ss
                ELSE trim(trim(sw) || ' ' || coalesce(nullif(side, '0'), '')) END AS raw FROM t)
SELECT p_partkey, CASE raw WHEN 'G' THEN 'Goalkeeper' WHEN 'Striker Left' THEN 'Striker Left'
  WHEN 'Defender Left' THEN 'Defender Left' WHEN 'Defender' THEN 'Defender' END AS "Position" FROM n""")
def p6(spark, sf):
    kind, size = F.col("p_type"), F.col("p_size")
    df = table(spark, sf, "part").select(
        "p_partkey", F.when(kind == "SMALL", "").when(kind == "LARGE", "Substitute")
        .when(kind == "PROMO", F.lit(None)).when(kind == "ECONOMY", "Striker").otherwise("Defender ").alias("positionSW"),
        F.when(size % 3 == 0, "Left").when(size % 3 == 1, "0").alias("position_sideSW"),
        F.when(size % 2 == 0, "G").otherwise("zz").alias("positionSS"))
    return shape.resolve_position(df).select("p_partkey", "Position")


@query("p7_formation_position", """
WITH m(f, raw, pos) AS (VALUES ('1-URGENT','F','GK'),('1-URGENT','O','CB'),('5-LOW','P','ST'),('2-HIGH','F','DM'))
SELECT o_orderkey, pos AS "Position", CASE o_orderpriority WHEN '1-URGENT' THEN 'top' WHEN '5-LOW' THEN 'low' END AS "Formation"
FROM orders LEFT JOIN m ON f = o_orderpriority AND raw = o_orderstatus""")
def p7(spark, sf):
    fm = spark.createDataFrame([("1-URGENT", "F", "GK"), ("1-URGENT", "O", "CB"), ("5-LOW", "P", "ST"),
                                ("2-HIGH", "F", "DM")], "formation string, raw_position string, position string")
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderpriority").alias("Formation"),
                                          F.col("o_orderstatus").alias("Position"))
    return shape.map_by_formation(o, fm, canonical={"1-URGENT": "top", "5-LOW": "low"}).select(
        "o_orderkey", "Position", "Formation")


_COL = "CASE WHEN p_size % {m} = 0 THEN '#ffffff' WHEN p_size % {m} = 1 THEN NULL ELSE p_brand END"


@query("p8_colour_repair", f"""
WITH t AS (SELECT p_partkey, {_COL.format(m=2).replace("NULL", "'#FFFFFF'")} AS p, {_COL.format(m=3)} AS s,
   {_COL.format(m=4)} AS k1, {_COL.format(m=5)} AS k2, {_COL.format(m=6)} AS sh, {_COL.format(m=7)} AS a1,
   {_COL.format(m=8)} AS a2, {_COL.format(m=9)} AS as1 FROM part),
f AS (SELECT p_partkey, p, s, coalesce(k1, p) k1, k2, coalesce(sh, p) sh, coalesce(a1, p) a1, a2, coalesce(as1, p) as1 FROM t),
w AS (SELECT p_partkey, CASE WHEN lower(p) = '#ffffff' THEN s ELSE p END AS p,
             CASE WHEN lower(p) = '#ffffff' THEN p ELSE s END AS s, k1, k2, sh, a1, a2, as1 FROM f),
c AS (SELECT *, CASE WHEN lower(p) = '#ffffff' THEN coalesce(nullif(s, '#ffffff'), nullif(k1, '#ffffff'),
   nullif(k2, '#ffffff'), nullif(sh, '#ffffff'), nullif(a1, '#ffffff'), nullif(a2, '#ffffff'), nullif(as1, '#ffffff'), p)
   ELSE p END AS q FROM w)
SELECT p_partkey, CASE WHEN q = '#ffffff' THEN '#919191' ELSE q END AS "PrimaryColour", s AS "SecondaryColour" FROM c""")
def p8(spark, sf):
    def col(m, other=None):
        z = F.col("p_size") % m
        return F.when(z == 0, "#ffffff").when(z == 1, F.lit(other)).otherwise(F.col("p_brand"))

    df = table(spark, sf, "part").select(
        "p_partkey", col(2, "#FFFFFF").alias("PrimaryColour"), col(3).alias("SecondaryColour"),
        col(4).alias("HomeKitCol1"), col(5).alias("HomeKitCol2"), col(6).alias("HomeShortsCol"),
        col(7).alias("AwayKitCol1"), col(8).alias("AwayKitCol2"), col(9).alias("AwayShortsCol"))
    return shape.repair_colours(df).select("p_partkey", "PrimaryColour", "SecondaryColour")


@query("p9_name_split", """
SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN 'Known' ELSE split_part(p_name, ' ', 1) || ' ' || p_type END AS first_name,
       CASE WHEN p_size % 4 = 0 THEN NULL ELSE split_part(p_name, ' ', 2) END AS last_name FROM part""")
def p9(spark, sf):
    w = F.split("p_name", " ")
    df = table(spark, sf, "part").select(
        "p_partkey", F.concat_ws(" ", w[0], "p_type", w[1]).alias("Name"),
        F.when(F.col("p_size") % 4 == 0, "Known").alias("FirstName"),
        F.lit(None).cast("string").alias("LastName"))
    return shape.split_name(df).select("p_partkey", F.col("FirstName").alias("first_name"),
                                       F.col("LastName").alias("last_name"))


@query("p10_sample_filters", """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
WHERE l_orderkey IN (SELECT l_orderkey FROM lineitem GROUP BY l_orderkey HAVING count(*) = 2) AND l_quantity >= 10""")
def p10(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return shape.min_sample(shape.exact_group_size(li, ["l_orderkey"], 2), "l_quantity", 10)


@query("p11_team_tournaments", f"""
WITH {MATCH}, p AS (SELECT DISTINCT unnest([home, away]) AS team, league FROM v_match WHERE season = '1997'),
g AS (SELECT team, list_sort(list(league)) AS codes FROM p GROUP BY team)
SELECT team AS "Team", array_to_string(list_transform(codes, lambda x: CASE x WHEN 'BUILDING' THEN 'Build' ELSE x END), ',') AS names
FROM g WHERE list_has_any(codes, ['BUILDING', 'MACHINERY'])""")
def p11(spark, sf):
    m = shape.season_filter(matches(spark, sf), 1997)
    out = shape.team_tournaments(m, ["BUILDING", "MACHINERY"], {"BUILDING": "Build"})
    return out.select("Team", F.array_join("Tournaments", ",").alias("names"))


@query("p12_relevant_stats", """
WITH a AS (SELECT *, CASE WHEN p_type = 'SMALL' THEN ['size','price'] WHEN p_type = 'LARGE' THEN ['price','cents'] ELSE [] END AS own,
  CASE WHEN p_size % 2 = 0 THEN ['cents'] ELSE [] END AS second FROM part),
b AS (SELECT *, list_distinct(list_concat(own, second)) AS allowed FROM a)
SELECT p_partkey, CASE WHEN list_contains(allowed, 'size') THEN nullif(p_size % 5, 0) END::DOUBLE AS size,
       CASE WHEN list_contains(allowed, 'price') THEN p_retailprice END AS price,
       CASE WHEN list_contains(allowed, 'cents') THEN nullif(p_partkey % 3, 0) END::DOUBLE AS cents
FROM b""")
def p12(spark, sf):
    lists = {"SMALL": ["size", "price"], "LARGE": ["price", "cents"], "even": ["cents"]}
    df = table(spark, sf, "part").select(
        "p_partkey", F.col("p_type").alias("FirstPos"),
        F.when(F.col("p_size") % 2 == 0, "even").alias("SecondPos"), F.lit(None).cast("string").alias("ThirdPos"),
        F.create_map(F.lit("size"), (F.col("p_size") % 5).cast("double"), F.lit("price"), F.col("p_retailprice"),
                     F.lit("cents"), (F.col("p_partkey") % 3).cast("double")).alias("Stats"))
    out = shape.relevant_stats(shape.position_columns(df, lists), "Allowed")
    get = lambda k: F.try_element_at("AggregatedStats", F.lit(k)).alias(k)
    return out.select("p_partkey", get("size"), get("price"), get("cents"))


@query("p13_prune", """
SELECT c_custkey, CASE WHEN c_nationkey % 3 = 0 THEN NULL ELSE c_mktsegment END AS segment,
       CASE WHEN c_nationkey % 4 <> 0 THEN c_acctbal END AS balance,
       CASE WHEN c_nationkey % 3 <> 0 THEN c_mktsegment END AS tags, CASE WHEN c_nationkey % 5 <> 0 THEN 1 ELSE 0 END AS has_info
FROM customer""")
def p13(spark, sf):
    seg = F.when(F.col("c_nationkey") % 3 == 0, F.lit("  ")).otherwise(F.col("c_mktsegment"))
    df = table(spark, sf, "customer").select(
        "c_custkey", seg.alias("segment"),
        F.when(F.col("c_nationkey") % 4 == 0, F.lit(float("nan"))).otherwise(F.col("c_acctbal")).alias("balance"),
        F.array(seg, F.lit("")).alias("tags"),
        F.struct(F.when(F.col("c_nationkey") % 5 != 0, F.col("c_name")).alias("n")).alias("info"))
    return shape.prune(df, ["c_custkey"]).select(
        "c_custkey", "segment", "balance", F.array_join("tags", "|").alias("tags"),
        F.col("info").isNotNull().cast("int").alias("has_info"))


@query("p14_drop_constant_columns", """
SELECT l_orderkey, l_linenumber, l_quantity, l_tax FROM lineitem""")
def p14(spark, sf):
    df = table(spark, sf, "lineitem").withColumns({
        "one": F.lit(1), "holes": F.when(F.col("l_linenumber") != 3, F.col("l_tax"))})
    return shape.drop_constant_columns(df, ["l_quantity", "l_tax", "one", "holes"],
                                       keep=["l_orderkey", "l_linenumber"])


@query("p15_pass_map", f"""
WITH {FEED}, n AS (SELECT *, lead(player) OVER (PARTITION BY match ORDER BY ts, event_id) AS nxt FROM v_feed),
p AS (SELECT *, end_x - x AS dx, end_y - y AS dy FROM n WHERE type = 'Pass' AND nxt IS NOT NULL)
SELECT strftime(match, '%Y-%m-%d') AS "Match", player AS "Player", team AS "Team",
  CASE WHEN outcome <> 0 THEN nxt END AS "PassReceiver", outcome AS "AccuratePass", x AS "IniX", y AS "IniY", end_x AS "EndX",
  end_y AS "EndY", angle AS "Angle", zone AS "Zone",
  {r('sqrt(power(dx * 105.0::DOUBLE / 100, 2) + power(dy * 68.0::DOUBLE / 100, 2))', 2)} AS "Length",
  CASE WHEN dx > 5 AND dy > 5 THEN 'Forward Right' WHEN dx > 5 AND dy < -5 THEN 'Forward Left'
  WHEN dx > 5 THEN 'Forward' WHEN abs(dx) <= 5 AND dy > 5 THEN 'Right' WHEN abs(dx) <= 5 AND dy < -5 THEN 'Left'
  WHEN dx < -5 AND dy > 5 THEN 'Backward Right' WHEN dx < -5 AND dy < -5 THEN 'Backward Left' WHEN dx < -5 THEN 'Backward'
  ELSE 'no clear direction' END AS "PassDirection" FROM p""")
def p15(spark, sf):
    from ..operators.windows import next_actor
    ev = next_actor(feed(spark, sf).withColumn("Length", F.lit(0.0)))
    return shape.pass_map(ev.withColumn("match", F.date_format("match", "yyyy-MM-dd")))


@query("p16_shot_map", f"""
WITH {FEED}
SELECT match AS "Match", n_name AS "Team", player AS "Player", type AS "Type", x AS "IniX", y AS "IniY", block_x AS "BlockX",
       block_y AS "BlockY", goal_y AS "GoalY", goal_z AS "GoalZ", zone AS "Zone",
       {r('sqrt(power((100 - x) * 105.0::DOUBLE / 100, 2) + power((coalesce(goal_y, 50) - y) * 68.0::DOUBLE / 100, 2))', 2)} AS "Length"
FROM v_feed LEFT JOIN nation ON n_nationkey = team WHERE type <> 'Pass'""")
def p16(spark, sf):
    names = table(spark, sf, "nation").select(F.col("n_nationkey").cast("long").alias("key"),
                                              F.col("n_name").alias("value"))
    return shape.shot_map(feed(spark, sf), teams=names)


@query("p17_fallback_positions", """
WITH t AS (SELECT p_partkey, CASE p_type WHEN 'SMALL' THEN 'Left Winger' WHEN 'LARGE' THEN 'Center-Back' END AS f,
                  CASE WHEN p_size % 2 = 0 THEN 'Goalkeeper' END AS pos FROM part)
SELECT p_partkey, coalesce(CASE f WHEN 'Left Winger' THEN 'LW' WHEN 'Center-Back' THEN 'CB' END,
                           CASE WHEN pos = 'Goalkeeper' THEN 'GK' END) AS "FirstPos",
       coalesce(CASE f WHEN 'Left Winger' THEN 'WG' WHEN 'Center-Back' THEN 'CB' END,
                CASE WHEN pos = 'Goalkeeper' THEN 'GK' END) AS "MainPos"
FROM t WHERE f IS NOT NULL OR pos IS NOT NULL""")
def p17(spark, sf):
    none = F.lit(None).cast("string")
    df = table(spark, sf, "part").select(
        "p_partkey", F.when(F.col("p_type") == "SMALL", "Left Winger").when(
            F.col("p_type") == "LARGE", "Center-Back").alias("FirstPos"), none.alias("SecondPos"),
        none.alias("ThirdPos"), F.when(F.col("p_size") % 2 == 0, "Goalkeeper").alias("Position"))
    return shape.fallback_positions(df).select("p_partkey", "FirstPos", "MainPos")


@query("p18_publish", """
SELECT c_custkey, c_name FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 2)""")
def p18(spark, sf):
    wanted = table(spark, sf, "nation").filter("n_regionkey = 2")
    return shape.publish(table(spark, sf, "customer"), ["c_custkey", "c_name"], wanted,
                         team="c_nationkey", team_id="n_nationkey")


@query("j1_left_join", """
SELECT l_orderkey, l_linenumber, o_custkey, o_orderstatus FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey""")
def j1(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderstatus")
    return joins.left_join(li, o, ["l_orderkey"])


@query("j2_inner_join", """
SELECT l_orderkey, l_linenumber, l_partkey, p_name FROM lineitem JOIN part ON l_partkey = p_partkey""")
def j2(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return joins.inner_join(li, table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name"),
                            ["l_partkey"])


@query("j3_outer_match", """
WITH a AS (SELECT CASE WHEN c_custkey % 7 <> 0 THEN c_custkey END AS id_a, c_nationkey AS nation, c_custkey // 10 AS grp, c_name FROM customer),
b AS (SELECT s_suppkey AS id_b, s_nationkey AS nation, s_suppkey // 10 AS grp, s_name FROM supplier),
j AS (SELECT coalesce(a.nation, b.nation) AS nation, coalesce(a.grp, b.grp) AS grp, id_a, id_b, c_name, s_name
      FROM a FULL JOIN b ON a.nation = b.nation AND a.grp = b.grp),
d AS (SELECT *, row_number() OVER (PARTITION BY id_a ORDER BY id_b NULLS LAST) AS rn FROM j)
SELECT nation, grp, id_a, id_b AS "id_bSW", c_name AS "c_nameSS", s_name AS "s_nameSW" FROM d WHERE id_a IS NULL OR rn = 1""")
def j3(spark, sf):
    a = table(spark, sf, "customer").select(
        F.when(F.col("c_custkey") % 7 != 0, F.col("c_custkey")).alias("id_a"), F.col("c_nationkey").alias("nation"),
        F.floor(F.col("c_custkey") / 10).alias("grp"), "c_name")
    b = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id_b"), F.col("s_nationkey").alias("nation"),
                                            F.floor(F.col("s_suppkey") / 10).alias("grp"), "s_name")
    out = joins.outer_match(a, b.withColumn("id_bSW", F.col("id_b")).drop("id_b"), ["nation", "grp"],
                            "id_a", "id_bSWSW")
    return out.withColumnRenamed("id_bSWSW", "id_bSW")


@query("j4_map_column", """
SELECT s_suppkey, CASE WHEN s_suppkey % 5 <> 0 THEN n_name END AS "Nation" FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey""")
def j4(spark, sf):
    s = table(spark, sf, "supplier").select("s_suppkey", F.when(
        F.col("s_suppkey") % 5 != 0, F.col("s_nationkey")).alias("Nation"))
    n = table(spark, sf, "nation")
    old = n.select(F.col("n_nationkey").alias("key"), F.lit("Z").alias("value"), F.lit(0).alias("at"))      # overwritten
    lk = old.unionByName(n.select(F.col("n_nationkey").alias("key"), F.col("n_name").alias("value"), F.lit(1).alias("at")))
    return joins.map_column(s, "Nation", lk, order="at")


@query("j5_semi_anti", """
SELECT c_custkey, CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') THEN 'with' ELSE 'without' END AS kind
FROM customer""")
def j5(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey")
    o = table(spark, sf, "orders").filter("o_orderstatus = 'P'")
    a = joins.semi(c, o, "c_custkey", "o_custkey").withColumn("kind", F.lit("with"))
    return a.unionByName(joins.anti(c, o, "c_custkey", "o_custkey").withColumn("kind", F.lit("without")))


@query("j6_embed", """
SELECT c_custkey, CASE WHEN c_nationkey >= 20 THEN 99 ELSE c_nationkey END AS nation, n_name AS name, n_regionkey AS region
FROM customer LEFT JOIN nation ON n_nationkey = CASE WHEN c_nationkey >= 20 THEN 99 ELSE c_nationkey END""")
def j6(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", F.when(F.col("c_nationkey") >= 20, 99).otherwise(
        F.col("c_nationkey")).alias("nation"))
    out = joins.embed(c, table(spark, sf, "nation"), "nation", ["n_name", "n_regionkey"], "n_nationkey")
    return out.select("c_custkey", "nation", F.col("nationInfo.n_name").alias("name"),
                      F.col("nationInfo.n_regionkey").alias("region"))


@query("j7_squad_pairs", f"""
WITH {MATCH}, m AS (SELECT c_custkey AS id, c_nationkey::BIGINT AS team, c_mktsegment AS grp FROM customer),
w AS (SELECT DISTINCT home AS team_a, away AS team_b FROM v_match)
SELECT team_a, team_b, count(*) AS pairs FROM w JOIN m a ON a.team = team_a JOIN m b ON b.team = team_b AND a.grp = b.grp
WHERE a.id <> b.id GROUP BY team_a, team_b""")
def j7(spark, sf):
    m = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"),
                                            F.col("c_nationkey").cast("long").alias("team"),
                                            F.col("c_mktsegment").alias("grp"))
    w = matches(spark, sf).select(F.col("HomeTeam").alias("team_a"), F.col("AwayTeam").alias("team_b"))
    return joins.squad_pairs(m, w)


@query("u1_union_drift", """
SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, NULL::BIGINT AS nation FROM customer
UNION ALL SELECT s_suppkey, s_name, NULL, s_nationkey FROM supplier""")
def u1(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                                            F.col("c_mktsegment").alias("segment"))
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
                                            F.col("s_nationkey").cast("long").alias("nation"))
    return shape.union_all([c, s])


@query("u2_dedup_first", """
SELECT o_custkey, o_orderkey, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1""")
def u2(spark, sf):
    o = table(spark, sf, "orders")
    return shape.dedup(o, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select(
        "o_custkey", "o_orderkey", "o_totalprice")


@query("u3_overlap_flag", """
WITH l AS (SELECT c_nationkey AS nation, list(DISTINCT c_mktsegment) AS segs FROM customer GROUP BY c_nationkey),
s AS (SELECT s_nationkey AS nation, list(DISTINCT CASE WHEN s_acctbal > 5000 THEN 'BUILDING' ELSE 'FURNITURE' END) AS segs FROM supplier GROUP BY s_nationkey),
g AS (SELECT n_nationkey, list_transform(l.segs, lambda x: CASE x WHEN 'BUILDING' THEN 'A' WHEN 'MACHINERY' THEN 'A' WHEN 'FURNITURE' THEN 'B' END) AS a,
  list_transform(s.segs, lambda x: CASE x WHEN 'BUILDING' THEN 'A' WHEN 'MACHINERY' THEN 'A' WHEN 'FURNITURE' THEN 'B' END) AS b
  FROM nation LEFT JOIN l ON l.nation = n_nationkey LEFT JOIN s ON s.nation = n_nationkey)
SELECT n_nationkey, CASE WHEN list_has_any(coalesce(a, []), coalesce(b, [])) THEN 1 ELSE 0 END AS match FROM g""")
def u3(spark, sf):
    from ..operators.aggregate import distinct_lists
    c = distinct_lists(table(spark, sf, "customer"), "c_nationkey", "c_mktsegment")
    s = table(spark, sf, "supplier").withColumn("seg", F.when(F.col("s_acctbal") > 5000, "BUILDING").otherwise("FURNITURE"))
    s = distinct_lists(s, "s_nationkey", "seg")
    n = table(spark, sf, "nation").select("n_nationkey")
    df = n.join(c, n["n_nationkey"] == c["c_nationkey"], "left").join(s, n["n_nationkey"] == s["s_nationkey"], "left")
    groups = {"BUILDING": "A", "MACHINERY": "A", "FURNITURE": "B"}
    return df.select("n_nationkey", shape.overlap_flag("c_mktsegmentList", "segList", groups).alias("match"))
