"""Checks of aggregations, pivots and metric catalogues."""

from pyspark.sql import functions as F

from ..functions.numeric import round_even
from ..operators import aggregate as agg, shape
from ..operators.windows import next_actor
from .views import FEED, MATCH, SIDES, STATS, feed, matches, query, r, ratio, stats, table


def rounded(df, n, *cols):
    return df.withColumns({c: round_even(F.col(c).cast("double"), n) for c in cols})


@query("a1_fill_scores", f"""
WITH {MATCH}, {STATS.strip()}, g AS (SELECT match, team % 25 AS team, sum(goals) AS g FROM v_stats GROUP BY 1, 2),
m AS (SELECT id, home, away, CASE WHEN hs <> 0 THEN hs END AS hs, CASE WHEN as_ <> 1 THEN as_ END AS as_ FROM v_match)
SELECT id AS "ID", coalesce(hs, h.g)::BIGINT AS "HomeScore", coalesce(as_, a.g)::BIGINT AS "AwayScore"
FROM m LEFT JOIN g h ON h.match = id AND h.team = home LEFT JOIN g a ON a.match = id AND a.team = away
WHERE coalesce(hs, h.g) IS NOT NULL AND coalesce(as_, a.g) IS NOT NULL""")
def a1(spark, sf):
    m = matches(spark, sf).withColumns({
        "HomeScore": F.when(F.col("HomeScore") != 0, F.col("HomeScore")),
        "AwayScore": F.when(F.col("AwayScore") != 1, F.col("AwayScore"))})
    s = stats(spark, sf).withColumn("Team", F.col("Team") % 25)
    return agg.fill_scores(m, s).select("ID", "HomeScore", "AwayScore")


@query("a2_team_from_players", f"""
WITH {STATS}, p AS (SELECT match, team, sum(passes) AS passes, sum(goals) AS goals, max(minutes) AS minutes FROM v_stats GROUP BY 1, 2),
t AS (SELECT l_orderkey AS match, l_suppkey AS team, max(CASE WHEN l_returnflag <> 'N' THEN floor(l_extendedprice)::BIGINT % 90 END) AS passes,
             max(CASE WHEN l_linestatus = 'O' THEN l_linenumber END)::BIGINT AS fouls FROM lineitem GROUP BY 1, 2)
SELECT match AS "Match", team AS "Team", CASE WHEN t.passes IS NULL OR p.passes IS NULL THEN 0 ELSE greatest(t.passes, p.passes) END::BIGINT AS "Passes",
       coalesce(fouls, 0) AS "Fouls", p.goals::BIGINT AS "Goals", minutes AS "MinutesPlayed"
FROM t JOIN p USING (match, team)""")
def a2(spark, sf):
    s = stats(spark, sf).select("Match", "Team", "Player", "ShirtNumber", "Position", "Passes", "Goals", "MinutesPlayed")
    t = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("Match"), F.col("l_suppkey").alias("Team")).agg(
        F.max(F.when(F.col("l_returnflag") != "N", F.floor("l_extendedprice") % 90)).alias("Passes"),
        F.max(F.when(F.col("l_linestatus") == "O", F.col("l_linenumber").cast("long"))).alias("Fouls"))
    return agg.team_from_players(t, s)


_RULES = {"Rating": "mean", "Position": "mode", "ShirtNumber": "mode"}


@query("a3_entity_aggregate", f"""
WITH {STATS},
md AS (SELECT player, shirt FROM (SELECT player, shirt, row_number() OVER (PARTITION BY player ORDER BY count(*) DESC, shirt) AS rn
       FROM v_stats GROUP BY player, shirt) WHERE rn = 1),
a AS (SELECT player, any_value(position) AS position, count(*) AS n, sum(minutes)::BIGINT AS minutes, sum(passes)::BIGINT AS passes,
      sum(acc)::BIGINT AS acc, coalesce(sum(CASE WHEN minutes < 0 THEN 1 END), 0)::BIGINT AS nothing, avg(xg) AS rating FROM v_stats GROUP BY player)
SELECT player AS "Player", position AS "Position", md.shirt AS "ShirtNumber", n AS "Matches", minutes AS "MinutesPlayed", passes AS "Passes",
       nothing AS "Nothing", {r('rating', 9)} AS "Rating", {ratio('acc', 'passes')} AS "PassAccuracy"
FROM a JOIN md USING (player)""")
def a3(spark, sf):
    s = stats(spark, sf).select("Player", "Position", "ShirtNumber", "MinutesPlayed", "Passes", "AccuratePasses",
                                F.when(F.col("MinutesPlayed") < 0, F.lit(1).cast("long")).alias("Nothing"),
                                F.col("ExpectedGoals").alias("Rating"), F.lit(1.0).alias("GoalsPer90"))
    out = agg.with_metrics(agg.aggregate_entity(s, "Player", _RULES), agg.PLAYER_METRICS)
    return rounded(out, 9, "Rating").select("Player", "Position", "ShirtNumber", "Matches", "MinutesPlayed", "Passes",
                                            "Nothing", "Rating", "PassAccuracy")


@query("a4_mode_smallest", """
WITH c AS (SELECT p_type, CASE WHEN p_brand <> 'Brand#1' AND p_type <> 'PROMO' THEN p_brand END AS b FROM part),
n AS (SELECT p_type, b, count(b) AS n FROM c GROUP BY 1, 2),
k AS (SELECT p_type, b, row_number() OVER (PARTITION BY p_type ORDER BY b IS NULL, n DESC, b) AS rn FROM n)
SELECT p_type, b AS brand FROM k WHERE rn = 1""")
def a4(spark, sf):
    p = table(spark, sf, "part").withColumn("brand", F.when(
        (F.col("p_brand") != "Brand#1") & (F.col("p_type") != "PROMO"), F.col("p_brand")))
    return agg.mode_min(p, ["p_type"], "brand")


def _passes(spark, sf):
    ev = next_actor(feed(spark, sf).withColumn("Length", F.lit(0.0)))
    return shape.pass_map(ev)


_P = f"""
WITH {FEED}, n AS (SELECT *, lead(player) OVER (PARTITION BY match ORDER BY ts, event_id) AS nxt FROM v_feed),
p0 AS (SELECT *, end_x - x AS dx, end_y - y AS dy FROM n WHERE type = 'Pass' AND nxt IS NOT NULL),
p AS (SELECT *, {r('sqrt(power(dx * 105.0::DOUBLE / 100, 2) + power(dy * 68.0::DOUBLE / 100, 2))', 2)} AS len,
  CASE WHEN dx > 5 THEN 'F' WHEN dx < -5 THEN 'B' ELSE '' END || CASE WHEN dy > 5 THEN 'R' WHEN dy < -5 THEN 'L' ELSE '' END AS dir FROM p0)"""


@query("a5_pass_aggregate", f"""
{_P}
SELECT match AS "Match", team AS "Team", player AS "Player", {r('avg(angle)', 6)} AS "PassMeanAngle", {r('avg(len)', 6)} AS "PassMeanLength",
  {r('sum(len)', 4)} AS "PassTotalLength", {r('avg(x)', 6)} AS "PassMeanX", {r('avg(y)', 6)} AS "PassMeanY",
  count(*) FILTER (zone = 'Back') AS "PassZoneBack", coalesce(sum(outcome) FILTER (zone = 'Right'), 0)::BIGINT AS "PassAccZoneRight",
  {r("coalesce(sum(outcome) FILTER (zone = 'Left') / nullif(count(*) FILTER (zone = 'Left'), 0)::DOUBLE, 0)", 6)} AS "PassPercZoneLeft",
  count(*) FILTER (dir = 'B') AS "PassDirBackward", count(*) FILTER (dir = 'FR') AS "PassDirForwardRight",
  coalesce(sum(outcome) FILTER (dir = 'BL'), 0)::BIGINT AS "PassAccDirBackwardLeft",
  {r("coalesce(sum(outcome) FILTER (dir = 'FL') / nullif(count(*) FILTER (dir = 'FL'), 0)::DOUBLE, 0)", 6)} AS "PassPercDirForwardLeft"
FROM p GROUP BY match, team, player""")
def a5(spark, sf):
    out = agg.aggregate_passes(_passes(spark, sf))
    out = rounded(out, 6, "PassMeanAngle", "PassMeanLength", "PassMeanX", "PassMeanY", "PassPercZoneLeft",
                  "PassPercDirForwardLeft")
    return rounded(out, 4, "PassTotalLength").select(
        "Match", "Team", "Player", "PassMeanAngle", "PassMeanLength", "PassTotalLength", "PassMeanX", "PassMeanY",
        "PassZoneBack", "PassAccZoneRight", "PassPercZoneLeft", "PassDirBackward", "PassDirForwardRight",
        "PassAccDirBackwardLeft", "PassPercDirForwardLeft")


@query("a6_shot_aggregate", f"""
WITH {FEED}, s AS (SELECT *, {r('sqrt(power((100 - x) * 105.0::DOUBLE / 100, 2) + power((coalesce(goal_y, 50) - y) * 68.0::DOUBLE / 100, 2))', 2)} AS len
  FROM v_feed WHERE type <> 'Pass')
SELECT match AS "Match", team AS "Team", player AS "Player", {r('avg(x)', 6)} AS "ShotMeanX", {r('coalesce(avg(goal_y), 0)', 6)} AS "MeanGoalY",
  {r('coalesce(avg(goal_z), 0)', 6)} AS "MeanGoalZ", {r('sum(len)', 4)} AS "ShotTotalLenght", {r('avg(len)', 6)} AS "ShotMeanLength",
  count(*) FILTER (type = 'Goal') AS "TotalGoals", count(*) FILTER (type = 'Miss') AS "MissedShots",
  count(*) FILTER (type = 'Post') AS "ShotsOnPost", count(*) FILTER (type = 'Saved Shot') AS "SavedShots",
  {r("coalesce(avg(x) FILTER (type = 'Goal'), 0)", 6)} AS "GoalIniX", {r("coalesce(avg(len) FILTER (type = 'Goal'), 0)", 6)} AS "GoalMeanLength"
FROM s GROUP BY match, team, player""")
def a6(spark, sf):
    out = agg.aggregate_shots(shape.shot_map(feed(spark, sf)))
    cols = ["ShotMeanX", "MeanGoalY", "MeanGoalZ", "ShotMeanLength", "GoalIniX", "GoalMeanLength"]
    out = rounded(rounded(out, 6, *cols), 4, "ShotTotalLenght")
    return out.select("Match", "Team", "Player", *cols, "ShotTotalLenght", "TotalGoals", "MissedShots",
                      "ShotsOnPost", "SavedShots")


@query("a7_team_rating", f"""
WITH {STATS}, m AS (SELECT match, team, avg(CASE WHEN shirt <> 2 THEN xg END) AS rating FROM v_stats GROUP BY 1, 2)
SELECT match AS "Match", team AS "Team", {r('rating', 6)} AS "Rating" FROM m""")
def a7(spark, sf):
    s = stats(spark, sf).withColumn("Rating", F.when(F.col("ShirtNumber") != 2, F.col("ExpectedGoals")))
    t = s.select("Match", "Team").distinct()
    return rounded(agg.team_rating(t, s), 6, "Rating")


@query("a8_distinct_lists", """
SELECT o_custkey, array_to_string(list_sort(list(DISTINCT o_orderpriority)), ',') AS priorities FROM orders GROUP BY 1""")
def a8(spark, sf):
    out = agg.distinct_lists(table(spark, sf, "orders"), "o_custkey", "o_orderpriority")
    return out.select("o_custkey", F.array_join("o_orderpriorityList", ",").alias("priorities"))


@query("a9_teams_per_league", f"""
WITH {SIDES} SELECT DISTINCT league AS "League", team AS "Team" FROM v_sides""")
def a9(spark, sf):
    return agg.teams_per_league(matches(spark, sf))


@query("a10_team_context", f"""
WITH {SIDES}
SELECT team AS "Team", sum(score) FILTER (ha = 'Home')::BIGINT AS "HomeGoals", sum(opp_score) FILTER (ha = 'Home')::BIGINT AS "HomeOppGoals",
  sum(opp_score) FILTER (ha = 'Away')::BIGINT AS "AwayOppGoals", sum(score) FILTER (ha = 'Away')::BIGINT AS "AwayGoals",
  {r('avg(elo)', 4)} AS "Elo", {r('avg(opp_elo)', 4)} AS "OppElo"
FROM v_sides GROUP BY team HAVING count(*) FILTER (ha = 'Home') > 0 AND count(*) FILTER (ha = 'Away') > 0""")
def a10(spark, sf):
    rows = shape.to_team_rows(matches(spark, sf), home_elo="HomeElo", away_elo="AwayElo")
    return rounded(agg.team_context(rows), 4, "Elo", "OppElo")


@query("a11_match_importance", f"""
WITH o AS (SELECT o_custkey AS player, o_orderkey, o_orderpriority AS league, o_totalprice AS minutes,
   CASE o_orderpriority WHEN '1-URGENT' THEN 50 WHEN '2-HIGH' THEN 40 WHEN '3-MEDIUM' THEN 30 ELSE 20 END AS w FROM orders),
b AS (SELECT player, avg(w) AS mean, max(w) AS mx, count(DISTINCT league) AS nc, count(DISTINCT o_orderkey) AS nm, sum(minutes) AS mins FROM o GROUP BY player),
s AS (SELECT *, mean * (1 + 0.1::DOUBLE * (nc - 1)) AS score FROM b),
l AS (SELECT min(score) AS lo, max(score) AS hi FROM s)
SELECT player AS "Player", {r('mean', 6)} AS "MeanTournamentWeight", mx AS "MaxTournamentWeight", nc AS "NumCompetitions", nm AS "MatchesPlayed",
  {r('mins', 2)} AS "TotalMinutes", {r('score', 6)} AS "CompetitionScore",
  {r('CASE WHEN hi = lo THEN 0.5 ELSE 0.5 + (score - lo) / (hi - lo) * 0.5 END', 6)} AS "NormWeight"
FROM s, l""")
def a11(spark, sf):
    p = F.col("o_orderpriority")
    o = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("Player"), F.col("o_orderkey").alias("Match"), p.alias("League"),
        F.col("o_totalprice").alias("MinutesPlayed"), F.when(p == "1-URGENT", 50).when(p == "2-HIGH", 40).when(
            p == "3-MEDIUM", 30).otherwise(20).alias("Weight"))
    out = agg.match_importance(o)
    return rounded(rounded(out, 6, "MeanTournamentWeight", "CompetitionScore", "NormWeight"), 2, "TotalMinutes")


@query("a12_nested_collection", """
WITH n AS (SELECT o_custkey, o_orderkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - 1 AS i FROM orders)
SELECT o_custkey, (i // 8)::INT AS part, count(*) AS n, string_agg(o_orderkey::VARCHAR, ',' ORDER BY i) AS keys FROM n GROUP BY 1, 2""")
def a12(spark, sf):
    o = table(spark, sf, "orders")
    out = agg.collect_nested(o, "o_custkey", "Orders", ["o_orderkey", "o_totalprice"], ["o_orderdate", "o_orderkey"], chunk=8)
    return out.select("o_custkey", "part", F.size("Orders").cast("long").alias("n"), F.array_join(
        F.transform("Orders", lambda x: x["o_orderkey"].cast("string")), ",").alias("keys"))


@query("a13_first_valid", """
SELECT c_nationkey, arg_min(c_name, c_custkey) FILTER (c_acctbal > 3000) AS name,
       arg_min(c_mktsegment, c_custkey) AS segment, arg_min(c_acctbal, c_custkey) FILTER (c_acctbal > 20000) AS rich
FROM customer GROUP BY c_nationkey""")
def a13(spark, sf):
    c = table(spark, sf, "customer").select(
        "c_nationkey", "c_custkey", F.when(F.col("c_acctbal") > 3000, F.col("c_name")).alias("name"),
        F.col("c_mktsegment").alias("segment"), F.when(F.col("c_acctbal") > 20000, F.col("c_acctbal")).alias("rich"))
    return agg.first_valid(c, "c_nationkey", ["name", "segment", "rich"], ["c_custkey"])


@query("a14_qualifier_pivot", """
SELECT event_id, event_type, CASE WHEN event_id % 3 <> 0 THEN json_extract_string(props, '$.k') END AS k,
       CASE WHEN event_id % 2 = 0 THEN event_type END AS kind, NULL::VARCHAR AS never
FROM events""")
def a14(spark, sf):
    e = table(spark, sf, "events")
    k = F.get_json_object("props", "$.k")

    def q(name, value):
        return F.struct(F.lit(name).alias("name"), value.alias("value"))

    quals = e.select("event_id", F.posexplode(F.array_compact(F.array(
        F.when(F.col("event_id") % 3 != 0, q("k", k)), q("k", F.when(F.col("event_id") % 3 != 0, F.lit("late"))),
        F.when(F.col("event_id") % 2 == 0, q("kind", F.col("event_type"))), q("unknown", k)))).alias("qpos", "q"))
    quals = quals.select("event_id", "qpos", "q.*")
    return agg.pivot_qualifiers(e.select("event_id", "event_type"), quals, ["k", "kind", "never"], ["event_id"])


@query("a15_minutes_and_elo_factor", f"""
WITH m AS (SELECT c_custkey AS player, c_nationkey AS team, avg(o_totalprice / 90) AS f FROM orders JOIN customer ON o_custkey = c_custkey
           WHERE o_orderdate >= DATE '1997-08-01' GROUP BY 1, 2),
t AS (SELECT s_nationkey AS team, avg(s_acctbal) AS elo FROM supplier GROUP BY 1),
l AS (SELECT min(elo) AS lo, max(elo) AS hi FROM t)
SELECT player AS "Player", {r('f', 6)} AS "Per90Factor", {r('0.5 + (elo - lo) / (hi - lo) * 0.5', 6)} AS "EloFactor"
FROM m JOIN t USING (team), l""")
def a15(spark, sf):
    c, o, s = (table(spark, sf, t) for t in ("customer", "orders", "supplier"))
    rows = o.filter("o_orderdate >= date '1997-08-01'").select(
        F.col("o_custkey").alias("Player"), F.col("o_totalprice").alias("MinutesPlayed"))
    teams = s.groupBy(F.col("s_nationkey").alias("ID")).agg(F.avg("s_acctbal").alias("EloRating"))
    players = c.select(F.col("c_custkey").alias("ID"), F.col("c_nationkey").alias("Team"))
    out = agg.minutes_factor(rows).join(agg.elo_factor(players, teams), "Player")
    return rounded(out, 6, "Per90Factor", "EloFactor")


@query("m1_player_metrics", f"""
WITH {STATS}, d AS (SELECT *, tackles + inter + clear + blocks AS da FROM v_stats)
SELECT match AS "Match", shirt AS "ShirtNumber", player AS "Player", team AS "Team", {ratio('acc', 'passes')} AS "PassAccuracy", {ratio('passes', 'touches')} AS "PassesPerTouch",
  {ratio('touches', 'passes')} AS "TouchesPerPass", {ratio('goals', 'shots')} AS "GoalConversion", {ratio('xg', 'shots')} AS "ExpectedGoalsPerShot",
  {r('goals - xg', 6)} AS "GoalsMinusxG", da::DOUBLE AS "DefensiveActions", {ratio('tackles_won + inter + clear', 'da')} AS "DefensiveActionSuccess",
  {ratio('tackles_won', 'tackles')} AS "TackleAccuracy", {ratio('inter', 'da')} AS "InterceptionShare", {ratio('blocks', 'da')} AS "BlockShare",
  (shots - goals)::DOUBLE AS "ShotsMinusGoals", {r('da * ' + ratio('90', 'minutes'), 6)} AS "DefensiveActionsPer90",
  {r(ratio('acc', 'passes') + ' * ' + ratio('90', 'minutes'), 6)} AS "PassAccuracyPer90"
FROM d""")
def m1(spark, sf):
    out = agg.player_metrics(stats(spark, sf).drop("Date", "Brand", "Name"))
    cols = ["PassAccuracy", "PassesPerTouch", "TouchesPerPass", "GoalConversion", "ExpectedGoalsPerShot", "GoalsMinusxG",
            "DefensiveActions", "DefensiveActionSuccess", "TackleAccuracy", "InterceptionShare", "BlockShare",
            "ShotsMinusGoals", "DefensiveActionsPer90", "PassAccuracyPer90"]
    return rounded(out.select("Match", "ShirtNumber", "Player", "Team", *cols), 6, "GoalsMinusxG",
                   "DefensiveActionsPer90", "PassAccuracyPer90")


@query("m2_team_metrics", f"""
WITH {STATS}, t AS (SELECT match, team, max(minutes) AS minutes, sum(passes)::BIGINT AS passes, sum(acc)::BIGINT AS acc, sum(goals)::BIGINT AS goals,
   sum(shots)::BIGINT AS shots, sum(xg) AS xg, sum(touches)::BIGINT AS touches FROM v_stats GROUP BY 1, 2)
SELECT match AS "Match", team AS "Team", {ratio('acc', 'passes')} AS "PassAccuracy", {ratio('goals', 'shots')} AS "GoalConversion",
  {r('goals - xg', 6)} AS "GoalsMinusxG", {ratio('touches', 'passes')} AS "TouchesPerPass",
  {r('passes * (90.0::DOUBLE / nullif(minutes, 0))', 6)} AS "PassesPer90" FROM t""")
def m2(spark, sf):
    t = stats(spark, sf).groupBy("Match", "Team").agg(
        F.max("MinutesPlayed").alias("MinutesPlayed"),
        *[F.sum(c).alias(c) for c in ("Passes", "AccuratePasses", "Goals", "TotalShots", "ExpectedGoals", "Touches")])
    return rounded(agg.team_metrics(t).select("Match", "Team", "PassAccuracy", "GoalConversion", "GoalsMinusxG",
                                              "TouchesPerPass", "PassesPer90"), 6, "GoalsMinusxG", "PassesPer90")


@query("m3_window_aggregates", """
WITH o AS (SELECT o_custkey, o_totalprice, year(o_orderdate) AS y,
   row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders),
s AS (SELECT o.*, unnest(['all', CASE WHEN y = 1999 THEN 'season' END, CASE WHEN rn <= 10 THEN 'last10' END,
   CASE WHEN rn <= 5 THEN 'last5' END, CASE WHEN rn <= 3 THEN 'last3' END]) AS scope FROM o)
SELECT scope, o_custkey, round_even(sum(o_totalprice) * 100, 0) / 100 AS total, count(*) AS "Matches" FROM s WHERE scope IS NOT NULL GROUP BY 1, 2""")
def m3(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", F.col("o_totalprice").alias("total"), "o_orderdate", "o_orderkey",
                                          F.year("o_orderdate").cast("string").alias("Season"))
    out = agg.aggregate_windows(o, "o_custkey", [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()], season=1999,
                                drop=["o_orderdate", "o_orderkey", "Season"])
    return rounded(out, 2, "total").select("scope", "o_custkey", "total", "Matches")
