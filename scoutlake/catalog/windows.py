"""Checks of ranking, ordering and period operators, and the flagship query."""

from pyspark.sql import functions as F

from ..functions.numeric import round_even
from ..operators import aggregate as agg, windows as win
from ..session import materialize
from .aggregates import rounded
from .views import FEED, MATCH, STATS, feed, matches, query, r, ratio, stats, table

_TOP = ["PassAccuracy", "TouchesPerPass", "GoalConversion", "ExpectedGoalsPerShot", "DefensiveActionSuccess",
        "TackleAccuracy", "PassesPer90", "TacklesPer90", "GoalsPer90", "InterceptionsPer90"]


def _pct(col, part, n=1):
    return r(f"CASE WHEN {col} IS NOT NULL THEN (rank() OVER (PARTITION BY {part}, {col} IS NULL ORDER BY {col}) + "
             f"(count(*) OVER (PARTITION BY {part}, {col}) - 1) / 2.0::DOUBLE) / count({col}) OVER (PARTITION BY {part}) * 100 END", n)


@query("flagship_last_five_percentiles", f"""
WITH {STATS}, {MATCH.strip()},
j AS (SELECT v_stats.*, v_match.date AS md, row_number() OVER (PARTITION BY player ORDER BY v_match.date DESC, match DESC, shirt DESC) AS rn
      FROM v_stats JOIN v_match ON match = id),
a AS (SELECT player, any_value(position) AS position, sum(minutes)::BIGINT AS minutes, sum(passes)::BIGINT AS passes, sum(acc)::BIGINT AS acc,
   sum(touches)::BIGINT AS touches, sum(shots)::BIGINT AS shots, sum(goals)::BIGINT AS goals, sum(xg) AS xg, sum(tackles)::BIGINT AS tackles,
   sum(tackles_won)::BIGINT AS tw, sum(inter)::BIGINT AS inter, sum(clear)::BIGINT AS clear, sum(blocks)::BIGINT AS blocks
   FROM j WHERE rn <= 5 GROUP BY player),
m AS (SELECT player, position, {ratio('acc', 'passes')} AS c0, {ratio('touches', 'passes')} AS c1, {ratio('goals', 'shots')} AS c2,
   {ratio('xg', 'shots')} AS c3, {ratio('tw + inter + clear', 'tackles + inter + clear + blocks')} AS c4, {ratio('tw', 'tackles')} AS c5,
   passes * {ratio('90', 'minutes')} AS c6, tackles * {ratio('90', 'minutes')} AS c7, goals * {ratio('90', 'minutes')} AS c8,
   inter * {ratio('90', 'minutes')} AS c9 FROM a)
SELECT position AS "Position", player AS "Player", {', '.join(f'{_pct(f"c{i}", "position")} AS "{c}"' for i, c in enumerate(_TOP))}
FROM m""")
def flagship(spark, sf):
    """Last five matches per player, metrics per 90 minutes, percentile within position.

    Rows of a player with the same match and number are told apart by their statistics, so a rerun takes the same five.
    """
    dates = matches(spark, sf).select(F.col("ID").alias("Match"), F.col("Date").alias("MatchDate"))
    s = stats(spark, sf).drop("Date", "Brand", "Name", "Team").join(dates, "Match")
    order = ["MatchDate", "Match", "ShirtNumber"]
    order += [c for c in s.columns if c not in ("Player", *order)]  # a player's equal rows of a match: the larger values first
    last = win.last_n(s, "Player", [F.col(c).desc() for c in order], 5)
    last = last.drop("rn", "MatchDate", "Match", "ShirtNumber")
    metrics = agg.player_metrics(agg.aggregate_entity(last, "Player", {"Position": "mode"}))
    # Read three times by the ranking: written once instead of joined and aggregated again.
    metrics = materialize(metrics.select("Position", "Player", *_TOP), "metrics")
    return win.pct_rank(metrics, "Position", "Player", _TOP)


@query("w1_next_actor", f"""
WITH {FEED} SELECT event_id, lead(player) OVER (PARTITION BY match ORDER BY ts, event_id) AS next_player FROM v_feed""")
def w1(spark, sf):
    return win.next_actor(feed(spark, sf).select("match", "player", "ts", "event_id")).select("event_id", "next_player")


@query("w2_last_n", """
SELECT o_custkey, o_orderkey, rn::INT AS rn FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
WHERE rn <= 5""")
def w2(spark, sf):
    return win.last_n(table(spark, sf, "orders"), "o_custkey",
                      [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()], 5).select("o_custkey", "o_orderkey", "rn")


@query("w3_latest_value", """
SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""")
def w3(spark, sf):
    return win.latest(table(spark, sf, "orders"), "o_custkey", ["o_orderdate", "o_orderkey"],
                      ["o_orderkey", "o_orderstatus", "o_totalprice"])


@query("w4_percentile_rank", f"""
WITH t AS (SELECT p_partkey, p_brand, floor(p_retailprice / 10) AS price, CASE WHEN p_size % 9 <> 0 THEN -p_size END::DOUBLE AS size FROM part)
SELECT p_brand, p_partkey, {_pct('price', 'p_brand')} AS price, {_pct('size', 'p_brand')} AS size FROM t""")
def w4(spark, sf):
    p = table(spark, sf, "part").select(
        "p_brand", "p_partkey", F.floor(F.col("p_retailprice") / 10).alias("price"),
        F.when(F.col("p_size") % 9 != 0, F.col("p_size")).alias("size"))
    return win.pct_rank(p, "p_brand", "p_partkey", ["price", "size"], negative=["size"])


@query("w4_percentile_rank_global", f"""
WITH t AS (SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice AS price, 1 AS one FROM lineitem)
SELECT one, l_orderkey, l_linenumber, l_partkey, {_pct('price', 'one', 4)} AS price FROM t""")
def w4_global(spark, sf):
    """One group over the whole table: slices keep any task small."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey",
                                             F.col("l_extendedprice").alias("price"), F.lit(1).alias("one"))
    out = win.pct_rank(li, "one", ["l_orderkey", "l_linenumber", "l_partkey"], ["price"], decimals=4, wide=False)
    return out.select("one", "l_orderkey", "l_linenumber", "l_partkey", F.col("pct").alias("price"))


@query("w5_group_mean_impute", f"""
WITH t AS (SELECT l_orderkey, l_linenumber, l_returnflag, CASE WHEN l_linenumber <> 2 THEN l_tax END AS tax FROM lineitem)
SELECT l_orderkey, l_linenumber, {r('coalesce(tax, avg(tax) OVER (PARTITION BY l_returnflag))', 6)} AS tax FROM t""")
def w5(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", F.when(
        F.col("l_linenumber") != 2, F.col("l_tax")).alias("tax"))
    return rounded(win.impute_group_mean(li, "l_returnflag", ["tax"]), 6, "tax").drop("l_returnflag")


@query("w6_top_positions", f"""
WITH {STATS}, c AS (SELECT team, brand, count(*) AS n FROM v_stats GROUP BY 1, 2),
k AS (SELECT *, row_number() OVER (PARTITION BY team ORDER BY n DESC, brand) AS rn FROM c)
SELECT team AS "Team", max(brand) FILTER (rn = 1) AS "FirstPos", max(brand) FILTER (rn = 2) AS "SecondPos", max(brand) FILTER (rn = 3) AS "ThirdPos"
FROM k WHERE rn <= 3 GROUP BY team""")
def w6(spark, sf):
    return win.top_positions(stats(spark, sf), "Team", "Brand")


@query("w7_running_index", """
SELECT l_orderkey, l_partkey, l_linenumber, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey) - 1 AS idx
FROM lineitem""")
def w7(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_suppkey", "l_shipdate")
    return win.running_index(li, ["l_suppkey"], ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey"]).drop("l_suppkey", "l_shipdate")


_WEEKS = """
b AS (SELECT user_id AS player, event_id, value, (ts::DATE - ((date_diff('day', DATE '2023-07-04', ts::DATE) % {d} + {d}) % {d})::INT) AS period FROM events),
g AS (SELECT player, period, count(DISTINCT event_id) AS n, avg(value) AS m FROM b GROUP BY 1, 2)"""


def _events(spark, sf):
    return table(spark, sf, "events").select(F.col("user_id").alias("Player"), F.col("ts").cast("date").alias("Date"),
                                             F.col("event_id").alias("Match"), F.col("value").alias("AdjustedRating"))


@query("w8_fill_periods", f"""
WITH {_WEEKS.format(d=2)},
s AS (SELECT player, unnest(generate_series(min(period), max(period), INTERVAL 2 DAY))::DATE AS period FROM g GROUP BY player)
SELECT player AS "Player", period AS "Period", coalesce(n, 0) AS "PlayedMatches",
  {r('last_value(m IGNORE NULLS) OVER (PARTITION BY player ORDER BY period ROWS UNBOUNDED PRECEDING)', 9)} AS "MeanRating"
FROM s LEFT JOIN g USING (player, period)""")
def w8(spark, sf):
    b = win.bucket_ratings(_events(spark, sf), days=2, anchor="2023-07-04", min_matches=0)
    return rounded(win.fill_periods(b, days=2), 9, "MeanRating")


@query("w9_period_buckets", f"""
WITH {_WEEKS.format(d=14)}
SELECT player AS "Player", period AS "Period", n AS "PlayedMatches", {r('m', 9)} AS "MeanRating" FROM g
WHERE player IN (SELECT user_id FROM events GROUP BY 1 HAVING count(DISTINCT event_id) >= 10)""")
def w9(spark, sf):
    return rounded(win.bucket_ratings(_events(spark, sf), anchor="2023-07-04"), 9, "MeanRating")


@query("w10_top_k", """
SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 100""")
def w10(spark, sf):
    return win.top_k(table(spark, sf, "customer").select("c_custkey", "c_acctbal"),
                     [F.col("c_acctbal").desc(), "c_custkey"], 100)


_SLOTS = [("ECONOMY", 1), ("LARGE", 2), ("SMALL", 3)]


@query("w11_lineup_pick", f"""
WITH {STATS}, q AS (SELECT team, player, any_value(position) AS position, sum(minutes) AS m FROM v_stats GROUP BY 1, 2),
k AS (SELECT *, row_number() OVER (PARTITION BY team, position ORDER BY m DESC, player) AS rn FROM q),
s(position, slot, n) AS (VALUES ('ECONOMY', 0, 1), ('LARGE', 1, 2), ('SMALL', 2, 3))
SELECT team AS "Team", slot, position AS "Position", player AS "Player" FROM k JOIN s USING (position) WHERE rn <= n""")
def w11(spark, sf):
    squad = stats(spark, sf).groupBy("Team", "Player", "Position").agg(F.sum("MinutesPlayed").alias("Score"))
    squad = squad.withColumn("Name", F.concat(F.lit("P"), F.col("Player").cast("string")))
    teams = squad.select("Team").distinct()
    slots = teams.select("Team", F.posexplode(F.array(*[F.struct(F.lit(p).alias("p"), F.lit(n).alias("n"))
                                                        for p, n in _SLOTS])).alias("slot", "s"))
    slots = slots.select("Team", "slot", F.col("s.p").alias("Position"), F.col("s.n").alias("n"))
    return win.pick_lineup(squad, slots).select("Team", "slot", "Position", "Player")


@query("w12_dedupe_best", """
WITH k AS (SELECT c_custkey, c_mktsegment, c_nationkey, row_number() OVER (PARTITION BY c_mktsegment, c_nationkey
   ORDER BY c_acctbal > 5000 DESC, c_acctbal > 0 DESC, c_custkey) AS rn FROM customer),
w AS (SELECT c_mktsegment, c_nationkey, c_custkey AS main FROM k WHERE rn = 1)
SELECT c_custkey AS id, main FROM k JOIN w USING (c_mktsegment, c_nationkey)""")
def w12(spark, sf):
    c = table(spark, sf, "customer")
    prio = [-(F.col("c_acctbal") > 5000).cast("int"), -(F.col("c_acctbal") > 0).cast("int")]
    _, ids = win.dedupe_best(c, ["c_mktsegment", "c_nationkey"], "c_custkey", prio, ["c_custkey"])
    return ids


@query("w13_team_lineups", f"""
WITH {STATS}, {MATCH.strip()}, i AS (SELECT *, CASE WHEN shirt <> 1 THEN touches END AS tx FROM v_stats),
f AS (SELECT *, coalesce(tx, avg(tx) OVER (PARTITION BY position)) AS px FROM i),
s AS (SELECT f.* FROM f JOIN v_match ON id = match WHERE season = '1998'),
q AS (SELECT team, player, any_value(position) AS position, sum(minutes) AS m, avg(px) AS px FROM s GROUP BY 1, 2),
k AS (SELECT *, row_number() OVER (PARTITION BY team, position ORDER BY m DESC, player) AS rn FROM q),
fm AS (SELECT team, CASE WHEN shirt % 2 = 0 THEN 'A' ELSE 'B' END AS form, count(*) AS n FROM s GROUP BY 1, 2),
ff AS (SELECT team, arg_min(form, form) FILTER (n = mx) AS form FROM (SELECT *, max(n) OVER (PARTITION BY team) AS mx FROM fm) GROUP BY team),
sl(form, slot, position, n) AS (VALUES ('A', 0, 'ECONOMY', 1), ('A', 1, 'LARGE', 2), ('B', 0, 'SMALL', 2), ('B', 1, 'PROMO', 1))
SELECT team AS "Team", form AS "Formation", slot, (rn - 1)::INT AS idx, position AS "Position", player AS "Player",
       (slot * 10 + rn - 1)::DOUBLE AS "X", {r('px', 6)} AS "PassMeanX"
FROM k JOIN ff USING (team) JOIN sl USING (form, position) WHERE rn <= sl.n""")
def w13(spark, sf):
    s = stats(spark, sf).withColumns({
        "PassMeanX": F.when(F.col("ShirtNumber") != 1, F.col("Touches").cast("double")),
        "PassMeanY": F.lit(1.0)})
    names = s.select(F.col("Player").alias("ID"), F.concat(F.lit("P"), F.col("Player").cast("string")).alias("Name")).distinct()
    forms = s.select("Match", "Team", F.when(F.col("ShirtNumber") % 2 == 0, "A").otherwise("B").alias("Formation"))
    slots = spark.createDataFrame([("A", 0, "ECONOMY", 1), ("A", 1, "LARGE", 2), ("B", 0, "SMALL", 2), ("B", 1, "PROMO", 1)],
                                  "formation string, slot int, position string, n int")
    coords = spark.createDataFrame([(f, p, i, float(k * 10 + i), 0.0) for f, k, p, n in (
        ("A", 0, "ECONOMY", 1), ("A", 1, "LARGE", 2), ("B", 0, "SMALL", 2), ("B", 1, "PROMO", 1)) for i in range(n)],
        "formation string, position string, idx int, x double, y double")
    out = win.team_lineups(matches(spark, sf), names, s, forms, slots, coords, "1998")
    return rounded(out, 6, "PassMeanX").select("Team", "Formation", "slot", F.col("idx").cast("int").alias("idx"),
                                               "Position", "Player", "X", "PassMeanX")
