"""Checks of the chart data."""

from pyspark.sql import functions as F

from ..operators import charts as ch, shape
from ..operators.similarity import top_similar
from ..operators.windows import next_actor, pct_rank
from ..session import materialize
from .aggregates import rounded
from .similarity import _PAIRS, _vectors
from .views import FEED, MATCH, SIDES, STATS, feed, matches, query, r, stats, table
from .windows import _pct


@query("v1_density_field", f"""
WITH {FEED}, pt AS (SELECT type AS key, x, 100 - y AS y FROM v_feed),
g AS (SELECT i, j FROM generate_series(0, 104) a(i), generate_series(0, 67) b(j)),
d AS (SELECT key, i, j, sum(exp(-(pow((i + 0.5) * (100.0::DOUBLE / 105) - x, 2) + pow((j + 0.5) * (100.0::DOUBLE / 68) - y, 2)) / 98.0::DOUBLE)) AS d FROM pt, g GROUP BY 1, 2, 3)
SELECT key, i::INT AS i, j::INT AS j, {r('pow(d / max(d) OVER (PARTITION BY key), 0.85)', 6)} AS f FROM d""")
def v1(spark, sf):
    pts = ch.field_points(feed(spark, sf).select("Type", F.col("x").alias("IniX"), F.col("y").alias("IniY")), "Type")
    return rounded(ch.kde_field(pts, 105, 68), 6, "f")


@query("v2_pass_network", f"""
WITH {FEED}, f AS (SELECT match, ts, event_id, type, outcome, player % 6 AS player, player % 2 AS team FROM v_feed),
n AS (SELECT *, lead(player) OVER (PARTITION BY match ORDER BY ts, event_id) AS nxt FROM f),
c AS (SELECT team, least(player, nxt) AS a, greatest(player, nxt) AS b, count(*) AS n FROM n
      WHERE type = 'Pass' AND outcome <> 0 AND nxt IS NOT NULL AND nxt % 2 = team GROUP BY 1, 2, 3),
m AS (SELECT *, greatest(max(n) OVER (PARTITION BY team), 5) AS mx FROM c)
SELECT team AS "Team", a, b, n, {r('(n - 5) / CASE WHEN mx > 5 THEN mx - 5 ELSE 1 END::DOUBLE', 6)} AS weight FROM m WHERE n >= 5""")
def v2(spark, sf):
    """Accurate passes between players of two squads, pairs with at least five."""
    ev = feed(spark, sf).withColumn("player", F.col("player") % 6).withColumn("team", F.col("player") % 2)
    passes = shape.pass_map(next_actor(ev).withColumn("Length", F.lit(0.0)))
    lineup = ev.select(F.col("team").alias("Team"), F.col("player").alias("Player"))
    return rounded(ch.pass_network(passes, lineup), 6, "weight")


@query("v3_trend_line", f"""
SELECT l_returnflag, count(*) AS n, {r('regr_intercept(l_extendedprice, l_quantity)', 2)} AS a, {r('regr_slope(l_extendedprice, l_quantity)', 4)} AS b
FROM lineitem GROUP BY 1""")
def v3(spark, sf):
    out = ch.trend(table(spark, sf, "lineitem"), "l_returnflag", "l_quantity", "l_extendedprice")
    return rounded(rounded(out, 2, "a"), 4, "b")


@query("v4_standouts", f"""
WITH t AS (SELECT p_type, p_partkey, p_size::DOUBLE AS x, p_retailprice AS y FROM part),
s AS (SELECT *, (x - min(x) OVER w) / nullif(max(x) OVER w - min(x) OVER w, 0) + (y - min(y) OVER w) / nullif(max(y) OVER w - min(y) OVER w, 0) AS score FROM t WINDOW w AS (PARTITION BY p_type)),
k AS (SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY round(score, 9) DESC, p_partkey) AS rank FROM s)
SELECT p_type, p_partkey, {r('score', 6)} AS score, rank::INT AS rank FROM k WHERE rank <= 8""")
def v4(spark, sf):
    p = table(spark, sf, "part").select("p_type", "p_partkey", F.col("p_size").cast("double").alias("x"), F.col("p_retailprice").alias("y"))
    return rounded(ch.standouts(p, "p_partkey", "x", "y", "p_type"), 6, "score").select("p_type", "p_partkey", "score", "rank")


@query("v5_match_series", f"""
WITH {SIDES}
SELECT team AS "Team", id AS "Match", row_number() OVER (PARTITION BY team ORDER BY date, id) - 1 AS num,
  CASE WHEN score > opp_score THEN 'Win' WHEN score < opp_score THEN 'Loss' ELSE 'Draw' END || ' (' ||
  CASE ha WHEN 'Home' THEN score ELSE opp_score END || ' - ' || CASE ha WHEN 'Home' THEN opp_score ELSE score END || ')' AS "Result",
  (score - opp_score) AS "ScoreDiff", {r('avg(score - opp_score) OVER (PARTITION BY team)', 9)} AS mean FROM v_sides""")
def v5(spark, sf):
    rows = shape.to_team_rows(matches(spark, sf), keep=("Date",))
    return rounded(ch.match_series(rows, "Team", "ScoreDiff"), 9, "mean").select(
        "Team", "Match", "num", "Result", "ScoreDiff", "mean")


@query("v6_similar_mean", _PAIRS + f""",
k AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY round(s, 6) DESC, b) AS num FROM p),
w AS (SELECT vec_id, label, {', '.join(f'v[{i + 1}] AS m{i}' for i in range(64))} FROM e),
pc AS (SELECT vec_id, {', '.join(f'''{_pct(f'm{i}', 'label')} AS m{i}''' for i in range(64))} FROM w),
lg AS (UNPIVOT pc ON {', '.join(f'm{i}' for i in range(64))} INTO NAME metric VALUE pct)
SELECT a AS id, metric, {r('avg(pct)', 9)} AS mean_pct FROM k JOIN lg ON lg.vec_id = b WHERE num <= 50 GROUP BY 1, 2""")
def v6(spark, sf):
    e = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), "label",
                                              *[F.col("embedding")[i].cast("double").alias(f"m{i}") for i in range(64)])
    long = pct_rank(e, "label", "id", [f"m{i}" for i in range(64)], wide=False).select("id", "metric", "pct")
    similar = materialize(top_similar(_vectors(spark, sf), 50), "similar")
    return rounded(ch.similar_mean(similar, long, [f"m{i}" for i in range(64)]), 9, "mean_pct")


@query("v7_shot_paths", f"""
WITH {FEED}
SELECT x AS "IniX", player AS "Player", match AS "Match", CASE WHEN block_x IS NOT NULL AND block_y IS NOT NULL THEN block_x WHEN goal_y IS NOT NULL THEN 100 END::DOUBLE AS "EndX",
  CASE WHEN block_x IS NOT NULL AND block_y IS NOT NULL THEN block_y WHEN goal_y IS NOT NULL THEN goal_y END AS "EndY",
  goal_y IS NOT NULL AND goal_z IS NOT NULL AS "OnTarget" FROM v_feed WHERE type <> 'Pass'""")
def v7(spark, sf):
    return ch.shot_paths(shape.shot_map(feed(spark, sf))).select("IniX", "Player", "Match", "EndX", "EndY", "OnTarget")


@query("v8_comparison_position", """
WITH p AS (SELECT p_partkey AS "ID", CASE WHEN p_size % 3 = 0 THEN 'AM' ELSE 'GK' END AS f, CASE WHEN p_size % 2 = 0 THEN 'ST' END AS s FROM part),
c AS (SELECT l_partkey AS pid, CASE l_returnflag WHEN 'A' THEN 'AM' WHEN 'N' THEN 'ST' ELSE 'CB' END AS pos FROM lineitem GROUP BY 1, 2),
k AS (SELECT "ID", pos, row_number() OVER (PARTITION BY "ID" ORDER BY CASE WHEN pos = f THEN 0 WHEN pos = s THEN 1 ELSE 2 END, pos) AS rn FROM p LEFT JOIN c ON c.pid = p."ID")
SELECT "ID", pos AS "ComparisonPosition" FROM k WHERE rn = 1""")
def v8(spark, sf):
    size = F.col("p_size")
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("ID"), F.when(size % 3 == 0, "AM").otherwise("GK").alias("FirstPos"),
                                        F.when(size % 2 == 0, "ST").alias("SecondPos"))
    flag = F.col("l_returnflag")
    c = table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("ID"), F.when(flag == "A", "AM").when(flag == "N", "ST").otherwise("CB").alias("Position"))
    return ch.comparison_position(p, c)
