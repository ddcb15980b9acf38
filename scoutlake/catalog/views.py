"""Match-like views over the check tables, as Spark frames and as the same SQL text."""

from pyspark.sql import functions as F

_QUERIES, _SQL = {}, {}


def query(name, sql=None):
    """Register a query and, where SQL can say the same, its check."""
    def add(fn):
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = sql.strip()
        return fn
    return add


def table(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def feed(spark, sf):
    """Events as an action feed on a 0-100 pitch."""
    e = table(spark, sf, "events")
    eid = F.col("event_id")
    kind = (F.when(F.col("event_type") == "click", "Pass").when(F.col("event_type") == "view", "Goal")
            .when(F.col("event_type") == "error", "Miss").when(F.col("event_type") == "signup", "Post")
            .otherwise("Saved Shot"))
    zone = F.element_at(F.array(*[F.lit(z) for z in ("Back", "Center", "Left", "Right")]),
                        (eid % 4 + 1).cast("int"))
    k = F.get_json_object("props", "$.k").cast("int")
    return e.select(
        F.to_date("ts").alias("match"), "ts", "event_id", F.col("user_id").alias("player"),
        (F.col("user_id") % 10).alias("team"), kind.alias("Type"),
        (eid * 37 % 101).cast("double").alias("x"), (eid * 53 % 101).cast("double").alias("y"),
        (eid * 41 % 101).cast("double").alias("Pass End X"),
        (eid * 59 % 101).cast("double").alias("Pass End Y"), k.alias("k"),
        F.when(k % 3 == 0, 0).otherwise(1).alias("outcome"),
        zone.alias("Zone"), F.col("value").alias("Angle"),
        F.when(k % 5 != 0, (eid * 29 % 101).cast("double")).alias("Goal Mouth Y Coordinate"),
        F.when(k % 7 != 0, (eid * 31 % 41).cast("double")).alias("Goal Mouth Z Coordinate"),
        F.when(k % 4 == 0, (eid * 43 % 101).cast("double")).alias("Blocked X Coordinate"),
        F.when(k % 4 == 0, (eid * 47 % 101).cast("double")).alias("Blocked Y Coordinate"))


FEED = """
v_feed AS (
  SELECT *, CASE WHEN k % 3 = 0 THEN 0 ELSE 1 END AS outcome,
         CASE event_id % 4 WHEN 0 THEN 'Back' WHEN 1 THEN 'Center' WHEN 2 THEN 'Left' ELSE 'Right' END AS zone,
         CASE WHEN k % 5 <> 0 THEN (event_id * 29 % 101)::DOUBLE END AS goal_y,
         CASE WHEN k % 7 <> 0 THEN (event_id * 31 % 41)::DOUBLE END AS goal_z,
         CASE WHEN k % 4 = 0 THEN (event_id * 43 % 101)::DOUBLE END AS block_x,
         CASE WHEN k % 4 = 0 THEN (event_id * 47 % 101)::DOUBLE END AS block_y
  FROM (SELECT ts::DATE AS match, ts, event_id, user_id AS player, user_id % 10 AS team,
               CASE event_type WHEN 'click' THEN 'Pass' WHEN 'view' THEN 'Goal' WHEN 'error' THEN 'Miss'
                               WHEN 'signup' THEN 'Post' ELSE 'Saved Shot' END AS type,
               (event_id * 37 % 101)::DOUBLE AS x, (event_id * 53 % 101)::DOUBLE AS y,
               (event_id * 41 % 101)::DOUBLE AS end_x, (event_id * 59 % 101)::DOUBLE AS end_y,
               value AS angle, json_extract(props, '$.k')::INT AS k
        FROM events))"""


def matches(spark, sf):
    """Orders as matches between nations."""
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    price = F.floor("o_totalprice")
    home = F.col("c_nationkey")
    return o.join(c, o["o_custkey"] == c["c_custkey"]).select(
        F.col("o_orderkey").alias("ID"), home.cast("long").alias("HomeTeam"),
        ((home + 1 + F.col("o_orderkey") % 24) % 25).cast("long").alias("AwayTeam"),
        (price % 5).cast("long").alias("HomeScore"),
        (F.floor(F.col("o_totalprice") / 10) % 5).cast("long").alias("AwayScore"),
        F.col("o_orderdate").cast("date").alias("Date"), F.col("c_mktsegment").alias("League"),
        F.year("o_orderdate").cast("string").alias("Season"),
        (1000.0 + F.col("c_acctbal") / 10).alias("HomeElo"),
        (1500.0 - F.col("o_totalprice") / 1000).alias("AwayElo"))


MATCH = """
v_match AS (
  SELECT o_orderkey AS id, c_nationkey::BIGINT AS home, ((c_nationkey + 1 + o_orderkey % 24) % 25)::BIGINT AS away,
         (floor(o_totalprice)::BIGINT % 5) AS hs, (floor(o_totalprice / 10)::BIGINT % 5) AS as_,
         o_orderdate::DATE AS date, c_mktsegment AS league, year(o_orderdate)::VARCHAR AS season,
         1000.0 + c_acctbal / 10 AS home_elo, 1500.0 - o_totalprice / 1000 AS away_elo
  FROM orders JOIN customer ON o_custkey = c_custkey)"""

SIDES = MATCH + """,
v_sides AS (
  SELECT id, home AS team, away AS opp, hs AS score, as_ AS opp_score, home_elo AS elo, away_elo AS opp_elo,
         'Home' AS ha, date, league, season FROM v_match
  UNION ALL
  SELECT id, away, home, as_, hs, away_elo, home_elo, 'Away', date, league, season FROM v_match)"""


def stats(spark, sf):
    """Line items as player rows of a match, parts as players, suppliers as teams."""
    li, p = table(spark, sf, "lineitem"), table(spark, sf, "part")
    q, n = F.col("l_quantity").cast("long"), F.col("l_linenumber").cast("long")
    passes = F.floor("l_extendedprice") % 60
    return li.join(p, li["l_partkey"] == p["p_partkey"]).select(
        F.col("l_orderkey").alias("Match"), F.col("l_suppkey").alias("Team"),
        F.col("l_partkey").alias("Player"), F.col("l_linenumber").cast("int").alias("ShirtNumber"),
        F.col("p_type").alias("Position"), (q * 2).alias("MinutesPlayed"), passes.alias("Passes"),
        F.floor(passes * 0.75).alias("AccuratePasses"), (passes + n).alias("Touches"),
        (n % 4).alias("TotalShots"), F.when(n % 4 >= 2, 1).otherwise(0).cast("long").alias("Goals"),
        (F.col("l_discount") * 5).alias("ExpectedGoals"), (q % 7).alias("Tackles"),
        F.floor(q % 7 / 2).alias("TacklesWon"), (q % 5).alias("Interceptions"),
        F.rint(F.col("l_tax") * 100).cast("long").alias("Clearances"),
        (n % 3).alias("OutfielderBlocks"), F.to_date("l_shipdate").alias("Date"),
        F.col("p_brand").alias("Brand"), F.col("p_name").alias("Name"))


STATS = """
v_stats AS (
  SELECT l_orderkey AS match, l_suppkey AS team, l_partkey AS player, l_linenumber AS shirt, p_type AS position,
         (l_quantity::BIGINT * 2) AS minutes, floor(l_extendedprice)::BIGINT % 60 AS passes,
         floor(floor(l_extendedprice)::BIGINT % 60 * 0.75)::BIGINT AS acc,
         floor(l_extendedprice)::BIGINT % 60 + l_linenumber AS touches, (l_linenumber % 4)::BIGINT AS shots,
         CASE WHEN l_linenumber % 4 >= 2 THEN 1 ELSE 0 END::BIGINT AS goals, l_discount * 5 AS xg,
         l_quantity::BIGINT % 7 AS tackles, (l_quantity::BIGINT % 7) // 2 AS tackles_won,
         l_quantity::BIGINT % 5 AS inter, round_even(l_tax * 100, 0)::BIGINT AS clear,
         (l_linenumber % 3)::BIGINT AS blocks, l_shipdate::DATE AS date, p_brand AS brand, p_name AS name
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def r(expr, n):
    """SQL half-even rounding on the scaled value, as in the library."""
    return f"(round_even(({expr}) * 1e{n}, 0) / 1e{n})"


def ratio(a, b, n=4):
    """SQL null-safe ratio."""
    return r(f"(({a})::DOUBLE / nullif(({b})::DOUBLE, 0))", n)


def clip01(x, lo=0, hi=1):
    return f"least(greatest({x}, {float(lo)}::DOUBLE), {float(hi)}::DOUBLE)"
