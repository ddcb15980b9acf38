"""Checks of ratings and roles."""

from pyspark.sql import functions as F

from ..config.weights import position_weights
from ..operators import aggregate as agg, rating as rat, roles, shape, windows as win
from .aggregates import rounded
from .views import MATCH, SIDES, STATS, clip01, matches, query, r, ratio, stats, table

_K = {"AUTOMOBILE": 50, "BUILDING": 40, "FURNITURE": 30}


def _elo(spark, sf):
    teams = table(spark, sf, "nation").select(F.col("n_nationkey").cast("long").alias("ID"),
                                              (F.lit(900.0) + F.col("n_regionkey") * 100).alias("EloRating"))
    m = matches(spark, sf).drop("HomeElo", "AwayElo")
    return rat.elo(m, teams, weight=rat.competition_weight("League", _K), window_rows=50_000)


def _gained(us, them, own, other, home=""):
    """SQL of a side's new rating after a match."""
    d = f"({us} - {them})"
    return (f"v + k * (CASE WHEN {d} <= 1 THEN 1 WHEN {d} = 2 THEN 1.5 WHEN {d} = 3 THEN 1.75 ELSE 1.75 + ({d} - 3) / 8 END) * "
            f"(CASE WHEN {d} > 0 THEN 1 WHEN {d} = 0 THEN 0.5 ELSE 0 END - 1 / (1 + pow(10, -(f.r[{own} + 1] - f.r[{other} + 1]{home}) / 400)))")


@query("r1_elo_matches", f"""
WITH RECURSIVE {MATCH.strip()}, o AS (
  SELECT row_number() OVER (ORDER BY date, id) AS i, id, home, away, hs, as_,
         CASE league WHEN 'AUTOMOBILE' THEN 50 WHEN 'BUILDING' THEN 40 WHEN 'FURNITURE' THEN 30 ELSE 20 END::DOUBLE AS k FROM v_match),
f(i, r) AS (SELECT 0::BIGINT, list(900.0::DOUBLE + n_regionkey * 100 ORDER BY n_nationkey) FROM nation UNION ALL
  SELECT o.i, list_transform(f.r, lambda v, j: CASE WHEN j = home + 1 THEN {_gained("hs", "as_", "home", "away", " + 100")}
    WHEN j = away + 1 THEN {_gained("as_", "hs", "away", "home")} ELSE v END) FROM f JOIN o ON o.i = f.i + 1)
SELECT id AS "ID", {r('f.r[home + 1]', 6)} AS "HomeElo", {r('f.r[away + 1]', 6)} AS "AwayElo" FROM f JOIN o USING (i)""")
def r1(spark, sf):
    """Post-match ratings of every match."""
    return rounded(_elo(spark, sf)[0].select("ID", "HomeElo", "AwayElo"), 6, "HomeElo", "AwayElo")


@query("r1_elo_final", f"""
WITH {MATCH}, o AS (
  SELECT row_number() OVER (ORDER BY date, id) AS i, home, away, hs, as_,
         CASE league WHEN 'AUTOMOBILE' THEN 50 WHEN 'BUILDING' THEN 40 WHEN 'FURNITURE' THEN 30 ELSE 20 END::DOUBLE AS k FROM v_match),
x AS (SELECT list([home::DOUBLE, away, hs, as_, k] ORDER BY i) AS l FROM o),
s AS (SELECT list(900.0::DOUBLE + n_regionkey * 100 ORDER BY n_nationkey) AS r0 FROM nation),
f AS (SELECT list_reduce(l, lambda a, m: list_transform(a, lambda v, j:
   CASE WHEN j = m[1] + 1 THEN v + m[5] * (CASE WHEN m[3] - m[4] <= 1 THEN 1 WHEN m[3] - m[4] = 2 THEN 1.5 WHEN m[3] - m[4] = 3 THEN 1.75 ELSE 1.75 + (m[3] - m[4] - 3) / 8 END)
       * (CASE WHEN m[3] > m[4] THEN 1 WHEN m[3] = m[4] THEN 0.5 ELSE 0 END - 1 / (1 + pow(10, -(a[(m[1] + 1)::INT] - a[(m[2] + 1)::INT] + 100) / 400)))
   WHEN j = m[2] + 1 THEN v + m[5] * (CASE WHEN m[4] - m[3] <= 1 THEN 1 WHEN m[4] - m[3] = 2 THEN 1.5 WHEN m[4] - m[3] = 3 THEN 1.75 ELSE 1.75 + (m[4] - m[3] - 3) / 8 END)
       * (CASE WHEN m[4] > m[3] THEN 1 WHEN m[3] = m[4] THEN 0.5 ELSE 0 END - 1 / (1 + pow(10, -(a[(m[2] + 1)::INT] - a[(m[1] + 1)::INT]) / 400)))
   ELSE v END), r0) AS e FROM x, s)
SELECT (unnest(generate_series(1, len(e))) - 1)::BIGINT AS "ID", {r('unnest(e)', 4)} AS "EloRating" FROM f""")
def r1_final(spark, sf):
    return rounded(_elo(spark, sf)[1], 4, "EloRating")


_W = {"SMALL": "FB", "LARGE": "CB", "PROMO": "AM"}


def _terms(pos, cols):
    """SQL of a position's weighted terms over the columns the view has."""
    out = ["6.0::DOUBLE"]
    for w, metric, lo, hi in position_weights()[pos]:
        if metric in cols:
            x = f"coalesce({cols[metric]}, 0)::DOUBLE"
            out.append(f"({w}::DOUBLE) * " + (x if lo is None else f"least(greatest(({x} - ({lo}::DOUBLE)) / ({hi - lo}::DOUBLE), 0), 1)"))
    return "least(greatest(" + " + ".join(out) + ", 0), 10)"


_COLS = {"PassAccuracy": ratio("acc", "passes"), "TackleAccuracy": ratio("tackles_won", "tackles"), "Interceptions": "inter",
         "Goals": "goals", "Clearances": "clear", "OutfielderBlocks": "blocks", "ExpectedGoals": "xg", "Touches": "touches"}
_R2 = f"""
WITH {STATS}, {SIDES.strip()}, j AS (
  SELECT v_stats.*, score - opp_score AS diff, elo, opp_elo, v_sides.date AS md, v_sides.league AS lg FROM v_stats JOIN v_sides ON id = match AND v_sides.team = v_stats.team % 25),
q AS (SELECT *, CASE position WHEN 'SMALL' THEN {_terms('FB', _COLS)} WHEN 'LARGE' THEN {_terms('CB', _COLS)} WHEN 'PROMO' THEN {_terms('AM', _COLS)} END AS base FROM j),
rt AS (SELECT *, least(greatest(base * (1 + 0.05::DOUBLE * ((opp_elo - elo) / 400)) * least(greatest(minutes / 60, 0.5), 1) * (1 + 0.1::DOUBLE * diff), 0), 10) AS rating
       FROM q WHERE base IS NOT NULL)"""


def _rated(spark, sf):
    rows = shape.to_team_rows(matches(spark, sf), home_elo="HomeElo", away_elo="AwayElo", keep=("League", "Date"))
    rows = rows.select("Match", F.col("Team").alias("side"), "League", F.col("Date").alias("MatchDate"), "Elo",
                       "OpponentElo", "ScoreDiff")
    s = stats(spark, sf).drop("Date", "Brand", "Name").withColumn("side", F.col("Team") % 25)
    s = agg.with_metrics(s, agg.PLAYER_METRICS).join(rows, ["Match", "side"])
    return rat.match_rating(s, groups=_W)


@query("r2_match_rating", _R2 + f"""
SELECT match AS "Match", shirt AS "ShirtNumber", player AS "Player", {r('rating', 6)} AS "Rating" FROM rt""")
def r2(spark, sf):
    return rounded(_rated(spark, sf), 6, "Rating").select("Match", "ShirtNumber", "Player", "Rating")


_R3 = _R2 + f""",
ad AS (SELECT *, least(greatest(rating * least(greatest(0.85::DOUBLE
  + 0.1::DOUBLE * {clip01("(CASE lg WHEN 'AUTOMOBILE' THEN 50 WHEN 'BUILDING' THEN 40 WHEN 'FURNITURE' THEN 30 ELSE 20 END - 20) / 30.0::DOUBLE")}
  + 0.1::DOUBLE * {clip01('(elo - 500) / 2000')}, 0.85), 1.05), 0), 10) AS adj FROM rt)"""


def _adjusted(spark, sf):
    rows = shape.to_team_rows(matches(spark, sf), home_elo="HomeElo", away_elo="AwayElo", keep=("League", "Date"))
    rows = rows.withColumn("Weight", rat.competition_weight("League", _K).cast("double"))
    df = _rated(spark, sf).select("Match", F.col("side").alias("Team"), "Player", "ShirtNumber", "Rating", "MinutesPlayed")
    return rat.adjust_rating(df, rows)


@query("r3_context_rating", _R3 + f"""
SELECT match AS "Match", shirt AS "ShirtNumber", player AS "Player", {r('adj', 6)} AS "AdjustedRating" FROM ad""")
def r3(spark, sf):
    return rounded(_adjusted(spark, sf), 6, "AdjustedRating").select("Match", "ShirtNumber", "Player", "AdjustedRating")


_R4 = f"""
WITH p AS (SELECT o_custkey AS player, (o_orderdate::DATE - (date_diff('day', DATE '1994-07-05', o_orderdate::DATE) % 14)::INT) AS period,
   count(DISTINCT o_orderkey) AS n, avg(o_totalprice / 60000) AS m FROM orders GROUP BY 1, 2),
b AS (SELECT player, avg(m) AS mean, sum(n) AS n FROM p GROUP BY 1), g AS (SELECT avg(m) AS g FROM p),
f AS (SELECT c_custkey AS player, abs(c_acctbal) / 10000 AS f1, c_nationkey / 25.0::DOUBLE AS f2, (c_custkey % 11) / 10.0::DOUBLE AS f3 FROM customer),
v AS (SELECT b.player, f1, f2, f3, n, round_even(65 + (0.65::DOUBLE * ((n * mean + 8 * g) / (n + 8)) / 10 + 0.15::DOUBLE * f1 + 0.1::DOUBLE * f2 + 0.1::DOUBLE * f3) * 30, 0) AS rating
  FROM b JOIN f USING (player), g)"""


def _value(spark, sf):
    o = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("Player"), F.col("o_orderkey").alias("Match"), F.col("o_orderdate").cast("date").alias("Date"),
        (F.col("o_totalprice") / 60000).alias("AdjustedRating"))
    periods = win.bucket_ratings(o, anchor="1994-07-05", min_matches=0)
    c = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("Player"), (F.abs("c_acctbal") / 10000).alias("Per90Factor"),
        (F.col("c_nationkey") / 25.0).alias("EloFactor"), (F.col("c_custkey") % 11 / 10.0).alias("MatchImpFactor"))
    return rat.player_value(periods, c), o


@query("r4_player_value", _R4 + """
SELECT player AS "Player", rating AS "Rating" FROM v""")
def r4(spark, sf):
    return _value(spark, sf)[0].select("Player", "Rating")


@query("r5_player_potential", _R4 + f""",
a AS (SELECT *, date_diff('day', DATE '1985-01-01' + (player % 9000)::INT, DATE '2015-01-01') / 365.25::DOUBLE AS age FROM v),
c AS (SELECT *, CASE WHEN age <= 18 THEN 1.0 WHEN age <= 20 THEN 0.9 WHEN age <= 22 THEN 0.8 WHEN age <= 24 THEN 0.65
   WHEN age <= 26 THEN 0.45 WHEN age <= 29 THEN 0.25 WHEN age <= 31 THEN 0.1 ELSE 0.0 END::DOUBLE AS pot FROM a)
SELECT player AS "Player", round_even(65 + (0.45::DOUBLE * {clip01('(rating - 65) / 30')} + 0.25::DOUBLE * pot + 0.1::DOUBLE * f1 + 0.1::DOUBLE * f2
  + 0.05::DOUBLE * f3 + 0.05::DOUBLE * {clip01('n / 20.0::DOUBLE')}) * 34, 0) AS "Potential" FROM c""")
def r5(spark, sf):
    value, o = _value(spark, sf)
    births = table(spark, sf, "customer").select(F.col("c_custkey").alias("Player"), F.date_add(
        F.lit("1985-01-01").cast("date"), (F.col("c_custkey") % 9000).cast("int")).alias("DateBirth"))
    played = o.groupBy("Player").agg(F.countDistinct("Match").alias("PlayedMatches"))
    return rat.player_potential(value, births, played, "2015-01-01").select("Player", "Potential")


@query("r6_rating_write_back", _R2 + f""",
o AS (SELECT player, match, max(rating) AS rating FROM rt GROUP BY 1, 2)
SELECT s.match AS "Match", s.shirt AS "ShirtNumber", s.player AS "Player", {r('o.rating', 6)} AS "Rating" FROM v_stats s LEFT JOIN o ON o.player = s.player AND o.match = s.match""")
def r6(spark, sf):
    s = stats(spark, sf)
    players = table(spark, sf, "part").select(F.col("p_partkey").alias("ID"))
    empty = spark.createDataFrame([], "Player bigint, Rating double, Potential double")
    out, _ = rat.apply_ratings(s, _rated(spark, sf), players, empty.drop("Potential"), empty.drop("Rating"))
    return rounded(out, 6, "Rating").select("Match", "ShirtNumber", "Player", "Rating")


@query("c1_pca_scores")
def c1(spark, sf):
    df, _, _ = roles.pca_scores(table(spark, sf, "embeddings"), ["embedding"], 5)
    return df.select("vec_id", "label", *[F.abs(F.col("scores")[i]).alias(f"pc{i + 1}") for i in range(5)])


@query("c2_kmeans_roles")
def c2(spark, sf):
    df, _, _ = roles.kmeans_select(table(spark, sf, "embeddings"), ["embedding"], 3, 6, starts=20)
    return df.select("vec_id", "label", "Cluster")


@query("c1_pca_by_position", f"""
WITH p AS (SELECT vec_id, label, embedding[1]::DOUBLE AS a, embedding[2]::DOUBLE + CASE WHEN label % 2 = 0 THEN 0.8 ELSE -0.8 END * embedding[1]::DOUBLE AS b FROM embeddings),
m AS (SELECT label, avg(a) AS ma, avg(b) AS mb, stddev_pop(a) AS sa, stddev_pop(b) AS sb, covar_pop(a, b) / (stddev_pop(a) * stddev_pop(b)) AS rho FROM p GROUP BY 1),
z AS (SELECT vec_id, label, (a - ma) / sa AS x, (b - mb) / sb AS y, rho FROM p JOIN m USING (label))
SELECT vec_id, label, {r('abs(x + sign(rho) * y) / sqrt(2)', 6)} AS pc1, {r('abs(x - sign(rho) * y) / sqrt(2)', 6)} AS pc2, {r('(1 + abs(rho)) / 2', 6)} AS share
FROM z""")
def c1_by_position(spark, sf):
    """Components of two columns for every group at once; in closed form they are the sum and the difference."""
    a, b = (F.col("embedding")[i].cast("double") for i in range(2))
    v = F.array(a, b + F.when(F.col("label") % 2 == 0, 0.8).otherwise(-0.8) * a)
    rows = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("label").alias("grp"), v.alias("v"))
    scores, axes = roles.pca_by_group(rows, 2)
    out = scores.join(axes, "grp").select(F.col("id").alias("vec_id"), F.col("grp").alias("label"), F.abs(F.col("scores")[0]).alias("pc1"),
                                          F.abs(F.col("scores")[1]).alias("pc2"), F.col("explained")[0].alias("share"))
    return rounded(out, 6, "pc1", "pc2", "share")


@query("c2_roles_by_position", """
SELECT vec_id, label, min(vec_id) OVER (PARTITION BY label, vec_id % (3 + label % 4)) AS first, (3 + label % 4)::BIGINT AS clusters FROM embeddings""")
def c2_by_position(spark, sf):
    """Clusters of every group at once, on groups of three to six far-apart clouds; a cluster is known by its smallest id."""
    cloud = F.col("vec_id") % (3 + F.col("label") % 4)
    v = F.array(*[F.col("embedding")[i].cast("double") + 40 * F.when(cloud == i, 1.0).otherwise(0.0) for i in range(6)])
    rows = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("label").alias("grp"), v.alias("v"))
    found, _ = roles.kmeans_by_group(rows)
    own = found.groupBy("grp", "Cluster").agg(F.min("id").alias("first"))
    many = own.groupBy("grp").agg(F.count("*").alias("clusters"))
    return found.join(own, ["grp", "Cluster"]).join(many, "grp").select(F.col("id").alias("vec_id"), F.col("grp").alias("label"), "first", "clusters")


_DIMS = 64


def _points(spark, sf):
    e = table(spark, sf, "embeddings")
    return e.select(F.col("vec_id").alias("Player"), (F.col("label") % 3).alias("Position"),
                    F.concat(F.lit("r"), F.col("label").cast("string")).alias("Role"),
                    *[F.col("embedding")[i].cast("double").alias(f"m{i}") for i in range(_DIMS)])


_C3 = f"""
WITH p AS (SELECT vec_id, label % 3 AS pos, 'r' || label AS role, {', '.join(f'embedding[{i + 1}]::DOUBLE AS m{i}' for i in range(_DIMS))} FROM embeddings),
c AS (SELECT pos, role, {', '.join(f'{r(f"avg(m{i})", 6)} AS c{i}' for i in range(_DIMS))} FROM p GROUP BY 1, 2)"""


@query("c3_role_centroids", _C3 + f"""
SELECT pos AS "Position", role AS "Role", {', '.join(f'c{i}' for i in range(_DIMS))} FROM c""")
def c3(spark, sf):
    cols = [f"m{i}" for i in range(_DIMS)]
    out = roles.role_centroids(_points(spark, sf), cols)
    return out.select("Position", "Role", *[F.col("center")[i].alias(f"c{i}") for i in range(_DIMS)])


@query("c4_nearest_role", _C3 + f""",
d AS (SELECT vec_id, p.pos, c.role, sqrt({' + '.join(f'(m{i} - c{i}) * (m{i} - c{i})' for i in range(_DIMS))}) AS d FROM p JOIN c ON p.pos = c.pos),
b AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, role) AS rn FROM d)
SELECT vec_id AS "Player", role AS "Role", {r('d', 6)} AS "Distance" FROM b WHERE rn = 1""")
def c4(spark, sf):
    cols = [f"m{i}" for i in range(_DIMS)]
    p = _points(spark, sf)
    out = roles.assign_role(p.drop("Role"), roles.role_centroids(p, cols), cols)
    return rounded(out, 6, "Distance").select("Player", "Role", "Distance")
