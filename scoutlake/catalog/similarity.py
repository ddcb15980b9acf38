"""Checks of similarity and fit operators."""

from pyspark.sql import functions as F

from ..config.weights import FIT_WEIGHTS
from ..functions.numeric import round_even
from ..operators import aggregate as agg, shape, similarity as sim
from ..operators.windows import pct_rank, top_k
from ..session import materialize
from .aggregates import rounded
from .views import FEED, MATCH, SIDES, STATS, clip01, feed, matches, query, r, ratio, stats, table
from .windows import _pct

_DIMS = 64
_E = """
WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),"""
_Z = _E + """
x AS (SELECT vec_id, label, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM e),
m AS (SELECT label, d, avg(x) AS mu, stddev_pop(x) AS sd FROM x GROUP BY 1, 2),
z AS (SELECT vec_id, x.label, list((x - mu) / sd ORDER BY x.d) AS z FROM x JOIN m ON m.label = x.label AND m.d = x.d GROUP BY 1, 2),
u AS (SELECT vec_id, label, list_transform(z, lambda t: t / sqrt(list_dot_product(z, z))) AS u FROM z),"""
_PAIRS = _Z + """
p AS (SELECT a.label, a.vec_id AS a, b.vec_id AS b, (list_dot_product(a.u, b.u) + 1) / 2 * 100 AS s FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id)"""


def _vectors(spark, sf):
    return sim.feature_vectors(table(spark, sf, "embeddings"), "vec_id", "label", ["embedding"])


def _frame(spark, sf):
    p = table(spark, sf, "part")
    pos = F.element_at(F.array(*[F.lit(x) for x in ("GK", "CB", "LB", "DM", "AM", "ST", "RW")]),
                       (F.col("p_partkey") % 7 + 1).cast("int"))
    players = p.select(F.col("p_partkey").alias("ID"), F.date_add(F.lit("1990-01-01").cast("date"), F.col("p_size") * 100).alias("DateBirth"),
                       (F.col("p_size") + 150).alias("Height"), F.when(F.col("p_size") % 2 == 0, "Left").otherwise("Right").alias("PrefFoot"),
                       pos.alias("Position"), F.col("p_type").alias("Role"))
    s = stats(spark, sf).drop("Date", "Brand", "Name").withColumn("Team", F.col("Team") % 25)
    return rounded(sim.similarity_features(matches(spark, sf), s, players, "1998", "2020-01-01",
                                           ["PassAccuracy", "GoalsPer90", "DefensiveActionsPer90"], min_minutes=100),
                   4, "PassAccuracy", "GoalsPer90", "DefensiveActionsPer90")


@query("n1_similarity_features")
def n1(spark, sf):
    """Season aggregates with profile of the players with enough minutes."""
    return _frame(spark, sf)


@query("n1_similarity_frame", f"""
WITH {STATS}, {SIDES.strip()},
g AS (SELECT player, sum(minutes) AS mi, sum(passes) AS pa, sum(acc) AS ac, sum(goals) AS go, sum(tackles + inter + clear + blocks) AS de
      FROM v_stats s JOIN v_sides v ON v.id = s.match AND v.team = s.team % 25 WHERE season = '1998' GROUP BY 1 HAVING sum(minutes) >= 100),
f AS (SELECT g.*, p_size, p_type, ['GK', 'CB', 'LB', 'DM', 'AM', 'ST', 'RW'][(player % 7 + 1)::INT] AS pos,
        {ratio('ac', 'pa')} AS accuracy, {r(f"go * {ratio('90', 'mi')}", 4)} AS goals, {r(f"de * {ratio('90', 'mi')}", 4)} AS actions FROM g JOIN part ON p_partkey = player),
i AS (SELECT *, coalesce(accuracy, avg(accuracy) OVER w) AS a, coalesce(goals, avg(goals) OVER w) AS go2, coalesce(actions, avg(actions) OVER w) AS de2
      FROM f WINDOW w AS (PARTITION BY pos))
SELECT player AS "Player", CASE WHEN pos IN ('ST', 'RW') THEN 'Attacker' WHEN pos IN ('CB', 'LB') THEN 'Defender' WHEN pos IN ('DM', 'AM') THEN 'Midfielder' ELSE 'Goalkeeper' END AS grp,
  floor((DATE '2020-01-01' - (DATE '1990-01-01' + (p_size * 100)::INT)) / 365.0)::DOUBLE AS "Age", (p_size + 150)::DOUBLE AS "Height",
  {r('a', 4)} AS "PassAccuracy", {r('go2', 4)} AS "GoalsPer90", {r('de2', 4)} AS "DefensiveActionsPer90",
  'Position_' || pos || '|PrefFoot_' || CASE WHEN p_size % 2 = 0 THEN 'Left' ELSE 'Right' END || '|Role_' || pos || ' - ' || p_type AS hot
FROM i""")
def n1_frame(spark, sf):
    """The same frame with its one-hot columns as the list of those that are 1."""
    df = _frame(spark, sf)
    hot = [c for c in df.columns if c.split("_")[0] in ("PrefFoot", "Position", "Role")]
    named = F.array(*[F.when(F.col(f"`{c}`") == 1, F.lit(c)) for c in hot])
    return df.select("Player", "grp", F.col("Age").cast("double"), F.col("Height").cast("double"), "PassAccuracy", "GoalsPer90", "DefensiveActionsPer90",
                     F.array_join(F.array_sort(F.array_compact(named)), "|").alias("hot"))


@query("n2_similar_pairs", _PAIRS + f"""
SELECT label AS grp, a, b, {r('s', 4)} AS similarity FROM p WHERE a < b AND s >= 60""")
def n2(spark, sf):
    return rounded(sim.similarity_pairs(_vectors(spark, sf), 60), 4, "similarity").select("grp", "a", "b", "similarity")


_GAPS = """
WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
x AS (SELECT vec_id, label, d, CASE WHEN label = 3 AND d = 6 AND vec_id % 2 = 0 THEN NULL WHEN label = 4 AND d = 8 THEN 1.0 ELSE x END AS x
      FROM (SELECT vec_id, label, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM e)),
m AS (SELECT label, d, avg(x) AS mu, stddev_pop(x) AS sd, count(*) = count(x) AND min(x) < max(x) AS keep FROM x GROUP BY 1, 2)"""


def _gappy(spark, sf):
    """Vectors with a column that is partly null in one group and one that is constant in another."""
    label, odd = F.col("label"), F.col("vec_id") % 2 == 0
    v = F.transform("embedding", lambda x, i: F.when((label == 3) & (i == 5) & odd, F.lit(None).cast("double"))
                    .when((label == 4) & (i == 7), F.lit(1.0)).otherwise(x.cast("double")))
    return table(spark, sf, "embeddings").select("vec_id", "label", v.alias("v"))


@query("n2_pairs_with_group_columns", _GAPS + f""",
z AS (SELECT vec_id, x.label, list((x - mu) / sd ORDER BY x.d) AS z FROM x JOIN m ON m.label = x.label AND m.d = x.d WHERE keep GROUP BY 1, 2),
u AS (SELECT vec_id, label, list_transform(z, lambda t: t / sqrt(list_dot_product(z, z))) AS u FROM z)
SELECT a.label AS grp, a.vec_id AS a, b.vec_id AS b, {r('(list_dot_product(a.u, b.u) + 1) / 2 * 100', 4)} AS similarity, len(a.u) AS columns
FROM u a JOIN u b ON a.label = b.label AND a.vec_id < b.vec_id AND (list_dot_product(a.u, b.u) + 1) / 2 * 100 >= 60""")
def n2_columns(spark, sf):
    v = sim.feature_vectors(_gappy(spark, sf), "vec_id", "label", ["v"])
    return rounded(sim.similarity_pairs(v, 60), 4, "similarity").select("grp", "a", "b", "similarity", "columns")


@query("p14_group_columns", _GAPS + f"""
SELECT label AS grp, (d - 1)::INT AS place, {r('mu', 6)} AS mean, {r('sd', 6)} AS deviation FROM m WHERE keep""")
def p14_columns(spark, sf):
    masks = sim.column_masks(_gappy(spark, sf).select(F.col("label").alias("grp"), "v"))
    each = masks.select("grp", F.posexplode(F.arrays_zip("_m", "_d", "_keep")).alias("place", "c")).filter("c._keep")
    return rounded(each.select("grp", "place", F.col("c._m").alias("mean"), F.col("c._d").alias("deviation")), 6, "mean", "deviation")


@query("n3_top_similar", _PAIRS + f""",
k AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY round(s, 6) DESC, b) AS num FROM p)
SELECT label AS grp, a AS id, b AS other, num::INT AS num, {r('s', 4)} AS similarity FROM k WHERE num <= 50""")
def n3(spark, sf):
    return rounded(sim.top_similar(_vectors(spark, sf), 50), 4, "similarity").select("grp", "id", "other", "num", "similarity")


_N4 = ["HomeGoals", "HomeOppGoals", "AwayOppGoals", "AwayGoals", "Elo", "OppElo", "Matches", "Total", "Formation_BUILDING",
       "Formation_AUTOMOBILE", "Formation_FURNITURE", "Formation_HOUSEHOLD", "Formation_MACHINERY"]


@query("n4_team_similarity", f"""
WITH {SIDES}, c AS (SELECT team, sum(score) FILTER (ha = 'Home')::DOUBLE AS c1, sum(opp_score) FILTER (ha = 'Home')::DOUBLE AS c2,
  sum(opp_score) FILTER (ha = 'Away')::DOUBLE AS c3, sum(score) FILTER (ha = 'Away')::DOUBLE AS c4, avg(elo) AS c5, avg(opp_elo) AS c6 FROM v_sides GROUP BY team),
g AS (SELECT c_nationkey::BIGINT AS team, count(*)::DOUBLE AS c7, sum(c_acctbal) AS c8 FROM customer GROUP BY 1),
fm AS (SELECT team, seg FROM (SELECT c_nationkey::BIGINT AS team, c_mktsegment AS seg, row_number() OVER (PARTITION BY c_nationkey ORDER BY count(*) DESC, c_mktsegment) AS rn
   FROM customer GROUP BY 1, 2, c_nationkey) WHERE rn = 1),
t AS (SELECT c.*, c7, c8, seg FROM c JOIN g USING (team) JOIN fm USING (team) WHERE c7 >= 5),
l AS (SELECT DISTINCT seg FROM t),
lv AS (SELECT team, list((t.seg = l.seg)::INT::DOUBLE ORDER BY l.seg) AS h FROM t, l GROUP BY team),
v AS (SELECT team, list_concat([c1, c2, c3, c4, c5, c6, c7, c8], h) AS v FROM t JOIN lv USING (team)),
x AS (SELECT team, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM v),
m AS (SELECT d, avg(x) AS mu, stddev_pop(x) AS sd FROM x GROUP BY 1),
z AS (SELECT team, list(CASE WHEN sd > 1e-12 THEN (x - mu) / sd ELSE 0 END ORDER BY x.d) AS z FROM x JOIN m ON m.d = x.d GROUP BY 1),
p AS (SELECT a.team AS a, b.team AS b, (list_dot_product(a.z, b.z) / sqrt(list_dot_product(a.z, a.z) * list_dot_product(b.z, b.z)) + 1) / 2 * 100 AS s FROM z a JOIN z b ON a.team <> b.team),
k AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY round(s, 6) DESC, b) AS num FROM p)
SELECT a AS id, b AS other, num::INT AS num, {r('s', 4)} AS similarity FROM k WHERE num <= 50""")
def n4(spark, sf):
    rows = shape.to_team_rows(matches(spark, sf), home_elo="HomeElo", away_elo="AwayElo")
    c = table(spark, sf, "customer").select(F.col("c_nationkey").cast("long").alias("Team"), F.col("c_acctbal").alias("Total"),
                                            F.col("c_mktsegment").alias("Formation"))
    season = agg.aggregate_entity(c, "Team", {"Formation": "mode"})
    feats = sim.team_features(agg.team_context(rows), season)
    return rounded(sim.team_similarity(feats, 50), 4, "similarity").select("id", "other", "num", "similarity")


@query("n5_style_cosine", _E + f"""
x AS (SELECT label, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM e),
c AS (SELECT label, list(mu ORDER BY d) AS c FROM (SELECT label, d, avg(x) AS mu FROM x GROUP BY 1, 2) GROUP BY 1)
SELECT vec_id AS player, c.label AS team, {r('list_dot_product(v, c) / sqrt(list_dot_product(v, v) * list_dot_product(c, c))', 6)} AS similarity FROM e, c""")
def n5(spark, sf):
    e = table(spark, sf, "embeddings")
    cols = [F.avg(F.col("embedding")[i].cast("double")) for i in range(_DIMS)]
    teams = e.groupBy(F.col("label").alias("id")).agg(F.array(*cols).alias("v"))
    players = e.select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("v"))
    return rounded(sim.cross_similarity(players, teams), 6, "similarity")


def _members(spark, sf):
    """Vectors with a squad of ten; the label is the position group."""
    return _vectors(spark, sf).withColumn("team", F.pmod(F.col("id") * 7, F.lit(10)).cast("long"))


@query("n6_squad_similarity", _Z + f"""
s AS (SELECT vec_id, label, u, (vec_id * 7 % 10)::BIGINT AS team FROM u),
w AS (SELECT vec_id AS player, team AS own, (team + 1 + vec_id % 3) % 10 AS other FROM s),
q AS (SELECT w.player, w.other, (list_dot_product(a.u, b.u) + 1) / 2 * 100 AS s FROM w JOIN s a ON a.team = w.own AND a.vec_id <> w.player
      JOIN s b ON b.team = w.other AND b.label = a.label)
SELECT player, other AS team, {r('avg(s)', 4)} AS similarity FROM q GROUP BY 1, 2""")
def n6(spark, sf):
    m = _members(spark, sf)
    pairs = m.select(F.col("id").alias("player"), ((F.col("team") + 1 + F.col("id") % 3) % 10).alias("team"))
    return rounded(sim.squad_similarity(m, pairs), 4, "similarity")


@query("n7_heatmap_correlation", f"""
WITH {FEED}, c AS (SELECT player, type, least(floor(x * 24 / 100), 23) * 16 + least(floor(y * 16 / 100), 15) AS cell FROM v_feed WHERE x BETWEEN 0 AND 100 AND y BETWEEN 0 AND 100),
a AS (SELECT player, cell, count(*) AS n FROM c GROUP BY 1, 2), b AS (SELECT type, cell, count(*) AS n FROM c GROUP BY 1, 2),
g AS (SELECT generate_series::DOUBLE AS cell FROM generate_series(0, 383)),
pr AS (SELECT DISTINCT player, type FROM c),
f AS (SELECT pr.player, pr.type, g.cell, coalesce(a.n, 0)::DOUBLE AS na, coalesce(b.n, 0)::DOUBLE AS nb FROM pr CROSS JOIN g
   LEFT JOIN a ON a.player = pr.player AND a.cell = g.cell LEFT JOIN b ON b.type = pr.type AND b.cell = g.cell)
SELECT player AS a, type AS b, {r('corr(na, nb)', 6)} AS corr FROM f GROUP BY 1, 2""")
def n7(spark, sf):
    v = feed(spark, sf)
    a = sim.heat_cells(v.select(F.col("player").alias("a"), F.col("x").alias("IniX"), F.col("y").alias("IniY")), "a")
    b = sim.heat_cells(v.select(F.col("Type").alias("b"), F.col("x").alias("IniX"), F.col("y").alias("IniY")), "b")
    pairs = v.select(F.col("player").alias("a"), F.col("Type").alias("b"))
    return rounded(sim.heatmap_corr(a, b, pairs), 6, "corr")


def _fit_inputs(spark, sf):
    """Customers as players, nations as clubs, with every side of a measure derived from the tables."""
    c, n = table(spark, sf, "customer"), table(spark, sf, "nation")
    nation = F.col("c_nationkey").cast("long")
    players = c.select(
        F.col("c_custkey").alias("player"), nation.alias("own"), F.col("c_mktsegment").alias("country"),
        F.array("c_mktsegment").alias("formations"), F.array(F.when(F.col("c_acctbal") > 0, F.lit("up")).otherwise(F.lit("down"))).alias("competitions"),
        (F.col("c_custkey") * 1.0).alias("birth"), F.abs("c_acctbal").alias("rating"), (F.col("c_acctbal") / 2).alias("potential"),
        (nation * 10.0).alias("own_elo"))
    squads = c.groupBy(nation.alias("team")).agg(
        F.array_sort(F.collect_set("c_mktsegment")).alias("team_countries"), F.avg(F.col("c_custkey") * 1.0).alias("team_birth"),
        F.avg(F.abs("c_acctbal")).alias("team_rating"), F.avg(F.col("c_acctbal") / 2).alias("team_potential"))
    region = F.col("n_regionkey")
    teams = n.select(F.col("n_nationkey").cast("long").alias("team"),
                     F.when(region == 0, "BUILDING").otherwise("MACHINERY").alias("team_country"),
                     F.array(F.when(region < 3, "BUILDING").otherwise("FURNITURE")).alias("team_formations"),
                     F.array(F.when(region % 2 == 0, "up").otherwise("down")).alias("team_competitions"),
                     (F.col("n_nationkey") * 10.0).alias("team_elo")).join(squads, "team")
    pairs = sim.candidate_pairs(players, teams.select("team"))
    num = lambda x: (x % 100).cast("double")
    both = pairs.select("player", "team")
    team_sim = pairs.select(F.col("own").alias("id"), F.col("team").alias("other"),
                            num(F.col("own") * 3 + F.col("team")).alias("similarity")).distinct()
    squad = both.withColumn("similarity", num(F.col("player") + F.col("team") * 7))
    pos = both.filter("player % 50 <> 0").withColumn("similarity", num(F.col("player") * 3 + F.col("team")))
    passes = both.filter("player % 4 <> 0").withColumn("PassesCorrelation", num(F.col("player") * 5 + F.col("team")))
    style = both.withColumn("similarity", num(F.col("player") + F.col("team")) / 100)
    return sim.fit_measures(pairs, players.drop("own"), teams, team_sim, squad, pos, passes, style,
                            tiers={"up": "A", "down": "B"}, families={"BUILDING": "A", "MACHINERY": "A", "FURNITURE": "B"})


_N8 = """
WITH sq AS (SELECT c_nationkey::BIGINT AS team, list(DISTINCT c_mktsegment) AS cs, avg(c_custkey * 1.0::DOUBLE) AS tb, avg(abs(c_acctbal)) AS tr, avg(c_acctbal / 2) AS tp FROM customer GROUP BY 1),
pr AS (SELECT c_custkey AS player, c_nationkey::BIGINT AS own, c_mktsegment AS seg, c_acctbal AS bal, n_nationkey::BIGINT AS team, n_regionkey AS region
   FROM customer, nation WHERE c_nationkey <> n_nationkey),
ms AS (SELECT player, pr.team, ((own * 3 + pr.team) % 100)::DOUBLE AS f1, ((player + pr.team * 7) % 100)::DOUBLE AS f2,
  (CASE WHEN seg IN ('BUILDING', 'MACHINERY') THEN 'A' WHEN seg = 'FURNITURE' THEN 'B' ELSE 'Z' END = CASE WHEN region < 3 THEN 'A' ELSE 'B' END)::INT AS f3,
  ((bal > 0) = (region % 2 = 0))::INT AS f4,
  CASE WHEN seg = CASE WHEN region = 0 THEN 'BUILDING' ELSE 'MACHINERY' END THEN 1.0 WHEN list_contains(cs, seg) THEN 0.5 ELSE 0.0 END::DOUBLE AS f5,
  ((player * 3 + pr.team) % 100)::DOUBLE AS f6, CASE WHEN player % 4 <> 0 THEN ((player * 5 + pr.team) % 100)::DOUBLE END AS f7,
  tb - player AS f8, pr.team * 10.0::DOUBLE - own * 10 AS f9, tr - abs(bal) AS f10, tp - bal / 2 AS f11, ((player + pr.team) % 100) / 100.0::DOUBLE AS f12
  FROM pr JOIN sq ON sq.team = pr.team WHERE player % 50 <> 0)"""
_NAMES = ["TeamsCorrelation", "SquadsCorrelation", "FormationsMatch", "TournamentsMatch", "CountryMatch", "SamePosCorrelation",
          "PassesCorrelation", "TimestampDiff", "EloRatingDiff", "RatingDiff", "PotentialDiff", "StatsCorrelation"]


@query("n8_fit_measures", _N8 + f"""
SELECT player, team, f3 AS "FormationsMatch", f4 AS "TournamentsMatch", {', '.join(f'{r(f"f{i + 1}", 4)} AS "{n}"' for i, n in enumerate(_NAMES) if i not in (2, 3))} FROM ms""")
def n8(spark, sf):
    return rounded(_fit_inputs(spark, sf), 4, *[n for n in _NAMES if n not in ("FormationsMatch", "TournamentsMatch")])


def _score():
    parts, w = [], FIT_WEIGHTS
    for i, n in enumerate(_NAMES):
        c = f"f{i + 1}"
        if n in sim.PERCENT:
            e = clip01(f"{c} / 100")
        elif n in sim.UNIT:
            e = clip01(c)
        else:
            lo, hi = f"min(abs({c})) OVER (PARTITION BY team)", f"max(abs({c})) OVER (PARTITION BY team)"
            e = f"1 - (abs({c}) - {lo}) / nullif({hi} - {lo}, 0)"
        if n in sim.PERCENT + sim.UNIT:
            e = f"CASE WHEN {c} IS NOT NULL THEN {e} END"
        parts.append(f"{w[n]}::DOUBLE * coalesce({e}, 0.5)")
    return f"({' + '.join(parts)}) / {sum(w.values())}::DOUBLE"


_N9 = _N8 + f""", sc AS (SELECT player, team, {_score()} AS score FROM ms)"""


@query("n9_fit_score", _N9 + f"""
SELECT player, team, {r('score', 6)} AS "Score" FROM sc""")
def n9(spark, sf):
    measures = materialize(_fit_inputs(spark, sf), "measures")
    return rounded(sim.fit_score(measures), 6, "Score").select("player", "team", "Score")


@query("n10_stars", f"""
WITH t AS (SELECT o_orderkey, o_orderstatus, o_totalprice, min(o_totalprice) OVER (PARTITION BY o_orderstatus) AS lo,
   max(o_totalprice) OVER (PARTITION BY o_orderstatus) AS hi FROM orders)
SELECT o_orderkey, round_even(((o_totalprice - lo) / nullif(hi - lo, 0) * 9 + 1) / 2 * 2, 0) / 2 AS "Stars" FROM t""")
def n10(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return sim.stars(o, "o_orderstatus", "o_totalprice").select("o_orderkey", "Stars")


@query("n11_fit_documents", _N9 + f""",
st AS (SELECT *, min(score) OVER (PARTITION BY team) AS lo, max(score) OVER (PARTITION BY team) AS hi FROM sc)
SELECT team, player, c_name AS name, {r('score', 6)} AS score, round_even(((score - lo) / (hi - lo) * 9 + 1) / 2 * 2, 0) / 2 AS stars
FROM st JOIN customer ON c_custkey = player""")
def n11(spark, sf):
    names = table(spark, sf, "customer").select(F.col("c_custkey").alias("ID"), F.col("c_name").alias("Name"))
    measures = materialize(_fit_inputs(spark, sf), "measures")
    scored = sim.stars(materialize(sim.fit_score(measures).select("player", "team", "Score"), "scores"))
    docs = sim.fit_documents(scored, names, chunk=64)
    rows = docs.select("team", F.explode("PlayersAdaptability").alias("k", "d"))
    return rounded(rows.select("team", F.col("d.Player").alias("player"), F.col("d.Name").alias("name"),
                               F.col("d.Score").alias("score"), F.col("d.Stars").alias("stars")), 6, "score")
