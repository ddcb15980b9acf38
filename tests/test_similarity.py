"""Tiled similarity against all pairs, the columns that count per group, and how much is compared."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from scoutlake import session
from scoutlake.operators import similarity as sim


def clustered(n, d=6, centres=12, seed=3, spread=0.02):
    rng = np.random.default_rng(seed)
    c = rng.normal(size=(centres, d))
    v = c[rng.integers(0, centres, n)] + rng.normal(scale=spread, size=(n, d))
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def frame(spark, groups, schema="id long, grp string, v array<double>"):
    rows = [(i, g, list(map(float, x))) for g, (ids, v) in groups.items() for i, x in zip(ids, v)]
    return spark.createDataFrame(rows, schema).repartition(5)


def brute_top(groups, n, metric):
    want = {}
    for ids, v in groups.values():
        ids, v = np.array(ids), np.array(v)
        if metric == "cosine":
            s = (np.clip(v @ v.T, -1, 1) + 1) * 50
        else:
            s = 1 / (1 + np.sqrt(((v[:, None] - v[None]) ** 2).sum(-1)))
        for i in range(len(ids)):
            order = sorted((j for j in range(len(ids)) if j != i), key=lambda j: (-round(s[i, j], 6), ids[j]))[:n]
            for k, j in enumerate(order):
                want[int(ids[i]), k + 1] = (int(ids[j]), s[i, j])
    return want


@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
@pytest.mark.parametrize("tile, pivots", [(4096, 4096), (25, 4096), (25, 4)])
def test_top_similar_equals_all_pairs(spark, tile, pivots, metric, monkeypatch):
    monkeypatch.setattr(sim, "PIVOTS", pivots)
    init = sim.Tiling.__init__
    monkeypatch.setattr(sim.Tiling, "__init__", lambda self, vectors, tile_rows, p=pivots: init(self, vectors, tile_rows, p))
    same = np.tile([0.6, 0.8, 0, 0, 0, 0], (60, 1))  # one vector many times
    groups = {"a": (range(300), clustered(300)), "b": (range(300, 420), np.concatenate([clustered(60, seed=8), same])),
              "c": (range(420, 424), clustered(4)), "d": ([424], clustered(1)), None: ([425, 426], np.zeros((2, 6)))}
    del groups[None]
    want = brute_top(groups, 7, metric)
    got = {(r["id"], r["num"]): (r["other"], r["similarity"]) for r in sim.top_similar(frame(spark, groups), 7, metric, tile).collect()}
    assert got.keys() == want.keys()
    for k, (other, s) in want.items():
        assert math.isclose(got[k][1], s, abs_tol=2e-6), k
    wrong = [k for k in want if got[k][0] != want[k][0]]
    assert all(math.isclose(got[k][1], want[k][1], abs_tol=2e-6) for k in wrong) and len(wrong) < 0.01 * len(want) + 1


@pytest.mark.parametrize("tile", [4096, 20])
def test_pairs_equal_all_pairs(spark, tile):
    groups = {"a": (range(200), clustered(200, spread=0.2)), "b": (range(200, 250), clustered(50, seed=4, spread=0.3))}
    want = {}
    for ids, v in groups.values():
        s = (np.clip(v @ v.T, -1, 1) + 1) * 50
        want |= {(ids[i], ids[j]): s[i, j] for i in range(len(ids)) for j in range(i + 1, len(ids)) if s[i, j] >= 97}
    rows = sim.similarity_pairs(frame(spark, groups), 97, tile_rows=tile).collect()
    assert len(rows) == len(want) and {(r["a"], r["b"]) for r in rows} == want.keys()


def test_far_tiles_are_not_compared(spark):
    """On clustered vectors nearly no row goes to another tile; all rows to all tiles would be 600 times 29."""
    v = clustered(600, centres=30, spread=0.001)
    tiling = sim.Tiling(frame(spark, {"a": (range(600), v)}), 20)
    tiles = tiling.rows.select("grp", "pivot", "sub").distinct().count()
    sent = tiling.sent("cosine", F.lit(99.9)).count()
    assert tiles >= 20 and sent < 0.1 * 600 * (tiles - 1)
    top = tiling.rows.groupBy("grp", "pivot", "sub").count().agg(F.max("count")).first()[0]
    assert top <= 60


def test_columns_count_per_group(spark):
    nan = float("nan")
    rows = [(1, "a", 1.0, 5.0, None, 2.0), (2, "a", 3.0, 5.0, 1.0, 4.0), (3, "a", 2.0, 5.0, 2.0, 9.0),
            (4, "b", 1.0, 6.0, 1.0, nan), (5, "b", 1.0, 7.0, 3.0, 1.0), (6, "b", 1.0, 9.0, 4.0, 2.0), (7, "c", 1.0, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "id long, g string, w double, x double, y double, z double")
    cols = ["w", "x", "y", "z"]
    kept = {"a": [0, 3], "b": [1, 2], "c": []}
    got = {r["id"]: r["v"] for r in sim.feature_vectors(df, "id", "g", cols, unit_length=False).collect()}
    for g, places in kept.items():
        own = np.array([[r[2 + p] for p in places] for r in rows if r[1] == g], dtype="float64")
        want = (own - own.mean(0)) / own.std(0) if places else own
        for r, z in zip([r for r in rows if r[1] == g], want):
            assert np.allclose(got[r[0]], z) and len(got[r[0]]) == len(places)
    heavy = {r["id"]: r["v"] for r in sim.feature_vectors(df, "id", "g", cols, weights={"z": 3.0}, unit_length=False).collect()}
    assert np.allclose(heavy[1], np.array(got[1]) * [1, 3]) and np.allclose(heavy[4], got[4])
    as_array = df.select("id", "g", F.array(*cols).alias("v"))
    assert {r["id"]: r["v"] for r in sim.feature_vectors(as_array, "id", "g", ["v"], unit_length=False).collect()} == got
    plain = {r["id"]: r["v"] for r in sim.feature_vectors(df, "id", "g", cols, scale=False, unit_length=False).collect()}
    assert plain[1] == [1.0, 5.0, 0.0, 2.0] and plain[4] == [1.0, 6.0, 1.0, 0.0]


def test_pairs_are_never_taken_for_a_small_table(spark):
    """Spark's estimate covers all pairs, and the sides with a row for each pair are merged, not broadcast."""
    players = spark.createDataFrame([(i, i % 50) for i in range(200)], "player int, own int")
    teams = spark.createDataFrame([(i,) for i in range(50)], "team int")
    pairs = sim.candidate_pairs(players, teams)
    assert {tuple(r) for r in pairs.collect()} == {(i, i % 50, t) for i in range(200) for t in range(50) if t != i % 50}
    assert pairs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() >= 200 * 49 * 12
    path = session.scratch_path(spark, "pairs")
    pairs.write.parquet(path)
    read = spark.read.parquet(path)  # a small file
    side = read.select("player", "team", F.lit(0.5).alias("similarity"))
    lists = F.array(F.lit("4-4-2")), F.array(F.lit("cup"))
    who = players.select("player", F.lit("x").alias("country"), lists[0].alias("formations"), lists[1].alias("competitions"),
                         *[F.lit(1.0).alias(c) for c in ("birth", "rating", "potential", "own_elo")])
    of = teams.select("team", F.lit("x").alias("team_country"), F.array(F.lit("x")).alias("team_countries"),
                      lists[0].alias("team_formations"), lists[1].alias("team_competitions"),
                      *[F.lit(1.0).alias(c) for c in ("team_birth", "team_rating", "team_potential", "team_elo")])
    team_sim = read.select(F.col("own").alias("id"), F.col("team").alias("other"), F.lit(0.5).alias("similarity")).distinct()
    out = sim.fit_measures(read, who, of, team_sim, side, side, side.withColumnRenamed("similarity", "PassesCorrelation"), side)
    assert out._jdf.queryExecution().executedPlan().toString().count("SortMergeJoin") >= 5
    assert out.count() == 200 * 49


def test_pairs_bring_their_columns_without_a_join(spark):
    """A join by group would sort all pairs of a group in one task."""
    groups = {"a": (range(60), clustered(60, spread=0.2)), "b": (range(60, 90), clustered(30, d=4, seed=4, spread=0.3))}
    found = sim.similarity_pairs(frame(spark, groups), 60)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInPandas" in plan and "FlatMapGroupsInPandas" not in plan  # a tile's pairs are not one frame
    assert {(r["grp"], r["columns"]) for r in found.collect()} == {("a", 6), ("b", 4)}
