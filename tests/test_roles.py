"""Components and clusters of all groups at once against numpy, group by group."""

import threading
import types

import numpy as np
import pytest

from scoutlake.operators import rating, roles


def frame(spark, groups):
    rows = [(f"{g}{i}", g, None if x is None else [None if v is None else float(v) for v in x]) for g, v in groups.items() for i, x in enumerate(v)]
    return spark.createDataFrame(rows, "id string, grp string, v array<double>").repartition(4)


def test_components_equal_numpy(spark):
    rng = np.random.default_rng(3)
    groups = {"a": rng.normal(size=(80, 4)) @ rng.normal(size=(4, 4)) * [1, 50, 1e-3, 1] + [0, 1e6, 0, 3],
              "b": np.c_[rng.normal(size=(30, 2)) @ rng.normal(size=(2, 2)), np.full(30, 7.0)], "c": rng.normal(size=(3, 2))}
    odd = {k: list(v) + ([[1.0, None, 2.0, 3.0], None] if k == "a" else []) for k, v in groups.items()}
    scores, axes = roles.pca_by_group(frame(spark, odd), 2)
    got = {r["id"]: r["scores"] for r in scores.collect()}
    share = {r["grp"]: r["explained"] for r in axes.collect()}
    assert got["a80"] is None and got["a81"] is None and len(got) == 115
    for g, x in groups.items():
        sd = x.std(0)
        z = np.where(sd > 1e-9, (x - x.mean(0)) / np.where(sd > 1e-9, sd, 1), 0)
        value, vector = np.linalg.eigh(z.T @ z / len(z))
        want = z @ vector[:, ::-1][:, :2]
        mine = np.array([got[f"{g}{i}"] for i in range(len(x))])
        for j in range(2):
            assert np.allclose(np.abs(mine[:, j]), np.abs(want[:, j]), atol=1e-6)
        assert np.allclose(share[g], value[::-1][:2] / value.sum(), atol=1e-9)


def silhouette(x, c):
    out = []
    for i in range(len(x)):
        d = ((x - x[i]) ** 2).sum(1)
        own = (c == c[i]).sum()
        if own == 1:
            out.append(0.0)
            continue
        a, b = d[c == c[i]].sum() / (own - 1), min(d[c == k].mean() for k in set(c) if k != c[i])
        out.append((b - a) / max(a, b) if max(a, b) else 0.0)
    return np.mean(out)


def test_clusters_of_all_groups(spark, monkeypatch):
    rng = np.random.default_rng(5)
    clouds = {"a": 3, "b": 4, "c": 6}
    groups = {g: np.concatenate([rng.normal(loc=30 * np.eye(6)[i], scale=.5, size=(20, 6)) for i in range(n)]) for g, n in clouds.items()}
    groups["two"] = np.repeat([[0.0, 0.0], [1.0, 1.0]], 3, axis=0)  # fewer different rows than clusters
    groups["none"] = [[None, 1.0]]
    calls = []
    passes = roles._passes
    monkeypatch.setattr(roles, "_passes", lambda *a: calls.append(1) or passes(*a))
    found, tried = roles.kmeans_by_group(frame(spark, groups))
    got = {r["id"]: r["Cluster"] for r in found.collect()}
    many = len(calls)
    for g, n in clouds.items():
        own = np.array([got[f"{g}{i}"] for i in range(20 * n)])
        assert len(set(own)) == n and all(len(set(own[i * 20:i * 20 + 20])) == 1 for i in range(n))
        k, cost, quality = max(tried[g], key=lambda t: (round(t[2], 12), -t[0]))
        centre = np.array([groups[g][own == c].mean(0) for c in own])
        assert k == n and np.isclose(cost, ((groups[g] - centre) ** 2).sum()) and np.isclose(quality, silhouette(groups[g], own))
    assert got["none0"] is None and {got[f"two{i}"] for i in range(6)} == {0}
    calls.clear()
    roles.kmeans_by_group(frame(spark, {"a": groups["a"]}), starts=2)
    assert abs(len(calls) - many) <= 20 and many <= 22  # passes, whatever the number of groups and starts
    with pytest.raises(ValueError):
        roles.kmeans_by_group(frame(spark, groups), 4, 3)


def test_separate_leagues_are_separate_tasks(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(400):
        league = i % 3
        h, a = rng.choice(6, 2, replace=False) + 10 * league
        rows.append((i, i // 4, int(h), int(a)))
    df = spark.createDataFrame(rows, "_id int, _date int, _home int, _away int").repartition(4)
    staged, windows = rating.elo_windows(df, 100)
    got = {(r["_w"], r["_c"]): r["n"] for r in staged.groupBy("_w", "_c").count().withColumnRenamed("count", "n").collect()}
    assert windows == 4 and sum(got.values()) == 400
    for w in range(windows):
        own = [c for v, c in got if v == w]
        assert len(own) >= 3
    teams = staged.select("_w", "_c", "_home").distinct().collect()
    assert all(r["_c"] // 10 == r["_home"] // 10 and r["_c"] <= r["_home"] for r in teams)


def test_starts_are_fitted_side_by_side(spark, monkeypatch):
    """Two fits must meet before either goes on; each k keeps its cheapest start, ties the first."""
    meet = threading.Barrier(2, timeout=30)

    class Fit:
        def __init__(self, k, seed, **_):
            self.k, self.seed = k, seed
            self.summary = types.SimpleNamespace(trainingCost=float((seed * 7 + k) % 3))

        def fit(self, _):
            meet.wait()
            return self

    monkeypatch.setattr(roles, "KMeans", Fit)
    best = roles._best_starts(spark.range(1), range(3, 5), 4, 42)
    assert {k: m.seed for k, m in best.items()} == {
        k: min(range(42, 46), key=lambda s: ((s * 7 + k) % 3, s)) for k in (3, 4)}
