"""Operators without a SQL check, and skew paths, against plain Python on small frames."""

import datetime as dt
import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from scoutlake.functions.text import matching_share, seq_ratio, token_set_score
from scoutlake.operators import charts, rating, resolve, roles, similarity as sim, windows as win


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


# -- text ----------------------------------------------------------------------

def lcs(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, j in itertools.product(range(len(a)), range(len(b))):
        t[i + 1][j + 1] = t[i][j] + 1 if a[i] == b[j] else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


def plain_token_set(a, b):
    """Definition by the three joined strings."""
    wa, wb = set(a.split()), set(b.split())
    if not wa or not wb:
        return 0.0
    both, da, db = sorted(wa & wb), sorted(wa - wb), sorted(wb - wa)
    if both and (not da or not db):
        return 100.0
    s0, s1, s2 = " ".join(both), " ".join(both + da), " ".join(both + db)

    def ratio(x, y):
        return 100.0 if not x and not y else 200.0 * lcs(x, y) / (len(x) + len(y))

    def joined(x, y):        # same first part: only the rest differs
        rest = len(" ".join(da)) + len(" ".join(db)) - 2 * lcs(" ".join(da), " ".join(db))
        return 100.0 - 100.0 * rest / (len(x) + len(y))

    return max(joined(s1, s2), *([ratio(s0, s1), ratio(s0, s2)] if both else [0.0]))


def test_token_set_score():
    rnd = random.Random(3)
    words = ["real", "madrid", "reall", "club", "athletic", "atletico", "inter", "milan", "ac"]
    for _ in range(400):
        a, b = (" ".join(rnd.choices(words, k=rnd.randint(1, 4))) for _ in range(2))
        assert token_set_score(a, b) == pytest.approx(plain_token_set(a, b))
        assert token_set_score(a, b) == pytest.approx(token_set_score(b, a))
        assert token_set_score(a, a) == 100.0
    assert token_set_score("", "x") == 0.0 and token_set_score(None, "x") == 0.0


def test_sequence_ratio(spark):
    df = spark.createDataFrame([(" Ab ", "ab"), (None, "a"), ("abcd", "bcde"), ("", "")], "a string, b string")
    assert [r[0] for r in df.select(seq_ratio("a", "b")).collect()] == [1.0, None, 0.75, 1.0]


# -- Elo -----------------------------------------------------------------------

def plain_elo(matches, start, home_adv=100.0):
    r, out = dict(start), {}
    for m in sorted(matches, key=lambda m: (m[1], m[0])):
        i, _, h, a, hs, as_, k = m
        rh, ra = r.get(h, 1000.0), r.get(a, 1000.0)

        def factor(d):
            return 1 if d <= 1 else 1.5 if d == 2 else 1.75 if d == 3 else 1.75 + (d - 3) / 8

        wh = 1 if hs > as_ else 0.5 if hs == as_ else 0
        eh = 1 / (1 + 10 ** (-(rh - ra + home_adv) / 400))
        ea = 1 / (1 + 10 ** (-(ra - rh) / 400))
        r[h], r[a] = rh + k * factor(hs - as_) * (wh - eh), ra + k * factor(as_ - hs) * (1 - wh - ea)
        out[i] = (r[h], r[a])
    return out, r


@pytest.mark.parametrize("window_rows", [1_000_000, 37])
def test_elo_matches_plain_fold(spark, window_rows):
    rnd = random.Random(5)
    data = []
    for i in range(300):
        h, a = rnd.sample(range(12), 2)
        data.append((i, dt.date(2025, 1, 1) + dt.timedelta(days=rnd.randrange(60)), h, a,
                     rnd.randrange(6), rnd.randrange(6), float(rnd.choice([20, 40]))))
    rnd.shuffle(data)
    m = spark.createDataFrame(data, "ID int, Date date, HomeTeam int, AwayTeam int, HomeScore int, AwayScore int, k double")
    start = {t: 900.0 + 10 * t for t in range(10)}                    # two teams start from the default
    teams = spark.createDataFrame(list(start.items()), "ID int, EloRating double")
    got, table = rating.elo(m, teams, weight=F.col("k"), window_rows=window_rows)
    want, final = plain_elo(data, start)
    for r in got.collect():
        assert (r["HomeElo"], r["AwayElo"]) == pytest.approx(want[r["ID"]])
    assert {r["ID"]: r["EloRating"] for r in table.collect()} == pytest.approx(final)


def elo_frames(spark, n):
    rnd = random.Random(8)
    data = []
    for i in range(n):
        h, a = rnd.sample(range(9), 2)
        data.append((i, dt.date(2025, 1, 1) + dt.timedelta(days=rnd.randrange(20)), h, a, rnd.randrange(6), rnd.randrange(6), 30.0))
    m = spark.createDataFrame(data, "ID int, Date date, HomeTeam int, AwayTeam int, HomeScore int, AwayScore int, k double")
    return data, m, spark.createDataFrame([(t, 950.0) for t in range(9)], "ID int, EloRating double")


def test_elo_folds_a_chain_of_windows_in_one_job(spark, monkeypatch):
    """20 windows of 10 rows are one job's fold: as many frames written as for one window, the same ratings."""
    data, m, teams = elo_frames(spark, 200)
    names, write = [], rating.materialize
    monkeypatch.setattr(rating, "materialize", lambda df, name, *by: names.append(name) or write(df, name, *by))
    got, _ = rating.elo(m, teams, weight=F.col("k"), window_rows=10)
    want, _ = plain_elo(data, {t: 950.0 for t in range(9)})
    assert {r["ID"]: (r["HomeElo"], r["AwayElo"]) for r in got.collect()} == {i: pytest.approx(w) for i, w in want.items()}
    assert names.count("elo-out") == 1


def test_elo_ratings_pass_between_jobs(spark):
    data, m, teams = elo_frames(spark, 200)
    got, table = rating.elo(m, teams, weight=F.col("k"), window_rows=10, chain=7)
    want, final = plain_elo(data, {t: 950.0 for t in range(9)})
    assert {r["ID"]: (r["HomeElo"], r["AwayElo"]) for r in got.collect()} == {i: pytest.approx(w) for i, w in want.items()}
    assert {r["ID"]: r["EloRating"] for r in table.collect()} == pytest.approx(final)


# -- fuzzy matching ------------------------------------------------------------

def plain_fuzzy(a, b, thr, block):
    out = set()
    blocks = {r[1] for r in a} | {r[1] for r in b} if block else {None}
    for blk in blocks:
        aa = [r for r in a if not block or r[1] == blk]
        bb = [r for r in b if not block or r[1] == blk]
        swap = len(aa) <= len(bb)
        left, right = (bb, aa) if swap else (aa, bb)
        for row in left:
            best = None
            for f in (2, 3):
                cand = [(-token_set_score(row[f], c[f]), c[f], c[0]) for c in right if row[f] and c[f]]
                cand = [c for c in cand if -c[0] >= thr]
                if cand:
                    c = min(cand)
                    if best is None or c[0] < best[0]:
                        best = (c[0], c[2])
            if best:
                out.add((best[1], row[0]) if swap else (row[0], best[1]))
    return out


def people(rnd, n, tag):
    first = ["alba", "bruno", "carla", "dario", "elena"]
    last = ["rossi", "bianchi", "ferrari", "esposito", "romano", "colombo", "ricci", "marino"]
    out = []
    for i in range(n):
        x, y = rnd.choice(first), rnd.choice(last)
        if rnd.random() < 0.4:
            at = rnd.randrange(len(y))
            y = y[:at] + rnd.choice("abcxyz") + y[at + rnd.randrange(2):]
        name = f"{x} {y}" if rnd.random() < 0.5 else f"{y} {x}"
        out.append((f"{tag}{i:03d}", i % 3, name, None if rnd.random() < 0.2 else y))
    return out


@pytest.mark.parametrize("thr,block,tile", [(75, True, 2000), (75, True, 10), (90, True, 2000), (90, False, 2000), (90, False, 12)])
def test_fuzzy_match(spark, thr, block, tile):
    rnd = random.Random(thr + tile)
    a, b = people(rnd, 60, "a"), people(rnd, 45, "b")
    da = spark.createDataFrame(a, "IdSS string, blk int, Name string, ShortName string")
    db = spark.createDataFrame(b, "IdSW string, blk int, Name string, ShortName string")
    got = resolve.fuzzy_match(da, db, ["Name", "ShortName"], thr, block="blk" if block else None, tile_rows=tile)
    assert set(rows(got, "IdSS", "IdSW")) == plain_fuzzy(a, b, thr, block)


def test_best_choices_score_few_pairs(monkeypatch):
    rnd = random.Random(4)
    names = lambda n: sorted({" ".join("".join(rnd.choice("abcdefghij") for _ in range(rnd.choice([3, 5, 9])))
                                       for _ in range(rnd.choice([1, 2, 2, 3]))) for _ in range(n)} | {"abc", "abc def", " "})
    values, choices = names(150), names(150)
    want = {}
    for threshold in (75, 90):
        for v in values:
            best = max(((token_set_score(v, c), [-ord(x) for x in c] + [1], c) for c in choices))
            if best[0] >= threshold:
                want[threshold, v] = (best[0], best[2])
    scored, whole = [], resolve.word_set_score
    monkeypatch.setattr(resolve, "word_set_score", lambda *x: scored.append(1) or whole(*x))
    got = {(t, v): (s, c) for t in (75, 90) for v, s, c in resolve.best_choices(values, choices, t)}
    assert got == want and len(scored) < 0.25 * 2 * len(values) * len(choices)


def test_with_leftovers_and_one_partner(spark):
    a = spark.createDataFrame([("1",), ("2",), ("3",)], "IdSS string")
    b = spark.createDataFrame([("x",), ("y",)], "IdSW string")
    m = spark.createDataFrame([("1", "x"), ("2", "x")], "IdSS string, IdSW string")
    pairs = resolve.with_leftovers(resolve.one_partner(m), a, b)
    got = {(r["IdSS"], r["IdSW"]) for r in pairs.collect()}
    assert got == {("1", "x"), ("2", None), ("3", None), (None, "y")}


# -- duplicates ----------------------------------------------------------------

def plain_groups(data, check, keys, thr):
    parent = list(range(len(data)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(data)), 2):
        x, y = data[i], data[j]
        if any(x[k] is not None and y[k] is not None and x[k] != y[k] for k in keys):
            continue
        s = [matching_share(x[c].strip().lower(), y[c].strip().lower()) for c in check if x[c] is not None and y[c] is not None]
        if s and sum(s) / len(s) >= thr:
            parent[find(i)] = find(j)
    groups = {}
    for i, d in enumerate(data):
        groups.setdefault(find(i), []).append(d)
    return groups.values()


@pytest.mark.parametrize("tile", [2000, 8])
def test_merge_duplicates(spark, tile):
    rnd = random.Random(11)
    data = []
    for i in range(80):
        name = rnd.choice(["manchester united", "borussia dortmund", "paris saint germain", "sporting lisbon"])
        if rnd.random() < 0.6:
            at = rnd.randrange(len(name))
            name = name[:at] + rnd.choice("xyz") + name[at + 1:]
        data.append((i, name, rnd.choice([None, "Spain", "France"]), rnd.choice([None, None, "k1", "k2"])))
    data += [(100 + i, "real club deportivo", "Spain", None) for i in range(40)]      # one hot group of copies
    df = spark.createDataFrame(data, "id int, name string, country string, key string")
    got = resolve.merge_duplicates(df, "id", ["name", "country"], ["key"], tile_rows=tile)
    want = set()
    for g in plain_groups(data, (1, 2), (3,), 0.9):
        g = sorted(g)
        first = lambda c: next((r[c] for r in g if r[c] is not None), None)
        want.add((g[0][0], first(1), first(2), first(3), len({r[3] for r in g if r[3]}) > 1))
    assert {tuple(r) for r in got.collect()} == want
    # Three texts of which the country is weak: same groups, fewer candidates.
    wide = df.withColumn("title", F.concat_ws(" ", "name", F.lit("club")))
    wide = wide.withColumn("title", F.when(F.col("id") % 5 != 0, F.col("title")))
    data3 = [(r["id"], r["name"], r["title"], r["country"], r["key"]) for r in wide.select(
        "id", "name", "title", "country", "key").collect()]
    got3 = resolve.merge_duplicates(wide, "id", ["name", "title", "country"], ["key"], weak=["country"], tile_rows=tile)
    ids = {min(r[0] for r in g) for g in plain_groups(data3, (1, 2, 3), (4,), 0.9)}
    assert {r["id"] for r in got3.collect()} == ids
    again = resolve.merge_duplicates(got.drop("conflict"), "id", ["name", "country"], ["key"])
    assert again.count() <= got.count()


def test_connected_components_long_chain(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(200, 201), (201, 200), (300, 300)]
    got = dict(rows(resolve.connected_components(spark.createDataFrame(edges, "src int, dst int")), "node", "component"))
    assert all(got[i] == 0 for i in range(61)) and got[201] == 200 and got[300] == 300


# -- similarity ----------------------------------------------------------------

def vectors(spark, n, groups, seed=2):
    rnd = np.random.default_rng(seed)
    data = [(i, int(i % groups if i % 3 else 0), rnd.normal(size=6).tolist()) for i in range(n)]
    return data, spark.createDataFrame(data, "id int, g int, x array<double>")


def plain_units(data):
    out = {}
    for g in {d[1] for d in data}:
        m = np.array([d[2] for d in data if d[1] == g])
        sd = m.std(0)
        z = np.where(sd > 0, (m - m.mean(0)) / np.where(sd > 0, sd, 1), 0)
        n = np.linalg.norm(z, axis=1, keepdims=True)
        for d, u in zip([d for d in data if d[1] == g], z / np.where(n > 0, n, 1)):
            out[d[0]] = u
    return out


@pytest.mark.parametrize("tile", [4096, 7])
def test_top_similar_and_pairs(spark, tile):
    data, df = vectors(spark, 60, 4)
    u, group = plain_units(data), {d[0]: d[1] for d in data}
    v = sim.feature_vectors(df, "id", "g", ["x"])
    got = sim.top_similar(v, 3, tile_rows=tile).collect()
    for i in u:
        want = sorted(((-round((u[i] @ u[j] + 1) * 50, 6), j) for j in u if j != i and group[j] == group[i]))[:3]
        mine = sorted((r["num"], r["other"]) for r in got if r["id"] == i)
        assert [j for _, j in mine] == [j for _, j in want]
    pairs = {(r["a"], r["b"]): r["similarity"] for r in sim.similarity_pairs(v, 55, tile_rows=tile).collect()}
    want = {(i, j): (u[i] @ u[j] + 1) * 50 for i, j in itertools.combinations(sorted(u), 2)
            if group[i] == group[j] and (u[i] @ u[j] + 1) * 50 >= 55}
    assert pairs == pytest.approx(want)


def test_euclidean_similarity(spark):
    data, df = vectors(spark, 20, 1)
    v = sim.feature_vectors(df, "id", "g", ["x"], scale=False, unit_length=False)
    pairs = {(r["a"], r["b"]): r["similarity"] for r in sim.similarity_pairs(v, 0, metric="euclidean").collect()}
    x = {d[0]: (d[1], np.array(d[2])) for d in data}
    want = {(i, j): 1 / (1 + np.linalg.norm(x[i][1] - x[j][1])) for i, j in itertools.combinations(range(20), 2)
            if x[i][0] == x[j][0]}
    assert pairs == pytest.approx(want)


def test_squad_similarity(spark):
    data, df = vectors(spark, 40, 3)
    u, group = plain_units(data), {d[0]: d[1] for d in data}
    team = {i: i % 4 for i in u}
    v = sim.feature_vectors(df, "id", "g", ["x"]).withColumn("team", F.col("id") % 4)
    pairs = spark.createDataFrame([(i, (team[i] + 1) % 4) for i in u], "player int, team int")
    got = {r["player"]: r["similarity"] for r in sim.squad_similarity(v, pairs).collect()}
    for i in u:
        vals = [(u[p] @ u[q] + 1) * 50 for p in u if team[p] == team[i] and p != i
                for q in u if team[q] == (team[i] + 1) % 4 and group[p] == group[q]]
        assert got[i] == pytest.approx(sum(vals) / len(vals))


def test_cross_similarity_split_lists(spark):
    data, df = vectors(spark, 15, 1)
    v = df.select("id", F.col("x").alias("v"))
    whole = rows(sim.cross_similarity(v, v.filter("id < 9")), "player", "team")
    split = rows(sim.cross_similarity(v, v.filter("id < 9"), max_teams=2), "player", "team")
    assert whole == split and len(whole) == 15 * 9


def test_stars_span_and_flat(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 1.5), ("b", 3.0), ("b", 3.0)], "team string, Score double")
    got = rows(sim.stars(df).filter("team = 'a'"), "Score", "Stars")
    assert got[0] == (1.0, 0.5) and got[-1] == (2.0, 5.0)
    assert all(r["Stars"] is None for r in sim.stars(df).filter("team = 'b'").collect())


# -- windows -------------------------------------------------------------------

def test_pct_rank_against_definition(spark):
    rnd = random.Random(9)
    data = [(i, "g" if i % 3 else "h", rnd.choice([None, -2.5, -1.0, 0.0, 0.001, 0.002, 1.0, 7.0, 1e6])) for i in range(90)]
    df = spark.createDataFrame(data, "id int, part string, x double")
    got = {r["id"]: r["x"] for r in win.pct_rank(df, "part", "id", ["x"], decimals=6).collect()}
    down = {r["id"]: r["x"] for r in win.pct_rank(df, "part", "id", ["x"], ["x"], decimals=6).collect()}
    for i, p, x in data:
        vals = [v for _, q, v in data if q == p and v is not None]
        if x is None:
            assert got[i] is None
            continue
        rank = sum(v < x for v in vals) + (sum(v == x for v in vals) + 1) / 2
        assert got[i] == pytest.approx(rank / len(vals) * 100, abs=1e-6)
        assert down[i] == pytest.approx((len(vals) + 1 - rank) / len(vals) * 100, abs=1e-6)


def test_next_actor_and_index_across_parts(spark):
    rnd = random.Random(4)
    data = [(m, i, rnd.randrange(5) if rnd.random() < 0.8 else None) for m in "ab" for i in rnd.sample(range(500), 60)]
    df = spark.createDataFrame(data, "match string, pos int, player int").repartition(3)
    got = rows(win.next_actor(df, order=("pos",)).fillna(-1), "match", "pos", "next_player")
    idx = rows(win.running_index(df, ["match"], ["pos"]), "match", "pos", "idx")
    for m in "ab":
        seq = sorted((p, w) for k, p, w in data if k == m)
        want = [-1 if w is None else w for _, w in seq[1:]] + [-1]
        assert [r[2] for r in got if r[0] == m] == want
        assert [r[2] for r in idx if r[0] == m] == list(range(60))


def test_pick_lineup_greedy_by_name(spark):
    squad = spark.createDataFrame([("t", 1, "Ann", "ST", 9.0), ("t", 1, "Ann", "LW", 8.0), ("t", 2, "Bea", "LW", 5.0),
                                   ("t", 3, "Cem", "ST", 7.0), ("t", 4, "Ann", "LW", 7.5)],
                                  "Team string, Player int, Name string, Position string, Score double")
    slots = spark.createDataFrame([("t", 0, "ST", 1), ("t", 1, "LW", 1)], "Team string, slot int, Position string, n int")
    assert rows(win.pick_lineup(squad, slots), "slot", "Player") == [(0, 1), (1, 2)]


def test_fill_periods_contiguous(spark):
    df = spark.createDataFrame([(1, dt.date(2025, 1, 7), 2, 5.0), (1, dt.date(2025, 2, 18), 1, 6.0)],
                               "Player int, Period date, PlayedMatches int, MeanRating double")
    got = rows(win.fill_periods(df), "Period", "PlayedMatches", "MeanRating")
    assert [g[1:] for g in got] == [(2, 5.0), (0, 5.0), (0, 5.0), (1, 6.0)]


# -- charts and roles ----------------------------------------------------------

def test_density_field(spark):
    pts = [("a", 10.0, 20.0), ("a", 10.0, 20.0), ("a", 60.0, 80.0), ("b", 5.0, 5.0)]
    got = {(r["key"], r["i"], r["j"]): r["f"] for r in charts.kde_field(
        spark.createDataFrame(pts, "key string, x double, y double"), 12, 8).collect()}
    for k in "ab":
        d = {(i, j): sum(math.exp(-(((i + .5) / 12 * 100 - x) ** 2 + ((j + .5) / 8 * 100 - y) ** 2) / 98)
                         for q, x, y in pts if q == k) for i in range(12) for j in range(8)}
        m = max(d.values())
        for c, v in d.items():
            assert got[(k, *c)] == pytest.approx((v / m) ** 0.85, abs=1e-9)


def test_pca_variance_order_and_null_role(spark):
    rnd = np.random.default_rng(1)
    x = rnd.normal(size=(200, 3)) @ np.array([[3, 1, 0], [0, 1, 0], [0, 0, .2]])
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id int, a double, b double, c double")
    out, explained, loadings = roles.pca_scores(df, ["a", "b", "c"], 3)
    assert list(explained) == sorted(explained, reverse=True) and loadings.shape == (3, 3)
    assert sum(explained) == pytest.approx(1.0)
    centers = spark.createDataFrame([("P", "near", [0.0, 0.0]), ("P", "far", [9.0, 9.0])], "Position string, Role string, center array<double>")
    pl = spark.createDataFrame([(1, "P", 1.0, 1.0), (2, "P", None, 1.0), (3, "Q", 1.0, 1.0)], "Player int, Position string, a double, b double")
    assert rows(roles.assign_role(pl, centers, ["a", "b"]).fillna("-", ["Role"]), "Player", "Role") == [(1, "near"), (2, "-"), (3, "-")]


def test_kmeans_finds_clear_clusters(spark):
    rnd = np.random.default_rng(6)
    pts = [(i, [float(v) for v in rnd.normal(loc=10 * (i % 4), scale=.3, size=2)]) for i in range(120)]
    df = spark.createDataFrame(pts, "id int, v array<double>")
    out, scores, _ = roles.kmeans_select(df, ["v"], 3, 6, starts=3)
    assert max(scores, key=lambda s: s[2])[0] == 4
    by = {}
    for r in out.collect():
        by.setdefault(r["id"] % 4, set()).add(r["Cluster"])
    assert all(len(s) == 1 for s in by.values()) and len(set().union(*by.values())) == 4


# -- keys of duplicate merging ---------------------------------------------------

def test_close_keys_lose_no_pair():
    rnd = random.Random(11)
    for threshold in (0.85, 0.9, 0.95):
        for _ in range(1500):
            letters = rnd.choice(["ab", "abcdef", "0123456789abcdefghij"])
            a = "".join(rnd.choices(letters, k=rnd.randint(1, 40)))
            b = list(a)
            for _ in range(rnd.randint(0, 5)):
                at = rnd.randint(0, len(b))
                b[at:at + rnd.randint(0, 1)] = rnd.choices(letters, k=rnd.randint(0, 1))
            b = "".join(b)
            if b and matching_share(a, b) >= threshold:
                common = {g: rnd.randint(1, 9) for g in (a[:3], "^" + b[:2], b[-3:])}
                assert set(resolve.close_keys(a, threshold, common)) & set(resolve.close_keys(b, threshold, common)), (a, b)


def test_close_keys_hold_few_strangers():
    """Invented names of 17 letters, none like another: hardly any pairs share a key."""
    rnd = random.Random(5)
    names = ["".join(rnd.choices("0123456789abcdef", k=6)) + " mar" + "".join(rnd.choices("0123456789abcdef", k=7)) for _ in range(3000)]
    common = {" ma": 3, "mar": 2, "6 m": 1}
    held = {}
    for n, name in enumerate(names):
        for key in resolve.close_keys(name, 0.9, common):
            held.setdefault(key, []).append(n)
    assert sum(len(h) * (len(h) - 1) // 2 for h in held.values()) < 20 * len(names)


def test_merge_duplicates_with_short_keys(spark):
    """Persons entered three times, one with a letter more: each is one row, found by the few keys of any column."""
    rnd = random.Random(7)
    persons = [("".join(rnd.choices("0123456789abcdef", k=6)), "mar" + "".join(rnd.choices("0123456789abcdef", k=7))) for _ in range(40)]
    data = [(3 * n + i, f"{first} {last}{'s' * (i == 0)}", last + "s" * (i == 0), "n" if i else None)
            for n, (first, last) in enumerate(persons) for i in range(3)]
    df = spark.createDataFrame(data, "id int, name string, short string, nation string")
    got = resolve.merge_duplicates(df, "id", ["name", "short"], ["nation"])
    assert sorted(r["id"] for r in got.collect()) == [3 * n for n in range(40)]
