"""Similarity of players and teams, squad similarity and fit scores.

Rows are compared in tiles of bounded size around pivots.  A row goes to another
tile of its group only if, by the triangle inequality, that tile may hold a row as
similar as its n-th best so far or as the threshold; only the best few or the
pairs over a threshold leave a tile.
"""

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, functions as F

from ..config import lookups as lk
from ..config.weights import FIT_WEIGHTS
from ..functions.numeric import _col, age_whole, clip, round_even
from ..session import materialize
from .shape import const_map, one_hot, to_team_rows
from .windows import impute_group_mean, last_n

TILE_ROWS = 4096
#: Pivots over all groups at most: they are sent to every task.
PIVOTS = 4096
#: Rows that are compared with a tile at a time.
COMPARED = 512


def dot(a, b):
    return F.aggregate(F.zip_with(_col(a), _col(b), lambda x, y: x * y), F.lit(0.0),
                       lambda s, x: s + x)


def unit(a):
    """Vector of length 1; a zero vector stays zero."""
    a = _col(a)
    norm = F.sqrt(dot(a, a))
    return F.transform(a, lambda x: F.coalesce(F.try_divide(x, norm), F.lit(0.0)))


def feature_vectors(df, id_col, group, cols, scale=True, weights=None, unit_length=True):
    """Vector per row: z-scores with the group's population deviation, weights, unit length.

    With ``scale``, a column that has one value in a group, or a null or NaN in any row of it, is left out
    there and stays in elsewhere, so the length of a vector depends on its group.  The group's moments, ends
    and null counts are one aggregate row per group, joined back.  Without ``scale`` nulls are 0.
    """
    group_col = F.col(group) if isinstance(group, str) else group
    if len(cols) == 1 and df.schema[cols[0]].dataType.typeName() == "array":
        raw = F.col(cols[0]).cast("array<double>")
    else:
        raw = F.array(*[F.col(c).cast("double") for c in cols])
    rows = df.select(F.col(id_col).alias("id"), group_col.alias("grp"),
                     F.transform(raw, lambda x: F.when(~F.isnan(x), x)).alias("v"))
    if weights:
        w = F.array(*[F.lit(float(weights.get(c, 1.0))) for c in cols])
    if scale:
        rows = rows.join(column_masks(rows), "grp").select(
            "id", "grp", "_keep", F.zip_with(F.zip_with("v", "_m", lambda x, m: x - m), "_d",
                                             lambda x, d: F.try_divide(x, d)).alias("v"))
        if weights:
            rows = rows.withColumn("v", F.zip_with("v", w, lambda x, y: x * y))
        rows = rows.select("id", "grp", F.filter("v", lambda x, i: F.get("_keep", i)).alias("v"))
    else:
        rows = rows.withColumn("v", F.transform("v", lambda x: F.coalesce(x, F.lit(0.0))))
        if weights:
            rows = rows.withColumn("v", F.zip_with("v", w, lambda x, y: x * y))
    return rows.withColumn("v", unit("v")) if unit_length else rows


def column_masks(rows):
    """Per group the means, population deviations and whether each place of ``v`` varies and is never null.

    ``rows`` has (grp, v).  Columns grp, _m, _d, _keep: one aggregate, whatever the number of columns.
    """
    filled = array_to_vector(F.transform("v", lambda x: F.coalesce(x, F.lit(0.0))))
    missing = array_to_vector(F.transform("v", lambda x: F.when(x.isNull(), 1.0).otherwise(0.0)))
    moments = rows.groupBy("grp").agg(
        Summarizer.metrics("mean", "variance", "count", "min", "max").summary(filled).alias("s"),
        Summarizer.sum(missing).alias("nulls"))
    shrink = (F.col("s.count") - 1) / F.col("s.count")
    varies = F.zip_with(vector_to_array("s.min"), vector_to_array("s.max"), lambda lo, hi: lo < hi)
    deviation = F.transform(vector_to_array("s.variance"), lambda x: F.sqrt(x * shrink))
    ends = moments.select("grp", vector_to_array("s.mean").alias("_m"), deviation.alias("_d"), varies.alias("_varies"),
                          vector_to_array("nulls").alias("_nulls"))
    # Values so close that their deviation is rounding alone are one value.
    keep = F.zip_with(F.zip_with("_varies", "_nulls", lambda x, n: x & (n == 0)), "_d", lambda x, d: x & (d > 1e-12))
    return ends.select("grp", "_m", "_d", keep.alias("_keep"))


def _similarities(a, b, metric):
    if metric == "cosine":
        return np.clip(a @ b.T, -1.0, 1.0)
    return 1.0 / (1.0 + _distances(a, b))


def _distances(a, b):
    gap = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T)
    return np.sqrt(np.maximum(gap, 0.0))


def _percent(values, metric):
    return (values + 1.0) / 2.0 * 100.0 if metric == "cosine" else values


def _nearest(score, metric):
    """Largest distance at which two rows can have a score; vectors of a cosine are no longer than 1."""
    if metric == "cosine":
        return np.sqrt(np.maximum(0.0, 4.0 - score / 25.0))
    return 1.0 / np.maximum(score, 1e-300) - 1.0


class Tiling:
    """Rows of groups in tiles around pivots, for exact comparison without all pairs.

    A group of more than ``tile_rows`` rows gets a pivot for as many, drawn by hash, at most ``PIVOTS`` over all
    groups, so the pivots can be sent to every task.  A row belongs to its nearest pivot; what is still too many
    rows is divided by hash.  By the triangle inequality no row of a tile is nearer than the distance to its pivot
    less the tile's radius, so a tile that cannot hold a score as good as wanted is never compared.
    """

    def __init__(self, vectors, tile_rows=TILE_ROWS, pivots=PIVOTS):
        self.spark = vectors.sparkSession
        self.types = {c: vectors.schema[c].dataType.simpleString() for c in ("id", "grp")}
        sizes = materialize(vectors.groupBy("grp").agg(F.count("*").alias("n")), "group-sizes")
        total = sizes.agg(F.sum("n")).first()[0] or 0
        share = max(tile_rows, -(-total // pivots))
        large = sizes.filter(F.col("n") > share)  # at most ``pivots`` groups
        self.pivots = self.spark.sparkContext.broadcast(self._drawn(vectors, large, share))
        placed = self._placed(vectors)
        of = placed.groupBy("grp", "pivot").agg(F.count("*").alias("n"), F.max("far").alias("radius"))
        of = materialize(of.select("grp", "pivot", F.ceil(F.col("n") / tile_rows).cast("int").alias("subs"), "radius"), "tile-sizes")
        sub = F.pmod(F.xxhash64("id"), F.col("subs")).cast("int")
        self.rows = placed.join(of, ["grp", "pivot"]).select("grp", "pivot", sub.alias("sub"), "id", "v")
        self.tiles = self.spark.sparkContext.broadcast(
            {(r["grp"], r["pivot"]): (r["subs"], r["radius"]) for r in
             of.join(large.select("grp"), "grp", "left_semi").collect()})  # a pivot each
        self.single = not self.tiles.value and not of.filter("subs > 1").limit(1).count()
        if not self.single:
            self.rows = materialize(self.rows, "tiled")

    def _drawn(self, vectors, large, share):
        """{group: matrix of its pivots}."""
        key = F.xxhash64(F.lit("pivot"), "id")
        some = vectors.join(large, "grp").withColumn("k", F.ceil(F.col("n") / share)) \
            .filter(F.pmod(key, F.col("n")) < 2 * F.col("k") + 8).select("grp", "k", key.alias("h"), "v")
        found = {}
        for r in sorted(some.collect(), key=lambda r: r["h"]):  # about two for each pivot
            own = found.setdefault(r["grp"], [])
            if len(own) < r["k"] and r["v"] not in own:
                own.append(r["v"])
        return {g: np.array(v, dtype="float64") for g, v in found.items()}

    def _placed(self, vectors):
        """Rows with their nearest pivot (0 in a group without) and the distance to it."""
        pivots = self.pivots

        def place(batches):
            for pdf in batches:
                pdf["pivot"], pdf["far"] = 0, 0.0
                for g, at in pdf.groupby("grp", sort=False, dropna=False).indices.items():
                    own = pivots.value.get(g)
                    if own is not None:
                        gap = _distances(np.array(pdf["v"].iloc[at].tolist(), dtype="float64"), own)
                        near = gap.argmin(axis=1)
                        pdf.iloc[at, pdf.columns.get_loc("pivot")] = near
                        pdf.iloc[at, pdf.columns.get_loc("far")] = gap[np.arange(len(at)), near]
                yield _plain(pdf)

        if not pivots.value:
            return vectors.select("id", "grp", "v", F.lit(0).alias("pivot"), F.lit(0.0).alias("far"))
        schema = f"id {self.types['id']}, grp {self.types['grp']}, v array<double>, pivot int, far double"
        return vectors.select("id", "grp", "v").mapInPandas(place, schema)

    def sent(self, metric, least, later=False):
        """Rows beside the other tiles of their group that may hold a row with a score of ``least`` (a column) or more.

        ``later``: only tiles behind the row's own, for pairs that are wanted once.
        """
        pivots, tiles = self.pivots, self.tiles

        def send(batches):
            for pdf in batches:
                out = []
                for g, at in pdf.groupby("grp", sort=False, dropna=False).indices.items():
                    own = pivots.value.get(g)
                    part = pdf.iloc[at]
                    subs = [tiles.value.get((g, p), (0, 0.0)) for p in range(len(own) if own is not None else 0)] \
                        or [(int(part["subs"].iloc[0]), 0.0)]
                    reach = _nearest(part["least"].to_numpy() - 1e-5, metric)
                    gap = _distances(np.array(part["v"].tolist(), dtype="float64"), own) if own is not None else np.zeros((len(at), 1))
                    fits = gap - np.array([r for _, r in subs]) <= reach[:, None] + 1e-9
                    for p, (many, _) in enumerate(subs):
                        for k in range(many):
                            mine = (part["pivot"] == p) & (part["sub"] == k)
                            ok = fits[:, p] & ~mine.to_numpy()
                            if later:
                                ok &= ((part["pivot"] < p) | ((part["pivot"] == p) & (part["sub"] < k))).to_numpy()
                            if ok.any():
                                out.append(part[ok].assign(pivot=p, sub=k)[["grp", "pivot", "sub", "id", "v", "least"]])
                if out:
                    yield _plain(pd.concat(out))

        subs = self.rows.groupBy("grp").agg((F.max("sub") + 1).alias("subs"))  # of groups without pivots
        asked = self.rows.join(least, ["grp", "id"]) if not isinstance(least, Column) else self.rows.withColumn("least", least)
        schema = f"grp {self.types['grp']}, pivot int, sub int, id {self.types['id']}, v array<double>, least double"
        return asked.join(subs, "grp").mapInPandas(send, schema)

    def own(self, fn, schema):
        """Frames that ``fn(grp, ids, matrix, ids, matrix, None)`` yields for each tile with itself."""
        key = ["grp", "pivot", "sub"]

        def compared(held):
            pdf = pd.concat(held).sort_values("id")
            ids, v = pdf["id"].to_numpy(), np.array(pdf["v"].tolist(), dtype="float64")
            for found in fn(pdf["grp"].iloc[0], ids, v, ids, v, None):
                if len(found):
                    yield _plain(found)

        def run(batches):
            held, at = [], None
            for pdf in batches:
                for k, part in pdf.groupby(key, sort=False):
                    if held and k != at:
                        yield from compared(held)
                        held = []
                    at = k
                    held.append(part)
            if held:
                yield from compared(held)

        parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        rows = self.rows.select(*key, "id", "v").repartition(parts, *key).sortWithinPartitions(*key)
        return rows.mapInPandas(run, schema)

    def others(self, sent, fn, schema):
        """Frames that ``fn(grp, ids, matrix, ids of the tile, its matrix, least)`` yields for sent rows, in batches, and the tile they came to."""
        own = self.rows.select("grp", "pivot", "sub", F.lit(0).alias("kind"), "id", "v", F.lit(None).cast("double").alias("least"))
        come = sent.select("grp", "pivot", "sub", F.lit(1).alias("kind"), "id", "v", "least")
        key = ["grp", "pivot", "sub"]

        def run(batches):
            held, at = [], None
            for pdf in batches:
                for k, part in pdf.groupby([*key, "kind"], sort=False, dropna=False):
                    if k[:3] != at:
                        held, at = [], k[:3]
                    if k[3] == 0:
                        held.append(part)
                    elif held:
                        if len(held) > 1 or isinstance(held[0], pd.DataFrame):
                            tile = pd.concat(held).sort_values("id")
                            held = [(tile["id"].to_numpy(), np.array(tile["v"].tolist(), dtype="float64"))]
                        for found in fn(k[0], part["id"].to_numpy(), np.array(part["v"].tolist(), dtype="float64"), *held[0],
                                        part["least"].to_numpy()):
                            if len(found):
                                yield _plain(found)

        return own.unionByName(come).repartition(*key).sortWithinPartitions(*key, "kind").mapInPandas(run, schema)


def _plain(pdf):
    """Texts as Python strings, so that what is put together from parts is one Arrow array; nothing at all for no rows."""
    if not len(pdf):
        return pd.DataFrame()
    return pdf.astype({c: object for c in pdf.columns if pdf[c].dtype.kind not in "ifb"})


def _first_n(score, n):
    """Row and column of the n best finite scores of each row, equal ones by column."""
    if score.shape[1] > n:
        cut = -np.partition(-score, n - 1, axis=1)[:, n - 1]
        row, col = np.nonzero((score >= cut[:, None]) & np.isfinite(score))
    else:
        row, col = np.nonzero(np.isfinite(score))
    order = np.lexsort((col, -score[row, col], row))
    row, col = row[order], col[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    return row[place < n], col[place < n]


def top_similar(vectors, n=50, metric="cosine", tile_rows=TILE_ROWS, published=None, decimals=6):
    """The n most similar rows of the same group for each row, numbered from 1.

    Values equal to ``decimals`` places rank by id.  ``published`` (a frame with ``id``) limits both sides before
    the ranking.  Each row is compared with its own tile first; its n-th best score there is what another tile must
    be able to reach.
    """
    if published is not None:
        vectors = vectors.join(published.select("id").distinct(), "id", "left_semi")
    tiling = Tiling(vectors, tile_rows)

    def best(grp, ids, a, others, b, least):
        for at in range(0, len(ids), COMPARED):
            part = slice(at, at + COMPARED)
            sims = _percent(_similarities(a[part], b, metric), metric)
            if least is None:
                sims[np.arange(len(sims)), np.arange(at, at + len(sims))] = -np.inf
            ranked = np.round(sims, decimals)
            if least is not None:
                ranked[ranked < least[part, None]] = -np.inf
            row, col = _first_n(ranked, n)
            yield pd.DataFrame({"grp": [grp] * len(row), "id": ids[part][row], "other": others[col], "similarity": sims[row, col]})

    schema = f"grp {tiling.types['grp']}, id {tiling.types['id']}, other {tiling.types['id']}, similarity double"
    rank = [round_even("similarity", decimals).desc(), F.col("other")]
    found = tiling.own(best, schema)
    if not tiling.single:
        found = materialize(found, "own-tiles")
        nth = last_n(found, ["grp", "id"], rank, n, "num").filter(F.col("num") == n) \
            .select("grp", "id", round_even("similarity", decimals).alias("nth"))
        least = tiling.rows.select("grp", "id").join(nth, ["grp", "id"], "left") \
            .select("grp", "id", F.coalesce("nth", F.lit(-1.0)).alias("least"))
        found = found.unionByName(tiling.others(tiling.sent(metric, least), best, schema))
    return last_n(found, ["id"], rank, n, "num")


def similarity_pairs(vectors, min_percent, metric="cosine", tile_rows=TILE_ROWS):
    """Unordered pairs of a group at or over a similarity, each once with a < b, and the number of places of their vectors.

    A task gives its pairs away after each ``COMPARED`` rows.
    """
    tiling = Tiling(vectors, tile_rows)

    def pairs(grp, ids, a, others, b, least):
        for at in range(0, len(ids), COMPARED):
            sims = _percent(_similarities(a[at:at + COMPARED], b, metric), metric)
            hit = sims >= min_percent
            if least is None:
                hit &= np.arange(len(b)) > np.arange(at, at + len(sims))[:, None]
            r, c = np.nonzero(hit)
            x, y = ids[at + r], others[c]
            yield pd.DataFrame({"grp": [grp] * len(r), "a": np.minimum(x, y), "b": np.maximum(x, y), "similarity": sims[r, c],
                                "columns": b.shape[1]})

    schema = f"grp {tiling.types['grp']}, a {tiling.types['id']}, b {tiling.types['id']}, similarity double, columns long"
    found = tiling.own(pairs, schema)
    if not tiling.single:
        found = found.unionByName(tiling.others(tiling.sent(metric, F.lit(float(min_percent)), later=True), pairs, schema))
    return found


def similarity_features(matches, stats, players, season, as_of, metrics, min_minutes=500):
    """Season aggregates with profile, age and one-hot categories, ready for vectors."""
    from .aggregate import aggregate_entity, player_metrics, ratio_names
    from ..config.metrics import LOCATION_COLUMNS, PLAYER_METRICS
    rows = to_team_rows(matches.filter(F.col("Season").cast("string") == str(season)),
                        home_elo="HomeElo", away_elo="AwayElo")
    rows = rows.select("Match", "Team", "Score", F.col("OpponentScore").alias("OppScore"), "Elo",
                       F.col("OpponentElo").alias("OppElo"))
    joined = stats.drop("ShirtNumber", "Position").join(rows, ["Match", "Team"])
    means = {c: "mean" for c in LOCATION_COLUMNS + ["Elo", "OppElo"]}
    agg = aggregate_entity(joined, "Player", means,
                           drop=["Match", "Team", *ratio_names(PLAYER_METRICS), "Rating"])
    agg = player_metrics(agg)
    info = players.select(F.col("ID").alias("Player"), "DateBirth", "Height", "PrefFoot",
                          "Position", "Role").dropna(subset=["DateBirth", "Height", "PrefFoot"])
    general = F.coalesce(F.try_element_at(const_map(lk.GENERAL_POSITION), F.col("Position")),
                         F.lit("Goalkeeper"))
    df = agg.filter(F.col("MinutesPlayed") >= min_minutes).join(info, "Player")
    df = df.withColumns({"Age": age_whole("DateBirth", as_of), "GeneralPos": general,
                         "Role": F.concat_ws(" - ", "Position", "Role"),
                         "_pos": F.col("Position")})
    numeric = ["Age", "Height", *[m for m in metrics if m in df.columns]]
    df = impute_group_mean(df, "_pos", numeric)
    df = df.select("Player", F.col("GeneralPos").alias("grp"), *numeric, "PrefFoot", "Position", "Role")
    return one_hot(df, ["PrefFoot", "Position", "Role"])


def team_features(context, season_stats, min_matches=5):
    """Goals and Elo context, season aggregates and one-hot formation; nulls 0."""
    df = context.join(season_stats.filter(F.col("Matches") >= min_matches), "Team")
    df = one_hot(df, ["Formation"])
    return df.fillna(0.0)


def team_similarity(features, n=50, tile_rows=TILE_ROWS):
    """Most similar teams, all teams in one group."""
    cols = [c for c in features.columns if c != "Team"]
    vectors = feature_vectors(features.withColumn("_g", F.lit(0)), "Team", "_g", cols)
    return top_similar(vectors, n, tile_rows=tile_rows)


def cross_similarity(players, teams, max_teams=1024):
    """Cosine of every player vector with the vectors of a bounded set of teams.

    ``teams`` is a top-k list; its size is checked.  The team vectors ride along
    as one array, so a player stays one row until the scores are exploded.  A
    larger team list is cut into lists of that size by hash and joined by list
    number.
    """
    total = teams.count()
    lists = max(1, -(-total // max_teams))
    packed = teams.select(F.pmod(F.xxhash64("id"), F.lit(lists)).alias("_l"),
                          F.struct(F.col("id").alias("team"), unit("v").alias("v")).alias("_t"))
    packed = packed.groupBy("_l").agg(F.collect_list("_t").alias("_ts"))
    numbers = F.sequence(F.lit(0).cast("long"), F.lit(lists - 1).cast("long"))
    rows = players.select(F.col("id").alias("player"), unit("v").alias("_u"),
                          F.explode(numbers).alias("_l"))
    rows = rows.join(packed, "_l").select("player", "_u", F.explode("_ts").alias("_t"))
    return rows.select("player", F.col("_t.team").alias("team"),
                       dot("_u", F.col("_t.v")).alias("similarity"))


def squad_sums(members):
    """Sum of unit vectors and number of players per (team, group)."""
    return members.groupBy("team", "grp").agg(
        vector_to_array(Summarizer.sum(array_to_vector("v"))).alias("s"), F.count("*").alias("n"))


def squad_similarity(members, pairs, exclude_self=True):
    """Mean similarity percent between a player's squad and another, for (player, team) pairs.

    ``members`` has (id, team, grp, v) with unit vectors; only players of a
    common group are compared.  The mean of all dot products is the product of
    the vector sums, so squads are compared without making player pairs, and a
    player is left out of his own squad by subtracting his share.
    """
    sums = squad_sums(members)
    a = sums.select(F.col("team").alias("own"), "grp", F.col("s").alias("sa"), F.col("n").alias("na"))
    b = sums.select("team", "grp", F.col("s").alias("sb"), F.col("n").alias("nb"))
    wanted = pairs.join(members.select(F.col("id").alias("player"), F.col("team").alias("own"), "grp",
                                       F.col("v").alias("u")), "player")
    whole = (wanted.select("own", "team").distinct().join(a, "own").join(b, ["team", "grp"])
             .groupBy("own", "team").agg(F.sum(dot("sa", "sb")).alias("_dot"),
                                         F.sum(F.col("na") * F.col("nb")).alias("_n")))
    out = wanted.join(whole, ["own", "team"])
    if exclude_self:
        out = out.join(b, ["team", "grp"], "left")
        out = out.withColumns({
            "_dot": F.col("_dot") - F.coalesce(dot("u", "sb"), F.lit(0.0)),
            "_n": F.col("_n") - F.coalesce("nb", F.lit(0))})
    mean = F.try_divide(F.col("_dot"), F.col("_n"))
    return out.select("player", "team", ((mean + 1) / 2 * 100).alias("similarity"))


def same_position_similarity(vectors, pairs, mates):
    """Mean similarity percent of a player with the players of a team in his positions.

    ``mates`` has (player set key, team, grp, s, n): sums of unit vectors; see
    :func:`position_sets`.
    """
    own = vectors.select(F.col("id").alias("player"), "grp", F.col("v").alias("u"))
    out = pairs.join(own, "player").join(mates, ["posset", "team", "grp"], "left")
    mean = F.try_divide(dot("u", "s"), F.col("n"))
    return out.select("player", "team", ((mean + 1) / 2 * 100).alias("similarity"))


def position_sets(players, possets, vectors):
    """Vector sums per (position set, team, group) of the players sharing a position."""
    mates = position_mates(players, possets)
    return (mates.join(vectors.select("id", "grp", "v"), "id").groupBy("posset", "team", "grp")
            .agg(vector_to_array(Summarizer.sum(array_to_vector("v"))).alias("s"),
                 F.count("*").alias("n")))


def position_mates(players, possets):
    """(position set, team, id) of the players who share a position with the set.

    There are at most as many sets as ways to choose three of nine positions.
    """
    flat = players.select("id", "team", F.explode("positions").alias("pos"))
    wanted = possets.select("posset", F.explode(F.split("posset", ",")).alias("pos"))
    return flat.join(wanted, "pos").select("posset", "team", "id").distinct()


def heat_cells(points, key, x="IniX", y="IniY", nx=24, ny=16):
    """Number of points per key and grid cell over [0, 100] squared, right edge closed."""
    keys = [key] if isinstance(key, str) else list(key)
    inside = F.col(x).between(0, 100) & F.col(y).between(0, 100)
    cell = (F.least(F.floor(F.col(x) * nx / 100), F.lit(nx - 1)) * ny
            + F.least(F.floor(F.col(y) * ny / 100), F.lit(ny - 1)))
    return points.filter(inside).groupBy(*keys, cell.cast("int").alias("cell")).agg(
        F.count("*").alias("n"))


def heatmap_corr(cells_a, cells_b, pairs, key_a="a", key_b="b", size=24 * 16):
    """Pearson correlation of two heat maps over all cells, from sums of the filled ones."""
    def moments(cells, key, tag):
        return cells.groupBy(key).agg(F.sum("n").cast("double").alias("s" + tag),
                                      F.sum(F.col("n") * F.col("n")).cast("double").alias("q" + tag))

    wanted = pairs.select(key_a, key_b).distinct()
    both = (wanted.join(cells_a.withColumnRenamed("n", "na"), key_a)
            .join(cells_b.withColumnRenamed("n", "nb"), [key_b, "cell"])
            .groupBy(key_a, key_b).agg(F.sum(F.col("na") * F.col("nb")).cast("double").alias("p")))
    out = (wanted.join(moments(cells_a, key_a, "a"), key_a).join(moments(cells_b, key_b, "b"), key_b)
           .join(both, [key_a, key_b], "left").fillna(0.0, ["p"]))
    cov = size * F.col("p") - F.col("sa") * F.col("sb")
    var = ((size * F.col("qa") - F.col("sa") * F.col("sa"))
           * (size * F.col("qb") - F.col("sb") * F.col("sb")))
    return out.select(key_a, key_b, F.try_divide(cov, F.sqrt(var)).alias("corr"))


# Measures of a (player, team) pair and how they enter the score.
PERCENT = ["TeamsCorrelation", "SquadsCorrelation", "SamePosCorrelation", "PassesCorrelation"]
UNIT = ["FormationsMatch", "TournamentsMatch", "CountryMatch", "StatsCorrelation"]
GAP = ["TimestampDiff", "EloRatingDiff", "RatingDiff", "PotentialDiff"]


def candidate_pairs(players, teams):
    """(player, team) rows of a candidate list and a team list, own team left out.

    Every player is scored for every team, so the caller bounds the two lists (top-k) as far as scores are wanted.
    A join, not an exploded list: Spark then knows how many pairs there are and sends none of what is made of them
    through the driver.  Only the team ids are broadcast.
    """
    rows = players.select("player", "own").join(F.broadcast(teams.select("team")), F.col("own") != F.col("team"))
    return rows.select("player", "own", "team")


def fit_measures(pairs, players, teams, team_sim, squad_sim, pos_sim, pass_corr, style_sim,
                 tiers=None, families=None):
    """Twelve compatibility measures per (player, team); pairs lacking a required one are dropped.

    ``players`` has one row per player (country, formations, competitions, birth
    seconds, rating, potential, own team Elo), ``teams`` one per team (country,
    countries of the squad, formations, competitions, means, Elo).
    """
    from .shape import overlap_flag
    tiers = lk.COMPETITION_TIER if tiers is None else tiers
    families = lk.FORMATION_FAMILY if families is None else families
    # Sides with a row for each pair or player compress well, and Spark would take small files for small tables: the
    # hint keeps them from being broadcast.  Pairs meet while the rows are narrow and share one partitioning.
    df = pairs
    for side, name in ((squad_sim, "SquadsCorrelation"), (pos_sim, "SamePosCorrelation"), (style_sim, "StatsCorrelation")):
        df = df.join(side.withColumnRenamed("similarity", name).hint("merge"), ["player", "team"])
    df = df.join(pass_corr.hint("merge"), ["player", "team"], "left")
    df = df.join(team_sim.select(F.col("id").alias("own"), F.col("other").alias("team"),
                                 F.col("similarity").alias("TeamsCorrelation")), ["own", "team"])
    df = df.join(players.hint("merge"), "player").join(F.broadcast(teams), "team")  # one row for each team
    country = (F.when(F.col("country") == F.col("team_country"), 1.0)
               .when(F.array_contains("team_countries", F.col("country")), 0.5).otherwise(0.0))
    df = df.select(
        "player", "team", "TeamsCorrelation", "SquadsCorrelation",
        overlap_flag("formations", "team_formations", families).alias("FormationsMatch"),
        overlap_flag("competitions", "team_competitions", tiers).alias("TournamentsMatch"),
        country.alias("CountryMatch"), "SamePosCorrelation", "PassesCorrelation",
        (F.col("team_birth") - F.col("birth")).alias("TimestampDiff"),
        (F.col("team_elo") - F.col("own_elo")).alias("EloRatingDiff"),
        (F.col("team_rating") - F.col("rating")).alias("RatingDiff"),
        (F.col("team_potential") - F.col("potential")).alias("PotentialDiff"),
        "StatsCorrelation")
    return df.dropna(subset=["TeamsCorrelation", "SquadsCorrelation", "SamePosCorrelation",
                             "StatsCorrelation", "RatingDiff", "PotentialDiff", "EloRatingDiff",
                             "TimestampDiff"])


def fit_score(df, weights=None, team="team", percent=PERCENT, units=UNIT, gaps=GAP):
    """Weighted mean of the measures; gaps are inverted min-max per team, unknown ones 0.5.

    The per-team limits are one aggregate row per team, joined back.
    """
    weights = FIT_WEIGHTS if weights is None else weights
    limits = df.groupBy(team).agg(*[f(F.abs(F.col(c))).alias(f"_{t}_{c}") for c in gaps
                                    for t, f in (("lo", F.min), ("hi", F.max))])
    df2 = df.join(F.broadcast(limits), team)
    parts = {c: clip(F.col(c) / 100, 0, 1) for c in percent}
    parts.update({c: clip(F.col(c), 0, 1) for c in units})
    for c in gaps:
        lo, hi = F.col(f"_lo_{c}"), F.col(f"_hi_{c}")
        parts[c] = 1 - F.try_divide(F.abs(F.col(c)) - lo, hi - lo)
    total = sum(float(weights.get(c, 0.0)) for c in parts)
    score = sum((float(weights.get(c, 0.0)) * F.coalesce(e, F.lit(0.5)) for c, e in parts.items()),
                F.lit(0.0)) / total
    return df2.select(*df.columns, score.alias("Score"))


def stars(df, team="team", score="Score"):
    """Score min-max per team to 0.5-5 in half steps; null where all scores are equal."""
    limits = df.groupBy(team).agg(F.min(score).alias("_lo"), F.max(score).alias("_hi"))
    scaled = F.try_divide(F.col(score) - F.col("_lo"), F.col("_hi") - F.col("_lo"))
    half = (scaled * 9 + 1) / 2
    return df.join(F.broadcast(limits), team).withColumn("Stars", round_even(half * 2) / 2).drop("_lo", "_hi")


def fit_documents(scores, names, chunk=None):
    """Per-team map player -> {Player, Name, Score, Stars}."""
    from .aggregate import collect_map
    rows = scores.join(names.select(F.col("ID").alias("player"), "Name").hint("merge"), "player", "left")
    value = F.struct(F.col("player").alias("Player"), "Name", "Score", "Stars")
    return collect_map(rows, "team", "PlayersAdaptability", "player", value, chunk)
