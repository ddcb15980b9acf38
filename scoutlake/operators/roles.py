"""Playing roles: components, clusters, centroids and the nearest role.

The functions by group fit all groups (positions) at once: components from one aggregate of the groups' product
matrices, and k-means with the centre sets of all groups, numbers of clusters and starts in every pass over the
rows, so the number of jobs grows with the passes alone.
"""

import math
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.numeric import round_even
from ..session import materialize
from .similarity import column_masks, dot

AT_ONCE = 8


def to_vectors(df, cols, out="features"):
    """Assemble numeric columns, or convert one array column, to a vector column; the rows must have all values."""
    if len(cols) == 1 and df.schema[cols[0]].dataType.typeName() == "array":
        return df.withColumn(out, array_to_vector(F.col(cols[0]).cast("array<double>")))
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="error").transform(df)


def _complete(df, cols):
    """Rows with all values, and the rest."""
    ok = F.lit(True)
    for c in cols:
        kind = df.schema[c].dataType.typeName()
        known = F.col(c).isNotNull()
        ok = ok & (known & ~F.isnan(c) if kind in ("double", "float") else known)
    return df.filter(ok), df.filter(~ok)


def pca_scores(df, cols, k=5):
    """Standardise by the population deviation, then the first k principal components.

    Returns the frame with a ``scores`` array (null where a value is missing), the
    explained shares and the loadings.  The covariance is one distributed pass;
    only a square matrix of the columns comes back.
    """
    whole, rest = _complete(df, cols)
    vectors = to_vectors(whole, cols)
    scaler = StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True)
    scaled = scaler.fit(vectors).transform(vectors)
    model = PCA(k=k, inputCol="scaled", outputCol="pca").fit(scaled)
    n = whole.count()
    widen = math.sqrt(n / (n - 1)) if n > 1 else 1.0        # the scaler divides by the sample deviation
    out = model.transform(scaled).withColumn("scores", F.transform(vector_to_array("pca"), lambda x: x * widen))
    out = out.drop("features", "scaled", "pca").unionByName(rest.withColumn("scores", F.lit(None).cast("array<double>")))
    return out, model.explainedVariance.toArray(), model.pc.toArray()


def _best_starts(vectors, ks, starts, seed):
    """For each k the cheapest of several k-means fits; the fits are short chains of small jobs, so several run at a time."""
    @inheritable_thread_target(vectors.sparkSession)
    def fit(task):
        k, s = task
        model = KMeans(k=k, seed=seed + s, featuresCol="features", predictionCol="Cluster").fit(vectors)
        return model.summary.trainingCost, model

    with ThreadPool(AT_ONCE) as pool:
        found = pool.map(fit, [(k, s) for k in ks for s in range(starts)], chunksize=1)
    return {k: min(found[i * starts:(i + 1) * starts], key=lambda f: f[0])[1] for i, k in enumerate(ks)}


def kmeans_select(df, cols, k_min=3, k_max=6, starts=20, seed=42):
    """K-means for each k, the best of several starts by cost, the best k by silhouette (ties: fewer clusters).

    The silhouette uses squared Euclidean distance.  Returns the clustered frame
    (rows with a missing value have a null cluster), (k, cost, silhouette) per k
    and the chosen model.
    """
    whole, rest = _complete(df, cols)
    vectors = to_vectors(whole, cols).cache()
    try:
        if not 2 <= k_min <= k_max < vectors.count():
            raise ValueError(f"k from {k_min} to {k_max} needs at least 2 clusters and more rows than clusters")
        silhouette = ClusteringEvaluator(featuresCol="features", predictionCol="Cluster")
        models = _best_starts(vectors, range(k_min, k_max + 1), starts, seed)
        quality = {k: float(silhouette.evaluate(m.transform(vectors))) for k, m in models.items()}
        chosen = models[max(quality, key=lambda k: (quality[k], -k))]
        out = chosen.transform(vectors).drop("features").unionByName(rest.withColumn("Cluster", F.lit(None).cast("int")))
        return out, [(k, float(m.summary.trainingCost), quality[k]) for k, m in models.items()], chosen
    finally:
        vectors.unpersist()


def _whole(v):
    return F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x))


def pca_by_group(rows, k=5):
    """Standardised scores on the first k principal components of each group.

    ``rows`` has (id, grp, v); vectors of a group have one length, which may differ between groups.  Rows with a
    missing value have null scores and do not count; a column without variation in its group counts 0.  A
    component's largest loading is positive.  Returns (id, grp, scores) and (grp, explained, loadings).

    The standardised products are summed per task and group, so a group's matrix is all that is shuffled; the
    eigenvectors of each group are found where its matrix is.
    """
    grp = rows.schema["grp"].dataType.simpleString()
    whole = rows.filter(_whole("v") & (F.size("v") > 0))
    z = F.zip_with(F.zip_with("v", "_m", lambda x, m: x - m), F.arrays_zip("_d", "_keep"),
                   lambda x, d: F.when(d["_keep"], F.try_divide(x, d["_d"])).otherwise(0.0))
    scaled = materialize(whole.join(column_masks(whole), "grp").select("id", "grp", z.alias("z")), "scaled")

    def products(batches):
        sums = {}
        for pdf in batches:
            for g, at in pdf.groupby("grp", sort=False).indices.items():
                x = np.array(pdf["z"].iloc[at].tolist(), dtype="float64")
                n, total = sums.get(g, (0, 0.0))
                sums[g] = n + len(x), total + x.T @ x
        for g, (n, total) in sums.items():
            yield pd.DataFrame({"grp": [g], "n": [n], "products": [total.ravel()]})

    def components(pdf):
        products = np.array(pdf["products"].iloc[0], dtype="float64")
        d = math.isqrt(len(products))
        share, axes = np.linalg.eigh(products.reshape(d, d) / pdf["n"].iloc[0])
        share, axes = share[::-1], axes[:, ::-1]
        axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(d)])
        first = min(k, d)
        total = share.sum()
        return pd.DataFrame({"grp": [pdf["grp"].iloc[0]], "explained": [(share[:first] / (total if total > 0 else 1.0)).tolist()],
                             "loadings": [axes[:, :first].T.tolist()]})

    parts = scaled.select("grp", "z").mapInPandas(products, f"grp {grp}, n long, products array<double>")
    sums = parts.groupBy("grp").agg(F.sum("n").alias("n"), vector_to_array(Summarizer.sum(array_to_vector("products"))).alias("products"))
    axes = materialize(sums.groupBy("grp").applyInPandas(
        components, f"grp {grp}, explained array<double>, loadings array<array<double>>"), "components")
    scores = scaled.join(axes, "grp").select("id", "grp", F.transform("loadings", lambda a: dot("z", a)).alias("scores"))
    rest = rows.filter(~F.coalesce(_whole("v") & (F.size("v") > 0), F.lit(False)))
    return scores.unionByName(rest.select("id", "grp", F.lit(None).cast("array<double>").alias("scores"))), axes


def _seeds(x, k, rng):
    """k-means++: centres drawn far from those before."""
    centres = [x[rng.integers(len(x))]]
    far = ((x - centres[0]) ** 2).sum(1)
    while len(centres) < k:
        total = far.sum()
        centres.append(x[rng.choice(len(x), p=far / total) if total > 0 else rng.integers(len(x))])
        far = np.minimum(far, ((x - centres[-1]) ** 2).sum(1))
    return np.array(centres)


class _Sets:
    """Centres of all sets of a group in one matrix; a set is a (k, start) with k clusters."""

    def __init__(self, ks, centres):
        self.ks, self.centres = list(ks), centres
        self.starts = np.concatenate([[0], np.cumsum(self.ks)])

    def nearest(self, x):
        """Number of the nearest centre of each set for each row, and the squared distance."""
        gap = (x * x).sum(1)[:, None] + (self.centres ** 2).sum(1)[None, :] - 2.0 * (x @ self.centres.T)
        gap = np.maximum(gap, 0.0)
        near = np.stack([gap[:, a:b].argmin(axis=1) + a for a, b in zip(self.starts, self.starts[1:])], axis=1)
        return near, np.take_along_axis(gap, near, axis=1)

    def only(self, sets):
        return _Sets([self.ks[i] for i in sets], np.concatenate([self.centres[self.starts[i]:self.starts[i + 1]] for i in sets]))


def _passes(rows, grp, sets):
    """Per (group, centre): rows, their sum, squares and cost, from one pass; {group: arrays}."""
    sent = rows.sparkSession.sparkContext.broadcast(sets)  # a group has at most (k, start) sets of k centres

    def run(batches):
        held = {}
        for pdf in batches:
            for g, at in pdf.groupby("grp", sort=False).indices.items():
                x = np.array(pdf["v"].iloc[at].tolist(), dtype="float64")
                own = sent.value[g]
                near, gap = own.nearest(x)
                sums = held.setdefault(g, [np.zeros(len(own.centres)), np.zeros(own.centres.shape), np.zeros(len(own.centres)), np.zeros(len(own.centres))])
                squares = (x * x).sum(1)
                for j in range(near.shape[1]):
                    c = near[:, j]
                    sums[0] += np.bincount(c, minlength=len(own.centres))
                    sums[2] += np.bincount(c, squares, minlength=len(own.centres))
                    sums[3] += np.bincount(c, gap[:, j], minlength=len(own.centres))
                    np.add.at(sums[1], c, x)
        for g, (n, total, squares, cost) in held.items():
            yield pd.DataFrame({"grp": [g], "stats": [np.concatenate([n, squares, cost, total.ravel()])]})

    parts = rows.select("grp", "v").mapInPandas(run, f"grp {grp}, stats array<double>")
    found = parts.groupBy("grp").agg(vector_to_array(Summarizer.sum(array_to_vector("stats"))).alias("s")).collect()
    out = {}
    for r in found:
        s, c = np.array(r["s"]), len(sets[r["grp"]].centres)
        out[r["grp"]] = s[:c], s[3 * c:].reshape(c, -1), s[c:2 * c], s[2 * c:3 * c]
    return out


def _silhouettes(rows, grp, sets, stats):
    """Mean silhouette by squared Euclidean distance of each set of each group, from one pass; {group: [value]}."""
    sent = rows.sparkSession.sparkContext.broadcast((sets, stats))

    def run(batches):
        held = {}
        for pdf in batches:
            for g, at in pdf.groupby("grp", sort=False).indices.items():
                x = np.array(pdf["v"].iloc[at].tolist(), dtype="float64")
                own, (n, total, squares, _) = sent.value[0][g], sent.value[1][g]
                near, _ = own.nearest(x)
                size = np.maximum(n, 1.0)
                mean = (x * x).sum(1)[:, None] + squares / size - 2.0 * (x @ (total / size[:, None]).T)
                mean[:, n == 0] = np.inf
                out = held.setdefault(g, np.zeros(near.shape[1] + 1))
                for j, (a, b) in enumerate(zip(own.starts, own.starts[1:])):
                    c = near[:, j]
                    inside = mean[np.arange(len(x)), c] * n[c] / np.maximum(n[c] - 1, 1)
                    other = mean[:, a:b].copy()
                    other[np.arange(len(x)), c - a] = np.inf
                    outside = other.min(axis=1)
                    top = np.maximum(inside, outside)
                    with np.errstate(invalid="ignore", divide="ignore"):
                        value = np.where(np.isfinite(outside) & (n[c] > 1) & (top > 0), (outside - inside) / top, 0.0)
                    out[j] += value.sum()
                out[-1] += len(x)
        for g, values in held.items():
            yield pd.DataFrame({"grp": [g], "s": [values]})

    parts = rows.select("grp", "v").mapInPandas(run, f"grp {grp}, s array<double>")
    found = parts.groupBy("grp").agg(vector_to_array(Summarizer.sum(array_to_vector("s"))).alias("s")).collect()
    return {r["grp"]: np.array(r["s"][:-1]) / r["s"][-1] for r in found}


def kmeans_by_group(rows, k_min=3, k_max=6, starts=20, seed=42, passes=20, sample=2000):
    """Clusters of each group: for each k the cheapest of several starts, then the k of the best silhouette (ties: fewer).

    ``rows`` has (id, grp, v).  Starts are drawn from at most ``sample`` rows of a group, chosen by hash; every pass
    counts all rows for the sets of all groups at once, until no centre moves or ``passes`` are done.  A group gets
    no more clusters than it has different rows in the sample.  Returns (id, grp, Cluster), null for a row with a
    missing value, and {grp: [(k, cost, silhouette)]}.
    """
    if not 2 <= k_min <= k_max:
        raise ValueError(f"k from {k_min} to {k_max} needs at least 2 clusters")
    spark, grp = rows.sparkSession, rows.schema["grp"].dataType.simpleString()
    known = F.coalesce(_whole("v") & (F.size("v") > 0), F.lit(False))
    whole = materialize(rows.filter(known), "points")
    order = Window.partitionBy("grp").orderBy(F.xxhash64("id"), "id")
    some = whole.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= sample).select("grp", "_r", "v")

    def draw(pdf):
        x = np.array(pdf.sort_values("_r")["v"].tolist(), dtype="float64")
        most = len(np.unique(x, axis=0))
        rng = np.random.default_rng(seed)
        own = [(k, _seeds(x, k, rng)) for k in range(k_min, k_max + 1) if k <= most for _ in range(starts)] or [(1, x[:1])]
        return pd.DataFrame({"grp": [pdf["grp"].iloc[0]] * len(own), "k": [k for k, _ in own],
                             "centres": [c.ravel() for _, c in own]})

    sets = {}
    for r in some.groupBy("grp").applyInPandas(draw, f"grp {grp}, k int, centres array<double>").collect():
        sets.setdefault(r["grp"], []).append((r["k"], np.array(r["centres"]).reshape(r["k"], -1)))
    sets = {g: _Sets([k for k, _ in own], np.concatenate([c for _, c in own])) for g, own in sets.items()}
    for _ in range(passes):
        stats, moved = _passes(whole, grp, sets), False
        for g, (n, total, _, _) in stats.items():
            new = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], sets[g].centres)
            moved |= bool((np.abs(new - sets[g].centres) > 1e-9).any())
            sets[g] = _Sets(sets[g].ks, new)
        if not moved:
            break
    cost = {g: np.add.reduceat(s[3], sets[g].starts[:-1]) for g, s in _passes(whole, grp, sets).items()}
    best = {g: [min((i for i, x in enumerate(own.ks) if x == k), key=lambda i: (cost[g][i], i)) for k in sorted(set(own.ks))]
            for g, own in sets.items()}
    sets = {g: own.only(best[g]) for g, own in sets.items()}
    stats = _passes(whole, grp, sets)
    quality = _silhouettes(whole, grp, sets, stats)
    tried = {g: [(k, float(cost[g][i]), float(q)) for k, i, q in zip(sets[g].ks, best[g], quality[g])] for g in sets}
    chosen = spark.sparkContext.broadcast({g: own.only([int(np.argmax(np.round(quality[g], 12)))]) for g, own in sets.items()})

    def assign(batches):
        for pdf in batches:
            pdf["Cluster"] = 0
            for g, at in pdf.groupby("grp", sort=False).indices.items():
                near, _ = chosen.value[g].nearest(np.array(pdf["v"].iloc[at].tolist(), dtype="float64"))
                pdf.iloc[at, pdf.columns.get_loc("Cluster")] = near[:, 0]
            yield pdf[["id", "grp", "Cluster"]]

    schema = f"id {rows.schema['id'].dataType.simpleString()}, grp {grp}, Cluster int"
    out = whole.select("id", "grp", "v").mapInPandas(assign, schema)
    rest = rows.filter(~known).select("id", "grp", F.lit(None).cast("int").alias("Cluster"))
    return out.unionByName(rest), tried


def name_roles(df, names=None, order=(), position="Position", cluster="Cluster", out="Role"):
    """Role of each (position, cluster): clusters numbered by the mean sum of the ``order`` columns, smallest first.

    ``names`` {position: [name, ...]} gives names by that number; a number without a name is "Role n".
    """
    known = {p: list(r) for p, r in (names or {}).items()}
    total = sum((F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in order), F.lit(0.0))
    means = df.filter(F.col(cluster).isNotNull()).groupBy(position, cluster).agg(F.avg(total).alias("_mean"))
    number = F.row_number().over(Window.partitionBy(position).orderBy("_mean", cluster))
    name = F.concat(F.lit("Role "), number.cast("string"))
    if known:
        table = F.create_map(*[x for p, r in known.items() for x in (F.lit(p), F.array(*[F.lit(n) for n in r]))])
        name = F.coalesce(F.get(F.try_element_at(table, F.col(position)), number - 1), name)
    return df.join(means.select(position, cluster, name.alias(out)), [position, cluster], "left")


def role_centroids(df, cols, position="Position", role="Role"):
    """Mean of each metric per position and role, six decimals, as one array per role."""
    means = df.filter(F.col(role).isNotNull()).groupBy(position, role).agg(
        *[round_even(F.avg(c), 6).alias(c) for c in cols])
    return means.select(position, role, F.array(*cols).alias("center"))


def role_centroids_of_vectors(rows, position="Position", role="Role"):
    """Mean vector per group and role, six decimals; ``rows`` has (grp, Role, v) and vectors of one length per group."""
    each = rows.filter(F.col("Role").isNotNull()).select("grp", "Role", F.posexplode("v").alias("at", "x"))
    means = each.groupBy("grp", "Role", "at").agg(round_even(F.avg("x"), 6).alias("x"))
    return means.groupBy(F.col("grp").alias(position), F.col("Role").alias(role)).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("at", "x"))), lambda c: c["x"]).alias("center"))


def assign_role(df, centroids, cols, key="Player", position="Position", role="Role"):
    """Nearest role of the player's position; a null metric gives a null role.

    Roles of a position are gathered into one short array, so each player stays
    one row and no pair rows are made.
    """
    roles = centroids.groupBy(position).agg(F.array_sort(F.collect_list(
        F.struct(F.col(role).alias("r"), F.col("center").alias("c")))).alias("_roles"))
    point = F.array(*[F.col(c).cast("double") for c in cols])
    known = F.forall(point, lambda x: x.isNotNull() & ~F.isnan(x))

    def distance(center):
        squares = F.zip_with(F.col("_p"), center, lambda x, y: (x - y) * (x - y))
        return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda a, x: a + x))

    out = df.select(key, position, point.alias("_p"), known.alias("_known")).join(
        roles, position, "left")
    near = F.array_min(F.transform("_roles", lambda r: F.struct(
        distance(r["c"]).alias("d"), r["r"].alias("r"))))
    return out.select(key, position, F.when(F.col("_known"), near["r"]).alias(role),
                      F.when(F.col("_known"), near["d"]).alias("Distance"))
