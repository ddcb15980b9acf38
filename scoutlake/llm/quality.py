"""Quality verdicts: document statistics, and gradient-boosted trees over them as flat node arrays.

The trees are fitted on at most ``SAMPLE`` labelled documents (second-order boosting of the logistic loss on binned
statistics). For the features in ``MONOTONE`` every split must move the score in the given direction, and the midpoint of
a split bounds what its two sides may predict, so the whole ensemble rises or falls with the feature. A fitted ensemble
is five numpy arrays of nodes (feature, threshold, left, right, value); a batch of documents walks all trees at once,
one level per step.

Defined results: a null or empty text has no words and fails the base rule; repeated rows get equal verdicts; several
labels of one document count as the smallest; without labels of both classes the base rule decides alone; only id and
text of documents and id and quality of labels are read.
"""

from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F

from .common import query, table

SAMPLE = 20_000
TREES, DEPTH, RATE, BINS, LAMBDA, LEAF = 60, 4, 0.2, 64, 1.0, 20
#: A document is kept from this chance of good quality on.
KEEP = 0.5
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MORE = ["mean_word", "symbol_share", "dup_line_share", "repeat_share", "upper_share", "digit_share", "punct_end_share",
        "distinct_share", "stop_share", "bar_share", "log_words", "lines"]
#: Direction in which quality may move with a feature.
MONOTONE = {"symbol_share": -1, "dup_line_share": -1, "repeat_share": -1, "bar_share": -1}
SYMBOLS = "#*$%&|<>"
#: Fixed value: frequent function words of the corpus' languages.
STOPS = frozenset("the of and to in a is that for it was on are with as be by this der die und das von ist nicht ein eine den "
                  "mit la le les et des de un une que pour el los las y en por para con".split())


def statistics(text):
    """Base counts and further statistics of a text, in the order of BASE + MORE."""
    import numpy as np

    text = text or ""
    words = _words(text)
    n = len(words)
    chars = sum(map(len, words))
    symbols = sum(map(text.count, SYMBOLS))
    lines, dup, kept = set(), 0, 0
    for line in text.split("\n"):
        if line.strip(" \t\n\v\f\r"):
            kept += 1
            if line in lines:
                dup += 1
            lines.add(line)
    repeat = 0
    number = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), "i8", n)
    if n >= 3:
        code = (ids[:-2] * len(number) + ids[1:-1])
        code = np.unique(code, return_inverse=True)[1] * np.int64(len(number)) + ids[2:]
        _, back, many = np.unique(code, return_inverse=True, return_counts=True)
        at = many[back] > 1
        mark = np.zeros(n, bool)
        for k in range(3):
            mark[k:n - 2 + k] |= at
        repeat = int(mark.sum())
    d, t = max(n, 1), max(len(text), 1)
    freq = Counter(words)
    more = [chars / d, symbols / d, dup / max(kept, 1), repeat / d,
            sum(c for w, c in freq.items() if w.isupper()) / d, sum(map(text.count, "0123456789")) / t,
            sum(c for w, c in freq.items() if w[-1] in ".!?") / d, len(freq) / d,
            sum(c for w, c in freq.items() if w.lower().strip(".,;:!?") in STOPS) / d, freq["|"] / d, np.log1p(n), kept]
    return [n, chars, symbols, dup, repeat, *map(float, more)]


def _words(text):
    """Runs of characters that are no ASCII white space."""
    for c in "\t\n\v\f\r":
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def bin_edges(x):
    """Upper edges of at most BINS quantile bins per column."""
    import numpy as np

    return [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]


def fit_trees(x, y, directions):
    """Node arrays (feature, threshold, left, right, value, roots) and the base score, by boosting."""
    import numpy as np

    edges = bin_edges(x)
    binned = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T)], axis=1)
    base = float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    score = np.full(len(y), base)
    nodes, roots = [], []  # feature, threshold, left, right, value

    def grow(rows, grad, hess, depth, low, high):
        me = len(nodes)
        g, h = grad[rows].sum(), hess[rows].sum()
        value = float(np.clip(-g / (h + LAMBDA), low, high))
        nodes.append([-1, 0.0, me, me, RATE * value])
        best = (1e-6, None)
        if depth < DEPTH and len(rows) >= 2 * LEAF:
            for f, e in enumerate(edges):
                if not len(e):
                    continue
                size = len(e) + 1
                b = binned[rows, f]
                gl = np.cumsum(np.bincount(b, grad[rows], size))[:-1]
                hl = np.cumsum(np.bincount(b, hess[rows], size))[:-1]
                nl = np.cumsum(np.bincount(b, minlength=size))[:-1]
                left = np.clip(-gl / (hl + LAMBDA), low, high)
                right = np.clip(-(g - gl) / (h - hl + LAMBDA), low, high)

                def gain(gs, hs, w):
                    return -(gs * w + 0.5 * (hs + LAMBDA) * w * w)

                got = gain(gl, hl, left) + gain(g - gl, h - hl, right) - gain(g, h, value)
                got[(nl < LEAF) | (len(rows) - nl < LEAF)] = -1
                if directions[f]:
                    got[(right - left) * directions[f] < 0] = -1
                k = int(got.argmax())
                if got[k] > best[0]:
                    best = (float(got[k]), (f, k, float(left[k]), float(right[k])))
        if best[1] is None:
            score[rows] += RATE * value
            return me
        f, k, left, right = best[1]
        middle = (left + right) / 2
        bounds = {0: ((low, high), (low, high)), 1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}
        to_left = binned[rows, f] <= k
        nodes[me][:2] = [f, float(edges[f][k])]
        nodes[me][2] = grow(rows[to_left], grad, hess, depth + 1, *bounds[directions[f]][0])
        nodes[me][3] = grow(rows[~to_left], grad, hess, depth + 1, *bounds[directions[f]][1])
        return me

    for _ in range(TREES):
        p = 1 / (1 + np.exp(-score))
        roots.append(grow(np.arange(len(y)), p - y, p * (1 - p), 0, -np.inf, np.inf))
    feature, threshold, left, right, value = map(np.array, zip(*nodes))
    return {"feature": feature, "threshold": threshold, "left": left, "right": right, "value": value,
            "roots": np.array(roots), "base": base}


def predict_trees(model, x):
    """Chance of good quality of each row."""
    import numpy as np

    at = np.tile(model["roots"], (len(x), 1))
    row = np.arange(len(x))[:, None]
    for _ in range(DEPTH):  # a leaf points to itself
        f = model["feature"][at]
        at = np.where(x[row, np.maximum(f, 0)] <= model["threshold"][at], model["left"][at], model["right"][at])
    return 1 / (1 + np.exp(-(model["base"] + model["value"][at].sum(axis=1))))


TYPES = ", ".join([f"{c} long" for c in BASE] + [f"{c} double" for c in MORE])


def statistics_of():
    """Struct column of statistics for a frame with a text column."""
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for t in texts:
            yield pd.DataFrame(list(map(statistics, t)), columns=BASE + MORE).astype({c: "int64" for c in BASE})

    return F.pandas_udf(run, TYPES)("text")


def fit(docs, labels, size=SAMPLE):
    """Trees from at most ``size`` labelled documents, None if there is only one class."""
    import numpy as np

    known = labels.select("doc_id", "quality").filter("quality is not null").groupBy(F.col("doc_id").alias("label_id")) \
        .agg(F.min("quality").cast("int").alias("quality")).orderBy(F.xxhash64("label_id"), "label_id").limit(size)
    docs = docs.select("doc_id", "text")
    rows = docs.join(F.broadcast(known), docs["doc_id"] == known["label_id"]) \
        .select("label_id", "quality", statistics_of().alias("s")) \
        .groupBy("label_id").agg(F.min(F.struct("quality", "s")).alias("r")).select("label_id", "r.quality", "r.s.*") \
        .orderBy("label_id").toPandas()  # at most `size` rows of numbers
    y = rows["quality"].to_numpy("f8")
    if not len(rows) or y.min() == y.max():
        return None
    return fit_trees(rows[MORE].to_numpy("f8"), y, [MONOTONE.get(c, 0) for c in MORE])


def judge(docs, model):
    """doc_id, base counts, base_failed, quality and kept of every document."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        import numpy as np

        for x in batches:
            yield pd.Series(predict_trees(model, x[MORE].to_numpy("f8")) if model else np.ones(len(x)))

    with_stats = docs.select("doc_id", statistics_of().alias("s"))
    failed = (F.col("s.n_words") < 50) | (100 * F.col("s.n_repeat_words") > 50 * F.col("s.n_words"))
    return with_stats.select("doc_id", *[F.col(f"s.{c}") for c in BASE], failed.alias("base_failed"),
                             F.pandas_udf(run, "double")("s").alias("quality")) \
        .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= KEEP))


@query("op9_quality_trees")
def op9(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return judge(docs, fit(docs, table(spark, sf, "labels")))
