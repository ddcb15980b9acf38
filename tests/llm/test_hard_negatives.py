"""Hard negatives against plain loops, with trees of any size."""

import collections
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from scoutlake.llm import hard_negatives as hn

from llm_samples import SF


def wanted(rows, positives=5, negatives=10):
    far = float("inf")
    rows = {(i, y, tuple(x)) for i, y, x in rows if y is not None and x is not None and None not in x}
    d = max((len(x) for *_, x in rows), default=0)
    rows = [(i, y, x + (0,) * (d - len(x))) for i, y, x in rows]
    rows = list(set(rows))
    out = []
    for i, y, x in rows:
        if i is None or i % 100:
            continue
        scored = sorted((-sum(a * b for a, b in zip(x, v)), far if j is None else j, z == y) for j, z, v in rows if j != i)
        for s, j, _ in [t for t in scored if t[2]][:positives]:
            near = [t for t in scored if not t[2] and 30 * -s <= 100 * -t[0] <= 90 * -s][:negatives]
            out += [(i, None if j == far else j, k + 1, None if t[1] == far else t[1], -s, -t[0]) for k, t in enumerate(near)]
    return collections.Counter(out)


def result(rows):
    got = hn.hard_negatives(rows, F.col("id") % 100 == 0)
    return collections.Counter(tuple(r) for r in got.select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def vectors(n, d, labels, seed, spread=40):
    rng = random.Random(seed)
    centres = [[rng.randint(-spread, spread) for _ in range(d)] for _ in range(labels)]
    out = []
    for i in range(n):
        y = rng.choice([0, 0, 0, *range(labels)])
        c = rng.choice(centres)
        out.append((i * 4, y, [v + rng.randint(-6, 6) for v in c]))
    return out


SCHEMA = "id long, label int, x array<long>, row string, tree string, score string"


@pytest.mark.parametrize("tree, leaf, fan, boxes", [(8192, 256, 8, 1024), (60, 8, 2, 1024), (20, 4, 3, 3)])
def test_whole_result(spark, monkeypatch, tree, leaf, fan, boxes):
    for name, value in (("TREE", tree), ("LEAF", leaf), ("FAN", fan), ("BOXES", boxes)):
        monkeypatch.setattr(hn, name, value)
    rows = vectors(500, 6, 7, 3)
    rows += [(2000, 1, [3] * 6), (2000, 1, [3] * 6), (2100, 1, [3] * 6), (2104, 1, [3] * 6), (2108, 2, [2] * 6), (2112, 2, [2] * 6), (2200, 99, [5] * 6),
             (None, 1, [4] * 6), (None, 2, [2] * 6), (2300, None, [1] * 6), (2400, 1, None), (2500, 1, [1, None, 1, 1, 1, 1]), (2600, 1, []),
             (2700, 1, [9, 9]), (2800, 2, [0] * 6), (-300, 2, [-5] * 6)]
    rows += [(3000 + 4 * i, 3, [1, 2, 3, 4, 5, 6]) for i in range(120)]  # one vector in a fifth of all rows
    df = spark.createDataFrame([(*r, "a", "b", "c") for r in rows], SCHEMA).repartition(3)
    assert result(df) == wanted(rows)


def test_large_numbers(spark):
    rows = [(i, y, [v << 22 for v in x]) for i, y, x in vectors(120, 5, 3, 9, 20)]
    assert result(spark.createDataFrame([(*r, "", "", "") for r in rows], SCHEMA)) == wanted(rows)
    with pytest.raises(ValueError, match="64 bits"):
        hn.Forest(spark.createDataFrame([(1, 1, [2**40])], "id long, label int, x array<long>"))


def test_empty_and_missing(spark):
    assert not result(spark.createDataFrame([], SCHEMA))
    assert not result(spark.createDataFrame([(100, 1, [1, 2], "", "", "")], SCHEMA))


def test_query_takes_only_whole_vectors(spark, tmp_path):
    rows = [(i * 20, i % 3, [float(i % 7) / 3, -0.5 * (i % 5), 1.25]) for i in range(60)]
    odd = [(7, None, [1.0, 1.0, 1.0]), (14, 1, None), (21, 1, [float("nan"), 1.0, 1.0]), (28, 1, [float("inf"), 1.0, 1.0]), (35, 1, [None, 1.0, 1.0])]
    spark.createDataFrame(rows + odd, "vec_id long, embedding_label int, embedding array<float>") \
        .withColumnRenamed("embedding_label", "label").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = collections.Counter(tuple(r) for r in hn.op13(spark, str(tmp_path)).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())
    scaled = [(i, (y + 1) % 10 if i % 7 == 0 else y, np.floor(256 * np.array(x, "f4").astype("f8")).astype(int).tolist()) for i, y, x in rows]
    assert got and got == wanted(scaled)


def test_boxes_are_left_out(monkeypatch):
    """On far-apart groups the queue opens few leaves."""
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.integers(-5, 6, (256, 8)) + c for c in rng.integers(-400, 400, (64, 8))])
    tree = hn.Tree(np.arange(len(x)), np.zeros(len(x), "i8"), x, "f8")
    seen = []

    class Watched(np.ndarray):
        def __getitem__(self, at):
            if isinstance(at, slice):
                seen.append(at)
            return np.asarray(super().__getitem__(at))

    plain, tree.x = tree.x, tree.x.view(Watched)
    a = plain[:1]
    least, most, none = ([np.array([v])] for v in (-hn.FAR, hn.FAR, -hn.FAR))
    (_, _, score, found), = tree.search(np.array([-1]), np.zeros(1, "i8"), a, least, most, none, 5, True)
    assert score.tolist() == sorted((plain @ a[0]).astype(int), reverse=True)[:5] and len(found) == 5
    assert 0 < len(seen) <= 8 < len(tree.leaf) - 1


def test_oracle_agrees_on_the_smallest_table(spark):
    assert hn.op13(spark, SF).count() > 0
