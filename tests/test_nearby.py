"""Names that are a few letters apart meet by their rests, and few others do."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from scoutlake.functions.text import matching_share, token_set_score
from scoutlake.operators import nearby, resolve
from test_brute_force import people, plain_fuzzy, rows


def edited(rnd, text, letters, most):
    b = list(text)
    for _ in range(rnd.randint(0, most)):
        at = rnd.randint(0, len(b))
        b[at:at + rnd.randint(0, 1)] = rnd.choices(letters, k=rnd.randint(0, 1))
    return "".join(b)


def batch(texts, roles):
    return pd.DataFrame({"field": 0, "role": roles, "value": texts, "seed": np.int64(7)})


def keys_of(texts, roles, threshold, by_word, more):
    lens = []
    for t, role in zip(texts, roles):
        words, size, short = nearby._split(t, by_word)
        lens.append((0, role, tuple(sorted(map(len, words))) if short else (), min(size, nearby.LETTERS + 1), 1))
    cuts, slow, _ = nearby.plan(lens, threshold, by_word)
    at, keys = nearby._batch_keys(batch(texts, roles), {k: sorted(v) for k, v in cuts.items()}, slow, by_word, more)
    return [set(keys[at == i].tolist()) for i in range(len(texts))]


@pytest.mark.parametrize("threshold", [0.85, 0.875, 0.9, 0.95])
def test_similar_word_sets_share_a_key(threshold):
    rnd = random.Random(int(threshold * 1000))
    near = 0
    for _ in range(2500):
        letters = rnd.choice(["ab ", "abcdef ", "0123456789abcdefghij  "])
        a = "".join(rnd.choices(letters, k=rnd.choice([3, 9, 14, 30, 70])))
        b = edited(rnd, a, letters, rnd.choice([2, 6]))
        if rnd.random() < 0.5:
            b = " ".join(rnd.sample(b.split(), len(b.split())))
        if token_set_score(a, b) < 100 * threshold:
            continue
        common = {w: rnd.randint(1, 9) for w in a.split()[:1]}
        grams = {g: rnd.randint(1, 9) for g in (a[:2], "^" + b[:1])}
        one, two = keys_of([a, b], [0, 1], threshold, True,
                           lambda words, role, slow: resolve.word_keys(words, role, slow, threshold, common, grams))
        assert one & two, (a, b)
        near += 1
    assert near > 300


@pytest.mark.parametrize("threshold", [0.85, 0.9])
def test_similar_texts_share_a_key(threshold):
    rnd = random.Random(3)
    near = 0
    for _ in range(2000):
        letters = rnd.choice(["ab ", "0123456789abcdefghij "])
        a = "".join(rnd.choices(letters, k=rnd.choice([1, 5, 12, 17, 30, 80])))
        b = edited(rnd, a, letters, 5)
        if not b or matching_share(a, b) < threshold:
            continue
        one, two = keys_of([a, b], [0, 0], threshold, False,
                           lambda words, role, slow: resolve.close_keys(words[0], threshold, {}) if slow else ())
        assert one & two, (a, b)
        near += 1
    assert near > 300


def test_rests_are_those_of_the_letters():
    a, b = nearby.rests(["abcab", "abxab"], 1)
    assert len(a) == 5 and set(a) & set(b) == {a[2]} and a[2] == b[2]
    assert nearby.rests(["abab"], 0) == nearby.rests(["xabab"], 1)[0, 0]


def hex_names(rnd, n):
    return [f"{rnd.choice(['alba', 'bruno', 'carla'])} mar{rnd.randrange(16 ** 5):05x}" for _ in range(n)]


def test_few_strangers_meet(spark):
    """Without a block 1,500 x 400 names with a common start and first names make few pairs (before: 1 in 12 of all)."""
    rnd = random.Random(1)
    names = [(i, 0, i >= 1500, n) for i, n in enumerate(hex_names(rnd, 1900))]
    df = spark.createDataFrame(names, "ref long, field int, role boolean, value string").withColumn(
        "role", F.col("role").cast("int")).withColumn("seed", F.lit(1).cast("long"))
    pairs, large = resolve.near_pairs(df, 0.9, 4096, others=lambda needed: lambda words, role, slow: resolve.word_keys(
        words, role, slow, 0.9, {"alba": 3, "bruno": 2, "carla": 1}, {}))
    got = {tuple(r) for r in pairs.collect()}
    text = {i: n for i, _, _, n in names}
    want = {(i, j) for i in range(1500) for j in range(1500, 1900) if token_set_score(text[i], text[j]) >= 90}
    assert want <= got and len(got) < len(want) + 200 and large.count() == 0


@pytest.mark.parametrize("thr,block,few", [(75, True, 4096), (75, True, 2), (90, True, 4096), (90, False, 2), (85, False, 4096)])
def test_fuzzy_match_by_keys(spark, monkeypatch, thr, block, few):
    """Blocks of many pairs: the same partners as all pairs of a block, also where many rows share a key."""
    monkeypatch.setattr(resolve, "KEY_PAIRS", few)
    rnd = random.Random(thr + few)
    a, b = people(rnd, 60, "a"), people(rnd, 45, "b")
    a += [("a900", 1, "di the very long of five words " + "x" * 50, "x"), ("a901", 1, "one two three four five", None)]
    b += [("b900", 1, "di the very long of five words " + "x" * 48, "x"), ("b901", 1, "one two three four fives", "  ")]
    da = spark.createDataFrame(a, "IdSS string, blk int, Name string, ShortName string")
    db = spark.createDataFrame(b, "IdSW string, blk int, Name string, ShortName string")
    got = resolve.fuzzy_match(da, db, ["Name", "ShortName"], thr, block="blk" if block else None, tile_rows=12, block_pairs=0)
    assert set(rows(got, "IdSS", "IdSW")) == plain_fuzzy(a, b, thr, block)


def test_merge_duplicates_of_one_long_chain(spark):
    """More rows of a key than are paired, and names of lengths that have no rests, are still one group each."""
    rnd = random.Random(9)
    long = "".join(rnd.choices("abcdefghij ", k=70)).strip()
    data = [(i, f"manchester unite{c}") for i, c in enumerate("abcdefghijklmnop")]
    data += [(100 + i, long[:20 * i] + c + long[20 * i:]) for i, c in enumerate("xyz")] + [(200, "rayo"), (201, ""), (202, None)]
    df = spark.createDataFrame(data, "id int, name string")
    got = resolve.merge_duplicates(df, "id", ["name"], [], tile_rows=6)
    assert sorted(r["id"] for r in got.collect()) == [0, 100, 200, 201, 202]


def test_best_choice_of_many(monkeypatch):
    """Choices without a common word are scored at once: none of them goes through the score of two texts."""
    rnd = random.Random(5)
    values, choices = ({f"mar{rnd.randrange(16 ** 5):05x}" for _ in range(n)} for n in (40, 300))
    scored, whole = [], resolve.word_set_score
    monkeypatch.setattr(resolve, "word_set_score", lambda *x: scored.append(1) or whole(*x))
    got = {v: (s, c) for v, s, c in resolve.best_choices(values, choices, 75)}
    want = {v: min((-token_set_score(v, c), c) for c in choices) for v in values}
    assert got == {v: (-s, c) for v, (s, c) in want.items() if -s >= 75} and len(scored) <= len(values)
