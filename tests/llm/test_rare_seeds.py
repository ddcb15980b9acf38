"""Rare seeds lose no alignment: the same leaks as plain alignment of every text with every item."""

import random

import numpy as np
import pytest

from scoutlake.llm import decontaminate

from test_whole_inputs import found, plain_score


def edited(words, rng, most):
    """A copy with words changed, dropped and added."""
    out = []
    for w in words:
        roll = rng.random()
        if roll < most / 3:
            continue
        out.append("zz" if roll < 2 * most / 3 else w)
        if roll > 1 - most / 3:
            out.append("yy")
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_same_leaks_as_plain_alignment(spark, seed):
    rng = random.Random(seed)
    common, odd = ["of", "the", "and", "to", "in"], [f"word{i}" for i in range(60)]
    items = [[rng.choice(common if rng.random() < 0.6 else odd) for _ in range(rng.choice([2, 3, 5, 6, 8, 12, 20, 40]))] for _ in range(25)]
    items += [["of", "the"] * 8, ["of"] * 12]
    texts = []
    for _ in range(250):
        item = rng.choice(items)
        around = [[rng.choice(common + odd) for _ in range(rng.randint(0, 12))] for _ in range(2)]
        texts.append(" ".join(around[0] + edited(item, rng, rng.choice([0, 0.15, 0.3, 0.5])) + around[1]))
    want = {(i, k) for i, t in enumerate(texts) for k, item in enumerate(items) if plain_score(t.split(), item) >= 0.6 - 1e-9}
    got = found(spark, texts, [" ".join(x) for x in items])
    assert set(got) == want and len(want) > 100
    for (i, k), score in got.items():
        assert score == pytest.approx(plain_score(texts[i].split(), items[k]))


def test_common_pairs_are_no_seeds():
    words = [["of", "the", *[f"{c}{i}" for c in "abcdefghijkl"], "of", "the"] for i in range(20)]
    block = list(enumerate(words))
    known = {w: k for k, w in enumerate(sorted({w for x in words for w in x}))}
    pairs = decontaminate.item_pairs(block, known)
    lengths = np.array([len(w) for w in words])
    seeds = decontaminate.rare_seeds(pairs, lengths)
    of, the = known["of"], known["the"]
    assert of * len(known) + the not in seeds and known["a0"] * len(known) + known["b0"] in seeds
    assert decontaminate.needed(np.array([6, 10, 15, 30])).tolist() == [1, 1, 2, 5]
    for k, w in enumerate(words):  # of the pairs' places no more than need - 1 are left out
        own = pairs[0][pairs[1] == k]
        assert len(w) - 1 - np.isin(own, seeds).sum() == 2 == decontaminate.needed(np.array([len(w)]))[0] - 1
