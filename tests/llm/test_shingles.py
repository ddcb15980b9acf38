"""The pipeline's near-copies against the similarity of all pairs."""

import random

import corpus_pipeline as cp
import pytest
from scoutlake.llm import shingles, simhash

from llm_samples import SF, with_extra


def plain_set(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def groups(texts, least):
    """Smallest member of each text's group, over all pairs."""
    sets, own = [plain_set(t) for t in texts], list(range(len(texts)))

    def find(x):
        while own[x] != x:
            x = own[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a == b or len(a & b) >= least * len(a | b) - 1e-9:
                x, y = sorted((find(i), find(j)))
                own[y] = x
    return [find(i) for i in range(len(texts))]


def edited():
    """Chains of edited copies, pairs between 0.6 and 1 of similarity, and short texts."""
    rng = random.Random(11)
    texts = [None, "", " \n", "one", "One", "two words", "one two three four five", "one two three four five six"]
    for _ in range(40):
        words = [f"w{rng.randrange(500)}" for _ in range(rng.choice([30, 120, 400]))]
        texts.append(" ".join(words))
        for _ in range(rng.choice([1, 2, 6])):
            for _ in range(rng.choice([1, 2, 4, 8]) * len(words) // 200 + 1):
                words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
            texts.append(" ".join(words))
    return texts


@pytest.mark.parametrize("tile", [256, 2])
def test_groups_equal_all_pairs(spark, monkeypatch, tile):
    monkeypatch.setattr(shingles, "TILE", tile)
    texts = edited()
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    root = {r.doc_id: r.root for r in shingles.near_copies(with_extra(frame)).collect()}
    least = {}
    for d in sorted(root):
        least.setdefault(root[d], d)
    want = groups(texts, shingles.LEAST)
    assert [least[root[d]] for d in range(len(texts))] == want
    assert len(set(want)) < len(texts) - 40


def test_stage_drops_edited_copies_and_keeps_others(spark, empty):
    texts = edited()
    frame = with_extra(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    kept = cp.drop_near_copies(spark, frame, SF)
    assert kept.columns == frame.columns and all(r.row == "own row" for r in kept.collect())
    assert {r.doc_id for r in kept.collect()} == set(groups(texts, 0.8))
    assert len(simhash.keep_one(frame).collect()) > kept.count()  # four differing bits miss edited copies
    assert cp.drop_near_copies(spark, with_extra(empty), SF).count() == 0


def test_fingerprint_groups_propose_pairs(spark, monkeypatch):
    """Without a common band, near fingerprints still lead to a pair; the sets decide on it."""
    rng = random.Random(3)
    texts = []
    for n in (400, 600, 800):
        words = [f"w{rng.randrange(10**6)}" for _ in range(n)]
        texts += [" ".join(words), " ".join(words + ["end"])]
    near = [bin(simhash.simhash(a) ^ simhash.simhash(b)).count("1") for a, b in zip(texts[::2], texts[1::2])]
    assert max(near) <= simhash.BITS
    monkeypatch.setattr(shingles, "bands", lambda s: [len(s)])  # another number for each length
    frame = with_extra(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    root = {r.doc_id: r.root for r in shingles.near_copies(frame).collect()}
    assert [root[d] == root[d + 1] for d in (0, 2, 4)] == [True] * 3 and len(set(root.values())) == 3
