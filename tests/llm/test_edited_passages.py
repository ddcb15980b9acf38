"""Edited benchmark passages are found whatever else the corpus holds."""

import random

import pytest
from scoutlake.llm import decontaminate

from test_operators import smith_waterman


def edited(item, rng):
    """Copies with each fourth word changed, a word put after each second one, and random edits."""
    out = [[f"z{i}" if i % 4 == 3 else w for i, w in enumerate(item)],
           [x for i, w in enumerate(item) for x in ([w, "zz"] if i % 2 else [w])],
           [x for w in item for x in (w, "zz")][:-1]]
    for _ in range(4):
        words = list(item)
        for _ in range(rng.randint(1, max(1, len(item) // 3))):
            at = rng.randrange(len(words))
            words[at:at + 1] = rng.choice([[], ["zy"], [words[at], "zx"]])
        out.append(words)
    return out


@pytest.mark.parametrize("filler", [0, 60_000])
def test_all_alignments_are_found(spark, filler):
    rng = random.Random(12)
    common = [f"c{i}" for i in range(30)]
    items = [[rng.choice(common) if rng.random() < 0.7 else f"r{rng.randrange(300)}" for _ in range(n)]
             for n in (3, 3, 4, 4, 5, 5, 6, 7, 8, 10, 12, 15, 15, 20, 40)]
    docs = [" ".join(["q1"] * 70 + words + ["q2"] * 70) for item in items for words in edited(item, rng)]
    frame = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    if filler:  # much more text made of the items' common words
        more = [(10_000 + i, " ".join(rng.choices(common, k=200))) for i in range(filler // 200)]
        frame = frame.unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.score for r in decontaminate.leaks(frame, bench).collect() if r.doc_id < 10_000}
    want, number = {}, {}
    for d, text in enumerate(docs):
        words = [number.setdefault(w, len(number)) for w in text.split() if w not in ("q1", "q2")]
        for k, item in enumerate(items):
            score = smith_waterman(words, [number.setdefault(w, len(number)) for w in item])
            if score >= 1.2 * len(item):
                want[d, k] = score / (2 * len(item))
    assert want == got and len(want) > 60
