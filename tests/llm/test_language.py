"""Language scores of whole texts against a plain loop over the words."""

import math
import random

import numpy as np
import pytest

from scoutlake.llm import language


def plain(text, model, langs):
    """Language and score by one word after the other."""
    known, parts, matrix = model
    total, n = np.zeros(len(langs)), 0
    for word in language.words(text or ""):
        if word in known:
            got = matrix[known[word]].astype("f8")
        else:
            got = np.zeros(len(langs))
            for step, size in enumerate((5, 4, 3, 2, 1)):
                marked = f" {word} " if size > 1 else word
                found = [parts[marked[i:i + size]] for i in range(len(marked) - size + 1) if marked[i:i + size] in parts]
                if found:
                    got = matrix[found].astype("f8").mean(axis=0) * 0.8 ** step
                    break
        total += got - got.mean()
        n += 1
    if not n:
        return "und", 0.0
    return langs[int(total.argmax())], 1 / np.exp((total - total.max()) / math.sqrt(n)).sum()


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(5)
    stems = {"aa": ["kolo", "mira", "tesu"], "bb": ["grund", "schaf", "licht"], "cc": ["ñandu", "οδός", "x" * 60]}
    rows = [(" ".join(rng.choice(stems[k]) + rng.choice(["", "n", "ta"]) for _ in range(30)), k) for k in stems for _ in range(20)]
    langs = sorted(stems)
    return language.fit(spark.createDataFrame(rows, "text string, lang string").repartition(3), langs), langs


@pytest.mark.parametrize("memo", [150_000, 3])
def test_scores_equal_the_loop(spark, model, monkeypatch, memo):
    monkeypatch.setattr(language, "MEMO", memo)
    model, langs = model
    rng = random.Random(6)
    parts = ["kolo", "Mira,", "grund-licht", "schafe.", "ÑANDU", "ΟΔΟΣ", "Σ", "12", "_", "it's", "\n", "\t", " ", "zz", "q", "kolota" * 3, "x" * 60, "İ"]
    texts = [" ".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(300)] + [None, "", "123 !", "x" * 60]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(4)
    for r in df.select("doc_id", language.predict(spark, model, langs).alias("p")).collect():
        lang, score = plain(texts[r.doc_id], model, langs)
        assert math.isclose(r.p.score, score, rel_tol=1e-6, abs_tol=1e-9), texts[r.doc_id]
        assert r.p.lang_pred == lang or score < 0.5, texts[r.doc_id]


def test_long_words_are_known(model):
    known, parts, _ = model[0]
    assert "x" * 60 in known and language.word_rows("x" * 60, known, parts)[1] == 1.0


def test_nothing_seen_is_left_out(spark):
    rows = [(" ".join(f"word{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(600)), "aa")] * 3
    known, _, matrix = language.fit(spark.createDataFrame(rows, "text string, lang string"), ["aa"])
    assert len(known) == 600 and len(matrix) > 600
