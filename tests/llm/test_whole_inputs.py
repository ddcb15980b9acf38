"""Nothing is lost to a bound: long names, mails and words, short items, few labels, null and shared ids."""

import collections
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from scoutlake.llm import common, decontaminate, pii, quality, token_counts, token_files, toxicity
from scoutlake.llm.tokens import public_path

from llm_samples import SF


def found(spark, texts, items):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {(r.doc_id, r.item_id): r.score for r in decontaminate.leaks(docs, bench).collect()}


def plain_score(words, item):
    """Smith-Waterman by the textbook, as a share of the item's best score."""
    row, best = [0] * (len(item) + 1), 0
    for w in words:
        new = [0]
        for j, x in enumerate(item):
            new.append(max(0, row[j] + (2 if w == x else -1), row[j + 1] - 1, new[j] - 1))
        row, best = new, max(best, *new)
    return best / (2 * len(item))


def test_short_items_are_found_like_by_plain_alignment(spark):
    rng = random.Random(3)
    words = ["rare", "pair", "very", "odd", "x"]
    items = ["rare pair", "pair pair", "odd", "rare odd x", "x rare x odd"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 7))) for _ in range(300)] + ["rare very pair", "pair", ""]
    want = {(i, k) for i, t in enumerate(texts) for k, item in enumerate(items) if plain_score(t.split(), item.split()) >= 0.6 - 1e-9}
    got = found(spark, texts, items)
    assert set(got) == want
    assert got[300, 0] == 0.75


def test_long_names_and_mails_leave_nothing(spark):
    name, local = "Abcdefghij" * 6 + "Tail", "a.b-" * 40 + "anna"
    texts = [f"Mr. {name} came", f"write to {local}@{'mail' * 30}.example.org now", "-" * 90 + "anna@mail.org", "a--b..anna@mail.org",
             "x" * 300 + "@mail.org", "a.a." * 20_000, "1-2." * 20_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r.doc_id: r.text for r in pii.replace_pii(docs).collect()}
    assert "Tail" not in out[0] and "Abcdefghij" not in out[0]
    for i in (1, 2, 3, 4):
        assert "anna@" not in out[i] and "mail.org" not in out[i] and "x@" not in out[i] and "example.org" not in out[i], out[i]
    assert out[5] == texts[5] and out[6] == texts[6]


def test_long_words_are_terms():
    long = "w" * 5_000
    assert long + "$" in toxicity.terms(f"a {long} b")
    trie = toxicity.build_trie([long + "$", "short$"])
    assert toxicity.match_words([long, long[1:], long[3:], "shor"], trie) == {
        long: [(long + "$", 0)], long[1:]: [(long + "$", 1)], "shor": [("short$", 1)]}


def test_few_toxic_labels_still_teach(spark):
    """So few toxic documents that one half of the sample has none."""
    rng = random.Random(1)
    plain = [f"plain{c}" for c in "abcdefghijklmnop"]
    docs = [(i, " ".join(rng.sample(plain, 8)) + (" grobian" if i < 8 else "")) for i in range(200)]
    rows = spark.createDataFrame(docs, "doc_id long, text string").withColumn("toxic", (F.col("doc_id") < 8).cast("int"))
    worth, _ = toxicity._learn(rows.select("text", "toxic", F.lit(1).alias("half")), {0: 192, 1: 8})
    assert any(e.startswith("grob") for e in worth), worth
    one = toxicity.learn_lexicon(rows.filter("toxic = 0").select("text", "toxic"), {0: 192})
    assert one == ({}, 1.0)


def test_a_sample_of_quality_is_one_row_for_each_label(spark, monkeypatch):
    rng = random.Random(2)
    text = [" ".join(rng.choice(["a", "fine", "word", "12", "##"]) for _ in range(60)) for _ in range(12)]
    docs = spark.createDataFrame([(i % 12, text[i % 12], "x", 1) for i in range(600)], "doc_id long, text string, quality string, label_id long")
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)], "doc_id long, quality int")
    seen = []
    fit_trees = quality.fit_trees
    monkeypatch.setattr(quality, "fit_trees", lambda x, y, m: seen.append(len(y)) or fit_trees(x, y, m))
    model = quality.fit(docs, labels, size=10)
    assert seen == [10] and model is not None
    assert {r.kept for r in quality.judge(docs, model).filter("not base_failed").collect()} <= {True, False}
    assert quality.fit(docs, labels.filter("quality = 1")) is None


@pytest.mark.parametrize("limits", [(0, 1, 3, 4, 100)])
def test_any_limit_and_share(spark, limits):
    lengths = [0, 0, 2, 3, 3, 3, 7, 40]
    h = spark.createDataFrame([(k, n) for k, n in collections.Counter(lengths).items()], "length long, n_docs long")
    totals = token_counts.context_totals(h)
    for r in token_counts.at_limits(totals, limits).collect():
        own = [x for x in lengths if x >= r.length]
        assert (r.n_docs, r.docs_at_least, r.tokens_at_least) == (lengths.count(r.length), len(own), sum(own))
        assert r.tokens_cut_here == sum(min(x, r.length) for x in lengths)
        assert r.share_up_to == sum(x <= r.length for x in lengths) / len(lengths)
    shares = {r.share: r.length for r in token_counts.at_shares(totals, (0.25, 0.5, 0.9, 1.0)).collect()}
    assert shares == {0.25: 0, 0.5: 3, 0.9: 40, 1.0: 40}
    none = token_counts.context_totals(h.limit(0))
    assert not token_counts.at_limits(none, limits).count() and not token_counts.at_shares(none, (0.5,)).count()


def test_benchmark_rows_go_by_id_and_text(spark):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").filter("length(text) > 60").first().text
    docs = spark.createDataFrame([(None, f"see {item}"), (1, f"see {item}"), (1, "a clean text that shares the id"), (None, "clean"), (2, None)],
                                 "doc_id long, text string")
    left = cp.drop_benchmark(spark, docs, SF).collect()
    assert collections.Counter((r.doc_id, r.text) for r in left) == collections.Counter(
        [(1, "a clean text that shares the id"), (None, "clean"), (2, None)])


def test_token_files_take_a_path_without_scheme(spark, documents, tmp_path):
    assert common.qualified(spark, str(tmp_path)) == f"file://{tmp_path}"
    files = token_files.write_token_files(documents, str(tmp_path / "own"), public_path("byte_bpe_50k.json"))
    assert all(r.path.startswith("file:///") for r in files.collect())
    assert token_files.read_token_files(files).count() == documents.count()
