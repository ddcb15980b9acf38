"""The pipeline against its operators, stage by stage, and on odd input."""

import corpus_pipeline as cp
from scoutlake.llm import decontaminate, packing, pii, shingles, toxicity
from scoutlake.llm.common import table
from scoutlake.llm.tokens import public_path

from llm_samples import SF, with_extra


def test_stages(spark, documents, empty):
    docs = with_extra(documents)
    ids = None
    for name, stage in cp.STAGES:
        out = stage(spark, docs, SF)
        if name != cp.STAGES[-1][0]:
            assert out.columns == docs.columns, name
            out = out.cache()
        if name == "toxicity":
            bad = {r.doc_id for r in docs.select("doc_id", toxicity.toxic_score(docs, table(spark, SF, "labels")).alias("s")).collect()
                   if r.s >= 0.5}
            assert {r.doc_id for r in out.collect()} == {r.doc_id for r in docs.collect()} - bad
        elif name == "near_dedup":
            assert out.count() == shingles.near_copies(docs).select("root").distinct().count()
        elif name == "decontamination":
            leaked = {r.doc_id for r in decontaminate.leaks(docs, table(spark, SF, "benchmark")).collect()}
            assert leaked and {r.doc_id for r in out.collect()} == {r.doc_id for r in docs.collect()} - leaked
            ids = {r.doc_id for r in out.collect()}
        elif name == "pii":
            assert {r.doc_id for r in out.collect()} == ids
            assert not out.select(pii.mentions(out["text"]).alias("m")).selectExpr("explode(m) m") \
                .join(docs.select(pii.mentions(docs["text"]).alias("o")).selectExpr("explode(o) m").distinct(), "m").count()
        else:
            want = packing.cut_pieces(docs, public_path("word_bpe_49k.json"), "word", 1, 4096)
            assert out.select(want.columns).exceptAll(want).count() == 0 and out.count() == want.count()
        assert stage(spark, with_extra(empty), SF).count() == 0
        docs = out


def test_run(spark):
    out = cp.run(spark, SF)
    assert {"doc_id", "piece", "sequence_id", "offset", "length"} <= set(out.columns) and out.count() > 0
