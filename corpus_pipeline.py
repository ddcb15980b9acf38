"""Text pipeline: toxic documents out, one of each group of near-copies, no benchmark passages, surrogates, packing.

Each stage takes (spark, docs, sf_dir) and all but the last return the columns of documents. Repeated rows, nulls and
empty tables have the results that each operator's docstring defines.
"""

import functools

from pyspark.sql import functions as F

from scoutlake.llm import decontaminate, packing, pii, shingles, simhash, toxicity
from scoutlake.llm.common import materialize, table
from scoutlake.llm.tokens import public_path

#: SQL cannot express learning, fingerprints and keyed surrogates; the pipeline is tested against its parts.
ORACLE_SQL = None


def drop_toxic(spark, docs, sf_dir):
    """Documents whose toxicity score is under one half."""
    score = toxicity.toxic_score(docs, table(spark, sf_dir, "labels"))
    return docs.filter(score < 0.5)


def drop_near_copies(spark, docs, sf_dir):
    """Of each group of near-copies the document with the smallest id; of rows that repeat it, one.

    Pairs are proposed by the groups of op1's fingerprints and by MinHash bands; the sets of five-word shingles decide (0.8).
    """
    return simhash.keep_one(docs, shingles.near_copies(docs))


def drop_benchmark(spark, docs, sf_dir):
    """Documents without a benchmark passage; they are known by id and text, so a null or shared id takes nothing else along."""
    own = F.xxhash64(F.col("doc_id").cast("long"), "text")
    found = decontaminate.leaks(docs.select(own.alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    leaked = found.select(F.col("doc_id").alias("leaked_row")).distinct()
    return docs.join(leaked, own == leaked["leaked_row"], "left_anti")


def replace_pii(spark, docs, sf_dir):
    """All documents, personal data in their texts replaced."""
    return pii.replace_pii(docs)


def pack(spark, docs, sf_dir):
    """Places of the documents' pieces in sequences of at most 4096 ids."""
    return packing.pack(docs, public_path("word_bpe_49k.json"))


STAGES = [("toxicity", drop_toxic), ("near_dedup", drop_near_copies), ("decontamination", drop_benchmark),
          ("pii", replace_pii), ("packing", pack)]


def run(spark, sf_dir):
    """All stages over documents, each written as Parquet and read again."""
    *first, (_, last) = STAGES
    docs = functools.reduce(lambda d, stage: materialize(stage[1](spark, d, sf_dir), f"stage-{stage[0]}"), first,
                            table(spark, sf_dir, "documents"))
    return materialize(last(spark, docs, sf_dir), "stage-packing")
