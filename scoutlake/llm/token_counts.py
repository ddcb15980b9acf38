"""Token counts from an exact histogram of encoded lengths.

The corpus is read once: each task counts how many of its documents have each length, only these counts are
shuffled, and the histogram is written down before anything reads it twice. Totals, quantiles and truncated totals for any
context limit, whether a document has that length or not, are read from suffix sums over the histogram.

Defined results: a null text counts as empty and has length 0; repeated rows count each time; an empty table gives
an empty histogram; only the text column is read, so other columns never matter.
"""

from collections import Counter

from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import materialize, query, small, table
from .tokens import encoder, public_path

#: Lengths per group of the two-level sums.
GROUP = 256
#: Context limits and shares of the documents that the query answers.
LIMITS = (512, 1_024, 2_048, 4_096, 8_192, 32_768, 131_072)
SHARES = (0.5, 0.9, 0.95, 0.99, 1.0)


def length_histogram(docs, path, kind="byte", text="text"):
    """Columns length, n_docs: how many documents have each number of ids."""
    def count(batches):
        import pyarrow as pa

        enc = encoder(path, kind)
        seen = Counter()
        for batch in small(batches):
            for t in batch.column(0).to_pylist():
                seen[len(enc.ids(t)) // 4] += 1
        yield pa.RecordBatch.from_pydict({"length": pa.array(list(seen.keys()), pa.int64()),
                                          "n": pa.array(list(seen.values()), pa.int64())})

    part = docs.select(F.col(text).alias("text")).mapInArrow(count, "length long, n long")
    return part.groupBy("length").agg(F.sum("n").alias("n_docs"))


def context_totals(histogram):
    """One row per length L: documents and ids of at least L, ids kept when all are cut at L, share of documents up to L.

    The sums run in two levels, within groups of lengths and over the groups, so no task holds the whole histogram.
    """
    histogram = materialize(histogram, "lengths")
    h = histogram.withColumn("tokens", F.col("length") * F.col("n_docs")) \
        .withColumn("grp", F.floor(F.col("length") / GROUP))
    groups = h.groupBy("grp").agg(F.sum("n_docs").alias("g_docs"), F.sum("tokens").alias("g_tokens"))
    after = Window.orderBy(F.desc("grp")).rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select("grp", F.coalesce(F.sum("g_docs").over(after), F.lit(0)).alias("docs_after"),
                           F.coalesce(F.sum("g_tokens").over(after), F.lit(0)).alias("tokens_after"))
    total = h.agg(F.sum("n_docs").alias("docs"), F.sum("tokens").alias("tokens")).first()
    own = Window.partitionBy("grp").orderBy(F.desc("length"))
    at_least = h.join(groups, "grp").select(
        "length", "n_docs", "tokens", F.lit(total["docs"]).alias("docs_total"), F.lit(total["tokens"]).alias("tokens_total"),
        (F.sum("n_docs").over(own) + F.col("docs_after")).alias("docs_at_least"),
        (F.sum("tokens").over(own) + F.col("tokens_after")).alias("tokens_at_least"))
    return at_least.select(
        "length", "n_docs", "docs_at_least", "tokens_at_least",
        (F.col("tokens_total") - F.col("tokens_at_least")
         + F.col("length") * F.col("docs_at_least")).alias("tokens_cut_here"),
        ((F.col("docs_total") - F.col("docs_at_least") + F.col("n_docs")) / F.col("docs_total")).alias("share_up_to"))


def quantiles(totals, shares):
    """The smallest length that covers each share of the documents."""
    wanted = [F.min(F.when(F.col("share_up_to") >= s, F.col("length"))).alias(f"q{s}") for s in shares]
    return totals.agg(*wanted)


def at_limits(totals, limits):
    """The columns of ``context_totals`` for any context limits, from the nearest lengths that occur; none for an empty table."""
    limits = list(limits)
    above = [F.min(F.when(F.col("length") >= v, F.struct("length", "n_docs", "docs_at_least", "tokens_at_least", "tokens_cut_here")))
             for v in limits]
    below = [F.max(F.when(F.col("length") <= v, F.struct("length", "share_up_to"))) for v in limits]
    answers = F.array(*[F.struct(F.lit(v).cast("long").alias("limit"), a.alias("a"), b.alias("b")) for v, a, b in zip(limits, above, below)])
    all_tokens = F.max(F.col("tokens_cut_here"))
    x, step = totals.agg(F.count(F.lit(1)).alias("n"), all_tokens.alias("tokens"), answers.alias("x")).filter("n > 0") \
        .select("tokens", F.explode("x").alias("x")), F.col("x.limit") - F.col("x.a.length")
    zero = F.lit(0).cast("long")
    return x.select(
        F.col("x.limit").alias("length"), F.when(step == 0, F.col("x.a.n_docs")).otherwise(zero).alias("n_docs"),
        F.coalesce("x.a.docs_at_least", zero).alias("docs_at_least"), F.coalesce("x.a.tokens_at_least", zero).alias("tokens_at_least"),
        F.coalesce(F.col("x.a.tokens_cut_here") + step * F.col("x.a.docs_at_least"), "tokens").alias("tokens_cut_here"),
        F.coalesce("x.b.share_up_to", F.lit(0.0)).alias("share_up_to"))


def at_shares(totals, shares):
    """The row of ``context_totals`` of the smallest length that covers each share of the documents, and the share."""
    found = F.array(*[F.struct(F.lit(float(s)).alias("share"), F.min(F.when(F.col("share_up_to") >= s, F.struct("*"))).alias("r"))
                      for s in shares])
    return totals.agg(found.alias("x")).select(F.explode("x").alias("x")).filter("x.r is not null").select("x.share", "x.r.*")


@query("op6_token_counts")
def op6(spark, sf):
    totals = context_totals(length_histogram(table(spark, sf, "documents"), public_path("byte_bpe_50k.json")))
    none = F.lit(None).cast("double").alias("share")
    rows = {"length": totals.select("*", none), "limit": at_limits(totals, LIMITS).select("*", none), "share": at_shares(totals, SHARES)}
    first, *rest = [df.select(F.lit(k).alias("kind"), "share", *totals.columns) for k, df in rows.items()]
    for df in rest:
        first = first.unionByName(df)
    return first
