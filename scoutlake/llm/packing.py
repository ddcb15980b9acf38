"""Best-fit packing planned on counts of lengths.

Tasks encode the documents and keep per piece only its length and checksum. The plan is best-fit decreasing over the
histogram of lengths (at most ``capacity`` rows, whatever the corpus): sequences of equal content are one range of
numbers, and a plan row says that the pieces of one length with ranks lo..hi-1 take the sequences from ``seq`` on at one
offset. Pieces then take their places by joining on length and rank.

Defined results: a null text is an empty document and has only its end id; repeated rows are packed each; equal
lengths are ranked by hash, id and piece; an empty table gives no rows; columns other than id and text are not read.
"""

import zlib

from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import materialize, query, small, table
from .tokens import encoder, public_path

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: Pieces of one length that one task ranks.
RANKED = 20_000


def cut_pieces(docs, path, kind, end_id, capacity):
    """Pieces of at most ``capacity`` ids with their checksums."""
    def encode(batches):
        import pyarrow as pa

        enc = encoder(path, kind)
        end = end_id.to_bytes(4, "little")
        size = 4 * capacity
        for batch in small(batches):
            out = ([], [], [], [], [])
            for doc, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = enc.ids(t) + end
                for k, at in enumerate(range(0, len(ids), size)):
                    cut = ids[at:at + size]
                    for col, v in zip(out, (doc, k, at // 4, len(cut) // 4, zlib.crc32(cut))):
                        col.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()),
                 *[pa.array(c, pa.int64()) for c in out[2:]]],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(encode, PIECES)


def plan_best_fit(counts, capacity):
    """Best-fit decreasing over ``counts`` {length: pieces}.

    Returns rows (length, lo, hi, seq, offset): pieces lo..hi-1 of that length stand at ``offset`` in the sequences
    seq, seq + 1, and so on.
    """
    open_at = [[] for _ in range(capacity + 1)]  # by space left: ranges (first sequence, how many)
    spaces = set()
    rows, sequences = [], 0

    def leave(space, first, n):
        if space:
            open_at[space].append((first, n))
            spaces.add(space)

    for length in sorted(counts, reverse=True):
        done, n = 0, counts[length]
        while done < n:
            fit = min((s for s in spaces if s >= length), default=None)
            if fit is None:
                break
            first, many = open_at[fit].pop()
            put = min(many, n - done)
            rows.append((length, done, done + put, first, capacity - fit))
            done += put
            if put < many:
                open_at[fit].append((first + put, many - put))
            if not open_at[fit]:
                spaces.discard(fit)
            leave(fit - length, first, put)
        each = capacity // length
        for many, deep in (((n - done) // each, each), (1, (n - done) % each)):
            if many and deep:
                for k in range(deep):
                    rows.append((length, done, done + many, sequences, k * length))
                    done += many
                leave(capacity - deep * length, sequences, many)
                sequences += many
    return rows


def _numbers(spark, names, rows):
    """A frame of whole numbers from the driver, whose size Spark knows."""
    import pyarrow as pa

    cols = list(zip(*rows)) or [()] * len(names)
    return spark.createDataFrame(pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, cols)}))


def pack(docs, path, kind="word", end_id=1, capacity=4096):
    """Place of every piece of every document: sequence_id and offset, beside the piece's own columns."""
    spark = docs.sparkSession
    pieces = materialize(cut_pieces(docs, path, kind, end_id, capacity), "pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = _numbers(spark, ["length", "lo", "hi", "seq", "at"], plan_best_fit(counts, capacity))
    splits = _numbers(spark, ["length", "splits"], [(k, -(-n // RANKED)) for k, n in counts.items()])
    mixed = F.xxhash64("doc_id", "piece", "ids_crc32")
    cut = pieces.join(splits, "length").withColumn("split", F.pmod(mixed, F.col("splits")))
    before = Window.partitionBy("length").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    starts = cut.groupBy("length", "split").agg(F.count(F.lit(1)).alias("n")) \
        .select("length", "split", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    own = Window.partitionBy("length", "split").orderBy(mixed, "doc_id", "piece")
    ranked = cut.withColumn("rank", F.row_number().over(own) - 1) \
        .join(starts, ["length", "split"]).withColumn("rank", F.col("rank") + F.col("base"))
    placed = ranked.join(plan, (ranked["length"] == plan["length"]) & (ranked["rank"] >= plan["lo"])
                         & (ranked["rank"] < plan["hi"]))
    return placed.select("doc_id", "piece", "start", ranked["length"], "ids_crc32",
                         (F.col("seq") + F.col("rank") - F.col("lo")).alias("sequence_id"), F.col("at").alias("offset"))


@query("op7_best_fit_packing")
def op7(spark, sf):
    return pack(table(spark, sf, "documents"), public_path("word_bpe_49k.json"))
