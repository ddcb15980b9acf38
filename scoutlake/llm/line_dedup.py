"""Line dedup: lines that other documents hold too stay only in the first of them.

A line's key is the line without ASCII white space at its ends, A-Z in lower case; keys of fewer than ``LEAST`` code points
are left alone. Every document notes the SHA-256 digests of its different keys. Two Bloom filters (``bloom``) over them say
which keys were seen once and which by two documents or more; only keys that the second filter holds are shuffled,
where equal digests are confirmed and the smallest document chosen. Documents that lose a line are found by a filter
of the same kind, and only their texts are shuffled to the list of what they lose.

Hot keys: documents of a key are reduced by partial aggregates. The choice goes back to the documents by a join, in which the
keys that hold more than one part in ``HOT`` of all suspected places are sent to every task (at most ``HOT`` of them, 40 bytes
each) and the others are dealt by digest.

Defined results: a null or empty text is one empty line; lines with equal keys in the first document stay, all of them; documents
are known by their id, so rows that share one never take lines from each other; a null id comes after all others, and rows without
an id count as one document; repeated rows have equal results; an empty table gives no rows; columns other than id and text are not
read.
"""

from pyspark.sql import functions as F

from . import bloom
from .common import materialize, query, small, table

#: Fixed value: code points of the shortest key that is compared.
LEAST = 10
#: A key that holds more than one part in this many of all suspected places is broadcast.
HOT = 2_000


def line_key(line):
    """Key of a line of UTF-8 bytes; None where it is too short to be compared."""
    key = line.strip().lower()
    if len(key) < LEAST or len(key) < 4 * LEAST and len(key.decode()) < LEAST:
        return None
    return key


def _id(column):
    return F.col(column).cast("long")


def line_digests(docs):
    """doc_id, hash of the text and the digests of its different keys, for every document that has one."""
    def compute(batches):
        import hashlib

        import pyarrow as pa

        for batch in small(batches):
            found = []
            for text in batch.column(2).to_pylist():
                keys = {line_key(line) for line in (text or b"").split(b"\n")} - {None}
                found.append([hashlib.sha256(k).digest() for k in keys])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.binary()))],
                names=["doc_id", "text_hash", "digests"])

    return docs.select(_id("doc_id").alias("doc_id"), F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary").alias("text")) \
        .mapInArrow(compute, "doc_id long, text_hash long, digests array<binary>").filter("size(digests) > 0")


def suspected(marks, segments, twice, number):
    """digest, doc_id, text_hash of the places whose digest the twice-seen filter holds, in one slice of it."""
    bits = twice.slice(number)

    def scan(batches):
        import numpy as np
        import pyarrow as pa

        for batch in small(batches):
            rows = batch.column(2).to_pylist()
            flat = [d for row in rows for d in row]
            of = np.repeat(np.arange(len(rows)), [len(row) for row in rows])
            ok = np.flatnonzero(bloom.held(flat, bits.value, segments))
            at = pa.array(of[ok])
            yield pa.RecordBatch.from_arrays(
                [pa.array([flat[i] for i in ok], pa.binary()), batch.column(0).take(at), batch.column(1).take(at)],
                names=["digest", "doc_id", "text_hash"])

    return marks.mapInArrow(scan, "digest binary, doc_id long, text_hash long")


def repeated_lines(docs):
    """doc_id, text_hash and the digests that the document loses, for documents that lose a line."""
    marks = materialize(line_digests(docs), "line-digests")
    n = marks.agg(F.sum(F.size("digests")).alias("n")).first()["n"] or 0
    segments = bloom.segments_for(n)
    twice = bloom.Filter(bloom.seen_twice(marks.select("digests"), segments), segments)
    suspects = None
    for number in twice.slices:
        part = materialize(suspected(marks, segments, twice, number), "suspected-lines")
        suspects = part if suspects is None else suspects.unionByName(part)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id"))
    last = F.max(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id"))
    keys = materialize(suspects.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), first.alias("first"), last.alias("last"))
                       .filter(~F.col("first").eqNullSafe(F.col("last"))).select("digest", "n", F.col("first.doc_id").alias("first")), "repeated-lines")
    most = (keys.agg(F.sum("n").alias("n")).first()["n"] or 0) // HOT
    hot, rest = keys.filter(F.col("n") > most).drop("n"), keys.filter(F.col("n") <= most).drop("n")
    lost = ~F.col("doc_id").eqNullSafe(F.col("first"))
    held = [suspects.join(F.broadcast(hot), "digest").filter(lost),  # at most HOT rows
            suspects.join(F.broadcast(hot.select("digest")), "digest", "left_anti").join(rest, "digest").filter(lost)]
    return held[0].unionByName(held[1]).groupBy("doc_id", "text_hash").agg(F.collect_set("digest").alias("digests"))


def dedup_lines(docs):
    """doc_id, kept_text, n_lines (before) and n_dropped of every document."""
    loses = materialize(repeated_lines(docs), "lost-lines")
    digest = F.sha2(F.concat_ws(" ", F.coalesce(_id("doc_id").cast("string"), F.lit("-")), "text_hash"), 256)
    rows = docs.select(_id("doc_id").alias("doc_id"), F.xxhash64("text").alias("text_hash"), F.coalesce("text", F.lit("")).alias("text"))
    segments = min(bloom.segments_for(loses.count()), bloom.SLICE)
    some = bloom.Filter(bloom.seen_twice(loses.select(F.array(F.unhex(digest)).alias("d")), segments, once=True), segments).slice(0)

    @F.pandas_udf("boolean")
    def may_lose(digests):
        import pandas as pd

        return pd.Series(bloom.held(digests.tolist(), some.value, segments))

    marked = rows.withColumn("may", may_lose(F.unhex(digest)))
    whole = marked.filter(~F.col("may")).select(
        "doc_id", F.col("text").alias("kept_text"), F.size(F.split("text", "\n", -1)).cast("long").alias("n_lines"),
        F.lit(0).cast("long").alias("n_dropped"))
    of = loses.select(F.col("doc_id").alias("of_id"), F.col("text_hash").alias("of_hash"), "digests")
    cut = marked.filter("may").join(of, F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("text_hash") == F.col("of_hash")), "left") \
        .select("doc_id", F.col("text").cast("binary").alias("text"), "digests")
    return whole.unionByName(cut.mapInArrow(_without, "doc_id long, kept_text string, n_lines long, n_dropped long"))


def _without(batches):
    """Texts without the lines whose digests are listed."""
    import hashlib

    import pyarrow as pa

    for batch in small(batches):
        out = ([], [], [])
        for text, digests in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            lines, lost = text.split(b"\n"), set(digests or ())
            kept = lines
            if lost:
                keys = map(line_key, lines)
                kept = [x for x, k in zip(lines, keys) if k is None or hashlib.sha256(k).digest() not in lost]
            for c, v in zip(out, (b"\n".join(kept).decode(), len(lines), len(lines) - len(kept))):
                c.append(v)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out[0], pa.string()), *[pa.array(c, pa.int64()) for c in out[1:]]],
                                         names=["doc_id", "kept_text", "n_lines", "n_dropped"])


SQL = """
WITH cut AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (
  SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM cut),
keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
firsts AS (
  SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10 GROUP BY key),
marked AS (
  SELECT r, keyed.doc_id, line, pos, coalesce(keyed.doc_id IS DISTINCT FROM first AND length(keyed.key) >= 10, false) AS lost
  FROM keyed LEFT JOIN firsts ON keyed.key = firsts.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE lost) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM marked GROUP BY r, doc_id
"""


@query("op12_line_dedup", SQL)
def op12(spark, sf):
    return dedup_lines(table(spark, sf, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))
