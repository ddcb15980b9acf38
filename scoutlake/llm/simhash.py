"""Near-copies by SimHash: byte-position inverted index with count filtering.

Fingerprints that differ in at most 4 of 64 bits agree in at least 4 of their 8 bytes. The index lists, for 20 triples
of byte positions, which fingerprints have which three bytes there; the triples are chosen so that any four positions
contain one, hence every pair that must be found shares a list. Within a list the agreeing bytes of each pair are
tallied, pairs under four are dropped, the others verified bit by bit. Only distinct fingerprints are indexed.

Lists of more than ``LIST`` fingerprints (hot bytes) are divided by a fourth position, which every wanted pair of the
list must share, and what is still long is divided into tiles; a pair of tiles is one bounded unit of work. Each task
sends on a spanning forest of its links, not the links.

Defined results: a text without words, empty or null, has fingerprint zero and is linked like any other; repeated rows
share a fingerprint and hence a component; the component is the smallest non-null id; an empty table gives no rows;
columns other than id and text are not read.
"""

from itertools import combinations

from pyspark.sql import functions as F

from .common import materialize, query, table

BITS = 4
LIST = 1024
#: Turan's system: any four of the eight positions contain one of these triples.
PARTS = ((0, 1, 2), (3, 4, 5), (6, 7))
TRIPLES = sorted({tuple(sorted(t)) for k, part in enumerate(PARTS) for t in [
    *combinations(part, 3), *[(*pair, x) for pair in combinations(part, 2) for x in PARTS[(k + 1) % 3]]]})
QUADS = list(combinations(range(8), 4))


def hashes(text, k=4):
    """Arrays of the 64-bit hashes of a text's k-word shingles, repeats included."""
    import numpy as np
    from xxhash import xxh64_intdigest

    words = text.encode().lower().split() if text else []
    if not words:
        return
    data = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), "i8", len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - k + 1)
    starts, ends = starts[:n].tolist(), ends[min(k, len(words)) - 1:].tolist()
    for at in range(0, n, 1 << 15):
        yield np.array([xxh64_intdigest(data[s:e], 42) for s, e in zip(starts[at:at + (1 << 15)], ends[at:at + (1 << 15)])],
                       "<u8")


def simhash(text, k=4):
    """64-bit fingerprint of a text's k-word shingles, repeats included."""
    import numpy as np

    ones, n = np.zeros(64, "i8"), 0
    for h in hashes(text, k):
        ones += np.unpackbits(h.view("u1").reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype="i4")
        n += len(h)
    return int.from_bytes(np.packbits(ones * 2 > n, bitorder="little").tobytes(), "little")


def fingerprints(docs):
    """doc_id, hash of the text and signed 64-bit fingerprint of each document."""
    def compute(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            f = np.array([simhash(t) for t in batch.column(2).to_pylist()], "u8").view("i8")
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(f)],
                                             names=["doc_id", "text_hash", "fp"])

    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), "text") \
        .mapInArrow(compute, "doc_id long, text_hash long, fp long")


def _key(number, positions, fp=None):
    """Index key: number of the position set, then the bytes at the positions."""
    fp = F.col("fp") if fp is None else fp
    key = F.lit(number).cast("long")
    for p in positions:
        key = F.shiftleft(key, 8).bitwiseOR(F.shiftrightunsigned(fp, 8 * p).bitwiseAND(F.lit(255).cast("long")))
    return key


def forest(a, b):
    """Spanning stars of the links (a, b): arrays (smallest member, other member)."""
    import numpy as np

    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = at[:len(a)], at[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[u], label[v])
        new = label.copy()
        for side in (u, v, label[u], label[v]):
            np.minimum.at(new, side, low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    other = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[label[other]], nodes[other]


def _verify(batches):
    """Links within the lists of a partition that is sorted by key: tally bytes, then compare bits."""
    import numpy as np
    import pyarrow as pa

    def pairs(keys, fps):
        out_a, out_b, held = [], [], 0
        live = np.arange(len(keys))
        for d in range(1, len(keys)):
            live = live[live + d < len(keys)]
            live = live[keys[live] == keys[live + d]]
            if not len(live):
                break
            x = fps[live] ^ fps[live + d]
            same = (x.view("u1").reshape(-1, 8) == 0).sum(axis=1) >= 4
            hit = live[same][np.bitwise_count(x[same]) <= BITS]
            hit = hit[fps[hit] != fps[hit + d]]
            if len(hit):
                out_a.append(fps[hit])
                out_b.append(fps[hit + d])
                held += len(hit)
                if held > 500_000:
                    a, b = forest(np.concatenate(out_a), np.concatenate(out_b))
                    out_a, out_b, held = [a], [b], 0
        return out_a, out_b

    found_a, found_b = [], []
    keys, fps = np.zeros(0, "i8"), np.zeros(0, "u8")

    def work(k, f):
        a, b = pairs(k, f)
        found_a.extend(a)
        found_b.extend(b)
        if sum(map(len, found_a)) > 500_000:
            a, b = forest(np.concatenate(found_a), np.concatenate(found_b))
            found_a[:], found_b[:] = [a], [b]

    for batch in batches:
        keys = np.concatenate([keys, batch.column(0).to_numpy(zero_copy_only=False)])
        fps = np.concatenate([fps, batch.column(1).to_numpy(zero_copy_only=False).view("u8")])
        if len(keys):
            cut = int(np.searchsorted(-(keys[::-1] == keys[-1]).astype("i1"), 0))  # rows of the last key stay
            work(keys[:len(keys) - cut], fps[:len(fps) - cut])
            keys, fps = keys[len(keys) - cut:], fps[len(fps) - cut:]
    work(keys, fps)
    if found_a:
        a, b = forest(np.concatenate(found_a), np.concatenate(found_b))
        yield pa.RecordBatch.from_arrays([pa.array(a.view("i8")), pa.array(b.view("i8"))], names=["a", "b"])


def _lists(rows):
    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(_verify, "a long, b long")


def links(distinct):
    """Spanning links among distinct fingerprints that differ in at most ``BITS`` bits."""
    index = distinct.select(F.explode(F.array(*[_key(i, t) for i, t in enumerate(TRIPLES)])).alias("key"), "fp")
    long = index.groupBy("key").count().filter(F.col("count") > LIST).select("key")
    found = _lists(index.join(long, "key", "left_anti"))
    hot = index.join(long, "key", "left_semi")
    number = F.shiftright("key", 24)
    wider = F.array(*[F.struct(F.lit(q).alias("q"), _key(q, p).alias("key"), F.lit(
        [i for i, t in enumerate(TRIPLES) if set(t) <= set(p)]).alias("triples")) for q, p in enumerate(QUADS)])
    quads = hot.select("fp", number.cast("int").alias("triple"), F.explode(wider).alias("w")) \
        .filter(F.array_contains("w.triples", F.col("triple"))).select(F.col("w.key").alias("key"), "fp").distinct()
    sizes = quads.groupBy("key").count().filter("count > 1")
    tiles = F.ceil(F.col("count") / LIST).cast("int")
    own = F.pmod(F.hash("fp"), F.col("tiles"))
    cut = quads.join(sizes, "key").withColumn("tiles", tiles).withColumn("own", own) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    cut = cut.select(F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("key"), "fp")
    return found.unionByName(_lists(cut))


def components(edges):
    """Smallest node reachable from each node of the edges (columns a, b); columns node, root.

    Each round points every node's larger neighbours, then its smaller ones, at its smallest neighbour, until all
    edges are stars. Rounds are written to the scratch folder.
    """
    def pointed(e):
        low = e.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "c")
        return e.join(low, F.col("u") == F.col("c"))

    def state(e):
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    edges = materialize(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                        .filter("a < b").distinct(), "edges")
    last = state(edges)
    while last[0]:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")) \
            .union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = pointed(both).filter("v > u").select(F.least("m", "u").alias("a"), F.col("v").alias("b")) \
            .filter("a < b").distinct()
        down = large.select(F.col("b").alias("u"), F.col("a").alias("v"))
        small = pointed(down)
        edges = materialize(small.select(F.col("m").alias("a"), F.col("v").alias("b"))
                            .union(small.select(F.col("m").alias("a"), F.col("u").alias("b")))
                            .filter("a < b").distinct(), "edges")
        now = state(edges)
        if now == last:
            break
        last = now
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root"))


def groups(distinct):
    """fp and root of each of the different fingerprints; root names those that links lead to."""
    roots = components(links(distinct.select("fp")))
    return distinct.join(roots, distinct["fp"] == roots["node"], "left").select(*distinct.columns, F.coalesce("root", "fp").alias("root"))


def near_copies(docs):
    """doc_id, text_hash, fp and component_id of every document; root names its component even if all ids are null."""
    marked = materialize(fingerprints(docs), "fingerprints")
    distinct = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    of = groups(distinct)
    least = of.groupBy("root").agg(F.min("first").alias("component_id"))
    named = materialize(of.join(least, "root").select(F.col("fp").alias("of_fp"), "component_id", "root"), "components")
    return marked.join(named, marked["fp"] == named["of_fp"]).select("doc_id", "text_hash", "fp", "component_id", "root")


def keep_one(docs, copies=None):
    """All columns of the documents, one row of each component: smallest id, then smallest text hash; null ids last.

    ``copies``: doc_id, text_hash and root of every document, if not those of ``near_copies``.
    """
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    keep = (near_copies(docs) if copies is None else copies).groupBy("root").agg(F.min(order).alias("k")) \
        .select(F.col("k.doc_id").alias("kept_id"), F.col("k.text_hash").alias("kept_hash"))
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("hash"))
    same = rows["id"].eqNullSafe(keep["kept_id"]) & (rows["hash"] == keep["kept_hash"])
    return rows.join(keep, same, "left_semi").dropDuplicates(["id", "hash"]).select("row.*")


@query("op1_simhash_near_dedup")
def op1(spark, sf):
    return near_copies(table(spark, sf, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
