"""Near-copies: groups of fingerprints and MinHash bands propose pairs, the similarity of the shingle sets decides.

Two texts are near-copies if their sets of five-word shingles have a Jaccard similarity of ``LEAST`` or more. Pairs are
proposed by the groups of near fingerprints (``simhash.groups``) and, as edited copies at 0.8 mostly differ in more bits
than those, by ``BANDS`` bands of ``ROWS`` MinHash values: a pair at 0.8 shares no band in about 3 of a million cases, one
at 0.9 in fewer than 1 of 10^11. Every proposed pair is verified with the sets themselves (32-bit hashes of all shingles),
so texts that are less similar are never linked.

Texts with equal sets are one node. In a list of nodes that share a band or a group, each is first compared with one of
them, another in each list. Only lists of over two nodes that are still in several components go on; there all pairs from
different components are compared, in tiles of ``TILE`` nodes, so no pair of a list is left out and a large group of
near-copies does not grow with its square. Nodes that share no list lose their set before it is compared.

Defined results: texts without words, empty or null, are copies of each other; a text of fewer than five words is one
shingle; repeated rows are copies; an empty table gives no rows; columns other than id and text are not read.
"""

from pyspark.sql import functions as F

from .common import materialize, small
from .simhash import components, groups, hashes, simhash

WORDS = 5
LEAST = 0.8
BANDS, ROWS = 24, 4
TILE = 256


def shingle_set(text, k=WORDS):
    """Sorted different 64-bit hashes of a text's k-word shingles."""
    import numpy as np

    return np.unique(np.concatenate([np.zeros(0, "<u8"), *hashes(text, k)]))


def bands(shingles):
    """One number for each band of MinHash values; none for an empty set."""
    import numpy as np
    from xxhash import xxh64_intdigest

    if not len(shingles):
        return []
    rng = np.random.default_rng(5)
    factor, shift = rng.integers(0, 2**63, (2, BANDS * ROWS), "u8") * np.uint64(2) + np.uint64(1)
    low = np.full(BANDS * ROWS, 2**64 - 1, "u8")
    for at in range(0, len(shingles), 4096):
        low = np.minimum(low, (shingles[at:at + 4096, None] * factor + shift).min(axis=0))
    return [xxh64_intdigest(row.tobytes(), i) for i, row in enumerate(low.reshape(BANDS, ROWS))]


def similar(a, b, least=LEAST):
    """Whether two sorted sets have a Jaccard similarity of at least ``least``."""
    import numpy as np

    if len(a) > len(b):
        a, b = b, a
    if len(a) < least * len(b) - 1e-9:
        return False
    at = np.searchsorted(b, a)
    both = int((b[np.minimum(at, len(b) - 1)] == a).sum()) if len(b) else 0
    return both >= least * (len(a) + len(b) - both) - 1e-9


def marks(docs, words=WORDS):
    """doc_id, hash of the text, node (digest of the set), fingerprint, bands and set of each document."""
    def compute(batches):
        import numpy as np
        import pyarrow as pa
        from xxhash import xxh64_intdigest

        for batch in small(batches, fresh=True):
            out = ([], [], [], [])
            for t in batch.column(2).to_pylist():
                s = shingle_set(t, words)
                out[0].append(xxh64_intdigest(s.tobytes(), 7))
                out[1].append(np.array(bands(s), "u8").view("i8"))
                out[2].append(np.unique(s.astype("<u4")).tobytes())
                out[3].append(simhash(t))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.array(out[0], "u8").view("i8")),
                 pa.array(np.array(out[3], "u8").view("i8")), pa.array(out[1], pa.list_(pa.int64())), pa.array(out[2], pa.binary())],
                names=["doc_id", "text_hash", "node", "fp", "bands", "shingles"])

    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), "text") \
        .mapInArrow(compute, "doc_id long, text_hash long, node long, fp long, bands array<long>, shingles binary")


def verified(pairs, sets, least=LEAST):
    """Of the pairs (a, b) those with similar sets."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in small(batches):
            x, y = (batch.column(i).to_pylist() for i in (2, 3))
            ok = [similar(np.frombuffer(p, "<u4"), np.frombuffer(q, "<u4"), least) for p, q in zip(x, y)]
            yield batch.select([0, 1]).filter(pa.array(ok, pa.bool_()))

    of = [sets.select(F.col("node").alias(c), F.col("shingles").alias(f"of_{c}")) for c in "ab"]
    return pairs.join(of[0], "a").join(of[1], "b").select("a", "b", "of_a", "of_b").mapInArrow(run, "a long, b long")


def _tile_links(rows, least):
    """Links between components within the tiles of a partition that is sorted by key."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        def work(members):
            own, out = {}, []

            def find(x):
                while own.setdefault(x, x) != x:
                    own[x] = own[own[x]]
                    x = own[x]
                return x

            for i, (a, root, x) in enumerate(members):
                for b, other, y in members[:i]:
                    if a != b and find(root) != find(other) and similar(x, y, least):
                        own[find(root)] = find(other)
                        out.append((a, b))
            return out

        last, members = None, []
        for batch in small(batches):
            found = []
            for key, node, root, s in zip(*(c.to_pylist() for c in batch.columns)):
                if key != last:
                    found += work(members)
                    last, members = key, []
                members.append((node, root, np.frombuffer(s, "<u4")))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=["a", "b"])
        found = work(members)
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=["a", "b"])

    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(run, "a long, b long")


def proposed(marked):
    """Lists of two or more nodes that share a band or a group of fingerprints: key, node, first (one node of the list)."""
    nodes = marked.filter("size(bands) > 0")
    banded = nodes.select("node", "bands").dropDuplicates(["node"]).select("node", F.explode("bands").alias("key"))
    prints = materialize(nodes.select("node", "fp").distinct(), "shingle-fingerprints")
    grouped = prints.join(groups(prints.select("fp").distinct()), "fp").select("node", F.xxhash64(F.lit("fp"), "root").alias("key"))
    index = banded.unionByName(grouped.distinct())
    first = F.min(F.struct(F.xxhash64("key", "node"), "node")).alias("first")
    lists = materialize(index.groupBy("key").agg(F.count(F.lit(1)).alias("n"), first).filter("n > 1")
                        .select("key", F.col("first.node").alias("first")), "shingle-lists")
    return index.join(lists, "key").select("key", "node", "first")


def links(index, sets, least=LEAST):
    """Links among different sets (columns node, shingles) that connect all similar pairs of a list of the index."""
    pairs = index.filter("node <> first") \
        .select(F.least("node", "first").alias("a"), F.greatest("node", "first").alias("b")).distinct()
    stars = materialize(verified(pairs, sets, least), "shingle-stars")
    roots = components(stars)
    rooted = index.join(roots, "node", "left").select(F.coalesce("root", "node").alias("root"), "node", "key")
    mixed = materialize(rooted.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("root").alias("low"), F.max("root").alias("high"))
                        .filter("n > 2 and low < high").select("key", F.ceil(F.col("n") / TILE).cast("int").alias("tiles")),
                        "shingle-mixed")
    own = F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int")
    cut = rooted.join(mixed, "key").withColumn("own", own) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))) \
        .select(F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("key"), "node", "root")
    # bands of the same group mostly have the same list: each list of nodes is compared once
    same = cut.groupBy("key").agg(F.sort_array(F.collect_set(F.struct("node", "root"))).alias("members")) \
        .filter("size(members) > 1").select("members").distinct()
    units = same.select(F.xxhash64("members").alias("key"), F.explode("members").alias("m")).select("key", "m.node", "m.root")
    rest = _tile_links(units.join(sets.select("node", "shingles"), "node").select("key", "node", "root", "shingles"), least)
    return stars.unionByName(rest)


def near_copies(docs, words=WORDS, least=LEAST):
    """doc_id, text_hash and root of every document; root names its group of near-copies."""
    marked = materialize(marks(docs, words), "shingles")
    index = materialize(proposed(marked), "shingle-index")
    sets = materialize(marked.select("node", "shingles").join(index.select("node").distinct(), "node", "left_semi")
                       .dropDuplicates(["node"]), "shingle-sets")
    roots = materialize(components(links(index, sets, least)), "shingle-roots")
    return marked.join(roots.withColumnRenamed("node", "of"), F.col("node") == F.col("of"), "left") \
        .select("doc_id", "text_hash", F.coalesce("root", "node").alias("root"))
