"""Hard negatives by a best-first search of STR-packed R-trees.

Sort-tile-recursive packing in two steps. Spark sorts all rows by label, by slabs of the first coordinate and by the second, and
cuts them into trees of about ``TREE`` rows; a tree goes on with its coordinates of largest variance down to leaves of ``LEAF``
rows, ``FAN`` leaves to a node. Leaves and nodes have minimum bounding boxes, of which an anchor's inner product with any row
inside lies in an interval that follows from each coordinate. A queue takes boxes by their upper end; boxes outside all score
windows, or strictly below the k-th best score of each window, are left out.

The search runs in two rounds: each anchor first goes to the tree whose box promises most, which gives its k-th scores, then to all
others that these scores don't rule out. Which those are is decided by the boxes of the trees, merged to at most ``BOXES``
boxes that are sent to every task. Anchors are moved to trees, never trees to anchors; a task holds one tree and a batch of
anchors.

Components are whole numbers. Scores are exact: in double precision while no sum can reach 2^53, else in 64-bit
integers; vectors whose scores might not fit those raise ``ValueError``.

Defined results: rows with a null label, a null vector or a null component take no part; rows that repeat in id, label and
vector are one row; rows that share the anchor's id are not its partners; a null id is no anchor and comes last among ties; shorter
vectors are filled with zeros; an empty table gives no rows; other columns are not read.
"""

import functools

from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import materialize, query, table

TREE = 8_192
LEAF = 256
FAN = 8
#: Boxes that all tasks get.
BOXES = 1_024
#: Order of null ids: behind every other.
NO_ID = 2**63 - 1
FAR = 2**62
FOUND = "row long, window int, score long, id long"


def str_order(x, leaf):
    """Order of the rows after sort-tile-recursive packing, in leaves of at most ``leaf`` rows, and where the leaves start."""
    import numpy as np

    by = np.argsort(-x.var(axis=0, dtype="f8"), kind="stable") if len(x) else []

    def tiles(rows, depth):
        pages = -(-len(rows) // leaf)
        if pages <= 1:
            return [rows]
        left = max(1, len(by) - depth)
        slabs = max(2, int(np.ceil(pages ** (1 / left))))
        if depth < len(by):
            rows = rows[np.argsort(x[rows, by[depth]], kind="stable")]
        size = leaf * -(-pages // slabs)
        return [t for at in range(0, len(rows), size) for t in tiles(rows[at:at + size], depth + 1)]

    cut = tiles(np.arange(len(x)), 0)
    return np.concatenate(cut), np.concatenate([[0], np.cumsum([len(t) for t in cut])])


def intervals(a, low, high):
    """Least and largest inner product of each row of ``a`` with any point of each box."""
    import numpy as np

    up, down = np.maximum(a, 0), np.minimum(a, 0)
    return up @ low.T + down @ high.T, up @ high.T + down @ low.T


class Tree:
    """Packed rows with boxes for leaves and nodes."""

    def __init__(self, ids, labels, x, work):
        import numpy as np

        order, cut = str_order(x, LEAF)
        self.ids, self.labels, self.x = ids[order], labels[order], x[order].astype(work)
        nodes = np.append(np.arange(0, len(cut) - 1, FAN), len(cut) - 1)
        self.leaf, self.node = cut, nodes
        self.boxes = [(np.minimum.reduceat(self.x, at), np.maximum.reduceat(self.x, at),
                       np.minimum.reduceat(self.labels, at), np.maximum.reduceat(self.labels, at))
                      for at in (cut[nodes[:-1]], cut[:-1])]

    def search(self, ids, labels, a, lows, highs, floors, k, same):
        """Per anchor and window the first k rows: tuples (anchor, window, scores, ids)."""
        import numpy as np

        ends = [(*intervals(a, low, high), l0, l1) for low, high, l0, l1 in self.boxes]
        for i in range(len(a)):
            least, most = lows[i], highs[i]
            least = np.maximum(least, floors[i])
            if len(least):
                for w, (s, d) in enumerate(self._one(ids[i], labels[i], a[i], least, most, k, same,
                                                     [(e[0][i], e[1][i], e[2], e[3]) for e in ends])):
                    if len(s):
                        yield i, w, s, d

    def _one(self, own, label, a, least, most, k, same, ends):
        """First k (scores, ids) of each window: best-first over nodes, then leaves."""
        import heapq

        import numpy as np

        best = [(np.zeros(0, "i8"), np.zeros(0, "i8")) for _ in least]
        least = least.copy()

        def open_(level, at):
            low, high, l0, l1 = (e[at] for e in ends[level])
            ok = (l0 <= label) & (l1 >= label) if same else ~((l0 == label) & (l1 == label))
            ok &= ((high[:, None] >= least) & (low[:, None] <= most)).any(axis=1)
            for j in np.flatnonzero(ok):
                heapq.heappush(queue, (-high[j], level, int(at[j])))

        queue = []
        open_(0, np.arange(len(self.node) - 1))
        while queue:
            high, level, j = heapq.heappop(queue)
            if -high < least.min():
                break
            low = ends[level][0][j]
            if not ((-high >= least) & (low <= most)).any():
                continue
            if level == 0:
                open_(1, np.arange(self.node[j], self.node[j + 1]))
                continue
            rows = slice(self.leaf[j], self.leaf[j + 1])
            score = self.x[rows] @ a
            at = np.flatnonzero((score >= least.min()) & (score <= most.max()))
            if not len(at):
                continue
            partner = (self.labels[rows][at] == label) == same
            at = at[partner & (self.ids[rows][at] != own)]
            score, found = score[at].astype("i8"), self.ids[rows][at]
            for w in range(len(best)):
                hit = (score >= least[w]) & (score <= most[w])
                if hit.any():
                    s, d = np.concatenate([best[w][0], score[hit]]), np.concatenate([best[w][1], found[hit]])
                    order = np.lexsort((d, -s))[:k]
                    best[w] = s[order], d[order]
                    if len(order) == k:
                        least[w] = max(least[w], s[order[-1]])
        return best


def _matrix(column, dtype, work):
    """Rows of a binary column as a matrix."""
    import numpy as np

    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), dtype).reshape(len(rows), -1).astype(work)


class Forest:
    """Trees of all rows, in the scratch folder, and the boxes that all tasks get."""

    def __init__(self, rows):
        """``rows``: id long, label long, x array<long>."""
        rows = rows.filter(F.col("label").isNotNull() & F.col("x").isNotNull()).filter(~F.exists("x", lambda v: v.isNull()))
        sizes = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("d"), F.min(F.array_min("x")).alias("low"),
                         F.max(F.array_max("x")).alias("high")).first()
        most = max(abs(sizes["low"] or 0), abs(sizes["high"] or 0), 1)
        self.spark, self.n, self.d = rows.sparkSession, sizes["n"], max(1, sizes["d"] or 1)
        if self.d * most * most >= 2**56:  # a hundred times a score is a long
            raise ValueError(f"inner products of {self.d} components up to {most} may not fit 64 bits")
        self.work = "f8" if self.d * most * most < 2**53 else "i8"
        self.dtype = "<i2" if most < 2**15 else "<i4" if most < 2**31 else "<i8"
        self.trees = max(1, -(-self.n // TREE))
        self.rows = materialize(self._packed_rows(rows), "vectors")
        self.packed = materialize(self._pack(), "trees")
        self.boxes = self.spark.sparkContext.broadcast(self._boxes())  # at most BOXES boxes

    def _packed_rows(self, rows):
        """row (hash of id, label and vector), id, label, vector in bytes, first two coordinates."""
        d, dtype = self.d, self.dtype

        def pack(batches):
            import numpy as np
            import pyarrow as pa

            for batch in batches:
                lists = batch.column(2)
                n, many = len(batch), np.diff(lists.offsets.to_numpy())
                x = np.zeros((n, d), dtype)
                of = np.repeat(np.arange(n), many)
                x[of, np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)] = lists.flatten().to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array([r.tobytes() for r in x], pa.binary()),
                     pa.array(x[:, 0].astype("i8")), pa.array(x[:, min(1, d - 1)].astype("i8"))], names=["id", "label", "x", "x0", "x1"])

        return rows.select(F.col("id").cast("long"), F.col("label").cast("long"), F.col("x").cast("array<long>")) \
            .mapInArrow(pack, "id long, label long, x binary, x0 long, x1 long") \
            .withColumn("row", F.xxhash64("id", "label", "x"))

    def _pack(self):
        """tree and its rows: ids, labels and vectors, each end to end."""
        shares = max(1, round(self.trees ** 0.5))
        cuts = self.rows.approxQuantile("x0", [i / shares for i in range(1, shares)], 0.01) if self.n and shares > 1 else []
        slab = functools.reduce(lambda c, v: c + F.when(F.col("x0") > v, 1).otherwise(0), cuts, F.lit(0))
        sorted_ = self.rows.withColumn("slab", slab).repartitionByRange(self.trees, "label", "slab", "x1", "row") \
            .select(F.spark_partition_id().cast("long").alias("tree"), "row", "id", "label", "x")

        def pack(batches):
            import numpy as np
            import pyarrow as pa

            held = [pa.Table.from_batches([b]) for b in batches]
            if not held:
                return
            rows = pa.concat_tables(held)
            tree, row = rows.column("tree")[0].as_py(), rows.column("row").to_numpy()
            ids, labels = rows.column("id").fill_null(NO_ID).to_numpy(), rows.column("label").to_numpy()
            once = np.unique(np.stack([row, ids, labels]), axis=1, return_index=True)[1]
            x = rows.column("x").take(pa.array(once)).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [pa.array([tree], pa.int64()), *[pa.array([v], pa.binary()) for v in (
                    ids[once].astype("<i8").tobytes(), labels[once].astype("<i8").tobytes(), b"".join(x))]],
                names=["tree", "ids", "labels", "x"])

        return sorted_.mapInArrow(pack, "tree long, ids binary, labels binary, x binary")

    def _boxes(self):
        """Arrays: first tree of each box (and the end), least and largest coordinates and labels."""
        import numpy as np

        share, dtype, d = -(-self.trees // BOXES), self.dtype, self.d

        def bound(batches):
            import pyarrow as pa

            for batch in batches:
                for tree, labels, x in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
                    rows = np.c_[np.frombuffer(labels, "<i8"), np.frombuffer(x, dtype).reshape(-1, d).astype("i8")]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([tree // share], pa.int64()), pa.array([rows.min(axis=0).tolist()]), pa.array([rows.max(axis=0).tolist()])],
                        names=["box", "low", "high"])

        each = self.packed.mapInArrow(bound, "box long, low array<long>, high array<long>")
        if share > 1:
            ends = [F.array_agg("low").alias("low"), F.array_agg("high").alias("high")]  # of ``share`` trees

            def merged(c, f):
                return F.aggregate(c, F.element_at(c, 1), lambda s, v: F.zip_with(s, v, f)).alias(c)

            each = each.groupBy("box").agg(*ends).select("box", merged("low", lambda u, v: F.least(u, v)), merged("high", lambda u, v: F.greatest(u, v)))
        found = sorted(each.collect())
        low, high = (np.array([r[c] for r in found], "i8").reshape(-1, d + 1) for c in ("low", "high"))
        return np.array([r["box"] for r in found], "i8"), share, low, high

    def _sent(self, anchors, same, first):
        """Anchors beside the trees they go to: with ``first`` those of the most promising box, else all others that may hold more."""
        boxes, trees, dtype, work = self.boxes, self.trees, self.dtype, self.work

        def send(batches):
            import numpy as np
            import pyarrow as pa

            box, share, low, high = boxes.value
            for batch in batches:
                col = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
                if not len(batch) or not len(box):
                    continue
                a, label = _matrix(col["x"], dtype, work), col["label"].to_numpy()[:, None]
                least, most = intervals(a, low[:, 1:].astype(work), high[:, 1:].astype(work))
                l0, l1 = low[:, 0], high[:, 0]
                ok = (l0 <= label) & (l1 >= label) if same else ~((l0 == label) & (l1 == label))
                lows, highs, floors = (col[c].to_pylist() for c in ("lows", "highs", "floors"))
                top = np.array([max(h, default=-FAR) for h in highs])[:, None]
                hope = np.where(ok & (least <= top), np.minimum(most, top), -float(FAR) * 4)
                best = hope.argmax(axis=1)
                of, to = [], []
                for i in range(len(batch)):
                    under = np.maximum(lows[i], floors[i])
                    fits = ok[i] & ((most[i][:, None] >= under) & (least[i][:, None] <= np.array(highs[i]))).any(axis=1)
                    go = np.arange(len(box)) == best[i]
                    for b in np.flatnonzero(fits & (go if first else ~go)):
                        at = np.arange(box[b] * share, min(trees, (box[b] + 1) * share))
                        to.append(at)
                        of.append(np.full(len(at), i))
                if of:
                    rows = batch.take(pa.array(np.concatenate(of)))
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(to)), *rows.columns], names=["tree", *rows.schema.names])

        return anchors.select(*ANCHOR).mapInArrow(send, "tree long, " + ANCHORS)

    def _search(self, sent, k, same):
        """First k rows of every window of every anchor, from each tree it was sent to."""
        d, dtype, work = self.d, self.dtype, self.work

        def run(batches):
            import numpy as np
            import pyarrow as pa

            at, tree = None, None
            for batch in batches:
                col = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
                number, kind = col["tree"].to_numpy(), col["kind"].to_numpy()
                starts = np.flatnonzero(np.r_[True, (np.diff(number) != 0) | (np.diff(kind) != 0)]) if len(batch) else []
                for s, e in zip(starts, [*starts[1:], len(batch)]):
                    if kind[s] == 0:
                        ids, labels, x = (col[c][int(s)].as_py() for c in ("ids", "labels", "x"))
                        at, tree = number[s], Tree(np.frombuffer(ids, "<i8"), np.frombuffer(labels, "<i8"),
                                                   np.frombuffer(x, dtype).reshape(-1, d), work)
                    elif number[s] == at:
                        part = {n: c.slice(s, e - s) for n, c in col.items()}
                        own, label = part["id"].to_numpy(), part["label"].to_numpy()
                        row = part["row"].to_numpy()
                        lists = [[np.array(v, "i8") for v in part[c].to_pylist()] for c in ("lows", "highs", "floors")]
                        out = [[], [], [], []]
                        for i, w, score, found in tree.search(own, label, _matrix(part["x"], dtype, work), *lists, k, same):
                            for c, v in zip(out, (np.full(len(score), row[i]), np.full(len(score), w), score, found)):
                                c.append(v)
                        if out[0]:
                            r, w, score, found = map(np.concatenate, out)
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(r), pa.array(w.astype("i4")), pa.array(score), pa.array(found, mask=found == NO_ID)],
                                names=["row", "window", "score", "id"])

        null = {c: F.lit(None).cast(t) for c, t in (("row", "long"), ("id", "long"), ("label", "long"), ("ids", "binary"), ("labels", "binary"),
                                                    ("lows", "array<long>"), ("highs", "array<long>"), ("floors", "array<long>"))}
        own = [*ANCHOR, "ids", "labels"]
        held = self.packed.select("tree", F.lit(0).alias("kind"), *[F.col(c) if c in ("x", "ids", "labels") else null[c].alias(c) for c in own])
        come = sent.select("tree", F.lit(1).alias("kind"), *[null[c].alias(c) if c in ("ids", "labels") else F.col(c) for c in own])
        return held.unionByName(come).repartition(self.trees, "tree").sortWithinPartitions("tree", "kind").mapInArrow(run, FOUND)

    def first(self, anchors, k, same):
        """row, window, rank (from 1), score and id of the first k partners in every window of every anchor.

        ``anchors``: row, id, label, x as in ``rows``, lows and highs (arrays: the ends of the windows). ``same``: partners have the
        anchor's label, else another.
        """
        none = F.transform("lows", lambda v: F.lit(-FAR).cast("long"))
        anchors = materialize(anchors.withColumn("floors", none), "anchors")
        order = Window.partitionBy("row", "window").orderBy(F.desc("score"), F.asc_nulls_last("id"))

        def top(found):
            return materialize(found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k), "partners")

        begun = top(self._search(self._sent(anchors, same, True), k, same))
        kth = begun.filter(F.col("rank") == k).groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("window", "score"))).alias("kth"))
        reached = F.transform("lows", lambda v, i: F.coalesce(F.element_at("kth", i), F.lit(-FAR).cast("long")))
        left = anchors.drop("floors").join(kth, "row", "left").withColumn("floors", reached).drop("kth")
        more = self._search(self._sent(left, same, False), k, same)
        return top(begun.drop("rank").unionByName(more))


ANCHOR = ["row", "id", "label", "x", "lows", "highs", "floors"]
ANCHORS = "row long, id long, label long, x binary, lows array<long>, highs array<long>, floors array<long>"


def hard_negatives(rows, is_anchor, positives=5, negatives=10, low=30, high=90):
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows``: id, label, x (array of whole numbers); ``is_anchor``: a condition on id. An anchor's positives are its first rows of the
    same label by score, then id; for each the first rows of other labels whose score is ``low`` to ``high`` percent of its.
    """
    forest = Forest(rows)
    whole = F.array(F.lit(-FAR).cast("long")), F.array(F.lit(FAR).cast("long"))
    anchors = materialize(forest.rows.filter(F.col("id").isNotNull()).filter(is_anchor).select(
        "row", "id", "label", "x", whole[0].alias("lows"), whole[1].alias("highs")).dropDuplicates(["row", "id", "label", "x"]), "anchors")
    near = forest.first(anchors, positives, True)
    windows = near.withColumn("low", F.expr(f"-((-score * {low} - pmod(-score * {low}, 100)) div 100)")) \
        .withColumn("high", F.expr(f"(score * {high} - pmod(score * {high}, 100)) div 100"))
    bounds = windows.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("rank", "low", "high"))).alias("w"))  # ``positives`` at most
    asked = anchors.drop("lows", "highs").join(bounds, "row").withColumn("lows", F.col("w.low")).withColumn("highs", F.col("w.high")).drop("w")
    far = forest.first(asked, negatives, False)
    of = near.select("row", (F.col("rank") - 1).alias("window"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return far.join(of, ["row", "window"]).join(anchors.select("row", F.col("id").alias("anchor_id")), "row").select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


SQL = """
WITH base AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda v: floor(256 * v::DOUBLE)) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         list_dot_product(a.x, b.x)::BIGINT AS score
  FROM base a JOIN base b ON a.vec_id % 100 = 0 AND a.vec_id IS DISTINCT FROM b.vec_id),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, positive_id, row_number() OVER w AS rank, other_id AS negative_id, positive_score,
       score AS negative_score
FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT same
  AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id)
QUALIFY row_number() OVER w <= 10
"""


@query("op13_hard_negatives", SQL)
def op13(spark, sf):
    rows = table(spark, sf, "embeddings").filter(~F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    scaled = rows.select(F.col("vec_id").alias("id"), label.alias("label"),
                         F.transform("embedding", lambda v: F.floor(v.cast("double") * 256)).alias("x"))
    return hard_negatives(scaled, F.col("id") % 100 == 0)
