"""Benchmark decontamination: rare word-pair seeds, then Smith-Waterman alignment.

Words are compared in lower case. An alignment of score ``LEAST`` (0.6 of 2 a word) of an item of n > 5 words has at least
need = 0.2 n - 1 of its n - 1 pairs of neighbouring words, at least one, within the 1.8 n words it can span: if no two matched
words were neighbours, n matches would have n - 1 edits between them and score n + 1. So of the item's pairs the n - need
rarest are its seeds: an alignment that keeps need pairs keeps a seed, whichever pairs the seeds are. Rare is what few places of
the benchmark have; what is searched does not depend on the corpus. In items of 2 to 5 words all pairs are seeds, and a pair
may have one word between. Only around seeds all pairs of the items are counted; places with fewer than need are left out;
so are windows that lack more of the item's different words than the 0.4 n it may leave unmatched. None of this loses an
alignment. Each window that stays is joined to its benchmark item and aligned with it; what scores ``LEAST`` of the item's
best score is a leak.

The benchmark is taken in blocks of ``BLOCK`` words, each small enough to be sent to every task; the corpus, of any
size, is never shuffled, only the windows are.

Defined results: a null or empty text has no leak; null or empty items match nothing; an item of one word is
its own seed; repeated documents each have their rows; equal items each have their rows; empty
tables give no rows; only id and text of both tables are read.
"""

import re

from pyspark.sql import functions as F

from .common import materialize, query, small, table

#: Items of fewer words use all their words as one seed.
SEED = 2
#: Places between two texts, more than the words of a pair are apart.
PAD = 3
#: Share of the item's best possible score from which an alignment is a leak, and of an item of few words.
LEAST = 0.6
#: Words of benchmark items in one block.
BLOCK = 200_000
MATCH, MISMATCH, GAP = 2, -1, -1
WORDS = re.compile(r"\w+")
WINDOWS = "doc_id long, item long, first int, words array<int>"


def item_blocks(benchmark):
    """Lists of (item_id, words), each of at most ``BLOCK`` words; streamed, so only one is held."""
    block, size = [], 0
    for row in benchmark.select(F.col("item_id").cast("long"), "text").filter("text is not null").toLocalIterator():
        words = WORDS.findall(row["text"].lower())
        if not words:
            continue
        if block and size + len(words) > BLOCK:
            yield block
            block, size = [], 0
        block.append((row["item_id"], words))
        size += len(words)
    if block:
        yield block


def word_ids(texts, known):
    """Numbers of the texts' words one after the other (-1: not a benchmark word), each text followed by PAD -1s, and
    where each text starts."""
    import numpy as np

    get, ids, starts = known.get, [], []
    gap = [-1] * PAD
    for t in texts:
        starts.append(len(ids))
        if t:
            ids += [get(w, -1) for w in WORDS.findall(t.lower())]
        ids += gap
    return np.array(ids, "i8"), np.array(starts + [len(ids)], "i8")


def slices(texts, size=2_000_000):
    """Ranges of the texts of about this many characters."""
    start = held = 0
    for k, t in enumerate(texts):
        held += len(t or "")
        if held >= size:
            yield start, k + 1
            start, held = k + 1, 0
    if start < len(texts):
        yield start, len(texts)


def item_pairs(block, known):
    """Sorted codes of the word pairs of all items with the item and the place of each."""
    import numpy as np

    rows = sorted((known[a] * len(known) + known[b], k, at) for k, (_, words) in enumerate(block) if len(words) >= SEED
                  for at, (a, b) in enumerate(zip(words, words[1:])))
    return tuple(np.array(c, "i8") for c in (zip(*rows) if rows else ((), (), ())))


def needed(lengths):
    """Pairs of neighbouring words that an alignment of an item of so many words has at least."""
    import numpy as np

    return np.ceil(np.round((2 * LEAST - 1) * lengths - 1, 6)).astype("i8")


def rare_seeds(pairs, lengths):
    """Codes, sorted, of the pairs that are seeds: of each item the rarest, all but need - 1, rare by their places in the benchmark."""
    import numpy as np

    codes, items, places = pairs
    if not len(codes):
        return codes
    n = np.unique(codes, return_inverse=True, return_counts=True)
    often = n[2][n[1]]
    order = np.lexsort((places, codes, often, items))
    rank = np.arange(len(order)) - np.searchsorted(items[order], items[order])
    of = lengths[items[order]]
    kept = np.where(of > 5, rank < of - np.maximum(needed(of), 1), True)
    return np.unique(codes[order[kept]])


def near_seeds(ids, seeds, size, far):
    """Which places have a seed no more than ``far`` words away."""
    import numpy as np

    some = np.zeros(len(ids) + 1, "i8")
    for step in (1, 2):
        a, b = ids[:-step], ids[step:]
        at = np.flatnonzero((a >= 0) & (b >= 0))
        code = a[at] * size + b[at]
        at = at[seeds[np.minimum(np.searchsorted(seeds, code), len(seeds) - 1)] == code]
        np.add.at(some, np.maximum(at - far, 0), 1)
        np.add.at(some, np.minimum(at + far + 1, len(ids)), -1)
    return np.cumsum(some[:-1]) > 0


def pair_hits(ids, pairs, size, step, near, chunk=1 << 16):
    """Item, start of the item and place of each pair of words ``step`` apart, near a seed, that items have, in parts."""
    import numpy as np

    codes, items, places = pairs
    a, b = ids[:-step], ids[step:]
    at = np.flatnonzero((a >= 0) & (b >= 0) & near[:len(a)])
    for i in range(0, len(at), chunk):
        p = at[i:i + chunk]
        code = a[p] * size + b[p]
        lo = np.searchsorted(codes, code)
        n = np.searchsorted(codes, code, "right") - lo
        q = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
        p = np.repeat(p, n)
        yield items[q], p - places[q], p


def crowded(k, at, starts, lengths):
    """Which hits have as many hits of their item around them, in their text, as a leak must have."""
    import numpy as np

    n = lengths[k]
    need, far = needed(n), (9 * n + 4) // 5
    doc = np.searchsorted(starts, at, "right") - 1
    key = np.sort((k << 32) + at)
    lo = np.searchsorted(key, (k << 32) + np.maximum(at - far, starts[doc]))
    hi = np.searchsorted(key, (k << 32) + np.minimum(at + far + 1, starts[doc + 1]))
    return hi - lo >= need


def find_windows(docs, block, known):
    """Windows of documents around an item's word pairs, and around short items' own words."""
    import numpy as np

    pairs, lengths = item_pairs(block, known), np.array([len(w) for _, w in block], "i8")
    seeds, widest = rare_seeds(pairs, lengths), 2 * int(lengths.max(initial=0)) + 2
    words_of = [frozenset(known[w] for w in words) for _, words in block]
    short = {}
    for k, (_, words) in enumerate(block):
        if len(words) < SEED:
            short.setdefault(tuple(known[w] for w in words), []).append(k)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for b in small(batches, fresh=True):
            texts, docs_of = b.column(1).to_pylist(), b.column(0).to_pylist()
            out = ([], [], [], [])
            for s, e in slices(texts):
                ids, starts = word_ids(texts[s:e], known)
                found = [(np.zeros(0, "i8"),) * 3]
                if len(seeds):
                    near = near_seeds(ids, seeds, len(known), widest)
                    found += pair_hits(ids, pairs, len(known), 1, near)
                    found += [tuple(c[lengths[h[0]] <= 5] for c in h) for h in pair_hits(ids, pairs, len(known), 2, near)]
                k, start, at = (np.concatenate(c) for c in zip(*found))
                ok = crowded(k, at, starts, lengths)
                hits = [(k[ok], start[ok], at[ok])]
                for run_ids, ks in short.items():
                    same = np.ones(max(0, len(ids) - len(run_ids) + 1), bool)
                    for j, i in enumerate(run_ids):
                        same &= ids[j:j + len(same)] == i
                    p = np.flatnonzero(same)
                    hits += [(np.full(len(p), one), p, p) for one in ks]
                k, start, at = (np.concatenate(c) for c in zip(*hits))
                doc, side = np.searchsorted(starts, at, "right") - 1, 4 * lengths[k] // 5 + 1
                lo, hi = np.maximum(start - side, starts[doc]), np.minimum(start + lengths[k] + side, starts[doc + 1] - PAD)
                order = np.lexsort((hi, lo, doc, k))
                merged = []
                for one, d, lo_, hi_ in zip(*(c[order].tolist() for c in (k, doc, lo, hi))):
                    if merged and merged[-1][:2] == [one, d] and lo_ <= merged[-1][3] \
                            and hi_ - merged[-1][2] <= 4 * int(lengths[one]) + 8:
                        merged[-1][3] = max(hi_, merged[-1][3])
                    else:
                        merged.append([one, d, lo_, hi_])
                listed = ids.tolist()
                for one, d, lo_, hi_ in merged:
                    words = listed[lo_:hi_]
                    missing = len(words_of[one]) - len(words_of[one].intersection(words))
                    if missing <= (1 - LEAST) * int(lengths[one]) + 1e-6:
                        out[0].append(docs_of[s + d])
                        out[1].append(one)
                        out[2].append(lo_ - int(starts[d]))
                        out[3].append(words)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int32()),
                 pa.array(out[3], pa.list_(pa.int32()))], names=["doc_id", "item", "first", "words"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, WINDOWS)


def align(words, item):
    """Smith-Waterman: best score, and the first and last word of the aligned part of ``words``."""
    import numpy as np

    n = len(item)
    whole = np.array(words, "<i4").tobytes().find(np.array(item, "<i4").tobytes())
    if whole >= 0 and whole % 4 == 0:  # nothing scores better than the whole item
        return MATCH * n, whole // 4, whole // 4 + n - 1
    item = np.asarray(item)
    column = np.arange(n + 1)
    score, begin = np.zeros(n + 1, "i8"), np.full(n + 1, -1, "i8")
    best = (0, 0, -1)
    for k, w in enumerate(words):
        step = np.where((item == w) & (w >= 0), MATCH, MISMATCH)
        new, start = np.zeros(n + 1, "i8"), np.full(n + 1, k + 1, "i8")
        diag, up = score[:-1] + step, score[1:] + GAP
        from_diag = np.where(score[:-1] > 0, begin[:-1], k)
        new[1:] = np.maximum(0, np.maximum(diag, up))
        start[1:] = np.where(diag >= up, from_diag, begin[1:])
        run = new - GAP * column  # a gap in the item: the best cell to the left, less the way
        top = np.maximum.accumulate(run)
        left = top + GAP * column
        source = np.maximum.accumulate(np.where(run == top, column, 0))
        better = left > new
        new[better], start[better] = left[better], start[source[better]]
        score, begin = new, start
        j = int(score.argmax())
        if score[j] > best[0]:
            best = (int(score[j]), int(begin[j]), k)
    return best


def leaks(docs, benchmark, least=LEAST):
    """doc_id, item_id, score (1: whole item), first_word and last_word of the best passage of each leaked item.

    ``least``: ``LEAST`` or more, for which the windows are cut.
    """
    import pyarrow as pa

    spark = docs.sparkSession
    found = None
    for block in item_blocks(benchmark):
        known = {w: k for k, w in enumerate(sorted({w for _, words in block for w in words}))}
        windows = find_windows(docs, block, known)
        items = spark.createDataFrame(pa.table({
            "item": pa.array(range(len(block)), pa.int64()), "item_id": pa.array([i for i, _ in block], pa.int64()),
            "item_words": pa.array([[known[w] for w in words] for _, words in block], pa.list_(pa.int32()))}))
        part = materialize(_aligned(windows.join(items, "item"), least), "leaks")
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], "doc_id long, item_id long, score double, first_word int, last_word int")
    best = F.max(F.struct("score", (-F.col("first_word")).alias("f"), "last_word")).alias("best")
    return found.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", F.col("best.score").alias("score"), (-F.col("best.f")).alias("first_word"),
        F.col("best.last_word").alias("last_word"))


def _aligned(pairs, least):
    def run(batches):
        import pyarrow as pa

        for b in batches:
            out = ([], [], [], [], [])
            for doc, item_id, first, words, item in zip(*(c.to_pylist() for c in b.columns)):
                score, lo, hi = align(words, item)
                if score >= least * MATCH * len(item):
                    for col, v in zip(out, (doc, item_id, score / (MATCH * len(item)), first + lo, first + hi)):
                        col.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64()),
                 pa.array(out[3], pa.int32()), pa.array(out[4], pa.int32())],
                names=["doc_id", "item_id", "score", "first_word", "last_word"])

    return pairs.select("doc_id", "item_id", "first", "words", "item_words").mapInArrow(
        run, "doc_id long, item_id long, score double, first_word int, last_word int")


@query("op5_decontamination")
def op5(spark, sf):
    return leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
