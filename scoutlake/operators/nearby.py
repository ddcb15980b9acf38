"""Pairs of similar texts, found by what is left of both once the letters only one of them has are deleted."""

from hashlib import blake2b
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from ..session import materialize

# Most rests of a text for one number of deletions, most words and letters of a text that has rests.
MOST, WORDS, LETTERS = 250, 4, 64
BUCKET_KEYS = 1_000_000
_STEP, _MIX, _END = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB


def deletions(n, m, total, threshold):
    """Letters to delete from texts of n and m letters so that one rest is equal if 1 - d / total reaches the threshold.

    The most insertions and deletions d between them follow from the threshold; d has the parity of n - m, and with
    d or fewer the common subsequence has (n + m - d) / 2 letters or more, so a rest of just that length is shared.
    None where the lengths alone are too far apart.
    """
    d = min(int(total * (1.0 - threshold) + 1e-9), n + m)
    d -= (d - n + m) % 2
    return None if d < abs(n - m) else ((d + n - m) // 2, (d - n + m) // 2)


def _parts(items):
    """(kept, rest) of all ways to set words aside that both texts have."""
    for k in range(len(items)):
        for kept in combinations(range(len(items)), k):
            yield [items[i] for i in kept], [x for i, x in enumerate(items) if i not in kept]


def plan(profile, threshold, sides):
    """(deletions per text length, lengths of texts that need other keys, keys in all).

    ``profile`` has (field, role, word lengths, length, texts). Pairs of lengths for which either text had more than
    ``MOST`` rests, and texts without rests (no word lengths), meet by other keys, which both sides then have.
    """
    held, whole, many, lists = {}, {}, {}, []
    for field, role, lens, size, n in profile:
        whole.setdefault((field, role), set()).add(size)
        if not lens:
            many.setdefault((field, role), set()).add(size)
        for kept, _ in _parts(lens):
            extra = sum(kept) + len(kept)
            held.setdefault((field, role, extra), set()).add(size - extra)
            lists.append(((field, role, extra, size - extra), n))
    cuts, slow = {}, set()
    for (field, role, extra), lengths in held.items():
        others = held.get((field, 1 - role if sides else role, extra), ())
        for n in lengths:
            found = cuts[field, role, extra, n] = set()
            for m in others:
                cut = deletions(n, m, n + m + 2 * extra, threshold)
                if cut and max(comb(n, cut[0]), comb(m, cut[1])) > MOST:
                    slow.add((field, role, n + extra))
                elif cut:
                    found.add(cut[0])
    for (field, role), sizes in many.items():
        slow.update((field, role, n) for n in sizes)
        other = 1 - role if sides else role
        slow.update((field, other, m) for m in whole.get((field, other), ()) if m >= min(sizes) * threshold / (2 - threshold) - 1)
    total = sum(n * sum(comb(key[3], x) for x in cuts[key]) for key, n in lists)
    return cuts, slow, total


def _hash(text):
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


def _end(h):
    h = (h ^ (h >> np.uint64(30))) * np.uint64(_MIX)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(_END)
    return h ^ (h >> np.uint64(31))


def rests(texts, x):
    """Hashes of all rests of texts of one length once x letters are deleted: a row for a text."""
    n = len(texts[0])
    letters = _end(np.array(texts, f"U{n}").view("u4").reshape(len(texts), n).astype("u8") + np.uint64(1)) if n else np.empty((len(texts), 0), "u8")
    cut = np.array(list(combinations(range(n), x)), "i8").reshape(comb(n, x), x)
    ends = np.column_stack([cut, np.full(len(cut), n)])
    starts = np.column_stack([np.zeros(len(cut), "i8"), cut + 1])
    out = np.zeros((len(texts), len(cut)), "u8")
    for k in range(x + 1):      # letters after k deletions stand k places earlier
        power = np.array([pow(_STEP, i - k, 1 << 64) for i in range(n)], "u8")
        sums = np.zeros((len(texts), n + 1), "u8")
        np.cumsum(letters * power, axis=1, out=sums[:, 1:])
        out += sums[:, ends[:, k]] - sums[:, starts[:, k]]
    return out


def _split(text, by_word):
    """(words, their length as joined, whether the text has rests)."""
    words = sorted(set(text.split())) if by_word else [text] if text else []
    size = sum(map(len, words)) + len(words) - 1
    return words, size, len(words) <= WORDS and size <= LETTERS


def _batch_keys(pdf, cuts, slow, by_word, more):
    """(row, key) of a batch: the rests, and the keys ``more(words, role, whether the text needs other keys)``."""
    seeds = pdf["seed"].to_numpy("i8").view("u8")
    groups, rows, keys = {}, [], []
    other_rows, other_keys = [], []
    for at, (field, role, text) in enumerate(zip(pdf["field"].tolist(), pdf["role"].tolist(), pdf["value"].tolist())):
        words, size, short = _split(text, by_word)
        for key in more(words, role, not short or (field, role, size) in slow):
            other_rows.append(at)
            other_keys.append(_hash(key))
        if short:
            for kept, rest in _parts(words):
                both, rest = " ".join(kept), " ".join(rest)
                extra = len(both) + 1 if kept else 0
                if cuts.get((field, role, extra, len(rest))):
                    group = groups.setdefault((field, role, extra, len(rest)), ([], [], []))
                    group[0].append(at)
                    group[1].append(rest)
                    group[2].append(_hash(both) if kept else 0)
    for key, (at, rest, both) in groups.items():
        at = np.array(at, "i8")
        start = (seeds[at] + np.array(both, "u8") * np.uint64(_STEP))[:, None]
        for x in cuts[key]:
            h = _end(rests(rest, x) + start)
            rows.append(np.repeat(at, h.shape[1]))
            keys.append(h.ravel())
    if other_rows:
        at = np.array(other_rows, "i8")
        rows.append(at)
        keys.append(_end(np.array(other_keys, "u8") + seeds[at] * np.uint64(_MIX)))
    return (np.concatenate(rows), np.concatenate(keys)) if rows else (np.empty(0, "i8"), np.empty(0, "u8"))


def _unique(keys, refs):
    order = np.lexsort((refs, keys))
    keys, refs = keys[order], refs[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (refs[1:] != refs[:-1])
    return keys[new], refs[new]


def _runs(keys):
    """First place and length of the runs of equal keys."""
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, "i8")
    return first, np.diff(np.append(first, len(keys)))


def _meet(keys, refs, few):
    """(src, dst) of rows of one side that share a key of at most ``few`` rows, and (key, ref) of larger keys."""
    slot = (keys & np.uint64((1 << 24) - 1)).astype("i8")
    keep = np.bincount(slot, minlength=1 << 24)[slot] > 1
    keys, refs = _unique(keys[keep], refs[keep])
    first, size = _runs(keys)
    size = np.repeat(size, size)
    small = (size > 1) & (size <= few)
    k, r = keys[small], refs[small]
    src, dst = [], []
    for step in range(1, few):
        same = np.flatnonzero(k[step:] == k[:-step]) if len(k) > step else np.empty(0, "i8")
        src.append(r[same])
        dst.append(r[same + step])
    big = size > few
    return np.concatenate(src), np.concatenate(dst), [(keys[big], refs[big], 0)]


def _meet_sides(keys, refs, other_keys, other_refs, few):
    """(src, dst) of rows of both sides that share a key of at most ``few`` pairs, and (key, ref) of larger keys."""
    def known(of, by):
        slots = np.zeros(1 << 24, bool)
        slots[(by & np.uint64((1 << 24) - 1)).astype("i8")] = True
        return slots[(of & np.uint64((1 << 24) - 1)).astype("i8")]

    keep, back = known(keys, other_keys), known(other_keys, keys)
    keys, refs = _unique(keys[keep], refs[keep])
    other_keys, other_refs = _unique(other_keys[back], other_refs[back])
    first, size = _runs(keys)
    mine = keys[first]
    lo, hi = np.searchsorted(other_keys, mine, "left"), np.searchsorted(other_keys, mine, "right")
    found = hi > lo
    first, size, lo, count = first[found], size[found], lo[found], (hi - lo)[found]
    big = size * count > few

    def rows(first, size):
        return np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())

    at = rows(first[~big], size[~big])
    wide = np.repeat(count[~big], size[~big])
    src = np.repeat(refs[at], wide)
    dst = other_refs[rows(np.repeat(lo[~big], size[~big]), wide)]
    return src, dst, [(keys[rows(first[big], size[big])], refs[rows(first[big], size[big])], 0),
                      (other_keys[rows(lo[big], count[big])], other_refs[rows(lo[big], count[big])], 1)]


def near_pairs(rows, threshold, few, sides=True, by_word=True, others=lambda needed: lambda words, role, slow: ()):
    """(pairs (src, dst), large keys (key, ref, role)) of texts that share a key.

    ``rows`` has ref and seed (long), field and role (int), value. Texts of one seed and field (and, with ``sides``, of
    roles 0 and 1) whose similarity 1 - d / (length of both) reaches the threshold share a key; d are the insertions and
    deletions, ``by_word`` counted between the sorted words without those that both have (every set of words is set
    aside in turn). ``others(whether a text needs other keys)`` gives the function of further keys of a text.
    Keys are hashes: what meets is to be compared. Keys travel as bytes, a row for a batch and bucket.
    Of keys with more than ``few`` pairs (without sides: rows) the rows are returned, not the pairs.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = materialize(rows.repartition(parts, "ref"), "texts")

    def lengths(batches):
        for pdf in batches:
            seen = {}
            for field, role, text in zip(pdf["field"].tolist(), pdf["role"].tolist(), pdf["value"].tolist()):
                words, size, short = _split(text, by_word)
                if words:
                    key = field, role, tuple(sorted(map(len, words))) if short else (), min(size, LETTERS + 1)
                    seen[key] = seen.get(key, 0) + 1
            yield pd.DataFrame([(f, r, list(lens), size, n) for (f, r, lens, size), n in seen.items()],
                               columns=["field", "role", "lens", "size", "n"])

    profile = (rows.select("field", "role", "value")
               .mapInPandas(lengths, "field int, role int, lens array<int>, size int, n long")
               .groupBy("field", "role", "lens", "size").agg(F.sum("n")).collect())
    cuts, slow, total = plan(profile, threshold, sides)
    cuts, more = {k: sorted(v) for k, v in cuts.items()}, others(bool(slow))
    buckets = max(1, min(2 * parts, total // 100_000), total // BUCKET_KEYS)

    def spread(batches):
        for pdf in batches:
            refs, role = pdf["ref"].to_numpy("i8"), pdf["role"].to_numpy("i8")
            at, keys = _batch_keys(pdf, cuts, slow, by_word, more)
            out = []
            for side in (0, 1):
                mine = role[at] == side
                k, r = keys[mine], refs[at[mine]]
                bucket = ((k >> np.uint64(32)) % np.uint64(buckets)).astype("i4")
                order = np.argsort(bucket, kind="stable")
                k, r, bucket = k[order], r[order], bucket[order]
                first, size = _runs(bucket)
                out += [(int(bucket[f]), side, k[f:f + s].tobytes(), r[f:f + s].tobytes()) for f, s in zip(first, size)]
            yield pd.DataFrame(out, columns=["bucket", "role", "keys", "refs"])

    def meet(pdf):
        both = []
        for side in (0, 1):
            of = pdf[pdf["role"] == side]
            both += [np.frombuffer(b"".join(of["keys"]), "u8"), np.frombuffer(b"".join(of["refs"]), "i8")]
        src, dst, large = _meet_sides(*both, few) if sides else _meet(*both[:2], few)
        pairs = pd.DataFrame({"src": src, "dst": dst}).drop_duplicates().assign(key=np.int64(0), large=False)
        large = [pd.DataFrame({"src": refs, "dst": np.int64(role), "key": keys.view("i8"), "large": True}) for keys, refs, role in large]
        return pd.concat([pairs, *large])[["src", "dst", "key", "large"]]

    met = rows.mapInPandas(spread, "bucket int, role int, keys binary, refs binary").repartition(int(buckets), "bucket")
    met = materialize(met.groupBy("bucket").applyInPandas(meet, "src long, dst long, key long, large boolean"), "near")
    return (met.filter(~F.col("large")).select("src", "dst").distinct(),
            met.filter("large").select("key", F.col("src").alias("ref"), F.col("dst").cast("int").alias("role")))
