"""Alignment of the tokens that two tokenizers make of the same text, and how often ids meet across the corpus.

Both tokenizers cut the same bytes. Byte places where tokens of both end cut them into groups; the groups are found by pointer
jumping: every token points to its farthest-right overlapping token of the other side, and following the pointers, doubled
in every round for all tokens at once, ends at the one token that closes the group. Tokens of a group are linked, each of A with
each of B.

A blank or line end that stands between two other characters is a place where no token of either side may cross, so a
text is cut there, each worker aligns a word once, all new words of a batch in one array, and the words' results are put
together per document. White space of any other form stays inside its part.

The corpus-wide count of an id pair (documents that hold it linked) is summed per task before the shuffle. Counts go back to the
documents in two ways: the ``COMMON`` most frequent pairs as a sorted table sent to all tasks (24 bytes each), all other
pairs, none of them frequent, by a join.

Defined results: a text that is null, empty or not given back by both tokenizers has zeros and an empty digest; repeated rows
count each; markers such as end-of-text are ordinary text; an empty table gives no rows; columns other than id and text are not
read.
"""

from itertools import chain

from pyspark.sql import functions as F

from .common import materialize, query, small, table, worker_state
from .tokens import BYTE_SPLIT, Encoder, public_path

#: Pairs whose counts are sent to all tasks.
COMMON = 200_000
#: What a worker remembers at most: parts, links and bytes of their written groups.
MEMO, MEMO_LINKS, MEMO_BYTES = 250_000, 4_000_000, 64 << 20
#: Pairs that a task counts before it sends them on.
COUNTED = 1_000_000
#: A group with more links than this is linked by its different ids and their numbers.
LARGE = 4_096
SPACE = "▁"


def terminals(ends_a, ends_b):
    """For each token of A, then of B, the token of A that closes its group, by pointer jumping over their ends."""
    import numpy as np

    n = len(ends_a)
    to_b = np.searchsorted(ends_b, ends_a)
    own = np.arange(n)
    point = np.concatenate([np.where(ends_b[to_b] == ends_a, own, n + to_b), np.searchsorted(ends_a, ends_b)])
    while True:
        far = point[point]
        if np.array_equal(far, point):
            return point[:n], point[n:]
        point = far


def align(a, b, ends_a, ends_b):
    """Group numbers, from 0, of the tokens of A and of B."""
    import numpy as np

    if not len(a):
        return np.zeros(0, "i8"), np.zeros(0, "i8")
    ta, tb = terminals(ends_a, ends_b)
    rank = np.cumsum(ta == np.arange(len(a))) - 1
    return rank[ta], rank[tb]


def links(a, b, ga, gb):
    """Linked id pairs (A id in the upper half) and how often, in order of A; groups may be of any size."""
    import numpy as np

    start = np.searchsorted(gb, np.arange(gb[-1] + 2 if len(gb) else 1))
    per = np.diff(start)
    large = np.bincount(ga, minlength=len(per)) * per > LARGE
    each = np.where(large[ga], 0, per[ga])
    of_a = np.repeat(np.arange(len(a)), each)
    of_b = start[ga[of_a]] + np.arange(len(of_a)) - np.repeat(np.cumsum(each) - each, each)
    pairs, times = [a[of_a].astype("i8") << 32 | b[of_b]], [np.ones(len(of_a), "i8")]
    for g in np.flatnonzero(large):
        ida, na = np.unique(a[ga == g], return_counts=True)
        idb, nb = np.unique(b[gb == g], return_counts=True)
        pairs.append((ida.astype("i8")[:, None] << 32 | idb).ravel())
        times.append((na[:, None] * nb).ravel())
    return np.concatenate(pairs), np.concatenate(times), of_a


def written(a, b, ga, gb):
    """Each group as text: ids of A, a bar, ids of B."""
    import numpy as np

    ends = np.arange(ga[-1] + 2 if len(ga) else 1)
    at_a, at_b = np.searchsorted(ga, ends).tolist(), np.searchsorted(gb, ends).tolist()
    sa, sb = list(map(str, a.tolist())), list(map(str, b.tolist()))
    return [f"{sa[i] if j == i + 1 else ','.join(sa[i:j])}|{sb[k] if m == k + 1 else ','.join(sb[k:m])}"
            for i, j, k, m in zip(at_a, at_a[1:], at_b, at_b[1:])]


class Growing:
    """Array that takes more at its end."""

    def __init__(self, dtype):
        import numpy as np

        self.data, self.n = np.zeros(1 << 10, dtype), 0

    def add(self, values):
        import numpy as np

        if self.n + len(values) > len(self.data):
            self.data = np.concatenate([self.data[:self.n], np.zeros(max(len(self.data), len(values)), self.data.dtype)])
        self.data[self.n:self.n + len(values)] = values
        self.n += len(values)


class Aligner:
    """Alignment of a byte-level file (A) with a sentencepiece model (B), remembered per word."""

    def __init__(self, path_a, path_b):
        import re

        import numpy as np
        import regex
        import sentencepiece

        self.a = Encoder(path_a, "byte")
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        letter = {chr(c): b for b, c in self.a.letters.items()}
        with_ids = self.a.vocabulary()
        self.bytes_a = {i: bytes(letter[c] for c in token) for token, i in with_ids.items() if all(c in letter for c in token)}
        as_byte = re.compile("<0x([0-9A-F]{2})>").fullmatch
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(m[1], 16)]) if (m := as_byte(p)) else p.replace(SPACE, " ").encode() for p in pieces]
        if any(x != SPACE and y == SPACE for p in pieces for x, y in zip(p, p[1:])) or any("\n" in p for p in pieces):
            raise ValueError("a piece goes on after a blank, so texts can't be cut at blanks")
        self.len_a = np.zeros(max(self.bytes_a) + 1, "i8")
        self.len_a[list(self.bytes_a)] = [len(x) for x in self.bytes_a.values()]
        self.len_b = np.array([len(x) for x in self.bytes_b], "i8")
        self.blank = self.b.piece_to_id(SPACE)
        self.ids_a = self.ranked(path_a) or self.a.plain_ids
        self.cut = regex.compile(r"(?<=\S)(?= \S|\n\S)").split
        self.space = regex.compile(r"\s").search
        self.clear()

    def ranked(self, path):
        """Encoder by ranks, faster for single words, where the file's ids are in the order of its merges; else None."""
        import json

        import tiktoken

        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        ids = [model["vocab"].get(m.replace(" ", "") if isinstance(m, str) else "".join(m)) for m in model["merges"]]
        if self.a.has_own_split or ids != list(range(256, 256 + len(ids))) or len(self.bytes_a) != 256 + len(ids):
            return None
        return tiktoken.Encoding("ranked", pat_str=BYTE_SPLIT, mergeable_ranks={b: i for i, b in self.bytes_a.items()},
                                 special_tokens={}).encode_ordinary

    def clear(self):
        self.known, self.text, self.bytes = {}, [], 0
        self.sums = [Growing("i8") for _ in range(4)]
        self.good, self.uses = Growing(bool), Growing("i8")
        self.ends, self.pairs, self.times = Growing("i8"), Growing("i8"), Growing("i8")
        self.ends.add([0])

    def shrink(self):
        """Keep the parts that were used most, half of the memory, and forget the others."""
        import numpy as np

        order = np.argsort(-self.uses.data[:len(self.text)], kind="stable")
        links, size = np.diff(self.ends.data[:len(self.text) + 1]), np.array([len(t) for t in self.text])
        enough = (np.cumsum(links[order]) <= MEMO_LINKS // 2) & (np.cumsum(size[order]) <= MEMO_BYTES // 2)
        kept = np.sort(order[:MEMO // 2][enough[:MEMO // 2]])
        old, keys = dict(vars(self)), list(self.known)
        start, many = old["ends"].data[kept], links[kept]
        self.clear()
        at = np.repeat(start - np.cumsum(many) + many, many) + np.arange(many.sum())
        self.ends.add(np.cumsum(many))
        for name in ("good", "uses"):
            getattr(self, name).add(old[name].data[kept])
        for name in ("pairs", "times"):
            getattr(self, name).add(old[name].data[at])
        for own, was in zip(self.sums, old["sums"]):
            own.add(was.data[kept])
        for i, k in enumerate(kept.tolist()):
            self.known[keys[k]] = i
            self.text.append(old["text"][k])
            self.bytes += len(keys[k]) + len(self.text[-1])

    def parts(self, text):
        """Keys of the parts of blank + text: a word without its blank, or a part as it stands."""
        found = (" " + text).replace("\n", " \n").split(" ")
        del found[0]
        if all(map(self.plain, set(found).difference(self.known))):
            return found
        return self.cut(" " + text)

    def plain(self, part):
        """Whether a part is a word, with at most one line end before it."""
        if part.isalpha():
            return True
        word = part[1:] if part[:1] == "\n" else part
        return bool(word) and not (self.space(word[0]) or self.space(word[-1]))

    def ids_b(self, units):
        """Ids of parts by the model, which sets a blank before what it encodes; None where it isn't one id."""
        found = self.b.encode([u[1:] if u[0] == " " else u for u in units], num_threads=1)
        return [f if u[0] == " " else f[1:] if f[:1] == [self.blank] else None for u, f in zip(units, found)]

    def given_back(self, ids_a, ids_b, text):
        want = text.encode()
        return b"".join(map(self.bytes_a.__getitem__, ids_a)) == want and b"".join(map(self.bytes_b.__getitem__, ids_b)) == want

    def tokens(self, keys):
        """Ids of parts by both tokenizers, empty where they don't give back the bytes, and whether they do."""
        units = [k if k[0] in " \n" else " " + k for k in keys]
        a, b = list(map(self.ids_a, units)), self.ids_b(units)
        text = "".join(units)
        if SPACE in text or None in b or not self.given_back(chain.from_iterable(a), chain.from_iterable(b), text):
            good = [SPACE not in u and y is not None and self.given_back(x, y, u) for u, x, y in zip(units, a, b)]
            return [x if g else [] for x, g in zip(a, good)], [y if g else [] for y, g in zip(b, good)], good
        return a, b, [True] * len(keys)

    def learn(self, keys):
        """Align parts that are not known yet, all in one array."""
        import numpy as np

        if not keys:
            return
        ids_a, ids_b, good = self.tokens(keys)
        n_a, n_b = (np.fromiter(map(len, ids), "i8", len(keys)) for ids in (ids_a, ids_b))
        at_a, at_b = (np.concatenate([[0], np.cumsum(n)]) for n in (n_a, n_b))
        a, b = (np.fromiter(chain.from_iterable(ids), "i8") for ids in (ids_a, ids_b))
        ga, gb = align(a, b, np.cumsum(self.len_a[a]), np.cumsum(self.len_b[b]))
        groups = np.bincount(ga) if len(ga) else np.zeros(0, "i8")
        n_links = groups * np.bincount(gb) if len(ga) else groups
        g_at = np.concatenate([ga, [len(groups)]])[at_a]  # groups before each part
        sums = np.concatenate([[0], np.cumsum(n_links)])
        for own, more in zip(self.sums, (n_a, n_b, np.diff(g_at), np.diff(sums[g_at]))):
            own.add(more)
        self.good.add(good)
        self.uses.add(np.zeros(len(keys), "i8"))
        if (n_links <= LARGE).all():
            pairs, times, of_a = links(a, b, ga, gb)
            counts = np.diff(np.searchsorted(of_a, at_a))
        else:
            each = [links(a[i:j], b[k:m], ga[i:j] - g, gb[k:m] - g)[:2] for i, j, k, m, g in
                    zip(at_a, at_a[1:], at_b, at_b[1:], g_at)]
            pairs, times = (np.concatenate([e[s] for e in each]) for s in (0, 1))
            counts = np.array([len(e[0]) for e in each], "i8")
        self.ends.add(self.pairs.n + np.cumsum(counts))
        self.pairs.add(pairs)
        self.times.add(times)
        text = written(a, b, ga, gb)
        g_at = g_at.tolist()
        for k, i, j in zip(keys, g_at, g_at[1:]):
            self.known[k] = len(self.text)
            self.text.append(";".join(text[i:j]))
            self.bytes += len(self.text[-1]) + len(k)

    def documents(self, texts):
        """Per text (n_a, n_b, n_groups, n_links, written groups, pairs, times), or None without tokens."""
        import numpy as np

        if len(self.known) > MEMO or self.pairs.n > MEMO_LINKS or self.bytes > MEMO_BYTES:
            self.shrink()
        cut = [self.parts(t) if t else () for t in texts]
        self.learn([k for k in dict.fromkeys(chain.from_iterable(cut)) if k not in self.known])
        numbers = np.fromiter(map(self.known.__getitem__, chain.from_iterable(cut)), "i8")
        self.uses.data[:len(self.text)] += np.bincount(numbers, minlength=len(self.text))
        ends = np.concatenate([[0], np.cumsum(np.fromiter(map(len, cut), "i8", len(cut)))])
        totals = [np.diff(np.concatenate([[0], np.cumsum(v)])[ends])
                  for v in (~self.good.data[numbers], *(s.data[numbers] for s in self.sums))]
        begin = self.ends.data[numbers]
        many = self.ends.data[numbers + 1] - begin
        for i, (s, e) in enumerate(zip(ends, ends[1:])):
            if s == e or totals[0][i]:
                yield None
                continue
            n = many[s:e]
            at = np.repeat(begin[s:e] - np.cumsum(n) + n, n) + np.arange(n.sum())
            pairs, times = self.pairs.data[at], self.times.data[at]
            if (times == 1).all():
                pairs, times = np.unique(pairs, return_counts=True)
            else:
                pairs, place = np.unique(pairs, return_inverse=True)
                times, each = np.zeros(len(pairs), "i8"), times
                np.add.at(times, place, each)
            yield *(int(t[i]) for t in totals[1:]), ";".join(map(self.text.__getitem__, numbers[s:e].tolist())), pairs, times


def aligner(path_a, path_b):
    """The worker's aligner for two files."""
    state = worker_state()
    key = ("aligner", path_a, path_b)
    if key not in state:
        state[key] = Aligner(path_a, path_b)
    return state[key]


ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs binary, times binary"
#: Bytes of text that are cut into parts at a time.
BATCH = 1 << 20


def aligned(docs, path_a, path_b, digest=True):
    """Per document its numbers, written groups (``digest``: their SHA-256), its different linked pairs and how often each.

    ``pairs``: 64-bit numbers in bytes, A id in the upper half, ascending; ``times``: 64-bit numbers in bytes.
    """
    def compute(batches):
        import hashlib

        import numpy as np
        import pyarrow as pa

        both, none = aligner(path_a, path_b), np.zeros(0, "<i8")
        for batch in small(batches, BATCH):
            out = [[] for _ in range(7)]
            for found in both.documents(batch.column(1).to_pylist()):
                *numbers, text, pairs, times = found or (0, 0, 0, 0, "", none, none)
                if digest and found:
                    text = hashlib.sha256(text.encode()).hexdigest()
                for c, v in zip(out, (*numbers, text, pairs.astype("<i8").tobytes(), times.astype("<i8").tobytes())):
                    c.append(v)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, pa.int64()) for c in out[:4]], pa.array(out[4], pa.string()),
                 *[pa.array(c, pa.binary()) for c in out[5:]]],
                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(compute, ALIGNED)


def _flat(batch, name):
    """Numbers of a column of bytes, end to end."""
    import numpy as np

    return np.frombuffer(b"".join(batch.column(batch.schema.get_field_index(name)).to_pylist()), "<i8")


def _lengths(batch, name):
    """How many numbers each row of a column of bytes has."""
    import numpy as np

    return np.fromiter(map(len, batch.column(batch.schema.get_field_index(name)).to_pylist()), "i8") // 8


def pair_counts(rows):
    """a, b, n: how many documents hold a pair; best: whether no pair of the same A id has a higher n."""
    def count(batches):
        import numpy as np
        import pyarrow as pa

        def summed(held):
            pairs, place = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
            n = np.zeros(len(pairs), "i8")
            np.add.at(n, place, np.concatenate([h[1] for h in held]))
            return pairs, n

        def sent(pairs, n):
            return pa.RecordBatch.from_arrays([pa.array(pairs >> 32, pa.int64()), pa.array(pairs & 0xFFFFFFFF, pa.int64()), pa.array(n)],
                                              names=["a", "b", "n"])

        held = [(np.zeros(0, "i8"), np.zeros(0, "i8"))]
        for batch in small(batches):
            held.append(np.unique(_flat(batch, "pairs"), return_counts=True))
            if sum(len(h[0]) for h in held) > COUNTED:
                held = [summed(held)]
                if len(held[0][0]) > COUNTED // 2:
                    yield sent(*held[0])
                    held = [(np.zeros(0, "i8"), np.zeros(0, "i8"))]
        yield sent(*summed(held))

    n = rows.select("pairs").mapInArrow(count, "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))
    n = materialize(n, "pair-counts")
    top = n.groupBy("a").agg(F.max("n").alias("most")).withColumnRenamed("a", "of")
    return materialize(n.join(top, F.col("a") == F.col("of")).select("a", "b", "n", (F.col("n") == F.col("most")).alias("best")), "pair-counts")


def align_tokens(docs, path_a, path_b):
    """Per document: n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256."""
    rows = materialize(aligned(docs, path_a, path_b).withColumn("row", F.monotonically_increasing_id()), "aligned")
    counts = pair_counts(rows)
    common = counts.orderBy(F.desc("n"), "a", "b").limit(COMMON)
    sent = docs.sparkSession.sparkContext.broadcast(_sorted(common.collect()))  # at most COMMON pairs

    def add(batches):
        import numpy as np
        import pyarrow as pa

        pairs, n, best = sent.value
        for batch in small(batches):
            pair, times, lengths = _flat(batch, "pairs"), _flat(batch, "times"), _lengths(batch, "pairs")
            of = np.repeat(np.arange(len(lengths)), lengths)
            at = np.minimum(np.searchsorted(pairs, pair), max(0, len(pairs) - 1))
            hit = pairs[at] == pair if len(pairs) else np.zeros(len(pair), bool)
            sums = [np.zeros(len(lengths), "i8") for _ in range(2)]
            for own, value in zip(sums, (n, best)):
                np.add.at(own, of[hit], times[hit] * value[at[hit]])
            ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(of[~hit], minlength=len(lengths)))]).astype("i4"))
            rest = [pa.ListArray.from_arrays(ends, pa.array(v[~hit])) for v in (pair, times)]
            kept = [batch.column(batch.schema.get_field_index(c)) for c in KEPT]
            yield pa.RecordBatch.from_arrays([*kept, *[pa.array(s) for s in sums], *rest],
                                             names=[*KEPT, "count_sum", "n_best", "pairs", "times"])

    done = rows.select(*KEPT, "pairs", "times").mapInArrow(add, DONE)
    done = materialize(done, "aligned-sums")
    rare = done.filter("size(pairs) > 0").select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")) \
        .select("row", F.shiftright("p.pairs", 32).alias("a"), F.col("p.pairs").bitwiseAND(F.lit(0xFFFFFFFF)).alias("b"), "p.times")
    more = rare.join(counts, ["a", "b"]).groupBy("row").agg(
        F.sum(F.col("times") * F.col("n")).alias("more_sum"), F.sum(F.col("times") * F.col("best").cast("long")).alias("more_best"))
    return done.join(more, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"), F.col("groups").alias("groups_sha256"))


KEPT = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups"]
DONE = ("row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, count_sum long, n_best long, "
        "pairs array<long>, times array<long>")


def _sorted(rows):
    """Arrays of pairs in ascending order, their counts and whether they are the best of their A id."""
    import numpy as np

    pairs = np.array([r["a"] << 32 | r["b"] for r in rows], "i8")
    order = np.argsort(pairs)
    return pairs[order], np.array([r["n"] for r in rows], "i8")[order], np.array([r["best"] for r in rows], "i8")[order]


@query("op11_token_alignment")
def op11(spark, sf):
    return align_tokens(table(spark, sf, "documents"), public_path("byte_bpe_50k.json"), public_path("piece_bpe_32k.model"))
