"""Toxicity by a learned lexicon: Levenshtein automata on a lexicon trie, and context windows around each hit.

Learning, on a sample of at most ``PER_CLASS`` labelled documents of each class: terms are words and word starts; a term
enters the lexicon if it separates the classes clearly (log odds less their standard error) and no longer term covers
the same documents. Near-copies of one document count once. The lexicon is a trie; a word's edit distance to all
entries is computed by walking the trie with one row of the automaton per node, for all words of a part of a batch at
once, and leaving a branch when no word can come within its distance. What a hit is worth, by entry and by distance, and
how much less inside a quotation, is estimated on the same sample; what is likelier harmless is left out. A document's score
is the chance that one of its words with a hit is abuse.

Defined results: an empty or null text scores 0; repeated rows score alike; several labels of one document count as the
largest; without labelled texts of both classes nothing is learned and all scores are 0; only id and text of documents and id
and toxic of labels are read.
"""

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import functions as F

from .common import fold, query, small, table, worker_state

#: Labelled documents of each class that the lexicon is learned from.
PER_CLASS = 10_000
#: Letters of the shortest term, and of the longest start of a word; words themselves are terms whatever their length.
LEAST, LONGEST = 3, 14
#: Letters of words that are compared with the trie at a time.
LETTERS = 1_500_000
WORDS = re.compile(r"[^\W_]+(?:[@$!*'’]+[^\W_]+)*")
WINDOW = 60
#: Distance that no entry reaches.
FAR = 1 << 20
#: Counts that a task holds before it sends them on.
HELD = 200_000
#: What a hit at edit distance 1 or 2 is worth beside an exact one, the weight of such priors in documents, and the prior
#: of a quotation.
FUZZY, WEIGHT, QUOTED = (1.0, 0.75, 0.65), 2.0, 0.35
#: Chances of abuse from which an entry, and a misspelling of one, count.
SURE, LIKELY = 0.75, 0.6
#: Fixed value: verbs and nouns that announce a quotation, in the languages of the corpus.
REPORTS = ("said says wrote writes quote quoted quotes called calls word term slur spelled dijo dice escribió palabra "
           "sagte sagt schrieb wort dit écrit écrivit mot").split()
REPORT = re.compile(r"\b(?:" + "|".join(REPORTS) + r")\b\W*(?:\w+\W+){0,3}$")
OPEN, CLOSE = "\"“„«‘", "\"”“»’"


def terms(text):
    """Words (marked with $) and starts of words of a text, each once."""
    found = set()
    for w in set(WORDS.findall(text.lower())):
        if LEAST <= len(w):
            found.add(w + "$")
            for n in range(LEAST, min(len(w), LONGEST) + 1):
                found.add(w[:n])
    return found


def sketch(text):
    """Smallest hash of three-word runs: near-copies mostly share it."""
    from xxhash import xxh64_intdigest

    w = text.lower().split()
    return min((xxh64_intdigest(" ".join(w[i:i + 3]).encode()) for i in range(max(1, len(w) - 2))), default=0) >> 1


def sample(docs, labels, per_class):
    """doc text and label of a bounded sample of labelled documents outside the held-out fold."""
    toxic = labels.filter(F.col("toxic").isNotNull() & (fold("doc_id", 5) != 0)) \
        .groupBy(F.col("doc_id").alias("label_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    pick = [toxic.filter(F.col("toxic") == v).orderBy(F.xxhash64("label_id"), "label_id").limit(per_class) for v in (0, 1)]
    known = F.broadcast(pick[0].unionByName(pick[1]))  # at most 2 * per_class rows of two numbers
    totals = {r["toxic"]: r["n"] for r in toxic.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    return docs.filter("text is not null").join(known, docs["doc_id"] == known["label_id"]).select("text", "toxic"), totals


def learn_lexicon(rows, totals):
    """{entry: {distance: chance of abuse}} and the factor of quotations, from the sample.

    The sample is halved by sketch. Each half picks entries, and the other half tells what they are worth, so a term that
    only happened to separate one half is found out.
    """
    def marked(batches):
        for b in small(batches, fresh=True):
            t = b.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(map(sketch, t), pa.int64())],
                                             names=["text", "toxic", "sketch"])

    if set(totals) != {0, 1}:
        return {}, 1.0
    half = F.pmod(F.xxhash64("sketch"), F.lit(2)).cast("int").alias("half")
    rows = rows.mapInArrow(marked, "text string, toxic int, sketch long") \
        .groupBy("sketch").agg(F.min(F.struct("toxic", "text")).alias("r")).select("r.text", "r.toxic", half).persist()
    try:
        return _learn(rows, totals)
    finally:
        rows.unpersist()


def _learn(rows, totals):
    sizes = Counter({(r["half"], r["toxic"]): r["n"] for r in
                     rows.groupBy("half", "toxic").agg(F.count(F.lit(1)).alias("n")).collect()})
    if not all(sizes[0, k] + sizes[1, k] for k in (0, 1)):
        return {}, 1.0
    halves = (0, 1)
    if min(sizes[h, k] for h in (0, 1) for k in (0, 1)) == 0:  # too few to judge by another half: all of them pick and judge
        rows, halves = rows.withColumn("half", F.lit(0)), (0,)
        sizes = Counter({(0, k): sizes[0, k] + sizes[1, k] for k in (0, 1)})

    def count(wanted, kind):
        def emitted(seen):
            return pa.RecordBatch.from_arrays(
                [pa.array([k[1] for k in seen], pa.string()), pa.array([k[0] for k in seen], pa.int32()),
                 pa.array(list(seen.values()), pa.int64())], names=["term", "half", "n"])

        def run(batches):
            seen = Counter()
            for b in small(batches, fresh=True):
                for t, h in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    found = terms(t)
                    seen.update((h, x) for x in (found if wanted is None else found & wanted))
                    if len(seen) >= HELD:
                        yield emitted(seen)
                        seen = Counter()
            yield emitted(seen)

        part = rows.filter(F.col("toxic") == kind).select("text", "half").mapInArrow(run, "term string, half int, n long")
        return part.groupBy("term", "half").agg(F.sum("n").alias("n"))

    least = {h: max(3, sizes[h, 1] // 500) for h in (0, 1)}  # a half that isn't there has no rows
    enough = F.col("n") >= F.when(F.col("half") == 0, least[0]).otherwise(least[1])
    toxic = {(r["half"], r["term"]): r["n"] for r in count(None, 1).filter(enough).collect()}
    clean = Counter({(r["half"], r["term"]): r["n"] for r in count({t for _, t in toxic}, 0).collect()})
    picked = defaultdict(set)  # entry: halves that picked it
    for h in halves:
        for entry in pick({t: n for (x, t), n in toxic.items() if x == h}, sizes[h, 1],
                          Counter({t: n for (x, t), n in clean.items() if x == h}), sizes[h, 0]):
            picked[entry].add(h)
    # weights that give the classes their share among all labels, at the size of the sample
    whole = sum(sizes.values())
    scale = [totals[k] / (totals[0] + totals[1]) * whole / (sizes[0, k] + sizes[1, k]) for k in (0, 1)]
    rate = totals[1] / (totals[0] + totals[1])
    judges = {e: (0, 1) if len(by) == 2 else halves if len(halves) == 1 else (1 - min(by),) for e, by in picked.items()}
    exact = {}
    for e, by in judges.items():
        t, c = (scale[k] * sum(n.get((h, e), 0) for h in by) for k, n in ((1, toxic), (0, clean)))
        p = (t + WEIGHT * rate) / (t + c + WEIGHT)
        if p >= SURE:
            exact[e] = (p, t)
    trie = build_trie(sorted(exact))

    def hits(batches):
        seen = Counter()
        for b in small(batches, fresh=True):
            texts, kinds, halves = (c.to_pylist() for c in b.columns)
            for t, kind, h, found in zip(texts, kinds, halves, _found(texts, trie)):
                best = {}
                for at in found.values():
                    for entry, distance in at:
                        best[entry] = min(best.get(entry, 9), distance)
                for entry, distance in best.items():
                    seen[entry, distance, kind, h] += 1
                if any(d == 0 for d in best.values()):
                    quoted = [is_quoted(t, m.start(), m.end()) for m in WORDS.finditer(t.lower()) if m[0] in found]
                    seen["", int(all(quoted)), kind, h] += 1
        keys = list(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), *[pa.array([k[i] for k in keys], pa.int32()) for i in (1, 2, 3)],
             pa.array([seen[k] for k in keys], pa.int64())], names=["entry", "distance", "toxic", "half", "n"])

    found = rows.mapInArrow(hits, "entry string, distance int, toxic int, half int, n long") \
        .groupBy("entry", "distance", "toxic", "half").agg(F.sum("n").alias("n")).collect()
    seen = defaultdict(float)
    for r in found:
        if not r["entry"] or r["half"] in judges[r["entry"]]:
            seen[r["entry"], r["distance"], r["toxic"]] += r["n"] * scale[r["toxic"]]

    def chance(entry, d, prior):
        t, c = seen[entry, d, 1], seen[entry, d, 0]
        return (t + WEIGHT * prior) / (t + c + WEIGHT)

    worth = {}
    for e, (p, _) in exact.items():
        near = {d: chance(e, d, p * FUZZY[d]) for d in range(1, reach(e) + 1)}
        worth[e] = {0: p} | {d: x for d, x in near.items() if x >= LIKELY}
    return worth, chance("", 1, QUOTED)


def pick(toxic, n1, clean, n0):
    """Terms that separate the classes clearly, the longest that cover the same documents, none vague or within another."""
    def odds(term):
        t, c = toxic[term], clean[term]
        value = math.log((t + .5) / (n1 - t + .5)) - math.log((c + .5) / (n0 - c + .5))
        return value - 1.64 * math.sqrt(1 / (t + .5) + 1 / (c + .5))

    longer = defaultdict(int)  # most documents that a one letter longer term covers
    for t, n in toxic.items():
        longer[t[:-1]] = max(longer[t[:-1]], n)
    vague = {u[:k] for u, n in toxic.items() for k in range(LEAST, len(u))
             if n >= 0.85 * toxic.get(u[:k], n + 1) and clean[u] < clean[u[:k]]}
    good = [t for t, n in toxic.items() if t not in vague and longer[t] < 0.98 * n and odds(t) > math.log(3) and clean[t] * n1 < 0.05 * n * n0]
    lexicon = set()
    for t in sorted(good, key=lambda t: (len(t), t)):
        if not any(t[:k] in lexicon for k in range(LEAST, len(t))):
            lexicon.add(t)
    return sorted(lexicon, key=lambda t: (-odds(t), t))


def reach(entry):
    """Edits allowed to an entry: fewer for short ones and for starts of words."""
    n = len(entry.rstrip("$"))
    return (0 if n < 5 else 1 if n < 8 else 2) if entry.endswith("$") else (0 if n < 6 else 1)


def build_trie(lexicon):
    """Nodes as dicts: letter to child, '' to the entries that end there, 'reach' to the largest reach below."""
    root = {"reach": 0}
    for entry in lexicon:
        node, most = root, reach(entry)
        for ch in entry.rstrip("$"):
            node["reach"] = max(node["reach"], most)
            node = node.setdefault(ch, {"reach": most})
        node["reach"] = max(node["reach"], most)
        node.setdefault("", []).append((entry, most))
    return root


def _entries(trie):
    found, open_ = [], [trie]
    while open_:
        node = open_.pop()
        found += [e for e, _ in node.get("", ())]
        open_ += [child for ch, child in node.items() if len(ch) == 1]
    return found


def _masks(letters):
    """One bit per letter of each row (letters may share a bit)."""
    import numpy as np

    bits = np.where(letters == 0, np.uint64(0), np.uint64(1) << (letters & 63).astype("u8"))
    return np.bitwise_or.reduce(bits, axis=1)


def match_words(words, trie):
    """{word: [(entry, distance)]} of the words within reach of an entry.

    A letter of an entry that a word lacks costs an edit, so words that lack more letters of every entry than its reach
    never enter the trie. Of a word only as many letters count as the longest entry and its reach have, and one more.
    """
    import numpy as np

    entries = _entries(trie)
    if not words or not entries:
        return {}
    width = max(len(e.rstrip("$")) + reach(e) + 1 for e in entries)
    letters = np.array(words, dtype=f"U{width}").view("u4").reshape(len(words), width)
    have, near = ~_masks(letters), np.zeros(len(words), bool)
    for e in entries:
        own = _masks(np.array([e.rstrip("$")], dtype=f"U{width}").view("u4").reshape(1, width))[0]
        near |= np.bitwise_count(have & own) <= reach(e)
    words = [w for w, ok in zip(words, near) if ok]
    if not words:
        return {}
    letters = letters[near]
    length = np.array([min(len(w), width) for w in words])
    column = np.arange(width + 1, dtype="i4")
    past = column[None, :] > length[:, None]
    first = np.where(past, FAR, column).astype("i4")
    out = defaultdict(list)

    open_ = [(trie, first, np.arange(len(words)))]
    while open_:
        node, rows, who = open_.pop()
        for entry, most in node.get("", ()):
            d = rows[np.arange(len(who)), length[who]] if entry.endswith("$") else rows.min(axis=1)
            for k in np.flatnonzero(d <= most):
                out[words[who[k]]].append((entry, int(d[k])))
        for ch, child in node.items():
            if len(ch) == 1:
                step = np.minimum(rows[:, :-1] + (letters[who] != ord(ch)), rows[:, 1:] + 1)
                full = np.concatenate([rows[:, :1] + 1, step], axis=1)
                full = np.minimum.accumulate(full - column, axis=1) + column
                full[past[who]] = FAR
                stay = np.flatnonzero(full.min(axis=1) <= child["reach"])
                if len(stay):
                    open_.append((child, full[stay], who[stay]))
    return out


def _found(texts, trie):
    """For each text the words with hits: {word: [(entry, distance)]}."""
    found, at = [], 0
    width = max((len(e) for e in _entries(trie)), default=0) + 4
    while at < len(texts):
        size, end, own = 0, at, []
        while end < len(texts) and (size < 2_000_000 or end == at):
            t = texts[end] or ""
            own.append(set(WORDS.findall(t.lower())))
            size += len(t)
            end += 1
        words = list(set().union(*own))
        hits, many = {}, max(1, LETTERS // width)
        for k in range(0, len(words), many):
            hits.update(match_words(words[k:k + many], trie))
        found += [{w: hits[w] for w in s & hits.keys()} for s in own]
        at = end
    return found


def is_quoted(text, start, end):
    """Whether a hit stands between quotation marks of its window or after a word that announces a quotation."""
    before, after = text[max(0, start - WINDOW):start], text[end:end + WINDOW]
    opened = max(before.rfind(c) for c in OPEN)
    if opened >= 0 and any(c in after for c in CLOSE) and sum(before.count(c) for c in "\"") % 2 == (before[opened] == '"'):
        return True
    return bool(REPORT.search(before.lower()))


def score_text(text, found, worth, inside):
    """Chance that one of the words with a hit is abuse."""
    if not found:
        return 0.0
    best = {}
    for m in WORDS.finditer(text.lower()):
        p = max((worth[entry].get(distance, 0.0) for entry, distance in found.get(m[0], ())), default=0.0)
        if p:
            p *= inside if is_quoted(text, m.start(), m.end()) else 1.0
            best[m[0]] = max(best.get(m[0], 0.0), p)
    return 1 - math.prod(1 - p for p in best.values())


def toxic_score(docs, labels, per_class=PER_CLASS):
    """Column of scores for a frame with a text column; the lexicon is learned from the labels of ``docs`` first."""
    rows, totals = sample(docs.select("doc_id", "text"), labels.select("doc_id", "toxic"), per_class)
    worth, inside = learn_lexicon(rows, totals)
    trie = build_trie(sorted(worth))

    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        worker_state().clear()
        for t in texts:
            out = []
            for part in small([t]):
                own = part.to_pylist()
                out += [score_text(x or "", f, worth, inside) for x, f in zip(own, _found(own, trie))]
            yield pa.array(out, pa.float64())

    return F.arrow_udf(score, "double")("text")


@query("op4_toxicity")
def op4(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    score = F.col("score")
    return docs.select("doc_id", F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
                       toxic_score(docs, table(spark, sf, "labels")).alias("score")) \
        .withColumn("predicted", (score >= 0.5).cast("int"))
