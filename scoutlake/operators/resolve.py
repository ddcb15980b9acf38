"""Entity resolution across providers: fuzzy matching, duplicate merging, id rewriting."""

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from ..config import lookups as lk
from ..functions.numeric import _col
from ..functions.text import lcs_of_many, letter_codes, letter_mask, matching_share, slug, stable_id, word_set, word_set_score
from ..session import materialize
from .joins import map_column, outer_match
from .nearby import near_pairs
from .shape import (const_map, coalesce_columns, dedup, exact_group_size, fallback_positions,
                    greatest_of, map_by_formation, min_sample, repair_colours, resolve_position,
                    split_name)
from .windows import dedupe_best, join_counted, latest, top_positions

TILE_ROWS = 1000
FEW = 8
# Pairs of a shared key that are compared one by one, pairs in all that need no keys, and the score
# (one letter of eight exchanged) at which partners inside a block are looked up by keys.
KEY_PAIRS, BLOCK_PAIRS, NEAR = 4096, 50_000_000, 87.5


def _grams(c, q):
    """Distinct letter groups of a string: pairs, or threes with the ends marked."""
    text = F.concat(F.lit("^"), c, F.lit("$")) if q == 3 else c
    last = F.length(text) - (q - 1)
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))),
                                        lambda i: F.substring(text, i, F.lit(q))))


def _gram_size(threshold):
    """Letters per group: three where enough groups survive the allowed edits, else two."""
    return 3 if threshold > 6 / 7 else 2


def _words(c):
    return F.filter(F.array_sort(F.array_distinct(F.split(c, r"\s+"))), lambda w: w != "")


def _word_grams(words):
    """Distinct letter pairs inside the words, with the word ends marked."""
    return F.array_distinct(F.flatten(F.transform(words, lambda w: F.transform(
        F.sequence(F.lit(1), F.length(w) + 1),
        lambda i: F.substring(F.concat(F.lit("^"), w, F.lit("$")), i, F.lit(2))))))


def _rare_first(items, common):
    """Items in one fixed order, the frequent ones last."""
    if common:
        table = const_map(common)
        rank = lambda x: F.coalesce(F.try_element_at(table, x), F.lit(0))
    else:
        rank = lambda x: F.lit(0)
    return F.array_sort(F.transform(items, lambda x: F.struct(
        rank(x).alias("r"), F.xxhash64(x).alias("h"), x.alias("x"))))


def common_items(rows, items, n=400):
    """Rank of the n most frequent items: a short dictionary, for the order of keys only."""
    top = (rows.select(F.explode(items).alias("x")).filter("x IS NOT NULL").groupBy("x").agg(F.count("*").alias("n"))
           .orderBy(F.col("n").desc(), "x").limit(n).collect())
    return {r["x"]: len(top) - i for i, r in enumerate(top)}


def _edits(n, threshold):
    """Most insertions and deletions between a string of length n and a partner at the threshold."""
    return F.floor(2.0 * n * (1.0 - threshold) / threshold + 1e-9).cast("int")


def _check(threshold):
    if threshold < 0.85:
        raise ValueError("letter-pair keys need a threshold of at least 0.85")


def edit_keys(c, threshold, common=None):
    """Keys of which two strings share at least one if their similarity reaches the threshold.

    With similarity s = 1 - d / (len a + len b), d insertions and deletions, a
    string of length n differs from a partner in at most
    d = floor(2 n (1 - s) / s) places, and each place touches q groups of q
    letters.  So at most q d of its distinct groups are missing in the partner,
    and the first q d + 1 of both in one fixed order have one in common (strings
    with d = 0 must be equal).  Holds where at least one group always survives:
    pairs from 0.85, threes with marked ends above 6/7.  ``common`` puts frequent
    groups last.
    """
    _check(threshold)
    c = _col(c)
    q = _gram_size(threshold)
    n = F.length(c)
    d = _edits(n, threshold)
    first = F.slice(_rare_first(_grams(c, q), common), F.lit(1), F.greatest(q * d + 1, F.lit(1)))
    keys = F.transform(first, lambda s: F.concat(F.lit("g:"), s["x"]))
    none = F.array().cast("array<string>")
    return F.when(n > 0, F.array_union(F.array(F.concat(F.lit("="), c)), F.when(d > 0, keys).otherwise(none)))


def close_keys(text, threshold, common):
    """Keys of which two strings share at least one if their similarity reaches the threshold, few strings a key.

    With d as in ``edit_keys``: up to two deletions and insertions leave the same rest of both strings once the letters
    only one of them has are deleted, so the rests of a short string (d up to 2, and strings up to 2 longer) are its
    keys.  For longer strings, of the distinct groups in one fixed order the first two that both have are among the
    first q d + 2 of each, so the keys are pairs of those.  That needs two common groups, which either string grants if
    it has q d + 2 groups; strings with fewer get the single groups of ``edit_keys`` as well, by which they meet.
    """
    if not text:
        return []
    q, n = _gram_size(threshold), len(text)

    def edits(length):
        return int(2.0 * length * (1.0 - threshold) / threshold + 1e-9)

    d, keys = edits(n), set()
    if edits(n - 2) <= 2:
        for cut in range(min(d, 2, n - 1) + 1):
            keys.update("d:" + "".join(kept) for kept in combinations(text, n - cut))
    if d > 2:
        marked = f"^{text}$" if q == 3 else text
        grams = sorted({marked[i:i + q] for i in range(len(marked) - q + 1)}, key=lambda g: (common.get(g, 0), g))
        keys.update("p:" + a + b for a, b in combinations(grams[:q * d + 2], 2))
        if len(grams) < q * d + 2:
            keys.update("g:" + g for g in grams[:q * d + 1])
    return list(keys)


def word_keys(words, role, slow, threshold, common_words, common_grams):
    """Keys of which two texts of different roles share at least one where the shared words alone reach the threshold.

    The word-set score is the best of three ratios. Comparing one side with the shared words alone, the words it does
    not share are shorter than 2 (1 - s) of it, so a few of its rarest words, longer than that together, meet all words
    of the other side. For the third ratio, between the words that differ, the texts share a rest (``near_pairs``).
    Texts with too many rests (``slow``) meet by letter pairs: an edit touches two of those inside words, so the rarest
    2 d + 1 pairs of both sides meet.
    """
    n = sum(map(len, words)) + len(words) - 1
    few, size = [], 0
    for w in sorted(words, key=lambda w: (common_words.get(w, 0), w)):
        if max(size - 1, 0) > 2.0 * (1.0 - threshold) * n + 1e-9:
            break
        few.append(w)
        size += len(w) + 1
    keys = [("a:" if role == 0 else "b:") + w for w in few] + [("b:" if role == 0 else "a:") + w for w in words]
    if slow:
        grams = {pair for w in words for pair in map("".join, zip(f"^{w}", f"{w}$"))}
        edits = int(2.0 * n * (1.0 - threshold) / threshold + 1e-9)
        keys += ["g:" + g for g in sorted(grams, key=lambda g: (common_grams.get(g, 0), g))[:2 * edits + 1]]
    return keys


def _tiles(rows, keys, fn, schema, tile_rows, sides=True):
    """Run ``fn`` on tiles of the rows that share a key.

    Rare keys are packed together by hash, a frequent key is cut into a grid of
    tiles (first side by second side), so every task holds a bounded number of
    rows however the keys are distributed.
    """
    sizes = rows.groupBy(*keys).agg(F.count_if(F.col("role") == 0).alias("_na"),
                                    F.count_if(F.col("role") == 1).alias("_nb"))
    if sides:
        sizes = sizes.filter((F.col("_na") > 0) & (F.col("_nb") > 0))
    else:
        sizes = sizes.filter(F.col("_na") > 1)
    n = F.col("_na") + F.col("_nb")
    big = n > tile_rows
    half = max(1, tile_rows // 2)
    ta = F.when(big, F.ceil(F.col("_na") / half)).otherwise(1).cast("int")
    tb = ta if not sides else F.when(big, F.ceil(F.col("_nb") / half)).otherwise(1).cast("int")
    total, grid = sizes.agg(F.coalesce(F.sum(n), F.lit(0)), F.coalesce(F.sum(
        F.when(big, ta.cast("long") * tb)), F.lit(0))).first()
    # A pack holds many rare keys, each a group of its own in it: rows for a call, not pairs.
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packs = max(1, min(int(total), parts), -(-int(total) // (16 * tile_rows)))
    rows = rows.join(sizes, list(keys))
    block = F.pmod(F.xxhash64("id"), F.when(F.col("role") == 0, ta).otherwise(tb)).cast("int")
    other = F.sequence(F.lit(0), F.when(F.col("role") == 0, tb).otherwise(ta) - 1)
    rows = rows.withColumn("_b", block).withColumn("_o", F.explode(other))
    if sides:
        i = F.when(F.col("role") == 0, F.col("_b")).otherwise(F.col("_o"))
        j = F.when(F.col("role") == 0, F.col("_o")).otherwise(F.col("_b"))
    else:
        i, j = F.least("_b", "_o"), F.greatest("_b", "_o")
    pack = F.when(big, F.concat_ws("|", *[F.col(k).cast("string") for k in keys])).otherwise(
        F.pmod(F.xxhash64(*keys), F.lit(packs)).cast("string"))
    rows = rows.select(*[c for c in rows.columns if c not in ("_na", "_nb", "_o", "_b")],
                       big.alias("_big"), pack.alias("_pack"), i.alias("_i"), j.alias("_j"))
    # The tiles are few bytes but much work, so they are spread before the size-based merge.
    cell = ["_big", "_pack", "_i", "_j"]
    rows = rows.repartition(max(1, min(parts, packs + int(grid))), *cell)
    return rows.groupBy(*cell).applyInPandas(fn, schema)


def best_choices(values, choices, threshold):
    """(value, score, choice) of the values whose best choice reaches the threshold; ties: smaller choice.

    Lengths and letters of all choices are compared with a value at once. Those without a common word that may reach the
    threshold are scored at once, too; those that share a word one by one, as far as they may beat the best so far.
    """
    choices = [(c, word_set(c)) for c in sorted(choices)]
    size = np.array([len(c[1][1]) for c in choices], "i8")
    mask = np.array([c[1][2] for c in choices], "u8")
    holders = {}
    for at, (_, theirs) in enumerate(choices):
        for w in theirs[0]:
            holders.setdefault(w, []).append(at)
    holders = {w: np.array(at) for w, at in holders.items()}
    letters, codes = letter_codes([c[1][1] for c in choices])
    for value in values:
        words = word_set(value)
        total = size + len(words[1])
        least = np.maximum(np.abs(size - len(words[1])), np.bitwise_count(mask ^ np.uint64(words[2])))
        may = (100.0 - 100.0 * least / np.maximum(total, 1) >= threshold) & (size > 0)
        shared = np.zeros(len(choices), bool)
        for w in words[0]:
            if w in holders:
                shared[holders[w]] = True
        best, alone = None, np.flatnonzero(may & ~shared)
        if len(alone) > FEW and codes is not None and 0 < len(words[1]) <= 64:
            total = total[alone]
            scores = 100.0 - 100.0 * (total - 2 * lcs_of_many(words[1], letters, codes[alone])) / total
            top = int(scores.argmax())
            if scores[top] >= threshold:
                best = (float(scores[top]), choices[alone[top]][0])
        else:
            shared |= may
        for at in np.flatnonzero(shared).tolist():
            choice, theirs = choices[at]
            s = word_set_score(words, theirs, max(threshold, best[0]) if best else threshold)
            if s >= threshold and (best is None or (-s, choice) < (-best[0], best[1])):
                best = (s, choice)
                if s == 100.0:
                    break
        if best:
            yield value, *best


def _best_by_value(values, threshold, keys, tile_rows):
    """(block, field, value, score, choice) of the tiles of values that share a key: the best choice of each tile."""
    def score(pdf):
        groups = {}
        cols = [pdf[c].tolist() for c in ("block", "field", *keys, "role", "value")]
        for blk, field, *key, role, value in zip(*cols):
            groups.setdefault((blk, field, *key), (set(), set()))[role].add(value)
        found = [(blk, int(field), *best) for (blk, field, *_), sides in groups.items()
                 for best in best_choices(*sides, threshold)]
        return pd.DataFrame(found, columns=["block", "field", "value", "score", "choice"])

    return _tiles(values.withColumn("id", F.col("value")), ["block", "field", *keys], score,
                  "block string, field int, value string, score double, choice string", tile_rows)


def _near_by_value(values, threshold, tile_rows):
    """The same, of all values that reach the threshold: only values that share a word or a rest are compared."""
    _check(threshold / 100.0)
    values = values.withColumns({"seed": F.xxhash64("field", "block"), "ref": F.xxhash64("field", "block", "value")})

    def others(needed):
        words = _words(F.col("value"))
        common_words, common_grams = common_items(values, words), common_items(values, _word_grams(words)) if needed else {}
        return lambda words, role, slow: word_keys(words, role, slow, threshold / 100.0, common_words, common_grams)

    pairs, large = near_pairs(values.select("ref", "seed", "field", "role", "value"), threshold / 100.0, KEY_PAIRS, others=others)
    mine = values.filter("role = 0").select(F.col("ref").alias("src"), "block", "field", "value")
    choices = values.filter("role = 1").select(F.col("ref").alias("dst"), "block", "field", F.col("value").alias("choice"))

    def score(batches):
        for pdf in batches:
            known = {}
            for text in {*pdf["value"], *pdf["choice"]}:
                known[text] = word_set(text)
            pdf["score"] = [word_set_score(known[x], known[y], threshold) for x, y in zip(pdf["value"], pdf["choice"])]
            yield pdf.loc[pdf["score"] >= threshold, ["block", "field", "value", "score", "choice"]]

    schema = "block string, field int, value string, score double, choice string"
    parts = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = (pairs.join(mine, "src").join(choices, ["dst", "block", "field"]).select("src", "block", "field", "value", "choice")
             .repartition(parts, "src").mapInPandas(score, schema))
    if large.isEmpty():
        return found
    hot = large.join(values.select("ref", "role", "block", "field", "value"), ["ref", "role"]).select(
        "key", "role", "block", "field", "value")
    return found.unionByName(_best_by_value(hot, threshold, ["key"], tile_rows))


def fuzzy_match(a, b, fields, threshold, block=None, id_a="IdSS", id_b="IdSW",
                tile_rows=TILE_ROWS, block_pairs=BLOCK_PAIRS):
    """Best partner in the other frame by word-set similarity.

    ``fields`` are columns both frames have, in priority order.  Inside a block
    the larger side looks for partners in the smaller one; per field the best
    value at or over the threshold counts (ties: smaller value, smaller id), and
    the best field wins (ties: field order).  Several rows may choose the same
    partner.  Without a block, and in blocks of more than ``block_pairs`` pairs
    together, only values that share a word or a rest (``near_pairs``) are
    compared, which loses nothing at thresholds of 85 and more.  At a lower one
    that finds the partners from ``NEAR`` on; a row that has one needs no other,
    since the best score counts, and only the rows left meet all of their block.
    """
    def side(df, id_col, role):
        return df.select(
            F.lit(role).alias("role"), F.col(id_col).cast("string").alias("id"),
            (F.col(block).cast("string") if block else F.lit("")).alias("block"),
            F.posexplode(F.array(*[F.col(f).cast("string") for f in fields])).alias("field", "value"))

    counts = (a.select(F.lit(1).alias("sa"), F.lit(0).alias("sb"),
                       (F.col(block).cast("string") if block else F.lit("")).alias("block"))
              .unionByName(b.select(F.lit(0).alias("sa"), F.lit(1).alias("sb"),
                                    (F.col(block).cast("string") if block else F.lit("")).alias("block")))
              .groupBy("block").agg(F.sum("sa").alias("sa"), F.sum("sb").alias("sb")))
    swap = counts.select("block", (F.col("sa") <= F.col("sb")).alias("swap"))
    rows = side(a, id_a, 0).unionByName(side(b, id_b, 1)).filter(
        F.col("value").isNotNull() & (F.col("value") != "")).join(swap, "block")
    rows = rows.withColumn("role", F.when(F.col("swap"), 1 - F.col("role")).otherwise(F.col("role")))
    by_value = ["block", "field", "value"]
    other = rows.filter("role = 1").groupBy("block", "field", F.col("value").alias("choice")).agg(F.min("id").alias("other"))

    def values(rows):
        return rows.select("role", *by_value).distinct()

    def partners(rows, found):
        best = found.groupBy(*by_value).agg(F.min_by(F.struct("score", "choice"), F.struct(-F.col("score"), F.col("choice"))).alias("m"))
        best = best.select(*by_value, "m.score", "m.choice").join(other, ["block", "field", "choice"])
        return rows.filter("role = 0").join(best, by_value).select("block", "id", "swap", "field", "score", "choice", "other")

    if block and (counts.agg(F.sum(F.col("sa") * F.col("sb"))).first()[0] or 0) <= block_pairs:
        hits = partners(rows, _best_by_value(values(rows), threshold, [], tile_rows))
    elif not block or threshold >= 85:
        hits = partners(rows, _near_by_value(values(rows), threshold, tile_rows))
    else:
        rows = materialize(rows, "names")
        near = materialize(partners(rows, _near_by_value(values(rows), NEAR, tile_rows)), "near-names")
        left = rows.join(near.select("block", "id").distinct().withColumn("role", F.lit(0)), ["block", "id", "role"], "left_anti")
        hits = near.unionByName(partners(left, _best_by_value(values(left), threshold, [], 8 * tile_rows)))
    order = F.struct(-F.col("score"), F.col("choice"), F.col("other"))
    per_field = hits.groupBy("block", "id", "swap", "field").agg(
        F.min_by(F.struct("other", "score"), order).alias("m"))
    best = per_field.groupBy("block", "id", "swap").agg(
        F.min_by(F.struct("m.other", "m.score", "field"),
                 F.struct(-F.col("m.score"), F.col("field"))).alias("m"))
    mine, other = F.col("id"), F.col("m.other")
    return best.select("block", F.when(F.col("swap"), other).otherwise(mine).alias(id_a),
                       F.when(F.col("swap"), mine).otherwise(other).alias(id_b),
                       F.col("m.score").alias("score"), F.col("m.field").alias("field")).distinct()


def with_leftovers(matched, a, b, id_a="IdSS", id_b="IdSW"):
    """Matched id pairs plus the ids of both sides that found no partner."""
    pairs = materialize(matched.select(id_a, id_b).distinct(), "matched")
    rest_a = a.select(F.col(id_a).cast("string").alias(id_a)).distinct().join(pairs, id_a, "left_anti")
    rest_b = b.select(F.col(id_b).cast("string").alias(id_b)).distinct().join(pairs, id_b, "left_anti")
    return pairs.unionByName(rest_a, allowMissingColumns=True).unionByName(
        rest_b, allowMissingColumns=True)


def one_partner(pairs, id_a="IdSS", id_b="IdSW"):
    """First non-null partner per id on either side; rows without an id are kept as they are.

    An id whose partner goes to another id leaves the pairs; ``with_leftovers`` afterwards brings it back alone.
    """
    def step(df, key, other):
        known = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(other).alias(other))
        return known.unionByName(df.filter(F.col(key).isNull()).select(key, other).distinct())

    return step(step(pairs, id_a, id_b), id_b, id_a).filter(
        F.col(id_a).isNotNull() | F.col(id_b).isNotNull()).select(id_a, id_b)


def connected_components(edges, src="src", dst="dst"):
    """Smallest node id of each node's component, by alternating star contraction.

    Each round replaces the edges around a node by edges to its smallest
    neighbour; the number of rounds grows with the logarithm of the graph.
    A node with a large share of all edges sends its smallest neighbour to every
    task, so the edges of a star are many tasks.  Rounds are written to the
    scratch folder, so the lineage stays short.
    """
    e = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).filter("u <> v").distinct()
    nodes = edges.select(F.explode(F.array(src, dst)).alias("node")).distinct()

    def star(e, large, total):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        if not large:
            both = both.filter("v < u")
        low = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("_n")).withColumn("m", F.least("u", "m"))
        out = join_counted(both, low, ["u"], "m", total=total)
        if large:
            out = out.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            out = out.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
                low.select("u", F.col("m").alias("v")))
        return out.filter("u <> v").distinct()

    def state(df):
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    e = materialize(e, "components")
    seen, now = None, state(e)
    while now != seen:
        e, seen = materialize(star(star(e, True, 2 * now[0]), False, now[0]), "components"), now
        now = state(e)
    return nodes.join(e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("c")), "node", "left"
                      ).select("node", F.coalesce("c", "node").alias("component"))


def duplicate_edges(df, id_col, check, keys=(), threshold=0.9, weak=(), tile_rows=TILE_ROWS):
    """Links between rows whose mean text similarity reaches the threshold, keys not in conflict.

    Equal rows collapse to their smallest id first, so many copies of one row are
    a star, not pairs.  Of the rest only rows sharing a key in some column are
    compared (``near_pairs``; ``close_keys`` for texts with too many rests): a mean
    at the threshold needs one column at the threshold.
    ``weak`` columns have few values (a country); among rows without nulls their
    agreement alone makes no candidates, since then another column must reach
    (m t - w) / (m - w) of the m columns and w weak ones.  Rows with nulls are
    still compared over all columns.  Keys of up to ``FEW`` rows only propose pairs,
    which are compared once; of a larger key each tile returns a spanning forest
    of its links, never all of them.
    """
    m, w = len(check), len(weak)
    rest = (threshold * m - w) / (m - w)
    if w and rest < 0.85:
        raise ValueError("too few columns to leave weak ones out")
    text = [F.lower(F.trim(F.col(c).cast("string"))).alias(f"c{i}") for i, c in enumerate(check)]
    held = [F.trim(F.col(c).cast("string")).alias(f"k{i}") for i, c in enumerate(keys)]
    texts = [f"c{i}" for i in range(m)]
    cols = texts + [f"k{i}" for i in range(len(keys))]
    rows = df.select(F.col(id_col).alias("id"), *text, *held)
    rows = rows.filter(F.coalesce(*[F.col(c) for c in texts]).isNotNull())
    reps = rows.groupBy(*cols).agg(F.min("id").alias("rep"))
    cond = [F.col("r." + c).eqNullSafe(F.col("p." + c)) for c in cols]
    copies = rows.alias("r").join(reps.alias("p"), cond).filter("r.id <> p.rep").select(
        F.col("p.rep").alias("src"), F.col("r.id").alias("dst"))
    reps = materialize(reps.withColumnRenamed("rep", "id").withColumn("ref", F.xxhash64("id")), "different-rows")
    empty = F.array().cast("array<string>")
    q = {_gram_size(threshold)} | ({_gram_size(rest)} if w else set())
    nc, nk = len(check), len(keys)

    def link(pdf):
        groups, seen, known, out = {}, {}, {}, []
        fields = zip(*(pdf[c].tolist() for c in ["id", *cols]))
        for key, role, rec in zip(pdf["key"].tolist(), pdf["role"].tolist(), fields):
            groups.setdefault(key, ({}, {}))[role][rec[0]] = rec[1:]
        for one, two in groups.values():
            items = sorted({**one, **two}.items())
            if len(items) <= FEW:       # a pair shares many such keys: it is compared once, after all keys
                out += [(i, j, False) for (i, _), (j, _) in combinations(items, 2) if not two or i in one or j in one]
                continue
            root = list(range(len(items)))

            def find(x):
                while root[x] != x:
                    root[x] = root[root[x]]
                    x = root[x]
                return x

            for x, (i, left) in enumerate(items):
                for y in range(x + 1, len(items)):
                    j, right = items[y]
                    if two and i not in one and j not in one:
                        continue
                    fx, fy = find(x), find(y)
                    if fx == fy:
                        continue
                    same = seen.get((i, j))
                    if same is None:
                        same = seen[i, j] = _alike(left, right, nc, nk, threshold, known)
                    if same:
                        root[fx] = fy
                        out.append((i, j, True))
        return pd.DataFrame(out, columns=["src", "dst", "sure"])

    def compare(batches):
        for pdf in batches:
            known, left, right = {}, *(zip(*(pdf[f"{side}_{c}"].tolist() for c in cols)) for side in ("src", "dst"))
            alike = [_alike(a, b, nc, nk, threshold, known) for a, b in zip(left, right)]
            yield pdf.loc[alike, ["src", "dst"]]

    id_type = df.schema[id_col].dataType.simpleString()
    schema = f"src {id_type}, dst {id_type}"

    def linked(rows, which, limit, sides):
        _check(limit)
        texts = rows.select("ref", "role", F.posexplode(F.array(*[f"c{i}" for i in which])).alias("field", "value"))
        texts = texts.filter(F.length("value") > 0).withColumn("seed", F.xxhash64("field"))

        def others(needed):
            common = common_items(reps, F.flatten(F.array(*[F.coalesce(_grams(F.col(c), size), empty)
                                                            for c in cols[:nc] for size in q]))) if needed else {}
            return lambda words, role, slow: close_keys(words[0], limit, common) if slow else ()

        pairs, large = near_pairs(texts, limit, FEW * FEW // 2 if sides else FEW, sides, False, others)
        for end in ("src", "dst"):
            pairs = pairs.join(reps.select(F.col("ref").alias(end), F.col("id").alias(f"{end}_id"), *[
                F.col(c).alias(f"{end}_{c}") for c in cols]), end)
        parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        pairs = pairs.filter("src_id <> dst_id").repartition(parts, "src", "dst").withColumns(
            {"src": F.least("src_id", "dst_id"), "dst": F.greatest("src_id", "dst_id")}).drop("src_id", "dst_id")
        found = pairs.mapInPandas(compare, schema)
        if large.isEmpty():
            return found
        # Of a large key each tile returns a spanning forest; the few rows of a tile's corner are again only proposed.
        links = materialize(_tiles(large.join(rows, ["ref", "role"]), ["key"], link, schema + ", sure boolean", tile_rows, sides)
                            .groupBy("src", "dst").agg(F.max("sure").alias("sure")), "duplicate-pairs")
        corner = links.filter(~F.col("sure")).select("src", "dst")
        for end in ("src", "dst"):
            corner = corner.join(reps.select(F.col("id").alias(end), *[F.col(c).alias(f"{end}_{c}") for c in cols]), end)
        return found.unionByName(links.filter("sure").select("src", "dst")).unionByName(
            corner.repartition(parts, "src", "dst").mapInPandas(compare, schema))

    if not w:
        return copies.unionByName(linked(reps.withColumn("role", F.lit(0)), range(m), threshold, False)).distinct()
    full = F.lit(True)
    for c in texts:
        full = full & F.col(c).isNotNull()
    strong = [i for i, c in enumerate(check) if c not in weak]
    whole = reps.filter(full).withColumn("role", F.lit(0))
    holes = reps.filter(~full).withColumn("role", F.lit(0)).unionByName(reps.withColumn("role", F.lit(1)))
    return (copies.unionByName(linked(whole, strong, rest, False))
            .unionByName(linked(holes, range(m), threshold, True)).distinct())


def _alike(a, b, nc, nk, threshold, known):
    """Whether the mean ratio of the shared texts reaches the threshold without a key conflict."""
    for x, y in zip(a[nc:nc + nk], b[nc:nc + nk]):
        if x is not None and y is not None and x != y:
            return False
    texts = [(x, y) for x, y in zip(a[:nc], b[:nc]) if x is not None and y is not None]
    if not texts:
        return False
    total = 0.0
    for done, (x, y) in enumerate(texts):       # lengths bound what the rest can add
        rest = sum(_ratio_bound(u, v, known) for u, v in texts[done:])
        if (total + rest) / len(texts) < threshold:
            return False
        ratio = known.get((x, y))
        if ratio is None:
            ratio = known[x, y] = matching_share(x, y)
        total += ratio
    return total / len(texts) >= threshold


def _ratio_bound(x, y, known):
    """Upper bound of the ratio from lengths and letters, or the ratio if it is known."""
    ratio = known.get((x, y))
    if ratio is not None:
        return ratio
    if x == y:
        return 1.0
    for t in (x, y):
        if t not in known:
            known[t] = letter_mask(t)
    least = max(abs(len(x) - len(y)), (known[x] ^ known[y]).bit_count())
    return 1.0 - least / (len(x) + len(y))


def merge_duplicates(df, id_col, check, keys=(), threshold=0.9, weak=(), tile_rows=TILE_ROWS):
    """One row per group of linked rows: first non-null value per column in id order.

    Links are closed transitively, so two rows with different keys may meet
    through a third; ``conflict`` marks such groups.
    """
    from .aggregate import first_valid
    edges = materialize(duplicate_edges(df, id_col, check, keys, threshold, weak, tile_rows), "links")
    groups = connected_components(edges).select(F.col("node").alias(id_col), "component")
    rows = df.join(groups, id_col, "left").withColumn(
        "_g", F.coalesce("component", F.col(id_col))).drop("component")
    cols = [c for c in df.columns if c != id_col]
    out = first_valid(rows, "_g", [id_col, *cols], [F.col(id_col)]).drop("_g")
    if keys:
        clash = rows.groupBy("_g").agg(F.greatest(
            *[F.min(F.trim(F.col(c).cast("string"))) != F.max(F.trim(F.col(c).cast("string")))
              for c in keys], F.lit(False)).alias("conflict"))
        out = out.join(clash.withColumnRenamed("_g", id_col), id_col, "left")
    return out.select(*df.columns, *(["conflict"] if keys else []))


def unify_stats(first, second, match_ids, team_ids, player_ids, sources=None):
    """Statistics of both providers in internal ids: outer join, positions, largest source value.

    Each id frame has (provider_first, provider_second, id) as (IdSS, IdSW, ID).
    """
    def translate(df, provider):
        for col, ids in (("Match", match_ids), ("team", team_ids), ("player", player_ids)):
            df = map_column(df.withColumn(col, F.col(col).cast("string")), col,
                            ids.select(F.col(provider).cast("string").alias("key"),
                                       F.col("ID").alias("value")))
        return df.filter(F.col("Match").isNotNull())        # matches without an id are not known

    keys = ["Match", "team", "player"]
    a, b = translate(first, "IdSS"), translate(second, "IdSW")
    from .shape import suffix
    joined = suffix(a, keys, "SS").join(suffix(b, keys, "SW"), keys, "full_outer")
    known = dedup(joined.filter(F.col("player").isNotNull()), ["Match", "player"], ["team"])
    joined = resolve_position(known)
    shirt = [F.col(c).try_cast("int") for c in ("shirt_numSS", "shirt_numSW") if c in joined.columns]
    joined = joined.select(F.col("Match"), F.col("team").alias("Team"), F.col("player").alias("Player"),
                           (F.coalesce(*shirt) if shirt else F.lit(None).cast("int")).alias("ShirtNumber"),
                           "Position", *[c for c in joined.columns if c not in (*keys, "Position")])
    return greatest_of(joined, sources or lk.player_sources(),
                       keep=["Match", "Team", "Player", "ShirtNumber", "Position"])


def merge_identities(players, stats, matches, season, order=("Slug", "ID")):
    """One profile per person and the loser ids rewritten in the statistics.

    Persons are the same if match name (or slug), team and country agree; the best
    profile has a contract, a shirt number, more known fields, then comes first.
    """
    played = stats.select("Match", "Team", "Player").join(
        matches.filter(F.col("Season").cast("string") == str(season)).select(
            F.col("ID").alias("Match"), "Date"), "Match").dropna(subset=["Date", "Player", "Team"])
    last = latest(played, "Player", ["Date", "Match", "Team"], [F.col("Team").alias("_team")])
    df = players.join(last.withColumnRenamed("Player", "ID"), "ID", "left")
    df = df.withColumn("Team", F.coalesce("_team", "Team")).drop("_team").select(players.columns)

    def clean(c):
        return F.coalesce(F.lower(F.trim(F.col(c).cast("string"))), F.lit(""))

    name = F.when(F.coalesce(F.trim("MatchName"), F.lit("")) == "", clean("Slug")).otherwise(clean("MatchName"))
    df = df.withColumn("_key", F.concat_ws("|", name, clean("Team"), clean("Country")))
    filled = sum((F.col(c).isNotNull().cast("int") for c in players.columns), F.lit(0))
    prio = [-F.col("ContractUntil").isNotNull().cast("int"),
            -F.col("ShirtNumber").isNotNull().cast("int"), -filled]
    best, ids = dedupe_best(df, ["_key"], "ID", prio, list(order))
    moved = map_column(stats, "Player", ids, "id", "main", out="_main")
    moved = moved.withColumn("Player", F.coalesce("_main", "Player")).drop("_main")
    return best.drop("_key"), moved.select(stats.columns), ids


def infer_position(df, players, formation_positions, keep=("Match", "Team", "Player", "ShirtNumber",
                                                           "Position", "MinutesPlayed")):
    """Missing positions from the profile: the first one the formation has, else the first.

    Rows that still have none are dropped, other null statistics become 0.
    """
    profile = players.select(F.col("ID").alias("Player"), F.array_compact(
        F.array("FirstPos", "SecondPos", "ThirdPos")).alias("_mine"))
    out = df.join(profile, "Player", "left").join(formation_positions, "Formation", "left")
    allowed = F.coalesce(F.col("positions"), F.array().cast("array<string>"))
    fits = F.filter("_mine", lambda p: F.array_contains(allowed, p))
    pick = F.coalesce(F.get(fits, F.lit(0)), F.get("_mine", F.lit(0)))
    out = out.withColumn("Position", F.coalesce("Position", pick)).filter("Position IS NOT NULL")
    rest = [c for c in df.columns if c not in keep and c != "Formation"]
    return out.select(*[c for c in df.columns if c in keep],
                      *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in rest])


def clean_staff(managers, teams):
    """Coaches with the team they lead last, profile columns only."""
    lead = teams.filter(F.col("Manager").isNotNull()).select(
        F.col("Manager").cast("long").cast("string").alias("IdSS"), F.col("ID").alias("Team"))
    lead = lead.groupBy("IdSS").agg(F.max("Team").alias("Team"))
    own = managers.drop("Team").withColumn("IdSS", F.col("IdSS").cast("long").cast("string"))
    drop = ["Type", "Matches", "Wins", "Draws", "Losses", "GoalsFor", "GoalsAgainst", "Points",
            "ShortName", "LongName", "ShortFirstName", "ShortLastName"]
    return own.filter(F.col("Type") == "coach").join(lead, "IdSS").drop(*drop)


def clean_teams(teams, staff):
    """Abbreviation from the slug, repaired colours, internal manager id."""
    df = teams.drop("ShortName", "LongName", "TextColour", "Venue", "Manager")
    df = df.withColumn("Abbreviation", F.coalesce(
        "Abbreviation", F.upper(F.substring(F.coalesce("Slug", F.lit("")), 1, 3))))
    lead = staff.groupBy(F.col("Team").alias("ID")).agg(F.max("ID").alias("Manager"))
    return repair_colours(df).join(lead, "ID", "left")


def clean_team_stats(team_stats, player_stats):
    """Matches with exactly two rows, goals joined, possession and formation required."""
    df = exact_group_size(team_stats, ["Match"], 2)
    goals = player_stats.groupBy("Match", "Team").agg(F.sum("Goals").alias("Goals"))
    df = df.drop("Goals", "AverageAge", "FinalThirdPhaseStatistic", "KilometersCovered", "NumberOfSprints")
    return df.join(goals, ["Match", "Team"], "left").dropna(subset=["BallPossession", "Formation"])


def clean_player_stats(player_stats, team_stats, matches, formation_map, season):
    """Formation joined, position by formation, minutes played, date of season matches."""
    df = player_stats.drop(*lk.DROPPED_COUNTERS).join(
        team_stats.select("Match", "Team", "Formation"), ["Match", "Team"])
    df = min_sample(map_by_formation(df, formation_map), "MinutesPlayed", 0, strict=True)
    dates = matches.filter(F.col("Season").cast("string") == str(season)).select(
        F.col("ID").alias("Match"), "Date")
    return df.join(dates, "Match", "left")


def clean_players(players, stats):
    """Positions played (else declared), team and number of the last match, names."""
    seen = top_positions(stats, groups=lk.MAIN_POSITION)
    now = latest(stats.filter(F.col("Date").isNotNull()), "Player",
                 ["Date", "Match", "Team", "ShirtNumber"], ["Team", "ShirtNumber"])
    base = players.drop("Team", "ShirtNumber", "MainPos")
    played = base.drop("FirstPos", "SecondPos", "ThirdPos").join(
        seen.withColumnRenamed("Player", "ID"), "ID")
    declared = fallback_positions(base.join(seen.select(F.col("Player").alias("ID")), "ID", "left_anti"))
    df = played.unionByName(declared, allowMissingColumns=True)
    df = df.join(now.withColumnRenamed("Player", "ID"), "ID", "left")
    df = split_name(df).drop("ShortName", "LongName", "ShortFirstName", "ShortLastName", "Position")
    return df.withColumnRenamed("MainPos", "Position")


def unify_entity(first, second, pairs, cols_map, id_prefix):
    """Merged profile rows of matched and unmatched ids, with slug and stable id."""
    from .shape import suffix
    a = dedup(suffix(first.withColumn("IdSS", F.col("IdSS").cast("string")), ["IdSS"], "SS"), ["IdSS"], ["SlugSS"])
    b = dedup(suffix(second.withColumn("IdSW", F.col("IdSW").cast("string")), ["IdSW"], "SW"), ["IdSW"], ["SlugSW"])
    rows = pairs.join(a, "IdSS", "left").join(b, "IdSW", "left")
    df = coalesce_columns(rows, cols_map)
    df = df.withColumn("Slug", slug("Name"))
    return df.withColumn("ID", stable_id(F.lit(id_prefix), "IdSS", "IdSW"))
