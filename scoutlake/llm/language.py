"""Language of a text: known words by their log frequency, unseen words by ever shorter character n-grams.

The model is fitted on a sample of about ``PER_LANG`` documents of each language. Words seen ``LEAST`` times or more
are known, whatever their length; an unseen word is scored by its longest known n-grams, of 5 letters down to 1, each step at a
discount. Counts are taken by Spark over the sample; the table that tasks get holds all its words and n-grams, so the sample alone
bounds it. Every text is scored whole: a worker scores what stands between blanks once, all that is new in a part of a batch in one
array, and a text's total is a sum of rows of that array.

Defined results: a null text, or one without a letter, is 'und' with score 0; ties go to the language first in the
alphabet; null languages are not learned; repeated rows score alike; without any labelled row all are 'und'; only id,
text and lang are read, and lang only to learn.
"""

import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import functions as F

from .common import fold, query, small, table

#: Documents of each language that the model is fitted on, about.
PER_LANG = 2_000
#: Terms that the smoothing takes a language to have; least count of a known word or n-gram.
TERMS = 200_000
LEAST = 3
LONGEST = 5
#: What each step to a shorter n-gram costs, as a factor on the log-likelihood ratio it may add.
STEP = 0.8
WORDS = re.compile(r"[^\W\d_]+")
#: Parts of texts that a worker remembers, and bytes of text that it takes at a time.
MEMO = 150_000
BATCH = 2 << 20


def words(text):
    return WORDS.findall(text.lower())


def grams(word, n):
    """Character n-grams of a word, from 2 letters on with its ends marked."""
    w = f" {word} " if n > 1 else word
    return [w[i:i + n] for i in range(len(w) - n + 1)]


def sample(docs, held_out, per_lang):
    """Text and language of the training documents: about ``per_lang`` of each language, by hash of the id."""
    rows = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out)
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()
    chance = F.lit(None).cast("double")
    for r in sizes:
        chance = F.when(F.col("lang") == r["lang"], F.lit(min(1.0, per_lang / r["n"]))).otherwise(chance)
    spread = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) / 1_000_003
    return rows.filter(spread < chance).select("text", "lang"), sorted(r["lang"] for r in sizes)


def fit(rows, langs):
    """Log frequencies per language: ({word: row}, {n-gram: row}, matrix of rows by languages)."""
    import numpy as np

    def count(batches):
        def emitted(seen):
            grams_seen = Counter()
            for (lang, w), n in seen.items():
                grams_seen[lang, 0, w] += n
                for k in range(1, LONGEST + 1):
                    for g in grams(w, k):
                        grams_seen[lang, k, g] += n
            return pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in grams_seen], pa.string()), pa.array([k[1] for k in grams_seen], pa.int32()),
                 pa.array([k[2] for k in grams_seen], pa.string()), pa.array(list(grams_seen.values()), pa.int64())],
                names=["lang", "size", "term", "n"])

        seen = Counter()
        for b in batches:
            for t, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for w, n in Counter(words(t)).items():
                    seen[lang, w] += n
                if len(seen) > 200_000:
                    yield emitted(seen)
                    seen = Counter()
        yield emitted(seen)

    counts = rows.mapInArrow(count, "lang string, size int, term string, n long")
    per = [F.sum(F.when(F.col("lang") == x, F.col("n")).otherwise(0)).alias(f"n{i}") for i, x in enumerate(langs)]
    terms = counts.groupBy("size", "term").agg(*per, F.sum("n").alias("total")).filter(F.col("total") >= LEAST).persist()
    sums = {r["size"]: np.array(r[1:], "f8") for r in terms.groupBy("size").agg(
        *[F.sum(f"n{i}") for i in range(len(langs))]).collect()}
    tables, rows_of = [], []
    for known in (F.col("size") == 0, F.col("size") > 0):
        own = {}
        for r in terms.filter(known).select("size", "term", *[f"n{i}" for i in range(len(langs))]).collect():  # terms of the sample
            own[r["term"]] = len(rows_of)
            rows_of.append(np.log((np.array(r[2:], "f8") + 0.1) / (sums[r["size"]] + 0.1 * TERMS)).astype("f4"))
        tables.append(own)
    terms.unpersist()
    return (*tables, np.array(rows_of, "f4").reshape(len(rows_of), len(langs)))


def word_rows(word, known, parts):
    """Rows of the model whose mean scores a word, and its weight: the word's own, or those of its longest known n-grams."""
    if word in known:
        return [known[word]], 1.0
    weight = 1.0
    for n in range(LONGEST, 0, -1):
        found = [parts[g] for g in grams(word, n) if g in parts]
        if found:
            return found, weight
        weight *= STEP
    return [], 0.0


class Scorer:
    """Scores of what stands between blanks, remembered by the worker."""

    def __init__(self, model):
        import numpy as np

        self.known, self.parts, matrix = model
        self.matrix = matrix.astype("f8") - matrix.astype("f8").mean(axis=1, keepdims=True)
        self.number, self.rows, self.words = {}, np.zeros((0, matrix.shape[1])), np.zeros(0, "i8")

    def learn(self, tokens):
        """Log-likelihoods of each token's words in each language, less their mean, and its number of words."""
        import numpy as np

        of, weight, rows, n = [], [], [], []
        for i, token in enumerate(tokens):
            found = words(token)
            n.append(len(found))
            for w in found:
                own, share = word_rows(w, self.known, self.parts)
                rows += own
                of += [i] * len(own)
                weight += [share / len(own)] * len(own) if own else ()
        more, of = np.zeros((len(tokens), self.matrix.shape[1])), np.array(of, "i8")
        for lang, column in enumerate(self.matrix.T):
            more[:, lang] = np.bincount(of, column[rows] * weight, minlength=len(tokens)) if rows else 0
        self.number.update(zip(tokens, range(len(self.number), len(self.number) + len(tokens))))
        self.rows, self.words = np.concatenate([self.rows, more]), np.concatenate([self.words, np.array(n, "i8")])

    def totals(self, texts):
        """Sums over the words of each text, and how many words it has."""
        import numpy as np

        cut = [t.split() if t else () for t in texts]
        new = dict.fromkeys(chain.from_iterable(cut))
        if len(self.number) + len(new) > MEMO:
            self.number, self.rows, self.words = {}, self.rows[:0], self.words[:0]
        self.learn([t for t in new if t not in self.number])
        at = np.fromiter(map(self.number.__getitem__, chain.from_iterable(cut)), "i8")
        ends = np.concatenate([[0], np.cumsum(np.fromiter(map(len, cut), "i8", len(cut)))])
        of = np.repeat(np.arange(len(cut)), np.diff(ends))
        sums = np.stack([np.bincount(of, column[at], minlength=len(cut)) for column in self.rows.T], axis=1)
        return sums, np.bincount(of, self.words[at], minlength=len(cut))


def predict(spark, model, langs):
    """Struct column (lang_pred, score) for a frame with a text column."""
    sent = spark.sparkContext.broadcast(model)  # terms of the sample

    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import numpy as np

        scorer = Scorer(sent.value) if langs else None
        for series in texts:
            out = [[], []]
            for part in small([series], BATCH):
                if not langs:
                    out[0] += ["und"] * len(part)
                    out[1] += [0.0] * len(part)
                    continue
                total, n = scorer.totals(part.to_pylist())
                best = total.argmax(axis=1)
                # words of a text are not independent: the square root tempers their number
                less = (total - total.max(axis=1, keepdims=True)) / np.sqrt(np.maximum(n, 1))[:, None]
                score = np.where(n > 0, 1 / np.exp(less).sum(axis=1), 0.0)
                out[0] += [langs[b] if k else "und" for b, k in zip(best.tolist(), n.tolist())]
                out[1] += score.tolist()
            yield pa.StructArray.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.float64())], names=["lang_pred", "score"])

    return F.arrow_udf(run, "lang_pred string, score double")("text")


@query("op3_language_id")
def op3(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(fold("doc_id", 4) == 2, F.lit(False))
    rows, langs = sample(docs, held_out, PER_LANG)
    model = fit(rows, langs) if langs else None
    return docs.select("doc_id", held_out.alias("held_out"), predict(spark, model, langs).alias("p")) \
        .select("doc_id", "held_out", "p.lang_pred", "p.score")
