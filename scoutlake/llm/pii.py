"""Personal data and secrets replaced by keyed surrogates, with DataFrame functions only.

A pattern finds mentions in whole texts. Mentions of one value in different spellings share a canonical form (phone
digits, lower-case address or secret, each token of a name), and every canonical value of a kind gets one surrogate, made from a
keyed hash: a digit for a digit, a letter for a letter of the same case and script, a valid check digit for a valid one,
octets for octets, a first name of the same gender and script. Collision checks run over all values: a surrogate that
another value has, or that is itself a value of the corpus, is made anew with the next attempt, so different values
stay different and equal ones equal. A surrogate is then written in the form of each mention (separators, case, title).

Only mentions and the documents that hold some are shuffled; a mention in a third of all documents is one row of the
table of values. Defined results: a null text stays null, an empty one empty; repeated rows get equal texts; all other
columns stay as they are; an empty table gives no rows.
"""

from functools import reduce

from pyspark.sql import functions as F

from .common import materialize, query, table

KEY = "change-me"
#: First names by script and gender, and titles by gender, that mark a name.
FIRST = {
    ("latin", "m"): "James John Robert Michael William David Richard Thomas Charles Daniel Hans Peter Pierre Jean Juan Carlos".split(),
    ("latin", "f"): "Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Anna Julia Marie Claire Lucia Carmen".split(),
    ("cyrillic", "m"): "Иван Сергей Дмитрий Алексей Николай Павел Михаил Андрей".split(),
    ("cyrillic", "f"): "Анна Мария Елена Ольга Наталья Татьяна Ирина Светлана".split(),
}
TITLES = {"m": ["Mr", "Herr", "Señor", "Monsieur", "Господин"], "f": ["Mrs", "Ms", "Miss", "Frau", "Señora", "Madame", "Госпожа"],
          "": ["Dr", "Prof"]}
SYLLABLES = {
    "latin": "ba be bi bo da de di do fa fe ga go ha he ka ke la le li lo ma me mi mo na ne no pa pe ra re ro sa se so ta te to va ve".split(),
    "cyrillic": "ба бе би бо да де ди до га го ка ке ла ле ли ло ма ме ми мо на не но па пе ра ре ро са се со та те то ва ве".split(),
}
_NAME = r"\p{Lu}[\p{L}'’\-]++"
_FIRSTS = "|".join(n for names in FIRST.values() for n in names)
_TITLES = "|".join(t for names in TITLES.values() for t in names)
_SECRET = r"(?i:password|passwd|secret|token|api_key)\s{0,3}[=:]\s{0,3}[\"']?"
_NUMBER = "|".join([
    r"(?:\d{1,3}\.){3}\d{1,3}(?!\d|\.\d)",
    r"\d{3}-\d{2}-\d{4}(?!\d)",
    r"\d{3}[\-.]\d{3}[\-. ]\d{4}(?!\d)",
    r"(?:\d{13,19}|\d{4}(?:[ \-]\d{4}){3}|\d{4}[ \-]\d{6}[ \-]\d{5})(?!\d)",
])
_PLUS = "|".join([
    r"\+1[ .\-]?(?:\(\d{3}\)|\d{3})[ .\-]?\d{3}[ .\-]?\d{4}(?!\d)",
    r"\+\d{1,3}[ .\-]?(?:\(\d{1,4}\)[ .\-]?)?\d{2,4}(?:[ .\-]\d{2,4}){1,3}(?!\d|\.\d)",
    r"\+\d{8,15}(?!\d)",
])
_CAPITAL = "|".join([
    r"AKIA[0-9A-Z]{16}\b",
    r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b",
    rf"(?:{_TITLES})\.? {_NAME}(?: {_NAME})?",
    rf"(?:{_FIRSTS}) {_NAME}",
])
#: One pattern for all kinds, tried only where a word or number starts and, by its first letter, only for the kinds that
#: can start so; the first alternative that matches at a place wins.
PATTERN = (r"(?<![\p{L}\d])(?:" + "|".join([
    r"(?<![A-Za-z0-9][._%+\-])(?=[A-Za-z0-9])[A-Za-z0-9._%+\-]++@(?:[A-Za-z0-9\-]++\.)++[A-Za-z]{2,}+",
    rf"(?=\d)(?<!\d\.)(?:{_NUMBER})",
    rf"(?=\+)(?:{_PLUS})",
    r"\(\d{3}\) ?\d{3}[\-. ]\d{4}(?!\d)",
    rf"(?=\p{{Lu}})(?:{_CAPITAL})",
    "(?=[pstaPSTA])" + _SECRET + r"[A-Za-z0-9+/_\-]{8,}+",
]) + ")")
#: Attempts after which a surrogate may grow by a letter, where too few of its form are free.
GROW = 8


def mentions(text):
    """All mentions of a text, in order."""
    return F.regexp_extract_all(text, F.lit(PATTERN), 0)


def kind_of(m):
    """Kind of a mention, from its form."""
    return (F.when(m.contains("@"), "email").when(m.rlike("^" + _SECRET), "secret").when(m.rlike(r"^AKIA[0-9A-Z]{16}$"), "key")
            .when(m.rlike(r"^[A-Z]{2}\d{2}[ A-Z0-9]+$"), "iban").when(m.rlike(r"^\d{1,3}(\.\d{1,3}){3}$"), "ip")
            .when(m.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn").when(m.rlike(r"^[+(]|^\d{3}[\-.]\d{3}[\-. ]\d{4}$"), "phone")
            .when(m.rlike(r"^\d"), "card").otherwise("name"))


def _one_of(words):
    return "^(?:" + "|".join(words) + ")$"


def name_tokens(m):
    """Tokens of a name with the kind of each: title, first name by gender, last name; script is part of the kind."""
    tokens = F.split(m, " ")
    title = F.regexp_replace(F.get(tokens, F.lit(0)), r"\.$", "")
    by_title = F.when(title.rlike(_one_of(TITLES["m"])), "m").when(title.rlike(_one_of(TITLES["f"])), "f")
    titled = title.rlike(_one_of(t for names in TITLES.values() for t in names))

    def kind(t, i):
        script = F.when(t.rlike(r"\p{IsCyrillic}"), "cyrillic").otherwise("latin")
        known = F.when(t.rlike(_one_of(FIRST["latin", "m"] + FIRST["cyrillic", "m"])), "m") \
            .when(t.rlike(_one_of(FIRST["latin", "f"] + FIRST["cyrillic", "f"])), "f")
        first = i < F.size(tokens) - 1
        return F.struct(F.when(titled & (i == 0), "title").when(
            first, F.concat(F.lit("first:"), F.coalesce(known, by_title, F.lit("m")), F.lit(":"), script)).otherwise(
            F.concat(F.lit("last:"), script)).alias("kind"), F.when(titled & (i == 0), t).otherwise(F.lower(t)).alias("canon"))

    return F.transform(tokens, kind)


def values_of(m, kind):
    """Canonical values of a mention: array of (kind, canon); several for a name."""
    canon = (F.when(kind == "email", F.lower(m)).when(kind == "secret", F.lower(F.regexp_replace(m, "^" + _SECRET, "")))
             .when(kind.isin("phone", "card", "ssn"), F.regexp_replace(m, r"\D", ""))
             .when(kind == "iban", F.regexp_replace(m, " ", "")).otherwise(m))
    return F.when(kind == "name", name_tokens(m)).otherwise(F.array(F.struct(kind.alias("kind"), canon.alias("canon"))))


def _luhn(digits, shift):
    """Luhn sum of a digit string; shift 1 if a check digit is still to follow."""
    n = F.length(digits)

    def weigh(i):
        d = F.substring(digits, i, 1).cast("int")
        twice = (n - i + shift) % 2 == 1
        return F.when(twice, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d)

    return F.aggregate(F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), weigh), F.lit(0), lambda a, x: a + x) % 10


def with_surrogate(values, key):
    """The values (kind, canon, attempt) with a surrogate of the same form, from the keyed hash of the three."""
    kind, canon, attempt = F.col("kind"), F.col("canon"), F.col("attempt")
    seed = F.concat_ws("\x1f", F.lit(key), kind, canon, attempt.cast("string"))
    more = (attempt >= GROW) & kind.isin("email", "secret")
    head = F.when(kind == "email", F.regexp_extract(canon, r"^(.*)\.[^.]+$", 1)) \
        .when(kind == "card", F.expr("left(canon, length(canon) - 1)")).when(kind == "key", F.expr("substring(canon, 5)")) \
        .otherwise(canon)
    keep = F.when(kind.isin("card", "phone", "ssn"), 1).when(kind == "iban", 2).otherwise(0)
    values = values.select("*", F.concat(F.sha2(seed, 512), F.sha2(F.concat(seed, F.lit("+")), 512)).alias("stream"),
                           F.concat(head, F.when(more, "x").otherwise("")).alias("head"), keep.alias("keep"),
                           canon.rlike("^[0-9a-f]{16,}$").alias("hexed"))

    def byte(i):  # i from 0; 128 bytes
        return F.conv(F.substring("stream", (i % 126 * 2 + 1).cast("int"), 4), 16, 10).cast("int")

    def like(c, i):
        k = byte(i)
        return (F.when(i < F.col("keep"), c).when(c.rlike("[0-9]"), (k % 10).cast("string"))
                .when(c.rlike("[a-z]"), F.char(F.lit(97) + k % F.when(F.col("hexed"), 6).otherwise(26)))
                .when(c.rlike("[A-Z]"), F.char(F.lit(65) + k % 26))
                .when(c.rlike("[а-я]"), F.substring(F.lit("абвгдежзийклмнопрстуфхцчшщъыьэюя"), k % 32 + 1, 1))
                .when(c.rlike("[А-Я]"), F.substring(F.lit("АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯ"), k % 32 + 1, 1)).otherwise(c))

    chars = F.filter(F.split("head", ""), lambda c: c != "")
    values = values.withColumn("shaped", F.array_join(F.transform(chars, like), ""))
    check = (F.lit(10) - _luhn(F.col("shaped"), 1) + F.when(_luhn(canon, 0) == 0, 0).otherwise(1)) % 10
    octets = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: (byte(i) % 254 + 1).cast("string")), ".")
    script = F.when(kind.endswith("cyrillic"), "cyrillic").otherwise("latin")
    pool = F.when(script == "latin", F.array(*map(F.lit, SYLLABLES["latin"]))).otherwise(F.array(*map(F.lit, SYLLABLES["cyrillic"])))
    first = kind.startswith("first:")
    n = F.when(first, F.greatest(F.lit(0), attempt - GROW + 1)).otherwise(3 + F.floor(attempt / 4).cast("int"))
    tail = F.array_join(F.transform(F.sequence(F.lit(1), F.least(F.lit(40), n)), lambda i: F.get(pool, byte(i) % F.size(pool))), "")
    named = F.lit("")
    for (of, gender), names in FIRST.items():
        named = F.when((script == of) & kind.startswith(f"first:{gender}"),
                       F.get(F.array(*[F.lit(x.lower()) for x in names]), byte(F.lit(60)) % len(names))).otherwise(named)
    return values.select("kind", "canon", "attempt", F.when(kind == "ip", octets)
                         .when(kind == "email", F.concat("shaped", F.lit("."), F.regexp_extract(canon, r"([^.]+)$", 1)))
                         .when(kind == "card", F.concat("shaped", check.cast("string")))
                         .when(kind == "key", F.concat(F.lit("AKIA"), "shaped"))
                         .when(first, F.concat(named, F.when(n > 0, tail).otherwise("")))
                         .when(kind.startswith("last:"), tail).otherwise(F.col("shaped")).alias("surrogate"))


def assign(values, key=KEY):
    """One surrogate per (kind, canon): all different within a kind, and none a value of the corpus."""
    values = materialize(values.select("kind", "canon").distinct(), "pii-values")
    fixed = values.filter("kind = 'title'").select("kind", "canon", F.col("canon").alias("surrogate"))
    todo = values.filter("kind <> 'title'").withColumn("attempt", F.lit(0))
    # A first name may take another first name of the corpus: the pool is small, and names are not unique anyway.
    taken = [values.filter("kind <> 'title' and kind not like 'first:%'").select("kind", F.col("canon").alias("surrogate"))]
    done = [fixed]
    while True:
        made = with_surrogate(todo, key)
        owner = made.groupBy("kind", "surrogate").agg(F.min("canon").alias("owner"))
        held = reduce(lambda a, b: a.unionByName(b), taken).distinct().withColumn("held", F.lit(True))
        tried = materialize(made.join(owner, ["kind", "surrogate"]).join(held, ["kind", "surrogate"], "left")
                            .withColumn("free", F.col("held").isNull() & (F.col("canon") == F.col("owner"))), "pii-tried")
        good = tried.filter("free").select("kind", "canon", "surrogate")
        done.append(good)
        taken.append(good.select("kind", "surrogate"))
        todo = tried.filter("not free").select("kind", "canon", (F.col("attempt") + 1).alias("attempt"))
        if todo.isEmpty():
            return reduce(lambda a, b: a.unionByName(b), done)


def _in_case(value, shape):
    return F.when(shape == F.upper(shape), F.upper(value)).when(F.substring(shape, 1, 1) == F.upper(F.substring(shape, 1, 1)),
                                                               F.initcap(value)).otherwise(value)


def written(m, kind, found):
    """The surrogates of a mention in the mention's own form; ``found``: its surrogates in order."""
    one = F.get(found, F.lit(0))
    # a secret in the case of each of its letters: copies in capitals stay copies, and values that differ in case differ
    secret = F.array_join(F.zip_with(F.split(one, ""), F.split(F.regexp_replace(m, "^" + _SECRET, ""), ""),
                                     lambda c, was: F.when(was.rlike("[A-Z]"), F.upper(c)).otherwise(c)), "")
    chars = F.filter(F.split(m, ""), lambda c: c != "")
    slots = F.array_join(F.transform(chars, lambda c, i: F.when(c.rlike("[0-9A-Za-z]"), F.substring(
        one, F.length(F.regexp_replace(F.array_join(F.slice(chars, 1, i + 1), ""), "[^0-9A-Za-z]", "")), 1)).otherwise(c)), "")
    names = F.array_join(F.transform(F.arrays_zip(F.split(m, " ").alias("was"), found.alias("now")),
                                     lambda x: F.when(x["was"] == x["now"], x["now"]).otherwise(_in_case(x["now"], x["was"]))), " ")
    return (F.when(kind == "name", names).when(kind.isin("phone", "card", "ssn", "iban"), slots)
            .when(kind == "secret", F.concat(F.regexp_extract(m, "^(" + _SECRET + ")", 1), secret))
            .when((kind == "email") & (m == F.upper(m)), F.upper(one)).otherwise(one))


def replacements(found, key=KEY):
    """mention, replacement: every distinct mention; ``found``: a frame with a column of mentions."""
    seen = found.distinct()
    parts = materialize(seen.select("mention", kind_of(F.col("mention")).alias("of"))
                        .select("mention", "of", F.posexplode(values_of(F.col("mention"), F.col("of"))).alias("at", "value"))
                        .select("mention", "of", "at", "value.kind", "value.canon"), "pii-mentions")
    named = parts.join(assign(parts, key), ["kind", "canon"]).groupBy("mention", "of") \
        .agg(F.sort_array(F.collect_list(F.struct("at", "surrogate"))).alias("s"))
    return materialize(named.select("mention", written(F.col("mention"), F.col("of"), F.col("s.surrogate")).alias("replacement")),
                       "pii-replacements")


def replace_pii(docs, key=KEY):
    """The documents with all columns, their text with surrogates."""
    clean = docs.filter(F.coalesce(~F.col("text").rlike(PATTERN), F.lit(True)))
    # equal texts get equal replacements, so a text is known by its digest
    digest = F.concat(F.sha2(F.col("text"), 256), F.length("text").cast("string"))
    packed = docs.select(F.struct("*").alias("row"), mentions(F.col("text")).alias("found"), digest.alias("of")) \
        .filter(F.size("found") > 0)
    packed = materialize(packed, "pii-documents")
    known = replacements(packed.select(F.explode("found").alias("mention")), key)
    lists = packed.select("of", "found").dropDuplicates(["of"]) \
        .select("of", F.posexplode("found").alias("at", "mention")).join(known, "mention") \
        .groupBy("of").agg(F.sort_array(F.collect_list(F.struct("at", "replacement"))).alias("r"))
    joined = packed.select("row", "of").join(lists, "of")
    text = F.array_join(F.transform(F.split(F.col("row.text"), PATTERN, -1), lambda gap, i: F.concat(
        gap, F.coalesce(F.get(F.col("r.replacement"), i), F.lit("")))), "")
    changed = joined.select(*[(text if c == "text" else F.col("row").getField(c)).alias(c) for c in docs.columns])
    return clean.unionByName(changed)


@query("op2_pii_surrogates")
def op2(spark, sf):
    return replace_pii(table(spark, sf, "documents"))
