"""Secrets after a keyword of any case and of any length, found by a detector that shares nothing with the operator."""

from scoutlake.llm import pii

from llm_samples import SF, with_extra

WORDS = ("password", "passwd", "secret", "token", "api_key")
VALUE = set("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_-")


def secrets(text):
    """Values of eight or more letters after a keyword, up to three blanks, = or :, up to three blanks and a quote."""
    text = text or ""
    low, found = "".join(c.lower() if c.isascii() else c for c in text), []
    for word in WORDS:
        at = low.find(word)
        while at >= 0:
            end = at + len(word)
            rest = text[end:]
            gap = len(rest) - len(rest.lstrip(" \t\n\r\f\v"))
            if not (at and text[at - 1].isalnum()) and gap <= 3 and rest[gap:gap + 1] in ("=", ":"):
                rest = rest[gap + 1:]
                gap = len(rest) - len(rest.lstrip(" \t\n\r\f\v"))
                rest = rest[gap:] if gap <= 3 else ""
                rest = rest[1:] if rest[:1] in ("'", '"') else rest
                n = next((i for i, c in enumerate(rest) if c not in VALUE), len(rest))
                if n >= 8:
                    found.append(rest[:n])
            at = low.find(word, end)
    return found


def test_any_case_and_length(spark, documents):
    hexed, long = "9233a8ec0123456789abcdef0123456789abcdef", "aB3-" * 1000 + "TheTail9"
    texts = [f'token = "{hexed}"', f'TOKEN = "{hexed.upper()}"', "API_KEY=abcdEFGH1234", "Password: hunter2Hunter2", "Secret:\tAAAAbbbb1",
             f"passwd={long} end", f"passwd={long.swapcase()} end", "the secret: short"]
    docs = with_extra(spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], documents.schema))
    out = {r.doc_id: r.text for r in pii.replace_pii(docs).collect()}
    was = {v for t in texts for v in secrets(t)}
    assert len(was) == 7
    now = {i: secrets(t) for i, t in out.items()}
    for i, t in enumerate(texts):
        assert [len(v) for v in now[i]] == [len(v) for v in secrets(t)] and not was & set(now[i]), i
        for old, new in zip(secrets(t), now[i]):
            assert all((a.isdigit(), a.isupper(), a.islower()) == (b.isdigit(), b.isupper(), b.islower()) for a, b in zip(old, new))
    assert out[1] == f'TOKEN = "{now[0][0].upper()}"' and out[0].startswith('token = "') and out[2].startswith("API_KEY=")
    assert now[6][0] == now[5][0].swapcase() and "TheTail9" not in out[5] and out[5].endswith(" end") and out[7] == texts[7]


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SF.rsplit('/', 1)[0]}/sf0.01/documents.parquet")
    was = {v for r in docs.select("text").collect() for v in secrets(r.text)}
    now = {v for r in pii.replace_pii(docs).select("text").collect() for v in secrets(r.text)}
    assert was and now and not was & now
