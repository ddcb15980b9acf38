"""Texts that quote a file's added tokens, against the library as it is."""

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from scoutlake.llm import packing, token_counts, tokens

KINDS = [("byte_bpe_50k.json", "byte"), ("word_bpe_49k.json", "word")]
MARKED = ["a <|endoftext|> b", "<|endoftext|>", "a<|endoftext|><|startoftext|>\n\n<|endoftext|>  b c", "<|EndOfText|>", "none", ""]


@pytest.mark.parametrize("name, kind", KINDS)
def test_ids_equal_the_unchanged_library(name, kind, monkeypatch):
    path = tokens.public_path(name)
    library, enc = Tokenizer.from_file(path), tokens.Encoder(path, kind)
    rng = random.Random(6)
    parts = ["a", "Be", "é", " ", "  ", "\n", "\t", "'s", ".", "9", "日", "\r\n", "<|endoftext|>", "<|startoftext|>", "<|endof", "İ", "ab."]
    texts = MARKED + ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(600)]
    for part in (1 << 20, 8):
        monkeypatch.setattr(tokens, "PART", part)
        for text in texts:
            assert np.frombuffer(enc.ids(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_added_tokens_that_strip(tmp_path):
    library = Tokenizer.from_file(tokens.public_path(KINDS[0][0]))
    from tokenizers import AddedToken

    library.add_tokens([AddedToken("<sep>", lstrip=True, rstrip=True)])
    library.save(str(tmp_path / "f.json"))
    enc = tokens.Encoder(str(tmp_path / "f.json"), "byte")
    for text in ("a <sep> b", "a b", "a  <sep><|endoftext|> b"):
        assert np.frombuffer(enc.ids(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_operators(spark):
    docs = spark.createDataFrame(list(enumerate(MARKED)), "doc_id long, text string")
    path = tokens.public_path("byte_bpe_50k.json")
    own = [Tokenizer.from_file(path).encode(t, add_special_tokens=False).ids for t in MARKED]
    counts = {r.length: r.n_docs for r in token_counts.length_histogram(docs, path).collect()}
    assert counts == {n: [len(x) for x in own].count(n) for n in map(len, own)}
    path = tokens.public_path("word_bpe_49k.json")
    own = [[*Tokenizer.from_file(path).encode(t, add_special_tokens=False).ids, 1] for t in MARKED]
    got = {r.doc_id: (r.length, r.ids_crc32) for r in packing.pack(docs, path).collect()}
    assert got == {i: (len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in enumerate(own)}
