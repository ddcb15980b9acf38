"""Token alignment against the libraries on whole texts and plain loops."""

import collections
import hashlib
import random

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from scoutlake.llm import alignment
from scoutlake.llm.tokens import byte_letters, public_path

from llm_samples import with_extra

A, B = public_path("byte_bpe_50k.json"), public_path("piece_bpe_32k.model")


class Libraries:
    """Ids and bytes of whole texts by the libraries as they are."""

    def __init__(self):
        self.a = Tokenizer.from_file(A)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B)
        self.byte = {chr(c): b for b, c in byte_letters().items()}

    def piece(self, i):
        p = self.b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode()

    def groups(self, text):
        """Groups as (ids of A, ids of B), or None without tokens."""
        if not text:
            return None
        want = (" " + text).encode()
        a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        cut_a = [bytes(self.byte[c] for c in self.a.id_to_token(i)) for i in a]
        cut_b = [self.piece(i) for i in b]
        if b"".join(cut_a) != want or b"".join(cut_b) != want:
            return None
        found, i, j = [], 0, 0
        while i < len(a):
            at, to = (i, j), [len(cut_a[i]), len(cut_b[j])]
            i, j = i + 1, j + 1
            while to[0] != to[1]:
                if to[0] < to[1]:
                    to[0] += len(cut_a[i])
                    i += 1
                else:
                    to[1] += len(cut_b[j])
                    j += 1
            found.append((a[at[0]:i], b[at[1]:j]))
        return found


LIBRARIES = Libraries()


def wanted(rows):
    """Result rows by plain loops over all documents."""
    cut = [LIBRARIES.groups(t) for _, t in rows]
    links = [collections.Counter((x, y) for a, b in g or () for x in a for y in b) for g in cut]
    held = collections.Counter(p for c in links for p in c)
    most = {}
    for (x, _), n in held.items():
        most[x] = max(most.get(x, 0), n)
    out = []
    for (doc, _), g, c in zip(rows, cut, links):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g or ())
        out.append((doc, sum(len(a) for a, _ in g or ()), sum(len(b) for _, b in g or ()), len(g or ()), sum(c.values()),
                    sum(n for p, n in c.items() if held[p] == most[p[0]]), sum(n * held[p] for p, n in c.items()),
                    "" if g is None else hashlib.sha256(text.encode()).hexdigest()))
    return collections.Counter(out)


def result(docs):
    got = alignment.align_tokens(docs, A, B)
    return collections.Counter(tuple(r) for r in got.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect())


@pytest.mark.parametrize("common", [200_000, 40])
def test_whole_result(documents, rows, monkeypatch, common):
    monkeypatch.setattr(alignment, "COMMON", common)
    assert result(with_extra(documents)) == wanted(rows)


def test_empty_table(empty):
    assert not result(with_extra(empty))


@pytest.mark.parametrize("large", [4096, 2])
def test_odd_texts(monkeypatch, large):
    monkeypatch.setattr(alignment, "LARGE", large)
    rng = random.Random(11)
    parts = ["a", "Be", "é", " ", "  ", "\n", "\t", "'s", ".", ",", "9", "ß", " ", "日", "́", "\r\n", "<|endoftext|>", "<s>", "İ", "▁", "ab.",
             "word", "\x00", "　", "x" * 40, "😀"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(800)]
    texts += ["日本語のテキスト" * 300, " " * 5000, "\n" * 3000, "ab" * 4000, "word " * 3000, " lead", "trail ", "\n", " ", "<|endoftext|>", None]
    both = alignment.Aligner(A, B)
    for at in range(0, len(texts), 100):
        for text, found in zip(texts[at:at + 100], both.documents(texts[at:at + 100])):
            g = LIBRARIES.groups(text)
            assert (found is None) == (g is None), text
            if g is None:
                continue
            want = collections.Counter((x, y) for a, b in g for x in a for y in b)
            n_a, n_b, n_groups, n_links, written, pairs, times = found
            assert written == ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g), text
            assert (n_a, n_b, n_groups, n_links) == (sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(want.values()))
            assert dict(zip(zip((pairs >> 32).tolist(), (pairs & 0xFFFFFFFF).tolist()), times.tolist())) == want


def test_pointers_end_at_the_token_that_closes_the_group():
    a, b = np.array([2, 5, 9, 12]), np.array([1, 4, 8, 9, 12])
    ta, tb = alignment.terminals(a, b)
    assert ta.tolist() == [2, 2, 2, 3] and tb.tolist() == [2, 2, 2, 2, 3]
    assert alignment.terminals(np.array([3]), np.array([1, 2, 3]))[1].tolist() == [0, 0, 0]
