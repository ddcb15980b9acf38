"""Token ids of whole texts with a tokenizers file, remembered per word.

A text is cut at single blanks and line ends, where neither kind of file lets a token cross: a byte-level file
('byte') keeps one leading blank with the word, a word file ('word') drops white space. Equal words have equal ids,
so a worker merges a word once and keeps its ids as bytes. The memory is bounded by two generations of ``MEMO``
words. White space of any other form sends the part through the file's own split.

As in the library, a file's added tokens (such as end-of-text markers) that a text quotes are one id each, and what lies
between them is encoded by itself. A file whose added tokens strip blanks, match whole words or normalized text is left to the
library.
"""

import functools
import string
import struct

import regex

from .common import worker_state

MEMO = 400_000
#: A text is cut into parts of about this many characters, so that a very long one needs no list of all its words.
PART = 1 << 20
CUT = regex.compile(r"(?<=\S)(?= \S)")
SPACE = regex.compile(r"\s")
#: ASCII signs, and the last letter of the range that holds the same letters in every version of Unicode.
SIGNS = string.punctuation
LATIN = "\u024f"
#: Runs of signs that an encoder remembers.
RUNS = 4096
#: Fixed value: the split of byte-level files that name none of their own.
BYTE_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters():
    """Byte-level files write each byte as one letter: printable Latin-1 as itself, the others from 256 on."""
    kept = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return {b: b if b in kept else next(rest) for b in range(256)}


class Encoder:
    """``kind``: 'byte' for byte-level files that keep white space, 'word' for files that drop it."""

    def __init__(self, path, kind):
        import json

        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        added = tokenizer.get_added_tokens_decoder()
        self.added = {t.content: struct.pack("<I", i) for i, t in added.items() if t.content}
        self.at_added = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")").split
        self.library = None
        if any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in added.values()):
            self.library = lambda text: tokenizer.encode(text, add_special_tokens=False).ids
        self.normal = tokenizer.normalizer.normalize_str if tokenizer.normalizer else str
        self.word = kind == "word"
        split = BYTE_SPLIT
        self.has_own_split = self.word or not tokenizer.pre_tokenizer or "ByteLevel" not in repr(tokenizer.pre_tokenizer)
        if self.word:
            with open(path, encoding="utf-8") as f:
                split = json.load(f)["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.split = regex.compile(split).findall
        self.merge = tokenizer.model.tokenize
        self.vocabulary = functools.partial(tokenizer.get_vocab, with_added_tokens=False)
        self.letters = byte_letters()
        self.young, self.old = {}, {}
        self.signs = {}
        self.line_end = None if self.word else self._merge("\n")

    def _merge(self, words):
        ids = []
        for w in words:
            ids += [t.id for t in self.merge(w.encode().decode("latin-1").translate(self.letters))]
        return struct.pack(f"<{len(ids)}I", *ids)

    def plain_ids(self, text):
        """List of the ids of a text in which markers are ordinary text, without memory."""
        return [t.id for w in self.split(self.normal(text)) for t in self.merge(w.encode().decode("latin-1").translate(self.letters))]

    def plain(self, text):
        """Ids by the file's own split, without memory."""
        return self._merge(self.split(self.normal(text)))

    def _letters(self, word, blank):
        """Ids of letters up to ``LATIN`` by a byte file, with a blank before them or without."""
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(self.letters)
        ids = [t.id for t in self.merge("Ġ" + word if blank else word)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _signs(self, run):
        """Ids of ASCII signs that follow letters: one word of a byte file's split."""
        ids = self.signs.get(run)
        if ids is None:
            ids = self._merge([run])
            if len(self.signs) < RUNS:
                self.signs[run] = ids
        return ids

    def _word(self, piece):
        """Ids of a piece: as it stands for a word file, with a blank before it for a byte file; None: not a piece."""
        blank = "" if self.word else " "
        if self.word and piece.isascii():
            piece = piece.lower()  # all that the normalizer does to ASCII but for white space, which is dropped
        if blank and (piece.isascii() or self.normal is str):
            core = piece.rstrip(SIGNS)
            if core.isalpha() and max(core) <= LATIN:
                return self._letters(core, True) if core == piece else self._get(core) + self._signs(piece[len(core):])
        elif piece.isascii():
            if piece.isalpha():
                ids = [t.id for t in self.merge(piece)]
                return struct.pack(f"<{len(ids)}I", *ids)
            if piece[-1:] in (",", ".") and piece[:-1].isalpha():
                return self._get(piece[:-1]) + self._merge(piece[-1])
        if blank and piece[:1] == "\n":
            rest = self.normal(piece[1:])
            core = rest.rstrip(SIGNS)
            if core.isalpha() and max(core) <= LATIN:
                return self.line_end + self._letters(core, False) + (self._signs(rest[len(core):]) if core != rest else b"")
            return self.line_end + self._merge(self.split(rest)) if rest and not SPACE.search(rest) else None
        if blank and (not piece or SPACE.search(piece)):
            return None
        return self._merge(self.split(self.normal(blank + piece)))

    def _get(self, piece):
        ids = self.young.get(piece)
        if ids is None:
            ids = self.old.get(piece)
            if ids is None:
                ids = self._word(piece)
            if ids is not None:
                if len(self.young) >= MEMO:
                    self.young, self.old = {}, self.young
                self.young[piece] = ids
        return ids

    def _part(self, text):
        if self.word:
            pieces = text.replace("\n", " ").split(" ")
        else:
            pieces = ("\n" + text).replace("\n", " \n").split(" ")
            del pieces[0]
        found = list(map(self.young.get, pieces))
        if None in found:
            get = self._get
            found = [get(p) if f is None else f for p, f in zip(pieces, found)]
            if None in found:
                return self.plain(text)
        if not self.word:  # without the line end put before the text
            found[0] = found[0][4:]
        return b"".join(found)

    def ids(self, text):
        """Ids of the text as little-endian unsigned 32-bit integers, in bytes."""
        if not text:
            return b""
        if self.library:
            ids = self.library(text)
            return struct.pack(f"<{len(ids)}I", *ids)
        if any(t in text for t in self.added):
            return b"".join(self._plain_ids(p) if i % 2 == 0 else self.added[p] for i, p in enumerate(self.at_added(text)))
        return self._plain_ids(text)

    def _plain_ids(self, text):
        """Ids of a text without added tokens."""
        if not text:
            return b""
        if len(text) <= 2 * PART:
            return self._part(text)
        first, *rest = parts(text)
        return b"".join([self._part(first)] + [self._tail(p) for p in rest])

    def _tail(self, part):
        """Ids of a part that starts with the blank before its first word."""
        if self.word:
            return self._part(part)
        pieces = part[1:].replace("\n", " \n").split(" ")
        found = [self._get(p) for p in pieces]
        return self.plain(part) if None in found else b"".join(found)


def parts(text):
    """Cut a text where a single blank stands between two words, at least ``PART`` characters apart."""
    start = 0
    while start < len(text):
        m = CUT.search(text, start + PART) if start + PART < len(text) else None
        end = m.start() if m else len(text)
        yield text[start:end]
        start = end


def encoder(path, kind):
    """The worker's encoder for a file."""
    state = worker_state()
    key = ("encoder", path, kind)
    if key not in state:
        state[key] = Encoder(path, kind)
    return state[key]


@functools.lru_cache(maxsize=None)
def public_path(name):
    """Place of a public tokenizer file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)
