"""Words of letters and signs are encoded without a search for the split, with the ids of the library."""

import struct

import pytest
from tokenizers import Tokenizer

from scoutlake.llm.tokens import Encoder, public_path

FILE = public_path("byte_bpe_50k.json")


@pytest.mark.parametrize("text", ["thoredble*** éouaié, esññ. geungä ENONOR!!", "ab''\nßchlich.&&&\nVIPAÊ\nz"])
def test_no_search_for_letters_and_signs(text):
    enc = Encoder(FILE, "byte")
    enc.split = None
    ids = Tokenizer.from_file(FILE).encode(text, add_special_tokens=False).ids
    assert enc._part(text) == struct.pack(f"<{len(ids)}I", *ids)


def test_other_pieces_still_take_the_split():
    lib, enc = Tokenizer.from_file(FILE), Encoder(FILE, "byte")
    for text in ("don't I'll it's, a''s", "x2² 中文。 ж̀ ǅ ɐ. ªº×", "a\n\n's b  c\n'll\t."):
        ids = lib.encode(text, add_special_tokens=False).ids
        assert enc.ids(text) == struct.pack(f"<{len(ids)}I", *ids)
