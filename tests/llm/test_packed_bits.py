"""Packed bits of token files against plain shifts, for every width."""

import numpy as np
import pytest

from scoutlake.llm import token_files


@pytest.mark.parametrize("n", [1, 7, 1024])
def test_low_bits_are_packed_lowest_first(n):
    rng = np.random.default_rng(n)
    for width in range(33):
        values = rng.integers(0, 2**32, (3, n), dtype="u8").astype("<u4")
        packed = token_files.pack_bits(values, width)
        low = values & np.uint32((1 << width) - 1)
        for row, want in zip(packed, low):
            whole = sum(int(v) << (i * width) for i, v in enumerate(want))
            assert row.tobytes() == whole.to_bytes(-(-n * width // 8), "little")
            assert (token_files.unpack_bits(row.tobytes(), n, width) == want).all()
