"""Pairs of Bloom filters over a Spark column of digests: which were seen at all, and which by two rows or more.

The bits are dealt into segments, and a digest has all its bits in one. Each task sends, per segment, the bits that its
rows set once and those they set twice; a segment is merged by one task that holds nothing but its two bitmaps: a bit
that two tasks set is a bit set twice. The twice-seen filter has no false negatives: all bits of a digest that two
rows hold were set twice. It is sized by the number of digests, ``BITS`` each, and taken to the tasks in slices of
at most ``SLICE`` segments, so what is broadcast at a time is bounded whatever the corpus.
"""

from pyspark.sql import functions as F

from .common import materialize, small

#: Bits of a segment, bits for each digest, bits that a digest sets.
SEGMENT = 1 << 20
BITS = 16
PROBES = 3
#: Segments of one slice: 32 MB of bits.
SLICE = 256
#: Bits that a task gathers before it sends them on.
GATHERED = 1_500_000


def segments_for(n):
    """Number of segments for n digests."""
    return max(1, -(-n * BITS // SEGMENT))


def places(digests, segments):
    """Segment of each digest (bytes of 24 or more) and its bits there, one row each."""
    import numpy as np

    size = len(digests[0]) if digests else 24
    words = np.frombuffer(b"".join(digests), "u1").reshape(-1, size)[:, :24].copy().view("<u8")
    step = np.arange(PROBES, dtype="u8")
    bits = (words[:, 1:2] + words[:, 2:3] * step) % np.uint64(SEGMENT)
    return (words[:, 0] % np.uint64(segments)).astype("i8"), bits.astype("i8")


def seen_twice(digests, segments, once=False):
    """Rows (segment, bits) of the filter of digests that two or more rows hold (``once``: one or more).

    ``digests``: a frame with one column, an array of the different digests of each row.
    """
    def gather(batches):
        import numpy as np
        import pyarrow as pa

        def send(held):
            at, n = np.unique(np.concatenate(held), return_counts=True)
            seg, first = np.unique(at >> 20, return_index=True)
            ends = [*first[1:], len(at)]
            out = ([], [])
            for a, b in zip(first, ends):
                bit = (at[a:b] & (SEGMENT - 1)).astype("<u4")
                out[0].append(bit.tobytes())
                out[1].append(bit[n[a:b] > 1].tobytes())
            return pa.RecordBatch.from_arrays([pa.array(seg, pa.int64()), *[pa.array(c, pa.binary()) for c in out]],
                                              names=["segment", "seen", "again"])

        held, many = [], 0
        for batch in small(batches):
            found = [d for row in batch.column(0).to_pylist() for d in row or ()]
            if found:
                seg, bits = places(found, segments)
                held.append(np.unique(seg[:, None] << 20 | bits, axis=None) if once else (seg[:, None] << 20 | bits).ravel())
                many += len(held[-1])
            if many > GATHERED:
                yield send(held)
                held, many = [], 0
        if held:
            yield send(held)

    def merge(batches):
        import numpy as np
        import pyarrow as pa

        def done(segment, seen, again):
            bits = np.packbits(seen if once else again, bitorder="little").tobytes()
            return pa.RecordBatch.from_arrays([pa.array([segment], pa.int64()), pa.array([bits], pa.binary())],
                                              names=["segment", "bits"])

        last, seen, again = None, None, None
        for batch in batches:
            for segment, one, two in zip(*(c.to_pylist() for c in batch.columns)):
                if segment != last:
                    if last is not None:
                        yield done(last, seen, again)
                    last, seen, again = segment, np.zeros(SEGMENT, bool), np.zeros(SEGMENT, bool)
                one, two = np.frombuffer(one, "<u4"), np.frombuffer(two, "<u4")
                again[two] = True
                again[one] |= seen[one]
                seen[one] = True
        if last is not None:
            yield done(last, seen, again)

    sent = digests.mapInArrow(gather, "segment long, seen binary, again binary")
    return sent.repartition("segment").sortWithinPartitions("segment").mapInArrow(merge, "segment long, bits binary")


class Filter:
    """Slices of a filter, broadcast one at a time."""

    def __init__(self, rows, segments):
        self.rows, self.segments = materialize(rows, "bloom"), segments
        self.spark = rows.sparkSession
        self.slices = range(-(-segments // SLICE))

    def slice(self, number):
        """Broadcast {segment: bits} of a slice, at most ``SLICE`` segments of ``SEGMENT`` bits."""
        own = self.rows.filter((F.col("segment") >= number * SLICE) & (F.col("segment") < (number + 1) * SLICE))
        return self.spark.sparkContext.broadcast({r["segment"]: r["bits"] for r in own.collect()})


def held(digests, bits, segments):
    """Whether each digest may be in the filter; those of other slices are not."""
    import numpy as np

    ok = np.zeros(len(digests), bool)
    if digests:
        seg, bit = places(digests, segments)
        order = np.argsort(seg, kind="stable")
        of, first = np.unique(seg[order], return_index=True)
        for s, a, b in zip(of.tolist(), first, [*first[1:], len(seg)]):
            if s in bits:
                at, own = order[a:b], np.frombuffer(bits[s], "u1")
                ok[at] = ((own[bit[at] >> 3] >> (bit[at] & 7)) & 1).all(axis=1)
    return ok
