"""Token ids in binary files of patched frame-of-reference blocks.

A file holds the ids of whole documents, one after the other, in blocks of ``BLOCK`` ids. A block stores its minimum
and, bit-packed, the low bits of the differences to it; the width is that of the ``SHARE`` percentile, and the larger
differences have their high bits in an exception list. The end of the file indexes where each block starts and where
each document ends, so a document is read from its own blocks alone.

Layout, little-endian: magic, blocks, then per block its start (u64), then per document its id (i64), a flag for a null
id (u8) and its end (u64), then three u64: where the index starts, number of blocks, number of documents.
Block: minimum (u32), ids (u32), width (u8), exceptions (u32), packed bits, positions (u16), high bits (u32).

Files are written under a name of the attempt, moved when complete, and listed in a table that only successful tasks
fill; a lost task leaves at most a file that no list names. Defined results: a null text is an empty document; null
ids come first; repeated rows are written each, in the order of id and text; an empty table gives no rows.
"""

import struct
import uuid
import zlib

from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import materialize, qualified, query, scratch_path, small, table
from .tokens import encoder, public_path

MAGIC = b"SLPFOR1\n"
BLOCK = 1024
SHARE = 0.95
#: Ids in a file, but for a document that is longer by itself.
FILE_IDS = 4_000_000
HEAD = "<IIBI"
LIST = "part int, file int, path string, n_docs long, n_ids long"


def pack_bits(values, width):
    """Rows of values as bytes, ``width`` bits each, lowest bit first."""
    import numpy as np

    if width == 0:
        return np.zeros((values.shape[0], 0), "u1")
    rows, n = values.shape
    bits = np.unpackbits(np.ascontiguousarray(values, "<u4").view("u1").reshape(rows, n, 4), axis=2, bitorder="little")
    return np.packbits(bits[:, :, :width].reshape(rows, n * width), axis=1, bitorder="little")


def unpack_bits(data, n, width):
    import numpy as np

    if width == 0:
        return np.zeros(n, "<u4")
    bits = np.unpackbits(np.frombuffer(data, "u1"), count=n * width, bitorder="little").reshape(n, width)
    return bits.astype("<u4") @ (np.uint32(1) << np.arange(width, dtype="<u4"))


def encode_blocks(ids):
    """Blocks of the ids (u32 array), as a list of bytes."""
    import numpy as np

    out = []
    whole = len(ids) // BLOCK
    groups = [(ids[:whole * BLOCK].reshape(whole, BLOCK), BLOCK)] if whole else []
    if len(ids) % BLOCK:
        groups.append((ids[whole * BLOCK:].reshape(1, -1), len(ids) % BLOCK))
    for rows, n in groups:
        for at in range(0, len(rows), 256):
            part = rows[at:at + 256].astype("<u4")
            low = part.min(axis=1)
            diff = part - low[:, None]
            mark = np.partition(diff, int(SHARE * (n - 1)), axis=1)[:, int(SHARE * (n - 1))]
            widths = np.array([int(m).bit_length() for m in mark])
            blocks = [None] * len(part)
            for width in np.unique(widths):
                own = np.flatnonzero(widths == width)
                packed = pack_bits(diff[own], int(width))
                high = diff[own] >> np.uint32(width) if width < 32 else np.zeros_like(diff[own])
                for k, i in enumerate(own):
                    where = np.flatnonzero(high[k])
                    blocks[i] = b"".join([struct.pack(HEAD, int(low[i]), n, int(width), len(where)), packed[k].tobytes(),
                                          where.astype("<u2").tobytes(), high[k][where].astype("<u4").tobytes()])
            out += blocks
    return out


def decode_block(data, start):
    import numpy as np

    low, n, width, extra = struct.unpack_from(HEAD, data, start)
    at = start + struct.calcsize(HEAD)
    size = -(-n * width // 8)
    values = unpack_bits(data[at:at + size], n, width)
    if extra:
        at += size
        where = np.frombuffer(data, "<u2", extra, at)
        values[where] |= np.frombuffer(data, "<u4", extra, at + 2 * extra) << np.uint32(width)
    return values + np.uint32(low)


def file_bytes(doc_ids, ends, ids):
    """A whole file for documents that end at ``ends`` in the ids."""
    import numpy as np

    blocks = encode_blocks(ids)
    starts = np.cumsum([len(MAGIC)] + [len(b) for b in blocks]).astype("<u8")
    return b"".join([
        MAGIC, *blocks, starts[:-1].tobytes(), np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
        np.array([d is None for d in doc_ids], "u1").tobytes(), np.array(ends, "<u8").tobytes(),
        struct.pack("<3Q", int(starts[-1]), len(blocks), len(doc_ids))])


class TokenFile:
    """Reads documents of a file's bytes."""

    def __init__(self, data):
        import numpy as np

        if data[:len(MAGIC)] != MAGIC:
            raise ValueError("not a token file")
        self.data = data
        index, n_blocks, n_docs = struct.unpack_from("<3Q", data, len(data) - 24)
        self.starts = np.frombuffer(data, "<u8", n_blocks, index)
        at = index + 8 * n_blocks
        null = np.frombuffer(data, "u1", n_docs, at + 8 * n_docs)
        self.doc_ids = [None if z else int(d) for d, z in zip(np.frombuffer(data, "<i8", n_docs, at), null)]
        self.ends = np.frombuffer(data, "<u8", n_docs, at + 9 * n_docs)

    def ids(self, k):
        """Ids of the k-th document, from the blocks that hold it."""
        import numpy as np

        start, end = int(self.ends[k - 1]) if k else 0, int(self.ends[k])
        if start == end:
            return np.zeros(0, "<u4")
        first = start // BLOCK
        got = np.concatenate([decode_block(self.data, int(s)) for s in self.starts[first:(end - 1) // BLOCK + 1]])
        return got[start - first * BLOCK:end - first * BLOCK]

    def documents(self):
        """(id, first id's place, ids) of each document, each block decoded once."""
        import numpy as np

        held, held_at, block = np.zeros(0, "<u4"), 0, 0
        start = 0
        for doc, end in zip(self.doc_ids, map(int, self.ends)):
            got = [held[start - held_at:]]
            have = held_at + len(held)
            while have < end:
                held, held_at = decode_block(self.data, int(self.starts[block])), have
                got.append(held)
                have += len(held)
                block += 1
            yield doc, start, np.concatenate(got)[:end - start]
            start = end


def _store(path):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def write_token_files(docs, folder, path, kind="byte", end_id=0):
    """Write all documents in ascending order of id; returns the list of files (columns of ``LIST``).

    A folder without a scheme is one of the cluster's default file system.
    """
    folder = qualified(docs.sparkSession, folder)

    def write(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        enc, end = encoder(path, kind), end_id.to_bytes(4, "little")
        part, rows = TaskContext.get().partitionId(), []
        doc_ids, ends, held, n = [], [], [], 0

        def flush():
            nonlocal doc_ids, ends, held, n
            store, root = _store(folder)
            store.create_dir(root, recursive=True)
            name = f"{root}/part-{part:06d}-{len(rows):06d}-{uuid.uuid4().hex}"
            with store.open_output_stream(f"{name}.tmp") as f:
                f.write(file_bytes(doc_ids, ends, np.frombuffer(b"".join(held), "<u4")))
            store.move(f"{name}.tmp", f"{name}.ids")
            rows.append((part, len(rows), f"{folder}/{name.rpartition('/')[2]}.ids", len(doc_ids), n))
            doc_ids, ends, held, n = [], [], [], 0

        for batch in small(batches):
            for doc, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = enc.ids(t) + end
                doc_ids.append(doc)
                held.append(ids)
                n += len(ids) // 4
                ends.append(n)
                if n >= FILE_IDS:
                    flush()
        if doc_ids:
            flush()
        cols = list(zip(*rows)) or [[]] * 5
        types = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                         names=["part", "file", "path", "n_docs", "n_ids"])

    ordered = docs.select(F.col("doc_id").cast("long"), "text") \
        .repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    return materialize(ordered.mapInArrow(write, LIST), "token-files")


def read_token_files(files):
    """Documents of the listed files: doc_id, start over all files, n_tokens, ids_crc32."""
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("n_part"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n_part").over(before), F.lit(0)).alias("part_base"))
    within = Window.partitionBy("part").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.join(parts, "part").select(
        "path", (F.col("part_base") + F.coalesce(F.sum("n_ids").over(within), F.lit(0))).alias("base"))

    def read(batches):
        import pyarrow as pa

        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                store, name = _store(path)
                with store.open_input_stream(name) as f:
                    whole = TokenFile(f.read())
                rows = [(d, base + s, len(ids), zlib.crc32(ids.astype("<u4").tobytes()))
                        for d, s, ids in whole.documents()]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)],
                                                 names=["doc_id", "start", "n_tokens", "ids_crc32"])

    spread = max(1, files.count())
    return placed.repartition(spread, "path").mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


@query("op8_token_files")
def op8(spark, sf):
    files = write_token_files(table(spark, sf, "documents"), scratch_path(spark, "ids"), public_path("byte_bpe_50k.json"))
    return read_token_files(files)
