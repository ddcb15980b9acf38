"""Line dedup against plain loops, with filters of one and of many slices."""

import collections
import hashlib

import pytest
from pyspark.sql import functions as F

from scoutlake.llm import bloom, line_dedup

from llm_samples import with_extra

LOWER = {i: i + 32 for i in range(65, 91)}


def key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)


def wanted(rows):
    far = float("inf")
    first = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            first[key(line)] = min(first.get(key(line), far), far if doc is None else doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 10 or first[key(x)] == (far if doc is None else doc)]
        out.append((doc, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return collections.Counter(out)


def result(docs):
    return collections.Counter(tuple(r) for r in line_dedup.dedup_lines(docs).select("doc_id", "kept_text", "n_lines", "n_dropped").collect())


ODD = [(1, "Shared line here\nown one\nshared LINE here \n"), (2, "\tSHARED line here\nÄÖÜÄÖÜÄÖÜ"), (2, "\tSHARED line here\nÄÖÜÄÖÜÄÖÜ"),
       (3, "ÄÖÜÄÖÜÄÖÜ\nÄÖÜÄÖÜÄÖÜX\näöüäöüäöüx"), (4, "ÄÖÜÄÖÜÄÖÜX\nabcdefghi\nabcdefghij"), (5, "abcdefghi\nabcdefghij\r"), (None, "abcdefghij"),
       (None, "only without an id"), (None, "only without an id"), (7, None), (8, ""), (9, "\n\n"), (10, "x\x00shared zero byte\n shared blank kept"),
       (11, "x\x00shared zero byte\n shared blank kept"), (12, "x" * 300_000), (13, "X" * 300_000 + "\nrest"), (-5, "X" * 300_000)]


@pytest.mark.parametrize("segment, slice_, hot", [(1 << 20, 256, 2_000), (64, 2, 2_000), (64, 1, 3)])
def test_odd_rows(spark, monkeypatch, segment, slice_, hot):
    for name, value in (("SEGMENT", segment), ("SLICE", slice_)):
        monkeypatch.setattr(bloom, name, value)
    monkeypatch.setattr(line_dedup, "HOT", hot)
    rows = spark.createDataFrame(ODD, "doc_id long, text string").repartition(3)
    assert result(with_extra(rows)) == wanted(ODD)


def test_sample(documents, rows, monkeypatch):
    monkeypatch.setattr(bloom, "GATHERED", 500)
    assert result(with_extra(documents)) == wanted(rows)


def test_empty_table(empty):
    assert not result(with_extra(empty))


def test_no_filter_forgets(spark):
    digests = [hashlib.sha256(str(i).encode()).digest() for i in range(5_000)]
    held = [digests[i % 4_000:i % 4_000 + 3] for i in range(0, 5_000, 2)]
    df = spark.createDataFrame([(h,) for h in held], "d array<binary>").repartition(4)
    n = collections.Counter(d for h in held for d in set(h))
    for once, least in ((False, 2), (True, 1)):
        segments = 3
        bits = {r["segment"]: r["bits"] for r in bloom.seen_twice(df, segments, once).collect()}
        ok = dict(zip(digests, bloom.held(digests, bits, segments)))
        assert all(ok[d] for d, c in n.items() if c >= least)
        assert sum(ok[d] for d in digests if n[d] < least) < 50


def test_suspects_are_few(spark):
    rows = spark.createDataFrame([(i, f"a line that only document {i} has\n" + ("a line that many have" if i % 50 == 0 else "")) for i in range(3_000)],
                                 "doc_id long, text string").repartition(4)
    marks = line_dedup.line_digests(rows)
    segments = bloom.segments_for(3_060)
    twice = bloom.Filter(bloom.seen_twice(marks.select("digests"), segments), segments)
    found = line_dedup.suspected(marks, segments, twice, 0)
    assert 60 <= found.count() < 200
    assert found.filter(F.col("digest") == F.lit(hashlib.sha256(b"a line that many have").digest())).count() == 60
