"""Phrases and notices repeated close together keep their label and score."""

from scoutlake.llm import licenses


def test_repeated_phrases(spark):
    notice = "Licensed under the Apache License, Version 2.0."
    edited = "Licensed under the very new Apache License, Version 2.0."
    agpl = [t for x, t in licenses.NOTICES if x == "agpl"][0]
    tail = agpl.replace("the GNU", "the well known GNU") + " the free software foundation free software foundation" * 3
    cases = [("All rights reserved. All rights reserved.", "proprietary", 1), ("All rights reserved. " * 50, "proprietary", 1),
             ("MIT License " * 40, "mit", 1), ("left MIT License " * 40, "mit", 1), ("cc by x cc by cc by", "cc-by", 1),
             ("GNU General Public License " * 9, "gpl", 1), (f"{notice} " * 5, "apache", 1), (f"{edited} {notice} {edited}", "apache", 1),
             (tail, "agpl,lgpl", 0.8), ("all rights are reserved", "", 0), ("rights reserved all", "", 0)]
    docs = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(cases)], "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.scan(docs).collect()}
    for i, (text, labels, score) in enumerate(cases):
        assert got[i].labels == labels, text
        assert got[i].score >= score and (score or got[i].score == 0), text
