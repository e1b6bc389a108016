from cladeframe.llm.licenses import PHRASES, notices, parsed, scan_licenses
from cladeframe.llm.queries import op10_license_scan
from tests.conftest import SF
from tests.llm.test_decontaminate import words


def base(text):
    w = words(text)
    at = sorted(k for p in PHRASES for k in range(len(w)) if w[k : k + len(p.split())] == p.split())
    labels = sorted({label for p, label in PHRASES.items() if any(w[k : k + len(p.split())] == p.split() for k in range(len(w)))})
    return len(w), at, labels


def test_edges(edge_docs, edge_rows):
    got = sorted((str(r[0]), r.n_words, r.places, r.base_labels, r.score) for r in scan_licenses(edge_docs).collect())
    assert got == sorted((str(r[0]), *base(r[1]), 0.0) for r in edge_rows)


def test_empty(no_docs):
    assert scan_licenses(no_docs).count() == 0


def test_labels(spark):
    apache = "Licensed under the Apache License, Version 2.0 (the \"License\")"
    texts = ["x y. " + apache, "This is CC BY. And cc-by; all rights\nreserved!", "Released under the M.I.T License", "Released under the MIT License.", " ".join(parsed(notices()[2][1], 3)[0]).replace("except", "except really only"), "the public license of general use", "This work is licensed under the GNU General Public License, version 3."]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r.doc_id: r for r in scan_licenses(docs).collect()}
    assert [out[i].labels for i in range(7)] == [["apache-2.0"], ["cc-by", "reserved"], [], ["mit"], ["apache-2.0"], [], ["gpl"]]
    assert [out[i].places for i in (1, 6)] == [[2, 5, 7], [7]]
    assert (out[0].spans[0].first, out[0].spans[0].last, out[0].score) == (2, 9, 1.0)
    assert 0.8 <= out[4].score <= 1 and out[6].score == 1.0


def test_query(spark):
    docs = dict(map(tuple, spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()))
    for r in op10_license_scan(spark, SF).collect():
        n, at, labels = base(docs[r.doc_id])
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (n, len(at), min(at, default=None), max(at, default=None), ",".join(labels))
        assert set(labels) <= set(r.labels.split(",")) and 0 <= r.score <= 1


GNU = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} Public License as published by the Free Software Foundation, either version 3 of the License."


def test_families_are_told_apart(spark):
    """Each member of a family gives its own label (and what the base phrases give), and no other's."""
    cases = [
        (GNU.format("General"), ["gpl"]), (GNU.format("Lesser General"), ["gpl", "lgpl"]), (GNU.format("Library General"), ["gpl", "lgpl"]), (GNU.format("Affero General"), ["agpl", "gpl"]),
        ("This work is licensed under the GNU Lesser General Public License, version 3.", ["gpl", "lgpl"]), ("This work is licensed under the GNU Affero General Public License", ["agpl", "gpl"]),
        ("Licensed under CC BY-NC-ND 4.0", ["cc-by", "cc-by-nc-nd"]), ("Licensed under CC BY-SA 3.0.", ["cc-by", "cc-by-sa"]), ("Licensed under CC BY 4.0", ["cc-by"]), ("Licensed under CC BY-NC 4.0.", ["cc-by", "cc-by-nc"]),
        ("This work is licensed under a Creative Commons Attribution 4.0 International License", ["cc-by"]),
        ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", ["cc-by-sa"]),
        ("This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License", ["cc-by-nc-nd"]),
        ("Licensed under the Apache License, Version 2.0", ["apache-2.0"]), ("Licensed under the Apache Software License, Version 1.1", ["apache-1.1"]), ("Licensed under the Apache License, Version 3.0", []),
        ("Released under the BSD-like license, not the MIT one", []), ("the terms of the public license", []),
    ]
    docs = spark.createDataFrame([(i, f"some words before it. {t} and some after") for i, (t, _) in enumerate(cases)], "doc_id long, text string")
    got = {r.doc_id: r.labels for r in scan_licenses(docs).collect()}
    assert [(t, got[i]) for i, (t, _) in enumerate(cases)] == cases


def test_inserted_words_and_ties(spark):
    mit = "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"
    far = mit.replace("to any", "x y z u v w to any")
    docs = spark.createDataFrame([(0, mit.replace("charge to", "charge truly to")), (1, far), (2, f"{mit} {mit}"), (3, "a b c d e"), (4, "a b c")], "doc_id long, text string")
    out = {r.doc_id: [(s.label, s.first, s.last) for s in r.spans] for r in scan_licenses(docs).collect()}
    n = len(mit.split())
    assert out == {0: [("mit", 0, n)], 1: [], 2: [("mit", 0, n - 1), ("mit", n, 2 * n - 1)], 3: [], 4: []}
    tie = {r.doc_id: r.labels for r in scan_licenses(docs, templates=[("x", "a b c"), ("y", "a b c"), ("z", "a b c d e")]).collect()}
    assert tie[4] == ["x", "y"] and tie[3] == ["z"]
