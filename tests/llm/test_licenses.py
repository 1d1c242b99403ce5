"""Licence scans against a search at every place."""

import random
import re

import pytest

from tests.conftest import plan_of
from tidemark.llm import licenses as L


def words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(L.WORD, lowered)


def expected(text, slack=L.SLACK):
    w = words(text)
    at = lambda p: [i for i in range(len(w)) if tuple(w[i : i + len(p)]) == p]
    named, noticed = L.templates(L.NAMES, L.NOTICES)
    names = sorted((t.label, i) for t in named for i in at(t.phrases[0][1]))
    notices = []
    for t in noticed:
        (zero, first), *rest = t.phrases
        for i in at(first):
            o = i - zero
            if all(any(abs(j - k - o) <= slack for j in at(p)) for k, p in rest):
                notices.append((t.label, o))
    return len(w), names, sorted(notices)


NOTICE = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction"
)
FIXED = [
    None, "", " .,;", "The MIT License (MIT)", "mit license MIT\nLICENSE", "CC-BY-NC 4.0 cc by", "cc by nc " + "x " * 9 + "4 0",
    "cc by nc " + "x " * 8 + "4 0", NOTICE, NOTICE.replace("associated", "all the very many associated"),
    "GNU general public licence", "İ GNU General Public License, version 3.", "gnu" * 50, "Apacheé License apache  license",
    "Licensed under the Apache License, Version 2.0.", "mit licen\u017fe mit \u212A license", "mit license " * 3000 + "cc by nc 4 0",
]


@pytest.fixture
def texts():
    rng = random.Random(3)
    vocabulary = "gnu general public license apache mit cc by nc 4 0 version 2 3 the of, word".split()
    made = [rng.choice([" ", ".\n", "-"]).join(rng.choices(vocabulary, k=rng.randint(1, 60))) for _ in range(150)]
    return FIXED + made + made[:20]


def found(row):
    pairs = lambda c: sorted((x["label"], x["start"]) for x in c)
    return row["n_words"], pairs(row["names"]), pairs(row["notices"])


def test_equal_to_a_search_at_every_place(spark, texts):
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS words", "1 AS hits")
    got = {r["doc_id"]: found(r) for r in L.license_scan(df).collect()}
    assert got == {i: expected(t) for i, t in rows}


def test_the_index_follows_the_corpus_and_results_do_not(spark, texts):
    rows = spark.createDataFrame([(1, t) for t in texts], "doc_id long, text string")
    counts = L.document_counts(rows.select(L.words_of(rows["text"]).alias("words")), ["gnu", "apache", "license", "zebra"])
    assert counts == {w: sum(w in set(words(t)) for t in texts) for w in counts}
    common = [("gnu public " * 5, 1)] * 300
    more = rows.unionByName(spark.createDataFrame([(2, t) for t, _ in common], "doc_id long, text string"))
    pick = lambda df: sorted(map(found, L.license_scan(df).where("doc_id = 1").collect()))
    assert pick(more) == pick(rows)


def test_report(spark):
    rows = [(None, "MIT License. Apache License; mit license"), (3, None), (3, "Licensed under CC BY-NC 4.0."), (4, "no licence")]
    report = L.license_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = sorted(tuple(r) for r in report if r["doc_id"] is not None)
    assert got == [
        (3, 0, 0, None, None, "", "", 0.0),
        (3, 7, 1, 2, 2, "cc-by", "cc-by,cc-by-nc-4.0", 1.0),
        (4, 2, 0, None, None, "", "", 0.0),
    ]
    (other,) = [tuple(r) for r in report if r["doc_id"] is None]
    assert other == (None, 6, 3, 0, 4, "apache,mit", "apache,mit", 0.5)


def test_native_without_shuffle_and_empty(spark, texts):
    plan = plan_of(L.license_report(spark.createDataFrame([(1, t) for t in texts], "doc_id long, text string")))
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
    assert L.license_report(spark.createDataFrame([], "doc_id long, text string")).count() == 0
