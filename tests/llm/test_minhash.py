import random
import re

import pytest

from tests.llm.test_components import brute as union
from tidemark.llm import minhash
from tidemark.llm.minhash import near_duplicates, without_near_duplicates

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def brute(rows, percent):
    sets = {i: shingles(t) for i, t in rows if i is not None}
    ids = sorted(sets)
    links = [
        (a, b)
        for k, a in enumerate(ids)
        for b in ids[k + 1 :]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    root = union(links)
    return {(i, len(sets[i]), root.get(i, i), root.get(i, i) == i) for i in ids}


def family(rng, base, n, edits):
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randrange(edits)):
            words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(8)
    text = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    texts = [" ".join(text(rng.randrange(1, 60))) for _ in range(60)]
    for n, edits in ((150, 4), (200, 5), (60, 3), (30, 8)):
        texts += family(rng, text(n), 25, edits)
    texts += ["a b c d e f"] * 5 + ["A B\tc  D e F", "a b c", "A b C", "x", "", None, "  ", "a b c d"]
    texts += ["spam " * 3000, "spam " * 8]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("percent", [80, 85])
def test_same_as_brute_force(docs, corpus, percent):
    frame = docs(corpus).selectExpr("*", "1 as rep", "2 as size", "3 as component")
    assert set(map(tuple, near_duplicates(frame, percent).collect())) == brute(corpus, percent)


def test_tiles_change_nothing(docs, corpus, monkeypatch):
    monkeypatch.setattr(minhash, "BAND_TILE", 6)
    monkeypatch.setattr(minhash, "SET_TILE", 5)
    assert set(map(tuple, near_duplicates(docs(corpus), 85).collect())) == brute(corpus, 85)


def test_nulls_repeated_rows_and_empty_table(docs):
    rows = [(None, "a b c d e f"), (None, None), (4, "a b c d e f"), (4, "a b c d e f"), (2, "A b c d e f"), (9, "")]
    out = sorted(map(tuple, near_duplicates(docs(rows)).collect()), key=str)
    assert out == sorted(
        [(None, 2, None, True), (None, 0, None, True), (4, 2, 2, False), (4, 2, 2, False), (2, 2, 2, True), (9, 0, 9, True)],
        key=str,
    )
    assert near_duplicates(docs([])).collect() == []


def test_one_of_each_group_stays(docs):
    rows = [(1, "a b c d e f"), (2, "a b c d e f"), (3, "g h i j k"), (3, "g h i j k"), (None, "x"), (7, None)]
    frame = docs(rows).selectExpr("*", "1 as kept")
    out = without_near_duplicates(frame)
    assert out.columns == frame.columns
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == sorted([(1, "a b c d e f"), (3, "g h i j k"), (None, "x"), (7, None)], key=str)
