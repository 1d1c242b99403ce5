"""Alignment of two tokenizers against a plain walk over whole texts."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest

from tidemark.llm import alignment as A


@pytest.fixture(scope="module")
def pair():
    return A.TokenizerPair.load(*map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model")))


def spans(pieces):
    out, at = [], 0
    for i, b in pieces:
        out.append((i, at, at + len(b)))
        at += len(b)
    return out


def walked(text, pair):
    """(groups, links) of one text; None if it has no tokens."""
    if not text:
        return None
    said = " " + text
    a = [(i, pair.a_bytes[i]) for i in pair.a.encode(said, add_special_tokens=False).ids]
    b = [(i, pair.b_bytes[i]) for i in pair.b.encode(text)]
    if any(b"".join(x for _, x in t) != said.encode() for t in (a, b)):
        return None
    a, b = spans(a), spans(b)
    common = {e for _, _, e in a} & {e for _, _, e in b}
    groups, links = [], []
    mine = ([], [])
    i = j = 0
    for end in sorted({e for _, _, e in a} | {e for _, _, e in b}):
        links.append((a[i][0], b[j][0]))
        assert max(a[i][1], b[j][1]) < min(a[i][2], b[j][2])
        if a[i][2] == end:
            mine[0].append(a[i][0])
            i += 1
        if b[j][2] == end:
            mine[1].append(b[j][0])
            j += 1
        if end in common:
            groups.append(mine)
            mine = ([], [])
    assert mine == ([], []) and i == len(a) and j == len(b)
    return groups, links


def expected(rows, pair):
    found = [(i, walked(t, pair)) for i, t in rows]
    docs = Counter(p for _, f in found if f for p in set(f[1]))
    top = {}
    for (a, _), n in docs.items():
        top[a] = max(top.get(a, 0), n)
    out = []
    for i, f in found:
        if f is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        groups, links = f
        text = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        out.append((
            i, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links),
            sum(docs[p] == top[p[0]] for p in links), sum(docs[p] for p in links), hashlib.sha256(text.encode()).hexdigest(),
        ))
    return out


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(7)
    syllables = "the in qu é ß ü 東京 😀 <|endoftext|> <s> ' 's 12 345 , . ... ( foo_bar \n \t ﬁ é".split(" ")
    word = lambda: "".join(rng.choices(syllables, k=rng.randint(1, 4)))
    some = lambda n: " ".join(word() for _ in range(n))
    long_ = some(40_000)
    unbroken = "".join(rng.choices("abcdefghij", k=150_000))
    return [
        None, "", " ", "  two  spaces ", "\n", "a", "▁", "x ▁ y", "<0x41> A", "don't 's", " x", "x  y", long_, long_[:200_000],
        "東 京" * 20_000, unbroken, some(3_000) + " " + unbroken + " " + some(9_000), long_ + " ▁", " " * 70_000 + "x",
        *[some(rng.randint(1, 40)) for _ in range(120)],
    ]


def test_equal_to_a_walk_over_whole_texts(spark, pair, texts):
    rows = [(None if i % 50 == 7 else i, t) for i, t in enumerate(texts)]
    rows += rows[:30]  # repeated rows count again
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS block", "1 AS codes", "2 AS key")
    out = [tuple(r) for r in A.alignment_report(df.repartition(5), pair).collect()]
    key = lambda r: tuple((x is None, x or 0) if not isinstance(x, str) else (False, x) for x in r)
    assert sorted(out, key=key) == sorted(expected(rows, pair), key=key)
    assert sum(r[1] > 0 and len(t or "") > 66_000 for r, t in zip(expected(rows, pair), [t for _, t in rows], strict=True)) > 6


def test_fragments_compose_in_any_order(pair):
    rng = random.Random(2)
    text = " " + " ".join("".join(rng.choices(["qu", "é", "ab", "東", "12"], k=rng.randint(1, 6))) for _ in range(300))
    tokens, good = pair.tokens([text.encode()])
    n = len(text.encode())
    assert good.all()
    whole, closed = A.fragment(tokens, True)
    for _ in range(20):
        limits = [0, *sorted(rng.sample(range(1, n), n // 4)), n]
        parts = [A.fragment(tokens.between(a, b), a == 0) for a, b in zip(limits, limits[1:], strict=False)]
        edges = [f for f, _ in parts]
        assert any(not f.closed for f in edges) and any(len(f.prefix.a) for f in edges)
        while len(edges) > 1:
            i = rng.randrange(len(edges) - 1)
            edges[i : i + 2] = [A.Fragment.unpack(edges[i].pack()).then(edges[i + 1])]
        (root,) = edges
        assert len(root.prefix.a) == len(root.suffix.a) == 0
        pieces = sorted([c for _, c in parts if len(c.a)] + list(root.seams), key=lambda t: int(t.a_end[0]))
        named = "".join("".join(p.names(pair, p.common())) for p in pieces)
        assert named == "".join(closed.names(pair, closed.common()))
        assert sum(len(p.links()[0]) for p in pieces) == len(closed.links()[0])


def test_ranges_cover_the_bytes_and_tokenize_runs_twice_at_most(texts):
    for text in [t for t in texts if t and len(t) > 60_000]:
        data = b" " + text.encode()
        found = list(A.ranges(data))
        assert found[0][0] == 0 and found[-1][1] == len(data)
        assert all(a[1] == b[0] for a, b in zip(found, found[1:], strict=False))
        assert all(c <= a < b <= d for a, b, c, d in found)
        assert sum(d - c for _, _, c, d in found) <= 3 * len(data)


def test_empty_table(spark, pair):
    assert A.alignment_report(spark.createDataFrame([], "doc_id long, text string"), pair).count() == 0
