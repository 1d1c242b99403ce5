import hashlib
import random
import re

from tidemark.llm.substring_dedup import remove_repeats, without_repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window):
    """{(doc_id, place among equal ids): (words, removed, kept)}"""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    seen, out = set(), []
    for doc_id, text in rows:
        words = WORD.findall(text or "")
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            key = tuple(words[i : i + window])
            if key in seen:
                gone[i : i + window] = [True] * window
            seen.add(key)
        kept = [w for w, g in zip(words, gone, strict=True) if not g]
        out.append((doc_id, len(words), sum(gone), " ".join(kept)))
    return out


def shape(expected):
    return sorted(
        ((d, n, r, hashlib.sha256(k.encode()).hexdigest()) for d, n, r, k in expected), key=str
    )


def got(df):
    cols = ("doc_id", "n_words", "n_removed", "kept_sha256")
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


def passages(rng):
    words = ["a", "b", "ç", "x1", "the", "of"]
    shared = [[rng.choice(words) + str(rng.randrange(40)) for _ in range(rng.randrange(5, 60))] for _ in range(12)]
    rows = []
    for i in range(120):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            parts += rng.choice(shared) if rng.random() < 0.4 else [f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(30))]
        sep = rng.choice([" ", "\n", "\t ", "\x0b", "  "])
        rows.append((i * 7 % 101, sep.join(parts)))
    return rows


def test_same_as_brute_force(docs):
    rows = passages(random.Random(5))
    rows += [(500, "spam " * 300), (501, "spam " * 300), (502, None), (503, ""), (None, rows[0][1]), (None, None)]
    rows += [rows[3], rows[3], (504, "  " * 25)]
    assert got(remove_repeats(docs(rows))) == shape(brute(rows, 20))
    assert got(remove_repeats(docs(rows), window=7, anchor=4)) == shape(brute(rows, 7))


def test_empty_table(docs):
    assert remove_repeats(docs([])).collect() == []


def test_texts_without_repeats_stay(docs, spark):
    text = "one  two\n" * 3
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(1, text), (2, passage), (3, f"before {passage}\nafter"), (4, None)]
    frame = docs(rows).selectExpr("*", "1 as block", "'x' as data", "2 as n_words")
    out = {r.doc_id: r for r in without_repeats(frame).collect()}
    assert out[1].text == text and out[2].text == passage and out[4].text is None
    assert out[3].text == "before after" and out[3].n_chars == 12
    assert out[3].block == 1 and out[3].n_words == 2
    assert without_repeats(frame).columns == frame.columns


def test_spans_name_the_removed_words(docs):
    passage = " ".join(f"p{i}" for i in range(30))
    out = {r.doc_id: r for r in remove_repeats(docs([(1, passage), (2, f"x y {passage} z")])).collect()}
    assert [tuple(s) for s in out[2].removed] == [(2, 30)] and out[1].removed == []
