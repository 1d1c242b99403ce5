import hashlib

from tidemark.llm.merkle import differences, edited, fingerprint, fingerprint_report, fingerprints, likeness

TEXT = "\n".join(f"line {i} has some words in it and is {i * i} long" for i in range(40)) + "\n\nlast section"


def brute(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    out = []
    for k, (i, t) in enumerate(rows):
        t, nxt = t or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(t) // 2
        e = t[: len(t) - half] + nxt[:half]
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), fingerprint(t), fingerprint(e), likeness(fingerprint(t), fingerprint(e)), likeness(fingerprint(t), fingerprint(nxt))))
    return sorted(out, key=str)


def test_report_follows_the_order_of_ids(docs):
    rows = [(i * 37 % 101, f"{i} " * (i % 17) + "é\n" * (i % 3)) for i in range(100)]
    rows += [(None, "n"), (None, None), (5000, ""), (5000, "b"), (5000, "b"), (6000, TEXT)]
    frame = docs(rows).selectExpr("*", "1 as block", "2 as fingerprint")
    assert sorted(map(tuple, fingerprint_report(frame).collect()), key=str) == brute(rows)
    for few in ([(1, "alone with itself")], [(None, None)], [(1, "a b"), (2, "c d")]):
        assert sorted(map(tuple, fingerprint_report(docs(few)).collect()), key=str) == brute(few)
    assert fingerprint_report(docs([])).collect() == []


def test_equal_roots_only_for_equal_texts():
    variants = ["", " ", "\n", "\n\n", "a b c d e", "a b c d\ne", "a b c d e ", "a  b c d e", "a\n\nb", "a\nb", TEXT, TEXT + "\n"]
    assert len({fingerprint(t).partition(":")[0] for t in variants}) == len(variants)
    assert fingerprint(None) == fingerprint("")


def test_edits_are_located_and_change_little():
    lines = TEXT.split("\n")
    lines[20] = lines[20].replace("some", "other")
    changed = "\n".join(lines)
    assert differences(fingerprint(TEXT), fingerprint(changed)) == [(1, 4)]
    assert differences(fingerprint(TEXT), fingerprint(TEXT)) == []
    assert likeness(fingerprint(TEXT), fingerprint(TEXT)) == 1
    assert 0.9 < likeness(fingerprint(TEXT), fingerprint(changed)) < 1
    assert likeness(fingerprint(TEXT), fingerprint("nothing of that kind here")) == 0
    half = edited(TEXT, "other words " * 500)
    assert 0.35 < likeness(fingerprint(TEXT), fingerprint(half)) < 0.65


def test_column(docs):
    out = {r.doc_id: r for r in fingerprints(docs([(1, "a"), (2, None), (3, "")])).collect()}
    assert out[1].fingerprint == fingerprint("a") and out[2].fingerprint == out[3].fingerprint
