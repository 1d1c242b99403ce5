import numpy as np
import pyarrow as pa

from tidemark.llm import textops as T
from tidemark.llm.minhash import near_duplicates
from tidemark.llm.substring_dedup import remove_repeats


def word_pair(n):
    """Two words of n letters that any polynomial with an odd base over a byte table hashes alike."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def hashes(texts, seed=0):
    buf, off = T.text_bytes(pa.array(texts))
    begin, end, counts = T.word_bounds(buf, off)
    return T.word_hashes(buf, begin, end, seed), counts


def test_word_hashes_depend_on_the_word_alone():
    words = ["a", "ab", "ba", "aab", "aba", "é", "x" * 300, "x" * 301, *word_pair(1024), *word_pair(2048)]
    found, _ = hashes([" ".join(words), " ".join(reversed(words)), "\n".join(words) + " "])
    assert len(set(found.tolist())) == len(words)
    n = len(words)
    assert np.array_equal(found[:n], found[n : 2 * n][::-1]) and np.array_equal(found[:n], found[2 * n :])
    assert not set(found.tolist()) & set(hashes([" ".join(words)], 1)[0].tolist())


def test_word_hashes_of_texts_beyond_a_slice(monkeypatch):
    words = [f"w{i % 97}" * (i % 5 + 1) for i in range(4000)] + ["z" * 5000]
    whole, _ = hashes([" ".join(words)])
    monkeypatch.setattr(T, "SLICE_BYTES", 1000)
    assert np.array_equal(whole, hashes([" ".join(words)])[0])


def test_window_hashes_are_of_the_words_in_order():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 3, 3000)
    ids = np.array([7, 11, 13], np.uint64)[words]
    for k in (1, 3, 5, 7, 10, 20):
        starts = np.arange(len(ids) - k + 1)
        found = T.window_hashes(ids, starts, k)
        assert len(set(found.tolist())) == len({tuple(words[i : i + k]) for i in starts})
        by_window = {}
        for i, h in zip(starts, found.tolist(), strict=True):
            assert by_window.setdefault(tuple(words[i : i + k]), h) == h


def test_operators_tell_such_words_apart(docs):
    a, b = word_pair(1024)
    rows = docs([(1, f"{a} " * 20), (2, f"{b} " * 20), (3, " ".join([a, b] * 10)), (4, " ".join([b, a] * 10))])
    removed = {r.doc_id: r.n_removed for r in remove_repeats(rows).collect()}
    assert removed == {1: 0, 2: 0, 3: 0, 4: 0}
    assert all(r.kept and r.n_shingles in (1, 2) for r in near_duplicates(docs([(1, f"{a} " * 20), (2, f"{b} " * 20)])).collect())
