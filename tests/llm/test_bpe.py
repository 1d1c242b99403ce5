import hashlib
import random
import struct

import public_tokenizers as P
import pytest
import tiktoken

from tidemark.llm.bpe import Encoder, Vocabulary, bpe_report, decoded, encode_ids, with_ids

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary.load(PATH)


@pytest.fixture(scope="module")
def reference(vocabulary):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={})


def texts(rng):
    alphabet = ["'", "s", "t", "re", "ve", "ll", " ", "  ", "\n", "\t", "\xa0", " ", "\x1c", "a", "é", "日本", "1", "²", "Ⅷ", ".", "!", "🙂", "́", "\x00", "ſ", "İ", "'S", "<|endoftext|>"]
    made = ["".join(rng.choices(alphabet, k=rng.randrange(40))) for _ in range(400)]
    made += ["a" * 5000, "ab" * 3000, " " * 700 + "x", "=" * 999 + "\n", "".join(rng.choices("abcdefgh", k=4000))]
    return made + ["", " ", "\n", "'", "'s", "x's's 'll", "don't I'VE we've", "a \n b", "a \n", "\n\n x", " 'tis"]


def test_same_ids_as_the_public_library(vocabulary, reference):
    import pyarrow as pa

    some = texts(random.Random(3))
    got = encode_ids(pa.array(some), vocabulary)
    for text, ids in zip(some, got, strict=True):
        assert ids.tolist() == reference.encode_ordinary(text), repr(text)


def test_forgetting_changes_nothing(vocabulary, reference, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr("tidemark.llm.bpe.KEPT_PIECES", 50)
    monkeypatch.setattr("tidemark.llm.bpe.PIECES", 7)
    monkeypatch.setattr("tidemark.llm.bpe.IDS", 11)
    encoder = Encoder(vocabulary)
    for seed in range(3):
        some = texts(random.Random(seed))[:60]
        ids, counts = encoder.encode(pa.array(some))
        assert ids.tolist() == [i for t in some for i in reference.encode_ordinary(t)]
        assert encoder.decode(ids, counts) == [t.encode() for t in some]


def test_report_and_columns(docs, vocabulary, reference):
    some = texts(random.Random(9))
    rows = [*enumerate(some), (9000, None), (9001, None), (5, some[5])]
    frame = docs(rows).selectExpr("*", "1 as ids", "2 as n_tokens")
    expected = []
    for i, text in rows:
        ids = reference.encode_ordinary(text or "")
        raw = struct.pack(f"<{len(ids)}I", *ids)
        expected.append((i, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, bpe_report(frame, vocabulary).collect())) == sorted(expected)
    back = decoded(with_ids(frame, vocabulary), vocabulary).collect()
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in back)
    assert bpe_report(docs([]), vocabulary).collect() == []


def test_decoding_keeps_invalid_sequences(vocabulary):
    import numpy as np

    ids = np.array([vocabulary.ranks[b"\xe6"], vocabulary.ranks[b"\x00"]], dtype=np.int32)
    assert Encoder(vocabulary).decode(ids, np.array([1, 0, 1])) == [b"\xe6", b"", b"\x00"]


def thue_morse(n):
    return "".join("ab"[bin(i).count("1") % 2] for i in range(n)), "".join("ba"[bin(i).count("1") % 2] for i in range(n))


def long_pieces():
    rng = random.Random(12)
    letters = lambda n, of="abcdefghijklmnopqrstuvwxyz": "".join(rng.choices(of, k=n))
    periodic = "abcde" * 3_000 + letters(500) + "xyz" * 4_000
    return [
        letters(20_000), letters(300_000), "a" * 1_000_000, " " * 250_000, "x" * 777 + letters(300, "ACGT") + "x" * 3_331,
        periodic, letters(30_000, "ACGT"), letters(20_000, "日本語東京"), "=" * 50_001, *thue_morse(1024), *thue_morse(2048),
        *(letters(n) for n in (191, 192, 193, 319, 320, 321, 385)),
    ]


def test_long_pieces(vocabulary, reference):
    import pyarrow as pa

    for text in long_pieces():
        (ids,) = encode_ids(pa.array([text]), vocabulary)
        assert ids.tolist() == reference.encode_ordinary(text), (len(text), text[:20])


def test_pieces_of_one_hash_are_told_apart(vocabulary, reference, monkeypatch):
    import numpy as np
    import pyarrow as pa

    from tidemark.llm import textops as T

    true = T.word_hashes
    same = lambda buf, a, b, seed=0: true(buf, a, b, seed) if seed else np.minimum(true(buf, a, b), np.uint64(2**55))
    monkeypatch.setattr(T, "word_hashes", same)
    encoder, text = Encoder(vocabulary), "these words all have one hash"
    ids, _ = encoder.encode(pa.array([text]))
    assert ids.tolist() == reference.encode_ordinary(text) and encoder.seed == 1


def test_very_long_text_in_parts(docs, vocabulary, reference):
    rng = random.Random(4)
    words = ["the", "of", "é", "x's", "12", "\n", "  ", ".", "日本"]
    text = " ".join(rng.choices(words, k=1_400_000)) + "z" * 5_000
    assert len(text.encode()) > 4 << 20
    ids = reference.encode_ordinary(text)
    row = bpe_report(docs([(1, text)]), vocabulary).first()
    digest = hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
    assert tuple(row) == (1, len(ids), digest, hashlib.sha256(text.encode()).hexdigest())
