import random
import zlib

import pytest

from tidemark.llm.toxicity import FEATURES, Lexicon, feature_matrix, fit_toxicity, toxicity_scores, without_toxic


def held(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(6)
    words = [f"{a}{b}" for a in ("th", "er", "on", "re", "st") for b in ("ing", "ou", "at", "ble", "in")]
    bad = ["idiot", "moron", "blergson", "blergsit", "Loser", "1d1ot"]
    rows, labels = [], []
    for i in range(900):
        text = [rng.choice(words) for _ in range(rng.randrange(3, 60))]
        toxic = rng.random() < 0.3
        if toxic:
            for _ in range(1 + len(text) // 12):
                text.insert(rng.randrange(len(text) + 1), rng.choice(bad))
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_held_out_accuracy_and_edges(docs, rows, corpus):
    texts, labels = corpus
    more = [(5000, None), (5001, ""), (5002, "the " * 50_000), (None, "you idiot you moron")]
    table = rows("doc_id long, quality int, toxic int", [*labels, (None, 1, 1), (7777, 0, 1), (0, 1, None), (5001, 1, 0), (5001, 1, 1)])
    frame = docs(texts + more)
    model = fit_toxicity(frame, table)
    out = {r.doc_id: r for r in toxicity_scores(frame.selectExpr("*", "1 as raw", "2 as score"), model).collect()}
    truth = {i: t for i, _, t in labels}
    tests = [i for i in truth if held(i)]
    assert all(out[i].held_out == held(i) for i in truth) and out[None].held_out is False
    right = sum(out[i].predicted == truth[i] for i in tests)
    assert right / len(tests) > 0.93
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in out.values())
    assert out[5000].score == out[5001].score and out[5001].predicted == 0 and out[None].predicted == 1
    kept = without_toxic(frame, model)
    assert kept.columns == frame.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in out.items() if not r.predicted} | {None}


def test_labels_that_are_held_out_change_nothing(docs, rows, corpus):
    texts, labels = corpus
    some, schema = docs(texts[:300]), "doc_id long, toxic int"
    a = rows(schema, [(i, t) for i, _, t in labels[:300]])
    b = rows(schema, [(i, 1 - t if held(i) else t) for i, _, t in labels[:300]])
    scores = [{r.doc_id: r.score for r in toxicity_scores(some, fit_toxicity(some, x)).collect()} for x in (a, b)]
    assert scores[0] == pytest.approx(scores[1], abs=1e-9)


def test_without_labels_and_empty_tables(docs, rows):
    none = rows("doc_id long, toxic int", [])
    model = fit_toxicity(docs([(1, "a")]), none)
    assert [(r.score, r.predicted) for r in toxicity_scores(docs([(1, "a")]), model).collect()] == [(0.0, 0)]
    assert toxicity_scores(docs([]), model).collect() == []


def test_features():
    import pyarrow as pa

    lexicon = Lexicon({"=idiot": 3.0, "blerg": 2.0})
    texts = ["you are an IDIOT!!", "1d10t", "blergson far away from it all and so on you", None, "plain words"]
    rows = [dict(zip(FEATURES, r, strict=True)) for r in feature_matrix(pa.array(texts), lexicon)]
    assert rows[0]["lexicon_rate"] == 0.25 and rows[0]["near_rate"] == 0.25 and rows[0]["shouted_rate"] == 0.25
    assert rows[1]["disguised_hits"] == 1 and rows[1]["lexicon_top"] == 3
    assert rows[2]["learned_rate"] > 0 and rows[2]["near_rate"] == 0 and rows[2]["you_rate"] > 0
    assert not any(rows[3].values()) and rows[4]["lexicon_weight"] == 0
