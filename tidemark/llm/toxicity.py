"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

The features are rates of what toxic writing shows: words of a lexicon, how near second
person words stand to them, capitals, punctuation, and disguised words.  The lexicon is a
short list of plain insults and the words and word beginnings that labelled texts show to be
typical.  Trees and calibration are fitted on disjoint labelled texts.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import textops as T
from tidemark.llm.shared import alone, cut

#: Labelled texts that the model is fitted on at most, the first by a hash of doc_id.
LABELLED = 40_000
#: Entries that the lexicon takes from labelled texts at most.
LEARNED = 2_000
THRESHOLD = 0.7
NEAR = 5
INSULTS = (
    "bastard clown creep disgusting dumb fool garbage hate idiot imbecile jerk liar loser moron "
    "pathetic pig scum shut stupid trash ugly vermin worthless"
).split()
YOU = frozenset(
    "you your yours yourself yourselves u ur ya thou thee tu te toi ton ta tes vous votre vos du dich dir "
    "dein deine deinen deiner ihr euch euer eure usted ustedes ti tus vosotros".split()
)
#: Characters that stand for letters in disguised words.
DISGUISE = str.maketrans("013457@$!|€", "oieastasiie")
_LETTERS = re.compile(r"[^\W\d_]+")
FEATURES = [
    "lexicon_rate", "lexicon_weight", "lexicon_top", "lexicon_kinds", "learned_rate", "near_rate",
    "you_rate", "capital_rate", "shouted_rate", "mark_rate", "shout_mark_rate", "disguised_rate",
    "disguised_hits", "repeat_rate", "mean_length", "log_words",
]


def plain(word: str) -> str:
    """The lower-case letters of a word."""
    return "".join(_LETTERS.findall(word.lower()))


def stems(letters: str) -> list[str]:
    """What the lexicon may know of a word: the word, and its beginnings of 4 to 6."""
    return [f"={letters}", *[letters[:n] for n in (4, 5, 6) if len(letters) > n]]


@dataclass(frozen=True)
class Lexicon:
    """Weights of words (``=word``) and word beginnings."""

    weights: dict[str, float]

    def weight(self, letters: str) -> float:
        """The largest weight of the word and its beginnings."""
        if not letters:
            return 0.0
        get, n = self.weights.get, len(letters)
        found = get("=" + letters, 0.0)
        if n > 4:
            found = max(found, get(letters[:4], 0.0))
            if n > 5:
                found = max(found, get(letters[:5], 0.0))
                if n > 6:
                    found = max(found, get(letters[:6], 0.0))
        return found


_KNOWN = frozenset(INSULTS)


_TRIPLE = re.compile(r"(.)\1\1", re.DOTALL)


def _repeats(word: str) -> float:
    return float(_TRIPLE.search(word) is not None)


def _word_facts(word: str, lexicon: Lexicon) -> tuple[float, ...]:
    """(weight, insult, learned, you, letters, capitals, shouted, marks, shout marks,
    disguised, disguised hit, repeats, length)"""
    if word.isalpha():  # most words: letters only
        letters = word.lower()
        letters = letters if letters.isalpha() else plain(word)
        weight, insult = lexicon.weight(letters), letters in _KNOWN
        capitals = 0 if word == letters else sum(map(str.isupper, word))
        return (
            max(weight, 2.0 * insult), float(insult), float(weight > 0), float(letters in YOU), len(letters), capitals,
            float(capitals > 1 and capitals == len(letters)), 0, 0, 0.0, 0.0, _repeats(word), len(word),
        )
    letters = plain(word)
    weight, insult = lexicon.weight(letters), letters in _KNOWN
    core = word.strip(".,;:!?\"'()[]")
    odd = core != "" and not core.isalpha()
    hidden = 0.0
    if odd:
        shown = plain(core.translate(DISGUISE))
        if shown != letters or len(core) != len(letters):
            found = max(lexicon.weight(shown), weight)
            hidden = float(found > 0 or shown in _KNOWN)
            weight, insult = max(weight, found), insult or shown in _KNOWN
    capitals = sum(map(str.isupper, word))
    marks = sum(not c.isalnum() for c in word)
    disguised = odd and len(letters) > 0 and len(core) > len(letters)
    return (
        max(weight, 2.0 * insult), float(insult), float(weight > 0), float(letters in YOU), len(letters), capitals,
        float(capitals > 1 and capitals == len(letters)), marks, word.count("!"), float(disguised), hidden,
        _repeats(word), len(word),
    )


def feature_matrix(column, lexicon: Lexicon) -> np.ndarray:
    """One row of ``FEATURES`` per text; all zero for a text without words."""
    buf, off = T.text_bytes(column)
    begin, end, counts = T.word_bounds(buf, off)
    n = len(counts)
    if len(begin) == 0:
        return np.zeros((n, len(FEATURES)))
    _, first, inverse = np.unique(T.word_hashes(buf, begin, end), return_index=True, return_inverse=True)
    raw = buf.tobytes()
    facts = np.array([_word_facts(raw[begin[i] : end[i]].decode("utf-8", "replace"), lexicon) for i in first])
    owner = np.repeat(np.arange(n), counts)
    total = lambda x: np.bincount(owner, x, n)
    of = facts[inverse].T
    weight, insult, learned, you, letters, capitals, shouted, marks, bangs, disguised, hidden, repeats, length = of
    hit = weight > 0
    seen = np.concatenate([[0], np.cumsum(you)])
    place = np.arange(len(owner))
    starts = np.cumsum(counts) - counts
    low = np.maximum(place - NEAR, starts[owner])
    high = np.minimum(place + NEAR + 1, (starts + counts)[owner])
    near = hit & (seen[high] > seen[low])
    top = np.zeros(n)
    np.maximum.at(top, owner, weight)
    pair = np.unique(owner[hit].astype(np.int64) * len(first) + inverse[hit])
    kinds = np.bincount(pair // len(first), minlength=n)
    words, chars = np.maximum(counts, 1), np.maximum(total(length), 1)
    columns = [
        total(insult) / words, total(weight) / words, top, np.minimum(kinds, 20), total(learned) / words, total(near) / words,
        total(you) / words, total(capitals) / np.maximum(total(letters), 1), total(shouted) / words,
        total(marks) / chars, total(bangs) / words, total(disguised) / words, total(hidden) / words,
        total(repeats) / words, total(length) / words, np.log1p(counts),
    ]
    return np.column_stack(columns)


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows whose labels are never learned from."""
    remainder = F.crc32(F.encode(F.col(doc_id).cast("string"), "UTF-8")) % 3
    return F.coalesce(remainder == 1, F.lit(False))


@dataclass
class ToxicityModel:
    lexicon: Lexicon
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    base_rate: float


def _features(docs: DataFrame, lexicon: Lexicon, *more: str) -> DataFrame:
    """doc_id, columns of whole numbers named, and the features of the text."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)
    kept = ["doc_id", *more]

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alone("toxicity")
        for batch in batches:
            for part in T.sliced(batch):
                matrix = feature_matrix(part.column("text"), shared.value)
                columns = [pa.array(matrix[:, i]) for i in range(len(FEATURES))]
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], *columns], names=[*kept, *FEATURES])

    schema = ", ".join([*[f"{c} long" for c in kept], *[f"{f} double" for f in FEATURES]])
    return docs.select(*[F.col(c).cast("long").alias(c) for c in kept], "text").mapInArrow(features, schema)


def _labelled(docs: DataFrame, labels: DataFrame, labelled: int) -> DataFrame:
    """(doc_id, label, text) of the texts to learn from, at most ``labelled`` ids, which
    bounds what is broadcast; an id with both labels is left out."""
    chosen = (
        labels.where(~held_out() & F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("toxic").cast("int").alias("label"), F.max("toxic").alias("most"))
        .where("label = most")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(labelled)
        .select("doc_id", "label")
    )
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text")


def _stems(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many toxic and clean texts of a slice have each word and beginning."""
    for batch in batches:
        for part in T.sliced(batch):
            toxic, clean = Counter(), Counter()
            for label, text in zip(part.column("label").to_pylist(), part.column("text").to_pylist(), strict=True):
                mine = {s for word in set((text or "").split()) for s in stems(plain(word)) if len(s) > 3}
                (toxic if label else clean).update(mine)
            every = [*toxic, *(s for s in clean if s not in toxic)]
            counts = [pa.array([c[s] for s in every], pa.int64()) for c in (toxic, clean)]
            yield pa.RecordBatch.from_arrays([pa.array(every, pa.string()), *counts], names=["stem", "toxic", "clean"])


def _learned_lexicon(texts: DataFrame, learned: int) -> Lexicon:
    """Words and beginnings that stand in many more toxic than other labelled texts."""
    n = {r["label"]: r["count"] for r in texts.select("doc_id", "label").distinct().groupBy("label").count().collect()}
    bad, good = max(n.get(1, 0), 1), max(n.get(0, 0), 1)
    odds = F.log((F.col("toxic") + 0.5) / (bad + 1)) - F.log((F.col("clean") + 0.5) / (good + 1))
    rows = (
        texts.select("label", "text")
        .mapInArrow(_stems, "stem string, toxic long, clean long")
        .groupBy("stem")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .where((F.col("toxic") >= max(3, bad // 400)) & (F.col("toxic") > 3 * F.col("clean")))
        .select("stem", odds.alias("weight"), "toxic")
        .where(F.col("weight") > math.log(8))
        .orderBy(F.desc(F.col("toxic") * F.col("weight")), "stem")
        .limit(learned)
        .toArrow()
    )
    weights = dict(zip(rows.column("stem").to_pylist(), rows.column("weight").to_pylist(), strict=True))
    return Lexicon(weights)


def fit_toxicity(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, learned: int = LEARNED) -> ToxicityModel:
    """Learns from the labels (doc_id, toxic) of at most ``labelled`` texts that are not held
    out.  Without texts of both labels the score is the rate of toxic ones.

    The labelled texts are picked in one pass over all texts and written to the shared
    folder; lexicon and features are taken from there.
    """
    texts = cut(_labelled(docs, labels, labelled), "labelled")
    lexicon = _learned_lexicon(texts, learned)
    table = cut(_features(texts, lexicon, "label").withColumn("label", F.col("label").cast("double")).repartition(8, "doc_id"), "toxicity")
    rates = table.agg(F.avg("label"), F.count(F.lit(1))).first()
    base = rates[0] or 0.0
    if base in (0.0, 1.0):
        return ToxicityModel(lexicon, None, None, base)
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(table)
    part = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(4))
    trees = GBTClassifier(
        labelCol="label", featuresCol="features", maxIter=30, maxDepth=3, stepSize=0.15, subsamplingRate=0.8,
        minInstancesPerNode=5, seed=7, cacheNodeIds=False,
    ).fit(rows.where(part != 0))
    judged = _raw(trees, rows.where(part == 0)).select("raw", "label")
    if judged.agg(F.count_distinct("label")).first()[0] < 2:
        judged = _raw(trees, rows).select("raw", "label")
    calibration = IsotonicRegression(featuresCol="raw", labelCol="label").fit(judged)
    return ToxicityModel(lexicon, trees, calibration, base)


def _raw(trees: GBTClassificationModel, rows: DataFrame) -> DataFrame:
    return trees.transform(rows).withColumn("raw", vector_to_array("probability")[1])


def toxicity_scores(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): held_out, score, predicted, and the trees'
    uncalibrated probability ``raw``.

    The score depends on the text alone.  A null text is scored as an empty one; a null
    doc_id is not held out.  Repeated rows get equal scores and an empty table gives an
    empty one.
    """
    rows = _features(docs, model.lexicon)
    if model.trees is None:
        scored = rows.withColumn("raw", F.lit(model.base_rate)).withColumn("score", F.col("raw"))
    else:
        rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)
        scored = model.calibration.setPredictionCol("score").transform(_raw(model.trees, rows))
    score = F.least(F.greatest("score", F.lit(0.0)), F.lit(1.0))
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        score.alias("score"),
        (score >= threshold).cast("int").alias("predicted"),
        "raw",
    )


def without_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows whose doc_id has a text scored at ``threshold`` or more; all
    columns stay, and rows with a null doc_id stay."""
    gone = toxicity_scores(docs, model, threshold).where("predicted = 1").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
