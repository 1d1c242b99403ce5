"""Licence scans by a positional index of rare licence words.

Licence notices are templates: their words with positions, and the phrases that must
stand.  The index keeps, for every phrase, its rarest word by the counts of the whole
corpus, with its place in the template.  A file looks up its own words in it; what it finds
are places where a template may begin.  Those of one template are intersected by relative
position, with some slack for names and years, and the phrases of the templates that are
left are compared word by word.  A phrase cannot stand without its rarest word, so nothing
is missed however common the words are.  Built-in column expressions only, and no shuffle
of texts.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Names of licences, and notices as their licences give them, without marks.
# The phrases that must stand are in braces.
NAMES = {
    "gpl": "gnu general public license",
    "apache": "apache license",
    "cc-by": "cc by",
    "mit": "mit license",
}
NOTICES = {
    "apache-2.0": "licensed under the {apache license version 2 0} the license you may not use this file except in compliance with the license",
    "bsd": "{redistribution and use in source and binary forms with or without modification are permitted} provided that the following conditions are met redistributions of source code must {retain the above copyright notice} this list of conditions and the following disclaimer",
    "cc-by-4.0": "this work is licensed under {cc by 4 0}",
    "cc-by-nc-4.0": "this work is licensed under {cc by nc} {4 0}",
    "cc-by-sa-4.0": "this work is licensed under {cc by sa} {4 0}",
    "gpl-2.0": "under the terms of the {gnu general public license} as published by the free software foundation either {version 2} of the license or at your option any later version",
    "gpl-3.0": "under the terms of the {gnu general public license} as published by the free software foundation either {version 3} of the license or at your option any later version",
    "isc": "{permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted} provided that the above copyright notice and this permission notice appear in all copies the software is provided as is and {the author disclaims all warranties}",
    "lgpl": "under the terms of the {gnu lesser general public license} as published by the free software foundation",
    "mit-text": "{permission is hereby granted free of charge to any person obtaining a copy} of this software and associated documentation files the software {to deal in the software without restriction}",
    "mpl-2.0": "this source code form is subject to the terms of the {mozilla public license v 2 0}",
    "unlicense": "this is {free and unencumbered software released into the public domain}",
}
#: Words by which the phrases of a notice may be nearer or farther than in the template.
SLACK = 8


@dataclass(frozen=True)
class Template:
    """Phrases that must stand, each with the place of its first word in the template."""

    label: str
    phrases: tuple[tuple[int, tuple[str, ...]], ...]

    @classmethod
    def read(cls, label: str, text: str) -> Template:
        found, at = [], 0
        for part in re.findall(r"\{[^}]*\}|[^{}\s]+", text):
            words = tuple(part.strip("{}").split())
            if part.startswith("{"):
                found.append((at, words))
            at += len(words)
        if not found:
            raise ValueError(f"no phrase of {label} must stand")
        return cls(label, tuple(found))


def templates(names: dict[str, str], notices: dict[str, str]) -> tuple[list[Template], list[Template]]:
    """Names, whose every word must stand, and notices."""
    return [Template.read(k, f"{{{v}}}") for k, v in names.items()], [Template.read(k, v) for k, v in notices.items()]


def words_of(text: Column) -> Column:
    """The words of a text, A-Z in lower case; null: none."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(0))


def document_counts(words: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """How many rows have each word of a vocabulary, which bounds the result; all rows
    count."""
    mine = F.array_distinct(F.filter("words", lambda w: w.isin(vocabulary)))
    rows = words.select(F.explode(mine).alias("word")).groupBy("word").count().collect()
    return dict.fromkeys(vocabulary, 0) | {r["word"]: r["count"] for r in rows}


def _starts(phrase: tuple[str, ...], counts: dict[str, int]) -> tuple[str, Column]:
    """(rarest word of a phrase, places where the phrase may begin by that word)."""
    rare = min(phrase, key=lambda w: (counts[w], w))
    before = phrase.index(rare)
    mine = F.filter("hits", lambda i: (F.get("words", i) == rare) & (i >= before))
    return rare, F.transform(mine, lambda i: i - before)


def _standing(starts: Column, phrase: tuple[str, ...]) -> Column:
    """Those of the places where all words of the phrase stand."""
    said = F.array(*[F.lit(w) for w in phrase])
    return F.filter(starts, lambda i: F.slice("words", i + 1, len(phrase)) == said)


def _begins(template: Template, places: dict[tuple[str, ...], Column], slack: int) -> Column:
    """Where a template begins: by its first phrase, and all others within the slack."""
    shifted = lambda at, phrase: F.transform(places[phrase], lambda i: i - at)
    out = shifted(*template.phrases[0])
    for at, phrase in template.phrases[1:]:
        near = F.flatten(F.transform(shifted(at, phrase), lambda i: F.sequence(i - slack, i + slack)))
        out = F.array_intersect(out, near)
    return out


def license_scan(
    docs: DataFrame,
    names: dict[str, str] = NAMES,
    notices: dict[str, str] = NOTICES,
    slack: int = SLACK,
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): n_words, and the ``names`` and ``notices``
    found as arrays of (label, start).

    A notice's start is where its template would begin, which may lie before the text.  Word
    counts that choose the index are taken over all rows.  A null text is empty and has no
    words; rows do not depend on each other; other columns are not looked at; an empty table
    gives an empty one.  A row's words are held as one array.
    """
    named, noticed = templates(names, notices)
    phrases = list(dict.fromkeys(p for t in named + noticed for _, p in t.phrases))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), words_of(F.col("text").cast("string")).alias("words"))
    counts = document_counts(rows, sorted({w for p in phrases for w in p}))

    index = {p: _starts(p, counts) for p in phrases}
    rare = sorted({word for word, _ in index.values()})
    n = F.size("words")
    nothing = F.array().cast("array<int>")
    every = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(nothing)
    rows = rows.withColumn("hits", F.filter(every, lambda i: F.get("words", i).isin(rare)))

    # Columns by number, so that one place's arrays are worked out once per row.
    may = {p: f"may_{i}" for i, p in enumerate(phrases)}
    stands = {p: f"stands_{i}" for i, p in enumerate(phrases)}
    some = F.size("hits") > 0
    rows = rows.select("doc_id", "words", *[F.when(some, index[p][1]).otherwise(nothing).alias(may[p]) for p in phrases])
    anchored = {p: F.col(c) for p, c in may.items()}
    left = {t: F.size(_begins(t, anchored, slack)) > 0 for t in named + noticed}

    def standing(p: tuple[str, ...]) -> Column:
        wanted = reduce(or_, [near for t, near in left.items() if p in [x for _, x in t.phrases]])
        return F.when(wanted, _standing(F.col(may[p]), p)).otherwise(nothing)

    rows = rows.select("doc_id", n.cast("long").alias("n_words"), *[standing(p).alias(stands[p]) for p in phrases])
    places = {p: F.col(stands[p]) for p in phrases}
    found = lambda t: F.transform(_begins(t, places, slack), lambda i: F.struct(F.lit(t.label).alias("label"), i.alias("start")))
    empty = F.array().cast("array<struct<label:string,start:int>>")
    return rows.select(
        "doc_id",
        "n_words",
        F.concat(empty, *[found(t) for t in named]).alias("names"),
        F.concat(empty, *[found(t) for t in noticed]).alias("notices"),
    )


def license_report(docs: DataFrame) -> DataFrame:
    """Counts, places and labels of what ``license_scan`` finds, and a score: 1 if a notice
    stands, a half if only a name does, 0 otherwise."""
    found = license_scan(docs)
    labels = lambda c: F.transform(c, lambda x: x.label)
    joined = lambda a: F.array_join(F.array_sort(F.array_distinct(a)), ",")
    starts = F.transform("names", lambda x: x.start)
    return found.select(
        "doc_id",
        "n_words",
        F.size("names").cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        joined(labels("names")).alias("base_labels"),
        joined(F.concat(labels("names"), labels("notices"))).alias("labels"),
        F.when(F.size("notices") > 0, 1.0).when(F.size("names") > 0, 0.5).otherwise(0.0).alias("score"),
    )


def _sql_list(words: tuple[str, ...]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def oracle() -> str:
    """The report as SQL that compares every phrase at every place."""
    named, noticed = templates(NAMES, NOTICES)
    phrases = list(dict.fromkeys(p for t in named + noticed for _, p in t.phrases))
    rows = ",\n    ".join(f"({i}, {_sql_list(p)})" for i, p in enumerate(phrases))
    parts = ",\n    ".join(
        f"('{t.label}', {str(t in named).lower()}, {n}, {at}, {phrases.index(p)}, {len(t.phrases)})"
        for t in named + noticed
        for n, (at, p) in enumerate(t.phrases)
    )
    return rf"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM documents
), phrases(phrase, said) AS (VALUES
    {rows}
), parts(label, name, n, at_word, phrase, n_phrases) AS (VALUES
    {parts}
), stands AS (
  SELECT doc_id, phrase, i - 1 AS start
  FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM words WHERE len(w) > 0) JOIN phrases ON said[1] = w[i]
  WHERE w[i : i + len(said) - 1] = said
), begins AS (
  SELECT doc_id, label, name, start - at_word AS start, n_phrases FROM stands JOIN parts USING (phrase) WHERE n = 0
), found AS (
  SELECT b.doc_id, b.label, b.name, b.start
  FROM begins b LEFT JOIN parts p ON p.label = b.label AND p.n > 0
  LEFT JOIN stands s ON s.doc_id = b.doc_id AND s.phrase = p.phrase AND abs(s.start - p.at_word - b.start) <= {SLACK}
  GROUP BY ALL HAVING count(DISTINCT CASE WHEN s.start IS NOT NULL THEN p.n END) = any_value(b.n_phrases) - 1
), sums AS (
  SELECT doc_id, count(*) FILTER (name) AS n_base, min(start) FILTER (name) AS first_word, max(start) FILTER (name) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (name) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels,
    bool_or(NOT name) AS noticed
  FROM found GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  (CASE WHEN noticed THEN 1.0 WHEN n_base > 0 THEN 0.5 ELSE 0.0 END)::DOUBLE AS score
FROM words d LEFT JOIN sums USING (doc_id)
"""
