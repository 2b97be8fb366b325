"""License scans with a positional rare-token index over notice templates.

The postings of a template are the places of its words; its mandatory phrases stand at fixed places in it. For each file the
licence words with the highest IDF that it holds are looked up, of each template the ``ANCHORS`` rarest words among its phrases,
so that no template is crowded out by another. Their places in the file, less their places in the template, are
candidate offsets; a template's offsets are the intersection over its looked-up words. At such an offset every phrase is
verified word by word, and the share of the template that stands there, weighted by IDF, is its score. A phrase holds its
rarest words, so nothing that verification would accept is lost.

All of it is DataFrame functions on the row of a file: texts don't move, no key can be hot, and only document counts of the templates' words
(bounded by the templates) are shuffled and collected.

Defined results: null and empty texts have no words; repeated rows are scanned each; further columns are ignored; an
empty table gives no rows. Letters outside A-Z keep their case.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkwatch.operators.columns import computed_once

ANCHORS = 3  # rarest words of a template's phrases that are looked up
SHARE = 0.8  # of a template's weight that has to stand in the file for its label
MAX_TEMPLATE_WORDS = 20_000  # all templates together, as they travel with the plan
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrases that name a licence, with its label.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}


def words_of(text: str) -> list[str]:
    """The words of a template, as those of files are cut."""
    lowered = text.translate(str.maketrans(UPPER, LOWER))
    return [w for w in re.split(SEPARATORS, lowered) if w]


@dataclass(frozen=True)
class Template:
    """A notice, its label, and the phrases in it without which it doesn't count."""

    label: str
    text: str
    phrases: tuple[str, ...]

    @property
    def words(self) -> list[str]:
        return words_of(self.text)

    @property
    def placed(self) -> list[tuple[int, list[str]]]:
        """The phrases with their places in the template."""
        words, out = self.words, []
        for p in map(words_of, self.phrases):
            starts = [i for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
            if not p or not starts:
                raise ValueError(f"{p} isn't in the template of {self.label}")
            out.append((starts[0], p))
        return out


# Usual public notices and the phrases that make them out.
TEMPLATES = (
    Template("gpl-3.0", "licensed under the GNU General Public License, version 3", ("gnu general public license", "version 3")),
    Template("gpl-2.0", "licensed under the GNU General Public License, version 2", ("gnu general public license", "version 2")),
    Template(
        "gpl",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        ("gnu general public license", "free software foundation"),
    ),
    Template("lgpl", "under the terms of the GNU Lesser General Public License", ("gnu lesser general public license",)),
    Template("agpl", "under the terms of the GNU Affero General Public License", ("gnu affero general public license",)),
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0", ("apache license", "version 2 0")),
    Template("mit", "Released under the MIT License", ("mit license",)),
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        ("permission is hereby granted free of charge", "obtaining a copy of this software"),
    ),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted", ("redistribution and use in source and binary forms",)),
    Template(
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
        ("for any purpose with or without fee is hereby granted",),
    ),
    Template("mpl-2.0", "subject to the terms of the Mozilla Public License, v. 2.0", ("mozilla public license", "v 2 0")),
    Template("cc-by-4.0", "Licensed under CC BY 4.0", ("cc by 4 0",)),
    Template("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0", ("cc by nc 4 0",)),
    Template("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0", ("cc by sa 4 0",)),
)


def array_of(words: Sequence[str]) -> Column:
    """One literal, however many words there are."""
    return F.split(F.lit(" ".join(words)), " ")


def words(text: Column) -> Column:
    """Words of a text; only A-Z are lower-cased, by the faster function where the text has nothing else to lower."""
    whole = F.coalesce(text, F.lit(""))
    lowered = F.when(F.octet_length(whole) == F.char_length(whole), F.lower(whole)).otherwise(F.translate(whole, UPPER, LOWER))
    return F.array_remove(F.split(lowered, SEPARATORS), "")


def word_weights(df: DataFrame, text_col: str, templates: Sequence[Template]) -> dict[str, int]:
    """IDF of the templates' words over all rows, in thousandths and at least 1. Counts are summed per task first."""
    vocabulary = sorted({w for t in templates for w in t.words})
    if len(vocabulary) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"templates of more than {MAX_TEMPLATE_WORDS} words")
    held = F.array_intersect(array_of(vocabulary), words(F.col(text_col)))
    # a row without any counts under the empty word, which no text has
    counted = df.select(F.explode(F.array_append(held, F.lit(""))).alias("word")).groupBy("word").count()
    counts = {r["word"]: r["count"] for r in counted.collect()}
    n = counts.get("", 0)
    return {w: max(1, math.floor(1000 * math.log((2 * n + 2) / (2 * counts.get(w, 0) + 1)))) for w in vocabulary}


# The index as data: what is looked up of a template (words and their places), what has to stand, and all words with their weights.
POSTINGS = (
    "array<struct<label:string,anchors:array<string>,places:array<int>,mandatory:array<string>,at:array<int>,"
    "words:array<string>,weights:array<int>,total:double>>"
)
NAMES = "array<struct<label:string,words:array<string>>>"
# The greatest share of each template at an offset where its anchors' postings meet and its phrases stand; null if there is none.
STANDING = """
transform(postings, t -> struct(t.label AS label, CASE WHEN size(array_intersect(t.anchors, looked)) = size(t.anchors) THEN
    array_max(transform(
        filter(
            aggregate(
                sequence(0, size(t.anchors) - 1),
                CAST(NULL AS ARRAY<INT>),
                (met, k) -> CASE
                    WHEN met IS NULL THEN array_distinct(transform(filter(hits, h -> h.word = t.anchors[k]), h -> h.at - t.places[k]))
                    ELSE array_intersect(met, transform(filter(hits, h -> h.word = t.anchors[k]), h -> h.at - t.places[k]))
                END
            ),
            o -> forall(sequence(0, size(t.mandatory) - 1), j -> coalesce(get(file, o + t.at[j]) = t.mandatory[j], false))
        ),
        o -> aggregate(
            sequence(0, size(t.words) - 1), 0,
            (sum, i) -> sum + CASE WHEN get(file, o + i) = t.words[i] THEN t.weights[i] ELSE 0 END
        ) / t.total
    ))
END AS share))
"""
PLACES = """
flatten(transform(names, p -> transform(
    filter(hits, h -> h.word = p.words[0] AND forall(sequence(0, size(p.words) - 1), j -> coalesce(get(file, h.at + j) = p.words[j], false))),
    h -> struct(p.label AS label, h.at AS at)
)))
"""


def postings(templates: Sequence[Template], weights: dict[str, int]) -> Column:
    rows = []
    for t in templates:
        anchors = anchors_of(t, weights)
        placed = [(start + j, w) for start, phrase in t.placed for j, w in enumerate(phrase)]
        rows.append(
            {
                "label": t.label,
                "anchors": list(anchors),
                "places": list(anchors.values()),
                "mandatory": [w for _, w in placed],
                "at": [i for i, _ in placed],
                "words": t.words,
                "weights": [weights[w] for w in t.words],
                "total": float(sum(weights[w] for w in t.words)),
            }
        )
    return F.from_json(F.lit(json.dumps(rows)), POSTINGS)


def anchors_of(template: Template, weights: dict[str, int]) -> dict[str, int]:
    """The words of a template's phrases that are looked up, rarest first, with a place of theirs in it."""
    places: dict[str, int] = {}
    for start, phrase in template.placed:
        for j, w in enumerate(phrase):
            # a word that is twice in the phrases would have two offsets: only the others can be anchors
            places[w] = -1 if w in places else start + j
    single = {w: p for w, p in places.items() if p >= 0} or {template.placed[0][1][0]: template.placed[0][0]}
    chosen = sorted(single, key=lambda w: (-weights[w], w))[:ANCHORS]
    return {w: single[w] for w in chosen}


def scan_licenses(
    df: DataFrame,
    templates: Sequence[Template] = TEMPLATES,
    phrases: dict[str, str] = PHRASES,
    id_col: str = "doc_id",
    text_col: str = "text",
    share: float = SHARE,
) -> DataFrame:
    """(id, n_words, places, base_labels, templates, score) of every row.

    ``places`` are those of all phrases, (label, at); ``templates`` is (label, share) of every template of which at
    least ``share`` stands in the file with all its phrases; ``score`` is the greatest share of any template whose phrases stand there.
    """
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    weights = word_weights(rows, "text", templates)
    names = [{"label": label, "words": words_of(p)} for p, label in phrases.items()]
    rare = {w for t in templates for w in anchors_of(t, weights)} | {n["words"][0] for n in names}
    by_idf = sorted(rare, key=lambda w: (-weights.get(w, 0), w))
    files = computed_once(rows, {"file": words(F.col("text"))}).drop("text")
    looked = computed_once(files, {"looked": F.array_intersect(array_of(by_idf), F.col("file"))})
    numbered = "filter(transform(file, (w, i) -> struct(i AS at, w AS word)), h -> array_contains(looked, h.word))"
    hits = F.expr(f"CASE WHEN size(looked) > 0 THEN {numbered} ELSE CAST(array() AS ARRAY<STRUCT<at: INT, word: STRING>>) END")
    index = {"postings": postings(templates, weights), "names": F.from_json(F.lit(json.dumps(names)), NAMES)}
    found = computed_once(computed_once(looked, {"hits": hits}).withColumns(index), {"places": F.expr(PLACES), "shares": F.expr(STANDING)})
    return found.select(
        "id",
        F.size("file").cast("long").alias("n_words"),
        "places",
        F.array_sort(F.array_distinct(F.col("places.label"))).alias("base_labels"),
        F.filter("shares", lambda t: t["share"] >= share).alias("templates"),
        F.coalesce(F.array_max(F.col("shares.share")), F.lit(0.0)).alias("score"),
    )
