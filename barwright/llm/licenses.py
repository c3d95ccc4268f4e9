"""License scans with a positional rare-token index.

The document frequency of every word of the licence templates is counted over the whole corpus. Each
key phrase of a template is indexed under its word of highest IDF, with its position. A file's words are
looked up there; where a hit at place p for posting q verifies as the whole phrase, the template would begin
at p - q. The postings of a template's phrases are intersected by these beginnings: all its phrases must agree
on one, give or take ``SLACK`` words put in or left out between them. The score is the share of the
template's IDF weight that stands in place, as seen from any of its phrases.

Plain phrases are found besides, at every place where their words stand consecutively.
"""

import math
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwright.llm.common import WORD_BYTES, by_value

by_value(__name__)

#: The phrases of the contract and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Label, usual wording, and the phrases without which it isn't this licence.
TEMPLATES = [
    ("agpl-3.0", "under the terms of the gnu affero general public license", ["gnu affero general public license"]),
    ("apache-2.0", "licensed under the apache license version 2 0", ["apache license", "version 2 0"]),
    ("apache-2.0", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", ["apache license", "you may not use this file except in compliance with the license"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ["redistribution and use in source and binary forms"]),
    ("cc-by-4.0", "licensed under cc by 4 0", ["cc by 4 0"]),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", ["cc by nc 4 0"]),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", ["cc by sa 4 0"]),
    ("cc0-1.0", "this work is dedicated to the public domain under cc0 1 0", ["cc0 1 0"]),
    ("gpl-2.0", "licensed under the gnu general public license version 2", ["gnu general public license", "version 2"]),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3", ["gnu general public license", "version 3"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ["with or without fee is hereby granted"]),
    ("lgpl", "under the terms of the gnu lesser general public license", ["gnu lesser general public license"]),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ["permission is hereby granted free of charge"]),
    ("mit", "licensed under the mit license", ["mit license"]),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ["mozilla public license"]),
    ("agpl-3.0", "gnu affero general public license version 3 19 november 2007", ["gnu affero general public license", "version 3"]),
    ("apache-2.0", "apache license version 2 0 january 2004", ["apache license", "version 2 0 january 2004"]),
    ("bsd", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission", ["may be used to endorse or promote products derived from this software"]),
    ("cc-by-4.0", "this work is licensed under the creative commons attribution 4 0 international license", ["creative commons attribution 4 0"]),
    ("cc-by-nc-4.0", "this work is licensed under the creative commons attribution noncommercial 4 0 international license", ["creative commons attribution noncommercial 4 0"]),
    ("cc-by-nd-4.0", "this work is licensed under the creative commons attribution noderivatives 4 0 international license", ["creative commons attribution noderivatives 4 0"]),
    ("cc-by-sa-4.0", "this work is licensed under the creative commons attribution sharealike 4 0 international license", ["creative commons attribution sharealike 4 0"]),
    ("cc0-1.0", "creative commons cc0 1 0 universal", ["cc0 1 0 universal"]),
    ("cc0-1.0", "the laws of most jurisdictions throughout the world automatically confer exclusive copyright and related rights defined below upon the creator and subsequent owner", ["automatically confer exclusive copyright and related rights"]),
    ("cc0-1.0", "the person who associated a work with this deed has dedicated the work to the public domain by waiving all of his or her rights to the work worldwide", ["has dedicated the work to the public domain"]),
    ("gpl-2.0", "gnu general public license version 2 june 1991", ["gnu general public license", "version 2 june 1991"]),
    ("gpl-2.0", "under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version", ["gnu general public license", "as published by the free software foundation", "version 2"]),
    ("gpl-3.0", "gnu general public license version 3 29 june 2007", ["gnu general public license", "version 3 29 june 2007"]),
    ("gpl-3.0", "under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version", ["gnu general public license", "as published by the free software foundation", "version 3"]),
    ("lgpl", "gnu lesser general public license version 2 1 february 1999", ["gnu lesser general public license", "version 2 1"]),
    ("lgpl", "gnu lesser general public license version 3 29 june 2007", ["gnu lesser general public license", "version 3"]),
    ("mit", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement", ["the software is provided as is without warranty of any kind", "and noninfringement"]),
    ("mpl-2.0", "mozilla public license version 2 0", ["mozilla public license version 2 0"]),
    ("unlicense", "this is free and unencumbered software released into the public domain", ["free and unencumbered software"]),
]
LEAST_SCORE = 0.5
#: Words by which a template's phrases may be off from each other.
SLACK = 6
_SLICE = 512


def split_words(text: str | None) -> list:
    return text.encode().translate(WORD_BYTES).split() if text else []


def _find(words: list, phrase: list, start: int = 0) -> list:
    """All places of a phrase."""
    places = []
    try:
        while True:
            start = words.index(phrase[0], start)
            if words[start : start + len(phrase)] == phrase:
                places.append(start)
            start += 1
    except ValueError:
        return places


class Index:
    """Templates with IDF weights; postings of the rarest word of each key phrase."""

    def __init__(self, frequencies: dict, documents: int, templates=None, phrases=None):
        self.templates, self.postings = [], defaultdict(list)
        for label, text, keys in templates or TEMPLATES:
            words = split_words(text)
            weights = [math.log((documents + 1) / (frequencies.get(w, 0) + 1)) + 1e-9 for w in words]
            spans = []
            for key in map(split_words, keys):
                at = _find(words, key)[0]
                rarest = max(range(at, at + len(key)), key=lambda k: (weights[k], -k))
                self.postings[words[rarest]].append((len(self.templates), len(spans), rarest))
                spans.append((at, key))
            self.templates.append((label, words, weights, sum(weights), spans))
        self.phrases = [(split_words(p), label) for p, label in (phrases or PHRASES).items()]
        self.rare = frozenset(self.postings)

    def matches(self, words: list, known: set) -> list:
        """(label, start, score) of the templates that stand in a text; known: its words."""
        rare = self.rare & known
        if not rare:
            return []
        begins = defaultdict(set)  # of each template's phrases
        for p, w in enumerate(words):
            if w in rare:
                for t, k, q in self.postings[w]:
                    at, key = self.templates[t][4][k]
                    if words[p - q + at : p - q + at + len(key)] == key and p - q + at >= 0:
                        begins[t, k].add(p - q)
        found = []
        for t in sorted({t for t, _ in begins}):
            label, own, weights, total, spans = self.templates[t]
            for first in sorted(begins.get((t, 0), ())):
                shifts = [first]
                for k in range(1, len(spans)):
                    near = [b for b in begins.get((t, k), ()) if abs(b - first) <= SLACK]
                    if not near:
                        break
                    shifts.append(min(near, key=lambda b: (abs(b - first), b)))
                if len(shifts) < len(spans):
                    continue
                there = self.weight(t, words, set(shifts))
                if there >= LEAST_SCORE * total:
                    found.append((label, max(first, 0), min(1.0, there / total)))
        return found

    def weight(self, template: int, words: list, begins: set) -> float:
        """The weight of a template's words that stand in place, seen from any of these beginnings."""
        _, own, weights, _, _ = self.templates[template]
        return sum(
            x for k, (w, x) in enumerate(zip(own, weights)) if any(0 <= b + k < len(words) and words[b + k] == w for b in begins)
        )

    def base(self, words: list, known: set) -> list:
        """(place, label) of every plain phrase."""
        return [(place, label) for phrase, label in self.phrases if known.issuperset(phrase) for place in _find(words, phrase)]


def _frequencies(docs: DataFrame) -> tuple[dict, int]:
    """In how many texts each template word stands, and the number of texts."""
    wanted = frozenset(w for _, text, _ in TEMPLATES for w in split_words(text))

    def count(batches):
        counts, total = dict.fromkeys(wanted, 0), 0
        for batch in batches:
            for at in range(0, batch.num_rows, _SLICE):
                for text in batch.column(0).slice(at, _SLICE).to_pylist():
                    total += 1
                    for word in wanted.intersection(split_words(text)):
                        counts[word] += 1
        words = ["", *(w.decode() for w in counts)]
        yield pa.RecordBatch.from_arrays([pa.array(words), pa.array([total, *counts.values()], pa.int64())], ["word", "n"])

    counts = docs.select("text").mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    found = {r["word"].encode(): r["n"] for r in counts.collect()}  # a row per template word
    return found, found.pop(b"", 0)


def scan(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, matches.

    Reads ``doc_id`` and ``text``. A null, empty or wordless text has no words, no places (first_word and
    last_word null), empty labels and score 0. ``score`` is that of the best template, 0 without one.
    ``matches`` lists the templates found with their first word's place. Repeated rows come out alike, rows
    without doc_id are scanned as others. Texts of any length are looked up whole. An empty table gives an
    empty result.
    """
    frequencies, documents = _frequencies(docs)
    index = Index(frequencies, documents)

    def looked_up(part):
        out = []
        for text in part.column(1).to_pylist():
            words = split_words(text)
            known = set(words)
            base, found = index.base(words, known), index.matches(words, known)
            places, base_labels = [p for p, _ in base], {label for _, label in base}
            out.append((
                len(words), len(base), min(places, default=None), max(places, default=None), ",".join(sorted(base_labels)),
                ",".join(sorted(base_labels | {m[0] for m in found})), max((m[2] for m in found), default=0.0),
                [{"label": m[0], "start": m[1], "score": m[2]} for m in found],
            ))
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
        kinds.append(pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("score", pa.float64())])))
        return [part.column(0), *(pa.array(c, k) for c, k in zip(zip(*out), kinds))]

    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "matches"]

    def look_up(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, _SLICE):
                yield pa.RecordBatch.from_arrays(looked_up(batch.slice(at, _SLICE)), names)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(
        look_up,
        "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, "
        "labels string, score double, matches array<struct<label: string, start: bigint, score: double>>",
    )
