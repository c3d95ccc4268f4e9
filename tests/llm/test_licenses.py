import re

from barwright.llm import licenses


def words_of(text):
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or "")) if w]


def brute(text):
    words, places, labels = words_of(text), [], set()
    for phrase, label in licenses.PHRASES.items():
        own = phrase.split()
        for k in range(len(words)):
            if words[k : k + len(own)] == own:
                places.append(k)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


NOTICES = {
    1: "Licensed under the Apache License, Version 2.0.", 2: "x y Licensed under CC BY-NC 4.0! cc by cc by", 3: "ALL rights\nreserved",
    4: "This work is licensed under the GNU General Public License, version 3.", 5: "Apache License, but version 2 point 0",
    6: "general public license", 7: "Permission is hereby granted, free of charge, to any person obtaining a copy", 8: None, 9: "",
    10: "all right reserved cc-bye", 11: "Straße über CC BY\u00a0x",
}


def test_documents_equal_brute_force(documents, document_texts, docs_of):
    for df, texts in ((documents, document_texts), (docs_of(NOTICES.items()), NOTICES)):
        rows = licenses.scan(df).collect()
        assert len(rows) == len(texts)
        for r in rows:
            assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute(texts[r["doc_id"]])
            assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1


def test_templates(docs_of):
    rows = {r["doc_id"]: r for r in licenses.scan(docs_of(NOTICES.items())).collect()}
    labels = {i: r["labels"] for i, r in rows.items()}
    assert labels == {1: "apache-2.0", 2: "cc-by,cc-by-nc-4.0", 3: "reserved", 4: "gpl,gpl-3.0", 5: "", 6: "gpl", 7: "mit", 8: "", 9: "", 10: "", 11: ""}
    assert rows[1]["score"] == 1.0 and rows[3]["score"] == 0.0 and 0.5 <= rows[7]["score"] < 1
    assert [(m["label"], m["start"]) for m in rows[2]["matches"]] == [("cc-by-nc-4.0", 2)]


def test_index_equals_trying_all_places():
    """Every alignment that holds all key phrases and half the weight is found through the rare words."""
    import random

    index = licenses.Index({}, 100)
    draw = random.Random(4)
    vocabulary = sorted({w for _, words, *_ in index.templates for w in words})
    for _ in range(200):
        words = []
        for _ in range(draw.randint(1, 4)):
            own = list(draw.choice(index.templates)[1])
            if draw.random() < 0.6:
                own[draw.randrange(len(own))] = draw.choice(vocabulary)
            words += own + draw.choices(vocabulary, k=draw.randint(0, 3))
        expected = set()
        for t, (label, own, weights, total, spans) in enumerate(index.templates):
            starts = [[p for p in range(len(words)) if words[p : p + len(key)] == key] for _, key in spans]
            for first in starts[0]:
                begin = first - spans[0][0]
                shifts = [begin]
                for (at, _), places in list(zip(spans, starts))[1:]:
                    near = sorted((abs(p - at - begin), p - at) for p in places if abs(p - at - begin) <= licenses.SLACK)
                    shifts += [near[0][1]] if near else []
                if len(shifts) == len(spans) and index.weight(t, words, set(shifts)) >= licenses.LEAST_SCORE * total:
                    expected.add((label, max(begin, 0)))
        assert {(m[0], m[1]) for m in index.matches(words, set(words))} == expected


HEADERS = {
    "gpl-2.0": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "gpl-3.0": "it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc0-1.0": "The laws of most jurisdictions throughout the world automatically confer exclusive Copyright and Related Rights (defined below) upon the creator and subsequent owner(s)",
    "apache-2.0": "Licensed under the Apache License as published, Version 2.0",
    "mit": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.',
}


def test_standard_notices_and_words_put_in_between(docs_of):
    texts = dict(enumerate(HEADERS.values()))
    found = {r["doc_id"]: r["labels"].split(",") for r in licenses.scan(docs_of(texts.items())).collect()}
    for k, label in enumerate(HEADERS):
        assert set(found[k]) - {"gpl"} == {label}
    far = "licensed under the apache license " + "and more " * 5 + "version 2 0"
    assert licenses.Index({}, 9).matches(licenses.split_words(far), set(licenses.split_words(far))) == []


def test_messy_rows(messy, empty):
    assert licenses.scan(messy).count() == messy.count()
    assert licenses.scan(empty).collect() == []
