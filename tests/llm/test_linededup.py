import random

import pytest

from barwright.llm import linededup


def word_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute(rows, min_words=8):
    """{(doc_id, line_no): first place or None} for rows with distinct ids."""
    lines = [((i, k), line.lower().split()) for i, t in sorted(rows) for k, line in enumerate(t.split("\n"))]
    out = {}
    for n, (place, words) in enumerate(lines):
        out[place] = None
        for other, theirs in lines[:n]:
            long = min(len(words), len(theirs)) >= min_words
            if words and (words == theirs or long and abs(len(words) - len(theirs)) < 2 and word_distance(words, theirs) < 2):
                out[place] = other
                break
    return out


def corpus(seed=3, docs=60):
    draw = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(40)]
    bases = [draw.choices(vocabulary, k=draw.randint(1, 14)) for _ in range(12)] + [["a"] * 9, ["a"] * 10, list("abababab")]
    rows = []
    for i in range(docs):
        lines = []
        for _ in range(draw.randint(1, 4)):
            line = list(draw.choice(bases))
            for _ in range(draw.choice([0, 1, 1, 2])):
                at = draw.randrange(len(line) + 1)
                draw.choice([lambda: line.insert(at, draw.choice(vocabulary)), lambda: line.__delitem__(slice(at, at + 1))])()
            lines.append(" ".join(line))
        rows.append((i, "\n".join(lines)))
    return rows


def decided(df):
    return {
        (r["doc_id"], r["line_no"]): None if r["kept"] else (r["first_doc_id"], r["first_line_no"]) for r in df.collect()
    }


@pytest.mark.parametrize("broadcast", [True, False])
def test_equals_brute_force(docs_of, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(linededup, "BROADCAST_CLASSES", -1)
    rows = corpus()
    assert decided(linededup.line_decisions(docs_of(rows))) == brute(rows)


def test_template_line_with_one_changing_word(docs_of):
    rows = [(i, f"this offer ends soon dear customer number n{i} so act") for i in range(200)]
    gone = decided(linededup.line_decisions(docs_of(rows)))
    assert gone[0, 0] is None and {gone[i, 0] for i in range(1, 200)} == {(0, 0)}


def test_messy_rows(messy, empty):
    rows = linededup.line_decisions(messy).collect()
    by_id = {}
    for r in rows:
        by_id.setdefault(r["doc_id"], []).append(r)
    assert 1 not in by_id and len(by_id[2]) == 1 and by_id[2][0]["kept"]
    assert all(r["kept"] for r in by_id[3] + by_id[4] + by_id[6] + by_id[8] + by_id[None])
    assert [(r["kept"], r["first_doc_id"]) for r in by_id[5]] == [(False, 4)]
    assert linededup.line_decisions(empty).count() == 0


def test_without_repeated_lines(messy, empty, docs_of):
    left = linededup.without_repeated_lines(messy)
    assert left.columns == messy.columns
    assert sorted(str(r["doc_id"]) for r in left.collect()) == sorted(["1", "2", "3", "4", "6", "6", "7", "None", "None", "8", "8"])
    docs = docs_of([(1, "first line\n\nsecond line"), (2, "third\nfirst line\nfourth"), (3, "second line\n\nThird!")])
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in linededup.without_repeated_lines(docs).collect()}
    assert got == {1: ("first line\n\nsecond line", 23), 2: ("third\nfourth", 12)}
    assert linededup.without_repeated_lines(empty).collect() == []


def test_native_plan(documents):
    plan = linededup.line_decisions(documents)._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "CartesianProduct", "NestedLoop"))
