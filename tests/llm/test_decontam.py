import hashlib
import re

import pytest

from barwright.llm import decontam

ITEMS = [
    (1, "The quick brown fox jumps over the lazy dog and then it rests a while"), (2, "tiny item here"), (3, ""), (4, None),
    (5, "the the the the the the the the the the the"), (None, "a nameless item of just seven words"), (2, "tiny item here"),
    (6, "quick brown fox jumps over the lazy dog and then it runs"),
]
FOX = "quick brown fox jumps over the lazy dog and then it rests"


def words_of(text):
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or "")) if w]


def brute(text, items):
    words, hit, found = words_of(text), set(), set()
    for item_id, item in items:
        own = words_of(item)
        n = min(10, len(own))
        runs = {tuple(own[k : k + n]) for k in range(len(own) - n + 1)} if n else set()
        for k in range(len(words) - n + 1):
            if n and tuple(words[k : k + n]) in runs:
                hit.update(range(k, k + n))
                if item_id is not None:
                    found.add(str(item_id))
    ids = ",".join(sorted(found))
    return len(words), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)


TEXTS = [
    (1, f"before {FOX.upper()}, after"), (2, FOX), (3, "brown fox jumps over the lazy dog and then"), (4, f"{FOX} {FOX}"),
    (5, "a tiny, item -- here! tiny item here"), (6, "the " * 40), (7, "a nameless item of just seven words"), (8, None), (9, ""),
    (10, "quick brown fox jumps over a lazy dog and then it rests"), (4, f"{FOX} {FOX}"), (11, "tiny item"),
]


@pytest.mark.parametrize("broadcast", [True, False])
def test_equals_brute_force(spark, docs_of, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(decontam, "BROADCAST_WINDOWS", -1)
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    rows = decontam.overlaps(docs_of(TEXTS), items).collect()
    got = sorted((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in rows)
    assert got == sorted((i, *brute(t, ITEMS)) for i, t in TEXTS)


def test_every_shared_span_of_a_window_is_found(spark, docs_of):
    """Runs of exactly ten words at any place of an item, in any surroundings."""
    item = [f"i{k}" for k in range(40)]
    texts = [(k, " ".join(["x"] * (k % 5) + item[k : k + 10] + ["y"])) for k in range(31)]
    near = [(100 + k, " ".join(item[k : k + 9])) for k in range(32)]
    items = spark.createDataFrame([(1, " ".join(item))], "item_id bigint, text string")
    rows = decontam.overlaps(docs_of(texts + near), items).collect()
    assert {r["doc_id"]: r["n_hit"] for r in rows} == {**{i: 10 for i, _ in texts}, **{i: 0 for i, _ in near}}


def test_messy_rows(spark, messy, empty):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert decontam.overlaps(messy, items).count() == messy.count()
    assert decontam.overlaps(messy, items.filter("false")).filter("contaminated").count() == 0
    assert decontam.overlaps(empty, items).count() == 0
    left = decontam.without_overlaps(messy, items)
    assert left.columns == messy.columns and left.count() == messy.count()


def test_clean_rows_stay_beside_a_hit_of_the_same_id(spark, docs_of):
    """Rows that share a doc_id, or lack one, are judged by their own texts."""
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    docs = docs_of([(None, FOX), (None, "clean and nameless"), (None, None), (1, FOX), (1, "clean"), (2, FOX), (3, "clean"), (3, "clean")])
    left = [(r["doc_id"], r["text"]) for r in decontam.without_overlaps(docs, items).collect()]
    assert sorted(left, key=str) == sorted(
        [(None, "clean and nameless"), (None, None), (1, "clean"), (3, "clean"), (3, "clean")], key=str
    )


def test_native_plan(spark, documents, sf_dir):
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    plan = decontam.overlaps(documents, items)._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "CartesianProduct", "NestedLoop"))
