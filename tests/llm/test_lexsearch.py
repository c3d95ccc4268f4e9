import math
from collections import Counter

import numpy as np
import pytest

from barwright.llm import lexsearch
from barwright.llm.common import WORD_BYTES


def words(text):
    return text.encode().translate(WORD_BYTES).split() if text else []


def brute_force(docs, items, most):
    """Every score by the formula, in Python's integers."""
    counted = [(i, Counter(words(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n_docs, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(w for _, c in counted for w in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(words(text))
    out = []
    for item, terms in asked.items():
        scored = []
        for i, c in counted:
            m = 50 + (50 * sum(c.values()) * n_docs) // total
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((10**9 * c[w]) // (1000 * c[w] + 20 * m))
                for w in terms if c[w]
            )
            if score > 0:
                scored.append((-score, i is None, i))
        for rank, (score, _, i) in enumerate(sorted(scored, key=lambda s: (s[0], s[1], s[2] or 0))[:most], 1):
            out.append((item, rank, i, -score))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def benchmark(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


@pytest.mark.parametrize("most", [1, 7, 50])
def test_equals_brute_force(documents, document_texts, benchmark, monkeypatch, most):
    monkeypatch.setattr(lexsearch, "SHARD_DOCS", 37)  # several shards a task
    items = [tuple(r) for r in benchmark.select("item_id", "text").collect()]
    expected = brute_force(list(document_texts.items()), items, most)
    assert rows_of(lexsearch.ranked(documents.repartition(3), benchmark, most)) == expected


def test_items_in_several_rounds(documents, benchmark, monkeypatch):
    whole = rows_of(lexsearch.ranked(documents, benchmark, 5))
    monkeypatch.setattr(lexsearch, "ITEM_WORDS", 400)
    assert rows_of(lexsearch.ranked(documents, benchmark, 5)) == whole


def test_ties_and_copies(spark, docs_of):
    docs = docs_of([(i, "alpha beta") for i in range(300, 0, -1)] + [(500, "gamma"), (7, "alpha beta")])
    items = spark.createDataFrame([(1, "Alpha"), (2, "delta"), (3, "...")], "item_id bigint, text string")
    found = rows_of(lexsearch.ranked(docs, items))
    texts = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert found == brute_force(texts, [(1, "Alpha"), (2, "delta"), (3, "...")], 50)
    assert [r[2] for r in sorted(found, key=lambda r: r[1])][:9] == [1, 2, 3, 4, 5, 6, 7, 7, 8]


def test_messy_rows(spark, messy):
    items = [(1, "one WORD line"), (1, "ünïcödé"), (None, "row"), (2, None), (3, "")]
    asked = spark.createDataFrame(items, "item_id bigint, text string")
    texts = [tuple(r) for r in messy.select("doc_id", "text").collect()]
    assert rows_of(lexsearch.ranked(messy, asked)) == brute_force(texts, items, 50)


def test_empty_tables(empty, messy, benchmark):
    assert lexsearch.ranked(empty, benchmark).count() == 0
    assert lexsearch.ranked(messy, benchmark.filter("false")).count() == 0
    assert lexsearch.ranked(messy, benchmark).columns == ["item_id", "rank", "doc_id", "score"]


def test_prunes(monkeypatch):
    """One rare word among many documents: few of them are scored."""
    random = np.random.default_rng(1)
    n = 5000
    terms = np.concatenate([np.array([0, 1]) if i % 500 == 0 else np.array([0]) for i in range(n)])
    sizes = np.array([2 if i % 500 == 0 else 1 for i in range(n)])
    impacts = np.where(terms == 0, random.integers(1, 1000, len(terms)), random.integers(10**6, 10**7, len(terms)))
    shard = lexsearch.Shard(np.arange(n), sizes, terms.astype(np.int32), impacts)
    asked, split = [], shard.intervals
    monkeypatch.setattr(shard, "intervals", lambda low, high: (asked.append(len(low)), split(low, high))[1])
    scores, ids = shard.search(np.array([0, 1]), (np.zeros(0, np.int64), np.zeros(0, np.int64)), 3)
    assert all(i % 500 == 0 for i in ids) and sum(asked) < n / 10


def test_lengths_beyond_64_bits():
    n = np.array([10, 10**6])
    expected = [50 + 50 * int(x) * 10**12 // (3 * 10**14) for x in n]
    assert lexsearch.lengths(n, 10**12, 3 * 10**14).tolist() == expected
