import math
import zlib
from collections import Counter

import numpy as np
import pytest

from barwright.llm import lmscore


def test_windows_end_at_documents():
    around, target, owner = lmscore.windows([np.array([1, 2, 3]), np.array([], int), np.array([4])])
    e = lmscore.EDGE
    assert target.tolist() == [1, 2, 3, 4] and owner.tolist() == [0, 0, 0, 2]
    assert around.T.tolist() == [[e, e, 2, 3], [e, 1, 3, e], [1, 2, e, e], [e, e, e, e]]


def test_gradient_is_that_of_the_loss():
    network = lmscore.Network(lmscore.Network().flat)
    draw = np.random.default_rng(1)
    around, target = draw.integers(0, lmscore.SYMBOLS, (4, 50)), draw.integers(0, lmscore.SYMBOLS, 50)
    slope = network.gradient(around, target)
    for k in np.argsort(-np.abs(slope))[:200:20]:
        flats = []
        for step in (1e-2, -1e-2):
            moved = network.flat.copy()
            moved[k] += step
            flats.append(-lmscore.Network(moved).log_probabilities(around, target).mean())
        assert math.isclose((flats[0] - flats[1]) / 2e-2, slope[k], rel_tol=0.05, abs_tol=1e-4)


def test_order_of_words_counts(docs_of):
    """Words in the order of the corpus score above the same words out of order, and above chance."""
    cycle = " ".join("abcdefgh")
    texts = [(k, " ".join([cycle] * 60)) for k in range(60)]
    texts.append((100, " ".join(np.random.default_rng(0).permutation(list("abcdefgh") * 60))))
    rows = {r["doc_id"]: r for r in lmscore.scores(docs_of(texts).coalesce(1), stride=1, rounds=6).collect()}
    assert rows[0]["mean_log_prob"] > -0.5 > rows[100]["mean_log_prob"]
    assert rows[0]["n_tokens"] == 480 and math.isclose(rows[0]["log_prob"], 480 * rows[0]["mean_log_prob"])


def test_better_than_chance_on_documents(documents):
    rows = [r for r in lmscore.scores(documents).collect() if r["n_tokens"]]
    mean = sum(r["log_prob"] for r in rows) / sum(r["n_tokens"] for r in rows)
    assert -math.log(lmscore.SYMBOLS) < mean < 0


def test_messy_rows(messy, empty):
    rows = lmscore.scores(messy).collect()
    assert len(rows) == messy.count()
    assert {(r["n_tokens"], r["log_prob"], r["mean_log_prob"]) for r in rows if r["doc_id"] in (1, 2, 3)} == {(0, 0.0, None)}
    assert lmscore.scores(empty).collect() == []


@pytest.mark.parametrize("known", [lmscore.KNOWN, 0])
def test_every_word_has_a_probability_of_its_own(docs_of, monkeypatch, known):
    """A word's log-probability is its symbol's and that of its share of the symbol's occurrences."""
    monkeypatch.setattr(lmscore, "KNOWN", known)
    draw = np.random.default_rng(3)
    texts = [(k, " ".join(f"w{int(j)}" for j in draw.zipf(1.2, 300) % 2000)) for k in range(30)]
    texts += [(k, None) for k in (40, None)] + [texts[0], (50, "")]
    counts = Counter(w for _, t in texts for w in (t or "").split())
    own = set(sorted(counts, key=lambda w: (-counts[w], w))[: lmscore.FREQUENT])
    bucket = {w: zlib.crc32(w.encode()) % lmscore.SHARED for w in counts if w not in own}
    totals = Counter()
    for word, b in bucket.items():
        totals[b] += counts[word]
    assert len(bucket) > 3 * lmscore.SHARED
    docs = docs_of(texts).coalesce(1)
    plain = {r["doc_id"]: r["log_prob"] for r in lmscore.scores(docs).collect()}
    rows = lmscore.word_scores(docs).collect()
    assert len(rows) == len(texts)
    for row in rows:
        words = (dict(texts)[row["doc_id"]] or "").split()
        shares = sum(math.log(counts[w] / totals[bucket[w]]) for w in words if w in bucket)
        assert row["n_tokens"] == len(words)
        assert math.isclose(row["log_prob"], plain[row["doc_id"]] + shares, rel_tol=1e-4, abs_tol=1e-9)
        assert (row["mean_log_prob"] is None) == (not words)


def test_words_of_messy_rows(messy, empty):
    assert lmscore.word_scores(messy).count() == messy.count()
    assert lmscore.word_scores(empty).collect() == []


def test_every_word_is_a_target_once():
    stride, rounds = lmscore.STRIDE, lmscore.ROUNDS
    for size in (1, 2, 3, 11, 12, 25, 100):
        hit = Counter()
        for turn in range(rounds):
            document = np.arange(size)
            hit.update(lmscore.windows([document], lmscore.first_target(size, stride, turn, rounds), stride)[1].tolist())
        assert hit == Counter(range(size))


def test_order_of_words_counts_as_registered(docs_of):
    """With the parameters that the query runs with: words in the corpus' order beat the same words out of order."""
    cycle = " ".join("abcdefgh")
    texts = [(k, " ".join([cycle] * 60)) for k in range(60)]
    texts.append((100, " ".join(np.random.default_rng(0).permutation(list("abcdefgh") * 60))))
    rows = {r["doc_id"]: r["mean_log_prob"] for r in lmscore.word_scores(docs_of(texts).coalesce(1)).collect()}
    assert rows[0] > -math.log(8) / 2 and rows[0] > rows[100] + 1


def test_large_weights_overflow_nothing():
    network = lmscore.Network()
    around = np.random.default_rng(1).integers(0, lmscore.SYMBOLS, (4, 300))
    target = np.arange(300) % lmscore.SYMBOLS
    small = network.log_probabilities(around, target)
    logits = (network.hidden(around) @ network.out + network.out_bias).astype(float)
    assert np.allclose(small, logits[np.arange(300), target] - np.log(np.exp(logits).sum(axis=1)), atol=1e-4)
    network.out *= 2000
    assert np.isfinite(network.log_probabilities(around, target)).all() and np.isfinite(network.gradient(around, target)).all()
