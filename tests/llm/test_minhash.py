import random

import numpy as np
import pytest

from barwright.llm import minhash


def shingles(text, width):
    words = text.encode().lower().split() if text else []
    if not words:
        return set()
    width = min(width, len(words))
    return set(zip(*[words[k : len(words) - width + 1 + k] for k in range(width)]))


def brute(texts, width, percent=80):
    """{doc_id: component} by comparing all pairs."""
    sets = {i: shingles(t, width) for i, t in texts.items()}
    up = {i: i for i in texts}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(texts)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


@pytest.mark.parametrize("width", [2, 5])
def test_equals_brute_force(documents, document_texts, width):
    rows = minhash.near_duplicates(documents, shingle_words=width).collect()
    assert {r["doc_id"]: r["component_id"] for r in rows} == brute(document_texts, width)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)
    assert {r["doc_id"]: r["n_shingles"] for r in rows} == {i: len(shingles(t, width)) for i, t in document_texts.items()}


def test_group_of_varied_near_copies(docs_of):
    """A chain of copies, linked to the base or to a neighbour only."""
    draw = random.Random(1)
    base = [f"w{k}" for k in range(120)]
    texts = {}
    for i in range(80):
        words = list(base)
        for _ in range(draw.randint(0, 9)):
            words[draw.randrange(len(words))] = f"x{draw.random()}"
        texts[i] = " ".join(words)
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(docs_of(texts.items()), 2).collect()}
    assert got == brute(texts, 2)


def test_messy_rows(messy, empty):
    rows = minhash.near_duplicates(messy, 2).collect()
    assert len(rows) == messy.count()
    by_id = {r["doc_id"]: r for r in rows}
    assert [by_id[i]["n_shingles"] for i in (1, 2, 3)] == [0, 0, 1]
    assert by_id[5]["component_id"] == 4 and not by_id[5]["kept"]
    assert by_id[6]["kept"] and by_id[None]["component_id"] is None and by_id[None]["kept"]
    left = minhash.without_near_duplicates(messy, shingle_words=2)
    assert left.columns == messy.columns and left.count() == messy.count() - 1
    assert minhash.near_duplicates(empty).collect() == []


def _varied(seed, groups, size):
    """Groups of texts that differ from their base by up to a fifth: links near the bound, groups near each other."""
    draw = random.Random(seed)
    texts = {}
    for g in range(groups):
        base = [f"g{g % 2}w{k}" for k in range(60)] + [f"g{g}v{k}" for k in range(20)]
        for _ in range(size):
            words = list(base)
            for _ in range(draw.randint(0, 8)):
                words[draw.randrange(len(words))] = f"x{draw.random()}"
            texts[len(texts)] = " ".join(words)
    return texts


@pytest.mark.parametrize("tile,ids,bands", [(512, 10**6, 10**6), (5, 0, 0)])
def test_tiles_meet_whole_or_in_pairs(docs_of, monkeypatch, tile, ids, bands):
    """Broadcast and shuffled look-ups, bands within one tile and over many."""
    monkeypatch.setattr(minhash, "TILE", tile)
    monkeypatch.setattr(minhash, "BROADCAST_IDS", ids)
    monkeypatch.setattr(minhash, "BROADCAST_BANDS", bands)
    texts = _varied(3, 6, 25)
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(docs_of(texts.items()), 2).collect()}
    assert got == brute(texts, 2)


def _tile(texts, ids, c):
    sets = [np.sort(minhash.shingle_set(texts[i], 2, minhash._WordHashes()).view(np.int64)) for i in ids]
    return {
        "id": ids, "c": np.array(c), "a": np.zeros((len(ids), 9), int), "b": np.zeros((len(ids), 9), int),
        "sets": sets, "n": np.array([len(x) for x in sets]),
    }


@pytest.mark.parametrize("seed", range(4))
def test_compare_finds_all_components_with_a_forest(seed):
    texts = _varied(seed, 3, 20)
    ids, expected = list(texts), brute(texts, 2)
    for left, right in ((ids, None), (ids[:25], ids[25:])):
        sides = [_tile(texts, x, x) if x else None for x in (left, right)]
        inner = [minhash.compare(_tile(texts, x, x), None, 0, 80) for x in (left, right) if x]
        links = minhash.compare(*sides, 0, 80) + sum(inner if right else [], [])
        up = {i: i for i in ids}
        for u, v in links * 60:  # as many rounds as the longest chain
            up[u] = up[v] = min(up[u], up[v])
        assert up == expected
        assert len(links) < 2 * len(ids)
        assert all(expected[u] == expected[v] for u, v in links)


def test_pairs_count_in_their_first_band():
    texts = {1: "a b c d e f", 2: "a b c d e f g"}
    left = _tile(texts, [1, 2], [1, 2])
    assert minhash.compare(left, None, 0, 80) == [(1, 2)]
    assert minhash.compare(_tile(texts, [1, 2], [1, 2]), None, 1, 80) == []  # equal in band 0 as well
    apart = _tile(texts, [1, 2], [1, 2])
    apart["b"][1] = 7  # no table in common
    assert minhash.compare(apart, None, 0, 80) == []
