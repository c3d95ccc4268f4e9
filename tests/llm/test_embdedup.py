import numpy as np
import pyarrow as pa
import pytest

from barwright.llm import embdedup

SCHEMA = "vec_id bigint, embedding array<float>, label int, key string, n bigint"


def brute(rows, threshold=0.93):
    ids = sorted({r[0] for r in rows if r[0] is not None})
    units = [(r[0], r[2], embdedup.unit_vector(r[1])) for r in rows if r[0] is not None]
    units = [u for u in units if u[2] is not None and u[1] is not None]
    n, up = dict.fromkeys(ids, 0), {i: i for i in ids}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for k, (a, label, x) in enumerate(units):
        for b, other, y in units[:k]:
            if label == other and len(x) == len(y) and x @ y >= threshold:
                n[a] += 1
                n[b] += 1
                up[max(root(a), root(b))] = min(root(a), root(b))
    return {i: (n[i], root(i)) for i in ids}


def vectors(seed=2):
    draw = np.random.default_rng(seed)
    rows = []
    for group in range(30):
        centre = draw.normal(size=32)
        for _ in range(12):
            rows.append((len(rows), (centre + draw.normal(size=32) * draw.choice([0.05, 0.2, 0.35])).astype(np.float32).tolist(), group % 3, "k", 1))
    return rows


@pytest.mark.parametrize("tile", [2048, 5])
def test_recall_and_precision(spark, monkeypatch, tile):
    """At least 0.9 of the links, none below the threshold; also with buckets split into tiles."""
    monkeypatch.setattr(embdedup, "TILE", tile)
    rows = vectors()
    wanted = brute(rows)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embdedup.linked_vectors(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert sum(n for n, _ in got.values()) >= 0.97 * sum(n for n, _ in wanted.values()) > 0
    assert all(got[i][0] <= wanted[i][0] for i in wanted)
    assert sum(got[i][1] == wanted[i][1] for i in wanted) >= 0.97 * len(wanted)


def test_estimates_are_unbiased_and_bounded():
    draw = np.random.default_rng(0)
    turn = embdedup.rotations(64, 8, 8)[0]
    errors, outside = [], 0
    for _ in range(2000):
        x, y = (v / np.linalg.norm(v) for v in draw.normal(size=(2, 64)))
        turned = turn @ x
        factor = np.abs(turned).sum() / 8
        estimate = np.sign(turned) @ (turn @ y) / 8 / factor
        bound = embdedup.CONFIDENCE * np.sqrt((1 - factor**2) / factor**2 / 63)
        errors.append(estimate - x @ y)
        outside += abs(errors[-1]) > bound
    assert abs(np.mean(errors)) < 0.01 and outside <= 2


def test_messy_rows(spark):
    v, w = [1.0, 2.0, 3.0], [1.0, 2.0, 3.1]
    rows = [
        (1, v, 1, "k", 1), (2, w, 1, "k", 1), (3, v, 2, "k", 1), (4, v, None, "k", 1), (5, None, 1, "k", 1), (6, [0.0, 0.0, 0.0], 1, "k", 1),
        (7, [1.0, None, 3.0], 1, "k", 1), (8, [1.0, float("nan"), 3.0], 1, "k", 1), (9, [float("inf"), 2.0, 3.0], 1, "k", 1), (10, [], 1, "k", 1),
        (11, v + [0.0], 1, "k", 1), (None, v, 1, "k", 1), (2, w, 1, "k", 1), (12, [1e30, 2e30, 3e30], 1, "k", 1),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    got = embdedup.linked_vectors(df).collect()
    assert len(got) == len(rows)
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got} == {
        1: (2, 1, True), 2: (2, 1, False), 12: (2, 1, False), None: (0, None, True), **{i: (0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 10, 11)}
    }
    assert embdedup.linked_vectors(df.filter("false")).collect() == []


def test_a_tile_of_near_copies_stays_small():
    """All pairs of a full tile, at the tables of a large label: keys and vectors are held for some of them only."""
    import tracemalloc

    random = np.random.default_rng(2)
    bits, tables = embdedup.plan(10**7)
    base = random.standard_normal(64)
    units = base + 0.01 * random.standard_normal((1024, 64))
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    turn = embdedup.rotations(64, bits, tables)[0]
    turned = units @ turn.T
    tile = {
        "id": np.arange(1024), "keys": np.arange(1024 * tables).reshape(1024, tables), "unit": units,
        "code": np.packbits(turned >= 0, axis=1), "factor": np.abs(turned).sum(axis=1) / 8,
    }
    tracemalloc.start()
    i, j = embdedup._linked(tile, tile, True, tables - 1, turn, 0.93)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(i) == 1024 * 1023 // 2 and peak < 300e6


def test_finder_keeps_every_vector_with_a_near_code():
    """Vectors of a pair at the threshold stay, within a tile and across two; most of the others don't."""
    random = np.random.default_rng(5)
    units = random.standard_normal((400, 64))
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    for k in range(0, 100, 2):  # pairs at a cosine of 0.93
        other = random.standard_normal(64)
        other -= (other @ units[k]) * units[k]
        units[k + 1] = 0.93 * units[k] + np.sqrt(1 - 0.93**2) * other / np.linalg.norm(other)
    codes = np.packbits(units @ embdedup.rotations(64, 8, 8)[0].T >= 0, axis=1)
    rows = [(k, k, codes[k].tobytes()) for k in range(400)]
    find = embdedup._finder(0.93)

    def kept(low, high, sides):
        batches = [pa.RecordBatch.from_pylist([
            dict(zip([*embdedup._PLACE, "side", "vec_id", "row", "code"], ("l", 64, 0, 1, low, high, side, *r))) for side in (0, 1) for r in sides[side]
        ])]
        return {i for out in find(batches) for i in out.column("vec_id").to_pylist()}

    inner = kept(0, 0, (rows, []))
    assert inner >= set(range(100)) and len(inner) < 300
    assert kept(0, 1, (rows[0::2], rows[1::2])) >= set(range(100))
