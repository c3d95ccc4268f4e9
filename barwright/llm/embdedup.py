"""Near-duplicate embeddings with randomised-rotation binary codes.

Every unit vector is turned by random rotations, and the signs of its coordinates are its code. With the
code goes a correction factor, the inner product of the turned vector and its own code: dividing by it
makes the inner product of one vector's code with another turned vector an unbiased estimate of their
cosine, and its error is bounded with known confidence. Disjoint groups of code bits are the keys of the
hash tables. Only codes travel to every table: vectors that share a key are compared by the bits in which
their codes differ, which bound the angle with the same confidence. Those that may have a partner fetch
their vectors and are compared by estimate; only where its bound reaches the threshold is the cosine
recomputed in double precision, and that alone decides.

A bucket larger than a tile is split: its tiles meet in pairs, in tasks of their own. A task sums links per
vector and returns a spanning forest of them, so what it emits is linear in what it reads. A pair that
shares several keys counts in its first table only. The number of bits grows with the logarithm of the
largest label, the number of tables so that a pair at the threshold is found with ``RECALL``.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwright.llm.common import by_value, components, discard, stage

by_value(__name__)

THRESHOLD, RECALL = 0.93, 0.995
#: Vectors of a tile, and the width of a confidence bound in standard errors.
TILE, CONFIDENCE = 2048, 4.0
#: Pairs of a tile whose keys and vectors are held side by side.
_PAIRS = 1 << 16
#: Up to so many buckets larger than a tile are broadcast.
BROADCAST_BUCKETS = 100_000
#: Vectors per bucket that the number of bits aims at.
_AIM = 32
_PLACE = ["label", "dim", "table", "key", "low", "high"]
_POSSIBLE = "label string, dim int, table int, key bigint, low int, high int, side int, vec_id bigint, row bigint"
_CODED = "vec_id bigint, label string, dim int, keys array<bigint>, unit binary, code binary, factor double"
_LINKS = "vec_id bigint, n bigint, other bigint"


def plan(largest: int, threshold: float = THRESHOLD) -> tuple[int, int]:
    """Bits per table and tables, for so many vectors of one label."""
    bits = min(24, max(4, math.ceil(math.log2(max(largest, 1) / _AIM + 1))))
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - RECALL) / math.log(1 - same))


def rotations(dim: int, bits: int, tables: int) -> np.ndarray:
    """Random rotations of ``dim`` coordinates, padded to 64; enough for all tables."""
    wide = max(64, -(-dim // 64) * 64)
    per_rotation = wide // bits
    random = np.random.default_rng(wide)
    turned = []
    for _ in range(-(-tables // per_rotation)):
        q, r = np.linalg.qr(random.standard_normal((wide, wide)))
        turned.append((q * np.sign(np.diag(r)))[:, :dim])
    return np.stack(turned)


def unit_vector(vector) -> np.ndarray | None:
    """The vector at length one in double precision, or None if it has no direction."""
    if vector is None or len(vector) == 0 or any(x is None for x in vector):
        return None
    vector = np.asarray(vector, float)
    with np.errstate(over="ignore", invalid="ignore"):
        largest = np.abs(vector).max()
        if not np.isfinite(vector).all() or largest == 0:
            return None
        vector = vector / largest
        return vector / np.linalg.norm(vector)


def _coder(bits: int, tables: int):
    def code(batches):
        turns = {}
        weights = 1 << np.arange(bits, dtype=np.int64)
        for batch in batches:
            out = []
            for vec_id, vector, label in zip(*(batch.column(k).to_pylist() for k in range(3))):
                unit = unit_vector(vector)
                if unit is None:
                    continue
                if len(unit) not in turns:
                    turns[len(unit)] = rotations(len(unit), bits, tables)
                turned = turns[len(unit)] @ unit
                signs = turned >= 0
                use = signs.shape[1] // bits * bits
                keys = (signs[:, :use].reshape(-1, bits) @ weights)[:tables]
                factor = np.abs(turned[0]).sum() / math.sqrt(turned.shape[1])
                out.append((vec_id, label, len(unit), keys, unit.tobytes(), np.packbits(signs[0]).tobytes(), factor))
            kinds = [pa.int64(), pa.string(), pa.int32(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.float64()]
            names = ["vec_id", "label", "dim", "keys", "unit", "code", "factor"]
            columns = list(zip(*out)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return code


def _linked(a: dict, b: dict, same: bool, table: int, turn: np.ndarray, threshold: float):
    """Index pairs (i, j) of vectors to link that meet in no earlier table; i < j within one tile."""
    wide = turn.shape[0]
    signs = np.unpackbits(a["code"], axis=1)[:, :wide] * 2.0 - 1.0
    estimate = signs @ (turn @ b["unit"].T) / math.sqrt(wide) / a["factor"][:, None]
    # the error stems from what of the other vector is orthogonal to this one
    spread = np.sqrt(np.maximum(1 - a["factor"] ** 2, 0) / a["factor"] ** 2 / (wide - 1)) * math.sqrt(1 - threshold**2)
    possible = estimate + CONFIDENCE * spread[:, None] >= threshold
    if same:
        possible = np.triu(possible, 1)
    i, j = np.nonzero(possible)
    kept = []
    for at in range(0, len(i), _PAIRS):
        x, y = i[at : at + _PAIRS], j[at : at + _PAIRS]
        fresh = (a["id"][x] != b["id"][y]) & ~(a["keys"][x, :table] == b["keys"][y, :table]).any(axis=1)
        x, y = x[fresh], y[fresh]
        close = np.einsum("ij,ij->i", a["unit"][x], b["unit"][y]) >= threshold
        kept.append((x[close], y[close]))
    return tuple(np.concatenate(c) for c in zip(*kept)) if kept else (i, j)


def _forest(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, its component's smallest node) that hang together as the given ones do."""
    nodes, ends = np.unique(np.concatenate([left, right]), return_inverse=True)
    a, b = ends[: len(left)], ends[len(left) :]
    root = np.arange(len(nodes))
    while True:
        least = root.copy()
        low = np.minimum(root[a], root[b])
        np.minimum.at(least, root[a], low)
        np.minimum.at(least, root[b], low)
        least = least[least][root]
        if (least == root).all():
            break
        root = least
    rest = root != np.arange(len(nodes))
    return nodes[rest], nodes[root[rest]]


def _matcher(bits: int, tables: int, threshold: float):
    def tile(rows):
        """Arrays of one tile from lists of its columns."""
        ids, keys, units, codes, factors = zip(*rows)
        return {
            "id": np.array(ids), "keys": np.array(keys), "factor": np.array(factors),
            "unit": np.frombuffer(b"".join(units)).reshape(len(rows), -1),
            "code": np.frombuffer(b"".join(codes), np.uint8).reshape(len(rows), -1),
        }

    def found(place, left, right, turns):
        _, dim, table, _, low, high = place
        if dim not in turns:
            turns[dim] = rotations(dim, bits, tables)[0]
        a = tile(left) if left else None
        b = tile(right) if right else a
        if a is None or (low != high and not right):
            return None
        i, j = _linked(a, b, low == high, table, turns[dim], threshold)
        if not len(i):
            return None
        x, y = a["id"][i], b["id"][j]
        ids, n = np.unique(np.concatenate([x, y]), return_counts=True)
        node, other = _forest(x, y)
        arrays = [np.concatenate([ids, node]), np.concatenate([n, np.zeros(len(node), int)])]
        others = pa.array([None] * len(ids) + other.tolist(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in arrays] + [others], ["vec_id", "n", "other"])

    def match(batches):
        turns = {}
        for place, sides in _tiles(batches):
            if (out := found(place, *sides, turns)) is not None:
                yield out

    return match


def _tiles(batches):
    """(place, the rows of its two sides) of rows sorted by place; at most two tiles are held."""
    at, sides = None, ([], [])
    for batch in batches:
        for row in zip(*(batch.column(k).to_pylist() for k in range(batch.num_columns))):
            place, side, values = row[: len(_PLACE)], row[len(_PLACE)], row[len(_PLACE) + 1 :]
            if place != at:
                if len(sides[0]) + len(sides[1]) > 1:
                    yield at, sides
                at, sides = place, ([], [])
            sides[side].append(values)
    if len(sides[0]) + len(sides[1]) > 1:
        yield at, sides


def most_different(wide: int, threshold: float) -> float:
    """The most bits of so many in which codes of vectors at the threshold differ, within the confidence."""
    share = math.acos(threshold) / math.pi
    return wide * share + CONFIDENCE * math.sqrt(wide * share * (1 - share))


def _finder(threshold: float):
    """Of each tile or pair of tiles, the vectors whose code is near another one's."""

    def signs(rows):
        codes = np.frombuffer(b"".join(r[2] for r in rows), np.uint8).reshape(len(rows), -1)
        return np.unpackbits(codes, axis=1).astype(np.float32) * 2 - 1

    def near(place, sides):
        if not sides[0] or (place[4] != place[5] and not sides[1]):
            return [[], []]
        left = signs(sides[0])
        right = signs(sides[1]) if sides[1] else left
        wide = left.shape[1]
        close = left @ right.T >= wide - 2 * most_different(wide, threshold)
        if not sides[1]:
            np.fill_diagonal(close, False)
        flags = [close.any(axis=1), close.any(axis=0)]
        return [[r for r, flag in zip(rows, own) if flag] for rows, own in zip(sides, flags)]

    def find(batches):
        for place, sides in _tiles(batches):
            kept = near(place, sides)
            rows = [(*place, side, *r[:2]) for side in (0, 1) for r in kept[side]]
            if rows:
                kinds = [pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
                names = [*_PLACE, "side", "vec_id", "row"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return find


def linked_vectors(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per row: vec_id, n_links, component_id (smallest vec_id reachable, itself included), kept.

    Reads ``vec_id``, ``embedding`` and ``label``; only vectors of one label and one length are compared.
    Vectors that are null, empty, zero or hold a null or non-finite component link with nothing, nor
    do rows with a null label or vec_id; a null vec_id has a null component and is kept. A row that
    repeats another one counts once, and rows that share a vec_id but differ are one node. An empty table
    gives an empty result.
    """
    usable = vectors.filter("vec_id is not null and label is not null and embedding is not null").select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"),
        F.col("label").cast("string").alias("label"),
    )
    largest = usable.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    bits, tables = plan(largest, threshold)
    coded = usable.dropDuplicates().mapInArrow(_coder(bits, tables), _CODED)
    coded, coded_path = stage(coded.withColumn("row", F.xxhash64("label", "unit")), "codes")

    place = _PLACE[:4]
    entries = coded.select("label", "dim", "vec_id", "row", "code", F.posexplode("keys").alias("table", "key"))
    large = entries.groupBy(*place).count().filter(F.col("count") > TILE).select(
        *place, F.ceil(F.col("count") / TILE).cast("int").alias("tiles")
    )
    large, large_path = stage(large, "large")
    few = large.count() <= BROADCAST_BUCKETS
    split = entries.join(F.broadcast(large) if few else large, place, "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)))
    split = split.withColumn("tile", F.pmod(F.xxhash64("vec_id"), F.col("tiles")).cast("int"))
    met = split.select("*", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("partner")).select(
        *place, F.least("tile", "partner").alias("low"), F.greatest("tile", "partner").alias("high"),
        (F.col("tile") > F.col("partner")).cast("int").alias("side"), "vec_id", "row", "code",
    )
    possible = met.repartition(*_PLACE).sortWithinPartitions(*_PLACE).mapInArrow(_finder(threshold), _POSSIBLE)
    possible, possible_path = stage(possible, "possible")
    whole = possible.join(coded.select("vec_id", "row", "keys", "unit", "code", "factor"), ["vec_id", "row"]).select(
        *_PLACE, "side", "vec_id", "keys", "unit", "code", "factor"
    )
    found = whole.repartition(*_PLACE).sortWithinPartitions(*_PLACE).mapInArrow(_matcher(bits, tables, threshold), _LINKS)
    found, _ = stage(found, "vector-links")
    discard(vectors.sparkSession, large_path, coded_path, possible_path)
    counts = found.filter("other is null").groupBy(F.col("vec_id").alias("id")).agg(F.sum("n").alias("n_links"))
    joined = components(found.filter("other is not null"), "vec_id", "other")
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"))
    component = F.coalesce("component", "vec_id")
    return (
        rows.join(counts, rows.vec_id == counts.id, "left").join(joined, rows.vec_id == joined.node, "left")
        .select(
            "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"),
            F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"),
        )
    )
