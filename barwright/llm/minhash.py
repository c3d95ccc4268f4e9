"""MinHash near-dedup with tensored banding.

Two small collections of band hashes are computed per document; table (i, j) is keyed by hash i of
the first and hash j of the second collection. ``bands`` x 2 x ``rows`` minhashes give ``bands``^2
tables of 2 x ``rows`` rows each, instead of ``bands``^2 x 2 x ``rows`` minhashes.

Texts with equal shingle sets fold into one class first. A table key never yields the pairs of its
members: each member is compared with up to three of them (the smallest, the largest and one by
hash), on whole sets. What still lies in different components under one key goes, with its sets, to tasks by
band of the first collection; bands larger than a tile are split, and their tiles meet in pairs. A task compares
members of different components that share a key, each pair in the first band it shares, until they are found
linked or none is left, and returns only the links that joined two components: a forest, linear in what it read.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwright.llm.common import by_value, components, discard, slices, stage

by_value(__name__)

BANDS, ROWS = 9, 3
_SIGNATURE = "doc_id bigint, n_shingles bigint, h1 bigint, h2 bigint, a array<bigint>, b array<bigint>"
_SET = "doc_id bigint, shingles array<bigint>"
_LINK = "u bigint, v bigint"
#: Documents of a tile, and those compared with one other at once.
TILE, _CHUNK = 512, 64
#: Up to so many bands larger than a tile are broadcast.
BROADCAST_BANDS = 100_000
#: Parts that a class of equal sets is folded in.
PARTS = 64
#: Up to so many ids (8 bytes each) are broadcast to pick their texts.
BROADCAST_IDS = 500_000
CACHED_WORDS = 1 << 17
_SLICE = 256


class _WordHashes(dict):
    def __missing__(self, word):
        value = self[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return value


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, width: int, hashes: dict) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``width`` words; a shorter text is one run."""
    words = text.encode().lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    codes = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    if len(hashes) > CACHED_WORDS:
        hashes.clear()
    width = min(width, len(words))
    runs = np.full(len(words) - width + 1, width, np.uint64)
    for k in range(width):
        runs = _mix(runs + codes[k : len(codes) - width + 1 + k])
    return np.unique(runs)


def _signer(width: int, bands: int, rows: int):
    random = np.random.default_rng(20)
    n = 2 * bands * rows
    factors = random.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    offsets = random.integers(0, 2**63, n, dtype=np.uint64)

    def minima(values: np.ndarray) -> np.ndarray:
        least = np.full(n, np.iinfo(np.uint64).max, np.uint64)
        for at in range(0, len(values), 4096):
            block = values[at : at + 4096, None] * factors + offsets
            np.minimum(least, block.min(axis=0), out=least)
        least = least.reshape(2 * bands, rows)
        keys = np.arange(2 * bands, dtype=np.uint64)
        for k in range(rows):
            keys = _mix(keys + least[:, k])
        return keys.view(np.int64)

    def signed(part, hashes):
        out = []
        for text in part.column(1).to_pylist():
            values = shingle_set(text, width, hashes)
            if len(values):
                placed = _mix(values + np.arange(len(values), dtype=np.uint64))
                marks = [int(np.bitwise_xor.reduce(x).view(np.int64)) for x in (_mix(values), placed)]
                keys = minima(values)
                out.append((len(values), *marks, keys[:bands], keys[bands:]))
            else:
                out.append((0, None, None, None, None))
        kinds = [pa.int64()] * 3 + [pa.list_(pa.int64())] * 2
        arrays = [part.column(0), *(pa.array(c, k) for c, k in zip(zip(*out), kinds))]
        return pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_shingles", "h1", "h2", "a", "b"])

    def sign(batches):
        hashes = _WordHashes()
        for part in slices(batches, _SLICE):
            yield signed(part, hashes)

    return sign


def _setter(width: int):
    def build(batches):
        hashes = _WordHashes()
        for part in slices(batches, _SLICE):
            sets = [shingle_set(t, width, hashes).view(np.int64) for t in part.column(1).to_pylist()]
            arrays = [part.column(0), pa.array(sets, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "shingles"])

    return build


def _sets(texts: DataFrame, ids: DataFrame, width: int) -> tuple[DataFrame, str]:
    """The staged shingle sets of some documents. Texts are shuffled only if the ids are too many to broadcast."""
    ids, path = stage(ids, "ids")
    wanted = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    sets = stage(texts.join(wanted, "doc_id", "left_semi").mapInArrow(_setter(width), _SET).distinct(), "sets")
    discard(texts.sparkSession, path)
    return sets


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those pairs (u, v) whose whole shingle sets are similar enough."""
    left = sets.toDF("u", "su")
    right = sets.toDF("v", "sv")
    common = F.size(F.array_intersect("su", "sv"))
    total = F.size("su") + F.size("sv") - common
    small, large = F.least(F.size("su"), F.size("sv")), F.greatest(F.size("su"), F.size("sv"))
    links = (
        pairs.join(left, "u").join(right, "v")
        .filter((small * 100 >= large * percent) & (common * 100 >= total * percent))
        .select("u", "v")
    )
    return links.distinct()


def _classes(named: DataFrame) -> tuple[DataFrame, DataFrame, str]:
    """Links (u, v) that tie equal sets together, the documents that stand for them, and the folder both read."""
    same = ["h1", "h2", "n_shingles"]
    # by parts of a class first: one class may hold a third of all rows
    parted = named.select("doc_id", *same, F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)).alias("part"))
    parts, path = stage(parted.groupBy(*same, "part").agg(F.min("doc_id").alias("part_id"), F.count("*").alias("n")), "classes")
    firsts = parts.groupBy(*same).agg(F.min("part_id").alias("first_id"), F.sum("n").alias("members"))
    several = parts.join(firsts.filter("members > 1"), same)
    inner = parted.join(several.select(*same, "part", "part_id"), [*same, "part"]).select(F.col("doc_id").alias("u"), F.col("part_id").alias("v"))
    links = inner.union(several.select("part_id", "first_id")).filter("u <> v")
    return links, firsts.select(F.col("first_id").alias("doc_id")), path


def compare(left: dict, right: dict | None, band: int, percent: int) -> list:
    """Links between two tiles, or within one, that join two components; the tiles' components are joined along."""
    other = right or left
    alike = []
    for at in range(len(left["id"])):
        rest = np.arange(at + 1 if right is None else 0, len(other["id"]))
        rest = rest[~(other["a"][rest, :band] == left["a"][at, :band]).any(axis=1)]
        rest = rest[(other["b"][rest] == left["b"][at]).any(axis=1)]
        own = left["sets"][at]
        small, large = np.minimum(len(own), other["n"][rest]), np.maximum(len(own), other["n"][rest])
        rest = rest[100 * small >= percent * large]
        for start in range(0, len(rest), _CHUNK):
            chunk = rest[start : start + _CHUNK]
            chunk = chunk[other["c"][chunk] != left["c"][at]]
            if not len(chunk):
                continue
            several = [other["sets"][k] for k in chunk]
            flat = np.concatenate(several)
            held = own[np.minimum(np.searchsorted(own, flat), len(own) - 1)] == flat
            ends = np.cumsum([len(x) for x in several])
            common = np.add.reduceat(held, ends - other["n"][chunk], dtype=np.int64)
            linked = chunk[100 * common >= percent * (len(own) + other["n"][chunk] - common)]
            for k in linked:
                a, b = left["c"][at], other["c"][k]
                if a != b:
                    alike.append((int(left["id"][at]), int(other["id"][k])))
                    for side in (left, other):
                        side["c"][side["c"] == b] = a
    return alike


def _comparer(percent: int):
    def tile(rows):
        ids, components, a, b, sets = zip(*rows)
        sets = [np.sort(np.asarray(x, np.int64)) for x in sets]
        n = np.array([len(x) for x in sets])
        return {"id": ids, "c": np.array(components), "a": np.array(a), "b": np.array(b), "sets": sets, "n": n}

    def found(place, sides):
        if sides[0] and (sides[1] or place[2] == place[3]):
            left = tile(sides[0])
            links = compare(left, tile(sides[1]) if sides[1] else None, place[0], percent)
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], ["u", "v"])

    def match(batches):
        """Rows come sorted by place; at most two tiles are held."""
        at, sides = None, ([], [])
        for batch in slices(batches, _SLICE):
            columns = [batch.column(k).to_pylist() for k in range(5)]
            lists = [[x.values.to_numpy() for x in batch.column(k)] for k in (7, 8, 9)]
            for *place, side, doc, c, a, b, held in zip(*columns, batch.column(5).to_pylist(), batch.column(6).to_pylist(), *lists):
                if place != at:
                    if at is not None and (out := found(at, sides)) is not None:
                        yield out
                    at, sides = place, ([], [])
                sides[side].append((doc, c, a, b, held))
        if at is not None and (out := found(at, sides)) is not None:
            yield out

    return match


def _apart(shared: DataFrame, joined: DataFrame) -> tuple[DataFrame, str]:
    """Members (doc_id, band i, component c) of the keys that hold several components, staged."""
    spark = shared.sparkSession
    placed = shared.join(joined, F.col("doc_id") == F.col("node"), "left").select(
        "key", "i", "doc_id", F.coalesce("component", "doc_id").alias("c")
    )
    placed, path = stage(placed, "placed")
    mixed = placed.groupBy("key").agg(F.min("c").alias("low"), F.max("c").alias("high")).filter("low < high")
    apart = stage(placed.join(mixed.select("key"), "key", "left_semi").select("doc_id", "i", "c").distinct(), "apart")
    discard(spark, path)
    return apart


def _tiled(apart: DataFrame, named: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between components that share a key, found in tasks by band."""
    place = ["i", "x"]
    rows = apart.join(named.select("doc_id", "a", "b").distinct(), "doc_id").withColumn("x", F.get("a", "i"))
    large = rows.groupBy(*place).count().filter(F.col("count") > TILE).select(*place, F.ceil(F.col("count") / TILE).cast("int").alias("tiles"))
    large, path = stage(large, "large")
    few = large.count() <= BROADCAST_BANDS
    split = rows.join(F.broadcast(large) if few else large, place, "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)))
    split = split.withColumn("tile", F.pmod(F.xxhash64("doc_id"), F.col("tiles")).cast("int"))
    met = split.select("*", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("partner")).join(sets, "doc_id").select(
        *place, F.least("tile", "partner").alias("low"), F.greatest("tile", "partner").alias("high"),
        (F.col("tile") > F.col("partner")).cast("int").alias("side"), "doc_id", "c", "a", "b", "shingles",
    )
    pair = [*place, "low", "high"]
    links, _ = stage(met.repartition(*pair).sortWithinPartitions(*pair).mapInArrow(_comparer(percent), _LINK), "links")
    discard(apart.sparkSession, path)
    return links


def near_duplicates(
    docs: DataFrame, shingle_words: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """Per document: n_shingles, component_id (smallest doc_id reachable over links) and kept.

    Reads ``doc_id`` (integer) and ``text`` only. A null or wordless text has no shingles and links
    with nothing; so does a row without doc_id, which keeps a null component and is kept. Rows that
    share a doc_id are one node, linked if any of their texts is; each row is returned. An empty
    table gives an empty result. Whole texts count, whatever their length.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    signed, _ = stage(texts.mapInArrow(_signer(shingle_words, bands, rows), _SIGNATURE), "signatures")
    named = signed.filter("n_shingles > 0 and doc_id is not null")
    copies, classes, classes_path = _classes(named)
    members = (
        named.join(classes.distinct(), "doc_id").select("doc_id", "b", F.posexplode("a").alias("i", "x"))
        .select("doc_id", "i", "x", F.posexplode("b").alias("j", "y"))
        .select("doc_id", "i", F.xxhash64("i", "j", "x", "y").alias("key"))
    )
    hubs = members.groupBy("key").agg(
        F.min("doc_id").alias("first_id"),
        F.max("doc_id").alias("last_id"),
        F.min_by("doc_id", F.xxhash64("doc_id")).alias("some_id"),
    ).filter("first_id < last_id")
    shared, shared_path = stage(members.join(hubs, "key"), "members")
    stars = shared.select("doc_id", F.explode(F.array("first_id", "last_id", "some_id")).alias("hub")).filter("doc_id <> hub")
    tried = stars.select(F.least("doc_id", "hub").alias("u"), F.greatest("doc_id", "hub").alias("v")).distinct()
    sets, sets_path = _sets(texts, shared.select("doc_id").distinct(), shingle_words)
    links, links_path = stage(copies.union(_confirmed(tried, sets, percent)), "links")
    joined = components(links, "u", "v")

    apart, apart_path = _apart(shared, joined)
    more = _tiled(apart, named, sets, percent)
    if not more.isEmpty():
        joined = components(joined.toDF("u", "v").union(more), "u", "v")
    discard(spark, classes_path, shared_path, sets_path, links_path, apart_path)
    component = F.coalesce("component", "doc_id").alias("component_id")
    out = signed.join(joined, signed.doc_id == joined.node, "left")
    return out.select(
        "doc_id", "n_shingles", component,
        F.coalesce(F.coalesce("component", "doc_id") == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def without_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """The documents, with one of each group of near copies: the one with the smallest doc_id.

    Columns are those of ``docs``. Rows that near_duplicates keeps stay, rows without doc_id too.
    """
    dropped = near_duplicates(docs, **options).filter("not kept").select("doc_id").distinct()
    return docs.join(dropped, "doc_id", "left_anti").select(docs.columns)
