"""Ranked lexical search: best-first document intervals bounded by range-maximum tables.

Documents are dealt to shards. A shard keeps, for every query word, the postings in the order of doc_id
with their impacts, and a sparse table that tells the largest impact in any range of a posting list by two
lookups. For an item, the sum of these maxima over its words bounds the score of every document in an
interval. The intervals of the highest bounds are taken first; each is split at the document of the largest
single impact, which is scored exactly. It ends once no interval's bound can reach the last of the best
documents found so far.

A term's impact in a document depends on corpus-wide counts. They are summed over all documents before the
search: texts are read once, the postings of query words staged.
"""

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from barwright.llm.common import WORD_BYTES, by_value, discard, slices, stage, word_array

by_value(__name__)

#: (item, word) pairs looked up at once, about; more items are answered in several rounds.
ITEM_WORDS = 200_000
#: Postings of one shard: its tables take some 130 bytes each.
SHARD_POSTINGS = 1 << 20
SHARD_DOCS = 1 << 16
#: Documents per task, about.
TASK_DOCS = 1 << 14
_SLICE = 256
_NO_ID = np.iinfo(np.int64).max


def item_words(items: DataFrame) -> DataFrame:
    """Distinct (item_id, word) of all items; rows that share an item_id are one item."""
    words = items.select(F.col("item_id").cast("bigint").alias("item_id"), F.explode(word_array(F.col("text"))).alias("word"))
    return words.distinct()


def _counter(vocabulary):
    def count(batches):
        known = vocabulary.value
        for part in slices(batches, _SLICE):
            sizes, terms, counts = [], [], []
            for text in part.column(1).to_pylist():
                words = text.encode().translate(WORD_BYTES).split() if text else []
                found = Counter(words)
                here = [(known[w], found[w]) for w in found.keys() & known.keys()]
                sizes.append(len(words))
                terms.append([t for t, _ in here])
                counts.append([c for _, c in here])
            arrays = [part.column(0), pa.array(sizes, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n", "terms", "counts"])

    return count


def lengths(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """The length part m of the score; in Python's integers where 64 bits could overflow."""
    if len(n) and 50 * int(n.max()) * n_docs >= 2**63:
        n = n.astype(object)
    return (50 + (50 * n * n_docs) // max(n_terms, 1)).astype(np.int64)


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Shard:
    """Postings of some documents, by term and then by place in the order of doc_id, and their tables."""

    def __init__(self, doc_ids, sizes, terms, impacts):
        order = np.argsort(doc_ids, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.doc_ids = doc_ids[order]
        self.n_docs = len(order)
        keys = terms.astype(np.int64) * self.n_docs + np.repeat(place, sizes)
        by_key = np.argsort(keys)
        self.keys, self.impacts = keys[by_key], impacts[by_key]
        longest = int(np.bincount(terms).max()) if len(terms) else 0
        levels = [np.arange(len(keys), dtype=np.int32)]
        while 2 << (len(levels) - 1) <= longest:
            # where the largest impact of the next 2^k postings lies; ranges asked for stay within a term
            half, below = 1 << (len(levels) - 1), levels[-1]
            level = below.copy()
            left, right = below[:-half], below[half:]
            level[:-half] = np.where(self.impacts[right] > self.impacts[left], right, left)
            levels.append(level)
        self.levels = np.stack(levels)

    def lists(self, terms: np.ndarray):
        """Start and end of each term's postings."""
        return np.searchsorted(self.keys, terms * self.n_docs), np.searchsorted(self.keys, (terms + 1) * self.n_docs)

    def largest(self, low: np.ndarray, high: np.ndarray):
        """The posting of largest impact in each non-empty range, and its impact; 0 for an empty one."""
        size = high - low
        some = np.maximum(size, 1)
        level = np.frexp(some.astype(np.float64))[1] - 1  # exact: sizes are far below 2^53
        first = np.minimum(low, len(self.keys) - 1)
        last = np.maximum(high - (1 << level), 0)
        a, b = self.levels[level, first], self.levels[level, last]
        at = np.where(self.impacts[b] > self.impacts[a], b, a)
        return at, np.where(size > 0, self.impacts[at], 0)

    def intervals(self, low, high):
        """Bound of each interval (rows of ranges, a column per term) and the document to split it at."""
        at, most = self.largest(low, high)
        rows = np.arange(len(low))
        return most.sum(axis=1), self.keys[at[rows, most.argmax(axis=1)]] % self.n_docs

    def search(self, terms: np.ndarray, best: tuple, most: int) -> tuple:
        """``best`` (scores, doc_ids: highest first) merged with this shard's documents for some terms."""
        low, high = self.lists(terms)
        there = high > low
        terms, low, high = terms[there], low[there][None], high[there][None]
        if not len(terms):
            return best
        scores, ids = best
        bounds, splits = self.intervals(low, high)
        starts = np.zeros(1, np.int64)
        while len(bounds):
            if len(scores) >= most:
                # an equal score counts only for a smaller doc_id than that of the last one held
                useful = (bounds > scores[-1]) | ((bounds == scores[-1]) & (self.doc_ids[starts] < ids[-1]))
            else:
                useful = bounds > 0
            bounds, splits, starts, low, high = (x[useful] for x in (bounds, splits, starts, low, high))
            if not len(bounds):
                break
            taken = np.zeros(len(bounds), bool)
            n_taken = max(32, len(bounds) // 3)
            taken[np.argpartition(-bounds, min(n_taken, len(bounds)) - 1)[:n_taken]] = True
            split = splits[taken]
            wanted = terms * self.n_docs + split[:, None]
            at = np.searchsorted(self.keys, wanted)
            held = self.keys[np.minimum(at, len(self.keys) - 1)] == wanted
            found = np.where(held, self.impacts[np.minimum(at, len(self.keys) - 1)], 0).sum(axis=1)
            scores = np.concatenate([scores, found])
            ids = np.concatenate([ids, self.doc_ids[split]])
            first = np.lexsort((ids, -scores))[:most]
            scores, ids = scores[first], ids[first]
            left, right = (low[taken], at), (at + held, high[taken])
            new_low, new_high = (np.concatenate(x) for x in zip(left, right))
            new_starts = np.concatenate([starts[taken], split + 1])
            new_bounds, new_splits = self.intervals(new_low, new_high)
            some = new_bounds > 0
            rest = ~taken
            bounds, splits, starts, low, high = (
                np.concatenate([x[rest], y[some]])
                for x, y in zip((bounds, splits, starts, low, high), (new_bounds, new_splits, new_starts, new_low, new_high))
            )
        return scores, ids


def _searcher(questions, numbers, most: int):
    """Search of a task's documents, shard by shard; what a shard found bounds the next ones."""

    def search(batches):
        asked, (n_docs, n_terms, weights) = questions.value, numbers.value
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in asked]

        def shards():
            held, postings, rows = [], 0, 0
            for part in slices(batches, 1024):
                held.append(part)
                postings += len(part.column(2).flatten())
                rows += part.num_rows
                if postings >= SHARD_POSTINGS or rows >= SHARD_DOCS:
                    yield pa.Table.from_batches(held).combine_chunks()
                    held, postings, rows = [], 0, 0
            if rows:
                yield pa.Table.from_batches(held).combine_chunks()

        for rows in shards():
            columns = [rows.column(c).combine_chunks() for c in ("doc_id", "n", "terms", "counts")]
            ids = columns[0].fill_null(_NO_ID).to_numpy()
            sizes = np.diff(columns[2].offsets.to_numpy())
            terms = columns[2].flatten().to_numpy()
            tf = columns[3].flatten().to_numpy().astype(np.int64)
            if not len(terms):
                continue
            m = np.repeat(lengths(columns[1].to_numpy(), n_docs, n_terms), sizes)
            impacts = weights[terms] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))
            shard = Shard(ids, sizes, terms, impacts)
            for k, (_, words) in enumerate(asked):
                best[k] = shard.search(words, best[k], most)
        for (item, _), (scores, ids) in zip(asked, best):
            keep = scores > 0
            out = [pa.array([item] * int(keep.sum()), pa.int64()), pa.array(ids[keep], mask=ids[keep] == _NO_ID), pa.array(scores[keep])]
            yield pa.RecordBatch.from_arrays(out, ["item_id", "doc_id", "score"])

    return search


def _best(found: DataFrame, most: int, *groups) -> DataFrame:
    order = W.partitionBy("item_id", *groups).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def _round(texts: DataFrame, pairs: list, most: int) -> DataFrame:
    """The best documents of some items, from what every task found."""
    spark = texts.sparkSession
    share = spark.sparkContext.broadcast
    vocabulary = {w: k for k, w in enumerate(sorted({w for _, w in pairs}))}
    asked = {}
    for item, word in pairs:
        asked.setdefault(item, []).append(vocabulary[word])
    asked = [(item, np.array(sorted(words), np.int64)) for item, words in asked.items()]
    postings = texts.mapInArrow(
        _counter(share({w.encode(): k for w, k in vocabulary.items()})), "doc_id bigint, n bigint, terms array<int>, counts array<int>"
    )
    postings, path = stage(postings, "postings")
    told = postings.agg(F.count_if(F.col("n") > 0), F.sum("n"), F.count("*")).first()
    n_docs, n_terms, n_rows = (x or 0 for x in told)
    df = postings.select(F.explode("terms").alias("term")).groupBy("term").count().collect()  # a row per query word
    weights = np.zeros(len(vocabulary), np.int64)
    for row in df:
        weights[row["term"]] = weight(n_docs, row["count"])
    # shards of some size: many small files are read by few tasks
    tasks = max(spark.sparkContext.defaultParallelism, -(-n_rows // TASK_DOCS))
    search = _searcher(share(asked), share((n_docs, n_terms, weights)), most)
    found = postings.coalesce(tasks).mapInArrow(search, "item_id bigint, doc_id bigint, score bigint")
    found, _ = stage(found, "found")
    discard(spark, path)
    return found


def ranked(docs: DataFrame, items: DataFrame, most: int = 50) -> DataFrame:
    """Per item its ``most`` best documents: item_id, rank (from 1), doc_id, score.

    Reads ``doc_id`` and ``text`` of the documents, ``item_id`` and ``text`` of the items. Texts without
    words, null or empty, match nothing and don't count as documents; very long ones count whole. Items
    without words have no rows, rows of one item_id are one item, and a null item_id is an item like others.
    Equal scores go by doc_id, rows without one last; repeated rows of a document are ranked each. Empty
    tables give an empty result.
    """
    spark = docs.sparkSession
    words, path = stage(item_words(items), "items")
    rounds = max(1, -(-words.count() // ITEM_WORDS))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    found = None
    for k in range(rounds):
        own = words.filter(F.pmod(F.xxhash64("item_id"), F.lit(rounds)) == k).collect()
        part = _round(texts, [tuple(r) for r in own], most)
        found = part if found is None else found.union(part)
    discard(spark, path)
    groups = F.pmod(F.coalesce(F.xxhash64("doc_id"), F.lit(0)), F.lit(64))
    first = _best(found.withColumn("part", groups), most, "part").drop("rank", "part")
    return _best(first, most).select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
