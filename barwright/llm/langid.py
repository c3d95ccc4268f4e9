"""Language ID: multinomial naive Bayes over hashed character n-grams.

Runs of one to three characters of the lower-cased letters, with a mark between words, are hashed into
``buckets``. Executors count them for labelled documents, Spark sums the counts, and the smoothed
log-probabilities (languages x buckets) are broadcast. A batch of texts is scored as a sparse product:
the buckets of all its n-grams pick columns of the matrix, which are summed per text.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwright.llm.common import by_value, slices

by_value(__name__)

BUCKETS = 1 << 15
#: Training texts per language, in expectation. All labelled texts serve where there are fewer.
SAMPLE = 3000
#: A model holds at most so many languages (4 bytes x buckets each in the broadcast).
MOST_LANGUAGES = 400
#: Evidence counts as at most so many independent n-grams: neighbouring ones overlap.
EVIDENCE = 64
UNKNOWN = "und"
#: Characters that are hashed at once, and rows that are turned into strings at once.
_BLOCK, _SLICE = 1 << 17, 256


def letter_table() -> np.ndarray:
    """For each code point, whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _blocks(texts):
    """Lists of (row, piece) of about ``_BLOCK`` characters; a piece's end counts as a word's end."""
    block, size = [], 0
    for row, text in enumerate(texts):
        for at in range(0, len(text or ""), _BLOCK):
            block.append((row, text[at : at + _BLOCK].lower()))
            size += len(block[-1][1])
            if size >= _BLOCK:
                yield block
                block, size = [], 0
    if block:
        yield block


def grams(texts, letters: np.ndarray, buckets: int):
    """Blocks of (row of each n-gram, its bucket) over the texts of a batch.

    Zero stands for a run of anything but letters. An n-gram lies within a word and its two marks:
    one letter, two characters that aren't both marks, or three around a letter.
    """
    for block in _blocks(texts):
        codes = np.frombuffer("\0".join([""] + [t for _, t in block] + [""]).encode("utf-32-le"), np.uint32)
        lengths = [1] + [len(t) + 1 for _, t in block]  # a separator belongs to the piece before it
        rows = np.repeat(np.array([block[0][0]] + [r for r, _ in block]), lengths)
        codes = np.where(letters[codes], codes, 0).astype(np.uint64)
        keep = np.concatenate([[True], (codes[1:] != 0) | (codes[:-1] != 0)])
        codes, rows = codes[keep], rows[keep]
        two = (codes[:-1] << np.uint64(21)) + codes[1:]
        three = (two[:-1] << np.uint64(21)) + codes[2:]
        inner = codes[1:-1] != 0
        keys = np.concatenate([codes[codes != 0], two, three[inner] + (np.uint64(1) << np.uint64(63))])
        places = np.concatenate([rows[codes != 0], rows[1:], rows[1:-1][inner]])
        yield places, ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.int64) % buckets


def _counter(buckets: int):
    def count(batches):
        letters, counts = letter_table(), {}
        for batch in slices(batches, _SLICE):
            langs = batch.column(0).to_pylist()
            names = sorted(set(langs))
            code = np.array([names.index(x) for x in langs])
            for rows, found in grams(batch.column(1).to_pylist(), letters, buckets):
                n = np.bincount(code[rows] * buckets + found, minlength=len(names) * buckets).reshape(-1, buckets)
                for name, own in zip(names, n):
                    counts[name] = counts.get(name, 0) + own
        for name, own in counts.items():
            some = np.flatnonzero(own)
            arrays = [pa.array([name] * len(some), pa.string()), pa.array(some), pa.array(own[some])]
            yield pa.RecordBatch.from_arrays(arrays, ["lang", "bucket", "n"])

    return count


def held_out():
    """Whether a document is kept from training: a fifth of them, by their id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, buckets: int = BUCKETS, sample: int = SAMPLE) -> tuple[list, np.ndarray]:
    """Language names and their log-probabilities, from documents with a language that aren't held out.

    About ``sample`` documents per language are read, chosen by a hash of their id, whole texts each.
    Rows without doc_id, text or lang take no part. Of more than MOST_LANGUAGES the largest are learned.
    """
    labelled = docs.select("doc_id", "text", "lang").filter(~held_out())
    labelled = labelled.filter("lang is not null and text is not null and doc_id is not null")
    sizes = labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGUAGES)
    share = F.least(F.lit(1.0), F.lit(float(sample)) / F.col("count"))
    rates = F.broadcast(sizes.select(F.col("lang").alias("known"), share.alias("rate")))
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    chosen = labelled.join(rates, F.col("lang") == F.col("known")).filter(draw < F.col("rate")).select("lang", "text")
    counts = chosen.mapInArrow(_counter(buckets), "lang string, bucket bigint, n bigint")
    # at most a number per language and bucket
    rows = counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    names = sorted(rows["lang"].unique())
    matrix = np.ones((len(names), buckets))
    matrix[[names.index(x) for x in rows["lang"]], rows["bucket"].to_numpy(int)] += rows["n"].to_numpy(float)
    return names, np.log(matrix / matrix.sum(axis=1, keepdims=True)).astype(np.float32)


def classify(texts, names: list, matrix: np.ndarray, letters: np.ndarray) -> tuple[list, np.ndarray]:
    """Names and scores of a batch of texts."""
    sums, n = np.zeros((len(names), len(texts))), np.zeros(len(texts))
    for rows, found in grams(texts, letters, matrix.shape[1]):
        n += np.bincount(rows, minlength=len(texts))
        for k in range(len(names)):
            sums[k] += np.bincount(rows, matrix[k][found], minlength=len(texts))
    if not names:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    sums *= np.minimum(n, EVIDENCE) / np.maximum(n, 1)
    best = sums.argmax(axis=0)
    score = 1 / np.exp(sums - sums.max(axis=0)).sum(axis=0)
    return [names[b] if m else UNKNOWN for b, m in zip(best, n)], np.where(n > 0, score, 0.0)


def languages(docs: DataFrame, **options) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred and score, the posterior of the language predicted.

    Reads ``doc_id``, ``text`` and, for training only, ``lang``. A null text and one without letters
    are ``und`` with score 0; so is everything where no labelled document is. Repeated rows are
    scored alike. A null doc_id is not held out, and not trained on either. Texts of any length count
    whole, in blocks. An empty table gives an empty result.
    """
    names, matrix = train(docs, **options)
    model = docs.sparkSession.sparkContext.broadcast(matrix)

    def predict(batches):
        letters = letter_table()
        for batch in slices(batches, _SLICE):
            found, score = classify(batch.column("text").to_pylist(), names, model.value, letters)
            arrays = [batch.column("doc_id"), batch.column("held_out"), pa.array(found, pa.string()), pa.array(score)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out().alias("held_out"), "text")
    return rows.mapInArrow(predict, "doc_id bigint, held_out boolean, lang_pred string, score double")


def with_known_language(docs: DataFrame, least_score: float = 0.5, **options) -> DataFrame:
    """The rows whose language is told with at least ``least_score``, and the columns of ``docs``."""
    names, matrix = train(docs, **options)
    model = docs.sparkSession.sparkContext.broadcast(matrix)

    def accept(batches):
        letters = letter_table()
        for batch in slices(batches, _SLICE):
            found, score = classify(batch.column("text").to_pylist(), names, model.value, letters)
            keep = (np.array(found) != UNKNOWN) & (score >= least_score) if found else np.zeros(0, bool)
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(accept, docs.schema)
