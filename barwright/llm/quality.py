"""Quality classifier by compression: which of two dictionaries shortens a text more.

Zstandard dictionaries are built from pieces of text labelled good and of text labelled bad. A text is
compressed in blocks with either one; what counts is the difference of the two sizes over their sum. A
logistic model turns it, with the ratio reached and the text's length, into a probability. It is fitted
on labelled texts that no dictionary has seen.
"""

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwright.llm.common import by_value, slices
from barwright.llm.langid import held_out

by_value(__name__)

#: Labelled documents per class that are learned from, at most; half of them make the dictionaries.
SAMPLE = 8000
#: Pieces per class that a dictionary is made of, at most, and their characters.
PIECES, PIECE = 16_000, 512
DICTIONARY, LEVEL = 112 << 10, 3
#: Bytes compressed at once. Small blocks keep the dictionary near.
BLOCK = 1 << 11
THRESHOLD = 0.3
_SLICE = 256


def labelled(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, quality, text) of at most ``sample`` ids per class, chosen by a hash, none held out.

    Ids with a null, another or with both labels are left out, and null texts.
    """
    known = labels.filter("doc_id is not null and quality in (0, 1)").filter(~held_out())
    known = known.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        F.min("quality").cast("int").alias("quality"), F.max("quality").alias("other")
    ).filter("quality = other").select("doc_id", "quality")
    drawn = [known.filter(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for q in (0, 1)]
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").filter("text is not null")
    return texts.join(F.broadcast(drawn[0].union(drawn[1])), "doc_id")


def _for_dictionary():
    """Which labelled documents make the dictionaries; the others fit the probabilities."""
    return F.crc32(F.col("doc_id").cast("string")) % 5 <= 2


def dictionary(pieces: list) -> bytes:
    """The dictionary of some pieces of text; their plain content where they are too few to train on."""
    coded = [p.encode() for p in pieces]
    try:
        return zstandard.train_dictionary(DICTIONARY, coded, k=200, d=8, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(coded)[:DICTIONARY]


def _compressor(content: bytes):
    if not content:
        return zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)
    known = zstandard.ZstdCompressionDict(content)
    known.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_content_size=False, write_dict_id=False)


def compressors(contents) -> list:
    return [_compressor(c) for c in contents]


def measure(text: str | None, pair: list) -> tuple:
    """(difference, ratio, length) of a whole text; all zero for an empty one."""
    coded = (text or "").encode()
    sizes = [0, 0]
    for at in range(0, len(coded), BLOCK):
        block = coded[at : at + BLOCK]
        for k in (0, 1):
            sizes[k] += len(pair[k].compress(block))
    bad, good = sizes
    if not coded:
        return 0.0, 0.0, 0.0
    return (bad - good) / (bad + good), float(np.log((bad + good) / (2 * len(coded)))), float(np.log(len(coded)))


def _terms(values: np.ndarray) -> np.ndarray:
    x, ratio, length = values.T
    return np.stack([np.ones(len(x)), x, ratio, length, x * x, ratio * ratio, length * length, x * ratio, x * length, ratio * length], 1)


def fit(values: np.ndarray, quality: np.ndarray) -> tuple:
    """Mean, scale and weights of the logistic model, by Newton steps that never raise the loss."""
    terms = _terms(values)
    mean, scale = terms.mean(0), terms.std(0) + 1e-9
    mean[0], scale[0] = 0, 1
    z = (terms - mean) / scale

    def loss(w):
        return np.logaddexp(0, -np.where(quality == 1, 1, -1) * (z @ w)).sum() + 0.005 * (w @ w)

    w = np.zeros(z.shape[1])
    now = loss(w)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -40, 40)))
        slope = z.T @ (p - quality) + 0.01 * w
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + 0.01 * np.eye(len(w)), slope)
        rate = 1.0
        while rate > 1e-6 and loss(w - rate * step) > now:
            rate /= 2
        if rate <= 1e-6 or now - loss(w - rate * step) < 1e-7:
            break
        w, now = w - rate * step, loss(w - rate * step)
    return mean, scale, w


def probabilities(values: np.ndarray, model: tuple) -> np.ndarray:
    mean, scale, w = model
    return 1 / (1 + np.exp(-np.clip(((_terms(values) - mean) / scale) @ w, -40, 40)))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> dict:
    """Two dictionaries (bad, good) and the logistic model.

    Without a text of both classes to fit, the model is None and ``base``, the share of good texts
    (one half without any), is every score.
    """
    known = labelled(docs, labels, sample)
    cut = known.filter(_for_dictionary()).select("quality", F.explode(F.expr(f"regexp_extract_all(text, '(?s).{{1,{PIECE}}}', 0)")).alias("piece"))
    contents = []
    for q in (0, 1):
        pieces = cut.filter(F.col("quality") == q).select("piece").distinct()
        drawn = pieces.orderBy(F.xxhash64("piece"), "piece").limit(PIECES).collect()
        contents.append(dictionary([r["piece"] for r in drawn]))

    def measured(batches):
        pair = compressors(contents)
        for part in slices(batches, _SLICE):
            found = [measure(t, pair) for t in part.column(1).to_pylist()]
            columns = [pa.array(c, pa.float64()) for c in zip(*found)] if found else [pa.array([], pa.float64())] * 3
            yield pa.RecordBatch.from_arrays([part.column(0), *columns], ["quality", "x", "ratio", "length"])

    rows = known.filter(~_for_dictionary()).select("quality", "text").mapInArrow(
        measured, "quality int, x double, ratio double, length double"
    )
    # repeated texts count once, so that a few widely copied ones can't take up the bound
    rows = rows.distinct().orderBy(F.xxhash64("x", "ratio", "length"), "quality").limit(2 * sample).collect()
    values = np.array([tuple(r)[1:] for r in rows]).reshape(-1, 3)
    quality = np.array([r["quality"] for r in rows], float)
    both = 0 < quality.sum() < len(quality)
    base = (quality.sum() + 0.5) / (len(quality) + 1)
    return {"contents": contents, "model": fit(values, quality) if both else None, "base": float(base)}


def score_texts(texts: list, trained: dict, pair: list) -> np.ndarray:
    if trained["model"] is None or not texts:
        return np.full(len(texts), trained["base"])
    return probabilities(np.array([measure(t, pair) for t in texts]), trained["model"])


def scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """Per row: doc_id, held_out, score (how likely label 1 is) and predicted (1 from ``threshold`` on).

    Reads ``doc_id`` and ``text`` of ``docs``, ``doc_id`` and ``quality`` of ``labels``. A null text counts
    as an empty one, and has the score of a text of no length. Texts of any length count whole, repeated
    rows come out alike, rows without doc_id are scored and are not held out. An empty table of documents
    gives an empty result; without labels every score is one half.
    """
    trained = docs.sparkSession.sparkContext.broadcast(train(docs, labels, sample))

    def judge(batches):
        pair = compressors(trained.value["contents"])
        for part in slices(batches, _SLICE):
            found = score_texts(part.column(2).to_pylist(), trained.value, pair)
            arrays = [part.column(0), part.column(1), pa.array(found, pa.float64()), pa.array((found >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out().alias("held_out"), "text")
    return rows.mapInArrow(judge, "doc_id bigint, held_out boolean, score double, predicted int")
