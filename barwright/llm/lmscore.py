"""Document scores by masked pseudo-likelihood.

A bidirectional window network predicts every word's symbol from the two words before and the two behind:
each place of the window has an embedding table of its own, their sum goes through tanh to a softmax. A
document's score is the sum of the log-probabilities of all its words, each given both its sides.

Words are counted over the whole corpus; the most frequent ones are symbols of their own, all others share
symbols by a hash. A shared word's probability is its symbol's times its share of the symbol's occurrences, so
each word has a probability of its own and those of all words add up to one. Counts of the commoner words go to
the tasks with the job, those of all others are joined. Each task trains a copy of the network on targets at every ``STRIDE``-th word of its
documents, over their whole length, and Spark averages the copies by their targets (``ROUNDS`` times, each
beginning a word further on, so that all words are targets). So
what is gathered from the corpus, counts and weights, grows with it, and what is broadcast doesn't.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwright.llm.common import WORD_BYTES, by_value, discard, stage

by_value(__name__)

FREQUENT, SHARED, WIDTH = 192, 64, 16
SYMBOLS = FREQUENT + SHARED
#: The symbol beyond a document's ends.
EDGE = SYMBOLS
OFFSETS = (-2, -1, 1, 2)
#: Each round has every second word as a target, so that the two have every word once.
STRIDE, ROUNDS = 2, 2
LEARNING_RATE, STEP = 0.2, 512
#: Most words whose counts are broadcast; the others' counts are joined.
KNOWN = 1 << 16
_CACHED, _SLICE, _ROWS = 1 << 17, 256, 512


def split_words(text: str | None) -> list:
    return text.encode().translate(WORD_BYTES).split() if text else []


class Symbols(dict):
    """Word to code; remembers words without a code of their own for a while.

    ``known`` are words with their counts, the first ``FREQUENT`` with own symbols, and ``totals`` the
    occurrences of each shared symbol. Codes from ``rest`` on stand for words that aren't known.
    """

    def __init__(self, known: list, totals: np.ndarray):
        super().__init__()
        self.own = {w: k for k, (w, _) in enumerate(known)}
        self.update(self.own)
        self.rest = len(known)
        shared = known[FREQUENT:]
        buckets = np.array([*(zlib.crc32(w) % SHARED for w, _ in shared), *range(SHARED)])
        counts = np.array([*(n for _, n in shared), *[1] * SHARED])
        own = min(FREQUENT, len(known))
        self.symbol = np.concatenate([np.arange(own), FREQUENT + buckets]).astype(np.uint8)
        #: Log of a word's share of its symbol; that of a word that isn't known lacks its count.
        self.share = np.concatenate([np.zeros(own), np.log(counts) - np.log(np.maximum(totals, 1))[buckets]])

    def __missing__(self, word):
        if len(self) > _CACHED + len(self.own):
            self.clear()
            self.update(self.own)
        code = self[word] = self.rest + zlib.crc32(word) % SHARED
        return code

    def of(self, text: str | None) -> tuple:
        """Symbols of the words, the sum of their shares, and the words that aren't known."""
        words = split_words(text)
        codes = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        rest = [words[k] for k in np.flatnonzero(codes >= self.rest)]
        return self.symbol[codes].tobytes(), float(self.share[codes].sum()), rest


class Network:
    """Weights in one flat array, so that they can be summed by position."""

    SHAPES = [(len(OFFSETS), SYMBOLS + 1, WIDTH), (WIDTH,), (WIDTH, SYMBOLS), (SYMBOLS,)]

    def __init__(self, flat: np.ndarray | None = None):
        sizes = [int(np.prod(s)) for s in self.SHAPES]
        if flat is None:
            flat = np.random.default_rng(8).normal(0, 0.1, sum(sizes))
        self.flat = np.asarray(flat, np.float32).copy()
        ends = np.cumsum(sizes)
        parts = [self.flat[e - s : e].reshape(shape) for e, s, shape in zip(ends, sizes, self.SHAPES)]
        self.places, self.bias, self.out, self.out_bias = parts
        # written anew in every step: large arrays are slow to come by
        self.logits = np.empty((max(_ROWS, STEP), SYMBOLS), np.float32)
        self.ones = np.ones(SYMBOLS, np.float32)

    def hidden(self, around: np.ndarray) -> np.ndarray:
        """around: the window's symbols, a row per place."""
        total = self.bias + self.places[0][around[0]]
        for table, symbols in zip(self.places[1:], around[1:]):
            total += table[symbols]
        return np.tanh(total)

    def _shifted(self, hidden: np.ndarray) -> np.ndarray:
        """Logits, less their row's largest where exp could overflow or a row vanish under it.

        No hidden value is beyond one, so the weights bound what a logit can be.
        """
        logits = np.matmul(hidden, self.out, out=self.logits[: len(hidden)])
        logits += self.out_bias
        if (np.abs(self.out).sum(axis=0) + np.abs(self.out_bias)).max() > 40:
            logits -= logits.max(axis=1, keepdims=True)
        return logits

    def log_probabilities(self, around: np.ndarray, target: np.ndarray) -> np.ndarray:
        scores = np.empty(len(target))
        for at in range(0, len(target), _ROWS):
            part = slice(at, at + _ROWS)
            logits = self._shifted(self.hidden(around[:, part]))
            own = logits[np.arange(len(logits)), target[part]]
            scores[part] = own - np.log(np.exp(logits, out=logits) @ self.ones)
        return scores

    def gradient(self, around: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Of the mean loss, as one flat array."""
        hidden = self.hidden(around)
        p = self._shifted(hidden)
        np.exp(p, out=p)
        p *= (1 / (len(target) * (p @ self.ones)))[:, None]
        p[np.arange(len(target)), target] -= np.float32(1 / len(target))
        back = (p @ self.out.T) * (1 - hidden * hidden)
        places, symbols, width = self.SHAPES[0]
        cells = ((np.arange(places)[:, None] * symbols + around)[:, :, None] * width + np.arange(width)).ravel()
        tables = np.bincount(cells, np.tile(back.ravel(), places), places * symbols * width).astype(np.float32)
        return np.concatenate([tables, back.sum(axis=0), (hidden.T @ p).ravel(), p.sum(axis=0)])


class Trainer:
    """Steps of adaptive gradient descent over a stream of documents."""

    def __init__(self, network: Network, stride: int = STRIDE):
        self.network, self.stride, self.targets = network, stride, 0
        self.squares = np.full(len(network.flat), 1e-8, np.float32)
        self.waiting, self.size = [], 0

    def add(self, symbols: np.ndarray, first: int) -> None:
        self.waiting.append((symbols, first))
        self.size += len(range(first, len(symbols), self.stride))
        if self.size >= 16 * STEP:
            self.flush()

    def flush(self) -> None:
        if self.size:
            documents, firsts = zip(*self.waiting)
            around, target = windows(documents, firsts, self.stride)[:2]
            for at in range(0, len(target), STEP):
                part = slice(at, at + STEP)
                slope = self.network.gradient(around[:, part], target[part])
                self.squares += slope**2
                self.network.flat -= LEARNING_RATE * slope / np.sqrt(self.squares)
            self.targets += len(target)
        self.waiting, self.size = [], 0


def windows(documents: list, firsts=0, stride: int = 1):
    """Symbols around each target, the targets, and the document of each."""
    firsts = np.broadcast_to(firsts, len(documents))
    edge = np.full(2, EDGE)
    line = np.concatenate([edge, *(part for d in documents for part in (d, edge))])
    ends = np.cumsum([len(d) + 2 for d in documents])
    places = [np.arange(e - len(d) + first, e, stride) for d, e, first in zip(documents, ends, firsts)]
    owner = np.repeat(np.arange(len(documents)), [len(p) for p in places])
    at = np.concatenate(places)
    return np.stack([line[at + k] for k in OFFSETS]), line[at], owner


def word_counts(docs: DataFrame) -> DataFrame:
    """Every word of all texts and how often it comes."""

    def count(batches):
        counts = {}

        def flushed():
            arrays = [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())]
            counts.clear()
            return pa.RecordBatch.from_arrays(arrays, ["word", "n"])

        for batch in batches:
            for at in range(0, batch.num_rows, _SLICE):
                for text in batch.column(0).slice(at, _SLICE).to_pylist():
                    for word in split_words(text):
                        counts[word] = counts.get(word, 0) + 1
                if len(counts) > _CACHED:
                    yield flushed()
        yield flushed()

    return docs.select("text").mapInArrow(count, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def _known(counts: DataFrame) -> tuple:
    """The commonest words with their counts, the most frequent first, and the least count from which all are there."""
    least, found = None, 0
    # as many of the highest counts as fit, in steps of an eighth of a power of two: a few hundred rows
    step = F.floor(F.log2("n") * 8)
    sizes = counts.groupBy(step.alias("step")).agg(F.count("*").alias("words"), F.min("n").alias("least"))
    for row in sizes.orderBy(F.desc("step")).collect():
        found += row["words"]
        if found > KNOWN:
            break
        least = row["least"]
    top = counts.orderBy(F.desc("n"), "word").limit(FREQUENT).collect()
    known = {bytes(w): n for w, n in top}
    more = counts.filter(F.col("n") >= least).collect() if least else []
    known.update(sorted(((bytes(w), n) for w, n in more), key=lambda r: (-r[1], r[0])))
    return list(known.items()), least


def _coded(docs: DataFrame, counts: DataFrame, known: list) -> DataFrame:
    """Per row of ``docs``, staged: row, doc_id, symbols (a byte a word), share and rest as Symbols has them."""
    totals = np.zeros(SHARED, np.int64)
    for bucket, n in counts.groupBy((F.crc32("word") % SHARED).cast("int")).agg(F.sum("n")).collect():
        totals[bucket] = n
    for word, n in known[:FREQUENT]:
        totals[zlib.crc32(word) % SHARED] -= n
    shared = docs.sparkSession.sparkContext.broadcast((known, totals))

    def code(batches):
        symbols = Symbols(*shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, _SLICE):
                part = batch.slice(at, _SLICE)
                rows = [symbols.of(t) for t in part.column(1).to_pylist()]
                kinds = pa.binary(), pa.float64(), pa.list_(pa.binary())
                arrays = [part.column(0), *(pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds))]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "symbols", "share", "rest"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    coded = rows.mapInArrow(code, "doc_id bigint, symbols binary, share double, rest array<binary>")
    return stage(coded.withColumn("row", F.monotonically_increasing_id()), "coded")[0]


def first_target(words: int, stride: int, turn: int, rounds: int) -> int:
    """Where the targets of a document begin: with as many rounds as the stride, every word is one once."""
    return (words + turn * stride // rounds) % stride


def _averaged(coded: DataFrame, weights: np.ndarray, stride: int, turn: int, rounds: int) -> np.ndarray:
    """The mean of the networks that the tasks trained, by their numbers of targets."""
    shared = coded.sparkSession.sparkContext.broadcast(weights)

    def fit(batches):
        trainer = Trainer(Network(shared.value), stride)
        for batch in batches:
            for row in batch.column(0):
                own = np.frombuffer(row.as_buffer(), np.uint8)
                trainer.add(own, first_target(len(own), stride, turn, rounds))
        trainer.flush()
        if trainer.targets:
            flat = trainer.network.flat.astype(float) * trainer.targets
            arrays = [pa.array(np.arange(len(flat))), pa.array(flat), pa.array(np.full(len(flat), trainer.targets))]
            yield pa.RecordBatch.from_arrays(arrays, ["place", "weight", "targets"])

    sums = coded.select("symbols").mapInArrow(fit, "place bigint, weight double, targets bigint").groupBy("place").agg(
        (F.sum("weight") / F.sum("targets")).alias("weight")
    )
    rows = sums.orderBy("place").toPandas()  # one row per weight of the network
    return rows["weight"].to_numpy() if len(rows) else weights


def _scored(coded: DataFrame, stride: int, rounds: int) -> DataFrame:
    """Per row of ``coded``: row, doc_id, share, n_tokens and log_prob, the sum over its symbols."""
    weights = Network().flat
    for turn in range(rounds):
        weights = _averaged(coded, weights, stride, turn, rounds)
    shared = coded.sparkSession.sparkContext.broadcast(np.asarray(weights, np.float32))

    def score(batches):
        network = Network(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, _SLICE):
                part = batch.slice(at, _SLICE)
                texts = [np.frombuffer(row.as_buffer(), np.uint8) for row in part.column(3)]
                around, target, owner = windows(texts)
                sums = np.bincount(owner, network.log_probabilities(around, target), len(texts)).astype(float)  # int if empty
                sizes = np.array([len(t) for t in texts])
                arrays = [*(part.column(k) for k in range(3)), pa.array(sizes, pa.int64()), pa.array(sums)]
                yield pa.RecordBatch.from_arrays(arrays, ["row", "doc_id", "share", "n_tokens", "log_prob"])

    kinds = "row bigint, doc_id bigint, share double, n_tokens bigint, log_prob double"
    return coded.select("row", "doc_id", "share", "symbols").mapInArrow(score, kinds)


def _result(rows: DataFrame, log_prob) -> DataFrame:
    rows = rows.select("doc_id", "n_tokens", log_prob.alias("log_prob"))
    mean = F.when(F.col("n_tokens") > 0, F.col("log_prob") / F.col("n_tokens"))
    return rows.withColumn("mean_log_prob", mean)


def scores(docs: DataFrame, stride: int = STRIDE, rounds: int = ROUNDS) -> DataFrame:
    """What word_scores returns, but with the log-probabilities of the words' symbols only."""
    counts, path = stage(word_counts(docs), "words")
    coded = _coded(docs, counts, _known(counts)[0])
    discard(docs.sparkSession, path)
    return _result(_scored(coded, stride, rounds), F.col("log_prob"))


def word_scores(docs: DataFrame, stride: int = STRIDE, rounds: int = ROUNDS) -> DataFrame:
    """Per row: doc_id, n_tokens, log_prob (sum over all words) and mean_log_prob (null without words).

    Reads ``doc_id`` and ``text``. A null, empty or wordless text has no tokens and log_prob 0. Repeated
    rows score alike; an empty table gives an empty result. Texts of any length count whole.
    """
    counts = stage(word_counts(docs), "words")[0]
    known, least = _known(counts)
    coded = _coded(docs, counts, known)
    scored = _scored(coded, stride, rounds)
    rare = counts.filter(F.col("n") > 1)  # the log of one is nothing
    rare = rare.filter(F.col("n") < least) if least else rare
    rest = coded.select("row", F.explode("rest").alias("word")).join(rare, "word")
    rest = rest.groupBy("row").agg(F.sum(F.log("n")).alias("counted"))
    total = F.col("log_prob") + F.col("share") + F.coalesce("counted", F.lit(0.0))
    return _result(scored.join(rest, "row", "left"), total)
