"""BPE encoding and decoding with a word lexicon.

The corpus' most frequent words are compiled, with their ids, into a minimal acyclic transducer: states
with equal futures are shared, and every arc carries how many words lie before it, so that the sum over
a word's arcs is its number and the number gives its ids. The arcs are sorted arrays in one file, which
a task memory-maps; all words of a batch walk it side by side. Words that it lacks are merged exactly
by rank. Vocabulary and merges are read from the tokenizer file; nothing is trained.
"""

import hashlib
import io
import json
import re
import tempfile
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barwright.llm.common import by_value, discard, slices, stage

by_value(__name__)

LEXICON_WORDS = 100_000
#: Words that a task counts, and whose ids it remembers, at once; then it starts anew.
COUNTED_WORDS, CACHED_WORDS = 150_000, 300_000
_SLICE = 256
#: Words merged side by side, and the bytes of the longest of them.
_MERGED, _SHORT_WORD = 4096, 48
# what separates and what makes words, as the tokenizer file has it
_SPACE = r"\t\n\x0b\x0c\r \x85\xa0"
_WIDE_SPACE = _SPACE + r"  -     　"
_SHORT = r"'s|'t|'re|'ve|'m|'ll|'d|"
_LATIN = re.compile(rf"{_SHORT}[a-zªµºß-öø-ÿ]+|[0-9²³¹¼½¾]|[^{_SPACE}a-zªµºß-öø-ÿ0-9²³¹¼½¾]+")
_ANY = regex.compile(rf"{_SHORT}\p{{L}}+|\p{{N}}|[^{_WIDE_SPACE}\p{{L}}\p{{N}}]+")


def _byte_letters() -> list:
    """The visible character that stands for each byte: printable ones for themselves."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class Vocabulary:
    """Tokens, merge ranks and special tokens of a tokenizer file with word ends (``</w>``)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model = content["model"]
        ids, end = model["vocab"], model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        self.tokens = {i: t for t, i in [*ids.items(), *self.special.items()]}
        letters = _byte_letters()
        self.letters = [ids[x] for x in letters]
        self.last_letters = [ids[x + end] for x in letters]
        pairs = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        # two ids in one number, to the merge's rank; and what each merge makes
        self.ranks = {ids[x] << 32 | ids[y]: rank for rank, (x, y) in enumerate(pairs)}
        self.made = [ids[x + y] for x, y in pairs]
        names = sorted(map(re.escape, self.special), key=len, reverse=True)
        self.marks = re.compile("(" + "|".join(names) + ")") if names else None
        # the same merges as sorted arrays, for many words at once
        keys = np.fromiter(self.ranks, np.int64, len(self.ranks))
        order = np.argsort(keys)
        self.pairs = keys[order], np.fromiter(self.ranks.values(), np.int64, len(keys))[order]
        self.results = np.array(self.made, np.int64)

    @classmethod
    def of(cls, parts: dict) -> "Vocabulary":
        """The vocabulary with these attributes: what ``vars`` gives is plain data, and travels without this class."""
        made = cls.__new__(cls)
        vars(made).update(parts)
        return made

    def merge(self, word: str) -> list:
        """The ids of one word: the pair of lowest rank is merged, the leftmost first."""
        coded = word.encode()
        parts = [self.letters[b] for b in coded[:-1]]
        parts.append(self.last_letters[coded[-1]])
        rank, never = self.ranks.get, len(self.made)
        ranks = [rank(x << 32 | y, never) for x, y in zip(parts, parts[1:])]
        while ranks:
            best = min(ranks)
            if best == never:
                break
            at = ranks.index(best)
            made = parts[at] = self.made[best]
            del parts[at + 1], ranks[at]
            if at:
                ranks[at - 1] = rank(parts[at - 1] << 32 | made, never)
            if at < len(ranks):
                ranks[at] = rank(made << 32 | parts[at + 1], never)
        return parts

    def merge_all(self, words: list) -> list:
        """``merge`` of many words: those of a like length side by side, a merge each in every step."""
        out = [None] * len(words)
        coded = [w.encode() for w in words]
        order = sorted(range(len(words)), key=lambda k: len(coded[k]))
        for at in range(0, len(order), _MERGED):
            rows = [k for k in order[at : at + _MERGED] if 1 < len(coded[k]) <= _SHORT_WORD]
            for k in order[at : at + _MERGED]:
                if not 1 < len(coded[k]) <= _SHORT_WORD:
                    out[k] = self.merge(words[k])
            if rows:
                for k, ids in zip(rows, self._merged([coded[k] for k in rows])):
                    out[k] = ids
        return out

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys, ranks = self.pairs
        wanted = left << 32 | right
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return np.where(keys[at] == wanted, ranks[at], len(self.made))

    def _merged(self, coded: list) -> list:
        if not len(self.made):
            return [[*(self.letters[b] for b in c[:-1]), self.last_letters[c[-1]]] for c in coded]
        never, n = len(self.made), len(coded)
        sizes = np.array([len(c) for c in coded])
        wide = int(sizes.max())
        text = np.frombuffer(b"".join(c.ljust(wide, b"\0") for c in coded), np.uint8).reshape(n, wide)
        ids = np.array(self.letters, np.int64)[text]
        ids[np.arange(n), sizes - 1] = np.array(self.last_letters, np.int64)[text[np.arange(n), sizes - 1]]
        ranks = self._ranks(ids[:, :-1], ids[:, 1:])
        ranks[np.arange(wide - 1) >= sizes[:, None] - 1] = never
        out, names = [None] * n, np.arange(n)
        while len(names):
            best = ranks.argmin(axis=1)
            rank = ranks[np.arange(len(names)), best]
            done = rank == never
            if done.any():
                for k, row, size in zip(names[done].tolist(), ids[done].tolist(), sizes[done].tolist()):
                    out[k] = row[:size]
                going = ~done
                names, ids, ranks, sizes, best, rank = (x[going] for x in (names, ids, ranks, sizes, best, rank))
                if not len(names):
                    break
            rows = np.arange(len(names))
            later = np.arange(ids.shape[1] - 1)
            ids[rows, best] = self.results[rank]
            ids = np.take_along_axis(ids, later + (later > best[:, None]), 1)
            ranks = np.take_along_axis(ranks, later[:-1] + (later[:-1] >= best[:, None]), 1) if ids.shape[1] > 1 else ranks[:, :0]
            sizes = sizes - 1
            if not ranks.shape[1]:
                for k, row in zip(names.tolist(), ids.tolist()):
                    out[k] = row[:1]
                break
            before = np.flatnonzero(best > 0)
            at = best[before]
            ranks[before, at - 1] = self._ranks(ids[before, at - 1], ids[before, at])
            behind = np.flatnonzero(best < sizes - 1)
            at = best[behind]
            ranks[behind, at] = self._ranks(ids[behind, at], ids[behind, at + 1])
            last = np.flatnonzero((best >= sizes - 1) & (best < ranks.shape[1]))
            ranks[last, best[last]] = never
        return out

    def words(self, text: str | None) -> list:
        """The words of a text; a special token stands for itself."""
        if not text:
            return []
        if self.marks is None or "<" not in text:
            return _words(text)
        found = []
        for piece in self.marks.split(text):
            found += [piece] if piece in self.special else _words(piece)
        return found

    def decode(self, ids: list) -> str:
        """The text of some ids: the file names no decoder, so it is their tokens, spaced."""
        return " ".join(self.tokens[i] for i in ids)


def _words(text: str) -> list:
    try:
        text.encode("latin-1")
        pattern = _LATIN
    except UnicodeEncodeError:
        pattern = _ANY
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # lower() has a rule for final Σ
    return pattern.findall(text.lower())


class Lexicon:
    """A memory-mapped transducer from words to ids."""

    def __init__(self, content: bytes):
        with tempfile.NamedTemporaryFile() as file:
            file.write(content)
            file.flush()
            mapped = np.memmap(file.name, np.int64, "r")
        sizes = mapped[:4]
        ends = np.cumsum(sizes) + 4
        self.keys, arcs, self.offsets, self.outputs = (mapped[e - s : e] for e, s in zip(ends, sizes))
        self.targets, self.skips = arcs.reshape(2, -1)

    def numbers(self, words: list) -> np.ndarray:
        """The number of each word, or -1."""
        coded = [w.encode() for w in words]
        sizes = np.fromiter(map(len, coded), np.int64, len(coded))
        text = np.frombuffer(b"".join(coded) + b"\0", np.uint8).astype(np.int64)
        starts = np.cumsum(sizes) - sizes
        state, number = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        left = np.arange(len(words))
        done = np.full(len(words), -1)
        place = 0
        while len(left) and len(self.keys):
            ended = sizes[left] == place
            # the arc of byte 256 marks a word's end
            code = np.where(ended, 256, text[starts[left] + np.where(ended, 0, place)])
            wanted = state[left] * 257 + code
            at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
            known = self.keys[at] == wanted
            at, ended, left = at[known], ended[known], left[known]
            number[left] += self.skips[at]
            state[left] = self.targets[at]
            done[left[ended]] = number[left[ended]]
            left = left[~ended]
            place += 1
        return done

    def ids(self, number: int) -> list:
        return self.outputs[self.offsets[number] : self.offsets[number + 1]].tolist()


def compile_lexicon(entries: dict) -> bytes:
    """The transducer of ``entries`` (word to ids): its four arrays behind their sizes.

    Words are added in the order of their bytes. Once a word leaves a branch, the branch's states can't
    change any more, and each is replaced by an equal one that exists already.
    """
    coded = sorted((w.encode(), ids) for w, ids in entries.items())
    register, arcs_of = {}, []

    def frozen(arcs: dict) -> int:
        """The state with these arcs, existing or new; number 0 is the root's."""
        key = tuple(arcs.items())
        if key not in register:
            register[key] = len(arcs_of) + 1
            arcs_of.append(arcs)
        return register[key]

    path, before = [{}], b""
    for word, _ in [*coded, (b"", None)]:
        common = 0
        while common < min(len(word), len(before)) and word[common] == before[common]:
            common += 1
        for depth in range(len(before), common, -1):
            path[depth - 1][before[depth - 1]] = frozen(path.pop())
        for _ in word[common:]:
            path.append({})
        if word:
            path[-1][256] = 0  # sorts behind all bytes, but a word comes before its extensions
        before = word
    states = [path[0], *arcs_of]
    below = [0] * len(states)
    for state in range(1, len(states)):  # a state's targets were frozen before it
        below[state] = sum(1 if code == 256 else below[to] for code, to in states[state].items())
    rows = []
    for state, arcs in enumerate(states):
        skip = 1 if 256 in arcs else 0
        for code, to in sorted(arcs.items()):
            rows.append((state * 257 + code, to, 0 if code == 256 else skip))
            skip += 0 if code == 256 else below[to]
    keys, targets, skips = np.array(rows, np.int64).reshape(-1, 3).T
    outputs = np.array([i for _, ids in coded for i in ids], np.int64)
    offsets = np.cumsum([0] + [len(ids) for _, ids in coded])
    file = io.BytesIO()
    parts = [keys, np.concatenate([targets, skips]), offsets, outputs]
    for part in [np.array([len(p) for p in parts]), *parts]:
        file.write(np.ascontiguousarray(part, np.int64).tobytes())
    return file.getvalue()


class Encoder:
    """Ids and decoded texts of words, from the lexicon or by merging; remembers what it met."""

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon):
        self.vocabulary, self.lexicon = vocabulary, lexicon
        self.known = {}

    def learn(self, texts: list) -> None:
        """Make ``known`` hold every word of these lists of words."""
        if len(self.known) > CACHED_WORDS:
            self.known.clear()
        new = [w for w in set().union(*texts) if w not in self.known]
        numbers = self.lexicon.numbers(new).tolist()
        special = self.vocabulary.special
        unseen = [w for w, number in zip(new, numbers) if number < 0 and w not in special]
        merged = dict(zip(unseen, self.vocabulary.merge_all(unseen)))
        for word, number in zip(new, numbers):
            ids = [special[word]] if word in special else self.lexicon.ids(number) if number >= 0 else merged[word]
            self.known[word] = (" ".join(map(str, ids)), self.vocabulary.decode(ids))

    def encode(self, words: list) -> tuple[str, str]:
        """Ids and decoded text, both spaced. Decoding joins tokens by spaces, so it goes word by word."""
        if not words:
            return "", ""
        ids, texts = zip(*map(self.known.__getitem__, words))
        return " ".join(ids), " ".join(texts)


def frequent_words(docs: DataFrame, vocabulary: Vocabulary, most: int) -> list:
    """At most ``most`` words: the most frequent ones, counted over all texts."""

    def count(batches):
        counts = {}

        def flushed():
            arrays = [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())]
            counts.clear()
            return pa.RecordBatch.from_arrays(arrays, ["word", "n"])

        for part in slices(batches, _SLICE):
            for text in part.column(0).to_pylist():
                for word in vocabulary.words(text):
                    counts[word] = counts.get(word, 0) + 1
            if len(counts) > COUNTED_WORDS:
                yield flushed()
        yield flushed()

    counts = docs.select("text").mapInArrow(count, "word string, n bigint")
    counts, path = stage(counts.groupBy("word").agg(F.sum("n").alias("n")), "word-counts")
    # as many of the highest counts as fit, in steps of an eighth of a power of two: a few hundred rows
    step = F.floor(F.log2("n") * 8)
    sizes = counts.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect()
    least, total = None, 0
    for row in sizes:
        total += row["count"]
        if total > most:
            break
        least = row["step"]
    words = [] if least is None else counts.filter(step >= least).select("word").toPandas()["word"].tolist()
    discard(docs.sparkSession, path)
    return [w for w in words if w not in vocabulary.special]


def _encoder(spark: SparkSession, docs: DataFrame, path: str, lexicon_words: int):
    vocabulary = Vocabulary(path)
    frequent = frequent_words(docs, vocabulary, lexicon_words)
    content = compile_lexicon(dict(zip(frequent, vocabulary.merge_all(frequent))))
    # plain data: executors need not have this package
    shared = spark.sparkContext.broadcast({"vocabulary": vars(vocabulary), "lexicon": content})

    def encoder():
        """This worker's encoder: what a broadcast holds stays from task to task, so words are remembered."""
        own = shared.value
        if "encoder" not in own:
            own["encoder"] = Encoder(Vocabulary.of(own["vocabulary"]), Lexicon(own["lexicon"]))
        return own["encoder"]

    return encoder


def encoded(docs: DataFrame, path: str, lexicon_words: int = LEXICON_WORDS) -> DataFrame:
    """Per row: doc_id, ids (array), n_tokens, ids_sha256, decoded and decoded_sha256.

    Reads ``doc_id`` and ``text``. A null text counts as an empty one: no ids, an empty decoded text.
    Repeated rows come out alike, an empty table gives an empty result, and texts of any length are
    encoded whole. The ids are those of the tokenizer file at ``path`` (on the driver).
    """
    return _coded(docs, path, lexicon_words, full=True)


def digests(docs: DataFrame, path: str, lexicon_words: int = LEXICON_WORDS) -> DataFrame:
    """``encoded`` without ids and decoded texts: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return _coded(docs, path, lexicon_words, full=False)


def _coded(docs: DataFrame, path: str, lexicon_words: int, full: bool) -> DataFrame:
    make = _encoder(docs.sparkSession, docs, path, lexicon_words)

    def digest(text: str) -> str:
        return hashlib.sha256(text.encode()).hexdigest()

    def code(batches):
        encoder = make()
        for part in slices(batches, _SLICE):
            texts = [encoder.vocabulary.words(t) for t in part.column(1).to_pylist()]
            encoder.learn(texts)
            out = [[], [], []]
            ids_out, decoded_out = [], []
            for words in texts:
                ids, decoded = encoder.encode(words)
                out[0].append(ids.count(" ") + 1 if ids else 0)
                out[1].append(digest(ids))
                out[2].append(digest(decoded))
                if full:
                    ids_out.append(np.fromstring(ids, np.int32, sep=" ") if ids else [])
                    decoded_out.append(decoded)
            arrays = [part.column(0), *(pa.array(c, k) for c, k in zip(out, (pa.int64(), pa.string(), pa.string())))]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if full:
                arrays += [pa.array(ids_out, pa.list_(pa.int32())), pa.array(decoded_out, pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(arrays, names)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return rows.mapInArrow(code, schema + (", ids array<int>, decoded string" if full else ""))
