import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from barwright.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
ALPHABET = (
    "abcXYZ '’sSΣσςİıßäÄÖéÉ0189²½ⅣⅫ\u0301\u0308\xa0\x85\x1c\x1f\x00\u2009\u3000\u200b<|>\n\t...!!日本語😀👍🏽ﬁǅᾳ'"
)
ODD = [
    "a<|endoftext|>b", "<|startoftext|><|endoftext|>X", "<|ENDOFTEXT|>", "I'LL don't we're \r\n", "ΑΣ ΣΑΣ Σ", "e\u0301",
    "x\x1cy z\x85w q\xa0e", "", None, "A<|endoftext|>\u030a", "'sss 's", "a" * 3000,
]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def expected(library, text):
    found = library.encode(text or "", add_special_tokens=False)
    return found.ids, library.decode(found.ids, skip_special_tokens=False)


def test_any_text_equals_the_library(library):
    draw = random.Random(1)
    texts = ODD + ["".join(draw.choices(ALPHABET, k=draw.randint(0, 40))) for _ in range(1500)]
    vocabulary = bpe.Vocabulary(PATH)
    words = sorted({w for t in texts[::2] for w in vocabulary.words(t)} - set(vocabulary.special))
    lexicon = bpe.Lexicon(bpe.compile_lexicon({w: vocabulary.merge(w) for w in words}))
    encoder = bpe.Encoder(vocabulary, lexicon)
    for text in texts:
        own = vocabulary.words(text)
        encoder.learn([own])
        ids, decoded = encoder.encode(own)
        assert (list(map(int, ids.split())), decoded) == expected(library, text), repr(text)


def test_documents_equal_the_library(library, documents, document_texts):
    for r in bpe.encoded(documents, PATH, lexicon_words=500).collect():
        ids, decoded = expected(library, document_texts[r["doc_id"]])
        assert (r["ids"], r["n_tokens"], r["decoded"]) == (ids, len(ids), decoded)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


def test_lexicon_shares_suffixes_and_numbers_words():
    words = sorted(["", "a", "ab", "b", "walking", "talking", "stalking", "é"][1:], key=str.encode)
    content = bpe.compile_lexicon({w: [k, k + 1] for k, w in enumerate(words)})
    lexicon = bpe.Lexicon(content)
    assert lexicon.numbers(words).tolist() == list(range(len(words)))
    assert [lexicon.ids(k) for k in range(len(words))] == [[k, k + 1] for k in range(len(words))]
    assert lexicon.numbers(["", "c", "abc", "walkin", "zé"]).tolist() == [-1] * 5
    assert len(lexicon.keys) < sum(len(w.encode()) + 1 for w in words) - 10
    assert bpe.Lexicon(bpe.compile_lexicon({})).numbers(["x"]).tolist() == [-1]


def test_messy_rows(library, messy, empty):
    rows = bpe.digests(messy, PATH).collect()
    assert len(rows) == messy.count()
    none = hashlib.sha256(b"").hexdigest()
    assert {(r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in rows if r["doc_id"] in (1, 2)} == {(0, none, none)}
    assert bpe.digests(empty, PATH).collect() == []


def test_words_merged_side_by_side(document_texts):
    vocabulary = bpe.Vocabulary(PATH)
    words = sorted({w for t in document_texts.values() for w in vocabulary.words(t)}) + ["a", "é", "x" * 60, "日本語" * 9]
    assert vocabulary.merge_all(words) == [vocabulary.merge(w) for w in words]
    assert vocabulary.merge_all([]) == []
    assert bpe.Vocabulary.of(vars(vocabulary)).merge_all(words[:50]) == vocabulary.merge_all(words[:50])
