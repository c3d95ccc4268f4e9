"""Every stage against a plain version of it, on its own input."""

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from barwright.llm import common
from .test_decontam import brute as overlap
from .test_minhash import brute as near


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    """The input of each stage and the result of the last, by name."""
    docs = common.table(spark, sf_dir, "documents")
    found = {}
    for name, step in pipeline.STAGES:
        found[name] = docs
        docs, _ = common.stage(step(spark, docs, sf_dir), name)
    return found | {"result": docs}


def rows(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_names_and_columns(tables):
    assert list(tables)[:-1] == ["language_id", "line_dedup", "near_dedup", "decontamination", "tokenization"]
    for name in list(tables)[:-1]:
        assert tables[name].columns == tables["language_id"].columns


def test_language_id_keeps_what_has_a_language(tables):
    before, after = rows(tables["language_id"]), rows(tables["line_dedup"])
    assert all(after[i] == before[i] for i in after)
    assert all(not any(c.isalpha() for c in before[i]["text"] or "") for i in set(before) - set(after))


def test_no_line_comes_twice(tables):
    before, after = rows(tables["line_dedup"]), rows(tables["near_dedup"])
    words = lambda line: tuple(common_words(line))
    seen = set()
    for i in sorted(after):
        own = after[i]["text"].split("\n")
        assert set(own) <= set(before[i]["text"].split("\n")) and after[i]["n_chars"] == len(after[i]["text"])
        for line in own:
            assert not words(line) or words(line) not in seen
            seen.add(words(line))
    first = {words(line) for r in before.values() for line in r["text"].split("\n")} - {()}
    assert all(len(w) >= 8 for w in first - seen)  # short lines go only if they stay elsewhere


def common_words(text):
    from .test_decontam import words_of

    return words_of(text)


def test_one_of_each_near_group_stays(tables):
    before, after = rows(tables["near_dedup"]), rows(tables["decontamination"])
    groups = near({i: r["text"] for i, r in before.items()}, 5)
    assert set(after) == {i for i, component in groups.items() if i == component}
    assert all(after[i] == before[i] for i in after)


def test_contaminated_documents_go(spark, tables, sf_dir):
    items = [(r["item_id"], r["text"]) for r in common.table(spark, sf_dir, "benchmark").collect()]
    before, after = rows(tables["decontamination"]), rows(tables["tokenization"])
    assert set(after) == {i for i, r in before.items() if not overlap(r["text"], items)[-1]}


def test_tokens(tables):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokenizer.no_truncation()
    before, after = rows(tables["tokenization"]), rows(tables["result"])
    assert set(before) == set(after)
    for i, r in after.items():
        assert r["ids"] == tokenizer.encode(before[i]["text"], add_special_tokens=False).ids


def test_run_gives_the_stages_result(spark, sf_dir, tables):
    got = pipeline.run(spark, sf_dir)
    assert sorted(got.collect()) == sorted(tables["result"].collect())
