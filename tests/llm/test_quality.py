import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from barwright.llm import quality


@pytest.fixture(scope="module")
def labels(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def _corpus(spark, n=900):
    """Documents of two kinds in a few words of their own, with labels for all."""
    random = np.random.default_rng(3)
    words = {q: ["".join(chr(97 + c) for c in random.integers(0, 26, 6)) for _ in range(60)] for q in (0, 1)}
    shared = ["the", "and", "of", "to"]
    rows = [(i, " ".join(random.choice(words[i % 2] + shared * 10, 40)), i % 2) for i in range(n)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    return docs, spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id bigint, quality int")


def test_held_out_accuracy(spark):
    docs, labels = _corpus(spark)
    found = quality.scores(docs, labels).collect()
    assert {r["doc_id"] for r in found if r["held_out"]} == {i for i in range(900) if zlib.crc32(str(i).encode()) % 5 == 0}
    unseen = [r for r in found if r["held_out"]]
    assert np.mean([r["predicted"] == r["doc_id"] % 2 for r in unseen]) > 0.97
    assert all(r["predicted"] == (r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in found)


def test_calibrated(spark):
    """Scores near p are right in about a share p of the held-out texts."""
    docs, labels = _corpus(spark, 1500)
    wrong = F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0  # a fifth of the labels says the opposite
    noisy = labels.withColumn("quality", F.when(wrong, 1 - F.col("quality")).otherwise(F.col("quality")))
    found = quality.scores(docs, noisy).join(noisy, "doc_id").filter("held_out").toPandas()
    for side in (found[found["score"] > 0.5], found[found["score"] <= 0.5]):
        assert abs(side["score"].mean() - side["quality"].mean()) < 0.1


def test_held_out_labels_and_other_columns_change_nothing(spark):
    docs, labels = _corpus(spark, 300)
    plain = sorted(map(tuple, quality.scores(docs, labels).collect()))
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    other = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    named = docs.withColumn("quality", F.lit(1)).withColumn("score", F.lit("x")).withColumn("lang", F.lit("en"))
    assert sorted(map(tuple, quality.scores(named, other).collect())) == plain


def test_sizes_of_a_text_by_hand(spark):
    docs, labels = _corpus(spark, 300)
    trained = quality.train(docs, labels)
    pair = quality.compressors(trained["contents"])
    text = docs.first()["text"] * 200  # many blocks
    blocks = [text.encode()[i : i + quality.BLOCK] for i in range(0, len(text.encode()), quality.BLOCK)]
    bad, good = (sum(len(c.compress(b)) for b in blocks) for c in pair)
    assert quality.measure(text, pair)[0] == (bad - good) / (bad + good)
    z = (quality._terms(np.array([quality.measure(text, pair)])) - trained["model"][0]) / trained["model"][1]
    expected = 1 / (1 + np.exp(-(z @ trained["model"][2])))
    assert quality.score_texts([text], trained, pair) == pytest.approx(expected, abs=1e-12)


def test_messy_rows(spark, messy, labels):
    found = quality.scores(messy, labels).collect()
    assert len(found) == messy.count()
    by_text = {}
    for r, text in zip(found, messy.select("text").collect()):
        by_text.setdefault(text["text"] or "", set()).add(r["score"])
    assert all(len(s) == 1 for s in by_text.values())
    assert all(not r["held_out"] for r in found if r["doc_id"] is None)


def test_empty_tables(spark, messy, empty, labels, documents):
    assert quality.scores(empty, labels).count() == 0
    assert {r["score"] for r in quality.scores(messy, labels.filter("false")).collect()} == {0.5}
    one_class = labels.filter("quality = 1")
    assert all(r["predicted"] == 1 for r in quality.scores(documents, one_class).collect())


def test_labels_that_clash_are_left_out(spark, documents, labels):
    both = labels.select("doc_id", "quality").union(labels.select("doc_id", 1 - F.col("quality")))
    assert quality.labelled(documents, both).count() == 0


def test_sample_is_bounded(documents, labels):
    sizes = quality.labelled(documents, labels, sample=3).groupBy("quality").agg(F.countDistinct("doc_id").alias("n"))
    assert all(r["n"] <= 3 for r in sizes.collect())
