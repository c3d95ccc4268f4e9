from barwright.llm import langid


def test_held_out_accuracy(spark):
    """Learned from four fifths of the documents, right on the rest."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = langid.languages(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out and lang is not null")
    right, total = found.filter("lang = lang_pred").count(), found.count()
    assert total > 100 and right >= 0.98 * total
    assert found.filter("score < 0 or score > 1").count() == 0


def test_language_column_of_held_out_rows_is_not_used(documents):
    from pyspark.sql import functions as F

    changed = documents.withColumn("lang", F.when(langid.held_out(), "xx").otherwise(F.col("lang")))
    a = sorted(langid.languages(documents).collect())
    assert sorted(langid.languages(changed).collect()) == a


def test_messy_rows(messy, empty):
    rows = langid.languages(messy).collect()
    assert len(rows) == messy.count()
    assert {r["lang_pred"] for r in rows if r["doc_id"] in (1, 2, 3)} == {langid.UNKNOWN}
    assert {r["score"] for r in rows if r["doc_id"] in (1, 2, 3)} == {0.0}
    assert not any(r["held_out"] for r in rows if r["doc_id"] is None)
    assert langid.languages(empty).collect() == []
    left = langid.with_known_language(messy)
    assert left.columns == messy.columns and left.filter("doc_id in (1, 2, 3)").count() == 0
    assert left.filter("doc_id = 4").first()["text"] == messy.filter("doc_id = 4").first()["text"]


def test_nothing_labelled(messy):
    from pyspark.sql import functions as F

    rows = langid.languages(messy.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r["lang_pred"], r["score"]) for r in rows} == {(langid.UNKNOWN, 0.0)}


def test_ngrams_of_a_batch_are_those_of_its_texts():
    letters = langid.letter_table()

    def counted(texts):
        found = {}
        for rows, buckets in langid.grams(texts, letters, 1 << 30):
            for row, bucket in zip(rows.tolist(), buckets.tolist()):
                found.setdefault(row, []).append(bucket)
        return {row: sorted(b) for row, b in found.items()}

    texts = ["ab c", None, "", "12", "é日本 x", "ab c"]
    alone = {k: v for k, t in enumerate(texts) for v in counted([t]).values()}
    assert counted(texts) == alone and set(alone) == {0, 4, 5}
    # _ab_c_: 3 letters, 5 pairs, 3 triples
    assert len(alone[0]) == 11
