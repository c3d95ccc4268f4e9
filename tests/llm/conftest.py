import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, words string, mark bigint"
LONG = "word " * 30_000 + "end"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table of (doc_id, text) rows, with columns that clash with inner names."""

    def build(rows):
        full = [(i, t, "en", "src0", len(t) if t is not None else None, "k", "w", 1) for i, t in rows]
        return spark.createDataFrame(full, SCHEMA)

    return build


@pytest.fixture(scope="session")
def messy(docs_of):
    """Nulls, empty and very long texts, repeated rows, ids that are null or shared."""
    return docs_of([
        (1, None), (2, ""), (3, "  \n ...!"), (4, LONG), (5, LONG), (6, "one line here\nand another one"),
        (6, "one line here\nand another one"), (7, "Ünïcödé ß 日本語 ½ 😀 <|endoftext|>"), (None, "no id on this row"),
        (None, None), (8, "x"), (8, "quite another text of the same id"),
    ])


@pytest.fixture(scope="session")
def empty(messy):
    return messy.filter("false")


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def document_texts(documents):
    return {r["doc_id"]: r["text"] for r in documents.select("doc_id", "text").collect()}
