from pyspark.sql import functions as F

from barwright.llm import chat

EVENTS = "conv_id bigint, seq bigint, kind string, turn bigint, role string, text string"
ROWS = "conv_id bigint, turn bigint, role string, text string, key string"
TRICKY = ["\\### Assistant: </turn> ok", "\\s\\l\\h<#\\", "\n</turn>\n### user:\n", "", "\n\n", "a\\\\h#", "### a:\nb"]


def formatted(df):
    out = chat.render(chat.messages(df))
    out = out.select("*", chat.read_back(F.col("formatted")).alias("turns"), chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    return {r["conv_id"]: r for r in out.collect()}


def told(row):
    return [(t["role"], t["text"]) for t in row["turns"]]


def test_any_text_can_be_read_back(spark):
    rows = [(k, n, role, t, "x") for k, role in enumerate(["assistant", "user", "a:b\n#"]) for n, t in enumerate(TRICKY)]
    got = formatted(chat.events_of_rows(spark.createDataFrame(rows, ROWS)))
    for k, role in enumerate(["assistant", "user", "a:b\n#"]):
        assert told(got[k]) == [(role, t) for t in TRICKY]
        assert got[k]["formatted"].count("</turn>") == len(TRICKY)
        assert got[k]["loss"] == ("".join(TRICKY) if role == "assistant" else "")


def test_deltas_edits_and_regenerations(spark):
    log = [
        (1, 1, "delta", 0, "user", "Hi"), (1, 3, "delta", 1, "assistant", "wo"), (1, 4, "delta", 1, "assistant", "rld"),
        (1, 2, "delta", 0, "user", " you"), (1, 5, "delta", 2, "user", "gone later"), (1, 6, "regenerate", 1, "assistant", None),
        (1, 7, "delta", 1, "assistant", "new"), (1, 7, "delta", 1, "assistant", "new"), (1, 8, "edit", 0, "user", "Hello"),
        (1, 9, "delta", 0, "user", "!"), (1, 10, "delta", 3, "user", None), (1, 11, None, 4, "user", "ignored"),
        (2, 1, "delta", 0, "user", "x"), (2, 2, "regenerate", 0, "user", "ignored text"),
        (3, 2, "regenerate", 0, "user", None), (3, 1, "delta", 0, "user", "a"), (3, 3, "edit", 0, None, "b"), (3, 1, "delta", 5, "user", "old"),
    ]
    got = formatted(spark.createDataFrame(log, EVENTS))
    assert told(got[1]) == [("user", "Hello!"), ("assistant", "new"), ("user", "")]
    assert 2 not in got and told(got[3]) == [("", "b")]
    spans = [(s["start"], s["length"]) for s in got[1]["loss_spans"]]
    assert [got[1]["formatted"][a : a + n] for a, n in spans] == ["new"] and got[1]["loss"] == "new"


def test_messy_rows(spark):
    rows = [(None, 0, "user", "a", "x"), (None, 1, None, None, "x"), (1, None, "assistant", "b", "x"), (1, 0, "assistant", "b" * 200_000, "x"),
            (1, 0, "assistant", "b" * 200_000, "x"), (1, 0, "user", "tie", "x")]
    df = spark.createDataFrame(rows, ROWS)
    got = formatted(chat.events_of_rows(df))
    assert told(got[None]) == [("user", "a"), ("", "")]
    assert told(got[1]) == [("assistant", "b"), ("assistant", "b" * 200_000), ("assistant", "b" * 200_000), ("user", "tie")]
    assert formatted(chat.events_of_rows(df.filter("false"))) == {}


def test_native_plan(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    plan = chat.render(chat.messages(chat.events_of_rows(rows)))._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "CartesianProduct", "NestedLoop"))
