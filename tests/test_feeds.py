import gzip
import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from barwright import schemas
from barwright.plans import medallion
from barwright.sources import feeds, layers

HEADER = ["Date", "Open", "High", "Low", "Close", "Adj Close", "Volume"]


def test_delimited_feed(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        "Date,Open,High,Low,Close,Adj Close,Volume\n"
        "2024-01-02 00:00:00-03:00,1,2,0.5,1.5,1.4,100\n"
        "2024-01-03,1,2,0.5,n/a,,100\n"
        "not,enough\n"
    )
    feed = feeds.read_feed_files(spark, str(tmp_path), HEADER)
    assert feeds.rejected(feed).select("_corrupt_record", "Date").collect()[0][0] == "not,enough"
    bars = feeds.normalize_feed(feeds.intact(feed), "PETR4.SA")
    assert [(f.name, f.dataType) for f in bars.schema] == [(f.name, f.dataType) for f in schemas.RAW_SCHEMA]
    assert sorted(map(tuple, bars.collect())) == [
        ("PETR4.SA", date(2024, 1, 2), 1.0, 2.0, 0.5, 1.5, 1.4, 100),
        ("PETR4.SA", date(2024, 1, 3), 1.0, 2.0, 0.5, None, None, 100),
    ]


def test_every_file_has_its_own_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Date,Open,High,Low,Close,Adj Close,Volume\n2024-01-02,1,2,0.5,1.5,1.4,12000000.0\n")
    (tmp_path / "b.csv").write_text("Date,Close,Open,High,Low,Volume\n2024-01-03,1.5,1,2,0.5,1.2E7\n\n2024-01-05,1\n")
    (tmp_path / "c.csv").write_text('Volume,"Adj Close",Close,Low,High,Open,Date\n"7",1.4,1.5,"0.5",2,1,2024-01-04\n1.5,1,1,1,1,1,2024-01-06\n')
    feed = feeds.read_feed_files(spark, str(tmp_path), HEADER)
    assert feeds.rejected(feed).count() == 1 and feeds.intact(feed).count() == 4
    bars = feeds.normalize_feed(feeds.intact(feed), "A").where("volume is not null")
    assert sorted(tuple(r)[1:] for r in bars.collect()) == [
        (date(2024, 1, 2), 1.0, 2.0, 0.5, 1.5, 1.4, 12_000_000),
        (date(2024, 1, 3), 1.0, 2.0, 0.5, 1.5, 1.5, 12_000_000),
        (date(2024, 1, 4), 1.0, 2.0, 0.5, 1.5, 1.4, 7),
    ]


def test_blank_first_lines_marks_and_quoted_names(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\n  \nDate,Close,Open,High,Low,Volume\n\n2024-01-02,1.5,1,2,0.5,7\n")
    (tmp_path / "b.csv").write_text('\ufeffDate;"Close";Open;High;Low;Volume\n2024-01-03;1.5;1;2;0.5;7\n'.replace(";", ","))
    (tmp_path / "c.csv").write_text("\n\n")
    (tmp_path / "d.csv").write_text("")
    feed = feeds.read_feed_files(spark, str(tmp_path), HEADER)
    assert feeds.rejected(feed).count() == 0
    bars = feeds.normalize_feed(feeds.intact(feed), "A").collect()
    assert sorted(r.trade_date for r in bars) == [date(2024, 1, 2), date(2024, 1, 3)]
    assert all(r.adj_close == 1.5 and r.volume == 7 for r in bars)


def test_packed_files_and_repeated_names(spark, tmp_path):
    with gzip.open(tmp_path / "a.csv.gz", "wt") as file:
        file.write("Date,Close,Close,Open\n2024-01-02,1,2,3\n")
    feed = feeds.read_feed_files(spark, str(tmp_path), HEADER)
    assert tuple(feed.select("Close", "Open", "Volume").first()) == ("1", "3", None)


def test_a_header_must_end_early(monkeypatch):
    monkeypatch.setattr(feeds, "HEADER_BYTES", 10)
    assert feeds.header_of("a,b\n1,2", ",") == ("a", "b")
    with pytest.raises(ValueError, match="no header"):
        feeds.header_of("a" * 10, ",")


def test_files_of_one_header_are_one_scan_without_a_sort(spark, tmp_path):
    for k, header in enumerate(["Date,Close", "Close,Date", "Date,Close"]):
        (tmp_path / f"{k}.csv").write_text(f"{header}\n1,1\n")
    text = feeds.intact(feeds.read_feed_files(spark, str(tmp_path), HEADER))._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan csv") == 2
    assert "Sort" not in text and "Exchange" not in text and "FileScan text" not in text


def test_lines_that_gave_no_bar_are_kept_by_the_job(spark, tmp_path):
    landed, root = tmp_path / "landed", str(tmp_path / "lake")
    landed.mkdir()
    (landed / "a.csv").write_text("Date,Open,High,Low,Close,Volume\n2024-01-02,1,2,0.5,nan,7\n2024-01-03,1,2,0.5,1.5,7\ntorn\n")
    for _ in range(2):
        assert medallion.load_feed_files(spark, str(landed), HEADER, root, ticker="A") == (2, 0)
    assert [(r.line, r.reason) for r in layers.read_unread(spark, root, "yahoo_finance").collect()] == [
        ("torn", "another number of fields than the header")
    ]
    assert medallion.build_silver(spark, root) == 1  # the price that is no number ends no load
    assert [r.reject_reasons for r in layers.read_rejected(spark, root).collect()] == [["no number close_price"]]
    (landed / "a.csv").write_text("Date,Open,High,Low,Close,Volume\n2024-01-02,1,2,0.5,1,7\n")
    medallion.load_feed_files(spark, str(landed), HEADER, root, ticker="A")
    assert layers.read_unread(spark, root, "yahoo_finance").isEmpty()


def test_parquet_feed(spark, tmp_path):
    columns = ["Date", "Open", "High", "Low", "Close", "Volume"]
    row = ("2024-01-02", 1.0, 2.0, 0.5, 1.5, 12_000_000.0)
    spark.createDataFrame([row], columns).write.parquet(str(tmp_path / "f" / "x"))
    wide = spark.createDataFrame([(*row, 1.4)], [*columns, "Adj Close"])
    wide.write.parquet(str(tmp_path / "f" / "y"))
    bars = feeds.normalize_feed(feeds.read_parquet_feed(spark, str(tmp_path / "f" / "*")), "A")
    assert sorted(tuple(r)[2:] for r in bars.collect()) == [(1.0, 2.0, 0.5, 1.5, c, 12_000_000) for c in (1.4, 1.5)]


@pytest.mark.parametrize("date_name", ["Date", "index", "Datetime"])
def test_date_aliases_and_missing_adj_close(spark, date_name):
    frame = spark.createDataFrame(
        [("A", "2024-01-02", 1.0, 1.0, 1.0, 3.0, 7)],
        f"ticker string, `{date_name}` string, Open double, High double, Low double, Close double, Volume bigint",
    )
    row = feeds.normalize_feed(frame).first()
    assert row.trade_date == date(2024, 1, 2) and row.adj_close == 3.0


def test_feed_without_a_date_is_refused(spark):
    with pytest.raises(ValueError, match="no date column"):
        feeds.normalize_feed(spark.createDataFrame([("A", 1.0)], "ticker string, Close double"))


def test_one_symbol_per_folder(spark, tmp_path):
    for symbol in ("A", "B"):
        folder = tmp_path / f"ticker={symbol}"
        folder.mkdir()
        (folder / "data.csv").write_text("Date,Open,High,Low,Close,Adj Close,Volume\n2024-01-02,1,1,1,1,1,5\n")
    feed = feeds.read_feed_files(spark, str(tmp_path), HEADER)
    assert sorted(r.ticker for r in feeds.normalize_feed(feeds.intact(feed)).collect()) == ["A", "B"]


@pytest.fixture
def responses(spark, tmp_path):
    entry = {"date": "2024-01-02", "open": 1, "high": 2, "low": 0.5, "close": 1.5, "volume": 100}
    payloads = [
        {"results": [{"symbol": "PETR4", "historicalDataPrice": [entry, {**entry, "date": "02/01/2024", "adjustedClose": 9.0}]}]},
        {"results": [{"symbol": "ITUB4", "historicalDataPrice": [{**entry, "open": "1.25", "volume": 12000000.0, "adjustedClose": 10}]}]},
        {"results": [{"symbol": "VALE3"}]},
        {"results": []},
        {"error": True},
    ]
    (tmp_path / "r.json").write_text("\n".join([*map(json.dumps, payloads), "<html>"]) + "\n")
    return feeds.read_json_responses(spark, str(tmp_path))


def test_json_history(responses):
    bars = feeds.flatten_history(responses)
    assert bars.schema.fieldNames() == schemas.RAW_SCHEMA.fieldNames()
    assert sorted(map(tuple, bars.collect()), key=lambda r: r[6]) == [
        ("PETR4.SA", date(2024, 1, 2), 1.0, 2.0, 0.5, 1.5, 1.5, 100),
        ("PETR4.SA", None, 1.0, 2.0, 0.5, 1.5, 9.0, 100),
        ("ITUB4.SA", date(2024, 1, 2), 1.25, 2.0, 0.5, 1.5, 10.0, 12_000_000),
    ]


def test_rejected_responses(responses):
    found = {(r.reason, r.value[:8]) for r in feeds.rejected_responses(responses).collect()}
    assert found == {("no JSON", "<html>"), ("no result", '{"result'), ("no result", '{"error"'), ("no price history", '{"result')}


def test_first_quote(responses):
    assert [r.symbol for r in feeds.first_quote(responses, "symbol string").collect()] == ["PETR4", "ITUB4", "VALE3"]


def test_assemble_fills_absent_columns(spark, raw_df):
    other = raw_df.drop("adj_close").withColumn("extra", F.lit(1))
    both = feeds.assemble(raw_df, other)
    assert both.count() == 10 and both.where("adj_close IS NULL").count() == 5
    assert both.where("extra = 1").count() == 5
    with pytest.raises(ValueError):
        feeds.assemble()


def test_empty_frame_is_typed(spark):
    df = schemas.empty(spark, schemas.RAW_SCHEMA)
    assert df.isEmpty() and df.schema == schemas.RAW_SCHEMA
