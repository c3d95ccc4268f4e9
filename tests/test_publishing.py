"""Loads that lose nothing, and runs that are seen whole or not at all."""

from datetime import date, timedelta

import pytest
from conftest import D2, D3, RAW_ROWS
from pyspark.sql import functions as F

from barwright.plans import medallion
from barwright.sources import layers, versions


def bronze_rows(spark, root, **options):
    return sorted(tuple(r)[:8] for r in layers.read_bronze(spark, root, **options).collect())


def silver_rows(spark, root):
    return sorted(tuple(r) for r in layers.read_silver(spark, root).drop("processed_at").collect())


def test_two_loads_of_one_date_keep_both_tickers(spark, raw_df, tmp_path):
    root = str(tmp_path)
    medallion.load_bronze(raw_df.where("ticker = 'PETR4.SA'"), root)
    medallion.load_bronze(raw_df.where("ticker <> 'PETR4.SA'"), root)
    assert bronze_rows(spark, root) == sorted(RAW_ROWS)
    medallion.load_bronze(raw_df, root)
    assert bronze_rows(spark, root) == sorted(RAW_ROWS)


def test_a_correction_wins_however_the_ticker_is_spelt(spark, raw_df, tmp_path):
    root = str(tmp_path)
    medallion.load_bronze(raw_df, root)
    late = raw_df.where(F.col("trade_date") == D2).where("ticker = 'VALE3.SA'")
    medallion.load_bronze(late.withColumns({"ticker": F.lit(" vale3.sa"), "close": F.lit(1.0)}), root)
    rows = {r[:2]: r for r in bronze_rows(spark, root)}
    assert len(rows) == 5 and rows[(" vale3.sa", D2)][5] == 1.0
    assert rows[("VALE3.SA", D3)][5] == 67.0


def test_rows_without_a_ticker_are_kept_and_not_doubled(spark, make_raw, raw_df, tmp_path):
    root = str(tmp_path)
    nameless = [make_raw([(None, D2, 1.0, 1.0, 1.0, close, 1.0, 5)]) for close in (1.0, 2.0)]
    for df in (nameless[0], nameless[1], nameless[0]):
        layers.write_bronze(df.unionByName(raw_df), root)
    rows = layers.read_bronze(spark, root)
    assert rows.count() == 7 and rows.where("ticker is null").count() == 2


def test_compaction_changes_no_row(spark, raw_df, tmp_path):
    root, table = str(tmp_path), tmp_path / "bronze/yahoo_finance"
    for tickers in (["PETR4.SA"], ["VALE3.SA", "PETR4.SA"], ["ITUB4.SA"]):
        medallion.load_bronze(raw_df, root, tickers=tickers)
    assert layers.compact_bronze(spark, root) == 5
    assert bronze_rows(spark, root) == sorted(RAW_ROWS)
    assert len(list(table.glob("load=*/trade_date=*"))) == 2
    assert layers.compact_bronze(spark, root) == 0
    corrected = raw_df.where("ticker = 'ITUB4.SA'").withColumn("close", F.lit(2.0))
    medallion.load_bronze(corrected, root)
    assert layers.compact_bronze(spark, root) == 3  # only the date with several loads
    assert {r[5] for r in bronze_rows(spark, root) if r[0] == "ITUB4.SA"} == {2.0}
    assert len(bronze_rows(spark, root)) == 5


def test_a_load_during_compaction_stays_the_newest(spark, raw_df, tmp_path, monkeypatch):
    root = str(tmp_path)
    for close in (1.0, 2.0):
        layers.write_bronze(raw_df.withColumn("close", F.lit(close)), root)
    publish = versions.publish

    def slow(session, table, folder, name, number=None):
        if number:  # another load is published just ahead of the compacted one
            monkeypatch.setattr(versions, "publish", publish)
            layers.write_bronze(raw_df.withColumn("close", F.lit(3.0)), root)
        return publish(session, table, folder, name, number)

    monkeypatch.setattr(versions, "publish", slow)
    layers.compact_bronze(spark, root)
    assert {r[5] for r in bronze_rows(spark, root)} == {3.0} and len(bronze_rows(spark, root)) == 5


def test_compaction_waits_for_claims(spark, raw_df, tmp_path):
    root, table = str(tmp_path), layers.bronze_path(str(tmp_path))
    layers.write_bronze(raw_df, root)
    versions.mark(spark, f"{table}/_claims/0000000002")  # claimed by a load that isn't readable yet
    layers.write_bronze(raw_df, root)
    assert layers.compact_bronze(spark, root) == 0
    assert versions.unsettled(spark, table, "load", patience_seconds=0) is None


def test_claims_are_never_shared(spark, raw_df, tmp_path):
    table = f"{tmp_path}/table"
    for _ in range(3):
        folder = versions.pending(table)
        raw_df.write.parquet(folder)
        versions.publish(spark, table, folder, "load")
    assert versions.numbers(spark, table, "load") == [f"{n:010d}" for n in (1, 2, 3)]


def test_nothing_is_left_out_unless_asked_for(spark, make_raw, tmp_path):
    days = [date.today() - timedelta(days=d) for d in (0, 10, 400, 4000)]
    raw = make_raw([("A", d, 1.0, 1.0, 1.0, 1.0, 1.0, 5) for d in days])
    assert medallion.load_bronze(raw, str(tmp_path / "all")) == (4, 0)
    assert medallion.load_bronze(raw, str(tmp_path / "year"), days=365) == (1, 3)  # today is not over
    assert medallion.load_bronze(raw, str(tmp_path / "from"), start=days[2]) == (2, 2)
    assert medallion.load_bronze(raw, str(tmp_path / "none"), tickers=["B"]) == (0, 4)


def test_all_rows_rejected(spark, raw_df, tmp_path):
    root = str(tmp_path)
    medallion.load_bronze(raw_df.withColumn("low", F.lit(-1.0)).repartition(3), root)
    assert medallion.build_silver(spark, root) == 0
    assert layers.read_silver(spark, root).isEmpty() and layers.read_rejected(spark, root).count() == 5


@pytest.mark.parametrize("trade_date", [None, D3])
def test_a_run_for_one_source_leaves_the_others(spark, raw_df, tmp_path, trade_date):
    root = str(tmp_path)
    medallion.load_bronze(raw_df.where("ticker = 'PETR4.SA'"), root, "s1")
    medallion.load_bronze(raw_df.where("ticker <> 'PETR4.SA'"), root, "s2")
    medallion.build_silver(spark, root)
    before = silver_rows(spark, root)
    medallion.build_silver(spark, root, source="s1", trade_date=trade_date)
    assert silver_rows(spark, root) == before and len(before) == 5
    assert medallion.build_silver(spark, root, source="never loaded") == 0
    assert silver_rows(spark, root) == before


def test_rejects_go_once_their_row_is_corrected(spark, raw_df, tmp_path):
    root = str(tmp_path)
    bad = raw_df.withColumn("low", F.when(F.col("ticker") == "PETR4.SA", -1.0).otherwise(F.col("low")))
    medallion.load_bronze(bad, root)
    assert medallion.build_silver(spark, root) == 3
    assert {(r.ticker, r.trade_date) for r in layers.read_rejected(spark, root).collect()} == {("PETR4.SA", D2), ("PETR4.SA", D3)}
    medallion.load_bronze(raw_df.where(F.col("trade_date") == D3), root)
    medallion.build_silver(spark, root, trade_date=D3)
    assert {(r.ticker, r.trade_date) for r in layers.read_rejected(spark, root).collect()} == {("PETR4.SA", D2)}
    medallion.load_bronze(raw_df, root)
    medallion.build_silver(spark, root)
    assert layers.read_rejected(spark, root).isEmpty() and len(silver_rows(spark, root)) == 5


class Stopped(Exception):
    pass


@pytest.mark.parametrize("step", ["write", "rejects", "publish"])
@pytest.mark.parametrize("run", [{}, {"trade_date": D3}, {"since": D2}])
def test_a_failing_run_leaves_silver_whole(spark, raw_df, tmp_path, monkeypatch, step, run):
    root = str(tmp_path)
    bad = raw_df.withColumn("low", F.when(F.col("ticker") == "ITUB4.SA", -1.0).otherwise(F.col("low")))
    medallion.load_bronze(bad, root)
    medallion.build_silver(spark, root)
    before = silver_rows(spark, root), layers.read_rejected(spark, root).count()
    spoilt = raw_df.withColumn("close", F.when(F.col("ticker") == "VALE3.SA", -1.0).otherwise(9.0))
    medallion.load_bronze(spoilt, root)

    def stop(*_, **__):
        raise Stopped

    write = layers.SilverRun.write
    if step == "write":
        monkeypatch.setattr(medallion, "refuse", stop)
    elif step == "rejects":
        monkeypatch.setattr(layers.SilverRun, "write", lambda self, df, kind: write(self, df, kind) if kind == "bars" else stop())
    else:
        monkeypatch.setattr(versions, "publish", stop)
    with pytest.raises(Stopped):
        medallion.build_silver(spark, root, **run)
    assert (silver_rows(spark, root), layers.read_rejected(spark, root).count()) == before
    assert not list(tmp_path.rglob("_pending-*"))
    monkeypatch.undo()
    medallion.build_silver(spark, root)
    assert {r[0] for r in silver_rows(spark, root)} == {"PETR4.SA", "ITUB4.SA"}


def test_superseded_folders_go_but_for_the_last_run(spark, raw_df, tmp_path):
    root = str(tmp_path)
    medallion.load_bronze(raw_df, root)
    for _ in range(3):
        medallion.build_silver(spark, root)
    held = {p.parts[-3] for p in (tmp_path / "silver").glob("version=*/kind=bars/trade_date=*")}
    assert held == {"version=0000000002", "version=0000000003"} or held == {"version=0000000003"}
    assert len(silver_rows(spark, root)) == 5
