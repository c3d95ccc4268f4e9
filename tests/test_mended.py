"""Paths that once lost or changed rows."""

import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from barwright.operators import quality, silver
from barwright.plans import medallion
from barwright.session import shared_folder
from barwright.sources import bars, layers
from conftest import D2, D3, RAW_ROWS

WINDOW = {"start": date(2000, 1, 1), "end": date(2100, 1, 1)}


def test_position_takes_whole_keys_prices_and_quantities(spark, tmp_path):
    day = datetime(2024, 1, 2)
    items = [
        (5, 1, 10.0, 1.0, day), ((1 << 20) + 1, 1, 20.0, 1.0, day),  # equal in their low 20 bits
        (7, 2, 2.0**37, 1.0, day), (8, 2, 1.0, 1.0, day),  # dear before cheap
        (9, 3, 900.0, 90.0, day), (9, 3, 900.0, 100.0, day),  # quantities above 63
        (2**62, 4, 5.0, 1.0, day), (2**62 + 1, 4, 6.0, 1.0, day),
    ]
    spark.createDataFrame(
        items, "l_orderkey bigint, l_partkey bigint, l_extendedprice double, l_quantity double, l_shipdate timestamp"
    ).write.parquet(str(tmp_path / "lineitem.parquet"))
    df = bars.bars_from_lineitem(spark, str(tmp_path), by="part")
    assert {r.ticker: (r.open, r.close) for r in df.collect()} == {
        "P1": (10.0, 20.0), "P2": (2.0**37, 1.0), "P3": (10.0, 9.0), "P4": (5.0, 6.0)
    }
    plan = df._jdf.queryExecution().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_load_of_some_tickers_keeps_the_others(spark, raw_df, tmp_path):
    root = str(tmp_path)
    for ticker in ("PETR4.SA", " vale3.sa ", "ITUB4.SA", "PETR4.SA"):
        assert medallion.load_bronze(raw_df, root, tickers=[ticker], **WINDOW).rows > 0
    assert sorted(map(tuple, layers.read_bronze(spark, root).drop("source", "ingested_at").collect())) == sorted(RAW_ROWS)


def test_corrected_date_goes_from_all_layers(spark, raw_df, tmp_path):
    root = str(tmp_path)
    medallion.load_bronze(raw_df, root, **WINDOW)
    assert medallion.build_silver(spark, root) == 5
    bad = raw_df.where(F.col("trade_date") == D3).withColumn("close", F.lit(-1.0))
    medallion.load_bronze(bad, root, **WINDOW)
    assert medallion.build_silver(spark, root, trade_date=D3) == 0
    assert {r.trade_date for r in layers.read_silver(spark, root).collect()} == {D2}
    rejected = layers.read_rejected(spark, root).collect()
    assert len(rejected) == 2 and {tuple(r.reject_reasons) for r in rejected} == {("not positive close_price",)}


def test_nan_prices(spark, make_raw, tmp_path):
    """A price that is no number is a bad record: it is rejected, and ends no load."""
    nan = float("nan")
    rows = [("A", D2, 1.0, 1.0, 1.0, 2.0, nan, 5), ("A", D2, 1.0, 1.0, 1.0, 2.0, 3.0, 5), ("A", D3, 1.0, nan, 1.0, 1.0, 1.0, 5)]
    raw = make_raw(rows)
    clean = silver.transform_silver(raw, datetime(2024, 1, 4))
    assert [(r.trade_date, r.adj_close) for r in clean.collect()] == [(D2, 3.0)]
    assert quality.quality_report(silver.cast_types(raw), date(2024, 1, 5)).first().nan_prices == 1
    with pytest.raises(quality.QualityError, match="nan_prices"):
        quality.require_quality(silver.cast_types(raw), date(2024, 1, 5))
    medallion.load_bronze(raw, str(tmp_path))
    assert medallion.build_silver(spark, str(tmp_path)) == 1
    (rejected,) = layers.read_rejected(spark, str(tmp_path)).collect()
    assert rejected.trade_date == D3 and rejected.reject_reasons == ["no number high_price"]


def test_no_staged_table_outlives_the_jobs(spark, raw_df, tmp_path):
    folder = shared_folder(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    medallion.run_all(spark, raw_df, str(tmp_path), **WINDOW)
    medallion.load_bronze(raw_df, str(tmp_path), tickers=["PETR4.SA"], **WINDOW)
    medallion.build_silver(spark, str(tmp_path), trade_date=D2)
    with pytest.raises(quality.QualityError):
        medallion.build_silver(spark, str(tmp_path), as_of=date(2023, 1, 1))
    assert set(os.listdir(folder)) == before
    assert not [p for p in tmp_path.rglob("_pending-*")]
