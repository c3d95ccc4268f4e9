"""Series in blocks, and gold that goes on from stored states."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from barwright.functions import blocks
from barwright.operators import analytics, gold
from barwright.plans import medallion
from barwright.sources import layers


def series(seed, tickers, days, gaps):
    draw = random.Random(seed)
    out = {}
    for t in range(tickers):
        day, points = date(2015, 1, 1), []
        for k in range(days):
            day += timedelta(days=draw.choice(gaps))
            points.append((day, draw.uniform(5, 50), draw.randint(1, 10**6), None if k == 0 or draw.random() < 0.1 else draw.uniform(-0.1, 0.1)))
        out[f"T{t}"] = points
    return out


def rows(df, *columns):
    return sorted(map(tuple, df.select("ticker", "trade_date", *columns).collect()), key=repr)


@pytest.mark.parametrize("block_days", [1, 7, 100, 5000])
@pytest.mark.parametrize("gaps", [[1], [1, 3, 40], [200]])
def test_rolling_columns_are_the_same_bits(make_series, block_days, gaps):
    silver = make_series(series(1, 3, 70, gaps))
    plain, cut = gold.daily_metrics(silver), gold.daily_metrics_by_block(silver, block_days)
    assert cut.columns == plain.columns
    same = ["close_price", "volume", "daily_return", "avg_volume_20d", "volatility_20d", "year", "month"]
    assert rows(cut, *same) == rows(plain, *same)
    for a, b in zip(rows(cut, "cum_return"), rows(plain, "cum_return")):
        assert a[:2] == b[:2] and a[2] == pytest.approx(b[2], abs=1e-9)
    for whole, by_block in (
        (analytics.bollinger_bands(silver), analytics.bollinger_bands_by_block(silver, block_days)),
        (analytics.volume_zscores(silver), analytics.volume_zscores_by_block(silver, block_days)),
    ):
        assert by_block.columns == whole.columns
        assert rows(by_block, *whole.columns[2:]) == rows(whole, *whole.columns[2:])


def test_compound_return_over_ten_blocks(make_series):
    silver = make_series(series(2, 2, 400, [1]))
    plain, cut = gold.daily_metrics(silver), gold.daily_metrics_by_block(silver, 40)
    for a, b in zip(rows(cut, "cum_return"), rows(plain, "cum_return")):
        assert a[2] == pytest.approx(b[2], rel=1e-9, abs=1e-9)


def test_one_ticker_over_many_tasks(spark, make_series):
    silver = make_series(series(3, 1, 2000, [1]))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        used = F.count("avg_volume_20d").alias("count"), F.sum("cum_return"), F.sum("volatility_20d")
        cut, whole = (
            df.withColumn("p", F.spark_partition_id()).groupBy("p").agg(*used).collect()
            for df in (gold.daily_metrics_by_block(silver, 50), gold.daily_metrics(silver))
        )
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(whole) == 1 and len(cut) > 8 and sum(r["count"] for r in cut) == 2000
    assert max(r["count"] for r in cut) < 700


def test_windows_are_over_blocks(make_series):
    plan = gold.daily_metrics_by_block(make_series(series(4, 1, 30, [1])), 10)._jdf.queryExecution().executedPlan().toString()
    for line in plan.splitlines():
        if "avg(volume" in line and "windowspecdefinition" in line:
            assert f"{blocks.BLOCK}#" in line.split("windowspecdefinition(")[1].split("trade_date")[0]


def test_overlap_brings_no_more_than_its_rows(make_series):
    silver = make_series(series(5, 2, 90, [1]))
    ahead = blocks.with_overlap(silver, 30, ["volume"], 19).where(blocks.AHEAD)
    counts = {(r["ticker"], r["_block"]): r["count"] for r in ahead.groupBy("ticker", "_block").count().collect()}
    assert max(counts.values()) == 19 and min(counts.values()) <= 19


def test_short_and_sparse_series_bring_few_rows_along(make_series):
    """Thirty rows, each in a block of its own by the calendar, are one block; of longer sparse ones, blocks get longer."""
    silver = make_series(series(7, 3, 30, [61, 90]))
    assert blocks.with_overlap(silver, 60, ["volume"]).where(blocks.AHEAD).isEmpty()
    sparse = make_series(series(8, 2, 600, [61, 90]) | {"S": series(9, 1, 25, [61])["T0"], "D": series(9, 1, 400, [1])["T0"]})
    cut = blocks.with_overlap(sparse, 60, ["volume", "daily_return"], compounded="daily_return")
    counts = cut.groupBy(*blocks.KEYS).agg(F.count_if(~F.col(blocks.AHEAD)).alias("n"), F.count_if(blocks.AHEAD).alias("ahead")).collect()
    assert sum(r["ahead"] for r in counts) < sum(r["n"] for r in counts) / 2
    assert len([r for r in counts if r["ticker"] == "T0"]) > 5 and max(r["n"] for r in counts) < 90
    plain, cut = gold.daily_metrics(sparse), gold.daily_metrics_by_block(sparse, 60)
    exact = ["avg_volume_20d", "volatility_20d"]
    assert rows(cut, *exact) == rows(plain, *exact)
    for a, b in zip(rows(cut, "cum_return"), rows(plain, "cum_return")):
        assert a[:2] == b[:2] and a[2] == pytest.approx(b[2], rel=1e-9, abs=1e-9)


@pytest.fixture
def raw(make_raw):
    draw = random.Random(6)
    found = []
    for t in ("A", "B", "C"):
        for k in range(0, 300, {"A": 1, "B": 3, "C": 45}[t]):
            close = draw.uniform(10, 20)
            found.append((t, date(2023, 1, 2) + timedelta(days=k), close, close, close, close, close, draw.randint(1, 1000)))
    return make_raw(found)


TABLES = {
    "daily_metrics": ["trade_date", "avg_volume_20d", "volatility_20d"], "monthly_returns": ["year", "month", "month_return", "month_volume"],
    "portfolio_summary": ["first_date", "last_date", "avg_daily_volume"],
}


def gold_rows(spark, root):
    found = {}
    for name, exact in TABLES.items():
        stored = layers.read_gold(spark, root, name)
        found[name] = sorted(map(tuple, stored.select("ticker", *exact).collect()), key=repr)
        rounded = {"daily_metrics": "cum_return", "portfolio_summary": "total_return"}.get(name)
        if rounded:
            found[f"{name}_{rounded}"] = sorted((r[0], r[1], round(r[2], 9)) for r in stored.select("ticker", *exact[:1], rounded).collect())
    return found


def test_extended_gold_equals_a_full_build_in_any_order(spark, raw, tmp_path):
    full, parts = str(tmp_path / "full"), str(tmp_path / "parts")
    medallion.load_bronze(raw, full)
    medallion.build_silver(spark, full)
    medallion.build_gold(spark, full)
    cuts = [date(2023, 1, 1), date(2023, 4, 10), date(2023, 6, 1), date(2023, 12, 31)]
    for k in (0, 2, 1):  # the middle comes last
        medallion.load_bronze(raw, parts, start=cuts[k], end=cuts[k + 1])
        medallion.build_silver(spark, parts, since=cuts[k] if k else None)
        medallion.extend_gold(spark, parts, cuts[k])
    assert gold_rows(spark, parts) == gold_rows(spark, full)
    states = [sorted(map(tuple, gold.month_states(layers.read_silver(spark, full)).select("ticker", "year", "month", "tail").collect()), key=repr)]
    stored = layers.read_gold(spark, parts, "series_states").select("ticker", "year", "month", "tail")
    assert sorted(map(tuple, stored.collect()), key=repr) == states[0]


def test_states_take_one_scan_and_two_shuffles(spark, make_series, tmp_path):
    make_series(series(10, 3, 200, [1, 3])).write.parquet(str(tmp_path / "silver"))
    silver = spark.read.parquet(str(tmp_path / "silver"))
    states = gold.month_states(silver)
    text = states._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and text.count("Exchange hashpartitioning") == 2 and "Join" not in text
    daily = {(r["ticker"], r["trade_date"]): r for r in gold.daily_metrics(silver).collect()}
    for r in states.collect():
        own = sorted(d for t, d in daily if t == r["ticker"] and (d.year, d.month) <= (r["year"], r["month"]))[-19:]
        assert [x["trade_date"] for x in r["tail"]] == own
        assert r["growth"] == pytest.approx(1 + daily[r["ticker"], own[-1]]["cum_return"], rel=1e-9)


def test_months_that_lost_all_bars_go(spark, raw, tmp_path):
    root = str(tmp_path)
    medallion.load_bronze(raw, root)
    medallion.build_silver(spark, root)
    medallion.extend_gold(spark, root, date(2023, 1, 1))
    june = F.month("trade_date") == 6
    medallion.load_bronze(raw.where(june).withColumn("close", F.lit(-1.0)), root)
    medallion.build_silver(spark, root, since=date(2023, 6, 1))
    rows = medallion.extend_gold(spark, root, date(2023, 6, 1))
    assert layers.read_gold(spark, root, "daily_metrics").where("month = 6").isEmpty()
    assert layers.read_gold(spark, root, "monthly_returns").where("month = 6").isEmpty()
    untouched = layers.read_gold(spark, root, "daily_metrics").where("month < 6").count()
    assert rows["daily_metrics"] + untouched == layers.read_silver(spark, root).count()


def test_extending_reads_and_writes_no_earlier_month(spark, raw, tmp_path):
    root = str(tmp_path)
    medallion.load_bronze(raw, root)
    medallion.build_silver(spark, root)
    medallion.extend_gold(spark, root, date(2023, 1, 1))
    stamp = {p: p.stat().st_mtime_ns for p in (tmp_path / "gold/daily_metrics").rglob("*.parquet")}
    medallion.extend_gold(spark, root, date(2023, 10, 5))
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "gold/daily_metrics").rglob("*.parquet")}
    old = {p for p in stamp if int(p.parent.name.split("=")[1]) < 10}
    assert all(after.get(p) == stamp[p] for p in old) and old != set(stamp)
