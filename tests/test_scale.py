"""Properties the plans must keep: what is shuffled, what reaches the scan, what hot keys cost."""

import os
import subprocess
import sys

import pytest
from conftest import D2, D3
from pyspark.sql import functions as F

import __spark_entry__ as contract
from barwright import session
from barwright.operators import analytics, gold, profile, quality, silver
from barwright.functions.series import by_date
from barwright.registry.base import raw_brand, silver_part
from barwright.sources import bars, layers


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return plan(df).count("Exchange hashpartitioning")


@pytest.fixture
def stored(spark, silver_df, raw_df, tmp_path):
    layers.write_bronze(raw_df, str(tmp_path))
    layers.write_silver(silver_df, str(tmp_path))
    return str(tmp_path)


def test_silver_takes_two_shuffles_and_daily_metrics_none_on_top(spark, stored):
    clean = silver.transform_silver(layers.read_bronze(spark, stored))
    assert shuffles(clean) == 2
    daily = gold.daily_metrics(clean)
    assert shuffles(daily) == 2
    assert shuffles(gold.portfolio_summary(daily)) == 2
    assert shuffles(gold.max_drawdown(daily)) == 2


def test_gold_from_stored_silver_takes_one_shuffle(spark, stored):
    stored_silver = layers.read_silver(spark, stored)
    assert shuffles(gold.daily_metrics(stored_silver)) == 1
    assert shuffles(gold.monthly_returns(stored_silver)) == 1


def test_the_gate_adds_no_shuffle_to_silver(spark, stored):
    clean = silver.transform_silver(layers.read_bronze(spark, stored))
    marked = clean.withColumn("_again", F.lag("trade_date").over(by_date()))
    assert shuffles(marked) == 2 and plan(marked).count("Sort [") == plan(clean).count("Sort [")


def test_a_heavy_day_is_written_by_several_tasks(spark, make_raw, tmp_path):
    rows = [(f"T{i}", D2, 1.0, 1.0, 1.0, 1.0 + i, 1.0, i) for i in range(30_000)]
    rows += [("A", D3, 1.0, 1.0, 1.0, 1.0, 1.0, 1)]
    frame = make_raw(rows).repartition(8)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        assert layers.write_bronze(frame, str(tmp_path)) == 30_001
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = {d: len(list((tmp_path / f"bronze/yahoo_finance/load=0000000001/trade_date={d}").glob("*.parquet"))) for d in (D2, D3)}
    assert files[D2] > 1 and files[D3] == 1


def test_copies_are_folded_before_the_shuffle(spark, raw_df):
    """One bar repeated 20,000 times reaches the shuffle as one row per map task."""
    hot = raw_df.limit(1).crossJoin(spark.range(0, 20_000, 1, 4)).drop("id")
    frame = hot.unionByName(raw_df)
    assert silver.clean_bars(frame).count() == 5
    text = plan(silver.clean_bars(frame))
    assert "partial_max" in text and "Window" not in text
    for folded in (
        silver.silver_audit(frame),
        quality.quality_report(silver.cast_types(frame)),
        profile.ticker_coverage(frame),
    ):
        assert "partial_count" in plan(folded)
    rows = {r.step: r.rows_left for r in silver.silver_audit(frame).collect()}
    assert rows["bronze_input"] == 20_005 and rows["deduplicate"] == 5


def test_scans_read_only_what_is_needed(spark, sf_dir, stored):
    text = plan(bars.bars_from_lineitem(spark, sf_dir, by="part"))
    (schema,) = [line for line in text.split("ReadSchema: ")[1:]]
    assert "l_discount" not in schema and "l_returnflag" not in schema
    one = analytics.bollinger_bands(layers.read_gold(spark, stored, "daily_metrics"), "PETR4.SA")
    gold.daily_metrics(layers.read_silver(spark, stored)).write.partitionBy("year", "month").parquet(
        layers.gold_path(stored, "daily_metrics")
    )
    one = analytics.bollinger_bands(layers.read_gold(spark, stored, "daily_metrics"), "PETR4.SA")
    text = plan(one)
    assert "EqualTo(ticker,PETR4.SA)" in text
    assert "struct<ticker:string,trade_date:date,close_price:double>" in text


def test_filters_of_cleaning_reach_the_scan(spark, stored):
    text = plan(silver.clean_bars(layers.read_bronze(spark, stored)))
    for pushed in ("GreaterThan(close,0.0)", "GreaterThan(low,0.0)", "IsNotNull(volume)"):
        assert pushed in text


@pytest.mark.parametrize("name", ["top_cumulative", "return_histogram", "monthly_heatmap", "equal_weight_backtest", "correlation_matrix", "sector_performance"])
def test_no_query_pairs_rows_without_a_key(spark, sf_dir, name):
    text = plan(contract.queries()[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_backtest_shuffles_the_returns_once(spark, stored):
    df = analytics.equal_weight_backtest(layers.read_silver(spark, stored))
    df.collect()
    assert "ReusedExchange" in plan(df)


def test_a_large_dimension_is_not_broadcast(spark, sf_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        df = bars.bars_from_lineitem(spark, sf_dir)
        assert "SortMergeJoin" in plan(df)
        expected = df.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert bars.bars_from_lineitem(spark, sf_dir).count() == expected


def test_series_hold_one_row_per_day(spark, sf_dir):
    """The bound all windows rely on."""
    for clean in (silver.clean_bars(raw_brand(spark, sf_dir)), silver_part(spark, sf_dir)):
        assert clean.count() == clean.select("ticker", "trade_date").distinct().count()


def test_shared_folder_follows_the_session(spark, monkeypatch, tmp_path):
    own = session.shared_folder(spark)
    assert own == session.shared_folder(spark) and os.path.isdir(own)

    class Conf:
        def __init__(self, values):
            self.values = values

        def get(self, key, default=None):
            return self.values.get(key, default)

    class Cluster:
        conf = Conf({"spark.checkpoint.dir": f"{tmp_path}/", "spark.master": "yarn"})

    assert session.shared_folder(Cluster) == str(tmp_path)
    Cluster.conf = Conf({"spark.master": "yarn"})
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Cluster)


def test_staged_table_cuts_the_lineage(spark, silver_df):
    kept = session.staged(silver_df, "silver")
    assert sorted(kept.collect()) == sorted(silver_df.collect())
    assert "Window" not in plan(kept) and D2 < D3
    assert kept.select(F.max("trade_date")).first()[0] == D3


def test_executors_need_no_copy_of_the_package(sf_dir, tmp_path):
    """Run from a folder where workers cannot import the package, as on a cluster."""
    script = tmp_path / "job.py"
    script.write_text(
        "import sys\n"
        f"sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})\n"
        "from barwright import registry\n"
        "from barwright.session import make_session\n"
        "spark = make_session('job', 'local[2]', **{'spark.ui.enabled': 'false'})\n"
        f"print('pairs', registry.QUERIES['correlation_matrix'](spark, {sf_dir!r}).count())\n"
    )
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, str(script)],
        cwd=tmp_path,
        env=environment,
        capture_output=True,
        text=True,
        timeout=300,
    )
    assert "pairs 625" in done.stdout, done.stderr[-2000:]
