"""Exact quartiles by narrowing, and checks kept per date."""

import math
import random
from datetime import date

import pytest
from conftest import D2, D3
from pyspark.sql import functions as F

from barwright.operators import profile, quality
from barwright.plans import medallion
from barwright.sources import layers


def expected(values, share):
    own = sorted(v for v in values if v is not None and math.isfinite(v))
    return own[max(1, math.ceil(share * len(own))) - 1] if own else None


def columns(seed):
    draw = random.Random(seed)
    n = 3000
    return {
        "even": [float(k) for k in range(n)],
        "heavy": [draw.paretovariate(0.1) for _ in range(n)],
        "tied": [draw.choice([1.0, 2.0, 2.0, 2.0]) for _ in range(n)],
        "wide": [draw.choice([-1, 1]) * 10 ** draw.uniform(-300, 300) for _ in range(n)],
        "edges": [draw.choice([-1.7e308, 1.7e308, 0.0, 5e-324]) for _ in range(n)],
        "holes": [draw.choice([None, float("nan"), float("inf"), draw.random()]) for _ in range(n)],
        "none": [None] * n,
        "one": [7.5] * n,
    }


@pytest.mark.parametrize("few", [0, 10, 1000])
@pytest.mark.parametrize("ranges", [16, 1024])
def test_quantiles_by_brute_force(spark, monkeypatch, few, ranges):
    monkeypatch.setattr(profile, "FEW", few)
    monkeypatch.setattr(profile, "RANGES", ranges)
    data = columns(few + ranges)
    rows = list(zip(*data.values()))
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in data)).repartition(4)
    shares = (0.0, 0.25, 0.5, 0.75, 1.0)
    found = profile.exact_quantiles(df, list(data), shares)
    assert found == {c: [expected(v, s) for s in shares] for c, v in data.items()}


def test_passes_are_few(spark, monkeypatch):
    """A large column needs no more than three passes before its values are few."""
    asked, ranges = [], profile._ranges
    monkeypatch.setattr(profile, "_ranges", lambda df, searched: (asked.append(len(searched)), ranges(df, searched))[1])
    df = spark.range(300_000).select(F.exp(F.randn(5) * 3).alias("x"))
    profile.exact_quantiles(df, ["x"])
    assert len(asked) <= 3


def test_exact_describe_has_the_columns_of_the_sketched_one(spark, raw_df):
    exact, sketched = profile.describe(raw_df, exact=True), profile.describe(raw_df)
    assert exact.schema.simpleString() == sketched.schema.simpleString()
    assert {r["column"]: r["q50"] for r in exact.collect()}["close"] == 32.5
    assert profile.describe(raw_df.limit(0), exact=True).first()["q50"] is None


def same_report(spark, root, as_of):
    scanned = quality.quality_report(layers.read_silver(spark, root), as_of).first().asDict()
    kept = quality.report_of_ledger(layers.read_ledger(spark, root), as_of).first().asDict()
    assert kept == scanned
    return kept


def test_ledger_equals_a_scan_after_corrections_and_removals(spark, raw_df, tmp_path):
    root, as_of = str(tmp_path), date(2024, 1, 5)
    medallion.load_bronze(raw_df, root)
    medallion.build_silver(spark, root)
    assert same_report(spark, root, as_of)["n_rows"] == 5
    assert same_report(spark, root, D2)["future_dates"] == 2
    bad = raw_df.where(F.col("trade_date") == D3).withColumn("close", F.when(F.col("ticker") == "VALE3.SA", -1.0).otherwise(5.0))
    medallion.load_bronze(bad, root)
    medallion.build_silver(spark, root, trade_date=D3)
    assert same_report(spark, root, as_of)["n_rows"] == 4
    medallion.load_bronze(bad.withColumn("close", F.lit(-1.0)), root)
    medallion.build_silver(spark, root, since=D3)
    report = same_report(spark, root, as_of)
    assert report["n_rows"] == 3 and report["last_date"] == D2 and report["passed"]


def test_ledger_of_unsound_bars(spark, make_raw):
    from barwright.operators import silver

    nan = float("nan")
    rows = [("A", D2, 1.0, -1.0, 1.0, nan, 1.0, 5), ("A", D2, 1.0, 1.0, 1.0, None, 1.0, None), (None, D3, 0.0, 1.0, 1.0, 1.0, 1.0, 5)]
    typed = silver.cast_types(make_raw(rows))
    kept = quality.report_of_ledger(quality.ledger(typed), D2).first().asDict()
    assert kept == quality.quality_report(typed, D2).first().asDict() and not kept["passed"]
