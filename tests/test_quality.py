from datetime import date, timedelta

import pytest
from conftest import D2
from pyspark.sql import functions as F

from barwright.operators import quality, silver


def test_clean_silver_passes_unchanged(silver_df):
    assert quality.require_quality(silver_df) is silver_df


def test_empty_frame_passes(silver_df):
    row = quality.quality_report(silver_df.limit(0)).first()
    assert row.passed and row.n_rows == 0 and row.last_date is None
    quality.require_quality(silver_df.limit(0))


@pytest.mark.parametrize(
    "break_it, check",
    [
        (lambda df: df.withColumn("close_price", F.lit(None).cast("double")), "null_close_price"),
        (lambda df: df.withColumn("volume", F.lit(None).cast("bigint")), "null_volume"),
        (lambda df: df.withColumn("low_price", F.lit(0.0)), "non_positive_low_price"),
        (lambda df: df.withColumn("high_price", F.lit(-1.0)), "non_positive_high_price"),
        (
            lambda df: df.withColumn("trade_date", F.lit(date.today() + timedelta(days=2))),
            "future_dates",
        ),
    ],
)
def test_each_check_fails_the_gate(silver_df, break_it, check):
    with pytest.raises(AssertionError, match=check):
        quality.require_quality(break_it(silver_df))


def test_duplicate_keys_fail_even_when_the_rows_differ(silver_df):
    copies = silver_df.unionByName(silver_df.withColumn("close_price", F.col("close_price") + 1))
    row = quality.quality_report(copies).first()
    assert row.duplicate_rows == 5
    with pytest.raises(quality.QualityError, match="duplicate_rows"):
        quality.require_quality(copies)


def test_staging_checks_in_the_same_pass(silver_df):
    stored = quality.staged_if_sound(silver_df)
    assert sorted(stored.collect()) == sorted(silver_df.collect())
    quality.staged_if_sound(silver_df.limit(0))
    for broken, check in [
        (silver_df.unionByName(silver_df.limit(2)), "'duplicate_rows': 2"),
        (silver_df.withColumn("low_price", F.lit(0.0)), "'non_positive_low_price': 5"),
        (silver_df.withColumn("trade_date", F.lit(None).cast("date")), "'null_trade_date': 5"),
    ]:
        with pytest.raises(quality.QualityError, match=check):
            quality.staged_if_sound(broken)


def test_null_prices_are_not_counted_as_non_positive(silver_df):
    row = quality.quality_report(
        silver_df.withColumn("open_price", F.lit(None).cast("double"))
    ).first()
    assert row.non_positive_open_price == 0


def test_missing_columns_are_skipped(silver_df):
    row = quality.quality_report(silver_df.drop("open_price", "volume")).first()
    assert row.passed and "null_volume" not in row.asDict()


def test_quarantine_splits_without_losing_rows(make_raw, raw_df):
    bad = [
        ("X", D2, None, 1.0, 1.0, 1.0, 1.0, 1),
        ("Y", D2, 1.0, 1.0, -1.0, 1.0, 1.0, -5),
    ]
    typed = silver.cast_types(raw_df.unionByName(make_raw(bad)))
    rejected = {r.ticker: r.reject_reasons for r in quality.quarantine(typed).collect()}
    assert rejected == {
        "X": ["missing open_price"],
        "Y": ["negative low_price", "negative volume"],
    }
    assert quality.valid_rows(typed).count() == 5
