"""Summaries of image planes: no task gathers the pixels of a detector."""

import numpy as np
from pyspark.sql import functions as F

from fiberqa.operators import ordering
from fiberqa.plans.extraction import image_summary
from fiberqa.plans.sky import residual_against_sky, sky_columns


def test_image_summary_gathers_no_detector(spark):
    rows = spark.range(400).select(
        F.lit(1000).alias("visit"), F.lit("b").alias("arm"), F.lit(1).alias("spectrograph"), F.col("id").cast("int").alias("fiberId"),
        F.lit(0).alias("y"), F.lit(0).alias("dx"), F.lit(0).alias("x"), (F.col("id") * 1.7 - 90.0).alias("image"),
        (F.col("id") * 1.5).alias("model"), (F.col("id") + 4.0).alias("variance"), F.lit(0).alias("mask"),
    )
    out = image_summary(rows)
    assert "percentile" not in out._jdf.queryExecution().optimizedPlan().toString()
    got = {r["plane"]: r for r in out.collect()}
    image = np.arange(400) * 1.7 - 90.0
    for name, p in (("q01", 1), ("q05", 5), ("median", 50), ("q99", 99)):
        assert abs(got["image"][name] - np.percentile(image, p)) < 1e-9
    assert abs(got["residual"]["mean"] - np.mean(image - np.arange(400) * 1.5)) < 1e-9


def test_ranks_count_their_values_once(spark, monkeypatch):
    """What a search for ranks reads twice is written: the rows are scanned once for it."""
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), (F.col("id") * 1.0).alias("x"))
    out = ordering.group_stats(df, ["k"], quantiles={"q": ("x", 0.5)}, bounded=False)
    # One read for the groups.
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Range (") == 1
    assert sorted(r["q"] for r in out.collect()) == [499.0, 499.5, 500.0]


def test_spectra_are_made_once_for_the_split(spark):
    rows = spark.range(600).select(
        F.lit(1000).alias("visit"), F.lit("b").alias("arm"), F.lit(1).alias("spectrograph"), (F.col("id") % 20).cast("int").alias("fiberId"),
        (500.0 + F.floor(F.col("id") / 20) * 2.0).alias("wavelength"), (F.col("id") % 11 - 5.0).alias("flux"),
        F.lit(100.0).alias("sky"), F.lit(9.0).alias("variance"), F.lit(0).alias("mask"),
    )
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    residual_against_sky(sky_columns(rows.mapInArrow(count, rows.schema)), fraction=0.3).count()
    assert made.value == 600
