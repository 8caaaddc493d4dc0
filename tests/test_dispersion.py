"""Interpolated dispersion: how much of the lines moves, and frames that run on."""

from pyspark.sql import functions as F

from fiberqa.operators.interpolation import interpolate
from fiberqa.operators.lines import with_dispersion
from fiberqa.sources.frames import join_per_group

KEYS = ["arm", "spectrograph", "fiberId"]


def tables(spark):
    lines = spark.range(60).select(
        F.lit("b").alias("arm"), F.lit(1).alias("spectrograph"), (F.col("id") % 2).cast("int").alias("fiberId"),
        F.when(F.col("id") != 7, (F.col("id") % 10) * 3.0).alias("y"), F.col("id").alias("note"),
    )
    knots = spark.createDataFrame([("b", 1, f, 5.0 * r, 600.0 + r * r + f) for f in (0, 1) for r in range(6)], "arm string, spectrograph int, fiberId int, row double, wavelength double")
    return lines, knots


def test_lines_move_once(spark):
    lines, knots = tables(spark)
    out = with_dispersion(lines, knots)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    # Only one read of the lines keeps what is no place of theirs.
    assert sum("AS note" in line for line in plan.splitlines()) <= 1
    got = {r["note"]: (r["fiberId"], r["y"], r["dispersion"]) for r in out.collect()}
    assert len(got) == 59 and out.columns == [*lines.columns, "dispersion"]

    def at(row):
        row = min(max(row, 0.0), 25.0)
        lo = min(int(row // 5), 4)
        return lo * lo + (row / 5 - lo) * (2 * lo + 1)

    for _, y, d in got.values():
        assert abs(d - abs(at(y + 0.5) - at(y - 0.5))) < 1e-9
    again = {r["note"]: r["dispersion"] for r in with_dispersion(lines.where("note < 20"), knots, places=lines).collect()}
    assert again == {n: d for n, (_, _, d) in got.items() if n < 20}


def test_no_frame_starts_anew_at_each_row(spark):
    lines, knots = tables(spark)
    knots = knots.withColumn("visit", F.lit(1))
    grid = lines.where("y IS NOT NULL").select(F.lit(1).alias("visit"), *KEYS, F.col("y").alias("row"))
    for keys in (KEYS, ["visit", *KEYS]):
        out = interpolate(grid.select(*keys, "row"), knots.select(*keys, "row", "wavelength"), keys, "row", "wavelength")
        assert "unboundedfollowing" not in out._jdf.queryExecution().optimizedPlan().toString().lower()


def test_one_row_per_group_has_a_size_of_its_own(spark):
    """A short table that was made from a long one is broadcast, so that the rows stay in place."""
    rows = spark.range(3_000_000).withColumn("k", F.col("id") % 3)
    table = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    out = join_per_group(rows, table, ["k"])
    assert "__copy" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert out.where("n <> 1000000").count() == 0 and out.count() == 3_000_000
