"""Jobs from the catalogue and from merged spectra on small tables."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from fiberqa.plans import fluxcal, norms
from fiberqa.sources import catalog

TYPES = {"config": ("instrument", "visit"), "spectra": ("instrument", "visit", "arm", "spectrograph"), "norms": ("instrument", "visit", "arm")}
SCHEMA = "dataset_type string, instrument string, visit int, arm string, spectrograph int, run string"


def catalogue(spark, *rows):
    return spark.createDataFrame([(t, "MOS", v, a, s, r) for t, v, a, s, r in rows], SCHEMA)


def complete(visit, arm="r", spectrographs=(1, 2)):
    return [("config", visit, None, None, "x"), ("norms", visit, arm, None, "x"), *[("spectra", visit, arm, s, "x") for s in spectrographs]]


def places(df):
    return sorted((r["visit"], r["arm"], r["spectrograph"], r["refVisit"]) for r in df.collect())


def test_inputs_keep_only_spectrographs_of_the_reference(spark):
    table = catalogue(spark, *complete(1, spectrographs=(1,)), *complete(2), *complete(3))
    assert places(catalog.stability_inputs(table, TYPES)) == [(2, "r", 1, 1), (3, "r", 1, 1)]


def test_a_given_reference_needs_no_complete_group(spark):
    table = catalogue(spark, ("spectra", 9, "r", 2, "x"), *complete(2), *complete(3))
    assert places(catalog.stability_inputs(table, TYPES, ref_visit=9)) == [(2, "r", 2, 9), (3, "r", 2, 9)]


def test_the_earliest_visit_is_that_of_the_groups(spark):
    table = catalogue(spark, ("spectra", 1, "r", 1, "x"), *complete(2), *complete(3))
    assert places(catalog.stability_inputs(table, TYPES)) == [(3, "r", 1, 2), (3, "r", 2, 2)]


def test_repeated_rows_of_the_catalogue_are_one_dataset(spark):
    table = catalogue(spark, *complete(1), *complete(1), *complete(2), *complete(2))
    assert places(catalog.stability_inputs(table, TYPES)) == [(2, "r", 1, 1), (2, "r", 2, 1)]


@pytest.mark.parametrize(
    "rows, message",
    [
        # Without a group there is no reference either, and either check may be the first to fail.
        ([], "no dataset group"),
        ([("spectra", 1, "r", 1, "x")], "no dataset group"),
        (complete(1), "no dataset group has reference"),
        ([*complete(1, "r"), *complete(2, "b")], "no dataset group has reference"),
    ],
)
def test_an_empty_selection_fails_when_read_and_not_before(spark, rows, message):
    inputs = catalog.stability_inputs(catalogue(spark, *rows), TYPES)
    with pytest.raises(PySparkException, match=message):
        inputs.collect()


def test_a_broken_group_fails_when_read(spark):
    table = catalogue(spark, *complete(1), *complete(2))
    # Two runs of the norms at one place, told apart by a dimension of their own.
    doubled = table.union(catalogue(spark, ("norms", 2, "r", None, "y")))
    groups = catalog.checked_groups(
        catalog.dataset_groups(doubled, TYPES | {"norms": ("instrument", "visit", "arm", "run")}, ["instrument", "visit", "arm"], ["spectra"])
    )
    with pytest.raises(PySparkException, match="of type norms"):
        groups.collect()


def lamp(spark, visits):
    rows = [(v, "r", s, 10 * s + f, p, 700.0 + p, 100.0 + f + p + v * (f == 1), 10.0, 4.0) for v in visits for s in (1, 2) for f in range(3) for p in range(5)]
    return spark.createDataFrame(rows, "visit int, arm string, spectrograph int, fiberId int, pix int, wavelength double, flux double, norm double, variance double")


def test_job_equals_the_plain_one_and_carries_headers(spark):
    spectra = lamp(spark, (1, 2))
    fibers = spectra.select("fiberId", "spectrograph").distinct().withColumns(
        {"targetType": F.lit("SKY"), "fiberStatus": F.lit("GOOD"), "mtp_A": F.concat(F.lit("U1-0-"), F.col("fiberId").cast("string"))}
    )
    headers = spectra.select("visit", "arm", "spectrograph").distinct().withColumn("metadata", F.create_map(F.lit("HST"), F.lit("now")))
    table, record = norms.stability_job(catalogue(spark, *complete(1), *complete(2)), spectra, fibers, headers)
    plain_table, plain_record, _ = norms.stability(spectra, fibers, 1)
    assert sorted(table.collect(), key=repr) == sorted(plain_table.collect(), key=repr)
    (got,), (want,) = record.collect(), plain_record.collect()
    assert all(got[c] == want[c] for c in plain_record.columns)
    assert (got["hst"], got["insrot"], got["refVisit"]) == ("now", None, 1)


PLANES = {"BAD": 0, "SAT": 1, "CR": 3, "NO_DATA": 8, "REFLINE": 14}


def test_merged_pixels_of_accepted_standards(spark):
    fibers = spark.createDataFrame(
        [(1, "FLUXSTD", "GOOD", 0.0), (2, "FLUXSTD", "BROKENFIBER", 0.0), (3, "FLUXSTD", "GOOD", 0.06), (4, "SKY", "GOOD", 0.0), (5, "FLUXSTD", "GOOD", None)],
        "fiberId int, targetType string, fiberStatus string, xNominal double",
    ).withColumns({c: F.lit(0.0) for c in ("yNominal", "xFocal", "yFocal")})
    masks = [0, 1, 2, 8, 256, 1 << 14, 1 << 5]
    pixels = [(v, f, p, 850.0, 100.0, 0.0 if p == 6 else 2.0, 4.0, m) for v in (1, 2) for f in range(1, 6) for p, m in enumerate(masks)]
    spectra = spark.createDataFrame(pixels, "visit int, fiberId int, pix int, wavelength double, flux double, norm double, covar0 double, mask int")
    exposures = spark.createDataFrame([(1, 10.0)], "visit int, exptime double")
    out = fluxcal.merged_pixels(spectra, fibers, exposures, PLANES)
    got = sorted((r["visit"], r["fiberId"], r["pix"], r["flux"], r["counts"]) for r in out.collect() if r["flux"] is not None)
    assert got == [(1, 1, 0, 5.0, 100.0), (1, 1, 5, 5.0, 100.0)]
    assert [r["pix"] for r in out.where("flux IS NULL").collect()] == [6]
    assert [tuple(r) for r in fluxcal.merged_sn(out).collect()] == [(1, 1, 50.0)]
    assert fluxcal.merged_pixels(spectra, fibers, exposures, PLANES, bad=()).where("fiberId = 1").count() == len(masks)
    assert fluxcal.merged_pixels(spectra.limit(0), fibers, exposures, PLANES).count() == 0
