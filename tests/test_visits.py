"""Two visits with different configurations give what each gives alone."""

from pyspark.sql import functions as F

from fiberqa.plans import extraction, fluxcal, norms, overlap, sky


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


def test_flux_table_takes_the_stars_of_each_visit(spark):
    bands = ", ".join(f"{1.0 + i}D * visit AS flux_{b}" for i, b in enumerate("grizy"))
    fibers = spark.sql(
        f"""SELECT visit, fiberId, 1 AS spectrograph, 100 * visit + fiberId AS objId, 1 AS catId, 0D AS ra, 0D AS dec, 0D AS xFocal, 0D AS yFocal,
        IF(visit = 1 OR fiberId = 7, 'FLUXSTD', 'SKY') AS targetType, {bands} FROM VALUES (1, 7), (1, 8), (2, 7), (2, 8) AS t(visit, fiberId)"""
    )
    spectra = spark.sql(
        """SELECT visit, fiberId, 500D + 10D * pix AS wavelength, 1D * pix * visit AS flux, 0 AS mask
        FROM VALUES (1, 7), (1, 8), (2, 7), (2, 8) AS t(visit, fiberId) LATERAL VIEW explode(sequence(1, 40)) AS pix"""
    )
    filters = spark.sql("SELECT name AS filter_name, 400D + 100D * k AS wavelength, 1D AS transmission FROM (SELECT explode(array('g', 'r', 'i', 'z', 'y')) AS name) LATERAL VIEW explode(sequence(0, 6)) AS k")
    both = rows_of(fluxcal.flux_table(fibers, spectra, filters))
    alone = [rows_of(fluxcal.flux_table(fibers.where(F.col("visit") == v), spectra.where(F.col("visit") == v), filters)) for v in (1, 2)]
    assert len(both) == 3 and both == sorted(alone[0] + alone[1], key=repr)


def test_sky_and_norms_take_the_fibers_of_each_visit(spark):
    fibers = spark.createDataFrame(
        [(1, 1, "SKY", "GOOD"), (1, 2, "SKY", "GOOD"), (1, 3, "SKY", "BAD"), (2, 2, "SKY", "GOOD"), (2, 3, "SKY", "GOOD")],
        "visit int, fiberId int, targetType string, fiberStatus string",
    )
    spectra = spark.createDataFrame([(v, "r", 1, f, 0, float(f), float(f)) for v in (1, 2) for f in (1, 2, 3)], "visit int, arm string, spectrograph int, fiberId int, pix int, flux double, wavelength double")
    got = {(r["visit"], r["fiberId"]) for r in sky.subtract_others(spectra, fibers).collect()}
    assert got == {(1, 1), (1, 2), (1, 3), (2, 2), (2, 3)}
    kept = norms.clean_norms(spectra.withColumn("values", F.col("flux")), fibers)
    assert {(r["visit"], r["fiberId"]) for r in kept.collect()} == {(1, 1), (1, 2), (2, 2), (2, 3)}


def test_every_job_has_every_fiber(spark):
    fibers = spark.createDataFrame([(1, "A-1"), (2, "A-1"), (3, "B-2")], "fiberId int, mtp_A string")
    sigma = spark.createDataFrame([(10, "r", 1, 1, 0.1, 0.2), (11, "r", 1, 2, 0.3, 0.4)], "visit int, arm string, spectrograph int, fiberId int, sigma double, sigma_std double")
    table = norms.fiber_table(sigma, fibers).collect()
    assert sorted((r["visit"], r["fiberId"], r["SM"]) for r in table) == [(10, 1, 1), (10, 2, 0), (10, 3, 0), (11, 1, 0), (11, 2, 1), (11, 3, 0)]


def test_overlap_statistics_of_each_visit(spark):
    pairs = spark.createDataFrame([(v, s, f, 630.2, 0.1 * v + f) for v in (1, 2) for s in (1, 2) for f in (1, 2, 3)], "visit int, spectrograph int, fiberId int, wavelength double, difference double")
    both = rows_of(overlap.overlap_stats(pairs))
    alone = [r for v in (1, 2) for r in rows_of(overlap.overlap_stats(pairs.where(F.col("visit") == v)))]
    assert len(both) == 4 and both == sorted(alone, key=repr)


def test_masked_spike_changes_no_other_fiber(spark):
    fibers = spark.createDataFrame([(f, "SKY") for f in range(1, 6)], "fiberId int, targetType string")
    for how in ("median", "mean"):
        seen = []
        for spike in (7.0, 1e6):
            rows = [(1, "r", 1, f, p, spike if (f, p) == (3, 0) else float(f * f + p), int((f, p) == (3, 0))) for f in range(1, 6) for p in (0, 1)]
            spectra = spark.createDataFrame(rows, "visit int, arm string, spectrograph int, fiberId int, pix int, flux double, mask int")
            got = {(r["fiberId"], r["pix"]): (r["skyModel"], r["residual"]) for r in sky.subtract_others(spectra, fibers, how=how).collect()}
            assert len(got) == 10 and got[3, 0] == (11.5 if how == "mean" else 10.0, spike - got[3, 0][0])
            seen.append({k: x for k, x in got.items() if k != (3, 0)})
        assert seen[0] == seen[1]


def test_calibration_and_places_of_each_visit(spark):
    pairs = spark.createDataFrame([(v, 1, 7, 630.2, 5.0, 15.0) for v in (1, 2)], "visit int, spectrograph int, fiberId int, wavelength double, y0 double, y1 double")
    knots = [(v, a, 1, 7, 10 * k, 600.0 + v + 10 * k * s) for v in (1, 2) for a, s in (("b", 1.0), ("r", 2.0)) for k in (0, 1, 2)]
    calibration = spark.createDataFrame(knots, "visit int, arm string, spectrograph int, fiberId int, row int, wavelength double")
    found = {r["visit"]: (r["w0"], r["w1"]) for r in overlap.wavelength_at_row(pairs, calibration, ("b", "r")).collect()}
    assert found == {v: (605.0 + v, 630.0 + v) for v in (1, 2)}

    stats = spark.createDataFrame([(v, 7, x) for v, x in ((1, -9.0), (2, 0.5))], "visit int, fiberId int, chiMed double")
    places = spark.createDataFrame([(1, 7, 0.1, 0.2), (2, 7, 0.3, 0.4)], "visit int, fiberId int, xFocal double, yFocal double")
    shown = {r["visit"]: (r["xFocal"], r["rangeClass"], r["shown"]) for r in extraction.on_focal_plane(stats, places, "chiMed", -5.0, 5.0).collect()}
    assert shown == {1: (0.1, "under", -5.0), 2: (0.3, "inside", 0.5)}
