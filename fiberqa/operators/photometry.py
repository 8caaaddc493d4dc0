"""Synthetic photometry and magnitude tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import ZERO_POINT, ab_mag
from ..functions.stats import ratio
from .interpolation import lerp

BUCKET = 5.0


def filter_segments(filters: DataFrame, bucket: float = BUCKET) -> DataFrame:
    """Straight pieces of the filter curves, listed under each wavelength bucket they touch."""
    along = Window.partitionBy("filter_name").orderBy("wavelength")
    pieces = filters.select(
        "filter_name",
        F.col("wavelength").alias("__w0"),
        F.col("transmission").alias("__t0"),
        F.lead("wavelength").over(along).alias("__w1"),
        F.lead("transmission").over(along).alias("__t1"),
        F.lead("wavelength", 2).over(along).isNull().alias("__last"),
    ).where(F.col("__w1").isNotNull())
    buckets = F.sequence(F.floor(F.col("__w0") / bucket), F.floor(F.col("__w1") / bucket))
    return pieces.withColumn("__bucket", F.explode(buckets))


def synth_flux(
    spectra: DataFrame, filters: DataFrame, keys: Sequence[str], flux: str = "flux", bucket: float = BUCKET
) -> DataFrame:
    """sum(flux · T) / sum(T) per spectrum and filter, T interpolated at the spectrum's own
    pixels and zero outside the curve. Pairs without transmission are left out.
    """
    w = F.col("wavelength")
    in_piece = (w >= F.col("__w0")) & ((w < F.col("__w1")) | (F.col("__last") & (w == F.col("__w1"))))
    t = lerp(w, F.col("__w0"), F.col("__t0"), F.col("__w1"), F.col("__t1"))
    return (
        spectra.where(F.col(flux).isNotNull())
        .select(*keys, "wavelength", F.col(flux).alias("__f"))
        .withColumn("__bucket", F.floor(w / bucket))
        .join(filter_segments(filters, bucket), "__bucket")
        .where(in_piece)
        .groupBy(*keys, "filter_name")
        .agg(ratio(F.sum(F.col("__f") * t), F.sum(t)).alias("synthFlux"))
        .where(F.col("synthFlux").isNotNull())
    )


def design_flux(fibers: DataFrame, bands: Sequence[str], ids: Sequence[str], zero: float = ZERO_POINT) -> DataFrame:
    """Identity columns with ``design_flux_<band>`` and ``design_mag_<band>``."""
    return fibers.select(
        *ids,
        *[F.col(f"flux_{b}").alias(f"design_flux_{b}") for b in bands],
        *[ab_mag(f"flux_{b}", zero).alias(f"design_mag_{b}") for b in bands],
    )


def design_flux_long(fibers: DataFrame, ids: Sequence[str], fluxes: str = "psfFlux") -> DataFrame:
    """The same from a map of filter name to flux: one row per fiber and filter."""
    return fibers.select(*ids, F.explode(fluxes).alias("filter_name", "design_flux")).withColumn(
        "design_mag", ab_mag("design_flux")
    )


def magnitude_differences(table: DataFrame, bands: Sequence[str], diff_filter: str | None = "g") -> DataFrame:
    """Measured minus design magnitude per band, and colors relative to ``diff_filter``."""
    out: dict[str, Column] = {f"diff_{b}": F.col(f"single_mag_{b}") - F.col(f"design_mag_{b}") for b in bands}
    if diff_filter is not None:
        reference = F.col(f"single_mag_{diff_filter}")
        out |= {f"color_{diff_filter}_{b}": reference - F.col(f"single_mag_{b}") for b in bands}
    return table.withColumns(out)


def choose_filters(fibers: DataFrame, keys: Sequence[str] = ("visit",), names: str = "filterNames") -> DataFrame:
    """Filter system per visit, judged on the names of its first flux standard.

    All five broad bands, else three Gaia bands, else some broad bands with the i band. With
    an incomplete set the colors may be impossible (``noColor``). ``system`` is NULL when
    nothing fits.
    """
    first = fibers.where(F.col("targetType") == "FLUXSTD").groupBy(*keys).agg(F.min_by(names, "fiberId").alias("__n"))

    def having(part: str) -> Column:
        return F.size(F.filter("__n", lambda n: F.contains(n, F.lit(part))))

    def has(name: str) -> Column:
        return F.array_contains("__n", name)

    n_ps1, n_gaia = having("ps1"), having("gaia")
    full = n_ps1 == 5
    gaia = n_gaia == 3
    part = (n_ps1 > 0) & has("i_ps1")
    colors = has("g_ps1") & has("z_ps1")
    # A visit with both full sets ends up with Gaia, which is tried last.
    case = F.when(gaia, "gaia").when(full, "full").when(part, "part")
    out = first.withColumn("__case", case)
    c = F.col("__case")
    return out.select(
        *keys,
        F.when(c == "gaia", "Gaia").when(c.isNotNull(), "PS1").alias("system"),
        F.when(c == "gaia", "g_gaia").when(c.isNotNull(), "i_ps1").alias("fluxFilter"),
        F.when(c == "gaia", "bp_gaia")
        .when(c == "full", "g_ps1")
        .when(c == "part", F.when(colors, "g_ps1").otherwise("i_ps1"))
        .alias("colorFilter1"),
        F.when(c == "gaia", "rp_gaia")
        .when(c == "full", "i_ps1")
        .when(c == "part", F.when(colors, "z_ps1").otherwise("i_ps1"))
        .alias("colorFilter2"),
        F.coalesce((c == "part") & ~colors, F.lit(False)).alias("noColor"),
    )
