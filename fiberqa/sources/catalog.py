"""Choosing datasets by coordinates, and lookups in the observation tables.

A catalogue has one row per dataset: ``dataset_type, instrument, visit, arm, spectrograph``,
NULL where the type lacks the dimension.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The order in which the parts of a visit are asked for its object.
ARM_ORDER = ("b", "r", "n", "m")
SPECTROGRAPH_ORDER = (1, 2, 3, 4)


def dataset_groups(
    catalog: DataFrame, types: dict[str, Sequence[str]], by: Sequence[str], multiple: Sequence[str] = ()
) -> DataFrame:
    """Coordinates ``by`` at which every type is present, with the number of datasets of each
    type (``n_<type>``) there.

    ``types`` maps a type to the dimensions it has. A type that lacks some of ``by`` matches
    all finer coordinates. ``violation`` names a type that is not in ``multiple`` but occurs
    more than once.
    """
    out = None
    for name, dims in sorted(types.items(), key=lambda t: -len([d for d in t[1] if d in by])):
        own = [d for d in by if d in dims]
        counts = (
            catalog.where(F.col("dataset_type") == name)
            .select(*by, *[d for d in dims if d not in by])
            .distinct()
            .groupBy(*own)
            .agg(F.count(F.lit(1)).alias(f"n_{name}"))
        )
        out = counts if out is None else out.join(counts, own)
    wrong = [F.when(F.col(f"n_{t}") > 1, F.lit(t)) for t in types if t not in multiple]
    return out.select(*by, *[f"n_{t}" for t in types], F.coalesce(*wrong, F.lit(None).cast("string")).alias("violation"))


def require_groups(groups: DataFrame) -> DataFrame:
    """The groups, or an error when there is none or one breaks its multiplicity."""
    if groups.isEmpty():
        raise RuntimeError("no dataset group matches the selection")
    bad = groups.where("violation IS NOT NULL").head(1)
    if bad:
        raise RuntimeError(f"more than one dataset of type {bad[0]['violation']} in a group")
    return groups


def checked_groups(groups: DataFrame) -> DataFrame:
    """The groups, as part of the plan: the job that reads them fails when there is none or one
    breaks its multiplicity. Nothing runs before that job, and only a count is made beside it.
    """
    message = F.concat(F.lit("more than one dataset in a group of type "), F.col("violation"))
    ok = F.when(F.col("violation").isNull(), F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    return groups.where(ok).unionByName(_none_or_error(groups, "no dataset group matches the selection"))


def _none_or_error(rows: DataFrame, message: str) -> DataFrame:
    """A table without rows and with the columns of ``rows``, which fails when ``rows`` is empty."""
    nothing = F.when(F.col("__n") > 0, F.lit(False)).otherwise(F.raise_error(F.lit(message)).cast("boolean"))
    blank = [F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema.fields]
    return rows.agg(F.count(F.lit(1)).alias("__n")).where(nothing).select(*blank)


def stability_inputs(
    catalog: DataFrame, types: dict[str, Sequence[str]], spectra: str = "spectra", ref_visit: int | None = None
) -> DataFrame:
    """Datasets of spectra to compare, with ``refVisit``, as one lazy plan.

    A dataset takes part when every type of ``types`` is present at its instrument, visit and
    arm, and the reference visit has the same arm and spectrograph. The reference needs no
    complete group of its own when it is given; otherwise it is the earliest visit of the
    groups. Reading the result fails when a group is broken or nothing is left.
    """
    by = ["instrument", "visit", "arm"]
    groups = checked_groups(dataset_groups(catalog, types, by, multiple=[spectra]))
    available = catalog.where(F.col("dataset_type") == spectra)
    found = with_reference(available.join(groups.select(*by), by, "left_semi"), ref_visit, available)
    return found.unionByName(_none_or_error(found, "no dataset group has reference spectra"))


def with_reference(spectra: DataFrame, ref_visit: int | None = None, available: DataFrame | None = None) -> DataFrame:
    """Datasets with the reference visit that has the same instrument, arm and spectrograph.

    The reference is ``ref_visit`` or the earliest visit. Its own datasets, and those without
    a counterpart there, are dropped. Counterparts are looked up in ``available``, which is
    ``spectra`` unless given.
    """
    place = ["instrument", "arm", "spectrograph"]
    known = spectra if available is None else available
    known = known.select(*place, "visit").distinct()
    spectra = spectra.select(*place, "visit").distinct()
    if ref_visit is None:
        first = spectra.agg(F.min("visit").alias("refVisit"))  # one row
        spectra = spectra.crossJoin(F.broadcast(first))
    else:
        spectra = spectra.withColumn("refVisit", F.lit(ref_visit))
    reference = known.withColumnRenamed("visit", "refVisit")
    return spectra.where(F.col("visit") != F.col("refVisit")).join(reference, [*place, "refVisit"], "left_semi")


def validate_groups(inputs: DataFrame, group: str = "job") -> DataFrame:
    """One row per broken rule of a job's inputs.

    ``inputs`` has a ``role`` per dataset: target, reference, config, norms. Rules: one
    instrument; one visit for target, config and norms; one arm; one reference visit; no
    spectrograph twice; the same spectrographs in target and reference.
    """
    role = F.col("role")

    def distinct(column: str, *roles: str):
        return F.count_distinct(F.when(role.isin(*roles), F.col(column)))

    per_spectrograph = inputs.where(role.isin("target", "reference")).groupBy(group, "spectrograph").agg(
        F.count(F.when(role == "target", 1)).alias("__t"), F.count(F.when(role == "reference", 1)).alias("__r")
    )
    spectrographs = per_spectrograph.groupBy(group).agg(
        F.max(F.col("__t") > 1).alias("__twice"), F.max((F.col("__t") > 0) != (F.col("__r") > 0)).alias("__differ")
    )
    facts = inputs.groupBy(group).agg(
        distinct("instrument", "target", "reference", "config", "norms").alias("__i"),
        distinct("visit", "target", "config", "norms").alias("__v"),
        distinct("arm", "target", "reference", "norms").alias("__a"),
        distinct("visit", "reference").alias("__rv"),
    )
    rules = F.array(
        F.when(F.col("__i") > 1, "instrument"),
        F.when(F.col("__v") > 1, "visit"),
        F.when(F.col("__a") > 1, "arm"),
        F.when(F.col("__rv") > 1, "reference visit"),
        F.when(F.col("__twice"), "duplicate spectrograph"),
        F.when(F.col("__differ"), "spectrograph set"),
    )
    return (
        facts.join(spectrographs, group, "left")
        .select(group, F.explode(F.array_compact(rules)).alias("violation"))
    )


def obs_info(exposures: DataFrame, telescope: DataFrame, environment: DataFrame, order: Sequence[str] = ("seq",)) -> DataFrame:
    """One row per visit that all three tables know: exposure, the first telescope status
    and the environment.
    """
    values = [c for c in telescope.columns if c != "visit" and c not in order]
    first = telescope.groupBy("visit").agg(F.min_by(F.struct(*values), F.struct(*order)).alias("__t"))
    return exposures.join(first.select("visit", "__t.*"), "visit").join(environment, "visit")


def guide_series(seeing: DataFrame, transparency: DataFrame, where: str | None = None) -> DataFrame:
    """Guide-camera exposures with both seeing and transparency, in order."""
    series = seeing.join(transparency, "agc_exposure_id")
    return (series.where(where) if where else series).orderBy("visit", "agc_exposure_id")


def first_object(headers: DataFrame) -> DataFrame:
    """Object of each visit: the first one present by spectrograph, then arm, else unknown."""
    arm = F.array_position(F.array(*[F.lit(a) for a in ARM_ORDER]), F.col("arm"))
    priority = F.struct(F.col("spectrograph"), arm)
    known = F.col("object").isNotNull() & F.col("spectrograph").isin(*SPECTROGRAPH_ORDER) & (arm > 0)
    name = F.min_by("object", F.when(known, priority))
    return headers.groupBy("visit").agg(F.coalesce(name, F.lit("unknown")).alias("object"))


def metadata(headers: DataFrame, keys: Sequence[str], names: Sequence[str], column: str = "metadata") -> DataFrame:
    """Header values of a group; all members are assumed to agree, the smallest is taken so
    that the answer repeats.
    """
    return headers.groupBy(*keys).agg(*[F.min(F.try_element_at(F.col(column), F.lit(n))).alias(n) for n in names])
