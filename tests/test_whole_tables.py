"""Queries that count every row of the tables they are about."""

from pyspark.sql import functions as F

from checks.registry import QUERIES
from checks.views import Views

from .conftest import DATA


def test_planes_of_all_arms_and_pixels(spark):
    quartz = Views(spark, DATA).quartz
    assert QUERIES["plane_norm_all"](spark, DATA).count() == quartz.select("visit", "arm", "pix", "fiberId").distinct().count()
    assert QUERIES["plane_norm_scatter_all"](spark, DATA).count() == quartz.select("visit", "arm", "pix").distinct().count()


def test_histograms_of_all_components(spark):
    components = spark.read.parquet(f"{DATA}/embeddings.parquet").agg(F.sum(F.size("embedding"))).first()[0]
    counts = {r[0]: r[1] for r in QUERIES["profile_histograms_all"](spark, DATA).groupBy("measure").agg(F.sum("count")).collect()}
    free = [n for m, n in counts.items() if m not in ("variation", "max")]  # these two have fixed ranges
    assert len(free) == 6 and set(free) == {components // 8}
