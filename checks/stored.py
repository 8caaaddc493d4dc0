"""Queries through the sinks: results are written, read back and pruned."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from fiberqa.plans import fluxcal as X
from fiberqa.sources.frames import load, shared_folder
from fiberqa.sources.sinks import write_csv, write_json, write_table

from .flux import SN
from .registry import case


def _path(v, kind: str) -> str:
    return f"{shared_folder(v.spark)}/{kind}-{uuid.uuid4().hex}"


@case(
    "stored_lines", "S1 S2 S10", "lines",
    "SELECT visit, arm, spectrograph, count(*) AS n, sum(flux) AS flux FROM lines WHERE visit IN (1000, 1002) AND arm = 'r' GROUP BY ALL", "flux",
)
def _(v):
    path = _path(v, "lines")
    for visit in (1000, 1001, 1002, 1003):  # a later visit leaves the earlier ones
        write_table(v.lines.where(F.col("visit") == visit), path)
    rows = load(v.spark, path, "visit in (1000, 1002) and arm = 'r'")
    return rows.groupBy("visit", "arm", "spectrograph").agg(F.count(F.lit(1)).alias("n"), F.sum("flux").alias("flux"))


@case("stored_csv", "S11", "quartz", f"WITH {SN} SELECT visit, fiberId, SN FROM sn WHERE SN IS NOT NULL", "SN")
def _(v):
    path = _path(v, "sn")
    write_csv(X.fiber_sn(v.quartz), path)
    return v.spark.read.schema("visit int, fiberId int, SN double").csv(path, header=True).where(F.col("SN").isNotNull())


@case("stored_json", "S12", "quartz", f"WITH {SN} SELECT visit, count(SN) AS n, max(SN) AS best FROM sn GROUP BY visit", "best")
def _(v):
    path = _path(v, "record")
    sn = X.fiber_sn(v.quartz)
    record = sn.groupBy("visit").agg(F.count("SN").alias("n"), F.max("SN").alias("best"), F.array(F.max("fiberId")).alias("table"))
    write_json(record, path, drop=("table",))
    return v.spark.read.schema("visit int, n bigint, best double").json(path)
