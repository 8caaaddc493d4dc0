"""Give executors the package where it is not installed on them."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SENT: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package as a zip file, as ``--py-files`` would; once an application."""
    context = spark.sparkContext
    if context.applicationId in _SENT:
        return
    package = Path(__file__).resolve().parents[1]
    handle, path = tempfile.mkstemp(prefix=f"{package.name}-", suffix=".zip")
    os.close(handle)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(path)
    _SENT.add(context.applicationId)
