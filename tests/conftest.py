import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="fiberqa-test-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(params=["one exposure", "any group", "any group without broadcast"])
def size(request, spark, monkeypatch):
    """Run a test on the way for groups of one exposure and on that for groups of any size."""
    from fiberqa.operators import clipping, interpolation, ordering
    from fiberqa.sources.frames import BROADCAST_BYTES

    for module in (clipping, interpolation, ordering):
        monkeypatch.setattr(module, "one_exposure", lambda keys: request.param == "one exposure")
    if request.param == "any group without broadcast":
        spark.conf.set(BROADCAST_BYTES, "0")
    yield request.param
    spark.conf.unset(BROADCAST_BYTES)
