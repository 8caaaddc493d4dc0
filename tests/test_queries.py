"""Every registered query against its SQL, and the hard ones also on the large-input way."""

import os

import pytest

import __spark_entry__ as driver
from checks.compare import connect, difference
from checks.registry import ORACLES, QUERIES, ROWS
from fiberqa.operators import clipping, interpolation, ordering

from .conftest import DATA

# Positions reach the cut-outs only with more fibers than the smallest tables have.
EMPTY_WHEN_SMALL = {"cutouts"}
HARD = [
    "sigma_clip",
    "soften_fit",
    "residual_stats",
    "image_summary",
    "normalized_ratio",
    "sky_left_one_out_median",
    "reference_total",
    "brightness_ranks",
    "overlap_wavelengths",
    "visit_results",
    "split_counts",
]


@pytest.fixture(scope="module")
def con():
    return connect(DATA)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, con, name):
    answer = difference(spark, con, DATA, name)
    assert answer is None or (name in EMPTY_WHEN_SMALL and answer == "no rows")


@pytest.mark.parametrize("name", HARD)
def test_matches_sql_with_groups_of_any_size(spark, con, name, monkeypatch):
    for module in (clipping, interpolation, ordering):
        monkeypatch.setattr(module, "one_exposure", lambda keys: False)
    assert difference(spark, con, DATA, name) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    assert QUERIES[name](spark, DATA).count() > 0


def test_entry(spark):
    assert driver.entry(spark).count() > 0
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_every_inventory_row_has_a_query():
    covered = {r for rows in ROWS.values() for r in rows.split()}
    wanted = {f"{letter}{i}" for letter, n in
              {"S": 12, "P": 32, "F": 16, "J": 10, "G": 41, "W": 14, "U": 3, "R": 8, "A": 11, "I": 3, "Q": 13}.items()
              for i in range(1, n + 1)}
    assert wanted <= covered, sorted(wanted - covered)


def test_no_path_outside_the_given_folder(spark, tmp_path):
    for name in os.listdir(DATA):
        os.symlink(os.path.join(DATA, name), tmp_path / name)
    assert QUERIES["residual_rows"](spark, str(tmp_path)).count() > 0
