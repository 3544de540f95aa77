"""Registered queries against their SQL twins on the smallest test tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry_points
from tools.compare import differences, open_tables
from vecindad.registry.oracle import ORACLE
from vecindad.registry.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    return open_tables(FOLDER)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    frame = entry_points.queries()[name](spark, FOLDER)
    problem = differences(frame, db, entry_points.oracle_sql()[name])
    assert problem is None, problem


def test_entry(spark):
    frame = entry_points.entry(spark)
    assert frame.count() > 0
    assert frame.columns[:4] == ["Anio", "Semana", "consorcioID", "Consorcio"]


def test_totals_agree_across_reports(spark):
    """The last running total of a building and year is the sum of its weeks."""
    from pyspark.sql import functions as F

    frame = entry_points.queries()["weekly_cash_flow"](spark, FOLDER)
    sums = frame.groupBy("consorcioID", "Anio").agg(
        F.sum("TotalGeneral").alias("total"), F.max("Acumulado").alias("last")
    )
    assert sums.where("total <> last").count() == 0
