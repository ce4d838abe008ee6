"""The driver contract, and a sample of queries against their check SQL."""

from __future__ import annotations

import re
import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as contract  # noqa: E402
from check_oracle import differences  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
# Stateful results with no SQL form; tests/test_fold.py and test_detector.py check them.
WITHOUT_SQL = {"f7_detect_with_drift", "f8_adaptive_drift", "f7_detect_mixing"}
SAMPLE = ("g1_labelled_traffic", "b3_zscore", "d10_precision_recall_f1", "e8_warning_zone",
          "e12_rolling_metrics", "f3_adjusted_weights", "f7_detect", "f10_drift_response")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in Path(FOLDER).glob("*.parquet"):
        connection.sql(f"create view {path.stem} as select * from '{path}'")
    return connection


def test_every_query_is_checked():
    optional = {n for n in contract.queries() if re.match(r"op\d+_|pipeline$", n)}
    assert set(contract.queries()) - optional - set(contract.oracle_sql()) == WITHOUT_SQL
    assert not set(contract.oracle_sql()) - set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() == 8


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, duck, name):
    mine = contract.queries()[name](spark, FOLDER).toPandas()
    theirs = duck.sql(contract.oracle_sql()[name]).df()
    assert len(mine) and differences(mine, theirs) == ""
