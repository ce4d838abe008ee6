from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from tidewarden.session import build_session  # noqa: E402
from derived_traffic import TrafficOptions, labelled_traffic  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[8]", 4, "8g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def keyed(spark):
    return spark.read.parquet(f"{FOLDER}/events.parquet").select("event_id", "ts")


@pytest.fixture(scope="session")
def traffic(keyed):
    """1,000 labelled events over 4 shards, computed once."""
    return labelled_traffic(keyed, TrafficOptions(shards=4)).cache()
