from __future__ import annotations

import sys
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from streamlab import build_session, schemas  # noqa: E402
from streamlab.functions import register_functions  # noqa: E402

T0 = datetime(2000, 1, 1, tzinfo=timezone.utc)
EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
PENN = (-73.9947, 40.750626)
MOMA = (-73.9776, 40.7614)
POLE = (0.0, 90.0)


def t(minutes: float) -> datetime:
    return T0 + timedelta(minutes=minutes)


def at_ms(ms: int) -> datetime:
    return EPOCH + timedelta(milliseconds=ms)


def ride(ride_id, start, at, frm=PENN, to=PENN, taxi=1, driver=None, began=None):
    """A ride row; ``at`` is the event's own time."""
    start_time, end_time = (at, EPOCH) if start else (began or T0, at)
    return (
        ride_id, start, start_time, end_time, *frm, *to, 1, taxi, taxi if driver is None else driver
    )


def fare(ride_id, at, tip=1.0, driver=1):
    return (ride_id, 1, driver, at, "CSH", tip, 0.0, 0.0)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    register_functions(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make(spark):
    """Build DataFrames from tuples by schema name."""

    class Make:
        def rides(self, *rows):
            return spark.createDataFrame(list(rows), schemas.RIDE)

        def fares(self, *rows):
            return spark.createDataFrame(list(rows), schemas.FARE)

        def frame(self, rows, ddl):
            return spark.createDataFrame(list(rows), ddl)

    return Make()


def rows(df, *cols):
    picked = df.select(*cols) if cols else df
    return sorted(tuple(r) for r in picked.collect())
