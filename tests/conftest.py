"""One local session for all tests and small tables as DataFrames."""

from __future__ import annotations

import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from barlake.schemas import BAR_SCHEMA, FEATURE_SCHEMA, FEATURES, PREDICTION_SCHEMA  # noqa: E402
from barlake.session import build_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "local[8]",
        4,
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


def weekdays(start: str, n: int) -> list[dt.date]:
    day, out = dt.date.fromisoformat(start), []
    while len(out) < n:
        if day.weekday() < 5:
            out.append(day)
        day += dt.timedelta(days=1)
    return out


def bars_of(spark, closes, volumes=None, symbol="T", start="2025-01-01"):
    """Bars with the given closes, stored newest first."""
    volumes = volumes or [1_000_001 + i for i in range(len(closes))]
    rows = [
        (symbol, d, c + 0.1, c + 1.0, c - 1.0, float(c), float(c), v)
        for d, c, v in zip(weekdays(start, len(closes)), closes, volumes)
    ]
    return spark.createDataFrame(rows[::-1], BAR_SCHEMA)


def valid_bars(spark, changes=None):
    """Five contract-valid bars; ``changes`` maps (row, column) to a value."""
    rows = [
        ["T", d, 100.0 + i, 102.0 + i, 99.0 + i, 101.0 + i, 101.0 + i, v]
        for i, (d, v) in enumerate(
            zip(weekdays("2026-01-01", 5), (1_000_000, 1_100_000, 1_050_000, 1_200_000, 1_150_000))
        )
    ]
    names = BAR_SCHEMA.fieldNames()
    for (i, name), value in (changes or {}).items():
        rows[i][names.index(name)] = value
    return spark.createDataFrame(rows, BAR_SCHEMA)


def valid_features(spark, changes=None):
    rows = [
        ["T", d, 0.01, 0.01, 100.0, 99.0, 0.02, 50.0 + i, 0.01, 0.1, i % 2]
        for i, d in enumerate(weekdays("2026-02-01", 5))
    ]
    names = FEATURE_SCHEMA.fieldNames()
    for (i, name), value in (changes or {}).items():
        rows[i][names.index(name)] = value
    return spark.createDataFrame(rows, FEATURE_SCHEMA)


def ramp_features(spark, n):
    """Features that grow with time, stored in scrambled order."""
    rows = [
        (
            "T", d, i / 10000, i / 11000, 100 + i / 10, 99 + i / 12, i / 20000,
            float(30 + i % 40), 0.01 + i / 100000, (i % 10 - 5) / 100, i % 2,
        )
        for i, d in enumerate(weekdays("2024-01-01", n))
    ]
    return spark.createDataFrame(rows[::2] + rows[1::2], FEATURE_SCHEMA)


def predictions_of(spark, actual, predicted, probability, start="2026-01-01"):
    rows = [
        ("T", d, a, p, float(q))
        for d, a, p, q in zip(weekdays(start, len(actual)), actual, predicted, probability)
    ]
    return spark.createDataFrame(rows, PREDICTION_SCHEMA)


def pandas_of(df, *order):
    return df.toPandas().sort_values(list(order or ("symbol", "Date"))).reset_index(drop=True)


__all__ = ["FEATURES"]
