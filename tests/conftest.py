from __future__ import annotations

import os
import sys
from datetime import date, timedelta

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rainloom.functions.scalars import COMPASS_POINTS  # noqa: E402
from rainloom.schema import OBSERVATION_COLUMNS, WIND_COLUMNS  # noqa: E402
from rainloom.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session


FIRST_DAY = date(2017, 3, 5)
STATIONS = ("Fenwick", "Saltmere", "Upper Holm")


def make_rows(n: int = 12, seed: int = 7, stations=STATIONS) -> list[tuple]:
    """Made-up observations, one per day from ``FIRST_DAY``, in column order of the format.

    A day's temperature, dampness and wind drive its other measures; it rains on damp days, every
    third day is followed by rain.
    """
    random = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        warmth, damp, wind = 14 + 6 * np.sin(i / 9) + random.normal(0, 2), random.beta(2, 2), random.gamma(3, 6)
        spread = 3 + random.exponential(4)
        values = {c: 0.0 for c in OBSERVATION_COLUMNS}
        values |= {
            "Date": (FIRST_DAY + timedelta(days=i)).isoformat(), "Location": stations[i * 7 % len(stations)],
            "MinTemp": warmth - spread, "MaxTemp": warmth + spread, "Temp9am": warmth - spread / 2, "Temp3pm": warmth + spread / 2,
            "Rainfall": 12 * damp ** 3 + random.random(), "Evaporation": 9 * (1 - damp) + random.random(), "Sunshine": 11 * (1 - damp) + random.random(),
            "WindGustSpeed": 12 + 1.8 * wind, "WindSpeed9am": wind, "WindSpeed3pm": wind + random.random() * 8,
            "Humidity9am": 35 + 60 * damp, "Humidity3pm": 25 + 55 * damp + random.random() * 5,
            "Pressure9am": 1012 + random.normal(0, 6), "Pressure3pm": 1010 + random.normal(0, 6),
            "Cloud9am": float(round(8 * damp)), "Cloud3pm": float(random.integers(1, 8)),
            "RainToday": "Yes" if damp > 0.5 else "No", "RainTomorrow": "Yes" if i % 3 == 2 else "No",
        }
        values |= {c: str(random.choice(COMPASS_POINTS)) for c in WIND_COLUMNS}
        rows.append(tuple(float(v) if isinstance(v, float) else v for v in (values[c] for c in OBSERVATION_COLUMNS)))
    return rows


def make_frame(spark, rows):
    kinds = ["string" if isinstance(v, str) else "double" for v in make_rows(1)[0]]
    schema = ", ".join(f"{c} {k}" for c, k in zip(OBSERVATION_COLUMNS, kinds))
    return spark.createDataFrame(rows, schema)


@pytest.fixture
def weather(spark):
    return make_frame(spark, make_rows())


def replace(rows, index, **cells):
    """Rows with some cells of one row changed."""
    changed = list(rows[index])
    for name, value in cells.items():
        changed[OBSERVATION_COLUMNS.index(name)] = value
    return [*rows[:index], tuple(changed), *rows[index + 1:]]
