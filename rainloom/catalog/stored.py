"""The stored ensemble of the registered scoring queries, written by ``tools/fit_stored_model.py``."""

from __future__ import annotations

import functools
import os

from rainloom.functions.features import WEATHER_FEATURES
from rainloom.operators.boosting import Ensemble
from rainloom.schema import NUMERIC_COLUMNS

FEATURES = [*NUMERIC_COLUMNS, "RainToday", "Month", "DayOfYear", *WEATHER_FEATURES]
PATH = os.path.join(os.path.dirname(os.path.abspath(__file__)), "stored_model.json")


@functools.cache
def stored_ensemble() -> Ensemble:
    with open(PATH) as file:
        return Ensemble.from_json(file.read())
