import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from obsforge.schema import RAW, RAW_COLUMNS  # noqa: E402
from obsforge.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false", spark__driver__memory="4g"
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def observation_rows(days=15, places=("Adelaide", "Perth", "Sydney")):
    """Small history: equal dates across places, gaps, null labels, a tie between categories."""
    import datetime

    rows = []
    for d in range(days):
        for p, place in enumerate(places):
            i = d * len(places) + p
            row = dict.fromkeys(RAW_COLUMNS)
            row.update(
                Date=datetime.date(2014, 1, 1) + datetime.timedelta(days=d),
                Location=place,
                MinTemp=10.0 + i % 7,
                MaxTemp=20.0 + i % 11,
                Rainfall=float(i % 4),
                Evaporation=None if i % 5 == 0 else 3.0 + i % 3,
                Sunshine=None if i % 2 else 8.0,
                WindGustDir=None if i % 9 == 0 else ("N", "S")[i % 2],
                WindGustSpeed=30.0 + i % 13,
                WindDir9am=("E", "W", "N")[i % 3],
                WindDir3pm=("E", "W")[p % 2],
                WindSpeed9am=5.0 + i % 6,
                WindSpeed3pm=150.0 if i == 4 else 9.0 + i % 6,
                Humidity9am=60.0 + i % 20,
                Humidity3pm=40.0 + i % 30,
                Pressure9am=1010.0 + i % 5,
                Pressure3pm=1009.0 + i % 5,
                Cloud9am=float(i % 9),
                Cloud3pm=None if i % 3 == 0 else float(i % 8),
                Temp9am=15.0 + i % 7,
                Temp3pm=22.0 + i % 7,
                RainToday=None if i == 7 else ("Yes" if i % 4 == 0 else "No"),
                RainTomorrow=None if i == 11 else ("Yes" if (i + 1) % 4 == 0 or i % 13 == 0 else "No"),
            )
            rows.append(row)
    return rows


@pytest.fixture(scope="session")
def obs(spark):
    rows = [tuple(r[c] for c in RAW_COLUMNS) for r in observation_rows()]
    return spark.createDataFrame(rows, RAW)
