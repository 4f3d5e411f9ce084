"""Column layout of the observation tables and the fixed values the results depend on."""

from __future__ import annotations

from pyspark.sql import types as T

_STRINGS = ("Location", "WindGustDir", "WindDir9am", "WindDir3pm", "RainToday", "RainTomorrow")

RAW_COLUMNS = [
    "Date", "Location", "MinTemp", "MaxTemp", "Rainfall", "Evaporation", "Sunshine", "WindGustDir", "WindGustSpeed",
    "WindDir9am", "WindDir3pm", "WindSpeed9am", "WindSpeed3pm", "Humidity9am", "Humidity3pm", "Pressure9am",
    "Pressure3pm", "Cloud9am", "Cloud3pm", "Temp9am", "Temp3pm", "RainToday", "RainTomorrow",
]


def _raw_type(name: str) -> T.DataType:
    if name == "Date":
        return T.DateType()
    return T.StringType() if name in _STRINGS else T.DoubleType()


RAW = T.StructType([T.StructField(name, _raw_type(name)) for name in RAW_COLUMNS])

LABEL = "RainTomorrow"
LABELS = ["RainToday", "RainTomorrow"]
KEYS = ["Date", "Location"]

# Columns the preparation removes, and columns that are never fenced (fixed values).
DROPPED = ["Date", "Temp3pm", "Pressure9am", "Temp9am", "Rainfall"]
NOT_FENCED = ["RainTomorrow", "RainToday", "Date", "Location"]

# Defaults added to a manual record when the column is absent (fixed values).
RECORD_DEFAULTS = {"Evaporation": 0.0, "Sunshine": 0.0}

# Text read as null, the default list of the CSV reader whose results are matched (fixed values).
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Forest and split parameters of the production run (fixed values).
FOREST = {"numTrees": 10, "maxDepth": 10, "seed": 42}
TEST_SIZE = 0.2
SEED = 42
TRAINING_SHARE = 2 / 3

# Texts of the run log that others read (fixed values).
FIRST_CHAMPION = "First model assigned as champion"
PROMOTED = "New model promoted to champion (Accuracy: {new:.4f} vs {old:.4f})"
NOT_PROMOTED = "Not promoted (no accuracy improvement)"
PREPARATION_STATUS, PREPARATION_ERROR = "data_preparation.status", "data_preparation.error"
PROMOTION, PROMOTION_ERROR = "model_promotion", "model_promotion_error"
COMPLETED, FAILED, STARTED = "COMPLETED", "FAILED", "STARTED"
AUTOMATIC, MANUAL = "prediction", "manual_prediction"
ENDPOINTS = {AUTOMATIC: "predict_api", MANUAL: "predict_user_api"}
