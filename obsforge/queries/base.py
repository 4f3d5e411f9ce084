"""Registry and the derived inputs shared by queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded for comparison across engines; adding 0.0 turns -0.0 into 0.0."""
    return df.select(*[(F.round(F.col(n), digits) + 0.0).alias(n) if t == "double" else F.col(n) for n, t in df.dtypes])



# Observation rows derived from line items; the text runs unchanged in both engines.
OBSERVATIONS = """
SELECT CAST(l_shipdate AS DATE) AS Date,
  concat('S', CAST(l_suppkey AS STRING)) AS Location,
  l_quantity - 10 AS MinTemp,
  l_quantity + round(l_tax * 100) AS MaxTemp,
  nullif(round(l_discount * 100), CAST(7 AS DOUBLE)) AS Rainfall,
  nullif(round(l_tax * 100), CAST(3 AS DOUBLE)) AS Evaporation,
  CASE WHEN l_linenumber = 4 THEN NULL ELSE CAST(l_linenumber AS DOUBLE) END AS Sunshine,
  CASE l_linenumber WHEN 1 THEN 'N' WHEN 2 THEN 'S' WHEN 3 THEN 'E' WHEN 4 THEN 'W' WHEN 6 THEN NULL ELSE 'SE' END AS WindGustDir,
  CAST(floor(l_extendedprice / 1000) AS DOUBLE) AS WindGustSpeed,
  CASE WHEN l_quantity = 50 THEN NULL WHEN l_linestatus = 'F' THEN 'N' ELSE 'S' END AS WindDir9am,
  CASE WHEN l_quantity < 10 THEN 'E' WHEN l_quantity < 20 THEN 'W' WHEN l_quantity < 45 THEN 'N' ELSE NULL END AS WindDir3pm,
  CAST(l_linenumber * 3 AS DOUBLE) AS WindSpeed9am,
  nullif(l_quantity, CAST(13 AS DOUBLE)) AS WindSpeed3pm,
  100 - l_quantity AS Humidity9am,
  round(l_discount * 1000) AS Humidity3pm,
  CAST(1000 + floor(l_extendedprice / 10000) AS DOUBLE) AS Pressure9am,
  CAST(1005 + floor(l_extendedprice / 5000) AS DOUBLE) AS Pressure3pm,
  CAST(nullif(l_linenumber, 2) AS DOUBLE) AS Cloud9am,
  round(l_tax * 100) AS Cloud3pm,
  l_quantity AS Temp9am,
  l_quantity + 1 AS Temp3pm,
  CASE WHEN round(l_discount * 100) = 1 AND l_linenumber = 7 THEN NULL WHEN l_linestatus = 'F' THEN 'Yes' ELSE 'No' END AS RainToday,
  CASE WHEN round(l_tax * 100) = 8 AND l_linenumber = 6 THEN NULL
       WHEN l_returnflag = 'R' OR l_quantity > 42 THEN 'Yes' ELSE 'No' END AS RainTomorrow
FROM lineitem
"""


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = OBSERVATIONS.replace("FROM lineitem", "FROM {lineitem}")
    return spark.sql(text, lineitem=table(spark, sf_dir, "lineitem"))


# Labelled scores derived from line items.
SCORED = """
SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label,
  CASE WHEN l_quantity / 50 >= 0.5 THEN 1 ELSE 0 END AS prediction,
  l_quantity / 50 AS score
FROM lineitem
"""


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(SCORED.replace("FROM lineitem", "FROM {lineitem}"), lineitem=table(spark, sf_dir, "lineitem"))
