"""Interquartile fences: fit, test, and four ways to apply them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsforge.functions.columns import no_nan
from obsforge.operators.profile import _long
from obsforge.plans.ranks import exact_quantiles

FENCES = "column string, q1 double, q3 double, low double, up double, mean double, median double"
MODES = ("clip", "collapse", "mean", "median")


def fit_fences(
    df: DataFrame,
    columns: Sequence[str],
    q1: float = 0.25,
    q3: float = 0.75,
    k: float = 1.5,
    approx: bool = False,
    centre: str | None = None,
    known_few: Sequence[str] = (),
) -> DataFrame:
    """(column, q1, q3, low, up, mean, median); `centre` asks for the mean or median as well.

    Exact by default: bracketed rank search, a few scans at any size. `approx` is one scan with sketches.
    """
    columns = list(columns)
    probs = [q1, q3] + ([0.5] if centre == "median" else [])
    means: dict[str, float | None] = dict.fromkeys(columns)
    if centre == "mean" and columns:
        row = df.agg(*[F.avg(no_nan(F.col(c).cast("double"))).alias(f"a{i}") for i, c in enumerate(columns)]).first()
        means = {c: row[f"a{i}"] for i, c in enumerate(columns)}
    if approx and columns:
        levels = F.array(*[F.lit(p) for p in probs])
        row = df.agg(
            *[F.percentile_approx(no_nan(F.col(c).cast("double")), levels, 10_000).alias(f"q{i}") for i, c in enumerate(columns)]
        ).first()
        found = {(c, p): None if row[f"q{i}"] is None else row[f"q{i}"][j] for i, c in enumerate(columns) for j, p in enumerate(probs)}
    else:
        found = exact_quantiles(df, columns, probs, known_few=known_few)
    rows = []
    for c in columns:
        lower, upper = found[(c, q1)], found[(c, q3)]
        if lower is None:
            rows.append((c, None, None, None, None, None, None))
            continue
        spread = k * (upper - lower)
        rows.append((c, lower, upper, lower - spread, upper + spread, means[c], found.get((c, 0.5))))
    return df.sparkSession.createDataFrame(rows, FENCES)


def _literals(df, fences):
    """One row per column: read once and used as literals, so that applying fences needs no join."""
    return [r for r in fences.collect() if r["column"] in df.columns and r["low"] is not None]


def has_outliers(df: DataFrame, fences: DataFrame) -> DataFrame:
    """Per column: is any value outside its fences, and how many on each side."""
    state = _literals(df, fences)
    wide = df.agg(
        *[F.count_if(F.col(s["column"]) < s["low"]).alias(f"l{i}") for i, s in enumerate(state)],
        *[F.count_if(F.col(s["column"]) > s["up"]).alias(f"u{i}") for i, s in enumerate(state)],
    )
    rows = [
        {
            "column": F.lit(s["column"]),
            "has_outliers": (F.col(f"l{i}") + F.col(f"u{i}")) > 0,
            "n_low": F.col(f"l{i}"),
            "n_up": F.col(f"u{i}"),
        }
        for i, s in enumerate(state)
    ]
    return _long(wide, rows)


def apply_fences(df: DataFrame, fences: DataFrame, mode: str = "clip") -> DataFrame:
    """Treat values outside the fences; nulls stay null.

    "clip": the nearer fence. "collapse": every value becomes the lower fence, which is what the production preparation
    does in effect. "mean" / "median": the centre stored with the fences.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    out = {}
    for s in _literals(df, fences):
        x = F.col(s["column"]).cast("double")
        if mode == "collapse":
            out[s["column"]] = F.when(x.isNotNull(), F.lit(s["low"]))
        elif mode == "clip":
            out[s["column"]] = F.when(x < s["low"], F.lit(s["low"])).when(x > s["up"], F.lit(s["up"])).otherwise(x)
        else:
            if s[mode] is None:
                raise ValueError(f"fences were fitted without centre={mode!r}")
            out[s["column"]] = F.when((x < s["low"]) | (x > s["up"]), F.lit(s[mode])).otherwise(x)
    return df.withColumns(out) if out else df
