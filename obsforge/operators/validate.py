"""Row validation against rules kept as data: one projection adds the list of violated rules to each row."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsforge.functions.columns import is_number, no_nan

ERRORS = "errors"


@dataclass(frozen=True)
class Rule:
    """`kind`: range, members, at_least, required, number.

    range: low..high inclusive (or exclusive at the low end); members: value in the list; at_least: column >= other,
    skipped when `other` broke a range rule; required: not null; number: text castable to a number.
    """

    kind: str
    column: str
    low: float | None = None
    high: float | None = None
    open_low: bool = False
    members: tuple = ()
    other: str | None = None

    @property
    def name(self) -> str:
        return f"{self.column}:{self.kind}"


def _number(df: DataFrame, column: str) -> Column:
    """The column as a number; only text needs a cast that can fail."""
    kind = df.schema[column].dataType
    value = F.col(column) if is_number(kind) else F.col(column).cast("string").try_cast("double")
    return no_nan(value) if kind.typeName() not in ("byte", "short", "integer", "long") else value


def _outside(df: DataFrame, rule: Rule) -> Column:
    x = _number(df, rule.column)
    test = F.lit(False)
    if rule.low is not None:
        test = test | ((x <= rule.low) if rule.open_low else (x < rule.low))
    if rule.high is not None:
        test = test | (x > rule.high)
    return test


def violation(df: DataFrame, rule: Rule, rules: Sequence[Rule] = ()) -> Column:
    """True where the row breaks the rule; a null never breaks any rule but "required"."""
    if rule.kind == "required":
        return F.col(rule.column).isNull()
    if rule.kind == "number":
        return F.col(rule.column).isNotNull() & _number(df, rule.column).isNull()
    if rule.kind == "members":
        return F.col(rule.column).isNotNull() & ~F.coalesce(F.col(rule.column).isin(*rule.members), F.lit(False))
    if rule.kind == "range":
        return F.coalesce(_outside(df, rule), F.lit(False))
    if rule.kind == "at_least":
        guard = F.lit(True)
        for r in rules:
            if r.kind == "range" and r.column in (rule.other, rule.column):
                guard = guard & ~F.coalesce(_outside(df, r), F.lit(False))
        return F.coalesce(guard & (_number(df, rule.column) < _number(df, rule.other)), F.lit(False))
    raise ValueError(f"unknown rule kind {rule.kind}")


def with_errors(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add `errors`: names of the violated rules in rule order; empty for a valid row."""
    # Flattened rather than compacted: functions with a lambda have no generated code, nor has anything inside them.
    none = F.array().cast("array<string>")
    found = [F.when(test, F.array(F.lit(name))).otherwise(none) for name, test in _violations(df, rules)]
    return df.withColumn(ERRORS, F.flatten(F.array(*found)) if found else none)


def _violations(df: DataFrame, rules: Sequence[Rule]) -> list[tuple[str, Column]]:
    """(name, test) of each rule that can be broken, in rule order; those of absent required columns come last."""
    absent = [r for r in rules if r.column not in df.columns and r.kind == "required"]
    present = [r for r in rules if r.column in df.columns and (r.other is None or r.other in df.columns)]
    return [(r.name, violation(df, r, present)) for r in present] + [(r.name, F.lit(True)) for r in absent]


def check(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with their errors). Rows are told apart by one test; only rejected ones get their list."""
    broken = reduce(lambda a, b: a | b, [test for _, test in _violations(df, rules)], F.lit(False))
    return df.where(~broken), with_errors(df.where(broken), rules)


def rule_counts(marked: DataFrame) -> DataFrame:
    """Violations per rule over rows that carry `errors`."""
    return marked.select(F.explode(ERRORS).alias("rule")).groupBy("rule").agg(F.count("*").alias("n"))


def extra_columns(df: DataFrame, allowed: Sequence[str]) -> list[str]:
    return [c for c in df.columns if c not in allowed]


def require_no_extra(df: DataFrame, allowed: Sequence[str]) -> DataFrame:
    extra = extra_columns(df, allowed)
    if extra:
        raise ValueError(f"unexpected columns: {', '.join(extra)}")
    return df


def extra_keys(column: str, allowed: Sequence[str]) -> Column:
    """Sorted keys of a JSON text that the schema does not know."""
    keys = F.map_keys(F.from_json(F.col(column), "map<string,string>"))
    known = F.array(*[F.lit(a) for a in allowed])
    return F.array_sort(F.array_except(keys, known))


def _ranges() -> list[Rule]:
    # Limits of the manual request (fixed values).
    limits = {
        "MinTemp": (-50, 60), "MaxTemp": (-50, 60), "WindGustDir": (0, 360), "WindGustSpeed": (0, 200),
        "WindDir9am": (0, 360), "WindDir3pm": (0, 360), "WindSpeed9am": (0, 200), "WindSpeed3pm": (0, 200),
        "Humidity9am": (0, 100), "Humidity3pm": (0, 100), "Pressure3pm": (900, 1100), "Cloud9am": (0, 9),
        "Cloud3pm": (0, 9), "RainToday": (0, 1),
    }
    return [Rule("range", c, float(low), float(high)) for c, (low, high) in limits.items()]


def request_rules() -> list[Rule]:
    """Rules of a manual request: required, numeric, ranges, MaxTemp >= MinTemp, RainToday 0 or 1."""
    ranges = [Rule("range", "Location", low=0.0, open_low=True), *_ranges()]
    fields = [r.column for r in ranges]
    return [
        *[Rule("required", c) for c in fields],
        *[Rule("number", c) for c in fields],
        *ranges,
        Rule("at_least", "MaxTemp", other="MinTemp"),
        Rule("members", "RainToday", members=(0, 1)),
    ]


def observation_rules() -> list[Rule]:
    """The measure limits for raw observations, where places, directions and RainToday are text and nulls are allowed."""
    text = ("WindGustDir", "WindDir9am", "WindDir3pm", "RainToday")
    return [
        Rule("required", "Date"),
        Rule("required", "Location"),
        *[r for r in _ranges() if r.column not in text],
        Rule("at_least", "MaxTemp", other="MinTemp"),
        Rule("members", "RainToday", members=("Yes", "No", "0", "1")),
    ]
