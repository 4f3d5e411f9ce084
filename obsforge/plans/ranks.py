"""Find rows and values by rank without sorting the table.

Each pass is one scan that ends in a handful of counters, and narrows the search to the bracket that holds the wanted
rank. Only the last bracket, a bounded number of distinct keys, is ever ordered.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsforge.functions.columns import no_nan
from obsforge.plans.ordered import running_before
from obsforge.session import cut_lineage

SMALL_DISTINCT = 50_000
SKETCH_ACCURACY = 1_000
GRID = 100
KEY_LIMIT = 100_000
KEY_SAMPLE = 20_000


@dataclass
class _Search:
    """One (column, probability) under search: the bracket that holds both ranks next to the quantile."""

    column: str
    prob: float
    first: int
    second: int
    low: float | None = None
    high: float | None = None
    below: int = 0
    distinct: int = 0
    tries: int = 0

    def inside(self, value: Column) -> Column:
        test = value.isNotNull()
        if self.low is not None:
            test = test & (value >= self.low)
        if self.high is not None:
            test = test & (value <= self.high)
        return test


def few_valued(df: DataFrame, columns: Sequence[str], small: int | None = None) -> list[str]:
    """The numeric columns with few distinct values, from one scan; a part of the table can be searched by the same list."""
    small = SMALL_DISTINCT if small is None else small
    if not columns:
        return []
    values = df.select(*[no_nan(F.col(c).cast("double")).alias(c) for c in columns])
    sizes = values.agg(*[F.approx_count_distinct(c).alias(f"d{i}") for i, c in enumerate(columns)]).first()
    return [c for i, c in enumerate(columns) if sizes[f"d{i}"] <= small]


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], small: int | None = None, known_few: Sequence[str] = ()
) -> dict[tuple[str, float], float | None]:
    """Linearly interpolated quantiles of numeric columns, nulls skipped, exact at any table size.

    Columns `known_few` have few distinct values, so those are not counted again.
    """
    small = SMALL_DISTINCT if small is None else small
    columns, probs = list(dict.fromkeys(columns)), list(dict.fromkeys(probs))
    result: dict[tuple[str, float], float | None] = {}
    if not columns or not probs:
        return result
    values = df.select(*[no_nan(F.col(c).cast("double")).alias(c) for c in columns])
    few, open_columns = [c for c in columns if c in known_few], [c for c in columns if c not in known_few]
    counts, many = {}, []
    if open_columns:
        sizes = values.agg(
            *[F.count(c).alias(f"n{i}") for i, c in enumerate(open_columns)],
            *[F.approx_count_distinct(c).alias(f"d{i}") for i, c in enumerate(open_columns)],
        ).first()
        counts = {c: sizes[f"n{i}"] for i, c in enumerate(open_columns)}
        few += [c for i, c in enumerate(open_columns) if counts[c] and sizes[f"d{i}"] <= small]
        many = [c for i, c in enumerate(open_columns) if counts[c] and sizes[f"d{i}"] > small]
    result.update({(c, p): None for c in open_columns if not counts[c] for p in probs})
    if not few and not many:
        return result
    # Few distinct values: the built-in exact percentile, whose state they bound. Many: a sketch to start the search from.
    margin = 2.0 / SKETCH_ACCURACY
    levels = F.array(*[F.lit(p) for p in probs])
    around = F.array(*[F.lit(q) for p in probs for q in (max(0.0, p - margin), min(1.0, p + margin))])
    row = values.agg(
        *[F.percentile(c, levels).alias(f"p{i}") for i, c in enumerate(few)],
        *[F.percentile_approx(c, around, SKETCH_ACCURACY).alias(f"q{i}") for i, c in enumerate(many)],
    ).first()
    result.update({(c, p): None if row[f"p{i}"] is None else row[f"p{i}"][j] for i, c in enumerate(few) for j, p in enumerate(probs)})
    searches = []
    for i, c in enumerate(many):
        for j, p in enumerate(probs):
            rank = math.floor((counts[c] - 1) * p)
            low = None if p <= margin else row[f"q{i}"][2 * j]
            high = None if p >= 1 - margin else row[f"q{i}"][2 * j + 1]
            searches.append(_Search(c, p, rank, min(rank + 1, counts[c] - 1), low, high))
    open_ = searches
    while open_:
        open_ = _narrowed(open_, values.agg(*_bracket_counts(open_)).first(), small)
    if searches:
        result.update(_read_brackets(values, searches, counts))
    return result


def _bracket_counts(searches):
    """What one scan has to count to check every open bracket against its ranks and to propose a tighter one."""
    grid = F.array(*[F.lit(i / GRID) for i in range(GRID + 1)])
    exprs = []
    for i, s in enumerate(searches):
        value = F.col(s.column)
        held = F.when(s.inside(value), value)
        exprs += [
            (F.max(F.lit(0)) if s.low is None else F.count_if(value < s.low)).alias(f"b{i}"),
            F.count(held).alias(f"n{i}"),
            F.approx_count_distinct(held).alias(f"d{i}"),
            F.percentile_approx(held, grid, GRID * 10).alias(f"g{i}"),
        ]
    return exprs


def _narrowed(searches, row, small):
    """Update the brackets from the counts; returns those that need another scan."""
    still_open = []
    for i, s in enumerate(searches):
        s.below, held, s.distinct = row[f"b{i}"], row[f"n{i}"], row[f"d{i}"]
        s.tries += 1
        if s.first < s.below:
            s.low, s.tries = None, s.tries + 4
            still_open.append(s)
        elif s.second >= s.below + held:
            s.high, s.tries = None, s.tries + 4
            still_open.append(s)
        elif s.distinct > small and s.tries < 12:
            grid_values, span = row[f"g{i}"], max(held - 1, 1)
            left = math.floor((s.first - s.below) / span * GRID) - 1
            right = math.ceil((s.second - s.below) / span * GRID) + 1
            low = grid_values[left] if left >= 0 else s.low
            high = grid_values[right] if right <= GRID else s.high
            if (low, high) != (s.low, s.high):
                s.low, s.high = low, high
                still_open.append(s)
    return still_open


def _read_brackets(values, searches, counts):
    hits = F.array(
        *[
            F.when(s.inside(F.col(s.column)), F.struct(F.lit(i).alias("slot"), F.col(s.column).alias("value")))
            for i, s in enumerate(searches)
        ]
    )
    seen = values.select(F.explode(hits).alias("hit")).where(F.col("hit").isNotNull())
    tallied = seen.groupBy("hit.slot", "hit.value").agg(F.count("*").alias("n"))
    ranked = running_before(
        tallied, ["value"], sums={"before": F.col("n")}, group=["slot"], rows=sum(s.distinct for s in searches)
    )
    spark = values.sparkSession
    wanted = spark.createDataFrame(
        [(i, which, rank - s.below) for i, s in enumerate(searches) for which, rank in ((0, s.first), (1, s.second))],
        "slot int, which int, rank long",
    )
    found = ranked.join(F.broadcast(wanted), "slot").where("rank >= before and rank < before + n")
    at = {(r["slot"], r["which"]): r["value"] for r in found.select("slot", "which", "value").collect()}
    out = {}
    for i, s in enumerate(searches):
        share = (counts[s.column] - 1) * s.prob - s.first
        out[(s.column, s.prob)] = at[(i, 0)] + (at[(i, 1)] - at[(i, 0)]) * share
    return out


@dataclass
class KeyAtRank:
    """The key tuple at a rank, how many rows precede it and how many share it."""

    key: tuple[Any, ...]
    below: int
    equal: int


def key_at_rank(df: DataFrame, keys: Sequence[str], rank: int, total: int, limit: int | None = None) -> KeyAtRank:
    """Key of the row with 0-based `rank` in ascending key order; keys of any orderable type, nulls first.

    One key column after the other: a histogram of the leading key and its running sum name the one value that holds the rank, and
    the next column is searched in the rows of that value only, by an equality that reaches the scan. `limit` rows or fewer are
    ordered by all keys at once. Dates and other small types are tallied in one scan; numbers and timestamps take one scan more,
    for a sketch that bounds which of them are tallied; other types are narrowed by samples.
    """
    limit = limit or KEY_LIMIT
    left, found, below = list(keys), [], 0
    while total > limit and left and _kind(df, left[0]) != "other":
        value, before, equal = _leading_at_rank(df, left[0], rank, total)
        found.append(value)
        df = df.where(_is(df, left.pop(0), value))
        below, rank, total = below + before, rank - before, equal
    if not left:
        return KeyAtRank(tuple(found), below, total)
    rest = _narrowed_key(df, left, rank, total, limit)
    return KeyAtRank((*found, *rest.key), below + rest.below, rest.equal)


# Types with so few values that all of them are tallied, and types that a sketch can bracket.
_SMALL = (T.DateType, T.BooleanType, T.ByteType, T.ShortType)
_SKETCHED = (T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.TimestampType)
BRACKET_ACCURACY = 10_000


def _kind(df, column) -> str:
    dtype = df.schema[column].dataType
    # A double holds every decimal of 15 digits.
    sketched = isinstance(dtype, _SKETCHED) or (isinstance(dtype, T.DecimalType) and dtype.precision <= 15)
    return "small" if isinstance(dtype, _SMALL) else "sketched" if sketched else "other"


def _is(df, column, value) -> Column:
    """Equality with a sortable value, as a test that can be pushed into the scan."""
    return F.col(column).isNull() if value is None else F.col(column) == _unsorted(df, column, value)


def _leading_at_rank(df, column, rank, total) -> tuple[Any, int, int]:
    """The column's value at a rank, how many rows are smaller and how many share it."""
    brackets = [(None, None)]
    if _kind(df, column) == "sketched":
        nulls, brackets = _sketched(df, column, rank, total)
        if rank < nulls:
            return None, 0, nulls
    for low, high in brackets:
        tally, size = _tally(df, column, low, high), 0
        if _kind(df, column) != "small":
            # Of unknown size, and read more than once if it is large.
            tally = cut_lineage(tally)
            size = tally.count()
        placed = running_before(tally, ["inside", "value"], sums={"before": F.col("n")}, rows=size)
        hit = placed.where((F.col("before") <= rank) & (F.col("before") + F.col("n") > rank)).first()
        if hit is not None and hit["inside"]:
            return hit["value"], hit["before"], hit["n"]
    raise ValueError(f"no row of rank {rank} among {total}")


def _tally(df, column, low, high) -> DataFrame:
    """(inside, value, n): rows per value of the bracket. All rows below it are one group; those above are not read."""
    value = F.col(column)
    held = df if high is None else df.where(value.isNull() | (value <= _unsorted(df, column, high)))
    inside = F.lit(True) if low is None else F.coalesce(value >= _unsorted(df, column, low), F.lit(False))
    spots = held.select(inside.alias("inside"), F.when(inside, sortable(df, column)).alias("value"))
    return spots.groupBy("inside", "value").agg(F.count(F.lit(1)).alias("n"))


def _sketched(df, column, rank, total) -> tuple[int, list[tuple[Any, Any]]]:
    """(nulls, brackets to try for the value at a rank, widest last), from one scan.

    The brackets lie a little beyond the sketch's own error. They only steer: what lies inside is counted.
    """
    form = sortable(df, column)
    number = F.coalesce(form.cast("double"), F.lit(-math.inf))
    number = F.when(F.isnan(number), F.lit(math.inf)).otherwise(number)
    share = (rank + 0.5) / total
    moves = [step / BRACKET_ACCURACY for step in (2, GRID)]
    asked = F.array(*[F.lit(min(1.0, max(0.0, share + sign * m))) for m in moves for sign in (-1, 1)])
    row = df.agg(F.count_if(form.isNull()).alias("nulls"), F.percentile_approx(number, asked, BRACKET_ACCURACY).alias("near")).first()
    whole = isinstance(df.schema[column].dataType, (T.IntegerType, T.LongType, T.TimestampType))

    def bound(value):
        if whole and math.isfinite(value):
            return min(max(int(value), -(2**63)), 2**63 - 1)
        return value

    brackets = []
    for i, move in enumerate(moves):
        low, high = row["near"][2 * i], row["near"][2 * i + 1]
        brackets.append((None if share <= move or low == -math.inf else bound(low), None if share >= 1 - move or high == math.inf else bound(high)))
    return row["nulls"], [*brackets, (None, None)]


def _narrowed_key(rows, keys, rank, total, limit) -> KeyAtRank:
    """The search on all keys together: samples propose brackets, each is counted, and the last one is ordered."""
    below, held, widen = 0, total, 4.0
    rows = rows.select(*[sortable(rows, c).alias(c) for c in keys])
    position = F.struct(*[F.col(c) for c in keys])
    while held > limit:
        low, high = _key_bracket(rows, keys, (rank - below + 0.5) / held, held, widen)
        under = F.lit(False) if low is None else position < _as_struct(rows, keys, low)
        over = F.lit(False) if high is None else position > _as_struct(rows, keys, high)
        inner = ~under & ~over
        seen = rows.agg(F.count_if(under).alias("under"), F.count_if(inner).alias("inner")).first()
        if not seen["under"] <= rank - below < seen["under"] + seen["inner"]:
            widen *= 2
            continue
        below += seen["under"]
        if low is not None and low == high:
            return KeyAtRank(tuple(low), below, seen["inner"])
        if seen["inner"] == held:
            break
        # The leading key is also tested alone, which reaches the scan.
        if high is not None and high[0] is not None:
            rows = rows.where(F.col(keys[0]).isNull() | (F.col(keys[0]) <= F.lit(high[0])))
        if low is not None and low[0] is not None:
            rows = rows.where(F.col(keys[0]) >= F.lit(low[0]))
        held, rows, widen = seen["inner"], rows.where(inner), 4.0
    counted = rows.groupBy(*keys).agg(F.count("*").alias("__n"))
    placed = running_before(counted, keys, sums={"__before": F.col("__n")}, rows=held)
    offset = rank - below
    hit = placed.where((F.col("__before") <= offset) & (F.col("__before") + F.col("__n") > offset)).first()
    return KeyAtRank(tuple(hit[c] for c in keys), below + hit["__before"], hit["__n"])


def _key_bracket(rows, keys, share, held, widen):
    """Keys a few standard errors below and above the wanted share of the rows, from a bounded sample.

    The sample only steers the search: what lies in the bracket is counted, and a miss widens it.
    """
    sample = rows.sample(min(1.0, KEY_SAMPLE / held), seed=7).orderBy(*keys).collect()
    size = len(sample)
    error = widen * math.sqrt(max(share * (1 - share) * size, 1.0))
    left, right = math.floor(share * size - error) - 1, math.ceil(share * size + error)
    return sample[left] if left >= 0 else None, sample[right] if right < size else None


def _as_struct(rows, keys, values) -> Column:
    types = {f.name: f.dataType for f in rows.schema.fields}
    return F.struct(*[F.lit(v).cast(types[c]).alias(c) for c, v in zip(keys, values)])


def sortable(df, column) -> Column:
    """A form that sorts alike and passes through the driver unchanged, whatever its time zone.

    Timestamps travel as microseconds, those without a zone as text.
    """
    dtype = df.schema[column].dataType
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(column)
    return F.col(column).cast("string") if isinstance(dtype, T.TimestampNTZType) else F.col(column)


def _unsorted(df, column, value) -> Column:
    """Literal of the column's own type from its sortable form; constant, so it can be pushed into the scan."""
    dtype = df.schema[column].dataType
    return F.timestamp_micros(F.lit(value)) if isinstance(dtype, T.TimestampType) else F.lit(value).cast(dtype)


def last_of_top(df: DataFrame, keys: Sequence[str], n: int) -> tuple[Any, ...] | None:
    """Key of the n-th row in key order (of the last, if there are fewer) by a top-n; for small n."""
    top = df.select(*[sortable(df, c).alias(c) for c in keys]).orderBy(*keys).limit(n)
    last = top.agg(F.max(F.struct(*keys)).alias("key")).first()["key"]
    return None if last is None else tuple(last)


def from_key(df: DataFrame, column: str, value: Any) -> Column:
    """True where a column may be at or behind `value`; constant and on one column, so that it can be pushed into the scan."""
    return F.lit(True) if value is None else F.col(column) >= _unsorted(df, column, value)


def precedes(df: DataFrame, keys: Sequence[str], key: Sequence[Any]) -> Column:
    """True where the row's key is smaller; the leading column is also tested alone so it can reach the scan.

    Nulls sort first, as in `orderBy`.
    """
    forms = df.select(*[sortable(df, c).alias(c) for c in keys])
    position = F.struct(*[sortable(df, c).alias(c) for c in keys])
    test = position < _as_struct(forms, keys, key)
    if key[0] is not None:
        lead = F.col(keys[0])
        test = (lead.isNull() | (lead <= _unsorted(df, keys[0], key[0]))) & test
    return test


def same_key(df: DataFrame, keys: Sequence[str], key: Sequence[Any]) -> Column:
    test = F.lit(True)
    for name, value in zip(keys, key):
        test = test & sortable(df, name).eqNullSafe(F.lit(value))
    return test


def repeated(df: DataFrame, times: str, chunk: int = 10_000) -> DataFrame:
    """Each row `times` times, spread over the cluster in chunks so that one hot row does not occupy one task."""
    chunks = df.withColumn("__chunk", F.explode(F.sequence(F.lit(0), ((F.col(times) - 1) / chunk).cast("int"))))
    spread = chunks.where(F.col(times) > 0).repartition("__chunk")
    size = F.least(F.lit(chunk), F.col(times) - F.col("__chunk") * chunk).cast("int")
    return spread.withColumn("__copy", F.explode(F.sequence(F.lit(1), size))).drop("__chunk", "__copy", times)
