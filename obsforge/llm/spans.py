"""Places of regular-expression matches as Spark columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Matches are added up in blocks, so that many matches in one text cost time in proportion to their number.
_BLOCK = 256


def let(value: Column, use) -> Column:
    """use(value), with value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def places(text: Column, pattern: Column, group: int = 0) -> Column:
    """Leftmost matches that do not overlap: array of (start, end, found) in code points, end exclusive; found is the group's text.

    The pattern must not match empty text. What lies between matches comes from split, the matches from regexp_extract_all.
    """
    shape = "array<struct<start:bigint,end:bigint,found:string>>"
    empty = F.array().cast(shape)
    between = F.transform(F.split(text, pattern, -1), lambda p: F.length(p).cast("bigint"))
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    found = F.regexp_extract_all(text, pattern, F.lit(group)) if group else whole
    rows = F.arrays_zip(F.slice(between, 1, F.size(whole)).alias("gap"), F.transform(whole, lambda m: F.length(m).cast("bigint")).alias("long"), found.alias("found"))

    def one(done: Column, row: Column) -> Column:
        start = done["at"] + row["gap"]
        span = F.struct(start.alias("start"), (start + row["long"]).alias("end"), row["found"].alias("found"))
        return F.struct((start + row["long"]).alias("at"), F.array_append(done["spans"], span).alias("spans"))

    def block(rows: Column):
        def run(done: Column, first: Column) -> Column:
            begin = F.struct(done["at"].alias("at"), empty.alias("spans"))
            return let(F.aggregate(F.slice(rows, first, F.lit(_BLOCK)), begin, one), lambda b: F.struct(b["at"].alias("at"), F.array_append(done["spans"], b["spans"]).alias("spans")))

        return run

    def all_blocks(rows: Column) -> Column:
        begin = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(f"array<{shape}>").alias("spans"))
        return F.flatten(F.aggregate(F.sequence(F.lit(1), F.size(rows), F.lit(_BLOCK)), begin, block(rows))["spans"])

    return let(rows, lambda r: F.when(F.size(r) > 0, all_blocks(r)).otherwise(empty))
