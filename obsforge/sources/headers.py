"""Headers of CSV files: each file is read by its own header line, whatever the order or the quotes of its names.

One scan finds the first line of every file. Files whose names differ from the wanted ones are refused by name; what the others
need is their order of columns, and only files that are not in the commonest order take part in a join.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsforge.session import cut_lineage

MALFORMED = "__line"
FILE, BLOCK, VALUE = "__file", "__block", "value"
# Files out of the commonest order are joined by broadcast up to so many; beyond, both sides are shuffled.
BROADCAST_FILES = 50_000
_NAMED = 5


def with_places(lines: DataFrame) -> DataFrame:
    """(value, file, block): lines of a text source with the file they come from and where their part of it begins."""
    return lines.select(VALUE, F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(BLOCK))


def read_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    return with_places(spark.read.text(path))


def _cells(line: Column, n: int) -> Column:
    """Text cells c0, c1, ... of a line, and the whole line where their number is not n."""
    ddl = ", ".join([*[f"c{i} string" for i in range(n)], f"{MALFORMED} string"])
    return F.from_csv(line, ddl, {"escape": '"', "columnNameOfCorruptRecord": MALFORMED})


def _open(line: Column) -> Column:
    """Whether an odd number of quotes leaves a cell open."""
    return (F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))) % 2 == 1


def first_lines(lines: DataFrame, names: Sequence[str]) -> DataFrame:
    """(file, header, cells): the first line of each file that is not blank, and its names; cells is null if their number differs or a quote is open."""
    n = len(names)
    heads = lines.where((F.col(BLOCK) == 0) & (F.trim(VALUE) != "")).withColumn("__at", F.monotonically_increasing_id())
    found = heads.groupBy(FILE).agg(F.min_by(VALUE, "__at").alias("header"))
    parsed = found.withColumn("__cells", _cells(F.regexp_replace("header", "^\ufeff", ""), n))
    cells = F.array(*[F.trim(F.coalesce(F.col(f"__cells.c{i}"), F.lit(""))) for i in range(n)])
    return parsed.select(FILE, "header", F.when(F.col(f"__cells.{MALFORMED}").isNull() & ~_open(F.col("header")), cells).alias("cells"))


class Headers:
    """The headers of some files, checked against the wanted names: a file whose names are others is an error that names it."""

    def __init__(self, lines: DataFrame, names: Sequence[str]):
        self.names = list(names)
        self.table = cut_lineage(first_lines(lines, names))
        fits = F.array_sort("cells").eqNullSafe(F.lit(sorted(self.names)))
        refused = self.table.where(~fits).orderBy(FILE).limit(_NAMED).collect()
        if refused:
            told = "; ".join(f"{r[FILE]}: {r['header']}" for r in refused)
            raise ValueError(f"columns differ from the schema ({','.join(self.names)}) in {told}")
        common = self.table.groupBy("header", "cells").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "header").first()
        self.header, self.order = (None, self.names) if common is None else (common["header"], list(common["cells"]))
        self.others = self.table.where(F.col("header") != F.lit(self.header)) if common is not None else self.table
        self.n_others = self.others.count()

    def orders(self) -> list[list[str]]:
        """The distinct orders of columns."""
        return [list(r["cells"]) for r in self.table.select("cells").distinct().orderBy("cells").collect()]

    def texts(self, lines: DataFrame) -> DataFrame:
        """Lines (value, file, block) -> text cells by name, without headers and blank lines; the whole line where it is malformed.

        A line has as many cells as the schema, and an even number of quotes.
        """
        n = len(self.names)
        line = F.col(VALUE)
        rows = lines.where(F.trim(line) != "")
        place = {name: F.lit(self.order.index(name)) for name in self.names}
        if not self.n_others:
            rows = rows.where(line != F.lit(self.header)) if self.header is not None else rows
        else:
            spots = F.array(*[F.array_position("cells", name).cast("int") - 1 for name in self.names])
            side = self.others.select(F.col(FILE).alias("__of"), F.col("header").alias("__header"), spots.alias("__spots"))
            side = F.broadcast(side) if self.n_others <= BROADCAST_FILES else side
            rows = rows.join(side, F.col(FILE) == F.col("__of"), "left")
            rows = rows.where(line != F.coalesce("__header", F.lit(self.header)))
            place = {name: F.coalesce(F.col("__spots")[i], place[name]) for i, name in enumerate(self.names)}
        kept = ["__spots"] if self.n_others else []
        rows = rows.select(_cells(line, n).alias("__cells"), F.when(_open(line), line).alias("__open"), *kept)
        if self.n_others:
            every = F.array(*[F.col(f"__cells.c{i}") for i in range(n)])
            cell = {name: F.get(every, place[name]) for name in self.names}
        else:
            cell = {name: F.col(f"__cells.c{self.order.index(name)}") for name in self.names}
        return rows.select(*[cell[name].alias(name) for name in self.names], F.coalesce("__open", f"__cells.{MALFORMED}").alias(MALFORMED))


def resolved(lines: DataFrame, names: Sequence[str]) -> DataFrame:
    """Text cells by name of all files of `lines` (value, file, block), each read by its own header."""
    return Headers(lines, names).texts(lines)


def read_whole_files(spark: SparkSession, path: str, names: Sequence[str], options: dict) -> DataFrame:
    """Text cells by name of files whose cells may hold line breaks; each file is read by one task, files of one order together."""
    heads = Headers(read_lines(spark, path), names)
    out = []
    for order in heads.orders() or [list(names)]:
        shape = T.StructType([T.StructField(n, T.StringType()) for n in [*order, MALFORMED]])
        files = [r[FILE] for r in heads.table.where(F.col("cells") == F.lit(order)).select(FILE).collect()]
        reader = spark.read.options(**options, multiLine=True, columnNameOfCorruptRecord=MALFORMED).schema(shape)
        out.append(reader.csv([_readable(f) for f in files] or path).select(*names, MALFORMED))
    return reduce(DataFrame.unionByName, out)


def _readable(file: str) -> str:
    """A file's path from its address, in which blanks and the like are escaped."""
    from urllib.parse import unquote

    return unquote(file)
