"""Row feed: take the next rows of a pool exactly once.

The state is one table of consumed rows, partitioned by batch, and a commit record per batch. Training rows, today's rows
and the ledger of used keys are all views of it, so a batch is either consumed for all of them or for none. A batch id is
written once; asking for it again returns what was written.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obsforge.functions.columns import row_fingerprint
from obsforge.operators.split import leading
from obsforge.plans.ordered import neighbours, running_before
from obsforge.plans.ranks import from_key, key_at_rank, last_of_top, precedes, repeated, same_key, sortable

TOP_ROWS = 10_000
BATCH, CONTENT = "batch_id", "__content"
NO_FILE, EMPTY_FILE = "no_file", "empty_file"


def read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """Parquet table, or None where nothing was written yet; any other error is raised."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _position(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """The table with its sort columns: the keys in a form that compares alike everywhere, then the content of the row."""
    names = [f"__k{i}" for i in range(len(keys))]
    placed = df.withColumns({n: sortable(df, k) for n, k in zip(names, keys)})
    return placed.withColumn(CONTENT, row_fingerprint(df.columns)), [*names, CONTENT]


def pending(pool: DataFrame, consumed: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """Pool rows that were not consumed. A row is its content: of equal rows as many are pending as were not consumed."""
    if consumed is None:
        return pool
    names = pool.columns
    marked = pool.withColumn(CONTENT, row_fingerprint(names))
    used = consumed.select(row_fingerprint(names).alias(CONTENT)).groupBy(CONTENT).agg(F.count("*").alias("__used"))
    whole = marked.groupBy(CONTENT).agg(F.count("*").alias("__all"))
    state = whole.join(used, CONTENT, "left").select(CONTENT, "__all", F.coalesce("__used", F.lit(0)).alias("__used"))
    rows = marked.join(state.where("__used < __all"), CONTENT)
    untouched = rows.where("__used = 0").select(*names)
    partly = rows.where("__used > 0").groupBy(*names).agg(F.first(F.col("__all") - F.col("__used")).alias("__n"))
    return untouched.unionByName(repeated(partly, "__n").select(*names))


def high_water(commits: DataFrame | None, keys: Sequence[str]) -> dict | None:
    """Sort columns of the last consumed row over all batches, how many rows equal to it were consumed, and rows in all."""
    if commits is None:
        return None
    names = [*[f"__k{i}" for i in range(len(keys))], CONTENT]
    last = F.max(F.struct(*names)).alias("last")
    row = commits.agg(last, F.sum("n_rows").alias("rows")).first()
    if row["last"] is None:
        return None
    same = F.lit(True)
    for n in names:
        same = same & F.col(n).eqNullSafe(F.lit(row["last"][n]))
    copies = commits.where(same).agg(F.sum("__copies")).first()[0]
    return {"place": tuple(row["last"]), "copies": copies, "rows": row["rows"]}


def _beyond(pool: DataFrame, keys: Sequence[str], mark: dict) -> DataFrame:
    """Pool rows behind the mark or equal to it; the leading key is tested alone as well, so that it reaches the scan."""
    later = ~precedes(pool, keys, mark["place"][:-1])
    return pool.where(from_key(pool, keys[0], mark["place"][0]) & later)


def late_rows(pool: DataFrame, consumed: DataFrame, keys: Sequence[str], mark: dict) -> DataFrame | None:
    """Rows that arrived in the pool before the mark after it had passed, or None; a count of the keys tells whether there are any."""
    placed, names = _position(pool.where(same_key(pool, keys, mark["place"][:-1])), keys)
    before = pool.where(precedes(pool, keys, mark["place"][:-1]))
    at = placed.agg(
        F.count_if(F.col(CONTENT) < mark["place"][-1]).alias("before"),
        F.least(F.count_if(F.col(CONTENT) == mark["place"][-1]), F.lit(mark["copies"])).alias("equal"),
    ).first()
    if before.count() + at["before"] + at["equal"] == mark["rows"]:
        return None
    reached = before.unionByName(placed.where(F.col(CONTENT) < mark["place"][-1]).select(*pool.columns))
    return pending(reached, consumed, keys)


def take_next(
    pool: DataFrame,
    consumed: DataFrame | None,
    keys: Sequence[str],
    n: int = 1,
    mark: dict | None = None,
    reconcile: bool = True,
    whole_keys: bool = False,
) -> DataFrame:
    """Exactly the next `n` rows (fewer at the end) by keys, then content; nulls first. An empty pool is an error.

    `mark` is where earlier batches ended; what they consumed is then not read, only the pool from there on. Rows that came
    late, before the mark, are found by a count and taken first; `reconcile=False` leaves that to `late_rows` in a job of its
    own. With `whole_keys`, all rows that share the last key come along.
    """
    skip = 0
    if mark is None:
        waiting = pending(pool, consumed, keys)
    else:
        waiting, skip = _beyond(pool, keys, mark), _to_skip(pool, keys, mark)
        late = late_rows(pool, consumed, keys, mark) if reconcile and consumed is not None else None
        if late is not None:
            waiting, skip = pending(waiting, consumed.where(_at_mark(consumed, keys, mark)), keys).unionByName(late), 0
    rows = _first_rows(waiting, keys, n + skip, whole_keys)
    if skip:
        placed, names = _position(rows, keys)
        rows = placed.orderBy(*names).offset(skip).select(*pool.columns) if n + skip <= TOP_ROWS else pending(rows, consumed, keys)
    if rows.isEmpty():
        raise ValueError("the pool is empty")
    return rows


def _at_mark(df: DataFrame, keys: Sequence[str], mark: dict) -> Column:
    return ~precedes(df, keys, mark["place"][:-1])


def _to_skip(pool: DataFrame, keys: Sequence[str], mark: dict) -> int:
    """Rows at the mark's key that were consumed: those of smaller content, and the copies of the marked row."""
    placed, _ = _position(pool.where(same_key(pool, keys, mark["place"][:-1])), keys)
    return placed.agg(F.count_if(F.col(CONTENT) < mark["place"][-1]) + F.least(F.count_if(F.col(CONTENT) == mark["place"][-1]), F.lit(mark["copies"]))).first()[0]


def _first_rows(waiting: DataFrame, keys: Sequence[str], n: int, whole_keys: bool) -> DataFrame:
    names = waiting.columns
    if n > TOP_ROWS:
        total = waiting.count()
        if not whole_keys:
            return leading(waiting, keys, n, total, "taken", "left").where("split = 'taken'").drop("split")
        border = key_at_rank(waiting, keys, min(n, total) - 1, total).key if total else None
    else:
        border = last_of_top(waiting, keys, n)
    if border is None:
        return waiting.limit(0)
    # Only the keys were sorted so far; whole rows are read up to the border.
    rows = waiting.where(precedes(waiting, keys, border) | same_key(waiting, keys, border))
    if whole_keys:
        return rows
    placed, order = _position(rows, keys)
    return placed.orderBy(*order).limit(n).select(*names)


def committed(spark: SparkSession, state: str) -> DataFrame | None:
    """All rows of committed batches. A batch whose job was lost half-way has no commit record and does not count."""
    commits = read_or_none(spark, f"{state}/commits")
    if commits is None:
        return None
    return spark.read.parquet(f"{state}/rows").join(commits.select(BATCH), BATCH, "left_semi")


def consume(
    spark: SparkSession, pool: DataFrame, state: str, batch_id: int, keys: Sequence[str], n: int = 1, reconcile: bool = True, whole_keys: bool = False
) -> DataFrame:
    """Consume the next rows as `batch_id` and return them; repeating a batch id changes nothing.

    The rows are written first and the commit record last; a retry after a failure in between overwrites the rows. The record
    holds the number of rows and the place of the last one, so that the next batch reads the pool from there on.
    """
    target = f"{state}/rows/{BATCH}={batch_id}"
    commits = read_or_none(spark, f"{state}/commits")
    if commits is None or commits.where(F.col(BATCH) == batch_id).isEmpty():
        batch = take_next(pool, committed(spark, state), keys, n, high_water(commits, keys), reconcile, whole_keys)
        batch.write.mode("overwrite").parquet(target)
        placed, names = _position(spark.read.schema(pool.schema).parquet(target), keys)
        counted = placed.groupBy(*names).agg(F.count("*").alias("__n"))
        end = F.max(F.struct(*names, "__n")).alias("__end")
        record = counted.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("n_rows"), end)
        record = record.select("n_rows", *[F.col("__end")[n].alias(n) for n in names], F.col("__end.__n").alias("__copies"))
        record.coalesce(1).write.mode("overwrite").parquet(f"{state}/commits/{BATCH}={batch_id}")
    return spark.read.schema(pool.schema).parquet(target)


def training_view(initial: DataFrame, consumed: DataFrame | None) -> DataFrame:
    return initial if consumed is None else initial.unionByName(consumed.select(*initial.columns))


def published(batch: DataFrame, label: str, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows without the label, the labels by key)."""
    return batch.drop(label), batch.select(*keys, label)


def check_pool(pool: DataFrame, consumed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row of invariants: counts add up, no row more often than the pool has it, everything consumed precedes everything left."""
    position = F.struct(*[F.col(c) for c in keys])
    names = pool.columns
    has = pool.select(row_fingerprint(names).alias(CONTENT)).groupBy(CONTENT).agg(F.count("*").alias("has"))
    used = consumed.groupBy(row_fingerprint(names).alias(CONTENT)).agg(F.count("*").alias("times"), F.max(position).alias("at"))
    used = used.join(has, CONTENT, "left").agg(
        F.coalesce(F.sum("times"), F.lit(0)).alias("n_consumed"),
        F.count_if(F.col("times") > F.coalesce("has", F.lit(0))).alias("n_repeated"),
        F.max("at").alias("last_used"),
    )
    left = pending(pool, consumed, keys).agg(F.struct(F.count("*").alias("n"), F.min(position).alias("next_up")))
    whole = pool.agg(F.count("*").alias("n_pool"))
    return whole.withColumns({"used": used.select(F.struct("*")).scalar(), "left": left.scalar()}).select(
        "n_pool",
        "used.n_consumed",
        F.col("left.n").alias("n_left"),
        "used.n_repeated",
        (F.col("n_pool") == F.col("used.n_consumed") + F.col("left.n")).alias("adds_up"),
        F.coalesce(F.col("left.next_up") >= F.col("used.last_used"), F.lit(True)).alias("in_order"),
    )


def digest_sums(digest: Column) -> list[Column]:
    """Sums over rows of the two halves of a hexadecimal digest."""
    return [F.sum(F.conv(F.substring(digest, start, 15), 16, 10).cast("decimal(38,0)")) for start in (1, 16)]


def batch_fingerprint(batch: DataFrame | None) -> str:
    """One text for a published batch; `no_file` and `empty_file` stand for an absent and an empty one.

    Rows are digested one by one and combined without regard to their order.
    """
    if batch is None:
        return NO_FILE
    sums = digest_sums(row_fingerprint(batch.columns))
    row = batch.agg(F.count("*").alias("n"), *[s.alias(f"h{i}") for i, s in enumerate(sums)]).first()
    return EMPTY_FILE if not row["n"] else f"{row['n']}-{row['h0']}-{row['h1']}"


def check_fresh(before: str, after: str) -> bool:
    """False where a real fingerprint did not change; sentinels always count as changed."""
    return before in (NO_FILE, EMPTY_FILE) or before != after


def fingerprints(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.withColumn("fingerprint", row_fingerprint(list(columns or df.columns)))


def staleness(
    df: DataFrame,
    fingerprint: str,
    order: Sequence[str],
    group: Sequence[str] = (),
    rows: int | None = None,
    rows_per_bucket: int | None = None,
) -> DataFrame:
    """Add `changed`: does the row differ from the one before it in its group; the first row has no predecessor and counts as changed."""
    rows = df.count() if rows is None else rows
    near = neighbours(df, order, {"previous": F.col(fingerprint)}, group, rows=rows, rows_per_bucket=rows_per_bucket)
    return near.withColumn("changed", F.coalesce(F.col("previous") != F.col(fingerprint), F.lit(True)))


def feed_report(consumed: DataFrame, pool_rows: int, keys: Sequence[str]) -> DataFrame:
    """Per batch: rows taken, first and last key of the leading column, rows in the pool before and after."""
    lead = F.col(keys[0])
    batches = consumed.groupBy(BATCH).agg(F.count("*").alias("n_rows"), F.min(lead).alias("first_key"), F.max(lead).alias("last_key"))
    placed = running_before(batches, [BATCH], {"taken": F.col("n_rows")})
    return placed.select(
        BATCH,
        "n_rows",
        "first_key",
        "last_key",
        (F.lit(pool_rows) - F.col("taken")).alias("rows_before"),
        (F.lit(pool_rows) - F.col("taken") - F.col("n_rows")).alias("rows_after"),
    )
