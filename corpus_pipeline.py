"""A training corpus from raw documents: language, exact copies, near copies, benchmark passages, packing.

Every stage takes (spark, docs, sf_dir) and all rows its predecessor kept. All but the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsforge.llm import language
from obsforge.llm.common import attach, documents, held_out, small_enough
from obsforge.llm.decontaminate import occurrences
from obsforge.llm.exact_dedup import exact_duplicates, normalised
from obsforge.llm.near_dedup import near_duplicates
from obsforge.llm.packing import pack
from obsforge.llm.queries import tokenizer_file
from obsforge.session import new_path, written


def _fresh(docs: DataFrame, name: str) -> str:
    """A column name like `name` that neither `docs` nor a join of it uses."""
    while {name, f"__{name}"} & set(docs.columns):
        name += "_"
    return name


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """The rows with a written number of their own, and the name of its column, which no column of `docs` has; doc_id may be null
    or repeat."""
    row = _fresh(docs, "__row")
    return written(docs.withColumn(row, F.monotonically_increasing_id()), "rows"), row


def _by_row(rows: DataFrame, row: str) -> DataFrame:
    """(doc_id, text) with the row's number as doc_id."""
    return rows.select(F.col(row).alias("doc_id"), "text")


def _without(rows: DataFrame, row: str, gone: DataFrame) -> DataFrame:
    """`rows` without those numbered in `gone` (one column), by broadcast if few go, else by a shuffle."""
    return attach(rows, written(gone.toDF(row), "dropped"), [row], "left_anti").drop(row)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no language can be told (no text, no letter) go; all others stay."""
    model = language.train(docs.where(~held_out(4, 2)))
    rows, row = _numbered(docs)
    found = language.identify(_by_row(rows, row), model)
    return _without(rows, row, found.where(F.col("lang_pred") == language.UNDETERMINED).select("doc_id"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays, also of rows that repeat one doc_id."""
    judged = written(exact_duplicates(docs), "exact")
    lost = judged.groupBy("doc_id").agg(F.max("kept").alias("kept")).where(~F.col("kept")).select("doc_id")
    shared = written(judged.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id"), "shared-ids")
    if shared.isEmpty():
        gone = written(lost.toDF(_fresh(docs, "lost")), "lost")
        side = F.broadcast(gone) if small_enough(gone) else gone
        return docs.join(side, F.col("doc_id").eqNullSafe(F.col(gone.columns[0])), "left_anti")
    rows, row = _numbered(docs)
    slim = rows.select(F.col(row).alias("row"), "doc_id", "text")
    gone = attach(slim.select("row", "doc_id"), written(lost, "lost"), ["doc_id"], "left_semi").select("row")
    # Rows of a doc_id that occurs more than once are judged by their own text, and one of equal ones is taken.
    again = attach(slim, shared, ["doc_id"], "left_semi")
    again = written(again.select("row", "doc_id", F.sha2(normalised(F.col("text")), 256).alias("digest"), F.coalesce(F.length("text"), F.lit(-1)).alias("points")), "again")
    longest = again.groupBy("doc_id", "digest").agg(F.max(F.struct("points", (-F.col("row")).alias("back"))).alias("best"))
    stay = judged.where("kept").select(F.col("doc_id").alias("id"), F.col("text_sha256").alias("kept_digest")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("digest") == F.col("kept_digest"))
    stays = written(longest.join(stay, same, "left_semi").select((-F.col("best.back")).alias("row")), "stay")
    return _without(rows, row, gone.unionByName(attach(again.select("row"), stays, ["row"], "left_anti")).distinct())


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays (shingles of five words, similarity 0.8 or more): that of the smallest doc_id.

    Rows without doc_id are judged one by one and come after all others. Rows that share a doc_id stay together if one of them stays.
    """
    rows, row = _numbered(docs)
    key = F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").alias("id"), F.col(row).alias("row"))
    judged = written(near_duplicates(rows.select(key.alias("doc_id"), "text")).select("doc_id.id", "doc_id.row", "kept"), "near")
    stay = judged.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.max("kept").alias("any_kept")).where("id IS NOT NULL AND n > 1 AND any_kept")
    gone = attach(judged.where("NOT kept"), written(stay.select("id"), "kept-ids"), ["id"], "left_anti")
    return _without(rows, row, gone.select("row"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold a benchmark item go."""
    rows, row = _numbered(docs)
    pairs = occurrences(_by_row(rows, row), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _without(rows, row, pairs.select("doc_id").distinct())


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 tokens: one row per piece of a document."""
    return pack(docs, tokenizer_file())


STAGES = [("language_id", language_id), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("packing", packing)]

# Language, near copies and packing cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each one's rows are written and read again as the next one's input."""
    docs = documents(spark, sf_dir)
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at + 1 < len(STAGES):
            path = new_path(spark, f"pipeline-{name}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
