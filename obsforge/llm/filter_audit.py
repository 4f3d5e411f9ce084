"""Filter interaction audit: what each filter of a chain removes in every order of the chain.

Each filter is a failure condition on one row; the copy filter is an existential self-join (hash, exact text, smaller doc_id).
Failure ids of all filters are united, combined per row, and only the counts of combinations meet the orders.
DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Mapping
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsforge.llm.common import GAP_CHARACTERS, Intermediate, attach, identified, small_enough

COPIES = "E"
# Rows of one hash are dealt over one more salt for every so many of them.
ROWS_PER_SALT = 4096


def word_array(text: Column) -> Column:
    """Maximal runs of characters other than white space in ASCII; `text` is not null."""
    trimmed = F.btrim(text, F.lit(GAP_CHARACTERS))
    return F.when(F.length(trimmed) > 0, F.split(trimmed, r"[\x20\x09-\x0D]+")).otherwise(F.array().cast("array<string>"))


def count_of(text: Column, characters: str) -> Column:
    """How many characters of a class of a regular expression the text has."""
    return F.length(F.regexp_replace(text, f"[^{characters}]++", "")).cast("long")


def failure_conditions() -> dict[str, Column]:
    """The default filters by letter: conditions over `text` (not null) and its `words` under which a row fails."""
    text, words = F.col("text"), F.col("words")
    return {
        "A": F.size(words) < 100,
        "B": 100 * F.size(F.array_distinct(words)).cast("long") < 80 * F.size(words).cast("long"),
        "C": 100 * count_of(text, "A-Z") > 10 * F.length(text).cast("long"),
        "D": F.rlike(text, F.lit("[#$%&*|]")),
    }


def later_copies(rows: DataFrame, steps: Intermediate) -> DataFrame:
    """The rows of (doc_id, part, text, hash, points) whose text also stands under a smaller doc_id.

    Only rows whose hash occurs more than once carry their texts on. The right side of the semi-join is one row per text, the
    smallest doc_id; a hash with many rows is dealt over salts, so a text that a third of all rows hold is no task of its own.
    """
    shared = steps.written(rows.groupBy("hash").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1"), "shared")
    held = attach(rows, shared, ["hash"], "inner").withColumn("salts", F.ceil(F.col("copies") / ROWS_PER_SALT).cast("int"))
    firsts = held.groupBy("hash", "text", "salts").agg(F.min("doc_id").alias("first_id")).where("first_id IS NOT NULL")
    firsts = firsts.select("hash", "text", "first_id", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    firsts = steps.written(firsts, "firsts")
    side = F.broadcast(firsts) if small_enough(firsts, F.octet_length("text") + 32) else firsts
    left, right = held.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.col("salts")).cast("int")).alias("l"), side.alias("r")
    same = (F.col("l.hash") == F.col("r.hash")) & (F.col("l.salt") == F.col("r.salt")) & (F.col("l.text") == F.col("r.text"))
    return left.join(right, same & (F.col("r.first_id") < F.col("l.doc_id")), "left_semi").select(*rows.columns)


def combinations(docs: DataFrame, labels: DataFrame, conditions: Mapping[str, Column] | None = None) -> DataFrame:
    """(part, fails, good, toxic, n): rows of a part (lang, null as empty) by the letters of the filters they fail, in order.

    good and toxic say whether any row of `labels` (doc_id, quality, toxic) for the doc_id has quality = 1, toxic = 1.
    """
    conditions = failure_conditions() if conditions is None else dict(conditions)
    if COPIES in conditions or any(len(letter) != 1 for letter in conditions):
        raise ValueError(f"filters need letters of their own, and {COPIES} marks copies")
    rows = identified(docs, "text", "lang").select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("hash", F.xxhash64("text")).withColumn("points", F.length("text"))
    key = ["doc_id", "part", "hash", "points"]
    with Intermediate(docs.sparkSession) as steps:
        letters = F.concat(*[F.when(c, F.lit(letter)).otherwise(F.lit("")) for letter, c in sorted(conditions.items())], F.lit(""))
        base = steps.written(rows.withColumn("words", word_array(F.col("text"))).select(*key, letters.alias("letters")), "failures")
        copies = later_copies(rows, steps).select(*key, F.lit(COPIES).alias("letters"), F.lit(0).cast("long").alias("n"))
        # Rows alike in all of the key fail alike, so they may be counted together.
        every = base.withColumn("n", F.lit(1).cast("long")).unionByName(copies)
        failing = every.groupBy(*key).agg(F.max(F.when(F.col("letters") != COPIES, F.col("letters"))).alias("own"), F.max(F.col("letters") == COPIES).alias("copy"), F.sum("n").alias("n"))
        named = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
        judged = attach(failing, steps.written(named, "labels"), ["doc_id"], "left")
        fails = F.array_join(F.array_sort(F.split(F.concat(F.coalesce("own", F.lit("")), F.when(F.col("copy"), COPIES).otherwise("")), "")), "")
        of = ["part", fails.alias("fails"), *[F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")]]
        return steps.result(judged.groupBy(*of).agg(F.sum("n").alias("n")), "combinations")


def audit(docs: DataFrame, labels: DataFrame, conditions: Mapping[str, Column] | None = None) -> DataFrame:
    """One row per part, order of the filters and step, zeros included.

    part, filter_order (string of letters), step (1, 2, ...; its filter is the letter there); counts of rows of the part: kept
    after the step, removed here, redundant (fail here, removed earlier), unique_fails (fail this filter only), good_lost and
    toxic_lost (removed here, labelled so), shapley (removed by this filter, summed over all orders).

    Null text is empty (it fails A); a null doc_id is neither smaller nor larger than any, so such rows are no copies and make
    none. Repeated rows count each. An empty table has no parts and gives no rows. Other columns of either table are ignored.
    """
    conditions = failure_conditions() if conditions is None else dict(conditions)
    orders = ["".join(p) for p in permutations(sorted([*conditions, COPIES]))]
    rows = combinations(docs, labels, conditions)
    rows = rows.withColumn("filter_order", F.explode(F.split(F.lit(",".join(orders)), ","))).withColumn("step", F.explode(F.sequence(F.lit(1), F.length("filter_order"))))
    letter = F.expr("substring(filter_order, step, 1)")
    left = F.expr("translate(fails, substring(filter_order, 1, step - 1), '')")
    fails, gone = F.contains("fails", letter), F.length(left) < F.length("fails")
    removed = fails & ~gone

    def rows_where(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(F.lit(0).cast("long")))

    steps = rows.groupBy("part", "filter_order", "step", letter.alias("letter")).agg(
        rows_where(~gone & ~fails).alias("kept"),
        rows_where(removed).alias("removed"),
        rows_where(fails & gone).alias("redundant"),
        rows_where(F.col("fails") == letter).alias("unique_fails"),
        rows_where(removed & F.col("good")).alias("good_lost"),
        rows_where(removed & F.col("toxic")).alias("toxic_lost"),
    )
    every = steps.groupBy("part", "letter").agg(F.sum("removed").alias("shapley"))
    joined = steps.join(every, ["part", "letter"])
    return joined.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
