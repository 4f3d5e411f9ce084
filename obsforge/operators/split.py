"""Chronological and stratified splits that assign exact row counts without ordering the table."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from obsforge.functions.columns import content_hash, key_hash, row_fingerprint
from obsforge.plans.ordered import running_before
from obsforge.plans.ranks import key_at_rank, precedes, repeated, same_key
from obsforge.schema import SEED, TEST_SIZE, TRAINING_SHARE
from obsforge.session import cut_lineage

ROW_KEY = "__row"
# Up to this many classes their borders are found together on the driver; a label with more is split by a window over the hashes.
MAX_CLASSES = 10_000


def chronological(
    df: DataFrame,
    date: str,
    ties: Sequence[str] = (),
    fraction: float = TRAINING_SHARE,
    first: str = "training",
    second: str = "prediction",
    key_limit: int | None = None,
) -> DataFrame:
    """Add `split`: the first int(n * fraction) rows by (date, ties, content of the row) are `first`, the rest `second`.

    Only the key at the border is searched for; the assignment itself is a filter-like projection of each row.
    """
    total = df.count()
    return leading(df, [date, *ties], int(total * fraction), total, first, second, key_limit)


def leading(df: DataFrame, keys: Sequence[str], cut: int, total: int, first: str, second: str, key_limit: int | None = None) -> DataFrame:
    """Add `split`: the first `cut` of `total` rows by (keys, content of the row) are `first`, the rest `second`."""
    late, early = F.lit(second), F.lit(first)
    if cut <= 0 or cut >= total:
        return df.withColumn("split", early if cut >= total and total else late)
    names, keys = df.columns, list(keys)
    border = key_at_rank(df, keys, cut - 1, total, key_limit)
    if border.below + border.equal > cut:
        # The border falls inside rows that share the keys: go on by the content of the row, which only those rows compute.
        tied = df.where(same_key(df, keys, border.key)).withColumn(ROW_KEY, row_fingerprint(names))
        inner = key_at_rank(tied, [ROW_KEY], cut - 1 - border.below, border.equal, key_limit)
        df = df.withColumn(ROW_KEY, F.when(same_key(df, keys, border.key), row_fingerprint(names)))
        keys, border = [*keys, ROW_KEY], _nested(border, inner)
    before = precedes(df, keys, border.key)
    at_border = same_key(df, keys, border.key)
    taken = cut - border.below
    if taken >= border.equal:
        return df.withColumn("split", F.when(before | at_border, early).otherwise(late)).select(*names, "split")
    # Identical copies straddle the border; which copy goes where is immaterial, the numbers are not.
    apart = df.where(~at_border).withColumn("split", F.when(before, early).otherwise(late))
    copy = df.where(at_border).select(*names).distinct()
    shares = F.array(
        F.struct(early.alias("split"), F.lit(taken).cast("long").alias("__n")),
        F.struct(late.alias("split"), F.lit(border.equal - taken).cast("long").alias("__n")),
    )
    copies = repeated(copy.select(*names, F.inline(shares)), "__n")
    return apart.select(*names, "split").unionByName(copies.select(*names, "split"))


def _nested(outer, inner):
    return type(outer)((*outer.key, *inner.key), outer.below + inner.below, inner.equal)


def class_quotas(counts: dict, test_size: float) -> dict:
    """Test rows per class: ceil(test_size * n) in total; training shares by largest remainder."""
    total = sum(counts.values())
    training = total - math.ceil(test_size * total)
    exact = {c: n * training / total for c, n in counts.items()}
    share = {c: math.floor(x) for c, x in exact.items()}
    left = training - sum(share.values())
    for c in sorted(counts, key=lambda c: (share[c] - exact[c], str(c)))[:left]:
        share[c] += 1
    return {c: counts[c] - share[c] for c in counts}


def stratified(
    df: DataFrame,
    label: str,
    key: Sequence[str] | None = None,
    test_size: float = TEST_SIZE,
    seed: int = SEED,
    widen: float = 6.0,
) -> DataFrame:
    """Add `split` ("train" / "test") with exact class quotas, rows chosen by a seeded hash of `key` (default: all columns).

    The hash is uniform, so the border of each class lies in a narrow known range: one scan counts what is below it and
    keeps only the hashes inside. A class may hold nearly all rows. `key` must identify rows, or be omitted. Rows without a
    label are an error.
    """
    names = df.columns
    spark = df.sparkSession
    labelled = df
    classes = labelled.groupBy(label).agg(F.count("*").alias("n"))
    found = classes.limit(MAX_CLASSES + 1).collect()
    counts = {r[label]: r["n"] for r in found}
    if None in counts or (len(found) > MAX_CLASSES and not classes.where(F.col(label).isNull()).isEmpty()):
        raise ValueError(f"rows without {label} cannot be split by it")
    if len(found) > MAX_CLASSES:
        return _many_classes(labelled, label, key, test_size, seed)
    if not counts:
        return labelled.withColumn("split", F.lit("train"))
    quotas = class_quotas(counts, test_size)
    label_type = df.schema[label].dataType.simpleString()
    hashed = labelled.withColumn(ROW_KEY, key_hash(seed, key) if key else content_hash(seed, sorted(names)))
    cuts = _hash_cuts(spark, hashed, label, label_type, counts, quotas, widen)
    table = F.broadcast(spark.createDataFrame(cuts, f"__label {label_type}, __cut string, __take long, __equal long"))
    marked = hashed.join(table, F.col(label) == F.col("__label"))
    is_test = (F.col(ROW_KEY) < F.col("__cut")) | ((F.col(ROW_KEY) == F.col("__cut")) & (F.col("__take") >= F.col("__equal")))
    if all(take >= equal or cut == "" for _, cut, take, equal in cuts):
        return marked.withColumn("split", F.when(is_test, "test").otherwise("train")).select(*names, "split")
    return _split_copies(marked, names, is_test)


def _many_classes(df: DataFrame, label: str, key: Sequence[str] | None, test_size: float, seed: int) -> DataFrame:
    """The same split for a label of many values: quotas from the class table, rows by running rank of their hash."""
    names = df.columns
    hashed = df.withColumn(ROW_KEY, key_hash(seed, key) if key else content_hash(seed, sorted(names)))
    classes = cut_lineage(df.groupBy(label).agg(F.count("*").alias("__n")))
    size = classes.agg(F.sum("__n").alias("rows"), F.count(F.lit(1)).alias("classes")).first()
    total = size["rows"]
    training = total - math.ceil(test_size * total)
    exact = F.col("__n") * training / total
    shares = classes.select(label, "__n", F.floor(exact).alias("__share"), (F.floor(exact) - exact).alias("__rest"), F.col(label).cast("string").alias("__text"))
    left = training - shares.agg(F.sum("__share")).first()[0]
    places = running_before(shares, ["__rest", "__text"], {"__place": F.lit(1)}, rows=size["classes"])
    quotas = places.select(F.col(label).alias("__label"), (F.col("__n") - F.col("__share") - (F.col("__place") < left).cast("long")).alias("__test"))
    counted = running_before(hashed, [ROW_KEY], {"__before": F.lit(1)}, group=[label], rows=total)
    marked = counted.join(quotas, F.col(label).eqNullSafe(F.col("__label")))
    return marked.withColumn("split", F.when(F.col("__before") < F.col("__test"), "test").otherwise("train")).select(*names, "split")


def _hash_cuts(spark, hashed, label, label_type, counts, quotas, widen):
    """Per class: hash of the last test row, how many rows with it are taken, how many there are."""
    top = 16**32
    ranges = []
    for c, n in counts.items():
        share = quotas[c] / n
        margin = widen * math.sqrt(max(share * (1 - share), 1 / n) / n) + 2 / n
        low, high = max(0.0, share - margin), min(1.0, share + margin)
        ranges.append((c, f"{int(low * top):032x}", "g" if high >= 1 else f"{int(high * top):032x}"))
    found = _read_cuts(spark, hashed, label, label_type, ranges, quotas)
    missed = [c for c in counts if quotas[c] and c not in found]
    if missed:
        # Copies can crowd the hash range; search the classes concerned by key instead.
        for c in missed:
            border = key_at_rank(hashed.where(F.col(label) == F.lit(c)), [ROW_KEY], quotas[c] - 1, counts[c])
            found[c] = (border.key[0], quotas[c] - border.below, border.equal)
    return [(c, *found.get(c, ("", 0, 0))) for c in counts]


def _read_cuts(spark, hashed, label, label_type, ranges, quotas):
    table = F.broadcast(spark.createDataFrame(ranges, f"__label {label_type}, __low string, __high string"))
    ranged = hashed.select(label, ROW_KEY).join(table, F.col(label) == F.col("__label"))
    spot = F.when(F.col(ROW_KEY) < F.col("__low"), "").when(F.col(ROW_KEY) <= F.col("__high"), F.col(ROW_KEY))
    tally = (
        ranged.select(label, spot.alias("__spot")).where("__spot is not null").groupBy(label, "__spot").agg(F.count("*").alias("n"))
    )
    ordered = Window.partitionBy(label).orderBy("__spot")
    placed = tally.withColumn("through", F.sum("n").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
    wanted = F.broadcast(spark.createDataFrame([(c, q) for c, q in quotas.items() if q] or [], f"__label {label_type}, __quota long"))
    hit = placed.join(wanted, F.col(label) == F.col("__label")).where(
        "through >= __quota and through - n < __quota and __spot <> ''"
    )
    return {r[label]: (r["__spot"], r["__quota"] - (r["through"] - r["n"]), r["n"]) for r in hit.collect()}


def _split_copies(marked, names, is_test):
    """Rows that share the border hash: identical copies are shared out by number; distinct rows are an error."""
    at_border = (F.col(ROW_KEY) == F.col("__cut")) & (F.col("__take") < F.col("__equal"))
    apart = marked.where(~at_border).withColumn("split", F.when(is_test, "test").otherwise("train")).select(*names, "split")
    groups = marked.where(at_border).groupBy(*names, "__take", "__equal").agg(F.count("*").alias("__seen"))
    whole = F.when(
        F.col("__seen") != F.col("__equal"), F.raise_error(F.lit("the split key does not identify rows")).cast("long")
    ).otherwise(F.col("__take"))
    shares = F.array(
        F.struct(F.lit("test").alias("split"), whole.alias("__n")),
        F.struct(F.lit("train").alias("split"), (F.col("__equal") - F.col("__take")).alias("__n")),
    )
    return apart.unionByName(repeated(groups.select(*names, F.inline(shares)), "__n").select(*names, "split"))


def split_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(F.count("*").alias("n_rows"))
