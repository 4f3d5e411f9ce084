"""Benchmark decontamination by templates: numbers, names and units become typed slots before windows are matched.

Windows of template tokens of the benchmark are hash-joined with those of all documents that hold the window's two rarest
words at their places; all others cannot be equal, and their hashes are not taken. Windows with names are matched in a
second form as well, with the names as words in lower case, so letter case hides nothing; windows that even so have too few words
are matched by their own words, numbers and units. Windows that meet on one diagonal
(document position minus item position) form one occurrence of the item; its slots must be filled consistently, that is, each
value of the item stands for one value in the document. A question asked anew with other numbers or names has the same
template and consistent slots, so it is found as well. Built from DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsforge.llm.common import attach, identified, small_enough
from obsforge.session import written

WINDOW = 8  # template tokens; shorter items are one window
MIN_WORDS = 5  # items with fewer words cannot be told from ordinary text and match nothing
MIN_LITERALS = 4  # a window needs so many tokens that are not slots, or half of its tokens if it is shorter than WINDOW
MIN_SHARE = 0.5  # part of an item's windows that must occur with consistent slots,
MIN_RUN = 13  # or tokens in a row, whatever their share of the item
UNITS = (
    "mm cm m km in ft yd mi mg g kg t lb oz ml cl l gal s sec secs min mins h hr hrs hour hours minute minutes second seconds day days "
    "week weeks month months year years percent dollar dollars euro euros cent cents pound pounds mile miles meter meters metre metres "
    "kilometer kilometers kilometre kilometres gram grams kilogram kilograms liter liters litre litres degree degrees hz khz mhz kw w v"
).split()

NUMBER, NAME, UNIT = "<n>", "<name>", "<u>"


def plain_words(text: Column) -> Column:
    """The words of a text joined by single spaces: runs of letters and digits, decimal points and commas within numbers kept."""
    joined = F.regexp_replace(F.coalesce(text, F.lit("")), r"[.,](?<=\p{N}[.,])(?=\p{N})", "·")
    return F.trim(F.regexp_replace(joined, r"[^\p{L}\p{M}\p{N}·]+", " "))


def _numbers(words: Column) -> Column:
    return F.regexp_replace(words, r"(^| )\p{N}[^ ]*", f"$1{NUMBER}")


def _units(lower: Column) -> Column:
    return F.regexp_replace(lower, rf"(?<={NUMBER} )({'|'.join(UNITS)})(?= |$)", UNIT)


def template(words: Column) -> Column:
    """Same words with typed slots: tokens that begin with a digit, capitalised words, and a unit after a number."""
    return _units(F.lower(F.regexp_replace(_numbers(words), r"(^| )\p{Lu}[\p{Ll}\p{M}]+(?= |$)", f"$1{NAME}")))


def folded(words: Column) -> Column:
    """The template without slots for names: capitalised words are words in lower case."""
    return _units(F.lower(_numbers(words)))


def _forms(words: Column) -> list[Column]:
    """words, and tokens of the three forms: template, folded, and the words themselves in lower case."""
    forms = {"words": words, "tokens": template(words), "folded": folded(words), "lower": F.lower(words)}
    return [F.split(c, " ").alias(n) for n, c in forms.items()]


def _literals(length: Column) -> Column:
    """Tokens of a window that must not be slots."""
    return F.least(F.lit(MIN_LITERALS), F.ceil(length / 2))


def _starts(tokens: Column, length: Column) -> Column:
    return F.when(F.size(tokens) >= length, F.sequence(F.lit(1), F.size(tokens) - length + 1)).otherwise(F.array().cast("array<int>"))


def _named(at: Column, length: Column) -> Column:
    """Whether the template has a name in this window, so that the folded form differs."""
    return F.array_contains(F.slice("tokens", at, length), NAME)


def _few(at: Column, length: Column) -> Column:
    """Whether even the folded form of this window has too few words."""
    return F.size(F.array_remove(F.array_remove(F.slice("folded", at, length), NUMBER), UNIT)) < _literals(length)


def _windows(starts: Column, tokens: str, length: Column, form: int) -> Column:
    """Array of (position, form, hash) of the windows of `length` tokens from `starts` on."""
    return F.transform(starts, lambda i: F.struct(i.alias("at"), F.lit(form).alias("form"), F.xxhash64(F.slice(tokens, i, length), length).alias("h")))


def _all_windows(length: Column, own: bool = True) -> Column:
    """Windows of every form: all as templates, those with names also folded, those of few words (if `own`) by their own words."""
    starts, none = _starts(F.col("tokens"), length), F.array().cast("array<int>")
    names = F.when(F.array_contains("tokens", NAME), F.filter(starts, lambda i: _named(i, length))).otherwise(none)
    found = [_windows(starts, "tokens", length, 0), _windows(names, "folded", length, 1)]
    if own:
        few = F.when(F.array_contains("folded", NUMBER), F.filter(starts, lambda i: _few(i, length))).otherwise(none)
        found.append(_windows(few, "lower", length, 2))
    return F.concat(*found)


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item_id, n_told, n_windows, length, at, form, h, words, tokens) for every window of every item in every form that tells it
    from ordinary text; n_told counts those of the template form, n_windows all places. Repeated items count once."""
    items = benchmark.select("item_id", plain_words(F.col("text")).alias("p")).where("item_id IS NOT NULL").distinct()
    items = items.select("item_id", *_forms(F.col("p")))
    items = items.where(F.size("words") >= MIN_WORDS).withColumn("length", F.least(F.lit(window), F.size("tokens")))
    spread = items.withColumn("w", F.explode(_all_windows(F.col("length")))).select("item_id", "length", "words", "tokens", "folded", "w.at", "w.form", "w.h")
    slots = F.size(F.filter(F.slice("tokens", F.col("at"), F.col("length")), lambda t: t.isin(NUMBER, NAME, UNIT)))
    tells = F.when(F.col("form") == 0, F.col("length") - slots >= _literals(F.col("length"))).when(F.col("form") == 1, ~_few(F.col("at"), F.col("length"))).otherwise(True)
    told = spread.where(tells).drop("folded")
    counts = told.groupBy("item_id").agg(F.countDistinct(F.when(F.col("form") == 0, F.col("at"))).alias("n_told"), F.countDistinct("at").alias("n_windows"))
    return told.join(counts, "item_id")


def anchors(known: DataFrame) -> DataFrame:
    """(word, spots): for every window of the benchmark the word, no slot, that is rarest among the items, and where it stands.

    spots holds each (length of the window, offset of the word, next rarest word, its offset) once; the next is the word itself
    in a window without another.
    """
    words = F.transform("words", lambda w: F.lower(w))
    often = known.select("item_id", "words").distinct().select(F.explode(words).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    slots = F.when(F.col("form") == 0, F.array(*map(F.lit, (NUMBER, NAME, UNIT)))).when(F.col("form") == 1, F.array(F.lit(NUMBER), F.lit(UNIT))).otherwise(F.array(F.lit("")))
    each = known.select("item_id", "form", "at", "length", slots.alias("slots"), F.posexplode(F.arrays_zip(F.slice(words, F.col("at"), F.col("length")).alias("w"), F.slice("tokens", F.col("at"), F.col("length")).alias("t"))).alias("offset", "one"))
    plain = each.where(~F.array_contains("slots", F.col("one.t"))).withColumn("word", F.col("one.w")).join(often, "word")
    ranked = F.sort_array(F.collect_list(F.struct("n", (-F.length("word")).alias("short"), "word", "offset")))  # at most `length` words
    best = plain.groupBy("item_id", "form", "at", "length").agg(ranked.alias("ranked"))
    first, second = F.get("ranked", F.lit(0)), F.coalesce(F.get("ranked", F.lit(1)), F.get("ranked", F.lit(0)))
    spot = F.struct("length", first["offset"].alias("offset"), second["word"].alias("other"), second["offset"].alias("other_offset"))
    return best.groupBy(first["word"].alias("word")).agg(F.collect_set(spot).alias("spots"))


def _anchored(docs: DataFrame, spots: DataFrame, own: list[int]) -> DataFrame:
    """(doc_id, at, h) of the documents' windows, in every form, in which both words of a spot (`spots` is small) lie at their places.

    Words are compared in lower case, in which a word that is no slot stands in every form. The forms of a window follow from
    its words and the one before it.
    """
    words = identified(docs, "text").select("doc_id", F.split(plain_words(F.col("text")), " ").alias("words"))
    each = words.select("doc_id", "words", F.posexplode_outer("words").alias("place", "w"))
    met = each.join(F.broadcast(spots), F.lower("w") == F.col("word")).select("doc_id", "words", "place", F.explode("spots").alias("spot"))
    met = met.select("doc_id", "words", (F.col("place") - F.col("spot.offset") + 1).alias("at"), F.col("spot.length").alias("length"), "spot")
    met = met.where((F.col("at") >= 1) & (F.col("at") + F.col("length") - 1 <= F.size("words")))
    met = met.where(F.lower(F.get("words", F.col("at") + F.col("spot.other_offset") - 1)) == F.col("spot.other"))
    later = (F.col("at") > 1).cast("int")
    met = met.select("doc_id", "at", "length", later.alias("later"), F.array_join(F.slice("words", F.col("at") - later, F.col("length") + later), " ").alias("text"))
    forms = {"tokens": template(F.col("text")), "folded": folded(F.col("text")), "lower": F.lower("text")}
    met = met.select("doc_id", "at", "length", *[F.slice(F.split(c, " "), F.col("later") + 1, F.col("length")).alias(n) for n, c in forms.items()])
    h = {n: F.xxhash64(n, "length") for n in forms}
    few = F.size(F.array_remove(F.array_remove("folded", NUMBER), UNIT)) < _literals(F.col("length"))
    by_words = F.when(few & F.col("length").isin(own), h["lower"]) if own else F.lit(None).cast("long")
    return met.select("doc_id", "at", F.explode(F.array_distinct(F.array(h["tokens"], h["folded"], by_words))).alias("h")).where("h IS NOT NULL")


def _all_anywhere(docs: DataFrame, lengths: list[tuple[int, bool]]) -> DataFrame:
    """(doc_id, at, h) of all windows of all documents, in every form."""
    tokens = identified(docs, "text").select("doc_id", *_forms(plain_words(F.col("text"))))
    spread = F.array(*[_all_windows(F.lit(n), own) for n, own in lengths]) if lengths else F.array().cast("array<array<struct<at:int,form:int,h:bigint>>>")
    return tokens.select("doc_id", F.explode(F.flatten(spread)).alias("w")).select("doc_id", "w.at", "w.h")


def _found(lines: DataFrame, min_share: float) -> DataFrame:
    """(doc_id, item_id, share) of the items of which enough is found on the lines together, or enough in a row on one of them."""
    steps = F.greatest(F.lit(1), F.lit(MIN_RUN + 1) - F.col("length"))
    ordered = F.array_sort("places")
    row = F.exists(F.zip_with(ordered, F.slice(ordered, steps, F.size(ordered)), lambda a, b: F.coalesce(b - a == steps - 1, F.lit(False))), lambda x: x)
    each = lines.withColumn("row", row & (F.col("length") + steps > MIN_RUN)).groupBy("doc_id", "item_id", "n_told", "n_windows")
    count = lambda name: F.size(F.array_distinct(F.flatten(F.collect_list(name))))
    total = each.agg(count("told").alias("t"), count("places").alias("n"), F.max("row").alias("row"))
    share = F.greatest(F.coalesce(F.try_divide(F.col("t"), F.col("n_told")), F.lit(0.0)), F.col("n") / F.col("n_windows"))
    return total.withColumn("share", share).where((F.col("share") >= min_share) | F.col("row")).select("doc_id", "item_id", "share")


def occurrences(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, min_share: float = MIN_SHARE) -> DataFrame:
    """(doc_id, item_id, share) for each document and item of which at least `min_share` of the windows, or windows that cover
    MIN_RUN tokens in a row, occur in it.

    share is the part of the item's windows found on diagonals with consistent slots: of those of the template form or of all
    places in any form, whichever is larger.
    """
    known = written(benchmark_windows(benchmark, window), "benchmark-windows")
    lengths = [(r["length"], r["own"]) for r in known.groupBy("length").agg(F.max(F.col("form") == 2).alias("own")).collect()]  # at most `window` values
    spots = written(anchors(known), "benchmark-anchors")
    # Without a bound on the words of the benchmark all windows are hashed; the join finds the same ones.
    found = _anchored(docs, spots, [n for n, o in lengths if o]) if small_enough(spots, F.lit(64) + 64 * F.size("spots")) else _all_anywhere(docs, lengths)
    marks = known.select("item_id", "length", "n_told", "n_windows", "form", F.col("at").alias("item_at"), "h")
    near = F.broadcast(marks) if small_enough(marks) else marks
    hits = found.join(near, "h").select("doc_id", "item_id", "length", "n_told", "n_windows", "at", "item_at", "form")
    # Windows that stand on one diagonal are one occurrence; their number is bounded by the item's windows.
    lines = hits.groupBy("doc_id", "item_id", "n_told", "n_windows", "length", (F.col("at") - F.col("item_at")).alias("shift"))
    lines = lines.agg(F.collect_set("item_at").alias("places"), F.collect_set(F.when(F.col("form") == 0, F.col("item_at"))).alias("told"))
    lines = written(lines, "benchmark-lines")
    likely = written(_found(lines, min_share).select("doc_id", "item_id"), "benchmark-pairs")

    lines = attach(lines, likely, ["doc_id", "item_id"], "left_semi")
    texts = attach(identified(docs, "text"), written(likely.select("doc_id").distinct(), "suspects"), ["doc_id"], "left_semi")
    texts = texts.select(F.col("doc_id").alias("d"), F.split(plain_words(F.col("text")), " ").alias("doc_words"))
    items = known.select(F.col("item_id").alias("i"), F.col("words"), F.col("tokens")).distinct()
    rows = lines.join(texts, F.col("doc_id").eqNullSafe(F.col("d"))).join(items, F.col("item_id") == F.col("i"))
    covered = F.array_distinct(F.flatten(F.transform("places", lambda p: F.sequence(p, p + F.col("length") - 1))))
    slots = F.filter(covered, lambda p: F.element_at("tokens", p).isin(NUMBER, NAME, UNIT))
    values = F.array_distinct(F.transform(slots, lambda p: F.struct(F.lower(F.element_at("words", p)).alias("item"), F.lower(F.get("doc_words", p + F.col("shift") - 1)).alias("doc"))))
    consistent = F.size(values) == F.size(F.array_distinct(F.transform(values, lambda v: v["item"])))
    return _found(rows.where(consistent), min_share)


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, min_share: float = MIN_SHARE) -> DataFrame:
    """doc_id, contaminated, n_items, item_ids (ascending, comma-joined), share (largest) for every row of `docs`.

    docs: (doc_id, text, any other columns); benchmark: (item_id, text, any other columns). Null and empty texts hold nothing;
    items without id, without text or with fewer than MIN_WORDS words match nothing. Each row is judged by its own text, also if
    its doc_id is null or repeats. Empty tables give no rows, or none contaminated.
    """
    numbered = written(identified(docs, "text").withColumn("__row", F.monotonically_increasing_id()), "rows")
    pairs = occurrences(numbered.select(F.col("__row").alias("doc_id"), "text"), benchmark, window, min_share)
    each = pairs.groupBy(F.col("doc_id").alias("__row")).agg(F.array_sort(F.collect_set("item_id")).alias("ids"), F.max("share").alias("share"))
    rows = attach(numbered.drop("text"), written(each, "contaminated"), ["__row"], "left", F.lit(32) + 16 * F.size("ids"))
    return rows.select(
        "doc_id",
        F.col("ids").isNotNull().alias("contaminated"),
        F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_items"),
        F.array_join(F.coalesce(F.col("ids").cast("array<string>"), F.array().cast("array<string>")), ",").alias("item_ids"),
        F.coalesce("share", F.lit(0.0)).alias("share"),
    )
