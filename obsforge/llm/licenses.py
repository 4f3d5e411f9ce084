"""License scanning by ordered signature rules. DataFrame functions only.

Words in lower case are joined by single spaces. A rule is tried only on texts that hold its keyword. Detections that lie within
a longer one that stays are suppressed; of two that overlap otherwise, the one of the better priority stays.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsforge.llm.common import identified
from obsforge.llm.license_rules import BASE, Rule, rules
from obsforge.llm.spans import let, places

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_DETECTION = "struct<start:bigint,back:bigint,priority:int,label:string,confidence:double>"


def word_text(text: Column) -> Column:
    """The words, with one space before, between and after them; one space if there are none."""
    lower = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.regexp_replace(F.concat(F.lit(" "), lower, F.lit(" ")), SEPARATORS, " ")


def _phrase(pattern: Column) -> Column:
    """The pattern as whole words: with the space before, without the one after it."""
    return F.concat(F.lit(" (?:"), pattern, F.lit(")(?= )"))


def _spaces(text: Column) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))).cast("long")


def _rule_table(table: list[Rule]) -> Column:
    return F.array(*[F.struct(F.lit(r.keyword).alias("keyword"), F.lit(r.pattern).alias("pattern"), F.lit(r.label).alias("label"), F.lit(r.priority).alias("priority"), F.lit(r.confidence).alias("confidence")) for r in table])


def detections(words: Column, table: list[Rule]) -> Column:
    """All matches of the rules whose keyword occurs: (start, back = -end, priority, label, confidence), in that order."""

    def of(rule: Column) -> Column:
        found = places(words, _phrase(rule["pattern"]))
        return F.transform(found, lambda m: F.struct(m["start"].alias("start"), (-m["end"]).alias("back"), rule["priority"].alias("priority"), rule["label"].alias("label"), rule["confidence"].alias("confidence")))

    # One search tells whether a rule matches at all; only then its places are taken, which needs several.
    tried = F.filter(_rule_table(table), lambda r: F.contains(words, r["keyword"]) & F.rlike(words, _phrase(r["pattern"])))
    return F.array_sort(F.flatten(F.transform(tried, of)))


def _best_of(group: Column) -> Column:
    """What survives of detections that hang together by overlaps: (start, back, priority, label, confidence)."""
    ranked = F.array_sort(F.transform(group, lambda d: F.struct(d["priority"].alias("priority"), d["start"].alias("start"), d["back"].alias("back"), d["label"].alias("label"), d["confidence"].alias("confidence"))))

    def meets(a: Column, b: Column) -> Column:
        return (a["start"] < -b["back"]) & (b["start"] < -a["back"])

    def decided(kept: Column, new: Column) -> Column:
        def bars(old: Column) -> Column:
            inside = (old["start"] >= new["start"]) & (old["back"] >= new["back"])
            same = (old["start"] == new["start"]) & (old["back"] == new["back"])
            return meets(old, new) & (~inside | same)

        return F.when(F.exists(kept, bars), kept).otherwise(F.array_append(F.filter(kept, lambda old: ~meets(old, new)), new))

    return F.when(F.size(group) == 1, ranked).otherwise(F.aggregate(ranked, F.slice(ranked, 1, 0), decided))


def surviving(found: Column) -> Column:
    """(labels, confidence) after suppression of sorted detections.

    Detections are decided by priority, then start, the longer first. One that meets a kept detection is dropped, unless the kept
    ones that it meets all lie within it and are shorter: then it takes their place. So nothing is dropped that meets nothing kept.
    Groups that hang together by overlaps are decided one by one; time grows with the square of such a group, not of the text.
    """
    begin = F.struct(
        F.array().cast(f"array<{_DETECTION}>").alias("group"), F.lit(0).cast("bigint").alias("reach"),
        F.array().cast("array<string>").alias("labels"), F.lit(0.0).alias("confidence"),
    )

    def settled(state: Column) -> Column:
        def added(kept: Column) -> Column:
            return F.struct(
                F.array_union(state["labels"], F.transform(kept, lambda d: d["label"])).alias("labels"),
                F.greatest(state["confidence"], F.coalesce(F.array_max(F.transform(kept, lambda d: d["confidence"])), F.lit(0.0))).alias("confidence"),
            )

        return let(_best_of(state["group"]), added)

    def step(state: Column, new: Column) -> Column:
        def begun(after: Column) -> Column:
            return F.struct(F.array(new).alias("group"), (-new["back"]).alias("reach"), after["labels"].alias("labels"), after["confidence"].alias("confidence"))

        joined = F.struct(
            F.array_append(state["group"], new).alias("group"), F.greatest(state["reach"], -new["back"]).alias("reach"),
            state["labels"].alias("labels"), state["confidence"].alias("confidence"),
        )
        return F.when(new["start"] < state["reach"], joined).otherwise(let(settled(state), begun))

    return F.aggregate(found, begin, step, settled)


def scan_licenses(docs: DataFrame, table: list[Rule] | None = None) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score for every row of (doc_id, text, any other columns).

    n_base counts all places of the base phrases, first_word and last_word are their smallest and largest word index. labels
    holds base_labels and those of the surviving rule detections; score is the largest confidence among them (1 for a base
    phrase, 0 without any). Null and empty texts have no words. Repeated rows repeat their result; an empty table gives none.
    """
    table = rules() if table is None else table
    words = F.col("words")
    rows = identified(docs, "text").select("doc_id", word_text(F.col("text")).alias("words"))
    strings, longs = F.array().cast("array<string>"), F.array().cast("array<bigint>")
    starts = [
        F.when(F.contains(words, F.lit(f" {p} ")), F.transform(places(words, _phrase(F.lit(p))), lambda m: _spaces(words.substr(F.lit(1), m["start"].cast("int"))))).otherwise(longs)
        for p, _ in BASE
    ]
    gate = reduce(lambda a, b: a | b, [F.contains(words, F.lit(k)) for k in sorted({r.keyword for r in table})])
    nothing = F.struct(strings.alias("labels"), F.lit(0.0).alias("confidence"))
    rows = rows.select(
        "doc_id",
        (_spaces(words) - 1).alias("n_words"),
        F.array(*starts).alias("starts"),
        F.when(gate, surviving(detections(words, table))).otherwise(nothing).alias("rule"),
    )
    every = F.flatten("starts")
    base = F.filter(F.array(*[F.when(F.size(F.get("starts", F.lit(i))) > 0, F.lit(label)) for i, (_, label) in enumerate(BASE)]), lambda l: l.isNotNull())
    return rows.select(
        "doc_id", "n_words",
        F.size(every).cast("long").alias("n_base"),
        F.array_min(every).alias("first_word"),
        F.array_max(every).alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, F.col("rule.labels"))), ",").alias("labels"),
        F.when(F.size(every) > 0, F.lit(1.0)).otherwise(F.col("rule.confidence")).alias("score"),
    )
