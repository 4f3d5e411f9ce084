"""Quality rules: a decision list of threshold conjunctions learned from labelled statistics. DataFrame functions only.

Statistics of whole texts are columns. Sequential covering grows a conjunction on one part of the labelled rows by information gain,
prunes it on the other part, keeps it if it is right often enough, takes away what it covers and goes on. The list becomes
one ordered conditional expression. Rows are counted by Spark; the driver sees counts per statistic and threshold only.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsforge.llm.common import GAP_CHARACTERS, Intermediate, identified
from obsforge.llm.filter_audit import count_of, word_array

# Labelled rows a list is learned from; beyond that a share of all, by a hash of doc_id.
MAX_LABELLED = 20_000
CUTS, TERMS, RULES = 32, 4, 16
# A rule stays if, on all labelled rows it reaches, it covers so many of its class and is right in this share.
LEAST_COVER, PRECISION = 5, 0.9
# Of three parts of the labelled rows, one is for pruning.
PARTS = 3

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_capitals", "n_digits", "n_stops"]
STATISTICS = [
    "words", "word_length", "symbols_per_word", "repeat_share", "dup_line_share", "distinct_share", "capital_share", "digit_share",
    "stop_share", "line_words",
]


def _neighbours(sorted_items: Column, same, of) -> Column:
    """The distinct numbers of(item) of all items of a sorted array that are the same as one beside them, sorted."""
    n = F.size(sorted_items)
    shorter = F.greatest(n - 1, F.lit(0))
    pairs = F.zip_with(F.slice(sorted_items, 1, shorter), F.slice(sorted_items, 2, shorter), lambda a, b: F.when(same(a, b), F.array(of(a), of(b))))
    return F.sort_array(F.array_distinct(F.flatten(F.filter(pairs, lambda p: p.isNotNull()))))


def _with_repeats(rows: DataFrame, window: int = 3) -> DataFrame:
    """Adds n_repeat_words: words of `list` that lie in a window of consecutive words which occurs twice or more in the list.

    Window hashes and places share one number, so that one sort of numbers brings equal windows together whatever their
    count; those that meet are compared again by their words.
    """
    most = F.greatest(F.size("list") - (window - 1), F.lit(0))
    rows = rows.withColumn("__bits", F.ceil(F.log2(F.size("list") + F.lit(2))).cast("int"))
    shifted = F.arrays_zip(*[F.slice("list", k, most).alias(f"w{k}") for k in range(1, window + 1)])

    def marked(w: Column, at: Column) -> Column:
        hashed = F.xxhash64(*[w[f"w{k}"] for k in range(1, window + 1)])
        return F.call_function("shiftleft", F.call_function("shiftright", hashed, F.col("__bits")), F.col("__bits")).bitwiseOR(at.cast("long"))

    rows = rows.withColumn("__windows", F.sort_array(F.transform(shifted, marked)))
    alike = _neighbours(
        F.col("__windows"),
        lambda a, b: F.call_function("shiftright", a.bitwiseXOR(b), F.col("__bits")) == 0,
        lambda a: (a - F.call_function("shiftleft", F.call_function("shiftright", a, F.col("__bits")), F.col("__bits"))).cast("int"),
    )
    rows = rows.withColumn("__alike", alike).drop("__windows")
    told = F.transform("__alike", lambda p: F.struct(F.concat_ws(" ", *[F.get("list", p + k) for k in range(window)]).alias("w"), p.alias("p")))
    rows = rows.withColumn("__told", F.sort_array(told))
    rows = rows.withColumn("__starts", _neighbours(F.col("__told"), lambda a, b: a["w"] == b["w"], lambda a: a["p"])).drop("__told", "__alike")
    steps = F.zip_with("__starts", F.slice("__starts", 2, F.greatest(F.size("__starts"), F.lit(1))), lambda a, b: F.least(F.coalesce(b - a, F.lit(window)), F.lit(window)))
    total = F.aggregate(steps, F.lit(0).cast("long"), lambda done, x: done + x)
    return rows.withColumn("n_repeat_words", total).drop("__starts", "__bits")


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and COUNTS (long) of every whole text; null text is empty."""
    rows = identified(docs, "text").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    full = F.filter(F.split("text", "\n"), lambda line: F.length(F.btrim(line, F.lit(GAP_CHARACTERS))) > 0)
    rows = rows.select("doc_id", "text", word_array(F.col("text")).alias("list"), full.alias("lines"))
    rows = _with_repeats(rows)
    return rows.select(
        "doc_id",
        F.size("list").cast("long").alias("n_words"),
        F.length(F.concat_ws("", "list")).cast("long").alias("word_chars"),
        count_of(F.col("text"), "#*$%&|<>").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        F.size("lines").cast("long").alias("n_lines"),
        F.size(F.array_distinct("list")).cast("long").alias("n_distinct"),
        count_of(F.col("text"), "A-Z").alias("n_capitals"),
        count_of(F.col("text"), "0-9").alias("n_digits"),
        count_of(F.col("text"), r""".,;:'"()!?\-""").alias("n_stops"),
    )


def measures() -> dict[str, Column]:
    """STATISTICS as columns over COUNTS; 0 for a text without words."""

    def share(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))

    columns = [
        F.col("n_words").cast("double"), share("word_chars", "n_words"), share("n_symbols", "n_words"), share("n_repeat_words", "n_words"),
        share("n_dup_lines", "n_lines"), share("n_distinct", "n_words"), share("n_capitals", "word_chars"), share("n_digits", "word_chars"),
        share("n_stops", "word_chars"), share("n_words", "n_lines"),
    ]
    return dict(zip(STATISTICS, columns, strict=True))


class Term(NamedTuple):
    """A threshold on a statistic: above it, or not above it."""

    statistic: str
    above: bool
    bound: float

    def column(self, of: dict[str, Column]) -> Column:
        return of[self.statistic] > self.bound if self.above else of[self.statistic] <= self.bound


class Rule(NamedTuple):
    terms: tuple[Term, ...]
    verdict: int

    def column(self, of: dict[str, Column]) -> Column:
        out = F.lit(True)
        for term in self.terms:
            out = out & term.column(of)
        return out


class DecisionList(NamedTuple):
    """The verdict of the first rule that holds, else the default."""

    rules: tuple[Rule, ...]
    default: int

    def column(self, of: dict[str, Column] | None = None) -> Column:
        of = measures() if of is None else of
        out = F.lit(self.default)
        for rule in reversed(self.rules):
            out = F.when(rule.column(of), F.lit(rule.verdict)).otherwise(out)
        return out

    def __str__(self) -> str:
        lines = [" and ".join(f"{t.statistic} {'>' if t.above else '<='} {t.bound:g}" for t in r.terms) + f" -> {r.verdict}" for r in self.rules]
        return "\n".join([*lines, f"else -> {self.default}"])


def _information(p: float, n: float) -> float:
    return math.log2(p / (p + n)) if p else 0.0


class Learner:
    """Counts over a written table of (label 0/1, prune boolean, statistics) that sequential covering asks for."""

    def __init__(self, table: DataFrame, names: list[str], cuts: int = CUTS):
        self.table, self.names = table, names
        self.of = {name: F.col(name) for name in names}
        ranks = [k / cuts for k in range(cuts)]
        rows = table.groupBy("label").agg(*[F.percentile(name, ranks).alias(name) for name in names]).collect()
        # Thresholds are quantiles of either class, so a class of few rows has its own.
        self.cuts = {name: sorted({bound for row in rows for bound in row[name]}) for name in names}
        self.bins = F.array(*[self._cuts_below(name) for name in names])

    def _cuts_below(self, name: str) -> Column:
        return F.size(F.filter(F.lit(self.cuts[name]), lambda bound: bound < F.col(name)))

    def counts(self, conditions: list[Column]) -> list[tuple[int, int]]:
        """(rows of label 0, of label 1) under each condition."""
        sums = [F.sum(F.when(c & (F.col("label") == label), 1).otherwise(0)) for c in conditions for label in (0, 1)]
        row = self.table.agg(*[F.coalesce(s, F.lit(0)).alias(f"c{k}") for k, s in enumerate(sums)]).first()
        return [(row[2 * k], row[2 * k + 1]) for k in range(len(conditions))]

    def best_term(self, reached: Column, verdict: int) -> Term | None:
        """The threshold with the largest gain of information for the verdict's class, the first of equal ones; None if none gains.

        Its bound lies half-way to the next larger value among the reached rows.
        """
        bins = self.table.where(reached).select("label", F.posexplode(self.bins).alias("at", "bin"))
        rows = bins.groupBy("at", "bin").agg(F.sum((F.col("label") == verdict).cast("long")).alias("p"), F.count(F.lit(1)).alias("all")).collect()
        by_place: dict[int, dict[int, tuple[int, int]]] = {}
        for row in rows:
            by_place.setdefault(row["at"], {})[row["bin"]] = (row["p"], row["all"] - row["p"])
        best, term = 1e-9, None
        for at, name in enumerate(self.names):
            here = by_place.get(at, {})
            p, n = sum(c[0] for c in here.values()), sum(c[1] for c in here.values())
            low_p = low_n = 0
            for k, bound in enumerate(self.cuts[name]):
                low_p, low_n = low_p + here.get(k, (0, 0))[0], low_n + here.get(k, (0, 0))[1]
                for above, q, m in ((False, low_p, low_n), (True, p - low_p, n - low_n)):
                    gain = q * (_information(q, m) - _information(p, n))
                    if gain > best:
                        best, term = gain, Term(name, above, bound)
        if term is None:
            return None
        value = F.col(term.statistic)
        above = self.table.where(reached).agg(F.min(F.when(value > term.bound, value)).alias("next")).first()["next"]
        return term if above is None else term._replace(bound=(term.bound + above) / 2)

    def rule(self, left: Column, verdict: int) -> tuple[Rule, int, int] | None:
        """Grown on the growing part of `left`, pruned on the other: the rule, and what it covers of its class and of the other."""
        terms: list[Term] = []
        reached = left & ~F.col("prune")
        while len(terms) < TERMS:
            term = self.best_term(reached, verdict)
            if term is None:
                break
            terms.append(term)
            reached = reached & term.column(self.of)
        if not terms:
            return None
        heads = [Rule(tuple(terms[:k]), verdict) for k in range(1, len(terms) + 1)]
        counted = self.counts([left & F.col("prune") & h.column(self.of) for h in heads] + [left & h.column(self.of) for h in heads])
        worth = [(c[verdict] - c[1 - verdict]) / max(1, sum(c)) for c in counted[: len(heads)]]
        at = max(range(len(heads)), key=lambda k: (worth[k], -k))
        whole = counted[len(heads) + at]
        return heads[at], whole[verdict], whole[1 - verdict]


def learn(table: DataFrame, names: list[str], cuts: int = CUTS, most_rules: int = RULES) -> DecisionList:
    """A decision list from a written table of (label 0/1, prune, statistics); the rarer class of what is left is covered next.

    Without rows, or with one class only, the list is empty; its default is the commoner class of what no rule covers, 1 on a tie.
    """
    left, rules = F.lit(True), []
    zero, one = (table.where(F.col("label") == k).count() for k in (0, 1))
    learner = Learner(table, names, cuts) if zero and one else None
    while learner and zero and one and len(rules) < most_rules:
        verdict = 0 if zero <= one else 1
        found = learner.rule(left, verdict)
        if found is None or found[1] < LEAST_COVER or found[1] < PRECISION * (found[1] + found[2]):
            break
        rule, own, other = found
        rules.append(rule)
        left = left & ~rule.column(learner.of)
        zero, one = (zero - own, one - other) if verdict == 0 else (zero - other, one - own)
    return DecisionList(tuple(rules), 0 if zero > one else 1)


def fit(counted: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> DecisionList:
    """The list for a written table of (doc_id, COUNTS) and labels (doc_id, label 0/1); rows without label are ignored.

    At most about `most` labelled rows are used, a share of all by hash of doc_id; every third, by another hash, prunes.
    """
    named = labels.where("doc_id IS NOT NULL AND label IN (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label"))
    with Intermediate(counted.sparkSession) as steps:
        rows = counted.join(named, "doc_id").select("doc_id", "label", *[c.alias(name) for name, c in measures().items()])
        rows = steps.written(rows, "labelled")
        n = rows.count()
        if n > most:
            rows = rows.where(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1_000_000)) < int(1e6 * most / n))
        part = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(PARTS)) == 0
        table = steps.written(rows.select("label", part.alias("prune"), *STATISTICS).coalesce(2), "learning")
        return learn(table, STATISTICS)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def judged(counted: DataFrame, rules: DecisionList) -> DataFrame:
    """All columns of `counted` (doc_id, COUNTS), base_failed, verdict (the list's: 1 good) and kept."""
    rows = counted.select("*", base_failed().alias("base_failed"), rules.column().alias("verdict"))
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("verdict") == 1))


def quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, COUNTS, base_failed, verdict, kept for every row of (doc_id, text, any other columns).

    `labels` has (doc_id, label 0/1); of several labels of a doc_id the larger counts. Null and empty texts have zero counts and
    fail the base rules. Repeated rows repeat their result; an empty table gives no rows. Columns lang and source are never read.
    """
    with Intermediate(docs.sparkSession) as steps:
        counted = steps.written(statistics(docs), "counts")
        return steps.result(judged(counted, fit(counted, labels)), "judged")
