import math
import random
from collections import Counter

import numpy as np
import pytest
from obsforge.llm import quality_rules
from obsforge.llm.quality_rules import COUNTS, STATISTICS, DecisionList, Rule, Term, fit, judged, learn, measures, quality_rules as operator, statistics
from pyspark.sql import functions as F

from .helpers import edges, frame, prose, words_of


def brute_counts(text):
    text = text or ""
    w = words_of(text)
    lines = [x for x in text.split("\n") if words_of(x)]
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    times = Counter(windows)
    covered = {j for i, x in enumerate(windows) if times[x] > 1 for j in range(i, i + 3)}

    def some(characters):
        return sum(c in characters for c in text)

    digits, capitals = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return [len(w), sum(map(len, w)), some("#*$%&|<>"), len(lines) - len(set(lines)), len(covered), len(lines), len(set(w)), some(capitals), some(digits), some(".,;:'\"()!?-")]


def strange():
    rng = random.Random(4)
    texts = [
        "a b c a b c", "a b c d", "a b c", "a a a a", "a b a b a b x a b a", "one two three\none two three\n\none two three ", "x\n x\nx \n\tx\n", "#*$%&|<> 1234 ABC.,;:'\"()!?-",
        "ab c d e abc d e", "a\x00b \x00 c", "\U0001d49c\U0001d49c 日本 " * 40, "w " * 5000, " ".join(rng.choice("abcdefgh") for _ in range(3000)),
    ]
    texts += [" ".join(rng.choice("ab") for _ in range(rng.randrange(1, 12))) for _ in range(60)]
    return [(r[0], r[1]) for r in edges()] + [(1000 + i, t) for i, t in enumerate(texts)]


def test_counts_against_plain_python(spark):
    rows = strange()
    got = sorted(repr([r["doc_id"], *[r[c] for c in COUNTS]]) for r in statistics(frame(spark, rows)).collect())
    assert got == sorted(repr([i, *brute_counts(t)]) for i, t in rows)


def test_windows_whose_hashes_meet_are_compared_by_words(spark, monkeypatch):
    monkeypatch.setattr(quality_rules.F, "xxhash64", lambda *c: F.length(c[0]).cast("long") * 0)
    rows = [(i, t) for i, t in strange() if t is None or len(t) < 2000]
    got = sorted(repr([r["doc_id"], r["n_repeat_words"]]) for r in statistics(frame(spark, rows)).collect())
    assert got == sorted(repr([i, brute_counts(t)[4]]) for i, t in rows)


def test_statistics_run_in_the_jvm(spark):
    plan = judged(statistics(frame(spark, strange())), DecisionList((), 1))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def brute_list(rows, names):
    """Sequential covering in plain Python over (label, prune, values...) rows."""
    cuts = {n: sorted({float(np.percentile([r[2 + k] for r in rows if r[0] == l], 100 * q / quality_rules.CUTS)) for l in (0, 1) for q in range(quality_rules.CUTS)}) for k, n in enumerate(names)}

    def holds(row, term):
        return (row[2 + names.index(term[0])] > term[2]) == term[1]

    def info(p, n):
        return math.log2(p / (p + n)) if p else 0.0

    left, rules = list(rows), []
    while True:
        count = Counter(r[0] for r in left)
        if not count[0] or not count[1]:
            break
        verdict = 0 if count[0] <= count[1] else 1
        reached, terms = [r for r in left if not r[1]], []
        while len(terms) < quality_rules.TERMS:
            best = (1e-9, None)
            p = sum(r[0] == verdict for r in reached)
            n = len(reached) - p
            for name in names:
                for bound in cuts[name]:
                    for above in (False, True):
                        some = [r for r in reached if holds(r, (name, above, bound))]
                        q = sum(r[0] == verdict for r in some)
                        gain = q * (info(q, len(some) - q) - info(p, n))
                        if gain > best[0]:
                            best = (gain, (name, above, bound))
            if best[1] is None:
                break
            name, above, bound = best[1]
            beyond = [r[2 + names.index(name)] for r in reached if r[2 + names.index(name)] > bound]
            terms.append((name, above, (bound + min(beyond)) / 2 if beyond else bound))
            reached = [r for r in reached if holds(r, terms[-1])]
        if not terms:
            break
        worth = []
        for k in range(1, len(terms) + 1):
            pruning = [r[0] == verdict for r in left if r[1] and all(holds(r, t) for t in terms[:k])]
            worth.append((2 * sum(pruning) - len(pruning)) / max(1, len(pruning)))
        terms = terms[: 1 + worth.index(max(worth))]
        covered = [r for r in left if all(holds(r, t) for t in terms)]
        own = sum(r[0] == verdict for r in covered)
        if own < quality_rules.LEAST_COVER or own < quality_rules.PRECISION * len(covered):
            break
        rules.append((terms, verdict))
        left = [r for r in left if not all(holds(r, t) for t in terms)]
    count = Counter(r[0] for r in left)
    return rules, 0 if count[0] > count[1] else 1


@pytest.mark.parametrize("seed", [1, 2])
def test_list_against_plain_covering(spark, seed):
    rng = random.Random(seed)
    rows = []
    for _ in range(900):
        a, b, c = rng.randrange(12), rng.random(), rng.randrange(3)
        bad = (a > 8 and b < 0.5) or (c == 2 and b > 0.9) or rng.random() < 0.01
        rows.append((0 if bad else 1, rng.random() < 0.33, float(a), b, float(c)))
    table = spark.createDataFrame(rows, "label int, prune boolean, a double, b double, c double")
    rules, default = brute_list(rows, ["a", "b", "c"])
    got = learn(table, ["a", "b", "c"])
    assert got.default == default and len(got.rules) == len(rules) >= 2
    for rule, (terms, verdict) in zip(got.rules, rules):
        assert rule.verdict == verdict and [t[:2] for t in rule.terms] == [t[:2] for t in terms]
        assert [t.bound for t in rule.terms] == pytest.approx([t[2] for t in terms])


def test_first_rule_that_holds_decides(spark):
    rules = DecisionList((Rule((Term("a", True, 5.0), Term("b", False, 1.0)), 0), Rule((Term("a", True, 5.0),), 1), Rule((), 0)), 1)
    table = spark.createDataFrame([(6.0, 1.0), (6.0, 2.0), (5.0, 0.0)], "a double, b double")
    got = table.select("a", "b", rules.column({"a": F.col("a"), "b": F.col("b")}).alias("v")).collect()
    assert {(r["a"], r["b"]): r["v"] for r in got} == {(6.0, 1.0): 0, (6.0, 2.0): 1, (5.0, 0.0): 0}
    assert "a > 5 and b <= 1 -> 0" in str(rules)


def junk(seed):
    kind, text = seed % 3, prose(seed, 120)
    if kind == 0:
        return " ".join(w + "###" for w in text.split())
    return (text[:10] + " ") * 60 if kind == 1 else "\n".join([text[:60]] * 30)


def labelled():
    rows = [(i, junk(i) if i % 5 == 0 else prose(i, 80 + i % 70)) for i in range(600)]
    return rows, [(i, 0 if i % 5 == 0 else 1) for i in range(600)]


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, label int").selectExpr("*", "'x' AS n_words", "'y' AS prune")


def test_held_out_rows_are_judged_right(spark):
    rows, labels = labelled()
    result = operator(frame(spark, rows), labels_of(spark, [l for l in labels if l[0] % 4]))
    got = {r["doc_id"]: r for r in result.collect()}
    assert len(got) == 600
    held = [i for i in range(600) if i % 4 == 0]
    assert sum(got[i]["verdict"] == labels[i][1] for i in held) >= 0.97 * len(held)
    for i, r in got.items():
        n, repeated = brute_counts(rows[i][1])[0], brute_counts(rows[i][1])[4]
        assert r["base_failed"] == (n < 50 or 100 * repeated > 50 * n)
        assert r["kept"] == (not r["base_failed"] and r["verdict"] == 1)


def test_edge_cases(spark):
    rows = strange()
    none = operator(frame(spark, rows), labels_of(spark, []))
    got = none.collect()
    assert len(got) == len(rows) and all(r["verdict"] == 1 and r["kept"] == (not r["base_failed"]) for r in got)
    assert all(r["base_failed"] for r in got if r["n_words"] == 0)
    only_bad = operator(frame(spark, rows), labels_of(spark, [(7, 0), (8, 0), (None, 1), (9, None), (10, 7)]))
    assert not any(r["kept"] for r in only_bad.collect())
    assert operator(frame(spark, []), labels_of(spark, [(1, 0), (2, 1)])).count() == 0


def test_sample_of_labels_is_bounded(spark):
    counted = spark.range(4000).selectExpr("id AS doc_id", *[f"CAST(id % 100 AS long) AS {c}" for c in COUNTS])
    labels = spark.range(4000).selectExpr("id AS doc_id", "CAST(id % 100 > 30 AS int) AS label")
    rules = fit(counted, labels, most=500)
    right = counted.select("doc_id", rules.column().alias("v")).where("v = CAST(doc_id % 100 > 30 AS int)").count()
    assert right >= 3800


def test_measures_of_texts_without_words(spark):
    row = statistics(frame(spark, [(1, "")])).select(*[c.alias(n) for n, c in measures().items()]).first()
    assert [row[s] for s in STATISTICS] == [0.0] * len(STATISTICS)
