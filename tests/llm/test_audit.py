import random
from itertools import permutations

import pytest
from obsforge.llm import filter_audit
from obsforge.llm.filter_audit import audit, later_copies, word_array
from pyspark.sql import functions as F

from .helpers import edges, frame, prose, words_of


def brute_audit(rows, labels):
    """All columns of every (part, order, step), by running the filters over the rows one after another."""
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, t in labels if i is not None and t == 1}
    judged = []
    for doc_id, text, lang in rows:
        text = text or ""
        w = words_of(text)
        fails = set()
        if len(w) < 100:
            fails.add("A")
        if 100 * len(set(w)) < 80 * len(w):
            fails.add("B")
        if 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text):
            fails.add("C")
        if any(c in "#$%&*|" for c in text):
            fails.add("D")
        if doc_id is not None and any(o is not None and o < doc_id and (t or "") == text for o, t, _ in rows):
            fails.add("E")
        judged.append((lang or "", fails, doc_id in good, doc_id in toxic))
    out = {}
    for part in {j[0] for j in judged}:
        shapley = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            there = [j for j in judged if j[0] == part]
            earlier = []
            for step, letter in enumerate(order, 1):
                gone = [j for j in there if letter in j[1]]
                there = [j for j in there if letter not in j[1]]
                shapley[letter] += len(gone)
                alone = sum(j[0] == part and j[1] == {letter} for j in judged)
                out[part, order, step] = [len(there), len(gone), sum(letter in j[1] for j in earlier), alone, sum(j[2] for j in gone), sum(j[3] for j in gone)]
                earlier += gone
        for order in map("".join, permutations("ABCDE")):
            for step, letter in enumerate(order, 1):
                out[part, order, step].append(shapley[letter])
    return out


def shout(text):
    return text.upper()


def messy():
    rng = random.Random(5)
    rows = [(r[0], r[1], "en") for r in edges()]
    texts = [prose(i, 150) for i in range(6)] + [shout(prose(7, 120)), prose(8, 130) + " #", "a b " * 80, "a | b", ""]
    rows += [(rng.randrange(100, 160), rng.choice(texts), rng.choice(["en", "de", None, ""])) for _ in range(90)]
    labels = [(rng.randrange(100, 160), rng.choice([0, 1, None]), rng.choice([0, 1])) for _ in range(60)] + [(None, 1, 1), (101, 1, 1), (101, 0, 0)]
    return rows, labels


def table(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, quality int, toxic int").selectExpr("*", "'x' AS fails", "1 AS n", "'y' AS part", "'z' AS text")


def found(result):
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    rows = result.collect()
    out = {(r["part"], r["filter_order"], r["step"]): [r[c] for c in names] for r in rows}
    assert len(out) == len(rows)
    return out


def test_every_order_against_brute_force(spark):
    rows, labels = messy()
    assert found(audit(frame(spark, rows), table(spark, labels))) == brute_audit(rows, labels)


def test_hot_text_over_salts_and_shuffled_sides(spark, monkeypatch):
    monkeypatch.setattr(filter_audit, "ROWS_PER_SALT", 7)
    monkeypatch.setattr(filter_audit, "small_enough", lambda *a: False)
    rows, labels = messy()
    rows += [(i, "the same text", "en") for i in range(200, 300)] + [(250, "the same text", "en")]
    assert found(audit(frame(spark, rows), table(spark, labels))) == brute_audit(rows, labels)


def test_equal_hashes_of_other_texts_are_no_copies(spark):
    rows = spark.createDataFrame([(1, "p", "a", 5, 1), (2, "p", "b", 5, 1), (3, "p", "a", 5, 1), (None, "p", "a", 5, 1)], "doc_id long, part string, text string, hash long, points int")
    with filter_audit.Intermediate(spark) as steps:
        assert [r["doc_id"] for r in later_copies(rows, steps).collect()] == [3]


def test_empty_tables(spark):
    assert audit(frame(spark, []), table(spark, [])).count() == 0
    rows = [(1, None, None), (2, None, None)]
    got = found(audit(frame(spark, rows), table(spark, [])))
    assert got == brute_audit(rows, []) and len(got) == 600


def test_filters_of_one_s_own(spark):
    rows = [(1, "one", "en"), (2, "one", "en"), (3, "two", "en")]
    got = found(audit(frame(spark, rows), table(spark, []), {"x": F.contains(F.col("text"), F.lit("n"))}))
    assert set(got) == {("en", o, s) for o in ("Ex", "xE") for s in (1, 2)}
    assert got["en", "Ex", 1][:4] == [2, 1, 0, 0] and got["en", "xE", 2][:4] == [1, 0, 1, 0]
    with pytest.raises(ValueError):
        audit(frame(spark, rows), table(spark, []), {"E": F.lit(True)})


def test_word_array_keeps_other_blanks(spark):
    texts = ["", " \t\r\n\x0b\x0c", "a", " a\tb\n", "a\xa0b c d", "x" * 50_000]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").select("text", word_array(F.col("text")).alias("w")).collect()
    assert all(r["w"] == words_of(r["text"]) for r in rows)
