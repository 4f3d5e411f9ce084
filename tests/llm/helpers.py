"""Small fixtures and plain-Python versions of the text operators."""

import random
import re

from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
)
# Names that operators use inside; a table may bring columns of the same name.
CLASHING = ["key", "digest", "cid", "root", "marks", "spans", "places", "gram", "label", "words", "tokens", "keep_id", "bucket", "group", "score", "known", "copies"]
BLANKS = " \t\n\x0b\x0c\r"


def frame(spark, rows):
    """Documents from (doc_id, text[, lang]) rows, with further columns whose names clash with the operators' own."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", None if r[1] is None else len(r[1])) for r in rows]
    docs = spark.createDataFrame(full, DOCUMENTS)
    for name in CLASHING:
        docs = docs.selectExpr("*", f"'x' AS `{name}`")
    return docs


def prose(seed, words, vocabulary=400):
    rng = random.Random(seed)
    syllables = ["ar", "be", "co", "di", "en", "fu", "go", "hi", "il", "ka"]
    return " ".join("".join(rng.choice(syllables) for _ in range(2 + rng.randrange(vocabulary) % 3)) for _ in range(words))


def edges():
    """Null, empty, blank, one word, ties, repeated rows, no id, a long text, characters outside ASCII."""
    long_text = prose(99, 30_000)
    rows = [
        (1, None), (2, ""), (3, " \t\n "), (4, "word"), (5, "Word"), (6, "wo rd"), (7, prose(1, 80)), (8, prose(1, 80)), (9, prose(1, 80) + " "),
        (9, prose(1, 80) + " "), (10, prose(2, 120)), (11, prose(2, 120) + " tail"), (12, long_text), (13, "x" * 20_000), (14, "été über niño \U0001d49c 日本語 text's"),
        (15, "123 456 !!!"), (16, long_text + " more"), (None, prose(3, 60)), (None, prose(3, 60)), (17, prose(3, 60)), (None, None),
    ]
    return rows


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower_ascii(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def shingles(text, size):
    w = words_of(lower_ascii(text))
    if not w:
        return set()
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)}


def components(sets, threshold=80):
    """Smallest index reachable, by brute force over all pairs."""
    parent = list(range(len(sets)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= threshold * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(sets))]
