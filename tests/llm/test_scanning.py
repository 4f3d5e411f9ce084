import hashlib
import random
import re

import pytest

from obsforge.llm import common
from obsforge.llm.decontaminate import contaminated, plain_words, template
from obsforge.llm.license_rules import BASE, Rule, rules
from obsforge.llm.licenses import scan_licenses, surviving
from obsforge.llm.secrets import _DEEPEST, _STEPS, battery, dismissal_threshold, find_secrets
from pyspark.sql import functions as F

from .helpers import edges, frame, prose

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"


def base_spans(text):
    text = text or ""
    found = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found)


def secret_rows():
    rng = random.Random(4)
    rows = list(edges())
    bits = [
        "PassWord = 'abcdefgh1'", "token: short", "secret:api_key:xyz12345678", "token=token=abcdefgh", "api-key=abcdefghijk", "APIKEY=" + "z" * 9,
        "AKIA" + "B7" * 8, "AKIAAKIA12", "AKIAxAKIA" + "Q" * 12, "f" * 31, "0a" * 20, "é\U0001d49c secret=\"" + "a1" * 20 + '"', "password  :  = ab", "token = " + "9f" * 16,
    ]
    for i in range(60):
        rows.append((100 + i, " ".join(rng.choice(bits + [prose(i, 3)]) for _ in range(rng.randrange(1, 9)))))
    rows.append((300, " ".join(["token=abcdefgh%d" % k for k in range(1000)])))
    return rows


def test_fixed_secrets(spark):
    rows = secret_rows()
    got = {}
    for r in find_secrets(frame(spark, rows)).collect():
        got.setdefault(r["doc_id"], []).append(r)
    for i, text in rows:
        found = base_spans(text)
        named = ",".join(f"{k}:{a}:{b}" for a, _, b, k in found)
        expected = (*(sum(f[1] == k for f in found) for k in range(3)), hashlib.sha256(named.encode()).hexdigest())
        matches = [(r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"]) for r in got[i]]
        assert expected in matches
        listed = [s for r in got[i] for s in r["spans"].split(",")]
        assert all(part in listed for part in named.split(","))
    assert sum(map(len, got.values())) == len(rows)
    assert find_secrets(frame(spark, [])).count() == 0


def test_random_tokens_are_found_and_structured_ones_dismissed(spark):
    rng = random.Random(9)
    random_ones = ["".join(rng.choice(BASE64) for _ in range(44)) for _ in range(40)]
    structured = ["/Usr/Local/Share/Doc/Package/Version" + str(i % 10) for i in range(20)] + ["Aa1" * 16, "ABCDEFGHIJabcdefghij0123456789", "aaaaaaaaaaaaaaaaaaaaaaaaaaA1" * 2]
    rows = [(i, f"see {t} here") for i, t in enumerate(random_ones + structured)]
    got = {r["doc_id"]: r["spans"] for r in find_secrets(frame(spark, rows)).collect()}
    hits = sum(got[i] == f"random:4:{4 + len(t)}" for i, t in enumerate(random_ones))
    assert hits >= 36
    assert sum(bool(got[i]) for i in range(40, len(rows))) <= 1


def test_battery_is_uniform_on_random_text(spark):
    rng = random.Random(2)
    rows = [("".join(rng.choice("0123456789abcdef") for _ in range(64)),) for _ in range(600)]
    values = [r[0] for r in spark.createDataFrame(rows, "s string").select(battery(F.col("s"), F.lit("0123456789abcdef"))).collect()]
    assert sum(v < 0.05 for v in values) < 0.09 * len(values)


def test_dismissal_is_the_step_up_rule(spark):
    rng = random.Random(6)
    p = [rng.random() ** 4 for _ in range(500)]
    tested = spark.createDataFrame([(x, 100.0) for x in p], "p double, bits double")
    step = dismissal_threshold(tested, 100.0, 0.05)
    ordered, cut = sorted(p), 0.0
    for k, x in enumerate(ordered, 1):
        if x <= 0.05 * k / len(p):
            cut = x
    ours = 10 ** (-step / _STEPS)
    assert ours >= cut * 10 ** (-1 / _STEPS) and sum(x <= ours for x in p) <= sum(x <= cut for x in p) + 1
    assert dismissal_threshold(tested.where("p < 0"), 100.0) == _DEEPEST * _STEPS + 1


def license_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute_suppression(found):
    """Every detection in order of priority against all kept ones."""
    kept = []
    for new in sorted(found, key=lambda d: (d[2], d[0], d[1], d[3], d[4])):
        mine = set(range(new[0], -new[1]))
        met = [(k, set(range(k[0], -k[1]))) for k in kept if mine & set(range(k[0], -k[1]))]
        if all(other < mine for _, other in met):
            kept = [k for k in kept if k not in [m for m, _ in met]] + [new]
    return kept


def brute_license(text, table):
    words = license_words(text)
    starts, labels = [], set()
    for phrase, label in BASE:
        p = phrase.split()
        at = [k for k in range(len(words) - len(p) + 1) if words[k : k + len(p)] == p]
        starts += at
        labels |= {label} if at else set()
    joined, found = "".join(f" {w}" for w in words) + " ", []
    for rule in table:
        if rule.keyword in joined:
            found += [(m.start(), -m.end(), rule.priority, rule.label, rule.confidence) for m in re.finditer(f" (?:{rule.pattern})(?= )", joined)]
    kept = brute_suppression(found)
    score = 1.0 if starts else max([k[4] for k in kept], default=0.0)
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels)), ",".join(sorted(labels | {k[3] for k in kept})), score)


def test_licenses_against_plain_python(spark):
    rng = random.Random(8)
    bits = [
        "Released under the MIT License.", "SPDX-License-Identifier: Apache-2.0", "Licensed under the Apache License, Version 2.0", "CC BY-NC", "cc-by-nc 4.0", "CC BY-NC-SA 4.0",
        "GNU General Public License, version 3", "GNU General Public License", "the MIT", "under the MIT license under the MIT license", "Mozilla Public License 2.0 license", "BSD-3-Clause license",
        "Permission is hereby granted, free of charge, to any person obtaining a copy", "All rights reserved.", "Creative Commons Attribution-NonCommercial 4.0 International License", "mit license isc license",
        "apache license version 2 0 license", "é LICENSE", "Distributed under the terms of the GPLv2 licence",
    ]
    rows = list(edges()) + [(100 + i, " ".join(rng.choice([*bits, prose(i, 4)]) for _ in range(rng.randrange(1, 10)))) for i in range(120)]
    rows.append((400, "under the mit license " * 700))
    table = rules()
    assert len(table) >= 200
    got = sorted((tuple(r) for r in scan_licenses(frame(spark, rows)).collect()), key=repr)
    assert got == sorted(((i, *brute_license(t, table)) for i, t in rows), key=repr)
    assert scan_licenses(frame(spark, [])).count() == 0


def shortest(parts):
    """Texts of a parsed pattern: every alternative, optional parts both left out and taken, repetitions as often as they must."""
    out = {""}
    for kind, value in parts:
        if kind is re._constants.LITERAL:
            one = {chr(value)}
        elif kind is re._constants.NOT_LITERAL:
            one = {"~"}
        elif kind is re._constants.IN:
            one = {chr(c[0] if kind_of is re._constants.RANGE else c) for kind_of, c in value}
        elif kind is re._constants.BRANCH:
            one = set().union(*map(shortest, value[1]))
        elif kind is re._constants.SUBPATTERN:
            one = shortest(value[3])
        else:
            assert kind is re._constants.MAX_REPEAT, kind
            one = set().union(*({a * n for a in shortest(value[2])} for n in {value[0], max(1, value[0])}))
        out = {a + b for a in out for b in one}
    return out


def test_every_match_of_a_rule_holds_its_keyword():
    for rule in rules():
        texts = {f" {t} " for t in shortest(re._parser.parse(rule.pattern))}
        assert all(re.fullmatch(f" (?:{rule.pattern}) ", t) for t in texts)
        assert all(rule.keyword in t for t in texts), rule


def test_license_bodies_without_their_names(spark):
    boost = "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"
    zlib = "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages"
    got = {r["doc_id"]: r["labels"] for r in scan_licenses(frame(spark, [(1, boost), (2, zlib)])).collect()}
    assert got == {1: "boost-1", 2: "zlib"}


def test_overlapping_detections_go_to_the_better_priority(spark):
    table = [Rule("alpha", "alpha beta gamma", "long", 50, 0.5), Rule("beta", "beta", "inner", 1, 1.0), Rule("gamma", "gamma delta", "late", 10, 0.7)]
    rows = [(1, "alpha beta gamma"), (2, "alpha beta gamma delta"), (3, "beta gamma delta")]
    got = {r["doc_id"]: r["labels"] for r in scan_licenses(frame(spark, rows), table).collect()}
    # In 2, "long" loses to "late", so it suppresses nothing: "inner", the best of all, stays.
    assert got == {1: "long", 2: "inner,late", 3: "inner,late"}
    table = [Rule("aa", "aa bb cc dd", "a", 40, 0.5), Rule("bb", "bb cc", "b", 10, 1.0), Rule("dd", "dd ee ff", "c", 20, 0.7)]
    assert scan_licenses(frame(spark, [(1, "aa bb cc dd ee ff")]), table).first()["labels"] == "b,c"


def test_suppression_of_random_overlaps(spark):
    rng = random.Random(12)
    cases = []
    for case in range(300):
        found = set()
        for _ in range(rng.randrange(0, 14)):
            start = rng.randrange(20)
            end, priority = start + rng.randrange(1, 9), rng.randrange(1, 5)
            found.add((start, -end, priority, f"{start}-{end}-{priority}", rng.choice([0.5, 0.7, 0.9])))
        cases.append((case, sorted(found)))
    shape = "case long, found array<struct<start:bigint,back:bigint,priority:int,label:string,confidence:double>>"
    rows = spark.createDataFrame(cases, shape).select("case", surviving(F.col("found")).alias("s")).select("case", "s.*").collect()
    got = {r["case"]: (set(r["labels"]), r["confidence"]) for r in rows}
    for case, found in cases:
        kept = brute_suppression(found)
        assert got[case] == ({k[3] for k in kept}, max([k[4] for k in kept], default=0.0))
        taken = set().union(*(range(k[0], -k[1]) for k in kept))
        assert sum(-k[1] - k[0] for k in kept) == len(taken)
        assert all(taken & set(range(d[0], -d[1])) for d in found)


ITEMS = [
    (1, "If Maria buys 12 apples for 3.50 euros and Peter buys 7 pears how much do they spend together in the shop"),
    (2, "the quick brown animal jumps over a lazy creature near the old river bank every single morning"),
    (3, "too short"),
    (4, None),
    (None, "an item without any number is not reported by this operator at all whatever it holds inside"),
    (2, "the quick brown animal jumps over a lazy creature near the old river bank every single morning"),
]


def benchmark(spark):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in ITEMS], "item_id long, text string, doc_id string, words string")


def test_templates(spark):
    got = spark.createDataFrame([("In 2020, Anna ran 5.5 km (or 12 MILES).",)], "t string").select(template(plain_words(F.col("t")))).first()[0]
    assert got == "<name> <n> <name> ran <n> <u> or <n> <u>"


@pytest.mark.parametrize("broadcast", [True, False])
def test_contaminated_documents(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    asked = ITEMS[0][1]
    again = asked.replace("Maria", "Laura").replace("Peter", "Tom").replace("12", "31").replace("7 ", "9 ")
    rows = [r for r in edges() if r[0] != 12] + [
        (100, f"{prose(1, 30)} {asked} {prose(2, 30)}"),
        (101, f"{prose(3, 30)} {again}"),
        (102, ITEMS[1][1]),
        (103, f"{ITEMS[1][1].replace('lazy', 'sleepy')} {asked}"),
        (104, " ".join(ITEMS[1][1].split()[:9])),
        (105, "too short"),
        (106, ITEMS[4][1]),
        (107, ITEMS[1][1].upper()),
        (100, "another row of the same document"),
    ]
    got = {}
    for r in contaminated(frame(spark, rows), benchmark(spark)).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert sum(map(len, got.values())) == len(rows)
    flagged = {i: r[0]["item_ids"] for i, r in got.items() if r[0]["contaminated"]}
    assert {100: "1", 101: "1", 102: "2"}.items() <= flagged.items()
    assert set(flagged) <= {100, 101, 102, 103, 107} and "1" in flagged[103]


NAMED = "Yesterday Anna met Boris near Lake Constance and they talked about Vienna while Clara waited for Doris inside Hotel Sacher until late"


@pytest.mark.parametrize("change", [str.lower, str.upper, str.title, str])
@pytest.mark.parametrize("item", [NAMED, NAMED.lower(), NAMED.title()])
def test_letter_case_hides_nothing(spark, item, change):
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = [(1, f"{prose(1, 20)} {change(item)} {prose(2, 20)}"), (2, prose(3, 60).title())]
    assert {r["doc_id"]: r["contaminated"] for r in contaminated(frame(spark, rows), items).collect()} == {1: True, 2: False}


def test_long_excerpts_and_items_of_few_words(spark):
    long = prose(11, 59)
    numbers = "sum 12 7 19 44 of 3 8 61 2 and 90 17 5 33 28 then 6"
    items = spark.createDataFrame([(1, long), (2, numbers)], "item_id long, text string")
    words = long.split()
    rows = [(1, " ".join(words[:25])), (2, f"{prose(12, 20)} {' '.join(words[30:43])} {prose(13, 20)}"), (3, " ".join(words[30:42])), (4, f"{prose(14, 9)} {numbers}"), (5, "sum 1 2 3 4 of 5 6 7 8 and 9 10 11 12 13 then 14"), (6, prose(15, 40))]
    got = {r["doc_id"]: r["item_ids"] for r in contaminated(frame(spark, rows), items).collect()}
    assert got == {1: "1", 2: "1", 3: "", 4: "2", 5: "", 6: ""}


def test_slots_must_be_filled_consistently(spark):
    item = spark.createDataFrame([(1, "first add 5 to the sum then take 5 from it and then multiply 5 by the whole result twice")], "item_id long, text string")
    same = "first add 8 to the sum then take 8 from it and then multiply 8 by the whole result twice"
    other = "first add 8 to the sum then take 3 from it and then multiply 9 by the whole result twice"
    got = {r["doc_id"]: r["contaminated"] for r in contaminated(frame(spark, [(1, same), (2, other)]), item).collect()}
    assert got == {1: True, 2: False}


def test_rows_of_one_id_are_judged_by_their_own_text(spark):
    rows = [(k, t) for k in (None, 5) for t in (ITEMS[1][1], prose(21, 40), prose(22, 40))]
    got = [(r["doc_id"], r["contaminated"]) for r in contaminated(frame(spark, rows), benchmark(spark)).collect()]
    assert sorted(got, key=repr) == sorted([(k, c) for k in (None, 5) for c in (True, False, False)], key=repr)


def test_contamination_of_empty_tables(spark):
    assert contaminated(frame(spark, []), benchmark(spark)).count() == 0
    none = contaminated(frame(spark, [(1, prose(1, 50))]), benchmark(spark).where("false")).collect()
    assert [(r["doc_id"], r["contaminated"], r["n_items"], r["item_ids"]) for r in none] == [(1, False, 0, "")]
