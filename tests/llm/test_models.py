import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from obsforge.llm import language, lm_score, quality
from obsforge.llm.packing import BinTree, WordTokenizer, first_fit_decreasing, pack
from obsforge.llm.queries import tokenizer_file

from .helpers import edges, frame, prose

SAMPLES = {
    "en": ["the quick brown fox jumps over the lazy dog and then it sleeps", "there is nothing that they would rather have than this thing"],
    "de": ["der schnelle braune fuchs springt und dann schläft er über nacht", "nichts ist schöner als das was wir hier nicht haben"],
}


def brute_phrases(text, parts):
    """Greedy longest phrases, by substring search; the text is read in the operator's stretches."""
    joined = ["".join(map(chr, language.folded(p))) for p in parts]
    read = "".join(map(chr, language.folded(text)))
    count = 0
    for at in range(0, len(read), language.STRETCH):
        stretch, phrase = read[at : at + language.STRETCH], ""
        count += 1
        for c in stretch:
            if any(phrase + c in j for j in joined):
                phrase += c
            else:
                count += 1
                phrase = c if any(c in j for j in joined) else ""
    return count


def test_phrases_equal_substring_search():
    parser = language.CrossParser(SAMPLES)
    texts = ["the fox sleeps", "schöner fuchs!", "", "日本 text", "zzz qqq", prose(1, 400), SAMPLES["en"][0] * 20]
    counts = parser.phrases([language.folded(t) for t in texts])
    for row, text in enumerate(texts):
        expected = [brute_phrases(text, SAMPLES[l]) if len(language.folded(text)) else 0 for l in parser.languages]
        assert counts[row].tolist() == expected


def test_suffix_automaton_knows_exactly_the_substrings():
    rng = random.Random(1)
    for _ in range(20):
        symbols = [rng.randrange(1, 4) for _ in range(30)]
        table = language.suffix_automaton(symbols, 4)
        known = {tuple(symbols[i:j]) for i in range(31) for j in range(i, 31)}
        for _ in range(300):
            word = tuple(rng.randrange(1, 4) for _ in range(rng.randrange(1, 8)))
            state = 0
            for s in word:
                state = table[state, s]
                if not state:
                    break
            assert bool(state) == (word in known)


def test_language_of_edge_cases(spark):
    labelled = frame(spark, [(i, t, l) for l in SAMPLES for i, t in enumerate(SAMPLES[l])] + [(9, None, "en"), (10, "text", None), (11, "", "fr")])
    model = language.train(labelled)
    assert [l for l, _ in model] == ["de", "en"]
    rows = edges()
    got = language.identify(frame(spark, rows), model).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r for r in got}
    for i in (1, 2, 3, 15):
        assert by_id[i]["lang_pred"] == "und" and by_id[i]["score"] == 0
    assert all(r["lang_pred"] in ("en", "de") and 0 < r["score"] <= 1 for r in got if r["doc_id"] in (4, 7, 12, 13, 14))
    assert language.identify(frame(spark, []), model).count() == 0
    assert {r["lang_pred"] for r in language.identify(frame(spark, rows), language.train(labelled.where("false"))).collect()} == {"und"}


def test_any_number_of_languages_in_groups(spark, monkeypatch):
    labelled = [(i, prose(100 + i, 60) + " " + chr(0x4E00 + i) * 3, f"l{i:03d}") for i in range(70)]
    model = language.train(frame(spark, labelled))
    assert len(model) == 70
    rows = [(i, t[5:200]) for i, t, _ in labelled] + edges()
    answers = []
    for size in (1 << 30, 1 << 20):
        monkeypatch.setattr(language, "GROUP_BYTES", size)
        assert (len(language._groups(model)) > 1) == (size == 1 << 20)
        answers.append(sorted(((r["doc_id"], r["lang_pred"], round(r["score"], 9)) for r in language.identify(frame(spark, rows), model).collect()), key=repr))
    assert answers[0] == answers[1]
    found = {(i, name) for i, name, _ in answers[0]}
    assert all((i, name) in found for i, _, name in labelled)


def test_sorted_transitions_equal_the_dense_table(monkeypatch):
    texts = ["the fox sleeps", "schöner fuchs!", "日本 text", prose(1, 400), SAMPLES["de"][1] * 9]
    dense = language.CrossParser(SAMPLES)
    monkeypatch.setattr(language, "DENSE_CELLS", 0)
    sparse = language.CrossParser(SAMPLES)
    assert all(a.table is None for a in sparse.automata) and all(a.table is not None for a in dense.automata)
    parts = [language.folded(t) for t in texts]
    assert dense.phrases(parts).tolist() == sparse.phrases(parts).tolist()


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.train(docs.where("crc32(cast(cast(doc_id AS string) AS binary)) % 4 <> 2"))
    rows = language.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.98 * len(held) > 200


def test_quality_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").selectExpr("doc_id", "quality AS label")
    table = quality.statistics(docs).cache()
    ensemble = quality.fit(table.join(labels.where("crc32(cast(cast(doc_id AS string) AS binary)) % 5 <> 0"), "doc_id"))
    assert 0 < len(ensemble.rules) < 120
    rows = quality.scored(table, ensemble).join(labels, "doc_id").collect()
    held = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert sum(r["predicted"] == r["label"] for r in held) >= 0.95 * len(held) > 50
    table.unpersist()


def test_rules_as_columns_equal_rules_in_numpy(spark):
    rng = np.random.default_rng(3)
    x = rng.random((400, len(quality.STATISTICS))).round(2)
    y = ((x[:, 1] > 0.4) & (x[:, 5] <= 0.7)).astype(float)
    table = spark.createDataFrame([(i, float(y[i]), *map(float, x[i])) for i in range(400)], "doc_id long, label double, " + ", ".join(f"{s} double" for s in quality.STATISTICS))
    ensemble = quality.fit(table)
    got = {r["doc_id"]: r["score"] for r in quality.scored(table, ensemble).collect()}
    margin = ensemble.intercept + sum(r.weight * r.holds(x) for r in ensemble.rules)
    assert np.allclose([got[i] for i in range(400)], 1 / (1 + np.exp(-margin)))
    assert np.mean([(got[i] > 0.5) == y[i] for i in range(400)]) > 0.98


def test_quality_of_edge_cases(spark):
    rows = edges()
    table = quality.statistics(frame(spark, rows))
    for labelled, low, high in ((table.selectExpr("*", "1 AS label").where("false"), 0.5, 0.5), (table.selectExpr("*", "1 AS label"), 0.9, 1.0), (table.selectExpr("*", "cast(NULL AS int) AS label"), 0.5, 0.5)):
        got = quality.scored(table, quality.fit(labelled)).collect()
        assert len(got) == len(rows) and all(low <= r["score"] <= high for r in got)
    assert quality.statistics(frame(spark, [])).count() == 0


def test_gradients_equal_finite_differences():
    rng = np.random.default_rng(0)
    p = {k: v.astype(np.float64) + 0.1 * rng.standard_normal(v.shape) for k, v in lm_score.initial().items()}
    ids = rng.integers(0, lm_score.IDS, 40)
    around = lm_score.contexts(ids, np.array([0, 25, 40]))
    loss = lambda q: -lm_score.forward(q, around, ids)[0].mean()
    before = {k: v.copy() for k, v in p.items()}
    squares = {k: np.zeros(v.shape) for k, v in p.items()}
    lm_score.learn(p, squares, around, ids)
    for k in before:
        at = np.unravel_index(np.argmax(squares[k]), squares[k].shape)
        near = {n: v.copy() for n, v in before.items()}
        near[k][at] += 1e-5
        slope = (loss(near) - loss(before)) / 1e-5
        assert abs(abs(slope) - np.sqrt(squares[k][at])) < 1e-3 * max(1, abs(slope))


def test_probabilities_sum_to_one():
    p = lm_score.initial()
    around = np.tile(np.array([[3, 5, 7, lm_score.IDS]]), (lm_score.IDS, 1))
    assert abs(np.exp(lm_score.forward(p, around, np.arange(lm_score.IDS))[0].astype(float)).sum() - 1) < 1e-4


def test_every_word_is_a_target_once():
    for n in (0, 1, 2, 50, 1001):
        for rounds in (1, 3, lm_score.ROUNDS):
            assert sorted(t for turn in range(rounds) for t in lm_score.targets(n, turn, rounds)) == list(range(n))


def test_words_beside_the_old_stride_are_learned():
    # Words 1 and 2 alternate; a stride of 16 from 0, 5 and 10 would learn from neither at 3 modulo 16, where alone word 7 stands.
    ids = np.tile([1, 2], 4000)
    ids[3::16] = 7
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([ids.astype(np.uint16).tobytes()])], ["doc_id", "ids"])
    values = lm_score.flat(lm_score.initial())
    for turn in range(lm_score.ROUNDS):
        values = np.array(next(lm_score._trained(values, turn, lm_score.ROUNDS)(iter([batch])))["parameters"][0].as_py())
    around = lm_score.contexts(ids, np.array([0, len(ids)]))
    score = lambda v: lm_score.forward(lm_score.shaped(v), around, ids)[0][3::16].mean()
    assert score(values) > score(lm_score.flat(lm_score.initial())) + 2


def test_pseudo_likelihood_of_edge_cases_and_order(spark):
    rng = random.Random(1)
    learned = [(1000 + i, " ".join(rng.choice(["the cat sat on the mat", "a dog ran in the park"]) for _ in range(40))) for i in range(150)]
    rows = edges() + learned + [(5000, "mat the on sat cat the park " * 30), (5001, "the cat sat on the mat " * 30)]
    got = lm_score.pseudo_likelihood(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r for r in got}
    assert all(by_id[i]["n_words"] == 0 and by_id[i]["log_likelihood"] == 0 and by_id[i]["mean_log_probability"] is None for i in (1, 2, 3))
    assert by_id[5001]["mean_log_probability"] > by_id[5000]["mean_log_probability"] + 0.5
    assert abs(by_id[7]["log_likelihood"] - by_id[8]["log_likelihood"]) < 1e-2
    assert lm_score.pseudo_likelihood(frame(spark, [])).count() == 0


def plain_log_probability(p, around, word):
    """One word's log-probability from the parameters, in plain Python."""

    def chosen(matrix, half, bias, hidden, branch):
        logits = [sum(w * h for w, h in zip(matrix[half * 32 + i], hidden)) + bias[i] for i in range(32)]
        return logits[branch] - math.log(sum(math.exp(x) for x in logits))

    read = [x for n in around for x in p["embedding"][-1 if n is None else n]]
    hidden = [max(0.0, sum(r * p["inner"][i][j] for i, r in enumerate(read)) + p["inner_bias"][j][0]) for j in range(32)]
    coded = lambda name, at: [h + c[at] for h, c in zip(hidden, p[f"{name}_code"])]
    of = lambda name, at: [row[at] for row in p[f"{name}_bias"]]
    node = word if word < lm_score.HEAD else lm_score.HEAD + (word - lm_score.HEAD) // 1024
    total = chosen(p["near"], 0, of("group", 0), hidden, node // 32)
    total += chosen(p["near"], 1, of("member", node // 32), coded("member", node // 32), node % 32)
    if word >= lm_score.HEAD:
        beyond = word - lm_score.HEAD
        total += chosen(p["far"], 0, of("branch", beyond // 1024), coded("branch", beyond // 1024), beyond // 32 % 32)
        total += chosen(p["far"], 1, of("leaf", beyond // 32), coded("leaf", beyond // 32), beyond % 32)
    return total


def test_scores_of_whole_documents_against_plain_python(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(1500)] * 5
    rng.shuffle(words)
    texts = [" ".join(words[i : i + 60]) for i in range(0, len(words), 60)] + ["once seen words only", "W1 w2\tw3", "", "w7"]
    docs = frame(spark, list(enumerate(texts)))
    known = lm_score.vocabulary(docs)
    assert len(known) == 1500 and lm_score.clusters_for(len(known)) == 1
    ids = lm_score.encoded(docs, known)
    values = lm_score.train(ids, clusters=1)
    p = {k: v.tolist() for k, v in lm_score.shaped(values).items()}
    got = {r["doc_id"]: r for r in lm_score.pseudo_likelihood(docs).collect()}
    assert len(got) == len(texts)
    held = {r["doc_id"]: np.frombuffer(r["ids"], dtype=np.uint16).tolist() for r in ids.collect()}
    own = {w for row in held.values() for w in row if w >= lm_score.RARE}
    assert len(own) == 1500  # no word above the threshold shares an id
    for i in [0, 1, 17, *range(len(texts) - 4, len(texts))]:
        around = [None, None, *held[i], None, None]
        expected = sum(plain_log_probability(p, around[k : k + 2] + around[k + 3 : k + 5], w) for k, w in enumerate(held[i]))
        assert got[i]["n_words"] == len(texts[i].split()) and abs(got[i]["log_likelihood"] - expected) < 1e-2 * max(1, len(held[i]))


@pytest.fixture(scope="module")
def tokenizer():
    return WordTokenizer(tokenizer_file())


def test_ids_equal_the_tokenizers_own(tokenizer):
    rng = random.Random(3)
    bits = ["it's", "he'll'd", "'sam", "''s", " 's", "\n's", "I'RE", "  x", " \n y", "\t\t", "1,2 '3", "é's", "'", "<|endoftext|>", "あい", "\U0001d49c", "a\x1cb", "'ll", "'r", "\r\n", "²3", " ", " ", " a"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(10))) for _ in range(2000)]
    texts += ["".join(chr(rng.choice([32, 39, 10, 97, 115, 114, 101, 118, 108, 48, 33, 0xE9, 0x85, 0xA0])) for _ in range(rng.randrange(25))) for _ in range(3000)]
    for ours, own in zip(tokenizer.encode(texts), tokenizer._direct(texts)):
        assert ours.tolist() == own.tolist()


def test_tree_places_like_a_scan():
    rng = random.Random(5)
    for _ in range(30):
        sizes = np.array([rng.randrange(1, 101) for _ in range(rng.randrange(1, 120))])
        bins, offsets = first_fit_decreasing(sizes, 100)
        free = []
        for i in np.argsort(-sizes, kind="stable"):
            b = next((k for k, f in enumerate(free) if f >= sizes[i]), len(free))
            if b == len(free):
                free.append(100)
            assert (bins[i], offsets[i]) == (b, 100 - free[b])
            free[b] -= sizes[i]
    assert BinTree(10, 1).place(10) == (0, 10)


def test_packing_round_trip(spark, tokenizer):
    rows = edges()
    got = pack(frame(spark, rows), tokenizer_file(), group_pieces=16, with_ids=True).collect()
    sequences, documents = {}, {}
    for r in got:
        ids = np.frombuffer(r["ids"], dtype="<u4").tolist()
        assert len(ids) == r["length"] and zlib.crc32(r["ids"]) == r["ids_crc32"]
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        documents.setdefault(r["doc_id"], []).append((r["start"], ids, r["doc_tokens"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    for i, text in rows:
        whole = [*tokenizer._direct([text or ""])[0].tolist(), 0]
        copies = sum(r[0] == i for r in rows)
        if i is not None:
            assert sum((ids for _, ids, _ in sorted(documents[i])[::copies]), []) == whole
            assert {t for _, _, t in documents[i]} == {len(whole)}
    assert pack(frame(spark, []), tokenizer_file()).count() == 0
