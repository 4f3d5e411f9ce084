import random

import duckdb
import pytest

import corpus_pipeline
from obsforge.llm.queries import QUERIES, SQL

from .helpers import BLANKS, DOCUMENTS, components, edges, prose, shingles
from .test_models import tokenizer  # noqa: F401

SF_DIR = "/root/testdata/sf0.001"
TABLES = "documents benchmark labels".split()


@pytest.mark.parametrize("name", sorted(SQL))
def test_queries_match_sql(spark, name):
    database = duckdb.connect()
    for table in TABLES:
        database.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    result = QUERIES[name](spark, SF_DIR)
    columns = sorted(result.columns)
    relation = database.sql(SQL[name])
    assert sorted(relation.columns) == columns
    at = [relation.columns.index(c) for c in columns]
    assert sorted(repr([r[c] for c in columns]) for r in result.collect()) == sorted(repr([r[i] for i in at]) for r in relation.fetchall())


def test_one_query_for_each_operator():
    assert sorted(n.split("_")[0] for n in QUERIES) == sorted(f"op{i}" for i in range(1, 14))


def fixture():
    rng, items = random.Random(17), [(i, prose(5000 + i, 25)) for i in range(5)]
    rows = [(i, t) for i, t in edges() if i is not None and i not in (12, 16)]
    for i in range(100, 180):
        base = prose(i // 4, 60).split()
        if i % 4 == 1:
            base[rng.randrange(60)] = "changed"
        if i % 4 == 2:
            base = [*base, " "]
        if i % 20 == 3:
            base = prose(i, 40).split() + items[i % 5][1].split() + prose(i + 1, 20).split()
        rows.append((i, " ".join(base)))
    rows += [(7, prose(1, 80)), (105, "a second text under one id " + prose(9, 12)), (300, "12 !! 34")]
    return rows, items


def brute_stages(rows, items):
    """Ids that each stage keeps."""
    key = lambda t: "".join(c for c in t or "" if c not in BLANKS)
    rows = [r for r in rows if any(c.isalpha() for c in r[1] or "")]
    groups = {}
    for r in rows:
        groups.setdefault(key(r[1]), []).append(r)
    out = [sorted(r[0] for r in rows)]
    rows = [max(g, key=lambda r: (len(r[1]), -r[0])) for g in groups.values()]
    out.append(sorted(r[0] for r in rows))
    rows.sort()
    near = components([shingles(t, 5) for _, t in rows])
    kept = {r[0] for k, r in enumerate(rows) if near[k] == k}
    rows = [r for r in rows if r[0] in kept]
    out.append(sorted(r[0] for r in rows))
    held = {r[0] for r in rows if not any(t in r[1] for _, t in items)}
    rows = [r for r in rows if r[0] in held]
    out.append(sorted(r[0] for r in rows))
    return out, rows


def test_stages_against_plain_python(spark, tmp_path, tokenizer):  # noqa: F811
    rows, items = fixture()
    sf_dir = str(tmp_path)
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCUMENTS).write.parquet(f"{sf_dir}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{sf_dir}/benchmark.parquet")
    expected, left = brute_stages(rows, items)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        result = stage(spark, docs, sf_dir)
        if k < 4:
            assert result.columns == DOCUMENTS.names
            path = f"{sf_dir}/{name}"
            result.write.parquet(path)
            docs = spark.read.parquet(path)
            assert sorted(r["doc_id"] for r in docs.select("doc_id").collect()) == expected[k], name
    total = sum(len(ids) + 1 for ids in tokenizer._direct([t for _, t in left]))
    assert sum(r["length"] for r in result.collect()) == total == sum(r["length"] for r in corpus_pipeline.run(spark, sf_dir).collect())


def test_pipeline_of_an_empty_table(spark, tmp_path):
    sf_dir = str(tmp_path)
    spark.createDataFrame([], DOCUMENTS).write.parquet(f"{sf_dir}/documents.parquet")
    spark.createDataFrame([(1, "x")], "item_id long, text string").write.parquet(f"{sf_dir}/benchmark.parquet")
    assert corpus_pipeline.run(spark, sf_dir).count() == 0


def test_rows_without_id_and_with_repeated_ids(spark, tmp_path):
    sf_dir, item = str(tmp_path), prose(5000, 25)
    clean = [prose(6000 + i, 40) for i in range(12)]
    near = prose(7000, 60)
    rows = [(None, t) for t in clean[:6]] + [(8, t) for t in clean[6:9]] + [(9, clean[9]), (None, "12 !! 34"), (8, "56 ??"), (None, None)]
    held = [(None, f"{clean[10]} {item}"), (8, f"{item} {clean[11]}"), (None, " ".join(item.split()[:14])), (None, " ".join(item.split()[11:]))]
    copies = [(None, near), (None, near + " one"), (None, near + " two")]
    named = [(10, prose(7001, 60)), (None, prose(7001, 60) + " more")]
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{sf_dir}/benchmark.parquet")

    def left(stage, rows):
        docs = spark.createDataFrame([(i, t, "en", "s", None) for i, t in rows], DOCUMENTS)
        return sorted(((r["doc_id"], r["text"]) for r in stage(spark, docs, sf_dir).collect()), key=repr)

    expected = lambda rows: sorted(rows, key=repr)
    letters = [r for r in rows if any(c.isalpha() for c in r[1] or "")]
    assert left(corpus_pipeline.language_id, rows) == expected(letters)
    assert left(corpus_pipeline.exact_dedup, letters * 2) == expected(letters)
    got = left(corpus_pipeline.near_dedup, letters + copies + named)
    assert [r for r in got if r not in copies] == expected([*letters, named[0]]) and len([r for r in got if r in copies]) == 1
    whole = [r for r in held if item in r[1]]
    got = left(corpus_pipeline.decontaminate, letters + held)
    assert set(letters) <= set(got) and not set(whole) & set(got)


def test_columns_of_any_name_and_type_pass_through(spark, tmp_path):
    """Columns that are named as the stages' own, or hold dots or maps, stay as they are, with unique and with repeated ids."""
    sf_dir, item = str(tmp_path), prose(5000, 25)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{sf_dir}/benchmark.parquet")
    names = ["__row", "___row", "digest", "text_sha256", "kept", "row", "points", "id", "best", "a.b", "__text"]
    for repeated in (False, True):
        rows = [(i // 2 if repeated else i, prose(i, 40), "en", "s", i) for i in range(12)]
        docs = spark.createDataFrame(rows, DOCUMENTS).selectExpr("*", "map('k', n_chars) AS m", *[f"concat(n_chars, '{n}') AS `{n}`" for n in names])
        whole = sorted(map(repr, docs.collect()))
        docs = docs.unionByName(docs.limit(0)).unionByName(docs.selectExpr(*[f"`{c}`" for c in docs.columns if c not in ("doc_id", "text")], "99 AS doc_id", "'12 3' AS text"))
        for name, stage in corpus_pipeline.STAGES[:4]:
            docs = stage(spark, docs, sf_dir)
            docs.write.parquet(f"{sf_dir}/{name}-{repeated}")
            docs = spark.read.parquet(f"{sf_dir}/{name}-{repeated}")
            assert docs.columns == [*DOCUMENTS.names, "m", *names]
            assert sorted(map(repr, docs.collect())) == whole, name
