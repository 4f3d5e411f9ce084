"""One registered query per text operator (opN_<name>) and the equivalent SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsforge.llm import language, quality
from obsforge.llm.common import documents, held_out
from obsforge.llm.decontaminate import MIN_LITERALS, MIN_SHARE, MIN_WORDS, UNITS, WINDOW, contaminated
from obsforge.llm.exact_dedup import exact_duplicates
from obsforge.llm.filter_audit import audit
from obsforge.llm.importance import importance_resampling
from obsforge.llm.licenses import scan_licenses
from obsforge.llm.lm_score import pseudo_likelihood
from obsforge.llm.near_dedup import near_duplicates
from obsforge.llm.packing import pack
from obsforge.llm.quality_rules import quality_rules
from obsforge.llm.secrets import find_secrets
from obsforge.llm.substring_dedup import without_repeats
from obsforge.session import written


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    """Where the installed vocabulary lies; the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

QUERIES["op7_exact_dedup"] = lambda spark, sf_dir: exact_duplicates(documents(spark, sf_dir))
SQL["op7_exact_dedup"] = """
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
    sha256(translate(coalesce(text, ''), chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS text_sha256
  FROM documents),
g AS (
  SELECT doc_id, text_sha256, count(*) OVER (PARTITION BY text_sha256) AS group_size,
    first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id) AS keep_id
  FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g
"""


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from the rows that are not held out, predicts every row."""
    docs = documents(spark, sf_dir)
    model = language.train(docs.where(~held_out(4, 2)))
    return language.identify(docs, model).select("doc_id", held_out(4, 2).alias("held_out"), "lang_pred", "score")


QUERIES["op5_language_id"] = op5_language_id
QUERIES["op1_near_dedup"] = lambda spark, sf_dir: near_duplicates(documents(spark, sf_dir), words=2)
SQL["op1_near_dedup"] = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS t
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(t) = 0 THEN [] WHEN len(t) = 1 THEN [t[1]]
    ELSE list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]) END) AS shingle
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT x, y FROM pairs JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * shared >= 80 * (p.n + q.n - shared)),
ends AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach AS (SELECT doc_id AS x, doc_id AS r FROM documents UNION SELECT e.y, reach.r FROM reach JOIN ends e ON e.x = reach.x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT x, min(r) AS component_id FROM reach GROUP BY x) c ON c.x = d.doc_id
"""


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


QUERIES["op10_decontaminate"] = op10_decontaminate
SQL["op10_decontaminate"] = rf"""
WITH raw AS (
  SELECT 'd' AS kind, doc_id AS id, text FROM documents
  UNION ALL SELECT DISTINCT 'b', item_id, text FROM benchmark WHERE item_id IS NOT NULL),
plain AS (
  SELECT kind, id, trim(regexp_replace(regexp_replace(regexp_replace(coalesce(text, ''), '(\p{{N}})[.,](\p{{N}})', '\1·\2', 'g'),
    '(\p{{N}})[.,](\p{{N}})', '\1·\2', 'g'), '[^\p{{L}}\p{{M}}\p{{N}}·]+', ' ', 'g')) AS p FROM raw),
w AS (SELECT kind, id, string_split(p, ' ') AS w FROM plain),
c AS (
  SELECT *, list_transform(w, lambda x: CASE WHEN regexp_matches(x, '^\p{{N}}') THEN '<n>'
    WHEN regexp_full_match(x, '\p{{Lu}}[\p{{Ll}}\p{{M}}]+') THEN '<name>' ELSE lower(x) END) AS c FROM w),
t AS (
  SELECT kind, id, w, list_transform(range(1, len(c) + 1), lambda i: CASE WHEN i > 1 AND c[i - 1] = '<n>'
    AND list_contains([{", ".join(f"'{u}'" for u in UNITS)}], c[i]) THEN '<u>' ELSE c[i] END) AS t FROM c),
items AS (SELECT id AS item_id, w, t, least({WINDOW}, len(t)) AS l FROM t WHERE kind = 'b' AND len(w) >= {MIN_WORDS}),
iw AS (SELECT *, unnest(range(1, len(t) - l + 2)) AS pos FROM items),
told AS (
  SELECT item_id, l, pos, array_to_string(t[pos:pos + l - 1], ' ') AS v FROM iw
  WHERE l - len(list_filter(t[pos:pos + l - 1], lambda x: x IN ('<n>', '<name>', '<u>'))) >= least({MIN_LITERALS}, ceil(l / 2))),
n AS (SELECT item_id, count(DISTINCT pos) AS n FROM told GROUP BY item_id),
dw AS (SELECT id AS doc_id, t, l, unnest(range(1, len(t) - l + 2)) AS pos FROM t CROSS JOIN (SELECT DISTINCT l FROM told) WHERE kind = 'd'),
dv AS (SELECT doc_id, l, pos, array_to_string(t[pos:pos + l - 1], ' ') AS v FROM dw),
hits AS (SELECT doc_id, item_id, told.l, dv.pos - told.pos AS shift, told.pos FROM dv JOIN told ON dv.v = told.v AND dv.l = told.l),
likely AS (
  SELECT doc_id, item_id, n FROM hits JOIN n USING (item_id) GROUP BY doc_id, item_id, n HAVING count(DISTINCT pos) >= {MIN_SHARE} * n),
slots AS (
  SELECT DISTINCT h.doc_id, h.item_id, shift, lower(i.w[p]) AS a, lower(d.w[p + shift]) AS b
  FROM (SELECT *, unnest(range(pos, pos + l)) AS p FROM hits JOIN likely USING (doc_id, item_id)) h
  JOIN items i ON i.item_id = h.item_id JOIN t d ON d.kind = 'd' AND d.id = h.doc_id WHERE i.t[p] IN ('<n>', '<name>', '<u>')),
loose AS (SELECT doc_id, item_id, shift FROM slots GROUP BY ALL HAVING count(*) > count(DISTINCT a)),
found AS (
  SELECT doc_id, item_id, count(DISTINCT pos) / n AS share FROM hits JOIN likely USING (doc_id, item_id)
  WHERE NOT EXISTS (SELECT 1 FROM loose o WHERE o.doc_id = hits.doc_id AND o.item_id = hits.item_id AND o.shift = hits.shift)
  GROUP BY doc_id, item_id, n HAVING count(DISTINCT pos) / n >= {MIN_SHARE})
SELECT d.doc_id, count(f.item_id) > 0 AS contaminated, count(f.item_id) AS n_items,
  coalesce(string_agg(CAST(f.item_id AS VARCHAR), ',' ORDER BY f.item_id), '') AS item_ids, coalesce(max(f.share), CAST(0 AS DOUBLE)) AS share
FROM documents d LEFT JOIN found f USING (doc_id) GROUP BY d.doc_id
"""
QUERIES["op2_packing"] = lambda spark, sf_dir: pack(documents(spark, sf_dir), tokenizer_file())
QUERIES["op9_substring_dedup"] = lambda spark, sf_dir: without_repeats(documents(spark, sf_dir))
SQL["op9_substring_dedup"] = """
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS t FROM documents),
p AS (SELECT doc_id, t, unnest(range(1, len(t) - 48)) AS p FROM w WHERE len(t) >= 50),
h AS (SELECT doc_id, p, md5(array_to_string(t[p:p + 49], ' ')) AS v FROM p),
m AS (SELECT v, min(doc_id) AS smallest FROM h GROUP BY v),
r AS (SELECT DISTINCT doc_id, unnest(range(p, p + 50)) AS i FROM h JOIN m USING (v) WHERE doc_id > smallest),
u AS (SELECT doc_id, unnest(range(1, len(t) + 1)) AS i, unnest(t) AS word FROM w),
k AS (
  SELECT u.doc_id, count(r.i) AS n_removed, string_agg(word, ' ' ORDER BY u.i) FILTER (r.i IS NULL) AS kept
  FROM u LEFT JOIN r ON r.doc_id = u.doc_id AND r.i = u.i GROUP BY u.doc_id)
SELECT w.doc_id, len(t) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN k USING (doc_id)
"""
QUERIES["op3_secrets"] = lambda spark, sf_dir: find_secrets(documents(spark, sf_dir))
QUERIES["op6_licenses"] = lambda spark, sf_dir: scan_licenses(documents(spark, sf_dir))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from the labelled rows that are not held out, scores every row."""
    held = held_out(5, 0)
    table = written(quality.statistics(documents(spark, sf_dir)), "statistics")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("quality").alias("label")).where(~held)
    ensemble = quality.fit(table.join(labels, "doc_id"))
    return quality.scored(table, ensemble).select("doc_id", held.alias("held_out"), "score", "predicted")


QUERIES["op4_quality"] = op4_quality
QUERIES["op8_pseudo_likelihood"] = lambda spark, sf_dir: pseudo_likelihood(documents(spark, sf_dir))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


QUERIES["op13_filter_audit"] = op13_filter_audit
SQL["op13_filter_audit"] = """
WITH RECURSIVE t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS w FROM t),
f AS (
  SELECT doc_id, part,
    CASE WHEN len(w) < 100 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END
    || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END AS fails
  FROM w),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
c AS (
  SELECT part, fails, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, count(*) AS n
  FROM f LEFT JOIN l USING (doc_id) GROUP BY ALL),
o AS (
  SELECT '' AS filter_order UNION ALL
  SELECT filter_order || x FROM o, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x) WHERE NOT contains(filter_order, x)),
s AS (SELECT filter_order, step, substr(filter_order, step, 1) AS x, substr(filter_order, 1, step - 1) AS earlier
  FROM (SELECT filter_order, unnest(range(1, 6))::INT AS step FROM o WHERE length(filter_order) = 5)),
j AS (
  SELECT part, filter_order, step, x, n, good, toxic, fails, contains(fails, x) AS here, translate(fails, earlier, '') <> fails AS gone FROM c, s),
r AS (
  SELECT part, filter_order, step, x,
    sum(CASE WHEN NOT gone AND NOT here THEN n ELSE 0 END)::BIGINT AS kept, sum(CASE WHEN NOT gone AND here THEN n ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN gone AND here THEN n ELSE 0 END)::BIGINT AS redundant, sum(CASE WHEN fails = x THEN n ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN NOT gone AND here AND good THEN n ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN NOT gone AND here AND toxic THEN n ELSE 0 END)::BIGINT AS toxic_lost
  FROM j GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, x))::BIGINT AS shapley
FROM r
"""


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = importance_resampling(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES["op11_importance_resampling"] = op11_importance_resampling
# The table of crc32 is made by its rule; the crc of a word folds over its bytes.
SQL["op11_importance_resampling"] = """
WITH crc AS (
  SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, v) ORDER BY v) AS t
  FROM (SELECT unnest(range(256)) AS v)),
raw AS (
  SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'b', 0, text FROM benchmark),
w AS (
  SELECT kind, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM raw),
one AS (SELECT kind, id, unnest(w) AS f FROM w),
h AS (SELECT f, hex(encode(f)) AS x FROM (SELECT DISTINCT f FROM one)),
codes AS (SELECT f, list_transform(range(0, len(x) // 2), lambda i: CAST('0x' || x[2 * i + 1:2 * i + 2] AS BIGINT)) AS bytes FROM h),
buckets AS (
  SELECT f, xor(list_reduce(bytes, lambda c, b: xor(t[xor(c, b) % 256 + 1], c >> 8), 4294967295), 4294967295) % 10000 AS bucket FROM codes, crc),
n AS (SELECT bucket, count(*) FILTER (kind = 'd') AS s, count(*) FILTER (kind = 'b') AS t FROM one JOIN buckets USING (f) GROUP BY bucket),
total AS (SELECT sum(s) AS s, sum(t) AS t FROM n),
gain AS (
  SELECT bucket, floor(1000 * ln((n.t + 1)::DOUBLE * (total.s + 10000)::DOUBLE / ((n.s + 1)::DOUBLE * (total.t + 10000)::DOUBLE)))::BIGINT AS gain FROM n, total),
weights AS (SELECT id AS doc_id, sum(gain)::BIGINT AS weight FROM one JOIN buckets USING (f) JOIN gain USING (bucket) WHERE kind = 'd' GROUP BY id),
scores AS (
  SELECT w.id AS doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || sha256('2024:' || w.id)[1:8] AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM w LEFT JOIN weights ON weights.doc_id = w.id WHERE kind = 'd'),
ranks AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n FROM scores WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN r <= 10 * n // 100 THEN r END AS rank FROM scores LEFT JOIN ranks USING (doc_id)
"""


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    judged = quality_rules(documents(spark, sf_dir), labels)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


QUERIES["op12_quality_rules"] = op12_quality_rules
