"""Sources and sinks, projections, missing values, validation."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsforge.operators import clean, impute, profile, split, validate
from obsforge.operators.validate import Rule
from obsforge.queries.base import query, rounded, table
from obsforge.session import new_path, written
from obsforge.sources import tables

LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
LINE_HASH = "md5(concat_ws('|', '42', l_orderkey, l_linenumber, l_partkey, l_suppkey))"

# Exact class quotas and hash order, as in the stratified split.
SPLIT_SQL = f"""
WITH base AS (SELECT *, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label, {LINE_HASH} AS h FROM lineitem),
cnt AS (SELECT label, count(*) AS n FROM base GROUP BY label),
tot AS (SELECT CAST(sum(n) AS BIGINT) AS total FROM cnt),
exa AS (SELECT label, n, total - CAST(ceil(CAST(0.2 AS DOUBLE) * total) AS BIGINT) AS training, total FROM cnt, tot),
fra AS (SELECT label, n, training, CAST(n AS DOUBLE) * training / total AS share FROM exa),
quo AS (SELECT label, n, training, floor(share) AS base_share,
  row_number() OVER (ORDER BY floor(share) - share, label) AS pos, sum(floor(share)) OVER () AS given FROM fra),
fin AS (SELECT label, CAST(n - base_share - CASE WHEN pos <= training - given THEN 1 ELSE 0 END AS BIGINT) AS quota FROM quo),
num AS (SELECT b.*, row_number() OVER (PARTITION BY label ORDER BY h) AS rn FROM base b),
spl AS (SELECT num.*, CASE WHEN rn <= quota THEN 'test' ELSE 'train' END AS split FROM num JOIN fin USING (label))
"""


def labelled_lines(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return lines.withColumn("label", F.when(F.col("l_returnflag") == "R", 1).otherwise(0))


EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


@query("S1_csv_history", "SELECT event_id, ts, user_id, nullif(event_type, 'error') AS event_type, value, props FROM events")
def s1(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    path = new_path(spark, "events-csv")
    texts = events.select(
        "event_id",
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"),
        "user_id",
        F.when(F.col("event_type") == "error", "NA").otherwise(F.col("event_type")).alias("event_type"),
        "value",
        "props",
    )
    tables.write_snapshot(texts, path, "csv")
    return tables.read_history(spark, path, EVENT_SCHEMA)


def event_texts(spark, sf_dir):
    return table(spark, sf_dir, "events").withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


def write_two_orders(spark, sf_dir, folder):
    """Events as CSV files of two orders of columns: those of type `view` with the columns reversed and all names quoted."""
    texts = event_texts(spark, sf_dir)
    tables.write_snapshot(texts.where("event_type <> 'view'"), f"{folder}/day=1", "csv")
    swapped = texts.where("event_type = 'view'").select(*reversed(texts.columns))
    swapped.write.options(**tables.CSV, quoteAll=True).csv(f"{folder}/day=2")
    return f"{folder}/*"


@query("S1_two_orders", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def s1_orders(spark, sf_dir):
    """A folder whose files differ in the order of their columns; each is read by its own header."""
    return tables.read_history(spark, write_two_orders(spark, sf_dir, new_path(spark, "events-csv")), EVENT_SCHEMA)


@query("S2_snapshot_write", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders")
def s2(spark, sf_dir):
    path = new_path(spark, tables.cleaned_name("orders.csv"))
    tables.write_snapshot(table(spark, sf_dir, "orders"), path)
    return spark.read.parquet(path)


@query("S3_append_new", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def s3(spark, sf_dir):
    orders, path = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice"), new_path(spark, "appended")
    tables.append_new(orders.where("o_orderstatus = 'F'"), path, ["o_orderkey"], 0)
    tables.append_new(orders, path, ["o_orderkey"], 1)
    return tables.append_new(orders, path, ["o_orderkey"], 1).drop("batch_id")


@query(
    "S4_record_defaults",
    'SELECT p_partkey, p_retailprice, CAST(0 AS DOUBLE) AS "Evaporation", CAST(0 AS DOUBLE) AS "Sunshine" FROM part',
)
def s4(spark, sf_dir):
    return tables.with_defaults(table(spark, sf_dir, "part").select("p_partkey", "p_retailprice"))


@query(
    "S5_split_write",
    SPLIT_SQL + "SELECT split, label, count(*) AS n, round(sum(l_quantity), 2) AS quantity FROM spl GROUP BY split, label",
)
def s5(spark, sf_dir):
    path = new_path(spark, "split")
    tables.write_split(split.stratified(labelled_lines(spark, sf_dir), "label", LINE_KEY), path)
    grouped = spark.read.parquet(path).groupBy("split", "label")
    return grouped.agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"))


@query(
    "S8_split_reload",
    SPLIT_SQL + "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, label FROM spl WHERE split = 'test'",
)
def s8(spark, sf_dir):
    path = new_path(spark, "split")
    tables.write_split(split.stratified(labelled_lines(spark, sf_dir), "label", LINE_KEY), path)
    return tables.read_split(spark, path, "test").select(*LINE_KEY, "label")


@query("P1_binary_map", "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS o_orderstatus FROM orders")
def p1(spark, sf_dir):
    return clean.binary_map(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), ["o_orderstatus", "absent"], "F", "O")


@query("P2_drop_columns", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag, l_linestatus FROM lineitem")
def p2(spark, sf_dir):
    return clean.drop_columns(table(spark, sf_dir, "lineitem"), ["l_extendedprice", "l_discount", "l_tax", "l_shipdate", "absent"])


@query(
    "P3_drop_unlabelled",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 1 ELSE 0 END AS today,
    CASE o_orderpriority WHEN '1-URGENT' THEN 1 ELSE 0 END AS tomorrow FROM orders
    WHERE o_orderstatus IN ('F', 'O') AND o_orderpriority IN ('1-URGENT', '5-LOW')""",
)
def p3(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("today"), F.col("o_orderpriority").alias("tomorrow"))
    mapped = clean.binary_map(clean.binary_map(orders, ["today"], "F", "O"), ["tomorrow"], "1-URGENT", "5-LOW")
    return clean.drop_unlabelled(mapped, ["today", "tomorrow"])


PART_KINDS = {
    "p_partkey": "continuous", "p_name": "categorical", "p_brand": "categorical", "p_type": "categorical",
    "p_size": "continuous", "p_retailprice": "continuous",
}


@query(
    "P4_column_kinds",
    "WITH g AS (SELECT * REPLACE (nullif(p_type, 'ECONOMY') AS p_type) FROM part) "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", '{kind}' AS kind, count(*) - count({c}) AS missing FROM g""" for c, kind in PART_KINDS.items()
    ),
)
def p4(spark, sf_dir):
    part = table(spark, sf_dir, "part").withColumn("p_type", F.nullif("p_type", F.lit("ECONOMY")))
    return profile.column_kinds(part).join(profile.missing_profile(part), "column").select("column", "kind", "missing")


@query(
    "P5_features_and_label",
    """SELECT CAST(l_linenumber AS DOUBLE) AS l_linenumber, l_quantity, l_extendedprice,
    CASE l_returnflag WHEN 'R' THEN 1 ELSE 0 END AS label FROM lineitem""",
)
def p5(spark, sf_dir):
    return clean.features_and_label(labelled_lines(spark, sf_dir).select("l_linenumber", "l_quantity", "l_extendedprice", "label"), "label")


@query("P6_align", "SELECT p_size, CAST(NULL AS DOUBLE) AS absent, p_partkey FROM part")
def p6(spark, sf_dir):
    return clean.align(table(spark, sf_dir, "part"), ["p_size", "absent", "p_partkey"])


@query("P7_without_label", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders")
def p7(spark, sf_dir):
    return clean.drop_columns(table(spark, sf_dir, "orders").drop("o_orderdate"), ["o_orderstatus"])


@query("P8_first_rows", "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 5")
def p8(spark, sf_dir):
    return clean.first_rows(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice"), ["o_orderdate", "o_orderkey"], 5)


@query(
    "P9_label_text",
    """SELECT prediction, prediction_label, count(*) AS n FROM (SELECT CASE WHEN l_quantity >= 25 THEN 1 ELSE 0 END AS prediction,
    CASE WHEN l_quantity >= 25 THEN 'Yes' ELSE 'No' END AS prediction_label FROM lineitem) GROUP BY ALL""",
)
def p9(spark, sf_dir):
    flagged = table(spark, sf_dir, "lineitem").select((F.col("l_quantity") >= 25).cast("int").alias("prediction"))
    return clean.with_label_text(flagged, "prediction").groupBy("prediction", "prediction_label").agg(F.count("*").alias("n"))


@query(
    "P11_key_values",
    """SELECT p_partkey, key, value FROM (
    SELECT p_partkey, 'p_name' AS key, p_name AS value FROM part
    UNION ALL SELECT p_partkey, 'p_type', coalesce(nullif(p_type, 'ECONOMY'), 'NA') FROM part
    UNION ALL SELECT p_partkey, 'p_size', CAST(p_size AS VARCHAR) FROM part)""",
)
def p11(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", F.nullif("p_type", F.lit("ECONOMY")).alias("p_type"), "p_size")
    return clean.key_values(part, ["p_partkey"])


N1_SQL = """WITH e AS (SELECT event_id, nullif(event_type, 'error') AS event_type FROM events),
m AS (SELECT event_type AS mode FROM e WHERE event_type IS NOT NULL GROUP BY event_type ORDER BY count(*) DESC, event_type LIMIT 1)
SELECT event_id, coalesce(event_type, mode) AS event_type FROM e, m"""


@query("N1_mode_fill", N1_SQL)
def n1(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", F.nullif("event_type", F.lit("error")).alias("event_type"))
    return clean.fill_mode(events, clean.fit_mode(events, ["event_type"]))


@query(
    "N2_stage_counts",
    """WITH o AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS s,
      nullif(o_orderpriority, '5-LOW') AS p FROM orders)
    SELECT 0 AS position, 'mapped' AS stage, count(*) AS n_rows,
      CAST(sum(CASE WHEN s IS NULL THEN 1 ELSE 0 END + CASE WHEN p IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_cells FROM o
    UNION ALL SELECT 1, 'filled', count(*), CAST(sum(CASE WHEN s IS NULL THEN 1 ELSE 0 END) AS BIGINT) FROM o
    UNION ALL SELECT 2, 'labelled', count(*), 0 FROM o WHERE s IS NOT NULL""",
)
def n2(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderstatus").alias("s"), F.nullif("o_orderpriority", F.lit("5-LOW")).alias("p")
    )
    mapped = clean.binary_map(orders, ["s"], "F", "O")
    filled = clean.fill_mode(mapped, clean.fit_mode(mapped, ["p"]))
    return clean.stage_counts({"mapped": mapped, "filled": filled, "labelled": clean.drop_unlabelled(filled, ["s"])})


def gapped_lines(spark, sf_dir):
    """Prices of returned items and quantities of open ones are unknown."""
    return table(spark, sf_dir, "lineitem").select(
        *LINE_KEY,
        F.when(F.col("l_returnflag") != "R", F.col("l_extendedprice")).alias("price"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_linenumber").cast("double").alias("line"),
    )


@query(
    "N3_iterative_imputation",
    """WITH g AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_returnflag <> 'R' THEN l_extendedprice END AS price,
      l_quantity AS quantity FROM lineitem),
    f AS (SELECT regr_slope(price, quantity) AS a, regr_intercept(price, quantity) AS b FROM g WHERE price IS NOT NULL)
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(coalesce(price, a * quantity + b), 3) AS price,
      round(quantity, 3) AS quantity FROM g, f""",
)
def n3(spark, sf_dir):
    lines = gapped_lines(spark, sf_dir).drop("line")
    return rounded(impute.mice(lines, ["price", "quantity"], estimator="ols"), 3)


def _chain(round_: int) -> str:
    """One round of the chain in SQL: quantity (fewer gaps) on price, then price on the new quantity."""
    old = f"c{round_ - 1}"
    return f"""
    a{round_} AS (SELECT regr_slope(quantity, p) AS s, regr_intercept(quantity, p) AS i FROM {old} WHERE quantity IS NOT NULL),
    b{round_} AS (SELECT c.* REPLACE (coalesce(quantity, s * p + i) AS q) FROM {old} c, a{round_}),
    d{round_} AS (SELECT regr_slope(price, q) AS s, regr_intercept(price, q) AS i FROM b{round_} WHERE price IS NOT NULL),
    c{round_} AS (SELECT c.* REPLACE (coalesce(price, s * q + i) AS p) FROM b{round_} c, d{round_})"""


@query(
    "N3_iterative_imputation_chain",
    """WITH g AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_returnflag <> 'R' THEN l_extendedprice END AS price,
      CASE WHEN l_linenumber <> 3 THEN l_quantity END AS quantity FROM lineitem),
    m AS (SELECT avg(price) AS mp, avg(quantity) AS mq FROM g),
    c0 AS (SELECT g.*, coalesce(price, mp) AS p, coalesce(quantity, mq) AS q FROM g, m),"""
    + ",".join(_chain(r) for r in (1, 2, 3))
    + " SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(p, 3) AS price, round(q, 3) AS quantity FROM c3",
)
def n3_chain(spark, sf_dir):
    """Gaps in both columns, three rounds of least squares."""
    lines = gapped_lines(spark, sf_dir).withColumn("quantity", F.when(F.col("line") != 3, F.col("quantity"))).drop("line")
    return rounded(impute.mice(lines, ["price", "quantity"], max_iter=3, tol=0.0, estimator="ols"), 3)


BAYES_GAPS = """WITH g AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_returnflag <> 'R' THEN l_extendedprice END AS price,
  CASE WHEN l_linenumber <> 3 THEN l_quantity END AS quantity, l_extendedprice AS true_price FROM lineitem)
"""


def _bayes(spark, sf_dir):
    lines = gapped_lines(spark, sf_dir).withColumn("quantity", F.when(F.col("line") != 3, F.col("quantity")))
    filled = impute.mice(lines, ["price", "quantity", "line"])
    gaps = written(lines.select(*[F.col(k).alias(f"__{k}") for k in LINE_KEY], F.col("price").alias("gap_price"), F.col("quantity").alias("gap_quantity")).distinct(), "gaps")
    return filled.join(gaps, [F.col(k) == F.col(f"__{k}") for k in LINE_KEY])


@query(
    "N3_iterative_imputation_bayes",
    BAYES_GAPS
    + """SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(price, 3) AS price, round(quantity, 3) AS quantity,
    TRUE AS complete FROM g""",
)
def n3_bayes(spark, sf_dir):
    """Observed cells stay as they are, gaps are filled."""
    both = _bayes(spark, sf_dir)
    return rounded(
        both.select(
            *LINE_KEY,
            F.when(F.col("gap_price").isNotNull(), F.col("price")).alias("price"),
            F.when(F.col("gap_quantity").isNotNull(), F.col("quantity")).alias("quantity"),
            (F.col("price").isNotNull() & F.col("quantity").isNotNull()).alias("complete"),
        ).distinct(),
        3,
    )


# Prices that follow from quantity and line, but for a remainder of the keys; the text runs unchanged in both engines.
PLANTED_PRICE = "900 * l_quantity + 40 * l_linenumber + (l_orderkey * 31 + l_linenumber * 17 + l_partkey * 7) % 101 * 4 - 200"


@query(
    "N3_imputation_error",
    f"""WITH g AS (SELECT {PLANTED_PRICE} AS truth, l_returnflag = 'R' AS gap FROM lineitem),
    m AS (SELECT avg(truth) AS mean FROM g WHERE NOT gap) SELECT count(*) AS n_filled, round(avg(abs(truth - mean)), 3) AS mean_fill_error, TRUE AS better
    FROM g, m WHERE gap""",
)
def n3_error(spark, sf_dir):
    """Filled prices, which depend on the quantity, are at least twice as near to the true ones as the mean of the observed prices is."""
    lines = table(spark, sf_dir, "lineitem").withColumn("truth", F.expr(PLANTED_PRICE))
    gapped = lines.select(
        "truth",
        (F.col("l_returnflag") == "R").alias("gap"),
        F.when(F.col("l_returnflag") != "R", F.col("truth")).alias("price"),
        F.when(F.col("l_linenumber") != 3, F.col("l_quantity")).alias("quantity"),
        F.col("l_linenumber").cast("double").alias("line"),
    )
    filled = impute.mice(gapped, ["price", "quantity", "line"])
    mean = gapped.agg(F.avg("price")).first()[0]
    error, naive = F.avg(F.abs(F.col("truth") - F.col("price"))), F.avg(F.abs(F.col("truth") - mean))
    return filled.where("gap").agg(F.count("*").alias("n_filled"), F.round(naive, 3).alias("mean_fill_error"), (2 * error < naive).alias("better"))


def _chain_with_rest(round_: int) -> str:
    """As `_chain`, but rows without quantity take part in the regression of the price with their quantity from the round's start."""
    old = f"c{round_ - 1}"
    return f"""
    a{round_} AS (SELECT regr_slope(quantity, p) AS s, regr_intercept(quantity, p) AS i FROM {old} WHERE quantity IS NOT NULL),
    b{round_} AS (SELECT c.* REPLACE (coalesce(quantity, s * p + i) AS q), q AS before FROM {old} c, a{round_}),
    d{round_} AS (SELECT regr_slope(price, before) AS s, regr_intercept(price, before) AS i FROM b{round_} WHERE price IS NOT NULL),
    c{round_} AS (SELECT c.* EXCLUDE (before) REPLACE (coalesce(price, s * q + i) AS p) FROM b{round_} c, d{round_})"""


@query(
    "N3_many_patterns",
    """WITH g AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_returnflag <> 'R' THEN l_extendedprice END AS price,
      CASE WHEN l_linenumber <> 3 THEN l_quantity END AS quantity FROM lineitem),
    m AS (SELECT avg(price) AS mp, avg(quantity) AS mq FROM g),
    c0 AS (SELECT g.*, coalesce(price, mp) AS p, coalesce(quantity, mq) AS q FROM g, m),"""
    + ",".join(_chain_with_rest(r) for r in (1, 2, 3))
    + " SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(p, 3) AS price, round(q, 3) AS quantity FROM c3",
)
def n3_many(spark, sf_dir):
    """Three rounds with matrices for the two commonest of four patterns; the others are read once a round."""
    lines = gapped_lines(spark, sf_dir).withColumn("quantity", F.when(F.col("line") != 3, F.col("quantity"))).drop("line")
    return rounded(impute.mice(lines, ["price", "quantity"], max_iter=3, tol=0.0, estimator="ols", matrix_cells=2 * 3**2), 3)


@query(
    "N4_median_fill",
    """WITH g AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_returnflag <> 'R' THEN l_extendedprice END AS price,
      CASE WHEN l_linestatus = 'F' THEN l_quantity END AS quantity FROM lineitem),
    m AS (SELECT median(price) AS mp, median(quantity) AS mq FROM g)
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(coalesce(price, mp), 4) AS price,
      round(coalesce(quantity, mq), 4) AS quantity FROM g, m""",
)
def n4(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        *LINE_KEY,
        F.when(F.col("l_returnflag") != "R", F.col("l_extendedprice")).alias("price"),
        F.when(F.col("l_linestatus") == "F", F.col("l_quantity")).alias("quantity"),
    )
    return rounded(clean.fill_median(lines, clean.fit_median(lines, ["price", "quantity"])), 4)


@query(
    "N5_missing_flags",
    """SELECT c_custkey, nullif(c_mktsegment, 'MACHINERY') AS segment,
    CAST(CASE WHEN c_mktsegment = 'MACHINERY' THEN 1 ELSE 0 END AS DOUBLE) AS segment_missing FROM customer""",
)
def n5(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", F.nullif("c_mktsegment", F.lit("MACHINERY")).alias("segment"))
    return clean.missing_flags(customers, ["segment"])


LINE_RULES = [
    Rule("range", "l_discount", 0.0, 0.08),
    Rule("range", "l_quantity", 2.0, 48.0),
    Rule("range", "l_tax", low=0.0, open_low=True),
    Rule("at_least", "l_quantity", other="l_linenumber"),
    Rule("members", "l_returnflag", members=("A", "R")),
]
# Bits of the broken rules, in rule order.
LINE_BROKEN = """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN l_discount < 0 OR l_discount > CAST(0.08 AS DOUBLE) THEN 1 ELSE 0 END AS r1,
  CASE WHEN l_quantity < 2 OR l_quantity > 48 THEN 1 ELSE 0 END AS r2,
  CASE WHEN l_tax <= 0 THEN 1 ELSE 0 END AS r3,
  CASE WHEN l_quantity BETWEEN 2 AND 48 AND l_quantity < l_linenumber THEN 1 ELSE 0 END AS r4,
  CASE WHEN l_returnflag NOT IN ('A', 'R') THEN 1 ELSE 0 END AS r5 FROM lineitem"""


@query(
    "V1_range_rules",
    f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(r1 + r2 + r3 AS INTEGER) AS n_errors FROM ({LINE_BROKEN}) WHERE r1 + r2 + r3 > 0",
)
def v1(spark, sf_dir):
    rejects = validate.check(table(spark, sf_dir, "lineitem"), LINE_RULES[:3])[1]
    return rejects.select(*LINE_KEY, F.size("errors").alias("n_errors"))


@query("V2_cross_field", f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM ({LINE_BROKEN}) WHERE r4 = 1")
def v2(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return lines.where(validate.violation(lines, LINE_RULES[3], LINE_RULES)).select(*LINE_KEY)


@query("V3_members", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus NOT IN ('F', 'O')")
def v3(spark, sf_dir):
    rule = Rule("members", "o_orderstatus", members=("F", "O"))
    return validate.check(table(spark, sf_dir, "orders"), [rule])[1].select("o_orderkey", "o_orderstatus")


@query(
    "V4_required_number",
    """WITH e AS (SELECT event_id, CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'view' THEN props
      ELSE json_extract_string(props, '$.k') END AS k FROM events)
    SELECT event_id, CASE WHEN k IS NULL THEN 'k:required' ELSE 'k:number' END AS error FROM e
    WHERE k IS NULL OR TRY_CAST(k AS DOUBLE) IS NULL""",
)
def v4(spark, sf_dir):
    k = F.get_json_object("props", "$.k")
    text = F.when(F.col("event_type") == "error", F.lit(None)).when(F.col("event_type") == "view", F.col("props")).otherwise(k)
    events = table(spark, sf_dir, "events").select("event_id", text.alias("k"))
    rejects = validate.check(events, [Rule("required", "k"), Rule("number", "k")])[1]
    return rejects.select("event_id", F.explode("errors").alias("error"))


@query(
    "V5_no_extra_fields",
    """SELECT event_id, array_to_string(list_sort([k for k in json_keys(props) if k <> 'user']), ',') AS extra FROM events
    WHERE len([k for k in json_keys(props) if k <> 'user']) > 0""",
)
def v5(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("__extra", validate.extra_keys("props", ["user"]))
    return events.where(F.size("__extra") > 0).select("event_id", F.array_join("__extra", ",").alias("extra"))


@query(
    "V6_violation_report",
    f"""SELECT * FROM (SELECT 'l_discount:range' AS rule, CAST(sum(r1) AS BIGINT) AS n FROM ({LINE_BROKEN})
    UNION ALL SELECT 'l_quantity:range', CAST(sum(r2) AS BIGINT) FROM ({LINE_BROKEN})
    UNION ALL SELECT 'l_tax:range', CAST(sum(r3) AS BIGINT) FROM ({LINE_BROKEN})
    UNION ALL SELECT 'l_quantity:at_least', CAST(sum(r4) AS BIGINT) FROM ({LINE_BROKEN})
    UNION ALL SELECT 'l_returnflag:members', CAST(sum(r5) AS BIGINT) FROM ({LINE_BROKEN})
    UNION ALL SELECT 'valid', count(*) FROM ({LINE_BROKEN}) WHERE r1 + r2 + r3 + r4 + r5 = 0) WHERE n > 0""",
)
def v6(spark, sf_dir):
    marked = validate.with_errors(table(spark, sf_dir, "lineitem"), LINE_RULES)
    outcome = F.when(F.size("errors") > 0, F.col("errors")).otherwise(F.array(F.lit("valid")))
    return validate.rule_counts(marked.select(outcome.alias("errors")))
