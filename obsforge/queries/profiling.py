"""Profiling."""

from __future__ import annotations

from pyspark.sql import functions as F

from obsforge.operators import clean, encode, profile
from obsforge.queries.base import query, rounded, table

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "labels", "embeddings", "pages", "benchmark", "conversations")


@query(
    "G1_shape",
    " UNION ALL ".join(
        f"""SELECT '{t}' AS name, (SELECT count(*) FROM {t}) AS n_rows,
        (SELECT count(*) FROM duckdb_columns() WHERE table_name = '{t}') AS n_columns"""
        for t in TABLES
    ),
)
def g1(spark, sf_dir):
    out = None
    for name in TABLES:
        row = profile.shape(table(spark, sf_dir, name)).select(F.lit(name).alias("name"), "n_rows", "n_columns")
        out = row if out is None else out.unionByName(row)
    return out


CUSTOMER = ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


@query(
    "G2_distinct_counts",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS n_distinct
        FROM (SELECT * REPLACE (nullif(c_mktsegment, 'MACHINERY') AS c_mktsegment) FROM customer)"""
        for c in CUSTOMER
    ),
)
def g2(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").withColumn("c_mktsegment", F.nullif("c_mktsegment", F.lit("MACHINERY")))
    return profile.distinct_counts(customers)


LINE_COLUMNS = (
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
    "l_linestatus", "l_shipdate",
)


@query(
    "G2_distinct_counts_approx",
    " UNION ALL ".join(f"""SELECT '{c}' AS "column", count(DISTINCT {c}) AS n_distinct, TRUE AS within FROM lineitem""" for c in LINE_COLUMNS),
)
def g2_approx(spark, sf_dir):
    """The estimates lie within three standard errors (5 % each) of the exact counts."""
    lines = table(spark, sf_dir, "lineitem").select(*LINE_COLUMNS)
    exact = profile.distinct_counts(lines)
    name, count = exact.columns[0], exact.columns[1]
    near = profile.distinct_counts(lines, approx=True).select(F.col(name).alias("__name"), F.col(count).alias("__near"))
    return exact.join(near, F.col(name) == F.col("__name")).select(*exact.columns, (F.abs(F.col("__near") - F.col(count)) <= 0.15 * F.col(count)).alias("within"))


@query("G3_distinct_values", "SELECT DISTINCT nullif(o_orderstatus, 'P') AS o_orderstatus FROM orders")
def g3(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("o_orderstatus", F.nullif("o_orderstatus", F.lit("P")))
    return profile.distinct_values(orders, "o_orderstatus")


@query(
    "G4_missing_profile",
    """WITH o AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS o_orderstatus, o_totalprice FROM orders)
    SELECT 'o_orderkey' AS "column", count(*) - count(o_orderkey) AS missing,
      round((count(*) - count(o_orderkey)) * CAST(100 AS DOUBLE) / count(*), 6) AS percent, 'bigint' AS dtype FROM o
    UNION ALL SELECT 'o_orderstatus', count(*) - count(o_orderstatus), round((count(*) - count(o_orderstatus)) * CAST(100 AS DOUBLE) / count(*), 6), 'int' FROM o
    UNION ALL SELECT 'o_totalprice', count(*) - count(o_totalprice), round((count(*) - count(o_totalprice)) * CAST(100 AS DOUBLE) / count(*), 6), 'double' FROM o""",
)
def g4(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return rounded(profile.missing_profile(clean.binary_map(orders, ["o_orderstatus"], "F", "O")))


@query(
    "G5_class_distribution",
    """SELECT l_returnflag, count(*) AS n, round(CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (), 6) AS share
    FROM lineitem GROUP BY l_returnflag""",
)
def g5(spark, sf_dir):
    return rounded(profile.class_distribution(table(spark, sf_dir, "lineitem"), "l_returnflag"))


CORRELATED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_gap"]
LINES_WITH_GAP = "(SELECT *, CASE WHEN l_linestatus = 'F' THEN l_extendedprice / l_quantity END AS l_gap FROM lineitem)"


def lines_with_gap(spark, sf_dir):
    gap = F.when(F.col("l_linestatus") == "F", F.col("l_extendedprice") / F.col("l_quantity"))
    return table(spark, sf_dir, "lineitem").withColumn("l_gap", gap)


@query(
    "G6_correlation",
    " UNION ALL ".join(
        f"SELECT '{b}' AS column_a, '{a}' AS column_b, round(corr({b}, {a}), 6) + 0 AS corr FROM {LINES_WITH_GAP}"
        for i, a in enumerate(CORRELATED)
        for b in CORRELATED[i + 1 :]
    ),
)
def g6(spark, sf_dir):
    return rounded(profile.correlation(lines_with_gap(spark, sf_dir), CORRELATED))


@query(
    "G6_correlation_wide",
    """WITH e AS (SELECT vec_id, unnest(embedding) AS v, unnest(range(len(embedding))) AS i FROM embeddings)
    SELECT concat('e', b.i) AS column_a, concat('e', a.i) AS column_b, round(corr(CAST(a.v AS DOUBLE), CAST(b.v AS DOUBLE)), 6) + 0 AS corr
    FROM e a JOIN e b ON a.vec_id = b.vec_id AND a.i < b.i GROUP BY a.i, b.i""",
)
def g6_wide(spark, sf_dir):
    """All pairs of the components of the embeddings."""
    rows = table(spark, sf_dir, "embeddings")
    width = len(rows.select("embedding").first()[0])
    return rounded(profile.correlation(rows.select(*[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(width)])))


# Factor of one of three columns from the three pairwise correlations.
def _vif3(own1, own2, rest):
    return f"1 / (1 - ({own1} * {own1} + {own2} * {own2} - 2 * {own1} * {own2} * {rest}) / (1 - {rest} * {rest}))"


THREE = """WITH x AS (SELECT l_quantity AS a, 2 * l_quantity + l_linenumber AS b, l_discount * 100 + l_linenumber AS c FROM lineitem),
r AS (SELECT corr(a, b) AS ab, corr(a, c) AS ac, corr(b, c) AS bc FROM x),
v AS (SELECT """ + ", ".join(
    [_vif3("ab", "ac", "bc") + " AS va", _vif3("ab", "bc", "ac") + " AS vb", _vif3("ac", "bc", "ab") + " AS vc", "ab", "ac", "bc FROM r)"]
)


def three_columns(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_quantity").alias("a"),
        (2 * F.col("l_quantity") + F.col("l_linenumber")).alias("b"),
        (F.col("l_discount") * 100 + F.col("l_linenumber")).alias("c"),
    )


@query(
    "G7_vif",
    THREE
    + """SELECT 'a' AS feature, round(va, 4) AS vif FROM v UNION ALL SELECT 'b', round(vb, 4) FROM v UNION ALL SELECT 'c', round(vc, 4) FROM v""",
)
def g7(spark, sf_dir):
    return rounded(profile.vif(three_columns(spark, sf_dir), ["a", "b", "c"]), 4)


@query(
    "G8_vif_eliminate",
    THREE
    + """, w AS (SELECT *, CASE WHEN va >= vb AND va >= vc THEN 'a' WHEN vb >= vc THEN 'b' ELSE 'c' END AS worst FROM v),
    k AS (SELECT *, CASE worst WHEN 'a' THEN bc WHEN 'b' THEN ac ELSE ab END AS left_r FROM w)
    SELECT f.feature, CASE WHEN f.feature = worst THEN 1 END AS dropped_at,
      round(CASE WHEN f.feature = worst THEN CASE worst WHEN 'a' THEN va WHEN 'b' THEN vb ELSE vc END
        ELSE 1 / (1 - left_r * left_r) END, 4) AS vif
    FROM k, (SELECT 'a' AS feature UNION ALL SELECT 'b' UNION ALL SELECT 'c') f""",
)
def g8(spark, sf_dir):
    return rounded(profile.vif_eliminate(three_columns(spark, sf_dir), ["a", "b", "c"], 10.0), 4)


@query(
    "G9_quantile_summary",
    """WITH s AS (SELECT (l_quantity - avg(l_quantity) OVER ()) / stddev_pop(l_quantity) OVER () AS l_quantity,
      (l_extendedprice - avg(l_extendedprice) OVER ()) / stddev_pop(l_extendedprice) OVER () AS l_extendedprice FROM lineitem)"""
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST({p} AS DOUBLE) AS prob, round(quantile_cont({c}, {p}), 6) + 0 AS value FROM s"""
        for c in ("l_quantity", "l_extendedprice")
        for p in profile.LETTER_PROBS
    ),
)
def g9(spark, sf_dir):
    columns = ["l_quantity", "l_extendedprice"]
    lines = table(spark, sf_dir, "lineitem").select(*columns)
    return rounded(profile.quantile_summary(encode.apply_scaler(lines, encode.fit_scaler(lines, columns)), columns))


@query(
    "G10_null_patterns",
    """SELECT concat(CASE WHEN o_orderstatus = 'P' THEN '1' ELSE '0' END, CASE WHEN o_orderpriority = '5-LOW' THEN '1' ELSE '0' END,
    CASE WHEN o_totalprice < 50000 THEN '1' ELSE '0' END) AS pattern, count(*) AS n FROM orders GROUP BY 1""",
)
def g10(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.nullif("o_orderstatus", F.lit("P")).alias("s"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("p"),
        F.when(F.col("o_totalprice") >= 50000, F.col("o_totalprice")).alias("t"),
    )
    return profile.null_patterns(orders)
