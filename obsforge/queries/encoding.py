"""Codes, scaling, outliers, splits."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from obsforge.operators import encode, outliers, split
from obsforge.queries.base import query, rounded, table
from obsforge.queries.relational import LINE_KEY, SPLIT_SQL, labelled_lines
from obsforge.session import cut_lineage

CODES_SQL = """WITH v AS (SELECT DISTINCT 'p_brand' AS "column", p_brand AS value FROM part
  UNION SELECT DISTINCT 'p_type', p_type FROM part),
c AS (SELECT "column", value, CAST(row_number() OVER (PARTITION BY "column" ORDER BY value) - 1 AS BIGINT) AS code FROM v)
"""


@query("E1_fit_codes", CODES_SQL + 'SELECT "column", value, code FROM c')
def e1(spark, sf_dir):
    return encode.fit_codes(table(spark, sf_dir, "part"), ["p_brand", "p_type"])


@query(
    "E2_apply_codes",
    CODES_SQL
    + """SELECT p_partkey, b.code AS p_brand, t.code AS p_type FROM part
    JOIN c b ON b."column" = 'p_brand' AND b.value = p_brand JOIN c t ON t."column" = 'p_type' AND t.value = p_type""",
)
def e2(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    return encode.apply_codes(part, cut_lineage(encode.fit_codes(part, ["p_brand", "p_type"])), ["p_brand", "p_type"])


@query("E3_decode", "SELECT p_partkey, p_brand, p_type FROM part")
def e3(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    codes = cut_lineage(encode.fit_codes(part, ["p_brand", "p_type"]))
    return encode.decode(encode.apply_codes(part, codes, ["p_brand", "p_type"]), codes, ["p_brand", "p_type"])


SCALED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "E4_fit_scaler",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", round(avg({c}), 6) AS mean, round(stddev_pop({c}), 6) AS std FROM lineitem""" for c in SCALED
    )
    + """ UNION ALL SELECT 'constant', CAST(5 AS DOUBLE), CAST(1 AS DOUBLE)""",
)
def e4(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumn("constant", F.lit(5.0))
    return rounded(encode.fit_scaler(lines, [*SCALED, "constant"]))


@query(
    "E5_apply_scaler",
    """WITH s AS (SELECT avg(l_quantity) AS mq, stddev_pop(l_quantity) AS sq, avg(l_extendedprice) AS mp, stddev_pop(l_extendedprice) AS sp FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round((l_quantity - mq) / sq, 6) + 0 AS l_quantity,
    round((l_extendedprice - mp) / sp, 6) + 0 AS l_extendedprice FROM lineitem, s""",
)
def e5(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(*LINE_KEY, "l_quantity", "l_extendedprice")
    return rounded(encode.apply_scaler(lines, encode.fit_scaler(lines, ["l_quantity", "l_extendedprice"])))


@query(
    "E6_assemble",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity AS v0, l_extendedprice AS v1, CAST(l_linenumber AS DOUBLE) AS v2 FROM lineitem",
)
def e6(spark, sf_dir):
    vectors = encode.assemble(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice", "l_linenumber"])
    parts = vectors.select(*LINE_KEY, vector_to_array("features").alias("v"))
    return parts.select(*LINE_KEY, *[F.col("v")[i].alias(f"v{i}") for i in range(3)])


FENCED = ["l_quantity", "l_extendedprice", "l_discount", "l_linenumber"]
# Quartiles 0.4 and 0.6 make the fences of uniform data narrow enough to have something outside.
FENCE_SQL = (
    "WITH q AS ("
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST(quantile_cont({c}, 0.4) AS DOUBLE) AS q1, CAST(quantile_cont({c}, 0.6) AS DOUBLE) AS q3,
        CAST(avg({c}) AS DOUBLE) AS mean, CAST(quantile_cont({c}, 0.5) AS DOUBLE) AS median FROM lineitem"""
        for c in FENCED
    )
    + """), f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS low, q3 + 1.5 * (q3 - q1) AS up FROM q),
p AS (SELECT f.* FROM f WHERE "column" = 'l_extendedprice'), n AS (SELECT f.* FROM f WHERE "column" = 'l_quantity')
"""
)


def line_fences(lines, columns=FENCED, **options):
    return outliers.fit_fences(lines, columns, 0.4, 0.6, **options)


@query(
    "O1_fit_fences",
    FENCE_SQL + 'SELECT "column", round(q1, 6) AS q1, round(q3, 6) AS q3, round(low, 6) AS low, round(up, 6) AS up FROM f',
)
def o1(spark, sf_dir):
    return rounded(line_fences(table(spark, sf_dir, "lineitem")).drop("mean", "median"))


@query(
    "O1_fit_fences_approx",
    " UNION ALL ".join(f"""SELECT '{c}' AS "column", count({c}) AS n, TRUE AS q1_within, TRUE AS q3_within, TRUE AS fences_follow FROM lineitem""" for c in FENCED),
)
def o1_approx(spark, sf_dir):
    """The sketched quartiles lie within the sketch's rank error (1 in 10,000, and one row) of the asked ranks."""
    lines = table(spark, sf_dir, "lineitem").select(*FENCED)
    fences = {r["column"]: r for r in line_fences(lines, approx=True).collect()}

    def within(c, value, share):
        slack = F.count(c) / 10_000 + 1
        return (F.count_if(F.col(c) < value) <= share * F.count(c) + slack) & (F.count_if(F.col(c) <= value) >= share * F.count(c) - slack)

    def follows(r):
        spread = 1.5 * (r["q3"] - r["q1"])
        return F.lit(abs(r["low"] - r["q1"] + spread) < 1e-6 and abs(r["up"] - r["q3"] - spread) < 1e-6)

    checks = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"), F.count(c).alias("n"), within(c, r["q1"], 0.4).alias("q1_within"),
                within(c, r["q3"], 0.6).alias("q3_within"), follows(r).alias("fences_follow"),
            )
            for c, r in fences.items()
        ]
    )
    return lines.agg(checks.alias("c")).select(F.inline("c"))


@query(
    "O2_has_outliers",
    FENCE_SQL
    + " UNION ALL ".join(
        f"""SELECT f."column", sum(CASE WHEN {c} < low OR {c} > up THEN 1 ELSE 0 END) > 0 AS has_outliers,
        CAST(sum(CASE WHEN {c} < low THEN 1 ELSE 0 END) AS BIGINT) AS n_low, CAST(sum(CASE WHEN {c} > up THEN 1 ELSE 0 END) AS BIGINT) AS n_up
        FROM lineitem, f WHERE f."column" = '{c}' GROUP BY f."column" """
        for c in FENCED
    ),
)
def o2(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return outliers.has_outliers(lines, line_fences(lines))


def _fenced(spark, sf_dir, mode, centre=None):
    lines = table(spark, sf_dir, "lineitem").select(
        *LINE_KEY, "l_extendedprice", F.when(F.col("l_linestatus") == "F", F.col("l_quantity")).alias("l_quantity")
    )
    columns = ["l_extendedprice", "l_quantity"]
    fences = line_fences(table(spark, sf_dir, "lineitem"), columns, centre=centre)
    return rounded(outliers.apply_fences(lines, fences, mode), 4)


def _fenced_sql(price, quantity):
    return (
        FENCE_SQL
        + f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round({price}, 4) AS l_extendedprice,
    round(CASE WHEN l_linestatus = 'F' THEN {quantity} END, 4) AS l_quantity FROM lineitem, p, n"""
    )


def _outside_sql(column, alias, replacement):
    return f"CASE WHEN {column} < {alias}.low OR {column} > {alias}.up THEN {alias}.{replacement} ELSE {column} END"


@query(
    "O3_clip_fences",
    _fenced_sql("greatest(p.low, least(p.up, l_extendedprice))", "greatest(n.low, least(n.up, l_quantity))"),
)
def o3(spark, sf_dir):
    return _fenced(spark, sf_dir, "clip")


@query("O4_collapse_fences", _fenced_sql("p.low", "n.low"))
def o4(spark, sf_dir):
    return _fenced(spark, sf_dir, "collapse")


@query(
    "O5_replace_by_mean",
    _fenced_sql(_outside_sql("l_extendedprice", "p", "mean"), _outside_sql("l_quantity", "n", "mean")),
)
def o5(spark, sf_dir):
    return _fenced(spark, sf_dir, "mean", "mean")


@query(
    "O5_replace_by_median",
    _fenced_sql(_outside_sql("l_extendedprice", "p", "median"), _outside_sql("l_quantity", "n", "median")),
)
def o5_median(spark, sf_dir):
    return _fenced(spark, sf_dir, "median", "median")


@query(
    "H1_chronological_split",
    """WITH r AS (SELECT *, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS rn, count(*) OVER () AS n FROM orders)
    SELECT o_orderkey, o_orderdate, o_totalprice,
    CASE WHEN rn <= CAST(floor(n * (CAST(2 AS DOUBLE) / 3)) AS BIGINT) THEN 'training' ELSE 'prediction' END AS split FROM r""",
)
def h1(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return split.chronological(orders, "o_orderdate", ["o_orderkey"])


@query("H2_stratified_split", SPLIT_SQL + "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, label, split FROM spl")
def h2(spark, sf_dir):
    return split.stratified(labelled_lines(spark, sf_dir).select(*LINE_KEY, "label"), "label", LINE_KEY)


MANY_SQL = SPLIT_SQL.replace("CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label", "l_orderkey AS label").replace("ORDER BY floor(share) - share, label", "ORDER BY floor(share) - share, CAST(label AS VARCHAR)")


@query("H2_many_classes", MANY_SQL + "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, split FROM spl")
def h2_many(spark, sf_dir):
    """A label with a class per order: beyond the class bound rows are ranked within their class."""
    lines = table(spark, sf_dir, "lineitem").select(*LINE_KEY, F.col("l_orderkey").alias("label"))
    return split.stratified(lines, "label", LINE_KEY).drop("label")
