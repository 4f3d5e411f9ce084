"""Row feed: batches, invariants, fingerprints, staleness, stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from obsforge.functions.columns import text_fingerprint
from obsforge.operators import feed, pool as stretches, split
from obsforge.queries.base import query, table
from obsforge.queries.relational import EVENT_SCHEMA, write_two_orders
from obsforge.session import new_path
from obsforge.streaming import arrivals

EVENT_KEYS = ["ts", "event_id"]
POOL_SQL = """WITH r AS (SELECT *, row_number() OVER (ORDER BY ts, event_id) AS rn, count(*) OVER () AS n FROM events),
pool AS (SELECT *, row_number() OVER (ORDER BY ts, event_id) AS pos FROM r WHERE rn > CAST(floor(n * (CAST(2 AS DOUBLE) / 3)) AS BIGINT))
"""


def _fed(spark, sf_dir, sizes=(1, 1, 50, 1000)):
    """Pool of the later third of the events, and a state with one batch per size; each batch is asked for twice."""
    halves = split.chronological(table(spark, sf_dir, "events"), "ts", ["event_id"])
    path = new_path(spark, "events-split")
    halves.write.partitionBy("split").parquet(path)
    pool = spark.read.parquet(path).where("split = 'prediction'").drop("split")
    state = new_path(spark, "feed")
    for batch_id, n in enumerate(sizes):
        feed.consume(spark, pool, state, batch_id, EVENT_KEYS, n)
        feed.consume(spark, pool, state, batch_id, EVENT_KEYS, n)
    return pool, state


@query(
    "I1_take_next",
    POOL_SQL
    + """SELECT event_id, ts, user_id, event_type, value,
    CASE WHEN pos <= 1 THEN 0 WHEN pos <= 2 THEN 1 WHEN pos <= 52 THEN 2 ELSE 3 END AS batch_id FROM pool WHERE pos <= 1052""",
)
def i1(spark, sf_dir):
    _, state = _fed(spark, sf_dir)
    return feed.committed(spark, state).select("event_id", "ts", "user_id", "event_type", "value", "batch_id")


@query(
    "I1_take_many",
    """WITH l AS (SELECT CASE WHEN l_linenumber <> 3 THEN CAST(l_shipdate AS DATE) END AS ship, l_quantity FROM lineitem),
    r AS (SELECT ship, row_number() OVER (ORDER BY ship NULLS FIRST) AS pos FROM l)
    SELECT CASE WHEN pos <= 12000 THEN 0 ELSE 1 END AS batch_id, ship, count(*) AS n FROM r WHERE pos <= 18000 GROUP BY ALL""",
)
def i1_many(spark, sf_dir):
    """Batches beyond the top-n bound, from a pool whose key has gaps and is shared by many rows."""
    path, state = new_path(spark, "line-pool"), new_path(spark, "feed")
    ship = F.when(F.col("l_linenumber") != 3, F.col("l_shipdate").cast("date")).alias("ship")
    table(spark, sf_dir, "lineitem").select(ship, "l_orderkey", "l_linenumber", "l_quantity").write.parquet(path)
    pool = spark.read.parquet(path)
    for batch_id, n in enumerate((12_000, 6_000)):
        if batch_id == 0 or pool.count() > 12_000:
            feed.consume(spark, pool, state, batch_id, ["ship"], n)
    return feed.committed(spark, state).groupBy(F.col("batch_id"), "ship").agg(F.count("*").alias("n"))


ARRIVED = """WITH p AS (SELECT event_id, ts, event_type, event_type = 'view' AS late FROM events),
early AS (SELECT event_id FROM p WHERE NOT late ORDER BY ts, event_id LIMIT 500),
b AS (SELECT p.*, CASE WHEN early.event_id IS NOT NULL THEN 0 END AS batch_id FROM p LEFT JOIN early USING (event_id)),
r AS (SELECT *, row_number() OVER (PARTITION BY batch_id IS NULL ORDER BY ts, event_id) AS pos FROM b),
fed AS (SELECT event_id, ts, coalesce(batch_id, CASE WHEN pos <= 300 THEN 1 WHEN pos <= 301 THEN 2 END) AS batch_id FROM r)
"""


def _arrived(spark, sf_dir):
    """Events by day; those of type `view` arrive after the first batch was taken, anywhere in the order."""
    events = table(spark, sf_dir, "events")
    pool, state = stretches.Pool(spark, new_path(spark, "pool"), EVENT_KEYS), new_path(spark, "feed")
    pool.append(events.where("event_type <> 'view'"), 0)
    stretches.consume(pool, state, 0, 500)
    for _ in range(2):
        pool.append(events.where("event_type = 'view'"), 1)
    for batch_id, n in ((1, 300), (1, 300), (2, 1)):
        stretches.consume(pool, state, batch_id, n)
    return pool, state


@query("I1_stretches", ARRIVED + "SELECT event_id, ts, batch_id FROM fed WHERE batch_id IS NOT NULL")
def i1_stretches(spark, sf_dir):
    """Batches from a pool in stretches: late rows come first, in their place."""
    _, state = _arrived(spark, sf_dir)
    return feed.committed(spark, state).select("event_id", "ts", "batch_id")


@query(
    "I2_stretch_counters",
    ARRIVED
    + """SELECT CAST(floor(epoch_us(ts) / 86400000000) AS BIGINT) AS stretch, count(*) AS n_pool, count(batch_id) AS n_consumed,
    count(*) <> count(batch_id) AS open FROM fed GROUP BY 1""",
)
def i2_stretches(spark, sf_dir):
    """Counters of the pool and of the batches per stretch; only open stretches are read by the next batch."""
    pool, state = _arrived(spark, sf_dir)
    return pool.progress(state)


@query(
    "I2_pool_invariants",
    POOL_SQL
    + """SELECT count(*) AS n_pool, count(*) FILTER (pos <= 1052) AS n_consumed, count(*) FILTER (pos > 1052) AS n_left,
    CAST(0 AS BIGINT) AS n_repeated, TRUE AS adds_up, TRUE AS in_order FROM pool""",
)
def i2(spark, sf_dir):
    pool, state = _fed(spark, sf_dir)
    return feed.check_pool(pool, feed.committed(spark, state), EVENT_KEYS)


@query(
    "I3_fingerprint",
    """SELECT o_orderkey, md5(concat_ws('|', CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR),
    coalesce(nullif(o_orderstatus, 'P'), 'NA'), strftime(o_orderdate, '%Y-%m-%d'), o_orderpriority)) AS fingerprint FROM orders""",
)
def i3(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"),
        F.col("o_orderdate").cast("date").alias("o_orderdate"),
        "o_orderpriority",
    )
    return orders.select("o_orderkey", text_fingerprint(orders.columns).alias("fingerprint"))


@query(
    "I3_row_fingerprint_json",
    """SELECT o_orderkey, md5(concat('{"o_custkey":', o_custkey, ',"o_orderdate":"', strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%g'), '","o_orderkey":', o_orderkey,
    ',"o_orderpriority":"', o_orderpriority, '","o_orderstatus":"', o_orderstatus, '","o_totalprice":', o_totalprice, '}')) AS fingerprint FROM orders""",
)
def i3_json(spark, sf_dir):
    return feed.fingerprints(table(spark, sf_dir, "orders")).select("o_orderkey", "fingerprint")


@query(
    "I4_staleness",
    """WITH f AS (SELECT event_id, user_id, ts, md5(event_type) AS fingerprint FROM events)
    SELECT event_id, user_id, fingerprint, coalesce(lag(fingerprint) OVER (PARTITION BY user_id ORDER BY ts, event_id) <> fingerprint, TRUE) AS changed
    FROM f""",
)
def i4(spark, sf_dir):
    marked = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", text_fingerprint(["event_type"]).alias("fingerprint"))
    return feed.staleness(marked, "fingerprint", ["ts", "event_id"], ["user_id"]).select("event_id", "user_id", "fingerprint", "changed")


@query("I5_stream", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def i5(spark, sf_dir):
    """Events arrive as files, those of type `view` twice; the table holds each once."""
    folder, target, checkpoint = (new_path(spark, n) for n in ("arrivals", "arrived", "stream-state"))
    texts = table(spark, sf_dir, "events").withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    options = {"header": True, "escape": '"'}
    texts.write.options(**options).csv(folder)
    texts.where("event_type = 'view'").write.mode("append").options(**options).csv(folder)
    stream = arrivals.read_arrivals(spark, folder, EVENT_SCHEMA)
    arrivals.run_stream(stream, target, checkpoint, ["event_id"]).awaitTermination()
    return arrivals.arrivals_table(spark, target).select(*EVENT_SCHEMA.names)


@query("I5_stream_two_orders", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def i5_orders(spark, sf_dir):
    """Files of two orders of columns arrive; each is read by its own header."""
    folder, target, checkpoint = (new_path(spark, n) for n in ("arrivals", "arrived", "stream-state"))
    lines = arrivals.read_arriving_lines(spark, write_two_orders(spark, sf_dir, folder), files_per_batch=100)
    arrivals.run_stream(lines, target, checkpoint, ["event_id"], schema=EVENT_SCHEMA).awaitTermination()
    return arrivals.arrivals_table(spark, target).select(*EVENT_SCHEMA.names)


@query(
    "I5_stream_deduplicated",
    "SELECT event_type, count(*) AS n FROM events GROUP BY event_type",
)
def i5_watermark(spark, sf_dir):
    """The same repeats dropped by watermarked state instead of a look into the target."""
    folder, target, checkpoint = (new_path(spark, n) for n in ("arrivals", "arrived", "stream-state"))
    events = table(spark, sf_dir, "events")
    events.write.parquet(folder)
    events.where("event_type = 'view'").write.mode("append").parquet(folder)
    stream = spark.readStream.schema(events.schema).parquet(folder)
    fresh = arrivals.deduplicated(stream, "ts", ["event_id"], "60 days")
    query = fresh.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(target)
    query.awaitTermination()
    return spark.read.parquet(target).groupBy("event_type").agg(F.count("*").alias("n"))


@query(
    "I6_feed_report",
    POOL_SQL
    + """, b AS (SELECT *, CASE WHEN pos <= 1 THEN 0 WHEN pos <= 2 THEN 1 WHEN pos <= 52 THEN 2 ELSE 3 END AS batch_id FROM pool WHERE pos <= 1052),
    t AS (SELECT count(*) AS total FROM pool)
    SELECT batch_id, count(*) AS n_rows, min(ts) AS first_key, max(ts) AS last_key, max(total) - (min(pos) - 1) AS rows_before,
    max(total) - max(pos) AS rows_after FROM b, t GROUP BY batch_id""",
)
def i6(spark, sf_dir):
    pool, state = _fed(spark, sf_dir)
    return feed.feed_report(feed.committed(spark, state), pool.count(), EVENT_KEYS)
