"""Registered queries over time and levels: as-of and interval joins, frames, cubes, sketches.

The clocks of ``orders`` (1995 to 2001) and ``events`` (one month) do not meet, so a day of the
orders' clock is taken as 18 minutes of the events' month (``ORDER_CLOCK``); both engines derive it
the same way.  Times are returned as microseconds, which compare alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scribeflow.operators import rollups, timeline
from scribeflow.plans import queries as Q
from scribeflow.plans.materialize import materialize
from scribeflow.plans.oracle import with_ctes
from scribeflow.plans.queries import register

#: A day of the orders' clock in the events' month.
ORDER_CLOCK = ("TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(18 * date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS INTEGER))")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def order_times(spark: SparkSession, sf: str) -> DataFrame:
    days = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1995-01-01").cast("date"))
    at = F.timestamp_micros(F.unix_micros(F.lit("2024-01-01 00:00:00").cast("timestamp")) + days.cast("long") * 18 * 60_000_000)
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey", at.alias("at"))


@register("asof_last_value", f"""
SELECT o.o_orderkey, e.event_id, e.event_type, e.value, CAST(epoch_us(o.at) - epoch_us(e.ts) AS BIGINT) AS age_us
FROM (SELECT o_orderkey, o_custkey, {ORDER_CLOCK} AS at FROM orders) o
ASOF LEFT JOIN (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id DESC) = 1) e
  ON o.o_custkey = e.user_id AND o.at > e.ts""")
def q_asof_last_value(spark, sf):
    out = timeline.last_before(order_times(spark, sf), table(spark, sf, "events"), [("o_custkey", "user_id")], "at", "ts",
                               {"event_id": "event_id", "event_type": "event_type", "value": "value", "ts": "ts"}, ["event_id"])
    age = F.unix_micros(F.col("at").cast("timestamp")) - F.unix_micros(F.col("ts").cast("timestamp"))
    return out.select("o_orderkey", "event_id", "event_type", "value", age.alias("age_us"))


@register("interval_overlap", """
WITH stays AS (
  SELECT l_orderkey, l_linenumber, o_custkey, l_shipdate AS s, l_shipdate + to_days(CAST(l_quantity AS INTEGER)) AS e
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
windows AS (SELECT o_orderkey, o_custkey, o_orderdate AS s, o_orderdate + to_days(30) AS e FROM orders)
SELECT x.l_orderkey, x.l_linenumber, y.o_orderkey, CAST(epoch_us(least(x.e, y.e)) - epoch_us(greatest(x.s, y.s)) AS BIGINT) AS overlap_us
FROM stays x JOIN windows y ON x.o_custkey = y.o_custkey AND x.s < y.e AND y.s < x.e""")
def q_interval_overlap(spark, sf):
    """A stay lasts from the ship date for as many days as the line's quantity; an order's window 30 days."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    later = lambda c, days: F.col(c).cast("timestamp") + F.make_dt_interval(days)
    stays = (table(spark, sf, "lineitem").join(orders, F.col("o_orderkey") == F.col("l_orderkey"))
             .select("l_orderkey", "l_linenumber", "o_custkey", "l_shipdate", later("l_shipdate", F.col("l_quantity").cast("int")).alias("received")))
    windows = orders.withColumn("closed", later("o_orderdate", F.lit(30)))
    return timeline.overlaps(stays, windows, [("o_custkey", "o_custkey")], ("l_shipdate", "received"), ("o_orderdate", "closed"),
                             {"l_orderkey": "l_orderkey", "l_linenumber": "l_linenumber"}, {"o_orderkey": "o_orderkey"}, finest=timeline.DAY)


@register("rolling_baseline", """
SELECT event_id, user_id, event_type, CAST(count(value) OVER w AS BIGINT) AS n_past,
       CAST(sum(CAST(value AS DECIMAL(18,6))) OVER w AS DOUBLE) / nullif(count(value) OVER w, 0) AS mean_past
FROM events WINDOW w AS (PARTITION BY user_id, event_type ORDER BY ts RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND CURRENT ROW)""")
def q_rolling_baseline(spark, sf):
    """Each event's value against the mean of its user's and type's past seven days (events cover a month)."""
    out = timeline.rolling_mean(table(spark, sf, "events"), ["user_id", "event_type"], "ts", "value", 7 * timeline.DAY)
    return out.select("event_id", "user_id", "event_type", "n_past", "mean_past")


@register("findings_cube", with_ctes("""
SELECT e.type, f.status, CASE WHEN e.src_rank = 0 THEN 'pdf_table' ELSE 'text_ruler' END AS source,
       CAST(grouping_id(e.type, f.status, CASE WHEN e.src_rank = 0 THEN 'pdf_table' ELSE 'text_ruler' END) AS BIGINT) AS grouping_id,
       count(*) AS n, CAST(count(f.value_num) AS BIGINT) AS n_numeric, count(DISTINCT f.test_name) AS n_tests
FROM findings f JOIN ents e ON e.doc_id = f.doc_id AND e.seq = f.seq
GROUP BY CUBE (e.type, f.status, CASE WHEN e.src_rank = 0 THEN 'pdf_table' ELSE 'text_ruler' END)""", ["findings", "ents"]))
def q_findings_cube(spark, sf):
    e = Q.entities(spark, sf)
    found = Q.finds(spark, sf).select("doc_id", "seq", "status", "value_num", "test_name")
    rows = found.join(e.select("doc_id", "seq", "type", "source"), ["doc_id", "seq"])
    return rollups.cube(rows, ["type", "status", "source"],
                        [F.count("*").alias("n"), F.count("value_num").alias("n_numeric"), F.countDistinct("test_name").alias("n_tests")]
                        ).withColumn("grouping_id", F.col("grouping_id").cast("long"))


@register("sketch_rollup", """
SELECT coalesce(CAST(day AS VARCHAR), 'all') AS day, n, n_users, true AS users_in_error, true AS median_in_error, true AS high_in_error
FROM (SELECT CAST(ts AS DATE) AS day, count(*) AS n, count(DISTINCT user_id) AS n_users FROM events GROUP BY GROUPING SETS ((CAST(ts AS DATE)), ()))""")
def q_sketch_rollup(spark, sf):
    """Sketches by day and event type are stored; days and the whole month are answered from them, and
    held against exact counts and ranks of the events."""
    events = table(spark, sf, "events").withColumn("day", F.col("ts").cast("date").cast("string"))
    state = materialize(rollups.sketches(events, ["day", "event_type"], "user_id", "value"), "event-sketches")
    days = rollups.merged(state, ["day"])
    told = rollups.answers(days.unionByName(rollups.merged(state.withColumn("day", F.lit("all")), ["day"])), [0.5, 0.95])
    both = events.withColumn("day", F.explode(F.array("day", F.lit("all"))))
    exact = both.join(told.select("day", "q50", "q95"), "day").groupBy("day").agg(
        F.countDistinct("user_id").alias("n_users"), F.count("value").alias("n_values"),
        *(F.count_if(F.col("value") <= F.col(q)).alias(f"to_{q}") for q in ("q50", "q95")),
        *(F.count_if(F.col("value") < F.col(q)).alias(f"below_{q}") for q in ("q50", "q95")))
    within = lambda q, p: ((F.col(f"to_{q}") / F.col("n_values") >= p - rollups.RANK_ERROR)
                           & (F.col(f"below_{q}") / F.col("n_values") <= p + rollups.RANK_ERROR))
    return told.join(exact, "day").select(
        "day", "n", "n_users",
        (F.abs(F.col("distinct_about") - F.col("n_users")) <= rollups.DISTINCT_ERROR * F.col("n_users")).alias("users_in_error"),
        within("q50", 0.5).alias("median_in_error"), within("q95", 0.95).alias("high_in_error"))
