"""Registered queries of the stateful streams.

Rows of the given tables arrive in a few files, one micro-batch each; the rule that deals them out
is the same in both engines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scribeflow.plans.materialize import materialize, release, shuffles_dropped
from scribeflow.plans.queries import register
from scribeflow.plans.timeline_queries import table
from scribeflow.session import scratch_path
from scribeflow.sources.reference import by_key
from scribeflow.streaming import arrivals

DAYS_A_BATCH, DELAY = 6, "2 days"


#: Rows of a micro-batch that are written as one file; a larger one is several, written and read by as many tasks.
FILE_ROWS = 250_000


def arriving(spark: SparkSession, rows: DataFrame, batch: str, n: int) -> tuple[str, int]:
    """``rows`` as files in order of their ``batch`` number, 0 to n - 1, and how many files a micro-batch has.
    The rows are made once, not once for each batch."""
    staged = materialize(rows, "arrivals-all")
    least = min((r["count"] for r in staged.where(F.col(batch).between(0, n - 1)).groupBy(batch).count().collect()), default=0)
    for files in dict.fromkeys((max(1, min(spark.sparkContext.defaultParallelism, least // FILE_ROWS)), 1)):
        path = scratch_path(spark, "arrivals")
        for k in range(n):
            own = staged.where(F.col(batch) == k).drop(batch)
            with shuffles_dropped(spark):
                (own.coalesce(1) if files == 1 else own.repartition(files)).write.mode("append").parquet(path)
        # each batch must have as many files, as they are told apart by their order alone
        if files == 1 or len(spark.read.schema(rows.drop(batch).schema).parquet(path).inputFiles()) == n * files:
            break
    release(staged)
    return path, files


def _day(c: str = "ts"):
    return F.datediff(F.col(c).cast("date"), F.lit("2024-01-01").cast("date"))


#: An event arrives with its days; every seventh arrives again one batch later, every eleventh comes two
#: batches late (and, if it is a seventh too, both times).
_ARRIVALS = f"""
arrivals AS (
  SELECT event_id, ts, least(CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INTEGER) // {DAYS_A_BATCH}, 4)
         + CASE WHEN event_id % 11 = 0 THEN 2 ELSE 0 END AS batch FROM events
  UNION ALL
  SELECT event_id, ts, least(CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INTEGER) // {DAYS_A_BATCH}, 4)
         + CASE WHEN event_id % 11 = 0 THEN 2 ELSE 0 END + 1 FROM events WHERE event_id % 7 = 0)"""


def _arrivals(events: DataFrame) -> DataFrame:
    day = F.least(F.floor(_day() / DAYS_A_BATCH).cast("int"), F.lit(4))
    first = day + F.when(F.col("event_id") % 11 == 0, 2).otherwise(0)
    again = F.when(F.col("event_id") % 7 == 0, F.array(first, first + 1)).otherwise(F.array(first))
    return events.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "value", F.explode(again).alias("batch"))


@register("stream_dedupe_late", f"""
WITH {_ARRIVALS},
marks AS (SELECT b AS batch, (SELECT max(ts) FROM arrivals a WHERE a.batch < b - 1) - INTERVAL {DELAY} AS mark FROM range(0, 8) t(b)),
told AS (SELECT a.event_id, a.ts, a.batch, coalesce(a.ts > m.mark, true) AS in_time FROM arrivals a JOIN marks m ON m.batch = a.batch)
SELECT event_id, CASE WHEN bool_or(in_time) THEN 'reported' ELSE 'late' END AS outcome,
       CASE WHEN bool_or(in_time) THEN 1 ELSE count(*) END AS n
FROM told GROUP BY event_id""")
def q_stream_dedupe_late(spark, sf):
    """Each event's outcome: reported once, or its late arrivals in the dead-letter table.  A batch is
    judged by the watermark that the batch before it began with."""
    events = _arrivals(table(spark, sf, "events"))
    path, files = arriving(spark, events, "batch", 8)
    out, dead = scratch_path(spark, "reported"), scratch_path(spark, "dead-letter")
    stream = arrivals.file_stream(spark, path, events.drop("batch").schema, files)
    arrivals.start_deduplicated(stream, "event_id", "ts", DELAY, out, dead, scratch_path(spark, "dedupe"), available_now=True).awaitTermination()
    kept = spark.read.parquet(out).select("event_id", F.lit("reported").alias("outcome"))
    late = spark.read.parquet(dead).where("reason = 'late'").select("event_id", F.lit("late").alias("outcome"))
    return kept.unionByName(late).groupBy("event_id", "outcome").agg(F.count("*").alias("n"))


@register("stream_sessions", """
WITH known AS (SELECT * FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL),
starts AS (SELECT *, CASE WHEN ts >= lag(ts) OVER w + INTERVAL 6 HOUR OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS fresh
           FROM known WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session FROM starts),
whole AS (SELECT user_id, min(ts) AS s, max(ts) + INTERVAL 6 HOUR AS e, count(*) AS n_events,
                 CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value FROM numbered GROUP BY user_id, session)
SELECT user_id, CAST(epoch_us(s) AS BIGINT) AS start_us, CAST(epoch_us(e) AS BIGINT) AS end_us, n_events, value
FROM whole WHERE e <= (SELECT max(ts) FROM known) - INTERVAL 1 DAY""")
def q_stream_sessions(spark, sf):
    """Sessions of events with a gap of six hours, as far as the watermark has closed them (a day before the last event)."""
    events = table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "value",
                                               F.least(F.floor(_day() / DAYS_A_BATCH).cast("int"), F.lit(4)).alias("batch"))
    (path, files), out = arriving(spark, events, "batch", 5), scratch_path(spark, "sessions")
    stream = arrivals.file_stream(spark, path, events.drop("batch").schema, files)
    closed = arrivals.sessions(stream, ["user_id"], "ts", "6 hours", "1 day",
                               {"n_events": F.count("*"), "value": F.sum(F.col("value").cast("decimal(18,2)")).cast("double")})
    arrivals.start_table(closed, out, scratch_path(spark, "sessions-checkpoint"), available_now=True).awaitTermination()
    return spark.read.schema(closed.schema).parquet(out).select(
        "user_id", F.unix_micros("session_start").alias("start_us"), F.unix_micros("session_end").alias("end_us"), "n_events", "value")


#: A line is a page of its order; batch by (order, line), an hour apart; of some orders a page never comes.
_TIMEOUT_HOURS = 2.5


@register("stream_document_assembly", f"""
WITH pages AS (
  SELECT l_orderkey, l_linenumber, count(*) OVER (PARTITION BY l_orderkey) AS n_pages,
         (l_orderkey * 31 + l_linenumber * 7) % 6 AS batch, l_orderkey % 10 = 3 AND l_linenumber = 1 AS lost
  FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)),
here AS (SELECT *, min(batch) OVER (PARTITION BY l_orderkey) AS first FROM pages WHERE NOT lost),
-- an hour a batch, and the watermark a batch behind: the timer goes off in the fourth batch after the first page, behind its pages
docs AS (SELECT l_orderkey AS doc_id, max(n_pages) AS n_pages, count(*) AS n_here, first FROM here WHERE batch <= first + 4 GROUP BY l_orderkey, first)
SELECT doc_id, CAST(n_pages AS INTEGER) AS n_pages, CAST(n_here AS INTEGER) AS n_here,
       CASE WHEN n_here = n_pages THEN 'complete' ELSE 'timed_out' END AS status
FROM docs WHERE n_here = n_pages OR first + {_TIMEOUT_HOURS} < (SELECT max(batch) FROM here)""")
def q_stream_document_assembly(spark, sf):
    """Orders as documents whose lines arrive as pages over six micro-batches: complete, or timed out."""
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("l_partkey"))
    n = lines.groupBy("l_orderkey").agg(F.count("*").alias("n_pages"))
    batch = ((F.col("l_orderkey") * 31 + F.col("l_linenumber") * 7) % 6).cast("int")
    pages = (lines.join(by_key(n), "l_orderkey").where(~((F.col("l_orderkey") % 10 == 3) & (F.col("l_linenumber") == 1)))
             .select(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("page"), "n_pages",
                     F.concat(F.lit("part "), F.col("l_partkey").cast("string")).alias("text"),
                     F.timestamp_seconds(F.lit(1704067200) + batch * 3600).alias("at"), batch.alias("batch")))
    (path, files), out = arriving(spark, pages, "batch", 6), scratch_path(spark, "assembled")
    stream = arrivals.file_stream(spark, path, pages.drop("batch").schema, files)
    whole = arrivals.assembled(stream, "doc_id", "page", "n_pages", "text", "at", "0 seconds", int(_TIMEOUT_HOURS * 3_600_000))
    with arrivals.rocksdb(spark):
        arrivals.start_table(whole, out, scratch_path(spark, "assembly-checkpoint"), available_now=True).awaitTermination()
    return spark.read.schema(whole.schema).parquet(out).select("doc_id", "n_pages", "n_here", "status")
