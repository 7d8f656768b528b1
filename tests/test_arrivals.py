"""Stateful streams: arrivals in files, one micro-batch each."""

import os
from collections import Counter
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from scribeflow.session import scratch_path
from scribeflow.streaming import arrivals

T0 = datetime(2024, 3, 1, tzinfo=timezone.utc)


def _files(spark, batches, schema):
    path = scratch_path(spark, "test-arrivals")
    for rows in batches:
        spark.createDataFrame([(*r[:-1], T0 + timedelta(hours=r[-1]) if r[-1] is not None else None) for r in rows], schema).coalesce(1) \
            .write.mode("append").parquet(path)
    return path


def test_reported_once_and_late_ones_are_kept(spark):
    schema = "id long, what string, at timestamp"
    batches = [
        [(1, "a", 0), (2, "b", 1), (2, "b", 1), (None, "no id", 1), (3, "no time", None)],
        [(1, "a", 0), (4, "c", 10)],          # 1 again, in time
        [(5, "d", 30)],
        [(6, "just", 2), (7, "e", 29)],       # judged by the mark that the batch before began with
        [(8, "late", 3), (8, "late", 3), (1, "a", 0), (5, "d", 30), (9, "f", 31)],   # 1 is a late duplicate
    ]
    path = _files(spark, batches, schema)
    out, dead, ckpt = (scratch_path(spark, x) for x in ("test-out", "test-dead", "test-ckpt"))

    def run():
        stream = arrivals.file_stream(spark, path, schema, 1)
        arrivals.start_deduplicated(stream, "id", "at", "12 hours", out, dead, ckpt, lambda df: df.withColumn("seen", F.lit(1)), available_now=True).awaitTermination()

    run()
    assert Counter(r["id"] for r in spark.read.parquet(out).collect()) == Counter([1, 2, 4, 5, 6, 7, 9])
    letters = Counter((r["id"], r["reason"]) for r in spark.read.parquet(dead).collect())
    assert letters == Counter([(None, "no key"), (3, "no time"), (8, "late"), (8, "late")])
    # a restart from the same checkpoint reports only what is new
    spark.createDataFrame([(9, "f", T0 + timedelta(hours=31)), (10, "g", T0 + timedelta(hours=32))], schema).coalesce(1).write.mode("append").parquet(path)
    run()
    assert Counter(r["id"] for r in spark.read.parquet(out).collect()) == Counter([1, 2, 4, 5, 6, 7, 9, 10])


def test_sessions_close_with_the_watermark(spark):
    schema = "who string, n int, at timestamp"
    batches = [[("a", 1, 0), ("a", 2, 0.5), ("b", 1, 0), (None, 9, 0), ("a", 9, None)], [("a", 4, 1.2), ("a", 8, 5), ("b", 2, 5.5)], [("c", 1, 50)]]
    path, out = _files(spark, batches, schema), scratch_path(spark, "test-sessions")
    closed = arrivals.sessions(arrivals.file_stream(spark, path, schema, 1), ["who"], "at", "1 hour", "2 hours", {"n": F.sum("n"), "rows": F.count("*")})
    arrivals.start_table(closed, out, scratch_path(spark, "test-ckpt"), available_now=True).awaitTermination()
    got = {(r["who"], r["s"], r["e"], r["n"], r["rows"]) for r in spark.read.parquet(out).select(
        "who", ((F.unix_seconds("session_start") - int(T0.timestamp())) / 3600).alias("s"),
        ((F.unix_seconds("session_end") - int(T0.timestamp())) / 3600).alias("e"), "n", "rows").collect()}
    assert {(w, round(s, 3), round(e, 3), n, k) for w, s, e, n, k in got} == {("a", 0, 2.2, 7, 3), ("b", 0, 1, 1, 1), ("a", 5, 6, 8, 1), ("b", 5.5, 6.5, 2, 1)}


def test_documents_come_together(spark):
    schema = "doc long, page int, pages int, text string, at timestamp"
    batches = [
        [(1, 2, 2, "two", 0), (2, 1, 3, "p1", 0), (3, 1, 1, "whole", 0), (None, 1, 1, "x", 0), (9, None, 1, "x", 0)],
        [(1, 1, 2, "one", 1), (1, 1, 2, "one again", 1), (2, 3, 3, None, 1)],
        [(1, 2, 2, "two", 2), (3, 1, 1, "whole", 2), (4, 1, 2, "waits", 9)],
        [(5, 1, 2, "x", 10)],
    ]
    path, out = _files(spark, batches, schema), scratch_path(spark, "test-assembled")
    whole = arrivals.assembled(arrivals.file_stream(spark, path, schema, 1), "doc", "page", "pages", "text", "at", "0 seconds", 4 * 3_600_000)
    with arrivals.rocksdb(spark):
        arrivals.start_table(whole, out, scratch_path(spark, "test-ckpt"), available_now=True).awaitTermination()
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") != arrivals.ROCKSDB
    got = {tuple(r) for r in spark.read.parquet(out).collect()}
    assert got == {(1, 2, 2, "complete", "one\ntwo"), (3, 1, 1, "complete", "whole"), (2, 3, 2, "timed_out", "p1\n")}


def test_empty_stream(spark):
    path, out = scratch_path(spark, "test-none"), scratch_path(spark, "test-none-out")
    schema = "who string, n int, at timestamp"
    spark.createDataFrame([], schema).write.parquet(path)
    closed = arrivals.sessions(arrivals.file_stream(spark, path, schema), ["who"], "at", "1 hour", "1 hour", {"n": F.count("*")})
    arrivals.start_table(closed, out, scratch_path(spark, "test-ckpt"), available_now=True).awaitTermination()
    assert not os.path.exists(out) or spark.read.schema(closed.schema).parquet(out).count() == 0
