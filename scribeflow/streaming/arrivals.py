"""Stateful streams: one report for a document that arrives twice, sessions, documents whose pages
arrive apart.

State is bounded by a watermark: what the stream has to remember is what arrived within the delay
(or the timeout), not all that ever arrived.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from scribeflow.operators.timeline import free_name

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def file_stream(spark: SparkSession, path: str, schema, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.format("parquet").schema(schema)
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).load(path)


def _started(writer, checkpoint: str, available_now: bool, processing_time: str | None) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def start_deduplicated(stream: DataFrame, key: str, time: str, delay: str, output: str, dead_letter: str, checkpoint: str,
                       transform: Callable[[DataFrame], DataFrame] | None = None, available_now: bool = False,
                       processing_time: str | None = None) -> StreamingQuery:
    """Report each key once, ``delay`` being how far apart its arrivals may be.

    The first arrival goes (through ``transform``) to ``output``, later ones are dropped by the state
    store, which forgets a key once the watermark has passed its time by the delay.  Rows that come
    later than the delay, and would be lost silently, go to ``dead_letter`` with a ``reason``:
    ``late``, ``no key`` or ``no time``.  (Spark judges a batch by the watermark that the batch before
    it began with, so a row may be a batch later than the delay.)  A late row of a key that was
    reported is a duplicate, not a dead letter.  Both folders have a part for each micro-batch, written with overwrite, so a
    retried batch replaces its rows.
    """
    spark, kind = stream.sparkSession, free_name("arrival", stream)
    columns = stream.columns
    known = F.col(key).isNotNull() & F.col(time).isNotNull()
    timed = stream.withWatermark(time, delay)
    kept = timed.where(known).dropDuplicatesWithinWatermark([key]).withColumn(kind, F.lit("kept"))
    both = kept.unionByName(timed.withColumn(kind, F.lit("any")))
    clock = os.path.join(checkpoint, "clock")

    def latest(batch_id: int):
        """The latest time of the batches before; a retried batch does not see its own."""
        if batch_id == 0 or not _exists(spark, clock):
            return None
        seen = spark.read.schema("latest timestamp, batch_id long").parquet(clock)
        return seen.where(F.col("batch_id") < batch_id).agg(F.max("latest")).first()[0]

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            first = batch.where(F.col(kind) == "kept").select(*columns)
            (transform(first) if transform else first).write.mode("overwrite").parquet(f"{output}/batch_id={batch_id}")
            # keys and times of what was reported, for late rows to be told from duplicates
            first.select(F.col(key).alias("key"), F.col(time).alias("time")).write.mode("overwrite").parquet(f"{checkpoint}/reported/batch_id={batch_id}")
            rows = batch.where(F.col(kind) == "any").select(*columns)
            reason = F.when(F.col(key).isNull(), "no key").when(F.col(time).isNull(), "no time")
            dead = rows.where(~known).select(*columns, reason.alias("reason"))
            before = latest(batch_id)
            if before is not None:
                mark = F.lit(before) - F.expr(f"INTERVAL {delay}")
                old = rows.where(known & (F.col(time) <= mark))
                span = old.agg(F.min(time).alias("a"), F.max(time).alias("b")).first()
                if span["a"] is not None:
                    reported = spark.read.schema("key " + stream.schema[key].dataType.simpleString() + ", time timestamp").parquet(f"{checkpoint}/reported")
                    # a duplicate lies within the delay of the arrival that was reported
                    near = reported.where(F.col("time").between(F.lit(span["a"]) - F.expr(f"INTERVAL {delay}"), F.lit(span["b"]) + F.expr(f"INTERVAL {delay}")))
                    late = old.join(near, old[key] == near["key"], "left_anti")
                    dead = dead.unionByName(late.select(*columns, F.lit("late").alias("reason")))
            dead.write.mode("overwrite").parquet(f"{dead_letter}/batch_id={batch_id}")
            rows.agg(F.max(time).cast("timestamp").alias("latest")).where("latest is not null").write.mode("overwrite").parquet(f"{clock}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    return _started(both.writeStream.foreachBatch(run), checkpoint, available_now, processing_time)


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def sessions(stream: DataFrame, keys: list[str], time: str, gap: str, delay: str, aggregates: dict[str, Column]) -> DataFrame:
    """Sessions of each key: rows no further apart than ``gap``, with ``session_start``,
    ``session_end`` (the last row's time and the gap) and the aggregates.  Appended once the
    watermark has passed a session's end.  Rows without a key or time belong to none."""
    known = F.col(time).isNotNull()
    for k in keys:
        known = known & F.col(k).isNotNull()
    grouped = stream.where(known).withWatermark(time, delay).groupBy(F.session_window(time, gap).alias("session"), *keys)
    return grouped.agg(*(c.alias(n) for n, c in aggregates.items())).select(
        *keys, F.col("session.start").alias("session_start"), F.col("session.end").alias("session_end"), *aggregates)


def start_table(stream: DataFrame, output: str, checkpoint: str, available_now: bool = False, processing_time: str | None = None) -> StreamingQuery:
    """Append the stream's rows to a folder of Parquet files, each row once."""
    return _started(stream.writeStream.format("parquet").option("path", output).outputMode("append"), checkpoint, available_now, processing_time)


def _assembler(timeout_ms: int):
    """The documents of one bucket: their pages in its state, each with a due time from its first page
    on.  A call for each document would cost far more than its few pages."""

    def step(key, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        ids, counts, due, reported, numbers, texts = state.get if state.exists else ([], [], [], [], [], [])
        about = {d: [n, t, r, {}] for d, n, t, r in zip(ids, counts, due, reported)}
        for d, p, t in zip(ids, numbers, texts):
            about[d][3] = dict(zip(p, t))
        out: list[tuple] = []

        def tell(d, status: str) -> None:
            n_pages, _, _, held = about[d]
            out.append((d, n_pages, len(held), status, "\n".join(held[p] for p in sorted(held))))

        fresh: dict = {}
        for frame in () if state.hasTimedOut else rows:
            for d, p, n, t, at in zip(*(frame[c].tolist() for c in ("doc_id", "page", "n_pages", "text", "at_ms"))):
                new = fresh.setdefault(d, [0, at + timeout_ms, {}])
                new[0], new[1] = max(new[0], n), min(new[1], at + timeout_ms)
                # of a page that comes twice the smaller text counts within a batch, the earlier between batches
                new[2][p] = min(t, new[2].get(p, t))
        for d, (n, t, pages) in fresh.items():
            own = about.setdefault(d, [0, t, False, {}])
            if own[2]:  # reported before; its state waits for the timer so that repeats stay silent
                continue
            own[0], own[3] = max(own[0], n), pages | own[3]
            if len(own[3]) >= own[0]:
                tell(d, "complete")
                own[2], own[3] = True, {}
        mark = state.getCurrentWatermarkMs()
        for d in [d for d, own in about.items() if own[1] <= mark]:
            if not about[d][2]:
                tell(d, "timed_out")
            del about[d]
        if about:
            held = [own[3] for own in about.values()]
            state.update((list(about), *([own[k] for own in about.values()] for k in range(3)), [list(h) for h in held], [list(h.values()) for h in held]))
            state.setTimeoutTimestamp(min(own[1] for own in about.values()))
        elif state.exists:
            state.remove()
        if out:
            yield pd.DataFrame(out, columns=["doc_id", "n_pages", "n_here", "status", "text"])

    return step


#: Documents of a stream share state by so many buckets.
BUCKETS = 4096


def assembled(pages: DataFrame, doc: str, page: str, n_pages: str, text: str, time: str, delay: str, timeout_ms: int) -> DataFrame:
    """Documents whose pages arrive in any order and batch: (doc_id, n_pages, n_here, status, text),
    out as soon as all pages are there (``complete``) or once the watermark has passed the first
    page's time by the timeout (``timed_out``, with the pages that came).  Pages without document,
    number or time are left out."""
    known = F.col(doc).isNotNull() & F.col(page).isNotNull() & F.col(n_pages).isNotNull() & F.col(time).isNotNull()
    rows = (pages.where(known).select(F.col(doc).alias("doc_id"), F.col(page).cast("int").alias("page"), F.col(n_pages).cast("int").alias("n_pages"),
                                      F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"), F.col(time).cast("timestamp").alias("at"))
            .withColumn("at_ms", F.unix_millis("at")).withWatermark("at", delay))
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_pages int, n_here int, status string, text string"
    own = rows.schema["doc_id"].dataType.simpleString()
    kept = f"ids array<{own}>, counts array<int>, due array<long>, reported array<boolean>, numbers array<array<int>>, texts array<array<string>>"
    dealt = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(BUCKETS)))
    return dealt.groupBy("bucket").applyInPandasWithState(_assembler(timeout_ms), schema, kept, "append", GroupStateTimeout.EventTimeTimeout)


@contextmanager
def rocksdb(spark: SparkSession):
    """Queries started inside keep their state in RocksDB."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)
