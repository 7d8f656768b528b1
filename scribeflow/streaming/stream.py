"""Structured Streaming front end.

Documents are independent, so a stream needs no cross-batch state: each
micro-batch of newly arrived documents (file source, parquet) runs the
batch pipeline through ``foreachBatch`` and its reports are written to
``<output>/batch_id=<n>`` with overwrite.  A retried batch rewrites the same
folder, so together with the checkpointed source offsets every document is
reported exactly once.
"""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from scribeflow.plans import pipeline as PL
from scribeflow.session import ensure_checkpoint_dir

DOCUMENT_SCHEMA = "doc_id long, file_name string, file_type string, file_size_bytes long, full_text string"


def document_stream(spark: SparkSession, path: str, schema: str = DOCUMENT_SCHEMA,
                    max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format("parquet").schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def start_report_stream(stream: DataFrame, dicts: PL.Dictionaries, output: str,
                        checkpoint: str | None = None, active_stages: list[str] | None = None,
                        available_now: bool = False, processing_time: str | None = None) -> StreamingQuery:
    """Start the stream; returns the running query."""
    spark = stream.sparkSession
    # by its output, so that two streams never share a log of offsets
    ckpt = checkpoint or os.path.join(ensure_checkpoint_dir(spark), "report-stream-" + hashlib.sha256(output.encode()).hexdigest()[:16])
    stages = active_stages or PL.TEXT_STAGES
    dicts = dicts.localize()  # once for all batches

    def run_batch(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        res = PL.run(batch, dicts, active_stages=stages)
        res.reports.write.mode("overwrite").parquet(os.path.join(output, f"batch_id={batch_id}"))
        res.release()

    w = stream.writeStream.foreachBatch(run_batch).option("checkpointLocation", ckpt)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()
