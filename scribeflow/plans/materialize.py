"""Stage boundaries: write an intermediate table to the shared checkpoint
folder (``spark.checkpoint.dir``) as parquet and read it back.

Used where one intermediate feeds several consumers (dictionary hits, the
per-document state, entities): the work runs once, the lineage is cut, and a
lost executor costs a re-read instead of a re-tokenization.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from scribeflow.session import scratch_path

_MEMO: dict[tuple, DataFrame] = {}
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is written inside leaves no shuffle files behind: nothing reads a finished write's
    shuffles again, and else they lie on disk until the driver's memory is collected."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the checkpoint folder and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with shuffles_dropped(spark):
        df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def release(df: DataFrame) -> None:
    """Delete the stage table that ``df`` was read from."""
    spark = df.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs
    for part in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = hadoop.Path(part)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def memo(spark: SparkSession, key: tuple, build) -> DataFrame:
    """Reuse one materialized table per (application, key)."""
    k = (spark.sparkContext.applicationId,) + key
    if k not in _MEMO:
        _MEMO[k] = build()
    return _MEMO[k]
