"""File ingest: file listing -> document records, supported-type split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scribeflow import fixed_values as fv


def read_file_listing(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """List files as (path, length) with Spark's binaryFile source.

    Only ``path`` and ``length`` are selected, so the file content column is
    pruned and never read.
    """
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.option("recursiveFileLookup", "true").load(path).select("path", "length")


def file_name_of(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def file_type_of(name: Column) -> Column:
    """Lower-cased last suffix with its dot; '' when the only dot leads the
    name, or when the name ends in a dot (pathlib's rule)."""
    n = F.char_length(name)
    rpos = F.instr(F.reverse(name), ".")  # 1-based from the end, 0 = none
    i = n - rpos  # 0-based index of the last dot
    return F.when((rpos > 0) & (i > 0) & (i < n - 1), F.lower(F.substring(name, i + 1, 1 << 30))).otherwise(F.lit(""))


def ingest(files_df: DataFrame) -> DataFrame:
    """files(path, length) -> documents(doc_id, path, file_name, file_type,
    file_size_bytes, status).  doc_id is a stable hash of the path so it does
    not depend on partitioning."""
    name = file_name_of(F.col("path"))
    return files_df.select(
        F.xxhash64("path").alias("doc_id"),
        "path",
        name.alias("file_name"),
        file_type_of(name).alias("file_type"),
        F.col("length").cast("long").alias("file_size_bytes"),
        F.lit("processing").alias("status"),
    )


def split_supported(docs: DataFrame, supported: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected).  Rejected rows carry the FILE_ERROR record and get
    no report (dead-letter table)."""
    types = supported or fv.SUPPORTED_FILE_TYPES
    ok = F.col("file_type").isin(types)
    accepted = docs.where(ok)
    rejected = docs.where(~ok).select(
        "*",
        F.lit(fv.ERROR_CODES["file"]).alias("error_code"),
        F.concat(F.lit("Unsupported file type: "), F.col("file_type")).alias("message"),
    )
    return accepted, rejected
