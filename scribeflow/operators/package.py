"""Packaging: stage outputs -> one nested report row per document.

Entities are grouped per (doc, type) and then per doc into a map keyed
``type + "s"`` in first-seen order; the ``value`` keeps the text/number
duality as ``value`` (Python ``str`` form) plus ``value_num``.  Stages that
did not run leave their defaults (``unknown``/0.0, zero counts, empty
summary).  Per-document wall-clock timings do not exist under lazy
execution, so ``processing_time_ms`` is null and ``stage_timings`` empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scribeflow.functions.text import py_float_str
from scribeflow.sources.reference import by_key

ITEM = "struct<name:string,value:string,value_num:double,unit:string,confidence:double,source:string>"


def entities_by_type(ents: DataFrame) -> DataFrame:
    """(doc_id, extracted_entities map<type+'s', array<item>>)."""
    e = ents.repartition("doc_id")
    value = F.when(F.col("value_num").isNotNull(), py_float_str(F.col("value_num"))).otherwise(F.col("value_text"))
    item = F.struct(
        "seq", "name", value.alias("value"), "value_num", "unit", "confidence",
        F.coalesce("source", F.lit("unknown")).alias("source"),
    )
    per_type = e.groupBy("doc_id", "type").agg(F.min("seq").alias("first"), F.array_sort(F.collect_list(item)).alias("items"))
    per_type = per_type.select(
        "doc_id", "first", F.concat(F.col("type"), F.lit("s")).alias("key"),
        F.transform("items", lambda x: x.dropFields("seq")).cast(f"array<{ITEM}>").alias("items"),
    )
    return per_type.groupBy("doc_id").agg(
        F.map_from_entries(F.transform(F.array_sort(F.collect_list(F.struct("first", "key", "items"))),
                                       lambda x: F.struct(x["key"], x["items"]))).alias("extracted_entities")
    )


def build_reports(docs: DataFrame, cls: DataFrame | None, ents: DataFrame | None,
                  rep: DataFrame | None, summ: DataFrame | None) -> DataFrame:
    """Report rows: doc_id, file_name, document_type, classification_confidence,
    extracted_entities, validation_summary, summary, processing_status,
    processing_time_ms, stage_timings, errors, warnings."""
    inline_cls = cls is None and "document_type" in docs.columns
    r = docs.select("doc_id", "file_name", F.col("status").alias("processing_status"), "errors", "warnings",
                    *(["document_type", "confidence"] if inline_cls else []))
    empty_map = F.create_map().cast(f"map<string,array<{ITEM}>>")
    if not inline_cls and cls is not None:
        r = r.join(by_key(cls.select("doc_id", "document_type", "confidence")), "doc_id", "left")
    elif not inline_cls:
        r = r.withColumn("document_type", F.lit(None).cast("string")).withColumn("confidence", F.lit(None).cast("double"))
    if ents is not None:
        r = r.join(by_key(entities_by_type(ents)), "doc_id", "left")
    else:
        r = r.withColumn("extracted_entities", empty_map)
    counts = ("total_validated", "valid_count", "invalid_count", "abnormal_count", "critical_count")
    if rep is not None:
        r = r.join(by_key(rep.select("doc_id", *counts)), "doc_id", "left")
    else:
        for c in counts:
            r = r.withColumn(c, F.lit(None).cast("long"))
    if summ is not None:
        r = r.join(by_key(summ.select("doc_id", "document_summary", "key_findings", "diagnoses", "layman_explanation")),
                   "doc_id", "left")
    else:
        r = r.withColumn("document_summary", F.lit(None).cast("string")) \
            .withColumn("key_findings", F.lit(None).cast("array<string>")) \
            .withColumn("diagnoses", F.lit(None).cast("array<string>")) \
            .withColumn("layman_explanation", F.lit(None).cast("string"))
    no_list = F.array().cast("array<string>")
    return r.select(
        "doc_id",
        "file_name",
        F.coalesce("document_type", F.lit("unknown")).alias("document_type"),
        F.coalesce("confidence", F.lit(0.0)).alias("classification_confidence"),
        F.coalesce("extracted_entities", empty_map).alias("extracted_entities"),
        F.struct(*[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts]).alias("validation_summary"),
        F.struct(
            F.coalesce("document_summary", F.lit("")).alias("document_summary"),
            F.coalesce("key_findings", no_list).alias("key_findings"),
            F.coalesce("diagnoses", no_list).alias("diagnoses"),
            F.coalesce("layman_explanation", F.lit("")).alias("layman_explanation"),
        ).alias("summary"),
        "processing_status",
        F.lit(None).cast("double").alias("processing_time_ms"),
        F.create_map().cast("map<string,double>").alias("stage_timings"),
        "errors",
        "warnings",
    )


def report_json(reports: DataFrame) -> DataFrame:
    """(doc_id, file_name, json) - the report serialised as one JSON text."""
    body = reports.drop("doc_id")
    return reports.select("doc_id", "file_name", F.to_json(F.struct(*[F.col(c) for c in body.columns])).alias("json"))
