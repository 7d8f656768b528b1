"""Snapshots, JSON paths, report files, dictionary sizes."""

import os
import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from scribeflow.operators import report_store
from scribeflow.operators import summarize as S
from scribeflow.session import scratch_path
from scribeflow.sinks import report_files
from scribeflow.sources.local import local_df
from scribeflow.sources.reference import bcast, measured

SCHEMA = "doc_id long, what string, value double"


def _snapshots(spark, old, new):
    run = uuid.uuid4().hex
    return [report_store.snapshot(spark.createDataFrame(rows, SCHEMA).withColumn("row", F.lit("x")), f"t_{k}_{run}", 4)
            for k, rows in (("old", old), ("new", new))]


def test_changes_by_multiplicity(spark):
    old = [(1, "a", 1.0)] * 3 + [(2, None, None), (None, "b", 2.0), (3, "same", 5.0), (4, "nan", float("nan"))]
    new = [(1, "a", 1.0)] + [(2, None, None)] * 2 + [(3, "same", 5.0), (5, "new", None), (4, "nan", float("nan")), (None, None, None)]
    got = report_store.changes(*_snapshots(spark, old, new))
    assert got.columns == ["kind", "n", "n_old", "n_new", "doc_id", "what", "value", "row"]
    assert Counter(tuple(r)[:7] for r in got.collect()) == Counter([
        ("removed", 2, 3, 1, 1, "a", 1.0), ("added", 1, 1, 2, 2, None, None), ("removed", 1, 1, 0, None, "b", 2.0),
        ("added", 1, 0, 1, 5, "new", None), ("added", 1, 0, 1, None, None, None)])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "FullOuter" in plan and "Exchange" not in plan


def test_changes_from_and_to_nothing(spark):
    rows = [(1, "a", 1.0), (2, "b", None)]
    assert Counter(r["kind"] for r in report_store.changes(*_snapshots(spark, [], rows)).collect()) == {"added": 2}
    assert Counter(r["kind"] for r in report_store.changes(*_snapshots(spark, rows, [])).collect()) == {"removed": 2}
    assert report_store.changes(*_snapshots(spark, [], [])).count() == 0


def test_paths(spark):
    texts = ['{"a": {"b": [1, "two", null, {"c": 3}]}, "n": 7, "pos": 1}', '{"a": 5}', "not json", None, "[1]", '{"a": {"b": {"x": 1, "y": "z"}}}']
    df = report_store.parsed(spark.createDataFrame(list(enumerate(texts)), "id long, json string").withColumn("at", F.lit("x")))
    got = {r["id"]: (r["n"], r["c"], r["text"]) for r in report_store.by_path(df, {"n": ("$.n", "bigint"), "c": ("$.a.b[3].c", "int"), "text": ("$.a", "string")}).collect()}
    assert got[0][:2] == (7, 3) and got[1][0] is None and got[2] == got[3] == (None, None, None)
    each = report_store.exploded(df, "$.a.b").select("id", "pos", "key", F.col("value").cast("string").alias("v"))
    assert sorted(map(tuple, each.collect()), key=str) == sorted([
        (0, 0, None, "1"), (0, 1, None, "two"), (0, 2, None, None), (0, 3, None, '{"c":3}'), (5, 0, "x", "1"), (5, 1, "y", "z")], key=str)
    assert report_store.exploded(df.where("false"), "$.a.b").count() == 0


ROWS = [(1, "a.txt", '{"x": "é"}'), (2, "a.txt", "2"), (2, "a.txt", "3"), (3, "b/../c\n", "4"), (4, None, "5"), (None, None, None), (5, "z.pdf", "")]


def test_one_file_for_each_report(spark):
    folder = scratch_path(spark, "report-files")
    df = spark.createDataFrame(ROWS, "doc_id long, file_name string, json string").repartition(3)
    report_files.write_report_files(df, folder)
    got = {}
    for name in os.listdir(folder):
        if not name.startswith(("_", ".")):
            with open(f"{folder}/{name}", encoding="utf-8") as f:
                got[name] = f.read()
    assert got == {"a.txt.1.result.json": '{"x": "é"}', "a.txt.2.result.json": "2", "a.txt.2.2.result.json": "3", "b_.._c_.result.json": "4",
                   "report-4.result.json": "5", "report-none.result.json": "null", "z.pdf.result.json": ""}
    assert sorted(x for x in os.listdir(folder) if x.startswith("_")) == ["_SUCCESS"]
    report_files.write_report_files(df.where("doc_id = 5"), folder, "overwrite")
    assert sorted(os.listdir(folder)) == ["_SUCCESS", "z.pdf.result.json"]


def test_a_failed_job_takes_its_files_back(spark):
    folder = scratch_path(spark, "report-files")
    good = spark.createDataFrame(ROWS, "doc_id long, file_name string, json string")
    report_files.write_report_files(good.where("doc_id = 5"), folder)
    bad = good.repartition(1).sortWithinPartitions("doc_id").withColumn(
        "json", F.when(F.col("doc_id") == 4, F.raise_error(F.lit("stop"))).otherwise(F.col("json")))
    with pytest.raises(Exception, match="stop"):
        report_files.write_report_files(bad.select("doc_id", F.concat(F.lit("new-"), "file_name").alias("file_name"), "json"), folder)
    assert [x for x in os.listdir(folder) if not x.startswith("_")] == ["z.pdf.result.json"]


def test_large_dictionaries_are_not_broadcast(spark):
    small = local_df(spark, [("a", 1)], "term string, n int")
    large = spark.range(1_000_000).select(F.concat(F.lit("term"), F.col("id").cast("string")).alias("term"), F.lit(1).alias("n"))
    literal = local_df(spark, [("t" * 20, k) for k in range(1000)], "term string, n int")
    assert measured(small)[0] == 1 and measured(literal)[0] == 1000 and measured(literal)[1] > 20_000
    docs = spark.range(10).select(F.concat(F.lit("term"), F.col("id").cast("string")).alias("term"))
    plan = lambda d: docs.join(d, "term")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan(bcast(small)) and "BroadcastHashJoin" not in plan(bcast(large))
    assert "BroadcastHashJoin" not in plan(bcast(literal, limit_bytes=10_000))


def test_layman_terms_are_joined(spark):
    terms = spark.createDataFrame([("medical_to_layman", "high_sugar", "m", "sweet", "too much"), ("medical_to_layman", "COPD", "m", "x", "y"),
                                   ("test_results", "normal", "m", "n", "fine")], "section string, key string, medical string, layman string, explanation string")
    rows = spark.createDataFrame([(1, "High Sugar (diabetes)"), (2, "COPD"), (3, None), (3, "High Sugar")], "doc_id long, dx string")
    got = Counter((r["doc_id"], r["said"]) for r in S.explained(rows, "dx", terms, "said").collect())
    assert got == Counter([(1, "sweet: too much"), (2, "COPD"), (3, None), (3, "sweet: too much")])


def test_medication_frequency_from_metadata(spark):
    schema = "doc_id long, seq int, type string, name string, value_text string, value_num double, unit string, confidence double, frequency string"
    rows = [(1, 0, "medication", "A", None, 5.0, "mg", 0.9, "twice daily"), (1, 1, "medication", "B", None, None, None, 0.9, None), (1, 2, "medication", "C", None, None, None, 0.9, "")]
    got = S.entity_rollup(spark.createDataFrame(rows, schema)).first()["medications"]
    assert [m["frequency"] for m in got] == ["twice daily", "As prescribed", "As prescribed"]


