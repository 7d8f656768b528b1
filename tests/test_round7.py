"""Disk and time at size: what is shuffled, what is left behind."""

import re
import time
from pathlib import Path

from pyspark.sql import functions as F

from scribeflow.operators.tokens import tokenize


def test_tokens_are_not_shuffled(spark):
    texts = {1: "Glucose: 5.4 mg/dL.\nNext  line", 2: "", 3: "a b " * 6000, 4: "é 😀 x-y"}
    rows = [*texts.items(), (None, "no id"), (5, None)]
    t = tokenize(spark.createDataFrame(rows, "doc_id long, text string"))
    plan = t._jdf.queryExecution().executedPlan().toString()
    # the texts are dealt once, before they are cut
    assert len(re.findall(r"Exchange hash", plan)) == 1 and plan.index("Generate") < plan.index("Exchange hash") and "Join" not in plan
    got = t.collect()
    assert {r["doc_id"] for r in got} == {1, 3, 4}
    for r in got:
        assert texts[r["doc_id"]][r["start_char"]:r["end_char"]] == r["tok"]
    for k in texts:
        assert sorted(r["tok_idx"] for r in got if r["doc_id"] == k) == list(range(sum(r["doc_id"] == k for r in got)))
    assert sum(r["doc_id"] == 3 for r in got) == 12000


def _shuffle_files(spark) -> int:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(k).getName().startswith("shuffle_") for k in range(files.size()))


def test_stage_tables_and_bundle_leave_no_shuffle_files(spark, tmp_path):
    from scribeflow.plans.materialize import materialize
    from scribeflow.sinks import writers as W

    before = _shuffle_files(spark)
    rows = spark.range(5000).withColumn("k", F.xxhash64("id")).repartition(5, "k")
    counted = materialize(rows.groupBy("k").count(), "counted")
    text = rows.select(F.col("id").alias("doc_id"), F.concat(F.lit("n"), "id").alias("file_name"), F.lit("a long text " * 20).alias("summary_text"))
    W.write_summaries(text, str(tmp_path / "summary"), "gzip")
    W.write_json(text, str(tmp_path / "json"), "gzip")
    deadline = time.time() + 30
    while _shuffle_files(spark) > before and time.time() < deadline:
        time.sleep(0.2)  # they are deleted in the background
    assert _shuffle_files(spark) <= before and counted.count() == 5000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    # 5,000 times 240 characters
    for part in ("summary", "json"):
        assert sum(f.stat().st_size for f in (tmp_path / part).iterdir()) < 200_000
        assert spark.read.json(str(tmp_path / part)).select("doc_id", "summary_text").distinct().count() == 5000


def test_hits_are_dropped_once_entities_are_written(spark):
    from scribeflow.plans import pipeline as PL

    docs = spark.createDataFrame([(1, "a.pdf", ".pdf", 5, "Hemoglobin: 9.1 g/dL. Diabetes.")], "doc_id long, file_name string, file_type string, file_size_bytes long, full_text string")
    res = PL.run(docs, PL.Dictionaries.defaults(spark), active_stages=PL.TEXT_STAGES)
    assert res.reports.count() == 1 and res.entities.count() > 0
    assert not [f for df in res.stage_tables for f in df.inputFiles() if "/hits-" in f]


def _orders(spark, d, orders=60):
    spark.range(orders).selectExpr("id AS o_orderkey").write.parquet(f"{d}/orders.parquet")
    spark.range(4 * orders).selectExpr(
        f"id % {orders} AS l_orderkey", "id AS l_partkey", "id * 3 AS l_suppkey", f"CAST(id DIV {orders} AS int) AS l_linenumber",
        "CAST(id % 50 AS double) AS l_quantity", "CAST(id AS double) AS l_extendedprice").write.parquet(f"{d}/lineitem.parquet")


def test_value_search_copies_no_step_into_a_filter(spark, tmp_path):
    from scribeflow.operators import extract as X
    from scribeflow.plans import queries as Q

    _orders(spark, str(tmp_path))
    got = Q.q_value_unit_extract(spark, str(tmp_path))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert not [x for x in plan.splitlines() if "Filter" in x and "substring" in x]
    # the same rows as by the text after a hit
    hits = X.gazetteer_hits(Q.cdocs(spark, str(tmp_path)), Q.lexicon(spark)).collect()
    assert sorted((r["doc_id"], r["tok_pos"], r["name"]) for r in got.collect()) == sorted(
        (h["doc_id"], h["tok_pos"], h["span_text"]) for h in hits if h["after"] is not None)


def test_ocr_words_are_made_where_their_document_lies(spark, tmp_path, monkeypatch):
    from scribeflow.plans import queries as Q

    _orders(spark, str(tmp_path))
    given, made = [], Q.fx.ocr_words_from
    monkeypatch.setattr(Q.fx, "ocr_words_from", lambda d: given.append(d) or made(d))
    assert Q.q_pipeline_ocr(spark, str(tmp_path)).count() == 60
    assert "hashpartitioning(doc_id" in given[0]._jdf.queryExecution().executedPlan().toString()


def test_arrivals_are_made_once_and_in_files_of_bounded_size(spark, monkeypatch):
    from scribeflow.plans import arrival_queries as A

    made = []
    keep = A.materialize
    monkeypatch.setattr(A, "materialize", lambda df, name: made.append(name) or keep(df, name))
    monkeypatch.setattr(A, "FILE_ROWS", 100)
    rows = spark.range(1200).select("id", (F.col("id") % 3).cast("int").alias("batch"))
    path, files = A.arriving(spark, rows, "batch", 3)
    assert made == ["arrivals-all"] and files == min(4, spark.sparkContext.defaultParallelism) > 1
    found = sorted(Path(path).glob("*.parquet"), key=lambda f: (f.stat().st_mtime, f.name))
    assert len(found) == 3 * files
    for k in range(3):  # in order of time a batch's files come together
        own = spark.read.parquet(*map(str, found[k * files:(k + 1) * files]))
        assert {r["id"] % 3 for r in own.collect()} == {k} and own.count() == 400
    # a batch too small for so many files, or empty, is one file each
    path, files = A.arriving(spark, rows.where("batch <> 1 OR id < 9"), "batch", 4)
    assert files == 1 and len(list(Path(path).glob("*.parquet"))) == 4
