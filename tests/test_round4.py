"""Plans that must not grow through the driver, or do a document's work more than once."""

import os

import pytest
from pyspark.sql import functions as F

from scribeflow.operators import extract as X
from scribeflow.operators import package, summarize, validate
from scribeflow.operators.tokens import match_dictionary
from scribeflow.session import scratch_path
from scribeflow.sinks import report_files
from scribeflow.sources.local import local_df


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def _physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_documents_are_joined_by_shuffle(spark):
    """Sides with a row for each document are not broadcast, however small they look."""
    docs = local_df(spark, [(1, "a.pdf", ".pdf", "success", [], [])],
                    "doc_id long, file_name string, file_type string, status string, errors array<string>, warnings array<string>")
    finds = local_df(spark, [(1, 0, "glucose", None, 50.0, None, "critical", "high", None)],
                     "doc_id long, seq int, test_name string, value_text string, value_num double, unit string, status string, reason string, "
                     "reference_range string")
    rep = validate.validation_report(docs, finds)
    assert "Broadcast" not in _physical(rep)
    assert "Broadcast" not in _physical(package.build_reports(docs, None, None, rep, None))
    assert rep.count() == 1


def test_report_files_are_read_by_name(spark):
    rows = local_df(spark, [(1, "a.pdf", '{"x":1}'), (2, "a.pdf", '{"x":2}'), (3, "ü/b.pdf", None)], "doc_id long, file_name string, json string")
    folder = report_files.write_report_files(rows, scratch_path(spark, "test-files"))
    names = report_files.named(rows)
    got = {tuple(r) for r in report_files.read_report_files(names, folder).collect()}
    assert got == {("a.pdf.1.result.json", '{"x":1}'), ("a.pdf.2.result.json", '{"x":2}'), ("ü_b.pdf.result.json", "null")}
    os.remove(folder.removeprefix("file://") + "/a.pdf.1.result.json")
    with pytest.raises(Exception, match="a.pdf.1"):
        report_files.read_report_files(names, folder).collect()


def test_texts_are_cut_and_searched_once(spark):
    docs = local_df(spark, [(1, "Chest pain, shortness of  breath; glucose is 5 mg")], "doc_id long, text string")
    lex = local_df(spark, [("symptom", ["chest", "pain"], 2), ("test_result", ["glucose"], 1)], "label string, toks array<string>, n int")
    hits = X.gazetteer_hits(docs.where("text <> ''").repartition(2), lex)
    assert _plan(hits).count("regexp_extract_all(") == 1
    told = X.text_entities(docs, lex, hits=hits, resolve=False)
    assert _plan(told).count("(?iuU)") == 3


def test_matches_of_long_texts_and_odd_tokens(spark):
    """Places are right behind the first block of pieces, blanks break a term only in runs, case folds."""
    texts = ["word " * 700 + "Chest PAIN: 7", "chest  pain", "chest\npain", "chest pain", "of of breath", "pain", "", None, "ΟΔΟΣ x chest pain" ]
    docs = local_df(spark, list(enumerate(texts)), "doc_id long, text string")
    dic = local_df(spark, [("symptom", ["chest", "pain"], 2), ("symptom", ["of", "breath"], 2), ("symptom", ["οδος", "x"], 2)],
                   "label string, toks array<string>, n int")
    got = {(r["doc_id"], r["tok_pos"], r["span_text"], r["start_char"], r["end_char"], r["after"])
           for r in match_dictionary(docs, dic, 2, want_offsets=True, window_labels=("symptom",)).collect()}
    assert got == {(0, 700, "Chest PAIN", 3500, 3510, ": 7"), (3, 0, "chest pain", 0, 10, ""), (4, 1, "of breath", 3, 12, ""),
                   (8, 0, "ΟΔΟΣ x", 0, 6, " chest pain"), (8, 2, "chest pain", 7, 17, "")}
