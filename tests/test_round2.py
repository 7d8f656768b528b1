"""Answers that were wrong before, dictionaries of any size, shared folders and stage tables."""

import os
import time

import pytest

from scribeflow.operators import extract as X
from scribeflow.operators import ocr_text as O
from scribeflow.operators import validate as V
from scribeflow.plans import pipeline as PL
from scribeflow.session import ensure_checkpoint_dir
from scribeflow.sources import reference as R
from scribeflow.sources.local import local_df

DOCS = "doc_id long, file_name string, file_type string, file_size_bytes long, full_text string"


def _run(spark, text, stages, dicts=None):
    docs = local_df(spark, [(1, "a.pdf", ".pdf", 1, text)], DOCS)
    return PL.run(docs, dicts or PL.Dictionaries.defaults(spark), active_stages=stages)


def test_built_in_rules_have_no_matching_range(spark):
    d = PL.Dictionaries.defaults(spark)
    e = local_df(spark, [(1, 0, "test_result", "glucose", None, 5.0, None, 1.0, "pdf_table", None, None, 1)],
                 "doc_id long, seq int, type string, name string, value_text string, value_num double, unit string, "
                 "confidence double, source string, start_char long, end_char long, page int")
    f = V.findings(e, d.rules, d.ranges, d.aliases).first()
    assert f["status"] == "unknown" and f["reason"] == "Value did not match any defined range"


def test_stages_run_in_the_configured_order(spark):
    text = "dosage dosage dosage dosage dosage dosage dosage pharmacy"
    late = _run(spark, text, ["classification", "phi_scrubbing"]).reports.first()
    assert late["processing_status"] == "failed" and late["errors"][0]["message"].endswith("Required field 'scrubbed_text' is empty")
    assert _run(spark, text, ["phi_scrubbing", "classification"]).reports.first()["processing_status"] == "success"


def test_confidence_skips_nan(spark):
    w = local_df(spark, [(1, 1, 1, 1, 1, 1, "50", "a"), (1, 1, 2, 1, 1, 1, "NaN", "b"), (1, 1, 3, 1, 1, 1, "x", "c")],
                 "doc_id long, page_number int, seq long, block_num int, par_num int, line_num int, conf string, text string")
    assert O.pages(w.replace("NaN", "nan")).first()["confidence"] == 0.5


def test_missing_and_corrupt_dictionaries(spark):
    d = R.default_dictionaries(spark)
    small = PL.Dictionaries.from_json(d["document_keywords"], None, d["medical_entities"], d["layman_terms"])
    assert small.lexicon.where("label = 'test_result'").count() == 0 and small.lexicon.count() > 0
    broken = local_df(spark, [("x", "{not json")], "path string, value string")
    with pytest.raises(ValueError, match="document_keywords"):
        PL.Dictionaries.from_json(broken, d["lab_ranges"], d["medical_entities"], d["layman_terms"])


def test_large_lexicon_plans_quickly(spark):
    d = R.default_dictionaries(spark)
    terms = R.json_value(spark, {"medications": {"x": [f"drug{k} forte" for k in range(50_000)]}, "conditions": {}, "symptoms": {}})
    dicts = PL.Dictionaries.from_json(d["document_keywords"], d["lab_ranges"], terms, d["layman_terms"])
    began = time.time()
    res = _run(spark, "take Drug49999 forte daily", ["phi_scrubbing", "classification", "extraction"], dicts)
    assert [r["name"] for r in res.entities.collect()] == ["Drug49999 forte"]
    assert time.time() - began < 90


def test_tables_beyond_the_local_limit_stay_whole(spark):
    d = PL.Dictionaries.defaults(spark).localize(limit=10)
    assert d.lexicon.count() == PL.Dictionaries.defaults(spark).lexicon.count()


def test_last_table_row_wins_at_any_position(spark):
    rows = local_df(spark, [(1, 1, 0, 1_000_001, ["glucose", "5"]), (1, 1, 1, 0, ["glucose", "7"]), (1, 10_000_000, 0, 0, ["glucose", "9"])],
                    "doc_id long, page_number int, table_index int, row_index int, cells array<string>")
    docs = local_df(spark, [(1, ".pdf")], "doc_id long, file_type string")
    t = X.table_entities(rows, docs, local_df(spark, [("glucose",)], "key_lower string"))
    text = X.text_entities(local_df(spark, [(1, "nothing")], "doc_id long, text string"), PL.Dictionaries.defaults(spark).lexicon)
    assert [r["value_num"] for r in X.merge_entities(t, text).collect()] == [9.0]


def test_stage_tables_are_released(spark):
    res = _run(spark, "glucose: 5 mg/dL", ["phi_scrubbing", "classification", "extraction", "validation", "summarization"])
    files = [f.removeprefix("file://") for df in res.stage_tables for f in df.inputFiles()]
    assert files and all(os.path.exists(f) for f in files)
    res.release()
    assert not any(os.path.exists(f) for f in files)


def test_no_local_folder_on_a_cluster():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())
