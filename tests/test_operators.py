"""Operators on hand-made inputs with hand-computed expectations."""


from pyspark.sql import functions as F

from scribeflow import fixed_values as fv
from scribeflow.operators import classify as C
from scribeflow.operators import extract as X
from scribeflow.operators import ocr_text as O
from scribeflow.operators import summarize as S
from scribeflow.operators import validate as V
from scribeflow.sources import reference as R


def test_value_unit_window_cases(spark):
    cases = [
        (": 13.5 g/dL", "13.5", "g/dL"),
        ("  is 120/80 mmHg", "120/80", "mmHg"),
        (": 10^3/μL", "10", None),
        (": 1200/80", "1200", "/"),
        (" level was 95 mg/dL", None, None),
        (": -5 mg", "5", "mg"),
        (" 10 mg", None, None),
        (" Dosage 20mg", "20", "mg"),
        (": 1,200 mg", "1", None),
        (": 5 μg", "5", "μg"),
        (" (HbA1c) - 6.1%", "6.1", "%"),
        (": .5 mg", None, None),
        (": 120/80/60", "120/80", "/"),
        (": 2021 mg", None, None),
    ]
    df = spark.createDataFrame([(c,) for c, _, _ in cases], "after string")
    v, u = X.value_unit("after")
    got = [(r[0], r[1]) for r in df.select(v, u).collect()]
    assert got == [(a, b) for _, a, b in cases]


def test_year_guard(spark):
    cases = [("1900", "1900"), ("1901", None), ("2099", None), ("2100", "2100"), ("1950.5", None), ("190/200", "190/200")]
    df = spark.createDataFrame([(": " + c + " mg",) for c, _ in cases], "after string")
    v, _ = X.value_unit("after")
    assert [r[0] for r in df.select(v).collect()] == [w for _, w in cases]


def _default_phrases(spark):
    return R.doc_phrase_table(R.default_dictionaries(spark)["document_keywords"])


def test_type_totals_from_default_dictionary(spark):
    t = {r["doc_type"]: r["total"] for r in R.type_totals(_default_phrases(spark)).collect()}
    assert t == {"lab_report": 29.0, "prescription": 30.0, "diagnosis_report": 25.0,
                 "discharge_summary": 24.0, "patient_history": 23.0}


def test_classify_threshold(spark):
    docs = spark.createDataFrame([
        (1, " ".join(["dosage"] * 6 + ["pharmacy"])),   # 13 / 30
        (2, " ".join(["dosage"] * 7 + ["pharmacy"])),   # 15 / 30
        (3, "   "),
        (4, "nothing to see"),
        (5, " ".join(["dosage"] * 20)),                 # 40 / 30 > 1
    ], "doc_id long, text string")
    out = {r["doc_id"]: r for r in C.classify(docs, _default_phrases(spark)).collect()}
    assert out[1]["document_type"] == "unknown" and abs(out[1]["confidence"] - 13 / 30) < 1e-12
    assert out[1]["keywords_found"] == []
    assert out[2]["document_type"] == "prescription" and out[2]["confidence"] == 0.5
    assert out[2]["keywords_found"] == ["dosage", "pharmacy"]
    assert (out[3]["document_type"], out[3]["confidence"]) == ("unknown", 0.0)
    assert (out[4]["document_type"], out[4]["confidence"]) == ("unknown", 0.0)
    assert out[5]["class_error"] is not None and out[2]["class_error"] is None


def test_keyword_score_overlaps_and_breaks(spark):
    docs = spark.createDataFrame([
        (1, "Past Medical History"), (2, "lab  report"), (3, "lab\nreport"), (4, "lab report"),
    ], "doc_id long, text string")
    m = C.phrase_matches(docs, _default_phrases(spark))
    sc = {(r["doc_id"], r["doc_type"]): r["score"] for r in C.keyword_scores(m).collect()}
    assert sc[(1, "patient_history")] == 4.0      # past medical history + medical history + history(2)
    assert sc[(1, "diagnosis_report")] == 2.0     # past medical history + history(1)
    assert (2, "lab_report") not in sc and (3, "lab_report") not in sc
    assert sc[(4, "lab_report")] == 1.0
    kw = C.keyword_scores(m).where("doc_id = 1 AND doc_type = 'patient_history'").first()["keywords"]
    assert kw == ["History", "Medical History", "Past Medical History"]


def _rules(spark):
    from scribeflow.sources.fixtures import RULES_JSON

    return R.rule_tables(R.json_value(spark, RULES_JSON))


def test_range_match_bounds_and_nan(spark):
    rules, ranges, aliases = _rules(spark)
    ents = spark.createDataFrame([
        (1, 0, "test_result", "hemoglobin", None, 12.0, "g/dL"),      # lo inclusive -> normal
        (1, 1, "test_result", "hemoglobin", None, 17.5, "g/dL"),      # hi exclusive -> abnormal high
        (1, 2, "test_result", "Hgb", None, 5.0, None),                # alias -> critical low
        (1, 3, "test_result", "hemoglobin", None, float("nan"), None),  # NaN -> no range
        (1, 4, "test_result", "potassium", None, 1.0, None),          # gap -> no range
        (1, 5, "test_result", "creatinine", None, 1.0, None),         # no rule
        (1, 6, "vital_sign", "heart_rate", None, 80.0, None),         # empty ruleset
        (1, 7, "medication", "lisinopril", "10", None, "mg"),         # non-numeric
    ], "doc_id long, seq int, type string, name string, value_text string, value_num double, unit string")
    f = {r["seq"]: r for r in V.findings(ents, rules, ranges, aliases).collect()}
    assert (f[0]["status"], f[0]["reference_range"]) == ("normal", "12 - 17.5")
    assert (f[1]["status"], f[1]["reason"]) == ("abnormal", "high")
    assert (f[2]["status"], f[2]["reason"]) == ("critical", "critically low")
    assert (f[3]["status"], f[3]["reason"]) == ("unknown", fv.REASON_NO_RANGE)
    assert (f[4]["status"], f[4]["reason"]) == ("unknown", fv.REASON_NO_RANGE)
    assert f[4]["reference_range"] is None
    assert (f[5]["status"], f[5]["reason"]) == ("unknown", fv.REASON_NOT_FOUND)
    assert (f[6]["status"], f[6]["reason"]) == ("unknown", fv.REASON_NO_RULESET)
    assert (f[7]["status"], f[7]["reason"]) == ("unknown", fv.REASON_NON_NUMERIC)
    rep = V.validation_report(spark.createDataFrame([(1,), (2,)], "doc_id long"),
                              V.findings(ents, rules, ranges, aliases)).collect()
    rep = {r["doc_id"]: r for r in rep}
    assert (rep[1]["total_validated"], rep[1]["valid_count"], rep[1]["invalid_count"]) == (8, 6, 2)
    assert [x["seq"] for x in rep[1]["critical_values"]] == [2]
    assert (rep[2]["total_validated"], rep[2]["valid_count"], rep[2]["critical_values"]) == (0, 0, [])


def test_merge_dedupe_table_last_wins(spark):
    cols = "doc_id long, type string, name string, value_text string, value_num double, unit string, " \
           "confidence double, source string, start_char long, end_char long, page int, tok_pos long"
    tab = spark.createDataFrame([
        (1, "test_result", "glucose", None, 5.0, None, 0.98, "pdf_table", None, None, 1, 10),
        (1, "test_result", "GLUCOSE", None, 6.0, None, 0.98, "pdf_table", None, None, 1, 20),
        (1, "test_result", "sodium", None, 140.0, None, 0.98, "pdf_table", None, None, 1, 30),
    ], cols)
    txt = spark.createDataFrame([
        (1, "test_result", "glucose", "7", None, None, 0.9, "text_ruler", 0, 7, None, 0),
        (1, "medication", "Aspirin", None, None, None, 0.9, "text_ruler", 9, 16, None, 2),
        (1, "medication", "aspirin", "5", None, None, 0.9, "text_ruler", 20, 27, None, 5),
    ], cols)
    out = sorted(X.merge_entities(tab, txt).collect(), key=lambda r: r["seq"])
    assert [(r["seq"], r["name"], r["value_num"], r["value_text"]) for r in out] == [
        (0, "GLUCOSE", 6.0, None), (1, "sodium", 140.0, None), (2, "Aspirin", None, None)]


def test_span_overlap_longest_first(spark):
    lex = spark.createDataFrame([
        ("condition", ["heart"], 1), ("condition", ["heart", "disease"], 2), ("symptom", ["disease", "x", "y"], 3),
        ("symptom", ["chest", "pain"], 2), ("symptom", ["pain"], 1),
    ], "label string, toks array<string>, n int")
    docs = spark.createDataFrame([(1, "heart disease x y and chest pain, heart")], "doc_id long, text string")
    h = X.gazetteer_hits(docs, lex.withColumn("term", F.lit("")))
    got = sorted((r["tok_pos"], r["span_text"]) for r in X.resolve_spans(h).collect())
    # "disease x y" (3 tokens) beats "heart disease" (2); "heart" then stands alone
    assert got == [(0, "heart"), (1, "disease x y"), (5, "chest pain"), (8, "heart")]


def test_ocr_page_text_and_stats(spark):
    rows = [
        # doc, page, seq, block, par, line, conf, text
        (1, 1, 1, 1, 1, 1, "-1", " "),
        (1, 1, 2, 1, 1, 1, "0", "Hello"),
        (1, 1, 3, 1, 1, 1, "90", "world "),
        (1, 1, 4, 1, 1, 2, "x", "next"),
        (1, 1, 5, 1, 2, 1, "80", "para"),
        (1, 1, 6, 1, 1, 1, "", "again"),
        (1, 2, 1, 0, 0, 0, "95", "   "),
    ]
    w = spark.createDataFrame(rows, "doc_id long, page_number int, seq long, block_num int, par_num int, "
                                    "line_num int, conf string, text string")
    p = {r["page_number"]: r for r in O.pages(w).collect()}
    assert p[1]["raw_text"] == "Hello world\nnext\n\npara\n\nagain"
    assert abs(p[1]["confidence"] - 0.85) < 1e-12
    assert p[1]["num_lines"] == 3
    assert (p[2]["raw_text"], p[2]["confidence"], p[2]["num_lines"]) == ("", 0.0, 0)
    ft = O.full_text(O.pages(w)).first()["full_text"]
    assert ft == p[1]["raw_text"] + fv.PAGE_BREAK


def test_blank_pages_full_text(spark):
    pages = spark.createDataFrame([(1, 1, ""), (1, 2, "")], "doc_id long, page_number int, raw_text string")
    assert O.full_text(pages).first()["full_text"] == fv.PAGE_BREAK


def test_summary_texts(spark):
    lay = R.layman_table(R.default_dictionaries(spark)["layman_terms"])
    docs = spark.createDataFrame([(1, "a.pdf"), (2, "b.jpg")], "doc_id long, file_name string")
    cls = spark.createDataFrame([(1, "lab_report", 0.425), (2, "unknown", 0.445)],
                                "doc_id long, document_type string, confidence double")
    ents = spark.createDataFrame([
        (1, 0, "test_result", "glucose", None, 45.0, "mg/dL", 0.98),
        (1, 1, "condition", "COPD", None, None, None, 0.9),
        (1, 2, "condition", "hypertension", None, None, None, 0.9),
        (1, 3, "medication", "Lisinopril", "10", None, "mg", 0.9),
        (1, 4, "medication", " lisinopril", "20", None, "mg", 0.9),
    ], "doc_id long, seq int, type string, name string, value_text string, value_num double, unit string, confidence double")
    item = "struct<seq:int,test_name:string,value_text:string,value_num:double,unit:string,status:string,reason:string,reference_range:string>"
    rep = spark.createDataFrame([(1,)], "doc_id long").select(
        "doc_id",
        F.array(F.struct(F.lit(0).alias("seq"), F.lit("glucose").alias("test_name"), F.lit(None).cast("string").alias("value_text"),
                         F.lit(45.0).alias("value_num"), F.lit("mg/dL").alias("unit"), F.lit("critical").alias("status"),
                         F.lit("very high").alias("reason"), F.lit("4 - 20").alias("reference_range"))).cast(f"array<{item}>").alias("critical_values"),
        F.array().cast(f"array<{item}>").alias("abnormal_values"))
    s = {r["doc_id"]: r for r in S.summarize(docs, cls, ents, rep, lay).collect()}
    d1 = s[1]
    assert d1["document_summary"] == ("Report: a.pdf\nType: lab_report (confidence: 42%)\n"
                                      "Data extracted: 1 test result(s), 1 medication(s)\n"
                                      "Critical findings: 1 value(s) requiring immediate attention")
    assert d1["key_findings"] == ["CRITICAL: glucose = 45.0 mg/dL (very high)"]
    assert d1["diagnoses"] == sorted(["Copd", "Hypertension", "Hyperglycemia (High Blood Sugar)"])
    assert [m["dosage"] for m in d1["medications"]] == ["10"]
    assert d1["layman_explanation"].split("\n\n")[1] == "Current medications mentioned in the report: Lisinopril."
    assert "High blood pressure: Your blood pressure" in d1["layman_explanation"]
    assert "Health findings: Copd Hyperglycemia (High Blood Sugar) High blood pressure: " in d1["layman_explanation"]
    d2 = s[2]
    assert d2["key_findings"] == ["No validation report available"]
    assert d2["document_summary"] == "Report: b.jpg\nType: unknown (confidence: 44%)\nAll validated findings are within normal ranges"
    assert d2["layman_explanation"] == fv.TEST_RESULT_TEMPLATES["normal"][2]


def test_hot_document_many_repeats(spark):
    """One document mentioning the same entity 20 000 times (a hot key): one
    entity (first text hit wins) with the right offsets; a second hot document
    whose phrase score passes 1.0 fails classification and gets no entities."""
    import time

    from scribeflow.plans import pipeline as PL

    text = " ".join(f"metformin - {i % 97 + 1}" for i in range(20000))   # no classification keyword
    hot2 = " ".join(f"glucose: {i % 97 + 1} mg/dL dosage" for i in range(2000))
    docs = spark.createDataFrame([(1, "hot.png", ".png", 1, text), (2, "cold.png", ".png", 1, "glucose: 3 mg/dL"),
                                  (3, "hot2.png", ".png", 1, hot2)],
                                 "doc_id long, file_name string, file_type string, file_size_bytes long, full_text string")
    t0 = time.time()
    res = PL.run(docs, PL.Dictionaries.defaults(spark), active_stages=PL.TEXT_STAGES)
    ents = {(r["doc_id"], r["name"]): r for r in res.entities.collect()}
    assert set(ents) == {(1, "metformin"), (2, "glucose")}
    assert ents[(1, "metformin")]["value_text"] == "1" and ents[(1, "metformin")]["start_char"] == 0
    hits = X.gazetteer_hits(docs.select("doc_id", F.col("full_text").alias("text")).where("doc_id = 1"),
                            PL.Dictionaries.defaults(spark).lexicon)
    last = hits.orderBy(F.col("tok_pos").desc()).first()
    assert last["start_char"] == text.rindex("metformin") and last["end_char"] == last["start_char"] + 9
    rep = {r["doc_id"]: r for r in res.reports.collect()}
    assert rep[3]["processing_status"] == "failed"            # 2 000 x dosage(2) / 30 > 1.0
    assert rep[3]["errors"][0]["error_code"] == "CLASSIFICATION_ERROR"
    assert rep[1]["processing_status"] == "success" and rep[2]["processing_status"] == "success"
    assert time.time() - t0 < 120
