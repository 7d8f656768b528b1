"""Summaries: findings + entities -> text per document.

Per document everything is computed with array expressions over a single
``groupBy(doc_id)`` of the entities and the validation report row, so the
stage adds one shuffle keyed by document.  Layman terms are joined: a row for
each diagnosis, which keeps the partitioning by document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scribeflow import fixed_values as fv
from scribeflow.functions.text import py_float_str, py_strip, percent0, title_case
from scribeflow.sources.reference import bcast, by_key


# ----------------------------------------------------------- expressions --
def value_str(value_text: Column, value_num: Column) -> Column:
    """``str(value)`` of an entity/finding value (None -> 'None')."""
    return F.when(value_num.isNotNull(), py_float_str(value_num)).when(
        value_text.isNotNull(), value_text).otherwise(F.lit("None"))


def format_value_unit(value_text: Column, value_num: Column, unit: Column) -> Column:
    """``" ".join(p for p in [str(value), unit or ""] if p).strip()``."""
    v = value_str(value_text, value_num)
    return py_strip(F.concat_ws(" ", F.nullif(v, F.lit("")), F.nullif(unit, F.lit(""))))


def finding_line(prefix: str, f: Column) -> Column:
    return F.concat(
        F.lit(prefix), f["test_name"], F.lit(" = "),
        format_value_unit(f["value_text"], f["value_num"], f["unit"]),
        F.lit(" ("), F.coalesce(f["reason"], F.lit("None")), F.lit(")"),
    )


def diagnosis_of(f: Column) -> Column:
    """First diagnosis rule hit by a finding (name / reason substrings)."""
    name, reason = F.lower(f["test_name"]), F.lower(F.coalesce(f["reason"], F.lit("")))
    out = None
    for n_sub, r_sub, label in fv.DIAGNOSIS_RULES:
        cond = F.contains(name, F.lit(n_sub)) & F.contains(reason, F.lit(r_sub))
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out


def diagnosis_key(d: Column) -> Column:
    return F.replace(F.lower(F.substring_index(d, " (", 1)), F.lit(" "), F.lit("_"))


def layman_terms(layman: DataFrame) -> DataFrame:
    """(term_key, term_text): what a diagnosis key is explained by.  Only keys that a diagnosis can
    have are kept (``diagnosis_key`` lower-cases and has no blanks)."""
    key = F.col("key")
    return layman.where((F.col("section") == "medical_to_layman") & (key == F.lower(key)) & ~F.contains(key, F.lit(" "))).groupBy(
        key.alias("term_key")).agg(F.max_by(F.concat("layman", F.lit(": "), "explanation"), F.col("explanation")).alias("term_text"))


def explained(rows: DataFrame, diagnosis: str, layman: DataFrame, out: str) -> DataFrame:
    """``rows`` with the explanation of the diagnosis in ``out``, the diagnosis itself where there is
    none: a join with the dictionary, broadcast only if its counted size allows."""
    terms = bcast(layman_terms(layman))
    return (rows.join(terms, diagnosis_key(F.col(diagnosis)) == F.col("term_key"), "left")
            .withColumn(out, F.coalesce("term_text", diagnosis)).drop("term_key", "term_text"))


def status_sentences(layman: DataFrame) -> dict[str, str]:
    rows = layman.where((F.col("section") == "test_results") & F.col("key").isin(*fv.DEFAULT_STATUS_SENTENCE)).collect()
    got = {r["key"]: r["explanation"] for r in rows if r["explanation"] is not None}
    return {k: got.get(k, d) for k, d in fv.DEFAULT_STATUS_SENTENCE.items()}


# --------------------------------------------------------------- operator --
def entity_rollup(entities: DataFrame) -> DataFrame:
    """Per document: test/vital counts, distinct medications (first wins by
    ``lower(strip(name))``) and title-cased condition names."""
    e = entities.repartition("doc_id")
    mk = F.lower(py_strip("name"))
    w = Window.partitionBy("doc_id", F.when(F.col("type") == "medication", mk)).orderBy("seq")
    e = e.withColumn("_first_med", (F.col("type") == "medication") & (F.row_number().over(w) == 1))
    val = F.when(F.col("value_num").isNotNull(), F.when(F.col("value_num") != 0, py_float_str(F.col("value_num")))) \
        .otherwise(F.when(F.col("value_text") != "", F.col("value_text")))
    med = F.struct(
        F.col("seq"), F.col("name"),
        F.coalesce(val, F.lit(fv.NOT_SPECIFIED)).alias("dosage"),
        F.nullif(F.col("unit"), F.lit("")).alias("unit"),
        F.coalesce(F.nullif(F.col("frequency"), F.lit("")) if "frequency" in entities.columns else F.lit(None), F.lit(fv.AS_PRESCRIBED)).alias("frequency"),
        F.col("confidence"),
    )
    return e.groupBy("doc_id").agg(
        F.count_if(F.col("type") == "test_result").alias("test_count"),
        F.count_if(F.col("type") == "vital_sign").alias("vital_count"),
        F.array_sort(F.collect_list(F.when(F.col("_first_med"), med))).alias("medications"),
        F.collect_set(F.when(F.col("type") == "condition", title_case("name"))).alias("condition_names"),
    )


def summarize(docs: DataFrame, classification: DataFrame | None, entities: DataFrame,
              report: DataFrame | None, layman: DataFrame) -> DataFrame:
    """Summary per document:
    (doc_id, document_summary, key_findings, abnormal_values, medications,
    diagnoses, layman_explanation).

    ``report`` has (doc_id, critical_values, abnormal_values); a document
    without a report row gets "No validation report available".  With
    ``classification=None`` the document rows may carry ``document_type`` /
    ``confidence`` themselves (null = classification did not finish).
    """
    sentences = status_sentences(layman)
    keep = [c for c in ("document_type", "confidence") if classification is None and c in docs.columns]
    d = docs.select("doc_id", "file_name", *keep)
    d = d.join(by_key(entity_rollup(entities)), "doc_id", "left")
    if report is not None:
        d = d.join(by_key(report.select("doc_id", "critical_values", "abnormal_values").withColumn("_rep", F.lit(True))),
                   "doc_id", "left")
    else:
        empty = "array<struct<seq:int,test_name:string,value_text:string,value_num:double,unit:string,status:string,reason:string,reference_range:string>>"
        d = d.select("*", F.lit(None).cast(empty).alias("critical_values"), F.lit(None).cast(empty).alias("abnormal_values"),
                     F.lit(None).cast("boolean").alias("_rep"))
    if classification is not None:
        d = d.join(by_key(classification.select("doc_id", "document_type", "confidence").withColumn("_cls", F.lit(True))),
                   "doc_id", "left")
    elif "document_type" in docs.columns:
        d = d.withColumn("_cls", F.when(F.col("document_type").isNotNull(), F.lit(True)))
    else:
        d = d.select("*", F.lit(None).cast("string").alias("document_type"), F.lit(None).cast("double").alias("confidence"),
                     F.lit(None).cast("boolean").alias("_cls"))

    has_rep = F.col("_rep").isNotNull()
    crit = F.coalesce("critical_values", F.array().cast(d.schema["critical_values"].dataType))
    abn = F.coalesce("abnormal_values", F.array().cast(d.schema["abnormal_values"].dataType))
    meds = F.coalesce("medications", F.array().cast(d.schema["medications"].dataType))
    n_crit, n_abn = F.size(crit), F.size(abn)
    tests, vitals, n_meds = F.coalesce("test_count", F.lit(0)), F.coalesce("vital_count", F.lit(0)), F.size(meds)

    abnormal_union = F.concat(crit, abn)
    rule_diags = F.filter(F.transform(abnormal_union, diagnosis_of), lambda x: x.isNotNull())
    diags = F.array_sort(F.array_distinct(F.concat(rule_diags, F.coalesce("condition_names", F.array().cast("array<string>")))))

    kf_lines = F.concat(F.transform(crit, lambda f: finding_line("CRITICAL: ", f)),
                        F.transform(abn, lambda f: finding_line("ABNORMAL: ", f)))
    key_findings = F.when(~has_rep | F.col("_rep").isNull(), F.array(F.lit(fv.NO_REPORT_FINDING))).when(
        F.size(kf_lines) == 0, F.array(F.lit(fv.ALL_NORMAL_FINDING))).otherwise(kf_lines)

    parts = F.filter(F.array(
        F.when(tests > 0, F.concat(tests.cast("string"), F.lit(" test result(s)"))),
        F.when(vitals > 0, F.concat(vitals.cast("string"), F.lit(" vital sign(s)"))),
        F.when(n_meds > 0, F.concat(n_meds.cast("string"), F.lit(" medication(s)"))),
    ), lambda x: x.isNotNull())
    doc_summary = F.concat_ws(
        "\n",
        F.concat(F.lit("Report: "), F.col("file_name")),
        F.when(F.col("_cls").isNotNull(), F.concat(
            F.lit("Type: "), F.col("document_type"), F.lit(" (confidence: "), percent0(F.col("confidence")), F.lit(")"))),
        F.when(F.size(parts) > 0, F.concat(F.lit("Data extracted: "), F.array_join(parts, ", "))),
        F.when(n_crit > 0, F.concat(F.lit("Critical findings: "), n_crit.cast("string"),
                                    F.lit(" value(s) requiring immediate attention"))),
        F.when(n_abn > 0, F.concat(F.lit("Abnormal findings: "), n_abn.cast("string"), F.lit(" value(s)"))),
        F.when((n_crit == 0) & (n_abn == 0), F.lit(fv.ALL_NORMAL_SUMMARY)),
    )

    status_sentence = F.when(has_rep & (n_crit > 0), F.lit(sentences["critical"])).when(
        F.size(abnormal_union) > 0, F.lit(sentences["abnormal"])).otherwise(F.lit(sentences["normal"]))
    med_sentence = F.when(n_meds > 0, F.concat(
        F.lit("Current medications mentioned in the report: "),
        F.array_join(F.transform(meds, lambda m: m["name"]), ", "), F.lit(".")))
    d = d.select(
        "doc_id",
        F.struct(doc_summary.alias("document_summary"), key_findings.alias("key_findings"), abnormal_union.alias("abnormal_values"),
                 meds.alias("medications"), diags.alias("diagnoses"), status_sentence.alias("status_sentence"),
                 med_sentence.alias("med_sentence")).alias("row"))
    # a row for each diagnosis, joined with the terms and put together again; all by doc_id, as before
    each = d.select("doc_id", "row", F.posexplode_outer("row.diagnoses").alias("place", "diagnosis"))
    each = explained(each, "diagnosis", layman, "said")
    d = each.groupBy("doc_id").agg(F.any_value("row").alias("row"), F.array_sort(F.collect_list(
        F.when(F.col("place").isNotNull(), F.struct("place", "said")))).alias("said"))
    health = F.when(F.size("said") > 0, F.concat(F.lit("Health findings: "), F.array_join(F.transform("said", lambda x: x["said"]), " ")))
    return d.select(
        "doc_id", "row.document_summary", "row.key_findings", "row.abnormal_values", "row.medications", "row.diagnoses",
        F.concat_ws("\n\n", "row.status_sentence", "row.med_sentence", health).alias("layman_explanation"))


def format_summary_text(summary: DataFrame, sections: tuple[str, ...] = (
        "document_summary", "key_findings", "abnormal_values", "medications", "diagnoses", "layman_explanation")) -> DataFrame:
    """Plain-text rendering (banner, bulleted sections), one string per doc."""
    lines = []
    for s in sections:
        if s == "document_summary":
            lines.append(F.array(F.concat(F.lit(fv.BANNER + "\n"), F.col(s), F.lit("\n" + fv.BANNER + "\n"))))
        elif s == "key_findings":
            lines.append(F.concat(F.array(F.lit("\nKEY FINDINGS:")),
                                  F.transform(s, lambda x: F.concat(F.lit(fv.BULLET), x))))
        elif s == "abnormal_values":
            lines.append(F.concat(F.array(F.lit("\nABNORMAL VALUES:")), F.transform(s, lambda a: F.concat(
                F.lit(fv.BULLET), F.coalesce(a["test_name"], F.lit("None")), F.lit(": "),
                value_str(a["value_text"], a["value_num"]), F.lit(" "), F.coalesce(a["unit"], F.lit("None")),
                F.lit(" ("), F.coalesce(a["reason"], F.lit("None")), F.lit(")")))))
        elif s == "medications":
            lines.append(F.concat(F.array(F.lit("\nMEDICATIONS:")), F.transform(s, lambda m: F.concat(
                F.lit(fv.BULLET), m["name"], F.lit(": "), F.coalesce(m["dosage"], F.lit("None")), F.lit(" "),
                F.coalesce(m["unit"], F.lit("None")), F.lit(" ("), F.coalesce(m["frequency"], F.lit("None")), F.lit(")")))))
        elif s == "diagnoses":
            lines.append(F.concat(F.array(F.lit("\nPOTENTIAL DIAGNOSES:")),
                                  F.transform(s, lambda x: F.concat(F.lit(fv.BULLET), x))))
        elif s == "layman_explanation":
            lines.append(F.array(F.concat(F.lit("\nPATIENT-FRIENDLY EXPLANATION:\n"), F.col(s), F.lit("\n"))))
    text = F.concat(py_strip(F.array_join(F.concat(*lines), "\n")), F.lit("\n"))
    return summary.select("doc_id", text.alias("summary_text"))
