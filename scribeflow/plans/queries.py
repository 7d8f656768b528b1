"""Registered queries: one per operator of the inventory.

Every query reads the driver tables (through the fixture views derived from
them) and returns a flat DataFrame whose column names match the oracle SQL in
``ORACLE``.  Arrays are returned joined with '|' so both engines compare as
plain strings.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scribeflow.fixed_values import VALUE_LABELS
from scribeflow.operators import classify as C
from scribeflow.operators.tokens import tokenize
from scribeflow.plans.materialize import materialize, memo
from scribeflow.plans.oracle import PIECE_RE, VALUE_RE, cte, with_ctes
from scribeflow.sources import fixtures as fx
from scribeflow.sources.reference import bcast, by_key, doc_phrase_table, json_value, type_totals

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def _row_key() -> F.Column:
    """A table row's place as one number, for the comparison (the engine orders by the struct)."""
    return (F.col("tok_pos.page") * 1_000_000 + F.col("tok_pos.table")) * 1_000_000 + F.col("tok_pos.row")


def _join(c) -> F.Column:
    return F.array_join(c, "|")


# ---------------------------------------------------------------- contexts --
def phrases(spark: SparkSession) -> DataFrame:
    return _dicts(spark).phrases


def _dicts(spark: SparkSession):
    """Fixture dictionaries, flattened from their JSON shapes once per session
    and kept as size-checked literal tables."""
    from scribeflow.plans import pipeline as PL

    def build():
        lab, ent = fx.lexicon_sources_fixture()
        r, rr, ra = rule_tables(json_value(spark, fx.RULES_JSON))
        d = PL.Dictionaries(
            phrases=doc_phrase_table(json_value(spark, fx.doc_keywords_fixture())),
            lexicon=entity_lexicon_table(json_value(spark, lab), json_value(spark, ent)),
            known_tests=X.known_tests_from_lab(json_value(spark, lab)),
            rules=r, ranges=rr, aliases=ra,
            layman=layman_table(default_dictionaries(spark)["layman_terms"]),
        )
        return d.localize()

    return memo(spark, ("fixture_dicts",), build)


def notes(spark: SparkSession, sf: str) -> DataFrame:
    """The derived notes view, written once per session (test input)."""
    return memo(spark, ("notes", sf), lambda: materialize(fx.notes(spark, sf, fx.spread_of(spark, sf, "orders")), "notes"))


def trows(spark: SparkSession, sf: str) -> DataFrame:
    """The derived table-rows view, written once per session (test input)."""
    return memo(spark, ("table_rows", sf), lambda: materialize(fx.table_rows(spark, sf, fx.spread_of(spark, sf, "lineitem")), "table_rows"))


def cdocs(spark: SparkSession, sf: str) -> DataFrame:
    """Notes that pass the classification gate (non-empty text)."""
    return notes(spark, sf).where(F.col("text") != "")


def pmatches(spark: SparkSession, sf: str) -> DataFrame:
    return C.phrase_matches(cdocs(spark, sf), phrases(spark))


# ---------------------------------------------------------- classification --
@register("tokenize", with_ctes("""
SELECT t.doc_id, t.pos AS tok_idx, t.pidx AS piece_idx, t.tok,
       CAST(s.end_char - length(t.tok) AS BIGINT) AS start_char, CAST(s.end_char AS BIGINT) AS end_char
FROM toks t JOIN (SELECT doc_id, pidx, sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY pidx) AS end_char FROM pieces) s
  USING (doc_id, pidx)""", ["toks", "pieces"]))
def q_tokenize(spark, sf):
    t = tokenize(cdocs(spark, sf), "text")
    return t.select("doc_id", "tok_idx", F.col("piece_idx").cast("long").alias("piece_idx"), "tok", "start_char", "end_char")


@register("phrase_match", with_ctes("SELECT doc_id, pos AS tok_pos, doc_type, span_text, weight FROM pmatch", ["pmatch"]))
def q_phrase_match(spark, sf):
    return pmatches(spark, sf).select("doc_id", F.col("tok_pos").cast("long").alias("tok_pos"), "doc_type", "span_text", "weight")


@register("keyword_score", with_ctes("SELECT doc_id, doc_type, score FROM kscores", ["kscores"]))
def q_keyword_score(spark, sf):
    return C.keyword_scores(pmatches(spark, sf)).select("doc_id", "doc_type", "score")


@register("type_total_score", with_ctes("""
SELECT t.doc_type, t.total, count(k.doc_id) AS docs_with_hits,
       CAST(sum(CASE WHEN k.score > t.total THEN 1 ELSE 0 END) AS BIGINT) AS docs_over_total
FROM type_totals t LEFT JOIN kscores k USING (doc_type, type_ord) GROUP BY t.doc_type, t.total""", ["type_totals", "kscores"]))
def q_type_total_score(spark, sf):
    tot = type_totals(phrases(spark))
    k = C.keyword_scores(pmatches(spark, sf))
    return tot.join(k, ["doc_type", "type_ord"], "left").groupBy("doc_type", "total").agg(
        F.count("doc_id").alias("docs_with_hits"),
        F.sum(F.when(F.col("score") > F.col("total"), 1).otherwise(0)).cast("long").alias("docs_over_total"),
    )


@register("score_normalize", with_ctes("SELECT doc_id, doc_type, norm FROM nscores", ["nscores"]))
def q_score_normalize(spark, sf):
    ph = phrases(spark)
    return C.normalize_scores(C.keyword_scores(pmatches(spark, sf)), type_totals(ph)).select("doc_id", "doc_type", "norm")


@register("classify_argmax", with_ctes("SELECT doc_id, doc_type AS best_type, norm AS best_score FROM best", ["best"]))
def q_classify_argmax(spark, sf):
    ph = phrases(spark)
    n = C.normalize_scores(C.keyword_scores(pmatches(spark, sf)), type_totals(ph))
    b = n.groupBy("doc_id").agg(F.max_by(F.struct("doc_type", "norm"), F.struct(F.col("norm"), -F.col("type_ord"))).alias("b"))
    return b.select("doc_id", F.col("b.doc_type").alias("best_type"), F.col("b.norm").alias("best_score"))


@register("classify_threshold", with_ctes("SELECT doc_id, document_type, confidence, over_one FROM classification", ["classification"]))
def q_classify_threshold(spark, sf):
    c = C.classify(cdocs(spark, sf), phrases(spark))
    return c.select("doc_id", "document_type", "confidence", F.col("class_error").isNotNull().alias("over_one"))


@register("classify_keywords", with_ctes("SELECT doc_id, document_type, keywords FROM classification", ["classification"]))
def q_classify_keywords(spark, sf):
    c = C.classify(cdocs(spark, sf), phrases(spark))
    return c.select("doc_id", "document_type", _join("keywords_found").alias("keywords"))


# ------------------------------------------------------------- extraction --
from scribeflow.operators import extract as X  # noqa: E402
from scribeflow.operators import validate as V  # noqa: E402
from scribeflow.sources.files import file_type_of  # noqa: E402
from scribeflow.sources.reference import entity_lexicon_table, rule_tables  # noqa: E402


def lexicon(spark: SparkSession) -> DataFrame:
    return _dicts(spark).lexicon


def known_tests(spark: SparkSession) -> DataFrame:
    return _dicts(spark).known_tests


def docs_meta(spark: SparkSession, sf: str) -> DataFrame:
    return notes(spark, sf).select("doc_id", "file_name", file_type_of(F.col("file_name")).alias("file_type"), "text")


def text_ents(spark: SparkSession, sf: str) -> DataFrame:
    return X.text_entities(cdocs(spark, sf), lexicon(spark))


def tab_ents(spark: SparkSession, sf: str) -> DataFrame:
    return X.table_entities(trows(spark, sf), docs_meta(spark, sf), known_tests(spark))


def entities(spark: SparkSession, sf: str) -> DataFrame:
    c = cdocs(spark, sf).select("doc_id")
    return X.merge_entities(tab_ents(spark, sf).join(by_key(c), "doc_id", "left_semi"), text_ents(spark, sf))


def rules(spark: SparkSession):
    d = _dicts(spark)
    return d.rules, d.ranges, d.aliases


def finds(spark: SparkSession, sf: str) -> DataFrame:
    r, rr, ra = rules(spark)
    return V.findings(entities(spark, sf), r, rr, ra)


@register("gazetteer_match", with_ctes(
    "SELECT doc_id, pos AS tok_pos, label, span_text, CAST(start_char AS BIGINT) AS start_char, "
    "CAST(start_char + length(span_text) AS BIGINT) AS end_char FROM ematch", ["ematch"]))
def q_gazetteer_match(spark, sf):
    h = X.gazetteer_hits(cdocs(spark, sf), lexicon(spark))
    return h.select("doc_id", F.col("tok_pos").cast("long").alias("tok_pos"), "label", "span_text", "start_char", "end_char")


#: Terms that lie inside one another: (label, term, tokens).
NESTED_TERMS = [("symptom", "shortness of breath", 3), ("symptom", "of breath", 2), ("symptom", "breath", 1), ("condition", "heart disease", 2),
                ("condition", "disease", 1), ("symptom", "chest pain", 2), ("symptom", "pain", 1), ("condition", "hypertension", 1)]
cte("nested_terms", [], "SELECT * FROM " + fx._values(NESTED_TERMS, ["label", "term", "n"]))
cte("nested_hits", ["tokw", "nested_terms"], """
SELECT t.doc_id, t.pos, x.label, CAST(x.n AS INTEGER) AS n FROM tokw t JOIN nested_terms x
  ON (x.n = 1 AND x.term = t.tl) OR (x.n = 2 AND x.term = t.tl || ' ' || t.tl1) OR (x.n = 3 AND x.term = t.tl || ' ' || t.tl1 || ' ' || t.tl2)""")
cte("nested_longer", ["nested_hits"], """
SELECT * FROM nested_hits WHERE n = 3
UNION ALL SELECT h.* FROM nested_hits h WHERE h.n = 2 AND NOT EXISTS (
  SELECT 1 FROM nested_hits k WHERE k.n = 3 AND k.doc_id = h.doc_id AND k.pos < h.pos + h.n AND h.pos < k.pos + k.n)""")


@register("span_overlap_resolve", with_ctes("""
SELECT doc_id, pos AS tok_pos, label, n FROM nested_longer
UNION ALL SELECT h.doc_id, h.pos, h.label, h.n FROM nested_hits h WHERE h.n = 1 AND NOT EXISTS (
  SELECT 1 FROM nested_longer k WHERE k.doc_id = h.doc_id AND k.pos < h.pos + h.n AND h.pos < k.pos + k.n)""", ["nested_longer", "nested_hits"]))
def q_span_overlap_resolve(spark, sf):
    """Hits of a lexicon whose terms lie inside one another: the longest stay."""
    ent = {"medications": {}, "conditions": [t for x, t, _ in NESTED_TERMS if x == "condition"], "symptoms": [t for x, t, _ in NESTED_TERMS if x == "symptom"]}
    lex = entity_lexicon_table(json_value(spark, {"blood_tests": {}, "vital_signs": {}}), json_value(spark, ent))
    h = X.gazetteer_hits(cdocs(spark, sf), lex)
    return X.resolve_spans(h).select("doc_id", F.col("tok_pos").cast("long").alias("tok_pos"), "label", F.col("n").cast("int").alias("n"))


@register("entity_label_filter", with_ctes(
    "SELECT type, CAST(count(*) AS BIGINT) AS n_entities, CAST(count(DISTINCT doc_id) AS BIGINT) AS n_docs "
    "FROM text_ents WHERE type IN ('test_result','vital_sign','medication','diagnosis','symptom','condition','other') GROUP BY type",
    ["text_ents"]))
def q_entity_label_filter(spark, sf):
    t = text_ents(spark, sf)
    return t.groupBy("type").agg(F.count(F.lit(1)).alias("n_entities"), F.countDistinct("doc_id").alias("n_docs"))


@register("value_unit_extract", with_ctes(
    "SELECT doc_id, pos AS tok_pos, label AS type, span_text AS name, "
    "nullif(regexp_extract(after, " + VALUE_RE + ", 1), '') AS value_raw, "
    "nullif(regexp_extract(after, " + VALUE_RE + ", 2), '') AS unit_raw "
    "FROM text_ents_raw WHERE after IS NOT NULL", ["text_ents_raw"]))
def q_value_unit_extract(spark, sf):
    # hits of these labels, and only they, have a text after them; a filter of that text would be
    # pushed below the steps that make it, and every step be copied into it
    h = X.gazetteer_hits(cdocs(spark, sf), lexicon(spark)).where(F.col("label").isin(list(VALUE_LABELS)))
    value, unit = X.raw_value_unit(F.col("after"))
    return h.select(
        "doc_id", F.col("tok_pos").cast("long").alias("tok_pos"), F.col("label").alias("type"), F.col("span_text").alias("name"),
        value.alias("value_raw"), unit.alias("unit_raw"),
    )


@register("year_guard", with_ctes(
    "SELECT doc_id, pos AS tok_pos, type, name, value_text, unit FROM text_ents "
    "WHERE type IN ('test_result','vital_sign','medication')", ["text_ents"]))
def q_year_guard(spark, sf):
    t = text_ents(spark, sf).where(F.col("type").isin("test_result", "vital_sign", "medication"))
    return t.select("doc_id", F.col("tok_pos.row").alias("tok_pos"), "type", "name", "value_text", "unit")


@register("table_row_filter", with_ctes(
    "SELECT doc_id, page AS page_number, pos AS row_key, name FROM tab_ents", ["tab_ents"]))
def q_table_row_filter(spark, sf):
    t = tab_ents(spark, sf)
    return t.select("doc_id", F.col("page").alias("page_number"), _row_key().alias("row_key"), "name")


@register("table_row_project", with_ctes(
    "SELECT doc_id, pos AS row_key, name, value_text, value_num, unit, CAST(0.98 AS DOUBLE) AS confidence, "
    "'pdf_table' AS source, page FROM tab_ents", ["tab_ents"]))
def q_table_row_project(spark, sf):
    t = tab_ents(spark, sf)
    return t.select("doc_id", _row_key().alias("row_key"), "name", "value_text", "value_num", "unit",
                    "confidence", "source", "page")


@register("table_source_gate", with_ctes("""
SELECT n.doc_id, n.file_name, CAST(count(t.doc_id) AS BIGINT) AS n_table_entities
FROM notes n LEFT JOIN tab_ents t USING (doc_id)
WHERE n.doc_id IN (SELECT doc_id FROM table_rows)
GROUP BY n.doc_id, n.file_name""", ["notes", "tab_ents", "table_rows"]))
def q_table_source_gate(spark, sf):
    t = by_key(tab_ents(spark, sf).select(F.col("doc_id").alias("_tid")))
    d = notes(spark, sf).join(by_key(trows(spark, sf).select("doc_id").distinct()), "doc_id", "left_semi")
    return d.join(t, d["doc_id"] == t["_tid"], "left").groupBy("doc_id", "file_name").agg(
        F.count("_tid").alias("n_table_entities"))


@register("entity_merge_dedupe", with_ctes(
    "SELECT doc_id, seq, type, name, value_text, value_num, unit, page FROM ents", ["ents"]))
def q_entity_merge_dedupe(spark, sf):
    return entities(spark, sf).select("doc_id", "seq", "type", "name", "value_text", "value_num", "unit", "page")


# -------------------------------------------------------------- validation --
@register("normalize_key", with_ctes(
    "SELECT doc_id, seq, name, key_norm FROM ents_k", ["ents_k"]))
def q_normalize_key(spark, sf):
    from scribeflow.functions.text import normalize_key

    return entities(spark, sf).select("doc_id", "seq", "name", normalize_key("name").alias("key_norm"))


@register("ruleset_route", with_ctes(
    "SELECT doc_id, seq, type, section AS ruleset FROM ents_k", ["ents_k"]))
def q_ruleset_route(spark, sf):
    r, _, _ = rules(spark)
    e = entities(spark, sf)
    sec = F.when(F.col("type") == "test_result", "blood_tests").when(F.col("type") == "vital_sign", "vital_signs")
    s = bcast(V.sections_with_rules(r))
    e = e.withColumn("sec", sec)
    return e.join(s, e["sec"] == s["section"], "left").select("doc_id", "seq", "type", F.col("section").alias("ruleset"))


@register("rule_lookup", with_ctes(
    "SELECT doc_id, seq, key_norm, rule_key FROM ents_k WHERE value_num IS NOT NULL", ["ents_k"]))
def q_rule_lookup(spark, sf):
    from scribeflow.functions.text import normalize_key

    r, _, ra = rules(spark)
    e = entities(spark, sf).where(F.col("value_num").isNotNull()).withColumn("key_norm", normalize_key("name"))
    sec = F.when(F.col("type") == "test_result", "blood_tests").when(F.col("type") == "vital_sign", "vital_signs")
    look = bcast(V.rule_lookup_table(r, ra))
    e = e.withColumn("sec", sec)
    return e.join(look, (e["sec"] == look["section"]) & (e["key_norm"] == look["match_key"]), "left").select(
        "doc_id", "seq", "key_norm", "rule_key")


@register("range_match", with_ctes(
    "SELECT doc_id, seq, test_name, value_num, status, reason FROM findings", ["findings"]))
def q_range_match(spark, sf):
    return finds(spark, sf).select("doc_id", "seq", "test_name", "value_num", "status", "reason")


@register("reference_range_format", with_ctes(
    "SELECT doc_id, seq, status, reference_range FROM findings", ["findings"]))
def q_reference_range_format(spark, sf):
    return finds(spark, sf).select("doc_id", "seq", "status", "reference_range")


@register("nonnumeric_finding", with_ctes(
    "SELECT doc_id, seq, test_name, value_text, status, reason FROM findings WHERE value_num IS NULL", ["findings"]))
def q_nonnumeric_finding(spark, sf):
    return finds(spark, sf).where(F.col("value_num").isNull()).select(
        "doc_id", "seq", "test_name", "value_text", "status", "reason")


def vreport(spark: SparkSession, sf: str) -> DataFrame:
    return V.validation_report(cdocs(spark, sf), finds(spark, sf))


@register("validation_report", with_ctes(
    "SELECT * FROM vreport", ["vreport"]))
def q_validation_report(spark, sf):
    r = vreport(spark, sf)
    names = lambda c: F.array_join(F.transform(c, lambda x: x["test_name"]), "|")
    return r.select("doc_id", "total_validated", "valid_count", "invalid_count", "abnormal_count", "critical_count",
                    names(F.col("critical_values")).alias("critical_names"),
                    names(F.col("abnormal_values")).alias("abnormal_names"))


# --------------------------------------------------------------- summaries --
from scribeflow.operators import summarize as S  # noqa: E402
from scribeflow.plans.oracle import cte as _cte  # noqa: E402

_cte("stext", ["summary"], """SELECT doc_id, trim(
  repeat('=', 80) || chr(10) || document_summary || chr(10) || repeat('=', 80) || chr(10) || chr(10) ||
  chr(10) || 'KEY FINDINGS:' || chr(10) || '  • ' || replace(key_findings, '|', chr(10) || '  • ') || chr(10) ||
  chr(10) || 'POTENTIAL DIAGNOSES:' || CASE WHEN diagnoses = '' THEN '' ELSE chr(10) || '  • ' || replace(diagnoses, '|', chr(10) || '  • ') END || chr(10) ||
  chr(10) || 'PATIENT-FRIENDLY EXPLANATION:' || chr(10) || layman_explanation || chr(10), chr(10) || ' ') || chr(10) AS summary_text
FROM summary""")
from scribeflow.sources.reference import default_dictionaries, layman_table  # noqa: E402


def layman(spark: SparkSession) -> DataFrame:
    return _dicts(spark).layman


def summaries(spark: SparkSession, sf: str) -> DataFrame:
    docs = cdocs(spark, sf)
    cls = C.classify(docs, phrases(spark))
    ents = materialize(entities(spark, sf), "entities")  # read by findings and by the rollup
    r, rr, ra = rules(spark)
    rep = V.validation_report(docs, V.findings(ents, r, rr, ra))
    return S.summarize(docs, cls, ents, rep, layman(spark))


@register("abnormal_union", with_ctes(
    "SELECT doc_id, string_agg(test_name || ':' || status, '|' ORDER BY srank, seq) AS abnormal_values FROM abn GROUP BY doc_id",
    ["abn"]))
def q_abnormal_union(spark, sf):
    s = summaries(spark, sf).where(F.size("abnormal_values") > 0)
    return s.select("doc_id", F.array_join(F.transform("abnormal_values", lambda f: F.concat(
        f["test_name"], F.lit(":"), f["status"])), "|").alias("abnormal_values"))


@register("medication_list", with_ctes("SELECT doc_id, seq, name, dosage, unit, frequency FROM meds", ["meds"]))
def q_medication_list(spark, sf):
    s = summaries(spark, sf).select("doc_id", F.explode("medications").alias("m"))
    return s.select("doc_id", "m.seq", "m.name", "m.dosage", "m.unit", "m.frequency")


@register("diagnosis_rules", with_ctes(
    "SELECT doc_id, seq, test_name, rule_diag AS diagnosis FROM abn WHERE rule_diag IS NOT NULL", ["abn"]))
def q_diagnosis_rules(spark, sf):
    r = vreport(spark, sf).select("doc_id", F.explode(F.concat("critical_values", "abnormal_values")).alias("f"))
    return r.select("doc_id", "f.seq", "f.test_name", S.diagnosis_of(F.col("f")).alias("diagnosis")).where(
        F.col("diagnosis").isNotNull())


@register("diagnosis_set", with_ctes("SELECT doc_id, diagnoses FROM summary", ["summary"]))
def q_diagnosis_set(spark, sf):
    return summaries(spark, sf).select("doc_id", _join("diagnoses").alias("diagnoses"))


@register("key_findings", with_ctes("SELECT doc_id, key_findings FROM summary", ["summary"]))
def q_key_findings(spark, sf):
    return summaries(spark, sf).select("doc_id", _join("key_findings").alias("key_findings"))


@register("format_value_unit", with_ctes(
    "SELECT doc_id, seq, trim(concat_ws(' ', nullif(coalesce(CAST(value_num AS VARCHAR), value_text, 'None'), ''), "
    "nullif(unit, ''))) AS value_unit FROM findings", ["findings"]))
def q_format_value_unit(spark, sf):
    f = finds(spark, sf)
    return f.select("doc_id", "seq", S.format_value_unit(F.col("value_text"), F.col("value_num"), F.col("unit")).alias("value_unit"))


@register("document_summary", with_ctes("SELECT doc_id, document_summary FROM summary", ["summary"]))
def q_document_summary(spark, sf):
    return summaries(spark, sf).select("doc_id", "document_summary")


@register("layman_join", with_ctes("SELECT doc_id, diagnosis, expl FROM diag_x", ["diag_x"]))
def q_layman_join(spark, sf):
    s = summaries(spark, sf).select("doc_id", F.explode("diagnoses").alias("diagnosis"))
    return S.explained(s, "diagnosis", layman(spark), "expl")


@register("layman_explanation", with_ctes("SELECT doc_id, layman_explanation FROM summary", ["summary"]))
def q_layman_explanation(spark, sf):
    return summaries(spark, sf).select("doc_id", "layman_explanation")


@register("summary_text_format", with_ctes("SELECT doc_id, summary_text FROM stext", ["stext"]))
def q_summary_text_format(spark, sf):
    s = summaries(spark, sf)
    return S.format_summary_text(s, ("document_summary", "key_findings", "diagnoses", "layman_explanation"))


# --------------------------------------------------------------------- OCR --
from scribeflow.operators import ocr_text as O  # noqa: E402


@register("ocr_word_filter", with_ctes("SELECT doc_id, page_number, seq, word FROM ocr_kept", ["ocr_kept"]))
def q_ocr_word_filter(spark, sf):
    return O.clean_words(fx.ocr_words(spark, sf)).select("doc_id", "page_number", "seq", "word")


@register("ocr_line_segments", with_ctes(
    "SELECT doc_id, page_number, seq, CAST(line_id AS BIGINT) AS line_id, new_par FROM ocr_seg", ["ocr_seg"]))
def q_ocr_line_segments(spark, sf):
    s = O.line_segments(fx.ocr_words(spark, sf))
    return s.select("doc_id", "page_number", "seq", F.col("line_id").cast("long").alias("line_id"), "new_par")


@register("ocr_page_text", with_ctes("SELECT doc_id, page_number, raw_text FROM ocr_ptext", ["ocr_ptext"]))
def q_ocr_page_text(spark, sf):
    return O.page_text(fx.ocr_words(spark, sf))


@register("ocr_page_confidence", with_ctes(
    "SELECT doc_id, source_page, confidence FROM ocr_pages", ["ocr_pages"]))
def q_ocr_page_confidence(spark, sf):
    return O.pages(fx.ocr_words(spark, sf)).select("doc_id", "source_page", "confidence")


@register("ocr_page_line_count", with_ctes(
    "SELECT doc_id, source_page, num_lines FROM ocr_pages", ["ocr_pages"]))
def q_ocr_page_line_count(spark, sf):
    return O.pages(fx.ocr_words(spark, sf)).select("doc_id", "source_page", "num_lines")


@register("page_renumber", with_ctes(
    "SELECT doc_id, source_page, page_number FROM ocr_pages", ["ocr_pages"]))
def q_page_renumber(spark, sf):
    return O.pages(fx.ocr_words(spark, sf)).select("doc_id", "source_page", "page_number")


@register("doc_full_text", with_ctes(
    "SELECT doc_id, string_agg(raw_text, " + "'\n\n--- Page Break ---\n\n'".replace("\n", "' || chr(10) || '") +
    " ORDER BY page_number) AS full_text FROM ocr_pages GROUP BY doc_id", ["ocr_pages"]))
def q_doc_full_text(spark, sf):
    return O.full_text(O.pages(fx.ocr_words(spark, sf)))


@register("doc_ocr_stats", with_ctes(
    "SELECT doc_id, count(*) AS page_count, avg(confidence) AS avg_confidence, CAST(sum(num_lines) AS BIGINT) AS total_lines "
    "FROM ocr_pages GROUP BY doc_id", ["ocr_pages"]))
def q_doc_ocr_stats(spark, sf):
    return O.ocr_stats(O.pages(fx.ocr_words(spark, sf)))


# ---------------------------------------------------- pipeline / packaging --
from scribeflow.operators import package as P  # noqa: E402
from scribeflow.plans import pipeline as PL  # noqa: E402
from scribeflow.sources.files import split_supported  # noqa: E402


def fixture_dicts(spark: SparkSession) -> PL.Dictionaries:
    return _dicts(spark)


NOTE_STAGES = ["phi_scrubbing", "classification", "extraction", "validation", "summarization", "packaging"]


def pipeline_result(spark: SparkSession, sf: str, stages=None) -> PL.PipelineResult:
    key = (spark.sparkContext.applicationId, sf, tuple(stages or NOTE_STAGES))
    if key not in _PIPE:
        _PIPE[key] = _pipeline(spark, sf, stages)
    return _PIPE[key]


_PIPE: dict = {}


def _pipeline(spark: SparkSession, sf: str, stages=None) -> PL.PipelineResult:
    docs = notes(spark, sf).select("doc_id", "file_name", file_type_of(F.col("file_name")).alias("file_type"),
                        (F.col("doc_id") + 1000).alias("file_size_bytes"), F.col("text").alias("full_text"))
    accepted, _ = split_supported(docs)
    return PL.run(accepted, fixture_dicts(spark), active_stages=stages or NOTE_STAGES,
                  table_rows=trows(spark, sf))


def reports(spark: SparkSession, sf: str) -> DataFrame:
    return pipeline_result(spark, sf).reports


@register("pipeline_compose", with_ctes("""
SELECT doc_id, file_name, processing_status, document_type, classification_confidence, total_validated, valid_count,
       invalid_count, abnormal_count, critical_count, document_summary, key_findings, diagnoses FROM pipe""", ["pipe"]))
def q_pipeline_compose(spark, sf):
    r = reports(spark, sf)
    return r.select("doc_id", "file_name", "processing_status", "document_type", "classification_confidence",
                    "validation_summary.*", "summary.document_summary",
                    _join("summary.key_findings").alias("key_findings"), _join("summary.diagnoses").alias("diagnoses"))


@register("required_input_gate", with_ctes(
    "SELECT doc_id, error_stage, message FROM pipe WHERE error_code = 'PIPELINE_ERROR'", ["pipe"]))
def q_required_input_gate(spark, sf):
    d = pipeline_result(spark, sf).documents
    e = d.select("doc_id", F.explode("errors").alias("e")).where(F.col("e.error_code") == "PIPELINE_ERROR")
    return e.select("doc_id", F.col("e.stage").alias("error_stage"), F.col("e.message").alias("message"))


@register("error_record", with_ctes(
    "SELECT doc_id, error_code, error_stage, true AS recoverable FROM pipe WHERE error_code IS NOT NULL", ["pipe"]))
def q_error_record(spark, sf):
    d = pipeline_result(spark, sf).documents
    e = d.select("doc_id", F.explode("errors").alias("e"))
    return e.select("doc_id", F.col("e.error_code").alias("error_code"), F.col("e.stage").alias("error_stage"),
                    F.col("e.recoverable").alias("recoverable"))


@register("status_route", with_ctes(
    "SELECT processing_status, error_code, CAST(count(*) AS BIGINT) AS n FROM pipe GROUP BY processing_status, error_code",
    ["pipe"]))
def q_status_route(spark, sf):
    d = pipeline_result(spark, sf).documents
    return d.select("status", F.try_element_at("errors", F.lit(1))["error_code"].alias("error_code")).groupBy(
        F.col("status").alias("processing_status"), "error_code").agg(F.count(F.lit(1)).alias("n"))


@register("phi_scrub", with_ctes(
    "SELECT doc_id, length(text) AS n_chars, text AS scrubbed_text FROM cdocs", ["cdocs"]))
def q_phi_scrub(spark, sf):
    from scribeflow.operators.scrub import scrub

    c = cdocs(spark, sf)
    return c.select("doc_id", F.char_length("text").cast("long").alias("n_chars"), scrub(F.col("text")).alias("scrubbed_text"))


@register("entities_by_type", with_ctes("""
SELECT e.doc_id, e.type || 's' AS type_key, CAST(count(*) AS BIGINT) AS n_items, string_agg(e.name, '|' ORDER BY e.seq) AS names
FROM ents e JOIN pipe p ON p.doc_id = e.doc_id AND p.processing_status = 'success'
GROUP BY e.doc_id, e.type""", ["ents", "pipe"]))
def q_entities_by_type(spark, sf):
    r = reports(spark, sf).select("doc_id", F.explode("extracted_entities").alias("type_key", "items"))
    return r.select("doc_id", "type_key", F.size("items").cast("long").alias("n_items"),
                    F.array_join(F.transform("items", lambda x: x["name"]), "|").alias("names"))


@register("report_json", with_ctes("""
SELECT doc_id, file_name, document_type, processing_status, CAST(total_validated AS BIGINT) AS total_validated,
       document_summary FROM pipe""", ["pipe"]))
def q_report_json(spark, sf):
    j = P.report_json(reports(spark, sf))
    g = lambda path: F.get_json_object("json", path)
    return j.select("doc_id", "file_name", g("$.document_type").alias("document_type"),
                    g("$.processing_status").alias("processing_status"),
                    g("$.validation_summary.total_validated").cast("long").alias("total_validated"),
                    g("$.summary.document_summary").alias("document_summary"))


# ------------------------------------------------------------ sources/sinks --
from scribeflow.session import scratch_path  # noqa: E402
from scribeflow.sinks import writers as W  # noqa: E402
from scribeflow.sources.files import ingest  # noqa: E402
from scribeflow.sources.reference import load_reference_json  # noqa: E402

_SUPPORTED_SQL = ", ".join("'" + t + "'" for t in __import__("scribeflow.fixed_values", fromlist=["x"]).SUPPORTED_FILE_TYPES)


@register("ingest_files", with_ctes("SELECT path, file_name, file_type, file_size_bytes, status FROM files_ing", ["files_ing"]))
def q_ingest_files(spark, sf):
    return ingest(fx.files(spark, sf)).drop("doc_id")


@register("ingest_supported_split", with_ctes(
    "SELECT path, file_type IN (" + _SUPPORTED_SQL + ") AS accepted, "
    "CASE WHEN file_type IN (" + _SUPPORTED_SQL + ") THEN NULL ELSE 'Unsupported file type: ' || file_type END AS message "
    "FROM files_ing", ["files_ing"]))
def q_ingest_supported_split(spark, sf):
    acc, rej = split_supported(ingest(fx.files(spark, sf)))
    a = acc.select("path", F.lit(True).alias("accepted"), F.lit(None).cast("string").alias("message"))
    r = rej.select("path", F.lit(False).alias("accepted"), "message")
    return a.unionByName(r)


@register("load_reference_json", with_ctes(
    "SELECT DISTINCT t AS doc_type, lower(trim(p)) AS phrase_lower, CAST(1.0 AS DOUBLE) AS weight, "
    "CAST(len(list_filter(regexp_extract_all(lower(trim(p)), " + PIECE_RE + "), lambda x: x <> ' ')) AS INTEGER) AS n "
    "FROM (SELECT CASE doc_id % 3 WHEN 0 THEN 'lab_report' WHEN 1 THEN 'prescription' ELSE 'patient_history' END AS t, "
    "unnest(string_split(split_part(text, chr(10), 1), ' ; ')) AS p FROM notes WHERE text <> '') WHERE trim(p) <> ''",
    ["notes"]))
def q_load_reference_json(spark, sf):
    # A keyword dictionary derived from the note headers, written as one JSON
    # document and read back through the dictionary loader (rows-only check).
    n = notes(spark, sf).where(F.col("text") != "")
    header = F.substring_index("text", "\n", 1)
    types = F.element_at(F.array(*[F.lit(t) for t in ("lab_report", "prescription", "patient_history")]),
                         (F.col("doc_id") % 3 + 1).cast("int"))
    ph = n.select(types.alias("t"), F.explode(F.split(header, " ; ")).alias("p")).where(F.col("p") != "")
    per_type = ph.groupBy("t").agg(F.array_sort(F.collect_set("p")).alias("keywords"))
    doc = per_type.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct(
        "t", F.struct("keywords", F.array().cast("array<string>").alias("indicators")))))).alias("value"))
    path = scratch_path(spark, "derived_keywords")
    doc.coalesce(1).write.mode("overwrite").text(path)
    loaded = load_reference_json(spark, path)
    return doc_phrase_table(loaded).select("doc_type", "phrase_lower", "weight", "n")


@register("doc_phrase_table", with_ctes("""
SELECT p.doc_type, p.phrase_lower, p.weight, CAST(len(p.toks) AS INTEGER) AS n,
       CAST(count(m.doc_id) AS BIGINT) AS n_hits
FROM phrases p LEFT JOIN pmatch m ON m.doc_type = p.doc_type AND lower(m.span_text) = p.phrase_lower
GROUP BY p.doc_type, p.phrase_lower, p.weight, len(p.toks)""", ["phrases", "pmatch"]))
def q_doc_phrase_table(spark, sf):
    ph = phrases(spark)
    m = pmatches(spark, sf).select("doc_id", F.col("doc_type").alias("_t"), F.lower("span_text").alias("_pl"))
    j = ph.join(m, (ph["doc_type"] == m["_t"]) & (ph["phrase_lower"] == m["_pl"]), "left")
    return j.groupBy("doc_type", "phrase_lower", "weight", "n").agg(F.count("doc_id").alias("n_hits"))


@register("entity_lexicon_table", with_ctes("""
SELECT x.label, x.term, CAST(x.n AS INTEGER) AS n, CAST(count(m.doc_id) AS BIGINT) AS n_hits
FROM lexicon x LEFT JOIN ematch m ON m.label = x.label AND lower(m.span_text) = lower(x.term)
GROUP BY x.label, x.term, x.n""", ["lexicon", "ematch"]))
def q_entity_lexicon_table(spark, sf):
    lx = lexicon(spark)
    h = X.gazetteer_hits(cdocs(spark, sf), lx).select("doc_id", F.col("label").alias("_l"), F.lower("span_text").alias("_s"))
    j = lx.join(h, (lx["label"] == h["_l"]) & (F.lower(lx["term"]) == h["_s"]), "left")
    return j.groupBy("label", "term", "n").agg(F.count("doc_id").alias("n_hits"))


@register("rule_range_table", with_ctes("""
SELECT r.section, r.key, CAST(r.range_ord AS INTEGER) AS range_ord, r.status, r.lo, r.hi, r.lo_text, r.hi_text, r.reason,
       CAST(count(f.doc_id) AS BIGINT) AS n_findings
FROM rule_ranges r LEFT JOIN findings f
  ON replace(lower(trim(f.test_name)), ' ', '_') = r.key AND f.status = r.status AND f.reason = r.reason
GROUP BY r.section, r.key, r.range_ord, r.status, r.lo, r.hi, r.lo_text, r.hi_text, r.reason""", ["rule_ranges", "findings"]))
def q_rule_range_table(spark, sf):
    from scribeflow.functions.text import normalize_key

    _, rr, _ = rules(spark)
    f = finds(spark, sf).select("doc_id", normalize_key("test_name").alias("_k"), F.col("status").alias("_s"),
                                F.col("reason").alias("_r"))
    j = rr.join(f, (rr["key"] == f["_k"]) & (rr["status"] == f["_s"]) & (rr["reason"] == f["_r"]), "left")
    return j.groupBy("section", "key", F.col("range_ord").cast("int").alias("range_ord"), "status", "lo", "hi",
                     "lo_text", "hi_text", "reason").agg(F.count("doc_id").alias("n_findings"))


@register("layman_table", with_ctes("""
SELECT l.section, l.key, l.layman, l.explanation, CAST(count(x.doc_id) AS BIGINT) AS n_used
FROM layman l LEFT JOIN diag_x x
  ON l.section = 'medical_to_layman' AND l.key = replace(lower(split_part(x.diagnosis, ' (', 1)), ' ', '_')
GROUP BY l.section, l.key, l.layman, l.explanation""", ["layman", "diag_x"]))
def q_layman_table(spark, sf):
    lt = layman(spark)
    s = summaries(spark, sf).select("doc_id", F.explode("diagnoses").alias("dg"))
    s = s.select("doc_id", S.diagnosis_key(F.col("dg")).alias("_k"))
    j = lt.join(s, (lt["section"] == "medical_to_layman") & (lt["key"] == s["_k"]), "left")
    return j.groupBy("section", "key", "layman", "explanation").agg(F.count("doc_id").alias("n_used"))


@register("table_cells_source", with_ctes("""
SELECT doc_id, page_number, table_index, CAST(count(*) AS INTEGER) AS row_count, CAST(max(n_cells) AS INTEGER) AS col_count
FROM table_rows GROUP BY doc_id, page_number, table_index""", ["table_rows"]))
def q_table_cells_source(spark, sf):
    t = X.table_rows_from_tables(fx.pdf_tables(spark, sf))
    return t.select("doc_id", "page_number", "table_index", "row_count", "col_count").distinct()


@register("csv_header_union", with_ctes("SELECT doc_id, col_pos, key FROM csv_keys", ["csv_keys"]))
def q_csv_header_union(spark, sf):
    e = entities(spark, sf)
    value = F.when(F.col("value_num").isNotNull(), F.lit("v")).otherwise(F.col("value_text"))
    rec = F.map_filter(F.create_map(F.lit("name"), F.col("name"), F.lit("value"), value, F.lit("unit"), F.col("unit"),
                                    F.lit("page"), F.col("page").cast("string")), lambda k, v: v.isNotNull())
    r = e.select("doc_id", "seq", rec.alias("record"))
    return W.record_keys(r, "record", ["seq"], by=["doc_id"]).select("doc_id", F.col("col_pos").cast("int"), "key")


@register("sink_json", with_ctes(
    "SELECT doc_id, file_name, document_type, processing_status FROM pipe", ["pipe"]))
def q_sink_json(spark, sf):
    path = W.write_json(reports(spark, sf), scratch_path(spark, "reports_json"))
    return spark.read.json(path).select("doc_id", "file_name", "document_type", "processing_status")


@register("sink_csv", with_ctes("""
SELECT CAST(e.doc_id AS VARCHAR) AS doc_id, CAST(e.seq AS VARCHAR) AS seq, e.name,
  nullif(coalesce(CAST(e.value_num AS VARCHAR), e.value_text), '') AS value, nullif(e.unit, '') AS unit,
  CASE WHEN e.src_rank = 0 THEN '0.98' ELSE '0.9' END AS confidence,
  CASE WHEN e.src_rank = 0 THEN 'pdf_table' ELSE 'text_ruler' END AS source
FROM ents e JOIN pipe p ON p.doc_id = e.doc_id AND p.processing_status = 'success'""", ["ents", "pipe"]))
def q_sink_csv(spark, sf):
    e = pipeline_result(spark, sf).entities
    flat = W.flatten_records(W.entity_records(e), "record", ["doc_id", "seq"])
    path = W.write_csv(flat, scratch_path(spark, "entities_csv"))
    return spark.read.option("header", True).csv(path)


_cte("rtext", ["pipe", "summary"], """SELECT p.doc_id, p.file_name, p.processing_status, trim(
  repeat('=', 80) || chr(10) || p.document_summary || chr(10) || repeat('=', 80) || chr(10) || chr(10) || chr(10) || 'KEY FINDINGS:' ||
  CASE WHEN p.key_findings = '' THEN '' ELSE chr(10) || '  • ' || replace(p.key_findings, '|', chr(10) || '  • ') END || chr(10) || chr(10) ||
  'POTENTIAL DIAGNOSES:' || CASE WHEN p.diagnoses = '' THEN '' ELSE chr(10) || '  • ' || replace(p.diagnoses, '|', chr(10) || '  • ') END || chr(10) ||
  chr(10) || 'PATIENT-FRIENDLY EXPLANATION:' || chr(10) ||
  CASE WHEN p.processing_status = 'success' THEN s.layman_explanation ELSE '' END || chr(10), chr(10) || ' ') || chr(10) AS summary_text
FROM pipe p LEFT JOIN summary s ON s.doc_id = p.doc_id""")


@register("sink_text", with_ctes("SELECT doc_id, file_name, summary_text FROM rtext", ["rtext"]))
def q_sink_text(spark, sf):
    path = W.write_summaries(W.report_texts(reports(spark, sf)), scratch_path(spark, "summary_text"))
    return spark.read.json(path).select("doc_id", "file_name", "summary_text")


@register("sink_report_bundle", with_ctes("""
SELECT 'json' AS format, doc_id, processing_status AS told, 1 AS n FROM pipe
UNION ALL SELECT 'summary', doc_id, summary_text, 1 FROM rtext
UNION ALL SELECT 'csv', e.doc_id, string_agg(e.name, '|' ORDER BY e.seq), count(*) FROM ents e
  JOIN pipe p ON p.doc_id = e.doc_id AND p.processing_status = 'success' GROUP BY e.doc_id""", ["pipe", "rtext", "ents"]))
def q_sink_report_bundle(spark, sf):
    """All parts of the bundle, read back."""
    res = pipeline_result(spark, sf)
    out = W.write_report_bundle(res.reports, scratch_path(spark, "bundle"), entities_list=res.entities, compression="gzip")
    j = spark.read.json(out["json"]).select(F.lit("json").alias("format"), "doc_id", F.col("processing_status").alias("told"), F.lit(1).cast("long").alias("n"))
    t = spark.read.json(out["summary"]).select(F.lit("summary").alias("format"), "doc_id", F.col("summary_text").alias("told"), F.lit(1).cast("long").alias("n"))
    c = spark.read.option("header", True).csv(out["csv"]).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.array_sort(F.collect_list(F.struct(F.col("seq").cast("int"), "name"))).alias("names"), F.count("*").alias("n"))
    c = c.select(F.lit("csv").alias("format"), "doc_id", _join(F.transform("names", lambda x: x["name"])).alias("told"), "n")
    return j.unionByName(t).unionByName(c)


# --------------------------------------------------------------- streaming --
@register("stream_pipeline", with_ctes(
    "SELECT doc_id, file_name, processing_status, document_type FROM pipe", ["pipe"]))
def q_stream_pipeline(spark, sf):
    """Notes arrive as parquet files; the stream reports them batch by batch
    (rows-only check: one report per accepted note)."""
    from scribeflow.streaming.stream import document_stream, start_report_stream

    src = scratch_path(spark, "stream_in")
    out = scratch_path(spark, "stream_out")
    docs = notes(spark, sf).select("doc_id", "file_name", file_type_of(F.col("file_name")).alias("file_type"),
                                   (F.col("doc_id") + 1000).alias("file_size_bytes"), F.col("text").alias("full_text"))
    accepted, _ = split_supported(docs)
    accepted.repartition(4).write.parquet(src)
    q = start_report_stream(document_stream(spark, src, max_files_per_trigger=2), fixture_dicts(spark), out,
                            checkpoint=scratch_path(spark, "stream_ckpt"), available_now=True)
    q.awaitTermination()
    return spark.read.parquet(out).select("doc_id", "file_name", "processing_status", "document_type")


@register("pipeline_ocr", with_ctes(
    "SELECT doc_id, file_name, processing_status, document_type, classification_confidence, total_validated "
    "FROM pipe_o", ["pipe_o"]))
def q_pipeline_ocr(spark, sf):
    """The default stage list end to end: word tables (derived from the notes
    text by the OCR fixture rule) -> page text -> scrub -> classify ->
    extract -> validate -> summarize -> reports."""
    n = notes(spark, sf)
    d = n.select("doc_id", F.concat(F.lit("scan_"), F.col("doc_id").cast("string"), F.lit(".png")).alias("file_name"),
                 F.lit(".png").alias("file_type"), F.char_length("text").cast("long").alias("file_size_bytes"))
    # dealt by document before words are made of them, so that no word is shuffled
    t = n.select("doc_id", "text")
    words = fx.ocr_words_from(t.repartition(fx.parts(t.agg(F.sum(F.octet_length("text").cast("long"))).first()[0]), "doc_id"))
    res = PL.run(d, fixture_dicts(spark), active_stages=PL.DEFAULT_STAGES, ocr_words=words)
    return res.reports.select("doc_id", "file_name", "processing_status", "document_type",
                              "classification_confidence", "validation_summary.total_validated")

# Modules that register further queries with the helpers above.
from scribeflow.plans import arrival_queries, store_queries, timeline_queries  # noqa: E402,F401
