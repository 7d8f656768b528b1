"""DuckDB oracle SQL, assembled from named CTEs.

Each registered query has an independent SQL formulation (window functions,
``string_agg ... ORDER BY``, ``lead``) over the same fixture views, written
from the semantics rather than from the Spark plan.  ``with_ctes`` prepends the
CTEs a final SELECT needs, in dependency order.
"""

from __future__ import annotations

from scribeflow.functions.text import PIECE_PATTERN
from scribeflow.sources import fixtures as fx

CTES: dict[str, tuple[list[str], str]] = dict(fx.SQL)


def cte(name: str, deps: list[str], sql: str) -> None:
    CTES[name] = (deps, sql)


def with_ctes(final: str, needs: list[str]) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in needs:
        visit(n)
    parts = [f"{n} AS ({CTES[n][1].strip()})" for n in order]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + final.strip()


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


PIECE_RE = _sql_str(PIECE_PATTERN)

# --- documents that pass the classification gate (non-empty text) ----------
cte("cdocs", ["notes"], "SELECT doc_id, file_name, text FROM notes WHERE text <> ''")

# --- tokens: pieces, tokens with piece index, next three tokens ------------
cte("pieces", ["cdocs"], f"""
SELECT doc_id, generate_subscripts(ps, 1) - 1 AS pidx, unnest(ps) AS piece
FROM (SELECT doc_id, regexp_extract_all(text, {PIECE_RE}) AS ps FROM cdocs)""")
cte("toks", ["pieces"], """
SELECT doc_id, pidx, piece AS tok, lower(piece) AS tl,
       row_number() OVER (PARTITION BY doc_id ORDER BY pidx) - 1 AS pos
FROM pieces WHERE piece <> ' '""")
cte("tokw", ["toks"], """
SELECT doc_id, pos, pidx, tok, tl,
  lead(tl, 1) OVER w AS tl1, lead(tl, 2) OVER w AS tl2, lead(tl, 3) OVER w AS tl3,
  lead(tok, 1) OVER w AS tk1, lead(tok, 2) OVER w AS tk2, lead(tok, 3) OVER w AS tk3,
  lead(pidx, 1) OVER w AS pi1, lead(pidx, 2) OVER w AS pi2, lead(pidx, 3) OVER w AS pi3
FROM toks WINDOW w AS (PARTITION BY doc_id ORDER BY pos)""")

# --- phrase table from the fixture phrases ----------------------------------
cte("phrases", ["phr"], f"""
SELECT doc_type, t AS type_ord, lower(trim(phrase)) AS phrase_lower, max(weight) AS weight,
       list_filter(regexp_extract_all(lower(trim(phrase)), {PIECE_RE}), lambda x: x <> ' ') AS toks
FROM phr GROUP BY doc_type, t, lower(trim(phrase))""")
cte("phrase_dict", ["phrases"], "SELECT DISTINCT doc_type, type_ord, toks, len(toks) AS n FROM phrases")
cte("type_totals", ["phrases"], "SELECT doc_type, type_ord, sum(weight) AS total FROM phrases GROUP BY doc_type, type_ord")


def _span(n_col: str) -> str:
    g1 = "(CASE WHEN pi1 - pidx = 2 THEN ' ' ELSE '' END) || tk1"
    g2 = "(CASE WHEN pi2 - pi1 = 2 THEN ' ' ELSE '' END) || tk2"
    g3 = "(CASE WHEN pi3 - pi2 = 2 THEN ' ' ELSE '' END) || tk3"
    return (f"tok || (CASE WHEN {n_col} >= 2 THEN {g1} ELSE '' END)"
            f" || (CASE WHEN {n_col} >= 3 THEN {g2} ELSE '' END)"
            f" || (CASE WHEN {n_col} >= 4 THEN {g3} ELSE '' END)")


cte("pmatch_raw", ["tokw", "phrase_dict"], f"""
SELECT w.doc_id, w.pos, w.pidx, p.doc_type, p.type_ord, p.n, {_span('p.n')} AS span_text
FROM tokw w JOIN phrase_dict p
  ON w.tl = p.toks[1] AND (p.n < 2 OR w.tl1 = p.toks[2]) AND (p.n < 3 OR w.tl2 = p.toks[3]) AND (p.n < 4 OR w.tl3 = p.toks[4])""")
cte("pmatch", ["pmatch_raw", "phrases"], """
SELECT m.doc_id, m.pos, m.doc_type, m.type_ord, m.span_text, coalesce(p.weight, CAST(1.0 AS DOUBLE)) AS weight
FROM pmatch_raw m LEFT JOIN phrases p ON p.doc_type = m.doc_type AND p.phrase_lower = lower(m.span_text)""")
cte("kscores", ["pmatch"], """
SELECT doc_id, doc_type, type_ord, sum(weight) AS score,
       array_to_string(list_sort(list_distinct(list(span_text))), '|') AS keywords
FROM pmatch GROUP BY doc_id, doc_type, type_ord""")
cte("nscores", ["kscores", "type_totals"], """
SELECT k.*, t.total, CASE WHEN t.total > 0 THEN k.score / t.total ELSE CAST(0.0 AS DOUBLE) END AS norm
FROM kscores k JOIN type_totals t USING (doc_type, type_ord)""")
cte("best", ["nscores"], """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY norm DESC, type_ord) AS rn FROM nscores) WHERE rn = 1""")
cte("classification", ["cdocs", "best"], """
SELECT d.doc_id,
  CASE WHEN b.doc_id IS NULL OR b.norm < 0.5 THEN 'unknown' ELSE b.doc_type END AS document_type,
  coalesce(b.norm, CAST(0.0 AS DOUBLE)) AS confidence,
  CASE WHEN b.doc_id IS NULL OR b.norm < 0.5 THEN '' ELSE b.keywords END AS keywords,
  coalesce(b.norm >= 0.5 AND b.norm > 1.0, false) AS over_one
FROM cdocs d LEFT JOIN best b ON b.doc_id = d.doc_id""")

# --- entity extraction --------------------------------------------------------
from scribeflow import fixed_values as _fv  # noqa: E402

VALUE_RE = _sql_str("(?i)" + _fv.VALUE_PATTERN)

cte("lexicon", ["lex"], """
SELECT label, term, string_split(lower(trim(term)), ' ') AS toks, len(string_split(lower(trim(term)), ' ')) AS n
FROM lex WHERE label <> 'none'""")
cte("poff", ["pieces"], """
SELECT doc_id, pidx, CAST(sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY pidx) - length(piece) AS BIGINT) AS start_char FROM pieces""")
cte("ematch", ["tokw", "lexicon", "poff"], f"""
SELECT w.doc_id, w.pos, x.label, x.n, {_span('x.n')} AS span_text, o.start_char
FROM tokw w JOIN lexicon x
  ON w.tl = x.toks[1] AND (x.n < 2 OR w.tl1 = x.toks[2]) AND (x.n < 3 OR w.tl2 = x.toks[3])
JOIN (SELECT doc_id AS o_doc, pidx AS o_pidx, start_char FROM poff) o ON o.o_doc = w.doc_id AND o.o_pidx = w.pidx""")
cte("text_ents_raw", ["ematch", "cdocs"], """
SELECT m.doc_id, m.pos, m.label, m.span_text, CAST(m.start_char AS BIGINT) AS start_char,
       CAST(m.start_char + length(m.span_text) AS BIGINT) AS end_char,
       CASE WHEN m.label IN ('test_result', 'vital_sign', 'medication')
            THEN substring(d.text, m.start_char + length(m.span_text) + 1, 50) END AS after
FROM ematch m JOIN cdocs d USING (doc_id)""")
cte("text_ents", ["text_ents_raw"], f"""
SELECT doc_id, pos, label AS type, span_text AS name, start_char, end_char,
       CASE WHEN yr THEN NULL ELSE v END AS value_text, CASE WHEN yr THEN NULL ELSE u END AS unit
FROM (SELECT *, coalesce(TRY_CAST(v AS DOUBLE) > 1900 AND TRY_CAST(v AS DOUBLE) < 2100, false) AS yr
      FROM (SELECT *, nullif(regexp_extract(after, {VALUE_RE}, 1), '') AS v,
                      nullif(regexp_extract(after, {VALUE_RE}, 2), '') AS u FROM text_ents_raw))""")
cte("pdf_docs", ["notes"], """
SELECT doc_id FROM notes
WHERE lower(CASE WHEN strpos(file_name, '.') > 0 THEN regexp_extract(file_name, '(\\.[^.]*)$', 1) ELSE '' END) = '.pdf'""")
cte("tab_ents", ["table_rows", "lex", "pdf_docs"], """
SELECT doc_id, 'test_result' AS type, name, CASE WHEN vn IS NULL THEN vs END AS value_text, vn AS value_num, unit,
       page_number AS page, (CAST(page_number AS BIGINT) * 1000000 + table_index) * 1000000 + row_index AS pos
FROM (SELECT *, CASE WHEN c0 IS NULL OR c0 = '' THEN '' ELSE trim(c0) END AS name,
             CASE WHEN c1 IS NULL OR c1 = '' THEN '' ELSE trim(c1) END AS vs,
             TRY_CAST(CASE WHEN c1 IS NULL OR c1 = '' THEN '' ELSE trim(c1) END AS DOUBLE) AS vn,
             CASE WHEN n_cells > 2 AND c2 IS NOT NULL AND c2 <> '' THEN trim(c2) END AS unit
      FROM table_rows WHERE n_cells >= 2)
WHERE lower(name) IN (SELECT lower(term) FROM lex WHERE label = 'test_result')
  AND doc_id IN (SELECT doc_id FROM pdf_docs)""")
cte("ents_u", ["tab_ents", "text_ents", "cdocs"], """
SELECT doc_id, 0 AS src_rank, type, name, value_text, value_num, unit, page, pos FROM tab_ents
WHERE doc_id IN (SELECT doc_id FROM cdocs)
UNION ALL
SELECT doc_id, 1 AS src_rank, type, name, value_text, CAST(NULL AS DOUBLE), unit, CAST(NULL AS INTEGER), pos FROM text_ents""")
cte("ents", ["ents_u"], """
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY f_rank, f_pos) - 1 AS INTEGER) AS seq,
       type, name, value_text, value_num, unit, page, src_rank
FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, type, lower(name)
                                   ORDER BY src_rank, CASE WHEN src_rank = 0 THEN -pos ELSE pos END) AS w,
                first_value(src_rank) OVER (PARTITION BY doc_id, type, lower(name) ORDER BY src_rank, pos) AS f_rank,
                first_value(pos) OVER (PARTITION BY doc_id, type, lower(name) ORDER BY src_rank, pos) AS f_pos
      FROM ents_u) WHERE w = 1""")

# --- validation ---------------------------------------------------------------
cte("rlook", ["rule_ranges", "rule_aliases"], """
SELECT section, match_key, rule_key FROM (
  SELECT *, row_number() OVER (PARTITION BY section, match_key ORDER BY rank, rule_ord) AS rn FROM (
    SELECT DISTINCT section, key AS match_key, 0 AS rank, rule_ord, key AS rule_key FROM rule_ranges
    UNION ALL SELECT section, alias_norm, 1, rule_ord, key FROM rule_aliases)) WHERE rn = 1""")
cte("ents_k", ["ents", "rule_ranges", "rlook"], """
SELECT e.*, s.section, l.rule_key
FROM (SELECT *, replace(lower(trim(name)), ' ', '_') AS key_norm,
             CASE type WHEN 'test_result' THEN 'blood_tests' WHEN 'vital_sign' THEN 'vital_signs' END AS sec FROM ents) e
LEFT JOIN (SELECT DISTINCT section FROM rule_ranges) s ON s.section = e.sec
LEFT JOIN rlook l ON l.section = s.section AND l.match_key = e.key_norm""")
cte("fbest", ["ents_k", "rule_ranges"], """
SELECT doc_id, seq, status, reason FROM (
  SELECT e.doc_id, e.seq, r.status, r.reason,
         row_number() OVER (PARTITION BY e.doc_id, e.seq
                            ORDER BY CASE r.status WHEN 'critical' THEN 0 WHEN 'abnormal' THEN 1 ELSE 2 END, r.range_ord) AS rn
  FROM ents_k e JOIN rule_ranges r ON r.section = e.section AND r.key = e.rule_key
  WHERE e.value_num IS NOT NULL AND r.status IN ('critical', 'abnormal', 'normal')
    AND (r.lo IS NULL OR e.value_num >= r.lo) AND (r.hi IS NULL OR e.value_num < r.hi)) WHERE rn = 1""")
cte("normal_ranges", ["rule_ranges"], """
SELECT section, key, arg_min(lo_text || ' - ' || hi_text, range_ord) AS normal_range
FROM rule_ranges WHERE status = 'normal' GROUP BY section, key""")
cte("findings", ["ents_k", "fbest", "normal_ranges"], f"""
SELECT e.doc_id, e.seq, e.type, e.name AS test_name, e.value_text, e.value_num, e.unit,
  CASE WHEN e.value_num IS NULL OR e.section IS NULL OR e.rule_key IS NULL OR b.status IS NULL THEN 'unknown' ELSE b.status END AS status,
  CASE WHEN e.value_num IS NULL THEN '{_fv.REASON_NON_NUMERIC}'
       WHEN e.section IS NULL THEN '{_fv.REASON_NO_RULESET}'
       WHEN e.rule_key IS NULL THEN '{_fv.REASON_NOT_FOUND}'
       WHEN b.status IS NULL THEN '{_fv.REASON_NO_RANGE}' ELSE b.reason END AS reason,
  CASE WHEN b.status IS NOT NULL THEN coalesce(n.normal_range, 'N/A') END AS reference_range
FROM ents_k e LEFT JOIN fbest b ON b.doc_id = e.doc_id AND b.seq = e.seq
LEFT JOIN normal_ranges n ON n.section = e.section AND n.key = e.rule_key""")
cte("vreport", ["cdocs", "findings"], """
SELECT d.doc_id,
  CAST(count(f.seq) AS BIGINT) AS total_validated,
  CAST(count(f.seq) FILTER (WHERE f.status IN ('normal', 'unknown')) AS BIGINT) AS valid_count,
  CAST(count(f.seq) FILTER (WHERE f.status IN ('critical', 'abnormal')) AS BIGINT) AS invalid_count,
  CAST(count(f.seq) FILTER (WHERE f.status = 'abnormal') AS BIGINT) AS abnormal_count,
  CAST(count(f.seq) FILTER (WHERE f.status = 'critical') AS BIGINT) AS critical_count,
  coalesce(string_agg(f.test_name, '|' ORDER BY f.seq) FILTER (WHERE f.status = 'critical'), '') AS critical_names,
  coalesce(string_agg(f.test_name, '|' ORDER BY f.seq) FILTER (WHERE f.status = 'abnormal'), '') AS abnormal_names
FROM cdocs d LEFT JOIN findings f USING (doc_id) GROUP BY d.doc_id""")

# --- summaries ------------------------------------------------------------------
def _layman_rows():
    rows = []
    for k, (m, l, e) in _fv.MEDICAL_TO_LAYMAN.items():
        rows.append(("medical_to_layman", k, m, l, e))
    for k, (m, l, e) in _fv.TEST_RESULT_TEMPLATES.items():
        rows.append(("test_results", k, m, l, e))
    return rows


cte("layman", [], "SELECT * FROM " + fx._values(_layman_rows(), ["section", "key", "medical", "layman", "explanation"]))
cte("meds", ["ents"], f"""
SELECT doc_id, seq, name,
  CASE WHEN value_num IS NOT NULL AND value_num <> 0 THEN CAST(value_num AS VARCHAR)
       WHEN value_num IS NULL AND value_text <> '' THEN value_text ELSE '{_fv.NOT_SPECIFIED}' END AS dosage,
  nullif(unit, '') AS unit, '{_fv.AS_PRESCRIBED}' AS frequency
FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, lower(trim(name)) ORDER BY seq) AS rn FROM ents WHERE type = 'medication')
WHERE rn = 1""")
cte("eroll", ["cdocs", "ents", "meds"], """
SELECT d.doc_id,
  (SELECT count(*) FROM ents e WHERE e.doc_id = d.doc_id AND e.type = 'test_result') AS test_count,
  (SELECT count(*) FROM ents e WHERE e.doc_id = d.doc_id AND e.type = 'vital_sign') AS vital_count,
  (SELECT count(*) FROM meds m WHERE m.doc_id = d.doc_id) AS med_count,
  (SELECT string_agg(m.name, ', ' ORDER BY m.seq) FROM meds m WHERE m.doc_id = d.doc_id) AS med_names
FROM cdocs d""")
_rule_case = "CASE " + " ".join(
    f"WHEN contains(lower(test_name), '{n}') AND contains(lower(coalesce(reason, '')), '{r}') THEN '{lab}'"
    for n, r, lab in _fv.DIAGNOSIS_RULES) + " END"
cte("abn", ["findings"], f"""
SELECT *, CASE status WHEN 'critical' THEN 0 ELSE 1 END AS srank, {_rule_case} AS rule_diag
FROM findings WHERE status IN ('critical', 'abnormal')""")
cte("diag_rows", ["abn", "ents"], """
SELECT DISTINCT doc_id, diagnosis FROM (
  SELECT doc_id, rule_diag AS diagnosis FROM abn WHERE rule_diag IS NOT NULL
  UNION ALL
  SELECT doc_id, array_to_string(list_transform(string_split(lower(name), ' '), lambda w: upper(w[1]) || w[2:]), ' ')
  FROM ents WHERE type = 'condition')""")
cte("diag_x", ["diag_rows", "layman"], """
SELECT r.doc_id, r.diagnosis, coalesce(l.layman || ': ' || l.explanation, r.diagnosis) AS expl
FROM diag_rows r LEFT JOIN layman l
  ON l.section = 'medical_to_layman' AND l.key = replace(lower(split_part(r.diagnosis, ' (', 1)), ' ', '_')""")
cte("diags", ["diag_x"], """
SELECT doc_id, string_agg(diagnosis, '|' ORDER BY diagnosis) AS diagnoses,
       string_agg(expl, ' ' ORDER BY diagnosis) AS health
FROM diag_x GROUP BY doc_id""")
cte("kf", ["abn"], """
SELECT doc_id, string_agg(
  (CASE status WHEN 'critical' THEN 'CRITICAL: ' ELSE 'ABNORMAL: ' END) || test_name || ' = ' ||
  CAST(value_num AS VARCHAR) || coalesce(' ' || nullif(unit, ''), '') || ' (' || coalesce(reason, 'None') || ')',
  '|' ORDER BY srank, seq) AS key_findings,
  count(*) FILTER (WHERE status = 'critical') AS n_crit, count(*) FILTER (WHERE status = 'abnormal') AS n_abn
FROM abn GROUP BY doc_id""")
cte("summary", ["cdocs", "classification", "eroll", "kf", "diags", "layman"], """
SELECT d.doc_id,
  'Report: ' || d.file_name || chr(10) ||
  'Type: ' || c.document_type || ' (confidence: ' ||
     CAST(CAST(CASE WHEN c.confidence * 100 - floor(c.confidence * 100) = 0.5
                    THEN CASE WHEN CAST(floor(c.confidence * 100) AS BIGINT) % 2 = 0 THEN floor(c.confidence * 100)
                              ELSE floor(c.confidence * 100) + 1 END
                    ELSE round(c.confidence * 100) END AS BIGINT) AS VARCHAR) || '%)' ||
  CASE WHEN r.test_count + r.vital_count + r.med_count > 0 THEN chr(10) || 'Data extracted: ' ||
    array_to_string(list_filter([
      CASE WHEN r.test_count > 0 THEN CAST(r.test_count AS VARCHAR) || ' test result(s)' END,
      CASE WHEN r.vital_count > 0 THEN CAST(r.vital_count AS VARCHAR) || ' vital sign(s)' END,
      CASE WHEN r.med_count > 0 THEN CAST(r.med_count AS VARCHAR) || ' medication(s)' END], lambda x: x IS NOT NULL), ', ')
    ELSE '' END ||
  CASE WHEN coalesce(k.n_crit, 0) > 0 THEN chr(10) || 'Critical findings: ' || CAST(k.n_crit AS VARCHAR) || ' value(s) requiring immediate attention' ELSE '' END ||
  CASE WHEN coalesce(k.n_abn, 0) > 0 THEN chr(10) || 'Abnormal findings: ' || CAST(k.n_abn AS VARCHAR) || ' value(s)' ELSE '' END ||
  CASE WHEN coalesce(k.n_crit, 0) = 0 AND coalesce(k.n_abn, 0) = 0 THEN chr(10) || 'All validated findings are within normal ranges' ELSE '' END
  AS document_summary,
  coalesce(k.key_findings, 'All findings within normal limits') AS key_findings,
  coalesce(g.diagnoses, '') AS diagnoses,
  (SELECT explanation FROM layman WHERE section = 'test_results' AND key =
     CASE WHEN coalesce(k.n_crit, 0) > 0 THEN 'critical' WHEN coalesce(k.n_abn, 0) > 0 THEN 'abnormal' ELSE 'normal' END)
  || CASE WHEN r.med_count > 0 THEN chr(10) || chr(10) || 'Current medications mentioned in the report: ' || r.med_names || '.' ELSE '' END
  || CASE WHEN g.health IS NOT NULL THEN chr(10) || chr(10) || 'Health findings: ' || g.health ELSE '' END
  AS layman_explanation,
  g.health
FROM cdocs d JOIN classification c USING (doc_id) JOIN eroll r USING (doc_id)
LEFT JOIN kf k USING (doc_id) LEFT JOIN diags g USING (doc_id)""")

# --- OCR word tables --------------------------------------------------------------
from scribeflow.functions.text import PY_WS as _PY_WS  # noqa: E402

_STRIP = _sql_str(f"^{_PY_WS}+|{_PY_WS}+$")
cte("ocr_kept", ["ocr_words"], f"""
SELECT * FROM (SELECT *, regexp_replace(text, {_STRIP}, '', 'g') AS word FROM ocr_words) WHERE word <> ''""")
cte("ocr_seg", ["ocr_kept"], """
SELECT *, sum(CASE WHEN new_line THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, page_number ORDER BY seq
                                                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS line_id
FROM (SELECT *, (pb IS NULL OR pb <> block_num OR pp <> par_num OR pl <> line_num) AS new_line,
                (pb IS NULL OR pb <> block_num OR pp <> par_num) AS new_par
      FROM (SELECT *, lag(block_num) OVER w AS pb, lag(par_num) OVER w AS pp, lag(line_num) OVER w AS pl
            FROM ocr_kept WINDOW w AS (PARTITION BY doc_id, page_number ORDER BY seq)))""")
cte("ocr_tlines", ["ocr_seg"], """
SELECT doc_id, page_number, line_id, string_agg(word, ' ' ORDER BY seq) AS line, arg_min(new_par, seq) AS new_par
FROM ocr_seg GROUP BY doc_id, page_number, line_id""")
cte("ocr_ptext", ["ocr_tlines"], f"""
SELECT doc_id, page_number, regexp_replace(string_agg(
    (CASE WHEN line_id = 1 THEN '' WHEN new_par THEN chr(10) || chr(10) ELSE chr(10) END) || line, '' ORDER BY line_id),
  {_STRIP}, '', 'g') AS raw_text
FROM ocr_tlines GROUP BY doc_id, page_number""")
cte("ocr_pstats", ["ocr_words"], f"""
SELECT doc_id, page_number,
  coalesce(least(avg(c) FILTER (WHERE c > 0) / 100.0, 1.0), 0.0) AS conf_mean,
  count(DISTINCT CASE WHEN block_num > 0 THEN (block_num, par_num, line_num) END) AS n_lines
FROM (SELECT *, TRY_CAST(regexp_replace(conf, {_STRIP}, '', 'g') AS DOUBLE) AS c FROM ocr_words)
GROUP BY doc_id, page_number""")
cte("ocr_pages", ["ocr_pstats", "ocr_ptext"], """
SELECT s.doc_id, CAST(row_number() OVER (PARTITION BY s.doc_id ORDER BY s.page_number) AS INTEGER) AS page_number,
  s.page_number AS source_page, coalesce(t.raw_text, '') AS raw_text,
  CASE WHEN coalesce(t.raw_text, '') = '' THEN 0.0 ELSE s.conf_mean END AS confidence,
  CAST(CASE WHEN coalesce(t.raw_text, '') = '' THEN 0 ELSE s.n_lines END AS INTEGER) AS num_lines
FROM ocr_pstats s LEFT JOIN ocr_ptext t USING (doc_id, page_number)""")

# --- pipeline composition, packaging ------------------------------------------------
_SUPPORTED = ", ".join(_sql_str(t) for t in _fv.SUPPORTED_FILE_TYPES)
cte("acc", ["notes"], f"""
SELECT * FROM (SELECT n.*, lower(CASE WHEN strpos(file_name, '.') > 0 THEN regexp_extract(file_name, '(\\.[^.]*)$', 1) ELSE '' END) AS file_type
               FROM notes n) WHERE file_type IN ({_SUPPORTED})""")
cte("pipe", ["acc", "classification", "vreport", "summary"], """
SELECT a.doc_id, a.file_name, e.error_code,
  CASE WHEN e.error_code IS NULL THEN 'success' ELSE 'failed' END AS processing_status,
  CASE WHEN e.error_code IS NULL THEN c.document_type ELSE 'unknown' END AS document_type,
  CASE WHEN e.error_code IS NULL THEN c.confidence ELSE CAST(0.0 AS DOUBLE) END AS classification_confidence,
  CASE WHEN e.error_code IS NULL THEN v.total_validated ELSE 0 END AS total_validated,
  CASE WHEN e.error_code IS NULL THEN v.valid_count ELSE 0 END AS valid_count,
  CASE WHEN e.error_code IS NULL THEN v.invalid_count ELSE 0 END AS invalid_count,
  CASE WHEN e.error_code IS NULL THEN v.abnormal_count ELSE 0 END AS abnormal_count,
  CASE WHEN e.error_code IS NULL THEN v.critical_count ELSE 0 END AS critical_count,
  CASE WHEN e.error_code IS NULL THEN s.document_summary ELSE '' END AS document_summary,
  CASE WHEN e.error_code IS NULL THEN s.key_findings ELSE '' END AS key_findings,
  CASE WHEN e.error_code IS NULL THEN s.diagnoses ELSE '' END AS diagnoses,
  e.error_stage, e.message
FROM acc a
LEFT JOIN classification c USING (doc_id)
LEFT JOIN vreport v USING (doc_id)
LEFT JOIN summary s USING (doc_id)
LEFT JOIN (
  SELECT a2.doc_id,
    CASE WHEN a2.text = '' THEN 'PIPELINE_ERROR' WHEN c2.over_one THEN 'CLASSIFICATION_ERROR' END AS error_code,
    CASE WHEN a2.text = '' OR c2.over_one THEN 'ClassificationStage' END AS error_stage,
    CASE WHEN a2.text = '' THEN 'Stage ''ClassificationStage'' missing required input: Required field ''scrubbed_text'' is empty' END AS message
  FROM acc a2 LEFT JOIN classification c2 USING (doc_id)) e USING (doc_id)""")

# --- sources / dictionaries with usage --------------------------------------------
cte("files_ing", ["files"], """
SELECT path, name AS file_name,
  CASE WHEN rp > 0 AND length(name) - rp > 0 AND length(name) - rp < length(name) - 1
       THEN lower(substring(name, length(name) - rp + 1)) ELSE '' END AS file_type,
  CAST(length AS BIGINT) AS file_size_bytes, 'processing' AS status
FROM (SELECT path, length, regexp_extract(path, '[^/]*$') AS name, strpos(reverse(regexp_extract(path, '[^/]*$')), '.') AS rp
      FROM files)""")
cte("csv_keys", ["ents"], """
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY first_seq, first_kpos) - 1 AS INTEGER) AS col_pos, key
FROM (SELECT doc_id, key, arg_min(seq, seq * 16 + kpos) AS first_seq, arg_min(kpos, seq * 16 + kpos) AS first_kpos FROM (
        SELECT doc_id, seq, 0 AS kpos, 'name' AS key FROM ents WHERE name IS NOT NULL
        UNION ALL SELECT doc_id, seq, 1, 'value' FROM ents WHERE value_text IS NOT NULL OR value_num IS NOT NULL
        UNION ALL SELECT doc_id, seq, 2, 'unit' FROM ents WHERE unit IS NOT NULL
        UNION ALL SELECT doc_id, seq, 3, 'page' FROM ents WHERE page IS NOT NULL) GROUP BY doc_id, key)""")

# --- the same text chain over documents rebuilt from OCR pages ---------------------
import re as _re  # noqa: E402

_CHAIN = ["pieces", "toks", "tokw", "pmatch_raw", "pmatch", "kscores", "nscores", "best", "classification",
          "poff", "ematch", "text_ents_raw", "text_ents", "ents", "ents_k", "fbest", "findings", "vreport"]


def _clone(name: str, suffix: str, rename: dict[str, str]) -> None:
    deps, sql = CTES[name]

    def sub(m):
        return m.group(1) + rename.get(m.group(2), m.group(2))

    new_sql = _re.sub(r"\b(FROM\s+|JOIN\s+)([A-Za-z_][A-Za-z0-9_]*)\b", sub, sql)
    CTES[name + suffix] = ([rename.get(d, d) for d in deps], new_sql)


# word tables derived from the notes text by the same rule (notes carry the
# fixture words, so the OCR path is exercised with real matches)
_OCR = ["ocr_lines", "ocr_words", "ocr_kept", "ocr_seg", "ocr_tlines", "ocr_ptext", "ocr_pstats", "ocr_pages"]
_REN_N = {n: n + "_n" for n in _OCR}
_REN_N["documents"] = "notes"
for _n in _OCR:
    _clone(_n, "_n", _REN_N)
CTES["ocr_lines_n"] = (["notes"], CTES["ocr_lines_n"][1])

_PB = "chr(10) || chr(10) || '--- Page Break ---' || chr(10) || chr(10)"
cte("odocs", ["notes", "ocr_pages_n"], f"""
SELECT d.doc_id, coalesce(t.text, '') AS text FROM notes d
LEFT JOIN (SELECT doc_id, string_agg(raw_text, {_PB} ORDER BY page_number) AS text FROM ocr_pages_n GROUP BY doc_id) t
  USING (doc_id)""")
cte("ocdocs", ["odocs"], "SELECT doc_id, text FROM odocs WHERE text <> ''")
cte("ents_u_o", ["text_ents_o"], """
SELECT doc_id, 1 AS src_rank, type, name, value_text, CAST(NULL AS DOUBLE) AS value_num, unit,
       CAST(NULL AS INTEGER) AS page, pos FROM text_ents_o""")
_REN = {n: n + "_o" for n in _CHAIN}
_REN.update({"cdocs": "ocdocs", "ents_u": "ents_u_o"})
for _n in _CHAIN:
    if _n in CTES:
        _clone(_n, "_o", _REN)
cte("pipe_o", ["odocs", "classification_o", "vreport_o"], """
SELECT o.doc_id, 'scan_' || CAST(o.doc_id AS VARCHAR) || '.png' AS file_name,
  CASE WHEN o.text = '' OR coalesce(c.over_one, false) THEN 'failed' ELSE 'success' END AS processing_status,
  CASE WHEN o.text = '' OR coalesce(c.over_one, false) THEN 'unknown' ELSE c.document_type END AS document_type,
  CASE WHEN o.text = '' OR coalesce(c.over_one, false) THEN CAST(0.0 AS DOUBLE) ELSE c.confidence END
    AS classification_confidence,
  CAST(CASE WHEN o.text = '' OR coalesce(c.over_one, false) THEN 0 ELSE v.total_validated END AS BIGINT)
    AS total_validated
FROM odocs o LEFT JOIN classification_o c USING (doc_id) LEFT JOIN vreport_o v USING (doc_id)""")
