"""Derived fixture views over the driver tables (see FIXTURES.md §2).

The driver data carries no clinical words, so every matching query runs on
views derived from ``orders`` / ``lineitem`` / ``documents``.  Each view is
defined twice with the same meaning: once as a Spark DataFrame and once as a
DuckDB CTE (``SQL`` below) for the oracle.  Fixture dictionaries (``LEX``,
``PHR``, ``RULES_JSON``) are small fixed test inputs, always joined to the
driver tables so the work grows with them.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scribeflow.sources.local import local_df
from scribeflow.sources.reference import by_key

# Fixture lexicon (i, label, term, unit); i = 12 is noise kept out of the lexicon.
LEX = [
    (0, "test_result", "hemoglobin", "g/dL"),
    (1, "test_result", "glucose", "mg/dL"),
    (2, "test_result", "potassium", "mEq/L"),
    (3, "test_result", "creatinine", "mg/dL"),
    (4, "vital_sign", "heart_rate", "bpm"),
    (5, "vital_sign", "blood_pressure_systolic", "mmHg"),
    (6, "medication", "lisinopril", "mg"),
    (7, "medication", "metformin", "mg"),
    (8, "condition", "hypertension", ""),
    (9, "condition", "heart disease", ""),
    (10, "symptom", "chest pain", ""),
    (11, "symptom", "shortness of breath", ""),
    (12, "none", "stable", ""),
]

# Fixture document phrases (t, doc_type, phrase, weight, ord).
PHR = [
    (0, "lab_report", "specimen", 1.0, 0),
    (0, "lab_report", "test results", 1.0, 1),
    (0, "lab_report", "result", 1.0, 2),
    (0, "lab_report", "reference range", 2.0, 3),
    (0, "lab_report", "units", 2.0, 4),
    (1, "prescription", "dosage", 2.0, 0),
    (1, "prescription", "refills", 2.0, 1),
    (1, "prescription", "as needed", 1.0, 2),
    (1, "prescription", "pharmacy", 1.0, 3),
    (2, "patient_history", "history", 2.0, 0),
    (2, "patient_history", "medical history", 1.0, 1),
    (2, "patient_history", "past medical history", 1.0, 2),
    (2, "patient_history", "allergies", 2.0, 3),
    (2, "patient_history", "plan", 1.0, 4),
]

# Fixture rules in the ranges/aliases contract (list order matters; null = open).
RULES_JSON = {
    "blood_tests": {
        "hemoglobin": {
            "aliases": ["hgb"],
            "ranges": [
                {"status": "critical", "range": [None, 7], "reason": "critically low"},
                {"status": "abnormal", "range": [7, 12], "reason": "low"},
                {"status": "normal", "range": [12, 17.5], "reason": "within range"},
                {"status": "abnormal", "range": [17.5, 20], "reason": "high"},
                {"status": "critical", "range": [20, None], "reason": "critically high"},
            ],
        },
        "glucose": {
            "aliases": ["blood sugar"],
            "ranges": [
                {"status": "normal", "range": [4, 20], "reason": "within range"},
                {"status": "abnormal", "range": [20, 40], "reason": "high"},
                {"status": "critical", "range": [40, None], "reason": "very high"},
            ],
        },
        "potassium": {
            "ranges": [
                {"status": "normal", "range": [3.5, 5], "reason": "within range"},
                {"status": "abnormal", "range": [5, 30], "reason": "above"},
            ],
        },
    },
    "vital_signs": {},
}

SUFFIXES = [".PDF", ".jpg", ".tar.gz", ".png"]
SEPARATORS = [": ", " is ", " - ", " Dosage ", " level "]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lex_df(spark: SparkSession) -> DataFrame:
    return local_df(spark, LEX, "i int, label string, term string, unit string")


def phr_df(spark: SparkSession) -> DataFrame:
    return local_df(spark, PHR, "t int, doc_type string, phrase string, weight double, ord int")


def doc_keywords_fixture() -> dict:
    """The fixture phrases in the keywords/indicators JSON shape."""
    out: dict[str, dict[str, list[str]]] = {}
    for _, doc_type, phrase, weight, _ in PHR:
        d = out.setdefault(doc_type, {"keywords": [], "indicators": []})
        d["indicators" if weight == 2.0 else "keywords"].append(phrase)
    return out


def lexicon_sources_fixture() -> tuple[dict, dict]:
    """The fixture lexicon as (lab_ranges-shaped, medical_entities-shaped) JSON."""
    lab = {"blood_tests": {}, "vital_signs": {}}
    ent = {"medications": {"fixture": []}, "conditions": [], "symptoms": []}
    for _, label, term, _ in LEX:
        if label == "test_result":
            lab["blood_tests"][term] = {}
        elif label == "vital_sign":
            lab["vital_signs"][term] = {}
        elif label == "medication":
            ent["medications"]["fixture"].append(term)
        elif label == "condition":
            ent["conditions"].append(term)
        elif label == "symptom":
            ent["symptoms"].append(term)
    return lab, ent


def json_df(spark: SparkSession, obj: dict) -> DataFrame:
    """One-row DataFrame holding a JSON document as text (the shape a
    ``wholetext`` read of a dictionary file gives)."""
    return local_df(spark, [(json.dumps(obj),)], "value string")


#: Rows of a driver table that are dealt to one task of a view grouped by document.
DEALT_ROWS = 250_000


def dealt(df: DataFrame, key: str, spread: int | None) -> DataFrame:
    """``df`` dealt by ``key`` to so many tasks, if a number is given; the steps by that key that follow
    need no further shuffle, and what they write has a file a task."""
    return df if spread is None else df.repartition(spread, key)


def spread_of(spark: SparkSession, sf_dir: str, name: str) -> int:
    """How many tasks a view that has a row for each row of a driver table is dealt to: a part never
    holds more rows because the table has more, and every core has one."""
    return max(spark.sparkContext.defaultParallelism, -(-table(spark, sf_dir, name).count() // DEALT_ROWS))


def note_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity"
    )
    lx = F.broadcast(lex_df(spark))  # 13-row literal table
    q = F.col("l_quantity").cast("int")
    term = F.when(F.col("l_suppkey") % 2 == 0, F.upper("term")).otherwise(F.col("term"))
    sep = F.element_at(F.array(*[F.lit(s) for s in SEPARATORS]), (F.col("l_linenumber") % 5 + 1).cast("int"))
    value = (
        F.when(F.col("l_partkey") % 29 == 0, F.lit("2021"))
        .when(F.col("i") == 5, F.concat((q + 100).cast("string"), F.lit("/"), (q + 50).cast("string")))
        .otherwise(F.concat(q.cast("string"), F.lit("."), (F.col("l_suppkey") % 10).cast("string")))
    )
    unit = F.when(F.col("unit") != "", F.concat(F.lit(" "), F.col("unit"))).otherwise(F.lit(""))
    return li.join(lx, (F.col("l_partkey") % 13) == F.col("i")).select(
        F.col("l_orderkey").alias("doc_id"),
        F.col("l_linenumber").alias("line_no"),
        "label",
        "term",
        F.concat(term, sep, value, unit, F.lit(".")).alias("sentence"),
    )


def _header(k) -> F.Column:
    """Header phrases of type k % 3, chosen by (ord*7 + k) % 10 <= k % 10 + 2."""
    per_type = []
    for t in range(3):
        items = [F.struct(F.lit(o).alias("ord"), F.lit(p).alias("phrase")) for (tt, _, p, _, o) in PHR if tt == t]
        per_type.append(F.array(*items))
    arr = F.element_at(F.array(*per_type), (k % 3 + 1).cast("int"))
    kept = F.filter(arr, lambda x: (x["ord"] * 7 + k) % 10 <= k % 10 + 2)
    return F.array_join(F.transform(kept, lambda x: x["phrase"]), " ; ")


def notes(spark: SparkSession, sf_dir: str, spread: int | None = None) -> DataFrame:
    """notes(doc_id, file_name, text): one note per order."""
    body = (
        dealt(note_lines(spark, sf_dir).select("doc_id", "line_no", "sentence"), "doc_id", spread)
        .groupBy("doc_id")
        .agg(F.array_sort(F.collect_list(F.struct("line_no", "sentence"))).alias("s"))
        .select("doc_id", F.array_join(F.transform("s", lambda x: x["sentence"]), " ").alias("body"))
    )
    k = F.col("o_orderkey")
    o = dealt(table(spark, sf_dir, "orders").select(k.alias("doc_id")), "doc_id", spread)
    k = F.col("doc_id")
    text = (
        F.when(k % 50 == 0, F.lit(""))
        .when(k % 50 == 1, F.lit("   "))
        .otherwise(F.concat(_header(k), F.lit("\n"), F.coalesce(F.col("body"), F.lit(""))))
    )
    suffix = F.element_at(F.array(*[F.lit(s) for s in SUFFIXES]), (k % 4 + 1).cast("int"))
    return o.join(by_key(body), "doc_id", "left").select(
        "doc_id", F.concat(F.lit("note_"), k.cast("string"), suffix).alias("file_name"), text.alias("text")
    )


def table_rows(spark: SparkSession, sf_dir: str, spread: int | None = None) -> DataFrame:
    """table_rows(doc_id, page_number, table_index, row_index, cells) for the notes of all file types."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice"
    )
    # rows that the join below would drop are not numbered; so the terms need not be sorted with them
    li = dealt(li.where((F.col("l_partkey") % 13).between(0, 12)), "l_orderkey", spread)
    q = F.col("l_quantity").cast("int")
    s10 = F.col("l_suppkey") % 10
    term = F.when(F.col("l_suppkey") % 2 == 0, F.upper("term")).otherwise(F.col("term"))
    c0 = F.when(s10 == 9, F.lit(None).cast("string")).otherwise(F.concat(F.lit(" "), term, F.lit(" ")))
    c1 = (
        F.when(s10 == 0, F.lit("n/a"))
        .when(s10 == 1, F.lit(""))
        .when(s10 == 2, F.lit(None).cast("string"))
        .when(s10 == 3, F.lit(" 7.0 "))
        .otherwise(F.concat(q.cast("string"), F.lit("."), s10.cast("string")))
    )
    c2 = F.when(F.col("l_partkey") % 7 == 0, F.lit(None).cast("string")).otherwise(F.col("unit"))
    n_cells = F.when(F.col("l_linenumber") % 7 == 6, 1).otherwise(3)
    from pyspark.sql import Window as W

    w = W.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    li = li.withColumn("row_index", F.row_number().over(w))
    return li.join(F.broadcast(lex_df(spark)), (F.col("l_partkey") % 13) == F.col("i")).select(
        F.col("l_orderkey").alias("doc_id"),
        (F.col("l_linenumber") / 4).cast("int").alias("pg0"),
        "row_index",
        F.slice(F.array(c0, c1, c2), 1, n_cells).alias("cells"),
    ).select(
        "doc_id", (F.col("pg0") + 1).alias("page_number"), F.lit(0).alias("table_index"), "row_index", "cells"
    )


def pdf_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pdf_tables(doc_id, page_number, table_index, rows array<array<string>>)."""
    return (
        table_rows(spark, sf_dir)
        .groupBy("doc_id", "page_number", "table_index")
        .agg(F.array_sort(F.collect_list(F.struct("row_index", "cells"))).alias("r"))
        .select("doc_id", "page_number", "table_index", F.transform("r", lambda x: x["cells"]).alias("rows"))
    )


def documents_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents(doc_id, file_name, file_type, file_size_bytes, full_text) from notes."""
    from scribeflow.sources.files import file_type_of

    n = notes(spark, sf_dir)
    return n.select(
        "doc_id",
        "file_name",
        file_type_of(F.col("file_name")).alias("file_type"),
        (F.col("doc_id") + 1000).alias("file_size_bytes"),
        F.col("text").alias("full_text"),
    )


def ocr_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ocr_words(doc_id, page_number, seq, block_num, par_num, line_num, conf, text)
    from ``documents.text``."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return ocr_words_from(d.repartition(parts(d.agg(F.sum(F.octet_length("text").cast("long"))).first()[0]), "doc_id"))


#: Text bytes of a task whose words become rows: a word takes many times its bytes there, and what is
#: sorted by page must stay in memory.
PART_BYTES = 8 << 20


def parts(text_bytes: int | None, least: int = 32) -> int:
    """How many tasks texts of so many bytes are dealt to; a number that is given is not made less by
    what the texts take before they are split."""
    return max(least, -(-(text_bytes or 0) // PART_BYTES))


def ocr_words_from(d: DataFrame) -> DataFrame:
    """The word-table rule of FIXTURES.md applied to any (doc_id, text)."""
    lines = d.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("ln", "line"))
    words = lines.select("doc_id", "ln", F.posexplode(F.split("line", " ", -1)).alias("wi", "word"))
    ln, wi = F.col("ln"), F.col("wi")
    conf = F.when((wi == 0) & (ln % 7 == 0), F.lit(-1)).otherwise((wi * 37 + ln * 11 + F.col("doc_id")) % 101)
    return words.select(
        "doc_id",
        (F.floor(ln / 20) + 1).cast("int").alias("page_number"),
        (ln.cast("long") * 1000000 + wi).alias("seq"),
        (F.floor((ln % 20) / 10) + 1).cast("int").alias("block_num"),
        (F.floor((ln % 10) / 5) + 1).cast("int").alias("par_num"),
        (ln % 5 + 1).cast("int").alias("line_num"),
        conf.cast("string").alias("conf"),
        F.col("word").alias("text"),
    )


EXTRA_FILES = ["a.webp", "b.tif", "c.TXT", ".hidden", "noext"]


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """files(path, length) from notes plus a few literal odd names."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_id"))
    k = F.col("doc_id")
    suffix = F.element_at(F.array(*[F.lit(s) for s in SUFFIXES]), (k % 4 + 1).cast("int"))
    base = o.select(
        F.concat(F.lit("/in/note_"), k.cast("string"), suffix).alias("path"), (k + 1000).alias("length")
    )
    extra = local_df(spark, [(f"/in/{n}", 7 + i) for i, n in enumerate(EXTRA_FILES)], "path string, length long")
    return base.unionByName(extra)


# ---------------------------------------------------------------------------
# The same views as DuckDB CTEs (the oracle side).
# ---------------------------------------------------------------------------


def _values(rows, cols) -> str:
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return repr(v)

    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"(VALUES {body}) AS v({', '.join(cols)})"


def _rules_rows():
    rng, ali = [], []
    for section, rules in RULES_JSON.items():
        for rule_ord, (key, rule) in enumerate(rules.items()):
            for range_ord, r in enumerate(rule.get("ranges", [])):
                lo, hi = r["range"]
                rng.append((section, rule_ord, key, range_ord, r["status"],
                            None if lo is None else float(lo), None if hi is None else float(hi),
                            json.dumps(lo) if lo is not None else "None", json.dumps(hi) if hi is not None else "None",
                            r["reason"]))
            for a in rule.get("aliases", []):
                ali.append((section, rule_ord, key, a.strip().lower().replace(" ", "_")))
    return rng, ali


_RNG, _ALI = _rules_rows()

SQL = {
    "lex": ([], f"SELECT * FROM {_values(LEX, ['i', 'label', 'term', 'unit'])}"),
    "phr": ([], f"SELECT t, doc_type, phrase, CAST(weight AS DOUBLE) AS weight, ord FROM {_values(PHR, ['t', 'doc_type', 'phrase', 'weight', 'ord'])}"),
    "rule_ranges": ([], "SELECT section, rule_ord, key, range_ord, status, CAST(lo AS DOUBLE) AS lo, CAST(hi AS DOUBLE) AS hi, lo_text, hi_text, reason FROM "
                    + _values(_RNG, ["section", "rule_ord", "key", "range_ord", "status", "lo", "hi", "lo_text", "hi_text", "reason"])),
    "rule_aliases": ([], "SELECT * FROM " + _values(_ALI, ["section", "rule_ord", "key", "alias_norm"])),
    "note_lines": (["lex"], """
SELECT l.l_orderkey AS doc_id, l.l_linenumber AS line_no, x.label, x.term,
  (CASE WHEN l.l_suppkey % 2 = 0 THEN upper(x.term) ELSE x.term END)
  || (CASE l.l_linenumber % 5 WHEN 0 THEN ': ' WHEN 1 THEN ' is ' WHEN 2 THEN ' - ' WHEN 3 THEN ' Dosage ' ELSE ' level ' END)
  || (CASE WHEN l.l_partkey % 29 = 0 THEN '2021'
           WHEN x.i = 5 THEN CAST(100 + CAST(l.l_quantity AS INTEGER) AS VARCHAR) || '/' || CAST(50 + CAST(l.l_quantity AS INTEGER) AS VARCHAR)
           ELSE CAST(CAST(l.l_quantity AS INTEGER) AS VARCHAR) || '.' || CAST(l.l_suppkey % 10 AS VARCHAR) END)
  || (CASE WHEN x.unit <> '' THEN ' ' || x.unit ELSE '' END) || '.' AS sentence
FROM lineitem l JOIN lex x ON l.l_partkey % 13 = x.i"""),
    "notes": (["note_lines", "phr"], """
SELECT o.o_orderkey AS doc_id,
  'note_' || CAST(o.o_orderkey AS VARCHAR) || (CASE o.o_orderkey % 4 WHEN 0 THEN '.PDF' WHEN 1 THEN '.jpg' WHEN 2 THEN '.tar.gz' ELSE '.png' END) AS file_name,
  CASE WHEN o.o_orderkey % 50 = 0 THEN '' WHEN o.o_orderkey % 50 = 1 THEN '   '
       ELSE coalesce(h.header, '') || chr(10) || coalesce(b.body, '') END AS text
FROM orders o
LEFT JOIN (SELECT o2.o_orderkey AS k, string_agg(p.phrase, ' ; ' ORDER BY p.ord) AS header
           FROM orders o2 JOIN phr p ON p.t = o2.o_orderkey % 3 AND (p.ord * 7 + o2.o_orderkey) % 10 <= o2.o_orderkey % 10 + 2
           GROUP BY o2.o_orderkey) h ON h.k = o.o_orderkey
LEFT JOIN (SELECT doc_id, string_agg(sentence, ' ' ORDER BY line_no, sentence) AS body FROM note_lines GROUP BY doc_id) b
  ON b.doc_id = o.o_orderkey"""),
    "table_rows": (["lex"], """
SELECT l.l_orderkey AS doc_id, l.l_linenumber // 4 + 1 AS page_number, 0 AS table_index,
  row_number() OVER (PARTITION BY l.l_orderkey ORDER BY l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity, l.l_extendedprice) AS row_index,
  CASE WHEN l.l_suppkey % 10 = 9 THEN NULL
       ELSE ' ' || (CASE WHEN l.l_suppkey % 2 = 0 THEN upper(x.term) ELSE x.term END) || ' ' END AS c0,
  CASE l.l_suppkey % 10 WHEN 0 THEN 'n/a' WHEN 1 THEN '' WHEN 2 THEN NULL WHEN 3 THEN ' 7.0 '
       ELSE CAST(CAST(l.l_quantity AS INTEGER) AS VARCHAR) || '.' || CAST(l.l_suppkey % 10 AS VARCHAR) END AS c1,
  CASE WHEN l.l_partkey % 7 = 0 THEN NULL ELSE x.unit END AS c2,
  CASE WHEN l.l_linenumber % 7 = 6 THEN 1 ELSE 3 END AS n_cells
FROM lineitem l JOIN lex x ON l.l_partkey % 13 = x.i"""),
    "ocr_lines": ([], """
SELECT doc_id, generate_subscripts(ls, 1) - 1 AS ln, unnest(ls) AS line
FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)"""),
    "ocr_words": (["ocr_lines"], """
SELECT doc_id, CAST(ln // 20 + 1 AS INTEGER) AS page_number, CAST(ln AS BIGINT) * 1000000 + wi AS seq,
  CAST((ln % 20) // 10 + 1 AS INTEGER) AS block_num, CAST((ln % 10) // 5 + 1 AS INTEGER) AS par_num,
  CAST(ln % 5 + 1 AS INTEGER) AS line_num,
  CAST(CASE WHEN wi = 0 AND ln % 7 = 0 THEN -1 ELSE (wi * 37 + ln * 11 + doc_id) % 101 END AS VARCHAR) AS conf,
  word AS text
FROM (SELECT doc_id, ln, generate_subscripts(ws, 1) - 1 AS wi, unnest(ws) AS word
      FROM (SELECT doc_id, ln, string_split(line, ' ') AS ws FROM ocr_lines))"""),
    "files": ([], """
SELECT '/in/note_' || CAST(o_orderkey AS VARCHAR) || (CASE o_orderkey % 4 WHEN 0 THEN '.PDF' WHEN 1 THEN '.jpg' WHEN 2 THEN '.tar.gz' ELSE '.png' END) AS path,
  o_orderkey + 1000 AS length
FROM orders
UNION ALL SELECT * FROM """ + _values([(f"/in/{n}", 7 + i) for i, n in enumerate(EXTRA_FILES)], ["path", "length"])),
}
