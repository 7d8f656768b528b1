"""Reference dictionaries: JSON documents -> small flat tables.

A dictionary file is read whole (``wholetext``) and parsed with ``from_json``
into maps, then flattened with ``posexplode`` so dictionary order survives as
an explicit ordinal column.  The results are tiny and bounded by the files, so
callers broadcast them (``broadcast_checked``).
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scribeflow import fixed_values as fv
from scribeflow.functions.text import PY_WS, PIECE_PATTERN, py_float_str, py_strip
from scribeflow.sources.local import local_df

# Dictionaries above this many rows are not broadcast (shuffle join instead).
BROADCAST_ROW_LIMIT = 200_000


def load_reference_json(spark: SparkSession, path: str) -> DataFrame:
    """One row per JSON file: (path, value).  A missing file raises at read
    time; a corrupt file is found by ``assert_parsed``."""
    return (
        spark.read.text(path, wholetext=True)
        .select(F.input_file_name().alias("path"), "value")
    )


def assert_parsed(df: DataFrame, name: str) -> None:
    """Raise when a dictionary's text is not a JSON object."""
    good = F.try_parse_json(F.col("value"))
    if df.where(good.isNull() | ~F.coalesce(F.schema_of_variant(good).startswith("OBJECT"), F.lit(False))).count():
        raise ValueError(f"dictionary {name} is not a JSON object")


def json_value(spark: SparkSession, obj: dict) -> DataFrame:
    """In-memory counterpart of ``load_reference_json`` for a dict."""
    return local_df(spark, [("<memory>", json.dumps(obj))], "path string, value string")


def default_dictionaries(spark: SparkSession) -> dict[str, DataFrame]:
    """The built-in dictionaries (fixed values) as JSON-text DataFrames."""
    return {
        "document_keywords": json_value(spark, fv.document_keywords_json()),
        "lab_ranges": json_value(spark, fv.lab_ranges_json()),
        "medical_entities": json_value(spark, fv.medical_entities_json()),
        "layman_terms": json_value(spark, fv.layman_json()),
    }


def broadcast_checked(df: DataFrame, limit: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """Broadcast a dictionary only when its row count is proven small.

    Dictionaries are built from reference files; counting them is a tiny job.
    Above the limit the plain DataFrame is returned and Spark plans a shuffle
    join instead.
    """
    n = df.count()
    return F.broadcast(df) if n <= limit else df


BROADCAST_BYTES_LIMIT = 64 * 1024 * 1024
_SIZES: dict[tuple, tuple[int, int]] = {}


def measured(df: DataFrame) -> tuple[int, int]:
    """Rows and bytes of a dictionary table, counted.  The optimizer's estimate cannot be trusted
    here: a table expanded from one JSON literal counts as a few bytes, whatever it holds.  Counted
    once for each plan and application."""
    key = (df.sparkSession.sparkContext.applicationId, df.semanticHash())
    if key not in _SIZES:
        row = F.octet_length(F.to_json(F.struct(*(F.col(f"`{c}`") for c in df.columns)))) if df.columns else F.lit(0)
        n, size = df.agg(F.count("*"), F.sum(row.cast("long"))).first()
        _SIZES[key] = n, size or 0
    return _SIZES[key]


def bcast(df: DataFrame, limit_bytes: int = BROADCAST_BYTES_LIMIT, limit_rows: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """Broadcast hint for a dictionary side whose counted rows and bytes are within the limits;
    beyond them a shuffle join is asked for, as the optimizer would broadcast by its estimate."""
    n, size = measured(df)
    return F.broadcast(df) if n <= limit_rows and size <= limit_bytes else df.hint("merge")


def by_key(df: DataFrame) -> DataFrame:
    """The side of a join that grows with the documents: joined by shuffle.  The optimizer's
    estimate, from compressed files, would broadcast a row for each document from the driver."""
    return df.hint("merge")


def _lower_tokens(text) -> F.Column:
    """Lower-cased tokens of a phrase with the document tokenizer (the single
    blank pieces are dropped)."""
    toks = F.regexp_extract_all(text, F.lit(PIECE_PATTERN), 0)
    return F.transform(F.filter(toks, lambda p: p != " "), lambda p: F.lower(p))


def doc_phrase_table(kw: DataFrame) -> DataFrame:
    """document_keywords JSON -> (doc_type, type_ord, phrase_lower, weight, toks, n).

    Keywords weigh 1.0 and indicators 2.0; a phrase listed in both keeps 2.0.
    Types outside the document-type enum (and ``unknown``) are dropped.
    """
    schema = "map<string, struct<keywords: array<string>, indicators: array<string>>>"
    m = kw.select(F.posexplode(F.from_json("value", schema)).alias("type_ord", "doc_type", "info"))
    valid = [t for t in fv.DOCUMENT_TYPES if t != "unknown"]
    m = m.where(F.col("doc_type").isin(valid))
    kws = m.select("doc_type", "type_ord", F.explode_outer("info.keywords").alias("p"), F.lit(fv.KEYWORD_WEIGHT).alias("w"))
    ind = m.select("doc_type", "type_ord", F.explode_outer("info.indicators").alias("p"), F.lit(fv.INDICATOR_WEIGHT).alias("w"))
    ph = kws.unionByName(ind).select("doc_type", "type_ord", py_strip("p").alias("p"), "w").where(
        F.col("p").isNotNull() & (F.col("p") != "")
    )
    ph = ph.groupBy("doc_type", "type_ord", F.lower("p").alias("phrase_lower")).agg(
        F.max("w").alias("weight"), F.min("p").alias("phrase")
    )
    return ph.select(
        "doc_type", "type_ord", "phrase", "phrase_lower", "weight",
        _lower_tokens(F.col("phrase")).alias("toks"),
    ).withColumn("n", F.size("toks"))


def type_totals(phrases: DataFrame) -> DataFrame:
    """Maximum reachable score per type: sum of distinct-phrase weights."""
    return phrases.groupBy("doc_type", "type_ord").agg(F.sum("weight").alias("total"))


def entity_lexicon_table(lab: DataFrame | None, ents: DataFrame | None) -> DataFrame:
    """(label, term, toks, n).  Blood-test / vital-sign keys, all medication
    groups, conditions and symptoms; terms split on whitespace only."""
    parts = []
    if lab is not None:
        lm = lab.select(F.from_json("value", "map<string, map<string, string>>").alias("m"))
        for section, label in (("blood_tests", "test_result"), ("vital_signs", "vital_sign")):
            parts.append(lm.select(F.lit(label).alias("label"), F.explode(F.map_keys(F.col("m")[section])).alias("term")))
    if ents is not None:
        schema = "struct<medications: map<string, array<string>>, conditions: array<string>, symptoms: array<string>>"
        em = ents.select(F.from_json("value", schema).alias("m"))
        parts.append(em.select(F.lit("medication").alias("label"), F.explode(F.flatten(F.map_values("m.medications"))).alias("term")))
        parts.append(em.select(F.lit("condition").alias("label"), F.explode("m.conditions").alias("term")))
        parts.append(em.select(F.lit("symptom").alias("label"), F.explode("m.symptoms").alias("term")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    toks = F.transform(F.split(py_strip("term"), PY_WS + "+"), lambda t: F.lower(t))
    return (
        out.where(F.col("term").isNotNull() & (py_strip("term") != ""))
        .select("label", "term", toks.alias("toks"))
        .dropDuplicates(["label", "toks"])
        .withColumn("n", F.size("toks"))
    )


def _json_number_text(raw) -> F.Column:
    """Python ``str()`` of a JSON number given its raw text; 'None' for null."""
    is_int = raw.rlike("^-?[0-9]+$")
    return (
        F.when(raw.isNull(), F.lit("None"))
        .when(is_int, raw.cast("decimal(38,0)").cast("string"))
        .otherwise(py_float_str(raw.cast("double")))
    )


def rule_tables(lab: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rules in the ranges/aliases contract.

    Returns (rules, rule_ranges, rule_aliases):
      rules(section, rule_ord, key, n_fields)
      rule_ranges(section, rule_ord, key, range_ord, status, lo, hi, lo_text, hi_text, reason)
      rule_aliases(section, rule_ord, key, alias_norm)
    """
    sec = lab.select(F.explode(F.from_json("value", "map<string, map<string, string>>")).alias("section", "rules"))
    rules = sec.select("section", F.posexplode("rules").alias("rule_ord", "key", "rule_text")).select(
        "section", "rule_ord", "key",
        F.size(F.from_json("rule_text", "map<string, string>")).alias("n_fields"),
        F.from_json(
            "rule_text",
            "struct<aliases: array<string>, ranges: array<struct<status: string, range: array<string>, reason: string>>>",
        ).alias("r"),
    )
    ranges = rules.select("section", "rule_ord", "key", F.posexplode("r.ranges").alias("range_ord", "x")).select(
        "section", "rule_ord", "key", "range_ord",
        F.col("x.status").alias("status"),
        F.try_element_at("x.range", F.lit(1)).cast("double").alias("lo"),
        F.try_element_at("x.range", F.lit(2)).cast("double").alias("hi"),
        _json_number_text(F.try_element_at("x.range", F.lit(1))).alias("lo_text"),
        _json_number_text(F.try_element_at("x.range", F.lit(2))).alias("hi_text"),
        F.col("x.reason").alias("reason"),
    )
    aliases = rules.select("section", "rule_ord", "key", F.explode("r.aliases").alias("a")).select(
        "section", "rule_ord", "key", F.replace(F.lower(py_strip("a")), F.lit(" "), F.lit("_")).alias("alias_norm")
    )
    return rules.drop("r"), ranges, aliases


def layman_table(lay: DataFrame) -> DataFrame:
    """(section, key, medical, layman, explanation)."""
    schema = "map<string, map<string, struct<medical: string, layman: string, explanation: string>>>"
    return (
        lay.select(F.explode(F.from_json("value", schema)).alias("section", "entries"))
        .select("section", F.explode("entries").alias("key", "e"))
        .select("section", "key", "e.medical", "e.layman", "e.explanation")
    )
