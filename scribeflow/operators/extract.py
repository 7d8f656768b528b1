"""Entity extraction: dictionary spans in text + rows of extracted tables.

Text:  hits of the entity lexicon (same one-pass matcher as classification)
       -> overlap resolution (longest span first, then earliest) only inside
          clusters of overlapping hits -> value/unit from the 50 characters
          after the span -> year guard.
Table: rows with >= 2 cells whose first cell is a known blood-test key (left
       semi join on a broadcast key set), only for ``.pdf`` documents.
Merge: one entity per (doc, type, lower(name)); table rows beat text, the
       last table row wins, the first text hit wins; order = first insertion.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scribeflow import fixed_values as fv
from scribeflow.functions.text import py_float, py_strip
from scribeflow.operators.tokens import match_dictionary
from scribeflow.sources.reference import bcast, by_key

VALUE_RE = "(?iuU)" + fv.VALUE_PATTERN
#: The same hits: a place where the pattern cannot start is passed over by its first character,
#: before word boundaries are looked at.
_SEARCH_RE = r"(?iuU)(?=[id:\-])" + fv.VALUE_PATTERN


def position(page, table, row):
    """Where an entity stands: by page, table and row, or by token alone."""
    cols = [(F.col(c) if isinstance(c, str) else c).cast("long") for c in (page, table, row)]
    return F.struct(*[c.alias(n) for c, n in zip(cols, ("page", "table", "row"))])


def lexicon_dictionary(lexicon: DataFrame) -> DataFrame:
    return lexicon.select("label", "toks", "n")


def gazetteer_hits(docs: DataFrame, lexicon: DataFrame, text_col: str = "text", broadcast: bool = True) -> DataFrame:
    """All lexicon hits with offsets and the text after each value-bearing one."""
    dic = lexicon_dictionary(lexicon)
    m = int(dic.agg(F.max("n")).first()[0] or 1)
    return match_dictionary(
        docs, bcast(dic) if broadcast else dic, m, text_col=text_col,
        want_offsets=True, window_labels=tuple(fv.VALUE_LABELS), window_chars=fv.VALUE_WINDOW,
    )


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hits that take free token positions, of clusters that come one after another, each in
    order of preference; linear, as a hit covers a term's few positions."""
    cluster, taken = None, set()
    for batch in batches:
        keep = []
        for *key, start, n in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "_cl", "tok_pos", "n"))):
            if key != cluster:
                cluster, taken = key, set()
            span = range(start, start + n)
            free = taken.isdisjoint(span)
            if free:
                taken.update(span)
            keep.append(free)
        yield batch.filter(pa.array(keep, pa.bool_()))


def resolve_spans(hits: DataFrame) -> DataFrame:
    """Keep a non-overlapping subset: longest first, ties to the earliest.

    Conflicts are found without ordering a document: every hit is expanded to
    the token positions it covers (at most the longest term) and grouped by
    (doc, position) - a key no hot document can concentrate.  Hits that share
    no position with another hit (nearly all) are kept as they are.  Only the
    conflicting ones are cut into clusters (running max of span ends) and
    walked once, against the token positions taken so far.
    """
    cols = list(hits.columns)
    h = hits.withColumn("_hid", F.struct("doc_id", "tok_pos", "n", "label"))
    cover = h.select("doc_id", "_hid", F.explode(F.sequence(F.col("tok_pos"), F.col("tok_pos") + F.col("n") - 1)).alias("_p"))
    busy = cover.groupBy("doc_id", "_p").agg(F.count(F.lit(1)).alias("_c"), F.collect_list("_hid").alias("_ids")) \
        .where(F.col("_c") > 1)
    conflicted = busy.select(F.explode("_ids").alias("_hid")).distinct()
    h = h.join(by_key(conflicted.withColumn("_conf", F.lit(True))), "_hid", "left")
    single = h.where(F.col("_conf").isNull()).select(*cols)
    multi = h.where(F.col("_conf").isNotNull()).select(*cols).withColumn("_end", F.col("tok_pos") + F.col("n"))
    w = Window.partitionBy("doc_id").orderBy("tok_pos", F.col("n").desc())
    prev_end = F.max("_end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    multi = multi.withColumn("_new", F.when(prev_end.isNull() | (F.col("tok_pos") >= prev_end), 1).otherwise(0))
    multi = multi.withColumn("_cl", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    # longest first, then earliest, then by label and text
    order = ["doc_id", "_cl", "_k", "tok_pos", *(c for c in ("label", "span_text") if c in cols)]
    ordered = multi.withColumn("_k", -F.col("n")).repartition("doc_id", "_cl").sortWithinPartitions(*order)
    resolved = ordered.mapInArrow(_walk, ordered.schema).select(*cols)
    return single.unionByName(resolved)


def raw_value_unit(after) -> tuple:
    """Value and unit of the first value-pattern hit, as written.  The window is searched once; both
    come from the short hit."""
    hit = F.regexp_extract(after, _SEARCH_RE, 0)
    return tuple(F.when(F.regexp_extract(hit, VALUE_RE, k) != "", F.regexp_extract(hit, VALUE_RE, k)) for k in (1, 2))


def value_unit(after_col: str = "after") -> tuple:
    """(value, unit) from the first value-pattern hit in the window, with the
    year guard (1900 < x < 2100 -> both null; 'a/b' values are exempt)."""
    v, u = raw_value_unit(F.col(after_col))
    year = is_year(py_float(v))
    return F.when(~year, v), F.when(~year, u)


def is_year(num):
    return num.isNotNull() & (num > fv.YEAR_LOW) & (num < fv.YEAR_HIGH)


def with_value_unit(hits: DataFrame, after: str = "after") -> DataFrame:
    """``hits`` with value and unit as in ``value_unit``, a step a column: used more than once, a step
    is not copied into the next, so each pattern runs once a hit."""
    h = hits.withColumn("_hit", F.regexp_extract(after, _SEARCH_RE, 0))
    h = h.withColumns({"_v": F.regexp_extract("_hit", VALUE_RE, 1), "_u": F.regexp_extract("_hit", VALUE_RE, 2)})
    h = h.withColumn("_num", py_float("_v"))
    h = h.withColumn("_kept", ~is_year(F.col("_num")))
    return h.withColumns({"value_text": F.when(F.col("_kept") & (F.col("_v") != ""), F.col("_v")),
                          "unit": F.when(F.col("_kept") & (F.col("_u") != ""), F.col("_u"))}).drop("_hit", "_v", "_u", "_num", "_kept")


def lexicon_can_overlap(lexicon: DataFrame, limit: int = 200_000) -> bool:
    """Can two hits of this (bounded) lexicon overlap?  Only if one token
    sequence occurs inside another, a proper suffix of one is a proper prefix
    of another (itself included), or one sequence carries two labels."""
    rows = lexicon.select("label", "toks").limit(limit + 1).collect()
    if len(rows) > limit:
        return True
    seqs: dict[tuple, set] = {}
    for r in rows:
        seqs.setdefault(tuple(r["toks"]), set()).add(r["label"])
    if any(len(v) > 1 for v in seqs.values()):
        return True
    prefixes = {t[:k] for t in seqs for k in range(1, len(t))}
    for t in seqs:
        n = len(t)
        if any(t[k:] in prefixes for k in range(1, n)):
            return True
        if any(t[i:j] in seqs for i in range(n) for j in range(i + 1, n + 1) if j - i < n):
            return True
    return False


def text_entities(docs: DataFrame, lexicon: DataFrame, text_col: str = "text", hits: DataFrame | None = None,
                  resolve: bool | None = None) -> DataFrame:
    """Text entities: (doc_id, type, name, value_text, value_num, unit,
    confidence, source, start_char, end_char, page, tok_pos).  Overlap
    resolution runs unless the lexicon provably yields no overlapping hits
    (``resolve=None`` decides from the lexicon)."""
    if resolve is None:
        resolve = lexicon_can_overlap(lexicon)
    if hits is None:
        hits = gazetteer_hits(docs, lexicon, text_col)
    r = (resolve_spans(hits) if resolve else hits).where(F.col("label").isin(fv.ENTITY_TYPES))
    return with_value_unit(r).select(
        "doc_id",
        F.col("label").alias("type"),
        F.col("span_text").alias("name"),
        "value_text",
        F.lit(None).cast("double").alias("value_num"),
        "unit",
        F.lit(fv.TEXT_ENTITY_CONFIDENCE).alias("confidence"),
        F.lit("text_ruler").alias("source"),
        "start_char",
        "end_char",
        F.lit(None).cast("int").alias("page"),
        position(F.lit(0), F.lit(0), "tok_pos").alias("tok_pos"),
    )


def table_rows_from_tables(pdf_tables: DataFrame) -> DataFrame:
    """pdf_tables(doc_id, page_number, table_index, rows) -> table_rows with
    row_count / col_count kept per table; empty tables dropped."""
    t = pdf_tables.where(F.size("rows") > 0).select(
        "doc_id", "page_number", "table_index",
        F.size("rows").alias("row_count"),
        F.coalesce(F.array_max(F.transform("rows", lambda r: F.size(r))), F.lit(0)).alias("col_count"),
        F.posexplode("rows").alias("row_index", "cells"),
    )
    return t


def table_entities(table_rows: DataFrame, docs: DataFrame, known_tests: DataFrame) -> DataFrame:
    """Table entities.  ``docs`` has (doc_id, file_type); ``known_tests`` has
    (key_lower) for the blood-test dictionary keys."""
    cells = [F.try_element_at("cells", F.lit(i)).alias(f"_c{i - 1}") for i in (1, 2, 3)]
    r = table_rows.where(F.size("cells") >= 2).select("doc_id", "page_number", "table_index", "row_index", *cells)
    c0, c1, c2 = (F.col(f"_c{i}") for i in range(3))
    r = r.select(
        "doc_id", "page_number", "table_index", "row_index",
        F.when(c0.isNull() | (c0 == ""), F.lit("")).otherwise(py_strip("_c0")).alias("name"),
        F.when(c1.isNull() | (c1 == ""), F.lit("")).otherwise(py_strip("_c1")).alias("vs"),
        F.when(c2.isNotNull() & (c2 != ""), py_strip("_c2")).alias("unit"),
    )
    keys = bcast(known_tests.select(F.col("key_lower").alias("_k")).distinct())
    r = r.join(keys, F.lower(r["name"]) == keys["_k"], "left_semi")
    pdf_docs = docs.where(F.col("file_type") == ".pdf").select("doc_id")
    r = r.join(by_key(pdf_docs), "doc_id", "left_semi")
    num = py_float(F.col("vs"))
    return r.select(
        "doc_id",
        F.lit("test_result").alias("type"),
        "name",
        F.when(num.isNull(), F.col("vs")).alias("value_text"),
        num.alias("value_num"),
        "unit",
        F.lit(fv.TABLE_ENTITY_CONFIDENCE).alias("confidence"),
        F.lit("pdf_table").alias("source"),
        F.lit(None).cast("long").alias("start_char"),
        F.lit(None).cast("long").alias("end_char"),
        F.col("page_number").cast("int").alias("page"),
        position("page_number", "table_index", "row_index").alias("tok_pos"),
    )


def merge_entities(table_ents: DataFrame | None, text_ents: DataFrame) -> DataFrame:
    """One entity per (doc, type, lower(name)); adds ``seq`` (0-based order of
    first insertion: table rows first, then text hits).

    The dedupe is an aggregation (``max_by`` last table row, ``min_by`` first
    text hit, ``min`` first insertion) over rows dealt by document once: the
    ``seq`` window and what later groups or joins by document need no further
    shuffle.  Table rows, of which a document may have any number, are first
    reduced to the last of a name where they lie, with the name's first place;
    the hits of a text come from one row and are dealt as they are.
    """
    payload = F.struct("name", "value_text", "value_num", "unit", "confidence", "source", "start_char", "end_char", "page")
    name = F.lower("name").alias("_lname")
    none = F.lit(None).cast(text_ents.schema["tok_pos"].dataType)
    u = text_ents.select("doc_id", "type", name, F.struct(F.lit(1).alias("src_rank"), "tok_pos").alias("_first"),
                         none.alias("_last"), payload.alias("e"))
    if table_ents is not None:
        t = table_ents.groupBy("doc_id", "type", name).agg(
            F.max_by(payload, "tok_pos").alias("e"), F.min("tok_pos").alias("tok_pos"), F.max("tok_pos").alias("_last"))
        u = u.unionByName(t.select("doc_id", "type", "_lname", F.struct(F.lit(0).alias("src_rank"), "tok_pos").alias("_first"), "_last", "e"))
    g = u.repartition("doc_id").groupBy("doc_id", "type", "_lname").agg(
        F.coalesce(F.max_by("e", "_last"), F.min_by("e", "_first")).alias("e"), F.min("_first").alias("_first"))
    seq = (F.row_number().over(Window.partitionBy("doc_id").orderBy("_first")) - 1).cast("int")
    return g.select(
        "doc_id", seq.alias("seq"), "type", "e.name", "e.value_text", "e.value_num", "e.unit", "e.confidence",
        "e.source", "e.start_char", "e.end_char", "e.page",
    )


def known_tests_from_lab(lab_json: DataFrame) -> DataFrame:
    m = lab_json.select(F.from_json("value", "map<string, map<string, string>>").alias("m"))
    k = m.select(F.explode(F.map_keys(F.col("m")["blood_tests"])).alias("k"))
    return k.select(F.lower("k").alias("key_lower"))
