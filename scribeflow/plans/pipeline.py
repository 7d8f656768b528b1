"""Pipeline composition: documents -> stage outputs -> one report per document.

Stages are DataFrame transforms over *all* documents at once.  Per-document
control flow (a required input missing, a stage error) is data: each stage
contributes a nullable error struct, the first error in stage order decides
the status, and outputs of stages after it are masked out.  Because
classification and extraction read the same text, both are served by one
tokenize + explode + broadcast-join pass over a combined dictionary.

Shuffles (all keyed by ``doc_id`` or on hits only): classification scores,
entity dedupe windows, validation report, summary rollup, report assembly.
Text that arrives with the documents is never shuffled; text from OCR word
tables is put together by a shuffle on its pages.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scribeflow import fixed_values as fv
from scribeflow.operators import classify as C
from scribeflow.operators import control as K
from scribeflow.operators import extract as X
from scribeflow.operators import ocr_text as O
from scribeflow.operators import summarize as S
from scribeflow.operators import validate as V
from scribeflow.operators.scrub import scrub
from scribeflow.operators.tokens import match_dictionary
from scribeflow.plans.materialize import materialize, release
from scribeflow.sources import reference as R
from scribeflow.sources.local import local_df

log = logging.getLogger(__name__)

DEFAULT_STAGES = [k for k, _ in fv.STAGES] + ["packaging"]
# Documents that arrive with text (no OCR word tables) start at scrubbing.
TEXT_STAGES = ["phi_scrubbing", "classification", "extraction", "validation", "summarization", "packaging"]


@dataclass
class Dictionaries:
    phrases: DataFrame
    lexicon: DataFrame
    known_tests: DataFrame
    rules: DataFrame
    ranges: DataFrame
    aliases: DataFrame
    layman: DataFrame

    @staticmethod
    def from_json(doc_keywords: DataFrame, lab_ranges: DataFrame | None, medical_entities: DataFrame | None,
                  layman_terms: DataFrame, rules_json: DataFrame | None = None) -> "Dictionaries":
        """Build every table from JSON-text DataFrames (``load_reference_json``).
        ``rules_json`` defaults to ``lab_ranges`` (same file in the reference).  A dictionary
        whose text is not JSON raises; without the lab or entity dictionary the lexicon is smaller."""
        for name, df in (("document_keywords", doc_keywords), ("lab_ranges", lab_ranges), ("medical_entities", medical_entities),
                         ("layman_terms", layman_terms), ("rules", rules_json)):
            if df is not None:
                R.assert_parsed(df, name)
        if lab_ranges is None:
            lab_ranges = R.json_value(doc_keywords.sparkSession, {})
        rules, ranges, aliases = R.rule_tables(rules_json if rules_json is not None else lab_ranges)
        return Dictionaries(
            phrases=R.doc_phrase_table(doc_keywords),
            lexicon=R.entity_lexicon_table(lab_ranges, medical_entities),
            known_tests=X.known_tests_from_lab(lab_ranges),
            rules=rules, ranges=ranges, aliases=aliases,
            layman=R.layman_table(layman_terms),
        )

    def localize(self, limit: int = R.BROADCAST_ROW_LIMIT) -> "Dictionaries":
        """Keep a copy of every table, so that the JSON is not flattened again in every plan:
        as a local relation up to ``limit`` rows, as a stage table beyond (which is joined by
        shuffle where it is too large to broadcast).
        """
        if getattr(self, "_local", False):
            return self
        names = ("phrases", "lexicon", "known_tests", "rules", "ranges", "aliases", "layman")
        # one job counts all tables, another fetches the small ones
        counts = None
        for name in names:
            c = getattr(self, name).agg(F.count("*").alias("n")).select(F.lit(name).alias("t"), "n")
            counts = c if counts is None else counts.unionByName(c)
        small = {r["t"] for r in counts.collect() if r["n"] <= limit}
        tagged = None
        for name in small:
            df = getattr(self, name)
            t = df.select(F.lit(name).alias("_t"), F.to_json(F.struct(*df.columns)).alias("_j"))
            tagged = t if tagged is None else tagged.unionByName(t)
        rows = tagged.collect() if tagged is not None else []
        import json

        out = {}
        for name in names:
            df = getattr(self, name)
            if name not in small:
                out[name] = materialize(df, f"dictionary-{name}")
                continue
            recs = [json.loads(r["_j"]) for r in rows if r["_t"] == name]
            data = [tuple(rec.get(f.name) for f in df.schema.fields) for rec in recs]
            out[name] = local_df(df.sparkSession, data, df.schema)
        d = Dictionaries(**out)
        d._local = True
        return d

    def lexicon_can_overlap(self) -> bool:
        return X.lexicon_can_overlap(self.lexicon)

    @staticmethod
    def defaults(spark: SparkSession) -> "Dictionaries":
        d = R.default_dictionaries(spark)
        return Dictionaries.from_json(d["document_keywords"], d["lab_ranges"], d["medical_entities"], d["layman_terms"])


def combined_dictionary(dicts: Dictionaries) -> DataFrame:
    """Phrases and lexicon terms in one matcher dictionary (kind, label,
    label_ord, toks, n) - one explode + join serves both stages."""
    ph = C.phrase_dictionary(dicts.phrases).select(F.lit("phrase").alias("kind"), "label", "label_ord", "toks", "n")
    lx = X.lexicon_dictionary(dicts.lexicon).select(
        F.lit("entity").alias("kind"), "label", F.lit(0).alias("label_ord"), "toks", "n")
    return ph.unionByName(lx)


@dataclass
class PipelineResult:
    reports: DataFrame          # one row per accepted document (nested report)
    documents: DataFrame        # per-document state: text, status, errors
    entities: DataFrame | None
    findings: DataFrame | None
    validation: DataFrame | None
    summaries: DataFrame | None
    classification: DataFrame | None
    pages: DataFrame | None
    stage_tables: tuple[DataFrame, ...] = ()

    def release(self) -> None:
        """Delete the stage tables of this run; its DataFrames can't be read any more."""
        for df in self.stage_tables:
            release(df)


def run(
    documents: DataFrame,
    dicts: Dictionaries,
    active_stages: list[str] | None = None,
    ocr_words: DataFrame | None = None,
    table_rows: DataFrame | None = None,
    scrub_rules: tuple[tuple[str, str], ...] = (),
    min_confidence: float = fv.MIN_CONFIDENCE,
    stage_tables: bool = True,
) -> PipelineResult:
    """Run the configured stages over ``documents``.

    ``documents``: doc_id, file_name, file_type, file_size_bytes and, when the
    OCR stage is not used, ``full_text``.  ``ocr_words`` feeds the OCR stage;
    ``table_rows`` (doc_id, page_number, table_index, row_index, cells) feeds
    table extraction for ``.pdf`` documents.  Unknown stage names are
    skipped with a warning; packaging always runs last.

    With ``stage_tables`` the intermediates read by several later steps
    (pages, hits, per-document state, entities, validation report) are
    written once to the shared checkpoint folder and read back.
    """
    kept: list[DataFrame] = []

    def keep(df: DataFrame, name: str) -> DataFrame:
        if not stage_tables:
            return df
        kept.append(materialize(df, name))
        return kept[-1]

    dicts = dicts.localize()
    stages = list(active_stages or DEFAULT_STAGES)
    known = {k for k, _ in fv.STAGES}
    for s_ in stages:
        if s_ not in known and s_ != "packaging":
            # reported in the log only; the document's warnings list stays empty
            log.warning("Unknown stage '%s' in settings. Skipping.", s_)
    # stages run in the order they are configured in; a name given twice runs once
    stages = [s for s in dict.fromkeys(stages) if s in known]
    order = list(stages)

    def before(first: str, then: str) -> bool:
        return first in order and (then not in order or order.index(first) < order.index(then))

    spark = documents.sparkSession
    meta_cols = [c for c in ("doc_id", "file_name", "file_type", "file_size_bytes") if c in documents.columns]

    # ---- text source and the per-document state (no text column in it) ----
    gate_cols: dict[str, Column] = {}
    pages = None
    d = documents.select(*meta_cols)
    # processed images exist only when the preprocessing stage ran; a word
    # table stands for them
    if "ocr" in stages and ocr_words is not None and before("preprocessing", "ocr"):
        pages = keep(O.pages(ocr_words), "pages")
        text = O.full_text(pages).select("doc_id", F.col("full_text").alias("text"))
        has = pages.select("doc_id").distinct().withColumn("_has_pages", F.lit(True))
        d = d.join(R.by_key(has), "doc_id", "left")
        gate_cols["ocr"] = K.gate_error("ocr", "processed_image_paths", F.lit(False), F.col("_has_pages").isNull())
    elif "ocr" in stages:
        text = documents.select("doc_id", F.lit("").alias("text")).where(F.lit(False))
        gate_cols["ocr"] = K.gate_error("ocr", "processed_image_paths", F.lit(False), F.lit(True))
    elif "full_text" in documents.columns:
        text = documents.select("doc_id", F.col("full_text").alias("text"))
    else:
        text = documents.select("doc_id", F.lit("").alias("text")).where(F.lit(False))

    if "phi_scrubbing" in stages:
        text = text.select("doc_id", scrub(F.col("text"), scrub_rules).alias("text"))
        # documents whose (scrubbed) text is empty or null: with the identity
        # scrub this is a pushed-down ``text = ''`` scan that skips row groups
        empty_ids = text.where(F.coalesce(F.col("text"), F.lit("")) == "").select("doc_id").withColumn("_empty", F.lit(True))
        d = d.join(R.by_key(empty_ids), "doc_id", "left")
        text_empty = F.col("_empty").isNotNull()
        if "_has_pages" in d.columns:
            text_empty = text_empty | F.col("_has_pages").isNull()
    else:
        text = text.where(F.lit(False))
        text_empty = F.lit(True)
    # text that is recognized after scrubbing, or scrubbed after a stage that reads it, is still empty there
    if "ocr" in stages and not before("ocr", "phi_scrubbing"):
        text_empty = F.lit(True)
    empty_at = {s: text_empty if before("phi_scrubbing", s) else F.lit(True) for s in ("classification", "extraction")}
    for s in ("classification", "extraction"):
        if s in stages:
            gate_cols[s] = K.gate_error(s, "scrubbed_text", F.lit(False), empty_at[s])
    if "summarization" in stages and not before("validation", "summarization"):
        gate_cols["summarization"] = K.gate_error("summarization", "validation_report", F.lit(True), F.lit(False))

    # ---- one matching pass over the text serves both text stages ----------
    ents = finds = rep = summ = hits = None
    has_cls = "classification" in stages
    tdocs = text.where(F.col("text").isNotNull() & (F.col("text") != ""))
    if has_cls or ("extraction" in stages):
        dic = combined_dictionary(dicts)
        m = int(dic.agg(F.max("n")).first()[0] or 1)
        dic = R.broadcast_checked(dic)
        hits = match_dictionary(
            tdocs, dic, m, text_col="text",
            want_offsets=F.col("kind") == "entity",
            window_labels=tuple(fv.VALUE_LABELS), window_chars=fv.VALUE_WINDOW,
        ).drop("first_piece", "last_piece")
        hits = keep(hits, "hits")
    if has_cls:
        matches = C.weigh_hits(hits.where(F.col("kind") == "phrase"), dicts.phrases)
        types = [(r["doc_type"], r["type_ord"], r["total"]) for r in R.type_totals(dicts.phrases).collect()]
        cls = C.classify_pivot(d.where(~empty_at["classification"]).select("doc_id"), matches, types, min_confidence)
        d = d.join(R.by_key(cls), "doc_id", "left")
        gate_cols["classification_run"] = K.stage_error("classification", F.col("class_error"))

    # ---- first failure decides; later stages are masked -------------------
    d = K.route(d, order, gate_cols)
    if has_cls:
        ok = K.reached("classification_done", order)
        d = d.withColumn("document_type", F.when(ok, F.col("document_type"))) \
            .withColumn("confidence", F.when(ok, F.col("confidence"))) \
            .withColumn("keywords_found", F.when(ok, F.col("keywords_found")))
    d = d.withColumn("warnings", F.array().cast("array<string>"))
    d = d.drop(*[c for c in ("_empty", "_has_pages", "class_error") if c in d.columns])
    d = keep(d, "doc_state")

    def reached(point: str) -> DataFrame:
        return d.where(K.reached(point, order)).select("doc_id")

    cls_out = d.where(F.col("document_type").isNotNull()).select(
        "doc_id", "document_type", "confidence", "keywords_found") if has_cls else None
    if "extraction" in stages:
        ent_hits = hits.where(F.col("kind") == "entity").drop("kind", "label_ord")
        txt = X.text_entities(tdocs, dicts.lexicon, hits=ent_hits, resolve=dicts.lexicon_can_overlap())
        tab = None
        if table_rows is not None:
            tab = X.table_entities(table_rows, d.select("doc_id", "file_type"), dicts.known_tests)
        ents = keep(X.merge_entities(tab, txt).join(R.by_key(reached("extraction_done")), "doc_id", "left_semi"), "entities")
    if stage_tables and hits is not None:
        # classification and entities are stage tables of their own now
        kept.remove(hits)
        release(hits)
    if "validation" in stages:
        e = ents if ents is not None else _empty_entities(spark)
        finds = V.findings(e, dicts.rules, dicts.ranges, dicts.aliases)
        rep = keep(V.validation_report(reached("validation"), finds), "validation")
    if "summarization" in stages:
        e = ents if ents is not None else _empty_entities(spark)
        sdocs = d.join(R.by_key(reached("summarization")), "doc_id", "left_semi")
        summ = S.summarize(sdocs, cls_out, e, rep, dicts.layman)

    from scribeflow.operators.package import build_reports

    reports = build_reports(d, None, ents, rep, summ)
    return PipelineResult(reports, d, ents, finds, rep, summ, cls_out, pages, tuple(kept))


def _empty_entities(spark: SparkSession) -> DataFrame:
    return local_df(spark, [], "doc_id long, seq int, type string, name string, value_text string, value_num double, "
                               "unit string, confidence double, source string, start_char long, end_char long, page int")
