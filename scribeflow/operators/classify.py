"""Document classification by weighted phrase scoring.

hits (doc, type, span) -> per (doc, type) score = sum of weights per
occurrence -> normalise by the type's reachable total -> arg-max (ties to the
earlier dictionary type) -> threshold.  A document without any hit is
``unknown`` with 0.0: every type then scores 0 and no zero-filled rows are
needed (scores are never negative, so a type with hits always beats one
without).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scribeflow import fixed_values as fv
from scribeflow.operators.tokens import match_dictionary
from scribeflow.sources.reference import bcast, by_key, type_totals


def phrase_dictionary(phrases: DataFrame) -> DataFrame:
    """Matcher dictionary: one entry per (type, token sequence)."""
    return (
        phrases.groupBy("doc_type", "type_ord", "toks", "n").agg(F.lit(1).alias("_one"))
        .select(F.col("doc_type").alias("label"), F.col("type_ord").alias("label_ord"), "toks", "n")
    )


def max_tokens(dictionary: DataFrame) -> int:
    """Longest entry in tokens (tiny action on a dictionary)."""
    return int(dictionary.agg(F.max("n")).first()[0] or 1)


def phrase_matches(docs: DataFrame, phrases: DataFrame, text_col: str = "text", broadcast: bool = True) -> DataFrame:
    """All phrase hits: (doc_id, tok_pos, doc_type, type_ord, span_text, weight)."""
    dic = phrase_dictionary(phrases)
    m = max_tokens(dic)
    dic_b = bcast(dic) if broadcast else dic
    hits = match_dictionary(docs, dic_b, m, text_col=text_col)
    return weigh_hits(hits, phrases, broadcast)


def weigh_hits(hits: DataFrame, phrases: DataFrame, broadcast: bool = True) -> DataFrame:
    """Weight per occurrence = weight of the phrase spelled like the span
    (lower-cased) under that type, 1.0 when none is."""
    w = phrases.select(F.col("doc_type").alias("label"), F.col("phrase_lower").alias("_pl"), F.col("weight").alias("_w"))
    w = bcast(w) if broadcast else w
    j = hits.join(w, (hits["label"] == w["label"]) & (F.lower(hits["span_text"]) == w["_pl"]), "left")
    return j.select(
        hits["doc_id"], "tok_pos", hits["label"].alias("doc_type"), F.col("label_ord").alias("type_ord"),
        "span_text", F.coalesce("_w", F.lit(1.0)).alias("weight"),
    )


def keyword_scores(matches: DataFrame) -> DataFrame:
    """(doc_id, doc_type, type_ord, score, keywords) per type with hits."""
    return matches.groupBy("doc_id", "doc_type", "type_ord").agg(
        F.sum("weight").alias("score"),
        F.array_sort(F.collect_set("span_text")).alias("keywords"),
    )


def normalize_scores(scores: DataFrame, totals: DataFrame) -> DataFrame:
    t = bcast(totals.select("doc_type", "total"))
    return scores.join(t, "doc_type").withColumn(
        "norm", F.when(F.col("total") > 0, F.col("score") / F.col("total")).otherwise(F.lit(0.0))
    )


def classify_scored(docs: DataFrame, norm: DataFrame, min_confidence: float = fv.MIN_CONFIDENCE) -> DataFrame:
    """Arg-max + threshold.  Output per document:
    (doc_id, document_type, confidence, keywords_found, class_error)."""
    best = norm.groupBy("doc_id").agg(
        F.max_by(F.struct("doc_type", "norm", "keywords"), F.struct(F.col("norm"), -F.col("type_ord"))).alias("b")
    )
    j = docs.select("doc_id").join(by_key(best), "doc_id", "left")
    conf = F.coalesce(F.col("b.norm"), F.lit(0.0))
    low = conf < F.lit(min_confidence)
    return j.select(
        "doc_id",
        F.when(F.col("b").isNull() | low, F.lit("unknown")).otherwise(F.col("b.doc_type")).alias("document_type"),
        conf.alias("confidence"),
        F.when(F.col("b").isNull() | low, F.array().cast("array<string>")).otherwise(F.col("b.keywords")).alias("keywords_found"),
        F.when(~low & (conf > 1.0), F.concat(
            F.lit("Classification failed: 1 validation error for DocumentClassification\nconfidence\n"
                  "  Input should be less than or equal to 1 [type=less_than_equal, input_value="),
            conf.cast("string"), F.lit(", input_type=float]"))
        ).alias("class_error"),
    )


def classify(docs: DataFrame, phrases: DataFrame, text_col: str = "text",
             min_confidence: float = fv.MIN_CONFIDENCE, matches: DataFrame | None = None) -> DataFrame:
    """Full classification of ``docs`` (doc_id, text)."""
    if matches is None:
        matches = phrase_matches(docs, phrases, text_col)
    norm = normalize_scores(keyword_scores(matches), type_totals(phrases))
    return classify_scored(docs, norm, min_confidence)


def classify_pivot(doc_ids: DataFrame, matches: DataFrame, types: list[tuple[str, int, float]],
                   min_confidence: float = fv.MIN_CONFIDENCE) -> DataFrame:
    """Same result as ``classify`` in one aggregation.

    With the (few) document types and their reachable totals known from the
    dictionary, every type's score is a conditional sum in a single
    ``groupBy(doc_id)`` (map-side partial aggregation intact); the arg-max
    and threshold are then plain expressions - one shuffle instead of two
    plus joins.  ``types`` is [(doc_type, type_ord, total)].
    """
    types = sorted(types, key=lambda t: t[1])
    aggs = []
    for i, (t, _, _) in enumerate(types):
        is_t = F.col("doc_type") == t
        aggs.append(F.sum(F.when(is_t, F.col("weight"))).alias(f"_s{i}"))
        aggs.append(F.collect_set(F.when(is_t, F.col("span_text"))).alias(f"_k{i}"))
    per_doc = matches.groupBy("doc_id").agg(*aggs)
    j = doc_ids.select("doc_id").join(by_key(per_doc), "doc_id", "left")
    best = None
    for i, (t, _, total) in enumerate(types):
        norm = F.coalesce(F.col(f"_s{i}"), F.lit(0.0)) / F.lit(total) if total > 0 else F.lit(0.0)
        cand = F.struct(norm.alias("norm"), F.lit(-i).alias("neg_ord"), F.lit(t).alias("doc_type"),
                        F.array_sort(F.coalesce(F.col(f"_k{i}"), F.array().cast("array<string>"))).alias("keywords"),
                        F.col(f"_s{i}").isNotNull().alias("hit"))
        best = cand if best is None else F.greatest(best, cand)
    if best is None:
        return doc_ids.select("doc_id", F.lit("unknown").alias("document_type"), F.lit(0.0).alias("confidence"),
                              F.array().cast("array<string>").alias("keywords_found"),
                              F.lit(None).cast("string").alias("class_error"))
    j = j.withColumn("_b", best)
    conf = F.col("_b.norm")
    low = (conf < F.lit(min_confidence)) | ~F.col("_b.hit")
    return j.select(
        "doc_id",
        F.when(low, F.lit("unknown")).otherwise(F.col("_b.doc_type")).alias("document_type"),
        F.when(F.col("_b.hit"), conf).otherwise(F.lit(0.0)).alias("confidence"),
        F.when(low, F.array().cast("array<string>")).otherwise(F.col("_b.keywords")).alias("keywords_found"),
        F.when(~low & (conf > 1.0), F.concat(
            F.lit("Classification failed: 1 validation error for DocumentClassification\nconfidence\n"
                  "  Input should be less than or equal to 1 [type=less_than_equal, input_value="),
            conf.cast("string"), F.lit(", input_type=float]"))
        ).alias("class_error"),
    )
