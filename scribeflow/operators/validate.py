"""Validation of entities against reference rules.

The rule side is prepared once on the (small) dictionary tables:

    lookup(section, match_key -> rule)   exact key (rank 0) beats alias (rank 1),
                                         then file order - resolved per match key
    rule_arr(section, key -> ranges[])   ranges sorted by (status priority, list order)
                                         + the formatted normal range

Entities then take one broadcast left join per table and pick the first
matching range with ``filter(...)[0]`` - no per-entity shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scribeflow import fixed_values as fv
from scribeflow.functions.text import normalize_key
from scribeflow.sources.reference import bcast, by_key

FINDING_COLS = ["doc_id", "seq", "test_name", "value_text", "value_num", "unit", "status", "reason", "reference_range"]


def rule_lookup_table(rules: DataFrame, aliases: DataFrame) -> DataFrame:
    """(section, match_key, rule_key, rule_ord): which rule a normalised name hits."""
    exact = rules.where(F.col("n_fields") > 0).select(
        "section", F.col("key").alias("match_key"), F.lit(0).alias("rank"), "rule_ord", F.col("key").alias("rule_key"))
    ali = aliases.select("section", F.col("alias_norm").alias("match_key"), F.lit(1).alias("rank"), "rule_ord",
                         F.col("key").alias("rule_key"))
    u = exact.unionByName(ali)
    return u.groupBy("section", "match_key").agg(
        F.min_by(F.struct("rule_key", "rule_ord"), F.struct("rank", "rule_ord")).alias("r")
    ).select("section", "match_key", "r.rule_key", "r.rule_ord")


def rule_range_arrays(ranges: DataFrame) -> DataFrame:
    """(section, rule_key, ranges array sorted by priority, reference_range)."""
    prio = F.when(F.col("status") == "critical", 0).when(F.col("status") == "abnormal", 1).when(
        F.col("status") == "normal", 2)
    r = ranges.where(prio.isNotNull()).withColumn("prio", prio)
    arr = r.groupBy("section", F.col("key").alias("rule_key")).agg(
        F.array_sort(F.collect_list(F.struct("prio", "range_ord", "status", "lo", "hi", "reason"))).alias("ranges")
    )
    normal = ranges.where(F.col("status") == "normal").groupBy("section", F.col("key").alias("rule_key")).agg(
        F.min_by(F.concat_ws(" - ", "lo_text", "hi_text"), "range_ord").alias("normal_range")
    )
    return arr.join(normal, ["section", "rule_key"], "left")


def sections_with_rules(rules: DataFrame) -> DataFrame:
    return rules.select("section").distinct()


def findings(entities: DataFrame, rules: DataFrame, ranges: DataFrame, aliases: DataFrame) -> DataFrame:
    """One finding per entity: (doc_id, seq, test_name, value_text, value_num,
    unit, status, reason, reference_range)."""
    section = F.when(F.col("type") == "test_result", F.lit("blood_tests")).when(
        F.col("type") == "vital_sign", F.lit("vital_signs"))
    e = entities.withColumn("section", section).withColumn("key_norm", normalize_key("name"))
    secs = bcast(sections_with_rules(rules).select(F.col("section").alias("_s1"), F.lit(True).alias("_has")))
    look = bcast(rule_lookup_table(rules, aliases).select(
        F.col("section").alias("_s2"), F.col("match_key").alias("_mk"), "rule_key"))
    arrs = bcast(rule_range_arrays(ranges).select(
        F.col("section").alias("_s3"), F.col("rule_key").alias("_rk"), "ranges", "normal_range"))
    e = e.join(secs, e["section"] == secs["_s1"], "left")
    e = e.join(look, (e["section"] == look["_s2"]) & (e["key_norm"] == look["_mk"]), "left")
    e = e.join(arrs, (e["section"] == arrs["_s3"]) & (e["rule_key"] == arrs["_rk"]), "left")
    v = F.col("value_num")
    hit = F.filter(
        F.coalesce(F.col("ranges"), F.array()),
        lambda r: (~F.isnan(v) & (r["lo"].isNull() | (v >= r["lo"])) & (r["hi"].isNull() | (v < r["hi"])))
        | (F.isnan(v) & r["lo"].isNull() & r["hi"].isNull()),
    )
    first = F.try_element_at(hit, F.lit(1))
    numeric = v.isNotNull()
    status = (
        F.when(~numeric, F.lit("unknown"))
        .when(F.col("_has").isNull(), F.lit("unknown"))
        .when(F.col("rule_key").isNull(), F.lit("unknown"))
        .when(F.size(hit) > 0, first["status"])
        .otherwise(F.lit("unknown"))
    )
    reason = (
        F.when(~numeric, F.lit(fv.REASON_NON_NUMERIC))
        .when(F.col("_has").isNull(), F.lit(fv.REASON_NO_RULESET))
        .when(F.col("rule_key").isNull(), F.lit(fv.REASON_NOT_FOUND))
        .when(F.size(hit) > 0, first["reason"])
        .otherwise(F.lit(fv.REASON_NO_RANGE))
    )
    matched = numeric & F.col("_has").isNotNull() & F.col("rule_key").isNotNull() & (F.size(hit) > 0)
    return e.select(
        "doc_id", "seq", F.col("name").alias("test_name"), "value_text", "value_num", "unit",
        status.alias("status"), reason.alias("reason"),
        F.when(matched, F.coalesce(F.col("normal_range"), F.lit("N/A"))).alias("reference_range"),
    )


def validation_report(docs: DataFrame, finds: DataFrame) -> DataFrame:
    """Per document: total, valid (normal + unknown), invalid, abnormal and
    critical counts and the ordered critical / abnormal finding lists.
    Documents without entities get zeros and empty lists."""
    st = F.col("status")
    item = F.struct("seq", "test_name", "value_text", "value_num", "unit", "status", "reason", "reference_range")
    agg = finds.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("total_validated"),
        F.count_if(st.isin("normal", "unknown")).alias("valid_count"),
        F.count_if(st.isin("critical", "abnormal")).alias("invalid_count"),
        F.count_if(st == "abnormal").alias("abnormal_count"),
        F.count_if(st == "critical").alias("critical_count"),
        F.array_sort(F.collect_list(F.when(st == "critical", item))).alias("critical_values"),
        F.array_sort(F.collect_list(F.when(st == "abnormal", item))).alias("abnormal_values"),
    )
    j = docs.select("doc_id").join(by_key(agg), "doc_id", "left")
    empty = F.array().cast(agg.schema["critical_values"].dataType)
    return j.select(
        "doc_id",
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in
          ("total_validated", "valid_count", "invalid_count", "abnormal_count", "critical_count")],
        F.coalesce("critical_values", empty).alias("critical_values"),
        F.coalesce("abnormal_values", empty).alias("abnormal_values"),
    )
