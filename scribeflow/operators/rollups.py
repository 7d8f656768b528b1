"""Aggregates over several levels at once: grouping sets over findings, and sketches that are
stored, merged and asked later.

Defined results: a null in a grouping column is a value of its own, told apart from the sum over
that column by ``grouping_id``; an empty table has no rows (the grand total of a cube of nothing
is left out); sketches skip null and non-finite values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sketch sizes, and the errors they are held to: HLL has a relative standard error of about
#: 1.04 / sqrt(2^14) = 0.8 %, KLL with 800 a rank error of about 0.4 %.
HLL_BITS, KLL_SIZE = 14, 800
DISTINCT_ERROR, RANK_ERROR = 0.04, 0.02


def cube(rows: DataFrame, by: Sequence[str], aggregates: Sequence[Column]) -> DataFrame:
    """Every combination of the columns ``by`` in one pass: the columns (null where summed over),
    ``grouping_id`` (bit k from the right set: the k-th last column is summed over) and the
    aggregates.  Partial aggregation comes before the shuffle, so a hot value is one row a task."""
    return rows.cube(*by).agg(F.grouping_id().alias("grouping_id"), F.count("*").alias("__n"), *aggregates).where("__n > 0").drop("__n")


def rollup(rows: DataFrame, by: Sequence[str], aggregates: Sequence[Column]) -> DataFrame:
    """The prefixes of ``by`` only."""
    return rows.rollup(*by).agg(F.grouping_id().alias("grouping_id"), F.count("*").alias("__n"), *aggregates).where("__n > 0").drop("__n")


def sets(rows: DataFrame, groupings: Sequence[Sequence[str]], by: Sequence[str], aggregates: Sequence[Column]) -> DataFrame:
    """Only the given combinations of ``by``."""
    out = rows.groupingSets([[F.col(c) for c in g] for g in groupings], *by).agg(
        F.grouping_id().alias("grouping_id"), F.count("*").alias("__n"), *aggregates)
    return out.where("__n > 0").drop("__n")


def sketches(rows: DataFrame, by: Sequence[str], distinct: str, value: str) -> DataFrame:
    """Sketch state as columns: (by, n, distinct_sketch, value_sketch).  Written as a table, it
    answers for any union of its rows without the input."""
    number = F.col(value).cast("double")
    finite = F.when(F.abs(number) < F.lit(float("inf")), number)
    return rows.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.hll_sketch_agg(F.col(distinct).cast("long"), HLL_BITS).alias("distinct_sketch"),
        F.kll_sketch_agg_double(finite, KLL_SIZE).alias("value_sketch"))


def merged(state: DataFrame, by: Sequence[str]) -> DataFrame:
    """Sketch state of fewer groups, from sketch state alone."""
    return state.groupBy(*by).agg(
        F.sum("n").alias("n"), F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.kll_merge_agg_double("value_sketch", KLL_SIZE).alias("value_sketch"))


def answers(state: DataFrame, quantiles: Sequence[float]) -> DataFrame:
    """(by, n, distinct_about, q<percent> ...) of sketch state; a quantile of no values is null."""
    some = F.kll_sketch_get_n_double("value_sketch") > 0
    return state.select(
        *(c for c in state.columns if not c.endswith("_sketch")), F.hll_sketch_estimate("distinct_sketch").alias("distinct_about"),
        *(F.when(some, F.kll_sketch_get_quantile_double("value_sketch", F.lit(q))).alias(f"q{round(q * 100)}") for q in quantiles))
