"""OCR word tables -> page text, page statistics and document text.

Line segmentation is adjacency, not grouping: a new line starts whenever the
(block, paragraph, line) triple differs from the previous kept word of the
page, found with ``lag`` over the page ordered by ``seq`` and numbered with a
running sum.  The window's hash partitioning on (doc, page) is reused by the
two following aggregations (lines, then pages); the page statistics and the
renumbering shuffle on their own keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scribeflow import fixed_values as fv
from scribeflow.functions.text import py_float, py_strip
from scribeflow.sources.reference import by_key

PAGE = ["doc_id", "page_number"]


def clean_words(words: DataFrame) -> DataFrame:
    """Strip each word; drop blank ones."""
    return words.withColumn("word", py_strip("text")).where(F.col("word") != "")


def line_segments(words: DataFrame) -> DataFrame:
    """Kept words with ``line_id`` (1-based per page) and ``new_par``."""
    w = Window.partitionBy(*PAGE).orderBy("seq")
    k = clean_words(words)
    prev = F.lag(F.struct("block_num", "par_num", "line_num")).over(w)
    k = k.withColumn("_prev", prev)
    new_line = F.col("_prev").isNull() | (F.col("_prev") != F.struct("block_num", "par_num", "line_num"))
    new_par = F.col("_prev").isNull() | (F.col("_prev.block_num") != F.col("block_num")) | (
        F.col("_prev.par_num") != F.col("par_num"))
    k = k.withColumn("new_line", new_line).withColumn("new_par", new_par)
    k = k.withColumn("line_id", F.sum(F.col("new_line").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return k.drop("_prev")


def page_text(words: DataFrame) -> DataFrame:
    """(doc_id, page_number, raw_text): words joined by a blank, lines by a
    newline, one empty line where the paragraph changes, stripped."""
    seg = line_segments(words)
    lines = seg.groupBy(*PAGE, "line_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "word"))), lambda x: x["word"]), " ").alias("line"),
        F.min_by("new_par", "seq").alias("new_par"),
    )
    piece = F.concat(
        F.when(F.col("line_id") == 1, F.lit("")).when(F.col("new_par"), F.lit("\n\n")).otherwise(F.lit("\n")),
        F.col("line"),
    )
    pages = lines.groupBy(*PAGE).agg(F.array_sort(F.collect_list(F.struct("line_id", piece.alias("p")))).alias("ls"))
    return pages.select(*PAGE, py_strip(F.array_join(F.transform("ls", lambda x: x["p"]), "")).alias("raw_text"))


def page_stats(words: DataFrame) -> DataFrame:
    """(doc_id, page_number, conf_mean, n_lines) over all rows of the page
    (blank and structural rows included)."""
    # a step a column: used more than once, a step is not copied into the next, so a word is parsed once
    c = F.col("_c")
    w = words.withColumn("_conf", py_strip("conf")).withColumn("_c", py_float("_conf"))
    return w.groupBy(*PAGE).agg(
        F.avg(F.when((c > 0) & ~F.isnan(c), c)).alias("_avg"),
        F.count_distinct(F.when(F.col("block_num") > 0, F.struct("block_num", "par_num", "line_num"))).alias("n_lines"),
    ).select(*PAGE, F.coalesce(F.least(F.col("_avg") / 100.0, F.lit(1.0)), F.lit(0.0)).alias("conf_mean"), "n_lines")


def pages(words: DataFrame) -> DataFrame:
    """pages(doc_id, page_number, raw_text, confidence, num_lines); blank page
    text forces confidence 0.0 and 0 lines; pages renumbered 1..n in order."""
    st = page_stats(words)
    tx = page_text(words)
    p = st.join(by_key(tx), PAGE, "left")
    blank = F.col("raw_text").isNull() | (F.col("raw_text") == "")
    p = p.select(
        *PAGE,
        F.coalesce("raw_text", F.lit("")).alias("raw_text"),
        F.when(blank, F.lit(0.0)).otherwise(F.col("conf_mean")).alias("confidence"),
        F.when(blank, F.lit(0)).otherwise(F.col("n_lines")).cast("int").alias("num_lines"),
    )
    return renumber(p)


def renumber(p: DataFrame) -> DataFrame:
    """Consecutive page numbers 1..n in input page order (no gaps)."""
    w = Window.partitionBy("doc_id").orderBy("page_number")
    return p.withColumn("source_page", F.col("page_number")).withColumn("page_number", F.row_number().over(w))


def full_text(p: DataFrame) -> DataFrame:
    """(doc_id, full_text): pages in order joined with the page-break line."""
    return p.groupBy("doc_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_number", "raw_text"))),
                                 lambda x: x["raw_text"]), fv.PAGE_BREAK).alias("full_text")
    )


def ocr_stats(p: DataFrame) -> DataFrame:
    """(doc_id, page_count, avg_confidence, total_lines)."""
    return p.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("page_count"),
        F.avg("confidence").alias("avg_confidence"),
        F.sum("num_lines").cast("long").alias("total_lines"),
    )
