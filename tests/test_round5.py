"""Helpers that run once a row: a word's confidence is parsed once, and a plain word is not searched."""

import random

from pyspark.sql import functions as F

from scribeflow.functions.text import py_strip
from scribeflow.operators.ocr_text import page_stats


def test_a_words_confidence_is_parsed_once(spark):
    rows = [(1, 1, 1, 1, 1, " 50 "), (1, 1, 1, 1, 1, "-1"), (1, 1, 1, 1, 2, "nan"), (1, 1, 2, 1, 1, "1_00"), (1, 1, 0, 1, 1, "x"), (1, 1, 1, 1, 1, "0"),
            (1, 1, 1, 1, 1, None), (2, 1, 1, 1, 1, "inf")]
    words = spark.createDataFrame(rows, "doc_id long, page_number int, block_num int, par_num int, line_num int, conf string")
    stats = page_stats(words)
    assert sorted(map(tuple, stats.collect())) == [(1, 1, 0.75, 3), (2, 1, 1.0, 1)]
    plan = stats._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RLIKE") == 1 and plan.lower().count("regexp_replace") == 1, plan


def test_strip_of_a_column_is_pythons(spark):
    rnd = random.Random(5)
    chars = [chr(c) for c in (9, 10, 11, 12, 13, 28, 31, 32, 0x85, 0xA0, 0x1680, 0x2000, 0x2029, 0x202F, 0x3000)] + list("aZ!~_.0") * 3 + ["é", "\U0001F600", "​", "\x7f"]
    vals = [None, "", " ", "a"] + ["".join(rnd.choices(chars, k=rnd.randint(0, 5))) for _ in range(3000)]
    d = spark.createDataFrame([(v,) for v in vals], "s string").select("s", py_strip("s").alias("a"), py_strip(F.col("s")).alias("b"))
    for s, a, b in d.collect():
        assert a == b == (None if s is None else s.strip())
    assert "ascii" in d.select("a")._jdf.queryExecution().optimizedPlan().toString()
