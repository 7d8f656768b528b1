"""As-of and interval joins, frames, cubes and sketches against plain versions."""

import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from scribeflow.operators import rollups, timeline

T0 = datetime(2024, 3, 1, tzinfo=timezone.utc)


def _time(hours):
    return None if hours is None else T0 + timedelta(hours=hours)


@pytest.fixture(scope="module")
def moments():
    rng = random.Random(4)
    left = [(k, rng.choice([1, 1, 1, 2, 3, None]), rng.choice([None, *range(0, 200)]), f"x{k}") for k in range(120)] + [(0, 1, 5, "again")] * 2
    right = [(1000 + k, rng.choice([1, 1, 2, 4, None]), rng.choice([None, *range(0, 200)]), rng.choice([None, 0.5, 1.5])) for k in range(150)]
    right += [(2000, 1, 5, 9.0), (2001, 1, 5, None)]
    return left, right


@pytest.mark.parametrize("strict", [True, False])
@pytest.mark.parametrize("width", [2 * timeline.HOUR, timeline.DAY, 4000 * timeline.DAY])
def test_last_before(spark, moments, strict, width):
    left, right = moments
    l = spark.createDataFrame([(i, k, _time(t), x) for i, k, t, x in left], "id long, who long, at timestamp, v string")
    r = spark.createDataFrame([(i, k, _time(t), v) for i, k, t, v in right], "eid long, who long, ts timestamp, val double")
    l = l.withColumns({c: F.lit(c) for c in ("k0", "t", "side", "b", "row", "tie", "ask")})
    got = timeline.last_before(l, r, [("who", "who")], "at", "ts", {"eid": "eid", "val": "val"}, ["eid"], width, strict)
    assert got.columns == l.columns + ["eid", "val"]
    want = Counter()
    for i, k, t, x in left:
        before = [(u, e, v) for e, q, u, v in right if None not in (k, t, q, u) and q == k and (u < t or (u == t and not strict))]
        best = max(before, key=lambda z: z[:2]) if before else (None, None, None)
        want[i, x, best[1], best[2]] += 1
    assert Counter((r["id"], r["v"], r["eid"], r["val"]) for r in got.collect()) == want


def test_last_before_has_no_window_over_a_whole_key(spark):
    l = spark.range(10).select("id", F.lit(1).alias("who"), F.timestamp_seconds("id").alias("at"))
    plan = timeline.last_before(l, l, [("who", "who")], "at", "at", {"was": "id"}, ["id"])._jdf.queryExecution().optimizedPlan().toString()
    windows = [x for x in plan.splitlines() if "Window [" in x]
    # rows by (key, stretch), heads by (key, group of stretches); only groups' last rows by key
    assert len(windows) == 3 and sum(", b#" in w.split("], [k0", 1)[1].split("]")[0] for w in windows) == 2


def test_last_before_of_nothing(spark, moments):
    l = spark.createDataFrame([(1, 1, T0)], "id long, who long, at timestamp")
    none = l.where("false")
    assert timeline.last_before(none, l, [("who", "who")], "at", "at", {"was": "id"}, ["id"]).count() == 0
    assert [r["was"] for r in timeline.last_before(l, none, [("who", "who")], "at", "at", {"was": "id"}, ["id"]).collect()] == [None]


def test_overlaps(spark):
    rng = random.Random(6)

    def span():
        s = rng.choice([None, *range(0, 400)])
        e = rng.choice([None, *[(s or 0) + d for d in (0, 1, 1, 2, 5, 30, 300, 9000, -3)]])
        return s, e

    left = [(k, rng.choice([1, 1, 2, None]), *span()) for k in range(90)] + [(500, 1, 10, 20)] * 2
    right = [(k, rng.choice([1, 1, 3, None]), *span()) for k in range(90)] + [(600, 1, 20, 30), (601, 1, 19, 21), (602, 1, 0, 10), (603, 1, -10, 500)]
    schema = "id long, who long, a timestamp, b timestamp"
    l, r = (spark.createDataFrame([(i, k, _time(s), _time(e)) for i, k, s, e in rows], schema) for rows in (left, right))
    l = l.withColumns({c: F.lit(c) for c in ("k0", "s", "e", "at", "cell", "level")})
    got = timeline.overlaps(l, r, [("who", "who")], ("a", "b"), ("a", "b"), {"i": "id"}, {"j": "id"})
    want = Counter()
    for i, k, s, e in left:
        for j, q, u, v in right:
            if None not in (k, s, e, q, u, v) and k == q and s < e and u < v and s < v and u < e:
                want[i, j, (min(e, v) - max(s, u)) * timeline.HOUR] += 1
    assert Counter(map(tuple, got.collect())) == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert timeline.overlaps(l.where("false"), r, [("who", "who")], ("a", "b"), ("a", "b"), {"i": "id"}, {"j": "id"}).count() == 0


def test_rolling_mean(spark):
    rng = random.Random(7)
    rows = [(k, rng.choice(["a", "a", "b", None]), rng.choice([None, *range(0, 100)]), rng.choice([None, float("nan"), 1.25, 7.5, -2.0])) for k in range(200)]
    rows += [rows[3], rows[3]]
    df = spark.createDataFrame([(i, k, _time(t), v) for i, k, t, v in rows], "id long, who string, at timestamp, val double")
    df = df.withColumns({c: F.lit(c) for c in ("t", "b", "own", "v")})
    got = timeline.rolling_mean(df, ["who"], "at", "val", 24 * timeline.HOUR)
    assert got.columns == df.columns + ["n_past", "mean_past"]
    want = Counter()
    for i, k, t, v in rows:
        past = [x for _, q, u, x in rows if None not in (k, t, u) and q == k and t - 24 <= u <= t and x is not None and x == x]
        want[i, len(past), sum(past) / len(past) if past else None] += 1
    assert Counter((r["id"], r["n_past"], r["mean_past"]) for r in got.collect()) == want


def test_cube_and_sets(spark):
    rows = [("a", None, 1), ("a", "x", 2), ("b", "x", None), ("a", "x", 4)]
    df = spark.createDataFrame(rows, "p string, q string, n int")
    got = {(r["p"], r["q"], r["grouping_id"]): (r["s"], r["c"]) for r in rollups.cube(df, ["p", "q"], [F.sum("n").alias("s"), F.count("*").alias("c")]).collect()}
    want = defaultdict(lambda: [None, 0])
    for p, q, n in rows:
        for gid in range(4):
            w = want[p if gid < 2 else None, q if gid % 2 == 0 else None, gid]
            w[0] = w[0] if n is None else (w[0] or 0) + n
            w[1] += 1
    assert got == {k: tuple(v) for k, v in want.items()}
    assert rollups.cube(df.where("false"), ["p", "q"], [F.count("*").alias("c")]).count() == 0
    assert {(r["p"], r["grouping_id"], r["c"]) for r in rollups.rollup(df, ["p", "q"], [F.count("*").alias("c")]).collect() if r["grouping_id"]} == {
        ("a", 1, 3), ("b", 1, 1), (None, 3, 4)}
    got = rollups.sets(df, [["p"], []], ["p", "q"], [F.count("*").alias("c")])
    assert {(r["p"], r["grouping_id"], r["c"]) for r in got.collect()} == {("a", 1, 3), ("b", 1, 1), (None, 3, 4)}


def test_merged_sketches_answer_like_exact_counts(spark):
    df = spark.range(60000).select((F.col("id") % 7).alias("d"), (F.col("id") % 9001).alias("who"),
                                   F.when(F.col("id") % 50 == 0, float("nan")).otherwise(F.pmod(F.col("id") * 7919, F.lit(10007)) / 10.0).alias("v"))
    state = rollups.sketches(df, ["d"], "who", "v")
    total = rollups.answers(rollups.merged(state.withColumn("d", F.lit("all")), ["d"]), [0.5, 0.9]).first()
    assert total["n"] == 60000 and abs(total["distinct_about"] - 9001) <= rollups.DISTINCT_ERROR * 9001
    values = sorted(r["v"] for r in df.where("not isnan(v)").select("v").collect())
    for q in (0.5, 0.9):
        at = sum(v <= total[f"q{round(q * 100)}"] for v in values) / len(values)
        assert abs(at - q) <= rollups.RANK_ERROR
    empty = rollups.answers(rollups.sketches(df.where("isnan(v)"), ["d"], "who", "v"), [0.5])
    assert {r["q50"] for r in empty.collect()} == {None}
    assert rollups.answers(rollups.sketches(df.where("false"), ["d"], "who", "v"), [0.5]).count() == 0


def test_intervals_go_to_the_levels_they_can_meet(spark):
    day = timeline.DAY
    d = spark.createDataFrame([(k * day, (k + n) * day, level) for k in range(40) for n, level in ((1, 0), (3, 2), (30, 5), (50, 6))], "s long, e long, level int")
    rows = {r["level"]: {x["at"] for x in g} for r in d.select("level").distinct().collect()
            for g in [timeline.cells(d.where(f"level = {r['level']}"), [5], day).collect()] if len(g) <= 80}
    assert rows == {0: {5}, 2: {5}, 5: {5}, 6: {6}}
    assert timeline.cells(d, [], day).count() == 0


def test_fixture_texts_are_dealt_by_their_bytes(spark, tmp_path, monkeypatch):
    from scribeflow.sources import fixtures as fx

    spark.createDataFrame([(k, f"word{k % 10} " * 10) for k in range(200)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(fx, "PART_BYTES", 200)
    assert fx.ocr_words(spark, str(tmp_path)).select(F.spark_partition_id()).distinct().count() > 32
    assert [fx.parts(n) for n in (None, 0, 200 * 50, 200 * 50 + 1)] == [32, 32, 50, 51]
