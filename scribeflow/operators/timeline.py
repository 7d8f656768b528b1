"""Joins and frames over time: the last value before a moment, overlapping intervals, means over
the past.

Keys are cut into stretches of time, so no task needs all rows of one key: what a stretch needs
from outside is handed to it as a few extra rows.

Defined results: a row with a null key or time is kept where it is asked for (the left side of
``last_before``, ``rolling_mean``), with null as its answer, and never matches; empty tables give
empty results; repeated rows count each time; extra columns pass through.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOUR = 3_600_000_000
DAY = 24 * HOUR
#: Stretches of the first level are handed on over groups of so many.
GROUP = 1024


def free_name(name: str, *frames: DataFrame) -> str:
    """``name``, or a longer one that no frame has."""
    taken = {c.lower() for f in frames for c in f.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _micros(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp"))


def _carried(rows: DataFrame, keys: list[str], widths: list[int]) -> DataFrame:
    """Rows (keys, t, side, tie, v, ask, row) with ``v`` filled from the last one before in the
    order (t, side, tie), stretch by stretch.  ``ask`` marks the rows that want an answer."""
    order = ["t", "side", "tie"]
    if not widths:
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return rows.withColumn("v", F.last("v", ignorenulls=True).over(w))
    width, *rest = widths
    cut = rows.withColumn("b", F.floor(F.col("t") / F.lit(width)).cast("long"))
    none = F.lit(None)
    v_type, row_type, tie_type = (rows.schema[c].dataType for c in ("v", "row", "tie"))
    # a stretch's last value, and the stretches that ask for what came before
    lasts = (cut.where(F.col("v").isNotNull()).groupBy(*keys, "b")
             .agg(F.max_by("v", F.struct(*order)).alias("v"))
             .select(*keys, F.col("b").alias("t"), F.lit(1).alias("side"), none.cast(tie_type).alias("tie"), "v",
                     F.lit(False).alias("ask"), none.cast(row_type).alias("row")))
    asked = (cut.where("ask").select(*keys, "b").distinct()
             .select(*keys, F.col("b").alias("t"), F.lit(0).alias("side"), none.cast(tie_type).alias("tie"),
                     none.cast(v_type).alias("v"), F.lit(True).alias("ask"), none.cast(row_type).alias("row")))
    handed = (_carried(lasts.unionByName(asked), keys, rest).where(F.col("ask") & F.col("v").isNotNull())
              .select(*keys, (F.col("t") * width).alias("t"), F.lit(-1).alias("side"), "tie", "v", F.lit(False).alias("ask"),
                      "row", F.col("t").alias("b")))
    w = Window.partitionBy(*keys, "b").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return cut.unionByName(handed).withColumn("v", F.last("v", ignorenulls=True).over(w)).drop("b")


def last_before(left: DataFrame, right: DataFrame, keys: list[tuple[str, str]], left_time: str, right_time: str,
                values: dict[str, str], ties: list[str], width: int = DAY, strict: bool = True) -> DataFrame:
    """Each left row with the values (``{new name: right column}``) of the last right row of its key
    before its time (``strict=False``: at or before); of equal times the largest by ``ties``.

    A carry-forward merge: both sides are put in one order within (key, stretch of ``width``
    microseconds), headed by the last value of the stretches before, which come from one row for
    each stretch.  One shuffle of the rows, no join.
    """
    names = [f"k{i}" for i in range(len(keys))]
    null = F.lit(None)
    # fields by place: their names may repeat in other cases
    row = F.struct(*(left[c] for c in left.columns))
    v = F.struct(*(right[c].alias(n) for n, c in values.items()))
    tie = F.struct(*(right[c].alias(f"c{i}") for i, c in enumerate(ties)))
    known = reduce(lambda a, b: a & b, [right[r].isNotNull() for _, r in keys], right[right_time].isNotNull())
    asks = left.select(*(left[a].alias(n) for n, (a, _) in zip(names, keys)), _micros(left[left_time]).alias("t"),
                       F.lit(0 if strict else 2).alias("side"), row.alias("row"), F.lit(True).alias("ask"))
    tells = right.where(known).select(*(right[b].alias(n) for n, (_, b) in zip(names, keys)), _micros(right[right_time]).alias("t"),
                                      F.lit(1).alias("side"), tie.alias("tie"), v.alias("v"), F.lit(False).alias("ask"))
    row_type, v_type, tie_type = asks.schema["row"].dataType, tells.schema["v"].dataType, tells.schema["tie"].dataType
    asks = asks.withColumns({"tie": null.cast(tie_type), "v": null.cast(v_type)})
    complete = reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in names], F.col("t").isNotNull())
    merged = _carried(asks.where(complete).unionByName(tells.withColumn("row", null.cast(row_type))), names, [width, GROUP])
    answered = merged.where("ask").unionByName(asks.where(~complete))
    return answered.select("row.*", *(F.col(f"v.{n}").alias(n) for n in values))


def overlaps(left: DataFrame, right: DataFrame, keys: list[tuple[str, str]], left_span: tuple[str, str], right_span: tuple[str, str],
             out_left: dict[str, str], out_right: dict[str, str], finest: int = HOUR) -> DataFrame:
    """Pairs of a left and a right row of one key whose half-open intervals [start, end) overlap,
    with the columns ``{new name: column}`` of both and ``overlap_us``.

    Cells of time at doubling widths: an interval's level is the first width that is as long as it,
    and it lies in at most two cells of this width and of every wider one.  Two intervals meet in the
    cells of the wider one's width, and of these the first that both have gives the pair, so each pair
    comes once.  A row goes to its own level if the other side has intervals as short, and to those
    wider levels that the other side has, so an interval of any length has at most two rows a level.
    Intervals with a null end, or none of positive length, overlap nothing.
    """
    names = [f"k{i}" for i in range(len(keys))]

    def spans(df: DataFrame, own: list[str], span: tuple[str, str], out: dict[str, str]) -> DataFrame:
        whole = reduce(lambda a, b: a & b, [df[c].isNotNull() for c in own], F.lit(True))
        s = df.where(whole).select(*(df[c].alias(n) for n, c in zip(names, own)), _micros(df[span[0]]).alias("s"),
                                   _micros(df[span[1]]).alias("e"), F.struct(*(df[c].alias(n) for n, c in out.items())).alias("row"))
        length = (F.col("e") - F.col("s")).cast("double") / finest
        return s.where("e > s").withColumn("level", F.greatest(F.lit(0), F.ceil(F.log2(length))).cast("int"))

    a, b = spans(left, [x for x, _ in keys], left_span, out_left), spans(right, [y for _, y in keys], right_span, out_right)
    # the levels of either side, a few numbers
    sides = a.select(F.lit(0).alias("side"), "level").unionByName(b.select(F.lit(1).alias("side"), "level")).distinct().collect()
    levels = [sorted(r["level"] for r in sides if r["side"] == k) for k in (0, 1)]

    def tagged(df: DataFrame, tag: str) -> DataFrame:
        return df.select(*names, "at", "cell", *(F.col(c).alias(f"{tag}_{c}") for c in ("s", "e", "level", "row")))

    met = tagged(cells(a, levels[1], finest), "l").join(tagged(cells(b, levels[0], finest), "r"), [*names, "at", "cell"])
    later = F.greatest("l_s", "r_s")
    once = (F.col("at") == F.greatest("l_level", "r_level")) & (F.col("cell") == F.floor(later / _width(finest)).cast("long"))
    both = (F.col("l_s") < F.col("r_e")) & (F.col("r_s") < F.col("l_e"))
    return met.where(once & both).select(
        *(F.col(f"l_row.{n}").alias(n) for n in out_left), *(F.col(f"r_row.{n}").alias(n) for n in out_right),
        (F.least("l_e", "r_e") - later).alias("overlap_us"))


def _width(finest: int) -> Column:
    return F.lit(finest).cast("long") * F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at"))


def cells(df: DataFrame, others: list[int], finest: int) -> DataFrame:
    """``df`` (s, e, level) with a row for each cell (``at``, ``cell``) where an interval may meet one of
    the levels ``others``."""
    wider = F.filter(F.array(*(F.lit(int(x)) for x in others)).cast("array<int>"), lambda x: x > F.col("level"))
    own = F.when(F.col("level") >= F.lit(min(others, default=1 << 30)), F.array("level")).otherwise(F.array().cast("array<int>"))
    df = df.withColumn("at", F.explode(F.concat(own, wider)))
    first, last = (F.floor(x / _width(finest)).cast("long") for x in (F.col("s"), F.col("e") - 1))
    return df.withColumn("cell", F.explode(F.sequence(first, last)))


def rolling_mean(df: DataFrame, keys: list[str], time: str, value: str, span: int, scale: int = 6) -> DataFrame:
    """``df`` with ``n_past`` and ``mean_past``: how many rows of the same key have a value in the
    ``span`` microseconds up to and with the row's own time, and their mean.

    Stretches are as long as the span, so a frame reaches into the one before at most: each row
    goes to its own stretch and, as context only, to the next.  Values are summed as decimals of
    ``scale`` places, so the mean does not depend on the order of rows.  NaN and infinite values
    count as null.
    """
    names = {n: free_name(n, df) for n in ("t", "b", "own", "v")}
    t, b, own, v = (names[n] for n in ("t", "b", "own", "v"))
    number = F.col(value).cast("double")
    finite = F.when(F.abs(number) < F.lit(float("inf")), number)
    rows = df.withColumns({t: _micros(F.col(time)), v: finite.cast(f"decimal(28,{scale})")})
    complete = reduce(lambda x, y: x & y, [F.col(k).isNotNull() for k in keys], F.col(t).isNotNull())
    at = F.floor(F.col(t) / F.lit(span)).cast("long")
    spread = (rows.where(complete)
              .withColumn(own, F.explode(F.array(F.lit(True), F.lit(False))))
              .withColumn(b, F.when(F.col(own), at).otherwise(at + 1)))
    w = Window.partitionBy(*keys, b).orderBy(t).rangeBetween(-span, Window.currentRow)
    n, total = F.count(v).over(w), F.sum(v).over(w)
    done = spread.withColumns({"n_past": n, "mean_past": F.when(n > 0, total.cast("double") / n)}).where(F.col(own))
    rest = rows.where(~complete).withColumns({"n_past": F.lit(0).cast("long"), "mean_past": F.lit(None).cast("double")})
    return done.select(*df.columns, "n_past", "mean_past").unionByName(rest.select(*df.columns, "n_past", "mean_past"))
