"""Best-fit packing by a grouping genetic algorithm on islands.

Documents become token pieces of at most ``capacity``.  Pieces are dealt by hash into groups
of about ``group_pieces``.  A group whose best fit, longest first, is at the lower bound of bins is
done; each other one is packed by several islands, one Spark row each, that evolve a population
of packings from different orders of its pieces.  A packing's genes are its bins: crossover
injects whole well-filled bins of one parent into the other, dissolves the bins that hold the
same pieces, lets the displaced pieces replace smaller ones whose bins they fill better, and
best-fits the rest.  Between epochs the elite of each island migrates to the next island of its
group.  A last round packs the pieces of all under-filled bins anew, so
that groups share their remainders.

Defined results: null and empty texts are one piece with the end id alone; repeated rows are
packed as rows of their own; an empty table gives no rows.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scribeflow.llm.common import slices, stage, texts
from scribeflow.llm.encoding import Encoder

CAPACITY = 2048
GROUP_PIECES = 4000
ISLANDS = 2
EPOCHS = 2
POPULATION = 6
#: Generations of an epoch, whatever the size of the group.
GENERATIONS = 150
#: Share of a parent's bins, best filled first, that a crossover injects, share of children that
#: are mutated too, and rounds of replacement, of so many pieces each, before best fit.
INJECTED, MUTATED, REPLACEMENTS, REPLACED = 0.3, 0.3, 2, 64
#: Bins filled less than this are packed again across groups.
WELL_FILLED = 0.995
_ID_BITS = 24


def pieces(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: the pieces of every whole text.  Only longer
    documents are cut; the remainder is the first piece."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(tokenizer, True)
        end = np.array([end_id], encoder.dtype).tobytes()
        for batch in slices(batches):
            rows: tuple[list, ...] = ([], [], [], [], [])
            for doc, packed in zip(batch.column("doc_id").to_pylist(), encoder.encode(batch.column("text").to_pylist())):
                ids = np.frombuffer(packed + end, encoder.dtype).astype("<u4")
                first = len(ids) % capacity or capacity
                for k, a in enumerate([0, *range(first, len(ids), capacity)]):
                    own = ids[a:a + (capacity if k else first)]
                    for out, x in zip(rows, (doc, k, a, len(own), zlib.crc32(own.tobytes()))):
                        out.append(x)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int32()), *(pa.array(x, pa.int64()) for x in rows[2:])],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return texts(docs).mapInArrow(part, "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit(lengths: np.ndarray, items: np.ndarray, bins: np.ndarray, room: list[tuple[int, int]],
             next_bin: int, capacity: int) -> int:
    """Put ``items``, longest first, where they leave least room; ``room`` holds (free, bin)
    in order.  Writes ``bins`` and returns the next free bin number."""
    for k in items[np.argsort(-lengths[items], kind="stable")].tolist():
        need = int(lengths[k])
        at = bisect.bisect_left(room, (need, -1))
        if at < len(room):
            free, b = room.pop(at)
        else:
            free, b, next_bin = capacity, next_bin, next_bin + 1
        bins[k] = b
        if free > need:
            bisect.insort(room, (free - need, b))
    return next_bin


def fitness(lengths: np.ndarray, bins: np.ndarray, capacity: int) -> tuple[int, float]:
    """Fewer bins first, then bins filled as unevenly as can be (well-filled ones survive)."""
    fill = np.bincount(bins, weights=lengths)
    fill = fill[fill > 0]
    return -len(fill), float(np.mean((fill / capacity) ** 2))


def replace(lengths: np.ndarray, bins: np.ndarray, displaced: np.ndarray, room: np.ndarray) -> np.ndarray:
    """Put each of the longest displaced pieces in the place of a smaller one whose bin it fills
    better; the smaller one is displaced instead.  ``room`` holds each bin's free space, ``bins`` is
    -1 for displaced pieces.  Returns the pieces that are displaced afterwards."""
    by_length = displaced[np.argsort(-lengths[displaced], kind="stable")]
    out = by_length[REPLACED:].tolist()
    # only a piece of a bin with free space can yield to a longer one, and one that is put in here is
    # no shorter than those that follow
    held = np.flatnonzero(bins >= 0)
    held = held[room[bins[held]] > 0]
    size, own = lengths[held], bins[held]
    reach, none = size + room[own], np.iinfo(np.int64).max
    for k in by_length[:REPLACED].tolist():
        need = lengths[k]
        fits = np.where((size < need) & (reach >= need), reach, none)
        at = int(fits.argmin()) if len(fits) else -1
        if at < 0 or fits[at] == none:
            out.append(k)
            continue
        b, taken = own[at], need - size[at]
        bins[k], bins[held[at]] = b, -1
        room[b] -= taken
        reach[own == b] -= taken
        size[at] = none
        out.append(int(held[at]))
    return np.array(out, np.int64)


def settle(lengths: np.ndarray, bins: np.ndarray, capacity: int) -> np.ndarray:
    """Place the pieces whose bin is -1: by replacement, then by best fit; bins numbered from 0."""
    n = int(bins.max(initial=-1)) + 1
    held = bins >= 0
    fill = np.bincount(bins[held], weights=lengths[held], minlength=n).astype(np.int64)
    room = capacity - fill
    displaced = np.flatnonzero(~held)
    for _ in range(REPLACEMENTS):
        if len(displaced):
            displaced = replace(lengths, bins, displaced, room)
    open_bins = np.flatnonzero((room > 0) & (room < capacity))
    best_fit(lengths, displaced, bins, sorted(zip(room[open_bins].tolist(), open_bins.tolist())), n, capacity)
    return np.unique(bins, return_inverse=True)[1]


def crossover(a: np.ndarray, b: np.ndarray, lengths: np.ndarray, capacity: int, rng: np.random.Generator) -> np.ndarray:
    """Bins of ``b`` injected whole into ``a``, the best filled ones first; the bins of ``a`` that hold
    the same pieces dissolve."""
    fill = np.bincount(b, weights=lengths)
    ranked = np.lexsort((rng.random(len(fill)), -fill))
    take = np.zeros(len(fill), bool)
    take[ranked[:max(1, int(len(ranked) * INJECTED))]] = True
    moved = take[b]
    gone = np.zeros(int(a.max()) + 1, bool)
    gone[a[moved]] = True
    return settle(lengths, np.where(moved, b + len(gone), np.where(gone[a], -1, a)), capacity)


def mutate(a: np.ndarray, lengths: np.ndarray, capacity: int, rng: np.random.Generator) -> np.ndarray:
    """Dissolve the emptiest bins and a few more."""
    fill = np.bincount(a, weights=lengths)
    n = max(2, len(fill) // 50)
    drop = np.zeros(len(fill), bool)
    drop[np.argsort(fill)[:n]] = True
    drop[rng.integers(0, len(fill), n)] = True
    return settle(lengths, np.where(drop[a], -1, a), capacity)


def seeded(lengths: np.ndarray, capacity: int, rng: np.random.Generator | None) -> np.ndarray:
    """A first packing: best fit, longest first, or, with ``rng``, in an order in which lengths count
    for more or less than they are, so that parents differ."""
    bins = np.full(len(lengths), -1, np.int64)
    if rng is None:
        best_fit(lengths, np.arange(len(lengths)), bins, [], 0, capacity)
        return bins
    order = np.argsort(-lengths * rng.uniform(1 - rng.random(), 1, len(lengths)), kind="stable")
    # best_fit sorts by length; in blocks of the drawn order it goes by that order
    room: list[tuple[int, int]] = []
    n = 0
    for block in np.array_split(order, max(1, len(order) // 16)):
        n = best_fit(lengths, block, bins, room, n, capacity)
    return bins


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Bins that no packing can do without."""
    return max(-int(-lengths.sum() // capacity), int((2 * lengths > capacity).sum()))


def evolve(lengths: np.ndarray, elites: list[np.ndarray], seed: int, capacity: int = CAPACITY,
           population: int = POPULATION, generations: int = GENERATIONS) -> np.ndarray:
    """The best packing of an island's population after some generations.  It ends early at
    the lower bound of bins, which no packing can beat."""
    rng = np.random.default_rng(seed)
    bound = lower_bound(lengths, capacity)
    own = list(elites)
    while len(own) < population:
        own.append(seeded(lengths, capacity, rng))
    score = [fitness(lengths, x, capacity) for x in own]
    for _ in range(generations):
        if -max(score)[0] <= bound or len(own) < 2:
            break
        # two parents, each the better of two drawn ones
        a, b = (max(rng.choice(len(own), 2), key=lambda k: score[k]) for _ in range(2))
        child = crossover(own[a], own[b], lengths, capacity, rng) if a != b else own[a]
        if a == b or rng.random() < MUTATED:
            child = mutate(child, lengths, capacity, rng)
        fit, worst = fitness(lengths, child, capacity), min(range(len(own)), key=lambda k: score[k])
        if fit > score[worst]:
            own[worst], score[worst] = child, fit
    return own[max(range(len(own)), key=lambda k: score[k])]


_STATE = "grp long, island int, lengths array<int>, elite binary, n long, shape double, bound long"


def _state(batch: pa.RecordBatch, best: np.ndarray, lengths: np.ndarray, capacity: int) -> pa.RecordBatch:
    n, shape = fitness(lengths, best, capacity) if len(lengths) else (0, 0.0)
    return pa.RecordBatch.from_arrays(
        [*(batch.column(c) for c in ("grp", "island", "lengths")), pa.array([best.astype("<i4").tobytes()], pa.binary()),
         pa.array([n], pa.int64()), pa.array([shape], pa.float64()), pa.array([lower_bound(lengths, capacity)], pa.int64())],
        names=["grp", "island", "lengths", "elite", "n", "shape", "bound"])


def _lengths(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("lengths").flatten().to_numpy(zero_copy_only=False).astype(np.int64)


def _first(groups: DataFrame, capacity: int) -> DataFrame:
    """Each group's best fit, longest first."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            lengths = _lengths(batch)
            yield _state(batch, seeded(lengths, capacity, None), lengths, capacity)

    return groups.withColumn("island", F.lit(0)).select("grp", "island", "lengths").mapInArrow(part, _STATE)


def _epoch(islands: DataFrame, epoch: int, capacity: int) -> DataFrame:
    """Each island evolves from its elites (``elites``: packings as int32 bytes)."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            lengths = _lengths(batch)
            grp, island, elites = (batch.column(c).to_pylist()[0] for c in ("grp", "island", "elites"))
            own = [np.frombuffer(x, "<i4").astype(np.int64) for x in elites]
            yield _state(batch, evolve(lengths, own, zlib.crc32(f"{grp}/{island}/{epoch}".encode()), capacity), lengths, capacity)

    return islands.select("grp", "island", "lengths", "elites").mapInArrow(part, _STATE)


def _pack(rows: DataFrame, groups: int, first_id: int, capacity: int, name: str) -> DataFrame:
    """Add sequence_id to the pieces in ``rows`` (rid, length); a group is one row of at most a
    few thousand pieces, dealt by hash of the row's own number.  Groups that best fit packs into
    the lower bound of bins are done; the others go to the islands."""
    items = F.array_sort(F.collect_list(F.struct(-F.col("length"), "rid", F.col("length").cast("int").alias("length"))))
    grouped = stage(rows.withColumn("grp", F.pmod(F.xxhash64("rid"), F.lit(groups))).groupBy("grp").agg(items.alias("items"))
                    .select("grp", F.transform("items", lambda x: x["rid"]).alias("rids"), F.transform("items", lambda x: x["length"]).alias("lengths")),
                    f"{name}-groups")
    first = stage(_first(grouped, capacity), f"{name}-first")
    above = first.where(-F.col("n") > F.col("bound"))
    found = first
    if not above.isEmpty():
        # the first island starts from the best fit, the others from packings of their own
        state = above.select("grp", "lengths", "elite", F.explode(F.array(*[F.lit(i) for i in range(ISLANDS)])).alias("island")).withColumn(
            "elites", F.when(F.col("island") == 0, F.array("elite")).otherwise(F.array().cast("array<binary>")))
        # by number: the few bytes of an island would be put together to one task
        tasks = min(groups * ISLANDS, max(rows.sparkSession.sparkContext.defaultParallelism, groups // 4))
        for epoch in range(EPOCHS):
            done = stage(_epoch(state.repartition(tasks, "grp", "island"), epoch, capacity), f"{name}-epoch")
            found = found.unionByName(done)
            # the elite moves on to the next island of its group, until one of the group is at the bound
            moved = done.select("grp", ((F.col("island") + 1) % ISLANDS).alias("island"), F.col("elite").alias("guest"))
            over = done.groupBy("grp").agg(F.max("n").alias("top"), F.max("bound").alias("least")).where("-top <= least").select("grp")
            state = (done.join(over, "grp", "left_anti").join(moved, ["grp", "island"])
                     .select("grp", "island", "lengths", F.array("elite", "guest").alias("elites")))
    best = found.groupBy("grp").agg(F.max_by("elite", F.struct("n", "shape", -F.col("island"))).alias("elite"))

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            lengths, grp = _lengths(batch), batch.column("grp").to_pylist()[0]
            bins = np.frombuffer(batch.column("elite").to_pylist()[0], "<i4").astype(np.int64)
            order = np.lexsort((np.arange(len(bins)), bins))
            before = np.concatenate(([0], np.cumsum(lengths[order])[:-1]))
            starts = np.flatnonzero(np.concatenate(([True], np.diff(bins[order]) > 0)))
            offset = np.empty(len(bins), np.int64)
            offset[order] = before - np.repeat(before[starts], np.diff(np.append(starts, len(bins))))
            fill = np.bincount(bins, weights=lengths)
            yield pa.RecordBatch.from_arrays(
                [batch.column("rids").flatten(), pa.array(lengths), pa.array(((grp + first_id) << _ID_BITS) + bins), pa.array(offset),
                 pa.array(fill[bins].astype(np.int64))], names=["rid", "length", "sequence_id", "offset", "fill"])

    return grouped.join(best, "grp").mapInArrow(part, "rid long, length long, sequence_id long, offset long, fill long")


def pack(parts: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``parts`` with sequence_id and offset.  Each piece is one row with its ``length``."""
    rows = stage(parts.withColumn("rid", F.monotonically_increasing_id()), "pieces")
    groups = max(1, -(-rows.count() // group_pieces))
    packed = stage(_pack(rows.select("rid", "length"), groups, 0, capacity, "pack"), "packed")
    loose = packed.where(F.col("fill") < int(capacity * WELL_FILLED)).select("rid", "length")
    again = max(1, -(-loose.count() // group_pieces))
    tight = packed.where(F.col("fill") >= int(capacity * WELL_FILLED))
    places = tight.unionByName(_pack(loose, again, groups, capacity, "tail")).select("rid", "sequence_id", "offset")
    return rows.join(places, "rid").drop("rid")


def sequences(packed: DataFrame) -> DataFrame:
    """Each sequence's number of pieces and its tokens."""
    return packed.groupBy("sequence_id").agg(F.count("*").alias("pieces"), F.sum("length").alias("tokens"))


def sequence_order(packed: DataFrame) -> DataFrame:
    """The pieces with their place in their sequence (0 first)."""
    return packed.withColumn("place", F.row_number().over(Window.partitionBy("sequence_id").orderBy("offset")) - 1)
