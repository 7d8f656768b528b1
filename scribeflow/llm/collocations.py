"""Phrase collocation mining by top-order marginalisation.

Only the longest windows are counted: a word with the words that follow it in its piece (the
lead columns ``w1 .. wK``), padded where the piece ends.  Counts of all shorter phrases are sums
over these, as each occurrence of a phrase is the prefix of the window that starts there: one
``ROLLUP(lang, w1, .., wK)`` gives the words of a language, and every word, pair and longer
phrase.  No n-gram of a lower order is ever listed.

Three jobs feed it:

1. ``vocabulary``: words with their counts and a 64-bit hash; two words of one language with one
   hash are found here, and the next hash function is taken.
2. ``windows``: each task counts its padded windows.  A word below the least count is in no
   candidate, so a window is padded from its first rare word on.  Windows of equal first two
   words are merged in one partition, each task's share being counted before it is sent, and the
   tails below the least count are folded into shorter, padded windows.  Sums are kept.
3. ``scores``: cuts of each candidate, looked up in the rolled-up table.

Up to ``SENT_WORDS`` frequent words are numbered in the tasks, so that a window is one 64-bit
number; with more of them, words are told by their hashes and nothing is sent.  Both ways give
the same counts.

Defined results: null text is empty, null lang is ``und``; repeated rows count each time; an
empty table has no rows; a text of separators only has no words; texts of any length are read
whole; extra columns are not read.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scribeflow.llm.common import SpanHash, mix, slices, stage

LONGEST = 3
LEAST_COUNT = 10
HELD_PERCENT = 50
FIRST_RANKS = 2000
#: The most frequent words that are sent to the tasks, 8 bytes each.
SENT_WORDS = (1 << 21) - 2
#: Bytes of text that a task counts at a time, bytes of words compared at a time, new windows
#: that a partition merges at a time, and words for each partition that merges.
CHUNK_BYTES = 4 << 20
COMPARED_BYTES = 1 << 20
MERGED = 1 << 20
BUCKET_WORDS = 8 << 20
#: Hash functions: one vectorised over the bytes, then others, should two words share a hash.
HASHES = 4

_PAD, _RARE = 0, 1
#: Bytes that end a piece, and blanks within one.
_BREAK = np.zeros(256, np.bool_)
_BREAK[list(b".,;:!?\n\x0b\x0c\r")] = True
_BLANK = np.zeros(256, np.bool_)
_BLANK[list(b" \t")] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(docs["lang"].cast("string"), F.lit("und")).alias("lang"),
                       docs["text"].cast("string").alias("text")).where("text <> ''")


def cut(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word in the bytes of some texts, and the number of its piece."""
    ends_piece = _BREAK[raw]
    edge = np.zeros(len(raw) + 1, np.bool_)
    edge[offsets] = True
    inside = ~(ends_piece | _BLANK[raw])
    starts = np.flatnonzero(inside & (edge[:-1] | np.concatenate(([True], ~inside[:-1]))))
    ends = np.flatnonzero(inside & (edge[1:] | np.concatenate((~inside[1:], [True])))) + 1
    piece = np.cumsum(ends_piece | edge[:-1])[starts]
    return starts, ends, piece


def hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, kind: int) -> np.ndarray:
    """A hash above ``_RARE`` for each word, by the function ``kind``."""
    if kind == 0:
        h = SpanHash(raw)(starts, ends) if len(starts) else np.zeros(0, np.uint64)
    else:
        data = raw.tobytes()
        h = np.fromiter((xxhash.xxh64_intdigest(data[a:b], kind) for a, b in zip(starts.tolist(), ends.tolist())),
                        np.uint64, len(starts))
    return np.where(h <= _RARE, h + np.uint64(2), h)


def _chunks(batches, kind: int):
    """lang, raw bytes, starts, ends, hashes and pieces of texts of one language, some
    ``CHUNK_BYTES`` at a time (one text is never split, so that may be more)."""
    held: dict[str, list[bytes]] = {}
    size: dict[str, int] = {}

    def out(lang):
        texts = held.pop(lang)
        del size[lang]
        raw = _LOWER[np.frombuffer(b"".join(texts), np.uint8)]
        offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
        starts, ends, piece = cut(raw, offsets)
        return lang, raw, starts, ends, hashes(raw, starts, ends, kind), piece

    for batch in slices(batches):
        names = batch.column("lang").to_pylist()
        for lang, text in zip(names, batch.column("text").cast(pa.large_binary()).to_pylist()):
            held.setdefault(lang, []).append(text)
            size[lang] = size.get(lang, 0) + len(text)
            if size[lang] >= CHUNK_BYTES:
                yield out(lang)
        if sum(size.values()) >= 2 * CHUNK_BYTES:
            yield out(max(size, key=size.get))
    for lang in list(held):
        yield out(lang)


def differing(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, lead: np.ndarray) -> np.ndarray:
    """Which words are not, byte for byte, the word that starts at ``lead`` and is as long."""
    out = np.zeros(len(starts), np.bool_)
    length = ends - starts
    reach = np.cumsum(length)
    a = 0
    while a < len(starts):
        b = max(a + 1, int(np.searchsorted(reach, (reach[a - 1] if a else 0) + COMPARED_BYTES, side="right")))
        n = length[a:b]
        first = np.cumsum(n) - n
        within = np.arange(int(n.sum())) - np.repeat(first, n)
        odd = raw[np.repeat(starts[a:b], n) + within] != raw[np.repeat(lead[a:b], n) + within]
        out[a:b] = np.logical_or.reduceat(odd, first)
        a = b
    return out


def distinct_words(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, h: np.ndarray) -> list[tuple[int, bytes, int]]:
    """(hash, word, count) of the distinct words, told apart by their bytes."""
    order = np.argsort(h, kind="stable")
    starts, ends, h = starts[order], ends[order], h[order]
    first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))) if len(h) else np.zeros(0, np.int64)
    count = np.diff(np.concatenate((first, [len(h)])))
    lead, lead_end = np.repeat(starts[first], count), np.repeat(ends[first], count)
    odd = ends - starts != lead_end - lead
    same = np.flatnonzero(~odd)
    odd[same] = differing(raw, starts[same], ends[same], lead[same])
    data = raw.tobytes()
    others: dict[tuple[int, bytes], int] = {}
    for k in np.flatnonzero(odd).tolist():
        key = int(h[k].astype(np.int64)), data[starts[k]:ends[k]]
        others[key] = others.get(key, 0) + 1
    count = np.add.reduceat((~odd).astype(np.int64), first) if len(first) else count
    return [*((int(x), data[a:b], int(c)) for x, a, b, c in zip(h[first].view(np.int64), starts[first].tolist(), ends[first].tolist(), count)),
            *((*k, c) for k, c in others.items())]


def vocabulary(docs: DataFrame) -> tuple[DataFrame, int]:
    """A stage table (lang, hash, word, n) of all words, and the hash function that tells all
    words of a language apart."""
    for kind in range(HASHES):

        def part(batches, kind=kind):
            for lang, raw, starts, ends, h, _ in _chunks(batches, kind):
                rows = distinct_words(raw, starts, ends, h)
                for k in range(0, len(rows), 1 << 16):
                    own = rows[k:k + (1 << 16)]
                    yield pa.RecordBatch.from_pydict({
                        "lang": pa.array([lang] * len(own), pa.string()),
                        "hash": pa.array([r[0] for r in own], pa.int64()),
                        "word": pa.array([r[1] for r in own], pa.binary()).cast(pa.string()),
                        "n": pa.array([r[2] for r in own], pa.int64())})

        words = (_texts(docs).mapInArrow(part, "lang string, hash long, word string, n long")
                 .groupBy("lang", "hash", "word").agg(F.sum("n").alias("n")))
        words = stage(words, "vocabulary")
        if words.groupBy("lang", "hash").count().where("count > 1").isEmpty():
            return words, kind
    raise ValueError(f"no two of {HASHES} hash functions tell all words apart")


class Words:
    """The numbers, from ``_RARE`` + 1 on, that each language's frequent words have in the tasks."""

    def __init__(self, frequent: DataFrame):
        rows = frequent.select("lang", "hash").toArrow()
        langs = rows.column("lang").combine_chunks().dictionary_encode()
        codes = langs.indices.to_numpy(zero_copy_only=False)
        h = rows.column("hash").to_numpy().astype(np.int64).view(np.uint64)
        self.of = {lang: np.sort(h[codes == k]) for k, lang in enumerate(langs.dictionary.to_pylist())}

    def ids(self, lang: str, h: np.ndarray) -> np.ndarray:
        known = self.of.get(lang)
        if known is None:
            return np.full(len(h), _RARE, np.uint64)
        at = np.minimum(np.searchsorted(known, h), len(known) - 1)
        return np.where(known[at] == h, at + (_RARE + 1), _RARE).astype(np.uint64)

    def hashes(self, lang: str, ids: np.ndarray) -> np.ndarray:
        names = np.concatenate((np.array([_PAD, _RARE], np.uint64), self.of.get(lang, np.zeros(0, np.uint64))))
        return names[ids.astype(np.int64)]


def leads(ids: np.ndarray, piece: np.ndarray, longest: int) -> list[np.ndarray]:
    """The lead columns: word k of the window that starts at each word, padded from the end of
    its piece or its first rare word on."""
    columns, alive = [ids], ids != _RARE
    for k in range(1, longest):
        lead = np.full(len(ids), _PAD, np.uint64)
        same = np.zeros(len(ids), np.bool_)
        if len(ids) > k:
            same[:-k] = piece[k:] == piece[:-k]
            lead[:-k] = ids[k:]
        alive = alive & same & (lead != _RARE)
        columns.append(np.where(alive, lead, np.uint64(_PAD)))
    return columns


def merge(columns: list[np.ndarray], counts: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """Equal windows once, in the order of their columns, with summed counts (1 each if none given)."""
    n = len(columns[0])
    if not n:
        return columns, np.zeros(0, np.int64)
    if len(columns) == 1 and counts is None:
        columns = [np.sort(columns[0])]
    else:
        order = np.argsort(columns[0], kind="stable") if len(columns) == 1 else np.lexsort(columns[::-1])
        columns = [c[order] for c in columns]
        counts = None if counts is None else counts[order]
    new = np.concatenate(([True], reduce(np.logical_or, [c[1:] != c[:-1] for c in columns])))
    first = np.flatnonzero(new)
    return [c[first] for c in columns], np.diff(np.concatenate((first, [n]))) if counts is None else np.add.reduceat(counts, first)


def pack(columns: list[np.ndarray], small: bool) -> list[np.ndarray]:
    """One number for a window of small ids; its order is the order of the columns."""
    if not small:
        return columns
    bits = np.uint64(63 // len(columns))
    return [reduce(lambda a, b: (a << bits) | b, columns)]


def unpack(packed: list[np.ndarray], longest: int, small: bool) -> list[np.ndarray]:
    if not small:
        return packed
    bits = 63 // longest
    ones = np.uint64((1 << bits) - 1)
    return [(packed[0] >> np.uint64(bits * (longest - 1 - k))) & ones for k in range(longest)]


def fold(columns: list[np.ndarray], counts: np.ndarray, least: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Windows below the least count are padded from their last word on, order by order, down
    to the pair; sums of every prefix stay."""
    for k in range(len(columns) - 1, 0, -1):
        columns, counts = merge(columns, counts)
        if not len(counts):
            break
        prefix = np.concatenate(([True], reduce(np.logical_or, [c[1:] != c[:-1] for c in columns[:k + 1]])))
        first = np.flatnonzero(prefix)
        total = np.repeat(np.add.reduceat(counts, first), np.diff(np.concatenate((first, [len(counts)]))))
        columns = columns[:k] + [np.where(total < least, np.uint64(_PAD), c) for c in columns[k:]]
    return merge(columns, counts)


def windows(docs: DataFrame, kind: int, sent, n_words: int, longest: int, least: int) -> DataFrame:
    """Padded longest windows (lang, w1 .. wK, n) of word hashes, folded; a window with a rare
    first word is (``_RARE``, pads).  ``sent``: a broadcast ``Words``, or none."""
    spark, small = docs.sparkSession, sent is not None
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_words // BUCKET_WORDS))

    def count(batches):
        for lang, _, _, _, h, piece in _chunks(batches, kind):
            ids = sent.value.ids(lang, h) if small else h
            packed, n = merge(pack(leads(ids, piece, longest), small))
            own = unpack(packed, longest, small)
            bucket = (mix(own[0] + mix(own[min(1, longest - 1)])) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            edges = np.flatnonzero(np.diff(bucket[order])) + 1
            groups = [g for g in np.split(order, edges) if len(g)]
            for k in range(0, len(groups), 64):
                some = groups[k:k + 64]
                yield pa.RecordBatch.from_pydict({
                    "lang": pa.array([lang] * len(some), pa.string()),
                    "bucket": pa.array([int(bucket[g[0]]) for g in some], pa.int64()),
                    "keys": pa.array([np.concatenate([c[g] for c in packed]).astype("<u8").tobytes() for g in some], pa.binary()),
                    "counts": pa.array([n[g].astype("<i8").tobytes() if n[g].max() > 0x7FFFFFFF else n[g].astype("<i4").tobytes()
                                        for g in some], pa.binary())})

    columns = [f"w{k + 1}" for k in range(longest)]

    def total(batches):
        held: dict[str, tuple] = {}
        waiting: dict[str, list] = {}
        size: dict[str, int] = {}

        def join(lang):
            parts = waiting.pop(lang, [])
            size.pop(lang, None)
            if lang in held:
                parts.append(held[lang])
            held[lang] = merge([np.concatenate([p[0][k] for p in parts]) for k in range(len(parts[0][0]))],
                               np.concatenate([p[1] for p in parts]))

        for batch in batches:
            for row in batch.to_pylist():
                keys = np.frombuffer(row["keys"], "<u8").reshape(1 if small else longest, -1)
                counts = np.frombuffer(row["counts"], "<i4" if len(row["counts"]) == 4 * keys.shape[1] else "<i8")
                lang = row["lang"]
                waiting.setdefault(lang, []).append((list(keys), counts.astype(np.int64)))
                size[lang] = size.get(lang, 0) + len(counts)
                # merged only when the new ones are as many as the old: each is sorted some log n times
                if size[lang] > max(MERGED, len(held[lang][1]) if lang in held else 0):
                    join(lang)
        for lang in list(waiting):
            join(lang)
        for lang, (packed, counts) in held.items():
            own, n = fold(unpack(packed, longest, small), counts, least)
            own = [sent.value.hashes(lang, c) for c in own] if small else own
            for k in range(0, len(n), 1 << 16):
                part = slice(k, k + (1 << 16))
                yield pa.RecordBatch.from_pydict(
                    {"lang": pa.array([lang] * len(n[part]), pa.string())}
                    | {c: pa.array(w[part].astype(np.uint64).view(np.int64), pa.int64()) for c, w in zip(columns, own)}
                    | {"n": pa.array(n[part], pa.int64())})

    return (_texts(docs).mapInArrow(count, "lang string, bucket long, keys binary, counts binary")
            .repartition(buckets, "lang", "bucket")
            .mapInArrow(total, ", ".join(["lang string", *(f"{c} long" for c in columns), "n long"])))


def rolled_up(top: DataFrame, longest: int, least: int) -> DataFrame:
    """(lang, size, w1 .. wK, f): how often each phrase of ``size`` words occurs, pads behind it;
    size 0 counts all words of the language.  Phrases below the least count are left out."""
    columns = [f"w{k + 1}" for k in range(longest)]
    sums = (top.rollup("lang", *columns).agg(F.sum("n").alias("f"), F.grouping_id().alias("gid"))
            .withColumn("size", sum(((F.col("gid").bitwiseAND(1 << k)) == 0).cast("int") for k in range(longest))))
    lang_told = F.col("gid").bitwiseAND(1 << longest) == 0
    last = reduce(lambda whole, k: F.when(F.col("size") == k + 1, F.col(columns[k])).otherwise(whole), range(longest), F.lit(None).cast("long"))
    phrase = (F.col("size") > 0) & ~last.isin(_PAD, _RARE) & (F.col("f") >= least)
    return (sums.where(lang_told & ((F.col("size") == 0) | phrase))
            .select("lang", "size", *(F.coalesce(F.col(c), F.lit(_PAD).cast("long")).alias(c) for c in columns), "f"))


def _part(columns: list[str], start: Column, length: Column) -> list[Column]:
    """Columns of the sub-phrase of ``length`` words from ``start`` (0 first), pads behind."""
    words = F.array(*columns)
    return [F.when(F.lit(k) < length, F.get(words, start + k)).otherwise(F.lit(_PAD).cast("long")).alias(f"p{k + 1}")
            for k in range(len(columns))]


def scores(table: DataFrame, longest: int, held_percent: int) -> DataFrame:
    """Candidates (lang, w1 .. wK, a, l, r, n, score) that no longer one holds."""
    columns = [f"w{k + 1}" for k in range(longest)]
    keys = [f"p{k + 1}" for k in range(longest)]
    many = table.where("size > 1").withColumnRenamed("f", "a")

    def looked_up(df: DataFrame, start: Column, length: Column, name: str) -> DataFrame:
        parts = table.where("size > 0").select("lang", *(F.col(c).alias(k) for c, k in zip(columns, keys)), F.col("f").alias(name))
        return df.select("*", *_part(columns, start, length)).join(parts, ["lang", *keys]).select(*df.columns, name)

    cuts = many.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = looked_up(cuts, F.lit(0), F.col("k"), "l")
    cuts = looked_up(cuts, F.col("k"), F.col("size") - F.col("k"), "r")
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    # a <= l, r, so the score is at most 1000000; the products have up to 38 digits
    floored = F.call_function("div", (wide("a") * wide("a")).cast("decimal(31,0)") * F.lit(1000000).cast("decimal(7,0)"), wide("l") * wide("r"))
    cuts = cuts.withColumn("score", floored.cast("long"))
    best = (cuts.groupBy("lang", "size", *columns, "a")
            .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
            .select("lang", "size", *columns, "a", "cut.l", "cut.r", "cut.score"))
    if longest > 2:
        spans = [F.struct(F.lit(s).alias("s"), F.lit(m).alias("m")) for m in range(2, longest) for s in range(longest - m + 1)]
        longer = (many.select("*", F.explode(F.array(*spans)).alias("span"))
                  .where(F.col("span.m") < F.col("size")).where(F.col("span.s") + F.col("span.m") <= F.col("size")))
        inside = (longer.select("lang", *_part(columns, F.col("span.s"), F.col("span.m")), "a")
                  .groupBy("lang", *keys).agg(F.max("a").alias("longer_f")))
        inside = inside.select(F.col("lang"), *(F.col(k).alias(c) for k, c in zip(keys, columns)), "longer_f")
        held = F.col("longer_f").cast("decimal(19,0)") * 100 >= F.col("a").cast("decimal(19,0)") * held_percent
        best = best.join(inside, ["lang", *columns], "left").where(F.col("longer_f").isNull() | ~held).drop("longer_f")
    total = table.where("size = 0").select("lang", F.col("f").alias("n"))
    return best.join(total, "lang")


def mine(docs: DataFrame, longest: int = LONGEST, least: int = LEAST_COUNT, held_percent: int = HELD_PERCENT,
         first: int = FIRST_RANKS, sent: int = SENT_WORDS) -> DataFrame:
    """Each language's first phrases: lang, rank, phrase, a, l, r, n, score."""
    spark = docs.sparkSession
    words, kind = vocabulary(docs)
    n_words = words.agg(F.sum("n")).first()[0] or 0
    frequent = words.where(F.col("n") >= least)
    # numbers have to fit the bits that a packed window has for each
    few = frequent.count() <= min(sent, (1 << 63 // longest) - 2)
    numbers = spark.sparkContext.broadcast(Words(frequent)) if few else None
    counted = stage(rolled_up(windows(docs, kind, numbers, n_words, longest, least), longest, least), "phrases")
    if few:
        numbers.destroy()
    found = scores(counted, longest, held_percent)
    columns = [f"w{k + 1}" for k in range(longest)]
    for k, c in enumerate(columns):
        names = frequent.select("lang", F.col("hash").alias(c), F.col("word").alias(f"word{k + 1}"))
        found = found.join(names, ["lang", c], "left" if k > 1 else "inner")
    found = found.withColumn("phrase", F.concat_ws(" ", *(f"word{k + 1}" for k in range(longest))))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= first)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))


#: The same rows as DuckDB SQL, by plain n-gram counts.
ORACLE = r"""
WITH pieces AS (
  SELECT lang, row_number() OVER () AS piece, regexp_extract_all(p, '[^ \t]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang,
               unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p
        FROM documents)),
words AS (SELECT lang, piece, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS a FROM pieces),
grams AS (
  SELECT lang, a, lead(a) OVER t AS b, lead(a, 2) OVER t AS c FROM words WINDOW t AS (PARTITION BY piece ORDER BY i)),
totals AS (SELECT lang, count(*) AS n FROM words GROUP BY lang),
f1 AS (SELECT lang, a, count(*) AS f FROM grams GROUP BY lang, a HAVING count(*) >= 10),
f2 AS (SELECT lang, a, b, count(*) AS f FROM grams WHERE b IS NOT NULL GROUP BY lang, a, b HAVING count(*) >= 10),
f3 AS (SELECT lang, a, b, c, count(*) AS f FROM grams WHERE c IS NOT NULL GROUP BY lang, a, b, c HAVING count(*) >= 10),
cuts AS (
  SELECT g.lang, g.a || ' ' || g.b AS phrase, 1 AS k, g.f AS a, x.f AS l, y.f AS r
  FROM f2 g JOIN f1 x ON x.lang = g.lang AND x.a = g.a JOIN f1 y ON y.lang = g.lang AND y.a = g.b
  WHERE NOT EXISTS (SELECT 1 FROM f3 t WHERE t.lang = g.lang AND t.a = g.a AND t.b = g.b AND 100 * t.f >= 50 * g.f)
    AND NOT EXISTS (SELECT 1 FROM f3 t WHERE t.lang = g.lang AND t.b = g.a AND t.c = g.b AND 100 * t.f >= 50 * g.f)
  UNION ALL
  SELECT g.lang, g.a || ' ' || g.b || ' ' || g.c, 1, g.f, x.f, y.f
  FROM f3 g JOIN f1 x ON x.lang = g.lang AND x.a = g.a JOIN f2 y ON y.lang = g.lang AND y.a = g.b AND y.b = g.c
  UNION ALL
  SELECT g.lang, g.a || ' ' || g.b || ' ' || g.c, 2, g.f, x.f, y.f
  FROM f3 g JOIN f2 x ON x.lang = g.lang AND x.a = g.a AND x.b = g.b JOIN f1 y ON y.lang = g.lang AND y.a = g.c),
scored AS (SELECT *, CAST((1000000 * CAST(a AS HUGEINT) * a) // (CAST(l AS HUGEINT) * r) AS BIGINT) AS score FROM cuts),
lowest AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS nth FROM scored),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, score
  FROM lowest WHERE nth = 1)
SELECT ranked.lang, ranked.rank, phrase, a, l, r, n, score
FROM ranked JOIN totals ON totals.lang = ranked.lang WHERE ranked.rank <= 2000
"""
