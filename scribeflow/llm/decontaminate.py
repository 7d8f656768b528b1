"""Benchmark decontamination by latent semantic retrieval.

1. ``fit``: all texts are cut into passages of ``PASSAGE`` words, and in one pass over them the
   tasks count how often each hashed word occurs and, with N the matrix of the passages' word counts
   and G a random matrix, sum N'N G.  With D the inverse frequencies, D N'N G is a random sketch of
   the TF-IDF matrix's Gram matrix, and its Nystrom form gives the leading right singular vectors
   and values: a distributed randomised SVD of the TF-IDF passages.  Every passage of every text is
   fitted and searched.
2. ``search``: overlapping windows of 8, 16 or 32 words, the size by the item's length, and the
   items are projected onto the singular vectors, scaled to unit variance.  Windows whose
   cosine with an item reaches ``COSINE`` are candidates.
3. Around a candidate, the longest common subsequence of words with the item is computed.  A
   document leaks an item if it holds ``SURE`` of the item's words in order, or ``LIKELY`` of them
   and of the answer, the item's last sentence.

4. Items of fewer than ``LEAST`` words, or of words of more than ``LONG`` bytes on the average (as
   in scripts without blanks), are also searched exactly: a document leaks one that it holds as
   the same words one after another; in a script without blanks, as the same characters.  Such
   an item's common words are all its words.

The items go out in blocks of bounded size, each against all texts.  Defined results: null and
empty texts and items, and items without a word, leak nothing; repeated rows are found alike;
empty tables give no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scribeflow.llm.common import mix, slices, text_bytes, texts, word_hashes, word_spans
from scribeflow.llm.windows import _rows

BITS = 13
RANK = 32
PASSAGE = 32
COSINE = 0.38
#: Share of a candidate window's words that the item must have.
SHARED = 0.5
#: Words around a candidate window that are compared, in lengths of the item.
AROUND = 2
SURE, LIKELY = 0.75, 0.55
LEAST = 8
#: Words of more bytes on the average are no words: the script has no blanks.
LONG = 24
BLOCK_ITEMS = 2000
_SIZE = 1 << BITS
_CHUNKS = 64
_PUNCTUATION = bytes(32 if chr(c) in ".,;:!?\"()[]|" else c for c in range(256))


def words(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, lower-cased (A-Z) and parted by white space and common
    punctuation, and the rows' offsets."""
    flat = np.frombuffer(b"".join(x.translate(_PUNCTUATION) for x in raw), np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in raw], dtype=np.int64)))
    starts, ends, rows = word_spans(flat, offsets)
    return word_hashes(flat, starts, ends, lower=True), rows


def feature(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - BITS)).astype(np.uint16)


def _blocks(rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the consecutive blocks of ``size`` words of every row, and each word's block."""
    n = np.diff(rows)
    count = -(-n // size)
    first = np.concatenate(([0], np.cumsum(count)))
    row = np.repeat(np.arange(len(n)), count)
    starts = rows[row] + (np.arange(first[-1]) - first[row]) * size
    return starts, np.repeat(np.arange(len(starts)), np.diff(np.append(starts, rows[-1])))


@dataclass
class Latent:
    """Word vectors: TF-IDF weights times the scaled singular vectors."""

    vectors: np.ndarray
    values: np.ndarray


def test_matrix(rank: int = RANK) -> np.ndarray:
    return np.random.default_rng(20).standard_normal((_SIZE, rank)).astype(np.float32)


def sketch(raw: list[bytes], g: np.ndarray) -> tuple[np.ndarray, int]:
    """N'N G and the number of passages."""
    h, rows = words(raw)
    return _sketched(feature(h), rows, g)


def _sketched(f: np.ndarray, rows: np.ndarray, g: np.ndarray) -> tuple[np.ndarray, int]:
    starts, block = _blocks(rows, PASSAGE)
    out = np.zeros((_SIZE, g.shape[1]))
    if not len(f):
        return out, 0
    # a passage's words side by side; the number after the last word stands for no word
    place = np.full((len(starts), PASSAGE), _SIZE, np.uint16)
    place[block, np.arange(len(f)) - starts[block]] = f
    vectors = np.concatenate((g, np.zeros((1, g.shape[1]), g.dtype)))
    x = vectors[place[:, 0]]
    for k in range(1, PASSAGE):
        x += vectors[place[:, k]]
    own = f.astype(np.int64)
    for c in range(g.shape[1]):
        out[:, c] = np.bincount(own, weights=x[:, c][block], minlength=_SIZE)
    return out, len(starts)


def _summed(docs: DataFrame, width: int, of) -> np.ndarray:
    """The sum over all tasks of ``of(raw)``, a matrix with a row for each hashed word; summed
    in two levels, so that no task adds up what all tasks sent."""
    per = _SIZE // _CHUNKS

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((_SIZE, width))
        for _, _, raw in _rows(batches):
            total += of(raw)
        yield pa.RecordBatch.from_arrays([pa.array(range(_CHUNKS), pa.int32()),
                                          pa.array([total[k * per:(k + 1) * per].tobytes() for k in range(_CHUNKS)], pa.binary())],
                                         names=["chunk", "blob"])

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(per * width)
        for blob in group["blob"]:
            total += np.frombuffer(blob)
        return pd.DataFrame({"chunk": group["chunk"].iloc[:1].to_numpy(), "blob": [total.tobytes()]})

    parts = texts(docs).withColumn("rk", F.lit(0).cast("long")).mapInArrow(part, "chunk int, blob binary")
    some = parts.withColumn("some", F.spark_partition_id() % 32).groupBy("some", "chunk").applyInPandas(add, "chunk int, blob binary")
    total = np.zeros((_SIZE, width))
    for r in some.groupBy("chunk").applyInPandas(add, "chunk int, blob binary").collect():
        total[r["chunk"] * per:(r["chunk"] + 1) * per] = np.frombuffer(r["blob"]).reshape(per, width)
    return total


def _counts(raw: list[bytes]) -> np.ndarray:
    return np.bincount(feature(words(raw)[0]), minlength=_SIZE)[:, None]


def fit(docs: DataFrame, rank: int = RANK) -> Latent:
    """The latent space: word frequencies and singular vectors of all texts, in one pass over them."""
    g = test_matrix(rank)

    def both(raw: list[bytes]) -> np.ndarray:
        h, rows = words(raw)
        f = feature(h)
        z, n = _sketched(f, rows, g)
        out = np.zeros((_SIZE, rank + 2))
        out[:, :rank], out[:, rank], out[0, rank + 1] = z, np.bincount(f, minlength=_SIZE), n
        return out

    z = _summed(docs, rank + 2, both)
    return decompose(z[:, :rank], z[:, rank], float(z[0, rank + 1]), g)


def decompose(z: np.ndarray, counts: np.ndarray, passages: float, g: np.ndarray) -> Latent:
    """Nystrom form of the TF-IDF Gram matrix C from Y = C W with W = D^-1 G."""
    idf = np.log((1 + counts.sum()) / (1 + counts)) + 0.05
    y, w = idf[:, None] * z, g / idf[:, None]
    core = w.T @ y
    core = (core + core.T) / 2
    core += np.eye(len(core)) * (1e-6 * max(1e-9, np.trace(core) / len(core)))
    values, basis = np.linalg.eigh(core)
    keep = values > 1e-9 * max(values.max(), 1e-30)
    half = y @ (basis[:, keep] / np.sqrt(values[keep]))  # C is about half half'
    u, s, _ = np.linalg.svd(half, full_matrices=False)
    keep = s > 1e-6 * max(s.max(initial=0.0), 1e-30)
    u, s = u[:, keep], s[keep]
    vectors = idf[:, None] * u / s  # s holds singular values: unit variance in each direction
    return Latent((vectors * np.sqrt(max(passages, 1.0))).astype(np.float32), s)


def window_of(n: int) -> int:
    """The window size for an item of n words: one window or more lies wholly inside it."""
    return 32 if n >= 56 else 16 if n >= 24 else 8


def _plain(raw: bytes) -> bytes:
    """Lower-cased (A-Z), without white space and common punctuation."""
    return b"".join(raw.translate(_PUNCTUATION).lower().split())


def _without_blanks(raw: bytes) -> bool:
    """Whether the bytes beyond ASCII lie in words of more than ``LONG`` bytes on the average, or
    the item is written in Han, Kana, Thai, Lao, Khmer or Burmese letters."""
    text = raw.decode("utf-8", "ignore")
    if _NO_BLANKS.search(text):
        return True
    parts = raw.translate(_PUNCTUATION).split()
    return bool(parts) and not raw.isascii() and len(_plain(raw)) > LONG * len(parts)


#: Thai, Lao, Burmese, Khmer; Kana, Han (and beyond the first plane).
_NO_BLANKS = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")


class Exact:
    """Short items by their length and the hash of their word sequence, and the characters of
    items in scripts without blanks."""

    def __init__(self, rows: list[tuple[int, bytes]]):
        self.by_length: dict[int, dict[int, list[int]]] = {}
        self.strings: list[tuple[int, int, bytes]] = []
        for k, raw in rows:
            h = words([raw])[0]
            if len(h) and _without_blanks(raw):
                self.strings.append((k, len(h), _plain(raw)))
            elif 0 < len(h) < LEAST:
                self.by_length.setdefault(len(h), {}).setdefault(int(sequences(h, len(h))[0]), []).append(k)
        self.wanted = {n: np.array(sorted(x), np.uint64) for n, x in self.by_length.items()}

    def __len__(self) -> int:
        return len(self.by_length) + len(self.strings)

    def search(self, raw: list[bytes], h: np.ndarray, rows: np.ndarray) -> Iterator[tuple[int, int, int, int, float]]:
        for n, wanted in self.wanted.items():
            s = sequences(h, n)
            at = np.flatnonzero(np.isin(s, wanted))
            row = np.searchsorted(rows[1:], at, side="right")
            ok = at + n <= rows[1:][row]
            for r, x in sorted(set(zip(row[ok].tolist(), s[at[ok]].tolist()))):
                for k in self.by_length[n][x]:
                    yield r, k, n, n, 1.0
        if self.strings:
            for r, x in enumerate(raw):
                # an item in such a script has bytes beyond ASCII
                text = b"" if x.isascii() else _plain(x)
                for k, n, own in self.strings if text else []:
                    at = text.find(own)
                    if at >= 0:
                        yield r, k, n, n, 1.0


def sequences(h: np.ndarray, n: int) -> np.ndarray:
    """A hash of every n words one after another."""
    out = np.zeros(max(0, len(h) - n + 1), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            out = mix(out * np.uint64(3) + h[k:k + len(out)])
    return out


@dataclass
class Items:
    """A block of items: ids, word hashes, where the answer begins, by window size the item numbers
    with their unit vectors, and how many words they have of each feature."""

    ids: list[int]
    hashes: list[np.ndarray]
    sets: list[set]
    answers: list[int]
    by_window: dict[int, tuple[np.ndarray, np.ndarray]]
    has: np.ndarray
    exact: Exact


def answer_start(text: str) -> int:
    """The number of words before the last sentence (of at least three words)."""
    parts = [p for p in re.split(r"(?<=[.?!])\s+", text.strip()) if p]
    n, tail = len(words([text.encode()])[0]), 0
    for p in reversed(parts):
        tail += len(words([p.encode()])[0])
        if tail >= 3:
            break
    return n - tail


def prepare(rows: list[tuple[int, str]], latent: Latent) -> Items:
    ids, hashes, answers = [], [], []
    for k, text in rows:
        h = words([(text or "").encode()])[0]
        if len(h) >= LEAST:
            ids.append(k)
            hashes.append(h)
            answers.append(answer_start(text))
    has = np.zeros((len(ids), _SIZE), np.uint16)
    by: dict[int, list[int]] = {}
    for k, h in enumerate(hashes):
        has[k] = np.bincount(feature(np.unique(h)), minlength=_SIZE)
        by.setdefault(window_of(len(h)), []).append(k)
    out = {}
    for size, own in by.items():
        v = np.stack([latent.vectors[feature(hashes[k])].sum(0) for k in own])
        out[size] = (np.array(own), (v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)).astype(np.float32))
    has = has.astype(np.min_scalar_type(has.max(initial=0)))
    return Items(ids, hashes, [set(h.tolist()) for h in hashes], answers, out, has, Exact([(k, (text or "").encode()) for k, text in rows]))


def lcs(item: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Which words of the item are in a longest common subsequence with the text."""
    m, n = len(item), len(text)
    table = np.zeros((m + 1, n + 1), np.int32)
    for i in range(m):
        table[i + 1, 1:] = np.maximum.accumulate(np.maximum(table[i, 1:], table[i, :-1] + (text == item[i])))
    used = np.zeros(m, bool)
    i, j = m, n
    while i and j:
        if item[i - 1] == text[j - 1] and table[i, j] == table[i - 1, j - 1] + 1:
            used[i - 1] = True
            i, j = i - 1, j - 1
        elif table[i - 1, j] >= table[i, j - 1]:
            i -= 1
        else:
            j -= 1
    return used


def candidates(h: np.ndarray, rows: np.ndarray, items: Items, latent: Latent, least: float = COSINE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Window size, window start and item number of the windows close to an item."""
    f = feature(h)
    half = 4
    starts, of = _blocks(rows, half)
    if not len(starts):
        return
    # four lookups for each block; the number after the last word stands for no word
    place = np.full((len(starts), half), _SIZE, np.uint16)
    place[of, np.arange(len(f)) - starts[of]] = f
    vectors = np.concatenate((latent.vectors, np.zeros((1, latent.vectors.shape[1]), np.float32)))
    block = vectors[place[:, 0]]
    for k in range(1, half):
        block += vectors[place[:, k]]
    row_end = rows[1:][np.searchsorted(rows[1:], starts, side="right")]
    level = block
    size = half
    while size < 32:
        # level: sums over ``size`` words from each multiple of size / 2 ... doubled to overlapping windows
        size *= 2
        step = size // 2 // half
        wide = level.copy()
        wide[:-step] += level[step:]
        level = wide
        if size in items.by_window:
            own, unit = items.by_window[size]
            inside = starts + size <= row_end
            first = np.concatenate(([0], np.flatnonzero(np.diff(row_end)) + 1))
            nth = np.arange(len(starts)) - np.repeat(first, np.diff(np.append(first, len(starts))))
            # windows at every half window, and a row's last block stands for its end
            at = np.flatnonzero((inside | (nth == 0) | (row_end - starts > size // 2)) & (nth % step == 0))
            for a in range(0, len(at), 1 << 14):
                some = at[a:a + (1 << 14)]
                v = wide[some]
                c = (v @ unit.T) / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
                w, k = np.nonzero(c >= least)
                if len(w):
                    start, k = starts[some[w]], own[k]
                    place = start[:, None] + np.arange(size)
                    ok = place < row_end[some[w]][:, None]
                    n = ((items.has[k[:, None], f[np.minimum(place, len(f) - 1)]] > 0) & ok).sum(1)
                    keep = n >= SHARED * np.minimum(size, ok.sum(1))
                    yield size, start[keep], k[keep]


def _before(f: np.ndarray) -> np.ndarray:
    """For each place the last one before it with the same feature, or -1."""
    out = np.full(len(f), -1, np.int64)
    order = np.argsort(f, kind="stable")
    same = f[order[1:]] == f[order[:-1]]
    out[order[1:][same]] = order[:-1][same]
    return out


def _at_most(lo: np.ndarray, hi: np.ndarray, ks: np.ndarray, f: np.ndarray, before: np.ndarray, items: Items) -> np.ndarray:
    """A bound of how many of an item's distinct words lie in [lo, hi): each feature that is there
    counts once, as all of the item's words that have it."""
    out = np.zeros(len(ks), np.int64)
    n = hi - lo
    cuts = np.searchsorted(np.cumsum(n), np.arange(0, int(n.sum()), 1 << 20), side="right").tolist() + [len(ks)]
    for a, b in zip(cuts, cuts[1:]):
        if a < b:
            first = np.cumsum(n[a:b]) - n[a:b]
            place = np.repeat(lo[a:b] - first, n[a:b])
            place += np.arange(len(place))
            fresh = before[place] < np.repeat(lo[a:b], n[a:b])
            out[a:b] = np.add.reduceat(items.has[np.repeat(ks[a:b], n[a:b]), f[place]] * fresh, first, dtype=np.int64)
    return out


def search_rows(raw: list[bytes], items: Items, latent: Latent) -> list[tuple[int, int, int, int, float]]:
    """Row, item id, common words, item words and the share of its answer, for leaks."""
    h, rows = words(raw)
    best: dict[tuple[int, int], tuple[int, int, float]] = {}
    f = feature(h)
    before = _before(f) if items.ids else None
    length, distinct = np.array([len(x) for x in items.hashes], np.int64), np.array([len(x) for x in items.sets], np.int64)
    for size, starts, ks in candidates(h, rows, items, latent):
        row = np.searchsorted(rows[1:], starts, side="right")
        lo, hi = np.maximum(rows[row], starts - AROUND * length[ks]), np.minimum(rows[row + 1], starts + size + AROUND * length[ks])
        # most candidates have too few of the item's words around them, which is told for all at once
        near = _at_most(lo, hi, ks, f, before, items) >= LIKELY * distinct[ks]
        row, starts, ks = row[near], starts[near], ks[near]
        reached: dict[tuple[int, int], int] = {}
        for r, s, k in zip(row.tolist(), starts.tolist(), ks.tolist()):
            item = items.hashes[k]
            m = len(item)
            lo, hi = max(int(rows[r]), s - AROUND * m), min(int(rows[r + 1]), s + size + AROUND * m)
            if s < reached.get((r, k), -1):
                continue
            near = h[lo:hi]
            if len(items.sets[k].intersection(near.tolist())) < LIKELY * len(items.sets[k]):
                continue
            # what starts here up to half an item on ends before ``hi``, and was looked at
            reached[r, k] = s + m // 2
            used = lcs(item, near)
            n, answer = int(used.sum()), float(used[items.answers[k]:].mean())
            if n > best.get((r, k), (0, 0, 0.0))[0]:
                best[r, k] = (n, m, answer)
    found = [(r, items.ids[k], n, m, answer) for (r, k), (n, m, answer) in best.items()
             if n >= SURE * m or (n >= LIKELY * m and answer >= LIKELY)]
    seen = {x[:2] for x in found}
    return found + [x for x in items.exact.search(raw, h, rows) if x[:2] not in seen]


def item_blocks(docs: DataFrame, benchmark: DataFrame) -> list:
    """The items in blocks of bounded size, each broadcast with the latent space."""
    latent = fit(docs)
    rows = benchmark.select(benchmark["item_id"].cast("long").alias("item_id"), benchmark["text"].cast("string").alias("text")).where(
        "text is not null").orderBy("item_id", "text")
    blocks: list[list[tuple[int, str]]] = [[]]
    for r in rows.toLocalIterator():
        if len(blocks[-1]) == BLOCK_ITEMS:
            blocks.append([])
        blocks[-1].append((r["item_id"], r["text"]))
    return [docs.sparkSession.sparkContext.broadcast((prepare(block, latent), latent)) for block in blocks]


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, common_words, item_words, answer_share of every document that holds an item."""
    out = None
    for sent in item_blocks(docs, benchmark):

        def part(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            items, space = sent.value
            for _, ids, raw in _rows(batches):
                found = [(ids[r], *rest) for r, *rest in search_rows(raw, items, space)] if items.ids or len(items.exact) else []
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*found), (pa.int64(),) * 4 + (pa.float64(),))],
                                                     names=["doc_id", "item_id", "common_words", "item_words", "answer_share"])

        found = texts(docs).withColumn("rk", F.lit(0).cast("long")).mapInArrow(
            part, "doc_id long, item_id long, common_words long, item_words long, answer_share double")
        out = found if out is None else out.union(found)
    return out


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that leak no item, all columns, without a shuffle."""
    out = docs
    for sent in item_blocks(docs, benchmark):

        def part(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            items, space = sent.value
            for batch in slices(batches):
                keep = np.ones(batch.num_rows, bool)
                if items.ids or len(items.exact):
                    keep[[r for r, *_ in search_rows(text_bytes(batch), items, space)]] = False
                yield batch.filter(pa.array(keep))

        out = out.mapInArrow(part, docs.schema)
    return out
