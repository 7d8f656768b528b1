"""Repeated windows across documents: which windows of ``WINDOW`` consecutive symbols of a
document also start in a document with a smaller doc_id.

Work is dealt out by content.  The anchor of a window is the least hash of the k-symbol
strings inside it, so equal windows have equal anchors, and a maximal run of windows with one
anchor is a *segment* of the text.

1. ``_anchors``: each task sends the anchors of its documents, 6 bytes each, to anchor buckets.
2. ``_repeated``: a bucket tells the documents which of their anchors another row has too.
   A window without such an anchor cannot repeat, which holds for most text.
3. ``_segments``: the documents send the segments of those anchors to shards.
4. ``_matched``: a shard builds a compressed index of its distinct segments, streams them
   against it, and reports the window ranges that also start in a smaller doc_id.
5. ``removed``: the documents meet the reported ranges.

Rows are known by ``rk``, a hash of doc_id and text, so repeated rows count as one and never
shadow each other.  Exact copies of a whole text are found first by grouping on the text's
hashes; only the copy with the smallest doc_id goes through steps 3 and 4, the others are
covered whole.  Buckets, shards and document parts grow in number with the input's bytes.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scribeflow.llm.common import _BASE, _INVERSE, _powers, mix, stage, trim

WINDOW = 50
#: Text bytes for each anchor bucket and document part.
PART_BYTES = 8 << 20
LEAST_PARTS = 32
#: Shards for each part: an index takes many times the memory of its text.
SHARDS_PER_PART = 4
#: Windows of a segment: text that repeats itself would make endless ones.
LONGEST_RUN = 64
#: Symbols whose hashes are held at a time.
_CHUNK = 1 << 18
_LOW = np.uint64(0xFFFFFFFF)


@dataclass(frozen=True)
class Alphabet:
    """How texts become symbols: ``split`` gives the flat symbols of a list of byte strings
    and their offsets; ``codes`` gives a 64-bit hash of each symbol; ``k``: symbols of an anchor."""

    split: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]
    codes: Callable[[np.ndarray], np.ndarray]
    k: int


def segments(symbols: np.ndarray, offsets: np.ndarray, alphabet: Alphabet,
             window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, row, first window start and end (exclusive) of each maximal run of windows
    with one anchor, cut after ``LONGEST_RUN`` windows and where the hashing goes on to its
    next stretch; a cut changes no window's anchor."""
    n, k = len(symbols), alphabet.k
    out: list[tuple[np.ndarray, ...]] = []
    row_end = offsets[1:]
    for a in range(0, max(0, n - window + 1), _CHUNK):
        b = min(n, a + _CHUNK + window - 1)
        codes = alphabet.codes(symbols[a:b])
        pre = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(codes * _powers(_BASE, len(codes)), out=pre[1:])
        least = mix((pre[k:] - pre[:-k]) * _powers(_INVERSE, len(codes))[:len(codes) - k + 1])
        span, wide = 1, window - k + 1
        while span < wide:
            step = min(span, wide - span)
            least = np.minimum(least[:len(least) - step], least[step:])
            span += step
        at = np.arange(a, a + len(least))
        row = np.searchsorted(row_end, at, side="right")
        inside = at + window <= row_end[row]
        least, at, row = least[inside], at[inside], row[inside]
        if not len(at):
            continue
        first = np.concatenate(([True], (least[1:] != least[:-1]) | (row[1:] != row[:-1])))
        begun = np.maximum.accumulate(np.where(first, at, 0))
        first = np.flatnonzero((at - begun) % LONGEST_RUN == 0)
        last = np.append(first[1:], len(at)) - 1
        out.append((least[first], row[first], at[first], at[last] + 1))
    if not out:
        zero = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), zero, zero, zero
    return tuple(np.concatenate(x) for x in zip(*out))  # type: ignore[return-value]


def _rows(batches: Iterator[pa.RecordBatch], most: int = 1 << 22, second: str = "doc_id") -> Iterator[tuple[list, list, list[bytes]]]:
    """rk, another column and text of rows with up to ``most`` bytes of text at a time (one long text may be more)."""
    for batch in batches:
        rk, ids = batch.column("rk").to_pylist(), batch.column(second).to_pylist()
        col = batch.column("text").cast(pa.large_binary())
        size = 0
        a = 0
        for b in range(batch.num_rows):
            size += len(col[b].as_buffer())
            if size >= most or b == batch.num_rows - 1:
                yield rk[a:b + 1], ids[a:b + 1], col.slice(a, b + 1 - a).to_pylist()
                a, size = b + 1, 0
    trim()


def _by(keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(keys, kind="stable")
    cuts = np.flatnonzero(np.diff(keys[order])) + 1
    for own in np.split(order, cuts) if len(order) else []:
        yield int(keys[own[0]]), own


def _join(*arrays: np.ndarray) -> bytes:
    return struct.pack(f"<{len(arrays)}q", *(len(x) for x in arrays)) + b"".join(np.ascontiguousarray(x).tobytes() for x in arrays)


def _parse(blob: bytes, *kinds: str) -> list[np.ndarray]:
    at, out = 8 * len(kinds), []
    for n, kind in zip(struct.unpack_from(f"<{len(kinds)}q", blob), kinds):
        out.append(np.frombuffer(blob, kind, n, at))
        at += n * np.dtype(kind).itemsize
    return out


def _batch(key: str, keys: list[int], blobs: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array(blobs, pa.binary())], names=[key, "blob"])


def _bucket(anchor: np.ndarray, parts: int) -> np.ndarray:
    return ((anchor >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)


def _anchors(docs: DataFrame, alphabet: Alphabet, parts: int) -> DataFrame:
    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rk, tk, raw in _rows(batches, second="tk"):
            symbols, offsets = alphabet.split(raw)
            anchor, row, _, _ = segments(symbols, offsets, alphabet)
            keys, texts_ = np.array(rk, np.int64), np.array(tk, np.int64)
            names, blobs = [], []
            for b, own in _by(_bucket(anchor, parts)):
                rows, local = np.unique(row[own], return_inverse=True)
                names.append(b)
                blobs.append(_join(keys[rows], texts_[rows], local.astype("<u2" if len(rows) < 1 << 16 else "<u4").view("u1"),
                                   (anchor[own] & _LOW).astype("<u4")))
            if names:
                yield _batch("bucket", names, blobs)

    return docs.mapInArrow(part, "bucket int, blob binary")


def _repeated(anchors: DataFrame, parts: int) -> DataFrame:
    """For each document part, the rows and those of their anchors that other texts have too."""

    def bucket(key, group: pd.DataFrame) -> pd.DataFrame:
        low, rk, tk = [], [], []
        for blob in group["blob"]:
            rows, texts_, local, anchor = _parse(blob, "<i8", "<i8", "u1", "<u4")
            local = local.view("<u2" if len(local) == 2 * len(anchor) else "<u4")
            rk.append(rows[local])
            tk.append(texts_[local])
            low.append(anchor)
        a, r, t = np.concatenate(low), np.concatenate(rk), np.concatenate(tk)
        # what stands alone goes first: most anchors do
        order = np.argsort(a)
        a = a[order]
        again = np.zeros(len(a) + 1, bool)
        again[1:-1] = a[1:] == a[:-1]
        many = again[1:] | again[:-1]
        a, r, t = a[many], r[order[many]], t[order[many]]
        order = np.lexsort((r, t, a))
        a, r, t = a[order], r[order], t[order]
        new = np.concatenate(([True], a[1:] != a[:-1]))[:len(a)]
        other = new | np.concatenate(([True], t[1:] != t[:-1]))[:len(a)]
        single = other | np.concatenate(([True], r[1:] != r[:-1]))[:len(a)]
        group_of = np.cumsum(new) - 1
        keep = single & (np.bincount(group_of, weights=other)[group_of] > 1) if len(a) else single
        a, r = a[keep], r[keep]
        full = (np.int64(key[0]) << np.int64(32)) | a.astype(np.int64)
        out = [(p, _join(r[own], full[own])) for p, own in _by(r % parts)]
        return pd.DataFrame(out, columns=["part", "blob"]).astype({"part": "int32"})

    return anchors.groupBy("bucket").applyInPandas(bucket, "part int, blob binary")


def _segments(dealt: DataFrame, told: DataFrame, alphabet: Alphabet, parts: int) -> DataFrame:
    """The segments of repeated anchors, by shard; copies of a text sent by one task are sent once."""

    def meet(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        hits, copies = [np.zeros(0, np.int64)], set()
        for blob in right["blob"]:
            r, full = _parse(blob, "<i8", "<i8")
            hits.append(full) if len(full) else copies.update(r.tolist())
        wanted = np.unique(np.concatenate(hits))
        out: list[tuple[int, bytes]] = []
        # rows without a doc_id have no place in the order, so they take no part
        left = left[left["doc_id"].notna() & ~left["rk"].isin(copies)].drop_duplicates("rk")
        table = pa.RecordBatch.from_arrays([pa.array(left["rk"], pa.int64()), pa.array(left["doc_id"].astype("int64")), pa.array(left["text"], pa.large_string())],
                                           names=["rk", "doc_id", "text"])
        for rk, ids, raw in _rows(iter([table])):
            symbols, offsets = alphabet.split(raw)
            anchor, row, start, end = segments(symbols, offsets, alphabet)
            full = (_bucket(anchor, parts) << 32) | (anchor & _LOW).astype(np.int64)
            shard = (mix(anchor) % np.uint64(parts * SHARDS_PER_PART)).astype(np.int64)
            found = np.searchsorted(wanted, full)
            hit = np.flatnonzero((found < len(wanted)) & (wanted[np.minimum(found, len(wanted) - 1)] == full)) if len(wanted) else np.zeros(0, np.int64)
            keys, docs_ = np.array(rk, np.int64), np.array(ids, np.int64)
            for s, own in _by(shard[hit]):
                own = hit[own]
                lengths = end[own] - start[own] + WINDOW - 1
                flat = np.repeat(start[own] - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths) + np.arange(lengths.sum())
                rows, local = np.unique(row[own], return_inverse=True)
                out.append((s, _join(keys[rows], docs_[rows], local.astype("<u4"), (start[own] - offsets[row[own]]).astype("<i8"),
                                     lengths.astype("<u4"), symbols[flat])))
        return pd.DataFrame(out, columns=["shard", "blob"]).astype({"shard": "int32"})

    return dealt.groupBy("part").cogroup(told.groupBy("part")).applyInPandas(meet, "shard int, blob binary")


def suffix_order(text: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of ``text`` (dense non-negative symbols), and for each rank whether its
    suffix shares its first ``window`` symbols with the one before.  Prefix doubling that
    sorts only what is not told apart yet."""
    n = len(text)
    top = int(text.max()) + 2
    per = max(1, int(62 // max(1, np.ceil(np.log2(top)))))
    per = min(per, 8)
    key = np.zeros(n, np.int64)
    for j in range(per):
        key *= top
        key[:n - j] += text[j:].astype(np.int64) + 1
    order = np.argsort(key).astype(np.int32)
    key = key[order]
    fresh = np.concatenate(([True], key[1:] != key[:-1]))
    del key
    rank = np.empty(n, np.int32)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n, dtype=np.int32), 0))
    depth = per
    ranks_at = {depth: rank.copy()}
    while True:
        starts = np.flatnonzero(fresh)
        sizes = np.diff(np.append(starts, n))
        tied = np.repeat(sizes > 1, sizes)
        where = np.flatnonzero(tied)
        if not len(where):
            break
        own = order[where]
        nxt = own + depth
        second = np.where(nxt < n, rank[np.minimum(nxt, n - 1)] + 1, 0).astype(np.int64)
        sub = np.argsort(rank[own] * np.int64(n + 1) + second)
        own, second = own[sub], second[sub]
        order[where] = own
        prior = rank[own]
        differ = np.concatenate(([True], (prior[1:] != prior[:-1]) | (second[1:] != second[:-1])))
        fresh[where] |= differ
        rank = rank.copy()
        rank[own] = np.maximum.accumulate(np.where(differ, where, 0))
        depth *= 2
        if depth <= window:
            ranks_at = {depth: rank}
    # windows are equal where their first and last ``half`` symbols are, half being the last depth within the window
    half, at_half = next(iter(ranks_at.items()))
    same = np.ones(max(n - 1, 0), bool)
    shift = 0
    while True:
        at = np.minimum(order + shift, n - 1)
        r = np.where(order + shift < n, at_half[at], -1)
        same &= r[1:] == r[:-1]
        if shift >= window - half:
            break
        shift = min(shift + half, window - half)
    return order, np.concatenate(([False], same))


def _matched(sent: DataFrame, index: Callable, dtype: str, parts: int) -> DataFrame:
    """``index(text, order, starts, lengths)`` streams the segments at ``starts`` of ``text``
    and returns for each text position the rank of a suffix that shares the window there (or -1)."""

    def shard(group: pd.DataFrame) -> pd.DataFrame:
        keys, docs, at, lengths, flat, done = [], [], [], [], [], 0
        for blob in group["blob"]:
            r, d, local, start, size, symbols = _parse(blob, "<i8", "<i8", "<u4", "<i8", "<u4", dtype)
            keys.append(r[local])
            docs.append(d[local])
            at.append(start)
            lengths.append(size.astype(np.int64))
            flat.append(symbols)
        rk, doc, start, size, symbols = (np.concatenate(x) for x in (keys, docs, at, lengths, flat))
        # equal segments are indexed once, with their smallest doc_id
        begin = np.concatenate(([0], np.cumsum(size)[:-1]))
        named: dict[bytes, int] = {}
        raw, width = symbols.tobytes(), symbols.dtype.itemsize
        which = np.fromiter((named.setdefault(raw[a * width:(a + m) * width], len(named)) for a, m in zip(begin.tolist(), size.tolist())),
                            np.int64, len(size))
        least = np.full(len(named), np.iinfo(np.int64).max)
        np.minimum.at(least, which, doc)
        first = np.full(len(named), -1)
        first[which[::-1]] = np.arange(len(which))[::-1]
        m = size[first]
        dense = np.unique(symbols, return_inverse=True)[1].astype(np.int32) + 1 if width > 1 else symbols.astype(np.int32) + 1
        starts = np.concatenate(([0], np.cumsum(m + 1)[:-1]))
        text = np.zeros(int((m + 1).sum()), np.int32)  # 0 ends each segment
        into = np.repeat(starts - np.concatenate(([0], np.cumsum(m)[:-1])), m) + np.arange(m.sum())
        text[into] = dense[np.repeat(begin[first] - np.concatenate(([0], np.cumsum(m)[:-1])), m) + np.arange(m.sum())]
        order, same = suffix_order(text)
        # smallest doc_id among the suffixes that share a window
        owner = np.full(len(text), np.iinfo(np.int64).max)
        owner[into] = np.repeat(least, m)
        cls = np.cumsum(~same) - 1
        low = np.full(int(cls[-1]) + 1, np.iinfo(np.int64).max)
        np.minimum.at(low, cls, owner[order])
        rank = index(text, order, starts, m)
        smallest = np.where(rank >= 0, low[cls[np.maximum(rank, 0)]], np.iinfo(np.int64).max)
        # each occurrence: its windows whose smallest doc_id is below its own
        windows = size - WINDOW + 1
        flat_at = np.repeat(starts[which] - np.concatenate(([0], np.cumsum(windows)[:-1])), windows) + np.arange(windows.sum())
        occurrence = np.repeat(np.arange(len(size)), windows)
        hit = smallest[flat_at] < doc[occurrence]
        place = flat_at - starts[which][occurrence] + start[occurrence]
        edge = np.concatenate(([False], hit[1:] & hit[:-1] & (occurrence[1:] == occurrence[:-1])))
        a = np.flatnonzero(hit & ~edge)
        b = np.flatnonzero(hit & ~np.append(edge[1:], False))
        r, lo, hi = rk[occurrence[a]], place[a], place[b] + WINDOW
        out = [(p, _join(r[own], lo[own].astype("<i8"), hi[own].astype("<i8"))) for p, own in _by(r % parts)]
        return pd.DataFrame(out, columns=["part", "blob"]).astype({"part": "int32"})

    return sent.groupBy("shard").applyInPandas(shard, "part int, blob binary")


def _spans(symbols: int, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal covered runs of ``symbols`` positions."""
    depth = np.zeros(symbols + 1, np.int64)
    np.add.at(depth, lo, 1)
    np.add.at(depth, hi, -1)
    covered = np.concatenate(([False], np.cumsum(depth)[:-1] > 0, [False]))
    return np.flatnonzero(covered[1:] & ~covered[:-1]), np.flatnonzero(~covered[1:] & covered[:-1])


def removed(docs: DataFrame, alphabet: Alphabet, index: Callable, dtype: str, cut: Callable, schema: str,
            carry: list[str] | None = None, name: str = "windows") -> DataFrame:
    """``cut(rows, spans)`` makes the result rows of a part: ``rows`` is a pandas frame with
    doc_id, text and the carried columns, ``spans`` the covered runs (start, end) of each row."""
    carry = carry or []
    own = docs.select(docs["doc_id"].cast("long").alias("doc_id"),
                      F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"), *[docs[c] for c in carry])
    own = own.withColumn("rk", F.xxhash64("doc_id", "text"))
    narrow = stage(own.select("rk", "doc_id", F.xxhash64("text").alias("h"), F.crc32(F.col("text").cast("binary")).alias("c"),
                              F.octet_length("text").alias("n")), f"{name}-rows")
    total = narrow.agg(F.sum(F.col("n").cast("long"))).first()[0] or 0
    parts = max(LEAST_PARTS, total // PART_BYTES)
    # exact copies: every row of a text but those of its smallest doc_id
    least = narrow.where("doc_id is not null and n > 0").groupBy("h", "c", "n").agg(F.min("doc_id").alias("least"), F.count("*").alias("k")).where("k > 1")
    copies = narrow.join(least, ["h", "c", "n"]).where("doc_id > least").select(F.pmod("rk", F.lit(parts)).cast("int").alias("part"), "rk").distinct()
    marks = copies.groupBy("part", F.pmod(F.xxhash64("rk", F.lit("mark")), F.lit(16))).agg(F.collect_list("rk").alias("rks"))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield _batch("part", batch.column("part").to_pylist(),
                             [_join(np.array(x, np.int64), np.zeros(0, np.int64)) for x in batch.column("rks").to_pylist()])

    marked = stage(marks.select("part", "rks").mapInArrow(mark, "part int, blob binary"), f"{name}-copies")
    known = own.where("doc_id is not null").select("rk", F.xxhash64("text").alias("tk"), "text")
    told = _repeated(_anchors(known, alphabet, parts), parts).unionByName(marked)
    # the texts are dealt out once: both cogroups below read the same exchange
    dealt = own.withColumn("part", F.pmod("rk", F.lit(parts)).cast("int"))
    sent = _segments(dealt, told, alphabet, parts)
    found = _matched(sent, index, dtype, parts).withColumn("copy", F.lit(False)).unionByName(marked.withColumn("copy", F.lit(True)))

    def finish(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        rk, lo, hi, copied = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], set()
        for blob, copy in zip(right["blob"], right["copy"]):
            if copy:
                copied.update(_parse(blob, "<i8", "<i8")[0].tolist())
                continue
            for x, y in zip((rk, lo, hi), _parse(blob, "<i8", "<i8", "<i8")):
                x.append(y)
        r, a, b = (np.concatenate(x) for x in (rk, lo, hi))
        order = np.argsort(r, kind="stable")
        r, a, b = r[order], a[order], b[order]
        rows = left["rk"].to_numpy(np.int64)
        begin, end = np.searchsorted(r, rows), np.searchsorted(r, rows, side="right")
        raw = [t.encode() for t in left["text"]]
        spans = []
        for k, x in enumerate(raw):
            if int(rows[k]) in copied:
                n = int(alphabet.split([x])[1][-1])
                spans.append((np.array([0]), np.array([n])) if n >= WINDOW else (np.zeros(0, np.int64), np.zeros(0, np.int64)))
            elif begin[k] < end[k]:
                n = int(b[begin[k]:end[k]].max())
                spans.append(_spans(n, a[begin[k]:end[k]], b[begin[k]:end[k]]))
            else:
                spans.append((np.zeros(0, np.int64), np.zeros(0, np.int64)))
        return cut(left, raw, spans)

    return dealt.groupBy("part").cogroup(found.groupBy("part")).applyInPandas(finish, schema)
