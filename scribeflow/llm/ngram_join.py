"""Exact Jaccard self-join of word shingle sets, size-aware: a heavy-light join.

Two texts link when 100 |A n B| >= 75 |A u B| over their distinct 5-word shingles, which for
sizes a and b means at least c(a, b) = ceil(3 (a + b) / 7) common ones.

Light sets (up to ``boundary()`` shingles, where enumerating is the cheaper way) emit every
subset of c(a, b) shingles for each size that a partner may have: sets that share a subset link.

Heavy sets scan inverted lists.  In any fixed order of all shingles the first common shingle of
a linked pair stands so early in both that the two places sum to at most (a + b) / 7, so only
prefixes are listed.  The order is by hash, with very frequent shingles moved back:

1. every text sends its shingles (long texts: those with a small hash) with their places in
   hash order to buckets, which tell the texts which of theirs other texts have too, and which
   are in more than ``HOT`` texts;
2. from that the places in the final order follow, and the texts list their prefixes; shingles
   that no other text has are left out;
3. pairs from the lists that share enough of their prefixes are checked on the whole sets, first
   one for each node, then those whose nodes are not connected yet.  Up to where the first of
   two prefixes ends, all common shingles are known, so the sets have at most as many more as
   are left of one of them.

The lists of frequent shingles, such as those of a large group of near copies, are not paired
out: each member is checked against the list's pivot.  Members that end in the pivot's
component need no further check among themselves; the others are tried with a few members inside,
and what is still outside meets all members in blocks whose common shingles are counted by matrix
products.  So no link between components is lost, and no pairs within a group are listed.

Equal texts are one node, and sets that are equal link at once.  Defined results: texts without
words (null, empty) have no shingles and link with nothing; repeated rows share a node; a null
doc_id is never a component's name unless no other is there; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scribeflow.llm.common import mix, release, stage, word_hashes, word_spans
from scribeflow.llm.components import components, forest
from scribeflow.llm.windows import _by, _join, _parse, _rows
from scribeflow.operators.timeline import free_name

WORDS = 5
#: A shingle in more texts than this has a pivot instead of pairs.
HOT = 64
#: Long texts list shingles below this share of all hashes; short ones list all.
SHARE = 0.4
LONG, SHORT = 64, 86
#: Members outside their pivot's component are tried with about so many inside, before the rest of
#: them meet all, in blocks of at most so many sets and shingles.
TRIES = 8
BLOCK_SETS, BLOCK_TOKENS = 4096, 4 << 20
#: Wanted nodes up to here are broadcast, to send only their texts; beyond, all texts are sent.
BROADCAST_NODES = 1_000_000
PART_BYTES = 8 << 20
LEAST_PARTS = 32
_EDGE = np.uint64(int(SHARE * 2**64))
_ODD = np.uint64(0x9E3779B97F4A7C15)
_LOW = np.uint64(0xFFFFFFFF)
_PAIRS = 1 << 20
#: Shingles that are columns of a matrix at a time.
_COLUMNS = 2048


def needed(a: int, b: int) -> int:
    """Common shingles that sets of these sizes need to link."""
    return -(-3 * (a + b) // 7)


def prefix(n: np.ndarray) -> np.ndarray:
    """How many of the first shingles any partner's first common one can be among."""
    return n - (3 * n + 3) // 4 + 1


def _subsets(n: int) -> list[tuple[int, int, int]]:
    """(smaller size, larger size, common shingles) of the pairs that a set of size n can be in."""
    return [(min(n, m), max(n, m), needed(n, m)) for m in range(1, 2 * n + 1)
            if 4 * min(n, m) >= 3 * max(n, m) and needed(n, m) <= min(n, m)]


def boundary() -> int:
    """The largest size whose subsets cost no more than twice its prefix and its check."""
    n = 1
    while sum(comb(n + 1, c) for _, _, c in _subsets(n + 1)) <= 2 * (int(prefix(np.array(n + 1))) + n + 1):
        n += 1
    return n


def shingle_sets(raw: list[bytes], words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row and hash of every distinct shingle, in order, and the rows' sizes.  A text with
    fewer words is one shingle."""
    flat = np.frombuffer(b"".join(raw), np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in raw], dtype=np.int64)))
    starts, ends, rows = word_spans(flat, offsets)
    h = word_hashes(flat, starts, ends, lower=True)
    count = np.diff(rows)
    with np.errstate(over="ignore"):
        salt = mix(np.arange(1, words + 1, dtype=np.uint64) * _ODD) | np.uint64(1)
        whole = np.zeros(max(0, len(h) - words + 1), np.uint64)
        for j in range(words):
            whole += h[j:j + len(whole)] * salt[j]
        at = np.arange(len(whole))
        row = np.searchsorted(rows[1:], at, side="right")
        fits = at + words <= rows[1:][row] if len(at) else np.zeros(0, bool)
        short = np.flatnonzero((count > 0) & (count < words))
        part = np.array([sum((int(h[rows[r] + j]) * int(salt[j]) for j in range(int(count[r]))), int(count[r])) & (2**64 - 1)
                         for r in short.tolist()], np.uint64)
    token = mix(np.concatenate((whole[fits], part)))
    row = np.concatenate((row[fits], short)) if len(at) else short
    order = np.lexsort((token, row))
    token, row = token[order], row[order]
    new = np.concatenate(([True], (token[1:] != token[:-1]) | (row[1:] != row[:-1])))[:len(token)]
    token, row = token[new], row[new]
    return row, token, np.bincount(row, minlength=len(raw))


_SHORT, _KNOWN, _UNKNOWN = range(3)
_NODES, _LIGHT, _SHINGLES, _POSTINGS, _PIVOTS = range(5)


def _entries(row: np.ndarray, token: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """The shingles that a text sends, for the lists of long texts and for those of short ones, by
    its size: row, key, code, and place in hash order.  Long texts send those below ``SHARE``
    of all hashes, and as many more as their prefix asks for."""
    bounds = np.searchsorted(row, np.arange(len(n) + 1))
    place = np.arange(len(row)) - bounds[row]
    long, short = n[row] >= LONG, n[row] < SHORT
    known = token < _EDGE
    some = np.flatnonzero(long & (known | (place < prefix(n[row]))))
    all_ = np.flatnonzero(short)
    pick = np.concatenate((some, all_))
    code = np.concatenate((np.where(known[some], _KNOWN, _UNKNOWN), np.full(len(all_), _SHORT)))
    return row[pick], mix(token[pick] + (code != _SHORT).astype(np.uint64) * _ODD), code, place[pick]


def _full(key: np.ndarray, parts: int) -> np.ndarray:
    return (((key >> np.uint64(32)) % np.uint64(parts)).astype(np.int64) << 32) | (key & _LOW).astype(np.int64)


def _narrow(x: np.ndarray) -> np.ndarray:
    """Counts in 2 or 4 bytes, as bytes."""
    return x.astype("<u4" if len(x) and int(x.max()) >> 16 else "<u2").view(np.uint8)


def _wide(x: np.ndarray, n: int) -> np.ndarray:
    return x.view("<u2" if len(x) == 2 * n else "<u4").astype(np.int64)


def _light_subsets(tk: list[int], token: np.ndarray, bounds: np.ndarray, n: np.ndarray) -> list[tuple[int, int, int]]:
    """Subset, whether the set is the smaller one of its pairs, node."""
    light = boundary()
    out = []
    for r in np.flatnonzero((n > 0) & (n <= light)).tolist():
        own = token[bounds[r]:bounds[r + 1]].tolist()
        for a, b, c in _subsets(len(own)):
            if b <= light:
                out += [(hash((a, b, *some)), int(len(own) == a), tk[r]) for some in combinations(own, c)]
    return out


def _sent(docs: DataFrame, parts: int) -> DataFrame:
    """By kind: the nodes (key, size, fingerprint), the subsets of light sets, and the shingles
    (of nodes with key and size: node, place and code, rest of the key)."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tk, _, raw in _rows(batches):
            rows: dict[int, int] = {}
            for k, t in enumerate(tk):
                rows.setdefault(t, k)
            tk, raw = list(rows), [raw[k] for k in rows.values()]
            keys = np.array(tk, np.int64)
            row, token, n = shingle_sets(raw)
            with np.errstate(over="ignore"):
                print_ = np.zeros(len(raw), np.uint64)
                np.add.at(print_, row, mix(token ^ _ODD))
                print_ = mix(print_ + n.astype(np.uint64))
            out = [(_NODES, tk[0] % parts, _join(keys, n.astype("<i8"), print_.view(np.int64)))]
            cuts = _light_subsets(tk, token, np.searchsorted(row, np.arange(len(raw) + 1)), n)
            if cuts:
                out.append((_LIGHT, tk[0] % parts, _join(*(np.array(x, np.int64) for x in zip(*cuts)))))
            row, key, code, place = _entries(row, token, n)
            full = _full(key, parts)
            known = np.bincount(row[code == _KNOWN], minlength=len(raw))
            for b, own in _by(full >> 32):
                some, local = np.unique(row[own], return_inverse=True)
                out.append((_SHINGLES, b, _join(keys[some], n[some].astype("<u4"), known[some].astype("<u4"), _narrow(local), _narrow(place[own] * 4 + code[own]),
                                                (full[own] & 0xFFFFFFFF).astype("<u4"))))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.int32()),
                                              pa.array([x[2] for x in out], pa.binary())], names=["kind", "bucket", "blob"])

    return docs.mapInArrow(part, "kind int, bucket int, blob binary")


def _told(sent: DataFrame, parts: int) -> DataFrame:
    """For each part, the shingles of its nodes that two or more texts have, with the pivots of
    the hot ones.  Nodes and light sets pass through."""

    def bucket(key, group: pd.DataFrame) -> pd.DataFrame:
        out = [(kind, 0, blob) for kind, blob in zip(group["kind"], group["blob"]) if kind != _SHINGLES]
        low, tk, size, known, place = [], [], [], [], []
        for blob in group["blob"][group["kind"] == _SHINGLES]:
            keys, n, of, local, at, own = _parse(blob, "<i8", "<u4", "<u4", "u1", "u1", "<u4")
            local = _wide(local, len(own))
            tk.append(keys[local])
            size.append(n[local])
            known.append(of[local])
            place.append(_wide(at, len(own)))
            low.append(own)
        if low:
            a = np.concatenate(low)
            order = np.argsort(a)
            a = a[order]
            again = np.zeros(len(a) + 1, bool)
            again[1:-1] = a[1:] == a[:-1]
            many = again[1:] | again[:-1]
            a, order = a[many], order[many]
            t, n, u, at = (np.concatenate(x)[order] for x in (tk, size, known, place))
            order = np.lexsort((t, a))
            a, t, n, u, at = (x[order] for x in (a, t, n, u, at))
            new = np.concatenate(([True], (a[1:] != a[:-1]) | (t[1:] != t[:-1])))[:len(a)]
            a, t, n, u, at = (x[new] for x in (a, t, n, u, at))
            start = np.flatnonzero(np.concatenate(([True], a[1:] != a[:-1])))[:len(a)]
            held = np.diff(np.append(start, len(a)))
            least, held = np.repeat(t[start], held), np.repeat(held, held)
            keep = held > 1
            a, t, n, u, at, least = (x[keep] for x in (a, t, n, u, at, least))
            hot = (held[keep] > HOT) & (at % 4 != _UNKNOWN)
            full = (np.int64(key[0]) << np.int64(32)) | a.astype(np.int64)
            for p, own in _by(t % parts):
                some, local = np.unique(t[own], return_inverse=True)
                first = np.zeros(len(some), np.int64)
                first[local] = own
                out.append((_SHINGLES, p, _join(some, n[first].astype("<u4"), u[first].astype("<u4"), local.astype("<u4"), at[own].astype("<u4"), full[own],
                                                hot[own].astype("u1"), least[own][hot[own]])))
        return pd.DataFrame(out, columns=["kind", "part", "blob"]).astype({"kind": "int32", "part": "int32"})

    return sent.groupBy("bucket").applyInPandas(bucket, "kind int, part int, blob binary")


def _prefixes(told: DataFrame) -> DataFrame:
    """By kind: the postings of the prefixes, and pairs with pivots."""

    def part(group: pd.DataFrame) -> pd.DataFrame:
        got = []
        for blob in group["blob"]:
            some, n, known, local, at, full, hot, least = _parse(blob, "<i8", "<u4", "<u4", "<u4", "<u4", "<i8", "u1", "<i8")
            pivot = np.zeros(len(at), np.int64)
            pivot[hot == 1] = least
            got.append((some[local], n[local].astype(np.int64), known[local].astype(np.int64), at.astype(np.int64), full, hot == 1, pivot))
        tk, n, known, at, full, hot, pivot = (np.concatenate(x) for x in zip(*got))
        place, code = at // 4, at % 4
        lists = np.where(code == _SHORT, 0, 1)
        order = np.lexsort((place, lists, tk))
        tk, n, known, place, full, hot, pivot, lists, code = (x[order] for x in (tk, n, known, place, full, hot, pivot, lists, code))
        begin = np.flatnonzero(np.concatenate(([True], (tk[1:] != tk[:-1]) | (lists[1:] != lists[:-1]))))
        size = np.diff(np.append(begin, len(tk)))
        # hot ones move behind the others that the text sent as known; those not told are not hot
        moved = np.cumsum(hot) - hot
        moved -= np.repeat(moved[begin], size)
        all_hot = np.repeat(np.add.reduceat(hot.astype(np.int64), begin), size)
        final = np.where(code == _UNKNOWN, place, np.where(hot, np.where(code == _SHORT, n, known) - all_hot + moved, place - moved))
        out = []
        # how many shingles may be shared at all: those told, and those not sent
        reach = np.repeat(np.add.reduceat((code != _UNKNOWN).astype(np.int64), begin), size) + np.where(code == _SHORT, 0, n - known)
        inside = (final < prefix(n)) & (4 * reach >= 3 * n)
        # shingles of the prefix whose lists are not paired out whole
        loose = np.repeat(np.add.reduceat((inside & (hot | (code == _UNKNOWN))).astype(np.int64), begin), size)
        keep = np.flatnonzero(~hot & inside)
        for b, own in _by(full[keep] >> 32):
            own = keep[own]
            out.append((_POSTINGS, b, _join(tk[own], n[own].astype("<u4"), final[own].astype("<u4"), loose[own].astype("<u4"), reach[own].astype("<u4"),
                                            code[own].astype("u1"), (full[own] & 0xFFFFFFFF).astype("<u4"))))
        own = np.flatnonzero(hot & inside & (pivot != tk))
        if len(own):
            pairs = pd.DataFrame({"p": pivot[own], "t": tk[own], "i": final[own], "n": n[own], "r": reach[own]})
            pairs = pairs.groupby(["p", "t"], as_index=False).agg({"i": "min", "n": "max", "r": "max"})
            out.append((_PIVOTS, 0, _join(*(pairs[c].to_numpy(np.int64) for c in ("p", "t", "i", "n", "r")))))
        return pd.DataFrame(out, columns=["kind", "bucket", "blob"]).astype({"kind": "int32", "bucket": "int32"})

    return told.where(F.col("kind") == _SHINGLES).groupBy("part").applyInPandas(part, "kind int, bucket int, blob binary")


def _unfold(made: DataFrame, kind: int, names: list[str]) -> DataFrame:
    """The rows of a kind whose blobs are columns of 64-bit integers."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column("blob").to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in _parse(blob, *["<i8"] * len(names))], names=names)

    return made.where(F.col("kind") == kind).select("blob").mapInArrow(part, ", ".join(f"{x} long" for x in names))


def shortfall(n: np.ndarray, m: np.ndarray, loose_n: np.ndarray, loose_m: np.ndarray) -> np.ndarray:
    """How many common shingles sets of sizes n and m must have among the paired ones of their
    prefixes, for a link to be possible."""
    c = (3 * (n + m) + 6) // 7
    return c - np.maximum(n - prefix(n), m - prefix(m)) - np.minimum(loose_n, loose_m)


def pairs_of_lists(token: np.ndarray, tk: np.ndarray, n: np.ndarray, place: np.ndarray, loose: np.ndarray, reach: np.ndarray,
                   code: np.ndarray, light: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Pairs a < b of one bucket's lists whose sizes allow a link, whether this shingle can be
    their first common one, and their ``shortfall``.  Of a linked pair's places of the first common
    shingle one is at most a seventh of its size.  Lists of shingles of unknown frequency may be
    long, so there only such members are met with their list."""
    early = 7 * place <= n
    whole = code != _UNKNOWN
    order = np.lexsort((tk, ~early, token))
    token, tk, n, place, early, whole, loose, reach, code = (x[order] for x in (token, tk, n, place, early, whole, loose, reach, code))
    start = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1])))[:len(token)]
    end = np.repeat(np.append(start[1:], len(token)), np.diff(np.append(start, len(token))))
    lead = np.flatnonzero(early | whole)
    todo = end[lead] - lead - 1
    lead, todo = lead[todo > 0], todo[todo > 0]
    total = np.cumsum(todo)
    at = 0
    while at < len(lead):
        stop = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + _PAIRS, side="right")))
        m = todo[at:stop]
        a = np.repeat(lead[at:stop], m)
        b = a + 1 + np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
        lo, hi = np.minimum(n[a], n[b]), np.maximum(n[a], n[b])
        # pairs of long texts are found in their own lists
        ok = (4 * lo >= 3 * hi) & (hi > light) & (tk[a] != tk[b]) & ((code[a] != _SHORT) | (lo < LONG))
        ok &= 7 * np.minimum(reach[a], reach[b]) >= 3 * (lo + hi)
        a, b = a[ok], b[ok]
        first = 7 * (place[a] + place[b]) <= n[a] + n[b]
        counted = whole[a] & whole[b]
        yield (np.minimum(tk[a], tk[b]), np.maximum(tk[a], tk[b]), first.astype(np.int64), counted.astype(np.int64),
               shortfall(n[a], n[b], loose[a], loose[b]))
        at = stop


def _paired(made: DataFrame) -> DataFrame:
    """Pairs (a, b) that may link."""
    light = boundary()

    def bucket(group: pd.DataFrame) -> pd.DataFrame:
        got = [_parse(blob, "<i8", "<u4", "<u4", "<u4", "<u4", "u1", "<u4") for blob in group["blob"]]
        tk, n, place, loose, reach, code, token = (np.concatenate(x).astype(np.int64) for x in zip(*got))
        found = [pd.DataFrame(dict(zip(("a", "b", "first", "shared", "least"), x)))
                 for x in pairs_of_lists(token, tk, n, place, loose, reach, code, light)]
        if not found:
            return pd.DataFrame(columns=["a", "b", "first", "shared", "least"]).astype("int64")
        return pd.concat(found).groupby(["a", "b"], as_index=False).agg({"first": "max", "shared": "sum", "least": "max"})

    rows = made.where(F.col("kind") == _POSTINGS).groupBy("bucket").applyInPandas(bucket, "a long, b long, first long, shared long, least long")
    return (rows.groupBy("a", "b").agg(F.max("first").alias("first"), F.sum("shared").alias("shared"), F.max("least").alias("least"))
            .where("first = 1 and shared >= least").select("a", "b"))


def _packed(token: np.ndarray) -> bytes:
    """Hashes as 6 bytes each, in order."""
    return np.ascontiguousarray((token >> np.uint64(16)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _unpacked(raw: memoryview) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def _whole_sets(own: DataFrame, wanted: DataFrame, parts: int, name: str) -> DataFrame:
    """Of each node in ``wanted`` (hub, tk): hub, tk and the set as sorted hashes."""
    wanted = stage(wanted.select("hub", "tk").distinct(), f"{name}-wanted")
    nodes = wanted.select("tk").distinct()
    few = own.select("rk", "text")
    if nodes.count() <= BROADCAST_NODES:
        few = few.join(F.broadcast(nodes), few["rk"] == nodes["tk"], "left_semi")
    few = few.withColumn("part", F.pmod("rk", F.lit(parts)).cast("int"))
    ask = wanted.withColumn("part", F.pmod("tk", F.lit(parts)).cast("int"))

    def meet(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        hubs: dict[int, list[int]] = {}
        for h, t in zip(right["hub"].tolist(), right["tk"].tolist()):
            hubs.setdefault(t, []).append(h)
        left = left[left["rk"].isin(hubs)].drop_duplicates("rk")
        table = pa.RecordBatch.from_arrays([pa.array(left["rk"], pa.int64()), pa.array(left["rk"], pa.int64()), pa.array(left["text"], pa.large_string())],
                                           names=["rk", "doc_id", "text"])
        out = []
        for tk, _, raw in _rows(iter([table])):
            row, token, n = shingle_sets(raw)
            bounds = np.searchsorted(row, np.arange(len(raw) + 1))
            for r, t in enumerate(tk):
                tokens = _packed(token[bounds[r]:bounds[r + 1]])
                out += [(h, t, tokens) for h in hubs[t]]
        return pd.DataFrame(out, columns=["hub", "tk", "tokens"]).astype({"hub": "int64", "tk": "int64"})

    sets = stage(few.groupBy("part").cogroup(ask.groupBy("part")).applyInPandas(meet, "hub long, tk long, tokens binary"), f"{name}-sets")
    release(wanted)
    return sets


def _checked(own: DataFrame, pairs: DataFrame, parts: int, name: str) -> DataFrame:
    """hub, tk, common shingles, sizes and whether the pair links, for pairs (hub, tk).  A set goes
    to each of its hubs, and there meets the hub's own."""
    sets = _whole_sets(own, pairs.select("hub", "tk").union(pairs.select("hub", F.col("hub").alias("tk"))), parts, name)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column("x"), batch.column("y")
            common, na, nb = [], [], []
            for k in range(batch.num_rows):
                s, t = _unpacked(memoryview(x[k].as_buffer())), _unpacked(memoryview(y[k].as_buffer()))
                at = np.minimum(np.searchsorted(t, s), len(t) - 1)
                common.append(int((t[at] == s).sum()))
                na.append(len(s))
                nb.append(len(t))
            c, na, nb = (np.array(v, np.int64) for v in (common, na, nb))
            yield pa.RecordBatch.from_arrays([batch.column("hub"), batch.column("tk"), *(pa.array(v) for v in (c, na, nb)),
                                              pa.array(7 * c >= 3 * (na + nb))], names=["hub", "tk", "common", "nh", "n", "linked"])

    left = sets.where("hub <> tk").select("hub", "tk", F.col("tokens").alias("y"))
    right = sets.where("hub = tk").select("hub", F.col("tokens").alias("x"))
    out = stage(left.join(right, "hub").mapInArrow(part, "hub long, tk long, common long, nh long, n long, linked boolean"), f"{name}-checked")
    release(sets)
    return out


def _named(comps: DataFrame, column: str, name: str) -> DataFrame:
    return comps.select(F.col("node").alias(column), F.col("component").alias(name))


def _apart(pairs: DataFrame, comps: DataFrame) -> DataFrame:
    """Pairs (a, b) whose nodes are in different components."""
    return (pairs.join(_named(comps, "a", "ca"), "a", "left").join(_named(comps, "b", "cb"), "b", "left")
            .where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b"))


def _members(pivoted: DataFrame, checked: DataFrame) -> DataFrame:
    """The members of each pivot, with their distance from it."""
    rows = (pivoted.join(checked.select(F.col("hub").alias("p"), F.col("tk").alias("t"), "common", "nh"), ["p", "t"])
            .select("p", "t", "i", "n", "r", (1 - F.col("common") / (F.col("n") + F.col("nh") - F.col("common"))).alias("d")))
    return stage(rows.withColumn("early", 7 * F.col("i") <= F.col("n")), "members")


def _placed(members: DataFrame, comps: DataFrame) -> DataFrame:
    """The members with their component and their pivot's."""
    return (members.join(_named(comps, "t", "ct"), "t", "left").join(_named(comps, "p", "cp"), "p", "left")
            .withColumns({"c": F.coalesce("ct", "t"), "pc": F.coalesce("cp", "p")}).drop("ct", "cp"))


def _may() -> Column:
    """Whether members u and v of one pivot may link, by components, distances, places, sizes and reach."""
    return ((F.col("u.p") == F.col("v.p")) & (F.col("u.c") != F.col("v.c")) & (F.abs(F.col("u.d") - F.col("v.d")) <= 0.2501)
            & (7 * (F.col("u.i") + F.col("v.i")) <= F.col("u.n") + F.col("v.n"))
            & (4 * F.least("u.n", "v.n") >= 3 * F.greatest("u.n", "v.n"))
            & (7 * F.least("u.r", "v.r") >= 3 * (F.col("u.n") + F.col("v.n"))))


def _some(placed: DataFrame) -> DataFrame:
    """Each member outside its pivot's component with a few inside."""
    inside = placed.where("c = pc")
    buckets = inside.groupBy("p").agg(F.ceil(F.count("*") / TRIES).alias("buckets"))
    own = F.pmod(F.xxhash64("t"), F.col("buckets"))
    u = placed.where("c <> pc").join(buckets, "p").withColumn("own", own).alias("u")
    v = inside.join(buckets, "p").withColumn("own", own).alias("v")
    return u.join(v, _may() & (F.col("u.own") == F.col("v.own"))).select(F.col("v.t").alias("hub"), F.col("u.t").alias("tk")).distinct()


def common_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many shingles each left set shares with each right one."""
    out = np.zeros((len(left), len(right)), np.float32)
    flat = [np.concatenate(x) if x else np.zeros(0, np.uint64) for x in (left, right)]
    both = np.intersect1d(*flat)
    row, code = [], []
    for sets, tokens in zip((left, right), flat):
        at = np.searchsorted(both, tokens)
        there = at < len(both)
        there[there] = both[at[there]] == tokens[there]
        r = np.repeat(np.arange(len(sets)), [len(x) for x in sets])[there]
        order = np.argsort(at[there], kind="stable")
        row.append(r[order])
        code.append(at[there][order])
    for a in range(0, len(both), _COLUMNS):
        m = []
        for r, c, n in zip(row, code, out.shape):
            x, y = np.searchsorted(c, (a, a + _COLUMNS))
            own = np.zeros((n, min(_COLUMNS, len(both) - a)), np.float32)
            own[r[x:y], c[x:y] - a] = 1
            m.append(own)
        out += m[0] @ m[1].T
    return out


def _across(own: DataFrame, placed: DataFrame, parts: int) -> DataFrame:
    """Links (a, b) between the members of a pivot that its component has not got, and all its
    members.  Both are cut into blocks; two blocks meet in one task, as the rows of two matrices
    whose product counts the common shingles.  So a member is one row for each block it meets,
    whatever the number of pairs, and of the links found a spanning forest goes on."""
    outside = F.col("c") != F.col("pc")
    blocks = lambda x: F.greatest(F.ceil(F.count_if(x) / BLOCK_SETS), F.ceil(F.sum(F.when(x, F.col("n"))) / BLOCK_TOKENS)).cast("int")
    cut = placed.groupBy("p").agg(blocks(outside).alias("nu"), blocks(F.lit(True)).alias("nv")).where("nu > 0")
    lists = placed.join(cut, "p").select("p", "t", "c", "nu", "nv", outside.alias("u"))
    mine = lambda n, salt: F.pmod(F.xxhash64("t", F.lit(salt)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    rows = (lists.where("u").select("p", "t", "c", F.lit(True).alias("left"), mine("nu", 1).alias("x"), every("nv").alias("y"))
            .unionByName(lists.select("p", "t", "c", F.lit(False).alias("left"), mine("nv", 2).alias("y"), every("nu").alias("x"))))
    rows = stage(rows.select(F.xxhash64("p", "x", "y").alias("hub"), F.col("t").alias("tk"), "c", "left"), "blocks")
    sets = _whole_sets(own, rows, parts, "blocks")

    def block(about: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        tokens = {t: _unpacked(memoryview(x)) for t, x in zip(held["tk"].tolist(), held["tokens"])}
        about = about.drop_duplicates(["tk", "left"])
        left, right = about[about["left"]], about[~about["left"]]
        c = common_counts([tokens[t] for t in left["tk"]], [tokens[t] for t in right["tk"]])
        n, m = (np.array([len(tokens[t]) for t in x["tk"]], np.int64) for x in (left, right))
        i, j = np.nonzero((7 * c >= 3 * (n[:, None] + m[None, :])) & (left["c"].to_numpy()[:, None] != right["c"].to_numpy()[None, :]))
        return pd.DataFrame(forest(left["tk"].to_numpy()[i].tolist(), right["tk"].to_numpy()[j].tolist()), columns=["a", "b"]).astype("int64")

    links = stage(rows.groupBy("hub").cogroup(sets.groupBy("hub")).applyInPandas(block, "a long, b long"), "block-links")
    release(rows, sets)
    return links


def _linked(comps: DataFrame, edges: DataFrame, name: str) -> DataFrame:
    """The components once ``edges`` are added: only edges between different ones are walked."""
    between = stage(edges.join(_named(comps, "a", "ca"), "a", "left").join(_named(comps, "b", "cb"), "b", "left")
                    .select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")).where("a <> b").distinct(), f"{name}-between")
    if between.isEmpty():
        return comps
    over = components(between, name)
    moved = comps.join(over.select(F.col("node").alias("component"), F.col("component").alias("up")), "component", "left").select(
        "node", F.coalesce("up", "component").alias("component"))
    new = over.join(comps.select("node"), "node", "left_anti")
    out = stage(moved.unionByName(new), name)
    release(between)
    return out


def join(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and text_hash of every row."""
    own = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"))
    own = own.withColumn("rk", F.xxhash64("text"))
    total = own.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    parts = max(LEAST_PARTS, total // PART_BYTES)
    told = stage(_told(_sent(own, parts), parts), "told")
    made = stage(_prefixes(told), "prefixes")
    nodes = stage(_unfold(told, _NODES, ["tk", "n", "print"]).distinct(), "nodes")
    pivoted = stage(_unfold(made, _PIVOTS, ["p", "t", "i", "n", "r"]).groupBy("p", "t").agg(
        F.min("i").alias("i"), F.max("n").alias("n"), F.max("r").alias("r")), "pivoted")
    pairs = stage(_paired(made), "pairs")
    release(made)
    # links that need no check: shared subsets of light sets, and equal sets
    light = _unfold(told, _LIGHT, ["s", "small", "tk"])
    hubs = light.groupBy("s").agg(F.min(F.when(F.col("small") == 1, F.col("tk"))).alias("hub")).where("hub is not null")
    linked = light.join(hubs, "s").select(F.col("hub").alias("a"), F.col("tk").alias("b"))
    same = nodes.where("n > 0").groupBy("n", "print").agg(F.min("tk").alias("hub"), F.count("*").alias("k")).where("k > 1")
    linked = stage(linked.union(nodes.join(same, ["n", "print"]).select(F.col("hub").alias("a"), F.col("tk").alias("b")))
                   .where("a <> b").distinct(), "links")
    release(told)
    # one pair for each node, and all with pivots; most clusters are connected then
    first = pairs.groupBy("b").agg(F.min("a").alias("hub")).select("hub", F.col("b").alias("tk"))
    checked = _checked(own, first.union(pivoted.select(F.col("p").alias("hub"), F.col("t").alias("tk"))).distinct(), parts, "first")
    def found(rows: DataFrame) -> DataFrame:
        return rows.where("linked").select(F.col("hub").alias("a"), F.col("tk").alias("b"))

    def seen(rows: DataFrame) -> DataFrame:
        return rows.select(F.least("hub", "tk").alias("a"), F.greatest("hub", "tk").alias("b"))

    comps = stage(components(linked.union(found(checked))), "comps")
    members = _members(pivoted, checked)
    # what did not link to its pivot mostly links to another member of the pivot's component
    few = stage(_some(_placed(members, comps)), "some")
    if not few.isEmpty():
        more = _checked(own, few, parts, "some")
        comps = _linked(comps, found(more), "some-comps")
        release(more)
    placed = stage(_placed(members, comps), "placed")
    if not placed.where("c <> pc").isEmpty():
        comps = _linked(comps, _across(own, placed, parts), "across-comps")
    rest = stage(_apart(pairs, comps).join(seen(checked), ["a", "b"], "left_anti"), "rest")
    if not rest.isEmpty():
        more = _checked(own, rest.select(F.col("a").alias("hub"), F.col("b").alias("tk")), parts, "rest")
        comps = _linked(comps, found(more), "rest-comps")
    release(checked, members, placed, pairs, pivoted)
    ids = own.select("doc_id", F.col("rk").alias("tk"))
    least = ids.groupBy("tk").agg(F.min("doc_id").alias("own"))
    named = (nodes.where("n > 0").join(least, "tk").join(comps.withColumnRenamed("node", "tk"), "tk", "left")
             .withColumn("component", F.coalesce("component", "tk")))
    names = named.groupBy("component").agg(F.min("own").alias("component_id"))
    of_node = named.select("tk", "n", "component").join(names, "component").select("tk", F.col("n").alias("n_shingles"), "component_id")
    return ids.join(of_node, "tk", "left").select(
        "doc_id", F.coalesce("n_shingles", F.lit(0).cast("long")).alias("n_shingles"),
        F.when(F.col("n_shingles").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.col("tk").alias("text_hash"))


def one_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without those that link, over any number of steps, to one of a smaller
    doc_id; all columns.  Repeated rows become one; rows without words or doc_id stay."""
    gone_id, gone_text, again_id = (free_name(x, docs) for x in ("gone_id", "gone_text", "again_id"))
    gone = join(docs).where("doc_id is not null and doc_id <> component_id").select(
        F.col("doc_id").alias(gone_id), F.col("text_hash").alias(gone_text)).distinct()
    gone = stage(gone, "gone")
    few = gone.count() <= BROADCAST_NODES
    rows = docs.join(F.broadcast(gone) if few else gone,
                     (docs["doc_id"].cast("long") == F.col(gone_id))
                     & (F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit(""))) == F.col(gone_text)), "left_anti")
    again = docs.groupBy(docs["doc_id"].cast("long").alias(again_id)).agg(F.count("*").alias("n")).where(F.col(again_id).isNotNull() & (F.col("n") > 1))
    again = stage(again.select(again_id), "again")
    if again.isEmpty():
        return rows
    repeated = rows.join(again, rows["doc_id"].cast("long") == F.col(again_id), "left_semi").dropDuplicates(["doc_id", "text"])
    return rows.join(again, rows["doc_id"].cast("long") == F.col(again_id), "left_anti").unionByName(repeated)
