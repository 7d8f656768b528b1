"""Substring dedup and the n-gram join against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from scribeflow.llm import fm_dedup, ngram_join, rlbwt_dedup
from scribeflow.llm.components import components
from scribeflow.llm.windows import suffix_order


def brute(rows, split, glue):
    """Per row: symbols, removed, spans, hash of what is kept."""
    items = [(d, split((t or "").encode())) for d, t, *_ in rows]
    first = {}
    for d, s in items:
        if d is not None:
            for a in range(len(s) - 49):
                w = bytes(s[a:a + 50]) if isinstance(s, bytes) else tuple(s[a:a + 50])
                first[w] = min(first.get(w, d), d)
    out = Counter()
    for d, s in items:
        gone = bytearray(len(s))
        for a in range(len(s) - 49 if d is not None else 0):
            w = bytes(s[a:a + 50]) if isinstance(s, bytes) else tuple(s[a:a + 50])
            if first[w] < d:
                gone[a:a + 50] = b"\1" * 50
        kept = glue([x for x, g in zip(s, gone) if not g])
        spans = sum(1 for k in range(len(s)) if gone[k] and (k == 0 or not gone[k - 1]))
        out[d, len(s), sum(gone), spans, hashlib.sha256(kept).hexdigest()] += 1
    return out


def test_words_removed(docs, rows):
    got = Counter(tuple(r) for r in fm_dedup.dedup(docs).collect())
    want = Counter()
    for (d, n, gone, _, h), k in brute(rows, lambda b: b.split(), b" ".join).items():
        want[d, n, gone, h] += k
    assert got == want and sum(g[2] for g in got) > 0


def test_bytes_removed(docs, rows):
    got = Counter(tuple(r) for r in rlbwt_dedup.dedup(docs).collect())
    assert got == brute(rows, lambda b: b, bytes) and sum(g[2] for g in got) > 0


def test_cleaned_keeps_rows_and_columns(docs, rows):
    got = rlbwt_dedup.cleaned(docs)
    assert got.columns == docs.columns and [f.dataType for f in got.schema] == [f.dataType for f in docs.schema]
    out = got.collect()
    assert len(out) == len(rows) and sum(r["text"] is None for r in out) == 2
    assert all(r["n_chars"] == len(r["text"] or "") for r in out)


def test_index_streams_strings_it_does_not_hold():
    """Matching statistics reach the window exactly where the text has such a string."""
    rng = np.random.default_rng(4)
    base = rng.integers(1, 4, 400).astype(np.int32)
    other = np.concatenate((rng.integers(1, 4, 30), base[100:190], rng.integers(1, 4, 40))).astype(np.int32)
    text = np.concatenate((base, [0], other, [0])).astype(np.int32)
    order, same = suffix_order(text)
    assert [int(x) for x in order] == sorted(range(len(text)), key=lambda k: tuple(text[k:]))
    for k in range(1, len(text)):
        a, b = text[order[k]:][:50], text[order[k - 1]:][:50]
        assert same[k] == (len(a) == len(b) == 50 and bool((a == b).all()))
    for module in (fm_dedup, rlbwt_dedup):
        out = module.stream(text, order, np.array([0, 401]), np.array([400, len(other)]))
        for at in range(len(text) - 50):
            inside = at + 50 <= 400 or 401 <= at <= 401 + len(other) - 50
            assert (out[at] >= 0) == inside
            if inside:
                assert (text[order[out[at]]:][:50] == text[at:at + 50]).all()


def jaccard(rows):
    def shingles(t):
        w = re.findall(rb"[^\x20\x09-\x0D]+", bytes(c + 32 if 65 <= c <= 90 else c for c in (t or "").encode()))
        return frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()

    sets = [shingles(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                parent[top(a)] = top(b)
    least = {}
    for k, r in enumerate(rows):
        if r[0] is not None:
            least[top(k)] = min(least.get(top(k), r[0]), r[0])
    return Counter((r[0], len(sets[k]), least.get(top(k)) if sets[k] else r[0]) for k, r in enumerate(rows))


@pytest.mark.parametrize("hot", [64, 3])
def test_ngram_join(docs, rows, hot, monkeypatch):
    monkeypatch.setattr(ngram_join, "HOT", hot)
    got = Counter(tuple(r)[:3] for r in ngram_join.join(docs).collect())
    assert got == jaccard(rows)


def test_light_boundary_and_links():
    assert ngram_join.needed(8, 8) == 7 and ngram_join.boundary() >= 5
    for a in range(1, 40):
        for b in range(a, 2 * a):
            for o in range(1, a + 1):
                assert (100 * o >= 75 * (a + b - o)) == (o >= ngram_join.needed(a, b))


def test_one_of_each_group_stays(docs, rows):
    got = ngram_join.one_each(docs)
    assert got.columns == docs.columns
    want = {d for (d, n, c) in jaccard(rows) if d is not None and d == c}
    assert sorted(r["doc_id"] for r in got.collect() if r["doc_id"] is not None) == sorted(want)


@pytest.mark.parametrize("one_task", [0, 1000])
def test_components(spark, one_task):
    edges = [(1, 2), (2, 3), (3, 4), (4, 5), (5, 6), (10, 11), (11, 12), (20, 19), (7, 7), (6, 5)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long"), one_task=one_task).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 6: 1, 10: 10, 11: 10, 12: 10, 19: 19, 20: 19}


def test_empty_tables(none):
    assert fm_dedup.dedup(none).count() == 0 and rlbwt_dedup.dedup(none).count() == 0
    assert ngram_join.join(none).count() == 0 and ngram_join.one_each(none).count() == 0


def test_ngram_join_of_one_large_group(spark):
    """330 near copies of one text, some too far from most others; the default bound of long lists."""
    rng = random.Random(11)
    base = [f"b{k}" for k in range(120)]
    rows = []
    for k in range(330):
        words = list(base)
        for _ in range(rng.choice([1, 1, 2, 3, 4, 5])):
            words[rng.randrange(len(words))] = f"x{rng.randrange(40)}"
        rows.append((1000 + k, " ".join(words), "en", "s", 1))
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")).collect()}
    sets = [{tuple(t.split()[i:i + 5]) for i in range(116)} for _, t, *_ in rows]
    parent = list(range(len(rows)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                parent[max(top(i), top(j))] = min(top(i), top(j))
    assert got == {1000 + k: 1000 + top(k) for k in range(len(rows))}
    assert len(set(got.values())) > 5


def test_common_counts():
    import numpy as np

    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 60, n).astype(np.uint64) << np.uint64(40)) for n in (0, 5, 40, 90, 1)]
    c = ngram_join.common_counts(sets, sets[1:])
    assert c.shape == (5, 4) and all(c[i, j] == len(np.intersect1d(sets[i], sets[j + 1])) for i in range(5) for j in range(4))
