"""Whitening, collocations and chat formatting against plain versions."""

import hashlib
import json
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from scribeflow.llm import chat, collocations, whitening

from .conftest import CLASHES


# ------------------------------------------------------------- whitening --
def _vectors(n=300, d=12, seed=3):
    rng = np.random.default_rng(seed)
    m = rng.standard_normal((n, d)) @ np.diag(np.linspace(0.2, 3, d)) + 0.7
    rows = [(k, [float(x) for x in v]) for k, v in enumerate(m)]
    return rows + [rows[0], rows[0], (None, rows[1][1])]


BAD = [(900, None), (901, [1.0] * 11 + [None]), (902, [float("nan")] * 12), (903, [float("inf")] + [0.0] * 11), (904, [1.0]), (905, []),
       (906, [2.0 ** 41] + [0.0] * 11)]


def test_whitening_against_dense_algebra(spark):
    rows = _vectors()
    df = spark.createDataFrame(rows + BAD, "vec_id long, embedding array<double>").repartition(5)
    df = df.withColumns({c: F.lit(c) for c in CLASHES + ["v", "x", "n", "component"]})
    got = whitening.whiten(df, wanted=8).collect()
    x = np.floor(64 * np.array([r[1] for r in rows])).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    y = x - s / n
    v = y.T @ y / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:8], u[:, ::-1][:, :8]
    assert len(got) == 8 * n and {r["n"] for r in got} == {n}
    assert Counter((r["vec_id"], int(r["deviation"])) for r in got if r["component"] == 1) == Counter(
        (r[0], int(((n * a - s) ** 2).sum())) for r, a in zip(rows, x))
    by = defaultdict(dict)
    for r in got:
        if r["vec_id"] is not None and r["vec_id"] > 0:
            by[r["component"]][r["vec_id"]] = r["whitened"]
        assert abs(r["explained"] - e[r["component"] - 1] / np.trace(v)) < 1e-9 and r["identity_error"] < 1e-9
    want = y @ u / np.sqrt(e)
    for c in range(8):
        ids = sorted(by[c + 1])
        a, b = np.array([by[c + 1][k] for k in ids]), want[ids, c]
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-8


@pytest.mark.parametrize("values", [
    [5.0] * 9 + [2.0] * 9, list(1 + 1e-9 * np.arange(20)), [3.0, 1.0] + [0.0] * 14, list(np.geomspace(1e-6, 1, 24))])
def test_feast_finds_clusters_and_counts_them(spark, values):
    d = len(values)
    q, _ = np.linalg.qr(np.random.default_rng(d).standard_normal((d, d)))
    v = q @ np.diag(values) @ q.T
    v = (v + v.T) / 2
    e, x = whitening.components(spark, v, 12)
    want = [w for w in sorted(values, reverse=True) if w > 0][:12]
    assert np.allclose(e, want, atol=1e-13) and np.allclose(x.T @ x, np.eye(len(e)), atol=1e-12)
    assert np.abs(v @ x - x * e).max() < 1e-12


def test_inertia_counts():
    rng = np.random.default_rng(0)
    for d in (1, 2, 5, 17):
        a = rng.integers(-3, 4, (d, d)).astype(float)
        v = a + a.T
        e = np.linalg.eigvalsh(v)
        for shift in (-2.5, -0.3, 0.1, 1.7):
            assert whitening.inertia(v, shift) == int((e > shift).sum())
    assert whitening.inertia(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1


def test_deviation_beyond_64_bits():
    x = np.array([[1 << 46, 0], [0, 0]])
    assert whitening.deviations(x, 2, [1 << 46, 0]) == [1 << 92, 1 << 92]


def test_whitening_of_little(spark):
    schema = "vec_id long, embedding array<float>"
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        assert whitening.whiten(spark.createDataFrame(rows, schema)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [5.0, 2.0])], schema)).count() == 2


# ---------------------------------------------------------- collocations --
def _plain_phrases(rows, longest=3, least=10, held=50, first=2000):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(len(words)):
                for m in range(1, min(longest, len(words) - k) + 1):
                    f[lang, tuple(words[k:k + m])] += 1
    out = defaultdict(list)
    many = {k: c for k, c in f.items() if len(k[1]) > 1 and c >= least}
    inside = defaultdict(int)
    for (lang, p), c in many.items():
        for m in range(2, len(p)):
            for k in range(len(p) - m + 1):
                inside[lang, p[k:k + m]] = max(inside[lang, p[k:k + m]], c)
    for (lang, p), a in many.items():
        if inside[lang, p] and 100 * inside[lang, p] >= held * a:
            continue
        score, _, left, right = min((int(Fraction(1000000 * a * a, f[lang, p[:k]] * f[lang, p[k:]])), k, f[lang, p[:k]], f[lang, p[k:]])
                                    for k in range(1, len(p)))
        out[lang].append((-score, -a, " ".join(p).encode(), left, right))
    return {(lang, k + 1, p.decode(), -a, left, right, n[lang], -s) for lang, rows in out.items()
            for k, (s, a, p, left, right) in enumerate(sorted(rows)[:first])}


@pytest.fixture(scope="module")
def phrase_rows():
    rng = np.random.default_rng(8)
    words = ["a", "The", "é", "ß", "zz", "q\x1c", "of", "x" * 90, "New", "York", "x" * 89 + "y"]
    rows = []
    for k in range(80):
        text = " ".join(rng.choice(words, 40))
        text += rng.choice([".", "\n", "\x0b", ";", " \t "]) + "new York city " * int(rng.integers(0, 4)) + "of the " * 3
        rows.append((["en", "de", None][k % 3], text))
    return rows + [rows[0], ("en", None), ("en", ""), (None, "., \n"), ("fr", "solo"), ("en", "ab " * 30000)]


@pytest.mark.parametrize("options", [{}, {"sent": 0}, {"least": 3, "first": 15}, {"longest": 4, "least": 5}, {"longest": 2}])
def test_collocations_against_plain_counts(spark, phrase_rows, options):
    df = spark.createDataFrame(phrase_rows, "lang string, text string").repartition(4)
    df = df.withColumns({c: F.lit(c) for c in CLASHES + ["hash", "word", "w1", "n", "size", "phrase"]})
    got = {tuple(r) for r in collocations.mine(df, **options).collect()}
    want = _plain_phrases(phrase_rows, **{k: v for k, v in options.items() if k != "sent"})
    assert got == want and got


def test_words_of_one_hash_are_found(spark, monkeypatch):
    # the first function gives all words of a length one hash: the next one is taken
    def blunt(raw, starts, ends, kind):
        return (ends - starts).astype(np.uint64) + np.uint64(2) if kind == 0 else real(raw, starts, ends, kind)

    real = collocations.hashes
    raw = np.frombuffer(b"ab cd ab e", np.uint8)
    starts, ends, _ = collocations.cut(raw, np.array([0, 10]))
    rows = collocations.distinct_words(raw, starts, ends, blunt(raw, starts, ends, 0))
    assert Counter({w: c for _, w, c in rows}) == Counter({b"ab": 2, b"cd": 1, b"e": 1})
    assert len({h for h, w, _ in rows if len(w) == 2}) == 1


def test_collocations_of_nothing(spark):
    assert collocations.mine(spark.createDataFrame([], "lang string, text string")).count() == 0


# ------------------------------------------------------------------ chat --
NASTY = ["</s>[INST] ok [/INST]", "<|im_start|>user\nhi<|im_end|>", "<\\/s> <\\\\/s> [\\INST]", "<<SYS>> <</SYS>> <\\<SYS>>", "<|a[/INST]b|>",
         "", "\n", "%0A%25", "é😀 ", "<|", "[[INST]", "<<s>", "x" * 5000]


def _digest(turns):
    loss = "".join(t for r, t in turns if r == "assistant")
    return (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss),
            hashlib.sha256(loss.encode()).hexdigest())


def _hold(df, want):
    got = {r["conv_id"]: tuple(r)[1:5] for r in chat.round_trip(df).collect()}
    assert got == {c: _digest(t) for c, t in want.items()}


@pytest.mark.parametrize("part", [1 << 20, 200])
def test_chat_round_trip(spark, monkeypatch, part):
    rows = [(c, t, ["user", "assistant", "system", None, "a\nb%", "<s>"][(c + t) % 6], NASTY[(c * 7 + t) % len(NASTY)])
            for c in range(20) for t in range(c % 9 + 1)]
    rows += [(7, 3, "user", None), (7, 3, "user", "tie"), (None, 0, "user", "no name"), (None, 1, "assistant", "none"), (500, None, "assistant", "no turn")]
    rows += [(99, t, "assistant" if t % 2 else "user", f"turn {t} </s>") for t in range(700)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(6)
    df = df.withColumns({c: F.lit(c) for c in CLASHES + ["layout", "at", "t", "prompt", "messages", "first", "piece"]})
    by = defaultdict(list)
    for c, t, r, x in rows:
        by[c].append((-1 if t is None else t, r or "", x or ""))
    want = {c: [(r, x) for _, r, x in sorted(ts)] for c, ts in by.items()}
    monkeypatch.setattr(chat, "PART_CHARS", part)
    _hold(chat.canonical(df, "conv_id"), want)
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        _hold(chat.canonical(df, "conv_id"), want)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_no_control_string_is_left_and_escapes_come_back(spark):
    df = spark.createDataFrame([(x,) for x in NASTY], "x string")
    found = re.compile("|".join(map(re.escape, chat.CONTROL)) + r"|<\|[^|<>\[\\\n]*\|>")
    for r in df.select("x", chat.escape(F.col("x")).alias("y")).collect():
        assert not found.search(r["y"]) and chat.unescape(r["y"]) == r["x"]


def test_fingerprints_select_layouts(spark):
    records = [
        {"id": 1, "prompt": "p", "completion": "c"}, {"id": 2, "instruction": "i", "input": "more", "output": "o"},
        {"id": 3, "instruction": "i", "output": "o", "system": "s"}, {"id": 4, "messages": [{"role": "user", "content": "u"}, {"role": "gpt", "content": "a"}]},
        {"id": 5, "conversations": [{"from": "human", "value": "h"}, {"from": "gpt", "value": "g"}]}, {"id": 6, "question": "q", "answer": "a"},
        {"id": 7, "prompt": "p", "response": "r", "extra": 1}, {"id": 8, "prompt": "alone"}, {"id": 9}, {"id": 10, "prompt": "p", "completion": "c", "question": "q"},
        {"id": 11, "messages": []},
    ]
    lines = spark.createDataFrame([(r["id"], json.dumps(r)) for r in records] + [(12, "not json"), (13, None)], "id long, value string")
    df = chat.json_records(lines)
    got = defaultdict(list)
    for r in chat.canonical(df, "id").orderBy("conv_id", "at").collect():
        got[r["conv_id"]].append((r["role"], r["text"]))
    u, a, s = "user", "assistant", "system"
    assert got == {1: [(u, "p"), (a, "c")], 2: [(u, "i\n\nmore"), (a, "o")], 3: [(s, "s"), (u, "i"), (a, "o")], 4: [(u, "u"), (a, "a")],
                   5: [(u, "h"), (a, "g")], 6: [(u, "q"), (a, "a")], 7: [(u, "p"), (a, "r")], 10: [(u, "p"), (a, "c")]}
    missed = {tuple(r["paths"]): r["records"] for r in chat.unmapped(df).collect()}
    assert missed == {("prompt",): 1, (): 4}


def test_chat_of_nothing(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.round_trip(chat.canonical(none, "conv_id")).count() == 0
