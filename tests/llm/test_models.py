"""Toxicity, search, decontamination and licences: held-out accuracy and brute force."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from scribeflow.llm import bm25, decontaminate, licenses, toxicity
from tests.llm.conftest import CLASHES, SCHEMA


def _words(rng, n, size=400):
    return [f"w{rng.randrange(size)}x" for _ in range(n)]


@pytest.fixture(scope="module")
def judged(spark):
    rng = random.Random(2)
    rows, labels = [], []
    for k in range(700):
        w, bad = _words(rng, rng.randint(20, 80)), rng.random() < 0.2
        for _ in range(2 if bad else 0):
            w.insert(rng.randrange(len(w)), rng.choice(["idiot", "trash", "zorgmark", "zorgling"]))
        rows.append((k, " ".join(w), "en", "s", 1))
        if rng.random() < 0.7:
            labels.append((k, 0, int(bad) if rng.random() < 0.97 else int(not bad)))
    rows += [(9001, None, None, None, None), (9002, "", "en", "s", 0), (9003, "you idiot, what trash " * 3000, "en", "s", 1), (None, "idiot", "en", "s", 1)]
    return (spark.createDataFrame(rows, SCHEMA).repartition(3), spark.createDataFrame(labels + [(9001, None, None), (5, 0, None)], "doc_id long, quality int, toxic int"), rows)


def test_toxicity_tells_classes_apart(judged, spark):
    from pyspark.sql import functions as F

    docs, labels, rows = judged
    docs = docs.withColumns({c: F.lit(c) for c in CLASHES})
    got = {r["doc_id"]: r for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()}
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got.values())
    bad = {k for k, t, *_ in rows if t and any(x in t for x in ("idiot", "trash", "zorg"))}
    right = sum((k in bad) == bool(r["predicted"]) for k, r in got.items() if r["held_out"])
    assert right >= 0.93 * sum(r["held_out"] for r in got.values())
    assert got[9003]["predicted"] == 1 and got[9002]["predicted"] == 0 and got[9001]["score"] == got[9002]["score"]
    kept = toxicity.kept(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r["predicted"] == 0 for r in got.values())


def test_toxicity_without_labels_or_rows(judged, spark, none):
    docs, labels, _ = judged
    got = toxicity.score(docs, toxicity.fit(docs, labels.limit(0))).where("doc_id = 9003").first()
    assert got["score"] > 0.5  # the lexicons' votes alone
    assert toxicity.score(none, toxicity.fit(none, labels)).count() == 0


def test_label_model_learns_voters():
    rng = np.random.default_rng(1)
    y = rng.random(4000) < 0.2
    votes = np.full((4000, 4), toxicity.NONE, np.int8)
    for j, (hit, false) in enumerate([(0.9, 0.01), (0.7, 0.05), (0.3, 0.3)]):
        votes[rng.random(4000) < np.where(y, hit, false), j] = toxicity.TOXIC
    votes[:, 3] = np.where(rng.random(4000) < 0.9, votes[:, 1], toxicity.NONE)  # nearly a copy
    model = toxicity.LabelModel(votes)
    p = model.posterior(votes)
    assert ((p > 0.5) == y).mean() > 0.9
    tree = model._tree(votes, np.where(y, 0.95, 0.05))
    assert tree[3] == 1 or tree[1] == 3


def test_bm25_is_exact(spark, rows):
    # a repeated row, and a second text of one id, are asked too
    own = [r for r in rows if r[0] is not None and r[0] % 20 == 0 and r[1]]
    rows = rows + [own[0], own[0], (own[1][0], "another text with the words of " + own[0][1], "en", "s", 1)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = defaultdict(list)
    for r in bm25.search(docs, k=7).collect():
        got[r["query_id"], r["query"]].append((r["rank"], r["doc_id"], r["score"]))
    named = [(d, t or "") for d, t, *_ in rows if d is not None]
    counts = []
    for d, t in named:
        counts.append((d, Counter(bm25.words([t.encode()])[0].view(np.int64).tolist())))
    length = [sum(c.values()) for _, c in counts]
    n, mean = sum(x > 0 for x in length), sum(length) / sum(x > 0 for x in length)
    df = Counter(w for _, c in counts for w in c)
    weight = {w: float(bm25.idf(np.array(df[w]), n)) for w in df}
    asked = {(d, t) for d, t in named if d % 20 == 0 and bm25.words([t.encode()])[0].size}
    assert {(d, int(bm25.query_keys(np.array([d]), [t.encode()])[0])) for d, t in asked} == set(got)
    for d, t in asked:
        terms = set(bm25.words([t.encode()])[0].view(np.int64).tolist())
        scores = []
        for (e, c), m in zip(counts, length):
            s = sum(weight[w] * (c[w] * 2.2 / (c[w] + 1.2 * (0.25 + 0.75 * m / mean))) for w in terms if w in c)
            if s:
                scores.append((-s, e))
        want = sorted(scores)[:7]
        mine = sorted(got[d, int(bm25.query_keys(np.array([d]), [t.encode()])[0])])
        assert [x[0] for x in mine] == list(range(1, len(want) + 1))
        assert np.allclose([x[2] for x in mine], [-s for s, _ in want], rtol=1e-9)
    assert len(asked) >= 4 and len({d for d, _ in asked}) < len(asked)


def test_bm25_asks_whole_texts(spark):
    rows = [(20, " ".join(f"q{k}" for k in range(60)), "en", "s", 1)]
    rows += [(100 + 20 * k + 1, f"q{k} other{k}", "en", "s", 1) for k in range(60)]
    got = bm25.search(spark.createDataFrame(rows, SCHEMA), k=100).collect()
    assert {r["doc_id"] for r in got if r["query_id"] == 20} == {r[0] for r in rows}


def test_bm25_reads_only_postings_of_taken_blocks():
    docs, per = 40 * bm25.BLOCK_DOCS, 4
    row = np.repeat(np.arange(docs), per)
    term = np.tile(np.arange(per), docs)
    tf = np.where(row < 2 * bm25.BLOCK_DOCS, 50, 1)
    index = bm25.Index(np.arange(docs), np.full(docs, 100), row, term, tf, 100.0)
    ids, scores = index.top(np.arange(per), np.ones(per), 5)
    assert ids.tolist() == [0, 1, 2, 3, 4] and np.allclose(scores, per * 50 * 2.2 / 51.2)
    assert index.read < len(row) / 2


def test_bm25_empty(none):
    assert bm25.search(none).count() == 0


def test_decontamination_finds_paraphrases(spark, none):
    from pyspark.sql import functions as F

    rng = random.Random(6)
    items = [(k, " ".join(_words(rng, rng.randint(18, 50), 3000)) + ". " + " ".join(_words(rng, 4, 3000)) + ".") for k in range(40)]
    rows, want = [], set()
    for k in range(300):
        w = _words(rng, rng.randint(10, 150), 3000)
        if k % 5 == 0:
            item = rng.choice(items)
            own = [x for x in item[1].split() if k % 2 or rng.random() > 0.12]
            at = rng.randrange(len(w))
            w, _ = w[:at] + own + w[at:], want.add((k, item[0]))
        rows.append((k, " ".join(w), "en", "s", 1))
    rows += [(901, None, None, None, None), (902, "", "en", "s", 0), (903, "w1x " * 20000, "en", "s", 1), rows[0]]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumns({c: F.lit(c) for c in CLASHES})
    bench = spark.createDataFrame(items + [(99, None), (98, "too short")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, bench).collect()}
    assert got <= want and len(got) >= 0.9 * len(want)
    kept = decontaminate.clean(docs, bench)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {r[0] for r in rows} - {d for d, _ in got}
    assert decontaminate.leaks(none, bench).count() == 0 and decontaminate.clean(docs, bench.limit(0)).count() == len(rows)


def test_lcs_and_svd():
    a = np.array([1, 2, 3, 4, 5], np.uint64)
    assert decontaminate.lcs(a, np.array([9, 1, 3, 9, 5], np.uint64)).sum() == 3
    rng = np.random.default_rng(0)
    raw = [" ".join(f"t{rng.integers(0, 30) + 40 * (k % 4)}" for _ in range(64)).encode() for k in range(400)]
    g = decontaminate.test_matrix()
    z, n = decontaminate.sketch(raw, g)
    counts = sum(decontaminate._counts([r]) for r in raw)[:, 0]
    latent = decontaminate.decompose(z, counts, n, g)
    # the leading singular values are those of the TF-IDF matrix
    idf = np.log((1 + counts.sum()) / (1 + counts)) + 0.05
    dense = []
    for r in raw:
        f = decontaminate.feature(decontaminate.words([r])[0])
        dense += [np.bincount(f[a:a + 32], minlength=1 << decontaminate.BITS) * idf for a in range(0, len(f), 32)]
    exact = np.linalg.svd(np.array(dense), compute_uv=False)
    assert np.allclose(latent.values[:4], exact[:4], rtol=0.1)


def test_licences(spark, none):
    from pyspark.sql import functions as F

    rng = random.Random(3)
    rows, want = [], {}
    lines = {"MIT": "Released under the MIT License.", "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
             "GPL": "This work is licensed under the GNU General Public License, version 3.", "CC-BY-NC": "Licensed under CC BY-NC 4.0."}
    for k in range(300):
        text = [" ".join(_words(rng, rng.randint(5, 60))) for _ in range(rng.randint(1, 5))]
        if k % 7 == 0:
            family = rng.choice(list(lines))
            text.insert(rng.randrange(len(text) + 1), lines[family])
            want[k] = family
        rows.append((k, "\n".join(text), "en", "s", 1))
    rows += [(901, None, None, None, None), (902, "\n\n", "en", "s", 0), (903, "Licensed under the Quux Frobnicate License 1.0.", "en", "s", 1),
             (904, "licence " * 30000, "en", "s", 1)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumns({c: F.lit(c) for c in CLASHES})
    got = defaultdict(set)
    for r in licenses.scan(docs).collect():
        got[r["doc_id"]].add(r["family"])
    assert all(f in got[k] for k, f in want.items())
    assert got[903] == {"unknown"} and not {k for k in got if k not in want} - {903, 904}
    assert licenses.scan(none).count() == 0


def test_licences_inside_long_lines(spark):
    rng = random.Random(8)
    notices = {"MIT": "Released under the MIT License.", "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
               "GPL": "This work is licensed under the GNU General Public License, version 3.", "CC-BY-NC": "Licensed under CC BY-NC 4.0."}
    rows, want = [], {}
    for k in range(120):
        w = _words(rng, rng.randint(20, 300))
        if k % 3 == 0:
            family = list(notices)[k // 3 % 4]
            at = (20, 62, rng.randrange(len(w)))[k // 12 % 3]  # 62: across the limit of a piece
            w[at:at], want[k] = notices[family].split(), family
        rows.append((k, " ".join(w), "en", "s", 1))
    got = defaultdict(set)
    for r in licenses.scan(spark.createDataFrame(rows, SCHEMA)).collect():
        if r["family"] != licenses.UNKNOWN:
            got[r["doc_id"]].add(r["family"])
    assert got == {k: {f} for k, f in want.items()}


def test_licence_sample_comes_from_whole_lines(spark):
    rows = [(k, " ".join(f"word{n}" for n in range(300)), "en", "s", 1) for k in range(40)]
    drawn = licenses.sample(spark.createDataFrame(rows, SCHEMA))
    words = [w for x in drawn for w in x.decode().split()]
    assert len(drawn) == 40 and max(len(x.split()) for x in drawn) == licenses.PIECE
    assert {"word0", "word100", "word299"} <= set(words)


def test_decontamination_finds_short_items_and_scripts_without_blanks(spark):
    rng = random.Random(4)
    items = [(1, "What is zeta?"), (2, "Kelvin"), (3, "\u5149\u5408\u4f5c\u7528\u5728\u53f6\u7eff\u4f53\u4e2d\u8fdb\u884c"), (4, "one two three four five six seven"),
             (5, "\u0e19\u0e49\u0e33\u0e40\u0e14\u0e37\u0e2d\u0e14"), (6, "...")]
    plain = [" ".join(_words(rng, 30)) for _ in range(12)]
    rows = [(0, plain[0]), (1, plain[1] + " what is ZETA " + plain[2]), (2, plain[2] + " kelvin."), (3, "\u524d" + items[2][1] + "\u540e " + plain[3]),
            (4, plain[4] + " one two three four, five six seven " + plain[5]), (5, items[4][1] + plain[5]), (6, plain[6] + " what zeta is"),
            (7, plain[7] + " one two three four five six"), (8, "what is"), (9, "zeta"), (10, "\u5149\u5408"), (11, None)]
    docs = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in rows], SCHEMA).repartition(2)
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = {(1, 1), (2, 2), (3, 3), (4, 4), (5, 5)}
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, bench).collect()} == want
    assert {r["doc_id"] for r in decontaminate.clean(docs, bench).collect()} == {k for k, _ in rows} - {d for d, _ in want}
