"""Each stage of the pipeline, and the whole of it, against plain versions: rows and texts."""

import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from scribeflow.llm import decontaminate, toxicity
from scribeflow.llm.queries import vocabulary
from scribeflow.session import scratch_path

from .conftest import CLASHES, SCHEMA, corpus
from .test_repeats import jaccard

ITEMS = [(1, "the quick ferret hides nine silver spoons under an old oak. Which animal hides the spoons? a ferret of course"), (2, None), (3, "ab")]


def _key(r):
    return r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]


@pytest.fixture(scope="module")
def folder(spark):
    """Tables of an sf_dir: documents with planted toxic words and benchmark passages, labels, items."""
    rows = corpus(45, seed=9)
    extra = []
    for k in range(40):
        bad = k % 4 == 0
        words = [f"p{(k * 7 + j * j) % 97}q" for j in range(30)]
        words[11:11] = ["you", "idiot", "total", "trash"] if bad else []
        extra.append((5000 + k, " ".join(words), "en", "s", 1))
    extra += [(6000 + k, f"u{k} v{k} w{k} " + ITEMS[0][1] + f" x{k} y{k}", "en", "s", 1) for k in range(3)]
    path = scratch_path(spark, "sf")
    docs = spark.createDataFrame(rows + extra, SCHEMA).withColumns({c: F.lit(c) for c in CLASHES})
    docs.repartition(3).write.parquet(f"{path}/documents.parquet")
    labels = [(5000 + k, 1, int(k % 4 == 0)) for k in range(40)] + [(d, 1, 0) for d in sorted({r[0] for r in rows if r[0] is not None})]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def _plain_near(rows):
    """The row of the least doc_id of each group of near copies, each once; rows without words or id stay."""
    parts = jaccard([(r["doc_id"], r["text"]) for r in rows])
    gone = {d for (d, n, c) in parts if d is not None and n and c != d}
    out, seen = [], set()
    repeated = Counter(r["doc_id"] for r in rows)
    for r in rows:
        if r["doc_id"] in gone:
            continue
        if r["doc_id"] is not None and repeated[r["doc_id"]] > 1:
            if (r["doc_id"], r["text"]) in seen:
                continue
            seen.add((r["doc_id"], r["text"]))
        out.append(_key(r))
    return Counter(out)


def _plain_cut(rows):
    """Texts without the bytes that a 50-byte string of a smaller doc_id covers."""
    first: dict[bytes, int] = {}
    for r in rows:
        raw = (r["text"] or "").encode()
        for k in range(len(raw) - 49 if r["doc_id"] is not None else 0):
            w = raw[k:k + 50]
            first[w] = min(first.get(w, r["doc_id"]), r["doc_id"])
    out = []
    for r in rows:
        raw = (r["text"] or "").encode()
        gone = bytearray(len(raw))
        for k in range(len(raw) - 49 if r["doc_id"] is not None else 0):
            if first[raw[k:k + 50]] < r["doc_id"]:
                gone[k:k + 50] = b"\x01" * 50
        text = bytes(b for b, g in zip(raw, gone) if not g).decode("utf-8", "ignore")
        out.append((r["doc_id"], None if r["text"] is None else text, r["lang"], r["source"], 0 if r["text"] is None else len(text)))
    return Counter(out)


def test_stages_and_run_match_plain_versions(spark, folder):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, stages = docs.columns, dict(C.STAGES)

    def step(name, frame):
        path = scratch_path(spark, f"test-{name}")
        stages[name](spark, frame, folder).write.parquet(path)
        out = spark.read.parquet(path)
        assert out.columns == columns
        return out, out.collect()

    # rejected documents go, all others stay as they are
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    scores = {(r["doc_id"], r["score"] >= 0.5) for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect() if r["doc_id"] is not None}
    bad = {d for d, b in scores if b}
    kept, rows = step("toxicity", docs)
    assert Counter(map(_key, rows)) == Counter(_key(r) for r in docs.collect() if r["doc_id"] not in bad)
    assert {5000 + k for k in range(0, 40, 4)} <= bad and not {5001 + k for k in range(0, 40, 4)} & bad
    # one document of each group of near copies
    want = _plain_near(rows)
    kept, rows = step("near_copies", kept)
    assert Counter(map(_key, rows)) == want
    # repeated passages
    want = _plain_cut(rows)
    kept, rows = step("repeats", kept)
    assert Counter(map(_key, rows)) == want
    # documents that hold an item, by the longest common subsequence over the whole text
    item = decontaminate.words([ITEMS[0][1].encode()])[0]
    held = set()
    for r in rows:
        h = decontaminate.words([(r["text"] or "").encode()])[0]
        if len(h) and decontaminate.lcs(item, h).sum() >= decontaminate.SURE * len(item):
            held.add(r["doc_id"])
        if "ab" in decontaminate.re.findall(r"[^\s.,;:!?\"()\[\]|]+", (r["text"] or "").lower()):
            held.add(r["doc_id"])
    want = Counter(_key(r) for r in rows if r["doc_id"] not in held)
    kept, rows = step("leaks", kept)
    assert Counter(map(_key, rows)) == want and any(6000 <= d < 6003 for d in held)
    # pieces of the rest
    encode = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    pieces = Counter()
    for r in rows:
        ids = encode.encode(r["text"] or "", add_special_tokens=False).ids + [0]
        first = len(ids) % 2048 or 2048
        for k, a in enumerate([0, *range(first, len(ids), 2048)]):
            own = ids[a:a + (2048 if k else first)]
            pieces[r["doc_id"], k, a, len(own), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in own))] += 1
    told = lambda df: Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in df.collect())
    assert told(stages["packing"](spark, kept, folder)) == pieces
    assert told(C.run(spark, folder)) == pieces
