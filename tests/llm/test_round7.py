"""The index space of the decontamination is fitted on all texts."""

import numpy as np
from pyspark.sql import functions as F

from scribeflow.llm import decontaminate


def test_latent_space_is_fitted_on_all_texts(spark):
    # more texts than the 20,000 that were drawn once; those of the last topic are few
    rows = spark.range(40_000).select(
        F.col("id").alias("doc_id"),
        F.concat_ws(" ", F.concat(F.lit("a"), F.col("id") % 7), F.concat(F.lit("b"), F.col("id") % 11),
                    F.when(F.col("id") % 9999 == 7, F.lit("rare one here"))).alias("text")).repartition(3)
    latent = decontaminate.fit(rows)
    raw = [r["text"].encode() for r in rows.collect()]
    h, offsets = decontaminate.words(raw)
    counts = np.bincount(decontaminate.feature(h), minlength=1 << decontaminate.BITS)
    # a row of the matrix of words by passages for each text
    row = np.repeat(np.arange(len(raw)), np.diff(offsets))
    idf = np.log((1 + counts.sum()) / (1 + counts)) + 0.05
    own, place = np.unique(decontaminate.feature(h), return_inverse=True)
    dense = np.zeros((len(raw), len(own)))
    np.add.at(dense, (row, place), 1.0)
    exact = np.linalg.svd(dense * idf[own], compute_uv=False)
    # as many words as the rank, or fewer: the space is the whole one
    assert len(own) <= decontaminate.RANK and np.allclose(latent.values[:10], exact[:10], rtol=1e-3)


def test_sketch_is_the_plain_product():
    rng = np.random.default_rng(3)
    raw = [" ".join(f"t{k}" for k in rng.integers(0, 90, n)).encode() for n in (0, 1, 31, 32, 33, 200)] + [b""]
    g = decontaminate.test_matrix(5)
    z, n = decontaminate.sketch(raw, g)
    want, passages = np.zeros_like(z), 0
    for r in raw:
        f = decontaminate.feature(decontaminate.words([r])[0])
        for a in range(0, len(f), decontaminate.PASSAGE):
            own = np.bincount(f[a:a + decontaminate.PASSAGE], minlength=len(g))
            want += np.outer(own, own @ g)
            passages += 1
    assert n == passages and np.allclose(z, want, atol=1e-3)
    assert decontaminate.sketch([], g)[1] == 0


def test_bound_of_words_near_a_candidate_holds():
    rng = np.random.default_rng(8)
    items = decontaminate.prepare([(k, " ".join(f"t{w}" for w in rng.integers(0, 60, 8 + 3 * k))) for k in range(12)],
                                  decontaminate.Latent(np.ones((1 << decontaminate.BITS, 2), np.float32), np.ones(2)))
    h, _ = decontaminate.words([" ".join(f"t{w}" for w in rng.integers(0, 300, 900)).encode()])
    f = decontaminate.feature(h)
    lo = rng.integers(0, 899, 400)
    hi = np.minimum(900, lo + rng.integers(1, 200, 400))
    ks = rng.integers(0, 12, 400)
    got = decontaminate._at_most(lo, hi, ks, f, decontaminate._before(f), items)
    own = [np.array(sorted(s), np.uint64) for s in items.sets]
    for a, b, k, n in zip(lo, hi, ks, got):
        there = set(f[a:b].tolist())
        assert n == sum(int(x) in there for x in decontaminate.feature(own[k])) >= len(items.sets[k] & set(h[a:b].tolist()))
    assert len(decontaminate._at_most(lo[:0], hi[:0], ks[:0], f, decontaminate._before(f), items)) == 0


def test_bm25_in_blocks_of_queries_and_shards(spark, rows, monkeypatch, tmp_path):
    from scribeflow.llm import bm25
    from tests.llm.conftest import SCHEMA

    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    want = sorted(map(tuple, bm25.search(docs, k=4, every=2).collect()))
    sent, broadcast = [], spark.sparkContext.broadcast
    monkeypatch.setattr(spark.sparkContext, "broadcast", lambda x: sent.append(x) or broadcast(x))
    monkeypatch.setattr(bm25, "QUERY_BYTES", 2000)
    monkeypatch.setattr(bm25, "SHARD_BYTES", 1000)
    monkeypatch.setattr(bm25, "POSTED_BYTES", 500)
    got = bm25.search(docs, k=4, every=2)
    # each query is sent once, in several blocks; the first broadcast is the word list
    assert len(sent) > 4 and sum(len(x[0]) for x in sent[1:]) == len({r[4] for r in want})
    assert sorted(map(tuple, got.collect())) == want
    # what is stored of the postings and queries does not grow with the other
    stored = [(f.split("/")[-2].split("-")[0]) for f in got.inputFiles()]
    assert set(stored) == {"found"}


def test_bm25_floor_of_shards_before_loses_nothing():
    from scribeflow.llm import bm25

    rng = np.random.default_rng(4)
    n, per = 3 * bm25.BLOCK_DOCS, 6
    row, term = np.repeat(np.arange(n), per), np.concatenate([rng.choice(50, per, replace=False) for _ in range(n)])
    index = bm25.Index(np.arange(n), np.full(n, 9), row, term, rng.integers(1, 9, len(row)), 9.0)
    ids, scores = index.top(np.arange(20), np.ones(20), 8)
    for reached in (scores[-1], scores[3]):
        near, own = index.top(np.arange(20), np.ones(20), 8, reached)
        assert ids[scores >= reached].tolist() == near[own >= reached].tolist()


def test_leaks_stage_of_the_pipeline_sums_all_texts(spark, monkeypatch, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([(1, "one two three four five six seven eight nine ten")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.range(25_000).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("word"), F.col("id") % 5).alias("text"))
    summed, plain = [], decontaminate._summed
    monkeypatch.setattr(decontaminate, "_summed", lambda rows, width, of: summed.append(rows.count()) or plain(rows, width, of))
    assert corpus_pipeline.drop_leaks(spark, docs, str(tmp_path)).count() == 25_000
    # one pass, over every text
    assert summed == [25_000]
