"""Sharding, token files and packing against plain versions."""

import zlib
from collections import Counter, defaultdict

import pytest
import xxhash

from scribeflow.llm import packing, sharding, token_output
from scribeflow.llm.queries import vocabulary


def _unit(key: int, name: str) -> float:
    seed = xxhash.xxh64((key & (2**64 - 1)).to_bytes(8, "little"), 42).intdigest() if key is not None else 42
    return ((xxhash.xxh64(name.encode(), seed).intdigest() >> 11) + 0.5) / 2**53


def _descend(key, nodes):
    import math

    while True:
        best = nodes[0] if len(nodes) == 1 else max(nodes, key=lambda n: math.log(_unit(key, n.name)) / n.weight)
        if best.shard is not None:
            return best.shard
        nodes = best.children


def _plain(rows):
    return [(r[0], r[1] or "") for r in rows]


def test_sharding_matches_a_plain_descent(docs, rows):
    tree = sharding.layout()
    got = sharding.assign(docs, tree).collect()
    want = Counter()
    for doc, text in _plain(rows):
        raw = text.encode()
        want[doc, len(raw) + 8, zlib.crc32(raw), _descend(doc, tree.regions), _descend(doc, (*tree.regions, *tree.grown().lots))] += 1
    assert Counter((r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["grown_shard"]) for r in got) == want
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
        assert r["law"] == "key" and r["grown_shard"] in (r["shard"], 24)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_weights_move_keys_only_where_they_change(spark):
    ids = spark.range(4000).withColumnRenamed("id", "doc_id")
    from pyspark.sql import functions as F

    weights = [1.0] * 24
    weights[0] = 3.0
    a, b = sharding.layout(), sharding.layout(weights=weights)
    got = ids.select(sharding.shard_of(F.col("doc_id"), a).alias("a"), sharding.shard_of(F.col("doc_id"), b).alias("b")).collect()
    assert len({r["a"] for r in got}) == 24
    # a region whose weight did not change only loses keys, and only to the region that grew
    assert all(r["b"] < 8 for r in got if r["a"] != r["b"])
    assert sum(r["b"] == 0 for r in got) > 2 * sum(r["a"] == 0 for r in got)


@pytest.fixture(scope="module")
def ids(rows):
    from tokenizers import Tokenizer

    def of(name):
        t = Tokenizer.from_file(vocabulary(name))
        return [(d, t.encode(x, add_special_tokens=False).ids) for d, x in _plain(rows)]

    return of


def _crc(ids):
    return zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids))


def test_token_files_round_trip(docs, ids, rows):
    got = token_output.round_trip(docs, vocabulary("word_bpe_49k.json"), 1).collect()
    want = sorted(((d is not None, d or 0, t, i) for (d, i), (_, t) in zip(ids("word_bpe_49k.json"), _plain(rows))), key=lambda x: x[:3])
    at, expect = 0, []
    for named, d, _, i in want:
        expect.append((d if named else None, at, len(i) + 1, _crc(i + [1])))
        at += len(i) + 1
    assert sorted(map(tuple, got), key=lambda r: r[1]) == expect


def test_packing_is_whole_and_tight(docs, ids):
    packed = packing.pack(packing.pieces(docs, vocabulary("byte_bpe_50k.json")))
    got = packed.collect()
    want = Counter()
    for d, i in ids("byte_bpe_50k.json"):
        i = i + [0]
        first = len(i) % 2048 or 2048
        for k, a in enumerate([0, *range(first, len(i), 2048)]):
            own = i[a:a + (2048 if k else first)]
            want[d, k, a, len(own), _crc(own)] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    bins = defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(r["length"] for r in got)
    assert len(bins) <= -(-total // 2048) + 1


def test_crossover_keeps_every_piece():
    import numpy as np

    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 1500, 400)
    a = np.zeros(400, np.int64)
    packing.best_fit(lengths, np.arange(400), a, [], 0, 2048)
    b = packing.mutate(a, lengths, 2048, rng)
    for child in (b, packing.crossover(a, b, lengths, 2048, rng)):
        assert len(child) == 400 and np.bincount(child, weights=lengths).max() <= 2048


def test_empty_tables(none):
    assert sharding.assign(none, sharding.layout()).count() == 0
    assert token_output.round_trip(none, vocabulary("word_bpe_49k.json"), 1).count() == 0
    assert packing.pack(packing.pieces(none, vocabulary("byte_bpe_50k.json"))).count() == 0


def test_the_search_wins_bins_over_best_fit():
    """Triplets that fill their bins exactly: best fit wastes bins, and so do all the first packings."""
    import numpy as np

    for seed in range(4):
        rng = np.random.default_rng(seed)
        a, b = rng.integers(520, 900, 60), rng.integers(520, 760, 60)
        lengths = np.concatenate((a, b, 2048 - a - b)).astype(np.int64)
        first = packing.seeded(lengths, 2048, None)
        alone = packing.evolve(lengths, [first], seed, generations=0)
        best = packing.evolve(lengths, [first], seed)
        assert packing.lower_bound(lengths, 2048) == 60 and np.bincount(best, weights=lengths).max() <= 2048 and len(best) == 180
        assert best.max() <= alone.max() - 2 and alone.max() <= first.max()


def test_groups_above_the_bound_go_to_the_islands(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    a, b = rng.integers(520, 900, 80), rng.integers(520, 760, 80)
    lengths = np.concatenate((a, b, 2048 - a - b)).tolist()
    df = spark.createDataFrame([(k, 0, 0, int(n), 0) for k, n in enumerate(lengths)], "doc_id long, piece int, start long, length long, ids_crc32 long")
    got = packing.pack(df, group_pieces=1000).collect()
    first = packing.seeded(np.array(lengths), 2048, None)
    assert sorted(r["doc_id"] for r in got) == list(range(240))
    assert len({r["sequence_id"] for r in got}) < first.max() + 1
