"""The search in groups of full size; the fit on all rows."""

import zlib

import numpy as np

from scribeflow.llm import packing, toxicity

from .conftest import SCHEMA


def test_large_groups_evolve_as_long_as_small_ones(monkeypatch):
    made = []
    plain = packing.settle
    monkeypatch.setattr(packing, "settle", lambda lengths, bins, capacity: made.append(len(lengths)) or plain(lengths, bins, capacity))
    lengths = np.random.default_rng(1).integers(684, 1200, 4000)
    packing.evolve(lengths, [], 3, population=2)
    assert len(made) >= 100


def test_toxicity_learns_from_every_row(spark):
    rng = np.random.default_rng(3)
    marked = {k: f"zorg{k // 5}" for k in range(0, 200)}  # 40 words, each in five toxic texts
    own = [k for k in range(20000) if zlib.crc32(str(k).encode()) % 5][:13000]
    place = dict(zip(own, rng.permutation(len(own))))
    words = rng.integers(0, 400, (len(own), 12))
    rows = [(k, " ".join(f"w{x}x" for x in words[place[k]]) + (f" {marked[place[k]]} q{marked[place[k]]}" if place[k] in marked else ""), "en", "s", 1) for k in own]
    labels = [(k, 0, int(place[k] in marked)) for k in own]
    model = toxicity.fit(spark.createDataFrame(rows, SCHEMA).repartition(4), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    weights = [model.weights[toxicity.number_of(f"zorg{k}")[0]] for k in range(40)]
    assert min(weights) > 0


def test_feature_numbers_survive_packing():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, toxicity._SIZE, n)) for n in (0, 1, 5, 0, 3000, 2)] + [np.array([0, toxicity._SIZE - 1])]
    row, number = toxicity.unpack_numbers([toxicity.pack_numbers(x) for x in sets])
    assert [number[row == k].tolist() for k in range(len(sets))] == [x.tolist() for x in sets]


def test_least_value_is_found():
    rng = np.random.default_rng(5)
    a, b = rng.standard_normal((40, 6)), rng.standard_normal(40)
    got = toxicity.minimum(lambda w: (float(((a @ w - b) ** 2).sum()), 2 * a.T @ (a @ w - b)), np.zeros(6), 100, enough=1e-12)
    assert np.allclose(got, np.linalg.lstsq(a, b, rcond=None)[0], atol=1e-4)
