"""Packing: pieces that cannot yield are not looked at, with the same packings.  A worker's encoder."""

import numpy as np

from scribeflow.llm import common, encoding, packing
from scribeflow.llm.queries import vocabulary


def plain_replace(lengths, bins, displaced, room):
    """Every piece that is held tried for every displaced one."""
    by_length = displaced[np.argsort(-lengths[displaced], kind="stable")]
    out = by_length[packing.REPLACED:].tolist()
    for k in by_length[:packing.REPLACED].tolist():
        left = [(room[bins[i]] - lengths[k] + lengths[i], i) for i in range(len(bins)) if bins[i] >= 0 and lengths[i] < lengths[k]]
        left = min(((x, i) for x, i in left if x >= 0), default=None)
        if left is None:
            out.append(k)
            continue
        x, i = left
        bins[k], bins[i] = bins[i], -1
        room[bins[k]] = x
        out.append(i)
    return np.array(out, np.int64)


def test_replacement_is_the_plain_one():
    for seed in range(30):
        rng = np.random.default_rng(seed)
        lengths = rng.integers(1, (2049, 300, 12)[seed % 3], int(rng.integers(4, 160)))
        bins = packing.seeded(lengths, 2048, None)
        bins = np.where(rng.random(bins.max() + 1)[bins] < 0.4, -1, bins)
        room = 2048 - np.bincount(bins[bins >= 0], weights=lengths[bins >= 0], minlength=bins.max() + 1).astype(np.int64)
        if not len(room):
            continue
        a, b, free, spare = bins.copy(), bins.copy(), room.copy(), room.copy()
        got, want = (f(lengths, x, np.flatnonzero(bins < 0), r) for f, x, r in ((packing.replace, a, free), (plain_replace, b, spare)))
        assert got.tolist() == want.tolist() and (a == b).all() and (free == spare).all()


def test_a_packing_whose_bins_all_dissolve_is_packed_anew():
    lengths = np.array([1200, 1200, 1200])
    assert np.bincount(packing.settle(lengths, np.full(3, -1), 2048)).tolist() == [1, 1, 1]
    for seed in range(8):
        assert len(set(packing.evolve(np.array([900, 900, 900, 900, 900]), [], seed, 2048, generations=20).tolist())) == 3


def test_the_search_looks_only_at_pieces_of_bins_with_free_space(monkeypatch):
    lengths = np.concatenate((np.full(2000, 1024), [1000, 1500]))
    bins = np.concatenate((np.arange(2000) // 2, [1000, -1]))
    room = np.append(np.zeros(1000, np.int64), 1048)
    seen, where = [], np.where
    monkeypatch.setattr(packing.np, "where", lambda c, *rest: seen.append(np.size(c)) or where(c, *rest))
    out = packing.replace(lengths, bins, np.array([2001]), room)
    assert out.tolist() == [2000] and bins[2001] == 1000 and room[1000] == 548 and max(seen) == 1


def test_a_worker_keeps_its_encoder_only_from_one_encoding_task_to_the_next(monkeypatch):
    monkeypatch.setattr(encoding, "_ENCODERS", {})
    monkeypatch.setattr(encoding, "_USED_BY", set())
    task = [1]
    monkeypatch.setattr(encoding, "_task", lambda: task[0])
    path = vocabulary("byte_bpe_50k.json")
    first = encoding.Encoder.of(path, True)
    common.trim()
    task[0] = 2
    assert encoding.Encoder.of(path, True) is first
    common.trim()
    task[0] = 3
    common.trim()
    assert not encoding._ENCODERS
