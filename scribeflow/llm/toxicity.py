"""Toxicity by weak supervision.

Many voters, lexicons and patterns, vote toxic, clean or nothing on every text outside the
held-out fold.  A generative label model estimates, by EM, how often the hidden class is toxic
and how each voter votes in each class; correlated voters are tied in a tree, where a voter's
vote depends on the class and on its parent's vote.  A given label is one more voter, so wrong
labels count for less.  A sparse linear classifier is trained on the model's posteriors and
scores every whole text; its inputs are the text's words and marks alone.

The fit reads each text once: its feature numbers, packed, are joined with its label and kept in
a stage table.  Sums over it (features in toxic and clean texts, equal rows of votes) are made in
tasks, and so is each step of EM and of the classifier; the driver adds sums whose size depends
on the voters and features, not on the rows.

Defined results: a null or empty text gets the classifier's prior score; repeated rows get
equal scores; without any labelled row the voters alone decide; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scribeflow.llm.common import SpanHash, mix, release, slices, stage, text_bytes, texts, trim, word_spans
from scribeflow.llm.windows import _rows
from scribeflow.sources.reference import by_key

FOLDS = 5
#: Features whose sums are added in one group.
_RANGE = 1 << 14
#: Text bytes whose features are made at a time: their sorting stays in a core's cache.
_FEW = 1 << 18
#: Posteriors are added in whole numbers, so that a sum does not depend on the order of tasks.
_UNIT = 1 << 24
BITS = 20
#: Word beginnings that are features of their own, in bytes.
BEGINNINGS = (4, 6, 7)
REPEATS = (2, 3)
_MARKS = 4
_SIZE = _MARKS + (1 << BITS)
TOXIC, CLEAN, NONE = 1, 0, 2

# Seed lexicons of the voters, by kind and language.
LEXICONS = {
    "persons": "idiot moron imbecile loser clown fool scum dumbass jerk bastard creep pig rat cretin halfwit",
    "judgements": "stupid pathetic worthless disgusting useless dumb ugly vile repulsive revolting ridiculous brainless",
    "things": "trash garbage filth crap vermin waste rubbish sewage",
    "profanity": "damn shit fuck fucking bitch asshole hell bullshit piss",
    "threats": "kill die destroy hurt beat hate suffer burn",
    "german": "idiot dumm trottel arschloch abschaum wertlos widerlich erbärmlich müll verlierer",
    "french": "idiot stupide imbécile crétin connard ordure minable pathétique dégoûtant raclure",
    "spanish": "idiota estúpido imbécil basura patético asqueroso inútil escoria payaso perdedor",
}
#: Patterns of the voters, over lower-cased bytes.
PATTERNS = {
    "address": rb"\byou(?:'re| are)?(?: such)?(?: an?)? (?:idiot|moron|loser|clown|fool|stupid|pathetic|worthless|trash|scum|disgusting)",
    "shout": rb"!{2,}",
    "masked": rb"\b[a-z]+\*{2,}[a-z]*|[@#$%&]{3,}",
    "go_away": rb"\b(?:shut up|get lost|go away|drop dead)\b",
}
#: Strings of which each hit has one, where the marks of ``masked`` are written alike.
NEEDED = {"address": (b"you",), "shout": (b"!!",), "masked": (b"**", b"@@@"), "go_away": (b"shut up", b"get lost", b"go away", b"drop dead")}
_MARKED = bytes(64 if chr(c) in "@#$%&" else c for c in range(256))

_SPACED = bytes(32 if chr(c) in ".,;:!?\"()[]" else c for c in range(256))


@dataclass
class Model:
    """Weights of hashed words and marks, and the intercept."""

    weights: np.ndarray
    intercept: float


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def features(raw: list[bytes], used: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Row and number of every distinct hashed word, word beginning (of ``BEGINNINGS`` bytes)
    or mark; words and beginnings that a text has twice or three times are further features.
    Words are lower-cased (A-Z) and parted by white space and common punctuation.  ``used``
    tells the numbers that are wanted; the others are left out early."""
    flat = np.frombuffer(b"".join(x.translate(_SPACED) for x in raw), np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in raw], dtype=np.int64)))
    starts, ends, rows = word_spans(flat, offsets)
    row = np.repeat(np.arange(len(raw)), np.diff(rows))
    hashed = SpanHash(flat, lower=True)
    keys: list[np.ndarray] = []
    for n in (0, *BEGINNINGS):
        long = np.flatnonzero(ends - starts > n) if n else slice(None)
        number = _number(hashed(starts[long], starts[long] + n if n else ends, n << 20))
        of = row[long]
        if used is not None:
            keep = used[number]
            number, of = number[keep], of[keep]
        keys.append(of * _SIZE + number)
    key, times = np.unique(np.concatenate(keys), return_counts=True)
    marks = np.array([(b"!!" in x, b"!" in x, b"?!" in x, x.isupper()) for x in raw], bool).reshape(-1, _MARKS)
    r, m = np.nonzero(marks)
    keys = [key, r * _SIZE + m]
    for n in REPEATS:
        of, number = np.divmod(key[times >= n], _SIZE)
        keys.append(of * _SIZE + again(number, n))
    key = np.unique(np.concatenate(keys))
    return key // _SIZE, key % _SIZE


def _number(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - BITS)).astype(np.int64) + _MARKS


def again(number: np.ndarray, n: int) -> np.ndarray:
    """The number of the feature that a text has this one ``n`` times."""
    return _number(mix(number.astype(np.uint64) + np.uint64(n << 40)))


def number_of(words: str) -> np.ndarray:
    """The numbers of space-separated words."""
    raw = np.frombuffer(words.encode(), np.uint8)
    starts, ends, _ = word_spans(raw, np.array([0, len(raw)]))
    return _number(SpanHash(raw, lower=True)(starts, ends))


def pattern_votes(raw: list[bytes]) -> np.ndarray:
    """A column of votes for each pattern: toxic where it occurs.  A pattern is searched for only
    where a string is that each of its hits has."""
    found = [(re.compile(p), NEEDED[name]) for name, p in PATTERNS.items()]
    return np.array([[TOXIC if any(x in marked for x in needed) and p.search(low) else NONE for p, needed in found]
                     for low in (x.lower() for x in raw) for marked in (low.translate(_MARKED),)], np.int8).reshape(-1, len(found))


def lexicon_votes(row: np.ndarray, number: np.ndarray, rows: int, lexicons: list[np.ndarray]) -> np.ndarray:
    """For each lexicon two voters: toxic where a word occurs, toxic where two do; and one that
    votes clean where no word of any does."""
    out = []
    any_hit = np.zeros(rows, np.int64)
    for words in lexicons:
        n = np.bincount(row[np.isin(number, words)], minlength=rows)
        any_hit += n
        out += [np.where(n > 0, TOXIC, NONE), np.where(n > 1, TOXIC, NONE)]
    out.append(np.where(any_hit == 0, CLEAN, NONE))
    return np.stack(out, axis=1).astype(np.int8) if rows else np.zeros((0, 2 * len(lexicons) + 1), np.int8)


class LabelModel:
    """Class prior and, for each voter, its votes given the class and its parent's vote.  ``votes``:
    a row a text, or what adds up ``moments`` over rows elsewhere, given the guess of the class."""

    def __init__(self, votes: np.ndarray | Callable, rounds: int = 25, prior: float = 0.15):
        gather = votes if callable(votes) else lambda guess: moments(votes, np.ones(len(votes)), guess(votes))
        guess, self.prior, self.tables = partial(first_guess, prior), prior, []
        for step in range(rounds + 1):
            joint = gather(guess)
            k = joint.shape[1] // 3
            n, toxic = joint[:, :3, :3].sum(), joint[1, :3, :3].sum()
            if step:
                self.prior = float(np.clip(toxic / n, 0.01, 0.6)) if n else prior
            else:
                self.parent = np.full(k, -1)
            if step == rounds:
                break
            if step == 5:
                self.parent = self._parents(joint)
            self._fit(joint)
            guess = self.guess()

    def _fit(self, joint: np.ndarray) -> None:
        self.tables = []
        for j in range(joint.shape[1] // 3):
            up, own = self.parent[j], slice(3 * j, 3 * j + 3)
            table = np.empty((2, 3, 3))
            for y in (0, 1):
                both = np.zeros((3, 3))
                if up >= 0:
                    both += joint[y, 3 * up:3 * up + 3, own]
                else:
                    both[0] = joint[y, own, own].diagonal()
                flat = joint[y, own, own].diagonal() + 1.0
                flat[TOXIC if y else CLEAN] += 2.0  # voters are better than chance to begin with
                both += 3 * flat / flat.sum()
                table[y] = both / both.sum(1, keepdims=True)
            self.tables.append(np.log(table))

    def _tree(self, votes: np.ndarray, p: np.ndarray) -> np.ndarray:
        return self._parents(moments(votes, np.ones(len(votes)), p))

    def _parents(self, joint: np.ndarray) -> np.ndarray:
        """Maximum spanning tree of the voters' mutual information given the class; weak ties are left out."""
        k, n = joint.shape[1] // 3, joint[:, :3, :3].sum()
        tie = np.zeros((k, k))
        for i in range(k):
            for j in range(i):
                for y in (0, 1):
                    q = (joint[y, 3 * i:3 * i + 3, 3 * j:3 * j + 3] + 1e-9) / max(1, n)
                    tie[i, j] += (q * np.log(q * q.sum() / np.outer(q.sum(1), q.sum(0)))).sum()
                tie[j, i] = tie[i, j]
        parent, inside = np.full(k, -1), [0] if k else []
        while len(inside) < k:
            rest = [j for j in range(k) if j not in inside]
            i, j = max(((i, j) for i in inside for j in rest), key=lambda e: tie[e])
            parent[j] = i if tie[i, j] > 1e-3 else -1
            inside.append(j)
        return parent

    def guess(self) -> Callable[[np.ndarray], np.ndarray]:
        """A function for tasks, from votes to the chance that the class is toxic."""
        return partial(_posterior, self.prior, self.parent, self.tables)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        return self.guess()(votes)


def _posterior(prior: float, parent: np.ndarray, tables: list[np.ndarray], votes: np.ndarray) -> np.ndarray:
    odds = np.full(len(votes), np.log(prior / (1 - prior)))
    for j, table in enumerate(tables):
        own, up = votes[:, j].astype(int), (votes[:, parent[j]].astype(int) if parent[j] >= 0 else np.zeros(len(votes), int))
        odds += table[1, up, own] - table[0, up, own]
    return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def first_guess(prior: float, votes: np.ndarray) -> np.ndarray:
    """Any vote against none."""
    toxic, clean = (votes == TOXIC).sum(1), (votes == CLEAN).sum(1)
    return np.where(toxic > clean, 0.9, np.where(clean > 0, 0.03, prior))


def moments(votes: np.ndarray, times: np.ndarray, p: np.ndarray) -> np.ndarray:
    """For clean and for toxic: how often each vote of each voter meets each vote of each voter."""
    hot = (votes[:, :, None] == np.arange(3)).reshape(len(votes), 3 * votes.shape[1]).astype(float)
    return np.stack([(hot * (times * w)[:, None]).T @ hot for w in (1 - p, p)])


def pack_numbers(number: np.ndarray) -> bytes:
    """Rising feature numbers in three planes: low bytes, and the steps of the rest in two."""
    step = np.diff(number >> 8, prepend=0)
    return b"".join(x.astype(np.uint8).tobytes() for x in (number & 255, step & 255, step >> 8))


def unpack_numbers(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Row and number of the features of several rows."""
    flat = np.frombuffer(b"".join(blobs), np.uint8).astype(np.int64)
    size = np.array([len(x) // 3 for x in blobs], np.int64)
    row, before = np.repeat(np.arange(len(blobs)), size), np.cumsum(size) - size
    at = np.arange(size.sum()) + 2 * before[row]
    upper = np.cumsum(flat[at + size[row]] + (flat[at + 2 * size[row]] << 8))
    upper -= np.concatenate(([0], upper))[before][row]
    return row, (upper << 8) + flat[at]


def _pool(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """label, numbers, votes (of the patterns) of every row outside the held-out fold."""
    known = labels.where("toxic is not null").groupBy(labels["doc_id"].cast("long").alias("id")).agg(F.max("toxic").cast("long").alias("toxic"))

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, ids, raw in _rows(batches, _FEW):
            row, number = features(raw)
            cuts = np.searchsorted(row, np.arange(len(raw) + 1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([pack_numbers(number[a:b]) for a, b in zip(cuts[:-1], cuts[1:])], pa.binary()),
                 pa.array([v.tobytes() for v in pattern_votes(raw)], pa.binary())], names=["doc_id", "numbers", "votes"])

    pool = texts(docs).where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull()).withColumn("rk", F.lit(0).cast("long"))
    pool = pool.mapInArrow(part, "doc_id long, numbers binary, votes binary")
    return pool.join(by_key(known), F.col("doc_id") == F.col("id"), "left").select(
        F.coalesce("toxic", F.lit(NONE)).cast("long").alias("label"), "numbers", "votes")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """label, row and number of the features, votes of the patterns."""
    for batch in slices(batches, 1024):
        label, numbers, votes = (batch.column(c).to_pylist() for c in ("label", "numbers", "votes"))
        yield np.array(label, np.int8), *unpack_numbers(numbers), np.frombuffer(b"".join(votes), np.int8).reshape(-1, len(PATTERNS))


def _votes(label: np.ndarray, row: np.ndarray, number: np.ndarray, patterns: np.ndarray, lexicons: list[np.ndarray]) -> np.ndarray:
    return np.concatenate((label[:, None], lexicon_votes(row, number, len(label), lexicons), patterns), axis=1)


def _best(pool: DataFrame, counts: Callable, weigh: Callable, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` features of the largest weight above 0, and their sums: ``counts`` gives two
    whole numbers for each feature of some rows, ``weigh`` the weight of their sums over all rows."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, _SIZE), np.int64)
        for some in _read(batches):
            total += counts(*some)
        for a in range(0, _SIZE, _RANGE):
            own = total[:, a:a + _RANGE]
            at = np.flatnonzero(own.any(0))
            if len(at):
                yield pa.RecordBatch.from_arrays([pa.array([a], pa.int64()), pa.array([at.astype("<u2").tobytes()]), pa.array([own[:, at].tobytes()])],
                                                 names=["first", "place", "sums"])

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros((2, _RANGE), np.int64)
        for place, sums in zip(group["place"], group["sums"]):
            total[:, np.frombuffer(place, "<u2")] += np.frombuffer(sums, np.int64).reshape(2, -1)
        weight = weigh(total)
        at = np.flatnonzero(weight > 0)
        at = at[np.argsort(-weight[at], kind="stable")[:most]]
        return pd.DataFrame({"number": group["first"].iloc[0] + at, "weight": weight[at], "a": total[0, at], "b": total[1, at]})

    sums = pool.mapInArrow(part, "first long, place binary, sums binary").groupBy("first")
    best = sums.applyInPandas(add, "number long, weight double, a long, b long").orderBy(F.desc("weight"), "number").limit(most).collect()
    return np.array([r["number"] for r in best], np.int64), np.array([(r["a"], r["b"]) for r in best], np.int64).reshape(-1, 2)


def _count(number: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(number, weights, _SIZE).astype(np.int64)


def mined_lexicons(pool: DataFrame, groups: int = 4, least: int = 5, most: int = 200) -> list[np.ndarray]:
    """Words that labelled toxic texts have far more often than the others, dealt into groups."""
    rows = {r["label"]: r["count"] for r in pool.groupBy("label").count().collect()}
    n_bad, n_good = max(1, rows.get(TOXIC, 0)), max(1, rows.get(CLEAN, 0))

    def counts(label, row, number, _) -> np.ndarray:
        return np.stack([_count(number[label[row] == y]) for y in (TOXIC, CLEAN)])

    def rates(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return (sums[0] + 0.1) / n_bad, (sums[1] + 0.1) / n_good

    def lift(sums: np.ndarray) -> np.ndarray:
        bad, good = rates(sums)
        return np.where(sums[0] >= max(least, 0.02 * n_bad), bad * np.log(bad / good), 0)

    top, sums = _best(pool, counts, lift, most)
    bad, good = rates(sums.T)
    top = top[bad > 8 * good]
    return [top[k::groups] for k in range(groups)]


def _ballots(pool: DataFrame, lexicons: list[np.ndarray]) -> DataFrame:
    """Equal rows of votes and how many there are."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in _read(batches):
            votes, times = np.unique(_votes(*some, lexicons), axis=0, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([v.tobytes() for v in votes], pa.binary()), pa.array(times, pa.int64())], names=["votes", "n"])

    return pool.mapInArrow(part, "votes binary, n long").groupBy("votes").agg(F.sum("n").alias("n"))


def _over(ballots: DataFrame, voters: int, sums: Callable) -> np.ndarray:
    """The sum of ``sums(votes, times)`` over all rows of votes."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = sums(np.zeros((0, voters), np.int8), np.zeros(0))
        for batch in slices(batches, 4096):
            votes = np.frombuffer(b"".join(batch.column("votes").to_pylist()), np.int8).reshape(-1, voters)
            total = total + sums(votes, batch.column("n").to_numpy(zero_copy_only=False).astype(float))
        yield pa.RecordBatch.from_arrays([pa.array([np.asarray(total, float).tobytes()], pa.binary())], names=["blob"])

    parts = [np.frombuffer(r["blob"]) for r in ballots.mapInArrow(part, "blob binary").collect()]
    return np.sum(parts, axis=0).reshape(np.shape(sums(np.zeros((0, voters), np.int8), np.zeros(0))))


def _soft(guess: Callable, unsure: float, votes: np.ndarray) -> np.ndarray:
    """Posteriors in whole units of ``_UNIT``, kept ``unsure`` away from 0 and 1."""
    return np.rint(np.clip(guess(votes), unsure, 1 - unsure) * _UNIT)


def train(pool: DataFrame, soft: Callable, rate: float, words: int = 8000, l2: float = 0.5, steps: int = 60) -> Model:
    """Sparse logistic regression on the soft labels ``soft`` gives: the ``words`` features that part
    the classes most surely, by L-BFGS; each step sums loss and gradient over all rows."""

    def counts(label, row, number, patterns) -> np.ndarray:
        return np.stack((_count(number), _count(number, soft(label, row, number, patterns)[row])))

    def surely(sums: np.ndarray) -> np.ndarray:
        total, toxic = sums[0], sums[1] / _UNIT
        sure = np.where(total >= 4, np.abs(toxic - total * rate) / np.sqrt(total * rate * (1 - rate) + 1e-9), 0)
        return np.where(sure > 2, sure, 0)

    used, _ = _best(pool, counts, surely, words)
    size = len(used)
    start = float(np.log(rate / (1 - rate)))
    if not size:
        return Model(np.zeros(_SIZE, np.float32), start)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = np.full(_SIZE, -1)
        place[used] = np.arange(size)
        for label, row, number, patterns in _read(batches):
            p = soft(label, row, number, patterns) / _UNIT
            at = place[number]
            keep = at >= 0
            have = np.bincount(row[keep], minlength=len(p))
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (at[keep].astype("<u2"), have.astype("<i4"), p)],
                                             names=["places", "have", "p"])

    table = stage(pool.mapInArrow(part, "places binary, have binary, p binary"), "toxicity-train")

    def slope(w: np.ndarray) -> tuple[float, np.ndarray]:
        def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(size + 2)
            for batch in batches:
                for places, have, p in zip(*(batch.column(c).to_pylist() for c in ("places", "have", "p"))):
                    c, p = np.frombuffer(places, "<u2"), np.frombuffer(p)
                    r = np.repeat(np.arange(len(p)), np.frombuffer(have, "<i4"))
                    z = np.bincount(r, w[c], len(p)) + w[size]
                    d = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - p
                    total[:size] += np.bincount(c, d[r], size)
                    total[size:] += d.sum(), (np.logaddexp(0, z) - p * z).sum()
            trim()
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["blob"])

        total = np.sum([np.frombuffer(r["blob"]) for r in table.mapInArrow(part, "blob binary").collect()], axis=0)
        total[:size] += l2 * w[:size]
        return float(total[-1] + 0.5 * l2 * w[:size] @ w[:size]), total[:-1]

    w = minimum(slope, np.append(np.zeros(size), start), steps)
    release(table)
    weights = np.zeros(_SIZE, np.float32)
    weights[used] = w[:size]
    return Model(weights, float(w[size]))


def minimum(slope: Callable, w: np.ndarray, steps: int, memory: int = 10, enough: float = 1e-6) -> np.ndarray:
    """Where a smooth convex function is least, by L-BFGS: ``slope`` gives its value and gradient.
    Ends when a step lowers the value by less than ``enough`` of it."""
    value, g = slope(w)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        d, alphas = -g, []
        for s, y in reversed(past):
            alphas.append((s @ d) / (s @ y))
            d = d - alphas[-1] * y
        if past:
            s, y = past[-1]
            d = d * ((s @ y) / (y @ y))
        else:
            d = d / max(1.0, float(np.linalg.norm(g)))
        for (s, y), alpha in zip(past, reversed(alphas)):
            d = d + (alpha - (y @ d) / (s @ y)) * s
        far = 1.0
        for _ in range(20):
            new = w + far * d
            new_value, new_g = slope(new)
            if new_value <= value + 1e-4 * far * (g @ d):
                break
            far /= 2
        else:
            break
        s, y = new - w, new_g - g
        less = value - new_value
        w, value, g = new, new_value, new_g
        if s @ y > 1e-12:
            past = [*past[1 - memory:], (s, y)]
        if less <= enough * max(1.0, abs(value)):
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, unsure: float = 0.02) -> Model:
    """Voters, label model and classifier from all rows outside the held-out fold."""
    pool = stage(_pool(docs, labels), "toxicity-pool")
    lexicons = [number_of(x) for x in LEXICONS.values()] + mined_lexicons(pool)
    ballots = stage(_ballots(pool, lexicons), "toxicity-votes")
    rows = int(ballots.agg(F.sum("n")).first()[0] or 0)
    if not rows:
        release(pool, ballots)
        return Model(np.zeros(_SIZE, np.float32), -2.0)
    voters = 2 + 2 * len(lexicons) + len(PATTERNS)
    guess = LabelModel(lambda guess: _over(ballots, voters, lambda votes, times: moments(votes, times, guess(votes)))).guess()
    own = partial(_soft, guess, unsure)
    rate = float(_over(ballots, voters, lambda votes, times: np.array([own(votes) @ times]))[0]) / _UNIT / rows
    model = train(pool, lambda *some: own(_votes(*some, lexicons)), rate)
    release(pool, ballots)
    return model


def scorer(spark, model: Model):
    """What a task calls to get a function from texts to scores."""
    sent = spark.sparkContext.broadcast((np.flatnonzero(model.weights).astype(np.int32), model.weights[model.weights != 0], model.intercept))

    def start():
        at, w, b = sent.value
        weights = np.zeros(_SIZE, np.float32)
        weights[at] = w
        # words whose repeats alone have a weight are wanted too
        used = weights != 0
        for n in REPEATS:
            used |= weights[again(np.arange(_SIZE), n)] != 0

        def score(raw: list[bytes]) -> np.ndarray:
            row, number = features(raw, used)
            z = np.bincount(row, weights=weights[number], minlength=len(raw)) + b
            return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

        return score

    return start


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    score_of = scorer(docs.sparkSession, model)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = score_of()
        for _, ids, raw in _rows(batches, _FEW):
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(score(raw))], names=["doc_id", "score"])

    scored = texts(docs).withColumn("rk", F.lit(0).cast("long")).mapInArrow(part, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def kept(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, all columns, without a shuffle."""
    score_of = scorer(docs.sparkSession, fit(docs, labels))

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = score_of()
        for batch in slices(batches):
            yield batch.filter(pa.array(score(text_bytes(batch)) < 0.5))

    return docs.mapInArrow(part, docs.schema)
