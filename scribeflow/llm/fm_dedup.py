"""Substring dedup on words by compressed FM-indexes.

Every shard (see ``windows``) holds the Burrows-Wheeler transform of its texts in a wavelet
matrix of packed bits.  The segments are streamed through it from right to left by backward
search; where the matching statistic reaches the window length, the interval tells which
other places share the window, and the smallest doc_id among them decides.

Defined results: null and empty texts have no words and the hash of nothing; texts with fewer
words than a window lose nothing; a null doc_id takes no part and keeps its text; repeated
rows never cut each other; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from scribeflow.llm.common import word_hashes, word_spans
from scribeflow.llm.windows import WINDOW, Alphabet, removed


def split_words(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    flat = np.frombuffer(b"".join(raw), np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in raw], dtype=np.int64)))
    starts, ends, rows = word_spans(flat, offsets)
    return word_hashes(flat, starts, ends), rows


WORDS = Alphabet(split_words, lambda symbols: symbols, 5)


class WaveletMatrix:
    """Ranks over a sequence of symbols: a level for each bit, packed in 64-bit words with the
    count of ones before each word."""

    def __init__(self, sequence: np.ndarray):
        self.n = len(sequence)
        self.bits = max(1, int(sequence.max()).bit_length()) if self.n else 1
        self.levels: list[tuple[np.ndarray, np.ndarray, int]] = []
        for level in range(self.bits - 1, -1, -1):
            ones = (sequence >> level) & 1
            packed = np.zeros((self.n // 64 + 1) * 64, np.uint8)
            packed[:self.n] = ones
            words = np.packbits(packed, bitorder="little").view("<u8")
            before = np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64)[:-1]))
            self.levels.append((words, before, self.n - int(ones.sum())))
            sequence = np.concatenate((sequence[ones == 0], sequence[ones == 1]))

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before position ``at``."""
        lo = np.zeros(len(at), np.int64)
        hi = at.astype(np.int64)
        for depth, (words, before, zeros) in enumerate(self.levels):
            one = (symbols >> (self.bits - 1 - depth)) & 1 == 1
            for end in (lo, hi):
                word = end >> 6
                mask = (np.uint64(1) << (end & 63).astype(np.uint64)) - np.uint64(1)
                ones = before[word] + np.bitwise_count(words[word] & mask)
                end[:] = np.where(one, zeros + ones, end - ones)
        return hi - lo


class FMIndex:
    def __init__(self, text: np.ndarray, order: np.ndarray):
        self.tree = WaveletMatrix(text[order - 1])
        self.less = np.concatenate(([0], np.cumsum(np.bincount(text))))

    def step(self, symbols: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of the matches with ``symbols`` put before them."""
        both = self.tree.rank(np.concatenate((symbols, symbols)), np.concatenate((lo, hi)))
        base = self.less[symbols]
        return base + both[:len(lo)], base + both[len(lo):]


def stream(text: np.ndarray, order: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """For each text position of a streamed segment, the rank of a suffix that matches at
    least a window there, or -1."""
    index = FMIndex(text, order)
    out = np.full(len(text), -1, np.int64)
    by_length = np.argsort(-lengths, kind="stable")
    at, left = starts[by_length] + lengths[by_length] - 1, lengths[by_length]
    lo, hi = np.zeros(len(at), np.int64), np.full(len(at), len(text), np.int64)
    for done in range(int(left[0]) if len(left) else 0):
        live = int(np.searchsorted(-left, -done, side="left"))
        lo, hi, at = lo[:live], hi[:live], at[:live]
        lo, hi = index.step(text[at], lo, hi)
        if done + 1 >= WINDOW:
            found = hi > lo
            out[at[found]] = lo[found]
        at = at - 1
    return out


def _rows(rows: pd.DataFrame, raw: list[bytes], spans: list) -> pd.DataFrame:
    out = []
    for doc, text, (lo, hi) in zip(rows["doc_id"], raw, spans):
        words = text.split()
        kept, at = [], 0
        for a, b in zip(lo.tolist(), hi.tolist()):
            kept += words[at:a]
            at = b
        kept += words[at:]
        out.append((doc, len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return pd.DataFrame(out, columns=["doc_id", "n_words", "n_removed", "kept_sha256"]).astype({"doc_id": "Int64"})


def dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row."""
    return removed(docs, WORDS, stream, "<u8", _rows, "doc_id long, n_words long, n_removed long, kept_sha256 string", name="fm")
