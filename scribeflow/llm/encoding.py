"""Token ids of whole texts through a public tokenizer, with a memo of words encoded before.

Both tokenizers cut a text into words before merging, so the ids of a text are the ids of its
words in order.  A word seen before is looked up; the new ones go through the library in one
call.  Texts with characters for which our cut might differ from the library's (special token
strings, anything beyond Latin-1 letters and common signs) go through the library whole.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np
from pyspark import TaskContext

from scribeflow.llm import common

#: Entries in each generation of the memo.  When the young one is full it becomes the old one
#: and what is asked for again moves up, so memory is bounded and frequent words stay.
MEMO_ENTRIES = 500_000
#: New words that go through the library in one call.
_CALL = 2000
_SIMPLE = re.compile("[\\x20-\\x7e\\t\\n\\r\\u00c0-\\u00ff]*")
#: How the two public vocabularies cut words, over the characters above (the
#: first after lower-casing).
_WORD_CUT = re.compile("[a-z\\u00df-\\u00f6\\u00f8-\\u00ff]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^\\sa-z0-9\\u00df-\\u00f6\\u00f8-\\u00ff]+")
_LETTERS = "A-Za-z\\u00c0-\\u00d6\\u00d8-\\u00f6\\u00f8-\\u00ff"
_BYTE_CUT = re.compile(f" ?[{_LETTERS}]+| ?[0-9]+|'(?:s|t|re|ve|m|ll|d)| ?[^\\s0-9{_LETTERS}]+|\\s+(?!\\S)|\\s+")
_ENCODERS: dict[tuple[str, bool], "Encoder"] = {}
_USED_BY: set[int | None] = set()


def _task() -> int | None:
    context = TaskContext.get()
    return context.taskAttemptId() if context else None


def forget() -> None:
    """Drop the encoders when a task that used none ends: tasks of other steps need the memory."""
    if _task() not in _USED_BY:
        _ENCODERS.clear()
        _USED_BY.clear()


common.FORGET.append(forget)


class Memo:
    """A bounded mapping in two generations."""

    def __init__(self, entries: int):
        self.entries, self.young, self.old = entries, {}, {}

    def missing(self, keys: set[str]) -> set[str]:
        """The keys not held; those held are in ``young`` afterwards."""
        out = keys.difference(self.young)
        if len(self.young) + len(out) > self.entries:
            self.old, self.young = self.young, {}
        old = self.old
        kept = {k: old[k] for k in out if k in old}
        self.young.update(kept)
        return out.difference(kept)


class Encoder:
    """``spaced``: a word has the one blank before it (byte-level vocabularies); otherwise
    white space only parts words and is dropped (lower-casing word vocabularies)."""

    def __init__(self, path: str, spaced: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.spaced = Tokenizer.from_file(path), spaced
        self.words = Memo(MEMO_ENTRIES)
        vocab = self.tokenizer.get_vocab()
        self.dtype = np.dtype("<u2" if len(vocab) <= 1 << 16 else "<u4")
        # byte-level tokens are spelled with one character for each byte; the others mark the end of a word
        suffix = json.loads(self.tokenizer.to_str())["model"].get("end_of_word_suffix")
        self.size = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, k in vocab.items():
            self.size[k] = len(token) if spaced else bool(suffix and token.endswith(suffix))

    @staticmethod
    def of(path: str, spaced: bool) -> "Encoder":
        """One encoder per Python worker, so its memos outlive a task; until one without use for it."""
        _USED_BY.clear()
        _USED_BY.add(_task())
        if (path, spaced) not in _ENCODERS:
            _ENCODERS[path, spaced] = Encoder(path, spaced)
        return _ENCODERS[path, spaced]

    def _cut(self, text: str) -> list[str] | None:
        if "<|" in text or not _SIMPLE.fullmatch(text):
            return None
        return _BYTE_CUT.findall(text) if self.spaced else _WORD_CUT.findall(text.lower())

    def _library(self, texts: list[str]) -> list[bytes]:
        if not texts:
            return []
        return [np.array(e.ids, dtype=self.dtype).tobytes()
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of single words: many in one text, parted by a break, and told apart by their
        lengths in bytes or by their last tokens."""
        out: list[bytes] = []
        for a in range(0, len(words), _CALL):
            own = words[a:a + _CALL]
            ids = np.array(self.tokenizer.encode("\n".join(own), add_special_tokens=False).ids, self.dtype)
            size = np.cumsum(self.size[ids])
            if self.spaced:
                ends = np.cumsum([len(w.encode()) + 1 for w in own]) - 1
                last = np.searchsorted(size, ends) + 1
                first = np.concatenate(([0], last[:-1] + 1))
            else:
                last = np.searchsorted(size, np.arange(1, len(own) + 1)) + 1
                first = np.concatenate(([0], last[:-1]))
            flat, w = ids.tobytes(), self.dtype.itemsize
            out += [flat[i:j] for i, j in zip((first * w).tolist(), (last * w).tolist())]
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian ids of each text, 2 or 4 bytes wide (``dtype``)."""
        parts = [self._cut(t) for t in texts]
        get = self.words.young.get
        found = [p and list(map(get, p)) for p in parts]
        unseen = {w for p, ids in zip(parts, found) if ids and None in ids for w, x in zip(p, ids) if x is None}
        if unseen:
            missing = self.words.missing(unseen)
            blank = [w for w in missing if w.isspace()]
            plain = [w for w in missing if not w.isspace()]
            self.words.young.update(zip(blank, self._library(blank)))
            self.words.young.update(zip(plain, self._encode_words(plain)))
            at = self.words.young.__getitem__
            found = [[at(w) if x is None else x for w, x in zip(p, ids)] if ids and None in ids else ids
                     for p, ids in zip(parts, found)]
        rest = iter(self._library([t for t, p in zip(texts, parts) if p is None]))
        return [next(rest) if ids is None else b"".join(ids) for ids in found]
