"""Token ids of whole texts, with the library called once per distinct word.

The tokenizer lower-cases, splits at white space and never merges across it, so a text's ids are the ids of its
white-space-separated words in turn. Words repeat far more often than they are new: each Python worker keeps the ids
of the words it has met in a bounded table and calls the tokenizers library for the others only. ``tests/llm`` hold
the result against the library's own encoding of the whole text.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs one worker per core

CACHE_WORDS = 1 << 19  # words kept per worker; beyond it the table starts anew
SLICE_BYTES = 1 << 20  # text split into words at a time
# A word of Latin letters and what the tokenizer separates from it: letters and punctuation never share a pre-token.
_PLAIN = re.compile(rb"((?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]|\xc5[\x92\x93])+)([.,!*$&%#|;:?]*)")


class WordEncoder:
    """Ids of UTF-8 texts by a tokenizer file, ``add_special_tokens=False``.

    Plain words of letters are one pre-token in composed form, so they go to the tokenizer's model at once, lower-cased and with
    their bytes spelt as its byte-level alphabet does; everything else is encoded by the whole tokenizer.
    """

    def __init__(self, path: str, limit: int = CACHE_WORDS):
        from tokenizers import Tokenizer, pre_tokenizers

        self._tokenizer = Tokenizer.from_file(path)
        self._model = self._tokenizer.model
        self.size = self._tokenizer.get_vocab_size()
        spell = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        letters = [chr(c) for c in (*range(0xDF, 0xF7), *range(0xF8, 0x100), 0x153)]
        self._spelling = {ord(letter): spell.pre_tokenize_str(letter)[0][0] for letter in letters}
        self._limit = limit
        self._parts: dict[bytes, bytes] = {}  # ids of cores and tails, packed: four bytes each
        self._forget()

    def _forget(self) -> None:
        self._rows: dict[bytes, int] = {}
        if len(self._parts) > self._limit:  # words have fewer cores than there are words: those stay longer
            self._parts = {}
        self._flat = np.zeros(1 << 12, np.uint32)
        self._ends = np.zeros(1 << 10, np.int64)  # where a row's ids end in _flat; row 0 is empty
        self._used = self._count = 0

    def _whole(self, word: bytes) -> bytes:
        return array("I", self._tokenizer.encode(word.decode("utf-8", "replace"), add_special_tokens=False).ids).tobytes()

    def _ids(self, word: bytes) -> bytes:
        plain = _PLAIN.fullmatch(word)
        if not plain:
            return self._whole(word)
        parts = self._parts
        core, tail = plain.group(1).lower(), plain.group(2)
        ids = parts.get(core)
        if ids is None:
            spelt = core.decode() if core.isascii() else core.decode().lower().translate(self._spelling)
            ids = parts[core] = array("I", [token.id for token in self._model.tokenize(spelt)]).tobytes()
        if not tail:
            return ids
        after = parts.get(tail)
        if after is None:
            after = parts[tail] = self._whole(tail)
        return ids + after

    def _learn(self, words: list[bytes]) -> None:
        ids = list(map(self._ids, words))
        added = np.frombuffer(b"".join(ids), np.uint32)
        if self._used + len(added) > len(self._flat):
            self._flat = np.concatenate([self._flat[: self._used], np.zeros(max(len(added), self._used) * 2, np.uint32)])
        if self._count + len(words) + 1 > len(self._ends):
            self._ends = np.concatenate([self._ends[: self._count + 1], np.zeros(2 * (self._count + len(words)), np.int64)])
        self._flat[self._used : self._used + len(added)] = added
        lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        self._ends[self._count + 1 : self._count + 1 + len(words)] = self._used + np.cumsum(lengths)
        self._rows.update(zip(words, range(self._count + 1, self._count + 1 + len(words))))
        self._used += len(added)
        self._count += len(words)

    def _look_up(self, words: list[bytes]) -> np.ndarray:
        """The row of each word; those not met before are learnt."""
        found = np.array(list(map(self._rows.get, words)), float)  # a missing row becomes nan
        missing = np.flatnonzero(np.isnan(found)).tolist()
        if missing:
            if len(self._rows) > self._limit or len(self._parts) > self._limit:
                self._forget()
                missing = range(len(words))
            self._learn(list(dict.fromkeys([words[i] for i in missing])))
            found[missing] = [self._rows[words[i]] for i in missing]
        return found.astype(np.int64)

    def word_counts(self, words: list[bytes]) -> np.ndarray:
        """The number of ids of each word (bytes without ASCII white space)."""
        rows = self._look_up(words)
        return self._ends[rows] - self._ends[rows - 1] if len(rows) else rows

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and the number of ids of each."""
        split = [text.split() for text in texts]
        words = list(chain.from_iterable(split))
        if not words:
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        rows = self._look_up(words)
        first = self._ends[rows - 1]
        lengths = self._ends[rows] - first
        ends = np.cumsum(lengths)
        ids = self._flat[np.repeat(first - (ends - lengths), lengths) + np.arange(ends[-1])]
        last_word = np.cumsum(np.fromiter(map(len, split), np.int64, len(split)))
        text_ends = np.concatenate([[0], ends])[last_word]
        return ids, np.diff(text_ends, prepend=0)

    def slices(self, rows: Iterable[tuple[int | None, bytes]]) -> Iterator[tuple[list[int | None], np.ndarray, np.ndarray]]:
        """(ids of documents, token ids, tokens per document) for about ``SLICE_BYTES`` of text at a time."""
        keys, texts, size = [], [], 0
        for key, text in rows:
            keys.append(key)
            texts.append(text)
            size += len(text)
            if size >= SLICE_BYTES:
                yield keys, *self.encode(texts)
                keys, texts, size = [], [], 0
        if keys:
            yield keys, *self.encode(texts)


@lru_cache(maxsize=2)
def encoder(path: str, words: int = CACHE_WORDS) -> WordEncoder:
    """This worker's encoder of a tokenizer file, which keeps so many words."""
    return WordEncoder(path, words)


def rows_of(batches: Iterable) -> Iterator[tuple[int | None, bytes]]:
    """(id, text) of Arrow batches with the columns ``id`` and ``text``."""
    for batch in batches:
        yield from zip(batch.column("id").to_pylist(), batch.column("text").to_pylist())
