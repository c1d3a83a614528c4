"""Byte-level BPE by a dynamic program over prefixes.

A text is split by the vocabulary's pattern; each match (a piece) is encoded by itself. The encoding of every prefix of a piece ends in
one token, and two neighbouring tokens tell whether they may stand side by side: a sequence is the encoding of its bytes if, and only
if, each two of its neighbours are the encoding of theirs. So the last token of the prefix that ends at byte i is the one token t
with bytes up to i that fits behind the last token of the prefix before t, and there is exactly one. These last tokens are all that is
kept (``Prefixes``): the encoding is read from the end, bytes are appended without a look at what is before, and after an edit
only the bytes are gone through again until as many last tokens in a row as the longest token has bytes are what they were.

Whether two tokens fit is found by taking both apart along their last merges, latest first: they do not if at any time the
tokens at the seam would have merged before those around them came to be.

As the tiktoken library does, a piece that is a token as a whole is that token, even if merges do not lead to it.

Each Python worker reads the ranks once and keeps the ids of pieces it has met, up to two generations of ``KEPT``. New pieces are gone
through in their order, each from the prefix it shares with the one before. Texts are encoded in slices, so memory does not follow
their length but for the ids of one text.

Nulls: a null text is the empty text, which has no tokens; a null id stays null. Repeated rows are rows of their own. An empty table
gives an empty result. Columns other than those named do not matter.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from tillwise.llm.shipping import released, ship, whole
from tillwise.session import tune

KEPT = 1 << 18  # pieces kept by a worker
LONG = 64  # bytes of a piece that is not worth keeping
SLICE = 1 << 20  # characters of a text that is split at once, else pieces at a time
AHEAD = 4  # characters that the pattern looks at beyond a piece, at most

ENCODED = "doc_id long, ids array<int>"
DECODED = "doc_id long, ids array<int>, bytes binary"


class Vocabulary:
    """Ranks of byte strings, and which tokens may follow which."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        # of all beginnings of tokens, the token that they are, or -1
        self._spelt = {token[:i]: -1 for token in ranks for i in range(1, len(token))} | ranks
        self._split: dict[int, tuple[int, int] | None] = {}
        self._bits = max(self.bytes).bit_length()
        self._fit: dict[int, bool] = {}

    @staticmethod
    def read(path: str) -> Vocabulary:
        """The ranks of a file with a line per token: its bytes in base 64 and its rank."""
        with open(path, "rb") as lines:
            return Vocabulary({base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())})

    def merged(self, piece: bytes) -> list[int]:
        """The ids of a few bytes by merging, lowest rank first: what the vocabulary's merges mean."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            ranks = [self.ranks.get(a + b, len(self.ranks) + 1) for a, b in zip(parts, parts[1:])]
            at = min(range(len(ranks)), key=ranks.__getitem__)
            if ranks[at] > len(self.ranks):
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[part] for part in parts]

    def split(self, token: int) -> tuple[int, int] | None:
        """The two tokens that a token's last merge joins; None for a byte, and for a token that merges do not lead to."""
        if token in self._split:
            return self._split[token]
        whole, found = self.bytes[token], None
        if len(whole) > 1:
            parts = [whole[i : i + 1] for i in range(len(whole))]
            while len(parts) > 2:
                ranks = [self.ranks.get(a + b) for a, b in zip(parts, parts[1:])]
                known = [rank for rank in ranks if rank is not None]
                if not known:
                    break
                at = ranks.index(min(known))
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            if len(parts) == 2:
                found = self.ranks[parts[0]], self.ranks[parts[1]]
        self._split[token] = found
        return found

    def fit(self, left: int, right: int) -> bool:
        """Whether the bytes of two tokens, one after the other, are encoded as just these; with -1 on the left, whether those of one are."""
        key = left << self._bits | right
        known = self._fit.get(key)
        if known is None:
            if len(self._fit) > 2 * KEPT:
                self._fit.clear()
            reached = len(self.bytes[right]) == 1 or self.split(right) is not None  # else merges do not lead to it
            known = self._fit[key] = reached and (left < 0 or self._fits(left, right))
        return known

    def _fits(self, left: int, right: int) -> bool:
        ranks, names = self.ranks, self.bytes
        # merges at ``until`` or later have been undone; of equal ranks the one further left comes first
        until = len(ranks) + 1
        while True:
            joined = ranks.get(names[left] + names[right])
            if joined is not None and joined < until:
                return False
            if left > right:
                parts, until = self.split(left), left
                if parts:
                    left = parts[1]
                    continue
                parts, until = self.split(right), right + 1
                if not parts:
                    return True
                right = parts[0]
            else:
                parts, until = self.split(right), right + 1
                if parts:
                    right = parts[0]
                    continue
                parts, until = self.split(left), left
                if not parts:
                    return True
                left = parts[1]

    def advance(self, piece: bytes, last: list[int], end: int) -> None:
        """Append to ``last`` the last tokens of the prefixes of ``piece`` up to ``end`` bytes; it holds those of the shorter ones.

        Goes forward: behind a prefix stands each token that the next bytes spell and that fits its last token.
        """
        known, longest, bits = len(last), self.longest, self._bits
        spelt, fits = self._spelt.get, self._fit.get
        last += [-1] * (end - known)
        for begin in range(max(0, known - longest + 1), end):
            before = last[begin - 1] if begin else -1
            for stop in range(max(begin, known) + 1, min(end, begin + longest) + 1):
                if last[stop - 1] >= 0:
                    continue
                token = spelt(piece[begin:stop])
                if token is None:
                    break
                if token >= 0:
                    fit = fits(before << bits | token)
                    if self.fit(before, token) if fit is None else fit:
                        last[stop - 1] = token

    def ids(self, piece: bytes, last: list[int]) -> list[int]:
        """The encoding of a piece, read from its end."""
        token = self.ranks.get(piece)
        if token is not None:
            return [token]
        out, at = [], len(piece)
        while at:
            out.append(last[at - 1])
            at -= len(self.bytes[out[-1]])
        return out[::-1]


class Prefixes:
    """A piece with the last token of each of its prefixes."""

    def __init__(self, vocabulary: Vocabulary, piece: bytes = b""):
        self._vocabulary = vocabulary
        self.bytes = b""
        self.last: list[int] = []
        self.looked_at = 0  # prefixes gone through since the beginning
        self.append(piece)

    def _advance(self, end: int) -> None:
        self.looked_at += end - len(self.last)
        self._vocabulary.advance(self.bytes, self.last, end)

    def append(self, more: bytes) -> None:
        """Encode more bytes; what is there stays as it is."""
        self.bytes += more
        self._advance(len(self.bytes))

    def edit(self, place: int, removed: int, added: bytes) -> None:
        """Take ``removed`` bytes out at ``place`` and put ``added`` there; last tokens from where they are again what they were stay."""
        place = min(max(place, 0), len(self.bytes))
        rest = min(place + max(removed, 0), len(self.bytes))
        before = self.last[rest:]
        self.bytes = self.bytes[:place] + added + self.bytes[rest:]
        del self.last[place:]
        begin, longest = place + len(added), self._vocabulary.longest
        self._advance(begin)
        for done in range(longest, len(before) + 1, longest):
            self._advance(begin + done)
            if self.last[-longest:] == before[done - longest : done]:
                self.last += before[done:]
                return
        self._advance(len(self.bytes))

    def copy(self) -> Prefixes:
        other = Prefixes(self._vocabulary)
        other.bytes, other.last = self.bytes, self.last.copy()
        return other

    def ids(self) -> list[int]:
        return self._vocabulary.ids(self.bytes, self.last)


class _Known(dict):
    """Ids of pieces, four bytes each, in two generations: when the younger one is full it becomes the elder, which is forgotten."""

    def __init__(self, vocabulary: Vocabulary, limit: int):
        self._vocabulary, self._limit = vocabulary, limit
        self._elder: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        """A piece that is only there among the elder, or was too long to be kept."""
        ids = self._elder.get(piece)
        if ids is None:
            return array("i", Prefixes(self._vocabulary, piece.encode("utf-8", "replace")).ids()).tobytes()
        self[piece] = ids
        return ids

    def learn(self, pieces: set[str]) -> None:
        """Encode pieces that are not there: in their order, so that each goes on from what it shares with the one before."""
        if len(self) > self._limit:
            self._elder = dict(self)
            self.clear()
        elder, vocabulary = self._elder, self._vocabulary
        new = sorted((p.encode("utf-8", "replace"), p) for p in pieces if p not in self and p not in elder and len(p) <= LONG)
        before, last = b"", []
        for spelt, piece in new:
            shared, most = 0, min(len(before), len(spelt))
            while shared < most and before[shared] == spelt[shared]:
                shared += 1
            del last[shared:]
            vocabulary.advance(spelt, last, len(spelt))
            self[piece] = array("i", vocabulary.ids(spelt, last)).tobytes()
            before = spelt


class Encoder:
    """Ids of texts by a rank file and the pattern that splits a text."""

    def __init__(self, path: str, pattern: str, limit: int = KEPT):
        self.vocabulary = Vocabulary.read(path)
        self.pattern = regex.compile(pattern)
        self._known = _Known(self.vocabulary, limit)
        top = max(self.vocabulary.bytes) + 1
        sizes = np.zeros(top, np.int64)
        for token, spelt in self.vocabulary.bytes.items():
            sizes[token] = len(spelt)
        self._ends = np.cumsum(sizes)
        self._sizes = sizes
        self._spelt = np.frombuffer(b"".join(self.vocabulary.bytes.get(token, b"") for token in range(top)), np.uint8)

    def _pieces(self, text: str) -> Iterator[list[str]]:
        if len(text) <= SLICE:
            yield self.pattern.findall(text)
            return
        matches = self.pattern.finditer(text)
        while some := [match[0] for match in islice(matches, SLICE)]:
            yield some

    def encode(self, text: str) -> np.ndarray:
        known, out = self._known, []
        for some in self._pieces(text):
            known.learn(set(some))
            out.append(b"".join(map(known.__getitem__, some)))
        return np.frombuffer(b"".join(out), np.int32)

    def encode_all(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text; new pieces of about ``SLICE`` characters of texts are learnt together."""
        known = self._known.__getitem__
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size + len(texts[end]) <= SLICE):
                size += len(texts[end])
                end += 1
            if size > SLICE:
                yield self.encode(texts[at])
            else:
                split = [self.pattern.findall(text) for text in texts[at:end]]
                self._known.learn(set().union(*split))
                for some in split:
                    yield np.frombuffer(b"".join(map(known, some)), np.int32)
            at = end

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes that ids spell."""
        size = self._sizes[ids]
        stops = np.cumsum(size)
        at = np.repeat(self._ends[ids] - stops, size) + np.arange(stops[-1] if len(stops) else 0)
        return self._spelt[at]


class Document:
    """A text kept as pieces with their prefixes; an edit splits and encodes again only what it can have changed."""

    def __init__(self, encoder: Encoder, text: str):
        self._encoder = encoder
        self.text = text
        self.pieces: list[Prefixes] = []
        self.ends: list[int] = []  # in characters
        for match in encoder.pattern.finditer(text):
            self.pieces.append(Prefixes(encoder.vocabulary, match[0].encode("utf-8", "replace")))
            self.ends.append(match.end())
        self.split_again = 0  # pieces that edits have matched

    def edit(self, place: int, removed: int, added: str) -> None:
        """Take ``removed`` characters out at ``place`` and put ``added`` there."""
        place = min(max(place, 0), len(self.text))
        rest = min(place + max(removed, 0), len(self.text))
        shift = place + len(added) - rest
        old_text, old_ends, old_pieces = self.text, self.ends, self.pieces
        self.text = old_text[:place] + added + old_text[rest:]
        # a match depends on what follows it by ``AHEAD`` characters, and never on what is before
        first = int(np.searchsorted(old_ends, place - AHEAD)) if old_ends else 0
        at = old_ends[first - 1] if first else 0
        old_begins = {end + shift: i + 1 for i, end in enumerate(old_ends) if end >= rest}
        pieces, ends = [], []
        tail = len(old_pieces)
        while at < len(self.text):
            if at in old_begins and at >= place + len(added):
                tail = old_begins[at]
                break
            match = self._encoder.pattern.match(self.text, at)
            pieces.append(self._piece(match[0], at, first + len(pieces), old_pieces, old_ends))
            ends.append(match.end())
            at = match.end()
        self.split_again += len(pieces)
        self.pieces = old_pieces[:first] + pieces + old_pieces[tail:]
        self.ends = old_ends[:first] + ends + [end + shift for end in old_ends[tail:]]

    def _piece(self, text: str, at: int, number: int, old: list[Prefixes], ends: list[int]) -> Prefixes:
        """The prefixes of a match, from those of the piece that began there, if one did."""
        data = text.encode("utf-8", "replace")
        if number < len(old) and at == (ends[number - 1] if number else 0):
            had = old[number].bytes
            head = next((i for i, (a, b) in enumerate(zip(had, data)) if a != b), min(len(had), len(data)))
            tail = 0
            while tail < min(len(had), len(data)) - head and had[-1 - tail] == data[-1 - tail]:
                tail += 1
            edited = old[number].copy()  # the piece itself may stand further on
            edited.edit(head, len(had) - tail - head, data[head : len(data) - tail])
            return edited
        return Prefixes(self._encoder.vocabulary, data)

    def append(self, more: str) -> None:
        self.edit(len(self.text), 0, more)

    def ids(self) -> list[int]:
        return [token for piece in self.pieces for token in piece.ids()]


# --- over the table -------------------------------------------------------------------------------------------------


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    """This worker's encoder."""
    return Encoder(path, pattern)


def _lists(values: list[np.ndarray], kind: pa.DataType) -> tuple[pa.Array, pa.Array]:
    ends = np.cumsum([0, *map(len, values)])
    return pa.array(ends, pa.int32()), pa.array(np.concatenate(values) if values else np.zeros(0, np.int32), kind)


def _encoded(path: str, pattern: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, pattern).encode_all
        for batch in batches:
            ids = list(encode(batch.column("text").to_pylist()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.ListArray.from_arrays(*_lists(ids, pa.int32()))], ["doc_id", "ids"])

    return run


def _decoded(path: str, pattern: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = encoder(path, pattern).decode
        for batch in batches:
            spelt = [decode(ids.values.to_numpy()).tobytes() for ids in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("ids"), pa.array(spelt, pa.binary())], ["doc_id", "ids", "bytes"])

    return run


def encoded(docs: DataFrame, ranks: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids of every whole text, by a rank file and the pattern that splits texts."""
    ship(tune(docs.sparkSession))
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), whole(F.col(f"`{text}`")).alias("text"))
    return rows.mapInArrow(released(_encoded(ranks, pattern)), ENCODED)


def decoded(ids: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """``encoded`` rows with the bytes that their ids spell; a text's UTF-8 again, where the ids are its encoding."""
    return ids.select("doc_id", "ids").mapInArrow(released(_decoded(ranks, pattern)), DECODED)
