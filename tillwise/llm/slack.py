"""Packing by minimum bin slack: each sequence takes the combination of lengths that fills it best.

Documents are encoded and cut into pieces of at most the capacity. Pieces are dealt evenly to groups of a bounded number
of pieces; what a group wastes is at most its last sequences, so groups of thousands of pieces cost nothing that shows.
In a group, each sequence starts with the longest piece left and a subset-sum over the counts of the other lengths,
a bit set in one integer, finds the fullest completion; it is removed, as often as the counts allow, and so on.

Nulls: a null text is the empty text, whose piece holds the end id only; a null id stays null. Repeated rows are packed each for
itself. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tillwise.llm.shipping import released, ship, utf8
from tillwise.llm.wordids import CACHE_WORDS, encoder, rows_of
from tillwise.session import durable, tune

CAPACITY = 2048
PIECES_PER_GROUP = 1 << 14

PIECES = "doc_id long, piece long, start long, length long, ids_crc32 long"


def _pieces(path: str, end_id: int, capacity: int, words: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, flat, counts in encoder(path, words).slices(rows_of(batches)):
            ids = np.insert(flat, np.cumsum(counts), end_id).astype("<u4")
            counts = counts + 1
            pieces = -(-counts // capacity)
            piece = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = piece * capacity
            length = np.minimum(np.repeat(counts, pieces) - start, capacity)
            ends = np.cumsum(length)
            crcs = [zlib.crc32(ids[a:b].data) for a, b in zip((ends - length).tolist(), ends.tolist())]
            of = np.repeat(np.arange(len(keys)), pieces)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()).take(pa.array(of)), pa.array(piece), pa.array(start), pa.array(length), pa.array(crcs, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return run


def token_pieces(
    docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY, doc_id: str = "doc_id", text: str = "text", words: int = CACHE_WORDS
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: every document's ids with the end id, cut only beyond the capacity."""
    return utf8(docs, doc_id, text).mapInArrow(released(_pieces(tokenizer, end_id, capacity, words)), PIECES)


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of lengths, out of ``counts``, with the greatest sum up to ``room``; longer lengths are tried first."""
    reach, mask, steps = 1, (2 << room) - 1, []
    for length in sorted((x for x, n in counts.items() if n and x <= room), reverse=True):
        left, share = min(counts[length], room // length), 1
        while left:
            times = min(share, left)
            grown = (reach | reach << length * times) & mask
            if grown != reach:
                steps.append((length, times, reach))
                reach = grown
            left -= times
            share *= 2
        if reach >> room:
            break
    total, chosen = reach.bit_length() - 1, {}
    for length, times, before in reversed(steps):
        if not before >> total & 1:
            chosen[length] = chosen.get(length, 0) + times
            total -= length * times
    return chosen


def pack(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """The sequence (from 0) and the offset of every piece; lengths are from 1 to the capacity."""
    order = np.argsort(lengths, kind="stable")
    kinds, first, number = np.unique(lengths[order], return_index=True, return_counts=True)
    waiting = {int(k): order[f : f + n][::-1].tolist() for k, f, n in zip(kinds, first, number)}
    counts = {k: len(v) for k, v in waiting.items()}
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    used = 0
    for longest in sorted(counts, reverse=True):
        while counts[longest]:
            counts[longest] -= 1
            chosen = fullest(counts, capacity - longest)
            counts[longest] += 1
            chosen[longest] = chosen.get(longest, 0) + 1
            for _ in range(min(counts[k] // n for k, n in chosen.items())):
                at = 0
                for length in sorted(chosen, reverse=True):
                    for _ in range(chosen[length]):
                        piece = waiting[length].pop()
                        sequence[piece], offset[piece] = used, at
                        at += length
                    counts[length] -= chosen[length]
                used += 1
    return sequence, offset


def _pack_group(capacity: int):
    def run(key: tuple[int], frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["place"], kind="stable", ignore_index=True)
        sequence, offset = pack(frame["length"].to_numpy(np.int64), capacity)
        return frame.drop(columns=["group", "place"]).assign(sequence_id=sequence + (int(key[0]) << 32), offset=offset)

    return run


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, per_group: int = PIECES_PER_GROUP) -> DataFrame:
    """``pieces`` (with ``length``) and their sequence_id and gapless offset.

    The pieces must read the same each time (a written table), as they are counted and dealt out by their place in it.
    """
    groups = max(1, math.ceil(pieces.count() / per_group))
    placed = pieces.withColumn("place", F.monotonically_increasing_id())
    dealt = placed.withColumn("group", F.pmod(F.xxhash64("place"), F.lit(groups)))
    fields = ", ".join(f"`{name}` {kind}" for name, kind in pieces.dtypes)
    return dealt.groupBy("group").applyInPandas(_pack_group(capacity), f"{fields}, sequence_id long, offset long")


def packed(
    docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY, doc_id: str = "doc_id", text: str = "text", words: int = CACHE_WORDS
) -> DataFrame:
    """One row per piece of every document: its tokens' place in the document and in a sequence. ``words``: kept per worker, for speed only."""
    ship(tune(docs.sparkSession))
    return pack_pieces(durable(token_pieces(docs, tokenizer, end_id, capacity, doc_id, text, words)), capacity)
