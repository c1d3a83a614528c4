"""Token files: the ids of documents in one array, with Elias-Fano coded document boundaries.

A file is one block of whole documents (its size is bounded but for a single longer document):

    magic, partition, block, documents, leading null ids, first id, token ids, bytes per id | document ids | boundaries | ids

Document ids and boundaries ascend, so both are Elias-Fano sequences: the low bits of each value side by side, the high
bits as a unary bit vector, and the position of every 256th one, from which ``select`` finds any value without decoding
the others: about 2 + log2(universe / n) bits a document in place of a 64-bit offset.

Spark's own writer puts the files in place, so any file system that Spark reaches will do, a task that is repeated
leaves one copy, and a lost executor costs its running tasks only.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tillwise.llm.shipping import ship, utf8
from tillwise.llm.wordids import encoder, rows_of
from tillwise.session import durable, shared_folder, tune

MAGIC = b"TWIDS001"
HEADER = struct.Struct("<8sQQQQqQB")
SEQUENCE = struct.Struct("<QQBQQ")
SAMPLE = 256
RUN = 16 * SAMPLE  # documents whose boundaries are read at a time
IDS_PER_FILE = 8 << 20

_ONES = np.array([bin(b).count("1") for b in range(256)], np.uint8)


class EliasFano:
    """An ascending sequence of unsigned 64-bit numbers in near-minimal space."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self._low_bits, self._low, self._high, self._samples = n, low_bits, low, high, samples

    @staticmethod
    def of(values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        universe = int(values[-1]) + 1 if n else 1
        low_bits = max(0, (universe // max(n, 1)).bit_length() - 1)
        places = np.arange(low_bits, dtype=np.uint64)
        low = np.packbits(((values[:, None] >> places) & np.uint64(1)).astype(np.uint8), bitorder="little")
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        bits[ones] = 1
        return EliasFano(n, low_bits, low, np.packbits(bits, bitorder="little"), ones[::SAMPLE].astype("<u4"))

    def to_bytes(self) -> bytes:
        head = SEQUENCE.pack(self.n, len(self._samples), self._low_bits, len(self._low), len(self._high))
        return head + self._low.tobytes() + self._high.tobytes() + self._samples.tobytes()

    @staticmethod
    def read(data: bytes, at: int) -> tuple[EliasFano, int]:
        """The sequence that starts at a byte, and the byte after it."""
        n, samples, low_bits, low, high = SEQUENCE.unpack_from(data, at)
        at += SEQUENCE.size
        parts = []
        for kind, count in ((np.uint8, low), (np.uint8, high), ("<u4", samples)):
            parts.append(np.frombuffer(data, kind, count, at))
            at += parts[-1].nbytes
        return EliasFano(n, low_bits, *parts), at

    def _lows(self, first: int, last: int) -> np.ndarray:
        begin = first * self._low_bits
        bits = np.unpackbits(self._low[begin // 8 : (last * self._low_bits + 7) // 8], bitorder="little")[begin % 8 :]
        bits = bits[: (last - first) * self._low_bits].reshape(last - first, self._low_bits).astype(np.uint64)
        return (bits << np.arange(self._low_bits, dtype=np.uint64)).sum(1, dtype=np.uint64)

    def values(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self._high, bitorder="little"))[: self.n]
        return ((ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self._low_bits)) | self._lows(0, self.n)

    def selected(self, first: int, last: int) -> np.ndarray:
        """Values ``first`` to ``last`` - 1, read from the sample before the first; what lies elsewhere is not decoded."""
        if first >= last:
            return np.zeros(0, np.uint64)
        sample, stop = first // SAMPLE, -(-last // SAMPLE)
        begin = int(self._samples[sample]) // 8
        end = int(self._samples[stop]) // 8 + 1 if stop < len(self._samples) else len(self._high)
        ones = begin * 8 + np.flatnonzero(np.unpackbits(self._high[begin:end], bitorder="little"))
        skipped = np.searchsorted(ones, int(self._samples[sample])) + first - sample * SAMPLE
        ones = ones[skipped : skipped + last - first]
        return ((ones - np.arange(first, last)).astype(np.uint64) << np.uint64(self._low_bits)) | self._lows(first, last)

    def select(self, i: int) -> int:
        """Value ``i``, found from the sample before it."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at, missing = int(self._samples[i // SAMPLE]), i % SAMPLE
        byte = at // 8
        bits = int(self._high[byte]) & (0xFF << at % 8)
        while missing >= _ONES[bits]:
            missing -= int(_ONES[bits])
            byte += 1
            bits = int(self._high[byte])
        place = byte * 8 + int(np.flatnonzero(np.unpackbits(np.array([bits], np.uint8), bitorder="little"))[missing])
        return ((place - i) << self._low_bits) | int(self._lows(i, i + 1)[0])


@dataclass
class TokenBlock:
    """One token file in memory."""

    partition: int
    block: int
    nulls: int
    first: int
    doc_ids: EliasFano
    ends: EliasFano
    ids: np.ndarray

    def to_bytes(self) -> bytes:
        width = self.ids.dtype.itemsize
        head = HEADER.pack(MAGIC, self.partition, self.block, self.ends.n, self.nulls, self.first, len(self.ids), width)
        return head + self.doc_ids.to_bytes() + self.ends.to_bytes() + self.ids.tobytes()

    @staticmethod
    def read(data: bytes) -> TokenBlock:
        magic, partition, block, _, nulls, first, n_ids, width = HEADER.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a token file")
        doc_ids, at = EliasFano.read(data, HEADER.size)
        ends, at = EliasFano.read(data, at)
        return TokenBlock(partition, block, nulls, first, doc_ids, ends, np.frombuffer(data, f"<u{width}", n_ids, at))

    def document_ids(self, first: int = 0, last: int | None = None) -> list[int | None]:
        """The ids of documents ``first`` to ``last`` - 1; those without one come first."""
        last = self.ends.n if last is None else last
        steps = self.doc_ids.selected(max(first - self.nulls, 0), max(last - self.nulls, 0))
        return [None] * max(0, min(last, self.nulls) - first) + [self.first + int(step) for step in steps]

    def bounds(self, first: int, last: int) -> np.ndarray:
        """Where documents ``first`` to ``last`` - 1 begin and, last, where the last one ends, by selects."""
        before = self.ends.select(first - 1) if first else 0
        return np.concatenate([[before], self.ends.selected(first, last).astype(np.int64)])

    def document(self, i: int) -> np.ndarray:
        """The token ids of document ``i`` of this block, by two selects."""
        return self.ids[self.ends.select(i - 1) if i else 0 : self.ends.select(i)]


def _block(partition: int, number: int, keys: list[int | None], counts: np.ndarray, ids: np.ndarray) -> bytes:
    known = [key for key in keys if key is not None]
    first = known[0] if known else 0
    steps = np.array([key - first for key in known], np.uint64)
    ends = np.cumsum(counts).astype(np.uint64)
    return TokenBlock(partition, number, len(keys) - len(known), first, EliasFano.of(steps), EliasFano.of(ends), ids).to_bytes()


def _blocks(path: str, end_id: int, limit: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        kind = "<u2" if max(encode.size, end_id + 1) <= 1 << 16 else "<u4"
        partition, number = TaskContext.get().partitionId(), 0
        keys: list[int | None] = []
        counts: list[np.ndarray] = []
        ids: list[np.ndarray] = []
        held = 0

        def flush() -> pa.RecordBatch:
            data = _block(partition, number, keys, np.concatenate(counts), np.concatenate(ids))
            return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["block"])

        for some, flat, lengths in encode.slices(rows_of(batches)):
            ends = np.cumsum(lengths)
            closed = np.insert(flat, ends, end_id).astype(kind)
            lengths = lengths + 1
            if held and held + len(closed) > limit:
                yield flush()
                number, held = number + 1, 0
                keys, counts, ids = [], [], []
            keys += some
            counts.append(lengths)
            ids.append(closed)
            held += len(closed)
        if keys:
            yield flush()

    return run


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int, doc_id: str = "doc_id", text: str = "text", ids_per_file: int = IDS_PER_FILE
) -> None:
    """Encode every whole text, append ``end_id`` and write token files to ``folder`` in ascending document order.

    Null ids come first, a null text is empty, rows of one id follow each other in the order of their texts. A slice of
    about 1 MB of text goes to one file whole, so a file holds ``ids_per_file`` ids or one slice (one document, if longer).
    An empty table writes no files.
    """
    ship(tune(docs.sparkSession))
    ordered = utf8(docs, doc_id, text).repartitionByRange(F.col("id").asc_nulls_first()).sortWithinPartitions(F.col("id").asc_nulls_first(), "text")
    blocks = ordered.mapInArrow(_blocks(tokenizer, end_id, ids_per_file), "block binary")
    # the text writer puts the bytes of a string out as they are, one record a file
    blocks.select(F.col("block").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).mode("overwrite").text(folder)


def _documents(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column("content"):
            block = TokenBlock.read(content.as_buffer().to_pybytes())
            for first in range(0, block.ends.n, RUN):
                last = min(first + RUN, block.ends.n)
                bounds = block.bounds(first, last)
                crcs = [zlib.crc32(block.ids[a:b].astype("<u4").data) for a, b in pairwise(bounds.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(block.document_ids(first, last), pa.int64()),
                        pa.array(np.full(last - first, block.partition)),
                        pa.array(np.full(last - first, block.block)),
                        pa.array(np.arange(first, last)),
                        pa.array(bounds[:-1]),
                        pa.array(np.diff(bounds)),
                        pa.array(crcs, pa.int64()),
                    ],
                    ["doc_id", "partition", "block", "place", "start", "n_tokens", "ids_crc32"],
                )


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    The files are read once. Their totals, one row each, are summed up in order, and the sums go back by a join.
    """
    files = ship(tune(spark)).read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("content")
    found = durable(
        files.mapInArrow(
            _documents, "doc_id long, partition long, block long, place long, start long, n_tokens long, ids_crc32 long"
        )
    )
    totals = found.groupBy("partition", "block").agg(F.sum("n_tokens").alias("total"))
    order = Window.orderBy("partition", "block").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select("partition", "block", F.coalesce(F.sum("total").over(order), F.lit(0)).alias("before"))
    return found.join(before, ["partition", "block"]).select(
        "doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_folder(spark: SparkSession) -> str:
    """A new folder for token files beside the session's checkpoints."""
    return f"{shared_folder(spark)}/tokens-{uuid.uuid4().hex}"
