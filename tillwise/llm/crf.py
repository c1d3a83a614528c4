"""Document quality by a linear-chain conditional random field over lines.

Every line is good or bad. Its evidence is counts about its own characters and words and about the lines before and
after it, each cut into ranges; a transition weight ties neighbouring lines. The model is fitted on a bounded sample of
labelled documents, read on the executors, whose label every line takes over. A document's quality is the mean of the lines' forward-backward
marginals of "good", weighted by line length.

Nulls: a null text is the empty text, which is one empty line; a null id is never held out. Rows repeat as they are.
Without labels every score is 0.5. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from tillwise.llm.shipping import released, ship, utf8, whole
from tillwise.llm.wordids import rows_of
from tillwise.llm.words import Words, slices
from tillwise.session import tune

FIT_DOCUMENTS = 4000  # labelled documents that the model is fitted on, at most
ROUNDS = 150

_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "digit": b"0123456789",
    "mark": b".,;:?",
    "shout": b"!",
    "bar": b"|",
    "symbol": b"#$%&*+/<=>@[\\]^_`{}~",
}
# ranges of the ratios, of the numbers of words and of the mean word length
_RATIO = np.array([0.001, 0.01, 0.03, 0.07, 0.15, 0.3, 0.5, 0.75])
_WORDS = np.array([1, 3, 6, 12, 25, 50, 100, 400])
_LENGTH = np.array([1.5, 2.5, 3.5, 4.5, 5.5, 6.5, 8, 12])
WIDTH = 9
STATISTICS = 12
OFFSETS = (0, -1, 1, -2, 2)  # the line itself and its neighbours


def _per_line(mask: np.ndarray, begins: np.ndarray) -> np.ndarray:
    return np.add.reduceat(mask, begins, dtype=np.int64)


@dataclass
class Lines:
    """The lines of some texts: their bytes, the range of lines of each text, and the range each statistic falls in."""

    size: np.ndarray
    count: np.ndarray  # lines per text
    ranges: np.ndarray  # lines x STATISTICS, numbers below WIDTH

    @staticmethod
    def of_many(texts: list[bytes]) -> Lines:
        """The same, in as little memory as a slice of the texts needs."""
        parts = [Lines.of(some) for _, some in slices(zip(range(len(texts)), texts))]
        return Lines(*(np.concatenate([getattr(part, name) for part in parts]) for name in ("size", "count", "ranges")))

    @staticmethod
    def of(texts: list[bytes]) -> Lines:
        words = Words.of(texts)
        raw = words.raw
        ends = np.flatnonzero(raw == 10)
        begins = np.concatenate([np.zeros(1, np.int64), ends[:-1] + 1])
        size = ends - begins
        text_ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1) - 1
        count = np.diff(np.searchsorted(ends, text_ends) + 1, prepend=0)

        table = np.zeros(256, np.uint8)
        for i, members in enumerate(_CLASSES.values(), 1):
            table[list(members)] = i
        kinds = table[raw]
        found = {name: _per_line(kinds == i, begins) for i, name in enumerate(_CLASSES, 1)}

        first = np.searchsorted(words.starts, begins)
        number = np.diff(np.append(first, len(words.starts)))
        hashes = words.hashes()

        def repeats(distance: int) -> np.ndarray:
            same = np.zeros(len(hashes) + 1, np.int64)
            if len(hashes) > distance:
                same[distance + 1 :] = np.cumsum(hashes[distance:] == hashes[:-distance])
            total = same[np.append(first, len(hashes))]
            # pairs that begin in an earlier line are few; they are told by the neighbours as well
            return total[1:] - total[:-1]

        filled, worded = np.maximum(size, 1), np.maximum(number, 1)
        letters = np.maximum(found["upper"] + found["lower"], 1)
        ratios = [found["upper"] / letters]
        ratios += [found[name] / filled for name in ("digit", "mark", "shout", "bar", "symbol")]
        ratios += [repeats(1) / worded, repeats(2) / worded, (found["bar"] + found["shout"] + found["symbol"]) / worded]
        columns = [np.searchsorted(_RATIO, r, side="right") for r in ratios]
        columns.append(np.searchsorted(_WORDS, number, side="right"))
        columns.append(np.searchsorted(_LENGTH, size / worded, side="right"))
        closing = np.where(size > 0, raw[np.maximum(ends - 1, 0)], 0)
        columns.append(np.where(size == 0, 0, np.where(np.isin(closing, list(b".!?")), 1, 2)))
        return Lines(size, count, np.stack(columns, 1).astype(np.int64))


@dataclass
class Model:
    """``weights``: per offset, statistic and range, towards "good"; ``transition[a, b]``: from a to b; ``start``: at the first line."""

    weights: np.ndarray
    transition: np.ndarray
    start: float

    @staticmethod
    def blank() -> Model:
        return Model(np.zeros((len(OFFSETS), STATISTICS, WIDTH)), np.zeros((2, 2)), 0.0)


def _neighbours(lines: Lines, offset: int) -> tuple[np.ndarray, np.ndarray]:
    """(line, its neighbour at the offset) for all that have one in their text."""
    text = np.repeat(np.arange(len(lines.count)), lines.count)
    line = np.arange(len(text))
    other = line + offset
    inside = (other >= 0) & (other < len(text))
    inside[inside] = text[other[inside]] == text[line[inside]]
    return line[inside], other[inside]


def _evidence(lines: Lines, model: Model) -> np.ndarray:
    out = np.zeros(len(lines.size))
    for k, offset in enumerate(OFFSETS):
        own = model.weights[k][np.arange(STATISTICS), lines.ranges].sum(1)
        line, other = _neighbours(lines, offset)
        out[line] += own[other]
    first = np.cumsum(lines.count) - lines.count
    out[first] += model.start
    return out


def _messages(evidence: np.ndarray, count: np.ndarray, transition: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log odds of "good" that reach each line from the lines before it (with its own evidence) and from those after it.

    All texts advance together, one line a step; texts that have ended drop out.
    """
    t = transition
    forward, backward = evidence.copy(), np.zeros(len(evidence))
    order = np.argsort(-count, kind="stable")
    first, length = (np.cumsum(count) - count)[order], count[order]
    active = np.searchsorted(-length, -np.arange(1, length[0] + 1 if len(length) else 1), side="right")
    for step in range(1, len(active)):
        at = first[: active[step]] + step
        a = forward[at - 1]
        forward[at] += np.logaddexp(a + t[1, 1], t[0, 1]) - np.logaddexp(a + t[1, 0], t[0, 0])
    for step in range(len(active) - 1, 0, -1):
        at = first[: active[step]] + step
        a = backward[at] + evidence[at]
        backward[at - 1] = np.logaddexp(a + t[1, 1], t[1, 0]) - np.logaddexp(a + t[0, 1], t[0, 0])
    return forward, backward


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(x / 2))


def marginals(lines: Lines, model: Model) -> np.ndarray:
    """The probability that each line is good."""
    forward, backward = _messages(_evidence(lines, model), lines.count, model.transition)
    return _sigmoid(forward + backward)


def fit(texts: list[bytes], labels: list[int], **how) -> Model:
    """``fit_lines`` of some texts."""
    return fit_lines(Lines.of_many(texts), labels, **how) if texts else Model.blank()


def fit_lines(lines: Lines, labels: list[int], rounds: int = ROUNDS, decay: float = 2e-4, step: float = 0.1) -> Model:
    """The weights of greatest conditional likelihood, by Adam; every line of a text bears its text's label."""
    model = Model.blank()
    truth = np.repeat(np.array(labels, float), lines.count)
    pairs = [_neighbours(lines, offset) for offset in OFFSETS]
    _, before = _neighbours(lines, -1)
    after = before + 1
    first = np.cumsum(lines.count) - lines.count
    share = 1 / len(labels)
    # a text counts the same, however many lines it has
    weight = np.repeat(1 / lines.count, lines.count)

    value = np.concatenate([model.weights.ravel(), model.transition.ravel(), [0.0]])
    mean, square = np.zeros_like(value), np.zeros_like(value)
    for turn in range(1, rounds + 1):
        model = Model(value[:-5].reshape(model.weights.shape), value[-5:-1].reshape(2, 2), float(value[-1]))
        evidence = _evidence(lines, model)
        forward, backward = _messages(evidence, lines.count, model.transition)
        missing = (truth - _sigmoid(forward + backward)) * weight
        gradient = np.zeros_like(model.weights)
        for k, (line, other) in enumerate(pairs):
            for s in range(STATISTICS):
                gradient[k, s] = np.bincount(lines.ranges[other, s], missing[line], WIDTH)
        # marginals of neighbouring lines, up to a common factor: message in, transition, message out
        into, out = forward[before], evidence[after] + backward[after]
        logs = np.stack([model.transition[a, b] + a * into + b * out for a in (0, 1) for b in (0, 1)])
        joint = np.exp(logs - logs.max(0))
        joint /= joint.sum(0)
        seen = np.stack([(truth[before] == a) & (truth[after] == b) for a in (0, 1) for b in (0, 1)])
        moves = ((seen - joint) * weight[after]).sum(1)
        slope = np.concatenate([gradient.ravel(), moves, [missing[first].sum()]]) * share - decay * value
        mean = 0.9 * mean + 0.1 * slope
        square = 0.999 * square + 0.001 * slope**2
        value = value + step * (mean / (1 - 0.9**turn)) / (np.sqrt(square / (1 - 0.999**turn)) + 1e-8)
    return Model(value[:-5].reshape(model.weights.shape), value[-5:-1].reshape(2, 2), float(value[-1]))


def quality(texts: list[bytes], model: Model) -> np.ndarray:
    """The quality of each text, from 0 to 1."""
    lines = Lines.of(texts)
    good = marginals(lines, model)
    text = np.repeat(np.arange(len(texts)), lines.count)
    total = np.bincount(text, lines.size, len(texts))
    size = np.where(total[text] > 0, lines.size, 1)
    return np.bincount(text, size * good, len(texts)) / np.bincount(text, size, len(texts))


def held_out(doc_id: str, modulus: int, remainder: int):
    """Whether the crc32 of the id's text leaves the remainder."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % modulus == remainder, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """id, text, label of at most ``rows`` labelled documents, chosen by the hash of their ids.

    Only ids are sorted; what is broadcast has ``rows`` rows at most.
    """
    known = labels.filter(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull())
    per_id = known.groupBy(F.col(doc_id).cast("long").alias("id")).agg(F.max(label).cast("int").alias("label"))
    chosen = per_id.orderBy(F.md5(F.col("id").cast("string")), "id").limit(rows)
    return utf8(docs, doc_id, text).join(F.broadcast(chosen), "id")


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = FIT_DOCUMENTS, doc_id: str = "doc_id", text: str = "text") -> Model:
    """A model from the labelled documents among ``docs``; of rows that share an id the least text counts.

    The executors read the texts; the driver gets twelve small numbers a line of at most ``rows`` documents.
    """
    ship(tune(docs.sparkSession))
    sample = labelled_sample(docs, labels, label, rows, doc_id, text).groupBy("id").agg(F.min("text").alias("text"), F.max("label").alias("label"))
    seen = sample.mapInArrow(released(_line_ranges), "id long, label int, ranges binary").collect()
    seen.sort(key=lambda row: row.id)
    if not seen:
        return Model.blank()
    ranges = [np.frombuffer(row.ranges, np.uint8).reshape(-1, STATISTICS) for row in seen]
    count = np.array([len(lines) for lines in ranges])
    lines = Lines(np.zeros(count.sum(), np.int64), count, np.concatenate(ranges).astype(np.int64))
    return fit_lines(lines, [row.label for row in seen])


def _line_ranges(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = zip(batch.column("id").to_pylist(), batch.column("label").to_pylist())
        for some, texts in slices(zip(keys, batch.column("text").to_pylist())):
            lines = Lines.of(texts)
            ends = np.cumsum(lines.count)
            ranges = [lines.ranges[a:b].astype(np.uint8).tobytes() for a, b in zip(ends - lines.count, ends)]
            ids, labels = zip(*some)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(labels, pa.int32()), pa.array(ranges, pa.binary())], ["id", "label", "ranges"])


def _score(model):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in slices(rows_of(batches)):
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(quality(texts, model.value))], ["doc_id", "score"])

    return run


def scored(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, score of every whole text."""
    spark = ship(tune(docs.sparkSession))
    return utf8(docs, doc_id, text).mapInArrow(released(_score(spark.sparkContext.broadcast(model))), "doc_id long, score double")


def _keep(model, threshold: float):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                texts = batch.column("utf8").to_pylist()
                score = np.concatenate([quality(some, model.value) for _, some in slices(zip(range(len(texts)), texts))])
                yield batch.select(["row"]).filter(pa.array(score >= threshold))

    return run


def accepted(docs: DataFrame, model: Model, threshold: float = 0.7, text: str = "text") -> DataFrame:
    """The documents, all columns, whose quality reaches the threshold."""
    spark = ship(tune(docs.sparkSession))
    # the row as one column, so that no name of its own can clash
    rows = docs.select(F.encode(whole(F.col(f"`{text}`")), "UTF-8").alias("utf8"), F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row"))
    kept = rows.mapInArrow(released(_keep(spark.sparkContext.broadcast(model), threshold)), StructType([rows.schema["row"]]))
    return kept.select(*[F.col(f"row.`{name}`").alias(name) for name in docs.columns])
