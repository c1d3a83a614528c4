"""Toxic passages: maximum-scoring segments of token log odds, calibrated as extreme values.

*Token scores.* How often a token occurs in toxic and in clean labelled documents gives its log odds with a Dirichlet prior
and their z score. Tokens are a word (lower case, without punctuation around it) and its first letters, which catch
inflected forms; in these counts what a document repeats counts by its logarithm, and equal texts count once. A word scores by its most
certain token, if that is significantly and much more frequent in toxic ones; any other word scores -DRIFT, so a text of ordinary words
runs downhill.
*Segments.* Ruzzo and Tompa's scan finds, in time linear in the number of words, every maximal-scoring segment: all
disjoint passages that cannot be made better by adding or leaving out words. Every occurrence of a word scores, so each copy of a
repeated passage is found.
*Calibration.* The best score in n words of clean text is about extreme-value distributed, P(S >= x) ~ 1 - exp(-K n exp(-lambda x)):
lambda comes from the token scores in clean documents, K from their best segments. A document's evidence is the sum of
lambda S - log(K n) over its significant passages, of which m equal ones (but for case and punctuation) weigh 1 + log2(m); a logistic curve, fitted on labelled documents that gave no counts, turns it into
the score.

Only a bounded sample of labelled documents is fitted on; all documents are scanned whole. Nulls: a null or empty text has no
passage and scores as other texts without one; a null id is never held out. Without labels every score is 0. An empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tillwise.llm.crf import labelled_sample
from tillwise.llm.shipping import ship, utf8
from tillwise.llm.wordids import rows_of
from tillwise.llm.words import slices
from tillwise.session import durable, tune

FIT_DOCUMENTS = 20_000  # labelled documents that scores and calibration are fitted on, at most
DRIFT = 0.8
ENRICHED = 2.0  # log odds from which a significant token counts: seven times as frequent in toxic documents
PRIOR = 5.0  # occurrences that every token is given, shared by the sizes of the classes
PREFIXES = (4, 5, 6, 7)
CACHE_WORDS = 1 << 20
CALIBRATION = "pmod(crc32(encode(cast(id AS string), 'UTF-8')), 4) = 1"  # the part of the sample that gives no counts

_AROUND = "".join(map(chr, range(33, 48))) + ":;<=>?@[\\]^_`{|}~«»“”„‘’¿¡…"


def bare(word: bytes) -> str:
    """A word in lower case without the punctuation around it."""
    return word.decode("utf-8", "replace").lower().strip(_AROUND)


def tokens(word: bytes) -> list[str]:
    """A word without its punctuation, and its beginnings (marked by a hyphen)."""
    plain = bare(word)
    return [plain, *(plain[:k] + "-" for k in PREFIXES if len(plain) >= k)] if plain else []


@dataclass
class Toxicity:
    """Scores of significant tokens, the extreme-value constants, and the logistic curve of the evidence."""

    scores: dict[str, tuple[float, float]] = field(default_factory=dict)  # token: (log odds, z)
    scale: float = 1.0  # lambda
    constant: float = 1.0  # K
    slope: float = 0.0
    intercept: float = -700.0

    def word_score(self, word: bytes) -> float:
        known = [self.scores[t] for t in tokens(word) if t in self.scores]
        return max(known, key=lambda x: x[1])[0] if known else -DRIFT

    def evidence(self, segments: list[tuple[int, int, float]], words: int, copy: list[int] | None = None) -> float:
        """Sum of the passages' evidence beyond chance; 0 without a significant one.

        ``copy`` numbers equal passages from 1 on: m of them weigh 1 + log2(m) together. Without it all are different.
        """
        chance = math.log(max(self.constant * words, 1e-9))
        return sum(max(0.0, self.scale * s - chance) * (math.log2(k / (k - 1)) if k > 1 else 1.0) for (_, _, s), k in zip(segments, copy or [1] * len(segments)))

    def score(self, evidence: np.ndarray) -> np.ndarray:
        return 0.5 * (1 + np.tanh((self.slope * evidence + self.intercept) / 2))


def maximal_segments(at: list[int], score: list[float], drift: float = DRIFT) -> list[tuple[int, int, float]]:
    """(first word, word after the last, score) of all maximal-scoring segments, in order.

    ``at`` are the places of the words with a positive score, ascending; every word between costs ``drift``.
    """
    found: list[tuple[int, int, float, float]] = []  # first, after last, sum before, sum after
    total, end = 0.0, 0
    for place, gain in zip(at, score):
        before = total - drift * (place - end)
        total, end = before + gain, place + 1
        first, low, high = place, before, total
        while found:
            # the nearest segment that begins lower; those passed over end no segment that reaches here
            j = len(found) - 1
            while j >= 0 and found[j][2] >= low:
                j -= 1
            if j < 0 or found[j][3] >= high:
                break
            first, low = found[j][0], found[j][2]
            del found[j:]
        found.append((first, end, low, high))
    return [(first, after, high - low) for first, after, low, high in found]


def copies(words: list[bytes], segments: list[tuple[int, int, float]]) -> list[int]:
    """The how-manieth of its kind each segment is: 1 if no segment before has the same bare words."""
    if len(segments) < 2:
        return [1] * len(segments)
    seen: Counter = Counter()
    out = []
    for first, after, _ in segments:
        key = hashlib.blake2b(" ".join(filter(None, map(bare, words[first:after]))).encode(), digest_size=16).digest()
        seen[key] += 1
        out.append(seen[key])
    return out


class _Scanner:
    """Finds the positive words of texts, with a bounded table of the words met."""

    def __init__(self, model: Toxicity):
        self.model = model
        self._known: dict[bytes, float] = {}

    def scan(self, texts: list[bytes]) -> list[tuple[int, list[tuple[int, int, float]], list[int]]]:
        """(number of words, maximal segments, which copy of its kind each segment is) of each text."""
        split = [text.split() for text in texts]
        words = list(chain.from_iterable(split))
        values = list(map(self._known.get, words))
        if None in values:
            if len(self._known) > CACHE_WORDS:
                self._known = {}
            self._known.update((word, self.model.word_score(word)) for word in set(words) - self._known.keys())
            values = list(map(self._known.__getitem__, words))
        value = np.array(values, float)
        hits = np.flatnonzero(value > 0)
        ends = np.cumsum(np.fromiter(map(len, split), np.int64, len(split)))
        cuts = np.searchsorted(hits, ends)
        out, begin, start = [], 0, 0
        for own, cut, end in zip(split, cuts.tolist(), ends.tolist()):
            found = maximal_segments((hits[begin:cut] - start).tolist(), value[hits[begin:cut]].tolist())
            out.append((end - start, found, copies(own, found)))
            begin, start = cut, end
        return out

    def gains(self, text: bytes) -> list[float]:
        """The positive scores of a text's words, which have been scanned."""
        return [score for score in map(self._known.__getitem__, text.split()) if score > 0]


# --- fitting --------------------------------------------------------------------------------------------------------


def occurrences(text: bytes) -> Counter:
    """How often each token occurs, 1 + log2 of the number; under "" the sum over the words."""
    many: Counter = Counter()
    for word, times in Counter(text.split()).items():
        for token in tokens(word):
            many[token] += times
    damped = Counter({token: times.bit_length() for token, times in many.items()})
    damped[""] = sum(times for token, times in damped.items() if not token.endswith("-"))
    return damped


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen = (Counter(), Counter())
    for batch in batches:
        for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
            seen[label].update(occurrences(text))
    names = list(seen[0].keys() | seen[1].keys())
    if names:
        counts = [pa.array([part[name] for name in names], pa.int64()) for part in (seen[1], seen[0])]
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *counts], ["token", "toxic", "clean"])


def log_odds(counts: DataFrame) -> DataFrame:
    """token, odds, z from token, toxic, clean: log odds ratio with a Dirichlet prior, over its standard deviation."""
    total = counts.filter("token = ''").select(F.col("toxic").alias("all_toxic"), F.col("clean").alias("all_clean"))
    share = F.col("all_toxic") / (F.col("all_toxic") + F.col("all_clean"))
    y, x = F.col("toxic") + PRIOR * share, F.col("clean") + PRIOR * (1 - share)
    return (
        counts.filter("token != ''")
        .join(F.broadcast(total.filter("toxic > 0 AND clean > 0")))  # one row
        .select("token", (F.log(y / F.col("all_toxic")) - F.log(x / F.col("all_clean"))).alias("odds"), F.sqrt(1 / y + 1 / x).alias("deviation"))
        .select("token", "odds", (F.col("odds") / F.col("deviation")).alias("z"))
    )


def _statistics(model):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _Scanner(model.value)
        for batch in batches:
            for keys, texts in slices(zip(batch.column("label").to_pylist(), batch.column("text").to_pylist())):
                found = scanner.scan(texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys, pa.int32()),
                        pa.array([n for n, _, _ in found], pa.int64()),
                        pa.array([[s for _, _, s in segments] for _, segments, _ in found], pa.list_(pa.float64())),
                        pa.array([copy for _, _, copy in found], pa.list_(pa.int64())),
                        # only those of clean documents are asked for
                        pa.array([[] if key else scanner.gains(text) for key, text in zip(keys, texts)], pa.list_(pa.float64())),
                    ],
                    ["label", "words", "segments", "copies", "gains"],
                )

    return run


def extreme_values(clean: list[tuple[int, list[float], list[float]]]) -> tuple[float, float]:
    """lambda and K from clean documents (words, segment scores, word scores), with one hit more than was seen."""
    words = sum(n for n, _, _ in clean) + 1
    hits = [gain for _, _, gains in clean for gain in gains] + [4.0]
    low, high = 0.05, 1.0  # at 1 the scores are log odds as they stand
    for _ in range(60):
        scale = (low + high) / 2
        expected = math.exp(-scale * DRIFT) + sum(math.exp(scale * gain) for gain in hits) / words
        low, high = (scale, high) if expected < 1 else (low, scale)
    best = [max(segments) for _, segments, _ in clean if segments]
    return scale, min(1.0, (len(best) + 1) / (words * math.exp(-scale * min(best, default=4.0))))


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-3) -> tuple[float, float]:
    """slope, intercept of greatest likelihood, by Newton steps; the slope is not negative."""
    beta = np.zeros(2)
    design = np.stack([x, np.ones_like(x)], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        slope = design.T @ (y - p) - penalty * beta
        curve = (design * (p * (1 - p))[:, None]).T @ design + (penalty + 1e-6) * np.eye(2)
        beta = beta + np.clip(np.linalg.solve(curve, slope), -2, 2)
    return max(0.0, float(beta[0])), float(beta[1])


def calibrated(model: Toxicity, known: list[tuple[int, int, list[float], list[int], list[float]]]) -> Toxicity:
    """The model with its constants fitted on documents (label, words, segment scores, copies, word scores) that gave no counts."""
    if known:
        model.scale, model.constant = extreme_values([(n, segments, gains) for label, n, segments, _, gains in known if label == 0])
        found = [model.evidence([(0, 0, one) for one in segments], n, copy) for _, n, segments, copy, _ in known]
        model.slope, model.intercept = _logistic(np.log1p(np.array(found)), np.array([float(row[0]) for row in known]))
    return model


def certain(tokens_seen: int) -> float:
    """The z score that the greatest of so many chance tokens rarely reaches."""
    return math.sqrt(2 * math.log(max(tokens_seen, 2)))


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = FIT_DOCUMENTS, doc_id: str = "doc_id", text: str = "text") -> Toxicity:
    """Token scores from three quarters of the sample, calibration from the fourth."""
    spark = ship(tune(docs.sparkSession))
    # equal texts are one, with the smallest id and its label: the id decides what the text is used for
    texts = labelled_sample(docs, labels, label, rows, doc_id, text).groupBy("text")
    sample = durable(texts.agg(F.min("id").alias("id"), F.min_by("label", "id").alias("label")))
    counted = sample.filter(f"NOT {CALIBRATION}").mapInArrow(_count, "token string, toxic long, clean long")
    counts = durable(counted.groupBy("token").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))
    found = log_odds(counts).filter((F.col("z") >= certain(counts.count())) & (F.col("odds") >= ENRICHED))
    model = Toxicity({row.token: (row.odds, row.z) for row in found.orderBy("token").collect()})  # some of the sample's words
    if not model.scores:
        return model
    statistics = sample.filter(CALIBRATION).mapInArrow(
        _statistics(spark.sparkContext.broadcast(model)), "label int, words long, segments array<double>, copies array<long>, gains array<double>"
    )
    return calibrated(model, sorted((r.label, r.words, list(r.segments), list(r.copies), sorted(r.gains)) for r in statistics.limit(rows).collect()))


# --- scoring --------------------------------------------------------------------------------------------------------


def _passages(model):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxicity = model.value
        scanner = _Scanner(toxicity)
        for keys, texts in slices(rows_of(batches)):
            found = scanner.scan(texts)
            evidence = np.array([toxicity.evidence(segments, n, copy) for n, segments, copy in found])
            significant = []
            for n, segments, _ in found:
                chance = math.log(max(toxicity.constant * n, 1e-9))
                significant.append([{"first": a, "after": b, "evidence": toxicity.scale * s - chance} for a, b, s in segments if toxicity.scale * s > chance])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, pa.int64()),
                    pa.array(toxicity.score(np.log1p(evidence))),
                    pa.array(significant, pa.list_(pa.struct([("first", pa.int64()), ("after", pa.int64()), ("evidence", pa.float64())]))),
                ],
                ["doc_id", "score", "passages"],
            )

    return run


def toxic_passages(docs: DataFrame, model: Toxicity, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, score, and the significant passages as ranges of words (split at ASCII white space) with their evidence."""
    spark = ship(tune(docs.sparkSession))
    return utf8(docs, doc_id, text).mapInArrow(
        _passages(spark.sparkContext.broadcast(model)),
        "doc_id long, score double, passages array<struct<first: long, after: long, evidence: double>>",
    )
