"""Nearest neighbours by low-dimensional stable projections in a kd-tree, verified until a chi-square test stops the search.

Largest inner products become smallest distances when every vector x gets one more component sqrt(M^2 - |x|^2), M the largest norm.
Each vector is projected onto ``DIMENSIONS`` Gaussian directions; for two points at distance d the squared projected
distance is d^2 times a chi-square variable. A block of vectors is a kd-tree over projections. For a query its leaves are
visited in the order of their projected distance; a vector is verified, in double precision, unless it is so far in projection
that one as near as the k-th best found is projected that far only with probability 1 - ``CERTAINTY``. The search ends where
this holds for a whole leaf. On vectors without structure (the test data) distances hardly differ and this stops late.

The same holds between blocks. A sample of at most ``SAMPLE_ROWS`` projected vectors of a length gives the planes of an upper kd-tree with
``BOXES`` regions at most; every vector goes to the block of its region, a block of more than ``ROWS`` vectors is dealt to parts by the
hash of the id, and each part's tree is built once and stored. The boxes of the blocks are known to all tasks (a bounded table). A query goes
to its nearest box first, then to the next two, the next four and so on, as long as the chi-square test, with the best found so far, does
not rule the next box out. So the vectors are shuffled once, and a query is sent only to where it may find something. Copies of
a vector have one projection and so one block; in a part they are one point with its smallest ids, cost nothing and tie by id.

Vectors that are null, zero, or hold null or non-finite components take no part; nor do null ids. Only vectors of one length
are compared. Rows of one id are each other's own row and never each other's neighbour. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.column import Column

from tillwise.llm.shipping import ship
from tillwise.session import durable, tune

DIMENSIONS = 12
CERTAINTY = 0.97
LEAF = 256
ROWS = 8192  # vectors of a part of a block
QUERIES = 4096  # queries that are asked of a part at once
SAMPLE_ROWS = 1 << 16  # vectors of a length that the planes between blocks are fitted on
BOXES = 1 << 12  # blocks of vectors of a length, at most
SEED = 20

FOUND = "query_id long, vec_id long, score double"


def chi_square_quantile(p: float, k: int) -> float:
    """The value that a chi-square variable of ``k`` degrees of freedom stays below with probability ``p``."""

    def below(x: float) -> float:
        a, x = k / 2, x / 2
        term = total = 1 / a
        n = a
        while term > total * 1e-15:
            n += 1
            term *= x / n
            total += term
        return total * math.exp(-x + a * math.log(x) - math.lgamma(a)) if x > 0 else 0.0

    low, high = 0.0, 10.0 * k + 100
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) < p else (low, middle)
    return high


def directions(length: int) -> np.ndarray:
    """The fixed Gaussian directions for vectors of a length and their added component."""
    return np.random.default_rng([SEED, length]).standard_normal((length + 1, DIMENSIONS))


def leaves(points: np.ndarray, size: int = LEAF) -> list[np.ndarray]:
    """The leaves of a kd-tree: row numbers, split at the median of the widest dimension."""
    out, waiting = [], [np.arange(len(points))]
    while waiting:
        rows = waiting.pop()
        if len(rows) <= size:
            out.append(rows)
            continue
        inside = points[rows]
        axis = int(np.argmax(inside.max(0) - inside.min(0)))
        order = np.argpartition(inside[:, axis], len(rows) // 2)
        waiting += [rows[order[: len(rows) // 2]], rows[order[len(rows) // 2 :]]]
    return out


class Block:
    """The distinct vectors of a block with the smallest ids of each, in a kd-tree over their projections."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, largest: float, keep: int):
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], np.ascontiguousarray(vectors[order], np.float64)
        # byte-wise equal rows; -0.0 becomes 0.0
        keys = (vectors + 0.0).view(np.dtype((np.void, vectors.dtype.itemsize * vectors.shape[1]))).ravel()
        _, first, copy = np.unique(keys, return_index=True, return_inverse=True)
        self.vectors = vectors[first]
        by_copy = np.argsort(copy, kind="stable")
        begin = np.searchsorted(copy[by_copy], np.arange(len(first)))
        number = np.minimum(np.diff(np.append(begin, len(ids))), keep)
        self.ids, self.begin, self.number = ids[by_copy], begin, number
        added = np.sqrt(np.maximum(largest**2 - (self.vectors**2).sum(1), 0))
        self.directions = directions(vectors.shape[1])
        self.points = np.column_stack([self.vectors, added]) @ self.directions
        self.leaves = leaves(self.points)
        self.low = np.array([self.points[rows].min(0) for rows in self.leaves])
        self.high = np.array([self.points[rows].max(0) for rows in self.leaves])
        self.largest = largest

    def search(
        self, queries: np.ndarray, k: int, certainty: float = CERTAINTY, floor: np.ndarray | None = None
    ) -> tuple[np.ndarray, np.ndarray, int]:
        """(rows, inner products) of the ``k`` best distinct vectors found for each query, -1 where there are fewer; and how
        many vectors were verified. ``floor``: inner products that are known to be reached elsewhere."""
        floor = np.full(len(queries), -np.inf) if floor is None else floor
        quantile = chi_square_quantile(certainty, DIMENSIONS)
        projected = queries @ self.directions[:-1]
        n = len(queries)
        gap = np.zeros((n, len(self.leaves)))
        for axis in range(DIMENSIONS):
            x = projected[:, axis : axis + 1]
            gap += np.maximum(np.maximum(self.low[:, axis] - x, x - self.high[:, axis]), 0) ** 2
        order = np.argsort(gap, axis=1)
        norms = (queries**2).sum(1) + self.largest**2  # squared distance = norms - 2 * inner product
        best = np.full((n, k), -np.inf)
        rows = np.full((n, k), -1)
        point_norms, query_norms = (self.points**2).sum(1), (projected**2).sum(1)
        active, verified = np.arange(n), 0
        for turn in range(len(self.leaves)):
            leaf = order[active, turn]
            reach = quantile * np.maximum(norms[active] - 2 * np.maximum(best[active, -1], floor[active]), 0)
            go = gap[active, leaf] <= np.where(np.isfinite(reach), reach, np.inf)
            active, leaf, reach = active[go], leaf[go], np.where(np.isfinite(reach), reach, np.inf)[go]
            if not len(active):
                break
            by_leaf = np.argsort(leaf, kind="stable")
            cuts = np.flatnonzero(np.diff(leaf[by_leaf], prepend=-1))
            score = np.full((len(active), LEAF), -np.inf)
            place = np.full((len(active), LEAF), -1)
            for group in np.split(by_leaf, cuts[1:]):
                members = self.leaves[leaf[group[0]]]
                asked = active[group]
                far = query_norms[asked, None] + point_norms[members] - 2 * (projected[asked] @ self.points[members].T)
                near = far <= reach[group, None]
                score[group, : len(members)] = np.where(near, queries[asked] @ self.vectors[members].T, -np.inf)
                place[group, : len(members)] = np.where(near, members, -1)
                verified += int(near.sum())
            score = np.concatenate([best[active], score], 1)
            place = np.concatenate([rows[active], place], 1)
            top = np.argpartition(-score, k - 1, axis=1)[:, :k]
            top = np.take_along_axis(top, np.argsort(-np.take_along_axis(score, top, 1), axis=1, kind="stable"), 1)
            best[active] = np.take_along_axis(score, top, 1)
            rows[active] = np.take_along_axis(place, top, 1)
        return rows, best, verified

    def neighbours(self, query_ids: np.ndarray, queries: np.ndarray, k: int, floor: np.ndarray | None = None) -> pd.DataFrame:
        """query_id, vec_id, score of the best ``k`` rows of the block for each query, the query's own left out."""
        rows, _, _ = self.search(queries, k + 1, floor=floor)
        query, column = np.nonzero(rows >= 0)
        row = rows[query, column]
        # summed the same way for every pair, so that copies in different blocks tie
        score = (queries[query] * self.vectors[row]).sum(1)
        times = self.number[row]
        at = np.repeat(self.begin[row] - (np.cumsum(times) - times), times) + np.arange(times.sum())
        out = pd.DataFrame({"query_id": np.repeat(query_ids[query], times), "vec_id": self.ids[at], "score": np.repeat(score, times)})
        out = out[out.query_id != out.vec_id].drop_duplicates().sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True])
        return out.groupby("query_id").head(k)


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """id, vector (doubles), norm, length of the vectors that take part."""
    vector = F.col("vector")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    norm = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda total, x: total + x * x))
    return (
        vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(embedding).cast("array<double>").alias("vector"))
        .filter(F.col("id").isNotNull() & vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0))
        .withColumns({"norm": norm, "length": F.size(vector)})
    )


# --- blocks ---------------------------------------------------------------------------------------------------------


@dataclass
class Planes:
    """The upper kd-tree of vectors of one length: a full binary tree of planes, the root first."""

    largest: float
    axis: np.ndarray
    cut: np.ndarray
    levels: int

    @staticmethod
    def fitted(points: np.ndarray, blocks: int, largest: float) -> Planes:
        levels = max(0, math.ceil(math.log2(max(blocks, 1))))
        axis, cut = np.zeros(1 << levels, np.int64), np.zeros(1 << levels)
        held = {1: np.arange(len(points))}
        for node in range(1, 1 << levels):
            rows = held.pop(node)
            inside = points[rows]
            if len(rows):
                axis[node] = np.argmax(inside.max(0) - inside.min(0))
                cut[node] = np.median(inside[:, axis[node]])
            right = inside[:, axis[node]] > cut[node] if len(rows) else np.zeros(0, bool)
            held[2 * node], held[2 * node + 1] = rows[~right], rows[right]
        return Planes(largest, axis, cut, levels)

    def block(self, points: np.ndarray) -> np.ndarray:
        node = np.ones(len(points), np.int64)
        for _ in range(self.levels):
            node = 2 * node + (points[np.arange(len(points)), self.axis[node]] > self.cut[node])
        return node - (1 << self.levels)


def projected(vectors: np.ndarray, largest: float) -> np.ndarray:
    """Projections of vectors of one length with their added component."""
    added = np.sqrt(np.maximum(largest**2 - (vectors**2).sum(1), 0))
    return np.column_stack([vectors, added]) @ directions(vectors.shape[1])


def _matrix(column: pa.Array, length: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), length)


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    lengths = batch.column("length").to_numpy()
    for length in np.unique(lengths).tolist():
        yield length, batch.filter(pa.array(lengths == length))


def _sampled(largest: dict[int, float]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, some in _by_length(batch):
                points = projected(_matrix(some.column("vector"), length), largest[length])
                yield pa.RecordBatch.from_arrays([some.column("length"), pa.array(points.tolist(), pa.list_(pa.float64()))], ["length", "point"])

    return run


def _placed(planes, carry: list[str]):
    """The block of each vector, and the columns ``carry``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, some in _by_length(batch):
                plane = planes.value[length]
                block = plane.block(projected(_matrix(some.column("vector"), length), plane.largest))
                yield pa.RecordBatch.from_arrays([some.column("length"), pa.array(block.astype(np.int32)), *map(some.column, carry)], ["length", "block", *carry])

    return run


def _built(planes, keep: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        block = Block(rows["id"].to_numpy(), np.stack(rows["vector"].to_numpy()), planes.value[key[0]].largest, keep)
        low, high = block.points.min(0), block.points.max(0)
        return pd.DataFrame({"length": [key[0]], "block": [key[1]], "part": [key[2]], "low": [low], "high": [high], "data": [pickle.dumps(block, protocol=5)]})

    return run


BLOCKS = "length int, block int, part int, low array<double>, high array<double>, data binary"


@dataclass
class Index:
    """The stored parts of all blocks, and per length the boxes (block numbers, low, high corners)."""

    parts: DataFrame
    largest: dict[int, float]
    boxes: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]

    @staticmethod
    def of(clean: DataFrame, keep: int) -> Index:
        """An index of ``usable`` vectors, all of them."""
        spark = clean.sparkSession
        seen = {r.length: (r.largest, r.rows) for r in clean.groupBy("length").agg(F.max("norm").alias("largest"), F.count("*").alias("rows")).collect()}
        largest = {length: big for length, (big, _) in seen.items()}
        every = max([1, *(math.ceil(rows / SAMPLE_ROWS) for _, rows in seen.values())])
        sample = clean.filter(F.pmod(F.xxhash64("id", F.lit(3)), F.lit(every)) == 0).mapInArrow(_sampled(largest), "length int, point array<double>")
        points: dict[int, list] = {}
        for row in sample.limit(2 * SAMPLE_ROWS * max(1, len(seen))).collect():
            points.setdefault(row.length, []).append(row.point)
        planes = {
            length: Planes.fitted(np.array(points.get(length, np.zeros((0, DIMENSIONS)))), min(BOXES, math.ceil(rows / ROWS)), big)
            for length, (big, rows) in seen.items()
        }
        shared = spark.sparkContext.broadcast(planes)
        counts = clean.mapInArrow(_placed(shared, []), "length int, block int").groupBy("length", "block").agg(F.ceil(F.count("*") / ROWS).cast("int").alias("n_parts"))
        # one row a block: BOXES at most
        placed = clean.mapInArrow(_placed(shared, ["id", "vector"]), "length int, block int, id long, vector array<double>").join(F.broadcast(counts), ["length", "block"])
        placed = placed.withColumn("part", F.pmod(F.xxhash64("id", F.lit(1)), F.col("n_parts")).cast("int"))
        parts = durable(placed.groupBy("length", "block", "part").applyInPandas(_built(shared, keep), BLOCKS))
        corners = [F.min(F.col("low")[i]).alias(f"low{i}") for i in range(DIMENSIONS)] + [F.max(F.col("high")[i]).alias(f"high{i}") for i in range(DIMENSIONS)]
        boxes: dict[int, list] = {}
        for row in parts.groupBy("length", "block").agg(*corners).collect():
            boxes.setdefault(row.length, []).append(tuple(row)[1:])
        out = {}
        for length, rows in boxes.items():
            table = np.array(sorted(rows))
            out[length] = table[:, 0].astype(np.int64), table[:, 1 : 1 + DIMENSIONS], table[:, 1 + DIMENSIONS :]
        return Index(parts, largest, out)


# --- search ---------------------------------------------------------------------------------------------------------


def _routed(index, first: int, after: int):
    """For each query the blocks that are ``first`` to ``after`` - 1 in the order of their projected distance, if the test does not end before."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        largest, boxes = index.value
        quantile = chi_square_quantile(CERTAINTY, DIMENSIONS)
        for batch in batches:
            for length, some in _by_length(batch):
                numbers, low, high = boxes[length]
                vectors = _matrix(some.column("vector"), length)
                points = vectors @ directions(length)[:-1]
                gap = np.zeros((len(points), len(numbers)))
                for axis in range(DIMENSIONS):
                    x = points[:, axis : axis + 1]
                    gap += np.maximum(np.maximum(low[:, axis] - x, x - high[:, axis]), 0) ** 2
                order = np.argsort(gap, axis=1, kind="stable")[:, first:after]
                floor = some.column("floor").to_numpy(zero_copy_only=False)
                reach = quantile * np.maximum((vectors**2).sum(1) + largest[length] ** 2 - 2 * floor, 0)
                query, column = np.nonzero(np.take_along_axis(gap, order, 1) <= reach[:, None])
                taken = some.take(pa.array(query))
                yield pa.RecordBatch.from_arrays(
                    [taken.column("length"), pa.array(numbers[order[query, column]].astype(np.int32)), *map(taken.column, ("id", "vector", "floor"))],
                    ["length", "block", "query_id", "query", "floor"],
                )

    return run


ROUTED = "length int, block int, query_id long, query array<double>, floor double"


def _search(k: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    def run(part: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(part) or not len(queries):
            return pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})
        block = pickle.loads(part["data"].iloc[0])  # written by _built
        return block.neighbours(queries["query_id"].to_numpy(), np.stack(queries["query"].to_numpy()).astype(np.float64), k, queries["floor"].to_numpy())

    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each row that ``is_query`` (on column ``id``), its ``k`` largest inner products found.

    Of rows that share a query's id the one with the least vector is asked for.
    """
    spark = ship(tune(vectors.sparkSession))
    clean = usable(vectors, vec_id, embedding)
    index = Index.of(clean, k + 1)
    asked = clean.filter(is_query).groupBy("id").agg(F.min(F.struct("length", "vector")).alias("row")).select("id", "row.length", "row.vector")
    shared = spark.sparkContext.broadcast((index.largest, index.boxes))
    found = durable(spark.createDataFrame([], f"{FOUND}, rank int"))
    first, after = 0, 1
    most = max([0, *(len(numbers) for numbers, *_ in index.boxes.values())])
    while first < most:
        # the k-th best so far, where there are as many
        floors = found.filter(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("floor"))
        floored = asked.join(floors, "id", "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))
        routed = durable(floored.mapInArrow(_routed(shared, first, after), ROUTED))
        turns = routed.groupBy("length", "block").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("turns"))  # one row a block
        if turns.isEmpty():
            break
        parts = index.parts.select("length", "block", "part", "data").join(F.broadcast(turns), ["length", "block"])
        parts = parts.withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("turns") - 1))).drop("turns")
        sent = index.parts.select("length", "block", "part").join(F.broadcast(turns), ["length", "block"])
        sent = routed.join(sent, ["length", "block"]).withColumn("turn", F.pmod(F.xxhash64("query_id"), F.col("turns")).cast("int"))
        keys = ("length", "block", "part", "turn")
        q_keys = [f"q_{key}" for key in keys]
        sent = sent.select(*[F.col(key).alias(q_key) for key, q_key in zip(keys, q_keys)], "query_id", "query", "floor")
        pairs = parts.groupBy(*keys).cogroup(sent.groupBy(*q_keys))
        found = durable(_best(found.drop("rank").unionByName(pairs.applyInPandas(_search(k), FOUND)), k))
        first, after = after, 2 * after + 1
    return found.select("query_id", "rank", "vec_id", "score")
