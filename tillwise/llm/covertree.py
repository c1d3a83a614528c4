"""Vector codes by product quantisation, its rounds of Lloyd's algorithm run over partition-local cover trees.

Components become integers floor(256 * x); a vector is cut into parts of equal length, and each part position has a codebook
of integer entries. A round assigns every part to the nearest entry and moves each entry to the mean (rounded down) of its parts.

Each task arranges its vectors in blocks and builds one cover tree per block and part position, once for all rounds:

* *Centres* are found farthest first. One that is found at distance d belongs to the levels 2**i < d: those of a level are more
  than 2**i apart and cover all points within 2**i. The parent of a centre is the nearest centre of the level above.
* *Nodes* are a centre at a level with children; they know the number, the component sums and the largest distance of the points
  below. Points stand in tree order, so those of a node are a range. Each point hangs on its nearest centre, about ``LEAF`` on one.
* *Assignment* descends from the root, a level at a time. An entry that is farther from a node's centre than the nearest one by more
  than twice the node's radius is nearest to no point below (triangle inequality). Where one entry is left, the node's sums go to
  it whole. Otherwise its children look at what is left; only points of leaves that stay ambiguous are compared one by one, with the
  entries left. Distances are integers, so ties are exact and go to the lower index; the square roots have a margin that only lets more nodes descend.

What a round shuffles is one sum per task, part, entry and component; codebooks are of one size at any input. Blocks with
their trees are a table in the shared folder, read once a round; a lost executor costs its running tasks.

Nulls: vectors that are null or hold null or non-finite components take no part; a null id is kept, after all others, a null
label is a label. Scaled components beyond 2**22 in size are held at that bound, which keeps all sums exact (parts of up to 500 components). Vectors of
different lengths have codebooks of their own (few lengths are expected); a length that is no multiple of the number of parts is
cut as evenly as can be, longer parts first; a vector of length 0 has the code of zeros and no error. Fewer vectors than entries make a smaller codebook.
Rows of one id are ordered by their vectors. An empty table gives an empty result. Columns other than those named do not matter.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tillwise.llm.shipping import released, ship
from tillwise.session import durable, tune

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
LARGEST = 1 << 22
ROWS = 8192  # vectors of a block
LEAF = 16  # points on a centre, on average

BLOCKS = "length int, ids array<long>, labels array<string>, trees binary"
SUMS = "length int, part int, entry int, position int, total long, number long"
CODED = "length int, vec_id long, label string, code string, error long"

Codebooks = dict[int, list[np.ndarray]]  # of each vector length, one (entries, part length) array per part


def cuts(length: int, parts: int) -> list[int]:
    """Where the parts of a vector begin and end."""
    size, longer = divmod(length, parts)
    return [i * size + min(i, longer) for i in range(parts + 1)]


# --- the tree -------------------------------------------------------------------------------------------------------


def _square(x: np.ndarray) -> np.ndarray:
    return np.einsum("...i,...i->...", x, x)


def farthest_first(points: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Centres (row numbers), the squared distance at which each was found, and of each point its nearest centre and distance to it."""
    nearest = np.zeros(len(points), np.int64)
    apart = _square(points - points[0])
    centres, found = [0], [np.iinfo(np.int64).max]
    while len(centres) < most:
        far = int(np.argmax(apart))
        if not apart[far]:
            break
        centres.append(far)
        found.append(int(apart[far]))
        to_new = _square(points - points[far])
        closer = to_new < apart
        nearest[closer] = len(centres) - 1
        apart[closer] = to_new[closer]
    return np.array(centres), np.array(found), nearest, apart


class CoverTree:
    """A cover tree over integer points with cumulative sums; ``order`` lists the points so that a node's are a range."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        centres, found, nearest, apart = farthest_first(points, max(1, -(-len(points) // leaf)))
        # the highest i with 4**i < found**2; the root is in all levels
        levels = (np.ceil(np.log2(np.maximum(found.astype(np.float64), 1)) / 2) - 1).astype(np.int64)
        if len(centres) > 1:
            levels[0] = levels[1] + 1
        parent = np.zeros(len(centres), np.int64)
        for k in range(1, len(centres)):
            above = np.flatnonzero(levels[:k] > levels[k])
            parent[k] = above[np.argmin(_square(points[centres[above]] - points[centres[k]]))]
        members = np.argsort(nearest, kind="stable")
        begin = np.searchsorted(nearest[members], np.arange(len(centres) + 1))
        children: list[dict[int, list[int]]] = [{} for _ in centres]
        for k in range(1, len(centres)):
            children[parent[k]].setdefault(int(levels[k]), []).append(k)

        # depth first: a node is a centre at the level of some of its children, and, last, with its own points
        order: list[np.ndarray] = []
        nodes: list[list] = []  # centre, first point, end, children
        placed = 0

        def grow(centre: int) -> int:
            """Nodes of a centre from its lowest up; children of a level are a level of nodes further down."""
            nonlocal placed
            first = placed
            own = members[begin[centre] : begin[centre + 1]]
            order.append(own)
            placed += len(own)
            nodes.append([centre, first, placed, []])
            top = len(nodes) - 1
            for level in sorted(children[centre]):
                below = [top] + [grow(child) for child in children[centre][level]]
                nodes.append([centre, first, placed, below])
                top = len(nodes) - 1
            return top

        self.root = grow(0)
        self.order = np.concatenate(order)
        self.points = np.ascontiguousarray(points[self.order])
        self.centre = points[centres[[node[0] for node in nodes]]]
        self.first, self.end = (np.array([node[i] for node in nodes]) for i in (1, 2))
        sums = np.zeros((len(points) + 1, points.shape[1]), np.int64)
        np.cumsum(self.points, axis=0, out=sums[1:])
        self.sums = sums[self.end] - sums[self.first]
        self.number = self.end - self.first
        self.radius = np.array([np.sqrt(_square(self.points[a:b] - c).max(initial=0)) for a, b, c in zip(self.first, self.end, self.centre)])
        self.child_at = np.concatenate([[0], np.cumsum([len(node[3]) for node in nodes])])
        self.child = np.array([child for node in nodes for child in node[3]], np.int64)

    def assign(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """Sums and number of the points nearest to each entry, the entry of each point in tree order, and how many distances of points were taken."""
        sums, number = np.zeros_like(entries), np.zeros(len(entries), np.int64)
        label = np.zeros(len(self.points), np.int64)
        compared = 0
        front = np.array([self.root])
        begin, candidate = np.array([0, len(entries)]), np.arange(len(entries))  # entries that may be nearest below a node
        while len(front):
            size = np.diff(begin)
            node = np.repeat(front, size)
            square = _square(self.centre[node] - entries[candidate])
            apart = np.sqrt(square)
            least = np.minimum.reduceat(apart, begin[:-1])
            near = apart <= np.repeat(least * (1 + 1e-9) + 2 * self.radius[front] + 1e-6, size)
            left = np.add.reduceat(near.astype(np.int64), begin[:-1])
            candidate = candidate[near]
            begin = np.concatenate([[0], np.cumsum(left)])
            sure = left == 1
            whole, into = front[sure], candidate[begin[:-1][sure]]
            np.add.at(sums, into, self.sums[whole])
            np.add.at(number, into, self.number[whole])
            label[_ranges(self.first[whole], self.end[whole])] = np.repeat(into, self.number[whole])
            fan = self.child_at[front + 1] - self.child_at[front]
            leaves = np.flatnonzero(~sure & (fan == 0))
            if len(leaves):
                at = _ranges(self.first[front[leaves]], self.end[front[leaves]])
                of = np.repeat(leaves, self.number[front[leaves]])
                some = candidate[_ranges(begin[of], begin[of + 1])]
                times = left[of]
                square = _square(self.points[np.repeat(at, times)] - entries[some])
                nearest = np.minimum.reduceat(square << 8 | some, np.cumsum(times) - times) & 255
                np.add.at(sums, nearest, self.points[at])
                number += np.bincount(nearest, minlength=len(entries))
                label[at] = nearest
                compared += len(square)
            inner = np.flatnonzero(~sure & (fan > 0))
            of = np.repeat(inner, fan[inner])
            candidate = candidate[_ranges(begin[of], begin[of + 1])]
            begin = np.concatenate([[0], np.cumsum(left[of])])
            front = self.child[_ranges(self.child_at[front[inner]], self.child_at[front[inner] + 1])]
        return sums, number, label, compared


def _ranges(first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """first[i] .. end[i] - 1 for all i, one after the other."""
    size = end - first
    stops = np.cumsum(size)
    return np.repeat(first - (stops - size), size) + np.arange(stops[-1] if len(stops) else 0)


# --- over the table -------------------------------------------------------------------------------------------------


def usable(vectors: DataFrame, vec_id: str, embedding: str, label: str) -> DataFrame:
    """vec_id, label (as text), length and integer components of the vectors that take part."""
    vector = F.col(f"`{embedding}`").cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    scaled = F.transform(vector, lambda x: F.greatest(F.least(F.floor(x * SCALE), F.lit(LARGEST)), F.lit(-LARGEST)).cast("int"))
    return vectors.filter(vector.isNotNull() & finite).select(
        F.col(f"`{vec_id}`").cast("long").alias("vec_id"),
        F.col(f"`{label}`").cast("string").alias("label"),
        F.size(vector).alias("length"),
        scaled.alias("vector"),
    )


def _blocks(parts: int, rows: int, leaf: int):
    def made(held: list[pa.RecordBatch], length: int) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        vectors = table.column("vector").combine_chunks()
        flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(vectors), length)
        edges = cuts(length, parts)
        trees = pickle.dumps([_packed(CoverTree(flat[:, a:b], leaf)) for a, b in zip(edges, edges[1:])], protocol=5)
        lists = [pa.array([table.column(name).to_pylist()], kind) for name, kind in (("vec_id", pa.list_(pa.int64())), ("label", pa.list_(pa.string())))]
        return pa.RecordBatch.from_arrays([pa.array([length], pa.int32()), *lists, pa.array([trees], pa.binary())], ["length", "ids", "labels", "trees"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[pa.RecordBatch]] = {}
        for batch in batches:
            lengths = batch.column("length").to_numpy()
            for length in np.unique(lengths).tolist():
                some = batch.filter(pa.array(lengths == length))
                waiting = held.setdefault(length, [])
                while some.num_rows:
                    room = rows - sum(part.num_rows for part in waiting)
                    waiting.append(some.slice(0, room))
                    some = some.slice(min(room, some.num_rows))
                    if sum(part.num_rows for part in waiting) == rows:
                        yield made(waiting, length)
                        waiting.clear()
        for length, waiting in held.items():
            if waiting:
                yield made(waiting, length)

    return run


def _packed(tree: CoverTree) -> CoverTree:
    """The tree with its numbers in as few bytes as they take; they become 64 bits again in ``_unpacked``."""
    for name in ("order", "points", "centre", "first", "end", "child_at", "child"):
        setattr(tree, name, getattr(tree, name).astype(np.int32))
    return tree


def _unpacked(data: bytes) -> list[CoverTree]:
    trees = pickle.loads(data)  # written by _blocks
    for tree in trees:
        for name in ("points", "centre", "first", "end", "child_at", "child"):
            setattr(tree, name, getattr(tree, name).astype(np.int64))
    return trees


def _summed(codebooks):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books: Codebooks = codebooks.value
        totals = {length: [(np.zeros_like(book), np.zeros(len(book), np.int64)) for book in parts] for length, parts in books.items()}
        seen = set()
        for batch in batches:
            for length, data in zip(batch.column("length").to_pylist(), batch.column("trees")):
                seen.add(length)
                for tree, book, (total, number) in zip(_unpacked(data.as_py()), books[length], totals[length]):
                    sums, count, *_ = tree.assign(book)
                    total += sums
                    number += count
        for length in sorted(seen):
            for part, (total, number) in enumerate(totals[length]):
                entry, position = (x.ravel() for x in np.indices(total.shape))
                columns = [np.full(total.size, length), np.full(total.size, part), entry, position]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column.astype(np.int32)) for column in columns] + [pa.array(total.ravel()), pa.array(np.repeat(number, total.shape[1]))],
                    ["length", "part", "entry", "position", "total", "number"],
                )

    return run


def _coded(codebooks):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, ids, labels, data in zip(*(batch.column(name) for name in ("length", "ids", "labels", "trees"))):
                books = codebooks.value[length.as_py()]
                trees = _unpacked(data.as_py())
                codes = np.zeros((len(ids), len(trees)), np.uint8)
                errors = np.zeros(len(ids), np.int64)
                for part, (tree, book) in enumerate(zip(trees, books)):
                    *_, label, _ = tree.assign(book)
                    codes[tree.order, part] = label
                    errors[tree.order] += _square(tree.points - book[label])
                text = codes.tobytes().hex()
                width = 2 * codes.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(ids), length.as_py(), np.int32)),
                        ids.values,
                        labels.values,
                        pa.array([text[i : i + width] for i in range(0, len(text), width)], pa.string()),
                        pa.array(errors),
                    ],
                    ["length", "vec_id", "label", "code", "error"],
                )

    return run


def codebooks_digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(x) for book in books for x in book.ravel().tolist()).encode()).hexdigest()


def moved(books: Codebooks, sums: DataFrame) -> Codebooks:
    """The codebooks with every entry at the mean of its parts, rounded down; entries without parts stay."""
    out = {length: [book.copy() for book in parts] for length, parts in books.items()}
    total = sums.groupBy("length", "part", "entry", "position").agg(F.sum("total").alias("total"), F.sum("number").alias("number"))
    for row in total.filter("number > 0").toLocalIterator():  # as many rows as the codebooks have numbers
        out[row.length][row.part][row.entry, row.position] = row.total // row.number
    return out


def vector_codes(
    vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, rows: int = ROWS, leaf: int = LEAF,
) -> tuple[DataFrame, Codebooks]:
    """(length, vec_id, label, code, error of every vector that takes part; the final codebooks).

    ``code`` has two hex digits per part (so ``entries`` may be 256 at most), ``error`` is the squared distance to the entries.
    """
    if entries > 256:
        raise ValueError("a code has one byte per part")
    spark = ship(tune(vectors.sparkSession))
    clean = usable(vectors, vec_id, embedding, label)
    first = Window.partitionBy("length").orderBy(F.col("vec_id").asc_nulls_last(), "vector")
    start = clean.select("length", "vector", F.row_number().over(first).alias("rank")).filter(F.col("rank") <= entries)
    taken: dict[int, list] = {}
    for row in start.orderBy("length", "rank").collect():  # ``entries`` vectors of each length
        taken.setdefault(row.length, []).append(row.vector)
    books: Codebooks = {}
    for length, some in taken.items():
        edges, start_rows = cuts(length, parts), np.array(some, np.int64).reshape(len(some), length)
        books[length] = [start_rows[:, a:b].copy() for a, b in zip(edges, edges[1:])]
    blocks = durable(clean.mapInArrow(released(_blocks(parts, rows, leaf)), BLOCKS))
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(books)
        books = moved(books, blocks.mapInArrow(released(_summed(shared)), SUMS))
        shared.unpersist()
    return durable(blocks.mapInArrow(released(_coded(spark.sparkContext.broadcast(books))), CODED)), books


def with_label_errors(coded: DataFrame) -> DataFrame:
    """``coded`` with label_error, the error summed over the rows of equal labels; summed per task first, joined back as one row per label."""
    per_label = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of")
    return coded.join(per_label, F.col("label").eqNullSafe(F.col("of"))).drop("of")
