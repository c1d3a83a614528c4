"""Jaccard join of documents on word n-grams: a grouped prefix join, up to the classes of linked documents.

A document is the set of its distinct n-word shingles (64-bit hashes, words with A-Z in lower case); two documents link
when 100 * |intersection| >= percent * |union|.

1. *Order.* Shingles are ordered by how common they are, then by hash. The commonness comes from counts of all shingles of
   all documents in a table of fixed size, where only shingles far above the table's mean stand out. Any order gives the
   same links; this one keeps common passages out of the prefixes.
2. *Groups.* In that order, two documents that link share a shingle among the first n - ceil(percent / 100 * n) + 1 of each.
   Documents with the same prefix and size form a group (exact copies, first of all); one posting is made per group
   and prefix shingle.
3. *Stars.* Every posting is paired with the head of its list, the group with the fewest uncommon shingles, so a list gives
   pairs in proportion to its length. Surviving pairs are expanded to members and verified on the whole sets.
4. *The rest.* What the links so far connect needs no further look. Pairs of groups that share a prefix shingle and are not
   yet in one component are all formed, and verified. So each pair of documents either is verified or was found connected,
   and a cluster of near copies never emits all its pairs.

Pairs must pass the size filter, the position filter and an upper bound of the overlap (sums of the smaller counts in 128
buckets) before whole sets are fetched.

Nulls: a null or empty text has no shingles and links with nothing; a row with a null id links as any other, but its id stays
null and never becomes a component's id. Repeated rows are copies of each other. An empty table gives an empty result. 64-bit hashes name shingles and sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tillwise.llm.components import components, joined_components
from tillwise.llm.shipping import in_few_parts, let_go, released, ship, utf8
from tillwise.llm.wordids import rows_of
from tillwise.llm.words import Words, mixed, shingles, slices
from tillwise.operators.joins import heavy_keys, measured, split_join
from tillwise.session import durable, tune

SLOTS = 1 << 22  # of the table of shingle counts, for up to 1,024 scan tasks; 16 times as many at most
CHUNK = 1 << 16
BUCKETS = 128
RUN = 1 << 16  # postings of one list that go to one task
FAN = 1 << 10  # pairs of one class, or rows of one list's head, that go to one task
NEEDED_BITS = 1 << 24  # of the table of wanted documents, grown alike

POSTED = "doc_id long, cid long, gid long, n int, light int, overlap binary, tokens array<long>, salts array<int>"


@dataclass(frozen=True)
class Similarity:
    words: int = 5
    percent: int = 80


def _runs(total: int, counts: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Indices first[i], first[i] + 1, ... of ``counts[i]`` elements each."""
    return np.repeat(first - (np.cumsum(counts) - counts), counts) + np.arange(total)


def grown(size: int, tasks: int) -> int:
    """A table size for the number of scan tasks: twice the size for twice the tasks beyond 1,024, up to 16 times."""
    return size << min(4, max(0, (tasks - 1) // 1024).bit_length())


# --- 1. how common a shingle is -------------------------------------------------------------------------------------


def _count_slots(size: int, slots: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, waiting = np.zeros(slots, np.int32), [np.zeros(0, np.int64)]
        for _, texts in slices(rows_of(batches)):
            _, values = shingles(Words.of(texts), size)
            waiting.append((values & np.uint64(slots - 1)).astype(np.int64))
            if sum(map(len, waiting)) > SLOTS // 2:
                np.add.at(counts, np.concatenate(waiting), 1)
                waiting = waiting[:1]
        np.add.at(counts, np.concatenate(waiting), 1)
        kept = np.minimum(counts, 255).astype(np.uint8)
        task = TaskContext.get().partitionId()
        for chunk in range(slots // CHUNK):
            part = kept[chunk * CHUNK : (chunk + 1) * CHUNK]
            if part.any():
                # the few that a byte does not hold: their place and what is above it
                high = np.flatnonzero(counts[chunk * CHUNK : (chunk + 1) * CHUNK] > 255)
                above = np.stack([high, counts[chunk * CHUNK + high] - 255], 1).astype("<u4")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk], pa.int32()), pa.array([task], pa.int32()), pa.array([part.tobytes()], pa.binary()), pa.array([above.tobytes()], pa.binary())],
                    ["chunk", "task", "counts", "above"],
                )

    return run


def _add_up(kind: str):
    def run(table: pa.Table) -> pa.Table:
        total = np.zeros(CHUNK, np.uint64)
        for part in table.column("counts"):
            total += np.frombuffer(part.as_buffer(), kind)
        for part in table.column("above") if "above" in table.column_names else ():
            above = np.frombuffer(part.as_buffer(), "<u4").reshape(-1, 2)
            total[above[:, 0]] += above[:, 1]
        total = np.minimum(total, (1 << 32) - 1).astype("<u4")
        return pa.table({"chunk": table.column("chunk")[:1], "counts": pa.array([total.tobytes()], pa.binary())})

    return run


def slot_counts(texts: DataFrame, size: int) -> np.ndarray:
    """Of every slot, in how many documents its shingles are: a table of bounded size at any input.

    Tasks' tables are added in two steps, each over about the root of the number of tasks.
    """
    tasks = texts.rdd.getNumPartitions()
    slots, width = grown(SLOTS, tasks), max(1, math.isqrt(tasks))
    made = texts.mapInArrow(released(_count_slots(size, slots)), "chunk int, task int, counts binary, above binary")
    once = made.groupBy("chunk", F.pmod("task", F.lit(width))).applyInArrow(_add_up("<u1"), "chunk int, counts binary")
    twice = once.groupBy("chunk").applyInArrow(_add_up("<u4"), "chunk int, counts binary")
    out = np.zeros(slots, np.uint32)
    for row in in_few_parts(twice, 4 * slots // SLOTS).toLocalIterator():
        out[row.chunk * CHUNK : (row.chunk + 1) * CHUNK] = np.frombuffer(row.counts, np.uint32)
    return out


def _common(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every slot its class of commonness (0: nothing stands out); the slots whose lists are spread over tasks, and over how many.

    What is above the mean is one shingle's, so that, and not the slot's whole count, decides on the spread.
    """
    average = float(counts.mean(dtype=np.float64))
    mean = max(1.0, average)
    limit = mean + 8 * math.sqrt(mean) + 4  # beyond what chance puts into a slot
    level = np.zeros(len(counts), np.uint8)
    hot, tasks = [], []
    for at in range(0, len(counts), CHUNK):
        part = counts[at : at + CHUNK]
        high = np.flatnonzero(part > limit)
        level[at + high] = np.log2(part[high] / mean).astype(np.uint8)
        spread = np.minimum(1 + np.rint(part[high] - average).astype(np.int64) // RUN, 65535)
        hot.append(at + high[spread > 1])
        tasks.append(spread[spread > 1])
    return level, np.concatenate(hot), np.concatenate(tasks)


# --- 2. prefixes, groups, postings ----------------------------------------------------------------------------------


def _summed(x: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, x.dtype), np.cumsum(x, dtype=x.dtype)])
    return total[ends] - total[begins]


def _class_ids(value: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """A number for each set of shingles, whatever their order."""
    n = np.diff(cuts).astype(np.uint64)
    return mixed(_summed(mixed(value ^ np.uint64(0x1B873593)), cuts[:-1], cuts[1:]) * np.uint64(31) + n).view(np.int64)


def _post(like: Similarity, common):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level, hot, tasks = common.value
        for keys, texts in slices(rows_of(batches)):
            text, value = shingles(Words.of(texts), like.words)
            slot = (value & np.uint64(len(level) - 1)).astype(np.int64)
            heat = level[slot].astype(np.int64)
            order = np.argsort(text * 256 + heat, kind="stable")  # by text and value before
            value, heat, slot = value[order], heat[order], slot[order]
            cuts = np.searchsorted(text, np.arange(len(texts) + 1))
            n = np.diff(cuts)
            prefix = np.where(n > 0, n - (n * like.percent + 99) // 100 + 1, 0)
            head = _runs(prefix.sum(), prefix, cuts[:-1])
            tokens = value[head]
            salts = np.ones(len(head), np.int32)
            if len(hot):
                at = np.minimum(np.searchsorted(hot, slot[head]), len(hot) - 1)
                salts = np.where(hot[at] == slot[head], tasks[at], 1).astype(np.int32)
            stops = np.cumsum(prefix)
            gid = mixed(_summed(mixed(tokens ^ np.uint64(0x5BD1E995)), stops - prefix, stops) * np.uint64(31) + n.astype(np.uint64))
            light = _summed((heat == 0).astype(np.int64), cuts[:-1], cuts[1:])
            bucket = text * BUCKETS + (value >> np.uint64(40)).astype(np.int64) % BUCKETS
            overlap = np.minimum(np.bincount(bucket, minlength=len(texts) * BUCKETS), 255).astype(np.uint8).tobytes()
            ends = pa.array(np.concatenate([[0], stops]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, pa.int64()),
                    pa.array(_class_ids(value, cuts), mask=n == 0),
                    pa.array(gid.view(np.int64), mask=n == 0),
                    pa.array(n, pa.int32()),
                    pa.array(light, pa.int32()),
                    pa.array([overlap[i * BUCKETS : (i + 1) * BUCKETS] for i in range(len(texts))], pa.binary()),
                    pa.ListArray.from_arrays(ends, pa.array(tokens.view(np.int64))),
                    pa.ListArray.from_arrays(ends, pa.array(salts)),
                ],
                ["doc_id", "cid", "gid", "n", "light", "overlap", "tokens", "salts"],
            )

    return run


def _with_heads(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Postings sorted by list and head first: each with its list's head, without lists of one group.

    Only the head of the list that a batch ends in is carried on, whatever the length of the list. A list that is spread over
    several tasks may have a single posting here and keeps it.
    """
    names = ["token", "salt", "spread", "light", "gid", "n", "pos"]
    carried: dict[str, np.ndarray] | None = None  # the last row, if nothing of its list went out yet
    head: tuple | None = None  # of the list that the last batch ended in
    for batch in batches:
        col = {name: batch.column(name).to_numpy() for name in names}
        if carried is not None:
            col = {name: np.concatenate([carried[name], col[name]]) for name in names}
        rows = len(col["token"])
        if not rows:
            continue
        new = np.ones(rows, bool)
        new[1:] = (col["token"][1:] != col["token"][:-1]) | (col["salt"][1:] != col["salt"][:-1])
        goes_on = carried is None and head is not None and (head[0], head[1]) == (col["token"][0], col["salt"][0])
        repeated = np.zeros(rows, bool)
        repeated[1:] = ~new[1:] & (col["gid"][1:] == col["gid"][:-1])
        begin = np.flatnonzero(new)
        length = np.diff(np.append(begin, rows))
        run = np.cumsum(new) - 1
        heads = {name: col[name][begin] for name in ("gid", "n", "pos")}
        if goes_on:
            heads["gid"][0], heads["n"][0], heads["pos"][0] = head[2:]
        out = (length > 1)[run] | (col["spread"] > 1)
        if goes_on:
            out[: length[0]] = True
        last_waits = not out[-1]
        carried = {name: col[name][-1:] for name in names} if last_waits else None
        head = (col["token"][-1], col["salt"][-1], heads["gid"][-1], heads["n"][-1], heads["pos"][-1])
        out &= ~repeated
        if out.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(col[name][out]) for name in ("token", "gid", "n", "pos", "light", "spread")]
                + [pa.array(heads[name][run][out]) for name in ("gid", "n", "pos")],
                ["token", "gid", "n", "pos", "light", "spread", "head", "head_n", "head_pos"],
            )


LISTED = "token long, gid long, n int, pos int, light int, spread int, head long, head_n int, head_pos int"


def _may_link(percent: int, n1: str, pos1: str, n2: str, pos2: str):
    """Size and position filter: what two sets have in common from this shingle on is enough."""
    return F.expr(
        f"least({n1}, {n2}) * 100 >= greatest({n1}, {n2}) * {percent} AND "
        f"least({n1} - {pos1}, {n2} - {pos2}) * {100 + percent} >= ({n1} + {n2}) * {percent}"
    )


def _ordered_pairs(pairs: DataFrame, x: str, y: str) -> DataFrame:
    return pairs.select(F.least(x, y).alias("x"), F.greatest(x, y).alias("y")).filter("x != y").distinct()


# --- verification ---------------------------------------------------------------------------------------------------


def _bounded(percent: int):
    """Pairs whose overlap can be large enough, judged by their counts in buckets; a full counter bounds nothing."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (
                np.frombuffer(b"".join(batch.column(name).to_pylist()), np.uint8).reshape(-1, BUCKETS) for name in ("overlap_x", "overlap_y")
            )
            n = batch.column("n_x").to_numpy().astype(np.int64) + batch.column("n_y").to_numpy()
            least = np.minimum(a, b)
            keep = (least.sum(1, dtype=np.int64) * (100 + percent) >= n * percent) | (least == 255).any(1)
            yield batch.select(["x", "y"]).filter(pa.array(keep))

    return run


def _sets(like: Similarity, needed):
    """The sets of the documents whose slot is marked."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = needed.value
        for batch in batches:
            slot = batch.column("slot").to_numpy()
            batch = batch.filter(pa.array((marks[slot >> 3] >> (slot & 7).astype(np.uint8) & 1).astype(bool)))
            for _, texts in slices(rows_of([batch])):
                text, value = shingles(Words.of(texts), like.words)
                cuts = np.searchsorted(text, np.arange(len(texts) + 1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_class_ids(value, cuts)), pa.array([value[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])], pa.binary())],
                    ["cid", "shingles"],
                )

    return run


def _linked(percent: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("shingles_x"), batch.column("shingles_y")):
                a, b = (np.frombuffer(s.as_buffer(), np.uint64) for s in (x, y))
                both = np.concatenate([a, b])
                both.sort()
                common = int(np.count_nonzero(both[1:] == both[:-1]))
                keep.append(100 * common >= percent * (len(both) - common))
            yield batch.select(["x", "y"]).filter(pa.array(keep, pa.bool_()))

    return run


class _Verifier:
    """Checks pairs of classes on the whole sets of their representatives."""

    def __init__(self, docs: DataFrame, posted: DataFrame, classes: DataFrame, like: Similarity, doc_id: str, text: str):
        self.like, self.classes = like, classes
        self.bits = grown(NEEDED_BITS, docs.rdd.getNumPartitions())
        self.docs = utf8(docs, doc_id, text).withColumn("slot", self._slot(F.col("id")))
        named = posted.join(classes.select("cid", F.col("rep").alias("doc_id")), ["cid", "doc_id"], "left_semi")
        unnamed = posted.filter("doc_id IS NULL").join(classes.filter("rep IS NULL"), "cid", "left_semi")
        representatives = named.select("cid", "n", "overlap").union(unnamed.select("cid", "n", "overlap"))
        self.bounds = representatives.groupBy("cid").agg(F.first("n").alias("n"), F.first("overlap").alias("overlap"))

    def _slot(self, doc_id):
        return F.pmod(F.xxhash64(doc_id), F.lit(self.bits))

    def links(self, pairs: DataFrame) -> DataFrame:
        """The pairs (x, y) of class ids that link."""
        spark, like = pairs.sparkSession, self.like
        x, y = (self.bounds.toDF(side, f"n_{side}", f"overlap_{side}") for side in ("x", "y"))
        pairs = durable(pairs)
        if pairs.isEmpty():
            return pairs
        heavy = measured(pairs, ["x", "y"], FAN)

        def both(rows: DataFrame, y: DataFrame, x: DataFrame) -> DataFrame:
            """Pairs with what is known of y, then of x; that of a class in many pairs is sent once for each task that its pairs are dealt to."""
            return split_join(split_join(rows, y, "y", heavy=heavy["y"]), x, "x", heavy=heavy["x"])

        possible = durable(both(pairs, y, x).mapInArrow(released(_bounded(like.percent)), "x long, y long").distinct())
        involved = possible.select(F.col("x").alias("cid")).union(possible.select("y")).distinct()
        needed = durable(involved.join(self.classes.select("cid", "rep"), "cid"))
        # which documents' sets to make: a table of bits, of one size at any input
        slot = self._slot(F.col("rep"))
        marks = np.zeros(self.bits // 8, np.uint8)
        bits = needed.groupBy(F.bitmap_bucket_number(slot + 1).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot + 1)).alias("bits"))
        for row in in_few_parts(bits, self.bits // NEEDED_BITS).toLocalIterator():
            part = np.frombuffer(row.bits, np.uint8)
            marks[(row.bucket - 1) * len(part) : row.bucket * len(part)] = part
        shared = spark.sparkContext.broadcast(marks)
        del marks
        sets = self.docs.mapInArrow(released(_sets(like, shared)), "cid long, shingles binary")
        # the bits let some documents more pass, other classes or copies of the same
        made = durable(sets.join(needed.select("cid"), "cid").groupBy("cid").agg(F.first("shingles").alias("shingles")))
        shared.destroy()
        x, y = (made.toDF(side, f"shingles_{side}") for side in ("x", "y"))
        # in a star x is the head: a pair carries the set of y to it, not the other way round
        return durable(both(possible, y, x).mapInArrow(released(_linked(like.percent)), "x long, y long").distinct())


# --- the join -------------------------------------------------------------------------------------------------------


def linked_classes(docs: DataFrame, like: Similarity = Similarity(), doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, links, roots): doc_id, cid, n of every document; x, y of verified links between classes of equal sets,
    enough of them to connect whatever links connect; cid, root of every class with a link."""
    spark = ship(tune(docs.sparkSession))
    texts = utf8(docs, doc_id, text)
    common = spark.sparkContext.broadcast(_common(slot_counts(texts, like.words)))
    posted = durable(texts.mapInArrow(released(_post(like, common)), POSTED))
    common.destroy()
    let_go(spark)

    # one document stands for a class of equal sets, one class for a group of equal prefixes and sizes
    classes = durable(posted.filter("n > 0").groupBy("gid", "cid").agg(F.min("doc_id").alias("rep")))  # null if none has an id
    heads = classes.groupBy("gid").agg(F.min("cid").alias("cid")).join(classes, ["gid", "cid"]).withColumnRenamed("rep", "doc_id")
    parts_of = ("n", "light", "tokens", "salts")
    groups = posted.join(heads, ["gid", "cid", "doc_id"], "left_semi").select("gid", *parts_of)
    unnamed = posted.filter("doc_id IS NULL").join(heads.filter("doc_id IS NULL"), ["gid", "cid"], "left_semi")
    groups = groups.union(unnamed.groupBy("gid").agg(*(F.first(name).alias(name) for name in parts_of)))
    postings = groups.select("gid", "n", "light", "salts", F.posexplode("tokens").alias("pos", "token")).select(
        "token", "gid", "n", "pos", "light", F.element_at("salts", F.col("pos") + 1).alias("spread")
    ).withColumn("salt", F.pmod("gid", "spread"))
    listed = durable(
        postings.repartition("token", "salt").sortWithinPartitions("token", "salt", "light", "gid").mapInArrow(released(_with_heads), LISTED)
    )
    let_go(spark)

    members = classes.select("gid", "cid")
    verifier = _Verifier(docs, posted, classes, like, doc_id, text)

    def expanded(pairs: DataFrame, left: DataFrame) -> DataFrame:
        """Pairs of classes from pairs of groups: those of ``left`` for x, all members for y."""
        return pairs.join(left.toDF("x", "cid_x"), "x").join(members.toDF("y", "cid_y"), "y").select("cid_x", "cid_y")

    # stars: the head of each list with the others, the heads of one list's parts with the first of them, a group with its members
    to_head = listed.filter(_may_link(like.percent, "n", "pos", "head_n", "head_pos")).select(F.col("head").alias("x"), F.col("gid").alias("y"))
    parts = listed.filter("spread > 1 AND gid = head")
    first = parts.groupBy("token").agg(F.min(F.struct("light", "gid")).alias("first")).select("token", F.col("first.gid").alias("x"))
    between = parts.join(first, "token").select("x", F.col("gid").alias("y"))
    stars = to_head.union(between).filter("x != y").distinct()
    group_head = classes.groupBy("gid").agg(F.min("cid").alias("head"))
    inside = members.join(group_head, "gid").select(F.col("head").alias("cid_x"), F.col("cid").alias("cid_y"))
    links = verifier.links(expanded(stars, group_head).union(inside).toDF("x", "y").filter("x != y").distinct())
    let_go(spark)
    roots = durable(components(links.toDF("a", "b")).toDF("cid", "root"))

    # the rest: what shares a prefix shingle, or a whole prefix, and is not connected yet
    rooted = durable(members.join(roots, "cid", "left").select("gid", "cid", F.coalesce("root", "cid").alias("root")))
    sizes = rooted.groupBy("gid").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("classes"))
    of_group = sizes.drop("classes")
    # the group's shingles just before this one: a pair that has one of them in common was formed there
    just_before = Window.partitionBy("gid").orderBy("pos").rowsBetween(-4, -1)
    # the parts of a list that is spread over tasks are seen from one head
    one_head = listed.join(first.withColumnRenamed("x", "whole_head"), "token", "left").withColumn("head", F.coalesce("whole_head", "head"))
    earlier = one_head.join(of_group, "gid").withColumn("earlier", F.collect_list("token").over(just_before))
    marked = durable(
        split_join(earlier, of_group.toDF("head", "head_low", "head_high"), "head", heavy=heavy_keys(listed, "head", FAN))
        .withColumn("apart", F.expr("NOT (low = high AND head_low = head_high AND low = head_low)"))
        .select("token", "gid", "n", "pos", "low", "high", "earlier", "apart", "spread")
    )
    # a list that is spread over tasks: its postings are dealt to as many, the others with it are repeated for each
    left = marked.filter("apart").withColumn("salt", F.pmod("gid", "spread")).drop("spread")
    others = marked.withColumn("salt2", F.explode(F.sequence(F.lit(0), F.col("spread") - 1))).select(
        *[F.col(name).alias(f"{name}2") for name in ("token", "gid", "n", "pos", "low", "high", "earlier")], "salt2"
    )
    unconnected = F.expr("gid != gid2 AND NOT (low = high AND low2 = high2 AND low = low2) AND NOT arrays_overlap(earlier, earlier2)")
    rest = left.join(others, F.expr("token = token2 AND salt = salt2") & unconnected & _may_link(like.percent, "n", "pos", "n2", "pos2"))
    between_groups = expanded(_ordered_pairs(rest, "gid", "gid2"), members)
    # likewise inside a group of several components
    parted = sizes.filter("low != high").select("gid", (1 + F.floor(F.col("classes") / FAN)).cast("int").alias("spread"))
    parted = durable(parted)
    split = rooted.join(parted, "gid") if parted.isEmpty() else split_join(rooted, parted, "gid", piece=FAN)
    one = split.select("gid", F.col("cid").alias("cid_x"), F.col("root").alias("root_x"), F.pmod("cid", "spread").cast("int").alias("salt"))
    each = split.select("gid", F.col("cid").alias("cid_y"), F.col("root").alias("root_y"), F.explode(F.sequence(F.lit(0), F.col("spread") - 1)).alias("salt"))
    within = one.join(each, ["gid", "salt"]).filter("root_x != root_y AND cid_x < cid_y")
    pairs = between_groups if parted.isEmpty() else between_groups.union(within.select("cid_x", "cid_y"))
    let_go(spark)
    more = verifier.links(_ordered_pairs(pairs, "cid_x", "cid_y"))
    let_go(spark)
    links = links.union(more)
    roots = durable(joined_components(roots, more.toDF("a", "b")).toDF("cid", "root"))
    return posted.select("doc_id", "cid", "n"), links, roots


def ngram_components(docs: DataFrame, like: Similarity = Similarity(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest id that links lead to), one row per row of ``docs``."""
    rows, _, roots = linked_classes(docs, like, doc_id, text)
    rooted = rows.join(roots, "cid", "left").select("doc_id", "n", F.coalesce("root", "cid").alias("root"))
    rooted = durable(rooted)
    named = rooted.groupBy("root").agg(F.min("doc_id").alias("least")).filter("root IS NOT NULL")
    return split_join(rooted, named, "root", "left", piece=RUN).select(
        "doc_id",
        F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def one_of_each(docs: DataFrame, like: Similarity = Similarity(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents, all columns, without those that links lead from to a smaller id.

    Rows without an id stay; rows that share an id stay if any of them does.
    """
    found = ngram_components(docs, like, doc_id, text)
    stays = F.max(F.col("doc_id") == F.col("component_id"))
    dropped = durable(found.groupBy("doc_id").agg(stays.alias("stays")).filter("NOT stays").select("doc_id"))
    # the row as one column, so that no name of its own can clash
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row"))
    kept = rows.join(dropped, "doc_id", "left_anti")
    return kept.select(*[F.col(f"row.`{name}`").alias(name) for name in docs.columns])
