"""Merkle manifest of a dataset by cogrouped subtree exchange.

Every row is a leaf: the SHA-256 of its fields, each as byte count, ``:`` and value, or ``-`` if null. The leaves of a group ascend by
id; runs of 16 nodes become their hash until one is left, the group's subroot; subroots, ordered by group, give the root alike.

A superblock is 16 ** 3 neighbouring nodes of a level.

1. *Places.* Leaves are range-partitioned by (group, id, leaf); a leaf's place is its number in the partition plus the leaves
   of its group in the partitions before, a prefix over one row per group and partition. A group of any size is spread.
2. *Up.* One grouping by superblock lifts a level by three; the nodes it returns are the next level. A dataset of 10 ** 12 rows takes four.
3. *Down.* Leaves of a superblock and the one row with the nodes outside that their proofs need (the siblings above the superblock,
   15 a level at most) are cogrouped in ``applyInPandas``: the local levels are made again, each leaf's siblings inside are
   joined to those outside, and the leaf is folded to the root, in the same call.

So a task holds superblocks of 4,096 hashes, whatever the number of rows or the share of one group. Every level is a table in the
shared folder; a lost executor costs its running tasks.

Nulls: a null field is ``-``; a null group is a group and comes first, as null ids do in theirs; a null id is never tampered with by
the audit query. Empty texts have length 0, not ``-``. Rows of one id are ordered by their leaf; equal rows are leaves of their own,
one after the other. An empty table gives an empty result. Columns other than those named do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.column import Column

from tillwise.llm.shipping import ship
from tillwise.session import durable, tune

RADIX = 16
HEIGHT = 3  # levels of a superblock
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

NODES = "grp string, at long, n long, node string"
# of a node: its places in the runs up to the root, each run's other nodes side by side, and what they lead to
PATHS = "grp string, at long, places array<int>, others array<string>"
SUBROOTS = "grp string, subroot string, root string, places array<int>, others array<string>"
FOUND = "leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
PROOF = ", places array<int>, siblings array<string>"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def framed(field: Column) -> Column:
    """A field with its length in front, so that no two lists of fields read alike."""
    value = field.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_hash(*fields: Column) -> Column:
    return F.sha2(F.concat(*map(framed, fields)), 256)


# --- hashing inside a superblock --------------------------------------------------------------------------------------


def local_levels(nodes: list[str], n: int, height: int = HEIGHT) -> list[list[str]]:
    """The levels of a superblock of a level of ``n`` nodes, from ``nodes`` up to the one that is left."""
    levels = [nodes]
    while len(levels) <= height and n > 1:
        last = levels[-1]
        levels.append([digest("".join(last[i : i + RADIX])) for i in range(0, len(last), RADIX)])
        n = -(-n // RADIX)
    return levels


def local_path(levels: list[list[str]], at: int) -> tuple[list[int], list[str]]:
    """Place in the run and the run's others, level by level, of the node at a place of the superblock."""
    places, others = [], []
    for level in levels[:-1]:
        begin = at - at % RADIX
        places.append(at % RADIX)
        others.append("".join(level[begin:at]) + "".join(level[at + 1 : begin + RADIX]))
        at //= RADIX
    return places, others


def folded(node: str, places: list[int], others: list[str]) -> str:
    """The root that a node and its siblings lead to."""
    for place, siblings in zip(places, others):
        cut = place * len(node)
        node = digest(siblings[:cut] + node + siblings[cut:])
    return node


def _lifted(height: int) -> Callable[[tuple, pd.DataFrame], pd.DataFrame]:
    def run(key: tuple, nodes: pd.DataFrame) -> pd.DataFrame:
        nodes = nodes.sort_values("at")
        n = int(nodes["n"].iloc[0])
        top = local_levels(nodes["node"].tolist(), n, height)[-1]
        return pd.DataFrame({"grp": [key[0]], "at": [key[1]], "n": [-(-n // RADIX**height)], "node": top})

    return run


def _joined(nodes: pd.DataFrame, outer: pd.DataFrame, height: int) -> list[tuple[list[int], list[str]]]:
    """Places and siblings up to the root of the nodes of a superblock, in order."""
    levels = local_levels(nodes["node"].tolist(), int(nodes["n"].iloc[0]), height)
    above, beyond = list(outer["places"].iloc[0]), list(outer["others"].iloc[0])
    inside = (local_path(levels, at) for at in range(len(nodes)))
    return [(places + above, others + beyond) for places, others in inside]


def _paths(height: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    def run(nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        nodes = nodes.sort_values("at")
        places, others = zip(*_joined(nodes, outer, height))
        return pd.DataFrame({"grp": nodes["grp"].to_numpy(), "at": nodes["at"].to_numpy(), "places": places, "others": others})

    return run


def _subroots(height: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    def run(nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        nodes = nodes.sort_values("at")
        paths = _joined(nodes, outer, height)
        subroots = nodes["node"].tolist()
        roots = [folded(node, *path) for node, path in zip(subroots, paths)]
        places, others = zip(*paths)
        return pd.DataFrame({"grp": nodes["key"].to_numpy(), "subroot": subroots, "root": roots, "places": places, "others": others})

    return run


def _audited(height: int, proofs: bool) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    def run(leaves: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        leaves = leaves.sort_values("at")
        subroot, root = outer["subroot"].iloc[0], outer["root"].iloc[0]
        rows = []
        for doc_id, node, seen, (places, others) in zip(leaves["doc_id"], leaves["node"], leaves["seen"], _joined(leaves, outer, height)):
            found = folded(node if seen is None else seen, places, others)
            rows.append((doc_id, node, subroot, root, digest("".join(others)), found, found == root, places, others))
        names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "places", "siblings"]
        out = pd.DataFrame(rows, columns=names)
        return out if proofs else out.drop(columns=["places", "siblings"])

    return run


# --- the tree as tables ---------------------------------------------------------------------------------------------


def placed(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` with ``at``, their place in ``grp`` by the columns ``order`` (nulls first), and ``n``, the size of ``grp``; a written table."""
    keys = [F.col("grp"), *(F.col(name).asc_nulls_first() for name in order)]
    # rows that are alike in all of these are interchangeable; their number lets them lie in several partitions
    ranged = rows.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*keys, F.col("tie"))
    written = durable(ranged.sortWithinPartitions(*keys, "tie").drop("tie").withColumn("row", F.monotonically_increasing_id()))
    written = written.withColumn("part", F.shiftright("row", 33))
    parts = written.groupBy("grp", "part").agg(F.min("row").alias("first"), F.count("*").alias("rows"))
    group = Window.partitionBy("grp")
    before = F.sum("rows").over(group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = parts.select("grp", "part", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"), F.sum("rows").over(group).alias("n"))
    return durable(
        written.join(offsets, ["grp", "part"]).select(*rows.columns, (F.col("row") + F.col("shift")).alias("at"), "n")
    )


@dataclass
class Tree:
    """Levels of nodes (``NODES``), each ``height`` levels of hashes above the one before; a group ends at the level where it has one node."""

    levels: list[DataFrame]
    height: int

    def block(self) -> Column:
        return F.floor(F.col("at") / RADIX**self.height).cast("long").alias("block")

    @staticmethod
    def over(nodes: DataFrame, height: int) -> Tree:
        tree = Tree([nodes], height)
        most = nodes.agg(F.max("n")).first()[0] or 0
        while True:
            below = tree.levels[-1].select("grp", "at", "n", "node")
            going_on = below if len(tree.levels) == 1 else below.filter("n > 1")  # a single leaf is lifted once, as it is
            tree.levels.append(durable(going_on.groupBy("grp", tree.block()).applyInPandas(_lifted(height), NODES)))
            most = -(-most // RADIX**height)
            if most <= 1:
                return tree

    def tops(self) -> DataFrame:
        """grp, node: the last node of every group."""
        ended = [level.filter("n = 1").select("grp", "node") for level in self.levels[1:]]
        return reduce(DataFrame.unionByName, ended)

    def outer(self, tops: DataFrame) -> DataFrame:
        """The paths of all superblocks of the lowest level, from those of the groups' tops (grp, places, others)."""

        def ended(level: DataFrame) -> DataFrame:
            return level.filter("n = 1").select("grp", "at").join(tops, "grp").select("grp", "at", "places", "others")

        paths = ended(self.levels[-1])  # no node there is below another
        for level in reversed(self.levels[1:-1]):
            inner = self.with_outer(level.filter("n > 1"), paths).applyInPandas(_paths(self.height), PATHS)
            paths = durable(inner.unionByName(ended(level)))
        return paths

    def with_outer(self, nodes: DataFrame, paths: DataFrame):
        """Nodes of each superblock cogrouped with the path of the superblock."""
        return nodes.groupBy("grp", self.block()).cogroup(paths.groupBy("grp", "at"))


def leaves_of(docs: DataFrame, tampered: dict[str, Column] | None, when: Column | None, fields=FIELDS, doc_id="doc_id", group="source") -> DataFrame:
    """grp, doc_id, node, seen: the leaf of every row and, where ``when`` holds, the one it has with the columns of ``tampered``."""
    rows = docs.select(*(F.col(f"`{name}`") for name in dict.fromkeys((*fields, doc_id, group))))
    seen = F.lit(None).cast("string")
    if tampered and when is not None:
        seen = F.when(when, leaf_hash(*(tampered.get(name, F.col(f"`{name}`")) for name in fields)))
    named = F.coalesce(F.concat(F.lit("="), F.col(f"`{group}`").cast("string")), F.lit("-"))  # in the groups' order, null first
    return rows.select(
        named.alias("grp"), F.col(f"`{doc_id}`").cast("long").alias("doc_id"), leaf_hash(*(F.col(f"`{name}`") for name in fields)).alias("node"), seen.alias("seen")
    )


def manifest(
    docs: DataFrame, tampered: dict[str, Column] | None = None, when: Column | None = None, height: int = HEIGHT, **names
) -> tuple[DataFrame, Tree, Tree]:
    """The placed leaves, the tree over each group's leaves and the tree over the subroots."""
    ship(tune(docs.sparkSession))
    leaves = placed(durable(leaves_of(docs, tampered, when, **names)), "doc_id", "node")
    groups = Tree.over(leaves, height)
    subroots = groups.tops().select(F.lit("").alias("grp"), F.col("grp").alias("key"), "node")
    return leaves, groups, Tree.over(placed(subroots, "key"), height)


def audited(
    docs: DataFrame, tampered: dict[str, Column] | None = None, when: Column | None = None, proofs: bool = False, height: int = HEIGHT, **names
) -> DataFrame:
    """One row per row of ``docs``: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    The root is of the rows as they are. Rows where ``when`` holds are then checked as if the columns of ``tampered`` (by name) had
    the given values: ``folded_root`` is what their leaf and the manifest's siblings lead to. ``proofs`` adds places and siblings, a
    list each with one item per level. ``names``: fields of the leaf, doc_id and group column.
    """
    leaves, groups, top = manifest(docs, tampered, when, height, **names)
    nothing = top.tops().select("grp", F.array().cast("array<int>").alias("places"), F.array().cast("array<string>").alias("others"))
    subroots = durable(top.with_outer(top.levels[0], top.outer(nothing)).applyInPandas(_subroots(height), SUBROOTS))
    outer = groups.outer(subroots.select("grp", "places", "others")).join(subroots.select("grp", "subroot", "root"), "grp")
    # ids as text: pandas would make numbers with nulls inexact
    inner = leaves.withColumn("doc_id", F.col("doc_id").cast("string"))
    found = groups.with_outer(inner, outer).applyInPandas(_audited(height, proofs), f"doc_id string, {FOUND}{PROOF if proofs else ''}")
    return found.withColumn("doc_id", F.col("doc_id").cast("long"))


def holds(leaf: str, places: list[int], siblings: list[str], root: str) -> bool:
    """Whether a row of ``audited(..., proofs=True)`` belongs to a dataset of this root, from its proof alone."""
    return folded(leaf, places, siblings) == root
