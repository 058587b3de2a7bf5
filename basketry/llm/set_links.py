"""Exact links between similar sets: candidate clusters, blocks of bounded size, and a prefix-tree join in each block.

``candidates`` names, for each set, keys of which two linked sets share at least one. Sets with a common key are
joined to the key's smallest set only (one edge per key and set), and components of these edges are clusters: every
pair that could be linked lies in one. A cluster of at most ``BLOCK`` sets is one block. A larger one is dealt by size
band (linked sets lie in the same band or in neighbouring ones) and hash, and every two parts that can hold a link
make a block, so no task holds more than two parts, however large the cluster. Its sets stand in as many blocks as it
has parts, so blocks are dealt to rounds, of which each sends ``ROUND`` times what the sets take on average, and leaves
nothing but links.

In a block the sets, ordered by how many sets hold an element, are stored in a prefix tree. A set is compared with
all others in one walk down the tree: overlaps are counted once per shared path, and a subtree is left as soon as the
overlap so far and the elements left on either side cannot make a link.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import discard, released, spread, stored
from basketry.llm.components import components

BLOCK = 256
ROUND = 1.5
# Linked: 100 * intersection >= 80 * union, that is 9 * intersection >= 4 * (sum of both sizes).
OVERLAP, SIZES = 9, 4
BAND = math.log(1.25)


class Node(NamedTuple):
    label: np.ndarray
    smallest: int  # size of the smallest set below
    rest: int  # most elements that a set has below this node
    children: list
    members: list[int]


def prefix_tree(sets: list[np.ndarray], order: list[int], lo: int, hi: int, depth: int) -> Node:
    """Path-compressed tree of ``sets[order[lo:hi]]``, which agree on their first ``depth`` elements."""
    roots: list[Node] = []
    stack = [(lo, hi, depth, roots)]
    made = []
    while stack:
        a, b, d, siblings = stack.pop()
        first, last = sets[order[a]], sets[order[b - 1]]
        n = min(len(first), len(last))
        differ = np.flatnonzero(first[d:n] != last[d:n])
        end = d + int(differ[0]) if len(differ) else n
        node = [first[d:end], a, b, end, [], []]
        siblings.append(node)
        made.append(node)
        i = a
        while i < b and len(sets[order[i]]) == end:
            node[5].append(order[i])
            i += 1
        while i < b:
            value = sets[order[i]][end]
            j = i + 1
            while j < b and sets[order[j]][end] == value:
                j += 1
            stack.append((i, j, end, node[4]))
            i = j
    built: dict[int, Node] = {}
    for node in reversed(made):
        label, a, b, end, children, members = node
        kids = [built[id(c)] for c in children]
        smallest = min([len(sets[m]) for m in members] + [k.smallest for k in kids])
        rest = max([0] + [len(k.label) + k.rest for k in kids])
        built[id(node)] = Node(label, smallest, rest, kids, members)
    return built[id(made[0])]


def links(sets: list[np.ndarray], sides: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Pairs (i, j), i < j, of linked sets (sorted arrays of distinct numbers); with ``sides`` only across sides."""
    used = [i for i, s in enumerate(sets) if len(s)]
    if len(used) < 2:
        return []
    values, back, counts = np.unique(np.concatenate([sets[i] for i in used]), return_inverse=True, return_counts=True)
    rank = np.empty(len(values), np.int32)
    rank[np.lexsort((values, -counts))] = np.arange(len(values), dtype=np.int32)
    ordered: list[np.ndarray] = [np.empty(0, np.int32)] * len(sets)
    start = 0
    for i in used:
        ordered[i] = np.sort(rank[back[start:start + len(sets[i])]])
        start += len(sets[i])
    held = used if sides is None else [i for i in used if sides[i] == 1]
    probes = used if sides is None else [i for i in used if sides[i] == 0]
    if not held or not probes:
        return []
    order = sorted(held, key=lambda i: ordered[i].astype(">i4").tobytes())
    tree = prefix_tree(ordered, order, 0, len(order), 0)
    found = []
    marks = np.zeros(len(values), bool)
    for i in probes:
        mine = ordered[i]
        marks[mine] = True
        n = len(mine)
        todo = [(tree, 0, 0)]
        while todo:
            node, overlap, seen = todo.pop()
            if len(node.label):
                overlap += int(np.count_nonzero(marks[node.label]))
                seen = int(np.searchsorted(mine, node.label[-1], side="right"))
            least = SIZES * (n + node.smallest)
            if OVERLAP * (overlap + min(n - seen, node.rest)) < least:
                continue
            for j in node.members:
                if (sides is not None or j > i) and OVERLAP * overlap >= SIZES * (n + len(ordered[j])):
                    found.append((min(i, j), max(i, j)))
            for child in node.children:
                if OVERLAP * (overlap + min(n - seen, len(child.label) + child.rest)) >= SIZES * (n + child.smallest):
                    todo.append((child, overlap, seen))
        marks[mine] = False
    return found


def numbers(elements: pd.Series) -> list[np.ndarray]:
    """Sets that are sent as the bytes of their 64-bit numbers."""
    return [np.frombuffer(e, np.int64) for e in elements]


def _solve(rows: pd.DataFrame, read: Callable[[pd.Series], list[np.ndarray]]) -> pd.DataFrame:
    """Per block and set: the smallest set it hangs together with in the block, and its number of links there."""
    out = []
    for _, block in rows.groupby("block"):
        ids = block["id"].to_numpy()
        sets = read(block["elements"])
        sides = block["side"].to_numpy()
        pairs = links(sets, sides if sides.any() else None)
        if not pairs:
            continue
        parent, n = list(range(len(ids))), np.zeros(len(ids), np.int64)

        def root(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        for i, j in pairs:
            n[i] += 1
            n[j] += 1
            a, b = root(i), root(j)
            if a != b:
                if ids[a] > ids[b]:
                    a, b = b, a
                parent[b] = a
        linked = np.flatnonzero(n)
        out.append(pd.DataFrame({"id": ids[linked], "root": ids[[root(i) for i in linked]], "links": n[linked]}))
    return pd.concat(out) if out else pd.DataFrame({"id": [], "root": [], "links": []}, dtype="int64")


def clusters(candidates: DataFrame) -> DataFrame:
    """id, cluster of all ids that share a key with another; ``candidates`` has key and id."""
    least = stored(candidates.groupBy("key").agg(F.min("id").alias("least"), F.max("id").alias("most"))
                   .where("least < most").drop("most"), "shared-keys")
    edges = candidates.join(least, "key").where("id > least").select(F.col("id").alias("u"), F.col("least").alias("v"))
    edges = stored(edges.distinct(), "candidate-edges")
    discard(least)
    found = stored(components(edges).select(F.col("node").alias("id"), F.col("component").alias("cluster")), "clusters")
    discard(edges)
    return found


def places(members: DataFrame) -> DataFrame:
    """``members`` (id, cluster, n, elements) with spots: block and side (0 or 1) of every block that a member stands in."""
    members = members.withColumn("band", F.floor(F.log(F.col("n")) / F.lit(BAND)).cast("int"))
    sizes = members.groupBy("cluster", "band").agg(F.count(F.lit(1)).alias("members")).groupBy("cluster").agg(
        F.sum("members").alias("size"),
        F.map_from_entries(F.collect_list(F.struct("band", F.ceil(F.col("members") / BLOCK).cast("int")))).alias("parts"))
    large = stored(sizes.where(F.col("size") > BLOCK).select("cluster", "parts"), "large-clusters")
    joined = members.join(large, "cluster", "left")
    parts = lambda shift: F.coalesce(F.try_element_at("parts", F.col("band") + shift), F.lit(0))
    own = F.pmod(F.xxhash64("id"), parts(0)).cast("int")

    def other(shift: int):
        n = parts(shift)
        return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))

    def name(band, i, above, j):
        return F.xxhash64("cluster", band, i, above, j)

    band = F.col("band")
    spots = F.concat(
        F.transform(other(0), lambda j: F.struct(
            name(band, F.least(F.col("own"), j), band, F.greatest(F.col("own"), j)).alias("block"),
            (F.col("own") > j).cast("int").alias("side"))),
        F.transform(other(1), lambda j: F.struct(name(band, F.col("own"), band + 1, j).alias("block"), F.lit(0).alias("side"))),
        F.transform(other(-1), lambda j: F.struct(name(band - 1, j, band, F.col("own")).alias("block"), F.lit(1).alias("side"))),
    )
    alone = F.array(F.struct(F.xxhash64("cluster").alias("block"), F.lit(0).alias("side")))
    return joined.withColumn("own", F.when(F.col("parts").isNotNull(), own)).select(
        "id", "n", "elements", F.when(F.col("parts").isNull(), alone).otherwise(spots).alias("spots"))


def linked(members: DataFrame, read: Callable[[pd.Series], list[np.ndarray]] = numbers) -> DataFrame:
    """id, component (smallest id linked directly or over others), n_links (sets it is linked with itself).

    ``members``, a stored table, has id, cluster, n (numbers in the set) and elements, of which ``read`` makes the sets,
    arrays of distinct 64-bit numbers. Sets without a link are left out.
    """
    placed = places(members)
    spots = F.size("spots")
    count, sent, held = placed.agg(F.sum(spots), F.sum(F.col("n") * spots), F.sum("n")).first()
    rounds = max(1, math.ceil((sent or 0) / (ROUND * (held or 1))))
    # Small blocks share a task and a call; a block's rows always meet in one.
    n = max(4 * rounds * int(members.sparkSession.conf.get("spark.sql.shuffle.partitions")), (count or 0) // 2048 + 1)
    found = []
    for turn in range(rounds):
        here = placed.select("id", "elements", F.explode(F.filter(
            "spots", lambda s: F.pmod(s["block"], F.lit(n)) % rounds == turn)).alias("spot"))  # noqa: B023
        here = here.select("spot.block", "spot.side", "id", "elements").withColumn("bin", F.pmod("block", F.lit(n)))
        # Rows are few bytes and much work: dealt by number, so that Spark doesn't merge their tasks.
        found.append(stored(spread(here, "bin").groupBy("bin").applyInPandas(
            lambda frame: released(_solve, frame, read), "id long, root long, links long"), "links"))
    solved = reduce(DataFrame.unionByName, found)
    joined = components(solved.select(F.col("id").alias("u"), F.col("root").alias("v")))
    return joined.withColumnRenamed("node", "id").join(
        solved.groupBy("id").agg(F.sum("links").alias("n_links")), "id")
