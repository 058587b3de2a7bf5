"""Ranked lexical search, exact: a tree over the items and a tree over documents, walked together.

A document is a vector with a coordinate for every item term it holds: what the term adds to a score. An item scores
the sum of the document's coordinates at its own terms. Nodes of the document tree hold the maximum of each
coordinate below them, nodes of the item tree the union of their terms, so the sum of a document node's maxima over an
item node's terms bounds every score between the two. A pair of nodes is left when that bound is under the weakest
of the items' k-th best scores so far, or nothing; else both nodes open, down to single items and documents, whose
sums are exact.

Three passes: the items' terms (a block of items at a time, of bounded size); the stored vectors of all documents,
restricted to those terms, with the counts that weights need; the walk, in which every task holds a window of
documents and k results per item, of which Spark keeps the best k of all tasks.

Terms are compared as 64-bit hashes; two different terms share one with a probability of about 1 in 10**19 per pair.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.common import flat_bytes, run_hashes, stored, text_slices, tidy

K = 10
# A block of items: what one walk holds, ships to its tasks and collects to the driver.
BLOCK_ITEMS, BLOCK_TERMS = 512, 1 << 15
# A window of documents, the cells of a dense batch of them, and the children of a node.
WINDOW, CELLS, FAN = 16_384, 1 << 22, 8

_TERM = np.zeros(256, bool)
_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def term_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of every run of letters, digits and characters outside ASCII, A-Z lower-cased."""
    edge = np.diff(np.concatenate(([False], _TERM[data], [False])).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    low = np.where((data >= 0x41) & (data <= 0x5A), data | 0x20, data)
    return run_hashes(low, starts, ends), starts


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, stop in text_slices(batch.column(1)):
            part = batch.slice(start, stop - start)
            data, offsets = flat_bytes(part.column(1))
            hashes, at = term_hashes(data)
            row = np.searchsorted(offsets, at, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(row)), pa.array(hashes.view(np.int64))], names=["item_id", "term"])


def item_blocks(items: DataFrame) -> Iterator[list[tuple[int | None, np.ndarray]]]:
    """Lists of (item_id, distinct term hashes); all terms of a list are at most ``BLOCK_TERMS``, or of one item."""
    terms = stored(items.mapInArrow(tidy(_item_terms), "item_id long, term long").distinct(), "item-terms")
    total = terms.agg(F.count(F.lit(1)), F.count_distinct(F.coalesce(F.col("item_id").cast("string"), F.lit("")))).first()
    n = max(1, -(-total[0] // (BLOCK_TERMS // 2)), -(-total[1] // (BLOCK_ITEMS // 2))) if total[0] else 0
    while n:
        block = F.pmod(F.xxhash64("item_id", F.lit(n)), F.lit(n))
        sizes = terms.groupBy(block.alias("block")).agg(
            F.count(F.lit(1)).alias("terms"), F.count_distinct(F.coalesce(F.col("item_id").cast("string"), F.lit(""))).alias("items"))
        if sizes.where((F.col("items") > 1) & ((F.col("terms") > BLOCK_TERMS) | (F.col("items") > BLOCK_ITEMS))).isEmpty():
            break
        n *= 2
    for i in range(n):
        rows = terms.where(block == i).groupBy("item_id").agg(F.collect_list("term").alias("terms")).collect()
        if rows:
            yield [(r["item_id"], np.unique(np.array(r["terms"], np.int64).view(np.uint64))) for r in rows]


def vectors(documents: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """doc_id, n (all terms), terms (places in the sorted ``vocabulary``), counts of every document with a term."""
    size = len(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in text_slices(batch.column(1)):
                part = batch.slice(start, stop - start)
                data, offsets = flat_bytes(part.column(1))
                hashes, at = term_hashes(data)
                n = np.diff(np.searchsorted(at, offsets))
                place = np.minimum(np.searchsorted(vocabulary, hashes), size - 1)
                hit = vocabulary[place] == hashes
                row = np.searchsorted(offsets, at[hit], side="right") - 1
                pairs, counts = np.unique(row * size + place[hit], return_counts=True)
                bounds = pa.array(np.searchsorted(pairs, np.arange(stop - start + 1) * size).astype(np.int32))
                out = pa.RecordBatch.from_arrays([
                    part.column(0), pa.array(n.astype(np.int64)),
                    pa.ListArray.from_arrays(bounds, pa.array((pairs % size).astype(np.int32))),
                    pa.ListArray.from_arrays(bounds, pa.array(counts.astype(np.int32)))],
                    names=["doc_id", "n", "terms", "counts"])
                yield out.filter(pa.array(n > 0))

    return documents.mapInArrow(tidy(run), "doc_id long, n long, terms array<int>, counts array<int>")


class Node(NamedTuple):
    """Of the item tree: all items below, the union of their terms, and children (none of a single item)."""

    items: np.ndarray
    terms: np.ndarray
    children: list


def item_tree(sets: list[np.ndarray], weights: np.ndarray) -> Node | None:
    """Items of like heaviest terms under one node."""
    lead = [max(zip(weights[s].tolist(), s.tolist())) for s in sets]
    level = [Node(np.array([i]), sets[i], []) for i in sorted(range(len(sets)), key=lead.__getitem__)]
    while len(level) > 1:
        level = [Node(np.concatenate([c.items for c in part]), np.unique(np.concatenate([c.terms for c in part])), part)
                 for part in (level[i:i + FAN] for i in range(0, len(level), FAN))]
    return level[0] if level else None


class Search:
    """The k best documents of each item among those seen so far: higher score first, then smaller doc_id."""

    def __init__(self, sets: list[np.ndarray], weights: np.ndarray, documents: int, length: int, k: int):
        self.tree, self.weights, self.documents, self.length, self.k = item_tree(sets, weights), weights, documents, length, k
        self.scores = [np.empty(0, np.int64) for _ in sets]
        self.ids = [np.empty(0, np.int64) for _ in sets]
        self.null = [np.empty(0, bool) for _ in sets]
        # Scores below these can't be among the k best; no score of 0 counts.
        self.least = np.ones(len(sets), np.int64)
        self.opened = self.pruned = 0

    def impacts(self, n: np.ndarray, row: np.ndarray, terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
        if 90 * int(n.max(initial=0)) * self.documents < 2**63:
            m = 10 + 90 * n * self.documents // self.length
        else:
            m = np.array([10 + 90 * v * self.documents // self.length for v in n.tolist()])
        return self.weights[terms] * (1_000_000_000 * counts // (1000 * counts + 8 * m[row]))

    def add(self, ids: np.ndarray, null: np.ndarray, n: np.ndarray, sizes: np.ndarray, terms: np.ndarray, counts: np.ndarray) -> None:
        """A window of documents: their terms and counts one after the other, ``sizes`` of each."""
        row = np.repeat(np.arange(len(ids)), sizes)
        impacts = self.impacts(n, row, terms, counts)
        # Documents of one heaviest term come to stand in one part of the tree; heaviest first, so that bounds rise early.
        best = np.lexsort((-impacts, row))
        first = best[np.searchsorted(row[best], np.flatnonzero(sizes))]
        order = row[first][np.lexsort((-impacts[first], terms[first], -self.weights[terms[first]]))]
        place = np.full(len(ids), -1)
        place[order] = np.arange(len(order))
        step = max(FAN * FAN, CELLS // len(self.weights) // (FAN * FAN) * FAN * FAN)
        at = place[row]
        for start in range(0, len(order), step):
            here = (at >= start) & (at < start + step)
            docs = order[start:start + step]
            leaves = np.zeros((-(-len(docs) // (FAN * FAN)) * FAN * FAN, len(self.weights)), np.int64)
            leaves[at[here] - start, terms[here]] = impacts[here]
            levels = [leaves]
            while len(levels) < 3:
                levels.insert(0, levels[0].reshape(-1, FAN, leaves.shape[1]).max(axis=1))
            levels.insert(0, levels[0].max(axis=0, keepdims=True))
            if self.tree is not None:
                self._walk(levels, ids[docs], null[docs])

    def _walk(self, levels: list[np.ndarray], ids: np.ndarray, null: np.ndarray) -> None:
        todo = [(self.tree, 0, np.zeros(1, np.int64))]
        while todo:
            node, level, rows = todo.pop()
            bounds = levels[level][rows[:, None], node.terms].sum(axis=1)
            kept = bounds >= self.least[node.items].min()
            self.opened += int(kept.sum())
            self.pruned += len(kept) - int(kept.sum())
            rows = rows[kept]
            if not len(rows):
                continue
            last = level == len(levels) - 1
            if last and not node.children:
                self._keep(int(node.items[0]), bounds[kept], ids[rows], null[rows])
                continue
            if not last:
                fan = len(levels[1]) if level == 0 else FAN
                rows = (rows[:, None] * fan + np.arange(fan)).ravel()
            todo += [(child, level + (not last), rows) for child in node.children or [node]]

    def _keep(self, item: int, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        scores, ids, null = (np.concatenate(c) for c in (
            (self.scores[item], scores), (self.ids[item], ids), (self.null[item], null)))
        best = np.lexsort((ids, null, -scores))[:self.k]
        self.scores[item], self.ids[item], self.null[item] = scores[best], ids[best], null[best]
        if len(best) == self.k:
            self.least[item] = max(1, scores[best[-1]])


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Documents of up to ``WINDOW`` rows or ``CELLS`` terms together."""
    parts, n_rows, n_terms = [], 0, 0

    def joined():
        return tuple(np.concatenate(c) for c in zip(*parts))

    for batch in batches:
        known = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
        sizes = np.asarray(batch.column(2).value_lengths())
        parts.append((batch.column(0).fill_null(0).to_numpy(), ~known, batch.column(1).to_numpy(), sizes,
                      batch.column(2).flatten().to_numpy().astype(np.int64), batch.column(3).flatten().to_numpy().astype(np.int64)))
        n_rows, n_terms = n_rows + len(sizes), n_terms + int(sizes.sum())
        if n_rows >= WINDOW or n_terms >= CELLS:
            yield joined()
            parts, n_rows, n_terms = [], 0, 0
    if parts:
        yield joined()


def _search_block(documents: DataFrame, items: list[tuple[int | None, np.ndarray]], k: int) -> DataFrame:
    vocabulary = np.unique(np.concatenate([t for _, t in items]))
    sets = [np.searchsorted(vocabulary, t) for _, t in items]
    keys = [i for i, _ in items]
    found = stored(vectors(documents, vocabulary), "vectors")
    n_docs, length = found.agg(F.count(F.lit(1)), F.sum("n")).first()
    holding = np.zeros(len(vocabulary), np.int64)
    for term, df in found.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # at most one row a term of the block
        holding[term] = df
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(df) + 1))) for df in holding], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(sets, weights, n_docs, length or 1, k)
        for window in _windows(batches):
            search.add(*window)
        sizes = [len(s) for s in search.scores]
        yield pa.RecordBatch.from_arrays([
            pa.array([key for key, size in zip(keys, sizes) for _ in range(size)], pa.int64()),
            pa.array(np.concatenate(search.ids), pa.int64(), mask=np.concatenate(search.null)),
            pa.array(np.concatenate(search.scores))], names=["item_id", "doc_id", "score"])

    best = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = found.where(F.size("terms") > 0).mapInArrow(tidy(run), "item_id long, doc_id long, score long")
    return ranked.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def search(documents: DataFrame, items: DataFrame, k: int = K, key: str = "doc_id", text: str = "text",
           item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """item_id, rank (from 1), doc_id, score: each item's ``k`` best documents with a score above 0.

    Equal scores rank by ascending doc_id. Null and empty texts, and items without a known term, have no rows. Every row
    of ``documents`` is a document of its own, also where ids repeat; rows without an id rank after equal scores with
    one. Rows of ``items`` with one id, null among them, are one item with the terms of all. Whole texts are read,
    however long. Empty tables give no row. Further columns of either table are not looked at.
    """
    docs = documents.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    asked = items.select(F.col(item_key).cast("long").alias("item_id"), F.col(item_text).cast("string").alias("text"))
    spark = documents.sparkSession
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for block in item_blocks(asked):
        found = _search_block(docs, block, k)
        out = out.unionByName(found)
    return out
