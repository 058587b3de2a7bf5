"""Exact top-k inner-product search by Voronoi cells.

Vectors become whole numbers, and every vector belongs to the cell of its nearest pivot. Per cell a summary holds its
radius and the k + 1 vectors nearest to the pivot. The vectors of the summaries give each query a score that its k-th
best reaches at least; queries are grouped by cell (large cells in several groups), and per group the lowest such
score, the centre and the radius bound what a vector must offer. A data vector goes only to groups whose bound it can
reach, spread over chunks of bounded size; each (group, chunk) is solved with one matrix product, and the few
scores that reach a query's own bound are ranked.

Bounds, for a query q of a group with centre c and radius r, and a vector x of a cell with pivot p and radius s:
q.x <= c.x + r |x| and q.x <= q.p + |q| s. Both are widened by a rounding allowance, so nothing exact is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from basketry.llm.common import stored

MAX_PIVOTS = 256
ROWS_PER_PIVOT = 4096
QUERY_BLOCK = 1024
MAX_GROUPS = 4096
CHUNK_ROWS = 8192


class Cells(NamedTuple):
    pivots: np.ndarray  # cells x dimensions
    radius: np.ndarray
    sample: np.ndarray  # vectors nearest to the pivots
    sample_id: np.ndarray


class Groups(NamedTuple):
    key: np.ndarray  # group numbers
    centre: np.ndarray
    radius: np.ndarray
    norm: np.ndarray
    bound: np.ndarray


def whole(vector, scale: float, size: int) -> np.ndarray | None:
    """floor(scale * x) of every component, padded with zeros to ``size``; None if a component is null or not finite."""
    try:
        values = np.asarray(vector, dtype=np.float64)
    except (TypeError, ValueError):
        return None
    if not np.isfinite(values).all():
        return None
    out = np.zeros(size, np.int64)
    out[:len(values)] = np.floor(values * scale)
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T in whole numbers; by floating point where that is exact."""
    largest = float(max(1, np.abs(a).max(initial=0))) * float(max(1, np.abs(b).max(initial=0))) * max(1, a.shape[1])
    if largest < 2**52:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def _stack(packed, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(packed), np.int64).reshape(-1, size)


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    x, pivots = x.astype(np.float64), pivots.astype(np.float64)
    return np.sqrt(np.maximum((x * x).sum(1)[:, None] - 2 * x @ pivots.T + (pivots * pivots).sum(1), 0))


def _summaries(vectors: DataFrame, pivots: np.ndarray, k: int, size: int) -> Cells:
    """Radius and nearest k + 1 vectors of each cell: at most MAX_PIVOTS * (k + 1) rows reach the driver."""
    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = _stack(batch["v"], size)
            far = _distances(x, pivots)
            frame = pd.DataFrame({"cell": far.argmin(1), "far": far.min(1), "id": batch["id"], "v": batch["v"]})
            frame["radius"] = frame.groupby("cell")["far"].transform("max")
            yield frame.sort_values(["far", "id"]).groupby("cell").head(k + 1)

    rows = vectors.mapInPandas(nearest, "cell long, far double, id long, v binary, radius double")
    place = W.partitionBy("cell").orderBy("far", "id")
    # Two ranks: within a slice of the tasks' rows first, so that no cell's rows all meet before they are few.
    first = rows.withColumn("part", F.pmod("id", F.lit(64))).withColumn(
        "place", F.row_number().over(W.partitionBy("cell", "part").orderBy("far", "id"))).withColumn(
        "radius", F.max("radius").over(W.partitionBy("cell", "part"))).where(F.col("place") <= k + 1)
    found = first.withColumn("place", F.row_number().over(place)).withColumn(
        "radius", F.max("radius").over(W.partitionBy("cell"))).where(F.col("place") <= k + 1).toPandas()
    radius = np.full(len(pivots), -1.0)
    radius[found["cell"].to_numpy()] = found["radius"].to_numpy()
    return Cells(pivots, radius, _stack(found["v"], size) if len(found) else np.zeros((0, size), np.int64), found["id"].to_numpy())


def _with_bounds(queries: DataFrame, cells: Cells, k: int, size: int) -> DataFrame:
    """Queries with their cell and a score that their k-th best reaches at least (null if the summaries are too few)."""
    def bound(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = _stack(batch["v"], size)
            scores = products(x, cells.sample).astype(np.float64)
            scores[batch["id"].to_numpy()[:, None] == cells.sample_id[None, :]] = -np.inf
            least = np.partition(scores, -k, axis=1)[:, -k] if scores.shape[1] >= k else np.full(len(x), -np.inf)
            far = _distances(x, cells.pivots)
            yield pd.DataFrame({"id": batch["id"], "v": batch["v"], "cell": far.argmin(1), "far": far.min(1),
                                "norm": np.sqrt((x.astype(np.float64) ** 2).sum(1)),
                                "least": [None if np.isinf(s) else int(s) for s in least]})

    return queries.mapInPandas(bound, "id long, v binary, cell long, far double, norm double, least long")


def _needed(vectors: DataFrame, groups: Groups, cells: Cells, chunks: int, size: int) -> DataFrame:
    """Each vector once per group that it may matter to: group, chunk, id, v."""
    def replicate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = groups.centre.astype(np.float64)
        cell_top = own @ cells.pivots.T.astype(np.float64) + groups.radius[:, None] * np.sqrt(
            (cells.pivots.astype(np.float64) ** 2).sum(1)) + groups.norm[:, None] * np.maximum(cells.radius, 0)
        reach = cell_top * (1 + 1e-9) + 1e-3 >= groups.bound[:, None]
        for batch in batches:
            for start in range(0, len(batch), 2048):
                part = batch.iloc[start:start + 2048]
                x = _stack(part["v"], size)
                cell = _distances(x, cells.pivots).argmin(1)
                floating = x.astype(np.float64)
                top = floating @ own.T
                top += np.sqrt((floating**2).sum(1))[:, None] * groups.radius[None, :]
                ok = (top + np.abs(top) * 1e-9 + 1e-3 >= groups.bound[None, :]) & reach[:, cell].T
                row, group = np.nonzero(ok)
                yield pd.DataFrame({"grp": groups.key[group], "chunk": part["chunk"].to_numpy()[row],
                                    "id": part["id"].to_numpy()[row], "v": part["v"].to_numpy()[row]})

    dealt = vectors.withColumn("chunk", F.pmod(F.xxhash64("id"), F.lit(chunks)))
    return dealt.mapInPandas(replicate, "grp long, chunk long, id long, v binary")


def search(df: DataFrame, is_query, k: int = 20, scale: float = 64.0, key: str = "vec_id",
           vector: str = "embedding") -> DataFrame:
    """The k highest scores of every row that ``is_query`` selects: query_id, rank, vec_id, score.

    A score is the inner product of the vectors' floor(scale * x); ties go to the smaller vec_id. Candidates are all
    rows but those with the query's own id; with fewer than k of them all are returned. Rows whose id or vector is
    null, or whose vector holds a null or non-finite component, take no part. Shorter vectors count as padded with
    zeros. An id that occurs on several rows is several candidates, and as a query it is answered once, for its first
    row in the order of its components. Scores must fit into 64 bits. An empty table gives no rows.
    """
    spark = df.sparkSession
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("x"),
                     F.coalesce(is_query, F.lit(False)).alias("asks")).where("id IS NOT NULL AND x IS NOT NULL")
    size = max(1, rows.agg(F.max(F.size("x"))).first()[0] or 0)

    def clean(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            packed = [None if (w := whole(x, scale, size)) is None else w.tobytes() for x in batch["x"]]
            yield pd.DataFrame({"id": batch["id"], "v": packed, "asks": batch["asks"]}).dropna()

    vectors = stored(rows.mapInPandas(clean, "id long, v binary, asks boolean"), "vectors")
    n = vectors.count()
    n_pivots = min(MAX_PIVOTS, max(8, n // ROWS_PER_PIVOT))
    # Pivots: a bounded sample, the first rows by a hash of the id; copies of one vector count once.
    first = vectors.withColumn("h", F.xxhash64("id")).orderBy("h", "v").limit(4 * n_pivots).select("v").toPandas()["v"]
    pivots = _stack(list(dict.fromkeys(bytes(v) for v in first))[:n_pivots] or [np.zeros(size, np.int64).tobytes()], size)
    cells = _summaries(vectors.select("id", "v"), pivots, k, size)

    asking = vectors.where("asks").groupBy("id").agg(F.min("v").alias("v"))
    queries = stored(_with_bounds(asking, cells, k, size), "queries")
    counts = {r["cell"]: r["n"] for r in queries.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    block = max(QUERY_BLOCK, -(-sum(counts.values()) // MAX_GROUPS))
    parts = F.element_at(F.create_map(*[F.lit(x) for c, m in counts.items() for x in (c, -(-m // block))]),
                         F.col("cell")) if counts else F.lit(1)
    grouped = queries.withColumn("grp", F.col("cell") * F.lit(1 << 32) + F.pmod(F.xxhash64("id"), parts))
    bounds = grouped.groupBy("grp").agg(
        F.first("cell").alias("cell"), F.max("far").alias("far"), F.max("norm").alias("norm"),
        F.min(F.coalesce(F.col("least").cast("double"), F.lit(float("-inf")))).alias("least")).toPandas()
    at = bounds["cell"].to_numpy().astype(int)
    groups = Groups(bounds["grp"].to_numpy(), pivots[at], bounds["far"].to_numpy(float),
                    bounds["norm"].to_numpy(float), bounds["least"].to_numpy(float))

    chunks = max(1, -(-n // CHUNK_ROWS))
    data = _needed(vectors.select("id", "v"), groups, cells, chunks, size)
    # Groups meet every chunk of the data; a chunk number follows from the id, so no cell is too large for a task.
    asked = grouped.select("grp", "id", "v", "least", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long"))).alias("chunk"))

    def solve(asks: pd.DataFrame, data: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(asks) and len(data):
            ids, x = data["id"].to_numpy(), _stack(data["v"], size)
            for start in range(0, len(asks), QUERY_BLOCK):
                part = asks.iloc[start:start + QUERY_BLOCK]
                scores = products(_stack(part["v"], size), x)
                for query, least, row in zip(part["id"], part["least"], scores):
                    fit = ids != query
                    if not pd.isna(least):
                        fit &= row >= least
                    own, own_ids = row[fit], ids[fit]
                    if len(own) > k:
                        near = own >= np.partition(own, -k)[-k]
                        own, own_ids = own[near], own_ids[near]
                    order = np.lexsort((own_ids, -own))[:k]
                    out.append(pd.DataFrame({"query_id": query, "vec_id": own_ids[order], "score": own[order]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")

    solved = asked.groupBy("grp", "chunk").cogroup(data.groupBy("grp", "chunk")).applyInPandas(
        solve, "query_id long, vec_id long, score long")
    best = W.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return solved.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
