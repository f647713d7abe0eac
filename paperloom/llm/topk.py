"""Exact top-k inner products over norm-sorted vectors.

Vectors are range-partitioned by descending length into blocks. Each query first
meets the block of the longest vectors, which gives it a floor: its k-th best score
so far. By Cauchy-Schwarz only blocks whose longest vector times the query's length
reaches the floor can matter, a prefix of the blocks. Within a block vectors come
by descending length, and a partial sum over the leading coordinates of an SVD
rotation plus the product of the residual lengths bounds each score; what passes is
scored exactly in whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paperloom.llm.graph import written

#: Vectors per block and queries per tile; blocks at most MAX_BLOCKS, then they grow and are streamed.
BLOCK, TILE, MAX_BLOCKS = 8192, 2048, 1024
#: Candidates bounded at once, leading coordinates kept, vectors that the rotation is fitted on.
STEP, LEAD, FIT = 1024, 16, 4096
#: Slack of the rotated bounds for rounding, as a share of the product of lengths.
SLACK = 1e-9


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """``id, v`` (components as floor(scale * x)) without null ids, null or empty vectors, and null or non-finite components; repeated rows once."""
    x = F.col("v")
    fine = x.isNotNull() & (F.size(x) > 0) & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.where(F.col("id").isNotNull() & fine)
    return rows.select("id", F.transform("v", lambda c: F.floor(F.lit(scale) * c)).alias("v")).distinct()


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.values.to_numpy(zero_copy_only=False)[column.offsets[0].as_py() : column.offsets[-1].as_py()]
    out = np.zeros((len(column), dim), np.int64)
    out[np.repeat(np.arange(len(column)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def rotation(sample: np.ndarray) -> np.ndarray:
    """Right singular vectors, strongest first: an orthogonal matrix whatever the sample."""
    return np.linalg.svd(np.vstack([sample, np.zeros((1, sample.shape[1]))]), full_matrices=True)[2].T


class _Tile:
    """The queries of one tile and their best candidates so far."""

    def __init__(self, ids: np.ndarray, q: np.ndarray, floor: np.ndarray, turn: np.ndarray, k: int):
        self.ids, self.q, self.turn, self.k = ids, q, turn, k
        self.floor = floor.astype(np.float64)
        self.length = np.sqrt((q.astype(np.float64) ** 2).sum(1))
        r = q @ turn
        self.lead = r[:, :LEAD]
        self.rest = np.sqrt((r[:, LEAD:] ** 2).sum(1))
        self.best = np.zeros((3, 0), np.int64)  # query row, score, candidate id

    def meet(self, ids: np.ndarray, c: np.ndarray) -> None:
        length = np.sqrt((c.astype(np.float64) ** 2).sum(1))
        slack = SLACK * (1 + self.length * (length.max() + 1))
        live = np.flatnonzero(self.length * length.max() + slack >= self.floor)
        if not len(live):
            return
        r = c @ self.turn
        bound = self.lead[live] @ r[:, :LEAD].T + np.outer(self.rest[live], np.sqrt((r[:, LEAD:] ** 2).sum(1)))
        qi, ci = np.nonzero(bound + slack[live, None] >= self.floor[live, None])
        qi = live[qi]
        if len(qi) > len(live) * len(ids) // 8 and max(float(np.abs(self.q).max()), 1) * float(np.abs(c).max()) * c.shape[1] < 2**53:
            # Whole numbers below 2 ** 53 add up exactly in floating point.
            score = (self.q.astype(np.float64) @ c.T.astype(np.float64))[qi, ci].astype(np.int64)
        else:
            score = np.concatenate([(self.q[qi[i : i + 65536]] * c[ci[i : i + 65536]]).sum(1) for i in range(0, len(qi), 65536)] or [np.zeros(0, np.int64)])
        keep = (score >= self.floor[qi]) & (ids[ci] != self.ids[qi])
        rows = np.concatenate([self.best, np.stack([qi[keep], score[keep], ids[ci[keep]]])], 1)
        rows = rows[:, np.lexsort((rows[2], -rows[1], rows[0]))]
        first = np.searchsorted(rows[0], np.arange(len(self.ids)))
        place = np.arange(rows.shape[1]) - first[rows[0]]
        self.best = rows[:, place < self.k]
        full = self.best[:, place[place < self.k] == self.k - 1]
        self.floor[full[0]] = np.maximum(self.floor[full[0]], full[1])

    def result(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(self.ids[self.best[0]]), pa.array(self.best[2]), pa.array(self.best[1])], names=["query_id", "id", "score"])


def _tiles(turn: np.ndarray, k: int):
    """Rows sorted by ``block, tile, side, length`` to the best candidates of each query in its tile."""
    dim = len(turn)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, tile, queries = None, None, []
        for batch in batches:
            key = np.stack([batch.column(i).to_numpy() for i in range(3)])
            cuts = np.concatenate([[0], np.flatnonzero((np.diff(key) != 0).any(0)) + 1, [key.shape[1]]])
            for a, b in zip(cuts[:-1], cuts[1:]):
                unit = (key[0, a], key[1, a])
                if unit != at:
                    if tile is not None:
                        yield tile.result()
                    at, tile, queries = unit, None, []
                ids, floor = (batch.column(i).slice(a, b - a).to_numpy() for i in (3, 4))
                v = _matrix(batch.column(5).slice(a, b - a), dim)
                if key[2, a] == 0:
                    queries.append((ids, v, floor))
                    continue
                if tile is None:
                    if not queries:
                        continue
                    tile = _Tile(*(np.concatenate(x) for x in zip(*queries)), turn, k)
                for i in range(0, b - a, STEP):
                    tile.meet(ids[i : i + STEP], v[i : i + STEP])
        if tile is not None:
            yield tile.result()

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 64) -> DataFrame:
    """``query_id, rank, id, score``: the ``k`` highest inner products of each query, ties to the smaller id.

    Queries are the rows whose ``id`` meets ``is_query``; their candidates are all
    rows of another id. Shorter vectors count as padded with zeros. Rows that
    ``whole_vectors`` leaves out take no part; an empty table gives no rows.
    """
    base = written(whole_vectors(vectors, id_col, vector_col, scale).withColumn("norm", F.aggregate("v", F.lit(0.0), lambda t, c: t + c * c)), "vectors")
    size, dim = base.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    dim = max(1, dim)
    blocks = min(MAX_BLOCKS, max(1, -(-size // BLOCK)))
    ranged = base.repartitionByRange(blocks, F.col("norm").desc(), F.col("id")).withColumn("block", F.spark_partition_id())
    table = written(ranged, "blocks")
    longest = sorted((r["block"], r["m"]) for r in table.groupBy("block").agg(F.max("norm").alias("m")).collect())  # one row per block
    numbers = {b: i for i, (b, _) in enumerate(longest)}
    steps = F.array(*[F.lit(m**0.5) for _, m in longest]) if longest else F.array(F.lit(0.0))
    dense = F.create_map(*[F.lit(x) for b, i in numbers.items() for x in (b, i)]) if numbers else F.create_map(F.lit(0), F.lit(0))
    table = table.withColumn("block", F.element_at(dense, F.col("block")))
    fit = [r["v"] for r in base.limit(FIT).collect()]  # FIT vectors: they turn the axes and change no result
    sample = np.zeros((max(1, len(fit)), dim))
    for i, v in enumerate(fit):
        sample[i, : len(v)] = v
    turn = rotation(sample)
    queries = table.where(is_query)
    tiles = max(1, -(-queries.count() // TILE))
    queries = queries.select("id", "v", "norm", F.pmod(F.xxhash64("id"), F.lit(tiles)).cast("int").alias("tile"))

    def meet(asked: DataFrame, held: DataFrame) -> DataFrame:
        """asked: block, tile, id, floor, v; held: block, tile, id, v, norm."""
        left = asked.select("block", "tile", F.lit(0).alias("side"), "id", "floor", "v", F.lit(0.0).alias("norm"))
        right = held.select("block", "tile", F.lit(1).alias("side"), "id", F.lit(0).cast("long").alias("floor"), "v", "norm")
        rows = left.union(right).repartition("block", "tile").sortWithinPartitions("block", "tile", "side", F.col("norm").desc(), "id")
        return rows.select("block", "tile", "side", "id", "floor", "v").mapInArrow(_tiles(turn, k), "query_id long, id long, score long")

    least = F.lit(-(2**62)).cast("long")
    every = F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))).alias("tile")
    longest_held = table.where("block = 0").select("block", every, "id", "v", "norm")
    first = written(meet(queries.select(F.lit(0).alias("block"), "tile", "id", least.alias("floor"), "v"), longest_held), "first-block")
    floors = first.groupBy("query_id").agg(F.count("*").alias("c"), F.min("score").alias("s")).where(F.col("c") >= k)
    known = queries.join(floors, queries["id"] == floors["query_id"], "left").withColumn("floor", F.coalesce("s", least))
    reach = F.size(F.filter(steps, lambda m: m * F.sqrt("norm") * (1 + 1e-9) + 1e-6 >= F.col("floor")))
    later = known.withColumn("reach", reach).where("reach > 1").select(F.explode(F.sequence(F.lit(1), F.col("reach") - 1)).alias("block"), "tile", "id", "floor", "v")
    wanted = later.select("block", "tile").distinct()
    found = first.union(meet(later, table.where("block > 0").join(wanted, "block")))
    place = F.row_number().over(W.partitionBy("query_id").orderBy(F.col("score").desc(), "id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")
