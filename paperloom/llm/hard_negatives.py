"""Hard negatives by threshold joins with an inverted index.

Each anchor has windows of scores: one without limits for its positives, later one
per positive, between two shares of the positive's score. A window asks for its
``k`` best rows.

Rows are met in chunks. A chunk's index holds, per group of dimensions, the rows
with an entry there; dimensions come by falling energy, and a row leaves out the
weak ones at the end as long as the lengths of what is left out, multiplied, stay
below the threshold. Partial scores are gathered group by group; a pair is dropped
once its partial score plus the product of the remaining lengths misses the
threshold, and what is left is scored exactly in whole numbers. Thresholds start
near the highest possible score and are lowered until the windows are full or reach
their lower ends; a full window's last score is the threshold from then on.

Anchors are broadcast in tiles of at most about TILE rows; the rows stay where they
are, and each task hands over at most ``k`` rows a window. A share of the rows (by a
hash, SEEDS) goes first, and the scores that fill a window there bound the rest.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paperloom.llm.graph import written

#: Anchors broadcast at once, anchors and rows compared at once, rows per file.
TILE, ANCHORS, CHUNK, FILE = 16384, 256, 8192, 1 << 18
#: Dimensions per group of the index; one row in SEEDS goes first.
GROUP, SEEDS = 8, 32
#: Thresholds tried in turn, as shares of the highest possible score.
LEVELS = (0.85, 0.7, 0.55, 0.4, 0.25, 0.1, -1.0)
#: Rounding slack of the bounds, as a share of the product of lengths.
SLACK = 1e-9
LOWEST, HIGHEST = -(2**62), 2**62


@dataclass
class Tile:
    """Anchors and their windows: ``low`` and ``high`` (both met) and the row that each window is for."""

    ids: np.ndarray
    labels: list[str]
    v: np.ndarray
    low: np.ndarray
    high: np.ndarray
    partner: np.ndarray
    score: np.ndarray


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Vectors of a list column, padded with zeros."""
    offsets = column.offsets.to_numpy()
    sizes = np.diff(offsets)
    flat = column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
    out = np.zeros((len(column), dim), np.int64)
    out[np.arange(dim) < sizes[:, None]] = flat
    return out


class Index:
    """Rows of a chunk by groups of dimensions, strongest group first."""

    def __init__(self, v: np.ndarray):
        self.v = v
        f = v.astype(np.float64)
        self.order = np.argsort(-(f**2).sum(0), kind="stable")
        self.f = f[:, self.order]
        self.edges = np.arange(0, v.shape[1] + GROUP, GROUP).clip(max=v.shape[1])
        self.rest = self.lengths(self.f)
        self.length = self.rest[:, 0]

    def lengths(self, f: np.ndarray) -> np.ndarray:
        """Length of what is left of each row from each group on; the last is 0."""
        tail = np.cumsum((f**2)[:, ::-1], axis=1)[:, ::-1]
        return np.sqrt(np.hstack([tail, np.zeros((len(f), 1))])[:, self.edges])

    def join(self, anchors: np.ndarray, threshold: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Anchor, row and score of all pairs whose score reaches the anchor's threshold."""
        f = anchors.astype(np.float64)[:, self.order]
        rest = self.lengths(f)
        slack = SLACK * rest[:, 0] * (self.length.max() + 1) + 1e-6
        bar = threshold - slack
        # Groups of a row that are indexed: beyond them no anchor can gain its threshold on its own.
        held = (self.rest * rest.max(0) >= bar.min()).sum(1) if bar.min() > 0 else np.full(len(self.f), len(self.edges) - 1)
        held = np.minimum(held, len(self.edges) - 1)
        rows = np.argsort(-held, kind="stable")
        held = held[rows]
        rows = rows[: int((held > 0).sum())]  # the others reach no threshold at all
        held = held[: len(rows)]
        part = np.zeros((len(f), len(rows)))
        for g in range(len(self.edges) - 1):
            n = int((held > g).sum())  # posting list of the group: the first n rows
            if not n:
                break
            a, b = self.edges[g], self.edges[g + 1]
            part[:, :n] += f[:, a:b] @ self.f[rows[:n], a:b].T
            if g & (g + 1) == 0:  # after 1, 2, 4, ... groups
                left = part[:, :n] + rest[:, g + 1, None] * self.rest[rows[:n], g + 1]
                alive = (left >= bar[:, None]).any(0)
                keep = np.concatenate([np.flatnonzero(alive), np.arange(n, len(rows))])
                rows, held, part = rows[keep], held[keep], part[:, keep]
        bound = part + rest[:, held] * self.rest[rows, held]
        ai, ri = np.nonzero(bound >= bar[:, None])
        ri = rows[ri]
        score = np.concatenate([(anchors[ai[i : i + CHUNK]] * self.v[ri[i : i + CHUNK]]).sum(1) for i in range(0, len(ai), CHUNK)] or [np.zeros(0, np.int64)])
        keep = score >= threshold[ai]
        return ai[keep], ri[keep], score[keep]


class Windows:
    """The best rows so far of every window of a tile."""

    def __init__(self, tile: Tile, k: int, same: bool):
        self.tile, self.k, self.same = tile, k, same
        self.codes: dict[str, int] = {}
        self.label = self.code(tile.labels)
        self.low = tile.low.copy()
        self.length = np.sqrt((tile.v.astype(np.float64) ** 2).sum(1))
        self.best = [np.zeros((3, 0), np.int64) for _ in range(tile.low.shape[1])]  # anchor, score, row id

    def code(self, labels: list[str]) -> np.ndarray:
        return np.array([self.codes.setdefault(x, len(self.codes)) for x in labels], np.int64)

    def meet(self, ids: np.ndarray, labels: list[str], v: np.ndarray) -> None:
        labels, index = self.code(labels), Index(v)
        reach = self.length * index.length.max() * (1 + SLACK) + 1e-6
        asked = np.isin(self.label, labels) if self.same else np.ones(len(reach), bool)
        asked &= ((self.low <= self.tile.high) & (self.low <= reach[:, None])).any(1)
        asked = np.flatnonzero(asked)
        for i in range(0, len(asked), ANCHORS):
            self._lower(asked[i : i + ANCHORS], reach, ids, labels, index)

    def _lower(self, who: np.ndarray, reach: np.ndarray, ids: np.ndarray, labels: np.ndarray, index: Index) -> None:
        """Lower the thresholds of anchors ``who`` until nothing below could enter a window."""
        before = np.full(len(reach), float(HIGHEST) * 2)
        for level in LEVELS:
            open_ = self.low[who] <= self.tile.high[who]
            bottom = np.where(open_, self.low[who], HIGHEST * 2).min(1).astype(np.float64)
            now = np.maximum(bottom, np.floor(reach[who] * level))
            live = now < before[who]
            who, now = who[live], now[live]
            if not len(who):
                return
            ai, ri, score = index.join(self.tile.v[who], now)
            ai = who[ai]
            fit = (score < before[ai]) & (ids[ri] != self.tile.ids[ai]) & ((labels[ri] == self.label[ai]) == self.same)
            self._keep(ai[fit], score[fit], ids[ri[fit]])
            before[who] = now

    def _keep(self, anchor: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        for w, held in enumerate(self.best):
            fit = (score >= self.low[anchor, w]) & (score <= self.tile.high[anchor, w])
            if not fit.any():
                continue
            rows = np.concatenate([held, np.stack([anchor[fit], score[fit], ids[fit]])], axis=1)
            rows = rows[:, np.lexsort((rows[2], -rows[1], rows[0]))]
            place = np.arange(rows.shape[1]) - np.searchsorted(rows[0], rows[0])
            rows, place = rows[:, place < self.k], place[place < self.k]
            self.best[w] = rows
            full = rows[:, place == self.k - 1]
            self.low[full[0], w] = np.maximum(self.low[full[0], w], full[1])

    def result(self) -> pa.RecordBatch:
        sizes = [b.shape[1] for b in self.best]
        window = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        anchor, score, ids = np.concatenate(self.best, axis=1)
        return pa.RecordBatch.from_arrays([pa.array(anchor.astype(np.int32)), pa.array(window), pa.array(ids), pa.array(score)], names=["anchor", "window", "id", "score"])


def _scan(tile, k: int, same: bool):
    """Rows of one partition to the best of each window of the broadcast ``tile``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = None
        for batch in batches:
            for i in range(0, batch.num_rows, CHUNK):
                part = batch.slice(i, CHUNK)
                if found is None:
                    found = Windows(tile.value, k, same)
                found.meet(part.column(0).to_numpy(), part.column(1).to_pylist(), matrix(part.column(2), tile.value.v.shape[1]))
        if found is not None:
            yield found.result()

    return run


def _best(tables: list[DataFrame], tile: Tile, k: int, same: bool) -> DataFrame:
    """``anchor, window, id, score, rank``: the ``k`` first rows of each window of a tile, over all ``tables`` in turn."""
    spark = tables[0].sparkSession
    place = F.row_number().over(W.partitionBy("anchor", "window").orderBy(F.col("score").desc(), "id"))
    out = None
    for rows in tables:
        if out is not None:
            tile = replace(tile, low=tile.low.copy())
            last = out.where(F.col("rank") == k).select("anchor", "window", "score").collect()  # one row a window of the tile
            for r in last:
                tile.low[r["anchor"], r["window"]] = max(tile.low[r["anchor"], r["window"]], r["score"])
        sent = spark.sparkContext.broadcast(tile)
        found = rows.select("id", "label", "v").mapInArrow(_scan(sent, k, same), "anchor int, window int, id long, score long")
        found = found if out is None else found.unionByName(out.drop("rank"))
        out = written(found.withColumn("rank", place).where(F.col("rank") <= k), "windows")
        sent.unpersist()
    return out


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, label: Column, scale: int) -> DataFrame:
    """``id, label, v`` of the rows that take part: id, label and vector without nulls, components finite; repeated rows once."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), label.cast("string").alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    fine = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)).where(fine)
    return rows.withColumn("v", F.transform("v", lambda c: F.floor(F.lit(scale) * c))).distinct()


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, label: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
    scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding", tile: int = TILE,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Scores are inner products of the components, each turned into floor(scale * x);
    shorter vectors count as padded with zeros, and sums must fit 64 bits. Anchors are
    the rows whose ``id`` meets ``is_anchor``. An anchor's positives are its first
    ``positives`` rows of the same label and another id, by falling score, ties by the
    smaller id; for each of them come the first ``negatives`` rows of another label with
    ``low * positive_score <= 100 * negative_score <= high * positive_score``.

    Rows with a null id or label, a null or empty vector or a null or non-finite
    component take no part. Repeated rows count once; different rows of one id are
    each an anchor and each a candidate of others. An anchor without positives, or a
    positive without negatives, gives no row; so does an empty table.
    """
    spark = vectors.sparkSession
    base = written(whole_vectors(vectors, id_col, vector_col, label, scale), "vectors")
    size, dim = base.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(1))).first()
    norm = F.aggregate("v", F.lit(0.0), lambda t, c: t + c * c)
    files = max(spark.sparkContext.defaultParallelism, -(-size // FILE))
    ranged = base.withColumn("norm", norm).repartitionByRange(files, "label", F.col("norm").desc(), "id").drop("norm")
    table = written(ranged.withColumn("seed", F.pmod(F.xxhash64("id"), F.lit(SEEDS)) == 0), "ranged")
    anchors = table.where(is_anchor).select("id", "label", "v")
    tiles = max(1, -(-anchors.count() // tile))
    anchors = written(anchors.withColumn("tile", F.pmod(F.xxhash64("id", "label", "v"), F.lit(tiles))).repartition("tile"), "anchors")
    tables = [table.where("seed"), table.where("not seed")]
    out = None
    for number in range(tiles):
        batch = anchors.where(F.col("tile") == number).orderBy("label", "id").toArrow()  # about `tile` rows
        n = batch.num_rows
        if not n:
            continue
        found = Tile(
            ids=batch["id"].to_numpy(), labels=batch["label"].to_pylist(), v=matrix(batch["v"].combine_chunks(), dim),
            low=np.full((n, 1), LOWEST), high=np.full((n, 1), HIGHEST), partner=np.zeros((n, 1), np.int64), score=np.zeros((n, 1), np.int64),
        )
        first = _best(tables, found, positives, True).toArrow()  # `positives` rows an anchor of the tile
        shape = (n, positives)
        asked = replace(found, low=np.full(shape, HIGHEST), high=np.full(shape, LOWEST), partner=np.zeros(shape, np.int64), score=np.zeros(shape, np.int64))
        at = first["anchor"].to_numpy(), first["rank"].to_numpy() - 1
        points = first["score"].to_numpy()
        asked.partner[at], asked.score[at] = first["id"].to_numpy(), points
        asked.low[at], asked.high[at] = -(-low * points // 100), high * points // 100
        names = pa.table({
            "anchor": np.repeat(np.arange(n, dtype=np.int32), positives), "window": np.tile(np.arange(positives, dtype=np.int32), n),
            "anchor_id": np.repeat(asked.ids, positives), "positive_id": asked.partner.ravel(), "positive_score": asked.score.ravel(),
        })
        rows = _best(tables, asked, negatives, False).join(spark.createDataFrame(names), ["anchor", "window"])
        rows = rows.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    return out
