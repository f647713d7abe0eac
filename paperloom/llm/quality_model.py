"""Quality classifier: hashed word n-gram logistic regression, trained by FTRL-proximal.

A text's features are hashed runs of one and two words, whether two words in a row
are equal, and hashed runs of one, two and three
word shapes (letters and digits folded to a run each, so "THE!!" is "A!!"), with
shares of their kind as values. Labelled texts, a bounded sample of them, are dealt
over a fixed number of shards; each shard takes them in turn with the
follow-the-regularised-leader update, and the models are averaged. A score is one
sparse dot product per text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.llm.bytetext import KEEP, mix, pieces, windows, words

BUCKETS = 1 << 18
SCALE = 8.0
BIAS = BUCKETS
#: FTRL-proximal: learning rate, smoothing, L1 and L2 strength, passes over a shard.
ALPHA, BETA, L1, L2, PASSES = 0.3, 1.0, 0.02, 0.1, 4
SHARDS = 8
#: Labelled texts learned from, about: ids are drawn by hash at the rate that gives so many.
SAMPLE = 6_000

_SHAPE = KEEP.copy()
_SHAPE[97:123] = ord("a")
_SHAPE[65:91] = ord("A")
_SHAPE[48:58] = ord("0")
_SHAPE[128:] = ord("a")
_RUN = np.zeros(256, bool)
_RUN[[ord("a"), ord("A"), ord("0")]] = True


def _features(data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Kinds of features: bucket of each, and where those of each text begin and end."""
    w = words(data, offsets, fold=KEEP)
    shape = _SHAPE[data]
    stay = np.ones(len(shape), bool)
    stay[1:] = ~((shape[1:] == shape[:-1]) & _RUN[shape[1:]])
    stay[offsets[:-1][offsets[:-1] < len(shape)]] = True
    s = words(shape[stay], np.concatenate([[0], np.cumsum(stay)])[offsets], fold=KEEP)
    out = []
    for kind, (x, n) in enumerate(((w, 1), (w, 2), (s, 1), (s, 2), (s, 3))):
        grams = mix(windows(x.hash, n) + np.uint64(kind)) if len(x.hash) >= n else np.zeros(0, np.uint64)
        ends = np.maximum(x.first[:-1], x.first[1:] - n + 1)
        out.append(((grams % np.uint64(BUCKETS)).astype(np.int64), np.stack([x.first[:-1], ends])))
        if kind == 1:
            # The same pairs once more, by whether both words are equal.
            out.append(((w.hash[1:] == w.hash[:-1]).astype(np.int64), out[-1][1]))
    return out


def _scored(weights: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.full(len(offsets) - 1, float(weights[BIAS]))
    for buckets, (a, b) in _features(data, offsets):
        sums = np.concatenate([[0.0], np.cumsum(weights[buckets], dtype=np.float64)])
        a, b = np.minimum(a, len(buckets)), np.minimum(b, len(buckets))
        total += SCALE * (sums[b] - sums[a]) / np.maximum(b - a, 1)
    return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _scores(weights: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in pieces(batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(_scored(weights, data, offsets))], names=["id", "score"])

    return run


def _filter(weights: np.ndarray, text: str, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in pieces(batch.column(text)):
                yield batch.slice(lo, hi - lo).filter(pa.array(_scored(weights, data, offsets) >= least))

    return run


def ftrl(examples: list[tuple[np.ndarray, np.ndarray, float]], passes: int = PASSES) -> np.ndarray:
    """Weights after ``passes`` over examples of distinct indices, values and a label of 0 or 1."""
    z, n = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)

    def weight(i):
        zi = z[i]
        w = -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(n[i])) / ALPHA + L2)
        return np.where(np.abs(zi) <= L1, 0.0, w)

    for _ in range(passes):
        for i, x, y in examples:
            w = weight(i)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -30, 30))) - y) * x
            n_new = n[i] + g * g
            z[i] += g - (np.sqrt(n_new) - np.sqrt(n[i])) / ALPHA * w
            n[i] = n_new
    return weight(np.arange(BUCKETS + 1))


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of whole shards, ordered by shard, to each shard's weights."""
    shards: dict[int, list] = {}
    for batch in batches:
        shard, label = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for lo, hi, data, offsets in pieces(batch.column(2)):
            kinds = _features(data, offsets)
            for d in range(hi - lo):
                index, value = [np.array([BIAS])], [np.ones(1)]
                for buckets, (a, b) in kinds:
                    i, c = np.unique(buckets[a[d] : b[d]], return_counts=True)
                    index.append(i)
                    value.append(SCALE * c / max(1, b[d] - a[d]))
                i, at = np.unique(np.concatenate(index), return_inverse=True)
                x = np.bincount(at, np.concatenate(value))
                shards.setdefault(shard[lo + d], []).append((i, x, float(label[lo + d])))
    for examples in shards.values():
        w = ftrl(examples)
        used = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(w[used])], names=["bucket", "weight"])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", learnable: Column | None = None, sample: int = SAMPLE) -> np.ndarray:
    """Weights by bucket, the bias last.

    Rows of ``labels`` with a null id or label teach nothing; several labels of an
    id count as their majority, 1 on a tie. ``learnable`` is a condition on
    ``labels``. Without any labelled text all weights are 0.
    """
    said = labels.where(learnable) if learnable is not None else labels
    said = said.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("double").alias("y")).dropna()
    said = said.groupBy("id").agg((F.avg("y") >= 0.5).cast("double").alias("y"))
    rate = min(1.0, sample / max(1, said.count()))
    drawn = said.where(F.pmod(F.xxhash64("id", F.lit(7)), F.lit(1 << 30)) < int(rate * (1 << 30)))
    # About ``sample`` ids of 16 bytes: a fixed bound, so the texts need not move.
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(drawn), "id")
    dealt = texts.select(F.pmod(F.xxhash64("id", F.lit(8)), F.lit(SHARDS)).cast("int").alias("shard"), "y", "text", "id")
    dealt = dealt.repartition(SHARDS, "shard").sortWithinPartitions("shard", F.xxhash64("id"), "text").select("shard", "y", "text")
    models = dealt.mapInArrow(_learn, "bucket long, weight double").withColumn("model", F.lit(1))
    mean = models.groupBy("bucket").agg((F.sum("weight") / SHARDS).alias("weight")).toArrow()  # BUCKETS rows at most
    weights = np.zeros(BUCKETS + 1, np.float32)
    weights[mean.column("bucket").to_numpy()] = mean.column("weight").to_numpy()
    return weights


def score(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, score`` per row; a null or empty text scores by the bias alone."""
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(_scores(weights), "id long, score double")


def keep_good(docs: DataFrame, weights: np.ndarray, text_col: str = "text", least: float = 0.7) -> DataFrame:
    """Rows of ``docs`` that score ``least`` or more, with all their columns; no row moves."""
    return docs.mapInArrow(_filter(weights, text_col, least), docs.schema)
