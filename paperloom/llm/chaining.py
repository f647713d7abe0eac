"""Substring dedup by collinear chaining of shared k-mer seeds.

Seeds are the winnowed K-word runs of each text: every run of K + WINDOW - 1 words
that two texts share gives both a common seed. A seed that several documents hold
ties each of them to the one with the smallest id, so a passage in n documents gives
n - 1 matches, not all pairs. Matches of a pair of documents on one diagonal merge
into segments; a Fenwick tree over the other text's positions finds the best chain of
segments that keep order in both, less a cost per word of gap. Chain ends and gaps
are then aligned word by word, which lets a passage run over edits.

Where a text repeats within a window its smallest gram is the same all along. Each
such periodic stretch is one run with its length, and runs of the same words are
matched as a whole, by their lengths.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paperloom.llm.bytetext import FOLD, lean, mix, pieces, windows, words
from paperloom.llm.graph import written

#: Words of a seed, seeds per winnowing window, words aligned beyond a chain's end, largest gap within a chain.
K, WINDOW, REACH, GAP = 8, 16, 32, 30
#: Cost per word of gap on either side; score of a match and of an edit in an alignment; lowest score of an accepted gap.
GAP_COST, MATCH, EDIT, LOSS = 0.25, 1, -2, -40
#: Words of a passage that counts.
LEAST = 50


def winnow(grams: np.ndarray) -> np.ndarray:
    """Positions of the smallest gram of every window, the first of equal ones in a window."""
    if len(grams) > WINDOW:
        view = np.lib.stride_tricks.sliding_window_view(grams, WINDOW)
        return np.unique(view.argmin(1) + np.arange(len(view)))
    return np.array([grams.argmin()]) if len(grams) else np.zeros(0, np.int64)


def periods(hashes: np.ndarray, at: np.ndarray, step: np.ndarray) -> list[tuple[int, int, int, int]]:
    """Distinct stretches ``first, lo, hi, d`` of period ``d`` words around seeds ``at`` that repeat ``step`` words before.

    ``first`` is the earliest place in the stretch that looks like the seed.
    """
    out = set()
    for d in np.unique(step).tolist():
        differ = np.flatnonzero(hashes[:-d] != hashes[d:])
        for q in (at[step == d] - d).tolist():
            k = int(np.searchsorted(differ, q))
            lo = int(differ[k - 1]) + 1 if k else 0
            hi = int(differ[k]) + d if k < len(differ) else len(hashes)
            out.add((lo + (q - lo) % d, lo, hi, d))
    return sorted(out)


def text_seeds(hashes: np.ndarray, grams: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Seeds of one text: hashes, positions, and rows ``left, size, period`` of a run, else zeros.

    A seed equal to the one before is told apart by the words between them, so it
    drops out only where the text is periodic. Such a stretch has the grams that
    hold the word before it and the word after it as seeds, each with one WINDOW
    words further in, and, from ``least`` words on, is one run of ``size`` words,
    ``left`` of them before its position.
    """
    at = winnow(grams)
    value = grams[at]
    again = np.flatnonzero(value[1:] == value[:-1]) + 1
    if not len(again):
        return value, at, np.zeros((len(at), 3), np.int32)
    step = at[again] - at[again - 1]
    between = np.where(step > K, grams[np.maximum(at[again] - K, 0)], np.uint64(0))
    key = value.copy()
    key[again] = mix(value[again] + mix(between + step.astype(np.uint64)))
    fresh = np.ones(len(at), bool)
    fresh[1:] = key[1:] != key[:-1]
    heads = fresh[again]
    edges, runs = [], []
    for first, lo, hi, d in periods(hashes, at[again[heads]], step[heads]):
        if hi - lo >= K + WINDOW:
            edges += [(x, y) for x, y in ((lo - 1, lo + WINDOW), (hi - K + 1, hi - K - WINDOW)) if 0 <= x < len(grams)]
        if hi - lo >= least:
            runs.append((first, first - lo, hi - lo, d))
    edge, inner = np.array(edges, np.int64).reshape(-1, 2).T
    runs = np.array(runs, np.int64).reshape(-1, 4)
    values = np.concatenate([key[fresh], grams[edge], mix(grams[edge] + mix(grams[inner])), mix(grams[runs[:, 0]] + runs[:, 3].astype(np.uint64))])
    spots = np.concatenate([at[fresh], edge, inner, runs[:, 0]])
    extra = np.zeros((len(spots), 3), np.int32)
    extra[len(spots) - len(runs) :] = runs[:, 1:]
    return values, spots, extra


def _seeds(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in pieces(batch.column(1)):
                w = words(data, offsets, fold=FOLD)
                grams = windows(w.hash, K)
                found = []
                for d in range(hi - lo):
                    a, b = int(w.first[d]), int(w.first[d + 1])
                    found.append(text_seeds(w.hash[a:b], grams[a : max(a, b - K + 1)], least))
                values, spots, extra = (np.concatenate(x) for x in zip(*found))
                ids = batch.column(0).slice(lo, hi - lo).take(pa.array(np.repeat(np.arange(hi - lo), [len(x[1]) for x in found])))
                columns = [pa.array(values.view(np.int64)), pa.array(spots.astype(np.int32)), *(pa.array(np.ascontiguousarray(x)) for x in extra.T)]
                yield pa.RecordBatch.from_arrays([ids, *columns], names=["id", "h", "pos", "left", "size", "period"])

    return lean(run)


NOTHING = (float("-inf"), -1)


class Fenwick:
    """Largest value over ranges; a value may be taken back by putting NOTHING."""

    def __init__(self, size: int):
        self.value = [NOTHING] * (size + 1)
        self.best = [NOTHING] * (size + 1)

    def put(self, i: int, value: tuple[float, int]) -> None:
        i += 1
        self.value[i] = value
        while i < len(self.best):
            top, step = self.value[i], 1
            while step < i & -i:  # the nodes below
                top = max(top, self.best[i - step])
                step *= 2
            self.best[i] = top
            i += i & -i

    def over(self, low: int, high: int) -> tuple[float, int]:
        """Over positions ``low`` to ``high - 1``."""
        out = NOTHING
        while high > low:
            if high - (high & -high) >= low:
                out = max(out, self.best[high])
                high -= high & -high
            else:
                out = max(out, self.value[high])
                high -= 1
        return out


def segments(pos: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Matches sorted by position to rows ``d0, d1, r0, r1``: runs on one diagonal."""
    diagonal = pos - other
    new = np.flatnonzero((np.diff(diagonal) != 0) | (np.diff(pos) > K + WINDOW)) + 1
    a, b = np.concatenate([[0], new]), np.concatenate([new, [len(pos)]]) - 1
    return np.stack([pos[a], pos[b] + K, other[a], other[b] + K], 1)


def chains(segs: np.ndarray) -> list[list[int]]:
    """Collinear chains, best first, each segment in one of them.

    A segment follows the best one that ends at most GAP words ahead of it in
    both texts: the tree holds those within GAP in the first text, by their end
    in the second, of which a range is asked.
    """
    n = len(segs)
    if n == 1:
        return [[0]]
    rows = segs.tolist()
    ends = sorted(range(n), key=lambda i: rows[i][1])
    places = sorted(range(n), key=lambda i: (rows[i][3], i))
    rank = {j: at for at, j in enumerate(places)}
    stops = [rows[j][3] for j in places]
    tree, score, prior, put, gone = Fenwick(n), [0.0] * n, [-1] * n, 0, 0
    for i in sorted(range(n), key=lambda i: rows[i]):
        d0, d1, r0, r1 = rows[i]
        while put < n and rows[ends[put]][1] <= d0:
            j = ends[put]
            tree.put(rank[j], (score[j] + GAP_COST * (rows[j][1] + rows[j][3]), j))
            put += 1
        while gone < put and rows[ends[gone]][1] < d0 - GAP:
            tree.put(rank[ends[gone]], NOTHING)
            gone += 1
        value, j = tree.over(bisect_left(stops, r0 - GAP), bisect_right(stops, r0))
        gain = value - GAP_COST * (d0 + r0)
        score[i] = d1 - d0
        if j >= 0 and gain > 0:
            score[i], prior[i] = score[i] + gain, j
    used, out = [False] * n, []
    for i in sorted(range(n), key=lambda i: -score[i]):
        chain = []
        while i >= 0 and not used[i]:
            used[i] = True
            chain.append(i)
            i = prior[i]
        if chain:
            out.append(chain[::-1])
    return out


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Matches sorted by ``id, other, pos`` to one row per segment of a chain."""

    def solve(ids, parts, out):
        pos, other = (np.concatenate(x) for x in zip(*parts))
        segs = segments(pos.astype(np.int64), other.astype(np.int64))
        for c, chain in enumerate(chains(segs)):
            for k, i in enumerate(chain):
                gap = segs[chain[k + 1], [0, 2]] - segs[i, [1, 3]] if k + 1 < len(chain) else (-1, -1)
                out.append((*ids, c, k, *segs[i], *gap))

    names = ["id", "other", "chain", "k", "d0", "d1", "r0", "r1", "gap_d", "gap_r"]
    give = lambda out: pa.RecordBatch.from_arrays([pa.array(x) for x in np.array(out, np.int64).T], names=names)
    at, parts = None, []
    for batch in batches:
        ids, others, pos, spot = (batch.column(i).to_numpy() for i in range(4))
        cuts = np.concatenate([[0], np.flatnonzero((np.diff(ids) != 0) | (np.diff(others) != 0)) + 1, [len(ids)]])
        out = []
        for a, b in zip(cuts[:-1], cuts[1:]):
            if a == b:
                continue
            if (ids[a], others[a]) != at:
                if parts:
                    solve(at, parts, out)
                at, parts = (ids[a], others[a]), []
            parts.append((pos[a:b], spot[a:b]))
        if out:
            yield give(out)
    if parts:
        out = []
        solve(at, parts, out)
        yield give(out)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with asked spots ``pos * 2 + right`` to REACH word hashes on that side, nearest first; 0 beyond the text."""
    for batch in batches:
        for lo, hi, data, offsets in pieces(batch.column(1)):
            w = words(data, offsets, fold=FOLD)
            short = (w.hash >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
            rows, spots, values = [], [], []
            for d in range(hi - lo):
                asked = np.array(batch.column(2)[lo + d].as_py(), np.int64)
                a, b = int(w.first[d]), int(w.first[d + 1])
                reach = np.arange(REACH)
                at = np.where((asked & 1)[:, None] == 1, (asked >> 1)[:, None] + reach, (asked >> 1)[:, None] - 1 - reach)
                fine = (at >= 0) & (at < b - a)
                got = np.where(fine, short[np.clip(a + at, 0, max(0, len(short) - 1))] if len(short) else 0, 0).astype(np.uint32)
                rows += [lo + d] * len(asked)
                spots.append(asked)
                values += [x.tobytes() for x in got]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(np.concatenate(spots)), pa.array(values, pa.binary())], names=["id", "spot", "slice"])


def align(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Alignments of many pairs of word rows from their common start.

    Gives the words of ``a`` in the best-scoring beginning, and the score of
    aligning the first ``size_a`` words with the first ``size_b``.
    """
    n = len(a)
    best, at, whole = np.zeros(n, np.int32), np.zeros(n, np.int32), np.full(n, np.iinfo(np.int32).min, np.int32)
    row = [np.full(n, EDIT * j, np.int32) for j in range(REACH + 1)]
    for j in range(REACH + 1):
        hit = (size_a == 0) & (size_b == j)
        whole[hit] = row[j][hit]
    for i in range(1, REACH + 1):
        last, row = row, [np.full(n, EDIT * i, np.int32)]
        for j in range(1, REACH + 1):
            same = (a[:, i - 1] == b[:, j - 1]) & (a[:, i - 1] != 0)
            cell = np.maximum(last[j - 1] + np.where(same, MATCH, EDIT).astype(np.int32), np.maximum(last[j], row[j - 1]) + np.int32(EDIT))
            row.append(cell)
            up = cell > best
            best[up], at[up] = cell[up], i
        for j in range(REACH + 1):
            hit = (size_a == i) & (size_b == j)
            if hit.any():
                whole[hit] = row[j][hit]
    return at, whole


def _align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sides of segments with both slices to how far the passage goes on there."""
    for batch in batches:
        if not batch.num_rows:
            continue
        mine, theirs = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(-1, REACH) for c in ("mine", "theirs"))
        gap_d, gap_r = (batch.column(c).to_numpy() for c in ("gap_d", "gap_r"))
        at, whole = np.zeros(len(mine), np.int32), np.full(len(mine), LOSS - 1, np.int32)
        for i in range(0, len(mine), 4096):
            s = slice(i, i + 4096)
            at[s], whole[s] = align(mine[s], theirs[s], np.maximum(gap_d[s], 0), np.maximum(gap_r[s], 0))
        joined = (gap_d >= 0) & (whole >= LOSS)
        more = np.where(joined, gap_d, at)
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("id", "other", "chain", "k", "d0", "d1", "right")), pa.array(more.astype(np.int64))], names=["id", "other", "chain", "k", "d0", "d1", "right", "more"])


def _run_spans(runs: DataFrame, least: int) -> DataFrame:
    """``id, other, start, end``: periodic stretches that the smallest document with such a stretch covers.

    A stretch is covered but for the words at its ends that no ``least`` words of
    the other one reach in step with its period.
    """
    heads = runs.groupBy("h").agg(F.min(F.struct("id", -F.col("size"), "left")).alias("head"), F.max("id").alias("last")).where("head.id < last")
    heads = heads.select("h", F.col("head.id").alias("other"), (-F.col("head.col2")).alias("whole"), F.col("head.left").alias("before"))
    met = runs.join(heads.hint("merge"), "h").where("id <> other")
    after = lambda size, left: (size - left - K) % F.col("period")
    lost = lambda shift: F.when(F.col("whole") - shift >= least, 0).otherwise(F.col("period") - shift)
    head = lost(F.pmod(F.col("before") - F.col("left"), F.col("period")))
    tail = lost(F.pmod(after(F.col("whole"), F.col("before")) - after(F.col("size"), F.col("left")), F.col("period")))
    start = F.col("pos") - F.col("left")
    spans = met.select("id", "other", (start + head).cast("long").alias("start"), (start + F.col("size") - tail).cast("long").alias("end"))
    return spans.where(F.col("end") - F.col("start") >= least)


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """``id, start, end, other_id``: spans of words of ``id`` that repeat a passage of a document with a smaller id.

    Words are lower-cased (A-Z) runs of non-blank characters, counted from 0; the
    span is ``start`` to ``end`` (exclusive), at least ``least`` words, and
    ``other_id`` the document that the longest part of it repeats. Null and short
    texts have none, nor do rows with a null id; repeated rows and rows that share
    an id never match each other. A passage that recurs only within one document
    does not count.
    """
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where("id is not null")
    seeds = written(source.mapInArrow(_seeds(least), "id long, h long, pos int, left int, size int, period int"), "seeds")
    runs = _run_spans(seeds.where("size > 0"), least)
    seeds = seeds.where("size = 0").select("id", "h", "pos")
    # The smallest document of each shared seed; merge joins at every size.
    heads = seeds.groupBy("h").agg(F.min(F.struct("id", "pos")).alias("head"), F.max("id").alias("last")).where("head.id < last")
    heads = heads.select("h", F.col("head.id").alias("other"), F.col("head.pos").alias("spot"))
    matches = seeds.join(heads.hint("merge"), "h").where("id <> other").select("id", "other", "pos", "spot")
    ordered = matches.repartition("id").sortWithinPartitions("id", "other", "pos", "spot")
    segs = written(ordered.mapInArrow(lean(_chain), "id long, other long, chain long, k long, d0 long, d1 long, r0 long, r1 long, gap_d long, gap_r long"), "segments")
    none = F.lit(-1).cast("long")
    side = lambda right, d, r, gd, gr: F.struct(F.lit(right).alias("right"), (F.col(d) * 2 + right).alias("spot"), (F.col(r) * 2 + right).alias("spot2"), gd.alias("gap_d"), gr.alias("gap_r"))
    sides = segs.select("id", "other", "chain", "k", "d0", "d1", F.explode(F.array(side(0, "d0", "r0", none, none), side(1, "d1", "r1", F.col("gap_d"), F.col("gap_r")))).alias("s"))
    sides = sides.select("id", "other", "chain", "k", "d0", "d1", "s.*")
    # Each asked spot of a document once, at most two per word of it.
    asked = sides.select("id", "spot").union(sides.select(F.col("other"), F.col("spot2"))).distinct().groupBy("id").agg(F.collect_list("spot").alias("asked"))
    slices = written(source.join(asked.hint("merge"), "id").mapInArrow(lean(_slices), "id long, spot long, slice binary"), "slices")
    slices = slices.groupBy("id", "spot").agg(F.max("slice").alias("slice"))
    both = sides.join(slices.withColumnRenamed("slice", "mine").hint("merge"), ["id", "spot"])
    theirs = written(slices, "slices-by-spot").select(F.col("id").alias("other"), F.col("spot").alias("spot2"), F.col("slice").alias("theirs"))
    both = both.join(theirs.hint("merge"), ["other", "spot2"])
    found = both.mapInArrow(lean(_align), "id long, other long, chain long, k long, d0 long, d1 long, right int, more long")
    spans = found.groupBy("id", "other", "chain", "k", "d0", "d1").agg(F.max(F.when(F.col("right") == 0, F.col("more"))).alias("l"), F.max(F.when(F.col("right") == 1, F.col("more"))).alias("r"))
    spans = spans.select("id", "other", (F.col("d0") - F.coalesce("l", F.lit(0))).alias("start"), (F.col("d1") + F.coalesce("r", F.lit(0))).alias("end"))
    spans = spans.union(runs)
    order = W.partitionBy("id").orderBy("start", F.col("end").desc(), "other")
    reach = F.max("end").over(order.rowsBetween(W.unboundedPreceding, -1))
    fresh = (F.col("start") > F.coalesce(reach, F.lit(-1))).cast("int")
    islands = spans.withColumn("fresh", fresh).withColumn("island", F.sum("fresh").over(order))
    merged = islands.groupBy("id", "island").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.max(F.struct(F.col("end") - F.col("start"), -F.col("other"))).alias("o"))
    return merged.where(F.col("end") - F.col("start") >= least).select("id", "start", "end", (-F.col("o.col2")).alias("other_id"))


SPANS = "__passage_spans"


def _cut(text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text_col).to_pylist()
            for i, (text, gone) in enumerate(zip(texts, batch.column(SPANS).to_pylist())):
                if not gone or not text:
                    continue
                raw = np.frombuffer(text.encode("utf-8"), np.uint8)
                w = words(raw, np.array([0, len(raw)]))
                out, last = [], 0
                for s in sorted(gone, key=lambda s: s["start"]):
                    if s["end"] > len(w.start):
                        continue
                    out.append(raw[last : w.start[s["start"]]].tobytes())
                    last = w.end[s["end"] - 1]
                out.append(raw[last:].tobytes())
                texts[i] = b"".join(out).decode("utf-8")
            at = batch.schema.get_field_index(text_col)
            kept = batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))
            yield kept.drop_columns([SPANS])

    return lean(run)


def drop_passages(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the repeated passages cut out of their texts; all rows and columns stay.

    Of rows that share an id each loses the spans that lie within its text.
    """
    gone = spans.groupBy(F.col("id").alias(id_col)).agg(F.collect_list(F.struct("start", "end")).alias(SPANS))
    rows = docs.join(gone, id_col, "left").select(*docs.columns, SPANS)
    return rows.mapInArrow(_cut(text_col), docs.schema)
