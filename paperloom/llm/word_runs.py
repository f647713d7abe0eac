"""Periodic runs in the word sequence of each text.

A run is a stretch of words with smallest period q, at least 2q long, that no
neighbour extends. Every run holds a Lyndon root: for one of an order of the words
and its reverse, the longest Lyndon word that starts at some place of the run has
the run's period. Phase one of a grouping suffix sorter gives these words: groups
of suffixes are taken in descending order, and each suffix of a group lengthens
the context of the nearest place to its left that is still to come. When a group's
turn is there, its context is the longest Lyndon word of its places. Each Lyndon
word is a root candidate, extended to both sides by longest common extensions.

Words are whole numbers of a vocabulary, never hashes, and extensions compare names
of substrings of doubled lengths, so nothing rests on chance. A word of a run stands
in a window of six words that occurs twice (at least six words, and a whole period,
recur one period on), so stretches without such windows are not sorted. The windows
are found by hash; a collision there only adds a stretch.

Work is per document and needs no shuffle. Memory follows the piece of texts in hand
(about PIECE bytes) or the longest text, some 400 bytes for each word of its
repeating stretches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.bytetext import PIECE, mix, windows

#: A run has at least this many words; half of it is the window that must occur twice.
LEAST = 12


def lyndon_lengths(ranks: np.ndarray) -> np.ndarray:
    """Length of the longest Lyndon word that starts at each place of a sequence of ranks.

    Places stand in ``order`` by group; a group is named by its first position there
    and has a context, the words that its places share. ``left`` and ``right`` chain
    the places whose group is still to come.
    """
    n = len(ranks)
    sort = np.argsort(ranks, kind="stable")
    first = np.flatnonzero(np.diff(ranks[sort], prepend=ranks[sort[:1]] - 1))
    sizes = np.zeros(n, np.int64)
    sizes[first] = np.diff(first, append=n)
    group, spot = np.empty(n, np.int64), np.empty(n, np.int64)
    group[sort], spot[sort] = np.repeat(first, sizes[first]), np.arange(n)
    order, group, spot, size = sort.tolist(), group.tolist(), spot.tolist(), sizes.tolist()
    context, length = [1] * n, [0] * n
    left, right = [*range(-1, n)], [*range(1, n + 1), 0]
    end = n
    while end:
        at = group[order[end - 1]]
        width, told, reached, times = context[at], [], -1, 0
        for place in sorted(order[at:end]) if end - at > 1 else order[at:end]:
            length[place] = width
            before, after = left[place], right[place]
            right[before], left[after] = after, before
            if before == reached:
                times += 1
            else:
                if reached >= 0:
                    told.append((times, group[reached], reached))
                reached, times = before, 1
        if reached >= 0:
            told.append((times, group[reached], reached))
        if len(told) > 1:
            told.sort(reverse=True)
        i = 0
        while i < len(told):
            times, old, _ = told[i]
            top, j = old + size[old], i
            while j < len(told) and told[j][0] == times and told[j][1] == old:
                top -= 1
                place, other = told[j][2], order[top]
                here = spot[place]
                order[here], order[top] = other, place
                spot[other], spot[place] = here, top
                j += 1
            longer = context[old] + times * width
            size[old] = top - old
            size[top], context[top] = j - i, longer
            for _, _, place in told[i:j]:
                group[place] = top
            i = j
        end = at
    return np.array(length, np.int64)


class Extensions:
    """Longest common extensions of a sequence by names of its substrings of lengths 1, 2, 4 and so on."""

    def __init__(self, values: np.ndarray):
        names = np.unique(values, return_inverse=True)[1]
        self.names = [names]
        step = 1
        while len(names) > step and names.max() + 1 < len(names):
            pairs = names[:-step] * np.int64(len(values) + 1) + names[step:]
            names = np.unique(pairs, return_inverse=True)[1]
            self.names.append(names)
            step *= 2

    def right(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words that agree from ``a`` and from ``b`` on; ``a < b``."""
        total = np.zeros(len(a), np.int64)
        for k in range(len(self.names) - 1, -1, -1):
            names = self.names[k]
            i, j = a + total, b + total
            inside = j < len(names)
            same = inside & (names[np.where(inside, i, 0)] == names[np.where(inside, j, 0)])
            total[same] += 1 << k
        return total

    def left(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words that agree up to ``a`` and up to ``b``, both included; ``a < b``."""
        total = np.zeros(len(a), np.int64)
        for k in range(len(self.names) - 1, -1, -1):
            names = self.names[k]
            i, j = a - total - (1 << k) + 1, b - total - (1 << k) + 1
            inside = i >= 0
            same = inside & (names[np.where(inside, i, 0)] == names[np.where(inside, j, 0)])
            total[same] += 1 << k
        return total


def repeating_stretches(values: np.ndarray, first: np.ndarray, least: int = LEAST) -> list[tuple[int, int]]:
    """Stretches (begin, end) that windows of ``least / 2`` words found twice in their text cover.

    ``first[d]:first[d + 1]`` are the words of text ``d``. No run of ``least`` words stands outside them.
    """
    size = least // 2
    if len(values) < size:
        return []
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    grams = windows(mix(values.astype(np.uint64) + mix(text.astype(np.uint64))), size)
    order = np.argsort(grams)
    equal = np.flatnonzero(grams[order[1:]] == grams[order[:-1]])
    again = np.zeros(len(grams), bool)
    again[order[equal]] = again[order[equal + 1]] = True
    again &= text[: len(grams)] == text[size - 1 :]
    spots = np.flatnonzero(again)
    delta = np.zeros(len(values) + 1, np.int64)
    delta[spots] += 1
    np.subtract.at(delta, spots + size, 1)
    inside = np.cumsum(delta[:-1]) > 0
    breaks = inside.copy()
    breaks[1:] &= ~inside[:-1]
    edges = first[first < len(values)]
    breaks[edges] |= inside[edges]
    begin = np.flatnonzero(breaks)
    stop = inside.copy()
    stop[:-1] &= ~inside[1:]
    last = edges[edges > 0] - 1
    stop[last] |= inside[last]
    end = np.flatnonzero(stop) + 1
    long = end - begin >= least
    return list(zip(begin[long].tolist(), end[long].tolist()))


def runs_of(values: np.ndarray, first: np.ndarray, least: int = LEAST) -> np.ndarray:
    """Rows (start, length, period) of all runs of ``least`` words or more, by start, then period."""
    stretches = repeating_stretches(values, first, least)
    if not stretches:
        return np.zeros((0, 3), np.int64)
    gap = int(values.max()) + 1
    parts, places, roots, at = [], [], [], 0
    for number, (begin, end) in enumerate(stretches):
        ranks = values[begin:end]
        parts += [ranks, np.array([gap + number])]  # a word of its own ends each stretch
        for lengths in (lyndon_lengths(ranks), lyndon_lengths(-ranks)):
            fit = np.flatnonzero(2 * lengths <= end - begin)
            places.append(fit + at)
            roots.append(lengths[fit])
        at += end - begin + 1
    extensions = Extensions(np.concatenate(parts))
    found = np.unique(np.stack([np.concatenate(places), np.concatenate(roots)]), axis=1)
    place, period = found
    start = place - extensions.left(place - 1, place + period - 1)
    length = place + period + extensions.right(place, place + period) - start
    keep = length >= np.maximum(least, 2 * period)
    found = np.unique(np.stack([start[keep], period[keep], length[keep]]), axis=1)
    sizes = np.array([end - begin + 1 for begin, end in stretches])
    starts = np.cumsum(sizes) - sizes
    begins = np.array([begin for begin, _ in stretches])
    back = np.searchsorted(starts, found[0], "right") - 1
    return np.stack([found[0] - starts[back] + begins[back], found[2], found[1]], axis=1)


def _scan(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "").cast(pa.large_binary())
            ends = np.cumsum(pc.binary_length(texts).to_numpy())
            lo = 0
            while lo < len(texts):
                hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + PIECE, "right")))
                yield _piece(batch.column(0).slice(lo, hi - lo), texts.slice(lo, hi - lo).to_pylist(), least)
                lo = hi

    return run


def _piece(ids: pa.Array, texts: list[bytes], least: int) -> pa.RecordBatch:
    words = [text.split() for text in texts]  # bytes split at the blank and at 9 to 13
    vocabulary: dict[bytes, int] = {}
    number = vocabulary.setdefault
    values = np.fromiter((number(w, len(vocabulary)) for ws in words for w in ws), np.int64)
    first = np.concatenate([[0], np.cumsum([len(ws) for ws in words])]).astype(np.int64)
    found = runs_of(values, first, least)
    cuts = np.searchsorted(found[:, 0], first)
    collapsed = []
    for d, ws in enumerate(words):
        mine = found[cuts[d] : cuts[d + 1]]
        if len(mine):
            mine[:, 0] -= first[d]
            delta = np.zeros(len(ws) + 1, np.int64)
            np.add.at(delta, mine[:, 0] + mine[:, 2], 1)
            np.add.at(delta, mine[:, 0] + mine[:, 1], -1)
            ws = [ws[i] for i in np.flatnonzero(np.cumsum(delta[:-1]) == 0)]
        collapsed.append(b" ".join(ws))
    fields = [pa.array(found[:, i]) for i in range(3)]
    runs = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.StructArray.from_arrays(fields, ["start", "length", "period"]))
    n_words = pa.array(np.diff(first))
    return pa.RecordBatch.from_arrays([ids, n_words, runs, pa.array(collapsed, pa.binary()).cast(pa.string())], names=["id", "n_words", "runs", "collapsed"])


def word_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """``id, n_words, runs, collapsed`` of every row of ``docs``.

    ``runs`` are structs of start (word number from 0), length and period, by start and
    then period; ``collapsed`` is the text with one blank between words and without the
    words that a run holds after its first period. Words are what stands between blanks
    and the characters 9 to 13. A null or empty text has no words, no runs and an empty
    ``collapsed``; a null id stays null; repeated rows give a row each; an empty table
    gives none; further columns of ``docs`` are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_scan(least), "id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
