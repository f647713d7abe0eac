"""Quality rules with cross-document line frequency.

Lines are normalised (A-Z to lower case, digits to 0, blanks collapsed) and
hashed; a line that more than ``limit`` distinct documents of one host hold is
boilerplate there and is taken out, and a document left with too small a share of
its words is rejected, besides those that fail the rules on the text alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.bytetext import BLANK, FOLD, KEEP, NEWLINE, mix, pieces, powers, windows, words
from paperloom.llm.graph import written

NORMAL = FOLD.copy()
NORMAL[48:58] = 48
SYMBOL = np.zeros(256, bool)
SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
SPAN = 8

_SCHEMA = "id long, host string, mark long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, lines array<struct<h: long, words: long>>"


def _per_text(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(mask)])[offsets])


def _repeats(grams: np.ndarray) -> int:
    """Words in windows that occur more than once."""
    _, at, times = np.unique(grams, return_inverse=True, return_counts=True)
    if len(times) == len(grams):
        return 0
    hit = np.zeros(len(grams) + SPAN, np.int64)
    again = np.flatnonzero(times[at] > 1)
    np.add.at(hit, again, 1)
    np.add.at(hit, again + SPAN, -1)
    return int(np.count_nonzero(np.cumsum(hit)))


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, data, offsets in pieces(batch.column(2)):
            n = hi - lo
            w = words(data, offsets, fold=KEEP)
            grams = windows(w.hash, SPAN)
            inside = ~BLANK[data]
            chars = _per_text(inside & ((data & 0xC0) != 0x80), offsets)
            symbols = _per_text(SYMBOL[data], offsets)
            raw = words(data, offsets, fold=KEEP, separators=NEWLINE)
            plain = words(data, offsets, fold=NORMAL)
            # Words of each line: lines are runs between line feeds, words lie within one.
            line = np.searchsorted(raw.start, plain.start, "right") - 1
            begin = np.flatnonzero(np.diff(line, prepend=-1))
            place = np.arange(len(line)) - np.repeat(begin, np.diff(np.append(begin, len(line))))
            size = int(place.max()) + 1 if len(place) else 0
            normal = mix(np.add.reduceat(plain.hash * powers(size)[place], begin)) if len(begin) else np.zeros(0, np.uint64)
            count = np.diff(np.append(begin, len(line)))
            used = line[begin]
            border = np.searchsorted(used, raw.first)
            dup, rep, marks, hs, ws, ends = [], [], [], [], [], [0]
            for d in range(n):
                a, b = int(w.first[d]), int(w.first[d + 1])
                rep.append(_repeats(grams[a : b - SPAN + 1]) if b - a >= SPAN else 0)
                lines = slice(border[d], border[d + 1])
                dup.append(len(used[lines]) - len(np.unique(raw.hash[used[lines]])))
                marks.append((w.hash[a:b] * powers(b - a)[: b - a]).sum(dtype=np.uint64))
                kinds, at = np.unique(normal[lines], return_inverse=True)
                hs.append(kinds)
                ws.append(np.bincount(at, count[lines], len(kinds)).astype(np.int64))
                ends.append(ends[-1] + len(kinds))
            entries = pa.StructArray.from_arrays([pa.array(np.concatenate(hs).view(np.int64)), pa.array(np.concatenate(ws))], names=["h", "words"])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(lo, n),
                    batch.column(1).slice(lo, n),
                    pa.array(np.array(marks, np.uint64).view(np.int64)),
                    *(pa.array(np.asarray(x), pa.int64()) for x in (np.diff(w.first), chars, symbols, dup, rep)),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), entries),
                ],
                names=["id", "host", "mark", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lines"],
            )


def line_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", limit: int = 20, least_percent: int = 30) -> DataFrame:
    """Per row: ``id``, the measures, ``base_failed``, ``removed`` (hashes of lines taken out), ``left_words``, ``kept``.

    ``kept`` is false if the base rules fail (fewer than 20 words, or over 30
    percent of them in repeated 8-word windows) or if less than ``least_percent``
    of the words are left. A null text has no words and fails; a null host is a
    host of its own. A document counts once for a line however often it or its
    row repeats. ``strip_lines`` makes the texts.
    """
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("host"), F.col(text_col).cast("string").alias("text"))
    measured = written(source.mapInArrow(_measure, _SCHEMA), "line-measures")
    lines = measured.select("id", "host", "mark", F.explode("lines").alias("l")).select("id", "host", "mark", F.col("l.h").alias("h"), F.col("l.words").alias("words"))
    # Distinct documents per host and line: equal ids meet first, then a partial count per line.
    spread = lines.groupBy("host", "h", "id").agg(F.lit(1).alias("one")).groupBy("host", "h").agg(F.count("*").alias("docs"))
    common = written(spread.where(F.col("docs") > limit).select("host", "h"), "common-lines")
    hits = lines.join(common, ["host", "h"]).groupBy("id", "host", "mark").agg(F.collect_set(F.struct("h", "words")).alias("hits"))
    hits = hits.select("id", "host", "mark", F.col("hits.h").alias("removed"), F.aggregate("hits", F.lit(0).cast("long"), lambda t, x: t + x["words"]).alias("gone"))
    m = measured.drop("lines").alias("m")
    same = (F.col("m.id").eqNullSafe(F.col("x.id"))) & (F.col("m.host") == F.col("x.host")) & (F.col("m.mark") == F.col("x.mark"))
    out = m.join(hits.alias("x"), same, "left").select("m.*", F.coalesce("x.removed", F.array().cast("array<long>")).alias("removed"), (F.col("n_words") - F.coalesce("gone", F.lit(0))).alias("left_words"))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return out.withColumn("base_failed", failed).withColumn("kept", ~failed & (100 * F.col("left_words") >= least_percent * F.col("n_words")))


def _strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for text, gone in zip(batch.column(1), batch.column(2)):
            drop, text = set(gone.as_py() or ()), text.as_py()
            if drop and text:
                rows = text.split("\n")
                column = pa.array(rows, pa.string())
                marks = []
                for lo, hi, data, offsets in pieces(column):
                    w = words(data, offsets, fold=NORMAL)
                    for d in range(hi - lo):
                        h = w.hash[w.first[d] : w.first[d + 1]]
                        marks.append(int(mix((h * powers(len(h))[: len(h)]).sum(dtype=np.uint64, keepdims=True)).view(np.int64)[0]) if len(h) else None)
                text = "\n".join(r for r, m in zip(rows, marks) if m not in drop)
            texts.append(text)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["id", "text"])


def strip_lines(docs: DataFrame, verdicts: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, text`` of the kept documents without their removed lines."""
    gone = verdicts.where("kept").groupBy("id").agg(F.array_distinct(F.flatten(F.collect_set("removed"))).alias("removed"))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).join(gone, "id")
    return rows.select("id", "text", "removed").mapInArrow(_strip, "id long, text string")
