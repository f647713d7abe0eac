"""N-gram Jaccard join with signature trees.

Top of the tree: nodes addressed by content. A text's shingles are dealt by hash
into ``k`` parts, ``k`` greater than the largest symmetric difference that two
linked sets of its size class may have; two linked sets then agree on a whole
part and meet under the node keyed by it (pigeonhole, so no link is lost).
Below: within one such node a bulk-loaded tree over its sets, each node holding
the OR of their token bitmaps and their size range, walked against itself; a pair
of nodes goes when its greatest possible overlap is too small, or when all of it
is connected already. What remains is compared exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paperloom.llm.bytetext import lean, mix, pieces, shingle_set, windows, words
from paperloom.llm.graph import components, written

#: Shingles of one task's tree; nodes with more are dealt over several tasks.
CHUNK_TOKENS = 2_000_000
#: One text in SAMPLED is looked at to find keys that very many texts hold.
SAMPLED = 256
FANOUT = 16
_U = np.uint64


@lru_cache(None)
def size_class(c: int) -> tuple[int, int]:
    """Smallest and largest set size of class ``c``; each class is half as wide again as its smallest size."""
    low = 1 if c == 0 else size_class(c - 1)[1] + 1
    return low, max(low, math.ceil(low * 1.5) - 1)


@lru_cache(None)
def parts(c: int, percent: int) -> tuple[int, int]:
    """Number of parts of class ``c`` and how many empty ones a set may leave unnamed; 0 parts if only equal sets link."""
    low, high = size_class(c)
    apart = 2 * high * (100 - percent) // (100 + percent)
    if apart == 0:
        return 0, 0
    spare = 1 + math.ceil(1.3 * (apart + 1) * math.exp(-low * percent / 100 / (apart + 1)))
    return apart + 1 + spare, spare


@lru_cache(None)
def classes(n: int, percent: int) -> tuple[int, ...]:
    """The class of size ``n`` and the higher ones that hold a possible partner."""
    c = 0
    while size_class(c)[1] < n:
        c += 1
    out = [c]
    while 100 * n >= percent * size_class(out[-1] + 1)[0]:
        out.append(out[-1] + 1)
    return tuple(out)


def signature_keys(tokens: np.ndarray, percent: int) -> np.ndarray:
    """Keys of the top nodes that a set belongs to."""
    out = []
    place, value = mix(tokens + _U(11)) >> _U(32), mix(tokens + _U(12))
    for c in classes(len(tokens), percent):
        k, spare = parts(c, percent)
        if not k:
            continue
        total = np.zeros(k, np.uint64)
        np.add.at(total, (place % _U(k)).astype(np.int64), value)
        named = np.arange(k, dtype=np.uint64)
        if np.count_nonzero(total == 0) <= spare:
            named, total = named[total != 0], total[total != 0]
        # 48 bits are enough: keys only bring candidates together.
        out.append(mix(mix(total + _U((c + 1) * 0x9E3779B97F4A7C15 % 2**64)) + named) >> _U(16))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _marks(n: int):
    """Size and fingerprint of each text's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in pieces(batch.column(1)):
                w = words(data, offsets)
                grams = windows(w.hash, n)
                sets = [shingle_set(w, grams, d, n) for d in range(hi - lo)]
                marks = np.array([(mix(s + _U(1)).sum(dtype=np.uint64), mix(s + _U(2)).sum(dtype=np.uint64)) for s in sets], np.uint64).view(np.int64)
                sizes = pa.array([len(s) for s in sets], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), sizes, pa.array(marks[:, 0]), pa.array(marks[:, 1])], names=["id", "n", "f1", "f2"])

    return lean(run)


def _keys(n: int, percent: int):
    """One row per text and top node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in pieces(batch.column(1)):
                w = words(data, offsets)
                grams = windows(w.hash, n)
                keys = [signature_keys(s, percent) if len(s := shingle_set(w, grams, d, n)) else s for d in range(hi - lo)]
                ids = batch.column(0).take(pa.array(np.repeat(np.arange(lo, hi), [len(k) for k in keys])))
                yield pa.RecordBatch.from_arrays([ids, pa.array(np.concatenate(keys).view(np.int64))], names=["id", "key"])

    return lean(run)


def packed(tokens: np.ndarray) -> bytes:
    """The upper 48 bits of each hash, in order: enough to compare two sets."""
    return tokens.view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, 2:] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return np.ascontiguousarray(out).view(np.uint64).ravel() >> _U(16)


def _ship(n: int):
    """Texts with their ``units`` to one row per unit with the text's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in pieces(batch.column(1)):
                w = words(data, offsets)
                grams = windows(w.hash, n)
                sets = [packed(shingle_set(w, grams, d, n)) for d in range(hi - lo)]
                units = batch.column(2).slice(lo, hi - lo)
                owner = np.repeat(np.arange(hi - lo), units.value_lengths().to_numpy(zero_copy_only=False))
                load = np.cumsum([len(sets[d]) for d in owner])
                flat = units.flatten()
                for part in np.split(np.arange(len(owner)), np.flatnonzero(np.diff(load // (8 << 20))) + 1):
                    if len(part):
                        mine = owner[part]
                        fields = [flat.field(i).slice(part[0], len(part)) for i in range(4)]
                        ids = batch.column(0).take(pa.array(lo + mine))
                        yield pa.RecordBatch.from_arrays([fields[0], fields[1], ids, fields[2], fields[3], pa.array([sets[d] for d in mine], pa.binary())], names=["top", "chunk", "id", "label", "side", "tokens"])

    return lean(run)


def bitmap(tokens: np.ndarray, bits: int) -> np.ndarray:
    """Words of the bitmap of a set, ``bits`` a power of two."""
    flags = np.zeros(bits, bool)
    flags[(tokens & _U(bits - 1)).astype(np.int64)] = True
    return np.packbits(flags, bitorder="little").view(np.uint64)


def bitmap_bits(size: int) -> int:
    """Bits of the bitmap that goes ahead of a set of ``size`` tokens: eight a token or more."""
    return 1 << max(8, (8 * size - 1).bit_length())


def folded(words: np.ndarray) -> np.ndarray:
    """A bitmap of half as many bits."""
    return words[: len(words) // 2] | words[len(words) // 2 :]


def _sketches(n: int):
    """Texts with their ``units`` to one row per unit with the size and the bitmap of the text's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in pieces(batch.column(1)):
                w = words(data, offsets)
                grams = windows(w.hash, n)
                sets = [shingle_set(w, grams, d, n) for d in range(hi - lo)]
                maps = [bitmap(s, bitmap_bits(len(s))).tobytes() for s in sets]
                units = batch.column(2).slice(lo, hi - lo)
                owner = np.repeat(np.arange(hi - lo), units.value_lengths().to_numpy(zero_copy_only=False))
                load = np.cumsum([len(maps[d]) for d in owner])
                flat = units.flatten()
                for part in np.split(np.arange(len(owner)), np.flatnonzero(np.diff(load // (8 << 20))) + 1):
                    if len(part):
                        mine = owner[part]
                        fields = [flat.field(i).slice(part[0], len(part)) for i in range(4)]
                        ids = batch.column(0).take(pa.array(lo + mine))
                        sizes = pa.array([len(sets[d]) for d in mine], pa.int32())
                        columns = [fields[0], fields[1], ids, fields[2], fields[3], sizes, pa.array([maps[d] for d in mine], pa.binary())]
                        yield pa.RecordBatch.from_arrays(columns, names=["top", "chunk", "id", "label", "side", "n", "bitmap"])

    return lean(run)


class SignatureTree:
    """Sets in size order, by their bitmaps and sizes; leaves of up to FANOUT sets, then nodes of up to FANOUT nodes."""

    def __init__(self, maps: np.ndarray, size: np.ndarray):
        over = size - np.bitwise_count(maps).sum(1).astype(np.int64)
        span = np.arange(len(maps) + 1)
        self.levels = [(maps, size, size, over, span)]
        while len(self.levels[-1][0]) > 1:
            maps, low, high, over, span = self.levels[-1]
            cuts = np.arange(0, len(maps), FANOUT)
            self.levels.append((np.bitwise_or.reduceat(maps, cuts, 0), np.minimum.reduceat(low, cuts), np.maximum.reduceat(high, cuts), np.maximum.reduceat(over, cuts), np.append(span[cuts], span[-1])))

    def children(self, level: int, node: int) -> np.ndarray:
        return np.arange(node * FANOUT, min((node + 1) * FANOUT, len(self.levels[level - 1][0])))


def possible(a, b, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """For each pair of nodes (i, j): may any set of one reach the threshold with any of the other?

    Common tokens are at most the common bits plus the tokens that share a bit
    with another of their own set, on the side where that is less.
    """
    common = np.bitwise_count(a[0][i] & b[0][j]).sum(1).astype(np.int64) + np.minimum(a[3][i], b[3][j])
    common = np.minimum(common, np.minimum(a[2][i], b[2][j]))
    sizes = (100 * a[2][i] >= percent * b[1][j]) & (100 * b[2][j] >= percent * a[1][i])
    return sizes & ((100 + percent) * common >= percent * (a[1][i] + b[1][j]))


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    common = int(np.count_nonzero(y[at] == x)) if len(y) else 0
    return (100 + percent) * common >= percent * (len(x) + len(y))


def tree_links(left: list[tuple[int, np.ndarray]], right: list[tuple[int, np.ndarray]] | None, percent: int, label: dict[int, int]) -> list[tuple[int, int]]:
    """Links that join what is not yet connected: within ``left``, or from ``left`` to ``right``.

    ``label`` gives a component per id so far. The links returned, together with
    it, connect all that the true links connect.
    """
    if not left or right is not None and not right:
        return []
    order = lambda rows: sorted((r for r in rows if len(r[1])), key=lambda r: (len(r[1]), r[0]))
    a = order(left)
    b = a if right is None else order(right)
    if not a or not b:
        return []
    bits = 1 << max(8, (32 * max(len(a[-1][1]), len(b[-1][1])) - 1).bit_length())
    grown = lambda rows: SignatureTree(np.stack([bitmap(r[1], bits) for r in rows]), np.array([len(r[1]) for r in rows]))
    ta = grown(a)
    tb = ta if right is None else grown(b)
    names: dict[int, int] = {}
    la = np.array([names.setdefault(label.get(r[0], r[0]), len(names)) for r in a])
    lb = la if right is None else np.array([names.setdefault(label.get(r[0], r[0]), len(names)) for r in b])
    out: list[tuple[int, int]] = []
    stack = [(len(ta.levels) - 1, 0, len(tb.levels) - 1, 0)]
    while stack:
        u, i, v, j = stack.pop()
        if u == 0 and v == 0:
            x, y = la[i], lb[j]
            if x != y and linked(a[i][1], b[j][1], percent):
                out.append((a[i][0], b[j][0]))
                la[la == y] = x
                if lb is not la:
                    lb[lb == y] = x
            continue
        span_a, span_b = ta.levels[u][4], tb.levels[v][4]
        spread = la[span_a[i] : span_a[i + 1]]
        if (spread == spread[0]).all() and (lb[span_b[j] : span_b[j + 1]] == spread[0]).all():
            continue
        down_a, down_b = u >= v and u > 0, v >= u and v > 0
        ci = ta.children(u, i) if down_a else np.array([i])
        cj = tb.children(v, j) if down_b else np.array([j])
        pi, pj = np.repeat(ci, len(cj)), np.tile(cj, len(ci))
        if tb is ta and u == v and i == j:
            keep = (pi < pj) | ((pi == pj) & (u - 1 > 0))
            pi, pj = pi[keep], pj[keep]
        ok = possible(ta.levels[u - down_a], tb.levels[v - down_b], pi, pj, percent)
        stack.extend((u - down_a, int(p), v - down_b, int(q)) for p, q in zip(pi[ok][::-1], pj[ok][::-1]))
    return out


def sift(ta: SignatureTree, tb: SignatureTree, percent: int, la: np.ndarray, lb: np.ndarray, ma: np.ndarray, mb: np.ndarray) -> None:
    """Mark the sets of two trees (``ma``, ``mb``) that may reach the threshold with one of another label in the other.

    Node pairs whose sets are all marked, or all of one label, are passed over.
    """
    stack = [(len(ta.levels) - 1, 0, len(tb.levels) - 1, 0)]
    while stack:
        u, i, v, j = stack.pop()
        span_a, span_b = ta.levels[u][4], tb.levels[v][4]
        at, bt = slice(span_a[i], span_a[i + 1]), slice(span_b[j], span_b[j + 1])
        if ma[at].all() and mb[bt].all() or (la[at] == la[at][0]).all() and (lb[bt] == la[at][0]).all():
            continue
        if u == 0 and v == 0:
            if possible(ta.levels[0], tb.levels[0], np.array([i]), np.array([j]), percent)[0]:
                ma[i] = mb[j] = True
            continue
        down_a, down_b = u >= v and u > 0, v >= u and v > 0
        ci = ta.children(u, i) if down_a else np.array([i])
        cj = tb.children(v, j) if down_b else np.array([j])
        pi, pj = np.repeat(ci, len(cj)), np.tile(cj, len(ci))
        if tb is ta and u == v and i == j:
            keep = (pi < pj) | ((pi == pj) & (u - 1 > 0))
            pi, pj = pi[keep], pj[keep]
        ok = possible(ta.levels[u - down_a], tb.levels[v - down_b], pi, pj, percent)
        stack.extend((u - down_a, int(p), v - down_b, int(q)) for p, q in zip(pi[ok], pj[ok]))


def survivors(sizes: np.ndarray, maps: list[bytes], labels: np.ndarray, sides: np.ndarray, percent: int) -> np.ndarray:
    """Which members of a node may link with another of its members, by bitmaps and sizes alone.

    Bitmaps of different lengths meet where the sizes allow a link; the longer ones are folded then.
    """
    kept = np.zeros(len(sizes), bool)
    length = np.array([len(m) for m in maps])
    halves = [sides == 0, sides == 1] if (sides >= 0).any() else [np.ones(len(sizes), bool)] * 2

    def grown(rows: np.ndarray, to: int) -> SignatureTree:
        found = []
        for r in rows:
            words = np.frombuffer(maps[r], np.uint64)
            while 8 * len(words) > to:
                words = folded(words)
            found.append(words)
        return SignatureTree(np.stack(found), sizes[rows])

    def meet(a: np.ndarray, b: np.ndarray, to: int) -> None:
        if not len(a) or not len(b):
            return
        a, b = (x[np.argsort(sizes[x], kind="stable")] for x in (a, b))
        ta = grown(a, to)
        ma = kept[a]
        if len(a) == len(b) and (a == b).all():
            tb, mb = ta, ma
        else:
            tb, mb = grown(b, to), kept[b]
        sift(ta, tb, percent, labels[a], labels[b], ma, mb)
        kept[a] |= ma
        kept[b] |= mb

    lengths = np.unique(length).tolist()
    for x in lengths:
        for y in lengths:
            if x > y and halves[0] is halves[1]:
                continue
            a, b = np.flatnonzero(halves[0] & (length == x)), np.flatnonzero(halves[1] & (length == y))
            if len(a) and len(b) and 100 * sizes[a].max() >= percent * sizes[b].min() and 100 * sizes[b].max() >= percent * sizes[a].min():
                meet(a, b, min(x, y))
    return kept


def _sifted(percent: int):
    """Rows sorted by node (``top, chunk``) to the units that may link with another of their node."""
    names = ["top", "chunk", "id", "label", "side"]

    def solve(rows: list[tuple]) -> list[tuple]:
        label, side, size = (np.array([r[i] for r in rows], np.int64) for i in (3, 4, 5))
        kept = survivors(size, [r[6] for r in rows], label, side, percent)
        return [r[:5] for r, k in zip(rows, kept) if k]

    def units(out: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int32()]
        return pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*out), kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows = None, []
        for batch in batches:
            out, maps = [], batch.column(6)
            for i, row in enumerate(zip(*(batch.column(c).to_pylist() for c in range(6)))):
                if row[:2] != at:
                    if rows:
                        out += solve(rows)
                    at, rows = row[:2], []
                rows.append((*row, maps[i].as_py()))
            if out:
                yield units(out)
        if rows and (out := solve(rows)):
            yield units(out)

    return lean(run)


def _walk(percent: int):
    """Rows sorted by node (``top, chunk, part``) to links; a node's rows are held one node at a time."""

    def solve(rows) -> list[tuple[int, int]]:
        label = {r[0]: r[2] for r in rows}
        left = [(r[0], r[1]) for r in rows if r[3] <= 0]
        right = [(r[0], r[1]) for r in rows if r[3] == 1]
        return tree_links(left, right if rows[-1][3] >= 0 else None, percent, label)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows = None, []
        for batch in batches:
            tops, chunks, ids, labels, sides = (batch.column(c).to_pylist() for c in (0, 1, 2, 3, 4))
            tokens, out = batch.column(5), []
            for r, key in enumerate(zip(tops, chunks)):
                if key != at:
                    if rows:
                        out += solve(rows)
                    at, rows = key, []
                rows.append((ids[r], unpacked(tokens[r].as_py()), labels[r], sides[r]))
            if out:
                yield _edges(out)
        if rows:
            yield _edges(solve(rows))

    return lean(run)


def _edges(out: list[tuple[int, int]]) -> pa.RecordBatch:
    pairs = np.array(out, np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def _solved(work: DataFrame, source: DataFrame, n: int, percent: int) -> DataFrame:
    """Links of the units ``top, chunk, id, label, side``. A text is read once for all its units, at most one per key of it.

    Bitmaps and sizes go ahead: a node's trees over them tell which members may link
    with another at all, and only the sets of those are sent after.
    """
    unit = "top long, chunk string, id long, label long, side int"

    def sent(units: DataFrame, send, schema: str) -> DataFrame:
        per = units.groupBy("id").agg(F.collect_list(F.struct("top", F.col("chunk").cast("string").alias("chunk"), "label", "side")).alias("units"))
        rows = source.join(per.hint("merge"), "id").mapInArrow(send, schema)
        return rows.repartition("top", "chunk").sortWithinPartitions("top", "chunk", "side", "id")

    left = written(sent(work, _sketches(n), f"{unit}, n int, bitmap binary").mapInArrow(_sifted(percent), unit), "survivors")
    return sent(left, _ship(n), f"{unit}, tokens binary").mapInArrow(_walk(percent), "a long, b long")


def _key_links(texts: DataFrame, n: int, percent: int) -> DataFrame:
    """``top, id``: each text with the smallest one under a common key.

    Keys that one text in a hundred holds, by a sample of the texts, are few: at
    most a hundred times the keys of an average text. Their smallest ids are found
    by partial minima and broadcast, so no hot key is shuffled; all other keys go
    through one shuffle and an ordered pass. The sample only chooses the way.
    """
    derive = lambda df: df.mapInArrow(_keys(n, percent), "id long, key long")
    keys, sample = derive(texts), texts.where(F.pmod(F.xxhash64("id", F.lit(3)), F.lit(SAMPLED)) == 0)
    least = max(16, sample.count() // 100)
    hot = written(derive(sample).groupBy("key").count().where(F.col("count") >= least).select("key"), "hot-keys")
    tops = written(keys.join(F.broadcast(hot), "key").groupBy("key").agg(F.min("id").alias("top")), "hot-tops")
    near = keys.join(F.broadcast(tops), "key").select("top", "id")
    first = F.first("id").over(W.partitionBy("key").orderBy("id"))
    far = keys.join(F.broadcast(hot), "key", "left_anti").select(first.alias("top"), "id")
    return near.union(far).where("id <> top").distinct()


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, percent: int = 80) -> DataFrame:
    """Per row of ``docs``: ``id, n_shingles, component_id``.

    Words are lower-cased (A-Z) runs of non-blank characters; two texts link when
    100 * common >= percent * union over their distinct ``n``-word shingles. A
    text of fewer words is one shingle; an empty or null text has none and links
    with nothing. Repeated rows and rows that share an id are one node. Rows with
    a null id come back with a null component. Other columns are not read.
    """
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    table = written(source.mapInArrow(_marks(n), "id long, n long, f1 long, f2 long"), "set-marks")
    full = table.where("n > 0 and id is not null")
    # Equal sets first: one row stands for all copies. Merge joins at every size: the plan must not depend on how
    # small a test is.
    copies = written(full.groupBy("f1", "f2", "n").agg(F.min("id").alias("leader")), "classes")
    lead = copies.groupBy(F.col("leader").alias("id")).agg(F.max("n").alias("n"))
    owned = written(full.join(copies.hint("merge"), ["f1", "f2", "n"]).select("id", "leader"), "leaders")
    # A cell is a top node: the smallest text of some keys and all that share one of them with it.
    source = source.where("id is not null")
    cells = _key_links(source, n, percent).join(owned.hint("merge"), "id").where("leader <> top")
    cells = written(cells.select("top", F.col("leader").alias("id")).distinct(), "cells")
    home = cells.join(lead, "id")
    load = written(home.groupBy("top").agg(F.ceil(F.sum("n") / CHUNK_TOKENS).cast("int").alias("chunks")), "loads")
    dealt = home.join(load, "top").select("top", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int").alias("chunk"), "id")
    heads = load.select("top", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.col("top").alias("id"))
    members = dealt.union(heads).select("top", "chunk", "id", F.col("id").alias("label"), F.lit(-1).alias("side"))
    # A repeated id with several texts connects the classes of all of them.
    twice = owned.groupBy("id").agg(F.min("leader").alias("a"), F.max("leader").alias("z")).where("a < z").select("id", "a")
    repeats = owned.join(twice, "id").select("a", F.col("leader").alias("b"))
    edges = written(_solved(members, source, n, percent).union(repeats), "links")
    found = components(edges)
    # Cells dealt over several chunks: what is still apart in them meets all of them.
    part = load.where("chunks > 1").select("top")
    wide = cells.join(part, "top").union(part.select("top", F.col("top").alias("id")))
    wide = wide.join(lead, "id").join(found.withColumnRenamed("node", "id"), "id", "left").select("top", "id", "n", F.coalesce("component", "id").alias("label"))
    units = written(_across(written(wide, "open-cells")), "open-units")
    if units.limit(1).count():
        found = components(edges.union(_solved(units, source, n, percent)))
    return _result(table, copies, found)


def _across(wide: DataFrame) -> DataFrame:
    """Units that compare the members of a cell outside its largest component with all of its members.

    ``wide``: ``top, id, n, label``. Both sides are dealt over blocks of CHUNK_TOKENS shingles.
    """
    held = wide.groupBy("top", "label").agg(F.count("*").alias("c"))
    main = held.groupBy("top").agg(F.max(F.struct("c", "label")).alias("m"), F.count("*").alias("labels")).where("labels > 1")
    main = written(main.select("top", F.col("m.label").alias("main")), "mains")

    def blocks(rows: DataFrame, name: str) -> DataFrame:
        load = written(rows.groupBy("top").agg(F.ceil(F.sum("n") / CHUNK_TOKENS).cast("int").alias("_n")), "loads")
        return rows.join(load, "top").select("top", "id", "label", F.pmod(F.xxhash64("id", F.lit(1)), F.col("_n")).cast("int").alias(name))

    rows = wide.join(main, "top")
    every, rest = blocks(rows.drop("main"), "chunk"), blocks(rows.where("label <> main").drop("main"), "block")
    unit = lambda df, side: df.select("top", F.concat_ws("/", "block", "chunk").alias("chunk"), "id", "label", F.lit(side).alias("side"))
    few = unit(rest.join(every.select("top", "chunk").distinct(), "top"), 0)
    many = unit(every.join(rest.select("top", "block").distinct(), "top"), 1)
    return few.union(many)


def _result(table: DataFrame, copies: DataFrame, found: DataFrame) -> DataFrame:
    of = copies.join(found.withColumnRenamed("node", "leader"), "leader", "left")
    of = written(of.select("f1", "f2", "n", F.coalesce("component", "leader").alias("component_id")), "components")
    rows = table.select("id", "n", "f1", "f2").join(of.hint("merge"), ["f1", "f2", "n"], "left")
    label = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return rows.select("id", F.col("n").alias("n_shingles"), label.alias("component_id"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, percent: int = 80) -> DataFrame:
    """Rows of ``docs`` that lead their component.

    Of rows that repeat an id the one with the smallest text stays; rows with a
    null id all stay.
    """
    found = jaccard_components(docs, id_col, text_col, n, percent)
    gone = found.where("component_id < id").select(F.col("id").alias(id_col)).distinct()
    left = docs.join(gone, id_col, "left_anti").select(docs.columns)
    # Only rows of repeated ids are put in order.
    again = found.where("id is not null").groupBy(F.col("id").alias(id_col)).count().where("count > 1").select(id_col)
    turn = F.row_number().over(W.partitionBy(id_col).orderBy(text_col))
    first = left.join(again, id_col, "left_semi").withColumn("__turn", turn).where("__turn = 1").drop("__turn")
    return left.join(again, id_col, "left_anti").select(docs.columns).union(first.select(docs.columns))
