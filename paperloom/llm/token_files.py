"""Token ids of documents as ORC files that can be read stripe by stripe or by document.

Rows are spread by ranges of the document id, so each task writes one file of
consecutive documents in ascending order. Ids are an integer array, which ORC packs
by run-length encoding; row indexes every ROWS rows and Bloom filters on the document
id let a reader skip what it does not ask for, and files split between stripes.

Each row holds its offset within its file (``at``) and its number of ids, so the
global offset of a document needs two narrow columns and one total per file. A lost
task is run again and writes its file anew; nothing is visible before the job commits.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Characters encoded at once, words remembered (twice that at most), rows of an index group, bytes of a stripe, wrong hits of a Bloom filter.
PIECE, WORDS, ROWS, STRIPE, WRONG = 1 << 21, 300_000, 1024, 64 << 20, 0.01
#: Longer words are not remembered.
LONG = 64
#: A word of Latin letters and the marks behind it. Such letters are letters to any tokenizer, whatever its Unicode tables, and
#: each has one lower case, but for the dotted capital I, which is left out. So is the apostrophe among the marks.
STEM = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+)([!-&(-/:-@[-`{-~]*)").fullmatch
SCHEMA = "doc_id long, file int, at long, n_tokens int, ids array<int>"


class WordEncoder:
    """Ids of texts, each distinct word encoded by the library once while it is remembered.

    For lower-casing tokenizers whose tokens never cross a blank or a line end, nor the
    border from letters to marks behind them, so that the ids of a text are those of its
    words in a row. Words live in two generations: a full one becomes the old one, and
    what is met again moves back, so frequent words stay.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task has one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.ends_word = np.zeros(self.library.get_vocab_size(), bool)
        for token, number in self.library.get_vocab().items():
            self.ends_word[number] = token.endswith("</w>")
        self.new: dict[str, bytes] = {"": b""}
        self.old: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as 32-bit numbers."""
        split = [text.replace("\n", " ").split(" ") for text in texts]
        if len(self.new) > WORDS:
            self.old, self.new = self.new, {"": b""}
        long = self._remember(set().union(*split))
        out = [b"".join(map(self.new.__getitem__, words)) for words in split]
        for word in long:
            del self.new[word]
        return out

    def _unknown(self, words: set[str]) -> set[str]:
        """Words in neither generation; those of the old one move to the new one."""
        fresh = words.difference(self.new)
        back = fresh.intersection(self.old)
        self.new.update((word, self.old[word]) for word in back)
        return fresh - back

    def _remember(self, words: set[str]) -> list[str]:
        """Have the ids of all ``words`` at hand; returns those that are too long to stay."""
        split, others = [], set()
        for word in self._unknown(words):
            m = STEM(word)
            if m is None:
                others.add(word)
            else:
                split.append((word, m[1].lower(), m[2]))
                others.add(m[2])
        self._learn_stems(list(self._unknown({stem for _, stem, _ in split})))
        others = list(self._unknown(others))
        self._learn(others)
        self.new.update([(word, self.new[stem] + self.new[marks]) for word, stem, marks in split])
        return [word for word in {*others, *(x for both in split for x in both[:2])} if len(word) > LONG]

    def _learn(self, words: list[str]) -> None:
        found = self.library.encode_batch_fast(words, add_special_tokens=False)
        self.new.update([(word, array("i", e.ids).tobytes()) for word, e in zip(words, found)])

    def _learn_stems(self, stems: list[str]) -> None:
        """Stems go through the library as one text, cut after the tokens that end a word, if there are as many."""
        ids = np.array(self.library.encode(" ".join(stems), add_special_tokens=False).ids, np.int32)
        ends = np.flatnonzero(self.ends_word[ids]) + 1
        if len(ends) != len(stems):
            return self._learn(stems)
        data, ends = ids.tobytes(), (4 * ends).tolist()
        self.new.update(zip(stems, map(data.__getitem__, map(slice, [0, *ends[:-1]], ends))))


@lru_cache(maxsize=2)
def _encoder(path: str) -> WordEncoder:
    """The encoder of this worker, with what it remembers from earlier tasks."""
    return WordEncoder(path)


def _writer(path: str, end_id: int):
    end = np.array([end_id], np.int32).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, file, at = _encoder(path), TaskContext.get().partitionId(), 0

        def coded(names: list, texts: list[str]) -> pa.RecordBatch:
            nonlocal at
            rows = encoder.encode(texts)
            ends = np.cumsum([len(r) // 4 + 1 for r in rows])
            sizes = np.diff(ends, prepend=0)
            flat = np.frombuffer(end.join([*rows, b""]), np.int32)
            ids = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(flat))
            columns = [pa.array(names, pa.int64()), pa.array(np.full(len(rows), file, np.int32)), pa.array(at + ends - sizes), pa.array(sizes.astype(np.int32)), ids]
            at += int(ends[-1])
            return pa.RecordBatch.from_arrays(columns, names=["doc_id", "file", "at", "n_tokens", "ids"])

        for batch in batches:
            names, texts, size = [], [], 0
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py() or ""
                names.append(name)
                texts.append(text)
                size += len(text)
                if size >= PIECE:
                    yield coded(names, texts)
                    names, texts, size = [], [], 0
            if names:
                yield coded(names, texts)

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", files: int | None = None) -> None:
    """Write the ids of every text, each followed by ``end_id``, as ORC files below ``path``.

    Documents stand in ascending order of their id over the files and within each; null
    ids come first, rows of one id by a hash of their text. A null or empty text has the
    end id alone. Repeated rows are written as often as they come, spread over files if
    they are many. ``files`` defaults to the partitions that ``docs`` has when read. An
    empty table gives no rows. Further columns of ``docs`` are not read.
    """
    files = files or max(1, docs.rdd.getNumPartitions())
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    order = ["doc_id", "tie", "row"]
    placed = rows.repartitionByRange(files, *order).sortWithinPartitions(*order).select("doc_id", "text")
    coded = placed.mapInArrow(_writer(tokenizer_path, end_id), SCHEMA)
    coded.write.options(**{
        "compression": "zstd",
        "orc.stripe.size": STRIPE,
        "orc.row.index.stride": ROWS,
        "orc.bloom.filter.columns": "doc_id",
        "orc.bloom.filter.fpp": WRONG,
    }).orc(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every row below ``path``.

    ``start`` counts the ids of all documents before: totals of files, one row each, are
    summed up in order and broadcast to the rows, which are read in place. There are as
    many totals as files, of which the reader's own listing holds more than that.
    """
    rows = spark.read.schema(SCHEMA).orc(path)
    totals = rows.groupBy("file").agg(F.sum("n_tokens").alias("total"))
    before = F.sum("total").over(W.orderBy("file").rowsBetween(W.unboundedPreceding, -1))
    totals = totals.select("file", F.coalesce(before, F.lit(0)).alias("before"))
    return rows.join(F.broadcast(totals), "file").select("doc_id", (F.col("before") + F.col("at")).alias("start"), F.col("n_tokens").cast("long").alias("n_tokens"), "ids")


def lookup(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """``doc_id, ids`` of the documents asked for; statistics, row indexes and Bloom filters skip the rest."""
    return spark.read.schema(SCHEMA).orc(path).where(F.col("doc_id").isin([int(i) for i in doc_ids])).select("doc_id", "ids")


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(3)
        offsets = ids.offsets.to_numpy()
        flat = ids.values.to_numpy().astype("<u4")
        sums = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:])]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(sums, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def checksums(tokens: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of ``read_tokens``: crc32 of the ids as little-endian 32-bit numbers."""
    return tokens.select("doc_id", "start", "n_tokens", "ids").mapInArrow(_checksums, "doc_id long, start long, n_tokens long, ids_crc32 long")
