"""Streams of documents and file announcements.

Sinks are folders of Parquet files with Spark's own commit log, so a batch that
is run again after a failure leaves its rows once. Checkpoints and tables live
in the shared folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def file_stream(spark: SparkSession, folder: str, schema: str, pattern: str = "*.parquet", per_trigger: int | None = None) -> DataFrame:
    """Files of a folder as a stream, in the order they appear."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return reader.parquet(folder)


def table_stream(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Files of the table at ``path``, be it one file or a folder of them, as a
    stream. The path goes in as a pattern, since a stream takes a plain one for
    a folder."""
    folder, name = path.rstrip("/").rsplit("/", 1)
    return file_stream(spark, f"{folder}/{{{name}}}", schema)


def ingest(stream: DataFrame, transform: Callable[[DataFrame], DataFrame], path: str, checkpoint: str) -> StreamingQuery:
    """G1: each new document goes through the batch ``transform``, whatever
    windows and joins it holds. Batch ``n`` owns the folder ``batch=n`` and
    replaces it when run again."""

    def write(batch: DataFrame, number: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def append_table(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append rows to a table as they come, once each."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def first_announcements(log: DataFrame, time: str, keys: list[str]) -> DataFrame:
    """Each file once, at its first announcement, of an append-only log.

    The stream appends without state, so none is lost however late it comes; the
    first one is a grouped minimum when read.
    """
    return log.groupBy(*keys).agg(F.min(time).alias(time))


def announce_once(stream: DataFrame, keys: list[str], path: str, checkpoint: str, emit: Callable[[DataFrame, int], None], buckets: int = 64) -> StreamingQuery:
    """G2 as a stream that emits: ``emit`` gets the rows of each batch whose keys
    no earlier batch held, one row a key, so what follows sees a file once
    however late or often it is announced again.

    Keys seen are kept below ``path``, one folder per batch and within it one per
    bucket of the keys; a batch reads only the buckets that it holds itself. A
    batch that is run again reads what came before it and replaces its own
    folder, so it finds the same new rows. ``emit`` must replace its output, too.
    """
    schema = stream.select(*keys).schema.add("batch", "long").add("bucket", "integer")
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")

    def alike(left: DataFrame, right: DataFrame, names: list[str], how: str) -> DataFrame:
        """Join in which empty keys are keys like others."""
        return left.alias("l").join(right.alias("r"), reduce(and_, [F.col(f"l.{n}").eqNullSafe(F.col(f"r.{n}")) for n in names]), how)

    def step(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = batch.dropDuplicates(keys).withColumn("bucket", bucket)
        # Each batch leaves a folder, so only the first finds none.
        if number > 0:
            seen = spark.read.schema(schema).option("basePath", path).parquet(path).where(F.col("batch") < number)
            rows = alike(rows, seen.select("bucket", *keys), ["bucket", *keys], "left_anti")
        new = rows.select("bucket", *keys).repartition("bucket")
        new.write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/batch={number}")
        mine = spark.read.schema(schema).option("basePath", path).parquet(path).where(F.col("batch") == number).select(*keys)
        emit(alike(batch.dropDuplicates(keys), mine, keys, "left_semi"), number)

    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


class VersionedTable:
    """G3 as snapshot and deltas, below one folder.

    Batches of a stream leave their rows in ``deltas/batch=n``. ``compact`` writes
    the current rows to a new folder and then adds one row to ``pointers``: the
    number of the snapshot, its folder and the last batch in it. Readers follow the
    highest pointer, so a run that is killed on the way leaves an unused folder and
    nothing else. A read goes through the deltas since and takes from the snapshot
    as it is what they do not name.
    """

    def __init__(self, spark: SparkSession, root: str, schema: str, keys: list[str], version: list[str]):
        self.spark, self.root, self.schema, self.keys, self.version = spark, root.rstrip("/"), schema, keys, version
        # An empty pointer lets every reader find the folders.
        self._pointers("ignore", [])

    def _pointers(self, mode: str, rows: list[tuple]) -> None:
        pointers = self.spark.createDataFrame(rows, "number long, folder string, upto long")
        pointers.coalesce(1).write.mode(mode).parquet(f"{self.root}/pointers")

    def upsert(self, stream: DataFrame, checkpoint: str) -> StreamingQuery:
        """Every batch leaves its rows as one delta, and replaces it when run again."""
        columns = self.spark.createDataFrame([], self.schema).columns

        def step(batch: DataFrame, number: int) -> None:
            batch.select(*columns).write.mode("overwrite").parquet(f"{self.root}/deltas/batch={number}")

        return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

    def pointer(self) -> tuple[int, str | None, int]:
        """Number and folder of the newest snapshot, and the last batch in it."""
        best = self.spark.read.schema("number long, folder string, upto long").parquet(f"{self.root}/pointers").agg(F.max(F.struct("number", "folder", "upto")).alias("p")).first()["p"]
        return tuple(best) if best else (-1, None, -1)

    def deltas(self, after: int) -> DataFrame:
        """Rows of the batches after ``after``; their folders alone are read."""
        rows = self.spark.read.schema(f"{self.schema}, batch long").option("basePath", f"{self.root}/deltas").parquet(f"{self.root}/deltas")
        return rows.where(F.col("batch") > after)

    def read(self) -> DataFrame:
        """The rows of the newest version of each key."""
        _, folder, upto = self.pointer()
        return self._merged(folder, self.deltas(upto))

    def _merged(self, folder: str | None, deltas: DataFrame) -> DataFrame:
        deltas = deltas.drop("batch")
        if folder is None:
            return current_rows(deltas, self.keys, self.version)
        snapshot = self.spark.read.schema(self.schema).parquet(f"{self.root}/{folder}")
        named = deltas.select(*self.keys).distinct()
        touched = snapshot.join(named, self.keys, "left_semi").unionByName(deltas)
        return snapshot.join(named, self.keys, "left_anti").unionByName(current_rows(touched, self.keys, self.version))

    def compact(self) -> None:
        """Write the current rows as a new snapshot and point to it."""
        number, folder, upto = self.pointer()
        last = self.deltas(upto).agg(F.max("batch")).first()[0]
        if last is None:
            return
        target = f"snapshots/{number + 1}-{uuid.uuid4().hex}"
        self._merged(folder, self.deltas(upto).where(F.col("batch") <= last)).write.parquet(f"{self.root}/{target}")
        self._pointers("append", [(number + 1, target, last)])


def current_rows(log: DataFrame, keys: list[str], version: list[str]) -> DataFrame:
    """Of an append-only table, the rows of the newest version of each key.

    New rows replace old ones when read, so a batch writes only its own rows
    and never the table. The newest versions are a grouped maximum.
    """
    newest = log.groupBy(*keys).agg(F.max(F.struct(*version)).alias("_v"))
    tagged = log.withColumn("_v", F.struct(*version))
    return tagged.join(newest, [*keys, "_v"], "left_semi").drop("_v").select(*log.columns)


def compact(log: DataFrame, keys: list[str], version: list[str], path: str) -> None:
    """Write the current rows as a new table, to read from then on."""
    current_rows(log, keys, version).write.mode("overwrite").parquet(path)
