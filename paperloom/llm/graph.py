"""Connected components of an edge table, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.session import cut, work_path


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared work folder; later reads do not recompute it."""
    spark = df.sparkSession
    path = work_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` to ``node, component``: the smallest node reachable.

    Nodes without an edge are absent. Large-star links each larger neighbour to
    the smallest one, small-star each smaller one; both use a minimum per node
    that is combined ahead of the shuffle and joined back, so a star with many
    rays is split like any skewed join. The edge count and a checksum tell when
    nothing moves; no edge reaches the driver. Null ends and loops are ignored.
    """
    a, b = F.col("a").cast("long"), F.col("b").cast("long")
    edges = cut(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct())
    mark = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = _least(both).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        low = _least(large)
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = cut(small.select("e.u", "e.v").where("u > v").distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    low = _least(edges)
    roots = low.select(F.col("m").alias("node"), F.col("m").alias("component")).distinct()
    return cut(low.select(F.col("u").alias("node"), F.col("m").alias("component")).union(roots))
