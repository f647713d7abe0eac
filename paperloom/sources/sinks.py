"""Files out: JSON, CSV, text, failure tables, manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_json(papers: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A5: one object per line, columns in order, empty fields kept."""
    papers.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_csv(sentences: DataFrame, path: str, mode: str = "overwrite") -> None:
    """``file, section, sentence, coordinates`` with a header."""
    flat = sentences.select("file", "section", "sentence", "coordinates")
    flat.write.mode(mode).option("header", True).option("escape", '"').option("multiLine", True).csv(path)


def read_csv(spark, path: str) -> DataFrame:
    schema = "file string, section string, sentence string, coordinates string"
    return spark.read.schema(schema).option("header", True).option("escape", '"').option("multiLine", True).csv(path)


def write_text(lines: DataFrame, path: str, buckets: int | None = None, mode: str = "overwrite") -> None:
    """Rendered lines in order of document and line over the sequence of
    files. They are placed by range, so one very long document spreads over
    several files. Without ``buckets`` Spark sizes the ranges."""
    order = ["doc_id", "line_no"]
    placed = lines.repartitionByRange(buckets, *order) if buckets else lines.repartitionByRange(*order)
    placed = placed.sortWithinPartitions(*order)
    placed.select(F.regexp_replace("line", r"[\r\n]+", " ").alias("value")).write.mode(mode).text(path)


def append_failures(failures: DataFrame, path: str) -> None:
    """Add to the failure table."""
    failures.write.mode("append").parquet(path)


def manifest(inputs: DataFrame, outputs: dict[str, tuple[DataFrame, str]], pages: DataFrame) -> DataFrame:
    """One JSON record per input, naming it, its outputs with their
    descriptions, and the page size. ``inputs`` and each output table have
    ``doc_id, file_id, filename``; ``pages`` has ``doc_id, width, height``."""

    def entry(prefix: str, description: str) -> Column:
        return F.struct(F.col(f"{prefix}_id").alias("file_id"), F.col(f"{prefix}_name").alias("filename"), F.lit(description).alias("description"))

    out = inputs.select("doc_id", F.col("file_id").alias("input_id"), F.col("filename").alias("input_name"))
    for name, (df, _) in outputs.items():
        out = out.join(df.select("doc_id", F.col("file_id").alias(f"{name}_id"), F.col("filename").alias(f"{name}_name")), "doc_id", "left")
    out = out.join(pages, "doc_id", "left")
    files = F.struct(entry("input", "Input file").alias("input"), *[entry(n, d).alias(n) for n, (_, d) in outputs.items()])
    record = F.struct(files.alias("extracted_files"), F.struct("width", "height").alias("page_dimensions"))
    return out.select("doc_id", F.to_json(record).alias("manifest"))
