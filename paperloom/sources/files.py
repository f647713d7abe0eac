"""Files in: folder scans, XML and JSON documents, decoding, failures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paperloom.schemas import paper_json

# File endings that are understood.
KNOWN_TYPES = ["pdf", "gz", "nxml"]


def scan_folder(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """A1: files of a folder as ``path, content`` rows, described."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder)
    return describe_files(raw.select("path", "content"))


def describe_files(files: DataFrame) -> DataFrame:
    """A1: id (base name without its ending), type, SHA-1 of the bytes, and an
    error for endings that are not known. Keeps ``path``; drops the bytes."""
    base = F.element_at(F.split("path", "/"), -1)
    kind = F.lower(F.regexp_extract(base, r"\.([^.]+)$", 1))
    return files.select(
        "path",
        F.regexp_replace(base, r"\.[^.]+$", "").alias("doc_id"),
        kind.alias("kind"),
        F.sha1("content").alias("sha1"),
        F.when(~kind.isin(KNOWN_TYPES), F.lit("unknown_type")).alias("error"),
    )


def scan_xml(spark: SparkSession, path: str) -> DataFrame:
    """A2: whole XML files, one row each, as ``doc_id, xml``."""
    text = spark.read.text(path, wholetext=True).withColumn("_path", F.col("_metadata.file_path"))
    return text.select(F.regexp_replace(F.element_at(F.split("_path", "/"), -1), r"\.[^.]+$", "").alias("doc_id"), F.col("value").alias("xml"))


def scan_xml_records(spark: SparkSession, path: str, row_tag: str) -> DataFrame:
    """A2: files that hold many documents, one row per element ``row_tag``:
    ``file, offset, record_no, xml, reason``.

    The closing tag ends a record, so large files are split between tasks as
    lines of text are. ``offset`` is the byte at which a record's stretch of the
    file begins; stretches are added up by split, and the splits of a file in
    order. ``reason`` is set for what goes to quarantine with its place:
    ``malformed`` elements, an ``unterminated`` last one, and ``stray_text`` in
    which no such element begins. Elements of that name do not stand inside one
    another, and the closing tag is written without blanks. Files are UTF-8.
    """
    end = f"</{row_tag}>"
    raw = spark.read.option("lineSep", end).text(path)
    rows = raw.select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_split"), F.col("_metadata.file_size").alias("_size"), F.monotonically_increasing_id().alias("_row")
    ).withColumn("_bytes", F.octet_length("value") + len(end))
    totals = rows.groupBy("file", "_split").agg(F.sum("_bytes").alias("_sum"), F.count("*").alias("_n"))
    before = W.partitionBy("file").orderBy("_split").rowsBetween(W.unboundedPreceding, -1)
    starts = totals.select("file", "_split", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_at"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_no"))
    inside = W.partitionBy("file", "_split").orderBy("_row").rowsBetween(W.unboundedPreceding, -1)
    placed = rows.withColumns({"_here": F.coalesce(F.sum("_bytes").over(inside), F.lit(0)), "_turn": F.count("*").over(inside)}).join(starts, ["file", "_split"])
    offset = F.col("_at") + F.col("_here")
    placed = placed.withColumns({"offset": offset, "record_no": F.col("_no") + F.col("_turn"), "_open": offset + F.octet_length("value") == F.col("_size")})
    body = F.regexp_substr("value", F.lit(rf"(?s)<{row_tag}[\s>/].*"))
    xml = F.when(F.col("_open"), body).otherwise(F.concat(body, F.lit(end)))
    reason = F.when(body.isNull(), "stray_text").when(F.col("_open"), "unterminated").when(~well_formed(xml), "malformed")
    kept = placed.where(body.isNotNull() | (F.trim(F.regexp_replace("value", r"\s+", " ")) != ""))
    return kept.select("file", "offset", "record_no", F.coalesce(xml, F.col("value")).alias("xml"), reason.alias("reason"))


def scan_xml_rows(spark: SparkSession, path: str, row_tag: str, schema: str) -> DataFrame:
    """A2: one row per element of one name, with the given fields; rows that do
    not fit keep their text in ``_corrupt_record`` when the schema has it."""
    return spark.read.format("xml").option("rowTag", row_tag).option("mode", "PERMISSIVE").schema(schema).load(path)


def well_formed(xml: Column) -> Column:
    """A2: whether the markup parses; malformed text never fails the job."""
    schema = "_ok string, _bad string"
    parsed = F.from_xml(xml, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    return xml.isNotNull() & parsed["_bad"].isNull()


def scan_papers(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """A3: paper JSON of any layout."""
    reader = spark.read.schema(paper_json()).option("columnNameOfCorruptRecord", "_corrupt_record")
    return reader.option("multiLine", multi_line).json(path)


def decode_text(content: Column) -> Column:
    """A4: bytes as UTF-8 where they are valid, else as Latin-1, which takes any
    bytes; NULL becomes the empty text."""
    utf8 = content.cast("string")
    return F.coalesce(F.when(F.is_valid_utf8(utf8), utf8), F.decode(content, "ISO-8859-1"), F.lit(""))


def not_done(work: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Work whose output does not exist yet."""
    return work.join(done.select(*keys), keys, "left_anti")


def split_failures(rows: DataFrame, checks: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows that pass every check, and ``doc_id, reason`` of those that fail
    one (the first named). Checks are true for good rows."""
    reason = F.lit(None).cast("string")
    for name, ok in reversed(list(checks.items())):
        reason = F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)).otherwise(reason)
    marked = rows.withColumn("reason", reason)
    return marked.where("reason is null").drop("reason"), marked.where("reason is not null").select("doc_id", "reason")
