"""Document-shaped inputs derived from the provided tables.

The tables hold no scholarly markup, so papers are written from their rows
with built-in functions. A paper takes at most eight citation lines (the line
number picks the paper, too), which bounds every group below by construction,
however many rows one order may have.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paperloom.functions.text import ordered_concat
from paperloom.operators.tokens import place, tokenise


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Citation lines ``doc_id, n, p, q, f``, one per row of ``lineitem``. Rows
    that repeat a line of an order are lines of a further paper."""
    again = F.row_number().over(W.partitionBy("l_orderkey", "l_linenumber").orderBy("l_partkey", "l_quantity", "l_returnflag")) - 1
    lines = table(spark, sf_dir, "lineitem").withColumn("n", F.col("l_linenumber") + 8 * again)
    return lines.select(
        F.concat_ws(".", "l_orderkey", F.expr("n div 8")).alias("doc_id"),
        "n",
        F.col("l_partkey").alias("p"),
        F.col("l_quantity").cast("int").alias("q"),
        F.col("l_returnflag").alias("f"),
    )


# The same rows for the oracle; ``{CITES}`` is a common table expression.
CITES = """cites AS (
  SELECT concat(l_orderkey, '.', n // 8) AS doc_id, CAST(n AS INTEGER) AS n, l_partkey AS p, CAST(l_quantity AS INTEGER) AS q, l_returnflag AS f
  FROM (SELECT *, l_linenumber + 8 * (row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_quantity, l_returnflag) - 1) AS n FROM lineitem))"""


def text(*parts: str | Column) -> Column:
    """Concatenate literals and columns; ``{name}`` in a literal is a column."""
    out = []
    for part in parts:
        if isinstance(part, Column):
            out.append(part.cast("string"))
            continue
        for i, bit in enumerate(part.replace("}", "{").split("{")):
            if bit:
                out.append(F.col(bit).cast("string") if i % 2 else F.lit(bit))
    return F.concat(*out)


def papers_from(rows: DataFrame, *parts: str | Column, order: str = "n") -> DataFrame:
    """One XML string per ``doc_id``: literal parts stand once, column parts
    once per row, in order. The rows are placed by document first, so the
    tokens need not be moved."""
    pieces = [F.lit(x) if isinstance(x, str) else ordered_concat(F.col(order), x) for x in parts]
    return place(rows).groupBy("doc_id").agg(F.concat(*pieces).alias("xml"))


def tokens_of(papers: DataFrame) -> DataFrame:
    """Tokens of papers made by ``papers_from``."""
    return tokenise(papers, placed=True)


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select(F.col("page_id").alias("doc_id"), F.col("html").alias("xml"))


# Page markup for the oracle, cleaned of comments, declarations, scripts and
# styles, then cut into tokens by a pattern both engines read alike.
PAGE_TOKENS = r"""clean AS (
  SELECT page_id AS doc_id,
         regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'),
           '<![^>]*>', '', 'g'), '(?is)<script\b[^>]*>.*?</script\s*>', '', 'g'), '(?is)<style\b[^>]*>.*?</style\s*>', '', 'g') AS x
  FROM pages),
lists AS (SELECT doc_id, regexp_extract_all(x, '<(?:"[^"]*"|''[^'']*''|[^>"''])+>|[^<]+') AS l FROM clean),
raw AS (SELECT doc_id, unnest(l) AS tok, generate_subscripts(l, 1) - 1 AS pos FROM lists),
tokens AS (
  SELECT doc_id, CAST(pos AS INTEGER) AS pos, tok,
         CASE WHEN tok NOT LIKE '<%' THEN 'text' WHEN tok LIKE '</%' THEN 'close' WHEN tok LIKE '%/>' THEN 'void' ELSE 'open' END AS kind,
         CASE WHEN tok LIKE '<%' THEN regexp_extract(tok, '^</?\s*([A-Za-z_][\w:.\-]*)', 1) END AS tag,
         CASE WHEN tok NOT LIKE '<%' THEN replace(replace(replace(replace(replace(replace(tok, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&apos;', ''''), '&nbsp;', ' '), '&amp;', '&') END AS text
  FROM raw)"""


def paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of each document as paragraphs: ``doc_id, para_no, para_text``."""
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("para_no", "para_text"))


PARAGRAPHS = """paragraphs AS (
  SELECT doc_id, unnest(l) AS para_text, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS para_no
  FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))"""

# Marks ahead of the first word, or alone, belong to a sentence, too.
SENTENCE_RE = r"[.!?]*[^.!?]+[.!?]*|[.!?]+"


def sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences of each paragraph: ``doc_id, para_no, sent_no, sentence``."""
    return (
        paragraphs(spark, sf_dir)
        .select("doc_id", "para_no", F.posexplode(F.regexp_extract_all("para_text", F.lit(SENTENCE_RE), F.lit(0))).alias("sent_no", "sentence"))
        .withColumn("sentence", F.trim(F.regexp_replace("sentence", r"[ \t\r\n\f]+", " ")))
        .where("sentence <> ''")
    )


SENTENCES = (
    PARAGRAPHS
    + r""",
sentences AS (
  SELECT * FROM (
    SELECT doc_id, para_no, CAST(sent_no AS INTEGER) AS sent_no, trim(regexp_replace(s, '[ \t\r\n\f]+', ' ', 'g')) AS sentence
    FROM (SELECT doc_id, para_no, unnest(l) AS s, generate_subscripts(l, 1) - 1 AS sent_no
          FROM (SELECT doc_id, para_no, regexp_extract_all(para_text, '[.!?]*[^.!?]+[.!?]*|[.!?]+') AS l FROM paragraphs)))
  WHERE sentence <> '')"""
)


def document_papers(spark: SparkSession, sf_dir: str, docs: DataFrame | None = None) -> DataFrame:
    """Documents as nested papers: the first line is the title, each further
    line a body paragraph with its sentences. Built inside each row."""
    lines = F.split("text", "\n")
    sents = lambda p: F.filter(
        F.transform(F.regexp_extract_all(p, F.lit(SENTENCE_RE), F.lit(0)), lambda s: F.trim(F.regexp_replace(s, r"[ \t\r\n\f]+", " "))), lambda s: s != ""
    )
    made = lambda p: F.transform(sents(p), lambda s, i: F.struct(s.alias("sentence"), F.concat(i + 1, F.lit(",0,0,1,1")).alias("coords")))
    spans = F.expr("cast(array() as array<struct<start:int,end:int,text:string,ref_id:string>>)")
    para = lambda p, i: F.struct(
        F.to_json(made(p)).alias("text"), spans.alias("cite_spans"), spans.alias("ref_spans"),
        F.concat(F.lit("Part "), i % 3).alias("section"), i.cast("string").alias("sec_num"), made(p).alias("sentences"),
    )
    body = F.transform(F.slice(lines, 2, F.size(lines)), para)
    authors = F.expr("cast(array() as array<struct<first:string,last:string>>)")
    docs = table(spark, sf_dir, "documents") if docs is None else docs
    return docs.select(
        F.col("doc_id").cast("string").alias("doc_id"),
        lines[0].alias("title"),
        F.lit("1").alias("coords"),
        F.sha1("text").alias("pdf_hash"),
        F.struct(lines[0].alias("title"), authors.alias("authors"), F.col("source").alias("venue"), F.lit("2019").alias("year"), F.create_map(F.lit("lang"), F.col("lang")).alias("identifiers")).alias("metadata"),
        F.slice(body, 1, 0).alias("abstract"),
        body.alias("body_text"),
        F.slice(body, 1, 0).alias("back_matter"),
        F.expr("cast(map() as map<string,struct<title:string>>)").alias("bib_entries"),
        F.expr("cast(map() as map<string,struct<type:string>>)").alias("ref_entries"),
    )
