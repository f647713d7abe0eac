"""Markup to ordered token rows, and everything that reads them.

A document arrives as one row and is placed by ``doc_id`` once, before its
text is blown up into tokens. All windows and groups below are keyed by
``doc_id`` first, so they reuse that placement and shuffle nothing more. The
tokens of one document come from one cell, which bounds the group.

Token columns: ``doc_id, pos, kind`` (open, close, void, text), ``tag``,
``tok`` (the raw token), ``text`` (unescaped, text tokens only) and ``depth``
(level of the node in the tree; a closing tag has the level of its opener).
"""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paperloom.functions.text import attr, ordered_concat, unescape

CDATA_RE = r"<!\[CDATA\[[\s\S]*?\]\]>"
TOKEN_RE = CDATA_RE + r"|<(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')++>|[^<]+"
NOISE_RE = "(" + CDATA_RE + r")|<!--[\s\S]*?-->|<\?[\s\S]*?\?>|<!(?!\[CDATA\[)[^>\[]*+(?:\[[\s\S]*?\]\s*+)?>"
TAG_RE = r"^</?\s*([A-Za-z_][\w:.\-]*)"
SKIPPED_BLOCKS = ("script", "style")
# Tokens take some fifteen times the room of the markup they are cut from: these
# make at most about 150 MB of them a task.
TASK_CHARS, TASK_LINES = 8 << 20, 16_384


def strip_noise(xml: Column, blocks: Iterable[str] = SKIPPED_BLOCKS) -> Column:
    """Remove comments, instructions and declarations (with an inner subset, if
    any), and for web pages raw blocks whose content is not markup. One pass, so
    what stands in a CDATA section stays. Texts without the characters that a
    pattern needs are not searched by it."""
    blocks = tuple(blocks)
    noisy = xml.contains("<!") | xml.contains("<?")
    out = F.when(noisy, F.regexp_replace(xml, NOISE_RE, "$1")).otherwise(xml)

    def clean(x: Column) -> Column:
        bare = x
        for tag in blocks:
            bare = F.regexp_replace(bare, rf"(?is)<{tag}\b[^>]*>.*?</{tag}\s*>", "")
        return F.when(x.rlike(f"(?i)</(?:{'|'.join(blocks)})"), bare).otherwise(x)

    return F.get(F.transform(F.array(out), clean), F.lit(0)) if blocks else out


def _doc_order(*parts: str):
    return W.partitionBy("doc_id", *parts).orderBy("pos")


def place(df: DataFrame, markup: Column | None = None) -> DataFrame:
    """Spread rows by ``doc_id`` over as many partitions as their markup asks
    for, the shuffle partitions at least. The number is given so that partitions
    are not merged by the size the documents have before they are blown up into
    tokens; ``markup`` is the column that will be."""
    return df.repartition(task_count(df, markup), "doc_id")


def task_count(df: DataFrame, markup: Column | None = None) -> int:
    """Tasks over which ``df`` is spread, so that the tokens of one fit its
    memory and are sorted there. Tables are measured by the characters of
    ``markup``, lines of papers, of a few hundred each, by their number."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if df.isStreaming:
        return least
    size = F.sum(F.length(markup)) / TASK_CHARS if markup is not None else F.count("*") / TASK_LINES
    return max(least, math.ceil(df.agg(size).first()[0] or 0))


def raw_tokens(docs: DataFrame, markup: str = "xml", blocks: Iterable[str] = SKIPPED_BLOCKS, placed: bool = False) -> DataFrame:
    """B1, first half: one row per tag or run of text, in document order.
    ``placed`` says that ``docs`` are spread by ``doc_id`` already."""
    placed = docs if placed else place(docs, F.col(markup))
    cleaned = placed.select("doc_id", strip_noise(F.col(markup), blocks).alias("_m"))
    cut = cleaned.select("doc_id", F.posexplode(F.regexp_extract_all("_m", F.lit(TOKEN_RE), F.lit(0))).alias("pos", "tok"))
    tag = F.regexp_extract("tok", TAG_RE, 1)
    cdata = F.col("tok").startswith("<![CDATA[")
    kind = (
        F.when(cdata | ~F.col("tok").startswith("<"), "text")
        .when(F.col("tok").startswith("</"), "close")
        .when(F.col("tok").endswith("/>"), "void")
        .otherwise("open")
    )
    text = F.when(cdata, F.expr("substring(tok, 10, length(tok) - 12)")).when(F.col("tok").contains("&"), unescape(F.col("tok"))).otherwise(F.col("tok"))
    return cut.select(
        "doc_id",
        "pos",
        kind.alias("kind"),
        F.when(kind != "text", tag).alias("tag"),
        "tok",
        F.when(kind == "text", text).alias("text"),
    )


def with_depth(tokens: DataFrame, nesting: Iterable[str] | None = None) -> DataFrame:
    """B1, second half: level of every token. For tag soup, ``nesting`` names
    the tags that are known to be balanced; others take no part."""
    counted = F.lit(True) if nesting is None else F.col("tag").isin(list(nesting))
    step = F.when(counted & (F.col("kind") == "open"), 1).when(counted & (F.col("kind") == "close"), -1).otherwise(0)
    level = F.sum(step).over(_doc_order().rowsBetween(W.unboundedPreceding, 0))
    return tokens.withColumn("depth", (level + F.when(counted & (F.col("kind") == "open"), 0).otherwise(1)).cast("int"))


def tokenise(docs: DataFrame, markup: str = "xml", nesting: Iterable[str] | None = None, placed: bool = False, blocks: Iterable[str] = SKIPPED_BLOCKS) -> DataFrame:
    """B1: ordered tokens with depth."""
    return with_depth(raw_tokens(docs, markup, blocks, placed), nesting)


def within(tokens: DataFrame, more: dict[str, Column] | None = None, /, **targets: str | tuple[str, ...]) -> DataFrame:
    """Add, per keyword, the position of the outermost enclosing element with
    one of the given tags (its own opening and closing tokens count as inside),
    or NULL. ``more`` are further columns over the order of the tokens, which
    the first of the passes takes along.

    Two passes over one sort: open elements are counted, then the position at
    which the count rose from zero is carried forward.
    """
    upto = _doc_order().rowsBetween(W.unboundedPreceding, 0)
    cols, hits = {}, {}
    for name, tags in targets.items():
        names = (tags,) if isinstance(tags, str) else tuple(tags)
        step = F.when(F.col("tag").isin(*names), F.when(F.col("kind") == "open", 1).when(F.col("kind") == "close", -1))
        cols[f"_n_{name}"] = F.coalesce(F.sum(step).over(upto), F.lit(0))
        hits[name] = F.coalesce(F.col("tag").isin(*names), F.lit(False))
    out = tokens.withColumns(cols | (more or {}))
    openers = {}
    for name in targets:
        n, hit = F.col(f"_n_{name}"), hits[name]
        opener = F.last(F.when(hit & (F.col("kind") == "open") & (n == 1), F.col("pos")), ignorenulls=True).over(upto)
        inside = (n > 0) | (hit & (F.col("kind") == "close") & (n == 0))
        own = hit & (F.col("kind") == "void") & (n == 0)
        openers[name] = F.when(own, F.col("pos")).when(inside, opener)
    return out.withColumns(openers).drop(*cols)


def with_openers(marked: DataFrame, **units: str) -> DataFrame:
    """Add, per keyword, the opening token of the element that ``within`` has
    marked in the column named, to all that stands in it: carried along the
    order the tokens have, so nothing is sorted by element."""
    upto = _doc_order().rowsBetween(W.unboundedPreceding, 0)
    seen = {name: F.last(F.when(F.col("pos") == F.col(unit), F.struct("pos", "tok")), ignorenulls=True).over(upto) for name, unit in units.items()}
    own = {name: F.when(F.col(f"{name}.pos") == F.col(unit), F.col(f"{name}.tok")) for name, unit in units.items()}
    return marked.withColumns(seen).withColumns(own)


def with_next(tokens: DataFrame, name: str, value: Column, *parts: str) -> DataFrame:
    """Add ``name``: the value of the next row of the document (and ``parts``)
    that has one. Rows without one are passed over, so that those with one need
    not be sorted apart from them."""
    keys = ", ".join(("doc_id", *parts))
    ahead = F.expr(f"lead(_v) IGNORE NULLS OVER (PARTITION BY {keys} ORDER BY pos)")
    return tokens.withColumn("_v", value).withColumn(name, ahead).drop("_v")


def only(tokens: DataFrame, *tags: str) -> DataFrame:
    """Text and the given tags; the other tags say nothing to the operator, and
    dropping them first keeps the ordered passes short. The tag is asked for
    once, as it is cut from the token each time."""
    return tokens.where(F.coalesce(F.col("tag").isin(*tags), F.lit(True)))


def unwrap(tokens: DataFrame, tags: Iterable[str], pad: Iterable[str] = ()) -> DataFrame:
    """B2: drop the tags but keep their content. A tag in ``pad`` leaves a
    space on each side, which sets the content off once spaces are collapsed."""
    gap = F.coalesce(F.col("tag").isin(list(pad)), F.lit(False))
    spaced = tokens.withColumns(
        {
            "kind": F.when(gap, "text").otherwise(F.col("kind")),
            "tok": F.when(gap, " ").otherwise(F.col("tok")),
            "text": F.when(gap, " ").otherwise(F.col("text")),
            "tag": F.when(~gap, F.col("tag")),
        }
    )
    return spaced.where(F.col("tag").isNull() | ~F.col("tag").isin(list(tags)))


def drop_subtrees(tokens: DataFrame, tags: Iterable[str], where: Column | None = None) -> DataFrame:
    """Remove elements with all they contain. ``where`` narrows the openers
    (say, to one attribute value)."""
    tags = tuple(tags)
    if where is None:
        return within(tokens, _gone=tags).where("_gone is null").drop("_gone")
    # The closer of an element is the next tag of its level. Openers are disjoint
    # or nested, so the furthest end seen so far decides.
    end = F.when(F.col("kind") == "void", F.col("pos")).otherwise(F.lead("pos").over(W.partitionBy("doc_id", "depth", "_t").orderBy("pos")))
    chosen = F.col("tag").isin(*tags) & F.col("kind").isin("open", "void") & where
    marks = tokens.withColumn("_t", F.col("kind") == "text").withColumn("_end", F.when(chosen, end))
    reach = F.max("_end").over(_doc_order().rowsBetween(W.unboundedPreceding, 0))
    return marks.withColumn("_reach", reach).where("_reach is null or pos > _reach").drop("_reach", "_end", "_t")


def trim_before(tokens: DataFrame, tags: Iterable[str], block: Iterable[str] | None = None) -> DataFrame:
    """Drop what stands ahead of the first of ``tags``; documents without
    any keep everything. With ``block``, only the leading element of that name
    is searched and trimmed."""
    tags = list(tags)
    goal = F.col("tag").isin(tags) & F.col("kind").isin("open", "void")
    if block is None:
        first = F.min(F.when(goal, F.col("pos"))).over(W.partitionBy("doc_id"))
        return tokens.withColumn("_first", first).where("_first is null or pos >= _first").drop("_first")
    marked = within(tokens, _blk=tuple(block))
    doc = W.partitionBy("doc_id")
    lead_block = F.min("_blk").over(doc)
    marked = marked.withColumn("_lead", lead_block)
    at = F.min(F.when(goal & (F.col("_blk") == F.col("_lead")), F.col("pos"))).over(doc)
    marked = marked.withColumn("_first", at)
    ahead = F.coalesce((F.col("_blk") == F.col("_lead")) & (F.col("pos") > F.col("_lead")) & (F.col("pos") < F.col("_first")), F.lit(False))
    return marked.where(~ahead).drop("_blk", "_lead", "_first")


def rename_tags(tokens: DataFrame, names: dict[str, str], attrs: dict[str, str] | None = None) -> DataFrame:
    """Rename tags, and attribute names inside tag tokens."""
    tag, tok = F.col("tag"), F.col("tok")
    for old, new in names.items():
        tok = F.when(F.col("tag") == old, F.regexp_replace(tok, rf"^(</?\s*){old}\b", f"$1{new}")).otherwise(tok)
        tag = F.when(F.col("tag") == old, F.lit(new)).otherwise(tag)
    for old, new in (attrs or {}).items():
        tok = F.when(F.col("tag").isNotNull(), F.regexp_replace(tok, rf"(\s){old}=", f"$1{new}=")).otherwise(tok)
    return tokens.withColumn("tok", tok).withColumn("tag", tag)


def serialise(tokens: DataFrame, by: list[str]) -> DataFrame:
    """Put token rows back together as markup, one string per group."""
    return tokens.groupBy(*by).agg(ordered_concat(F.col("pos"), F.col("tok")).alias("markup"))


def element_text(tokens: DataFrame, column: str, name: str = "text") -> DataFrame:
    """Text of every element marked by ``within`` in ``column``."""
    return (
        tokens.where(F.col(column).isNotNull())
        .groupBy("doc_id", F.col(column))
        .agg(ordered_concat(F.col("pos"), F.col("text")).alias(name))
    )


def elements(tokens: DataFrame, *tags: str) -> DataFrame:
    """Every element of the given tags at any depth, also those inside one
    another: ``doc_id, pos, tag, tok, text``. A token counts for each of them
    that is open around it, found level by level as the one opened last."""
    hit = F.col("tag").isin(*tags)
    step = F.when(hit & (F.col("kind") == "open"), 1).when(hit & (F.col("kind") == "close"), -1).otherwise(0)
    level = F.sum(step).over(_doc_order().rowsBetween(W.unboundedPreceding, 0))
    inside = tokens.withColumn("_n", level).where("_n > 0").withColumn("_lvl", F.explode(F.sequence(F.lit(1), "_n")))
    upto = _doc_order("_lvl").rowsBetween(W.unboundedPreceding, 0)
    opened = F.when(hit & (F.col("kind") == "open") & (F.col("_lvl") == F.col("_n")), F.struct("pos", "tag", "tok"))
    owned = inside.withColumn("_own", F.last(opened, ignorenulls=True).over(upto))
    return owned.groupBy("doc_id", F.col("_own.pos").alias("pos"), F.col("_own.tag").alias("tag"), F.col("_own.tok").alias("tok")).agg(
        ordered_concat(F.col("pos"), F.col("text")).alias("text")
    )


def merged_text(rows: DataFrame, *keys: str, least: Iterable[str] = ()) -> DataFrame:
    """First row of each group of ``doc_id`` and ``keys``, with the ``text`` of
    all its rows in order and the smallest value of each column in ``least``.
    One sort on top of the order that tokens stand in; an aggregate that
    collects texts would sort its rows twice, and once more by item after it.
    Every row holds the texts of its group until the first is picked, so this is
    for short elements such as fields, not for paragraphs."""
    spot = W.partitionBy("doc_id", *keys).orderBy("pos")
    whole = spot.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    cols = {"_nth": F.row_number().over(spot), "text": F.array_join(F.collect_list("text").over(whole), "")}
    return rows.withColumns(cols | {name: F.min(name).over(whole) for name in least}).where("_nth = 1").drop("_nth")


def at_own(unit: str, value: str | Column) -> Column:
    """``value`` if the row is the opener of the element marked in ``unit``."""
    return F.when(F.col("pos") == F.col(unit), F.col(value) if isinstance(value, str) else value)


def attr_of(column: str, name: str) -> Column:
    """Attribute of the opening token of the element marked in ``column``, as
    an aggregate over the rows of that element."""
    return F.min(F.when(F.col("pos") == F.col(column), attr(F.col("tok"), name)))


def block_groups(tokens: DataFrame, tags: Iterable[str], name: str = "block") -> DataFrame:
    """B9 for tag soup: number the stretches between block tags, where neither
    closing tags nor nesting can be relied on."""
    hit = F.when(F.col("tag").isin(list(tags)), 1).otherwise(0)
    return tokens.withColumn(name, F.sum(hit).over(_doc_order().rowsBetween(W.unboundedPreceding, 0)))
