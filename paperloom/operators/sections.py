"""Sections, paragraphs, sentences and the parts of a paper they belong to."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paperloom.functions.text import attr, blank_to_null, collapse_ws, ordered_concat, ordered_list, tidy
from paperloom.operators.tokens import attr_of, element_text, only, within

SECTION_SEP = "::"
# Markers a paragraph may carry for references and raised or
# lowered text; they never belong in a section name.
MARKERS = r"[#@&]!(?:start|sep|end)[#@&]"
EQUATION = "EQUATION"


def nest_level(tokens: DataFrame, tags: Iterable[str], name: str = "nest") -> DataFrame:
    """Number of open elements of ``tags`` at each token, itself included."""
    return tokens.withColumn(name, _nest(tags))


def _nest(tags: Iterable[str]) -> Column:
    hit = F.col("tag").isin(list(tags))
    step = F.when(hit & (F.col("kind") == "open"), 1).when(hit & (F.col("kind") == "close"), -1).otherwise(0)
    upto = W.partitionBy("doc_id").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    level = F.sum(step).over(upto) + F.when(hit & (F.col("kind") == "close"), 1).otherwise(0)
    return level.cast("int")


def sectioned_paragraphs(
    tokens: DataFrame,
    sections: Iterable[str],
    head: str = "head",
    paras: Iterable[str] = ("p",),
    num: Column | None = None,
    head_num: str | None = "n",
    sec_id: Column | None = None,
    carry: bool = False,
    normalise=collapse_ws,
    given: str | None = None,
    names: DataFrame | None = None,
) -> DataFrame:
    """Paragraphs with the path of named sections around them.

    A section is named by the text of the first ``head`` directly inside it and
    numbered by an attribute of that head (``head_num``) or of its own (``num``).
    ``section`` joins the names from the root down, ``sec_num`` is the number of
    the innermost named one, ``sec_id`` the id of the innermost, ``tag`` that of
    the paragraph element. With ``carry``
    a paragraph outside every section stays with the last top-level one. A
    column ``given`` names the paragraph of each token, where the tags alone do
    not (see ``item_units``). ``names`` (``doc_id, pos, name``) are names of
    sections that have no head.

    One pass brings tokens down to units (sections, heads, paragraphs). Then
    each unit looks at every level up to its own for the section opened last at
    that level, which is the one around it: no pairs, no joins, any depth.
    """
    secs = list(sections)
    kept, nest = only(tokens, *secs, *paras, head), {"nest": _nest(secs)}
    marked = within(kept, nest, _p=tuple(paras), _h=head) if given is None else within(kept, nest, _h=head).withColumn("_p", F.col(given))
    is_sec = F.col("tag").isin(secs) & (F.col("kind") == "open")
    unit = F.coalesce("_p", "_h", F.when(is_sec, F.col("pos")))
    at_start = F.col("pos") == F.col("_unit")
    none = F.lit(None).cast("string")
    units = marked.withColumn("_unit", unit).where("_unit is not null and kind <> 'close'").groupBy("doc_id", F.col("_unit").alias("pos")).agg(
        F.min(F.when(at_start, F.when(F.col("_p").isNotNull(), "para").when(F.col("_h").isNotNull(), "head").otherwise("sec"))).alias("what"),
        F.min(F.when(at_start, F.col("tag"))).alias("tag"),
        F.min(F.when(at_start, F.col("nest"))).alias("nest"),
        F.min(F.when(at_start, F.col("depth"))).alias("depth"),
        ordered_concat(F.col("pos"), F.col("text")).alias("text"),
        F.min(F.when(at_start, sec_id if sec_id is not None else none)).alias("sec_id"),
        F.min(F.when(at_start, num if num is not None else none)).alias("_num"),
        F.min(F.when(at_start, attr(F.col("tok"), head_num) if head_num else none)).alias("_head_num"),
    )
    sec_row = F.col("what") == "sec"
    level = W.partitionBy("doc_id", "nest").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    turn = units.withColumns(
        {
            "_turn": F.sum(F.when(sec_row, 1).otherwise(0)).over(level),
            "_base": F.last(F.when(sec_row, F.col("depth")), ignorenulls=True).over(level),
        }
    )
    direct = (F.col("what") == "head") & (F.col("depth") == F.col("_base") + 1)
    own_head = F.min_by(F.struct("text", "_head_num"), F.when(direct, F.col("pos"))).over(W.partitionBy("doc_id", "nest", "_turn"))
    named = turn.withColumn("_head", own_head).where("what <> 'head'")
    name = F.regexp_replace(tidy(F.col("_head.text")), MARKERS, "")
    if names is not None:
        given_names = names.select("doc_id", "pos", F.lit("sec").alias("what"), blank_to_null(tidy(F.col("name"))).alias("_given_name"))
        named = named.join(given_names, ["doc_id", "pos", "what"], "left")
        name = F.coalesce(name, F.col("_given_name"))
    named = named.withColumn("_seat", F.when(sec_row, F.struct(F.coalesce("_num", "_head._head_num").alias("num"), name.alias("name"), "sec_id")))
    top = F.greatest("nest", F.lit(1)) if carry else F.col("nest")
    steps = named.select(
        "doc_id", "pos", "nest", "what", "tag", "text", "_seat", F.explode_outer(F.when(top > 0, F.sequence(F.lit(1), top))).alias("_lvl")
    )
    seat = F.last(F.when(F.col("_lvl") == F.col("nest"), F.col("_seat")), ignorenulls=True)
    upto = W.partitionBy("doc_id", "_lvl").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    found = steps.withColumn("_at", seat.over(upto)).where("what = 'para'")
    paths = found.groupBy("doc_id", "pos").agg(
        F.first("text").alias("text"),
        F.first("tag").alias("tag"),
        ordered_list(F.col("_lvl"), F.when(F.col("_at.name").isNotNull(), F.struct("_at.num", "_at.name"))).alias("path"),
        F.max_by("_at.sec_id", "_lvl").alias("sec_id"),
    )
    out = paths.select("doc_id", "pos", "tag", "sec_id", "path", *[c.alias(n) for n, c in path_columns().items()], normalise(F.col("text")).alias("para_text"))
    return out.where(F.trim("para_text") != "")


def path_columns(path: str = "path") -> dict[str, Column]:
    """``section`` (names joined) and ``sec_num`` (number of the innermost)."""
    p = F.col(path)
    return {
        "section": F.coalesce(F.array_join(F.transform(p, lambda s: s["name"]), SECTION_SEP), F.lit("")),
        "sec_num": F.when(F.size(p) > 0, F.element_at(p, -1)["num"]),
    }


def paragraph_rows(tokens: DataFrame, tags: Iterable[str] = ("p",), formula: str | None = "formula", normalise=collapse_ws) -> DataFrame:
    """One row per paragraph element with its text, empty ones dropped. A
    ``formula`` outside every paragraph becomes a paragraph of its own that
    reads EQUATION and keeps the raw text and label.

    ``normalise`` maps the paragraph text column to the stored one.
    """
    marks = {"_p": tuple(tags)}
    if formula:
        marks |= {"_f": formula, "_l": "label"}
    marked = within(tokens, **marks)
    if not formula:
        marked = marked.withColumns({"_f": F.lit(None).cast("int"), "_l": F.lit(None).cast("int")})
    unit = F.coalesce("_p", "_f")
    is_para = F.max(F.col("_p").isNotNull())
    joined = lambda keep: ordered_concat(F.col("pos"), F.when(keep, F.col("text")))
    return (
        marked.withColumn("_unit", unit)
        .where("_unit is not null")
        .groupBy("doc_id", F.col("_unit").alias("pos"))
        .agg(
            F.when(is_para, normalise(joined(F.lit(True)))).otherwise(EQUATION).alias("para_text"),
            F.when(~is_para, joined(F.col("_l").isNull())).alias("raw_str"),
            F.when(~is_para, blank_to_null(joined(F.col("_l").isNotNull()))).alias("eq_num"),
        )
        .where(F.trim("para_text") != "")
    )


def number_paragraphs(paras: DataFrame, name: str = "para_no") -> DataFrame:
    """Paragraph number within the document, from zero."""
    rn = F.row_number().over(W.partitionBy("doc_id").orderBy("pos")) - 1
    return paras.withColumn(name, rn.cast("int"))


def sentence_rows(tokens: DataFrame, para: str = "p", sent: str = "s") -> DataFrame:
    """One row per sentence element, with coordinates; a paragraph without
    any gives one sentence, its whole text."""
    marked = within(only(tokens, para, sent), _p=para, _s=sent).where("_p is not null")
    rows = marked.groupBy("doc_id", F.col("_p").alias("para_pos"), "_s").agg(
        F.min("pos").alias("pos"),
        collapse_ws(ordered_concat(F.col("pos"), F.col("text"))).alias("sentence"),
        attr_of("_s", "coords").alias("coords"),
    )
    split = F.max(F.col("_s").isNotNull()).over(W.partitionBy("doc_id", "para_pos"))
    kept = rows.withColumn("_split", split).where("_s is not null or (not _split and trim(sentence) <> '')")
    order = W.partitionBy("doc_id").orderBy("para_pos")
    inner = W.partitionBy("doc_id", "para_pos").orderBy("pos")
    return kept.select(
        "doc_id",
        "para_pos",
        (F.dense_rank().over(order) - 1).cast("int").alias("para_no"),
        (F.row_number().over(inner) - 1).cast("int").alias("sent_no"),
        "sentence",
        "coords",
    )


def select_abstract(tokens: DataFrame, container: str = "abstract") -> DataFrame:
    """Abstract paragraphs by the first rule that applies: paragraphs in
    divisions; else text of divisions that have none; else bare paragraphs;
    else all text. Every row is labelled ``Abstract``."""
    inner = within(tokens, _a=container).where("_a is not null").drop("_a")
    marked = within(inner, _d="div", _p="p")
    per_div = W.partitionBy("doc_id", "_d")
    has_p = F.max(F.col("_p").isNotNull()).over(per_div)
    has_div = F.max(F.col("_d").isNotNull()).over(W.partitionBy("doc_id"))
    level = (
        F.when(F.col("_d").isNotNull(), F.when(has_p, F.when(F.col("_p").isNotNull(), 0)).otherwise(0))
        .when(~has_div & F.col("_p").isNotNull(), 1)
        .when(~has_div, 2)
    )
    unit = F.when(F.col("_p").isNotNull(), F.col("_p")).when(F.col("_d").isNotNull() & ~has_p, F.col("_d")).otherwise(F.lit(-1))
    rows = marked.withColumns({"_level": level, "_unit": unit}).where("_level is not null")
    texts = rows.groupBy("doc_id", "_level", "_unit").agg(collapse_ws(ordered_concat(F.col("pos"), F.col("text"))).alias("para_text"), F.min("pos").alias("pos"))
    texts = texts.where(F.trim("para_text") != "")
    best = F.min("_level").over(W.partitionBy("doc_id"))
    chosen = texts.withColumn("_best", best).where("_level = _best")
    return number_paragraphs(chosen).select("doc_id", "pos", "para_no", F.lit("Abstract").alias("section"), "para_text")


def leading_paragraphs(tokens: DataFrame, block: str, sectioned: Iterable[str]) -> DataFrame:
    """B12, LaTeX fallback: without an abstract element, the unsectioned
    paragraphs directly inside the leading block."""
    marked = within(tokens, _b=block, _d=tuple(sectioned), _a="abstract", _p="p")
    has = F.max(F.col("_a").isNotNull()).over(W.partitionBy("doc_id"))
    rows = marked.withColumn("_has", has).where("not _has and _b is not null and _d is null and _p is not null")
    texts = element_text(rows, "_p", "para_text").withColumnRenamed("_p", "pos")
    return number_paragraphs(texts.withColumn("para_text", collapse_ws(F.col("para_text"))).where("trim(para_text) <> ''")).select(
        "doc_id", "para_no", F.lit("Abstract").alias("section"), "para_text"
    )


def back_matter(tokens: DataFrame, container: str = "back") -> DataFrame:
    """Divisions inside divisions of the back part; the section is their
    head, else the type of the division around them."""
    inner = within(tokens, _b=container).where("_b is not null").drop("_b")
    marked = within(nest_level(inner, ["div"]), _outer="div", _head="head").where("_outer is not null")
    around = W.partitionBy("doc_id", "_outer")
    kind = F.min(F.when(F.col("pos") == F.col("_outer"), attr(F.col("tok"), "type"))).over(around)
    child = F.when((F.col("tag") == "div") & (F.col("kind") == "open") & (F.col("nest") == 2), F.col("pos"))
    seat = F.last(child, ignorenulls=True).over(around.orderBy("pos").rowsBetween(W.unboundedPreceding, 0))
    placed = marked.withColumns({"_type": F.coalesce(kind, F.lit("")), "_child": seat}).where("nest >= 2")
    units = placed.groupBy("doc_id", F.col("_child").alias("pos"), "_type").agg(
        tidy(ordered_concat(F.col("pos"), F.when(F.col("_head").isNull(), F.col("text")))).alias("para_text"),
        blank_to_null(tidy(ordered_concat(F.col("pos"), F.when(F.col("_head").isNotNull(), F.col("text"))))).alias("_title"),
        F.min(F.when(F.col("pos") == F.col("_head"), attr(F.col("tok"), "n"))).alias("sec_num"),
    )
    out = number_paragraphs(units.where("para_text <> ''"))
    return out.select("doc_id", "pos", "para_no", F.coalesce("_title", "_type").alias("section"), "sec_num", "para_text")


def back_units(tokens: DataFrame) -> DataFrame:
    """Tokens of the back part in which each inner division stands on its own,
    without the division around it and without heads."""
    levelled = nest_level(within(tokens, _head="head").where("_head is null").drop("_head"), ["div"])
    return levelled.where("nest > 1").drop("nest")


def section_names(tokens: DataFrame, tags: Iterable[str], limit: int | None = 50) -> DataFrame:
    """``doc_id, pos, sec_id, name`` of every section at any depth: the head
    directly inside, else the leading pieces that are not paragraphs and are
    shorter than ``limit`` (a rule of the converter; None for any length), up to
    the first that is not. A token belongs to each section around it."""
    secs = list(tags)
    is_sec = F.col("tag").isin(secs) & (F.col("kind") == "open")
    marked = nest_level(tokens, secs).where("nest > 0")
    steps = marked.withColumn("_lvl", F.explode(F.sequence(F.lit(1), "nest")))
    upto = W.partitionBy("doc_id", "_lvl").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    own = F.struct("pos", "depth", attr(F.col("tok"), "id").alias("id"))
    steps = steps.withColumn("_s", F.last(F.when(is_sec & (F.col("_lvl") == F.col("nest")), own), ignorenulls=True).over(upto))
    marked = steps.where("depth > _s.depth").select("*", F.col("_s.pos").alias("_sec"), F.col("_s.id").alias("sec_id"))
    child_start = (F.col("depth") == F.col("_s.depth") + 1) & F.col("kind").isin("open", "void", "text")
    inside = W.partitionBy("doc_id", "_sec").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    marked = marked.withColumn("_child", F.sum(F.when(child_start, 1).otherwise(0)).over(inside))
    kids = marked.groupBy("doc_id", "_sec", "sec_id", "_child").agg(
        F.min(F.when(child_start, F.col("tag"))).alias("_tag"),
        F.trim(ordered_concat(F.col("pos"), F.col("text"))).alias("_text"),
    )
    stop = F.coalesce(F.col("_tag"), F.lit("")) == "p"
    if limit is not None:
        stop |= F.length("_text") >= limit
    prior = W.partitionBy("doc_id", "_sec").orderBy("_child").rowsBetween(W.unboundedPreceding, 0)
    kids = kids.withColumn("_stopped", F.max(stop).over(prior))
    return kids.groupBy("doc_id", F.col("_sec").alias("pos"), "sec_id").agg(
        F.coalesce(
            F.min_by("_text", F.when(F.col("_tag") == "head", F.col("_child"))),
            F.trim(ordered_concat(F.col("_child"), F.when(~F.col("_stopped"), F.col("_text")), " ")),
        ).alias("name")
    )


def section_texts(tokens: DataFrame, tags: Iterable[str], head: str = "head") -> DataFrame:
    """Name of every section at any depth: the text of the head directly inside."""
    secs = list(tags)
    marked = within(nest_level(tokens, secs), _h=head)
    is_sec = F.col("tag").isin(secs) & (F.col("kind") == "open")
    level = W.partitionBy("doc_id", "nest").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    around = F.last(F.when(is_sec, F.struct("pos", "depth")), ignorenulls=True).over(level)
    heads = marked.withColumn("_sec", around).where("_h is not null")
    texts = heads.groupBy("doc_id", "_h").agg(
        F.min(F.when(F.col("pos") == F.col("_h"), F.col("_sec"))).alias("_sec"),
        F.min(F.when(F.col("pos") == F.col("_h"), F.col("depth"))).alias("_depth"),
        tidy(ordered_concat(F.col("pos"), F.col("text"))).alias("_name"),
    )
    return texts.where("_depth = _sec.depth + 1").groupBy("doc_id", F.col("_sec.pos").alias("pos")).agg(F.min_by("_name", "_h").alias("name"))


def list_items(items: DataFrame, text: str = "item_text", number: str = "list_num", is_item: Column | None = None) -> DataFrame:
    """B15, text side: settings items (``[…]``) are dropped, numbered ones get
    ``n. `` in front; ``shift`` is what spans in them must move by. Rows that
    are not items (``is_item``) stay as they are."""
    prefix = F.when(F.col(number).isNotNull(), F.concat(F.col(number), F.lit(". "))).otherwise("")
    trimmed = F.trim(text)
    setting = trimmed.startswith("[") & trimmed.endswith("]")
    return items.where(~setting if is_item is None else ~setting | ~is_item).withColumns(
        {"para_text": F.concat(prefix, F.col(text)), "shift": F.length(prefix)}
    )


def item_units(tokens: DataFrame, paras: Iterable[str]) -> DataFrame:
    """Add ``para_at``, the position of the paragraph of each token. That is
    the outermost of ``paras``, unless an ``item`` stands around it: then the
    innermost item, so that an item in a list in an item is a paragraph of its
    own. The item opened last at a token's level of items is the one around it."""
    marked = within(nest_level(tokens, ["item"], "_deep"), _outer=tuple(paras), _top="item")
    level = W.partitionBy("doc_id", "_deep").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    opened = F.when((F.col("tag") == "item") & (F.col("kind") == "open"), F.col("pos"))
    inner = F.last(opened, ignorenulls=True).over(level)
    plain = F.col("_top").isNull() | (F.col("_outer") < F.col("_top"))
    unit = F.when(plain, F.col("_outer")).when(F.col("_deep") > 0, inner)
    return marked.withColumn("para_at", unit).drop("_deep", "_outer", "_top")


def item_marks(tokens: DataFrame) -> DataFrame:
    """``doc_id, pos, given_num, list_pos, ordered`` of every item: its own
    number and the list directly around it."""
    lists = nest_level(tokens.where(F.col("tag").isin("list", "item")), ["list"], "_deep")
    level = W.partitionBy("doc_id", "_deep").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    opened = F.when((F.col("tag") == "list") & (F.col("kind") == "open"), F.struct("pos", attr(F.col("tok"), "type").alias("type")))
    seat = lists.withColumn("_list", F.last(opened, ignorenulls=True).over(level))
    own = seat.where((F.col("tag") == "item") & (F.col("kind") != "close"))
    ordered = F.coalesce(F.col("_list.type").isin("ordered", "enumerate"), F.lit(False))
    return own.select("doc_id", "pos", attr(F.col("tok"), "id-text").alias("given_num"), F.col("_list.pos").alias("list_pos"), ordered.alias("ordered"))


def itemised(paras: DataFrame, marks: DataFrame) -> DataFrame:
    """Paragraphs (``doc_id, pos, para_text, spans``) of which some are list
    items: settings go, and items of ordered lists get their own number, else
    their place in the list, in front; their spans move along, ids kept."""
    rows = paras.join(marks, ["doc_id", "pos"], "left").withColumnRenamed("para_text", "_plain")
    is_item = F.col("ordered").isNotNull()
    kept = list_items(rows.withColumn("_none", F.lit(None).cast("string")), "_plain", "_none", is_item)
    place = F.row_number().over(W.partitionBy("doc_id", "list_pos").orderBy("pos"))
    counted = kept.withColumn("_num", F.coalesce("given_num", F.when(F.col("ordered"), place.cast("string"))))
    out = list_items(counted, "_plain", "_num", is_item)
    moved = F.transform("spans", lambda s: s.withField("start", s["start"] + F.col("shift")).withField("end", s["end"] + F.col("shift")))
    return out.withColumn("spans", moved).drop("_plain", "_none", "_num", "shift", "given_num", "list_pos", "ordered")


def abstract_zones(tokens: DataFrame, blocks: Iterable[str], sectioned: Iterable[str], unit: str = "para_at") -> DataFrame:
    """B12 over zones: ``doc_id, pos, in_abstract`` of every paragraph of ``unit``.
    Paragraphs of an ``abstract`` make the abstract; in a document without one,
    those directly inside the leading block and outside its divisions do."""
    marked = within(tokens, _a="abstract", _b=tuple(blocks), _d=tuple(sectioned))
    doc = W.partitionBy("doc_id")
    upto = doc.orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    base = F.last(F.when(F.col("pos") == F.col("_b"), F.col("depth")), ignorenulls=True).over(upto)
    marked = marked.withColumns({"_base": base, "_first": F.min("_b").over(doc), "_has": F.max(F.col("_a").isNotNull()).over(doc)})
    lead = F.col("_b").isNotNull() & (F.col("_b") == F.col("_first")) & F.col("_d").isNull() & (F.col("tag") == "p") & (F.col("depth") == F.col("_base") + 1)
    inside = F.when(F.col("_has"), F.col("_a").isNotNull()).otherwise(lead)
    return marked.where(F.col("pos") == F.col(unit)).select("doc_id", "pos", F.coalesce(inside, F.lit(False)).alias("in_abstract"))


def item_rows(tokens: DataFrame) -> DataFrame:
    """Items of lists with their number and text."""
    marked = within(tokens, _i="item").where("_i is not null")
    return marked.groupBy("doc_id", F.col("_i").alias("pos")).agg(
        collapse_ws(ordered_concat(F.col("pos"), F.col("text"))).alias("item_text"), attr_of("_i", "id-text").alias("list_num")
    )


def shift_spans(spans: DataFrame, by: str = "shift") -> DataFrame:
    """B15, span side: move spans by the ``shift`` of their item, keeping ids."""
    return spans.withColumns({"start": F.col("start") + F.col(by), "end": F.col("end") + F.col(by)})


def titles(tokens: DataFrame, tag: str = "title") -> DataFrame:
    """The title of level ``a``, else the first; coordinates default to 1."""
    marked = within(only(tokens, tag), _t=tag).where("_t is not null")
    each = marked.groupBy("doc_id", "_t").agg(
        ordered_concat(F.col("pos"), F.col("text")).alias("_text"), attr_of("_t", "level").alias("_level"), attr_of("_t", "coords").alias("_coords")
    )
    rank = F.struct(~F.coalesce(F.col("_level") == "a", F.lit(False)), F.col("_t"))
    best = each.groupBy("doc_id").agg(F.min_by(F.struct("_text", "_coords"), rank).alias("_b"))
    return best.select("doc_id", F.col("_b._text").alias("title"), F.coalesce("_b._coords", F.lit("1")).alias("coords"))


def coordinate_boxes(df: DataFrame, keys: list[str], coords: str = "coords") -> DataFrame:
    """``p,x,y,w,h;p,x,…`` as one row per box."""
    boxes = df.select(*keys, F.posexplode(F.split(coords, ";")).alias("box_no", "_b")).where("trim(_b) <> ''")
    part = F.split("_b", ",")
    return boxes.select(
        *keys,
        "box_no",
        F.get(part, F.lit(0)).try_cast("int").alias("page"),
        *[F.get(part, F.lit(i)).try_cast("double").alias(c) for i, c in enumerate(("x", "y", "w", "h"), 1)],
    )


