"""Character spans: placeholders, offsets, substitution and checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paperloom.functions.ids import UID_PRECEDENCE
from paperloom.functions.text import attr, blank_to_null, ordered_concat, soften_ws
from paperloom.operators.tokens import only, within

# Placeholder names that stand for references in text.
CITE_TOKEN = r"BIBREF\d+"
REF_TOKEN = r"(?:FIGREF|TABREF|EQREF|FOOTREF|SECREFU|SECREF)\d+"
FORMULA_TOKEN = r"(?:INLINEFORM|DISPLAYFORM)\d+"
ANY_TOKEN = rf"(?:{CITE_TOKEN}|{REF_TOKEN}|{FORMULA_TOKEN})"


def placeholder_spans(
    rows: DataFrame, keys: list[str], text: str, pattern: str = ANY_TOKEN, carry: list[str] | None = None
) -> DataFrame:
    """One row per placeholder with half-open offsets into ``text``.

    The text is cut at the placeholders; an offset is the running length of
    the pieces before it. ``carry`` names further columns to keep.
    """
    out = [*keys, *(carry or [])]
    found = F.regexp_extract_all(F.col(text), F.lit(f"({pattern})"), F.lit(1))
    base = rows.where(F.col(text).rlike(pattern)).select(*out, found.alias("_tok"), F.split(F.col(text), pattern).alias("_gap"))
    each = base.select(*out, F.posexplode(F.arrays_zip("_tok", "_gap")).alias("span_no", "_z"))
    each = each.select(*out, "span_no", F.col("_z._tok").alias("ref_id"), F.col("_z._gap").alias("_gap")).where("ref_id is not null")
    upto = W.partitionBy(*keys).orderBy("span_no").rowsBetween(W.unboundedPreceding, 0)
    end = F.sum(F.length("_gap") + F.length("ref_id")).over(upto)
    kind = (
        F.when(F.col("ref_id").startswith("BIBREF"), "cite")
        .when(F.col("ref_id").rlike(f"^{FORMULA_TOKEN}$"), "eq")
        .otherwise("ref")
    )
    return each.withColumn("end", end.cast("int")).select(
        *out, "span_no", kind.alias("kind"), (F.col("end") - F.length("ref_id")).cast("int").alias("start"), "end", "ref_id"
    )


def substitute(spans: DataFrame, keys: list[str], text: str = "para_text") -> DataFrame:
    """Put ``surface`` in place of ``token`` and move every span: the new
    start is the old one plus all length changes ahead of it.

    Expects ``start, end, token, surface`` and the paragraph text on each span;
    adds ``new_start, new_end`` and ``chunk``, the text from the end of the
    previous span to the end of this one.
    """
    order = W.partitionBy(*keys).orderBy("start")
    delta = F.length("surface") - F.length("token")
    moved = F.coalesce(F.sum(delta).over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    gap_from = F.coalesce(F.lag("end").over(order), F.lit(0))
    gap = F.substring(F.col(text), gap_from + 1, F.col("start") - gap_from)
    return spans.withColumns({"new_start": (F.col("start") + moved).cast("int"), "chunk": F.concat(gap, F.col("surface"))}).withColumn(
        "new_end", (F.col("new_start") + F.length("surface")).cast("int")
    )


def substituted_text(moved: DataFrame, keys: list[str], text: str = "para_text") -> DataFrame:
    """Paragraph text after ``substitute``."""
    grouped = moved.groupBy(*keys).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "chunk"))), lambda x: x["chunk"]), "").alias("_head"),
        F.max("end").alias("_end"),
        F.first(text).alias("_old"),
    )
    return grouped.select(*keys, F.concat("_head", F.expr("substring(_old, _end + 1, length(_old))")).alias(text))


def replace_padded(text: Column, spans: Column, pre: str = "", post: str = "", between: str = ", ") -> Column:
    """C11: new text of one paragraph. ``spans`` is an array of
    ``struct<start,end,surface>``. In order of start, a span that begins before
    the last kept one ends is dropped; one that abuts it is set off by
    ``between``; all get ``pre`` and ``post`` once."""
    none = F.expr("cast(array() as array<struct<start:int,end:int,surface:string,joined:boolean>>)")
    start_acc = F.struct(F.lit(0).alias("last"), none.alias("kept"))

    def step(acc, s):
        joined = (s["start"] == acc["last"]) & (F.size(acc["kept"]) > 0)
        item = F.struct(s["start"].alias("start"), s["end"].alias("end"), s["surface"].alias("surface"), joined.alias("joined"))
        keep = (s["start"] >= acc["last"]) | (F.size(acc["kept"]) == 0)
        return F.when(keep, F.struct(s["end"].alias("last"), F.array_append(acc["kept"], item).alias("kept"))).otherwise(acc)

    kept = F.aggregate(F.array_sort(spans), start_acc, step)["kept"]
    ends = F.concat(F.array(F.lit(0)), F.transform(kept, lambda s: s["end"]))
    parts = F.transform(
        kept,
        lambda s, i: F.concat(
            F.substring(text, F.get(ends, i) + 1, s["start"] - F.get(ends, i)),
            F.when(s["joined"], between).otherwise(""), F.lit(pre), s["surface"], F.lit(post),
        ),
    )
    tail = F.substring(text, F.element_at(ends, -1) + 1, F.length(text))
    return F.concat(F.array_join(parts, ""), tail)


def inside_existing(spans: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """C17: spans that lie within any existing span of the same paragraph.

    A span is inside one iff, among existing spans starting no later, the
    furthest end reaches its own; a running maximum tells, without pairs.
    """
    types = dict(spans.dtypes)
    rest = [c for c in spans.columns if c not in (*keys, "start", "end")]
    ours = spans.withColumn("_probe", F.lit(1))
    theirs = existing.select(*keys, "start", "end", *[F.lit(None).cast(types[c]).alias(c) for c in rest], F.lit(0).alias("_probe"))
    w = W.partitionBy(*keys).orderBy("start", "_probe").rowsBetween(W.unboundedPreceding, 0)
    reach = F.max(F.when(F.col("_probe") == 0, F.col("end"))).over(w)
    both = ours.unionByName(theirs).withColumn("_reach", reach)
    return both.where("_probe = 1 and end <= _reach").drop("_probe", "_reach")


def span_checks(spans: DataFrame, keys: list[str], text: str = "para_text", surface: str = "surface") -> DataFrame:
    """Add ``reason`` to spans whose text is not what stands at their
    offsets, or whose start is shared; NULL for good ones."""
    at = F.substring(F.col(text), F.col("start") + 1, F.col("end") - F.col("start"))
    twins = F.count("*").over(W.partitionBy(*keys, "start"))
    return spans.withColumn("reason", F.when(at != F.col(surface), "text_mismatch").when(twins > 1, "duplicate_start"))


def span_violations(spans: DataFrame, keys: list[str], text: str = "para_text", surface: str = "surface") -> DataFrame:
    """The spans that fail, with the reason, for quarantine."""
    return span_checks(spans, keys, text, surface).where("reason is not null")


def resolve_by_precedence(refs: DataFrame, entries: DataFrame) -> DataFrame:
    """Section targets map by name; a ``uid`` target takes the first kind,
    in fixed order, that has an entry with its number; others are upper-cased.

    ``refs``: ``doc_id, target, …``; ``entries``: ``doc_id, ref_id``.
    """
    number = lambda c: F.regexp_extract(c, r"(\d+)$", 1)
    kinds = F.array(*[F.lit(k) for k in UID_PRECEDENCE])
    ranked = entries.select("doc_id", number("ref_id").alias("_num"), "ref_id", F.array_position(kinds, F.regexp_extract("ref_id", r"^(\D+)", 1)).alias("_rank"))
    best = ranked.where("_rank > 0").groupBy("doc_id", "_num").agg(F.min_by("ref_id", "_rank").alias("_best"))
    keyed = refs.withColumn("_num", F.when(F.col("target").startswith("uid"), number("target")))
    joined = keyed.join(best, ["doc_id", "_num"], "left")
    ref_id = (
        F.when(F.col("target").startswith("cid"), F.replace(F.col("target"), F.lit("cid"), F.lit("SECREF")))
        .when(F.col("target").startswith("uid") & F.col("_best").isNotNull(), F.col("_best"))
        .otherwise(F.upper("target"))
    )
    return joined.withColumn("ref_id", ref_id).drop("_num", "_best")


def with_numbers(spans: DataFrame, entries: DataFrame) -> DataFrame:
    """Text of a span is the number of the entry it points to."""
    nums = entries.select("doc_id", "ref_id", F.col("num").alias("text"))
    return spans.join(nums, ["doc_id", "ref_id"], "left")


def marked_spans(tokens: DataFrame, para: str = "p", marks: tuple[str, ...] = ("xref", "sup", "sub")) -> DataFrame:
    """Spans of possibly nested marks, with offsets into the softened
    paragraph text. A pair of spaces may lie across a mark: a run then begins
    without the space that completes the pair.

    Columns: ``doc_id, para_pos, pos, kind`` (cite, fig, table, NULL for other
    references, else the tag of the mark), ``start, end, text, ref_id, para_text``.
    """
    inside = within(only(tokens, para, *marks), _p=para).where("_p is not null")
    is_mark = F.coalesce(F.col("tag").isin(*marks) & F.col("kind").isin("open", "close"), F.lit(False))
    begins = F.col("pos") == F.col("_p")
    # Rows are what gives text, the marks, and the start of each paragraph, where all that is counted begins anew. Counting goes along the
    # document, in the order that the tokens have already, and subtracts what stood ahead of the paragraph.
    line = W.partitionBy("doc_id").orderBy("pos")
    upto = line.rowsBetween(W.unboundedPreceding, 0)
    since = lambda when, value: F.last(F.when(when, value), ignorenulls=True).over(upto)
    pieces = inside.withColumns({"_mark": is_mark, "_raw": F.coalesce(F.regexp_replace("text", r"[^\S\n\t]", " "), F.lit(""))}).where("_mark or _raw <> '' or pos = _p")
    # Spaces at the end of all text so far: those of this row, or, if it has nothing else, one more stretch of them.
    tail = F.length("_raw") - F.length(F.rtrim("_raw"))
    placed = pieces.withColumn("_tail", tail).withColumn("_spaces", F.sum("_tail").over(upto))
    placed = placed.withColumn("_open", (F.col("_spaces") - since(begins | (F.rtrim("_raw") != ""), F.col("_spaces") - F.col("_tail"))) % 2)
    pending = ~begins & (F.lag("_open", 1, 0).over(line) == 1)
    begun = F.when(pending & F.col("_raw").startswith(" "), F.expr("substring(_raw, 2)")).otherwise(F.col("_raw"))
    placed = placed.withColumn("_text", F.replace(begun, F.lit("  "), F.lit(" ")))
    placed = placed.withColumn("_chars", F.sum(F.length("_text")).over(upto) - F.length("_text"))
    placed = placed.withColumn("_at", F.col("_chars") - since(begins, F.col("_chars")))
    level = W.partitionBy("doc_id", "_p", "_level").orderBy("pos")
    placed = placed.withColumn("_level", F.when(F.col("_mark"), F.col("depth"))).withColumn("_until", F.lead("_at").over(level))
    ref_type = attr(F.col("tok"), "ref-type")
    kind = F.when(F.col("tag") != "xref", F.col("tag")).when(ref_type == "bibr", "cite").when(ref_type.isin("fig", "table"), ref_type)
    # The text of a mark is all that stands inside it, cut from the paragraph text, which is put together once. One row a paragraph holds both.
    opened = F.when(F.col("_mark") & (F.col("kind") == "open"), F.struct("pos", kind.alias("kind"), "_at", "_until", attr(F.col("tok"), "rid").alias("ref_id")))
    whole = placed.where("doc_id is not null").groupBy("doc_id", F.col("_p").alias("para_pos")).agg(
        ordered_concat(F.col("pos"), blank_to_null(F.col("_text"))).alias("para_text"), F.collect_list(opened).alias("_marks")
    )
    spans = whole.select("doc_id", "para_pos", "para_text", F.explode("_marks").alias("_s")).select("doc_id", "para_pos", "para_text", "_s.*")
    return spans.select(
        "doc_id", "para_pos", "pos", "kind", F.col("_at").cast("int").alias("start"), F.col("_until").cast("int").alias("end"),
        F.substring(F.col("para_text"), F.col("_at") + 1, F.col("_until") - F.col("_at")).alias("text"), "ref_id", "para_text",
    )


def merge_ref_spans(spans: DataFrame, new_keys: DataFrame) -> DataFrame:
    """Figure and table spans become reference spans; ids are replaced by
    the new keys (``doc_id, old_key, ref_id``), unknown ones by NULL."""
    picked = spans.where("kind in ('fig', 'table')").withColumnRenamed("ref_id", "old_key").withColumn("kind", F.lit("ref"))
    return picked.join(new_keys.select("doc_id", "old_key", "ref_id"), ["doc_id", "old_key"], "left").drop("old_key")


def dense_keys(entries: DataFrame, prefix: Column, keep: Column | None = None) -> DataFrame:
    """Number entries of each document and type by old key as text, from
    zero; entries that fail ``keep`` still use up a number."""
    rn = F.row_number().over(W.partitionBy("doc_id", "type").orderBy("old_key")) - 1
    out = entries.withColumn("ref_id", F.concat(prefix, rn))
    return out if keep is None else out.where(keep)


def number_in_order(items: DataFrame, name: str = "num") -> DataFrame:
    """Ordinal of an item in its document's list, from zero."""
    rn = F.row_number().over(W.partitionBy("doc_id").orderBy("pos")) - 1
    return items.withColumn(name, rn.cast("int"))


def formula_pieces(tokens: DataFrame, para: str = "p") -> DataFrame:
    """Pieces of paragraphs in which a formula is replaced by a token named
    after its place: INLINEFORM0, … without an id, DISPLAYFORM0, … with one.
    Payload columns: ``math, latex, target``."""
    marked = within(only(tokens, para, "formula", "math", "texmath"), _p=para, _f="formula", _m="math", _t="texmath").where("_p is not null")
    unit = F.coalesce("_f", F.when(F.col("kind") == "text", F.col("pos")))
    is_f = F.max(F.col("_f").isNotNull())
    pieces = marked.withColumn("_u", unit).where("_u is not null and kind <> 'close'").groupBy("doc_id", F.col("_p").alias("para_pos"), F.col("_u").alias("pos")).agg(
        F.when(is_f, "ref").otherwise("text").alias("kind"),
        ordered_concat(F.col("pos"), F.when(F.col("_f").isNull(), F.col("text"))).alias("text"),
        F.when(is_f, ordered_concat(F.col("pos"), F.when(F.col("_m").isNotNull(), F.col("text")))).alias("math"),
        F.when(is_f, ordered_concat(F.col("pos"), F.when(F.col("_t").isNotNull(), F.col("text")))).alias("latex"),
        F.min(F.when(F.col("pos") == F.col("_f"), attr(F.col("tok"), "id"))).alias("target"),
    )
    name = F.when(F.col("target").isNotNull(), "DISPLAYFORM").otherwise("INLINEFORM")
    counted = W.partitionBy("doc_id", "para_pos", "kind", F.col("target").isNotNull()).orderBy("pos")
    named = F.when(F.col("kind") == "ref", F.concat(name, F.row_number().over(counted) - 1)).otherwise(F.col("text"))
    is_ref = F.col("kind") == "ref"
    return pieces.withColumn("text", named).withColumns({"sub": F.lit(0), "padded": is_ref, "is_span": is_ref})


#: Places between two positions of the tokens of ``formula_tokens``.
FORMULA_ROOM = 8


def formula_tokens(tokens: DataFrame, tag: str = "inline-formula", para: str = "p") -> DataFrame:
    """C12, JATS: tokens in which the content of a formula in a paragraph is its
    name, INLINEFORM0 and so on by paragraph, with a blank on each side of the
    element. Positions are spread by FORMULA_ROOM, so that the blanks find room."""
    marked = within(tokens, _p=para, _f=tag)
    formula = F.col("_p").isNotNull() & F.col("_f").isNotNull()
    own = formula & (F.col("pos") == F.col("_f"))
    count = F.sum(F.when(own, 1).otherwise(0)).over(W.partitionBy("doc_id", "_p").orderBy("pos").rowsBetween(W.unboundedPreceding, 0))
    level = F.min(F.when(own, F.col("depth"))).over(W.partitionBy("doc_id", "_f"))
    named = marked.withColumns({"_name": F.concat(F.lit("INLINEFORM"), count - 1), "_level": level})
    plain = lambda at, value: F.struct((FORMULA_ROOM * F.col("pos") + at).alias("pos"), F.lit("text").alias("kind"), F.lit(None).cast("string").alias("tag"), value.alias("tok"), value.alias("text"))
    self = lambda at, kind: F.struct((FORMULA_ROOM * F.col("pos") + at).alias("pos"), kind.alias("kind"), "tag", "tok", "text")
    blank, name = F.lit(" "), F.col("_name")
    start = F.array(plain(0, blank), self(1, F.lit("open")), plain(2, name))
    end = F.array(self(0, F.lit("close")), plain(1, blank))
    last = formula & (F.col("tag") == tag) & (F.col("kind") == "close") & (F.col("depth") == F.col("_level"))
    whole = F.array(plain(0, blank), self(1, F.lit("open")), plain(2, name), self(3, F.lit("close")), plain(4, blank))
    shown = F.when(~F.coalesce(formula, F.lit(False)), F.array(self(0, F.col("kind")))).when(own & (F.col("kind") == "void"), whole).when(own, start).when(last, end)
    rows = named.select("doc_id", "depth", F.explode(shown).alias("_r"))
    return rows.select("doc_id", "_r.pos", "_r.kind", "_r.tag", "_r.tok", "_r.text", "depth")


def bibitems(tokens: DataFrame) -> DataFrame:
    """Bibliography items with an id, in list order."""
    own = tokens.where((F.col("tag") == "bibitem") & (F.col("kind") != "close"))
    return own.select("doc_id", "pos", attr(F.col("tok"), "id").alias("bib_id")).where("bib_id is not null")
