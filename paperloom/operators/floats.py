"""Figures, tables, equations, footnotes and supplements of a paper."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paperloom.functions.ids import tei_key
from paperloom.functions.text import attr, blank_to_null, first_by, ordered_concat, ordered_list, soften_ws, tidy
from paperloom.operators.tokens import at_own, attr_of, only, rename_tags, with_openers, within

# Order in which kinds of entry override each other.
ENTRY_PRECEDENCE = ["equation", "figure", "table", "footnote", "section"]
TEX_DOCUMENT = r"\\begin\{document\}(.+)\\end\{document\}"


def _own(column: str, name: str) -> Column:
    return attr_of(column, name)


def _part(column: str, keep: Column | None = None) -> Column:
    inside = F.col(column).isNotNull() if keep is None else F.col(column).isNotNull() & keep
    return ordered_concat(F.col("pos"), F.when(inside, F.col("text")))


def _renamed(c: Column, prefix: str) -> Column:
    return F.replace(c, F.lit("uid"), F.lit(prefix))


def tei_entries(tokens: DataFrame) -> DataFrame:
    """Figures and tables with an id. Caption: description, else (for
    tables) head. A figure's number is the text of its own label when that is
    all digits. Tables keep their markup with row and cell tags renamed."""
    marked = within(tokens, _i="figure", _d="figDesc", _h="head", _l="label", _t="table").where("_i is not null")
    marked = rename_tags(marked, {"row": "tr", "cell": "td"}, {"cols": "colspan"})
    markup = ordered_concat(F.col("pos"), F.when(F.col("_t").isNotNull(), F.col("tok")))
    label = F.trim(_part("_l"))
    rows = marked.groupBy("doc_id", F.col("_i").alias("pos")).agg(
        F.min(at_own("_i", "tok")).alias("_tok"),
        F.max(F.col("_d").isNotNull()).alias("_has"),
        F.trim(_part("_d")).alias("_desc"),
        F.trim(_part("_h")).alias("_head"),
        label.alias("_label"),
        markup.alias("_markup"),
    )
    rows = rows.withColumns({"_id": attr(F.col("_tok"), "xml:id"), "type": F.coalesce(attr(F.col("_tok"), "type"), F.lit("figure"))})
    table = F.col("type") == "table"
    return rows.where("_id is not null").select(
        "doc_id",
        tei_key(F.col("_id")).alias("ref_id"),
        F.when(table, "table").otherwise("figure").alias("type"),
        F.when(F.col("_has"), F.col("_desc")).when(table, F.col("_head")).otherwise("").alias("text"),
        F.when(table, F.col("_markup")).otherwise("").alias("content"),
        F.when(table, F.col("_id")).when(F.col("_label").rlike(r"^\d+$"), F.col("_label")).alias("fig_num"),
    )


def _file_name(token: Column) -> Column:
    return F.concat_ws(".", attr(token, "file"), F.when(attr(token, "file").isNotNull(), attr(token, "extension")))


def latex_figures(tokens: DataFrame) -> DataFrame:
    """Figure floats, and figures with an id outside them. Files come from
    the figure itself, else from its sub-figures; the caption of a float is its
    caption element, that of a bare figure all its text; formula source goes."""
    kept = only(tokens, "float", "figure", "subfigure", "caption", "texmath")
    marked = within(kept, _f="float", _g="figure", _c="caption", _x="texmath")
    marked = with_openers(marked.where("(_f is not null or _g is not null) and kind <> 'close'"), _float_tok="_f")
    rows = marked.where(F.col("_f").isNull() | (attr(F.col("_float_tok"), "name") == "figure"))
    rows = rows.withColumn("_i", F.coalesce("_f", "_g"))
    clean = F.col("_x").isNull()
    file = F.when(F.col("tag").isin("figure", "subfigure") & F.col("kind").isin("open", "void"), blank_to_null(_file_name(F.col("tok"))))
    figs = rows.groupBy("doc_id", "_i", "_g").agg(
        F.min("pos").alias("_p"),
        F.max(file_of(F.col("_g"), file)).alias("_file"),
        ordered_list(F.col("pos"), F.when(F.col("tag") == "subfigure", file)).alias("_subs"),
        F.min(at_own("_i", "tok")).alias("_tok"),
        F.max(F.col("_f").isNotNull()).alias("_float"),
        F.max(F.col("_c").isNotNull()).alias("_has"),
        ordered_concat(F.col("pos"), F.when((F.col("_c").isNotNull()) & clean, F.col("text"))).alias("_cap"),
        ordered_concat(F.col("pos"), F.when(clean, F.col("text"))).alias("_all"),
    )
    files = F.when(F.col("_g").isNull(), F.lit(None)).when(F.col("_file").isNotNull(), F.array("_file")).otherwise(F.col("_subs"))
    out = figs.groupBy("doc_id", F.col("_i").alias("pos")).agg(
        F.min("_tok").alias("_tok"),
        F.flatten(ordered_list(F.col("_p"), files)).alias("uris"),
        F.when(F.max("_float"), F.when(F.max("_has"), tidy(ordered_concat(F.col("_p"), F.col("_cap"))))).otherwise(
            blank_to_null(tidy(ordered_concat(F.col("_p"), F.col("_all"))))
        ).alias("text"),
    )
    out = out.withColumns({"_id": attr(F.col("_tok"), "id"), "num": attr(F.col("_tok"), "id-text")})
    return out.where("_id is not null").select("doc_id", _renamed(F.col("_id"), "FIGREF").alias("ref_id"), F.lit("figure").alias("type"), "num", "text", "uris")


def file_of(group: Column, file: Column) -> Column:
    """File named by the opening token of the figure itself."""
    return F.when(F.col("pos") == group, file)


def latex_tables(tokens: DataFrame) -> DataFrame:
    """Table floats and tables with an id that are not inline. Caption:
    caption, else head, else paragraphs joined, else the text outside rows."""
    kept = only(tokens, "float", "table", "caption", "head", "p", "row", "texmath")
    marked = within(kept, _f=("float", "table"), _c="caption", _h="head", _p="p", _r="row", _x="texmath").where("_f is not null")
    spot = W.partitionBy("doc_id", "_f")
    opener = lambda c: F.min(F.when(F.col("pos") == F.col("_f"), c)).over(spot)
    typed = marked.withColumns({"_tag": opener(F.col("tag")), "_name": opener(attr(F.col("tok"), "name")), "_rend": opener(attr(F.col("tok"), "rend"))})
    wanted = F.when(F.col("_tag") == "float", F.col("_name") == "table").otherwise(F.coalesce(F.col("_rend") != "inline", F.lit(True)))
    clean = F.col("_x").isNull()
    text = lambda c: F.when(c & clean, F.col("text"))
    paras = typed.where(wanted).groupBy("doc_id", "_f", "_p").agg(
        F.min("pos").alias("_at"),
        *[F.max(F.col(c).isNotNull()).alias(f"_has{c}") for c in ("_c", "_h", "_p")],
        ordered_concat(F.col("pos"), text(F.col("_c").isNotNull())).alias("_cap"),
        ordered_concat(F.col("pos"), text(F.col("_h").isNotNull())).alias("_head"),
        F.trim(ordered_concat(F.col("pos"), text(F.col("_p").isNotNull()))).alias("_para"),
        ordered_concat(F.col("pos"), text(F.col("_r").isNull())).alias("_rest"),
        _own("_f", "id").alias("_id"),
        _own("_f", "id-text").alias("num"),
    )
    joined = lambda c, sep="": ordered_concat(F.col("_at"), F.col(c), sep)
    caption = (
        F.when(F.max("_has_c"), joined("_cap")).when(F.max("_has_h"), joined("_head"))
        .when(F.max("_has_p"), ordered_concat(F.col("_at"), F.when(F.col("_has_p"), F.col("_para")), " ")).otherwise(joined("_rest"))
    )
    out = paras.groupBy("doc_id", F.col("_f").alias("pos")).agg(F.min("_id").alias("_id"), F.min("num").alias("num"), tidy(caption).alias("text"))
    return out.where("_id is not null").select("doc_id", _renamed(F.col("_id"), "TABREF").alias("ref_id"), F.lit("table").alias("type"), "num", "text")


def jats_floats(tokens: DataFrame, tag: str, kind: str) -> DataFrame:
    """Elements with an id, their label and caption text; tables
    add footnotes after a line break and keep their inner markup.

    Each child of the caption counts as a paragraph, whatever its tag.
    ``text`` is ``label: caption``; it is NULL when either is missing.
    """
    marked = within(tokens, _i=tag, _l="label", _c="caption", _n="table-wrap-foot", _p="p", _t="table").where("_i is not null")
    spot = W.partitionBy("doc_id").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    cap_depth = F.last(F.when(F.col("pos") == F.col("_c"), F.col("depth")), ignorenulls=True).over(spot)
    child = F.when(F.col("_c").isNotNull() & (F.col("depth") == F.col("_cd") + 1) & (F.col("kind") == "open"), F.col("pos"))
    marked = marked.withColumn("_cd", cap_depth)
    # Text between the children, directly in the caption, belongs to none.
    stray = (F.col("kind") == "text") & (F.col("depth") == F.col("_cd") + 1)
    marked = marked.withColumn("_k", F.when(F.col("_c").isNotNull() & ~stray, F.last(child, ignorenulls=True).over(spot)))
    marked = marked.withColumn("_k", F.when(F.col("_k") > F.col("_c"), F.col("_k")))
    unit = F.coalesce(F.when(F.col("_c").isNotNull(), F.col("_k")), F.when(F.col("_n").isNotNull(), F.col("_p")))
    paras = marked.withColumn("_u", unit).groupBy("doc_id", "_i", "_u").agg(
        F.min("pos").alias("_at"),
        _own("_i", "id").alias("_id"),
        F.max(F.col("_c").isNotNull() & F.col("_u").isNotNull()).alias("_cap"),
        F.max(F.col("_n").isNotNull() & F.col("_u").isNotNull()).alias("_note"),
        soften_ws(ordered_concat(F.col("pos"), F.when(F.col("_u").isNotNull(), F.col("text")))).alias("_text"),
        ordered_concat(F.col("pos"), F.when(F.col("_l").isNotNull() & F.col("_u").isNull(), F.col("text"))).alias("_label"),
        ordered_concat(F.col("pos"), F.when(F.col("_t").isNotNull(), F.col("tok"))).alias("_markup"),
    )
    pick = lambda flag: ordered_concat(F.col("_at"), F.when(F.col(flag), F.col("_text")), " ")
    out = paras.groupBy("doc_id", F.col("_i").alias("pos")).agg(
        F.min("_id").alias("old_key"),
        blank_to_null(ordered_concat(F.col("_at"), F.col("_label"))).alias("label"),
        F.when(F.max("_cap"), pick("_cap")).alias("caption"),
        pick("_note").alias("_notes"),
        blank_to_null(ordered_concat(F.col("_at"), F.col("_markup"))).alias("content"),
    )
    text = F.concat("label", F.lit(": "), "caption")
    if kind == "table":
        text = F.concat(text, F.lit("\n"), F.col("_notes"))
    return out.where("old_key is not null").select("doc_id", "old_key", F.lit(kind).alias("type"), "label", "caption", text.alias("text"), "content")


def table_cells(tokens: DataFrame, table: tuple[str, ...] = ("float", "table")) -> DataFrame:
    """One row per cell with its place, alignment, borders, text and source.
    The children of a cell are joined by a space; a formula gives its reading
    in ``text`` and its source in ``latex``."""
    marked = within(tokens, _f=table, _r="row", _c="cell", _fm="formula", _m="math", _x="texmath").where("_f is not null")
    # What a cell shares with its row and table is carried along the order that the tokens have already; sorting them by table, by row
    # and by child of a cell cost more than all else.
    marked = with_openers(marked, _table="_f", _row="_r").where("_r is not null")
    upto = W.partitionBy("doc_id").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    marked = marked.withColumn("_base", F.last(F.when(F.col("pos") == F.col("_c"), F.col("depth")), ignorenulls=True).over(upto))
    rows = marked.where("_c is not null and kind <> 'close'")
    # Each child of a cell sets in with a space; spaces are collapsed in the end.
    lead = F.when(F.col("depth") == F.col("_base") + 1, " ").otherwise("")
    plain = F.col("_fm").isNull()
    said = lambda inner: F.concat(lead, F.when(plain | inner.isNotNull(), F.coalesce("text", F.lit(""))).otherwise(""))
    cells = rows.groupBy("doc_id", "_f", "_r", "_c").agg(
        F.min("_table").alias("_table"), F.min("_row").alias("_row"), F.min(F.when(F.col("pos") == F.col("_c"), F.col("tok"))).alias("_cell"),
        tidy(ordered_concat(F.col("pos"), blank_to_null(said(F.col("_m"))))).alias("text"),
        tidy(ordered_concat(F.col("pos"), blank_to_null(said(F.col("_x"))))).alias("latex"),
    )
    # One order of the cells serves both numbers; a cell sets in a row if none of that row stands ahead.
    tab = W.partitionBy("doc_id", "_f").orderBy("_r", "_c")
    numbered = cells.withColumns({"_nth": F.row_number().over(tab), "_sets": F.coalesce(F.lag("_r").over(tab) != F.col("_r"), F.lit(True))})
    upto = tab.rowsBetween(W.unboundedPreceding, 0)
    numbered = numbered.withColumns(
        {
            "row_no": (F.sum(F.when(F.col("_sets"), 1).otherwise(0)).over(upto) - 1).cast("int"),
            "col_no": (F.col("_nth") - F.last(F.when(F.col("_sets"), F.col("_nth")), ignorenulls=True).over(upto)).cast("int"),
        }
    )
    flag = lambda token, name: F.coalesce(attr(F.col(token), name) == "true", F.lit(False))
    return numbered.select(
        "doc_id", attr(F.col("_table"), "id").alias("table_id"), "row_no", "col_no", attr(F.col("_cell"), "halign").alias("alignment"),
        flag("_cell", "left-border").alias("left_border"), flag("_cell", "right-border").alias("right_border"),
        flag("_row", "top-border").alias("top_border"), flag("_row", "bottom-border").alias("bottom_border"), "text", "latex",
    )


def table_rows(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Cells nested by row: ``keys, row_no, top_border, bottom_border, cells``."""
    return cells.groupBy(*keys, "row_no").agg(
        F.max("top_border").alias("top_border"), F.max("bottom_border").alias("bottom_border"),
        ordered_list(F.col("col_no"), F.struct("alignment", "right_border", "left_border", "text", "latex")).alias("cells"),
    )


def table_html(cells: DataFrame, keys: list[str]) -> DataFrame:
    """One HTML string per table. Cells of the first row and of rows with a
    bottom border are headings. Input has ``row_no, col_no, bottom_border, text``."""
    tag = F.when((F.col("row_no") == 0) | F.col("bottom_border"), "th").otherwise("td")
    cell = F.concat(F.lit("<"), tag, F.lit(">"), "text", F.lit("</"), tag, F.lit(">"))
    rows = cells.groupBy(*keys, "row_no").agg(ordered_concat(F.col("col_no"), cell).alias("_r"))
    line = F.concat(F.lit("<tr>"), "_r", F.lit("</tr>"))
    return rows.groupBy(*keys).agg(F.concat(F.lit("<table>"), ordered_concat(F.col("row_no"), line), F.lit("</table>")).alias("html"))


def latex_equations(tokens: DataFrame) -> DataFrame:
    """Display formulas with an id: number, reading and source."""
    marked = within(only(tokens, "formula", "math", "texmath"), _f="formula", _m="math", _x="texmath").where("_f is not null")
    rows = marked.groupBy("doc_id", F.col("_f").alias("pos")).agg(
        _own("_f", "type").alias("_type"), _own("_f", "id").alias("_id"), _own("_f", "id-text").alias("num"),
        F.trim(_part("_m")).alias("text"), F.trim(_part("_x")).alias("latex"),
    )
    return rows.where("_type = 'display' and _id is not null").select(
        "doc_id", _renamed(F.col("_id"), "EQREF").alias("ref_id"), F.lit("equation").alias("type"), "num", "text", "latex"
    )


def jats_formulas(tokens: DataFrame) -> DataFrame:
    """Inline formulas: source between the document marks without dollar
    signs; reading from MathML, else the text, else FORMULA; MathML as it is."""
    marked = within(tokens, _f="inline-formula", _m="mml:math", _x="tex-math").where("_f is not null")
    rows = marked.groupBy("doc_id", F.col("_f").alias("pos")).agg(
        F.max(F.col("_m").isNotNull()).alias("_has"), _part("_m").alias("_math"), _part("_x").alias("_tex"), _part("_f").alias("_all"),
        blank_to_null(ordered_concat(F.col("pos"), F.when(F.col("_m").isNotNull(), F.col("tok")))).alias("mathml"),
    )
    source = blank_to_null(F.regexp_extract("_tex", TEX_DOCUMENT, 1))
    text = F.when(F.col("_has"), F.col("_math")).when(~F.col("_all").contains("begin{document}"), F.col("_all")).otherwise("FORMULA")
    return rows.select("doc_id", "pos", text.alias("text"), F.regexp_replace(source, r"^\$+|\$+$", "").alias("latex"), "mathml")


def latex_footnotes(tokens: DataFrame) -> DataFrame:
    """Notes with an id: number and text, links written out."""
    marked = within(only(tokens, "note", "xref", "texmath"), _n="note", _l="xref", _x="texmath").where("_n is not null and kind <> 'close'")
    link = F.when(F.col("pos") == F.col("_l"), F.concat(F.lit(" "), attr(F.col("tok"), "url"), F.lit(" ")))
    piece = F.when(F.col("_x").isNull(), F.coalesce(link, F.when(F.col("_l").isNull(), F.col("text"))))
    rows = marked.groupBy("doc_id", F.col("_n").alias("pos")).agg(
        F.min(at_own("_n", "tok")).alias("_tok"), blank_to_null(tidy(ordered_concat(F.col("pos"), piece))).alias("text")
    )
    rows = rows.withColumns({"_id": attr(F.col("_tok"), "id"), "num": attr(F.col("_tok"), "id-text")})
    return rows.where("_id is not null").select("doc_id", _renamed(F.col("_id"), "FOOTREF").alias("ref_id"), F.lit("footnote").alias("type"), "num", "text")


def union_entries(*maps: DataFrame) -> DataFrame:
    """One entry per ``(doc_id, ref_id)``; kinds later in the fixed order
    override earlier ones. Missing columns are NULL."""
    allr = maps[0]
    for more in maps[1:]:
        allr = allr.unionByName(more, allowMissingColumns=True)
    rank = F.array_position(F.array(*[F.lit(k) for k in ENTRY_PRECEDENCE]), F.col("type"))
    rest = [c for c in allr.columns if c not in ("doc_id", "ref_id")]
    best = allr.groupBy("doc_id", "ref_id").agg(F.max_by(F.struct(*rest), rank).alias("_e"))
    return best.select("doc_id", "ref_id", "_e.*")


def page_dimensions(tokens: DataFrame, width: int = 600, height: int = 800) -> DataFrame:
    """A10: size of the first page surface; a default where there is none."""
    own = (F.col("tag") == "surface") & (F.col("kind") != "close")
    first = lambda name: first_by(attr(F.col("tok"), name), F.col("pos"), own)
    return tokens.groupBy("doc_id").agg(
        F.coalesce(first("lrx").try_cast("double"), F.lit(float(width))).alias("width"),
        F.coalesce(first("lry").try_cast("double"), F.lit(float(height))).alias("height"),
    )


