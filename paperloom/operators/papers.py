"""Nested papers: assembly, layouts, flattening and rendering."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions.text import ordered_items, ordered_list
from paperloom.schemas import PAPER_JSON_DDL, PARAGRAPH, paper_json

# Keys put out per type of reference entry, in output order.
ENTRY_KEYS = {
    "figure": ["text", "type_str", "uris", "num", "fig_num"],
    "table": ["text", "type_str", "content", "num", "html"],
    "footnote": ["text", "type_str", "num"],
    "section": ["text", "type_str", "num", "parent"],
    "equation": ["text", "type_str", "latex", "mathml", "num"],
}
OTHER_KEYS = ["text", "type", "latex", "mathml", "content", "html", "uris", "num", "parent", "fig_num"]
PARTS = ["abstract", "body_text", "back_matter"]
METADATA = ["title", "authors", "year", "venue", "identifiers"]
SEP = "::"
KEEP_NULLS = {"ignoreNullFields": "false"}


def assemble(
    meta: DataFrame,
    paragraphs: DataFrame,
    spans: DataFrame | None = None,
    bibs: DataFrame | None = None,
    entries: DataFrame | None = None,
    authors: DataFrame | None = None,
) -> DataFrame:
    """One nested row per paper from the long tables.

    ``meta``: ``doc_id`` and scalars; ``paragraphs``: ``doc_id, part, para_no,
    section, sec_num, para_text`` (and ``sentences``); ``spans``: ``doc_id,
    part, para_no, kind, start, end, text, ref_id`` (equation spans keep
    ``latex, math, raw_str, eq_num``, where given); ``bibs``: ``doc_id, key,
    …``; ``entries``: ``doc_id, ref_id, …``; ``authors``: ``doc_id, pos, …``.
    Entries with a ``pos`` keep that order, others the order of their keys; of
    repeated keys the last stays, and rows without a key are left out
    (``keyed_entries`` gives the rows that went).
    A paper is one row by definition, so it must fit a task; the long tables
    are the form for anything larger.
    """
    paras = paragraphs
    if spans is not None:
        fields, payload = ["start", "end", "text", "ref_id"], [c for c in ("latex", "math", "raw_str", "eq_num") if c in spans.columns]
        keyed = spans.groupBy("doc_id", "part", "para_no").agg(
            *[
                ordered_list(F.col("start"), F.when(F.col("kind") == k, F.struct(*fields, *(payload if k == "eq" else [])))).alias(f"{k}_spans")
                for k in ("cite", "ref", "eq")
            ]
        )
        paras = paras.join(keyed, ["doc_id", "part", "para_no"], "left")
        empty = {f.name: F.array().cast(f.dataType) for f in keyed.schema if f.name.endswith("_spans")}
        paras = paras.withColumns({name: F.coalesce(F.col(name), none) for name, none in empty.items()})
    body = F.struct(*[c for c in paras.columns if c not in ("doc_id", "part", "para_no")])
    nested = paras.groupBy("doc_id").agg(*[ordered_items(F.col("para_no"), F.when(F.col("part") == p, body)).alias(p) for p in PARTS])
    out = meta.join(nested, "doc_id", "left")
    if authors is not None:
        rows = F.struct(*[c for c in authors.columns if c not in ("doc_id", "pos")])
        out = out.join(authors.groupBy("doc_id").agg(ordered_items(F.col("pos"), rows).alias("authors")), "doc_id", "left")
    for table, key, name in ((bibs, "key", "bib_entries"), (entries, "ref_id", "ref_entries")):
        if table is not None:
            kept = keyed_entries(table, key)[0]
            value = F.struct(*[c for c in kept.columns if c not in ("doc_id", "pos", key)])
            pairs = ordered_items(F.col("pos" if "pos" in kept.columns else key), F.struct(F.col(key).alias("k"), value.alias("v")))
            out = out.join(kept.groupBy("doc_id").agg(F.map_from_entries(pairs).alias(name)), "doc_id", "left")
    return out


def keyed_entries(table: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows of ``table`` fit for a map, and ``doc_id, key, reason`` of the
    others. Of rows with one key in a document the last (by ``pos``, else by
    content) stays; one that a later one replaces is a ``repeated_key``, one
    without a key a ``missing_key``. A grouped maximum, so a key that comes very
    often is combined ahead of the shuffle."""
    rest = [c for c in table.columns if c not in ("doc_id", key)]
    have = table.where(F.col(key).isNotNull())
    turn = F.struct(F.col("pos") if "pos" in rest else F.lit(0), F.to_json(F.struct(*rest)))
    best = have.groupBy("doc_id", key).agg(F.max_by(F.struct(*rest), turn).alias("_e"), F.count("*").alias("_n"))
    missing = table.where(F.col(key).isNull()).select("doc_id", F.lit(None).cast("string").alias("key"), F.lit("missing_key").alias("reason"))
    repeated = best.where("_n > 1").select("doc_id", F.col(key).alias("key"), F.explode(F.array_repeat(F.lit("repeated_key"), (F.col("_n") - 1).cast("int"))).alias("reason"))
    return best.select("doc_id", key, "_e.*"), repeated.unionByName(missing)


def entry_json(entry: Column) -> Column:
    """A reference entry with the keys of its type only; other types keep
    all. ``entry`` has the superset of fields, ``type`` among them."""

    def field(k):
        return (entry["type"] if k == "type_str" else entry[k]).alias(k)

    out = F.to_json(F.struct(*[field(k) for k in OTHER_KEYS]), KEEP_NULLS)
    for kind, keys in ENTRY_KEYS.items():
        out = F.when(entry["type"] == kind, F.to_json(F.struct(*[field(k) for k in keys]), KEEP_NULLS)).otherwise(out)
    return out


def tidy_bib(entry: Column) -> Column:
    """Old names to new ones in one bibliography entry: an ``issn`` stands
    in for a missing issue, a ``link`` for missing links; both then go."""
    links = F.coalesce(entry["links"], F.when(entry["link"].isNotNull(), F.array(entry["link"])))
    return entry.dropFields("issn", "link").withField("issue", F.coalesce(entry["issue"], entry["issn"])).withField("links", links)


def _json_value(raw: Column, kind: str) -> Column:
    """A field of two forms as it was: JSON of the given kind, or a string."""
    v = F.try_parse_json(raw)
    structured = F.coalesce(F.schema_of_variant(v).startswith(kind), F.lit(False))
    return F.when(structured, v).otherwise(raw.cast("variant"))


def title_text(title: Column) -> Column:
    """Text of a title that is a string or ``{text, coords}``."""
    return F.coalesce(F.get_json_object(title, "$.text"), title)


def title_coords(title: Column) -> Column:
    return F.coalesce(F.get_json_object(title, "$.coords"), F.lit("1"))


def with_sentences(papers: DataFrame) -> DataFrame:
    """Add to every paragraph its ``sentences``, read from its text."""
    return papers.withColumns({k: F.transform(k, lambda p: p.withField("sentences", text_elements(p["text"]))) for k in PARTS})


def release(papers: DataFrame, name: str, version: str, generated: str, kind: str = "pdf") -> DataFrame:
    """``doc_id`` and the release JSON. Name, version and time are given, so
    that equal input gives equal output."""
    c = F.col
    header = F.struct(F.lit(f"{name} {version}").alias("generated_with"), F.lit(generated).alias("date_generated"))
    meta = [_json_value(c("metadata.title"), "OBJECT").alias("title"), *[c(f"metadata.{k}").alias(k) for k in METADATA[1:]]]
    parts = [F.transform(k, lambda p: p.dropFields("sentences").withField("text", _json_value(p["text"], "ARRAY"))).alias(k) for k in PARTS]
    payload = F.struct(c("doc_id").alias("paper_id"), c("pdf_hash").alias("_pdf_hash"), *parts, c("bib_entries"), c("ref_entries"))
    whole = F.struct(c("doc_id").alias("paper_id"), header.alias("header"), *meta, raw_text(c("abstract")).alias("abstract"), payload.alias(f"{kind}_parse"))
    return papers.select("doc_id", F.to_json(whole, KEEP_NULLS).alias("json"))


def parse_json(rows: DataFrame, column: str = "json") -> DataFrame:
    """A3: JSON text read with the schema of all layouts; a text that cannot be
    read keeps it in ``_corrupt_record``."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    return rows.withColumn("_r", F.from_json(column, PAPER_JSON_DDL, options)).select(*rows.columns, "_r.*")


def unify_layouts(raw: DataFrame) -> DataFrame:
    """E5: one shape for all layouts, as read by ``parse_json`` or the JSON
    source. ``layout`` says which it was; ``reason`` is set for rows to
    quarantine. Metadata is looked for inside the payload and beside it."""
    c = F.col
    full = lambda p: p.isNotNull() & F.coalesce(p["body_text"], p["abstract"], p["back_matter"]).isNotNull()
    beside = F.when(F.coalesce(c("title"), c("year"), c("venue")).isNotNull(), F.struct(*METADATA))
    layout = (
        F.when(c("_corrupt_record").isNotNull(), F.lit(None))
        .when(full(c("grobid_parse")), "2019")
        .when(full(c("pdf_parse")) & F.coalesce(c("pdf_parse.metadata"), c("metadata"), beside).isNull(), "2020")
        .when(full(c("pdf_parse")), "current")
        .when(F.size("body_text") > 0, "flat")
    )
    payload = lambda k, own: F.when(c("layout") == "2019", c(f"grobid_parse.{k}")).otherwise(F.coalesce(c(f"pdf_parse.{k}"), own))
    own_abstract = F.when(c("abstract").startswith("["), F.from_json("abstract", f"array<{PARAGRAPH}>"))
    own = {"abstract": own_abstract} | {k: c(k) for k in (*PARTS[1:], "bib_entries", "ref_entries")}
    meta = F.coalesce(F.when(c("layout") == "2019", c("metadata")), c("pdf_parse.metadata"), c("metadata"), beside)
    bibs = F.transform_values(payload("bib_entries", own["bib_entries"]), lambda k, v: tidy_bib(v))
    entries = F.transform_values(
        payload("ref_entries", own["ref_entries"]), lambda k, v: v.dropFields("type_str").withField("type", F.coalesce(v["type"], v["type_str"]))
    )
    read = {f.name for f in paper_json().fields} - {"paper_id"}
    return raw.withColumn("layout", layout).select(
        *[x for x in raw.columns if x not in read],
        "layout",
        F.coalesce("_pdf_hash", "s2_pdf_hash", "pdf_parse._pdf_hash").alias("pdf_hash"),
        meta.alias("metadata"),
        *[F.coalesce(payload(p, own[p]), F.array()).alias(p) for p in PARTS],
        F.coalesce(bibs, F.create_map()).alias("bib_entries"),
        F.coalesce(entries, F.create_map()).alias("ref_entries"),
        F.when(c("_corrupt_record").isNotNull(), "malformed_json").when(c("layout").isNull(), "unknown_layout").alias("reason"),
    )


SENTENCES_TYPE = "array<struct<sentence:string,coords:string>>"


def text_elements(raw: Column) -> Column:
    """JSON text of a paragraph as a list of ``{sentence, coords}``. Objects
    give their fields, strings a sentence without coordinates, anything else is
    skipped; a text that is no list is one sentence."""
    v = F.try_parse_json(raw)
    kind = lambda x: F.schema_of_variant(x)
    items = F.try_variant_get(v, "$", "array<variant>")
    made = F.transform(
        items,
        lambda x: F.when(
            kind(x).startswith("OBJECT"),
            F.struct(
                F.coalesce(F.try_variant_get(x, "$.sentence", "string"), F.lit("")).alias("sentence"),
                F.coalesce(F.try_variant_get(x, "$.coords", "string"), F.lit("")).alias("coords"),
            ),
        ).when(kind(x) == "STRING", F.struct(F.try_variant_get(x, "$", "string").alias("sentence"), F.lit("").alias("coords"))),
    )
    plain = F.when(v.isNull(), raw).when(kind(v) == "STRING", F.try_variant_get(v, "$", "string"))
    single = F.when(plain.isNotNull(), F.array(F.struct(plain.alias("sentence"), F.lit("").alias("coords"))))
    return F.when(F.coalesce(kind(v).startswith("ARRAY"), F.lit(False)), F.filter(made, lambda x: x.isNotNull())).otherwise(single)


def flatten_sentences(papers: DataFrame, parts: Iterable[str] = PARTS) -> DataFrame:
    """Title row, then every sentence of abstract, body and back matter:
    ``file, part, para_no, sent_no, section, sentence, coordinates``.

    Expects ``doc_id, title, coords`` and one array per part whose items have
    ``section`` and ``sentences``. Only explodes: nothing is shuffled.
    """
    first = papers.select(
        F.col("doc_id").alias("file"), F.lit(0).alias("part"), F.lit(0).alias("para_no"), F.lit(0).alias("sent_no"),
        F.lit("title").alias("section"), F.col("title").alias("sentence"), F.col("coords").alias("coordinates"),
    )
    def numbered(name: str, part: int) -> Column:
        item = lambda x, j: F.struct(F.lit(part).alias("part"), j.alias("para_no"), x["section"].alias("section"), x["sentences"].alias("sentences"))
        return F.transform(F.coalesce(F.col(name), F.array()), item)

    units = F.flatten(F.array(*[numbered(name, part) for part, name in enumerate(parts, 1)]))
    paras = papers.select(F.col("doc_id").alias("file"), F.explode(units).alias("u"))
    rows = paras.select("file", "u.part", "u.para_no", "u.section", F.posexplode("u.sentences").alias("sent_no", "s")).select(
        "file", "part", "para_no", "sent_no", "section", F.col("s.sentence").alias("sentence"), F.col("s.coords").alias("coordinates")
    )
    return first.unionByName(rows)


def reading_order(titles: DataFrame, paragraphs: DataFrame) -> DataFrame:
    """Lines of a plain rendering as ``doc_id, line_no, line``: the title,
    then each non-empty paragraph, ahead of it the name of its section when it
    is seen for the first time. ``paragraphs``: ``doc_id, ord, section, text``.

    First sightings come from a grouped minimum, which combines before the
    shuffle, so a document of any length is never gathered in one task. Line
    numbers leave room for headings and so have gaps.
    """
    shown = paragraphs.where("text <> ''")
    heads = shown.groupBy("doc_id", "section").agg(F.min("ord").alias("ord"))
    line = lambda df, no, text: df.select("doc_id", no.cast("long").alias("line_no"), text.alias("line"))
    return (
        line(titles, F.lit(0), F.col("title"))
        .unionByName(line(heads, F.col("ord") * 2 + 1, F.col("section")))
        .unionByName(line(shown, F.col("ord") * 2 + 2, F.col("text")))
    )


def raw_text(paras: Column) -> Column:
    """Sentences joined by a space, one paragraph per line."""
    return F.concat(F.array_join(F.transform(paras, lambda p: F.array_join(F.transform(p["sentences"], lambda s: s["sentence"]), " ")), "\n"), F.lit("\n"))


def lookup(rows: DataFrame, json: str, key: str, name: str = "value") -> DataFrame:
    """Values of ``key`` in a JSON object, or in each object of a list;
    nested objects are not searched."""
    v = F.try_parse_json(F.col(json))
    items = F.when(F.schema_of_variant(v).startswith("ARRAY"), F.try_variant_get(v, "$", "array<variant>")).when(
        F.schema_of_variant(v).startswith("OBJECT"), F.array(v)
    )
    found = rows.withColumn("_i", F.explode(items)).withColumn(name, F.try_variant_get("_i", f"$.{key}", "string"))
    return found.where(F.col(name).isNotNull()).drop("_i")


def section_list(section: Column, sec_num: Column) -> Column:
    """``A::B`` to ``[(NULL, A), (num, B)]``."""
    names = F.split(section, SEP)
    last = F.size(names) - 1
    return F.when(
        section != "", F.transform(names, lambda n, i: F.struct(F.when(i == last, sec_num).alias("num"), n.alias("name")))
    ).otherwise(F.expr("cast(array() as array<struct<num:string,name:string>>)"))


def section_string(path: Column) -> Column:
    """Back to the joined names."""
    return F.coalesce(F.array_join(F.transform(path, lambda s: s["name"]), SEP), F.lit(""))


def differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows in one but not the other, with multiplicity. Empty when equal."""
    cols = left.columns
    return left.exceptAll(right.select(cols)).unionByName(right.select(cols).exceptAll(left))
