"""Bibliography items, authors, affiliations, funders, ids and dates."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paperloom.functions.text import attr, blank_to_null, first_by, last_by, number, ordered_concat, ordered_list, tidy
from paperloom.operators.tokens import at_own, merged_text, only, with_next, within

# Title levels that name a venue, best first; name endings that
# are not a last name; kinds of date, best first; resolver of identifiers.
VENUE_LEVELS = ["j", "m", "s"]
NAME_ENDINGS = ["jr", "jr.", "iii", "iv", "v"]
DATE_ORDER = ["epub", "accepted", "collection", "received"]
DOI_URL = r"https?://dx\.doi\.org/(.+)"
ORCID_URL = r"https?://orcid\.org/(.+)"
ORCID_LENGTH = 19
FUNDING_WORDS = ["fund", "support", "provide"]


def item_fields(tokens: DataFrame, item: str | tuple[str, ...], fields: Iterable[str], attrs: Iterable[str] = ()) -> DataFrame:
    """One row per field element inside an item, plus one for the item itself:
    ``doc_id, item_pos, pos, tag, text`` and one column ``@name`` per attribute,
    read here once. Fields do not nest."""
    items = (item,) if isinstance(item, str) else tuple(item)
    # Only openers are read again; texts stand in ``text`` already.
    opener = F.when(F.col("kind").isin("open", "void"), F.col("tok"))
    rows = only(tokens, *items, *fields).select("doc_id", "pos", "kind", "tag", "text", opener.alias("tok"))
    marked = within(rows, _i=items, _x=tuple(fields)).where("_i is not null")
    unit = F.coalesce("_x", F.when(F.col("pos") == F.col("_i"), F.col("pos")))
    # A field that begins ahead of the item has no opener in it.
    units = merged_text(marked.withColumn("_u", unit).where("_u is not null"), "_i", "_u")
    read = [attr(at_own("_u", "tok"), name).alias(f"@{name}") for name in attrs]
    return units.select("doc_id", F.col("_i").alias("item_pos"), F.col("_u").alias("pos"), at_own("_u", "tag").alias("tag"), "text", *read)


def _at(name: str) -> Column:
    return F.col(f"`@{name}`")


def _is(tag: str) -> Column:
    return F.col("tag") == tag


def _has(tag: str, name: str, value: str) -> Column:
    return _is(tag) & (_at(name) == value)


def year_of(when: Column) -> Column:
    """D3: four digits at the start, of the 1900s or 2000s."""
    return number(F.regexp_extract(when, r"^((?:19|20)\d{2})", 1))


def multimap(pairs: Column) -> Column:
    """``array<struct<k,v>>`` to a map of arrays, keys in first-seen order."""
    keys = F.array_distinct(F.transform(pairs, lambda x: x["k"]))
    values = F.transform(keys, lambda k: F.transform(F.filter(pairs, lambda x: x["k"] == k), lambda x: x["v"]))
    return F.map_from_arrays(keys, values)


def tei_bibliography(tokens: DataFrame, item: str = "biblStruct") -> DataFrame:
    """One row per bibliography item that has a title."""
    f = item_fields(tokens, item, ("title", "date", "biblScope", "idno", "note"), ("xml:id", "level", "when", "unit", "from", "to", "type"))
    f = f.withColumnRenamed("pos", "at")
    pos, txt = F.col("at"), F.col("text")
    level = _at("level")
    page = _has("biblScope", "unit", "page") & _at("from").isNotNull()
    levels = F.array(*[F.lit(v) for v in VENUE_LEVELS])
    venue_rank = F.array_position(levels, level)
    has_id = _is("idno") & (txt != "") & _at("type").isNotNull()
    items = f.groupBy("doc_id", F.col("item_pos").alias("pos")).agg(
        F.min(F.when(pos == F.col("item_pos"), _at("xml:id"))).alias("bib_id"),
        F.coalesce(first_by(txt, F.struct(~F.coalesce(level == "a", F.lit(False)), pos), _is("title")), F.lit("")).alias("title"),
        F.array_sort(F.collect_list(F.when(_is("title") & (venue_rank > 0), F.struct(venue_rank.alias("r"), pos.alias("p"), txt.alias("t"))))).alias("_venues"),
        year_of(first_by(F.coalesce(_at("when"), F.lit("")), pos, _is("date"))).alias("year"),
        F.coalesce(first_by(txt, pos, _has("biblScope", "unit", "volume")), F.lit("")).alias("volume"),
        F.coalesce(first_by(txt, pos, _has("biblScope", "unit", "issue")), F.lit("")).alias("issue"),
        F.coalesce(first_by(F.concat_ws("--", _at("from"), _at("to")), pos, page), F.lit("")).alias("pages"),
        ordered_list(pos, F.when(has_id, F.struct(_at("type").alias("k"), txt.alias("v")))).alias("_ids"),
        F.coalesce(first_by(txt, pos, _has("note", "type", "raw_reference")), F.lit("")).alias("raw_text"),
    )
    venue = F.get(F.filter("_venues", lambda v: v["t"] != F.col("title")), F.lit(0))["t"]
    named = items.where("title <> ''").withColumns({"venue": F.coalesce(venue, F.lit("")), "other_ids": multimap(F.col("_ids"))})
    return named.drop("_venues", "_ids")


def jats_bibliography(tokens: DataFrame) -> DataFrame:
    """D1, D3-D6 for reference lists: one row per ``ref``."""
    fields = ("label", "article-title", "source", "year", "volume", "issue", "fpage", "lpage", "pub-id")
    listed = within(only(tokens, "ref-list", "ref", *fields), _l="ref-list").where("_l is not null").drop("_l")
    f = item_fields(listed, "ref", fields, ("id", "pub-id-type"))
    pos, txt = F.col("pos"), F.col("text")
    one = lambda tag: F.coalesce(first_by(txt, pos, _is(tag)), F.lit(""))
    raw = lambda tag: first_by(txt, pos, _is(tag))
    year = raw("year")
    return f.groupBy("doc_id", F.col("item_pos").alias("pos")).agg(
        F.min(F.when(pos == F.col("item_pos"), _at("id"))).alias("old_key"),
        one("label").alias("label"),
        one("article-title").alias("title"),
        F.when(year.rlike(r"^\d+$"), year.try_cast("int")).alias("year"),
        one("source").alias("venue"),
        one("volume").alias("volume"),
        one("issue").alias("issue"),
        # NULL unless both ends are there.
        F.concat(raw("fpage"), F.lit("-"), raw("lpage")).alias("pages"),
        F.create_map(F.lit("DOI"), ordered_list(pos, F.when(_has("pub-id", "pub-id-type", "doi"), txt))).alias("other_ids"),
    )


def clean_reference(text: Column) -> Column:
    """D7, LaTeX: lines are collapsed and trimmed, then joined by a space."""
    return F.array_join(F.transform(F.split(text, "\n"), tidy), " ")


def bib_text_key(rows: DataFrame, text: str = "bib_text") -> DataFrame:
    """``[key] rest``, else the first line is the key."""
    flat = F.regexp_replace(text, r"\s", " ")
    pattern = r"^\[(.*?)\](.*)$"
    lines = F.split(text, "\n")
    marked = F.col(text).rlike(r"^\[.*?\]")
    blanked = lambda c: F.regexp_replace(c, r"\s", " ")
    out = rows.withColumns(
        {
            "bib_key": F.when(marked, F.regexp_extract(flat, pattern, 1)).otherwise(blanked(lines[0])),
            "raw_text": F.when(marked, clean_reference(F.regexp_extract(flat, pattern, 2))).otherwise(
                clean_reference(blanked(F.array_join(F.slice(lines, 2, F.size(lines)), " ")))
            ),
        }
    )
    return out.where("bib_key <> '' and raw_text <> ''")


def bib_texts(tokens: DataFrame, item: str = "p") -> DataFrame:
    """Text and links of each bibliography paragraph."""
    marked = within(only(tokens, "bibliography", "Bibliography", "xref", item), _l=("bibliography", "Bibliography"), _p=item).where("_l is not null and _p is not null")
    link = (F.col("tag") == "xref") & (F.col("kind") != "close")
    return marked.groupBy("doc_id", F.col("_p").alias("pos")).agg(
        ordered_concat(F.col("pos"), F.col("text")).alias("bib_text"),
        ordered_list(F.col("pos"), F.when(link, attr(F.col("tok"), "url"))).alias("urls"),
    )


def tei_authors(tokens: DataFrame, item: str = "author") -> DataFrame:
    """One row per author. The first forename of type ``first`` is the first
    name; further ones, middle ones and all surnames but the last are middle
    names; suffixes are joined."""
    f = item_fields(tokens, item, ("forename", "surname", "suffix", "email"), ("type",))
    pos, txt = F.col("pos"), F.col("text")
    kind = _at("type")
    firsts = ordered_list(pos, F.when(_is("forename") & (kind == "first") & (txt != ""), txt))
    middles = ordered_list(pos, F.when(_is("forename") & kind.isin("first", "middle"), F.struct(kind.alias("t"), txt.alias("x"))))
    surnames = ordered_list(pos, F.when(_is("surname"), txt))
    rows = f.groupBy("doc_id", "item_pos").agg(
        firsts.alias("_firsts"), middles.alias("_mids"), surnames.alias("_sur"),
        ordered_concat(pos, F.when(_is("suffix"), txt), " ").alias("suffix"),
        F.coalesce(first_by(txt, pos, _is("email")), F.lit("")).alias("email"),
    )
    is_first = lambda x: (x["t"] == "first") & (x["x"] != "")
    at = F.array_position(F.transform("_mids", is_first), True)
    rest = F.filter("_mids", lambda x, i: ((i + 1) != at) & ~((x["t"] == "first") & (x["x"] == "")))
    early = F.slice("_sur", 1, F.greatest(F.size("_sur") - 1, F.lit(0)))
    return rows.select(
        "doc_id",
        F.col("item_pos").alias("pos"),
        F.coalesce(F.get("_firsts", F.lit(0)), F.lit("")).alias("first"),
        F.concat(F.transform(rest, lambda x: x["x"]), early).alias("middle"),
        F.coalesce(F.get("_sur", F.size("_sur") - 1), F.lit("")).alias("last"),
        "suffix",
        "email",
    )


def split_author(text: Column) -> Column:
    """``struct<first,middle,last>`` of a name written in one string; an
    ending such as ``jr`` shifts the last name to the word before it."""
    words = F.filter(F.split(F.trim(text), r"\s+"), lambda w: w != "")
    n = F.size(words)
    ending = F.lower(F.element_at(words, -1)).isin(NAME_ENDINGS) & (n > 1)
    return F.when(
        n > 0,
        F.struct(
            F.when(n > 1, words[0]).otherwise("").alias("first"),
            F.slice(words, 2, F.greatest(n - 2, F.lit(0))).alias("middle"),
            F.when(ending, F.get(words, n - 2)).otherwise(F.element_at(words, -1)).alias("last"),
        ),
    )


def title_block_authors(tokens: DataFrame, item: str = "author") -> DataFrame:
    """D10, title block: the pieces of each author element, tidied, empty ones
    dropped, joined by a comma; the whole is kept as ``last``. Formulas go."""
    marked = within(tokens, _a=item, _f="formula").where("_a is not null and _f is null")
    base = F.min(F.when(F.col("pos") == F.col("_a"), F.col("depth")))
    spot = W.partitionBy("doc_id", "_a")
    marked = marked.withColumn("_base", base.over(spot))
    child = (F.col("depth") == F.col("_base") + 1) & (F.col("kind") != "close")
    marked = marked.withColumn("_n", F.sum(F.when(child, 1).otherwise(0)).over(spot.orderBy("pos").rowsBetween(W.unboundedPreceding, 0)))
    parts = marked.groupBy("doc_id", "_a", "_n").agg(tidy(ordered_concat(F.col("pos"), F.col("text"))).alias("_t"))
    return parts.groupBy("doc_id", F.col("_a").alias("pos")).agg(ordered_concat(F.col("_n"), blank_to_null(F.col("_t")), ", ").alias("last"))


def dedup_authors(authors: DataFrame) -> DataFrame:
    """Trim names, drop authors without any, merge equal ones: position of
    the first, last non-empty email, last affiliation that says something.

    All aggregates combine before the shuffle, so a paper with very many
    mentions of few authors moves few rows. ``affiliation`` is
    ``struct<laboratory,institution,location>`` or NULL.
    """
    a = F.col("affiliation")
    says = (F.coalesce(a["institution"], F.lit("")) != "") | (F.coalesce(a["laboratory"], F.lit("")) != "") | (F.coalesce(F.size(a["location"]), F.lit(0)) > 0)
    clean = authors.withColumns(
        {
            "first": F.trim("first"), "last": F.trim("last"), "suffix": F.trim("suffix"),
            "middle": F.transform("middle", lambda m: F.trim(m)),
        }
    ).where((F.col("first") != "") | (F.col("last") != "") | (F.size("middle") > 0))
    key = ["doc_id", "first", "last", F.array_join("middle", " ").alias("middle"), "suffix"]
    # The first mention counts as it is; later ones only where they say more.
    return clean.groupBy(*key).agg(
        F.min("pos").alias("pos"),
        F.coalesce(last_by(F.col("email"), F.col("pos"), F.coalesce(F.col("email"), F.lit("")) != ""), F.lit("")).alias("email"),
        F.coalesce(last_by(a, F.col("pos"), says), first_by(a, F.col("pos"))).alias("affiliation"),
    )


def tei_affiliations(tokens: DataFrame, item: str = "affiliation", owner: str = "author") -> DataFrame:
    """Laboratory, institution and address parts of each affiliation; one
    without either name is dropped. ``owner_pos`` is the author around it."""
    marked = within(tokens, _i=item, _o="orgName", _adr="address", _own=owner).where("_i is not null")
    upto = W.partitionBy("doc_id").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    inner = F.when(F.col("_adr").isNotNull() & (F.col("kind") == "open") & (F.col("tag") != "address"), F.col("pos"))
    level = F.last(F.when(inner.isNotNull(), F.col("depth")), ignorenulls=True).over(upto)
    marked = marked.withColumns({"_g": F.last(inner, ignorenulls=True).over(upto), "_gd": level})
    # Text between the parts of an address belongs to none of them.
    part_of = F.col("_adr").isNotNull() & (F.col("_g") > F.col("_adr")) & ((F.col("kind") != "text") | (F.col("depth") > F.col("_gd")))
    marked = marked.withColumn("_g", F.when(part_of, F.col("_g")))
    f = marked.withColumn("_u", F.coalesce("_o", "_g")).where("_u is not null and kind <> 'close'").groupBy("doc_id", "_i", "_u").agg(
        F.min(F.when(F.col("pos") == F.col("_u"), F.col("tag"))).alias("tag"),
        F.min(F.when(F.col("pos") == F.col("_u"), attr(F.col("tok"), "type"))).alias("type"),
        ordered_concat(F.col("pos"), F.col("text")).alias("text"),
        F.min("_own").alias("owner_pos"),
    )
    org = lambda t: F.coalesce(last_by(F.col("text"), F.col("_u"), (F.col("tag") == "orgName") & (F.col("type") == t)), F.lit(""))
    part = F.when((F.col("tag") != "orgName") & (F.col("text") != ""), F.struct(F.col("tag").alias("k"), F.col("text").alias("v")))
    pairs = ordered_list(F.col("_u"), part)
    rows = f.groupBy("doc_id", F.col("_i").alias("pos")).agg(
        org("laboratory").alias("laboratory"), org("institution").alias("institution"), pairs.alias("_parts"), F.min("owner_pos").alias("owner_pos")
    )
    # A later part of the same name wins.
    keep = F.filter("_parts", lambda x, i: ~F.exists(F.slice("_parts", i + 2, F.size("_parts")), lambda y: y["k"] == x["k"]))
    return rows.where("laboratory <> '' or institution <> ''").select("doc_id", "pos", "owner_pos", "laboratory", "institution", F.map_from_entries(keep).alias("location"))


def jats_affiliations(tokens: DataFrame) -> DataFrame:
    """Text of each ``aff`` without its marker (the first label and the
    first superscript), institution ids set aside."""
    kept = only(tokens, "aff", "label", "sup", "institution-id")
    marked = within(kept, _i="aff", _lab="label", _sup="sup", _id="institution-id").where("_i is not null and kind <> 'close'")
    spot = W.partitionBy("doc_id", "_i")
    firsts = marked.withColumns({"_l1": F.min("_lab").over(spot), "_s1": F.min("_sup").over(spot)})
    gone = F.coalesce((F.col("_lab") == F.col("_l1")) | (F.col("_sup") == F.col("_s1")), F.lit(False)) | F.col("_id").isNotNull()
    ids = F.when(F.col("_id").isNotNull(), F.struct(F.col("_id").alias("p"), attr(F.col("tok"), "institution-id-type").alias("k"), F.col("text").alias("v")))
    rows = firsts.groupBy("doc_id", F.col("_i").alias("pos")).agg(
        F.min(F.when(F.col("pos") == F.col("_i"), attr(F.col("tok"), "id"))).alias("aff_id"),
        ordered_concat(F.col("pos"), F.when(~gone, F.col("text"))).alias("text"),
        ordered_list(F.col("pos"), ids).alias("_ids"),
    )
    # The opener carries the kind, the text token the value.
    kinds = F.filter("_ids", lambda x: x["k"].isNotNull())
    pairs = F.transform(
        kinds, lambda k: F.struct(k["k"].alias("k"), F.array_join(F.transform(F.filter("_ids", lambda x: (x["p"] == k["p"]) & x["v"].isNotNull()), lambda x: x["v"]), "").alias("v"))
    )
    last = F.filter(pairs, lambda x, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda y: y["k"] == x["k"]))
    return rows.select("doc_id", "pos", "aff_id", "text", F.map_from_entries(last).alias("other_ids"))


def join_affiliations(authors: DataFrame, affiliations: DataFrame) -> DataFrame:
    """The first affiliation id of an author picks the first affiliation
    of that id; its text becomes the institution."""
    one = affiliations.where("aff_id is not null").groupBy("doc_id", "aff_id").agg(F.min_by("text", "pos").alias("institution"))
    keyed = authors.withColumn("aff_id", F.get("affiliation_ids", F.lit(0)))
    return keyed.join(one, ["doc_id", "aff_id"], "left").drop("aff_id")


def _leaves(tokens: DataFrame) -> DataFrame:
    """Tokens of the marked elements (``_m``) that hold no other one, with the
    position of their opener as ``_c``. Such an opener is the last mark up to a
    row, and the mark after that row closes it."""
    upto = W.partitionBy("doc_id").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    last = F.last(F.when(F.col("_m"), F.when(F.col("kind") == "open", F.col("pos")).otherwise(-1)), ignorenulls=True).over(upto)
    return with_next(tokens.withColumn("_c", last), "_after", F.when(F.col("_m"), F.col("kind"))).where("_c >= 0 and _after = 'close'")


def jats_contributors(tokens: DataFrame) -> DataFrame:
    """Leaf contributors with a name. A paper in which any of them lacks
    given names has no authors at all."""
    # A contributor that holds another one is a group, not a person: the next
    # contributor tag after its opener is an opener too.
    fields = ("surname", "given-names", "suffix", "contrib-id", "email", "xref")
    marks = F.col("tag") == "contrib"
    spot = only(tokens, "contrib", "name", *fields).withColumn("_m", F.coalesce(marks, F.lit(False)))
    inside = within(_leaves(spot), _x=fields, _name="name")
    unit = F.coalesce("_x", F.when(F.col("pos") == F.col("_c"), F.col("pos")), F.when((F.col("tag") == "name") & (F.col("kind") == "open"), F.col("pos")))
    units = merged_text(inside.withColumn("_u", unit).where("_u is not null and kind <> 'close'"), "_c", "_u", least=["_name"])
    read = [attr(at_own("_u", "tok"), name).alias(f"@{name}") for name in ("corresp", "ref-type", "rid")]
    f = units.select("doc_id", "_c", F.col("_u").alias("pos"), at_own("_u", "tag").alias("tag"), "_name", "text", *read)
    pos, txt = F.col("pos"), F.col("text")
    in_name = F.col("_name").isNotNull()
    rows = f.groupBy("doc_id", F.col("_c").alias("pos")).agg(
        F.max(_is("name")).alias("_named"),
        first_by(txt, pos, _is("given-names") & in_name).alias("_given"),
        F.coalesce(first_by(txt, pos, _is("surname") & in_name), F.lit("")).alias("last"),
        F.coalesce(first_by(txt, pos, _is("suffix") & in_name), F.lit("")).alias("suffix"),
        first_by(txt, pos, _is("contrib-id")).alias("_orcid"),
        first_by(txt, pos, _is("email")).alias("email"),
        F.coalesce(F.max(_has("contrib", "corresp", "yes") | _has("xref", "ref-type", "corresp")), F.lit(False)).alias("corresponding"),
        ordered_list(pos, F.when(_has("xref", "ref-type", "aff"), _at("rid"))).alias("affiliation_ids"),
    ).where("_named")
    void = F.max(F.col("_given").isNull()).over(W.partitionBy("doc_id"))
    orcid = F.coalesce(blank_to_null(F.regexp_extract("_orcid", ORCID_URL, 1)), F.col("_orcid"))
    given = F.split("_given", " ")
    return rows.withColumn("_void", void).where("not _void").select(
        "doc_id", "pos", given[0].alias("first"), F.slice(given, 2, F.size(given)).alias("middle"), "last", "suffix", "email",
        F.when(F.length(orcid) == ORCID_LENGTH, orcid).alias("orcid"), "corresponding", "affiliation_ids",
    )


def jats_funders(tokens: DataFrame) -> DataFrame:
    """Innermost funding sources and statements: name, DOI, notes."""
    tags = ["funding-source", "funding-statement"]
    hit = F.coalesce(F.col("tag").isin(tags), F.lit(False))
    upto = W.partitionBy("doc_id").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    inside = within(_leaves(tokens.withColumn("_m", hit)), _id="institution-id", _inst="institution", _nc="named-content")
    content = attr(F.col("tok"), "content-type")
    kinds = F.last(F.when((F.col("tag") == "named-content") & (F.col("kind") == "open"), content), ignorenulls=True).over(upto)
    inside = inside.withColumn("_nk", F.when(F.col("_nc").isNotNull(), kinds))
    taken = F.col("_id").isNotNull() | F.col("_inst").isNotNull() | F.coalesce(F.col("_nk").isin("funder-name", "funder-identifier"), F.lit(False))
    pick = lambda c: ordered_concat(F.col("pos"), F.when(c, F.col("text")))
    rows = inside.groupBy("doc_id", F.col("_c").alias("pos")).agg(
        F.min(F.when(F.col("pos") == F.col("_c"), F.col("tag"))).alias("_tag"),
        F.min(F.when(F.col("pos") == F.col("_c"), attr(F.col("tok"), "xlink:href"))).alias("_href"),
        blank_to_null(pick(F.col("_id").isNotNull())).alias("_iid"),
        blank_to_null(pick(F.col("_inst").isNotNull() & F.col("_id").isNull())).alias("_iname"),
        blank_to_null(pick(F.col("_nk") == "funder-name")).alias("_fname"),
        blank_to_null(pick(F.col("_nk") == "funder-identifier")).alias("_fid"),
        pick(~taken).alias("_rest"),
    )
    doi = F.coalesce("_href", "_fid", "_iid")
    doi = F.coalesce(blank_to_null(F.regexp_extract(doi, DOI_URL, 1)), doi)
    told = (F.col("_tag") == "funding-statement") | F.col("_rest").rlike("|".join(FUNDING_WORDS))
    named = F.coalesce("_fname", "_iname")
    name = F.when(told, named).otherwise(F.coalesce(named, F.col("_rest")))
    out = rows.select("doc_id", "pos", name.alias("_name"), doi.alias("_doi"), F.when(told, F.col("_rest")).alias("notes"))
    linked = F.regexp_extract("_name", r"\s*" + DOI_URL + "$", 1)
    pull = F.col("_doi").isNull() & (linked != "")
    return out.select(
        "doc_id", "pos", F.when(pull, F.regexp_replace("_name", r"\s*" + DOI_URL + "$", "")).otherwise(F.col("_name")).alias("name"),
        F.when(pull, linked).otherwise(F.col("_doi")).alias("doi"), "notes",
    )


def most_frequent(values: DataFrame, value: str = "value", name: str = "journal_id") -> DataFrame:
    """The value seen most often in each document, ties to the one seen
    first. Counted per value ahead of the pick, so hot documents stay small."""
    counts = values.groupBy("doc_id", value).agg(F.count("*").alias("_n"), F.min("pos").alias("_first"))
    return counts.groupBy("doc_id").agg(F.max_by(value, F.struct("_n", -F.col("_first"))).alias(name))


def article_ids(tokens: DataFrame) -> DataFrame:
    """Identifiers, journal name and category of a paper; ``reason`` says
    when a single-valued one is there more than once."""
    f = item_fields(tokens, "front", ("article-id", "journal-title", "subject"), ("pub-id-type",))
    pos, txt = F.col("pos"), F.col("text")
    ident = lambda k: first_by(txt, pos, _has("article-id", "pub-id-type", k))
    return f.groupBy("doc_id").agg(
        ident("doi").alias("doi"),
        ident("pmid").alias("pubmed_id"),
        F.concat(F.lit("PMC"), ident("pmc")).alias("pmc_id"),
        first_by(txt, pos, _is("journal-title")).alias("journal_name"),
        first_by(txt, pos, _is("subject")).alias("category"),
        F.when(F.count_if(_is("journal-title")) > 1, "multiple_journal_names").when(F.count_if(_is("subject")) > 1, "multiple_categories").alias("reason"),
    )


def date_text(year: Column, month: Column, day: Column) -> Column:
    """The parts that are there, joined by dashes."""
    return F.concat_ws("-", year, month, day)


def best_dates(dates: DataFrame) -> DataFrame:
    """One column per kind of date (the last mention wins) and the best of
    them. Input ``doc_id, pos, kind, date``."""
    pick = [last_by(F.col("date"), F.col("pos"), F.col("kind") == k).alias(k) for k in DATE_ORDER]
    return dates.groupBy("doc_id").agg(*pick).withColumn("best", F.coalesce(*[blank_to_null(F.col(k)) for k in DATE_ORDER]))


def jats_dates(tokens: DataFrame) -> DataFrame:
    """Dates of the front part as ``doc_id, pos, kind, date``."""
    marked = within(tokens, _d=("pub-date", "date"), _y="year", _m="month", _dd="day").where("_d is not null")
    part = lambda c: blank_to_null(ordered_concat(F.col("pos"), F.when(F.col(c).isNotNull(), F.col("text"))))
    kind = F.coalesce(attr(F.col("tok"), "pub-type"), attr(F.col("tok"), "date-type"))
    return marked.groupBy("doc_id", F.col("_d").alias("pos")).agg(
        F.min(F.when(F.col("pos") == F.col("_d"), kind)).alias("kind"), date_text(part("_y"), part("_m"), part("_dd")).alias("date")
    )


def identifier_year(file_id: Column) -> Column:
    """Century of a two-digit year at the start of a file id."""
    lead = F.substring(F.substring_index(file_id, ".", 1), 1, 2)
    n = F.when(lead.rlike(r"^\d+$"), lead.try_cast("int"))
    return F.coalesce(F.when(n < 40, n + 2000).otherwise(n + 1900).cast("string"), F.lit(""))


def published_date(tokens: DataFrame) -> DataFrame:
    """Date of type ``published`` in the publication statement."""
    marked = within(tokens, _s="publicationStmt").where("_s is not null")
    own = (F.col("tag") == "date") & (F.col("kind") != "close") & (attr(F.col("tok"), "type") == "published")
    return marked.groupBy("doc_id").agg(F.coalesce(first_by(attr(F.col("tok"), "when"), F.col("pos"), own & attr(F.col("tok"), "when").isNotNull()), F.lit("")).alias("year"))
