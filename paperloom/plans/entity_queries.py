"""Queries over bibliographies, authors, funders, ids and dates."""

from pyspark.sql import functions as F

from paperloom.operators import entities as E
from paperloom.operators import trees
from paperloom.plans.adapters import CITES, cites, papers_from, table, text, tokens_of
from paperloom.plans.registry import query


def _when(condition: str, *parts):
    return F.when(F.expr(condition), text(*parts)).otherwise("")


def _bibliography(spark, sf_dir):
    line = text(
        '<biblStruct xml:id="b', F.col("n") - 1, '">',
        _when("p % 4 <> 0", '<analytic><title level="a">Part {p}</title></analytic>'),
        "<monogr>",
        _when("p % 11 <> 0 and p % 3 = 0", '<title level="s">Series {q}</title>'),
        _when("p % 11 <> 0 and p % 5 = 0", '<title level="m">Part {p}</title>'),
        _when("p % 11 <> 0 and p % 5 <> 0", '<title level="m">Book {q}</title>'),
        _when("p % 11 <> 0 and p % 2 = 0", '<title level="j">Journal {q}</title>'),
        '<imprint><biblScope unit="volume">{q}</biblScope>',
        _when("p % 3 = 1", '<biblScope unit="issue">{n}</biblScope>'),
        '<biblScope unit="page" from="{p}"', _when("p % 2 = 1", ' to="', F.col("p") + F.col("q"), '"'), "/>",
        '<date when="', F.lit(1850) + F.col("p") % 200, '-05"/></imprint></monogr>',
        '<idno type="PMID">{q}</idno><idno type="DOI">10.1/{p}</idno><idno type="arXiv"></idno>',
        _when("p % 2 = 0", '<idno type="DOI">10.2/{q}</idno>'),
        '<note type="other">No</note><note type="raw_reference">Raw {p} &amp; {q}</note></biblStruct>',
    )
    tokens = tokens_of(papers_from(cites(spark, sf_dir), "<TEI><listBibl>", line, "</listBibl></TEI>"))
    return E.tei_bibliography(tokens)


_BIBS = f"""WITH {CITES}, bibs AS (SELECT *, concat('b', n - 1) AS bib_id,
      CASE WHEN p % 4 <> 0 THEN concat('Part ', p) WHEN p % 11 = 0 THEN '' WHEN p % 3 = 0 THEN concat('Series ', q) WHEN p % 5 = 0 THEN concat('Part ', p) ELSE concat('Book ', q) END AS title,
      CASE WHEN p % 5 = 0 THEN concat('Part ', p) ELSE concat('Book ', q) END AS book FROM cites)"""
_KEPT = " FROM bibs WHERE title <> ''"


@query("d1_bibliography", f"{_BIBS} SELECT doc_id, bib_id, title{_KEPT}")
def d1_bibliography(spark, sf_dir):
    return _bibliography(spark, sf_dir).select("doc_id", "bib_id", "title")


@query(
    "d2_venue",
    f"""{_BIBS} SELECT doc_id, bib_id, CASE WHEN p % 11 = 0 THEN '' WHEN p % 2 = 0 THEN concat('Journal ', q) WHEN book <> title THEN book
      WHEN p % 3 = 0 AND concat('Series ', q) <> title THEN concat('Series ', q) ELSE '' END AS venue{_KEPT}""",
)
def d2_venue(spark, sf_dir):
    return _bibliography(spark, sf_dir).select("doc_id", "bib_id", "venue")


@query("d3_year", f"{_BIBS} SELECT doc_id, bib_id, CASE WHEN 1850 + p % 200 BETWEEN 1900 AND 2099 THEN CAST(1850 + p % 200 AS INTEGER) END AS year{_KEPT}")
def d3_year(spark, sf_dir):
    return _bibliography(spark, sf_dir).select("doc_id", "bib_id", "year")


@query("d4_volume_issue", f"{_BIBS} SELECT doc_id, bib_id, CAST(q AS VARCHAR) AS volume, CASE WHEN p % 3 = 1 THEN CAST(n AS VARCHAR) ELSE '' END AS issue{_KEPT}")
def d4_volume_issue(spark, sf_dir):
    return _bibliography(spark, sf_dir).select("doc_id", "bib_id", "volume", "issue")


@query("d5_pages", f"{_BIBS} SELECT doc_id, bib_id, CASE WHEN p % 2 = 1 THEN concat(p, '--', p + q) ELSE CAST(p AS VARCHAR) END AS pages{_KEPT}")
def d5_pages(spark, sf_dir):
    return _bibliography(spark, sf_dir).select("doc_id", "bib_id", "pages")


@query(
    "d6_other_ids",
    f"""{_BIBS} SELECT doc_id, bib_id, concat('{{"PMID":["', q, '"],"DOI":["10.1/', p, '"', CASE WHEN p % 2 = 0 THEN concat(',"10.2/', q, '"') ELSE '' END, ']}}') AS other_ids{_KEPT}""",
)
def d6_other_ids(spark, sf_dir):
    return _bibliography(spark, sf_dir).select("doc_id", "bib_id", F.to_json("other_ids").alias("other_ids"))


@query("d7_raw_reference", f"{_BIBS} SELECT doc_id, bib_id, concat('Raw ', p, ' & ', q) AS raw_text{_KEPT}")
def d7_raw_reference(spark, sf_dir):
    return _bibliography(spark, sf_dir).select("doc_id", "bib_id", "raw_text")


@query("d7_latex_reference", f"WITH {CITES} SELECT doc_id, n, concat('Lee ', p, '. Title', ' ', q, ', 2015') AS raw_text FROM cites")
def d7_latex_reference(spark, sf_dir):
    rows = cites(spark, sf_dir)
    return rows.select("doc_id", "n", E.clean_reference(text("Lee {p}.\n Title  {q},\t2015 ")).alias("raw_text"))


@query(
    "d1_jats_bibliography",
    f"""WITH {CITES} SELECT doc_id, concat('ref', n) AS old_key, concat('Part ', p) AS title, CASE WHEN p % 3 <> 0 THEN CAST(1990 + n AS INTEGER) END AS year, concat('J ', q) AS venue,
      CAST(q AS VARCHAR) AS volume, CAST(n AS VARCHAR) AS issue, CASE WHEN p % 2 = 0 THEN concat(p, '-', p + 9) END AS pages, concat('{{"DOI":[', CASE WHEN p % 5 = 0 THEN concat('"10.1/', p, '"') ELSE '' END, ']}}') AS other_ids FROM cites""",
)
def d1_jats_bibliography(spark, sf_dir):
    line = text(
        '<ref id="ref{n}"><label>{n}</label><element-citation><article-title>Part <x>{p}</x></article-title><source>J {q}</source><year>', F.lit(1990) + F.col("n"), _when("p % 3 = 0", "a"), "</year>",
        "<volume>{q}</volume><issue>{n}</issue><fpage>{p}</fpage>", _when("p % 2 = 0", "<lpage>", F.col("p") + 9, "</lpage>"),
        _when("p % 5 = 0", '<pub-id pub-id-type="doi">10.1/{p}</pub-id>'), '<pub-id pub-id-type="pmid">{q}</pub-id></element-citation></ref>',
    )
    tokens = tokens_of(papers_from(cites(spark, sf_dir), "<back><ref-list>", line, "</ref-list></back>"))
    return E.jats_bibliography(tokens).select("doc_id", "old_key", "title", "year", "venue", "volume", "issue", "pages", F.to_json("other_ids").alias("other_ids"))


@query(
    "d8_bib_text_keys",
    f"""WITH {CITES} SELECT doc_id, CASE WHEN p % 2 = 0 THEN concat('k', p) ELSE concat('Key ', p) END AS bib_key, CASE WHEN p % 2 = 0 THEN concat('Rest of ', q, ' here') ELSE concat('second ', q, ' line') END AS raw_text,
      concat('http://x.org/', p, '|http://y.org/', n) AS urls FROM cites""",
)
def d8_bib_text_keys(spark, sf_dir):
    links = '<xref url="http://x.org/{p}"></xref><xref url="http://y.org/{n}"/>'
    line = F.when(F.col("p") % 2 == 0, text("<p>[k{p}] Rest of {q}\n here", links, "</p>")).otherwise(text("<p>Key\t{p}\n second {q}\nline", links, "</p>"))
    tokens = tokens_of(papers_from(cites(spark, sf_dir), "<bibliography>", line, "</bibliography>"))
    return E.bib_text_key(E.bib_texts(tokens)).select("doc_id", "bib_key", "raw_text", F.array_join("urls", "|").alias("urls"))


@query(
    "d9_author_names",
    f"""WITH {CITES} SELECT doc_id, concat('A', p) AS first, concat_ws('|', CASE WHEN p % 3 = 0 THEN concat('M', q) END, CASE WHEN p % 2 = 0 THEN 'Second' END, CASE WHEN p % 5 = 0 THEN concat('van', n) END) AS middle,
      concat('L', q) AS last, CASE WHEN p % 7 = 0 THEN 'Jr PhD' ELSE '' END AS suffix, concat('a', n, '@x.org') AS email FROM cites""",
)
def d9_author_names(spark, sf_dir):
    line = text(
        '<author><persName><forename type="first">A{p}</forename>', _when("p % 3 = 0", '<forename type="middle">M{q}</forename>'),
        _when("p % 2 = 0", '<forename type="first">Second</forename>'), _when("p % 5 = 0", "<surname>van{n}</surname>"), "<surname>L{q}</surname>",
        _when("p % 7 = 0", "<suffix>Jr</suffix><suffix>PhD</suffix>"), "</persName><email>a{n}@x.org</email></author>",
    )
    tokens = tokens_of(papers_from(cites(spark, sf_dir), "<analytic>", line, "</analytic>"))
    return E.tei_authors(tokens).withColumn("middle", F.array_join("middle", "|")).select("doc_id", "first", "middle", "last", "suffix", "email")


@query(
    "d10_author_split",
    """WITH names AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN concat('Ann ', event_type, ' U', user_id) WHEN 1 THEN concat('Ann U', user_id, ' Jr.') WHEN 2 THEN concat('U', user_id) ELSE concat('Ann ', event_type, ' B', ' U', user_id, ' III') END AS w,
      event_id % 4 AS k, user_id, event_type FROM events)
    SELECT event_id, CASE WHEN k = 2 THEN '' ELSE 'Ann' END AS first, CASE k WHEN 0 THEN event_type WHEN 1 THEN concat('U', user_id) WHEN 2 THEN '' ELSE concat(event_type, ' B U', user_id) END AS middle, concat('U', user_id) AS last FROM names""",
)
def d10_author_split(spark, sf_dir):
    forms = F.array(text("Ann  {event_type} U{user_id} "), text("Ann U{user_id} Jr."), text("U{user_id}"), text("Ann {event_type} B U{user_id}\tIII"))
    rows = table(spark, sf_dir, "events").select("event_id", E.split_author(F.get(forms, F.col("event_id") % 4)).alias("a"))
    return rows.select("event_id", "a.first", F.array_join("a.middle", " ").alias("middle"), "a.last")


@query("d10_title_block", f"WITH {CITES} SELECT doc_id, concat('Ann ', p, ', B. Lee, Univ ', q) AS last FROM cites")
def d10_title_block(spark, sf_dir):
    line = text("<author> Ann\n{p} <hi>B.  Lee</hi> <sup/><formula>x</formula>Univ {q}</author>")
    tokens = tokens_of(papers_from(cites(spark, sf_dir), "<maketitle>", line, "</maketitle>"))
    return E.title_block_authors(tokens).select("doc_id", "last")


def _mentions(spark, sf_dir):
    """Author mentions: the paper is the event type, so a few papers hold all rows."""
    e = table(spark, sf_dir, "events")
    blank = F.col("user_id") % 13 == 0
    aff = F.when(
        F.col("value") > 50,
        F.struct(F.lit("").alias("laboratory"), text("Inst {event_id}").alias("institution"), F.lit(None).cast("map<string,string>").alias("location")),
    )
    return e.select(
        F.col("event_type").alias("doc_id"), F.col("event_id").alias("pos"),
        F.when(blank, " ").otherwise(text(" First{user_id} ")).alias("first"),
        F.when(F.col("user_id") % 2 == 0, F.array(F.lit(" M "))).otherwise(F.expr("cast(array() as array<string>)")).alias("middle"),
        F.when(blank, "").otherwise(text("Last", F.col("user_id") % 10)).alias("last"), F.lit("").alias("suffix"),
        F.when(F.col("value") > 100, text("e{event_id}@x.org")).otherwise("").alias("email"), aff.alias("affiliation"),
    )


@query(
    "d11_dedup_authors",
    """WITH m AS (SELECT event_type AS doc_id, event_id, value, CASE WHEN user_id % 13 = 0 THEN '' ELSE concat('First', user_id) END AS first,
        CASE WHEN user_id % 2 = 0 THEN 'M' ELSE '' END AS middle, CASE WHEN user_id % 13 = 0 THEN '' ELSE concat('Last', user_id % 10) END AS last, '' AS suffix FROM events)
    SELECT doc_id, first, middle, last, suffix, min(event_id) AS pos, coalesce(concat('e', max(event_id) FILTER (value > 100), '@x.org'), '') AS email,
      CASE WHEN max(event_id) FILTER (value > 50) IS NOT NULL THEN concat('Inst ', max(event_id) FILTER (value > 50)) END AS institution
    FROM (SELECT * FROM m WHERE first <> '' OR last <> '' OR middle <> '') GROUP BY doc_id, first, middle, last, suffix""".replace(
        "coalesce(concat('e', max(event_id) FILTER (value > 100), '@x.org'), '')",
        "CASE WHEN max(event_id) FILTER (value > 100) IS NULL THEN '' ELSE concat('e', max(event_id) FILTER (value > 100), '@x.org') END",
    ),
)
def d11_dedup_authors(spark, sf_dir):
    out = E.dedup_authors(_mentions(spark, sf_dir))
    return out.select("doc_id", "first", "middle", "last", "suffix", "pos", "email", F.col("affiliation.institution").alias("institution"))


@query(
    "d12_affiliations",
    f"""WITH {CITES} SELECT doc_id, CASE WHEN p % 2 = 0 THEN concat('Lab ', p) ELSE '' END AS laboratory, CASE WHEN p % 3 = 0 THEN concat('Inst ', q) ELSE '' END AS institution,
      concat('{{"settlement":"S', q, '","country":"C', p, '"}}') AS location FROM cites WHERE p % 2 = 0 OR p % 3 = 0""",
)
def d12_affiliations(spark, sf_dir):
    line = text(
        "<affiliation>", _when("p % 2 = 0", '<orgName type="laboratory">Lab {p}</orgName>'), _when("p % 3 = 0", '<orgName type="institution">Inst {q}</orgName>'),
        "<address>\n<settlement>S{q}</settlement> <region></region><country>C{p}</country> </address></affiliation>",
    )
    tokens = tokens_of(papers_from(cites(spark, sf_dir), "<author>", line, "</author>"))
    return E.tei_affiliations(tokens).select("doc_id", "laboratory", "institution", F.to_json("location").alias("location"))


def _front(spark, sf_dir):
    line = text(
        '<contrib-group><contrib contrib-type="author"', _when("p % 4 = 0", ' corresp="yes"'), "><name><surname>Sur{p}</surname>",
        _when("p % 50 <> 0", "<given-names>Ann B{q} C</given-names>"), _when("p % 3 = 0", "<suffix>Jr</suffix>"), "</name>",
        "<contrib-id>", _when("p % 2 = 0", "https://orcid.org/"), F.when(F.expr("p % 7 = 0"), "short").otherwise(text("0000-0000-0000-", F.lit(1000) + F.col("n"))), "</contrib-id>",
        "<email>a{n}@x.org</email>", '<xref ref-type="aff" rid="aff{n}">1</xref><xref ref-type="aff" rid="zz"/>', _when("p % 5 = 0", '<xref ref-type="corresp" rid="c"/>'), "</contrib></contrib-group>",
        "<contrib><collab>Group {n}</collab></contrib>",
    )
    aff = text(
        _when("p % 3 <> 1", '<aff id="aff{n}"><label>{n}</label><sup>x</sup>Univ {p}<institution-wrap><institution-id institution-id-type="GRID">g.{q}</institution-id></institution-wrap>, C</aff>')
    )
    return tokens_of(papers_from(cites(spark, sf_dir), "<front>", line, aff, "</front>"))


_AUTHORS = f"""WITH {CITES}, bad AS (SELECT doc_id FROM cites WHERE p % 50 = 0), authors AS (SELECT * FROM cites WHERE doc_id NOT IN (SELECT doc_id FROM bad))"""


@query("d13_author_affiliation", f"{_AUTHORS} SELECT doc_id, concat('Sur', p) AS last, CASE WHEN p % 3 <> 1 THEN concat('Univ ', p, ', C') END AS institution FROM authors")
def d13_author_affiliation(spark, sf_dir):
    tokens = _front(spark, sf_dir)
    return E.join_affiliations(E.jats_contributors(tokens), E.jats_affiliations(tokens)).select("doc_id", "last", "institution")


@query("d13_affiliation_texts", f"""WITH {CITES} SELECT doc_id, concat('aff', n) AS aff_id, concat('Univ ', p, ', C') AS text, concat('{{"GRID":"g.', q, '"}}') AS other_ids FROM cites WHERE p % 3 <> 1""")
def d13_affiliation_texts(spark, sf_dir):
    return E.jats_affiliations(_front(spark, sf_dir)).select("doc_id", "aff_id", "text", F.to_json("other_ids").alias("other_ids"))


@query(
    "d14_contributors",
    f"""{_AUTHORS} SELECT doc_id, 'Ann' AS first, concat('B', q, ' C') AS middle, concat('Sur', p) AS last, CASE WHEN p % 3 = 0 THEN 'Jr' ELSE '' END AS suffix, concat('a', n, '@x.org') AS email,
      CASE WHEN p % 7 <> 0 THEN concat('0000-0000-0000-', 1000 + n) END AS orcid, p % 4 = 0 OR p % 5 = 0 AS corresponding, concat('aff', n, ' zz') AS affiliation_ids FROM authors""",
)
def d14_contributors(spark, sf_dir):
    out = E.jats_contributors(_front(spark, sf_dir)).drop("pos")
    return out.withColumns({"middle": F.array_join("middle", " "), "affiliation_ids": F.array_join("affiliation_ids", " ")})


@query(
    "d15_funders",
    f"""WITH {CITES} SELECT doc_id, CASE p % 5 WHEN 0 THEN concat('Agency ', q) WHEN 1 THEN concat('Fond ', q) WHEN 2 THEN concat('Council ', q) WHEN 3 THEN CAST(NULL AS VARCHAR) ELSE concat('Body ', q) END AS name,
      CASE p % 5 WHEN 0 THEN concat('10.13/', p) WHEN 1 THEN concat('10.14/', p) WHEN 2 THEN concat('10.15/', p) WHEN 3 THEN NULL ELSE concat('10.16/', p) END AS doi,
      CASE p % 5 WHEN 3 THEN concat('We thank ', q) WHEN 4 THEN concat(' supports ', n) END AS notes FROM cites""",
)
def d15_funders(spark, sf_dir):
    forms = [
        text("<funding-source><institution-wrap><institution-id>http://dx.doi.org/10.13/{p}</institution-id><institution>Agency {q}</institution></institution-wrap></funding-source>"),
        text('<funding-source xlink:href="https://dx.doi.org/10.14/{p}">Fond {q}</funding-source>'),
        text("<funding-source>Council {q} http://dx.doi.org/10.15/{p}</funding-source>"),
        text("<funding-statement>We thank {q}</funding-statement>"),
        text('<funding-source><funding-source><named-content content-type="funder-name">Body {q}</named-content><named-content content-type="funder-identifier">http://dx.doi.org/10.16/{p}</named-content> supports {n}</funding-source></funding-source>'),
    ]
    line = F.get(F.array(*forms), F.col("p") % 5)
    tokens = tokens_of(papers_from(cites(spark, sf_dir), "<front><funding-group>", line, "</funding-group></front>"))
    return E.jats_funders(tokens).select("doc_id", "name", "doi", "notes")


@query(
    "d16_most_frequent",
    """WITH c AS (SELECT user_id AS doc_id, event_type, count(*) AS k, min(event_id) AS f FROM events GROUP BY 1, 2),
    r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY k DESC, f) AS rn FROM c) SELECT doc_id, event_type AS journal_id FROM r WHERE rn = 1""",
)
def d16_most_frequent(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(F.col("user_id").alias("doc_id"), F.col("event_id").alias("pos"), F.col("event_type").alias("value"))
    return E.most_frequent(rows)


@query(
    "d17_article_ids",
    f"""WITH {CITES} SELECT doc_id, concat('10.1/', min(p)) AS doi, CAST(max(q) AS VARCHAR) AS pubmed_id, concat('PMC', min(p)) AS pmc_id,
      'Journal' AS journal_name, concat('Cat ', arg_min(q, n)) AS category, CASE WHEN count(*) > 1 THEN 'multiple_categories' END AS reason FROM cites GROUP BY doc_id""",
)
def d17_article_ids(spark, sf_dir):
    per_doc = cites(spark, sf_dir).groupBy("doc_id").agg(F.min("p").alias("lo"), F.max("q").alias("hi"))
    rows = cites(spark, sf_dir).join(per_doc, "doc_id")
    first = F.col("n") == F.min("n").over(_doc())
    ids = F.when(
        first,
        text('<article-id pub-id-type="doi">10.1/{lo}</article-id><article-id pub-id-type="pmid">{hi}</article-id><article-id pub-id-type="pmc">{lo}</article-id><journal-title>Journal</journal-title>'),
    ).otherwise("")
    rows = rows.withColumn("ids", ids)
    line = text("<subj-group><subject>Cat {q}</subject></subj-group>")
    return E.article_ids(tokens_of(papers_from(rows, "<front>", F.col("ids"), line, "</front>")))


def _doc():
    from pyspark.sql import Window as W

    return W.partitionBy("doc_id")


_KINDS = {"1-URGENT": "epub", "2-HIGH": "accepted", "3-MEDIUM": "collection", "4-NOT SPECIFIED": "received", "5-LOW": "other"}
_KIND_SQL = "CASE o_orderpriority " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _KINDS.items()) + " END"


@query(
    "d18_best_dates",
    f"""WITH d AS (SELECT o_custkey AS doc_id, o_orderkey AS pos, {_KIND_SQL} AS kind, concat_ws('-', year(o_orderdate), month(o_orderdate), CASE WHEN o_orderkey % 3 <> 0 THEN day(o_orderdate) END) AS date FROM orders)
    SELECT doc_id, max_by(date, pos) FILTER (kind = 'epub') AS epub, max_by(date, pos) FILTER (kind = 'accepted') AS accepted, max_by(date, pos) FILTER (kind = 'collection') AS collection, max_by(date, pos) FILTER (kind = 'received') AS received,
      coalesce(max_by(date, pos) FILTER (kind = 'epub'), max_by(date, pos) FILTER (kind = 'accepted'), max_by(date, pos) FILTER (kind = 'collection'), max_by(date, pos) FILTER (kind = 'received')) AS best FROM d GROUP BY doc_id""",
)
def d18_best_dates(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    kind = F.create_map(*[F.lit(x) for kv in _KINDS.items() for x in kv])[F.col("o_orderpriority")]
    day = F.when(F.col("o_orderkey") % 3 != 0, F.day("o_orderdate"))
    date = E.date_text(F.year("o_orderdate").cast("string"), F.month("o_orderdate").cast("string"), day.cast("string"))
    return E.best_dates(o.select(F.col("o_custkey").alias("doc_id"), F.col("o_orderkey").alias("pos"), kind.alias("kind"), date.alias("date")))


@query(
    "d18_front_dates",
    f"""WITH {CITES} SELECT doc_id, CASE WHEN p % 2 = 0 THEN 'epub' ELSE 'accepted' END AS kind, CASE WHEN p % 3 = 0 THEN concat(2000 + n, '-', q % 12 + 1) ELSE concat(2000 + n, '-', q % 12 + 1, '-', p % 28 + 1) END AS date FROM cites""",
)
def d18_front_dates(spark, sf_dir):
    day = _when("p % 3 <> 0", "<day>", F.col("p") % 28 + 1, "</day>")
    parts = text(day, "<month>", F.col("q") % 12 + 1, "</month><year>", F.lit(2000) + F.col("n"), "</year>")
    line = F.when(F.expr("p % 2 = 0"), text('<pub-date pub-type="epub">', parts, "</pub-date>")).otherwise(text('<history><date date-type="accepted">', parts, "</date></history>"))
    return E.jats_dates(tokens_of(papers_from(cites(spark, sf_dir), "<front>", line, "</front>"))).select("doc_id", "kind", "date")


@query(
    "d18_identifier_year",
    f"""WITH {CITES} SELECT doc_id, n, CASE WHEN p % 4 = 0 THEN '' WHEN p % 100 < 40 THEN CAST(2000 + p % 100 AS VARCHAR) ELSE CAST(1900 + p % 100 AS VARCHAR) END AS year FROM cites""",
)
def d18_identifier_year(spark, sf_dir):
    file_id = F.when(F.col("p") % 4 == 0, text("hep{p}.1")).otherwise(text(F.lpad((F.col("p") % 100).cast("string"), 2, "0"), "05.{n}"))
    return cites(spark, sf_dir).select("doc_id", "n", E.identifier_year(file_id).alias("year"))


@query("d18_published_date", f"WITH {CITES} SELECT doc_id, coalesce(arg_min(concat('2018-06-', 10 + q), n) FILTER (p % 3 = 0), '') AS year FROM cites GROUP BY doc_id")
def d18_published_date(spark, sf_dir):
    kind = F.when(F.expr("p % 3 = 0"), "published").otherwise("drafted")
    line = text('<date type="', kind, '" when="2018-06-', F.lit(10) + F.col("q"), '"/>')
    return E.published_date(tokens_of(papers_from(cites(spark, sf_dir), "<fileDesc><publicationStmt>", line, '</publicationStmt><date type="published" when="1900"/></fileDesc>')))


@query(
    "d19_section_paths",
    """WITH RECURSIVE tree AS (
      SELECT p_partkey AS id, concat('S', p_partkey % 7) AS path FROM part WHERE p_partkey = 0
      UNION ALL SELECT p.p_partkey, concat(t.path, '::S', p.p_partkey % 7) FROM part p JOIN tree t ON p.p_partkey // 10 = t.id AND p.p_partkey <> 0)
    SELECT CAST(id AS VARCHAR) AS sec_id, path AS section, CAST(length(path) - length(replace(path, '::', '')) AS INTEGER) // 2 + 1 AS depth FROM tree""",
)
def d19_section_paths(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select(
        F.lit("tree").alias("doc_id"), F.col("p_partkey").cast("string").alias("sec_id"), F.col("p_partkey").cast("string").alias("num"),
        text("S", F.col("p_partkey") % 7).alias("name"), F.expr("p_partkey div 10").cast("string").alias("parent"),
    )
    paths = trees.section_paths(rows)
    return paths.select("sec_id", F.array_join(F.transform("path", lambda s: s["name"]), "::").alias("section"), F.size("path").alias("depth"))


@query(
    "d20_synthetic_ids",
    """WITH s AS (SELECT p_brand AS doc_id, p_partkey AS pos, CASE WHEN p_size % 2 = 0 THEN concat('SECREF', p_partkey) END AS id FROM part),
    t AS (SELECT *, greatest(999, coalesce(max(CASE WHEN id IS NOT NULL THEN pos END) OVER (PARTITION BY doc_id), 0)) AS top, sum(CASE WHEN id IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos) AS nth FROM s)
    SELECT doc_id, pos, coalesce(id, concat('SECREF', CAST(top + nth AS BIGINT))) AS sec_id FROM t""",
)
def d20_synthetic_ids(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("doc_id"), F.col("p_partkey").alias("pos"), F.when(F.col("p_size") % 2 == 0, text("SECREF{p_partkey}")).alias("sec_id")
    )
    return trees.synthetic_ids(rows).select("doc_id", "pos", "sec_id")


