"""Queries over spans, citations and references."""

from pyspark.sql import functions as F

from paperloom.functions.ids import latex_key, tei_key
from paperloom.operators import citations as C
from paperloom.operators import spans as P
from paperloom.plans.adapters import CITES, cites, papers_from, text, tokens_of
from paperloom.plans.registry import query



def _bib():
    return F.when(F.col("p") % 4 != 0, text('<biblStruct xml:id="b', F.col("n") - 1, '"><title>T{p}</title></biblStruct>')).otherwise("")


_LEN = "length(concat('[', n, ']'))"
_REF = "CASE WHEN p % 4 <> 0 THEN concat('BIBREF', n - 1) END"


@query(
    "c1_normalise_ids",
    f"""WITH {CITES} SELECT doc_id, n, concat('BIBREF', p) AS bib, concat('TABREF', n) AS tab, concat('FIGREF', n) AS fig, concat('EQREF', n) AS eq,
      concat('BIBREF', p) AS latex_bib, concat('SECREF', n) AS latex_sec, concat('UID', n) AS latex_other FROM cites""",
)
def c1_normalise_ids(spark, sf_dir):
    tei = {"bib": "#b{p}", "tab": "#tab_{n}", "fig": "fig_{n}", "eq": "formula_{n}"}
    latex = {"latex_bib": "bid{p}", "latex_sec": "cid_{n}", "latex_other": "uid{n}"}
    return cites(spark, sf_dir).select(
        "doc_id", "n", *[tei_key(text(v)).alias(k) for k, v in tei.items()], *[latex_key(text(v)).alias(k) for k, v in latex.items()]
    )


@query(
    "c2_citation_spans",
    f"""WITH {CITES}
    SELECT doc_id, concat('Uses [', n, '] for ', q, '.') AS para_text, 5::INTEGER AS start, CAST(5 + {_LEN} AS INTEGER) AS "end", concat('[', n, ']') AS text, {_REF} AS ref_id FROM cites
    UNION ALL SELECT doc_id, concat('seen (', p, ') [', n, '] .'), CAST(8 + length(CAST(p AS VARCHAR)) AS INTEGER), CAST(8 + length(CAST(p AS VARCHAR)) + {_LEN} AS INTEGER), concat('[', n, ']'), NULL FROM cites""",
)
def c2_citation_spans(spark, sf_dir):
    ref = text('<ref type="bibr" target="#b', F.col("n") - 1, '"> [{n}] </ref>')
    line = text("<p>Uses ", ref, ' for {q}.</p><p>seen ({p})<ref type="bibr">[{n}]</ref>.</p>')
    tokens = tokens_of(papers_from(cites(spark, sf_dir), "<TEI><body>", line, "</body><back><listBibl>", _bib(), "</listBibl></back></TEI>"))
    return C.span_rows(C.cited_paragraphs(C.cited_units(tokens)), "para_text").select("doc_id", "para_text", "start", "end", "text", "ref_id")


@query("c3_bracket_style", f"WITH {CITES} SELECT doc_id, 2 * count(*) FILTER (p % 2 = 0 AND n <= 999) > 5 AS bracket FROM cites GROUP BY doc_id")
def c3_bracket_style(spark, sf_dir):
    head = F.when(F.col("p") % 2 == 1, "<head>H</head>").otherwise("")
    line = text("<div><div>", head, '<p><ref type="bibr">[{n}]</ref> <ref type="bibr" target="#b0">[{n}, 9]</ref><ref type="bibr">{n}</ref><ref>[1]</ref></p></div></div>')
    return C.bracket_style(tokens_of(papers_from(cites(spark, sf_dir), "<TEI><body>", line, "</body></TEI>")), C.MORE_THAN, C.DIGITS)


@query(
    "c4_bracket_filter",
    f"""WITH {CITES}, lines AS (SELECT *, 3 * count(*) FILTER (n <= 999) OVER (PARTITION BY doc_id) + count(*) FILTER (p % 3 <> 0 AND n <= 999) OVER (PARTITION BY doc_id) > 5 AS bracket,
      CASE WHEN p % 3 = 0 THEN CAST(n AS VARCHAR) ELSE concat('[', n, ']') END AS surface FROM cites)
    SELECT doc_id, 4::INTEGER AS start, CAST(4 + length(surface) AS INTEGER) AS "end", surface AS text, {_REF} AS ref_id
    FROM lines WHERE NOT (p % 4 <> 0 AND bracket AND p % 3 = 0)
    UNION ALL SELECT doc_id, CAST(1 + k * ({_LEN} + 1) AS INTEGER), CAST(1 + k * ({_LEN} + 1) + {_LEN} AS INTEGER), concat('[', n, ']'), NULL FROM lines, (SELECT unnest([0, 1, 2]) AS k)""",
)
def c4_bracket_filter(spark, sf_dir):
    surface = F.when(F.col("p") % 3 == 0, text("{n}")).otherwise(text("[{n}]"))
    line = text(
        '<div><p>See <ref type="bibr" target="#b', F.col("n") - 1, '">', surface, "</ref>.</p><p>",
        *['<ref type="bibr">[{n}]</ref>'] * 3, "</p></div>",
    )
    tokens = tokens_of(papers_from(cites(spark, sf_dir), "<TEI><body>", line, "</body><back><listBibl>", _bib(), "</listBibl></back></TEI>"))
    paras = C.cited_paragraphs(C.cited_units(tokens, style=True), None, C.MORE_THAN, C.WIDEST, C.DIGITS)
    return C.span_rows(paras).select("doc_id", "start", "end", "text", "ref_id")


@query(
    "c5_range_marker",
    f"""WITH {CITES} SELECT doc_id, n, CASE p % 5 WHEN 0 THEN '-' WHEN 1 THEN ' –' WHEN 2 THEN ', ' WHEN 3 THEN ' - ' ELSE '  ' END AS gap, p % 5 IN (0, 1) AS is_range FROM cites""",
)
def c5_range_marker(spark, sf_dir):
    gaps = F.array(*[F.lit(g) for g in ("-", " –", ", ", " - ", "  ")])
    rows = cites(spark, sf_dir).withColumn("gap", F.get(gaps, F.col("p") % 5))
    return rows.select("doc_id", "n", "gap", C.is_range_gap(F.col("gap")).alias("is_range"))


@query(
    "c6_range_expansion",
    f"""WITH {CITES}, wide AS (SELECT *, CASE WHEN p % 7 = 0 THEN 1 ELSE 2 + p % 5 END AS d FROM cites),
    lines AS (SELECT *, d > 1 AND n + d <= 999 AND count(*) FILTER (n <= 999) OVER (PARTITION BY doc_id) + count(*) FILTER (n + d <= 999) OVER (PARTITION BY doc_id) > 5 AS grows FROM wide),
    keys AS (SELECT doc_id, n - 1 AS k FROM lines UNION SELECT doc_id, n - 1 + d FROM lines),
    grown AS (SELECT l.doc_id, l.n, l.d, unnest(generate_series(0, l.d)) AS s FROM lines l WHERE grows),
    spans AS (
      SELECT doc_id, CAST(3 + sum(length(concat('[', n + s, ']')) + 1) OVER (PARTITION BY doc_id, n ORDER BY s) - length(concat('[', n + s, ']')) - 1 AS INTEGER) AS start, concat('[', n + s, ']') AS text, n - 1 + s AS k FROM grown
      UNION ALL SELECT doc_id, 3::INTEGER, concat('[', n, ']'), n - 1 FROM lines WHERE NOT grows
      UNION ALL SELECT doc_id, CAST(3 + {_LEN} + 3 AS INTEGER), concat('[', n + d, ']'), n - 1 + d FROM lines WHERE NOT grows)
    SELECT s.doc_id, s.start, CAST(s.start + length(s.text) AS INTEGER) AS "end", s.text, CASE WHEN keys.k IS NOT NULL THEN concat('BIBREF', s.k) END AS ref_id
    FROM spans s LEFT JOIN keys ON s.doc_id = keys.doc_id AND s.k = keys.k""",
)
def c6_range_expansion(spark, sf_dir):
    rows = cites(spark, sf_dir).withColumn("d", F.when(F.col("p") % 7 == 0, 1).otherwise(F.col("p") % 5 + 2))
    first, last = F.col("n") - 1, F.col("n") - 1 + F.col("d")
    line = text('<p>In <ref type="bibr" target="#b', first, '">[{n}]</ref>-<ref type="bibr" target="#b', last, '">[', last + 1, "]</ref> now</p>")
    bib = text(*[x for i in (first, last) for x in ('<biblStruct xml:id="b', i, '"><title>T</title></biblStruct>')])
    tokens = tokens_of(papers_from(rows, "<TEI><body><div>", line, "</div></body><back><listBibl>", bib, "</listBibl></back></TEI>"))
    paras = C.cited_paragraphs(C.cited_units(tokens, style=True), None, C.MORE_THAN, C.WIDEST, C.DIGITS)
    return C.span_rows(paras).select("doc_id", "start", "end", "text", "ref_id")


@query(
    "c7_figure_table_spans",
    f"""WITH {CITES}
    SELECT doc_id, concat('In Fig. ', n, ' , ', n, ' and S', n, '.') AS para_text, 3::INTEGER AS start, CAST(8 + length(n::VARCHAR) AS INTEGER) AS "end", concat('Fig. ', n) AS text, CASE WHEN p % 3 <> 0 THEN concat('FIGREF', n) END AS ref_id FROM cites
    UNION ALL SELECT doc_id, concat('In Fig. ', n, ' , ', n, ' and S', n, '.'), CAST(11 + length(n::VARCHAR) AS INTEGER), CAST(11 + 2 * length(n::VARCHAR) AS INTEGER), n::VARCHAR, CASE WHEN p % 2 = 0 THEN concat('TABREF', n) END FROM cites""",
)
def c7_figure_table_spans(spark, sf_dir):
    line = text(
        '<p>In <ref type="figure" target="#fig_{n}">Fig. {n}</ref>, <ref type="table" target="#tab_{n}">{n}</ref> and <ref type="section">S{n}</ref>.</p>',
        F.when(F.col("p") % 3 != 0, text('<figure xml:id="fig_{n}"/>')).otherwise(""),
        F.when(F.col("p") % 2 == 0, text('<figure type="table" xml:id="tab_{n}"></figure>')).otherwise(""),
    )
    tokens = tokens_of(papers_from(cites(spark, sf_dir), "<TEI><body>", line, "</body></TEI>"))
    return C.span_rows(C.cited_paragraphs(C.cited_units(tokens)), "para_text").select("doc_id", "para_text", "start", "end", "text", "ref_id")


@query(
    "c8_prefix_precedence",
    f"""WITH {CITES}
    SELECT doc_id, n, CASE WHEN p % 7 = 0 THEN concat('SECREF', n) WHEN p % 7 = 1 THEN concat('XID', n)
      WHEN p % 2 = 0 THEN concat('FIGREF', n) WHEN p % 3 = 0 THEN concat('TABREF', n) WHEN p % 5 = 0 THEN concat('SECREFU', n) ELSE concat('UID', n) END AS ref_id FROM cites""",
)
def c8_prefix_precedence(spark, sf_dir):
    rows = cites(spark, sf_dir)
    kind = F.when(F.col("p") % 7 == 0, "cid").when(F.col("p") % 7 == 1, "xid").otherwise("uid")
    refs = rows.select("doc_id", "n", text(kind, "{n}").alias("target"))
    have = F.array_compact(
        F.array(
            F.when(F.col("p") % 2 == 0, text("FIGREF{n}")), F.when(F.col("p") % 3 == 0, text("TABREF{n}")),
            F.when(F.col("p") % 5 == 0, text("SECREFU{n}")), text("SECREF{n}"),
        )
    )
    entries = rows.select("doc_id", F.explode(have).alias("ref_id"))
    return P.resolve_by_precedence(refs, entries).select("doc_id", "n", "ref_id")


_C9_KINDS = [("cite", "BIBREF", "4"), ("ref", "FIGREF", "15 + length(n::VARCHAR)"), ("ref", "SECREFU", "28 + 2 * length(n::VARCHAR)")]


@query(
    "c9_placeholder_spans",
    f"WITH {CITES} "
    + " UNION ALL ".join(
        f"""SELECT doc_id, n, '{kind}' AS kind, CAST({at} AS INTEGER) AS start, CAST({at} + {len(name)} + length(n::VARCHAR) AS INTEGER) AS "end",
        concat('{name}', n) AS ref_id, {"CASE WHEN p % 2 = 0 THEN concat('N', q) END" if name != "FIGREF" else "NULL"} AS text FROM cites"""
        for kind, name, at in _C9_KINDS
    ),
)
def c9_placeholder_spans(spark, sf_dir):
    rows = cites(spark, sf_dir).withColumn("para_text", text("See BIBREF{n} and FIGREF{n}, then SECREFU{n}."))
    named = rows.where("p % 2 = 0").select("doc_id", text("N{q}").alias("num"), F.explode(F.array(text("BIBREF{n}"), text("SECREFU{n}"))).alias("ref_id"))
    spans = P.placeholder_spans(rows, ["doc_id", "n"], "para_text")
    return P.with_numbers(spans, named).select("doc_id", "n", "kind", "start", "end", "ref_id", "text")


def _moved(spark, sf_dir):
    rows = cites(spark, sf_dir).withColumn("para_text", text("Both BIBREF{n} and FIGREF{p} fit {q}."))
    spans = P.placeholder_spans(rows, ["doc_id", "n"], "para_text", carry=["para_text"])
    number = F.regexp_extract("ref_id", r"(\d+)$", 1)
    surface = F.when(F.col("kind") == "cite", F.concat(F.lit("["), number, F.lit("]"))).otherwise(F.concat(F.lit("Figure "), number))
    return P.substitute(spans.withColumns({"token": F.col("ref_id"), "surface": surface}), ["doc_id", "n"])


@query(
    "c10_reindex",
    f"""WITH {CITES}
    SELECT doc_id, n, concat('[', n, ']') AS surface, 5::INTEGER AS new_start, CAST(5 + {_LEN} AS INTEGER) AS new_end FROM cites
    UNION ALL SELECT doc_id, n, concat('Figure ', p), CAST(10 + {_LEN} AS INTEGER), CAST(17 + {_LEN} + length(p::VARCHAR) AS INTEGER) FROM cites""",
)
def c10_reindex(spark, sf_dir):
    return _moved(spark, sf_dir).select("doc_id", "n", "surface", "new_start", "new_end")


@query("c10_replaced_text", f"WITH {CITES} SELECT doc_id, n, concat('Both [', n, '] and Figure ', p, ' fit ', q, '.') AS para_text FROM cites")
def c10_replaced_text(spark, sf_dir):
    return P.substituted_text(_moved(spark, sf_dir), ["doc_id", "n"])


_ALPHABET = "abcdefghijklmnopqrstuvwxyzabcdefghijklmnopqrstuvwxyz"


@query(
    "c11_replace_padded",
    f"""WITH RECURSIVE {CITES},
    spans AS (SELECT doc_id, 3 * n AS s, 3 * n + q % 7 + 1 AS e, concat('<', n, '>') AS w, row_number() OVER (PARTITION BY doc_id ORDER BY n) AS i FROM cites),
    fold AS (
      SELECT doc_id, 0::BIGINT AS i, 0::BIGINT AS last_end, false AS any_kept, '' AS out FROM (SELECT DISTINCT doc_id FROM spans)
      UNION ALL
      SELECT f.doc_id, s.i, CASE WHEN s.s >= f.last_end OR NOT f.any_kept THEN s.e ELSE f.last_end END, true,
        CASE WHEN s.s >= f.last_end OR NOT f.any_kept THEN
          concat(f.out, substr('{_ALPHABET}', CAST(f.last_end + 1 AS INTEGER), CAST(s.s - f.last_end AS INTEGER)), CASE WHEN s.s = f.last_end AND f.any_kept THEN ', ' ELSE '' END, '(', s.w, ')')
        ELSE f.out END
      FROM fold f JOIN spans s ON s.doc_id = f.doc_id AND s.i = f.i + 1)
    SELECT doc_id, concat(max_by(out, i), substr('{_ALPHABET}', CAST(max_by(last_end, i) + 1 AS INTEGER))) AS para_text FROM fold GROUP BY doc_id""",
)
def c11_replace_padded(spark, sf_dir):
    start = (F.col("n") * 3).cast("int")
    span = F.struct(start.alias("start"), (start + F.col("q") % 7 + 1).cast("int").alias("end"), text("<{n}>").alias("surface"))
    rows = cites(spark, sf_dir).groupBy("doc_id").agg(F.collect_list(span).alias("spans"))
    return rows.select("doc_id", P.replace_padded(F.lit(_ALPHABET), F.col("spans"), pre="(", post=")").alias("para_text"))


@query(
    "c12_formula_spans",
    f"""WITH {CITES}
    SELECT doc_id, n, 4::INTEGER AS start, 15::INTEGER AS "end", 'INLINEFORM0' AS token, concat('x ', p) AS math, concat('x_', p) AS latex, CAST(NULL AS VARCHAR) AS ref_id, 'Let INLINEFORM0 and DISPLAYFORM0 hold.' AS para_text FROM cites
    UNION ALL SELECT doc_id, n, 20::INTEGER, 32::INTEGER, 'DISPLAYFORM0', concat('y', q), concat('y^', q), concat('EQREF', n), 'Let INLINEFORM0 and DISPLAYFORM0 hold.' FROM cites""",
)
def c12_formula_spans(spark, sf_dir):
    line = text(
        "<p>Let <formula><math>x {p}</math><texmath>x_{p}</texmath></formula> and "
        '<formula id="uid{n}"><math>y{q}</math><texmath>y^{q}</texmath></formula> hold.</p>'
    )
    tokens = tokens_of(papers_from(cites(spark, sf_dir).withColumn("doc_id", text("{doc_id}/{n}")), line))
    placed = C.layout(P.formula_pieces(tokens), ["math", "latex", "target"])
    spans = C.span_rows(C.laid_paragraphs(placed, "math", "latex", "target"), "para_text")
    part = F.split("doc_id", "/")
    return spans.select(
        part[0].alias("doc_id"), part[1].cast("int").alias("n"), "start", "end", F.col("text").alias("token"), "math", "latex",
        F.replace(F.col("target"), F.lit("uid"), F.lit("EQREF")).alias("ref_id"), "para_text",
    )


def _typed(spark, sf_dir):
    line = text(
        '<p>As <xref ref-type="bibr" rid="B{n}">{n}<sup>a{q}</sup></xref> in <xref ref-type="fig" rid="F{p}">Fig <b> {n}</b></xref>'
        ' and <xref ref-type="aff" rid="x">z</xref> H<sub>2</sub>O.</p>'
    )
    tokens = tokens_of(papers_from(cites(spark, sf_dir), "<body>", line, "</body>"))
    return P.marked_spans(tokens)


_JATS_TEXT = "concat('As ', n, 'a', q, ' in Fig ', n, ' and z H2O.') AS para_text"
_L1 = "(length(n::VARCHAR) + length(q::VARCHAR))"


@query(
    "c13_typed_spans",
    f"""WITH {CITES}
    SELECT doc_id, {_JATS_TEXT}, 'cite' AS kind, 3::INTEGER AS start, CAST(4 + {_L1} AS INTEGER) AS "end", concat(n, 'a', q) AS text, concat('B', n) AS ref_id FROM cites
    UNION ALL SELECT doc_id, {_JATS_TEXT}, 'fig', CAST(8 + {_L1} AS INTEGER), CAST(12 + {_L1} + length(n::VARCHAR) AS INTEGER), concat('Fig ', n), concat('F', p) FROM cites""",
)
def c13_typed_spans(spark, sf_dir):
    spans = _typed(spark, sf_dir).where("kind in ('cite', 'fig', 'table')")
    return spans.select("doc_id", "para_text", "kind", "start", "end", "text", "ref_id")


@query(
    "c14_sup_sub_spans",
    f"""WITH {CITES}
    SELECT doc_id, 'sup' AS kind, CAST(3 + length(n::VARCHAR) AS INTEGER) AS start, CAST(4 + {_L1} AS INTEGER) AS "end", concat('a', q) AS text FROM cites
    UNION ALL SELECT doc_id, 'sub', CAST(20 + {_L1} + length(n::VARCHAR) AS INTEGER), CAST(21 + {_L1} + length(n::VARCHAR) AS INTEGER), '2' FROM cites""",
)
def c14_sup_sub_spans(spark, sf_dir):
    return _typed(spark, sf_dir).where("kind in ('sup', 'sub')").select("doc_id", "kind", "start", "end", "text")


def _entries(spark, sf_dir):
    rows = cites(spark, sf_dir)
    return rows.select(
        "doc_id", F.when(F.col("f") == "N", "table").otherwise("figure").alias("type"), text("k", F.col("p") % 100, "-{n}").alias("old_key"), "n", "p"
    )


_DENSE = f"""WITH {CITES}, entries AS (SELECT *, CASE WHEN f = 'N' THEN 'table' ELSE 'figure' END AS type, concat('k', p % 100, '-', n) AS old_key FROM cites),
    keyed AS (SELECT *, concat(CASE type WHEN 'table' THEN 'TABREF' ELSE 'FIGREF' END, row_number() OVER (PARTITION BY doc_id, type ORDER BY old_key) - 1) AS new_key FROM entries)"""


def _dense(spark, sf_dir):
    prefix = F.when(F.col("type") == "table", "TABREF").otherwise("FIGREF")
    return P.dense_keys(_entries(spark, sf_dir), prefix, keep=F.col("p") % 4 != 0)


@query(
    "c15_merge_ref_spans",
    _DENSE + """ SELECT doc_id, n, 'ref' AS kind, CAST(n AS INTEGER) AS start, CAST(n + 3 AS INTEGER) AS "end", CASE WHEN p % 4 <> 0 THEN new_key END AS ref_id FROM keyed""",
)
def c15_merge_ref_spans(spark, sf_dir):
    spans = _entries(spark, sf_dir).select(
        "doc_id", "n", F.when(F.col("type") == "figure", "fig").otherwise("table").alias("kind"),
        F.col("n").cast("int").alias("start"), (F.col("n") + 3).cast("int").alias("end"), F.col("old_key").alias("ref_id"),
    )
    cite = spans.withColumn("kind", F.lit("cite"))
    return P.merge_ref_spans(spans.unionByName(cite), _dense(spark, sf_dir)).select("doc_id", "n", "kind", "start", "end", "ref_id")


@query("c16_dense_keys", _DENSE + " SELECT doc_id, type, old_key, new_key AS ref_id FROM keyed WHERE p % 4 <> 0")
def c16_dense_keys(spark, sf_dir):
    return _dense(spark, sf_dir).select("doc_id", "type", "old_key", "ref_id")


@query(
    "c17_containment",
    f"""WITH {CITES}, s AS (SELECT doc_id, n, 3 * n AS b, 3 * n + q % 7 + 1 AS e FROM cites), t AS (SELECT doc_id, 3 * n - 1 AS b, 3 * n - 1 + p % 9 AS e FROM cites)
    SELECT doc_id, n FROM s WHERE EXISTS (SELECT 1 FROM t WHERE t.doc_id = s.doc_id AND s.b >= t.b AND s.e <= t.e)""",
)
def c17_containment(spark, sf_dir):
    rows = cites(spark, sf_dir)
    start = F.col("n") * 3
    ours = rows.select("doc_id", "n", start.alias("start"), (start + F.col("q") % 7 + 1).alias("end"))
    theirs = rows.select("doc_id", (start - 1).alias("start"), (start - 1 + F.col("p") % 9).alias("end"))
    return P.inside_existing(ours, theirs, ["doc_id"]).select("doc_id", "n")


@query(
    "c18_span_violations",
    f"""WITH {CITES}, copies AS (SELECT * FROM cites UNION ALL SELECT * FROM cites WHERE p % 7 = 0)
    SELECT doc_id, n, CASE WHEN p % 5 = 0 THEN 'text_mismatch' ELSE 'duplicate_start' END AS reason FROM copies WHERE p % 5 = 0 OR p % 7 = 0""",
)
def c18_span_violations(spark, sf_dir):
    start = F.when(F.col("p") % 5 == 0, 6).otherwise(5)
    surface = text("[{n}]")
    rows = cites(spark, sf_dir).select(
        "doc_id", "n", "p", text("Uses [{n}] for {q}").alias("para_text"), start.alias("start"), (start + F.length(surface)).alias("end"), surface.alias("surface")
    )
    return P.span_violations(rows.unionByName(rows.where("p % 7 = 0")), ["doc_id", "n"]).select("doc_id", "n", "reason")


@query("c18_integrity_holds", f"WITH {CITES} SELECT count(*) AS spans, 0::BIGINT AS violations FROM cites")
def c18_integrity_holds(spark, sf_dir):
    # Every span a paragraph layout makes reads back its own surface.
    line = text('<p>A<ref type="bibr" target="#b{n}"> [{n}]</ref>  b <i>{q}</i></p>')
    tokens = tokens_of(papers_from(cites(spark, sf_dir), "<body>", line, "</body>"))
    paras = C.cited_paragraphs(C.keyed_units(C.paragraph_pieces(tokens), C.bibliography_keys(tokens)))
    spans = P.span_checks(C.span_rows(paras, "para_text").withColumnRenamed("text", "surface"), C.PARA)
    return spans.agg(F.count("*").alias("spans"), F.count("reason").alias("violations"))


@query("c19_bibliography_numbers", f"WITH {CITES} SELECT doc_id, concat('bid', p) AS bib_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY n) - 1 AS INTEGER) AS num FROM cites")
def c19_bibliography_numbers(spark, sf_dir):
    line = text('<p><bibitem id="bid{p}"/>Text {q}</p>')
    tokens = tokens_of(papers_from(cites(spark, sf_dir), "<bibliography>", line, "</bibliography>"))
    return P.number_in_order(P.bibitems(tokens)).select("doc_id", "bib_id", "num")
