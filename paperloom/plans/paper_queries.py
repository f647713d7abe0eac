"""Queries over whole papers: files, assembly, layouts, rendering (A, E)."""

from pyspark.sql import functions as F

from paperloom.operators import citations as C
from paperloom.operators import papers as P
from paperloom.operators import sections as S
from paperloom.operators.entities import tei_bibliography
from paperloom.plans.adapters import CITES, SENTENCES, cites, document_papers, papers_from, table, text, tokens_of
from paperloom.plans.registry import query
from paperloom.session import stored, work_path
from paperloom.sources import files as A
from paperloom.sources import sinks as K


@query(
    "a1_scan_files",
    """SELECT CAST(doc_id AS VARCHAR) AS doc_id, CASE doc_id % 4 WHEN 0 THEN 'pdf' WHEN 1 THEN 'gz' WHEN 2 THEN 'nxml' ELSE 'doc' END AS kind, sha1(text) AS sha1,
      CASE WHEN doc_id % 4 = 3 THEN 'unknown_type' END AS error FROM documents""",
)
def a1_scan_files(spark, sf_dir):
    ending = F.get(F.array(*[F.lit(x) for x in ("pdf", "gz", "NXML", "doc")]), (F.col("doc_id") % 4).cast("int"))
    docs = table(spark, sf_dir, "documents")
    rows = docs.select(F.concat(F.lit("/in/"), "source", F.lit("/"), "doc_id", F.lit("."), ending).alias("path"), F.encode("text", "UTF-8").alias("content"))
    return A.describe_files(rows).select("doc_id", "kind", "sha1", "error")


@query(
    "a1_scan_folder",
    """SELECT CAST(doc_id // 500 AS INTEGER) AS bucket, 'txt' AS kind, sha1(string_agg(text || chr(10), '' ORDER BY doc_id)) AS sha1, 'unknown_type' AS error FROM documents GROUP BY doc_id // 500
      UNION ALL SELECT CAST(doc_id // 500 AS INTEGER), 'gz', NULL, NULL FROM documents GROUP BY doc_id // 500""",
)
def a1_scan_folder(spark, sf_dir):
    """Files written to the shared folder, plain and compressed, found again with their types and the SHA-1 of their bytes."""
    folder = work_path(spark, "files")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.expr("cast(doc_id div 500 as int)").alias("bucket"))
    placed = docs.repartition("bucket").sortWithinPartitions("bucket", "doc_id").select("bucket", "text")
    for name, codec in (("plain", "none"), ("packed", "gzip")):
        placed.write.partitionBy("bucket").option("compression", codec).text(f"{folder}/{name}")
    found = A.scan_folder(spark, folder, "part-*").where(F.col("path").contains("bucket="))
    bucket = F.regexp_extract("path", r"bucket=(\d+)", 1).cast("int")
    return found.select(bucket.alias("bucket"), "kind", F.when(F.col("kind") == "txt", F.col("sha1")).alias("sha1"), "error")


@query(
    "a2_scan_records",
    """SELECT CAST(doc_id AS VARCHAR) AS doc_id, CASE WHEN doc_id % 11 = 0 THEN 'malformed' END AS reason, CASE WHEN doc_id % 11 <> 0 THEN md5(text) END AS digest FROM documents""",
)
def a2_scan_records(spark, sf_dir):
    """Files of many documents each, written and scanned record by record; broken records go to quarantine with their place."""
    folder = work_path(spark, "records")
    docs = table(spark, sf_dir, "documents")
    close = F.when(F.col("doc_id") % 11 == 0, "").otherwise("</p>")
    docs.select(F.concat(F.lit('<doc id="'), "doc_id", F.lit('"><p>'), F.hex(F.encode("text", "UTF-8")), close, F.lit("</doc>"))).write.text(folder)
    found = A.scan_xml_records(spark, folder, "doc")
    body = F.regexp_extract("xml", r"<p>([0-9A-F]*)</p>", 1)
    return found.select(
        F.regexp_extract("xml", r'id="(\d+)"', 1).alias("doc_id"), "reason", F.when(F.col("reason").isNull(), F.md5(F.unhex(body))).alias("digest")
    )


@query("a2_well_formed", f"WITH {CITES}, bad AS (SELECT doc_id, bool_or(p % 11 = 0) AS broken FROM cites GROUP BY doc_id) SELECT doc_id, NOT broken AS ok FROM bad")
def a2_well_formed(spark, sf_dir):
    line = text("<p>T{p}", F.when(F.col("p") % 11 == 0, "").otherwise("</p>"))
    docs = papers_from(cites(spark, sf_dir), "<body>", line, "</body>")
    return docs.select("doc_id", A.well_formed(F.col("xml")).alias("ok"))


def _layout_json(spark, sf_dir):
    """Papers written out in three layouts, an unknown one and a broken one."""
    p = document_papers(spark, sf_dir)
    drop = lambda k: F.transform(k, lambda x: x.dropFields("sentences")).alias(k)
    parts = [drop(k) for k in P.PARTS]
    old = F.to_json(F.struct(F.col("doc_id").alias("paper_id"), F.col("pdf_hash").alias("s2_pdf_hash"), "metadata", F.struct(*parts).alias("grobid_parse")))
    mid = F.to_json(F.struct(F.col("doc_id").alias("paper_id"), F.col("pdf_hash").alias("_pdf_hash"), F.struct(*parts).alias("pdf_parse")))
    flat = F.to_json(F.struct(F.col("doc_id").alias("paper_id"), "metadata", *parts))
    other = F.to_json(F.struct(F.col("doc_id").alias("paper_id"), F.struct(F.lit(1).alias("x")).alias("other")))
    k = F.col("doc_id").cast("long") % 5
    json = F.when(k == 0, old).when(k == 1, mid).when(k == 2, flat).when(k == 3, other).otherwise(F.concat(F.lit('{"paper_id": '), "doc_id", F.lit(', "body')))
    return p.select("doc_id", json.alias("json"))


_LINES = "(len(string_split(text, chr(10))) - 1)"


@query(
    "a3_scan_papers",
    f"""SELECT CAST(doc_id AS VARCHAR) AS doc_id, doc_id % 5 = 4 AS corrupt, CASE WHEN doc_id % 5 <> 4 THEN CAST(doc_id AS VARCHAR) END AS paper_id,
      CASE WHEN doc_id % 5 = 2 THEN CAST({_LINES} AS INTEGER) END AS body FROM documents""",
)
def a3_scan_papers(spark, sf_dir):
    folder = work_path(spark, "json")
    _layout_json(spark, sf_dir).select("json").write.text(folder)
    rows = A.scan_papers(spark, folder)
    corrupt = F.col("_corrupt_record").isNotNull()
    own = F.coalesce("paper_id", F.regexp_extract("_corrupt_record", r'"paper_id": (\d+)', 1))
    return rows.select(own.alias("doc_id"), corrupt.alias("corrupt"), F.when(~corrupt, F.col("paper_id")).alias("paper_id"), F.when(F.col("body_text").isNotNull(), F.size("body_text")).alias("body"))


@query("a4_decode", "SELECT doc_id, md5(regexp_replace(text, '[^\\x00-\\xFF]', '?', 'g')) AS digest, length(text) AS chars FROM documents")
def a4_decode(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("text", F.regexp_replace("text", r"[^\x00-\xFF]", "?"))
    content = F.when(F.col("doc_id") % 2 == 0, F.encode("text", "UTF-8")).otherwise(F.encode("text", "ISO-8859-1"))
    out = A.decode_text(content)
    return docs.select("doc_id", F.md5(F.encode(out, "UTF-8")).alias("digest"), F.length(out).cast("long").alias("chars"))


@query("a5_json_sink", f"SELECT CAST(doc_id AS VARCHAR) AS doc_id, string_split(text, chr(10))[1] AS title, CAST({_LINES} AS INTEGER) AS paragraphs FROM documents")
def a5_json_sink(spark, sf_dir):
    path = work_path(spark, "json-sink")
    K.write_json(document_papers(spark, sf_dir).select("doc_id", "title", "body_text"), path)
    back = spark.read.schema("doc_id string, title string, body_text array<struct<section:string>>").json(path)
    return back.select("doc_id", "title", F.size("body_text").alias("paragraphs"))


_SENTENCE_ROWS = f"""WITH {SENTENCES}
    SELECT CAST(doc_id AS VARCHAR) AS file, 0::INTEGER AS part, 0::INTEGER AS para_no, 0::INTEGER AS sent_no, 'title' AS section, string_split(text, chr(10))[1] AS sentence, '1' AS coordinates FROM documents
    UNION ALL
    SELECT CAST(doc_id AS VARCHAR), 2::INTEGER, CAST(para_no - 1 AS INTEGER), CAST(row_number() OVER (PARTITION BY doc_id, para_no ORDER BY sent_no) - 1 AS INTEGER), concat('Part ', (para_no - 1) % 3), sentence,
      concat(row_number() OVER (PARTITION BY doc_id, para_no ORDER BY sent_no), ',0,0,1,1') FROM sentences WHERE para_no > 0"""


@query("a6_csv_sink", f"SELECT file, section, nullif(sentence, '') AS sentence, coordinates FROM ({_SENTENCE_ROWS})")
def a6_csv_sink(spark, sf_dir):
    path = work_path(spark, "csv-sink")
    K.write_csv(P.flatten_sentences(document_papers(spark, sf_dir)), path)
    return K.read_csv(spark, path)


@query("e6_flatten_sentences", _SENTENCE_ROWS)
def e6_flatten_sentences(spark, sf_dir):
    return P.flatten_sentences(document_papers(spark, sf_dir))


def _turns(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("ord"), F.col("role").alias("section"), "text")
    titles = rows.select("doc_id").distinct().withColumn("title", text("Conversation {doc_id}"))
    return titles, rows


_READING = """WITH heads AS (SELECT conv_id, role, min(turn) AS turn FROM conversations WHERE text <> '' GROUP BY 1, 2)
    SELECT DISTINCT conv_id AS doc_id, 0::BIGINT AS line_no, concat('Conversation ', conv_id) AS line FROM conversations
    UNION ALL SELECT conv_id, CAST(turn * 2 + 1 AS BIGINT), role FROM heads
    UNION ALL SELECT conv_id, CAST(turn * 2 + 2 AS BIGINT), text FROM conversations WHERE text <> ''"""


@query("e8_reading_order", _READING)
def e8_reading_order(spark, sf_dir):
    return P.reading_order(*_turns(spark, sf_dir))


@query("a7_text_sink", f"SELECT regexp_replace(line, '[\\r\\n]+', ' ', 'g') AS line FROM ({_READING})")
def a7_text_sink(spark, sf_dir):
    path = work_path(spark, "text-sink")
    K.write_text(P.reading_order(*_turns(spark, sf_dir)), path)
    return spark.read.text(path).withColumnRenamed("value", "line")


@query("a8_resume", "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)")
def a8_resume(spark, sf_dir):
    return A.not_done(table(spark, sf_dir, "documents").select("doc_id", "source"), table(spark, sf_dir, "labels"), ["doc_id"])


_FAILED = "CASE WHEN doc_id % 4 = 3 THEN 'unknown_type' WHEN n_chars < 100 THEN 'too_short' WHEN text NOT LIKE concat('%', chr(10), '%') THEN 'no_body' END"


@query("a9_failures", f"SELECT doc_id, {_FAILED} AS reason FROM documents WHERE {_FAILED} IS NOT NULL")
def a9_failures(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    checks = {"unknown_type": F.col("doc_id") % 4 != 3, "too_short": F.col("n_chars") >= 100, "no_body": F.col("text").contains("\n")}
    _, failed = A.split_failures(docs, checks)
    path = work_path(spark, "failures")
    K.append_failures(failed, path)
    return spark.read.schema("doc_id long, reason string").parquet(path)


@query(
    "a11_manifest",
    """SELECT doc_id, concat('{"extracted_files":{"input":{"file_id":"i', doc_id, '","filename":"', doc_id, '.pdf","description":"Input file"},"xml":{',
      CASE WHEN doc_id % 3 <> 0 THEN concat('"file_id":"x', doc_id, '","filename":"', doc_id, '.xml",') ELSE '' END, '"description":"Markup"}},"page_dimensions":{"width":', 600 + doc_id % 7, '.0,"height":800.0}}') AS manifest FROM documents""",
)
def a11_manifest(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id")
    inputs = docs.select("doc_id", text("i{doc_id}").alias("file_id"), text("{doc_id}.pdf").alias("filename"))
    xml = docs.where("doc_id % 3 <> 0").select("doc_id", text("x{doc_id}").alias("file_id"), text("{doc_id}.xml").alias("filename"))
    pages = docs.select("doc_id", (F.lit(600) + F.col("doc_id") % 7).cast("double").alias("width"), F.lit(800.0).alias("height"))
    return K.manifest(inputs, {"xml": (xml, "Markup")}, pages)


@query(
    "e1_assemble",
    f"""WITH {CITES}
    SELECT doc_id, concat('Order ', doc_id) AS title, CAST(count(*) AS INTEGER) AS paragraphs, string_agg(concat('Uses [', n, '] .'), '|' ORDER BY n) AS body,
      string_agg(CASE WHEN p % 4 <> 0 THEN concat(5, '-', 5 + length(concat('[', n, ']')), '-BIBREF', n) ELSE concat(5, '-', 5 + length(concat('[', n, ']')), '-none') END, '|' ORDER BY n) AS cites,
      coalesce(string_agg(concat('BIBREF', n, '=T', p), '|' ORDER BY n) FILTER (p % 4 <> 0), '') AS bibs FROM cites GROUP BY doc_id""",
)
def e1_assemble(spark, sf_dir):
    line = text('<p>Uses <ref type="bibr" target="#b{n}">[{n}]</ref>.</p>')
    bib = F.when(F.col("p") % 4 != 0, text('<biblStruct xml:id="b{n}"><title>T{p}</title></biblStruct>')).otherwise("")
    docs = papers_from(cites(spark, sf_dir), "<TEI><body>", line, "</body><back><listBibl>", bib, "</listBibl></back></TEI>")
    tokens = tokens_of(docs)
    # The entries are asked for twice, by the citations and by the papers.
    bibs = stored(tei_bibliography(tokens).select("doc_id", C.tei_key(F.col("bib_id")).alias("key"), "pos", "title", "year", "venue"), "bibs")
    laid = C.cited_paragraphs(C.keyed_units(C.paragraph_pieces(tokens), bibs)).withColumnRenamed("para_pos", "pos")
    numbered = S.number_paragraphs(laid).withColumn("part", F.lit("body_text"))
    # Spans stay with their paragraph, so nothing has to be joined again.
    only = lambda k: F.transform(F.filter("spans", lambda s: s["kind"] == k), lambda s: s.dropFields("kind"))
    paras = numbered.select(
        "doc_id", "part", "para_no", F.lit("Body").alias("section"), F.lit(None).cast("string").alias("sec_num"), "para_text", only("cite").alias("cite_spans"), only("ref").alias("ref_spans")
    )
    meta = docs.select("doc_id", text("Order {doc_id}").alias("title"))
    papers = P.assemble(meta, paras, bibs=bibs)
    cite = lambda p: F.array_join(F.transform(p["cite_spans"], lambda s: F.concat_ws("-", s["start"], s["end"], F.coalesce(s["ref_id"], F.lit("none")))), "|")
    entries = F.transform(F.map_entries("bib_entries"), lambda e: F.concat(e["key"], F.lit("="), e["value"]["title"]))
    return papers.select(
        "doc_id", "title", F.size("body_text").alias("paragraphs"), F.array_join(F.transform("body_text", lambda p: p["para_text"]), "|").alias("body"),
        F.array_join(F.transform("body_text", cite), "|").alias("cites"), F.coalesce(F.array_join(entries, "|"), F.lit("")).alias("bibs"),
    )


@query(
    "e2_entry_projection",
    f"""WITH {CITES} SELECT doc_id, n, CASE p % 6
      WHEN 0 THEN concat('{{"text":"T', p, '","type_str":"figure","uris":["u', q, '"],"num":"', n, '","fig_num":null}}')
      WHEN 1 THEN concat('{{"text":"T', p, '","type_str":"table","content":"C","num":"', n, '","html":null}}')
      WHEN 2 THEN concat('{{"text":"T', p, '","type_str":"footnote","num":"', n, '"}}')
      WHEN 3 THEN concat('{{"text":"T', p, '","type_str":"section","num":"', n, '","parent":"S', q, '"}}')
      WHEN 4 THEN concat('{{"text":"T', p, '","type_str":"equation","latex":"x","mathml":null,"num":"', n, '"}}')
      ELSE concat('{{"text":"T', p, '","type":"other","latex":"x","mathml":null,"content":"C","html":null,"uris":["u', q, '"],"num":"', n, '","parent":"S', q, '","fig_num":null}}') END AS json FROM cites""",
)
def e2_entry_projection(spark, sf_dir):
    kinds = F.array(*[F.lit(k) for k in ("figure", "table", "footnote", "section", "equation", "other")])
    none = F.lit(None).cast("string")
    entry = F.struct(
        text("T{p}").alias("text"), F.get(kinds, (F.col("p") % 6).cast("int")).alias("type"), F.lit("x").alias("latex"), none.alias("mathml"), F.lit("C").alias("content"),
        none.alias("html"), F.array(text("u{q}")).alias("uris"), text("{n}").alias("num"), text("S{q}").alias("parent"), none.alias("fig_num"),
    )
    rows = cites(spark, sf_dir).withColumn("e", entry)
    return rows.select("doc_id", "n", P.entry_json(F.col("e")).alias("json"))


@query(
    "e3_renames",
    f"""WITH {CITES} SELECT doc_id, n, CASE WHEN p % 2 = 0 THEN concat('I', q) ELSE concat('S', n) END AS issue, CASE WHEN p % 3 = 0 THEN concat('L', p) WHEN p % 3 = 1 THEN concat('a', n, '|b') END AS links FROM cites""",
)
def e3_renames(spark, sf_dir):
    entry = F.struct(
        F.when(F.col("p") % 2 == 0, text("I{q}")).alias("issue"), text("S{n}").alias("issn"),
        F.when(F.col("p") % 3 == 1, F.array(text("a{n}"), F.lit("b"))).alias("links"), F.when(F.col("p") % 3 == 0, text("L{p}")).alias("link"),
    )
    rows = cites(spark, sf_dir).withColumn("e", entry).withColumn("e", P.tidy_bib(F.col("e")))
    return rows.select("doc_id", "n", "e.issue", F.array_join("e.links", "|").alias("links"))


@query(
    "e4_release",
    f"""WITH {SENTENCES}, bodies AS (SELECT doc_id, arg_min(sentence, (para_no, sent_no)) FILTER (para_no = 1) AS first FROM sentences GROUP BY doc_id)
    SELECT CAST(d.doc_id AS VARCHAR) AS doc_id, 'Paperloom 1.0' AS generated_with, '2020-01-01T00:00:00.000000Z' AS date_generated, d.lang AS lang, d.source AS venue, chr(10) AS abstract,
      sha1(d.text) AS pdf_hash, CAST({_LINES} AS INTEGER) AS paragraphs, b.first AS first FROM documents d LEFT JOIN bodies b USING (doc_id)""",
)
def e4_release(spark, sf_dir):
    out = P.release(document_papers(spark, sf_dir), "Paperloom", "1.0", "2020-01-01T00:00:00.000000Z")
    at = lambda path: F.get_json_object("json", path)
    return out.select(
        "doc_id", at("$.header.generated_with").alias("generated_with"), at("$.header.date_generated").alias("date_generated"), at("$.identifiers.lang").alias("lang"),
        at("$.venue").alias("venue"), at("$.abstract").alias("abstract"), at("$.pdf_parse._pdf_hash").alias("pdf_hash"),
        F.json_array_length(at("$.pdf_parse.body_text")).alias("paragraphs"), at("$.pdf_parse.body_text[0].text[0].sentence").alias("first"),
    )


@query(
    "e5_unify_layouts",
    f"""SELECT CAST(doc_id AS VARCHAR) AS doc_id, CASE doc_id % 5 WHEN 0 THEN '2019' WHEN 1 THEN '2020' WHEN 2 THEN 'flat' END AS layout, CASE WHEN doc_id % 5 IN (0, 1) THEN sha1(text) END AS pdf_hash,
      CASE WHEN doc_id % 5 IN (0, 2) THEN source END AS venue, CASE WHEN doc_id % 5 < 3 THEN CAST({_LINES} AS INTEGER) ELSE 0::INTEGER END AS paragraphs,
      CASE doc_id % 5 WHEN 3 THEN 'unknown_layout' WHEN 4 THEN 'malformed_json' END AS reason FROM documents WHERE NOT (doc_id % 5 = 2 AND {_LINES} = 0)
    UNION ALL SELECT CAST(doc_id AS VARCHAR), NULL, NULL, source, 0::INTEGER, 'unknown_layout' FROM documents WHERE doc_id % 5 = 2 AND {_LINES} = 0""",
)
def e5_unify_layouts(spark, sf_dir):
    out = P.unify_layouts(P.parse_json(_layout_json(spark, sf_dir)))
    return out.select("doc_id", "layout", "pdf_hash", F.col("metadata.venue").alias("venue"), F.size("body_text").alias("paragraphs"), "reason")


@query(
    "e7_mixed_elements",
    """SELECT doc_id, 0::INTEGER AS item, 'S' || n_chars AS sentence, '1,2' AS coords FROM documents WHERE doc_id % 4 = 0
    UNION ALL SELECT doc_id, 1::INTEGER, 'plain ' || doc_id, '' FROM documents WHERE doc_id % 4 = 0
    UNION ALL SELECT doc_id, 2::INTEGER, '', '' FROM documents WHERE doc_id % 4 = 0
    UNION ALL SELECT doc_id, 0::INTEGER, 'EQUATION', '' FROM documents WHERE doc_id % 4 = 1
    UNION ALL SELECT doc_id, 0::INTEGER, 'no "json" ' || doc_id, '' FROM documents WHERE doc_id % 4 = 2""",
)
def e7_mixed_elements(spark, sf_dir):
    forms = F.array(
        text(F.lit('[{"sentence":"S'), "{n_chars}", F.lit('","coords":"1,2"},"plain '), "{doc_id}", F.lit('",5,{"other":1}]')),
        F.lit('"EQUATION"'), text('no "json" {doc_id}'), F.lit("[]"),
    )
    docs = table(spark, sf_dir, "documents").select("doc_id", F.get(forms, (F.col("doc_id") % 4).cast("int")).alias("raw"))
    return docs.select("doc_id", F.posexplode(P.text_elements(F.col("raw"))).alias("item", "s")).select("doc_id", "item", "s.sentence", "s.coords")


@query(
    "e9_raw_text",
    f"""WITH {SENTENCES}, paras AS (SELECT p.doc_id, p.para_no, coalesce(string_agg(s.sentence, ' ' ORDER BY s.sent_no), '') AS t FROM paragraphs p LEFT JOIN sentences s ON p.doc_id = s.doc_id AND p.para_no = s.para_no WHERE p.para_no > 0 GROUP BY 1, 2)
    SELECT CAST(d.doc_id AS VARCHAR) AS doc_id, concat(coalesce((SELECT string_agg(t, chr(10) ORDER BY para_no) FROM paras WHERE paras.doc_id = d.doc_id), ''), chr(10)) AS body FROM documents d""",
)
def e9_raw_text(spark, sf_dir):
    return document_papers(spark, sf_dir).select("doc_id", P.raw_text(F.col("body_text")).alias("body"))


@query(
    "e10_key_lookup",
    """WITH e AS (SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
    SELECT event_id, CAST(k AS VARCHAR) AS value FROM e WHERE event_id % 3 <> 2 AND k IS NOT NULL UNION ALL SELECT event_id, CAST(k + 1 AS VARCHAR) FROM e WHERE event_id % 3 = 1 AND k IS NOT NULL""",
)
def e10_key_lookup(spark, sf_dir):
    n = F.get_json_object("props", "$.k").cast("long")
    many = F.concat(F.lit("["), "props", F.lit(',{"x":1},{"k":'), n + 1, F.lit("}]"))
    nested = F.concat(F.lit('{"a":'), "props", F.lit("}"))
    k = F.col("event_id") % 3
    rows = table(spark, sf_dir, "events").select("event_id", F.when(k == 0, F.col("props")).when(k == 1, many).otherwise(nested).alias("json"))
    return P.lookup(rows, "json", "k").select("event_id", "value")


@query(
    "e11_section_strings",
    f"""WITH {CITES} SELECT doc_id, n, concat('A', p, CASE WHEN p % 2 = 0 THEN concat('::B', q) ELSE '' END) AS section, CAST(n AS VARCHAR) AS sec_num, CASE WHEN p % 2 = 0 THEN 2::INTEGER ELSE 1::INTEGER END AS depth FROM cites""",
)
def e11_section_strings(spark, sf_dir):
    section = F.when(F.col("p") % 2 == 0, text("A{p}::B{q}")).otherwise(text("A{p}"))
    rows = cites(spark, sf_dir).withColumn("path", P.section_list(section, text("{n}")))
    return rows.select("doc_id", "n", P.section_string(F.col("path")).alias("section"), F.element_at("path", -1)["num"].alias("sec_num"), F.size("path").alias("depth"))


@query("e12_round_trip", "SELECT count(*) AS papers, 0::BIGINT AS differences FROM documents WHERE doc_id % 5 < 3")
def e12_round_trip(spark, sf_dir):
    good = P.with_sentences(P.unify_layouts(P.parse_json(_layout_json(spark, sf_dir))).where("doc_id % 5 < 3"))
    once = P.release(good, "Paperloom", "1.0", "first")
    again = P.release(P.with_sentences(P.unify_layouts(P.parse_json(once))), "Paperloom", "1.0", "second")
    plain = lambda df, when: df.select("doc_id", F.replace("json", F.lit(when), F.lit("")).alias("json"))
    diff = P.differences(plain(once, '"first"'), plain(again, '"second"'))
    both = once.select(F.lit(1).alias("papers"), F.lit(0).alias("differences")).unionByName(diff.select(F.lit(0).alias("papers"), F.lit(1).alias("differences")))
    return both.agg(F.sum("papers").alias("papers"), F.sum("differences").alias("differences"))
