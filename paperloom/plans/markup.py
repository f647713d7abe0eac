"""Queries over markup: tokens, sections, paragraphs and sentences."""

from pyspark.sql import functions as F

from paperloom.functions.text import attr, collapse_ws, ordered_concat, soften_ws, tidy
from paperloom.operators import sections as S
from paperloom.operators import tokens as T
from paperloom.operators.spans import placeholder_spans
from paperloom.plans.adapters import CITES, PAGE_TOKENS, SENTENCES, cites, pages, paragraphs, papers_from, sentences, text, tokens_of
from paperloom.plans.registry import query

# Tags that are balanced in web pages and so may carry depth.
PAGE_NESTING = ["head", "title", "nav", "ul", "li", "a", "div", "article", "h1", "footer"]
_IN = "('" + "','".join(PAGE_NESTING) + "')"
_NUMBERED = CITES + ", numbered AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n) - 1 AS i FROM cites)"


@query(
    "b1_tokens",
    f"""WITH {PAGE_TOKENS},
    steps AS (SELECT *, CASE WHEN tag IN {_IN} AND kind = 'open' THEN 1 WHEN tag IN {_IN} AND kind = 'close' THEN -1 ELSE 0 END AS step FROM tokens)
    SELECT doc_id, pos, kind, tag, text,
      CAST(sum(step) OVER (PARTITION BY doc_id ORDER BY pos) + CASE WHEN step = 1 THEN 0 ELSE 1 END AS INTEGER) AS depth FROM steps""",
)
def b1_tokens(spark, sf_dir):
    tokens = T.tokenise(pages(spark, sf_dir), nesting=PAGE_NESTING)
    return tokens.select("doc_id", "pos", "kind", "tag", "text", "depth")


@query("b2_unwrap", f"WITH {PAGE_TOKENS} SELECT doc_id, pos, tok FROM tokens WHERE tag IS NULL OR tag NOT IN ('b', 'a')")
def b2_unwrap(spark, sf_dir):
    return T.unwrap(T.raw_tokens(pages(spark, sf_dir)), ["b", "a"]).select("doc_id", "pos", "tok")


@query(
    "b2_unwrap_padded",
    f"""WITH {_NUMBERED} SELECT doc_id, CAST(i AS INTEGER) AS para_no,
      concat('See', ' Part ', p, ' ', 'now ', n, '.') AS para_text FROM numbered""",
)
def b2_unwrap_padded(spark, sf_dir):
    line = text('<p>See<hi rend="it"> Part <bold>{p}</bold></hi>now <italic>{n}</italic>.</p>')
    tokens = tokens_of(papers_from(cites(spark, sf_dir), "<body>", line, "</body>"))
    flat = T.unwrap(tokens, ["hi", "bold", "italic", "graphic"], pad=["hi"])
    return S.number_paragraphs(S.paragraph_rows(flat, formula=None)).select("doc_id", "para_no", "para_text")


@query(
    "b3_drop_subtrees",
    f"""WITH {PAGE_TOKENS},
    steps AS (SELECT *, sum(CASE WHEN tag IN ('nav','footer') AND kind = 'open' THEN 1 WHEN tag IN ('nav','footer') AND kind = 'close' THEN -1 ELSE 0 END)
      OVER (PARTITION BY doc_id ORDER BY pos) AS depth FROM tokens)
    SELECT doc_id, pos, tok FROM steps WHERE depth = 0 AND NOT coalesce(tag IN ('nav','footer'), false)""",
)
def b3_drop_subtrees(spark, sf_dir):
    return T.drop_subtrees(T.raw_tokens(pages(spark, sf_dir)), ["nav", "footer"]).select("doc_id", "pos", "tok")


@query(
    "b3_drop_supplements",
    f"WITH {CITES} SELECT doc_id, concat('Kept ', n, ' of ', p) AS para_text FROM cites WHERE p % 3 <> 0",
)
def b3_drop_supplements(spark, sf_dir):
    kind = F.when(F.col("p") % 3 == 0, ' sec-type="supplementary-material"').otherwise("")
    line = text("<sec", kind, "><p>Kept {n} of {p}</p><sec></sec></sec>")
    tokens = tokens_of(papers_from(cites(spark, sf_dir), "<body>", line, "</body>"))
    left = T.drop_subtrees(tokens, ["sec"], attr(F.col("tok"), "sec-type") == "supplementary-material")
    return S.paragraph_rows(left, formula=None).select("doc_id", "para_text")


@query(
    "b4_trim_before_title",
    f"""WITH {PAGE_TOKENS}, first AS (SELECT doc_id, min(pos) AS cut FROM tokens WHERE tag = 'h1' AND kind = 'open' GROUP BY doc_id)
    SELECT t.doc_id, t.pos, t.tok FROM tokens t LEFT JOIN first f USING (doc_id) WHERE f.cut IS NULL OR t.pos >= f.cut""",
)
def b4_trim_before_title(spark, sf_dir):
    return T.trim_before(T.raw_tokens(pages(spark, sf_dir)), ["h1"]).select("doc_id", "pos", "tok")


@query(
    "b4_trim_leading_block",
    f"""WITH {CITES}, firsts AS (SELECT doc_id, min(CASE WHEN p % 2 = 0 THEN n END) AS cut FROM cites GROUP BY doc_id)
    SELECT doc_id, concat('Item ', n) AS para_text FROM cites JOIN firsts USING (doc_id) WHERE cut IS NULL OR n >= cut
    UNION ALL SELECT DISTINCT doc_id, 'Later' FROM cites""",
)
def b4_trim_leading_block(spark, sf_dir):
    title = F.when(F.col("p") % 2 == 0, "<maketitle/>").otherwise("")
    line = text(title, "<p>Item {n}</p>")
    docs = papers_from(cites(spark, sf_dir), "<body><std>", line, "</std><std><p>Later</p><title>x</title></std></body>")
    kept = T.trim_before(tokens_of(docs), ["maketitle", "title"], block=["std"])
    return S.paragraph_rows(kept, formula=None).select("doc_id", "para_text")


@query(
    "b5_rename_tags",
    f"""WITH {PAGE_TOKENS}
    SELECT doc_id, pos, CASE tag WHEN 'ul' THEN 'list' WHEN 'li' THEN 'item' ELSE tag END AS tag,
      regexp_replace(CASE tag WHEN 'ul' THEN regexp_replace(tok, '^(</?)ul', '\\1list') WHEN 'li' THEN regexp_replace(tok, '^(</?)li', '\\1item') ELSE tok END,
        '^(<.*\\s)href=', '\\1target=') AS tok
    FROM tokens""",
)
def b5_rename_tags(spark, sf_dir):
    renamed = T.rename_tags(T.raw_tokens(pages(spark, sf_dir)), {"ul": "list", "li": "item"}, {"href": "target"})
    return renamed.select("doc_id", "pos", "tag", "tok")


@query(
    "b5_table_markup",
    f"""WITH {CITES} SELECT doc_id, concat('<table>', string_agg(concat('<tr><td>', p, '</td><td colspan="2">', q, '</td><td/></tr>'), '' ORDER BY n), '</table>') AS content
    FROM cites GROUP BY doc_id""",
)
def b5_table_markup(spark, sf_dir):
    line = text('<row><cell>{p}</cell><cell cols="2">{q}</cell><cell/></row>')
    tokens = tokens_of(papers_from(cites(spark, sf_dir), '<figure type="table"><table>', line, "</table></figure>"))
    renamed = T.rename_tags(tokens, {"row": "tr", "cell": "td"}, {"cols": "colspan"})
    inside = T.within(renamed, _t="table").where("_t is not null")
    return T.serialise(inside, ["doc_id", "_t"]).select("doc_id", F.col("markup").alias("content"))


@query(
    "b6_sections_by_heading",
    f"""WITH {_NUMBERED},
    paras AS (
      SELECT doc_id, 3 * i AS para_no, CASE WHEN p % 5 = 0 THEN '' ELSE concat('Sec ', n) END AS section,
             CASE WHEN p % 5 <> 0 THEN CAST(n AS VARCHAR) END AS sec_num, concat('Top ', p, '.') AS para_text FROM numbered
      UNION ALL
      SELECT doc_id, 3 * i + 1, CASE WHEN p % 5 = 0 THEN concat('Sub ', q) ELSE concat('Sec ', n, '::Sub ', q) END, concat(n, '.1'), concat('Deep ', p, '.') FROM numbered
      UNION ALL
      SELECT doc_id, 3 * i + 2, CASE WHEN p % 5 = 0 THEN '' ELSE concat('Sec ', n) END, CASE WHEN p % 5 <> 0 THEN CAST(n AS VARCHAR) END, concat('Tail ', p, '.') FROM numbered)
    SELECT doc_id, CAST(para_no AS INTEGER) AS para_no, section, sec_num, para_text FROM paras""",
)
def b6_sections_by_heading(spark, sf_dir):
    head = F.when(F.col("p") % 5 != 0, text('<head n="{n}">Sec {n}</head>')).otherwise("")
    line = text("<div>", head, '<p>Top {p}.</p><div><head n="{n}.1">Sub {q}</head><p>Deep {p}.</p></div><p>Tail {p}.</p></div>')
    tokens = tokens_of(papers_from(cites(spark, sf_dir), "<TEI><text><body>", line, "</body></text></TEI>"))
    placed = S.sectioned_paragraphs(tokens, ["div"])
    return S.number_paragraphs(placed).select("doc_id", "para_no", "section", "sec_num", "para_text")


@query(
    "b7_sections_nested",
    f"""WITH {CITES}
    SELECT doc_id, concat('Sec ', n) AS section, concat('Intro ', p, '.') AS para_text FROM cites WHERE n > 1
    UNION ALL SELECT doc_id, concat('Sec ', n, '::Sub ', q), concat('Part ', p, '.') FROM cites WHERE n > 1
    UNION ALL SELECT doc_id, '', concat('Bare ', p, '.') FROM cites WHERE n = 1""",
)
def b7_sections_nested(spark, sf_dir):
    whole = text("<sec><title>Sec {n}</title><p>Intro {p}.</p><sec><title>Sub &amp;!start&amp;{q}&amp;!end&amp;</title><p>Part {p}.</p></sec></sec>")
    line = F.when(F.col("n") == 1, text("<p>Bare {p}.</p>")).otherwise(whole)
    tokens = tokens_of(papers_from(cites(spark, sf_dir), "<article><body>", line, "</body></article>"))
    return S.sectioned_paragraphs(tokens, ["sec"], head="title", head_num=None).select("doc_id", "section", "para_text")


@query(
    "b8_sections_by_id",
    f"""WITH {CITES}
    SELECT doc_id, concat('SECREF', n) AS sec_id, concat('Sec ', n) AS section, CAST(n AS VARCHAR) AS sec_num, concat('In ', p) AS para_text FROM cites
    UNION ALL SELECT doc_id, concat('SECREFU', n), concat('Sec ', n, '::Sub ', q), concat(n, '.1'), concat('Under ', p) FROM cites
    UNION ALL SELECT doc_id, concat('SECREF', n), concat('Sec ', n), CAST(n AS VARCHAR), concat('After ', p) FROM cites""",
)
def b8_sections_by_id(spark, sf_dir):
    line = text(
        '<div0 id="cid{n}" id-text="{n}"><head>Sec {n}</head><p>In {p}</p>'
        '<div1 id="uid{n}" id-text="{n}.1"><head>Sub {q}</head><p>Under {p}</p></div1></div0><p>After {p}</p>'
    )
    tokens = tokens_of(papers_from(cites(spark, sf_dir), "<body>", line, "</body>"))
    own = attr(F.col("tok"), "id")
    sec_id = F.regexp_replace(F.regexp_replace(own, "cid", "SECREF"), "uid", "SECREFU")
    number = attr(F.col("tok"), "id-text")
    paras = S.sectioned_paragraphs(tokens, ["div0", "div1"], num=number, head_num=None, sec_id=sec_id, carry=True)
    return paras.select("doc_id", "sec_id", "section", "sec_num", "para_text")


@query(
    "b9_paragraph_split",
    f"""WITH {_NUMBERED}
    SELECT doc_id, CAST(2 * i AS INTEGER) AS para_no, concat('Line ', n, ' has ', p) AS para_text, CAST(NULL AS VARCHAR) AS raw_str, CAST(NULL AS VARCHAR) AS eq_num FROM numbered
    UNION ALL SELECT doc_id, CAST(2 * i + 1 AS INTEGER), 'EQUATION', concat('y = ', p), concat('(', n, ')') FROM numbered""",
)
def b9_paragraph_split(spark, sf_dir):
    line = text('<p>Line  {n}\nhas <b>{p}</b></p><p> </p><formula xml:id="formula_{n}">y = {p}<label>({n})</label></formula>')
    tokens = tokens_of(papers_from(cites(spark, sf_dir), "<body><div>", line, "</div></body>"))
    paras = S.number_paragraphs(S.paragraph_rows(tokens))
    return paras.select("doc_id", "para_no", "para_text", "raw_str", "eq_num")


@query(
    "b10_sentence_split",
    f"""WITH {_NUMBERED}
    SELECT doc_id, CAST(2 * i AS INTEGER) AS para_no, 0::INTEGER AS sent_no, concat('One ', n, '.') AS sentence, concat(n, ',1,2,3,4') AS coords FROM numbered
    UNION ALL SELECT doc_id, CAST(2 * i AS INTEGER), 1::INTEGER, concat('Two ', p, '.'), CAST(NULL AS VARCHAR) FROM numbered
    UNION ALL SELECT doc_id, CAST(2 * i + 1 AS INTEGER), 0::INTEGER, concat('Whole ', q, '.'), CAST(NULL AS VARCHAR) FROM numbered""",
)
def b10_sentence_split(spark, sf_dir):
    line = text('<p><s coords="{n},1,2,3,4">One \n {n}.</s> <s>Two <i>{p}</i>.</s></p><p>Whole {q}.</p>')
    tokens = tokens_of(papers_from(cites(spark, sf_dir), "<body>", line, "</body>"))
    return S.sentence_rows(tokens).select("doc_id", "para_no", "sent_no", "sentence", "coords")


@query(
    "b10_document_sentences",
    f"WITH {SENTENCES} SELECT doc_id, para_no, sent_no, sentence FROM sentences",
)
def b10_document_sentences(spark, sf_dir):
    return sentences(spark, sf_dir).select("doc_id", "para_no", "sent_no", "sentence")


@query(
    "b11_whitespace",
    r"""WITH paragraphs AS (SELECT doc_id, unnest(l) AS para_text, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS para_no
      FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))
    SELECT doc_id, para_no, regexp_replace(para_text, '\s+', ' ', 'g') AS collapsed,
      replace(regexp_replace(para_text, '[\r\f ]', ' ', 'g'), '  ', ' ') AS softened FROM paragraphs""",
)
def b11_whitespace(spark, sf_dir):
    rows = paragraphs(spark, sf_dir)
    return rows.select("doc_id", "para_no", collapse_ws(F.col("para_text")).alias("collapsed"), soften_ws(F.col("para_text")).alias("softened"))


@query(
    "b12_abstract",
    f"""WITH {CITES}, kinds AS (SELECT *, min(p) OVER (PARTITION BY doc_id) % 4 AS k, row_number() OVER (PARTITION BY doc_id ORDER BY n) - 1 AS i FROM cites)
    SELECT doc_id, CAST(i AS INTEGER) AS para_no, 'Abstract' AS section, concat('Para ', p) AS para_text FROM kinds WHERE k IN (0, 1, 2)
    UNION ALL SELECT doc_id, 0::INTEGER, 'Abstract', string_agg(concat('Para ', p), '' ORDER BY n) FROM kinds WHERE k = 3 GROUP BY doc_id""",
)
def b12_abstract(spark, sf_dir):
    # Four shapes of abstract, one per document: paragraphs in divisions, bare
    # divisions, bare paragraphs, bare text.
    rows = cites(spark, sf_dir)
    shape = rows.groupBy("doc_id").agg((F.min("p") % 4).alias("k"))
    forms = [text("<div><head>H</head><p>Para {p}</p></div>"), text("<div>Para {p}</div>"), text("<p>Para {p}</p>"), text("Para {p}")]
    line = F.element_at(F.array(*forms), (F.col("k") + 1).cast("int"))
    docs = papers_from(rows.join(shape, "doc_id"), "<TEI><abstract>", line, "</abstract><body><p>No</p></body></TEI>")
    return S.select_abstract(tokens_of(docs)).drop("pos")


@query(
    "b12_leading_paragraphs",
    f"""WITH {_NUMBERED} SELECT doc_id, CAST(i AS INTEGER) AS para_no, 'Abstract' AS section, concat('Lead ', p) AS para_text FROM numbered""",
)
def b12_leading_paragraphs(spark, sf_dir):
    line = text("<p>Lead {p}</p><div0><p>Body {p}</p></div0>")
    docs = papers_from(cites(spark, sf_dir), "<body><std>", line, "</std></body>")
    return S.leading_paragraphs(tokens_of(docs), "std", ["div0"])


@query(
    "b13_back_matter",
    f"""WITH {_NUMBERED}
    SELECT doc_id, CAST(i AS INTEGER) AS para_no, CASE WHEN p % 2 = 0 THEN concat('Thanks ', n) ELSE 'annex' END AS section,
      CASE WHEN p % 2 = 0 THEN CAST(n AS VARCHAR) END AS sec_num, concat('To ', q, ' all.') AS para_text FROM numbered""",
)
def b13_back_matter(spark, sf_dir):
    head = F.when(F.col("p") % 2 == 0, text('<head n="{n}">Thanks {n}</head>')).otherwise("")
    line = text('<div type="annex"><div>', head, "<p>To {q} all.</p></div></div>")
    docs = papers_from(cites(spark, sf_dir), "<text><body><div><div><p>No</p></div></div></body><back>", line, "</back></text>")
    return S.back_matter(tokens_of(docs)).drop("pos")


@query(
    "b14_section_names",
    f"""WITH {CITES} SELECT doc_id, concat('uid', n) AS sec_id,
      CASE WHEN p % 3 = 0 THEN concat('Head ', p) WHEN p % 3 = 1 THEN concat('Short ', n, ' piece') ELSE concat('Short ', n) END AS name FROM cites""",
)
def b14_section_names(spark, sf_dir):
    long_piece = "This leading piece runs on for well over fifty characters in all."
    inner = (
        F.when(F.col("p") % 3 == 0, text("<head>Head {p}</head><p>x</p>"))
        .when(F.col("p") % 3 == 1, text("Short {n}<hi>piece</hi><p>x</p>tail"))
        .otherwise(text(f"Short {{n}}<hi>{long_piece}</hi>more"))
    )
    tokens = tokens_of(papers_from(cites(spark, sf_dir), "<body>", text('<div0 id="uid{n}">', inner, "</div0>"), "</body>"))
    return S.section_names(tokens, ["div0"]).select("doc_id", "sec_id", "name")


@query(
    "b15_list_items",
    f"""WITH {CITES}
    SELECT doc_id, CAST(n AS INTEGER) AS item, concat(CASE WHEN p % 2 = 0 THEN concat(n, '. ') ELSE '' END, 'Uses BIBREF', n, ' twice') AS para_text,
      CAST(5 + CASE WHEN p % 2 = 0 THEN length(concat(n, '. ')) ELSE 0 END AS INTEGER) AS start,
      CAST(5 + length(concat('BIBREF', n)) + CASE WHEN p % 2 = 0 THEN length(concat(n, '. ')) ELSE 0 END AS INTEGER) AS "end",
      concat('BIBREF', n) AS ref_id FROM cites""",
)
def b15_list_items(spark, sf_dir):
    number = F.when(F.col("p") % 2 == 0, text(' id-text="{n}"')).otherwise("")
    line = text("<item>[label={n}]</item><item", number, ">Uses BIBREF{n} twice</item>")
    tokens = tokens_of(papers_from(cites(spark, sf_dir), "<list>", line, "</list>"))
    items = S.list_items(S.item_rows(tokens))
    moved = S.shift_spans(placeholder_spans(items, ["doc_id", "pos"], "item_text", carry=["para_text", "shift"]))
    return moved.select("doc_id", F.regexp_extract("ref_id", r"(\d+)$", 1).cast("int").alias("item"), "para_text", "start", "end", "ref_id")


@query(
    "b16_titles",
    f"""WITH {CITES}, pick AS (SELECT doc_id, min(CASE WHEN p % 2 = 0 THEN n END) AS cut, min(n) AS low FROM cites GROUP BY doc_id)
    SELECT doc_id, concat('Title ', p) AS title, CASE WHEN p % 3 = 0 THEN concat(n, ',1,1,2,2') ELSE '1' END AS coords
    FROM cites JOIN pick USING (doc_id) WHERE n = coalesce(cut, low)""",
)
def b16_titles(spark, sf_dir):
    level = F.when(F.col("p") % 2 == 0, "a").otherwise("j")
    coords = F.when(F.col("p") % 3 == 0, text(' coords="{n},1,1,2,2"')).otherwise("")
    line = text('<title level="', level, '"', coords, ">Title {p}</title>")
    return S.titles(tokens_of(papers_from(cites(spark, sf_dir), "<titleStmt>", line, "</titleStmt>")))


@query(
    "b16_page_titles",
    f"""WITH {PAGE_TOKENS},
    marked AS (SELECT *, sum(CASE WHEN tag = 'title' AND kind = 'open' THEN 1 WHEN tag = 'title' AND kind = 'close' THEN -1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos) AS inside FROM tokens)
    SELECT doc_id, string_agg(text, '' ORDER BY pos) AS title, '1' AS coords FROM marked WHERE inside = 1 AND text IS NOT NULL GROUP BY doc_id""",
)
def b16_page_titles(spark, sf_dir):
    return S.titles(T.raw_tokens(pages(spark, sf_dir)))


@query(
    "b17_coordinate_boxes",
    f"""WITH {CITES}
    SELECT doc_id, CAST(n AS INTEGER) AS n, 0::INTEGER AS box_no, CAST(n AS INTEGER) AS page, CAST(q AS DOUBLE) AS x, 2.5::DOUBLE AS y, CAST(p AS DOUBLE) AS w, 4.0::DOUBLE AS h FROM cites
    UNION ALL SELECT doc_id, CAST(n AS INTEGER), 1::INTEGER, CAST(n + 1 AS INTEGER), CAST(p AS DOUBLE), 1.0::DOUBLE, CAST(q AS DOUBLE), 8.25::DOUBLE FROM cites""",
)
def b17_coordinate_boxes(spark, sf_dir):
    rows = cites(spark, sf_dir).withColumn("coords", text("{n},{q},2.5,{p},4.0;", (F.col("n") + 1), ",{p},1.0,{q},8.25"))
    return S.coordinate_boxes(rows, ["doc_id", "n"])


@query(
    "b9_page_paragraphs",
    f"""WITH {PAGE_TOKENS},
    blocks AS (SELECT *, sum(CASE WHEN tag IN ('p', 'h1', 'li', 'div') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos) AS block,
      CASE WHEN tag IN ('p', 'h1', 'li', 'div') THEN tok END AS mark FROM tokens),
    texts AS (SELECT doc_id, block, min(pos) AS pos, trim(regexp_replace(coalesce(string_agg(text, '' ORDER BY pos), ''), '\\s+', ' ', 'g')) AS para_text FROM blocks GROUP BY doc_id, block)
    SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS INTEGER) AS para_no, para_text FROM texts WHERE para_text <> ''""",
)
def b9_page_paragraphs(spark, sf_dir):
    # Web pages leave paragraphs open, so a block ends where the next begins.
    rows = T.block_groups(T.raw_tokens(pages(spark, sf_dir)), ["p", "h1", "li", "div"])
    texts = rows.groupBy("doc_id", "block").agg(F.min("pos").alias("pos"), tidy(ordered_concat(F.col("pos"), F.col("text"))).alias("para_text"))
    return S.number_paragraphs(texts.where("para_text <> ''")).select("doc_id", "para_no", "para_text")
