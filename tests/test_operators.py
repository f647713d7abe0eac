"""Operators on small inputs, edge cases first."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from paperloom.functions import ids, scan, text
from paperloom.operators import citations as C
from paperloom.operators import corpus as K
from paperloom.operators import entities as E
from paperloom.operators import floats as L
from paperloom.operators import papers as P
from paperloom.operators import sections as S
from paperloom.operators import spans as N
from paperloom.operators import tokens as T
from paperloom.operators import trees


def docs(spark, *xml):
    return spark.createDataFrame([(str(i), x) for i, x in enumerate(xml)], "doc_id string, xml string")


def one(spark, column):
    return spark.range(1).select(column.alias("x")).collect()[0].x


# text and ids


@pytest.mark.parametrize("raw,want", [("a &lt;b&gt; &amp;amp;", "a <b> &amp;"), ("&#65;&#x42;&#233;&#x1F600;", "ABé😀"), ("&#0;&#xD800;", "&#0;&#xD800;"), ("no refs & more", "no refs & more"), ("", "")])
def test_unescape(spark, raw, want):
    assert one(spark, text.unescape(F.lit(raw))) == want


def test_attr(spark):
    tok = F.lit("""<ref type='bibr' xml:id="a" target="#b0" x="it's &quot;q&quot;" empty="">""")
    assert [one(spark, text.attr(tok, n)) for n in ("type", "xml:id", "target", "x", "empty", "id", "none")] == ["bibr", "a", "#b0", 'it\'s "q"', None, None, None]


def test_soften_is_a_single_pass(spark):
    assert one(spark, text.soften_ws(F.lit("a   b c\td\n"))) in ("a  b c\td\n", "a  b c\td\n")


@pytest.mark.parametrize("raw,want", [("#b12", "BIBREF12"), ("tab_0", "TABREF0"), ("#fig_3", "FIGREF3"), ("formula_1", "EQREF1"), ("b1b", "BIBREF1B"), ("sec", "SEC")])
def test_tei_key(spark, raw, want):
    assert one(spark, ids.tei_key(F.lit(raw))) == want


# running sums


def test_running_sum_over_blocks(spark):
    rng = random.Random(1)
    data = [("hot", i, rng.randint(0, 5)) for i in range(500)] + [("cold", i * 7, 1) for i in range(20)]
    got = scan.running_sum(spark.createDataFrame(data, "k string, pos long, v long"), ["k"], "pos", F.col("v"), "s", block=16)
    have = {(r.k, r.pos): r.s for r in got.collect()}
    for key in ("hot", "cold"):
        total = 0
        for k, pos, v in sorted(d for d in data if d[0] == key):
            total += v
            assert have[(k, pos)] == total


# tokens


def test_tokens_depth_quotes_comments_cdata(spark):
    t = T.tokenise(docs(spark, '<a x="1>2"><!-- <b> --><b/>t<![CDATA[<raw>]]></a>'))
    assert [tuple(r) for r in t.orderBy("pos").select("kind", "tag", "text", "depth").collect()] == [
        ("open", "a", None, 1), ("void", "b", None, 2), ("text", None, "t", 2), ("text", None, "<raw>", 2), ("close", "a", None, 1),
    ]


def test_within_takes_the_outermost(spark):
    t = T.within(T.tokenise(docs(spark, "<d><d>x</d>y</d>z<d/>")), _d="d").where("text is not null or kind = 'void'")
    assert [r._d for r in t.orderBy("pos").collect()] == [0, 0, None, 7]


def test_drop_subtrees_with_condition(spark):
    t = T.tokenise(docs(spark, '<a><s k="x">no<s>no</s></s><s>yes</s><s k="x"/>end</a>'))
    left = T.drop_subtrees(t, ["s"], text.attr(F.col("tok"), "k") == "x")
    assert "".join(r.text for r in left.where("text is not null").orderBy("pos").collect()) == "yesend"


def test_trim_keeps_documents_without_title(spark):
    t = T.tokenise(docs(spark, "<std><p>a</p><title/>b</std>", "<std><p>a</p></std>"))
    kept = T.trim_before(t, ["title"], block=["std"]).where("text is not null")
    assert rows(kept, "doc_id", "text") == [("0", "b"), ("1", "a")]


# sections


def test_section_paths_skip_unnamed_and_foreign_heads(spark):
    x = '<body><p>top</p><div><figure><head>Not</head></figure><div><head n="1">A</head><p>in</p><div><head n="1.1">B</head><p>deep</p></div><p>after</p></div></div></body>'
    got = S.sectioned_paragraphs(T.tokenise(docs(spark, x)), ["div"])
    assert rows(got, "para_text", "section", "sec_num") == [("after", "A", "1"), ("deep", "A::B", "1.1"), ("in", "A", "1"), ("top", "", None)]


def test_sentences_fall_back_to_the_paragraph(spark):
    got = S.sentence_rows(T.tokenise(docs(spark, '<b><p><s coords="1">a</s> <s>b</s></p><p>whole</p><p> </p></b>')))
    assert rows(got, "para_no", "sent_no", "sentence", "coords") == [(0, 0, "a", "1"), (0, 1, "b", None), (1, 0, "whole", None)]


# citations


def cited(spark, body, known=range(30), style=True, widest=C.WIDEST, digits=C.DIGITS):
    t = T.tokenise(docs(spark, f"<p>{body}</p>"))
    keys = spark.createDataFrame([("0", f"BIBREF{i}") for i in known], "doc_id string, key string")
    st = spark.createDataFrame([("0", True)], "doc_id string, bracket boolean") if style else None
    paras = C.cited_paragraphs(C.keyed_units(C.paragraph_pieces(t), keys), st, widest=widest, digits=digits)
    spans = C.span_rows(paras, "para_text").orderBy("start").collect()
    for s in spans:
        assert s.para_text[s.start : s.end] == s.text
    return [(s.text, s.ref_id) for s in spans], (paras.collect()[0].para_text)


def ref(n, target=None):
    return f'<ref type="bibr" target="#b{n - 1 if target is None else target}">[{n}]</ref>'


def test_range_expands(spark):
    assert cited(spark, f"See {ref(1)}-{ref(4)}.", known=[0, 1, 3])[0] == [("[1]", "BIBREF0"), ("[2]", "BIBREF1"), ("[3]", None), ("[4]", "BIBREF3")]


def test_neighbours_do_not_expand(spark):
    got, para = cited(spark, f"See {ref(1)}-{ref(2)}.")
    assert got == [("[1]", "BIBREF0"), ("[2]", "BIBREF1")] and para == "See [1] - [2] ."


def test_falling_keys_keep_both(spark):
    assert cited(spark, f"{ref(1, 9)}-{ref(4, 2)}")[0] == [("[1]", "BIBREF9"), ("[4]", "BIBREF2")]


def test_shorter_list_decides(spark):
    assert [t for t, _ in cited(spark, f"{ref(1, 0)}–{ref(5, 1)}")[0]] == ["[1]", "[2]"]


def test_chain_pairs_from_the_left(spark):
    assert [t for t, _ in cited(spark, f"{ref(1)}-{ref(3)}-{ref(6)}")[0]] == ["[1]", "[2]", "[3]", "[6]"]
    assert [t for t, _ in cited(spark, f"{ref(1)}-{ref(3)}-{ref(6)}-{ref(8)}")[0]] == ["[1]", "[2]", "[3]", "[6]", "[7]", "[8]"]


def test_too_wide_or_not_a_mark(spark):
    assert len(cited(spark, f"{ref(1)}-{ref(21)}")[0]) == 2
    assert len(cited(spark, f"{ref(1)}, {ref(4)}")[0]) == 2
    assert len(cited(spark, f"{ref(1)}-<i>x</i>{ref(4)}")[0]) == 2


def test_limits_are_arguments(spark):
    wide = cited(spark, f"{ref(1)}-{ref(24)}", widest=None)[0]
    assert wide == [(f"[{i + 1}]", f"BIBREF{i}") for i in range(24)]
    far = [9998, 10001]
    assert len(cited(spark, f"{ref(9999)}-{ref(10002)}", known=far)[0]) == 2
    assert cited(spark, f"{ref(9999)}-{ref(10002)}", known=far, digits=None)[0] == [("[9999]", "BIBREF9998"), ("[10000]", None), ("[10001]", None), ("[10002]", "BIBREF10001")]


def test_units_of_one_pass(spark):
    """Keys, pieces and style from the same tokens; a title inside a paragraph counts for both."""
    item = lambda i, title: f'<biblStruct xml:id="b{i}"><title>{title}</title></biblStruct>'
    cites = "".join(f'<div><p>{ref(n)}{"-" + ref(n + 2) if n == 1 else ""} <ref type="figure" target="#fig_0">F</ref></p></div>' for n in range(1, 8))
    x = f'<t>{cites}<p>{item(0, "A")}</p>{item(1, "B")}{item(2, "C")}{item(3, "")}<biblStruct><title>N</title></biblStruct><figure xml:id="fig_0"/><ref type="bibr">[9]</ref></t>'
    y = x.replace("<div><p>", "<div><head>H</head><p>")
    t = T.tokenise(docs(spark, x, y))
    units = C.cited_units(t, style=True)
    assert rows(units.where("kind = 'key' and doc_id = '0'"), "key", "family") == [("BIBREF0", "bib"), ("BIBREF1", "bib"), ("BIBREF2", "bib"), ("FIGREF0", "entry")]
    assert rows(C.bracket_style(t, C.MORE_THAN, C.DIGITS)) == [("0", True), ("1", False)]
    got = C.span_rows(C.cited_paragraphs(units, None, C.MORE_THAN, C.WIDEST, C.DIGITS)).orderBy("para_pos", "start").collect()
    first = lambda d: [(s.text, s.ref_id) for s in got if s.doc_id == d][:4]
    assert first("0") == [("[1]", "BIBREF0"), ("[2]", "BIBREF1"), ("[3]", "BIBREF2"), ("F", "FIGREF0")]
    assert first("1")[:3] == [("[1]", "BIBREF0"), ("[3]", "BIBREF2"), ("F", "FIGREF0")]
    plan = C.cited_paragraphs(units, None, C.MORE_THAN)._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_set" not in plan and plan.count("LocalRelation") + plan.count("LogicalRDD") == 1


def test_unlinked_breaks_the_range_and_loses_no_citation(spark):
    assert cited(spark, f"{ref(1)}-{ref(4)}", known=[0])[0] == [("[1]", "BIBREF0"), ("[4]", None)]


def test_surface_filter_only_in_bracket_style(spark):
    plain = '<ref type="bibr" target="#b0">Lee</ref>'
    assert cited(spark, plain)[0] == [] and cited(spark, plain, style=False)[0] == [("Lee", "BIBREF0")]


# spans


def test_placeholders_at_both_ends(spark):
    df = spark.createDataFrame([(1, "BIBREF1 x FIGREF2"), (2, "none"), (3, "SECREFU1SECREF2")], "id long, t string")
    got = N.placeholder_spans(df, ["id"], "t")
    assert rows(got, "id", "ref_id", "start", "end") == [(1, "BIBREF1", 0, 7), (1, "FIGREF2", 10, 17), (3, "SECREF2", 8, 15), (3, "SECREFU1", 0, 8)]


def test_substitute_matches_python(spark):
    df = spark.createDataFrame([(1, "a BIBREF1BIBREF22 b FIGREF3 c")], "id long, para_text string")
    spans = N.placeholder_spans(df, ["id"], "para_text", carry=["para_text"])
    moved = N.substitute(spans.withColumns({"token": F.col("ref_id"), "surface": F.concat(F.lit("["), "ref_id", F.lit("]"))}), ["id"])
    new = N.substituted_text(moved, ["id"]).collect()[0].para_text
    assert new == "a [BIBREF1][BIBREF22] b [FIGREF3] c"
    assert all(new[r.new_start : r.new_end] == r.surface for r in moved.collect())


def test_replace_padded(spark):
    df = spark.createDataFrame([("abcdefghij", [(1, 3, "X"), (2, 4, "no"), (3, 5, "Y"), (7, 8, "Z")])], "t string, s array<struct<start:int,end:int,surface:string>>")
    assert df.select(N.replace_padded(F.col("t"), F.col("s"), "<", ">")).collect()[0][0] == "a<X>, <Y>fg<Z>ij"


def test_containment_against_brute_force(spark):
    rng = random.Random(2)
    make = lambda: [("p%d" % rng.randint(0, 2), s, s + rng.randint(1, 9)) for s in (rng.randint(0, 40) for _ in range(60))]
    ours, theirs = sorted(set(make())), make()
    want = sorted(o for o in ours if any(t[0] == o[0] and o[1] >= t[1] and o[2] <= t[2] for t in theirs))
    frame = lambda d: spark.createDataFrame(d, "k string, start int, end int")
    assert sorted(tuple(r) for r in N.inside_existing(frame(ours), frame(theirs), ["k"]).collect()) == want


def test_nested_marks(spark):
    x = '<p>A<xref ref-type="bibr" rid="r1">1<sup>a<sub>2</sub></sup></xref> b</p>'
    got = N.marked_spans(T.tokenise(docs(spark, x)))
    assert rows(got, "kind", "start", "end", "text", "ref_id") == [("cite", 1, 4, "1a2", "r1"), ("sub", 3, 4, "2", None), ("sup", 2, 4, "a2", None)]


def test_marks_read_their_tokens_once(spark):
    """Paragraph text and marks come from one pass: no join brings the tokens in again."""
    x = "<b><p> a  <sup> b </sup>  <i> c</i></p><p>  <xref> </xref> d</p></b>"
    got = N.marked_spans(T.tokenise(docs(spark, x)))
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert rows(got, "para_pos", "kind", "start", "end", "text", "para_text") == [(1, "sup", 3, 6, " b ", " a  b  c"), (11, None, 1, 2, " ", "  d")]


# entities


@pytest.mark.parametrize(
    "name,want", [("Ann B. Lee", ("Ann", ["B."], "Lee")), ("Lee", ("", [], "Lee")), ("Ann Lee Jr.", ("Ann", ["Lee"], "Lee")), ("Lee III", ("Lee", [], "Lee")), ("III", ("", [], "III"))]
)
def test_split_author(spark, name, want):
    r = one(spark, E.split_author(F.lit(name)))
    assert (r.first, r.middle, r.last) == want


def test_year(spark):
    assert [one(spark, E.year_of(F.lit(v))) for v in ("2015-03", "1899", "19", "x2015", "20155")] == [2015, None, None, None, 2015]


def test_missing_given_names_void_the_paper(spark):
    x = "<front><contrib><name><surname>A</surname></name></contrib><contrib><name><surname>B</surname><given-names>C D</given-names></name></contrib></front>"
    ok = "<front><contrib><collab>G</collab><contrib><name><surname>B</surname><given-names>C D</given-names></name></contrib></contrib></front>"
    assert rows(E.jats_contributors(T.tokenise(docs(spark, x, ok))), "doc_id", "first", "middle", "last") == [("1", "C", ["D"], "B")]


def test_most_frequent_ties_go_to_the_first(spark):
    df = spark.createDataFrame([("d", 3, "a"), ("d", 1, "b"), ("d", 2, "a"), ("d", 4, "b")], "doc_id string, pos long, value string")
    assert rows(E.most_frequent(df)) == [("d", "b")]


# trees


def test_section_tree_with_cycle_and_unknown_parent(spark):
    data = [("d", "a", "1", "A", None), ("d", "b", "2", "B", "a"), ("d", "c", "3", "C", "b"), ("d", "s", None, "S", "s"), ("d", "u", None, "U", "gone"), ("d", "x", None, "X", "y"), ("d", "y", None, "Y", "x")]
    got = trees.section_paths(spark.createDataFrame(data, "doc_id string, sec_id string, num string, name string, parent string"))
    have = {r.sec_id: ([p.name for p in r.path], r.cyclic) for r in got.collect()}
    assert have == {"a": (["A"], False), "b": (["A", "B"], False), "c": (["A", "B", "C"], False), "s": (["S"], False), "u": (["U"], False), "x": (["X"], True), "y": (["Y"], True)}


def test_section_tree_with_repeated_ids_ends(spark):
    data = [("d", "X", "1", "R", None), ("d", "Y", "2", "Y", "X"), ("d", "X", "3", "X", "Y"), ("d", "Z", "4", "Z", "Y")]
    data += [("e", f"s{i}", None, f"S{i}", f"s{i - 1}" if i else None) for i in range(40)]
    got = trees.section_paths(spark.createDataFrame(data, "doc_id string, sec_id string, num string, name string, parent string")).collect()
    have = sorted((r.sec_id, [p.name for p in r.path], r.cyclic) for r in got if r.doc_id == "d")
    assert have == [("X", ["R"], False), ("X", ["R", "Y", "X"], False), ("Y", ["R", "Y"], False), ("Z", ["R", "Y", "Z"], False)]
    assert {r.sec_id: len(r.path) for r in got if r.doc_id == "e"} == {f"s{i}": i + 1 for i in range(40)}


def test_references_are_read_once(spark):
    df = spark.createDataFrame([("a &#38;lt; b &amp;lt; &lt;&#x41;&nope; &amp; & &#xD800; c",)], "t string")
    assert df.select(text.unescape(F.col("t"))).first()[0] == "a &lt; b &lt; <A&nope; & & &#xD800; c"


def test_sections_of_raw_text_keep_comments(spark):
    t = T.tokenise(docs(spark, "<!DOCTYPE a [<!ENTITY x 'y'>]><a><![CDATA[x<!-- y -->z]]><!-- gone --><?pi?>w</a>"))
    assert rows(t.where("kind = 'text'"), "text") == [("w",), ("x<!-- y -->z",)]


def test_marks_between_pairs_of_spaces(spark):
    x = '<p>foo <xref ref-type="bibr" rid="r"> bar</xref> baz  <xref ref-type="fig" rid="f">Fig 1</xref> end<sup> </sup>  <sup>x</sup></p>'
    for r in N.marked_spans(T.tokenise(docs(spark, x))).collect():
        assert r.para_text == "foo bar baz Fig 1 end  x" and r.para_text[r.start : r.end] == r.text


def test_synthetic_ids_stay_above_used_ones(spark):
    data = [("d", 1, None), ("d", 2, "SECREF1500"), ("d", 3, None), ("e", 1, None), ("e", 2, "SECREFU7000")]
    got = trees.synthetic_ids(spark.createDataFrame(data, "doc_id string, pos long, sec_id string"))
    assert rows(got, "doc_id", "pos", "sec_id") == [("d", 1, "SECREF1501"), ("d", 2, "SECREF1500"), ("d", 3, "SECREF1502"), ("e", 1, "SECREF1000"), ("e", 2, "SECREFU7000")]


# papers


@pytest.mark.parametrize(
    "raw,want",
    [
        ('[{"sentence":"a","coords":"1"},"b",3,null,{"x":1}]', [("a", "1"), ("b", ""), ("", "")]),
        ("EQUATION", [("EQUATION", "")]), ('"EQUATION"', [("EQUATION", "")]), ("[]", []), ("[1]", []), ("[broken", [("[broken", "")]),
    ],
)
def test_text_elements(spark, raw, want):
    assert [tuple(x) for x in one(spark, P.text_elements(F.lit(raw)))] == want


def test_reading_order_repeats_no_heading(spark):
    t = spark.createDataFrame([("d", "T")], "doc_id string, title string")
    p = spark.createDataFrame([("d", 0, "A", ""), ("d", 1, "B", "b1"), ("d", 2, "A", "a1"), ("d", 3, "B", "b2")], "doc_id string, ord long, section string, text string")
    lines = [r.line for r in P.reading_order(t, p).orderBy("line_no").collect()]
    assert lines == ["T", "B", "b1", "A", "a1", "b2"]


def test_sections_round_trip(spark):
    path = P.section_list(F.lit("A::B"), F.lit("2"))
    assert [tuple(x) for x in one(spark, path)] == [(None, "A"), ("2", "B")]
    assert one(spark, P.section_string(path)) == "A::B" and one(spark, P.section_list(F.lit(""), F.lit("1"))) == []


def test_lookup_top_level_only(spark):
    df = spark.createDataFrame([(1, '{"k":1,"a":{"k":9}}'), (2, '[{"k":"x"},{"y":1},[{"k":3}]]'), (3, "broken")], "id long, j string")
    assert rows(P.lookup(df, "j", "k"), "id", "value") == [(1, "1"), (2, "x")]


# corpus


def test_commands(spark):
    raw = r"\citep[see][p. 1]{a,b} \citet*{c} \cite{d} \citeyearpar{e} \bibitem[x]{y}"
    assert one(spark, K.normalise_commands(F.lit(raw))) == r"\cite{a,b} \cite{c} \cite{d} \cite{e} \bibitem{y}"


def test_vocabulary_is_dense_and_by_frequency(spark):
    words = [("w%d" % i,) for i in range(50) for _ in range(1 + i % 5)]
    got = K.vocabulary(spark.createDataFrame(words, "word string")).orderBy("id").collect()
    count = {w: sum(1 for x in words if x[0] == w) for (w,) in words}
    assert [r.id for r in got] == list(range(3, 53))
    assert [count[r.word] for r in got] == sorted(count.values(), reverse=True)


def test_windows_go_on_and_pad(spark, monkeypatch):
    monkeypatch.setattr(K, "HEAD_WORDS", 2)  # so that both join paths are taken
    s = spark.createDataFrame([(1, "a a a b b c"), (2, "..."), (3, "a b c a b c a")], "id long, sentence string")
    words = K.sentence_words(s, ["id"])
    got = {(r.id, r.window_no): (r.ids, r.mask) for r in K.token_windows(words, ["id"], K.vocabulary(words.where("word is not null")), length=7).collect()}
    a, b, c = 3, 4, 5
    assert got[1, 0][0] == [1, a, a, a, b, b, 2] and got[2, 0] == ([1, 2, 0, 0, 0, 0, 0], [1, 1, 0, 0, 0, 0, 0]) and got[3, 0][0] == [1, a, b, c, a, b, 2]
    # No word is lost: a sentence goes on in its next window.
    assert got[1, 1] == ([1, c, 2, 0, 0, 0, 0], [1, 1, 1, 0, 0, 0, 0]) and got[3, 1][0] == [1, c, a, 2, 0, 0, 0] and len(got) == 5


def test_commands_in_linear_time(spark):
    """Commands with stars, options and blanks; a long run of blanks behind a command that never ends is read once."""
    from paperloom.operators import corpus as K

    texts = [
        r"\citep[see][p. 2]{a}", "\\citeT * {a,b}", "\\citeyearpar [x] [y]\n* {k}", r"\citeyear{y}", r"\citetext{no}", r"\cite{z}", r"\citep[open{k}", r"\citep{}",
        r"\bibitem [Lee] {q}\BibItem[]{r}", "\\citep" + " " * 100000 + "x", "\\citep" + "[a] " * 20000 + "{k}",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "n long, t string")
    got = [r.x for r in df.orderBy("n").select(K.normalise_commands(F.col("t")).alias("x")).collect()]
    assert got == [
        r"\cite{a}", r"\cite{a,b}", r"\cite{k}", r"\cite{y}", r"\citetext{no}", r"\cite{z}", r"\citep[open{k}", r"\citep{}", r"\bibitem {q}\bibitem{r}", texts[9], r"\cite{k}",
    ]


def test_empty_text_is_no_number_and_named_references_stay_exact(spark):
    given = ["a &lt;b&gt; &amp;lt; &amp;amp; &bad; & x", "&#65;&amp;#66; &#x43; &quot;&apos;&nbsp;", "&&lt;lt;", "", None, "&#1114112; &#; &lt"]
    df = spark.createDataFrame(list(enumerate(given)), "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(text.unescape(F.col("t"))).collect()]
    assert got == ["a <b> &lt; &amp; &bad; & x", "A&#66; C \"'\xa0", "&<lt;", "", None, "&#1114112; &#; &lt"]
    numbers = spark.createDataFrame([("12",), ("",), ("x",), (None,)], "t string").select(text.number(F.col("t"))).collect()
    assert [r[0] for r in numbers] == [12, None, None, None]


def test_markup_is_spread_by_what_it_holds(spark, monkeypatch):
    monkeypatch.setattr("paperloom.operators.tokens.TASK_CHARS", 100)
    papers = docs(spark, *["<a>" + "x" * 93 + "</a>"] * 9)
    assert T.task_count(papers, F.col("xml")) == 9
    assert T.task_count(papers.where("false"), F.col("xml")) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread = T.tokenise(papers).select(F.spark_partition_id().alias("p"), "doc_id").distinct()
    assert spread.count() == 9 and spread.select("p").distinct().count() > 2


def test_item_fields_join_texts_without_collecting_aggregates(spark):
    x = '<l><title>Out<ref id="r1"/>side</title><ref id="r2"><source>A <b>b</b> &amp;<i/> c</source><year>2000</year><source/></ref></l>'
    fields = E.item_fields(T.raw_tokens(docs(spark, x)), "ref", ("source", "year", "title"), ("id",))
    assert rows(fields, "tag", "text", "@id") == [("ref", "", "r2"), ("source", "", None), ("source", "A b & c", None), ("year", "2000", None), (None, "", None)]
    assert "ObjectHashAggregate" not in fields._jdf.queryExecution().executedPlan().toString()


def test_contributor_names_inside_and_outside_of_name(spark):
    x = '<front><contrib corresp="yes"><surname>Out</surname><name><surname>De <b>La</b></surname><given-names>Ann B</given-names></name><xref rid="a1" ref-type="aff">1</xref></contrib></front>'
    out = E.jats_contributors(T.tokenise(docs(spark, x)))
    assert rows(out, "first", "last", "corresponding", "affiliation_ids") == [("Ann", "De La", True, ["a1"])]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "keys=[doc_id#" not in "".join(line for line in plan.split("\n") if "_u#" in line and "ObjectHashAggregate" in line)


def sorts(df):
    """Sorts in the plan of a query."""
    return df._jdf.queryExecution().executedPlan().toString().count(" Sort [")


def test_table_cells_are_cut_in_the_order_of_the_tokens(spark):
    x = (
        '<d><float id="t1"><row top-border="true"><cell halign="left">a <b>b</b><formula><math>x</math><texmath>$x$</texmath></formula></cell>between<cell/></row>'
        '<row bottom-border="true"><cell right-border="true"><table id="in"><row top-border="true"><cell>deep</cell></row></table>t</cell></row></float>'
        '<row><cell>outside</cell></row><table><row><cell left-border="true"><i/>1<i/>2</cell></row></table></d>'
    )
    cells = L.table_cells(T.tokenise(docs(spark, x)))
    names = ("table_id", "row_no", "col_no", "alignment", "left_border", "right_border", "top_border", "bottom_border", "text", "latex")
    got = sorted((tuple(r) for r in cells.select(*names).collect()), key=str)
    assert got == sorted(
        [
            ("t1", 0, 0, "left", False, False, True, False, "a b x", "a b $x$"), ("t1", 0, 1, None, False, False, True, False, "", ""),
            ("t1", 1, 0, None, False, True, False, True, "deep t", "deep t"), (None, 0, 0, None, True, False, False, False, "1 2", "1 2"),
        ],
        key=str,
    )
    # One by document and place, one of the finished cells.
    assert sorts(cells) == 2


def test_floats_are_read_without_a_sort_of_their_own(spark):
    x = (
        '<d><float name="figure" id="uid1" id-text="1"><figure file="a" extension="png"/><caption>One  <formula><texmath>$x$</texmath></formula></caption></float>'
        '<float name="table" id="uid2"><figure file="no"/></float><figure id="uid3" file="b">Bare</figure><float id="uid4"><caption>none</caption></float></d>'
    )
    figures = L.latex_figures(T.tokenise(docs(spark, x)))
    assert rows(figures, "ref_id", "num", "text", "uris") == [("FIGREF1", "1", "One", ["a.png"]), ("FIGREF3", None, "Bare", ["b"])]
    assert "unboundedfollowing" not in figures._jdf.queryExecution().executedPlan().toString()


def test_citations_are_cut_without_collecting_aggregates(spark):
    """Units of citations come from ordered passes; no array is filtered row by row, and heads ask for two orders, not three."""
    x = (
        '<t><div><p>See <ref type="bibr" target="#b0"> [1] </ref> <b>and</b> <ref type="figure" target="#fig_0">F<i>1</i></ref></p></div><div><head>H</head><p/><ref type="bibr">[2]</ref></div>'
        '<figure xml:id="fig_0"><p>in</p></figure><biblStruct xml:id="b0"><title>A <i>b</i></title></biblStruct><biblStruct xml:id="b1"><title/></biblStruct></t>'
    )
    tokens = T.tokenise(docs(spark, x))
    units = C.cited_units(tokens, style=True)
    assert rows(units, "kind", "text", "ref_type", "key", "family", "_bare") == sorted(
        [
            ("key", None, None, "BIBREF0", "bib", None), ("key", None, None, "FIGREF0", "entry", None), ("ref", "F1", "figure", "FIGREF0", "entry", True),
            ("ref", "[1]", "bibr", "BIBREF0", "bib", True), ("ref", "[2]", "bibr", None, "bib", False), ("text", " ", None, None, None, True), ("text", " ", None, None, None, True),
            ("text", "See ", None, None, None, True), ("text", "and", None, None, None, True), ("text", "in", None, None, None, None),
        ],
        key=repr,
    )
    plan = units._jdf.queryExecution().executedPlan().toString()
    assert "knownnotcontainsnull" not in plan and "ObjectHashAggregate(keys=[doc_id#" not in "".join(line for line in plan.split("\n") if "role#" in line)
    assert sorts(units) == 4 and "ObjectHashAggregate" not in "".join(line for line in C.paragraph_pieces(tokens)._jdf.queryExecution().executedPlan().toString().split("\n") if "_p#" in line)


def test_contributors_and_funders_follow_the_order_of_the_tokens(spark):
    """Elements that hold no other one of their kind are found in the order that the tokens have."""
    x = (
        '<front><contrib><name><surname>Group</surname><given-names>G</given-names></name><contrib><name><surname>In</surname><given-names>A B</given-names></name></contrib><email>g@x</email></contrib><contrib/>'
        "<funding-source>Out<funding-source>Body</funding-source> tail</funding-source><funding-source>Open</front>"
    )
    tokens = T.tokenise(docs(spark, x))
    assert rows(E.jats_contributors(tokens), "first", "last", "email") == [("A", "In", None)]
    assert rows(E.jats_funders(tokens), "name") == [("Body",)]
    for found in (E.jats_contributors(tokens), E.jats_funders(tokens)):
        assert "_m#" not in "".join(line for line in found._jdf.queryExecution().executedPlan().toString().split("\n") if " Sort [" in line)


def test_what_says_nothing_is_left_out_ahead_of_the_passes(spark):
    """Operators that read few tags let the others go before the tokens are sorted; the results are those of all tags."""
    x = (
        '<d><p>A <u>b</u> <formula id="f1"><math><mi>x</mi></math><texmath>x</texmath></formula></p><note id="uid1" id-text="1">N <u>n</u><xref url="http://u"/></note>'
        '<aff id="a1"><label>1</label>Univ <u>X</u><institution-id institution-id-type="G">g1</institution-id></aff>'
        '<back><ref-list><ref id="r1"><u>1</u><article-title>T <u>t</u></article-title></ref></ref-list></back><p>H<u>2</u><sub>3</sub></p></d>'
    )
    tokens = T.tokenise(docs(spark, x))
    found = {
        "formula": N.formula_pieces(tokens), "note": L.latex_footnotes(tokens), "aff": E.jats_affiliations(tokens), "ref": E.jats_bibliography(tokens), "sub": N.marked_spans(tokens),
    }
    assert rows(found["formula"].where("kind = 'ref'"), "text", "math", "latex", "target") == [("DISPLAYFORM0", "x", "x", "f1")]
    assert rows(found["note"], "ref_id", "num", "text") == [("FOOTREF1", "1", "N n http://u")]
    assert rows(found["aff"].select("aff_id", "text", F.to_json("other_ids"))) == [("a1", "Univ X", '{"G":"g1"}')]
    assert rows(found["ref"], "old_key", "title") == [("r1", "T t")]
    assert rows(found["sub"], "kind", "start", "end", "text", "para_text") == [("sub", 2, 3, "3", "H23")]
    for name in ("formula", "note", "aff", "ref"):
        plan = found[name]._jdf.queryExecution().optimizedPlan().toString()
        assert [line for line in plan.split("\n") if "Filter" in line and "regexp_extract(tok#" in line], name


def test_levels_of_sections_are_counted_along_with_their_parts(spark):
    x = '<d><div><head n="1">A</head><p>one</p><div><head>B</head><p>two</p></div><p>three</p></div></d>'
    found = S.sectioned_paragraphs(T.tokenise(docs(spark, x)), ["div"])
    assert rows(found, "section", "sec_num", "para_text") == [("A", "1", "one"), ("A", "1", "three"), ("A::B", None, "two")]
    windows = [line for line in found._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Window [" in line and "[doc_id#" in line and "pos#" in line]
    assert len([line for line in windows if "], [pos#" in line and ", [doc_id#" in line and "nest#" not in line.split("], [doc_id#")[1] and "_lvl" not in line]) == 3
