"""Rules, scans, classifier, tokens and chat rows against brute force, with odd rows."""

import random
import re

import numpy as np
import pytest

from llm_fixtures import make_docs  # noqa: F401
from paperloom.llm import license_scan, line_rules, quality_model, tool_calls, url_templates
from paperloom.llm.queries import URL_RULES

LOWER = {c: c + 32 for c in range(65, 91)}


def split_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# url templates


def brute_urls(urls):
    """The same tree, grown path by path with plain dictionaries."""
    rows = []
    for url in urls:
        host, path = "", ""
        if url and "://" in url:
            rest = url.split("://", 1)[1]
            host = re.match(r"[^/?#]*", rest)[0].translate(LOWER)
            path = re.match(r"[^?#]*", rest[len(host) :])[0]
        fits = [r for r in URL_RULES if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
        rule = max(fits, key=lambda r: len(r[1] + r[2]), default=None)
        mask = tuple(re.sub(url_templates.VARIABLE, "*", s) for s in path.split("/") if s)
        rows.append((host, path, rule, mask))
    counts = {}
    for host, _, rule, mask in rows:
        c = counts.setdefault((host, mask), [0, 0])
        c[0] += rule is not None and rule[0] == "block"
        c[1] += rule is not None
    template = {}

    def grow(host, node, keys, depth):
        for k in [k for k in keys if len(k[1]) == depth]:
            template[k] = node
        keys = [k for k in keys if len(k[1]) > depth]
        if len(keys) == 1:
            template[keys[0]] = node + "/" + "/".join(keys[0][1][depth:])
            return
        kids = {}
        for k in keys:
            kids.setdefault(k[1][depth], []).append(k)
        named = {c: (sum(counts[k][0] for k in ks), sum(counts[k][1] for k in ks)) for c, ks in kids.items() if c != "*"}
        b_all, m_all = (sum(v[i] for v in named.values()) for i in (0, 1))
        groups = {}
        for c, ks in kids.items():
            to = c
            if c != "*" and len(named) > 1:
                b, m = named[c]
                p, rest = (b_all + 0.5) / (m_all + 1), m_all - m
                z = abs((b + 0.5) / (m + 1) - (b_all - b + 0.5) / (rest + 1)) / (p * (1 - p) * (1 / (m + 1) + 1 / (rest + 1))) ** 0.5
                if m > 0 and rest > 0 and z < url_templates.APART:
                    to = url_templates.MERGED
            groups.setdefault(to, []).extend(ks)
        for c, ks in groups.items():
            grow(host, node + "/" + c, ks, depth + 1)

    for host in {k[0] for k in counts}:
        grow(host, "", [k for k in counts if k[0] == host], 0)
    total = {}
    for k, t in template.items():
        v = total.setdefault((k[0], t), [0, 0])
        v[0] += counts[k][0]
        v[1] += counts[k][1]
    out = []
    drawn = lambda b, m, to: (b + to * url_templates.STRENGTH) / (m + url_templates.STRENGTH)
    for i, (host, path, rule, mask) in enumerate(rows):
        t = template[(host, mask)]
        prior = url_templates.PRIOR
        if url_templates.MERGED not in t:
            prior = drawn(*(sum(v[x] for k, v in total.items() if k[1] == t) for x in (0, 1)), prior)
        purity = drawn(*total[(host, t)], prior)
        verdict = rule[0] if rule else "block" if purity >= url_templates.REJECT else "allow"
        out.append((i, host, path, rule and rule[1] + rule[2], verdict, t))
    return out


def test_url_templates(spark):
    rng = random.Random(3)
    urls = [None, "", "no host", "http://", "HTTP://WWW.Example.COM", "x://net/es/", "http://com/a?x=/b", "http://a.net/fr", "http://b.xnet/fr/1", "https://www.example.com/en/1", "a://b://c/d", "http://h.org/" + "/".join(f"s{i}x" for i in range(300))]
    for _ in range(900):
        host = rng.choice(["shop.net", "blog.net", "a.example.com", "big.org", "www.example.com"])
        head = rng.choice(["es", "fr", "Es", "news", "en", "u" + str(rng.randrange(3))])
        urls.append(f"http://{host}/{head}/{rng.choice(['p', 'q', str(rng.randrange(99))])}" + rng.choice(["", ".html", "/", "?a=1", "#f", "/deep/er"]))
    for i in range(80):
        urls.append(f"http://wide.net/{'es' if i % 2 else 'k' + 'abcdefgh'[i % 8] * (1 + i // 8)}/x")
    urls += [f"http://wide.net/{'x' * i}/y" for i in range(1, 60)] + [f"http://mirror.net/es/z{'y' * i}" for i in range(1, 20)] + ["http://mirror.net/zz/top", "http://mirror.net/zz/top"]
    df = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)], "page_id long, url string, host string, template string")
    got = url_templates.url_verdicts(df, URL_RULES).collect()
    assert sorted((r["id"], r["host"], r["path"], r["rule"], r["verdict"], r["template"]) for r in got) == brute_urls(urls)
    assert url_templates.url_verdicts(df.where("false"), URL_RULES).count() == 0
    assert [r["verdict"] for r in url_templates.url_verdicts(df.where("page_id in (0, 2)").selectExpr("cast(null as long) page_id", "url"), URL_RULES).collect()] == ["allow", "allow"]


def test_url_branches_and_evidence_over_hosts(spark, tmp_path):
    """A masked segment is not a merged branch; a template blocked on many hosts is blocked on a host without rules."""
    from paperloom.llm.queries import op3

    urls = [f"http://h.net/{c}/{'ab'[i % 2] * (3 + i // 2)}/x" for c in ("es", "fr") for i in range(40)]
    urls += ["http://h.net/17/abbb/x", "http://h.net/2024/abcd/x"]
    urls += [f"http://n{i}.net/es/lista" for i in range(60)] + [f"http://c{i}.com/news/today" for i in range(60)]
    urls += ["http://free.org/es/lista", "http://free.org/news/today", "http://free.org/other"]
    rows = list(enumerate(urls))
    spark.createDataFrame(rows, "page_id long, url string").write.parquet(str(tmp_path / "pages.parquet"))
    got = {rows[r["page_id"]][1]: r for r in op3(spark, str(tmp_path)).collect()}
    assert sorted((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"], r["template"]) for r in got.values()) == brute_urls(urls)
    assert [got[u]["verdict"] for u in urls[80:82]] == ["allow", "allow"]
    assert got["http://free.org/es/lista"]["rule"] is None
    assert [got[u]["verdict"] for u in urls[-3:]] == ["block", "allow", "allow"]


def test_url_verdict_does_not_depend_on_the_number_of_siblings(spark, tmp_path):
    """The registered query at 49 to 90 sections beside a blocked one."""
    from paperloom.llm.queries import op3

    names = ["s" + "abcdefghij"[i // 10] + "abcdefghij"[i % 10] for i in range(90)]
    urls = [f"http://h{k}.net/es/{'p' * (1 + i % 9)}{'q' * (i // 9)}" for k in (49, 50, 51, 90) for i in range(200)]
    clean = [f"http://h{k}.net/{s}/{page}" for k in (49, 50, 51, 90) for s in names[:k] for page in ("p", "ppp")]
    rows = [(i, u) for i, u in enumerate(urls + clean)]
    spark.createDataFrame(rows, "page_id long, url string").write.parquet(str(tmp_path / "pages.parquet"))
    got = {r["page_id"]: r for r in op3(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    a, b = len(urls), len(urls) + len(clean)
    assert {got[i]["verdict"] for i in range(a)} == {"block"}
    assert {got[i]["verdict"] for i in range(a, b)} == {"allow"}
    assert {round(got[i]["purity"], 6) for i in range(a, b)} == {0.1}


# license scan


def brute_license(text):
    text = (text or "").translate(LOWER)
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)
    ws = cut(text)
    spots = [(i, label) for phrase, label in license_scan.PHRASES for i in range(len(ws)) if ws[i : i + len(phrase.split())] == phrase.split()]
    met = {}
    for line in text.split("\n"):
        for label, template in license_scan.TEMPLATES:
            t = set(template.split(" "))
            share = len(t & set(cut(line))) / len(t)
            if share * 100 >= license_scan.CONTAINMENT:
                met[label] = max(share, met.get(label, 0))
    base = sorted({x[1] for x in spots})
    at = [x[0] for x in spots]
    return len(ws), len(at), min(at, default=None), max(at, default=None), ",".join(base), ",".join(sorted({*base, *met})), 1.0 if at else max(met.values(), default=0.0)


def test_license_scan(spark, make_docs):
    templates = [t for _, t in license_scan.TEMPLATES]
    rng = random.Random(2)
    texts = [None, "", " ", "Under the MIT License", "under the mit license under the mit license", "cc by nc cc by nc-cc/by.nc", "xunder the mit license", "é apache LICENSE, version 2.0 ü", "plain words\n\nmore", "CC BY NC " * 3000, "word " * 20000 + "under the MIT license."]
    for t in templates:
        ws = t.split(" ")
        texts += [f"intro\n{t.upper()}!\nend", " ".join(ws[:-1]), " ".join(ws[1:]), " ".join(rng.sample(ws, len(ws))), " ".join(ws[: len(ws) // 2]) + "\n" + " ".join(ws[len(ws) // 2 :]), t + " " + "filler " * 40]
    docs = make_docs([(i, t) for i, t in enumerate(texts)] + [(None, templates[0]), (None, templates[0])])
    got = license_scan.license_scan(docs)[0].collect()
    assert len(got) == len(texts) + 2
    rows = {r["id"]: tuple(r[1:]) for r in got if r["id"] is not None}
    for i, t in enumerate(texts):
        assert rows[i] == pytest.approx(brute_license(t)), t
    assert license_scan.license_scan(docs.where("false"))[0].count() == 0


def test_license_positions_filter(spark):
    """Of all meetings with a prefix some cannot reach the threshold by what is left on either side; no pair that does is lost."""
    rng = random.Random(12)
    order = [f"w{i}" for i in range(30)]
    templates = [sorted(rng.sample(order, 10), key=order.index) for _ in range(6)]
    c = license_scan.needed(10, 80)
    blocks = [rng.sample(t, rng.randint(5, 10)) + rng.sample(order, 4) for t in templates for _ in range(40)]
    prefix = spark.createDataFrame([(t, w, i) for t, ws in enumerate(templates) for i, w in enumerate(ws[: 10 - c + 1])], "t int, word string, i int")
    whole = spark.createDataFrame([(t, ws, 10, c) for t, ws in enumerate(templates)], "t int, template array<string>, m int, c int")
    df = spark.createDataFrame([(i, i, 0, sorted(set(b))) for i, b in enumerate(blocks)], "uid long, id long, block int, words array<string>")
    met = license_scan.candidates(df, order, prefix, whole).select("uid", "t").collect()
    every = sum(w in ws[: 10 - c + 1] for b in blocks for w in set(b) for ws in templates)
    true = {(i, t) for i, b in enumerate(blocks) for t, ws in enumerate(templates) if len(set(b) & set(ws)) >= c}
    assert true <= {tuple(r) for r in met} and true and len(met) < 0.9 * every


def test_license_notice_wrapped_over_lines(spark, tmp_path):
    from paperloom.llm.queries import op4

    rng = random.Random(11)
    rows, want = [], {}
    for label, template in license_scan.TEMPLATES:
        for before in (0, 1, 16, 17, 18, 33, 34, 50):
            ws = template.split(" ")
            wrapped = "".join(w + rng.choice([" ", "\n", "\n * "]) for w in ws[:-1]) + ws[-1] + "\n"
            rows.append((len(rows), "\n".join(["filler text"] * (before // 2) + ["odd"] * (before % 2)) + "\n" + wrapped + "more " * (before % 5)))
            want[len(rows) - 1] = label
    rows += [(900, "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation"), (901, None), (902, ""), (903, "\n"), (904, " \n\n ")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in op4(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    assert all(label in got[i]["labels"].split(",") and got[i]["score"] == 1 for i, label in want.items())
    assert got[900]["labels"] == "mit"
    assert all(got[i]["labels"] == "" and got[i]["score"] == 0 for i in (901, 902, 903, 904))


# line rules


def test_line_rules(spark, make_docs):
    unique = lambda i, n: " ".join(f"w{i}x{'abcdefghij'[j % 10]}{'k' * (j // 10)}" for j in range(n))
    head = "Menu HOME 12 about us"
    rows = [(i, f"{head}\n{unique(chr(97 + i), 40)}") for i in range(25)]
    rows += [(100 + i, f"menu home  77 ABOUT us\n{unique(chr(97 + i) * 2, 1)}") for i in range(3)]
    rows += [(200, f"{head}\n{unique('zz', 40)}", "en", "other"), (201, f"{head}\n{unique('zy', 40)}", "en", None)]
    rows += [(300, None), (301, ""), (302, " \n \n"), (None, unique("q", 30)), (303, unique("r", 25)), (303, unique("r", 25)), (304, "a b c d e f g h " * 9), (305, "x#*$ y\nx#*$ y\n \né&ü\n")]
    docs = make_docs(rows)
    verdicts = line_rules.line_rules(docs)
    got = {}
    for r in verdicts.collect():
        got.setdefault(r["id"], []).append(r)
    assert sum(map(len, got.values())) == len(rows)
    assert all(got[i][0]["kept"] and got[i][0]["left_words"] == 40 for i in range(25))
    assert all(got[100 + i][0]["base_failed"] for i in range(3))
    assert got[200][0]["left_words"] == 45 and got[201][0]["left_words"] == 45
    assert [got[i][0]["n_words"] for i in (300, 301, 302)] == [0, 0, 0]
    assert got[None][0]["kept"] and len(got[303]) == 2
    assert (got[304][0]["n_repeat_words"], got[304][0]["base_failed"]) == (72, True)
    odd = got[305][0]
    assert (odd["n_words"], odd["word_chars"], odd["n_symbols"], odd["n_dup_lines"]) == (5, 13, 7, 1)
    texts = {r["id"]: r["text"] for r in line_rules.strip_lines(docs, verdicts).collect()}
    assert texts[3] == unique("d", 40) and texts[200].startswith(head) and 304 not in texts
    assert line_rules.line_rules(docs.where("false")).count() == 0


# classifier


def test_ftrl_follows_its_definition():
    rng = np.random.default_rng(1)
    examples = [(np.sort(rng.choice(50, 5, replace=False)), rng.random(5) * 4, float(rng.random() < 0.5)) for _ in range(40)]
    z, n = [0.0] * 51, [0.0] * 51
    m = quality_model

    def weight(i):
        return 0.0 if abs(z[i]) <= m.L1 else -(z[i] - np.sign(z[i]) * m.L1) / ((m.BETA + n[i] ** 0.5) / m.ALPHA + m.L2)

    for _ in range(m.PASSES):
        for idx, x, y in examples:
            ws = [weight(i) for i in idx]
            p = 1 / (1 + np.exp(-sum(w * v for w, v in zip(ws, x))))
            for i, w, v in zip(idx, ws, x):
                g = (p - y) * v
                z[i] += g - ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / m.ALPHA * w
                n[i] += g * g
    assert m.ftrl(examples)[:50] == pytest.approx([weight(i) for i in range(50)], abs=1e-9)


def test_classifier_tells_junk(spark, make_docs):
    rng = random.Random(8)
    good = lambda: " ".join(rng.choice(["the", "river", "was", "wide", "and", "slow", "under", "trees"]) for _ in range(rng.randint(10, 60)))
    junk = lambda: " ".join(rng.choice(["BUY", "NOW", "win", "$$$"]) + "!!" for _ in range(rng.randint(10, 60)))
    texts = [(i, good() if i % 3 else junk()) for i in range(600)]
    docs = make_docs([*texts, (700, None), (701, ""), (None, "x")])
    labels = spark.createDataFrame([(i, int(i % 3 > 0), "x") for i in range(300)] + [(None, 1, "x"), (5, None, "x"), (0, 0, "x")], "doc_id long, quality int, score string")
    weights = quality_model.train(docs, labels)
    rows = quality_model.score(docs, weights).collect()
    assert len(rows) == len(texts) + 3 and all(0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["id"] is not None and 300 <= r["id"] < 600]
    assert sum((r["score"] >= 0.5) == (r["id"] % 3 > 0) for r in held) >= 0.97 * len(held)
    kept = quality_model.keep_good(docs, weights, least=0.5)
    assert kept.columns == docs.columns and kept.where("doc_id >= 300 and doc_id < 600").count() == sum(r["score"] >= 0.5 for r in held)
    nothing = quality_model.train(docs, labels.where("false"))
    assert not nothing.any() and quality_model.score(docs.where("false"), nothing).count() == 0


# chat rows


def test_tool_calls(spark):
    call = lambda i, name, args: '{"tool_calls": [{"id": %s, "name": "%s", "arguments": %s}]}' % (i, name, args)
    result = lambda i, text: '{"tool_call_id": "%s", "content": %s}' % (i, text)
    rows = [
        (1, 0, "user", "hello {"), (1, 1, "tool", result("a", '{"z": 1, "b": [2.50]}')), (1, 2, "assistant", call('"a"', "add", '{"y": 2, "x": 1}')),
        (1, 3, "assistant", '{"tool_calls": [{"id": "b", "name": "add", "arguments": {"x": "1"}}, {"id": "c", "name": "none", "arguments": {}}]}'), (1, 4, "tool", result("b", '"ok"')),
        (1, 5, "assistant", call('"a"', "add", '{"x": 1, "y": 2, "k": 0}')), (1, 6, "tool", result("q", "null")), (1, 7, "assistant", call("null", "add", "[1]")),
        (2, 0, "tool", result("a", '"elsewhere"')), (None, 0, "tool", result("a", '"x"')), (3, None, None, None), (3, 1, "user", ""), (3, 1, "user", ""),
        (3, 2, "assistant", '{"tool_calls": []}'), (3, 3, "tool", "not json"), (3, 4, "assistant", '{"broken'),
    ]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "conv_id long, turn long, role string, text string, kind string, json string")
    schemas = {"add": {"x": ("integer", True), "y": ("number", True)}}
    got = tool_calls.link_tool_calls(df, schemas).collect()
    one = sorted((r for r in got if r["conv_id"] == 1), key=lambda r: r["position"])
    assert [(r["turn"], r["call_no"], r["kind"], r["linked"]) for r in one] == [(0, 0, "message", False), (2, 0, "call", True), (1, 0, "result", True), (3, 0, "call", True), (3, 1, "call", False), (4, 0, "result", True), (5, 0, "call", True), (6, 0, "result", False), (7, 0, "call", False)]
    faults = {(r["turn"], r["call_no"]): r["faults"] for r in one}
    assert faults[2, 0] == [] and faults[3, 0] == ["x: not integer", "y: missing"] and faults[3, 1] == ["unknown tool"]
    assert faults[5, 0] == ["k: unknown", "repeated id"] and faults[7, 0] == ["arguments: not an object"]
    assert one[1]["json"] == '{"role":"assistant","tool_calls":[{"arguments":{"x":1,"y":2},"id":"a","name":"add"}]}'
    assert one[2]["json"] == '{"content":{"b":[2.5],"z":1},"role":"tool","tool_call_id":"a"}'
    rest = {(r["conv_id"], r["turn"], r["position"]): r for r in got if r["conv_id"] != 1}
    assert not rest[2, 0, 0]["linked"] and not rest[None, 0, 0]["linked"] and rest[3, None, 0]["json"] == "{}"
    assert [rest[3, t, p]["kind"] for t, p in ((1, 1), (1, 2), (2, 3), (3, 4), (4, 5))] == ["message"] * 5
    assert tool_calls.link_tool_calls(df.where("false"), schemas).count() == 0


def test_long_conversation_is_numbered_by_blocks(spark, monkeypatch):
    monkeypatch.setattr(tool_calls, "BLOCK", 7)
    df = spark.range(100).selectExpr("1L as conv_id", "id as turn", "'user' as role", "'x' as text")
    assert sorted((r["turn"], r["position"]) for r in tool_calls.link_tool_calls(df, {}).collect()) == [(i, i) for i in range(100)]
