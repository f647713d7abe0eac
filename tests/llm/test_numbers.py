"""Tokens, mixes, top-k and the pipeline against brute force, with odd rows."""

import hashlib
import math
import random

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from llm_fixtures import make_docs  # noqa: F401
from paperloom.llm import bpe, mixing, topk
from paperloom.llm.queries import word_bpe_path

tokenizers = pytest.importorskip("tokenizers")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    t = tokenizers.Tokenizer.from_file(word_bpe_path())
    t.no_truncation()
    t.no_padding()
    return t


def odd_texts():
    rng = random.Random(1)
    yield from ("", "  ", "Hello World's it'S 123 été ΑΣ Σ İ ǅ ﬁ <|endoftext|> a<|startoftext|>b<|ENDOFTEXT|>", "日本語 👍🏽 \x00\x7f\x1c\x85　", "é ́x", "!" * 3000, "ab" * 4000, "ᲉꟋ x \U00033400", "the" * 5000 + " q", "word " * 70000 + "end")
    for _ in range(60):
        letters = rng.choice(["ab", "aeinrst", "abcdefghijklmnopqrstuvwxyz", "éèaeß日", "!?.*#", "thein"])
        yield "".join(rng.choice(letters) for _ in range(rng.randint(1, 4000)))
    for _ in range(300):
        yield "".join(chr(rng.choice([rng.randint(0, 0x250), rng.randint(0x250, 0xD7FF), rng.randint(0xE000, 0x1FFFF)])) for _ in range(20))


def test_tokens_equal_the_library(spark, make_docs, library):
    texts = list(odd_texts()) + [r[0] for r in duckdb.sql(f"SELECT text FROM '{SF}/documents.parquet'").fetchall()]
    docs = make_docs([*enumerate(texts), (None, "a b"), (None, None)])
    digests = {r["id"]: r for r in bpe.encode_digests(docs, word_bpe_path()).collect()}
    coded = {r["id"]: r for r in bpe.encode_decode(docs, word_bpe_path()).collect()}
    for i, text in enumerate(texts):
        ids = library.encode(text, add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert coded[i]["ids"] == ids and coded[i]["decoded"] == decoded
        assert digests[i]["n_tokens"] == len(ids)
        assert digests[i]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert digests[i]["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()
    assert bpe.encode_digests(docs, word_bpe_path()).where("id is null").count() == 2
    assert bpe.encode_digests(docs.where("false"), word_bpe_path()).count() == 0


def test_long_word_keeps_a_bounded_window(library):
    """Tokens leave while the word is still being read."""
    c = bpe.codec(word_bpe_path())
    read = [0]

    def chars():
        rng = random.Random(2)
        for _ in range(30000):
            read[0] += 1
            yield rng.choice("aeinrst")

    size = 0
    for token in c.merges.tokens(chars()):
        size += len(token)
        assert read[0] - size <= 5 * (c.merges.lookahead + c.merges.longest)


def test_words_come_back_from_the_older_generation(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 3)
    c = bpe.Codec(word_bpe_path())
    rng = random.Random(4)
    for _ in range(50):
        text = " ".join(rng.choice(["the", "a", "of", "Xylo", "qwrt", "ümlaut", "9", "don't"]) for _ in range(20))
        assert list(c.encode(text)) == library.encode(text, add_special_tokens=False).ids
        assert len(c.cache) <= 3 and len(c.older) <= 3


def test_new_words_are_merged_together(library, monkeypatch):
    """Words met for the first time in one piece of texts go through the rounds at once, not one by one."""
    c = bpe.Codec(word_bpe_path())
    rng = random.Random(7)
    words = list(dict.fromkeys("".join(rng.choice(rng.choice(["aeinrst", "é日ß👍", "abcdefghijklmnopqrstuvwxyz", "!?.*"])) for _ in range(rng.randint(1, 32))) for _ in range(9000)))
    raw = [w.encode() for w in words]
    together = {}
    for places, ids, sizes in c.merges.merge_words(raw):
        ends = sizes.cumsum()
        together |= {words[i]: ids[e - n : e].tolist() for i, e, n in zip(places, ends, sizes)}
    assert together == {w: list(c.word_ids(w)) for w in words}
    monkeypatch.setattr(bpe.MergeList, "merge", None)
    texts = [" ".join(words[i : i + 50]) for i in range(0, 3000, 50)]
    (out,) = bpe._coded(word_bpe_path())(iter([pa.record_batch([pa.array(range(60)), pa.array(texts)], names=["id", "text"])]))
    assert out.column("ids").to_pylist() == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_plain_text(library):
    c = bpe.codec(word_bpe_path())
    ids = c.encode("Ça va 👍🏽, l'été?<|endoftext|>")
    assert "".join(c.plain_text(ids)).replace(" ", "") == "çava👍🏽,l'été?<|endoftext|>"


# mixes


def fill(budget, kids):
    """Share by weight, again and again, until nobody is over capacity."""
    out, live = {}, {k: v for k, v in kids.items() if v[0] > 0 and v[1] > 0}
    while live:
        total = sum(w for w, _ in live.values())
        over = {k for k, (w, cap) in live.items() if cap <= budget * w / total}
        if not over:
            return out | {k: budget * w / total for k, (w, _) in live.items()}
        for k in over:
            out[k] = live[k][1]
        budget -= sum(live.pop(k)[1] for k in over)
    return out


def test_mix(spark, make_docs):
    rng = random.Random(9)
    rows = [(i, " ".join(["w"] * rng.randint(1, 40)), rng.choice(["en", "en", "en", "de", None]), rng.choice(["a1", "a1", "a1", "b1", "b2", "c1", None])) for i in range(700)]
    rows += [(800, None, "en", "a1"), (801, "", "en", "c1"), (802, "x y", "xx", "a1"), (803, "w w w", "en", "a1"), (803, "w w", "en", "a1"), (None, "w", "en", "a1"), (None, "w w", "en", "a1")]
    docs = make_docs(rows)
    w = {"domain": {"a": 1, "b": 5, "c": 4, "": 2}, "lang": {"en": 6, "de": 3, "": 1}, "source": {"a1": 1, "b1": 2, "b2": 1, "c1": 1, "": 1}}
    case = lambda level: F.expr("CASE " + " ".join(f"WHEN {level} = '{k}' THEN {v}" for k, v in w[level].items()) + " ELSE 0 END")
    got = mixing.mix(docs, F.substring("source", 1, 1), {k: case(k) for k in w}, percent=90, epochs=2).collect()
    assert len(got) == len(rows)
    leaf = lambda lang, source: ((source or "")[:1], lang or "", source or "")
    size = {}
    for _, text, lang, source in rows:
        size[leaf(lang, source)] = size.get(leaf(lang, source), 0) + len((text or "").split())
    cap = lambda *key: 2 * sum(v for k, v in size.items() if k[: len(key)] == key)
    kids = lambda *key: {k[len(key)] for k in size if k[: len(key)] == key}
    budget = {}
    for d, x in fill(math.floor(sum(size.values()) * 0.9), {d: (w["domain"].get(d, 0), cap(d)) for d in kids()}).items():
        for lang, y in fill(x, {k: (w["lang"].get(k, 0), cap(d, k)) for k in kids(d)}).items():
            for s, z in fill(y, {k: (w["source"].get(k, 0), cap(d, lang, k)) for k in kids(d, lang)}).items():
                budget[d, lang, s] = math.floor(z + 1e-6)
    want = []
    for key, tokens in size.items():
        mine = [(i, text) for i, text, lang, source in rows if leaf(lang, source) == key]
        whole, rest = divmod(budget.get(key, 0), tokens) if tokens else (0, 0)
        at = {}
        for i, text in mine:
            i = -(2**63) if i is None else i
            if text:
                h = int(hashlib.md5(f"1/{whole}/{i}".encode()).hexdigest()[:15], 16)
                at[h, i] = at.get((h, i), 0) + len(text.split())
        inside, run = set(), 0
        for (h, i), t in sorted(at.items()):
            run += t
            if run > rest:
                break
            inside.add(i)
        for i, text in mine:
            copies = whole + ((-(2**63) if i is None else i) in inside) if text else int(budget.get(key, 0) > 0)
            want.append((str(i), copies))
    assert sorted((str(r["doc_id"]), r["_copies"]) for r in got) == sorted(want)
    assert len({c for _, c in want}) >= 3
    mixed = mixing.mix(docs, F.substring("source", 1, 1), {k: case(k) for k in w}, percent=90)
    assert mixing.mixed_rows(mixed).columns == docs.columns and mixing.mixed_rows(mixed).count() == sum(c for _, c in want)
    assert mixing.mix(docs.where("false"), F.lit("a"), {k: case(k) for k in w}).count() == 0


# top-k


@pytest.mark.parametrize("block, tile", [(8192, 2048), (40, 3)])
def test_top_k(spark, monkeypatch, block, tile):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "TILE", tile)
    rng = random.Random(4)
    vectors = {i: [rng.gauss(0, rng.choice([0.05, 1, 3])) for _ in range(24)] for i in range(300)}
    for i in range(60, 90):
        vectors[i] = list(vectors[60])
    vectors |= {300: [0.0] * 24, 301: [1.0], 302: [-2.0] * 30, 303: [1e6] * 24}
    bad = [(400, None), (401, []), (402, [1.0, None]), (403, [float("nan")]), (404, [float("inf")]), (None, [1.0])]
    rows = [*vectors.items(), *bad, (60, vectors[60])]
    df = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], "vec_id long, embedding array<double>, id string, v string, norm int")
    ints = {i: [math.floor(64 * x) for x in v] for i, v in vectors.items()}
    want = []
    for q in (i for i in ints if i % 20 == 0):
        scored = sorted((-sum(a * b for a, b in zip(ints[q], v)), i) for i, v in ints.items() if i != q)
        want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:20])]
    got = topk.top_k(df, F.col("id") % 20 == 0).collect()
    assert sorted(tuple(r) for r in got) == sorted(want)
    few = topk.top_k(df.where("vec_id in (0, 1, 2)"), F.col("id") % 20 == 0).collect()
    assert len(few) == 2
    assert topk.top_k(df.where("false"), F.col("id") % 20 == 0).count() == 0
    assert topk.top_k(df.where("vec_id = 400"), F.col("id") % 20 == 0).count() == 0


# pipeline


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.collect()} if name != "near_copies" else None
        ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
        docs = corpus_pipeline.written(stage(spark, docs, SF), name).cache()
        assert {r["doc_id"] for r in docs.select("doc_id").collect()} <= ids and docs.count()
        if name != "tokens":
            assert docs.columns == columns
        if name == "passages":
            assert {r["doc_id"] for r in docs.collect()} == ids
            assert docs.where("n_chars <> length(text)").count() == 0
        if name == "tokens":
            library = tokenizers.Tokenizer.from_file(word_bpe_path())
            for r in docs.collect():
                assert r["ids"] == library.encode(before[r["doc_id"]], add_special_tokens=False).ids


def test_words_met_again_are_not_decoded_again(monkeypatch):
    calls = []
    decode = bpe.Codec.decode
    monkeypatch.setattr(bpe.Codec, "decode", lambda self, ids: calls.append(1) or decode(self, ids))
    bpe.codec.cache_clear()
    texts = pa.array(["one two one", "two  one\n", "", None])
    (out,) = bpe._coded(word_bpe_path())(iter([pa.record_batch([pa.array([1, 2, 3, 4]), texts], names=["id", "text"])]))
    bpe.codec.cache_clear()
    assert len(calls) == 2
    ids, decoded = out.column("ids").to_pylist(), out.column("decoded").to_pylist()
    assert ids[0][0] == ids[0][-1] and len(ids[0]) == len(ids[1]) + len(ids[0]) // 3 and ids[2:] == [[], []] and decoded[2:] == ["", ""]
    assert decoded[0] == " ".join([decoded[0].split(" ")[0], decoded[1]])


def test_pipeline_tokens_forget_words_after_a_task():
    batch = pa.record_batch([pa.array([1]), pa.array(["some words that a worker must not keep"])], names=["id", "text"])
    (out,) = bpe._coded(word_bpe_path())(iter([batch]))
    assert out.column(1)[0].as_py()
    c = bpe.codec(word_bpe_path())
    assert not c.cache and not c.older
