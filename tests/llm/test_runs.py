"""Periodic runs and token files against brute force and the library, with odd rows."""

import hashlib
import random
import zlib

import duckdb
import numpy as np
import pyarrow.orc as orc
import pytest
from pyspark.sql import functions as F

from llm_fixtures import make_docs  # noqa: F401
from paperloom.llm import queries, token_files, word_runs
from paperloom.session import work_path

tokenizers = pytest.importorskip("tokenizers")
SF = "/root/testdata/sf0.001"


def longest_lyndon(v):
    ends = []
    for i in range(len(v)):
        j = i + 1
        while j < len(v) and v[j:] > v[i:]:
            j += 1
        ends.append(j - i)
    return ends


def all_runs(v, least=12):
    """Every stretch with equal words q apart that no neighbour extends, at its smallest period."""
    found = {}
    for q in range(1, len(v) // 2 + 1):
        i = 0
        while i + q < len(v):
            if v[i] != v[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(v) and v[j] == v[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q):
                found.setdefault((i, j + q), q)
            i = j
    return sorted((s, e - s, q) for (s, e), q in found.items())


def kept_words(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def sequences():
    rng = random.Random(5)
    yield from ([], [0], [0] * 40, [i % 7 for i in range(90)], [bin(i).count("1") & 1 for i in range(128)])
    a, b = [0], [0, 1]
    while len(b) < 200:
        a, b = b, b + a
    yield b
    for _ in range(300):
        k, n = rng.randint(1, 4), rng.randint(1, 60)
        v = [rng.randrange(k) for _ in range(n)]
        if rng.random() < 0.5:
            p = rng.randint(1, 8)
            v = [v[i % min(p, n)] if rng.random() > 0.03 else rng.randrange(k) for i in range(n)]
        yield v


def test_lyndon_words_of_both_orders():
    for v in sequences():
        if v:
            assert word_runs.lyndon_lengths(np.array(v)).tolist() == longest_lyndon(v)
            assert word_runs.lyndon_lengths(-np.array(v)).tolist() == longest_lyndon([-x for x in v])


@pytest.mark.parametrize("least", [2, 4, 12])
def test_runs_of_sequences(least):
    for v in sequences():
        cut = len(v) // 3
        got = [tuple(r) for r in word_runs.runs_of(np.array(v, np.int64), np.array([0, cut, cut, len(v)]), least).tolist()]
        assert got == all_runs(v[:cut], least) + [(s + cut, n, q) for s, n, q in all_runs(v[cut:], least)]


def test_word_runs_with_odd_rows(spark, make_docs):
    rng = random.Random(6)
    texts = [None, "", " \n\t", "a", "a " * 11, "a " * 12, "x\x0by " * 9, "x\x85y " * 9, "é　ü b " * 7 + "é　ü", "Ab ab " * 6, "p q r " * 4 + "z " + "p q r " * 4]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randint(1, 90))) for _ in range(60)]
    docs = make_docs([*enumerate(texts), (None, "k l " * 8), (5, texts[5])])
    got = word_runs.word_runs(docs).collect()
    assert len(got) == len(texts) + 2
    texts = dict(enumerate(texts)) | {None: "k l " * 8}
    for r in got:
        words = [w.decode() for w in (texts[r["id"]] or "").encode().split()]
        runs = all_runs(words)
        assert r["n_words"] == len(words) and [tuple(x) for x in r["runs"]] == runs
        assert r["collapsed"] == kept_words(words, runs)
    assert word_runs.word_runs(docs.where("false")).count() == 0


def test_very_long_text(spark, make_docs):
    words = [str(i % 1000) for i in range(100000)] + [f"w{i}" for i in range(100000)]
    r = word_runs.word_runs(make_docs([(1, " ".join(words))])).first()
    assert [tuple(x) for x in r["runs"]] == [(0, 100000, 1000)]
    assert r["collapsed"] == " ".join(words[:1000] + words[100000:])


def test_registered_runs(spark):
    got = {r["doc_id"]: r for r in queries.QUERIES["op13_word_runs"](spark, SF).collect()}
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    assert len(got) == len(rows)
    changed = 0
    for doc_id, text in rows:
        words = [w.decode() for w in (text or "").encode().split()]
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
            changed += 1
        if n > 3000:  # the plain search takes the square of a text's words
            continue
        runs = all_runs(words)
        r = got[doc_id]
        top = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else (None, None, None)
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(runs), *top)
        assert r["exponent_milli"] == (1000 * top[1] // top[2] if runs else None)
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(kept_words(words, runs).encode()).hexdigest()
    assert changed


# token files


@pytest.fixture(scope="module")
def library():
    t = tokenizers.Tokenizer.from_file(queries.word_bpe_path())
    t.no_truncation()
    t.no_padding()
    return t


def test_words_give_the_ids_of_the_text(library, monkeypatch):
    """Ids of words in a row are those of the text, with words remembered or forgotten."""
    monkeypatch.setattr(token_files, "WORDS", 20)
    rng = random.Random(8)
    bits = ["uń", "deux's", "ΑΣ", "Σ　x", "e\u0301", "\u0301", "\x1c", "\x85a", "\x0b", "\t", "\r", "<|endoftext|>", "a<|startoftext|>'S", "İ", "...", "!?", "👍🏽", "9", "x" * 90, "Straße,", "ŉa.)", "ǅ", "don't'", "ab<|", "ABC!!", "ÉÀ", "e-", "İstanbul.", "\u3000", "日本"]
    encoder = token_files.WordEncoder(queries.word_bpe_path())
    for _ in range(200):
        texts = ["".join(rng.choice([*bits, " ", " ", "\n", "  "]) for _ in range(rng.randint(0, 40))) for _ in range(5)]
        for text, ids in zip(texts, encoder.encode(texts)):
            assert np.frombuffer(ids, np.int32).tolist() == library.encode(text, add_special_tokens=False).ids
    assert len(encoder.new) <= 20 + 300 and all(len(w) <= token_files.LONG for w in encoder.new)


def test_token_files(spark, make_docs, library, monkeypatch):
    rng = random.Random(3)
    texts = [None, "", "  ", "Hello <|endoftext|> World", "word " * 90000 + "end", "x" * 3000]
    texts += [" ".join(rng.choice(["the", "Été", "日本", "12", "!?"]) for _ in range(rng.randint(1, 50))) for _ in range(3000)]
    rows = list(enumerate(texts)) + [(7, texts[7])] * 5 + [(None, "a b")]
    rng.shuffle(rows)
    docs = make_docs(rows)
    path = work_path(spark, "files")
    token_files.write_tokens(docs, path, queries.word_bpe_path(), 2, files=3)
    read = token_files.read_tokens(spark, path)
    got = sorted((r["start"], r["doc_id"], r["ids"]) for r in read.collect())
    want, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        want.append((start, doc_id, ids))
        start += len(ids)
    assert got == want
    sums = {r["doc_id"]: r for r in token_files.checksums(read).collect()}
    for start, doc_id, ids in want:
        assert sums[doc_id]["n_tokens"] == len(ids)
        assert sums[doc_id]["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
    assert [(r["doc_id"], r["ids"]) for r in token_files.lookup(spark, path, [2000, 10**9]).collect()] == [(2000, library.encode(texts[2000], add_special_tokens=False).ids + [2])]
    empty = work_path(spark, "files")
    token_files.write_tokens(docs.where("false"), empty, queries.word_bpe_path(), 2)
    assert token_files.checksums(token_files.read_tokens(spark, empty)).count() == 0


def test_files_skip_what_is_not_asked(spark, make_docs, monkeypatch):
    """Even ids only: an odd id lies between the statistics of its row group, and the Bloom filter rules it out."""
    docs = make_docs([(2 * i, "a b c") for i in range(6000)])
    path = work_path(spark, "files")
    token_files.write_tokens(docs, path, queries.word_bpe_path(), 2, files=2)

    def rows_read(ids):
        found = token_files.lookup(spark, path, ids)
        found.collect()
        plan = found._jdf.queryExecution().executedPlan()
        return plan.collectLeaves().head().metrics().apply("numOutputRows").value()

    assert rows_read([5000]) <= token_files.ROWS
    assert rows_read([5001]) == 0
    assert rows_read([10**7]) == 0
    import glob

    names = sorted(glob.glob(f"{path}/*.orc"))
    assert len(names) == 2
    for name in names:
        file = orc.ORCFile(name)
        assert file.row_index_stride == token_files.ROWS and file.compression == "ZSTD"


def test_registered_token_files(spark, library):
    got = {r["doc_id"]: r for r in queries.QUERIES["op12_token_orc"](spark, SF).collect()}
    start = 0
    for doc_id, text in duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall():
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        assert tuple(got[doc_id]) == (doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
