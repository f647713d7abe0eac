"""Stages of the pipeline against brute force on the smallest tables, and passages against all exact runs there."""

import corpus_pipeline
import pytest

from paperloom.llm import chaining, queries
from test_near_copies import brute_components

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def texts_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_quality_keeps_what_the_query_predicts(spark, docs):
    kept = corpus_pipeline.quality(spark, docs, SF)
    good = queries.QUERIES["op7_quality_ftrl"](spark, SF).where("predicted = 1")
    assert kept.columns == docs.columns
    assert sorted(i for i, _ in texts_of(kept)) == sorted(r["doc_id"] for r in good.collect())


def test_near_copies_keep_one_of_each_component(spark, docs):
    rows = texts_of(docs)
    kept = corpus_pipeline.near_copies(spark, docs, SF)
    assert sorted(texts_of(kept)) == sorted((i, t) for i, t in rows if i in set(brute_components(rows, 5, 80).values()))


def test_passages_cover_all_exact_runs(spark, docs):
    """Words in a stretch of 50 that also stands in a document with a smaller id: nearly all lie in a span, and go."""
    least, seen, asked = 50, set(), {}
    lower = {c: c + 32 for c in range(65, 91)}
    for i, text in sorted(texts_of(docs)):
        words = [w.decode() for w in (text or "").translate(lower).encode().split()]
        grams = [tuple(words[a : a + least]) for a in range(len(words) - least + 1)]
        asked[i] = {a + k for a, g in enumerate(grams) if g in seen for k in range(least)}
        seen.update(grams)
    found = {}
    for r in chaining.repeated_passages(docs).collect():
        found.setdefault(r["id"], set()).update(range(r["start"], r["end"]))
    total = sum(map(len, asked.values()))
    missed = sum(len(a - found.get(i, set())) for i, a in asked.items())
    assert total > 1000 and missed <= 0.001 * total
    left = dict(texts_of(corpus_pipeline.passages(spark, docs, SF)))
    for i, text in texts_of(docs):
        assert len((left[i] or "").encode().split()) == len((text or "").encode().split()) - len(found.get(i, ()))
