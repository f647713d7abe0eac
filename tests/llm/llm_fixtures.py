"""Documents for the tests of this folder; the session comes from the folder above."""

import pytest

#: Names that the operators use inside, as extra columns of their input.
CLASH = ["id", "h", "n", "key", "keys", "top", "chunk", "label", "score", "start", "end", "tokens", "budget", "weight", "domain", "host", "mark", "uid", "v", "norm", "block", "json"]


@pytest.fixture
def make_docs(spark):
    """Documents of (id, text) or (id, text, lang, source) rows, with clashing extra columns."""

    def make(rows):
        rows = [(*r, *("en", "src1")[len(r) - 2 :]) if len(r) < 4 else r for r in rows]
        df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
        return df.selectExpr("*", "cast(length(text) as long) as n_chars", *[f"'x' as {c}" for c in CLASH])

    return make
