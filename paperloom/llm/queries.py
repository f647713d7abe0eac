"""One registered query per operator, over whole tables, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.llm import bpe, chaining, hard_negatives, license_scan, line_rules, mixing, ngram_join, quality_model, token_files, tool_calls, topk, url_templates, word_runs
from paperloom.session import work_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1 = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({LOWER.format("text")}, '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 OR ws IS NULL THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) END) AS g FROM w),
classes AS (SELECT list_sort(g) AS g, min(doc_id) AS lead, len(any_value(g)) AS n FROM s WHERE len(g) > 0 GROUP BY list_sort(g)),
x AS (SELECT lead, n, unnest(g) AS t FROM classes),
pairs AS (
  SELECT a.lead AS p, b.lead AS q FROM x a JOIN x b ON a.t = b.t AND a.lead < b.lead AND 10 * least(a.n, b.n) >= 9 * greatest(a.n, b.n)
  GROUP BY a.lead, b.lead, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
e AS (SELECT p, q FROM pairs UNION ALL SELECT q, p FROM pairs),
r(node, reach) AS (SELECT lead, lead FROM classes UNION SELECT r.node, e.q FROM r JOIN e ON r.reach = e.p),
c AS (SELECT node, min(reach) AS component FROM r GROUP BY node)
SELECT s.doc_id, CAST(len(s.g) AS BIGINT) AS n_shingles, coalesce(c.component, s.doc_id) AS component_id
FROM s LEFT JOIN classes k ON list_sort(s.g) = k.g LEFT JOIN c ON c.node = k.lead
"""


@query("op1_ngram_jaccard_join", OP1)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-copy components of documents at 3-word shingles and a similarity of 0.9."""
    found = ngram_join.jaccard_components(table(spark, sf_dir, "documents"), n=3, percent=90)
    return found.withColumnRenamed("id", "doc_id")


def word_bpe_path() -> str:
    """The tokenizer file, as its package names it; installed alike on every executor."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op8_bpe_stream")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document's ids and decoded text."""
    return bpe.encode_digests(table(spark, sf_dir, "documents"), word_bpe_path()).withColumnRenamed("id", "doc_id")


OP6 = rf"""
WITH t AS (
  SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
l AS (SELECT doc_id, host, unnest(string_split(text, chr(10))) AS line FROM t),
m AS (SELECT doc_id, host, line, regexp_extract_all(regexp_replace({LOWER.format("line")}, '[0-9]', '0', 'g'), '[^\x20\x09-\x0D]+') AS ws FROM l),
filled AS (SELECT doc_id, host, line, array_to_string(ws, ' ') AS norm, len(ws) AS n FROM m WHERE len(ws) > 0),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM filled GROUP BY doc_id),
common AS (SELECT host, norm FROM filled GROUP BY host, norm HAVING count(DISTINCT doc_id) > 20),
gone AS (SELECT doc_id, sum(n) AS gone FROM filled JOIN common USING (host, norm) GROUP BY doc_id),
g AS (SELECT doc_id, unnest(range(1, len(ws) - 6)) AS i, ws FROM t WHERE len(ws) >= 8),
h AS (SELECT doc_id, i, array_to_string(ws[i:i + 7], ' ') AS gram FROM g),
again AS (SELECT doc_id, gram FROM h GROUP BY doc_id, gram HAVING count(*) > 1),
spot AS (SELECT DISTINCT doc_id, unnest(range(i, i + 8)) AS p FROM h JOIN again USING (doc_id, gram)),
rep AS (SELECT doc_id, count(*) AS n_repeat_words FROM spot GROUP BY doc_id),
b AS (
  SELECT t.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(gone, 0) AS gone
  FROM t LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id) LEFT JOIN gone USING (doc_id)),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND 100 * (n_words - gone) >= 30 * n_words AS kept FROM f
"""


@query("op6_line_rules", OP6)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document; its source stands for its host."""
    rows = line_rules.line_rules(table(spark, sf_dir, "documents"))
    return rows.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


@query("op7_quality_ftrl")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from labels outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    weights = quality_model.train(docs, table(spark, sf_dir, "labels"), learnable=~held_out())
    rows = quality_model.score(docs, weights).withColumnRenamed("id", "doc_id")
    return rows.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


OP10 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings),
p AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p) WHERE rank <= 20
"""


@query("op10_norm_sorted_topk", OP10)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 highest inner products of every twentieth vector against all others."""
    found = topk.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)
    return found.withColumnRenamed("id", "vec_id")


#: Fixed rules of the url query.
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


@query("op3_url_templates")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of every page's url."""
    found = url_templates.url_verdicts(table(spark, sf_dir, "pages"), URL_RULES)
    return found.withColumnRenamed("id", "page_id")


def _op4_sql() -> str:
    spots, blocks = [], []
    for phrase, label in license_scan.PHRASES:
        size = len(phrase.split(" "))
        spots.append(f"SELECT doc_id, '{label}' AS label, unnest(list_filter(range(1, len(ws) + 1), lambda i: array_to_string(ws[i:i + {size - 1}], ' ') = '{phrase}')) - 1 AS p FROM w")
    for label, text in license_scan.TEMPLATES:
        words = sorted(set(text.split(" ")))
        c = license_scan.needed(len(words), license_scan.CONTAINMENT)
        blocks.append(f"SELECT doc_id, '{label}' AS label, len(list_intersect(ws, {words!r})) / {len(words)}::DOUBLE AS s FROM l WHERE len(list_intersect(ws, {words!r})) >= {c}")
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    half = max(len(text.split(" ")) for _, text in license_scan.TEMPLATES)
    return f"""
WITH t AS (SELECT doc_id, {LOWER.format("coalesce(text, '')")} AS text FROM documents),
w AS (SELECT doc_id, regexp_extract_all(text, '{pattern}') AS ws, contains(text, chr(10)) AS wrapped FROM t),
l AS (SELECT doc_id, regexp_extract_all(line, '{pattern}') AS ws FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM t)
  UNION ALL SELECT doc_id, unnest(list_transform(range(0, greatest(1, CAST(ceil((len(ws) - {half}) / {half}) AS INTEGER))), lambda i: ws[i * {half} + 1:(i + 2) * {half}])) FROM w WHERE wrapped),
spots AS ({" UNION ALL ".join(spots)}),
blocks AS ({" UNION ALL ".join(blocks)}),
b AS (SELECT doc_id, count(*) AS n_base, min(p) AS first_word, max(p) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM spots GROUP BY doc_id),
a AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT doc_id, label FROM spots UNION SELECT doc_id, label FROM blocks) GROUP BY doc_id),
s AS (SELECT doc_id, max(s) AS s FROM blocks GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(s, 0.0::DOUBLE) END AS score
FROM w LEFT JOIN b USING (doc_id) LEFT JOIN a USING (doc_id) LEFT JOIN s USING (doc_id)
"""


@query("op4_license_scan", _op4_sql())
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and template blocks of every document."""
    return license_scan.license_scan(table(spark, sf_dir, "documents"), across=True)[0].withColumnRenamed("id", "doc_id")


#: The tool that the chat query sees in each question.
CHAT_SCHEMAS = {"reply": {"prompt": ("string", True), "chars": ("integer", True), "opening": ("boolean", False)}}

OP9 = """
WITH m AS (
  SELECT conv_id, turn, role, text, CASE role WHEN 'user' THEN 'call' WHEN 'assistant' THEN 'result' ELSE 'message' END AS kind,
    CASE role WHEN 'user' THEN conv_id || ':' || turn WHEN 'assistant' THEN conv_id || ':' || (turn - 1) END AS call_id FROM conversations),
j AS (
  SELECT conv_id, turn, kind, call_id,
    CASE kind
      WHEN 'call' THEN '{"role":"assistant","tool_calls":[{"arguments":{"chars":' || length(text) || CASE WHEN turn < 4 THEN ',"opening":' || (turn = 0) ELSE ',"opening":' || turn END
        || ',"prompt":' || to_json(text) || '},"id":"' || call_id || '","name":"reply"}]}'
      WHEN 'result' THEN '{"content":' || to_json(text) || ',"role":"tool","tool_call_id":"' || call_id || '"}'
      ELSE '{"content":' || to_json(text) || ',"role":"' || role || '"}' END AS json,
    CASE WHEN kind = 'call' AND turn >= 4 THEN 'opening: not boolean' ELSE '' END AS faults FROM m)
SELECT a.conv_id, a.turn, a.kind, a.call_id, coalesce(b.call_id IS NOT NULL AND a.kind <> b.kind, false) AS linked, a.faults,
  row_number() OVER (PARTITION BY a.conv_id ORDER BY a.turn) - 1 AS position, a.json
FROM j a LEFT JOIN j b ON a.conv_id = b.conv_id AND a.call_id = b.call_id AND a.kind <> b.kind
"""


def question_calls(conversations: DataFrame) -> DataFrame:
    """Conversations with each question as a tool call and each answer as the result of the turn before."""
    conv, turn = F.col("conv_id").cast("string"), F.col("turn")
    opening = lambda c: F.struct(F.col("text").alias("prompt"), F.length("text").alias("chars"), c.alias("opening"))
    of = lambda c: F.to_json(F.struct(F.array(F.struct(F.concat(conv, F.lit(":"), turn).alias("id"), F.lit("reply").alias("name"), opening(c).alias("arguments"))).alias("tool_calls")))
    call = F.when(turn < 4, of(turn == 0)).otherwise(of(turn))
    result = F.to_json(F.struct(F.concat(conv, F.lit(":"), turn - 1).alias("tool_call_id"), F.col("text").alias("content")))
    role = F.when(F.col("role") == "user", "assistant").when(F.col("role") == "assistant", "tool").otherwise(F.col("role"))
    text = F.when(F.col("role") == "user", call).when(F.col("role") == "assistant", result).otherwise(F.col("text"))
    return conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"))


@query("op9_tool_calls", OP9)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Linked, checked and serialised messages of every conversation, questions seen as tool calls."""
    rows = tool_calls.link_tool_calls(question_calls(table(spark, sf_dir, "conversations")), CHAT_SCHEMAS)
    return rows.select("conv_id", "turn", "kind", "call_id", "linked", F.array_join("faults", "; ").alias("faults"), "position", "json")


#: Domains of the sources and the weights of the mix.
DOMAIN = "CASE WHEN source = 'src0' THEN 'web' WHEN length(source) = 4 THEN 'reference' ELSE 'forum' END"
WEIGHTS = {
    "domain": "CASE domain WHEN 'web' THEN 40 WHEN 'reference' THEN 35 ELSE 25 END",
    "lang": "CASE lang WHEN 'en' THEN 60 WHEN 'de' THEN 15 WHEN 'fr' THEN 15 ELSE 10 END",
    "source": "1",
}


def _fill_sql(depth: int) -> str:
    keys = mixing.LEAF[:depth]
    parent, name = keys[:-1], keys[-1]
    part = f"PARTITION BY {', '.join(parent)}" if parent else ""
    given = f"JOIN a{depth - 1} g USING ({', '.join(parent)})" if parent else "CROSS JOIN a0 g"
    cols = ", ".join(f"n.{k}" for k in keys)
    return f"""
n{depth} AS (SELECT {", ".join(keys)}, CAST(sum(2 * tokens) AS BIGINT) AS cap, {WEIGHTS[name]} AS weight FROM leaves GROUP BY ALL),
r{depth} AS (SELECT {cols}, n.cap, n.weight, g.amount AS budget, n.cap / n.weight AS ratio FROM n{depth} n {given}),
l{depth} AS (SELECT *, row_number() OVER ({part} ORDER BY ratio, {name}) AS turn,
    (budget - coalesce(sum(cap) OVER ({part} ORDER BY ratio, {name} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER ({part} ORDER BY ratio, {name} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM r{depth}),
m{depth} AS (SELECT *, arg_min(CASE WHEN ratio > level THEN level END, CASE WHEN ratio > level THEN turn END) OVER ({part}) AS set_level FROM l{depth}),
a{depth} AS (SELECT {", ".join(keys)}, CASE WHEN set_level IS NULL THEN cap::DOUBLE ELSE least(cap::DOUBLE, set_level * weight) END AS amount FROM m{depth})"""


OP5 = rf"""
WITH d AS (
  SELECT doc_id, {DOMAIN} AS domain, lang, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS tokens FROM documents),
leaves AS (SELECT domain, lang, source, CAST(sum(tokens) AS BIGINT) AS tokens FROM d WHERE tokens > 0 GROUP BY ALL),
a0 AS (SELECT floor(sum(tokens) * 100 / 100)::DOUBLE AS amount FROM leaves),
{_fill_sql(1)},{_fill_sql(2)},{_fill_sql(3)},
b AS (SELECT domain, lang, source, tokens AS size, CAST(floor(amount + 1e-6) AS BIGINT) AS budget FROM leaves JOIN a3 USING (domain, lang, source)),
w AS (SELECT *, CAST(floor(budget / size) AS BIGINT) AS whole FROM b),
h AS (SELECT d.*, whole, budget - whole * size AS rest, budget, ('0x' || substr(md5('1/' || whole || '/' || doc_id), 1, 15))::BIGINT AS h FROM d JOIN w USING (domain, lang, source)),
c AS (SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY h, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM h)
SELECT doc_id, domain, lang, source, tokens, CAST(CASE WHEN tokens = 0 THEN (budget > 0)::INT ELSE whole + (rest > 0 AND run <= rest)::INT END AS INTEGER) AS copies FROM c
WHERE copies > 0
"""


def mixed(docs: DataFrame) -> DataFrame:
    return mixing.mix(docs, F.expr(DOMAIN), {k: F.expr(v) for k, v in WEIGHTS.items()})


@query("op5_source_mix", OP5)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of a mix as large as the corpus, with the copies that each contributes."""
    rows = mixed(table(spark, sf_dir, "documents")).where("_copies > 0")
    return rows.select("doc_id", F.expr(DOMAIN).alias("domain"), "lang", "source", mixing.words_of(F.col("text")).alias("tokens"), F.col("_copies").alias("copies"))


@query("op2_chained_passages")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that repeat one of a document with a smaller id."""
    found = chaining.repeated_passages(table(spark, sf_dir, "documents"))
    return found.withColumnRenamed("id", "doc_id").withColumnRenamed("other_id", "other_doc_id")


OP11 = """
WITH r AS (
  SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS VARCHAR) AS label, embedding AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS (SELECT vec_id, label, list_transform(e, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM r),
p AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_inner_product(CAST(a.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id),
pos AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS n FROM p WHERE same) WHERE n <= 5),
neg AS (
  SELECT pos.anchor_id, pos.vec_id AS positive_id, p.vec_id AS negative_id, pos.score AS positive_score, p.score AS negative_score,
    row_number() OVER (PARTITION BY pos.anchor_id, pos.vec_id ORDER BY p.score DESC, p.vec_id) AS rank
  FROM pos JOIN p ON pos.anchor_id = p.anchor_id AND NOT p.same AND 30 * pos.score <= 100 * p.score AND 100 * p.score <= 90 * pos.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM neg WHERE rank <= 10
"""


@query("op11_hard_negatives", OP11)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten hard negatives for each of the five positives of every hundredth vector."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, label)


#: Id that ends each document in the token files.
END_ID = 2


@query("op12_token_orc")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offsets, lengths and checksums of all documents' ids, from the ORC files written and read back."""
    path = work_path(spark, "token-files")
    token_files.write_tokens(table(spark, sf_dir, "documents"), path, word_bpe_path(), END_ID)
    return token_files.checksums(token_files.read_tokens(spark, path))


def replayed(docs: DataFrame) -> DataFrame:
    """``doc_id, text``; texts whose id has a crc32 divisible by ten repeat a part of their words up to the end."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    rows = docs.select("doc_id", "text", h.alias("h"), F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("ws"))
    n = F.size("ws")
    rows = rows.withColumn("a", F.when(n > 0, F.col("g") % n).cast("int"))
    rows = rows.withColumn("p", (1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    at = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    again = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get("ws", at(i)))
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


@query("op13_word_runs")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number, longest and digest of the runs of every document's words, and a digest of the words kept."""
    found = word_runs.word_runs(replayed(table(spark, sf_dir, "documents")))
    order = lambda r: F.struct(r["length"].alias("a"), (-r["start"]).alias("b"), (-r["period"]).alias("c"))
    top = F.array_max(F.transform("runs", lambda r: F.struct(order(r).alias("order"), r.alias("run"))))["run"]
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    rows = found.withColumn("top", top)
    return rows.select(
        F.col("id").alias("doc_id"),
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"top.{c}").alias(c) for c in ("start", "length", "period")],
        F.floor(1000 * F.col("top.length") / F.col("top.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
