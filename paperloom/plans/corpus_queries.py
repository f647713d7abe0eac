"""Queries over corpora and streams."""

from pyspark.sql import functions as F

from paperloom.operators import corpus as K
from paperloom.operators import papers as P
from paperloom.plans.adapters import PARAGRAPHS, SENTENCES, document_papers, paragraphs, sentences, table, text
from paperloom.plans.paper_queries import _SENTENCE_ROWS
from paperloom.plans.registry import query
from paperloom.session import stored, work_path
from paperloom.sources.files import decode_text
from paperloom.streaming import ingest as G

_FILES = """files AS (SELECT concat(event_type, '/', user_id) AS archive, event_id, concat('f', event_id, CASE event_id % 4 WHEN 0 THEN '.tex' WHEN 1 THEN '.txt' WHEN 2 THEN '.PDF' ELSE '.bbl' END) AS file,
      value > 60 AS main, event_id % 4 AS k FROM events),
    best AS (SELECT archive, arg_max(file, (k = 0, file)) FILTER (main AND k <> 2) AS file FROM files GROUP BY archive)"""


def _archives(spark, sf_dir):
    ending = F.get(F.array(*[F.lit(x) for x in (".tex", ".txt", ".PDF", ".bbl")]), (F.col("event_id") % 4).cast("int"))
    content = F.when(F.col("value") > 60, "% c\n\\begin { document} x").otherwise("\\begin{figure} document")
    rows = table(spark, sf_dir, "events").select(text("{event_type}/{user_id}").alias("archive"), text("f{event_id}", ending).alias("file"), content.alias("content"))
    return K.primary_sources(rows)


@query("f1_primary_source", f"WITH {_FILES} SELECT archive, file FROM best WHERE file IS NOT NULL")
def f1_primary_source(spark, sf_dir):
    return _archives(spark, sf_dir)[0]


@query("f1_no_primary_source", f"WITH {_FILES} SELECT archive, 'no_main_file' AS reason FROM best WHERE file IS NULL")
def f1_no_primary_source(spark, sf_dir):
    return _archives(spark, sf_dir)[1]


@query(
    "f2_commands",
    r"""SELECT p_partkey, concat('As \cite{k', p_partkey, '} and \cite{a,b} in ', p_name, ' \cite{z}; \bibitem{q', p_size, '} end') AS text FROM part""",
)
def f2_commands(spark, sf_dir):
    k = F.col("p_partkey") % 3
    form = F.when(k == 0, "\\citep[see][p. 2]{k").when(k == 1, "\\citet*{k").otherwise("\\CiteAlt {k")
    raw = F.concat(
        F.lit("As "), form, F.col("p_partkey").cast("string"), F.lit("} and \\citeauthor{a,b} in "), F.col("p_name"),
        F.lit(" \\cite{z}; \\bibitem[Lee(2015)]{q"), F.col("p_size").cast("string"), F.lit("} end"),
    )
    return table(spark, sf_dir, "part").select("p_partkey", K.normalise_commands(raw).alias("text"))


@query(
    "f3_math_removal",
    r"""SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN concat('No start $x', p_size, '$ kept') ELSE concat('Pre $a$ \begin{document} Let ', chr(10), ' be ', p_name, ' or  and  so  end') END AS text FROM part""",
)
def f3_math_removal(spark, sf_dir):
    whole = F.concat(
        F.lit("Pre $a$ \\begin{document} Let $x_"), F.col("p_size").cast("string"), F.lit("$\n be "), F.col("p_name"),
        F.lit(" or \\begin{align*}a\n&b\\end{align} and $$y\n$$ so \\[z\\]\\(w\\) end"),
    )
    raw = F.when(F.col("p_partkey") % 5 == 0, text("No start $x", "{p_size}", "$ kept")).otherwise(whole)
    return table(spark, sf_dir, "part").select("p_partkey", K.remove_math(raw).alias("text"))


@query(
    "f4_quality_warnings",
    f"""WITH {PARAGRAPHS}
    SELECT doc_id, 'warn_no_bibs' AS reason FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
    UNION ALL SELECT doc_id, 'warn_no_body' FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM paragraphs WHERE para_no > 0 AND trim(para_text) <> '')
    UNION ALL SELECT doc_id, 'err_unicode_decode' FROM documents WHERE doc_id % 2 = 1 AND regexp_matches(text, '[\\x80-\\xFF]')""",
)
def f4_quality_warnings(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    bodies = paragraphs(spark, sf_dir).where("para_no > 0 and trim(para_text) <> ''")
    latin = F.encode(F.regexp_replace("text", r"[^\x00-\xFF]", "?"), "ISO-8859-1")
    content = F.when(F.col("doc_id") % 2 == 0, F.encode("text", "UTF-8")).otherwise(latin)
    bad = docs.where(content.cast("string") != decode_text(content))
    return K.quality_warnings(docs.select("doc_id"), table(spark, sf_dir, "labels"), bodies, bad)


_LATEST = """SELECT event_type AS dataset, concat(user_id, '.json') AS filename, max_by(event_id, (ts, event_id)) AS file_id FROM events GROUP BY 1, 2"""


def _announced(spark, sf_dir):
    return table(spark, sf_dir, "events").select(F.col("event_type").alias("dataset"), text("out/{user_id}.json").alias("filename"), F.col("event_id").alias("file_id"), "ts")


@query("f5_replace_outputs", _LATEST)
def f5_replace_outputs(spark, sf_dir):
    return K.latest_outputs(_announced(spark, sf_dir), ["ts", "file_id"]).select("dataset", "filename", "file_id")


_WORDS = SENTENCES + """,
    words AS (SELECT doc_id, para_no, sent_no, unnest(l) AS word, generate_subscripts(l, 1) AS k FROM (SELECT doc_id, para_no, sent_no, regexp_extract_all(lower(sentence), '[^ .,;:!?]+') AS l FROM sentences)),
    counts AS (SELECT word, count(*) AS n FROM words GROUP BY word),
    vocab AS (SELECT word, n, CAST(row_number() OVER (ORDER BY n DESC, substr(md5(word), 1, 3), word) + 2 AS BIGINT) AS id FROM counts)"""


@query("f6_vocabulary", f"WITH {_WORDS} SELECT word, id FROM vocab")
def f6_vocabulary(spark, sf_dir):
    words = K.sentence_words(sentences(spark, sf_dir), ["doc_id", "para_no", "sent_no"]).where("word is not null")
    return K.vocabulary(words)


@query(
    "f6_token_windows",
    f"""WITH {_WORDS}, ids AS (SELECT doc_id, para_no, sent_no, CAST((k - 1) // 126 AS INTEGER) AS window_no, string_agg(CAST(id AS VARCHAR), ' ' ORDER BY k) AS s, count(*) AS c FROM words JOIN vocab USING (word) GROUP BY 1, 2, 3, 4)
    SELECT s.doc_id, s.para_no, s.sent_no, coalesce(i.window_no, 0) AS window_no, concat('1 ', CASE WHEN i.s IS NULL THEN '' ELSE concat(i.s, ' ') END, '2', repeat(' 0', CAST(126 - coalesce(i.c, 0) AS INTEGER))) AS ids, CAST(coalesce(i.c, 0) + 2 AS INTEGER) AS tokens
    FROM sentences s LEFT JOIN ids i ON s.doc_id = i.doc_id AND s.para_no = i.para_no AND s.sent_no = i.sent_no""",
)
def f6_token_windows(spark, sf_dir):
    keys = ["doc_id", "para_no", "sent_no"]
    words = stored(K.sentence_words(sentences(spark, sf_dir), keys), "words")
    out = K.token_windows(words, keys, stored(K.vocabulary(words.where("word is not null")), "vocabulary"))
    return out.select(*keys, "window_no", F.array_join("ids", " ").alias("ids"), F.size(F.filter("mask", lambda m: m == 1)).alias("tokens"))


_EVENTS = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
_DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def _finish(spark, q, path, schema):
    q.awaitTermination()
    return spark.read.schema(schema).parquet(path)


@query("g1_continuous_ingest", f"SELECT file, section, sentence, coordinates FROM ({_SENTENCE_ROWS})")
def g1_continuous_ingest(spark, sf_dir):
    stream = G.table_stream(spark, f"{sf_dir}/documents.parquet", _DOCUMENTS)
    path = work_path(spark, "ingest")
    flat = lambda batch: P.flatten_sentences(document_papers(spark, sf_dir, batch))
    q = G.ingest(stream, flat, path, work_path(spark, "ingest-state"))
    return _finish(spark, q, path, "file string, section string, sentence string, coordinates string").select("file", "section", "sentence", "coordinates")


@query("g2_drop_repeats", "SELECT event_type AS dataset, user_id AS filename, epoch_us(min(ts)) AS first_us FROM events GROUP BY event_type, user_id")
def g2_drop_repeats(spark, sf_dir):
    stream = G.table_stream(spark, f"{sf_dir}/events.parquet", _EVENTS)
    rows = stream.select(F.col("event_type").alias("dataset"), F.col("user_id").alias("filename"), "ts")
    path = work_path(spark, "announced")
    log = _finish(spark, G.append_table(rows, path, work_path(spark, "announced-state")), path, "dataset string, filename long, ts timestamp")
    return G.first_announcements(log, "ts", ["dataset", "filename"]).select("dataset", "filename", F.unix_micros("ts").alias("first_us"))


@query("g3_upsert", _LATEST)
def g3_upsert(spark, sf_dir):
    # Announcements arrive as several files, one per batch.
    inbox = work_path(spark, "inbox")
    table(spark, sf_dir, "events").repartitionByRange(4, "ts").write.parquet(inbox)
    stream = G.file_stream(spark, inbox, _EVENTS, per_trigger=1)
    rows = stream.select(F.col("event_type").alias("dataset"), text("{user_id}.json").alias("filename"), F.col("event_id").alias("file_id"), "ts")
    path = work_path(spark, "outputs")
    log = _finish(spark, G.append_table(rows, path, work_path(spark, "outputs-state")), path, "dataset string, filename string, file_id long, ts timestamp")
    return G.current_rows(log, ["dataset", "filename"], ["ts", "file_id"]).select("dataset", "filename", "file_id")


@query("g2_announce_once", "SELECT event_type AS dataset, user_id AS filename, 1 AS times FROM events GROUP BY event_type, user_id")
def g2_announce_once(spark, sf_dir):
    """Files as a stream hands them on: once each, though every announcement comes again in a second run."""
    inbox, out = work_path(spark, "inbox"), work_path(spark, "emitted")
    path, state = work_path(spark, "keys"), work_path(spark, "keys-state")
    rows = table(spark, sf_dir, "events").select(F.col("event_type").alias("dataset"), F.col("user_id").alias("filename"), "ts")
    schema = "dataset string, filename long, ts timestamp"
    emit = lambda new, number: new.select("dataset", "filename").write.mode("overwrite").parquet(f"{out}/batch={number}")
    for _ in range(2):
        rows.repartitionByRange(2, "ts").write.mode("append").parquet(inbox)
        G.announce_once(G.file_stream(spark, inbox, schema, per_trigger=1), ["dataset", "filename"], path, state, emit, buckets=4).awaitTermination()
    found = spark.read.schema("dataset string, filename long, batch long").parquet(out)
    return found.groupBy("dataset", "filename").agg(F.count("*").cast("int").alias("times"))


@query("g3_snapshot_delta", _LATEST)
def g3_snapshot_delta(spark, sf_dir):
    """Newest outputs from a snapshot and the deltas since, compacted between two runs of the stream."""
    inbox, state = work_path(spark, "inbox"), work_path(spark, "table-state")
    schema = "dataset string, filename string, file_id long, ts timestamp"
    rows = table(spark, sf_dir, "events").select(F.col("event_type").alias("dataset"), text("{user_id}.json").alias("filename"), F.col("event_id").alias("file_id"), "ts")
    outputs = G.VersionedTable(spark, work_path(spark, "table"), schema, ["dataset", "filename"], ["ts", "file_id"])
    for late in (1, 0):  # later announcements arrive first
        rows.where(F.col("file_id") % 2 == late).repartition(2, "dataset").write.mode("append").parquet(inbox)
        outputs.upsert(G.file_stream(spark, inbox, schema, per_trigger=1), state).awaitTermination()
        if late:
            outputs.compact()
    return outputs.read().select("dataset", "filename", "file_id")
