"""Files in and out, and streams."""

import hashlib

from pyspark.sql import functions as F

from conftest import rows
from paperloom.operators import papers as P
from paperloom.session import work_path
from paperloom.sources import files, sinks
from paperloom.streaming import ingest


def test_scan_folder(spark, tmp_path):
    (tmp_path / "a.b.PDF").write_bytes(b"one")
    (tmp_path / "x.doc").write_bytes(b"two")
    got = files.scan_folder(spark, str(tmp_path))
    assert rows(got, "doc_id", "kind", "sha1", "error") == [
        ("a.b", "pdf", hashlib.sha1(b"one").hexdigest(), None), ("x", "doc", hashlib.sha1(b"two").hexdigest(), "unknown_type"),
    ]


def test_scan_xml_and_well_formed(spark, tmp_path):
    (tmp_path / "good.xml").write_text("<a>\n<b/></a>")
    (tmp_path / "bad.xml").write_text("<a><b></a>")
    got = files.scan_xml(spark, str(tmp_path / "*.xml")).withColumn("ok", files.well_formed(F.col("xml")))
    assert rows(got, "doc_id", "ok") == [("bad", False), ("good", True)]


def test_scan_xml_rows(spark, tmp_path):
    (tmp_path / "a.xml").write_text('<r><bib id="1"><title>A</title></bib><bib id="2"><title>B</title></bib></r>')
    got = files.scan_xml_rows(spark, str(tmp_path / "a.xml"), "bib", "_id string, title string")
    assert rows(got) == [("1", "A"), ("2", "B")]


def test_decode(spark):
    df = spark.createDataFrame([(1, "é".encode()), (2, "é".encode("latin-1")), (3, None)], "id long, b binary")
    assert rows(df.select("id", files.decode_text(F.col("b")).alias("t"))) == [(1, "é"), (2, "é"), (3, "")]


def test_failures_split_by_first_reason(spark):
    df = spark.createDataFrame([(1, 5), (2, -5), (3, None)], "doc_id long, v long")
    good, bad = files.split_failures(df, {"missing": F.col("v").isNotNull(), "negative": F.col("v") >= 0})
    assert rows(good, "doc_id") == [(1,)] and rows(bad) == [(2, "negative"), (3, "missing")]


def test_text_sink_keeps_the_order(spark, tmp_path):
    data = [(d, n, f"{d}-{n}") for d in "ba" for n in (2, 0, 1)]
    lines = spark.createDataFrame(data, "doc_id string, line_no long, line string")
    path = str(tmp_path / "out")
    sinks.write_text(lines, path, buckets=2)
    parts = sorted(p for p in (tmp_path / "out").iterdir() if p.name.startswith("part"))
    assert [x for p in parts for x in p.read_text().split()] == ["a-0", "a-1", "a-2", "b-0", "b-1", "b-2"]


def test_csv_round_trip_of_awkward_text(spark, tmp_path):
    data = [("f", "s", 'say "hi", then\nleave\\', "1,2"), ("f", "s", "plain", None)]
    df = spark.createDataFrame(data, "file string, section string, sentence string, coordinates string")
    sinks.write_csv(df, str(tmp_path / "c"))
    assert rows(sinks.read_csv(spark, str(tmp_path / "c"))) == sorted(data, key=repr)


def test_layouts(spark, tmp_path):
    para = '{"text": [{"sentence": "S.", "coords": "1"}], "section": "A"}'
    lines = [
        '{"paper_id": "1", "s2_pdf_hash": "h", "metadata": {"title": "T"}, "grobid_parse": {"body_text": [%s], "bib_entries": {"BIBREF0": {"title": "B", "issn": "9", "link": "L"}}}}' % para,
        '{"paper_id": "2", "_pdf_hash": "h", "pdf_parse": {"body_text": [%s]}}' % para,
        '{"paper_id": "3", "pdf_parse": {"body_text": [%s], "metadata": {"title": "T"}}}' % para,
        '{"paper_id": "4", "body_text": [%s], "metadata": {"title": "T"}, "ref_entries": {"FIGREF0": {"text": "c", "type_str": "figure"}}}' % para,
        '{"paper_id": "5", "title": {"text": "T", "coords": "9"}, "abstract": "x\\n", "pdf_parse": {"_pdf_hash": "h", "body_text": [%s]}}' % para,
        '{"paper_id": "6"}',
        '{"paper_id": "7", ',
    ]
    (tmp_path / "p.json").write_text("\n".join(lines))
    got = P.unify_layouts(files.scan_papers(spark, str(tmp_path)))
    assert rows(got, "layout", "pdf_hash", "reason", F.size("body_text"), P.title_text(F.col("metadata.title"))) == sorted(
        [
            ("2019", "h", None, 1, "T"), ("2020", "h", None, 1, None), ("current", None, None, 1, "T"), ("flat", None, None, 1, "T"), ("current", "h", None, 1, "T"),
            (None, None, "unknown_layout", 0, None), (None, None, "malformed_json", 0, None),
        ],
        key=repr,
    )
    bib = got.where("layout = '2019'").select("bib_entries.BIBREF0.*").collect()[0]
    assert (bib.issue, bib.links) == ("9", ["L"])


def test_upsert_stream_replays_and_replaces(spark, tmp_path):
    schema = "doc_id string, version long, text string"
    inbox, table, state = str(tmp_path / "in"), work_path(spark, "t"), work_path(spark, "s")
    put = lambda data: spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(inbox)
    run = lambda: ingest.append_table(ingest.file_stream(spark, inbox, schema), table, state).awaitTermination()
    put([("a", 1, "a1"), ("a", 1, "a1b"), ("b", 1, "b1")])
    run()
    put([("a", 2, "a2")])
    run()
    run()
    log = spark.read.schema(schema).parquet(table)
    assert log.count() == 4
    assert rows(ingest.current_rows(log, ["doc_id"], ["version"])) == [("a", 2, "a2"), ("b", 1, "b1")]
    small = work_path(spark, "compact")
    ingest.compact(log, ["doc_id"], ["version"], small)
    assert spark.read.schema(schema).parquet(small).count() == 2


def test_ingest_runs_batch_windows(spark, tmp_path):
    from paperloom.operators.sections import sentence_rows
    from paperloom.operators.tokens import tokenise

    inbox, table = str(tmp_path / "in"), work_path(spark, "t")
    spark.createDataFrame([("a", "<p><s>x</s></p>")], "doc_id string, xml string").write.parquet(inbox)
    stream = ingest.file_stream(spark, inbox, "doc_id string, xml string")
    ingest.ingest(stream, lambda b: sentence_rows(tokenise(b)), table, work_path(spark, "s")).awaitTermination()
    assert rows(spark.read.schema("doc_id string, sentence string").parquet(table), "doc_id", "sentence") == [("a", "x")]


def test_scan_xml_records_with_offsets(spark, tmp_path):
    one = '<set>\n<doc n="1"><p>é</p></doc>\n<doc n="2"><p></doc> <doc n="3">x</doc>'
    (tmp_path / "a.xml").write_text(one, encoding="utf-8")
    (tmp_path / "b.xml").write_text('stray</doc><doc n="4">open', encoding="utf-8")
    (tmp_path / "c.xml").write_text("".join(f'<doc n="{i}">{"y" * i}</doc>\n' for i in range(3000)), encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        got = files.scan_xml_records(spark, str(tmp_path / "*.xml"), "doc").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    by = lambda name: sorted((r.offset, r.record_no, r.xml, r.reason) for r in got if r.file.endswith(name))
    assert [(r[2], r[3]) for r in by("a.xml")] == [('<doc n="1"><p>é</p></doc>', None), ('<doc n="2"><p></doc>', "malformed"), ('<doc n="3">x</doc>', None)]
    assert [(r[2], r[3]) for r in by("b.xml")] == [("stray", "stray_text"), ('<doc n="4">open', "unterminated")]
    many, data = by("c.xml"), (tmp_path / "c.xml").read_bytes()
    assert [r[1] for r in many] == list(range(3000)) and all(r[3] is None for r in many)
    for at, _, xml, _ in [*many[::97], *by("a.xml")[:1]]:
        whole = data if xml != by("a.xml")[0][2] else one.encode()
        assert whole[at:].decode().lstrip("\n").removeprefix("<set>\n").startswith(xml)


def test_announcements_are_handed_on_once(spark, tmp_path):
    schema = "name string, n long"
    inbox, out = str(tmp_path / "in"), str(tmp_path / "out")
    path, state = work_path(spark, "k"), work_path(spark, "s")
    put = lambda data: spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(inbox)
    emit = lambda new, number: new.write.mode("overwrite").parquet(f"{out}/batch={number}")
    run = lambda: ingest.announce_once(ingest.file_stream(spark, inbox, schema), ["name"], path, state, emit, 4).awaitTermination()
    put([("a", 1), ("a", 1), ("b", 1)])
    run()
    put([("a", 2), ("c", 2), (None, 2)])
    run()
    put([("b", 3), ("d", 3)])
    run()
    run()
    assert rows(spark.read.schema(schema).parquet(out), "name") == sorted([("a",), ("b",), ("c",), ("d",), (None,)], key=repr)


def test_snapshot_and_deltas(spark, tmp_path):
    schema = "doc_id string, version long, text string"
    inbox, state = str(tmp_path / "in"), work_path(spark, "s")
    table = ingest.VersionedTable(spark, str(tmp_path / "t"), schema, ["doc_id"], ["version"])
    put = lambda data: spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(inbox)
    run = lambda: table.upsert(ingest.file_stream(spark, inbox, schema), state).awaitTermination()
    put([("a", 1, "a1"), ("a", 1, "a1b"), ("b", 5, "b5"), ("c", 1, "c1")])
    run()
    assert table.pointer() == (-1, None, -1) and table.read().count() == 4
    table.compact()
    table.compact()
    assert table.pointer()[0] == 0 and table.read().count() == 4
    put([("a", 2, "a2"), ("b", 4, "late")])
    run()
    assert rows(table.read()) == [("a", 2, "a2"), ("b", 5, "b5"), ("c", 1, "c1")]
    # A run that is killed after its snapshot, ahead of the pointer, changes nothing.
    spark.createDataFrame([("x", 9, "x")], schema).write.parquet(f"{tmp_path}/t/snapshots/1-killed")
    assert table.read().count() == 3
    table.compact()
    assert table.pointer()[0] == 1 and rows(table.read()) == [("a", 2, "a2"), ("b", 5, "b5"), ("c", 1, "c1")]
    assert table.deltas(table.pointer()[2]).count() == 0


def test_table_of_files_as_stream(spark, tmp_path):
    """A table is streamed whole, be it one file or a folder of several."""
    for name, parts in (("one", 1), ("many", 3)):
        spark.range(10).repartition(parts).write.parquet(str(tmp_path / f"{name}.parquet"))
    single = next((tmp_path / "one.parquet").glob("part-*")).rename(tmp_path / "file.parquet")
    for name in ("many.parquet", single.name):
        out = str(tmp_path / f"out-{name}")
        ingest.ingest(ingest.table_stream(spark, str(tmp_path / name), "id long"), lambda b: b, out, str(tmp_path / f"state-{name}")).awaitTermination()
        assert [r[0] for r in rows(spark.read.schema("id long").parquet(out))] == list(range(10))
