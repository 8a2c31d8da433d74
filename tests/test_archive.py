"""Manifests, names, bundles, evidence, sources and incremental runs."""

import io
import zipfile

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from docloom.operators import bundles, chunking, dedup, evidence, integrity, search, threads
from docloom.plans import flows
from docloom.sources import files, mail, office
from docloom.streaming.incremental import once_per_content


def test_first_copy_wins_and_numbers_skip_taken_names(spark):
    rows = spark.createDataFrame([(1, "a.md"), (2, "A.md"), (3, "a_2.md"), (4, "a.md")], "n int, name string")
    got = {r["n"]: r["unique_name"] for r in dedup.numbered_names(rows, "name", "n").collect()}
    assert got[1] == "a.md" and got[3] == "a_2.md" and len({x.lower() for x in got.values()}) == 4
    texts = spark.createDataFrame([(3, "x"), (1, "x"), (2, "y")], "n int, t string")
    assert sorted(r["n"] for r in dedup.first_copies(texts, "t", "n").collect()) == [1, 2]


def test_titles_are_numbered_in_brackets(spark):
    rows = spark.createDataFrame([(1, "t"), (2, "t")], "n int, name string")
    got = dedup.numbered_names(rows, "name", "n", style=" ({n})").orderBy("n").collect()
    assert [r["unique_name"] for r in got] == ["t", "t (2)"]


def test_variants_keep_the_first_text(spark):
    rows = spark.createDataFrame([("a", 2, "n2", "h2", "b2", ["p1"]), ("a", 1, "n1", "h1", "b1", ["p2", "p1"])], "aid string, seq int, name string, header string, body string, parents array<string>")
    row = dedup.variants(rows).first()
    assert (row["body"], row["names"], row["parents"]) == ("b1", ["n1", "n2"], ["p1", "p2"])


def test_missing_parents_are_named(spark):
    edges = spark.createDataFrame([("x", "p"), ("y", "q")], "attachment string, parent string")
    emails = spark.createDataFrame([("p",)], "file string")
    with pytest.raises(integrity.IntegrityError, match="q"):
        integrity.require(edges, emails, {"parent": "file"}, "parents")
    integrity.require(edges.where("parent = 'p'"), emails, {"parent": "file"}, "parents")


def test_same_stem_documents_keep_their_texts(spark):
    raw = spark.createDataFrame([("a.docx", "a"), ("a.pdf", "a"), ("b.pdf", "b"), ("c.pdf", "c")], "name string, stem string")
    texts = spark.createDataFrame([("1", "a", "a.pdf"), ("2", "a", "a.docx"), ("3", "b", None), ("4", "b", "b.pdf")], "path string, stem string, declared string")
    got = {r["name"]: (r["state"], r["path"]) for r in integrity.matched_texts(raw, texts).collect()}
    assert got == {"a.docx": ("matched", "2"), "a.pdf": ("matched", "1"), "b.pdf": ("ambiguous", None), "c.pdf": ("none", None)}


def test_a_common_stem_is_not_paired(spark):
    raw = spark.range(300).selectExpr("id AS name", "if(id < 299, 'hot', 'cold') AS stem")
    texts = spark.range(1000, 1300).selectExpr("id AS path", "'hot' AS stem", "if(id % 3 = 0, id - 1000, NULL) AS declared")
    texts = texts.unionByName(spark.range(1).selectExpr("5000 AS path", "'cold' AS stem", "CAST(NULL AS bigint) AS declared"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = integrity.matched_texts(raw, texts)
        got, nodes, rows = df.collect(), [df._jdf.queryExecution().executedPlan()], []
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    while nodes:
        node = nodes.pop()
        nodes += [node.children().apply(i) for i in range(node.children().size())]
        if "Join" in node.nodeName():
            rows.append(node.metrics().apply("numOutputRows").value())
    assert rows and max(rows) <= 300
    assert {r["state"] for r in got if r["name"] < 299} == {"ambiguous"}
    assert [(r["state"], r["path"]) for r in got if r["name"] == 299] == [("matched", 5000)]


def test_chunks_close_before_the_limit(spark):
    text = "\n\n".join(["a" * 700, "b" * 500, "c" * 1300, " ", "d"])
    rows = spark.createDataFrame([(1, text), (2, ""), (3, None)], "doc_id int, text string")
    got = [(r["doc_id"], r["part"], len(r["chunk"])) for r in chunking.chunks(rows, "doc_id", "text").orderBy("doc_id", "part").collect()]
    assert got == [(1, 1, 1202), (1, 2, 1300), (1, 3, 1)]


def test_own_headers_win_in_email_chunks(spark):
    body = "### 📩 آخرین پیام (پاسخ جاری):\n\nlatest message here\n\n---\n\n### 📜 پیام در تاریخچه مکاتبات:\n> From: Ali\n> Sent: 1403/01/02\n\nolder message\n---\nshort"
    emails = spark.createDataFrame([("f", "s", "me", "1403/01/01", "", body)], "file string, subject string, sender string, jalali_date string, folder string, body string")
    got = chunking.email_chunks(emails).orderBy("chunk_id").collect()
    assert [(r["chunk_id"], r["sender"], r["date_shamsi"]) for r in got] == [("f_msg_1", "me", "1403/01/01"), ("f_msg_2", "Ali", "1403/01/02")]


def test_ocr_text_wins(spark):
    low = spark.createDataFrame([("a", 1), ("b", 1)], "name string, v int")
    high = spark.createDataFrame([("b", 2), ("c", 2)], "name string, v int")
    assert sorted(tuple(r) for r in chunking.preferred(low, high, "name").collect()) == [("a", 1), ("b", 2), ("c", 2)]


def test_conversations(spark):
    rows = spark.createDataFrame([("1", "c", "RE: x", "A"), ("2", None, "FW: x", "B"), ("3", "", "x", "A"), ("4", None, "", "C")], "id string, conv string, subject string, sender string")
    key = threads.conversation_key(F.col("conv"), F.col("subject"), F.col("id"))
    got = threads.rollup(rows.withColumn("k", key), "k", "id", "sender", "subject").collect()
    assert {r["k"]: (r["n_messages"], r["senders"]) for r in got} == {"c": (1, ["A"]), "SUBJ_x": (2, ["A", "B"]), "ITEM_4": (1, ["C"])}


def test_bundles_split_only_between_units(spark):
    rows = spark.createDataFrame([(1, 40, 10), (2, 50, 10), (3, 20, 10), (4, 100, 10)], "n int, words int, bytes int")
    got = bundles.assigned(rows, ["n"], max_words=100, max_bytes=1000).orderBy("n").collect()
    assert [r["bundle"] for r in got] == [1, 1, 2, 3]
    by = bundles.assigned(rows.withColumn("box", F.col("n") % 2), ["n"], max_words=100, max_bytes=1000, run="box").orderBy("n").collect()
    assert [r["bundle"] for r in by] == [1, 1, 1, 2]
    with pytest.raises(PySparkException, match="exceeds a bundle"):
        bundles.assigned(rows, ["n"], max_words=99, max_bytes=1000).collect()


def test_shared_attachment_is_below_each_parent_and_sizes_add_up(spark):
    emails = spark.createDataFrame([("E-1", "a.md", "s", "d1", "h\nپیوست‌ها:\n- x", "# t", ["A-1"]), ("E-2", "b.md", "s", "d2", "", "u", ["A-1"]), ("E-3", "c.md", "s", "d3", "", "v", [])], "id string, source string, subject string, date string, header string, body string, attachments array<string>")
    docs = spark.createDataFrame([("A-1", "A", ["n"], ["r"], "نوع: pdf\nx: y", "## deep")], "aid string, raw_id string, names array<string>, raws array<string>, header string, body string")
    sections = bundles.assigned(bundles.email_sections(emails, docs), ["date", "source"])
    text = bundles.bundle_texts(sections).first()["text"]
    assert text.count("### شروع پیوست A-1") == 2 and "##### deep" in text and "### t" in text and "نوع: pdf" in text
    assert bundles.NO_ATTACHMENT in text and "- x" not in text and "x: y" not in text
    lines = bundles.line_ranges(sections, "bundle", "date", "section").orderBy("date").collect()
    assert lines[0]["start_line"] == 1 and lines[1]["start_line"] == lines[0]["end_line"] + 1
    total = sections.agg(F.sum("words"), F.sum("bytes")).first()
    assert len(text.split()) - total[0] == len(f"{bundles.TITLE} {bundles.LIST_TITLE}".split())
    assert len(text.encode()) - total[1] <= len(f"{bundles.TITLE}\n\n{bundles.LIST_TITLE}\n\n".encode())


def test_one_content_resolves_and_several_do_not(spark):
    refs = spark.createDataFrame([("m1", "a"), ("m2", "a"), ("m3", "a"), ("m4", "z")], "mid string, name string")
    originals = spark.createDataFrame(
        [("m1", "a", "p1", "s1"), ("m1", "b", "p2", "s2"), ("m2", "b", "p4", "s1"), ("m2", "c", "p3", "s1"), ("m4", "x", "p5", "s5"), ("m4", "y", "p6", "s6")],
        "message_id string, source_name string, path string, sha256 string",
    )
    got = evidence.resolved(refs, originals, {"mid": "message_id", "name": "source_name"}, {"mid": "message_id"}).collect()
    assert {r["mid"]: (r["state"], r["path"]) for r in got} == {"m1": ("resolved", "p1"), "m2": ("resolved", "p3"), "m3": ("missing", None), "m4": ("ambiguous", None)}


def test_evidence_file_names(spark):
    rows = spark.createDataFrame([("r", "a.pdf", "1" * 64, 1), ("r", "A.pdf", "2" * 64, 2), ("r", "a.pdf", "1" * 64, 3)], "report string, path_name string, sha256 string, seq int")
    got = [r["filename"] for r in evidence.file_names(rows).orderBy("seq").collect()]
    assert got == ["a.pdf", "A_" + "2" * 12 + ".pdf"]


def test_many_codes_go_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(evidence, "CODE_BLOCK", 2)
    codes = spark.createDataFrame([(f"c{i}",) for i in range(7)], "code string")
    texts = spark.createDataFrame([(1, "has C3 and c5"), (2, "none")], "id int, text string")
    got = evidence.containing(texts, F.col("text"), codes, F.col("code")).select("id", "code").collect()
    assert sorted(tuple(r) for r in got) == [(1, "c3"), (1, "c5")]


def test_nearest_neighbours_are_exact(spark):
    rng = np.random.default_rng(1)
    data = rng.normal(size=(60, 8)).astype("float32")
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)] + [(99, [0.0] * 8)], "vec_id long, embedding array<float>")
    queries = df.where("vec_id < 3").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    unit = data / np.linalg.norm(data, axis=1, keepdims=True)
    got = search.nearest_to_all(df, queries, k=3).orderBy("query_id", "rank").collect()
    want = [(q, int(k)) for q in range(3) for k in np.argsort(-(unit @ unit[q]))[:3]]
    assert [(r["query_id"], r["key"]) for r in got] == want
    assert [r["vec_id"] for r in search.nearest(df, data[0].tolist(), k=3).collect()] == [k for q, k in want if q == 0]


def test_embedding_runs_once_a_text_and_the_index_is_kept(spark, tmp_path):
    def model():
        return lambda texts: np.array([[len(x), 1.0] for x in texts])

    rows = spark.createDataFrame([("a", "xx"), ("a", "yyy"), ("b", "xx"), ("c", None)], "chunk_id string, text string")
    made = search.embedded(rows, "text", model)
    assert {tuple(r["embedding"] or ()) for r in made.collect()} == {(2.0, 1.0), (3.0, 1.0), ()}
    path = str(tmp_path / "index")
    assert search.write_index(made, path) and not search.write_index(made, path)
    assert sorted(r["chunk_id"] for r in spark.read.parquet(path).collect()) == ["a", "a_1", "b", "c"]


def zipped(**members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, data in members.items():
            z.writestr(name, data)
    return out.getvalue()


def test_archives_flatten_without_losing_or_escaping(spark):
    content = zipped(**{"a/report.txt": "1", "b/report.txt": "2", "../outside.txt": "3", ".hidden": "4", "c/": ""})
    archives = spark.createDataFrame([("z.zip", bytearray(content)), ("bad.zip", bytearray(b"x"))], "name string, content binary")
    edges = spark.createDataFrame([("z.zip", "p1"), ("z.zip", "p2")], "attachment string, parent string")
    found, more = office.flattened(archives, edges)
    names = sorted(r["file"] for r in found.collect())
    assert len(names) == 3 and "z_unzipped_outside.txt" in names and sum("report" in n for n in names) == 2
    assert more.count() == 6 and office.zip_members(archives).where("error is not null").count() == 1


DOCX = '<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:body><w:p><w:pPr><w:pStyle w:val="Heading1"/></w:pPr><w:r><w:t>He</w:t></w:r><w:r><w:t>ad</w:t></w:r></w:p><w:tbl><w:tr><w:tc><w:p><w:r><w:t>c</w:t></w:r></w:p></w:tc></w:tr></w:tbl><w:p><w:r><w:t>end</w:t></w:r></w:p></w:body></w:document>'


def test_office_readers(spark):
    sheet = '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c><c r="C1"><v>2.0</v></c></row></sheetData></worksheet>'
    book = '<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="S" r:id="r1"/></sheets></workbook>'
    links = '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Target="worksheets/sheet1.xml"/></Relationships>'
    strings = '<sst xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><si><t>head</t></si></sst>'
    slide = '<p:sld xmlns:p="http://schemas.openxmlformats.org/presentationml/2006/main" xmlns:a="http://schemas.openxmlformats.org/drawingml/2006/main"><p:txBody><a:p><a:r><a:t>hi</a:t></a:r></a:p></p:txBody></p:sld>'
    rows = [
        ("a.docx", zipped(**{"word/document.xml": DOCX})),
        ("b.xlsx", zipped(**{"xl/workbook.xml": book, "xl/_rels/workbook.xml.rels": links, "xl/sharedStrings.xml": strings, "xl/worksheets/sheet1.xml": sheet})),
        ("c.pptx", zipped(**{"ppt/slides/slide1.xml": slide})),
        ("d.txt", b"plain"),
        ("e.docx", b"broken"),
        ("f.bin", b"x"),
    ]
    df = spark.createDataFrame([(n, bytearray(c)) for n, c in rows], "name string, content binary")
    got = {r["name"]: r for r in office.converted(df).collect()}
    assert got["a.docx"]["body"] == "## Head\n\n| c |\n| --- |\n\nend"
    assert got["b.xlsx"]["body"] == "## شیت: S\n\n| head | 2 |\n| --- | --- |"
    assert got["c.pptx"]["body"] == "## اسلاید 1\n\nhi" and got["d.txt"]["body"] == "plain"
    assert got["e.docx"]["error"] and set(got) == {"a.docx", "b.xlsx", "c.pptx", "d.txt", "e.docx"}
    assert office.docx_paragraphs(rows[0][1]) == ["Head", "c", "end"]
    assert office.is_red("FFFF0000") and not office.is_red("FF000000")


def test_nested_messages_once_each(spark):
    inner = b"Subject: inner\r\nFrom: b@x\r\nMessage-ID: <i>\r\n\r\ninner body\r\n"
    outer = (
        b"Subject: outer\r\nFrom: a@x\r\nDate: Wed, 20 Mar 2024 12:00:00 +0000\r\nMIME-Version: 1.0\r\n"
        b'Content-Type: multipart/mixed; boundary="B"\r\n\r\n--B\r\nContent-Type: text/html\r\n\r\n<p>hello<br>there</p>\r\n'
        b"--B\r\nContent-Type: message/rfc822\r\n\r\n" + inner + b"\r\n--B\r\nContent-Type: application/pdf\r\n"
        b'Content-Disposition: attachment; filename="r.pdf"\r\n\r\nPDF\r\n--B--\r\n'
    )
    rows = [("m/o.eml", bytearray(outer)), ("m/copy.eml", bytearray(outer))]
    found = spark.createDataFrame(rows, "path string, content binary").withColumn("modified", F.lit("2024-01-01").cast("timestamp"))
    got = {r["subject"]: r for r in flows.emails_from_files(found).collect()}
    assert set(got) == {"outer", "inner"} and got["outer"]["jalali_date"] == "1403/01/01"
    assert got["outer"]["body"] == "hello\nthere" and [a["name"] for a in got["outer"]["attachments"]] == ["r.pdf"]
    assert "- attachments/r.pdf" in got["outer"]["markdown"] and got["inner"]["message_id"] == "<i>"
    good, bad = mail.index(mail.parsed(found))
    assert good.count() == 2 and bad.count() == 0


def test_markdown_and_manifest_round_trip(spark, tmp_path):
    (tmp_path / "emails").mkdir()
    (tmp_path / "emails" / "نامه a+b.md").write_text("---\nموضوع: x\n---\nbody", encoding="utf-8")
    rows = files.read_markdown(spark, str(tmp_path / "emails")).collect()
    assert [(r["file"], r["header"], r["body"]) for r in rows] == [("نامه a+b.md", "موضوع: x", "body")]
    (tmp_path / "m.json").write_text('{"a.pdf": ["p", "q"]}')
    (tmp_path / "bad.json").write_text("{")
    assert files.read_manifest(spark, str(tmp_path / "m.json")).count() == 2
    assert files.read_manifest(spark, str(tmp_path / "bad.json")).count() == 0
    before = files.snapshot(files.scan(spark, str(tmp_path)))
    assert integrity.differences(before, before, "path", "sha256").count() == 0
    files.write_jsonl(spark.range(2), str(tmp_path / "out"))
    with pytest.raises(PySparkException):
        files.write_jsonl(spark.range(2), str(tmp_path / "out"))
    with pytest.raises(ValueError):
        files.check_paths("/a/b", "/a")
    with pytest.raises(ValueError):
        files.contained("../x", "/a")
    assert files.contained("b/./c", "/a") == "/a/b/c" and [files.exit_code(*x) for x in ((1, 0), (1, 1), (0, 1))] == [0, 2, 1]


def test_each_content_is_processed_once_across_runs(spark, tmp_path):
    source, out, done, state = (str(tmp_path / x) for x in ("in", "out", "done", "state"))

    def run():
        stream = spark.readStream.schema("id int, text string").parquet(source)
        q = once_per_content(stream, lambda df: df.select("id", F.upper("text").alias("text")), content="text", output=out, done=done, checkpoint=state)
        q.awaitTermination()

    spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "id int, text string").write.parquet(source)
    run()
    spark.createDataFrame([(4, "b"), (5, "c")], "id int, text string").write.mode("append").parquet(source)
    run()
    run()
    assert sorted(r["text"] for r in spark.read.parquet(out).collect()) == ["A", "B", "C"]


def test_flagship_flow(spark):
    text = "A healthy sentence with quite enough letters in it.\n" * 40
    docs = spark.createDataFrame([(1, text), (2, text), (3, "x"), (4, None)], "doc_id long, text string")
    got = flows.dedup_gate_chunk(docs).orderBy("part").collect()
    assert [r["chunk_id"] for r in got] == ["1_part_1", "1_part_2"] and all(r["n_chars"] <= 1300 for r in got)
