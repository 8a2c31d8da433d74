"""Whole flows on small datasets: bundles with attachments in both layouts, and evidence for reports."""

import hashlib
import io
import json
import sys
import zipfile

import pytest
from pyspark.sql import functions as F

from docloom.__main__ import main
from docloom.functions import fixed
from docloom.operators import bundles, integrity
from docloom.plans import archive

KEY = fixed.KEYS


def write_dataset(root, mails=("a", "b")):
    (root / "emails" / "attachments").mkdir(parents=True)
    (root / "attachments_text").mkdir()
    (root / "attachments_ocr_google").mkdir()
    for name in mails:
        header = f"{KEY['message_id']}: <{name}@x>\n{KEY['subject']}: about {name}\n{KEY['jalali_date']}: 1403/01/0{1 + mails.index(name)}\n{KEY['source_name']}: {name}.eml\n{KEY['attachments']}:\n- attachments/shared.pdf"
        (root / "emails" / f"{name}.md").write_text(f"---\n{header}\n---\n# Body of {name} LTR-7{name}\ntext", encoding="utf-8")
    (root / "emails/attachments/shared.pdf").write_bytes(b"PDF shared")
    (root / "emails/attachments/DW1-x.dwg").write_bytes(b"drawing")
    head = f"---\n{KEY['attachment_name']}: shared.pdf\n{KEY['kind']}: pdf\n---\n"
    (root / "attachments_ocr_google/shared.md").write_text(head + "# Shared text\nof the attachment", encoding="utf-8")
    manifest = {"shared.pdf": [f"{m}.md" for m in mails], "DW1-x.dwg": [f"{mails[0]}.md"]}
    (root / "attachment_manifest.json").write_text(json.dumps(manifest))
    return root


def email_id(root, name):
    return "E-" + hashlib.sha256(f"{root}/emails/{name}.md".encode()).hexdigest()[:20]


def text_of(spark, out):
    return {r["bundle"]: r["text"] for r in spark.read.parquet(f"{out}/bundles").collect()}


def test_bundles_keep_attachments_in_both_layouts(spark, tmp_path):
    root, ids = write_dataset(tmp_path / "set"), None
    for layout in ("inline", "appendix"):
        out = tmp_path / layout
        main(["bundle", "--input", str(root), "--output", str(out), "--layout", layout])
        text = text_of(spark, out)[1]
        ids = [email_id(root, x) for x in "ab"]
        assert text.count("of the attachment") == (2 if layout == "inline" else 1)
        assert "### Body of a LTR-7a" in text and "#### Shared text" in text and "- attachments/" not in text
        manifest = spark.read.json(str(out / "manifest")).first()
        assert [e["id"] for e in sorted(manifest["emails"], key=lambda e: e["start_line"])] == ids
        lines = text.split("\n")
        for e in manifest["emails"]:
            assert lines[e["start_line"] - 1].startswith(f"## شروع ایمیل {e['id']}") and lines[e["end_line"] - 1] == f"## پایان ایمیل {e['id']}"
            assert len(e["attachments"]) == (2 if e["id"] == ids[0] else 1)
        report = spark.read.json(str(out / "report")).first()
        assert (report["emails"], report["attachments"], report["unique_raw_attachments"], report["sources_unchanged"]) == (2, 2, 2, True)
        assert spark.read.json(str(out / "sources")).count() == 6
        if layout == "appendix":
            assert f"{bundles.APPENDIX_PARENTS}{ids[0]}، {ids[1]}" in text and bundles.APPENDIX_TITLE in text
    with pytest.raises(ValueError, match="there already"):
        main(["bundle", "--input", str(root), "--output", str(tmp_path / "inline")])
    with pytest.raises(ValueError, match="overlap"):
        main(["bundle", "--input", str(root), "--output", str(root / "out")])


def test_appendix_parts_count_once_a_bundle(spark):
    schema = "n int, words int, bytes int, shared array<struct<key:string,words:bigint,bytes:bigint>>"
    rows = spark.createDataFrame([(1, 10, 10, [("x", 50, 50)]), (2, 10, 10, [("x", 50, 50)]), (3, 10, 10, [("y", 50, 50)]), (4, 10, 10, None)], schema)
    got = bundles.assigned(rows, ["n"], max_words=80, max_bytes=1000, shared="shared").orderBy("n").collect()
    assert [r["bundle"] for r in got] == [1, 1, 2, 2]


def test_equal_order_keys_multiply_no_row(spark):
    rows = spark.createDataFrame([(1, 5, 5, "a"), (1, 5, 5, "a"), (1, 7, 5, "b"), (2, 5, 5, "c")], "n int, words int, bytes int, t string")
    got = bundles.assigned(rows, ["n"], max_words=10, max_bytes=1000).collect()
    assert sorted((r["n"], r["bundle"], r["t"]) for r in got) == [(1, 1, "a"), (1, 1, "a"), (1, 2, "b"), (2, 3, "c")]


def test_broken_datasets_are_refused(spark, tmp_path):
    def broken(name, change, match):
        root = write_dataset(tmp_path / name)
        change(root)
        with pytest.raises(integrity.IntegrityError, match=match):
            archive.linked(archive.read(spark, str(root)))

    broken("raw", lambda r: (r / "emails/attachments/shared.pdf").unlink(), "not there")
    broken("parent", lambda r: (r / "emails/b.md").unlink(), "parents")
    broken("listed", lambda r: (r / "attachment_manifest.json").write_text('{"shared.pdf": ["a.md"]}'), "list")
    broken("orphan", lambda r: (r / "attachments_text/other.md").write_text("x"), "belong to no attachment")
    broken("two", lambda r: (r / "attachments_text/shared.md").write_text("x"), "not unique")


DOCX = '<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:body>{}</w:body></w:document>'


def write_report(path, *lines):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", DOCX.format("".join(f"<w:p><w:r><w:t>{x}</w:t></w:r></w:p>" for x in lines)))
    path.write_bytes(out.getvalue())


def test_evidence_is_copied_verified_and_left_alone_when_unchanged(spark, tmp_path):
    root = write_dataset(tmp_path / "set")
    mails, reports, out = tmp_path / "mails", tmp_path / "reports", tmp_path / "out"
    mails.mkdir()
    reports.mkdir()
    for name in "ab":
        (mails / f"{name}.eml").write_bytes(f"Subject: {name}\r\nMessage-ID: <{name}@x>\r\n\r\nbody\r\n".encode())
    write_report(reports / "one.docx", "عنوان: Findings", f"see {email_id(root, 'a')} and DW1-x")
    write_report(reports / "two.docx", "عنوان: Findings", "by letter LTR-7b and LTR-99 and E-" + "0" * 20)
    run = lambda: main(["collect", "--input", str(reports), "--datasets", str(root), "--messages", str(mails), "--output", str(out), "--codes", r"LTR-\d+[a-z]?"])
    run()
    manifest = {r["report"]: r for r in spark.read.json(str(out / "collection_manifest")).collect()}
    one, two = manifest["one.docx"], manifest["two.docx"]
    assert {one["folder"], two["folder"]} == {"Findings", "Findings (2)"}
    assert sorted(f["filename"] for f in one["files"]) == ["DW1-x.dwg", "a.eml", "shared.pdf"] and not one["unresolved"]
    assert sorted(f["filename"] for f in two["files"]) == ["b.eml", "shared.pdf"]
    assert sorted(u["ref"] for u in two["unresolved"]) == ["E-" + "0" * 20, "LTR-99"]
    assert (out / one["folder"] / "a.eml").read_bytes() == (mails / "a.eml").read_bytes() and (out / two["folder"] / "two.docx").exists()
    run()
    again = spark.read.json(str(out / "collection_manifest"))
    assert {r["report"]: r["folder"] for r in again.collect()} == {k: r["folder"] for k, r in manifest.items()}
    (out / one["folder"] / "a.eml").write_bytes(b"tampered")
    run()
    after = {r["report"]: r["folder"] for r in spark.read.json(str(out / "collection_manifest")).collect()}
    assert after["one.docx"] not in (one["folder"], two["folder"]) and after["two.docx"] == two["folder"]
    assert (out / after["one.docx"] / "a.eml").read_bytes() == (mails / "a.eml").read_bytes()


def test_copies_that_differ_are_seen(spark, tmp_path):
    (tmp_path / "x").write_bytes(b"1")
    plan = spark.createDataFrame([(str(tmp_path / "x"), "0" * 64, "f", "x")], "path string, sha256 string, folder string, filename string")
    plan = plan.withColumn("path", F.concat(F.lit("file://"), "path"))
    assert [r["same"] for r in archive.copied(plan, f"file://{tmp_path}/out").collect()] == [False]


def test_archives_complete_a_dataset_and_its_state_is_reported(spark, tmp_path):
    root = write_dataset(tmp_path / "set")
    data = archive.read(spark, str(root))
    state, findings = archive.quality_report(data)
    assert state.first()["status"] == "ok" and findings.count() == 0
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("x/new.pdf", "fresh")
    held = spark.createDataFrame([("shared.zip", bytearray(out.getvalue()))], "name string, content binary")
    edges = data.edges.unionByName(spark.createDataFrame([(str(root), "shared.zip", "a.md"), (str(root), "gone.pdf", "c.md")], data.edges.schema))
    more = archive.Dataset(data.emails, edges, data.raws, data.texts.where("false"))
    found, new = archive.completed(more, held)
    assert [r["name"] for r in found.collect()] == ["shared_unzipped_new.pdf"] and [tuple(r) for r in new.collect()] == [("shared_unzipped_new.pdf", "a.md")]
    state, findings = archive.quality_report(more, failed_messages=1)
    assert state.first()["status"] == "error"
    assert sorted((r["kind"], r["name"]) for r in findings.collect()) == [("no_file", "gone.pdf"), ("no_file", "shared.zip"), ("no_parent", "gone.pdf"), ("no_text", "shared.pdf")]
    raws = data.raws.unionByName(spark.createDataFrame([(str(root), "shared_unzipped_new.pdf", "p", "0")], data.raws.schema))
    with pytest.raises(integrity.IntegrityError, match="other files"):
        archive.completed(archive.Dataset(data.emails, edges, raws, data.texts), held)


def test_old_sheets_and_rar_files_need_their_libraries(monkeypatch):
    from docloom.sources import office

    class Sheet:
        name, nrows = "S", 2

        def row_values(self, i):
            return [["a", ""], [2.0, "b"]][i]

    class Book:
        def sheets(self):
            return [Sheet()]

    monkeypatch.setitem(sys.modules, "xlrd", type("xlrd", (), {"open_workbook": staticmethod(lambda file_contents: Book())}))
    assert office.xls_markdown(b"x") == "## شیت: S\n\n| a |  |\n| --- | --- |\n| 2 | b |"
    monkeypatch.setitem(sys.modules, "rarfile", type("rarfile", (), {"RarFile": staticmethod(lambda f: ("rar", f.read()))}))
    assert office._archive("A.RAR", b"y") == ("rar", b"y")


def test_batches_fall_back_to_single_pages(spark):
    from docloom.operators import pages

    calls = []

    def single(contents):
        return [c.decode() for c in contents]

    def batch(contents, token):
        text = "".join(f"{token} {n} BEGIN\n{c.decode()}\n{token} {n} END\n" for n, c in enumerate(contents, 1))
        return text if b"break" not in contents[0] else text[2:]

    rows = [("a", n, f"k{n}", f"text {n}") for n in range(7)] + [("b", 0, "k9", "break"), ("b", 1, "k10", "x"), ("c", 0, "k11", " ")]
    jobs = spark.createDataFrame([(d, p, k, bytearray(c.encode())) for d, p, k, c in rows], "doc string, page bigint, key string, content binary")
    got = {(r["doc"], r["page"]): r for r in pages.recognised_in_batches(jobs, single, batch, lambda x: bool(x.strip())).collect()}
    assert not calls and all(got["a", n]["text"] == f"text {n}" and got["a", n]["method"] == "batch" for n in range(7))
    assert [got["a", n]["requests"] for n in range(7)] == [1, 0, 0, 0, 0, 1, 0]
    assert (got["b", 0]["method"], got["b", 0]["fallback"], got["b", 0]["requests"], got["b", 1]["requests"]) == ("single", True, 2, 1)
    assert got["c", 0]["error"] and got["c", 0]["requests"] == 2
    halved = pages.recognised_in_batches(jobs, single, batch, bundle_bytes=14).where("doc = 'a'").collect()
    assert sorted(r["requests"] for r in halved) == [0, 0, 0, 1, 1, 1, 1]
    totals = pages.engine_totals(spark.createDataFrame([tuple(r) for r in got.values()], pages.ENGINE)).first()
    assert (totals["pages"], totals["batch_pages"], totals["fallbacks"], totals["failures"]) == (10, 7, 2, 1)


def test_marked_pages_warn_of_missing_anchors_scans_and_shrinkage(spark):
    from docloom.operators import pages

    text = "A page of text that is long enough to be healthy, NET WEIGHT included."
    mark = lambda n, x: f"RAGPAGE 000{n} BEGIN\n{x}\nRAGPAGE 000{n} END\n"
    page = lambda scan=False, chars=0, anchors=(): (scan, chars, list(anchors))
    rows = [
        ("ok", mark(1, text), [page(anchors=["NET WEIGHT"])]),
        ("scan", mark(1, text), [page(scan=True)]),
        ("shrunk", mark(1, text), [page(chars=1000)]),
        ("anchor", mark(1, text), [page(anchors=["CASING", "NET WEIGHT", "REPORT NO"])]),
        ("order", mark(2, text) + mark(1, text), [page(), page()]),
        ("lost", mark(1, text), [page(), page()]),
    ]
    docs = spark.createDataFrame(rows, "doc string, raw string, pages array<struct<scan:boolean,chars:bigint,anchors:array<string>>>")
    got = {(r["doc"], r["number"]): (r["status"], r["complete"], r["reasons"]) for r in pages.checked_markers(docs).collect()}
    assert got["ok", 1] == ("PASS", True, []) and got["scan", 1] == ("WARNING", True, ["scanned"]) and got["shrunk", 1][0] == "WARNING"
    assert got["anchor", 1][0] == "FAIL" and got["order", 1][0] == "FAIL" and got["order", 1][2] == ["order"]
    assert got["lost", 1] == ("PASS", False, []) and got["lost", 2][0] == "FAIL" and got["lost", 2][2] == ["no_boundaries"]
