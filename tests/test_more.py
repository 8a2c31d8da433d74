"""Retries, page batches, repairs and the command line."""

import pytest

from docloom.__main__ import main
from docloom.functions.retry import is_transient, retried
from docloom.operators import integrity, pages


class Status(Exception):
    def __init__(self, status, retry_after=None):
        self.status, self.retry_after = status, retry_after


def test_four_attempts_for_transient_errors_one_for_others():
    calls, waits = [], []

    def fail(error):
        calls.append(1)
        raise error

    with pytest.raises(Status):
        retried(lambda: fail(Status(503, retry_after=100)), sleep=waits.append)
    assert len(calls) == 4 and waits == [60.0] * 3
    calls.clear()
    with pytest.raises(Status):
        retried(lambda: fail(Status(404)), sleep=waits.append)
    assert len(calls) == 1 and is_transient(TimeoutError()) and is_transient(OSError("Connection reset")) and not is_transient(ValueError())
    assert retried(lambda: 5) == 5


def test_page_batches(spark):
    rows = [("a", n, 100) for n in range(7)] + [("b", 0, 2 << 20), ("b", 1, 10)]
    got = pages.batched(spark.createDataFrame(rows, "doc string, page int, size long"), "doc", "page", "size").orderBy("doc", "page").collect()
    assert [r["batch"] for r in got] == [1, 1, 1, 1, 1, 2, 2, 1, 2]


def test_parents_are_repaired_without_guessing(spark):
    broken = [("x", "d", "s", "1"), ("x", "d", "s", "2"), ("y", "d", "t", "1"), ("z", "d", "u", "1")]
    originals = [("m1", "d", "s", "2"), ("m1", "d", "s", "1"), ("m2", "d", "s", "1"), ("m3", "d", "t", "1"), ("m4", "d", "t", "1")]
    got = integrity.repaired_parents(
        spark.createDataFrame(broken, "parent string, date string, subject string, attachment string"),
        spark.createDataFrame(originals, "file string, date string, subject string, attachment string"),
    )
    assert {r["parent"]: (r["state"], r["file"]) for r in got.collect()} == {"x": ("repaired", "m1"), "y": ("ambiguous", None), "z": ("missing", None)}


def test_commands(spark, tmp_path):
    mails = tmp_path / "mails"
    mails.mkdir()
    (mails / "a.eml").write_bytes(b"Subject: s\r\nFrom: a@x\r\nDate: Wed, 20 Mar 2024 12:00:00 +0000\r\n\r\na body of some length for a chunk\r\n")
    main(["ingest", "--input", str(mails), "--output", str(tmp_path / "set")])
    rows = spark.read.parquet(str(tmp_path / "set/emails")).collect()
    assert [r["jalali_date"] for r in rows] == ["1403/01/01"]
    texts = tmp_path / "texts"
    texts.mkdir()
    (texts / "a.md").write_text(rows[0]["markdown"], encoding="utf-8")
    main(["chunks", "--input", str(texts), "--output", str(tmp_path / "chunks")])
    assert [r["chunk_id"] for r in spark.read.json(str(tmp_path / "chunks")).collect()] == ["a.md_msg_1"]
    main(["bundle", "--input", str(texts), "--output", str(tmp_path / "bundles")])
    manifest = spark.read.json(str(tmp_path / "bundles/manifest")).first()
    assert manifest["emails"][0]["source"] == "a.md" and manifest["file"] == "part_001.md"
