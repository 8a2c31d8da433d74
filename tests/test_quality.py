"""Thresholds of text health, routing and gates."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from docloom.functions import fixed
from docloom.operators import pages, quality
from docloom.plans import flows
from docloom.queries import QUERIES

SENTENCE = "This is one ordinary English sentence about a small town."


def status_of(spark, text):
    rows = spark.createDataFrame([(text,)], "t string")
    return rows.select(quality.status(quality.metrics(F.col("t"))).alias("s")).first()["s"]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        (SENTENCE, "PASS"),
        ("i\nb\nS\n" * 40, "FAIL"),
        (SENTENCE + " DWG LENGTH", "WARNING"),
        ("", "FAIL"),
        (SENTENCE + " aaaaaa", "WARNING"),
        (SENTENCE + " aaaaaa bbbbb ccccc", "FAIL"),
        (SENTENCE + " " + "~" * 20, "FAIL"),
        ("![x](data) " + SENTENCE, "PASS"),
        ("\n".join([SENTENCE] * 12 + ["a"] * 5), "WARNING"),
    ],
)
def test_status(spark, text, want):
    assert status_of(spark, text) == want


def test_anchors(spark):
    source, text = "Packing List, CASING, QTY", "packing-list only"
    row = spark.createDataFrame([(source, text)], "s string, t string")
    missing = quality.missing_anchors(F.col("s"), F.col("t"))
    got = row.select(missing.alias("m"), quality.with_anchors(F.lit("PASS"), missing, F.size(quality.anchors_of(F.col("s")))).alias("x")).first()
    assert (got["m"], got["x"]) == (["CASING", "QTY"], "FAIL")


@pytest.mark.parametrize("block_bytes", [10**7, 10])
def test_anchors_in_blocks(spark, block_bytes):
    rows = spark.createDataFrame([(1, "Packing List, CASING, QTY", "packing-list only"), (2, "none", ""), (3, None, "QTY")], "i int, s string, t string")
    phrases = spark.createDataFrame([("Packing List",), ("CASING",), ("q t y",), ("QTY",), (None,), ("absent",)], "text string")
    got = {r["i"]: tuple(r["anchors"]) for r in quality.anchor_counts(rows, "s", "t", phrases, block_bytes=block_bytes).collect()}
    assert got == {1: (4, 3, False), 2: (0, 0, False), 3: (0, 0, False)}


def test_more_anchor_text_than_a_plan_holds(spark, tmp_path):
    spark.createDataFrame([(1, "x ABC"), (2, "y")], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    long = spark.range(11).selectExpr("id AS item_id", "concat(id, repeat('z', 1000000)) AS text")
    long.unionByName(spark.createDataFrame([(99, "abc")], "item_id long, text string")).write.parquet(str(tmp_path / "benchmark.parquet"))
    assert [tuple(r) for r in QUERIES["anchor_check"](spark, str(tmp_path)).collect()] == [(1, 1, 1, "WARNING")]


@pytest.mark.parametrize(("total", "mb", "want"), [(16, 1.0, 5), (10, 10.01, 5), (15, 10.0, 15), (50, 30.0, 5), (4, 11.0, 4)])
def test_page_cap(spark, total, mb, want):
    assert spark.range(1).select(quality.pages_to_process(F.lit(total), F.lit(mb)).alias("n")).first()["n"] == want


NORMAL = "این گزارش برای بررسی نتایج آزمون نمونه در شرکت است و نتیجه مطابق درخواست شده است"


@pytest.mark.parametrize(
    ("text", "reasons"),
    [
        (NORMAL, []),
        (" ".join(w[::-1] for w in NORMAL.split()), ["reversed", "unknown_persian"]),
        (SENTENCE + " (cid:124)", ["glyphs"]),
        ("", ["health", "little_text"]),
        ("qwx zzt " * 10, ["unknown_latin"]),
        ("\n".join(["ab"] * 8 + ["the longer line of this page"] * 4), ["fragments"]),
    ],
)
def test_routing(spark, text, reasons):
    row = spark.createDataFrame([(text,)], "t string")
    why = quality.routing(F.col("t"), F.col("t"), F.lit(0.0), F.lit(False), F.col("t"))
    assert row.select(why.alias("w")).first()["w"] == reasons


def test_gate_and_overlay(spark):
    rows = spark.createDataFrame(
        [(1, "x", True, "PASS", None), (2, "x", True, "FAIL", None), (3, "x", True, "FAIL", fixed.EMAIL_FIRST), (4, "x", False, "PASS", None), (5, "نیاز به OCR", None, None, None), (6, "x", None, None, None)],
        "id int, text string, ready boolean, status string, policy string",
    )
    names = {"text": "text", "ready": "ready", "state": "status", "policy": "policy"}
    assert sorted(r["id"] for r in quality.admitted(rows, **names).collect()) == [1, 3, 6]
    report = spark.createDataFrame([(2, "PASS")], "id int, status string")
    got = {r["id"]: r["status"] for r in quality.overlaid(rows, report, "id", ["status"]).collect()}
    assert got[2] == "PASS" and got[3] == "FAIL" and got[6] is None


def test_orientation(spark):
    rows = [("a", "up", 70), ("a", "left", 15), ("b", "up", 90), ("b", "left", 11), ("c", "up", 50), ("c", "left", 45)]
    got = quality.orientation(spark.createDataFrame(rows, "page string, direction string, letters int"), ["page"])
    assert {r["page"]: (r["direction"], r["sure"]) for r in got.collect()} == {"a": ("up", True), "b": ("up", True), "c": ("up", False)}


def source_pages(spark):
    rows = [("f", 1, NORMAL, "k1"), ("f", 2, "", "k2"), ("g", 1, "X", "k2"), ("g", 2, "", "k3"), ("g", 3, "", "k4")]
    df = spark.createDataFrame(rows, "file string, number int, raw string, key string")
    more = {"total": F.lit(3), "size_mb": F.lit(1.0), "span_text": F.col("raw"), "image_ratio": F.lit(0.0), "turned": F.lit(False), "content": F.col("key")}
    return df.withColumns(more)


def test_distinct_pages_go_to_ocr_once_and_failures_are_bounded(spark):
    def ocr(content: pd.Series) -> pd.Series:
        return content.map(lambda k: "" if k == "k4" else f"{SENTENCE} {k}")

    cache = spark.createDataFrame([], pages.CACHE)
    done, add = flows.hybrid_pages(source_pages(spark), ocr, cache)
    rows = {(r["file"], r["number"]): r for r in done.collect()}
    assert rows["f", 1]["method"] == "local" and rows["f", 1]["status"] == "PASS"
    assert rows["f", 2]["text"] == rows["g", 1]["text"] == f"{SENTENCE} k2"
    assert rows["g", 2]["status"] == "WARNING" and rows["g", 3]["status"] == "FAIL"
    stored = add.collect()
    assert sorted(r["key"] for r in stored) == ["k2", "k3"]

    def never(content: pd.Series) -> pd.Series:
        raise AssertionError(content.tolist())

    warm = spark.createDataFrame(stored, pages.CACHE)
    again, _ = flows.hybrid_pages(source_pages(spark).where("key <> 'k4'"), never, warm)
    assert {r["text"] for r in again.where("method = 'ocr'").collect()} == {f"{SENTENCE} k2", f"{SENTENCE} k3"}
    tampered = warm.withColumn("text", F.lit("changed"))
    assert pages.cached(warm.select("key"), tampered).where("text is not null").count() == 0


def test_pages_in_batches_are_the_same_pages(spark):
    def text(content):
        return f"{SENTENCE} {bytes(content).decode() if not isinstance(content, str) else content}"

    def batch(contents, token):
        return "".join(f"{token} {n} BEGIN\n{text(c)}\n{token} {n} END\n" for n, c in enumerate(contents, 1))

    rows = source_pages(spark).withColumn("content", F.encode(F.col("content").cast("string"), "utf-8"))
    empty = spark.createDataFrame([], pages.CACHE)
    plain, _ = flows.hybrid_pages(rows, lambda c: c.map(text), empty)
    batched, add = flows.hybrid_pages(rows, lambda c: c.map(text), empty, ocr_batch=batch)
    key = lambda df: sorted((r["file"], r["number"], r["method"], r["status"], r["text"]) for r in df.collect())
    assert key(plain) == key(batched) and add.count() > 0


def test_retries_are_counted(spark):
    rows = spark.createDataFrame([("a", "x"), ("b", "y")], "key string, content string")
    got = pages.recognised(rows, lambda c: c.map(lambda v: SENTENCE if v == "y" else None), tries=3).collect()
    assert {r["key"]: (r["requests"], r["status"]) for r in got} == {"a": (3, "FAIL"), "b": (1, "WARNING")}


def test_assembled_pages(spark):
    rows = [("f", 2, "two", "WARNING", "ocr"), ("f", 1, "one", "PASS", "local"), ("f", 3, "bad", "FAIL", "ocr")]
    df = spark.createDataFrame(rows, "file string, number int, text string, status string, method string")
    body = pages.assembled(df).first()["body"]
    assert body.index("one") < body.index(fixed.OCR_WARNING) < body.index("two") and "bad" not in body
    clean = spark.createDataFrame([(body,)], "b string").select(quality.without_failed_pages(F.col("b")).alias("c")).first()["c"]
    assert "## صفحه 2" in clean and "## صفحه 3" not in clean
