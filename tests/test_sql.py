"""Queries against their SQL on rows that the test tables have only at larger sizes."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from docloom.functions import fixed, messages
from docloom.functions import text as X
from docloom.operators import pages
from docloom.sources import files

TEXTS = ["", "a text of some words", "", "", " \n ", "another text", "", "", "", "the last text"]
DOCUMENTS = [(i, x, "en", f"src{i % 3}", len(x)) for i, x in enumerate(TEXTS)]


def both(spark, folder, name, table, rows, schema, **more):
    """A query's rows and those of its SQL, over tables of ``rows``."""
    for at, (own, kind) in {table: (rows, schema), **more}.items():
        spark.createDataFrame(own, kind).coalesce(1).write.mode("overwrite").parquet(f"{folder}/{at}.parquet")
    db = duckdb.connect()
    for at in (table, *more):
        db.execute(f"CREATE VIEW {at} AS SELECT * FROM read_parquet('{folder}/{at}.parquet/*.parquet')")
    got = entry.queries()[name](spark, str(folder))
    want = db.execute(f"SELECT {', '.join(got.columns)} FROM ({entry.oracle_sql()[name]})").fetchall()
    return sorted(map(tuple, got.collect()), key=repr), sorted(want, key=repr)


def documents(spark, folder, name):
    return both(spark, folder, name, "documents", DOCUMENTS, "doc_id long, text string, lang string, source string, n_chars long")


def test_an_attachment_with_an_empty_text(spark, tmp_path):
    got, want = documents(spark, tmp_path, "attachment_texts")
    assert got == want
    fields = {k: F.lit("x") for k in ("attachment_name", "kind")} | {k: F.array().cast("array<string>") for k in ("parents", "notes")}
    md = [files.attachment_markdown(fields | {"body": F.lit(x).cast("string")}) for x in (None, " ")]
    assert all(r.endswith(fixed.NO_TEXT_BODY) for r in spark.range(1).select(*[m.alias(f"m{i}") for i, m in enumerate(md)]).first())


def test_an_email_with_an_empty_text(spark, tmp_path):
    got, want = documents(spark, tmp_path, "email_texts")
    assert got == want
    keys = ("message_id", "subject", "sender", "to", "cc", "jalali_date", "source_name")
    fields = {k: F.lit("x") for k in keys} | {"attachments": F.array().cast("array<string>")}
    md = [files.email_markdown(fields | {"body": F.lit(x).cast("string")}) for x in (None, "")]
    assert all(r.endswith(fixed.EMPTY_BODY) for r in spark.range(1).select(*[m.alias(f"m{i}") for i, m in enumerate(md)]).first())


def test_an_export_name_of_nothing(spark, tmp_path):
    got, want = documents(spark, tmp_path, "export_names")
    assert got == want and ("", 0) in {(name, doc) for doc, name in got}
    assert spark.range(1).select(X.export_name(F.lit(" ..")).alias("a")).first()["a"] == fixed.NO_NAME


def test_a_blank_page_comes_back(spark, tmp_path):
    got, want = documents(spark, tmp_path, "page_engine")
    assert got == want
    jobs = spark.createDataFrame([("a", 0, "k", bytearray())], "doc string, page bigint, key string, content binary")
    read = lambda contents: [bytes(c).decode() for c in contents]
    taken, refused = (pages.recognised_in_batches(jobs, read, None, *usable).first() for usable in ([lambda x: x is not None], []))
    assert (taken["text"], taken["error"], refused["text"]) == ("", None, None) and refused["error"]


def test_references_without_a_semicolon(spark, tmp_path):
    page = '<title>a &amp;&amp;&amp</title><p>b &lt c &#65 d</p><script>x && y &amp</script>&nbsp;e &'
    got, want = both(spark, tmp_path, "html_text", "pages", [(1, page), (2, None)], "page_id long, html string")
    assert got == want and got[0][1].startswith("a &&&amp\nb &lt c &#65 d")
    assert messages.html_text(page).startswith("a &&&\nb < c A d") and messages.html_text("&\ufdd0;&\ufdd0amp", True) == "&\ufdd0;&\ufdd0amp"


def test_a_code_with_a_line_break(spark, tmp_path):
    docs = [(1, "x One two\nthree four y", "en", "s", 1), (2, "a\tB c  d e", "en", "s", 1)]
    items = ([(1, "one two\nthree four five"), (2, "A b C d five")], "item_id long, text string")
    got, want = both(spark, tmp_path, "stem_contains_join", "documents", docs, "doc_id long, text string, lang string, source string, n_chars long", benchmark=items)
    assert got == want == [(2, 2)]


TURNS = ["A line of more than forty-five characters that stays here.\nAsco.\nA last line.", "Asco.", "One.\nTwo co.", "Long, long, long, long, long, long, long, and de co.", "One.\nTwo.\nCo."]
CONVERSATIONS = [(i % 2, i, "user", x) for i, x in enumerate(TURNS)]


@pytest.mark.parametrize("name", ["message_cleaning", "newest_messages", "quoted_messages", "thread_cleaning"])
def test_lines_above_a_signature(spark, tmp_path, name):
    got, want = both(spark, tmp_path, name, "conversations", CONVERSATIONS, "conv_id long, turn long, role string, text string")
    assert got == want
    first = TURNS[0].split("\n")
    assert [messages.clean_body(x) for x in TURNS] == [f"{first[0]}\n{first[2]}", "", "", "", ""]
    assert messages.latest_message(TURNS[1]) == fixed.EMPTY_BODY
