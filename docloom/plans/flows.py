"""Whole flows, composed of the operators."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.functions import fixed
from docloom.functions.messages import clean_thread, column, page_text
from docloom.operators import chunking, dedup, pages, quality
from docloom.sources import files, mail


def dedup_gate_chunk(docs: DataFrame, *, separator: str = "\n", limit: int = fixed.CHUNK_CHARS) -> DataFrame:
    """First copies of each text, healthy ones alone, packed into chunks: (doc_id, part, n_chars, chunk_id).

    Health is judged where the rows are read; only hashes are shuffled to find copies.
    """
    own = docs.select("doc_id", "text")
    kept = dedup.first_copies(own, "text", "doc_id")
    healthy = kept.where(quality.status(quality.metrics(F.col("text"))) != "FAIL")
    parts = chunking.chunks(healthy, "doc_id", "text", limit=limit, separator=separator)
    name = F.concat_ws("_part_", F.col("doc_id").cast("string"), F.col("part").cast("string"))
    return parts.select("doc_id", "part", F.length("chunk").alias("n_chars"), name.alias("chunk_id"))


def emails_from_files(found: DataFrame, parser: Callable[[bytes], dict] = mail.parse_rfc822) -> DataFrame:
    """Message files (nested ones too) to e-mails with cleaned threads and their Markdown."""
    rows = mail.archive_columns(mail.with_nested(found, parser))
    rows = rows.withColumn("body", column(clean_thread, F.col("body")))
    names = F.transform("attachments", lambda a: a["name"])
    source = F.regexp_extract("path", r"([^/]+)$", 1)
    columns = {c: F.col(c) for c in ("message_id", "subject", "sender", "to", "cc", "jalali_date", "body")}
    text = files.email_markdown(columns | {"source_name": source, "attachments": names})
    return rows.withColumn("markdown", text)


def hybrid_pages(
    source: DataFrame,
    ocr: Callable[[pd.Series], pd.Series],
    cache: DataFrame,
    *,
    tries: int = 2,
    ocr_batch: Callable[[list[bytes], str], str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Healthy pages keep their own text, others go to OCR: distinct ones, unknown to the cache, once each.

    With ``ocr_batch`` the pages of a document go in batches, those that a batch does not answer well alone
    (``pages.recognised_in_batches``).

    ``source(file, number, total, size_mb, raw, span_text, image_ratio, turned, key, content)``. Returns pages
    (file, number, method, status, text) and the results to add to the cache.
    """
    wanted = source.where(F.col("number") <= quality.pages_to_process(F.col("total"), F.col("size_mb")))
    own = wanted.withColumn("_text", page_text(F.col("raw")))
    reasons = quality.routing(F.col("raw"), F.col("_text"), F.col("image_ratio"), F.col("turned"), page_text(F.col("span_text")))
    routed = own.withColumn("_reasons", reasons)
    local = routed.where(F.size("_reasons") == 0).select(
        "file", "number", F.lit("local").alias("method"), quality.status(quality.metrics(F.col("_text"))).alias("status"), F.col("_text").alias("text")
    )
    asked = routed.where(F.size("_reasons") > 0).select("file", "number", "key", "content")
    jobs = asked.select("key", "content").dropDuplicates(["key"])
    known = pages.cached(jobs.select("key"), cache).where("text is not null")
    if ocr_batch is None:
        fresh = pages.recognised(jobs.join(known, "key", "left_anti"), ocr, tries=tries).persist()
    else:
        places = asked.groupBy("key").agg(F.min(F.struct("file", "number")).alias("_p")).join(known, "key", "left_anti")
        first = places.select("key", F.col("_p.file").alias("doc"), F.col("_p.number").cast("long").alias("page"))
        unknown = first.join(jobs, "key").select("doc", "page", "key", "content")
        fresh = pages.judged(pages.recognised_in_batches(unknown, lambda contents: list(ocr(pd.Series(contents))), ocr_batch)).persist()
    texts = known.select("key", "text", F.lit("WARNING").alias("status")).unionByName(fresh.select("key", "text", "status"))
    seen = pages.fan_out(texts, asked.select("file", "number", "key")).select(
        "file", "number", F.lit("ocr").alias("method"), F.coalesce("status", F.lit("FAIL")).alias("status"), "text"
    )
    return local.unionByName(seen), pages.update_cache(cache, fresh.where("text is not null"))
