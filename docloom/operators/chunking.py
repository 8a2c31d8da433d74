"""Texts into chunks: greedy paragraph packing, thread sections, numbering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docloom.functions import fixed
from docloom.functions import text as X


def packed(text: Column, *, limit: int = fixed.CHUNK_CHARS, separator: str = "\n\n") -> Column:
    """Paragraphs in order, packed: a chunk closes before the paragraph that would take it beyond ``limit``.

    A longer paragraph is a chunk of its own; separators don't count. Each document is folded where it lies.
    """
    paragraphs = F.filter(F.transform(F.split(text, separator), X.strip), lambda p: p != "")
    empty = F.struct(
        F.array().cast("array<string>").alias("done"), F.array().cast("array<string>").alias("open"), F.lit(0).alias("n")
    )

    def add(state: Column, p: Column) -> Column:
        close = (state["n"] + F.length(p) > limit) & (F.size(state["open"]) > 0)
        joined = F.array_join(state["open"], separator)
        return F.struct(
            F.when(close, F.concat(state["done"], F.array(joined))).otherwise(state["done"]).alias("done"),
            F.when(close, F.array(p)).otherwise(F.concat(state["open"], F.array(p))).alias("open"),
            F.when(close, F.length(p)).otherwise(state["n"] + F.length(p)).alias("n"),
        )

    def finish(state: Column) -> Column:
        last = F.array(F.array_join(state["open"], separator))
        return F.when(F.size(state["open"]) > 0, F.concat(state["done"], last)).otherwise(state["done"])

    return F.aggregate(paragraphs, empty, add, finish)


def chunks(df: DataFrame, key: str, text: str, **options) -> DataFrame:
    """``df`` exploded to (key, part from 1, chunk text)."""
    return df.select(F.col(key), F.posexplode(packed(F.col(text), **options)).alias("_p", "chunk")).select(
        key, (F.col("_p") + 1).alias("part"), "chunk"
    )


def sections(body: Column) -> Column:
    """The messages of a thread document, trimmed; those of fewer than 15 characters go."""
    titles = r"### 📩 آخرین پیام \(پاسخ جاری\):|### 📜 پیام در تاریخچه مکاتبات:|\n---\n"
    parts = F.transform(F.split(body, titles), X.strip)
    return F.filter(parts, lambda s: F.length(s) >= fixed.MIN_SECTION_CHARS)


def email_chunks(emails: DataFrame) -> DataFrame:
    """``emails(file, subject, sender, jalali_date, folder, body)``: a chunk per message, numbered among those kept.

    A message's own From and Sent lines win over the document's.
    """
    each = emails.select("*", F.posexplode(sections(F.col("body"))).alias("_p", "section"))
    own = lambda name, other: F.coalesce(
        F.nullif(X.strip(F.regexp_extract("section", rf"(?i)>?\s*{name}:\s*([^\n\r]+)", 1)), F.lit("")), F.col(other)
    )
    rows = each.withColumn("sender", own("From", "sender")).withColumn("jalali_date", own("Sent", "jalali_date"))
    text = F.format_string(
        "موضوع: %s\nفرستنده: %s\nتاریخ: %s\nفایل والد: %s\n\nمتن پیام:\n%s", "subject", "sender", "jalali_date", "file", "section"
    )
    return rows.select(
        text.alias("text"),
        F.lit("email").alias("source_type"),
        F.col("file").alias("source_file"),
        "subject",
        "sender",
        F.col("jalali_date").alias("date_shamsi"),
        "folder",
        F.concat_ws("_msg_", "file", (F.col("_p") + 1).cast("string")).alias("chunk_id"),
    )


def attachment_chunks(attachments: DataFrame) -> DataFrame:
    """``attachments(file, attachment_name, kind, parents, policy, original_path, ocr_quality, pages_total,
    pages_processed, pages_range, complete, body)``, gated and overlaid before: packed chunks with their context."""
    first = F.col("policy").eqNullSafe(F.lit(fixed.EMAIL_FIRST))
    original = F.coalesce("original_path", "attachment_name")
    name = F.coalesce("attachment_name", "file")
    from docloom.operators.quality import without_failed_pages

    rows = attachments.withColumn("_body", F.when(first, without_failed_pages(F.col("body"))).otherwise(F.col("body")))
    coverage = F.format_string(
        "پوشش سند: %s از %s صفحه؛ صفحات %s؛ پردازش کامل: %s\n", "pages_processed", "pages_total", "pages_range", "complete"
    )
    role = F.format_string(
        "نقش پیوست: توضیح تکمیلی؛ متن ایمیل منبع اصلی زمینهٔ مکاتبه است.\nمتن OCR ممکن است ناقص باشد؛ برای جزئیات دقیق به فایل"
        " اصلی مراجعه کنید.\nفایل اصلی: %s\n",
        original,
    )
    context = F.concat(
        F.when(F.col("pages_total").isNotNull(), coverage).otherwise(""), F.when(first, role).otherwise("")
    )
    each = rows.select("*", context.alias("_context"), F.posexplode(packed(F.col("_body"))).alias("_p", "_chunk"))
    kind, parents = F.coalesce("kind", F.lit(fixed.UNKNOWN)), F.coalesce("parents", F.lit(fixed.UNKNOWN))
    text = F.concat(
        F.format_string("پیوست: %s (نوع: %s)\nایمیل مرتبط: %s\n\n", name, kind, parents), "_context", F.lit("محتوا:\n"), "_chunk"
    )
    return each.select(
        text.alias("text"),
        F.lit("attachment").alias("source_type"),
        F.col("file").alias("source_file"),
        name.alias("attachment_name"),
        parents.alias("parent_email"),
        kind.alias("type"),
        F.lit("supporting_attachment").alias("source_role"),
        original.alias("original_attachment"),
        F.coalesce("ocr_quality", F.lit(fixed.UNKNOWN)).alias("ocr_quality"),
        F.concat_ws("_part_", "file", (F.col("_p") + 1).cast("string")).alias("chunk_id"),
    )


def all_chunks(emails: DataFrame, attachments: DataFrame) -> DataFrame:
    """E-mail chunks, then attachment chunks; what only one kind has is null in the other."""
    return emails.unionByName(attachments, allowMissingColumns=True)


def preferred(low: DataFrame, high: DataFrame, key: str) -> DataFrame:
    """Both tables by key; ``high`` wins. No window: rows of ``low`` without a partner, and all of ``high``."""
    return low.join(high.select(key).distinct(), key, "left_anti").unionByName(high, allowMissingColumns=True)


def numbered(df: DataFrame, group: str, order: str) -> DataFrame:
    """``number`` from 1 and ``of`` within each group, and is it the last?"""
    own = W.partitionBy(group)
    rows = df.withColumn("number", F.row_number().over(own.orderBy(order))).withColumn("of", F.count("*").over(own))
    return rows.withColumn("is_last", F.col("number") == F.col("of"))


def success_numbers(df: DataFrame, order: str, ok: Column) -> DataFrame:
    """The rows that succeeded, numbered from 1 in their order over the whole table; failures take no number.

    Ranges of the order number their own rows, and the ranges' counts (a row each) say where each begins.
    """
    dealt = df.where(ok).repartitionByRange(order).sortWithinPartitions(order).withColumn("_range", F.spark_partition_id()).persist()
    counts = dealt.groupBy("_range").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    local = F.row_number().over(W.partitionBy("_range").orderBy(order))
    joined = dealt.withColumn("_local", local).join(counts.select("_range", before.alias("_before")), "_range")
    return joined.withColumn("number", F.col("_before") + F.col("_local")).drop("_range", "_local", "_before")
