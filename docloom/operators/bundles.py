"""E-mails with their attachments rendered and packed into bundles of bounded size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.functions import fixed
from docloom.functions import text as X
from docloom.functions.messages import column, shifted_headings

TITLE = "# آرشیو مکاتبات فنی — بستهٔ ایمیل و پیوست"
LIST_TITLE = "## فهرست ایمیل‌های این بسته"
NO_TEXT = "بدون متن استخراج‌شده؛ اصل فایل محفوظ است. از این وضعیت، خالی‌بودن اصل سند یا تصویر نتیجه‌گیری نشود."
APPENDIX_TITLE = "## متن پیوست‌های این بسته"
APPENDIX_PARENTS = "ایمیل‌های مرتبط در همین بسته: "
APPENDIX_TEXT = "متن در بخش پیوست‌های همین بسته موجود است"
APPENDIX_NO_TEXT = "بدون متن استخراج‌شده؛ اصل فایل محفوظ است"
EMAIL_ID = 22  # bytes of an e-mail's id
AGAIN = (1, EMAIL_ID + 3)  # words and bytes of one more e-mail in an attachment's list
NO_ATTACHMENT = "پیوست ذخیره‌شده‌ای در مانیفست این ایمیل ثبت نشده است."


def assigned(
    df: DataFrame,
    order: list[str],
    *,
    words: str = "words",
    size: str = "bytes",
    max_words: int = fixed.BUNDLE_WORDS,
    max_bytes: int = fixed.BUNDLE_BYTES,
    head: tuple[int, int] = (0, 0),
    run: str | None = None,
    shared: str | None = None,
) -> DataFrame:
    """``df`` with its bundle number in the given order.

    The fold resets with each bundle, so it needs the sizes in one sequence. Only (order, words, bytes) travels, and it
    is folded as a stream, a batch in memory at a time, never as a whole list. ``run`` names a column (mailbox, year)
    whose values are sequences of their own, folded side by side: that is how it grows with the cluster. ``shared`` names a
    column of parts (array of key, words, bytes) that a bundle holds once, however many of its units have them; a unit that
    repeats one adds ``AGAIN``. Units with equal order keys follow each other by size.
    """
    keys = [run] if run else []
    sized = df.withColumns({"_w": F.col(words).cast("long"), "_b": F.col(size).cast("long")})
    on = [*keys, *order, "_w", "_b", "_same"]
    if shared is None:
        sized = sized.withColumn("_parts", F.lit(None).cast("array<struct<key:string,words:bigint,bytes:bigint>>"))
    else:
        sized = sized.withColumn("_parts", F.col(shared))
    alike = W.partitionBy(*keys, *order, "_w", "_b").orderBy(F.xxhash64(*[c for c in df.columns if c != shared]))
    sized = sized.withColumn("_same", F.row_number().over(alike))
    narrow = sized.select(*on, "_parts")
    dealt = narrow.repartition(*keys) if run else narrow.repartition(1)
    dealt = dealt.sortWithinPartitions(*on)
    schema = dealt.select(*on).schema.add("bundle", T.IntegerType()).add("fits", T.BooleanType())

    def fold(batches):
        empty = {"words": head[0], "size": head[1], "empty": True, "seen": set()}
        state: dict = {"key": None, "number": 1, **empty}
        for pdf in batches:
            numbers, fits = [], []
            own = pdf[run].tolist() if run else [None] * len(pdf)
            for key, w, b, parts in zip(own, pdf["_w"].tolist(), pdf["_b"].tolist(), pdf["_parts"].tolist(), strict=True):
                if run and key != state["key"]:
                    state = {"key": key, "number": 1, **empty, "seen": set()}
                parts = [] if parts is None else [(p["key"], p["words"], p["bytes"]) for p in parts]
                alone = w + sum(p[1] for p in parts), b + sum(p[2] for p in parts)
                more = [AGAIN if p[0] in state["seen"] else p[1:] for p in parts]
                w, b = w + sum(m[0] for m in more), b + sum(m[1] for m in more)
                if not state["empty"] and (state["words"] + w > max_words or state["size"] + b > max_bytes):
                    state |= {"number": state["number"] + 1, **empty, "seen": set()}
                    w, b = alone
                state |= {"words": state["words"] + w, "size": state["size"] + b, "empty": False}
                state["seen"] |= {p[0] for p in parts}
                numbers.append(state["number"])
                fits.append(head[0] + alone[0] <= max_words and head[1] + alone[1] <= max_bytes)
            yield pdf.drop(columns=["_parts"]).assign(bundle=numbers, fits=fits)

    numbers = dealt.mapInPandas(fold, schema)
    joined = sized.drop("_parts").join(numbers, on)
    checked = F.when(F.col("fits"), F.col("bundle")).otherwise(
        F.raise_error(F.lit("an e-mail with its attachments exceeds a bundle"))
    )
    return joined.withColumn("bundle", checked.cast("int")).drop("fits", "_w", "_b", "_same")


def _source_lines(a: Column) -> Column:
    """Where an attachment's originals and extracted texts are, a line each."""
    line = lambda raw, text: F.concat_ws(
        "\n\n", F.concat(F.lit("مسیر اصل پیوست: "), raw), F.concat(F.lit("مسیر متن استخراج‌شده: "), text)
    )
    return F.array_join(F.zip_with(a["raws"], a["markdowns"], line), "\n\n")


def attachment_section(a: Column, email: Column) -> Column:
    """An attachment's part below an e-mail (``a``: struct aid, raw_id, names, raws, markdowns, header, body)."""
    kept = X.kept_header_lines(a["header"])
    body = F.when(X.strip(a["body"]) != "", a["body"]).otherwise(NO_TEXT)
    return F.concat_ws(
        "\n\n",
        F.concat(F.lit("### شروع پیوست "), a["aid"], F.lit(" — "), F.array_join(F.array_distinct(a["names"]), "؛ ")),
        F.concat(F.lit("ایمیل والد این نسخهٔ پیوست: "), email),
        F.concat(
            F.lit("شناسهٔ اصل مدرک: "), a["raw_id"], F.lit("؛ نسخه‌های متنی متفاوت این شناسه، مدرک مستقل نیستند.")
        ),
        _source_lines(a),
        F.nullif(F.regexp_replace(kept, "\n", "\n\n"), F.lit("")),
        body,
        F.concat(F.lit("### پایان پیوست "), a["aid"]),
    )


def email_sections(emails: DataFrame, attachments: DataFrame) -> DataFrame:
    """Each e-mail's line in the list and its section, with its attachments below it (the inline layout).

    ``emails(id, source, subject, date, header, body, attachments)``, ``attachments(aid, raw_id, names, raws, header,
    body)``, also with ``markdowns`` beside ``raws``; headings go down under the section's own. Words and bytes of a bundle are sums of these parts.
    """
    deep = _with_markdowns(attachments).withColumn("body", column(shifted_headings, F.col("body"), 3))
    one = emails.select("id", F.posexplode("attachments").alias("_n", "aid")).join(deep, "aid")
    fields = ["aid", "raw_id", "names", "raws", "markdowns", "header", "body"]
    parts = one.select("id", "_n", attachment_section(F.struct(*fields), F.col("id")).alias("part"))
    gathered = parts.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("_n", "part"))).alias("_parts"))
    rows = emails.withColumn("body", column(shifted_headings, F.col("body"), 2)).join(gathered, "id", "left")
    below = F.when(F.col("_parts").isNull(), F.lit(NO_ATTACHMENT)).otherwise(
        F.array_join(F.transform("_parts", lambda p: p["part"]), "\n\n")
    )
    rows = rows.select("id", "source", "date", _entry(), _section(below))
    both = F.concat_ws("\n\n", "entry", "section")
    return rows.withColumns({"words": X.count_words(both), "bytes": F.octet_length(both) + 4})


def _with_markdowns(attachments: DataFrame) -> DataFrame:
    if "markdowns" in attachments.columns:
        return attachments
    return attachments.withColumn("markdowns", F.transform("raws", lambda r: F.lit(None).cast("string")))


def _entry() -> Column:
    return F.format_string("- %s | %s | %s", "id", "date", "subject").alias("entry")


def _section(below: Column) -> Column:
    """An e-mail's section; what its list of attachments says is replaced by ``below``."""
    return F.concat_ws(
        "\n\n",
        F.format_string("## شروع ایمیل %s — %s", "id", "subject"),
        F.concat(F.lit("مسیر Markdown اصلی: "), "source"),
        F.lit("### مشخصات ایمیل"),
        X.strip(F.substring_index("header", fixed.KEYS["attachments"] + ":", 1)),
        F.lit("### متن و تاریخچهٔ همین ایمیل"),
        "body",
        F.lit("### پیوست‌های همین ایمیل"),
        below,
        F.format_string("## پایان ایمیل %s", "id"),
    ).alias("section")


def appendix_parts(attachments: DataFrame) -> DataFrame:
    """(aid, line, head, tail): an attachment's line below an e-mail, and its part of the appendix before and after the
    list of its e-mails."""
    deep = _with_markdowns(attachments).withColumn("body", column(shifted_headings, F.col("body"), 3))
    a = F.struct("aid", "raw_id", "names", "raws", "markdowns", "header", "body")
    has = X.strip(F.col("body")) != ""
    state = F.when(has, APPENDIX_TEXT).otherwise(APPENDIX_NO_TEXT)
    kept = F.nullif(F.regexp_replace(X.kept_header_lines(F.col("header")), "\n", "\n\n"), F.lit(""))
    tail = F.concat_ws(
        "\n\n", _source_lines(a), kept, F.when(has, F.col("body")).otherwise(NO_TEXT), F.concat(F.lit("### پایان پیوست "), "aid")
    )
    line = F.concat(F.lit("- "), "aid", F.lit(": "), F.array_join(F.array_distinct("names"), "؛ "), F.lit(" — "), state, F.lit("."))
    head = F.concat(F.lit("### شروع پیوست "), "aid", F.lit("\n\n"), F.lit(APPENDIX_PARENTS))
    return deep.select("aid", line.alias("line"), head.alias("head"), tail.alias("tail"))


def appendix_sections(emails: DataFrame, attachments: DataFrame) -> DataFrame:
    """As ``email_sections`` for the appendix layout: e-mails name their attachments, whose texts follow after all e-mails,
    once a bundle. ``shared`` has each attachment's share of a bundle, its first e-mail's id included."""
    parts = appendix_parts(attachments)
    one = emails.select("id", F.posexplode("attachments").alias("_n", "aid")).join(parts, "aid")
    text = F.concat_ws("\n\n", "head", "tail")
    share = F.struct(F.col("aid").alias("key"), (X.count_words(text) + 1).cast("long").alias("words"), (F.octet_length(text) + 2 + EMAIL_ID).cast("long").alias("bytes"))
    gathered = one.groupBy("id").agg(
        F.array_sort(F.collect_list(F.struct("_n", "line"))).alias("_lines"), F.collect_list(share).alias("shared")
    )
    rows = emails.withColumn("body", column(shifted_headings, F.col("body"), 2)).join(gathered, "id", "left")
    below = F.when(F.col("_lines").isNull(), F.lit(NO_ATTACHMENT)).otherwise(
        F.array_join(F.transform("_lines", lambda x: x["line"]), "\n\n")
    )
    rows = rows.select("id", "source", "date", "attachments", _entry(), _section(below), "shared")
    both = F.concat_ws("\n\n", "entry", "section")
    return rows.withColumns({"words": X.count_words(both), "bytes": F.octet_length(both) + 4})


def appendix_texts(sections: DataFrame, attachments: DataFrame) -> DataFrame:
    """The bundles' texts in the appendix layout; attachments in the order in which e-mails name them first."""
    order = F.struct("date", "source")
    named = sections.select("bundle", order.alias("_o"), "id", F.posexplode("attachments").alias("_n", "aid"))
    each = named.groupBy("bundle", "aid").agg(
        F.min(F.struct("_o", "_n")).alias("_first"), F.transform(F.array_sort(F.collect_list(F.struct("_o", "id"))), lambda x: x["id"]).alias("_ids")
    )
    part = F.concat_ws("\n\n", F.concat("head", F.array_join("_ids", "، ")), "tail")
    parts = each.join(appendix_parts(attachments), "aid").groupBy("bundle").agg(
        F.array_sort(F.collect_list(F.struct("_first", part.alias("part")))).alias("_parts")
    )
    own = F.array_sort(F.collect_list(F.struct("date", "source", "entry", "section")))
    whole = sections.groupBy("bundle").agg(own.alias("_e")).join(parts, "bundle", "left")
    join = lambda name: F.array_join(F.transform("_e", lambda e: e[name]), "\n\n")
    after = F.array_join(F.transform("_parts", lambda p: p["part"]), "\n\n")
    text = F.concat_ws("\n\n", F.lit(TITLE), F.lit(LIST_TITLE), join("entry"), join("section"), F.lit(APPENDIX_TITLE), after)
    return whole.select("bundle", F.concat(text, F.lit("\n")).alias("text"))


def file_of(bundle: Column) -> Column:
    return F.format_string("part_%03d.md", bundle)


def email_lines(texts: DataFrame) -> DataFrame:
    """``texts(bundle, text)``: first and last line of each e-mail's section in its file, from 1."""
    lines = texts.select("bundle", F.posexplode(F.split("text", "\n")).alias("_n", "_line"))
    mark = lambda word: F.regexp_extract("_line", rf"^## {word} ایمیل (E-[0-9a-f]{{20}})", 1)
    found = lines.select("bundle", "_n", mark("شروع").alias("_start"), mark("پایان").alias("_end")).where("_start <> '' or _end <> ''")
    return found.groupBy("bundle", F.greatest("_start", "_end").alias("id")).agg(
        (F.min("_n") + 1).cast("long").alias("start_line"), (F.max("_n") + 1).cast("long").alias("end_line")
    )


def bundle_texts(sections: DataFrame) -> DataFrame:
    """``sections(bundle, date, source, entry, section)``: the bundles' texts (each is bounded by its caps)."""
    own = F.array_sort(F.collect_list(F.struct("date", "source", "entry", "section")))
    each = sections.groupBy("bundle").agg(own.alias("_e"))
    join = lambda name: F.array_join(F.transform("_e", lambda e: e[name]), "\n\n")
    text = F.concat_ws("\n\n", F.lit(TITLE), F.lit(LIST_TITLE), join("entry"), join("section"))
    return each.select("bundle", F.concat(text, F.lit("\n")).alias("text"))


def line_ranges(df: DataFrame, bundle: str, order: str, text: str) -> DataFrame:
    """First and last line of each unit in its bundle, from 1."""
    n = F.regexp_count(F.col(text), F.lit("\n")) + 1
    own = W.partitionBy(bundle).orderBy(order)
    end = F.sum(n).over(own.rowsBetween(W.unboundedPreceding, 0))
    return df.withColumn("end_line", end).withColumn("start_line", F.col("end_line") - n + 1)


def manifest(emails: DataFrame) -> DataFrame:
    """``emails(bundle, file, id, source, message_id, attachments, start_line, end_line, words, bytes)``: a row per bundle
    with its e-mails nested."""
    record = F.struct("start_line", "id", "source", "message_id", "attachments", "end_line")
    return emails.groupBy("bundle", "file").agg(
        F.sum("words").alias("words"), F.sum("bytes").alias("bytes"), F.array_sort(F.collect_list(record)).alias("emails")
    )
