"""Message files: an injected parser, messages in messages, and the columns of the archive.

The parser turns a file's bytes into a dict; one for RFC 822 files is here, others (a parser of another format) are
passed in. A file that cannot be parsed is a row with its error.
"""

from __future__ import annotations

import email
import email.policy
import hashlib
from collections.abc import Callable, Iterator
from email.utils import parsedate_to_datetime

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.functions import dates, fixed
from docloom.functions import text as X
from docloom.functions.messages import column, html_text

ATTACHMENT = "struct<name:string,hidden:boolean,data:binary>"
MESSAGE = (
    "path string, sha256 string, message_id string, subject string, sender string, to string, cc string, date timestamp,"
    f" modified timestamp, body string, html string, attachments array<{ATTACHMENT}>, error string"
)


def _leaves(part) -> Iterator:
    """Parts that hold no parts; an attached message is one, whatever it holds."""
    if part.get_content_type() == "message/rfc822" or not part.is_multipart():
        yield part
    else:
        for own in part.iter_parts():
            yield from _leaves(own)


def parse_rfc822(content: bytes) -> dict:
    m = email.message_from_bytes(content, policy=email.policy.default)
    plain, rich, files = None, None, []
    for part in _leaves(m):
        if part.get_content_type() == "message/rfc822":
            inner = part.get_payload(0)
            files.append({"name": "message.eml", "hidden": False, "data": inner.as_bytes()})
        elif part.get_filename():
            hidden = part.get_content_disposition() == "inline"
            files.append({"name": part.get_filename(), "hidden": hidden, "data": part.get_payload(decode=True) or b""})
        elif part.get_content_type() == "text/plain" and plain is None:
            plain = part.get_content()
        elif part.get_content_type() == "text/html" and rich is None:
            rich = part.get_content()
    try:
        date = parsedate_to_datetime(m["date"]) if m["date"] else None
    except ValueError:
        date = None
    fields = {k: str(m[h]) if m[h] else None for k, h in (("message_id", "message-id"), ("subject", "subject"), ("sender", "from"), ("to", "to"), ("cc", "cc"))}
    return fields | {"date": date, "body": plain, "html": rich, "attachments": files}


def parsed(files: DataFrame, parser: Callable[[bytes], dict] = parse_rfc822) -> DataFrame:
    """``files(path, modified, content)`` to messages."""
    names = ["path", "sha256", "message_id", "subject", "sender", "to", "cc", "date", "modified", "body", "html", "attachments", "error"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = []
            for path, modified, content in zip(pdf["path"], pdf["modified"], pdf["content"], strict=True):
                data = bytes(content)
                row = dict.fromkeys(names) | {"path": path, "modified": modified, "sha256": hashlib.sha256(data).hexdigest()}
                try:
                    row |= parser(data)
                    if row["date"] is not None:
                        row["date"] = pd.Timestamp(row["date"]).tz_convert("UTC").tz_localize(None) if row["date"].tzinfo else row["date"]
                except Exception as e:
                    row["error"] = f"{type(e).__name__}: {e}"
                rows.append(row)
            out = pd.DataFrame(rows, columns=names)
            out["date"] = pd.to_datetime(out["date"])
            yield out

    return files.select("path", "modified", "content").mapInPandas(run, MESSAGE)


def with_nested(files: DataFrame, parser: Callable[[bytes], dict] = parse_rfc822, *, suffixes: tuple[str, ...] = (".msg", ".eml")) -> DataFrame:
    """Messages of the files and of the messages attached to them, each content once, level by level until no new content
    is found."""
    one = files.withColumn("_sha", F.sha2("content", 256))
    first = one.groupBy("_sha").agg(F.min("path").alias("path"))  # hashes travel, contents do not
    level = parsed(one.join(first, ["_sha", "path"], "left_semi").drop("_sha"), parser).persist()
    out = level
    while True:
        inner = level.where("error is null").select(F.col("path").alias("_from"), "modified", F.inline("attachments"))
        own = inner.where(X.extension(F.col("name")).isin(*suffixes))
        new = own.select(F.concat_ws("!", "_from", "name").alias("path"), "modified", F.col("data").alias("content"))
        new = new.withColumn("sha256", F.sha2("content", 256)).dropDuplicates(["sha256"])
        new = new.join(out.select("sha256"), "sha256", "left_anti").drop("sha256")
        if not new.head(1):
            return out
        level = parsed(new, parser).persist()
        out = out.unionByName(level)


def archive_columns(messages: DataFrame) -> DataFrame:
    """Good messages with the archive's columns: sentinels, plain body, time, Jalali date, kept attachments by hash."""
    body = F.coalesce(F.nullif("body", F.lit("")), column(html_text, F.col("html")), F.lit(""))
    time = F.coalesce("date", "modified")
    kept = F.filter(
        F.transform(
            "attachments",
            lambda a, i: F.struct(
                X.file_name(
                    F.coalesce(
                        F.nullif(X.strip(F.regexp_replace(a["name"], "\\x00", "")), F.lit("")),
                        F.concat(F.lit("attachment_"), (i + 1).cast("string"), F.lit(".bin")),
                    )
                ).alias("name"),
                a["hidden"].alias("hidden"),
                a["data"].alias("data"),
                F.sha2(a["data"], 256).alias("sha256"),
            ),
        ),
        lambda a: X.keep_attachment(a["name"], F.octet_length(a["data"]), a["hidden"]),
    )
    return messages.where("error is null").select(
        "path",
        F.coalesce(F.nullif("message_id", F.lit("")), "sha256").alias("message_id"),
        F.coalesce(F.nullif("subject", F.lit("")), F.lit(fixed.NO_SUBJECT)).alias("subject"),
        F.coalesce("sender", F.lit(fixed.UNKNOWN)).alias("sender"),
        F.coalesce("to", F.lit(fixed.NONE)).alias("to"),
        F.coalesce("cc", F.lit(fixed.NONE)).alias("cc"),
        time.alias("time"),
        dates.jalali(time.cast("date")).alias("jalali_date"),
        X.strip(body).alias("body"),
        kept.alias("attachments"),
    )


def index(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Originals by id and name, and the files that could not be read."""
    good = messages.where("error is null")
    ids = F.coalesce(F.nullif("message_id", F.lit("")), "sha256")
    return (
        good.select("path", "sha256", ids.alias("message_id"), F.regexp_extract("path", r"([^/]+)$", 1).alias("source_name")),
        messages.where("error is not null").select("path", "error"),
    )
