"""Files as tables, read by Spark's own readers, and the sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions import fixed
from docloom.functions import text as X


def file_name(path: Column) -> Column:
    return F.url_decode(F.regexp_extract(F.regexp_replace(path, r"\+", "%2B"), r"([^/]+)$", 1))


def scan(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """Files below a folder: path, name, size, modified, content (read only if it is used)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(folder)
    return files.select(
        "path", file_name(F.col("path")).alias("name"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"), "content"
    )


def snapshot(files: DataFrame) -> DataFrame:
    return files.select("path", F.sha2("content", 256).alias("sha256"))


def read_markdown(spark: SparkSession, folder: str) -> DataFrame:
    """Markdown files: file, header, body."""
    raw = spark.read.option("pathGlobFilter", "*.md").text(folder, wholetext=True)
    rows = raw.select(file_name(F.col("_metadata.file_path")).alias("file"), X.split_header(F.col("value")).alias("_h"))
    return rows.select("file", "_h.header", "_h.body")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Attachment manifest as edges (attachment, parent); broken JSON counts as empty."""
    raw = spark.read.text(path, wholetext=True)
    parsed = F.from_json("value", "map<string,array<string>>")
    return raw.select(F.explode(parsed).alias("attachment", "parents")).select("attachment", F.explode("parents").alias("parent"))


def one_manifest(found: DataFrame, selected: str | None = None) -> str:
    """The path that is named, or the only one there is."""
    paths = [selected] if selected else [r["path"] for r in found.select("path").head(2)]
    if len(paths) != 1:
        raise ValueError("name the manifest: there is none, or more than one")
    return paths[0]


def check_paths(source: str, target: str) -> None:
    """Source and target must not contain each other."""
    a, b = (p.rstrip("/") + "/" for p in (source, target))
    if a.startswith(b) or b.startswith(a):
        raise ValueError(f"{source} and {target} overlap")


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def kept(df: DataFrame, folder: str, name: str) -> DataFrame:
    """``df`` as a table below ``folder``: what follows reads it, and its plan starts there."""
    path = f"{folder}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def check_new(spark: SparkSession, target: str, sources: list[str]) -> None:
    """Distinct sources, and a target that is not there and lies apart from them."""
    if not sources or len(set(sources)) != len(sources):
        raise ValueError("sources must be there and differ")
    if exists(spark, target):
        raise ValueError(f"{target} is there already; nothing was written")
    for source in sources:
        check_paths(source, target)


def replace_json(df: DataFrame, path: str) -> None:
    """JSON lines in place of those at ``path``: written beside them, then renamed."""
    spark, new = df.sparkSession, f"{path}.new"
    df.write.mode("overwrite").json(new)
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = fs_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    old = fs_path(f"{path}.old")
    fs.delete(old, True)
    if fs.exists(fs_path(path)) and not fs.rename(fs_path(path), old):
        raise OSError(f"{path} could not be set aside")
    if not fs.rename(fs_path(new), fs_path(path)):
        raise OSError(f"{new} could not be renamed")
    fs.delete(old, True)


def contained(path: str, root: str) -> str:
    """A path that stays below its root."""
    import posixpath

    full = posixpath.normpath(posixpath.join(root, path))
    if not full.startswith(root.rstrip("/") + "/"):
        raise ValueError(f"{path} leaves {root}")
    return full


def email_markdown(m: dict[str, Column], *, empty: str = fixed.EMPTY_BODY) -> Column:
    """An e-mail's Markdown from columns message_id, subject, sender, to, cc, jalali_date, source_name, attachments
    (array), body. A missing body (null) has a notice; ``empty`` is what an empty one has."""
    key, n = fixed.KEYS, F.size(m["attachments"])
    listed = F.when(n > 0, F.concat(F.lit("\n"), F.array_join(F.transform(m["attachments"], lambda a: F.concat(F.lit("- attachments/"), a)), "\n")))
    lines = [
        F.lit("---"),
        *[
            F.concat(F.lit(f"{key[k]}: "), F.coalesce(m[k], F.lit(other)))
            for k, other in {
                "message_id": "", "subject": fixed.NO_SUBJECT, "sender": fixed.UNKNOWN, "to": fixed.NONE,
                "cc": fixed.NONE, "jalali_date": fixed.DEFAULT_DATE, "source_name": "",
            }.items()
        ],
        F.concat(F.lit(f"{key['n_attachments']}: "), n.cast("string")),
        F.concat(F.lit(f"{key['attachments']}:"), F.coalesce(listed, F.lit(f" {fixed.NONE}"))),
        F.lit("---\n"),
        F.coalesce(F.when(m["body"] == "", F.lit(empty)), m["body"], F.lit(fixed.EMPTY_BODY)),
    ]
    return F.concat_ws("\n", *lines)


def attachment_markdown(a: dict[str, Column], *, empty: str = fixed.NO_TEXT_BODY) -> Column:
    """An attachment's Markdown from columns attachment_name, kind, parents (array), notes (array), body. A missing body
    (null) has a notice; ``empty`` is what a blank one has."""
    key, body = fixed.KEYS, X.strip(a["body"])
    items = lambda c: F.array_join(F.transform(c, lambda x: F.concat(F.lit("- "), x)), "\n")
    lines = [
        F.lit("---"),
        F.concat(F.lit(f"{key['attachment_name']}: "), a["attachment_name"]),
        F.concat(F.lit(f"{key['kind']}: "), a["kind"]),
        F.when(F.size(a["parents"]) > 0, F.concat(F.lit(f"{key['parents']}:\n"), items(a["parents"]))),
        F.when(F.size(a["notes"]) > 0, F.concat(F.lit(f"{key['notes']}: "), F.array_join(a["notes"], "؛ "))),
        F.lit("---\n"),
        F.coalesce(F.when(body == "", F.lit(empty)), body, F.lit(fixed.NO_TEXT_BODY)),
    ]
    return F.concat_ws("\n", *lines)


def write_jsonl(df: DataFrame, path: str) -> None:
    """JSON lines in UTF-8; an output that is there is never overwritten."""
    df.write.mode("errorifexists").json(path)


def write_texts(df: DataFrame, path: str, text: str = "text") -> None:
    """One value a row, by Spark's text sink."""
    df.select(F.col(text)).write.mode("errorifexists").option("lineSep", "\n\f\n").text(path)


def quality_report(covered: DataFrame) -> DataFrame:
    """``covered(name, ext, state, both)`` as one JSON row: counts and a status, error before warning before ok."""
    return covered.agg(
        F.count("*").alias("files"),
        F.count(F.when(F.col("state") == "covered", 1)).alias("covered"),
        F.count(F.when(F.col("state") == "missing", 1)).alias("missing"),
        F.count(F.when(F.col("state") == "not_text", 1)).alias("not_text"),
    ).select(
        "*",
        F.when(F.col("missing") > 0, "error").when(F.col("not_text") > 0, "warning").otherwise("ok").alias("status"),
        F.to_json(F.struct("files", "covered", "missing", "not_text")).alias("json"),
    )


def exit_code(processed: int, failed: int) -> int:
    """0: all well; 2: some failed; 1: nothing came of it."""
    return 0 if not failed else 2 if processed else 1
