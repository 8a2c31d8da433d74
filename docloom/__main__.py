"""Command line: python -m docloom ingest | chunks | bundle | collect | search ..."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from docloom.functions import fixed
from docloom.functions import text as X
from docloom.operators import bundles, chunking, dedup, evidence, search
from docloom.plans import archive, flows
from docloom.sources import files, mail, office


def ingest(spark: SparkSession, a: argparse.Namespace) -> None:
    """Message files to e-mails, stored attachments (each content once) and their edges."""
    files.check_paths(a.input, a.output)
    rows = flows.emails_from_files(files.scan(spark, a.input, "*.eml")).withColumn("file", F.concat(F.sha2("path", 256), F.lit(".md")))
    rows.select("file", "markdown", *[c for c in rows.columns if c not in ("file", "markdown", "attachments")]).write.parquet(f"{a.output}/emails")
    each = rows.select("file", F.inline("attachments"))
    stored = each.groupBy("sha256").agg(F.min("name").alias("name"), F.first("data").alias("content"))
    stored.write.parquet(f"{a.output}/attachments")
    each.select(F.col("sha256").alias("attachment"), F.col("file").alias("parent")).distinct().write.parquet(f"{a.output}/edges")
    office.converted(spark.read.parquet(f"{a.output}/attachments")).write.parquet(f"{a.output}/attachment_texts")
    mail.index(mail.with_nested(files.scan(spark, a.input, "*.eml")))[1].write.json(f"{a.output}/errors")


def chunks(spark: SparkSession, a: argparse.Namespace) -> None:
    """Markdown e-mails to JSON lines of chunks."""
    rows = files.read_markdown(spark, a.input)
    field = lambda k, other: F.coalesce(F.nullif(X.header_field(F.col("header"), fixed.KEYS[k]), F.lit("")), other)
    emails = rows.select(
        "file", field("subject", F.col("file")).alias("subject"), field("sender", F.lit(fixed.UNKNOWN)).alias("sender"),
        field("jalali_date", F.lit("")).alias("jalali_date"), field("folder", F.lit("")).alias("folder"), "body",
    )
    files.write_jsonl(chunking.email_chunks(emails), a.output)


def bundle(spark: SparkSession, a: argparse.Namespace) -> None:
    """Datasets (or folders of Markdown e-mails alone) to bundles of bounded size, with a manifest."""
    folders = a.input.split(",")
    limits = {"max_words": a.max_words, "max_bytes": int(a.max_mb * 1e6)}
    if any(files.exists(spark, f"{x}/attachment_manifest.json") for x in folders):
        archive.bundle(spark, folders, a.output, layout=a.layout, **limits)
        return
    files.check_new(spark, a.output, folders)
    rows = files.read_markdown(spark, folders[0])
    key = lambda k: X.header_field(F.col("header"), fixed.KEYS[k])
    emails = rows.select(
        dedup.email_id(F.col("file")).alias("id"), F.col("file").alias("source"), key("subject").alias("subject"), key("message_id").alias("message_id"),
        F.coalesce(F.nullif(key("jalali_date"), F.lit("")), F.lit(fixed.UNKNOWN)).alias("date"), "header", "body", F.array().cast("array<string>").alias("attachments"),
    )
    none = spark.createDataFrame([], "aid string, raw_id string, names array<string>, raws array<string>, header string, body string")
    sections = bundles.assigned(bundles.email_sections(emails, none), ["date", "source"], **limits).persist()
    bundles.bundle_texts(sections).withColumn("file", bundles.file_of(F.col("bundle"))).write.parquet(f"{a.output}/bundles")
    lines = bundles.email_lines(spark.read.parquet(f"{a.output}/bundles"))
    named = sections.join(emails.select("id", "message_id", "attachments"), "id").join(lines, ["bundle", "id"])
    files.write_jsonl(bundles.manifest(named.withColumn("file", bundles.file_of(F.col("bundle")))), f"{a.output}/manifest")


def collect(spark: SparkSession, a: argparse.Namespace) -> None:
    """The originals that DOCX reports cite, copied below the output; without --datasets only the cited ids and codes."""
    docx = files.scan(spark, a.input, "*.docx").where("name not like '~$%'")
    found = office.converted(docx).where("error is null")
    if not a.datasets:
        refs = evidence.cited(found, "name", "body").withColumn("kind", F.lit("id"))
        codes = evidence.cited_codes(found, "name", "body", a.codes).select("report", F.col("code").alias("ref"), F.lit("code").alias("kind"))
        files.write_jsonl(refs.unionByName(codes), a.output)
        return
    files.check_paths(a.input, a.output)
    folders = a.datasets.split(",")
    data = archive.read(spark, folders[0])
    for folder in folders[1:]:
        data = data.union(archive.read(spark, folder))
    emails, attachments = archive.linked(data)
    emails = emails.withColumn("source_name", X.header_field(F.col("header"), fixed.KEYS["source_name"])).persist()
    messages = files.scan(spark, a.messages or a.input, "*.eml")
    index = mail.index(mail.with_nested(messages))[0]
    lines = X.lines(F.col("body"))
    reports = docx.select(F.col("name").alias("report"), "path", F.sha2("content", 256).alias("sha256")).join(
        found.select(F.col("name").alias("report"), evidence.report_title(lines, F.col("name")).alias("title"), F.col("body").alias("text")), "report"
    )
    state = archive.collect(reports, emails, attachments, index, data.raws, a.output, codes=a.codes, drawings=a.drawings)
    state.show(1000, truncate=60)


def nearest(spark: SparkSession, a: argparse.Namespace) -> None:
    """The rows of an index that are most similar to one of them."""
    rows = spark.read.parquet(a.input)
    one = rows.where(F.col(a.key) == a.id).select("embedding").first()
    search.nearest(rows, list(one["embedding"]), key=a.key, k=a.k).drop("embedding").show(truncate=80)


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="docloom", description=__doc__)
    commands = parser.add_subparsers(required=True)
    for f in (ingest, chunks, bundle, collect, nearest):
        p = commands.add_parser(f.__name__, help=f.__doc__)
        p.set_defaults(run=f)
        p.add_argument("--input", required=True)
        if f is not nearest:
            p.add_argument("--output", required=True)
        if f is bundle:
            p.add_argument("--max-words", type=int, default=fixed.BUNDLE_WORDS)
            p.add_argument("--max-mb", type=float, default=fixed.BUNDLE_BYTES / 1e6)
            p.add_argument("--layout", choices=("inline", "appendix"), default="inline")
        if f is collect:
            p.add_argument("--codes", default=fixed.CORRESPONDENCE_CODES)
            p.add_argument("--drawings", default=fixed.DRAWING_CODES)
            p.add_argument("--datasets", help="dataset folders, separated by commas")
            p.add_argument("--messages", help="folder of original messages")
        if f is nearest:
            p.add_argument("--key", default="vec_id")
            p.add_argument("--id", required=True)
            p.add_argument("-k", type=int, default=4)
    a = parser.parse_args(args)
    a.run(SparkSession.builder.getOrCreate(), a)


if __name__ == "__main__":
    main()
