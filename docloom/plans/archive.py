"""Datasets of e-mails with attachments: loaded and checked, written as bundles, and collected as evidence for reports.

A dataset is a folder with ``emails/*.md``, ``emails/attachments/*``, ``attachment_manifest.json`` and the attachments'
texts in ``attachments_text`` and ``attachments_ocr_google``. All checks are joins; the driver sees a few keys of what
fails. Texts of an attachment that differ are variants of one raw document, never documents of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions import fixed
from docloom.functions import text as X
from docloom.operators import bundles, dedup, evidence, integrity
from docloom.sources import files, office

TEXT_FOLDERS = ("attachments_ocr_google", "attachments_text")


@dataclass
class Dataset:
    """emails(dataset, file, source, header, body), edges(dataset, name, parent), raws(dataset, name, path, sha256) and
    texts(dataset, file, path, header, body) of one or more datasets."""

    emails: DataFrame
    edges: DataFrame
    raws: DataFrame
    texts: DataFrame

    def union(self, other: Dataset) -> Dataset:
        return Dataset(*[a.unionByName(b) for a, b in zip(vars(self).values(), vars(other).values(), strict=True)])


def read(spark: SparkSession, folder: str) -> Dataset:
    """The tables of a dataset's folder."""
    folder = folder.rstrip("/")
    name = F.lit(folder).alias("dataset")

    def markdown(sub: str) -> DataFrame:
        if not files.exists(spark, f"{folder}/{sub}"):
            return spark.createDataFrame([], "dataset string, file string, path string, header string, body string")
        rows = files.read_markdown(spark, f"{folder}/{sub}")
        return rows.select(name, "file", F.concat(F.lit(f"{folder}/{sub}/"), "file").alias("path"), "header", "body")

    emails = markdown("emails").withColumnRenamed("path", "source").select("dataset", "file", "source", "header", "body")
    edges = files.read_manifest(spark, f"{folder}/attachment_manifest.json").select(name, F.col("attachment").alias("name"), "parent")
    raws = spark.createDataFrame([], "dataset string, name string, path string, sha256 string")
    if files.exists(spark, f"{folder}/emails/attachments"):
        found = files.scan(spark, f"{folder}/emails/attachments")
        raws = found.select(name, "name", "path", F.sha2("content", 256).alias("sha256"))
    texts = markdown(TEXT_FOLDERS[0])
    for sub in TEXT_FOLDERS[1:]:
        texts = texts.unionByName(markdown(sub))
    return Dataset(emails, edges, raws, texts)


def _within(dataset: str, name: Column) -> Column:
    return F.concat_ws("\n", dataset, name)


def original_names(texts: DataFrame) -> DataFrame:
    """``texts`` with the original's name that their header declares (null: none); two that differ are an error."""
    field = lambda key: F.nullif(F.regexp_extract(X.header_field(F.col("header"), fixed.KEYS[key]), r"([^/\\]*)$", 1), F.lit(""))
    a, b = field("attachment_name"), field("original_path")
    clash = F.raise_error(F.concat(F.lit("a header names two originals: "), "path"))
    return texts.withColumn("declared", F.when(a != b, clash).otherwise(F.coalesce(a, b)))


def linked(data: Dataset) -> tuple[DataFrame, DataFrame]:
    """Checked e-mails and attachments.

    emails: id, source, subject, date, message_id, header, body, attachments (sorted variant ids). attachments: aid, raw_id,
    raw_hash, header, body, sources (array of raw, markdown, name), parents (e-mail ids). Raised: attachments of the manifest
    that are not there, parents that are not there, e-mails that list what the manifest does not give them, texts that
    belong to no attachment, an attachment with two texts or with one that may belong to several.
    """
    both = {"dataset": "dataset"}
    integrity.require(data.edges, data.raws, both | {"name": "name"}, "attachments of the manifest that are not there")
    integrity.require(data.edges, data.emails, both | {"parent": "file"}, "parents of the manifest that are not there")
    listed = F.transform(F.regexp_extract_all("header", F.lit(r"(?m)^- attachments/(.+)$"), F.lit(1)), X.strip)
    claims = data.emails.select("dataset", F.col("file").alias("parent"), F.explode(listed).alias("name"))
    integrity.require(claims, data.edges, both | {"name": "name", "parent": "parent"}, "e-mails list what the manifest has not")

    mine = data.raws.join(data.edges.select("dataset", "name").distinct(), ["dataset", "name"], "left_semi")
    key = _within("dataset", F.col("name")).alias("name")
    candidates = original_names(data.texts).select(
        "path", _within("dataset", X.stem(F.col("file"))).alias("stem"), F.when(F.col("declared").isNotNull(), _within("dataset", F.col("declared"))).alias("declared")
    )
    found = integrity.matched_texts(mine.select(key, _within("dataset", X.stem(F.col("name"))).alias("stem")), candidates).persist()
    if bad := found.where("state = 'ambiguous'").head(5):
        raise integrity.IntegrityError(f"texts of attachments are not unique: {[r['name'] for r in bad]}")
    used = found.where("state = 'matched'").select("name", "path")
    integrity.require(data.texts, used, {"path": "path"}, "texts that belong to no attachment")

    text = data.texts.select(F.col("path").alias("markdown"), "header", "body")
    whole = mine.withColumn("_key", key).join(used.select(F.col("name").alias("_key"), F.col("path").alias("markdown")), "_key", "left")
    whole = whole.join(text, "markdown", "left").drop("_key").fillna("", ["header", "body"])
    whole = whole.withColumn("aid", dedup.variant_id(F.col("sha256"), F.col("header"), F.col("body")))
    ids = data.emails.withColumn("id", dedup.email_id(F.col("source")))
    owned = data.edges.join(whole.select("dataset", "name", "aid"), ["dataset", "name"])
    owned = owned.join(ids.select("dataset", F.col("file").alias("parent"), "id"), ["dataset", "parent"])
    children = owned.groupBy("id").agg(F.array_sort(F.collect_set("aid")).alias("attachments"))
    key_of = lambda k, other: F.coalesce(F.nullif(X.header_field(F.col("header"), fixed.KEYS[k]), F.lit("")), other)
    emails = ids.join(children, "id", "left").select(
        "id", "source", key_of("subject", X.stem(F.col("file"))).alias("subject"), key_of("jalali_date", F.lit(fixed.UNKNOWN)).alias("date"),
        key_of("message_id", F.lit("")).alias("message_id"), "header", "body", F.coalesce("attachments", F.array().cast("array<string>")).alias("attachments"),
    )
    source = F.struct(F.col("path").alias("raw"), "markdown", "name")
    one = whole.groupBy("aid").agg(
        F.first("sha256").alias("raw_hash"), F.min_by(F.struct("header", "body"), "path").alias("_t"), F.array_sort(F.collect_list(source)).alias("sources")
    )
    parents = owned.groupBy("aid").agg(F.array_sort(F.collect_set("id")).alias("parents"))
    attachments = one.join(parents, "aid").select(
        "aid", dedup.raw_id(F.col("raw_hash")).alias("raw_id"), "raw_hash", "_t.header", "_t.body", "sources", "parents"
    )
    return emails, attachments


def completed(data: Dataset, archives: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What the archives of a dataset (``archives(name, content)``) hold beyond it: files (name, sha256, content), and edges
    (name, parent) that the manifest lacks. What is there already stays untouched; another content under a name that is
    taken is refused."""
    found, more = office.flattened(archives, data.edges.select(F.col("name").alias("attachment"), "parent"))
    found = found.select(F.col("file").alias("name"), "sha256", "content")
    there = data.raws.select("name", F.col("sha256").alias("_there"))
    if bad := found.join(there, "name").where("sha256 <> _there").select("name").head(5):
        raise integrity.IntegrityError(f"other files have these names: {[r['name'] for r in bad]}")
    edges = more.select(F.col("attachment").alias("name"), "parent")
    return found.join(there, "name", "left_anti"), edges.join(data.edges, ["name", "parent"], "left_anti")


def quality_report(data: Dataset, *, failed_messages: int = 0, failed_files: int = 0) -> tuple[DataFrame, DataFrame]:
    """A dataset's state in one row (counts, error before warning before ok), and its findings (kind, name, parent):
    attachments of the manifest that are not there, parents that are not there, files that could have a text and have none."""
    names = data.raws.select("dataset", "name")
    text = data.texts.select("dataset", X.stem(F.col("file")).alias("_stem"), F.contains("path", F.lit(f"/{TEXT_FOLDERS[0]}/")).alias("_ocr"))
    have = text.groupBy("dataset", "_stem").agg(F.max("_ocr").alias("_ocr"))
    own = names.withColumn("_stem", X.stem(F.col("name"))).join(have, ["dataset", "_stem"], "left")
    kind = X.extension(F.col("name"))
    convertible = kind.isin(*fixed.OFFICE_EXTENSIONS, *fixed.OCR_EXTENSIONS)
    covered = F.when(kind == ".pdf", F.coalesce("_ocr", F.lit(False))).otherwise(F.col("_ocr").isNotNull())
    finding = lambda df, what, parent: df.select(F.lit(what).alias("kind"), "name", parent.alias("parent"))
    null = F.lit(None).cast("string")
    bare = finding(own.where(convertible & ~covered), "no_text", null)
    lost = finding(integrity.missing(data.edges, data.raws, {"dataset": "dataset", "name": "name"}), "no_file", null)
    orphans = data.edges.join(data.emails.select("dataset", F.col("file").alias("parent")), ["dataset", "parent"], "left_anti")
    findings = bare.unionByName(lost).unionByName(finding(orphans, "no_parent", F.col("parent")))
    n = lambda what: F.count(F.when(F.col("kind") == what, 1)).alias(what)
    row = findings.agg(n("no_text"), n("no_file"), n("no_parent")).withColumns({"failed_messages": F.lit(failed_messages), "failed_files": F.lit(failed_files)})
    errors = F.col("no_file") + F.col("no_parent") + F.col("failed_messages") + F.col("failed_files")
    counts = data.emails.agg(F.count("*").alias("emails")).crossJoin(data.raws.agg(F.count("*").alias("attachments")))  # single rows
    state = F.when(errors > 0, "error").when(F.col("no_text") > 0, "warning").otherwise("ok")
    return counts.crossJoin(row).withColumn("status", state), findings


def as_sections(attachments: DataFrame) -> DataFrame:
    """Attachments in the form that bundles render."""
    part = lambda name: F.transform("sources", lambda s: s[name]).alias
    return attachments.select("aid", "raw_id", part("name")("names"), part("raw")("raws"), part("markdown")("markdowns"), "header", "body")


def snapshot(spark: SparkSession, folders: list[str]) -> DataFrame:
    """Path and hash of every file of the datasets."""
    out = None
    for folder in folders:
        own = files.snapshot(files.scan(spark, folder))
        out = own if out is None else out.unionByName(own)
    return out


def bundle(
    spark: SparkSession, folders: list[str], output: str, *, max_words: int = fixed.BUNDLE_WORDS, max_bytes: int = fixed.BUNDLE_BYTES, layout: str = "inline"
) -> None:
    """Datasets to bundles with a manifest under ``output``, which must not exist. The sources are hashed before, again
    before anything is written, and after: what changed in between stops the run or is marked in the report."""
    files.check_new(spark, output, folders)
    before = snapshot(spark, folders).persist()
    before.count()
    data = read(spark, folders[0])
    for folder in folders[1:]:
        data = data.union(read(spark, folder))
    emails, attachments = linked(data)
    if not emails.head(1):
        raise ValueError("no Markdown e-mails")
    parts = as_sections(attachments)
    if layout == "inline":
        sections = bundles.assigned(bundles.email_sections(emails, parts), ["date", "source"], max_words=max_words, max_bytes=max_bytes).persist()
        texts = bundles.bundle_texts(sections)
    else:
        rows = bundles.appendix_sections(emails, parts)
        sections = bundles.assigned(rows, ["date", "source"], max_words=max_words, max_bytes=max_bytes, shared="shared").persist()
        texts = bundles.appendix_texts(sections, parts)
    if integrity.differences(before, snapshot(spark, folders), "path", "sha256").head(1):
        raise RuntimeError("sources changed while the bundles were made; nothing was written")
    texts.withColumn("file", bundles.file_of(F.col("bundle"))).write.parquet(f"{output}/bundles")
    lines = bundles.email_lines(spark.read.parquet(f"{output}/bundles"))
    named = sections.select("bundle", "id", "source", "words", "bytes").join(emails.select("id", "message_id", "attachments"), "id")
    named = named.join(lines, ["bundle", "id"]).withColumn("file", bundles.file_of(F.col("bundle")))
    files.write_jsonl(bundles.manifest(named), f"{output}/manifest")
    files.write_jsonl(attachments.drop("header", "body"), f"{output}/attachments")
    unchanged = not integrity.differences(before, snapshot(spark, folders), "path", "sha256").head(1)
    report = emails.agg(F.count("*").alias("emails")).crossJoin(
        attachments.agg(F.count("*").alias("attachments"), F.count_distinct("raw_id").alias("unique_raw_attachments"))
    )  # two single rows
    report = report.withColumns({"layout": F.lit(layout), "sources_unchanged": F.lit(unchanged)})
    files.write_jsonl(report, f"{output}/report")
    files.write_jsonl(before, f"{output}/sources")
    if not unchanged:
        raise RuntimeError("sources changed while the bundles were written; see the report")


# ---- evidence


def email_references(reports: DataFrame, emails: DataFrame, pattern: str) -> tuple[DataFrame, DataFrame]:
    """(report, ref) of e-mails that reports cite by id or by a code that the e-mail's text holds, and of codes that none
    holds."""
    cited = evidence.cited(reports, "report", "text").where("ref like 'E-%'")
    codes = evidence.cited_codes(reports, "report", "text", pattern)
    hits = evidence.containing(emails.select("id", "body"), F.col("body"), codes.select("code").distinct(), F.col("code")).select("id", "code")
    found = codes.join(hits, "code")
    lost = codes.join(hits.select("code").distinct(), "code", "left_anti")
    refs = cited.unionByName(found.select("report", F.col("id").alias("ref"))).distinct()
    return refs, lost.select("report", F.col("code").alias("ref"), F.lit("no e-mail holds this code").alias("reason"))


def evidence_files(
    reports: DataFrame, emails: DataFrame, attachments: DataFrame, messages: DataFrame, raws: DataFrame, *, codes: str, drawings: str
) -> tuple[DataFrame, DataFrame]:
    """What each report needs: (report, ref, role, path, sha256), and what is missing: (report, ref, reason).

    ``reports(report, text)``, ``emails(id, message_id, source_name, body, attachments)``, ``attachments(aid, raw_id,
    raw_hash, sources)``, ``messages(path, sha256, message_id, source_name)``, ``raws(path, sha256)``. An e-mail's original
    is found by message id and file name, else by message id; an attachment's by variant, else by raw id, and its hash must
    still be the manifest's; a drawing by its whole code in a file's stem. One content is one document; several are never
    chosen from, but all versions of a drawing are kept and marked.
    """
    asked, lost = email_references(reports, emails, codes)
    known = asked.join(emails.select(F.col("id").alias("ref"), "message_id", "source_name"), "ref", "left")
    unknown = known.where("message_id is null").select("report", "ref", F.lit("no such e-mail").alias("reason"))
    keys = known.where("message_id is not null").select("report", "ref", "message_id", "source_name")
    originals = messages.select("path", "sha256", F.col("message_id").alias("_id"), F.col("source_name").alias("_name"))
    found = evidence.resolved(keys, originals, {"message_id": "_id", "source_name": "_name"}, {"message_id": "_id"})
    found = found.select("report", "ref", F.lit("e-mail").alias("role"), "state", "path", "sha256")

    sources = attachments.select("aid", "raw_id", "raw_hash", F.explode("sources").alias("s"))
    there = sources.join(raws.select(F.col("path").alias("_path"), "sha256"), (F.col("s.raw") == F.col("_path")) & (F.col("raw_hash") == F.col("sha256")))
    there = there.select("aid", "raw_id", F.col("_path").alias("path"), "sha256")
    direct = evidence.cited(reports, "report", "text").where("ref like 'A-%'")
    by_mail = evidence.expanded(asked, emails.select("id", "attachments")).where("ref like 'A-%'")
    wanted = direct.withColumn("role", F.lit("attachment cited")).unionByName(by_mail.withColumn("role", F.lit("attachment of an e-mail")))
    wanted = wanted.groupBy("report", "ref").agg(F.min("role").alias("role"))
    theirs = evidence.resolved(wanted, there, {"ref": "aid"}, {"ref": "raw_id"}).select("report", "ref", "role", "state", "path", "sha256")

    plans = evidence.cited_codes(reports, "report", "text", drawings)
    stems = there.select("path", "sha256").distinct().withColumn("stem", X.stem(files.file_name(F.col("path"))))
    hits = evidence.containing(stems, evidence.tight(F.col("stem")), plans.select("code").distinct(), evidence.tight(F.col("code")))
    drawn = plans.join(hits.select("code", "path", "sha256"), "code", "left")
    versions = drawn.groupBy("report", "code").agg(F.count_distinct("sha256").alias("n"), F.collect_set(F.struct("sha256", "path")).alias("all"))
    one = versions.where("n = 1").select("report", "code", F.array_min("all").alias("f"), F.lit("drawing").alias("role"))
    more = versions.where("n > 1").select("report", "code", F.explode("all").alias("f"), F.lit("one of several versions of a drawing").alias("role"))
    drawn = one.unionByName(more).select("report", F.col("code").alias("ref"), "role", F.lit("resolved").alias("state"), "f.path", "f.sha256")
    unclear = versions.where("n <> 1").select("report", F.col("code").alias("ref"), F.lit("no drawing, or several versions").alias("reason"))

    every = found.unionByName(theirs).unionByName(drawn)
    why = F.when(F.col("state") == "missing", "no original").otherwise("several originals differ")
    missing = every.where("state <> 'resolved'").select("report", "ref", why.alias("reason"))
    return every.where("state = 'resolved'").drop("state"), missing.unionByName(unknown).unionByName(lost).unionByName(unclear)


def collection_plan(selected: DataFrame) -> DataFrame:
    """(report, sha256, path, filename, refs, roles): each content once a report, under a name that no other has."""
    order = F.struct("role", "ref", "path")
    one = selected.groupBy("report", "sha256").agg(
        F.min(order).alias("_f"), F.array_sort(F.collect_set("ref")).alias("refs"), F.array_sort(F.collect_set("role")).alias("roles")
    )
    rows = one.select("report", "sha256", F.col("_f.path").alias("path"), F.col("_f").alias("seq"), "refs", "roles")
    names = evidence.file_names(rows.select("report", files.file_name(F.col("path")).alias("path_name"), "sha256", "seq"))
    return rows.drop("seq").join(names.select("report", "sha256", "filename"), ["report", "sha256"])


def copied(plan: DataFrame, output: str) -> DataFrame:
    """``plan(path, sha256, folder, filename)`` copied below ``output``: (target, sha256, same). A copy is read again, and
    ``same`` says whether it has the hash that was planned. A file that is there is not written over."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import hashlib

        from pyarrow.fs import FileSystem, FileType

        def content(path: str) -> bytes:
            fs, at = FileSystem.from_uri(path)
            with fs.open_input_file(at) as f:
                return f.read()

        for pdf in frames:
            rows = []
            for path, sha, folder, name in zip(pdf["path"], pdf["sha256"], pdf["folder"], pdf["filename"], strict=True):
                target = f"{output}/{folder}/{name}"
                fs, at = FileSystem.from_uri(target)
                if fs.get_file_info(at).type == FileType.NotFound:
                    fs.create_dir(at.rsplit("/", 1)[0], recursive=True)
                    with fs.open_output_stream(at) as f:
                        f.write(content(path))
                rows.append((target, sha, hashlib.sha256(content(target)).hexdigest() == sha))
            yield pd.DataFrame(rows, columns=["target", "sha256", "same"])

    return plan.select("path", "sha256", "folder", "filename").mapInPandas(run, "target string, sha256 string, same boolean")


def collect(
    reports: DataFrame, emails: DataFrame, attachments: DataFrame, messages: DataFrame, raws: DataFrame, output: str, *, codes: str, drawings: str
) -> DataFrame:
    """Copies the originals that ``reports(report, title, path, sha256, text)`` need below ``output`` and returns each
    report's state: report, folder, status (new or unchanged), files, unresolved (their numbers).

    A report whose text and plan equal an earlier run's, and whose copies still have their hashes, is left as it is.
    Earlier reports that are not in this run stay in the manifest. Every copy is read again and must have its hash. Steps
    are tables below ``output``, in a folder that goes at the end.
    """
    spark, work = reports.sparkSession, f"{output}/_work"
    keep = lambda df, name: files.kept(df, work, name)
    given = (reports, emails, attachments, messages, raws)
    names = ("reports", "emails", "attachments", "messages", "raws")
    reports, emails, attachments, messages, raws = (keep(df, name) for df, name in zip(given, names, strict=True))
    selected, missing = evidence_files(reports, emails, attachments, messages, raws, codes=codes, drawings=drawings)
    selected, missing = keep(selected, "selected"), keep(missing, "missing")
    plan = keep(collection_plan(selected), "plan")
    record = F.struct("filename", "sha256", F.col("path").alias("source"), "refs", "roles")
    gathered = plan.groupBy("report").agg(F.array_sort(F.collect_list(record)).alias("files"))
    open_ = missing.groupBy("report").agg(F.array_sort(F.collect_set(F.struct("ref", "reason"))).alias("unresolved"))
    none = {"files": "array<struct<filename:string,sha256:string,source:string,refs:array<string>,roles:array<string>>>", "unresolved": "array<struct<ref:string,reason:string>>"}
    rows = reports.select("report", "title", "path", F.col("sha256").alias("report_sha256")).join(gathered, "report", "left").join(open_, "report", "left")
    rows = keep(rows.withColumns({k: F.coalesce(k, F.array().cast(t)) for k, t in none.items()}), "rows")
    manifest = f"{output}/collection_manifest"
    previous = spark.read.schema(f"report string, report_sha256 string, folder string, {', '.join(f'{k} {t}' for k, t in none.items())}").json(manifest) if files.exists(spark, manifest) else None
    if previous is not None:
        previous = keep(previous, "previous")
        there = files.scan(spark, output).select("path", F.sha2("content", 256).alias("sha256")).withColumn("path", F.url_decode(F.regexp_replace("path", r"\+", "%2B")))
        kept = previous.select("report", "folder", F.explode("files").alias("f")).withColumn("_end", F.concat(F.lit("/"), "folder", F.lit("/"), "f.filename"))
        found = there.withColumn("_end", F.regexp_extract("path", r"(/[^/]+/[^/]+)$", 1)).select("_end", F.col("sha256").alias("_sha")).distinct()
        broken = kept.join(found, (kept["_end"] == found["_end"]) & (F.col("f.sha256") == F.col("_sha")), "left_anti").select("report").distinct()
        same = previous.join(broken, "report", "left_anti").select("report", "report_sha256", "files", "unresolved", F.col("folder").alias("_old")).distinct()
        rows = rows.join(same, ["report", "report_sha256", "files", "unresolved"], "left")
        taken = previous.select(F.lower("folder").alias("title")).distinct()
    else:
        rows, taken = rows.withColumn("_old", F.lit(None).cast("string")), spark.createDataFrame([], "title string")
    named = rows.select("report", F.lit(1).alias("rank"), F.col("title").alias("name")).unionByName(
        taken.select(F.col("title").alias("report"), F.lit(0).alias("rank"), F.col("title").alias("name"))
    )
    named = named.withColumn("order", F.concat_ws("\n", F.col("rank").cast("string"), "report"))
    folders = dedup.numbered_names(named, "name", "order", style=" ({n})", out="folder").where("rank = 1").select("report", "folder")
    status = F.when(F.col("_old").isNotNull(), "unchanged").otherwise("new").alias("status")
    rows = rows.join(folders, "report").select("report", "path", "report_sha256", F.coalesce("_old", "folder").alias("folder"), "files", "unresolved", status)
    rows = keep(rows, "placed")
    new = rows.where("status = 'new'")
    own = new.select("path", F.col("report_sha256").alias("sha256"), "folder", F.col("report").alias("filename"))
    todo = new.select("folder", F.inline("files")).select(F.col("source").alias("path"), "sha256", "folder", "filename")
    if bad := copied(own.unionByName(todo), output).where("not same").head(5):
        raise RuntimeError(f"copies differ from their originals: {[r['target'] for r in bad]}")
    lines = rows.select("report", "report_sha256", "folder", "files", "unresolved")
    if previous is not None:
        lines = integrity.retained(previous, lines, "report")
    files.replace_json(lines, manifest)
    out = [r.asDict(recursive=True) for r in rows.select("report", "folder", "status", F.size("files").alias("files"), F.size("unresolved").alias("unresolved")).collect()]
    files.remove(spark, work)
    return spark.createDataFrame(out, "report string, folder string, status string, files int, unresolved int")
