"""From the ids and codes that a report cites to one verified original, or to a stated gap."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.functions import text as X

#: Codes that go to all texts at once; more are dealt in blocks.
CODE_BLOCK = 2000


def cited(reports: DataFrame, report: str, text: str) -> DataFrame:
    """(report, ref) of all canonical ids in the reports' texts."""
    return reports.select(F.col(report).alias("report"), F.explode(X.references(F.col(text))).alias("ref"))


def cited_codes(reports: DataFrame, report: str, text: str, pattern: str) -> DataFrame:
    return reports.select(F.col(report).alias("report"), F.explode(X.codes(F.col(text), pattern)).alias("code"))


def containing(texts: DataFrame, text: Column, codes: DataFrame, code: Column) -> DataFrame:
    """Rows of ``texts`` with each code that their text contains, ignoring case.

    A containment join has no key. The codes are the stated queries: they go to the tasks in blocks of at most about
    ``CODE_BLOCK``, each an automaton that reads a text once for all its codes; a (row, code) that is found then meets the
    rows of ``codes`` by equality. Texts are lower-cased once, below. A null text or code contains nothing and is
    contained in nothing; an empty code is in every text.
    """
    spark = texts.sparkSession
    wanted = codes.select(F.lower(code).alias("_code"), *codes.columns).where("_code is not null").distinct()
    each = wanted.select("_code").distinct()
    blocks = max(1, -(-each.count() // CODE_BLOCK))
    lowered = texts.select(*texts.columns, F.lower(text).alias("_low")).where("_low is not null")
    schema = T.StructType([*texts.schema.fields, T.StructField("_code", T.StringType())])
    out = None
    for i in range(blocks):
        own = each if blocks == 1 else each.where(F.pmod(F.xxhash64("_code"), F.lit(blocks)) == i)
        block = spark.sparkContext.broadcast([r["_code"] for r in own.toLocalIterator()])
        found = lowered.mapInArrow(_finder(block), schema)
        here = wanted if blocks == 1 else wanted.where(F.pmod(F.xxhash64("_code"), F.lit(blocks)) == i)
        part = found.join(F.broadcast(here), "_code").drop("_code")
        out = part if out is None else out.unionByName(part)
    return out


def _finder(block: Broadcast) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows once for each code of the block in their last column, which gives way to the code."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        always, patterns = [c for c in block.value if not c], ahocorasick.Automaton()
        for c in filter(None, block.value):
            patterns.add_word(c, c)
        patterns.make_automaton()
        for batch in batches:
            rows, found = [], []
            for i, low in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                own = {c for _, c in patterns.iter(low)} if len(patterns) else set()
                rows += [i] * (len(own) + len(always))
                found += [*own, *always]
            taken = batch.take(pa.array(rows, pa.int64()))
            columns = [*taken.columns[:-1], pa.array(found, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], "_code"])

    return run


def tight(value: Column) -> Column:
    """Without white space, lower case: how drawing codes and file stems are compared."""
    return F.lower(F.regexp_replace(value, r"(?U)\s+", ""))


def resolved(refs: DataFrame, originals: DataFrame, exact: dict[str, str], wider: dict[str, str]) -> DataFrame:
    """Each reference's original: by the exact key, else by the wider one; then by the number of distinct contents.

    ``originals`` has ``path`` and ``sha256``; ``exact`` and ``wider`` map columns of ``refs`` to columns of it. A state
    is resolved (one content; its smallest path), missing (none) or ambiguous (several: no guess).
    """

    def by(keys: dict[str, str], mark: str) -> DataFrame:
        there = originals.select(*[F.col(b).alias(f"_{a}") for a, b in keys.items()], "path", "sha256")
        same = [F.col(a) == F.col(f"_{a}") for a in keys]
        own = refs.join(there, same).drop(*[f"_{a}" for a in keys])
        return own.groupBy(*refs.columns).agg(
            F.count_distinct("sha256").alias(f"{mark}_n"), F.min(F.struct("sha256", "path")).alias(mark)
        )

    on = refs.columns
    first, second = by(exact, "_e"), by(wider, "_w")
    joined = refs.join(first, on, "left").join(second, on, "left")
    n = F.coalesce("_e_n", "_w_n", F.lit(0))
    state = F.when(n == 0, "missing").when(n == 1, "resolved").otherwise("ambiguous")
    best = F.when(state == "resolved", F.coalesce("_e", "_w"))
    return joined.select(*on, state.alias("state"), best["path"].alias("path"), best["sha256"].alias("sha256"))


def expanded(email_refs: DataFrame, emails: DataFrame) -> DataFrame:
    """References to e-mails with those to their attachments, one step on, without doubles."""
    own = emails.select(F.col("id").alias("_id"), F.explode("attachments").alias("_aid"))
    more = email_refs.join(own, F.col("ref") == F.col("_id")).select("report", F.col("_aid").alias("ref"))
    return email_refs.select("report", "ref").unionByName(more).distinct()


def plan_key(files: DataFrame) -> DataFrame:
    """``files(report, sha256, ref)``: each report's plan in one comparable array."""
    each = files.groupBy("report", "sha256").agg(F.array_sort(F.collect_set("ref")).alias("refs"))
    return each.groupBy("report").agg(F.array_sort(F.collect_list(F.struct("sha256", "refs"))).alias("plan"))


def unchanged(current: DataFrame, previous: DataFrame) -> DataFrame:
    """``(report, report_sha256, plan, unresolved)``: is there an equal earlier plan? new or unchanged."""
    old = previous.select("report", "report_sha256", "plan", "unresolved", F.lit(True).alias("_same")).distinct()
    joined = current.join(old, ["report", "report_sha256", "plan", "unresolved"], "left")
    return joined.select("report", F.when(F.col("_same"), "unchanged").otherwise("new").alias("state"))


def manifest_records(manifest: DataFrame, kind: str) -> DataFrame:
    """``manifest(file, bundles)``: e-mails or attachments of all bundles; of equal ids the last wins."""
    each = manifest.select(F.col("file").alias("_file"), F.posexplode("bundles").alias("_b", "bundle"))
    each = each.select("_file", "_b", F.posexplode(F.col("bundle")[kind]).alias("_r", "record"))
    return (
        each.groupBy(F.col("record.id").alias("id"))
        .agg(F.max_by("record", F.struct("_file", "_b", "_r")).alias("record"))
        .select("record.*")
    )


def report_title(lines: Column, name: Column) -> Column:
    """The line marked as title, or what follows an empty mark; else the file's stem. Illegal characters go."""
    mark = r"^عنوان\s*[:：]\s*"
    at = F.array_position(F.transform(lines, lambda x: x.rlike(mark)), True).cast("int")
    own = X.strip(F.regexp_replace(F.get(lines, at - 1), mark, ""))
    rest = F.filter(F.slice(lines, at + 1, F.size(lines) + 1), lambda x: x != "")
    title = F.when(at > 0, F.coalesce(F.nullif(own, F.lit("")), F.get(rest, F.lit(0))))
    clean = lambda x: F.regexp_replace(X.strip(x), r"[. ]+$", "")
    return F.coalesce(clean(F.regexp_replace(title, r'[<>:"/\\|?*\x00-\x1f]', "_")), clean(X.stem(name)))


def file_names(files: DataFrame) -> DataFrame:
    """``files(report, path_name, sha256, seq)``: one row per content; a name that is taken (ignoring case) gets a part of
    the hash."""
    from pyspark.sql import Window as W

    one = files.groupBy("report", "sha256").agg(F.min(F.struct("seq", "path_name")).alias("_f"))
    one = one.select("report", "sha256", "_f.seq", "_f.path_name")
    n = F.row_number().over(W.partitionBy("report", F.lower("path_name")).orderBy("seq"))
    marked = F.concat(X.stem(F.col("path_name")), F.lit("_"), F.substring("sha256", 1, 12), X.extension(F.col("path_name")))
    taken = (n > 1) | (F.lower("path_name") == F.lower("report"))
    return one.select("report", "sha256", "seq", F.when(taken, marked).otherwise(F.col("path_name")).alias("filename"))


