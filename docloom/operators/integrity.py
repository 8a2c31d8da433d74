"""Referential checks between manifests, files and e-mails, and differences between snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def missing(df: DataFrame, other: DataFrame, on: dict[str, str]) -> DataFrame:
    """Distinct keys of ``df`` that ``other`` lacks (``on``: column here to column there)."""
    keys = df.select(*[F.col(a).alias(f"_{i}") for i, a in enumerate(on)]).distinct()
    there = other.select(*[F.col(b).alias(f"_{i}") for i, b in enumerate(on.values())])
    gone = keys.join(there, [f"_{i}" for i in range(len(on))], "left_anti")
    return gone.select(*[F.col(f"_{i}").alias(a) for i, a in enumerate(on)])


class IntegrityError(ValueError):
    """Rows that should have a partner have none."""


def require(df: DataFrame, other: DataFrame, on: dict[str, str], what: str) -> None:
    """Raises with some of the missing keys unless all are there."""
    if some := missing(df, other, on).head(5):
        raise IntegrityError(f"{what}: {[tuple(r) for r in some]}")


def matched_texts(raw: DataFrame, candidates: DataFrame) -> DataFrame:
    """``raw(name, stem)`` with ``candidates(path, stem, declared)``: the text of each attachment.

    A text that declares its original's name goes to that alone; without a name it goes to a stem that only one
    attachment has. States: matched, none, ambiguous (two texts, or an undeclared one for several).
    """
    siblings = raw.groupBy("stem").agg(F.count("*").alias("siblings"))
    texts, own = candidates.where("path is not null"), [F.count("*").alias("n"), F.min("path").alias("path")]
    named = texts.where("declared is not null").groupBy("stem", F.col("declared").alias("name")).agg(F.struct(*own).alias("named"))
    open_to = texts.where("declared is null").groupBy("stem").agg(F.struct(*own).alias("open"))
    # counted by stem and by (stem, name), so that a stem of many files and texts is never paired
    joined = raw.join(siblings.join(open_to, "stem", "left"), "stem").join(named, ["stem", "name"], "left")
    alone = F.when(F.col("siblings") == 1, F.col("open"))
    found = joined.groupBy("name").agg(
        F.sum(F.coalesce("named.n", F.lit(0)) + F.coalesce(alone["n"], F.lit(0))).alias("n"),
        F.min(F.least("named.path", alone["path"])).alias("path"),
        F.bool_or(F.col("open").isNotNull() & (F.col("siblings") > 1)).alias("unclear"),
    )
    state = F.when(F.col("unclear") | (F.col("n") > 1), "ambiguous").when(F.col("n") == 1, "matched").otherwise("none")
    return found.select("name", state.alias("state"), F.when(state == "matched", F.col("path")).alias("path"))


def with_parents(files: DataFrame, edges: DataFrame, emails: DataFrame) -> DataFrame:
    """``files(name)`` with sorted parents from ``edges(name, parent)``; without any, the first e-mail of ``emails(file)``
    that shares the name's date and number."""
    prefix = r"^(\d{8}_\d{3}_)"
    own = edges.groupBy("name").agg(F.array_sort(F.collect_set("parent")).alias("parents"))
    firsts = emails.withColumn("_prefix", F.regexp_extract("file", prefix, 1)).where("_prefix <> ''")
    firsts = firsts.groupBy("_prefix").agg(F.min("file").alias("_first"))
    joined = files.join(own, "name", "left").withColumn("_prefix", F.regexp_extract("name", prefix, 1))
    joined = joined.join(firsts, "_prefix", "left")
    return joined.select("name", F.coalesce("parents", F.when(F.col("_first").isNotNull(), F.array("_first"))).alias("parents"))


def differences(before: DataFrame, after: DataFrame, key: str, value: str) -> DataFrame:
    """Rows that a snapshot lost, gained or changed; none if both are equal."""
    a = before.select(F.col(key).alias("key"), F.col(value).alias("_a"))
    b = after.select(F.col(key).alias("key"), F.col(value).alias("_b"))
    joined = a.join(b, "key", "full").where(~F.col("_a").eqNullSafe(F.col("_b")))
    change = F.when(F.col("_b").isNull(), "lost").when(F.col("_a").isNull(), "gained").otherwise("changed")
    return joined.select("key", change.alias("change"))


def same_sets(left: DataFrame, right: DataFrame, key: str, member: str) -> DataFrame:
    """For each key of both, are the members the same set?"""
    gather = lambda df, name: df.groupBy(key).agg(F.array_sort(F.collect_set(member)).alias(name))
    both = gather(left, "_l").join(gather(right, "_r"), key)
    return both.select(key, (F.col("_l") == F.col("_r")).alias("same"))


def new_or_changed(current: DataFrame, done: DataFrame, key: str, content: str) -> DataFrame:
    """Rows whose (key, content hash) an earlier run has not finished."""
    return current.join(done.select(key, content), [key, content], "left_anti")


def appended(edges: DataFrame, more: DataFrame) -> DataFrame:
    """Edges with more of them, each once."""
    return edges.unionByName(more).distinct()


def retained(previous: DataFrame, current: DataFrame, key: str) -> DataFrame:
    """Earlier rows that no current one replaces, then the current ones."""
    return previous.join(current.select(key), key, "left_anti").unionByName(current, allowMissingColumns=True)


def repaired_parents(broken: DataFrame, originals: DataFrame) -> DataFrame:
    """``broken(parent, date, subject, attachment)`` against ``originals(file, date, subject, attachment)``: the one message
    of that date and subject with the same set of attachments; missing or ambiguous otherwise, never a guess."""
    gather = lambda df, name: df.groupBy(name, "date", "subject").agg(F.array_sort(F.collect_set("attachment")).alias("own"))
    pairs = gather(broken, "parent").join(gather(originals, "file"), ["date", "subject", "own"], "left")
    found = pairs.groupBy("parent").agg(F.count("file").alias("n"), F.min("file").alias("file"))
    state = F.when(F.col("n") == 1, "repaired").when(F.col("n") == 0, "missing").otherwise("ambiguous")
    return found.select("parent", state.alias("state"), F.when(F.col("n") == 1, F.col("file")).alias("file"))
