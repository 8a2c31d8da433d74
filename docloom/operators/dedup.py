"""Content hashes, first copies, variants, and names that collide."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docloom.functions import text as X


def content_groups(df: DataFrame, content: str, order: str) -> DataFrame:
    """One row per distinct content: its SHA-256, the first ``order`` and the number of copies.

    Only the hash travels, pre-aggregated; a content with very many copies stays one row a task.
    """
    return df.groupBy(F.sha2(F.col(content), 256).alias("sha256")).agg(
        F.min(order).alias("first"), F.count("*").alias("copies")
    )


def first_copies(df: DataFrame, content: str, order: str) -> DataFrame:
    """The rows of ``df`` that are the first of their content."""
    return df.join(content_groups(df, content, order).select(F.col("first").alias(order)), order, "left_semi")


def raw_id(sha256: Column) -> Column:
    return F.concat(F.lit("A-"), F.substring(sha256, 1, 20))


def email_id(path: Column) -> Column:
    return F.concat(F.lit("E-"), F.substring(F.sha2(path, 256), 1, 20))


def variant_id(sha256: Column, header: Column, body: Column) -> Column:
    """Raw id and a hash of the text that goes with it: kept header lines and the body."""
    text = F.concat(X.kept_header_lines(header), F.lit("\n"), X.strip(body))
    return F.concat(raw_id(sha256), F.lit("-T-"), F.substring(F.sha2(text, 256), 1, 12))


def variants(df: DataFrame) -> DataFrame:
    """``df(aid, seq, name, header, body, parents)``: one row per variant; the first text wins, names and parents gather."""
    return df.groupBy("aid").agg(
        F.min_by(F.struct("header", "body"), "seq").alias("text"),
        F.transform(F.array_sort(F.collect_list(F.struct("seq", "name"))), lambda x: x["name"]).alias("names"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("parents")))).alias("parents"),
    ).select("aid", "text.header", "text.body", "names", "parents")


def variants_of_raw(df: DataFrame) -> DataFrame:
    """``df(raw_id, aid)``: variants of each raw attachment, sorted."""
    return df.groupBy("raw_id").agg(F.array_sort(F.collect_set("aid")).alias("aids"))


def inverse_manifest(edges: DataFrame, child: str, parent: str) -> DataFrame:
    """Child to parents turned into parent to sorted distinct children."""
    return edges.groupBy(parent).agg(F.array_sort(F.collect_set(child)).alias("children"))


def numbered_names(df: DataFrame, name: str, order: str, *, out: str = "unique_name", style: str = "_{n}") -> DataFrame:
    """Names told apart, ignoring case: the second of a name gets number 2, and so on.

    A number that would make a name that is there as itself is passed over: the names that are there say which numbers of
    which name are taken, and each row counts up past them, so one pass is enough. Only names and order are numbered; the
    other columns stay where they are until the numbers are joined to them.
    """
    before, after = style.split("{n}")
    ending = X.extension(F.col(name)) if style.startswith("_") else F.lit("")
    base = F.substring(F.col(name), F.lit(1), F.length(name) - F.length(ending))
    form = rf"(?s)^(.*){re.escape(before)}([1-9][0-9]{{0,8}}){re.escape(after)}$"
    owner, number = F.regexp_extract(base, form, 1), F.regexp_extract(base, form, 2).try_cast("int")
    taken = df.select(F.lower(F.concat(owner, ending)).alias("_lower"), number.alias("_k")).where("_k > 1")
    taken = taken.groupBy("_lower").agg(F.array_sort(F.collect_set("_k")).alias("_taken"))
    narrow = df.select(F.lower(name).alias("_lower"), F.col(order).alias("_order"))
    n = F.row_number().over(W.partitionBy("_lower").orderBy("_order"))
    counted = narrow.withColumn("_n", n).where("_n > 1").join(taken, "_lower", "left")
    free = F.aggregate(F.coalesce("_taken", F.array().cast("array<int>")), F.col("_n"), lambda v, k: v + (k <= v).cast("int"))
    rows = df.join(counted.select("_lower", "_order", free.alias("_n")), (F.lower(name) == F.col("_lower")) & (F.col(order) == F.col("_order")), "left")
    tail = F.substring(F.col(name), F.length(name) - F.length(ending) + 1, F.length(ending))
    made = F.concat(base, F.lit(before), F.col("_n").cast("string"), F.lit(after), tail)
    return rows.withColumn(out, F.coalesce(made, F.col(name))).drop("_lower", "_order", "_n")


def numbered_ids(df: DataFrame, column: str, order: str) -> DataFrame:
    """Ids told apart over the whole table: the second of an id ends in _1, the third in _2."""
    n = F.row_number().over(W.partitionBy(column).orderBy(order)) - 1
    return df.withColumn(column, F.when(n == 0, F.col(column)).otherwise(F.concat_ws("_", column, n.cast("string"))))
