"""Capped water-filling over sources, and seeded whole and fractional repetitions of documents.

Sources share all words by weight. A source whose share exceeds ``max_epochs`` times its size is clamped there, and
what it gives back is shared again by weight among the rest, until none is above its cap. A source of size S and
target T then takes each document floor(T / S) times whole, and in a seeded order once more those that fit what is
left of T; the document at the cut gives just its first words that still fit (a fractional repetition).

All of it is DataFrame work. Only sums travel to the driver. The seeded order is cut by a histogram over ``BINS``
hash bins (pre-aggregated before its shuffle); only the one bin that holds the cut is ordered row by row, so no task
sees a whole source.

A null text has size 0. A null source is a source of its own, after all others. A source of size 0 has target 0.
Rows with equal ids are told apart by their size, then by a hash of their text and kept columns; rows equal in all of
these are interchangeable. Null ids of one size share a place in the seeded order, told apart by that hash. Very long
texts are counted whole. Other columns may have any name: only ``keep`` is carried, in a struct. Empty tables give empty
results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from docloom.llm.common import integer_id, looked_up, stored

WORDS = r"[^\x20\x09-\x0D]+"
BINS = 4096


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORDS)), F.lit(0)).cast("long")


def source_order(sources: DataFrame, *, weights: int = 3) -> DataFrame:
    """``sources(source, source_size)`` with weight 1, 2, ... repeating by code point, null last.

    The order is dealt by ranges: each range numbers its own rows, and the ranges' counts (one number each) give its
    start.
    """
    dealt = sources.withColumn("isnull", F.col("source").isNull()).repartitionByRange("isnull", "source")
    dealt = dealt.sortWithinPartitions("isnull", "source").withColumn("range", F.spark_partition_id())
    local = dealt.withColumn("n", F.row_number().over(W.partitionBy("range").orderBy("isnull", "source")))
    counts = dealt.groupBy("range").count().withColumnRenamed("count", "of")
    before = F.coalesce(F.sum("of").over(W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("range", before.alias("before"))
    number = F.col("before") + F.col("n") - 1
    return local.join(starts, "range").select(
        "source", "isnull", "source_size", (F.pmod(number, F.lit(weights)) + 1).alias("weight")
    )


def water_fill(sources: DataFrame, *, max_epochs: int = 3) -> DataFrame:
    """``sources(source_size, weight, ...)`` with ``target``: the fixed point of clamping and sharing anew.

    A round clamps every source above its cap at the current level; a clamp only raises the level, so no clamp is
    ever taken back. The loop's state is two sums; a level is exact: (weight * words left) / (weights left).
    """
    cap = F.lit(max_epochs) * F.col("source_size")
    left, total = 0, None
    weight = None
    clamped = F.lit(False)
    while True:
        row = sources.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(clamped, cap)).alias("held"),
            F.sum(F.when(~clamped, F.col("weight"))).alias("weight"),
            F.count(F.when(clamped, 1)).alias("n"),
        ).first()
        if row["n"] == total or row["weight"] is None:
            break
        total, left, weight = row["n"], (row["all"] or 0) - (row["held"] or 0), row["weight"]
        clamped = F.col("weight").cast("decimal(38,0)") * left > cap.cast("decimal(38,0)") * weight
    level = (F.col("weight") * F.lit(left)).cast("double") / F.lit(weight or 1).cast("double")
    return sources.withColumn("target", F.when(clamped, cap.cast("double")).otherwise(level))


def seeded(key: Column, seed: str) -> Column:
    """A 52-bit number from the key and a seed, by MD5."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key)), 1, 13), 16, 10).cast("long")


def mix(docs: DataFrame, *, max_epochs: int = 3, seed: str = "mix", keep: tuple[str, ...] = ()) -> DataFrame:
    """Per document: doc_id, size, source_size, target, copies (whole), part (words of a last one) and taken.

    ``keep`` names columns of ``docs`` that the result carries along in a struct ``kept``.
    """
    rows = docs.select(
        integer_id(docs),
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("key"),
        size_of(F.col("text")).alias("size"),
        F.xxhash64("text", *[f"`{f.name}`" for f in docs.schema if f.name in keep and not isinstance(f.dataType, MapType)]).alias("tie"),
        *([F.struct(*keep).alias("kept")] if keep else []),
    )
    name = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.col("size").cast("string"))
    rows = rows.withColumn("h", seeded(name, seed)).withColumn("bin", F.shiftright("h", 40).cast("int"))
    bins = stored(rows.groupBy("key", "bin").agg(F.sum("size").alias("words"), F.count("*").alias("n")), "mix-bins")
    sources = bins.groupBy("key").agg(F.sum("words").alias("source_size"))
    source = F.when(F.col("key") != "", F.substring("key", 2, 1 << 30)).alias("source")
    sources = water_fill(stored(source_order(sources.select(source, "source_size")), "mix-sources"), max_epochs=max_epochs)
    size, target = F.col("source_size"), F.col("target")
    whole = F.when(size > 0, F.floor(target / size)).otherwise(0).cast("long")
    sources = sources.withColumn("whole", whole).withColumn("rest", target - F.col("whole") * size)
    sources = sources.withColumn("key", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))
    before = F.sum("words").over(W.partitionBy("key").orderBy("bin").rowsBetween(W.unboundedPreceding, -1))
    room = F.col("rest") - F.coalesce(F.col("before"), F.lit(0))
    cuts = bins.withColumn("before", before).join(sources.select("key", "rest"), "key")
    cuts = cuts.where(room < F.col("words")).groupBy("key").agg(
        F.min(F.struct("bin", room.alias("give"))).alias("cut")
    )
    plan = sources.join(cuts, "key", "left").select(
        "key", "source_size", "target", "whole", F.col("cut.bin").alias("cut_bin"), F.col("cut.give").alias("give")
    )
    plan = stored(plan.join(bins.groupBy("key").agg(F.sum("n").alias("n")), "key"), "mix-plan")
    joined = rows.join(F.broadcast(plan.drop("n")), "key") if _few(plan) else looked_up(rows, plan, "key", "n")
    earlier = W.partitionBy("key", "bin").orderBy("h", "doc_id", "tie").rowsBetween(W.unboundedPreceding, -1)
    at_cut = F.coalesce((F.col("bin") == F.col("cut_bin")) & (F.col("give") > 0), F.lit(False))
    again = F.coalesce(F.col("bin") < F.col("cut_bin"), F.lit(True))
    sure = joined.where(~at_cut).withColumn("more", F.when(again, F.col("size")).otherwise(F.lit(0)))
    fits = F.floor("give").cast("long") - F.coalesce(F.sum("size").over(earlier), F.lit(0))
    cut = joined.where(at_cut).withColumn("more", F.greatest(F.lit(0), F.least(F.col("size"), fits)))
    full = F.col("more") >= F.col("size")
    copies = F.when(F.col("size") > 0, F.col("whole") + full.cast("long")).otherwise(F.lit(1))
    return sure.unionByName(cut).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        copies.alias("copies"),
        F.when(full, F.lit(0)).otherwise(F.col("more")).cast("long").alias("part"),
        (F.col("size") * F.col("whole") + F.col("more")).cast("long").alias("taken"),
        *(["kept"] if keep else []),
    )


def _few(plan: DataFrame, most: int = 10_000) -> bool:
    """Are there so few sources (a short row each) that their plan may be broadcast?"""
    return len(plan.select("key").head(most + 1)) <= most
