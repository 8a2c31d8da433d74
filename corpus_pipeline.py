"""The corpus pipeline: quality rules, near duplicates, benchmark decontamination, source mixing, token files.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame: documents again, and
in the last stage what the token files hold of each document.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from docloom.llm import decontamination, jaccard_join, mixing, quality_rules, token_store
from docloom.llm.common import looked_up, stored, table

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
#: Lines go and documents are judged by expressions that SQL has no equal for in one statement with the byte-level
#: tokenizer at the end; the tests compare run() with a brute-force version.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go, and documents that the rules reject.

    Null and empty texts have too few words and are rejected; rows are judged one by one, so repeated rows and null ids
    are rows like others; whole texts are judged, however long; an empty table stays empty.
    """
    return quality_rules.filter_documents(docs)


def hashable(docs: DataFrame) -> list[str]:
    """The columns that have a hash: all but maps."""
    return [f.name for f in docs.schema if not isinstance(f.dataType, MapType)]


def row_key(docs: DataFrame) -> Column:
    """A name of a row: a hash of its columns. Equal rows share it."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in hashable(docs)])


def chosen(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """``docs`` with (left_semi) or without (left_anti) the rows of ``keys(key)``, joined by a name that ``docs`` has not."""
    name = "key"
    while name.lower() in {c.lower() for c in docs.columns}:
        name = f"_{name}"
    return docs.join(keys.select(F.col("key").alias(name)), row_key(docs) == F.col(name), how)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: the one with the smallest doc_id.

    Rows with a null id come after all others; rows that share their id are told apart by ``row_key``, the smaller one
    first; of equal rows one stays. Texts without a word (null, empty) are near to none: all of them stay, equal rows
    once. Very long texts are compared whole. An empty table stays empty.
    """
    key = row_key(docs)
    found = jaccard_join.classes(docs.select(key.alias("doc_id"), "text")).select(F.col("doc_id").alias("key"), "class_id")
    rows = docs.select(key.alias("key"), F.col("doc_id").alias("id")).groupBy("key").agg(F.min("id").alias("id"), F.count("*").alias("n"))
    named = stored(rows.join(found.distinct(), "key"), "near-duplicates")
    order = F.struct(F.col("id").isNull().alias("last"), "id", "key")
    first = named.groupBy("class_id").agg(F.min(order).alias("first"), F.count("*").alias("rows"))
    first = stored(first.select("class_id", "rows", F.col("first.key").alias("stays")), "near-duplicate-classes")
    judged = looked_up(named, first, "class_id", "rows").select("key", "n", (F.col("key") == F.col("stays")).alias("stays"))
    kept = chosen(docs, judged.where("n > 1 or not stays"), "left_anti")
    repeated = chosen(docs, judged.where("n > 1 and stays"), "left_semi")
    return kept.unionByName(repeated.dropDuplicates(hashable(docs)))


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no phrase of the benchmark.

    Each row is judged by its own text: rows that share an id, null ids and repeated rows included. Null and empty texts
    hold nothing and stay; whole texts are searched, however long; an empty table stays empty.
    """
    found = decontamination.decontaminate(
        docs.select(row_key(docs).alias("doc_id"), "text"), table(spark, sf_dir, "benchmark")
    )
    return chosen(docs, found.where("n_hit > 0").select(F.col("doc_id").alias("key")).distinct(), "left_anti")


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it whole; the one at a source's cut if it gives half of it or more.

    A null source is a source of its own. Null and empty texts have no size and stay once. Ties of id and size are cut
    in the order of the rows' hashes; equal rows are interchangeable. An empty table stays empty.
    """
    mixed = mixing.mix(docs, keep=tuple(docs.columns))
    copies = F.col("copies") + (2 * F.col("part") >= F.col("size")).cast("long") * (F.col("part") > 0).cast("long")
    return mixed.select(F.inline(F.array_repeat("kept", copies.cast("int"))))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files and what they hold: doc_id, start, n_tokens, ids_crc32.

    Null and empty texts hold the end id alone; null ids come first; rows that share an id follow each other by text; an
    empty table writes no file and gives no row.
    """
    return token_store.round_trip(docs, VOCABULARY)


STAGES = [
    ("quality rules", quality),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", benchmark),
    ("mixing sources", mixture),
    ("token files", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stage's documents a table in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for n, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if n < len(STAGES):
            docs = stored(docs, f"pipeline-{n}")
    return docs
