"""Vectors: embedding by an injected model, exact cosine search, and the table that holds them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docloom.operators.dedup import numbered_ids


def embedded(df: DataFrame, text: str, model: Callable[[], Callable[[list[str]], np.ndarray]], *, batch: int = 64) -> DataFrame:
    """``df`` with ``embedding array<float>``: the model is made once a worker and gets texts in batches.

    Each distinct text is embedded once; rows with equal texts share the result.
    """
    distinct = df.select(F.col(text).alias("_text")).where("_text is not null").distinct()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        embed = model()
        for pdf in frames:
            values = pdf["_text"].tolist()
            vectors = [v for i in range(0, len(values), batch) for v in np.asarray(embed(values[i : i + batch]), "float32")]
            yield pd.DataFrame({"_text": values, "embedding": [v.tolist() for v in vectors]})

    made = distinct.mapInPandas(run, "_text string, embedding array<float>")
    return df.join(made, F.col(text) == F.col("_text"), "left").drop("_text")


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity of two arrays; null for a zero vector."""
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def nearest(vectors: DataFrame, query: list[float], *, key: str = "vec_id", vector: str = "embedding", k: int = 4) -> DataFrame:
    """The k most similar rows, ties by key: a top-k in each task, then of those."""
    own = F.array(*[F.lit(float(x)) for x in query])
    scored = vectors.select("*", cosine(F.col(vector), own).alias("similarity"))
    return scored.where("similarity is not null").orderBy(F.col("similarity").desc(), F.col(key)).limit(k)


#: Queries that one scan of the vectors answers, and those that are multiplied at once.
SCAN_QUERIES, BLOCK_QUERIES = 65_536, 512


def _best(scores: np.ndarray, keys: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best scores of each row and their keys, ties by key: only what reaches the k-th score is sorted."""
    n = scores.shape[1]
    limits = np.partition(scores, n - k, axis=1)[:, n - k] if n > k else np.full(len(scores), -np.inf)
    best_scores, best_keys = np.full((len(scores), k), -np.inf), np.zeros((len(scores), k), keys.dtype)
    for i, (own, limit) in enumerate(zip(scores, limits, strict=True)):
        at = np.flatnonzero(own >= limit)
        at = at[np.lexsort((keys[at], -own[at]))[:k]]
        best_scores[i, : len(at)], best_keys[i, : len(at)] = own[at], keys[at]
    return best_scores, best_keys


def nearest_to_all(vectors: DataFrame, queries: DataFrame, *, key: str = "vec_id", vector: str = "embedding", k: int = 4) -> DataFrame:
    """The k rows most similar to each row of ``queries(query_id, vector)``, exactly.

    A scan of the vectors answers up to ``SCAN_QUERIES`` queries, which are broadcast (some MB). Each task multiplies its
    rows with them, ``BLOCK_QUERIES`` at a time, and keeps k for each query to its end; those alone travel.
    """
    spark, rows = vectors.sparkSession, queries.select("query_id", F.col("vector").alias("v"))
    scans = max(1, -(-rows.count() // SCAN_QUERIES))
    out = None
    for i in range(scans):
        own = rows if scans == 1 else rows.where(F.pmod(F.xxhash64("query_id"), F.lit(scans)) == i)
        local = own.toPandas()
        matrix = np.array(local["v"].tolist(), "float64").reshape(len(local), -1)
        norms = np.linalg.norm(matrix, axis=1, keepdims=True)
        held = spark.sparkContext.broadcast((local["query_id"].to_numpy(), matrix / np.where(norms > 0, norms, 1)))

        def run(frames: Iterator[pd.DataFrame], held=held) -> Iterator[pd.DataFrame]:
            ids, unit = held.value
            scores, keys = np.full((len(ids), k), -np.inf), np.zeros((len(ids), k), np.int64)
            for pdf in frames:
                if not len(ids) or not len(pdf):
                    continue
                m = np.array(pdf["v"].tolist(), "float64").reshape(len(pdf), -1)
                length = np.linalg.norm(m, axis=1)
                keep = length > 0
                here, names = (m[keep] / length[keep, None]).T, pdf["key"].to_numpy()[keep]
                for a in range(0, len(ids) if len(names) else 0, BLOCK_QUERIES):
                    part = slice(a, a + BLOCK_QUERIES)
                    new = _best(unit[part] @ here, names, k)
                    both, of = np.hstack((scores[part], new[0])), np.hstack((keys[part], new[1]))
                    order = np.lexsort((of, -both), axis=1)[:, :k]
                    scores[part], keys[part] = np.take_along_axis(both, order, 1), np.take_along_axis(of, order, 1)
            found = np.isfinite(scores)
            yield pd.DataFrame({"query_id": np.repeat(ids, found.sum(axis=1)), "key": keys[found], "similarity": scores[found]})

        pairs = vectors.select(F.col(key).alias("key"), F.col(vector).alias("v")).mapInPandas(
            run, "query_id long, key long, similarity double"
        )
        out = pairs if out is None else out.unionByName(pairs)
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.col("similarity").desc(), "key"))
    return out.withColumn("rank", rank).where(F.col("rank") <= k)


def write_index(chunks: DataFrame, path: str, *, rebuild: bool = False) -> bool:
    """Writes ``chunks(chunk_id, text, embedding, ...)`` with ids told apart over the whole table.

    An index that is there stays as it is unless ``rebuild``; returns whether it was written.
    """
    spark = chunks.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    exists = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)
    if exists and not rebuild:
        return False
    numbered_ids(chunks, "chunk_id", "text").write.mode("overwrite").parquet(path)
    return True
