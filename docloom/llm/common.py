"""Helpers shared by the training-data operators.

Anything that must outlive one task goes to the folder in ``spark.checkpoint.dir``: driver and executors share
only that folder, the warehouse and the inputs.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, LongType, NullType

ASCII_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
# A-Z to a-z; all other ASCII but digits and letters to a space, so that split() leaves the words.
WORD_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def shared_root(spark: SparkSession) -> str:
    """The shared folder that the session names; one of its own only where none is set and all tasks run here (tests)."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="docloom-")
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext.getCheckpointDir()
    return root.rstrip("/")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, removed when the driver's Python ends."""
    path = f"{shared_root(spark)}/docloom/{name}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    return path


def _remove(spark: SparkSession, path: str) -> None:
    try:
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)
    except Exception:  # the JVM may be gone before Python ends
        return


def stored(df: DataFrame, name: str, *, row_group: int | None = None, partition_by: str | None = None) -> DataFrame:
    """``df`` written once as a table in the shared folder and read back: it cuts lineage and survives executors."""
    path, spark = shared_dir(df.sparkSession, name), df.sparkSession
    writer = df.write.option("compression", "zstd")
    if row_group:
        writer = writer.option("parquet.block.size", row_group)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def integer_id(df: DataFrame, name: str = "doc_id") -> Column:
    """The id column as a long. Ids are integers (or null): any other type is refused here, before a task runs."""
    kind = df.schema[name].dataType
    if not isinstance(kind, (IntegralType, NullType)):
        raise TypeError(f"{name} must be an integer column, not {kind.simpleString()}")
    return F.col(name).cast("long").alias(name)


def looked_up(rows: DataFrame, keyed: DataFrame, key: str, count: str, *, share: int = 1_000_000) -> DataFrame:
    """``rows`` with the columns of ``keyed(key, count, ...)``, a row for each key with the number of ``rows`` that hold it.

    Keys that hold more than a millionth of all rows (1,000 at least), so a million keys at most, are broadcast and found
    where the rows are. The others meet by a shuffle, in which no key is heavy; rows that were found spread over it.
    """
    names = [c for c in keyed.columns if c not in (key, count)]
    total = keyed.agg(F.sum(count)).first()[0] or 0
    heavy = F.col(count) > max(1000, total // share)
    hot = F.broadcast(keyed.where(heavy).select(F.col(key).alias("_hot"), F.struct(*names).alias("_of_hot")))
    rest = keyed.where(~heavy).select(F.col(key).alias("_key"), F.struct(*names).alias("_of_key"))
    first = rows.join(hot, F.col(key) == F.col("_hot"), "left")
    anywhere = F.xxhash64(*rows.columns)  # should it be a key, the row has found its own already
    if not isinstance(rows.schema[key].dataType, LongType):
        anywhere = anywhere.cast("string").cast(rows.schema[key].dataType)
    spread = F.when(F.col("_hot").isNull(), F.col(key)).otherwise(anywhere)
    both = first.withColumn("_spread", spread).join(rest, F.col("_spread") == F.col("_key"), "left")
    found = F.coalesce("_of_hot", "_of_key")
    return both.select(*rows.columns, *[found[n].alias(n) for n in names])


def id_and_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Just (doc_id long, text string), so that no other column's name can clash."""
    return df.select(integer_id(df, id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def texts(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """A string column as UTF-8 bytes; null is empty."""
    return [b"" if x is None else x for x in batch.column(name).cast(pa.binary()).to_pylist()]


class Vocab(dict):
    """Word to local number, in order of first use."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64) over unsigned integers."""
    x = x.astype(np.uint64, copy=True)
    x += np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def gram_hashes(word_hashes: np.ndarray, n: int) -> np.ndarray:
    """64-bit hashes of all n-word windows; none if there are fewer words."""
    m = len(word_hashes) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out, factor = np.zeros(m, np.uint64), np.uint64(0xD6E8FEB86659FD93)
    for j in range(n):
        out = out * factor + word_hashes[j : j + m]
    return mix(out)


def sorted_unique(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.concatenate(([True], x[1:] != x[:-1]))] if len(x) else x


def batches_of(rows: Iterator[pa.RecordBatch], most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of the batches that hold rows, of about ``most`` bytes (a row at least): what is made Python's at a time."""
    for b in rows:
        step = max(1, b.num_rows * most // max(1, b.nbytes))
        for i in range(0, b.num_rows, step):
            yield b.slice(i, step)
        del b  # before the next batch is read
