"""Incremental runs: a stream of new files or rows, each content processed once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def _table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def once_per_content(
    stream: DataFrame, process: Callable[[DataFrame], DataFrame], *, content: str, output: str, done: str, checkpoint: str
) -> StreamingQuery:
    """Runs ``process`` over what a micro-batch brings that no earlier one had; appends its result to ``output``.

    ``done`` holds the hashes of finished contents. The batch's number is a partition of both tables, and a batch that is
    run again after a failure replaces its own partition, so results stay whole and single. Available rows are taken,
    then the query ends.
    """

    def batch(rows: DataFrame, number: int) -> None:
        spark = rows.sparkSession
        seen = _table(spark, done, "sha256 string, batch long").where(F.col("batch") < number)
        own = rows.withColumn("sha256", F.sha2(F.col(content), 256)).dropDuplicates(["sha256"])
        new = own.join(seen.select("sha256"), "sha256", "left_anti").persist()
        process(new).write.mode("overwrite").parquet(f"{output}/batch={number}")
        new.select("sha256").write.mode("overwrite").parquet(f"{done}/batch={number}")
        new.unpersist()

    return (
        stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
