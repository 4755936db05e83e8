"""Run a streaming plan over all available input into a Parquet table."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epipanel.operators.series import best_row
from epipanel.session import temporary


@contextmanager
def stream_conf(spark: SparkSession, **settings: str):
    """Session settings for the length of one run, restored afterwards."""
    names = {k.replace("__", "."): v for k, v in settings.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def folders(spark: SparkSession) -> tuple[str, str]:
    root = temporary(spark, "stream")
    return f"{root}/table", f"{root}/progress"


def append_to_table(stream: DataFrame, out: str | None = None, progress: str | None = None) -> DataFrame:
    """Append mode: rows are written once their windows are final."""
    spark = stream.sparkSession
    table, state = folders(spark)
    table, state = out or table, progress or state
    query = (
        stream.writeStream.outputMode("append").format("parquet")
        .option("path", table).option("checkpointLocation", state).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(table)


def complete_table(stream: DataFrame, out: str | None = None, progress: str | None = None) -> DataFrame:
    """Complete mode: each batch replaces the whole (aggregate-sized) table."""
    spark = stream.sparkSession
    table, state = folders(spark)
    table, state = out or table, progress or state

    def replace(batch: DataFrame, _epoch: int) -> None:
        batch.write.mode("overwrite").parquet(table)

    query = (
        stream.writeStream.outputMode("complete").foreachBatch(replace)
        .option("checkpointLocation", state).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(table)


def upsert_table(stream: DataFrame, keys: list[str], out: str | None = None, progress: str | None = None) -> DataFrame:
    """Update mode: changed rows per epoch, newest epoch per key on read.

    An epoch that is replayed after a failure overwrites its own folder.
    """
    spark = stream.sparkSession
    table, state = folders(spark)
    table, state = out or table, progress or state

    def keep(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table}/epoch={epoch}")

    query = (
        stream.writeStream.outputMode("update").foreachBatch(keep)
        .option("checkpointLocation", state).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    versions = spark.read.option("basePath", table).parquet(table)
    return best_row(versions, keys, -F.col("epoch")).drop("epoch")
