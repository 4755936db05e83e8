"""Result sinks: run-versioned tables, JSON documents and models."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def new_run_id() -> str:
    return datetime.now(timezone.utc).strftime("%Y%m%d_%H%M")


def write_panel(panel: DataFrame, path: str) -> None:
    """Panel partitioned by year; a year's rows are written by a few tasks, as many as partitions allow."""
    slots = max(1, int(panel.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 16)
    spread = F.pmod(F.xxhash64(*[c for c in panel.columns if c != "ano"]), F.lit(slots))
    panel.repartition("ano", spread).write.mode("overwrite").partitionBy("ano").parquet(path)


def write_result(df: DataFrame, root: str, name: str, run_id: str) -> None:
    """One table per result; a re-run of the same run id replaces its partition."""
    (
        df.withColumn("run_id", F.lit(run_id)).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(f"{root}/{name}")
    )


def read_result(spark: SparkSession, root: str, name: str, run_id: str | None = None) -> DataFrame:
    """Rows of a run; without an id, of the latest run."""
    found = spark.read.parquet(f"{root}/{name}")
    # Partition values look like numbers; the declared type keeps them text.
    as_text = [F.col(c) for c in found.columns if c != "run_id"]
    runs = found.select(*as_text, F.col("run_id").cast("string").alias("run_id"))
    wanted = run_id or runs.agg(F.max("run_id")).first()[0]
    return runs.filter(F.col("run_id") == wanted)


def write_json(df: DataFrame, path: str) -> None:
    """Small documents (winner, per-horizon metrics) as one JSON-lines file."""
    df.coalesce(1).write.mode("overwrite").json(path)


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def save_model(model: PipelineModel, path: str, **metadata) -> None:
    """Fitted pipeline plus a metadata row (config, features, params, metrics)."""
    model.write().overwrite().save(f"{path}/model")
    spark = SparkSession.getActiveSession()
    rows = [(k, json.dumps(v, sort_keys=True)) for k, v in metadata.items()]
    write_json(spark.createDataFrame(rows, "name string, value string"), f"{path}/metadata")


def load_model(spark: SparkSession, path: str) -> tuple[PipelineModel, dict]:
    meta = read_json(spark, f"{path}/metadata", "name string, value string").collect()
    return PipelineModel.load(f"{path}/model"), {r.name: json.loads(r.value) for r in meta}


def write_submission(scores: DataFrame, path: str) -> None:
    scores.write.mode("overwrite").csv(path, header=True)
