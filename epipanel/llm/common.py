"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from epipanel.session import shared_dir

ASCII_SPACE = " \t\n\r\x0b\x0c"


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back: a cut of its lineage."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def texts(docs: DataFrame, *keep: str) -> DataFrame:
    """doc_id and text only (null text: empty), so further or clashing columns never meet the operator's own."""
    return docs.select(F.col("doc_id"), *keep, F.coalesce(F.col("text"), F.lit("")).alias("text"))


def sha256_hex(data: bytes) -> str:
    import hashlib

    return hashlib.sha256(data).hexdigest()


def hash_sample(df: DataFrame, size: int, *key: str) -> DataFrame:
    """All rows, or where there are more than ``size`` about that many: those of the smallest hashes of ``key``.

    A threshold on the hash, set from the number of rows, keeps the sample the same however the rows are
    dealt out, and lets no task send more than its share.
    """
    n = df.count()
    if n <= size:
        return df
    return df.where(F.xxhash64(*key) <= min(int(2**64 * (size / n)) - 2**63, 2**63 - 1))


def bucket_of(column: str, modulus: int) -> Column:
    """crc32 of the column as text, modulo ``modulus``."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def batches(fn: Callable[[dict[str, list]], dict[str, list]], schema: pa.Schema, columns: tuple[str, ...], rows: int = 512):
    """Arrow map function: ``fn`` gets lists of at most ``rows`` values a column, so Python objects stay few."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for start in range(0, part.num_rows, rows):
                cut = part.slice(start, rows)
                out = fn({c: cut.column(c).to_pylist() for c in columns})
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in schema], schema=schema)

    return run


def with_texts(docs: DataFrame, rewrite: Callable[[], Callable[[list[str]], list[str]]]) -> DataFrame:
    """All columns of ``docs`` with every text rewritten and n_chars, where there is one, counted anew; null stays null.

    ``rewrite`` makes the function in each task, so what it holds is built once there.
    """
    names = docs.columns
    at, chars = names.index("text"), names.index("n_chars") if "n_chars" in names else -1

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        change = rewrite()
        for part in parts:
            for start in range(0, part.num_rows, 512):
                cut = part.slice(start, 512)
                old = cut.column(at).to_pylist()
                new = iter(change([t for t in old if t is not None]))
                out = [None if t is None else next(new) for t in old]
                columns = list(cut.columns)
                columns[at] = pa.array(out, pa.string())
                if chars >= 0:
                    columns[chars] = pa.array([None if t is None else len(t) for t in out], columns[chars].type)
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(run, docs.schema)
