"""Quoted records of large delimited files, read in splits although records may span lines.

Lines come from the splittable text source with their file and the block that holds them. A record starts
where the number of quotes before it is even: quotes are counted a block, summed up along each file's blocks
(one row a block), and each task puts its lines together to records from its block's parity. What crosses
blocks - the end of one, the start of the next, whole blocks inside one field - is a few pieces a block,
joined in order. A quote may only stand around a field or, doubled, inside a quoted one.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

PIECES = "path string, block long, at long, kind string, record binary"


def text_lines(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, file_name, block, at, value): lines as bytes; ``at`` grows inside a block."""
    raw = spark.read.options(lineSep="\n", pathGlobFilter=pattern).text(path)
    return raw.select(
        F.col("_metadata.file_path").alias("path"), F.url_decode(F.replace("_metadata.file_name", F.lit("+"), F.lit("%2B"))).alias("file_name"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), F.col("value").cast("binary").alias("value"),
    )


def block_parity(lines: DataFrame) -> DataFrame:
    """(path, block, open): whether a block starts inside quotes."""
    text = F.col("value").cast("string")
    quotes = F.octet_length(text) - F.octet_length(F.replace(text, F.lit('"'), F.lit("")))
    blocks = lines.groupBy("path", "block").agg((F.sum(quotes) % 2).alias("odd"))
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return blocks.select("path", "block", (F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2 == 1).alias("open"))


def pieces_of(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole records, and the pieces at the edges of blocks: what ends an open record, what starts one.

    The first record of a file is its header, which spans no lines.
    """
    place, kind, held, first, inside = None, "whole", [], None, False
    out: list[tuple] = []

    def closed(how: str) -> None:
        if held:
            out.append((*place, first, how, b"\n".join(held)))
        held.clear()

    for part in parts:
        for path, block, at, value, open_ in zip(*(part.column(c).to_pylist() for c in ("path", "block", "at", "value", "open")), strict=True):
            if (path, block) != place:
                closed("head" if kind == "head" else "tail")
                place, inside = (path, block), open_
                kind = "head" if open_ else "header" if block == 0 else "whole"
            first = first if held else at
            held.append(value)
            inside ^= value.count(b'"') % 2 == 1
            if not inside:
                closed(kind)
                kind = "whole"
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()), strict=True)], names=["path", "block", "at", "kind", "record"])
            out.clear()
    closed("head" if kind == "head" else "tail")
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()), strict=True)], names=["path", "block", "at", "kind", "record"])


def quoted_records(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, block, at, record): every record behind the headers as bytes, in order of block and ``at`` within its file."""
    lines = text_lines(spark, path, pattern)
    placed = lines.join(block_parity(lines), ["path", "block"]).sortWithinPartitions("path", "block", "at")
    pieces = placed.mapInArrow(pieces_of, PIECES)
    along = Window.partitionBy("path").orderBy("block", "at").rowsBetween(Window.unboundedPreceding, 0)
    edges = pieces.where("kind in ('head', 'tail')").withColumn("group", F.sum((F.col("kind") == "tail").cast("int")).over(along))
    ordered = F.sort_array(F.collect_list(F.struct("block", "at", "record")))
    joined = edges.groupBy("path", "group").agg(ordered.alias("p")).select("path", F.get("p", 0)["block"].alias("block"), F.get("p", 0)["at"].alias("at"), "p")
    text = F.aggregate("p", F.lit(None).cast("binary"), lambda a, p: F.when(a.isNull(), p["record"]).otherwise(F.concat(a, F.lit(b"\n"), p["record"])))
    return pieces.where("kind = 'whole'").select("path", "block", "at", "record").unionByName(joined.select("path", "block", "at", text.alias("record")))


def decoded(record: Column, encoding: str) -> Column:
    """Text of a record without its carriage return."""
    return F.regexp_replace(F.decode(record, encoding), "\r$", "")


def read_quoted(spark: SparkSession, path: str, sep: str = ",", encoding: str = "UTF-8", pattern: str = "*") -> DataFrame:
    """All columns of headed, quoted CSV files as text; files of one folder share a header."""
    rows = quoted_records(spark, path, pattern)
    # the first line of the first file: one row
    header = spark.read.options(lineSep="\n", pathGlobFilter=pattern).text(path).where("_metadata.file_block_start = 0").limit(1)
    text = header.select(decoded(F.col("value").cast("binary"), encoding)).first()
    if text is None:
        raise ValueError(f"no records in {path}")
    names = spark.range(1).select(F.from_csv(F.lit(text[0].lstrip("﻿")), ", ".join(f"c{k} string" for k in range(text[0].count(sep) + 1)), {"sep": sep, "quote": '"', "escape": '"'}).alias("r")).first()["r"]
    names = [n for n in names if n is not None]
    schema = ", ".join(f"`{n}` string" for n in names)
    value = decoded(F.col("record"), encoding)
    options = {"sep": sep, "quote": '"', "escape": '"'}
    parsed = rows.where(F.length(F.trim(value)) > 0).select(F.from_csv(value, schema, options).alias("r"))
    return parsed.select("r.*")
