"""Delimited inputs: line lists, population, notifications, series, texts."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epipanel.functions.calendar import parse_day, week_start
from epipanel.functions.text import norm_key
from epipanel.session import reliable_checkpoint
from epipanel.sources.records import read_quoted, text_lines

# Columns of a case line list and of a notification file.
CASE_COLUMNS = ("i_class_final", "i_desc_classificacao", "i_desc_uf_res", "i_desc_radf_res", "i_data_prim_sintomas")
NOTIFICATION_COLUMNS = ("SG_UF", "SG_UF_NOT", "CLASSI_FIN", "DT_SIN_PRI")


def read_columns(spark: SparkSession, folder: str, columns: tuple[str, ...], sep: str = ";") -> DataFrame:
    """Named columns of every CSV file in a folder, tagged with the file name.

    Files may order their columns differently; one with bytes that are not UTF-8 is Latin-1. Header and
    encoding of a file are a row of a table that its lines are joined with, so no file has a plan or a driver
    row of its own however many there are.
    """
    lines = text_lines(spark, folder, "*.csv")
    raw = F.col("value").cast("string")
    names = F.split(F.regexp_replace(raw, '[\ufeff"\r]', ""), re.escape(sep))
    is_header = (F.col("block") == 0) & (F.size(F.array_intersect(names, F.array(*[F.lit(c) for c in columns]))) == len(columns))
    files = lines.groupBy("path").agg(
        F.min_by(F.when(is_header, names), F.when(is_header, F.col("at"))).alias("names"),
        F.bool_or(~F.is_valid_utf8(raw)).alias("latin"),
    )
    files = reliable_checkpoint(files)
    widest, lacking = files.agg(F.max(F.size("names")), F.min(F.when(F.col("names").isNull(), F.col("path")))).first()
    if lacking is not None:
        raise ValueError(f"{lacking} lacks columns {columns}")
    if widest is None:
        raise FileNotFoundError(f"no CSV files in {folder}")
    body = lines.where(~is_header & (F.length(F.trim(raw)) > 0)).join(files, "path")
    text = F.regexp_replace(F.when(F.col("latin"), F.decode("value", "ISO-8859-1")).otherwise(raw), "\r$", "")
    fields = F.from_csv(text, ", ".join(f"c{k} string" for k in range(widest)), {"sep": sep})
    cells = body.select("file_name", "names", fields.alias("f")).select("file_name", "names", F.array(*(F.col(f"f.c{k}") for k in range(widest))).alias("cells"))
    place = lambda c: F.get("cells", (F.array_position("names", F.lit(c)) - 1).cast("int")).alias(c)
    return cells.select(*map(place, columns), F.col("file_name").alias("source_file"))


def read_line_list(spark: SparkSession, folder: str) -> DataFrame:
    """Case records with normalised class, disease, state, region and week."""
    raw = read_columns(spark, folder, CASE_COLUMNS)
    day = parse_day("i_data_prim_sintomas")
    return raw.withColumns(
        {
            "class_norm": norm_key(F.col("i_class_final")),
            "disease_norm": norm_key(F.col("i_desc_classificacao")),
            "uf_norm": norm_key(F.col("i_desc_uf_res")),
            "ra_norm_raw": norm_key(F.col("i_desc_radf_res")),
            "date": day,
            "ano": F.year(day),
            "epi_sunday": week_start(day),
        }
    )


def read_population(spark: SparkSession, path: str) -> DataFrame:
    """(ra, ano, populacao) keyed by the normalised region name."""
    rows = spark.read.schema("RA string, ano int, populacao long").csv(path, header=True)
    return rows.select(norm_key(F.col("RA")).alias("ra"), F.col("RA").alias("ra_name"), "ano", "populacao")


def read_notifications(spark: SparkSession, path: str) -> DataFrame:
    """Large Latin-1 file; Spark splits it, only four columns are parsed."""
    raw = spark.read.options(header=True, encoding="ISO-8859-1").csv(path)
    return raw.select(*[c for c in raw.columns if c in NOTIFICATION_COLUMNS]).withColumns(
        {"code": F.expr("try_cast(CLASSI_FIN as int)"), "epi_sunday": week_start(parse_day("DT_SIN_PRI"))}
    )


def read_national_series(spark: SparkSession, path: str, before: str) -> DataFrame:
    """Weekly national series up to a cut date."""
    raw = spark.read.csv(path, header=True)
    rows = raw.select(
        parse_day("data_epi").alias("ds"), "pais", "regiao", "uf", F.expr("try_cast(casos as double)").alias("y")
    )
    return rows.filter(F.col("ds") < F.lit(before).cast("date"))


def read_labelled_text(spark: SparkSession, path: str, labels: list[str], key: str = "id", column: str = "comment_text") -> DataFrame:
    """Text rows with integer labels; quoted fields may span lines, and a large file is read by many tasks."""
    raw = read_quoted(spark, path)
    return raw.select(key, column, *[F.expr(f"try_cast({c} as int)").alias(c) for c in labels if c in raw.columns])
