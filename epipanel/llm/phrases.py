"""Document fingerprints by locally consistent parsing.

A text is parsed into phrases again and again. On each level, runs of one symbol become one; then
deterministic coin tossing gives every symbol a label below six that depends on a few symbols in front
of it only, never equal to its neighbour's; phrases start at local maxima of the labels and are named by
a hash of what they hold. So equal substrings get equal phrases inside, wherever they stand. The
fingerprint keeps, for each of the levels ``LEVELS`` (phrases of about 2, 6, 15 and 38 code points), the
``KEEP`` smallest phrase names (a name met again counts as a further one); likeness is the mean over levels of the Jaccard estimate from them.

``with_next`` pairs every document with the next one by descending doc_id. Texts are dealt out once by
ranges of doc_id; each range also gets the first document of the range that follows it, so no window
over all rows is needed.

Cases: null text is empty; two texts without phrases are alike (1), one with and one without are not
(0); equal texts have equal fingerprints; equal doc_ids are ordered by their texts; null doc_ids come
last; a single document is its own next; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from epipanel.llm.common import partitions, sha256_hex, texts

LEVELS = (1, 2, 3, 4)
KEEP = 16
PRIME = 0x9E3779B97F4A7C15
BATCH_CHARS = 200_000
U = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    """A fixed scrambling of 64-bit numbers."""
    x = x ^ (x >> U(33))
    x = x * U(0xFF51AFD7ED558CCD)
    x ^= x >> U(29)
    x = x * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(32))


POWERS = np.array([pow(PRIME, k + 1, 1 << 64) for k in range(64)], U)


def lowest_difference(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """2 x the lowest bit in which a and b differ, plus a's bit there."""
    d = np.maximum(a ^ b, a.dtype.type(1))
    d &= ~d + a.dtype.type(1)
    out = np.bitwise_count(d - a.dtype.type(1))
    out += out
    out += (a & d) != 0
    return out


_SMALL = np.arange(128, dtype=np.uint64)
#: lowest_difference of all pairs of labels below 128, at 128 x the label + the one in front of it.
TOSS = lowest_difference(np.repeat(_SMALL, 128), np.tile(_SMALL, 128))
#: Scrambled code points.
CODES = mixed(np.arange(0x10000, dtype=np.uint64))


def level(x: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the phrases of all documents, and where each document's begin.

    x holds code points (32 bits) or the names of the level below (64 bits); ``starts`` the first place
    of every document in it (documents are not empty here).
    """
    fresh = np.empty(len(x), bool)
    fresh[0] = True
    np.not_equal(x[1:], x[:-1], out=fresh[1:])
    fresh[starts] = True
    at = np.flatnonzero(fresh)
    y = x[at]
    many = np.flatnonzero(np.diff(at, append=len(x)) > 1)
    if len(many):  # a run is one symbol, named by what it repeats and how often
        runs = np.diff(at, append=len(x))[many].astype(U)
        y[many] = (mixed(y[many].astype(U) + mixed(runs)) | U(1 << 31)).astype(y.dtype)
        starts = np.searchsorted(at, starts)
    before = np.empty_like(y)
    before[1:] = y[:-1]
    before[starts] = y[starts] ^ y.dtype.type(1)
    label = lowest_difference(y, before)
    for _ in range(3):
        left = np.empty_like(label)
        left[1:] = label[:-1]
        left[starts] = label[starts] ^ 1
        label = TOSS.take((label.astype(np.uint16) << 7) | left)
    peak = np.empty(len(y), bool)
    peak[1:-1] = (label[1:-1] > label[:-2]) & (label[1:-1] >= label[2:])
    peak[-1] = False
    peak[starts[1:] - 1] = False  # a document's last symbol sees no neighbour behind it
    peak[starts] = True
    block = np.flatnonzero(peak)
    size = np.diff(block, append=len(y))
    inside = np.arange(len(y), dtype=np.int32) - np.repeat(block.astype(np.int32), size)
    hashed = CODES.take(y) if y.dtype == np.uint32 and y.max() < len(CODES) else mixed(y.astype(U))
    hashed *= POWERS.take(inside & 63)
    return mixed(np.add.reduceat(hashed, block)), np.searchsorted(block, starts)


def sketches(documents: list[str]) -> list[tuple[np.ndarray, ...]]:
    """For every text and level, its smallest phrase names (as 32-bit numbers, ascending)."""
    empty = tuple(np.zeros(0, np.uint32) for _ in LEVELS)
    out: list[tuple[np.ndarray, ...]] = [empty] * len(documents)
    full = [k for k, t in enumerate(documents) if t]
    if not full:
        return out
    raw = [documents[k].encode("utf-32-le", "surrogatepass") for k in full]
    sizes = np.array([len(r) // 4 for r in raw])
    x = np.frombuffer(b"".join(raw), np.uint32)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    found = []
    for depth in range(1, max(LEVELS) + 1):
        x, starts = level(x, starts)
        if depth in LEVELS:
            names = (x * U(PRIME) >> U(32)).astype(np.uint32)
            owner = np.repeat(np.arange(len(full)), np.diff(starts, append=len(x)))
            key = np.sort((owner.astype(U) << U(32)) | names.astype(U))
            first = np.empty(len(key), bool)
            first[0] = True
            np.not_equal(key[1:], key[:-1], out=first[1:])
            turn = np.arange(len(key)) - np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))
            again = np.flatnonzero(turn)  # the second, third ... phrase of one name counts as a name of its own
            lower = key[again] + (turn[again].astype(U) * U(PRIME) >> U(32))
            key[again] = (key[again] & ~U(0xFFFFFFFF)) | (lower & U(0xFFFFFFFF))
            key = np.unique(key)
            first = np.searchsorted(key >> U(32), np.arange(len(full), dtype=U))
            values = (key & U(0xFFFFFFFF)).astype(np.uint32)
            found.append([values[a : min(a + KEEP, b)] for a, b in zip(first.tolist(), [*first.tolist()[1:], len(values)], strict=True)])
    for n, k in enumerate(full):
        out[k] = tuple(by_level[n] for by_level in found)
    return out


def written(sketch: tuple[np.ndarray, ...]) -> str:
    return "-".join(part.astype(">u4").tobytes().hex() for part in sketch)


def likeness(a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...]) -> float:
    total, levels = 0.0, 0
    for x, y in zip(a, b, strict=True):
        if not len(x) and not len(y):
            continue
        both = set(x.tolist()) | set(y.tolist())
        least = sorted(both)[:KEEP]
        shared = set(x.tolist()) & set(y.tolist())
        total += sum(v in shared for v in least) / len(least)
        levels += 1
    return total / levels if levels else 1.0


def by_size(documents: list[str]) -> list[tuple[np.ndarray, ...]]:
    """Sketches, worked out for about ``BATCH_CHARS`` code points at a time."""
    out: list[tuple[np.ndarray, ...]] = []
    part: list[str] = []
    size = 0
    for text in documents:
        part.append(text)
        size += len(text)
        if size >= BATCH_CHARS:
            out += sketches(part)
            part, size = [], 0
    return out + sketches(part)


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint of every document."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            own = by_size(part.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(list(map(written, own)), pa.string())], names=["doc_id", "fingerprint"])

    return texts(docs).mapInArrow(run, "doc_id long, fingerprint string")


def dealt(docs: DataFrame) -> DataFrame:
    """range, last, doc_id, text: every range of doc_ids followed by a ``last`` row, the next range's first document."""
    spark = docs.sparkSession
    n = partitions(spark)
    rows = texts(docs)
    cuts = np.array(sorted(set(rows.where(F.col("doc_id").isNotNull()).stat.approxQuantile("doc_id", [k / n for k in range(1, n)], 0.2 / n)))) if n > 1 else np.zeros(0)

    @F.pandas_udf("int")
    def range_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.where(ids.isna(), 0, 1 + np.searchsorted(cuts, ids.to_numpy(float, na_value=np.nan), side="left"))).astype("int32")

    rows = rows.withColumn("range", range_of("doc_id")).select("range", F.lit(0).alias("last"), "doc_id", "text")
    # one row a range: at most as many as there are partitions
    tops = rows.groupBy("range").agg(F.max("doc_id").alias("top_id")).withColumnRenamed("range", "top_range")
    heads = (
        rows.join(F.broadcast(tops), (F.col("range") == F.col("top_range")) & F.col("doc_id").eqNullSafe(F.col("top_id")))
        .groupBy("range").agg(F.max(F.struct(F.xxhash64("text").alias("h"), "text", "doc_id")).alias("head"))
    )
    above = Window.orderBy("range")
    follow = heads.select(
        F.coalesce(F.lead("range").over(above), F.first("range").over(above.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("range"),
        F.lit(1).alias("last"), F.col("head.doc_id").alias("doc_id"), F.col("head.text").alias("text"),
    )
    # keys that hash to different partitions, so that each partition gets one range
    ids = spark.range(40 * n).select(F.col("id").cast("int").alias("key"))
    keys = ids.groupBy(F.pmod(F.hash("key"), F.lit(n))).agg(F.min("key").alias("key")).orderBy("key")
    spread = [r["key"] for r in keys.collect()]
    slot = F.element_at(F.lit(spread), F.col("range") % len(spread) + 1)
    return rows.unionByName(follow).withColumn("slot", slot).repartition(n, "slot").drop("slot").sortWithinPartitions(
        "range", "last", F.desc_nulls_last("doc_id"), F.desc(F.xxhash64("text")), F.desc("text")
    )


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by the beginning of the next."""
    cut = len(text) // 3
    return text[: len(text) - cut] + following[:cut]


OUT = pa.schema(
    [
        ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
    ]
)


def with_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness to each other and the next one's."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # a document whose next one has not come yet
        for part in parts:
            for start in range(0, part.num_rows, 512):
                cut = part.slice(start, 512)
                rows = list(zip(cut.column("last").to_pylist(), cut.column("doc_id").to_pylist(), cut.column("text").to_pylist(), strict=True))
                own = by_size([r[2] for r in rows])
                rows = ([held[0]] if held else []) + rows
                own = ([held[1]] if held else []) + own
                pairs = [k for k in range(len(rows) - 1) if not rows[k][0]]
                changed = [edited(rows[k][2], rows[k + 1][2]) for k in pairs]
                other = by_size(changed)
                out = [
                    (
                        rows[k][1], len(rows[k][2]), sha256_hex(text.encode("utf-8", "surrogatepass")), written(own[k]), written(print_),
                        likeness(own[k], print_), likeness(own[k], own[k + 1]),
                    )
                    for k, text, print_ in zip(pairs, changed, other, strict=True)
                ]
                held = (rows[-1], own[-1])
                columns = list(zip(*out, strict=True)) or [()] * len(OUT)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, OUT, strict=True)], schema=OUT)

    return dealt(docs).mapInArrow(
        run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    )
