"""Best-fit packing by exact complements, planned on the histogram of lengths.

Pieces are at most ``capacity`` tokens long, so their lengths have at most ``capacity`` distinct values:
the plan needs that histogram only, however many documents there are. For the longest length left, single,
pair and triple sums of available lengths are indexed and the combination that fills the gap exactly is
taken as often as its counts allow; where none exists the largest length that fits is added and the rest
of the gap is tried again. Each step uses up at least one length, so a plan has few steps.

Pieces find their places by their rank within their length. Ranks are counted in hash slots, so a length
that a third of all pieces have is spread over many tasks.

Cases: null text is empty and packs as one end mark; equal rows are packed each; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from epipanel.llm.common import partitions, stored, texts
from epipanel.llm.wordcodec import codec

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """Every document's ids and one end mark, cut only where longer than ``capacity``."""
    mark = np.array([end_id], "<u4").tobytes()

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(tokenizer_path)
        for part in parts:
            for start in range(0, part.num_rows, 512):
                cut = part.slice(start, 512)
                rows: list[tuple] = []
                for doc, ids in zip(cut.column("doc_id").to_pylist(), coder.encode_many(cut.column("text").to_pylist()), strict=True):
                    ids += mark
                    for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                        own = ids[at : at + 4 * capacity]
                        rows.append((doc, k, at // 4, len(own) // 4, zlib.crc32(own)))
                columns = list(zip(*rows, strict=True))
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return texts(docs).mapInArrow(run, PIECES)


@dataclass(frozen=True)
class Step:
    """``bins`` sequences alike: (length, how many of it) in order."""

    bins: int
    items: tuple[tuple[int, int], ...]


class Complements:
    """Sums of one, two and three available lengths."""

    def __init__(self, counts: np.ndarray):
        self.left = counts.astype(np.int64)
        self.size = 1 << int(2 * len(counts)).bit_length()

    def single(self, gap: int, used: dict[int, int]) -> list[int] | None:
        return [gap] if 0 < gap < len(self.left) and self.left[gap] > used.get(gap, 0) else None

    def free(self, used: dict[int, int]) -> np.ndarray:
        left = self.left.copy()
        for length, n in used.items():
            left[length] -= n
        return left

    def pair(self, gap: int, left: np.ndarray) -> list[int] | None:
        low = np.arange(1, gap // 2 + 1)
        fits = (left[low] > 0) & (left[gap - low] > 0)
        if gap % 2 == 0 and gap:
            fits[-1] = left[gap // 2] > 1
        found = np.flatnonzero(fits)
        return [gap - int(low[found[0]]), int(low[found[0]])] if len(found) else None

    def triple(self, gap: int, left: np.ndarray) -> list[int] | None:
        there = np.fft.rfft((left > 0).astype(float), self.size)
        pair_sums = np.fft.irfft(there * there, self.size)[: gap + 1] > 0.5
        first = np.arange(gap - 2, 0, -1)
        for a in first[(left[first] > 0) & pair_sums[gap - first]].tolist():
            left[a] -= 1
            rest = self.pair(gap - a, left)
            left[a] += 1
            if rest:
                return [a, *rest]
        return None

    def exact(self, gap: int, used: dict[int, int]) -> list[int] | None:
        if gap <= 0:
            return None
        if one := self.single(gap, used):
            return one
        left = self.free(used)
        return self.pair(gap, left) or self.triple(gap, left)

    def largest(self, gap: int, used: dict[int, int]) -> int:
        fits = np.flatnonzero(self.free(used)[1 : gap + 1] > 0)
        return int(fits[-1]) + 1 if len(fits) else 0


def plan(counts: np.ndarray, capacity: int) -> list[Step]:
    """Steps that place every piece; ``counts[n]`` pieces have length n."""
    sums = Complements(counts)
    steps: list[Step] = []
    for longest in range(capacity, 0, -1):
        while sums.left[longest] > 0:
            used = {longest: 1}
            gap = capacity - longest
            while gap > 0:
                more = sums.exact(gap, used)
                if more is None:
                    best = sums.largest(gap, used)
                    more = [best] if best else []
                for length in more:
                    used[length] = used.get(length, 0) + 1
                gap -= sum(more)
                if not more:
                    break
            bins = min(int(sums.left[length]) // n for length, n in used.items())
            for length, n in used.items():
                sums.left[length] -= bins * n
            steps.append(Step(bins, tuple(sorted(used.items(), reverse=True))))
    return steps


def places(steps: list[Step]) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length, by first rank: pieces a sequence, first sequence and offset."""
    taken: dict[int, int] = {}
    found: dict[int, list[tuple[int, int, int, int]]] = {}
    sequence = 0
    for step in steps:
        offset = 0
        for length, n in step.items:
            first = taken.get(length, 0)
            found.setdefault(length, []).append((first, n, sequence, offset))
            taken[length] = first + n * step.bins
            offset += n * length
        sequence += step.bins
    return {length: tuple(np.array(c, np.int64) for c in zip(*rows, strict=True)) for length, rows in found.items()}


def pack(cut: DataFrame, capacity: int = 4096) -> DataFrame:
    """``cut`` (the columns of ``pieces``) with sequence_id and offset."""
    spark = cut.sparkSession
    cut = stored(cut)
    counts = np.zeros(capacity + 1, np.int64)
    for row in cut.groupBy("length").count().collect():  # at most ``capacity`` rows
        counts[row["length"]] = row["count"]
    table = spark.sparkContext.broadcast(places(plan(counts, capacity)))
    slots = 4 * partitions(spark)
    slotted = cut.withColumn("slot", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(slots)))
    earlier = Window.partitionBy("length").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        slotted.groupBy("length", "slot").count()
        .withColumn("before", F.coalesce(F.sum("count").over(earlier), F.lit(0)))
        .select("length", "slot", "before")
    )
    inside = Window.partitionBy("length", "slot").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (
        slotted.withColumn("in_slot", F.row_number().over(inside) - 1)
        .join(before, ["length", "slot"])
        .withColumn("rank", F.col("before") + F.col("in_slot"))
        .select("doc_id", "piece", "start", "length", "ids_crc32", "rank")
    )

    def place(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            length, rank = (part.column(c).to_numpy() for c in ("length", "rank"))
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            order = np.argsort(length, kind="stable")
            for rows in np.split(order, np.flatnonzero(np.diff(length[order])) + 1) if len(order) else []:
                first, n, start, at = table.value[int(length[rows[0]])]
                k = np.searchsorted(first, rank[rows], side="right") - 1
                turn = rank[rows] - first[k]
                sequence[rows] = start[k] + turn // n[k]
                offset[rows] = at[k] + turn % n[k] * length[rows]
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")), pa.array(sequence), pa.array(offset)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return ranked.mapInArrow(place, f"{PIECES}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    return pack(pieces(docs, tokenizer_path, capacity, end_id), capacity)
