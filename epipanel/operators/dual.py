"""Ridge-penalised logistic models of more terms than one machine holds.

All steps from zero lie in the span of the training rows, so a model is kept as one number for each row, ``a``: its term
weights are X'a, its margins XX'a. The matrix X lies in the shared folder in parts by term; a pass over it turns such numbers
into margins, each task summing its parts, and everything else is arithmetic on vectors as long as the rows. Nothing as long
as the terms comes to the driver. A sketch of XX', made in a few passes ahead, saves most of those of the fit.
"""

from __future__ import annotations

from collections.abc import Callable, Generator, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epipanel.operators.ngrams import blocks, released
from epipanel.session import scratch, shuffles_removed, temporary

#: Entries of the matrix in a part of it, and in the rows that are dealt to the parts at once.
PART_ENTRIES, DEALT_ENTRIES = 200_000, 1_000_000
#: Parts of the matrix in a file: so few that no split of a file is without them.
FILE_PARTS = 4
#: Rows whose sums are added at once.
PIECE_ROWS = 1 << 14
#: What is known of XX' ahead of the fit: columns, bytes of them at most, and how many are asked for in a pass.
SKETCH_COLUMNS, SKETCH_BYTES, SKETCH_ASKED = 32, 64_000_000, 16
ENTRIES = ("row", "term", "value")


@dataclass(frozen=True)
class Matrix:
    """Rows dealt out by term: the folder's ``cells`` are their entries by ``block`` of terms, ``rows`` their other columns.

    A row is known by its ``chunk`` and its place ``pos`` in it; ``square`` is its length squared.
    """

    cells: DataFrame
    rows: DataFrame


def _dealt(n_blocks: int, others: list[str]) -> Callable:
    """Rows -> for each chunk of them a row with the entries of each block of terms, and their other columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            lengths = np.diff(batch.column("indices").offsets.to_numpy())
            cuts = np.flatnonzero(np.diff(np.cumsum(lengths, dtype=np.int64) // DEALT_ENTRIES, prepend=-1))
            for start, stop in zip(cuts, np.r_[cuts[1:], len(lengths)], strict=True):
                part = batch.slice(start, stop - start)
                term, value = (part.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("indices", "values"))
                row = np.repeat(np.arange(len(part), dtype=np.int32), lengths[start:stop])
                block = term % n_blocks
                order = np.argsort(block, kind="stable")
                at = np.flatnonzero(np.diff(block[order], prepend=-1))
                ends = np.r_[at[1:], len(order)]
                packed = [[x[order[i:j]].tobytes() for i, j in zip(at, ends, strict=True)] for x in (row, (term // n_blocks).astype(np.int32), value)]
                n = len(at)
                yield pa.record_batch(
                    [pa.array(["cells"] * n), pa.array(block[order[at]].astype(np.int32)), pa.array(np.full(n, chunk)), pa.nulls(n, pa.int32()), pa.nulls(n, pa.float64()),
                     *(pa.array(x, pa.binary()) for x in packed), *(pa.nulls(n, part.schema.field(c).type) for c in others)],
                    ["kind", "block", "chunk", "pos", "square", *ENTRIES, *others],
                )
                n, square = len(part), np.bincount(row, value * value, len(part))
                yield pa.record_batch(
                    [pa.array(["rows"] * n), pa.array(np.full(n, chunk % n_blocks, np.int32)), pa.array(np.full(n, chunk)), pa.array(np.arange(n, dtype=np.int32)), pa.array(square),
                     *(pa.nulls(n, pa.binary()) for _ in ENTRIES), *(part.column(c) for c in others)],
                    ["kind", "block", "chunk", "pos", "square", *ENTRIES, *others],
                )
                chunk += 1
        released()

    return run


def _joined(others: list[str]) -> Callable:
    """Dealt rows in order of block -> one row with all entries of a block, and what is no entry as it is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, rows in blocks(batches):
            cells = rows.filter(pc.equal(rows["kind"], "cells"))
            plain = rows.filter(pc.equal(rows["kind"], "rows"))
            none = pa.nulls(plain.num_rows, pa.list_(pa.int64()))
            plain = plain.append_column("chunks", none).append_column("sizes", none).select(["kind", "block", "chunks", "sizes", "chunk", "pos", "square", *ENTRIES, *others])
            yield from plain.combine_chunks().to_batches()
            if not cells.num_rows:
                continue
            packed = [cells[c].to_pylist() for c in ENTRIES]
            yield pa.record_batch(
                [pa.array(["cells"]), pa.array([block], pa.int32()), pa.array([cells["chunk"].to_pylist()], pa.list_(pa.int64())),
                 pa.array([[len(x) // 4 for x in packed[0]]], pa.list_(pa.int64())), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.float64()),
                 *(pa.array([b"".join(x)], pa.binary()) for x in packed), *(pa.nulls(1, cells.schema.field(c).type) for c in others)],
                plain.schema.names,
            )
        released()

    return run


def _tasks(df: DataFrame) -> int:
    return df.sparkSession.sparkContext.defaultParallelism


def n_blocks_of(entries: int, tasks: int) -> int:
    return max(2 * tasks, 1 + entries // PART_ENTRIES)


def by_block(df: DataFrame, n_blocks: int) -> DataFrame:
    """Rows in order of block; the blocks are spread evenly over the partitions."""
    files = max(_tasks(df), 1 + n_blocks // FILE_PARTS)
    return df.repartitionById(files, F.col("block") % files).sortWithinPartitions("block", "kind", "chunk")


def matrix(df: DataFrame, n_blocks: int, others: list[str], joined: bool, folder: str) -> Matrix:
    """``features`` of all rows by block of terms and the columns ``others``; ``joined``: one row for each block."""
    vector = F.unwrap_udt("features")
    indices = F.coalesce(vector["indices"], F.transform(vector["values"], lambda _, i: i))
    names = [f"_c{i}" for i in range(len(others))]
    rows = df.select(indices.alias("indices"), vector["values"].alias("values"), *(F.col(c).alias(n) for c, n in zip(others, names, strict=True)))
    kinds = ", ".join(f"{n} {df.schema[c].dataType.simpleString()}" for c, n in zip(others, names, strict=True))
    entries = f"chunk long, pos int, square double, row binary, term binary, value binary, {kinds}"
    dealt = rows.mapInArrow(_dealt(n_blocks, names), f"kind string, block int, {entries}")
    if joined:
        dealt = by_block(dealt, n_blocks).mapInArrow(_joined(names), f"kind string, block int, chunks array<long>, sizes array<long>, {entries}")
    dealt.write.partitionBy("kind").parquet(folder)
    read = df.sparkSession.read.schema(dealt.schema).parquet(folder)
    kept = ["block", *(["chunks", "sizes"] if joined else ["chunk"]), *ENTRIES]
    own = [F.col(n).alias(c) for c, n in zip(others, names, strict=True)]
    return Matrix(read.filter("kind = 'cells'").select(*kept), read.filter("kind = 'rows'").select("chunk", "pos", "square", *own))


def _entries(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.frombuffer(row["row"], np.int32), np.frombuffer(row["term"], np.int32), np.frombuffer(row["value"])


def _each(batch: pa.RecordBatch) -> Iterator[dict]:
    """The rows one by one, so that the bytes of one are held at a time."""
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


class Rows:
    """Numbers of the training rows: those of a chunk lie side by side."""

    def __init__(self, chunks: np.ndarray):
        self.chunks, self.starts = np.unique(chunks, return_index=True)
        self.n = len(chunks)

    def of(self, row: dict, at: np.ndarray) -> np.ndarray:
        return at + np.repeat(self.starts[np.searchsorted(self.chunks, row["chunks"])], row["sizes"])


def _term_sums(row: dict, numbers: Rows, vectors: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """(row, term, value, X'v of each v) of one block."""
    at, term, value = _entries(row)
    at = numbers.of(row, at)
    return at, term, value, [np.bincount(term, value * v[at]) for v in vectors]


def product(cells: DataFrame, numbers: Rows, vectors: list[np.ndarray]) -> list[np.ndarray]:
    """XX'v of each v: a task sums the parts of the matrix that it reads, then the tasks' sums are added piece by piece."""
    context = cells.sparkSession.sparkContext
    sent = context.broadcast((numbers, vectors))
    pieces = 1 + (numbers.n - 1) // PIECE_ROWS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, vectors = sent.value
        sums = None
        for batch in batches:
            for row in _each(batch):
                at, term, value, found = _term_sums(row, numbers, vectors)
                sums = [np.zeros(numbers.n) for _ in vectors] if sums is None else sums
                for s, z in zip(sums, found, strict=True):
                    s += np.bincount(at, value * z[term], numbers.n)
        task = TaskContext.get().partitionId()
        for i in range(pieces if sums is not None else 0):
            part = np.stack([s[i * PIECE_ROWS : (i + 1) * PIECE_ROWS] for s in sums])
            yield pa.record_batch([pa.array([i], pa.int32()), pa.array([task], pa.int32()), pa.array([part.tobytes()], pa.binary())], ["block", "task", "sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, rows in blocks(batches):
            total = sum(np.frombuffer(x.as_buffer()) for x in rows["sums"])
            yield pa.record_batch([pa.array([piece], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["block", "sums"])

    parts = cells.coalesce(_tasks(cells)).mapInArrow(run, "block int, task int, sums binary")
    # in order of task, so that the sums are the same each time
    added = parts.repartitionById(min(pieces, _tasks(cells)), F.col("block") % min(pieces, _tasks(cells))).sortWithinPartitions("block", "task")
    found = added.mapInArrow(add, "block int, sums binary").toArrow()
    sent.destroy()
    out = [np.zeros(numbers.n) for _ in vectors]
    for piece, sums in zip(found["block"].to_pylist(), found["sums"], strict=True):
        for s, v in zip(out, np.frombuffer(sums.as_buffer()).reshape(len(vectors), -1), strict=True):
            s[piece * PIECE_ROWS : (piece + 1) * PIECE_ROWS] = v
    return out


def sketch(ask: Callable[[list[np.ndarray]], list[np.ndarray]], n: int) -> np.ndarray:
    """B of a few columns with BB' close to XX' on the latter's large eigenvalues (Nystroem's, one step of the power method ahead)."""
    columns = max(1, min(SKETCH_COLUMNS, n, SKETCH_BYTES // (8 * n)))
    asked = np.random.default_rng(0).choice((-1.0, 1.0), (n, columns))

    def answers(vectors: np.ndarray) -> np.ndarray:
        found = []
        for i in range(0, columns, SKETCH_ASKED):
            found += ask(list(vectors.T[i : i + SKETCH_ASKED]))
        return np.stack(found, 1)

    asked = np.linalg.qr(answers(asked))[0]
    found = answers(asked)
    inner = asked.T @ found
    size, turn = np.linalg.eigh((inner + inner.T) / 2)
    kept = size > 1e-8 * size.max(initial=0.0)
    return found @ (turn[:, kept] / np.sqrt(size[kept]))


def newton(
    y: np.ndarray, weight: np.ndarray, ridge: float, max_iter: int, near: np.ndarray, square: np.ndarray, tol: float = 1e-7
) -> Generator[np.ndarray, np.ndarray, tuple[np.ndarray, float]]:
    """(a, intercept) that minimise sum(weight * logistic loss) + ridge / 2 * |X'a|^2; the intercept is not penalised.

    Newton's step from (a, b) is (K + ridge / curve) c + sb = -g / curve with sum(c) = 0, where K = XX' and g / curve is the
    gradient by row over the loss's curvature. Conjugate gradients solve it, both sides scaled by the root of the curvature,
    with K taken as ``near`` near' and a diagonal ahead of them; ``square`` is K's diagonal. Yielded are vectors c, to be answered
    with Kc. It ends when the gradient has shrunk to ``tol`` of the first one; on the way there its size is estimated.
    """
    rest = np.maximum(square - (near * near).sum(1), 1e-6 * square.max())
    a, ka, b = np.zeros(len(y)), np.zeros(len(y)), 0.0
    first, trust = None, 1.0

    def estimate(v: np.ndarray) -> float:
        return trust * (((near.T @ v) ** 2).sum() + v @ (rest * v))

    for _ in range(max_iter):
        margin = ka + b
        p = np.exp(-np.logaddexp(0.0, -margin))
        slope = weight * (p - y)
        g, gb = slope + ridge * a, slope.sum() / np.sqrt(len(y))  # the intercept's column, about as long as a row
        size = estimate(g) + gb * gb
        if first is None or size <= tol * tol * first:
            kg = yield g
            trust *= max(1.0, (g @ kg) / max(estimate(g), 1e-300))
            size = max(g @ kg, 0.0) + gb * gb
            first = size if first is None else first
            if size <= tol * tol * first:
                break
        h = np.sqrt(weight * np.maximum(p * (1.0 - p), 1e-10))
        diagonal = ridge + h * h * rest
        inner = np.linalg.cholesky(np.eye(near.shape[1]) + (near * (h * h / diagonal)[:, None]).T @ near)

        def solved(r: np.ndarray) -> np.ndarray:
            v = r / diagonal
            return v - h * (near @ np.linalg.solve(inner.T, np.linalg.solve(inner, near.T @ (h * v)))) / diagonal

        ones = solved(h)

        def ahead(r: np.ndarray) -> tuple[np.ndarray, float]:
            """(``r`` through the approximate inverse among vectors whose c sums to 0, the intercept's step)."""
            v = solved(r)
            return v - (h @ v) / (h @ ones) * ones, (h @ v) / (h @ ones)

        enough = max(min(0.1, (size / first) ** 0.25) ** 2 * size, 0.25 * tol * tol * first)
        c, kc, r = np.zeros(len(y)), np.zeros(len(y)), -g / h
        z, sb = ahead(r)
        d, left = z, r @ z
        for _ in range(len(y) + 1):
            if left <= 0 or estimate(h * (r - h * sb)) <= enough:
                break
            kd = yield h * d
            q = h * kd + ridge * d
            step = left / (d @ q)
            c, kc, r = c + step * h * d, kc + step * kd, r - step * q
            z, sb = ahead(r)
            d, left = z + (r @ z) / left * d, r @ z

        def loss(t: float) -> float:
            m = margin + t * (kc + sb)
            return weight @ (np.logaddexp(0.0, m) - y * m) + ridge / 2 * ((a + t * c) @ (ka + t * kc))

        t, base, fall = 1.0, loss(0.0), g @ kc + slope.sum() * sb
        while loss(t) > base + 1e-4 * t * fall + 1e-12 * abs(base) and t > 1e-9:
            t /= 2
        a, ka, b = a + t * c, ka + t * kc, b + t * sb
    return a, b


def fit(x: Matrix, labels: list[str], ridge: float, max_iter: int) -> tuple[Rows, list[tuple[np.ndarray, float]]]:
    """A balanced model of each label; all share the passes over the matrix."""
    names = [f"y{i}" for i in range(len(labels))]
    known = x.rows.select("chunk", "pos", "square", *(F.col(c).cast("double").alias(n) for c, n in zip(labels, names, strict=True))).toArrow()
    known = known.sort_by([("chunk", "ascending"), ("pos", "ascending")])
    numbers = Rows(known["chunk"].to_numpy())
    asked, steps, models, near = {}, {}, {}, None
    for i, (name, label) in enumerate(zip(names, labels, strict=True)):
        y = known[name].to_numpy()
        if not len(y) or known[name].null_count or not np.isin(y, (0.0, 1.0)).all():
            raise ValueError(f"{label}: every training row needs a label 0 or 1")
        pos = int(y.sum())
        if pos in (0, len(y)):  # one class only: no weights, a certain score
            models[i] = np.zeros(len(y)), np.inf if pos else -np.inf
            continue
        weight = np.where(y == 1, len(y) / (2 * pos), len(y) / (2 * (len(y) - pos)))
        near = sketch(lambda vectors: product(x.cells, numbers, vectors), len(y)) if near is None else near
        steps[i] = newton(y, weight, ridge, max_iter, near, known["square"].to_numpy())
        asked[i] = next(steps[i])
    while asked:
        for i, answer in zip(list(asked), product(x.cells, numbers, list(asked.values())), strict=True):
            try:
                asked[i] = steps[i].send(answer)
            except StopIteration as end:
                models[i] = end.value
                del asked[i]
    return numbers, [models[i] for i in range(len(labels))]


def margins(x: Matrix, numbers: Rows, a: list[np.ndarray], other: Matrix, n_blocks: int) -> DataFrame:
    """(chunk, pos, m): the margins of the other rows without intercepts, in order of ``a``; rows without entries are missing.

    A block's term weights meet the other rows' entries of the block in one task.
    """
    sent = x.cells.sparkSession.sparkContext.broadcast((numbers, a))
    k = len(a)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _each(batch):
                z = _term_sums(row, *sent.value)[3]
                yield pa.record_batch([pa.array([row["block"]], pa.int32()), pa.array([np.stack(z).tobytes()], pa.binary())], ["block", "weights"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, sums = TaskContext.get().partitionId(), {}
        for batch_block, rows in blocks(batches):
            weights = None
            for batch in rows.to_batches():
                for row in _each(batch):
                    if row["weights"] is not None:
                        weights = np.frombuffer(row["weights"]).reshape(k, -1)
                    elif weights is not None:
                        at, term, value = _entries(row)
                        seen = term < weights.shape[1]
                        at, term, value = at[seen], term[seen], value[seen]
                        add = np.stack([np.bincount(at, value * w[term], len(at) and at[-1] + 1) for w in weights], 1)
                        held = sums.get(row["chunk"], np.zeros((0, k)))
                        if len(held) < len(add):
                            held = np.concatenate([held, np.zeros((len(add) - len(held), k))])
                        held[: len(add)] += add
                        sums[row["chunk"]] = held
        for chunk, held in sums.items():
            n = len(held)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * k), pa.array(held.ravel()))
            yield pa.record_batch([pa.array(np.full(n, task)), pa.array(np.full(n, chunk)), pa.array(np.arange(n, dtype=np.int32)), lists], ["task", "chunk", "pos", "m"])

    weights = x.cells.mapInArrow(weigh, "block int, weights binary")
    rows = weights.select(F.lit("a").alias("kind"), "block", F.lit(None).cast("long").alias("chunk"), *(F.lit(None).cast("binary").alias(c) for c in ENTRIES), "weights").unionByName(
        other.cells.select(F.lit("b").alias("kind"), "block", "chunk", *ENTRIES, F.lit(None).cast("binary").alias("weights"))
    )
    parts = by_block(rows, n_blocks).coalesce(_tasks(rows)).mapInArrow(run, "task long, chunk long, pos int, m array<double>")
    # in order of task, so that equal rows have equal sums
    inside = F.sort_array(F.collect_list(F.struct("task", "m")))
    zeros = F.array(*[F.lit(0.0)] * k)
    total = F.aggregate(inside, zeros, lambda acc, t: F.zip_with(acc, t["m"], lambda u, v: u + v))
    return parts.groupBy("chunk", "pos").agg(total.alias("m"))


def scores(train: DataFrame, other: DataFrame, key: str, labels: list[str], ridge: float, max_iter: int) -> DataFrame:
    """(key, label, score): probability of label 1 for each row of ``other``, both with ``features``."""
    spark = train.sparkSession
    entries = train.agg(F.sum(F.size(F.unwrap_udt("features")["values"]))).first()[0] or 0
    n_blocks = n_blocks_of(entries, _tasks(train))
    out = f"{temporary(spark, 'margins')}/rows"
    with scratch(spark, "matrix") as folder, shuffles_removed(spark):
        x = matrix(train, n_blocks, labels, True, f"{folder}/train")
        numbers, models = fit(x, labels, ridge, max_iter)
        asked = matrix(other, n_blocks, [key], False, f"{folder}/other")
        found = margins(x, numbers, [a for a, _ in models], asked, n_blocks)
        rows = asked.rows.join(found, ["chunk", "pos"], "left").select(
            key, *(F.coalesce(F.col("m")[i], F.lit(0.0)).alias(f"_m{i}") for i in range(len(labels)))
        )
        rows.write.parquet(out)
    rows = spark.read.schema(rows.schema).parquet(out)
    score = [1.0 / (1.0 + F.exp(-(F.col(f"_m{i}") + F.lit(float(b))))) for i, (_, b) in enumerate(models)]
    each = [F.struct(F.lit(label).alias("label"), s.alias("score")) for label, s in zip(labels, score, strict=True)]
    return rows.select(key, F.inline(F.array(*each)))
