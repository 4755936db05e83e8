"""Near-duplicate join on sets of five-word shingles, with Bayesian pruning of candidate pairs.

1. Every whole text becomes its set of shingles (runs of non-space characters are words; a text of one to
   four words has one shingle), a hash of the set and ``HASHES`` MinHash values. Documents of equal sets
   are one class from here on.
2. Sets that agree in a band of ``ROWS`` values are candidates. A bucket yields a star, not all pairs;
   the stars' components are the groups in which candidate pairs lie.
3. Each group is compared inside tasks, large groups by pairs of blocks of about ``BLOCK`` sets. A pair
   that shares a band is followed through its MinHash values, ``LOOK`` at a time, and dropped when the
   posterior probability that its similarity reaches the threshold (uniform prior) falls below
   ``TOLERANCE``. The rest are verified on the shingles themselves. A task returns one row for each set:
   its number of links there and the root of its part of the links' forest. Pairs never leave a task.
4. Components of those forests are the classes.

At similarity 0.8 a pair shares no band with probability 5e-5, and is pruned with less than 1e-4.

Cases: null text and text without words have no shingles: each such document is its own class, without
links; equal doc_ids are told apart by their texts, equal rows get equal results; null doc_ids take part
and name a class only if all its documents have none; an empty table gives no rows; other columns are
ignored or, in ``keep_representatives``, kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from epipanel.llm.common import partitions, stored, texts
from epipanel.llm.components import components

WIDTH, THRESHOLD = 5, 0.8
HASHES, ROWS = 128, 5
BANDS = HASHES // ROWS
LOOK, TOLERANCE = 16, 1e-5
BLOCK = 512
U = np.uint64
_RNG = np.random.default_rng(20)
SCALE = (_RNG.integers(0, 2**31, HASHES, dtype=np.uint64) * 2 + 1).astype(np.uint32)
SHIFT = _RNG.integers(0, 2**32, HASHES, dtype=np.uint64).astype(np.uint32)
STEPS = np.array([pow(0x9E3779B97F4A7C15, k, 1 << 64) for k in range(WIDTH)], U)


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U(32))
    x = x * U(0xD6E8FEB86659FD93)
    x ^= x >> U(32)
    x = x * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


def shingle_sets(column: pa.Array) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text."""
    words = pc.ascii_split_whitespace(column)
    flat = words.flatten()
    if not len(flat):
        return [np.zeros(0, U)] * len(column)
    coded = flat.dictionary_encode()
    unique = [w.encode("utf-8", "surrogatepass") for w in coded.dictionary.to_pylist()]
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in unique], U)
    full = np.array([bool(w) for w in unique])
    index = coded.indices.to_numpy()
    ends = np.cumsum(pc.list_value_length(words).to_numpy())
    keep = full[index]
    ends = np.concatenate([[0], np.cumsum(keep)])[ends]
    x = hashes[index[keep]]
    starts = np.concatenate([[0], ends[:-1]])
    windows = np.zeros(max(0, len(x) - WIDTH + 1), U)
    for k in range(WIDTH):
        windows += x[k : k + len(windows)] * STEPS[k]
    windows = mixed(windows)
    out = []
    for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
        if b - a >= WIDTH:
            s = np.sort(windows[a : b - WIDTH + 1])
            out.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
        elif b > a:
            out.append(mixed((x[a:b] * STEPS[: b - a]).sum(keepdims=True, dtype=U) + U(b - a)))
        else:
            out.append(np.zeros(0, U))
    return out


def minhashes(sets: list[np.ndarray]) -> np.ndarray:
    """One row of ``HASHES`` values for each set, all of them non-empty."""
    sizes = [len(s) for s in sets]
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
    x = (np.concatenate(sets) >> U(32)).astype(np.uint32)
    out = np.empty((len(sets), HASHES), np.uint32)
    for k in range(HASHES):
        out[:, k] = np.minimum.reduceat(x * SCALE[k] + SHIFT[k], starts)
    return out


def set_hash(shingles: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, set_id (null without shingles) and signature of every document."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for start in range(0, part.num_rows, 512):
                cut = part.slice(start, 512)
                sets = shingle_sets(cut.column("text"))
                full = [k for k, s in enumerate(sets) if len(s)]
                prints: list[bytes | None] = [None] * len(sets)
                if full:
                    for k, row in zip(full, minhashes([sets[k] for k in full]), strict=True):
                        prints[k] = row.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        cut.column("doc_id"), cut.column("text_hash"),
                        pa.array([set_hash(s) if len(s) else None for s in sets], pa.int64()), pa.array(prints, pa.binary()),
                    ],
                    names=["doc_id", "text_hash", "set_id", "signature"],
                )

    rows = texts(docs).withColumn("text_hash", F.xxhash64("text"))
    return rows.mapInArrow(run, "doc_id long, text_hash long, set_id long, signature binary")


def stars(sets: DataFrame) -> DataFrame:
    """a, b: every set with the first one of each bucket that it shares with others."""
    n = partitions(sets.sparkSession)

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            values = np.frombuffer(b"".join(part.column("signature").to_pylist()), np.uint32).reshape(-1, HASHES)
            ids = part.column("set_id").to_numpy()
            for band in range(BANDS):
                key = np.full(len(ids), band, U)
                for k in range(ROWS):
                    key = mixed(key * U(31) + values[:, band * ROWS + k])
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(ids)], names=["bucket", "set_id"])

    def meet(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, head = None, 0  # the bucket that the batch before ended in, and its first set
        for part in parts:
            bucket, ids = part.column("bucket").to_numpy(), part.column("set_id").to_numpy()
            if not len(ids):
                continue
            first = np.concatenate([[last is None or bucket[0] != last], bucket[1:] != bucket[:-1]])
            place = np.maximum.accumulate(np.where(first, np.arange(len(ids)), -1))
            heads = np.where(place >= 0, ids[place], head)
            last, head = bucket[-1], heads[-1]
            found = heads != ids
            yield pa.RecordBatch.from_arrays([pa.array(ids[found]), pa.array(heads[found])], names=["a", "b"])

    buckets = sets.select("set_id", "signature").mapInArrow(cut, "bucket long, set_id long")
    return buckets.repartition(n, "bucket").sortWithinPartitions("bucket", "set_id").mapInArrow(meet, "a long, b long")


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> list[tuple[int, int]]:
    """(values looked at, matches needed): below, the posterior of reaching the threshold is under the tolerance.

    With a uniform prior and m matches in n values the posterior is P(Binomial(n + 1, threshold) <= m).
    """
    out = []
    for n in range(LOOK, HASHES + 1, LOOK):
        total, m = 0.0, 0
        while True:
            total += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if total >= tolerance:
                break
            m += 1
        out.append((n, m))
    return out


def linked(prints: np.ndarray, sets: list[np.ndarray], rows: np.ndarray, others: np.ndarray, same: bool, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (of ``rows`` with ``others``; each once if they are the same) whose similarity reaches the threshold."""
    needed = least_matches(threshold)
    names, codes = np.unique(np.concatenate([sets[k] for k in others]), return_inverse=True)
    starts = np.concatenate([[0], np.cumsum([len(sets[k]) for k in others])[:-1]]).astype(np.int64)
    sizes = np.array([len(sets[k]) for k in others])
    bands = prints[:, : BANDS * ROWS].reshape(len(prints), BANDS, ROWS)
    found_a, found_b = [], []
    for k in rows.tolist():
        left = np.flatnonzero(others > k) if same else np.arange(len(others))
        if not len(left):
            continue
        left = left[(bands[others[left]] == bands[k]).all(axis=2).any(axis=1)]
        agree, seen = np.zeros(len(left), np.int64), 0
        for n, least in needed:
            if not len(left):
                break
            agree += (prints[others[left], seen:n] == prints[k, seen:n]).sum(axis=1)
            keep = agree >= least
            left, agree, seen = left[keep], agree[keep], n
        if not len(left):
            continue
        if len(left) < 8:
            both = np.array([len(np.intersect1d(sets[k], sets[others[j]], assume_unique=True)) for j in left])
        else:
            place = np.minimum(np.searchsorted(names, sets[k]), len(names) - 1)
            mark = np.zeros(len(names), bool)
            mark[place[names[place] == sets[k]]] = True
            both = np.add.reduceat(mark[codes].astype(np.int64), starts)[left]
        like = both / (len(sets[k]) + sizes[left] - both)
        hit = left[like >= threshold]
        found_a.append(np.full(len(hit), k))
        found_b.append(others[hit])
    if not found_a:
        return np.zeros(0, int), np.zeros(0, int)
    return np.concatenate(found_a), np.concatenate(found_b)


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Root of every row in the links' components."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while True:
            after = root[root]
            if (after == root).all():
                break
            root = after
        if (root == before).all():
            break
    return root


def verified(docs: DataFrame, groups: DataFrame, threshold: float) -> DataFrame:
    """set_id, peer, links: for each set and block pair, the documents linked to it there and its forest's root."""
    n = partitions(docs.sparkSession)
    rows = texts(docs).withColumn("text_hash", F.xxhash64("text"))

    def sets_of(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # of the sets with copies: equal rows (same doc_id or none) are read once a task
        for part in parts:
            for start in range(0, part.num_rows, 512):
                cut = part.slice(start, 512)
                fresh = []
                for k, (i, copies) in enumerate(zip(cut.column("set_id").to_pylist(), cut.column("copies").to_pylist(), strict=True)):
                    if copies > 1 and i in seen:
                        continue
                    if copies > 1:
                        seen.add(i)
                    fresh.append(k)
                cut = cut.take(pa.array(fresh, pa.int64()))
                sets = shingle_sets(cut.column("text"))
                right = [k for k, i in enumerate(cut.column("set_id").to_pylist()) if len(sets[k]) and set_hash(sets[k]) == i]
                yield pa.RecordBatch.from_arrays(
                    [*(cut.column(c).take(pa.array(right, pa.int64())) for c in ("set_id", "root", "copies", "blocks")), pa.array([sets[k].tobytes() for k in right], pa.binary())],
                    names=["set_id", "root", "copies", "blocks", "shingles"],
                )

    named = groups.select("first_doc", "first_hash", "set_id", "root", "copies", "blocks")
    # by text too: one doc_id, or none at all, may stand for many texts
    held = rows.join(named, F.col("doc_id").eqNullSafe(F.col("first_doc")) & (F.col("text_hash") == F.col("first_hash")))
    held = held.select("text", "set_id", "root", "copies", "blocks").mapInArrow(
        sets_of, "set_id long, root long, copies long, blocks int, shingles binary"
    )
    own = F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int")
    pairs = (
        held.withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")})
        .select("root", "low", "high", "own", "set_id", "copies", "shingles")
    )

    def compare(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_rows: list[tuple] = []
        for part in parts:
            columns = [part.column(c).to_pylist() for c in ("root", "low", "high", "own", "set_id", "copies", "shingles")]
            for row in zip(*columns, strict=True):
                if held_rows and row[:3] != held_rows[-1][:3] and len(held_rows) >= 2 * BLOCK:
                    yield answer(held_rows, threshold)
                    held_rows = []
                held_rows.append(row)
        if held_rows:
            yield answer(held_rows, threshold)

    return pairs.repartition(n, "root", "low", "high").sortWithinPartitions("root", "low", "high", "set_id").mapInArrow(
        compare, "set_id long, peer long, links long"
    )


def answer(rows: list[tuple], threshold: float) -> pa.RecordBatch:
    """Links within each (root, low, high) of ``rows``, which are in that order."""
    rows = [r for k, r in enumerate(rows) if not k or (r[:3], r[4]) != (rows[k - 1][:3], rows[k - 1][4])]  # equal rows once
    sets = [np.frombuffer(r[6], U) for r in rows]
    prints = minhashes(sets)
    ids = np.array([r[4] for r in rows], np.int64)
    copies = np.array([r[5] for r in rows], np.int64)
    links, peer = np.zeros(len(rows), np.int64), ids.copy()
    start = 0
    while start < len(rows):
        stop = start
        while stop < len(rows) and rows[stop][:3] == rows[start][:3]:
            stop += 1
        _, low, high = rows[start][:3]
        own = np.array([r[3] for r in rows[start:stop]])
        here = np.arange(start, stop)
        left, right = here[own == low], here[own == high]
        if len(left) and len(right):
            a, b = linked(prints, sets, left, right, low == high, threshold)
            np.add.at(links, a, copies[b])
            np.add.at(links, b, copies[a])
            roots = forest(stop - start, a - start, b - start)
            peer[start:stop] = ids[here[roots]]
        start = stop
    return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(peer), pa.array(links)], names=["set_id", "peer", "links"])


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, text_hash, set_id, class_root, class_id and n_links (documents linked to it, copies too) of every document.

    ``class_root`` (a set_id, null without shingles) tells classes apart; ``class_id`` names them by their smallest
    doc_id, which two classes may share.
    """
    signed = stored(signatures(docs))
    sets = (
        signed.where(F.col("set_id").isNotNull()).groupBy("set_id")
        .agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")).alias("m"),
            F.count("*").alias("copies"), F.first("signature").alias("signature"),
        )
        .select("set_id", F.col("m.doc_id").alias("first_doc"), F.col("m.text_hash").alias("first_hash"), "copies", "signature")
    )
    sets = stored(sets)
    near = components(stars(sets))
    sizes = near.groupBy("root").agg(F.count("*").alias("n"))
    groups = (
        near.join(sizes, "root").select(F.col("node").alias("set_id"), "root", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
        .join(sets.select("set_id", "first_doc", "first_hash", "copies"), "set_id")
    )
    found = stored(verified(docs, groups, threshold))
    joined = components(found.select(F.col("set_id").alias("a"), F.col("peer").alias("b")))
    counts = found.groupBy("set_id").agg(F.sum("links").alias("links"))
    known = (
        sets.select("set_id", "first_doc", "copies")
        .join(joined.withColumnRenamed("node", "set_id"), "set_id", "left")
        .join(counts, "set_id", "left")
        .withColumn("root", F.coalesce("root", "set_id"))
    )
    names = known.groupBy("root").agg(F.min("first_doc").alias("class_id"))
    known = known.join(names, "root").select(
        F.col("set_id").alias("known_set"), F.col("root").alias("class_root"), "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    alone = F.col("set_id").isNull()
    return (
        signed.select("doc_id", "text_hash", "set_id")
        .join(known, F.col("set_id") == F.col("known_set"), "left")
        .select(
            "doc_id", "text_hash", "set_id", "class_root",
            F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        )
    )


def keep_representatives(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """All columns of one document of each class (smallest doc_id) and of every document without words."""
    found = classes(docs, threshold).where(F.col("set_id").isNull() | F.col("doc_id").eqNullSafe(F.col("class_id")))
    # equal doc_ids or none at all may still leave several rows of a class: one of them is taken
    alone = found.where(F.col("set_id").isNull()).select("doc_id", "text_hash").distinct()
    first = found.where(F.col("set_id").isNotNull()).groupBy("class_root").agg(F.min(F.struct("text_hash", "doc_id")).alias("m")).select("m.doc_id", "m.text_hash")
    chosen = alone.withColumn("__llm_each", F.lit(True)).unionByName(first.withColumn("__llm_each", F.lit(False))).select(
        F.col("doc_id").alias("__llm_kept_doc"), F.col("text_hash").alias("__llm_kept_hash"), "__llm_each"
    )
    hash_of = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    rows = docs.join(chosen, docs["doc_id"].eqNullSafe(F.col("__llm_kept_doc")) & (hash_of == F.col("__llm_kept_hash")))
    row = Window.partitionBy("__llm_kept_doc", "__llm_kept_hash").orderBy(F.lit(1))
    return rows.withColumn("__llm_kept_row", F.row_number().over(row)).where(F.col("__llm_each") | (F.col("__llm_kept_row") == 1)).select(*docs.columns)
