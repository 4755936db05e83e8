"""Repeated passages: every byte of a string of ``LENGTH`` bytes that starts anywhere else too.

1. Every string of ``LENGTH`` bytes has an anchor: the position in it whose ``WIDTH`` bytes hash least
   (the last such). Equal strings have equal anchors at equal places, so strings can only repeat where an
   anchor's hash does. Strings that follow each other and share an anchor form one context.
2. Contexts meet by their anchor's hash, sorted, in a stream that holds one row. A context that stands
   elsewhere byte for byte (by hash) is covered whole. The others, where the anchor does occur elsewhere,
   go on with their bytes, and one of each set of equal contexts with them.
3. In a task, the contexts of some anchors become one text with its enhanced suffix array: the suffixes
   that start a string of ``LENGTH`` bytes, sorted, with the common prefixes of neighbours. A stack scan
   over the intervals of common prefixes of at least ``LENGTH`` yields, by testing whether what stands in
   front of the occurrences differs, the maximal repeats, each with all its occurrences.
4. Spans go back to their documents; matches never cross documents.

An anchor met in more than ``HOT`` contexts is not held in one task: each string of those contexts goes by
the hash of its own ``LENGTH`` bytes, sorted, in a stream that holds one row, and is covered if it stands
elsewhere. Nothing is dropped. Bytes are compared by 64-bit hashes in step 2 and for these strings.

Cases: null text is empty; texts shorter than ``LENGTH`` bytes keep all; equal rows repeat each other;
an empty table gives no rows; other columns are ignored or, in ``without_repeats``, kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epipanel.llm.common import partitions, stored

LENGTH, WIDTH = 200, 64
HOT = 20_000
ROWS = 20_000
TASK_BYTES = 1_500_000
PLACE_BITS = 28
U = np.uint64
ALONE, REPEATED, SPAN = 0, 1, 2
_RNG = np.random.default_rng(11)
BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) | U(1)
BASE = 0x9E3779B97F4A7C15
BASE_BACK = pow(BASE, -1, 1 << 64)
_RUN = U(0x5851F42D4C957F2D)


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. n - 1 modulo 2 ** 64."""
    out = np.full(n, base, U)
    out[:1] = 1
    return np.multiply.accumulate(out)


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U(31))
    x = x * U(0x7FB5D329728EA185)
    x ^= x >> U(27)
    x = x * U(0x81DADEF4BC2DD44D)
    return x ^ (x >> U(33))


def contexts(documents: list[bytes]) -> tuple[np.ndarray, ...]:
    """Of all contexts: document, anchor hash, context hash, first string's place, number of strings, anchor's place in it, state.

    Contexts that one document repeats, as texts with a period do at every step, cover each other: what
    they cover is one ``SPAN`` row for each stretch, and one of them stays, as ``REPEATED``.
    """
    sizes = np.array([len(d) for d in documents], np.int64)
    none = tuple(np.zeros(0, np.int64) for _ in range(7))
    data = np.frombuffer(b"".join(documents), np.uint8)
    span = LENGTH - WIDTH + 1  # positions of an anchor within a string
    if len(data) < LENGTH:
        return none
    x = BYTE[data]
    h, width, base = x, 1, 0xD1342543DE82EF95
    while width < WIDTH:
        h = h[:-width] * U(base) + h[width:]
        width, base = 2 * width, base * base % (1 << 64)
    h = mixed(h)
    low = U((1 << PLACE_BITS) - 1)
    least = (h & ~low) | (low - (np.arange(len(h), dtype=U) & low))
    width = 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < span:
        least = np.minimum(least[: len(least) - (span - width)], least[span - width :])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    string = np.arange(len(data) - LENGTH + 1)
    owner = np.repeat(np.arange(len(sizes)), sizes)[: len(string)]
    inside = string + LENGTH <= (starts + sizes)[owner]
    string, owner = string[inside], owner[inside]
    if not len(string):
        return none
    anchor = (low - (least[string] & low)).astype(np.int64)
    anchor += (string >> PLACE_BITS) << PLACE_BITS
    anchor += np.where(anchor < string, 1 << PLACE_BITS, 0)
    fresh = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])])
    first = np.flatnonzero(fresh)
    count = np.diff(first, append=len(string))
    lo, owner, anchor = string[first], owner[first], anchor[first]
    sums = np.concatenate([np.zeros(1, U), np.cumsum(x * powers(BASE, len(x)), dtype=U)])
    back = powers(BASE_BACK, len(x))
    whole = mixed((sums[lo + count - 1 + LENGTH] - sums[lo]) * back[lo] + count.astype(U)).view(np.int64)
    key, place = h[anchor].view(np.int64), lo - starts[owner]
    order = np.lexsort((whole, key, owner))
    same = (owner[order][1:] == owner[order][:-1]) & (key[order][1:] == key[order][:-1]) & (whole[order][1:] == whole[order][:-1])
    again, twice = np.zeros(len(order), bool), np.zeros(len(order), bool)
    again[order[1:][same]] = True
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    state = np.where(twice, REPEATED, ALONE)
    at = np.flatnonzero(twice)
    stop = place[at] + count[at] - 1 + LENGTH
    new = np.concatenate([[True], (owner[at][1:] != owner[at][:-1]) | (place[at][1:] > stop[:-1])])[: len(at)]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at))[: len(first)] - 1
    begin = place[at[first]]
    strings = stop[last] - begin - LENGTH + 1
    own_key = mixed(_RUN + h[anchor[at[first]]] * U(31) + np.arange(len(first), dtype=U)).view(np.int64)
    keep = ~again
    rows = (owner[keep], key[keep], whole[keep], place[keep], count[keep], (anchor - lo)[keep], state[keep])
    spans_ = (owner[at[first]], own_key, own_key, begin, strings, np.zeros(len(first), np.int64), np.full(len(first), SPAN))
    return tuple(np.concatenate(pair) for pair in zip(rows, spans_, strict=True))


def doc_key() -> Column:
    return F.xxhash64("doc_id", F.coalesce(F.col("text"), F.lit("")))


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", doc_key().alias("doc_key"), F.coalesce("text", F.lit("")).alias("text"))


CONTEXT = "anchor long, whole long, doc_id long, doc_key long, lo int, strings int, at int, state int"


def anchored(docs: DataFrame) -> DataFrame:
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for start in range(0, part.num_rows, 256):
                cut = part.slice(start, 256)
                owner, anchor, whole, lo, strings, at, state = contexts([t.encode("utf-8", "surrogatepass") for t in cut.column("text").to_pylist()])
                take = pa.array(owner)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(anchor), pa.array(whole), cut.column("doc_id").take(take), cut.column("doc_key").take(take),
                        *(pa.array(v.astype(np.int32)) for v in (lo, strings, at, state)),
                    ],
                    names=["anchor", "whole", "doc_id", "doc_key", "lo", "strings", "at", "state"],
                )

    return keyed(docs).mapInArrow(run, CONTEXT)


#: What a context that met another becomes.
COVERED, OPEN, WITNESS = 0, 1, 2


def met(contexts_: DataFrame) -> DataFrame:
    """Contexts whose anchor occurs elsewhere: covered whole, open, or a witness that open ones are compared with."""
    names = ["anchor", "whole", "doc_id", "doc_key", "lo", "strings", "at", "state"]

    def judge(rows: pa.RecordBatch | pa.Table, before: tuple | None, last: bool) -> tuple[pa.Table, int]:
        a, w, state = (rows.column(c).to_numpy() for c in ("anchor", "whole", "state"))
        n = len(a)
        same_a = np.concatenate([[before is not None and before[0] == a[0]], a[1:] == a[:-1], [False]])
        same_w = same_a & np.concatenate([[before is not None and before[1] == w[0]], w[1:] == w[:-1], [False]])
        done = n if last else n - 1
        prev_a, next_a, prev, next_ = same_a[:-1], same_a[1:], same_w[:-1], same_w[1:]
        covered = prev | next_ | (state != ALONE)
        kinds = (
            (COVERED, prev | next_ | (state == SPAN)), (OPEN, ~covered & (prev_a | next_a)),
            (WITNESS, covered & (state != SPAN) & ((prev_a & ~prev) | (next_a & ~next_))),
        )
        found = []
        for kind, which in kinds:
            at = np.flatnonzero(which[:done])
            cut = rows.take(pa.array(at))
            found.append(cut.append_column("kind", pa.array(np.full(len(at), kind, np.int32))))
        return pa.concat_tables(found), done

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, before = None, None
        for part in parts:
            rows = pa.Table.from_batches([part])
            rows = pa.concat_tables([held, rows.cast(held.schema)]) if held is not None else rows
            if not rows.num_rows:
                continue
            rows = rows.combine_chunks()
            found, done = judge(rows, before, last=False)
            yield from found.combine_chunks().to_batches()
            if done:
                before = (rows.column("anchor")[done - 1].as_py(), rows.column("whole")[done - 1].as_py())
            held = rows.slice(done)
        if held is not None and held.num_rows:
            found, _ = judge(held.combine_chunks(), before, last=True)
            yield from found.combine_chunks().to_batches()

    n = partitions(contexts_.sparkSession)
    return contexts_.select(*names).repartition(n, "anchor").sortWithinPartitions("anchor", "whole").mapInArrow(run, f"{CONTEXT}, kind int")


def prefix_ranks(data: np.ndarray) -> dict[int, np.ndarray]:
    """For 8, 16 .. 128: the rank of each position's prefix of that length among all, by doubling.

    ``data`` holds symbols of at most 32 bits; beyond its end stands nothing.
    """
    ranks = {1: np.unique(data, return_inverse=True)[1].astype(np.int64)}
    width = 1
    while width < 128:
        have = ranks.pop(width) if width < 8 else ranks[width]
        later = np.zeros(len(have), np.int64)
        later[:-width] = have[width:] + 1
        ranks[2 * width] = np.unique(have * (int(later.max()) + 1) + later, return_inverse=True)[1].astype(np.int64)
        width *= 2
    return ranks


def common_prefix(ranks: dict[int, np.ndarray], data: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Lengths of the common prefixes of suffixes a and b, by binary descent over the ranks."""
    n, out = len(data), np.zeros(len(a), np.int64)
    for width in (128, 128, 128, 64, 32, 16, 8):
        x, y = a + out, b + out
        fits = (x < n) & (y < n)
        same = np.zeros(len(a), bool)
        same[fits] = ranks[width][x[fits]] == ranks[width][y[fits]]
        out[same] += width
    for _ in range(7):
        x, y = a + out, b + out
        fits = (x < n) & (y < n)
        fits[fits] = data[x[fits]] == data[y[fits]]
        out[fits] += 1
    return out


def maximal_repeats(texts_: list[bytes], length: int = LENGTH) -> Iterator[tuple[int, np.ndarray]]:
    """(repeat's length, its places in the joined texts) for every maximal repeat of at least ``length`` bytes.

    Places count a separator behind each text. The suffixes that start a string of ``length`` bytes are
    sorted with the common prefixes of neighbours; intervals of common prefixes nest like a tree, which
    one scan with a stack visits. An interval is a maximal repeat if its occurrences do not all have the
    same byte in front (a text's start differs from everything).
    """
    sizes = np.array([len(t) for t in texts_], np.int64)
    ends = np.cumsum(sizes + 1) - 1
    data = np.zeros(int(ends[-1]) + 1 if len(ends) else 0, np.int64)
    if not len(data):
        return
    inside = np.ones(len(data), bool)
    inside[ends] = False
    data[inside] = np.frombuffer(b"".join(texts_), np.uint8)
    data[ends] = 256 + np.arange(len(ends))
    ranks = prefix_ranks(data)
    starts = ends - sizes
    suffix = np.arange(len(data))
    suffix = suffix[(suffix + length <= np.repeat(ends, sizes + 1))]
    if len(suffix) < 2:
        return
    rank = np.concatenate([ranks[128] + 1, np.zeros(384, np.int64)])
    order = np.lexsort((rank[suffix + 256], rank[suffix + 128], rank[suffix]))  # by 384 bytes: no context is longer
    suffix = suffix[order]
    near = (rank[suffix[1:]] == rank[suffix[:-1]]) & (rank[suffix[1:] + length - 128] == rank[suffix[:-1] + length - 128]) if length >= 128 else np.ones(len(suffix) - 1, bool)
    lcp = np.zeros(len(suffix) + 1, np.int64)
    at = np.flatnonzero(near)
    lcp[at + 1] = common_prefix(ranks, data, suffix[at], suffix[at + 1])
    lcp[lcp < length] = 0
    front = np.where(np.isin(suffix, starts), -1 - suffix, data[suffix - 1])
    # runs of suffixes joined by prefixes of at least ``length``; one byte in front of all: nothing maximal in it
    begin = np.flatnonzero((lcp[:-1] == 0) & (lcp[1:] > 0))
    stop = np.flatnonzero((lcp[:-1] > 0) & (lcp[1:] == 0)) + 1
    changes = np.concatenate([[0], np.cumsum(front[1:] != front[:-1])])
    for a, b in zip(begin.tolist(), stop.tolist(), strict=True):
        if changes[b - 1] == changes[a]:
            continue
        stack: list[tuple[int, int]] = []  # (common prefix, first suffix)
        for k in range(a + 1, b + 1):
            here = int(lcp[k]) if k < b else 0
            first = k - 1
            while stack and stack[-1][0] > here:
                depth, first = stack.pop()
                if changes[k - 1] != changes[first]:
                    yield depth, suffix[first:k]
            if here and (not stack or stack[-1][0] < here):
                stack.append((here, first))


def stand_elsewhere(rows: pa.Table, before: int | None, last: bool) -> tuple[pa.Table, int]:
    """Spans of the open strings whose hash the row in front or behind has too, and the number of rows judged."""
    group, kind = rows.column("group").to_numpy(), rows.column("kind").to_numpy()
    done = len(group) if last else len(group) - 1
    same = np.concatenate([[before is not None and before == group[0]], group[1:] == group[:-1], [False]])
    at = pa.array(np.flatnonzero(((same[:-1] | same[1:]) & (kind == OPEN))[:done]))
    found = rows.select(["doc_id", "doc_key", "lo"]).take(at).combine_chunks()
    lo = found.column("lo")
    found = found.append_column("stop", pc.add(lo, pa.scalar(LENGTH, pa.int32()))).rename_columns(["doc_id", "doc_key", "start", "stop"])
    return found, done


def resolved(needs: DataFrame) -> DataFrame:
    """doc_id, doc_key, start, stop: what repeats of the open contexts, and of the strings of hot ones, cover."""
    n = partitions(needs.sparkSession)

    def answer(rows: list[tuple]) -> pa.RecordBatch:
        texts_ = [r[5] for r in rows]
        ends = np.cumsum([len(t) + 1 for t in texts_])
        starts = ends - np.array([len(t) + 1 for t in texts_])
        low: dict[int, list[tuple[int, int]]] = {}
        for depth, places in maximal_repeats(texts_):
            owner = np.searchsorted(ends, places, side="right")
            for k, place in zip(owner.tolist(), (places - starts[owner]).tolist(), strict=True):
                low.setdefault(k, []).append((place, place + depth))
        out = []
        for k, spans in low.items():
            _, doc, key, lo, kind, _ = rows[k]
            if kind == OPEN:
                out += [(doc, key, lo + a, lo + b) for a, b in joined(spans)]
        columns = list(zip(*out, strict=True)) or [()] * 4
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.int32()), strict=True)], names=["doc_id", "doc_key", "start", "stop"]
        )

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size = 0
        held, before = None, None  # the last string of a hot context, judged with the next one, and the hash in front of it
        for part in parts:
            single = pc.is_null(part.column("bytes"))
            strings = pa.Table.from_batches([part.filter(single).select(["group", "doc_id", "doc_key", "lo", "kind"])])
            if strings.num_rows:
                strings = (pa.concat_tables([held, strings.cast(held.schema)]) if held is not None else strings).combine_chunks()
                found, done = stand_elsewhere(strings, before, last=False)
                yield from found.to_batches()
                if done:
                    before = strings.column("group")[done - 1].as_py()
                held = strings.slice(done).combine_chunks()
            part = part.filter(pc.invert(single))
            columns = [part.column(c).to_pylist() for c in ("group", "doc_id", "doc_key", "lo", "kind", "bytes")]
            for row in zip(*columns, strict=True):
                if rows and size > TASK_BYTES and row[0] != rows[-1][0]:
                    yield answer(rows)
                    rows, size = [], 0
                rows.append(row)
                size += len(row[5])
        if rows:
            yield answer(rows)
        if held is not None:
            yield from stand_elsewhere(held, before, last=True)[0].to_batches()

    return needs.repartition(n, "group").sortWithinPartitions("group").mapInArrow(run, "doc_id long, doc_key long, start int, stop int")


def joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def with_bytes(docs: DataFrame, needs: DataFrame) -> DataFrame:
    """group, doc_id, doc_key, lo, kind and bytes of every context asked for; of hot ones each string, by its hash, without bytes."""
    own = needs.groupBy(F.col("doc_id").alias("need_id"), F.col("doc_key").alias("need_key")).agg(
        F.collect_set(F.struct("anchor", "lo", "strings", "kind", "hot")).alias("asked")
    )
    rows = keyed(docs).join(own, (F.col("doc_key") == F.col("need_key")) & F.col("doc_id").eqNullSafe(F.col("need_id"))).select("doc_id", "doc_key", "text", "asked")

    names = ["group", "doc_id", "doc_key", "lo", "kind", "bytes"]
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())

    def batch(out: list[tuple]) -> pa.RecordBatch:
        values = list(zip(*out, strict=True)) or [()] * 6
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, kinds, strict=True)], names=names)

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for start in range(0, part.num_rows, 128):
                piece = part.slice(start, 128)
                out: list[tuple] = []
                columns = [piece.column(c).to_pylist() for c in ("doc_id", "doc_key", "text", "asked")]
                for doc, key, text, asked in zip(*columns, strict=True):
                    raw = text.encode("utf-8", "surrogatepass")
                    for c in asked:
                        lo, hi = c["lo"], c["lo"] + c["strings"]
                        if not c["hot"]:
                            out.append((c["anchor"], doc, key, lo, c["kind"], raw[lo : hi - 1 + LENGTH]))
                        else:
                            out += [(xxhash.xxh3_64_intdigest(raw[a : a + LENGTH]) - (1 << 63), doc, key, a, c["kind"], None) for a in range(lo, hi)]
                        if len(out) >= ROWS:
                            yield batch(out)
                            out = []
                yield batch(out)

    return rows.mapInArrow(cut, "group long, doc_id long, doc_key long, lo int, kind int, bytes binary")


def spans(docs: DataFrame) -> DataFrame:
    """__llm_id, __llm_key, __llm_spans (start and stop in bytes) of every document that holds repeated strings."""
    found = stored(met(anchored(docs)))
    asked = found.where(F.col("kind") != COVERED)
    # written first: a few rows that Spark broadcasts by their size, or joins with splits where they are many
    hot = stored(asked.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > HOT).select(F.col("anchor").alias("hot_anchor")))
    needs = asked.join(hot, F.col("anchor") == F.col("hot_anchor"), "left").withColumn("hot", F.col("hot_anchor").isNotNull())
    covered = found.where(F.col("kind") == COVERED).select(
        "doc_id", "doc_key", F.col("lo").alias("start"), (F.col("lo") + F.col("strings") - 1 + LENGTH).alias("stop")
    )
    every = covered.unionByName(resolved(with_bytes(docs, needs)))
    return every.groupBy(F.col("doc_id").alias("__llm_id"), F.col("doc_key").alias("__llm_key")).agg(F.collect_set(F.struct("start", "stop")).alias("__llm_spans"))


def with_spans(docs: DataFrame, *keep: str) -> DataFrame:
    rows = docs.select(*keep, doc_key().alias("__llm_own_key"))
    return rows.join(spans(docs), (F.col("__llm_own_key") == F.col("__llm_key")) & F.col("doc_id").eqNullSafe(F.col("__llm_id")), "left")


def remove(raw: bytes, cut: list[tuple[int, int]]) -> bytes:
    out, last = [], 0
    for a, b in cut:
        out.append(raw[last:a])
        last = b
    return b"".join([*out, raw[last:]])


def deduplicated(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the bytes that stay of every document."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for start in range(0, part.num_rows, 256):
                piece = part.slice(start, 256)
                out = []
                for text, found in zip(piece.column("text").to_pylist(), piece.column("spans").to_pylist(), strict=True):
                    raw = (text or "").encode("utf-8", "surrogatepass")
                    cut = joined([(s["start"], s["stop"]) for s in found or ()])
                    out.append((len(raw), sum(b - a for a, b in cut), len(cut), remove(raw, cut)))
                n, removed, runs, kept = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(kept, pa.binary())],
                    names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
                )

    rows = with_spans(docs, "doc_id", "text").select("doc_id", "text", F.col("__llm_spans").alias("spans"))
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def whole_characters(raw: bytes, cut: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans without characters that are covered in part only."""
    out = []
    for a, b in cut:
        while a < b and raw[a] & 0xC0 == 0x80:
            a += 1
        while b > a and b < len(raw) and raw[b] & 0xC0 == 0x80:
            b -= 1
        if a < b:
            out.append((a, b))
    return out


def without_repeats(docs: DataFrame) -> DataFrame:
    """All columns, with repeated strings cut out of the texts (whole characters only) and n_chars counted anew."""
    names = docs.columns
    rows = with_spans(docs, *names)
    schema = docs.schema
    at, chars = names.index("text"), names.index("n_chars") if "n_chars" in names else -1

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for start in range(0, part.num_rows, 256):
                piece = part.slice(start, 256)
                out: list[str | None] = []
                for text, found in zip(piece.column(at).to_pylist(), piece.column(len(names)).to_pylist(), strict=True):
                    if text is None or not found:
                        out.append(text)
                        continue
                    raw = text.encode("utf-8", "surrogatepass")
                    cut = whole_characters(raw, joined([(s["start"], s["stop"]) for s in found]))
                    out.append(remove(raw, cut).decode("utf-8", "surrogatepass"))
                columns = list(piece.columns[: len(names)])
                columns[at] = pa.array(out, pa.string())
                if chars >= 0:
                    columns[chars] = pa.array([None if t is None else len(t) for t in out], columns[chars].type)
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.select(*names, "__llm_spans").mapInArrow(run, schema)
