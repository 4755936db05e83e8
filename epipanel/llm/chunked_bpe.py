"""BPE encoding by content-defined chunks that documents share, and exact decoding.

A rolling hash over ``WINDOW`` code points cuts texts where its low bits are zero, so equal passages are
cut alike wherever they stand. Chunks met again within a task are counted; the most used ``CODEBOOK`` of
all tasks are encoded once and sent to every task (at most ``CODEBOOK`` chunks of ``LONGEST`` code points,
whatever the input). A task encodes each further chunk once while its cache holds it. The book and the
cache save work only; every text gets its ids either way.

A chunk's border may stand inside a word, so joins are repaired: the word across the border and a whole
word on each side are encoded again, and the window grows until its first and last words get the ids
that the chunks gave them.

Cases: null text is empty and has no ids; equal rows give equal rows; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epipanel.llm.common import texts
from epipanel.llm.wordcodec import COARSE, WordCodec, codec

WINDOW = 32
MEAN, SHORTEST, LONGEST = 1024, 256, 4096
CODEBOOK = 2048
CACHE = 4096
MIX = np.uint32(0x9E3779B1)


def cut_points(text: str) -> list[int]:
    """Ends of the chunks; the last one is the text's length."""
    n = len(text)
    if n <= SHORTEST:
        return [n] if n else []
    h = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32) * MIX
    h ^= h >> np.uint32(15)
    power, width = int(MIX), 1
    while width < WINDOW:  # h[i] covers ``width`` code points from i on
        h = h[:-width] * np.uint32(power) + h[width:] if len(h) > width else h[:0]
        power, width = power * power & 0xFFFFFFFF, width * 2
    h ^= h >> np.uint32(16)
    marks = (np.flatnonzero((h & np.uint32(MEAN - 1)) == 0) + WINDOW).tolist()
    ends, last = [], 0
    for mark in [*marks, n]:
        while mark - last > LONGEST:
            last += LONGEST
            ends.append(last)
        if mark - last >= SHORTEST and mark < n:
            ends.append(mark)
            last = mark
    if not ends or ends[-1] < n:
        ends.append(n)
    return ends


def chunks(text: str) -> list[str]:
    ends = cut_points(text)
    return [text[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def digest(chunk: str) -> bytes:
    return xxhash.xxh3_128_digest(chunk.encode("utf-8", "surrogatepass"))


def shared_chunks(docs: DataFrame, size: int = CODEBOOK) -> DataFrame:
    """The ``size`` chunks used most among those that some task met twice: digest, chunk, uses."""

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uses: Counter[bytes] = Counter()
        again: dict[bytes, str] = {}
        for part in parts:
            for text in part.column("text"):
                for chunk in chunks(text.as_py()):
                    key = digest(chunk)
                    uses[key] += 1
                    if uses[key] == 2:
                        again[key] = chunk
        top = sorted(again, key=lambda k: (-uses[k], k))
        for start in range(0, len(top), 1024):
            keys = top[start : start + 1024]
            yield pa.RecordBatch.from_pydict(
                {"digest": pa.array(keys, pa.binary()), "chunk": [again[k] for k in keys], "uses": pa.array([uses[k] for k in keys], pa.int64())}
            )

    found = texts(docs).select("text").mapInArrow(count, "digest binary, chunk string, uses long")
    return found.groupBy("digest").agg(F.first("chunk").alias("chunk"), F.sum("uses").alias("uses")).orderBy(F.desc("uses"), "digest").limit(size)


def whole(words: list[str], coder: WordCodec) -> list[int]:
    return coder.tokenizer.encode(" ".join(words), add_special_tokens=False).ids


class Chunk:
    """Words at the edges, kept as text, and the ids of all between."""

    __slots__ = ("body", "closed_left", "closed_right", "first", "inner", "last", "one")

    def __init__(self, text: str, coder: WordCodec):
        spans = [m.span() for m in COARSE.finditer(text)] if len(text) < 64 else None
        self.closed_left, self.closed_right = text[:1].isspace() and not COARSE.match(text), bool(text) and not COARSE.match(text[-1])
        if spans is None:
            first = COARSE.search(text)
            if first is None:
                self.one, self.first, self.last, self.inner, self.body = True, "", "", [], b""
                return
            stop = len(text.rstrip(" \t\n\r\x0b\x0c"))
            start = max(text.rfind(c, 0, stop) for c in " \t\n\r\x0b\x0c") + 1
            edge = [first.span(), (start, stop)] if start > first.start() else [first.span()]
        else:
            edge = [spans[0], spans[-1]] if len(spans) > 1 else spans
        self.one = len(edge) < 2
        self.first = text[slice(*edge[0])] if edge else ""
        self.last = text[slice(*edge[1])] if len(edge) > 1 else ""
        middle = text[edge[0][1] : edge[1][0]] if len(edge) > 1 else ""
        self.body = coder.encode(middle)
        self.inner = COARSE.findall(middle[:200])[:1] + COARSE.findall(middle[-200:])[-1:] if middle else []


def encode(text: str, coder: WordCodec, look: dict[bytes, Chunk], cache: dict[bytes, Chunk]) -> bytes:
    """ids of the whole text: the chunks' own, with every join repaired."""
    out: list[bytes] = []
    word, before = "", ""  # the word still open at the border, and the whole word in front of it
    for part in chunks(text):
        key = digest(part)
        chunk = look.get(key) or cache.get(key)
        if chunk is None:
            if len(cache) >= CACHE:
                cache.clear()
            chunk = cache[key] = Chunk(part, coder)
        if chunk.closed_left and word:
            out.append(coder.encode(word))
            word, before = "", word
        if chunk.one:
            joined = word + chunk.first
            if chunk.closed_right and joined:
                out.append(repaired(before, joined, "", coder) if word else coder.encode(joined))
                word, before = "", joined
            else:
                word = joined
            continue
        after = chunk.inner[0] if chunk.inner else ""
        out.append(repaired(before, word + chunk.first, after, coder) if word else coder.encode(chunk.first))
        out.append(chunk.body)
        before = chunk.inner[-1] if chunk.inner else chunk.first
        if chunk.closed_right:
            out.append(coder.encode(chunk.last))
            word, before = "", chunk.last
        else:
            word = chunk.last
    if word:
        out.append(coder.encode(word))
    return b"".join(out)


def repaired(before: str, joined: str, after: str, coder: WordCodec) -> bytes:
    """ids of the word across a border, encoded with its neighbours until both agree with their own ids."""
    ids = whole([w for w in (before, joined, after) if w], coder)
    left = np.frombuffer(coder.encode(before), "<u4").tolist()
    right = np.frombuffer(coder.encode(after), "<u4").tolist()
    end = len(ids) - len(right)
    if ids[: len(left)] == left and ids[end:] == right and end >= len(left):
        return np.array(ids[len(left) : end], "<u4").tobytes()
    return np.array(whole([joined], coder), "<u4").tobytes()  # neighbours apart: white space is a hard border


def encode_decode(docs: DataFrame, tokenizer_path: str, codebook: int = CODEBOOK) -> DataFrame:
    """doc_id, n_tokens, ids (unsigned 32-bit little-endian) and the text decoded from these ids."""
    shared = [row["chunk"] for row in shared_chunks(docs, codebook).select("chunk").toLocalIterator()] if codebook else []
    sent = docs.sparkSession.sparkContext.broadcast(shared)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(tokenizer_path)
        coder.encode_many(sent.value)
        look = {digest(c): Chunk(c, coder) for c in sent.value}
        cache: dict[bytes, Chunk] = {}
        for part in parts:
            for start in range(0, part.num_rows, 256):
                cut = part.slice(start, 256)
                ids = [encode(t, coder, look, cache) for t in cut.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        cut.column("doc_id"),
                        pa.array([len(x) // 4 for x in ids], pa.int64()),
                        pa.array(ids, pa.binary()),
                        pa.array([coder.decode(x) for x in ids], pa.binary()).cast(pa.string()),
                    ],
                    names=["doc_id", "n_tokens", "ids", "decoded"],
                )

    return texts(docs).mapInArrow(run, "doc_id long, n_tokens long, ids binary, decoded string")
