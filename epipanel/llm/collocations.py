"""Phrase collocation mining with counting quotient filters.

A word's id is its 64-bit hash, seeded by the language and checked to be different for all words of a
language (else another seed is taken). The ids of an n-gram are packed side by side and permuted by a Feistel
network, which can be undone. The top ``q`` bits of the permuted value are the quotient, everything else the
remainder. A filter keeps its entries in that order: the lengths of the quotients' runs in unary bits, the
remainders in full, the counts in a byte each where they fit. Nothing is lost, so counts are exact, and the
n-gram is had back by undoing the permutation.

Each task counts its share of the texts, ``TOKENS`` words at a time, into filters and sends them cut by the
quotients' top bits; filters of one cut are merged as sorted arrays, their counts summed. The permutation
deals n-grams out evenly, and one that is everywhere is one entry of each filter.

Three passes over the texts count words, pairs and triples. A pair can only be frequent if both words are,
a triple if both its pairs are, so each pass leaves out what a bitmap of the frequent shorter ones denies.
The bitmap is the one thing every task gets: 16 bits an entry, 2^26 bits (8 MB) at the most. Beyond that
size it lets more through, and the counts stay exact.

Cases: a null text is empty, a null language ``und``; equal documents count each; empty tables give no rows;
a text of any length is read in pieces of ``SEGMENT`` bytes that overlap by n - 1 words; columns other than
text and lang are left aside. Counts up to 10^16 are scored exactly.
"""

from __future__ import annotations

import string
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from epipanel.llm.common import partitions, stored

LEAST = 10
TOP = 2000
TOKENS = 1 << 21
VOCABULARY = 1 << 20
SEGMENT = 1 << 21
MOST_BITS = 26
BITS_EACH = 16
U = np.uint64
M1, M2, ODD = U(0xFF51AFD7ED558CCD), U(0xC4CEB9FE1A85EC53), U(0x9E3779B97F4A7C15)

#: A-Z lower-cased, what ends a piece as a line feed, a tab as a space.
BYTES = bytes(b + 32 if 65 <= b <= 90 else 10 if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b for b in range(256))


# permutation


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(33))) * M1
    x = (x ^ (x >> U(29))) * M2
    return x ^ (x >> U(32))


def turned(parts: list[np.ndarray], rounds) -> list[np.ndarray]:
    out, n = list(parts), len(parts)
    for r in rounds:
        rest = U(0)
        for k in range(1, n):
            rest = rest * ODD + out[(r + k) % n]
        out[r % n] = out[r % n] ^ mixed(rest + U(r + 1) * M2)
    return out


def permuted(ids: list[np.ndarray]) -> list[np.ndarray]:
    """Packed ids as one pseudo-random value of as many 64-bit parts; ``restored`` undoes it."""
    with np.errstate(over="ignore"):
        return turned(ids, range(2 * len(ids)))


def restored(parts: list[np.ndarray]) -> list[np.ndarray]:
    with np.errstate(over="ignore"):
        return turned(parts, range(2 * len(parts) - 1, -1, -1))


# filters


def merged(parts: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Entries in order, equal ones as one."""
    order = np.argsort(parts[0], kind="stable")
    first = parts[0][order]
    if len(first) > 1 and (first[1:] == first[:-1]).any():
        order = np.lexsort(parts[::-1])
    parts, counts = [p[order] for p in parts], counts[order]
    if not len(order):
        return parts, counts
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([p[1:] != p[:-1] for p in parts])
    at = np.flatnonzero(new)
    return [p[at] for p in parts], np.add.reduceat(counts, at)


def packed(parts: list[np.ndarray], counts: np.ndarray, q: int, cut: int, bits: int) -> bytes:
    """The filter of sorted entries whose top ``bits`` bits are ``cut``; ``q`` (16 or 24) is the quotient's width."""
    slots = 1 << (q - bits)
    quotient = (parts[0] >> U(64 - q)).astype(np.int64) - (cut << (q - bits))
    ends = np.zeros(slots + len(quotient), bool)
    ends[np.cumsum(np.bincount(quotient, minlength=slots) + 1) - 1] = True
    low = parts[0].astype(">u8").view(np.uint8).reshape(-1, 8)[:, q // 8 :]
    small = np.minimum(counts, 255).astype(np.uint8)
    return b"".join(
        [len(counts).to_bytes(8, "little"), np.packbits(ends).tobytes(), low.tobytes(), *(p.tobytes() for p in parts[1:]), small.tobytes(), counts[counts >= 255].astype("<i8").tobytes()]
    )


def unpacked(data: bytes, n: int, q: int, cut: int, bits: int) -> tuple[list[np.ndarray], np.ndarray]:
    slots, size = 1 << (q - bits), int.from_bytes(data[:8], "little")
    at = 8

    def take(count: int, kind) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(data, kind, count, at)
        at += out.nbytes
        return out

    ends = np.unpackbits(take((slots + size + 7) // 8, np.uint8), count=slots + size)
    quotient = np.cumsum(ends)[ends == 0] + (cut << (q - bits))
    low = np.zeros((size, 8), np.uint8)
    low[:, q // 8 :] = take(size * (8 - q // 8), np.uint8).reshape(size, -1)
    parts = [low.view(">u8").reshape(-1).astype(np.uint64) | (quotient.astype(np.uint64) << U(64 - q))]
    parts += [take(size, np.uint64) for _ in range(n - 1)]
    counts = take(size, np.uint8).astype(np.int64)
    counts[counts == 255] = take(int((counts == 255).sum()), "<i8")
    return parts, counts


class Bitmap:
    """Says no to most packed ids that are not among the frequent ones, and never to one that is."""

    def __init__(self, words: np.ndarray, bits: int):
        self.words, self.bits = words, bits

    def holds(self, value: np.ndarray) -> np.ndarray:
        at = value & U((1 << self.bits) - 1)
        return (self.words[(at >> U(6)).astype(np.int64)] >> (at & U(63))) & U(1) == 1


def bitmap(frequent: DataFrame, slot: str) -> Bitmap:
    """Of the values in ``slot`` (longs); at most 2^20 rows of 64 bits come to the driver."""
    n = frequent.count()
    bits = min(MOST_BITS, max(10, (max(1, n) * BITS_EACH - 1).bit_length()))
    place = F.col(slot).bitwiseAND(F.lit((1 << bits) - 1))
    rows = (
        frequent.groupBy(F.shiftright(place, 6).alias("at"))
        .agg(F.bit_or(F.expr(f"shiftleft(1L, cast({slot} & 63 as int))")).alias("set")).toPandas()
    )
    words = np.zeros(1 << (bits - 6), np.int64)
    words[rows["at"].to_numpy(np.int64)] = rows["set"].to_numpy(np.int64)
    return Bitmap(words.view(np.uint64), bits)


# counting


class Shard:
    """The word n-grams of some texts, as local ids until they are sent."""

    def __init__(self, n: int):
        self.n = n
        self.clear()

    def clear(self) -> None:
        self.ids = defaultdict(lambda: len(self.ids) - 1)
        self.ids[b"\n"] = 0
        self.ids[b""] = -1
        self.tokens, self.size = defaultdict(list), 0

    def add(self, lang: str, text: str) -> Iterator[None]:
        """Takes a text in; yields whenever the shard should be sent."""
        data = text.encode().translate(BYTES)
        at, carry = 0, []
        while at < len(data):
            end = at + SEGMENT
            if end < len(data):
                end = max(data.rfind(b"\n", at, end), data.rfind(b" ", at, end), at) + 1
                end = end if end > at + 1 else min([x for x in (data.find(b"\n", at + 1), data.find(b" ", at + 1)) if x >= 0], default=len(data))
            words = data[at:end].replace(b"\n", b" \n ").split(b" ")
            found = np.fromiter(map(self.ids.__getitem__, carry + words), np.int32, len(carry) + len(words))
            if end < len(data) and self.n > 1:
                carry = [w for w in carry + words if w][1 - self.n :]
            found = found[found >= 0]
            self.tokens[lang] += [found, np.zeros(1, np.int32)]
            self.size += len(found) + 1
            at = end
            if self.size >= TOKENS or len(self.ids) >= VOCABULARY:
                yield

    def words(self) -> list[bytes]:
        return [w for w in self.ids if w not in (b"", b"\n")]


def grams(shard: Shard, seed: int, allowed: Bitmap | None) -> Iterator[tuple[str, list[np.ndarray], np.ndarray]]:
    """(lang, permuted parts, counts) of a shard's n-grams whose shorter parts may be frequent, in order."""
    words, n = shard.words(), shard.n
    for lang, found in shard.tokens.items():
        ids = np.zeros(len(words) + 1, np.uint64)
        local = np.concatenate(found)
        used = np.unique(local)
        start = lang_seed(lang, seed)
        used = used[used > 0]
        ids[used] = np.array([xxhash.xxh64_intdigest(words[k - 1], start) for k in used.tolist()], np.uint64)
        real = local > 0
        if n == 2:
            real &= allowed.holds(ids)[local]
            good = real[1:] & real[:-1]
        else:
            pair = real[1:] & real[:-1]
            at = np.flatnonzero(pair)
            pair[at] = allowed.holds(permuted([ids[local[at]], ids[local[at + 1]]])[0])
            good = pair[1:] & pair[:-1]
        at, key = np.flatnonzero(good), 0
        for k in range(n):
            key = (key << 21) | local[at + k].astype(np.int64)
        key, counts = np.unique(key, return_counts=True)
        if len(key):
            parts = [ids[(key >> (21 * (n - 1 - k))) & ((1 << 21) - 1)] for k in range(n)]
            yield lang, *merged(permuted(parts), counts.astype(np.int64))


def lang_seed(lang: str, seed: int) -> int:
    return xxhash.xxh64_intdigest(lang.encode(), seed)


def shards(parts: Iterator[pa.RecordBatch], n: int) -> Iterator[Shard]:
    shard = Shard(n)
    for part in parts:
        for at in range(0, part.num_rows, 256):
            cut = part.slice(at, 256)
            for lang, text in zip(cut.column(0).to_pylist(), cut.column(1).to_pylist(), strict=True):
                for _ in shard.add(lang, text):
                    yield shard
                    shard.clear()
    yield shard


WORD_ROWS = pa.schema([("lang", pa.string()), ("word", pa.string()), ("id", pa.int64()), ("f", pa.int64())])


def vocabulary(spoken: DataFrame, seed: int) -> DataFrame:
    """lang, word, id, f of all words."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in shards(parts, 1):
            words = shard.words()
            for lang, found in shard.tokens.items():
                counts = np.bincount(np.concatenate(found), minlength=len(words) + 1)
                start = lang_seed(lang, seed)
                used = (np.flatnonzero(counts[1:])).tolist()
                for at in range(0, len(used), 1 << 16):
                    some = [words[k] for k in used[at : at + (1 << 16)]]
                    ids = np.array([xxhash.xxh64_intdigest(w, start) for w in some], np.uint64).view(np.int64)
                    f = counts[np.array(used[at : at + (1 << 16)], np.int64) + 1]
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some)), pa.array([w.decode() for w in some]), pa.array(ids), pa.array(f)], schema=WORD_ROWS)

    return spoken.mapInArrow(run, "lang string, word string, id long, f long").groupBy("lang", "word", "id").agg(F.sum("f").alias("f"))


def counted(spoken: DataFrame, n: int, seed: int, allowed: Bitmap, tokens: int, least: int) -> DataFrame:
    """lang, id1 .. id n, f, slot of the n-grams found ``least`` times; slot is where a bitmap looks for them."""
    spark = spoken.sparkSession
    bits = max(4, (max(1, tokens) >> 22).bit_length())
    q = 16 if bits <= 16 else 24
    shared = spark.sparkContext.broadcast(allowed)

    def send(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in shards(parts, n):
            for lang, entries, counts in grams(shard, seed, shared.value):
                cuts = (entries[0] >> U(64 - bits)).astype(np.int64)
                edges = np.append(np.flatnonzero(np.r_[True, cuts[1:] != cuts[:-1]]), len(cuts))
                for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                    cut = int(cuts[a])
                    data = packed([p[a:b] for p in entries], counts[a:b], q, cut, bits)
                    yield pa.RecordBatch.from_pydict({"lang": [lang], "cut": pa.array([cut], pa.int64()), "filter": pa.array([data], pa.binary())})

    def merge(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, size = None, [], 0

        def settled() -> tuple[list[np.ndarray], np.ndarray]:
            return merged([np.concatenate([h[0][k] for h in held]) for k in range(n)], np.concatenate([h[1] for h in held]))

        def out() -> Iterator[pa.RecordBatch]:
            entries, counts = settled()
            often = counts >= least
            entries, counts = [e[often] for e in entries], counts[often]
            for a in range(0, len(counts), 1 << 16):
                some = [e[a : a + (1 << 16)] for e in entries]
                ids = [i.view(np.int64) for i in restored(some)]
                columns = {"lang": pa.array([key[0]] * len(some[0]), pa.string())}
                columns |= {f"id{k + 1}": pa.array(ids[k]) for k in range(n)}
                yield pa.RecordBatch.from_pydict(columns | {"f": pa.array(counts[a : a + (1 << 16)]), "slot": pa.array(some[0].view(np.int64))})

        for part in parts:
            for row in range(part.num_rows):
                now = part.column(0)[row].as_py(), part.column(1)[row].as_py()
                if key is not None and now != key:
                    yield from out()
                    held, size = [], 0
                key = now
                held.append(unpacked(part.column(2)[row].as_py(), n, q, key[1], bits))
                size += len(held[-1][1])
                if len(held) > 1 and size > 2 * len(held[0][1]) + (1 << 18):  # merged whenever it has doubled
                    held = [settled()]
                    size = len(held[0][1])
        if key is not None:
            yield from out()

    filters = spoken.mapInArrow(send, "lang string, cut long, filter binary").repartition(partitions(spark), "lang", "cut")
    names = "".join(f"id{k + 1} long, " for k in range(n))
    return filters.sortWithinPartitions("lang", "cut").mapInArrow(merge, f"lang string, {names}f long, slot long")


def seeded_vocabulary(spoken: DataFrame) -> tuple[DataFrame, int]:
    """All words and a seed under which no two words of a language have one id."""
    seed = 0
    while True:
        words = stored(vocabulary(spoken, seed))
        if words.groupBy("lang", "id").count().where("count > 1").isEmpty():
            return words, seed
        seed += 1


# scores


def exact_score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)) on 38 digits."""
    wide = a.cast("decimal(16,0)")
    return F.call_function("div", wide * wide * F.lit(1_000_000).cast("decimal(7,0)"), left.cast("decimal(19,0)") * right.cast("decimal(19,0)"))


def cut_scores(a: Column, cuts: Column) -> Column:
    """(score, k, l, r) of each cut: the least of them has the lowest score, then the fewest words in its first part."""
    return F.transform(
        cuts,
        lambda c, k: F.struct(exact_score(a, c["l"], c["r"]).alias("score"), k.alias("k"), c["l"].alias("l"), c["r"].alias("r")),
    )


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first ``top`` phrases of two and three words."""
    spark = docs.sparkSession
    spoken = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    words, seed = seeded_vocabulary(spoken)
    sizes = words.groupBy("lang").agg(F.sum("f").alias("n"))
    tokens = words.agg(F.sum("f")).first()[0] or 0
    often = words.where(F.col("f") >= least)
    pairs = stored(counted(spoken, 2, seed, bitmap(often, "id"), tokens, least))
    triples = stored(counted(spoken, 3, seed, bitmap(pairs, "slot"), tokens, least))

    def word(k: int) -> DataFrame:
        return often.select("lang", F.col("id").alias(f"id{k}"), F.col("word").alias(f"w{k}"), F.col("f").alias(f"f{k}"))

    def pair(a: int, b: int) -> DataFrame:
        return pairs.select("lang", F.col("id1").alias(f"id{a}"), F.col("id2").alias(f"id{b}"), F.col("f").alias(f"f{a}{b}"))

    inside = (
        triples.select("lang", "id1", "id2", "f").unionByName(triples.select("lang", F.col("id2").alias("id1"), F.col("id3").alias("id2"), "f"))
        .groupBy("lang", "id1", "id2").agg(F.max("f").alias("longer"))
    )
    twos = (
        pairs.join(inside, ["lang", "id1", "id2"], "left").where(100 * F.coalesce("longer", F.lit(0)) < 50 * F.col("f"))
        .join(word(1), ["lang", "id1"]).join(word(2), ["lang", "id2"])
        .select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), F.col("f").alias("a"), F.array(F.struct(F.col("f1").alias("l"), F.col("f2").alias("r"))).alias("cuts"))
    )
    threes = (
        triples.join(word(1), ["lang", "id1"]).join(word(2), ["lang", "id2"]).join(word(3), ["lang", "id3"])
        .join(pair(1, 2), ["lang", "id1", "id2"]).join(pair(2, 3), ["lang", "id2", "id3"])
        .select(
            "lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), F.col("f").alias("a"),
            F.array(F.struct(F.col("f1").alias("l"), F.col("f23").alias("r")), F.struct(F.col("f12").alias("l"), F.col("f3").alias("r"))).alias("cuts"),
        )
    )
    scored = twos.unionByName(threes).select("lang", "phrase", "a", F.array_min(cut_scores(F.col("a"), F.col("cuts"))).alias("cut")).select(
        "lang", "phrase", "a", "cut.l", "cut.r", "cut.score"
    )
    first = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    dealt = scored.withColumn("lot", F.pmod(F.xxhash64("phrase"), F.lit(partitions(spark))))
    near = dealt.withColumn("place", F.row_number().over(Window.partitionBy("lang", "lot").orderBy(*first))).where(F.col("place") <= top)
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*first))).where(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


#: The same rows on plain SQL.
SQL = rf"""
with d as (
  select coalesce(lang, 'und') as lang,
    translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}') as t from documents),
pieces as (select lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) as piece from d),
w as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
g as (
  select lang, m, list_slice(w, i, i + m - 1) as ws
  from (select lang, w, m, unnest(range(1, len(w) - m + 2)) as i from w, (values (1), (2), (3)) v(m) where len(w) >= m)),
f as (select lang, m, ws, count(*)::bigint as f from g group by all),
sizes as (select lang, sum(f)::bigint as n from f where m = 1 group by lang),
c as (select * from f where m >= 2 and f >= {LEAST}),
inside as (
  select lang, ws, max(f) as longer
  from (select lang, list_slice(ws, 1, 2) as ws, f from c where m = 3 union all select lang, list_slice(ws, 2, 3), f from c where m = 3)
  group by all),
kept as (select c.* from c left join inside using (lang, ws) where m = 3 or 100 * coalesce(longer, 0) < 50 * c.f),
cut as (select *, unnest(range(1, m)) as k from kept),
scored as (
  select cut.lang, cut.ws, k, cut.f as a, x.f as l, y.f as r, (1000000::hugeint * cut.f * cut.f) // (x.f::hugeint * y.f) as score
  from cut join f x on x.lang = cut.lang and x.ws = list_slice(cut.ws, 1, k)
  join f y on y.lang = cut.lang and y.ws = list_slice(cut.ws, k + 1, cut.m)),
least_cut as (select * from scored qualify row_number() over (partition by lang, ws order by score, k) = 1),
ranked as (
  select *, array_to_string(ws, ' ') as phrase,
    row_number() over (partition by lang order by score desc, a desc, array_to_string(ws, ' ')) as rank from least_cut)
select lang, rank, phrase, a, l, r, n, score::bigint as score from ranked join sizes using (lang) where rank <= {TOP}
"""
