"""Benchmark decontamination by winnowing, on built-in functions only.

Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased. A window is ``SPAN`` words in
a row of an item; an item of fewer words, but not none, is one window. Every text is cut into its hashes of
``GRAM`` words; of each span of window length the least hash, its print, is kept. Two texts that share a
whole window keep the same print for it, so joining the prints of documents and items meets every shared
window; a met window is then compared word by word. Shorter windows are handled the same way with a hash of
their own number of words, for the few lengths under ``SPAN`` that items have.

Texts are read once. A bitmap of the items' prints (``BITS_EACH`` bits a print, two probes, at most 2^22 bits)
goes with the plan, and a document's windows leave its row only where it does not deny their print: few of them
unless the items are more than the bitmap can tell apart, and then more rows meet the join, which decides.
Documents are known by the MD5 of their text, so copies are judged once and doc_ids may repeat or be null.
Hot windows sit on the documents' side of plain joins, which Spark splits; the items' side has one row a
window or text.

Cases: null or empty text has no words; a null item_id reads as an empty string; items of equal texts count
each by its id, equal ids once; repeated documents give a row each; an empty table gives no rows or no hits;
columns other than doc_id, item_id and text are left aside.
"""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epipanel.functions.arrays import bound
from epipanel.llm.common import stored

SPAN = 10
GRAM = 5
BITS_EACH = 128
MOST_BITS = 22
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BETWEEN = "".join(chr(c) for c in range(128) if not chr(c).isalnum())

CANDIDATES = "array<struct<length:int,print:bigint,start:int,window:string>>"


def words_of(text: Column) -> Column:
    spaced = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase + BETWEEN, string.ascii_lowercase + " " * len(BETWEEN))
    return F.array_remove(F.split(spaced, " "), "")


def joined(values: Column, count: int, combine: Callable[[Column, Column], Column]) -> Column:
    """At each place ``combine`` over it and the ``count`` - 1 behind, by doubling; what runs over the end is no use."""
    span = 1
    while span < count:
        by = min(span, count - span)
        values = shifted(values, by, combine)
        span += by
    return values


def shifted(values: Column, by: int, combine: Callable[[Column, Column], Column]) -> Column:
    return bound(values, lambda v: F.zip_with(v, F.slice(v, F.lit(1 + by), F.size(v)), combine))


def window_prints(codes: Column, length: int) -> Column:
    """The print of each window of ``length`` words, from the words' hashes."""
    gram = min(GRAM, length)
    seeded = F.transform(codes, lambda c: F.xxhash64(F.lit(length), c)) if length < SPAN else codes
    grams = joined(seeded, gram, lambda a, b: F.xxhash64(a, b))
    least = joined(grams, length - gram + 1, lambda a, b: F.least(a, b))
    return bound(least, lambda m: F.slice(m, F.lit(1), F.greatest(F.size(m) - (length - 1), F.lit(0))))


def coded(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def window_text(words: Column, length: Column, start: Column) -> Column:
    return F.array_join(F.slice(words, start + 1, length), " ")


def item_windows(items: DataFrame, span: int) -> DataFrame:
    """(class, length, window, print): each distinct text's windows with their prints."""
    classes = items.select(F.coalesce("text", F.lit("")).alias("text")).distinct()
    cut = classes.select(F.md5("text").alias("class"), words_of(F.col("text")).alias("words")).where(F.size("words") > 0)
    cut = cut.withColumn("length", F.least(F.size("words"), F.lit(span)))

    def of_length(n: int) -> Column:
        return F.when(F.col("length") == n, window_prints(coded(F.col("words")), n))

    prints = F.coalesce(*map(of_length, range(1, span + 1)))
    pairs = F.transform(prints, lambda m, at: F.struct(m.alias("print"), window_text(F.col("words"), F.col("length"), at).alias("window")))
    return cut.select("class", "length", F.explode(pairs).alias("w")).select("class", "length", "w.window", "w.print")


def places(print_: Column, bits: int) -> tuple[Column, Column]:
    mask = F.lit((1 << bits) - 1)
    return print_.bitwiseAND(mask), F.shiftrightunsigned(print_, 32).bitwiseAND(mask)


def bitmap(prints: DataFrame) -> tuple[Column, int]:
    """(array of longs as one literal, number of bits): at most 2^16 longs, whatever the items."""
    bits = min(MOST_BITS, max(10, (prints.count() * BITS_EACH).bit_length()))
    place = F.explode(F.array(*places(F.col("print"), bits)))
    rows = (
        prints.select(place.alias("p")).groupBy(F.shiftright("p", 6).alias("at"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("set")).collect()
    )
    longs = ["0"] * (1 << (bits - 6))
    for r in rows:
        longs[r["at"]] = str(r["set"])
    return F.split(F.lit(",".join(longs)), ",").cast("array<bigint>"), bits


def candidates(words: Column, length: int, held: Column, bits: int) -> Column:
    """(length, print, start, window) of the windows whose print the bitmap does not deny."""

    def probed(print_: Column) -> Column:
        def one(place: Column) -> Column:
            bit = F.call_function("shiftright", F.get(held, F.shiftright(place, 6).cast("int")), place.bitwiseAND(F.lit(63)).cast("int"))
            return bit.bitwiseAND(F.lit(1)) == 1

        first, second = places(print_, bits)
        return one(first) & one(second)

    def written(prints: Column, some: Column) -> Column:
        every = F.transform(prints, lambda m, at: F.struct(m.alias("print"), at.alias("start")))
        return F.transform(
            F.filter(every, lambda w: F.array_contains(some, w["print"])),
            lambda w: F.struct(
                F.lit(length).alias("length"), w["print"].alias("print"), w["start"].alias("start"),
                window_text(words, F.lit(length), w["start"]).alias("window"),
            ),
        )

    def met(prints: Column) -> Column:
        some = F.filter(F.array_distinct(prints), probed)
        return bound(some, lambda s: F.when(F.size(s) > 0, written(prints, s)).otherwise(F.array().cast(CANDIDATES)))

    return bound(window_prints(coded(words), length), met)


def read_once(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """(doc_id, key, n_words, candidates) of every document."""
    lengths = sorted(r[0] for r in windows.select("length").distinct().collect())
    none = F.array().cast(CANDIDATES)
    if lengths:
        held, bits = bitmap(windows.select("print").distinct())
        found = F.concat(*(F.when(F.size("words") >= n, candidates(F.col("words"), n, held, bits)).otherwise(none) for n in lengths))
    else:
        found = none
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.md5(text).alias("key"), words_of(F.col("text")).alias("words"))
    return rows.select("doc_id", "key", F.size("words").cast("long").alias("n_words"), found.alias("candidates"))


def covered(spans: Column) -> Column:
    """Number of places inside the union of (start, end) structs sorted by start."""
    none = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("total"))
    fold = F.aggregate(
        spans,
        none,
        lambda had, s: F.struct(
            F.greatest(had["end"], s["end"]).alias("end"),
            (had["total"] + F.greatest(s["end"] - F.greatest(had["end"], s["start"]), F.lit(0))).alias("total"),
        ),
    )
    return fold["total"]


def decontaminate(docs: DataFrame, items: DataFrame, span: int = SPAN) -> DataFrame:
    """doc_id, n_words, hits (start and end of each hit window, in words), n_hit, items (ids as sorted strings)."""
    windows = stored(item_windows(items, span))
    rows = stored(read_once(docs, windows))
    met = rows.where(F.size("candidates") > 0).select("key", F.explode("candidates").alias("c")).select("key", "c.*")
    hits = stored(
        met.join(windows.select("length", "print", "window").distinct(), ["length", "print", "window"], "left_semi")
        .select("key", "length", "start", "window").distinct()
    )
    where = hits.groupBy("key").agg(F.sort_array(F.collect_set(F.struct("start", (F.col("start") + F.col("length")).alias("end")))).alias("hits"))
    ids = items.select(
        F.md5(F.coalesce("text", F.lit(""))).alias("class"), F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item")
    ).distinct()
    named = (
        hits.select("key", "length", "window").distinct()
        .join(windows.select("class", "length", "window").distinct(), ["length", "window"])
        .select("key", "class").distinct()
        .join(ids, "class").select("key", "item").distinct()
        .groupBy("key").agg(F.sort_array(F.collect_list("item")).alias("items"))
    )
    judged = stored(where.join(named, "key").select("key", "hits", covered(F.col("hits")).alias("n_hit"), "items"))
    return rows.select("doc_id", "key", "n_words").join(judged, "key", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("hits", F.array().cast("array<struct<start:int,end:int>>")).alias("hits"),
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


#: The digest of ``op11_winnowed_benchmark`` on plain SQL, by comparing every window.
SQL = rf"""
with d as (
  select row_number() over () as k, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '{WORD}') as w
  from documents),
i as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '{WORD}') as w
  from benchmark),
iw as (
  select distinct item_id, n, array_to_string(list_slice(w, p, p + n - 1), ' ') as x
  from (select item_id, w, least(len(w), {SPAN}) as n, unnest(range(1, len(w) - least(len(w), {SPAN}) + 2)) as p from i where len(w) > 0)),
lens as (select distinct n from iw),
dw as (
  select k, n, p, array_to_string(list_slice(w, p, p + n - 1), ' ') as x
  from (select k, w, n, unnest(range(1, len(w) - n + 2)) as p from d, lens where len(w) >= n)),
hit as (select distinct k, dw.n, dw.p as q, item_id from dw join iw on iw.n = dw.n and iw.x = dw.x),
places as (select k, count(distinct p) as n_hit from (select k, unnest(range(q, q + n)) as p from hit) group by k),
named as (
  select k, count(*) as n_items, string_agg(s, ',' order by s) as l
  from (select distinct k, coalesce(item_id::varchar, '') as s from hit) group by k)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(l, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join places using (k) left join named using (k)
"""
