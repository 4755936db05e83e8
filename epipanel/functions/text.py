"""Text normalisation, tokens and n-grams as built-in column expressions."""

from __future__ import annotations

import functools
import unicodedata

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column
from pyspark.sql import functions as F


@functools.cache
def accent_pairs() -> tuple[str, str]:
    """Every BMP letter that NFD splits into one base letter plus marks."""
    accented, plain = [], []
    for code in range(0xC0, 0x10000):
        ch = chr(code)
        base = "".join(
            c for c in unicodedata.normalize("NFD", ch) if unicodedata.category(c) != "Mn"
        )
        if len(base) == 1 and base != ch:
            accented.append(ch)
            plain.append(base)
    return "".join(accented), "".join(plain)


def fold_accents(col) -> Column:
    """Drop combining marks and map composed letters to their base letter."""
    accented, plain = accent_pairs()
    return F.translate(F.regexp_replace(col, r"\p{Mn}+", F.lit("")), accented, plain)


def strip(col) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.regexp_replace(col, r"(?U)^\s+|\s+$", F.lit(""))


def norm_key(col) -> Column:
    """Accent-free, upper-case, trimmed key; null stays null."""
    return strip(F.upper(fold_accents(col)))


def word_count(col) -> Column:
    """Number of white-space separated words."""
    words = F.split(strip(F.coalesce(col, F.lit(""))), r"(?U)\s+")
    return F.size(F.filter(words, lambda w: F.length(w) > 0))


def tokens(col, pattern: str = r"(?U)\w+", stop_words: list[str] | None = None) -> Column:
    """Lower-case tokens of the whole text, minus stop words."""
    found = F.regexp_extract_all(F.lower(col), F.lit(f"({pattern})"), F.lit(1))
    return F.filter(found, lambda w: ~w.isin(stop_words)) if stop_words else found


def joined_runs(items: Column, n: int, sep: str) -> Column:
    """Every run of ``n`` neighbours of an array, joined.

    The array is bound to a lambda variable, so its expression is evaluated once
    per row and not once per run.
    """
    if n == 1:
        return items

    def runs(a: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(a) - n)
        made = F.transform(starts, lambda i: F.concat_ws(sep, *[F.get(a, i + j) for j in range(n)]))
        return F.when(F.size(a) >= n, made).otherwise(F.array().cast("array<string>"))

    return F.get(F.transform(F.array(items), runs), F.lit(0))


def word_ngrams(toks: Column, n: int) -> Column:
    """Array of ``n``-word grams joined by one blank."""
    return joined_runs(toks, n, " ")


def char_ngrams(col, n: int) -> Column:
    """Array of all ``n``-character grams of a text, in linear time."""
    return joined_runs(F.filter(F.split(col, ""), lambda c: F.length(c) > 0), n, "")


def english_stop_words() -> list[str]:
    """Spark's own English list, kept to single alphabetic words."""
    return [w for w in StopWordsRemover.loadDefaultStopWords("english") if w.isalpha()]


def has_capitals(col) -> Column:
    return F.coalesce(F.rlike(col, F.lit("[A-Z]{3,}")), F.lit(False)).cast("int")


def has_exclamations(col) -> Column:
    return F.coalesce(F.rlike(col, F.lit("!{2,}")), F.lit(False)).cast("int")


def has_questions(col) -> Column:
    return F.coalesce(F.rlike(col, F.lit(r"\?{2,}")), F.lit(False)).cast("int")
