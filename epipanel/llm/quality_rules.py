"""Quality rules: a decision list learned by sequential covering and run as ordered Spark conditions.

Statistics of every whole text are computed in one Arrow pass. On a bounded sample of labelled rows
(about ``SAMPLE_ROWS``, the smallest hashes of doc_id) sequential covering grows a conjunction of thresholds
by FOIL gain on two thirds of the rows, prunes it on the other third, removes what it covers and goes
on. The list becomes one ``CASE WHEN`` column, so applying it is a projection.

Cases: null or empty text has no words and fails the base rule; equal rows are judged alike; without
labels, or with one class only, the list is empty and the base rule alone decides; a document with
several labels counts as bad if one of them says so; other columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epipanel.llm.common import batches, hash_sample, stored, texts

SAMPLE_ROWS = 20_000
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = b"#*$%&|<>"
COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_distinct_words", "n_upper", "n_digits", "n_marks", "longest_word",
)
STATS = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in COUNTS)])
FEATURES = (
    "n_words", "word_length", "symbols_per_word", "upper_share", "digit_share", "marks_per_word",
    "dup_line_share", "repeat_share", "distinct_share", "words_per_line", "longest_word",
)


def repeated_positions(words: list[str], width: int = 3) -> int:
    """Positions inside a ``width``-word window that occurs twice or more."""
    if len(words) <= width:
        return 0
    ids = pa.array(words).dictionary_encode().indices.to_numpy().astype(np.int64)
    key = ids[: len(ids) - width + 1]
    for shift in range(1, width):
        wide = key * (int(ids.max()) + 1) + ids[shift : len(ids) - width + 1 + shift]
        key = np.unique(wide, return_inverse=True)[1] if shift + 1 < width and len(words) > 500_000 else wide
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(ids), bool)
    for shift in range(width):
        covered[shift : shift + len(key)] |= twice
    return int(covered.sum())


def text_counts(text: str) -> tuple[int, ...]:
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    by_byte = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), minlength=256)
    digits, upper = by_byte[48:58].sum(), by_byte[65:91].sum()
    marks = by_byte[33:127].sum() - digits - upper - by_byte[97:123].sum()
    return (
        len(words), sum(map(len, words)), int(by_byte[list(SYMBOLS)].sum()), len(lines) - len(set(lines)),
        repeated_positions(words), len(lines), len(set(words)), int(upper), int(digits), int(marks),
        max(map(len, words), default=0),
    )


def text_stats(docs: DataFrame) -> DataFrame:
    """One row of counts per document, from its whole text."""

    def count(part: dict[str, list]) -> dict[str, list]:
        columns = list(zip(*map(text_counts, part["text"]), strict=True))
        return {"doc_id": part["doc_id"], **dict(zip(COUNTS, columns, strict=True))}

    schema = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS)
    return texts(docs).mapInArrow(batches(count, STATS, ("doc_id", "text")), schema)


def features(stats: DataFrame) -> DataFrame:
    """The learner's features: ratios that do not depend on the text's length, and two lengths."""
    words, chars = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))
    lines = F.greatest(F.col("n_lines"), F.lit(1))
    return stats.withColumns(
        {
            "word_length": F.col("word_chars") / words,
            "symbols_per_word": F.col("n_symbols") / words,
            "upper_share": F.col("n_upper") / chars,
            "digit_share": F.col("n_digits") / chars,
            "marks_per_word": F.col("n_marks") / words,
            "dup_line_share": F.col("n_dup_lines") / lines,
            "repeat_share": F.col("n_repeat_words") / words,
            "distinct_share": F.col("n_distinct_words") / words,
            "words_per_line": F.col("n_words") / lines,
        }
    )


@dataclass(frozen=True)
class Test:
    feature: str
    above: bool
    cut: float

    def column(self) -> Column:
        return F.col(self.feature) > self.cut if self.above else F.col(self.feature) <= self.cut

    def holds(self, table: dict[str, np.ndarray]) -> np.ndarray:
        return table[self.feature] > self.cut if self.above else table[self.feature] <= self.cut

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.cut:.6g}"


def covers(rule: list[Test], table: dict[str, np.ndarray]) -> np.ndarray:
    held = np.ones(len(next(iter(table.values()))), bool)
    for test in rule:
        held &= test.holds(table)
    return held


def grow(table: dict[str, np.ndarray], bad: np.ndarray, cuts: dict[str, np.ndarray], most: int) -> list[Test]:
    """Add the test of greatest FOIL gain until no bad row is mixed with a good one."""
    rule: list[Test] = []
    inside = np.ones(len(bad), bool)
    while len(rule) < most:
        p0, n0 = int((inside & bad).sum()), int((inside & ~bad).sum())
        if not p0 or not n0:
            break
        best, gain = None, 1e-9
        for name, values in cuts.items():
            if not len(values):
                continue
            place = np.searchsorted(values, table[name][inside], side="left")
            p_below = np.cumsum(np.bincount(place[bad[inside]], minlength=len(values) + 1))[:-1]
            n_below = np.cumsum(np.bincount(place[~bad[inside]], minlength=len(values) + 1))[:-1]
            for above, p, n in ((False, p_below, n_below), (True, p0 - p_below, n0 - n_below)):
                with np.errstate(divide="ignore", invalid="ignore"):
                    score = np.where(p > 0, p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0))), -1.0)
                k = int(np.argmax(score))
                if score[k] > gain:
                    best, gain = Test(name, above, float(values[k])), float(score[k])
        if best is None:
            break
        rule.append(best)
        inside &= best.holds(table)
    return rule


def worth(rule: list[Test], table: dict[str, np.ndarray], bad: np.ndarray) -> float:
    held = covers(rule, table)
    p, n = int((held & bad).sum()), int((held & ~bad).sum())
    return (p - n) / (p + n) if p + n else -1.0


def learn_list(table: dict[str, np.ndarray], bad: np.ndarray, precision: float = 0.9, most_tests: int = 4, most_rules: int = 24) -> list[list[Test]]:
    """Ordered rules that mark bad rows; each keeps at least ``precision`` on rows it was not grown on."""
    rules: list[list[Test]] = []
    left = np.ones(len(bad), bool)
    prune_part = np.arange(len(bad)) % 3 == 2
    while len(rules) < most_rules and (left & bad).sum() >= 5:
        sub = {k: v[left & ~prune_part] for k, v in table.items()}
        held_out = {k: v[left & prune_part] for k, v in table.items()}
        # cuts lie between values of the rows still left, so later rules resolve rare causes
        cuts = {k: np.unique(np.quantile(v, np.linspace(0, 1, 129)[1:-1], method="lower")) for k, v in sub.items()} if len(bad) else {}
        for k, v in sub.items():
            cuts[k] = np.unique(np.r_[cuts[k], np.quantile(v[bad[left & ~prune_part]], np.linspace(0, 1, 33), method="lower")]) if bad[left & ~prune_part].any() else cuts[k]
        rule = grow(sub, bad[left & ~prune_part], cuts, most_tests)
        if not rule:
            break
        prune_bad = bad[left & prune_part]
        while len(rule) > 1 and worth(rule[:-1], held_out, prune_bad) >= worth(rule, held_out, prune_bad):
            rule = rule[:-1]
        inside = covers(rule, table) & left
        p, n = int((covers(rule, held_out) & prune_bad).sum()), int((covers(rule, held_out) & ~prune_bad).sum())
        if p + n == 0 or (p + 1) / (p + n + 2) < precision * min(1.0, (p + n + 1) / (p + n + 2)):
            break
        rules.append(rule)
        left &= ~inside
    return rules


def rule_column(rules: list[list[Test]]) -> Column:
    """Number of the first rule that holds, from 1; 0 if none does."""
    out = None
    for number, rule in enumerate(rules, 1):
        condition = rule[0].column()
        for test in rule[1:]:
            condition &= test.column()
        out = F.when(condition, F.lit(number)) if out is None else out.when(condition, F.lit(number))
    return F.lit(0) if out is None else out.otherwise(F.lit(0))


def fit(stats: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> list[list[Test]]:
    """The decision list learned from labelled statistics; ``sample_rows`` bounds what reaches the driver."""
    marked = labels.where(F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("label_quality"))
    known = features(stats).join(marked, "doc_id").where(~base_failed()).select("doc_id", *FEATURES, "label_quality")
    rows = hash_sample(known, sample_rows, "doc_id").toPandas().sort_values(["doc_id", *FEATURES], ignore_index=True)
    rows = rows.iloc[np.random.default_rng(1).permutation(len(rows))]
    bad = (rows["label_quality"] == 0).to_numpy()
    if not len(rows) or bad.all() or not bad.any():
        return []
    return learn_list({c: rows[c].to_numpy(float) for c in FEATURES}, bad)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def judge(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Counts, base verdict, the first rule that fired and the final verdict of every document."""
    stats = stored(text_stats(docs))
    rules = fit(stats, labels, sample_rows)
    return features(stats).withColumn("rule", rule_column(rules)).select(
        "doc_id", *COUNTS, "rule",
        base_failed().alias("base_failed"),
        (~base_failed() & (F.col("rule") == 0)).alias("kept"),
    )
