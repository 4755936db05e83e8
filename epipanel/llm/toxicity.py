"""Toxicity by a noisy channel: obfuscated words are restored, then the restored text is scored.

Words written with digits and signs for letters, with letters set apart or repeated become lattices of
what each sign may stand for. A Viterbi search picks the reading that is likeliest under a character
4-gram model, counted over the whole corpus, and the cost of each substitution. Of the states at a sign the
``BEAM`` likeliest are followed, fewer than there are only behind two blanked letters. Words without such
signs, with letters doubled only, or with an exclamation mark or three blanks behind them stay as they are written.

A logistic model scores the restored words: whole words and word beginnings. It is fitted on a bounded
sample of labelled rows (about ``SAMPLE_ROWS``, the smallest hashes of doc_id) with at most ``FEATURES``
features; the character counts cover every text and are bounded by the alphabet (28 signs, 4 places).

Cases: null or empty text gets the score of a text without features; a document with several labels
counts as toxic if one of them says so; without labels or with one class only every score is that
class's (0 without labels); equal texts have equal scores; other columns are ignored.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epipanel.llm.common import bucket_of, hash_sample, texts

SAMPLE_ROWS = 12_000
FEATURES = 512
ORDER, SIGNS = 4, 28  # 0: no letter, 1-26: a-z, 27: any other letter
BEAM = 128
MEMO = 300_000
STARTS = (4, 5, 6)
WORDS = re.compile(r"[^\W\d_]+")

#: Letters that digits and signs are commonly written for.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l", "¡": "i",
    "*": "abcdefghijklmnopqrstuvwxyz", "#": "abcdefghijklmnopqrstuvwxyz",
}
APART = " ._-·'~"
SUSPECT = re.compile(
    r"(?<![^\s\"(])(?=\S*[^\W\d_])[0-9@$!|+€£¡*#]+[^\W\d_]\S*"  # a sign, then letters
    r"|[^\W\d_]+[0-9@$!|+€£¡*#]+[^\W\d_]\S*"  # a sign between letters
    r"|[^\W\d_]+(?:[0-9@$!|+€£¡]*[0-9@$|+€£]|[*#]{1,2})(?=[.,;:?)\"']*(?!\S))"  # signs at the end
    r"|[^\W_]*([^\W\d_])\1\1[^\W_]*"  # a letter three times
    r"|(?<!\w)[^\W\d_](?:[ ._·'~-]{1,2}[^\W_]){3,}(?!\w)"  # letters set apart
    r"|[^\W\d_]{1,3}(?:[._·~-][^\W\d_]{1,3}){2,}"
)


def _sign_table() -> np.ndarray:
    table = np.zeros(0x10000, np.uint8)
    for code in range(0x10000):
        char = chr(code)
        if char.isalpha():
            base = unicodedata.normalize("NFKD", char)[0].lower()
            table[code] = ord(base) - 96 if "a" <= base <= "z" else 27
    return table


@cache
def tables() -> tuple[np.ndarray, np.ndarray]:
    """By code point: letter class; 1 for a sign written for letters, 2 for a mark between letters, 4 for white space,
    8 for a sign that may end a word, 16 for a digit."""
    kind = np.zeros(0x10000, np.uint8)
    kind[[ord(c) for c in LEET]] = 1
    kind[[ord(c) for c in APART]] |= 2
    kind[[k for k in range(0x10000) if chr(k).isspace()]] |= 4
    kind[[ord(c) for c in LEET if c not in "!¡"]] |= 8
    kind[[k for k in range(0x10000) if chr(k).isdigit()]] |= 16
    return _sign_table(), kind


def codes_of(text: str) -> np.ndarray:
    return np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), 0xFFFF)


def signs(text: str) -> np.ndarray:
    """Letter classes of a text."""
    return tables()[0][codes_of(text)]


def suspects(text: str) -> list[tuple[int, int]]:
    """Stretches, between white space, that hold everything ``SUSPECT`` can match in the text."""
    codes = codes_of(f" {text}  ")
    letters, kinds = tables()
    letter, kind = letters[codes] > 0, kinds[codes]
    at = np.flatnonzero(kind & 3)
    at = at[(at > 0) & (at < len(codes) - 2)]
    sign, mark = kind[at] & 1 > 0, (kind[at] & 2 > 0) & (kind[at] & 4 == 0)
    before, after = letter[at - 1], letter[at + 1]
    ends = kind[at] & 8 > 0
    hits = [at[(sign & after) | (ends & before) | (sign & before & (kind[at + 1] & 1 > 0)) | (mark & before & after)]]
    same = np.flatnonzero((codes[1:-1] == codes[:-2]) & (codes[1:-1] == codes[2:]) & letter[1:-1])
    hits.append(same + 1)
    alone = letter | (kind & 16 > 0)
    wide = np.flatnonzero(alone[1:-1] & ~alone[:-2] & ~alone[2:]) + 1
    known = letter[wide]
    close = np.flatnonzero((wide[3:] - wide[:-3] <= 9) & (known[3:] | known[2:-1] | known[1:-2] | known[:-3])) if len(wide) > 3 else np.zeros(0, int)
    spans: list[tuple[int, int]] = []
    if not len(close) and not any(map(len, hits)):
        return spans
    white = np.flatnonzero(kind & 4)
    lows = np.concatenate([*hits, wide[close]])
    highs = np.concatenate([*hits, wide[close + 3]])
    order = np.argsort(lows, kind="stable")
    lows, highs = lows[order], highs[order]
    start = white[np.searchsorted(white, lows, side="right") - 1]
    stop = white[np.searchsorted(white, highs, side="left")] - 1
    for a, b in zip(start.tolist(), stop.tolist(), strict=True):
        if spans and a <= spans[-1][1] + 1:
            spans[-1] = (spans[-1][0], max(b, spans[-1][1]))
        else:
            spans.append((a, b))
    return spans


def gram_counts(docs: DataFrame) -> DataFrame:
    """gram, n: 4-grams of letter classes over every whole text, summed in each task first."""

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SIGNS**ORDER, np.int64)
        for part in parts:
            column = part.column("text")
            for start in range(0, part.num_rows, 256):
                c = signs("   " + "   ".join(column.slice(start, 256).to_pylist()) + "   ").astype(np.int32)
                key = ((c[:-3] * SIGNS + c[1:-2]) * SIGNS + c[2:-1]) * SIGNS + c[3:]
                total += np.bincount(key, minlength=len(total))
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int64)), pa.array(total[found])], names=["gram", "n"])

    return texts(docs).select("text").mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def log_model(counts: np.ndarray) -> np.ndarray:
    """log P(last | first three), each order mixed with the shorter one below it."""
    four = counts.reshape((SIGNS,) * ORDER).astype(float)
    p = np.full(SIGNS, 1.0 / SIGNS)
    for width in range(1, ORDER + 1):
        c = four.sum(axis=tuple(range(ORDER - width)))
        p = (c + 2.0 * p) / (c.sum(axis=-1, keepdims=True) + 2.0)
    return np.log(p).astype(np.float32)


def arcs(run: str, last: bool = False) -> list[tuple[str, float]]:
    """Readings of a run of one sign, with their log costs; a word's last one may well be no letter."""
    char, times = run[0], len(run)
    if char.isalpha():
        if times == 1:
            return [(char, 0.0)]
        return [(char * 2, 0.0), (char, -2.0)] if times == 2 else [(char, -0.5), (char * 2, -0.7)]
    out = [("", -0.3), (" ", -0.7)] if char in APART else [("", -3.0 if last and char in "*#|+" else -5.0), (" ", -6.0)]
    for letter in LEET.get(char, ""):
        price = -1.0 if len(LEET[char]) < 4 else -4.0
        out.append((letter, price))
        if times > 1:
            out.append((letter * min(times, 2), price - 0.5))
    if len(LEET.get(char, "")) > 4 and times > 1:  # several blanked letters
        return out[:2] + [(a, b - 1.0) for a, b in out[2:]]
    return out


def restore(token: str, model: np.ndarray) -> str:
    """Likeliest reading of an obfuscated stretch of text."""
    states: dict[tuple[int, int, int], tuple[float, str]] = {(0, 0, 0): (0.0, "")}
    runs = [m[0] for m in re.finditer(r"(.)\1*", token.lower(), re.DOTALL)]
    if any(len(LEET.get(r[0], "")) > 4 and len(r) > 1 for r in runs):
        runs = [c for r in runs for c in (r if len(LEET.get(r[0], "")) > 4 else [r])]
    for k, run in enumerate([*runs, None]):
        after: dict[tuple[int, int, int], tuple[float, str]] = {}
        for reading, price in arcs(run, k == len(runs) - 1) if run else [(" ", 0.0)]:
            classes = signs(reading).tolist()
            for state, (score, text) in states.items():
                a, b, c = state
                total = score + price
                for d in classes:
                    if d or c:
                        total += float(model[a, b, c, d])
                    a, b, c = b, c, d
                if (a, b, c) not in after or after[a, b, c][0] < total:
                    after[a, b, c] = (total, text + reading)
        if len(after) > BEAM:
            after = dict(sorted(after.items(), key=lambda x: -x[1][0])[:BEAM])
        states = after
    return max(states.values())[1].strip()


@dataclass
class Model:
    grams: np.ndarray
    bias: float
    words: dict[str, float] = field(default_factory=dict)
    starts: dict[str, float] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.memo: dict[str, str] = {}
        self.heads: set[str] | None = None  # first four letters of every feature

    def restored(self, match: re.Match[str]) -> str:
        token = match[0]
        found = self.memo.get(token)
        if found is None:
            if len(self.memo) > MEMO:
                self.memo.clear()
            edge = token.rstrip(".,;:?)\"'")
            found = self.memo[token] = restore(edge, self.grams) + token[len(edge) :] + " "
        return found

    def clean(self, text: str) -> str:
        """The text with every obfuscated stretch restored."""
        spans = suspects(text)
        if not spans:
            return text
        out, last = [], 0
        for a, b in spans:
            out += [text[last:a], SUSPECT.sub(self.restored, text[a:b])]
            last = b
        return "".join([*out, text[last:]])

    def evidence(self, text: str) -> tuple[set[str], set[str]]:
        return evidence(self.clean(text))

    def score(self, text: str) -> float:
        if self.heads is None:
            self.heads = {f[:4] for f in (*self.words, *self.starts)}
        near = {w for w in set(WORDS.findall(self.clean(text).lower())) if w[:4] in self.heads}
        z = self.bias + sum(self.words[w] for w in self.words.keys() & near)
        z += sum(self.starts[s] for s in self.starts.keys() & {w[:n] for w in near for n in STARTS if len(w) >= n})
        return 1.0 / (1.0 + math.exp(-max(-700.0, min(700.0, z))))


def evidence(text: str) -> tuple[set[str], set[str]]:
    words = set(WORDS.findall(text.lower()))
    return words, {w[:n] for w in words for n in STARTS if len(w) >= n}


def best_features(sample: DataFrame, blank: Model, most: int) -> list[str]:
    """Words and word beginnings (marked ^) that speak most for toxic texts, by likelihood ratio."""

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every: Counter[str] = Counter()
        toxic: Counter[str] = Counter()
        for part in parts:
            for text, label in zip(part.column("text").to_pylist(), part.column("label").to_pylist(), strict=True):
                words, starts = blank.evidence(text)
                found = [*words, *("^" + s for s in starts)]
                every.update(found)
                if label:
                    toxic.update(found)
        keys = list(every)
        for start in range(0, len(keys), 50_000):
            cut = keys[start : start + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cut), pa.array([every[k] for k in cut], pa.int64()), pa.array([toxic[k] for k in cut], pa.int64())],
                names=["feature", "n", "n_toxic"],
            )

    total = sample.agg(F.count("*").alias("n"), F.sum("label").alias("t")).first()
    n, t = max(total["n"], 1), max(total["t"] or 0, 1)
    share = F.lit(t / n)
    inside = F.col("n_toxic") / F.col("n")
    gain = F.col("n_toxic") * F.log(inside / share) + F.coalesce((F.col("n") - F.col("n_toxic")) * F.log((1 - inside) / (1 - share)), F.lit(0.0))
    rows = (
        sample.mapInArrow(count, "feature string, n long, n_toxic long")
        .groupBy("feature").agg(F.sum("n").alias("n"), F.sum("n_toxic").alias("n_toxic"))
        .where((F.col("n_toxic") >= 4) & (inside > 2 * share))
        .orderBy(F.desc(gain), "feature").limit(most).select("feature").collect()
    )
    return [r["feature"] for r in rows]


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 12) -> tuple[np.ndarray, float]:
    """Weights and bias by Newton steps on the ridge-penalised likelihood; the bias is not penalised."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    w = np.zeros(x.shape[1])
    w[-1] = np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3))
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + penalty * w
        bend = (x * (p * (1 - p) + 1e-6).astype(np.float32)[:, None]).T @ x
        step = np.linalg.solve(bend + np.diag(penalty), slope)
        w -= step
        if np.abs(step).max() < 1e-4:
            break
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, learn: Column | None = None, sample_rows: int = SAMPLE_ROWS, most: int = FEATURES) -> Model:
    """``learn`` limits the labelled rows that may be learned from."""
    counts = np.zeros(SIGNS**ORDER, np.int64)
    grams = gram_counts(docs).toPandas()
    counts[grams["gram"].to_numpy(int)] = grams["n"].to_numpy()
    model = Model(log_model(counts), -30.0)
    marked = labels.where(F.col("toxic").isNotNull() & (learn if learn is not None else F.lit(True)))
    chosen = hash_sample(marked.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("label")), sample_rows, "doc_id")
    sample = texts(docs).join(F.broadcast(chosen), "doc_id")  # about ``sample_rows`` rows of two numbers
    total = sample.agg(F.count("*").alias("n"), F.sum("label").alias("t")).first()
    if not total["n"] or not total["t"] or total["t"] == total["n"]:
        model.bias = 30.0 if total["n"] and total["t"] == total["n"] else -30.0
        return model
    names = best_features(sample, model, most)
    place = {name: k for k, name in enumerate(names)}

    def found(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            rows = []
            for text in part.column("text").to_pylist():
                words, starts = model.evidence(text)
                rows.append([place[f] for f in (*words, *("^" + s for s in starts)) if f in place])
            yield pa.RecordBatch.from_arrays([part.column("label"), pa.array(rows, pa.list_(pa.int32()))], names=["label", "found"])

    rows = sample.mapInArrow(found, "label int, found array<int>").toPandas()
    x = np.zeros((len(rows), len(names)), np.float32)
    for k, own in enumerate(rows["found"]):
        x[k, own] = 1.0
    weights, bias = logistic(x, rows["label"].to_numpy(np.float32))
    model.bias = bias
    for name, weight in zip(names, weights.tolist(), strict=True):
        if weight:
            (model.starts if name[0] == "^" else model.words)[name.removeprefix("^")] = weight
    return model


def scored(docs: DataFrame, model: Model, *keep: str) -> DataFrame:
    """``keep`` columns and score of every document."""
    rows = docs.select(*keep, F.coalesce("text", F.lit("")).alias("__llm_text"))
    sent = docs.sparkSession.sparkContext.broadcast((model.grams, model.bias, model.words, model.starts))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*sent.value)
        for part in parts:
            scores: list[float] = []
            for start in range(0, part.num_rows, 512):
                scores += map(own.score, part.column("__llm_text").slice(start, 512).to_pylist())
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), pa.array(scores, pa.float64())], names=[*keep, "__llm_score"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name in keep)
    return rows.mapInArrow(run, f"{kinds}, __llm_score double")


def rate(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document, learned from the rows not held out."""
    model = fit(docs, labels, bucket_of("doc_id", 5) != 0)
    return scored(docs, model, "doc_id").select(
        "doc_id",
        (F.coalesce(bucket_of("doc_id", 5), F.lit(-1)) == 0).alias("held_out"),
        F.col("__llm_score").alias("score"),
        (F.col("__llm_score") >= 0.5).cast("int").alias("predicted"),
    )


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of the documents that score below one half."""
    return scored(docs, model, *docs.columns).where(F.col("__llm_score") < 0.5).select(*docs.columns)
