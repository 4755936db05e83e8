"""Personal data: fixed patterns, and further spans chosen by boosted trees among generous candidates.

The base patterns find emails, addresses of machines, card numbers and telephone numbers; each search
is linear in the text. Candidate generators then propose every other stretch that could be one of these
(each run of whole digit groups in a chain of numbers, addresses with spelled-out signs), overlapping ones
too. A run has at most 19 digits, so their number is linear in the text. Gradient-boosted
trees over format and context features give each a probability, calibrated by isotonic regression on
held-out rows; per kind the lowest threshold of at least ``PRECISION`` there selects what is added.

There are no labels: base spans of the corpus, rewritten in other formats, are the positives, and
candidates that provably fail (checksum, range, number of digits) with dates, versions, amounts and parts
of generated numbers from a fixed-seed generator the negatives. Corpus candidates for training are about ``SAMPLE_ROWS`` at most.

Cases: null or empty text has no spans; equal texts have equal spans; without any candidate in the
corpus the model is fitted on generated rows alone; other columns are ignored or, in ``redact``, kept.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epipanel.llm.common import sha256_hex, stored, texts, with_texts

KINDS = ("email", "ip", "card", "phone")
SAMPLE_ROWS = 8_000
#: Candidates of a text that are held and scored at a time.
SLICE = 4_096
PRECISION = 0.99
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
NUMBER = re.compile(r"[+(]{0,2}[0-9]+(?:(?:[ ().\-/]|\[\.\]|\(dot\)){1,3}[0-9]+)*")
MAIL = re.compile(
    r"([\w.%+-]{1,64})\s?(?:@|\(at\)|\[at\]|\{at\}| at )\s?([\w-]{1,63}(?:\s?(?:\.|\(dot\)|\[dot\]|\{dot\}| dot )\s?[\w-]{1,63}){1,6})", re.IGNORECASE
)
#: The middle of ``MAIL``, so in every text that it matches.
MAIL_CORE = re.compile(r"(?:@|\(at\)|\[at\]|\{at\}| at )\s?[\w-]{1,63}\s?(?:\.|\(dot\)|\[dot\]|\{dot\}| dot )\s?[\w-]", re.IGNORECASE)
GROUP = re.compile("[0-9]+")
INNER = re.compile(r"(?<=[0-9])[^0-9]+(?=[0-9])")
GLUE_BEFORE, GLUE_AFTER = re.compile(r"[0-9]([ ().\-/]{1,3})$"), re.compile(r"([ ().\-/]{1,3})[0-9]")
CUES = re.compile(r"mail|phone|tel|call|fax|mobile|card|visa|pay|host|server|address|ip\b", re.IGNORECASE)
Span = tuple[str, int, int]


def digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(number: str) -> bool:
    total = 0
    for k, char in enumerate(reversed(number)):
        d = ord(char) - 48
        if k % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def emails(text: str) -> list[Span]:
    """Leftmost non-overlapping emails: from each sign, left over its local part, right over its domain."""
    found, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            found.append(("email", start, domain.end()))
            last = domain.end()
        else:
            last = at + 1
        at = text.find("@", max(at + 1, last))
    return found


def base_spans(text: str) -> list[Span]:
    found = emails(text) if "@" in text else []
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12 and 12 <= len(d := digits(m[0])) <= 19 and luhn(d):
            found.append(("card", *m.span()))
    if "." in text:
        found += [("ip", *m.span()) for m in IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in m[0].split("."))]
    if "+" in text:
        found += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m[0])) <= 15]
    return in_order(found)


def in_order(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def listed(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def proposals(text: str, taken: list[Span]) -> Iterator[list[Span]]:
    """Everything that could be personal data and does not touch a base span, ``SLICE`` or a few more at a time."""
    marks = marked(bytearray(len(text)), taken) if taken else None
    found: list[Span] = []

    def free(spans: list[Span]) -> list[Span]:
        return spans if marks is None else [s for s in spans if marks.find(1, s[1], s[2]) < 0]

    if MAIL_CORE.search(text):
        found += [("email", *m.span()) for m in MAIL.finditer(text)]
    for m in NUMBER.finditer(text):
        ahead: deque[tuple[int, int]] = deque()  # the groups that a run from the next one may reach: 19 digits
        groups, n_ahead, done = GROUP.finditer(text, *m.span()), 0, False
        while True:
            while not done and n_ahead <= 19:
                group = next(groups, None)
                if group is None:
                    done = True
                else:
                    ahead.append(group.span())
                    n_ahead += group.end() - group.start()
            if not ahead:
                break
            a = first = ahead[0][0]
            while a > m.start() and text[a - 1] in "+(":
                a -= 1
            n = 0
            for j, (start, b) in enumerate(ahead):
                n += b - start
                if n > 19:
                    break
                if j == 3 and n <= 12 and (n >= 7 or text.count(".", a, b) + text.count("dot", a, b) >= 3):
                    found.append(("ip", a, b))
                if 7 <= n <= 15:
                    found.append(("phone", a, b))
                if n >= 12:
                    found.append(("card", a, b))
            n_ahead -= ahead.popleft()[1] - first
            if len(found) >= SLICE:
                yield in_order(free(found))
                found = []
    yield in_order(free(found))


def candidates(text: str, taken: list[Span]) -> list[Span]:
    """All proposals for a short text."""
    return in_order([s for some in proposals(text, taken) for s in some])


def marked(marks: bytearray, spans: list[Span]) -> bytearray:
    for _, a, b in spans:
        marks[a:b] = b"\1" * (b - a)
    return marks


NAMES = (
    "email", "ip", "card", "phone", "n_digits", "n_groups", "longest_group", "shortest_group", "last_group", "plus",
    "brackets", "dots", "dashes", "spaces", "slashes", "luhn", "octets", "leading_zero", "local_pattern",
    "card_pattern", "year_first", "length", "label_length", "spelled_signs", "letters_near", "digits_near",
    "cue_before", "starts_word", "ends_word", "inner_signs", "glued_before", "glued_after",
)


def described(kind: str, text: str, start: int, end: int) -> list[float]:
    """Format features of the span and context features around it."""
    own = text[start:end]
    groups = re.findall("[0-9]+", own)
    sizes = [len(g) for g in groups] or [0]
    number = "".join(groups)
    before, after = text[max(0, start - 24) : start], text[end : end + 12]
    tail = re.split(r"[.\s\])}]", own)[-1]
    inner = set(INNER.findall(own)) if kind != "email" else set()
    # numbers that stand next to it: none, behind another sign than those inside, behind the same
    glued = [1 + (m[1] in inner) if m else 0 for m in (GLUE_BEFORE.search(before), GLUE_AFTER.match(after))]
    return [
        *(float(kind == k) for k in KINDS),
        len(number), len(groups), max(sizes), min(sizes), sizes[-1], own.startswith("+"), own.count("(") - own.count("(dot"),
        own.count("."), own.count("-"), own.count(" "), own.count("/"), 12 <= len(number) <= 19 and luhn(number),
        len(groups) == 4 and all(len(g) < 4 and int(g) <= 255 for g in groups),
        sum(g[0] == "0" and len(g) > 1 for g in groups), sizes[-3:] in ([3, 3, 4], [2, 4, 4], [3, 4, 4]) or sizes in ([10], [3, 4], [3, 7]),
        sizes in ([4, 4, 4, 4], [4, 6, 5], [16], [15]), bool(groups) and len(groups[0]) == 4 and groups[0][:2] in ("19", "20"),
        len(own), len(tail), len(re.findall(r"\(at\)|\[at\]|\{at\}| at |\(dot\)|\[dot\]|\{dot\}| dot |\[\.\]", own, re.IGNORECASE)),
        sum(map(str.isalpha, before[-8:] + after[:8])), sum(map(str.isdigit, before + after)), bool(CUES.search(before)),
        not before or before[-1].isspace() or before[-1] in "\"'(<:=", not after or after[0].isspace() or after[0] in ".,;:!?)\"'>",
        len(inner), *glued,
    ]


def provably_not(kind: str, own: str) -> bool:
    number, groups = digits(own), re.findall("[0-9]+", own)
    if kind == "card":
        return not 12 <= len(number) <= 19 or not luhn(number)
    if kind == "ip":
        return len(groups) != 4 or any(len(g) > 3 or int(g) > 255 for g in groups)
    if kind == "phone":
        return not 9 <= len(number) <= 15 or max(map(len, groups)) > 11
    return False


def rewritten(kind: str, own: str, rng: np.random.Generator) -> str:
    """The same datum in another common format."""
    number = digits(own)
    if kind == "email":
        at, dot = [("@", "."), (" (at) ", "."), ("[at]", "[dot]"), (" at ", " dot "), ("(at)", "(dot)"), ("{at}", "."), ("{at}", "{dot}")][rng.integers(7)]
        local, _, domain = own.partition("@")
        return f"{local}{at}{domain.replace('.', dot)}"
    if kind == "ip":
        return own.replace(".", ["[.]", "(dot)", "."][rng.integers(3)])
    if kind == "card":
        gap = " .-"[rng.integers(3)] * int(rng.integers(1, 3))
        return gap.join(number[k : k + 4] for k in range(0, len(number), 4))
    n = number[-10:]
    return [f"({n[:3]}) {n[3:6]}-{n[6:]}", f"{n[:3]}-{n[3:6]}-{n[6:]}", f"{n[:3]}.{n[3:6]}.{n[6:]}", f"1 ({n[:3]}) {n[3:6]}-{n[6:]}"][rng.integers(4)]


def generated(rng: np.random.Generator, rows: int = 600) -> tuple[list[Span], list[str], list[Span], list[str]]:
    """Positives and negatives that do not depend on the corpus."""
    good, good_text, bad, bad_text = [], [], [], []

    def put(spans: list[Span], where: list[str], kind: str, own: str, tails: tuple[str, ...] = ("", ".", " and so", ", then")) -> None:
        lead = ["word ", "at home ", "the line ", ""][rng.integers(4)]
        spans.append((kind, len(lead), len(lead) + len(own)))
        where.append(lead + own + tails[rng.integers(len(tails))])

    for _ in range(rows):
        n = "".join(map(str, rng.integers(0, 10, 16)))
        stem = next(n[:15] + str(c) for c in range(10) if luhn(n[:15] + str(c)))
        put(good, good_text, "card", rewritten("card", stem, rng))
        put(good, good_text, "phone", rewritten("phone", "2" + n[:9], rng))
        put(good, good_text, "ip", rewritten("ip", ".".join(map(str, rng.integers(1, 256, 4))), rng))
        user = "".join(map(chr, rng.integers(97, 123, rng.integers(3, 9))))
        put(good, good_text, "email", rewritten("email", f"{user}@{user[:4]}.{['com', 'org', 'net', 'de'][rng.integers(4)]}", rng))
        year, code = f"{rng.integers(1, 13):02d}/{rng.integers(20, 40)}", f"{rng.integers(100, 1000)}"
        forms = ("-".join([stem[k : k + 4] for k in range(0, 16, 4)]), stem, rewritten("card", stem, rng))
        put(good, good_text, "card", forms[rng.integers(3)], (f" {year}", f" {code}", f" {year} {code}", f", {year}"))
        put(good, good_text, "phone", rewritten("phone", "2" + n[:9], rng), (f" {rng.integers(6, 12)}-{rng.integers(1, 8)}", f" {rng.integers(1, 60)}", f" / {code}"))
        day = f"{rng.integers(1950, 2040)}-{rng.integers(1, 13):02d}-{rng.integers(1, 29):02d}"
        clock = f"{rng.integers(0, 24):02d}.{rng.integers(0, 60):02d}.{rng.integers(0, 60):02d}"
        wrong = n[:15] + str((int(stem[-1]) + 1 + rng.integers(9)) % 10)
        other = [day, f"{day} {clock}", day.replace("-", "/"), n[:7], n[:9], n[:11], n, f"{n[:3]} {n[3:6]} {n[6:9]}", f"{n[0]}.{n[1:3]}.{n[3:5]}-{n[5:9]}"]
        put(bad, bad_text, "phone", other[rng.integers(len(other))])
        put(bad, bad_text, "card", rewritten("card", wrong, rng) if not luhn(wrong) else n[:12])
        put(bad, bad_text, "ip", f"{rng.integers(256, 999)}.{rng.integers(0, 999)}.{rng.integers(0, 99)}.{rng.integers(0, 99)}")
        put(bad, bad_text, "email", [f"{user} at {user[:3]} dot", f"met at {user}.", f"{user} @ {user[1:]}", f"was at {user} . so"][rng.integers(4)])
        put(bad, bad_text, "email", [f"{user} at {user[:4]}. {user[1:]}", f"met at {user}. {user[:3]}", f"was at {n[:2]}.{n[2:4]}", f"{user} at {n[:1]}. {user}"][rng.integers(4)])
        put(bad, bad_text, "phone", "  ".join([n[:2], n[2:6], n[6:9], n[9:12]][: rng.integers(3, 5)]), (f" {n[12:]}", f"  {n[13:]} {n[:3]}"))
    # parts of a number, and more than it, are not it; neither is a part of what is none
    whole = [(*s, t, True) for s, t in zip(good, good_text, strict=True)] + [(*s, t, False) for s, t in zip(bad, bad_text, strict=True)]
    for kind, a, b, text, right in whole:
        if kind == "email" or not right and kind == "ip":
            continue
        for rival in candidates(text, []):
            if rival != (kind, a, b) and rival[0] != "email" and rival[1] < b and a < rival[2] and not provably_not(rival[0], text[rival[1] : rival[2]]):
                bad.append(rival)
                bad_text.append(text)
    return good, good_text, bad, bad_text


@dataclass
class Trees:
    """Boosted depth-3 trees over binned features, their calibration and each kind's threshold."""

    edges: list[np.ndarray]
    trees: list[tuple[list[tuple[int, int]], np.ndarray]]
    start: float
    steps: tuple[np.ndarray, np.ndarray]
    cuts: dict[str, float]

    def raw(self, x: np.ndarray) -> np.ndarray:
        binned = bins(x, self.edges)
        out = np.full(len(x), self.start)
        for tests, leaves in self.trees:
            out += leaves[walk(binned, tests)]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        at, value = self.steps
        return value[np.clip(np.searchsorted(at, self.raw(x), side="right") - 1, 0, len(value) - 1)]


def bins(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, x[:, k], side="left") for k, e in enumerate(edges)], axis=1) if len(x) else np.zeros((0, len(edges)), int)


def walk(binned: np.ndarray, tests: list[tuple[int, int]]) -> np.ndarray:
    """Leaf of every row in a complete tree whose nodes are in level order."""
    node = np.zeros(len(binned), int)
    feature, cut = np.array([t[0] for t in tests]), np.array([t[1] for t in tests])
    while len(node) and node.max() < len(tests):
        node = 2 * node + 1 + (binned[np.arange(len(node)), feature[node]] > cut[node])
    return node - len(tests)


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 80, rate: float = 0.2, depth: int = 3) -> Trees:
    edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, 33)[1:-1])) for k in range(x.shape[1])]
    binned, width = bins(x, edges), 33
    start = float(np.log(y.mean() / (1 - y.mean())))
    score, trees = np.full(len(y), start), []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-score))
        slope, bend = p - y, np.maximum(p * (1 - p), 1e-6)
        tests: list[tuple[int, int]] = []
        node = np.zeros(len(y), int)
        for level in range(depth):
            first, many = 2**level - 1, 2**level
            best, chosen = np.full(many, 1e-9), [(0, width)] * many
            for k in range(x.shape[1]):
                key = (node - first) * width + binned[:, k]
                g = np.bincount(key, slope, many * width).reshape(many, width).cumsum(1)
                h = np.bincount(key, bend, many * width).reshape(many, width).cumsum(1)
                gain = g**2 / (h + 1) + (g[:, -1:] - g) ** 2 / (h[:, -1:] - h + 1) - g[:, -1:] ** 2 / (h[:, -1:] + 1)
                at = gain.argmax(1)
                for m in np.flatnonzero(gain[np.arange(many), at] > best):
                    best[m], chosen[m] = gain[m, at[m]], (k, int(at[m]))
            tests += chosen
            f, c = np.array([t[0] for t in chosen]), np.array([t[1] for t in chosen])
            node = 2 * node + 1 + (binned[np.arange(len(node)), f[node - first]] > c[node - first])
        leaf = node - len(tests)
        leaves = -rate * np.bincount(leaf, slope, 2**depth) / (np.bincount(leaf, bend, 2**depth) + 1)
        score += leaves[leaf]
        trees.append((tests, leaves))
    return Trees(edges, trees, start, (np.zeros(1), np.zeros(1)), {})


def isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Steps of the non-decreasing fit of y on score, by pooling neighbours that fall."""
    order = np.argsort(score, kind="stable")
    blocks: list[list[float]] = []
    for s, v in zip(score[order].tolist(), y[order].tolist(), strict=True):
        blocks.append([s, v, 1.0])
        while len(blocks) > 1 and (blocks[-2][1] >= blocks[-1][1] or blocks[-2][0] == blocks[-1][0]):
            _, v2, n2 = blocks.pop()
            b = blocks[-1]
            b[1], b[2] = (b[1] * b[2] + v2 * n2) / (b[2] + n2), b[2] + n2
    return np.array([b[0] for b in blocks]), np.array([b[1] for b in blocks])


class Sample:
    """Of all rows it is shown, the ``size`` distinct ones of the smallest hashes."""

    def __init__(self, size: int):
        self.size, self.limit = size, 1 << 64
        self.rows: dict[tuple, int] = {}

    def show(self, row: tuple) -> None:
        h = xxhash.xxh64_intdigest("\0".join(row))
        if h < self.limit:
            self.rows[row] = h
            if len(self.rows) >= 2 * self.size:
                self.settle()

    def settle(self) -> dict[tuple, int]:
        if len(self.rows) > self.size:
            kept = sorted(self.rows.items(), key=lambda r: (r[1], r[0]))[: self.size]
            self.rows, self.limit = dict(kept), kept[-1][1]
        return self.rows


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Trees:
    """Every task sends the rows of the smallest hashes of each label, at most ``sample_rows`` / 2, so what is
    sampled does not depend on how rows are dealt out, and what leaves a task is bounded."""
    size = max(1, sample_rows // 2)

    def propose(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        samples = (Sample(size), Sample(size))  # half of each label: a chain has many more parts that fail than numbers
        for part in parts:
            for text in part.column("text").to_pylist():
                if not NUMBER_HINT.search(text) and not MAIL_CORE.search(text):
                    continue
                base = base_spans(text)
                for kind, a, b in base:
                    samples[1].show((kind, text[max(0, a - 24) : a], text[a:b], text[b : b + 12]))
                for some in proposals(text, base):
                    for kind, a, b in some:
                        if provably_not(kind, text[a:b]):
                            samples[0].show((kind, text[max(0, a - 24) : a], text[a:b], text[b : b + 12]))
        for label, sample in enumerate(samples):
            rows = [(*row, label, h - (1 << 63)) for row, h in sample.settle().items()]
            if rows:
                kinds = (pa.string(),) * 4 + (pa.int32(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["kind", "lead", "own", "tail", "label", "place"])

    shown = texts(docs).select("text").mapInArrow(propose, "kind string, lead string, own string, tail string, label int, place long")
    shown = stored(shown.groupBy("kind", "lead", "own", "tail").agg(F.max("label").alias("label"), F.max("place").alias("place")))
    halves = [shown.where(F.col("label") == label).orderBy("place", "kind", "lead", "own", "tail").limit(size) for label in (0, 1)]
    rows = halves[0].unionByName(halves[1]).drop("place").toPandas().sort_values(["kind", "lead", "own", "tail"])
    rng = np.random.default_rng(7)
    good, good_text, bad, bad_text = generated(rng)
    x = [described(k, t, a, b) for (k, a, b), t in zip(good + bad, good_text + bad_text, strict=True)]
    y = [1.0] * len(good) + [0.0] * len(bad)
    for kind, lead, own, tail, label in rows.itertuples(index=False):
        forms = [own, rewritten(kind, own, rng)] if label else [own]
        for form in forms:
            x.append(described(kind, lead + form + tail, len(lead), len(lead) + len(form)))
            y.append(float(label))
    x, y = np.array(x, float), np.array(y)
    held = rng.random(len(y)) < 0.3
    model = boost(x[~held], y[~held])
    score = model.raw(x[held])
    model.steps = isotonic(score, y[held])
    p = model.probability(x[held])
    for k, kind in enumerate(KINDS):
        own = x[held][:, k] > 0
        cuts = [c for c in np.unique(p[own]) if c >= 0.5 and y[held][own][p[own] >= c].mean() >= PRECISION]
        model.cuts[kind] = float(min(cuts, default=2.0))
    return model


NUMBER_HINT = re.compile(r"[0-9]")


def added_spans(text: str, base: list[Span], model: Trees) -> list[Span]:
    """Candidates whose calibrated probability reaches their kind's threshold; of overlapping ones the likeliest."""
    if not NUMBER_HINT.search(text) and not MAIL_CORE.search(text):
        return []
    likely: list[tuple[float, int, int, int]] = []
    for some in proposals(text, base):
        some = [s for s in some if not provably_not(s[0], text[s[1] : s[2]])]
        if some:
            p = model.probability(np.array([described(k, text, a, b) for k, a, b in some], float)).tolist()
            likely += [(-x, a, KINDS.index(k), b) for x, (k, a, b) in zip(p, some, strict=True) if x >= model.cuts[k]]
    chosen: list[Span] = []
    marks = bytearray(len(text)) if likely else b""
    for _, a, k, b in sorted(likely):
        if marks.find(1, a, b) < 0:
            chosen.append((KINDS[k], a, b))
            marked(marks, chosen[-1:])
    return chosen


def find(docs: DataFrame, model: Trees) -> DataFrame:
    """doc_id, base and all spans of every document, as lists of kind:start:end, and counts by kind of the base ones."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            base_lists, span_lists, counts = [], [], []
            for start in range(0, part.num_rows, 512):
                for text in part.column("text").slice(start, 512).to_pylist():
                    base = base_spans(text)
                    base_lists.append(listed(base))
                    span_lists.append(listed(in_order(base + added_spans(text, base, sent.value))))
                    counts.append([sum(s[0] == k for s in base) for k in KINDS])
            by_kind = zip(*counts, strict=True) if counts else [()] * len(KINDS)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *(pa.array(c, pa.int64()) for c in by_kind), pa.array([sha256_hex(b.encode()) for b in base_lists]), pa.array(base_lists), pa.array(span_lists)],
                names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "base", "spans"],
            )

    kinds = ", ".join(f"n_{k} long" for k in KINDS)
    return texts(docs).mapInArrow(run, f"doc_id long, {kinds}, base_sha256 string, base string, spans string")


def redacted(text: str, model: Trees) -> str:
    base = base_spans(text)
    out, last = [], 0
    for kind, a, b in in_order(base + added_spans(text, base, model)):
        if b <= last:
            continue
        if a >= last:
            out += [text[last:a], f"[{kind.upper()}]"]
        last = b
    return "".join([*out, text[last:]])


def redact(docs: DataFrame, model: Trees) -> DataFrame:
    """All columns, with every span in a text replaced by its kind in brackets."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return with_texts(docs, lambda: lambda part: [redacted(t, sent.value) for t in part])
