"""Language of a text by a bidirectional gated recurrent network over bytes, trained here in numpy.

The network reads each word (a run of letters, lower-cased, in windows of at most ``WINDOW`` bytes) from
both ends with state zero at its edges, and gives every byte a distribution over the languages. So what
a word's bytes get depends on the word alone and is worked out once for each distinct word that a task
meets. A document's distribution is the mean over all its bytes.

Training uses backpropagation through time on about ``SAMPLE_WORDS`` distinct words of about
``SAMPLE_DOCS`` labelled documents (smallest hashes); prediction covers every letter of every text.

Cases: null text and text without a letter get ``und`` and score 0; without labelled rows every
document does; with one language it is predicted for all texts with letters; equal texts get equal
predictions; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epipanel.llm.common import bucket_of, hash_sample, texts

SAMPLE_DOCS, SAMPLE_WORDS = 3_000, 40_000
WINDOW, UNITS = 64, 24
MEMO = 1_000_000
WORDS = re.compile(r"[^\W\d_]+")


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def bytes_of(word: str) -> list[bytes]:
    raw = word.encode("utf-8", "surrogatepass")
    return [raw[k : k + WINDOW] for k in range(0, len(raw), WINDOW)]


def padded(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Byte matrix (256 beyond the end) and lengths."""
    sizes = np.array([len(w) for w in words])
    matrix = np.full((len(words), int(sizes.max())), 256, np.int64)
    matrix[np.arange(matrix.shape[1]) < sizes[:, None]] = np.frombuffer(b"".join(words), np.uint8)
    return matrix, sizes


def reverse(matrix: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Index that turns each row's first ``size`` places around."""
    place = np.arange(matrix.shape[1])[None, :]
    return np.where(place < sizes[:, None], sizes[:, None] - 1 - place, place)


@dataclass
class Network:
    languages: list[str]
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def blank(cls, languages: list[str], rng: np.random.Generator) -> Network:
        h, c = UNITS, len(languages)
        weights = {"out": rng.normal(0, 0.1, (2 * h, c)), "out_bias": np.zeros(c)}
        for side in "lr":
            weights[f"in_{side}"] = rng.normal(0, 0.3, (257, 3 * h))  # a byte's share of all gates
            weights[f"rec_{side}"] = rng.normal(0, 1 / np.sqrt(h), (h, 3 * h))
        return cls(languages, {k: v.astype(np.float32) for k, v in weights.items()})

    def read(self, matrix: np.ndarray, side: str, keep: list | None = None) -> np.ndarray:
        """States of one direction, (words, places, units)."""
        h = UNITS
        table, rec = self.weights[f"in_{side}"], self.weights[f"rec_{side}"]
        state = np.zeros((len(matrix), h), np.float32)
        out = np.empty((*matrix.shape, h), np.float32)
        for t in range(matrix.shape[1]):
            x = table[matrix[:, t]]
            gates = sigmoid(x[:, : 2 * h] + state @ rec[:, : 2 * h])
            update, reset = gates[:, :h], gates[:, h:]
            new = np.tanh(x[:, 2 * h :] + (reset * state) @ rec[:, 2 * h :])
            if keep is not None:
                keep.append((state, update, reset, new))
            state = state + update * (new - state)
            out[:, t] = state
        return out

    def places(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities of every byte, and which places hold one."""
        matrix, sizes = padded(words)
        turn = reverse(matrix, sizes)
        left = self.read(matrix, "l")
        right = self.read(np.take_along_axis(matrix, turn, 1), "r")
        both = np.concatenate([left, np.take_along_axis(right, turn[:, :, None], 1)], axis=2)
        z = both @ self.weights["out"] + self.weights["out_bias"]
        p = np.exp(z - z.max(axis=2, keepdims=True))
        return p / p.sum(axis=2, keepdims=True), np.arange(matrix.shape[1]) < sizes[:, None]

    def sums(self, words: list[str]) -> np.ndarray:
        """Per word: the bytes' probabilities summed, and the number of bytes."""
        parts = [(k, b) for k, w in enumerate(words) for b in bytes_of(w)]
        parts.sort(key=lambda x: len(x[1]))
        out = np.zeros((len(words), len(self.languages) + 1), np.float32)
        for start in range(0, len(parts), 2048):
            owner = np.array([k for k, _ in parts[start : start + 2048]])
            p, there = self.places([b for _, b in parts[start : start + 2048]])
            np.add.at(out, owner, np.column_stack([(p * there[:, :, None]).sum(axis=1), there.sum(axis=1)]).astype(np.float32))
        return out

    def slopes(self, words: list[bytes], target: np.ndarray) -> tuple[dict[str, np.ndarray], float]:
        """Gradient of the mean cross-entropy over all bytes, by backpropagation through time."""
        h, w = UNITS, self.weights
        matrix, sizes = padded(words)
        turn = reverse(matrix, sizes)
        views = {"l": matrix, "r": np.take_along_axis(matrix, turn, 1)}
        kept: dict[str, list] = {"l": [], "r": []}
        left, right = (self.read(views[s], s, kept[s]) for s in "lr")
        both = np.concatenate([left, np.take_along_axis(right, turn[:, :, None], 1)], axis=2)
        z = both @ w["out"] + w["out_bias"]
        p = np.exp(z - z.max(axis=2, keepdims=True))
        p /= p.sum(axis=2, keepdims=True)
        there = (np.arange(matrix.shape[1]) < sizes[:, None]).astype(np.float32)
        n = there.sum()
        loss = -(np.log(p[np.arange(len(p)), :, target] + 1e-9) * there).sum() / n
        d = p.copy()
        d[np.arange(len(p)), :, target] -= 1.0
        d *= (there / n)[:, :, None]
        grads = {"out": np.tensordot(both, d, ((0, 1), (0, 1))), "out_bias": d.sum(axis=(0, 1))}
        back = d @ w["out"].T
        for side, dh in (("l", back[:, :, :h]), ("r", np.take_along_axis(back[:, :, h:], turn[:, :, None], 1))):
            rec = w[f"rec_{side}"]
            d_in, d_rec = np.zeros_like(w[f"in_{side}"]), np.zeros_like(rec)
            later = np.zeros((len(matrix), h), np.float32)
            for t in range(matrix.shape[1] - 1, -1, -1):
                state, update, reset, new = kept[side][t]
                g = dh[:, t] + later
                a_new = g * update * (1 - new**2)
                a_update = g * (new - state) * update * (1 - update)
                through = a_new @ rec[:, 2 * h :].T
                a_reset = through * state * reset * (1 - reset)
                a = np.concatenate([a_update, a_reset, a_new], axis=1)
                np.add.at(d_in, views[side][:, t], a)
                d_rec[:, : 2 * h] += state.T @ a[:, : 2 * h]
                d_rec[:, 2 * h :] += (reset * state).T @ a_new
                later = g * (1 - update) + a[:, : 2 * h] @ rec[:, : 2 * h].T + through * reset
            grads[f"in_{side}"], grads[f"rec_{side}"] = d_in, d_rec
        return grads, float(loss)


def train(words: list[bytes], target: np.ndarray, often: np.ndarray, languages: list[str], steps: int = 350, batch: int = 384, seed: int = 5) -> Network:
    """Adam steps on batches with every language alike often; ``often`` weighs the words of a language."""
    rng = np.random.default_rng(seed)
    net = Network.blank(languages, rng)
    if len(languages) < 2:
        return net
    first = {k: np.zeros_like(v) for k, v in net.weights.items()}
    second = {k: np.zeros_like(v) for k, v in net.weights.items()}
    by_language = [np.flatnonzero(target == k) for k in range(len(languages))]
    odds = [np.sqrt(often[rows]) / np.sqrt(often[rows]).sum() for rows in by_language]
    for step in range(1, steps + 1):
        each = max(1, batch // len(languages))
        rows = np.concatenate([rng.choice(r, each, p=o) for r, o in zip(by_language, odds, strict=True)])
        grads, _ = net.slopes([words[k] for k in rows], target[rows])
        size = np.sqrt(sum(float((g**2).sum()) for g in grads.values()))
        rate = 0.01 * min(1.0, 2.0 * (1 - step / (steps + 1)) + 0.05)
        for k, g in grads.items():
            g = g * min(1.0, 5.0 / (size + 1e-9))
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g**2
            net.weights[k] -= (rate * first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
    return net


def fit(docs: DataFrame, learn: Column | None = None, sample_docs: int = SAMPLE_DOCS, sample_words: int = SAMPLE_WORDS) -> Network:
    """The network learned from text and lang of rows with both; ``learn`` limits them further."""
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (learn if learn is not None else F.lit(True)))
    chosen = hash_sample(labelled.select("doc_id", "text", "lang"), sample_docs, "doc_id", "text")

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found: dict[tuple[str, str], int] = {}
            for text, lang in zip(part.column("text").to_pylist(), part.column("lang").to_pylist(), strict=True):
                for word in WORDS.findall(text.lower()):
                    found[word, lang] = found.get((word, lang), 0) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in found], pa.string()), pa.array([k[1] for k in found], pa.string()), pa.array(list(found.values()), pa.int64())],
                names=["word", "lang", "n"],
            )

    words = (
        chosen.select("text", "lang").mapInArrow(cut, "word string, lang string, n long")
        .groupBy("word", "lang").agg(F.sum("n").alias("n")).where(F.length("word") <= WINDOW // 4)
    )
    words = hash_sample(words, sample_words, "word", "lang").toPandas().sort_values(["word", "lang"])
    languages = sorted(words["lang"].unique())
    target = words["lang"].map({v: k for k, v in enumerate(languages)}).to_numpy(int)
    return train([w.encode() for w in words["word"]], target, words["n"].to_numpy(float), languages)


class Reader:
    """Sums of the words met so far in a task."""

    def __init__(self, net: Network):
        self.net, self.place = net, {}
        self.table = np.zeros((0, len(net.languages) + 1), np.float32)

    def predict(self, texts_: list[str]) -> list[tuple[str, float]]:
        if not self.net.languages:
            return [("und", 0.0)] * len(texts_)
        if len(self.place) > MEMO:
            self.__init__(self.net)
        cut = [WORDS.findall(t.lower()) for t in texts_]
        new = list({w for words in cut for w in words}.difference(self.place))
        if new:
            self.place.update(zip(new, range(len(self.place), len(self.place) + len(new)), strict=True))
            size = len(self.place)
            if size > len(self.table):
                self.table = np.concatenate([self.table, np.zeros((max(size, 4096), self.table.shape[1]), np.float32)])
            self.table[size - len(new) : size] = self.net.sums(new)
        out = []
        for text, words in zip(texts_, cut, strict=True):
            if not words or not any(map(str.isalpha, words)) and not any(map(str.isalpha, text)):
                out.append(("und", 0.0))
                continue
            total = self.table[np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))].sum(axis=0, dtype=np.float64)
            best = int(np.argmax(total[:-1]))
            out.append((self.net.languages[best], min(1.0, float(total[best] / total[-1]))))
        return out


def predict(docs: DataFrame, net: Network) -> DataFrame:
    """doc_id, lang_pred and score of every document, from its whole text alone."""
    sent = docs.sparkSession.sparkContext.broadcast(net)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(sent.value)
        for part in parts:
            for start in range(0, part.num_rows, 512):
                cut = part.slice(start, 512)
                found = reader.predict(cut.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [cut.column("doc_id"), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                    names=["doc_id", "lang_pred", "score"],
                )

    return texts(docs).mapInArrow(run, "doc_id long, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    """Predictions for all documents, learned from those whose crc32 leaves no 1 modulo 3."""
    remainder = F.coalesce(bucket_of("doc_id", 3), F.lit(-1))
    net = fit(docs, remainder != 1)
    return predict(docs, net).select("doc_id", (remainder == 1).alias("held_out"), "lang_pred", "score")
