"""Encoding of whole texts with a word-BPE file, by tokenizing each distinct piece of text once.

White space never joins what stands on its two sides: the file's normalizer turns it to a space and the
pre-tokenizer drops it. So a text may be cut there and the ids of its pieces joined. In ASCII and the
accented Latin letters, already composed, a word not met before is cut further, at the file's own pre-token
borders after lower-casing. Other texts, and those holding a special token's string, are cut at spaces only.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import lru_cache

import numpy as np

#: Entries of each kind that a worker remembers: bounds its memory.
MEMO = 600_000
PLAIN = re.compile(r"[\t\n\r\x20-\x7eÀ-ÖØ-öø-ÿ]*")
#: Contraction endings and character classes of the public tokenizer file's split pattern.
FINE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9]+")
COARSE = re.compile(r"[^ \t\n\r\x0b\x0c]+")
SPECIAL = "<|"
MARKS = ".,;:!?"
#: Bytes that are no printable Latin-1 character are written as characters from 256 on, in their order.
UNPRINTED = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174)]
BYTE_CHARS = {b: 256 + k for k, b in enumerate(UNPRINTED)}


class Memo:
    """ids of pieces. When half of ``MEMO`` is new, what was older is dropped and the rest kept as old, so pieces
    that come again stay."""

    def __init__(self, learn: Callable[[list[str]], list[bytes]]):
        self.learn = learn
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def prepare(self, pieces: set[str]) -> None:
        """Have the ids of all pieces at hand."""
        missing = pieces.difference(self.new)
        if not missing:
            return
        if self.new and len(self.new) + len(missing) > MEMO // 2:
            self.old, self.new, missing = self.new, {}, pieces
        again = missing & self.old.keys()
        self.new.update(zip(again, map(self.old.__getitem__, again), strict=True))
        unknown = list(missing - again)
        self.new.update(zip(unknown, self.learn(unknown), strict=True))

    def joined(self, pieces: list[str]) -> bytes:
        return b"".join(map(self.new.__getitem__, pieces))


class WordCodec:
    """ids of a text as little-endian unsigned 32-bit integers, and their decoding."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.tokens = [b""] * (max(vocab.values()) + 1)
        for token, number in vocab.items():
            self.tokens[number] = token.encode()
        raw = np.arange(len(self.tokens), dtype="<u4").tobytes()
        self.four_bytes = [raw[k : k + 4] for k in range(0, len(raw), 4)]
        self.words, self.fine, self.coarse = Memo(self.learn_words), Memo(self.learn_fine), Memo(self.learn_coarse)

    def cut(self, text: str) -> tuple[list[str], Memo]:
        if SPECIAL not in text and PLAIN.fullmatch(text):
            return text.lower().split(), self.words
        return COARSE.findall(text), self.coarse

    def encode(self, text: str) -> bytes:
        """ids of the whole text, four bytes each."""
        pieces, memo = self.cut(text)
        memo.prepare(set(pieces))
        return memo.joined(pieces)

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """As ``encode``, with the unknown pieces of all texts tokenized in one go."""
        cut = [self.cut(t) for t in texts]
        for memo in (self.words, self.coarse):
            memo.prepare(set().union(*(pieces for pieces, own in cut if own is memo)))
        return [memo.joined(pieces) for pieces, memo in cut]

    def learn_words(self, words: list[str]) -> list[bytes]:
        """A word of letters alone, or with one mark behind them, is one piece or two; others are cut."""
        cut = {w: FINE.findall(w) for w in words if not w.isalpha() and not (w[-1] in MARKS and w[:-1].isalpha())}
        pieces = {p for own in cut.values() for p in own}
        pieces.update(w if w[-1] not in MARKS else w[:-1] for w in words if w not in cut)
        pieces.update(MARKS)
        self.fine.prepare(pieces)
        ids = self.fine.new
        return [ids[w] if w.isalpha() else ids[w[:-1]] + ids[w[-1]] if w not in cut else self.fine.joined(cut[w]) for w in words]

    def learn_coarse(self, words: list[str]) -> list[bytes]:
        return [np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes() for word in words]

    def learn_fine(self, words: list[str]) -> list[bytes]:
        """Tokenize new pre-tokens: they are what the file's own splitting gives, so its model alone is asked, on
        their bytes written as the file writes them."""
        model, ids = self.tokenizer.model, self.four_bytes
        spelled = (w if w.isascii() else w.encode().decode("latin-1").translate(BYTE_CHARS) for w in words)
        return [b"".join([ids[t.id] for t in model.tokenize(w)]) for w in spelled]

    def decode(self, ids: bytes) -> bytes:
        """UTF-8 of the decoded text: the file names no decoder, so tokens are joined by spaces."""
        return b" ".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def codec(path: str) -> WordCodec:
    """One codec for each worker and file; the file must be at ``path`` on every machine."""
    return WordCodec(path)
