"""Counts over one text, used by the quality rules and the quality classifier."""

from __future__ import annotations

from collections import Counter

import numpy as np

# Fixed values of the base measures: symbol characters, words per window.
SYMBOLS = "#*$%&|<>"
WINDOW = 3

_BYTES = np.arange(256)
_IS = {
    "blank": np.isin(_BYTES, [32, *range(9, 14)]),
    "symbol": np.isin(_BYTES, [ord(c) for c in SYMBOLS]),
    "upper": (_BYTES >= 65) & (_BYTES <= 90),
    "lower": (_BYTES >= 97) & (_BYTES <= 122),
    "digit": (_BYTES >= 48) & (_BYTES <= 57),
    "stop": np.isin(_BYTES, [ord(c) for c in ".!?"]),
    "bang": _BYTES == ord("!"),
    "wide": _BYTES >= 128,
    "starts": (_BYTES & 0xC0) != 0x80,  # first byte of a character
}


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of three words found at least twice in the text."""
    n = len(words)
    if n <= WINDOW:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, n)
    pairs = ids[:-1] * len(numbers) + ids[1:]
    if len(numbers) >= 1 << 20:  # three numbers would not fit into 63 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * len(numbers) + ids[2:]
    order = np.argsort(windows, kind="stable")
    ranked = windows[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(windows), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    for shift in range(WINDOW):
        covered[shift:shift + len(windows)] |= twice
    return int(covered.sum())


def duplicate_lines(data: bytes) -> tuple[int, int]:
    """Lines with a word, and those of them that equal an earlier line."""
    lines = Counter(line for line in data.split(b"\n") if line and not line.isspace())
    total = sum(lines.values())
    return total, total - len(lines)


class Text:
    """Measures of one text, each computed when it is first asked for."""

    def __init__(self, text: str | None):
        self.data = (text or "").encode()
        self._known: dict[str, object] = {}

    def _once(self, name: str, make):
        if name not in self._known:
            self._known[name] = make()
        return self._known[name]

    @property
    def words(self) -> list[bytes]:
        return self._once("words", self.data.split)

    @property
    def byte_counts(self) -> np.ndarray:
        return self._once("bytes", lambda: np.bincount(np.frombuffer(self.data, np.uint8), minlength=256))

    def count(self, kind: str) -> int:
        return int(self.byte_counts[_IS[kind]].sum())

    @property
    def n_words(self) -> int:
        return len(self.words)

    @property
    def word_chars(self) -> int:
        return self.count("starts") - self.count("blank")

    @property
    def n_symbols(self) -> int:
        return self.count("symbol")

    @property
    def lines(self) -> tuple[int, int]:
        return self._once("lines", lambda: duplicate_lines(self.data))

    @property
    def n_dup_lines(self) -> int:
        return self.lines[1]

    @property
    def n_repeat_words(self) -> int:
        return self._once("repeats", lambda: repeated_words(self.words))

    @property
    def n_distinct(self) -> int:
        return self._once("distinct", lambda: len(set(self.words)))

    @property
    def longest_word(self) -> int:
        return self._once("longest", lambda: max(map(len, self.words), default=0))
