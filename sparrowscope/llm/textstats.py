"""Statistics of one text, each computed when first asked for."""

from __future__ import annotations

from functools import cached_property

import numpy as np

from sparrowscope.llm.common import utf8

# The symbols that the quality rules count.
SYMBOLS = b"#*$%&|<>"

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True
_UPPER = np.zeros(256, bool)
_UPPER[ord("A") : ord("Z") + 1] = True
_LOWER = np.zeros(256, bool)
_LOWER[ord("a") : ord("z") + 1] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[ord("0") : ord("9") + 1] = True
_HIGH = np.arange(256) >= 128
_LEAD = _HIGH & (np.arange(256) >= 192)
_END = np.zeros(256, bool)
_END[list(b".!?")] = True


class Text:
    """A text with lazily computed statistics. Words are runs of characters other
    than space and the control characters 9 to 13."""

    def __init__(self, text: str | None):
        self.text = text or ""

    @cached_property
    def data(self) -> bytes:
        return utf8(self.text)

    @cached_property
    def words(self) -> list[bytes]:
        return self.data.split()

    @cached_property
    def counts(self) -> np.ndarray:
        return np.bincount(np.frombuffer(self.data, np.uint8), minlength=256)

    def count(self, mask: np.ndarray) -> int:
        return int(self.counts[mask].sum())

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - self.count(_SPACE)

    @cached_property
    def n_symbols(self) -> int:
        return self.count(_SYMBOL)

    @cached_property
    def n_letters(self) -> int:
        return self.count(_UPPER | _LOWER | _LEAD)

    @cached_property
    def n_upper(self) -> int:
        return self.count(_UPPER)

    @cached_property
    def n_digits(self) -> int:
        return self.count(_DIGIT)

    @cached_property
    def n_high(self) -> int:
        return self.count(_LEAD)

    @cached_property
    def n_ends(self) -> int:
        return self.count(_END)

    @cached_property
    def lines(self) -> list[bytes]:
        return [line for line in self.data.split(b"\n") if line.strip()]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def word_ids(self) -> np.ndarray:
        known: dict[bytes, int] = {}
        return np.fromiter(
            (known.setdefault(word, len(known)) for word in self.words), np.int64, len(self.words)
        )

    @cached_property
    def n_distinct_words(self) -> int:
        return int(self.word_ids.max()) + 1 if self.n_words else 0

    @cached_property
    def n_repeat_words(self) -> int:
        """Words inside a three-word window that occurs at least twice, every
        occurrence counted."""
        if self.n_words < 4:
            return 0
        ids, base = self.word_ids, self.n_distinct_words
        pairs = ids[:-1] * base + ids[1:]
        if base > 1 << 20:
            pairs = np.unique(pairs, return_inverse=True)[1]
        codes = pairs[:-1] * base + ids[2:]
        order = np.argsort(codes, kind="stable")
        ranked = codes[order]
        same = ranked[1:] == ranked[:-1]
        if not same.any():
            return 0
        repeated = np.zeros(len(codes), bool)
        repeated[order[1:][same]] = True
        repeated[order[:-1][same]] = True
        covered = np.zeros(self.n_words, bool)
        for shift in range(3):
            covered[shift : shift + len(codes)] |= repeated
        return int(covered.sum())
