"""Word shingles of texts as sorted arrays of distinct 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from sparrowscope.llm.common import mix64, utf8

_SPACES = bytes.maketrans(b"\t\n\v\f\r", b"     ")
# Bytes of text that are split at a time.
_CHUNK = 4 << 20


def word_hashes(texts: list[str | None]) -> list[np.ndarray]:
    """Hashes of the words of each text after lower-casing A to Z. Words are runs of
    characters other than space and the control characters 9 to 13."""
    data = [utf8(text).lower().translate(_SPACES) for text in texts]
    lists = pc.split_pattern(pa.array(data, pa.binary()), b" ")
    coded = lists.values.dictionary_encode()
    words = coded.dictionary.to_pylist()
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(word) for word in words), np.uint64, len(words))
    real = np.fromiter((len(word) > 0 for word in words), bool, len(words))
    places, offsets = coded.indices.to_numpy(), lists.offsets.to_numpy()
    flat, used = hashes[places], real[places]
    return [flat[a:b][used[a:b]] for a, b in zip(offsets[:-1], offsets[1:])]


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of `size` words; a shorter text is one run."""
    if len(words) == 0:
        return words
    width = min(size, len(words))
    runs = np.full(len(words) - width + 1, width, np.uint64)
    for k in range(width):
        runs = mix64(runs ^ words[k : k + len(runs)])
        runs += np.uint64(k + 1)
    return np.unique(runs)


def shingle_sets(texts: list[str | None], size: int) -> Iterator[np.ndarray]:
    at = 0
    while at < len(texts):
        end, total = at, 0
        while end < len(texts) and total < _CHUNK:
            total += len(texts[end] or "")
            end += 1
        for words in word_hashes(texts[at:end]):
            yield shingle_set(words, size)
        at = end


def digest(values: np.ndarray) -> int:
    """Signed 64-bit digest of a set."""
    value = xxhash.xxh3_64_intdigest(values.tobytes())
    return value - (1 << 64) if value >> 63 else value
