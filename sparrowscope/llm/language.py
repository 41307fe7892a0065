"""Language identification in two steps: the family first, then the languages within it.

Features are hashed letter trigrams of the whole text, square-rooted and scaled to unit
length. Families are told apart, and the languages of one family, by one-versus-one
linear support vector machines (squared hinge loss). They are fitted on a bounded sample:
about PER_LANGUAGE rows of every language, chosen by the hash of their id.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sparrowscope.llm.common import map_texts, utf8

# Families of closely related languages. Others are a family of their own.
FAMILIES = {
    "en": "germanic", "de": "germanic", "nl": "germanic", "sv": "germanic", "da": "germanic",
    "no": "germanic", "fr": "romance", "es": "romance", "it": "romance", "pt": "romance",
    "ro": "romance", "ca": "romance", "ru": "slavic", "uk": "slavic", "pl": "slavic",
    "cs": "slavic", "sk": "slavic", "bg": "slavic",
}
UNDETERMINED = "und"
PER_LANGUAGE = 1_000
BITS = 12
# Bytes hashed at a time, so that a very long text needs no more memory.
_BLOCK = 1 << 20
# Letters, and signs such as fractions that are no decimal digits either.
_LETTER = re.compile(r"[^\W\d_]")
_KEEP = np.full(256, 32, np.uint32)
_KEEP[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_KEEP[128:] = np.arange(128, 256)


def has_letter(text: str | None) -> bool:
    """Whether a character is in one of Unicode's letter categories."""
    return bool(text) and any(found.group().isalpha() for found in _LETTER.finditer(text))


def trigram_counts(text: str | None) -> np.ndarray:
    """Hashed counts of the byte trigrams of the lower-cased letters, words apart."""
    data = np.frombuffer(b" " + utf8((text or "").lower()) + b" ", np.uint8)
    counts = np.zeros(1 << BITS, np.int64)
    for at in range(0, len(data) - 2, _BLOCK):
        kept = _KEEP[data[at : at + _BLOCK + 2]]
        codes = (kept[:-2] << 16) | (kept[1:-1] << 8) | kept[2:]
        counts += np.bincount((codes * np.uint32(2654435761)) >> np.uint32(32 - BITS), minlength=1 << BITS)
    return counts


def scaled(counts: np.ndarray) -> np.ndarray:
    roots = np.sqrt(counts).astype(np.float32)
    norm = float(np.sqrt((roots * roots).sum()))
    return roots / norm if norm else roots


def fit_pair(x: np.ndarray, sign: np.ndarray, penalty: float = 1e-4, steps: int = 150) -> np.ndarray:
    """Weights (last one: bias) of a linear machine for signs +1 and -1; both classes
    weigh the same. Accelerated gradient steps on the squared hinge loss."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    share = np.where(sign > 0, 0.5 / (sign > 0).sum(), 0.5 / (sign < 0).sum()).astype(np.float32)
    weights = ahead = np.zeros(x.shape[1], np.float32)
    rate = 0.25
    for step in range(steps):
        slack = np.maximum(0, 1 - sign * (x @ ahead))
        gradient = penalty * ahead - 2 * (x.T @ (share * sign * slack))
        new = ahead - rate * gradient
        ahead = new + step / (step + 3) * (new - weights)
        weights = new
    return weights


@dataclass
class Machines:
    """One-versus-one machines among `names`; the winner has most votes, then margin."""

    names: list[str]
    pairs: list[tuple[int, int]] = field(default_factory=list)
    weights: np.ndarray | None = None

    @classmethod
    def fit(cls, names: list[str], x: np.ndarray, labels: np.ndarray) -> Machines:
        pairs = list(combinations(range(len(names)), 2))
        rows = []
        for a, b in pairs:
            use = (labels == names[a]) | (labels == names[b])
            rows.append(fit_pair(x[use], np.where(labels[use] == names[a], 1, -1).astype(np.float32)))
        return cls(names, pairs, np.array(rows, np.float32) if rows else None)

    def predict(self, x: np.ndarray) -> tuple[str, float]:
        if self.weights is None:
            return self.names[0], 1.0
        margins = self.weights[:, :-1] @ x + self.weights[:, -1]
        votes, sums = np.zeros(len(self.names)), np.zeros(len(self.names))
        for (a, b), margin in zip(self.pairs, margins):
            votes[a if margin >= 0 else b] += 1
            sums[a] += margin
            sums[b] -= margin
        best = max(range(len(self.names)), key=lambda i: (votes[i], sums[i], -i))
        least = min(m if a == best else -m for (a, b), m in zip(self.pairs, margins) if best in (a, b))
        return self.names[best], float(1 / (1 + np.exp(-3.0 * least)))


@dataclass
class LanguageModel:
    families: Machines | None
    languages: dict[str, Machines]

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and confidence; undetermined with 0 for texts without a letter."""
        if self.families is None or not has_letter(text):
            return UNDETERMINED, 0.0
        x = scaled(trigram_counts(text))
        family, sure = self.families.predict(x)
        language, also = self.languages[family].predict(x)
        return language, sure * also


def fit(
    docs: DataFrame,
    families: Mapping[str, str] = FAMILIES,
    per_language: int = PER_LANGUAGE,
    id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
) -> LanguageModel:
    """Fit on rows with a language and a letter. What comes to the driver are the hashed
    counts of about `per_language` rows a language: those whose hashed id lies in the
    lowest per_language / rows share."""
    rows = docs.where(docs[lang].isNotNull()).select(
        docs[id].alias("id"), docs[lang].cast("string").alias("lang"), docs[text].alias("text")
    )
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("rows"))
    place = F.pmod(F.xxhash64("id"), F.lit(1 << 40)) / float(1 << 40)
    sample = rows.join(F.broadcast(counts), "lang").where(place * F.col("rows") < per_language)
    sample = sample.select("lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, places, counts = [], [], []
            for language, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if has_letter(value):
                    found = trigram_counts(value)
                    used = np.flatnonzero(found)
                    langs.append(language)
                    places.append(used.astype("<u2").tobytes())
                    counts.append(found[used].astype("<u4").tobytes())
            yield pa.record_batch(
                [pa.array(langs, pa.string()), pa.array(places, pa.binary()), pa.array(counts, pa.binary())],
                names=["lang", "places", "counts"],
            )

    found = map_texts(sample, run, "lang string, places binary, counts binary").collect()
    if not found:
        return LanguageModel(None, {})
    found.sort(key=lambda r: (r["lang"], r["places"], r["counts"]))
    labels = np.array([row["lang"] for row in found], object)
    x = np.zeros((len(found), 1 << BITS), np.float32)
    for k, row in enumerate(found):
        counts = np.zeros(1 << BITS)
        counts[np.frombuffer(row["places"], "<u2")] = np.frombuffer(row["counts"], "<u4")
        x[k] = scaled(counts)
    kin = np.array([families.get(label, label) for label in labels], object)
    names = sorted(set(kin))
    return LanguageModel(
        Machines.fit(names, x, kin),
        {
            name: Machines.fit(sorted(set(labels[kin == name])), x[kin == name], labels[kin == name])
            for name in names
        },
    )


def predict(docs: DataFrame, model: LanguageModel, id: str = "doc_id", text: str = "text") -> DataFrame:
    """id, lang_pred and score of every row. Null texts and texts without a letter are
    `und` with score 0; repeated rows are predicted each on their own; an empty table
    gives an empty result. With nothing to learn from, every text is `und`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [model.predict(value) for value in batch.column(1).to_pylist()]
            yield pa.record_batch(
                [
                    batch.column(0),
                    pa.array([language for language, _ in made], pa.string()),
                    pa.array([score for _, score in made], pa.float64()),
                ],
                names=["id", "lang_pred", "score"],
            )

    rows = docs.select(docs[id].alias("id"), docs[text].alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return map_texts(rows, run, f"id {kind}, lang_pred string, score double").withColumnRenamed("id", id)


def keep_determined(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """The rows whose language can be told, all columns as they are."""
    names = docs.columns
    place = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [model.predict(value)[0] != UNDETERMINED for value in batch.column(place).to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return map_texts(docs, run, docs.schema)
