"""Language of texts: multinomial naive Bayes over hashed character n-grams.

A text is lower-cased, every run of other characters than letters becomes one space, and all
its n-grams of 1 to 4 characters are hashed into buckets. Learning counts buckets per language
in one pass over all documents that may be learned from: a task emits one array per language,
arrays are added up on the executors. The log-probabilities are broadcast, their size is
bounded by ``MATRIX_BYTES`` whatever the number of languages, and texts are scored as sparse
rows against that matrix.

Null and letterless texts are ``und`` with score 0, without anything learned every text is.
Ties go to the language that sorts first. Repeated rows count and are returned as often as they
come. Texts of any length are read whole, piece by piece. Columns beside the named ones are
neither read nor in the way.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isotherm.operators.partials import merge_arrays, task_part

#: n-gram lengths, buckets at most, additive smoothing, bytes of the broadcast matrix at most.
LENGTHS, BUCKETS, SMOOTHING, MATRIX_BYTES = (1, 2, 3, 4), 1 << 16, 0.1, 64 << 20
#: Characters of a text, and n-grams of a batch, that are held at once.
PIECE, HELD = 1 << 18, 1 << 20
UNKNOWN = "und"


@cache
def _letters() -> np.ndarray:
    """For every code point: is it a letter?"""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def normal(text: str) -> Iterator[np.ndarray]:
    """Code points of the text in pieces: lower-case letters, one space for whatever is between."""
    letters, last = _letters(), 32
    yield np.array([32], np.uint32)
    for start in range(0, len(text), PIECE):
        codes = np.frombuffer(text[start : start + PIECE].lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = np.where(letters[codes], codes, np.uint32(32))
        keep = codes != 32
        keep |= np.concatenate(([last], codes[:-1])) != 32
        if len(codes):
            last = codes[-1]
        yield codes[keep]
    if last != 32:
        yield np.array([32], np.uint32)


def grams(text: str, buckets: int) -> Iterator[np.ndarray]:
    """Buckets of all n-grams of a text, piece by piece; none if it has no letter."""
    left, shift = np.zeros(0, np.uint32), np.uint32(32 - (buckets.bit_length() - 1))
    pieces = normal(text)
    for codes in pieces:
        both = np.concatenate((left, codes))
        # an n-gram belongs to the piece that holds its last character
        for n in LENGTHS:
            first = max(0, len(left) - n + 1)
            size = len(both) - first - n + 1
            if size <= 0:
                continue
            h = np.full(size, n * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
            for j in range(n):
                h = (h ^ both[first + j : first + j + size]) * np.uint32(0x01000193)
                h ^= h >> np.uint32(15)
            yield (h * np.uint32(0x85EBCA6B)) >> shift
        left = both[max(0, len(both) - max(LENGTHS) + 1) :]


def has_letter(text: str | None) -> bool:
    return text is not None and any(c.isalpha() for c in text)


@dataclass
class Model:
    languages: list[str]
    log_prior: np.ndarray
    #: languages x buckets
    log_share: np.ndarray


def _buckets(languages: int, most: int) -> int:
    """The largest power of two up to ``most`` with which the matrix stays within its bound."""
    while most > 256 and languages * most * 8 > MATRIX_BYTES:
        most //= 2
    if languages * most * 8 > MATRIX_BYTES:
        raise ValueError(f"{languages} languages are too many for one matrix")
    return most


def fit(
    docs: DataFrame, *, learn: Column | None = None, text: str = "text", lang: str = "lang",
    buckets: int = BUCKETS, smoothing: float = SMOOTHING,
) -> Model:
    """Learns from all rows where ``learn`` holds that have a language and a letter.

    The shares come from the whole of these rows, no sample. One row per language and one
    array of ``buckets`` counts per language reach the driver.
    """
    rows = docs if learn is None else docs.filter(learn)
    rows = rows.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))
    rows = rows.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    found = [r["lang"] for r in rows.select("lang").distinct().collect()]
    if not found:
        return Model([], np.zeros(0), np.zeros((0, buckets)))
    buckets = _buckets(len(found), buckets)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for value, language in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                value = value.as_py()
                if not has_letter(value):
                    continue
                # the last place counts texts
                total = totals.setdefault(language, np.zeros(buckets + 1, np.int64))
                total[-1] += 1
                held, size = [], 0
                for part in grams(value, buckets):
                    held.append(part)
                    size += len(part)
                    if size >= HELD:
                        total[:-1] += np.bincount(np.concatenate(held), minlength=buckets)
                        held, size = [], 0
                if held:
                    hit, times = np.unique(np.concatenate(held), return_counts=True)
                    total[hit] += times
        if totals:
            part = pa.array([task_part()] * len(totals), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(totals)), part, pa.array(list(totals.values()), pa.list_(pa.int64()))], names=["lang", "part", "counts"]
            )

    partials = rows.mapInArrow(count, "lang string, part long, counts array<long>")
    merged = merge_arrays(partials, ["lang"], ["counts"], parts=rows.rdd.getNumPartitions())
    counted = sorted((r["lang"], np.array(r["counts"], dtype=float)) for r in merged.toLocalIterator())
    if not counted:
        return Model([], np.zeros(0), np.zeros((0, buckets)))
    all_counts = np.stack([c for _, c in counted])
    seen, texts = all_counts[:, :-1] + smoothing, all_counts[:, -1]
    return Model([lang for lang, _ in counted], np.log(texts / texts.sum()), np.log(seen / seen.sum(axis=1, keepdims=True)))


def log_scores(texts: Iterable[str | None], model: Model) -> np.ndarray:
    """Joint log-probability per text and language: a sparse product, ``HELD`` n-grams at a time."""
    texts = list(texts)
    out = np.tile(model.log_prior, (len(texts), 1))
    held: list[np.ndarray] = []
    owners: list[int] = []
    size = 0

    def flush() -> None:
        if held:
            starts = np.concatenate(([0], np.cumsum([len(h) for h in held])[:-1]))
            hits = np.concatenate(held)
            for j, share in enumerate(model.log_share):
                np.add.at(out[:, j], owners, np.add.reduceat(share[hits], starts))

    for i, value in enumerate(texts):
        for part in grams(value, model.log_share.shape[1]) if has_letter(value) else ():
            if len(part):
                held.append(part)
                owners.append(i)
                size += len(part)
            if size >= HELD:
                flush()
                held, owners, size = [], [], 0
    flush()
    return out


def classify(texts: Iterable[str | None], model: Model) -> tuple[list[str], np.ndarray]:
    """Most probable language of each text and its posterior probability."""
    texts = list(texts)
    if not model.languages:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    scores = log_scores(texts, model)
    best = scores.argmax(axis=1) if len(texts) else np.zeros(0, int)
    top = scores[np.arange(len(texts)), best]
    posterior = 1.0 / np.exp(scores - top[:, None]).sum(axis=1)
    known = np.array([has_letter(t) for t in texts], bool)
    return [model.languages[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)], np.where(known, posterior, 0.0)


def scorer(docs: DataFrame, model: Model) -> Callable[[Column], Column]:
    """A column function: ``lang_pred string, score double`` of a text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def score(texts: pd.Series) -> pd.DataFrame:
        names, scores = classify([None if t is None or t != t else t for t in texts], shared.value)
        return pd.DataFrame({"lang_pred": names, "score": scores})

    return lambda text: score(text.cast("string"))
