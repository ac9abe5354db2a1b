"""Byte-pair encoding and decoding with a public vocabulary that marks word ends.

Method: every short word is held as a contiguous array of parts next to an array with the rank
of each adjacent pair. The encoder scans the ranks for the minimum, deletes that boundary and
refreshes the two neighbouring ranks until no pair has a rank. Words beyond ``SHORT`` parts take
a heap instead of the scan, with the same merges in the same order.

Texts are cut at white space first, which no token crosses. A worker remembers the tokens of
the chunks and of the words it has met, of a bounded number of either.

Defined cases: a null text is an empty one and has no tokens; the strings of special tokens in
a text become their ids; ids outside the vocabulary are skipped when decoding, null ids decode
to an empty text.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

SHORT = 128
#: Most chunks (words with their punctuation) and most words that one worker remembers.
CHUNKS, WORDS = 250_000, 400_000
_NONE = 1 << 60
_WHITE = regex.compile(r"[\t-\r \x85\xa0  -     　]+")


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable ones themselves, others from U+0100 on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    letters, extra = [""] * 256, 256
    for b in range(256):
        if b in shown:
            letters[b] = chr(b)
        else:
            letters[b], extra = chr(extra), extra + 1
    return letters


class Vocabulary:
    """What a tokenizer file says, arranged for encoding and decoding."""

    def __init__(self, text: str) -> None:
        spec = json.loads(text)
        model = spec["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        letters = byte_letters()
        self.inner = [vocab[c] for c in letters]
        self.final = [vocab[c + end] for c in letters]
        self.merges = {}
        for rank, (a, b) in enumerate(model["merges"]):
            self.merges[vocab[a] << 32 | vocab[b]] = (rank, vocab[a + b])
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.tokens: list[str | None] = [None] * size
        for token, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = token
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pieces = regex.compile(split["pattern"]["Regex"])
        self.marks = regex.compile("|".join(map(regex.escape, self.special)) or r"(?!)")

    def merge_short(self, parts: list[int]) -> list[int]:
        """Merge by scanning a contiguous array of adjacent ranks."""
        merges = self.merges
        ranks = [merges.get(a << 32 | b, (_NONE, 0))[0] for a, b in zip(parts, parts[1:], strict=False)]
        while ranks:
            low = min(ranks)
            if low == _NONE:
                break
            i = ranks.index(low)
            parts[i] = merges[parts[i] << 32 | parts[i + 1]][1]
            del parts[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = merges.get(parts[i] << 32 | parts[i + 1], (_NONE, 0))[0]
            if i:
                ranks[i - 1] = merges.get(parts[i - 1] << 32 | parts[i], (_NONE, 0))[0]
        return parts

    def merge_long(self, parts: list[int]) -> list[int]:
        """The same merges from a heap of (rank, position), for words of any length."""
        n, merges = len(parts), self.merges
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = []

        def offer(i: int) -> None:
            j = after[i]
            if j >= 0 and (found := merges.get(parts[i] << 32 | parts[j])):
                heapq.heappush(heap, (found[0], i, parts[i], parts[j], found[1]))

        for i in range(n):
            offer(i)
        while heap:
            _, i, a, b, new = heapq.heappop(heap)
            j = after[i]
            if parts[i] != a or j < 0 or parts[j] != b:
                continue
            parts[i], parts[j] = new, -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return [p for p in parts if p >= 0]

    def word(self, piece: str) -> list[int]:
        raw = piece.encode("utf-8", "surrogatepass")
        parts = [self.inner[b] for b in raw[:-1]] + [self.final[raw[-1]]]
        return self.merge_short(parts) if len(parts) <= SHORT else self.merge_long(parts)


class _Memory(dict):
    """Results by text, forgotten all at once when there are too many."""

    def __init__(self, make: Callable[[str], bytes], most: int) -> None:
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, text: str) -> bytes:
        made = self.make(text)
        if len(text) <= SHORT:
            if len(self) >= self.most:
                self.clear()
            self[text] = made
        return made


class Encoder:
    """Ids of a text, as little-endian 32-bit integers."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.words = _Memory(lambda w: np.asarray(vocabulary.word(w), dtype="<u4").tobytes(), WORDS)
        self.chunks = _Memory(self._chunk, CHUNKS)

    def _chunk(self, chunk: str) -> bytes:
        return b"".join(map(self.words.__getitem__, self.vocabulary.pieces.findall(chunk)))

    def plain(self, text: str) -> bytes:
        # each letter is lowered by itself: the capital sigma never takes its final form
        lowered = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        if any(c in lowered for c in "\x1c\x1d\x1e\x1f"):  # no white space, though split() takes them for it
            chunks = [c for c in _WHITE.split(lowered) if c]
        else:
            chunks = lowered.split()
        return b"".join(map(self.chunks.__getitem__, chunks))

    def __call__(self, text: str) -> bytes:
        v = self.vocabulary
        if "<|" not in text or not v.marks.search(text):
            return self.plain(text)
        out, at = [], 0
        for m in v.marks.finditer(text):
            out += [self.plain(text[at : m.start()]), np.asarray([v.special[m[0]]], dtype="<u4").tobytes()]
            at = m.end()
        return b"".join([*out, self.plain(text[at:])])


def decode_ids(vocabulary: Vocabulary, ids: bytes) -> str:
    """Token strings joined by blanks: the file names no decoder."""
    tokens, known = vocabulary.tokens, len(vocabulary.tokens)
    try:
        return " ".join(map(tokens.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))
    except (IndexError, TypeError):
        found = (tokens[i] for i in np.frombuffer(ids, dtype="<u4").tolist() if i < known)
        return " ".join(t for t in found if t is not None)


_loaded: dict[int, Encoder] = {}


def _encoder(shared) -> Encoder:
    """The broadcast file, parsed once in each worker, and what that worker remembers."""
    if shared.id not in _loaded:
        _loaded.clear()
        _loaded[shared.id] = Encoder(Vocabulary(shared.value))
    return _loaded[shared.id]


class _Shared:
    def __init__(self, broadcast) -> None:
        self.broadcast = broadcast
        self.id = broadcast._jbroadcast.id()

    def __getstate__(self):
        return {"broadcast": self.broadcast, "id": self.id}

    @property
    def value(self) -> str:
        return self.broadcast.value


class Bpe:
    """Column functions for one tokenizer file; the file (1 to 2 MB, of fixed size) is read on
    the driver and broadcast."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            shared = _Shared(spark.sparkContext.broadcast(file.read()))

        @F.pandas_udf("binary")
        def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            encoder = _encoder(shared)
            for texts in batches:
                yield pd.Series([encoder(t or "") for t in texts], dtype=object)

        @F.pandas_udf("string")
        def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            vocabulary = _encoder(shared).vocabulary
            for ids in batches:
                yield pd.Series([decode_ids(vocabulary, i or b"") for i in ids], dtype=object)

        @F.pandas_udf("ids binary, decoded string")
        def both(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            encoder = _encoder(shared)
            for texts in batches:
                ids = [encoder(t or "") for t in texts]
                decoded = [decode_ids(encoder.vocabulary, i) for i in ids]
                yield pd.DataFrame({"ids": ids, "decoded": decoded}, dtype=object)

        self._encode, self._decode, self._both = encode, decode, both

    def encode(self, text: Column) -> Column:
        """Ids as binary, four little-endian bytes each; never null."""
        return self._encode(F.coalesce(text, F.lit("")))

    def decode(self, ids: Column) -> Column:
        return self._decode(ids)

    def round_trip(self, text: Column) -> Column:
        """A struct of the ids and of what they decode to, from one pass through Python."""
        return self._both(F.coalesce(text, F.lit("")))

    @staticmethod
    def count(ids: Column) -> Column:
        return (F.octet_length(ids) / 4).cast("long")
