"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Terms are lower-cased words and the 5- and 6-letter pieces inside words. All terms of the
labelled examples make the vocabulary, which the bounded sample alone bounds; their document
frequencies are counted over all documents. Terms are told apart by 64-bit hashes, taken of whole arrays of
letters; equal words of a batch are looked up once. Examples are put into blocks of like ones; the index holds the postings of
every term and, for terms in more than a few examples, the largest weight in each block. A query reads its rarer
terms first; blocks whose upper bound stays below the k-th best then known are left out. Texts are scored many
together, so where a term is in many examples of a block, its weights are rows of a matrix that meets all of them at once. These
sums choose the candidates, with room for rounding; cosines of candidates are summed again in double precision, so the
neighbours are exact, ties going to the lower example. Votes weigh 1 / (distance + ``SOFT``) times the example's weight. A monotone fit (pool
adjacent violators) on examples scored against all others, on the executors, turns votes into probabilities; a text without any neighbour gets the rate of the
examples without one, smoothed by one example of the overall rate.

The labelled sample is bounded: at most ``toxic`` + ``clean`` examples, those with the smallest hash
of the key. Index, vocabulary and calibration follow from these bounds and are broadcast. An
example weighs the inverse of its class's drawing share (1 on average) in votes, in the monotone fit and in the
score without a neighbour, so scores mean rates among all labels, whatever the bounds.

Defined cases: null and empty texts have no terms and get the score of texts without a
neighbour. An example with a null label or text is no example; a document labelled twice counts as
toxic if any label says so. Without a toxic example every score is 0.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import cache
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isotherm.llm.common import drawn

COMMON, NEAREST, SOFT = 16, 15, 0.02
PIECES = (5, 6)
#: Blocks of like examples at most, and so many examples in one on average at least.
BLOCKS, BLOCK = 4, 64
#: Shares of a block's examples from which a term's weights there are kept as full rows, by tier.
TIERS = (0.16, 0.32)
#: Reading one posting costs about as much as so many products of a full row.
POSTING = 400
#: Code points and queries that are handled at once.
PORTION, TOGETHER = 1 << 17, 256
#: Neighbouring terms whose document frequencies travel in one row.
SLICE = 4096
_WORD = re.compile(r"[^\W\d_]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def terms_of(chunk: str) -> set[str]:
    """Words of a lower-cased stretch without white space, and the pieces of their letters."""
    out = set()
    for w in _WORD.findall(chunk):
        out.add(w)
        for n in PIECES:
            out.update("~" + w[i : i + n] for i in range(len(w) - n + 1))
    return out


def mixed(h: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64 bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@cache
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """For every code point 1 for a letter of words, 2 for white space, else 0; and a random number."""
    every = "".join(map(chr, range(sys.maxunicode + 1)))
    kind = np.zeros(len(every), np.uint8)
    for value, found in ((1, _WORD), (2, re.compile(r"\s+"))):
        for m in found.finditer(every):
            kind[m.start() : m.end()] = value
    return kind, mixed(np.arange(1, len(every) + 1, dtype=np.uint64) * _BASE)


def portions(texts: list[str]) -> Iterator[list[str]]:
    """Neighbouring texts of about ``PORTION`` code points together."""
    part, size = [], 0
    for t in texts:
        if part and size + len(t) > PORTION:
            yield part
            part, size = [], 0
        part.append(t)
        size += len(t) + 1
    if part:
        yield part


def _within(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... for each of the sizes, one after the other."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


@dataclass
class Occurrences:
    """Words of some texts, chunk by chunk, and the terms of the different ones by their hashes;
    ``terms_of`` defines them."""

    text: str  # the lower-cased texts, a line feed between them
    doc: np.ndarray  # of each word in the texts, as are chunk and spelt, the number of the different word
    chunk: np.ndarray
    spelt: np.ndarray
    word: np.ndarray  # of each term of a different word, as are hash, at and size
    hash: np.ndarray
    at: np.ndarray
    size: np.ndarray  # letters; of a whole word 0

    @classmethod
    def of(cls, texts: list[str]) -> Occurrences:
        kinds, numbers = _letters()
        texts = [t.lower() for t in texts]
        text = "\n".join(texts)
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        kind, number = kinds[points], numbers[points]
        letter = kind == 1
        step = np.diff(letter.view(np.int8), prepend=np.int8(0), append=np.int8(0))
        begin, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        size = end - begin
        chunk = np.cumsum(kind == 2, dtype=np.int32)[begin]
        ends = np.cumsum([len(t) + 1 for t in texts])
        doc = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(begin, ends), prepend=0))
        power = np.cumprod(np.full(int(size.max(initial=1)), _BASE))
        first = np.cumsum(size) - size
        whole = np.add.reduceat(number[letter] * power[_within(size)], first) if len(begin) else np.zeros(0, np.uint64)
        whole, one, spelt = np.unique(whole, return_index=True, return_inverse=True)
        begin, size, words = begin[one], size[one], np.arange(len(one))
        word, hashes, at, sizes = [words], [mixed(whole)], [begin], [np.zeros(len(begin), np.int64)]
        rolled = number
        for n in range(2, max(PIECES) + 1):
            rolled = rolled[:-1] * _BASE + number[n - 1 :]
            if n in PIECES:
                many = np.maximum(size - n + 1, 0)
                own = np.repeat(words, many)
                place = begin[own] + _within(many)
                word.append(own)
                hashes.append(mixed(rolled[place] ^ np.uint64(n)))
                at.append(place)
                sizes.append(np.full(len(own), n))
        return cls(text, doc, chunk, spelt, *(np.concatenate(x) for x in (word, hashes, at, sizes)))

    def term(self, i: int) -> str:
        a, n = int(self.at[i]), int(self.size[i])
        return "~" + self.text[a : a + n] if n else _WORD.match(self.text, a).group()


class Vocabulary:
    """Numbers of terms by their 64-bit hashes, which are given in the order of the numbers."""

    def __init__(self, hashes: np.ndarray) -> None:
        order = np.argsort(hashes, kind="stable")
        self.hash, self.number = hashes[order], order.astype(np.int32)
        bits = max(1, len(hashes).bit_length())
        self.shift = np.uint64(64 - bits)
        self.slot = np.searchsorted(self.hash >> self.shift, np.arange((1 << bits) + 1, dtype=np.uint64)).astype(np.int32)

    def __len__(self) -> int:
        return len(self.hash)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each hash, -1 for one that no term has."""
        slot = (hashes >> self.shift).astype(np.int64)
        at, end = self.slot[slot], self.slot[slot + 1]
        out = np.full(len(hashes), -1, np.int32)
        left = np.flatnonzero(at < end)
        at, end = at[left], end[left]
        while len(left):
            hit = self.hash[at] == hashes[left]
            out[left[hit]] = self.number[at[hit]]
            more = ~hit
            at = at + 1
            more &= at < end
            left, at, end = left[more], at[more], end[more]
        return out

    def counts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where each text's terms begin (and the last ones end), term numbers in rising order, and
        in how many chunks of the text each occurs."""
        begin, terms, tf = [np.zeros(1, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
        for part in portions(texts):
            found = Occurrences.of(part)
            number = self.find(found.hash)
            known = np.flatnonzero(number >= 0)
            known = known[np.argsort(found.word[known], kind="stable")]
            number, many = number[known], np.bincount(found.word[known], minlength=int(found.spelt.max(initial=-1)) + 1)
            sizes = many[found.spelt]
            word = np.repeat(np.arange(len(sizes)), sizes)
            number = number[np.repeat((np.cumsum(many) - many)[found.spelt], sizes) + _within(sizes)].astype(np.int64)
            by_chunk, by_term = (int(x).bit_length() for x in (found.chunk.max(initial=0), len(self)))
            key = np.sort((((found.doc[word] << by_term) | number) << by_chunk) | found.chunk[word])
            key = key[np.diff(key, prepend=-1) != 0] >> by_chunk
            first = np.flatnonzero(np.diff(key, prepend=-1))
            key, n = key[first], np.diff(first, append=len(key))
            begin.append(begin[-1][-1] + np.searchsorted(key >> by_term, np.arange(1, len(part) + 1)))
            terms.append(key & ((1 << by_term) - 1))
            tf.append(n.astype(np.int32))
        return np.concatenate(begin), np.concatenate(terms), np.concatenate(tf)


def damped(tf: np.ndarray) -> np.ndarray:
    return 1 + np.log(tf, dtype=np.float64)


def weighted(terms: np.ndarray, tf: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Term numbers, unit-length weights (1 + ln tf) * idf, and the length they had."""
    w = damped(tf) * idf[terms]
    norm = float(np.sqrt(w @ w))
    return terms, w / norm if norm else w, norm


class BlockMaxIndex:
    """Examples by their terms; the k of highest cosine, exactly, for many queries at once.

    The weight of an example's term is ``damp`` of the given value times ``per_term`` times ``per_example``.
    Values are few, so their numbers are held. What speeds up reading is made where it is used (``Blocks``).
    """

    def __init__(
        self, examples: list[tuple[np.ndarray, np.ndarray]], n_terms: int, *, damp: Callable[[np.ndarray], np.ndarray] | None = None,
        per_term: np.ndarray | None = None, per_example: np.ndarray | None = None,
    ) -> None:
        self.n, self.n_terms = len(examples), n_terms
        self.per_term = np.ones(n_terms) if per_term is None else per_term
        self.per_example = np.ones(self.n) if per_example is None else per_example
        values = np.unique(np.concatenate([np.unique(v) for _, v in examples] or [np.zeros(0)]))
        small = np.uint16 if len(values) <= 1 << 16 else np.uint32
        self.given, self.values = values, damp(values) if damp else values
        self.begin = np.concatenate([[0], np.cumsum([len(t) for t, _ in examples], dtype=np.int64)]).astype(np.int64)
        self.term, self.code = np.empty(int(self.begin[-1]), np.int32), np.empty(int(self.begin[-1]), small)
        df = np.zeros(n_terms, np.int64)
        self.copy = np.zeros(self.n, np.int32)  # how many equal examples stand directly before this one
        for i, (t, v) in enumerate(examples):
            a, b = self.begin[i], self.begin[i + 1]
            self.term[a:b], self.code[a:b] = t, np.searchsorted(values, v)
            df[t] += 1  # a term occurs once in an example
            if i:
                z = self.begin[i - 1]
                if np.array_equal(self.term[a:b], self.term[z:a]) and np.array_equal(self.code[a:b], self.code[z:a]):
                    self.copy[i] = self.copy[i - 1] + 1
        self.common = df * COMMON > self.n
        self._blocks: Blocks | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_blocks": None}

    def example_counts(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Terms and the given values of an example."""
        at = slice(self.begin[i], self.begin[i + 1])
        return self.term[at], self.given[self.code[at]]

    def cosines(self, ids: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Of the given examples, every product and sum in double precision, terms in rising order, common ones last."""
        query, asked = self.blocks.query, self.blocks.asked
        query[terms], asked[terms] = weights, True
        out = []
        for part in np.array_split(ids, -(-len(ids) // 64)):
            # of an example only the terms that were asked for
            some = [a + np.flatnonzero(asked.take(self.term[a:b])) for a, b in zip(self.begin[part].tolist(), self.begin[part + 1].tolist(), strict=True)]
            at = np.concatenate(some)
            t, code = self.term[at], self.code[at]
            kind = 2 * np.repeat(np.arange(len(part)), [len(x) for x in some]) + self.common[t]
            sums = np.bincount(kind, query[t] * self.values[code], minlength=2 * len(part)).reshape(-1, 2)
            out.append(sums[:, 0] * self.per_example[part] + sums[:, 1] * self.per_example[part])
        asked[terms] = False
        return np.concatenate(out)

    @property
    def blocks(self) -> Blocks:
        if self._blocks is None:
            self._blocks = Blocks(self)
        return self._blocks

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int, skip: np.ndarray | None = None, visit: int = 2) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of highest positive cosine, exactly; ``skip`` marks some as absent."""
        return next(self.nearest_of([(terms, weights)], k, [skip], visit))

    def nearest_of(self, queries: list, k: int, skip: list | None = None, visit: int = 2) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``nearest`` of many (terms, weights). ``visit`` blocks of the highest upper bounds are read
        first; any other only if its bound reaches the k-th best of what is known then."""
        skip = skip or [None] * len(queries)
        queries = [(t, w * self.per_term[t]) for t, w in queries]
        none = np.zeros(0, np.int64), np.zeros(0)
        if not self.n:
            yield from (none for _ in queries)
            return
        total = self.blocks.sums(queries, k, skip, visit)
        for (t, w), absent, row in zip(queries, skip, total, strict=True):
            least = np.partition(row, self.n - k)[self.n - k] if self.n > k else 0.0
            at = np.flatnonzero((row >= least * (1 - 2 * self.blocks.off(len(t)))) & (row > 0))
            ids = np.sort(self.blocks.order[at])
            # of equal examples the first ones win
            ids = ids[self.copy[ids] < k + (0 if absent is None else len(absent))]
            if not len(ids):
                yield none
                continue
            cosine = self.cosines(ids, t, w)
            best = np.lexsort((ids, -cosine))[:k]
            yield ids[best], cosine[best]


class Blocks:
    """Like examples as blocks, a term's largest weight in each, and weights laid out for reading.

    Terms of few examples have postings only. For the others each block has its stretch of the
    postings, its largest weight and, if the term is in many of its examples, a full row of weights, in tiers
    of similar share. A query reads its rare terms first. Of a block that may hold any of the k
    best it reads the rest: tier by tier either the postings or, together with other queries, all rows
    as one product of matrices, whichever is less work. A posting is one number, the weight
    in its upper and the place of the example in its lower half. No weight is negative, so sums in
    single precision are ``off`` by a share of themselves at most.
    """

    def __init__(self, index: BlockMaxIndex) -> None:
        n, n_terms = index.n, index.n_terms
        sizes = np.diff(index.begin)
        df = np.bincount(index.term, minlength=n_terms)
        wide = np.flatnonzero(df >= max(24, n // 256))
        self.row = np.full(n_terms, -1, np.int32)
        self.row[wide] = np.arange(len(wide))
        self.query, self.asked = np.zeros(n_terms), np.zeros(n_terms, bool)
        self.half = 16 if n <= 1 << 16 else 32

        owner = np.repeat(np.arange(n, dtype=np.int32), sizes)
        group = self._groups(index, df, owner)
        self.order = np.argsort(group, kind="stable")
        self.place = np.empty(n, np.int32)
        self.place[self.order] = np.arange(n)
        size = np.bincount(group)
        self.edge = np.concatenate([[0], np.cumsum(size)])
        blocks = len(size)

        bits, codes = n.bit_length(), len(index.values).bit_length()
        del owner
        key = index.term.astype(np.int64)
        key <<= bits
        key |= np.repeat(self.place, sizes)
        key <<= codes
        key |= index.code
        key.sort()
        self.start = np.concatenate([[0], np.cumsum(df)])
        self.posting = np.empty(len(key), np.uint32 if self.half == 16 else np.uint64)
        scale, values = index.per_example[self.order].astype(np.float32), index.values.astype(np.float32)
        for a in range(0, len(key), 1 << 18):
            some = key[a : a + (1 << 18)]
            at = (some >> codes) & ((1 << bits) - 1)
            weight = (values[some & ((1 << codes) - 1)] * scale[at]).view(np.uint32)
            if self.half == 16:  # rounded to 8 binary digits
                weight = (weight + np.uint32(1 << 15)) & np.uint32(0xFFFF0000)
            self.posting[a : a + (1 << 18)] = (weight if self.half == 16 else weight.astype(np.uint64) << np.uint64(32)) | at.astype(self.posting.dtype)
        del key

        # per common term and block: where its postings begin, its largest weight, its tier and row
        self.many, self.most = np.zeros((blocks, len(wide)), np.int32), np.zeros((blocks, len(wide)), np.float32)
        parts = np.split(wide, np.flatnonzero(np.diff(np.cumsum(df[wide]) >> 18)) + 1)
        block_of = np.repeat(np.arange(blocks), size)
        for part in parts:
            row, at, weight = self._stretches(part, df)
            cell = block_of[at], row
            np.add.at(self.many, cell, 1)
            np.maximum.at(self.most, cell, weight)
        self.cell = (self.start[wide] + np.cumsum(self.many, axis=0) - self.many).astype(np.int64)
        share = self.many / size[:, None]
        self.tier = np.where(size[:, None] < 32, 0, np.searchsorted(TIERS, share, side="right")).astype(np.int8)
        by_tier = np.argsort(self.tier, axis=1, kind="stable")
        column = np.empty((blocks, len(wide)), np.int32)
        np.put_along_axis(column, by_tier, np.arange(len(wide), dtype=np.int32)[None, :], axis=1)
        ends = np.array([np.bincount(t, minlength=len(TIERS) + 1) for t in self.tier]).cumsum(axis=1)
        self.column = column - ends[:, :1].astype(np.int32)  # below 0 for tier 0
        self.ends = ends - ends[:, :1]
        self.full = [np.zeros((self.ends[b, -1], size[b]), np.float32) for b in range(blocks)]
        for part in parts:
            row, at, weight = self._stretches(part, df)
            block = block_of[at]
            column = self.column[block, row]
            for b in range(blocks):
                own = np.flatnonzero((block == b) & (column >= 0))
                self.full[b][column[own], at[own] - self.edge[b]] = weight[own]
        #: postings from which a tier's rows are read rather than these
        self.worth = np.concatenate([np.full((blocks, 1), np.inf), np.diff(self.ends) * size[:, None] / POSTING], axis=1)

    def off(self, n: int) -> float:
        """The largest share by which a sum of n products may be off."""
        return (n + 64) * 2.0**-23 + (1.01 * 2.0**-8 if self.half == 16 else 0)

    def _split(self, posting: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and weights of postings."""
        if self.half == 16:
            return (posting & np.uint32(0xFFFF)).astype(np.int64), (posting & np.uint32(0xFFFF0000)).view(np.float32)
        return (posting & np.uint64(0xFFFFFFFF)).astype(np.int64), (posting >> np.uint64(32)).astype(np.uint32).view(np.float32)

    def _stretches(self, terms: np.ndarray, df: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows, places and weights of all postings of some common terms."""
        at = np.repeat(self.start[terms], df[terms]) + _within(df[terms])
        return np.repeat(self.row[terms], df[terms]), *self._split(self.posting[at])

    @staticmethod
    def _groups(index: BlockMaxIndex, df: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Groups of examples with like frequent terms, by a few rounds of spherical k-means."""
        k = min(BLOCKS, -(-index.n // BLOCK))
        top = np.argsort(-df, kind="stable")[:512]
        column = np.full(index.n_terms, -1, np.int32)
        column[top] = np.arange(len(top))
        at = np.flatnonzero(column[index.term] >= 0)
        x = np.zeros((index.n, len(top)), np.float32)
        x[owner[at], column[index.term[at]]] = 1
        x /= np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1e-9)
        long = np.argsort(-np.diff(index.begin), kind="stable")[: -(-index.n // 2)]
        centre = x[long[:1]]
        for _ in range(k - 1):  # far from the others, but no outlier
            near = (x[long] @ centre.T).max(1)
            centre = np.vstack([centre, x[long[np.argsort(near, kind="stable")[len(long) // 50]]]])
        for _ in range(8):
            group = (x @ centre.T).argmax(1)
            for g in range(k):
                if (group == g).any():
                    centre[g] = x[group == g].sum(0)
            centre /= np.maximum(np.sqrt((centre * centre).sum(1, keepdims=True)), 1e-9)
        return np.unique(group, return_inverse=True)[1]

    def _read(self, begin: np.ndarray, sizes: np.ndarray, weights: np.ndarray) -> np.ndarray:
        at = np.repeat(begin - (np.cumsum(sizes) - sizes), sizes)
        at += np.arange(len(at))
        place, weight = self._split(self.posting[at])
        weight *= np.repeat(weights, sizes)
        return np.bincount(place, weight, minlength=len(self.order))

    def sums(self, queries: list, k: int, skip: list, visit: int) -> np.ndarray:
        """For every query and place; of blocks that can't hold one of the k best the rare terms only."""
        n, blocks = len(self.order), len(self.full)
        total = np.zeros((len(queries), n), np.float32)
        rest, bound = [], np.zeros((len(queries), blocks))
        for q, (terms, weights) in enumerate(queries):
            row, w = self.row[terms], weights.astype(np.float32)
            rare = row < 0
            t = terms[rare]
            total[q] = self._read(self.start[t], self.start[t + 1] - self.start[t], w[rare])
            rest.append((row[~rare], w[~rare]))
            self._leave(total, q, skip)
            bound[q] = np.maximum.reduceat(total[q], self.edge[:-1]) + self.most[:, rest[q][0]] @ rest[q][1]
        rank = np.argsort(np.argsort(-bound, axis=1, kind="stable"), axis=1)
        first = rank < visit
        self._add(total, rest, first)
        for q in range(len(queries)):
            self._leave(total, q, skip)
        if visit < blocks:
            least = np.array([np.partition(x, n - k)[n - k] if n > k else 0.0 for x in total])
            off = np.array([[self.off(len(t))] for t, _ in queries])
            self._add(total, rest, ~first & (bound * (1 + 2 * off) >= least[:, None] * (1 - off)))
        for q in range(len(queries)):
            self._leave(total, q, skip)
        return total

    def _leave(self, total: np.ndarray, q: int, skip: list) -> None:
        if skip[q] is not None:
            total[q, self.place[skip[q]]] = -1.0

    def _add(self, total: np.ndarray, rest: list, chosen: np.ndarray) -> None:
        """Add the common terms of the chosen blocks."""
        blocks, tiers = self.worth.shape
        whole = np.zeros((len(rest), blocks, tiers), bool)
        for q, (row, w) in enumerate(rest):
            begin, sizes, weights = [], [], []
            for b in np.flatnonzero(chosen[q]) if len(row) else ():
                many, tier = self.many[b][row], self.tier[b][row]
                whole[q, b] = np.bincount(tier, many, minlength=tiers) > self.worth[b]
                left = np.flatnonzero((many > 0) & ~whole[q, b][tier])
                begin.append(self.cell[b][row[left]])
                sizes.append(many[left])
                weights.append(w[left])
            if begin:
                total[q] += self._read(*(np.concatenate(x) for x in (begin, sizes, weights)))
        for b in range(blocks):
            asked = np.flatnonzero(whole[:, b].any(1))
            if not len(asked):
                continue
            query = np.zeros((len(asked), len(self.full[b])), np.float32)
            for i, q in enumerate(asked):
                row, w = rest[q]
                column = self.column[b][row]
                own = np.flatnonzero(column >= 0)
                query[i, column[own]] = w[own]
            for j in range(1, tiers):
                use = np.flatnonzero(whole[asked, b, j])
                if len(use):
                    a, z = self.ends[b, j - 1], self.ends[b, j]
                    total[asked[use], self.edge[b] : self.edge[b + 1]] += query[use, a:z] @ self.full[b][a:z]


@dataclass
class Neighbours:
    """Vocabulary and labelled examples, handed to the executors once."""

    words: Vocabulary
    index: BlockMaxIndex
    labels: np.ndarray
    keys: np.ndarray
    shares: tuple[float, float]  # weight of a clean and of a toxic example

    def votes(self, queries: list[tuple[np.ndarray, np.ndarray]], skip: list | None = None) -> Iterator[tuple[float | None, np.ndarray, np.ndarray]]:
        """For each (terms, their counts) the vote, the neighbours and their cosines."""
        for a in range(0, len(queries), TOGETHER):
            asked = [weighted(t, tf, self.index.per_term)[:2] for t, tf in queries[a : a + TOGETHER]]
            for found, cosine in self.index.nearest_of(asked, NEAREST, skip and skip[a : a + TOGETHER]):
                if not len(found):
                    yield None, found, cosine
                    continue
                y = self.labels[found]
                w = np.where(y > 0, self.shares[1], self.shares[0]) / (np.maximum(1 - cosine, 0) + SOFT)
                yield float(w @ y / w.sum()), found, cosine


@dataclass
class Model:
    index: BlockMaxIndex
    shared: Broadcast  # of the Neighbours
    steps: tuple[np.ndarray, np.ndarray]  # votes and the scores they stand for
    alone: float  # score without a neighbour


def monotone(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators of weighted labels; each pool's rate is smoothed by one example of the overall rate."""
    order = np.argsort(x, kind="stable")
    weight = np.ones(len(x)) if weight is None else weight
    overall = float(weight @ y / weight.sum())
    pools: list[list[float]] = []  # votes, labels, size, all weighted
    for v, l, w in zip(x[order], y[order], weight[order], strict=True):
        pools.append([v * w, float(l * w), float(w)])
        while len(pools) > 1 and pools[-2][1] / pools[-2][2] >= pools[-1][1] / pools[-1][2]:
            v2, l2, n2 = pools.pop()
            pools[-1] = [pools[-1][0] + v2, pools[-1][1] + l2, pools[-1][2] + n2]
    at = np.array([p[0] / p[2] for p in pools])
    rate = np.maximum.accumulate([(p[1] + overall) / (p[2] + 1) for p in pools])
    return at, rate


def labelled(docs: DataFrame, labels: DataFrame, learn: Column, *, text: str, key: str, toxic: int, clean: int) -> tuple[DataFrame, tuple[float, float]]:
    """The bounded sample of examples (key, text, label), and the weight of a clean and of a toxic
    one: known / drawn labels of the class, 1 on average over the drawn."""
    marked = (
        labels.filter(F.col("toxic").isNotNull() & F.col(key).isNotNull() & learn)
        .groupBy(key).agg(F.max("toxic").alias("y"))
    )
    chosen = drawn(marked.filter("y > 0"), toxic, key).union(drawn(marked.filter("y <= 0"), clean, key))
    chosen = chosen.select(F.col(key).alias("_k"), (F.col("y") > 0).cast("int").alias("_y"))
    sizes = lambda rows: {r.y: r.n for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    known, got = sizes(marked.select((F.col("y") > 0).cast("int").alias("y"))), sizes(chosen.select(F.col("_y").alias("y")))
    even = sum(got.values()) / max(1, sum(known.get(y, 0) for y in got))
    weights = tuple(even * known.get(y, 0) / got[y] if got.get(y) else 1.0 for y in (0, 1))
    # at most toxic + clean narrow rows
    bodies = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).filter("text IS NOT NULL")
    examples = bodies.join(F.broadcast(chosen), F.col("key") == F.col("_k")).select("key", "text", F.col("_y").alias("y"))
    return examples, weights


def all_terms(examples: DataFrame) -> np.ndarray:
    """The hash of every term of the examples, by the order of the terms. Their number is bounded by the sample."""

    def tally(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = np.zeros(0, np.uint64)
        for batch in batches:
            for part in portions(batch["text"].tolist()):
                found = Occurrences.of(part)
                hashes, first = np.unique(found.hash, return_index=True)
                new = ~np.isin(hashes, seen, assume_unique=True)
                seen = np.concatenate([seen, hashes[new]])
                yield pd.DataFrame({"term": pd.Series([found.term(i) for i in first[new]], dtype=object), "h": hashes[new].view(np.int64)})

    rows = examples.select("text").mapInPandas(tally, "term string, h long").distinct().toArrow()
    return rows.sort_by("term")["h"].to_numpy().view(np.uint64)


def document_frequencies(docs: DataFrame, words: Broadcast, *, text: str) -> tuple[int, np.ndarray]:
    """Number of documents, and of documents with each term, over the whole table."""

    def tally(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocabulary = words.value
        counts, n = np.zeros(len(vocabulary), np.int64), 0
        for batch in batches:
            n += len(batch)
            _, found, _ = vocabulary.counts([t for t in batch["t"] if t])
            counts += np.bincount(found, minlength=len(counts))
        part = np.arange(-1, -(-len(counts) // SLICE))  # -1: number of documents
        yield pd.DataFrame({"part": part, "n": [np.array([n]).tobytes(), *(counts[p * SLICE : (p + 1) * SLICE].tobytes() for p in part[1:].tolist())]})

    def added(rows: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(n, np.int64) for n in rows["n"])
        return pd.DataFrame({"part": rows["part"].iloc[:1], "n": [total.tobytes()]})

    shape = "part long, n binary"
    rows = docs.select(F.col(text).alias("t")).mapInPandas(tally, shape).groupBy("part").applyInPandas(added, shape).toArrow().sort_by("part")
    every = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(n.as_buffer(), np.int64) for n in rows["n"])])
    return (int(every[0]), every[1:].astype(float)) if len(every) else (0, np.zeros(len(words.value)))


def _read_examples(examples: DataFrame, words: Broadcast, idf: np.ndarray) -> tuple[BlockMaxIndex, np.ndarray, np.ndarray, list[int], list[int]]:
    """The index of the examples that have terms, their labels, keys and runs of equal terms and key,
    and the labels of the examples without a term."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            begin, terms, tf = words.value.counts(batch["text"].tolist())
            each = list(zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True))
            small = [np.uint16 if tf[a:b].max(initial=0) < 1 << 16 else np.int32 for a, b in each]
            yield pd.DataFrame({
                "key": batch["key"], "y": batch["y"], "terms": [terms[a:b].astype(np.int32).tobytes() for a, b in each],
                "tf": [tf[a:b].astype(s).tobytes() for (a, b), s in zip(each, small, strict=True)],
            })

    rows = examples.mapInPandas(counted, "key long, y int, terms binary, tf binary").toArrow()
    keys, ys = rows["key"].to_numpy(), rows["y"].to_numpy()
    terms = [np.frombuffer(x.as_buffer(), np.int32) for x in rows["terms"]]  # no copies
    tfs = [np.frombuffer(x.as_buffer(), np.uint16 if len(x.as_buffer()) * 2 == t.nbytes else np.int32) for x, t in zip(rows["tf"], terms, strict=True)]
    norm, strongest = np.zeros(len(rows)), np.zeros(len(rows), np.int64)
    for i, (t, tf) in enumerate(zip(terms, tfs, strict=True)):
        if len(t):
            _, w, norm[i] = weighted(t, tf, idf)
            strongest[i] = t[np.argmax(w)]
    order: list[int] = []  # by strongest term, then by all terms, so that equal examples are neighbours
    full = [i for i in range(len(rows)) if len(terms[i])]
    for _, like in groupby(sorted(full, key=strongest.__getitem__), key=strongest.__getitem__):
        order += sorted(like, key=lambda i: (terms[i].tobytes(), int(keys[i]), int(ys[i])))
    index = BlockMaxIndex([(terms[i], tfs[i]) for i in order], len(words.value), damp=damped, per_term=idf, per_example=1 / norm[order])
    run = [0] * len(order)
    for j in range(1, len(order)):
        a, b = order[j - 1], order[j]
        run[j] = run[j - 1] + int(keys[a] != keys[b] or not np.array_equal(terms[a], terms[b]))
    return index, ys[order].astype(np.float64), keys[order].astype(np.int64), run, [int(y) for i, y in enumerate(ys) if not len(terms[i])]


def _examples_votes(docs: DataFrame, shared: Broadcast, run: list[int], most: int) -> tuple[list[float], list[int]]:
    """The votes on at most ``most`` examples, each scored against all others, and their numbers. Rows
    of the same key don't vote on it; other copies do, as they do on a new text."""
    asked = np.linspace(0, len(run) - 1, min(most, len(run))).astype(int)
    first, last = np.searchsorted(run, np.array(run)[asked]), np.searchsorted(run, np.array(run)[asked], "right")

    def vote(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for batch in batches:
            at = batch["id"].to_numpy()
            queries = [m.index.example_counts(asked[i]) for i in at]
            votes = m.votes(queries, [np.arange(first[i], last[i]) for i in at])
            yield pd.DataFrame({"id": at, "vote": [v if v is not None else -1.0 for v, _, _ in votes]})

    session = docs.sparkSession
    parts = min(max(1, len(asked) // TOGETHER), session.sparkContext.defaultParallelism)
    rows = session.range(0, len(asked), 1, parts).mapInPandas(vote, "id long, vote double").toArrow().sort_by("id")
    votes = rows["vote"].to_numpy()
    return votes[votes >= 0].tolist(), asked[votes >= 0].tolist()


def fit(
    docs: DataFrame, labels: DataFrame, *, learn: Column | None = None, text: str = "text", key: str = "doc_id",
    toxic: int = 4_000, clean: int = 8_000, calibrate: int = 3_000,
) -> Model:
    """Weigh the examples' terms over all documents, index the examples and calibrate.

    ``learn`` says which rows of ``labels`` may be learned from; ``calibrate`` bounds the
    examples that are scored against the others.
    """
    context = docs.sparkSession.sparkContext
    examples, shares = labelled(docs, labels, F.lit(True) if learn is None else learn, text=text, key=key, toxic=toxic, clean=clean)
    any_toxic = bool(examples.filter("y = 1").limit(1).count())
    hashes = all_terms(examples) if any_toxic else np.zeros(0, np.uint64)
    words = Vocabulary(hashes)
    if not any_toxic:
        index = BlockMaxIndex([], 0)
        nothing = Neighbours(words, index, np.zeros(0), np.zeros(0, np.int64), shares)
        return Model(index, context.broadcast(nothing), (np.array([0.0, 1.0]), np.array([0.0, 1.0])), 0.0)
    shared = context.broadcast(words)
    n, df = document_frequencies(docs, shared, text=text) if len(words) else (0, np.zeros(0))
    idf = np.log((1 + n) / (1 + df)) + 1
    index, ys, keys, run, bare = _read_examples(examples, shared, idf)
    shared.unpersist()
    model = Model(index, context.broadcast(Neighbours(words, index, ys, keys, shares)), (np.array([0.0, 1.0]), np.array([0.0, 1.0])), 0.0)
    every = [*ys.astype(int).tolist(), *bare]
    if every and len(words):
        rate = shares[1] * sum(every) / sum(shares[y] for y in every)
        model.alone = (shares[1] * sum(bare) + rate) / (sum(shares[y] for y in bare) + 1)
    votes, at = _examples_votes(docs, model.shared, run, calibrate) if run else ([], [])
    if votes:
        truth = ys[at]
        model.steps = monotone(np.array(votes), truth, np.where(truth > 0, shares[1], shares[0]))
    return model


def together(batches: Iterator[pd.Series]) -> Iterator[list[str]]:
    """Texts of several batches, about as many as are scored at once, fewer where they are long."""
    held: list[str] = []
    for texts in batches:
        held += texts.tolist()
        if len(held) >= TOGETHER or sum(map(len, held)) > 16 * PORTION:
            yield held
            held = []
    if held:
        yield held


def scorer(docs: DataFrame, model: Model):
    """A column function: text to score, and the keys and cosines of the neighbours it rests on."""
    shared, steps, alone = model.shared, model.steps, model.alone

    @F.pandas_udf("score double, neighbours array<long>, cosines array<double>")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for texts in together(batches):
            begin, terms, tf = m.words.counts(texts)
            queries = [(terms[a:b], tf[a:b]) for a, b in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True)]
            rows = [
                (alone if vote is None else float(np.interp(vote, *steps)), m.keys[found].tolist(), cosine.tolist())
                for vote, found, cosine in m.votes(queries)
            ]
            yield pd.DataFrame(rows, columns=["score", "neighbours", "cosines"])

    return lambda text: score(F.coalesce(text, F.lit("")))
