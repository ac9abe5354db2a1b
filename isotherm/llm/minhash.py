"""Near-duplicates by MinHash with sequential Bayesian verification.

Documents with equal shingle sets form a class first; everything else works on classes. Banded
signatures give candidates: a band bucket of at most ``ALL_PAIRS`` classes compares all of them,
a larger one compares each with the smallest (a star). Candidates are compared one batch of
hashes after another and dropped as soon as the posterior probability (uniform prior) that
their similarity reaches the threshold falls below ``miss``. Survivors are verified exactly on the full sets:
first one per class, then all whose classes are not in one component yet.

What a star may leave open is settled in one more pass. Classes that large buckets connect while they still
span several components form regions. In a region, the classes outside its largest component are a query set
that is run against the region block by block: a task holds the signatures and full sets of one block of each,
drops pairs by the same posterior bounds, counts the common shingles of the rest exactly and returns links only, at
most one per component it merges. So a class travels once per block, a pair never, and only classes that share
no band at all are missed, with probability (1 - s^rows)^bands at similarity s (5e-8 at 0.8 for 32 bands of 4), and
what ``miss`` allows.

Defined cases: a document without words or text has an empty set, is linked with nothing and forms its
own component. With fewer words than a shingle has, the whole sequence is one shingle. A document
without a key counts in its component, has the component's id (null if no member has a key) and is kept only
if that is null. Rows that repeat a key and text are one document twice; both have the same values.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isotherm.llm.common import materialise

#: Classes of a bucket that are all compared, hashes of a batch, and what a block holds at most, on average.
ALL_PAIRS, BATCH, BLOCK, BLOCK_BYTES = 24, 32, 512, 2 << 20
REMEMBERED = 250_000
_U = np.uint64


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: multiply and shift."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
        x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = value
        return value


_words = _Words()


def shingles(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; A-Z is lower-cased, words end at
    ASCII white space."""
    if not text:
        return np.zeros(0, _U)
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, _U)
    h = np.fromiter(map(_words.__getitem__, words), dtype=_U, count=len(words))
    width = min(k, len(h))
    with np.errstate(over="ignore"):
        out = np.full(len(h) - width + 1, width, dtype=_U)
        for i in range(width):
            out = out * _U(0x9E3779B97F4A7C15) + h[i : len(h) - width + 1 + i]
    return np.unique(_mixed(out))


class Signatures:
    def __init__(self, n: int, seed: int = 29) -> None:
        g = np.random.default_rng(seed)
        self.a = g.integers(1, 1 << 63, n, dtype=_U) * _U(2) + _U(1)
        self.b = g.integers(0, 1 << 63, n, dtype=_U)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        best = np.full(len(self.a), 0xFFFFFFFF, dtype=np.uint32)
        with np.errstate(over="ignore"):
            for at in range(0, len(hashes), 512):  # bounded memory for long texts
                part = hashes[at : at + 512, None] * self.a + self.b
                np.minimum(best, (part.min(0) >> _U(32)).astype(np.uint32), out=best)
        return best


def least_matches(n: int, threshold: float, miss: float) -> int:
    """The fewest of n equal hashes with which a similarity of at least ``threshold`` still has a
    posterior probability of ``miss``, under a uniform prior."""
    # the posterior is Beta(m + 1, n - m + 1): its tail is a binomial sum of n + 1 draws
    logs = [math.lgamma(n + 2) - math.lgamma(j + 1) - math.lgamma(n + 2 - j) + j * math.log(threshold) + (n + 1 - j) * math.log1p(-threshold) for j in range(n + 2)]
    tail = 0.0
    for m in range(n + 1):
        tail += math.exp(logs[m])
        if tail >= miss:
            return m
    return n


def survives(a: np.ndarray, b: np.ndarray, needed: list[int]) -> np.ndarray:
    """Which pairs of signature rows are left after all batches."""
    alive, matches = np.arange(len(a)), np.zeros(len(a), dtype=np.int64)
    for i, least in enumerate(needed):
        at = slice(i * BATCH, (i + 1) * BATCH)
        matches[alive] += (a[alive, at] == b[alive, at]).sum(1)
        alive = alive[matches[alive] >= least]
    out = np.zeros(len(a), dtype=bool)
    out[alive] = True
    return out


def described(docs: DataFrame, *, text: str, key: str, k: int, hashes: int) -> DataFrame:
    """Key, set size, a 128-bit name of the set (null if empty) and the signature."""

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sign = Signatures(hashes)
        for batch in batches:
            rows = []
            for key_, mark, t in zip(batch["key"], batch["mark"], batch["t"], strict=True):
                s = shingles(t, k)
                if len(s):
                    rows.append((key_, mark, len(s), xxhash.xxh3_128_digest(s.tobytes()), sign(s).tobytes()))
                else:
                    rows.append((key_, mark, 0, None, None))
            yield pd.DataFrame(rows, columns=["key", "mark", "n", "set", "sig"], dtype=object)

    # keys travel as strings: a long column with nulls would pass through floating point
    rows = docs.select(F.col(key).cast("string").alias("key"), F.xxhash64(F.col(text)).alias("mark"), F.col(text).alias("t"))
    out = rows.mapInPandas(describe, "key string, mark long, n long, set binary, sig binary")
    return out.withColumn("key", F.col("key").cast("long"))


def banded(classes: DataFrame, *, bands: int, rows: int) -> DataFrame:
    """A row for each class and band: the bucket and the class."""

    def band(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = np.arange(1, bands + 1, dtype=_U)
        for batch in batches:
            sig = np.frombuffer(b"".join(batch["sig"]), dtype=np.uint32).reshape(len(batch), -1)[:, : bands * rows].astype(_U)
            parts = sig.reshape(len(batch), bands, rows)
            value = np.broadcast_to(number, parts.shape[:2])
            for r in range(rows):
                value = _mixed(value * _U(0x9E3779B97F4A7C15) + parts[:, :, r])
            yield pd.DataFrame({
                "bucket": value.ravel().view(np.int64), "band": np.tile(np.arange(bands, dtype=np.int32), len(batch)),
                "set": np.repeat(batch["set"].to_numpy(), bands),
            })

    return classes.select("set", "sig").mapInPandas(band, "bucket long, band int, set binary")


def components(links: DataFrame, name: str) -> DataFrame:
    """Smallest member of each component, for every member that is not it: columns set, root.

    Alternating stars: every node points its larger neighbours, then its smaller ones, at the
    smallest; a hot node is one key with partial aggregation. Each round is written and read back.
    """
    links = links.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    links, state = materialise(links, name), None
    while True:
        both = links.union(links.select("v", "u"))
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        links = materialise(small.filter("u != v").distinct(), name)
        seen = tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if seen == state:
            return links.select(F.col("u").alias("set"), F.col("v").alias("root"))
        state = seen


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""

    @F.pandas_udf("boolean")
    def alike(a: pd.Series, b: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(a, b, strict=True):
            x, y = np.frombuffer(x, _U), np.frombuffer(y, _U)
            both = len(np.intersect1d(x, y, assume_unique=True))
            out.append(100 * both >= percent * (len(x) + len(y) - both))
        return pd.Series(out, dtype=bool)

    left = sets.select(F.col("set").alias("a"), F.col("hashes").alias("ha"))
    right = sets.select(F.col("set").alias("b"), F.col("hashes").alias("hb"))
    return pairs.join(left, "a").join(right, "b").filter(alike("ha", "hb")).select("a", "b")


def near_duplicates(
    docs: DataFrame, *, text: str = "text", key: str = "doc_id", shingle: int = 4, percent: int = 80,
    bands: int = 32, rows: int = 4, miss: float = 1e-6, mark: str | None = None,
) -> DataFrame:
    """One row per document: ``key``, n_shingles, component_id, kept and, with ``mark``, the hash of its
    text under that name."""
    n_hashes = bands * rows
    needed = [least_matches(n, percent / 100, miss) for n in range(BATCH, n_hashes + 1, BATCH)]
    base = materialise(described(docs, text=text, key=key, k=shingle, hashes=n_hashes), "minhash-docs")
    classes = base.filter("set IS NOT NULL").groupBy("set").agg(
        F.min("key").alias("rep"), F.max("n").alias("n"), F.first("sig").alias("sig")
    )
    classes = materialise(classes, "minhash-classes")
    parts = banded(classes, bands=bands, rows=rows)
    buckets = parts.groupBy("bucket").agg(F.count(F.lit(1)).alias("m"), F.min("set").alias("low")).filter("m > 1")
    members = materialise(parts.join(buckets, "bucket"), "minhash-buckets")

    # small buckets: all pairs of a bounded number; large ones: a star
    lists = members.filter(F.col("m") <= ALL_PAIRS).groupBy("bucket").agg(F.array_sort(F.collect_list("set")).alias("s")).select("s").distinct()
    firsts = lists.select(F.posexplode("s").alias("i", "a"), "s")
    few = firsts.select("a", F.explode(F.expr("slice(s, i + 2, size(s))")).alias("b"))
    stars = members.filter((F.col("m") > ALL_PAIRS) & (F.col("set") != F.col("low"))).select(F.col("low").alias("a"), F.col("set").alias("b"))
    pairs = few.union(stars).distinct()

    @F.pandas_udf("boolean")
    def plausible(a: pd.Series, b: pd.Series) -> pd.Series:
        x, y = (np.frombuffer(b"".join(s), dtype=np.uint32).reshape(len(s), -1) for s in (a, b))
        return pd.Series(survives(x, y, needed))

    left = classes.select(F.col("set").alias("a"), F.col("n").alias("na"), F.col("sig").alias("sa"))
    right = classes.select(F.col("set").alias("b"), F.col("n").alias("nb"), F.col("sig").alias("sb"))
    sized = (100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    pairs = pairs.join(left, "a").join(right, "b").filter(sized).filter(plausible("sa", "sb")).select("a", "b")
    pairs = materialise(pairs, "minhash-pairs")

    # full sets of every class that any later step may verify
    large = members.filter(F.col("m") > ALL_PAIRS).select("bucket", "band", "set")
    ends = pairs.select(F.col("a").alias("set")).union(pairs.select("b")).union(large.select("set")).distinct()
    sets = materialise(_needed(docs, classes, ends, text=text, key=key, shingle=shingle), "minhash-sets")

    one = pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    links = materialise(_verified(one, sets, percent), "minhash-links")
    roots = components(links, "minhash-roots")
    rest = _apart(pairs, roots).join(one, ["a", "b"], "left_anti")
    more = materialise(_verified(rest, sets, percent), "minhash-links")
    links = links.union(more)
    roots = components(links, "minhash-roots")
    if not large.isEmpty():
        found = _unsettled(large, roots, classes, sets, needed, percent)
        if found is not None:
            links = links.union(found)
            roots = components(links, "minhash-roots")

    joined = classes.select("set", "rep").join(roots, "set", "left").withColumn("root", F.coalesce("root", "set"))
    smallest = joined.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = joined.join(smallest, "root").select("set", "component_id")
    out = base.select("key", "mark", "n", "set").join(named, "set", "left")
    own = F.when(F.col("set").isNull(), F.col("key")).otherwise(F.col("component_id"))
    return out.select(
        F.col("key").alias(key), F.col("n").alias("n_shingles"), own.alias("component_id"),
        F.col("key").eqNullSafe(own).alias("kept"), *([F.col("mark").alias(mark)] if mark else []),
    )


def _needed(docs: DataFrame, classes: DataFrame, ends: DataFrame, *, text: str, key: str, shingle: int) -> DataFrame:
    """Full sets of the classes in ``ends``, from the texts of documents with their smallest key."""

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [shingles(t, shingle).tobytes() for t in batch["t"]]
            yield pd.DataFrame({"set": [xxhash.xxh3_128_digest(f) for f in found], "hashes": found}, dtype=object)

    reps = classes.join(ends, "set").select("rep").distinct()
    texts = docs.select(F.col(key).cast("long").alias("rep"), F.col(text).alias("t")).filter("t IS NOT NULL")
    texts = texts.join(reps.filter("rep IS NOT NULL"), "rep", "left_semi").union(
        texts.filter("rep IS NULL")  # a class may have no member with a key
    )
    return texts.select("t").mapInPandas(hashed, "set binary, hashes binary").join(ends, "set", "left_semi").dropDuplicates(["set"])


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs whose ends are in different components."""
    a = roots.select(F.col("set").alias("a"), F.col("root").alias("ra"))
    b = roots.select(F.col("set").alias("b"), F.col("root").alias("rb"))
    both = pairs.join(a, "a", "left").join(b, "b", "left")
    return both.filter(F.coalesce("ra", "a") != F.coalesce("rb", "b")).select("a", "b")


def _linked(x: np.ndarray, others: list[np.ndarray], inside: np.ndarray, percent: int) -> np.ndarray:
    """Which of the sets ``others`` are similar enough to x; all hold places of the flags ``inside``."""
    inside[x] = True
    sizes = np.array([len(o) for o in others])
    both = np.add.reduceat(inside[np.concatenate(others)], np.cumsum(sizes) - sizes, dtype=np.int64)
    inside[x] = False
    return 100 * both >= percent * (len(x) + sizes - both)


def spanning_links(strays: pd.DataFrame, members: pd.DataFrame, needed: list[int], percent: int) -> list[tuple[bytes, bytes]]:
    """Links between the components of two blocks, found by comparing every stray with every member of another
    component; a link that joins nothing new is left out. Columns: set, root, n, sig, hashes."""
    if not len(strays) or not len(members):
        return []
    roots = {r: i for i, r in enumerate(pd.unique(pd.concat([members["root"], strays["root"]])))}
    own, mine = (np.array([roots[r] for r in t["root"]]) for t in (members, strays))
    raw = [np.frombuffer(h, _U) for t in (members, strays) for h in t["hashes"]]
    distinct, place = np.unique(np.concatenate(raw), return_inverse=True)
    coded = np.split(place, np.cumsum([len(h) for h in raw])[:-1])
    inside = np.zeros(len(distinct), dtype=bool)
    y = np.frombuffer(b"".join(members["sig"]), dtype=np.uint32).reshape(len(members), -1)
    n, names = members["n"].to_numpy(dtype=np.int64), members["set"].to_numpy()
    out = []
    for i, (set_, size, sig) in enumerate(zip(strays["set"], strays["n"], strays["sig"], strict=True)):
        fits = (own != mine[i]) & (100 * np.minimum(n, size) >= percent * np.maximum(n, size))
        at = np.flatnonzero(fits)
        x = np.frombuffer(sig, dtype=np.uint32)
        at = at[survives(np.broadcast_to(x, (len(at), len(x))), y[at], needed)]
        if not len(at):
            continue
        at = at[_linked(coded[len(members) + i], [coded[j] for j in at], inside, percent)]
        for j in at.tolist():
            if own[j] != mine[i]:
                out.append((min(set_, names[j]), max(set_, names[j])))
                gone = own[j]
                own[own == gone], mine[mine == gone] = mine[i], mine[i]
    return out


def _unsettled(large: DataFrame, roots: DataFrame, classes: DataFrame, sets: DataFrame, needed: list[int], percent: int) -> DataFrame | None:
    """The links that large buckets still hold between components: ``a, b``, written; None if there are no such buckets."""
    rows = large.join(roots, "set", "left").withColumn("root", F.coalesce("root", "set"))
    spans = rows.groupBy("bucket").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.min("set").alias("low"))
    edges = materialise(rows.join(spans.filter("x <> y"), "bucket").select(F.col("low").alias("a"), F.col("set").alias("b")).distinct(), "minhash-edges")
    if edges.isEmpty():
        return None
    regions = components(edges, "minhash-regions").withColumnRenamed("root", "region")
    nodes = edges.select(F.col("b").alias("set")).distinct().join(regions, "set", "left").join(roots, "set", "left")
    nodes = nodes.withColumns({"region": F.coalesce("region", "set"), "root": F.coalesce("root", "set")})
    nodes = materialise(nodes.join(classes.select("set", "n", "sig"), "set").join(sets, "set"), "minhash-nodes")

    sizes = nodes.groupBy("region", "root").agg(F.count(F.lit(1)).alias("m"), F.sum(F.length("hashes") + F.length("sig")).alias("bytes"))
    largest = F.struct("m", "root")
    tops = sizes.groupBy("region").agg(
        F.max_by("root", largest).alias("top"), F.sum("m").alias("m"), F.sum("bytes").alias("bytes"),
        (F.sum("m") - F.max("m")).alias("strays"), (F.sum("bytes") - F.max_by("bytes", largest)).alias("stray_bytes"),
    )

    def cut(m: str, size: str):
        return F.greatest(F.ceil(F.col(m) / BLOCK), F.ceil(F.col(size) / BLOCK_BYTES)).cast("int")

    tops = tops.filter("strays > 0").select("region", "top", cut("m", "bytes").alias("blocks"), cut("strays", "stray_bytes").alias("parts"))
    open_ = nodes.join(tops, "region")
    place = lambda salt, of: F.pmod(F.xxhash64("set", F.lit(salt)), F.col(of)).cast("int")
    each = lambda of: F.explode(F.sequence(F.lit(0), F.col(of) - 1))
    columns = ("set", "root", "n", "sig", "hashes")
    members = open_.select("region", place(1, "blocks").alias("block"), each("parts").alias("part"), *columns, F.lit(False).alias("stray"))
    strays = open_.filter("root != top").select("region", each("blocks").alias("block"), place(2, "parts").alias("part"), *columns, F.lit(True).alias("stray"))

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        found = spanning_links(group[group["stray"]], group[~group["stray"]], needed, percent)
        return pd.DataFrame(found, columns=["a", "b"], dtype=object)

    links = members.union(strays).groupBy("region", "block", "part").applyInPandas(compare, "a binary, b binary")
    return materialise(links.distinct(), "minhash-links")
