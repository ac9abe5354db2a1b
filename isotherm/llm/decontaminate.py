"""Benchmark passages in documents, all in DataFrame functions.

Every window of a document that has as many words as a benchmark item is compared with the items of
that size by 5-word shingles; a document shorter than the item is a window by itself. A window reaches the similarity ``percent`` only if enough of its
shingles occur in items of its size, so windows are counted out first from the shingles that do (exact: no
window that could match is lost). The others get a SimHash of 64 bits over their shingles;
fingerprints are cut into ``RADIUS`` + 1 blocks, of which two fingerprints within the radius share at least one
(pigeonhole), and a join on item size, block and value finds all of them. Candidates within the
radius are then verified by the exact weighted similarity: shingles weigh by how often they occur,
sum of minima over sum of maxima.

At a similarity of 0.8 a bit differs with probability 0.15, so a radius of 20 holds all but
about 2 in 10,000 matches at the very threshold and practically all closer ones.

Words are lower-cased and end at ASCII white space. The benchmark's shingles are broadcast while
there are at most ``BROADCAST`` of them, which is counted first; beyond it they are shuffled.

Defined cases: null and empty texts and items match nothing. An item with fewer than five words is one
shingle of all its words. Copies of a document share its windows and each get its rows; a
repeated row repeats its rows. Items of one text each get a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isotherm.llm.common import materialise, text_of, words_of

SHINGLE, RADIUS, BROADCAST = 5, 20, 500_000
BITS = 64


def _hashes(words: Column, width: int) -> Column:
    """Hashes of all ``width``-word shingles of an array of words."""
    first = F.slice(words, F.lit(1), F.greatest(F.size(words) - (width - 1), F.lit(0)))
    return F.transform(first, lambda x, i: F.xxhash64(F.lit(width), x, *[F.get(words, i + j) for j in range(1, width)]))


def simhash(hashes: Column) -> Column:
    """Bit b is set where more hashes have it than not; repeated hashes count as often."""
    vote = lambda b: F.aggregate(hashes, F.lit(0), lambda t, x: t + _bit(x, b))
    return F.aggregate(
        F.sequence(F.lit(0), F.lit(BITS - 1)),
        F.lit(0).cast("long"),
        lambda f, b: F.when(vote(b) > 0, f.bitwiseOR(_shift(b))).otherwise(f),
    )


def _shift(b: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), b)


def _bit(x: Column, b: Column) -> Column:
    return 2 * F.call_function("shiftrightunsigned", x, b).bitwiseAND(F.lit(1).cast("long")).cast("int") - 1


def _blocks(fingerprint: Column) -> Column:
    """(number, value) of each of the radius + 1 blocks."""
    parts, low = [], 0
    for i in range(RADIUS + 1):
        high = BITS * (i + 1) // (RADIUS + 1)
        value = F.shiftrightunsigned(fingerprint, low).bitwiseAND(F.lit((1 << (high - low)) - 1).cast("long"))
        parts.append(F.struct(F.lit(i).alias("block"), value.cast("int").alias("value")))
        low = high
    return F.array(*parts)


def _common(a: Column, b: Column) -> Column:
    """Sum over shingles of the smaller count. Without repeats it is the plain intersection."""
    plain = (F.size(F.array_distinct(a)) == F.size(a)) | (F.size(F.array_distinct(b)) == F.size(b))
    times = lambda c, x: F.size(F.filter(c, lambda y: y == x))
    each = F.aggregate(F.array_intersect(a, b), F.lit(0), lambda t, x: t + F.least(times(a, x), times(b, x)))
    return F.when(plain, F.size(F.array_intersect(a, b))).otherwise(each)


def _text_keys(docs: DataFrame, text: str) -> DataFrame:
    body = text_of(F.col(text))
    return docs.withColumns({"_k1": F.xxhash64(body), "_k2": F.xxhash64(F.lit(7), body)})


def leaks(
    docs: DataFrame, benchmark: DataFrame, *, text: str = "text", key: str = "doc_id", item_text: str = "text",
    item_key: str = "item_id", percent: int = 80,
) -> DataFrame:
    """One row per document and item it contains: key, item_id, similarity (the best window's),
    start_word (the first such window, counted from 0)."""
    items = benchmark.select(
        F.col(item_key).alias("item_id"), words_of(F.lower(text_of(F.col(item_text)))).alias("w")
    ).filter(F.size("w") > 0).withColumn("n", F.size("w"))
    by_width = [_hashes(F.col("w"), k) for k in range(1, SHINGLE + 1)]
    chosen = F.when(F.col("n") >= SHINGLE, by_width[-1])
    for k in range(1, SHINGLE):
        chosen = chosen.when(F.col("n") == k, by_width[k - 1])
    items = items.withColumn("sh", chosen).select("item_id", "n", "sh", simhash(F.col("sh")).alias("fp"))
    items = materialise(items, "leak-items")
    known = items.select("n", F.explode("sh").alias("h")).distinct()
    count = known.count()
    widths = sorted({min(r.n, SHINGLE) for r in items.select(F.least("n", F.lit(SHINGLE)).alias("n")).distinct().collect()})
    if count <= BROADCAST:
        known = F.broadcast(known)

    keyed = _text_keys(docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")), "_text")
    worded = keyed.withColumn("w", words_of(F.lower(text_of(F.col("_text")))))
    # where shingles of items occur; copies of a text fall together
    starts = None
    for k in widths:
        shingled = worded.select("_k1", "_k2", F.size("w").alias("words"), F.posexplode(_hashes(F.col("w"), k)).alias("p", "h"))
        hits = shingled.join(known, "h").filter(F.least("n", F.lit(SHINGLE)) == k)
        first = F.greatest(F.col("p") - F.col("n") + k, F.lit(0))
        last = F.least(F.col("p"), F.greatest(F.col("words") - F.col("n"), F.lit(0)))
        near = hits.filter(first <= last)
        near = near.select("_k1", "_k2", "n", F.least("n", "words").alias("m"), F.explode(F.sequence(first, last)).alias("s"))
        starts = near if starts is None else starts.union(near)
    short = F.least("n", F.lit(SHINGLE)) - 1
    size = F.col("m") + F.col("n") - 2 * short
    if starts is None:
        starts = worded.select("_k1", "_k2", F.lit(0).alias("n"), F.lit(0).alias("m"), F.lit(0).alias("s")).limit(0)
    # both sides together have `size` shingles: common >= percent / (100 + percent) * size. Copies of
    # a text count its shingles again, which lets more windows through, never fewer
    enough = starts.groupBy("_k1", "_k2", "n", "m", "s").agg(F.count(F.lit(1)).alias("c")).filter((100 + percent) * F.col("c") >= percent * size)
    lists = enough.groupBy("_k1", "_k2").agg(F.collect_set(F.struct("n", "s")).alias("at"))
    lists = materialise(lists, "leak-windows")

    texts = keyed.select("_k1", "_k2", "_text").join(lists, ["_k1", "_k2"]).dropDuplicates(["_k1", "_k2"])
    found = texts.withColumn("w", words_of(F.lower(text_of(F.col("_text"))))).select("_k1", "_k2", "w", F.explode("at").alias("at"))
    piece = F.slice(F.col("w"), F.col("at.s") + 1, F.col("at.n"))
    found = found.select("_k1", "_k2", "at.n", "at.s", piece.alias("w"))
    shingles = F.when(F.col("n") >= SHINGLE, _hashes(F.col("w"), SHINGLE))
    for k in range(1, SHINGLE):
        shingles = shingles.when(F.col("n") == k, _hashes(F.col("w"), k))
    windows = found.withColumn("wh", shingles).select("_k1", "_k2", "n", "s", "wh", simhash(F.col("wh")).alias("wf"))
    windows = materialise(windows, "leak-fingerprints")
    a = windows.select("_k1", "_k2", "n", "s", "wf", F.explode(_blocks(F.col("wf"))).alias("x"))
    b = items.select("item_id", "n", "fp", F.explode(_blocks(F.col("fp"))).alias("x"))
    near = a.select("*", "x.block", "x.value").drop("x").join(b.select("*", "x.block", "x.value").drop("x"), ["n", "block", "value"])
    near = near.filter(F.bit_count(F.col("wf").bitwiseXOR(F.col("fp"))) <= RADIUS)
    pairs = near.select("_k1", "_k2", "n", "s", "item_id").distinct()
    exact = pairs.join(windows.select("_k1", "_k2", "n", "s", "wh"), ["_k1", "_k2", "n", "s"]).join(items.select("item_id", "sh"), "item_id")
    exact = exact.withColumn("c", _common(F.col("wh"), F.col("sh"))).withColumn("all", F.size("wh") + F.size("sh") - F.col("c"))
    best = exact.filter(100 * F.col("c") >= percent * F.col("all")).groupBy("_k1", "_k2", "item_id").agg(
        F.max(F.col("c") / F.col("all")).alias("similarity"),
        F.max_by("s", F.struct(F.col("c") / F.col("all"), -F.col("s"))).cast("long").alias("start_word"),
    )
    return keyed.select("_key", "_k1", "_k2").join(best, ["_k1", "_k2"]).select(F.col("_key").alias(key), "item_id", "similarity", "start_word")
