"""Sharding by sampled splitters, all in DataFrame functions; the law is ``bytes``.

Records are ordered by the hash of their text, then by the hash and value of their key, so equal texts lie
together. A size-weighted sample of positions (a record is drawn with a chance in proportion to its
bytes, decided by a hash) gives quantile boundaries; the boundaries cut the table into ranges of
nearly equal bytes, and a range that came out overfull is cut again by a denser sample of its own. Sums per range, which are few,
then place every record exactly: a record belongs to the shard in which the middle of its bytes
falls. Shards differ by less than one record, and by at most ``loose`` of a shard more where a group
of equal texts on a border is kept whole; a larger group is split between neighbouring shards.

Only keys, hashes and sizes are shuffled. The driver sees the sample (a bounded number of
positions), sums per range and the records next to a border.

Defined cases: a null text has size 1 and the checksum of the empty text. Rows equal in text and
key are told apart by nothing, so they share a place in the order; each still gets a slot of its
own. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isotherm.llm.common import materialise, text_of

#: Ranges at least, and at most; between them one range for so many bytes.
FEWEST, MOST, RANGE_BYTES = 64, 4_096, 256 << 20
#: Sampled positions for each range.
EACH = 24
OVERFULL = 1.5


def _position() -> Column:
    return F.struct("h1", "h2", "h3")


def _bucket(splitters: list[tuple], at: Column) -> Column:
    """Number of splitters at or before ``at``, by binary search over a literal array."""
    if not splitters:
        return F.lit(0)
    array = F.array(*[F.struct(*[F.lit(v).cast("long").alias(f"h{i}") for i, v in enumerate(s, 1)]) for s in splitters])
    n, steps = len(splitters), []
    step = 1 << (n.bit_length() - 1)
    while step:
        steps.append(step)
        step //= 2
    return F.aggregate(
        F.array(*map(F.lit, steps)),
        F.lit(0),
        lambda low, s: F.when((low + s <= n) & (F.get(array, low + s - 1) <= at), low + s).otherwise(low),
    )


def _drawn(rows: DataFrame, chance: Column) -> list[tuple]:
    """Positions drawn with the given chance, decided by a hash; one may be drawn once only."""
    u = (F.xxhash64("h1", "h2", "h3", F.lit(17)).bitwiseAND(F.lit((1 << 53) - 1)) / F.lit(float(1 << 53)))
    return [tuple(r) for r in rows.filter(u < chance).select("h1", "h2", "h3").collect()]


def _quantiles(drawn: list[tuple], parts: int) -> list[tuple]:
    drawn = sorted(drawn)
    return sorted({drawn[len(drawn) * i // parts] for i in range(1, parts)} - {drawn[0]}) if drawn else []


def placed(docs: DataFrame, *, text: str = "text", key: str = "doc_id", shards: int = 8, loose: float = 0.01) -> DataFrame:
    """Each row's key, size, checksum, shard and slot. Other columns stay behind; join by the key."""
    body = text_of(F.col(text)).cast("binary")
    rows = docs.select(
        F.col(key),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.xxhash64(body).alias("h1"),
        F.xxhash64(F.col(key).cast("string")).alias("h2"),
        F.coalesce(F.col(key).cast("long"), F.lit(-1)).alias("h3"),
    )
    rows = materialise(rows, "shard-keys")  # the texts are read once
    total = rows.agg(F.sum("size")).first()[0] or 0
    parts = min(MOST, max(FEWEST, -(-total // RANGE_BYTES)))
    draw = F.least(F.lit(1.0), F.col("size") * (parts * EACH / max(total, 1)))
    splitters = _quantiles(_drawn(rows, draw), parts)

    def ranged(cuts: list[tuple]) -> tuple[DataFrame, list]:
        out = rows.withColumn("range", _bucket(cuts, _position()))
        sums = out.groupBy("range").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")).collect()
        return out, sorted(sums, key=lambda r: r["range"])

    cut, sums = ranged(splitters)
    over = {r["range"]: r["bytes"] for r in sums if r["bytes"] > OVERFULL * total / parts and r["n"] > 1}
    if over:
        chance = F.lit(0.0)
        for number, size in over.items():
            pieces = -(-size * parts // total)
            chance = F.when(F.col("range") == number, F.col("size") * (4 * pieces * EACH / size)).otherwise(chance)
        more = _drawn(cut.filter(F.col("range").isin(*over)), F.least(F.lit(1.0), chance))
        where = [*splitters, None]
        for number, size in over.items():
            low = splitters[number - 1] if number else None
            inside = [m for m in more if (low is None or m >= low) and (where[number] is None or m < where[number])]
            splitters = sorted({*splitters, *_quantiles(inside, -(-size * parts // total))})
        cut, sums = ranged(splitters)

    before, rows_before, b, n = {}, {}, 0, 0
    for r in sums:
        before[r["range"]], rows_before[r["range"]] = b, n
        b, n = b + r["bytes"], n + r["n"]
    offset = lambda d: F.get(F.array(*[F.lit(d.get(i, 0)).cast("long") for i in range(len(splitters) + 1)]), F.col("range"))
    order = Window.partitionBy("range").orderBy("h1", "h2", "h3", "size", "text_crc32")
    ended = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))
    exact = cut.withColumns({
        "row": offset(rows_before) + F.row_number().over(order) - 1,
        "end": offset(before) + ended,
    })
    middle = 2 * F.col("end") - F.col("size")  # twice the middle of the record's bytes
    first = F.least(F.lit(shards - 1), F.floor(middle * shards / (2 * max(total, 1)))).cast("int")
    exact = materialise(exact.withColumn("shard", first), "shard-rows")
    edges = (
        exact.groupBy("shard")
        .agg(F.min("row").alias("low"), F.min_by("h1", "row").alias("a"), F.max_by("h1", "row").alias("z"), F.sum("size").alias("bytes"))
        .orderBy("shard").collect()
    )
    starts = {e["shard"]: e["low"] for e in edges}
    torn = {nxt["a"] for e, nxt in zip(edges, edges[1:], strict=False) if e["z"] == nxt["a"]}  # fewer than the shards
    if torn:
        groups = exact.filter(F.col("h1").isin(*torn)).groupBy("h1").agg(
            F.sum("size").alias("bytes"), F.min("row").alias("low"), F.max("row").alias("high"), F.min("shard").alias("s"), F.max("shard").alias("t")
        ).collect()
        for g in groups:
            if g["bytes"] <= loose * total / shards and g["t"] == g["s"] + 1:
                starts[g["t"]] = g["high"] + 1  # the whole group goes to the shard in which it begins
    if not starts:
        return exact.select(key, "size", "text_crc32", F.col("shard"), F.col("row").alias("slot"))
    known = sorted(starts)
    shard, slot = F.lit(known[0]), F.col("row") - starts[known[0]]
    for s in known[1:]:
        shard = F.when(F.col("row") >= starts[s], s).otherwise(shard)
        slot = F.when(F.col("row") >= starts[s], F.col("row") - starts[s]).otherwise(slot)
    return exact.select(key, "size", "text_crc32", shard.cast("int").alias("shard"), slot.cast("long").alias("slot"))
