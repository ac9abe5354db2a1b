"""Quality rules with risk-controlled thresholds, all in DataFrame functions.

Two rules are fixed (too few words, too much repetition). For the others, ``RULES``, a document
is rejected where its rate is above a cutoff, and the cutoff of each stratum comes from the
labelled holdout: of the documents labelled good, the share a cutoff rejects must be below
``risk`` / number of rules, by an exact binomial test. Cutoffs of a rule are tested from lax to
strict and the last accepted before the first failure holds (fixed-sequence testing), each at
level ``delta`` / (rules x strata); so with probability 1 - ``delta`` no stratum loses more than
``risk`` of its good documents to these rules. A rule without an accepted cutoff rejects none.

Strata are the values of the stratum column, however many, null being one of its own. Counts, tests and cutoffs
are rows of one table per stratum that is joined back; the driver sees the number of strata.

Defined cases: null and empty texts have no words and fail the fixed rule. A null label or
quality is no label; a document labelled twice counts with its lower quality. Without labels only the
fixed rules reject.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isotherm.llm.common import fresh, join_counts, materialise, text_of, words_of

SYMBOLS = "#*$%&|<>"
#: Each rule's rate in thousandths, from the columns of ``with_features``.
RULES = ("symbols", "dup_lines", "repeats", "capitals")
#: Cutoffs in thousandths, lax to strict.
CUTOFFS = (900, 800, 700, 600, 500, 400, 350, 300, 250, 200, 170, 140, 120, 100, 80, 60, 50, 40, 30, 20)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _symbols(text: Column) -> Column:
    """How many of ``SYMBOLS``: bytes lost by plain replacement, much faster than translate()."""
    left = text
    for c in SYMBOLS:
        left = F.replace(left, F.lit(c), F.lit(""))
    return F.octet_length(text) - F.octet_length(left)


def _neighbours(array: Column, fn) -> Column:
    """``fn`` over each element and the next one."""
    short = F.greatest(F.size(array) - 1, F.lit(0))
    return F.zip_with(F.slice(array, F.lit(1), short), F.slice(array, F.lit(2), short), fn)


def with_features(docs: DataFrame, *, text: str = "text", out: str = "features") -> DataFrame:
    """``docs`` with a struct of the counts (``COUNTS``) and of the rate of each rule.

    Windows of three words are compared by a 64-bit hash first; only a text in which two hashes
    are equal sorts its own hashes, and equal neighbours then compare their words. No row leaves its task.
    """
    t, w, h, s, p = (fresh(docs, f"_{out}_{x}") for x in "twhsp")
    step = docs.withColumn(t, text_of(F.col(text)))
    step = step.withColumn(w, words_of(F.col(t)))
    inner = F.slice(F.col(w), F.lit(1), F.greatest(F.size(w) - 2, F.lit(0)))
    step = step.withColumn(
        h, F.transform(inner, lambda x, i: F.xxhash64(x, F.get(F.col(w), i + 1), F.get(F.col(w), i + 2)))
    )
    numbered = F.transform(F.col(h), lambda x, i: F.struct(x.alias("h"), i.alias("i")))
    step = step.withColumn(s, F.when(F.size(F.array_distinct(h)) < F.size(h), F.sort_array(numbered)))
    word = lambda x, k: F.get(F.col(w), x["i"] + k)
    same = _neighbours(
        F.col(s),
        lambda a, b: F.when(
            (a["h"] == b["h"])
            & (word(a, 0) == word(b, 0)) & (word(a, 1) == word(b, 1)) & (word(a, 2) == word(b, 2)),
            F.array(a["i"], b["i"]),
        ),
    )
    step = step.withColumn(
        p, F.when(F.col(s).isNotNull(), F.array_sort(F.array_distinct(F.flatten(F.filter(same, lambda x: x.isNotNull())))))
    )
    covered = F.aggregate(
        _neighbours(F.col(p), lambda a, b: F.least(b - a, F.lit(3))), F.lit(0), lambda total, x: total + x
    )
    lines = F.filter(F.split(F.col(t), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    n = F.size(w).cast("long")
    repeated = F.when(F.size(p) > 0, covered + 3).otherwise(0).cast("long")
    chars = F.length(F.concat_ws("", w)).cast("long")
    symbols = _symbols(F.col(t)).cast("long")
    n_lines, dup = F.size(lines), (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")
    rate = lambda a, b: F.floor(1000 * a / F.greatest(b, F.lit(1)))
    step = step.withColumn(
        out,
        F.struct(
            n.alias("n_words"),
            chars.alias("word_chars"),
            symbols.alias("n_symbols"),
            dup.alias("n_dup_lines"),
            repeated.alias("n_repeat_words"),
            rate(symbols, chars).alias("symbols"),
            rate(dup, n_lines).alias("dup_lines"),
            rate(repeated, n).alias("repeats"),
            rate(F.octet_length(t) - F.octet_length(F.regexp_replace(t, "[A-Z]+", "")), chars).alias("capitals"),
        ),
    )
    return step.drop(t, w, h, s, p)


def base_failed(features: Column) -> Column:
    n = features["n_words"]
    return (n < 50) | (100 * features["n_repeat_words"] > 50 * n)


def _log_gamma(x: Column) -> Column:
    """Logarithm of the gamma function for x >= 1, by Stirling's series ten steps up."""
    y = x + 10.0
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7)
    steps = reduce(lambda a, b: a * b, [x + float(i) for i in range(10)])
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series - F.log(steps)


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for a binomial X with k <= n p: the largest term, and those below it by their ratios.

    Terms fall off like a normal density at least; those 12 deviations below the largest are
    under 1e-31 of it and left out.
    """
    k, n = k.cast("double"), n.cast("double")
    largest = (
        _log_gamma(n + 1) - _log_gamma(k + 1) - _log_gamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)
    )
    count = F.least(k, F.ceil(12 * F.sqrt(n * (p * (1 - p)))) + 60).cast("int")
    places = F.filter(F.sequence(F.lit(0), count), lambda i: i < count)
    one = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"))

    def step(so_far: Column, i: Column) -> Column:
        term = so_far["term"] * (k - i) * (1 - p) / ((n - k + i + 1) * p)
        return F.struct(term.alias("term"), (so_far["sum"] + term).alias("sum"))

    return F.exp(largest) * F.aggregate(places, one, step, lambda x: x["sum"])


def stratum(value: Column) -> Column:
    """A key that is never null: null is a stratum of its own."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit(""))


def cutoffs(
    featured: DataFrame, labels: DataFrame, *, key: str = "doc_id", by: str = "lang", out: str = "features",
    risk: float = 0.04, delta: float = 0.05,
) -> DataFrame:
    """``stratum, n`` and a cutoff per rule, null where none is accepted, from the documents whose label
    says good; ``n`` of them count.

    Only the key, the stratum and four rates are shuffled. A good document that fails a fixed
    rule is not counted: these rules can't lose it any more.
    """
    good = labels.groupBy(F.col(key).alias("_key")).agg(F.min("quality").alias("_q")).filter("_q = 1").select("_key")
    narrow = featured.filter(~base_failed(F.col(out))).select(
        F.col(key).alias("_key"), stratum(F.col(by)).alias("stratum"), *[F.col(out)[r].alias(r) for r in RULES]
    )
    over = [F.array(*[F.sum((F.col(r) > c).cast("long")) for c in CUTOFFS]).alias(r) for r in RULES]
    counts = materialise(narrow.join(good, "_key").groupBy("stratum").agg(F.count(F.lit(1)).alias("n"), *over), "quality-counts")
    level, p, n = delta / (len(RULES) * max(1, counts.count())), risk / len(RULES), F.col("n")

    def last_accepted(rule: str) -> Column:
        passed = F.transform(rule, lambda k: F.when(k > p * n, False).otherwise(binomial_tail(k, n, p) <= level))
        failed = F.array_position(passed, F.lit(False)).cast("int")  # counted from 1; 0 where all passed
        return F.when(failed == 0, CUTOFFS[-1]).when(failed > 1, F.get(F.array(*map(F.lit, CUTOFFS)), failed - 2))

    return counts.select("stratum", "n", *[last_accepted(r).alias(r) for r in RULES])


def judged(featured: DataFrame, cuts: DataFrame, *, by: str = "lang", out: str = "features") -> DataFrame:
    """``featured`` with ``base_failed`` and ``kept`` in the struct ``out``.

    ``featured`` is a written table. Cutoffs go back to its rows by stratum; strata with more than a thousandth
    of the rows are broadcast, so a language that holds most rows stays where it is.
    """
    key, size, cut = (fresh(featured, f"_{out}_{x}") for x in ("stratum", "rows", "cut"))
    keyed = featured.withColumn(key, stratum(F.col(by)))
    packed = cuts.select(F.col("stratum").alias(key), F.struct(*RULES).alias(cut))
    sizes = keyed.groupBy(key).agg(F.count(F.lit(1)).alias(size)).join(packed, key, "left")
    rows = join_counts(keyed, materialise(sizes, "quality-cutoffs"), [key], n=size, total=featured.count())
    f = F.col(out)
    failed = base_failed(f)
    rejected = reduce(lambda a, b: a | b, [F.coalesce(f[r] > F.col(cut)[r], F.lit(False)) for r in RULES])
    return rows.withColumn(out, f.withField("base_failed", failed).withField("kept", ~failed & ~rejected)).select(*featured.columns)


def verdicts(
    docs: DataFrame, labels: DataFrame, *, text: str = "text", key: str = "doc_id", by: str = "lang",
    risk: float = 0.04, delta: float = 0.05, out: str = "features", cuts: DataFrame | None = None,
) -> DataFrame:
    """``docs`` with the struct ``out``: counts, rates, ``base_failed`` and ``kept``.

    The counts are written with the rows once; thresholds read the narrow columns of that table, and no
    later filter repeats the counting.
    """
    featured = materialise(with_features(docs, text=text, out=out), "quality")
    if cuts is None:
        cuts = cutoffs(featured, labels, key=key, by=by, out=out, risk=risk, delta=delta)
    return judged(featured, cuts, by=by, out=out)
