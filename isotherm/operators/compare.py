"""Agreement of two labelings of the same rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isotherm.functions.exprs import ARI_BANDS, NMI_BANDS, bands, overall_verdict


def labels_join(
    left: DataFrame,
    right: DataFrame,
    *,
    keys: Sequence[str] = ("lat", "lon"),
    label: str = "cluster",
    suffixes: Sequence[str] = ("_a", "_b"),
) -> DataFrame:
    """Inner join of two labelings on the row key, labels told apart by suffix."""
    return left.select(*keys, F.col(label).alias(f"{label}{suffixes[0]}")).join(
        right.select(*keys, F.col(label).alias(f"{label}{suffixes[1]}")), list(keys), "inner"
    )


def confusion_matrix(df: DataFrame, *, a: str = "cluster_a", b: str = "cluster_b") -> DataFrame:
    """Long form: ``a, b, n`` for the pairs that occur."""
    return df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))


def confusion_wide(
    df: DataFrame, values: Sequence | None = None, *, a: str = "cluster_a", b: str = "cluster_b"
) -> DataFrame:
    """Zero-filled crosstab; pass the known labels of ``b`` to save a job."""
    counts = confusion_matrix(df, a=a, b=b)
    wide = counts.groupBy(a).pivot(b, list(values) if values is not None else None).agg(F.sum("n"))
    return wide.na.fill(0)


def best_mapping(df: DataFrame, *, a: str = "cluster_a", b: str = "cluster_b") -> DataFrame:
    """For every label of ``a`` the label of ``b`` it shares most rows with (ties to the
    smallest) and the shared part."""
    best = (
        confusion_matrix(df, a=a, b=b)
        .groupBy(a)
        .agg(F.min(F.struct((-F.col("n")).alias("n"), F.col(b).alias("b"))).alias("m"), F.sum("n").alias("total"))
    )
    return best.select(
        a,
        F.col("m.b").alias(b),
        (-F.col("m.n")).alias("overlap"),
        "total",
        (-F.col("m.n") / F.col("total")).alias("share"),
    )


def label_scores(df: DataFrame, *, a: str = "cluster_a", b: str = "cluster_b") -> DataFrame:
    """``n, ari, nmi, agreement_rate`` in one pass over the rows.

    The contingency table carries everything: grouping sets over its few rows give the
    joint and both margins, and each score is a sum of pairs or of n ln n per level.
    """
    counts = confusion_matrix(df, a=a, b=b)
    same = F.sum(F.when(F.col(a) == F.col(b), F.col("n"))).alias("same")
    levels = counts.groupingSets([[F.col(a), F.col(b)], [F.col(a)], [F.col(b)]], F.col(a), F.col(b)).agg(
        F.sum("n").cast("double").alias("n"), F.grouping_id().alias("level"), same
    )
    joint, by_a, by_b = (F.col("level") == v for v in (0, 1, 2))

    def pairs(level: Column) -> Column:
        return F.sum(F.when(level, F.col("n") * (F.col("n") - 1.0) / 2.0))

    def information(level: Column) -> Column:
        return F.sum(F.when(level, F.col("n") * F.ln("n")))

    sums = levels.agg(
        F.sum(F.when(joint, F.col("n"))).alias("n"),
        F.coalesce(F.sum(F.when(joint, F.col("same"))), F.lit(0)).alias("same"),
        pairs(joint).alias("p"),
        pairs(by_a).alias("pa"),
        pairs(by_b).alias("pb"),
        information(joint).alias("i"),
        information(by_a).alias("ia"),
        information(by_b).alias("ib"),
    )
    n = F.col("n")
    expected = F.try_divide(F.col("pa") * F.col("pb"), n * (n - 1.0) / 2.0)
    limit = (F.col("pa") + F.col("pb")) / 2.0
    ari = F.when(
        (F.col("p") == F.col("pa")) & (F.col("p") == F.col("pb")), F.lit(1.0)
    ).otherwise(F.try_divide(F.col("p") - expected, limit - expected))
    h, ha, hb = (F.ln(n) - F.col(c) / n for c in ("i", "ia", "ib"))
    # Two single-class labelings carry no information and count as equal.
    nmi = F.when((F.col("ia") == F.col("ib")) & (F.col("ia") == n * F.ln(n)), F.lit(1.0)).otherwise(
        F.coalesce(F.try_divide(F.greatest(ha + hb - h, F.lit(0.0)), (ha + hb) / 2.0), F.lit(0.0))
    )
    return sums.select(
        n.cast("long").alias("n"),
        ari.alias("ari"),
        nmi.alias("nmi"),
        F.try_divide(F.col("same").cast("double"), n).alias("agreement_rate"),
    )


def adjusted_rand(df: DataFrame, **labels: str) -> DataFrame:
    return label_scores(df, **labels).select("ari")


def nmi(df: DataFrame, **labels: str) -> DataFrame:
    return label_scores(df, **labels).select("nmi")


def agreement(df: DataFrame, *, a: str = "cluster_a", b: str = "cluster_b") -> DataFrame:
    """Flag per row whether both labels are equal."""
    return df.withColumn("agreement", F.col(a) == F.col(b))


def agreement_rate(df: DataFrame, *, a: str = "cluster_a", b: str = "cluster_b") -> DataFrame:
    equal = F.col(a) == F.col(b)
    return df.agg(
        F.count_if(equal).alias("n_agree"),
        F.count_if(~equal).alias("n_disagree"),
        F.avg(equal.cast("double")).alias("agreement_rate"),
    )


def validation_verdict(scores: DataFrame) -> DataFrame:
    """Add the bands of both scores and the overall verdict."""
    return scores.withColumns(
        {
            "ari_band": bands("ari", ARI_BANDS, "low"),
            "nmi_band": bands("nmi", NMI_BANDS, "moderate"),
            "verdict": overall_verdict("ari", "agreement_rate"),
        }
    )


def paired_sizes(df: DataFrame, *, a: str = "cluster_a", b: str = "cluster_b") -> DataFrame:
    """Sizes of equal label values side by side; a label only one side uses gets 0."""
    counts = confusion_matrix(df, a=a, b=b)
    both = counts.select(
        F.explode(
            F.array(
                F.struct(F.col(a).alias("label"), F.col("n").alias("n_a"), F.lit(0).cast("long").alias("n_b")),
                F.struct(F.col(b).alias("label"), F.lit(0).cast("long").alias("n_a"), F.col("n").alias("n_b")),
            )
        ).alias("e")
    )
    return both.groupBy(F.col("e.label").alias("label")).agg(
        F.sum("e.n_a").alias("n_a"), F.sum("e.n_b").alias("n_b")
    )
