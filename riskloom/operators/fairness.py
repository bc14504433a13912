"""Score behaviour per protected group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.columns import band_right_closed
from riskloom.operators.metrics import auc
from riskloom.plans.joins import checked_left_join
from riskloom.plans.shape import tall

# Age bands (low, high] of the audit and its minimum group sizes.
AGE_EDGES = (18.0, 30.0, 40.0, 50.0, 60.0, 100.0)
AGE_LABELS = ("18-30", "31-40", "41-50", "51-60", "60+")
MIN_ROWS, MIN_POSITIVES = 100, 10


def age_group(days_birth):
    return band_right_closed(-days_birth / F.lit(365.0), AGE_EDGES, AGE_LABELS)


def with_demographics(
    predictions: DataFrame, demographics: DataFrame, attributes: Sequence[str], key: str
) -> DataFrame:
    known = [a for a in attributes if a in demographics.columns]
    return predictions.join(demographics.select(key, *known), key, "left")


def row_count_mismatch(
    predictions: DataFrame, demographics: DataFrame, key: str = "SK_ID_CURR"
) -> DataFrame:
    """One row: rows before and after the join, and whether they differ."""
    copies = demographics.groupBy(key).agg(F.count(F.lit(1)).alias("_copies"))
    return (
        predictions.select(key)
        .join(copies, key, "left")
        .agg(
            F.count(F.lit(1)).alias("n_predictions"),
            F.coalesce(F.sum(F.coalesce("_copies", F.lit(1))), F.lit(0)).alias("n_joined"),
        )
        .withColumn("row_count_mismatch", F.col("n_predictions") != F.col("n_joined"))
    )


def fairness_report(
    predictions: DataFrame,
    demographics: DataFrame,
    attributes: Sequence[str] = ("CODE_GENDER",),
    key: str = "SK_ID_CURR",
    score: str = "predicted_pd",
    target: str = "TARGET",
    checked: bool = False,
) -> DataFrame:
    """Per attribute and group: count, mean score, disparity to all rows, mean target.

    Rows whose attribute is missing count in the overall mean but form no group.
    ``row_count_mismatch`` is true where demographics repeat a key and the join made rows.
    ``checked=True`` raises instead.
    """
    if checked:
        known = [a for a in attributes if a in demographics.columns]
        merged = checked_left_join(predictions, demographics.select(key, *known), key)
    else:
        merged = with_demographics(predictions, demographics, attributes, key)
    known = [a for a in attributes if a in merged.columns]
    measures = [score] + ([target] if target in merged.columns else [])
    overall = merged.agg(F.avg(score)).scalar()
    groups = tall(merged, known, measures, "attribute", "grp", "string")
    out = groups.where(F.col("grp").isNotNull()).groupBy("attribute", "grp").agg(
        F.count(F.lit(1)).alias("count"),
        F.avg(score).alias("mean_pred"),
        *[F.avg(F.col(t).cast("double")).alias("mean_target") for t in measures[1:]],
    )
    mismatch = row_count_mismatch(predictions, demographics, key).select("row_count_mismatch")
    return out.withColumns(
        {
            "overall_mean_pred": overall,
            "disparity": F.col("mean_pred") - overall,
            "row_count_mismatch": mismatch.scalar(),
        }
    )


def auc_by_group(
    df: DataFrame,
    group: str,
    label: str = "label",
    score: str = "score",
    groups: Sequence[str] | None = None,
    min_rows: int = MIN_ROWS,
    min_positives: int = MIN_POSITIVES,
    digits: int | None = None,
) -> DataFrame:
    """AUC, size and base rate per group; groups too small for a ranking drop out."""
    rows = df.where(F.col(group).isNotNull())
    if groups is not None:
        rows = rows.where(F.col(group).isin(*groups))
    out = auc(rows, label, score, [group], digits)
    big = (F.col("n") > min_rows) & (F.col("positives") > min_positives)
    return out.where(big).withColumn(
        "base_rate", F.col("positives").cast("double") / F.col("n")
    )
