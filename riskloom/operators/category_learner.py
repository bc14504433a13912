"""The third learner: ordered target statistics of raw categories, feeding a tree model.

A row's category is coded by the mean target of the rows before it in a seeded order
that share the category, pulled to the mean of all rows before it. No label moves its
own row's code. Every fold's model has codes of its own that never see the held-out
rows: a held-out or new row is coded from all training rows.

The order is cut into buckets. One shuffle deals the rows by bucket and serves the
running totals of every column; what earlier buckets hold of a category is added from a
table with a row per (column, category, bucket). A category with most of the rows is
spread over all buckets, so it meets no single task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml import Estimator
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.operators.training import CvResult, mean_scores, prepare, probability
from riskloom.plans.joins import lookup_join
from riskloom.plans.lineage import checkpointed, stored
from riskloom.plans.shape import tall

ROWS_PER_BUCKET = 100_000
PRIOR_WEIGHT = 1.0
ORDER_BITS = 60
# the column that holds every row in one category; its code is the prior of the others
EVERYONE = "_everyone"


def order_of(key: str, seed: int = 42) -> Column:
    """Position of a key in the seeded order: the first 60 bits of an MD5, so that
    programs other than Spark can repeat it."""
    digest = F.md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, ORDER_BITS // 4), 16, 10).cast("long")


def category_key(column: str) -> Column:
    """The category as text; a missing one is a category of its own."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit(""))


def _own(fold: str, k: int, value: str) -> Column:
    return F.when(F.col(fold) == k, F.col(value)).otherwise(F.lit(0.0))


def _sums(fold: str, folds: int, over: Callable[[Column], Column]) -> Column:
    """Per model k: labelled rows and positives outside fold k."""
    n, s = over(F.sum("_known")), over(F.sum("_y"))
    zero = F.lit(0.0)
    return F.array(
        *[
            F.struct(
                (F.coalesce(n, zero) - F.coalesce(over(F.sum(_own(fold, k, "_known"))), zero)).alias("n"),
                (F.coalesce(s, zero) - F.coalesce(over(F.sum(_own(fold, k, "_y"))), zero)).alias("s"),
            )
            for k in range(folds)
        ]
    )


def _added(a: str, b: str) -> Column:
    """Entry by entry sum of two arrays of (n, s); a missing array counts as zeros."""
    return F.when(F.col(b).isNull(), F.col(a)).otherwise(
        F.zip_with(
            a, b, lambda x, y: F.struct((x["n"] + y["n"]).alias("n"), (x["s"] + y["s"]).alias("s"))
        )
    )


def _training_sums(c: str) -> Column:
    """Per model: the training rows before the row; all of them where it is held out."""

    def chosen(v: Column, k: Column) -> Column:
        return F.when(F.col("_fold") == k, F.get(f"_w_{c}", k)).otherwise(v)

    return F.transform(_added(f"_i_{c}", f"_o_{c}"), chosen)


@dataclass
class OrderedCodes:
    """``rows`` is the input with ``<column>_ots`` arrays, one code per fold model;
    ``whole`` holds per (feature, category) the training sums of every model and
    ``everyone`` the (rows, positives) each model trains on."""

    columns: list[str]
    weight: float
    rows: DataFrame
    whole: DataFrame
    everyone: list[tuple[float, float]]

    def for_model(self, k: int) -> DataFrame:
        """The rows as model k sees them: one code per column."""
        return self.rows.withColumns(
            {f"{c}_ots": F.get(f"{c}_ots", F.lit(k)) for c in self.columns}
        )

    def transform(self, df: DataFrame) -> DataFrame:
        """New rows with ``<column>_ots`` arrays: every training row counts; an unseen
        category gets the training mean."""
        out = df
        for c in self.columns:
            sums = self.whole.where(F.col("feature") == c)
            one = sums.select(F.col("category").alias(f"_k_{c}"), F.col("whole").alias(f"_t_{c}"))
            out = lookup_join(out.withColumn(f"_k_{c}", category_key(c)), one, [f"_k_{c}"])
        everyone = F.array(
            *[F.struct(F.lit(n).alias("n"), F.lit(s).alias("s")) for n, s in self.everyone]
        )
        folds = len(self.everyone)
        codes = [
            _codes(F.col(f"_t_{c}"), everyone, folds, self.weight).alias(f"{c}_ots")
            for c in self.columns
        ]
        return out.select(*df.columns, *codes)


def _codes(sums: Column, everyone: Column, folds: int, weight: float) -> Column:
    """Smoothed mean per model; the mean of everyone before the row is the prior."""

    def code(k: int) -> Column:
        all_, own = F.get(everyone, F.lit(k)), F.get(sums, F.lit(k))
        prior = (all_["s"] + 0.5) / (all_["n"] + 1.0)
        n, s = F.coalesce(own["n"], F.lit(0.0)), F.coalesce(own["s"], F.lit(0.0))
        return (s + prior * weight) / (n + weight)

    return F.array(*[code(k) for k in range(folds)])


def ordered_codes(
    df: DataFrame,
    columns: Sequence[str],
    key: str,
    target: str,
    folds: int,
    fold: str = "fold",
    weight: float = PRIOR_WEIGHT,
    seed: int = 42,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> OrderedCodes:
    """Code the columns for all fold models in one pass over the rows.

    ``key`` is unique. Rows without a label are coded but count nowhere; a row without
    a fold counts for every model.
    """
    names = [EVERYONE, *columns]
    buckets = df.count() // rows_per_bucket + 1
    y = F.col(target).cast("double")
    # a fold of its own for rows without one, so that sums by fold lose no row
    home = F.coalesce(F.col(fold).cast("int"), F.lit(-1))
    keyed = df.withColumn("_h", order_of(key, seed)).withColumns(
        {
            "_b": F.floor(F.col("_h") / (2.0**ORDER_BITS / buckets)).cast("int"),
            "_fold": home,
            "_y": F.coalesce(y, F.lit(0.0)),
            "_known": y.isNotNull().cast("double"),
            f"_k_{EVERYONE}": F.lit(""),
            **{f"_k_{c}": category_key(c) for c in columns},
        }
    )
    cells = tall(keyed, [f"_k_{c}" for c in names], ["_b", "_fold", "_y", "_known"], "feature", "category", "string")
    per_bucket = stored(
        cells.withColumn("feature", F.substring("feature", 4, 1 << 20))
        .groupBy("feature", "category", "_b", "_fold")
        .agg(F.sum("_y").alias("_y"), F.sum("_known").alias("_known")),
        "ordered-sums",
    )
    whole = stored(
        per_bucket.groupBy("feature", "category").agg(
            _sums("_fold", folds, lambda c: c).alias("whole")
        ),
        "ordered-whole",
    )
    # at most a row per bucket and fold in each (column, category) window
    earlier = Window.partitionBy("feature", "category").orderBy("_b").rangeBetween(Window.unboundedPreceding, -1)
    before = stored(
        per_bucket.select(
            "feature", "category", "_b", _sums("_fold", folds, lambda c: c.over(earlier)).alias("before")
        ).distinct(),
        "ordered-before",
    )

    # dealt by bucket once: every window below finds its rows in place
    inside = {
        c: Window.partitionBy("_b", f"_k_{c}").orderBy("_h", key).rowsBetween(Window.unboundedPreceding, -1)
        for c in names
    }
    local = keyed.repartition("_b")
    for c in names:
        local = local.withColumn(f"_i_{c}", _sums("_fold", folds, lambda s, c=c: s.over(inside[c])))
    for c in names:
        one = before.where(F.col("feature") == c).select(
            F.col("category").alias(f"_k_{c}"), "_b", F.col("before").alias(f"_o_{c}")
        )
        total = whole.where(F.col("feature") == c).select(
            F.col("category").alias(f"_k_{c}"), F.col("whole").alias(f"_w_{c}")
        )
        local = lookup_join(local, one, [f"_k_{c}", "_b"])
        local = lookup_join(local, total, [f"_k_{c}"])
    sums = local.withColumns({f"_t_{c}": _training_sums(c) for c in names})
    coded = sums.select(
        *df.columns,
        *[
            _codes(F.col(f"_t_{c}"), F.col(f"_t_{EVERYONE}"), folds, weight).alias(f"{c}_ots")
            for c in columns
        ],
    )
    row = whole.where(F.col("feature") == EVERYONE).first()
    everyone = [(v["n"], v["s"]) for v in row["whole"]] if row else [(0.0, 0.0)] * folds
    return OrderedCodes(list(columns), weight, stored(coded, "ordered-codes"), whole, everyone)


@dataclass
class CategoryCv:
    """Fold models over numbers and ordered codes, with their out-of-fold scores."""

    result: CvResult
    codes: OrderedCodes
    key: str

    def predict(self, df: DataFrame) -> DataFrame:
        """(key, p): mean over the fold models, each reading its own codes."""
        coded, parts = self.codes.transform(df), []
        for k, model in enumerate(self.result.models):
            seen = coded.withColumns({f"{c}_ots": F.get(f"{c}_ots", F.lit(k)) for c in self.codes.columns})
            rows = seen.withColumns({"_label": F.lit(0.0), "_none": F.lit(0)})
            ready = prepare(rows, self.result.chosen[k], self.key, "_label", "_none")
            parts.append(model.transform(ready).select(self.key, probability().alias("p")))
        return mean_scores(parts, self.key)


def run_category_cv(
    df: DataFrame,
    categories: Sequence[str],
    numbers: Sequence[str],
    key: str,
    label: str,
    build: Callable[[], Estimator],
    folds: int,
    fold: str = "fold",
    weight: float = PRIOR_WEIGHT,
    seed: int = 42,
) -> CategoryCv:
    """Cross-validate a learner on raw categories. Rows without label or fold are left out."""
    known = df.where(F.col(label).isNotNull() & F.col(fold).isNotNull())
    codes = ordered_codes(known, categories, key, label, folds, fold, weight, seed)
    features = [*numbers, *[f"{c}_ots" for c in categories]]
    models, oof = [], None
    for k in range(folds):
        rows = prepare(codes.for_model(k), features, key, label, fold)
        held_out = F.col("fold") == k
        estimator = build()
        if estimator.hasParam("validationIndicatorCol"):
            model = estimator.fit(rows.withColumn("_validation", held_out))
        else:
            model = estimator.fit(rows.where(~held_out))
        models.append(model)
        part = model.transform(rows.where(held_out)).select(key, "fold", "label", probability().alias("p"))
        oof = part if oof is None else oof.unionByName(part)
    if oof is None:
        raise ValueError("no folds")
    return CategoryCv(CvResult([features] * folds, models, checkpointed(oof)), codes, key)
