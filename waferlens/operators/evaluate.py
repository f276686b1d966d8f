"""Classifier metrics as aggregations: counts are combined map-side, then a few rows remain."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waferlens.functions.columns import percentage, safe_ratio
from waferlens.operators.ordering import SINGLE_TASK_ROWS, running_sum
from waferlens.shared import materialise

BINARY = (0, 1)


def _tally(hit: Column, weight: str | None) -> Column:
    """How many rows hit, where a row stands for ``weight`` rows."""
    if weight is None:
        return F.count(F.when(hit, 1))
    return F.coalesce(F.sum(F.when(hit, F.col(weight))), F.lit(0).cast("long"))


def _cell(truth: str, prediction: str, actual: int, predicted: int, weight: str | None) -> Column:
    return _tally((F.col(truth) == actual) & (F.col(prediction) == predicted), weight)


def confusion_matrix(
    scored: DataFrame,
    truth: str = "truth",
    prediction: str = "prediction",
    classes: Sequence[int] = BINARY,
    weight: str | None = None,
) -> DataFrame:
    """(truth, prediction, n) over the full class grid, zero cells included."""
    cells = [
        F.struct(
            F.lit(actual).alias("truth"),
            F.lit(predicted).alias("prediction"),
            _cell(truth, prediction, actual, predicted, weight).alias("n"),
        )
        for actual in classes
        for predicted in classes
    ]
    return scored.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def _f1(precision: Column, recall: Column) -> Column:
    return safe_ratio(2 * precision * recall, precision + recall)


def binary_prf(
    scored: DataFrame,
    truth: str = "truth",
    prediction: str = "prediction",
    positive: int = 1,
    weight: str | None = None,
) -> DataFrame:
    """Precision, recall and F1 of the positive class in one row; 0/0 counts as 0."""
    is_truth, is_predicted = F.col(truth) == positive, F.col(prediction) == positive
    counts = scored.agg(
        _tally(is_truth & is_predicted, weight).alias("hits"),
        _tally(is_predicted, weight).alias("predicted"),
        _tally(is_truth, weight).alias("actual"),
    )
    return counts.select(
        safe_ratio(F.col("hits"), F.col("predicted")).alias("precision"),
        safe_ratio(F.col("hits"), F.col("actual")).alias("recall"),
    ).withColumn("f1_score", _f1(F.col("precision"), F.col("recall")))


def classification_report(
    scored: DataFrame,
    truth: str = "truth",
    prediction: str = "prediction",
    classes: Sequence[int] = BINARY,
    weight: str | None = None,
) -> DataFrame:
    """Per-class scores plus accuracy, macro and weighted averages, one row each.

    The accuracy row carries the accuracy as ``f1_score`` and leaves the other
    scores NULL.
    """
    measures = []
    for c in classes:
        is_truth, is_predicted = F.col(truth) == c, F.col(prediction) == c
        measures += [
            _tally(is_truth & is_predicted, weight).alias(f"hits_{c}"),
            _tally(is_predicted, weight).alias(f"predicted_{c}"),
            _tally(is_truth, weight).alias(f"actual_{c}"),
        ]
    counts = scored.agg(*measures)
    scores = counts.select(
        *[
            F.struct(
                safe_ratio(F.col(f"hits_{c}"), F.col(f"predicted_{c}")).alias("precision"),
                safe_ratio(F.col(f"hits_{c}"), F.col(f"actual_{c}")).alias("recall"),
                F.col(f"hits_{c}").alias("hits"),
                F.col(f"actual_{c}").alias("support"),
            ).alias(f"class_{c}")
            for c in classes
        ]
    )

    def score(c: int, measure: str) -> Column:
        if measure == "f1_score":
            return _f1(F.col(f"class_{c}.precision"), F.col(f"class_{c}.recall"))
        return F.col(f"class_{c}.{measure}")

    def total(part) -> Column:
        first, *rest = [part(c) for c in classes]
        return sum(rest, first)

    support = total(lambda c: score(c, "support"))
    rated = ("precision", "recall", "f1_score")

    def row(label: str, values: dict[str, Column], rows: Column) -> Column:
        none = F.lit(None).cast("double")
        return F.struct(
            F.lit(label).alias("label"),
            *[values.get(measure, none).alias(measure) for measure in rated],
            rows.alias("support"),
        )

    rows = [
        row(str(c), {m: score(c, m) for m in rated}, score(c, "support")) for c in classes
    ]
    accuracy = safe_ratio(total(lambda c: score(c, "hits")), support)
    rows.append(row("accuracy", {"f1_score": accuracy}, support))
    macro = {m: total(lambda c, m=m: score(c, m)) / len(classes) for m in rated}
    rows.append(row("macro avg", macro, support))
    weighted = {
        m: safe_ratio(total(lambda c, m=m: score(c, m) * score(c, "support")), support)
        for m in rated
    }
    rows.append(row("weighted avg", weighted, support))
    return scores.select(F.inline(F.array(*rows)))


def roc_auc(
    scored: DataFrame,
    truth: str = "truth",
    score: str = "score",
    positive: int = 1,
    single_task_rows: int = SINGLE_TASK_ROWS,
    weight: str | None = None,
) -> DataFrame:
    """Exact area under the ROC curve in one row; tied scores count half.

    Rows are first counted per distinct score, which folds any heavy score;
    the running count of negatives is range-partitioned when there are many
    scores. NULL when only one class is present.
    """
    is_positive = F.col(truth) == positive
    per_score = scored.groupBy(F.col(score).alias("_score")).agg(
        _tally(is_positive, weight).alias("_positives"),
        _tally(~is_positive, weight).alias("_negatives"),
    )
    ranked = running_sum(per_score, ["_score"], "_negatives", "_upto", single_task_rows)
    beaten = F.col("_upto") - F.col("_negatives") / 2
    pairs = F.sum("_positives").cast("double") * F.sum("_negatives")
    return ranked.agg(
        F.try_divide(F.sum(F.col("_positives") * beaten), pairs).alias("roc_auc")
    )


def label_profile(
    df: DataFrame, target: str = "is_fail", split: str | None = None, weight: str | None = None
) -> DataFrame:
    """Row count and positive share in percent; train and test counts if split."""
    parts = [_tally(F.lit(True), weight).alias("rows_total")]
    if split is not None:
        parts += [
            _tally(F.col(split) == "train", weight).alias("rows_train"),
            _tally(F.col(split) == "test", weight).alias("rows_test"),
        ]
    positives = F.sum(target) if weight is None else F.sum(F.col(target) * F.col(weight))
    known = _tally(F.col(target).isNotNull(), weight)
    parts.append(percentage(positives, known).alias("positive_rate_pct"))
    return df.agg(*parts)


def metrics_record(
    dataset: DataFrame,
    scored: DataFrame,
    features: Sequence[str],
    importances: DataFrame | None = None,
    target: str = "is_fail",
    split: str | None = "split",
    prediction: str = "prediction",
    score: str = "score",
) -> DataFrame:
    """Everything recorded about one training run, as one nested row.

    The scored rows are read once: they are counted by score, truth and
    prediction, and all measures come from these counts. The profile too, where
    the dataset is those very rows. All inputs of the final aggregation are
    one-row or class-grid tables.
    """
    weight = "_times"
    counted = materialise(
        scored.groupBy(score, target, prediction).agg(F.count(F.lit(1)).alias(weight))
    )
    if dataset is scored and split is None:
        profile = label_profile(counted, target, None, weight)
    else:
        profile = label_profile(dataset, target, split)
    prf = binary_prf(counted, target, prediction, weight=weight).select(
        F.round("f1_score", 4).alias("f1_fail_class"),
        F.round("precision", 4).alias("precision_fail"),
        F.round("recall", 4).alias("recall_fail"),
    )
    auc = roc_auc(counted, target, score, weight=weight).select(F.round("roc_auc", 4).alias("roc_auc"))
    cells = confusion_matrix(counted, target, prediction, weight=weight).groupBy("truth").agg(
        F.sort_array(F.collect_list(F.struct("prediction", "n"))).alias("row")
    )
    matrix = cells.agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("truth", "row"))),
            lambda line: F.transform(line["row"], lambda cell: cell["n"]),
        ).alias("confusion_matrix")
    )
    report = classification_report(counted, target, prediction, weight=weight).agg(
        F.map_from_entries(
            F.collect_list(
                F.struct("label", F.struct("precision", "recall", "f1_score", "support"))
            )
        ).alias("classification_report")
    )
    parts = [profile.withColumn("feature_count", F.lit(len(features))), prf, auc, matrix, report]
    if importances is not None:
        parts.append(
            importances.agg(
                F.transform(
                    F.sort_array(
                        F.collect_list(F.struct("importance", "feature")), asc=False
                    ),
                    lambda entry: F.struct(entry["feature"], entry["importance"]),
                ).alias("top_features")
            )
        )
    return one_row(*parts)


def one_row(*parts: DataFrame) -> DataFrame:
    """Put one-row tables side by side."""
    stacked, *others = parts
    for other in others:
        stacked = stacked.unionByName(other, allowMissingColumns=True)
    return stacked.agg(*[F.first(c, ignorenulls=True).alias(c) for c in stacked.columns])
