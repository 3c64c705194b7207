"""Scoring quality against labels: confusion counts, ROC-AUC, average precision."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.operators.cumulative import ranged, running_sums
from riskloom.operators.relational import with_labels


def _count(condition: Column) -> Column:
    return F.coalesce(F.sum(condition.cast("bigint")), F.lit(0))


def _ratio(top: Column, bottom: Column) -> Column:
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def classification_report(
    scored: DataFrame, *, by: list[str] | None = None, label: str = "is_fraud", flag: str = "is_flagged"
) -> DataFrame:
    """Counts, rates, precision, recall and F1 in one aggregation, optionally per subgroup.

    A ratio with denominator 0 is 0. Rows without label cannot be judged and are left out.
    """
    return _rates(scored.where(F.col(label).isNotNull()).groupBy(*(by or [])).agg(*_confusion(label, flag)), by or [])


def _confusion(label: str, flag: str) -> list[Column]:
    y, hit = F.col(label).cast("boolean"), F.col(flag).cast("boolean")
    return [
        F.count("*").alias("n_samples"),
        _count(~y & ~hit).alias("true_negatives"),
        _count(~y & hit).alias("false_positives"),
        _count(y & ~hit).alias("false_negatives"),
        _count(y & hit).alias("true_positives"),
    ]


def _rates(counts: DataFrame, by: list[str]) -> DataFrame:
    tp, fp, fn = F.col("true_positives"), F.col("false_positives"), F.col("false_negatives")
    n = F.col("n_samples")
    return counts.select(
        *by,
        "n_samples",
        _ratio(tp + fn, n).alias("fraud_rate"),
        _ratio(tp + fp, n).alias("flag_rate"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        "true_negatives",
        "false_positives",
        "false_negatives",
        "true_positives",
    )


def ranking_metrics(scored: DataFrame, *, label: str = "is_fraud", score: str = "ensemble_score") -> DataFrame:
    """Exact ROC-AUC (ties count half) and average precision, as one row.

    Rows are first counted per distinct score; the running counts from the top are then taken over
    range cells, so no task sees the whole score list. Both are NULL when a class is missing.
    """
    y = F.col(label).cast("bigint")
    counts = (
        scored.where(F.col(label).isNotNull())
        .groupBy((-F.col(score).cast("double")).alias("_rank"))
        .agg(F.sum(y).alias("_pos"), F.sum(1 - y).alias("_neg"))
    )
    curve = running_sums(
        ranged(counts, ["_rank"]), [], "_rank", {"_tp": "_pos", "_fp": "_neg"}, totals=True
    )
    return curve.agg(*_areas())


def _areas() -> list[Column]:
    pos, neg, tp, fp = (F.col(c).cast("double") for c in ("_pos", "_neg", "_tp", "_fp"))
    p, n = F.max("total__tp").cast("double"), F.max("total__fp").cast("double")
    return [
        F.try_divide(F.sum(neg * (tp - pos / 2)), p * n).alias("roc_auc"),
        F.try_divide(F.sum(pos * F.try_divide(tp, tp + fp)), F.nullif(p, F.lit(0.0))).alias("pr_auc"),
    ]


def subgroup_report(
    scored: DataFrame,
    sets: list[list[str]],
    *,
    label: str = "is_fraud",
    flag: str = "is_flagged",
    score: str = "ensemble_score",
) -> DataFrame:
    """Counts, rates and ranking metrics of every subgroup of every column set, in one pass each.

    ``sets`` are grouping sets; ``grouping`` is SQL's grouping id over their columns in order of first
    mention, which tells a column left out from a NULL value. The ranking metrics of all subgroups
    come from one running count over (set, subgroup, score) cells, so a subgroup may be the whole
    table. A subgroup with one class only has NULL metrics.
    """
    columns = list(dict.fromkeys(c for s in sets for c in s))
    judged = scored.where(F.col(label).isNotNull())
    by = ["grouping", *columns]

    def grouped(frame: DataFrame, extra: list[str], *aggregates: Column) -> DataFrame:
        every = [F.col(c) for c in [*columns, *extra]]
        wanted = [[F.col(c) for c in [*s, *extra]] for s in sets]
        kept = frame.select(*every, *[c for c in (label, flag) if c not in columns])
        # the extra columns are in every set, so their bits of the id are 0
        number = F.shiftright(F.grouping_id(), len(extra)).cast("bigint").alias("grouping")
        return kept.groupingSets(wanted, *every).agg(number, *aggregates)

    rates = _rates(grouped(judged, [], *_confusion(label, flag)), by)
    y = F.col(label).cast("bigint")
    ranked = judged.withColumn("_rank", -F.col(score).cast("double"))
    counts = grouped(ranked, ["_rank"], F.sum(y).alias("_pos"), F.sum(1 - y).alias("_neg"))
    curve = running_sums(
        ranged(counts, [*by, "_rank"]), by, "_rank", {"_tp": "_pos", "_fp": "_neg"}, totals=True
    )
    areas = curve.groupBy(*by).agg(*_areas()).toDF(*[f"_of_{c}" for c in by], "roc_auc", "pr_auc")
    same = reduce(lambda a, b: a & b, [F.col(f"`{c}`").eqNullSafe(F.col(f"`_of_{c}`")) for c in by])
    return rates.join(areas, same).select(*rates.columns, "roc_auc", "pr_auc")


def performance_report(predictions: DataFrame, labels: DataFrame, batch_id: str) -> dict:
    """All metrics of a batch; an ``error`` entry instead when they cannot be had."""
    data = with_labels(predictions, labels)
    if "is_fraud" not in data.columns:
        return {"batch_id": batch_id, "error": "no ground truth labels"}
    report = classification_report(data).first().asDict()
    fraud = report["true_positives"] + report["false_negatives"]
    if fraud in (0, report["n_samples"]):
        return {"batch_id": batch_id, "error": "no class variation", "fraud_count": fraud}
    return {"batch_id": batch_id, **report, **ranking_metrics(data).first().asDict()}


def amount_band(amount: str = "amount") -> Column:
    """A transaction's size class, for subgroup reports."""
    a = F.col(amount).cast("double")
    return F.when(a <= 100, "up to 100").when(a <= 1000, "up to 1000").when(a <= 5000, "up to 5000").otherwise(
        "over 5000"
    )
