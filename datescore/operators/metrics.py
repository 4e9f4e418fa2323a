"""Evaluation metrics as DataFrames.

Every metric is computed from integer counts gathered in one distributed
aggregation, and each output value is a single division of exact numbers,
so results do not depend on partitioning or summation order. Every metric
of a scored set is also a function of its score histogram (positives and
negatives per distinct score, ``score_histogram``); the count metrics take a
weight column so that a whole evaluation runs from that one small table.

Tie-aware AUC without a global sort
-----------------------------------
AUC = P(score of a positive > score of a negative) + 1/2 P(equal). Scores are
grouped first (one row per distinct score with its positive and negative
counts), so a score shared by a third of all rows is one row. Approximate
quantiles of the distinct scores cut them into B ordered buckets, B growing
with their number, and a bucket that is still too large is cut again by its own
quantiles; a running sum inside each bucket gives the
negatives below a score within its bucket, and a running sum over the B
bucket totals gives the negatives in all lower buckets. No step orders all
rows in one task; the only unpartitioned window runs over B rows.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from datescore.schema import LABEL
from datescore.session import materialize

AUC_BUCKET_ROWS = 100_000  # distinct scores that one window sorts
AUC_FAN = 256  # buckets that one round of cuts makes of a bucket, at most
CUT_ERROR = 1e-3  # rank error of the cut points between them
_EXACT = "decimal(38,0)"


def _ratio(num: Column, den: Column) -> Column:
    """num / den as DOUBLE, 0 when den is 0 (no error under ANSI mode)."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def _check_binary(label: Column) -> Column:
    return F.sum(F.when(F.coalesce(label.isin(0, 1), F.lit(False)), F.lit(0)).otherwise(F.lit(1)))


def _guard(bad: Column, what: str) -> Column:
    return F.when(bad > 0, F.raise_error(F.lit(f"{what}: labels must be 0 or 1")))


# --- counts -------------------------------------------------------------------


def _weight(weight: str | None) -> Column:
    return F.lit(1) if weight is None else F.col(weight)


def confusion_counts(
    pairs: DataFrame, truth: str = "true_label", pred: str = "prediction_label", weight: str | None = None
) -> DataFrame:
    """One row: tp, fp, fn, tn, n (BIGINT). Fails on a label other than 0/1.

    ``weight`` names a count column when each row stands for several pairs
    (e.g. a score histogram); by default every row is one pair.
    """
    t, p, w = F.col(truth), F.col(pred), _weight(weight)

    def cnt(cond: Column) -> Column:
        return F.coalesce(F.sum(F.when(cond, w).otherwise(F.lit(0))).cast("long"), F.lit(0).cast("long"))

    agg = pairs.agg(
        cnt((p == 1) & (t == 1)).alias("tp"),
        cnt((p == 1) & (t == 0)).alias("fp"),
        cnt((p == 0) & (t == 1)).alias("fn"),
        cnt((p == 0) & (t == 0)).alias("tn"),
        cnt(F.lit(True)).alias("n"),
        F.sum(F.when(F.coalesce(t.isin(0, 1), F.lit(False)), F.lit(0)).otherwise(w)).alias("_bad"),
    )
    return agg.select(F.coalesce(_guard(F.col("_bad"), "confusion counts"), F.col("tp")).alias("tp"), "fp", "fn", "tn", "n")


def confusion_matrix(
    pairs: DataFrame, truth: str = "true_label", pred: str = "prediction_label", weight: str | None = None
) -> DataFrame:
    """A2: prediction x truth counts; an absent cell is null (like a crosstab's NaN).

    A prediction value that never occurs has no row.
    """
    if weight is not None:
        pairs = pairs.where(F.col(weight) > 0)
    count = F.count(F.lit(1)) if weight is None else F.sum(weight)
    wide = pairs.groupBy(pred).pivot(truth, [0, 1]).agg(count)
    return wide.select(
        F.col(pred).alias("prediction_label"),
        F.col("0").cast("long").alias("true_0"),
        F.col("1").cast("long").alias("true_1"),
    )


# --- class report and single-number metrics ----------------------------------


def _class_stats(tp: Column, fp: Column, fn: Column) -> tuple[Column, Column, Column]:
    precision = _ratio(tp, tp + fp)
    recall = _ratio(tp, tp + fn)
    f1 = _ratio(F.lit(2) * tp, F.lit(2) * tp + fp + fn)
    return precision, recall, f1


def class_report(
    pairs: DataFrame, truth: str = "true_label", pred: str = "prediction_label", weight: str | None = None
) -> DataFrame:
    """A3: per-class precision, recall, F1, support; accuracy; macro and weighted means."""
    c = confusion_counts(pairs, truth, pred, weight)
    tp, fp, fn, tn, n = (F.col(x) for x in ("tp", "fp", "fn", "tn", "n"))
    p1, r1, f1 = _class_stats(tp, fp, fn)
    # Class 0 sees the matrix mirrored.
    p0, r0, f0 = _class_stats(tn, fn, fp)
    s1, s0 = tp + fn, tn + fp
    acc = _ratio(tp + tn, n)

    def row(name: str, p: Column | None, r: Column | None, f: Column, s: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class"),
            (p if p is not None else F.lit(None).cast("double")).alias("precision"),
            (r if r is not None else F.lit(None).cast("double")).alias("recall"),
            f.alias("f1"),
            s.cast("long").alias("support"),
        )

    def macro(a: Column, b: Column) -> Column:
        return (a + b) / F.lit(2.0)

    def weighted(a0: Column, a1: Column) -> Column:
        return _ratio(a0 * s0 + a1 * s1, n)

    rows = F.array(
        row("0", p0, r0, f0, s0),
        row("1", p1, r1, f1, s1),
        row("accuracy", None, None, acc, n),
        row("macro avg", macro(p0, p1), macro(r0, r1), macro(f0, f1), n),
        row("weighted avg", weighted(p0, p1), weighted(r0, r1), weighted(f0, f1), n),
    )
    return c.select(F.inline(rows))


def binary_metrics(
    pairs: DataFrame, truth: str = "true_label", pred: str = "prediction_label", weight: str | None = None
) -> DataFrame:
    """Accuracy, AUC of hard labels, recall, F1 and precision of class 1."""
    c = confusion_counts(pairs, truth, pred, weight)
    tp, fp, fn, tn, n = (F.col(x) for x in ("tp", "fp", "fn", "tn", "n"))
    precision, recall, f1 = _class_stats(tp, fp, fn)
    tnr = _ratio(tn, tn + fp)
    # With one class absent from the truth, a hard-label AUC is undefined.
    auc_hard = F.when((tp + fn > 0) & (tn + fp > 0), (recall + tnr) / F.lit(2.0))
    metrics = F.array(
        *[
            F.struct(F.lit(name).alias("metric"), value.alias("value"))
            for name, value in [
                ("accuracy", _ratio(tp + tn, n)),
                ("auc_hard", auc_hard),
                ("recall", recall),
                ("f1", f1),
                ("precision", precision),
            ]
        ]
    )
    return c.select(F.inline(metrics))


# --- AUC of scores -------------------------------------------------------------


def auc(
    scored: DataFrame,
    score: str = "score",
    label: str = LABEL,
    by: list[str] | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Tie-aware area under the ROC curve of ``score``, per group of ``by``.

    Output: ``by`` columns, auc (DOUBLE, null when a class is absent),
    positives, negatives (BIGINT).

    Cut points are loose quantiles of the distinct scores: on the driver, one
    double for about AUC_BUCKET_ROWS of them (``buckets`` fixes the number). A
    score's bucket is found by binary search (``Bucketizer``, JVM-side).
    Buckets only balance the work: any monotone cut set gives the same AUC.

    Like MLlib's evaluators this is an action: the distinct-score table is
    written once under the shared folder, so the scoring upstream runs once
    for both the cut points and the sums.

    Without rows the result has no group; without ``by`` it is one row with a null
    AUC and zero counts.
    """
    by = list(by or [])
    return auc_from_histogram(materialize(score_histogram(scored, score, label, by), "auc-histogram"), by, buckets)


def score_histogram(scored: DataFrame, score: str = "score", label: str = LABEL, by: list[str] | None = None) -> DataFrame:
    """Positives and negatives per distinct score (``_s, _pos, _neg, _bad``).

    Every metric of a scored set is a function of this table, and a score
    shared by any number of rows is one row of it (partial aggregation).
    """
    lab = F.col(label)
    return scored.groupBy(*(by or []), F.col(score).alias("_s")).agg(
        F.sum(F.when(lab == 1, F.lit(1)).otherwise(F.lit(0))).cast("long").alias("_pos"),
        F.sum(F.when(lab == 0, F.lit(1)).otherwise(F.lit(0))).cast("long").alias("_neg"),
        _check_binary(lab).alias("_bad"),
    )


def histogram_pairs(hist: DataFrame, t: float = 0.5, inclusive: bool = False) -> DataFrame:
    """(true_label, prediction_label, w) rows of a score histogram, for the count metrics."""
    s = F.col("_s")
    pred = F.when(s >= F.lit(t) if inclusive else s > F.lit(t), F.lit(1)).otherwise(F.lit(0))
    cells = F.array(
        F.struct(F.lit(1).alias("true_label"), F.col("_pos").alias("w")),
        F.struct(F.lit(0).alias("true_label"), F.col("_neg").alias("w")),
    )
    bad = F.struct(F.lit(-1).alias("true_label"), F.col("_bad").alias("w"))
    return hist.select(pred.alias("prediction_label"), F.inline(F.array_append(cells, bad))).where(F.col("w") > 0)


def auc_from_histogram(distinct: DataFrame, by: list[str] | None = None, buckets: int | None = None) -> DataFrame:
    """A9 from a (written) score histogram; the result, one row per group, is written too."""
    cuts = _quantile_cuts(distinct, buckets) if buckets else bucket_cuts(distinct)
    return materialize(_auc_from_distinct(distinct, list(by or []), cuts), "auc")


def _quantile_cuts(distinct: DataFrame, b: int) -> list[float]:
    fractions = [i / b for i in range(1, b)]
    cuts = distinct.approxQuantile("_s", fractions, max(CUT_ERROR, 1.0 / (4 * b))) if fractions else []
    return sorted({c for c in cuts if abs(c) < float("inf")})


def bucket_cuts(distinct: DataFrame, rows: int | None = None) -> list[float]:
    """Cut points after which no bucket holds many more than ``rows`` scores (AUC_BUCKET_ROWS), unless they are equal.

    The first round takes quantiles of all scores; a bucket that is still too
    large is cut by its own quantiles, all such buckets in one aggregation.
    """
    limit = rows or AUC_BUCKET_ROWS
    n = distinct.count()
    if n <= limit:
        return []
    cuts = _quantile_cuts(distinct, min(AUC_FAN, -(-n // limit) + 1))
    while True:
        counted = _bucketed(distinct, cuts).groupBy("_bk").count()
        heavy = {int(r["_bk"]): r["count"] for r in counted.where(F.col("count") > 2 * limit).collect()}
        if not heavy:
            return cuts
        parts = min(AUC_FAN, -(-max(heavy.values()) // limit) + 1)
        fractions = F.array(*[F.lit(i / parts) for i in range(1, parts)])
        inside = _bucketed(distinct, cuts).where(F.col("_bk").cast("int").isin(list(heavy)))
        own = inside.groupBy("_bk").agg(F.percentile_approx("_s", fractions, F.lit(10_000)).alias("q")).collect()
        finer = sorted({*cuts, *(c for r in own for c in r["q"] if abs(c) < float("inf"))})
        if finer == cuts:  # what is left in a heavy bucket is one score in many groups
            return cuts
        cuts = finer


def _bucketed(distinct: DataFrame, cuts: list[float]) -> DataFrame:
    splits = [float("-inf"), *(cuts or [0.0]), float("inf")]
    return Bucketizer(splits=splits, inputCol="_s", outputCol="_bk", handleInvalid="error").transform(distinct)


def _auc_from_distinct(distinct: DataFrame, by: list[str], cuts: list[float]) -> DataFrame:
    bucketed = _bucketed(distinct, cuts)
    within = Window.partitionBy(*by, "_bk").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    ranked = bucketed.withColumn("_nb", F.coalesce(F.sum("_neg").over(within), F.lit(0)).cast(_EXACT))
    # Twice the Mann-Whitney count: pos * (2 * negatives below + negatives tied).
    per_bucket = ranked.groupBy(*by, "_bk").agg(
        F.sum("_pos").alias("_P"),
        F.sum("_neg").alias("_N"),
        F.sum(F.col("_pos").cast(_EXACT) * (F.lit(2) * F.col("_nb") + F.col("_neg").cast(_EXACT))).alias("_twice"),
        F.sum("_bad").alias("_bad"),
    )
    # One row per bucket and group: the running sum over buckets is small.
    lower = Window.partitionBy(*by).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    per_bucket = per_bucket.withColumn("_off", F.coalesce(F.sum("_N").over(lower), F.lit(0)).cast(_EXACT))
    total = per_bucket.groupBy(*by).agg(
        F.sum(F.col("_twice") + F.lit(2) * F.col("_P").cast(_EXACT) * F.col("_off")).alias("_num"),
        F.sum("_P").alias("positives"),
        F.sum("_N").alias("negatives"),
        F.sum("_bad").alias("_bad"),
    )
    den = F.lit(2) * F.col("positives").cast(_EXACT) * F.col("negatives").cast(_EXACT)
    value = F.when(den > 0, F.col("_num").cast("double") / den.cast("double"))
    return total.select(
        *by,
        F.coalesce(_guard(F.col("_bad"), "auc"), value).alias("auc"),
        F.coalesce("positives", F.lit(0)).cast("long").alias("positives"),
        F.coalesce("negatives", F.lit(0)).cast("long").alias("negatives"),
    )


def mean_over(df: DataFrame, value: str, by: list[str], name: str) -> DataFrame:
    """A10: mean of ``value`` per group (e.g. AUC over folds)."""
    return df.groupBy(*by).agg(F.avg(value).alias(name))


def subset_sizes(df: DataFrame, role: Column | str) -> DataFrame:
    """Sizes of all subsets in one aggregation: role, rows."""
    r = F.col(role) if isinstance(role, str) else role
    return df.groupBy(r.alias("role")).agg(F.count(F.lit(1)).alias("rows"))
