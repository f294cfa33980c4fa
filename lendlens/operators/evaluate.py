"""Evaluation of scored rows.

Inputs are a label column, a 0/1 prediction and a class-1 score. Counting
metrics are one conditional-sum aggregate; curve metrics group by distinct
score and take prefix sums with the bucketed running-sum primitive, so no
task ever sorts all rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlens.functions.ranking import running_sums


def confusion_matrix(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """K9: the 2×2 counts (label, prediction, count), zero cells included."""
    y, p = F.col(label), F.col(pred)
    row = df.agg(*[F.sum(((y == a) & (p == b)).cast("long")).alias(f"c{a}{b}") for a in (0, 1) for b in (0, 1)])
    parts = [F.struct(F.lit(a).alias(label), F.lit(b).alias(pred),
                      F.coalesce(F.col(f"c{a}{b}"), F.lit(0)).cast("long").alias("count"))
             for a in (0, 1) for b in (0, 1)]
    return row.select(F.explode(F.array(*parts)).alias("s")).select("s.*")


def _counts(df: DataFrame, label: str, pred: str) -> DataFrame:
    y, p = F.col(label), F.col(pred)
    return df.agg(F.sum(((y == 1) & (p == 1)).cast("long")).alias("tp"),
                  F.sum(((y == 0) & (p == 1)).cast("long")).alias("fp"),
                  F.sum(((y == 0) & (p == 0)).cast("long")).alias("tn"),
                  F.sum(((y == 1) & (p == 0)).cast("long")).alias("fn"))


def _safe(num, den):
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def classification_metrics(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Accuracy and per-class precision, recall, F1 (0 when undefined)."""
    c = _counts(df, label, pred).na.fill(0)
    tp, fp, tn, fn = (F.col(x).cast("double") for x in ("tp", "fp", "tn", "fn"))
    p1, r1 = _safe(tp, tp + fp), _safe(tp, tp + fn)
    p0, r0 = _safe(tn, tn + fn), _safe(tn, tn + fp)
    return c.select(_safe(tp + tn, tp + tn + fp + fn).alias("accuracy"),
                    p0.alias("precision_0"), r0.alias("recall_0"), _safe(2 * p0 * r0, p0 + r0).alias("f1_0"),
                    p1.alias("precision_1"), r1.alias("recall_1"), _safe(2 * p1 * r1, p1 + r1).alias("f1_1"))


def classification_report(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Per class precision, recall, F1 and support, plus accuracy, macro
    and support-weighted averages."""
    m = classification_metrics(df, label, pred)
    c = _counts(df, label, pred).na.fill(0)
    s0 = (F.col("tn") + F.col("fp")).cast("long")
    s1 = (F.col("tp") + F.col("fn")).cast("long")
    j = m.withColumns({k: c.select(k).scalar() for k in ("tp", "fp", "tn", "fn")})
    tot = s0 + s1
    rows = F.array(
        F.struct(F.lit("0").alias("class"), F.col("precision_0").alias("precision"), F.col("recall_0").alias("recall"),
                 F.col("f1_0").alias("f1"), s0.alias("support")),
        F.struct(F.lit("1").alias("class"), F.col("precision_1").alias("precision"), F.col("recall_1").alias("recall"),
                 F.col("f1_1").alias("f1"), s1.alias("support")),
        F.struct(F.lit("accuracy").alias("class"), F.lit(None).cast("double").alias("precision"),
                 F.lit(None).cast("double").alias("recall"), F.col("accuracy").alias("f1"), tot.alias("support")),
        F.struct(F.lit("macro avg").alias("class"), ((F.col("precision_0") + F.col("precision_1")) / 2).alias("precision"),
                 ((F.col("recall_0") + F.col("recall_1")) / 2).alias("recall"),
                 ((F.col("f1_0") + F.col("f1_1")) / 2).alias("f1"), tot.alias("support")),
        F.struct(F.lit("weighted avg").alias("class"),
                 ((F.col("precision_0") * s0 + F.col("precision_1") * s1) / tot).alias("precision"),
                 ((F.col("recall_0") * s0 + F.col("recall_1") * s1) / tot).alias("recall"),
                 ((F.col("f1_0") * s0 + F.col("f1_1") * s1) / tot).alias("f1"), tot.alias("support")))
    return j.select(F.explode(rows).alias("s")).select("s.*")


def _score_counts(df: DataFrame, label: str, score: str) -> DataFrame:
    y = F.col(label)
    return (df.where(F.col(score).isNotNull() & y.isNotNull())
            .groupBy(F.col(score).cast("double").alias("score"))
            .agg(F.sum((y == 1).cast("long")).alias("pos"), F.sum((y != 1).cast("long")).alias("neg")))


def roc_auc(df: DataFrame, label: str = "label", score: str = "probability") -> DataFrame:
    """Exact ROC-AUC (ties count one half) = P(score⁺ > score⁻) from
    per-score counts and a running count of negatives."""
    g = running_sums(_score_counts(df, label, score), "score", ["neg"])
    agg = g.agg(F.sum(F.col("pos") * (F.col("cum_neg") - 0.5 * F.col("neg"))).alias("u"),
                F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    return agg.select(F.when((F.col("P") > 0) & (F.col("N") > 0), F.col("u") / (F.col("P") * F.col("N")))
                      .alias("roc_auc"))


def roc_curve(df: DataFrame, label: str = "label", score: str = "probability",
              drop_intermediate: bool = True) -> DataFrame:
    """(fpr, tpr, threshold) at distinct scores, highest first, starting
    from (0, 0) at threshold +inf. With ``drop_intermediate`` a point is kept
    only where the curve changes direction (its next step differs from its
    own), plus the first and last — the usual default. The next step comes
    from a self-join on the running index, not an unpartitioned window."""
    counts = _score_counts(df, label, score).withColumn("_one", F.lit(1))
    g = running_sums(counts, "score", ["pos", "neg", "_one"], descending=True)
    P = df.where(F.col(label) == 1).select(F.count(F.lit(1))).scalar()
    N = df.where(F.col(label) != 1).select(F.count(F.lit(1))).scalar()
    if drop_intermediate:
        nxt = g.select((F.col("cum__one") - 1).alias("cum__one"), F.col("pos").alias("_npos"),
                       F.col("neg").alias("_nneg"))
        g = g.join(nxt, "cum__one", "left").where(
            (F.col("cum__one") == 1) | F.col("_npos").isNull()
            | (F.col("_npos") != F.col("pos")) | (F.col("_nneg") != F.col("neg")))
    pts = g.select((F.col("cum_neg") / N).alias("fpr"), (F.col("cum_pos") / P).alias("tpr"),
                   F.col("score").alias("threshold"))
    start = df.sparkSession.createDataFrame([(0.0, 0.0, float("inf"))], "fpr double, tpr double, threshold double")
    return start.unionByName(pts)


def pr_curve(df: DataFrame, label: str = "label", score: str = "probability") -> DataFrame:
    """(precision, recall, threshold) at distinct scores from the highest
    down to the first one reaching full recall, with the closing point
    (precision 1, recall 0)."""
    g = running_sums(_score_counts(df, label, score), "score", ["pos", "neg"], descending=True)
    P = df.where(F.col(label) == 1).select(F.count(F.lit(1))).scalar()
    pts = (g.where(F.col("cum_pos") - F.col("pos") < P)
           .select((F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))).alias("precision"),
                   (F.col("cum_pos") / P).alias("recall"), F.col("score").alias("threshold")))
    end = df.sparkSession.createDataFrame([(1.0, 0.0, None)], "precision double, recall double, threshold double")
    return pts.unionByName(end)


def prediction_counts(df: DataFrame, pred: str = "prediction") -> DataFrame:
    """Frequency of each predicted class."""
    return df.groupBy(pred).agg(F.count(F.lit(1)).alias("count"))


def score_histogram_by_class(df: DataFrame, label: str = "label", score: str = "probability",
                             bins: int = 50) -> DataFrame:
    """Equal-width probability bins over [0, 1] per class (last bin
    closed), empty bins omitted."""
    b = F.least(F.floor(F.col(score) * bins).cast("int"), F.lit(bins - 1))
    return (df.where(F.col(score).isNotNull()).groupBy(F.col(label).alias("label"), b.alias("bin"))
            .agg(F.count(F.lit(1)).alias("count"))
            .withColumns({"left": F.col("bin") / bins, "right": (F.col("bin") + 1) / bins}))


def evaluate(df: DataFrame, label: str = "label", pred: str = "prediction", score: str = "probability") -> dict:
    """K10 + K11 as a dict of Python floats. The three narrow columns are
    persisted once so the scoring pipeline is not re-run for each metric
    (a lost cached block is recomputed from lineage)."""
    narrow = df.select(label, pred, score).persist()
    try:
        m = classification_metrics(narrow, label, pred).first().asDict()
        m["roc_auc"] = roc_auc(narrow, label, score).first()["roc_auc"]
    finally:
        narrow.unpersist()
    return m


def train_test_comparison(train_scored: DataFrame, test_scored: DataFrame, label: str = "label",
                          pred: str = "prediction", score: str = "probability") -> DataFrame:
    """Metric × {train, test}; train metrics on the unresampled rows."""
    tr = evaluate(train_scored, label, pred, score)
    te = evaluate(test_scored, label, pred, score)
    rows = [(k, tr[k], te[k]) for k in tr]
    return train_scored.sparkSession.createDataFrame(rows, "metric string, train double, test double")
