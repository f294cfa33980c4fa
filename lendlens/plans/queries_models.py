"""Registered queries: sampling, evaluation, models, persistence, scoring.

The evaluation operators (K9–K16) are SQL-checked on a transparent risk
score built from the table (``1 - EXT_SOURCE_2``, 0.5 when missing); the
trained-model queries run the reference's default configurations and get a
rows-only check (different learners cannot equal the reference's numbers).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lendlens.functions.exprs import EXT_COLS
from lendlens.operators import evaluate as ev
from lendlens.operators import sampling, stats
from lendlens.operators.models import feature_importance
from lendlens.operators.neighbours import KnnImputer, smote
from lendlens.plans import experiments as ex
from lendlens.plans.catalog import apps, oracle, r, register
from lendlens.plans.pipeline import create_preprocessing_pipeline, load_pipeline, save_pipeline
from lendlens.session import cut_lineage, scratch_path
from lendlens.sources.tables import read_applications, write_table

# ----------------------------------------------------------------- K1, K4
_ALLOC_SQL = """
, cc AS (SELECT TARGET, count(*) AS cnt FROM applications GROUP BY TARGET)
, tt AS (SELECT sum(cnt) AS n, sum(cnt) - CAST(ceil(0.2 * sum(cnt)) AS BIGINT) AS n_train FROM cc)
, fl AS (SELECT TARGET, cnt, CAST(n_train AS DOUBLE) * cnt / n AS ex, floor(CAST(n_train AS DOUBLE) * cnt / n) AS fl0,
                n_train FROM cc, tt)
, rk AS (SELECT *, row_number() OVER (ORDER BY ex - fl0 DESC, TARGET) AS rn,
                n_train - sum(fl0) OVER () AS lft FROM fl)
, alloc AS (SELECT TARGET, cnt, CAST(fl0 + CASE WHEN rn <= lft THEN 1 ELSE 0 END AS BIGINT) AS n_tr FROM rk)"""


@register("k1_stratified_split", oracle(_ALLOC_SQL + """
SELECT 'train' AS split, TARGET, n_tr AS count FROM alloc UNION ALL
SELECT 'test' AS split, TARGET, cnt - n_tr AS count FROM alloc"""))
def k1_stratified_split(spark, sf_dir):
    """K1: exact stratified 80/20 split (hash thresholds per class); sizes."""
    split = sampling.stratified_split(apps(spark, sf_dir), "TARGET", "ID", 0.2, 42)
    return split.groupBy("split", "TARGET").agg(F.count(F.lit(1)).alias("count"))


@register("k4_class_weights", oracle(f"""
SELECT TARGET, count(*) AS count, {r('(SELECT count(*) FROM applications) / (2.0 * count(*))')} AS weight
FROM applications GROUP BY TARGET"""))
def k4_class_weights(spark, sf_dir):
    """K4: balanced class weights n / (2·n_c)."""
    df = apps(spark, sf_dir)
    w = sampling.with_class_weight(df, "TARGET", "weight")
    return w.groupBy("TARGET").agg(F.count(F.lit(1)).alias("count"), F.first("weight").alias("weight"))


# --------------------------------------------------------------- K9–K16
def _scored(spark, sf_dir):
    df = apps(spark, sf_dir)
    score = F.lit(1.0) - F.coalesce(F.col("EXT_SOURCE_2"), F.lit(0.5))
    return df.select("ID", F.col("TARGET").cast("int").alias("label"), score.alias("risk_score"),
                     (score >= 0.5).cast("int").alias("prediction"))


_SCORED_SQL = """
, s AS (SELECT ID, CAST(TARGET AS INTEGER) AS label, 1.0 - coalesce(EXT_SOURCE_2, 0.5) AS risk_score,
               CAST(1.0 - coalesce(EXT_SOURCE_2, 0.5) >= 0.5 AS INTEGER) AS prediction FROM applications)"""


@register("k9_confusion_matrix", oracle(_SCORED_SQL + """
, g AS (SELECT a.l AS label, b.p AS prediction FROM (VALUES (0), (1)) a(l), (VALUES (0), (1)) b(p))
SELECT g.label, g.prediction, CAST(count(s.ID) AS BIGINT) AS count
FROM g LEFT JOIN s ON s.label = g.label AND s.prediction = g.prediction GROUP BY g.label, g.prediction"""))
def k9_confusion_matrix(spark, sf_dir):
    """K9: confusion matrix of the risk-score rule."""
    return ev.confusion_matrix(_scored(spark, sf_dir))


_CM = """
, c AS (SELECT CAST(sum(CASE WHEN label = 1 AND prediction = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS tp,
               CAST(sum(CASE WHEN label = 0 AND prediction = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS fp,
               CAST(sum(CASE WHEN label = 0 AND prediction = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS tn,
               CAST(sum(CASE WHEN label = 1 AND prediction = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS fn FROM s)
, m AS (SELECT tp, fp, tn, fn, (tp + tn) / (tp + tn + fp + fn) AS accuracy,
               CASE WHEN tn + fn > 0 THEN tn / (tn + fn) ELSE 0 END AS p0, CASE WHEN tn + fp > 0 THEN tn / (tn + fp) ELSE 0 END AS r0,
               CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS p1, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS r1
        FROM c)
, m2 AS (SELECT *, CASE WHEN p0 + r0 > 0 THEN 2 * p0 * r0 / (p0 + r0) ELSE 0 END AS f0,
                  CASE WHEN p1 + r1 > 0 THEN 2 * p1 * r1 / (p1 + r1) ELSE 0 END AS f1 FROM m)"""


@register("k10_classification_metrics", oracle(_SCORED_SQL + _CM + f"""
SELECT {r('accuracy')} AS accuracy, {r('p0')} AS precision_0, {r('r0')} AS recall_0, {r('f0')} AS f1_0,
       {r('p1')} AS precision_1, {r('r1')} AS recall_1, {r('f1')} AS f1_1 FROM m2"""))
def k10_classification_metrics(spark, sf_dir):
    """Accuracy, precision, recall, F1 per class of the rule."""
    return ev.classification_metrics(_scored(spark, sf_dir))


@register("k14_classification_report", oracle(_SCORED_SQL + _CM + f"""
SELECT '0' AS class, {r('p0')} AS precision, {r('r0')} AS recall, {r('f0')} AS f1, CAST(tn + fp AS BIGINT) AS support FROM m2
UNION ALL SELECT '1', {r('p1')}, {r('r1')}, {r('f1')}, CAST(tp + fn AS BIGINT) FROM m2
UNION ALL SELECT 'accuracy', NULL, NULL, {r('accuracy')}, CAST(tp + fn + tn + fp AS BIGINT) FROM m2
UNION ALL SELECT 'macro avg', {r('(p0 + p1) / 2')}, {r('(r0 + r1) / 2')}, {r('(f0 + f1) / 2')},
                 CAST(tp + fn + tn + fp AS BIGINT) FROM m2
UNION ALL SELECT 'weighted avg', {r('(p0 * (tn + fp) + p1 * (tp + fn)) / (tp + fn + tn + fp)')},
                 {r('(r0 * (tn + fp) + r1 * (tp + fn)) / (tp + fn + tn + fp)')},
                 {r('(f0 * (tn + fp) + f1 * (tp + fn)) / (tp + fn + tn + fp)')}, CAST(tp + fn + tn + fp AS BIGINT) FROM m2"""))
def k14_classification_report(spark, sf_dir):
    """Per-class report with macro and weighted averages."""
    return ev.classification_report(_scored(spark, sf_dir))


@register("k11_roc_auc", oracle(_SCORED_SQL + f"""
, rk AS (SELECT label, (2 * rank() OVER (ORDER BY risk_score) + count(*) OVER (PARTITION BY risk_score) - 1) / 2.0 AS rnk
         FROM s)
, u AS (SELECT sum(CASE WHEN label = 1 THEN rnk ELSE 0 END) AS rs, CAST(sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS p,
               CAST(sum(CASE WHEN label <> 1 THEN 1 ELSE 0 END) AS DOUBLE) AS n FROM rk)
SELECT {r('(rs - p * (p + 1) / 2) / (p * n)')} AS roc_auc FROM u"""))
def k11_roc_auc(spark, sf_dir):
    """Exact ROC-AUC (Mann–Whitney with tie halves) of the risk score."""
    return ev.roc_auc(_scored(spark, sf_dir), "label", "risk_score")


_CURVE = """
, g AS (SELECT risk_score AS score, sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS pos,
               sum(CASE WHEN label <> 1 THEN 1 ELSE 0 END) AS neg FROM s GROUP BY risk_score)
, cs AS (SELECT score, pos, neg, sum(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS tp,
                sum(neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS fp,
                row_number() OVER (ORDER BY score DESC) AS idx,
                lead(pos) OVER (ORDER BY score DESC) AS npos, lead(neg) OVER (ORDER BY score DESC) AS nneg FROM g)
, tot AS (SELECT CAST(sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS P,
                 CAST(sum(CASE WHEN label <> 1 THEN 1 ELSE 0 END) AS DOUBLE) AS N FROM s)"""


@register("k12_roc_curve", oracle(_SCORED_SQL + _CURVE + f"""
SELECT 0.0 AS fpr, 0.0 AS tpr, CAST('inf' AS DOUBLE) AS threshold
UNION ALL SELECT {r('fp / N')}, {r('tp / P')}, {r('score')} FROM cs, tot
WHERE idx = 1 OR npos IS NULL OR npos <> pos OR nneg <> neg"""))
def k12_roc_curve(spark, sf_dir):
    """ROC points (intermediate collinear points dropped)."""
    return ev.roc_curve(_scored(spark, sf_dir), "label", "risk_score")


@register("k13_pr_curve", oracle(_SCORED_SQL + _CURVE + f"""
SELECT {r('tp / (tp + fp)')} AS precision, {r('tp / P')} AS recall, {r('score')} AS threshold FROM cs, tot
WHERE tp - pos < P
UNION ALL SELECT 1.0, 0.0, NULL"""))
def k13_pr_curve(spark, sf_dir):
    """precision–recall points down to full recall."""
    return ev.pr_curve(_scored(spark, sf_dir), "label", "risk_score")


@register("k15_prediction_counts", oracle(_SCORED_SQL + " SELECT prediction, count(*) AS count FROM s GROUP BY prediction"))
def k15_prediction_counts(spark, sf_dir):
    """Predicted class counts."""
    return ev.prediction_counts(_scored(spark, sf_dir))


@register("k16_score_histogram_by_class", oracle(_SCORED_SQL + f"""
, hb AS (SELECT label, CAST(least(floor(risk_score * 50), 49) AS INTEGER) AS bin FROM s WHERE risk_score IS NOT NULL)
SELECT label, bin, count(*) AS count, {r('bin / 50')} AS "left", {r('(bin + 1) / 50')} AS "right"
FROM hb GROUP BY label, bin"""))
def k16_score_histogram_by_class(spark, sf_dir):
    """50-bin score histogram per class."""
    return ev.score_histogram_by_class(_scored(spark, sf_dir), "label", "risk_score", 50)


# ------------------------------------------------------- K2, K3, C6
def _checked_synthetic(out, rows, cont):
    """Per class: rows, synthetic rows, and those that lie at their gap between two rows of their class."""
    types = dict(rows.dtypes)
    base = rows.select(F.col("ID").alias("base_id"), F.col("TARGET").alias("_b"), *[F.col(c).cast("double").alias(f"_b_{c}") for c in cont])
    near = rows.select(F.col("ID").alias("neighbour_id"), F.col("TARGET").alias("_n"), *[F.col(c).cast("double").alias(f"_n_{c}") for c in cont])
    right = (F.col("_b") == F.col("TARGET")) & (F.col("_n") == F.col("TARGET")) & (F.col("base_id") != F.col("neighbour_id")) & F.col("gap").between(0, 1)
    for c in cont:
        between = (F.col(f"_b_{c}") + F.col("gap") * (F.col(f"_n_{c}") - F.col(f"_b_{c}"))).cast(types[c])
        right = right & (F.abs(F.col(c) - between) <= 1e-9 * F.greatest(F.abs(between), F.lit(1.0)))
    # Rows of the input have no base row: they are counted without the joins.
    joined = (out.where("base_id IS NOT NULL").join(near, "neighbour_id", "left").join(base, "base_id", "left")
              .select("TARGET", "base_id", F.when(right, 1).alias("right"))
              .unionByName(out.where("base_id IS NULL").select("TARGET", "base_id", F.lit(None).cast("int").alias("right"))))
    return joined.groupBy("TARGET").agg(F.count(F.lit(1)).alias("count"), F.count("base_id").alias("synthetic"),
                                        F.count("right").alias("synthetic_right"))


@register("k2_smote", oracle(_ALLOC_SQL + """
SELECT TARGET, (SELECT max(n_tr) FROM alloc) AS count, (SELECT max(n_tr) FROM alloc) - n_tr AS synthetic,
       (SELECT max(n_tr) FROM alloc) - n_tr AS synthetic_right FROM alloc"""))
def k2_smote(spark, sf_dir):
    """K2: SMOTE on the prepared train split; every synthetic row is checked against its base row, neighbour and gap."""
    train, _ = ex.split_once(apps(spark, sf_dir))
    tr = cut_lineage(create_preprocessing_pipeline("logistic").fit(train).transform(train))
    feats = [c for c in tr.columns if c not in ("ID", "TARGET")]
    return _checked_synthetic(smote(tr, feats, "TARGET", "ID", k=5, seed=42, provenance=True), tr, feats)


_NC_NUM = ["AMT_CREDIT", "AMT_INCOME_TOTAL", "DAYS_BIRTH", "HOUR_APPR_PROCESS_START"]
_NC_NOM = ["NAME_INCOME_TYPE", "CODE_GENDER", "NAME_CONTRACT_TYPE"]


@register("k3_smote_nc", oracle("""
, c AS (SELECT TARGET, count(*) AS n FROM applications GROUP BY TARGET)
SELECT TARGET, (SELECT max(n) FROM c) AS count, (SELECT max(n) FROM c) - n AS synthetic, (SELECT max(n) FROM c) - n AS synthetic_right FROM c"""))
def k3_smote_nc(spark, sf_dir):
    """K3: SMOTE-NC over numeric and nominal columns of the whole table; synthetic rows checked as in K2."""
    df = apps(spark, sf_dir).select("ID", "TARGET", *_NC_NUM, *_NC_NOM)
    out = smote(df, _NC_NUM + _NC_NOM, "TARGET", "ID", k=5, seed=42, nominal_cols=_NC_NOM, provenance=True)
    return _checked_synthetic(out, df, _NC_NUM)


@register("c6_knn_imputer")
def c6_knn_imputer(spark, sf_dir):
    """External scores imputed by the mean of the 5 nearest rows
    (missing-aware distance over the scores and the 5 features most
    correlated with each), fitted and applied on the whole table. Checked
    against a brute-force fixture in the tests (quadratic SQL is too slow)."""
    df = apps(spark, sf_dir)
    return KnnImputer(target_cols=list(EXT_COLS)).fit(df).transform(df).select("ID", *EXT_COLS)


# -------------------------------------------------- K5–K8, K17–K21, A
def _lr_run(spark, sf_dir, use_smote=False):
    train, test = ex.split_once(apps(spark, sf_dir))
    return {**ex.train_and_evaluate(train, test, "logistic_regression", use_smote=use_smote), "test": test}


@register("k5_logistic_regression")
def k5_logistic_regression(spark, sf_dir):
    """K5+K8: balanced logistic regression on the prepared split; test-set
    predictions."""
    return _lr_run(spark, sf_dir)["test_scored"]


@register("k6_random_forest")
def k6_random_forest(spark, sf_dir):
    """K6: random forest (300 trees, depth 10, leaf 2) on the prepared split."""
    train, test = ex.split_once(apps(spark, sf_dir))
    return ex.train_and_evaluate(train, test, "random_forest")["test_scored"]


@register("k7_gradient_boosting")
def k7_gradient_boosting(spark, sf_dir):
    """K7: gradient-boosted trees (300 rounds, depth 5, rate 0.05) on the
    prepared split."""
    train, test = ex.split_once(apps(spark, sf_dir))
    return ex.train_and_evaluate(train, test, "gradient_boosting")["test_scored"]


@register("k17_feature_importance")
def k17_feature_importance(spark, sf_dir):
    """The 15 largest logistic coefficients by absolute value."""
    res = _lr_run(spark, sf_dir)
    return feature_importance(res["model"], res["features"], 15)


@register("k18_train_test_comparison")
def k18_train_test_comparison(spark, sf_dir):
    """Metrics on the unresampled train side and the test side."""
    res = _lr_run(spark, sf_dir)
    rows = [(k, res["train_metrics"][k], res["test_metrics"][k]) for k in res["train_metrics"]]
    return spark.createDataFrame(rows, "metric string, train double, test double")


@register("k19_run_experiments")
def k19_run_experiments(spark, sf_dir):
    """The experiment runner (logistic regression, prepared data, SMOTE),
    the model and its pipeline saved; an error fails the query."""
    return ex.run_experiments(spark, apps(spark, sf_dir), models=("logistic_regression",),
                              data_types=("preprocessed",), use_smote=True, raise_errors=True,
                              output_dir=scratch_path(spark, "experiments"))


@register("k20_raw_baseline")
def k20_raw_baseline(spark, sf_dir):
    """Raw-data baselines (logistic regression on complete numeric rows,
    boosted trees with unordered categories and gaps); an error in any run
    fails the query."""
    return ex.run_experiments(spark, apps(spark, sf_dir), models=("logistic_regression", "gradient_boosting"),
                              data_types=("raw",), use_smote=False, params=None, raise_errors=True)


@register("k20_raw_forest")
def k20_raw_forest(spark, sf_dir):
    """The raw-data forest, 300 trees on complete numeric rows."""
    return ex.run_experiments(spark, apps(spark, sf_dir), models=("random_forest",), data_types=("raw",), use_smote=False, raise_errors=True)


@register("k21_preprocessing_pipeline")
def k21_preprocessing_pipeline(spark, sf_dir):
    """The default logistic preparation pipeline fitted on the train
    split and applied to the test split."""
    train, test = ex.split_once(apps(spark, sf_dir))
    return create_preprocessing_pipeline("logistic").fit(train).transform(test)


@register("k21_preprocessing_pipeline_tree_selected")
def k21_preprocessing_pipeline_tree_selected(spark, sf_dir):
    """K21 for trees with the feature selector (G3) at the end."""
    train, test = ex.split_once(apps(spark, sf_dir))
    return create_preprocessing_pipeline("tree", apply_feature_selection=True).fit(train).transform(test)


@register("a3_pipeline_roundtrip")
def a3_pipeline_roundtrip(spark, sf_dir):
    """A3: save the fitted pipeline, load it back and transform the test side."""
    train, test = ex.split_once(apps(spark, sf_dir))
    path = save_pipeline(create_preprocessing_pipeline("logistic").fit(train), scratch_path(spark, "pipeline"))
    return load_pipeline(path).transform(test)


@register("a5_score_file")
def a5_score_file(spark, sf_dir):
    """A4+A5: save a trained model with its pipeline, then score a Parquet file
    of the test rows with the loaded artefacts."""
    res = _lr_run(spark, sf_dir)
    mpath = ex.save_model(scratch_path(spark, "model"), res["model"], "logistic_regression", "preprocessed",
                          res["features"], res["pipeline"])
    test = res["test"]
    data_path = scratch_path(spark, "to-score")
    test.write.parquet(data_path)
    scores, _counts = ex.score_file(spark, mpath, data_path, scratch_path(spark, "scores"))
    return scores


@register("a5_score_stream")
def a5_score_stream(spark, sf_dir):
    """A5 as a stream: files of applications scored by Structured Streaming
    into a Parquet sink."""
    from lendlens.streaming.scoring import score_stream
    res = _lr_run(spark, sf_dir)
    mpath = ex.save_model(scratch_path(spark, "model"), res["model"], "logistic_regression", "preprocessed",
                          res["features"], res["pipeline"])
    test = res["test"]
    in_dir, out_dir = scratch_path(spark, "stream-in"), scratch_path(spark, "stream-out")
    test.repartition(4).write.parquet(in_dir)
    q = score_stream(spark, mpath, in_dir, test.schema, out_dir, scratch_path(spark, "stream-ckpt"))
    q.awaitTermination()
    return spark.read.parquet(out_dir)


@register("a5_stream_counts")
def a5_stream_counts(spark, sf_dir):
    """A5: prediction counts of the streamed files, kept in the state store over a restart in mid-stream."""
    from lendlens.streaming.scoring import count_stream, latest_counts
    res = _lr_run(spark, sf_dir)
    mpath = ex.save_model(scratch_path(spark, "model"), res["model"], "logistic_regression", "preprocessed",
                          res["features"], res["pipeline"])
    in_dir, out_dir, ckpt = scratch_path(spark, "stream-in"), scratch_path(spark, "stream-counts"), scratch_path(spark, "stream-ckpt")
    half = F.xxhash64("ID") % 2 == 0
    for part in (half, ~half):  # the second run finds the first one's state
        res["test"].where(part).repartition(2).write.mode("append").parquet(in_dir)
        count_stream(spark, mpath, in_dir, res["test"].schema, out_dir, ckpt, files_per_trigger=1).awaitTermination()
    return latest_counts(spark, out_dir)


_A1_COLS = ["ID", "AMT_ANNUITY", "NAME_TYPE_SUITE", "OWN_CAR_AGE", "DAYS_BIRTH"]


@register("a1_read_applications", oracle(f"SELECT {', '.join(_A1_COLS)} FROM applications"), round_doubles=False)
def a1_read_applications(spark, sf_dir):
    """A1 (+A2): write the table as CSV with a header, read it back with an
    explicit schema (blanks → NULL, NaN → NULL)."""
    df = apps(spark, sf_dir).select(*_A1_COLS)
    path = write_table(df, scratch_path(spark, "apps-csv"), "csv")
    return read_applications(spark, path, schema=df.schema, fmt="csv")


_CORR_COLS = ["AMT_CREDIT", "AMT_ANNUITY", "EXT_SOURCE_2", "DAYS_BIRTH"]


@register("a2_write_table", oracle(" UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, {r(f'corr({a}, {b})')} AS correlation FROM applications"
    for a in _CORR_COLS for b in _CORR_COLS)))
def a2_write_table(spark, sf_dir):
    """A2: the correlation matrix written as CSV and read back."""
    m = stats.correlation_matrix(apps(spark, sf_dir), _CORR_COLS)
    path = write_table(m, scratch_path(spark, "corr-csv"), "csv")
    return spark.read.schema(m.schema).option("header", "true").csv(path)
