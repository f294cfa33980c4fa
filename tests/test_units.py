"""Unit cases on small hand-made frames (nulls, ties, constants, edge values)."""

import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lendlens.functions import stats_math as sm
from lendlens.functions.exprs import hour_bin
from lendlens.functions.quantiles import (RANK_ERROR, approximate_quantiles, exact_quantiles, merge_sketches, order_statistics,
                                          sketch_table)
from lendlens.functions.ranking import running_sums
from lendlens.operators import charts, encode, evaluate, features, impute, profile, quality, sampling, select, stats
from lendlens.operators.neighbours import knn_impute, knn_join, smote


# ------------------------------------------------------------ expressions
def test_hour_bins_edges(spark):
    hours = [-1, 0, 5, 6, 11, 12, 17, 18, 23, None]
    df = spark.createDataFrame([(h,) for h in hours], "h int")
    got = [r[0] for r in df.select(hour_bin("h")).collect()]
    assert got == ["Morning", "Late_Night", "Late_Night", "Morning", "Morning", "Afternoon", "Afternoon",
                   "Evening", "Evening", "Evening"]


def test_bureau_bins_edges(spark):
    vals = [0.0, 1.0, 2.0, 2.5, 3.0, 5.0, 6.0, None]
    cols = ["AMT_REQ_CREDIT_BUREAU_HOUR", "AMT_REQ_CREDIT_BUREAU_DAY", "AMT_REQ_CREDIT_BUREAU_WEEK",
            "AMT_REQ_CREDIT_BUREAU_MON", "AMT_REQ_CREDIT_BUREAU_QRT", "AMT_REQ_CREDIT_BUREAU_YEAR"]
    df = spark.createDataFrame([tuple([v] * 6) for v in vals], ", ".join(f"{c} double" for c in cols))
    out = features.bureau_bins(df).select(*[f"{c}_CAT" for c in cols]).collect()
    year = [r[5] for r in out]
    assert year == ["ZERO", "LOW", "LOW", "ZERO", "MEDIUM", "MEDIUM", "HIGH", "ZERO"]
    week = [r[2] for r in out]
    assert week == ["ZERO", "ONE", "MULTIPLE", "MULTIPLE", "MULTIPLE", "MULTIPLE", "MULTIPLE", "ZERO"]
    proc = features.BureauProcessor().transform(df).collect()
    assert [r["HAS_CREDIT_BUREAU_DATA"] for r in proc] == [1] * 7 + [0]
    assert proc[-1]["AMT_REQ_CREDIT_BUREAU_YEAR_ORD"] == 0


def test_weekday_unknown_is_null(spark):
    df = spark.createDataFrame([("MONDAY",), ("FUNDAY",), (None,)], "WEEKDAY_APPR_PROCESS_START string")
    rows = features.WeekdayEncoder().transform(df).collect()
    assert rows[0]["WEEKDAY_SIN"] == pytest.approx(0.0) and rows[0]["WEEKDAY_COS"] == pytest.approx(1.0)
    assert rows[1]["WEEKDAY_SIN"] is None and rows[2]["WEEKDAY_COS"] is None


def test_log1p_guard_and_clip_keeps_null(spark):
    df = spark.createDataFrame([(-2.0,), (0.0,), (None,)], "AMT_CREDIT double")
    out = features.Log1p(columns=["AMT_CREDIT"]).transform(df).collect()
    assert [r[0] for r in out] == [None, 0.0, None]
    capped = quality.SocialCircleCap(columns=["x"], percentile=0.5)
    d = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (None,)], "x double")
    assert [r[0] for r in capped.fit(d).transform(d).collect()] == [1.0, 2.0, 2.0, None]


# ------------------------------------------------------------ quantiles
def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(size=3000), np.full(500, 1.25), rng.exponential(size=1500) * 1e6])
    df = spark.createDataFrame([(float(v),) for v in x], "x double").repartition(7)
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.9999, 1.0]
    got = exact_quantiles(df, ["x"], probs, max_collect=200, sketch_k=256)["x"]
    for p in probs:
        assert got[p] == pytest.approx(float(np.quantile(x, p)), rel=1e-12, abs=1e-12)


def test_order_statistics_and_empty(spark):
    df = spark.createDataFrame([(float(v),) for v in [5, 1, 4, 1, 3]] + [(None,)], "x double")
    st = order_statistics(df, {"x": F.col("x")}, {"x": [0, 1, 4, 9]}, max_collect=2)
    assert st["x"] == {0: 1.0, 1: 1.0, 4: 5.0, 9: None}
    empty = spark.createDataFrame([], "x double")
    assert exact_quantiles(empty, ["x"], [0.5])["x"][0.5] is None


@pytest.mark.parametrize("kw", [{}, {"max_collect": 50}, {"max_collect": 100, "margin": 1e-6}])
def test_exact_quantiles_whatever_the_sketch_says(spark, kw):
    """Heavy tails, a value that fills most of a column, gaps, and brackets too narrow for the sketch's error."""
    rng = np.random.default_rng(1)
    n = 20000
    wide = np.exp(rng.normal(size=n) * 8)
    wide[:2] = 1e300, -1e300
    cols = {"normal": rng.normal(size=n), "wide": wide, "few": rng.integers(0, 5, n).astype(float),
            "tied": np.where(rng.random(n) < .6, 7.0, rng.normal(size=n)), "one": np.full(n, 3.0),
            "gaps": np.where(rng.random(n) < .9, np.nan, rng.normal(size=n))}
    df = spark.createDataFrame(pd.DataFrame(cols)).withColumn("none", F.lit(None).cast("double")).repartition(5)
    probs = [0, 0.01, 0.25, 0.5, 0.75, 0.999, 1]
    got = exact_quantiles(df, [*cols, "none"], probs, **kw)
    for c, x in cols.items():
        assert [got[c][p] for p in probs] == pytest.approx(list(np.nanquantile(x, probs)), rel=1e-12)
    assert got["none"] == {p: None for p in probs}


def test_kept_sketches_merge(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"day": rng.integers(0, 6, 30000), "x": rng.lognormal(size=30000) * 1e3, "y": rng.normal(size=30000)})
    pdf.loc[pdf["day"] == 5, "y"] = np.nan
    df = spark.createDataFrame(pdf)
    days = sketch_table(df, ["x", "y"], by=["day"])
    assert days.count() == 12 and days.where("sketch IS NULL").select("day", "column").collect() == [(5, "y")]
    probs = [0.0, 0.1, 0.5, 0.9, 0.999, 1.0]
    for some, by in ((merge_sketches(days), []), (merge_sketches(days, ["day"]), ["day"])):
        for r in approximate_quantiles(some, probs, by).collect():
            x = pdf[r["column"]] if not by else pdf[pdf["day"] == r["day"]][r["column"]]
            x = x.dropna().to_numpy()
            assert (x < r["value"]).mean() - 2 * RANK_ERROR <= r["p"] <= (x <= r["value"]).mean() + 2 * RANK_ERROR
    assert merge_sketches(days).agg(F.sum("n")).first()[0] == 30000 + int((pdf["day"] != 5).sum())


# ------------------------------------------------------------ imputers
def test_modes_smallest_on_ties(spark):
    df = spark.createDataFrame([("b", 2.0), ("a", 2.0), ("b", 1.0), ("a", 1.0), (None, None)], "s string, x double")
    assert impute.modes(df, ["s", "x"]) == {"s": "a", "x": 1.0}


def test_employment_and_occupation(spark):
    df = spark.createDataFrame([(365243, None, "Pensioner"), (-100, "", "Working"), (None, None, "Unemployed"),
                                (-5, "Drivers", "Pensioner")], "DAYS_EMPLOYED long, OCCUPATION_TYPE string, NAME_INCOME_TYPE string")
    out = impute.OccupationImputer().transform(impute.EmploymentImputer().transform(df)).collect()
    assert [r["DAYS_EMPLOYED"] for r in out] == [0.0, -100.0, 0.0, -5.0]
    assert [r["OCCUPATION_TYPE"] for r in out] == ["Unemployed", "Laborers", "Unemployed", "Drivers"]


def test_fit_uses_training_rows_only(spark):
    train = spark.createDataFrame([(1.0,), (3.0,), (None,)], "x double")
    test1 = spark.createDataFrame([(None,), (100.0,)], "x double")
    test2 = spark.createDataFrame([(None,), (-100.0,)], "x double")
    m = impute.SimpleImputer(columns=["x"], strategy="median").fit(train)
    assert m.transform(test1).collect()[0][0] == 2.0
    assert m.transform(test2).collect()[0][0] == 2.0


# ------------------------------------------------------------ encoders
def test_encoders_unseen_and_null(spark):
    train = spark.createDataFrame([("b", "x"), ("a", "y"), (None, "x")], "c string, d string")
    test = spark.createDataFrame([("z", "q"), ("a", None)], "c string, d string")
    enc = encode.FlexibleEncoder(label_encode_cols=["c"], onehot_encode_cols=["d"], frequency_encode_cols=[])
    out = enc.fit(train).transform(test).collect()
    # classes sorted: a, b, nan → unseen 'z' becomes class 0
    assert [r["c"] for r in out] == [0, 0]
    assert out[0]["d_y"] == 0.0 and out[1]["d_y"] == 0.0
    freq = encode.FlexibleEncoder(frequency_encode_cols=["c"]).fit(train).transform(test).collect()
    assert [r["c_freq"] for r in freq] == [0.0, 0.5]
    ordn = encode.FlexibleEncoder(ordinal_encode_cols=["d"], ordinal_mappings={"d": ["y", "x"]}).fit(train)
    assert [r["d"] for r in ordn.transform(test).collect()] == [-1.0, -1.0]


def test_scaler_constant_column(spark):
    df = spark.createDataFrame([(1.0, 5.0, 0), (3.0, 5.0, 1)], "a double, b double, TARGET int")
    out = features.StandardScale().fit(df).transform(df).collect()
    assert [r["a"] for r in out] == [-1.0, 1.0]
    assert [r["b"] for r in out] == [0.0, 0.0]
    assert [r["TARGET"] for r in out] == [0, 1]


# ------------------------------------------------------------ selection
def test_vif_collinear_and_uncentred(spark):
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=300), rng.normal(size=300)
    rows = [(float(x), float(y), float(x + y), float(z)) for x, y, z in zip(a, b, rng.normal(size=300))]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    kept, removed, hist = select.vif_filter(df, ["a", "b", "c", "d"], 10.0)
    assert math.isinf(max(v for _, v in hist[0]))
    assert len(removed) == 1 and set(kept) | set(removed) == {"a", "b", "c", "d"}
    # uncentred VIF by direct regression without intercept
    X = np.array([[r[0], r[1], r[3]] for r in rows])
    G = X.T @ X
    v = select.vif_from_gram(G, X.sum(axis=0), len(X))
    for i in range(3):
        others = np.delete(X, i, axis=1)
        beta, *_ = np.linalg.lstsq(others, X[:, i], rcond=None)
        ssr = ((X[:, i] - others @ beta) ** 2).sum()
        assert v[i] == pytest.approx((X[:, i] ** 2).sum() / ssr, rel=1e-8)


def test_binary_variance_filter(spark):
    df = spark.createDataFrame([(0, 1, 2.0)] + [(0, 0, float(i)) for i in range(200)], "f1 int, f2 int, x double")
    kept, removed = select.binary_variance_filter(df, ["f1", "f2", "x"], 0.01)
    assert kept == ["f1", "x"] and removed == ["f2"]


# ------------------------------------------------------------ statistics
def test_pvalue_tails_textbook():
    assert sm.chi2_sf(3.841458820694124, 1) == pytest.approx(0.05, abs=1e-9)
    assert sm.chi2_sf(5.991464547107979, 2) == pytest.approx(0.05, abs=1e-9)
    assert sm.t_two_sided(2.2281388519649385, 10) == pytest.approx(0.05, abs=1e-9)
    assert sm.f_sf(4.964602743730711, 1, 10) == pytest.approx(0.05, abs=1e-9)
    # binary target: F = t², so both tails agree
    r, n = 0.3, 50
    t = r * math.sqrt((n - 2) / (1 - r * r))
    assert sm.corr_p_value(r, n) == pytest.approx(sm.f_sf(t * t, 1, n - 2), rel=1e-9)


def test_chi2_yates_two_by_two(spark):
    rows = [("a", 1)] * 10 + [("a", 0)] * 20 + [("b", 1)] * 30 + [("b", 0)] * 15
    df = spark.createDataFrame(rows, "f string, TARGET int")
    r = stats.contingency_stats(df, ["f"]).collect()[0]
    O = np.array([[20, 10], [15, 30]], float)
    E = O.sum(1)[:, None] * O.sum(0)[None, :] / O.sum()
    yates = (((np.abs(O - E) - 0.5) ** 2) / E).sum()
    assert r["chi2"] == pytest.approx(yates, rel=1e-12)
    assert r["dof"] == 1 and r["p_value"] == pytest.approx(sm.chi2_sf(yates, 1), rel=1e-9)


def test_iv_one_class_is_zero(spark):
    df = spark.createDataFrame([("a", 1), ("b", 1), ("a", 1)], "f string, TARGET int")
    r = stats.contingency_stats(df, ["f"]).collect()[0]
    assert r["information_value"] == 0.0 and r["chi2"] == 0.0 and r["p_value"] == 1.0


def test_spearman_ties_match_numpy(spark):
    rng = np.random.default_rng(5)
    x = rng.integers(0, 7, size=400)
    y = (rng.random(400) < 0.2 + 0.05 * x).astype(int)
    df = spark.createDataFrame([(int(a), int(b)) for a, b in zip(x, y)], "f long, TARGET int")
    got = stats.spearman(df, "f").collect()[0]["spearman_r"]

    def avg_rank(v):
        order = np.argsort(v, kind="mergesort")
        ranks = np.empty(len(v))
        ranks[order] = np.arange(1, len(v) + 1)
        for u in np.unique(v):
            ranks[v == u] = ranks[v == u].mean()
        return ranks
    want = np.corrcoef(avg_rank(x), avg_rank(y))[0, 1]
    assert got == pytest.approx(want, rel=1e-10)


def test_running_sums_bucketed_equals_window(spark):
    df = spark.createDataFrame([(float(i), i % 3) for i in range(5000)], "v double, n long").repartition(5)
    a = {r["v"]: r["cum_n"] for r in running_sums(df, "v", ["n"], max_rows=300).collect()}
    b = {r["v"]: r["cum_n"] for r in running_sums(df, "v", ["n"]).collect()}
    assert a == b


# ------------------------------------------------------------ evaluation
def test_auc_with_ties(spark):
    scores = [0.1, 0.4, 0.4, 0.8, 0.8, 0.9]
    labels = [0, 0, 1, 0, 1, 1]
    df = spark.createDataFrame(list(zip(labels, scores)), "label int, probability double")
    auc = evaluate.roc_auc(df).collect()[0][0]
    pos = [s for s, l in zip(scores, labels) if l == 1]
    neg = [s for s, l in zip(scores, labels) if l == 0]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert auc == pytest.approx(want)


def test_metrics_zero_when_undefined(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "label int, prediction int")
    m = evaluate.classification_metrics(df).collect()[0]
    assert m["precision_1"] == 0.0 and m["recall_1"] == 0.0 and m["accuracy"] == 1.0


# ------------------------------------------------------------ sampling
def test_stratified_split_sizes_and_disjoint(spark):
    rows = [(i, 1 if i % 13 == 0 else 0) for i in range(1, 2001)]
    df = spark.createDataFrame(rows, "ID long, TARGET int")
    s = sampling.stratified_split(df, test_size=0.2, seed=42)
    counts = {(r["split"], r["TARGET"]): r["count"] for r in s.groupBy("split", "TARGET").count().collect()}
    assert counts[("test", 0)] + counts[("test", 1)] == 400
    assert counts[("test", 1)] == 31 and counts[("train", 1)] == 122
    again = sampling.stratified_split(df.repartition(3), test_size=0.2, seed=42)
    a = {r.ID for r in s.where("split = 'test'").select("ID").collect()}
    b = {r.ID for r in again.where("split = 'test'").select("ID").collect()}
    assert a == b


def test_split_of_many_classes(spark):
    """10,000 classes of all sizes, one with a third of all rows, one NULL; sizes exact, ties of hashes by id."""
    rows = spark.range(60000).selectExpr(
        "id AS ID", "CASE WHEN id % 3 = 0 THEN 0 WHEN id % 97 = 1 THEN NULL ELSE id % 10007 END AS TARGET")
    out = sampling.stratified_split(rows, test_size=0.2, seed=7)
    assert out.columns == ["ID", "TARGET", "split"]
    got = {r["TARGET"]: (r["n"], r["t"]) for r in out.groupBy("TARGET").agg(
        F.count("*").alias("n"), F.sum((F.col("split") == "test").cast("int")).alias("t")).collect()}
    n = sum(a for a, _ in got.values())
    n_test = math.ceil(0.2 * n)
    n_train = n - n_test
    train = {k: n_train * a // n for k, (a, _) in got.items()}
    order = sorted(got, key=lambda k: (-(n_train * got[k][0] % n), k is None, k))
    for k in order[:n_train - sum(train.values())]:
        train[k] += 1
    assert n == 60000 and len(got) > 10000 and {k: a - t for k, (a, t) in got.items()} == train
    picked = sorted((r["h"], r["ID"]) for r in out.where("TARGET = 0").select(sampling.split_hash("ID", 7).alias("h"), "ID").collect())
    side = {r["ID"]: r["split"] for r in out.where("TARGET = 0").collect()}
    assert [side[i] for _, i in picked] == ["test"] * got[0][1] + ["train"] * (got[0][0] - got[0][1])


def test_class_weights_of_many_classes(spark):
    df = spark.range(1000).selectExpr("IF(id < 400, 0, id % 100) AS y")
    got = {r["y"]: r["weight"] for r in sampling.with_class_weight(df, "y").distinct().collect()}
    assert len(got) == 100 and got[0] == pytest.approx(1000 / (100 * 406)) and got[7] == pytest.approx(1000 / (100 * 6))


def test_missing_lattice(spark):
    rng = np.random.default_rng(4)
    cols = [f"c{k}" for k in range(7)]
    rows = [tuple(None if rng.random() < 0.15 * k else 1 for k in range(7)) for _ in range(300)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} int" for c in cols))
    gone = [{c for c, v in zip(cols, r) if v is None} for r in rows]
    patterns = {tuple(r["missing"]): r["rows"] for r in profile.missing_patterns(df, cols).collect()}
    assert patterns == {tuple(sorted(g)): gone.count(g) for g in gone}
    for order in (1, 2, 4):
        got = {r["columns"]: (r["n_columns"], r["rows_all_missing"], r["rows_only_these"]) for r in profile.missing_lattice(df, cols, order).collect()}
        want = {}
        for n in range(1, order + 1):
            for x in itertools.combinations(cols, n):
                if every := sum(set(x) <= g for g in gone):
                    want[",".join(x)] = (n, every, gone.count(set(x)))
        assert got == want
    assert profile.missing_lattice(df.limit(0), cols).collect() == []
    together = profile.missing_together(profile.missing_patterns(df.limit(0), cols), [["c1", "c2"], []]).collect()
    assert [tuple(r) for r in together] == [("c1,c2", 0, 0), ("", 0, 0)]


def test_smote_balances_and_interpolates(spark):
    rng = np.random.default_rng(2)
    rows = [(i, 0, float(x), float(y)) for i, (x, y) in enumerate(rng.normal(size=(120, 2)), start=1)]
    rows += [(1000 + i, 1, float(x) + 5, float(y) + 5) for i, (x, y) in enumerate(rng.normal(size=(20, 2)))]
    df = spark.createDataFrame(rows, "ID long, TARGET int, a double, b double")
    out = smote(df, ["a", "b"], "TARGET", "ID", k=5, seed=42, max_cell=8)
    counts = {r["TARGET"]: r["count"] for r in out.groupBy("TARGET").count().collect()}
    assert counts == {0: 120, 1: 120}
    minority = np.array([[r[2], r[3]] for r in rows if r[1] == 1])
    synth = out.where("TARGET = 1 AND ID < 0").select("a", "b").collect()
    lo, hi = minority.min(axis=0), minority.max(axis=0)
    for r in synth:  # every synthetic point lies in the minority's bounding box
        assert lo[0] - 1e-9 <= r[0] <= hi[0] + 1e-9 and lo[1] - 1e-9 <= r[1] <= hi[1] + 1e-9


def test_knn_impute_brute_force(spark):
    rng = np.random.default_rng(4)
    n = 80
    X = rng.normal(size=(n, 4))
    X[rng.random((n, 4)) < 0.25] = np.nan
    rows = [(i, *[None if np.isnan(v) else float(v) for v in X[i]]) for i in range(n)]
    df = spark.createDataFrame(rows, "ID long, t1 double, t2 double, f1 double, f2 double")
    got = {r["ID"]: (r["t1"], r["t2"]) for r in knn_impute(df, df, ["t1", "t2"], ["f1", "f2"], k=3,
                                                          max_cell=10).collect()}

    def nan_dist(a, b):
        m = ~np.isnan(a) & ~np.isnan(b)
        if not m.any():
            return np.nan
        return math.sqrt(4 / m.sum() * ((a[m] - b[m]) ** 2).sum())
    for i in range(n):
        for c in (0, 1):
            if not np.isnan(X[i, c]):
                assert got[i][c] == X[i, c]
                continue
            cand = [(nan_dist(X[i], X[j]), j) for j in range(n) if not np.isnan(X[j, c])]
            cand = sorted((d, j) for d, j in cand if not np.isnan(d))[:3]
            want = np.mean([X[j, c] for _, j in cand]) if cand else np.nanmean(X[:, c])
            assert got[i][c] == pytest.approx(want, rel=1e-9)


def test_knn_join_exact_small(spark):
    pts = [(i, "s", [float(i % 5), float(i // 5)]) for i in range(40)]
    df = spark.createDataFrame(pts, "id long, space string, vec array<double>")
    res = knn_join(df.withColumnRenamed("id", "qid"), df.withColumnRenamed("id", "did"), 3, exclude_self=True,
                   max_cell=6).where("qid = 12").orderBy("rank").collect()
    assert [r["did"] for r in res] == [7, 11, 13]


# ------------------------------------------------------------ reports
def test_topk_others_and_amplitude(spark):
    rows = [("a", 1)] * 5 + [("b", 0)] * 3 + [("c", 0)] * 2 + [("d", 1)] + [(None, 0)] * 4
    df = spark.createDataFrame(rows, "f string, TARGET int")
    top = [(r["category"], r["count"]) for r in charts.topk_others(df, "f", 2).orderBy("rank").collect()]
    assert top == [("a", 5), ("b", 3), ("Others", 3)]
    amp = {r["category"]: r for r in charts.amplitude(df, "f", "TARGET", 10).collect()}
    assert amp["a"]["default_pct"] == round(5 / 6 * 100, 3)
    assert amp["b"]["non_default_pct"] == round(3 / 9 * 100, 3)


def test_missing_reports(spark):
    df = spark.createDataFrame([(1, None, None), (2, 1.0, None), (3, None, None)], "id long, a double, b double")
    co = profile.co_missing(df, ["a", "b"]).collect()[0]
    assert co["rows_all_missing"] == 2 and co["same_rows"] is False
    ms = {r["column"]: r["missing_count"] for r in profile.missing_summary(df).collect()}
    assert ms == {"id": 0, "a": 2, "b": 3}


def test_partition_invariance(spark):
    rows = [(i, float(i % 17), i % 2) for i in range(3000)]
    one = spark.createDataFrame(rows, "ID long, x double, TARGET int").coalesce(1)
    many = one.repartition(8)
    a = stats.continuous_target_stats(one, ["x"]).collect()[0]
    b = stats.continuous_target_stats(many, ["x"]).collect()[0]
    assert a["anova_f"] == pytest.approx(b["anova_f"], rel=1e-12)
    assert exact_quantiles(one, ["x"], [0.3]) == exact_quantiles(many, ["x"], [0.3])


def test_kde_matches_numpy(spark):
    rng = np.random.default_rng(8)
    rows = [(int(t), float(x)) for t, x in zip(rng.integers(0, 2, 500), rng.normal(size=500))]
    df = spark.createDataFrame(rows, "TARGET int, x double").repartition(4)
    out = charts.distribution_by_target(df, "x", "TARGET", gridsize=20).collect()
    for cls in ("0", "1"):
        x = np.array([v for t, v in rows if str(t) == cls])
        bw = x.std(ddof=1) * len(x) ** (-0.2)
        pts = sorted((r["grid_index"], r["x"], r["density"]) for r in out if r["TARGET"] == cls)
        for _, g, d in pts:
            want = np.exp(-0.5 * ((g - x) / bw) ** 2).sum() / (len(x) * bw * math.sqrt(2 * math.pi))
            assert d == pytest.approx(want, rel=1e-9)


def test_knn_join_hot_duplicates(spark):
    rng = np.random.default_rng(1)
    X = rng.integers(0, 4, size=(300, 2)).astype(float)
    X[:100] = [1.0, 1.0]  # a third of the rows share one vector
    rows = [(i, "s", x.tolist()) for i, x in enumerate(X)]
    df = spark.createDataFrame(rows, "id long, space string, vec array<double>")
    res = knn_join(df.withColumnRenamed("id", "qid"), df.withColumnRenamed("id", "did"), 4, exclude_self=True,
                   max_cell=30).collect()
    got = {}
    for r in res:
        got.setdefault(r["qid"], []).append((r["rank"], r["did"]))
    ids = np.arange(len(X))
    for i in range(len(X)):
        d = np.sqrt(((X - X[i]) ** 2).sum(1))
        d[i] = np.inf
        assert [did for _, did in sorted(got[i])] == list(ids[np.lexsort((ids, d))[:4]])


def test_save_load_gives_equal_predictions(spark):
    from lendlens.plans import experiments as ex
    from lendlens.plans.catalog import apps
    from lendlens.session import scratch_path
    df = apps(spark, "/root/testdata/sf0.001")
    train, test = ex.split_once(df)
    res = ex.train_and_evaluate(train, test, "logistic_regression")
    path = ex.save_model(scratch_path(spark, "model-test"), res["model"], "logistic_regression", "preprocessed",
                         res["features"], res["pipeline"])
    art = ex.load_model(path)
    assert art["feature_names"] == res["features"] and art["model_type"] == "logistic_regression"
    a = {r["ID"]: (r["prediction"], r["probability"]) for r in ex.score_frame(art, test).collect()}
    b = {r["ID"]: (r["prediction"], r["probability"]) for r in res["test_scored"].collect()}
    assert a.keys() == b.keys() and all(a[k][0] == b[k][0] and a[k][1] == pytest.approx(b[k][1]) for k in a)
    with pytest.raises(ValueError):
        ex.save_model(path, None, "logistic_regression", "preprocessed", [])


def test_empty_frames_keep_schema(spark):
    empty = spark.createDataFrame([], "ID long, TARGET int, x double, s string")
    assert profile.missing_summary(empty).collect() == [("ID", 0, None), ("TARGET", 0, None), ("x", 0, None),
                                                       ("s", 0, None)]
    assert [r["row_count"] for r in profile.row_missing_over(empty).collect()] == [0] * 8
    assert charts.amplitude(empty, "s").collect() == []
    assert charts.hour_bin_risk(empty.withColumnRenamed("x", "HOUR_APPR_PROCESS_START")).collect() == []
    assert stats.contingency_stats(empty, ["s"]).collect() == []
    assert evaluate.confusion_matrix(empty.withColumnRenamed("TARGET", "label")
                                     .withColumn("prediction", F.lit(0))).count() == 4


def test_roc_drops_collinear_points_and_pr_stops_at_full_recall(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.8), (1, 0.7), (0, 0.6)], "label int, probability double")
    roc = [(r["fpr"], r["tpr"], r["threshold"]) for r in evaluate.roc_curve(df).collect()]
    assert sorted(roc, key=lambda t: -t[2]) == [(0.0, 0.0, math.inf), (0.0, 1 / 3, 0.9), (0.0, 1.0, 0.7),
                                               (1.0, 1.0, 0.6)]
    pr = {(r["precision"], r["recall"], r["threshold"]) for r in evaluate.pr_curve(df).collect()}
    assert pr == {(1.0, 1 / 3, 0.9), (1.0, 2 / 3, 0.8), (1.0, 1.0, 0.7), (1.0, 0.0, None)}


def test_smote_ids_unique_and_reproducible(spark):
    rows = [(i, 0 if i > 12 else 1, float(i % 7), float(i % 5)) for i in range(1, 61)]
    df = spark.createDataFrame(rows, "ID long, TARGET int, a double, b double")
    out = smote(df, ["a", "b"], "TARGET", "ID", k=3, seed=7, max_cell=8)
    assert out.select("ID").distinct().count() == out.count() == 96
    again = smote(df.repartition(5), ["a", "b"], "TARGET", "ID", k=3, seed=7, max_cell=8)
    key = lambda d: sorted((r["ID"], round(r["a"], 12), round(r["b"], 12)) for r in d.where("ID < 0").collect())
    assert key(out) == key(again)
