"""Correlation and feature–target statistics.

Design rule: many features are profiled with one scan. Columns are unpivoted
to ``(feature, value, target)`` and grouped once (the only shuffle of base
rows, combined map-side); every statistic is then computed from that small
table. p-values come from a pandas UDF applied to the per-feature rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendlens.functions.exprs import np_round, safe_corr
from lendlens.functions.quantiles import exact_quantiles
from lendlens.functions.ranking import average_ranks, running_sums
from lendlens.functions.stats_math import chi2_sf_udf, corr_p_udf, f_sf_udf


def _unpivot(df: DataFrame, features, target: str, as_text: bool) -> DataFrame:
    vt = "string" if as_text else "double"
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f).cast(vt).alias("value")) for f in features
    ])).alias("s"), F.col(target).alias("t")).select("s.feature", "s.value", "t")
    return long.where(F.col("value").isNotNull() & F.col("t").isNotNull())


# ---------------------------------------------------------------- H1–H3, G4
def correlation_matrix(df: DataFrame, cols, method: str = "auto") -> DataFrame:
    """H1: pairwise-complete Pearson correlation, long form ``(col_a, col_b,
    correlation)`` over all ordered pairs. Default: masked Gram sums per
    partition (NumPy in ``mapInPandas``, one pass for any width) added up by a
    ``groupBy`` of p² cells. ``method="agg"``: one JVM aggregate of a
    null-safe correlation per pair (fine for a handful of columns; p² large
    aggregates overflow the generated-code method limit)."""
    cols = list(cols)
    if method == "auto":
        method = "gram"
    if method == "agg":
        pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
        row = df.agg(*[safe_corr(a, b).alias(f"c{k}") for k, (a, b) in enumerate(pairs)])
        parts = []
        for k, (a, b) in enumerate(pairs):
            parts.append(F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(f"c{k}").alias("correlation")))
            if a != b:
                parts.append(F.struct(F.lit(b).alias("col_a"), F.lit(a).alias("col_b"), F.col(f"c{k}").alias("correlation")))
        return row.select(F.explode(F.array(*parts)).alias("s")).select("s.*")
    return _gram_correlation(df, cols)


def _gram_correlation(df: DataFrame, cols) -> DataFrame:
    p = len(cols)
    shift = df.agg(*[F.avg(c).alias(c) for c in cols]).first()
    shift = np.array([shift[c] if shift[c] is not None else 0.0 for c in cols])

    def partial(it):
        n = sx = sxx = sxy = None
        for pdf in it:
            X = pdf.to_numpy(dtype="float64", na_value=np.nan) - shift
            M = (~np.isnan(X)).astype("float64")
            Z = np.where(M > 0, X, 0.0)
            part = (M.T @ M, Z.T @ M, (Z * Z).T @ M, Z.T @ Z)
            if n is None:
                n, sx, sxx, sxy = part
            else:
                n, sx, sxx, sxy = n + part[0], sx + part[1], sxx + part[2], sxy + part[3]
        if n is None:
            return
        ii, jj = np.meshgrid(np.arange(p), np.arange(p), indexing="ij")
        yield pd.DataFrame({"a": ii.ravel(), "b": jj.ravel(), "n": n.ravel(), "sx": sx.ravel(),
                            "sy": sx.T.ravel(), "sxx": sxx.ravel(), "syy": sxx.T.ravel(), "sxy": sxy.ravel()})

    schema = "a int, b int, n double, sx double, sy double, sxx double, syy double, sxy double"
    sums = (df.select(*[F.col(c).cast("double") for c in cols]).mapInPandas(partial, schema)
            .groupBy("a", "b").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")]))
    num = F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy")
    den = F.sqrt((F.col("n") * F.col("sxx") - F.col("sx") ** 2) * (F.col("n") * F.col("syy") - F.col("sy") ** 2))
    names = F.array(*[F.lit(c) for c in cols])
    return sums.select(F.element_at(names, F.col("a") + 1).alias("col_a"),
                       F.element_at(names, F.col("b") + 1).alias("col_b"),
                       F.when(F.col("n") >= 2, F.try_divide(num, den)).alias("correlation"))


def target_correlation(df: DataFrame, cols, target: str = "TARGET") -> DataFrame:
    """H2: correlation of each column with the target, largest |r| first."""
    cols = [c for c in cols if c != target]
    row = df.agg(*[safe_corr(c, target).alias(f"c{i}") for i, c in enumerate(cols)])
    parts = [F.struct(F.lit(c).alias("feature"), F.col(f"c{i}").alias("correlation")) for i, c in enumerate(cols)]
    out = row.select(F.explode(F.array(*parts)).alias("s")).select("s.*")
    return out.orderBy(F.abs("correlation").desc_nulls_last(), F.asc("feature"))


def correlation_bands(df: DataFrame, cols, target: str = "TARGET") -> DataFrame:
    """H3: strong (|r| > 0.3), medium (0.1 < |r| <= 0.3), weak (|r| <= 0.1)."""
    a = F.abs(F.col("correlation"))
    return target_correlation(df, cols, target).withColumn(
        "band", F.when(a > 0.3, "strong").when(a > 0.1, "medium").when(a <= 0.1, "weak"))


def top_correlated(df: DataFrame, col: str, candidates, n: int = 5) -> DataFrame:
    """The n candidates with the largest |Pearson r| against ``col``
    (itself excluded, undefined correlations dropped)."""
    cands = [c for c in dict.fromkeys(candidates) if c != col]
    # One pass of masked Gram sums (pairwise-complete, like corr) for col
    # against every candidate; only the col row of the matrix is kept.
    m = correlation_matrix(df, [col] + cands).where((F.col("col_a") == col) & (F.col("col_b") != col))
    out = m.select(F.col("col_b").alias("feature"), "correlation")
    out = out.where(F.col("correlation").isNotNull() & ~F.isnan("correlation"))
    return out.orderBy(F.abs("correlation").desc(), F.asc("feature")).limit(n)


# ---------------------------------------------------------------- H5–H8, H18
def continuous_metrics(df: DataFrame, col: str, target: str | None = None) -> DataFrame:
    """H5: count, missing, mean, exact median, sample std, min, max, biased
    skewness and excess kurtosis (population moments); optional one-way ANOVA
    of the column over target groups."""
    x = F.col(col).cast("double")
    row = df.agg(F.count(x).alias("count"), (F.count(F.lit(1)) - F.count(x)).alias("missing"),
                 F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"), F.min(x).alias("min"),
                 F.max(x).alias("max"), F.skewness(x).alias("skewness"), F.kurtosis(x).alias("kurtosis"))
    med = exact_quantiles(df, [col], [0.5])[col][0.5]
    out = row.select(F.lit(col).alias("feature"), "count", "missing", "mean",
                     F.lit(med).cast("double").alias("median"), "std", "min", "max", "skewness", "kurtosis")
    if target is not None:
        a = anova_f(df, [col], target).select(F.col("f_statistic").alias("anova_f"),
                                              F.col("p_value").alias("anova_p"))
        out = out.withColumns({"anova_f": a.select("anova_f").scalar(),
                               "anova_p": a.select("anova_p").scalar()})
    return out


def shape_metrics(df: DataFrame, col: str) -> DataFrame:
    """H6: bias-corrected skewness and excess kurtosis (pandas' estimators),
    from the population moments of one aggregate."""
    x = F.col(col).cast("double")
    row = df.agg(F.count(x).alias("n"), F.skewness(x).alias("g1"), F.kurtosis(x).alias("g2"))
    n, g1, g2 = F.col("n").cast("double"), F.col("g1"), F.col("g2")
    return row.select(
        F.lit(col).alias("feature"),
        F.when(n > 2, g1 * F.sqrt(n * (n - 1)) / (n - 2)).alias("skewness"),
        F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6)).alias("kurtosis"))


def normality_check(df: DataFrame, col: str) -> DataFrame:
    """H18 (re-aimed): Jarque–Bera statistic n/6·(g1² + g2²/4) from the
    population moments, p from chi-square with 2 degrees of freedom."""
    x = F.col(col).cast("double")
    row = df.agg(F.count(x).alias("n"), F.skewness(x).alias("g1"), F.kurtosis(x).alias("g2"))
    jb = F.col("n") / 6.0 * (F.col("g1") ** 2 + F.col("g2") ** 2 / 4.0)
    return row.select(F.lit(col).alias("feature"), F.col("n").alias("count"), jb.alias("jarque_bera"),
                      F.exp(-jb / 2.0).alias("p_value"))


def nominal_metrics(df: DataFrame, col: str) -> DataFrame:
    """H7: count, missing, distinct values, mode (smallest on ties), its
    frequency and its percent of the non-null rows."""
    counts = (df.where(F.col(col).isNotNull()).groupBy(F.col(col).cast("string").alias("v"))
              .agg(F.count(F.lit(1)).alias("n")))
    missing = df.where(F.col(col).isNull()).select(F.count(F.lit(1))).scalar()
    agg = counts.agg(F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique_values"),
                     F.min(F.struct((-F.col("n")).alias("k"), F.col("v"))).alias("m"))
    return agg.select(F.lit(col).alias("feature"), F.coalesce("count", F.lit(0)).cast("long").alias("count"),
                      missing.alias("missing"), "unique_values", F.col("m.v").alias("mode"),
                      F.coalesce(-F.col("m.k"), F.lit(0)).cast("long").alias("mode_frequency"),
                      F.coalesce(-F.col("m.k") * 100.0 / F.col("count"), F.lit(0.0)).alias("mode_percentage"))


def ordinal_metrics(df: DataFrame, col: str, order_mapping: dict | None = None) -> DataFrame:
    """H8: categories in ordinal order (unmapped rank 0, ties by frequency),
    frequency, percent (2 dp) and cumulative percent (2 dp, from exact
    cumulative counts)."""
    counts = (df.where(F.col(col).isNotNull()).groupBy(F.col(col).cast("string").alias("category"))
              .agg(F.count(F.lit(1)).alias("frequency")))
    if order_mapping:
        keys = list(order_mapping)
        rank = F.coalesce(F.try_element_at(F.map_from_arrays(F.lit(keys), F.lit([float(order_mapping[k]) for k in keys])),
                                           F.col("category")), F.lit(0.0))
        key = F.struct(rank.alias("r"), (-F.col("frequency")).alias("f"), F.col("category").alias("c"))
    else:
        key = F.struct(F.col("category").alias("c"))
    total = counts.select(F.sum("frequency")).scalar()
    keyed = counts.withColumns({"_key": key, "_one": F.lit(1)})
    out = running_sums(keyed, "_key", ["_one", "frequency"])
    return out.select(F.col("cum__one").cast("int").alias("order"), "category", "frequency",
                      np_round(F.col("frequency") * 100.0 / total, 2).alias("percentage"),
                      np_round(F.col("cum_frequency") * 100.0 / total, 2).alias("cumulative_percentage"))


# ---------------------------------------------------------------- M11
def crosstab(df: DataFrame, row: str, col: str, normalize: bool = False, max_width: int = 1000) -> DataFrame:
    """Counts of every pair of values as a table, a row per value of ``row`` and a column per value of ``col``
    (its text; NULLs of either are left out), or, normalised, each column's shares.

    The cells are one ``groupBy`` (combined map-side); only they are pivoted. ``col`` may have up to ``max_width``
    values, as each becomes a column."""
    cells = df.where(F.col(row).isNotNull() & F.col(col).isNotNull()).groupBy(
        F.col(row).alias(row), F.col(col).cast("string").alias("__col")).agg(F.count(F.lit(1)).alias("__n"))
    totals = {r["__col"]: r["n"] for r in cells.groupBy("__col").agg(F.sum("__n").alias("n")).limit(max_width + 1).collect()}
    if len(totals) > max_width:
        raise ValueError(f"{col}: a crosstab would have more than {max_width} columns")
    if not totals:
        return cells.select(row)
    table = cells.groupBy(row).pivot("__col", sorted(totals)).agg(F.first("__n"))
    count = {c: F.coalesce(F.col(f"`{c}`"), F.lit(0)) for c in sorted(totals)}
    return table.select(row, *[(x / F.lit(float(totals[c])) if normalize else x).alias(c) for c, x in count.items()])


# ---------------------------------------------------------------- H9–H11
def contingency_stats(df: DataFrame, features, target: str = "TARGET", yates: bool = True) -> DataFrame:
    """H9 + H10 + H11 for many text features at once, from one
    ``groupBy(feature, value, target)``: chi-square (Yates-corrected when
    dof = 1), dof, p-value, Cramér's V, information value (class shares
    + 0.0001, natural log) and mutual information (natural log)."""
    cells = _unpivot(df, features, target, as_text=True).groupBy("feature", "value", "t").agg(F.count(F.lit(1)).alias("o"))
    kind = F.col("t").try_cast("double")
    hits = [F.coalesce(F.sum(F.when(kind == c, F.col("o"))), F.lit(0)).alias(name) for c, name in ((0, "good"), (1, "bad"))]
    rows = cells.groupBy("feature", "value").agg(F.sum("o").alias("row"), *hits)
    cols = cells.groupBy("feature", "t").agg(F.sum("o").alias("col"))
    feat = rows.groupBy("feature").agg(F.count(F.lit(1)).alias("r"), F.sum("row").alias("n"), F.sum(1 / F.col("row")).alias("inv_r"),
                                       F.sum("good").alias("goods"), F.sum("bad").alias("bads"))
    feat = feat.join(cols.groupBy("feature").agg(F.count(F.lit(1)).alias("c"), F.sum(1 / F.col("col")).alias("inv_c")), "feature")
    feat = feat.withColumn("dof", (F.col("r") - 1) * (F.col("c") - 1))  # a row per feature
    # Cells that hold no row add e each: n less the e of the others.
    e = F.col("row").cast("double") * F.col("col") / F.col("n")
    off = F.abs(F.col("o") - e)
    sums = (cells.join(rows.select("feature", "value", "row"), ["feature", "value"]).join(cols, ["feature", "t"])
            .join(F.broadcast(feat.select("feature", "n")), "feature").groupBy("feature")
            .agg(F.sum(off * off / e).alias("part"), F.sum(e).alias("seen"), F.max(off).alias("off"),
                 F.sum(F.col("o") / F.col("n") * F.log(F.col("o") / e)).alias("mi")))
    good, bad = F.col("good") / F.col("goods") + 0.0001, F.col("bad") / F.col("bads") + 0.0001
    iv = (rows.join(F.broadcast(feat.where("goods > 0 AND bads > 0").select("feature", "goods", "bads")), "feature")
          .groupBy("feature").agg(F.sum((bad - good) * F.log(bad / good)).alias("iv")))
    out = feat.join(sums, "feature").join(iv, "feature", "left").withColumn("iv", F.coalesce("iv", F.lit(0.0)))
    # In a 2 x 2 table all four cells are equally far off.
    less = F.col("off") - F.least(F.lit(0.5), F.col("off"))
    out = out.withColumn("chi", F.when(F.lit(yates) & (F.col("dof") == 1), less * less * F.col("n") * F.col("inv_r") * F.col("inv_c"))
                         .otherwise(F.col("part") + (F.col("n") - F.col("seen"))))
    chi2 = F.when(F.col("dof") > 0, F.col("chi")).otherwise(F.lit(0.0))
    out = out.select("feature", F.col("r").cast("long").alias("unique_values"), chi2.alias("chi2"),
                     F.col("dof").cast("long").alias("dof"), F.col("n").cast("long").alias("n"),
                     F.when(F.least("r", "c") > 1, F.sqrt(chi2 / (F.col("n") * (F.least("r", "c") - 1))))
                     .alias("cramers_v"),
                     F.col("iv").alias("information_value"), F.col("mi").alias("mutual_information"))
    return out.withColumn("p_value", F.when(F.col("dof") > 0, chi2_sf_udf(F.col("chi2"), F.col("dof").cast("double")))
                          .otherwise(F.lit(1.0)))


def chi2_cramers_v(df: DataFrame, feature: str, target: str = "TARGET") -> DataFrame:
    """H9: chi-square test and Cramér's V of one feature against the target."""
    return contingency_stats(df, [feature], target).select(
        "feature", "unique_values", "chi2", "dof", "p_value", "cramers_v")


def information_value(df: DataFrame, feature: str, target: str = "TARGET") -> DataFrame:
    """Information value of one feature (0 when a class is absent)."""
    return contingency_stats(df, [feature], target).select("feature", "information_value")


def mutual_information(df: DataFrame, feature: str, target: str = "TARGET") -> DataFrame:
    """Mutual information (nats) between the feature's text and the target."""
    return contingency_stats(df, [feature], target).select("feature", "mutual_information")


# ---------------------------------------------------------------- H12, H15
def _group_moments(long: DataFrame) -> DataFrame:
    """Per (feature, target value): count, mean and sample variance of x."""
    return long.groupBy("feature", "t").agg(F.count(F.lit(1)).alias("ng"), F.avg("value").alias("mg"),
                                            F.var_samp("value").alias("vg"))


def continuous_target_stats(df: DataFrame, features, target: str = "TARGET") -> DataFrame:
    """H12 + H15 for many numeric features from one ``groupBy(feature,
    target)`` of the unpivoted rows: point-biserial (Pearson) r with its
    two-sided p, and the one-way ANOVA F with its p. Rows where either the
    feature or the target is NULL are dropped per feature."""
    g = _group_moments(_unpivot(df, features, target, as_text=False)).withColumn("t", F.col("t").cast("double"))
    w = Window.partitionBy("feature")
    n = F.sum("ng").over(w)
    gm = F.sum(F.col("ng") * F.col("mg")).over(w) / n
    tm = F.sum(F.col("ng") * F.col("t")).over(w) / n
    g = g.select("feature", "t", "ng", "mg", F.coalesce("vg", F.lit(0.0)).alias("vg"), n.alias("N"),
                 gm.alias("gm"), tm.alias("tm"))
    per = g.groupBy("feature").agg(
        F.first("N").alias("N"), F.count(F.lit(1)).alias("k"),
        F.sum(F.col("ng") * (F.col("mg") - F.col("gm")) ** 2).alias("ssb"),
        F.sum((F.col("ng") - 1) * F.col("vg")).alias("ssw"),
        F.sum(F.col("ng") * (F.col("mg") - F.col("gm")) * (F.col("t") - F.col("tm"))).alias("sxt"),
        F.sum(F.col("ng") * (F.col("t") - F.col("tm")) ** 2).alias("stt"))
    sxx = F.col("ssb") + F.col("ssw")
    r = F.when((sxx > 0) & (F.col("stt") > 0), F.col("sxt") / F.sqrt(sxx * F.col("stt")))
    fstat = F.when((F.col("k") > 1) & (F.col("N") > F.col("k")),
                   (F.col("ssb") / (F.col("k") - 1)) / (F.col("ssw") / (F.col("N") - F.col("k"))))
    out = per.select("feature", F.col("N").cast("long").alias("n"), r.alias("point_biserial_r"),
                     fstat.alias("anova_f"), (F.col("k") - 1).cast("double").alias("d1"),
                     (F.col("N") - F.col("k")).cast("double").alias("d2"))
    return out.select("feature", "n", "point_biserial_r",
                      corr_p_udf(F.col("point_biserial_r"), F.col("n").cast("double")).alias("point_biserial_p"),
                      "anova_f", f_sf_udf(F.col("anova_f"), F.col("d1"), F.col("d2")).alias("anova_p"))


def point_biserial(df: DataFrame, feature: str, target: str = "TARGET") -> DataFrame:
    """Pearson r of target and a numeric feature, two-sided p (t, n-2)."""
    return continuous_target_stats(df, [feature], target).select(
        "feature", "n", F.col("point_biserial_r").alias("correlation"), F.col("point_biserial_p").alias("p_value"))


def anova_f(df: DataFrame, features, target: str = "TARGET") -> DataFrame:
    """One-way ANOVA of each feature over the target groups."""
    return continuous_target_stats(df, list(features), target).select(
        "feature", F.col("anova_f").alias("f_statistic"), F.col("anova_p").alias("p_value"))


# ---------------------------------------------------------------- H13, H14
def _codes(df: DataFrame, feature: str, order: dict | list | None) -> tuple[DataFrame, Column]:
    """Numeric code of each row's value: the mapped rank when an order is
    given (unmapped rows dropped), else the 0-based position among the
    sorted distinct values (category codes)."""
    base = df.select(F.col(feature).alias("v"), F.col("_t")).where(F.col("v").isNotNull() & F.col("_t").isNotNull())
    if order is not None:
        ranks = order if isinstance(order, dict) else {v: i for i, v in enumerate(order)}
        keys = list(ranks)
        m = F.try_element_at(F.map_from_arrays(F.lit(keys), F.lit([float(ranks[k]) for k in keys])),
                             F.col("v").cast("string"))
        base = base.withColumn("code", m).where(F.col("code").isNotNull())
        return base, F.col("code")
    distinct = base.select("v").distinct().withColumn("_one", F.lit(1))
    coded = running_sums(distinct, "v", ["_one"]).select("v", (F.col("cum__one") - 1).cast("double").alias("code"))
    return base.join(coded, "v"), F.col("code")


def _weighted_pearson(cells: DataFrame, x: str, y: str, w: str = "n") -> DataFrame:
    """Pearson r of (x, y) pairs weighted by counts, from one aggregate of
    raw weighted sums (the inputs are ranks, codes or 0/1, so the sums stay
    well within double precision)."""
    wx, wy = F.col(w) * F.col(x), F.col(w) * F.col(y)
    s = cells.agg(F.sum(w).cast("double").alias("N"), F.sum(wx).alias("sx"), F.sum(wy).alias("sy"),
                  F.sum(wx * F.col(x)).alias("sxx"), F.sum(wy * F.col(y)).alias("syy"),
                  F.sum(wx * F.col(y)).alias("sxy"))
    n = F.col("N")
    vx = n * F.col("sxx") - F.col("sx") ** 2
    vy = n * F.col("syy") - F.col("sy") ** 2
    return s.select(F.col("N").cast("long").alias("n"),
                    F.when((vx > 0) & (vy > 0), (n * F.col("sxy") - F.col("sx") * F.col("sy")) / F.sqrt(vx * vy))
                    .alias("r"))


def spearman(df: DataFrame, feature: str, target: str = "TARGET", order=None) -> DataFrame:
    """Spearman correlation (Pearson of average ranks) and two-sided p.
    Counts per (value, target) are ranked on the distinct values only — no
    global sort of rows — then correlated with counts as weights. With an
    order mapping, unmapped values are dropped."""
    base, code = _codes(df.withColumn("_t", F.col(target)), feature, order)
    cells = base.groupBy(code.alias("x"), F.col("_t").cast("double").alias("y")).agg(F.count(F.lit(1)).alias("n"))
    rx = average_ranks(cells.groupBy("x").agg(F.sum("n").alias("n")), "x").select("x", F.col("avg_rank").alias("rx"))
    ry = average_ranks(cells.groupBy("y").agg(F.sum("n").alias("n")), "y").select("y", F.col("avg_rank").alias("ry"))
    ranked = cells.join(rx, "x").join(F.broadcast(ry), "y")
    res = _weighted_pearson(ranked, "rx", "ry")
    return res.select(F.lit(feature).alias("feature"), "n", F.col("r").alias("spearman_r"),
                      corr_p_udf(F.col("r"), F.col("n").cast("double")).alias("spearman_p"))


def point_biserial_coded(df: DataFrame, feature: str, target: str = "TARGET", order=None) -> DataFrame:
    """Point-biserial r of the target and the feature's category codes
    (or mapped ranks), with p."""
    base, code = _codes(df.withColumn("_t", F.col(target)), feature, order)
    cells = base.groupBy(code.alias("x"), F.col("_t").cast("double").alias("y")).agg(F.count(F.lit(1)).alias("n"))
    res = _weighted_pearson(cells, "x", "y")
    return res.select(F.lit(feature).alias("feature"), "n", F.col("r").alias("point_biserial_r"),
                      corr_p_udf(F.col("r"), F.col("n").cast("double")).alias("point_biserial_p"))


# ---------------------------------------------------------------- H16, H17
def relationship_continuous(df: DataFrame, feature: str, target: str = "TARGET") -> DataFrame:
    """H16 (continuous): point-biserial r and p, ANOVA F and p."""
    return continuous_target_stats(df, [feature], target)


def relationship_nominal(df: DataFrame, feature: str, target: str = "TARGET") -> DataFrame:
    """H16 (nominal): distinct values, chi-square, p, Cramér's V, IV, MI."""
    return contingency_stats(df, [feature], target).select(
        "feature", "unique_values", "chi2", "p_value", "cramers_v", "information_value", "mutual_information")


def relationship_ordinal(df: DataFrame, feature: str, target: str = "TARGET", order=None) -> DataFrame:
    """H16 (ordinal): Spearman r and p, point-biserial r and p on the codes."""
    s = spearman(df, feature, target, order)
    p = point_biserial_coded(df, feature, target, order).select("point_biserial_r", "point_biserial_p")
    return s.select("feature", "spearman_r", "spearman_p").withColumns({
        "point_biserial_r": p.select("point_biserial_r").scalar(),
        "point_biserial_p": p.select("point_biserial_p").scalar()})


def relationship_discrete_few(df: DataFrame, feature: str, target: str = "TARGET") -> DataFrame:
    """H16 (discrete, few values): distinct values, chi-square, p, Cramér's V."""
    return contingency_stats(df, [feature], target).select("feature", "unique_values", "chi2", "p_value", "cramers_v")


def relationship_discrete_many(df: DataFrame, feature: str, target: str = "TARGET") -> DataFrame:
    """H16 (discrete, many values): distinct values, point-biserial on the
    codes with p, information value."""
    c = contingency_stats(df, [feature], target).select("unique_values", "information_value")
    p = point_biserial_coded(df, feature, target)
    return p.select("feature", "point_biserial_r", "point_biserial_p").withColumns({
        "unique_values": c.select("unique_values").scalar(),
        "information_value": c.select("information_value").scalar()})


def relationship_report(df: DataFrame, nominal=(), continuous=(), target: str = "TARGET") -> DataFrame:
    """One row per feature; nominal features share one contingency pass
    and continuous ones one moment pass (never a job per column)."""
    parts = []
    if nominal:
        parts.append(contingency_stats(df, list(nominal), target).select(
            "feature", F.lit("nominal").alias("kind"), "unique_values", "chi2", "p_value", "cramers_v",
            "information_value", "mutual_information", F.lit(None).cast("double").alias("point_biserial_r"),
            F.lit(None).cast("double").alias("point_biserial_p"), F.lit(None).cast("double").alias("anova_f"),
            F.lit(None).cast("double").alias("anova_p")))
    if continuous:
        parts.append(continuous_target_stats(df, list(continuous), target).select(
            "feature", F.lit("continuous").alias("kind"), F.lit(None).cast("long").alias("unique_values"),
            F.lit(None).cast("double").alias("chi2"), F.lit(None).cast("double").alias("p_value"),
            F.lit(None).cast("double").alias("cramers_v"), F.lit(None).cast("double").alias("information_value"),
            F.lit(None).cast("double").alias("mutual_information"), "point_biserial_r", "point_biserial_p",
            "anova_f", "anova_p"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out

