"""Outliers and data quality.

Fences and caps are learned in one pass of exact quantiles over all columns;
applying them is a narrow projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendlens.functions.exprs import AMOUNT_COLS, SOCIAL_COLS, WEEKDAYS, np_round, null_safe_clip
from lendlens.functions.quantiles import exact_quantiles
from lendlens.operators.base import JsonEstimator, JsonModel


def iqr_fences(df: DataFrame, cols, k: float = 1.5) -> dict[str, tuple[float, float]]:
    q = exact_quantiles(df, cols, [0.25, 0.75])
    out = {}
    for c in cols:
        q1, q3 = q[c][0.25], q[c][0.75]
        if q1 is None:
            continue
        out[c] = (q1 - k * (q3 - q1), q3 + k * (q3 - q1))
    return out


def iqr_outlier_summary(df: DataFrame, cols=None) -> DataFrame:
    """Per numeric column, values beyond the 1.5·IQR fences: count and
    percent of non-null values (2 dp), most outlying first. Pass 1 finds the
    quartiles of every column; pass 2 is one conditional-sum aggregate."""
    cols = cols or [c for c, t in df.dtypes if t in ("int", "bigint", "double", "float")]
    fences = iqr_fences(df, cols)
    aggs = []
    for i, c in enumerate(fences):
        lo, hi = fences[c]
        x = F.col(c)
        aggs += [F.sum(((x < lo) | (x > hi)).cast("long")).alias(f"o{i}"), F.count(x).alias(f"n{i}")]
    row = df.agg(*aggs)
    parts = [F.struct(F.lit(c).alias("column"), F.coalesce(F.col(f"o{i}"), F.lit(0)).cast("long").alias("outliers"),
                      np_round(F.try_divide(F.col(f"o{i}") * 100.0, F.col(f"n{i}")), 2).alias("outlier_percent"),
                      F.lit(fences[c][0]).cast("double").alias("lower"),
                      F.lit(fences[c][1]).cast("double").alias("upper"))
             for i, c in enumerate(fences)]
    return (row.select(F.explode(F.array(*parts)).alias("s")).select("s.*")
            .orderBy(F.desc("outlier_percent"), F.asc("column")))


class IqrCapModel(JsonModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        fences = self.fitted["fences"]
        return df.withColumns({c: null_safe_clip(c, lo, hi) for c, (lo, hi) in fences.items()
                               if c in df.columns})


class IqrCap(JsonEstimator):
    """Clip columns to their 1.5·IQR fences learned on training data;
    NULL stays NULL."""
    DEFAULTS = {"columns": [], "k": 1.5}
    model_class = IqrCapModel

    def _fit(self, df: DataFrame):
        o = self.opts
        f = iqr_fences(df, o["columns"], o["k"])
        return self._make_model({"fences": {c: list(v) for c, v in f.items()}})


class SocialCircleCapModel(JsonModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        caps = self.fitted["caps"]
        return df.withColumns({c: null_safe_clip(c, None, v) for c, v in caps.items()
                               if c in df.columns and v is not None})

    def capped_value_counts(self, df: DataFrame) -> DataFrame:
        """The verbose report: value counts per capped column after capping."""
        out = self.transform(df)
        cols = [c for c in self.fitted["caps"] if c in out.columns]
        long = out.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value"))
                                              for c in cols])).alias("s")).select("s.*")
        return long.where(F.col("value").isNotNull()).groupBy("column", "value").count()


class SocialCircleCap(JsonEstimator):
    """D3: upper cap at an interpolated quantile (default P99.99) learned on
    training data; absent columns are skipped."""
    DEFAULTS = {"columns": SOCIAL_COLS, "percentile": 0.9999, "verbose": False}
    model_class = SocialCircleCapModel

    def _fit(self, df: DataFrame):
        o = self.opts
        cols = [c for c in o["columns"] if c in df.columns]
        q = exact_quantiles(df, cols, [o["percentile"]])
        return self._make_model({"caps": {c: q[c][o["percentile"]] for c in cols}})


class AmountOutlierModel(JsonModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        caps = self.fitted["caps"]
        new = {}
        for c, v in caps.items():
            if c not in df.columns or v is None:
                continue
            new[f"{c}_outlier"] = F.coalesce((F.col(c) > F.lit(v)), F.lit(False)).cast("int")
            new[c] = null_safe_clip(c, None, v)
        return df.withColumns(new)


class AmountOutlier(JsonEstimator):
    """Cap amounts at their 99.995th percentile; ``<c>_outlier`` flags the
    values above the cap (computed before clipping). NULLs are ignored when
    fitting."""
    DEFAULTS = {"columns": AMOUNT_COLS, "percentile": 0.99995}
    model_class = AmountOutlierModel

    def _fit(self, df: DataFrame):
        o = self.opts
        cols = [c for c in o["columns"] if c in df.columns]
        q = exact_quantiles(df, cols, [o["percentile"]])
        return self._make_model({"caps": {c: q[c][o["percentile"]] for c in cols}})


# ---------------------------------------------------------------- D6
VALIDITY_AMOUNT_COLS = AMOUNT_COLS + ["HOUR_APPR_PROCESS_START"]
VALIDITY_CATEGORICAL = ["NAME_CONTRACT_TYPE", "NAME_TYPE_SUITE", "WEEKDAY_APPR_PROCESS_START"]


def _dti_over(t: float) -> Column:
    ann, inc = F.col("AMT_ANNUITY"), F.col("AMT_INCOME_TOTAL")
    # x/0 is ±inf in the reference's arithmetic: positive annuity over zero income counts.
    return F.coalesce(F.try_divide(ann, inc) > t, (inc == 0) & (ann > 0), F.lit(False))


def validity_checks(include_annuity_check: bool = True) -> list[tuple[str, Column]]:
    """(check name, predicate that marks a failing row)."""
    c = F.col
    checks = [("TARGET_Invalid_Values", F.coalesce(~c("TARGET").isin(0, 1), F.lit(True)))]
    for a in VALIDITY_AMOUNT_COLS:
        checks.append((f"{a}_Negative", F.coalesce(c(a) < 0, F.lit(False))))
    checks.append(("HOUR_APPR_PROCESS_START_Invalid",
                   F.coalesce(~c("HOUR_APPR_PROCESS_START").between(0, 23), F.lit(True))))
    for a in VALIDITY_CATEGORICAL:
        checks.append((f"{a}_Missing_Values", c(a).isNull()))
    checks.append(("WEEKDAY_APPR_PROCESS_START_Invalid_Labels",
                   c("WEEKDAY_APPR_PROCESS_START").isNotNull() & ~c("WEEKDAY_APPR_PROCESS_START").isin(*WEEKDAYS)))
    checks.append(("DTI_Above_50_Percent", _dti_over(0.5)))
    checks.append(("DTI_Above_100_Percent", _dti_over(1.0)))
    checks.append(("AMT_GOODS_PRICE_Missing_When_Credit_Exists",
                   F.coalesce(c("AMT_CREDIT") > 0, F.lit(False)) & c("AMT_GOODS_PRICE").isNull()))
    if include_annuity_check:
        checks.append(("AMT_ANNUITY_Greater_Than_AMT_CREDIT",
                       F.coalesce(c("AMT_ANNUITY") > c("AMT_CREDIT"), F.lit(False))))
    return checks


def validity_report(df: DataFrame, id_col: str = "ID", include_annuity_check: bool = True) -> DataFrame:
    """(check, count) — one aggregate of conditional sums, unpivoted."""
    checks = validity_checks(include_annuity_check)
    aggs = [(F.count(F.lit(1)) - F.count_distinct(id_col)).alias("c0")]
    aggs += [F.sum(p.cast("long")).alias(f"c{i + 1}") for i, (_, p) in enumerate(checks)]
    names = ["ID_Duplicates"] + [n for n, _ in checks]
    row = df.agg(*aggs)
    parts = [F.struct(F.lit(n).alias("check"), F.coalesce(F.col(f"c{i}"), F.lit(0)).cast("long").alias("count"))
             for i, n in enumerate(names)]
    return row.select(F.explode(F.array(*parts)).alias("s")).select("s.*")


def _validity_oracle() -> str:
    def cnt(cond):
        return f"SELECT CAST(sum(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT) AS n FROM applications"
    dti = ("(CASE WHEN AMT_INCOME_TOTAL = 0 THEN AMT_ANNUITY > 0 "
           "ELSE AMT_ANNUITY / AMT_INCOME_TOTAL > {t} END)")
    rows = [("ID_Duplicates", "SELECT count(*) - count(DISTINCT ID) AS n FROM applications"),
            ("TARGET_Invalid_Values", cnt("TARGET IS NULL OR TARGET NOT IN (0, 1)"))]
    rows += [(f"{a}_Negative", cnt(f"{a} < 0")) for a in VALIDITY_AMOUNT_COLS]
    rows.append(("HOUR_APPR_PROCESS_START_Invalid",
                 cnt("HOUR_APPR_PROCESS_START IS NULL OR NOT (HOUR_APPR_PROCESS_START BETWEEN 0 AND 23)")))
    rows += [(f"{a}_Missing_Values", cnt(f"{a} IS NULL")) for a in VALIDITY_CATEGORICAL]
    wd = ", ".join(f"'{w}'" for w in WEEKDAYS)
    rows.append(("WEEKDAY_APPR_PROCESS_START_Invalid_Labels",
                 cnt(f"WEEKDAY_APPR_PROCESS_START IS NOT NULL AND WEEKDAY_APPR_PROCESS_START NOT IN ({wd})")))
    rows.append(("DTI_Above_50_Percent", cnt(dti.format(t=0.5))))
    rows.append(("DTI_Above_100_Percent", cnt(dti.format(t=1.0))))
    rows.append(("AMT_GOODS_PRICE_Missing_When_Credit_Exists", cnt("AMT_CREDIT > 0 AND AMT_GOODS_PRICE IS NULL")))
    rows.append(("AMT_ANNUITY_Greater_Than_AMT_CREDIT", cnt("AMT_ANNUITY > AMT_CREDIT")))
    return " UNION ALL ".join(f"SELECT '{n}' AS \"check\", CAST(coalesce(n, 0) AS BIGINT) AS count FROM ({q}) x"
                              for n, q in rows)


VALIDITY_ORACLE_BODY = _validity_oracle()
