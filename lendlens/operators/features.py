"""Feature engineering as column expressions.

All transforms are narrow projections (one ``Project`` that Catalyst fuses
with its neighbours); the only fitted stages learn column lists, moments or
a principal axis in a single aggregate.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlens.functions.exprs import (BUREAU_COLS, DOCUMENT_COLS, EXT_COLS, NUMERIC_TYPES, RARE_SUITES,
                                      bureau_bin, bureau_order, cyclical, hour_bin, rank_in, row_mean,
                                      weekday_num)
from lendlens.operators.base import JsonEstimator, JsonModel, JsonTransformer


class WeekdayEncoder(JsonTransformer):
    """Weekday name → 0..6 (Monday 0) → ``WEEKDAY_SIN``/``WEEKDAY_COS``;
    the source is dropped; an unknown name gives NULL."""
    DEFAULTS = {"feature": "WEEKDAY_APPR_PROCESS_START"}

    def _transform(self, df: DataFrame) -> DataFrame:
        f = self.opts["feature"]
        s, c = cyclical(weekday_num(f).cast("double"), 7)
        return df.withColumns({"WEEKDAY_SIN": s, "WEEKDAY_COS": c}).drop(f)


class HourBinner(JsonTransformer):
    """Hour → Late_Night / Morning / Afternoon / Evening (raw hour kept)."""
    DEFAULTS = {"hour_col": "HOUR_APPR_PROCESS_START", "bin_col": "HOUR_APPR_PROCESS_BIN"}

    def _transform(self, df: DataFrame) -> DataFrame:
        o = self.opts
        return df.withColumn(o["bin_col"], hour_bin(o["hour_col"]))


class AgeFeature(JsonTransformer):
    """``AGE`` = whole years of |DAYS_BIRTH|, source dropped; optionally
    ``YEARS_EMPLOYED`` from |DAYS_EMPLOYED| the same way (documented feature)."""
    DEFAULTS = {"years_employed": False}

    def _transform(self, df: DataFrame) -> DataFrame:
        out = df.withColumn("AGE", (F.abs(F.col("DAYS_BIRTH")) / 365.25).cast("long")).drop("DAYS_BIRTH")
        if self.opts["years_employed"] and "DAYS_EMPLOYED" in df.columns:
            out = out.withColumn("YEARS_EMPLOYED", (F.abs(F.col("DAYS_EMPLOYED")) / 365.25).cast("long"))
        return out


class DaysAbsModel(JsonModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: F.abs(F.col(c)) for c in self.fitted["columns"] if c in df.columns})


class DaysAbs(JsonEstimator):
    """Absolute value of the columns whose name starts with ``prefix``
    (found at fit time)."""
    DEFAULTS = {"prefix": "DAYS_"}
    model_class = DaysAbsModel

    def _fit(self, df: DataFrame):
        return self._make_model({"columns": [c for c in df.columns if c.startswith(self.opts["prefix"])]})


def bureau_bins(df: DataFrame, cols=BUREAU_COLS, drop_source: bool = False) -> DataFrame:
    """E5: each bureau count → ``<col>_CAT`` band."""
    out = df.withColumns({f"{c}_CAT": bureau_bin(c) for c in cols})
    return out.drop(*cols) if drop_source else out


def bureau_ordinal(df: DataFrame, cols=BUREAU_COLS) -> DataFrame:
    """``<col>_CAT`` band → ``<col>_ORD`` position in its fixed order
    (unknown → -1); the ``_CAT`` columns are dropped."""
    new = {}
    for c in cols:
        cat = f"{c}_CAT"
        new[f"{c}_ORD"] = F.coalesce(rank_in(cat, bureau_order(c)), F.lit(-1)).cast("int")
    return df.withColumns(new).drop(*[f"{c}_CAT" for c in cols])


class BureauProcessor(JsonTransformer):
    """C7 + E5 + E6 fused: presence flag, NULL → 0, bands, ordinal codes; the
    counts and bands are dropped, leaving ``HAS_CREDIT_BUREAU_DATA`` and the
    six ``_ORD`` columns."""

    def _transform(self, df: DataFrame) -> DataFrame:
        cols = BUREAU_COLS
        out = df.withColumn("HAS_CREDIT_BUREAU_DATA", F.col(cols[0]).isNotNull().cast("int"))
        out = out.withColumns({c: F.coalesce(F.col(c), F.lit(0.0)) for c in cols})
        out = bureau_bins(out, cols, drop_source=True)
        return bureau_ordinal(out, cols)


class DocumentTotal(JsonTransformer):
    """``TOTAL_DOC_SUBMITTED`` = row sum of the document flags (NULLs
    skipped); the flags are dropped."""
    DEFAULTS = {"columns": DOCUMENT_COLS}

    def _transform(self, df: DataFrame) -> DataFrame:
        cols = [c for c in self.opts["columns"] if c in df.columns]
        total = reduce(lambda a, b: a + b, [F.coalesce(F.col(c), F.lit(0)).cast("long") for c in cols], F.lit(0).cast("long"))
        return df.withColumn("TOTAL_DOC_SUBMITTED", total).drop(*cols)


class ExtMean(JsonTransformer):
    """``ext_mean`` = mean of the non-null scores (NULL if none); the
    scores are dropped."""
    DEFAULTS = {"columns": EXT_COLS, "output": "ext_mean"}

    def _transform(self, df: DataFrame) -> DataFrame:
        o = self.opts
        return df.withColumn(o["output"], row_mean(o["columns"])).drop(*o["columns"])


def ext_weighted(df: DataFrame, weights=(0.2, 0.5, 0.3), cols=EXT_COLS,
                 output: str = "EXT_SOURCE_WEIGHTED") -> DataFrame:
    """Weighted sum of the three scores; NULL if any is NULL."""
    expr = reduce(lambda a, b: a + b, [F.col(c) * F.lit(float(w)) for c, w in zip(cols, weights)])
    return df.withColumn(output, expr)


class PcaOneModel(JsonModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        s = self.fitted
        terms = [((F.col(c) - F.lit(m)) / F.lit(sd)) * F.lit(w)
                 for c, m, sd, w in zip(s["columns"], s["means"], s["stds"], s["loading"])]
        return df.withColumn(self.opts["output"], reduce(lambda a, b: a + b, terms))


class PcaOne(JsonEstimator):
    """Standardise (population std) and project on the first principal
    component. One aggregate gives the moments and the covariance matrix
    (``covar_pop`` per pair); the p×p eigenproblem is solved on the driver.
    The sign is fixed so the largest absolute loading is positive.
    ``explained_variance_ratio`` is kept in the state."""
    DEFAULTS = {"columns": EXT_COLS, "output": "EXT_SOURCE_PCA1"}
    model_class = PcaOneModel

    def _fit(self, df: DataFrame):
        cols = self.opts["columns"]
        p = len(cols)
        aggs = [F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)]
        aggs += [F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(cols)]
        aggs += [F.covar_pop(a, b).alias(f"c{i}_{j}") for i, a in enumerate(cols) for j, b in enumerate(cols) if j >= i]
        row = df.agg(*aggs).first()
        means = [row[f"m{i}"] for i in range(p)]
        stds = [row[f"s{i}"] if row[f"s{i}"] else 1.0 for i in range(p)]
        corr = np.zeros((p, p))
        for i in range(p):
            for j in range(i, p):
                v = row[f"c{i}_{j}"] / (stds[i] * stds[j])
                corr[i, j] = corr[j, i] = v
        vals, vecs = np.linalg.eigh(corr)
        k = int(np.argmax(vals))
        w = vecs[:, k]
        if w[np.argmax(np.abs(w))] < 0:
            w = -w
        ratio = float(vals[k] / vals.sum())
        return self._make_model({"columns": cols, "means": means, "stds": stds, "loading": w.tolist(),
                                 "explained_variance_ratio": ratio})


class Log1p(JsonTransformer):
    """``<col><suffix>`` = log(1 + x) for present columns (NULL where
    x <= -1); originals dropped by default."""
    DEFAULTS = {"columns": ["AMT_CREDIT", "AMT_INCOME_TOTAL"], "suffix": "_LOG", "drop_original": True}

    def _transform(self, df: DataFrame) -> DataFrame:
        o = self.opts
        cols = [c for c in o["columns"] if c in df.columns]
        x = F.col
        out = df.withColumns({f"{c}{o['suffix']}": F.when(x(c) > -1, F.log1p(x(c))) for c in cols})
        return out.drop(*cols) if o["drop_original"] else out


class StandardScaleModel(JsonModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        s = self.fitted
        return df.withColumns({c: (F.col(c).cast("double") - F.lit(m)) / F.lit(sd)
                               for c, m, sd in zip(s["columns"], s["means"], s["scales"])})


class StandardScale(JsonEstimator):
    """Every numeric column except the excluded ones (TARGET always):
    mean 0, population std 1; zero-variance columns are only centred. One
    aggregate of ``avg`` and ``stddev_pop``."""
    DEFAULTS = {"exclude_cols": []}
    model_class = StandardScaleModel

    def _fit(self, df: DataFrame):
        excl = set(self.opts["exclude_cols"]) | {"TARGET"}
        cols = [c for c, t in df.dtypes if t in NUMERIC_TYPES and c not in excl]
        if not cols:
            return self._make_model({"columns": [], "means": [], "scales": []})
        row = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
                     *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(cols)]).first()
        means = [row[f"m{i}"] for i in range(len(cols))]
        scales = [row[f"s{i}"] if row[f"s{i}"] else 1.0 for i in range(len(cols))]
        return self._make_model({"columns": cols, "means": means, "scales": scales})


def ratios(df: DataFrame) -> DataFrame:
    """Debt-to-income and the documented credit/income and
    annuity/income ratios (NULL on a zero divisor)."""
    c = F.col
    return df.withColumns({
        "DTI_RATIO": F.try_divide(c("AMT_ANNUITY"), c("AMT_INCOME_TOTAL")),
        "CREDIT_INCOME_RATIO": F.try_divide(c("AMT_CREDIT"), c("AMT_INCOME_TOTAL")),
        "ANNUITY_INCOME_RATIO": F.try_divide(c("AMT_ANNUITY"), c("AMT_INCOME_TOTAL")),
    })


def rare_group(df: DataFrame, col: str = "NAME_TYPE_SUITE", categories=RARE_SUITES,
               label: str = "RARE_SUITE") -> DataFrame:
    """Listed categories and NULL → one rare label."""
    x = F.col(col)
    return df.withColumn(col, F.when(x.isNull() | x.isin(*categories), F.lit(label)).otherwise(x))


def suite_and_contract_encode(df: DataFrame):
    """E14 on the suite, then one-hot (drop first) on contract type and
    suite. Returns ``(encoded frame, fitted encoder)``."""
    from lendlens.operators.encode import FlexibleEncoder
    grouped = rare_group(df)
    enc = FlexibleEncoder(onehot_encode_cols=["NAME_CONTRACT_TYPE", "NAME_TYPE_SUITE"], onehot_drop="first")
    model = enc.fit(grouped)
    return model.transform(grouped), model


def hour_bin_col(df: DataFrame, hour_col="HOUR_APPR_PROCESS_START") -> DataFrame:
    return df.withColumn("HOUR_APPR_PROCESS_BIN", hour_bin(hour_col))

