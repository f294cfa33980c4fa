"""Column-expression builders shared by the operators.

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so
it stays inside whole-stage codegen; nothing runs Python per row.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# ---------------------------------------------------------------------------
WEEKDAYS = ["MONDAY", "TUESDAY", "WEDNESDAY", "THURSDAY", "FRIDAY", "SATURDAY", "SUNDAY"]
HOUR_BINS = ["Late_Night", "Morning", "Afternoon", "Evening"]  # clock order
BUREAU_COLS = ["AMT_REQ_CREDIT_BUREAU_HOUR", "AMT_REQ_CREDIT_BUREAU_DAY",
               "AMT_REQ_CREDIT_BUREAU_WEEK", "AMT_REQ_CREDIT_BUREAU_MON",
               "AMT_REQ_CREDIT_BUREAU_QRT", "AMT_REQ_CREDIT_BUREAU_YEAR"]
BUREAU_ORDERS = {
    "HOUR": ["ZERO", "HAS_ENQUIRY"],
    "DAY": ["ZERO", "HAS_ENQUIRY"],
    "WEEK": ["ZERO", "ONE", "MULTIPLE"],
    "MON": ["ZERO", "LOW", "HIGH"],
    "QRT": ["ZERO", "LOW", "HIGH"],
    "YEAR": ["ZERO", "LOW", "MEDIUM", "HIGH"],
}
SOCIAL_COLS = ["OBS_30_CNT_SOCIAL_CIRCLE", "DEF_30_CNT_SOCIAL_CIRCLE",
               "OBS_60_CNT_SOCIAL_CIRCLE", "DEF_60_CNT_SOCIAL_CIRCLE"]
EXT_COLS = ["EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"]
DOCUMENT_COLS = [f"FLAG_DOCUMENT_{i}" for i in range(2, 22)]
AMOUNT_COLS = ["AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY", "AMT_GOODS_PRICE"]
EDUCATION_ORDER = ["Lower secondary", "Secondary / secondary special", "Incomplete higher",
                   "Higher education", "Academic degree"]
RARE_SUITES = ["Children", "Group of people", "Other_A", "Other_B", "Spouse, partner"]
DAYS_EMPLOYED_SENTINEL = 365243
NUMERIC_TYPES = ("int", "bigint", "smallint", "tinyint", "double", "float")
# ---------------------------------------------------------------------------


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hour_bin(c) -> Column:
    """Hour → period. Negatives fall to Morning and NULL to Evening, as the
    row-wise rule does (``0 <= x < 6`` fails, then ``x < 12`` holds / all
    comparisons with a missing value fail)."""
    x = col(c)
    return (F.when((x >= 0) & (x < 6), F.lit("Late_Night"))
            .when(x < 12, F.lit("Morning"))
            .when(x < 18, F.lit("Afternoon"))
            .otherwise(F.lit("Evening")))


def rank_in(c, values: list) -> Column:
    """0-based position of ``c`` in ``values``; NULL when absent."""
    x = col(c)
    expr = F.lit(None).cast("int")
    for i in reversed(range(len(values))):
        expr = F.when(x == F.lit(values[i]), F.lit(i)).otherwise(expr)
    return expr


def weekday_num(c) -> Column:
    return rank_in(c, WEEKDAYS)


def cyclical(num: Column, period: int) -> tuple[Column, Column]:
    angle = F.lit(2 * math.pi) * num / F.lit(period)
    return F.sin(angle), F.cos(angle)


def bureau_bin(c: str) -> Column:
    """E5: count → band, by the window named in the column."""
    x = F.col(c)
    if c.endswith("_HOUR") or c.endswith("_DAY"):
        return F.when(x > 0, "HAS_ENQUIRY").otherwise("ZERO")
    if c.endswith("_WEEK"):
        return F.when(x > 1, "MULTIPLE").when(x == 1, "ONE").otherwise("ZERO")
    if c.endswith("_MON") or c.endswith("_QRT"):
        return F.when(x > 2, "HIGH").when(x.between(1, 2), "LOW").otherwise("ZERO")
    return (F.when(x > 5, "HIGH").when(x.between(3, 5), "MEDIUM")
            .when(x.between(1, 2), "LOW").otherwise("ZERO"))


def bureau_order(c: str) -> list[str]:
    """Category order for a bureau column, chosen by the window in its name."""
    for key in ("HOUR", "DAY", "WEEK", "MON", "QRT", "YEAR"):
        if key in c:
            return BUREAU_ORDERS[key]
    raise KeyError(c)


def row_null_count(cols: list[str]) -> Column:
    return reduce(lambda a, b: a + b, [F.col(c).isNull().cast("int") for c in cols])


def any_null(cols: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])


def all_null(cols: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNull() for c in cols])


def null_safe_clip(c, lo=None, hi=None) -> Column:
    """Clip keeping NULL as NULL (``least``/``greatest`` would skip it)."""
    x = col(c)
    y = x
    if lo is not None:
        y = F.greatest(y, F.lit(float(lo)))
    if hi is not None:
        y = F.least(y, F.lit(float(hi)))
    return F.when(x.isNull(), F.lit(None).cast("double")).otherwise(y)


def row_mean(cols: list[str]) -> Column:
    """Mean over the non-null values of a row; NULL when all are NULL."""
    s = reduce(lambda a, b: a + b, [F.coalesce(F.col(c), F.lit(0.0)) for c in cols])
    n = row_null_count(cols)
    present = F.lit(len(cols)) - n
    return F.when(present > 0, s / present)


def numeric_columns(df, exclude=()) -> list[str]:
    return [c for c, t in df.dtypes if t in NUMERIC_TYPES and c not in exclude]


def string_columns(df, exclude=()) -> list[str]:
    return [c for c, t in df.dtypes if t == "string" and c not in exclude]


def round_double(c, digits: int = 6) -> Column:
    return F.round(col(c).cast("double"), digits)


def np_round(c, digits: int) -> Column:
    """Round half to even on ``x·10^d`` as NumPy/pandas ``round`` does (the
    reference's rounding of reported percentages)."""
    m = F.lit(float(10 ** digits))
    return F.rint(col(c).cast("double") * m) / m


def half_away_round(c, digits: int) -> Column:
    """Round half away from zero on ``x·10^d`` (C ``round``), which is also how
    the SQL oracle rounds doubles; used to present results at fixed precision."""
    m = F.lit(float(10 ** digits))
    v = col(c).cast("double") * m
    a = F.abs(v)
    fl = F.floor(a).cast("double")
    r = (F.when(a >= F.lit(float(2 ** 52)), v)
         .when(a - fl == 0.5, F.signum(v) * (fl + 1.0))
         .otherwise(F.rint(v)))
    return r / m


def safe_corr(a, b) -> Column:
    """Pearson correlation over rows where both are present (as ``corr``),
    NULL instead of an ANSI division error when either side is constant."""
    x, y = col(a).cast("double"), col(b).cast("double")
    both = x.isNotNull() & y.isNotNull()
    xs, ys = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_samp(xs, ys), F.stddev_samp(xs) * F.stddev_samp(ys))
