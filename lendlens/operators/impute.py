"""Missing-value handling.

Fits are one or two aggregate jobs: exact quantiles (bounded histogram
selection) and modes (``groupBy(column, value).count`` on an unpivoted
frame, combined map-side, then a ``min`` over ``(-count, value)`` so the
smallest value wins ties). Transforms are single projections.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlens.functions.exprs import BUREAU_COLS, DAYS_EMPLOYED_SENTINEL
from lendlens.functions.quantiles import exact_quantiles
from lendlens.operators.base import JsonEstimator, JsonModel, JsonTransformer


def modes(df: DataFrame, cols) -> dict:
    """Most frequent non-null value per column, smallest value on ties.

    Columns are unpivoted per type family (text / numeric) so each family is
    one ``groupBy``; a hot value costs one row per partition after the
    map-side combine.
    """
    types = dict(df.dtypes)
    out = {}
    for family in ("string", "numeric"):
        fam = [c for c in cols if (types[c] == "string") == (family == "string")]
        if not fam:
            continue
        vt = "string" if family == "string" else "double"
        long = df.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(c).cast(vt).alias("value")) for c in fam
        ])).alias("s")).select("s.*").where(F.col("value").isNotNull())
        rows = (long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
                .groupBy("column").agg(F.min(F.struct((-F.col("n")).alias("neg"), F.col("value"))).alias("m"))
                .collect())
        for r in rows:
            out[r["column"]] = r["m"]["value"]
    for c in cols:
        out.setdefault(c, None)
    return out


class BasicImputerModel(JsonModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        s = self.fitted
        c = F.col
        new = {}
        if "CODE_GENDER" in df.columns:
            new["CODE_GENDER"] = F.when(c("CODE_GENDER") == "XNA", F.lit(s["gender_mode"])).otherwise(c("CODE_GENDER"))
        new["NAME_TYPE_SUITE"] = F.coalesce(c("NAME_TYPE_SUITE"), F.lit("Unknown"))
        new["GOODS_PRICE_WAS_MISSING"] = c("AMT_GOODS_PRICE").isNull().cast("double")
        new["AMT_GOODS_PRICE"] = F.coalesce(c("AMT_GOODS_PRICE"), c("AMT_CREDIT").cast("double"))
        new["AMT_ANNUITY_WAS_MISSING"] = c("AMT_ANNUITY").isNull().cast("double")
        new["AMT_ANNUITY"] = F.coalesce(c("AMT_ANNUITY"), F.lit(s["annuity_median"]).cast("double"))
        new["CNT_FAM_MEMBERS"] = F.coalesce(c("CNT_FAM_MEMBERS"), F.lit(s["fam_members_median"]).cast("double"))
        new["DAYS_LAST_PHONE_CHANGE"] = F.coalesce(c("DAYS_LAST_PHONE_CHANGE"),
                                                   F.lit(s["phone_change_median"]).cast("double"))
        if s.get("org_type_mode") is not None:
            new["ORGANIZATION_TYPE"] = F.coalesce(c("ORGANIZATION_TYPE"), F.lit(s["org_type_mode"]))
        return df.withColumns(new)


class BasicImputer(JsonEstimator):
    """Medians of annuity, family size and phone-change days; modes of
    organisation and gender (``XNA`` counts toward the mode). Flags for the
    missing goods price and annuity are computed before filling."""
    model_class = BasicImputerModel

    def _fit(self, df: DataFrame):
        q = exact_quantiles(df, ["AMT_ANNUITY", "CNT_FAM_MEMBERS", "DAYS_LAST_PHONE_CHANGE"], [0.5])
        mcols = [c for c in ("ORGANIZATION_TYPE", "CODE_GENDER") if c in df.columns]
        m = modes(df, mcols)
        return self._make_model({
            "annuity_median": q["AMT_ANNUITY"][0.5], "fam_members_median": q["CNT_FAM_MEMBERS"][0.5],
            "phone_change_median": q["DAYS_LAST_PHONE_CHANGE"][0.5],
            "org_type_mode": m.get("ORGANIZATION_TYPE"), "gender_mode": m.get("CODE_GENDER")})


class CarAgeImputerModel(JsonModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        med = self.fitted["median_car_age"]
        own, age = F.col("FLAG_OWN_CAR"), F.col("OWN_CAR_AGE")
        return df.withColumn("OWN_CAR_AGE", F.when(age.isNull() & (own == "N"), F.lit(0.0))
                             .when(age.isNull() & (own == "Y"), F.lit(med).cast("double"))
                             .otherwise(age))


class CarAgeImputer(JsonEstimator):
    """Missing car age → 0 for non-owners, owners' median for owners."""
    model_class = CarAgeImputerModel

    def _fit(self, df: DataFrame):
        q = exact_quantiles(df, {"a": F.when(F.col("FLAG_OWN_CAR") == "Y", F.col("OWN_CAR_AGE"))}, [0.5])
        return self._make_model({"median_car_age": q["a"][0.5]})


class EmploymentImputer(JsonTransformer):
    """The 365243 sentinel and NULL become 0; text that is not a number
    becomes NULL (after the fill). The result is double."""
    DEFAULTS = {"column": "DAYS_EMPLOYED"}

    def _transform(self, df: DataFrame) -> DataFrame:
        c = self.opts["column"]
        x = F.col(c)
        if dict(df.dtypes)[c] == "string":
            num = F.try_cast(F.trim(x), "double")
            filled = F.when(x.isNull(), F.lit(0.0)).otherwise(num)
            val = F.when(num == DAYS_EMPLOYED_SENTINEL, F.lit(0.0)).otherwise(filled)
        else:
            val = F.when(x == DAYS_EMPLOYED_SENTINEL, F.lit(0.0)).otherwise(F.coalesce(x.cast("double"), F.lit(0.0)))
        return df.withColumn(c, val)


class OccupationImputer(JsonTransformer):
    """C4: blank/NULL occupation → ``Unemployed`` when the income type names a
    pensioner or unemployed person and days employed is NULL or <= 0, else
    ``Laborers``."""

    def _transform(self, df: DataFrame) -> DataFrame:
        occ, days, inc = F.col("OCCUPATION_TYPE"), F.col("DAYS_EMPLOYED"), F.col("NAME_INCOME_TYPE")
        missing = occ.isNull() | (occ == "")
        no_emp = days.isNull() | (days <= 0)
        unemp = F.coalesce(inc.rlike("(?i)Pensioner|Unemployed"), F.lit(False))
        return df.withColumn("OCCUPATION_TYPE", F.when(missing & unemp & no_emp, F.lit("Unemployed"))
                             .when(missing, F.lit("Laborers")).otherwise(occ))


class SimpleImputerModel(JsonModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        fills = self.fitted["fills"]
        types = dict(df.dtypes)
        new = {}
        for c, v in fills.items():
            if v is None:
                continue
            t = types[c]
            lit = F.lit(v).cast(t if t == "string" else "double")
            new[c] = F.coalesce(F.col(c).cast("double") if t != "string" else F.col(c), lit)
        return df.withColumns(new)


class SimpleImputer(JsonEstimator):
    """Per column fill with the training mean, exact median, most
    frequent value (smallest on ties) or a constant. Numeric results are
    double, as the reference's array round-trip gives."""
    DEFAULTS = {"columns": [], "strategy": "median", "fill_value": None}
    model_class = SimpleImputerModel

    def _fit(self, df: DataFrame):
        o = self.opts
        cols, strat = o["columns"], o["strategy"]
        if strat == "constant":
            fills = {c: o["fill_value"] for c in cols}
        elif strat == "median":
            q = exact_quantiles(df, cols, [0.5])
            fills = {c: q[c][0.5] for c in cols}
        elif strat == "mean":
            row = df.agg(*[F.avg(c).alias(c) for c in cols]).first()
            fills = {c: row[c] for c in cols}
        elif strat == "most_frequent":
            fills = modes(df, cols)
        else:
            raise ValueError(f"unknown strategy {strat!r}")
        return self._make_model({"fills": fills})


def bureau_flag_and_fill(df: DataFrame, cols=BUREAU_COLS) -> DataFrame:
    """``HAS_CREDIT_BUREAU_DATA`` = hour count present; NULL counts → 0."""
    new = {"HAS_CREDIT_BUREAU_DATA": F.col(cols[0]).isNotNull().cast("int")}
    new.update({c: F.coalesce(F.col(c), F.lit(0.0)) for c in cols})
    return df.withColumns(new)
