"""Registered queries: imputers, caps, feature expressions and encoders.

Each fitted operator is fitted on the whole ``applications`` view and
applied to it; the projection keeps ``ID`` plus the touched columns.
"""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from lendlens.functions.exprs import (AMOUNT_COLS, BUREAU_COLS, DOCUMENT_COLS, EDUCATION_ORDER, EXT_COLS,
                                      RARE_SUITES, SOCIAL_COLS, WEEKDAYS, bureau_order)
from lendlens.operators import encode, features, impute, quality
from lendlens.plans.catalog import apps, oracle, r, register


def _mode_cte(name: str, col: str) -> str:
    return (f", {name} AS (SELECT {col} AS m FROM applications WHERE {col} IS NOT NULL GROUP BY {col} "
            f"ORDER BY count(*) DESC, {col} ASC LIMIT 1)")


# ----------------------------------------------------------------- C1–C7
_C1_COLS = ["ID", "CODE_GENDER", "NAME_TYPE_SUITE", "GOODS_PRICE_WAS_MISSING", "AMT_GOODS_PRICE",
            "AMT_ANNUITY_WAS_MISSING", "AMT_ANNUITY", "CNT_FAM_MEMBERS", "DAYS_LAST_PHONE_CHANGE", "ORGANIZATION_TYPE"]


@register("c1_basic_imputer", oracle(
    ", med AS (SELECT quantile_cont(AMT_ANNUITY, 0.5) AS ann, quantile_cont(CNT_FAM_MEMBERS, 0.5) AS fam, "
    "quantile_cont(DAYS_LAST_PHONE_CHANGE, 0.5) AS ph FROM applications)"
    + _mode_cte("org", "ORGANIZATION_TYPE") + _mode_cte("gen", "CODE_GENDER") + """
SELECT ID, CASE WHEN CODE_GENDER = 'XNA' THEN gen.m ELSE CODE_GENDER END AS CODE_GENDER,
       coalesce(NAME_TYPE_SUITE, 'Unknown') AS NAME_TYPE_SUITE,
       CAST(AMT_GOODS_PRICE IS NULL AS DOUBLE) AS GOODS_PRICE_WAS_MISSING,
       coalesce(AMT_GOODS_PRICE, CAST(AMT_CREDIT AS DOUBLE)) AS AMT_GOODS_PRICE,
       CAST(AMT_ANNUITY IS NULL AS DOUBLE) AS AMT_ANNUITY_WAS_MISSING, coalesce(AMT_ANNUITY, med.ann) AS AMT_ANNUITY,
       coalesce(CNT_FAM_MEMBERS, med.fam) AS CNT_FAM_MEMBERS, coalesce(DAYS_LAST_PHONE_CHANGE, med.ph) AS DAYS_LAST_PHONE_CHANGE,
       coalesce(ORGANIZATION_TYPE, org.m) AS ORGANIZATION_TYPE
FROM applications, med, org, gen"""), round_doubles=False)
def c1_basic_imputer(spark, sf_dir):
    """medians/modes fitted on the table, then filled with flags."""
    df = apps(spark, sf_dir)
    return impute.BasicImputer().fit(df).transform(df).select(*_C1_COLS)


@register("c2_car_age_imputer", oracle("""
, med AS (SELECT quantile_cont(OWN_CAR_AGE, 0.5) AS m FROM applications WHERE FLAG_OWN_CAR = 'Y')
SELECT ID, FLAG_OWN_CAR, CASE WHEN OWN_CAR_AGE IS NULL AND FLAG_OWN_CAR = 'N' THEN 0.0
                             WHEN OWN_CAR_AGE IS NULL AND FLAG_OWN_CAR = 'Y' THEN med.m ELSE OWN_CAR_AGE END AS OWN_CAR_AGE
FROM applications, med"""), round_doubles=False)
def c2_car_age_imputer(spark, sf_dir):
    """Car age filled by ownership (owners' median)."""
    df = apps(spark, sf_dir)
    return impute.CarAgeImputer().fit(df).transform(df).select("ID", "FLAG_OWN_CAR", "OWN_CAR_AGE")


_C3_SQL = "CASE WHEN DAYS_EMPLOYED = 365243 THEN 0.0 ELSE coalesce(CAST(DAYS_EMPLOYED AS DOUBLE), 0.0) END"


@register("c3_employment_imputer", oracle(f"SELECT ID, {_C3_SQL} AS DAYS_EMPLOYED FROM applications"),
          round_doubles=False)
def c3_employment_imputer(spark, sf_dir):
    """Employment sentinel and NULL → 0 (double)."""
    return impute.EmploymentImputer().transform(apps(spark, sf_dir)).select("ID", "DAYS_EMPLOYED")


@register("c4_occupation_imputer", oracle(f"""
SELECT ID, CASE WHEN (OCCUPATION_TYPE IS NULL OR OCCUPATION_TYPE = '')
                 AND coalesce(regexp_matches(NAME_INCOME_TYPE, '(?i)Pensioner|Unemployed'), FALSE)
                 AND ({_C3_SQL}) <= 0 THEN 'Unemployed'
            WHEN OCCUPATION_TYPE IS NULL OR OCCUPATION_TYPE = '' THEN 'Laborers' ELSE OCCUPATION_TYPE END AS OCCUPATION_TYPE
FROM applications"""))
def c4_occupation_imputer(spark, sf_dir):
    """C4: occupation filled from income type, after the employment fix."""
    df = impute.EmploymentImputer().transform(apps(spark, sf_dir))
    return impute.OccupationImputer().transform(df).select("ID", "OCCUPATION_TYPE")


@register("c5_simple_imputer_median", oracle(
    ", med AS (SELECT " + ", ".join(f"quantile_cont({c}, 0.5) AS m{i}" for i, c in enumerate(EXT_COLS)) +
    " FROM applications) SELECT ID, " + ", ".join(f"coalesce({c}, med.m{i}) AS {c}" for i, c in enumerate(EXT_COLS)) +
    " FROM applications, med"), round_doubles=False)
def c5_simple_imputer_median(spark, sf_dir):
    """Median fill of the external scores."""
    df = apps(spark, sf_dir)
    m = impute.SimpleImputer(columns=EXT_COLS, strategy="median").fit(df)
    return m.transform(df).select("ID", *EXT_COLS)


@register("c5_simple_imputer_mean", oracle(
    ", mu AS (SELECT " + ", ".join(f"avg({c}) AS m{i}" for i, c in enumerate(SOCIAL_COLS)) +
    " FROM applications) SELECT ID, " + ", ".join(f"{r(f'coalesce({c}, mu.m{i})')} AS {c}"
                                                  for i, c in enumerate(SOCIAL_COLS)) +
    " FROM applications, mu"))
def c5_simple_imputer_mean(spark, sf_dir):
    """Mean fill of the social-circle counts."""
    df = apps(spark, sf_dir)
    return impute.SimpleImputer(columns=SOCIAL_COLS, strategy="mean").fit(df).transform(df).select("ID", *SOCIAL_COLS)


@register("c5_simple_imputer_most_frequent", oracle(
    _mode_cte("mo", "OCCUPATION_TYPE") + _mode_cte("mf", "CNT_FAM_MEMBERS") + """
SELECT ID, coalesce(OCCUPATION_TYPE, mo.m) AS OCCUPATION_TYPE, coalesce(CNT_FAM_MEMBERS, mf.m) AS CNT_FAM_MEMBERS
FROM applications, mo, mf"""), round_doubles=False)
def c5_simple_imputer_most_frequent(spark, sf_dir):
    """Most-frequent fill (smallest value on ties), text and numeric."""
    df = apps(spark, sf_dir)
    cols = ["OCCUPATION_TYPE", "CNT_FAM_MEMBERS"]
    return impute.SimpleImputer(columns=cols, strategy="most_frequent").fit(df).transform(df).select("ID", *cols)


@register("c5_simple_imputer_constant", oracle(
    "SELECT ID, coalesce(OWN_CAR_AGE, -1.0) AS OWN_CAR_AGE, coalesce(AMT_GOODS_PRICE, -1.0) AS AMT_GOODS_PRICE "
    "FROM applications"), round_doubles=False)
def c5_simple_imputer_constant(spark, sf_dir):
    """Constant fill."""
    df = apps(spark, sf_dir)
    cols = ["OWN_CAR_AGE", "AMT_GOODS_PRICE"]
    return (impute.SimpleImputer(columns=cols, strategy="constant", fill_value=-1.0).fit(df).transform(df)
            .select("ID", *cols))


@register("c7_bureau_flag_and_fill", oracle(
    "SELECT ID, CAST(AMT_REQ_CREDIT_BUREAU_HOUR IS NOT NULL AS INTEGER) AS HAS_CREDIT_BUREAU_DATA, " +
    ", ".join(f"coalesce({c}, 0.0) AS {c}" for c in BUREAU_COLS) + " FROM applications"), round_doubles=False)
def c7_bureau_flag_and_fill(spark, sf_dir):
    """Bureau presence flag and zero fill."""
    return impute.bureau_flag_and_fill(apps(spark, sf_dir)).select("ID", "HAS_CREDIT_BUREAU_DATA", *BUREAU_COLS)


# ----------------------------------------------------------------- D2–D4
def _fence_cte(cols) -> str:
    return ", f AS (SELECT " + ", ".join(
        f"quantile_cont({c}, 0.25) - 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS lo{i}, "
        f"quantile_cont({c}, 0.75) + 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS hi{i}"
        for i, c in enumerate(cols)) + " FROM applications)"


_D2_COLS = ["AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY"]


@register("d2_iqr_cap", oracle(_fence_cte(_D2_COLS) + " SELECT ID, " + ", ".join(
    f"{r(f'CASE WHEN {c} IS NULL THEN NULL ELSE least(greatest({c}, f.lo{i}), f.hi{i}) END')} AS {c}"
    for i, c in enumerate(_D2_COLS)) + " FROM applications, f"))
def d2_iqr_cap(spark, sf_dir):
    """Clip amounts to their IQR fences (NULL kept)."""
    df = apps(spark, sf_dir)
    return quality.IqrCap(columns=_D2_COLS).fit(df).transform(df).select("ID", *_D2_COLS)


@register("d3_social_circle_cap", oracle(
    ", caps AS (SELECT " + ", ".join(f"quantile_cont({c}, 0.9999) AS c{i}" for i, c in enumerate(SOCIAL_COLS)) +
    " FROM applications) SELECT ID, " + ", ".join(
        f"{r(f'CASE WHEN {c} IS NULL THEN NULL ELSE least({c}, caps.c{i}) END')} AS {c}"
        for i, c in enumerate(SOCIAL_COLS)) + " FROM applications, caps"))
def d3_social_circle_cap(spark, sf_dir):
    """D3: social-circle counts capped at their P99.99."""
    df = apps(spark, sf_dir)
    return quality.SocialCircleCap().fit(df).transform(df).select("ID", *SOCIAL_COLS)


@register("d4_amount_outlier", oracle(
    ", caps AS (SELECT " + ", ".join(f"quantile_cont({c}, 0.99995) AS c{i}" for i, c in enumerate(AMOUNT_COLS)) +
    " FROM applications) SELECT ID, " + ", ".join(
        f"{r(f'CASE WHEN {c} IS NULL THEN NULL ELSE least({c}, caps.c{i}) END')} AS {c}, "
        f"CAST(coalesce({c} > caps.c{i}, FALSE) AS INTEGER) AS {c}_outlier"
        for i, c in enumerate(AMOUNT_COLS)) + " FROM applications, caps"))
def d4_amount_outlier(spark, sf_dir):
    """Amounts capped at P99.995 with outlier flags."""
    df = apps(spark, sf_dir)
    out = quality.AmountOutlier().fit(df).transform(df)
    return out.select("ID", *[x for c in AMOUNT_COLS for x in (c, f"{c}_outlier")])


# ----------------------------------------------------------------- E1–E15
_WD_CASE = "CASE WEEKDAY_APPR_PROCESS_START " + " ".join(f"WHEN '{w}' THEN {i}" for i, w in enumerate(WEEKDAYS)) + " END"


@register("e1_weekday_encoder", oracle(
    f"SELECT ID, {r(f'sin({2 * math.pi!r} * ({_WD_CASE}) / 7)')} AS WEEKDAY_SIN, "
    f"{r(f'cos({2 * math.pi!r} * ({_WD_CASE}) / 7)')} AS WEEKDAY_COS FROM applications"))
def e1_weekday_encoder(spark, sf_dir):
    """Cyclical weekday encoding."""
    return features.WeekdayEncoder().transform(apps(spark, sf_dir)).select("ID", "WEEKDAY_SIN", "WEEKDAY_COS")


_HB = ("CASE WHEN HOUR_APPR_PROCESS_START >= 0 AND HOUR_APPR_PROCESS_START < 6 THEN 'Late_Night' "
       "WHEN HOUR_APPR_PROCESS_START < 12 THEN 'Morning' WHEN HOUR_APPR_PROCESS_START < 18 THEN 'Afternoon' "
       "ELSE 'Evening' END")


@register("e2_hour_binner", oracle(
    f"SELECT ID, HOUR_APPR_PROCESS_START, {_HB} AS HOUR_APPR_PROCESS_BIN FROM applications"))
def e2_hour_binner(spark, sf_dir):
    """Hour → period (raw hour kept)."""
    return (features.HourBinner().transform(apps(spark, sf_dir))
            .select("ID", "HOUR_APPR_PROCESS_START", "HOUR_APPR_PROCESS_BIN"))


@register("e3_age_feature", oracle(
    "SELECT ID, CAST(trunc(abs(DAYS_BIRTH) / 365.25) AS BIGINT) AS AGE, "
    "CAST(trunc(abs(DAYS_EMPLOYED) / 365.25) AS BIGINT) AS YEARS_EMPLOYED FROM applications"))
def e3_age_feature(spark, sf_dir):
    """Age in whole years (and years employed)."""
    return (features.AgeFeature(years_employed=True).transform(apps(spark, sf_dir))
            .select("ID", "AGE", "YEARS_EMPLOYED"))


@register("e4_days_abs", oracle(
    "SELECT ID, abs(DAYS_BIRTH) AS DAYS_BIRTH, abs(DAYS_EMPLOYED) AS DAYS_EMPLOYED, "
    "abs(DAYS_LAST_PHONE_CHANGE) AS DAYS_LAST_PHONE_CHANGE FROM applications"), round_doubles=False)
def e4_days_abs(spark, sf_dir):
    """Absolute value of every DAYS_ column found at fit time."""
    df = apps(spark, sf_dir)
    out = features.DaysAbs().fit(df).transform(df)
    return out.select("ID", "DAYS_BIRTH", "DAYS_EMPLOYED", "DAYS_LAST_PHONE_CHANGE")


def _bureau_case(c: str) -> str:
    if c.endswith("_HOUR") or c.endswith("_DAY"):
        return f"CASE WHEN {c} > 0 THEN 'HAS_ENQUIRY' ELSE 'ZERO' END"
    if c.endswith("_WEEK"):
        return f"CASE WHEN {c} > 1 THEN 'MULTIPLE' WHEN {c} = 1 THEN 'ONE' ELSE 'ZERO' END"
    if c.endswith("_MON") or c.endswith("_QRT"):
        return f"CASE WHEN {c} > 2 THEN 'HIGH' WHEN {c} BETWEEN 1 AND 2 THEN 'LOW' ELSE 'ZERO' END"
    return (f"CASE WHEN {c} > 5 THEN 'HIGH' WHEN {c} BETWEEN 3 AND 5 THEN 'MEDIUM' "
            f"WHEN {c} BETWEEN 1 AND 2 THEN 'LOW' ELSE 'ZERO' END")


@register("e5_bureau_bins", oracle(
    "SELECT ID, " + ", ".join(f"{_bureau_case(c)} AS {c}_CAT" for c in BUREAU_COLS) + " FROM applications"))
def e5_bureau_bins(spark, sf_dir):
    """E5: bureau counts → bands (source kept)."""
    return features.bureau_bins(apps(spark, sf_dir)).select("ID", *[f"{c}_CAT" for c in BUREAU_COLS])


def _ord_case(c: str) -> str:
    filled = f"(CASE WHEN {c} IS NULL THEN 0.0 ELSE {c} END)"
    band = _bureau_case(c).replace(c, filled)
    order = bureau_order(c)
    return ("CAST(CASE " + band + " " + " ".join(f"WHEN '{v}' THEN {i}" for i, v in enumerate(order)) +
            " ELSE -1 END AS INTEGER)")


@register("e6_bureau_processor", oracle(
    "SELECT ID, CAST(AMT_REQ_CREDIT_BUREAU_HOUR IS NOT NULL AS INTEGER) AS HAS_CREDIT_BUREAU_DATA, " +
    ", ".join(f"{_ord_case(c)} AS {c}_ORD" for c in BUREAU_COLS) + " FROM applications"))
def e6_bureau_processor(spark, sf_dir):
    """C7+E5+E6: presence flag, fill, bands, ordinal codes."""
    out = features.BureauProcessor().transform(apps(spark, sf_dir))
    return out.select("ID", "HAS_CREDIT_BUREAU_DATA", *[f"{c}_ORD" for c in BUREAU_COLS])


@register("e7_document_total", oracle(
    "SELECT ID, CAST(" + " + ".join(f"coalesce({c}, 0)" for c in DOCUMENT_COLS) +
    " AS BIGINT) AS TOTAL_DOC_SUBMITTED FROM applications"))
def e7_document_total(spark, sf_dir):
    """Number of documents submitted."""
    return features.DocumentTotal().transform(apps(spark, sf_dir)).select("ID", "TOTAL_DOC_SUBMITTED")


_PRESENT = " + ".join(f"CAST({c} IS NOT NULL AS INTEGER)" for c in EXT_COLS)
_SUMX = " + ".join(f"coalesce({c}, 0.0)" for c in EXT_COLS)


@register("e8_ext_mean", oracle(
    f"SELECT ID, {r(f'CASE WHEN ({_PRESENT}) > 0 THEN ({_SUMX}) / ({_PRESENT}) END')} AS ext_mean FROM applications"))
def e8_ext_mean(spark, sf_dir):
    """Row mean of the available external scores."""
    return features.ExtMean().transform(apps(spark, sf_dir)).select("ID", "ext_mean")


@register("e9_ext_weighted", oracle(
    f"SELECT ID, {r('EXT_SOURCE_1 * 0.2 + EXT_SOURCE_2 * 0.5 + EXT_SOURCE_3 * 0.3')} AS EXT_SOURCE_WEIGHTED "
    "FROM applications"))
def e9_ext_weighted(spark, sf_dir):
    """Weighted external score."""
    return features.ext_weighted(apps(spark, sf_dir)).select("ID", "EXT_SOURCE_WEIGHTED")


@register("e10_pca_one")
def e10_pca_one(spark, sf_dir):
    """First principal component of the median-filled external scores
    (not SQL-expressible: an eigenproblem)."""
    df = apps(spark, sf_dir)
    filled = impute.SimpleImputer(columns=EXT_COLS, strategy="median").fit(df).transform(df)
    m = features.PcaOne().fit(filled)
    return m.transform(filled).select("ID", "EXT_SOURCE_PCA1")


@register("e11_log1p", oracle(
    f"SELECT ID, {r('ln(1 + AMT_CREDIT)')} AS AMT_CREDIT_LOG, {r('ln(1 + AMT_INCOME_TOTAL)')} AS AMT_INCOME_TOTAL_LOG "
    "FROM applications"))
def e11_log1p(spark, sf_dir):
    """log1p of credit and income (originals dropped)."""
    return features.Log1p().transform(apps(spark, sf_dir)).select("ID", "AMT_CREDIT_LOG", "AMT_INCOME_TOTAL_LOG")


_E12_COLS = ["AMT_CREDIT", "AMT_ANNUITY", "CNT_FAM_MEMBERS", "FLAG_DOCUMENT_3", "HOUR_APPR_PROCESS_START"]


@register("e12_standard_scale", oracle(
    ", st AS (SELECT " + ", ".join(f"avg({c}) AS m{i}, CASE WHEN stddev_pop({c}) > 0 THEN stddev_pop({c}) ELSE 1.0 END AS s{i}"
                                   for i, c in enumerate(_E12_COLS)) +
    " FROM applications) SELECT ID, TARGET, " + ", ".join(f"{r(f'({c} - st.m{i}) / st.s{i}')} AS {c}"
                                                         for i, c in enumerate(_E12_COLS)) +
    " FROM applications, st"))
def e12_standard_scale(spark, sf_dir):
    """Population-std scaling of numeric columns (ID and TARGET excluded)."""
    df = apps(spark, sf_dir).select("ID", "TARGET", *_E12_COLS)
    return features.StandardScale(exclude_cols=["ID"]).fit(df).transform(df)


@register("e13_ratios", oracle(
    f"SELECT ID, {r('AMT_ANNUITY / nullif(AMT_INCOME_TOTAL, 0)')} AS DTI_RATIO, "
    f"{r('AMT_CREDIT / nullif(AMT_INCOME_TOTAL, 0)')} AS CREDIT_INCOME_RATIO, "
    f"{r('AMT_ANNUITY / nullif(AMT_INCOME_TOTAL, 0)')} AS ANNUITY_INCOME_RATIO FROM applications"))
def e13_ratios(spark, sf_dir):
    """Debt-to-income and income ratios."""
    return features.ratios(apps(spark, sf_dir)).select("ID", "DTI_RATIO", "CREDIT_INCOME_RATIO", "ANNUITY_INCOME_RATIO")


_RARE_SQL = ", ".join(f"'{v}'" for v in RARE_SUITES)


@register("e14_rare_group", oracle(
    f"SELECT ID, CASE WHEN NAME_TYPE_SUITE IS NULL OR NAME_TYPE_SUITE IN ({_RARE_SQL}) THEN 'RARE_SUITE' "
    "ELSE NAME_TYPE_SUITE END AS NAME_TYPE_SUITE FROM applications"))
def e14_rare_group(spark, sf_dir):
    """Rare suites and NULL grouped."""
    return features.rare_group(apps(spark, sf_dir)).select("ID", "NAME_TYPE_SUITE")


_SUITE_G = (f"(CASE WHEN NAME_TYPE_SUITE IS NULL OR NAME_TYPE_SUITE IN ({_RARE_SQL}) THEN 'RARE_SUITE' "
            "ELSE NAME_TYPE_SUITE END)")


@register("e15_suite_and_contract_encode", oracle(
    "SELECT ID, CAST(NAME_CONTRACT_TYPE = 'Revolving loans' AS DOUBLE) AS \"NAME_CONTRACT_TYPE_Revolving loans\", "
    f"CAST({_SUITE_G} = 'RARE_SUITE' AS DOUBLE) AS NAME_TYPE_SUITE_RARE_SUITE, "
    f"CAST({_SUITE_G} = 'Unaccompanied' AS DOUBLE) AS NAME_TYPE_SUITE_Unaccompanied FROM applications"))
def e15_suite_and_contract_encode(spark, sf_dir):
    """Rare grouping then one-hot (drop first) of contract and suite."""
    out, _ = features.suite_and_contract_encode(apps(spark, sf_dir))
    return out.select("ID", *[c for c in out.columns if c.startswith("NAME_CONTRACT_TYPE_")
                              or c.startswith("NAME_TYPE_SUITE_")])


# ----------------------------------------------------------------- F1–F8
_LABEL_COLS = ["CODE_GENDER", "FLAG_OWN_CAR", "FLAG_OWN_REALTY"]


def _label_sql(c: str) -> str:
    t = f"coalesce(CAST({c} AS VARCHAR), 'nan')"
    return f"CAST(dense_rank() OVER (ORDER BY {t}) - 1 AS BIGINT)"


@register("f1_label_encode", oracle(
    "SELECT ID, " + ", ".join(f"{_label_sql(c)} AS {c}" for c in _LABEL_COLS) + " FROM applications"))
def f1_label_encode(spark, sf_dir):
    """text → code in the sorted classes."""
    df = apps(spark, sf_dir)
    return encode.FlexibleEncoder(label_encode_cols=_LABEL_COLS).fit(df).transform(df).select("ID", *_LABEL_COLS)


_ONEHOT = {"NAME_INCOME_TYPE": ["Commercial associate", "Pensioner", "State servant", "Unemployed", "Working"],
           "NAME_FAMILY_STATUS": ["Married", "Separated", "Single / not married", "Widow"]}


def _onehot_sql(cats: dict) -> str:
    return ", ".join(f"CAST({c} = '{v}' AS DOUBLE) AS \"{c}_{v}\"" for c, vs in cats.items() for v in vs[1:])


@register("f2_onehot_encode", oracle("SELECT ID, " + _onehot_sql(_ONEHOT) + " FROM applications"))
def f2_onehot_encode(spark, sf_dir):
    """one-hot, first category dropped."""
    df = apps(spark, sf_dir).select("ID", *_ONEHOT)
    return encode.FlexibleEncoder(onehot_encode_cols=list(_ONEHOT)).fit(df).transform(df)


_EDU_POS = "CASE NAME_EDUCATION_TYPE " + " ".join(f"WHEN '{v}' THEN {i}" for i, v in enumerate(EDUCATION_ORDER)) + " END"


@register("f3_ordinal_encode", oracle(
    f"SELECT ID, CAST(coalesce({_EDU_POS}, -1) AS DOUBLE) AS NAME_EDUCATION_TYPE FROM applications"))
def f3_ordinal_encode(spark, sf_dir):
    """education level → position in the given order."""
    df = apps(spark, sf_dir).select("ID", "NAME_EDUCATION_TYPE")
    enc = encode.FlexibleEncoder(ordinal_encode_cols=["NAME_EDUCATION_TYPE"],
                                 ordinal_mappings={"NAME_EDUCATION_TYPE": EDUCATION_ORDER})
    return enc.fit(df).transform(df)


_FREQ_COLS = ["ORGANIZATION_TYPE", "OCCUPATION_TYPE"]


def _freq_sql(c: str) -> str:
    return (f"{r(f'coalesce((SELECT CAST(count(*) AS DOUBLE) FROM applications x WHERE x.{c} = a.{c}) / '
                 f'(SELECT count({c}) FROM applications), 0.0)')}")


@register("f4_frequency_encode", oracle(
    "SELECT ID, " + ", ".join(f"{_freq_sql(c)} AS {c}_freq" for c in _FREQ_COLS) + " FROM applications a"))
def f4_frequency_encode(spark, sf_dir):
    """share of each value among non-null training rows."""
    df = apps(spark, sf_dir).select("ID", *_FREQ_COLS)
    return encode.FlexibleEncoder(frequency_encode_cols=_FREQ_COLS).fit(df).transform(df)


_F5_CONFIG = {
    "label_encode_cols": ["CODE_GENDER", "FLAG_OWN_CAR", "FLAG_OWN_REALTY"],
    "onehot_encode_cols": ["NAME_CONTRACT_TYPE", "NAME_INCOME_TYPE", "NAME_FAMILY_STATUS", "NAME_HOUSING_TYPE",
                           "NAME_TYPE_SUITE"],
    "ordinal_encode_cols": ["NAME_EDUCATION_TYPE"],
    "ordinal_mappings": {"NAME_EDUCATION_TYPE": EDUCATION_ORDER},
    "frequency_encode_cols": ["ORGANIZATION_TYPE", "OCCUPATION_TYPE"],
}
_F5_ONEHOT = {"NAME_CONTRACT_TYPE": ["Cash loans", "Revolving loans"],
              "NAME_INCOME_TYPE": _ONEHOT["NAME_INCOME_TYPE"],
              "NAME_FAMILY_STATUS": _ONEHOT["NAME_FAMILY_STATUS"],
              "NAME_HOUSING_TYPE": ["House / apartment", "Rented apartment", "With parents"],
              "NAME_TYPE_SUITE": ["Children", "Family", "Other_A", "Spouse, partner", "Unaccompanied", "nan"]}


def _f5_onehot_sql() -> str:
    parts = []
    for c, vs in _F5_ONEHOT.items():
        for v in vs[1:]:
            parts.append(f"CAST(coalesce({c}, 'nan') = '{v}' AS DOUBLE) AS \"{c}_{v}\"")
    return ", ".join(parts)


@register("f5_flexible_encoder", oracle(
    "SELECT ID, TARGET, AMT_CREDIT, " + ", ".join(f"{_label_sql(c)} AS {c}" for c in _F5_CONFIG["label_encode_cols"])
    + ", " + _f5_onehot_sql() + f", CAST(coalesce({_EDU_POS}, -1) "
    "AS DOUBLE) AS NAME_EDUCATION_TYPE, " + ", ".join(f"{_freq_sql(c)} AS {c}_freq" for c in _FREQ_COLS)
    + " FROM applications a"))
def f5_flexible_encoder(spark, sf_dir):
    """the reference encoder configuration on the raw table (a NULL suite
    is its own one-hot category)."""
    cols = ["ID", "TARGET", "AMT_CREDIT"] + [c for k in ("label_encode_cols", "onehot_encode_cols",
                                                           "ordinal_encode_cols", "frequency_encode_cols")
                                              for c in _F5_CONFIG[k]]
    df = apps(spark, sf_dir).select(*cols)
    return encode.FlexibleEncoder(**_F5_CONFIG).fit(df).transform(df)


@register("f6_hour_bin_onehot", oracle(
    "SELECT ID, " + ", ".join(f"CAST(({_HB}) = '{b}' AS INTEGER) AS HOUR_BIN_{b}"
                              for b in ["Afternoon", "Evening", "Late_Night", "Morning"]) + " FROM applications"))
def f6_hour_bin_onehot(spark, sf_dir):
    """hour-bin dummies with the categories fixed at fit."""
    df = features.HourBinner().transform(apps(spark, sf_dir).select("ID", "HOUR_APPR_PROCESS_START"))
    return encode.HourBinOneHot().fit(df).transform(df).drop("HOUR_APPR_PROCESS_START")


_F7_COLS = ["NAME_CONTRACT_TYPE", "CODE_GENDER", "NAME_TYPE_SUITE", "NAME_INCOME_TYPE", "OCCUPATION_TYPE",
            "ORGANIZATION_TYPE", "WEEKDAY_APPR_PROCESS_START"]


@register("f7_dictionary_encode", oracle(
    "SELECT ID, " + ", ".join(
        f"CAST(CASE WHEN {c} IS NULL THEN -1 ELSE dense_rank() OVER (ORDER BY {c} NULLS LAST) - 1 END AS INTEGER) AS {c}"
        for c in _F7_COLS) + " FROM applications"))
def f7_dictionary_encode(spark, sf_dir):
    """text columns → category codes (NULL → -1)."""
    df = apps(spark, sf_dir).select("ID", *_F7_COLS)
    return encode.DictionaryEncoder().fit(df).transform(df)


_TE_COLS = ["NAME_INCOME_TYPE", "ORGANIZATION_TYPE"]


@register("f8_target_encode", oracle(
    ", prior AS (SELECT avg(TARGET) AS p FROM applications) SELECT ID, " + ", ".join(
        f"{r(f'coalesce((SELECT avg(x.TARGET) FROM applications x WHERE x.{c} = a.{c}), prior.p)')} AS {c}_te"
        for c in _TE_COLS) + " FROM applications a, prior"))
def f8_target_encode(spark, sf_dir):
    """F8: mean target per category (overall mean for NULL/unseen)."""
    df = apps(spark, sf_dir).select("ID", "TARGET", *_TE_COLS)
    return encode.TargetEncoder(columns=_TE_COLS).fit(df).transform(df).select("ID", *[f"{c}_te" for c in _TE_COLS])
