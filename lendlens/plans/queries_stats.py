"""Registered queries: correlation, feature–target statistics, selection.

p-values need distribution tails that the SQL oracle lacks, so each statistic
is registered twice where it has one: a SQL-checked query of the statistic
itself, and a ``*_with_p`` query (rows-only check); the tails are unit-tested
against textbook values.
"""

from __future__ import annotations

from lendlens.functions.exprs import EDUCATION_ORDER
from lendlens.operators import select, stats
from lendlens.plans.catalog import apps, oracle, r, register

_CORR_COLS = ["AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY", "AMT_GOODS_PRICE", "EXT_SOURCE_1", "EXT_SOURCE_2",
              "EXT_SOURCE_3", "CNT_FAM_MEMBERS", "DAYS_BIRTH", "OWN_CAR_AGE"]
_CORR_SQL = " UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, {r(f'corr({a}, {b})')} AS correlation FROM applications"
    for a in _CORR_COLS for b in _CORR_COLS)


@register("h1_correlation_matrix", oracle(_CORR_SQL))
def h1_correlation_matrix(spark, sf_dir):
    """H1: pairwise-complete Pearson matrix (masked per-partition Gram sums,
    one pass)."""
    return stats.correlation_matrix(apps(spark, sf_dir), _CORR_COLS)


@register("h1_correlation_matrix_agg", oracle(_CORR_SQL))
def h1_correlation_matrix_agg(spark, sf_dir):
    """H1 via one JVM aggregate of a null-safe correlation per pair."""
    return stats.correlation_matrix(apps(spark, sf_dir), _CORR_COLS, method="agg")


_TC_COLS = ["AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY", "EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3",
            "HOUR_APPR_PROCESS_START", "DAYS_BIRTH", "FLAG_DOCUMENT_3", "OBS_30_CNT_SOCIAL_CIRCLE"]
_TC_SQL = " UNION ALL ".join(f"SELECT '{c}' AS feature, corr({c}, TARGET) AS correlation FROM applications"
                             for c in _TC_COLS)


@register("h2_target_correlation", oracle(f"SELECT feature, {r('correlation')} AS correlation FROM ({_TC_SQL}) t"))
def h2_target_correlation(spark, sf_dir):
    """H2: correlation with TARGET, largest |r| first."""
    return stats.target_correlation(apps(spark, sf_dir), _TC_COLS + ["TARGET"])


@register("h3_correlation_bands", oracle(f"""
SELECT feature, {r('correlation')} AS correlation,
       CASE WHEN abs(correlation) > 0.3 THEN 'strong' WHEN abs(correlation) > 0.1 THEN 'medium'
            WHEN abs(correlation) <= 0.1 THEN 'weak' END AS band FROM ({_TC_SQL}) t"""))
def h3_correlation_bands(spark, sf_dir):
    """H3: strength band of each target correlation."""
    return stats.correlation_bands(apps(spark, sf_dir), _TC_COLS)


_G4_CANDS = ["AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY", "HOUR_APPR_PROCESS_START", "DAYS_BIRTH",
             "CNT_FAM_MEMBERS", "OBS_30_CNT_SOCIAL_CIRCLE", "DEF_30_CNT_SOCIAL_CIRCLE", "TARGET", "DAYS_EMPLOYED"]


@register("g4_top_correlated", oracle(
    ", c AS (" + " UNION ALL ".join(f"SELECT '{c}' AS feature, corr(EXT_SOURCE_2, {c}) AS correlation FROM applications"
                                   for c in _G4_CANDS) +
    ") SELECT feature, " + r("correlation") + " AS correlation FROM c WHERE correlation IS NOT NULL AND NOT isnan(correlation) "
    "ORDER BY abs(c.correlation) DESC, feature LIMIT 5"))
def g4_top_correlated(spark, sf_dir):
    """Five features most correlated with EXT_SOURCE_2."""
    return stats.top_correlated(apps(spark, sf_dir), "EXT_SOURCE_2", _G4_CANDS, 5)


def _moments_sql(c: str) -> str:
    return (f", mom AS (SELECT avg({c}) AS m FROM applications) "
            f", cm AS (SELECT avg(pow({c} - m, 2)) AS m2, avg(pow({c} - m, 3)) AS m3, avg(pow({c} - m, 4)) AS m4 "
            f"FROM applications, mom WHERE {c} IS NOT NULL) ")


@register("h5_continuous_metrics", oracle(_moments_sql("AMT_CREDIT") + f"""
SELECT 'AMT_CREDIT' AS feature, count(AMT_CREDIT) AS count, count(*) - count(AMT_CREDIT) AS missing,
       {r('avg(AMT_CREDIT)')} AS mean, {r('quantile_cont(AMT_CREDIT, 0.5)')} AS median,
       {r('stddev_samp(AMT_CREDIT)')} AS std, {r('min(AMT_CREDIT)')} AS min, {r('max(AMT_CREDIT)')} AS max,
       {r('max(cm.m3) / pow(max(cm.m2), 1.5)')} AS skewness, {r('max(cm.m4) / pow(max(cm.m2), 2) - 3')} AS kurtosis
FROM applications, cm"""))
def h5_continuous_metrics(spark, sf_dir):
    """H5: continuous metrics with biased skewness/kurtosis."""
    return stats.continuous_metrics(apps(spark, sf_dir), "AMT_CREDIT")


@register("h5_continuous_metrics_with_anova")
def h5_continuous_metrics_with_anova(spark, sf_dir):
    """H5 with the ANOVA F and p over TARGET groups."""
    return stats.continuous_metrics(apps(spark, sf_dir), "EXT_SOURCE_2", "TARGET")


@register("h6_shape_metrics", oracle(f"""
SELECT 'AMT_ANNUITY' AS feature, {r('skewness(AMT_ANNUITY)')} AS skewness, {r('kurtosis(AMT_ANNUITY)')} AS kurtosis
FROM applications"""))
def h6_shape_metrics(spark, sf_dir):
    """H6: bias-corrected skewness and kurtosis."""
    return stats.shape_metrics(apps(spark, sf_dir), "AMT_ANNUITY")


@register("h18_normality_check", oracle(_moments_sql("EXT_SOURCE_3") + f"""
, jb AS (SELECT count(EXT_SOURCE_3) AS n, count(EXT_SOURCE_3) / 6.0 * (pow(max(cm.m3) / pow(max(cm.m2), 1.5), 2)
         + pow(max(cm.m4) / pow(max(cm.m2), 2) - 3, 2) / 4.0) AS jb FROM applications, cm)
SELECT 'EXT_SOURCE_3' AS feature, n AS count, {r('jb')} AS jarque_bera, {r('exp(-jb / 2.0)')} AS p_value FROM jb"""))
def h18_normality_check(spark, sf_dir):
    """Jarque–Bera normality test of EXT_SOURCE_3."""
    return stats.normality_check(apps(spark, sf_dir), "EXT_SOURCE_3")


@register("h7_nominal_metrics", oracle(f"""
, c AS (SELECT CAST(ORGANIZATION_TYPE AS VARCHAR) AS v, count(*) AS n FROM applications
        WHERE ORGANIZATION_TYPE IS NOT NULL GROUP BY 1)
, m AS (SELECT v, n FROM c ORDER BY n DESC, v ASC LIMIT 1)
SELECT 'ORGANIZATION_TYPE' AS feature, CAST((SELECT sum(n) FROM c) AS BIGINT) AS count,
       (SELECT count(*) FROM applications WHERE ORGANIZATION_TYPE IS NULL) AS missing,
       (SELECT count(*) FROM c) AS unique_values, m.v AS mode, m.n AS mode_frequency,
       {r('m.n * 100.0 / (SELECT sum(n) FROM c)')} AS mode_percentage FROM m"""))
def h7_nominal_metrics(spark, sf_dir):
    """H7: nominal metrics of the organisation type."""
    return stats.nominal_metrics(apps(spark, sf_dir), "ORGANIZATION_TYPE")


_EDU_MAP = {v: i + 1 for i, v in enumerate(EDUCATION_ORDER)}
_EDU_RANK = "CASE category " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in _EDU_MAP.items()) + " ELSE 0 END"


@register("h8_ordinal_metrics", oracle(f"""
, c AS (SELECT CAST(NAME_EDUCATION_TYPE AS VARCHAR) AS category, count(*) AS frequency FROM applications
        WHERE NAME_EDUCATION_TYPE IS NOT NULL GROUP BY 1)
, o AS (SELECT category, frequency, row_number() OVER (ORDER BY {_EDU_RANK}, frequency DESC, category) AS rn,
               sum(frequency) OVER (ORDER BY {_EDU_RANK}, frequency DESC, category ROWS UNBOUNDED PRECEDING) AS cum,
               sum(frequency) OVER () AS total FROM c)
SELECT CAST(rn AS INTEGER) AS "order", category, frequency, round_even(frequency * 100.0 / total, 2) AS percentage,
       round_even(cum * 100.0 / total, 2) AS cumulative_percentage FROM o"""))
def h8_ordinal_metrics(spark, sf_dir):
    """H8: education levels in order with cumulative percentages."""
    return stats.ordinal_metrics(apps(spark, sf_dir), "NAME_EDUCATION_TYPE", _EDU_MAP)


def _contingency_sql(f: str, i: int = 0) -> str:
    """Brute-force contingency statistics over the full value×class grid."""
    s = f"_{i}"
    return f"""
, cells{s} AS (SELECT CAST({f} AS VARCHAR) AS v, TARGET AS t, count(*) AS o FROM applications
              WHERE {f} IS NOT NULL AND TARGET IS NOT NULL GROUP BY 1, 2)
, rt{s} AS (SELECT v, sum(o) AS rtot FROM cells{s} GROUP BY v)
, ct{s} AS (SELECT t, sum(o) AS ctot FROM cells{s} GROUP BY t)
, tot{s} AS (SELECT sum(o) AS n, count(DISTINCT v) AS r, count(DISTINCT t) AS c FROM cells{s})
, grid{s} AS (SELECT rt{s}.v, ct{s}.t, rtot, ctot, CAST(coalesce(cells{s}.o, 0) AS DOUBLE) AS o
             FROM rt{s} CROSS JOIN ct{s} LEFT JOIN cells{s} ON cells{s}.v = rt{s}.v AND cells{s}.t = ct{s}.t)
, e{s} AS (SELECT grid{s}.*, CAST(rtot AS DOUBLE) * ctot / n AS e, (r - 1) * (c - 1) AS dof, n, r, c FROM grid{s}, tot{s})
, iv{s} AS (SELECT v, (max(CASE WHEN t = 1 THEN o END) / max(CASE WHEN t = 1 THEN ctot END) + 0.0001
                     - (max(CASE WHEN t = 0 THEN o END) / max(CASE WHEN t = 0 THEN ctot END) + 0.0001))
                    * ln((max(CASE WHEN t = 1 THEN o END) / max(CASE WHEN t = 1 THEN ctot END) + 0.0001)
                         / (max(CASE WHEN t = 0 THEN o END) / max(CASE WHEN t = 0 THEN ctot END) + 0.0001)) AS term
           FROM grid{s} GROUP BY v)
, st{s} AS (SELECT '{f}' AS feature, CAST(max(r) AS BIGINT) AS unique_values,
                  CASE WHEN max(dof) > 0 THEN sum(CASE WHEN dof = 1 THEN pow(abs(o - e) - least(0.5, abs(o - e)), 2) / e
                                                      ELSE pow(o - e, 2) / e END) ELSE 0.0 END AS chi2,
                  CAST(max(dof) AS BIGINT) AS dof, CAST(max(n) AS BIGINT) AS n, least(max(r), max(c)) AS k,
                  coalesce((SELECT sum(term) FROM iv{s}), 0.0) AS iv,
                  sum(CASE WHEN o > 0 THEN o / n * ln(o * n / (CAST(rtot AS DOUBLE) * ctot)) ELSE 0 END) AS mi
           FROM e{s})"""


def _contingency_select(i: int = 0) -> str:
    s = f"_{i}"
    return (f"SELECT feature, unique_values, {r('chi2')} AS chi2, dof, n, "
            f"{r('CASE WHEN k > 1 THEN sqrt(chi2 / (n * (k - 1))) END')} AS cramers_v, "
            f"{r('iv')} AS information_value, {r('mi')} AS mutual_information FROM st{s}")


_NOMINAL = ["NAME_INCOME_TYPE", "NAME_CONTRACT_TYPE", "ORGANIZATION_TYPE", "OCCUPATION_TYPE", "CODE_GENDER"]


def _cross_sql(row, col, values, normalize):
    cell = lambda v: f"count(*) FILTER (WHERE {col} = '{v}')"
    name = lambda v: '"' + v + '"'
    if not normalize:
        return f"SELECT {row}, " + ", ".join(f"CAST({cell(v)} AS BIGINT) AS {name(v)}" for v in values) + f" FROM applications WHERE {row} IS NOT NULL GROUP BY {row}"
    share = lambda v: r(f"{cell(v)} * 1.0 / (SELECT count(*) FROM applications WHERE {col} = '{v}' AND {row} IS NOT NULL)")
    return f"SELECT {row}, " + ", ".join(f"{share(v)} AS {name(v)}" for v in values) + f" FROM applications WHERE {row} IS NOT NULL GROUP BY {row}"


_SUITES = ["Children", "Family", "Other_A", "Spouse, partner", "Unaccompanied"]


@register("m11_crosstab", oracle(_cross_sql("NAME_EDUCATION_TYPE", "NAME_TYPE_SUITE", _SUITES, False)))
def m11_crosstab(spark, sf_dir):
    """Education by accompanying person, as a table of counts."""
    return stats.crosstab(apps(spark, sf_dir), "NAME_EDUCATION_TYPE", "NAME_TYPE_SUITE")


@register("m11_crosstab_normalized", oracle(_cross_sql("OCCUPATION_TYPE", "NAME_TYPE_SUITE", _SUITES, True)))
def m11_crosstab_normalized(spark, sf_dir):
    """Shares of occupations within each accompanying person."""
    return stats.crosstab(apps(spark, sf_dir), "OCCUPATION_TYPE", "NAME_TYPE_SUITE", normalize=True)


@register("h9_contingency_stats", oracle(
    "".join(_contingency_sql(f, i) for i, f in enumerate(_NOMINAL)) + " " +
    " UNION ALL ".join(_contingency_select(i) for i in range(len(_NOMINAL)))))
def h9_contingency_stats(spark, sf_dir):
    """H9–H11 batched: chi-square (Yates on 2×2), Cramér's V, IV, MI for five
    nominal features from one grouped pass."""
    return stats.contingency_stats(apps(spark, sf_dir), _NOMINAL).drop("p_value")


@register("h9_chi2_cramers_v", oracle(_contingency_sql("NAME_CONTRACT_TYPE") + f"""
SELECT feature, unique_values, {r('chi2')} AS chi2, dof, {r('CASE WHEN k > 1 THEN sqrt(chi2 / (n * (k - 1))) END')}
       AS cramers_v FROM st_0"""))
def h9_chi2_cramers_v(spark, sf_dir):
    """H9: chi-square with Yates correction (2×2) and Cramér's V."""
    return stats.chi2_cramers_v(apps(spark, sf_dir), "NAME_CONTRACT_TYPE").drop("p_value")


@register("h9_chi2_with_p")
def h9_chi2_with_p(spark, sf_dir):
    """H9 with its p-value (chi-square tail)."""
    return stats.chi2_cramers_v(apps(spark, sf_dir), "NAME_INCOME_TYPE")


@register("h10_information_value", oracle(_contingency_sql("ORGANIZATION_TYPE") +
                                          f" SELECT feature, {r('iv')} AS information_value FROM st_0"))
def h10_information_value(spark, sf_dir):
    """Information value of the organisation type."""
    return stats.information_value(apps(spark, sf_dir), "ORGANIZATION_TYPE")


@register("h11_mutual_information", oracle(_contingency_sql("OCCUPATION_TYPE") +
                                           f" SELECT feature, {r('mi')} AS mutual_information FROM st_0"))
def h11_mutual_information(spark, sf_dir):
    """Mutual information of the occupation and the target."""
    return stats.mutual_information(apps(spark, sf_dir), "OCCUPATION_TYPE")


def _continuous_sql(f: str, i: int = 0) -> str:
    s = f"_{i}"
    return f"""
, v{s} AS (SELECT CAST({f} AS DOUBLE) AS x, CAST(TARGET AS DOUBLE) AS t FROM applications
          WHERE {f} IS NOT NULL AND TARGET IS NOT NULL)
, g{s} AS (SELECT t, count(*) AS ng, avg(x) AS mg, coalesce(var_samp(x), 0) AS vg FROM v{s} GROUP BY t)
, gm{s} AS (SELECT avg(x) AS gm, count(*) AS n, corr(x, t) AS pr FROM v{s})
, a{s} AS (SELECT '{f}' AS feature, max(n) AS n, max(pr) AS pr, sum(ng * pow(mg - gm, 2)) AS ssb,
                 sum((ng - 1) * vg) AS ssw, count(*) AS k FROM g{s}, gm{s})"""


def _continuous_select(i: int = 0) -> str:
    return (f"SELECT feature, n, {r('pr')} AS point_biserial_r, "
            f"{r('CASE WHEN k > 1 AND n > k THEN (ssb / (k - 1)) / (ssw / (n - k)) END')} AS anova_f FROM a_{i}")


_CONTINUOUS = ["EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3", "AMT_CREDIT", "AMT_INCOME_TOTAL", "DAYS_BIRTH"]


@register("h12_h15_continuous_target_stats", oracle(
    "".join(_continuous_sql(f, i) for i, f in enumerate(_CONTINUOUS)) + " " +
    " UNION ALL ".join(_continuous_select(i) for i in range(len(_CONTINUOUS)))))
def h12_h15_continuous_target_stats(spark, sf_dir):
    """H12 + H15 batched: point-biserial r and ANOVA F for six numeric
    features from one grouped pass."""
    return stats.continuous_target_stats(apps(spark, sf_dir), _CONTINUOUS).drop("point_biserial_p", "anova_p")


@register("h12_point_biserial", oracle(_continuous_sql("EXT_SOURCE_2") +
                                       f" SELECT feature, n, {r('pr')} AS correlation FROM a_0"))
def h12_point_biserial(spark, sf_dir):
    """Point-biserial correlation of EXT_SOURCE_2 and TARGET."""
    return stats.point_biserial(apps(spark, sf_dir), "EXT_SOURCE_2").drop("p_value")


@register("h15_anova_f", oracle(_continuous_sql("AMT_CREDIT") + " SELECT feature, " +
                                r("CASE WHEN k > 1 AND n > k THEN (ssb / (k - 1)) / (ssw / (n - k)) END") +
                                " AS f_statistic FROM a_0"))
def h15_anova_f(spark, sf_dir):
    """One-way ANOVA F of the credit amount over TARGET."""
    return stats.anova_f(apps(spark, sf_dir), ["AMT_CREDIT"]).drop("p_value")


@register("h16_relationship_continuous")
def h16_relationship_continuous(spark, sf_dir):
    """H16 continuous bundle with p-values."""
    return stats.relationship_continuous(apps(spark, sf_dir), "EXT_SOURCE_2")


@register("h16_relationship_continuous_values", oracle(_continuous_sql("EXT_SOURCE_2") + " " + _continuous_select()))
def h16_relationship_continuous_values(spark, sf_dir):
    """H16 continuous bundle: its statistics without the p-values."""
    return stats.relationship_continuous(apps(spark, sf_dir), "EXT_SOURCE_2").drop("point_biserial_p", "anova_p")


@register("h16_relationship_nominal")
def h16_relationship_nominal(spark, sf_dir):
    """H16 nominal bundle with p-value."""
    return stats.relationship_nominal(apps(spark, sf_dir), "NAME_INCOME_TYPE")


_V_SQL = r("CASE WHEN k > 1 THEN sqrt(chi2 / (n * (k - 1))) END")


@register("h16_relationship_nominal_values", oracle(_contingency_sql("NAME_INCOME_TYPE") + f"""
SELECT feature, unique_values, {r('chi2')} AS chi2, {_V_SQL} AS cramers_v, {r('iv')} AS information_value,
       {r('mi')} AS mutual_information FROM st_0"""))
def h16_relationship_nominal_values(spark, sf_dir):
    """H16 nominal bundle: its statistics without the p-value."""
    return stats.relationship_nominal(apps(spark, sf_dir), "NAME_INCOME_TYPE").drop("p_value")


@register("h16_relationship_discrete_few")
def h16_relationship_discrete_few(spark, sf_dir):
    """H16 discrete (few values) bundle."""
    return stats.relationship_discrete_few(apps(spark, sf_dir), "CNT_FAM_MEMBERS")


@register("h16_relationship_discrete_few_values", oracle(_contingency_sql("CNT_FAM_MEMBERS") + f"""
SELECT feature, unique_values, {r('chi2')} AS chi2, {_V_SQL} AS cramers_v FROM st_0"""))
def h16_relationship_discrete_few_values(spark, sf_dir):
    """H16 discrete (few values) bundle: its statistics without the p-value."""
    return stats.relationship_discrete_few(apps(spark, sf_dir), "CNT_FAM_MEMBERS").drop("p_value")


@register("h16_relationship_discrete_many")
def h16_relationship_discrete_many(spark, sf_dir):
    """H16 discrete (many values) bundle."""
    return stats.relationship_discrete_many(apps(spark, sf_dir), "HOUR_APPR_PROCESS_START")


@register("h16_relationship_discrete_many_values", oracle(_contingency_sql("HOUR_APPR_PROCESS_START") + f"""
, v AS (SELECT CAST(dense_rank() OVER (ORDER BY HOUR_APPR_PROCESS_START) - 1 AS DOUBLE) AS x, CAST(TARGET AS DOUBLE) AS y
        FROM applications WHERE HOUR_APPR_PROCESS_START IS NOT NULL AND TARGET IS NOT NULL)
SELECT feature, (SELECT {r('corr(x, y)')} FROM v) AS point_biserial_r, unique_values, {r('iv')} AS information_value FROM st_0"""))
def h16_relationship_discrete_many_values(spark, sf_dir):
    """H16 discrete (many values) bundle: its statistics without the p-value."""
    return stats.relationship_discrete_many(apps(spark, sf_dir), "HOUR_APPR_PROCESS_START").drop("point_biserial_p")


@register("h16_relationship_ordinal")
def h16_relationship_ordinal(spark, sf_dir):
    """H16 ordinal bundle (Spearman and point-biserial with p)."""
    return stats.relationship_ordinal(apps(spark, sf_dir), "NAME_EDUCATION_TYPE", order=EDUCATION_ORDER)


_EDU_CODE = "CASE NAME_EDUCATION_TYPE " + " ".join(f"WHEN '{v}' THEN {i}" for i, v in enumerate(EDUCATION_ORDER)) + " END"


@register("h14_spearman", oracle(f"""
, v AS (SELECT CAST({_EDU_CODE} AS DOUBLE) AS x, CAST(TARGET AS DOUBLE) AS y FROM applications
        WHERE NAME_EDUCATION_TYPE IS NOT NULL AND TARGET IS NOT NULL AND ({_EDU_CODE}) IS NOT NULL)
, rk AS (SELECT (2 * rank() OVER (ORDER BY x) + count(*) OVER (PARTITION BY x) - 1) / 2.0 AS rx,
                (2 * rank() OVER (ORDER BY y) + count(*) OVER (PARTITION BY y) - 1) / 2.0 AS ry FROM v)
SELECT 'NAME_EDUCATION_TYPE' AS feature, count(*) AS n, {r('corr(rx, ry)')} AS spearman_r FROM rk"""))
def h14_spearman(spark, sf_dir):
    """Spearman correlation of education rank and TARGET (tie-aware)."""
    return stats.spearman(apps(spark, sf_dir), "NAME_EDUCATION_TYPE", order=EDUCATION_ORDER).drop("spearman_p")


@register("h14_spearman_numeric", oracle(f"""
, v AS (SELECT CAST(AMT_ANNUITY AS DOUBLE) AS x, CAST(TARGET AS DOUBLE) AS y FROM applications
        WHERE AMT_ANNUITY IS NOT NULL AND TARGET IS NOT NULL)
, rk AS (SELECT (2 * rank() OVER (ORDER BY x) + count(*) OVER (PARTITION BY x) - 1) / 2.0 AS rx,
                (2 * rank() OVER (ORDER BY y) + count(*) OVER (PARTITION BY y) - 1) / 2.0 AS ry FROM v)
SELECT 'AMT_ANNUITY' AS feature, count(*) AS n, {r('corr(rx, ry)')} AS spearman_r FROM rk"""))
def h14_spearman_numeric(spark, sf_dir):
    """H14 on a many-valued numeric column (ranks over distinct values)."""
    return stats.spearman(apps(spark, sf_dir), "AMT_ANNUITY").drop("spearman_p")


@register("h13_point_biserial_coded", oracle(f"""
, v AS (SELECT CAST(dense_rank() OVER (ORDER BY HOUR_APPR_PROCESS_START) - 1 AS DOUBLE) AS x, CAST(TARGET AS DOUBLE) AS y
        FROM applications WHERE HOUR_APPR_PROCESS_START IS NOT NULL AND TARGET IS NOT NULL)
SELECT 'HOUR_APPR_PROCESS_START' AS feature, count(*) AS n, {r('corr(x, y)')} AS point_biserial_r FROM v"""))
def h13_point_biserial_coded(spark, sf_dir):
    """Point-biserial on the category codes of the application hour."""
    return stats.point_biserial_coded(apps(spark, sf_dir), "HOUR_APPR_PROCESS_START").drop("point_biserial_p")


_H17_NOM = ["NAME_INCOME_TYPE", "NAME_FAMILY_STATUS"]
_H17_CONT = ["EXT_SOURCE_2", "AMT_ANNUITY"]


@register("h17_relationship_report", oracle(
    "".join(_contingency_sql(f, i) for i, f in enumerate(_H17_NOM)) +
    "".join(_continuous_sql(f, i + 10) for i, f in enumerate(_H17_CONT)) + " " +
    " UNION ALL ".join(
        [f"SELECT feature, 'nominal' AS kind, unique_values, {r('chi2')} AS chi2, "
         f"{r('CASE WHEN k > 1 THEN sqrt(chi2 / (n * (k - 1))) END')} AS cramers_v, {r('iv')} AS information_value, "
         f"{r('mi')} AS mutual_information, CAST(NULL AS DOUBLE) AS point_biserial_r, CAST(NULL AS DOUBLE) AS anova_f "
         f"FROM st_{i}" for i in range(len(_H17_NOM))] +
        [f"SELECT feature, 'continuous' AS kind, CAST(NULL AS BIGINT) AS unique_values, CAST(NULL AS DOUBLE) AS chi2, "
         f"CAST(NULL AS DOUBLE) AS cramers_v, CAST(NULL AS DOUBLE) AS information_value, "
         f"CAST(NULL AS DOUBLE) AS mutual_information, {r('pr')} AS point_biserial_r, "
         f"{r('CASE WHEN k > 1 AND n > k THEN (ssb / (k - 1)) / (ssw / (n - k)) END')} AS anova_f FROM a_{i + 10}"
         for i in range(len(_H17_CONT))])))
def h17_relationship_report(spark, sf_dir):
    """Stacked relationship report over nominal and continuous features."""
    return stats.relationship_report(apps(spark, sf_dir), _H17_NOM, _H17_CONT).drop(
        "p_value", "point_biserial_p", "anova_p")


@register("h17_relationship_report_with_p")
def h17_relationship_report_with_p(spark, sf_dir):
    """H17 with every p-value."""
    return stats.relationship_report(apps(spark, sf_dir), _H17_NOM, _H17_CONT)


# ---------------------------------------------------------------- G1–G3
_VIF_COLS = ["AMT_CREDIT", "AMT_GOODS_PRICE", "AMT_ANNUITY", "AMT_INCOME_TOTAL", "EXT_SOURCE_2", "CNT_FAM_MEMBERS",
             "HOUR_APPR_PROCESS_START", "FLAG_DOCUMENT_3"]


@register("g1_vif_filter")
def g1_vif_filter(spark, sf_dir):
    """G1: iterative VIF elimination from one Gram pass (rows with a NULL in
    the listed columns are left out). Returns the kept and removed columns."""
    kept, removed, _ = select.vif_filter(apps(spark, sf_dir), _VIF_COLS, 10.0)
    rows = [(c, "kept", None) for c in kept] + [(c, "removed", i + 1) for i, c in enumerate(removed)]
    return spark.createDataFrame(rows, "feature string, status string, removal_round int")


_G2_COLS = ["FLAG_DOCUMENT_2", "FLAG_DOCUMENT_3", "FLAG_DOCUMENT_21", "FLAG_DOCUMENT_20", "TARGET",
            "CNT_FAM_MEMBERS", "AMT_CREDIT", "DEF_30_CNT_SOCIAL_CIRCLE"]
_G2_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, (SELECT count(DISTINCT {c}) FROM applications) = 2 AS is_binary, "
    f"(SELECT var_pop({c}) FROM applications) AS v, {i} AS pos" for i, c in enumerate(_G2_COLS))


@register("g2_binary_variance_filter", oracle(f"""
, s AS ({_G2_SQL})
SELECT feature, CASE WHEN NOT is_binary THEN 'kept_non_binary' WHEN v > 0.01 THEN 'kept_binary' ELSE 'removed' END
       AS status FROM s"""))
def g2_binary_variance_filter(spark, sf_dir):
    """Binary columns with population variance <= 0.01 are removed."""
    df = apps(spark, sf_dir)
    kept, removed = select.binary_variance_filter(df, _G2_COLS, 0.01)
    binary, _ = select.binary_columns(df, _G2_COLS)
    rows = [(c, "removed" if c in removed else "kept_binary" if c in binary else "kept_non_binary")
            for c in _G2_COLS]
    return spark.createDataFrame(rows, "feature string, status string")


@register("g3_feature_selector")
def g3_feature_selector(spark, sf_dir):
    """Logistic-style selection (VIF, then binary variance) applied to a
    median-filled numeric projection; returns the selected frame."""
    from lendlens.operators import impute
    cols = _VIF_COLS + ["FLAG_DOCUMENT_2", "FLAG_DOCUMENT_21"]
    df = apps(spark, sf_dir).select("TARGET", *cols)
    df = impute.SimpleImputer(columns=cols, strategy="median").fit(df).transform(df)
    return select.FeatureSelector(model_base="logistic").fit(df).transform(df)

