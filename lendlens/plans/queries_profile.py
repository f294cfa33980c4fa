"""Registered queries: projection, profiling, quality and chart data."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from lendlens.functions import quantiles
from lendlens.functions.exprs import EXT_COLS, SOCIAL_COLS, BUREAU_COLS, EDUCATION_ORDER, NUMERIC_TYPES
from lendlens.operators import charts, profile, quality
from lendlens.plans.catalog import apps, oracle, r, register
from lendlens.session import scratch_path
from lendlens.sources.fixtures import APP_COLUMNS

_HOUR_BIN_SQL = ("CASE WHEN HOUR_APPR_PROCESS_START >= 0 AND HOUR_APPR_PROCESS_START < 6 THEN 'Late_Night' "
                 "WHEN HOUR_APPR_PROCESS_START < 12 THEN 'Morning' WHEN HOUR_APPR_PROCESS_START < 18 "
                 "THEN 'Afternoon' ELSE 'Evening' END")
_BIN_ORDER_SQL = ("CAST(CASE hour_bin WHEN 'Late_Night' THEN 0 WHEN 'Morning' THEN 1 "
                  "WHEN 'Afternoon' THEN 2 WHEN 'Evening' THEN 3 END AS INTEGER)")


# ------------------------------------------------------------------ charts
@register("j11_hour_bin_risk", oracle(f"""
SELECT hour_bin, count(*) AS count, {r('avg(TARGET) * 100')} AS default_rate, {_BIN_ORDER_SQL} AS bin_order
FROM (SELECT {_HOUR_BIN_SQL} AS hour_bin, TARGET FROM applications) t GROUP BY hour_bin"""))
def j11_hour_bin_risk(spark, sf_dir):
    """Count and default rate per hour bin, in clock order (flagship)."""
    return charts.hour_bin_risk(apps(spark, sf_dir))


@register("j10_hourly_risk", oracle(f"""
SELECT HOUR_APPR_PROCESS_START AS hour, count(*) AS count, {r('avg(TARGET)')} AS default_rate,
       {r('avg(TARGET) * 100')} AS default_rate_pct
FROM applications GROUP BY HOUR_APPR_PROCESS_START"""))
def j10_hourly_risk(spark, sf_dir):
    """Per hour: count, default rate, rate in percent."""
    return charts.hourly_risk(apps(spark, sf_dir))


@register("j12_class_counts", oracle("SELECT TARGET, count(*) AS count FROM applications GROUP BY TARGET"))
def j12_class_counts(spark, sf_dir):
    """Target distribution."""
    return charts.class_counts(apps(spark, sf_dir))


@register("j5_count_and_rate", oracle(f"""
SELECT NAME_INCOME_TYPE, count(*) AS count, {r('avg(TARGET) * 100')} AS default_rate
FROM applications WHERE NAME_INCOME_TYPE IS NOT NULL GROUP BY NAME_INCOME_TYPE"""))
def j5_count_and_rate(spark, sf_dir):
    """Count and default rate per income type."""
    return charts.count_and_rate(apps(spark, sf_dir), "NAME_INCOME_TYPE")


@register("j2_discrete_counts", oracle("""
SELECT CNT_FAM_MEMBERS, count(*) AS count FROM applications
WHERE CNT_FAM_MEMBERS IS NOT NULL GROUP BY CNT_FAM_MEMBERS"""))
def j2_discrete_counts(spark, sf_dir):
    """Counts of a discrete column by value."""
    return charts.discrete_counts(apps(spark, sf_dir), "CNT_FAM_MEMBERS")


_TOPK_SQL = """
, c AS (SELECT CAST(ORGANIZATION_TYPE AS VARCHAR) AS category, count(*) AS cnt
        FROM applications WHERE ORGANIZATION_TYPE IS NOT NULL GROUP BY 1)
, rk AS (SELECT category, cnt, row_number() OVER (ORDER BY cnt DESC, category ASC) AS rn FROM c)
, lab AS (SELECT CASE WHEN rn <= 10 THEN category ELSE 'Others' END AS category, rn <= 10 AS top, cnt FROM rk)
, g AS (SELECT category, top, sum(cnt) AS cnt FROM lab GROUP BY category, top)
SELECT CAST(row_number() OVER (ORDER BY top DESC, cnt DESC, category ASC) AS INTEGER) AS rank, category,
       CAST(cnt AS BIGINT) AS count, round_even(CAST(cnt AS DOUBLE) * 100.0 / sum(cnt) OVER (), 1) AS percent
FROM g"""


@register("j3_topk_others", oracle(_TOPK_SQL))
def j3_topk_others(spark, sf_dir):
    """Top 10 organisation types, the rest as Others, with percent."""
    return charts.topk_others(apps(spark, sf_dir), "ORGANIZATION_TYPE", 10)


_J4_COLS = ["NAME_INCOME_TYPE", "ORGANIZATION_TYPE", "OCCUPATION_TYPE"]
_J4_SQL = (", long AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS col, CAST({c} AS VARCHAR) AS value FROM applications WHERE {c} IS NOT NULL"
    for c in _J4_COLS) + """)
, cnt AS (SELECT col, value, count(*) AS n FROM long GROUP BY col, value)
, rk AS (SELECT col, n, row_number() OVER (PARTITION BY col ORDER BY n DESC, value) AS rn FROM cnt)
, per AS (SELECT col, greatest(max(CASE WHEN rn <= 10 THEN n END),
                              sum(n) - sum(CASE WHEN rn <= 10 THEN n ELSE 0 END)) AS peak FROM rk GROUP BY col)
SELECT """ + r("max(peak) * 1.2") + " AS y_limit FROM per")


@register("j4_shared_axis_limit", oracle(_J4_SQL))
def j4_shared_axis_limit(spark, sf_dir):
    """Common y-limit for top-10 charts of three columns."""
    return charts.shared_axis_limit(apps(spark, sf_dir), _J4_COLS, 10)


_J7_SQL = """
, tot AS (SELECT sum(CASE WHEN TARGET = 1 THEN 1 ELSE 0 END) AS n1, sum(CASE WHEN TARGET = 0 THEN 1 ELSE 0 END) AS n0
          FROM applications)
, g AS (SELECT CAST(ORGANIZATION_TYPE AS VARCHAR) AS category,
               sum(CASE WHEN TARGET = 1 THEN 1 ELSE 0 END) AS c1, sum(CASE WHEN TARGET = 0 THEN 1 ELSE 0 END) AS c0
        FROM applications WHERE ORGANIZATION_TYPE IS NOT NULL GROUP BY 1)
, p AS (SELECT category, CAST(c1 AS DOUBLE) * 100.0 / n1 AS default_pct, CAST(c0 AS DOUBLE) * 100.0 / n0 AS non_default_pct
        FROM g, tot)
, a AS (SELECT category, default_pct, non_default_pct, default_pct - non_default_pct AS diff,
               abs(default_pct - non_default_pct) / ((default_pct + non_default_pct) / 2 + 1e-10) AS amp_raw FROM p)
SELECT category, round_even(default_pct, 3) AS default_pct, round_even(non_default_pct, 3) AS non_default_pct,
       round_even(diff, 3) AS diff, round_even(amp_raw, 3) AS amplitude
FROM a ORDER BY amp_raw DESC, category ASC LIMIT 10"""


@register("j7_amplitude", oracle(_J7_SQL))
def j7_amplitude(spark, sf_dir):
    """Organisation types whose class shares differ most (top 10)."""
    return charts.amplitude(apps(spark, sf_dir), "ORGANIZATION_TYPE", "TARGET", 10)


_J1_SQL = """
, v AS (SELECT CAST(AMT_CREDIT AS DOUBLE) AS x FROM applications WHERE AMT_CREDIT IS NOT NULL)
, s AS (SELECT min(x) AS lo, (max(x) - min(x)) / 30 AS width, avg(x) AS mean, quantile_cont(x, 0.5) AS med FROM v)
, c AS (SELECT least(CAST(floor((x - lo) / width) AS INTEGER), 29) AS bin, count(*) AS cnt FROM v, s GROUP BY 1)
, grid AS (SELECT CAST(range AS INTEGER) AS bin FROM range(30))
SELECT grid.bin AS bin, """ + r("lo + grid.bin * width") + " AS \"left\", " + r("lo + (grid.bin + 1) * width") + \
    """ AS "right", CAST(coalesce(cnt, 0) AS BIGINT) AS count, """ + r("mean") + " AS mean, " + r("med") + \
    """ AS median
FROM grid CROSS JOIN s LEFT JOIN c ON grid.bin = c.bin"""


@register("j1_histogram", oracle(_J1_SQL))
def j1_histogram(spark, sf_dir):
    """30-bin histogram of the credit amount with mean and median."""
    return charts.histogram(apps(spark, sf_dir), "AMT_CREDIT", 30)


_QPROBS = [i / 10 for i in range(11)]
_J8_SQL = (", v AS (SELECT EXT_SOURCE_2 AS x, TARGET FROM applications WHERE EXT_SOURCE_2 IS NOT NULL AND TARGET IS NOT NULL)"
           ", q AS (SELECT " + ", ".join(f"quantile_cont(x, {p}) AS q{i}" for i, p in enumerate(_QPROBS)) + " FROM v)"
           ", e0 AS (" + " UNION ALL ".join(f"SELECT q{i} AS e FROM q" for i in range(11)) + ")"
           """
, e AS (SELECT e, CAST(row_number() OVER (ORDER BY e) - 1 AS INTEGER) AS i FROM (SELECT DISTINCT e FROM e0) d)
, bins AS (SELECT a.i AS idx, a.e AS lo, b.e AS hi FROM e a JOIN e b ON b.i = a.i + 1)
SELECT bins.idx AS "order", """ + r("bins.lo") + " AS \"left\", " + r("bins.hi") + """ AS "right",
       count(*) AS count, """ + r("avg(TARGET) * 100") + """ AS default_rate
FROM v JOIN bins ON (v.x > bins.lo OR (bins.idx = 0 AND v.x = bins.lo)) AND v.x <= bins.hi
GROUP BY bins.idx, bins.lo, bins.hi""")


@register("j8_ordered_rate", oracle(_J8_SQL))
def j8_ordered_rate(spark, sf_dir):
    """Default rate over exact deciles of EXT_SOURCE_2 (right-closed bins)."""
    return charts.ordered_rate(apps(spark, sf_dir), "EXT_SOURCE_2", "TARGET", 10).drop("label")


_EDU_CASE = "CASE NAME_EDUCATION_TYPE " + " ".join(
    f"WHEN '{v}' THEN {i}" for i, v in enumerate(EDUCATION_ORDER)) + " END"


@register("j8_ordered_rate_mapped", oracle(f"""
SELECT CAST({_EDU_CASE} AS INTEGER) AS "order", NAME_EDUCATION_TYPE AS label, CAST(NULL AS DOUBLE) AS "left",
       CAST(NULL AS DOUBLE) AS "right", count(*) AS count, {r('avg(TARGET) * 100')} AS default_rate
FROM applications WHERE NAME_EDUCATION_TYPE IS NOT NULL AND TARGET IS NOT NULL AND ({_EDU_CASE}) IS NOT NULL
GROUP BY NAME_EDUCATION_TYPE"""))
def j8_ordered_rate_mapped(spark, sf_dir):
    """J8 with an ordinal mapping: education levels in their natural order."""
    return charts.ordered_rate(apps(spark, sf_dir), "NAME_EDUCATION_TYPE", "TARGET", order=EDUCATION_ORDER)


_J9_SQL = """
, q AS (SELECT CAST(TARGET AS VARCHAR) AS grp, quantile_cont(AMT_ANNUITY, 0.25) AS q1, quantile_cont(AMT_ANNUITY, 0.5) AS med,
               quantile_cont(AMT_ANNUITY, 0.75) AS q3 FROM applications WHERE AMT_ANNUITY IS NOT NULL GROUP BY TARGET)
, f AS (SELECT grp, q1, med, q3, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT f.grp AS "group", count(a.AMT_ANNUITY) AS count, """ + r("f.q1") + " AS q1, " + r("f.med") + " AS median, " + \
    r("f.q3") + " AS q3, " + r("min(CASE WHEN a.AMT_ANNUITY BETWEEN f.lo AND f.hi THEN a.AMT_ANNUITY END)") + \
    " AS whisker_low, " + r("max(CASE WHEN a.AMT_ANNUITY BETWEEN f.lo AND f.hi THEN a.AMT_ANNUITY END)") + \
    """ AS whisker_high, CAST(sum(CASE WHEN a.AMT_ANNUITY < f.lo OR a.AMT_ANNUITY > f.hi THEN 1 ELSE 0 END) AS BIGINT) AS outliers
FROM applications a JOIN f ON CAST(a.TARGET AS VARCHAR) = f.grp WHERE a.AMT_ANNUITY IS NOT NULL
GROUP BY f.grp, f.q1, f.med, f.q3"""


@register("j9_box_stats", oracle(_J9_SQL))
def j9_box_stats(spark, sf_dir):
    """Box-plot statistics of the annuity per target class."""
    return charts.box_stats(apps(spark, sf_dir), "AMT_ANNUITY", "TARGET")


# ------------------------------------------------------------ missingness
def _missing_union(cols) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing_count, "
        f"CAST(count(*) - count({c}) AS DOUBLE) * 100.0 / count(*) AS missing_percent FROM applications"
        for c in cols)


@register("c8_missing_summary", oracle(f"""
SELECT "column", missing_count, {r('missing_percent')} AS missing_percent FROM ({_missing_union(APP_COLUMNS)}) m"""))
def c8_missing_summary(spark, sf_dir):
    """NULL count and percent for every column, in one aggregate."""
    return profile.missing_summary(apps(spark, sf_dir))


@register("c9_missing_table", oracle(f"""
SELECT "column", missing_count, round_even(missing_percent, 2) AS missing_percent
FROM ({_missing_union(APP_COLUMNS)}) m WHERE missing_count > 0"""))
def c9_missing_table(spark, sf_dir):
    """Columns with any NULL, percent to 2 dp, most missing first."""
    return profile.missing_table(apps(spark, sf_dir))


_THRESH = ", ".join(f"({t})" for t in profile.COLUMN_THRESHOLDS)


@register("c10_missing_columns_over", oracle(f"""
, m AS ({_missing_union(APP_COLUMNS)})
, t AS (SELECT CAST(th AS INTEGER) AS threshold FROM (VALUES {_THRESH}) v(th))
SELECT t.threshold, count(m."column") AS column_count FROM t LEFT JOIN m ON m.missing_percent > t.threshold
GROUP BY t.threshold"""))
def c10_missing_columns_over(spark, sf_dir):
    """Number of columns with missing percent above each threshold."""
    return profile.missing_columns_over(apps(spark, sf_dir))


_ANY_NULL_SQL = " OR ".join(f"{c} IS NULL" for c in APP_COLUMNS)
_NULL_CNT_SQL = " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in APP_COLUMNS)


@register("c11_rows_with_missing", oracle(f"SELECT ID FROM applications WHERE {_ANY_NULL_SQL}"))
def c11_rows_with_missing(spark, sf_dir):
    """C11: ids of rows with at least one NULL."""
    return profile.rows_with_missing(apps(spark, sf_dir)).select("ID")


def _row_over_sql(where: str = "TRUE", cols=APP_COLUMNS) -> str:
    cnt = " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in cols)
    parts = " UNION ALL ".join(
        f"SELECT CAST({t} AS INTEGER) AS threshold, CAST(sum(CASE WHEN p > {t} THEN 1 ELSE 0 END) AS BIGINT) AS row_count, "
        f"round_even(CAST(sum(CASE WHEN p > {t} THEN 1 ELSE 0 END) AS DOUBLE) * 100.0 / count(*), 2) AS row_percent FROM p"
        for t in profile.ROW_THRESHOLDS)
    return f", p AS (SELECT ({cnt}) * 100.0 / {len(cols)} AS p FROM applications WHERE {where}) {parts}"


@register("c12_row_missing_over", oracle(_row_over_sql()))
def c12_row_missing_over(spark, sf_dir):
    """Rows whose NULL share exceeds each threshold."""
    return profile.row_missing_over(apps(spark, sf_dir))


_ALL_SOCIAL_NULL = " AND ".join(f"{c} IS NULL" for c in SOCIAL_COLS)


@register("c13_co_missing", oracle(f"""
SELECT CAST(sum(CASE WHEN {_ALL_SOCIAL_NULL} THEN 1 ELSE 0 END) AS BIGINT) AS rows_all_missing,
       coalesce(bool_and({' AND '.join(f'(({c} IS NULL) = ({SOCIAL_COLS[0]} IS NULL))' for c in SOCIAL_COLS[1:])}), TRUE)
       AS same_rows
FROM applications"""))
def c13_co_missing(spark, sf_dir):
    """Rows missing all four social-circle counts; same rows for all?"""
    return profile.co_missing(apps(spark, sf_dir), SOCIAL_COLS)


@register("c13_co_missing_bureau", oracle(f"""
SELECT CAST(sum(CASE WHEN {' AND '.join(f'{c} IS NULL' for c in BUREAU_COLS)} THEN 1 ELSE 0 END) AS BIGINT) AS rows_all_missing,
       coalesce(bool_and({' AND '.join(f'(({c} IS NULL) = ({BUREAU_COLS[0]} IS NULL))' for c in BUREAU_COLS[1:])}), TRUE)
       AS same_rows
FROM applications"""))
def c13_co_missing_bureau(spark, sf_dir):
    """C13 on the six bureau windows."""
    return profile.co_missing(apps(spark, sf_dir), BUREAU_COLS)


@register("c14_co_missing_rows", oracle(_row_over_sql(_ALL_SOCIAL_NULL)))
def c14_co_missing_rows(spark, sf_dir):
    """C14: the rows missing every social count, profiled with C12."""
    return profile.row_missing_over(profile.co_missing_rows(apps(spark, sf_dir), SOCIAL_COLS))


_a, _b, _c = [f"({c} IS NULL)" for c in EXT_COLS]


def _s(e):
    return f"CAST(sum(CASE WHEN {e} THEN 1 ELSE 0 END) AS BIGINT)"


@register("c15_missing_combinations", oracle(f"""
SELECT {_s(_a)} AS missing_1, {_s(_b)} AS missing_2, {_s(_c)} AS missing_3,
       {_s(f'{_a} AND {_b} AND NOT {_c}')} AS missing_12_only, {_s(f'{_a} AND {_c} AND NOT {_b}')} AS missing_13_only,
       {_s(f'{_b} AND {_c} AND NOT {_a}')} AS missing_23_only, {_s(f'{_a} AND {_b} AND {_c}')} AS missing_all,
       {_s(f'NOT {_a} AND NOT {_b} AND NOT {_c}')} AS missing_none,
       {_s(f'CAST({_a} AS INTEGER) + CAST({_b} AS INTEGER) + CAST({_c} AS INTEGER) = 1')} AS missing_exactly_one,
       {_s(f'{_a} AND NOT {_b} AND NOT {_c}')} AS missing_1_only, {_s(f'{_b} AND NOT {_a} AND NOT {_c}')} AS missing_2_only
FROM applications"""))
def c15_missing_combinations(spark, sf_dir):
    """Missingness combinations of the three external scores."""
    return profile.missing_combinations(apps(spark, sf_dir), EXT_COLS)


_LATTICE_COLS = sorted([*EXT_COLS, *SOCIAL_COLS[:2], "OWN_CAR_AGE", "OCCUPATION_TYPE", "AMT_ANNUITY", "AMT_REQ_CREDIT_BUREAU_DAY", "NAME_TYPE_SUITE"])
_SUBSETS = [x for n in (1, 2, 3) for x in combinations(_LATTICE_COLS, n)]


@register("c15_missing_lattice", oracle(", m AS (SELECT " + " + ".join(
    f"CASE WHEN {c} IS NULL THEN {1 << i} ELSE 0 END" for i, c in enumerate(_LATTICE_COLS)) + " AS mask FROM applications), "
    "s AS (SELECT * FROM (VALUES " + ", ".join(
        f"('{','.join(x)}', {len(x)}, {sum(1 << _LATTICE_COLS.index(c) for c in x)})" for x in _SUBSETS) + ") v(cols, n, bits)) "
    """SELECT cols AS columns, n AS n_columns, CAST(count(*) AS BIGINT) AS rows_all_missing,
       CAST(count(*) FILTER (WHERE mask = bits) AS BIGINT) AS rows_only_these
FROM s JOIN m ON mask & bits = bits GROUP BY cols, n"""))
def c15_missing_lattice(spark, sf_dir):
    """C13–C15 for all sets of up to three of ten columns, from one pass of pattern counts."""
    return profile.missing_lattice(apps(spark, sf_dir), _LATTICE_COLS, 3)


_PATTERN_COLS = [*EXT_COLS, *SOCIAL_COLS, *BUREAU_COLS, "OCCUPATION_TYPE", "AMT_ANNUITY"]
_TOGETHER = [EXT_COLS, SOCIAL_COLS, BUREAU_COLS, [*EXT_COLS[:2], "OCCUPATION_TYPE"], ["AMT_ANNUITY"], []]


@register("c13_missing_together", oracle(" UNION ALL ".join(
    f"SELECT '{','.join(sorted(x))}' AS columns, CAST(count(*) FILTER (WHERE {' AND '.join(['TRUE', *(f'{c} IS NULL' for c in x)])}) AS BIGINT) "
    f"AS rows_all_missing, CAST(count(*) FILTER (WHERE {' AND '.join((c + ' IS NULL') if c in x else (c + ' IS NOT NULL') for c in _PATTERN_COLS)}) AS BIGINT) "
    "AS rows_only_these FROM applications" for x in _TOGETHER)))
def c13_missing_together(spark, sf_dir):
    """Rows missing all of, and exactly, each listed column set, from the pattern table of fifteen columns."""
    patterns = profile.missing_patterns(apps(spark, sf_dir), _PATTERN_COLS)
    return profile.missing_together(patterns, _TOGETHER)


_M14_COLS = ["AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY", "EXT_SOURCE_1", "OWN_CAR_AGE"]
_M14_PROBS = [0.01, 0.25, 0.5, 0.9, 0.999]


@register("m14_kept_sketches", oracle(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST({p} AS DOUBLE) AS p, {r(f'quantile_cont({c}, {p})')} AS exact, TRUE AS approximate_within FROM applications"
    for c in _M14_COLS for p in _M14_PROBS)))
def m14_kept_sketches(spark, sf_dir):
    """Quantiles from sketches kept by hour and merged; each is checked against its exact rank, and stands beside the exact value."""
    df = apps(spark, sf_dir)
    path = scratch_path(spark, "sketches")
    quantiles.sketch_table(df, _M14_COLS, by=["HOUR_APPR_PROCESS_START"]).write.parquet(path)
    found = quantiles.approximate_quantiles(quantiles.merge_sketches(spark.read.parquet(path)), _M14_PROBS).collect()
    # Shares of values below, and up to, each approximate quantile: one pass.
    at = df.agg(*[F.avg(F.when(F.col(q["column"]).isNotNull(), (F.col(q["column"]) < q["value"]).cast("double"))).alias(f"lo{j}") for j, q in enumerate(found)],
                *[F.avg(F.when(F.col(q["column"]).isNotNull(), (F.col(q["column"]) <= q["value"]).cast("double"))).alias(f"hi{j}") for j, q in enumerate(found)]).first()
    exact, slack = quantiles.exact_quantiles(df, _M14_COLS, _M14_PROBS), 2 * quantiles.RANK_ERROR
    rows = [(q["column"], q["p"], exact[q["column"]][q["p"]], at[f"lo{j}"] - slack <= q["p"] <= at[f"hi{j}"] + slack) for j, q in enumerate(found)]
    return spark.createDataFrame(rows, "column string, p double, exact double, approximate_within boolean")


@register("c16_missing_bands", oracle(f"""
SELECT "column", missing_count, {r('missing_percent')} AS missing_percent,
       CASE WHEN missing_percent < 5 THEN 'LOW_<5%' WHEN missing_percent < 30 THEN 'MEDIUM_5-30%' ELSE 'HIGH_>=30%' END AS band
FROM ({_missing_union(APP_COLUMNS)}) m"""))
def c16_missing_bands(spark, sf_dir):
    """Each column's missing band."""
    return profile.missing_bands(apps(spark, sf_dir))


# --------------------------------------------------------------- B, H4, D
@register("b1_drop_columns", oracle("SELECT * EXCLUDE (ID, TARGET) FROM applications"), round_doubles=False)
def b1_drop_columns(spark, sf_dir):
    """B1: drop ID, TARGET and an absent name (ignored)."""
    return profile.drop_columns(apps(spark, sf_dir), ["ID", "TARGET", "NOT_A_COLUMN"])


@register("b2_select_columns", oracle("SELECT ID, TARGET, AMT_CREDIT, NAME_CONTRACT_TYPE FROM applications"))
def b2_select_columns(spark, sf_dir):
    """B2: fixed projection."""
    return profile.select_columns(apps(spark, sf_dir), ["ID", "TARGET", "AMT_CREDIT", "NAME_CONTRACT_TYPE"])


def _numeric_app_cols(spark, sf_dir):
    return [c for c, t in apps(spark, sf_dir).dtypes if t in NUMERIC_TYPES]


_NUMERIC_APP = [c for c in APP_COLUMNS if not c.startswith("NAME_") and c not in (
    "CODE_GENDER", "FLAG_OWN_CAR", "FLAG_OWN_REALTY", "OCCUPATION_TYPE", "ORGANIZATION_TYPE",
    "WEEKDAY_APPR_PROCESS_START")]


@register("b3_select_numeric", oracle(f"SELECT {', '.join(_NUMERIC_APP)} FROM applications"), round_doubles=False)
def b3_select_numeric(spark, sf_dir):
    """Numeric columns only."""
    return profile.select_numeric(apps(spark, sf_dir))


_B4_SQL = " UNION ALL ".join(
    (f"SELECT '{c}' AS variable, 'ordinal' AS type" if c == "NAME_EDUCATION_TYPE" else
     f"SELECT '{c}' AS variable, CASE WHEN count(DISTINCT {c}) <= 20 THEN 'discrete' ELSE 'continuous' END AS type "
     f"FROM applications" if c in _NUMERIC_APP else
     f"SELECT '{c}' AS variable, 'nominal' AS type")
    for c in APP_COLUMNS)


@register("b4_classify_variables", oracle(_B4_SQL))
def b4_classify_variables(spark, sf_dir):
    """Ordinal / discrete / continuous / nominal per column."""
    return profile.classify_variables(apps(spark, sf_dir), ordinal_cols=["NAME_EDUCATION_TYPE"])


@register("b5_drop_incomplete_rows", oracle(f"SELECT ID, TARGET FROM applications WHERE NOT ({_ANY_NULL_SQL})"))
def b5_drop_incomplete_rows(spark, sf_dir):
    """Rows without any NULL."""
    return profile.drop_incomplete_rows(apps(spark, sf_dir)).select("ID", "TARGET")


@register("b6_filter", oracle("""
SELECT ID, HOUR_APPR_PROCESS_START, NAME_INCOME_TYPE FROM applications
WHERE HOUR_APPR_PROCESS_START BETWEEN 9 AND 17 AND NAME_INCOME_TYPE IN ('Working', 'Pensioner')
  AND OCCUPATION_TYPE IS NOT NULL AND NOT (CODE_GENDER = 'XNA') AND (TARGET = 1 OR AMT_CREDIT > 100000)"""))
def b6_filter(spark, sf_dir):
    """Equality, null test, inclusive range, isin, and/or/not."""
    c = F.col
    pred = (c("HOUR_APPR_PROCESS_START").between(9, 17) & c("NAME_INCOME_TYPE").isin("Working", "Pensioner")
            & c("OCCUPATION_TYPE").isNotNull() & ~(c("CODE_GENDER") == "XNA")
            & ((c("TARGET") == 1) | (c("AMT_CREDIT") > 100000)))
    return profile.where(apps(spark, sf_dir), pred).select("ID", "HOUR_APPR_PROCESS_START", "NAME_INCOME_TYPE")


_B7_KEEP = EXT_COLS + SOCIAL_COLS
_B7_SQL = f"""SELECT "column" FROM ({_missing_union(APP_COLUMNS)}) m
WHERE missing_percent < 30 OR "column" IN ({', '.join(f"'{c}'" for c in _B7_KEEP)})"""


@register("b7_drop_sparse_columns", oracle(_B7_SQL))
def b7_drop_sparse_columns(spark, sf_dir):
    """Columns kept after dropping those >= 30% missing (scores and
    social-circle counts are exempt)."""
    kept = profile.drop_sparse_columns(apps(spark, sf_dir), 0.3, keep=_B7_KEEP).columns
    return spark.createDataFrame([(c,) for c in kept], "column string")


_B8_COLS = ["AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY", "AMT_GOODS_PRICE", "EXT_SOURCE_2"]
_B8_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS count, {r(f'avg({c})')} AS mean, {r(f'stddev_samp({c})')} AS std, "
    f"{r(f'min({c})')} AS min, {r(f'quantile_cont({c}, 0.25)')} AS p25, {r(f'quantile_cont({c}, 0.5)')} AS p50, "
    f"{r(f'quantile_cont({c}, 0.75)')} AS p75, {r(f'max({c})')} AS max FROM applications" for c in _B8_COLS)


@register("b8_describe", oracle(_B8_SQL))
def b8_describe(spark, sf_dir):
    """Exact describe of the amount columns."""
    return profile.describe(apps(spark, sf_dir), _B8_COLS)


@register("b8_info", oracle(" UNION ALL ".join(
    f"SELECT CAST({i} AS INTEGER) AS place, '{c}' AS \"column\", lower(replace(replace(typeof(any_value({c})), 'VARCHAR', 'string'), 'INTEGER', 'int')) AS dtype, "
    f"count({c}) AS non_null_count FROM applications" for i, c in enumerate(APP_COLUMNS))))
def b8_info(spark, sf_dir):
    """Type and non-null count of every column."""
    return profile.info(apps(spark, sf_dir))


@register("b8_shape", oracle(f"SELECT count(*) AS rows, CAST({len(APP_COLUMNS)} AS BIGINT) AS columns FROM applications"))
def b8_shape(spark, sf_dir):
    """Rows and columns."""
    return profile.shape(apps(spark, sf_dir))


@register("b9_top_n", oracle("SELECT ID, AMT_CREDIT FROM applications ORDER BY AMT_CREDIT DESC, ID ASC LIMIT 10"))
def b9_top_n(spark, sf_dir):
    """Ten largest credits, id as tie-break."""
    return profile.top_n(apps(spark, sf_dir).select("ID", "AMT_CREDIT"),
                         [F.desc("AMT_CREDIT"), F.asc("ID")], 10)


@register("h4_value_counts", oracle("""
SELECT NAME_TYPE_SUITE, count(*) AS count FROM applications GROUP BY NAME_TYPE_SUITE"""))
def h4_value_counts(spark, sf_dir):
    """H4: value counts keeping the NULL group."""
    return profile.value_counts(apps(spark, sf_dir), "NAME_TYPE_SUITE", dropna=False)


@register("d5_duplicate_ids", oracle("""
SELECT count(*) AS total_rows, count(DISTINCT ID) AS distinct_ids, count(*) - count(DISTINCT ID) AS duplicate_rows,
       count(*) - count(DISTINCT ID) > 0 AS has_duplicates FROM applications"""))
def d5_duplicate_ids(spark, sf_dir):
    """Duplicate-id profile."""
    return profile.duplicate_ids(apps(spark, sf_dir))


@register("d6_validity_report", oracle(quality.VALIDITY_ORACLE_BODY))
def d6_validity_report(spark, sf_dir):
    """Named validity checks with the number of rows failing each."""
    return quality.validity_report(apps(spark, sf_dir))


_D1_COLS = ["AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY", "CNT_FAM_MEMBERS", "OBS_30_CNT_SOCIAL_CIRCLE",
            "DAYS_EMPLOYED"]


def _d1_sql(cols) -> str:
    parts = []
    for c in cols:
        parts.append(
            f"SELECT '{c}' AS \"column\", CAST(sum(CASE WHEN {c} < lo OR {c} > hi THEN 1 ELSE 0 END) AS BIGINT) AS outliers, "
            f"round_even(CAST(sum(CASE WHEN {c} < lo OR {c} > hi THEN 1 ELSE 0 END) AS DOUBLE) * 100.0 / count({c}), 2) "
            f"AS outlier_percent, {r('lo')} AS lower, {r('hi')} AS upper FROM applications, "
            f"(SELECT quantile_cont({c}, 0.25) - 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS lo, "
            f"quantile_cont({c}, 0.75) + 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS hi "
            f"FROM applications) f GROUP BY lo, hi")
    return " UNION ALL ".join(parts)


@register("d1_iqr_outlier_summary", oracle(_d1_sql(_D1_COLS)))
def d1_iqr_outlier_summary(spark, sf_dir):
    """IQR outliers per numeric column (count, percent of non-null)."""
    return quality.iqr_outlier_summary(apps(spark, sf_dir), _D1_COLS)


_J6_SQL = """
, v AS (SELECT CAST(TARGET AS VARCHAR) AS cls, CAST(EXT_SOURCE_2 AS DOUBLE) AS x FROM applications
        WHERE EXT_SOURCE_2 IS NOT NULL AND TARGET IS NOT NULL)
, m AS (SELECT cls, count(*) AS n, avg(x) AS mean,
               CASE WHEN stddev_samp(x) > 0 THEN stddev_samp(x) * pow(count(*), -0.2) ELSE 1.0 END AS bw,
               min(x) AS lo, max(x) AS hi FROM v GROUP BY cls)
, g AS (SELECT m.cls, m.n, m.mean, m.bw, CAST(gi.range AS BIGINT) AS grid_index,
               (m.lo - 2 * m.bw) + gi.range * ((m.hi + 2 * m.bw) - (m.lo - 2 * m.bw)) / 99 AS gx
        FROM m CROSS JOIN range(100) gi)
SELECT g.cls AS TARGET, """ + r("g.mean") + """ AS mean, g.grid_index, """ + r("g.gx") + """ AS x,
       """ + r("sum(exp(-0.5 * pow((g.gx - v.x) / g.bw, 2))) / (g.n * g.bw * sqrt(2 * pi()))") + """ AS density
FROM g JOIN v ON v.cls = g.cls GROUP BY g.cls, g.mean, g.grid_index, g.gx, g.n, g.bw"""


@register("j6_distribution_by_target", oracle(_J6_SQL))
def j6_distribution_by_target(spark, sf_dir):
    """Per-class Gaussian KDE of EXT_SOURCE_2 on a 100-point grid (exact)."""
    return charts.distribution_by_target(apps(spark, sf_dir), "EXT_SOURCE_2", "TARGET")
