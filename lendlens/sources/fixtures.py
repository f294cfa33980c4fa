"""The deterministic ``applications`` view over the supplied test tables.

The supplied tables hold no nulls, sentinels or rare classes, so this plain
SQL (accepted by both Spark and DuckDB) derives a loan-application table with
the shapes the operators must handle. It is test input only: no operator
takes a shortcut from how these rows are made.

``APPS_CTES`` is a ``WITH`` clause that defines ``b`` and ``applications``;
oracle SQL strings continue it with ``, more AS (...) SELECT ...`` or just
``SELECT ...``.
"""

from __future__ import annotations

_BASE_CTE = """b AS (
  SELECT o.o_orderkey AS k, o.o_totalprice AS price, o.o_orderpriority AS prio,
         c.c_acctbal AS bal, c.c_mktsegment AS seg, n.n_name AS nation,
         (o.o_orderkey * o.o_orderkey * 31 + o.o_orderkey * 7919) % 10007 AS h1,
         (o.o_orderkey * o.o_orderkey * 17 + o.o_orderkey * 104729) % 10009 AS h2,
         (o.o_orderkey * o.o_orderkey * 13 + o.o_orderkey * 1299709) % 10037 AS h3,
         (o.o_orderkey * o.o_orderkey * 7 + o.o_orderkey * 15485863) % 10039 AS h4,
         (o.o_orderkey * o.o_orderkey * 11 + o.o_orderkey * 611953) % 10061 AS h5
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
                JOIN nation n ON c.c_nationkey = n.n_nationkey)"""

_FLAG_DOC_MODULI = [11, None, 23, 32, 43, 56, 71, 88, 107, 128, 151, 176, 203, 232,
                    263, 296, 331, 368, 407, 448]


def _flag_docs() -> str:
    parts = []
    for i, m in zip(range(2, 22), _FLAG_DOC_MODULI):
        cond = "k % 3 <> 0" if m is None else f"k % {m} = 0"
        parts.append(f"  CAST(CASE WHEN {cond} THEN 1 ELSE 0 END AS BIGINT) AS FLAG_DOCUMENT_{i}")
    return ",\n".join(parts)


_SELECT = """SELECT
  k AS ID,
  CAST(CASE WHEN h1 % 1000 < 40 + CASE WHEN h4 % 1000 < 250 THEN 110 ELSE 0 END
       + CASE WHEN h2 % 100 < 3 THEN 60 ELSE 0 END THEN 1 ELSE 0 END AS BIGINT) AS TARGET,
  CASE WHEN k % 10 = 0 THEN 'Revolving loans' ELSE 'Cash loans' END AS NAME_CONTRACT_TYPE,
  CASE WHEN k % 400 = 3 THEN 'XNA' WHEN k % 3 = 0 THEN 'M' ELSE 'F' END AS CODE_GENDER,
  CASE WHEN k % 3 = 1 THEN 'Y' ELSE 'N' END AS FLAG_OWN_CAR,
  CASE WHEN k % 5 < 3 THEN 'Y' ELSE 'N' END AS FLAG_OWN_REALTY,
  CASE WHEN k % 3 = 1 AND k % 17 <> 0 THEN CAST((k * 11) % 40 AS DOUBLE) END AS OWN_CAR_AGE,
  bal * 10 + 130000 + CASE WHEN k % 499 = 0 THEN 5000000 ELSE 0 END AS AMT_INCOME_TOTAL,
  price AS AMT_CREDIT,
  CASE WHEN k % 501 <> 0 THEN price / (12 + k % 24) END AS AMT_ANNUITY,
  CASE WHEN k % 97 <> 0 THEN price * 9e-1 END AS AMT_GOODS_PRICE,
  CASE WHEN k % 200 = 0 THEN NULL WHEN k % 8 < 6 THEN 'Unaccompanied' WHEN k % 8 = 6 THEN 'Family'
       WHEN k % 16 = 7 THEN 'Spouse, partner' WHEN k % 32 = 15 THEN 'Children' ELSE 'Other_A' END AS NAME_TYPE_SUITE,
  CASE seg WHEN 'AUTOMOBILE' THEN 'Working' WHEN 'BUILDING' THEN 'Pensioner' WHEN 'FURNITURE' THEN 'Commercial associate'
           WHEN 'MACHINERY' THEN 'State servant' ELSE 'Unemployed' END AS NAME_INCOME_TYPE,
  CASE prio WHEN '1-URGENT' THEN 'Lower secondary' WHEN '2-HIGH' THEN 'Secondary / secondary special'
            WHEN '3-MEDIUM' THEN 'Incomplete higher' WHEN '4-NOT SPECIFIED' THEN 'Higher education'
            ELSE 'Academic degree' END AS NAME_EDUCATION_TYPE,
  CASE k % 4 WHEN 0 THEN 'Married' WHEN 1 THEN 'Single / not married' WHEN 2 THEN 'Widow' ELSE 'Separated' END AS NAME_FAMILY_STATUS,
  CASE WHEN k % 9 = 0 THEN 'Rented apartment' WHEN k % 9 = 1 THEN 'With parents' ELSE 'House / apartment' END AS NAME_HOUSING_TYPE,
  CASE WHEN k % 3 = 2 THEN NULL WHEN k % 7 = 0 THEN 'Managers' WHEN k % 7 < 3 THEN 'Drivers' WHEN k % 7 < 5 THEN 'Core staff' ELSE 'Laborers' END AS OCCUPATION_TYPE,
  CASE WHEN k % 211 <> 0 THEN nation END AS ORGANIZATION_TYPE,
  CASE WHEN k % 409 <> 0 THEN CAST(1 + (k * 3) % 5 AS DOUBLE) END AS CNT_FAM_MEMBERS,
  -(7500 + (k * 89) % 17500) AS DAYS_BIRTH,
  CASE WHEN seg = 'BUILDING' THEN 365243 ELSE -((k * 53) % 12000) END AS DAYS_EMPLOYED,
  CASE WHEN k % 613 <> 0 THEN CAST(-((k * 29) % 3000) AS DOUBLE) END AS DAYS_LAST_PHONE_CHANGE,
  CASE h5 % 7 WHEN 0 THEN 'MONDAY' WHEN 1 THEN 'TUESDAY' WHEN 2 THEN 'WEDNESDAY' WHEN 3 THEN 'THURSDAY'
             WHEN 4 THEN 'FRIDAY' WHEN 5 THEN 'SATURDAY' ELSE 'SUNDAY' END AS WEEKDAY_APPR_PROCESS_START,
  CAST(CASE WHEN h2 % 100 < 3 THEN h3 % 6 WHEN h2 % 100 < 48 THEN 6 + h3 % 6
            WHEN h2 % 100 < 95 THEN 12 + h3 % 6 ELSE 18 + h3 % 6 END AS BIGINT) AS HOUR_APPR_PROCESS_START,
  CASE WHEN k % 2 = 0 THEN ((h4 + h5) % 1000) / 1e3 END AS EXT_SOURCE_1,
  CASE WHEN k % 307 <> 0 THEN (h4 % 1000) / 1e3 END AS EXT_SOURCE_2,
  CASE WHEN k % 5 <> 0 THEN ((h4 % 1000) + (h3 % 1000)) / 2e3 END AS EXT_SOURCE_3,
  CASE WHEN k % 300 <> 0 THEN CAST(CASE WHEN k % 4999 = 1 THEN 348 ELSE h5 % 6 END AS DOUBLE) END AS OBS_30_CNT_SOCIAL_CIRCLE,
  CASE WHEN k % 300 <> 0 THEN CAST(CASE WHEN h3 % 9 = 0 THEN 1 ELSE 0 END AS DOUBLE) END AS DEF_30_CNT_SOCIAL_CIRCLE,
  CASE WHEN k % 300 <> 0 THEN CAST(CASE WHEN k % 4999 = 1 THEN 344 ELSE h5 % 5 END AS DOUBLE) END AS OBS_60_CNT_SOCIAL_CIRCLE,
  CASE WHEN k % 300 <> 0 THEN CAST(CASE WHEN h3 % 18 = 0 THEN 1 ELSE 0 END AS DOUBLE) END AS DEF_60_CNT_SOCIAL_CIRCLE,
  CASE WHEN k % 7 <> 0 THEN CAST(CASE WHEN k % 160 = 1 THEN 1 ELSE 0 END AS DOUBLE) END AS AMT_REQ_CREDIT_BUREAU_HOUR,
  CASE WHEN k % 7 <> 0 THEN CAST(CASE WHEN k % 180 = 1 THEN 2 ELSE 0 END AS DOUBLE) END AS AMT_REQ_CREDIT_BUREAU_DAY,
  CASE WHEN k % 7 <> 0 THEN CAST(CASE WHEN k % 33 = 1 THEN 1 WHEN k % 33 = 2 THEN 3 ELSE 0 END AS DOUBLE) END AS AMT_REQ_CREDIT_BUREAU_WEEK,
  CASE WHEN k % 7 <> 0 THEN CAST(CASE WHEN k % 6 = 0 THEN k % 5 ELSE 0 END AS DOUBLE) END AS AMT_REQ_CREDIT_BUREAU_MON,
  CASE WHEN k % 7 <> 0 THEN CAST(CASE WHEN k % 5 = 0 THEN k % 4 ELSE 0 END AS DOUBLE) END AS AMT_REQ_CREDIT_BUREAU_QRT,
  CASE WHEN k % 7 <> 0 THEN CAST((k * 17) % 9 AS DOUBLE) END AS AMT_REQ_CREDIT_BUREAU_YEAR,
""" + _flag_docs() + "\nFROM b"

#: Body of the view (``WITH b AS (...) SELECT ...``), as given in FIXTURES.md.
APPLICATIONS_SQL = "WITH " + _BASE_CTE + "\n" + _SELECT

#: Leading CTEs for oracle SQL: defines ``b`` and ``applications``.
APPS_CTES = "WITH " + _BASE_CTE + ",\napplications AS (\n" + _SELECT + "\n)\n"


def oracle(body: str) -> str:
    """Prefix an oracle query with the applications CTEs.

    ``body`` either starts with ``SELECT`` or with ``, name AS (...)`` to add
    further CTEs.
    """
    body = body.strip()
    if body.startswith(","):
        return APPS_CTES + body
    return APPS_CTES + body


def _column_names() -> list[str]:
    import re
    names = re.findall(r"\bAS ([A-Z][A-Z0-9_]*)\s*(?:,|$)", _SELECT, flags=re.M)
    return [n for n in names if n not in ("DOUBLE", "BIGINT")]


#: Columns of the applications view, in order.
APP_COLUMNS = _column_names()
