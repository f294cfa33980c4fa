"""Projection, filters and one-pass profiling reports.

Every report computes all its columns in a single ``agg`` (or one
``groupBy``) and unpivots the one-row result with ``stack``: one scan of the
base rows regardless of the number of columns.
"""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendlens.functions.exprs import NUMERIC_TYPES, any_null, np_round, row_null_count
from lendlens.functions.quantiles import exact_quantiles
from lendlens.operators.base import JsonTransformer


def _stack(row_df: DataFrame, entries: list[tuple[str, list[str]]], names: list[str]) -> DataFrame:
    """Unpivot a one-row frame: each entry is (label, [column refs])."""
    parts = []
    for label, refs in entries:
        parts.append(F.struct(F.lit(label).alias(names[0]),
                              *[F.col(r).alias(n) for r, n in zip(refs, names[1:])]))
    return row_df.select(F.explode(F.array(*parts)).alias("s")).select("s.*")


# ---------------------------------------------------------------- B1–B9
class DropColumns(JsonTransformer):
    """B1 as a pipeline stage: drop listed columns, ignoring absent names."""
    DEFAULTS = {"columns": []}

    def _transform(self, df: DataFrame) -> DataFrame:
        return drop_columns(df, self.opts["columns"])


def drop_columns(df: DataFrame, cols) -> DataFrame:
    """B1: drop listed columns; names that are absent are ignored."""
    return df.drop(*[c for c in cols if c in df.columns])


def select_columns(df: DataFrame, cols) -> DataFrame:
    """B2: fixed projection."""
    return df.select(*cols)


def select_numeric(df: DataFrame, exclude=()) -> DataFrame:
    """Keep numeric columns only."""
    return df.select(*[c for c, t in df.dtypes if t in NUMERIC_TYPES and c not in exclude])


def classify_variables(df: DataFrame, ordinal_cols=(), max_discrete: int = 20,
                       exclude=()) -> DataFrame:
    """(variable, type) — ordinal if listed; numeric with at most
    ``max_discrete`` distinct values → discrete, else continuous; text →
    nominal. Distinct counts come from ``distinct_counts_upto``."""
    cols = [c for c in df.columns if c not in exclude]
    numeric = [c for c, t in df.dtypes if c in cols and t in NUMERIC_TYPES and c not in ordinal_cols]
    counts = distinct_counts_upto(df, numeric, max_discrete)
    rows = []
    for c, t in df.dtypes:
        if c not in cols:
            continue
        if c in ordinal_cols:
            kind = "ordinal"
        elif t in NUMERIC_TYPES:
            kind = "discrete" if counts[c] <= max_discrete else "continuous"
        else:
            kind = "nominal"
        rows.append((c, kind))
    return df.sparkSession.createDataFrame(rows, "variable string, type string")


def distinct_counts_upto(df: DataFrame, cols, limit: int) -> dict[str, int]:
    """Exact distinct counts for columns with few values; ``limit + 1`` for the
    rest. Each task keeps at most ``limit + 1`` distinct values a column, so
    one pass decides for every column."""
    if not cols:
        return {}
    cols = list(cols)

    def few(it):
        seen = [set() for _ in cols]
        for pdf in it:
            for i, found in enumerate(seen):
                if len(found) <= limit:
                    found.update(pdf.iloc[:, i].dropna().unique()[:limit + 1])
        yield pd.DataFrame([(i, float(v)) for i, found in enumerate(seen) for v in list(found)[:limit + 1]], columns=["i", "v"])

    values = df.select(*[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(cols)]).mapInPandas(few, "i int, v double")
    rows = values.groupBy("i", "v").agg(F.lit(1).alias("one")).groupBy("i").agg(F.count("one").alias("n")).collect()
    got = {cols[r["i"]]: r["n"] for r in rows}
    return {c: min(got.get(c, 0), limit + 1) for c in cols}


def drop_incomplete_rows(df: DataFrame, subset=None) -> DataFrame:
    """Drop rows with a NULL in any (listed) column."""
    return df.na.drop(how="any", subset=subset)


def where(df: DataFrame, predicate: Column) -> DataFrame:
    """Boolean filter (equality, null tests, inclusive ``between``, ``isin``)."""
    return df.where(predicate)


def drop_sparse_columns(df: DataFrame, threshold: float = 0.3, keep=()) -> DataFrame:
    """Drop columns whose missing share is ``>= threshold`` unless kept."""
    row = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.count(c).alias(c) for c in df.columns]).first()
    n = row["__n"]
    if not n:
        return df
    drop = [c for c in df.columns if c not in keep and (n - row[c]) / n >= threshold]
    return df.drop(*drop)


def describe(df: DataFrame, cols=None) -> DataFrame:
    """Count, mean, sample std, min, exact quartiles, max per column."""
    cols = cols or [c for c, t in df.dtypes if t in NUMERIC_TYPES]
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}"),
                 F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
    row = df.agg(*aggs).first()
    q = exact_quantiles(df, cols, [0.25, 0.5, 0.75])
    data = [(c, int(row[f"n{i}"]), row[f"m{i}"], row[f"s{i}"], row[f"lo{i}"], q[c][0.25],
             q[c][0.5], q[c][0.75], row[f"hi{i}"]) for i, c in enumerate(cols)]
    return df.sparkSession.createDataFrame(
        data, "column string, count long, mean double, std double, min double, p25 double, "
              "p50 double, p75 double, max double")


def info(df: DataFrame) -> DataFrame:
    """(place, column, dtype, non_null_count) of every column, in order, from one pass."""
    counts = df.agg(*[F.count(F.col(c)).alias(f"n{i}") for i, c in enumerate(df.columns)])
    rows = F.array(*[F.struct(F.lit(i).alias("place"), F.lit(c).alias("column"), F.lit(t).alias("dtype"), F.col(f"n{i}").alias("non_null_count"))
                     for i, (c, t) in enumerate(df.dtypes)])
    return counts.select(F.explode(rows).alias("r")).select("r.*")


def shape(df: DataFrame) -> DataFrame:
    """(rows, columns)."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)).cast("long"))


def top_n(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """Sort with explicit tie-breaks, keep ``n`` rows (Spark plans a
    TakeOrderedAndProject: per-partition top-n, then a merge of n×partitions)."""
    return df.orderBy(*order).limit(n)


# ---------------------------------------------------------------- C8–C16
def missing_summary(df: DataFrame, cols=None) -> DataFrame:
    """Per column, NULL count and percent of rows."""
    cols = cols or df.columns
    # count(col) skips NULLs; total minus it is the NULL count (cheaper than
    # summing a cast null test per column).
    row = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count(c).alias(f"k{i}") for i, c in enumerate(cols)])
    miss = [(F.col("__n") - F.col(f"k{i}")) for i in range(len(cols))]
    parts = [F.struct(F.lit(c).alias("column"), miss[i].alias("missing_count"),
                      F.try_divide(miss[i] * 100.0, F.col("__n")).alias("missing_percent"))
             for i, c in enumerate(cols)]
    return row.select(F.explode(F.array(*parts)).alias("s")).select("s.*")


def missing_table(df: DataFrame, cols=None) -> DataFrame:
    """Columns with any NULL, percent rounded to 2, most missing first."""
    return (missing_summary(df, cols).where(F.col("missing_count") > 0)
            .withColumn("missing_percent", np_round("missing_percent", 2))
            .orderBy(F.desc("missing_percent"), F.asc("column")))


COLUMN_THRESHOLDS = [10, 20, 30, 40, 50, 55, 60, 70, 80, 90]
ROW_THRESHOLDS = [10, 20, 30, 40, 50, 60, 70, 80]


def missing_columns_over(df: DataFrame, thresholds=COLUMN_THRESHOLDS, cols=None) -> DataFrame:
    """Number of columns whose missing percent is ``>`` each threshold."""
    summary = missing_summary(df, cols)
    th = df.sparkSession.createDataFrame([(int(t),) for t in thresholds], "threshold int")
    # Tiny theta join: |columns| × |thresholds| rows, both bounded by the schema.
    return (F.broadcast(th).join(summary, summary["missing_percent"] > th["threshold"], "left")
            .groupBy("threshold").agg(F.count("column").alias("column_count")))


def rows_with_missing(df: DataFrame, cols=None) -> DataFrame:
    """C11: rows having a NULL in any (listed) column."""
    return df.where(any_null(cols or df.columns))


def row_missing_over(df: DataFrame, thresholds=ROW_THRESHOLDS, cols=None) -> DataFrame:
    """Share of NULLs per row × 100; rows over each threshold, count and
    percent of all rows (2 dp). One conditional sum per threshold."""
    cols = cols or df.columns
    pct = row_null_count(cols) * 100.0 / len(cols)
    base = df.select(pct.alias("p"))
    row = base.agg(F.count(F.lit(1)).alias("__n"),
                   *[F.coalesce(F.sum((F.col("p") > t).cast("long")), F.lit(0)).alias(f"c{i}")
                     for i, t in enumerate(thresholds)])
    parts = [F.struct(F.lit(int(t)).alias("threshold"), F.col(f"c{i}").alias("row_count"),
                      np_round(F.try_divide(F.col(f"c{i}") * 100.0, F.col("__n")), 2).alias("row_percent"))
             for i, t in enumerate(thresholds)]
    return row.select(F.explode(F.array(*parts)).alias("s")).select("s.*")


def co_missing(df: DataFrame, cols) -> DataFrame:
    """Rows missing in all listed columns, and whether every column is
    missing on exactly the same rows (set intersection/equality by predicate)."""
    nulls = [F.col(c).isNull() for c in cols]
    same = reduce(lambda a, b: a & b, [n == nulls[0] for n in nulls[1:]], F.lit(True))
    return df.agg(F.coalesce(F.sum(reduce(lambda a, b: a & b, nulls).cast("long")), F.lit(0)).alias("rows_all_missing"),
                  F.coalesce(F.bool_and(same), F.lit(True)).alias("same_rows"))


def co_missing_rows(df: DataFrame, cols) -> DataFrame:
    """C14: the rows missing in all listed columns."""
    return df.where(reduce(lambda a, b: a & b, [F.col(c).isNull() for c in cols]))


def missing_combinations(df: DataFrame, cols) -> DataFrame:
    """C15 (three columns a, b, c): per-column missing counts, each pair
    missing with the third present, all three, none, exactly one."""
    a, b, c = [F.col(x).isNull() for x in cols]
    s = lambda e: F.coalesce(F.sum(e.cast("long")), F.lit(0))
    one = (a.cast("int") + b.cast("int") + c.cast("int")) == 1
    return df.agg(
        s(a).alias("missing_1"), s(b).alias("missing_2"), s(c).alias("missing_3"),
        s(a & b & ~c).alias("missing_12_only"), s(a & c & ~b).alias("missing_13_only"),
        s(b & c & ~a).alias("missing_23_only"), s(a & b & c).alias("missing_all"),
        s(~a & ~b & ~c).alias("missing_none"), s(one).alias("missing_exactly_one"),
        s(a & ~b & ~c).alias("missing_1_only"), s(b & ~a & ~c).alias("missing_2_only"))


def missing_patterns(df: DataFrame, cols) -> DataFrame:
    """One row per set of columns that are missing together on some row: (missing, rows), ``missing`` in the order of ``cols``.

    A single pass counts the patterns (combined map-side); there are as many as the data shows, however many sets
    the columns have. Counts of any column set are sums over this table.
    """
    mask = F.concat(*[F.when(F.col(c).isNull(), F.lit("1")).otherwise(F.lit("0")) for c in cols])
    counts = df.select(mask.alias("mask")).groupBy("mask").agg(F.count(F.lit(1)).alias("rows"))
    names = F.transform(F.lit(list(cols)), lambda c, i: F.when(F.substr(F.col("mask"), i + 1, F.lit(1)) == "1", c))
    return counts.select(F.filter(names, lambda c: c.isNotNull()).alias("missing"), "rows")


def missing_together(patterns: DataFrame, sets) -> DataFrame:
    """(columns, rows_all_missing, rows_only_these) of each listed column set, from a table of ``missing_patterns``."""
    wanted = [sorted(x) for x in sets]
    sums = []
    for j, cols in enumerate(wanted):
        want, n = F.lit(cols) if cols else F.array().cast("array<string>"), len(cols)
        hit = F.size(F.array_intersect("missing", want)) == n
        sums += [F.coalesce(F.sum(F.when(hit, F.col("rows"))), F.lit(0)).alias(f"all{j}"),
                 F.coalesce(F.sum(F.when(hit & (F.size("missing") == n), F.col("rows"))), F.lit(0)).alias(f"only{j}")]
    cells = F.array(*[F.struct(F.array_join(F.lit(c), ",").alias("columns") if c else F.lit("").alias("columns"),
                               F.col(f"all{j}").alias("rows_all_missing"), F.col(f"only{j}").alias("rows_only_these")) for j, c in enumerate(wanted)])
    return patterns.agg(*sums).select(F.explode(cells).alias("c")).select("c.*")


def missing_lattice(df: DataFrame, cols, order: int = 3) -> DataFrame:
    """C13–C15 for every set of up to ``order`` columns that some row misses together: (columns, n_columns,
    rows_all_missing, rows_only_these).

    Superset sums over the pattern table: each pattern adds its rows to all its subsets, so the data is read once
    and sets that never occur cost nothing. ``columns`` joins the sorted names by commas.
    """
    names = F.array_sort("missing")
    sub = F.array(F.struct(F.array().cast("array<string>").alias("set"), F.lit(0).alias("next")))
    every = None
    for _ in range(order):  # subsets of one more column, each behind the last one taken
        sub = F.flatten(F.transform(sub, lambda s: F.transform(
            F.filter(F.transform(names, lambda c, i: F.struct(c.alias("c"), (i + 1).alias("next"))), lambda x: x.next > s.next),
            lambda x: F.struct(F.array_append(s.set, x.c).alias("set"), x.next.alias("next")))))
        every = sub if every is None else F.concat(every, sub)
    pairs = missing_patterns(df, cols).select("rows", F.size("missing").alias("m"), F.explode(every).alias("s"))
    return pairs.groupBy(F.array_join("s.set", ",").alias("columns"), F.size("s.set").alias("n_columns")).agg(
        F.sum("rows").alias("rows_all_missing"),
        F.coalesce(F.sum(F.when(F.col("m") == F.size("s.set"), F.col("rows"))), F.lit(0)).alias("rows_only_these"))


def missing_bands(df: DataFrame, cols=None) -> DataFrame:
    """Band each column by missing share: <5%, 5–30%, >=30%, most
    missing first."""
    return (missing_summary(df, cols)
            .withColumn("band", F.when(F.col("missing_percent") < 5, "LOW_<5%")
                        .when(F.col("missing_percent") < 30, "MEDIUM_5-30%")
                        .otherwise("HIGH_>=30%"))
            .orderBy(F.desc("missing_percent"), F.asc("column")))


# ---------------------------------------------------------------- H4, D5
def value_counts(df: DataFrame, col: str, dropna: bool = True, sort: str = "count") -> DataFrame:
    """H4: (value, count), most frequent first (value as tie-break) or, with
    ``sort="value"``, by value; the NULL group kept when ``dropna`` is False.
    Partial aggregation combines map-side, so a hot value costs one row per
    partition in the shuffle."""
    base = df.select(col)
    if dropna:
        base = base.where(F.col(col).isNotNull())
    out = base.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    order = [F.asc_nulls_last(col)] if sort == "value" else [F.desc("count"), F.asc_nulls_last(col)]
    return out.orderBy(*order)


def duplicate_ids(df: DataFrame, id_col: str = "ID") -> DataFrame:
    """Any duplicates, number of extra rows, distinct ids, total rows."""
    return (df.agg(F.count(F.lit(1)).alias("total_rows"),
                   F.count_distinct(id_col).alias("distinct_ids"))
            .withColumn("duplicate_rows", F.col("total_rows") - F.col("distinct_ids"))
            .withColumn("has_duplicates", F.col("duplicate_rows") > 0))
