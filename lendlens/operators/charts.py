"""Chart data: the aggregated table behind each exploratory chart.

The drawing itself is not built. Each operator is one or two aggregations of
the base rows; windows only ever run over aggregated rows, and top-k uses a
row-number filter that Spark turns into a partial ``WindowGroupLimit`` before
the shuffle (or a ``TakeOrderedAndProject`` without partition keys).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendlens.functions.exprs import HOUR_BINS, hour_bin, np_round, rank_in
from lendlens.functions.ranking import running_sums
from lendlens.functions.quantiles import exact_quantiles


def _scalar_count(df: DataFrame, cond: Column | None = None) -> Column:
    """Row count as a scalar subquery (run once, inlined as a value)."""
    base = df if cond is None else df.where(cond)
    return base.select(F.count(F.lit(1))).scalar()


# ---------------------------------------------------------------- J1, J2
def histogram(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """Equal-width bins over [min, max] (last bin closed), NULLs dropped,
    empty bins kept; the column mean and median are attached to every row.
    A constant column gets the range [x-0.5, x+0.5]."""
    x = F.col(col).cast("double")
    vals = df.select(x.alias("x")).where(F.col("x").isNotNull())
    st = vals.agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.avg("x").alias("mean")).first()
    if st["lo"] is None:
        return df.sparkSession.createDataFrame([], "bin int, left double, right double, count long, "
                                                   "mean double, median double")
    lo, hi = float(st["lo"]), float(st["hi"])
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo) / bins
    med = exact_quantiles(vals, ["x"], [0.5])["x"][0.5]
    b = F.least(F.floor((F.col("x") - F.lit(lo)) / F.lit(width)).cast("int"), F.lit(bins - 1))
    counts = vals.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (grid.join(F.broadcast(counts), "bin", "left")
            .select("bin", (F.lit(lo) + F.col("bin") * F.lit(width)).alias("left"),
                    (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("right"),
                    F.coalesce("count", F.lit(0)).cast("long").alias("count"),
                    F.lit(st["mean"]).cast("double").alias("mean"),
                    F.lit(med).cast("double").alias("median")))


def discrete_counts(df: DataFrame, col: str) -> DataFrame:
    """Counts per value, ordered by value."""
    return (df.where(F.col(col).isNotNull()).groupBy(col)
            .agg(F.count(F.lit(1)).alias("count")).orderBy(col))


# ---------------------------------------------------------------- J3, J4
def topk_others(df: DataFrame, col: str, k: int = 10) -> DataFrame:
    """The k most frequent values (count desc, value asc); the rest summed
    as ``Others`` when there are more than k values; percent of the total
    (1 dp). The top k is found by a bounded take-ordered, the relabel is a
    join against those k rows (broadcast)."""
    counts = (df.where(F.col(col).isNotNull())
              .groupBy(F.col(col).cast("string").alias("category"))
              .agg(F.count(F.lit(1)).alias("count")))
    top = (counts.orderBy(F.desc("count"), F.asc("category")).limit(k)
           .select("category", F.lit(True).alias("_top")))
    labelled = (counts.join(F.broadcast(top), "category", "left")
                .select(F.when(F.col("_top"), F.col("category")).otherwise(F.lit("Others")).alias("category"),
                        F.col("_top").isNotNull().alias("_top"), "count"))
    out = labelled.groupBy("category", "_top").agg(F.sum("count").alias("count"))
    w_all = Window.partitionBy()  # over at most k+1 aggregated rows
    rank = Window.orderBy(F.desc("_top"), F.desc("count"), F.asc("category"))
    return out.select(F.row_number().over(rank).alias("rank"), "category", "count",
                      np_round(F.col("count") * 100.0 / F.sum("count").over(w_all), 1).alias("percent"))


def shared_axis_limit(df: DataFrame, cols: list[str], k: int = 10) -> DataFrame:
    """1.2 × the largest of (top count, Others sum) over columns — a common
    y-limit for side-by-side top-k charts. Columns are unpivoted once; top-k
    per column is a row-number filter (partial group limit before shuffle)."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols
    ])).alias("s")).select("s.*").where(F.col("value").isNotNull())
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))
    w = Window.partitionBy("column").orderBy(F.desc("count"), F.asc("value"))
    top = (counts.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= k)
           .groupBy("column").agg(F.sum("count").alias("top_sum"), F.max("count").alias("top_max")))
    totals = counts.groupBy("column").agg(F.sum("count").alias("total"))
    per_col = top.join(totals, "column").select(
        "column", F.greatest(F.col("top_max"), F.col("total") - F.col("top_sum")).alias("peak"))
    return per_col.agg((F.max("peak") * 1.2).alias("y_limit"))


# ---------------------------------------------------------------- J5, J7
def count_and_rate(df: DataFrame, feature: str, target: str = "TARGET") -> DataFrame:
    """Per value: count and target mean × 100, ordered by value."""
    return (df.where(F.col(feature).isNotNull()).groupBy(feature)
            .agg(F.count(F.lit(1)).alias("count"), (F.avg(target) * 100).alias("default_rate"))
            .orderBy(feature))


def amplitude(df: DataFrame, feature: str, target: str = "TARGET", top_n: int = 10) -> DataFrame:
    """Share of each class per category (denominator: all rows of the
    class, NULL categories included), diff, amplitude = |diff|/(avg+1e-10),
    top n by amplitude, 3 dp. One ``groupBy`` with conditional counts replaces
    the two value counts and their outer alignment."""
    t = F.col(target)
    n1 = _scalar_count(df, t == 1)
    n0 = _scalar_count(df, t == 0)
    g = (df.where(F.col(feature).isNotNull())
         .groupBy(F.col(feature).cast("string").alias("category"))
         .agg(F.sum((t == 1).cast("long")).alias("c1"), F.sum((t == 0).cast("long")).alias("c0")))
    d = F.try_divide(F.col("c1") * 100.0, n1)
    nd = F.try_divide(F.col("c0") * 100.0, n0)
    g = g.select("category", d.alias("default_pct"), nd.alias("non_default_pct"))
    g = g.withColumn("diff", F.col("default_pct") - F.col("non_default_pct")).withColumn(
        "amplitude", F.abs(F.col("diff")) / ((F.col("default_pct") + F.col("non_default_pct")) / 2 + 1e-10))
    top = g.orderBy(F.desc("amplitude"), F.asc("category")).limit(top_n)
    return top.select("category", *[np_round(c, 3).alias(c) for c in
                                    ("default_pct", "non_default_pct", "diff", "amplitude")])


# ---------------------------------------------------------------- J8
def quantile_edges(df: DataFrame, col: str, n_bins: int) -> list[float]:
    """Exact quantile edges at 0, 1/q, …, 1 with duplicates dropped."""
    probs = [i / n_bins for i in range(n_bins + 1)]
    q = exact_quantiles(df, [col], probs)[col]
    edges = []
    for p in probs:
        v = q[p]
        if v is not None and (not edges or v != edges[-1]):
            edges.append(float(v))
    return edges


def qcut_expr(col: str, edges: list[float]) -> Column:
    """Bin index for right-closed bins (e_i, e_i+1], the first one closed."""
    x = F.col(col)
    expr = F.lit(None).cast("int")
    for i in reversed(range(1, len(edges))):
        lo_ok = (x >= edges[0]) if i == 1 else (x > edges[i - 1])
        expr = F.when(lo_ok & (x <= edges[i]), F.lit(i - 1)).otherwise(expr)
    return expr


def ordered_rate(df: DataFrame, feature: str, target: str = "TARGET", n_bins: int = 10,
                 order: list | dict | None = None) -> DataFrame:
    """Count and default rate × 100 in the feature's order.

    With an ``order`` (list or value→rank map) only mapped values are kept
    and sorted by rank. Otherwise a floating column or one with more than 20
    distinct values is cut at exact quantiles (right-closed, lowest included,
    duplicate edges dropped); else grouped by value.
    """
    base = df.select(feature, target).na.drop()
    if order is not None:
        ranks = order if isinstance(order, dict) else {v: i for i, v in enumerate(order)}
        keys = sorted(ranks, key=lambda v: ranks[v])
        r = rank_in(feature, keys)
        rank_val = F.element_at(F.array(*[F.lit(ranks[k]) for k in keys]), r + 1)
        return (base.where(r.isNotNull())
                .groupBy(rank_val.alias("order"), F.col(feature).cast("string").alias("label"))
                .agg(F.count(F.lit(1)).alias("count"), (F.avg(target) * 100).alias("default_rate"))
                .select("order", "label", F.lit(None).cast("double").alias("left"),
                        F.lit(None).cast("double").alias("right"), "count", "default_rate"))
    dtype = dict(base.dtypes)[feature]
    many = dtype in ("double", "float") or base.agg(F.count_distinct(feature)).first()[0] > 20
    if many:
        edges = quantile_edges(base, feature, n_bins)
        if len(edges) < 2:
            edges = edges * 2
        b = qcut_expr(feature, edges)
        lefts = F.array(*[F.lit(e) for e in edges[:-1]])
        rights = F.array(*[F.lit(e) for e in edges[1:]])
        g = (base.groupBy(b.alias("order"))
             .agg(F.count(F.lit(1)).alias("count"), (F.avg(target) * 100).alias("default_rate")))
        return g.select("order",
                        F.format_string("%.2f-%.2f", F.element_at(lefts, F.col("order") + 1),
                                        F.element_at(rights, F.col("order") + 1)).alias("label"),
                        F.element_at(lefts, F.col("order") + 1).alias("left"),
                        F.element_at(rights, F.col("order") + 1).alias("right"),
                        "count", "default_rate")
    g = (base.groupBy(F.col(feature).alias("value"))
         .agg(F.count(F.lit(1)).alias("count"), (F.avg(target) * 100).alias("default_rate")))
    w = Window.orderBy("value")  # over the (<= 20) aggregated values
    return g.select((F.row_number().over(w) - 1).alias("order"), F.col("value").cast("string").alias("label"),
                    F.lit(None).cast("double").alias("left"), F.lit(None).cast("double").alias("right"),
                    "count", "default_rate")


# ---------------------------------------------------------------- J9
def box_stats(df: DataFrame, col: str, target: str | None = None) -> DataFrame:
    """Quartiles, whiskers (furthest points within 1.5 IQR), outlier
    count; per target class when ``target`` is given, for any number of
    classes. The rows become counts per (class, value); their running sums in
    that order give each value's ranks within its class, from which the exact
    quartiles are read, and the whiskers and outliers come from the counts."""
    group = F.lit("all") if target is None else F.col(target)
    cells = (df.select(group.alias("g"), F.col(col).cast("double").alias("x"))
             .where(F.col("g").isNotNull() & F.col("x").isNotNull())
             .groupBy("g", "x").agg(F.count(F.lit(1)).alias("n")))
    cum = running_sums(cells.withColumn("_key", F.struct("g", "x")), "_key", ["n"]).select("g", "x", "n", "cum_n")
    totals = cum.groupBy("g").agg(F.sum("n").alias("count"), F.min(F.col("cum_n") - F.col("n")).alias("start"))
    placed = cum.join(totals, "g").withColumn("above", F.col("cum_n") - F.col("start"))

    def value_at(rank):
        return F.max(F.when((F.col("above") - F.col("n") <= rank) & (rank < F.col("above")), F.col("x")))

    probs = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    places = {name: (F.col("count") - 1) * p for name, p in probs.items()}
    ends = placed.groupBy("g", "count").agg(*[e for name, h in places.items() for e in (
        value_at(F.floor(h)).alias(f"{name}_0"), value_at(F.least(F.floor(h) + 1, F.col("count") - 1)).alias(f"{name}_1"))])
    quart = ends.select("g", "count", *[
        (F.col(f"{name}_0") + (h - F.floor(h)) * (F.col(f"{name}_1") - F.col(f"{name}_0"))).alias(name)
        for name, h in places.items()])
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = (F.col("x") >= F.col("q1") - reach) & (F.col("x") <= F.col("q3") + reach)
    return (cum.join(quart, "g").groupBy(F.col("g").cast("string").alias("group"), "count", "q1", "median", "q3")
            .agg(F.min(F.when(inside, F.col("x"))).alias("whisker_low"), F.max(F.when(inside, F.col("x"))).alias("whisker_high"),
                 F.sum(F.when(~inside, F.col("n")).otherwise(0)).cast("long").alias("outliers")))


# ---------------------------------------------------------------- J10–J12
def hourly_risk(df: DataFrame, hour_col: str = "HOUR_APPR_PROCESS_START",
                target: str = "TARGET") -> DataFrame:
    """Per hour: count, default rate and the rate as percent."""
    return (df.groupBy(F.col(hour_col).alias("hour"))
            .agg(F.count(F.lit(1)).alias("count"), F.avg(target).alias("default_rate"))
            .withColumn("default_rate_pct", F.col("default_rate") * 100)
            .orderBy("hour"))


def hour_bin_risk(df: DataFrame, hour_col: str = "HOUR_APPR_PROCESS_START",
                  target: str = "TARGET") -> DataFrame:
    """Per hour bin: count and default rate (%) in clock order."""
    b = hour_bin(hour_col)
    return (df.groupBy(b.alias("hour_bin"))
            .agg(F.count(F.lit(1)).alias("count"), (F.avg(target) * 100).alias("default_rate"))
            .withColumn("bin_order", rank_in("hour_bin", HOUR_BINS))
            .orderBy("bin_order"))


def class_counts(df: DataFrame, target: str = "TARGET") -> DataFrame:
    """The target distribution."""
    return df.groupBy(target).agg(F.count(F.lit(1)).alias("count")).orderBy(target)


# ---------------------------------------------------------------- J6
#: Bins a bandwidth, moments kept of each bin, and the bandwidths beyond which a kernel adds nothing to a double.
KDE_BINS, KDE_MOMENTS, KDE_REACH = 10, 6, 8.5


def distribution_by_target(df: DataFrame, col: str, target: str = "TARGET", gridsize: int = 100,
                           cut: float = 2.0) -> DataFrame:
    """Per class, the mean and a Gaussian kernel density on a grid
    (Scott bandwidth = sample std · n^(-1/5); grid from min - cut·bw to
    max + cut·bw), for any number of classes.

    Pass 1 is one grouped aggregate of moments. Pass 2 joins them to the rows
    by class and sums, in bins of a tenth of a bandwidth, the powers 0 to 5
    of each value's distance u from its bin's centre (map-side combined). A
    bin's kernels at a grid point z bandwidths away are
    exp(-z²/2) · Σ He_k(z) · Σu^k / k!, the Hermite series of exp(-(z-u)²/2).
    With |u| <= 0.05 its remainder is below 2e-9 of a kernel's height, so the
    densities are those of the direct sum to that precision. Bins meet only
    the grid points within reach."""
    base = df.select(F.col(target).cast("string").alias("cls"), F.col(col).cast("double").alias("x")) \
        .where(F.col("x").isNotNull() & F.col("cls").isNotNull())
    mom = base.groupBy("cls").agg(F.count(F.lit(1)).alias("n"), F.avg("x").alias("mean"),
                                  F.stddev_samp("x").alias("sd"), F.min("x").alias("lo"), F.max("x").alias("hi"))
    mom = mom.withColumn("bw", F.when(F.col("sd") > 0, F.col("sd") * F.pow(F.col("n"), F.lit(-0.2))).otherwise(F.lit(1.0)))
    step = (F.col("hi") - F.col("lo") + 2 * cut * F.col("bw")) / max(gridsize - 1, 1)
    mom = mom.select("cls", "n", "mean", "bw", "lo", (F.col("lo") - cut * F.col("bw")).alias("first"), step.alias("step"))

    place = (F.col("x") - F.col("lo")) / F.col("bw")  # in bandwidths
    binned = base.join(mom.select("cls", "bw", "lo"), "cls").withColumn("bin", F.floor(place * KDE_BINS))
    u = place - (F.col("bin") + 0.5) / KDE_BINS
    bins = binned.groupBy("cls", "bin").agg(*[F.sum(F.pow(u, F.lit(float(k))) if k else F.lit(1.0)).alias(f"m{k}") for k in range(KDE_MOMENTS)])
    centre = F.col("lo") + (F.col("bin") + 0.5) / KDE_BINS * F.col("bw")
    near = bins.join(mom.select("cls", "bw", "lo", "first", "step"), "cls").withColumn("centre", centre)
    reach = KDE_REACH * F.col("bw")
    begin = F.greatest(F.ceil((F.col("centre") - reach - F.col("first")) / F.col("step")), F.lit(0))
    end = F.least(F.floor((F.col("centre") + reach - F.col("first")) / F.col("step")), F.lit(gridsize - 1))
    near = near.withColumn("begin", begin.cast("long")).withColumn("end", end.cast("long")).where("begin <= end")
    near = near.withColumn("grid_index", F.explode(F.sequence("begin", "end")))
    z = (F.col("first") + F.col("grid_index") * F.col("step") - F.col("centre")) / F.col("bw")
    near = near.withColumn("z", z)
    hermite, series, scale = [F.lit(1.0), F.col("z")], F.col("m0"), 1.0
    for k in range(1, KDE_MOMENTS):
        scale *= k
        series = series + hermite[k] * F.col(f"m{k}") / scale
        hermite.append(F.col("z") * hermite[k] - k * hermite[k - 1])
    sums = near.groupBy("cls", "grid_index").agg(F.sum(F.exp(-0.5 * F.col("z") * F.col("z")) * series).alias("kernel_sum"))
    meta = mom.withColumn("grid_index", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(gridsize - 1).cast("long"))))
    meta = meta.withColumn("x", F.col("first") + F.col("grid_index") * F.col("step"))
    norm = F.col("n") * F.col("bw") * math.sqrt(2 * math.pi)
    return (meta.join(sums, ["cls", "grid_index"], "left")
            .select(F.col("cls").alias(target), "mean", "grid_index", "x",
                    (F.coalesce("kernel_sum", F.lit(0.0)) / norm).alias("density")))
