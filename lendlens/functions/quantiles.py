"""Exact quantiles without holding every distinct value in one task.

``F.percentile`` is exact but keeps a value→count map per group; for a global
quantile over billions of distinct doubles that map lands in one reducer.
Here mergeable sketches find where to look, and exact counts decide:

1. one aggregate gives ``n``, ``min``, ``max`` and a KLL sketch per column
   (a few thousand values each, combined map-side);
2. a sketch answers each wanted rank with a bracket of values, its error
   bound to both sides;
3. one further pass counts, exactly, the values below every bracket and
   gathers those inside it with their multiplicities. The rank is read off.

Brackets are cut by rank, not by value, so heavy tails and repeated values
don't widen them: a value that fills a bracket is both its ends, or one
``(value, count)`` row. A bracket expected to hold more than ``max_collect``
rows is sketched again instead (each round divides it by about 130), and a
rank that the sketch missed, which its error bound allows once in a while,
moves to the side where the counts say it is. So the result is exact for any
data, with two jobs up to some million rows and one more for every factor of
130; no pass has more than a bounded number of rows to collect.

Ranks follow linear interpolation between the order statistics at
``floor((n-1)p)`` and the next one, which equals pandas/NumPy ``quantile``,
Spark ``percentile`` and DuckDB ``quantile_cont``. NaN counts as missing.

Sketches can also be kept: ``sketch_table`` writes one per column and group,
``merge_sketches`` combines tables of several days or files, and
``approximate_quantiles`` answers from them within ``RANK_ERROR``.
"""

from __future__ import annotations

import bisect
import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_COLLECT = 20_000
#: Items a sketch keeps on its highest level, and the share of all ranks it may be off (99 % of the time).
SKETCH_K = 4096
RANK_ERROR = 0.0013
#: Half of a bracket, as a share of all ranks.
MARGIN = 2 * RANK_ERROR


def _targets_for(n: int, probs) -> dict[float, tuple[int, int, float]]:
    out = {}
    for p in probs:
        h = (n - 1) * float(p)
        k0 = int(math.floor(h))
        k1 = min(k0 + 1, n - 1)
        out[p] = (k0, k1, h - k0)
    return out


def _number(column: Column) -> Column:
    v = column.cast("double")
    return F.when(~F.isnan(v), v)


def order_statistics(df: DataFrame, columns: dict, ranks, max_collect: int = MAX_COLLECT,
                     sketch_k: int = SKETCH_K, margin: float = MARGIN) -> dict[str, dict[int, float | None]]:
    """Exact k-th smallest values (0-based ranks, NULLs skipped).

    ``columns`` maps names to Columns; ``ranks`` maps the same names to the
    ranks wanted, or is a function ``(name, n) -> ranks`` evaluated once the
    counts are known (a rank beyond the count gives ``None``). The first
    aggregate gives counts, extremes and sketches together.
    """
    names = list(columns)
    base = df.select(*[_number(columns[c]).alias(f"v{i}") for i, c in enumerate(names)])
    aggs = []
    for i in range(len(names)):
        v = F.col(f"v{i}")
        aggs += [F.count(v).alias(f"n{i}"), F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}"),
                 F.kll_sketch_agg_double(v, sketch_k).alias(f"s{i}")]
    stats = base.agg(*aggs).first()
    counts = {c: stats[f"n{i}"] or 0 for i, c in enumerate(names)}
    want = {c: (ranks(c, counts[c]) if callable(ranks) else ranks.get(c, [])) for c in names}
    targets: dict[tuple[int, int], _Target] = {}
    for i, c in enumerate(names):
        for k in want[c]:
            if 0 <= k < counts[c]:
                targets.setdefault((i, k), _Target(i, k, stats[f"lo{i}"], stats[f"hi{i}"], counts[c]))
    _narrow(df.sparkSession, [(t, 0, stats[f"s{t.i}"]) for t in targets.values() if t.inside > max_collect and t.lo < t.hi], margin)
    for t in targets.values():
        if t.lo == t.hi and t.inside == counts[names[t.i]]:  # one value fills the column
            t.settle(t.lo, 0, t.inside)
    while open_t := [t for t in targets.values() if t.value is None]:
        _look_again(base, open_t, max_collect, sketch_k, margin)
    out: dict[str, dict[int, float | None]] = {}
    for i, c in enumerate(names):
        out[c] = {k: (targets[(i, k)].value if (i, k) in targets else None) for k in want[c]}
    out["__counts__"] = counts
    # How many values are below / equal to each returned order statistic.
    out["__less__"] = {c: {k: targets[(i, k)].less for k in want[c] if (i, k) in targets} for i, c in enumerate(names)}
    out["__equal__"] = {c: {k: targets[(i, k)].equal for k in want[c] if (i, k) in targets} for i, c in enumerate(names)}
    return out


class _Target:
    """The value of rank ``k`` of column ``i``: somewhere from ``lo`` to ``hi``, with about ``inside`` rows between."""

    def __init__(self, i: int, k: int, lo: float, hi: float, inside: int):
        self.i, self.k, self.lo, self.hi, self.inside = i, k, lo, hi, inside
        self.value = self.less = self.equal = None

    def settle(self, value: float, less: int, equal: int) -> None:
        self.value, self.less, self.equal = value, less, equal

    def move(self, lo: float, hi: float, inside: int) -> None:
        self.lo, self.hi, self.inside = lo, hi, inside


def _narrow(spark: SparkSession, items, margin: float) -> None:
    """Cuts each target's bracket by a sketch of the ``inside`` values between its ends, of which ``before`` ranks come earlier."""
    if not items:
        return
    sketches, wanted = {}, {}
    for t, before, sketch in items:
        sketches[id(sketch)] = sketch
        at = (t.k - before) / max(t.inside - 1, 1)
        wanted.setdefault(id(sketch), []).append((t, max(at - margin, 0.0), min(at + margin, 1.0)))
    keys = list(sketches)
    # A local relation of a few dozen sketches: no job runs.
    local = spark.createDataFrame(pa.table({f"s{j}": pa.array([bytes(sketches[key])], pa.binary()) for j, key in enumerate(keys)}))
    row = local.select(*[F.kll_sketch_get_quantile_double(f"s{j}", F.lit([x for _, lo, hi in wanted[key] for x in (lo, hi)])).alias(f"q{j}")
                         for j, key in enumerate(keys)]).first()
    for j, key in enumerate(keys):
        for at, (t, lo, hi) in enumerate(wanted[key]):
            rows = t.inside
            t.move(t.lo if lo == 0.0 else max(t.lo, row[j][2 * at]), t.hi if hi == 1.0 else min(t.hi, row[j][2 * at + 1]),
                   int((hi - lo + margin) * rows) + 1)


def _look_again(base: DataFrame, open_t: list[_Target], max_collect: int, sketch_k: int, margin: float) -> None:
    """One pass over the brackets of the open targets: counts below each, and the values inside, or a sketch of them."""
    brackets: dict[tuple, int] = {}
    held: dict[int, list[_Target]] = {}
    for t in open_t:
        j = brackets.setdefault((t.i, t.lo, t.hi), len(brackets))
        held.setdefault(j, []).append(t)
    small = {j for j, ts in held.items() if ts[0].inside <= max_collect or ts[0].lo == ts[0].hi}
    below = base.agg(*[F.count(F.when(F.col(f"v{i}") < F.lit(lo), 1)).alias(f"b{j}") for (i, lo, _), j in brackets.items()])
    empty = {"v": F.lit(None).cast("double"), "hi": F.lit(None).cast("double"), "sketch": F.lit(None).cast("binary")}
    out = below.select(F.explode(F.array(*[F.struct(F.lit(j).alias("j"), F.col(f"b{j}").alias("n")) for j in brackets.values()])).alias("r")) \
        .select(F.col("r.j").alias("j"), F.lit("below").alias("kind"), empty["v"].alias("v"), F.col("r.n").alias("n"),
                empty["hi"].alias("hi"), empty["sketch"].alias("sketch"))

    def inside(which, strictly: bool) -> DataFrame:
        mine = {b: j for b, j in brackets.items() if j in which}
        cond = {}
        for (i, lo, hi), j in mine.items():
            v = F.col(f"v{i}")
            cond[j] = ((v > F.lit(lo)) & (v < F.lit(hi))) if strictly else ((v >= F.lit(lo)) & (v <= F.lit(hi)))
        some = F.lit(False)
        for c in cond.values():
            some = some | c
        tagged = [F.when(cond[j], F.struct(F.lit(j).alias("j"), F.col(f"v{i}").alias("v"))) for (i, _lo, _hi), j in mine.items()]
        return base.where(some).select(F.explode(F.array(*tagged)).alias("s")).where(F.col("s").isNotNull()).select("s.*")

    large = set(held) - small
    if small:
        out = out.unionByName(inside(small, False).groupBy("j", "v").agg(F.count(F.lit(1)).alias("n")).select(
            "j", F.lit("value").alias("kind"), "v", "n", empty["hi"].alias("hi"), empty["sketch"].alias("sketch")))
    if large:
        ends = base.agg(*[F.count(F.when(F.col(f"v{i}") == F.lit(x), 1)).alias(f"{end}{j}") for (i, lo, hi), j in brackets.items() if j in large
                          for end, x in (("lo", lo), ("hi", hi))])
        cells = F.array(*[F.struct(F.lit(j).alias("j"), F.lit(end).alias("kind"), F.col(f"{end}{j}").alias("n")) for j in sorted(large) for end in ("lo", "hi")])
        out = out.unionByName(ends.select(F.explode(cells).alias("r")).select(
            "r.j", "r.kind", empty["v"].alias("v"), "r.n", empty["hi"].alias("hi"), empty["sketch"].alias("sketch")))
        out = out.unionByName(inside(large, True).groupBy("j").agg(
            F.count("v").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"), F.kll_sketch_agg_double("v", sketch_k).alias("sketch")).select(
            "j", F.lit("sketch").alias("kind"), F.col("lo").alias("v"), "n", "hi", "sketch"))
    found: dict[int, dict[str, list]] = {j: {} for j in held}
    for r in out.toArrow().to_pylist():
        found[r["j"]].setdefault(r["kind"], []).append(r)
    again = []
    for j, ts in held.items():
        before = found[j]["below"][0]["n"]
        if j in small:
            rows = sorted((r["v"], r["n"]) for r in found[j].get("value", []))
            ends, total = [], before
            for _, n in rows:
                total += n
                ends.append(total)
        else:
            at_lo, at_hi = found[j]["lo"][0]["n"], found[j]["hi"][0]["n"]
            middle = found[j].get("sketch", [{"n": 0}])[0]
            total = before + at_lo + middle["n"] + at_hi
        for t in ts:
            if t.k < before:  # the sketch was further off than its bound: look on that side
                t.move(-math.inf, math.nextafter(t.lo, -math.inf), before)
            elif t.k >= total:
                t.move(math.nextafter(t.hi, math.inf), math.inf, max_collect + 1)
            elif j in small:
                at = bisect.bisect_right(ends, t.k)
                t.settle(rows[at][0], ends[at] - rows[at][1], rows[at][1])
            elif t.k < before + at_lo:
                t.settle(t.lo, before, at_lo)
            elif t.k >= total - at_hi:
                t.settle(t.hi, total - at_hi, at_hi)
            else:
                t.move(middle["v"], middle["hi"], middle["n"])
                again.append((t, before + at_lo, middle["sketch"]))
    _narrow(base.sparkSession, [x for x in again if x[0].lo < x[0].hi], margin)


def exact_quantiles(df: DataFrame, columns, probs, max_collect: int = MAX_COLLECT,
                    sketch_k: int = SKETCH_K, margin: float = MARGIN) -> dict[str, dict[float, float | None]]:
    """Exact interpolated quantiles.

    ``columns`` is a list of names or a dict ``name -> Column`` (virtual
    columns, e.g. ``when(TARGET = 1, x)`` for per-class quantiles). NULLs are
    skipped. Returns ``{name: {p: value}}``; ``None`` for an empty column.
    """
    if not isinstance(columns, dict):
        columns = {c: F.col(c) for c in columns}
    names = list(columns)
    if not names:
        return {}

    def ranks(_c, n):
        return sorted({k for k0, k1, _ in _targets_for(n, probs).values() for k in (k0, k1)}) if n else []

    stats = order_statistics(df, columns, ranks, max_collect, sketch_k, margin)
    result: dict[str, dict[float, float | None]] = {}
    for c in names:
        n = stats["__counts__"][c]
        if not n:
            result[c] = {p: None for p in probs}
            continue
        result[c] = {}
        for p, (k0, k1, frac) in _targets_for(n, probs).items():
            v0, v1 = stats[c][k0], stats[c][k1]
            result[c][p] = v0 + frac * (v1 - v0) if frac else v0
    return result


def quantile(df: DataFrame, column, p: float, **kw) -> float | None:
    name = column if isinstance(column, str) else "q"
    cols = {name: F.col(column) if isinstance(column, str) else column}
    return exact_quantiles(df, cols, [p], **kw)[name][p]


def median(df: DataFrame, column, **kw) -> float | None:
    return quantile(df, column, 0.5, **kw)


# ------------------------------------------------------------- kept sketches
def sketch_table(df: DataFrame, columns, by=(), sketch_k: int = SKETCH_K) -> DataFrame:
    """One row per group and column: ``n``, ``lo``, ``hi`` and a KLL sketch (NULL without values).

    The rows are small and mergeable: written once per file or day, they
    answer quantiles of any union later without reading the data again.
    """
    by = list(by)
    values = [F.struct(F.lit(c).alias("column"), _number(F.col(c)).alias("v")) for c in columns]
    long = df.select(*by, F.explode(F.array(*values)).alias("x")).select(*by, "x.column", "x.v")
    return (long.groupBy(*by, "column")
            .agg(F.count("v").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"), F.kll_sketch_agg_double("v", sketch_k).alias("sketch"))
            .withColumn("sketch", F.when(F.col("n") > 0, F.col("sketch"))))


def merge_sketches(tables: DataFrame, by=()) -> DataFrame:
    """Combines rows of ``sketch_table`` (of several tables, or of finer groups) into one per ``by`` group and column."""
    return (tables.where(F.col("n") > 0).groupBy(*by, "column")
            .agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.kll_merge_agg_double("sketch").alias("sketch")))


def approximate_quantiles(sketches: DataFrame, probs, by=()) -> DataFrame:
    """(by, column, p, value): a value whose rank is within ``RANK_ERROR`` of p, 99 % of the time; extremes are exact."""
    probs = [float(p) for p in probs]
    found = F.arrays_zip(F.lit(probs).alias("p"), F.kll_sketch_get_quantile_double("sketch", F.lit(probs)).alias("value"))
    rows = sketches.where(F.col("n") > 0).select(*by, "column", "lo", "hi", F.explode(found).alias("q"))
    value = F.when(F.col("q.p") <= 0, F.col("lo")).when(F.col("q.p") >= 1, F.col("hi")).otherwise(F.col("q.value"))
    return rows.select(*by, "column", F.col("q.p").alias("p"), value.alias("value"))
