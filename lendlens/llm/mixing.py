"""Mixing sources to target weights by pivotal dependent rounding.

Each source gets a target number of words; a document's expected copies are
its source's target divided by its size, so all documents of a source share
one probability.  The whole part is taken at once.  The fractional parts are
rounded by the pivotal method: two documents trade expected words at random
until one of them is at 0 or 1 copies, with odds that keep each expectation.
Because words (not copies) are traded, the words taken from a source stay at
its target up to the last open document.  Leaves of at most about `LEAF_ROWS`
documents are rounded in parallel; their open documents meet in the next
level of a reduction tree until one per source is left, which a hashed coin
closes.  All coins are hashes of ids, so reruns agree.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendlens.llm.common import WORD, sized_broadcast, written
from lendlens.llm.textkernels import U64, mix

SHARE = 1.5
CAP = 2.0
WEIGHTS = (3, 1, 2)
LEAF_ROWS = 20_000
FAN_IN = 1_000


def word_count(col):
    return F.coalesce(F.regexp_count(col, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(totals: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """Adds target to (source, source_size): `share` of all words by weight, none above `cap` times its size.

    Sources stand in code point order, null last, and take the weights in
    turn.  The excess of capped sources goes to the others by weight; sorted
    by size / weight, the capped ones are a prefix, so running sums find them.
    The table has one row per source; its windows run in one task.
    """
    place = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(place) - 1) % len(weights)
    w = totals.withColumn("weight", F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (turn + 1).cast("int")))
    w = w.withColumn("most", cap * F.col("source_size"))
    order = [F.col("most") / F.col("weight"), F.col("source").asc_nulls_last()]
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    left = (share * F.sum("source_size").over(every) - F.coalesce(F.sum("most").over(before), F.lit(0.0)))
    left_weight = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    w = w.withColumn("rate", left / left_weight)
    w = w.withColumn("free", F.col("rate") * F.col("weight") < F.col("most"))
    # The first source below its cap sets the rate of all that follow.
    rate = F.first(F.when(F.col("free"), F.col("rate")), ignorenulls=True).over(
        Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return w.withColumn("target", F.coalesce(rate * F.col("weight"), F.col("most"))).select(
        "source", "source_size", "target")


def _coins(ids: np.ndarray, seed: int) -> np.ndarray:
    """A number in [0, 1) for each id, another one for each seed."""
    return (mix(mix(ids.view(U64)) + U64(seed + 1)) >> U64(11)).astype(np.float64) / float(1 << 53)


def pivotal(p: np.ndarray, size: np.ndarray, ids: np.ndarray, seed: int) -> np.ndarray:
    """Trades expected words between rows in turn; all but at most one entry of the result are 0 or 1."""
    out, size, coin, held = p.tolist(), size.tolist(), _coins(ids, seed).tolist(), 0
    for i in range(1, len(out)):
        a, b = held, i
        up = min((1 - out[a]) * size[a], out[b] * size[b])    # words that a may take from b
        down = min(out[a] * size[a], (1 - out[b]) * size[b])  # words that a may give to b
        if up + down <= 0:
            held = b if out[a] in (0.0, 1.0) else a
            continue
        win = coin[i] * (up + down) < down
        move = up if win else -down
        x, y = out[a] + move / size[a], out[b] - move / size[b]
        # Whoever set the bound lands on it exactly.
        if win:
            x, y = (1.0, y) if (1 - out[a]) * size[a] <= out[b] * size[b] else (x, 0.0)
        else:
            x, y = (0.0, y) if out[a] * size[a] <= (1 - out[b]) * size[b] else (x, 1.0)
        out[a], out[b] = min(max(x, 0.0), 1.0), min(max(y, 0.0), 1.0)
        held = a if out[a] not in (0.0, 1.0) else b
    return np.array(out)


def _round_leaf(seed: int, last: bool):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        # Large documents first: what stays open at the end is most often a small one.
        rows = rows.sort_values(["size", "row"], ascending=[False, True], kind="stable")
        ids, p = rows["row"].to_numpy(np.int64), rows["p"].to_numpy(np.float64)
        p = pivotal(p, rows["size"].to_numpy(np.float64), ids, seed)
        if last:
            open_ = ~np.isin(p, (0.0, 1.0))
            p[open_] = (_coins(ids[open_], seed + 1) < p[open_]).astype(np.float64)
        return rows.assign(p=p)

    return run


def _row_key(id_col: str, text_col: str, source_col: str):
    """A hash of a row's id, text and source, nulls apart from all values."""
    return F.xxhash64(*[x for c in (id_col, text_col, source_col) for x in (F.col(c), F.col(c).isNull())])


def _plan(docs: DataFrame, id_col: str, text_col: str, source_col: str, weights, share: float, cap: float, seed: int) -> DataFrame:
    """(id, key, nth, size, source_size, target, copies) of each row; nth numbers rows of the same key."""
    narrow = written(docs.select(F.col(id_col).cast("long").alias("id"), _row_key(id_col, text_col, source_col).alias("key"),
                                 F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size")), "sizes")
    # Rows that agree in all that counts get numbers, so that they draw different coins.
    again = Window.partitionBy("key").orderBy("id")
    narrow = narrow.withColumn("nth", F.row_number().over(again))
    totals = narrow.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    targets = source_targets(totals.select("source", "source_size"), weights, share, cap)
    table = written(targets.join(totals.select(F.col("source").alias("s"), "docs"), F.col("source").eqNullSafe(F.col("s")))
                    .drop("s").select(F.col("source").alias("of"), "source_size", "target",
                                      F.ceil(F.col("docs") / LEAF_ROWS).cast("long").alias("leaves")), "targets")
    chance = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rows = narrow.join(sized_broadcast(table), F.col("source").eqNullSafe(F.col("of")))
    rows = rows.withColumn("whole", F.floor(chance).cast("long")).withColumn("p", chance - F.floor(chance))
    fixed = rows.where("size = 0 OR p = 0").select("id", "key", "nth", "size", "source_size", "target", F.col("whole").alias("copies"))
    open_rows = rows.where("size > 0 AND p > 0")
    open_rows = open_rows.select("id", "key", "nth", "size", "source_size", "target", "whole", "p", "leaves",
                                 F.coalesce("source", F.lit("")).alias("src"), F.col("source").isNull().alias("no_src"),
                                 F.xxhash64("key", "nth").alias("row"))
    open_rows = open_rows.withColumn("leaf", F.pmod("row", "leaves"))
    state = "id long, key long, nth int, size long, source_size long, target double, whole long, p double, leaves long, " \
            "src string, no_src boolean, row long, leaf long"
    most = table.agg(F.max("leaves").alias("n")).first()["n"] or 1
    done, level = [fixed], 0
    while True:
        last = most <= 1
        out = open_rows.groupBy("no_src", "src", "leaf").applyInPandas(_round_leaf(seed + 2 * level, last), state)
        out = written(out, "rounded")
        done.append(out.where("p = 0 OR p = 1").select(
            "id", "key", "nth", "size", "source_size", "target", (F.col("whole") + F.col("p").cast("long")).alias("copies")))
        if last:
            break
        most = -(-most // FAN_IN)
        open_rows = out.where("p > 0 AND p < 1").withColumn("leaf", F.pmod("row", F.lit(most)))
        level += 1
    result = done[0]
    for part in done[1:]:
        result = result.union(part)
    return result


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights=WEIGHTS, share: float = SHARE, cap: float = CAP, seed: int = 0) -> DataFrame:
    """(id, size, source_size, target, taken, copies): how often the mix takes each document.

    One row per row of `docs`; size counts its words (null text: 0) and taken
    is size times copies.  A text without words takes its whole expected
    copies.  Null is a source of its own; rows that repeat an id are rounded
    each for itself; an empty table gives an empty result.
    """
    plan = _plan(docs, id_col, text_col, source_col, weights, share, cap, seed)
    return plan.select(F.col("id").alias(id_col), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          weights=WEIGHTS, share: float = SHARE, cap: float = CAP, seed: int = 0) -> DataFrame:
    """The rows of `docs` that the mix takes, all columns, plus copies (how often).

    Every row has its own share of the plan, also rows with a null id or that repeat an id; which of several rows
    with the same id, text and source takes which number of copies is open, the numbers are the plan's.
    """
    plan = _plan(docs, id_col, text_col, source_col, weights, share, cap, seed).where("copies > 0")
    plan = plan.select(F.col("key").alias("__key"), F.col("nth").alias("__nth"), "copies")
    docs = docs.drop(*({"copies"} - {id_col, text_col, source_col})).withColumn("__key", _row_key(id_col, text_col, source_col))
    names = [c for c in docs.columns if c != "__key"]
    numbered = docs.withColumn("__nth", F.row_number().over(Window.partitionBy("__key").orderBy("__key")))
    return numbered.join(plan, ["__key", "__nth"]).select(*names, "copies")
