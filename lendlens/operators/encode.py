"""Categorical encoders (F1–F8).

Codes, shares and target means are fitted as a table (kind, c, v, x) with one
row per column and value, of any number of values: one pass over the rows
counts every value of every column (map-side combined). ``transform`` reads
the columns of few values at once and looks them up in the projection; those
of more values by a left join each, which the planner broadcasts while the
table is small. Sorted codes come from range-partitioned running sums, so no task
or driver holds a column's values. Only one-hot encoding, whose result has a
column per value, refuses a width (``max_width``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendlens.functions.ranking import running_sums
from lendlens.operators.base import JsonEstimator, JsonModel, TableModel, stored_table

MAX_WIDTH = 10_000  # columns that one-hot encoding of one column may add
NAN_TEXT = "nan"  # how a missing value reads once cast to text


def _text(x: Column) -> Column:
    return F.coalesce(x.cast("string"), F.lit(NAN_TEXT))


def value_counts(df: DataFrame, cols) -> DataFrame:
    """(c, v, n): rows of every value, as text and NULL included, of several columns in one pass."""
    pairs = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in cols])
    return df.select(F.explode(pairs).alias("s")).groupBy("s.c", "s.v").agg(F.count(F.lit(1)).alias("n"))


def sorted_codes(values: DataFrame) -> DataFrame:
    """(c, v, x): the place, from 0, of each distinct non-null value among the sorted values of its column."""
    keys = values.where("v IS NOT NULL").select(F.struct("c", "v").alias("k")).distinct().withColumn("one", F.lit(1))
    ranked = running_sums(keys, "k", ["one"])
    firsts = ranked.groupBy(F.col("k.c").alias("c")).agg(F.min("cum_one").alias("first"))  # a row per column
    return (ranked.select("k.c", "k.v", "cum_one").join(F.broadcast(firsts), "c")
            .select("c", "v", (F.col("cum_one") - F.col("first")).cast("double").alias("x")))


def _looked_up(model: TableModel, df: DataFrame, kind: str, col: str, key: Column, name: str) -> DataFrame:
    """Adds ``name``: the number that the model's table holds for ``key``, NULL for other keys."""
    few = model.small_lookups().get((kind, col))
    if few is not None:
        places = F.map_from_arrays(F.lit(list(few)), F.lit([float(x) for x in few.values()]))
        return df.withColumn(name, F.try_element_at(places, key))
    side = model.table().where((F.col("kind") == kind) & (F.col("c") == col)).select(F.col("v").alias("__v"), F.col("x").alias(name))
    return df.join(side, key == F.col("__v"), "left").drop("__v")


def _onehot_categories(values: DataFrame, max_width: int) -> dict[str, list]:
    """The sorted values of each column, a missing one last as its own category."""
    widths = {r["c"]: r["n"] for r in values.groupBy("c").agg(F.count(F.lit(1)).alias("n")).collect()}
    for c, n in widths.items():
        if n > max_width:
            raise ValueError(f"{c}: one-hot encoding would add {n} columns, above max_width = {max_width}")
    rows = [(r["c"], r["v"]) for r in values.select("c", "v").collect()]  # at most max_width for each column
    return {c: sorted(v for d, v in rows if d == c and v is not None) + [NAN_TEXT] * ((c, None) in rows) for c in widths}


def onehot_exprs(col: str, categories: list, drop_first: bool = True) -> dict[str, Column]:
    """one 0/1 double column per kept category; unseen → all zero."""
    cats = categories[1:] if drop_first else categories
    x = _text(F.col(col))
    return {f"{col}_{c}": (x == F.lit(c)).cast("double") for c in cats}


def ordinal_expr(col: str, order: list) -> Column:
    """position in ``order``; unknown and NULL → -1 (double)."""
    if not order:
        return F.lit(-1.0)
    place = F.map_from_arrays(F.lit(list(order)), F.lit(list(range(len(order)))))
    return F.coalesce(F.try_element_at(place, F.col(col).cast("string")), F.lit(-1)).cast("double")


class FlexibleEncoderModel(TableModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        s, o = self.fitted, self.opts
        out = [F.col(c) for c in s["keep"] if c in df.columns]
        names = df.columns
        for i, c in enumerate(s["label"]):
            if c in names:  # unseen → 0
                df = _looked_up(self, df, "label", c, _text(F.col(c)), f"__label_{i}")
                out.append(F.coalesce(F.col(f"__label_{i}"), F.lit(0)).cast("long").alias(c))
        for c, cats in s["onehot"].items():
            if c in names:
                out += [e.alias(n) for n, e in onehot_exprs(c, cats, o["onehot_drop"] == "first").items()]
        for c, order in s["ordinal"].items():
            if c in names:
                out.append(ordinal_expr(c, order).alias(c))
        for i, c in enumerate(s["frequency"]):
            if c in names:  # training share of the value; unseen or NULL → 0
                df = _looked_up(self, df, "frequency", c, F.col(c).cast("string"), f"__freq_{i}")
                out.append(F.coalesce(F.col(f"__freq_{i}"), F.lit(0.0)).alias(f"{c}_freq"))
        return df.select(*out)


class FlexibleEncoder(JsonEstimator):
    """Label, one-hot, ordinal and frequency encoding of chosen
    columns. Output order: untouched columns, label codes, one-hot columns,
    ordinal codes, frequencies (``<col>_freq``)."""
    DEFAULTS = {"label_encode_cols": [], "onehot_encode_cols": [], "ordinal_encode_cols": [],
                "ordinal_mappings": {}, "frequency_encode_cols": [], "onehot_drop": "first",
                "handle_unknown": "ignore", "max_width": MAX_WIDTH}
    model_class = FlexibleEncoderModel

    def _fit(self, df: DataFrame):
        o = self.opts
        label, onehot, frequency = ([c for c in o[f"{k}_encode_cols"] if c in df.columns]
                                    for k in ("label", "onehot", "frequency"))
        enc = {*o["label_encode_cols"], *o["onehot_encode_cols"], *o["ordinal_encode_cols"], *o["frequency_encode_cols"]}
        state = {"keep": [c for c in df.columns if c not in enc], "label": label, "onehot": {}, "frequency": frequency,
                 "ordinal": {c: list(o["ordinal_mappings"][c]) for c in o["ordinal_encode_cols"]
                             if c in df.columns and c in o["ordinal_mappings"]}, "table": None}
        cols = list(dict.fromkeys(label + onehot + frequency))
        if not cols:
            return self._make_model(state)
        counts = df.sparkSession.read.parquet(stored_table(value_counts(df, cols), "value-counts"))
        if onehot:
            found = _onehot_categories(counts.where(F.col("c").isin(onehot)), o["max_width"])
            state["onehot"] = {c: found.get(c, []) for c in onehot}
        parts = []
        if label:
            named = counts.where(F.col("c").isin(label)).select("c", _text(F.col("v")).alias("v"))
            parts.append(sorted_codes(named).select(F.lit("label").alias("kind"), "c", "v", "x"))
        if frequency:
            seen = counts.where(F.col("c").isin(frequency) & F.col("v").isNotNull())
            totals = seen.groupBy("c").agg(F.sum("n").alias("total"))  # a row per column
            parts.append(seen.join(F.broadcast(totals), "c")
                         .select(F.lit("frequency").alias("kind"), "c", "v", (F.col("n") / F.col("total")).alias("x")))
        if parts:
            state["table"] = stored_table(reduce(DataFrame.unionByName, parts), "category-codes")
        return self._make_model(state)


class HourBinOneHotModel(JsonModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        o, cats = self.opts, self.fitted["categories"]
        prefix, bin_col = o["prefix"], o["bin_col"]
        old = [c for c in df.columns if c.startswith(prefix + "_")]
        use = cats[1:] if o["drop_first"] else cats
        out = df.drop(*old)
        out = out.withColumns({f"{prefix}_{c}": (F.col(bin_col) == F.lit(c)).cast("int") for c in use})
        return out.drop(bin_col)


class HourBinOneHot(JsonEstimator):
    """dummies of the hour bin with the categories fixed at fit time
    (earlier dummies removed first); the bin column is dropped."""
    DEFAULTS = {"bin_col": "HOUR_APPR_PROCESS_BIN", "prefix": "HOUR_BIN", "drop_first": False, "max_width": MAX_WIDTH}
    model_class = HourBinOneHotModel

    def _fit(self, df: DataFrame):
        c = self.opts["bin_col"]
        values = value_counts(df.where(F.col(c).isNotNull()), [c])
        return self._make_model({"categories": _onehot_categories(values, self.opts["max_width"]).get(c, [])})


class DictionaryEncoderModel(TableModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        names, new = df.columns, {}
        for i, c in enumerate(self.fitted["columns"]):
            if c in names:
                df = _looked_up(self, df, "code", c, F.col(c).cast("string"), f"__code_{i}")
                new[c] = F.coalesce(F.col(f"__code_{i}"), F.lit(-1)).cast("int")
        return df.select(*[new[c].alias(c) if c in new else F.col(c) for c in names])


class DictionaryEncoder(JsonEstimator):
    """every text column → category code (sorted categories; NULL and
    unseen → -1)."""
    DEFAULTS = {"columns": None}
    model_class = DictionaryEncoderModel

    def _fit(self, df: DataFrame):
        cols = self.opts["columns"] or [c for c, t in df.dtypes if t == "string"]
        if not cols:
            return self._make_model({"columns": [], "table": None})
        codes = sorted_codes(value_counts(df, cols)).withColumn("kind", F.lit("code"))
        return self._make_model({"columns": cols, "table": stored_table(codes, "category-codes")})


class TargetEncoderModel(TableModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        s, names, new = self.fitted, df.columns, {}
        for i, c in enumerate(s["columns"]):
            if c in names:
                df = _looked_up(self, df, "mean", c, F.col(c).cast("string"), f"__mean_{i}")
                new[f"{c}_te"] = F.coalesce(F.col(f"__mean_{i}"), F.lit(s["prior"]).cast("double"))
        return df.select(*[F.col(c) for c in names if c not in new], *[e.alias(n) for n, e in new.items()])


class TargetEncoder(JsonEstimator):
    """F8 (documented option): mean target per category on training data;
    NULL or unseen → the overall mean. One ``groupBy`` for all columns."""
    DEFAULTS = {"columns": [], "target": "TARGET"}
    model_class = TargetEncoderModel

    def _fit(self, df: DataFrame):
        o = self.opts
        cols = list(o["columns"])
        prior = df.agg(F.avg(o["target"])).first()[0]
        if not cols:
            return self._make_model({"prior": prior, "columns": [], "table": None})
        pairs = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in cols])
        means = (df.select(F.explode(pairs).alias("s"), F.col(o["target"]).alias("t")).where("s.v IS NOT NULL")
                 .groupBy(F.lit("mean").alias("kind"), "s.c", "s.v").agg(F.avg("t").alias("x")))
        return self._make_model({"prior": prior, "columns": cols, "table": stored_table(means, "category-codes")})
