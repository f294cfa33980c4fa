"""Spark ML stage base classes with JSON-held options and fitted state.

Options and fitted state live in two string ``Param``s, so the stock
``DefaultParamsWriter``/``Reader`` persist any stage (alone or inside a
``Pipeline``) without custom writers. State in JSON is always small: scalars,
the column names of one-hot codes, or p×p matrices. State that grows with the
data (category codes, donors) is a Parquet table: in the shared scratch
folder after a fit, inside the stage's own folder once it is saved.
"""

from __future__ import annotations

import json

from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendlens.session import scratch_path


class _JsonParams(Params):
    options = Param(Params._dummy(), "options", "constructor options as JSON",
                    typeConverter=TypeConverters.toString)
    state = Param(Params._dummy(), "state", "fitted state as JSON",
                  typeConverter=TypeConverters.toString)

    #: Default options; subclasses override.
    DEFAULTS: dict = {}

    def _init_json(self, opts: dict) -> None:
        merged = dict(self.DEFAULTS)
        merged.update({k: v for k, v in opts.items() if v is not None or k in self.DEFAULTS})
        self._setDefault(options=json.dumps(dict(self.DEFAULTS), sort_keys=True), state="{}")
        self._set(options=json.dumps(merged, sort_keys=True))

    @property
    def opts(self) -> dict:
        return json.loads(self.getOrDefault(self.options))

    @property
    def fitted(self) -> dict:
        return json.loads(self.getOrDefault(self.state))

    def _set_state(self, state: dict):
        self._set(state=json.dumps(state, sort_keys=True, default=float))
        return self


class JsonTransformer(Transformer, _JsonParams, DefaultParamsReadable, DefaultParamsWritable):
    """Stateless stage: ``transform`` is a narrow projection."""

    def __init__(self, **opts):
        super().__init__()
        self._init_json(opts)


class JsonModel(Model, _JsonParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fitted stage: state learned from training data only."""

    def __init__(self, **opts):
        super().__init__()
        self._init_json(opts)


class _TableWriter(DefaultParamsWriter):
    """Saves the params and, beside them, the stage's table."""

    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        if self.instance.fitted.get("table"):
            self.instance.table().write.parquet(f"{path}/table")


class _TableReader(DefaultParamsReader):
    def load(self, path: str):
        stage = super().load(path)
        if stage.fitted.get("table"):
            stage._set_state({**stage.fitted, "table": f"{path}/table"})
        return stage


class TableModel(JsonModel):
    """Fitted stage with a table of any size beside its JSON state."""

    #: Values up to which a column's lookup becomes part of the projection instead of a join.
    SMALL_VALUES = 64

    def table(self) -> DataFrame:
        return SparkSession.getActiveSession().read.parquet(self.fitted["table"])

    def small_lookups(self) -> dict[tuple, dict]:
        """{(kind, c): {v: x}} of the columns with few values, all from one read of a (kind, c, v, x) table."""
        path = self.fitted["table"]
        if getattr(self, "_small", (None,))[0] != path:
            table = self.table()
            widths = table.groupBy("kind", "c").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") <= self.SMALL_VALUES)
            rows = table.join(F.broadcast(widths), ["kind", "c"]).select("kind", "c", "v", "x").collect()  # a row per column and few values
            found: dict[tuple, dict] = {}
            for r in rows:
                found.setdefault((r["kind"], r["c"]), {})[r["v"]] = r["x"]
            self._small = (path, found)
        return self._small[1]

    def write(self):
        return _TableWriter(self)

    @classmethod
    def read(cls):
        return _TableReader(cls)


def stored_table(df: DataFrame, name: str) -> str:
    """Writes a fitted table into the shared scratch folder; returns its path."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return path


class JsonEstimator(Estimator, _JsonParams, DefaultParamsReadable, DefaultParamsWritable):
    """Estimator whose ``_fit`` returns ``model_class`` carrying the state."""

    model_class: type = JsonModel

    def __init__(self, **opts):
        super().__init__()
        self._init_json(opts)

    def _make_model(self, state: dict) -> JsonModel:
        m = self.model_class(**self.opts)
        m._set_state(state)
        return m

    def fit_transform(self, df):
        return self.fit(df).transform(df)
