"""Feature selection.

VIF needs only the Gram matrix ``XᵀX``, the column sums and ``n``: one pass
over the rows (per-partition NumPy products in ``mapInPandas`` summed by a
``groupBy`` of the p×p cells, or one JVM aggregate for narrow inputs). Every
elimination round then works on the p×p matrix on the driver — dropping a
column deletes a row and a column, no rescan.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlens.operators.base import JsonEstimator, JsonModel


def gram_matrix(df: DataFrame, cols) -> tuple[np.ndarray, np.ndarray, int]:
    """(XᵀX, column sums, n) over rows complete in ``cols`` (as doubles)."""
    cols = list(cols)
    p = len(cols)
    base = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)]).na.drop()

    def partial(it):
        G = s = None
        n = 0
        for pdf in it:
            X = pdf.to_numpy(dtype="float64")
            g, v = X.T @ X, X.sum(axis=0)
            G, s = (g, v) if G is None else (G + g, s + v)
            n += len(X)
        if G is None:
            return
        rows = [(i, j, float(G[i, j])) for i in range(p) for j in range(i, p)]
        rows += [(-1, j, float(s[j])) for j in range(p)] + [(-1, -1, float(n))]
        yield pd.DataFrame(rows, columns=["i", "j", "v"])

    cells = (base.mapInPandas(partial, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
             .collect())  # p(p+1)/2 + p + 1 rows
    G, s, n = np.zeros((p, p)), np.zeros(p), 0
    for r in cells:
        if r["i"] == -1 and r["j"] == -1:
            n = int(r["v"])
        elif r["i"] == -1:
            s[r["j"]] = r["v"]
        else:
            G[r["i"], r["j"]] = G[r["j"], r["i"]] = r["v"]
    return G, s, n


def vif_from_gram(G: np.ndarray, s: np.ndarray, n: int, rtol: float = 1e-10) -> np.ndarray:
    """VIF of each column regressed on the others without an added intercept.

    R² is uncentred unless a constant lies in the span of the other columns
    (then it is centred, as a regression package that detects an implicit
    constant does). A perfect fit gives an infinite VIF. Columns are first
    scaled to unit length, so the cut-off of small singular values means the
    same for rates and for amounts.
    """
    p = G.shape[0]
    length = np.sqrt(np.where(np.diag(G) > 0, np.diag(G), 1.0))
    G, s = G / np.outer(length, length), s / length
    out = np.empty(p)
    for i in range(p):
        rest = [j for j in range(p) if j != i]
        if not rest:
            out[i] = 1.0
            continue
        Gr = G[np.ix_(rest, rest)]
        g = G[rest, i]
        pinv = np.linalg.pinv(Gr, rcond=1e-12, hermitian=True)
        ssr = G[i, i] - g @ pinv @ g
        sr = s[rest]
        const_resid = n - sr @ pinv @ sr  # 0 when a constant is in the span
        tss = G[i, i] - (s[i] ** 2) / n if abs(const_resid) <= 1e-8 * max(n, 1) else G[i, i]
        if ssr <= rtol:
            out[i] = np.inf
        else:
            out[i] = tss / ssr
    return out


def vif_filter(df: DataFrame, cols, threshold: float = 10.0) -> tuple[list[str], list[str], list[list]]:
    """G1: drop the column with the largest VIF while it exceeds the
    threshold. Returns (kept, removed in order, per-round VIF tables)."""
    cols = list(cols)
    G, s, n = gram_matrix(df, cols)
    idx = list(range(len(cols)))
    removed, history = [], []
    while len(idx) > 0:
        v = vif_from_gram(G[np.ix_(idx, idx)], s[idx], n)
        history.append([(cols[i], float(x)) for i, x in zip(idx, v)])
        k = int(np.argmax(v))
        if v[k] > threshold:
            removed.append(cols[idx[k]])
            idx.pop(k)
        else:
            break
    return [cols[i] for i in idx], removed, history


def binary_columns(df: DataFrame, cols) -> tuple[list[str], dict[str, float]]:
    """Columns with exactly two distinct non-null values, and every column's
    population variance. Two aggregates (min/max/variance, then a count of
    values other than min and max) decide it without a distinct-count
    shuffle."""
    cols = list(cols)
    a = df.agg(*[x for i, c in enumerate(cols) for x in (
        F.min(F.col(c).cast("double")).alias(f"lo{i}"), F.max(F.col(c).cast("double")).alias(f"hi{i}"),
        F.var_pop(F.col(c).cast("double")).alias(f"v{i}"))]).first()
    others = df.agg(*[F.sum((~F.col(c).cast("double").isin(a[f"lo{i}"], a[f"hi{i}"])).cast("long")).alias(f"o{i}")
                      if a[f"lo{i}"] is not None else F.lit(0).alias(f"o{i}") for i, c in enumerate(cols)]).first()
    binary = [c for i, c in enumerate(cols)
              if a[f"lo{i}"] is not None and a[f"lo{i}"] != a[f"hi{i}"] and not others[f"o{i}"]]
    return binary, {c: a[f"v{i}"] for i, c in enumerate(cols)}


def binary_variance_filter(df: DataFrame, cols, threshold: float = 0.01) -> tuple[list[str], list[str]]:
    """Binary columns are kept only if their population variance exceeds
    the threshold. Order: non-binary, then kept binary."""
    cols = list(cols)
    binary, var = binary_columns(df, cols)
    keep_bin = [c for c in binary if var[c] > threshold]
    removed = [c for c in binary if c not in keep_bin]
    return [c for c in cols if c not in binary] + keep_bin, removed


class FeatureSelectorModel(JsonModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        sel = self.fitted["selected_features"]
        missing = set(sel) - set(df.columns)
        if missing:
            raise ValueError(f"Features missing in transform data: {sorted(missing)}")
        keep = [c for c in self.fitted.get("passthrough", []) if c in df.columns]
        return df.select(*keep, *sel)

    def get_feature_names_out(self) -> list[str]:
        return list(self.fitted["selected_features"])


class FeatureSelector(JsonEstimator):
    """``logistic`` → VIF filter then binary-variance filter; ``tree`` →
    binary-variance filter only. ``passthrough`` columns (e.g. the label) are
    kept untouched."""
    DEFAULTS = {"model_base": "logistic", "vif_threshold": 10.0, "variance_threshold": 0.01,
                "passthrough": ["ID", "TARGET"]}
    model_class = FeatureSelectorModel

    def _fit(self, df: DataFrame):
        o = self.opts
        base = o["model_base"].lower()
        cols = [c for c in df.columns if c not in o["passthrough"]]
        removed_vif = []
        if base == "logistic":
            cols, removed_vif, _ = vif_filter(df, cols, o["vif_threshold"])
        elif base != "tree":
            raise ValueError(f"Unknown model_base: {o['model_base']}. Choose from: 'logistic', 'tree'")
        selected, removed_var = binary_variance_filter(df, cols, o["variance_threshold"])
        keep = [c for c in o["passthrough"] if c in df.columns]
        return self._make_model({"selected_features": selected, "passthrough": keep,
                                 "removed_vif_features": removed_vif, "removed_variance_features": removed_var})
