"""Raw trees with categories and gaps; experiments that go on after a failure and a restart."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import PipelineModel  # noqa: F401
from pyspark.sql import functions as F

from lendlens.operators import evaluate
from lendlens.operators.models import RawTreeFeatures, fit_classifier, predict
from lendlens.plans import experiments as ex
from lendlens.plans.catalog import apps
from tests.conftest import SMOKE_DIR

SMALL = {"logistic_regression": {"maxIter": 5}, "random_forest": {"numTrees": 4, "maxDepth": 3}, "gradient_boosting": {"maxIter": 2, "maxDepth": 2}}


def table(spark, n=3000):
    rng = np.random.default_rng(6)
    kind = rng.choice(list("abcdefgh"), n)
    x = rng.normal(size=n)
    gap = rng.random(n) < 0.3
    y = np.where(gap, 1, (x > 0.8).astype(int)) if n else []
    y = np.where(np.isin(kind, ["a", "c", "e", "g"]), y, 1 - y)
    frame = pd.DataFrame({"ID": np.arange(n), "TARGET": y, "kind": np.where(rng.random(n) < 0.05, None, kind), "x": np.where(gap, np.nan, x),
                          "whole": rng.integers(0, 9, n)})
    return spark.createDataFrame(frame).withColumn("x", F.when(~F.isnan("x"), F.col("x")))


def test_categories_are_sets_and_gaps_go_either_way(spark):
    train = table(spark)
    raw = RawTreeFeatures(train, exclude=("TARGET", "ID"))
    assert raw.names == ["kind", "x_gaps_low", "x_gaps_high", "whole"] and raw.max_bins == 32
    ready = raw.transform(train, ["ID", "TARGET"])
    assert ready.schema["kind"].metadata["ml_attr"] == {"type": "nominal", "num_vals": 9}
    rows = ready.join(train.select("ID", F.col("x").alias("x0"), F.col("kind").alias("k0")), "ID").collect()
    top, low = max(r["x0"] for r in rows if r["x0"] is not None), min(r["x0"] for r in rows if r["x0"] is not None)
    for r in rows:
        if r["x0"] is None:
            assert r["x_gaps_low"] < low and r["x_gaps_high"] > top
        else:
            assert r["x_gaps_low"] == r["x_gaps_high"] == r["x0"]
        assert (r["kind"] == 8) == (r["k0"] is None) and 0 <= r["kind"] <= 8
    # One tree of depth 2 parts the eight kinds into two sets and finds the side of the gaps.
    model = fit_classifier(ready, raw.names, "gradient_boosting", params={"maxIter": 1, "maxDepth": 3, "subsamplingRate": 1.0, "featureSubsetStrategy": "all",
                                                                         "maxBins": raw.max_bins})
    attrs = model.stages[0].transform(ready).schema["features"].metadata["ml_attr"]["attrs"]
    assert [a["name"] for a in attrs["nominal"]] == ["kind"] and len(attrs["numeric"]) == 3
    scored = predict(model, ready.withColumn("label", F.col("TARGET").cast("double")))
    assert evaluate.evaluate(scored)["accuracy"] > 0.95
    unseen = raw.transform(spark.createDataFrame([(1, 0, "zz", None, None)], train.schema), ["ID"]).first()
    assert unseen["kind"] == 8 and unseen["whole"] < 0


def test_wide_and_empty_columns(spark):
    df = spark.range(3000).selectExpr("id AS ID", "id % 2 AS TARGET", "CONCAT('v', id) AS many", "CAST(NULL AS DOUBLE) AS none", "CAST(NULL AS STRING) AS no_text")
    raw = RawTreeFeatures(df, exclude=("TARGET", "ID"))
    out = raw.transform(df, ["TARGET"])
    assert raw.max_bins == 32 and not out.schema["many"].metadata and out.schema["no_text"].metadata["ml_attr"]["num_vals"] == 1
    assert out.select(raw.names).first() is not None and out.where("none_gaps_low >= none_gaps_high").isEmpty()


@pytest.mark.parametrize("parallel", [1, 3])
def test_failures_are_recorded_and_reruns_go_on(spark, tmp_path, monkeypatch, parallel):
    df = apps(spark, SMOKE_DIR)
    calls, whole = [], ex.raw_baseline

    def broken(train, test, model, *rest):
        calls.append(model)
        if model == "random_forest" and len(calls) <= 3:
            raise ValueError("planted")
        return whole(train, test, model, *rest)

    monkeypatch.setattr(ex, "raw_baseline", broken)
    run = lambda: {r["model"]: r for r in ex.run_experiments(
        spark, df, models=tuple(SMALL), data_types=("raw",), use_smote=False, params=SMALL,
        results_path=str(tmp_path / "results"), parallel=parallel).collect()}
    first = run()
    assert list(first) == list(SMALL) and "planted" in first["random_forest"]["error"] and first["random_forest"]["test_roc_auc"] is None
    assert all(first[m]["error"] is None and first[m]["test_roc_auc"] > 0.4 for m in SMALL if m != "random_forest")
    again = run()
    assert calls[3:] == ["random_forest"] and again["random_forest"]["error"] is None
    assert {m: again[m] for m in SMALL if m != "random_forest"} == {m: first[m] for m in SMALL if m != "random_forest"}
    assert run() == again and len(calls) == 4


def test_streamed_counts_survive_a_restart(spark, tmp_path):
    from lendlens.streaming.scoring import count_stream, latest_counts
    train = table(spark).select("ID", "TARGET", "whole", F.coalesce("x", F.lit(9.0)).alias("x"))
    model = fit_classifier(train, ["whole", "x"], "logistic_regression", params={"maxIter": 5})
    path = ex.save_model(str(tmp_path / "model"), model, "logistic_regression", "raw", ["whole", "x"])
    rows, n = train.drop("TARGET"), 0
    for k in range(3):  # three runs of the stream, two files each, one file a batch
        part = rows.where(F.col("ID") % 3 == k)
        part.repartition(2).write.mode("append").parquet(str(tmp_path / "in"))
        query = count_stream(spark, path, str(tmp_path / "in"), rows.schema, str(tmp_path / "out"), str(tmp_path / "ckpt"), files_per_trigger=1)
        query.awaitTermination()
        n += part.count()
        got = {r["prediction"]: r["count"] for r in latest_counts(spark, str(tmp_path / "out")).collect()}
        so_far = ex.score_frame(ex.load_model(path), rows.where(F.col("ID") % 3 <= k))
        want = {r["prediction"]: r["count"] for r in so_far.groupBy("prediction").count().collect()}
        assert got == want and sum(got.values()) == n
    assert len(list((tmp_path / "out").iterdir())) == 6
