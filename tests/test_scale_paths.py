"""One path for every size: many classes, any key type, any scale; the package reaches the workers."""

import os
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendlens.functions.ranking import running_sums
from lendlens.operators import charts, encode, profile, select, stats
from lendlens.operators.neighbours import KnnImputer

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_running_sums_of_text_and_struct_keys(spark):
    rows = [(f"k{i:04d}", i % 7 + 1) for i in range(500)]
    df = spark.createDataFrame(rows, "v string, n long").repartition(5)
    want, total = {}, 0
    for v, n in rows:
        total += n
        want[v] = total
    assert {r["v"]: r["cum_n"] for r in running_sums(df, "v", ["n"]).collect()} == want
    assert {r["v"]: r["cum_n"] for r in running_sums(df, "v", ["n"], max_rows=40).collect()} == want
    keyed = df.withColumn("k", F.struct((-F.col("n")).alias("a"), "v"))
    down = {r["v"]: r["cum_n"] for r in running_sums(keyed, "k", ["n"], descending=True).collect()}
    order, total = sorted(rows, key=lambda r: (-r[1], r[0]), reverse=True), 0
    for v, n in order:
        total += n
        assert down[v] == total
    assert running_sums(df.limit(0), "v", ["n"]).collect() == []


def test_box_stats_of_many_classes(spark):
    rng = np.random.default_rng(1)
    rows = [(int(c), float(x)) for c in range(1500) for x in rng.normal(size=5).round(2)] + [(None, 1.0), (3, None)]
    got = {r["group"]: r for r in charts.box_stats(spark.createDataFrame(rows, "t int, x double"), "x", "t").collect()}
    assert len(got) == 1500
    for c in (0, 3, 700, 1499):
        x = np.array([v for k, v in rows if k == c and v is not None])
        q1, med, q3 = np.quantile(x, [0.25, 0.5, 0.75])
        inside = x[(x >= q1 - 1.5 * (q3 - q1)) & (x <= q3 + 1.5 * (q3 - q1))]
        r = got[str(c)]
        assert r["count"] == len(x) and r["outliers"] == len(x) - len(inside)
        assert [r["q1"], r["median"], r["q3"]] == pytest.approx([q1, med, q3])
        assert [r["whisker_low"], r["whisker_high"]] == pytest.approx([inside.min(), inside.max()])


def test_density_of_many_classes(spark):
    rows = [(c, float(x)) for c in range(70) for x in range(c + 2)]
    out = charts.distribution_by_target(spark.createDataFrame(rows, "TARGET int, x double"), "x", "TARGET", gridsize=10).collect()
    assert len(out) == 700 and {r["TARGET"] for r in out} == {str(c) for c in range(70)}
    assert all(r["density"] > 0 for r in out)


@pytest.mark.parametrize("scale", [1.0, 1e3, 1e6, 1e9])
def test_vif_at_any_scale(spark, scale):
    rng = np.random.default_rng(2)
    b0 = rng.normal(size=400)
    X = np.column_stack([b0, b0 + 0.03 * rng.normal(size=400), scale * (1 + rng.random(400)), scale * rng.normal(size=400)])
    got = select.vif_from_gram(X.T @ X, X.sum(axis=0), len(X))
    for i in range(4):
        rest = np.delete(X, i, axis=1)
        fit = rest / np.linalg.norm(rest, axis=0)
        resid = X[:, i] - fit @ np.linalg.lstsq(fit, X[:, i], rcond=None)[0]
        assert got[i] == pytest.approx((X[:, i] @ X[:, i]) / (resid @ resid), rel=1e-5)
    assert got[0] > 500
    df = spark.createDataFrame([tuple(map(float, r)) for r in X], "a double, b double, c double, d double")
    kept, removed, _ = select.vif_filter(df, ["a", "b", "c", "d"], 10.0)
    assert removed in (["a"], ["b"])


def test_ordinal_codes_of_null_and_unknown(spark):
    df = spark.createDataFrame([(1, "low"), (2, None), (3, "high"), (4, "odd")], "id int, c string")
    enc = encode.FlexibleEncoder(ordinal_encode_cols=["c"], ordinal_mappings={"c": ["low", "high"]})
    assert {r["id"]: r["c"] for r in enc.fit(df).transform(df).collect()} == {1: 0.0, 2: -1.0, 3: 1.0, 4: -1.0}


def test_encoders_of_many_values_and_saved_tables(spark, tmp_path):
    n = 120_000
    df = spark.range(n).select(F.concat(F.lit("v"), F.lpad(F.col("id").cast("string"), 7, "0")).alias("c"),
                               (F.col("id") % 2).cast("int").alias("TARGET"), "id")
    rows = df.where("id IN (0, 17, 119999)").unionByName(spark.createDataFrame([("new", 0, -1), (None, 0, -2)], "c string, TARGET int, id long"))
    models = [(encode.FlexibleEncoder(label_encode_cols=["c"]), "c", {0: 0, 17: 17, 119999: 119999, -1: 0, -2: 0}),
              (encode.FlexibleEncoder(frequency_encode_cols=["c"]), "c_freq", {0: 1 / n, 17: 1 / n, 119999: 1 / n, -1: 0.0, -2: 0.0}),
              (encode.DictionaryEncoder(columns=["c"]), "c", {0: 0, 17: 17, 119999: 119999, -1: -1, -2: -1}),
              (encode.TargetEncoder(columns=["c"]), "c_te", {0: 0.0, 17: 1.0, 119999: 1.0, -1: 0.5, -2: 0.5})]
    for i, (encoder, name, want) in enumerate(models):
        model = encoder.fit(df)
        model.write().save(f"{tmp_path}/{i}")
        again = type(model).load(f"{tmp_path}/{i}")
        assert again.fitted["table"] == f"{tmp_path}/{i}/table"
        assert {r["id"]: r[name] for r in again.transform(rows).collect()} == pytest.approx(want)
    with pytest.raises(ValueError):
        encode.FlexibleEncoder(onehot_encode_cols=["c"]).fit(df)


@pytest.mark.parametrize("width, share", [(9, 0.4), (18, 0.15)])
def test_knn_imputer_of_many_missing_patterns(spark, width, share):
    rng = np.random.default_rng(width)
    x = rng.normal(size=(300, width)) * np.linspace(0.2, 3, width)
    x[rng.random(x.shape) < share] = np.nan
    names = [f"x{i}" for i in range(width)]
    df = spark.createDataFrame([(i, *[None if np.isnan(v) else float(v) for v in r]) for i, r in enumerate(x)],
                               "ID long, " + ", ".join(f"{c} double" for c in names))
    model = KnnImputer(target_cols=names[:2], feature_cols=names[2:]).fit(df)
    got = {r["ID"]: r for r in model.transform(df).collect()}
    assert len(got) == 300
    for i in range(300):
        for c in (0, 1):
            if not np.isnan(x[i, c]):
                assert got[i][names[c]] == x[i, c]
                continue
            both = ~np.isnan(x) & ~np.isnan(x[i])
            d = np.sqrt(np.where(both, (x - x[i]) ** 2, 0).sum(1) * width / np.maximum(both.sum(1), 1))
            d[~both.any(1) | np.isnan(x[:, c])] = np.inf
            near = np.lexsort((np.arange(300), d))[:5]
            assert got[i][names[c]] == pytest.approx(x[near[np.isfinite(d[near])], c].mean(), rel=1e-9)


def test_contingency_of_many_classes(spark):
    rng = np.random.default_rng(5)
    f, t = rng.integers(0, 6, 4000), rng.integers(0, 90, 4000)
    df = spark.createDataFrame([(f"v{a}", int(b)) for a, b in zip(f, t)], "f string, TARGET int")
    table = np.zeros((6, 90))
    np.add.at(table, (f, t), 1)
    e = table.sum(1, keepdims=True) * table.sum(0) / 4000
    got = stats.contingency_stats(df, ["f"]).collect()[0]
    assert got["dof"] == 5 * 89 and got["chi2"] == pytest.approx(((table - e) ** 2 / e).sum(), rel=1e-9)
    p = table / 4000
    assert got["mutual_information"] == pytest.approx((p * np.log(np.where(p > 0, p * 4000 / e, 1))).sum(), rel=1e-9)
    two = spark.createDataFrame([("a", 0)] * 7 + [("b", 1)] * 5 + [("b", 0)] * 3, "f string, TARGET int")
    # 2 x 2 with an empty cell: every cell is 2.3333 off, 0.5 less by Yates.
    off = abs(7 - 7 * 10 / 15) - 0.5
    want = sum(off ** 2 / (r * c / 15) for r in (7, 8) for c in (10, 5))
    assert stats.contingency_stats(two, ["f"]).collect()[0]["chi2"] == pytest.approx(want)


def test_distinct_counts_up_to_a_limit(spark):
    df = spark.range(0, 5000, 1, 6).select((F.col("id") % 7).alias("a"), "id", F.lit(None).cast("double").alias("z"))
    assert profile.distinct_counts_upto(df, ["a", "id", "z"], 10) == {"a": 7, "id": 11, "z": 0}


def test_package_reaches_workers_from_another_folder(tmp_path):
    code = (f"import sys; sys.path.insert(0, {ROOT!r})\n"
            "from pyspark.sql import SparkSession\n"
            "import __spark_entry__ as e\n"
            "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false')"
            ".config('spark.sql.shuffle.partitions', '2').getOrCreate()\n"
            "print('ROWS', len(e.queries()['h9_chi2_with_p'](s, '/root/testdata/sf0.001').collect()))\n")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS 1" in out.stdout, out.stderr[-2000:]
