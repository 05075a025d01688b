"""Newton logistic regression, slices from one ranking, estimated summaries."""

import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from duelspark.operators import evaluate as E
from duelspark.operators import inspect, logistic
from duelspark.operators import models as ML
from duelspark.settings import Settings

COLS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def labelled(spark):
    rnd = random.Random(8)
    rows = []
    for _ in range(900):
        x = [rnd.gauss(0, 1), rnd.gauss(2, 3), rnd.random()]
        rows.append((*x, int(rnd.random() < 1 / (1 + math.exp(-(x[0] - 0.4 * x[1] + 0.5))))))
    return spark.createDataFrame(rows, "a double, b double, c double, y int").repartition(7)


def vectors(df):
    return VectorAssembler(inputCols=COLS, outputCol="f").transform(df)


def test_gradient_is_zero_by_sql(spark, labelled):
    df = labelled.toPandas()  # noqa: F841 - read by the SQL
    for found in logistic.fit(vectors(labelled), "f", "y", (0.01, 1.0, 10.0)):
        w = [float(v) for v in found.weights]
        p = f"1 / (1 + exp(-({w[0]!r} * a + {w[1]!r} * b + {w[2]!r} * c + {w[3]!r})))"
        own = [f"(sum(({p} - y) * {c}) + {w[i]!r} / {found.penalty!r}) / count(*)" for i, c in enumerate(COLS)]
        got = duckdb.sql(f"SELECT {', '.join(own)}, sum({p} - y) / count(*) FROM df").fetchall()[0]
        assert max(abs(g) for g in got) < 1e-8
        n = len(df)
        lr = LogisticRegression(featuresCol="f", labelCol="y", regParam=1 / (found.penalty * n), standardization=False,
                                maxIter=2000, tol=1e-12).fit(vectors(labelled))
        assert np.allclose([*lr.coefficients, lr.intercept], w, atol=1e-4)


def test_odd_labels_and_copied_features(spark, labelled):
    same = labelled.withColumn("b", F.col("a"))
    w = logistic.fit(vectors(same), "f", "y", (1.0,))[0].weights
    assert w[0] == pytest.approx(w[1], abs=1e-7)
    gaps = labelled.unionByName(labelled.withColumn("y", F.lit(None).cast("int")))
    assert np.allclose(logistic.fit(vectors(gaps), "f", "y", (1.0,))[0].weights,
                       logistic.fit(vectors(labelled), "f", "y", (1.0,))[0].weights, atol=1e-7)
    ones = logistic.fit(vectors(labelled.withColumn("y", F.lit(1))), "f", "y", (1.0,))[0]
    assert ones.gradient < 1e-9 and ones.weights[-1] > 5
    assert len(logistic.fit(vectors(labelled.where("false")), "f", "y", (1.0, 2.0))) == 2
    with pytest.raises(RuntimeError):
        logistic.fit(vectors(labelled), "f", "y", (1.0,), max_rounds=1)


def test_fitted_formula_holds_the_scaling(spark, labelled, tmpdir_path):
    df = labelled.withColumnRenamed("y", "target").withColumn("c", F.lit(3.0))  # a feature without spread
    f = ML.fit_logistic(df, df, COLS, Settings.fixture(), ML.Grids(logistic_c=(1.0,)))
    ML.save(f, f"{tmpdir_path}/lr")
    again = ML.Fitted(f.name, ML.load(f"{tmpdir_path}/lr"), f.params, {}, f.prob_col)
    got = again.with_probability(df, "p").toPandas()
    z = got[COLS[:2]].to_numpy()
    z = (z - z.mean(axis=0)) / z.std(axis=0, ddof=1)
    scaled = VectorAssembler(inputCols=["u", "v"], outputCol="f").transform(spark.createDataFrame(
        [(float(u), float(v), int(y)) for (u, v), y in zip(z, got["target"])], "u double, v double, y int"))
    w = logistic.fit(scaled, "f", "y", (1.0,))[0].weights
    assert np.allclose(got["p"], 1 / (1 + np.exp(-(z @ w[:2] + w[2]))), atol=1e-7)


def test_slices_of_all_columns_equal_single_tables(spark):
    rnd = random.Random(1)
    df = spark.createDataFrame([(rnd.choice(["x", "y", None]), rnd.choice(["x", "overall", "q"]), rnd.randint(0, 1),
                                 round(rnd.random(), 2)) for _ in range(500)], "s string, t string, target int, prob double")
    got = E.slice_tables(df, ["s", "t"], "prob")
    for c in ("s", "t"):
        one = {r["slice"]: r for r in E.slice_table(df, c, "prob").collect()}
        many = {r["slice"]: r for r in got.where(F.col("by_col") == c).collect()}
        assert one.keys() == many.keys() and "overall" in one
        for k, r in one.items():
            assert [r[x] for x in r.asDict()] == pytest.approx([many[k][x] for x in r.asDict()])
    assert E.slice_tables(df.where("false"), ["s", "t"], "prob").count() == 0


def test_estimated_summary_within_its_bounds(spark):
    n = 20_000
    df = spark.range(n).select(F.col("id"), (F.col("id") * 7919 % n).cast("double").alias("x.y"), F.lit(None).cast("int").alias("none"),
                               F.when(F.col("id") % 3 > 0, F.concat(F.lit("v"), F.sqrt("id").cast("int"))).alias("s"),
                               F.lit(None).cast("string").alias("empty"), (F.col("id") % 5 == 0).alias("b"))
    got = {r["column"]: r for r in inspect.describe_estimated(df, 1000).collect()}
    want = {r["column"]: r for r in inspect.describe(df.withColumnRenamed("x.y", "xy")).collect()}
    want["x.y"] = want.pop("xy")
    assert got.keys() == want.keys()
    for c, w in want.items():
        for k in ("count", "mean", "std", "min", "max"):
            assert got[c][k] == pytest.approx(w[k])
    for c in ("id", "x.y"):
        assert all(abs(got[c][q] - want[c][q]) <= n / 1000 + 1 for q in ("25%", "50%", "75%"))
    assert abs(got["s"]["unique"] - want["s"]["unique"]) <= 0.2 * want["s"]["unique"]
    for c in ("s", "b"):
        assert got[c]["freq"] == want[c]["freq"] and (c == "s" or got[c]["top"] == want[c]["top"])
    assert (got["empty"]["unique"], got["empty"]["top"], got["none"]["50%"]) == (0, None, None)
    assert inspect.describe_estimated(df.select(F.array("id").alias("z"))).count() == 0
