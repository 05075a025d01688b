"""Spark ML stages: recovery on separable data, grid choice, saved models."""

import random

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from duelspark.operators import models as ML
from duelspark.operators import profiles as P
from duelspark.operators.stats import exact_medians
from duelspark.settings import Settings

S = Settings.fixture()


@pytest.fixture(scope="module")
def separable(spark):
    rnd = random.Random(5)
    rows = []
    for i in range(1200):
        a, b = rnd.gauss(0, 1), rnd.gauss(0, 1)
        y = 1 if a + 0.5 * b > 0 else 0
        rows.append((i, y, a if i % 17 else None, b, "train" if i < 800 else ("val" if i < 1000 else "test")))
    return spark.createDataFrame(rows, "contest_id long, target int, elo_diff double, rank_diff double, split string")


def test_logistic_recovers_separable_rule(spark, separable):
    tr, va = (separable.where(F.col("split") == s) for s in ("train", "val"))
    g = ML.Grids.reduced()
    f = ML.fit_logistic(tr, va, ["elo_diff", "rank_diff"], S, g)
    assert f.val_metrics["accuracy"] > 0.9
    assert f.params["C"] in g.logistic_c


def test_grid_choice_is_lowest_validation_loss(spark, separable):
    tr, va = (separable.where(F.col("split") == s) for s in ("train", "val"))
    g = ML.Grids(logistic_c=(0.0001, 10.0))
    f = ML.fit_logistic(tr, va, ["elo_diff", "rank_diff"], S, g)
    assert f.params["C"] == 10.0  # strong penalty underfits a separable rule


def test_saved_pipeline_scores_equal(spark, separable, tmpdir_path):
    tr, va, te = (separable.where(F.col("split") == s) for s in ("train", "val", "test"))
    g = ML.Grids(boosted=((12, 0.3, 3, 1.0),), patience=3)
    f = ML.fit_boosted(tr, va, ["elo_diff", "rank_diff"], S, g)
    path = f"{tmpdir_path}/gbt"
    ML.save(f, path)
    back = ML.load(path)
    a = ML.score(te, [f], {"boosted_trees": "p"}).orderBy("contest_id").collect()
    b = ML.score(te, [ML.Fitted(f.name, back, f.params, f.val_metrics, f.prob_col)],
                 {"boosted_trees": "p"}).orderBy("contest_id").collect()
    assert [r.p for r in a] == [r.p for r in b]
    assert sum((r.p >= 0.5) == (r.target == 1) for r in a) / len(a) > 0.85
    imp = ML.importances(spark, f).collect()
    assert imp[0].feature == "elo_diff"


def test_kmeans_elbow_finds_three_blobs(spark):
    rnd = random.Random(2)
    centers = [(0, 0, 0, 0, 0, 0), (5, 5, 5, 0, 0, 0), (0, 0, 0, 5, 5, 5)]
    rows = [(i, f"p{i}", *[c + rnd.gauss(0, 0.3) for c in centers[i % 3]]) for i in range(90)]
    cols = ["ace_rate", "df_rate", "1st_serve_pct", "1st_serve_win_pct", "2nd_serve_win_pct", "bp_saved_pct"]
    prof = spark.createDataFrame(rows, ["player_id", "player_name", *cols])
    sweep = P.kmeans_sweep(prof, S.with_(k_range=(2, 3, 4, 5, 6)), restarts=3)
    k = P.pick_elbow(P.inertia_table(spark, sweep)).first()["k"]
    assert k == 3
    assigned = P.assign_clusters(prof, next(x for x in sweep if x.k == 3).centers)
    assert assigned.select("cluster").distinct().count() == 3
    assert P.centroids(assigned).count() == 3


def test_pipeline_medians_are_exact(spark, separable, tmpdir_path):
    tr, va = (separable.where(F.col("split") == s) for s in ("train", "val"))
    f = ML.fit_logistic(tr, va, ["elo_diff", "rank_diff"], S, ML.Grids(logistic_c=(1.0,)))
    ML.save(f, f"{tmpdir_path}/lr")
    gap = spark.createDataFrame([(None, float("nan"))], "elo_diff double, rank_diff double")
    filled = ML.load(f"{tmpdir_path}/lr").transform(gap).first()
    want = exact_medians(tr, ["elo_diff", "rank_diff"]).first()
    assert (filled["elo_diff__imp"], filled["rank_diff__imp"]) == (want["elo_diff"], want["rank_diff"])


def test_lloyd_inertia_by_sql(spark):
    """All restarts advance together; the inertia is that of the returned centres, which are a fixed point."""
    rnd = random.Random(4)
    cols = ["ace_rate", "df_rate", "1st_serve_pct", "1st_serve_win_pct", "2nd_serve_win_pct", "bp_saved_pct"]
    rows = [(i, f"p{i}", *[rnd.gauss(3 * (i % 4), 1) for _ in cols]) for i in range(300)]
    prof = spark.createDataFrame(rows, ["player_id", "player_name", *cols]).repartition(5)
    one = P.kmeans_sweep(prof, S.with_(k_range=(2, 4)), restarts=1)
    sweep = P.kmeans_sweep(prof, S.with_(k_range=(2, 4)), restarts=6)
    assert all(a.cost >= b.cost for a, b in zip(one, sweep))
    z = P.standardize(prof, cols, "_z").toPandas()
    c = pd.DataFrame([(x.k, j, *row) for x in sweep for j, row in enumerate(x.centers)],
                     columns=["k", "j", *[f"c{i}" for i in range(6)]])
    dist = " + ".join(f'pow("{f}_z" - c{i}, 2)' for i, f in enumerate(cols))
    near = f"SELECT k, player_id, min({dist}) AS d, arg_min(j, {dist}) AS j FROM z, c GROUP BY k, player_id"
    got = duckdb.sql(f"SELECT k, sum(d) FROM ({near}) GROUP BY k ORDER BY k").fetchall()
    assert [x[1] for x in got] == pytest.approx([x.cost for x in sweep])
    means = duckdb.sql(f"""SELECT max(abs(m - x)) FROM (SELECT k, j, avg("{cols[0]}_z") AS m FROM ({near}) n JOIN z USING (player_id)
                           GROUP BY k, j) JOIN (SELECT k, j, c0 AS x FROM c) USING (k, j)""").fetchall()[0][0]
    assert means < 0.02
    labels = {r["player_id"]: r["cluster"] for r in P.assign_clusters(prof, sweep[1].centers).collect()}
    assert labels == dict(duckdb.sql(f"SELECT player_id, j FROM ({near}) WHERE k = 4").fetchall())


def test_registered_queries_fit_the_full_grids(monkeypatch):
    from duelspark.plans import model_queries as Q
    used = []
    monkeypatch.setattr(Q, "_memo", lambda spark, sf_dir, key, fn: fn())
    monkeypatch.setattr(Q, "_splits", lambda spark, sf_dir: (None, None, None))
    monkeypatch.setattr(Q, "_features", lambda spark, sf_dir: [])
    monkeypatch.setattr(Q, "_FITTERS", {n: lambda tr, va, cols, s, grids: used.append(grids) for n in Q.OUT})
    for name in Q.OUT:
        Q.fitted(None, "", name)
    assert used == [ML.Grids.reference()] * 3
