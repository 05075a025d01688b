"""The six stages end to end on CSV files made from the sf0.001 fixture."""

import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from duelspark.operators.models import Grids
from duelspark.plans import stages
from duelspark.settings import Settings
from duelspark.sources.fixtures import FixtureTables

S = Settings.fixture().with_(kmeans_restarts=2, k_range=(2, 3, 4))


def test_stages_end_to_end(spark, tmpdir_path):
    fx = FixtureTables(spark, SF_SMALL)
    c = fx.contests()
    raw = f"{tmpdir_path}/raw"
    # one CSV folder per family and year, written by Spark (header line per part file)
    for fam in ("main", "qual_chall"):
        for y in (1995, 1996, 1997, 1998, 1999, 2000, 2001):
            part = c.where((F.col("match_source") == fam) & (F.floor(F.col("tourney_date") / 10000) == y))
            part.drop("match_source", "contest_id").coalesce(1).write.option("header", True).csv(f"{raw}/{fam}_{y}")
    paths = {fam: [f"{raw}/{fam}_{y}/{f}" for y in range(1995, 2003) if os.path.isdir(f"{raw}/{fam}_{y}")
                   for f in os.listdir(f"{raw}/{fam}_{y}") if f.endswith(".csv")]
             for fam in ("main", "qual_chall")}
    fx.rankings().coalesce(1).withColumnRenamed("player_id", "player").write.option("header", True).csv(f"{raw}/rk")
    rk_paths = [f"{raw}/rk/{f}" for f in os.listdir(f"{raw}/rk") if f.endswith(".csv")]
    out = f"{tmpdir_path}/out"
    counts = stages.ingest(spark, paths, out, S, rk_paths)
    assert counts["all"] == counts["main"] + counts["qual_chall"] > 0
    assert counts["all"] == spark.read.parquet(f"{out}/cleaned").count()
    stages.preprocess(spark, out, S)
    stages.features(spark, out, S)
    assert spark.read.parquet(f"{out}/features").count() > 0
    k = stages.cluster(spark, out, S)
    assert k in S.k_range
    params = stages.model(spark, out, S, Grids(logistic_c=(1.0,), forest=((10, 4, 5),),
                                               boosted=((8, 0.3, 3, 1.0),), patience=3))
    assert set(params) == {"logistic_regression", "random_forest", "boosted_trees"}
    stages.evaluate(spark, out, S)
    summary = spark.read.json(f"{out}/evaluation_summary", multiLine=True).first()
    assert summary["metrics_by_surface"] and summary["test_metrics_all_models"]
    assert spark.read.option("header", True).csv(f"{out}/reports/roc_points").count() > 3
