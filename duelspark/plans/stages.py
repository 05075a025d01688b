"""The reference's stages as library calls: each reads the previous stage's
table from ``out_dir`` and writes its own (Parquet partitioned by season for
contest tables; small reports as CSV/JSON). No stage collects data rows; the
only driver-side values are counts, the chosen K and fitted model objects.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clean, evaluate as E, matrix as M, models as ML, profiles as P
from ..operators.frames import attach_row
from ..session import materialize
from ..settings import Settings
from ..sources import files

MODEL_OUT = {"logistic_regression": "lr_prob", "random_forest": "rf_prob", "boosted_trees": "xgb_prob"}


def _p(out_dir: str, name: str) -> str:
    return f"{out_dir.rstrip('/')}/{name}"


def ingest(spark: SparkSession, family_paths: dict[str, list[str]], out_dir: str, s: Settings,
           ranking_paths: list[str] | None = None, players_path: str | None = None,
           common_only: bool = True) -> dict | None:
    """Stage 1: read, tag, reconcile, clean and write the contests; rankings and
    players pass through. Returns the row counts, total and per family
    (AGG1-2), read from the written table (a one-column scan), so the
    cleaning plan runs once. (An ``Observation`` would save that scan, but a
    session that has observed anything can no longer be serialized, and the
    forest's scoring expression carries its session: stage 5 would fail.)"""
    raw = files.read_contests(spark, family_paths, common_only=common_only)
    if raw is None:
        return None
    files.write_table(files.with_season(clean.clean_contests(raw, s)), _p(out_dir, "cleaned"), ["season"])
    counted = spark.read.parquet(_p(out_dir, "cleaned")).agg(
        F.count(F.lit(1)).alias("all"),
        *[F.count_if(F.col("match_source") == fam).alias(fam) for fam in family_paths]).first()
    counts = counted.asDict()
    files.write_table(clean.invalid_contests(raw, s), _p(out_dir, "rejected"))  # H9 side output
    if ranking_paths:
        rk = files.read_rankings(spark, ranking_paths)
        if rk is not None:
            files.write_table(rk, _p(out_dir, "rankings"))
    if players_path:
        pl = files.read_players(spark, players_path)
        if pl is not None:
            files.write_table(pl, _p(out_dir, "players"))
    return counts


def _rankings(spark: SparkSession, out_dir: str) -> DataFrame | None:
    """The stored rankings; None where stage 1 had none (peak rank stays NULL)."""
    there = files.existing(spark, [_p(out_dir, "rankings")])
    return spark.read.parquet(*there) if there else None


def preprocess(spark: SparkSession, out_dir: str, s: Settings) -> None:
    """Stage 2: ratios, rank fill, per-surface median height fill."""
    c = spark.read.parquet(_p(out_dir, "cleaned"))
    out = clean.fill_height(clean.fill_rank(clean.serve_ratios(c), s))
    files.write_table(out, _p(out_dir, "preprocessed"), ["season"])


def features(spark: SparkSession, out_dir: str, s: Settings) -> None:
    """Stage 3: the pre-match feature matrix (history, rating, as-of, swap, encodings)."""
    prep = spark.read.parquet(_p(out_dir, "preprocessed")).drop("season")
    fm = M.feature_matrix(prep, _rankings(spark, out_dir), s)
    files.write_table(files.with_season(fm), _p(out_dir, "features"), ["season"])


def cluster(spark: SparkSession, out_dir: str, s: Settings) -> int:
    """Stage 4: career profiles, K-Means sweep, elbow, assignment, centroids."""
    prof = P.career_profiles(spark.read.parquet(_p(out_dir, "preprocessed")))
    sweep = P.kmeans_sweep(prof, s)
    curve = P.inertia_table(spark, sweep)
    files.write_small_csv(curve, _p(out_dir, "reports/kmeans_inertia"))
    k = P.pick_elbow(curve).first()["k"]
    assigned = P.assign_clusters(prof, next(x for x in sweep if x.k == k).centers)
    files.write_table(assigned.select("player_id", "player_name", "cluster"), _p(out_dir, "player_clusters"))
    files.write_small_csv(P.centroids(assigned), _p(out_dir, "reports/centroids"))
    return k


def model(spark: SparkSession, out_dir: str, s: Settings, grids: ML.Grids | None = None) -> dict:
    """Stage 5: join clusters, split by date, fit the three grids, score the
    test split, save models and the model description."""
    grids = grids or ML.Grids.reference()
    fm = spark.read.parquet(_p(out_dir, "features")).drop("season")
    cl = spark.read.parquet(_p(out_dir, "player_clusters"))
    table = M.join_clusters(fm, cl, s).withColumn("split", M.split_column(s))
    table = table.where(F.col("split").isNotNull())  # contests outside all splits take no part
    feats = M.model_columns(table, s)
    table = table.withColumns({c: F.col(c).cast("double") for c in feats})
    files.write_table(table, _p(out_dir, "model_table"))
    table = spark.read.parquet(_p(out_dir, "model_table"))
    tr, va, te = (table.where(F.col("split") == x) for x in ("train", "val", "test"))
    from concurrent.futures import ThreadPoolExecutor
    fitters = (ML.fit_logistic, ML.fit_forest, ML.fit_boosted)
    with ThreadPoolExecutor(max_workers=3) as pool:  # independent families, concurrent jobs
        fitted = list(pool.map(lambda fit: fit(tr, va, feats, s, grids), fitters))
    for f in fitted:
        ML.save(f, _p(out_dir, f"models/{f.name}"))
    pred = ML.score(te, fitted, MODEL_OUT)
    files.write_table(pred, _p(out_dir, "test_predictions"))
    pred = spark.read.parquet(_p(out_dir, "test_predictions"))
    test_m = E.model_metrics(pred, MODEL_OUT, [])
    files.write_table(ML.score(va, fitted, MODEL_OUT), _p(out_dir, "val_predictions"))
    val_m = E.model_metrics(spark.read.parquet(_p(out_dir, "val_predictions")), MODEL_OUT, [])
    metrics = F.collect_list(F.struct("model", "n", "accuracy", "log_loss", "auc_roc"))
    counts = table.groupBy("split").count()
    bounds = [(name, *getattr(s.splits, name)) for name in ("train", "val", "test")]
    chosen = [F.struct(F.lit(f.name).alias("model"), *[F.lit(v).cast("string").alias(k) for k, v in f.params.items()])
              .alias(f.name) for f in fitted]
    doc = (attach_row(attach_row(
        test_m.agg(metrics.alias("test_metrics")), val_m.agg(metrics.alias("val_metrics"))),
        counts.agg(F.map_from_entries(F.collect_list(F.struct("split", "count"))).alias("split_rows")))
           .withColumn("split_bounds", F.array(*[F.struct(F.lit(n).alias("split"), F.lit(a).alias("first"),
                                                          F.lit(b).alias("last")) for n, a, b in bounds]))
           .withColumn("feature_cols", F.array(*[F.lit(c) for c in feats]))
           .withColumn("chosen_params", F.struct(*chosen)))
    files.write_document(doc, _p(out_dir, "model_schema"))
    # importances of the boosted model (SRT3 top 20)
    files.write_small_csv(ML.importances(spark, fitted[2]), _p(out_dir, "reports/importances"))
    return {f.name: f.params for f in fitted}


def evaluate(spark: SparkSession, out_dir: str, s: Settings, prob: str = "xgb_prob") -> None:
    """Stage 6: metric tables (CSV) and the evaluation summary (JSON)."""
    pred = spark.read.parquet(_p(out_dir, "test_predictions"))
    rep = lambda n: _p(out_dir, f"reports/{n}")
    slices = materialize(E.slice_tables(pred, ["surface", "tourney_level"], prob), "slices")
    by_surface, by_level = (slices.where(F.col("by_col") == c).drop("by_col") for c in ("surface", "tourney_level"))
    files.write_small_csv(by_surface, rep("metrics_by_surface"))
    files.write_small_csv(by_level, rep("metrics_by_level"))
    files.write_small_csv(E.calibration(pred, prob), rep("calibration"))
    files.write_small_csv(E.confusion(pred, prob), rep("confusion"))
    files.write_small_csv(E.accuracy_by(pred, "tourney_level", prob).orderBy("tourney_level"), rep("accuracy_by_level"))
    files.write_small_csv(E.accuracy_by_year(pred, prob), rep("accuracy_by_year"))
    files.write_csv(E.roc_points(pred, MODEL_OUT), rep("roc_points"))
    if "elo_diff" in pred.columns:
        files.write_small_csv(E.binned_win_rate(pred, "elo_diff", prob), rep("elo_diff_win_rate"))
    files.write_small_csv(E.upset_histogram(pred, prob), rep("upset_histogram"))
    files.write_small_csv(E.top_upsets(pred, prob), rep("top_upsets"))
    schema = files.read_document(spark, _p(out_dir, "model_schema"))
    cols = ["slice", "n", "accuracy", "log_loss", "auc_roc"]
    summary = attach_row(attach_row(
        by_surface.agg(F.collect_list(F.struct(*cols)).alias("metrics_by_surface")),
        by_level.agg(F.collect_list(F.struct(*cols)).alias("metrics_by_level"))),
        schema.select(F.col("test_metrics").alias("test_metrics_all_models"),
                      F.col("val_metrics").alias("validation_metrics_all_models"),
                      "chosen_params", F.col("split_rows").alias("splits"), "split_bounds"))
    files.write_document(summary, _p(out_dir, "evaluation_summary"))
