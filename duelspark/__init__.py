"""duelspark: Spark-native analysis and prediction of head-to-head contests.

Main entry points (all take and return Spark DataFrames):

* ``plans.stages``: ingest, preprocess, features, cluster, model, evaluate
* ``operators.clean``: clean_contests, invalid_contests, serve_ratios, fill_rank, fill_height
* ``operators.history``: history_features (form, surface form, workload, serve means, best rank)
* ``operators.rating``: elo_ratings, elo_expectation
* ``operators.matrix``: pre_match, main_draw, swap_sides, encode, feature_matrix, join_clusters
* ``operators.profiles``: career_profiles, kmeans_sweep, pick_elbow, assign_clusters, centroids
* ``operators.models``: fit_logistic, fit_forest, fit_boosted, score, importances, save, load
* ``operators.evaluate``: slice_table, model_metrics, calibration, confusion, accuracy_by,
  binned_win_rate, upset_histogram, top_upsets, roc_points
* ``operators.inspect`` / ``operators.stats``: describe, shape, head, exact_quantiles
* ``sources.files``: read_contests, read_rankings, read_players, write_table, ...

Parameters live in ``Settings`` (``Settings.reference()`` / ``Settings.fixture()``).
"""

from .settings import Settings

__all__ = ["Settings"]
__version__ = "0.1.0"
