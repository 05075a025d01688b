"""Queries for profiles and clustering (stage 4), models (stage 5), exact
medians and inspection. Fitted models are rows-only checks (no SQL twin).

Expensive shared products (the K-Means sweep, the modelling table, the fitted
grids) are computed once per Spark application and scale-factor directory,
the way a stage writes its output once for the later stages; the modelling
table is written once to the cluster's checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import inspect as I
from ..operators import matrix as M
from ..operators import models as ML
from ..operators import profiles as P
from ..operators.frames import attach_row
from ..operators.stats import exact_medians
from ..session import materialize
from ..settings import NUMERIC_FEATURES, SERVE_FIELDS
from ..sources.fixtures import FixtureTables
from . import oracle_sql as O
from .ingest_queries import S, prepared
from .matrix_queries import _MF_SQL, _SW_SQL, _ENC_SQL, _prefix as _matrix_prefix
from .registry import for_check, register

_CACHE: dict = {}


def _memo(spark, sf_dir: str, key: str, fn):
    k = (spark.sparkContext.applicationId, sf_dir, key)
    if k not in _CACHE:
        _CACHE[k] = fn()
    return _CACHE[k]


def _prepared(spark, sf_dir) -> DataFrame:
    """Stages 1-2, their cleaned table written once for the profiles and the modelling table."""
    return _memo(spark, sf_dir, "prepared", lambda: prepared(spark, sf_dir, True))


# ---------------------------------------------------------------- profiles
def _side_sql(tag: str, full: str, rank: int) -> str:
    ratios = ", ".join(f'{tag}_{f} AS "{f}"' for f in SERVE_FIELDS)
    return (f"SELECT {full}_id AS player_id, {full}_name AS player_name, "
            f"[{rank}, tourney_date, match_num, contest_id] AS o, {ratios} FROM prep")


_PROFILE_SQL = (",\nlng AS (" + _side_sql("w", "winner", 0) + " UNION ALL " + _side_sql("l", "loser", 1) + "),\n"
                "prof AS (SELECT player_id, arg_max(player_name, o) FILTER (WHERE player_name IS NOT NULL) AS player_name, "
                + ", ".join(f'avg("{f}") AS "{f}"' for f in SERVE_FIELDS) + " FROM lng GROUP BY player_id),\n"
                "full_prof AS (SELECT * FROM prof WHERE "
                + " AND ".join(f'"{f}" IS NOT NULL' for f in SERVE_FIELDS) + ")\n")


def _profiles(spark, sf_dir) -> DataFrame:
    # several consumers (statistics subquery, sweep, assignment): the profiles are written once
    return _memo(spark, sf_dir, "profiles", lambda: materialize(P.career_profiles(_prepared(spark, sf_dir)), "profiles"))


@register("career_profile", O.prep_prefix().rstrip() + _PROFILE_SQL
          + "SELECT player_id, player_name, " + ", ".join(f'round("{f}", 9) AS "{f}"' for f in SERVE_FIELDS)
          + " FROM full_prof")
def q_career_profile(spark, sf_dir):
    """AGG4 + FLT4 + SET2/ARR2: career means over both sides, last known name."""
    return for_check(_profiles(spark, sf_dir))


@register("zscores", O.prep_prefix().rstrip() + _PROFILE_SQL + "SELECT player_id, " + ", ".join(
    f'round(CASE WHEN stddev_pop("{f}") OVER () > 0 THEN ("{f}" - avg("{f}") OVER ()) / stddev_pop("{f}") OVER () '
    f'ELSE 0.0 END, 9) AS "{f}_z"' for f in SERVE_FIELDS) + " FROM full_prof")
def q_zscores(spark, sf_dir):
    """ML1: standardised profiles (population std, zero variance -> 0)."""
    z = P.standardize(_profiles(spark, sf_dir), list(SERVE_FIELDS), "_z")
    return for_check(z.select("player_id", *[f"{f}_z" for f in SERVE_FIELDS]))


def _sweep(spark, sf_dir):
    return _memo(spark, sf_dir, "sweep", lambda: P.kmeans_sweep(_profiles(spark, sf_dir), S))


@register("kmeans_sweep")
def q_kmeans_sweep(spark, sf_dir):
    """ML2: inertia per K (best of the seeded restarts)."""
    return P.inertia_table(spark, _sweep(spark, sf_dir))


@register("elbow")
def q_elbow(spark, sf_dir):
    """ML3: chosen K by the distance-from-chord rule on the data's inertia curve."""
    return P.pick_elbow(P.inertia_table(spark, _sweep(spark, sf_dir)))


def _clusters(spark, sf_dir) -> DataFrame:
    def build():
        sweep = _sweep(spark, sf_dir)
        k = P.pick_elbow(P.inertia_table(spark, sweep)).first()["k"]
        chosen = next(x for x in sweep if x.k == k)
        return materialize(P.assign_clusters(_profiles(spark, sf_dir), chosen.centers), "clusters")
    return _memo(spark, sf_dir, "clusters", build)


@register("player_clusters")
def q_player_clusters(spark, sf_dir):
    """ML4: player -> cluster with the chosen K."""
    return _clusters(spark, sf_dir).select("player_id", "player_name", "cluster")


@register("centroids")
def q_centroids(spark, sf_dir):
    """ML5: cluster centres in original units, 3 decimals."""
    return P.centroids(_clusters(spark, sf_dir))


from .matrix_queries import _CLUSTER_SQL, _cluster_map  # noqa: E402


@register("centroids_by_rule", O.prep_prefix().rstrip() + _PROFILE_SQL.rstrip() + _CLUSTER_SQL + "\nSELECT cluster, "
          + ", ".join(f'round(avg("{f}"), 3) AS "{f}"' for f in SERVE_FIELDS)
          + " FROM full_prof JOIN cmap USING (player_id) GROUP BY cluster")
def q_centroids_by_rule(spark, sf_dir):
    """ML5 given labels: centres in original units of a data-derived labelling
    (account-balance bands), so the arithmetic has a SQL twin."""
    assigned = _profiles(spark, sf_dir).join(_cluster_map(spark, sf_dir), "player_id")
    return P.centroids(assigned)


# ------------------------------------------------------------------ models
def _table(spark, sf_dir) -> DataFrame:
    """The modelling table: feature matrix + cluster one-hots + split label,
    written once to the checkpoint folder."""
    def build():
        from concurrent.futures import ThreadPoolExecutor
        fx, prep = FixtureTables(spark, sf_dir), _prepared(spark, sf_dir)
        with ThreadPoolExecutor(max_workers=2) as pool:  # the sweep's many small jobs run beside the matrix's few large ones
            clusters = pool.submit(_clusters, spark, sf_dir)
            m = M.feature_matrix(prep, fx.rankings(), S)
            side = [c for c in m.columns if c.startswith(("player1_", "player2_")) and not c.endswith("_id")]
            m = materialize(m.drop(*side), "feature-matrix")  # models read the differences only
            found = clusters.result().select("player_id", "cluster")
        m = M.join_clusters(m, found, S)
        return materialize(m.withColumn("split", M.split_column(S)), "model_table")
    return _memo(spark, sf_dir, "table", build)


def _features(spark, sf_dir) -> list[str]:
    return M.model_columns(_table(spark, sf_dir), S)


def _splits(spark, sf_dir):
    t = _table(spark, sf_dir)
    cols = _features(spark, sf_dir)
    cast = t.select(*[c for c in t.columns if c not in cols], *[F.col(c).cast("double").alias(c) for c in cols])
    return [cast.where(F.col("split") == x) for x in ("train", "val", "test")]


_FITTERS = {"logistic_regression": ML.fit_logistic, "random_forest": ML.fit_forest, "boosted_trees": ML.fit_boosted}
OUT = {"logistic_regression": "lr_prob", "random_forest": "rf_prob", "boosted_trees": "xgb_prob"}


def fitted(spark, sf_dir, name: str) -> ML.Fitted:
    def build():
        tr, va, _ = _splits(spark, sf_dir)
        return _FITTERS[name](tr, va, _features(spark, sf_dir), S, ML.Grids.reference())
    return _memo(spark, sf_dir, f"fit:{name}", build)


def _fit_all(spark, sf_dir, names) -> list[ML.Fitted]:
    """Fit independent model families concurrently (one driver thread each;
    the modelling table is built first, once)."""
    from concurrent.futures import ThreadPoolExecutor
    _table(spark, sf_dir)
    with ThreadPoolExecutor(max_workers=len(names)) as pool:
        return list(pool.map(lambda n: fitted(spark, sf_dir, n), names))


def _scored(spark, sf_dir, names) -> DataFrame:
    test = _splits(spark, sf_dir)[2]
    return ML.score(test, _fit_all(spark, sf_dir, names), {n: OUT[n] for n in names})


@register("logistic")
def q_logistic(spark, sf_dir):
    """ML6 + ML9 + NUL6: chosen logistic regression scored on the test split."""
    return _scored(spark, sf_dir, ["logistic_regression"])


@register("forest")
def q_forest(spark, sf_dir):
    """ML7 + ML9: chosen random forest scored on the test split."""
    return _scored(spark, sf_dir, ["random_forest"])


@register("boosted")
def q_boosted(spark, sf_dir):
    """ML8 + ML9: chosen boosted trees (early stopped) scored on the test split."""
    return _scored(spark, sf_dir, ["boosted_trees"])


@register("test_predictions")
def q_test_predictions(spark, sf_dir):
    """ML10 + PRJ8: all three models applied to the same test rows."""
    return _scored(spark, sf_dir, list(OUT))


@register("importances")
def q_importances(spark, sf_dir):
    """ML11 + SRT3: top 20 features of the boosted model."""
    return ML.importances(spark, fitted(spark, sf_dir, "boosted_trees"))


@register("model_description")
def q_model_description(spark, sf_dir):
    """SNK3 content: features, validation metrics, chosen parameters, split sizes."""
    import json
    tr, va, te = _splits(spark, sf_dir)
    rows = []
    for f in _fit_all(spark, sf_dir, list(OUT)):
        n = f.name
        rows.append((n, json.dumps(f.params, sort_keys=True), f.val_metrics["log_loss"], f.val_metrics["accuracy"]))
    desc = spark.createDataFrame(rows, "model string, params string, val_log_loss double, val_accuracy double")
    sizes = (tr.select(F.lit("train").alias("split")).unionByName(va.select(F.lit("val").alias("split")))
             .unionByName(te.select(F.lit("test").alias("split"))).groupBy("split").count())
    sizes = sizes.agg(F.map_from_entries(F.collect_list(F.struct("split", "count"))).alias("split_rows"))
    return attach_row(desc.withColumn("n_features", F.lit(len(_features(spark, sf_dir)))), sizes)


# ------------------------------------------------------------ exact medians
_MED_COLS = [*NUMERIC_FEATURES, *[f"surface_{v}" for v in S.surfaces], *[f"tourney_level_{v}" for v in S.predicted_levels]]


@register("train_medians", _matrix_prefix(_MF_SQL, _SW_SQL, _ENC_SQL) + "SELECT " + ", ".join(
    f"round(median(CAST({c} AS double)), 9) AS {c}" for c in _MED_COLS) + " FROM enc WHERE tourney_date <= 19991231")
def q_train_medians(spark, sf_dir):
    """AGG5: exact interpolated median of every model column over the training split."""
    m = M.feature_matrix(prepared(spark, sf_dir, True), FixtureTables(spark, sf_dir).rankings(), S)
    train = m.where(M.split_column(S) == "train")
    return for_check(exact_medians(train, _MED_COLS))


# ---------------------------------------------------------------- inspect
_DESC_COLS = ("tourney_date", "surface", "tourney_level", "round", "target", "elo_diff", "lr_prob", "rf_prob",
              "xgb_prob")
_NUM = ("tourney_date", "target", "elo_diff", "lr_prob", "rf_prob", "xgb_prob")


def _sig(x: str) -> str:
    return f"CAST(printf('%.9e', CAST({x} AS double)) AS double)"


def _desc_sql() -> str:
    parts = []
    for c in _DESC_COLS:
        if c in _NUM:
            parts.append(
                f"SELECT '{c}' AS \"column\", count({c}) AS count, NULL::bigint AS \"unique\", NULL::varchar AS top, "
                f"NULL::bigint AS freq, {_sig(f'avg({c})')} AS mean, {_sig(f'stddev_samp({c})')} AS std, "
                f"{_sig(f'min({c})')} AS min, {_sig(f'quantile_cont({c}, 0.25)')} AS \"25%\", "
                f"{_sig(f'quantile_cont({c}, 0.5)')} AS \"50%\", {_sig(f'quantile_cont({c}, 0.75)')} AS \"75%\", "
                f"{_sig(f'max({c})')} AS max FROM predictions")
        else:
            top = (f"(SELECT {c} FROM predictions WHERE {c} IS NOT NULL GROUP BY {c} "
                   f"ORDER BY count(*) DESC, {c} LIMIT 1)")
            freq = (f"(SELECT count(*) FROM predictions WHERE {c} IS NOT NULL GROUP BY {c} "
                    f"ORDER BY count(*) DESC, {c} LIMIT 1)")
            parts.append(
                f"SELECT '{c}', count({c}), count(DISTINCT {c}), {top}, {freq}, NULL::double, NULL::double, "
                f"NULL::double, NULL::double, NULL::double, NULL::double, NULL::double FROM predictions")
    return O.predictions_prefix() + "\nUNION ALL\n".join(parts)


def _sig_spark(df: DataFrame) -> DataFrame:
    dbl = [f.name for f in df.schema.fields if f.dataType.typeName() == "double"]
    return df.withColumns({c: F.when(F.col(c).isNotNull(), F.format_string("%.9e", F.col(c)).try_cast("double"))
                           for c in dbl})


@register("describe", _desc_sql())
def q_describe(spark, sf_dir):
    """AGG19: per-column summary (exact quartiles; 10 significant digits)."""
    p = FixtureTables(spark, sf_dir).predictions(S.seed).select(*_DESC_COLS)
    return _sig_spark(I.describe(p))


@register("shape", O.with_views(O.CONTESTS_CTE, O.CLEANED_CTE)
          + "SELECT count(*) AS rows, " + str(len(O.CONTEST_COLUMNS)) + " AS columns, '"
          + ",".join(O.CONTEST_COLUMNS) + "' AS column_names FROM cleaned")
def q_shape(spark, sf_dir):
    """AGG20: rows, column count and names."""
    from ..operators import clean
    return I.shape(clean.clean_contests(FixtureTables(spark, sf_dir).contests(), S))


@register("sorted_contests", O.with_views(O.CONTESTS_CTE, O.CLEANED_CTE)
          + "SELECT contest_id, tourney_date, match_num, winner_id, loser_id FROM cleaned "
          "ORDER BY tourney_date, match_num, contest_id")
def q_sorted_contests(spark, sf_dir):
    """SRT1: global time order (range-partitioned sort)."""
    from ..operators import clean
    c = clean.clean_contests(FixtureTables(spark, sf_dir).contests(), S)
    return I.sort_by_time(c).select("contest_id", "tourney_date", "match_num", "winner_id", "loser_id")


@register("head", O.with_views(O.CONTESTS_CTE, O.CLEANED_CTE)
          + "SELECT tourney_date, surface, winner_id, loser_id FROM cleaned "
          "ORDER BY tourney_date, match_num, contest_id LIMIT 10")
def q_head(spark, sf_dir):
    """SRT4 + PRJ7: first 10 rows of a column subset (unknown names ignored)."""
    from ..operators import clean
    c = clean.clean_contests(FixtureTables(spark, sf_dir).contests(), S)
    return I.head(c, 10, ["tourney_date", "surface", "winner_id", "loser_id", "no_such_column"],
                  order=["tourney_date", "match_num", "contest_id"])
