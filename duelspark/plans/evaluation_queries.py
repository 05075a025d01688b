"""Checked queries for the evaluation tables over the ``predictions`` fixture
(AGG6-AGG18, FLT7-8, CND3-5, BIN1-2, SRT5-6, ML12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluate as E
from ..operators.matrix import split_column
from ..settings import CALIBRATION_EDGES
from ..sources.fixtures import FixtureTables
from . import oracle_sql as O
from .ingest_queries import S
from .registry import for_check, register

MODELS = {"logistic_regression": "lr_prob", "random_forest": "rf_prob", "boosted_trees": "xgb_prob"}
PROB = "xgb_prob"
EPS = "1e-6"


def _pred(spark, sf_dir):
    """The scored table, written once (stage 5's output is stage 6's input), so
    the many branches of an evaluation plan scan it instead of rebuilding it."""
    from ..session import materialize
    return materialize(FixtureTables(spark, sf_dir).predictions(S.seed), "predictions")


def _pre(*ctes: str) -> str:
    return O.with_views(O.CONTESTS_CTE, O.PREDICTIONS_CTE, *ctes)


def _metric_sql(base: str, keys: str) -> str:
    """n, accuracy, log_loss, auc_roc per key over CTE ``base(keys, y, p)``."""
    return f"""
agg AS (
  SELECT {keys}, count(*) AS n, avg(CAST(CAST(p >= 0.5 AS int) = y AS double)) AS accuracy,
         avg(-(y * ln(p) + (1 - y) * ln(1 - p))) AS ll, min(y) < max(y) AS two
  FROM {base} GROUP BY {keys}),
pts AS (SELECT {keys}, p, sum(y) AS pos, count(*) - sum(y) AS neg FROM {base} GROUP BY {keys}, p),
cum AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY {keys} ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb
        FROM pts),
auc AS (SELECT {keys}, CAST(sum(pos * (2 * nb + neg)) AS double) / (2.0 * sum(pos) * sum(neg)) AS auc_roc
        FROM cum GROUP BY {keys})
SELECT {', '.join('agg.' + k.strip() for k in keys.split(','))}, n, round(accuracy, 9) AS accuracy,
       round(CASE WHEN two THEN ll END, 9) AS log_loss, round(CASE WHEN two THEN auc_roc END, 9) AS auc_roc
FROM agg JOIN auc USING ({keys})"""


_SLICE_BASE = f"""
base AS (
  SELECT by_col, slice, target AS y, least(greatest({PROB}, {EPS}), 1 - {EPS}) AS p FROM (
    SELECT 'surface' AS by_col, 'surface=' || surface AS slice, target, {PROB} FROM predictions WHERE surface IS NOT NULL
    UNION ALL SELECT 'surface', 'overall', target, {PROB} FROM predictions
    UNION ALL SELECT 'tourney_level', 'tourney_level=' || tourney_level, target, {PROB} FROM predictions
      WHERE tourney_level IS NOT NULL
    UNION ALL SELECT 'tourney_level', 'overall', target, {PROB} FROM predictions)),"""


@register("slice_metrics", _pre() + "," + _SLICE_BASE + _metric_sql("base", "by_col, slice"))
def q_slice_metrics(spark, sf_dir):
    """AGG6-AGG10: metric rows per surface and per level, each with an overall row."""
    return for_check(E.slice_tables(_pred(spark, sf_dir), ["surface", "tourney_level"], PROB))


_SPLIT = ("CASE WHEN tourney_date <= 19991231 THEN 'train' WHEN tourney_date BETWEEN 20000101 AND 20001231 "
          "THEN 'val' WHEN tourney_date BETWEEN 20010101 AND 99991231 THEN 'test' END")
_MODEL_BASE = ",\nbase AS (" + " UNION ALL ".join(
    f"SELECT '{m}' AS model, {_SPLIT} AS split, target AS y, least(greatest({c}, {EPS}), 1 - {EPS}) AS p FROM predictions"
    for m, c in MODELS.items()) + "),"


@register("model_metrics", _pre() + _MODEL_BASE + _metric_sql("base", "model, split"))
def q_model_metrics(spark, sf_dir):
    """ML12: every model on every split, one pass over the unpivoted scores."""
    p = _pred(spark, sf_dir).withColumn("split", split_column(S))
    return for_check(E.model_metrics(p, MODELS, ["split"]))


_CAL_BIN = " + ".join(f"CAST({PROB} > CAST('{e!r}' AS double) AS int)" for e in CALIBRATION_EDGES)


@register("calibration", _pre() + f"""
SELECT {_CAL_BIN} AS bin, round(avg(CAST(target AS double)), 9) AS frac_pos, round(avg({PROB}), 9) AS mean_pred,
       count(*) AS n
FROM predictions GROUP BY 1""")
def q_calibration(spark, sf_dir):
    """AGG11: reliability table, 10 right-closed bins, empty bins absent."""
    return for_check(E.calibration(_pred(spark, sf_dir), PROB))


@register("confusion", _pre() + f"""
SELECT target AS actual, count(*) FILTER (WHERE {PROB} < 0.5) AS pred_0, count(*) FILTER (WHERE {PROB} >= 0.5) AS pred_1
FROM predictions GROUP BY target""")
def q_confusion(spark, sf_dir):
    """AGG12 + CND3: 2x2 counts at threshold 0.5."""
    return E.confusion(_pred(spark, sf_dir), PROB)


@register("accuracy_by_level", _pre() + f"""
SELECT tourney_level, round(avg(CAST(CAST({PROB} >= 0.5 AS int) = target AS double)), 9) AS accuracy, count(*) AS n
FROM predictions GROUP BY tourney_level ORDER BY tourney_level""")
def q_accuracy_by_level(spark, sf_dir):
    """AGG13 + SRT5: accuracy and n per level, ordered by level."""
    return for_check(E.accuracy_by(_pred(spark, sf_dir), "tourney_level", PROB).orderBy("tourney_level"))


@register("accuracy_by_year", _pre() + """,
base AS (SELECT CAST(floor(tourney_date / 10000) AS int) AS year, target AS y, xgb_prob AS p FROM predictions),""" + """
agg0 AS (SELECT year, count(*) AS n, avg(CAST(CAST(p >= 0.5 AS int) = y AS double)) AS accuracy FROM base GROUP BY year),
pts AS (SELECT year, p, sum(y) AS pos, count(*) - sum(y) AS neg FROM base GROUP BY year, p),
cum AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY year ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb
        FROM pts),
auc AS (SELECT year, CASE WHEN sum(pos) > 0 AND sum(neg) > 0
               THEN CAST(sum(pos * (2 * nb + neg)) AS double) / (2.0 * sum(pos) * sum(neg)) END AS auc_roc
        FROM cum GROUP BY year)
SELECT year, round(accuracy, 9) AS accuracy, n, round(auc_roc, 9) AS auc_roc
FROM agg0 JOIN auc USING (year) WHERE n >= 10""")
def q_accuracy_by_year(spark, sf_dir):
    """AGG14 + SCA7 + FLT8: per year, groups under 10 rows dropped, one-class guard."""
    return for_check(E.accuracy_by_year(_pred(spark, sf_dir), PROB))


_EB_EDGES = " + ".join(f"CAST(elo_diff > lo + st * {i} AS int)" for i in range(1, 10))


@register("elo_bins", _pre() + f""",
r AS (SELECT min(elo_diff) AS lo, max(elo_diff) AS hi FROM predictions WHERE elo_diff IS NOT NULL),
b AS (SELECT p.*, r.lo, r.hi, (r.hi - r.lo) / 10 AS st FROM predictions p, r WHERE p.elo_diff IS NOT NULL),
g AS (SELECT {_EB_EDGES} AS bin, avg(CAST(target AS double)) AS actual_win_rate, avg({PROB}) AS mean_predicted,
             count(*) AS n, any_value(lo) AS lo, any_value(hi) AS hi, any_value(st) AS st
      FROM b GROUP BY 1)
SELECT bin, round(actual_win_rate, 9) AS actual_win_rate, round(mean_predicted, 9) AS mean_predicted, n,
       round(((CASE WHEN bin = 0 THEN lo - (hi - lo) * 0.001 ELSE lo + st * bin END) + (lo + st * (bin + 1))) / 2, 9)
         AS bin_mid
FROM g WHERE n >= 20""")
def q_elo_bins(spark, sf_dir):
    """AGG15 + BIN1: win rate by rating-difference bin (data range, right-closed)."""
    return for_check(E.binned_win_rate(_pred(spark, sf_dir), "elo_diff", PROB))


_UPS = f"""
u AS (SELECT contest_id, tourney_date, surface, target, {PROB},
             CASE WHEN target = 1 THEN 1 - {PROB} ELSE {PROB} END AS loser_prob
      FROM predictions WHERE (target = 1 AND {PROB} < 0.5) OR (target = 0 AND {PROB} > 0.5))"""


@register("upset_histogram", _pre(_UPS) + """,
r AS (SELECT CASE WHEN max(loser_prob) = min(loser_prob) THEN min(loser_prob) - 0.5 ELSE min(loser_prob) END AS lo,
             CASE WHEN max(loser_prob) = min(loser_prob) THEN max(loser_prob) + 0.5 ELSE max(loser_prob) END AS hi FROM u),
x AS (SELECT loser_prob AS v, lo, hi, (hi - lo) / 30 AS st,
             least(floor((loser_prob - lo) * (30.0 / (hi - lo))), 29) AS i0 FROM u, r),
y AS (SELECT *, i0 * st + lo AS e_lo, CASE WHEN i0 + 1 = 30 THEN hi ELSE (i0 + 1) * st + lo END AS e_hi FROM x)
SELECT CAST(i0 - CAST(v < e_lo AS int) + CAST(v >= e_hi AND i0 <> 29 AS int) AS int) AS bin, count(*) AS n
FROM y GROUP BY 1""")
def q_upset_histogram(spark, sf_dir):
    """AGG16 + FLT7 + CND5 + BIN2: histogram of the loser's probability over upsets."""
    return E.upset_histogram(_pred(spark, sf_dir), PROB)


@register("top_upsets", _pre(_UPS) + """
SELECT contest_id, tourney_date, surface, target, round(xgb_prob, 9) AS xgb_prob, round(loser_prob, 9) AS loser_prob
FROM u ORDER BY loser_prob DESC, contest_id LIMIT 20""")
def q_top_upsets(spark, sf_dir):
    """SRT6: the 20 most surprising results (a top-k report)."""
    t = E.top_upsets(_pred(spark, sf_dir), PROB, 20)
    return for_check(t.select("contest_id", "tourney_date", "surface", "target", PROB, "loser_prob"))


_LONG = ",\nlng AS (" + " UNION ALL ".join(
    f"SELECT '{m}' AS model, target AS y, {c} AS p FROM predictions" for m, c in MODELS.items()) + ")"


@register("roc_points", _pre() + _LONG + """,
pts AS (SELECT model, p, sum(y) AS pos, count(*) - sum(y) AS neg FROM lng GROUP BY model, p),
cum AS (SELECT *, sum(pos) OVER w AS tps, sum(neg) OVER w AS fps,
               lead(pos) OVER w2 AS npos, lead(neg) OVER w2 AS nneg, row_number() OVER w2 AS rk,
               sum(pos) OVER (PARTITION BY model) AS tp, sum(neg) OVER (PARTITION BY model) AS tn
        FROM pts
        WINDOW w AS (PARTITION BY model ORDER BY p DESC ROWS UNBOUNDED PRECEDING),
               w2 AS (PARTITION BY model ORDER BY p DESC))
SELECT model, round(fps / tn, 9) AS fpr, round(tps / tp, 9) AS tpr, round(p, 9) AS threshold
FROM cum WHERE rk = 1 OR npos IS NULL OR npos <> pos OR nneg <> neg
UNION ALL
SELECT DISTINCT model, 0.0::double, 0.0::double, 'inf'::double FROM lng""")
def q_roc_points(spark, sf_dir):
    """AGG17: ROC points of the three score columns (collinear points dropped)."""
    return for_check(E.roc_points(_pred(spark, sf_dir), MODELS))
