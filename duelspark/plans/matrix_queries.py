"""Checked queries for the feature matrix (PRJ11, FLT5-6, CND1-2, NUL4-5,
JOIN2, JOIN4, PVT1-2, AGG18) and the flagship ``feature_matrix``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import matrix as M
from ..settings import ROUND_ORDINAL, SERVE_FIELDS
from ..sources.fixtures import FixtureTables
from . import oracle_sql as O
from .history_queries import ELO_SQL
from .ingest_queries import S, prepared
from .registry import for_check, register

_T = "ORDER BY tourney_date, match_num, contest_id"
_G = f"OVER (PARTITION BY player_id {_T} ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)"

_HIST_SQL = f""",
rankings AS (SELECT * FROM ({O.RANKINGS_CTE.strip()[len('rankings AS '):]})),
hist AS (
  SELECT contest_id, side, player_id, tourney_date,
         avg(won) {_G} AS global_form,
         avg(won) OVER (PARTITION BY player_id, surface {_T} ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS surface_form,
         coalesce(sum(wt) OVER (PARTITION BY player_id ORDER BY day RANGE BETWEEN 14 PRECEDING AND 1 PRECEDING), 0)
           + coalesce(sum(wt) OVER (PARTITION BY player_id, day ORDER BY match_num, contest_id
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS fatigue,
         {', '.join(f'avg("{f}") {_G} AS avg_{f}' for f in SERVE_FIELDS)}
  FROM app),
peak AS (
  SELECT q.player_id, q.tourney_date, min(r.rank) AS peak_rank
  FROM (SELECT DISTINCT player_id, tourney_date FROM app) q
  LEFT JOIN rankings r ON r.player_id = q.player_id AND r.ranking_date <= q.tourney_date
  GROUP BY q.player_id, q.tourney_date),
hw AS (SELECT hist.*, peak.peak_rank FROM hist LEFT JOIN peak USING (player_id, tourney_date))"""

_STATE = ("global_form", "surface_form", "fatigue", *[f"avg_{f}" for f in SERVE_FIELDS], "peak_rank")
_CTX = ", ".join([
    "p.contest_id", "p.tourney_date", "p.match_num", "p.tourney_level", "p.surface", "p.round", "p.best_of",
    "p.match_source", "p.winner_id AS w_id", "p.loser_id AS l_id", "p.winner_name AS w_name",
    "p.loser_name AS l_name", "p.winner_rank AS w_rank", "p.loser_rank AS l_rank",
    "p.winner_rank_points AS w_rank_points", "p.loser_rank_points AS l_rank_points",
    "p.winner_age AS w_age", "p.loser_age AS l_age", "p.winner_ht AS w_ht", "p.loser_ht AS l_ht",
    "coalesce(nullif(p.winner_hand, ''), 'U') AS w_hand", "coalesce(nullif(p.loser_hand, ''), 'U') AS l_hand",
    "z.we AS w_elo", "z.le AS l_elo",
    *[f"w.{c} AS w_{c}, l.{c} AS l_{c}" for c in _STATE],
])
_MF_SQL = f""",
mf AS (
  SELECT {_CTX}
  FROM pooled p JOIN z ON z.contest_id = p.contest_id
  JOIN hw w ON w.contest_id = p.contest_id AND w.side = 'w'
  JOIN hw l ON l.contest_id = p.contest_id AND l.side = 'l'
  WHERE p.match_source = 'main' AND p.tourney_level IN ('1', '2', '3'))"""

_PAIR_SQL = ",\n         ".join(
    f"CASE WHEN heads THEN w_{p} ELSE l_{p} END AS player1_{p}, CASE WHEN heads THEN l_{p} ELSE w_{p} END AS player2_{p}"
    for p in M.PAIRS)
_SW_SQL = f""",
sw AS (
  SELECT contest_id, tourney_date, match_num, tourney_level, surface, round, best_of,
         {_PAIR_SQL},
         CASE WHEN heads THEN 1 ELSE 0 END AS target
  FROM (SELECT *, substr(md5(concat('42:', CAST(contest_id AS varchar))), 1, 1) < '8' AS heads FROM mf)),
sd AS (
  SELECT *, {', '.join(f'CAST(player1_{p} AS double) - CAST(player2_{p} AS double) AS {d}' for d, p in M.DIFFS)}
  FROM sw)"""

_HAND = ("CASE WHEN upper(substr(coalesce({c}, 'R'), 1, 1)) = 'U' THEN 'R' "
         "ELSE upper(substr(coalesce({c}, 'R'), 1, 1)) END")
_ENC_COLS = ", ".join([
    "CASE round " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in ROUND_ORDINAL.items()) + " ELSE 0 END AS round_ordinal",
    "CASE " + _HAND.format(c="player1_hand") + " || " + _HAND.format(c="player2_hand")
    + " WHEN 'RR' THEN 0 WHEN 'RL' THEN 1 WHEN 'LR' THEN 2 WHEN 'LL' THEN 3 ELSE 0 END AS handedness",
    *[f"CAST(surface = '{v}' AS int) AS surface_{v}" for v in S.surfaces],
    *[f"coalesce(CAST(tourney_level = '{v}' AS int), 0) AS tourney_level_{v}" for v in S.predicted_levels],
])
_ENC_SQL = f""",
enc AS (SELECT * REPLACE (coalesce(TRY_CAST(best_of AS int), 3) AS best_of), {_ENC_COLS} FROM sd)"""

_DOUBLE_STATE = ("elo", "global_form", "surface_form", "fatigue", "age", "ht", *[f"avg_{f}" for f in SERVE_FIELDS])


def _prefix(*parts: str) -> str:
    base = O.with_views(O.CONTESTS_CTE, O.CLEANED_CTE, O.RATIOS_CTE, O.PREP_CTE, O.POOLED_CTE, O.APP_CTE)
    return base.replace("WITH ", "WITH RECURSIVE ", 1).rstrip() + ELO_SQL.rstrip() + _HIST_SQL + "".join(parts) + "\n"


def _round_all(names) -> str:
    return ", ".join(f"round({n}, 9) AS {n}" for n in names)


def _features(spark, sf_dir):
    return M.pre_match(prepared(spark, sf_dir, True), FixtureTables(spark, sf_dir).rankings(), S, main_only=True)


_MF_DOUBLES = [f"{t}_{c}" for c in _DOUBLE_STATE for t in ("w", "l")]


@register("main_features", _prefix(_MF_SQL) + f"SELECT * REPLACE ({_round_all(_MF_DOUBLES)}) FROM mf")
def q_main_features(spark, sf_dir):
    """PRJ11 + FLT5: pre-match state of both players, main draw only (filter above the windows)."""
    return for_check(M.main_draw(_features(spark, sf_dir), S))


_SD_DOUBLES = [f"player{i}_{c}" for c in _DOUBLE_STATE for i in (1, 2)] + [d for d, _ in M.DIFFS]


@register("swap_diff", _prefix(_MF_SQL, _SW_SQL) + f"SELECT * REPLACE ({_round_all(_SD_DOUBLES)}) FROM sd")
def q_swap_diff(spark, sf_dir):
    """CND1-2: keyed coin, player1/player2 layout, target, differences."""
    return for_check(M.swap_sides(M.main_draw(_features(spark, sf_dir), S), S))


_ENC_OUT = ["contest_id", "round_ordinal", "handedness", "best_of",
            *[f"surface_{v}" for v in S.surfaces], *[f"tourney_level_{v}" for v in S.predicted_levels]]


@register("encode", _prefix(_MF_SQL, _SW_SQL, _ENC_SQL) + f"SELECT {', '.join(_ENC_OUT)} FROM enc")
def q_encode(spark, sf_dir):
    """JOIN4 (literal lookups), NUL4-5, PVT1 (fixed one-hot)."""
    return M.encode(M.swap_sides(M.main_draw(_features(spark, sf_dir), S), S), S).select(*_ENC_OUT)


@register("feature_matrix", _prefix(_MF_SQL, _SW_SQL, _ENC_SQL) + f"SELECT * REPLACE ({_round_all(_SD_DOUBLES)}) FROM enc")
def q_feature_matrix(spark, sf_dir):
    """Flagship: the whole stage-3 matrix (history, rating, as-of, swap, encodings)."""
    return for_check(M.feature_matrix(prepared(spark, sf_dir, True), FixtureTables(spark, sf_dir).rankings(), S))


# A literal cluster map derived from the supplier table (the K-Means map is a
# fitted model with no SQL twin): account-balance bands 0, 1, 2; suppliers
# with a negative balance get no cluster, which exercises the -1 fallback.
_CLUSTER_SQL = (",\ncmap AS (SELECT s_suppkey AS player_id, CASE WHEN s_acctbal < 3000 THEN 0 "
                "WHEN s_acctbal < 6000 THEN 1 ELSE 2 END AS cluster FROM supplier WHERE s_acctbal >= 0)")


def _cluster_map(spark, sf_dir):
    sup = FixtureTables(spark, sf_dir).table("supplier")
    band = F.when(F.col("s_acctbal") < 3000, 0).when(F.col("s_acctbal") < 6000, 1).otherwise(2)
    return sup.where(F.col("s_acctbal") >= 0).select(F.col("s_suppkey").alias("player_id"), band.alias("cluster"))


_CJ_SQL = _CLUSTER_SQL + """,
cj AS (
  SELECT sd.contest_id, coalesce(c1.cluster, -1) AS player1_cluster, coalesce(c2.cluster, -1) AS player2_cluster
  FROM sd LEFT JOIN cmap c1 ON c1.player_id = sd.player1_id LEFT JOIN cmap c2 ON c2.player_id = sd.player2_id)"""
_CJ_HOT = ", ".join(f'CAST(player{i}_cluster = {v} AS int) AS "player{i}_cluster_{v}"'
                    for i in (1, 2) for v in (-1, 0, 1, 2))


@register("cluster_join", _prefix(_MF_SQL, _SW_SQL, _CJ_SQL)
          + f'SELECT contest_id, player1_cluster, player2_cluster, {_CJ_HOT} FROM cj')
def q_cluster_join(spark, sf_dir):
    """JOIN2 (left join of the cluster map, twice) + PVT2 (one-hot of observed values)."""
    m = M.swap_sides(M.main_draw(_features(spark, sf_dir), S), S)
    out = M.join_clusters(m, _cluster_map(spark, sf_dir), S, values=[-1, 0, 1, 2])  # the rule's domain
    hot = [c for c in out.columns if c.startswith(("player1_cluster", "player2_cluster"))]
    return out.select("contest_id", *hot)


@register("split_counts", _prefix(_MF_SQL, _SW_SQL) + """
SELECT CASE WHEN tourney_date <= 19991231 THEN 'train' WHEN tourney_date BETWEEN 20000101 AND 20001231 THEN 'val'
            WHEN tourney_date BETWEEN 20010101 AND 99991231 THEN 'test' END AS split,
       count(*) AS n, round(avg(target), 9) AS class_balance, min(tourney_date) AS first_date,
       max(tourney_date) AS last_date
FROM sd GROUP BY 1""")
def q_split_counts(spark, sf_dir):
    """FLT6 (temporal split by inclusive date ranges) + AGG18 (class balance)."""
    m = M.swap_sides(M.main_draw(_features(spark, sf_dir), S), S)
    return for_check(m.groupBy(M.split_column(S).alias("split")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("target").alias("class_balance"),
        F.min("tourney_date").alias("first_date"), F.max("tourney_date").alias("last_date")))
