"""Checked queries for the pre-match history (WIN1-WIN7, JOIN3, ARR2)."""

from __future__ import annotations

from ..operators import asof, history, rating
from ..settings import SERVE_FIELDS
from ..sources.fixtures import FixtureTables
from . import oracle_sql as O
from .ingest_queries import S, prepared
from .registry import for_check, register

_T = "ORDER BY tourney_date, match_num, contest_id"


def _features(spark, sf_dir, *wanted):
    """The wanted history features over the cleaned table written once (rows and block tables both
    read it, instead of rebuilding the contests)."""
    rk = FixtureTables(spark, sf_dir).rankings() if "peak_rank" in wanted else None
    return history.history_features(prepared(spark, sf_dir, True), rk, S, wanted=list(wanted))


@register("appearances", O.app_prefix() + "SELECT contest_id, side, player_id, surface, won, wt, day FROM app")
def q_appearances(spark, sf_dir):
    """ARR2: winner/loser row -> two appearance rows."""
    app = history.appearances(history.with_pool(prepared(spark, sf_dir), S), S)
    return app.select("contest_id", "side", "player_id", "surface", "won", "wt", "day")


@register("form_global", O.app_prefix() + f"""
SELECT contest_id, side, player_id,
       round(avg(won) OVER (PARTITION BY player_id {_T} ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING), 9) AS global_form
FROM app""")
def q_form_global(spark, sf_dir):
    """WIN1: mean of the last 20 results, current contest excluded."""
    return for_check(_features(spark, sf_dir, "global_form").drop("surface"))


@register("form_surface", O.app_prefix() + f"""
SELECT contest_id, side, player_id, surface,
       round(avg(won) OVER (PARTITION BY player_id, surface {_T} ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING), 9)
         AS surface_form
FROM app""")
def q_form_surface(spark, sf_dir):
    """WIN2: the same over the last 10 contests on this surface (after NUL3)."""
    return for_check(_features(spark, sf_dir, "surface_form"))


# Oracle: band self-join, the literal definition (earlier contests dated on or
# after date - 14 days, same-day earlier ones included).
@register("fatigue", O.app_prefix() + """
SELECT a.contest_id, a.side, a.player_id, coalesce(sum(b.wt), 0.0) AS fatigue
FROM app a LEFT JOIN app b
  ON b.player_id = a.player_id AND b.day >= a.day - 14
 AND (b.tourney_date < a.tourney_date
      OR (b.tourney_date = a.tourney_date AND (b.match_num < a.match_num
          OR (b.match_num = a.match_num AND b.contest_id < a.contest_id))))
GROUP BY a.contest_id, a.side, a.player_id""")
def q_fatigue(spark, sf_dir):
    """WIN3 + SCA6: weighted count of earlier contests in the last 14 days."""
    return for_check(_features(spark, sf_dir, "fatigue").drop("surface"))


@register("serve_form", O.app_prefix() + "SELECT contest_id, side, player_id, " + ", ".join(
    f'round(avg("{f}") OVER (PARTITION BY player_id {_T} ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING), 9) AS avg_{f}'
    for f in SERVE_FIELDS) + " FROM app")
def q_serve_form(spark, sf_dir):
    """WIN4: per ratio, mean of the non-null values among the last 20 contests."""
    return for_check(_features(spark, sf_dir, *[f"avg_{f}" for f in SERVE_FIELDS]).drop("surface"))


_HIST_COLS = ("global_form", "surface_form", "fatigue", *[f"avg_{f}" for f in SERVE_FIELDS], "peak_rank")


@register("history_chunked", O.app_prefix(O.RANKINGS_CTE) + f"""
SELECT a.contest_id, a.side, a.player_id,
       round(avg(won) OVER (PARTITION BY a.player_id {_T.replace('ORDER BY ', 'ORDER BY a.')} ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING), 9) AS global_form,
       round(avg(won) OVER (PARTITION BY a.player_id, a.surface {_T.replace('ORDER BY ', 'ORDER BY a.')} ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING), 9)
         AS surface_form,
       coalesce(sum(wt) OVER (PARTITION BY a.player_id ORDER BY day RANGE BETWEEN 14 PRECEDING AND 1 PRECEDING), 0)
         + coalesce(sum(wt) OVER (PARTITION BY a.player_id, day ORDER BY a.match_num, a.contest_id
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS fatigue,
       """ + ", ".join(
    f'round(avg("{f}") OVER (PARTITION BY a.player_id ORDER BY a.tourney_date, a.match_num, a.contest_id '
    f'ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING), 9) AS avg_{f}' for f in SERVE_FIELDS) + """,
       pk.peak_rank
FROM app a LEFT JOIN (
  SELECT q.player_id, q.tourney_date, min(r.rank) AS peak_rank
  FROM (SELECT DISTINCT player_id, tourney_date FROM app) q
  LEFT JOIN rankings r ON r.player_id = q.player_id AND r.ranking_date <= q.tourney_date
  GROUP BY q.player_id, q.tourney_date) pk ON pk.player_id = a.player_id AND pk.tourney_date = a.tourney_date""")
def q_history_chunked(spark, sf_dir):
    """The skew-safe history plan forced on, with 64-row chunks so that every
    player's sequence spans many chunks and halos (WIN1-WIN5, JOIN3 fused)."""
    rk = FixtureTables(spark, sf_dir).rankings()
    h = history.history_features(prepared(spark, sf_dir), rk, S.with_(history_chunk_rows=64))
    return for_check(h.select("contest_id", "side", "player_id", *_HIST_COLS))


@register("running_best", O.with_views(O.RANKINGS_CTE) + """
SELECT player_id, ranking_date, rank,
       min(rank) OVER (PARTITION BY player_id ORDER BY ranking_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
         AS peak_rank
FROM (SELECT player_id, ranking_date, min(rank) AS rank FROM rankings GROUP BY player_id, ranking_date)""")
def q_running_best(spark, sf_dir):
    """WIN5: running best rank per player."""
    return asof.running_best(FixtureTables(spark, sf_dir).rankings())


# Oracle: inequality join + min, the definition of a backward inclusive as-of.
@register("peak_rank_asof", O.app_prefix(O.RANKINGS_CTE) + """
SELECT q.player_id, q.tourney_date, min(r.rank) AS peak_rank
FROM (SELECT DISTINCT player_id, tourney_date FROM app) q
LEFT JOIN rankings r ON r.player_id = q.player_id AND r.ranking_date <= q.tourney_date
GROUP BY q.player_id, q.tourney_date""")
def q_peak_rank_asof(spark, sf_dir):
    """JOIN3: best rank at or before the contest date; no history -> NULL."""
    app = history.appearances(history.with_pool(prepared(spark, sf_dir), S), S)
    return asof.peak_rank_asof(app, FixtureTables(spark, sf_dir).rankings(), "tourney_date")


@register("peak_rank_history", O.app_prefix(O.RANKINGS_CTE) + """
SELECT a.contest_id, a.side, a.player_id, min(r.rank) AS peak_rank
FROM app a LEFT JOIN rankings r ON r.player_id = a.player_id AND r.ranking_date <= a.tourney_date
GROUP BY a.contest_id, a.side, a.player_id""")
def q_peak_rank_history(spark, sf_dir):
    """JOIN3 fused into the history block table (no extra shuffle)."""
    return _features(spark, sf_dir, "peak_rank").drop("surface")


ELO_SQL = """,
c AS MATERIALIZED (
  SELECT surface, contest_id, winner_id AS w, loser_id AS l,
         row_number() OVER (PARTITION BY surface ORDER BY tourney_date, match_num, contest_id) AS n
  FROM pooled),
z AS (
  SELECT surface, contest_id, n, w, l, 1500.0::double AS we, 1500.0::double AS le,
         map([w, l], [1516.0::double, 1484.0::double]) AS st
  FROM c WHERE n = 1
  UNION ALL
  SELECT surface, contest_id, n, w, l, we, le,
         map_concat(st, map([w, l], [we + 32 * (1 - e), le + 32 * (0 - (1 - e))]))
  FROM (SELECT *, 1 / (1 + pow(10, (le - we) / 400)) AS e
        FROM (SELECT c.surface, c.contest_id, c.n, c.w, c.l,
                     coalesce(z.st[c.w], 1500.0::double) AS we, coalesce(z.st[c.l], 1500.0::double) AS le, z.st
              FROM z JOIN c ON c.surface = z.surface AND c.n = z.n + 1)))
"""


def _elo_prefix() -> str:
    return O.with_views(O.CONTESTS_CTE, O.CLEANED_CTE, O.RATIOS_CTE, O.PREP_CTE, O.POOLED_CTE).replace(
        "WITH ", "WITH RECURSIVE ", 1).rstrip() + ELO_SQL


@register("elo", _elo_prefix() + "SELECT contest_id, round(we, 9) AS w_elo, round(le, 9) AS l_elo FROM z")
def q_elo(spark, sf_dir):
    """WIN6: sequential per-surface Elo, both ratings before the contest."""
    return for_check(rating.elo_ratings(prepared(spark, sf_dir), S))


@register("elo_expectation", _elo_prefix() + """
SELECT contest_id, round(we, 9) AS w_elo, round(le, 9) AS l_elo,
       round(1 / (1 + pow(10, (le - we) / 400)), 9) AS expected FROM z""")
def q_elo_expectation(spark, sf_dir):
    """WIN7: winner's win expectation from the pre-contest ratings."""
    return for_check(rating.elo_expectation(rating.elo_ratings(prepared(spark, sf_dir), S)))

