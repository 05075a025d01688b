"""Checked queries for the fixture views and stages 1-2 (cleaning, ratios, fills)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clean
from ..settings import Settings
from ..sources.fixtures import FixtureTables
from . import oracle_sql as O
from .registry import for_check, register

S = Settings.fixture()


def contests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FixtureTables(spark, sf_dir).contests()


def prepared(spark: SparkSession, sf_dir: str, materialize: bool = False) -> DataFrame:
    """Stages 1-2 applied to the fixture contests (written once when several
    consumers follow)."""
    return clean.preprocess(contests(spark, sf_dir), S, materialize=materialize)


@register("contests", O.contests_prefix() + "SELECT * FROM contests")
def q_contests(spark, sf_dir):
    return for_check(contests(spark, sf_dir))


@register("rankings", O.with_views(O.RANKINGS_CTE) + "SELECT * FROM rankings")
def q_rankings(spark, sf_dir):
    return FixtureTables(spark, sf_dir).rankings()


@register("predictions", O.predictions_prefix() + "SELECT * FROM predictions")
def q_predictions(spark, sf_dir):
    return for_check(FixtureTables(spark, sf_dir).predictions(S.seed))


_CLEAN_COLS = ("contest_id", "tourney_date", "match_num", "tourney_level", "match_source", "surface",
               "round", "best_of", "score", "winner_id", "loser_id")


@register("clean_contests", O.with_views(O.CONTESTS_CTE, O.CLEANED_CTE) + f"""
SELECT {', '.join(c for c in _CLEAN_COLS if c != 'surface')},
       CASE WHEN surface IN ('ECONOMY', 'LARGE', 'MEDIUM', 'PROMO') THEN surface ELSE 'ECONOMY' END AS surface,
       'fixture' AS family
FROM cleaned""")
def q_clean_contests(spark, sf_dir):
    """FLT1, FLT2, PRJ4 (try_cast), PRJ1 (literal tag), NUL3 (surface fallback)."""
    from ..operators.history import with_pool
    c = clean.clean_contests(contests(spark, sf_dir), S)
    return clean.tag_source(with_pool(c, S).select(*_CLEAN_COLS), "fixture", "family")


_RATIO_COLS = [f"{s}_{f}" for s in ("w", "l") for f in
               ("1st_serve_pct", "1st_serve_win_pct", "2nd_serve_win_pct", "bp_saved_pct", "ace_rate", "df_rate")]


@register("serve_ratios", O.with_views(O.CONTESTS_CTE, O.CLEANED_CTE, O.RATIOS_CTE)
          + "SELECT contest_id, " + ", ".join(f"round({c}, 9) AS {c}" for c in _RATIO_COLS) + " FROM rat")
def q_serve_ratios(spark, sf_dir):
    """SCA1-SCA2."""
    c = clean.serve_ratios(clean.clean_contests(contests(spark, sf_dir), S))
    return for_check(c.select("contest_id", *_RATIO_COLS))


@register("rank_fill", O.prep_prefix()
          + "SELECT contest_id, winner_rank, loser_rank, winner_rank_points, loser_rank_points FROM prep")
def q_rank_fill(spark, sf_dir):
    """NUL1."""
    return prepared(spark, sf_dir).select("contest_id", "winner_rank", "loser_rank",
                                          "winner_rank_points", "loser_rank_points")


@register("height_fill", O.prep_prefix()
          + "SELECT contest_id, surface, winner_ht, loser_ht FROM prep")
def q_height_fill(spark, sf_dir):
    """NUL2, ARR1, AGG3, JOIN1 (two consumers of the cleaned table: the
    median branch and the filled rows, so it is written once)."""
    return for_check(prepared(spark, sf_dir, True).select("contest_id", "surface", "winner_ht", "loser_ht"))


@register("height_medians", O.with_views(O.CONTESTS_CTE, O.CLEANED_CTE, O.RATIOS_CTE, O.PREP_CTE)
          + "SELECT surface, ht_median FROM hmed")
def q_height_medians(spark, sf_dir):
    """AGG3 on its own: lower median per surface group."""
    c = clean.clean_contests(contests(spark, sf_dir), S)
    return clean.height_medians(c)


@register("counts_by_source", O.with_views(O.CONTESTS_CTE, O.CLEANED_CTE) + """
SELECT CASE WHEN grouping(match_source) = 1 THEN 'all' ELSE match_source END AS match_source,
       count(*) AS n
FROM cleaned GROUP BY ROLLUP (match_source)""")
def q_counts_by_source(spark, sf_dir):
    """AGG1-AGG2: total and per-family row counts in one aggregate."""
    c = clean.clean_contests(contests(spark, sf_dir), S)
    return (c.rollup("match_source")
            .agg(F.count(F.lit(1)).alias("n"), F.grouping("match_source").alias("_g"))
            .select(F.when(F.col("_g") == 1, F.lit("all")).otherwise(F.col("match_source")).alias("match_source"),
                    "n"))
