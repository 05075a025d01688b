"""JOIN3 / WIN5: as-of lookups on a ranking history.

Backward, inclusive as-of join as a union plus one RANGE window: both sides are
put on (player, date), the running minimum over ``unbounded preceding ..
current row`` is read off at the query rows. Equal dates are peers of the
RANGE frame, so a ranking dated the same day counts (``side='right'``). One
exchange on the player key, a linear scan, no inequality join.

Each side is pre-aggregated to one row per (player, date) first, so a window
group holds at most one row per date of that player, whatever the raw row
count of a hot player.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import to_date


def clean_rankings(rankings: DataFrame) -> DataFrame:
    """Drop incomplete rows (FLT4), cast ids/dates/ranks to int (PRJ4): a malformed id or rank, or a
    number that is no calendar date, makes the row incomplete. Every as-of path starts here."""
    return (rankings.select(F.col("player_id").try_cast("long").alias("player_id"),
                            F.col("ranking_date").try_cast("int").alias("ranking_date"),
                            F.col("rank").try_cast("int").alias("rank"))
            .na.drop("any").where(to_date("ranking_date").isNotNull()))


def running_best(rankings: DataFrame) -> DataFrame:
    """WIN5: best (minimum) rank of each player up to and including each ranking date."""
    per_day = clean_rankings(rankings).groupBy("player_id", "ranking_date").agg(F.min("rank").alias("rank"))
    w = Window.partitionBy("player_id").orderBy("ranking_date").rowsBetween(Window.unboundedPreceding, 0)
    return per_day.withColumn("peak_rank", F.min("rank").over(w))


def peak_rank_asof(queries: DataFrame, rankings: DataFrame, date_col: str = "tourney_date",
                   player_col: str = "player_id") -> DataFrame:
    """JOIN3: for each distinct (player, date) of ``queries``, the best rank at or
    before that date; no history -> NULL. Returns (player, date, peak_rank)."""
    q = (queries.select(F.col(player_col).cast("long").alias("player_id"),
                        F.col(date_col).cast("int").alias("_d"))
         .distinct().withColumn("_q", F.lit(True)).withColumn("rank", F.lit(None).cast("int")))
    h = (clean_rankings(rankings).groupBy("player_id", F.col("ranking_date").alias("_d"))
         .agg(F.min("rank").alias("rank")).withColumn("_q", F.lit(False)))
    w = Window.partitionBy("player_id").orderBy("_d").rangeBetween(Window.unboundedPreceding, 0)
    return (q.unionByName(h).withColumn("peak_rank", F.min("rank").over(w))
            .where(F.col("_q"))
            .select(F.col("player_id").alias(player_col), F.col("_d").alias(date_col), "peak_rank"))
