"""Checked queries for the reader's and the union's rules, on the fixture contests: fields typed
from text, contest keys of repeated rows, unions of unlike tables, shifted dates, the elbow rule."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalar import shift_yyyymmdd
from ..operators import clean, profiles
from ..sources import files
from . import oracle_sql as O
from .ingest_queries import contests
from .registry import register

_TYPED = ("tourney_date", "winner_id", "loser_id", "winner_ht")


@register("typed_fields", O.contests_prefix() + """
SELECT contest_id, tourney_date, CASE WHEN match_num % 7 <> 0 THEN winner_id END AS winner_id, loser_id,
       CAST(winner_ht AS double) AS winner_ht
FROM contests""")
def q_typed_fields(spark, sf_dir):
    """SRC1, SCA9: fields written as text (every other row with ``.0``, a missing height as NaN, some
    ids with a half) and typed back."""
    c = contests(spark, sf_dir)
    plain = {name: F.col(name).cast("string") for name in _TYPED}
    gaps = {name: F.when(F.col("match_num") % 2 == 0, text).otherwise(F.concat(text, F.lit(".0")))
            for name, text in plain.items()}
    gaps["winner_id"] = F.when(F.col("match_num") % 7 == 0, F.concat(plain["winner_id"], F.lit(".5"))) \
        .otherwise(gaps["winner_id"])
    gaps["winner_ht"] = F.coalesce(plain["winner_ht"], F.lit("NaN"))
    written = c.select("contest_id", *[text.alias(name) for name, text in gaps.items()])
    return written.select("contest_id", *[files.typed(F.col(name), files.MATCH_TYPES[name]).alias(name) for name in _TYPED])


_KEYED = ("match_source", "tourney_date", "match_num", "winner_id", "loser_id")


@register("duplicate_contests", O.contests_prefix() + f"""
SELECT {', '.join(_KEYED)}, count(*) AS contests, count(*) AS ids, CAST(count(*) AS int) AS last_ordinal
FROM (SELECT * FROM contests UNION ALL SELECT * FROM contests WHERE match_num % 3 = 0)
GROUP BY {', '.join(_KEYED)}""")
def q_duplicate_contests(spark, sf_dir):
    """H1: a third of the contests twice; every copy keeps an id of its own."""
    c = contests(spark, sf_dir).select(*_KEYED)
    keyed = files.contest_key(clean.union_all([c, c.where("match_num % 3 = 0")]))
    ordinal = F.element_at(F.split("contest_id", "-"), -1).cast("int")
    return keyed.groupBy(*_KEYED).agg(F.count(F.lit(1)).alias("contests"), F.countDistinct("contest_id").alias("ids"),
                                      F.max(ordinal).alias("last_ordinal"))


def _families(spark, sf_dir):
    c = contests(spark, sf_dir)
    main = c.where("match_source = 'main'").select("contest_id", "surface", "winner_id", "winner_rank")
    qual = c.where("match_source = 'qual_chall'").select("loser_rank", "winner_id", "contest_id", "surface")
    return [clean.tag_source(main, "main", "family"), clean.tag_source(qual, "qual_chall", "family")]


@register("family_union", O.contests_prefix() + """
SELECT contest_id, surface, winner_id, match_source AS family,
       CASE WHEN match_source = 'main' THEN winner_rank END AS winner_rank,
       CASE WHEN match_source = 'qual_chall' THEN loser_rank END AS loser_rank
FROM contests""")
def q_family_union(spark, sf_dir):
    """SET1, PRJ10: two tables of unlike columns by name, absent ones NULL."""
    return clean.union_all(_families(spark, sf_dir))


@register("family_common", O.contests_prefix()
          + "SELECT contest_id, match_source AS family, surface, winner_id FROM contests")
def q_family_common(spark, sf_dir):
    """SET3, PRJ2: the same two tables on the columns they share."""
    return clean.union_all(_families(spark, sf_dir), common_only=True)


@register("shifted_dates", O.contests_prefix() + """
SELECT contest_id, tourney_date,
       CAST(strftime(strptime(CAST(tourney_date AS varchar), '%Y%m%d') - INTERVAL 14 DAY, '%Y%m%d') AS int) AS window_start
FROM contests""")
def q_shifted_dates(spark, sf_dir):
    """SCA6: the first day of each contest's workload window."""
    return contests(spark, sf_dir).select("contest_id", "tourney_date",
                                          shift_yyyymmdd("tourney_date", -14).alias("window_start"))


@register("elbow_of_bands", O.with_views(O.CONTESTS_CTE, """
x AS (SELECT w_svpt AS x, count(*) AS n FROM contests WHERE w_svpt IS NOT NULL GROUP BY 1)""", """
bands AS (
  SELECT k, floor(x * k / 51) AS band, sum(n) AS n, sum(n * x) AS s, sum(n * x * x) AS ss
  FROM x, (SELECT unnest(range(2, 9)) AS k) GROUP BY 1, 2)""", """
curve AS (SELECT k, sum(ss - CAST(s AS double) * CAST(s AS double) / n) AS y FROM bands GROUP BY k)""", """
line AS (SELECT min(k) AS x1, max(k) AS x2, arg_min(y, k) AS y1, arg_max(y, k) AS y2 FROM curve)""") + """
SELECT CAST(k AS int) AS k FROM curve, line
ORDER BY abs((x2 - x1) * (y - y1) - (y2 - y1) * (k - x1)) / sqrt((x2 - x1) ** 2 + (y2 - y1) ** 2) DESC, k LIMIT 1""")
def q_elbow_of_bands(spark, sf_dir):
    """ML3 on a curve that needs no fit: spread of the winners' service points within 2 to 8 equal bands."""
    x = contests(spark, sf_dir).where("w_svpt IS NOT NULL").groupBy(F.col("w_svpt").cast("long").alias("x")) \
        .agg(F.count(F.lit(1)).alias("n"))
    bands = x.withColumn("k", F.explode(F.sequence(F.lit(2), F.lit(8)))) \
        .groupBy("k", F.floor(F.col("x") * F.col("k") / 51).alias("band")) \
        .agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("x")).alias("s"),
             F.sum(F.col("n") * F.col("x") * F.col("x")).alias("ss"))
    s = F.col("s").cast("double")
    return profiles.pick_elbow(bands.groupBy("k").agg(F.sum(F.col("ss") - s * s / F.col("n")).alias("inertia")))
