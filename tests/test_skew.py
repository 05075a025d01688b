"""A hot player holding half of all appearance rows: the chunked history plan
keeps every window group bounded and gives the single-window results."""

import random

from pyspark.sql import functions as F

from history_windows import single_window
from duelspark.operators import history
from duelspark.settings import SERVE_FIELDS, Settings

S = Settings.reference().with_(history_chunk_rows=64)


def _hot_contests(spark, n=3000):
    rnd = random.Random(9)
    rows = []
    for i in range(n):
        other = rnd.randint(2, 40)
        hot_wins = rnd.random() < 0.6
        w, lo = (1, other) if hot_wins else (other, 1)
        day = 1 + i // 3  # three contests a day, ~1000 days
        rows.append((i, day, i % 5, "GMACF"[i % 5], ("Hard", "Clay", "Grass", "Mud")[i % 4], w, lo,
                     rnd.random(), rnd.random() if i % 7 else None))
    df = spark.createDataFrame(rows, "contest_id long, day int, match_num long, tourney_level string, "
                                     "surface string, winner_id long, loser_id long, r1 double, r2 double")
    date = F.date_format(F.date_add(F.lit("2000-01-01").cast("date"), F.col("day")), "yyyyMMdd").cast("int")
    cols = {"tourney_date": date}
    for side in ("w", "l"):
        for j, f in enumerate(SERVE_FIELDS):
            cols[f"{side}_{f}"] = F.col("r1" if j % 2 == 0 else "r2") * (0.5 if side == "w" else 0.4)
    return df.withColumns(cols).drop("day", "r1", "r2")


def test_hot_player_chunks_are_bounded(spark):
    c = _hot_contests(spark)
    app = history.appearances(history.with_pool(c, S), S)
    total = app.count()
    hot = app.where(F.col("player_id") == 1).count()
    assert hot * 2 >= total  # one key holds half of the rows
    pos = history._with_positions(app, ["player_id"], "_gpos")
    groups = pos.groupBy("player_id", F.floor(F.col("_gpos") / S.history_chunk_rows).alias("c")).count()
    assert groups.agg(F.max("count")).first()[0] <= S.history_chunk_rows
    # positions are a dense 0..n-1 sequence per player
    per = pos.groupBy("player_id").agg(F.min("_gpos").alias("lo"), F.max("_gpos").alias("hi"),
                                       F.count(F.lit(1)).alias("n"), F.countDistinct("_gpos").alias("d"))
    assert per.where((F.col("lo") != 0) | (F.col("hi") != F.col("n") - 1) | (F.col("d") != F.col("n"))).count() == 0


def test_hot_player_results_equal_single_window(spark):
    c = _hot_contests(spark)
    cols = ["global_form", "surface_form", "fatigue", *[f"avg_{f}" for f in SERVE_FIELDS]]
    a = {(r.contest_id, r.side): tuple(r[k] for k in cols)
         for r in history.history_features(c, None, S).collect()}
    b = {(r.contest_id, r.side): tuple(r[k] for k in cols)
         for r in single_window(c, None, S).collect()}
    assert a.keys() == b.keys()
    for k in a:
        for x, y in zip(a[k], b[k]):
            assert (x is None and y is None) or abs(x - y) < 1e-12, (k, a[k], b[k])
