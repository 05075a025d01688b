"""Rows that real exports contain: repeated contests, decimal-form integers, NaN, absent numbers,
malformed rankings, contests outside the splits."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from duelspark.operators import asof, clean, history, inspect, matrix, rating
from duelspark.settings import Settings
from duelspark.sources import files

S = Settings.reference()
HEADER = ("tourney_id,surface,tourney_level,tourney_date,match_num,winner_id,winner_name,winner_ht,loser_id,loser_name,"
          "loser_ht,score,round")
ROWS = ["t1,Hard,A,20190101.0,1.0,101.0,A,NaN,102.0,B,180,6-1 6-1,R32",
        "t1,Hard,A,20190101.0,1.0,101.0,A,NaN,102.0,B,180,6-1 6-1,R32",
        "t1,Hard,A,20190102,2,101,A,190,103,C,,7-5,R16", "t1,,A,20190103,3,102,B,,103,C,175,6-0,QF",
        "t2,Clay,G,20190204,1,103,C,175.5,101,A,190,ret,F", "t2,Clay,G,20190204,1,7.5,C,175.5,101,A,190,6-1,F"]


def contests(spark, tmp_path, header=HEADER, rows=ROWS):
    path = tmp_path / "m.csv"
    path.write_text("\n".join([header, *rows]) + "\n")
    return files.read_contests(spark, {"main": [str(path)]})


def test_decimal_form_integers_and_nan(spark, tmp_path):
    got = contests(spark, tmp_path).orderBy("tourney_date", "winner_id").collect()
    first = got[0]
    assert (first["tourney_date"], first["match_num"], first["winner_id"], first["loser_id"]) == (20190101, 1, 101, 102)
    assert first["winner_ht"] is None and [r["winner_id"] for r in got].count(None) == 1


def test_repeated_contests_stay_single_rows(spark, tmp_path):
    kept = clean.preprocess(contests(spark, tmp_path), S)
    assert kept.count() == 4 and kept.select("contest_id").distinct().count() == 4
    rows = matrix.pre_match(kept, None, S, elo_checkpoint=False).collect()
    assert len(rows) == 4
    twins = sorted((r for r in rows if r["tourney_date"] == 20190101), key=lambda r: r["w_elo"])
    assert [r["w_elo"] for r in twins] == [1500.0, 1516.0]  # the second copy is walked after the first


def test_absent_contest_number(spark, tmp_path):
    header = HEADER.replace("match_num,", "")
    rows = [",".join(c for i, c in enumerate(r.split(",")) if i != 4) for r in ROWS]
    kept = clean.preprocess(contests(spark, tmp_path, header, rows).drop("match_num"), S)
    assert matrix.feature_matrix(kept, None, S, elo_checkpoint=False).count() == 4
    from duelspark.operators.profiles import career_profiles
    assert career_profiles(kept).count() == 0  # no serve counts in these rows


def test_both_ranking_paths_agree_on_odd_rows(spark):
    ranks = spark.createDataFrame([("101", "20180230", "3", "1"), ("101", "20180301", "9", "1"), ("x1", "20180301", "1", "1"),
                                   ("102", "20180301", "bad", "1")], "player_id string, ranking_date string, rank string, points string")
    c = spark.createDataFrame([("c1", 20190101, 1, "Hard", "A", 101, 102)],
                              "contest_id string, tourney_date int, match_num long, surface string, tourney_level string, "
                              "winner_id long, loser_id long")
    h = {r["player_id"]: r["peak_rank"] for r in history.history_features(c, ranks, S).collect()}
    q = c.select(F.col("winner_id").alias("player_id"), "tourney_date").union(c.select("loser_id", "tourney_date"))
    a = {r["player_id"]: r["peak_rank"] for r in asof.peak_rank_asof(q, ranks).collect()}
    assert h == a == {101: 9, 102: None}
    assert [r["peak_rank"] for r in asof.running_best(ranks).collect()] == [9]


def test_height_fill_has_no_exchange_on_surface(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 2 == 0, "Hard").otherwise("Clay").alias("surface"),
                                  F.when(F.col("id") % 5 > 0, F.col("id").cast("double")).alias("winner_ht"),
                                  F.lit(180.0).alias("loser_ht"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        out = clean.fill_height(df)
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and out.where("winner_ht IS NULL").count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_describe_covers_every_simple_type(spark):
    df = spark.createDataFrame([(True, dt.date(2020, 1, 1), dt.datetime(2020, 1, 1), 1.5, "a")] * 2
                               + [(False, None, None, None, None)],
                               "b boolean, d date, t timestamp, x double, s string")
    got = {r["column"]: r for r in inspect.describe(df).collect()}
    assert set(got) == {"b", "d", "t", "x", "s"}
    assert (got["b"]["top"], got["b"]["freq"], got["d"]["count"], got["t"]["unique"]) == ("true", 2, 2, 1)


def test_many_pools_use_many_tasks(spark):
    c = spark.range(400).select(F.col("id").alias("contest_id"), F.lit(20190101).alias("tourney_date"),
                                F.col("id").alias("match_num"), F.lit("Hard").alias("surface"),
                                (F.col("id") * 2).alias("winner_id"), (F.col("id") * 2 + 1).alias("loser_id"),
                                F.col("id").alias("league"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 64)
    try:
        out = rating.elo_ratings(c, S, pool_cols=("league",), checkpoint=False)
        assert out.rdd.getNumPartitions() == 64 and out.count() == 400
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("text,token", [("6-1 RET", True), ("w/o", True), (None, False), ("6-1 6-2", False)])
def test_has_token(spark, text, token):
    from duelspark.functions.scalar import has_token
    df = spark.createDataFrame([(text,)], "score string")
    assert df.select(has_token("score", S.bad_score_tokens)).first()[0] is token


def test_crowded_scores_keep_groups_bounded(spark):
    from duelspark.operators import evaluate
    n = 4000
    df = spark.range(n).select((F.lit(0.5) + F.col("id") * 1e-10).alias("p"), (F.col("id") * 7 % 3 == 0).cast("int").alias("y"),
                               F.lit("s").alias("k"))
    pts = evaluate.ranked_points(df, ["k"], "y", "p")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert pts.groupBy("_b").count().agg(F.max("count")).first()[0] <= 3 * n / parts
    y = [int(i * 7 % 3 == 0) for i in range(n)]
    below, wins = 0, 0
    for v in y:
        wins, below = (wins + below, below) if v else (wins, below + 1)
    got = evaluate.auc_by(df, ["k"], "y", "p").first()["auc_roc"]
    assert abs(got - wins / (sum(y) * (n - sum(y)))) < 1e-12
