"""File readers and writers on temporary CSV/Parquet fixtures."""

import os

import pytest
from pyspark.sql import functions as F

from duelspark.sources import files

HEADER = ("tourney_id,tourney_date,match_num,tourney_level,surface,round,best_of,score,winner_id,winner_name,"
          "winner_hand,winner_ht,winner_rank,loser_id,loser_name,loser_hand,loser_ht,loser_rank,w_svpt,w_ace,"
          "l_svpt,l_ace")


def _write(path, header, rows):
    with open(path, "w") as f:
        f.write(header + "\n")
        for r in rows:
            f.write(r + "\n")


@pytest.fixture()
def raw(tmpdir_path):
    d = tmpdir_path
    _write(f"{d}/m_2000.csv", HEADER, [
        "T1,20000103,1,G,Hard,R128,5,6-4 6-4,1,Ann,R,180,3,2,Bea,L,170,7,60,5,55,3",
        "T1,20000103,2,G,Hard,R128,5,6-4 ret.,3,Cid,R,,10,4,Dee,R,175,12,50,2,50,1",
        "T1,20000103,3,G,Hard,R128,5,,5,Eve,R,181,,6,Fay,U,182,,40,x,45,2",
    ])
    _write(f"{d}/m_2001.csv", HEADER + ",extra_col", [
        "T2,20010105,1,M,Clay,F,3,7-5 6-3,1,Ann,R,180,2,3,Cid,R,,9,70,4,60,2,zz",
    ])
    # columns in another order and one known column missing (winner_ht)
    reordered = ("loser_id,winner_id,tourney_date,match_num,tourney_level,surface,round,best_of,score,winner_name,"
                 "winner_hand,winner_rank,loser_name,loser_hand,loser_ht,loser_rank,w_svpt,w_ace,l_svpt,l_ace,"
                 "tourney_id")
    _write(f"{d}/m_2002.csv", reordered, [
        "2,1,20020107,1,A,Grass,SF,3,W/O,Ann,R,1,Bea,L,170,8,,,,,T3",
    ])
    _write(f"{d}/q_2000.csv", HEADER + ",minutes", [
        "Q1,20000101,1,C,Hard,Q1,3,6-1 6-1,7,Gus,R,185,200,8,Hal,R,180,300,50,6,50,4,",
        "Q1,20000101,2,C,Hard,Q1,3,6-1 6-1,9,Ivo,R,185,200,9,Ivo,R,180,300,50,6,50,4,",
        "Q1,20000132,3,C,Hard,Q1,3,6-1 6-1,9,Ivo,R,185,200,10,Jan,R,180,300,50,6,50,4,",
        "Q1,20000101,4,C,Hard,Q1,3,6-1 6-1,abc,Kim,R,185,200,10,Jan,R,180,300,50,6,50,4,",
    ])
    return d


def test_read_contests_by_name(spark, raw):
    fam = {"main": files.yearly_paths(raw, "m_{year}.csv", range(2000, 2004)),  # 2003 absent
           "qual_chall": files.yearly_paths(raw, "q_{year}.csv", [2000, 2001])}  # 2001 absent
    df = files.read_contests(spark, fam)
    rows = {(r.match_source, r.tourney_date, r.match_num): r for r in df.collect()}
    assert len(rows) == 9
    assert dict(df.dtypes)["minutes"] == "int"  # all-empty column: typed NULLs
    assert df.where(F.col("minutes").isNotNull()).count() == 0
    # reordered file bound by name, not by position
    r = rows[("main", 20020107, 1)]
    assert (r.winner_id, r.loser_id, r.winner_name) == (1, 2, "Ann")
    assert r.winner_ht is None  # column absent in that file -> typed NULL
    # malformed number -> NULL; empty -> NULL
    bad = rows[("main", 20000103, 3)]
    assert bad.w_ace is None and bad.winner_rank is None and bad.score is None
    assert dict(df.dtypes)["winner_ht"] == "double" and dict(df.dtypes)["w_ace"] == "int"
    assert dict(df.dtypes)["extra_col"] == "string"
    assert df.select("contest_id").distinct().count() == 9


def test_invalid_rows_go_to_a_counted_side_output(spark, raw):
    from duelspark.operators import clean
    from duelspark.settings import Settings
    s = Settings.reference()
    df = files.read_contests(spark, {"qual_chall": [f"{raw}/q_2000.csv"]})
    bad = {r.match_num: r.reason for r in clean.invalid_contests(df, s).collect()}
    assert bad == {2: "winner equals loser", 3: "invalid date", 4: "missing player id"}
    assert [r.match_num for r in clean.clean_contests(df, s).collect()] == [1]


def test_common_only_keeps_intersection(spark, raw):
    fam = {"main": files.yearly_paths(raw, "m_{year}.csv", [2000, 2001])}
    df = files.read_contests(spark, fam, common_only=True)
    assert "extra_col" not in df.columns
    assert df.count() == 4


def test_missing_everything_gives_none(spark, tmpdir_path):
    assert files.read_contests(spark, {"main": [f"{tmpdir_path}/nope.csv"]}) is None
    assert files.read_players(spark, f"{tmpdir_path}/players.csv") is None


def test_rankings_rename_and_skip_absent(spark, tmpdir_path):
    _write(f"{tmpdir_path}/r_a.csv", "ranking_date,rank,player,points", ["20000103,1,1,5000", "20000103,x,2,"])
    df = files.read_rankings(spark, [f"{tmpdir_path}/r_a.csv", f"{tmpdir_path}/r_b.csv"])
    rows = sorted(df.collect(), key=lambda r: r["player_id"])
    assert "player_id" in df.columns and len(rows) == 2
    assert [r["rank"] for r in rows] == [1, None]


def test_parquet_file_and_directory(spark, tmpdir_path):
    df = spark.range(10).withColumn("tourney_date", F.lit(20000101) + F.col("id") * 10000)
    files.write_table(files.with_season(df), f"{tmpdir_path}/t", partition_by=["season"])
    back = files.read_parquet(spark, f"{tmpdir_path}/t")
    assert back.count() == 10 and "season" in back.columns
    assert back.where(F.col("season") == 2003).count() == 1
    one = f"{tmpdir_path}/one.parquet"
    df.toPandas().to_parquet(one)
    assert files.read_parquet(spark, one).count() == 10


def test_document_round_trip(spark, tmpdir_path):
    doc = spark.createDataFrame([("lr", 0.61, {"train": 10, "val": 3})],
                                "model string, log_loss double, splits map<string,int>")
    files.write_document(doc, f"{tmpdir_path}/doc")
    back = files.read_document(spark, f"{tmpdir_path}/doc")
    assert back.first()["model"] == "lr"
    files.write_small_csv(doc.select("model", "log_loss"), f"{tmpdir_path}/csv")
    assert any(n.endswith(".csv") for n in os.listdir(f"{tmpdir_path}/csv"))
