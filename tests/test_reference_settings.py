"""The stages under the reference's own domains (surfaces, levels, splits)."""

import random

from pyspark.sql import functions as F

from duelspark.plans import stages
from duelspark.settings import Settings

COLS = ("tourney_id,tourney_date,match_num,tourney_level,surface,round,best_of,score,winner_id,winner_name,"
        "winner_hand,winner_ht,winner_age,winner_rank,winner_rank_points,loser_id,loser_name,loser_hand,loser_ht,"
        "loser_age,loser_rank,loser_rank_points,w_svpt,w_1stIn,w_1stWon,w_2ndWon,w_bpSaved,w_bpFaced,w_ace,w_df,"
        "l_svpt,l_1stIn,l_1stWon,l_2ndWon,l_bpSaved,l_bpFaced,l_ace,l_df")


def _write_year(path, year, rnd, family):
    lines = [COLS]
    for t in range(6):
        date = year * 10000 + (t + 1) * 100 + 5
        level = "GMAC"[t % 4] if family == "main" else "C"
        surface = ("Hard", "Clay", "Grass", "Carpet", "")[t % 5]
        for m in range(1, 9):
            w, lo = rnd.sample(range(100, 112), 2)
            score = "6-4 RET" if m == 8 and t == 0 else "6-4 6-3"
            stats = [rnd.randint(40, 90) for _ in range(2)]
            side = lambda sv: [sv, sv * 6 // 10, sv * 4 // 10, sv * 2 // 10, 2, 4, rnd.randint(0, 9), 2]
            lines.append(",".join(map(str, [
                f"{year}-{t}", date, m, level, surface, ("R32", "QF", "SF", "F")[m % 4], 3, score,
                w, f"P{w}", "R" if w % 3 else "L", "" if w % 5 == 0 else 180 + w % 10, 25.5, w - 99, 1000,
                lo, f"P{lo}", "", 185, 27.0, "" if lo % 4 == 0 else lo - 99, 900,
                *side(stats[0]), *side(stats[1])])))
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


def test_stages_with_reference_settings(spark, tmpdir_path):
    rnd = random.Random(4)
    s = Settings.reference()
    paths = {"main": [], "qual_chall": []}
    for fam in paths:
        for y in (2019, 2020, 2021):
            p = f"{tmpdir_path}/{fam}_{y}.csv"
            _write_year(p, y, rnd, fam)
            paths[fam].append(p)
    out = f"{tmpdir_path}/out"
    counts = stages.ingest(spark, paths, out, s)
    assert counts["all"] == counts["main"] + counts["qual_chall"]
    assert counts["main"] == 3 * 6 * 8 - 3  # the retired contests are dropped
    stages.preprocess(spark, out, s)
    prep = spark.read.parquet(f"{out}/preprocessed")
    assert prep.where(F.col("winner_ht").isNull() & F.col("surface").isNotNull()).count() == 0
    assert prep.where(F.col("loser_rank").isNull()).count() == 0
    stages.features(spark, out, s)
    fm = spark.read.parquet(f"{out}/features")
    # main draw, levels G/M/A only; one-hot columns of the reference's domains
    assert fm.where(~F.col("tourney_level").isin("G", "M", "A")).count() == 0
    assert {"surface_Hard", "surface_Carpet", "tourney_level_G", "elo_diff", "peak_rank_diff"} <= set(fm.columns)
    # the unnamed surface falls back to Hard
    assert fm.where(F.col("surface") == "").count() == 0
    # per year: tournaments 0..5 have levels G, M, A, C, G, M -> five predicted, 8 contests
    # each, minus the retired contest of tournament 0
    assert fm.count() == 3 * (5 * 8 - 1)
