"""Edge rows and independent re-computations of the evaluation arithmetic."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from duelspark.functions import scalar as X
from duelspark.operators import evaluate as E
from duelspark.operators.frames import attach_row
from duelspark.operators import profiles as P
from duelspark.operators.stats import exact_quantiles


def _pairwise_auc(y, p):
    pos = [pi for yi, pi in zip(y, p) if yi == 1]
    neg = [pi for yi, pi in zip(y, p) if yi == 0]
    s = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
    return s / (len(pos) * len(neg))


def _with_partitions(spark, n, run):
    """Scores are ranked in as many ranges as there are shuffle partitions."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", n)
    try:
        return run()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("partitions", ["1", "4", "64"])
def test_auc_two_level_equals_pairwise(spark, partitions):
    rnd = random.Random(7)
    rows = [(g, rnd.randint(0, 1), round(rnd.random(), 2)) for g in ("a", "b") for _ in range(300)]
    rows += [("c", 1, 0.5), ("c", 1, 0.7)]  # one class
    df = spark.createDataFrame(rows, "g string, y int, p double")
    got = {r.g: r.auc_roc for r in _with_partitions(spark, partitions, lambda: E.auc_by(df, ["g"], "y", "p").collect())}
    for g in ("a", "b"):
        sub = [(y, p) for gg, y, p in rows if gg == g]
        assert got[g] == pytest.approx(_pairwise_auc(*zip(*sub)), abs=1e-12)
    assert got["c"] is None


def test_one_class_slice_has_no_loss_or_auc(spark):
    df = spark.createDataFrame([("Hard", 1, 0.0), ("Hard", 1, 1.0), ("Clay", 0, 0.5), ("Clay", 1, 0.5),
                                (None, 0, 0.2)], "surface string, target int, prob double")
    t = {r.slice: r for r in E.slice_table(df, "surface", "prob").collect()}
    assert set(t) == {"surface=Hard", "surface=Clay", "overall"}
    assert t["surface=Hard"].log_loss is None and t["surface=Hard"].auc_roc is None
    assert t["surface=Hard"].accuracy == 0.5  # p = 0 -> label 0, p = 1 -> label 1
    assert t["surface=Clay"].auc_roc == 0.5 and t["overall"].n == 5
    # clipped log loss: p = 0 with y = 1 costs -ln(1e-6)
    ll = [-(math.log(1e-6)), -math.log(1 - 1e-6), -math.log(0.5), -math.log(0.5), -math.log(0.8)]
    assert t["overall"].log_loss == pytest.approx(sum(ll) / 5)


def _roc_reference(y, s):
    order = sorted(range(len(s)), key=lambda i: -s[i])
    ys, ss = [y[i] for i in order], [s[i] for i in order]
    thr, tps, fps = [], [], []
    tp = fp = 0
    for i, (yy, sc) in enumerate(zip(ys, ss)):
        tp += yy
        fp += 1 - yy
        if i == len(ss) - 1 or ss[i + 1] != sc:
            thr.append(sc), tps.append(tp), fps.append(fp)
    if len(fps) > 2:
        keep = [0] + [i for i in range(1, len(fps) - 1)
                      if (fps[i + 1] - 2 * fps[i] + fps[i - 1]) or (tps[i + 1] - 2 * tps[i] + tps[i - 1])] + [len(fps) - 1]
        thr, tps, fps = [thr[i] for i in keep], [tps[i] for i in keep], [fps[i] for i in keep]
    P, N = tps[-1], fps[-1]
    return sorted([(0.0, 0.0, math.inf)] + [(f / N, t / P, th) for f, t, th in zip(fps, tps, thr)])


def test_roc_points_match_reference_curve(spark):
    rnd = random.Random(3)
    rows = [(rnd.randint(0, 1), round(rnd.random(), 1), round(rnd.random(), 3)) for _ in range(400)]
    df = spark.createDataFrame(rows, "target int, a double, b double")
    got = E.roc_points(df, {"m1": "a", "m2": "b"}).collect()
    for m, c in (("m1", 1), ("m2", 2)):
        mine = sorted((r.fpr, r.tpr, r.threshold) for r in got if r.model == m)
        ref = _roc_reference([r[0] for r in rows], [r[c] for r in rows])
        assert len(mine) == len(ref)
        for a, b in zip(mine, ref):
            assert a == pytest.approx(b)


def test_calibration_edges(spark):
    ps = [0.0, 0.1, 0.10000001, 0.5, 0.9, 0.95, 1.0, 0.30000000000000004, 0.3]
    df = spark.createDataFrame([(p, 1) for p in ps], "p double, target int")
    got = dict(df.select("p", X.calibration_bin("p").alias("b")).collect())
    edges = np.linspace(0.0, 1.0, 11)
    for p in ps:
        assert got[p] == int(np.searchsorted(edges[1:-1], p))


@pytest.mark.parametrize("values", [[3.0, 1.0, 2.5, 7.0, -4.0, 2.5, 9.9, 0.0], [5.0, 5.0, 5.0], [0.0, 0.0]])
def test_right_closed_bins_match_cut(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    st = df.agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    got = [r.b for r in attach_row(df, st).select(X.right_closed_bin("x", "lo", "hi", 10).alias("b")).collect()]
    want = pd.cut(pd.Series(values), bins=10, labels=False).tolist()
    assert got == want


@pytest.mark.parametrize("values", [[random.Random(1).random() for _ in range(500)], [0.3, 0.3], [0.0, 1.0, 0.5]])
def test_left_closed_bins_match_histogram(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    st = df.agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    got = np.bincount([r.b for r in attach_row(df, st).select(X.left_closed_bin("x", "lo", "hi", 30).alias("b"))
                       .collect()], minlength=30)
    want, _ = np.histogram(values, bins=30)
    assert got.tolist() == want.tolist()


def _elbow_ref(ks, ys):
    p1, p2 = np.array([ks[0], ys[0]]), np.array([ks[-1], ys[-1]])
    v = p2 - p1
    n = np.linalg.norm(v)
    best, bd = ks[0], -1.0
    for k, y in zip(ks, ys):
        q = np.array([k, y]) - p1
        d = abs(v[0] * q[1] - v[1] * q[0]) / n if n else 0.0  # 2-D cross product
        if d > bd:
            best, bd = k, d
    return best


@pytest.mark.parametrize("ys", [[100, 60, 40, 35, 33, 32, 31], [10, 10, 10, 10, 10, 10, 10],
                                [50, 40, 30, 20, 10, 5, 0], [9, 8, 2, 1.5, 1.2, 1.1, 1.0]])
def test_elbow_matches_reference_rule(spark, ys):
    ks = list(range(2, 9))
    curve = spark.createDataFrame(list(zip(ks, [float(y) for y in ys])), "k int, inertia double")
    assert P.pick_elbow(curve).first()["k"] == _elbow_ref(ks, ys)



@pytest.mark.parametrize("partitions", ["1", "64"])
def test_exact_quantiles_match_numpy(spark, partitions):
    rnd = random.Random(11)
    vals = [float(rnd.randint(0, 300)) for _ in range(3000)] + [None] * 20
    df = spark.createDataFrame([(v, v * 2 if v is not None else None) for v in vals], "a double, b double")
    got = _with_partitions(spark, partitions, lambda: exact_quantiles(df, ["a", "b"], [0.25, 0.5, 0.75]))
    arr = np.array([v for v in vals if v is not None])
    for c, mult in (("a", 1), ("b", 2)):
        want = np.percentile(arr * mult, [25, 50, 75])
        assert got[c] == pytest.approx(list(want))


def test_scalar_guards(spark):
    df = spark.createDataFrame([(1, 0), (1, -2), (1, None), (3, 4)], "n int, d int")
    assert [r.q for r in df.select(X.share_of("n", "d").alias("q")).collect()] == [None, None, None, 0.75]
    h = spark.createDataFrame([(None, "L"), ("u", "r"), ("A", "L"), ("L", "L")], "a string, b string")
    assert [r.c for r in h.select(X.hand_code("a", "b").alias("c")).collect()] == [1, 0, 0, 3]
    r = spark.createDataFrame([("QF",), ("Q1",), (None,)], "r string")
    assert [x.o for x in r.select(X.round_ordinal("r").alias("o")).collect()] == [5, 0, 0]
    d = spark.createDataFrame([(20000301,), (20001301,), (None,)], "d int")
    assert [x.s for x in d.select(X.shift_yyyymmdd("d", -14).alias("s")).collect()] == [20000216, None, None]
    s = spark.createDataFrame([("Hard",), ("Mud",), (None,)], "s string")
    assert [x.p for x in s.select(X.in_domain_or("s", ("Hard", "Clay"), "Hard").alias("p")).collect()] == \
        ["Hard", "Hard", "Hard"]


def test_exact_quantiles_on_heavy_duplicates(spark):
    vals = [5.0] * 900 + [float(i) for i in range(100)] + [0.0, 1.0] * 200
    df = spark.createDataFrame([(v, v % 2) for v in vals], "a double, b double")
    got = exact_quantiles(df, ["a", "b"], [0.1, 0.5, 0.9])
    for c, arr in (("a", np.array(vals)), ("b", np.array(vals) % 2)):
        assert got[c] == pytest.approx(list(np.percentile(arr, [10, 50, 90])))
