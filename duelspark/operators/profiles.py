"""Player career profiles and K-Means clustering (reference stage 4).

AGG4, FLT4, ML1-ML5. The profile table has one row per player; it is built by
one aggregation over the long appearance view (partial aggregation on the map
side, so a prolific player costs one partial row per task, not a hot group).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from ..settings import SERVE_FIELDS, Settings
from .frames import attach_row

PART_ROWS = 1 << 16  # profiles of one K-Means task


def career_profiles(prepared: DataFrame, fields=SERVE_FIELDS, until_date: int | None = None) -> DataFrame:
    """AGG4 + FLT4: per player, null-skipping mean of each ratio over both
    sides, and the last non-null name (winner rows before loser rows, each in
    time order); players without a full profile dropped.

    ``until_date`` restricts the profile to contests up to that date (the
    reference uses all years, test period included: H7 in the survey)."""
    if "match_num" not in prepared.columns:  # PRJ10
        prepared = prepared.withColumn("match_num", F.lit(None).cast("long"))
    src = prepared if until_date is None else prepared.where(F.col("tourney_date") <= until_date)

    def side(tag: str, full: str, rank: int):
        return F.struct(F.col(f"{full}_id").cast("long").alias("player_id"),
                        F.col(f"{full}_name").alias("player_name"),
                        F.struct(F.lit(rank).alias("s"), F.col("tourney_date").alias("d"),
                                 F.col("match_num").alias("m"), F.col("contest_id").alias("c")).alias("o"),
                        *[F.col(f"{tag}_{f}").cast("double").alias(f) for f in fields])

    long = src.select(F.inline(F.array(side("w", "winner", 0), side("l", "loser", 1))))
    named = F.col("player_name").isNotNull()
    prof = long.groupBy("player_id").agg(
        *[F.avg(f).alias(f) for f in fields],
        F.max_by(F.when(named, F.col("player_name")), F.when(named, F.col("o"))).alias("player_name"))
    return prof.na.drop("any", subset=list(fields)).select("player_id", "player_name", *fields)


def standardize(df: DataFrame, cols, suffix: str = "") -> DataFrame:
    """ML1: z-scores with the population std (zero-variance column -> 0).
    Mean and std are a one-row aggregate attached as a scalar subquery."""
    stats = df.agg(*[F.avg(c).alias(f"_m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"_s_{c}") for c in cols])
    x = attach_row(df, stats)
    z = {f"{c}{suffix}": F.when(F.col(f"_s_{c}") > 0, (F.col(c) - F.col(f"_m_{c}")) / F.col(f"_s_{c}"))
         .otherwise(F.lit(0.0)) for c in cols}
    return x.withColumns(z).drop(*[f"_m_{c}" for c in cols], *[f"_s_{c}" for c in cols])


@dataclass
class Sweep:
    k: int
    cost: float
    seed: int
    centers: np.ndarray  # (k, fields), standardised


def _standard(profiles: DataFrame, fields) -> DataFrame:
    return standardize(profiles, list(fields), "_z")


def _matrix(batch: pa.RecordBatch, fields) -> np.ndarray:
    return np.stack([batch[f"{f}_z"].to_numpy(zero_copy_only=False) for f in fields], axis=1)


def _squares(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """(rows, centres), summed field by field: no (rows, centres, fields) array is built."""
    out = np.zeros((len(x), len(centers)))
    for i in range(x.shape[1]):
        apart = x[:, i, None] - centers[None, :, i]
        out += apart * apart
    return out


def _draw(batch: pa.RecordBatch, seed: int, turn: int) -> np.ndarray:
    """Exponential variables keyed by (seed, turn, player): the same on every run and partitioning."""
    ids = batch["player_id"].to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    x = ids * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed * 1000003 + turn * 7919 + 1) * np.uint64(0xD1B54A32D192ED03)
    for shift in (30, 27):  # mixing of 64 bits by shifts and odd factors
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(31)
    return -np.log((x >> np.uint64(11)).astype(np.float64) * 2.0 ** -53 + 2.0 ** -54)


def seed_centers(data: DataFrame, fields, seeds: list[int], most: int) -> np.ndarray:
    """(seeds, most, fields): for every seed a sequence of starting centres, each drawn with probability
    in proportion to the squared distance from those before it (the row of least exponential variable
    over distance). One job per place of the sequence for all seeds; a task returns one row a seed."""
    found = np.zeros((len(seeds), 0, len(fields)))
    for turn in range(most):
        def run(batches, found=found, turn=turn):
            best: dict[int, tuple] = {}
            for b in batches:
                x, ids = _matrix(b, fields), b["player_id"].to_pylist()
                for i, seed in enumerate(seeds):
                    far = _squares(x, found[i]).min(axis=1) if turn else np.ones(len(x))
                    with np.errstate(divide="ignore"):
                        key = np.where(far > 0, _draw(b, seed, turn) / far, np.inf)
                    at = int(key.argmin())
                    drawn = (float(key[at]), ids[at], x[at].tolist())
                    best[i] = min(best[i], drawn) if i in best else drawn
            if best:
                yield pa.record_batch([pa.array(list(best), pa.int32()), *map(pa.array, zip(*best.values()))],
                                      names=["i", "key", "player_id", "x"])

        rows = data.mapInArrow(run, "i int, key double, player_id long, x array<double>") \
            .groupBy("i").agg(F.min(F.struct("key", "player_id", "x")).alias("best")).orderBy("i").collect()
        found = np.concatenate([found, np.array([[r["best"]["x"]] for r in rows])], axis=1)
    return found


def assignment_sums(data: DataFrame, fields, centers: list[np.ndarray]):
    """For all runs in one pass: per run its inertia, the rows and the component sums of each centre."""
    def run(batches):
        total = [np.zeros((len(c), 2 + len(fields))) for c in centers]
        for b in batches:
            x = _matrix(b, fields)
            for c, found in zip(centers, total):
                dist = _squares(x, c)
                near = dist.argmin(axis=1)
                for i, weights in enumerate((None, dist[np.arange(len(x)), near], *x.T)):
                    found[:, i] += np.bincount(near, weights, len(c))
        met = [(r, j, *row) for r, found in enumerate(total) for j, row in enumerate(found.tolist()) if row[0]]
        if met:
            yield pa.record_batch([pa.array(c) for c in zip(*met)], names=names)

    values = ["n", "cost", *[f"s{i}" for i in range(len(fields))]]
    names = ["run", "centre", *values]
    rows = data.mapInArrow(run, "run long, centre long, " + ", ".join(f"{c} double" for c in values)) \
        .groupBy("run", "centre").agg(*[F.sum(c).alias(c) for c in values]).collect()  # one row per centre
    cost = np.zeros(len(centers))
    count = [np.zeros(len(c)) for c in centers]
    sums = [np.zeros_like(c) for c in centers]
    for r in rows:
        cost[r["run"]] += r["cost"]
        count[r["run"]][r["centre"]] = r["n"]
        sums[r["run"]][r["centre"]] = [r[c] for c in values[2:]]
    return cost, count, sums


def kmeans_sweep(profiles: DataFrame, s: Settings, fields=SERVE_FIELDS, restarts: int | None = None,
                 max_iter: int = 300, tol: float = 1e-4) -> list[Sweep]:
    """ML2: for each K, ``restarts`` seeded fits, keep the lowest inertia (sum of squared distances).

    All fits advance together: one aggregate per iteration for all (K, seed, centre), until a fit's
    centres move by at most ``tol`` in squared distance. A centre without rows stays where it is. Fewer
    distinct profiles than K repeat starting centres, which then stay empty."""
    data = _standard(profiles, fields).select("player_id", *[f"{f}_z" for f in fields])
    # a profile is small, the work on it is not: dealt over all cores, not by bytes
    cores = data.sparkSession.sparkContext.defaultParallelism
    data = data.repartition(max(cores, profiles.count() // PART_ROWS), "player_id").persist(StorageLevel.MEMORY_AND_DISK)
    seeds = [s.seed + r for r in range(restarts or s.kmeans_restarts)]
    try:
        if data.isEmpty():
            return []
        start = seed_centers(data, fields, seeds, max(s.k_range))
        runs = [(k, i) for k in s.k_range for i in range(len(seeds))]
        centers = [start[i, :k].copy() for k, i in runs]
        moving = list(range(len(runs)))
        for _ in range(max_iter):
            _, count, sums = assignment_sums(data, fields, [centers[r] for r in moving])
            still = []
            for r, n, total in zip(moving, count, sums):
                new = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], centers[r])
                if ((new - centers[r]) ** 2).sum() > tol:
                    still.append(r)
                centers[r] = new
            moving = still
            if not moving:
                break
        cost, _, _ = assignment_sums(data, fields, centers)
    finally:
        data.unpersist()
    fits = [Sweep(k, float(c), seeds[i], x) for (k, i), c, x in zip(runs, cost, centers)]
    return [min((f for f in fits if f.k == k), key=lambda f: (f.cost, f.seed)) for k in s.k_range]


def inertia_table(spark, sweep: list[Sweep]) -> DataFrame:
    """The (k, inertia) curve as a DataFrame (one row per K)."""
    return spark.createDataFrame([(x.k, float(x.cost)) for x in sweep], "k int, inertia double")


def pick_elbow(curve: DataFrame) -> DataFrame:
    """ML3: K farthest from the line through the first and last point of the
    (k, inertia) curve; ties -> smaller K; zero-length line -> first K."""
    ends = curve.agg(F.min_by("inertia", "k").alias("_y1"), F.min("k").alias("_x1"),
                     F.max_by("inertia", "k").alias("_y2"), F.max("k").alias("_x2"))
    x = attach_row(curve, ends)
    dx, dy = F.col("_x2") - F.col("_x1"), F.col("_y2") - F.col("_y1")
    length = F.sqrt(dx * dx + dy * dy)
    cross = F.abs(dx * (F.col("inertia") - F.col("_y1")) - dy * (F.col("k") - F.col("_x1")))
    x = x.withColumn("dist", F.when(length > 0, cross / length).otherwise(F.lit(0.0)))
    return x.agg(F.max_by("k", F.struct(F.col("dist"), -F.col("k"))).alias("k"))


def assign_clusters(profiles: DataFrame, centers: np.ndarray, fields=SERVE_FIELDS) -> DataFrame:
    """ML4: player -> cluster, the nearest of the chosen centres (ties: the lower number)."""
    z = _standard(profiles, fields)
    places = F.array(*[F.struct(sum((F.pow(F.col(f"{f}_z") - float(v), 2) for f, v in zip(fields, c)), F.lit(0.0)).alias("d"),
                                F.lit(j).alias("cluster")) for j, c in enumerate(centers)])
    return z.select("player_id", "player_name", F.array_min(places)["cluster"].alias("cluster"), *fields)


def centroids(assigned: DataFrame, fields=SERVE_FIELDS, digits: int = 3) -> DataFrame:
    """ML5: cluster centres in original units (mean of members), rounded."""
    return assigned.groupBy("cluster").agg(*[F.round(F.avg(f), digits).alias(f) for f in fields])
