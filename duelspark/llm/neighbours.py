"""Approximate nearest neighbours by learned partitions, for the largest inner product.

1. Fit, on a bounded sample (``sample`` rows expected, by a hash of the id): the exact neighbour
   graph of the sample; a balanced partition of that graph (balanced k-means as a start, then
   rounds in which every vector moves to the part that holds most of its neighbours and still
   has room); a softmax classifier from a vector to the distribution of its neighbours' parts.
   There is one part for every ``part_rows`` rows, at least ``parts`` and at most ``most_parts``; the
   sample has ``sample`` rows, or 64 for every part if that is more.
2. Index every row: its part is the classifier's most probable one. A part of any size is dealt
   over blocks of about ``block`` rows, the queries that visit it over blocks of about
   ``query_block``; a group is one block of each, so its size has a bound on both sides.
3. Route: a query visits its most probable parts. How many is measured, not guessed: the fewest
   for which the sample's own queries find ``recall`` of their true neighbours.
4. Rerank: every group scores its queries against its rows exactly and returns the best ``k`` of each
   query; the best ``k`` of all groups are the answer, ties to the smaller id.

Scores are inner products in double precision of the original vectors, each the sum of one
row's products in a fixed order, so equal vectors have equal scores. Edge cases: vectors that are
null, all zero, of another length than the most common one, or with null or non-finite components
take no part; rows with a null id neither; repeated rows of an id are one row (the least vector); fewer than ``k``
candidates give all of them; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize, parts, spread

RESULT = "query_id long, vec_id long, score double"


@dataclass(frozen=True)
class Params:
    k: int = 20
    sample: int = 4000
    parts: int = 16
    most_parts: int = 128
    part_rows: int = 65536
    neighbours: int = 10
    rounds: int = 8
    recall: float = 0.95
    block: int = 8192
    query_block: int = 8192
    seed: int = 3


@dataclass(frozen=True)
class Router:
    weights: np.ndarray  # (dim + 1, parts)
    probes: int

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return softmax(unit(x) @ self.weights[:-1] + self.weights[-1])


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-30)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fill(score: np.ndarray, room: int) -> np.ndarray:
    """Rows to columns by descending score, no column above ``room``."""
    out, left = np.full(len(score), -1), np.full(score.shape[1], room)
    order = np.argsort(-score, axis=None, kind="stable")
    for flat in order:
        i, j = divmod(int(flat), score.shape[1])
        if out[i] < 0 and left[j] > 0:
            out[i] = j
            left[j] -= 1
    return out


def graph_partition(x: np.ndarray, near: np.ndarray, p: Params) -> np.ndarray:
    """Balanced parts of the neighbour graph (``near``: neighbours of every row)."""
    rng, n = np.random.default_rng(p.seed), len(x)
    count = min(p.parts, n)
    room = int(np.ceil(1.1 * n / count))
    centres = x[rng.choice(n, count, replace=False)]
    part = np.zeros(n, int)
    for _ in range(p.rounds):
        part = fill(x @ centres.T, room)
        centres = unit(np.stack([x[part == j].mean(axis=0) if (part == j).any() else centres[j] for j in range(count)]))
    for _ in range(p.rounds):
        votes = np.zeros((n, count))
        np.add.at(votes, (np.repeat(np.arange(n), near.shape[1]), part[near].ravel()), 1.0)
        np.add.at(votes, (near.ravel(), np.repeat(part, near.shape[1])), 1.0)
        votes += 1e-3 * (x @ centres.T)
        moved = fill(votes, room)
        if np.array_equal(moved, part):
            break
        part = moved
    return part


def best(x: np.ndarray, q: np.ndarray, k: int) -> np.ndarray:
    return np.argsort(-(q @ x.T), axis=1, kind="stable")[:, :k]


def fit_router(ids: np.ndarray, x: np.ndarray, p: Params) -> Router:
    order = np.argsort(ids, kind="stable")
    x = x[order].astype(np.float64)
    if len(x) < 2:
        return Router(np.zeros((x.shape[1] + 1, 1)), 1)
    u = unit(x)
    near = np.concatenate([best(u, u[i:i + 512], p.neighbours + 1) for i in range(0, len(u), 512)])[:, 1:]
    part = graph_partition(u, near, p)
    count = part.max() + 1
    goal = np.zeros((len(u), count))
    goal[np.arange(len(u)), part] = 1.0
    np.add.at(goal, (np.repeat(np.arange(len(u)), near.shape[1]), part[near].ravel()), 1.0 / max(1, near.shape[1]))
    goal /= goal.sum(axis=1, keepdims=True)
    w, speed = np.zeros((u.shape[1] + 1, count)), np.full((u.shape[1] + 1, count), 1e-8)
    a = np.hstack([u, np.ones((len(u), 1))])
    for _ in range(300):
        g = a.T @ (softmax(a @ w) - goal) / len(u) + 1e-5 * w
        speed += g * g
        w -= 0.5 * g / np.sqrt(speed)
    router = Router(w, count)
    place = router.probabilities(x)
    home, tests = place.argmax(axis=1), np.arange(0, len(x), max(1, len(x) // 500))
    top = best(x, x[tests], p.k + 1)
    ranks = np.argsort(np.argsort(-place[tests], axis=1, kind="stable"), axis=1)
    need = np.take_along_axis(ranks, home[top], axis=1)[top != tests[:, None]]
    found = np.cumsum(np.bincount(need, minlength=count)) / max(1, len(need))
    return Router(w, int(np.searchsorted(found, p.recall) + 1) if len(need) else count)


def vectors(table: pa.Table, column: str) -> np.ndarray:
    flat = table[column].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(table.num_rows, -1)


def score_block(query_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int):
    """(query_id, vec_id, score) of the best ``k`` rows of a block for every query; rows that tie with
    the last by rounding are scored in a fixed order before the choice."""
    out = []
    for at in range(0, len(q), 256):
        rough = q[at:at + 256] @ x.T
        keep = min(k + 1, x.shape[0])
        floor = np.partition(rough, -keep, axis=1)[:, -keep] - 1e-9 * (1 + np.abs(rough).max(axis=1))
        for i, row in enumerate(rough):
            some = np.flatnonzero(row >= floor[i])
            some = some[ids[some] != query_ids[at + i]]
            exact = (x[some] * q[at + i]).sum(axis=1)
            order = np.lexsort((ids[some], -exact))[:k]
            out.append((np.full(len(order), query_ids[at + i]), ids[some][order], exact[order]))
    return [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]


def usable(rows: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, v): rows that take part."""
    v = F.col("v")
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    good = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("v")) \
        .where(F.col("vec_id").isNotNull() & v.isNotNull() & ~bad & F.exists(v, lambda c: c != 0))
    good = materialize(good.groupBy("vec_id").agg(F.min("v").alias("v")), "vectors")
    sizes = good.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("rows"))
    most = sizes.orderBy(F.desc("rows"), "n").limit(1).collect()
    return good.where(F.size("v") == (most[0]["n"] if most else 0))


def sized(p: Params, n: int) -> Params:
    """``p`` for a table of ``n`` rows: more parts, and the sample that they need."""
    count = max(p.parts, min(p.most_parts, parts(n, p.part_rows)))
    return replace(p, parts=count, sample=max(p.sample, 64 * count))


def search(rows: DataFrame, queries: Column, p: Params = Params(), vec_id: str = "vec_id",
           embedding: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found for every row on which ``queries`` (a
    condition on ``vec_id``) holds, among all other rows."""
    spark = rows.sparkSession
    data = usable(rows, vec_id, embedding)
    n = data.count()
    p = sized(p, n)
    share = F.pmod(F.xxhash64("vec_id", F.lit(p.seed)), F.lit(1 << 30)) < F.lit(int((1 << 30) * min(1.0, p.sample / max(1, n))))
    sample = data.where(share if n > p.sample else F.lit(True)).toPandas()  # bounded by ``sample``
    if not n or not len(sample):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    router = fit_router(sample["vec_id"].to_numpy(), np.stack(sample["v"].to_numpy()), p)
    shared = spark.sparkContext.broadcast(router)

    def place(batches):
        for b in batches:
            if b.num_rows:
                t = pa.Table.from_batches([b])
                home = shared.value.probabilities(vectors(t, "v")).argmax(axis=1)
                yield pa.record_batch([b["vec_id"], b["v"], pa.array(home.astype(np.int32))], names=["vec_id", "v", "part"])

    def route(batches):
        r = shared.value
        for b in batches:
            if b.num_rows:
                place_ = r.probabilities(vectors(pa.Table.from_batches([b]), "v"))
                to = np.argsort(-place_, axis=1, kind="stable")[:, :r.probes]
                take = pa.array(np.repeat(np.arange(b.num_rows), to.shape[1]))
                yield pa.record_batch([b["vec_id"].take(take), b["v"].take(take), pa.array(to.ravel().astype(np.int32))],
                                      names=["vec_id", "v", "part"])

    schema = "vec_id long, v array<double>, part int"
    index = materialize(data.mapInArrow(place, schema), "index")
    asked = data.where(queries).mapInArrow(route, schema)

    def blocks(table: DataFrame, rows_: int) -> Column:
        """Number of blocks of a row's part (0: the part has no rows here)."""
        sizes = table.groupBy("part").agg(F.count("*").alias("n")).collect()  # one row per part
        of = [F.lit(x) for r in sizes for x in (r["part"], parts(r["n"], rows_))]
        return F.coalesce(F.element_at(F.create_map(*of), F.col("part")), F.lit(0)) if of else F.lit(0)

    def every(count: Column) -> Column:
        return F.explode(F.when(count > 0, F.sequence(F.lit(0), count - 1)))

    x_blocks, q_blocks = blocks(index, p.block), blocks(asked, p.query_block)
    index = index.withColumn("block", spread(x_blocks, "vec_id")).withColumn("visit", every(q_blocks))
    asked = asked.withColumn("visit", spread(q_blocks, "vec_id")).withColumn("block", every(x_blocks))

    def rerank(q: pa.Table, x: pa.Table) -> pa.Table:
        got = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        if q.num_rows and x.num_rows:
            got = score_block(q["vec_id"].to_numpy(), vectors(q, "v"), x["vec_id"].to_numpy(), vectors(x, "v"), p.k)
        return pa.table(dict(zip(("query_id", "vec_id", "score"), map(pa.array, got))))

    found = asked.groupBy("part", "block", "visit").cogroup(index.groupBy("part", "block", "visit")).applyInArrow(rerank, RESULT)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= p.k).select("query_id", "rank", "vec_id", "score")


def exact_search(rows: DataFrame, queries: Column, p: Params = Params(), vec_id: str = "vec_id",
                 embedding: str = "embedding") -> DataFrame:
    """The same with every part visited: the yardstick for recall."""
    return search(rows, queries, Params(**{**p.__dict__, "recall": 2.0}), vec_id, embedding)
