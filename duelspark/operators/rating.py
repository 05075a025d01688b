"""WIN6 / WIN7: sequential Elo ratings per rating pool.

Each player starts at ``elo_initial`` in every pool (surface); both ratings are
emitted *before* the contest, then winner += K(1-E), loser += K(0-(1-E)) with
E = 1 / (1 + 10^((R_l - R_w)/400)).

A contest needs the ratings its players left in their previous contest of the
same pool, so the exact result is a true sequential chain within a pool; pools
are independent. Plan: project six narrow columns, sort them per pool and month
in many tasks and pack them in time order into blocks of ``BLOCK_ROWS`` contests
that hold ids only; place each pool's blocks in its own
partition (``repartitionById`` over the known surface domain; hash
partitioning with an explicit count for other pool keys, so AQE does not merge
pools back together), sort the few blocks
within partitions (external sort, spills), then one streaming pass per
partition in ``mapInPandas`` over Arrow batches. State is one dict keyed by
(pool, player): memory O(players), never O(contests), and nothing is collected.

Limit, stated plainly: parallelism is the number of pools. A pool is walked by
one task because its result is defined sequentially. Pass finer pools (extra
key columns such as a league or region) when the data has them. The walk's
output is written once to the cluster's checkpoint folder so that a lost
executor never forces the walk to run again.
"""

from __future__ import annotations

from typing import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import expected_score
from ..session import materialize
from ..settings import Settings
from .history import with_pool

BLOCK_ROWS = 128  # contests of one packed block
IDS = ("contest_id", "winner_id", "loser_id")
ELO_SCHEMA = "contest_id {id}, w_elo double, l_elo double"


def _walker(initial: float, k: float, n_pool_cols: int):
    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pools: dict = {}  # pool -> {player: rating}
        cur_pool, cur = object(), None
        for pdf in batches:
            keys = list(zip(*[pdf[f"_p{i}"].tolist() for i in range(n_pool_cols)]))
            ws = pdf["winner_id"].tolist()
            ls = pdf["loser_id"].tolist()
            we_out = [0.0] * len(ws)
            le_out = [0.0] * len(ws)
            for i, (pool, w, lo) in enumerate(zip(keys, ws, ls)):
                if pool != cur_pool:  # rows arrive sorted by pool: rare switch
                    cur_pool, cur = pool, pools.setdefault(pool, {})
                rw = cur.get(w, initial)
                rl = cur.get(lo, initial)
                we_out[i] = rw
                le_out[i] = rl
                e = 1.0 / (1.0 + 10 ** ((rl - rw) / 400.0))
                cur[w] = rw + k * (1.0 - e)
                cur[lo] = rl + k * (0.0 - (1.0 - e))
            yield pd.DataFrame({"contest_id": pdf["contest_id"], "w_elo": we_out, "l_elo": le_out})
    return walk


def packed(narrow: DataFrame, pcols: list[str]) -> DataFrame:
    """(pool, _m, _n, contest_id, winner_id, loser_id): blocks of one pool and month, numbered in time
    order; the ids are arrays."""
    keys = [*pcols, "_m"]
    types = dict(narrow.dtypes)
    schema = ", ".join([*(f"{c} {types[c]}" for c in keys), "_n long", *(f"{c} array<{types[c]}>" for c in IDS)])

    def run(batches):
        last, n = None, 0
        for b in batches:
            at = list(zip(*(b[c].to_pylist() for c in keys)))
            edges = [0, *(i for i in range(1, len(at)) if at[i] != at[i - 1]), len(at)]
            cuts = [i for lo, hi in zip(edges, edges[1:]) for i in range(lo, hi, BLOCK_ROWS)]
            if not cuts:
                continue
            numbers = []
            for i in cuts:
                n = n + 1 if at[i] == last else 0
                last = at[i]
                numbers.append(n)
            offsets = pa.array([*cuts, len(at)], pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, b[c]) for c in IDS]
            yield pa.record_batch([*(b[c].take(pa.array(cuts)) for c in keys), pa.array(numbers, pa.int64()), *lists],
                                  names=[*keys, "_n", *IDS])

    return narrow.repartition(*keys).sortWithinPartitions(*keys, "tourney_date", "match_num", "contest_id") \
        .mapInArrow(run, schema)


def unpacked(batches: Iterator[pd.DataFrame], pcols: list[str]) -> Iterator[pd.DataFrame]:
    """The contests of the blocks, in their order."""
    for pdf in batches:
        for at in range(0, len(pdf), 64):
            yield pdf.iloc[at:at + 64][[*pcols, *IDS]].explode(list(IDS), ignore_index=True)


def elo_ratings(contests: DataFrame, s: Settings, pool_cols: tuple[str, ...] | None = None,
                partitions: int | None = None, checkpoint: bool = True) -> DataFrame:
    """(contest_id, w_elo, l_elo): both ratings before each contest, per pool
    (``s.rating_pools`` unless ``pool_cols`` is given)."""
    pool_cols = tuple(pool_cols or s.rating_pools)
    pooled = with_pool(contests, s)
    narrow = pooled.select("contest_id", "tourney_date", "match_num", "winner_id", "loser_id",
                           F.floor(F.col("tourney_date") / 100).alias("_m"),
                           *[F.col(c).alias(f"_p{i}") for i, c in enumerate(pool_cols)])
    pcols = [f"_p{i}" for i in range(len(pool_cols))]
    blocks = packed(narrow, pcols)
    if tuple(pool_cols) == ("surface",) and partitions is None:
        # known pool domain (after the surface fallback): one partition per pool, by id
        idx = F.array_position(F.array(*[F.lit(x) for x in s.surfaces]), F.col("_p0")).cast("int") - 1
        placed = blocks.repartitionById(len(s.surfaces), idx)
    else:
        # as many tasks as any other shuffle has, however many pools there are
        n = partitions or int(contests.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        placed = blocks.repartition(n, *pcols)
    ordered = placed.sortWithinPartitions(*pcols, "_m", "_n")
    walk = _walker(s.elo_initial, s.elo_k, len(pcols))
    out = ordered.mapInPandas(lambda batches: walk(unpacked(batches, pcols)),
                              ELO_SCHEMA.format(id=dict(contests.dtypes)["contest_id"]))
    return materialize(out, "elo") if checkpoint else out


def elo_expectation(elo: DataFrame) -> DataFrame:
    """WIN7: winner's expected score from the pre-contest ratings."""
    return elo.withColumn("expected", expected_score("w_elo", "l_elo"))
