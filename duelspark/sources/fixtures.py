"""Maps the driver's TPC-H-like tables onto the contest data model.

Players are suppliers; a contest is a pair of adjacent lines of one order and
the dearer line wins (FIXTURES.md, part B). The pairing uses ``lead`` over the
per-order window instead of self-joins, so the whole view costs one window on
``l_orderkey`` that reuses the orders join's partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import table_path

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def _yyyymmdd(ts: Column) -> Column:
    return (F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)).cast("int")


_RAW = ("l_suppkey", "s_name", "l_quantity", "l_tax", "l_discount", "p_size", "l_extendedprice")


def _line_side(c) -> dict[str, Column]:
    """Per-line player statistics (one side of a contest); ``c(name)`` gives
    the raw column of this side."""
    q, size, supp = c("l_quantity"), c("p_size"), c("l_suppkey")
    return {
        "id": supp,
        "name": c("s_name"),
        "svpt": q.cast("int"),
        "in1": F.floor(q * 6 / 10).cast("int"),
        "won1": F.floor(q * 4 / 10).cast("int"),
        "won2": F.floor(q * 2 / 10).cast("int"),
        "bpf": F.round(c("l_tax") * 100).cast("int"),
        "bps": F.floor(F.round(c("l_tax") * 100) / 2).cast("int"),
        "ace": F.round(c("l_discount") * 100).cast("int"),
        "dfs": F.floor(q / 25).cast("int"),
        "rnk": F.when(size % 13 != 0, size % 13),
        "pts": F.when(size % 3 > 0, size * 10),
        "age": (F.lit(18) + supp % 20).cast("double"),
        "ht": F.when(size % 7 > 0, F.lit(160) + size),
        "hand": (F.when(supp % 5 == 0, "L").when(supp % 7 == 0, F.lit(None))
                 .when(supp % 11 == 0, "u").when(supp % 13 == 0, "A").otherwise("R")),
        "price": c("l_extendedprice"),
    }


_SIDE_OUT = {
    "rank": "rnk", "rank_points": "pts", "age": "age", "ht": "ht", "hand": "hand",
}
_SERVE_OUT = {
    "svpt": "svpt", "1stIn": "in1", "1stWon": "won1", "2ndWon": "won2",
    "bpSaved": "bps", "bpFaced": "bpf", "ace": "ace", "df": "dfs",
}


def contests_from_tables(lineitem: DataFrame, part: DataFrame, orders: DataFrame,
                         supplier: DataFrame) -> DataFrame:
    """One row per contest, winner and loser columns side by side (match CSV layout)."""
    li = lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                         "l_extendedprice", "l_discount", "l_tax", "l_shipdate")
    pt = part.select(F.col("p_partkey").alias("l_partkey"), "p_type", "p_size")
    sp = supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    od = orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority", "o_orderstatus")
    # part and supplier joins first, orders last: the per-order window below then
    # reuses the orders join's hash partitioning on l_orderkey (no extra exchange).
    lines = li.join(pt, "l_partkey").join(sp, "l_suppkey", "left").join(od, "l_orderkey")

    order_w = Window.partitionBy("l_orderkey").orderBy(
        "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity",
        "l_discount", "l_tax", "l_shipdate")
    # the window carries the raw columns once (plus lead of them); the side
    # structs are built after it, so the exchange holds no duplicated struct
    paired = lines.select(
        "l_orderkey", "l_shipdate", "l_linenumber", "p_type", "o_orderpriority", "o_orderstatus", *_RAW,
        F.row_number().over(order_w).alias("rn"),
        F.lead(F.lit(True), 1).over(order_w).alias("has_b"),
        *[F.lead(x, 1).over(order_w).alias(f"b_{x}") for x in _RAW],
    ).where((F.col("rn") % 2 == 1) & F.col("has_b") & (F.col("l_suppkey") != F.col("b_l_suppkey")))
    paired = paired.select(
        "l_orderkey", "l_shipdate", "l_linenumber", "p_type", "o_orderpriority", "o_orderstatus", "rn",
        F.col("l_quantity").alias("aq"),
        F.struct(*[e.alias(k) for k, e in _line_side(F.col).items()]).alias("a"),
        F.struct(*[e.alias(k) for k, e in _line_side(lambda x: F.col(f"b_{x}")).items()]).alias("b"))

    awin = F.col("a.price") >= F.col("b.price")
    w = F.when(awin, F.col("a")).otherwise(F.col("b"))
    lo = F.when(awin, F.col("b")).otherwise(F.col("a"))
    ln = F.col("l_linenumber")
    pri = F.col("o_orderpriority")
    aq = F.col("aq")
    cols = [
        (F.col("l_orderkey") * 100 + F.col("rn")).alias("contest_id"),
        _yyyymmdd(F.col("l_shipdate")).alias("tourney_date"),
        F.col("l_orderkey").alias("match_num"),
        F.substring(pri, 1, 1).alias("tourney_level"),
        F.when(F.col("o_orderstatus") == "P", "qual_chall").otherwise("main").alias("match_source"),
        F.col("p_type").alias("surface"),
        (F.when(ln == 1, "R128").when(ln == 2, "R64").when(ln == 3, "R32").when(ln == 4, "QF")
         .when(ln == 5, "F").when(ln == 6, "RR").otherwise("Q1")).alias("round"),
        F.when(ln == 7, F.lit(None).cast("int")).when(pri.like("1%"), 5).otherwise(3).alias("best_of"),
        (F.when(aq == 50, "6-4 ret").when(aq == 49, "W/O").when(aq == 48, F.lit(None))
         .otherwise("6-4 6-4")).alias("score"),
        w["id"].alias("winner_id"), lo["id"].alias("loser_id"),
        w["name"].alias("winner_name"), lo["name"].alias("loser_name"),
    ]
    for out, k in _SIDE_OUT.items():
        cols += [w[k].alias(f"winner_{out}"), lo[k].alias(f"loser_{out}")]
    for out, k in _SERVE_OUT.items():
        cols.append(w[k].alias(f"w_{out}"))
    for out, k in _SERVE_OUT.items():
        cols.append(lo[k].alias(f"l_{out}"))
    return paired.select(*cols)


def rankings_from_tables(lineitem: DataFrame, part: DataFrame, orders: DataFrame) -> DataFrame:
    """Ranking history: (player_id, ranking_date, rank, points), distinct rows."""
    od = (orders.where(F.col("o_orderstatus") == "F")
          .select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate"))
    li = lineitem.where(F.col("l_suppkey") % 10 > 0).select("l_orderkey", "l_partkey", "l_suppkey")
    pt = part.select(F.col("p_partkey").alias("l_partkey"), "p_size")
    return (li.join(pt, "l_partkey").join(od, "l_orderkey")
            .select(F.col("l_suppkey").alias("player_id"),
                    _yyyymmdd(F.col("o_orderdate")).alias("ranking_date"),
                    F.col("p_size").alias("rank"),
                    (F.col("p_size") * 100).alias("points"))
            .distinct())


def coin(contest_id: Column, seed: int = 42) -> Column:
    """Fair keyed coin: True when player1 is the winner. Independent of
    partitioning and row order (unlike ``rand(seed)``)."""
    key = F.concat(F.lit(f"{seed}:"), contest_id.cast("string"))
    return F.substring(F.md5(key), 1, 1) < F.lit("8")


def predictions_from_contests(contests: DataFrame, seed: int = 42,
                              predicted_levels=("1", "2", "3")) -> DataFrame:
    """A scored test table with ties and the exact values 0, 0.5 and 1."""
    return (contests.where((F.col("match_source") == "main")
                           & F.col("tourney_level").isin(*predicted_levels))
            .select("contest_id", "tourney_date", "surface", "tourney_level", "round",
                    F.when(coin(F.col("contest_id"), seed), 1).otherwise(0).alias("target"),
                    ((F.col("w_svpt") - F.col("l_svpt")) * 8).cast("double").alias("elo_diff"),
                    (F.col("w_ace") / F.lit(10.0)).alias("lr_prob"),
                    ((F.col("w_bpFaced") + F.col("l_bpFaced")) / F.lit(16.0)).alias("rf_prob"),
                    ((F.col("w_svpt") + F.col("l_svpt")) / F.lit(100.0)).alias("xgb_prob")))


class FixtureTables:
    """Lazily built fixture views over one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    def contests(self) -> DataFrame:
        return contests_from_tables(self.table("lineitem"), self.table("part"),
                                    self.table("orders"), self.table("supplier"))

    def rankings(self) -> DataFrame:
        return rankings_from_tables(self.table("lineitem"), self.table("part"), self.table("orders"))

    def predictions(self, seed: int = 42) -> DataFrame:
        return predictions_from_contests(self.contests(), seed)
