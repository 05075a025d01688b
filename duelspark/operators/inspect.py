"""Inspection of any table as DataFrames (PRJ7, SRT1, SRT4, AGG19-20).

The reference's inspection command line is re-aimed as functions; all of them
run on the cluster and return small DataFrames.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DateType, NumericType, StringType, TimestampNTZType,
                               TimestampType)

from ..session import materialize
from .stats import quantile_table

QUARTILES = (0.25, 0.5, 0.75)
SIMPLE = (StringType, BooleanType, DateType, TimestampType, TimestampNTZType)
DESCRIBED = ("column string, count long, unique long, top string, freq long, mean double, std double, min double, "
             "`25%` double, `50%` double, `75%` double, max double")


def select_known(df: DataFrame, cols: list[str] | None) -> DataFrame:
    """PRJ7: keep the named columns that exist; none valid -> all columns."""
    named = [name.strip() for name in cols or []]
    found = [name for name in named if name in df.columns]
    return df.select(*(found or df.columns))


def sort_by_time(df: DataFrame) -> DataFrame:
    """SRT1: global sort by date, then number when present, then the contest
    id (a total order; a range-partitioned distributed sort)."""
    keys = ["tourney_date"] + [c for c in ("match_num", "contest_id") if c in df.columns]
    return df.orderBy(*keys)


def head(df: DataFrame, n: int = 10, cols: list[str] | None = None, order: list[str] | None = None) -> DataFrame:
    """SRT4: first n rows in a given order (top-n per task, then merged)."""
    out = select_known(df, cols)
    if order:
        out = df.orderBy(*order).select(*out.columns)
    return out.limit(n)


def shape(df: DataFrame) -> DataFrame:
    """AGG20: row count, column count and names (one row)."""
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows", F.lit(len(df.columns)).alias("columns"), F.lit(",".join(df.columns)).alias("column_names"))


def describe_estimated(df: DataFrame, accuracy: int = 10_000, distinct_error: float = 0.05) -> DataFrame:
    """AGG19 for wide tables, at the caller's choice: the columns of ``describe`` from one aggregate of mergeable
    sketches over one scan. Quartiles are values of the column whose rank is off by at most rows /
    ``accuracy``; ``unique`` has a relative standard deviation of ``distinct_error``; top and freq come from
    a sketch of 10,000 counters (exact up to 7,500 distinct texts). Everything else is exact. NaN is
    no quartile; without any number quartiles are NULL, without any text unique is 0 and top NULL."""
    num = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    txt = [f.name for f in df.schema.fields if isinstance(f.dataType, SIMPLE)]
    if not num and not txt:
        return df.sparkSession.createDataFrame([], DESCRIBED)
    plain = df.select(*[F.col(f"`{c}`").cast("double").alias(f"n{i}") for i, c in enumerate(num)],
                      *[F.col(f"`{c}`").cast("string").alias(f"t{i}") for i, c in enumerate(txt)])
    sums, rows = [], []

    def add(key: str, name: str, parts: dict) -> None:
        sums.extend(e.alias(f"{key}_{k}") for k, e in parts.items())
        rows.append(F.struct(F.lit(name).alias("column"), *[
            (F.col(f"{key}_{k}") if k in parts else F.lit(None)).cast(t).alias(k) for k, t in
            (("count", "long"), ("unique", "long"), ("top", "array<struct<item:string,count:bigint>>"), ("mean", "double"),
             ("std", "double"), ("min", "double"), ("q", "array<double>"), ("max", "double"))]))
    for i, c in enumerate(num):
        x = F.col(f"n{i}")
        add(f"n{i}", c, {"count": F.count(x), "mean": F.avg(x), "std": F.stddev_samp(x), "min": F.min(x), "max": F.max(x),
                         "q": F.percentile_approx(F.nanvl(x, F.lit(None)), list(QUARTILES), accuracy)})
    for i, c in enumerate(txt):
        x = F.col(f"t{i}")
        add(f"t{i}", c, {"count": F.count(x), "unique": F.approx_count_distinct(x, distinct_error),
                         "top": F.expr(f"approx_top_k(t{i}, 1, 10000) FILTER (WHERE t{i} IS NOT NULL)")})
    return plain.agg(*sums).select(F.inline(F.array(*rows))).select(
        "column", "count", "unique", F.get("top", F.lit(0))["item"].alias("top"),
        F.get("top", F.lit(0))["count"].alias("freq"), "mean", "std", "min",
        *[F.get("q", F.lit(i)).alias(f"{int(100 * x)}%") for i, x in enumerate(QUARTILES)], "max")


def describe(df: DataFrame) -> DataFrame:
    """AGG19: one row per column: count, unique, top, freq (strings,
    booleans, dates and timestamps, as text), mean,
    std (sample), min, 25%, 50%, 75% (exact, linear), max (numbers)."""
    from ..session import kept
    with kept(df) as d:  # three tables are written from it (SNK6)
        return _describe(d)


def _describe(df: DataFrame) -> DataFrame:
    num = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    txt = [f.name for f in df.schema.fields if isinstance(f.dataType, SIMPLE)]
    none = F.lit(None).cast("double")
    if not num and not txt:
        return df.sparkSession.createDataFrame([], DESCRIBED)
    sums, rows = [], []
    for i, c in enumerate([*num, *txt]):
        x = F.col(c).cast("double" if c in num else "string")
        parts = {"count": F.count(x)} | ({"mean": F.avg(x), "std": F.stddev_samp(x), "min": F.min(x), "max": F.max(x)}
                                         if c in num else {})
        sums += [e.alias(f"{i}_{k}") for k, e in parts.items()]
        rows.append(F.struct(F.lit(c).alias("column"), F.col(f"{i}_count").alias("count"), *[
            (F.col(f"{i}_{k}") if k in parts else none).alias(k) for k in ("mean", "std", "min", "max")],
            F.lit(i if c in num else None).cast("int").alias("c"), F.lit(None if c in num else i).cast("int").alias("t")))
    base = materialize(df.agg(*sums), "column-sums").select(F.inline(F.array(*rows)))
    words = F.array(*[F.struct(F.lit(i).alias("t"), F.col(c).cast("string").alias("v"))
                      for i, c in enumerate(txt, len(num))]) if txt else F.array().cast("array<struct<t:int,v:string>>")
    texts = df.select(F.inline(words)).where("v IS NOT NULL").groupBy("t", "v").agg(F.count(F.lit(1)).alias("n"))
    tops = materialize(texts.groupBy("t").agg(F.count(F.lit(1)).alias("unique"), F.max("n").alias("freq"),
                                              F.min_by("v", F.struct(-F.col("n"), "v")).alias("top")), "column-tops")
    quart = quantile_table(df, num, list(QUARTILES)) if num else df.sparkSession.createDataFrame([], "c int, q array<double>")
    return base.join(tops, "t", "left").join(quart, "c", "left").select(
        "column", "count", F.when(F.col("t").isNotNull(), F.coalesce("unique", F.lit(0))).alias("unique"), "top", "freq",
        "mean", "std", "min", *[F.col("q")[i].alias(f"{int(100 * x)}%") for i, x in enumerate(QUARTILES)], "max")
