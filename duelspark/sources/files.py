"""File sources and sinks (SRC1-SRC6, SNK1-SNK6).

CSV reading without inference: with an explicit schema Spark's CSV reader
binds columns *by position* and ignores the header, so a file whose columns
come in another order is read wrongly without any error. Instead every file is
read as strings with ``header=True``, grouped by its header line (one scan per
distinct header, not one per file), each group is projected *by name* with
``try_cast`` to the declared type (malformed -> NULL; a known column missing
from a file -> typed NULL; unknown columns stay strings), and the groups are
unioned by name. ``common_only=True`` keeps only the columns present in every
file (the reference's intersection).
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from ..functions.scalar import nan_to_null
from ..operators.clean import union_all

log = logging.getLogger(__name__)

# Declared types of the contest table, matched by header name.
_INT = "int"
_LONG = "long"
_DBL = "double"
_STR = "string"
MATCH_TYPES: dict[str, str] = {
    "tourney_id": _STR, "tourney_name": _STR, "surface": _STR, "draw_size": _INT, "tourney_level": _STR,
    "tourney_date": _INT, "match_num": _LONG,
    "winner_id": _LONG, "winner_seed": _STR, "winner_entry": _STR, "winner_name": _STR, "winner_hand": _STR,
    "winner_ht": _DBL, "winner_ioc": _STR, "winner_age": _DBL,
    "loser_id": _LONG, "loser_seed": _STR, "loser_entry": _STR, "loser_name": _STR, "loser_hand": _STR,
    "loser_ht": _DBL, "loser_ioc": _STR, "loser_age": _DBL,
    "score": _STR, "best_of": _INT, "round": _STR, "minutes": _INT,
    **{f"{s}_{c}": _INT for s in ("w", "l")
       for c in ("ace", "df", "svpt", "1stIn", "1stWon", "2ndWon", "SvGms", "bpSaved", "bpFaced")},
    "winner_rank": _INT, "winner_rank_points": _INT, "loser_rank": _INT, "loser_rank_points": _INT,
}
RANKING_TYPES: dict[str, str] = {"ranking_date": _INT, "rank": _INT, "player": _LONG, "points": _INT}


def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def existing(spark: SparkSession, paths: list[str]) -> list[str]:
    """Paths that exist (any Hadoop file system); absent ones are logged and skipped."""
    out = []
    for path in paths:
        p, fs = _fs_path(spark, path)
        if fs.exists(p):
            out.append(path)
        else:
            log.warning("missing %s", path)
    return out


def header_line(spark: SparkSession, path: str) -> str:
    """First line of a file (metadata-sized read through the Hadoop FS)."""
    p, fs = _fs_path(spark, path)
    jvm = spark.sparkContext._jvm
    stream = fs.open(p)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        line = reader.readLine()
        return (line or "").lstrip("﻿").strip()
    finally:
        stream.close()


def typed(text: F.Column, kind: str) -> F.Column:
    """A text field as its declared type, NULL if it is malformed. Integers may be written with a
    decimal part of zeros (``7.0``, as exports of columns with gaps do), any other decimal part is
    malformed, however small; NaN is missing."""
    if kind in (_INT, _LONG):
        exact = text.try_cast("decimal(38,18)")
        whole = (exact == F.floor(exact)) & (text.rlike("[eE]") | ~text.rlike(r"\.\d*[1-9]"))
        return F.coalesce(text.try_cast(kind), F.when(whole, exact.try_cast(kind)))
    return nan_to_null(text.try_cast(kind)) if kind == "double" else text.try_cast(kind)


def yearly_paths(directory: str, pattern: str, years) -> list[str]:
    """SRC2 helper: ``pattern`` formatted with each year, e.g. "m_{year}.csv"."""
    return [f"{directory.rstrip('/')}/{pattern.format(year=y)}" for y in years]


def read_typed_csv(spark: SparkSession, paths: list[str], types: dict[str, str],
                   tag: tuple[str, str] | None = None, common_only: bool = False) -> DataFrame | None:
    """SRC1: read CSVs as strings, one scan per distinct header line, project by
    name with declared types. Missing files are skipped; none left -> None."""
    paths = existing(spark, paths)
    if not paths:
        return None
    groups: dict[str, list[str]] = {}
    for p in paths:
        groups.setdefault(header_line(spark, p), []).append(p)
    parts = []
    for _, group in sorted(groups.items()):
        raw = (spark.read.option("header", True).option("mode", "PERMISSIVE")
               .option("inferSchema", False).csv(group))
        cols = []
        for c in raw.columns:
            t = types.get(c)
            cols.append(typed(F.col(f"`{c}`"), t).alias(c) if t and t != _STR else F.col(f"`{c}`"))
        parts.append(raw.select(*cols))
    df = union_all(parts, common_only=common_only)
    if tag is not None:
        df = df.withColumn(tag[0], F.lit(tag[1]))
    return df


def with_declared(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """PRJ10: add each declared column absent from ``df`` as a typed NULL."""
    missing = {c: F.lit(None).cast(t) for c, t in types.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df


def contest_key(df: DataFrame) -> DataFrame:
    """H1: a stable contest id for CSV input (total-order tie breaker): 128 bits from two hashes of
    family, tournament id, date, number, winner and loser, and the contest's ordinal among those
    that agree in all of them, so that repeated rows stay contests of their own."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(""))
             for c in ("match_source", "tourney_id", "tourney_date", "match_num", "winner_id", "loser_id")
             if c in df.columns]
    key = F.concat(*[F.lower(F.lpad(F.hex(F.xxhash64(*parts, F.lit(i))), 16, "0")) for i in (0, 1)])
    among_equals = Window.partitionBy("contest_id").orderBy(F.xxhash64(*df.columns))
    ordinal = F.row_number().over(among_equals)
    return df.withColumn("contest_id", key) \
        .withColumn("contest_id", F.concat_ws("-", "contest_id", ordinal.cast("string")))


def read_contests(spark: SparkSession, family_paths: dict[str, list[str]], common_only: bool = False,
                  source_col: str = "match_source") -> DataFrame | None:
    """SRC2 + PRJ1 + SET1: all families (e.g. main draw, qualifying), each
    tagged with its family name, unioned by name; absent files skipped."""
    parts = [d for fam, ps in family_paths.items()
             if (d := read_typed_csv(spark, ps, MATCH_TYPES, (source_col, fam), common_only)) is not None]
    if not parts:
        return None
    df = union_all(parts, common_only=common_only)
    if not common_only:
        df = with_declared(df, MATCH_TYPES)
    return contest_key(df)


def read_rankings(spark: SparkSession, paths: list[str]) -> DataFrame | None:
    """SRC3: ranking history; ``player`` renamed ``player_id`` (PRJ3)."""
    df = read_typed_csv(spark, paths, RANKING_TYPES)
    return None if df is None else df.withColumnsRenamed({"player": "player_id"})


def read_players(spark: SparkSession, path: str) -> DataFrame | None:
    """SRC4: player metadata, passed through as read (strings)."""
    return read_typed_csv(spark, [path], {})


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """SRC5: one file or a directory of part files (partition columns discovered)."""
    return spark.read.parquet(path)


def read_document(spark: SparkSession, path: str) -> DataFrame:
    """SRC6: a JSON document (e.g. the model description) as a one-row DataFrame."""
    return spark.read.json(path, multiLine=True)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite") -> None:
    """SNK1: Parquet, partitioned (e.g. by season) so later date filters prune
    files; never funnelled through one task."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def with_season(df: DataFrame) -> DataFrame:
    return df.withColumn("season", F.floor(F.col("tourney_date") / 10000).cast("int"))


def write_small_csv(df: DataFrame, path: str) -> None:
    """SNK2: a metric table (tens of rows by construction) as one CSV file; tables that grow with the
    data (ROC points) go to ``write_csv``."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    """SNK2 for a table of any size: one CSV part per task."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_document(df: DataFrame, path: str) -> None:
    """SNK3/SNK4: a one-row (nested) DataFrame as a JSON document."""
    df.coalesce(1).write.mode("overwrite").json(path)


def keep(df: DataFrame) -> DataFrame:
    """SNK6: keep a table across several actions (spills to disk, never lost
    silently: recomputed from lineage if an executor goes)."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)
