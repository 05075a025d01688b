"""Pre-match history features (WIN1-WIN5, ARR2, JOIN3 fused).

Everything a player knew *before* a contest: last-N form overall and per
surface, weighted workload over the previous days, last-N means of the serve
ratios and the best ranking so far. Time order is (tourney_date, match_num,
contest_id); frames always exclude the current contest.

Scale design, the same at every size. A plain
``Window.partitionBy(player)`` sends one player's whole career to one task;
if one player holds a third of all rows, that task holds a third of the data.
Here no group grows with a player's row count:

1. spans: per (player, span of ``SPAN_DAYS`` days), the in-span row number, overall
   and per surface; span sizes are aggregated (map-side partial aggregation), a
   window over the *span* table (one narrow row per player and span) gives each
   span its offsets;
2. the fatigue RANGE frame and the as-of best ranking ride on the same exchange:
   the last days of a span are copied into the next one, ranking rows are unioned
   in, and the span table carries the best ranking before a span;
3. the ROWS frames run per (player, chunk of ``history_chunk_rows``
   positions), the last N rows of the previous chunk are copied in as a halo
   (``explode`` of a one-or-two element array, no union, no second scan).

So a full row is moved three times for all features. The finest group left is one
player's contests in one span: bounded by how many contests a player can play in
that many days, not by the size of the data.

Only what the wanted features need is built. The span table comes from a narrow
projection of the appearances, not from the rows of an earlier step, so that no
step runs twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import epoch_day, in_domain_or
from ..session import materialize
from ..settings import SERVE_FIELDS, Settings
from .asof import clean_rankings

UNB = Window.unboundedPreceding
SPAN_DAYS = 64  # days of one span, unless the fatigue frame needs longer ones


def with_pool(contests: DataFrame, s: Settings) -> DataFrame:
    """NUL3: surface outside the known domain (or NULL) -> default; the column is overwritten.
    PRJ10: an absent contest number reads as NULL (order: date, then contest id)."""
    if "match_num" not in contests.columns:
        contests = contests.withColumn("match_num", F.lit(None).cast("long"))
    return contests.withColumn("surface", in_domain_or("surface", s.surfaces, s.default_surface))


def _ratio(contests: DataFrame, name: str) -> Column:
    # PRJ10: an absent optional column reads as NULL
    return F.col(name).cast("double") if name in contests.columns else F.lit(None).cast("double")


def appearances(contests: DataFrame, s: Settings, fields=SERVE_FIELDS, carry: tuple[str, ...] = ()) -> DataFrame:
    """ARR2: one row per (contest, player), one pass (inline of a two-element array).

    Expects ``with_pool`` applied. Columns: contest context, side (w/l),
    player_id, won (1.0/0.0), wt (workload weight), day (epoch day), ratios, and the ``carry`` columns."""

    def side(tag: str, full: str, won: float) -> Column:
        return F.struct(
            F.lit(tag).alias("side"),
            F.col(f"{full}_id").cast("long").alias("player_id"),
            F.lit(won).alias("won"),
            *[_ratio(contests, f"{tag}_{f}").alias(f) for f in fields],
        )

    heavy = F.when(F.col("tourney_level") == s.heavy_level, F.lit(s.heavy_weight)).otherwise(F.lit(1.0))
    return (contests.select("contest_id", "tourney_date", "match_num", "surface", *carry,
                            heavy.alias("wt"), epoch_day("tourney_date").alias("day"),
                            F.inline(F.array(side("w", "winner", 1.0), side("l", "loser", 0.0))))
            .where(F.col("player_id").isNotNull() & F.col("day").isNotNull()))


def ranking_days(rankings: DataFrame) -> DataFrame:
    """(player_id, day, rank): incomplete rows dropped (FLT4), min rank per day."""
    return (clean_rankings(rankings).select("player_id", epoch_day("ranking_date").alias("day"), "rank")
            .groupBy("player_id", "day").agg(F.min("rank").alias("rank")))


def _with_positions(df: DataFrame, keys: list[str], pos: str | None, *, surfaces=(), fatigue_days: int | None = None,
                    side_rows: DataFrame | None = None) -> DataFrame:
    """0-based position (column ``pos``, if named) of each row in its key's time order, two-level: its place
    in a span of days, plus the rows of the earlier spans. One exchange of the rows, by key and span.

    ``surfaces``: the surface domain; adds ``_spos``, the position among the rows of the same surface.
    ``fatigue_days``: adds ``fatigue``; the last days of a span are copied into the next one.
    ``side_rows`` (day, rank rows): adds ``peak_rank``; they share the exchange and are dropped after it."""
    days = max(SPAN_DAYS, 4 * (fatigue_days or 0))
    span = F.floor(F.col("day") / days)
    rows = df.withColumn("_span", span)
    ranks = None if side_rows is None else side_rows.withColumn("_span", span)
    x = rows.withColumn("_copy", F.lit(0))
    if fatigue_days:
        late = F.pmod(F.col("day"), F.lit(days)) >= days - fatigue_days
        x = rows.withColumn("_copy", F.explode(F.when(late, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))) \
            .withColumn("_span", F.col("_span") + F.col("_copy"))
        needed = {*keys, "_span", "_copy", "day", "wt"}  # of a copied row
        x = x.withColumns({c: F.when(F.col("_copy") == 0, F.col(c)) for c in x.columns if c not in needed})
    if ranks is not None:
        x = x.unionByName(ranks.withColumn("_copy", F.lit(2)), allowMissingColumns=True)
    own = F.count(F.when(F.col("_copy") == 0, 1))
    in_span = Window.partitionBy(*keys, "_span")
    in_day = Window.partitionBy(*keys, "_span", "day").orderBy("match_num", "contest_id").rowsBetween(UNB, -1)
    time = ("day", "match_num", "contest_id")
    cols = {}
    if pos:
        cols["_li"] = own.over(in_span.orderBy(*time).rowsBetween(UNB, -1))
    if surfaces:
        cols["_si"] = own.over(Window.partitionBy(*keys, "_span", "surface").orderBy(*time).rowsBetween(UNB, -1))
    if fatigue_days is not None:  # day-level frame, plus the earlier contests of the day
        cols["fatigue"] = (F.coalesce(F.sum("wt").over(in_span.orderBy("day").rangeBetween(-fatigue_days, -1)), F.lit(0.0))
                           + F.coalesce(F.sum("wt").over(in_day), F.lit(0.0)))
    if ranks is not None:  # as-of best rank, within the span
        cols["_best"] = F.min("rank").over(in_span.orderBy("day").rangeBetween(UNB, 0))
    out = x.repartition(*keys, "_span").withColumns(cols).where(F.col("_copy") == 0).drop("_copy", "rank")
    if not (pos or surfaces or ranks is not None):
        return out.drop("_span")
    spans = rows.groupBy(*keys, "_span").agg(
        F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col("surface") == v).alias(f"_n{i}") for i, v in enumerate(surfaces)])
    earlier = Window.partitionBy(*keys).orderBy("_span").rangeBetween(UNB, -1)
    before = {"_b0": F.coalesce(F.sum("_n").over(earlier), F.lit(0))}
    before.update({f"_s{i}": F.coalesce(F.sum(f"_n{i}").over(earlier), F.lit(0)) for i in range(len(surfaces))})
    if ranks is not None:
        spans = spans.unionByName(ranks.groupBy(*keys, "_span").agg(F.min("rank").alias("_rank")), allowMissingColumns=True)
        before["_best0"] = F.min("_rank").over(earlier)
    spans = spans.withColumns(before).where(F.col("_n").isNotNull()).select(*keys, "_span", *before)
    out = out.join(spans, [*keys, "_span"])
    found = {pos: (F.col("_b0") + F.col("_li")).cast("long")} if pos else {}
    if surfaces:
        on_surface = F.coalesce(*[F.when(F.col("surface") == v, F.col(f"_s{i}")) for i, v in enumerate(surfaces)])
        found["_spos"] = on_surface + F.col("_si")
    if ranks is not None:
        found["peak_rank"] = F.least("_best", "_best0")
    return out.withColumns(found).drop("_span", *cols.keys() - {"fatigue"}, *before)


def _halo_frames(df: DataFrame, keys: list[str], pos: str, chunk_rows: int,
                 frames: dict[str, tuple[Column, int]]) -> DataFrame:
    """ROWS frames ``n preceding .. 1 preceding`` per key, evaluated per chunk of
    ``chunk_rows`` positions; the last n rows of a chunk are also sent to the
    next chunk (halo) and dropped after the window. Group size <= chunk + n."""
    halo = max(n for _, n in frames.values())
    if chunk_rows < halo:
        raise ValueError("history_chunk_rows must be >= the longest frame")
    copies = F.when(F.col(pos) % chunk_rows >= chunk_rows - halo,
                    F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    x = (df.withColumn("_copy", F.explode(copies))
         .withColumn("_chunk", F.floor(F.col(pos) / chunk_rows) + F.col("_copy")))
    w = Window.partitionBy(*keys, "_chunk").orderBy(pos)
    return (x.withColumns({k: e.over(w.rowsBetween(-n, -1)) for k, (e, n) in frames.items()})
            .where(F.col("_copy") == 0).drop("_copy", "_chunk"))


def _frames(s: Settings, fields) -> dict[str, tuple[Column, int]]:
    fr = {"global_form": (F.avg("won"), s.global_form_window)}
    fr.update({f"avg_{f}": (F.avg(f), s.serve_window) for f in fields})
    return fr


def feature_names(fields=SERVE_FIELDS) -> list[str]:
    return ["global_form", "surface_form", "fatigue", *[f"avg_{f}" for f in fields], "peak_rank"]


def history_features(contests: DataFrame, rankings: DataFrame | None, s: Settings, fields=SERVE_FIELDS,
                     wanted: list[str] | None = None, carry: tuple[str, ...] = (), boundary: bool = False) -> DataFrame:
    """Per (contest, side): player_id, surface (pooled) and the ``wanted`` features, by default all of
    global_form, surface_form, fatigue, avg_<ratio>..., peak_rank, and the contests' ``carry`` columns. Input: contests
    (any source, all levels). ``boundary``: the rows are written once between the moves, so that the disk
    holds the shuffle of one of them at a time."""
    def step(df: DataFrame) -> DataFrame:
        return materialize(df, "history") if boundary else df

    names = feature_names(fields)
    wanted = names if wanted is None else [c for c in names if c in wanted]
    frames = {k: v for k, v in _frames(s, fields).items() if k in wanted}
    surfaces = list(dict.fromkeys([*s.surfaces, s.default_surface])) if "surface_form" in wanted else []
    ranks = ranking_days(rankings) if "peak_rank" in wanted and rankings is not None else None
    rows = appearances(with_pool(contests, s), s, fields, carry).drop("tourney_date")  # the day says the same
    app = _with_positions(rows, ["player_id"], "_gpos" if frames else None,
                          surfaces=surfaces, fatigue_days=s.fatigue_days if "fatigue" in wanted else None, side_rows=ranks)
    if "peak_rank" in wanted and rankings is None:
        app = app.withColumn("peak_rank", F.lit(None).cast("int"))
    kept = [c for c in app.columns if c not in ("wt", "day", "match_num")]
    if surfaces:  # sequence per (player, surface)
        app = _halo_frames(step(app.select(*kept)), ["player_id", "surface"], "_spos", s.history_chunk_rows,
                           {"surface_form": (F.avg("won"), s.surface_form_window)})
        kept = [c for c in app.columns if c not in ("wt", "day", "match_num", "_spos")]
    if frames:  # sequence per player
        app = _halo_frames(step(app.select(*kept)), ["player_id"], "_gpos", s.history_chunk_rows, frames)
    return app.select("contest_id", "side", "player_id", "surface", *wanted, *carry)
