"""The textbook form of the history features (one window per player), the yardstick of the chunked plan."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from duelspark.operators import history
from duelspark.operators.asof import peak_rank_asof
from duelspark.operators.history import UNB, appearances, with_pool
from duelspark.settings import SERVE_FIELDS

ORDER = ("tourney_date", "match_num", "contest_id")


def single_window(contests, rankings, s, fields=SERVE_FIELDS):
    app = appearances(with_pool(contests, s), s, fields)

    g = Window.partitionBy("player_id").orderBy(*ORDER)
    sw = Window.partitionBy("player_id", "surface").orderBy(*ORDER)
    dw = Window.partitionBy("player_id").orderBy("day")
    same_day = Window.partitionBy("player_id", "day").orderBy("match_num", "contest_id")
    cols = {k: e.over(g.rowsBetween(-n, -1)) for k, (e, n) in history._frames(s, fields).items()}
    cols["surface_form"] = F.avg("won").over(sw.rowsBetween(-s.surface_form_window, -1))
    cols["fatigue"] = (F.coalesce(F.sum("wt").over(dw.rangeBetween(-s.fatigue_days, -1)), F.lit(0.0))
                       + F.coalesce(F.sum("wt").over(same_day.rowsBetween(UNB, -1)), F.lit(0.0)))
    out = app.withColumns(cols)
    if rankings is not None:
        q = out.select("player_id", "tourney_date").distinct()
        peaks = peak_rank_asof(q, rankings, "tourney_date")
        out = out.join(peaks, ["player_id", "tourney_date"], "left")
    else:
        out = out.withColumn("peak_rank", F.lit(None).cast("int"))
    return out.select("contest_id", "side", "player_id", "surface", "global_form", "surface_form", "fatigue",
                      *[f"avg_{f}" for f in fields], "peak_rank")
