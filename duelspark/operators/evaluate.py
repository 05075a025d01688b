"""Evaluation of scored contests (reference stage 6 and the metric parts of 5).

AGG6-18, FLT7-8, CND3-5, BIN1-2, SRT3/6, ML12. Every table is an aggregate
over the predictions; nothing is collected.

Exact AUC at scale (AGG8/AGG17). A window over all distinct scores of a slice
would run in one task. Two levels instead: (a) per (slice, score) positive and
negative counts (partial aggregation), range-partitioned by slice and score and
written once; (b) a bucket is one range partition, so buckets hold about equally
many distinct scores however close together these lie, and bucket totals get a
prefix sum over at most one row per partition and slice; (c) within a bucket, a
prefix over its distinct scores. AUC = sum(pos * (2 * neg_below + neg)) / (2 * P * N), numerator summed
as an exact decimal. No window group is larger than one bucket of one slice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .frames import attach_row
from ..session import materialize
from ..functions.scalar import (calibration_bin, clip_prob, hard_label, is_upset, left_closed_bin,
                                loser_prob, right_closed_bin, right_closed_edges, year_of)

UNB = Window.unboundedPreceding


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _one_row_join(df: DataFrame, stats: DataFrame) -> DataFrame:
    return attach_row(df, stats)


def ranked_points(df: DataFrame, keys: list[str], y: str, p: str) -> DataFrame:
    """Distinct scores per key with pos, neg, and neg_below / pos_below (counts
    with a strictly lower score), two-level prefix; ``_b`` numbers the buckets.
    Rows without a score take no part."""
    pts = df.where(F.col(p).isNotNull()).groupBy(*keys, p).agg(F.sum(y).cast("long").alias("pos"),
                                   (F.count(F.lit(1)) - F.sum(y)).cast("long").alias("neg"))
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # written, because range bounds come from a sample: every reader must see the same buckets
    pts = materialize(pts.repartitionByRange(n, *keys, p).withColumn("_b", F.spark_partition_id()), "ranked-scores")
    bw = Window.partitionBy(*keys).orderBy("_b").rowsBetween(UNB, -1)
    bt = (pts.groupBy(*keys, "_b").agg(F.sum("neg").alias("_bneg"), F.sum("pos").alias("_bpos"))
          .withColumns({"_nb": F.coalesce(F.sum("_bneg").over(bw), F.lit(0)),
                        "_pb": F.coalesce(F.sum("_bpos").over(bw), F.lit(0))})
          .drop("_bneg", "_bpos"))
    within = Window.partitionBy(*keys, "_b").orderBy(p).rowsBetween(UNB, -1)
    return (pts.join(bt, [*keys, "_b"])
            .withColumns({
                "neg_below": (F.col("_nb") + F.coalesce(F.sum("neg").over(within), F.lit(0))).cast("long"),
                "pos_below": (F.col("_pb") + F.coalesce(F.sum("pos").over(within), F.lit(0))).cast("long")})
            .drop("_nb", "_pb"))


def auc_by(df: DataFrame, keys: list[str], y: str, p: str) -> DataFrame:
    """AGG8: exact ROC AUC with ties counted half, per key; NULL with one class."""
    pts = ranked_points(df, keys, y, p)
    num = (F.col("pos").cast("decimal(38,0)") * (F.col("neg_below") * 2 + F.col("neg")).cast("decimal(38,0)"))
    agg = pts.groupBy(*keys).agg(F.sum(num).alias("_num"), F.sum("pos").alias("_P"), F.sum("neg").alias("_N"))
    auc = F.col("_num").cast("double") / (F.lit(2.0) * F.col("_P").cast("double") * F.col("_N").cast("double"))
    return agg.select(*keys, F.when((F.col("_P") > 0) & (F.col("_N") > 0), auc).alias("auc_roc"))


def _log_loss_term(y: Column, p: Column) -> Column:
    return -(y * F.ln(p) + (F.lit(1) - y) * F.ln(F.lit(1.0) - p))


def metrics_by(pred: DataFrame, keys: list[str], y: str = "target", p: str = "prob",
               eps: float = 1e-6) -> DataFrame:
    """AGG6/7/9: n, accuracy, log-loss, AUC per key on clipped probabilities;
    log-loss and AUC NULL when the group holds one class."""
    base = pred.select(*keys, F.col(y).cast("int").alias("_y"), clip_prob(p, eps).alias("_p"))
    agg = base.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg((hard_label("_p") == F.col("_y")).cast("double")).alias("accuracy"),
        F.avg(_log_loss_term(F.col("_y"), F.col("_p"))).alias("_ll"),
        (F.min("_y") < F.max("_y")).alias("_two"))
    out = agg.join(auc_by(base, keys, "_y", "_p"), keys)
    return out.select(*keys, "n", "accuracy", F.when(F.col("_two"), F.col("_ll")).alias("log_loss"),
                      F.when(F.col("_two"), F.col("auc_roc")).alias("auc_roc"))


def slice_table(pred: DataFrame, by: str, prob: str, y: str = "target", eps: float = 1e-6) -> DataFrame:
    """AGG10: one metric row per value of ``by`` ("by=value") plus "overall";
    NULL values of ``by`` appear only in the overall row. Each row is sent to
    its slice and to the overall slice (explode), then one grouped pass."""
    label = F.when(F.col(by).isNotNull(), F.concat(F.lit(f"{by}="), F.col(by).cast("string")))
    x = (pred.select(F.explode(F.array(label, F.lit("overall"))).alias("slice"), y, prob)
         .where(F.col("slice").isNotNull()))
    return metrics_by(x, ["slice"], y, prob, eps)


def slice_tables(pred: DataFrame, by: list[str], prob: str, y: str = "target", eps: float = 1e-6) -> DataFrame:
    """AGG10 for several columns with one ranking of the scores: the rows of ``slice_table`` for every column
    of ``by``, named in ``by_col``. The overall slice is ranked once and repeated in the result."""
    def part(place: int, label: Column) -> Column:
        return F.struct(F.lit(place).alias("_place"), label.alias("slice"))

    parts = [part(i, F.concat(F.lit(f"{c}="), F.col(c).cast("string"))) for i, c in enumerate(by)]
    x = (pred.select(F.inline(F.array(part(-1, F.lit("overall")), *parts)), y, prob)
         .where(F.col("slice").isNotNull()))
    found = metrics_by(x, ["_place", "slice"], y, prob, eps)
    names = F.array(*[F.lit(c) for c in by])
    own = F.when(F.col("_place") < 0, names).otherwise(F.slice(names, F.greatest("_place", F.lit(0)) + 1, 1))
    return found.select(F.explode(own).alias("by_col"), "slice", "n", "accuracy", "log_loss", "auc_roc")


def model_metrics(pred: DataFrame, prob_cols: dict[str, str], keys: list[str], y: str = "target",
                  eps: float = 1e-6) -> DataFrame:
    """ML12: metrics of every model in one pass over an unpivoted table."""
    long = pred.unpivot([*keys, y], list(prob_cols.values()), "_col", "prob")
    names = F.create_map(*[F.lit(x) for kv in ((v, k) for k, v in prob_cols.items()) for x in kv])
    long = long.withColumn("model", F.element_at(names, F.col("_col"))).drop("_col")
    return metrics_by(long, ["model", *keys], y, "prob", eps)


def calibration(pred: DataFrame, prob: str, y: str = "target") -> DataFrame:
    """AGG11: 10 equal bins on [0, 1], right-closed; mean predicted and observed
    rate; empty bins absent."""
    return (pred.groupBy(calibration_bin(prob).alias("bin"))
            .agg(F.avg(F.col(y).cast("double")).alias("frac_pos"), F.avg(prob).alias("mean_pred"),
                 F.count(F.lit(1)).alias("n")))


def confusion(pred: DataFrame, prob: str, y: str = "target") -> DataFrame:
    """AGG12: 2x2 counts, rows = actual, columns = predicted label."""
    return (pred.withColumn("_yhat", hard_label(prob)).groupBy(F.col(y).alias("actual"))
            .pivot("_yhat", [0, 1]).count().na.fill(0)
            .withColumnsRenamed({"0": "pred_0", "1": "pred_1"}))


def accuracy_by(pred: DataFrame, key: Column | str, prob: str, y: str = "target", name: str | None = None,
                min_n: int = 0, with_auc: bool = False) -> DataFrame:
    """AGG13/AGG14 + FLT8: accuracy and n per group (raw probability, as the
    reference), optional AUC, groups under ``min_n`` dropped (HAVING)."""
    kname = name or str(key)
    base = pred.select(_c(key).alias(kname), F.col(y).cast("int").alias("_y"), F.col(prob).alias("_p"))
    agg = base.groupBy(kname).agg(F.avg((hard_label("_p") == F.col("_y")).cast("double")).alias("accuracy"),
                                  F.count(F.lit(1)).alias("n"))
    if with_auc:
        agg = agg.join(auc_by(base, [kname], "_y", "_p"), kname)
    return agg.where(F.col("n") >= min_n)


def accuracy_by_year(pred: DataFrame, prob: str, y: str = "target", min_n: int = 10) -> DataFrame:
    """AGG14: per calendar year of the int date; one-class years give NULL AUC."""
    return accuracy_by(pred, year_of("tourney_date"), prob, y, name="year", min_n=min_n, with_auc=True)


def binned_win_rate(pred: DataFrame, x: str, prob: str, y: str = "target", bins: int = 10,
                    min_n: int = 20) -> DataFrame:
    """AGG15 + BIN1: equal-width right-closed bins over the data range of ``x``;
    observed rate, mean predicted, n, bin mid; bins under ``min_n`` dropped.
    The range is a one-row aggregate attached as a scalar subquery (no collect, no join)."""
    base = pred.where(F.col(x).isNotNull())
    stats = base.agg(F.min(x).alias("_lo"), F.max(x).alias("_hi"))
    b = _one_row_join(base, stats).withColumn("bin", right_closed_bin(x, "_lo", "_hi", bins))
    agg = b.groupBy("bin", "_lo", "_hi").agg(F.avg(F.col(y).cast("double")).alias("actual_win_rate"),
                                             F.avg(prob).alias("mean_predicted"), F.count(F.lit(1)).alias("n"))
    left, right = right_closed_edges("_lo", "_hi", bins, "bin")
    return (agg.where(F.col("n") >= min_n)
            .select("bin", "actual_win_rate", "mean_predicted", "n", ((left + right) / 2).alias("bin_mid")))


def upsets(pred: DataFrame, prob: str, y: str = "target") -> DataFrame:
    """FLT7 + CND5: contests the favourite lost, with the loser's probability."""
    return pred.where(is_upset(y, prob)).withColumn("loser_prob", loser_prob(y, prob))


def upset_histogram(pred: DataFrame, prob: str, y: str = "target", bins: int = 30) -> DataFrame:
    """AGG16 + BIN2: counts of upset probabilities in equal bins over their range."""
    u = upsets(pred, prob, y).select("loser_prob")
    stats = u.agg(F.min("loser_prob").alias("_lo"), F.max("loser_prob").alias("_hi"))
    return (_one_row_join(u, stats).groupBy(left_closed_bin("loser_prob", "_lo", "_hi", bins).alias("bin"))
            .agg(F.count(F.lit(1)).alias("n")))


def top_upsets(pred: DataFrame, prob: str, k: int = 20, y: str = "target", key: str = "contest_id") -> DataFrame:
    """SRT6: the k most surprising results (top-k report; TakeOrderedAndProject
    keeps k rows per task, so no global sort)."""
    return upsets(pred, prob, y).orderBy(F.col("loser_prob").desc(), F.col(key)).limit(k)


def roc_points(pred: DataFrame, prob_cols: dict[str, str], y: str = "target") -> DataFrame:
    """AGG17: ROC curve points per model (sklearn ``roc_curve`` semantics:
    distinct thresholds in descending order, collinear points dropped, an
    initial (0, 0) point at threshold +inf). All models in one pass."""
    long = pred.unpivot([y], list(prob_cols.values()), "_col", "p")
    names = F.create_map(*[F.lit(x) for kv in ((v, k) for k, v in prob_cols.items()) for x in kv])
    long = long.select(F.element_at(names, F.col("_col")).alias("model"), F.col(y).cast("int").alias("_y"), "p")
    pts = ranked_points(long, ["model"], "_y", "p")
    tot = pts.groupBy("model").agg(F.sum("pos").alias("_P"), F.sum("neg").alias("_N"))
    # descending thresholds: tps / fps = counts at or above the threshold
    pts = (pts.join(tot, "model")
           .withColumns({"tps": F.col("_P") - F.col("pos_below"), "fps": F.col("_N") - F.col("neg_below")}))
    # the next lower distinct threshold's increment decides collinearity
    nxt = _next_lower(pts)
    keep = (F.col("_next_pos").isNull() | F.col("_is_top")
            | (F.col("_next_pos") != F.col("pos")) | (F.col("_next_neg") != F.col("neg")))
    curve = nxt.where(keep).select(
        "model", F.when(F.col("_N") > 0, F.col("fps") / F.col("_N")).alias("fpr"),
        F.when(F.col("_P") > 0, F.col("tps") / F.col("_P")).alias("tpr"),
        F.col("p").alias("threshold"))
    origin = tot.select("model", F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"),
                        F.lit(float("inf")).alias("threshold"))
    return curve.unionByName(origin)


def _next_lower(pts: DataFrame) -> DataFrame:
    """For each distinct threshold: pos/neg of the next lower threshold and
    whether it is the highest one, without a window over all thresholds."""
    w = Window.partitionBy("model", "_b").orderBy(F.col("p").desc())
    pts = pts.withColumns({"_np": F.lead("pos").over(w), "_nn": F.lead("neg").over(w),
                           "_rk": F.row_number().over(w)})
    # per bucket: its highest point (for the bucket above) and whether a higher bucket exists
    heads = (pts.where(F.col("_rk") == 1)
             .select("model", "_b", F.col("pos").alias("_hp"), F.col("neg").alias("_hn")))
    bw = Window.partitionBy("model").orderBy("_b")
    heads = heads.withColumns({"_lp": F.lag("_hp").over(bw), "_ln": F.lag("_hn").over(bw),
                               "_top": F.lead("_b").over(bw).isNull()})
    pts = pts.join(heads.select("model", "_b", "_lp", "_ln", "_top"), ["model", "_b"])
    return pts.withColumns({
        "_next_pos": F.coalesce(F.col("_np"), F.col("_lp")),
        "_next_neg": F.coalesce(F.col("_nn"), F.col("_ln")),
        "_is_top": F.col("_top") & (F.col("_rk") == 1),
    })
