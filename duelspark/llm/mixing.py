"""Mixing sources to target weights by entropy balancing.

A document's size is its number of words. The mix wants ``target`` words of every source: the
sources, in code point order with null last, weigh ``weights`` in turn and share the words of all
documents; no target exceeds ``most`` times its source's words, and what is cut off is shared
again by weight among the others until none is above.

The document rates are those of least relative entropy to "every document once" that meet the
token constraint of every source and the bound: rate = min(most, exp(dual * size / scale)), with
one dual variable per source (scale: the source's words per document). The dual is convex; its
gradient is the source's words under the current rates minus its target. Newton steps on it run
as distributed aggregations over the counts per (source, size), which hold all that the rates
depend on; a step that leaves the bracket known to hold the root is replaced by its middle.
The first bracket holds every root: at its ends even a document of one word has the rate exp(-60) or
``most``. Iterations go on until every source is within ``tolerance`` of its target; a source that is
not after ``rounds`` of them is an error.

Rounding to copies: every document is taken floor(rate) times, and once more if it is among those
with the least u / fraction (u: a uniform number from the hash of its id), up to the source's
missing words (sequential Poisson sampling). The cutting value is found by counting words per
value range, three times 1,024 ranges, and then row by row among the few documents of the last
range, so no window ever holds a source. Reruns give the same copies.

Edge cases: null text has size 0, and documents of size 0 are taken once; a source without words
has target 0; null is a source like any other; repeated rows (same id) share u and are cut one by
one in the last range; an empty table gives an empty result; extra columns are kept whatever their
names; ``mix`` replaces columns with the names of those it adds, ``take`` returns the columns it got.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD, materialize, numbered

RANGES = 1024
ROUNDS = 3
ADDED = ("size", "source_size", "target", "rate", "copies", "taken")


@dataclass(frozen=True)
class Params:
    weights: tuple[float, ...] = (1.0, 2.0, 3.0)
    most: int = 3
    tolerance: float = 1e-6
    rounds: int = 200
    seed: int = 7


def targets(sources: DataFrame, p: Params) -> DataFrame:
    """(source, source_size, scale, target) from (source, source_size, n): one row per source. Capping
    is solved in closed form per row order: sources reach their cap in the order of size / weight, so
    with prefix sums over that order the last uncapped share decides who is capped."""
    everyone = Window.partitionBy(F.lit(1))  # one row per source
    number = F.row_number().over(everyone.orderBy(F.col("source").isNull(), F.col("source")))
    weights = F.array(*[F.lit(float(w)) for w in p.weights])
    rows = sources.withColumn("_w", F.element_at(weights, F.pmod(number - 1, F.lit(len(p.weights))).cast("int") + 1)) \
        .withColumn("_cap", p.most * F.col("source_size").cast("double"))
    by_level = everyone.orderBy(F.col("_cap") / F.col("_w"), F.col("source").isNull(), F.col("source"))
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_room", F.sum("source_size").over(everyone)
                           - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) \
        .withColumn("_rest", F.sum("_w").over(everyone) - F.coalesce(F.sum("_w").over(before), F.lit(0.0)))
    # a source is capped if, with all earlier ones capped, its share of what is left is still too much
    level = F.col("_room") / F.col("_rest")
    free = F.when(level * F.col("_w") <= F.col("_cap"), F.struct(F.col("_rest") * -1, level))
    rows = rows.withColumn("_level", F.min(free).over(everyone)["col2"])  # of the first source that is not capped
    return rows.select("source", "source_size",
                       F.greatest(F.lit(1.0), F.col("source_size") / F.col("n")).alias("scale"),
                       F.least(F.col("_cap"), F.coalesce(F.col("_level") * F.col("_w"), F.col("_cap"))).alias("target"))


def rate(dual: Column, size: Column, scale: Column, most: int) -> Column:
    """The tilted rate; a null dual marks a source whose documents all sit at the bound."""
    return F.when(size == 0, F.lit(1.0)).when(dual.isNull(), F.lit(float(most))) \
        .otherwise(F.least(F.lit(float(most)), F.exp(F.least(F.lit(50.0), dual * size / scale))))


def solve(cells: DataFrame, goals: DataFrame, p: Params) -> DataFrame:
    """``goals`` plus the dual of every source. ``cells``: counts per (source, size)."""
    full = F.col("target") >= p.most * F.col("source_size") * (1 - 1e-12)
    state = materialize(goals.select("*", F.when(~full, F.lit(0.0)).alias("dual"),
                                     (-60 * F.col("scale")).alias("lo"), (60 * F.col("scale")).alias("hi"), full.alias("done")), "dual")
    for _ in range(p.rounds):
        words = F.col("c.n") * F.col("c.size")
        x = F.col("c.size") / F.col("s.scale")
        r = rate(F.col("s.dual"), F.col("c.size"), F.col("s.scale"), p.most)
        now = cells.alias("c").join(state.where("not done").alias("s"), F.col("c.source").eqNullSafe(F.col("s.source"))) \
            .groupBy(F.col("s.source").alias("source")) \
            .agg(F.sum(words * r).alias("words"), F.sum(F.when(r < p.most, words * r * x).otherwise(0.0)).alias("slope"))
        gap = F.col("words") - F.col("target")
        lo = F.when(gap < 0, F.col("dual")).otherwise(F.col("lo"))
        hi = F.when(gap > 0, F.col("dual")).otherwise(F.col("hi"))
        newton = F.col("dual") - gap / F.nullif(F.col("slope"), F.lit(0.0))
        near = F.abs(gap) <= p.tolerance * F.greatest(F.col("target"), F.lit(1.0))
        step = F.when(near, F.col("dual")).when((newton > lo) & (newton < hi), newton).otherwise((lo + hi) / 2)
        moved = state.alias("s").join(now.alias("w"), F.col("s.source").eqNullSafe(F.col("w.source")), "left") \
            .select("s.*", "w.words", "w.slope")
        todo = F.col("words").isNotNull()
        state = materialize(moved.select(
            "source", "source_size", "scale", "target",
            F.when(todo, step).otherwise(F.col("dual")).alias("dual"), F.when(todo, lo).otherwise(F.col("lo")).alias("lo"),
            F.when(todo, hi).otherwise(F.col("hi")).alias("hi"), (~todo | near).alias("done")), "dual")
        if state.where("not done").isEmpty():
            return state.select("source", "source_size", "scale", "target", "dual")
    raise RuntimeError(f"sources off their targets after {p.rounds} rounds: {state.where('not done').count()}")


def same(left: str, right: str = "source") -> Column:
    return F.col(left).eqNullSafe(F.col(right))


def cut(fractions: DataFrame, missing: DataFrame) -> DataFrame:
    """The cutting place of every source: (source, v, key), the last document taken once more.
    ``fractions``: (source, size, v, key) with v in [0, 1); ``missing``: (source, words)."""
    rows, need, width = fractions, missing.select("source", "words", F.lit(0.0).alias("from")), 1.0
    for _ in range(ROUNDS):
        width /= RANGES
        number = F.floor((F.col("v") - F.col("from")) / F.lit(width))
        inside = rows.alias("r").join(need.alias("m"), same("r.source", "m.source")) \
            .where((F.col("v") >= F.col("from")) & (F.col("v") < F.col("from") + width * RANGES)) \
            .select("r.*", "words", "from", number.alias("range"))
        sums = inside.groupBy("source", "words", "from", "range").agg(F.sum("size").alias("size"))
        upto = Window.partitionBy("source").orderBy("range")
        crossing = sums.withColumn("total", F.sum("size").over(upto)) \
            .where((F.col("total") >= F.col("words")) & (F.col("total") - F.col("size") < F.col("words")))
        need = materialize(crossing.select("source", (F.col("words") - F.col("total") + F.col("size")).alias("words"),
                                           (F.col("from") + F.col("range") * width).alias("from")), "cut")
    last = rows.alias("r").join(need.alias("m"), same("r.source", "m.source")) \
        .where((F.col("v") >= F.col("from")) & (F.col("v") < F.col("from") + width)).select("r.*", "words")
    order = Window.partitionBy("source").orderBy("v", "key")
    ends = last.withColumn("total", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))) \
        .where(F.col("total") - F.col("size") < F.col("words"))
    # the crossing document comes along only if that brings the sum nearer
    nearer = F.col("total") - F.col("words") <= F.col("words") - (F.col("total") - F.col("size"))
    return ends.groupBy("source").agg(
        F.max(F.struct("v", "key", nearer.alias("with"), (F.col("total") >= F.col("words")).alias("over"))).alias("e")) \
        .select("source", "e.v", "e.key", (~F.col("e.over") | F.col("e.with")).alias("with"))


def mix(docs: DataFrame, p: Params = Params(), text: str = "text", source: str = "source",
        doc_id: str = "doc_id") -> DataFrame:
    """``docs`` plus size, source_size, target, rate, copies and taken (= size * copies)."""
    names = docs.drop(*ADDED).columns
    kept, (text, source, doc_id) = numbered(docs.drop(*ADDED), text, source, doc_id)
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    unit = (F.pmod(F.xxhash64(F.col(doc_id), F.lit(p.seed)), F.lit(1 << 52)) + 1) / float((1 << 52) + 1)
    key = F.xxhash64(F.col(doc_id), F.lit(p.seed + 1))
    narrow = materialize(kept.select(F.col(source).alias("source"), size.alias("size"), unit.alias("u"),
                                     key.alias("key")), "mix-sizes")
    cells = materialize(narrow.groupBy("source", "size").agg(F.count("*").alias("n")), "mix-cells")
    totals = cells.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"), F.sum("n").alias("n"))
    duals = materialize(solve(cells, targets(totals, p), p), "mix-duals")

    def rates(rows: DataFrame, size_of: Column) -> DataFrame:
        r = rate(F.col("_dual"), size_of, F.col("_scale"), p.most)
        return rows.withColumn("rate", r).withColumn("_whole", F.floor("rate")) \
            .withColumn("_fraction", F.col("rate") - F.col("_whole"))

    def value(u: Column) -> Column:  # u / fraction, mapped to [0, 1) in the same order
        ratio = F.try_divide(u, F.col("_fraction"))
        return ratio / (1 + ratio)

    d = duals.select(F.col("source").alias("_source"), "source_size", "target", F.col("scale").alias("_scale"),
                     F.col("dual").alias("_dual"))
    by_cell = rates(cells.join(d, same("source", "_source")), F.col("size"))
    missing = by_cell.groupBy("source").agg(
        (F.first("target") - F.sum(F.col("n") * F.col("size") * F.col("_whole"))).alias("words")).where("words > 0")
    open_ = rates(narrow.join(d, same("source", "_source")), F.col("size")).where("_fraction > 0 and size > 0") \
        .select("source", "size", value(F.col("u")).alias("v"), "key")
    ends = materialize(cut(open_, materialize(missing, "mix-missing")), "mix-ends") \
        .select(F.col("source").alias("_end"), F.col("v").alias("_v"), F.col("key").alias("_key"), "with")
    out = rates(kept.withColumn("size", size).join(d, same(source, "_source")), F.col("size")) \
        .join(ends, same("_source", "_end"), "left")
    v = value(unit)
    more = (F.col("_fraction") > 0) & (F.col("size") > 0) & (
        (v < F.col("_v")) | (v == F.col("_v")) & ((key < F.col("_key")) | (key == F.col("_key")) & F.col("with")))
    return out.withColumn("copies", (F.col("_whole") + F.when(more, 1).otherwise(0)).cast("int")) \
        .select(*[F.col(c).alias(name) for c, name in zip(kept.columns, names)], "size", "source_size", "target", "rate", "copies",
                (F.col("size") * F.col("copies")).alias("taken"))


def take(docs: DataFrame, p: Params = Params(), text: str = "text", source: str = "source",
         doc_id: str = "doc_id") -> DataFrame:
    """The mix itself: every document as often as its copies say, with the columns of ``docs``."""
    plain, places = numbered(docs, text, source, doc_id)
    mixed = mix(plain, p, *places).where("copies > 0")
    repeat = F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")
    return mixed.select(*plain.columns, repeat).drop("copy").toDF(*docs.columns)
