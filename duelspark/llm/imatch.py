"""Document fingerprints by I-Match, in DataFrame functions only.

The terms of a text are its words (lower case); the lexicon is the terms whose inverse document
frequency lies in a band: found in at least ``min_docs`` documents and in at least ``min_share`` and
at most ``max_share`` of them (idf from ln(1 / max_share) to ln(1 / min_share)). A randomised lexicon
subset keeps the lexicon terms whose hash falls in it; its fingerprint cell is a hash of all sorted
distinct terms of the text in that subset. Subsets come in ``LEVELS`` levels of ``cells`` each: those of
level 0 divide the whole lexicon, so every in-band term of a text is in its fingerprint; those of level
L divide the 4^-L of it whose hash ends in 2L zero bits, so that some level's cells see one or two terms
whatever the text's length and survive edits elsewhere. The fingerprint lists the cells that are not
empty: two digits for level and cell, four for the hash.

Likeness of two fingerprints: equal cells among the cells that are not empty in both; 1 if both are
empty. Equal texts have equal fingerprints.

Size of the lexicon: each of its terms is in at least ``min_share`` of the documents, so it has at most
(mean distinct terms of a document) / ``min_share`` terms, whatever the number of documents. Up to
``held_terms`` it is one value of hash buckets that every task holds, and no term is shuffled after
the counting; beyond that the terms are joined with it by shuffle, with the same result.

A text none of whose terms is in the lexicon uses all of them. Edge cases: null text is
empty text and has an empty fingerprint (two such are alike: 1.0); the next document of a
row is the next lower id, a null id after all others, the highest after the last; rows that
repeat an id follow each other in the order of their texts' hashes; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize, parts

SPACE = r"[\x20\x09-\x0D]+"
LEVELS = 8
PER_BUCKET = 4


@dataclass(frozen=True)
class Params:
    min_docs: int = 2
    min_share: float = 1 / 5000
    max_share: float = 0.5
    cells: int = 32
    held_terms: int = 2_000_000


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once however often it is named."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def terms(text: Column) -> Column:
    """Distinct term hashes of a text."""
    hashes = F.transform(F.split(F.lower(text), SPACE), lambda w: F.xxhash64(w))
    return F.array_remove(F.array_distinct(hashes), F.xxhash64(F.lit("")))


def lexicon(docs: DataFrame, rows: int, p: Params) -> DataFrame:
    """(term): hashes of the terms in the band, over all documents."""
    least = max(p.min_docs, p.min_share * rows)
    return docs.select(F.explode(terms(F.col("text"))).alias("term")).groupBy("term") \
        .agg(F.count("*").alias("df")).where((F.col("df") >= least) & (F.col("df") <= p.max_share * rows)) \
        .select("term")


def cells(hashes: Column, lev: Column, p: Params) -> Column:
    """One entry per subset of level ``lev`` that holds any of the sorted ``hashes``: the subset of a
    term is the range of hashes it lies in, so the terms of one subset follow each other."""
    def cell(h: Column) -> Column:
        return F.pmod(F.floor(h / F.lit(2.0 ** 64 / p.cells)), F.lit(p.cells)).cast("int")

    def entry(state: Column) -> Column:
        place = F.lower(F.lpad(F.hex(lev * p.cells + state["cell"]), 2, "0"))
        return F.array(F.concat(place, F.lower(F.lpad(F.hex(F.pmod(state["hash"], F.lit(1 << 16))), 4, "0"))))

    def step(state: Column, h: Column) -> Column:
        inside = state["cell"] == cell(h)
        ended = ~inside & (state["cell"] >= 0)
        return F.struct(cell(h).alias("cell"),
                        F.when(inside, F.xxhash64(state["hash"], h)).otherwise(F.xxhash64(h)).alias("hash"),
                        F.when(ended, F.concat(state["done"], entry(state))).otherwise(state["done"]).alias("done"))

    start = F.struct(F.lit(-1).alias("cell"), F.lit(0).cast("long").alias("hash"),
                     F.array().cast("array<string>").alias("done"))
    return F.aggregate(hashes, start, step, lambda s: F.when(s["cell"] < 0, s["done"])
                       .otherwise(F.concat(s["done"], entry(s))))


def render(own: Column, p: Params) -> Column:
    """The fingerprint of a text with these term hashes."""
    def level(hashes: Column) -> Callable[[Column], Column]:
        return lambda at: cells(F.filter(hashes, lambda h: h.bitwiseAND(at["mask"]) == 0), at["level"], p)

    finer = F.array(*[F.struct(F.lit(i).alias("level"), F.lit(4 ** i - 1).cast("long").alias("mask"))
                      for i in range(1, LEVELS)])

    def levels(hashes: Column) -> Column:
        rest = let(F.filter(hashes, lambda h: h.bitwiseAND(F.lit(3).cast("long")) == 0),
                   lambda few: F.flatten(F.transform(finer, level(few))))
        return F.concat(cells(hashes, F.lit(0), p), rest)

    return F.array_join(let(F.sort_array(own), levels), "-")


def with_fingerprint(rows: DataFrame, band: DataFrame, p: Params, text: str, name: str) -> DataFrame:
    """``rows`` plus the fingerprint of their ``text``; ``band``: the stored lexicon."""
    def chosen(inside: Column, every: Column) -> Column:
        return F.when(F.size(inside) > 0, inside).otherwise(every)

    n = band.count()
    if n <= p.held_terms:
        buckets = parts(n, PER_BUCKET)
        slots = rows.sparkSession.range(buckets).join(band.withColumn("id", F.pmod("term", F.lit(buckets))), "id", "left") \
            .groupBy("id").agg(F.collect_list("term").alias("terms"))
        held = slots.agg(F.array_sort(F.collect_list(F.struct("id", "terms")))["terms"]).scalar()

        def marked(every: Column) -> Column:
            inside = F.filter(every, lambda h: F.array_contains(
                F.get(F.col("_held"), F.pmod(h, F.lit(buckets)).cast("int")), h))
            return let(inside, lambda own: render(chosen(own, every), p))

        return rows.withColumn("_held", held).withColumn(name, let(terms(F.col(text)), marked)).drop("_held")
    stored = materialize(rows.withColumn("_row", F.monotonically_increasing_id()), "imatch")
    every = stored.select("_row", F.explode(terms(F.col(text))).alias("term"))
    found = every.join(band.withColumn("_in", F.lit(True)), "term", "left").groupBy("_row").agg(
        F.collect_list("term").alias("every"), F.collect_list(F.when(F.col("_in"), F.col("term"))).alias("inside"))
    prints = found.select("_row", render(chosen(F.col("inside"), F.col("every")), p).alias(name))
    return stored.join(prints, "_row", "left").withColumn(name, F.coalesce(name, F.lit(""))).drop("_row")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal cells (0 to 1) of two fingerprints."""
    def entries(x: Column) -> Column:
        return F.filter(F.split(x, "-"), lambda e: e != "")

    def places(x: Column) -> Column:
        return F.transform(entries(x), lambda e: F.left(e, F.lit(2)))

    used = F.size(F.array_union(places(a), places(b)))
    return F.when(used == 0, 1.0).otherwise(F.size(F.array_intersect(entries(a), entries(b))) / used)


def with_next(docs: DataFrame, rows: int, band: DataFrame, p: Params) -> DataFrame:
    """(doc_id, text, fingerprint, next_text, next_fingerprint): those of the document with the next
    lower id, or of the highest after the last. Ids are cut into about sqrt(rows) ranges; every range also gets the first
    document of the range below, so one window over ranges finds every successor."""
    lo, hi = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    lo, hi = (0, 0) if lo is None else (lo, hi)
    width = (hi - lo) // max(1, math.isqrt(rows)) + 1
    place = F.coalesce(F.col("doc_id"), F.lit(lo - 1).cast("long"))  # null ids come last
    keyed = docs.withColumn("_k", place).withColumn("_range", F.floor((F.col("_k") - lo) / F.lit(width)))
    # one row per range: the highest id of a range follows the lowest id of the range above it
    firsts = materialize(keyed.groupBy("_range").agg(F.max("_k").alias("_k")), "ranges")
    down = Window.partitionBy(F.lit(0)).orderBy(F.desc("_range"))
    whole = down.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    halo = firsts.select(F.coalesce(F.lag("_range").over(down), F.last("_range").over(whole)).alias("_to"), "_k")
    tails = keyed.select("_k", "doc_id", "text").join(halo, "_k") \
        .select("doc_id", "text", "_k", F.col("_to").alias("_range"), F.lit(True).alias("_halo"))
    both = keyed.select("doc_id", "text", "_k", "_range", F.lit(False).alias("_halo")).unionByName(tails)
    both = with_fingerprint(both, band, p, "text", "fingerprint")
    order = Window.partitionBy("_range").orderBy("_halo", F.desc("_k"), F.xxhash64("text"))
    return both.withColumn("next_text", F.lead("text").over(order)) \
        .withColumn("next_fingerprint", F.lead("fingerprint").over(order)).where(~F.col("_halo")) \
        .select("doc_id", "text", "fingerprint", "next_text", "next_fingerprint")


def fingerprint_edits(docs: DataFrame, p: Params = Params(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and
    near_next; the edited text has its last third replaced by the start of the next document."""
    base = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = base.count()
    band = materialize(lexicon(base, rows, p), "lexicon")
    n, cut = F.char_length("text"), F.floor(F.char_length("text") / 3).cast("int")
    edited = F.concat(F.left(F.col("text"), n - cut), F.left(F.col("next_text"), cut))
    paired = with_next(base, rows, band, p).withColumn("edited", edited).select(
        "doc_id", n.cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint", "next_fingerprint", "edited")
    return with_fingerprint(paired, band, p, "edited", "edited_fingerprint").select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))
