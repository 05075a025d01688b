"""Spelling variants by a trie-node pair dictionary.

1. Words and their counts come from the whole texts, counted inside a task first.
2. The words are range-sorted once as they are and once reversed; a walk over each sorted part numbers
   the nodes of the forward and the reversed trie (``numbered``). A word then has one node for each of
   its prefixes and one for each of its suffixes. A prefix that is open across a border of two parts
   takes its number from the earlier part; one row per part goes to the driver for that.
3. Every word gives integer pairs (prefix node, suffix node): at each position the pair that skips the
   code point there, and at each gap the pair of the word itself, into which a code point may be
   inserted. Two words differ by one replaced code point exactly if they share a skipping pair, by one
   inserted or deleted one exactly if a skipping pair of the longer is an inserting pair of the shorter
   (of a run of equal code points only the first is skipped for that). Each near pair meets in just one
   pair of nodes, and a pair of nodes holds at most one word per letter and one more, so no group can grow.
4. From each group a word takes the number of near words and the best of them; rows stay one a member.
   Forms are followed to the last by pointer doubling.

Edge cases: a null or empty text has no words; a null id stands as empty text in the hash; equal rows
count again; of near words with the same count the smallest in code-point order wins; an empty table
gives an empty result; only the id and text columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, parts, pieces, raw_bytes

RUN = re.compile("[a-zÀ-ÿ]+")  # of texts in lower case
FLUSH = 1 << 18     # distinct words that a counting task holds
PER_PART = 1 << 16  # words of one sorted part
PART_BITS = 40      # a node's number: part, then its place among the part's nodes


def counts(docs: DataFrame, damage: int | None) -> DataFrame:
    """(word, n): runs of letters in lower case (A-Z only) and their occurrences. With ``damage`` set,
    a run whose crc32 of ``<doc_id>:<run>`` it divides loses the code point at crc32 modulo length."""
    def run(batches):
        seen: Counter[str] = Counter()

        def rows():
            out = pa.record_batch([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())],
                                  names=["word", "n"])
            seen.clear()
            return out

        for b in pieces(batches, 500):
            for key, text in zip(b["doc_id"].to_pylist(), raw_bytes(b["text"])):
                head = zlib.crc32(f"{'' if key is None else key}:".encode())
                for word, n in Counter(RUN.findall(text.lower().decode("utf-8", "replace"))).items():
                    if damage:
                        h = zlib.crc32(word.encode(), head)
                        if h % damage == 0:
                            word = word[:h % len(word)] + word[h % len(word) + 1:]
                    seen[word] += n
                if len(seen) >= FLUSH:
                    yield rows()
        if seen:
            yield rows()

    return docs.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def common_prefix(a: str, b: str) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return next(i for i in range(n) if a[i] != b[i])


def _path(word: str, before: str, above: list[int], first: int) -> list[int]:
    """Nodes of the word's prefixes, given those of the word before it; new nodes count from ``first``."""
    shared = common_prefix(word, before) + 1
    return above[:shared] + list(range(first, first + len(word) + 1 - shared))


def numbered(words: DataFrame, rows: int) -> DataFrame:
    """(word, part, place, path): distinct words in code-point order, each with the numbers of its
    prefixes' trie nodes, from the root to the word."""
    def run(batches):
        part = TaskContext.get().partitionId()
        start = part << PART_BITS
        before, above, fresh, place = "", [start], start + 1, start
        for b in pieces(batches, 1 << 13):
            texts, paths, places = b["word"].to_pylist(), [], []
            for word in texts:
                above = _path(word, before, above, fresh)
                fresh = max(fresh, above[-1] + 1)
                before = word
                paths.append(above)
                places.append(place)
                place += 1
            yield pa.record_batch([b["word"], pa.array([part] * len(texts), pa.int32()), pa.array(places, pa.int64()),
                                   pa.array(paths, pa.list_(pa.int64()))], names=["word", "part", "place", "path"])

    ordered = words.select("word").repartitionByRange(parts(rows, PER_PART), "word").sortWithinPartitions("word")
    stored = materialize(ordered.mapInArrow(run, "word string, part int, place long, path array<long>"), "trie")
    return stored.select("word", "place", across(stored).alias("path"))


def across(stored: DataFrame):
    """The path with the numbers of nodes that an earlier part opened. The driver sees the first and
    the last word of each part, as many rows as there are parts."""
    ends = stored.groupBy("part").agg(F.min("word").alias("first"), F.max("word").alias("last"),
                                      F.max_by("path", "word").alias("path")).orderBy("part").collect()
    inherited, before, above = {}, "", [0]
    for e in ends:
        shared = common_prefix(e["first"], before) + 1
        inherited[e["part"]] = above[:shared]
        start = e["part"] << PART_BITS
        # nodes that this part's first word opened before its own ones: number = start + depth
        open_ = min(shared, common_prefix(e["first"], e["last"]) + 1)
        before, above = e["last"], above[:open_] + e["path"][open_:]
        assert all(x >= start for x in above[open_:])
    if not inherited:
        return F.col("path")
    table = F.create_map(*[x for p, path in inherited.items()
                           for x in (F.lit(p), F.array(*map(F.lit, path)).cast("array<long>"))])
    taken = F.element_at(table, F.col("part"))
    own = F.col("part").cast("long") * F.lit(1 << PART_BITS)
    return F.transform("path", lambda x, i: F.when((i < F.size(taken)) & (x == own + i), F.get(taken, i)).otherwise(x))


def pairs_of_nodes(words: DataFrame) -> DataFrame:
    """(prefix, suffix, skips, whole, n, place): the integer pairs of every word. ``whole``: its own
    pair at a gap; otherwise a code point is skipped, ``lone`` if it differs from the one before."""
    at = F.posexplode("path").alias("i", "prefix")
    gaps = words.select("word", "n", "place", "back", F.size("path").alias("size"), at)
    here = F.substring("word", F.col("i") + 1, F.lit(1))
    lone = (F.col("i") == 0) | (here != F.substring("word", F.col("i"), F.lit(1)))
    whole = F.struct(F.get("back", F.col("size") - 1 - F.col("i")).alias("suffix"), F.lit(True).alias("whole"),
                     F.lit(False).alias("lone"))
    skip = F.struct(F.get("back", F.col("size") - 2 - F.col("i")).alias("suffix"), F.lit(False).alias("whole"),
                    lone.alias("lone"))
    return gaps.select("prefix", "n", "place", F.explode(F.array(whole, skip)).alias("p")) \
        .select("prefix", F.col("p.suffix").alias("suffix"), F.col("p.whole").alias("whole"),
                F.col("p.lone").alias("lone"), "n", "place").where(F.col("suffix").isNotNull())


def nearest(pairs: DataFrame) -> DataFrame:
    """(place, n_near, best): per word with near words their number and the best, as (-n, place)."""
    rank = F.struct((-F.col("n")).alias("less"), F.col("place").alias("place"))
    met = pairs.groupBy("prefix", "suffix").agg(
        F.sort_array(F.collect_list(F.when(~F.col("whole"), rank))).alias("skips"),
        F.sort_array(F.collect_list(F.when(F.col("lone"), rank))).alias("lone"),
        F.max(F.when(F.col("whole"), rank)).alias("whole"))
    met = met.where((F.size("skips") > 1) | (F.col("whole").isNotNull() & (F.size("lone") > 0)))
    other = F.transform("skips", lambda x: F.struct(
        x["place"].alias("place"), (F.size("skips") - 1).alias("n_near"),
        F.when(x["place"] == F.col("skips")[0]["place"], F.get("skips", F.lit(1))).otherwise(F.col("skips")[0]).alias("best")))
    longer = F.when(F.col("whole").isNotNull(), F.transform("lone", lambda x: F.struct(
        x["place"].alias("place"), F.lit(1).alias("n_near"), F.col("whole").alias("best"))))
    shorter = F.when(F.col("whole").isNotNull() & (F.size("lone") > 0), F.array(F.struct(
        F.col("whole.place").alias("place"), F.size("lone").alias("n_near"), F.get("lone", F.lit(0)).alias("best"))))
    none = F.array().cast("array<struct<place:bigint,n_near:int,best:struct<less:bigint,place:bigint>>>")
    rows = met.select(F.explode(F.concat(other, F.coalesce(longer, none), F.coalesce(shorter, none))).alias("m")).select("m.*")
    return rows.where("n_near > 0").groupBy("place").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(place, root): forms (place, form) followed to the last. A form has at least twice the count,
    so chains are short: each round doubles the steps, written to the checkpoint folder."""
    steps = materialize(forms.select("place", F.col("form").alias("root")), "roots")
    while True:
        on = steps.select(F.col("place").alias("root"), F.col("root").alias("next"))
        longer = materialize(steps.join(on, "root", "left").select("place", F.coalesce("next", "root").alias("root"),
                                                                   F.col("next").isNotNull().alias("moved")), "roots")
        steps = longer.select("place", "root")
        if longer.where("moved").isEmpty():
            return steps


def spelling_variants(docs: DataFrame, damage: int | None = None, least_length: int = 5, least_count: int = 3,
                      factor: int = 2, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per word of at least ``least_length`` code points and ``least_count`` occurrences: n, n_near (words
    one edit away), form (the near word of largest n, if that is ``factor`` times the word's), form_n, root."""
    base = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    words = materialize(counts(base, damage).where((F.char_length("word") >= least_length) & (F.col("n") >= least_count)),
                        "words")
    rows = words.count()
    ahead = numbered(words, rows)
    back = numbered(words.select(F.reverse("word").alias("word")), rows)
    both = materialize(words.join(ahead, "word")
                       .join(back.select(F.reverse("word").alias("word"), F.col("path").alias("back")), "word"), "nodes")
    near = materialize(nearest(pairs_of_nodes(both)), "near")
    plain = both.select("word", "n", "place")
    chosen = materialize(plain.join(near, "place", "left").select(
        "word", "n", "place", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("best.less") >= F.lit(factor) * F.col("n"), F.col("best")).alias("best")), "forms")
    ends = roots(chosen.where("best IS NOT NULL").select("place", F.col("best.place").alias("form")))
    named = chosen.join(ends, "place", "left").select(
        "word", "n", "n_near", F.col("best.place").alias("form_at"), (-F.col("best.less")).alias("form_n"),
        F.coalesce("root", "place").alias("root_at"))
    names = plain.select("place", "word")
    return named.join(names.select(F.col("place").alias("form_at"), F.col("word").alias("form")), "form_at", "left") \
        .join(names.select(F.col("place").alias("root_at"), F.col("word").alias("root")), "root_at") \
        .select("word", "form", "root", "n", "n_near", "form_n")
