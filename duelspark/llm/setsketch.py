"""Near duplicates by SetSketch registers.

A text's set holds the 64-bit hashes of its distinct shingles of ``width`` words (ASCII lower case).
Register i of a set's sketch is the least of the set's exponential hash values under function i,
rounded to the scale RATE * BASE**(1 - k) and truncated to k in 0 .. LEVELS (``registers``): a short
integer that merges by maximum, and that two sets share about as often as they share elements.

1. Equal sets are one class, so copies cost one row. Classes, not documents, are compared.
2. Registers are banded (BANDS bands of WIDTH registers); two sets of similarity 0.8 agree on no band
   with probability (1 - 0.8**5)**40 = 1.2e-7 at most, and far less above 0.8.
3. Star rounds: a class is first held against one class, the one that is the least of most of its
   buckets, then, in buckets whose members still lie in several components, against the CENTRES
   randomly chosen members it meets most often. What the full sets confirm becomes links and
   components, so a crowd of near copies costs a few pairs a member.
4. Rest: what is left in several components is compared in blocks of at most BLOCK members, pairs
   across components only, each in the first band that it shares. Register agreement gives the
   likelihood of the similarity J; a pair is credible if the most likely J is at least ``floor_of`` (six
   standard deviations below the threshold). The most likely first, credible pairs are confirmed on the
   full sets where they are compared, unless links found before already join them; only links come out.
   No cap on members, partners or candidates.
The full sets are made again from the texts of the classes that share a bucket with another.

Edge cases: a text with fewer words than ``width`` is one shingle; null and wordless texts have an
empty set, are linked with nothing and stay alone; null ids take part in links but are a component's
id only if all its ids are null; repeated rows share a class; an empty table gives an empty result;
only the id and text columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, pieces, raw_bytes
from .simhash import component_labels

WIDTH, BANDS = 5, 40
REGISTERS = WIDTH * BANDS
BASE, RATE, LEVELS = 1.02, 64.0, 2500  # scale of the registers; 64-bit minima stay inside 0 .. LEVELS
CENTRES = 4         # centres that a class is held against in the second star round
BLOCK = 1024        # members of a bucket that one comparison holds on each side
AT_ONCE = 1 << 15   # hashes sketched together (the arrays of one pass stay in cache)

_RANDOM = np.random.default_rng(20240611)
_MASKS = _RANDOM.integers(0, 1 << 64, REGISTERS, dtype=np.uint64)
_ODDS = _RANDOM.integers(0, 1 << 64, REGISTERS, dtype=np.uint64) | np.uint64(1)
_BAND_ODDS = _RANDOM.integers(0, 1 << 64, (BANDS, WIDTH), dtype=np.uint64) | np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingle_set(text: bytes, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles; empty for a text without words."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    known: dict[bytes, int] = {}
    h = np.fromiter((known.get(w) or known.setdefault(w, xxhash.xxh64_intdigest(w)) for w in words), np.uint64, len(words))
    size = min(width, len(words))
    out = np.full(len(words) - size + 1, size, np.uint64)
    for i in range(size):
        out = _mixed(out * np.uint64(0x9E3779B97F4A7C15) + h[i:len(h) - size + 1 + i])
    return np.unique(out)


def _scaled(least: np.ndarray) -> np.ndarray:
    """Register values of the least hash of each set: exponential variables on the scale of BASE."""
    u = (least.astype(np.float64) + 0.5) / 2.0 ** 64
    u = np.minimum(u, 1 - 2.0 ** -53)
    k = np.floor(1 - np.log(-np.log1p(-u) / RATE) / np.log(BASE))
    return np.clip(k, 0, LEVELS).astype(np.uint16)


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """One row of REGISTERS short integers for each set; an empty set has zeros. The sketch of a
    union is the elementwise maximum of the sketches."""
    out = np.zeros((len(sets), REGISTERS), np.uint16)
    filled = [i for i, s in enumerate(sets) if len(s)]
    at = 0
    while at < len(filled):
        end, total = at, 0
        while end < len(filled) and (end == at or total + len(sets[filled[end]]) <= AT_ONCE):
            total += len(sets[filled[end]])
            end += 1
        group = filled[at:end]
        values = np.concatenate([sets[i] for i in group])
        starts = np.cumsum([0, *(len(sets[i]) for i in group[:-1])])
        least, work = np.empty((REGISTERS, len(group)), np.uint64), np.empty_like(values)
        for r in range(REGISTERS):
            np.bitwise_xor(values, _MASKS[r], out=work)
            np.multiply(work, _ODDS[r], out=work)
            np.minimum.reduceat(work, starts, out=least[r])
        out[group] = _scaled(least).T
        at = end
    return out


def buckets(sketches: np.ndarray) -> np.ndarray:
    """One 64-bit bucket for each band of each sketch."""
    x = sketches.reshape(len(sketches), BANDS, WIDTH).astype(np.uint64) + np.uint64(1)
    return _mixed((x * _BAND_ODDS).sum(axis=2, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64) * _MASKS[0])


def _tail(x: np.ndarray) -> np.ndarray:
    """Probability that a register of one set exceeds the other's, for a share ``x`` of the union."""
    return -np.log1p(-np.clip(x, 1e-12, 1) * (BASE - 1) / BASE) / np.log(BASE)


def likely_similarity(greater: np.ndarray, less: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """The similarity J of greatest likelihood, given how many registers of a are greater and less than
    b's and the sizes of the sets: registers differ upwards with probability tail(u - v J), downwards
    with tail(v - u J), u and v being the sizes' shares. Bisection on the likelihood's slope."""
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)
    equal = REGISTERS - greater - less
    lo, hi = np.zeros(len(u)), np.minimum(u / v, v / u)
    step = 1e-6

    def likelihood(j):
        up, down = _tail(u - v * j), _tail(v - u * j)
        return greater * np.log(up) + less * np.log(down) + equal * np.log(np.clip(1 - up - down, 1e-12, 1))

    for _ in range(20):
        mid = (lo + hi) / 2
        rising = likelihood(mid + step) >= likelihood(mid)
        lo, hi = np.where(rising, mid, lo), np.where(rising, hi, mid)
    return (lo + hi) / 2


def floor_of(share: float) -> float:
    """Six standard deviations below the threshold: at REGISTERS registers none that matters is lost."""
    return share - 6 * (share * (1 - share) / REGISTERS) ** 0.5


def sketched(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, n, key, sketch, content): ``key`` is 128 bits of the sorted set, null for an empty one;
    ``content`` finds the text again."""
    def run(batches):
        for b in pieces(batches, 500):
            sets = [shingle_set(x, width) for x in raw_bytes(b["text"])]
            keys = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            yield pa.record_batch([b["doc_id"], pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.binary()),
                                   pa.array([r.tobytes() for r in registers(sets)], pa.binary()), b["content"]],
                                  names=["doc_id", "n", "key", "sketch", "content"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.withColumn("content", F.xxhash64("text")) \
        .mapInArrow(run, f"doc_id {kind}, n long, key binary, sketch binary, content long")


def banded(classes: DataFrame) -> DataFrame:
    def run(batches):
        for b in pieces(batches, 2000):
            rows = np.frombuffer(b"".join(b["sketch"].to_pylist()), np.uint16).reshape(-1, REGISTERS)
            yield pa.record_batch([pa.array(np.repeat(b["class"].to_numpy(), BANDS)),
                                   pa.array(buckets(rows).view(np.int64).ravel())], names=["class", "bucket"])

    return classes.select("class", "sketch").mapInArrow(run, "class long, bucket long")


def full_sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(class, n, members) of the wanted classes (class, key, content): the sets made again from the
    texts. A text whose 64-bit content hash fits by chance is told apart by its key."""
    def run(batches):
        for b in pieces(batches, 500):
            sets = [shingle_set(x, width) for x in raw_bytes(b["text"])]
            yield pa.record_batch([pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                                   pa.array([s.tobytes() for s in sets], pa.binary())], names=["key", "members"])

    texts = docs.select("text", F.xxhash64("text").alias("content")).dropDuplicates(["content"]) \
        .join(wanted.select("content").distinct(), "content", "left_semi")
    return texts.mapInArrow(run, "key binary, members binary").dropDuplicates(["key"]) \
        .join(wanted.select("class", "key"), "key").select("class", "members")


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    both = np.concatenate([x, y])
    both.sort()
    inter = int(np.count_nonzero(both[1:] == both[:-1]))
    return 100 * inter >= percent * (len(both) - inter)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes with 100 * intersection >= percent * union."""
    def run(batches):
        for b in pieces(batches, 1000):
            ok = [linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent)
                  for x, y in zip(b["x"].to_pylist(), b["y"].to_pylist())]
            yield b.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    with_a = pairs.join(sets.select(F.col("class").alias("a"), F.col("members").alias("x")), "a")
    with_b = with_a.join(sets.select(F.col("class").alias("b"), F.col("members").alias("y")), "b")
    return with_b.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def split_buckets(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """(bucket, class, component) of the buckets whose members lie in more than one component."""
    if labels is None:
        return members.select("bucket", "class", F.col("class").alias("component"))
    placed = materialize(
        members.join(labels.select(F.col("node").alias("class"), "label"), "class", "left")
        .select("bucket", "class", F.coalesce("label", "class").alias("component")), "placed")
    split = placed.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")) \
        .where("lo <> hi").select("bucket")
    return materialize(placed.join(split, "bucket", "left_semi"), "split")


def stars(apart: DataFrame, centre, most: int) -> DataFrame:
    """Pairs (a, b) of a class and a centre of its buckets, in another component: for each class the
    ``most`` centres that it meets in most buckets, so the pairs grow with the classes."""
    centres = apart.groupBy("bucket").agg(centre.alias("pick")) \
        .select("bucket", F.col("pick.class").alias("centre"), F.col("pick.component").alias("of"))
    met = apart.join(centres, "bucket").where("component <> of").groupBy("class", "centre") \
        .agg(F.count("*").alias("shared"))
    best = F.sort_array(F.collect_list(F.struct((-F.col("shared")).alias("order"), "centre")))
    return met.groupBy("class").agg(F.slice(best, 1, most).alias("best")) \
        .select(F.col("class").alias("b"), F.explode("best.centre").alias("a")) \
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def remaining_links(apart: DataFrame, details: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between unlike components that share a bucket: one for each pair of components that a
    comparison finds linked. ``apart``: (bucket, class, component); ``details``: (class, n, sketch, members),
    which join the dealt rows last, so that sketches and sets are shuffled once more only.

    A bucket is dealt out in blocks of BLOCK members at most, and a pair of blocks is compared at a time:
    register agreement makes a pair credible, the full sets confirm it."""
    least = floor_of(percent / 100)
    sizes = apart.groupBy("bucket").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("blocks"))
    dealt = apart.join(sizes, "bucket").withColumn("mine", F.pmod(F.xxhash64("class"), "blocks").cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
        .select("bucket", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine",
                "class", "component")
    group = ["bucket", "i", "j"]
    ordered = dealt.join(details, "class").repartition(*group).sortWithinPartitions(*group, "class")

    def compare(t: pa.Table) -> pa.RecordBatch:
        cls, comp, n, mine = (t[c].to_numpy() for c in ("class", "component", "n", "mine"))
        rows = np.frombuffer(b"".join(t["sketch"].to_pylist()), np.uint16).reshape(-1, REGISTERS)
        bands = buckets(rows)
        here = (bands == np.int64(t["bucket"][0].as_py()).astype(np.uint64)).argmax(axis=1)
        sets = [np.frombuffer(x, np.uint64) for x in t["members"].to_pylist()]
        same = t["i"][0] == t["j"][0]
        forest = {c: c for c in set(comp.tolist())}

        def top(c):
            while forest[c] != c:
                forest[c] = forest[forest[c]]
                c = forest[c]
            return c

        _, of, count = np.unique(comp, return_inverse=True, return_counts=True)
        crowd = of == count.argmax()  # the pairs of two members of the largest component need no look
        every, met = np.arange(len(comp)), []
        for q in np.flatnonzero(~crowd):
            r = every[(crowd | (every > q)) & (comp != comp[q]) & (same | (mine != mine[q]))
                      & (100 * np.minimum(n, n[q]) >= percent * np.maximum(n, n[q]))]
            r = r[(bands[r] == bands[q]).argmax(axis=1) == here[q]]  # pairs that share an earlier band meet there
            met.append(np.stack([np.full(len(r), q), r]))
        met = np.concatenate(met, axis=1) if met else np.empty((2, 0), np.int64)
        credible = []
        for lo in range(0, met.shape[1], AT_ONCE):
            q, r = met[:, lo:lo + AT_ONCE]
            greater, less = (rows[q] > rows[r]).sum(axis=1), (rows[q] < rows[r]).sum(axis=1)
            likely = likely_similarity(greater, less, n[q], n[r])
            ok = likely >= least
            credible += zip((-likely[ok]).tolist(), q[ok].tolist(), r[ok].tolist())
        found = []
        for _, q, r in sorted(credible):
            x, y = top(comp[q]), top(comp[r])
            if x != y and linked(sets[q], sets[r], percent):
                forest[max(x, y)] = min(x, y)
                found.append((cls[q], cls[r]))
        return pa.record_batch([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())],
                               names=["a", "b"])

    def run(batches):
        held: list[pa.RecordBatch] = []  # rows of the group that is still open
        for b in pieces(batches, 4096):
            t = pa.Table.from_batches([*held, b])
            ids = np.stack([t[c].to_numpy() for c in group])
            cuts = np.flatnonzero((ids[:, 1:] != ids[:, :-1]).any(axis=0)) + 1
            for lo, hi in zip([0, *cuts], cuts):
                if hi - lo > 1:
                    yield compare(t.slice(lo, hi - lo))
            held = t.slice(cuts[-1] if len(cuts) else 0).combine_chunks().to_batches()
        if held and sum(x.num_rows for x in held) > 1:
            yield compare(pa.Table.from_batches(held))

    return ordered.mapInArrow(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, width: int = 2, percent: int = 80, doc_id: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """Per document: its id, ``n_shingles``, ``component_id`` (the least id reachable over links) and
    ``kept`` (its id is the component's)."""
    base = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    stored = materialize(sketched(base, width), "sketches")
    filled = stored.where(F.col("key").isNotNull())
    classes = materialize(
        filled.groupBy("key").agg(F.min("doc_id").alias("first"), F.min("content").alias("content"),
                                  F.min("n").alias("n"), F.min("sketch").alias("sketch"))
        .withColumn("class", F.monotonically_increasing_id()), "classes")
    bands = materialize(banded(classes), "bands")
    met = bands.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1").select("bucket")
    members = materialize(bands.join(met, "bucket", "left_semi"), "buckets")

    wanted = classes.join(members.select("class").distinct(), "class", "left_semi")
    sets = materialize(full_sets(base, wanted, width), "sets")
    links, labels = None, None
    member = F.struct("class", "component")
    for centres, most in ((F.min(member), 1), (F.min_by(member, F.xxhash64("class", "bucket")), CENTRES)):
        apart = split_buckets(members, labels)
        pairs = materialize(stars(apart, centres, most), "stars")
        found = confirmed(pairs, sets, percent)
        links = materialize(found if links is None else links.union(found), "links")
        labels = component_labels(links)
    apart = split_buckets(members, labels)
    details = classes.select("class", "n", "sketch").join(sets, "class")
    more = materialize(remaining_links(apart, details, percent), "links")
    if not more.isEmpty():
        labels = component_labels(links.union(more))

    grouped = classes.join(labels.select(F.col("node").alias("class"), "label"), "class", "left") \
        .select("key", "first", F.coalesce("label", "class").alias("group"))
    ids = grouped.groupBy("group").agg(F.min("first").alias("component_id"))
    by_key = grouped.join(ids, "group").select("key", "component_id")
    found = filled.select("doc_id", "n", "key").join(by_key, "key").select("doc_id", "n", "component_id")
    alone = stored.where(F.col("key").isNull()).select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return found.unionByName(alone).select("doc_id", F.col("n").alias("n_shingles"), "component_id",
                                           F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
