"""SimHash near-duplicates: fingerprints and a binary-trie self-join on them.

A text's words (ASCII lower case) give shingles of ``width`` words, repeats included; every
shingle is hashed with XXH64 (seed 42), and a fingerprint bit is 1 where more than half of the
hashes have it. Two texts are linked when their fingerprints differ in at most ``errors`` bits.

The join walks one binary trie of the distinct fingerprints against itself: a pair of nodes
carries the number of bits in which their paths differ, is split into its child pairs, and is
dropped once that number exceeds the error budget. The upper levels are the unit of
distribution: the trie is cut into nodes of bounded size (as deep as crowding fingerprints ask), each
node's fingerprints become one packed row, a node meets only the nodes that the budget allows
on their common path, and every such pair of nodes is walked by one task. A task returns a
spanning forest of its links (member, root of its part), not all pairs, so a crowd of near
copies costs as many rows as it has members. Components are then the minimum label over the
forest edges, with pointer jumping, written to the checkpoint folder after each round.

Edge cases: a text without words has fingerprint zero and is linked like any other; null text is
empty text; null ids take part in links but are never a component id unless all ids of a
component are null; repeated rows share their fingerprint; an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, numbered, pieces, raw_bytes, schema_with

PREFIX_BITS = 16  # the cut first looks at this many leading bits: at most 65,536 counts
STEP_BITS = 4     # and at this many more of the prefixes that are still too full, until none is
PACKET = 32 << 20  # bytes of packed nodes in one batch
LEAF = 8          # node pairs no larger than this are compared element by element
FRONTIER = 1 << 14


def fingerprint(text: bytes, width: int = 3) -> int:
    words = text.lower().split()
    if not words:
        return 0
    joined, h = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= width:
        return h(joined, 42)
    at = [0, *accumulate(len(w) + 1 for w in words)]
    hashes = np.array([h(joined[a:b - 1], 42) for a, b in zip(at, at[width:])], np.uint64)
    n = len(hashes)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 14):
        ones += np.unpackbits(hashes[i:i + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1,
                              bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0])


def with_fingerprint(docs: DataFrame, width: int = 3, text: str = "text", keep_text: bool = False) -> DataFrame:
    """``docs`` plus ``_fp`` (the fingerprint's bits as a signed long); the text only if asked for."""
    base = docs.drop("_fp")
    out = base if keep_text else base.drop(text)
    names = out.columns

    def run(batches):
        for b in pieces(batches, 500):
            fp = np.array([fingerprint(x, width) for x in raw_bytes(b[text])], np.uint64).view(np.int64)
            yield pa.record_batch([*(b[c] for c in names), pa.array(fp)], names=[*names, "_fp"])

    return base.mapInArrow(run, schema_with(out, _fp="long"))


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


class Forest:
    """Union-find over 0..n-1 that takes links in arrays."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        while True:
            a, b = self.root[i], self.root[j]
            open_ = a != b
            if not open_.any():
                return
            i, j, a, b = i[open_], j[open_], a[open_], b[open_]
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = self.root[self.root]
                if np.array_equal(up, self.root):
                    break
                self.root = up


def _split(values: np.ndarray, lo: np.ndarray, hi: np.ndarray, bit: int) -> np.ndarray:
    """Where the bit turns to 1 within each sorted run [lo, hi) that agrees on all higher bits."""
    mid = hi.copy()
    some = lo < hi
    first = (values[lo[some]] >> np.uint64(bit) | np.uint64(1)) << np.uint64(bit)
    mid[some] = np.clip(np.searchsorted(values, first), lo[some], hi[some])
    return mid


def walk(values: np.ndarray, a: tuple[int, int], b: tuple[int, int], errors: int, forest: Forest) -> None:
    """Traverse the trie of sorted distinct ``values`` for the run pair ``a``, ``b`` (equal: a
    self-pair) from the top bit down and add every link within the budget to ``forest``."""
    start = np.array([[a[0], a[1], b[0], b[1], 0]], np.int64)
    stack = [(63, start)]
    while stack:
        bit, front = stack.pop()
        if len(front) > FRONTIER:
            half = len(front) // 2
            stack += [(bit, front[half:]), (bit, front[:half])]
            continue
        la, ha, lb, hb, err = front.T
        small = np.maximum(ha - la, hb - lb) <= LEAF
        if bit < 0:
            small[:] = True
        if small.any():
            f = front[small]
            n, m = f[:, 1] - f[:, 0], f[:, 3] - f[:, 2]
            size = n * m
            pair = np.repeat(np.arange(len(f)), size)
            k = np.arange(len(pair)) - np.repeat(np.cumsum(size) - size, size)
            i, j = f[pair, 0] + k // m[pair], f[pair, 2] + k % m[pair]
            near = (i < j) & (distance(values[i], values[j]) <= errors)
            forest.add(i[near], j[near])
        f = front[~small]
        if not len(f):
            continue
        la, ha, lb, hb, err = f.T
        ma, mb = _split(values, la, ha, bit), _split(values, lb, hb, bit)
        own = la == lb  # a self-pair meets its crossed children once
        children = [np.stack(x, axis=1) for x in ((la, ma, lb, mb, err), (ma, ha, mb, hb, err), (la, ma, mb, hb, err + 1))]
        other = ~own
        children.append(np.stack((ma, ha, lb, mb, err + 1), axis=1)[other])
        nxt = np.concatenate(children)
        nxt = nxt[(nxt[:, 0] < nxt[:, 1]) & (nxt[:, 2] < nxt[:, 3]) & (nxt[:, 4] <= errors)]
        if len(nxt):
            stack.append((bit - 1, nxt))


def split_nodes(counts: dict[int, int], most: int, bits: int, roots: list[tuple[int, int]]) -> tuple[list, list]:
    """The nodes (prefix, depth) below ``roots`` with at most ``most`` fingerprints each, and those of
    depth ``bits`` that hold more. ``counts``: fingerprints per prefix of ``bits`` bits."""
    keys = sorted(counts)
    sums = [0, *accumulate(counts[k] for k in keys)]
    out, crowded, stack = [], [], list(roots)
    while stack:
        prefix, depth = stack.pop()
        lo, hi = (bisect_left(keys, x << (bits - depth)) for x in (prefix, prefix + 1))
        if lo == hi:
            continue
        if sums[hi] - sums[lo] <= most:
            out.append((prefix, depth))
        elif depth == bits:
            crowded.append((prefix, depth))
        else:
            stack += [(prefix * 2 + 1, depth + 1), (prefix * 2, depth + 1)]
    return out, crowded


def aligned(nodes: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Left-aligned prefixes, ascending, and depths."""
    placed = sorted((p << (64 - d), d) for p, d in nodes)
    return np.array([p for p, _ in placed], np.uint64), np.array([d for _, d in placed], np.int64)


def cut_nodes(counts: dict[int, int], most: int) -> tuple[np.ndarray, np.ndarray]:
    """Trie nodes (left-aligned prefixes and depths) that cover all fingerprints, each with at most
    ``most`` of them where ``PREFIX_BITS`` bits allow it. ``counts``: fingerprints per prefix."""
    out, crowded = split_nodes(counts, most, PREFIX_BITS, [(0, 0)])
    return aligned(out + crowded)


def prefix_counts(fps: DataFrame, bits: int, within: list[tuple[int, int]] | None = None) -> dict[int, int]:
    """Fingerprints per prefix of ``bits`` bits, below the nodes ``within`` (all of one depth)."""
    if within is None:
        rows = fps.select(F.shiftrightunsigned("_fp", 64 - bits).alias("p"))
    else:
        wanted = fps.sparkSession.sparkContext.broadcast(np.array([p for p, _ in within], np.uint64))
        up = np.uint64(64 - within[0][1])

        def inside(batches):
            for b in batches:
                v = b["_fp"].to_numpy(zero_copy_only=False).view(np.uint64)
                p = v[np.isin(v >> up, wanted.value)] >> np.uint64(64 - bits)
                yield pa.record_batch([pa.array(p.view(np.int64))], names=["p"])

        rows = fps.select("_fp").mapInArrow(inside, "p long")
    return {r["p"] % (1 << 64): r["n"] for r in rows.groupBy("p").agg(F.count("*").alias("n")).collect()}


def cut_trie(fps: DataFrame, counts: dict[int, int], most: int) -> tuple[np.ndarray, np.ndarray]:
    """Nodes with at most ``most`` fingerprints each, however fingerprints crowd: prefixes that are
    too full are counted ``STEP_BITS`` deeper, round by round. A round brings the driver at most
    2^STEP_BITS counts for every ``most`` fingerprints."""
    bits = PREFIX_BITS
    nodes, crowded = split_nodes(counts, most, bits, [(0, 0)])
    while crowded:
        bits += STEP_BITS
        done, crowded = split_nodes(prefix_counts(fps, bits, crowded), most, bits, crowded)
        nodes += done
    return aligned(nodes)


def trie_links(fps: DataFrame, errors: int = 3, most: int = 1 << 18) -> DataFrame:
    """Forest edges (a, b) over the distinct signed longs in ``fps._fp``: two fingerprints are
    connected by edges if and only if links of at most ``errors`` bits connect them. ``most``:
    fingerprints per trie node (the bound on a task's memory); smaller inputs are cut finer."""
    spark = fps.sparkSession
    counts = prefix_counts(fps, PREFIX_BITS)  # at most 65,536 rows
    total = sum(counts.values())
    if not total:
        return spark.createDataFrame([], "a long, b long")
    nodes = spark.sparkContext.broadcast(cut_trie(fps, counts, min(most, max(1024, total // 48))))

    def place(batches):
        starts, _ = nodes.value
        for b in batches:
            v = b["_fp"].to_numpy(zero_copy_only=False).view(np.uint64)
            yield pa.record_batch([pa.array(np.searchsorted(starts, v, side="right").astype(np.int32) - 1), b["_fp"]],
                                  names=["node", "_fp"])

    def pack(table: pa.Table) -> pa.Table:
        v = np.sort(table["_fp"].to_numpy().view(np.uint64))
        return pa.table({"node": table["node"].slice(0, 1), "packed": pa.array([v.tobytes()], pa.binary())})

    def meet(batches):
        starts, deep = nodes.value
        for b in batches:
            for k, packed in zip(b["node"].to_pylist(), b["packed"].to_pylist()):
                common = np.minimum(deep, deep[k]).astype(np.uint64)
                gap = starts ^ starts[k]
                gap = np.where(common == 0, np.uint64(0), gap >> (np.uint64(64) - np.maximum(common, np.uint64(1))))
                mates = np.flatnonzero(np.bitwise_count(gap) <= errors).astype(np.int32)
                per = max(1, PACKET // len(packed))
                for m in (mates[i:i + per] for i in range(0, len(mates), per)):
                    yield pa.record_batch([pa.array(np.minimum(m, k)), pa.array(np.maximum(m, k)),
                                           pa.array([packed] * len(m), pa.binary())], names=["x", "y", "packed"])

    def join(table: pa.Table) -> pa.Table:
        runs = [np.frombuffer(x, np.uint64) for x in table["packed"].to_pylist()]
        runs.sort(key=lambda r: int(r[0]))
        v = np.concatenate(runs)
        forest, n = Forest(len(v)), len(runs[0])
        walk(v, (0, n), (0, n) if len(runs) == 1 else (n, len(v)), errors, forest)
        child = np.flatnonzero(forest.root != np.arange(len(v)))
        return pa.table({"a": v[child].view(np.int64), "b": v[forest.root[child]].view(np.int64)})

    packed = fps.select("_fp").mapInArrow(place, "node int, _fp long") \
        .groupBy("node").applyInArrow(pack, "node int, packed binary")
    pairs = packed.mapInArrow(meet, "x int, y int, packed binary")
    return pairs.groupBy("x", "y").applyInArrow(join, "a long, b long")


def component_labels(edges: DataFrame) -> DataFrame:
    """(node, label): the least node that is connected to each node of ``edges`` (a, b). Rounds of
    minimum over neighbours and two pointer jumps; every round is written to the checkpoint folder."""
    both = materialize(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
                       .distinct(), "edges")
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")),
                         "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b") \
            .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        step = labels.join(near, "node").select("node", F.col("label").alias("old"),
                                                F.least("label", "near").alias("label"))
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("up"))
        step = step.join(up, "label").select("node", "old", F.least("label", "up").alias("label"))
        step = materialize(step, "labels")
        labels = step.select("node", "label")
        if step.where(F.col("old") != F.col("label")).isEmpty():
            return labels


def groups(fingerprinted: DataFrame, errors: int, doc_id: str) -> DataFrame:
    """(_fp, _group, component_id) of every distinct fingerprint: ``_group`` is never null, the least
    id of a group may be."""
    fps = materialize(fingerprinted.groupBy("_fp").agg(F.min(doc_id).alias("first")), "fingerprints")
    labels = component_labels(trie_links(fps, errors))
    rooted = fps.join(labels.select(F.col("node").alias("_fp"), "label"), "_fp", "left") \
        .select("_fp", "first", F.coalesce("label", "_fp").alias("_group"))
    roots = rooted.groupBy("_group").agg(F.min("first").alias("component_id"))
    return rooted.select("_fp", "_group").join(roots, "_group").select("_fp", "_group", "component_id")


def with_component(fingerprinted: DataFrame, errors: int = 3, doc_id: str = "doc_id") -> DataFrame:
    """Adds ``component_id``, the least id reachable over links, to a stored table with ``_fp``."""
    return fingerprinted.drop("component_id").join(groups(fingerprinted, errors, doc_id).drop("_group"), "_fp")


def near_duplicates(docs: DataFrame, width: int = 3, errors: int = 3, doc_id: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """Per document: its id, fingerprint (16 hexadecimal digits) and component_id."""
    base = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    stored = materialize(with_fingerprint(base, width), "simhash")
    return with_component(stored, errors).select("doc_id", F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"),
                                                 "component_id")


def first_of_each(docs: DataFrame, width: int = 3, errors: int = 3, doc_id: str = "doc_id",
                  text: str = "text") -> DataFrame:
    """``docs`` with one document of each component: the row with the least id (nulls last; then by
    the text's hash; of equal rows, one). The fingerprinted rows are stored once, so the texts are
    read a single time by Python."""
    columns = docs.columns
    docs, (doc_id, text) = numbered(docs, doc_id, text)
    stored = materialize(with_fingerprint(docs, width, text, keep_text=True)
                         .withColumn("_row", F.monotonically_increasing_id()), "simhash")
    narrow = stored.select("_fp", "_row", F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("_hash"))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "_hash", "_row")
    chosen = narrow.join(groups(narrow, errors, "doc_id"), "_fp").groupBy("_group").agg(F.min(order).alias("pick")) \
        .select(F.col("pick._row").alias("_row"))
    return stored.join(chosen, "_row", "left_semi").select(*docs.columns).toDF(*columns)
