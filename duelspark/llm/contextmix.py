"""Language-model scores by logistic context mixing.

A text is coded as its tokens (words in ASCII lower case, then one end): each word's bytes and a
closing space, the end as a line feed; every byte is eight binary decisions, most significant bit
first. Several predictors give each decision a probability from the counts of zeros and ones
seen in the training documents under a hashed context and the bits of the byte so far:

* the last 1, 2, 3, 4 and 6 bytes of the word (fewer at its start), in hashed tables of two to four
  slots for every distinct (context, byte) counted, so that they are as crowded at any size;
* the whole word so far, exact and without limit: its counts live where the words with the same
  first six bytes are, so they grow with the corpus and are never gathered in one place.

The predictors' logits are mixed by weights that two gates select (how often the longest context
was seen; the same, coarser, with the bit's place) and the result is refined by an
adaptive probability map (gate, mixed logit). Weights and map (some 1,100 numbers) are learned
online, one pass in batches, on all training words of every shard, each weighted by a power of its
count and predicted without its own occurrence; the shards' results are averaged. Scoring leaves weights and counts
as they are, so a text's score does not depend on the partitioning, and the probabilities of all
token sequences sum to one. The contexts stay inside a word, so a word has one probability, found
once for each distinct word of the corpus; words of a block that begin alike share the work on their beginning.

What a document's words share (its language, its kind of junk) enters as a class that scales every
word's probability by how much more often training documents of that class use the word; the
scales are normalised over all words, and a text's probability is the mixture over the classes
by their shares. Classes are k-means clusters of byte frequencies over all training documents; only
where the k-means starts comes from a bounded sample (``class_sample`` rows expected).

1. Count the words of the training documents by class: distinct words per task, then a sum by word.
2. Count the distinct contexts; build the tables from the distinct words; learn the weights shard by shard; give every
   distinct word (also of held-out texts) its count and log-probability.
3. Documents are grouped into chunks of nearby ids; a chunk asks for its distinct words once, and
   meets the answers with its texts.

Edge cases: null text is empty text (its score is that of the end alone); repeated rows count as
documents of their own; a null id counts as an empty text where ids are hashed; without training
documents all counts are zero and every decision has probability one half; an empty table gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, parts, pieces, raw_bytes

ORDERS = ((1, 16), (2, 18), (3, 19), (4, 19), (6, 20))  # bytes of context, least bits of the table's size
LEAST_BITS = tuple(size for _, size in ORDERS)
DEEP = ORDERS[-1][0]
INPUTS = len(ORDERS) + 2  # the tables, the exact word prefix, a constant
SEEN, BINS = 14, 33
MAP_SHARE = 0.2
GATES = (2 * SEEN, 8 * 4)
P = 0x9E3779B97F4A7C15
P_INVERSE = pow(P, -1, 1 << 64)
U = np.uint64
PROFILE_UNITS = 65535  # of a packed component
CLASS_ROUNDS = 30  # most rounds of the k-means over all documents


@dataclass(frozen=True)
class Params:
    per_shard: int = 1 << 15
    per_chunk: int = 2000
    batch: int = 2048
    rate: float = 0.005
    map_rate: float = 0.02
    start_speed: float = 1e-4
    weight: float = 0.75
    flush: int = 400_000
    classes: int = 6  # eight at most
    class_sample: int = 3000  # documents that the k-means starts from; it runs on all
    class_prior: float = 1.0


@dataclass
class Bits:
    """The binary decisions of a list of words, in order: word number, value, gate parts, contexts."""
    word: np.ndarray
    bit: np.ndarray
    place: np.ndarray
    deep: np.ndarray       # numbers of the decisions whose prefix is longer than the longest table context
    slots: list[np.ndarray]
    prefix: np.ndarray     # of those decisions: 64-bit key of (whole prefix, bits so far)
    owner: np.ndarray      # of every byte that is coded: its word
    node: np.ndarray       # and the group of eight decisions that holds its own


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(31))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(29))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(32))


def decisions(words: list[bytes], only_deep: bool = False, bits: tuple[int, ...] = LEAST_BITS, shared: bool = False) -> Bits:
    """``only_deep``: just the decisions whose prefix is longer than the tables' contexts. ``bits``: of
    the tables' sizes. ``shared``: words that begin alike share the decisions on what they have in common."""
    coded = [w + b" " if w else b"\n" for w in words]
    sizes = np.array([len(w) for w in coded], np.int64)
    buf = np.frombuffer(b"".join(coded), np.uint8)
    n = len(buf)
    word = np.repeat(np.arange(len(words)), sizes)
    pos = np.arange(n) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    power, inverse = np.full(n + 1, P, U), np.full(n + 1, P_INVERSE, U)
    power[0] = inverse[0] = 1
    power, inverse = np.cumprod(power, dtype=U), np.cumprod(inverse, dtype=U)
    sums = np.concatenate([np.zeros(1, U), np.cumsum((buf.astype(U) + U(1)) * power[:n], dtype=U)])
    pick = np.flatnonzero(pos >= DEEP) if only_deep else np.arange(n)
    owner, node = word[pick], np.arange(len(pick))
    if shared:  # one byte for every distinct beginning of a word
        begin = pick - pos[pick]
        _, first, node = np.unique((sums[pick + 1] - sums[begin]) * inverse[begin] + pos[pick].astype(U) * U(0xD6E8FEB86659FD93),
                                   return_index=True, return_inverse=True)
        pick = pick[first]
    at, where = pos[pick], pick

    def context(length: np.ndarray) -> np.ndarray:
        begin = where - length
        return (sums[where] - sums[begin]) * inverse[begin] + length.astype(U) * U(0xD6E8FEB86659FD93)

    byte = buf[pick].astype(np.int64)
    t = np.arange(8)
    path = ((1 << t)[None, :] | (byte[:, None] >> (8 - t)[None, :])).astype(U)
    bit = (byte[:, None] >> (7 - t)[None, :] & 1).astype(np.uint8).ravel()

    def keys(length: np.ndarray, salt: int) -> np.ndarray:
        return ((mixed(context(length) + U(salt))[:, None] + path * U(0xC2B2AE3D27D4EB4F)) * U(P)).ravel()

    slots = [] if only_deep else [(keys(np.minimum(at, k), k) >> U(64 - size)).astype(np.int32) for (k, _), size in zip(ORDERS, bits)]
    deep = np.flatnonzero(np.repeat(at >= DEEP, 8))
    own = at >= DEEP
    where, path = where[own], path[own]
    return Bits(np.repeat(word[pick], 8), bit, np.tile(t, len(pick)), deep, slots, keys(at[own], 99), owner, node)


def occurrences(b: Bits, c: np.ndarray) -> np.ndarray:
    """How often every decision is made, when the words occur ``c`` times."""
    return np.repeat(np.bincount(b.node, c[b.owner], len(b.bit) // 8), 8)


class Counts:
    """Zeros and ones of the hashed tables; ``ones[k]`` and ``seen[k]`` are columns of the k-th table, whose
    two counts of a slot lie side by side."""

    def __init__(self, bits: tuple[int, ...] = LEAST_BITS):
        self.bits = bits
        self.both = [np.zeros((1 << size, 2), np.float32) for size in bits]
        self.seen, self.ones = ([x[:, i] for x in self.both] for i in (0, 1))

    def __getstate__(self):
        return self.bits, [[squeezed(np.ascontiguousarray(x)) for x in t] for t in (self.seen, self.ones)]

    def __setstate__(self, state):
        bits, tables = state
        self.__init__(bits)
        for own, packs in zip((self.seen, self.ones), tables):
            for x, pack in zip(own, packs):
                x[:] = unsqueezed(pack, len(x))


def pairs_at(both: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two counts at each place, fetched together."""
    got = both.view(np.int64).ravel().take(place).view(np.float32).reshape(-1, 2)
    return got[:, 0], got[:, 1]


def squeezed(x: np.ndarray) -> bytes:
    """Floats without loss: most are zero or small, so the bytes of one place go together."""
    return pa.compress(x.view(np.uint8).reshape(-1, 4).T.tobytes(), codec="zstd", asbytes=True)


def unsqueezed(x: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(x, 4 * n, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view(np.float32).ravel()


@dataclass
class Mixer:
    first: np.ndarray
    second: np.ndarray
    map: np.ndarray

    @classmethod
    def start(cls) -> Mixer:
        centres = 1 / (1 + np.exp(-(np.arange(BINS) - BINS // 2) / 2.0))
        first = np.zeros((GATES[0], INPUTS))
        for deep in (0, 1):  # trust the longest context the more, the more often it was seen
            for seen in range(SEEN):
                trust, k = 1 - 0.5 ** seen, len(ORDERS) - 1 + deep
                first[deep * SEEN + seen, k] = trust
                first[deep * SEEN + seen, k - 2 - deep:k] = (1 - trust) * np.array([0.3, 0.6, 0.1][-2 - deep:])
        return cls(first, np.zeros((GATES[1], INPUTS)), np.tile(centres, (GATES[0], 1)))

    def flat(self) -> np.ndarray:
        return np.concatenate([self.first.ravel(), self.second.ravel(), self.map.ravel()])

    @classmethod
    def of(cls, flat: np.ndarray) -> Mixer:
        a, b = GATES[0] * INPUTS, GATES[1] * INPUTS
        return cls(flat[:a].reshape(-1, INPUTS), flat[a:a + b].reshape(-1, INPUTS), flat[a + b:].reshape(-1, BINS))


class DeepCounts:
    """Training counts (all, ones) of the decisions on long prefixes, by 64-bit key. Most keys own a
    place of a directly addressed table; keys that share a place with its owner are kept sorted."""

    def __init__(self, words: list[bytes], c: np.ndarray, bits: int = 22):
        self.shift, parts_ = U(64 - bits), []
        self.owner = np.zeros(1 << bits, U)
        for at in range(0, len(words), 1 << 13):
            b = decisions(words[at:at + (1 << 13)], only_deep=True, shared=True)
            w = occurrences(b, c[at:at + (1 << 13)])
            use = w > 0
            parts_.append((b.prefix[use], w[use].astype(np.float32), b.bit[use]))
            self.owner[self.place(parts_[-1][0])] = parts_[-1][0]
        self.both = np.zeros((1 << bits, 2), np.float32)
        rest = []
        for key, w, bit in parts_:
            place = self.place(key)
            mine = self.owner[place] == key
            np.add.at(self.both[:, 0], place[mine], w[mine])
            np.add.at(self.both[:, 1], place[mine], w[mine] * bit[mine])
            rest.append((key[~mine], w[~mine], w[~mine] * bit[~mine]))
        key, w, w1 = (np.concatenate(x) for x in zip(*rest)) if rest else (np.zeros(0, U), np.zeros(0), np.zeros(0))
        self.keys, inv = np.unique(key, return_inverse=True)
        self.rest = np.bincount(inv, w, len(self.keys)), np.bincount(inv, w1, len(self.keys))

    def place(self, key: np.ndarray) -> np.ndarray:
        return (key >> self.shift).astype(np.int64)

    def get(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        place = self.place(key)
        mine = self.owner[place] == key
        seen, ones = (np.where(mine, x, 0) for x in pairs_at(self.both, place))
        other = np.flatnonzero(~mine)
        if len(self.keys) and len(other):
            at = np.minimum(np.searchsorted(self.keys, key[other]), len(self.keys) - 1)
            hit = self.keys[at] == key[other]
            seen[other[hit]], ones[other[hit]] = self.rest[0][at[hit]], self.rest[1][at[hit]]
        return seen, ones


def inputs(b: Bits, tables: Counts, deep: DeepCounts, without: float = 0.0):
    """Logits of all predictors (events x INPUTS) and the two gates. ``without``: 1 where every word's
    own occurrence is to be left out."""
    own = b.bit.astype(np.float32) * np.float32(without)

    def logit(seen, ones, own):
        if without:
            seen, ones = np.maximum(seen - np.float32(without), 0), ones - own
        ones = np.clip(ones, 0, seen)
        return np.log((ones + np.float32(0.05)) / (seen - ones + np.float32(0.05))), seen

    x = np.zeros((len(b.bit), INPUTS), np.float32)
    for k in range(len(ORDERS)):
        x[:, k], longest = logit(*pairs_at(tables.both[k], b.slots[k]), own)
    x[b.deep, -2], longest[b.deep] = logit(*deep.get(b.prefix), own[b.deep])
    x[:, -1] = 0.3
    g1 = np.minimum(np.log2(longest + 1).astype(np.intp), SEEN - 1)
    g1[b.deep] += SEEN
    g2 = b.place * 4 + ((longest >= 1).astype(np.intp) + (longest >= 16) + (longest >= 256))
    return np.clip(x, -12, 12, out=x), g1, g2


def mixed_logit(m: Mixer, x: np.ndarray, g1: np.ndarray, g2: np.ndarray):
    """Mixed logit and its bin of the map. The weights of both gates are added once for every pair of gates."""
    both = (m.first.astype(np.float32)[:, None] + m.second.astype(np.float32)).reshape(-1, INPUTS)
    z = np.einsum("ij,ij->i", both.take(g1 * GATES[1] + g2, axis=0), x)
    z = np.minimum(np.maximum(z, np.float32(-15)), np.float32(15))
    bins = np.minimum(np.maximum(np.rint(z * 2).astype(np.intp) + BINS // 2, 0), BINS - 1)
    return z.astype(np.float64), bins


def predict(m: Mixer, x: np.ndarray, g1: np.ndarray, g2: np.ndarray):
    """Mixed logit, its bin of the map, and the refined probability of a one."""
    z, bins = mixed_logit(m, x, g1, g2)
    p = (1 - MAP_SHARE) / (1 + np.exp(-z)) + MAP_SHARE * m.map.ravel().take(g1 * BINS + bins)
    return z, bins, np.clip(p, 1e-6, 1 - 1e-6)


def learn(m: Mixer, x, g1, g2, bit, weight, speed, p: Params) -> None:
    """One online step on a batch: weights by the gradient of the coding cost, the map towards the
    bits seen, both in proportion to the events' weights."""
    z, bins = mixed_logit(m, x, g1, g2)
    share = weight / weight.sum()
    g = ((1 / (1 + np.exp(-z)) - bit) * share)[:, None] * x
    cells = ((g1 * GATES[1] + g2) * INPUTS)[:, None] + np.arange(INPUTS)
    sums = np.bincount(cells.ravel(), g.ravel(), GATES[0] * GATES[1] * INPUTS).reshape(*GATES, INPUTS)
    for k, table in enumerate((m.first, m.second)):
        step = sums.sum(axis=1 - k)
        speed[k] += step * step
        table -= p.rate * step / np.sqrt(speed[k])
    cell = g1 * BINS + bins
    mass = np.bincount(cell, weight, GATES[0] * BINS)
    mean = np.bincount(cell, weight * bit, GATES[0] * BINS)
    some = mass > 0
    flat = m.map.ravel()
    events = np.bincount(cell, minlength=GATES[0] * BINS)[some]
    flat[some] += (1 - (1 - p.map_rate) ** np.minimum(events, 50)) * (mean[some] / mass[some] - flat[some])


def train_shard(words: list[bytes], c: np.ndarray, tables: Counts, p: Params) -> tuple[np.ndarray, np.ndarray]:
    """The mixer learned on one shard and, per parameter, how many events its gate has seen."""
    m, deep = Mixer.start(), DeepCounts(words, c)
    order = sorted((i for i in range(len(words)) if c[i] > 0), key=lambda i: xxhash.xxh64_intdigest(words[i], 7))
    used = [np.zeros(GATES[0]), np.zeros(GATES[1])]
    speed = [np.full((g, INPUTS), p.start_speed) for g in GATES]
    for block in range(0, len(order), 1 << 12):
        part = order[block:block + (1 << 12)]
        b = decisions([words[i] for i in part], bits=tables.bits, shared=True)
        x, g1, g2 = inputs(b, tables, deep, 1.0)
        weight = c[part].astype(float) ** p.weight
        ends = np.searchsorted(b.owner, np.arange(0, len(part) + (1 << 10), 1 << 10))
        for at, (begin, end) in zip(range(block, len(order), 1 << 10), zip(ends, ends[1:])):
            mixed_up = np.random.default_rng(at).permutation((end - begin) * 8)
            own, place = begin + (mixed_up >> 3), mixed_up & 7
            event = b.node[own] * 8 + place
            events = x.take(event, axis=0), g1[event], g2[event], b.bit[event], weight[b.owner[own]]
            for i in range(0, len(event), p.batch):
                learn(m, *(e[i:i + p.batch] for e in events), speed, p)
            used[0] += np.bincount(events[1], minlength=GATES[0])
            used[1] += np.bincount(events[2], minlength=GATES[1])
    mass = np.concatenate([np.repeat(used[0], INPUTS), np.repeat(used[1], INPUTS), np.repeat(used[0], BINS)])
    return m.flat(), mass


def log10_probabilities(words: list[bytes], tables: Counts, deep, m: Mixer) -> np.ndarray:
    out = np.zeros(len(words))
    for at in range(0, len(words), 1 << 12):
        part = words[at:at + (1 << 12)]
        b = decisions(part, bits=tables.bits, shared=True)
        _, _, p = predict(m, *inputs(b, tables, deep))
        logs = np.log10(np.where(b.bit == 1, p, 1 - p)).reshape(-1, 8).sum(axis=1)
        out[at:at + len(part)] = np.bincount(b.owner, logs[b.node], len(part))
    return out


PORTION = 1 << 23  # bytes of text taken apart at a time
SPACES = b" \t\n\x0b\x0c\r"
LOWER = bytes(range(256)).lower()


def token_arrays(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """The tokens of all texts: where each text's begin, the number of each token, the distinct tokens by number."""
    col = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    raw = bytes(memoryview(col.buffers()[2] or b"")[offsets[0]:offsets[-1]])
    edges, x = offsets - offsets[0], np.frombuffer(raw, np.uint8)
    inside = np.zeros(len(x) + 2, bool)
    inside[1:-1] = (x != 32) & (x - np.uint8(9) > 4)
    begins, ends = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
    inner = edges[(edges > 0) & (edges < len(x))]  # a text's edge parts words
    begins[inner], ends[inner - 1] = inside[inner + 1], inside[inner]
    begin, end = np.flatnonzero(begins), np.flatnonzero(ends)
    before = np.searchsorted(begin, edges)  # words before each text
    place = np.concatenate([np.zeros(1, np.int64), np.cumsum(end - begin + 1)])  # of the words, once the white space is gone
    first = before + np.arange(len(before))
    start = np.empty(len(begin) + len(texts) + 1, np.int64)  # words and ends (empty) in order, then where the last one ends
    start[np.arange(len(begin)) + np.repeat(np.arange(len(texts)), np.diff(before))] = place[:-1]
    start[first[1:] - 1], start[-1] = place[before[1:]], place[-1]
    coded = pa.Array.from_buffers(pa.large_binary(), len(start) - 1,
                                  [None, pa.py_buffer(start), pa.py_buffer(raw.translate(LOWER, SPACES))]).dictionary_encode()
    return first[:-1], coded.indices.to_numpy(), coded.dictionary


def byte_list(words) -> list[bytes]:
    return words.to_numpy(zero_copy_only=False).tolist() if isinstance(words, pa.Array) else words.to_numpy().tolist()


def word_keys(words) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, byte_list(words)), U, len(words)).view(np.int64)


def portions(batches, rows: int, size: int = PORTION):
    """The same rows in batches of at most ``rows`` rows and about ``size`` bytes of text."""
    for b in pieces(batches, rows):
        held = np.cumsum(pc.fill_null(pc.binary_length(b["text"]), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < b.num_rows:
            end = max(at + 1, int(np.searchsorted(held, (held[at - 1] if at else 0) + size, "right")))
            yield b.slice(at, end - at)
            at = end


def near_ids(docs: DataFrame, per_chunk: int) -> DataFrame:
    """``docs`` plus ``_chunk``: ranges of ids with about ``per_chunk`` rows each; a range with more than
    twice as many (crowded or repeated ids) is dealt over several chunks by the text's hash."""
    lo, hi, n = docs.agg(F.min("doc_id"), F.max("doc_id"), F.count("*")).first()
    width = max(1, ((hi or 0) - (lo or 0) + 1) * per_chunk // max(1, n))
    ranged = docs.withColumn("_range", F.coalesce(F.floor((F.col("doc_id") - (lo or 0)) / F.lit(width)), F.lit(-1)))
    crowd = materialize(ranged.groupBy("_range").agg(F.count("*").alias("n")).where(F.col("n") > 2 * per_chunk)
                        .select("_range", F.ceil(F.col("n") / per_chunk).alias("_ways")), "crowded")
    return ranged.join(crowd, "_range", "left").withColumn("_chunk", F.xxhash64(
        "_range", F.pmod(F.xxhash64("text"), F.coalesce("_ways", F.lit(1))))).drop("_range", "_ways")


def profile(text: bytes) -> np.ndarray:
    """Relative byte frequencies of the text, square-rooted to unit length."""
    n = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    return np.sqrt(n / max(1, len(text)))


def refined(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums (in whole ``PROFILE_UNITS``) and nearest classes of the packed profiles ``x``."""
    near = (x @ centres.T).argmax(axis=1)
    return ((near == np.arange(len(centres))[:, None]).astype(np.float64) @ x).astype(np.int64), near  # exact: whole, below 2^53


def unit(sums: np.ndarray, old: np.ndarray) -> np.ndarray:
    """Class sums as centres of unit length; a class without documents keeps its centre."""
    length = np.linalg.norm(sums.astype(np.float64), axis=1, keepdims=True)
    return np.where(length > 0, sums / np.maximum(length, 1), old)


def first_centres(x: np.ndarray, classes: int) -> np.ndarray:
    """Where the k-means over all documents starts: farthest first, then k-means on the packed profiles ``x``."""
    centres = unit(x[:1], np.zeros((1, 256)))
    while len(centres) < min(classes, len(x)):
        centres = np.vstack([centres, unit(x[(x @ centres.T).max(axis=1).argmin()][None], np.zeros((1, 256)))])
    for _ in range(30):
        centres = unit(refined(x, centres)[0], centres)
    return centres


def class_centres(docs: DataFrame, p: Params) -> np.ndarray:
    """k-means on the profiles of all training documents, one job a round, until no centre moves; it starts
    from the centres of a bounded sample. Sums are whole numbers, so the order of the tasks does not matter."""
    def pack(batches):
        for b in pieces(batches, 1000):
            if b.num_rows:  # byte by byte: those that no text has take no room
                x = np.stack([np.round(profile(x) * PROFILE_UNITS).astype(np.uint16) for x in raw_bytes(b["text"])])
                yield pa.record_batch([pa.array([pa.compress(x.T.tobytes(), codec="lz4", asbytes=True)], pa.binary()),
                                       pa.array([b["draw"].to_pylist()], pa.list_(pa.int32())), pa.array([len(x)], pa.int32())],
                                      names=["profiles", "draws", "n"])

    def unpack(b: pa.RecordBatch):
        for profiles, n in zip(b["profiles"].to_pylist(), b["n"].to_pylist()):
            yield np.frombuffer(pa.decompress(profiles, 512 * n, codec="lz4", asbytes=True), np.uint16).reshape(256, n).T

    def apart(batches):
        for b in batches:
            for x, draws in zip(unpack(b), b["draws"].to_pylist()):
                yield pa.record_batch([pa.array([row.tobytes() for row in x], pa.binary()), pa.array(draws, pa.int32())],
                                      names=["profile", "draw"])

    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)).cast("int").alias("draw")
    stored = materialize(docs.where("NOT held_out AND text <> ''").select("text", draw)
                         .mapInArrow(pack, "profiles binary, draws array<int>, n int"), "class-profiles")
    single = stored.mapInArrow(apart, "profile binary, draw int")

    def matrix(packs) -> np.ndarray:
        return np.frombuffer(b"".join(packs), np.uint16).reshape(-1, 256).astype(np.float64)

    share = min(1.0, p.class_sample / max(1, stored.agg(F.sum("n")).first()[0] or 0))
    some = sorted(r["profile"] for r in single.where(F.col("draw") < share * (1 << 30)).select("profile").collect()) \
        or [r["profile"] for r in single.orderBy("draw", "profile").limit(1).collect()]
    if not some:
        return np.zeros((1, 256))
    centres = first_centres(matrix(some), p.classes)
    for _ in range(CLASS_ROUNDS):
        def add(batches, centres=centres):
            sums = np.zeros((len(centres), 256), np.int64)
            for b in batches:
                for x in unpack(b):
                    sums += refined(x.astype(np.float64), centres)[0]
            yield pa.record_batch([pa.array(range(len(sums)), pa.int32()), pa.array(sums.tolist())], names=["k", "sums"])

        each = stored.select("profiles", "n").mapInArrow(add, "k int, sums array<long>").select("k", F.posexplode("sums").alias("at", "v"))
        total = np.zeros((len(centres), 256))
        for r in each.groupBy("k", "at").agg(F.sum("v").alias("v")).collect():  # classes times 256
            total[r["k"], r["at"]] = r["v"]
        before, centres = centres, unit(total, centres)
        if np.abs(centres - before).max() < 1e-4:
            break
    return centres


def count_words(docs: DataFrame, centres, p: Params) -> DataFrame:
    """(word, c, by): every distinct token, its count in the rows that are not held out, and that
    count by class."""
    k = len(centres.value)
    names = [f"n{i}" for i in range(k)]

    def words(batches):
        open_: list[pa.RecordBatch] = []
        for b in portions(batches, 1 << 30):
            if open_ and sum(x["text"].nbytes for x in open_) + b["text"].nbytes > PORTION:
                yield from pieces([emit(open_)], 1 << 15)
                open_ = []
            open_.append(b)
        if open_:
            yield from pieces([emit(open_)], 1 << 15)

    def emit(batches):
        t = pa.Table.from_batches(batches).combine_chunks()
        text = t["text"].combine_chunks()
        first, token, distinct = token_arrays(text)
        out = t["held_out"].to_pylist()
        kind = np.array([k if o else int((centres.value @ profile(x)).argmax()) for o, x in zip(out, raw_bytes(text))], np.int64)
        kind = np.repeat(kind, np.diff(first, append=len(token)))  # held-out texts only name their words
        c = [np.bincount(token[kind == i], minlength=len(distinct)) for i in range(k)]
        return pa.record_batch([distinct.cast(pa.binary()), *map(pa.array, c)], names=["word", *names])

    sums = [F.sum(c).alias(c) for c in names]
    return docs.select("held_out", "text").mapInArrow(words, "word binary, " + ", ".join(f"{c} long" for c in names)) \
        .groupBy("word").agg(*sums).select("word", sum((F.col(c) for c in names), F.lit(0)).alias("c"),
                                           F.array(*names).alias("by"))


STEPS = 16  # a class scale is stored as a power of two in sixteenths


def class_scales(c: np.ndarray, by: np.ndarray, shares: np.ndarray, prior: float) -> np.ndarray:
    """Per word and class: log2 of how much likelier the class makes the word, in steps, as int8."""
    ratio = (by + prior * shares) / ((c + prior)[:, None] * shares)
    return np.clip(np.rint(np.log2(ratio) * STEPS), -128, 127).astype(np.int8)


def packed(scales: np.ndarray) -> np.ndarray:
    """Up to eight scales of a word as one long."""
    out = np.zeros((len(scales), 8), np.int8)
    out[:, :scales.shape[1]] = scales
    return out.view(np.int64).ravel()


def unpacked(column: pa.Array, k: int) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).view(np.int8).reshape(-1, 8)[:, :k]


BLOCK = 1 << 12


SLOTS = 2  # least slots of a table for every distinct (context, byte)
SKETCH = 1024


def context_keys(words: list[bytes]) -> list[np.ndarray]:
    """Per order, uniform 64-bit keys of every byte's (context, byte)."""
    buf, sizes = b"".join(w + b" " if w else b"\n" for w in words), [len(w) + 1 if w else 1 for w in words]
    x, n = np.frombuffer(buf, np.uint8).astype(U) + U(1), np.array(sizes, np.int64)
    pos = np.arange(len(x)) - np.repeat(np.cumsum(n) - n, n)
    out = []
    for k, _ in ORDERS:
        key = x.copy()
        for back in range(1, k + 1):  # a context that the word's start cuts off is one of its own
            before = np.concatenate([np.zeros(min(back, len(x)), U), x[:-back]])
            key = key + np.where(pos >= back, before, U(0)) * U(pow(257, back))
        out.append(mixed(key * U(P)))
    return out


def distinct_estimate(smallest: np.ndarray) -> float:
    """How many distinct keys there are, from the ``SKETCH`` smallest (all, if fewer)."""
    return len(smallest) if len(smallest) < SKETCH else (SKETCH - 1) / (float(smallest[-1]) / 2.0 ** 64)


def table_bits(types: DataFrame) -> tuple[int, ...]:
    """Bits of the tables' sizes from the distinct (context, byte) of the training words, counted by the
    smallest hashes of every task."""
    def sketch(batches):
        low = [np.zeros(0, U)] * len(ORDERS)
        for b in pieces(batches, 1 << 13):
            words = byte_list(b["word"])
            if words:
                low = [np.unique(np.concatenate([a, x]))[:SKETCH] for a, x in zip(low, context_keys(words))]
        yield pa.record_batch([pa.array(np.arange(len(ORDERS), dtype=np.int32)),
                               pa.array([x.tobytes() for x in low], pa.binary())], names=["k", "low"])

    def merge(t: pa.Table) -> pa.Table:
        low = np.unique(np.concatenate([np.frombuffer(x, U) for x in t["low"].to_pylist()]))[:SKETCH]
        return pa.table({"k": t["k"].slice(0, 1), "low": pa.array([low.tobytes()], pa.binary())})

    schema = "k int, low binary"
    got = {r["k"]: distinct_estimate(np.frombuffer(r["low"], U)) for r in types.where("c > 0").select("word")
           .mapInArrow(sketch, schema).groupBy("k").applyInArrow(merge, schema).collect()}
    return tuple(max(least, math.ceil(math.log2(SLOTS * got.get(k, 0) + 1))) for k, least in enumerate(LEAST_BITS))


def hashed_tables(types: DataFrame, bits: tuple[int, ...] = LEAST_BITS) -> Counts:
    """The hashed tables. Every task sums its words into tables of its own and sends them in blocks,
    which are added up by block; the driver holds one set of tables."""
    def add(batches):
        own = Counts(bits)
        for b in pieces(batches, 1 << 13):
            words, c = byte_list(b["word"]), b["c"].to_numpy()
            if words:
                d = decisions(words, bits=bits, shared=True)
                w = occurrences(d, c).astype(np.float32)
                w1 = w * d.bit
                for k, slots in enumerate(d.slots):
                    np.add.at(own.seen[k], slots, w)
                    np.add.at(own.ones[k], slots, w1)
        for k in range(len(ORDERS)):
            seen, ones = own.seen[k].reshape(-1, BLOCK), own.ones[k].reshape(-1, BLOCK)
            some = np.flatnonzero(seen.any(axis=1))
            for i in range(0, len(some), 256):
                part = some[i:i + 256]
                yield pa.record_batch([
                    pa.array(np.full(len(part), k, np.int32)), pa.array(part.astype(np.int32)),
                    pa.array([squeezed(np.concatenate([seen[j], ones[j]])) for j in part], pa.binary())],
                    names=["k", "block", "sums"])

    def total(t: pa.Table) -> pa.Table:
        sums = sum(unsqueezed(x, 2 * BLOCK).astype(np.float64) for x in t["sums"].to_pylist())
        return pa.table({"k": t["k"].slice(0, 1), "block": t["block"].slice(0, 1),
                         "sums": pa.array([squeezed(sums.astype(np.float32))], pa.binary())})

    schema, out = "k int, block int, sums binary", Counts(bits)
    rows = types.where("c > 0").select("word", "c").mapInArrow(add, schema).groupBy("k", "block").applyInArrow(total, schema)
    for r in rows.toLocalIterator():
        at = slice(r["block"] * BLOCK, (r["block"] + 1) * BLOCK)
        out.seen[r["k"]][at], out.ones[r["k"]][at] = unsqueezed(r["sums"], 2 * BLOCK).reshape(2, BLOCK)
    return out


def learn_mixer(sharded: DataFrame, tables, p: Params) -> Mixer:
    """Average of the shards' mixers, each parameter weighted by the events behind it."""
    def train(t: pa.Table) -> pa.Table:
        t = t.sort_by("word")  # words that begin alike come together
        flat, mass = train_shard(byte_list(t["word"]), t["c"].to_numpy(), tables.value, p)
        return pa.table({"i": pa.array(np.arange(len(flat), dtype=np.int32)), "v": flat * mass, "n": mass})

    rows = sharded.groupBy("shard").applyInArrow(train, "i int, v double, n double") \
        .groupBy("i").agg(F.sum("v").alias("v"), F.sum("n").alias("n")).toPandas()  # one row per parameter
    flat = Mixer.start().flat()
    some = rows[rows["n"] > 0]
    flat[some["i"]] = np.round(some["v"] / some["n"], 6)  # the order of summation leaves no trace
    return Mixer.of(flat)


def class_norms(rated: DataFrame, k: int) -> np.ndarray:
    """log10 of every class's sum over all words: the scaled words of the table and, at scale one, all
    words that are not in it."""
    def sums(batches):
        for b in batches:
            p_ = 10 ** b["lp"].to_numpy().astype(np.float64)
            scales = unpacked(b["scales"], k)
            yield pa.record_batch([pa.array([*(p_ @ 2.0 ** (scales / STEPS)), p_.sum()]),
                                   pa.array(np.arange(k + 1, dtype=np.int32))], names=["z", "i"])

    got = {r["i"]: r["z"] for r in rated.select("lp", "scales").mapInArrow(sums, "z double, i int")
           .groupBy("i").agg(F.sum("z").alias("z")).collect()}
    rest = max(0.0, 1 - got.get(k, 0.0))
    return np.round(np.log10([got.get(i, 0.0) + rest for i in range(k)]), 9)


def score(docs: DataFrame, held_out: Column, p: Params = Params(), text: str = "text",
          doc_id: str = "doc_id") -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10),
    n_bytes, bits_per_byte. ``held_out``: condition on ``doc_id``; those rows teach nothing."""
    spark = docs.sparkSession
    base = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).withColumn("held_out", held_out)
    centres = spark.sparkContext.broadcast(class_centres(base, p))
    types = materialize(count_words(base, centres, p), "words")
    k = len(centres.value)
    total = types.agg(F.sum("c").alias("n"), F.count_if(F.col("c") > 0).alias("v"), F.count("*").alias("t"),
                      *[F.sum(F.col("by")[i]).alias(f"k{i}") for i in range(k)]).first()
    train_tokens, known, shards = total["n"] or 0, total["v"], parts(total["t"], p.per_shard)
    shares = np.array([(total[f"k{i}"] or 0) + 1.0 for i in range(k)])
    shares /= shares.sum()
    tables = spark.sparkContext.broadcast(hashed_tables(types, table_bits(types)))
    sharded = types.withColumn("shard", F.pmod(F.xxhash64(F.substring("word", 1, DEEP)), F.lit(shards)).cast("int"))
    mixer = spark.sparkContext.broadcast(learn_mixer(sharded, tables, p))

    def rate(t: pa.Table) -> pa.Table:
        t = t.sort_by("word")  # words that begin alike come together
        words, c = byte_list(t["word"]), t["c"].to_numpy()
        lp = log10_probabilities(words, tables.value, DeepCounts(words, c), mixer.value)
        by = t["by"].combine_chunks().flatten().to_numpy().reshape(len(words), k)
        scales = class_scales(c, by, shares, p.class_prior)
        return pa.table({"key": word_keys(t["word"]), "c": t["c"],
                         "lp": pa.array(lp.astype(np.float32)),
                         "scales": packed(scales)})

    rated = materialize(sharded.groupBy("shard").applyInArrow(rate, "key long, c long, lp float, scales long"),
                        "word-scores")
    norms = class_norms(rated, k)
    chunked = near_ids(base, p.per_chunk)

    def ask(batches):
        open_: dict[int, list[np.ndarray]] = {}
        size = 0
        for b in portions(batches, p.per_chunk):
            b = b.take(pc.sort_indices(b["_chunk"]))
            first, token, distinct = token_arrays(b["text"])
            keys = word_keys(distinct)
            chunks, begin = np.unique(b["_chunk"].to_numpy(), return_index=True)
            for chunk, own in zip(chunks.tolist(), np.split(token, first[begin[1:]])):
                own = np.flatnonzero(np.bincount(own)) if len(own) > len(keys) >> 3 else np.unique(own)
                open_.setdefault(chunk, []).append(keys[own])
                size += len(own)
            if size > p.flush:
                yield from send(open_)
                open_, size = {}, 0
        yield from send(open_)

    def send(open_):
        own = [x[0] if len(x) == 1 else np.unique(np.concatenate(x)) for x in open_.values()]
        if own:
            yield pa.record_batch([pa.array(np.repeat(np.array(list(open_), np.int64), list(map(len, own)))),
                                   pa.array(np.concatenate(own))], names=["_chunk", "key"])

    asked = chunked.select("_chunk", "text").mapInArrow(ask, "_chunk long, key long")
    answers = asked.join(rated, "key").select("_chunk", "key", "c", "lp", "scales")
    floor, log_shares = math.log10(train_tokens + known + 1), np.log10(shares)
    id_type = dict(base.dtypes)["doc_id"]

    def add(rows: pa.Table, words: pa.Table) -> pa.Table:
        order = np.argsort(words["key"].to_numpy())
        key, c, lp = (words[n].to_numpy()[order] for n in ("key", "c", "lp"))
        scales = unpacked(words["scales"].combine_chunks(), k)[order] * (math.log10(2) / STEPS)
        values = np.vstack([c > 0, np.log10(c + 1.0) - floor, (lp.astype(np.float64)[:, None] + scales - norms).T])
        return pa.concat_tables([pa.Table.from_batches([part(b, key, values)])
                                 for b in portions(rows.combine_chunks().to_batches(), rows.num_rows)])

    def part(b: pa.RecordBatch, key: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
        first, token, distinct = token_arrays(b["text"])
        own = values[:, np.searchsorted(key, word_keys(distinct))]
        sums = [np.add.reduceat(v[token], first) for v in own]
        logs = np.column_stack(sums[2:]) + log_shares
        best = logs.max(axis=1)
        model = best + np.log10((10 ** (logs - best[:, None])).sum(axis=1))
        size = pc.fill_null(pc.binary_length(b["text"]), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        bits = np.divide(-model * math.log2(10), size, out=np.zeros(len(size)), where=size > 0)
        return pa.record_batch({"doc_id": b["doc_id"], "held_out": b["held_out"], "n_tokens": np.diff(first, append=len(token)),
                                "n_known": sums[0].astype(np.int64), "train_tokens": np.full(len(size), train_tokens, np.int64),
                                "base_score": sums[1], "score": model, "n_bytes": size,
                                "bits_per_byte": pa.array(bits, mask=size == 0)})

    return chunked.groupBy("_chunk").cogroup(answers.groupBy("_chunk")).applyInArrow(
        add, f"doc_id {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
             "score double, n_bytes long, bits_per_byte double")
