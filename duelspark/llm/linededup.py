"""Line dedup through a sharded minimal perfect hash over the distinct line hashes.

A line's key is the line without ASCII white space at both ends, A-Z lower-cased; a key has a
128-bit hash. A key of at least ``min_chars`` code points that occurs in at least ``min_docs``
documents loses all its lines in every document; all other lines stay.

1. Count: every document gives its distinct key hashes; a grouped count (partial sums first)
   gives the documents per key.
2. Index: the counted keys are dealt into shards of about ``per_shard`` keys. A shard is one row:
   the bit arrays of a minimal perfect hash (each level takes the keys that fall alone on a
   position, the others go to the next), and at each key's slot a 32-bit fingerprint and the
   count. Keys that no level has placed are listed beside the arrays with all their bits.
3. Probe: documents are grouped into chunks; each chunk's distinct hashes visit their shards once,
   so a line that a third of the documents share is probed once per chunk, not per document. A
   probe compares the slot's fingerprint and returns the keys to drop.
4. Rewrite: a chunk of whole texts meets its own list of keys to drop.

Lines are never joined with lines, and no index leaves its shard. Edge cases: a null or empty
text is one empty line (never dropped, since ``min_chars`` is at least 1); a text that loses all
lines becomes empty; repeated rows count as documents of their own; extra columns are kept.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunked_by_rows, materialize, numbered, parts, pieces, raw_bytes, schema_with

SPACE = b" \t\n\x0b\x0c\r"
GAMMA = 2.0
LEVELS = 24


@dataclass(frozen=True)
class Params:
    min_docs: int = 10
    min_chars: int = 1
    per_shard: int = 1 << 16
    per_chunk: int = 512


def line_hash(line: bytes, min_chars: int = 1) -> bytes | None:
    """16 hash bytes of a line's key; None for a key that is too short to drop."""
    key = line.strip(SPACE).lower()
    if len(key) < min_chars or (min_chars > 1 and len(key.decode()) < min_chars):
        return None
    return xxhash.xxh3_128_digest(key)


def halves(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)


def mix(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    """Position of each (hi, lo) key on a level of ``size`` positions."""
    x = (keys[:, 0] ^ (keys[:, 1] * np.uint64(0x9E3779B97F4A7C15))) + np.uint64(level * 0xD1B54A32D192ED03 % (1 << 64))
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(32))) % np.uint64(size)).astype(np.int64)


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (keys[:, 1] & np.uint64(0xFFFFFFFF)).astype(np.uint32)


@dataclass
class PerfectHash:
    """Slots 0..n-1 for n keys: level sizes, their bits end to end, and the keys left over."""
    sizes: np.ndarray
    bits: np.ndarray       # packed
    left: np.ndarray       # (m, 2) keys without a place; they take the last m slots

    def __post_init__(self):
        self.flat = np.unpackbits(self.bits, count=int(self.sizes.sum())) if len(self.sizes) else np.zeros(0, np.uint8)
        self.rank = np.cumsum(self.flat, dtype=np.int64) - self.flat
        self.placed = int(self.flat.sum())
        self.extra = {bytes(k): self.placed + i for i, k in enumerate(self.left)}

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        sizes, bits, rest = [], [], keys
        for level in range(LEVELS):
            if not len(rest):
                break
            size = max(8, int(len(rest) * GAMMA))
            at = mix(rest, level, size)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            bits.append(alone)
            rest = rest[~alone[at]]
        packed = np.packbits(np.concatenate(bits)) if bits else np.zeros(0, np.uint8)
        return cls(np.array(sizes, np.int64), packed, np.ascontiguousarray(rest))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of every key of the set; for other keys some slot, or -1."""
        out, open_, base = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            if not len(open_):
                break
            at = base + mix(keys[open_], level, int(size))
            hit = self.flat[at] == 1
            out[open_[hit]] = self.rank[at[hit]]
            open_, base = open_[~hit], base + int(size)
        for i in open_ if self.extra else ():
            out[i] = self.extra.get(bytes(keys[i]), -1)
        return out


INDEX = "shard int, sizes binary, bits binary, rest binary, fingerprint binary, count binary"


def build_shard(table: pa.Table) -> pa.Table:
    keys = np.stack([table["hi"].to_numpy(), table["lo"].to_numpy()], axis=1).view(np.uint64)
    h = PerfectHash.build(keys)
    slot = h.slots(keys)
    prints, counts = np.zeros(len(keys), np.uint32), np.zeros(len(keys), np.int64)
    prints[slot], counts[slot] = fingerprints(keys), table["n"].to_numpy()
    arrays = (h.sizes, h.bits, h.left, prints, counts)
    names = ("sizes", "bits", "rest", "fingerprint", "count")
    return pa.table({"shard": table["shard"].slice(0, 1)}
                    | {k: pa.array([a.tobytes()], pa.binary()) for k, a in zip(names, arrays)})


def open_shard(index: pa.Table) -> tuple[PerfectHash, np.ndarray, np.ndarray]:
    raw = {k: index[k][0].as_py() for k in ("sizes", "bits", "rest", "fingerprint", "count")}
    h = PerfectHash(np.frombuffer(raw["sizes"], np.int64), np.frombuffer(raw["bits"], np.uint8),
                    np.frombuffer(raw["rest"], np.uint64).reshape(-1, 2))
    return h, np.frombuffer(raw["fingerprint"], np.uint32), np.frombuffer(raw["count"], np.int64)


def line_counts(docs: DataFrame, text: str, p: Params) -> DataFrame:
    """(hi, lo, n): documents per key."""
    def hashes(batches):
        for b in pieces(batches, 1000):
            found = [h for x in raw_bytes(b[text])
                     for h in {line_hash(line, p.min_chars) for line in x.split(b"\n")} if h]
            k = halves(found)
            yield pa.record_batch([pa.array(k[:, 0]), pa.array(k[:, 1])], names=["hi", "lo"])

    return docs.select(text).mapInArrow(hashes, "hi long, lo long").groupBy("hi", "lo").agg(F.count("*").alias("n"))


def line_index(counts: DataFrame, p: Params) -> tuple[DataFrame, int]:
    """One row per shard (``INDEX``) and the number of shards."""
    n = parts(counts.count(), p.per_shard)
    rows = counts.withColumn("shard", F.pmod("hi", F.lit(n)).cast("int"))
    return materialize(rows.groupBy("shard").applyInArrow(build_shard, INDEX), "line-index"), n


def drop_common_lines(docs: DataFrame, p: Params = Params(), text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with the kept text in ``text`` (a null text stays null), and n_lines, n_dropped
    (they replace columns of the same name)."""
    docs = docs.drop("n_lines", "n_dropped")
    named = docs.columns
    docs, (text, doc_id) = numbered(docs, text, doc_id)
    index, shards = line_index(materialize(line_counts(docs, text, p), "line-counts"), p)
    chunked, _ = chunked_by_rows(docs, p.per_chunk, doc_id, text)

    def probes(batches):
        for b in pieces(batches, 1000):
            chunk = b["_chunk"].to_pylist()
            pairs = {(c, h) for c, x in zip(chunk, raw_bytes(b[text]))
                     for h in {line_hash(line, p.min_chars) for line in x.split(b"\n")} if h}
            k = halves([h for _, h in pairs])
            yield pa.record_batch([pa.array([c for c, _ in pairs], pa.int32()), pa.array(k[:, 0]), pa.array(k[:, 1])],
                                  names=["_chunk", "hi", "lo"])

    def answer(probe: pa.Table, shard: pa.Table) -> pa.Table:
        keys = np.stack([probe["hi"].to_numpy(), probe["lo"].to_numpy()], axis=1).view(np.uint64)
        drop = np.zeros(len(keys), bool)
        if len(keys) and shard.num_rows:
            h, prints, counts = open_shard(shard)
            slot = h.slots(keys)
            known = slot >= 0
            known[known] = prints[slot[known]] == fingerprints(keys[known])
            drop[known] = counts[slot[known]] >= p.min_docs
        return probe.select(["_chunk", "hi", "lo"]).filter(pa.array(drop))

    asked = chunked.select("_chunk", text).mapInArrow(probes, "_chunk int, hi long, lo long").distinct() \
        .withColumn("shard", F.pmod("hi", F.lit(shards)).cast("int"))
    dropped = asked.groupBy("shard").cogroup(index.groupBy("shard")).applyInArrow(answer, "_chunk int, hi long, lo long")
    names, out = docs.columns, schema_with(docs, n_lines="long", n_dropped="long")

    def rewrite(rows: pa.Table, drop: pa.Table) -> pa.Table:
        packed = np.stack([drop["hi"].to_numpy(), drop["lo"].to_numpy()], axis=1).tobytes()
        gone = {packed[i:i + 16] for i in range(0, len(packed), 16)}
        texts, lines, lost = [], [], []
        for x in rows[text].combine_chunks().cast(pa.binary()).to_pylist():
            split = (x or b"").split(b"\n")
            kept = [line for line in split if line_hash(line, p.min_chars) not in gone] if gone else split
            texts.append(x if x is None or len(kept) == len(split) else b"\n".join(kept))
            lines.append(len(split))
            lost.append(len(split) - len(kept))
        new = pa.array(texts, pa.binary()).cast(rows.schema.field(text).type)
        cols = {c: new if c == text else rows[c] for c in names}
        return pa.table(cols | {"n_lines": pa.array(lines, pa.int64()), "n_dropped": pa.array(lost, pa.int64())})

    return chunked.groupBy("_chunk").cogroup(dropped.groupBy("_chunk")).applyInArrow(rewrite, out) \
        .toDF(*named, "n_lines", "n_dropped")


def sha256_of(docs: DataFrame, text: str, name: str) -> DataFrame:
    """Adds the lowercase hexadecimal SHA-256 of the text (null as empty)."""
    return docs.withColumn(name, F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256))


__all__ = ["Params", "drop_common_lines", "line_counts", "line_index", "line_hash", "PerfectHash", "sha256_of"]
