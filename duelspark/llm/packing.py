"""Best-fit packing planned over the histogram of lengths.

1. Tokenize every whole text once (one map). A document is its ids and then the end id. A
   document longer than ``size`` is cut into pieces of ``size``, the first of which may be shorter.
2. Histogram: count the pieces per length (at most ``size`` counts, whatever the input).
3. Plan on the histogram: lengths from long to short; each length's pieces go to the open
   sequences with the least room that still fits, many at a time. Sequences with the same room
   that were opened together form one run of numbers, so the plan is a list of ranges (length,
   first rank, count, first sequence, offset). Its size is bounded by the lengths and rooms, not
   by the documents.
4. Documents take planned slots: every piece has a rank within its length, from two counts (the
   pieces of the same length in lower shards, and its row number within its (length, shard), so
   a length that a third of all pieces share is numbered by many tasks), and the range of the plan
   that holds the rank gives sequence and offset.

Edge cases: null text is empty text; an empty text is the end id alone (length 1); repeated rows
are packed as often as they occur; an empty table gives no pieces; extra columns are ignored.
"""

from __future__ import annotations

import base64
import zlib
from array import array
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize, parts, pieces, schema_with, spread

PIECES = "doc_id {id}, _row long, piece int, start long, length long, ids_crc32 long"


@dataclass(frozen=True)
class Params:
    """``ranks``: the byte-pair vocabulary file (the same vocabulary as byte_bpe_50k.json; a test
    holds their ids equal); None is the installed public one. ``special``: strings that are one id."""
    size: int = 1024
    end_id: int = 2
    ranks: str | None = None
    special: dict[str, int] = field(default_factory=lambda: {"<|endoftext|>": 50256})
    per_shard: int = 1024
    keep_ids: bool = False


@lru_cache(maxsize=2)
def encoder(path: str | None):
    """One encoder per worker process."""
    import public_tokenizers
    import tiktoken
    with open(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_ids(text: str, p: Params) -> list[int]:
    """A document's ids, the end id included."""
    enc = encoder(p.ranks)
    for mark, number in p.special.items():
        if mark in text:
            out = []
            for i, part in enumerate(text.split(mark)):
                out += ([number] if i else []) + enc.encode_ordinary(part)
            return [*out, p.end_id]
    return [*enc.encode_ordinary(text), p.end_id]


def cuts(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: only the first may be shorter than ``size``."""
    head = n % size or size
    return [(0, head), *((s, size) for s in range(head, n, size))]


def token_pieces(docs: DataFrame, p: Params, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, _row, piece, start, length, ids_crc32[, ids]) of every document."""
    base = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")) \
        .withColumn("_row", F.monotonically_increasing_id())
    schema = PIECES.format(id=base.schema["doc_id"].dataType.simpleString()) + (", ids array<int>" if p.keep_ids else "")

    def run(batches):
        for b in pieces(batches, 500):
            rows, at, ids = [], [], []
            for i, x in enumerate(b["text"].to_pylist()):
                a = array("I", token_ids(x or "", p))
                raw = memoryview(a).cast("B")
                for k, (s, n) in enumerate(cuts(len(a), p.size)):
                    at.append(i)
                    rows.append((k, s, n, zlib.crc32(raw[4 * s:4 * (s + n)])))
                    if p.keep_ids:
                        ids.append(np.frombuffer(raw[4 * s:4 * (s + n)], np.uint32).astype(np.int32))
            k, s, n, c = zip(*rows) if rows else ((), (), (), ())
            take = pa.array(at, pa.int64())
            cols = [b["doc_id"].take(take), b["_row"].take(take), pa.array(k, pa.int32()), pa.array(s, pa.int64()),
                    pa.array(n, pa.int64()), pa.array(c, pa.int64())]
            names = ["doc_id", "_row", "piece", "start", "length", "ids_crc32"]
            if p.keep_ids:
                cols.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.record_batch(cols, names=names)

    return base.mapInArrow(run, schema)


def plan(histogram: dict[int, int], size: int) -> np.ndarray:
    """Rows (length, first rank, count, first sequence, offset, sequence step 1) of a best-fit
    packing of ``histogram`` (pieces per length) into sequences of ``size``."""
    rooms: dict[int, list[tuple[int, int]]] = {}  # room -> runs (first sequence, count) of open sequences
    rows, opened = [], 0
    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            room = min((r for r in rooms if r >= length), default=None)
            if room is None:
                # no open sequence fits: as many new ones as hold the rest, size // length in each
                n = -(-left // (size // length))
                room = size
                rooms[room] = [(opened, n)]
                opened += n
            first, n = rooms[room].pop()
            used = min(n, left)
            rows.append((length, rank, used, first, size - room))
            rank, left = rank + used, left - used
            if used < n:
                rooms[room].append((first + used, n - used))
            if not rooms[room]:
                del rooms[room]
            if room > length:
                rooms.setdefault(room - length, []).append((first, used))
    return np.array(rows, np.int64).reshape(-1, 5)


def ranked(stored: DataFrame, p: Params) -> DataFrame:
    """Adds ``_rank``, the piece's number from 0 within its length."""
    n = parts(stored.count(), p.per_shard)
    dealt = stored.withColumn("_shard", spread(n, "_row", "piece"))
    counts = dealt.groupBy("length", "_shard").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("_shard").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("length", "_shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_base"))
    own = Window.partitionBy("length", "_shard").orderBy("_row", "piece")
    return dealt.withColumn("_own", F.row_number().over(own) - 1).join(base, ["length", "_shard"]) \
        .withColumn("_rank", F.col("_base") + F.col("_own")).drop("_own", "_base", "_shard")


def pack(docs: DataFrame, p: Params = Params(), text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids with ``keep_ids``)."""
    stored = materialize(token_pieces(docs, p, text, doc_id), "pieces")
    histogram = {r["length"]: r["n"] for r in stored.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = plan(histogram, p.size)  # at most size lengths in the histogram
    order = np.lexsort((slots[:, 1], slots[:, 0]))
    shared = stored.sparkSession.sparkContext.broadcast(slots[order])
    rows = ranked(stored, p)
    keep = [c for c in rows.columns if c not in ("_row", "_rank")]

    def place(batches):
        s = shared.value
        keys = s[:, 0] * (1 << 42) + s[:, 1]
        for b in batches:
            rank = b["_rank"].to_numpy()
            at = np.searchsorted(keys, b["length"].to_numpy() * (1 << 42) + rank, side="right") - 1
            yield pa.record_batch([*(b[c] for c in keep), pa.array(s[at, 3] + rank - s[at, 1]), pa.array(s[at, 4])],
                                  names=[*keep, "sequence_id", "offset"])

    schema = schema_with(rows.select(*keep), sequence_id="long", offset="long")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return rows.mapInArrow(place, schema).select(*columns, *(["ids"] if p.keep_ids else []))


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves, from ``pack`` with ``keep_ids``: sequence_id and its ids in order."""
    parts_ = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts_, lambda x: x["ids"])).alias("ids"))
