"""Vector codes of a few bytes: each vector is cut into equal parts, each part is replaced by the number
of the nearest entry of its position's codebook, and codebooks are refined by rounds of k-means in
integers (component: floor(scale * x); new entry: componentwise floor of the mean).

Assignment follows Drake and Hamerly. Each part keeps, from round to round, its b closest entries with
lower bounds on their distances and one outer bound for all other entries; b is one number per round.
When entries move, a bound sinks by its entry's movement and the outer bound by the largest movement.
The distance to the present entry is then computed exactly; the first place of the list from which all
bounds lie above it says how many listed entries must be looked at, and only those are computed, in
integers (ties to the lower index). If the outer bound is not above it, all entries are computed and
the list is made anew. b is adapted downwards after each round to the list place that nearly all parts
stayed within (``DEEP``). Bounds are floats rounded down; they only ever excuse work, since what they
do not clear strictly is verified in integers, so codes equal those of a full search.

The state of a round (components, lists, bounds) is a table in the checkpoint folder. Sums per entry
are made inside each task; what reaches the driver is ``entries`` times the vector's length numbers.

Edge cases: rows whose vector is null or holds null or non-finite components are left out; vectors
shorter than the longest, or a length that the number of parts does not divide, are filled up with
zeros; fewer rows than entries give shorter codebooks; repeated rows count each; the first entries are
those of the least ids (then of the stored components' bytes), null ids last; an empty table gives an empty result. All other
columns come back untouched inside a struct; ``code``, ``error`` and ``codebooks_sha256`` replace columns
of these names. Components beyond 2**26 in size after scaling are an error: their squares, summed over
512 components, would not fit a long.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize, pieces, unused

LIST = 16           # entries a part keeps in the first round
LEAST = 2
DEEP = 0.99         # share of the listed answers that the next round's shorter lists must still hold
EXACT = 1 << 53     # whole numbers below this are exact in float64
LARGEST = 1 << 26
ROWS = 4096         # vectors in one array pass
SLACK = 1e-9


@dataclass
class Step:
    """Codebooks of a round (parts, entries, width), how far each entry moved, and the list's length."""
    books: np.ndarray
    moved: np.ndarray | None
    keep: int


def whole_components(vectors: list, width: int, scale: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.float64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    out = np.floor(out * scale)
    if len(out) and np.abs(out).max(initial=0) > LARGEST:
        raise ValueError(f"a component is beyond {LARGEST} in size after scaling")
    return out.astype(np.int32)


def squared(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Exact squared distances of every row of ``x`` to every entry, as long integers."""
    x, book = x.astype(np.int64), book.astype(np.int64)
    most = int(max(np.abs(x).max(initial=0), np.abs(book).max(initial=0)))
    if 4 * most * most * x.shape[1] < EXACT:
        a, b = x.astype(np.float64), book.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)).astype(np.int64)
    return np.stack([((x - e) ** 2).sum(1) for e in book], axis=1)


def _ordered(dist: np.ndarray, index: np.ndarray) -> np.ndarray:
    """Columns of each row by distance, ties to the lower entry."""
    by_index = np.argsort(index, axis=1, kind="stable")
    by_dist = np.argsort(np.take_along_axis(dist, by_index, 1), axis=1, kind="stable")
    return np.take_along_axis(by_index, by_dist, 1)


def _below(x: np.ndarray) -> np.ndarray:
    """Single-precision numbers that are not above ``x``."""
    return np.nextafter(x.astype(np.float32), np.float32(-np.inf))


def full_search(x: np.ndarray, book: np.ndarray, keep: int):
    """The ``keep`` closest entries in order, lower bounds on their distances, the outer bound, and the
    squared distance to the closest."""
    dist = squared(x, book)
    order = np.argsort(dist, axis=1, kind="stable")
    near = order[:, :keep]
    root = np.sqrt(np.take_along_axis(dist, order[:, :keep + 1], 1).astype(np.float64))
    outer = root[:, keep] if book.shape[0] > keep else np.full(len(x), np.inf)
    return near.astype(np.int32), _below(root[:, :keep]), _below(outer), np.take_along_axis(dist, near[:, :1], 1)[:, 0]


def bounded_search(x: np.ndarray, book: np.ndarray, moved: np.ndarray, near: np.ndarray, bounds: np.ndarray,
                   outer: np.ndarray):
    """One round for rows with a list: new list, bounds, outer bound, squared distance, and how many
    listed entries were looked at (0: none but the present one, list length + 1: all entries)."""
    n, b = near.shape
    whole = x.astype(np.int64)
    own = ((whole - book[near[:, 0]].astype(np.int64)) ** 2).sum(1)
    sunk = _below(bounds - moved[near])
    sunk[:, 0] = _below(np.sqrt(own.astype(np.float64)))
    outer = _below(outer - moved.max(initial=0))
    # lowest bound from each place of the list to its end and beyond
    after = np.minimum.accumulate(np.concatenate([sunk, outer[:, None]], axis=1)[:, ::-1], axis=1)[:, ::-1]
    upper = np.sqrt(own.astype(np.float64)) * (1 + SLACK) + SLACK
    clear = after > upper[:, None]
    clear[:, 0] = False
    depth = np.where(clear.any(axis=1), clear.argmax(axis=1), b + 1)
    near, best = near.copy(), own.copy()
    for d in range(2, b + 1):
        rows = np.flatnonzero(depth == d)
        if len(rows):
            listed = near[rows, :d]
            dist = ((whole[rows, None, :] - book[listed].astype(np.int64)) ** 2).sum(2)
            order = _ordered(dist, listed)
            dist = np.take_along_axis(dist, order, 1)
            near[rows, :d], best[rows] = np.take_along_axis(listed, order, 1), dist[:, 0]
            sunk[rows, :d] = _below(np.sqrt(dist.astype(np.float64)))
    rows = np.flatnonzero(depth > b)
    if len(rows):
        near[rows], sunk[rows], outer[rows], best[rows] = full_search(x[rows], book, b)
    return near, sunk, outer, best, depth


def searched(df: DataFrame, step: Step, parts: int, keep_now: int) -> DataFrame:
    """A round's state. ``df``: (row, whole), and the last state's columns where ``step.moved`` is set."""
    sent = df.sparkSession.sparkContext.broadcast(step)
    schema = T.StructType([df.schema["row"]]).add("whole", "binary").add("near", "binary").add("bounds", "binary") \
        .add("outer", "binary").add("codes", "binary").add("error", "long").add("deep", "binary")

    def run(batches):
        s = sent.value
        entries, width = s.books.shape[1:]
        for b in pieces(batches, ROWS):
            n = b.num_rows
            x = np.frombuffer(b"".join(b["whole"].to_pylist()), np.int32).reshape(n, parts, width)
            if s.moved is not None:
                old = [np.frombuffer(b"".join(b[c].to_pylist()), t).reshape(n, parts, -1)
                       for c, t in (("near", np.int32), ("bounds", np.float32), ("outer", np.float32))]
            near, bounds, outer, codes, deep = [], [], [], [], []
            error = np.zeros(n, np.int64)
            for p in range(parts):
                if s.moved is None:
                    a, lo, out, best = full_search(x[:, p], s.books[p], keep_now)
                    depth = np.full(n, keep_now + 1)
                else:
                    a, lo, out, best, depth = bounded_search(x[:, p], s.books[p], s.moved[p], old[0][:, p], old[1][:, p],
                                                             old[2][:, p, 0])
                if s.keep < a.shape[1]:  # shorter lists: what is cut off falls under the outer bound
                    out = np.minimum(out, lo[:, s.keep:].min(axis=1))
                    a, lo = a[:, :s.keep], lo[:, :s.keep]
                error += best
                for held, new in ((near, a), (bounds, lo), (outer, out[:, None]), (codes, a[:, 0]), (deep, depth)):
                    held.append(new)

            def packed(held, kind):
                joined = np.ascontiguousarray(np.stack(held, axis=1).astype(kind)).reshape(n, -1)
                return pa.array([r.tobytes() for r in joined], pa.binary())

            yield pa.record_batch([b["row"], b["whole"], packed(near, np.int32), packed(bounds, np.float32),
                                   packed(outer, np.float32), packed(codes, np.int32), pa.array(error),
                                   packed(deep, np.uint8)], names=[f.name for f in schema])

    return df.mapInArrow(run, schema)


def entry_sums(state: DataFrame, parts: int, entries: int, width: int):
    """Sums and counts of the components of each entry, and how many answers each list place gave.
    Added up inside a task; entries * width numbers for each part reach the driver."""
    def run(batches):
        sums = np.zeros((parts, entries, width), np.int64)
        counts = np.zeros((parts, entries), np.int64)
        deep = np.zeros(256, np.int64)
        for b in pieces(batches, ROWS):
            n = b.num_rows
            x = np.frombuffer(b"".join(b["whole"].to_pylist()), np.int32).reshape(n, parts, width)
            codes = np.frombuffer(b"".join(b["codes"].to_pylist()), np.int32).reshape(n, parts)
            for p in range(parts):
                np.add.at(sums[p], codes[:, p], x[:, p].astype(np.int64))
                counts[p] += np.bincount(codes[:, p], minlength=entries)
            deep += np.bincount(np.frombuffer(b"".join(b["deep"].to_pylist()), np.uint8), minlength=256)
        for kind, array in enumerate((sums, counts, deep)):
            at = np.flatnonzero(array)
            if len(at):
                yield pa.record_batch([pa.array(np.full(len(at), kind, np.int32)), pa.array(at), pa.array(array.ravel()[at])],
                                      names=["kind", "at", "n"])

    rows = state.select("whole", "codes", "deep").mapInArrow(run, "kind int, at long, n long") \
        .groupBy("kind", "at").agg(F.sum("n").alias("n")).toPandas()
    out = [np.zeros(s, np.int64) for s in (parts * entries * width, parts * entries, 256)]
    for kind, array in enumerate(out):
        some = rows[rows["kind"] == kind]
        array[some["at"].to_numpy(np.int64)] = some["n"].to_numpy(np.int64)
    return out[0].reshape(parts, entries, width), out[1].reshape(parts, entries), out[2]


def adapted(deep: np.ndarray, keep: int) -> int:
    """The next list length: the place within which ``DEEP`` of the parts that a list answered stayed."""
    listed = deep[:keep + 1]
    if not listed.sum():
        return keep
    return max(min(LEAST, keep), min(keep, int(np.searchsorted(np.cumsum(listed), DEEP * listed.sum()))))


def codebook_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(df: DataFrame, vector: str = "embedding", row_id: str = "vec_id", parts: int = 4, entries: int = 256,
             rounds: int = 4, scale: int = 1024) -> DataFrame:
    """``df``'s usable rows without the vector, plus ``code`` (two hexadecimal digits a part), ``error``
    (squared distances summed over parts) and ``codebooks_sha256``."""
    spark = df.sparkSession
    if entries > 256:
        raise ValueError("two hexadecimal digits name at most 256 entries")
    others = [F.col(f"`{c}`") for c in df.columns if c not in (vector, "code", "error", "codebooks_sha256")]
    finite = F.forall(vector, lambda x: F.abs(x.cast("double")) < float("inf"))  # NaN is above it
    finite = finite & F.forall(vector, lambda x: x.isNotNull())
    usable = df.where(F.col(vector).isNotNull() & finite)
    usable = usable.select(F.struct(*others).alias("row"), F.col(vector).alias("vector"))
    longest = usable.agg(F.max(F.size("vector"))).first()[0]
    width = -(-max(1, longest or 0) // parts)

    def whole(batches):
        for b in pieces(batches, ROWS):
            x = whole_components(b["vector"].to_pylist(), width * parts, scale)
            yield pa.record_batch([b["row"], pa.array([r.tobytes() for r in x], pa.binary())], names=["row", "whole"])

    state = materialize(usable.mapInArrow(whole, T.StructType([usable.schema["row"]]).add("whole", "binary")), "vectors")
    first = state.orderBy(F.col(f"row.{row_id}").asc_nulls_last(), F.col("whole")).limit(entries) \
        .select("whole").collect()  # at most ``entries`` rows
    if not first:
        return df.limit(0).select(*others, F.lit("").alias("code"), F.lit(0).cast("long").alias("error"),
                                               F.lit("").alias("codebooks_sha256"))
    books = np.stack([np.frombuffer(r["whole"], np.int32) for r in first]).astype(np.int64) \
        .reshape(len(first), parts, width).transpose(1, 0, 2)
    size = books.shape[1]
    keep = min(LIST, size)
    step = Step(books, None, keep)
    for turn in range(rounds + 1):
        state = materialize(searched(state, step, parts, keep), f"codes-{turn}")
        if turn == rounds:
            break
        sums, counts, deep = entry_sums(state, parts, size, width)
        new = np.where(counts[:, :, None] > 0, sums // np.maximum(counts, 1)[:, :, None], books)
        moved = np.sqrt(((new - books) ** 2).sum(axis=2).astype(np.float64)) * (1 + SLACK) + SLACK
        moved[(new == books).all(axis=2)] = 0
        books, keep = new, step.keep
        step = Step(books, moved, adapted(deep, keep) if turn else keep)

    def hexed(batches):
        for b in pieces(batches, ROWS):
            codes = np.frombuffer(b"".join(b["codes"].to_pylist()), np.int32).reshape(b.num_rows, parts)
            text = ["".join(f"{x:02x}" for x in r) for r in codes.tolist()]
            yield pa.record_batch([b["row"], pa.array(text), b["error"]], names=["row", "code", "error"])

    out = state.select("row", "codes", "error").mapInArrow(
        hexed, T.StructType([state.schema["row"]]).add("code", "string").add("error", "long"))
    return out.select("row.*", "code", "error").withColumn("codebooks_sha256", F.lit(codebook_digest(books)))


def with_label_error(coded: DataFrame, label: str = "label") -> DataFrame:
    """Adds ``label_error``: ``error`` summed over rows of equal label, nulls together."""
    of = unused(coded, "of")
    sums = coded.groupBy(F.col(label).alias(of)).agg(F.sum("error").alias("label_error"))
    return coded.drop("label_error").join(sums, F.col(label).eqNullSafe(F.col(of))).drop(of)
