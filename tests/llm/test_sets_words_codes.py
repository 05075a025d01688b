"""SetSketch near duplicates, spelling variants and vector codes against plain versions."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from conftest import SF_SMALL
from duelspark.llm import partcodes, setsketch, variants
from duelspark.llm.catalog import ORACLES
from llm_fixtures import docs, none, odd, run  # noqa: F401 - fixtures

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
RUN = re.compile("[A-Za-zÀ-ÿ]+")


def plain_set(text, width=2):
    words = WORD.findall((text or "").translate(LOWER))
    return {" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def plain_duplicates(rows, percent=80):
    """[(id, text)] -> per row (n, component, kept)."""
    sets = [plain_set(t) for _, t in rows]
    label = list(range(len(rows)))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i
    for i, a in enumerate(sets):
        for j in range(i):
            inter = len(a & sets[j])
            if a and sets[j] and 100 * inter >= percent * (len(a) + len(sets[j]) - inter):
                label[max(top(i), top(j))] = min(top(i), top(j))
    ids = defaultdict(list)
    for i, (key, _) in enumerate(rows):
        ids[top(i)].append(key)
    out = []
    for i, (key, _) in enumerate(rows):
        first = min((x for x in ids[top(i)] if x is not None), default=None)
        out.append((key, len(sets[i]), first, key == first))
    return out


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_setsketch_matches_plain(run, docs):
    got = run("op11_setsketch")
    want = plain_duplicates(list(docs["text"].items()))
    assert sorted(got.itertuples(index=False, name=None)) == sorted(want)
    assert not all(x[3] for x in want)  # there are copies


def test_setsketch_links_at_the_threshold(spark):
    """Chains whose neighbours have a similarity of just 0.8 or just below, crowds of near copies, and
    many texts that share a passage."""
    rng = np.random.default_rng(3)
    rows = []
    for k in range(40):  # n and n + 1 words: n - 1 of n shingles, 4 of 5 at the least
        words = [f"c{k}w{i}" for i in range(9)]
        rows += [(len(rows) + i, " ".join(words[:5 + i])) for i in range(5)]
    base = [f"b{i}" for i in range(200)]
    for _ in range(150):
        edited = list(base)
        for at in rng.choice(200, rng.integers(1, 25), replace=False):
            edited[at] = f"e{rng.integers(1 << 30)}"
        rows.append((len(rows), " ".join(edited)))
    for _ in range(60):
        rows.append((len(rows), " ".join(base[:60] + [f"o{rng.integers(1 << 30)}" for _ in range(40)])))
    got = setsketch.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert rows_of(got) == sorted(plain_duplicates(rows), key=str)


def test_setsketch_rest_round_joins_components(spark, monkeypatch):
    """Blocks smaller than a bucket: components are joined wherever any of their members are linked."""
    monkeypatch.setattr(setsketch, "BLOCK", 3)
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 64, 100, dtype=np.uint64)
    sets = [np.unique(np.concatenate([base[2 * i:2 * i + 60], [np.uint64(9)]])) for i in range(20)]
    sketches = setsketch.registers(sets)
    shared = [(int(b), i) for i, row in enumerate(setsketch.buckets(sketches).view(np.int64)) for b in row]
    apart = spark.createDataFrame([(b, i, 100 + i % 10) for b, i in shared], "bucket long, class long, component long")
    details = spark.createDataFrame([(i, len(s), sketches[i].tobytes(), s.tobytes()) for i, s in enumerate(sets)],
                                    "class long, n long, sketch binary, members binary")
    got = [tuple(r) for r in setsketch.remaining_links(apart, details, 80).collect()]
    assert got and all(setsketch.linked(sets[a], sets[b], 80) and a % 10 != b % 10 for a, b in got)

    def parts(pairs):
        top = list(range(10))
        for a, b in pairs:
            x, y = top[a % 10], top[b % 10]
            top = [min(x, y) if t in (x, y) else t for t in top]
        return top
    assert parts(got) == parts([(i, j) for i in range(20) for j in range(i) if setsketch.linked(sets[i], sets[j], 80)])


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(5)
    a, b = (rng.integers(0, 1 << 64, 900, dtype=np.uint64) for _ in range(2))
    one, two, both = setsketch.registers([a, b, np.union1d(a, b)])
    assert np.array_equal(np.maximum(one, two), both)
    found = []
    for _ in range(60):
        u = rng.integers(0, 1 << 64, 600, dtype=np.uint64)
        x, y = setsketch.registers([u[:500], u[50:]]).astype(int)  # 450 of 600
        found.append(setsketch.likely_similarity(np.array([(x > y).sum()]), np.array([(x < y).sum()]), np.array([500]),
                                                 np.array([550]))[0])
    assert abs(np.mean(found) - 0.75) < 0.02 and min(found) > setsketch.floor_of(0.75)


def test_setsketch_odd_rows(odd, none):
    got = setsketch.near_duplicates(odd)
    assert rows_of(got) == sorted(plain_duplicates([(r["doc_id"], r["text"]) for r in odd.collect()]), key=str)
    clash = odd.withColumnsRenamed({"score": "class", "lang": "key", "source": "bucket", "n_chars": "content"})
    assert rows_of(setsketch.near_duplicates(clash)) == rows_of(got)
    assert setsketch.near_duplicates(none).count() == 0


# ------------------------------------------------------------------------------------------------ words
def plain_variants(rows, damage=97):
    n = Counter()
    for key, text in rows:
        for word in RUN.findall(text or ""):
            word = word.translate(LOWER)
            h = zlib.crc32(f"{'' if key is None else key}:{word}".encode())
            if damage and h % damage == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            n[word] += 1
    n = {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}
    masks = defaultdict(set)
    for w in n:
        for i in range(len(w)):
            masks[w[:i], w[i + 1:]].add(w)
    near = defaultdict(set)
    for (head, tail), words in masks.items():
        for w in words:
            near[w] |= words - {w}
            if head + tail in n:
                near[w].add(head + tail)
                near[head + tail].add(w)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out, key=str)


def test_variants_match_plain(spark, run, docs):
    got = run("op12_spelling_variants")
    got = [tuple(None if isinstance(x, float) and math.isnan(x) else x for x in r) for r in got.itertuples(index=False, name=None)]
    want = plain_variants(docs["text"].items())
    assert sorted(got, key=str) == want
    assert sum(r[1] is not None for r in want) > 100


def test_variants_across_parts(spark, monkeypatch):
    """Tries cut into many parts, runs of equal letters, letters of two bytes, chains of forms."""
    monkeypatch.setattr(variants, "PER_PART", 5)
    words = {"aaaaa": 3, "aaaaaa": 6, "aaaaaaa": 12, "aaaaaaaa": 24, "baaaaaa": 7, "éaaaaa": 9, "aaéaaa": 9, "àéîõü": 4,
             "àéîõ": 50, "àéîõüx": 8, "abcde": 3, "abcdf": 3, "abcdg": 6, "abxdg": 12, "abcd": 90, "bcdef": 3, "bcdeffg": 9}
    rng = np.random.default_rng(8)
    for _ in range(150):
        words["".join(rng.choice(list("ab"), rng.integers(5, 9)))] = int(rng.integers(3, 60))
    rows = [(i, " ".join([w.upper() if w.isascii() else w] * n)) for i, (w, n) in enumerate(words.items())]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert rows_of(variants.spelling_variants(df)) == plain_variants(rows, None)
    assert rows_of(variants.spelling_variants(df, damage=3)) == plain_variants(rows, 3)


def test_variants_odd_rows(spark, odd, none):
    rows = [(None, "Ärger ärger ärger Ärgern"), (1, None), (1, ""), (2, "words words words word's " * 9), (2, "wordz " * 4),
            (2, "wordz " * 4), (3, "x" * 3000 + " " + "x" * 2999 + " ")] + [(i, "x" * 3000 + " " + "x" * 2999) for i in range(4, 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS n", "'p' AS place", "2 AS path")
    assert rows_of(variants.spelling_variants(df, damage=97)) == plain_variants(rows)
    assert rows_of(variants.spelling_variants(odd)) == plain_variants([(r["doc_id"], r["text"]) for r in odd.collect()], None)
    assert variants.spelling_variants(none).count() == 0


# ------------------------------------------------------------------------------------------------ codes
def plain_codes(x, parts=4, entries=256, rounds=4):
    """Integer k-means by full search: codes, errors, codebooks (parts, entries, width)."""
    x = np.asarray(x, np.int64).reshape(len(x), parts, -1)
    books = x[:entries].transpose(1, 0, 2).copy()
    for turn in range(rounds + 1):
        dist = ((x[:, :, None, :] - books[None]) ** 2).sum(3)
        codes = dist.argmin(axis=2)
        if turn == rounds:
            return codes, dist.min(axis=2).sum(axis=1), books
        for p in range(parts):
            for e in range(books.shape[1]):
                mine = x[codes[:, p] == e, p]
                if len(mine):
                    books[p, e] = mine.sum(axis=0) // len(mine)


def codes_frame(spark, x, **more):
    rows = [(i, [float(v) / 1024 for v in r]) for i, r in enumerate(x.tolist())]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)


@pytest.mark.parametrize("kind", ["clusters", "ties", "noise"])
def test_codes_match_full_search(spark, kind):
    rng = np.random.default_rng(6)
    if kind == "clusters":
        x = rng.integers(-900, 900, (30, 16))[rng.integers(0, 30, 700)] + rng.integers(-40, 40, (700, 16))
    elif kind == "ties":
        x = rng.integers(-1, 2, (600, 16))
    else:
        x = rng.integers(-1000, 1000, (500, 16))
    got = partcodes.compress(codes_frame(spark, x), entries=40).toPandas().set_index("vec_id").sort_index()
    codes, error, books = plain_codes(x, entries=40)
    assert got["code"].tolist() == ["".join(f"{c:02x}" for c in r) for r in codes.tolist()]
    assert got["error"].tolist() == error.tolist()
    text = ",".join(map(str, books.ravel().tolist()))
    assert set(got["codebooks_sha256"]) == {hashlib.sha256(text.encode()).hexdigest()}


def test_bounds_excuse_work_and_stay_right():
    """Rounds of small movements: most parts are cleared by their bounds, all answers equal full search."""
    rng = np.random.default_rng(7)
    book = rng.integers(-2000, 2000, (64, 8))
    x = (book[rng.integers(0, 64, 3000)] + rng.integers(-60, 60, (3000, 8))).astype(np.int32)
    near, low, outer, best = partcodes.full_search(x, book, 8)
    for _ in range(4):
        new = book + rng.integers(-6, 7, book.shape)
        moved = np.sqrt(((new - book) ** 2).sum(1).astype(float)) + 1e-6
        book = new
        near, low, outer, best, depth = partcodes.bounded_search(x, book, moved, near, low, outer)
        dist = partcodes.squared(x, book)
        assert np.array_equal(near[:, 0], dist.argmin(1)) and np.array_equal(best, dist.min(1))
        root = np.sqrt(dist.astype(float))
        assert (low <= np.take_along_axis(root, near, 1)).all()
        np.put_along_axis(root, near, np.inf, 1)
        assert (outer <= root.min(1)).all()
    assert (depth == 1).mean() > 0.5 and partcodes.adapted(np.bincount(depth, minlength=256), 8) < 8


def test_codes_of_large_components():
    x = np.array([[1 << 26, -(1 << 26)], [3, 4]], np.int32)
    assert partcodes.squared(x, np.array([[-(1 << 26), 1 << 26], [0, 0]])).tolist() == [[1 << 55, 1 << 53], [
        (3 + (1 << 26)) ** 2 + (4 - (1 << 26)) ** 2, 25]]
    with pytest.raises(ValueError):
        partcodes.whole_components([[1e9]], 1, 1024)


def test_codes_match_sql(run):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS FROM '{SF_SMALL}/embeddings.parquet'")
    want = con.sql(ORACLES["op13_part_codes"]).df().sort_values("vec_id").reset_index(drop=True)
    got = run("op13_part_codes").sort_values("vec_id").reset_index(drop=True)
    assert got[list(want.columns)].astype(str).equals(want.astype(str))


def test_codes_odd_rows(spark):
    rows = [(1, [0.5, 0.25, -0.1, 0.0, 1.0], "a"), (None, [0.5] * 5, None), (2, None, "a"), (3, [0.1, None], "a"),
            (4, [float("nan")] * 5, "b"), (5, [float("inf")] * 5, "b"), (6, [], None), (1, [0.5, 0.25, -0.1, 0.0, 1.0], "a")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string") \
        .selectExpr("*", "label AS row", "vec_id AS whole", "1 AS codes", "2 AS error", "3 AS of")
    got = partcodes.with_label_error(partcodes.compress(df)).toPandas()
    assert sorted(map(str, got["vec_id"])) == ["1.0", "1.0", "6.0", "nan"]
    assert got["error"].tolist() == [0] * 4 and got["label_error"].tolist() == [0] * 4
    assert set(got.columns) == {"vec_id", "label", "row", "whole", "codes", "of", "code", "error", "codebooks_sha256",
                                "label_error"}
    assert got.loc[got["label"] == "a", "code"].nunique() == 1 and (got["of"] == 3).all()
    empty = partcodes.with_label_error(partcodes.compress(df.limit(0)))
    assert empty.count() == 0 and set(empty.columns) == set(got.columns)


def test_label_errors_add_up(spark):
    coded = spark.createDataFrame([(1, None, 5), (2, None, 6), (3, "x", 7)], "vec_id long, label string, error long")
    got = {r["vec_id"]: r["label_error"] for r in partcodes.with_label_error(coded).collect()}
    assert got == {1: 11, 2: 11, 3: 7}
