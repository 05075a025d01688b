"""Line dedup, SimHash, toxicity, mixing and packing against plain versions."""

import hashlib
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

from conftest import SF_SMALL
from duelspark.llm import linededup, mixing, packing, simhash, toxicity
from duelspark.llm.catalog import ORACLES
from llm_fixtures import docs, none, odd, run  # noqa: F401 - fixtures

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_fingerprint(text, width=3):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def plain_components(fps, errors=3):
    """{id: fingerprint} -> {id: least id reachable}."""
    by = {}
    for i, f in fps.items():
        by.setdefault(f, []).append(i)
    keys = list(by)
    values = np.array(keys, np.uint64)
    label = {f: min(by[f]) for f in keys}
    while True:
        new = {f: min(label[keys[j]] for j in np.flatnonzero(np.bitwise_count(values ^ np.uint64(f)) <= errors))
               for f in keys}
        if new == label:
            return {i: label[f] for i, f in fps.items()}
        label = new


def test_simhash_matches_plain(run, docs):
    got = run("op9_simhash").set_index("doc_id")
    fps = {i: plain_fingerprint(t) for i, t in docs["text"].items()}
    assert got["fingerprint"].to_dict() == {i: f"{f:016x}" for i, f in fps.items()}
    assert got["component_id"].to_dict() == plain_components(fps)


def test_trie_walk_finds_every_link():
    rng = np.random.default_rng(5)
    seeds = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    near = [s ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 6), replace=False)))
            for s in seeds for _ in range(25)]
    v = np.unique(np.array([*near, 0, 7, (1 << 64) - 1], np.uint64))
    want = simhash.Forest(len(v))
    i, j = np.triu_indices(len(v), 1)
    ok = simhash.distance(v[i], v[j]) <= 3
    want.add(i[ok], j[ok])
    for cut in (0, 1, len(v) // 3):
        got = simhash.Forest(len(v))
        for a, b in (((0, cut), (0, cut)), ((cut, len(v)), (cut, len(v))), ((0, cut), (cut, len(v)))):
            simhash.walk(v, a, b, 3, got)
        assert np.array_equal(got.root, want.root)


def test_trie_links_over_many_nodes(spark):
    rng = np.random.default_rng(6)
    base = rng.integers(-(1 << 62), 1 << 62, 300)
    rows = np.unique(np.concatenate([base, base ^ 1, base ^ (1 << 61) ^ 4, base[:50] ^ -1]))
    fps = spark.createDataFrame(pd.DataFrame({"_fp": rows, "doc_id": np.arange(len(rows))}))
    got = simhash.with_component(fps, 3).toPandas()
    want = plain_components(dict(zip(range(len(rows)), rows.view(np.uint64).tolist())))
    assert dict(zip(got["doc_id"], got["component_id"])) == want


def test_cut_covers_every_prefix():
    counts = {0: 5000, 1: 3, 40000: 10, 65535: 2000}
    starts, depths = simhash.cut_nodes(counts, 1500)
    for k in counts:
        at = int(np.searchsorted(starts, np.uint64(k << 48), side="right")) - 1
        assert (k << 48) >> (64 - int(depths[at])) == int(starts[at]) >> (64 - int(depths[at]))


def test_cut_goes_as_deep_as_a_crowd_asks(spark):
    v = np.concatenate([np.arange(3000, dtype=np.uint64) * np.uint64(3), np.arange(500, dtype=np.uint64) << np.uint64(52)])
    v = np.unique(np.concatenate([v, ~v]))
    fps = spark.createDataFrame(pd.DataFrame({"_fp": v.view(np.int64), "doc_id": np.arange(len(v))}))
    starts, depths = simhash.cut_trie(fps, simhash.prefix_counts(fps, simhash.PREFIX_BITS), 100)
    at = np.searchsorted(starts, v, side="right") - 1
    up = (64 - depths[at]).astype(np.uint64)
    assert (v >> up == starts[at] >> up).all() and np.bincount(at).max() <= 100 and depths.max() > simhash.PREFIX_BITS
    got = simhash.with_component(fps, 2).toPandas().sort_values("doc_id")["component_id"]
    links = simhash.Forest(len(v))
    i, j = np.triu_indices(len(v), 1)
    near = simhash.distance(v[i], v[j]) <= 2
    links.add(i[near], j[near])
    assert got.tolist() == links.root.tolist()


def test_groups_of_documents_without_ids_stay_apart(spark):
    rows = [(None, "one two three four five"), (None, "six seven eight nine ten eleven"), (None, "one two three four five")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r["text"] for r in simhash.first_of_each(d).collect()) == [rows[0][1], rows[1][1]]


def test_near_duplicates_edges(odd, none, spark):
    got = simhash.near_duplicates(odd).toPandas()
    assert len(got) == 8
    assert set(got.loc[got["fingerprint"] == "0" * 16, "component_id"]) == {1}
    assert set(got.loc[got["doc_id"].isin([3, 4]), "component_id"]) == {3}
    kept = simhash.first_of_each(odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == [1, 3, 5, 6]
    assert simhash.near_duplicates(none).count() == 0 and simhash.first_of_each(none).count() == 0


def test_line_dedup_edges(odd, none, spark):
    rows = [(i, f"Shared Line \nown {i}\n\t\n") for i in range(12)] + [(20, "SHARED LINE"), (21, None), (22, "")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    p = linededup.Params(per_shard=3, per_chunk=2)
    got = {r["doc_id"]: r for r in linededup.drop_common_lines(d, p).collect()}
    assert got[3]["text"] == "own 3\n\t\n" and (got[3]["n_lines"], got[3]["n_dropped"]) == (4, 1)
    assert got[20]["text"] == "" and got[21]["text"] is None and got[21]["n_lines"] == 1
    out = linededup.drop_common_lines(odd)
    assert out.count() == 8 and out.columns == [*odd.columns, "n_lines", "n_dropped"]
    assert linededup.drop_common_lines(none).count() == 0


def test_perfect_hash_is_a_bijection():
    keys = np.frombuffer(b"".join(xxhash.xxh3_128_digest(str(i)) for i in range(5000)), np.uint64).reshape(-1, 2)
    h = linededup.PerfectHash.build(keys)
    assert sorted(h.slots(keys)) == list(range(5000))
    twin = np.concatenate([keys[:3], keys[:1]])  # a key twice stays outside all levels
    assert len(linededup.PerfectHash.build(twin).left) == 2


@pytest.mark.parametrize("name", ["op6_line_dedup"])
def test_sql_twin(run, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_SMALL}/documents.parquet'")
    want = con.execute(ORACLES[name]).fetchdf()
    got = run(name)
    assert sorted(map(tuple, got[sorted(got)].to_numpy().tolist())) == \
        sorted(map(tuple, want[sorted(want)].to_numpy().tolist()))
    assert hashlib.sha256(b"").hexdigest()


def test_toxicity_learns_and_handles_edges(run, odd, none, spark):
    got = run("op8_toxicity").set_index("doc_id")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet").toPandas().set_index("doc_id")["toxic"].dropna()
    assert (got["predicted"] == (got["score"] >= 0.5)).all() and got["score"].between(0, 1).all()
    assert got["held_out"].equals(pd.Series({i: zlib.crc32(str(i).encode()) % 5 == 0 for i in got.index})[got.index])
    joined = got.loc[labels.index]
    assert (joined["predicted"] == labels)[~joined["held_out"]].mean() > 0.95
    empty = spark.createDataFrame([], "doc_id long, toxic int")
    m = toxicity.fit(odd, empty)
    s = toxicity.score(odd, m)
    assert s.count() == 8 and s.agg({"score": "max"}).first()[0] < 1e-5
    assert toxicity.score(none, m).count() == 0


def test_factorization_learns_a_pair():
    """Two words are harmless alone and toxic together: only the interaction can tell."""
    rng = np.random.default_rng(1)
    p = toxicity.Params(epochs=60, batch=16, min_support=1)
    docs, y = [], []
    for i in range(600):
        a, b = i % 2, i // 2 % 2
        words = [w for w, on in ((b"insult", a), (b"group", b)) if on] + [b"w%d" % rng.integers(30)]
        docs.append(toxicity.features(words, p.bits))
        y.append(a & b)
    m = toxicity.learn(docs, np.array(y, np.float32), p)
    assert np.mean([(toxicity.logit(m, d) > 0) == bool(t) for d, t in zip(docs, y)]) > 0.95


def plain_targets(sizes, weights=(1, 2, 3), most=3):
    order = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    capped, target = set(), {}
    while True:
        room = sum(sizes.values()) - sum(most * sizes[s] for s in capped)
        free = [s for s in order if s not in capped]
        share = {s: room * w[s] / sum(w[x] for x in free) for s in free}
        over = {s for s in free if share[s] > most * sizes[s]}
        if not over:
            return share | {s: most * sizes[s] for s in capped}
        capped |= over


def test_mixing_meets_targets(run, docs):
    got = run("op1_mix_sources")
    sizes = {i: len(WORD.findall(t or "")) for i, t in docs["text"].items()}
    assert got.set_index("doc_id")["size"].to_dict() == sizes
    by = Counter()
    for i, s in docs["source"].items():
        by[s] += sizes[i]
    want = plain_targets(by)
    for s, g in got.groupby("source"):
        assert abs(g["target"].iloc[0] - want[s]) < 1e-6 * want[s]
        assert abs(g["taken"].sum() - want[s]) <= g["size"].max() / 2 + 1
    assert (got["taken"] <= 3 * got["size"]).all()


def test_mixing_edges(odd, none):
    got = mixing.mix(odd).toPandas()
    assert len(got) == 8 and (got["taken"] == got["size"] * got["copies"]).all() and got["copies"].between(0, 3).all()
    again = mixing.mix(odd.repartition(5)).toPandas()
    cols = ["text", "size", "target", "taken"]
    assert sorted(map(str, got[cols].to_numpy().tolist())) == sorted(map(str, again[cols].to_numpy().tolist()))
    assert mixing.take(odd).columns == odd.columns
    assert mixing.mix(none).count() == 0


def test_capped_targets(spark):
    rows = [(i, "w " * 10, "a") for i in range(2)] + [(10 + i, "w " * 10, "b") for i in range(50)] \
        + [(100 + i, "w " * 10, None) for i in range(3)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).toPandas()
    want = plain_targets({"a": 20, "b": 500, None: 30})
    for s, t in want.items():
        g = got[got["source"].isna() if s is None else got["source"] == s]
        assert abs(g["target"].iloc[0] - t) < 1e-6 and abs(g["taken"].sum() - t) <= 5


def test_packing_round_trip(run, docs):
    from public_tokenizers import path
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path("byte_bpe_50k.json"))
    got = run("op10_pack")
    ids = {i: [*tok.encode(t or "", add_special_tokens=False).ids, 2] for i, t in docs["text"].items()}
    for i, g in got.sort_values("piece").groupby("doc_id"):
        assert list(g["piece"]) == list(range(len(g))) and g["length"].sum() == len(ids[i])
        assert list(g["start"]) == [0, *g["length"].cumsum()[:-1]] and (g["length"].iloc[1:] == 1024).all()
        for s, n, c in zip(g["start"], g["length"], g["ids_crc32"]):
            assert c == zlib.crc32(np.array(ids[i][s:s + n], "<u4").tobytes())
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        assert list(g["offset"]) == [0, *g["length"].cumsum()[:-1]] and g["length"].sum() <= 1024
    assert got["sequence_id"].nunique() <= 1.02 * got["length"].sum() / 1024 + 1


def test_special_strings_match_the_tokenizer():
    from public_tokenizers import path
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path("byte_bpe_50k.json"))
    for t in ("a<|endoftext|>b", "<|endoftext|>", " x<|endoftext|><|endoftext|> y", "", "é ß\n\n  z"):
        assert packing.token_ids(t, packing.Params())[:-1] == tok.encode(t, add_special_tokens=False).ids


def test_plan_is_best_fit():
    rng = np.random.default_rng(3)
    lengths = rng.integers(1, 65, 3000)
    rows = packing.plan(dict(Counter(lengths.tolist())), 64)
    fill, placed = Counter(), Counter()
    for length, rank, n, first, offset in rows.tolist():
        assert placed[length] == rank
        placed[length] += n
        for s in range(first, first + n):
            assert fill[s] == offset
            fill[s] += length
    assert placed == Counter(lengths.tolist()) and max(fill.values()) <= 64
    assert len(fill) <= 1.01 * lengths.sum() / 64 + 1


def test_packing_edges(odd, none, spark):
    got = packing.pack(odd, packing.Params(keep_ids=True)).toPandas()
    assert (got[got["doc_id"] == 1]["length"] == 1).all() and len(got[got["doc_id"] == 3]) == 2
    assert (got["length"] == got["ids"].map(len)).all()
    seq = packing.sequences(packing.pack(odd, packing.Params(keep_ids=True))).toPandas()
    assert seq["ids"].map(len).sum() == got["length"].sum()
    assert packing.pack(none).count() == 0


INNER = ["_row", "_fp", "_group", "_chunk", "_source", "_dual", "_key", "_end", "_scale", "_whole", "_fraction", "_v", "with",
         "size", "copies", "_copy", "key", "u", "n", "c1", "hi", "label", "component_id", "n_lines", "gone.away"]


def test_columns_named_like_inner_ones(odd):
    """Columns that share a name with one an operator uses inside come back as they were."""
    d = odd.toDF(*odd.columns[:-1], "Score")
    for name in INNER:
        d = d.withColumn(name, F.concat(F.lit(f"{name} "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))))

    def untouched(out, names):
        rows = [r.asDict() for r in out.collect()]
        assert rows and all(r[c] == f"{c} {'none' if r['doc_id'] is None else r['doc_id']}" for r in rows for c in names)
        return sorted(str((r["doc_id"], r["text"])) for r in rows)

    for fn, added in ((simhash.first_of_each, []), (mixing.take, []), (linededup.drop_common_lines, ["n_lines", "n_dropped"]),
                      (mixing.mix, list(mixing.ADDED))):
        out = fn(d)
        assert set(out.columns) == {*d.columns, *added}
        assert untouched(out, [c for c in INNER if c not in added]) == sorted(
            str((r["doc_id"], r["text"])) for r in fn(odd).select("doc_id", "text").collect())


def test_dual_far_out(spark):
    """One huge document among very many of one word, with a small target: the dual lies far below -60."""
    rows = [(i, "w", "a") for i in range(300)] + [(300, "w " * 200000, "a"), (301, "w " * 500, "b")]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    cells = d.select("source", F.regexp_count("text", F.lit("w")).cast("long").alias("size")).groupBy("source", "size") \
        .agg(F.count("*").alias("n"))
    goals = spark.createDataFrame([("a", 200300, 200300 / 301, 20.0), ("b", 500, 500.0, 400.0)],
                                  "source string, source_size long, scale double, target double")
    duals = {r["source"]: r["dual"] for r in mixing.solve(cells, goals, mixing.Params()).collect()}
    words = 300 * np.exp(duals["a"] / (200300 / 301)) + 200000 * np.exp(duals["a"] * 200000 / (200300 / 301))
    assert duals["a"] < -60 and abs(words - 20) < 1e-4 and abs(500 * np.exp(duals["b"]) - 400) < 1e-2
    with pytest.raises(RuntimeError):
        mixing.solve(cells, goals, mixing.Params(rounds=1))
