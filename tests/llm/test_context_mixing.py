"""Context mixing: exact counts and base score, a proper distribution, edges."""

import itertools
import math
import pickle
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from duelspark.llm import contextmix as cm
from duelspark.llm.catalog import crc_mod
from llm_fixtures import docs, none, odd, run  # noqa: F401 - fixtures

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_counts_and_base_score(run, docs):
    got = run("op5_context_mixing").set_index("doc_id")
    toks = {i: [*WORD.findall((t or "").translate(LOWER)), None] for i, t in docs["text"].items()}
    out = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in toks}
    c = Counter(w for i, ws in toks.items() if not out[i] for w in ws)
    n, v = sum(c.values()), len(c)
    assert got["held_out"].to_dict() == out and (got["train_tokens"] == n).all()
    for i, ws in toks.items():
        assert got.loc[i, "n_tokens"] == len(ws) and got.loc[i, "n_known"] == sum(c[w] > 0 for w in ws)
        base = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws)
        assert math.isclose(got.loc[i, "base_score"], base, rel_tol=1e-9)
    assert (got["score"] < 0).all() and np.isfinite(got["score"]).all()
    bits = -got["score"].sum() * math.log2(10) / got["n_bytes"].sum()
    assert bits < 3.5  # a byte of these texts costs about 4.3 bits by its frequency alone


def test_probabilities_of_all_short_words_sum_to_one():
    """Every byte's decisions share their sum: over all first bytes, and below one of them."""
    words = [b"ab", b"abc", b"b", b"", b"abcdefgh", b"abcdefgi"]
    c = np.array([5, 3, 9, 4, 2, 1])
    tables = cm.Counts()
    d = cm.decisions(words)
    w = c[d.word].astype(float)
    for k, s in enumerate(d.slots):
        tables.seen[k] += np.bincount(s, w, len(tables.seen[k])).astype(np.float32)
        tables.ones[k] += np.bincount(s, w * d.bit, len(tables.ones[k])).astype(np.float32)
    m = cm.Mixer.of(cm.train_shard(words, c, tables, cm.Params(batch=64))[0])
    deep = cm.DeepCounts(words, c)
    b = cm.decisions([b"abcdefg" + bytes([x]) for x in range(256)])
    _, _, p = cm.predict(m, *cm.inputs(b, tables, deep))
    p = np.where(b.bit == 1, p, 1 - p)
    cost = p.reshape(256, -1, 8)[:, 7].prod(axis=1)  # the eighth byte, for each of its 256 values
    assert math.isclose(cost.sum(), 1, rel_tol=1e-9)
    first = cm.decisions([bytes([x]) + b"z" for x in range(256)])
    _, _, q = cm.predict(m, *cm.inputs(first, tables, deep))
    q = np.where(first.bit == 1, q, 1 - q).reshape(256, -1, 8)[:, 0].prod(axis=1)
    assert math.isclose(q.sum(), 1, rel_tol=1e-9)
    lp = cm.log10_probabilities(words, tables, deep, m)
    assert (10 ** lp).sum() <= 1 and lp[words.index(b"b")] > lp[words.index(b"abcdefgi")]


def test_deep_counts_are_the_prefix_trie():
    words = [b"".join(x) for x in itertools.product([b"abcdef", b"abcdeg"], [b"x", b"xy", b""])]
    c = np.arange(len(words))
    d = cm.decisions(words, only_deep=True)
    for bits in (22, 3):  # with three bits nearly all keys share a place
        seen, ones = cm.DeepCounts(words, c, bits).get(d.prefix)
        for key in set(d.prefix.tolist()):
            own = d.prefix == np.uint64(key)
            assert (seen[own] == c[d.word[own]].sum()).all() and (ones[own] == (c[d.word] * d.bit)[own].sum()).all()
    # the first deep byte of "abcdefxy": its top bit is decided below "abcdef", which three words share
    first = np.flatnonzero(d.word == 1)[0]
    assert seen[first] == c[:3].sum() and ones[first] == 0
    assert np.array_equal(np.unique(cm.decisions(words).prefix), np.unique(d.prefix))


def test_class_scales_are_normalised(run):
    shares = np.array([0.7, 0.3])
    c = np.array([10, 1, 0])
    by = np.array([[10, 0], [0, 1], [0, 0]])
    s = 2.0 ** (cm.class_scales(c, by, shares, 1.0) / cm.STEPS)
    assert s[0, 0] > 1 > s[0, 1] and s[1, 1] > 1 > s[1, 0] and (s[2] == 1).all()


def test_partitioning_and_edges(odd, none, spark):
    held = crc_mod("doc_id", 7) == 2
    a = cm.score(odd, held).toPandas()
    b = cm.score(odd.repartition(7), held).toPandas()
    key = ["n_bytes", "n_tokens", "doc_id"]
    a, b = (x.sort_values(key).reset_index(drop=True) for x in (a, b))
    pd.testing.assert_frame_equal(a, b, check_exact=False, rtol=1e-6)
    assert len(a) == 8 and (a.loc[a["n_bytes"] == 0, "n_tokens"] == 1).all()
    assert a.loc[a["n_bytes"] == 0, "bits_per_byte"].isna().all()
    assert cm.score(none, held).count() == 0
    nothing = cm.score(odd, F.lit(True)).toPandas()
    assert (nothing["train_tokens"] == 0).all() and (nothing["n_known"] == 0).all() and (nothing["score"] < 0).all()


def words_of(n, start=0):
    return [f"w{i * 7919 % 100003:05d}x{i}".encode() for i in range(start, start + n)]


def test_mixer_learns_from_every_word_of_every_shard(spark):
    words = words_of(17000)
    c = np.ones(len(words), np.int64)
    used = cm.train_shard(words, c, cm.Counts(), cm.Params())[1]
    one_gate = used[:cm.GATES[0] * cm.INPUTS].reshape(-1, cm.INPUTS)[:, 0]
    assert one_gate.sum() == sum(8 * (len(w) + 1) for w in words)
    rows = spark.createDataFrame([(bytearray(w), 1, 8 + i % 4) for i, w in enumerate(words_of(200))],
                                 "word binary, c long, shard int")
    tables = spark.sparkContext.broadcast(cm.hashed_tables(rows))
    late = cm.learn_mixer(rows, tables, cm.Params()).flat()
    early = cm.learn_mixer(rows.withColumn("shard", F.col("shard") - 8), tables, cm.Params()).flat()
    assert np.array_equal(late, early) and not np.allclose(late, cm.Mixer.start().flat())


def test_tables_follow_the_contexts_counted(spark):
    words = words_of(120000)
    rows = spark.createDataFrame([(bytearray(w), 1) for w in words], "word binary, c long").repartition(5)
    bits = cm.table_bits(rows)
    assert [k for k, _ in cm.ORDERS] == [1, 2, 3, 4, 6] and bits[:2] == cm.LEAST_BITS[:2]
    for (k, least), got in zip(cm.ORDERS, bits):
        pairs = len({(w + b" ")[max(0, i - k):i + 1] if i >= k else ((w + b" ")[:i + 1], "start")
                     for w in words for i in range(len(w) + 1)})
        assert abs(got - max(least, math.log2(cm.SLOTS * pairs))) < 1.2
    assert bits[-1] > cm.LEAST_BITS[-1]
    tables = cm.hashed_tables(rows, bits)
    again = pickle.loads(pickle.dumps(tables))
    for k, b in enumerate(bits):
        plain = np.zeros(1 << b, np.float32)
        np.add.at(plain, cm.decisions(words, bits=bits).slots[k], 1)
        assert np.array_equal(tables.seen[k], plain)
        assert np.array_equal(again.seen[k], plain) and np.array_equal(again.ones[k], tables.ones[k])
