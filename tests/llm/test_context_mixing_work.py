"""op5's CPU time (finding op5_context_mixing of round 3): shared beginnings once, texts taken apart in one go."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from duelspark.llm import contextmix as cm

WORDS = [b"international" + bytes([a, b]) for a in range(97, 123) for b in range(97, 107)] + [b"", b"a", b"ab", b"b"]
TEXTS = [None, "", " ", "a", "A b", " A\x0bb\x1c c\x00 ", " x y É z", "x" * 10 + "\n", " lead", "trail ", None, "", "é ß\tÀ",
         "the THE the\r\nend"]


def learned(words, c):
    tables = cm.Counts()
    d = cm.decisions(words)
    for k, s in enumerate(d.slots):
        np.add.at(tables.seen[k], s, c[d.word].astype(np.float32))
        np.add.at(tables.ones[k], s, (c[d.word] * d.bit).astype(np.float32))
    return tables, cm.DeepCounts(words, c)


def test_words_that_begin_alike_are_rated_once_on_what_they_share(monkeypatch):
    c = np.arange(len(WORDS)) % 5 + 1
    tables, deep = learned(WORDS, c)
    m = cm.Mixer.of(cm.train_shard(WORDS, c, tables, cm.Params(batch=64))[0])
    apart = [cm.log10_probabilities([w], tables, deep, m)[0] for w in WORDS]
    worked, plain = [], cm.inputs
    monkeypatch.setattr(cm, "inputs", lambda b, *more: worked.append(len(b.bit)) or plain(b, *more))
    together = cm.log10_probabilities(WORDS, tables, deep, m)
    assert np.allclose(together, apart, rtol=1e-12, atol=0)
    begun = {(w + b" " if w else b"\n")[:i + 1] for w in WORDS for i in range(len(w) + 1)}
    assert sum(worked) == 8 * len(begun) < 8 * sum(len(w) + 1 for w in WORDS) / 4


def test_a_shared_decision_counts_for_all_its_words():
    c = np.arange(len(WORDS)) * 7 % 11
    each, once = cm.decisions(WORDS), cm.decisions(WORDS, shared=True)
    n = cm.occurrences(once, c)
    for k, (a, b) in enumerate(zip(each.slots, once.slots)):
        size = 1 << cm.LEAST_BITS[k]
        assert (np.bincount(a, c[each.word], size) == np.bincount(b, n, size)).all()
        assert (np.bincount(a, c[each.word] * each.bit, size) == np.bincount(b, n * once.bit, size)).all()


@pytest.mark.parametrize("texts", [TEXTS, TEXTS[3:], [""], [None], ["  "], ["a"], ["a", "b"], ["a ", "b", " c"]])
def test_tokens_of_texts(texts):
    for column in (pa.array(texts, pa.string()), pa.array(["zz q", *texts, "k"], pa.string()).slice(1, len(texts))):
        first, token, distinct = cm.token_arrays(column)
        names = distinct.to_pylist()
        lower = [re.sub("[A-Z]", lambda x: x[0].lower(), t or "") for t in texts]
        assert [[names[i] for i in x] for x in np.split(token, first[1:])] \
            == [[*(w.encode() for w in re.findall(r"[^\x20\x09-\x0D]+", t)), b""] for t in lower]
        assert len(set(names)) == len(names)


def test_portions_keep_all_rows():
    b = pa.record_batch({"text": pa.array(TEXTS * 20), "i": pa.array(range(len(TEXTS) * 20))})
    for rows, size in ((7, 1 << 20), (1000, 10), (1000, 1), (50, 30)):
        cut = list(cm.portions([b.slice(3), b.slice(0, 0)], rows, size))
        assert pa.Table.from_batches(cut).equals(pa.Table.from_batches([b.slice(3)])) and all(x.num_rows for x in cut)
        assert max(x.num_rows for x in cut) <= rows


def test_counts_by_class_over_many_portions(spark, monkeypatch):
    monkeypatch.setattr(cm.portions, "__defaults__", (64,))
    rows = [(t, i % 4 == 1) for i, t in enumerate(TEXTS * 9)]
    docs = spark.createDataFrame(rows, "text string, held_out boolean").repartition(3)
    centres = np.stack([cm.profile(b"aaa"), cm.profile(b"x y z the end")])
    got = {bytes(r["word"]): (r["c"], r["by"]) for r in cm.count_words(docs, spark.sparkContext.broadcast(centres), cm.Params()).collect()}
    want, every = [Counter(), Counter()], set()
    for t, out in rows:
        words = [*re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower()), b""]
        every.update(words)
        if not out:
            want[int((centres @ cm.profile((t or "").encode())).argmax())].update(words)
    assert got == {w: (want[0][w] + want[1][w], [want[0][w], want[1][w]]) for w in every}
