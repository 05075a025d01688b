"""The pipeline's stages, each against a plain version on its own input."""

from collections import Counter

import pytest

import corpus_pipeline as cp
from conftest import SF_SMALL
from duelspark.llm import linededup
from duelspark.llm.common import materialize
from llm_fixtures import none, odd  # noqa: F401 - fixtures
from test_text_ops import WORD, plain_components, plain_fingerprint, plain_targets


@pytest.fixture(scope="module")
def stages(spark):
    """What every stage read and returned."""
    docs, out = spark.read.parquet(f"{SF_SMALL}/documents.parquet"), {}
    for name, stage in cp.STAGES:
        got = materialize(stage(spark, docs, SF_SMALL), "test-stage")
        out[name], docs = (docs.toPandas(), got.toPandas()), got
    return out


def test_order_and_columns(stages, spark):
    assert [n for n, _ in cp.STAGES] == ["toxicity", "line dedup", "simhash near-dedup", "mixing", "packing"]
    for name, (_, after) in list(stages.items())[:-1]:
        assert list(after.columns) == cp.COLUMNS
    assert cp.run(spark, SF_SMALL).count() == len(stages["packing"][1])


def test_toxicity_keeps_clean_documents(stages, spark):
    before, after = stages["toxicity"]
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet").toPandas().dropna()
    clean = set(labels[labels["toxic"] == 0]["doc_id"])
    toxic = set(labels[labels["toxic"] == 1]["doc_id"])
    kept = set(after["doc_id"])
    assert len(clean - kept) <= 0.02 * len(clean) and len(toxic & kept) <= 0.2 * len(toxic)
    assert after.merge(before, on=cp.COLUMNS).shape[0] == len(after)


def test_line_dedup(stages):
    before, after = stages["line dedup"]
    texts = {i: t.split("\n") for i, t in zip(before["doc_id"], before["text"])}
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").encode().lower()
    seen = Counter(k for lines in texts.values() for k in {key(x) for x in lines})
    for i, t in zip(after["doc_id"], after["text"]):
        assert t == "\n".join(x for x in texts[i] if not key(x) or seen[key(x)] < linededup.Params().min_docs)
    assert (after["n_chars"] == after["text"].map(len)).all() and len(after) == len(before)


def test_one_of_each_near_duplicate_group(stages):
    before, after = stages["simhash near-dedup"]
    groups = plain_components({i: plain_fingerprint(t) for i, t in zip(before["doc_id"], before["text"])})
    assert sorted(after["doc_id"]) == sorted(set(groups.values()))


def test_mix_near_targets(stages):
    before, after = stages["mixing"]
    size = {i: len(WORD.findall(t)) for i, t in zip(before["doc_id"], before["text"])}
    by = Counter()
    for i, s in zip(before["doc_id"], before["source"]):
        by[s] += size[i]
    taken, copies = Counter(), Counter(after["doc_id"])
    for i, s in zip(after["doc_id"], after["source"]):
        taken[s] += size[i]
    largest = {s: max(size[i] for i in g["doc_id"]) for s, g in before.groupby("source")}
    for s, t in plain_targets(by).items():
        assert abs(taken[s] - t) <= largest[s] / 2 + 1
    assert max(copies.values()) <= 3


def test_packing_covers_the_mix(stages):
    before, after = stages["packing"]
    assert Counter(after[after["piece"] == 0]["doc_id"]) == Counter(before["doc_id"])
    full = after.groupby("sequence_id")["length"].sum()
    assert full.max() <= 1024 and len(full) <= 1.02 * full.sum() / 1024 + 1


def test_edges(spark, odd, none):
    for docs in (odd, none):
        for _, stage in cp.STAGES:
            docs = materialize(stage(spark, docs, SF_SMALL), "test-stage")
        assert docs.count() >= 0
