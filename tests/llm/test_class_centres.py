"""op5's document classes are learned from every training document (F7)."""

import numpy as np

from duelspark.llm import contextmix as cm


def test_every_training_document_moves_the_centres(spark):
    """With a start from few documents, the centres are still the k-means of all of them."""
    texts = ["aaab" * (i % 5 + 1) + "ab"[i % 2] * (i % 7) for i in range(150)] \
        + ["xyz" * (i % 4 + 1) + "z" * (i % 9) for i in range(250)]
    rows = [(i, t, False) for i, t in enumerate(texts)] + [(1000, "QQQQ" * 50, True), (1001, "", False), (1002, None, False)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, held_out boolean").repartition(5)
    x = np.stack([cm.profile(t.encode()) for t in texts])
    for sample in (20, 0):
        got = cm.class_centres(docs, cm.Params(classes=2, class_sample=sample))
        near = (x @ got.T).argmax(axis=1)
        want = np.stack([x[near == k].sum(axis=0) for k in range(len(got))])
        assert np.allclose(got, want / np.linalg.norm(want, axis=1, keepdims=True), atol=2e-3)
    again = cm.class_centres(docs.repartition(3), cm.Params(classes=2, class_sample=0))
    assert (again == got).all()


def test_no_training_document(spark):
    docs = spark.createDataFrame([(1, "a", True), (2, "", False)], "doc_id long, text string, held_out boolean")
    assert cm.class_centres(docs, cm.Params()).shape == (1, 256)
