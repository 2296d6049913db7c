"""Context-tree weighting keeps every context, however few grams are shipped."""
import numpy as np
import pytest

from railpulse.llm import ctw
from railpulse.llm.common import fold, table


def test_scores_do_not_depend_on_what_is_shipped(spark):
    """Against the whole tree; the model used to stop growing at ``model_grams``."""
    docs = table(spark, "/root/testdata/sf0.001", "documents").limit(60)
    docs = spark.createDataFrame(docs.collect(), docs.schema)
    tree = ctw.fit_tree(docs.where(fold("doc_id", ctw.FOLDS) != 0))
    want = {r["doc_id"]: tree.log10_probability(ctw.grams_of([r["text"].encode().lower()])[0]).sum() for r in docs.collect()}
    for shipped in (100, 5000, 10_000_000):
        got = {r["doc_id"]: r["score"] for r in ctw.score_documents(docs, model_grams=shipped).collect()}
        assert got == pytest.approx(want, rel=1e-9)


def test_grams_that_are_not_shipped():
    texts = [b"", b"abcabc", b"xyz"]
    grams, counts = ctw.grams_of(texts)
    head = np.unique(grams)[::2]
    score, rest = ctw.head_scores(texts, head, np.full(len(head), -1.0))
    for i, own in enumerate(np.split(grams, np.cumsum(counts)[:-1])):
        assert score[i] == -np.isin(own, head).sum()
        others = own[~np.isin(own, head)]
        assert {r["gram"]: r["n"] for r in rest[i].as_py()} == {g: (others == g).sum() for g in others.tolist()}
