import numpy as np
import pytest
from conftest import SF

from gaugeline.llm import quality as op


@pytest.fixture()
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def test_parts_labelled_texts(documents, labels):
    got = op.importance_resample(documents, labels)
    assert got.count() == documents.count()
    rows = got.join(labels, "doc_id").collect()
    kept = {q: np.mean([r["kept"] for r in rows if r["quality"] == q]) for q in (0, 1)}
    assert kept[1] > 0.97 and kept[0] < 0.1


def test_weights_as_brute_force(documents, labels):
    labelled = op.with_labels(documents, labels, 20_000, 6)
    ratios = op.fit(labelled).ratios
    raw = np.zeros(op.WORDS + op.SHAPES)
    target = raw.copy()
    for r in labelled.collect():
        for b in op.ngrams(r["text"]):
            raw[b] += 1
            target[b] += r["label"] == 1 and r["half"] == 0
    assert np.allclose(ratios, op.log_ratios(target, raw))
    texts = dict(documents.select("doc_id", "text").collect())
    for r in op.importance_resample(documents, labels).collect():
        assert np.isclose(r["log_weight"], sum(ratios[b] for b in op.ngrams(texts[r["doc_id"]])))


def test_top_k_is_exact_but_for_ties(spark):
    rng = np.random.default_rng(3)
    values = [*rng.normal(size=500).tolist(), *[0.25] * 40, 1e9, -1e9]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for k in (1, 2, 100, 250, len(values), len(values) + 5):
        least = op.kth_largest(df, "x", k)
        assert least == sorted(values, reverse=True)[min(k, len(values)) - 1]
    assert op.kth_largest(df, "x", 0) == op.kth_largest(df.limit(0), "x", 3) == float("inf")


def test_sampling_k_and_copies(documents, labels):
    got = op.importance_resample(documents.unionByName(documents), labels, k=100).collect()
    kept = [r["doc_id"] for r in got if r["kept"]]
    assert len(kept) >= 100 and all(kept.count(d) % 2 == 0 for d in kept)


def test_odd_and_empty_tables(odd_documents, labels):
    assert all(r["kept"] for r in op.importance_resample(odd_documents, labels.limit(0)).collect())
    assert op.importance_resample(odd_documents.limit(0), labels).count() == 0
    odd = labels.selectExpr("cast(null as long) doc_id", "quality", "1 label").unionByName(
        labels.selectExpr("doc_id", "cast(null as int) quality", "2 label"))
    assert op.importance_resample(odd_documents, odd).count() == odd_documents.count()
