import numpy as np
import public_tokenizers
from conftest import SF
from test_op4_minhash import brute as near_brute
from test_op7_decontamination import brute as passages
from test_op8_packing import check as round_trip

import corpus_pipeline
from gaugeline.llm import quality, secret_scan

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_one_after_the_other(spark, documents):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    items = [(r[0], r[1]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    docs = documents
    for name, stage in corpus_pipeline.STAGES:
        before = [(r["doc_id"], r["text"]) for r in docs.collect()]
        out = corpus_pipeline.store(stage(spark, docs, SF), f"test-{name}")
        ids = {r["doc_id"] for r in out.select("doc_id").collect()}
        if name != "packing":
            assert out.columns == COLUMNS
        if name == "quality":
            want = quality.importance_resample(docs, labels).where("kept").collect()
            assert ids == {r["doc_id"] for r in want}
        elif name == "near_duplicates":
            assert ids == {r[0] for r in near_brute(before, 5) if r[3]}
        elif name == "decontamination":
            assert ids == {d for d, _, hit, _ in passages(before, items) if not hit}
            assert len(ids) < len(before)
        elif name == "secrets":
            model = secret_scan.MarkovModel((0.0,) * secret_scan.SYMBOLS ** 2, 1.0)
            found = secret_scan.with_secret_spans(out, model)
            assert ids == {d for d, _ in before} and found.where("size(all_found) > 0").count() == 0
            assert all(r["n_chars"] == len(r["text"]) for r in out.collect())
        else:
            round_trip(before, out.collect(), 2048)
        docs = out


def test_odd_documents_pass_all_stages(spark, odd_documents):
    odd = odd_documents.selectExpr("doc_id", "text", "lang", "kept source", "cast(null as long) n_chars",
                                   "'x' kept", "'y' component", "'z' base_found", "1 label")
    docs = odd
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.store(stage(spark, docs, SF), f"odd-{name}")
        if name != "packing":
            assert docs.columns == COLUMNS
        empty = stage(spark, odd.limit(0), SF)
        assert empty.count() == 0
    assert docs.where("doc_id = 1").count() > 0


def test_run(spark):
    pieces = corpus_pipeline.run(spark, SF).collect()
    assert pieces and all(len(np.frombuffer(p["ids"], "<u4")) <= 2048 for p in pieces)
    assert public_tokenizers.path("byte_bpe_50k.json")
