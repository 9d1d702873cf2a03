import zlib

import numpy as np
from conftest import SF

from gaugeline.llm import language_id as op
from gaugeline.llm.queries import QUERIES


def test_held_out_accuracy(spark, documents):
    langs = {r["doc_id"]: r["lang"] for r in documents.select("doc_id", "lang").collect()}
    rows = QUERIES["op3_language_id"](spark, SF).collect()
    assert len(rows) == len(langs)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang_pred"] == langs[r["doc_id"]] for r in held]) > 0.97


def test_viterbi_as_exhaustive_search():
    import itertools
    rng = np.random.default_rng(0)
    scores = rng.normal(size=(20, 6, 3)).astype(np.float32)
    lengths = rng.integers(1, 7, 20)
    labels = op.viterbi(scores, lengths, 1.5)
    for row, n in enumerate(lengths):
        def total(path):
            return (sum(scores[row, t, s] for t, s in enumerate(path))
                    - 1.5 * sum(a != b for a, b in zip(path, path[1:])))
        best = max(itertools.product(range(3), repeat=int(n)), key=total)
        assert np.isclose(total(labels[row, :n]), total(best), atol=1e-5)


def test_spans_scripts_and_odd_texts(spark, odd_documents):
    train = spark.createDataFrame(
        [("the house and the garden of the king", "en"), ("дом и сад короля и дорога", "ru"),
         ("das haus und der garten des königs", "de"), (None, "en"), ("text", None)],
        "text string, lang string")
    model = op.train(train)
    assert model.langs == ["de", "en", "ru"]
    mixed = "the king and the house " * 4 + "дом короля и сад " * 4
    got = op.label_batch(model, [mixed, None, "123 ½ !", "", "дом"], 6.0)
    assert [(s["start"], s["end"], s["lang"]) for s in got[0][2]] == [(0, 20, "en"), (20, 36, "ru")]
    assert [g[:2] for g in got[1:4]] == [("und", 0.0)] * 3 and got[4][0] == "ru"
    rows = op.predict(odd_documents, model).collect()
    assert len(rows) == odd_documents.count()
    assert {r["lang_pred"] for r in rows if r["doc_id"] in (1, 2, 3)} == {"und"}
    empty = op.train(train.limit(0))
    assert {r["lang_pred"] for r in op.predict(odd_documents, empty).collect()} == {"und"}
    assert op.predict(odd_documents.limit(0), model).count() == 0


def test_rare_language_is_learned_beside_common_ones(spark):
    rows = [(f"the house and garden number {chr(97 + k % 26)}{chr(97 + k // 26 % 26)}", "en")
            for k in range(600)] + [("дом и сад короля и дорога", "ru"), ("12 34", "xx")]
    train = spark.createDataFrame(rows, "text string, lang string")
    model = op.train(train, size=3)
    assert model.langs == ["en", "ru"]
    assert op.label_batch(model, ["дорога и дом", "the garden"], 6.0)[0][0] == "ru"


def test_sample_of_each_group_as_brute_force(spark):
    df = spark.createDataFrame([(f"g{k % 7 % 3}", k % 400) for k in range(2_000)] + [("g9", 1)],
                               "g string, v long")
    hashes = df.distinct().withColumn("h", op.F.xxhash64("v")).collect()
    want = [(g, r["v"]) for g in ("g0", "g1", "g2", "g9")
            for r in sorted((r for r in hashes if r["g"] == g), key=lambda r: r["h"])[:50]]
    got = [(r["g"], r["v"]) for r in op.hash_sample_each(df, "g", op.F.col("v"), 50).collect()]
    assert sorted(got) == sorted(want)
