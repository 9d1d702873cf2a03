import hashlib
import re

from conftest import SF, lower_ascii

from gaugeline.llm import decontamination as op
from gaugeline.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(lower_ascii(text or ""))


def brute(docs, items, width=10):
    windows = {}
    for item, text in items:
        w = words(text)
        for x in [tuple(w)] if 0 < len(w) < width else [
                tuple(w[k:k + width]) for k in range(len(w) - width + 1)]:
            windows.setdefault(x, set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if (x := tuple(w[k:k + n])) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[x] - {None}
        out.append((doc, len(w), sorted(hit), sorted(found)))
    return sorted(out, key=repr)


def plain(df):
    return sorted(((r["doc_id"], r["n_words"],
                    [k for s in r["hits"] for k in range(s["start"], s["end"])], sorted(r["items"]))
                   for r in df.collect()), key=repr)


def pairs(df, key):
    return [(r[key], r["text"]) for r in df.select(key, "text").collect()]


def test_query_as_brute_force(spark, documents):
    items = pairs(spark.read.parquet(f"{SF}/benchmark.parquet"), "item_id")
    want = brute(pairs(documents, "doc_id"), items)
    got = QUERIES["op7_decontamination"](spark, SF).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"],
                    r["contaminated"]) for r in got)) == [
        (d, n, len(hit), len(found), hashlib.sha256(
            ",".join(sorted(map(str, found))).encode()).hexdigest(), bool(hit))
        for d, n, hit, found in sorted(want)]
    assert any(r["contaminated"] for r in got)


def test_odd_documents_items_and_blocks(spark, odd_documents, rows_of):
    items = spark.createDataFrame(
        [(1, "ONE", "x"), (2, None, "x"), (3, "", "x"), (None, rows_of(3, 12), "x"),
         (12, rows_of(3, 14), "x"), (12, rows_of(1, 40), "x"), (30, "grÖße ÀÉ", "x"), (4, "...", "x")],
        "item_id long, text string, doc_id string")
    want = brute(pairs(odd_documents, "doc_id"), pairs(items, "item_id"))
    assert plain(op.find_passages(odd_documents, items)) == want
    assert plain(op.find_passages(odd_documents, items, block_bytes=60)) == want
    assert op.find_passages(odd_documents.limit(0), items).count() == 0
    assert plain(op.find_passages(odd_documents, items.limit(0))) == brute(
        pairs(odd_documents, "doc_id"), [])


def test_proximity(spark):
    test = " ".join(f"t{k}" for k in range(10))
    near = test.replace("t4", "t4 extra")
    far = test.replace("t4", "t4 and some more words")
    docs = spark.createDataFrame([(1, f"a {test} b"), (2, near), (3, far), (4, f"{test} {near}")],
                                 "doc_id long, text string")
    items = spark.createDataFrame([(7, test)], "item_id long, text string")
    got = {r["doc_id"]: (r["items"], r["near_items"]) for r in op.find_passages(docs, items).collect()}
    assert got == {1: ([7], [7]), 2: ([], [7]), 3: ([], []), 4: ([7], [7])}
