import random
import re
from collections import Counter
from math import floor, log

import numpy as np
from conftest import SF, lower_ascii

from gaugeline.llm import lexical_search as op
from gaugeline.llm.queries import ORACLES, QUERIES
from harness import compare

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return Counter(TERM.findall(lower_ascii(text or "")))


def brute(docs, items, most=20):
    bags = [(d, terms(t)) for d, t in docs]
    n_docs, n_terms = sum(bool(b) for _, b in bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        found = []
        for doc, bag in bags:
            score = 0
            for term, times in terms(text).items():
                if tf := bag.get(term):
                    w = floor(1000 * log((2 * n_docs + 2) / (2 * df[term] + 1)))
                    m = 75 + 25 * sum(bag.values()) * n_docs // n_terms
                    score += times * w * (10 ** 9 * tf // (1000 * tf + 12 * m))
            if score > 0:
                found.append((-score, doc is None, doc))
        found.sort(key=lambda f: (f[0], f[1], f[2] or 0))
        out += [(item, k, doc, -s) for k, (s, _, doc) in enumerate(found[:most], 1)]
    return sorted(out, key=repr)


def plain(df):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()), key=repr)


def pairs(df, key):
    return [(r[key], r["text"]) for r in df.select(key, "text").collect()]


def test_query_as_brute_force_and_sql(spark, documents):
    items = pairs(spark.read.parquet(f"{SF}/benchmark.parquet"), "item_id")
    got = plain(QUERIES["op12_lexical_search"](spark, SF))
    assert got == brute(pairs(documents, "doc_id"), items)
    sql = compare.connect(SF).execute(ORACLES["op12_lexical_search"]).fetchall()
    assert sorted(sql, key=repr) == got
    assert len(got) == 20 * len(items)


def test_odd_documents_items_and_blocks(spark, odd_documents, rows_of):
    items = spark.createDataFrame(
        [(1, "ONE", "x"), (2, None, "x"), (3, " .-", "x"), (None, rows_of(3, 12), "x"),
         (12, rows_of(3, 14), "x"), (12, rows_of(1, 40), "x"), (12, rows_of(1, 40), "x"),
         (30, "grÖße ÀÉ w1 w1 w2", "x"), (31, "nowhere", "x"), (32, rows_of(2, 9), None)],
        "item_id long, text string, doc_id string")
    docs, wanted = pairs(odd_documents, "doc_id"), pairs(items, "item_id")
    assert plain(op.search(odd_documents, items)) == brute(docs, wanted)
    assert plain(op.search(odd_documents, items, most=2, block_terms=20)) == brute(docs, wanted, 2)
    assert plain(op.search(odd_documents.limit(0), items)) == []
    assert plain(op.search(odd_documents, items.limit(0))) == []
    assert plain(op.search(odd_documents, items.where("item_id = 31"))) == []


def test_ties_of_many_copies_go_by_id(spark):
    docs = spark.createDataFrame([(k * 7 % 1009, "alpha beta") for k in range(1, 1009)]
                                 + [(5_000 + k, "gamma") for k in range(2_000)],
                                 "doc_id long, text string").repartition(8)
    items = spark.createDataFrame([(1, "beta alpha alpha")], "item_id long, text string")
    assert [r[2] for r in sorted(plain(op.search(docs, items)), key=lambda r: r[1])] == list(range(1, 21))


def test_plan_shares_sums_and_keeps_them_right():
    rng = random.Random(3)
    phrases = [[rng.randrange(400) for _ in range(6)] for _ in range(12)]
    bags = []
    for _ in range(60):
        own = Counter(t for p in rng.sample(phrases, 3) for t in p) + Counter(
            rng.randrange(400) for _ in range(5))
        bags.append((list(own), list(own.values())))
    bags += [([7_000], [1]), ([3, 7_000], [2, 1])]
    plan = op.Plan.of(bags, {t: t % 13 for t in range(400)})
    shared, alone = plan.additions()
    assert shared < 0.7 * alone
    gains = np.arange(3 * len(plan.terms)).reshape(3, -1) % 101
    doc, term = np.nonzero(gains)
    got = plan.scores(doc, term, gains[doc, term], 3)
    at = {int(t): k for k, t in enumerate(plan.terms)}
    for d in range(3):
        assert got[:, d].tolist() == [sum(
            n * (t % 13) * int(gains[d, at[t]]) for t, n in zip(*bag) if t in at) for bag in bags]
