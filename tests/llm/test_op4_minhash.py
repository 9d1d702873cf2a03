import itertools
import random

import pytest
from conftest import SPACED, lower_ascii

from gaugeline.llm import components, minhash


def shingles(text, k):
    w = SPACED.findall(lower_ascii(text or ""))
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute(rows, k, percent=80):
    sets = [(i, shingles(t, k)) for i, t in rows]
    links = [(a, b) for (a, x), (b, y) in itertools.combinations(sets, 2)
             if a is not None and b is not None and x and y
             and 100 * len(x & y) >= percent * len(x | y)]
    root = roots({i for i, _ in rows if i is not None}, links)
    return sorted(((i, len(s), root.get(i), i is None or root[i] == i) for i, s in sets), key=repr)


def check(df, k):
    rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    got = sorted(map(tuple, minhash.near_duplicates(df, words=k).collect()), key=repr)
    assert got == brute(rows, k)
    return got


def test_documents_as_brute_force(documents):
    for k in (2, 5):
        assert not all(r[3] for r in check(documents, k))


def test_odd_documents(odd_documents):
    check(odd_documents, 2)


def test_chains_of_edits_and_shared_ids(spark, rows_of):
    rng = random.Random(4)
    base, rows = rows_of(7, 120).split(), []
    for k in range(40):  # neighbours are near, the ends of the chain are not
        rows.append((k + 1, " ".join(base)))
        base[rng.randrange(len(base))] = f"new{k}"
    rows += [(900, rows_of(8, 50)), (3, rows_of(8, 50)), (901, rows_of(8, 49))]
    got = check(spark.createDataFrame(rows, "doc_id long, text string"), 2)
    assert {r[2] for r in got} == {1}


@pytest.mark.parametrize("blocks", [{}, {"block": 3, "bucket_block": 8}, {"bucket_block": 5}])
def test_groups_of_edited_copies_in_blocks(spark, rows_of, blocks):
    """Groups whose members are near the threshold from each other, so that components meet again."""
    rng = random.Random(6)
    rows = []
    for group in range(3):
        base = rows_of(20 + group, 60).split()
        for k in range(70):
            text = list(base)
            for at in rng.sample(range(60), rng.randint(2, 5)):
                text[at] = f"new{rng.randrange(10_000)}"
            rows += [(group * 1_000 + k, " ".join(text))] * rng.choice([1, 1, 2])
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, minhash.near_duplicates(df, words=2, **blocks).collect()), key=repr)
    assert got == brute(rows, 2)
    assert 3 < len({r[2] for r in got}) < 200


def test_empty_table(documents):
    assert minhash.near_duplicates(documents.limit(0)).count() == 0


def test_components_of_random_graphs(spark):
    rng = random.Random(5)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)]
    links += [(k, k + 1) for k in range(400, 460)] + [(500, k) for k in range(501, 540)]
    df = spark.createDataFrame(links, "a long, b long")
    got = dict(map(tuple, components.connected_components(df, "t").collect()))
    used = {n for e in links if e[0] != e[1] for n in e}
    want = roots(used, links)
    assert got == want
    assert components.connected_components(df.limit(0), "t").count() == 0
