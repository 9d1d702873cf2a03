import numpy as np
from conftest import SF
from test_op4_minhash import roots

from gaugeline.llm import embedding_dedup as op


def brute(rows, cosine=0.9):
    good = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        scaled = np.array(v, float) / max(map(abs, v))  # squares of tiny components are zero
        good[i] = scaled / np.linalg.norm(scaled)
    ids = sorted(good)
    unit = np.array([good[i] for i in ids])
    linked = unit @ unit.T >= cosine
    np.fill_diagonal(linked, False)
    links = [(ids[a], ids[b]) for a, b in zip(*np.nonzero(np.triu(linked)))]
    root = roots({i for i, _ in rows if i is not None}, links)
    n = dict(zip(ids, linked.sum(axis=1).tolist()))
    return sorted(((i, n.get(i, 0), root.get(i), i is None or root[i] == i) for i, _ in rows),
                  key=repr)


def check(df, **more):
    rows = [(r[0], r[1]) for r in df.select("vec_id", "embedding").collect()]
    got = sorted(map(tuple, op.near_duplicate_vectors(df, **more).collect()), key=repr)
    want = brute(rows)
    assert sum(r[1] for r in got) >= 0.9 * sum(r[1] for r in want)
    assert got == want


def test_table_as_brute_force(spark):
    check(spark.read.parquet(f"{SF}/embeddings.parquet"))


def test_groups_copies_and_blocks(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(30, 16))
    rows = [(k, (base[k % 30] + 0.08 * rng.normal(size=16)).tolist()) for k in range(300)]
    rows += [(1_000 + k, base[0].tolist()) for k in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    check(df, block=16)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, [0.0, 0.0, 0.0]), (3, [1.0, None, 0.0]), (4, [nan, 1.0, 0.0]),
            (5, [inf, 1.0, 0.0]), (6, [1.0, 2.0, 3.0]), (7, [2.0, 4.0, 6.0]),
            (8, [1e300, 2e300, 3e300]), (9, [-1.0, -2.0, -3.0]), (10, [1e-300, 0.0, 0.0]),
            (11, [5.0, 0.0, 0.0])]
    df = spark.createDataFrame([(i, v, 0, "x") for i, v in rows],
                               "vec_id long, embedding array<double>, n_links int, kept string")
    check(df)
    got = op.near_duplicate_vectors(df.unionByName(
        spark.createDataFrame([(None, [1.0, 2.0, 3.0], 0, "x"), (6, [1.0, 2.0, 3.0], 0, "x")],
                              df.schema))).collect()
    assert [tuple(r) for r in got if r["vec_id"] == 6] == [(6, 2, 6, True)] * 2
    assert [tuple(r) for r in got if r["vec_id"] is None] == [(None, 0, None, True)]
    assert op.near_duplicate_vectors(df.limit(0)).count() == 0
    assert op.near_duplicate_vectors(df.where("vec_id < 4")).count() == 3


def test_cells_come_in_order_of_distance():
    rng = np.random.default_rng(7)
    x = rng.normal(size=(50, 8))
    index = op.MultiIndex(rng.normal(size=(6, 4)), rng.normal(size=(6, 4)), 9)
    far = (op.distances(x[:, :4], index.first)[:, :, None]
           + op.distances(x[:, 4:], index.second)[:, None, :]).reshape(50, -1)
    assert (index.cells(x) == np.argsort(far, axis=1)[:, :9]).all()


def brute_by_length(df):
    rows = [(r[0], r[1]) for r in df.select("vec_id", "embedding").collect()]
    return sorted((r for n in {len(v) for _, v in rows}
                   for r in brute([x for x in rows if len(x[1]) == n])), key=repr)


def test_every_length_is_compared(spark):
    rng = np.random.default_rng(5)
    rows = []
    for n, count in ((1, 30), (2, 25), (5, 40), (16, 60)):
        base = rng.normal(size=(8, n))
        rows += [(len(rows) + k, (base[k % 8] * (1 + k) + 0.02 * rng.normal(size=n)).tolist())
                 for k in range(count)]
    rows += [(500, [2.0]), (501, [2.0]), (502, [1.0] * 7), (503, [1.0] * 7), (504, [1.0] * 9)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    for part in (df, df.where("size(embedding) = 1"), df.where("vec_id >= 502")):
        got = sorted(map(tuple, op.near_duplicate_vectors(part).collect()), key=repr)
        assert got == brute_by_length(part)


def test_visits_grow_until_the_recall_is_met():
    rng = np.random.default_rng(3)
    sample = rng.normal(size=(2_000, 16))
    sample /= np.linalg.norm(sample, axis=1, keepdims=True)
    few = op.fit(sample, codes=16, cosine=0.6, recall=0.99, most=2)
    many = op.fit(sample, codes=16, cosine=0.6, recall=0.99, most=256)
    assert few.visits == many.visits > 2
