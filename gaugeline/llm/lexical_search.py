"""Ranked lexical search of many items at once, by common-subexpression evaluation.

Items are weighted term sets and a document's score is a sum over their terms, so items that share
terms share parts of their sums. The shared sets are mined first: in rounds, terms of an item are put
in order of how many items have them, and pairs close by that two or more items share become a node, the
sum of both. Nodes and items form a DAG. Documents are then read in blocks: each node's accumulator,
one partial score for each document of the block, is worked out once and added into everything that
uses it, level by level; items are sums of few nodes. Each task keeps the best documents of an item
in its own rows, and those are ranked over all tasks.

Documents are cut into words once and stored as term vectors, of the terms that items have. Equal
items are evaluated once. Items are taken in blocks of bounded size, each block's result stored before
the next is planned.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from gaugeline.llm.common import HASHES, HashFilter, store

#: Every byte that is no letter, digit or part of a character beyond ASCII to a space, A-Z lowered.
TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256))
BAGS = pa.schema([("item_id", pa.int64()), ("key", pa.binary()), ("place", pa.float64()),
                  ("terms", pa.list_(pa.int64())), ("times", pa.list_(pa.int64()))])
VECTORS = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int64())),
                     ("tfs", pa.list_(pa.int64()))])
HITS = pa.schema([("number", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])
#: Fixed values of the score: k1 in tenths, and the shares of b and the rest in hundredths.
SCALE, K1, B = 1_000_000_000, 12, 25


def term_counts(text: bytes | None) -> tuple[int, np.ndarray, np.ndarray]:
    """(number of terms, hashes of the distinct ones, their counts)."""
    counts = Counter(text.translate(TERM_BYTES).split()) if text else {}
    hashes = np.fromiter(map(HASHES.__getitem__, counts), np.uint64, len(counts)).view(np.int64)
    times = np.fromiter(counts.values(), np.int64, len(counts))
    return int(times.sum()), hashes, times


def bag_task(batches) -> Iterator[pa.RecordBatch]:
    """Items with at least one term as bags; ``place`` puts items with a common term close."""
    for batch in batches:
        rows = []
        for item, text in zip(batch["item_id"].to_pylist(), batch["text"]):
            _, terms, times = term_counts(text.as_py())
            if len(terms):
                order = np.argsort(terms)
                terms, times = terms[order], times[order]
                key = xxhash.xxh3_128_digest(terms.tobytes() + times.tobytes())
                spread = int.from_bytes(key[:3], "big") / (1 << 24)
                rows.append((item, key, float((int(terms[0]) >> 40) + spread), terms, times))
        columns = zip(*rows) if rows else [()] * len(BAGS)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, BAGS)], schema=BAGS)


def vector_task(batches, wanted: HashFilter) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        numbers, sizes, terms, times = [], [], [], []
        for text in batch["text"]:
            n, hashes, counts = term_counts(text.as_py())
            chosen = wanted.maybe(hashes)
            numbers.append(n)
            sizes.append(int(chosen.sum()))
            terms.append(hashes[chosen])
            times.append(counts[chosen])
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
        flat = [np.concatenate([np.zeros(0, np.int64), *x]) for x in (terms, times)]
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], pa.array(numbers, pa.int64()),
             *(pa.ListArray.from_arrays(offsets, pa.array(x, pa.int64())) for x in flat)],
            schema=VECTORS)


def shared_sets(items: list[list[int]], leaves: int, rounds: int = 12, reach: int = 16
                ) -> tuple[list[tuple[int, int]], list[list[int]]]:
    """Mine sets that several items share: (pairs of the inner nodes, nodes of each item).

    Nodes below ``leaves`` are given; node ``leaves + k`` is the sum of the pair k. In each round an item's
    nodes are put in the order of how many items have them, so that what items share lies together;
    pairs at most ``reach`` places apart are counted, and an item takes those that most items have. Time
    and memory are in proportion to the items' sizes.
    """
    pairs: list[tuple[int, int]] = []
    for _ in range(rounds):
        users = Counter(node for item in items for node in item)
        ordered = [sorted((n for n in item if users[n] > 1), key=lambda n: (-users[n], n))
                   for item in items]

        def near(item: list[int]) -> Iterator[tuple[int, int]]:
            return ((a, b) for k, a in enumerate(item) for b in item[k + 1:k + 1 + reach])

        counts = Counter(pair for item in ordered for pair in near(item))
        chosen: list[list[tuple[int, int]]] = []
        for item in ordered:
            used: set[int] = set()
            own = []
            for pair in sorted((p for p in near(item) if counts[p] > 1),
                               key=lambda p: (-counts[p], p)):
                if used.isdisjoint(pair):
                    used.update(pair)
                    own.append(pair)
            chosen.append(own)
        taken = Counter(pair for own in chosen for pair in own)
        numbers = {pair: leaves + len(pairs) + k for k, pair in enumerate(
            pair for pair, times in taken.items() if times > 1)}
        if not numbers:
            break
        pairs += numbers
        for k, own in enumerate(chosen):
            made = [pair for pair in own if pair in numbers]
            gone = {node for pair in made for node in pair}
            items[k] = [n for n in items[k] if n not in gone] + [numbers[pair] for pair in made]
    return pairs, items


@dataclass
class Plan:
    """The DAG of one block of items, as arrays. Leaves are (term, times in the item)."""

    terms: np.ndarray  # distinct hashes, sorted
    weights: np.ndarray  # of the terms
    leaf_term: np.ndarray
    leaf_times: np.ndarray
    levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]  # nodes and their two parts
    parts: np.ndarray  # nodes of all items, one after another
    starts: np.ndarray  # of each item in ``parts``
    nodes: int

    @classmethod
    def of(cls, bags: list[tuple[list[int], list[int]]], weight_of: dict[int, int]) -> Plan:
        """From (terms, times) of each item. Terms without a weight are in no document."""
        terms = np.array(sorted({t for own, _ in bags for t in own if t in weight_of}), np.int64)
        place = {int(t): k for k, t in enumerate(terms)}
        leaves: dict[tuple[int, int], int] = {}
        items = [[leaves.setdefault((place[t], n), len(leaves)) for t, n in zip(*bag) if t in place]
                 for bag in bags]
        pairs, items = shared_sets(items, len(leaves))
        depth = [0] * len(leaves)
        for a, b in pairs:
            depth.append(1 + max(depth[a], depth[b]))
        inner = np.array(pairs, np.int64).reshape(-1, 2)
        level = np.array(depth[len(leaves):], np.int64)
        levels = [(len(leaves) + at, inner[at, 0], inner[at, 1]) for at in (
            np.flatnonzero(level == d) for d in range(1, level.max(initial=0) + 1))]
        # An item without any term that occurs sums the empty node at the end.
        empty = len(leaves) + len(pairs)
        items = [item or [empty] for item in items]
        return cls(terms, np.array([weight_of[int(t)] for t in terms], np.int64),
                   *np.array(list(leaves), np.int64).reshape(-1, 2).T, levels,
                   np.concatenate([np.array(i, np.int64) for i in items]),
                   np.cumsum([0, *map(len, items)])[:-1], empty + 1)

    def additions(self) -> tuple[int, int]:
        """Sums for each document: with shared nodes, and if every item were summed alone."""
        size = np.ones(self.nodes, np.int64)
        for nodes, a, b in self.levels:
            size[nodes] = size[a] + size[b]
        inner = sum(len(nodes) for nodes, _, _ in self.levels)
        return inner + len(self.parts), int(size[self.parts].sum())

    def scores(self, doc: np.ndarray, term: np.ndarray, gain: np.ndarray, docs: int) -> np.ndarray:
        """Scores (items, docs) from the entries (document, term number, gain) of a block."""
        gains = np.zeros((len(self.terms), docs), np.int64)
        gains[term, doc] = gain * self.weights[term]
        partial = np.zeros((self.nodes, docs), np.int64)
        partial[:len(self.leaf_term)] = gains[self.leaf_term] * self.leaf_times[:, None]
        for nodes, a, b in self.levels:
            partial[nodes] = partial[a] + partial[b]
        return np.add.reduceat(partial[self.parts], self.starts, axis=0)


class Best:
    """The ``most`` best documents of each item so far: by score, then least doc_id, null last."""

    def __init__(self, items: int, most: int):
        self.most = most
        self.held: list[list[tuple[np.ndarray, ...]]] = [[] for _ in range(items)]
        self.size = np.zeros(items, np.int64)
        self.least = np.ones(items, np.int64)  # scores under this do not count

    def add(self, scores: np.ndarray, ids: np.ndarray, missing: np.ndarray) -> None:
        good = scores >= self.least[:, None]
        for item in np.flatnonzero(good.any(axis=1)).tolist():
            at = np.flatnonzero(good[item])
            self.held[item].append((scores[item, at], ids[at], missing[at]))
            self.size[item] += len(at)
            if self.size[item] >= 20 * self.most:
                self.cut(item)

    def cut(self, item: int) -> None:
        score, ids, missing = (np.concatenate(c) for c in zip(*self.held[item]))
        first = np.lexsort((ids, missing, -score))[:self.most]
        self.held[item] = [(score[first], ids[first], missing[first])]
        self.size[item] = len(first)
        if len(first) == self.most:
            self.least[item] = score[first[-1]]

    def rows(self) -> Iterator[pa.RecordBatch]:
        for item in np.flatnonzero(self.size).tolist():
            self.cut(item)
            score, ids, missing = self.held[item][0]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(ids), item)), pa.array(ids, mask=missing), pa.array(score)],
                schema=HITS)


def search_task(batches, plan: Plan, n_docs: int, n_terms: int, most: int, entries: int = 1 << 21
                ) -> Iterator[pa.RecordBatch]:
    """Best documents of a task for each item; ``entries`` bounds the accumulators of a block."""
    if not len(plan.terms):
        return
    best = Best(len(plan.starts), most)
    block = max(1, entries // (plan.nodes + len(plan.parts)))
    for batch in batches:
        ids = batch["doc_id"]
        missing = ids.is_null().to_numpy(zero_copy_only=False)
        numbers = ids.fill_null(0).to_numpy(zero_copy_only=False)
        total = batch["n"].to_numpy()
        base = 100 - B + B * total * n_docs // n_terms
        sizes = np.diff(batch["terms"].offsets.to_numpy())
        hashes, tf = (batch[c].flatten().to_numpy() for c in ("terms", "tfs"))
        doc = np.repeat(np.arange(batch.num_rows), sizes)
        term = np.minimum(np.searchsorted(plan.terms, hashes), len(plan.terms) - 1)
        known = plan.terms[term] == hashes
        doc, term, tf = doc[known], term[known], tf[known]
        gain = SCALE * tf // (1_000 * tf + K1 * base[doc])
        edges = np.searchsorted(doc, np.arange(0, batch.num_rows + block, block))
        for k, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
            if a < b:
                begin, end = k * block, min((k + 1) * block, batch.num_rows)
                best.add(plan.scores(doc[a:b] - begin, term[a:b], gain[a:b], end - begin),
                         numbers[begin:end], missing[begin:end])
    yield from best.rows()


def ranked(hits: DataFrame, by: str, most: int) -> DataFrame:
    """Rows of the ``most`` first places of each ``by``. Spark ranks in the tasks before it shuffles."""
    order = "ORDER BY score DESC, doc_id ASC NULLS LAST"
    return hits.withColumn("rank", F.expr(f"row_number() OVER (PARTITION BY {by} {order})")).where(
        F.col("rank") <= most)


def search(docs: DataFrame, items: DataFrame, most: int = 20, block_terms: int = 500_000
           ) -> DataFrame:
    """The ``most`` best documents of every row of ``items``: item_id, rank, doc_id, score.

    Terms are runs of ASCII letters and digits and characters beyond ASCII, A-Z lower-cased. With N
    documents that have a term, L terms in them, df documents with a term, w = floor(1000 * ln((2N + 2)
    / (2df + 1))) and m = 75 + 25 * n * N div L for a document of n terms, its score sums w * (10^9 * tf
    div (1000 * tf + 12 * m)) over the item's terms, repeats included. Only scores above 0 count;
    equal ones go by ascending doc_id, null last.

    Null and empty texts have no terms: such items have no rows, such documents are never found. Each
    row of ``items`` is an item of its own, so rows that share an item_id each have their ranks, and a
    null item_id stays null; each row of ``docs`` is a document of its own. Empty tables give no rows.
    Texts of any length are read whole. Other columns are not read, whatever their names.

    Terms are compared by 64-bit hashes. The driver plans one block of items at a time, of about
    ``block_terms`` distinct terms, or a single larger item.
    """
    spark = docs.sparkSession
    bags = store(items.select(F.col("item_id").cast("long"), F.col("text").cast("binary"))
                 .mapInArrow(bag_task, from_arrow_schema(BAGS)), "bags")
    wanted = spark.sparkContext.broadcast(HashFilter(
        bags.select(F.explode("terms").alias("hash")).distinct()))
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
    vectors = store(texts.mapInArrow(lambda batches: vector_task(batches, wanted.value),
                                     from_arrow_schema(VECTORS)), "vectors")
    n_docs, n_terms = vectors.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    # Equal items are one class. Only terms that occur have a row here.
    classes = store(bags.groupBy("key").agg(*[F.first(c).alias(c) for c in (
        "place", "terms", "times")]), "classes")
    count, size = classes.agg(F.count("*"), F.sum(F.size("terms"))).first()
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    if not count or not n_docs:
        return out
    weight = F.floor(1_000 * F.log((2.0 * n_docs + 2) / (2.0 * F.col("df") + 1)))
    frequencies = store(vectors.select(F.explode("terms").alias("term")).groupBy("term").agg(
        F.count("*").alias("df")).select("term", weight.alias("weight")), "weights")
    blocks = ceil(size / block_terms)
    shares = [k / blocks for k in range(1, blocks)]
    edges = classes.approxQuantile("place", shares, 0.1 / blocks) if shares else []
    found = []
    for low, high in zip([None, *edges], [*edges, None]):
        inside = classes
        if low is not None:
            inside = inside.where(F.col("place") > low)
        if high is not None:
            inside = inside.where(F.col("place") <= high)
        found.append(block_hits(inside, vectors, frequencies, n_docs, n_terms, most))
    hits = found[0]
    for other in found[1:]:
        hits = hits.unionByName(other)
    return (bags.select("item_id", "key").join(hits, "key")
            .select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))


def block_hits(inside: DataFrame, vectors: DataFrame, frequencies: DataFrame, n_docs: int,
               n_terms: int, most: int) -> DataFrame:
    """Stored (key, rank, doc_id, score) of the classes of one block."""
    spark = vectors.sparkSession
    terms = inside.select(F.explode("terms").alias("term")).distinct()
    weight_of = {r["term"]: r["weight"] for r in frequencies.join(terms, "term").collect()}
    rows = inside.select("key", "terms", "times").collect()
    plan = spark.sparkContext.broadcast(Plan.of([(r["terms"], r["times"]) for r in rows], weight_of))
    hits = vectors.select("doc_id", "n", "terms", "tfs").where(F.size("terms") > 0).mapInArrow(
        lambda batches: search_task(batches, plan.value, n_docs, n_terms, most),
        from_arrow_schema(HITS))
    keys = spark.createDataFrame([(k, r["key"]) for k, r in enumerate(rows)],
                                 "number long, key binary")
    return store(ranked(hits, "number", most).join(keys, "number")
                 .select("key", "rank", "doc_id", "score"), "hits")
