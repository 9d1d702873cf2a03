"""Near-duplicates by MinHash: universal hash minima, bands, verification, components.

Documents with equal shingle sets are one class from the start, so copies are never compared. Of
each bucket of a band only links to its most central class are tried at first, the one that meets
most others in all its buckets, and one link per class: that shared in most bands. Once components
are known, buckets that hold more than one component are looked at again, across components only and
in blocks of bounded size, where sizes and signatures are compared on the spot; what leaves a block
is likely links, each from the first bucket that both classes share. A component of many classes is
compared with the outsiders it shares buckets with in blocks that give confirmed links. Every link
is confirmed on full shingle sets.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import DoubleType

from gaugeline.llm.common import HASHES, HashFilter, store
from gaugeline.llm.components import connected_components

#: Lower-cases A-Z, leaves every other byte.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
SKETCH = pa.schema([("doc_id", pa.int64()), ("size", pa.int64()), ("key", pa.binary()),
                    ("signature", pa.binary()), ("buckets", pa.list_(pa.int64()))])
LINK = pa.schema([("a", pa.int64()), ("b", pa.int64())])
SET = pa.schema([("id", pa.int64()), ("key", pa.binary()), ("shingles", pa.list_(pa.int64()))])



def shingle_set(text: bytes | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles; of the whole where it is shorter."""
    parts = text.translate(LOWER).split() if text else []
    if not parts:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(HASHES.__getitem__, parts), np.uint64, len(parts))
    length = min(words, len(parts))
    rolled = np.full(len(parts) - length + 1, length, np.uint64)
    for k in range(length):
        rolled = (rolled ^ hashes[k:len(parts) - length + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
        rolled ^= rolled >> np.uint64(29)
    return np.unique(rolled)


def set_key(shingles: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else None


@dataclass(frozen=True)
class Bands:
    """``count`` bands of ``rows`` minima. A pair of similarity s shares a bucket with probability
    1 - (1 - s ** rows) ** count: all but 1 in 29,000 at 0.8 for the default, one in two million
    at 0.1."""

    rows: int = 8
    count: int = 56
    seed: int = 20_261

    @functools.cached_property
    def coefficients(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        rng = np.random.default_rng(self.seed)
        n = self.rows * self.count
        return (rng.integers(0, 1 << 32, n, np.uint32) | np.uint32(1),
                rng.integers(0, 1 << 32, n, np.uint32),
                rng.integers(0, 1 << 63, (self.count, self.rows), np.uint64) | np.uint64(1))

    def minima(self, shingles: np.ndarray) -> np.ndarray:
        scale, shift, _ = self.coefficients
        low = np.full(len(scale), np.iinfo(np.uint32).max, np.uint32)
        values = (shingles >> np.uint64(32)).astype(np.uint32)
        for k in range(0, len(values), 512):
            hashed = scale[:, None] * values[None, k:k + 512] + shift[:, None]
            np.minimum(low, hashed.min(axis=1), out=low)
        return low

    def buckets(self, minima: np.ndarray) -> np.ndarray:
        weights = self.coefficients[2]
        mixed = (minima.reshape(self.count, self.rows).astype(np.uint64) + np.uint64(1)) * weights
        total = np.bitwise_xor.reduce(mixed ^ (mixed >> np.uint64(31)), axis=1)
        total = (total + np.arange(self.count, dtype=np.uint64)) * np.uint64(0xC2B2AE3D27D4EB4F)
        return (total ^ (total >> np.uint64(32))).view(np.int64)


def sketch_task(batches, words: int, bands: Bands) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, batch.num_rows, 1_000):
            part = batch.slice(k, 1_000)
            out: list[list] = [[], [], [], []]
            for text in part["text"]:
                shingles = shingle_set(text.as_py(), words)
                minima = bands.minima(shingles) if len(shingles) else None
                for column, value in zip(out, (
                        len(shingles), set_key(shingles),
                        None if minima is None else (minima & np.uint32(255)).astype(np.uint8)
                        .tobytes(), None if minima is None else bands.buckets(minima))):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [part["doc_id"], *(pa.array(c, f.type) for c, f in zip(out, list(SKETCH)[1:]))],
                schema=SKETCH)


def set_task(batches, words: int, ids: HashFilter) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        chosen = np.flatnonzero(ids.maybe(batch["hash"].to_numpy(zero_copy_only=False)))
        for k in range(0, len(chosen), 500):
            part = batch.take(pa.array(chosen[k:k + 500]))
            sets = [shingle_set(t.as_py(), words) for t in part["text"]]
            yield pa.RecordBatch.from_arrays(
                [part["doc_id"], pa.array([set_key(s) for s in sets], pa.binary()),
                 pa.array([s.view(np.int64) for s in sets], SET[2].type)], schema=SET)


def agreement(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Similarity of signatures of one byte per minimum, of which 1 in 256 agrees by chance."""
    return ((left == right).mean(axis=-1) - 1 / 256) / (1 - 1 / 256)


@F.pandas_udf(DoubleType())
def estimated_similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    if a.empty:
        return pd.Series([], dtype=float)
    left, right = (np.frombuffer(b"".join(s), np.uint8).reshape(len(s), -1) for s in (a, b))
    return pd.Series(agreement(left, right))


@dataclass
class Verifier:
    """Confirms candidate pairs of classes: by sizes, then signatures, then full sets."""

    classes: DataFrame  # id, size, signature
    sets: DataFrame  # id, shingles
    percent: int
    slack: float = 0.14  # more than six standard deviations of the estimate at 0.8

    def links(self, pairs: DataFrame) -> DataFrame:
        def side(name: str) -> DataFrame:
            return self.classes.select(F.col("id").alias(name), F.col("size").alias(f"size_{name}"),
                                       F.col("signature").alias(f"signature_{name}"))

        def members(name: str) -> DataFrame:
            return self.sets.select(F.col("id").alias(name),
                                    F.col("shingles").alias(f"set_{name}"))

        small, large = F.least("size_a", "size_b"), F.greatest("size_a", "size_b")
        likely = (pairs.join(side("a"), "a").join(side("b"), "b")
                  .where(100 * small >= self.percent * large)
                  .where(estimated_similarity("signature_a", "signature_b")
                         >= self.percent / 100 - self.slack)
                  .select("a", "b").distinct())
        shared = F.size(F.array_intersect("set_a", "set_b"))
        union = F.size("set_a") + F.size("set_b") - shared
        return (likely.join(members("a"), "a").join(members("b"), "b")
                .where(100 * shared >= self.percent * union).select("a", "b").distinct())


def likely_links(group: pa.Table, percent: int, slack: float) -> pa.Table:
    """Likely links between components in a block of a bucket, or between two blocks of it."""
    bucket = group["bucket"][0].as_py()
    first, second = group["row"][0].as_py(), group["column"][0].as_py()
    ids, component, size, own = (group[c].to_numpy() for c in ("id", "component", "size", "own"))
    signatures = np.frombuffer(b"".join(group["signature"].to_pylist()), np.uint8).reshape(len(ids), -1)
    buckets = np.array(group["buckets"].to_pylist())
    found: list[tuple] = []
    for k in np.flatnonzero(own == first):
        other = component > component[k] if first == second else component != component[k]
        other &= (own == second) & (ids != ids[k])
        other &= 100 * np.minimum(size, size[k]) >= percent * np.maximum(size, size[k])
        at = np.flatnonzero(other)
        at = at[agreement(signatures[at], signatures[k]) >= percent / 100 - slack]
        for m in at.tolist():
            shared = np.intersect1d(buckets[k], buckets[m])
            if len(shared) and shared[0] == bucket:
                found.append((ids[k], ids[m]))
    return pa.table([pa.array(c, pa.int64()) for c in (zip(*found) if found else ((), ()))],
                    schema=LINK)


def likely_across(open_: DataFrame, classes: DataFrame, percent: int, slack: float,
                  block: int) -> DataFrame:
    """Likely links (a, b) between the components that share a bucket of ``open_``; rows of a bucket
    go to tasks in blocks of ``block`` on average."""
    blocks = open_.groupBy("bucket").agg(F.ceil(F.count("*") / block).alias("blocks"))
    own = F.pmod(F.xxhash64("id"), F.col("blocks"))
    dealt = (open_.select("bucket", "id", "component").join(blocks, "bucket")
             .withColumn("own", own)
             .withColumn("facing", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
             .select("bucket", "id", "component", "own", F.least("own", "facing").alias("row"),
                     F.greatest("own", "facing").alias("column")))
    return (dealt.join(classes.select("id", "size", "signature", "buckets"), "id")
            .groupBy("bucket", "row", "column")
            .applyInArrow(lambda group: likely_links(group, percent, slack), from_arrow_schema(LINK)))


def block_links(group: pa.Table, percent: int) -> pa.Table:
    """Links between a block of a component's members and a block of outsiders."""
    own = group["own"].to_numpy(zero_copy_only=False)
    ids = group["id"].to_numpy()
    sets = [np.asarray(s.as_py(), np.int64) for s in group["shingles"]]
    inside = [k for k in np.flatnonzero(own)]
    if not inside or own.all():
        return LINK.empty_table()
    sizes = np.array([len(sets[k]) for k in inside])
    flat = np.concatenate([sets[k] for k in inside])
    starts = np.cumsum(sizes) - sizes
    found: list[tuple] = []
    for k in np.flatnonzero(~own):
        other = np.sort(sets[k])
        at = np.minimum(np.searchsorted(other, flat), len(other) - 1)
        shared = np.add.reduceat((other[at] == flat).astype(np.int64), starts)
        for m in np.flatnonzero(100 * shared >= percent * (sizes + len(other) - shared)):
            found.append((ids[inside[m]], ids[k]))
    return pa.table([pa.array(c, pa.int64()) for c in (zip(*found) if found else ((), ()))],
                    schema=LINK)


def large_component_links(open_: DataFrame, sets: DataFrame, percent: int,
                          block: int) -> DataFrame:
    """Links between components of over ``block`` classes and what else is in their open buckets.

    Of two large components the one with the smaller number is the outsider's host. Members and
    outsiders go to tasks in blocks of ``block`` and 8 * ``block`` on average.
    """
    large = open_.where(F.col("members") > block)
    hosts = large.select("bucket", F.col("component").alias("host")).distinct()
    outside = (open_.join(hosts, "bucket")
               .where((F.col("component") != F.col("host"))
                      & ((F.col("members") <= block) | (F.col("component") > F.col("host"))))
               .select("host", "id").distinct())
    inside = large.select(F.col("component").alias("host"), "id").distinct()

    def blocks(rows: DataFrame, name: str, size: int) -> DataFrame:
        return rows.groupBy("host").agg(F.ceil(F.count("*") / size).alias(name))

    counts = blocks(inside, "rows", block).join(blocks(outside, "others", 8 * block), "host")

    def dealt(rows: DataFrame, own: str, facing: str, is_own: bool) -> DataFrame:
        return (rows.join(counts, "host")
                .withColumns({own: F.pmod(F.xxhash64("id"), F.col(own)),
                              facing: F.explode(F.sequence(F.lit(0).cast("long"), F.col(facing) - 1))})
                .select("host", "rows", "others", "id", F.lit(is_own).alias("own")))

    both = dealt(inside, "rows", "others", True).unionByName(
        dealt(outside, "others", "rows", False))
    return (both.join(sets, "id").groupBy("host", "rows", "others")
            .applyInArrow(lambda group: block_links(group, percent), from_arrow_schema(LINK)))


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80,
                    bands: Bands = Bands(), block: int = 128,
                    bucket_block: int = 512) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Documents with 100 * |A & B| >= percent * |A | B| are linked, A and B their sets of distinct
    ``words``-word shingles (white-space words, A-Z lower-cased; the whole sequence where there are
    fewer words). ``component_id`` is the least doc_id reachable by links, ``kept`` tells whether it
    is the document's own. Null, empty and blank texts have no shingles and are linked with nothing.
    Rows that share a doc_id are one node, each with its own number of shingles; a row without
    doc_id is linked with nothing, has no component and is kept. Ties do not arise. Texts of any length
    are read whole, an empty table gives no rows, and other columns are not read, whatever their names.
    """
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
    sketches = store(texts.mapInArrow(lambda batches: sketch_task(batches, words, bands),
                                      from_arrow_schema(SKETCH)), "sketches")
    linkable = sketches.where(F.col("key").isNotNull() & F.col("doc_id").isNotNull())
    # Copies: one class for each set of shingles, combined before the shuffle.
    classes = store(linkable.groupBy("key").agg(
        F.min("doc_id").alias("id"), *[F.first(c).alias(c) for c in
                                       ("size", "signature", "buckets")]), "classes")
    # One id can name several sets; its sets are one node, and each is compared.
    entries = classes.select("id", F.explode("buckets").alias("bucket"))
    sizes = entries.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    met = store(entries.join(sizes, "bucket"), "met")
    # An original meets more classes than its edited copies do.
    central = met.groupBy("id").agg(F.sum("n").alias("meets"))
    leads = met.join(central, "id").groupBy("bucket").agg(
        F.max_by("id", F.struct("meets", -F.col("id"))).alias("lead"))
    shared = store(met.select("bucket", "id").join(leads, "bucket"), "shared")
    ids = shared.select("id").distinct()
    maybe = docs.sparkSession.sparkContext.broadcast(HashFilter(
        ids.select(F.xxhash64("id").alias("hash"))))
    found = texts.withColumn("hash", F.xxhash64("doc_id")).mapInArrow(
        lambda batches: set_task(batches, words, maybe.value), from_arrow_schema(SET))
    wanted = classes.join(ids, "id", "left_semi").select("id", "key")
    sets = store(found.join(wanted, ["id", "key"], "left_semi").dropDuplicates(["id", "key"])
                 .select("id", "shingles"), "sets")
    verify = Verifier(classes.select("id", "size", "signature"), sets, percent)

    best = (shared.where("id <> lead").groupBy("id", "lead").agg(F.count("*").alias("times"))
            .groupBy("id").agg(F.max_by("lead", F.struct("times", -F.col("lead"))).alias("a"))
            .select("a", F.col("id").alias("b")))
    first = store(verify.links(best), "links")
    parts = connected_components(first, "parts")

    # Buckets that still hold several components.
    placed = store(shared.select("bucket", "id").join(
        parts.select(F.col("node").alias("id"), "component"), "id", "left")
        .select("bucket", "id", F.coalesce("component", "id").alias("component")), "placed")
    mixed = (placed.groupBy("bucket").agg(F.min("component").alias("low"),
                                          F.max("component").alias("high"))
             .where("low <> high").select("bucket"))
    members = placed.groupBy("component").agg(F.count_distinct("id").alias("members"))
    open_ = store(placed.join(mixed, "bucket").join(members, "component"), "open")
    few = open_.where(F.col("members") <= block)
    across = store(likely_across(few, classes, percent, verify.slack, bucket_block).distinct(), "across")
    late = verify.links(across).unionByName(
        large_component_links(open_, sets, percent, block))
    copies = (linkable.join(classes.select("key", F.col("id").alias("b")), "key")
              .select(F.col("doc_id").alias("a"), "b").where("a <> b"))
    nodes = connected_components(
        first.unionByName(late).unionByName(copies), "components")
    component = F.coalesce("component", "doc_id")
    return (sketches.select("doc_id", F.col("size").alias("n_shingles"))
            .join(nodes.withColumnRenamed("node", "doc_id"), "doc_id", "left")
            .select("doc_id", "n_shingles", component.alias("component_id"),
                    F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept")))
