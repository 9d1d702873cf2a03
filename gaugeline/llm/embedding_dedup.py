"""Near-duplicate vectors by an inverted multi-index.

Each half of a vector has a codebook of its own; pairs of codes are the cells of a grid. From a
vector, cells are visited in order of distance by the multi-sequence rule, as many as are needed for
two vectors at the threshold to meet in a common one with the target probability, which is measured
on a sample. Vectors that meet are compared exactly, in blocks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from gaugeline.llm.common import hash_sample, store
from gaugeline.llm.components import connected_components

PLACED = pa.schema([("id", pa.int64()), ("weight", pa.int64()), ("vector", pa.binary()),
                    ("cells", pa.list_(pa.int64()))])
FOUND = pa.schema([("id", pa.int64()), ("links", pa.int64()), ("least", pa.int64())])


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows at length 1; scaled by their largest component first, so that nothing overflows."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, but for a term that is the same for all centres."""
    return (centres ** 2).sum(axis=1) - 2 * points @ centres.T


def k_means(points: np.ndarray, k: int, rng, rounds: int = 12) -> np.ndarray:
    centres = points[rng.choice(len(points), k, replace=k > len(points))].copy()
    for _ in range(rounds):
        nearest = distances(points, centres).argmin(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, points)
        count = np.bincount(nearest, minlength=k)
        centres[count > 0] = sums[count > 0] / count[count > 0, None]
    return centres


@dataclass
class MultiIndex:
    first: np.ndarray
    second: np.ndarray
    visits: int

    def cells(self, vectors: np.ndarray, visits: int | None = None) -> np.ndarray:
        """Nearest cells of each unit vector, nearest first.

        A cell at place (i, j) of the two sorted code lists comes after the (i + 1) * (j + 1) - 1
        cells before it in both, so only places with (i + 1) * (j + 1) <= visits are looked at.
        """
        n = min(visits or self.visits, len(self.first) * len(self.second))
        half = self.first.shape[1]
        far = (distances(vectors[:, :half], self.first), distances(vectors[:, half:], self.second))
        lists = [np.argsort(d, axis=1, kind="stable")[:, :n] for d in far]
        near = [np.take_along_axis(d, o, axis=1) for d, o in zip(far, lists)]
        places = [(i, j) for i in range(near[0].shape[1]) for j in range(near[1].shape[1])
                  if (i + 1) * (j + 1) <= n]
        i, j = (np.array(p) for p in zip(*places))
        order = np.argsort(near[0][:, i] + near[1][:, j], axis=1, kind="stable")[:, :n]
        return (np.take_along_axis(lists[0][:, i], order, axis=1) * len(self.second)
                + np.take_along_axis(lists[1][:, j], order, axis=1))


def fit(sample: np.ndarray, codes: int, cosine: float, recall: float, most: int = 64,
        seed: int = 9) -> MultiIndex:
    """Codebooks, and the number of visits two vectors need.

    Sampled vectors are paired with random ones at exactly the threshold cosine, the hardest case;
    ``visits`` is the least number at which the share ``recall`` of the pairs has a common cell, ``most``
    at first and twice as many as long as those do not do; visits of all cells find every pair.
    """
    rng = np.random.default_rng(seed)
    half = sample.shape[1] // 2
    index = MultiIndex(k_means(sample[:, :half], codes, rng), k_means(sample[:, half:], codes, rng),
                       most)
    x = sample[rng.choice(len(sample), min(len(sample), 1_000), replace=False)]
    aside = rng.normal(size=x.shape)
    aside -= (aside * x).sum(axis=1, keepdims=True) * x
    length = np.linalg.norm(aside, axis=1, keepdims=True)
    aside = np.divide(aside, length, out=np.zeros_like(aside), where=length > 0)
    y = cosine * x + np.sqrt(1 - cosine ** 2) * aside
    cells = len(index.first) * len(index.second)
    while True:
        met = meetings(index, x, y, most)
        index.visits = int(np.sort(met)[max(0, int(np.ceil(recall * len(met))) - 1)])
        if index.visits <= most or most >= cells:
            index.visits = min(index.visits, cells)
            return index
        most *= 2


def meetings(index: MultiIndex, x: np.ndarray, y: np.ndarray, most: int) -> np.ndarray:
    """Visits after which each pair has met: the earliest place, in the later of the two lists; one more
    than ``most`` where it has not."""
    out = []
    for k in range(0, len(x), 50):
        a, b = index.cells(x[k:k + 50], most), index.cells(y[k:k + 50], most)
        places = np.arange(a.shape[1])
        later = np.maximum(places[:, None], places[None, :])
        out.append(np.where(a[:, :, None] == b[:, None, :], later, most).min(axis=(1, 2)) + 1)
    return np.concatenate(out)


def place_task(batches, indexes: dict[int, tuple[int, MultiIndex]],
               kind: str) -> Iterator[pa.RecordBatch]:
    """Cells of each vector; those of a length are numbered from its own first one on."""
    for batch in batches:
        for k in range(0, batch.num_rows, 1_000):
            part = batch.slice(k, 1_000)
            sizes = np.array([len(v) for v in part["vector"]])
            for width in np.unique(sizes).tolist():
                own = part.take(pa.array(np.flatnonzero(sizes == width)))
                first, index = indexes[width]
                vectors = np.array(own["vector"].to_pylist(), kind)
                cells = first + index.cells(unit(vectors.astype(float)))
                yield pa.RecordBatch.from_arrays(
                    [own["id"], own["weight"],
                     pa.array([v.tobytes() for v in vectors], pa.binary()),
                     pa.array(list(cells), PLACED[3].type)], schema=PLACED)


def block_links(group: pa.Table, cosine: float, kind: str) -> pa.Table:
    """Links between two blocks of a cell's vectors, or within one.

    Each vector's number of linked rows counts pairs whose first common cell this is; ``least``
    joins it to the least id of its linked group in the blocks.
    """
    ids = group["id"].to_numpy()
    weight = group["weight"].to_numpy()
    vectors = unit(np.frombuffer(b"".join(group["vector"].to_pylist()), kind)
                   .reshape(len(ids), -1).astype(float))
    left, right = (group[c][0].as_py() for c in ("low", "high"))
    side = group["block"].to_numpy()
    a = np.flatnonzero(side == left)
    b = np.flatnonzero(side == right)
    linked = vectors[a] @ vectors[b].T >= cosine
    if left == right:
        np.fill_diagonal(linked, False)
    touched = np.union1d(a[linked.any(axis=1)], b[linked.any(axis=0)])
    if not len(touched):
        return FOUND.empty_table()
    cell = group["cell"][0].as_py()
    earlier = [[c for c in cells if c < cell] for cells in group["cells"].to_pylist()]
    column = {c: k for k, c in enumerate(sorted({c for cells in earlier for c in cells}))}
    has = np.zeros((len(ids), len(column) + 1), np.float32)
    for row, cells in enumerate(earlier):
        has[row, [column[c] for c in cells]] = 1
    counted = linked & (has[a] @ has[b].T == 0)
    links = np.zeros(len(ids), np.int64)
    links[a] += counted @ weight[b]
    if left != right:
        links[b] += counted.T @ weight[a]
    # Least id of each connected group of the block, by passing minima along links.
    far = np.iinfo(np.int64).max
    least = ids.copy()
    while True:
        from_b = np.where(linked, least[b][None, :], far).min(axis=1, initial=far)
        np.minimum.at(least, a, from_b)
        from_a = np.where(linked, least[a][:, None], far).min(axis=0, initial=far)
        before = least[b].copy()
        np.minimum.at(least, b, from_a)
        if (least[b] == before).all() and (
                np.where(linked, least[b][None, :], far).min(axis=1, initial=far)
                >= least[a]).all():
            break
    return pa.table([pa.array(ids[touched]), pa.array(links[touched]), pa.array(least[touched])],
                    schema=FOUND)


def near_duplicate_vectors(vectors: DataFrame, cosine: float = 0.9, recall: float = 0.995,
                           per_cell: int = 8, most_codes: int = 1024, sample: int = 20_000,
                           block: int = 1024) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding): vec_id, n_links, component_id, kept.

    Two vectors are linked where their cosine, in double precision, is at least ``cosine``; pairs
    are looked for with the target ``recall`` at the threshold itself and a higher one above it.
    ``n_links`` counts the other vectors linked directly, ``component_id`` is the least vec_id
    reachable, ``kept`` tells whether it is the vector's own.

    Null and zero vectors and vectors with null or non-finite components link with nothing; so do
    rows without vec_id, which have no component and are kept. Vectors are compared with those of
    their own length; of length 1, all of one sign are linked. Rows that share vec_id and vector are one
    vector; those that share only the id are one node, whose links are added. Equal vectors are one class
    and are not compared. An empty table gives no rows; other columns are not read, whatever their names.

    Each length has codebooks fitted on ``sample`` distinct vectors at most; every vector is indexed. Codes per
    half grow with the square root of the number of vectors, so that a cell keeps ``per_cell``. A
    cell of any size is compared block by block, none of them over ``block`` vectors on average.
    """
    spark = vectors.sparkSession
    kind = "<f4" if dict(vectors.dtypes)["embedding"] == "array<float>" else "<f8"
    number = "array<float>" if kind == "<f4" else "array<double>"
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast(number)
                          .alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    usable = rows.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & finite
                        & F.exists("vector", lambda x: x != 0))
    keyed = usable.withColumns({"h1": F.xxhash64("vector"),
                                "h2": F.xxhash64(F.lit(7), "vector")})
    members = store(keyed.groupBy("h1", "h2", "vec_id").agg(F.first("vector").alias("vector")),
                    "vectors")
    classes = store(members.groupBy("h1", "h2").agg(
        F.min("vec_id").alias("id"), F.count("*").alias("weight"),
        F.first("vector").alias("vector")), "vector-classes")
    width = F.size("vector")
    lengths = classes.groupBy(width.alias("n")).count().orderBy("n").collect()
    if not lengths:
        return rows.select("vec_id").withColumns({
            "n_links": F.lit(0).cast("long"), "component_id": F.col("vec_id"),
            "kept": F.lit(True)})
    indexes, first = {}, 0
    for n, total in lengths:
        if n < 2 or total < 2:
            continue
        codes = int(np.clip(round((total / per_cell) ** 0.5), 1, most_codes))
        chosen = hash_sample(classes.where(width == n), F.struct("h1", "h2"),
                             sample).select("vector").toArrow()
        indexes[n] = first, fit(unit(np.array(chosen["vector"].to_pylist(), float)), codes, cosine,
                                recall)
        first += codes ** 2
    shared = spark.sparkContext.broadcast(indexes)
    placed = store(classes.where(width.isin(list(indexes))).select("id", "weight", "vector")
                   .mapInArrow(lambda batches: place_task(batches, shared.value, kind),
                               from_arrow_schema(PLACED)), "placed")

    spread = placed.select("*", F.explode("cells").alias("cell"))
    blocks = (placed.select(F.explode("cells").alias("cell")).groupBy("cell").count()
              .where("count > 1").select("cell", F.ceil(F.col("count") / block).cast("int")
                                         .alias("blocks")))
    blocked = spread.join(blocks, "cell").withColumn(
        "block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    paired = (blocked.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
              .drop("other", "blocks"))
    found = store(paired.groupBy("cell", "low", "high").applyInArrow(
        lambda group: block_links(group, cosine, kind), from_arrow_schema(FOUND)), "vector-links")
    if cosine <= 1 and any(n == 1 for n, _ in lengths):
        # Two vectors of length 1 have the cosine 1 or -1, so sums by sign count the links.
        single = classes.where(width == 1).withColumn("positive", F.get("vector", F.lit(0)) > 0)
        signs = single.groupBy("positive").agg(F.sum("weight").alias("all"),
                                               F.min("id").alias("least"))
        found = found.unionByName(single.join(F.broadcast(signs), "positive").select(
            "id", (F.col("all") - F.col("weight")).alias("links"), "least"))

    counts = found.groupBy("id").agg(F.sum("links").alias("found"))
    by_class = (members.join(classes.select("h1", "h2", "id", "weight"), ["h1", "h2"])
                .join(counts, "id", "left"))
    linked = by_class.select("vec_id", "id", (F.coalesce("found", F.lit(0)) + F.col("weight") - 1)
                             .alias("links"))
    edges = (found.select(F.col("id").alias("a"), F.col("least").alias("b"))
             .unionByName(linked.select(F.col("vec_id").alias("a"), F.col("id").alias("b"))))
    nodes = connected_components(edges, "vector-components")
    totals = linked.groupBy("vec_id").agg(F.sum("links").alias("links"))
    component = F.coalesce("component", "vec_id")
    return (rows.select("vec_id").join(totals, "vec_id", "left")
            .join(nodes.withColumnRenamed("node", "vec_id"), "vec_id", "left")
            .select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                    component.alias("component_id"),
                    F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept")))
