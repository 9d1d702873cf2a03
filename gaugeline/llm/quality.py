"""Quality by importance resampling: hashed n-gram models of target and raw text.

Two bags of hashed n-grams are estimated, one from texts labelled good, one from all texts. A text's
log importance weight is the sum of its n-grams' log ratios; Gumbel noise added to it and the k
largest taken sample k texts without replacement in proportion to weight. The n-grams are those of
words and of word shapes (case, digits, punctuation, repetition), each in a table of its own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from gaugeline.llm.common import hash_sample, store

TOKENS = re.compile(r"\w+|[^\w\s]+").findall
REMEMBERED = 100_000
#: Buckets of word n-grams, and of n-grams of three shapes of 16 kinds.
WORDS, SHAPES = 1 << 12, 1 << 12
COUNTS = pa.schema([("target", pa.bool_()), ("bucket", pa.int32()), ("count", pa.int64())])
SCORES = pa.schema([("doc_id", pa.int64()), ("label", pa.int32()), ("half", pa.int32()),
                    ("log_weight", pa.float64()), ("uniform", pa.float64())])


def shape(token: str) -> int:
    if token.islower():
        return 0
    if token.istitle():
        return 1
    if token.isupper():
        return 2 if len(token) > 1 else 1
    if token.isdigit():
        return 3
    return 5 if token[0].isalnum() or token[0] == "_" else 4


class TokenCodes(dict):
    """A token's 64-bit hash with its shape in the lowest three bits."""

    def __missing__(self, token: str) -> int:
        value = xxhash.xxh3_64_intdigest(token.lower()) & ~7 | shape(token)
        if len(self) < REMEMBERED:
            self[token] = value
        return value


CODES = TokenCodes()


def ngrams(text: str | None) -> np.ndarray:
    """Buckets of a text's word 1- and 2-grams and, above them, of its shape 3-grams."""
    tokens = TOKENS(text) if text else []
    if not tokens:
        return np.zeros(0, np.int64)
    code = np.fromiter(map(CODES.__getitem__, tokens), np.uint64, len(tokens))
    word = code >> np.uint64(3)
    prime, shift = np.uint64(0x9E3779B97F4A7C15), np.uint64(64 - 12)
    pair = (word[:-1] * prime ^ word[1:]) * np.uint64(0xC2B2AE3D27D4EB4F)
    kind = (code & np.uint64(7)).astype(np.int64)
    kind[1:] |= 8 * (word[1:] == word[:-1])
    kind[2:] |= 8 * (word[2:] == word[:-2])
    edged = np.r_[15, 15, kind]
    triple = edged[:-2] << 8 | edged[1:-1] << 4 | edged[2:]
    return np.concatenate([((word * prime) >> shift).astype(np.int64),
                           (pair >> shift).astype(np.int64), WORDS + triple])


def count_task(batches) -> Iterator[pa.RecordBatch]:
    size = WORDS + SHAPES
    counts = {True: np.zeros(size, np.int64), False: np.zeros(size, np.int64)}
    for batch in batches:
        for target, text in zip(batch["target"].to_pylist(), batch["text"]):
            own = np.bincount(ngrams(text.as_py()), minlength=size)
            counts[False] += own
            if target:
                counts[True] += own
    for target, total in counts.items():
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([target] * len(at)), pa.array(at.astype(np.int32)), pa.array(total[at])],
            schema=COUNTS)


def score_task(batches, ratios: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        weights = [float(ratios[ngrams(t.as_py())].sum()) for t in batch["text"]]
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], batch["label"], batch["half"], pa.array(weights, pa.float64()),
             batch["uniform"]], schema=SCORES)


@dataclass
class ImportanceModel:
    """Log ratio of each n-gram bucket, and the log weight that best parts the labelled texts."""

    ratios: np.ndarray
    cut: float = float("-inf")


def log_ratios(target: np.ndarray, raw: np.ndarray, smoothing: float = 1.0) -> np.ndarray:
    """Log of the target's over the raw text's bucket probabilities, for each table of n-grams."""
    out = np.zeros(len(raw))
    for part in (slice(0, WORDS), slice(WORDS, WORDS + SHAPES)):
        p, q = target[part] + smoothing, raw[part] + smoothing
        out[part] = np.log(p / p.sum()) - np.log(q / q.sum())
    return out if target.any() else np.zeros(len(raw))


def best_cut(good: np.ndarray, bad: np.ndarray) -> float:
    """Where the shares of good values below and bad values above add up to least; in the middle of
    the gap there, the lowest one of several. Without good or without bad values nothing is cut."""
    if not len(good) or not len(bad):
        return float("-inf")
    values = np.unique(np.r_[good, bad])
    edges = np.r_[values[0] - 1, (values[:-1] + values[1:]) / 2, values[-1] + 1]
    wrong = (np.searchsorted(np.sort(good), edges) / len(good)
             + 1 - np.searchsorted(np.sort(bad), edges) / len(bad))
    return float(edges[wrong.argmin()])


def kth_largest(df: DataFrame, column: str, k: int, bins: int = 4096) -> float:
    """A value that the k largest of a column reach and, but for ties, no others.

    Counts in ever narrower bins; the driver sees a bin count at a time, and nothing is sorted.
    """
    low, high = df.agg(F.min(column), F.max(column)).first()
    if low is None or k <= 0:
        return float("inf")
    above = 0
    while True:
        step = (high - low) / bins
        if step <= 0 or low + step == low:
            return low
        inside = df.where(F.col(column).between(low, high))
        place = F.least(F.floor((F.col(column) - low) / step), F.lit(bins - 1)).alias("bin")
        counts = dict(inside.groupBy(place).count().collect())
        for b in sorted(counts, reverse=True):
            if above + counts[b] >= k:
                break
            above += counts[b]
        first, last = inside.where(place == b).agg(F.min(column), F.max(column)).first()
        if above + counts[b] == k or first == last:
            return first
        low, high = first, last


def with_labels(docs: DataFrame, labels: DataFrame, rows: int, seed: int) -> DataFrame:
    """doc_id, text, label (of a bounded sample, else null), half (fit on 0, calibrate on 1)."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    sample = (hash_sample(known.groupBy(F.col("doc_id").cast("long").alias("doc_id"))
                          .agg(F.min("quality").cast("int").alias("label")),
                          F.col("doc_id"), rows).select("doc_id", "label"))
    return (docs.select(F.col("doc_id").cast("long"), "text")
            .join(F.broadcast(sample), "doc_id", "left")  # at most ``rows`` rows
            .withColumn("half", F.pmod(F.xxhash64(F.lit(seed), "text"), F.lit(2)).cast("int")))


def fit(labelled: DataFrame) -> ImportanceModel:
    """Models of good and of all texts from a frame of text, label and half."""
    good = F.coalesce((F.col("label") == 1) & (F.col("half") == 0), F.lit(False))
    counted = (labelled.select(good.alias("target"), "text")
               .mapInArrow(count_task, from_arrow_schema(COUNTS))
               .groupBy("target", "bucket").agg(F.sum("count").alias("count")).toPandas())
    tables = np.zeros((2, WORDS + SHAPES))
    tables[counted["target"].astype(int), counted["bucket"]] = counted["count"]
    return ImportanceModel(log_ratios(tables[1], tables[0]))


def importance_resample(docs: DataFrame, labels: DataFrame, k: int | None = None,
                        rows: int = 20_000, seed: int = 6) -> DataFrame:
    """One row per row of ``docs``: doc_id, log_weight, gumbel_key, kept.

    The target is the texts that ``labels`` (doc_id, quality) calls good, 1; the raw model counts
    the whole texts of all rows. Of the labels the ``rows`` ids with the smallest hashes are used (a
    bound); an id labelled both ways counts as bad. Half of them fit the target and the others
    calibrate: without ``k``, as many rows are kept as have a weight above the value that parts good
    from bad best.

    Null and empty texts have weight 0 (no evidence). Noise depends on the text and ``seed`` alone,
    so copies go together, and rows tied at the cut are all kept. Without labels of both kinds, and
    without ``k``, all rows are kept. Rows without doc_id are scored like others. Texts of any length
    are read whole, an empty table gives no rows, and other columns of either table are not read,
    whatever their names.
    """
    labelled = with_labels(docs, labels, rows, seed)
    model = fit(labelled)
    shared = docs.sparkSession.sparkContext.broadcast(model.ratios)
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(seed + 1), "text"), 11)
    uniform = (draw.cast("double") + 0.5) / float(1 << 53)
    scored = store(labelled.withColumn("uniform", uniform).mapInArrow(
        lambda batches: score_task(batches, shared.value), from_arrow_schema(SCORES)), "weights")
    keyed = scored.withColumn("gumbel_key",
                              F.col("log_weight") - F.log(-F.log(F.col("uniform"))))
    if k is None:
        held = scored.where("half = 1 and label is not null").select("label", "log_weight")
        found = held.toPandas()  # at most ``rows`` rows
        cut = best_cut(*(found.loc[(found["label"] == 1) == good, "log_weight"].to_numpy()
                         for good in (True, False)))
        k = scored.where(F.col("log_weight") >= cut).count()
    least = kth_largest(keyed, "gumbel_key", k)
    return keyed.select("doc_id", "log_weight", "gumbel_key",
                        (F.col("gumbel_key") >= least).alias("kept"))
