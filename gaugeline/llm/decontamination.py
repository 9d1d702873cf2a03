"""Benchmark passages in training text, by a positional inverted index spread over the cluster.

The index is cut by documents into segments of bounded size, one stored row each, holding every
indexed term's postings: positions counted through the segment, with a gap between documents that no
match can bridge. Which terms those are is told by a bitmap of the terms that test items have, of
bounded size. Test windows come in blocks of bounded size, each block's result stored before the next
is read. In each segment a window starts from
the postings of its rarest term there, moved by the term's offset, and intersects them with the
moved postings of the next rarest. A window with a term the segment lacks costs nothing more.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from gaugeline.llm.common import HASHES, HashFilter, store
#: Lower-cases A-Z and blanks every other ASCII byte but digits and a-z; other bytes stay.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32
             for b in range(256))
SEGMENT = pa.schema([
    ("segment", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("n_words", pa.list_(pa.int32())),
    ("terms", pa.list_(pa.binary())), ("sizes", pa.list_(pa.int32())), ("steps", pa.binary())])
SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32())])
MATCH = pa.schema([
    ("segment", pa.int64()), ("ordinal", pa.int32()), ("doc_id", pa.int64()),
    ("n_words", pa.int64()), ("hits", pa.list_(SPAN)), ("items", pa.list_(pa.int64())),
    ("near_items", pa.list_(pa.int64()))])


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(FOLD).split() if text else []


def starts_of(n_words: np.ndarray, gap: int) -> np.ndarray:
    """Position of each document's first word in its segment."""
    return np.cumsum(n_words.astype(np.int64) + gap) - n_words - gap


def term_task(batches) -> Iterator[pa.RecordBatch]:
    """Hashes of the distinct terms of a batch of test items."""
    for batch in batches:
        terms = {w for text in batch["text"] for w in words_of(text.as_py())}
        hashes = np.fromiter(map(HASHES.__getitem__, terms), np.uint64, len(terms))
        yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64))], names=["hash"])


class SegmentTerms(dict):
    """Numbers of a segment's terms in the order they come; -1 for those that the filter lacks."""

    def __init__(self, wanted: HashFilter):
        super().__init__()
        self.wanted, self.names = wanted, []

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.names) if self.wanted.may_hold(HASHES[word]) else -1
        if number >= 0:
            self.names.append(word)
        return number


def postings(batches, wanted: HashFilter, gap: int, segment_words: int) -> Iterator[pa.RecordBatch]:
    first, written = TaskContext.get().partitionId() << 40, 0
    doc_ids, sizes, ids, vocabulary = [], [], [], SegmentTerms(wanted)

    def segment() -> pa.RecordBatch:
        nonlocal written, vocabulary
        n_words = np.array(sizes, np.int32)
        flat = np.concatenate(ids)
        position = np.arange(len(flat)) + np.repeat(gap * np.arange(len(n_words)), n_words)
        position = position[flat >= 0].astype(np.int32)
        flat = flat[flat >= 0]
        order = np.argsort(flat, kind="stable")
        counts = np.bincount(flat, minlength=len(vocabulary.names))
        row = [[first + written], [doc_ids[:]], [n_words], [vocabulary.names],
               [counts.astype(np.int32)],
               [np.diff(position[order], prepend=np.int32(0)).tobytes()]]
        written += 1
        for done in (doc_ids, sizes, ids):
            done.clear()
        vocabulary = SegmentTerms(wanted)
        return pa.RecordBatch.from_arrays(
            [pa.array(v, f.type) for v, f in zip(row, SEGMENT)], schema=SEGMENT)

    pending = 0
    for batch in batches:
        for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
            words = words_of(text.as_py())
            ids.append(np.fromiter(map(vocabulary.__getitem__, words), np.int32, len(words)))
            doc_ids.append(doc_id)
            sizes.append(len(words))
            pending += len(words) + 1
            if pending >= segment_words:
                yield segment()
                pending = 0
    if doc_ids:
        yield segment()


def build_index(docs: DataFrame, wanted: HashFilter, gap: int = 64,
                segment_words: int = 400_000) -> DataFrame:
    """Segments of a positional index over the whole texts, one row each.

    Terms that the filter surely lacks have no postings; documents keep their order and number of
    words."""
    shared = docs.sparkSession.sparkContext.broadcast(wanted)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(
        lambda batches: postings(batches, shared.value, gap, segment_words),
        from_arrow_schema(SEGMENT))


@dataclass
class Windows:
    """Windows of one block of test items; ``terms`` are numbered, short windows padded with -1."""

    names: list[bytes]
    terms: np.ndarray
    item: np.ndarray
    item_ids: list[int | None]

    @classmethod
    def of(cls, items: list[tuple[int | None, bytes]], width: int) -> Windows:
        vocabulary: dict[bytes, int] = {}
        rows, owner = [], []
        for k, (_, text) in enumerate(items):
            ids = [vocabulary.setdefault(w, len(vocabulary)) for w in words_of(text)]
            short = [ids + [-1] * (width - len(ids))] if 0 < len(ids) < width else []
            windows = short or [ids[i:i + width] for i in range(len(ids) - width + 1)]
            rows += windows
            owner += [k] * len(windows)
        return cls(list(vocabulary), np.array(rows, np.int32).reshape(-1, width),
                   np.array(owner, np.int64), [i for i, _ in items])


class Segment:
    def __init__(self, row: dict):
        self.sizes = np.array(row["sizes"], np.int64)
        self.ends = np.cumsum(self.sizes)
        self.positions = np.cumsum(np.frombuffer(row["steps"], np.int32), dtype=np.int32)
        self.place = {t: k for k, t in enumerate(row["terms"])}

    def of(self, k: int) -> np.ndarray:
        return self.positions[self.ends[k] - self.sizes[k]:self.ends[k]]

    @staticmethod
    def within(sorted_at: np.ndarray, wanted: np.ndarray, slop: int) -> np.ndarray:
        """Which wanted positions have a posting at most ``slop`` away."""
        at = np.searchsorted(sorted_at, wanted - slop)
        return (at < len(sorted_at)) & (sorted_at[np.minimum(at, len(sorted_at) - 1)]
                                        <= wanted + slop)

    def matches(self, windows: Windows, slop: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(window, starts, exact): where its terms stand within ``slop`` of their places, and
        whether all stand exactly there."""
        local = np.array([self.place.get(n, -1) for n in windows.names] + [-1], np.int64)
        counts = np.r_[self.sizes, 0][local]
        counts[-1] = np.iinfo(np.int64).max  # padding
        rarity = counts[windows.terms]
        for w in np.flatnonzero((rarity > 0).all(axis=1)):
            terms = windows.terms[w]
            order = [o for o in np.argsort(rarity[w], kind="stable") if terms[o] >= 0]
            start = self.of(local[terms[order[0]]]) - order[0]
            exact = np.ones(len(start), bool)
            for o in order[1:]:
                postings_at = self.of(local[terms[o]])
                near = self.within(postings_at, start + o, slop)
                start, exact = start[near], exact[near]
                if not len(start):
                    break
                exact &= self.within(postings_at, start + o, 0)
            if len(start):
                yield w, start, exact


def match_task(batches, windows: Windows, gap: int, slop: int) -> Iterator[pa.RecordBatch]:
    width = np.count_nonzero(windows.terms >= 0, axis=1)
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1).to_pylist()[0]
            n_words = np.array(row["n_words"], np.int64)
            starts = starts_of(n_words, gap)
            size = int(starts[-1] + n_words[-1] + gap + 1)
            edge = np.zeros(size + 1, np.int64)
            found: dict[bool, set] = {True: set(), False: set()}
            for w, start, exact in Segment(row).matches(windows, slop):
                item = windows.item_ids[windows.item[w]]
                sure = start[exact]
                np.add.at(edge, sure, 1)
                np.add.at(edge, sure + width[w], -1)
                for kind, at in ((True, sure), (False, start)):
                    # A near match may begin in the gap before its document.
                    docs = np.searchsorted(starts, at + slop * (not kind), side="right") - 1
                    if item is not None:
                        found[kind].update((d, item) for d in set(docs.tolist()))
            hit = np.r_[False, np.cumsum(edge) > 0]
            change = np.flatnonzero(hit[1:] != hit[:-1])
            hits: list[list] = [[] for _ in starts]
            for begin, end in zip(change[::2], change[1::2]):
                d = int(np.searchsorted(starts, begin, side="right") - 1)
                hits[d].append({"start": int(begin - starts[d]), "end": int(end - starts[d])})
            items = {kind: [[] for _ in starts] for kind in found}
            for kind, pairs in found.items():
                for d, item in sorted(pairs):
                    items[kind][d].append(item)
            n = len(starts)
            columns = [[row["segment"]] * n, list(range(n)), row["doc_ids"], n_words, hits,
                       items[True], items[False]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, MATCH)], schema=MATCH)


def find_passages(docs: DataFrame, tests: DataFrame, width: int = 10, slop: int = 2,
                  block_bytes: int = 8 << 20) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, hits, items, near_items.

    ``hits`` are the maximal word spans covered by exact occurrences of windows of ``tests``
    (item_id, text), ``items`` the ids of items with such a window, ``near_items`` of those with a
    window whose words all stand at most ``slop`` places off. A window is ``width`` consecutive
    words; an item with fewer is one window; an item without words has none.

    Null and empty texts have no words; an item whose id is null marks words but is not listed;
    items that share an id count once; rows of ``docs`` that share one are matched each. Texts of any
    length are read whole, empty tables give no rows or no hits, and other columns are not read, whatever
    their names. Distinct test items come to the driver and tasks in blocks of about ``block_bytes``, one
    at a time. Only with several blocks are results, not texts, grouped by document.
    """
    gap = width + 2 * slop + 1
    items = store(tests.select(F.col("item_id").cast("long"), F.col("text").cast("binary").alias("text"))
                  .where(F.col("text").isNotNull()).distinct(), "test-items")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-total // block_bytes) or 1
    numbered = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))

    def windows(block: int) -> Windows:
        rows = numbered.where(F.col("block") == block).select("item_id", "text").collect()
        return Windows.of(sorted(((i, bytes(t)) for i, t in rows),
                                 key=lambda r: (r[0] is None, r)), width)

    terms = items.select("text").mapInArrow(term_task, "hash long").distinct()
    index = store(build_index(docs, HashFilter(terms), gap), "postings")

    def matched(block: int) -> DataFrame:
        own = docs.sparkSession.sparkContext.broadcast(windows(block))
        return index.mapInArrow(lambda batches: match_task(batches, own.value, gap, slop),
                                from_arrow_schema(MATCH))

    if blocks == 1:
        return matched(0).drop("segment", "ordinal")
    found = store(matched(0), "passages")
    for block in range(1, blocks):
        found = found.unionByName(store(matched(block), "passages"))
    gathered = found.groupBy("segment", "ordinal").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
        *[F.flatten(F.collect_list(c)).alias(c) for c in ("hits", "items", "near_items")])
    return gathered.select("doc_id", "n_words", merged(F.col("hits")).alias("hits"),
                           F.array_distinct("items").alias("items"),
                           F.array_distinct("near_items").alias("near_items"))


def merged(hits: Column) -> Column:
    """Spans sorted, those that overlap or touch joined."""
    def step(done: Column, s: Column) -> Column:
        last = F.element_at(done, -1)
        apart = (F.size(done) == 0) | (s["start"] > F.try_element_at(done, F.lit(-1))["end"])
        return F.when(apart, F.concat(done, F.array(s))).otherwise(F.concat(
            F.slice(done, 1, F.size(done) - 1),
            F.array(F.struct(last["start"].alias("start"),
                             F.greatest(last["end"], s["end"]).alias("end")))))
    return F.aggregate(F.array_sort(hits), F.slice(hits, 1, 0), step)


def hit_words(hits: Column) -> Column:
    return F.aggregate(hits, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
