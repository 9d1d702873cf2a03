"""Repeated passages, by suffix automata of corpus shards.

A window of W words is repeated if its word sequence starts anywhere else. Every window has an
anchor, the least hash of its G-word grams, which depends on its words only: equal windows have equal
anchors. Anchors are counted over the corpus; windows whose anchor occurs once are done with. Runs of
windows with one anchor go to the shard of that anchor. A shard builds a suffix automaton of its
distinct runs with occurrence counts and streams the runs through it for matching statistics: where
the longest match reaches W words and its W-word suffix occurs twice, a repeated window ends. The
windows found make up the maximal spans that are removed.

The automata are sent to where their texts are, not to all tasks: together they grow with the
corpus, and all tasks reading all of them would be quadratic. Runs that recur within an input batch
are settled there and sent once. Windows of an anchor with very many occurrences are sent one by one,
as two hashes of all their words, and counted; so no shard holds more than ``HOT`` runs of an anchor,
and a common line costs the same whatever surrounds it.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from gaugeline.llm.common import HASHES, HashFilter, store

#: Words of a gram; doubling makes its hash.
GRAM = 16
#: Occurrences from which an anchor's windows are sent one by one.
HOT = 2_000
#: Words of the runs one automaton is built from, give or take the last anchor's.
SHARD_WORDS = 60_000
#: Bytes of runs in which an input batch looks for equal ones before it sends them.
GATHERED = 64 << 20
ANCHORS = pa.schema([("hash", pa.int64()), ("times", pa.int64())])
#: A run of windows for the shard of its anchor, without a place if it stands for several that are
#: settled; a window of a hot anchor, for the shard of its first hash, with its second for words; or,
#: without words, a settled span, sent along under its document's hash.
RUNS = pa.schema([("shard", pa.int64()), ("words", pa.binary()), ("h1", pa.int64()),
                  ("h2", pa.int64()), ("start", pa.int32()), ("end", pa.int32())])
SPANS = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("start", pa.int32()),
                   ("end", pa.int32())])
KEPT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                  ("kept_text", pa.string())])
PRIMES = [np.uint64(p) for p in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                                 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]


def word_hashes(text: bytes | None) -> np.ndarray:
    words = text.split() if text else []
    return np.fromiter(map(HASHES.__getitem__, words), np.uint64, len(words))


def joined(h: np.ndarray, step: int, prime: np.uint64) -> np.ndarray:
    """Hashes of sequences and those ``step`` places on, taken together."""
    mixed = h[:-step] * prime
    return (mixed ^ (mixed >> np.uint64(29))) * PRIMES[1] + h[step:]


def gram_hashes(words: np.ndarray) -> np.ndarray:
    for k in range(4):
        words = joined(words, 1 << k, PRIMES[k])
    return (words ^ (words >> np.uint64(31))) * PRIMES[5]


def sliding(extreme: np.ufunc, x: np.ndarray, width: int) -> np.ndarray:
    """Extreme of every ``width`` consecutive values."""
    reach = 1
    while 2 * reach <= width:
        x, reach = extreme(x[:-reach], x[reach:]), 2 * reach
    rest = width - reach
    return extreme(x[:-rest], x[rest:]) if rest else x


def anchors(grams: np.ndarray, window: int) -> np.ndarray:
    """Anchor of every window: the least hash of its grams."""
    return sliding(np.minimum, grams, window - GRAM + 1)


def anchor_task(batches, window: int) -> Iterator[pa.RecordBatch]:
    width = window - GRAM + 1
    for batch in batches:
        found = []
        for text in batch["text"]:
            words = word_hashes(text.as_py())
            if len(words) < window:
                continue
            grams = gram_hashes(words)
            pad = np.zeros(width - 1, np.uint64)
            # A gram is an anchor if it is the least of some window that holds it.
            top = sliding(np.maximum, np.concatenate([pad, anchors(grams, window), pad]), width)
            found.append(grams[grams == top])
        if found:
            value, times = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(times)],
                                             schema=ANCHORS)


def window_hashes(grams: np.ndarray, window: int, prime: np.uint64) -> np.ndarray:
    """Hash of all words of every window, from the grams that cover it."""
    n = len(grams) - (window - GRAM)
    out = grams[:n]
    for at in [*range(GRAM, window - GRAM, GRAM), window - GRAM]:
        mixed = out * prime
        out = (mixed ^ (mixed >> np.uint64(29))) * PRIMES[1] + grams[at:at + n]
    return out ^ (out >> np.uint64(32))


def runs_of(words: np.ndarray, window: int, repeated: HashFilter,
            hot: HashFilter) -> Iterator[tuple[int, int, int, bytes | None]]:
    """(shard, first window, number of windows, hash that stands for the words or None) of the
    windows that may be repeated."""
    grams = gram_hashes(words)
    anchor = anchors(grams, window)
    maybe = repeated.maybe(anchor)
    if not maybe.any():
        return
    change = np.flatnonzero(anchor[1:] != anchor[:-1]) + 1
    begin = np.r_[0, change]
    size = np.diff(np.r_[begin, len(anchor)])
    is_hot = hot.maybe(anchor)
    first = second = None
    for b, n in zip(begin[maybe[begin]].tolist(), size[maybe[begin]].tolist()):
        if not is_hot[b]:
            yield int(anchor[b].view(np.int64)), b, n, None
            continue
        if first is None:
            first = window_hashes(grams, window, PRIMES[4]).view(np.int64)
            second = window_hashes(grams, window, PRIMES[2])
        for k in range(b, b + n):
            yield int(first[k]), k, 1, second[k].tobytes()


def run_task(batches, window: int, repeated: HashFilter,
             hot: HashFilter) -> Iterator[pa.RecordBatch]:
    places: dict[tuple[int, bytes], list] = {}
    size = 0
    for batch in batches:
        for text, h1, h2 in zip(batch["text"], batch["h1"].to_pylist(), batch["h2"].to_pylist()):
            words = word_hashes(text.as_py())
            if len(words) < window:
                continue
            for shard, start, n, digest in runs_of(words, window, repeated, hot):
                end = start + n + window - 1
                content = digest or words[start:end].tobytes()
                place = places.setdefault((shard, content), [])
                place.append((h1, h2, start, end))
                size += 32 if len(place) > 1 else 64 + len(content)
            if size > GATHERED:
                yield gathered(places)
                places, size = {}, 0
    if places:
        yield gathered(places)


def gathered(places: dict[tuple[int, bytes], list]) -> pa.RecordBatch:
    rows = []
    settled: dict[tuple[int, int], list] = {}
    for (shard, content), found in places.items():
        if len(found) == 1:
            rows.append((shard, content, *found[0]))
            continue
        rows.append((shard, content, None, None, None, None))
        for h1, h2, start, end in found:
            settled.setdefault((h1, h2), []).append((start, end))
    rows += [(doc[0], None, *doc, *span) for doc, spans in settled.items() for span in united(spans)]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows), RUNS)], schema=RUNS)


def united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


class SuffixAutomaton:
    """Suffix automaton of several sequences, with the number of places each state's strings end."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link, self.length, self.count = [-1], [0], [0]

    def _state(self, length: int, following: dict, link: int, count: int) -> int:
        self.next.append(following)
        self.length.append(length)
        self.link.append(link)
        self.count.append(count)
        return len(self.length) - 1

    def _split(self, p: int, symbol: int, q: int) -> int:
        """State for the strings of ``q`` that end right after ``p``'s."""
        clone = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q], 0)
        while p >= 0 and self.next[p].get(symbol) == q:
            self.next[p][symbol] = clone
            p = self.link[p]
        self.link[q] = clone
        return clone

    def add(self, sequence: list[int], weight: int) -> None:
        last = 0
        for symbol in sequence:
            q = self.next[last].get(symbol)
            if q is not None:
                if self.length[q] != self.length[last] + 1:
                    q = self._split(last, symbol, q)
                last = q
                self.count[last] += weight
                continue
            p, last = last, self._state(self.length[last] + 1, {}, 0, weight)
            while p >= 0 and symbol not in self.next[p]:
                self.next[p][symbol] = last
                p = self.link[p]
            if p >= 0:
                q = self.next[p][symbol]
                self.link[last] = q if self.length[q] == self.length[p] + 1 else self._split(
                    p, symbol, q)

    def finish(self) -> None:
        """Hand counts down the suffix links, longest strings first."""
        for state in np.argsort(-np.array(self.length), kind="stable").tolist():
            if state:
                self.count[self.link[state]] += self.count[state]

    def repeated(self, sequence: list[int], window: int) -> Iterator[int]:
        """Starts of the windows of a sequence that end in two or more places of the whole."""
        state = matched = 0
        for end, symbol in enumerate(sequence, 1):
            while state and symbol not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            if symbol in self.next[state]:
                state = self.next[state][symbol]
                matched += 1
            while self.length[self.link[state]] >= window:
                state = self.link[state]
                matched = self.length[state]
            if matched >= window and self.count[state] >= 2:
                yield end - window


def shard_spans(groups: list[dict[bytes, list]], window: int) -> Iterator[tuple]:
    """Spans of the repeated windows of some anchors' runs.

    ``groups`` has, for each anchor, occurrences of each distinct run and whether it stands for
    settled ones. Runs that occur twice are repeated as a whole; a run alone with its anchor has no
    other to match, but may repeat itself. Windows sent as hashes are counted.
    """
    automaton, waiting = None, []
    for group in groups:
        alone = len(group) == 1
        for content, (places, weight) in group.items():
            if len(content) == 8:
                if weight >= 2:
                    yield from ((h1, h2, start, start + window) for h1, h2, start in places)
                continue
            size = len(content) // 8
            if weight >= 2:
                for h1, h2, start in places:
                    yield h1, h2, start, start + size
                if alone:
                    continue
            elif alone and len({content[k:k + 8 * window] for k in range(
                    0, len(content) - 8 * window + 8, 8)}) == size - window + 1:
                continue
            sequence = np.frombuffer(content, np.uint64).tolist()
            automaton = automaton or SuffixAutomaton()
            automaton.add(sequence, min(weight, 2))
            if weight < 2:
                waiting.append((sequence, places[0]))
    if not waiting:
        return
    automaton.finish()
    for sequence, (h1, h2, start) in waiting:
        at = [start + k for k in automaton.repeated(sequence, window)]
        for begin, end in united([(k, k + window) for k in at]):
            yield h1, h2, begin, end


def shard_task(batches, window: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by shard; automata are built for as many whole anchors as ``SHARD_WORDS``."""
    groups: list[dict[bytes, list]] = []
    passed: list[tuple] = []
    current, words = None, 0

    def found() -> pa.RecordBatch:
        rows = passed + list(shard_spans(groups, window))
        passed.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [()] * 4, SPANS)],
            schema=SPANS)

    for batch in batches:
        for shard, content, *place in zip(*(c.to_pylist() for c in batch.columns)):
            if content is None:
                passed.append(tuple(place))
                continue
            if shard != current:
                if words >= SHARD_WORDS:
                    yield found()
                    groups, words = [], 0
                groups.append({})
                current = shard
            entry = groups[-1].get(content)
            if entry is None:
                entry = groups[-1][content] = [[], 0]
                words += len(content) // 8
            h1, h2, start, _ = place
            entry[1] += 2 if start is None else 1
            if start is not None:
                entry[0].append((h1, h2, start))
    if groups or passed:
        yield found()


def split_task(batches, touched: HashFilter, wanted: bool) -> Iterator[pa.RecordBatch]:
    """Rows that may have spans, or those that have none for sure."""
    for batch in batches:
        chosen = touched.maybe(batch["h1"].to_numpy(zero_copy_only=False)) == wanted
        yield batch.filter(pa.array(chosen))


def keep_task(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        have = batch["spans"].to_pylist() if "spans" in batch.schema.names else repeat(None)
        out: list[list] = [[], [], []]
        for text, spans in zip(batch["text"], have):
            words = (text.as_py() or b"").split()
            edge = np.zeros(len(words) + 1, np.int64)
            for span in spans or ():
                edge[span["start"]] += 1
                edge[span["end"]] -= 1
            gone = np.cumsum(edge[:-1]) > 0
            kept = [w for w, g in zip(words, gone) if not g] if spans else words
            for column, value in zip(out, (len(words), len(words) - len(kept),
                                           b" ".join(kept).decode())):
                column.append(value)
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], *(pa.array(c, f.type) for c, f in zip(out, list(KEPT)[1:]))],
            schema=KEPT)


def remove_repeated(docs: DataFrame, window: int = 35) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_text.

    Words are white-space words, unchanged. Every word covered by a window of ``window`` consecutive
    words that also starts elsewhere, in another row or the same, is removed, the first occurrence
    included; windows are judged on the input. ``kept_text`` is the other words joined by a space.
    Null, empty and short texts lose nothing (null gives an empty text). Rows that share a doc_id
    are documents of their own; equal rows repeat each other; a null doc_id stays null. Texts of any
    length are read whole, an empty table gives no rows, and other columns are not read, whatever their
    names.

    Words are compared by 64-bit hashes of each, so two windows are taken for equal wrongly only if
    all words that differ collide.
    """
    if window < GRAM:
        raise ValueError(f"windows have at least {GRAM} words")
    context = docs.sparkSession.sparkContext
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"),
                        F.xxhash64("doc_id", "text").alias("h1"),
                        F.xxhash64(F.lit(1), "text", "doc_id").alias("h2"))
    counted = store(texts.select("text").mapInArrow(
        lambda batches: anchor_task(batches, window), from_arrow_schema(ANCHORS))
        .groupBy("hash").agg(F.sum("times").alias("times")).where("times > 1"), "anchors")
    filters = context.broadcast((HashFilter(counted.select("hash")), HashFilter(
        counted.where(F.col("times") > HOT).select("hash"))))
    runs = texts.select("text", "h1", "h2").mapInArrow(
        lambda batches: run_task(batches, window, *filters.value), from_arrow_schema(RUNS))
    found = (runs.repartition("shard").sortWithinPartitions("shard")
             .mapInArrow(lambda batches: shard_task(batches, window), from_arrow_schema(SPANS)))
    spans = store(found.groupBy("h1", "h2").agg(
        F.collect_list(F.struct("start", "end")).alias("spans")), "spans")
    touched = context.broadcast(HashFilter(spans.select(F.col("h1").alias("hash"))))
    kept = from_arrow_schema(KEPT)
    # Only texts that lose words move to meet their spans.
    losing = (texts.mapInArrow(lambda batches: split_task(batches, touched.value, True), texts.schema)
              .join(spans, ["h1", "h2"], "left").select("doc_id", "text", "spans")
              .mapInArrow(keep_task, kept))
    whole = texts.mapInArrow(
        lambda batches: keep_task(split_task(batches, touched.value, False)), kept)
    return losing.unionByName(whole)
