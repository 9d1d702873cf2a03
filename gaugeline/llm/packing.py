"""Packing of tokenised documents into windows by sum of squares.

Every task packs the documents of its input split as they come. A document longer than a window is
cut into whole windows and a rest. A rest goes to the fill level that leaves the sum of squared
counts of partially filled windows smallest; the counts are kept in an array by level. Windows that
are still partial when the split ends are emptied into full ones, cutting where need be, and the
last of them into windows whose lengths are powers of two, which take no padding.
"""

from __future__ import annotations

import functools
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema
from tokenizers import Tokenizer

from gaugeline.llm.common import LATIN, LETTER, NUMBER
from gaugeline.llm.token_counts import byte_symbols

#: Distinct pre-tokens a worker remembers; beyond that it starts afresh.
REMEMBERED = 1_000_000
#: Fixed by the byte-level scheme.
PRETOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LATIN_PRETOKENS = re.compile(
    PRETOKENS.replace(r" ?\p{L}+", f" ?[{LETTER}]+").replace(r" ?\p{N}+", f" ?[{NUMBER}]+")
    .replace(r"[^\s\p{L}\p{N}]", rf"[^\t-\r\x20{LETTER}{NUMBER}]")
    .replace(r"\s+(?!\S)|\s+", r"[\t-\r\x20]+(?![^\t-\r\x20])|[\t-\r\x20]+")).findall
PIECE = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.binary()),
                   ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()),
                   ("offset", pa.int64())])


class Encoded(dict):
    """Ids of pre-tokens, worked out when first asked for."""

    def __init__(self, merges: tiktoken.Encoding):
        super().__init__()
        self.merges = merges

    def __missing__(self, pretoken: str) -> bytes:
        ids = array("I", self.merges.encode_ordinary(pretoken)).tobytes()
        self[pretoken] = ids
        return ids


class CachedEncoder:
    """Token ids as little-endian unsigned 32-bit bytes; pre-tokens seen before are looked up.

    The scheme encodes pre-tokens independently of each other, so a text's ids are joined from
    theirs. Texts with special strings or with characters beyond ``LATIN`` go to the tokenizer
    whole.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.whole = re.compile("|".join([f"[^{LATIN}]", *map(re.escape, special)])).search
        byte_of = {symbol: byte for byte, symbol in enumerate(byte_symbols())}
        ranks = {bytes(byte_of[s] for s in word): rank
                 for word, rank in self.tokenizer.get_vocab(with_added_tokens=False).items()}
        # The same vocabulary in a library with less overhead for single pre-tokens.
        self.merges = tiktoken.Encoding("own", pat_str=PRETOKENS, mergeable_ranks=ranks,
                                        special_tokens={})
        self.known = Encoded(self.merges)

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        get, out = self.known.__getitem__, []
        for text in texts:
            if self.whole(text):
                ids = self.tokenizer.encode(text, add_special_tokens=False).ids
                out.append(array("I", ids).tobytes())
                continue
            out.append(b"".join(map(get, LATIN_PRETOKENS(text))))
        return out


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> CachedEncoder:
    return CachedEncoder(path)


class Windows:
    """Partially filled windows of one task, by fill level."""

    def __init__(self, size: int, first_id: int):
        self.size, self.next_id = size, first_id
        self.counts = np.zeros(size + 1, np.int64)
        self.open: list[list[list]] = [[] for _ in range(size + 1)]

    def place(self, length: int) -> int:
        """Fill level that takes an item: the one with the least change in the sum of squares.

        Moving a window from level h to h + length changes the sum by
        2 * (counts[h + length] - counts[h]) + 2; a new window has no count to take away, a filled
        one no count to add. Ties go to the fullest window.
        """
        counts, size = self.counts, self.size
        to = counts[length:size + 1]
        change = 2 * (to - counts[:len(to)]) + 2
        change[0] = 2 * counts[length] + 1
        change[-1] = -2 * counts[size - length] + 1 if length < size else 0
        usable = counts[:len(to)] > 0
        usable[0] = True
        change[~usable] = np.iinfo(np.int64).max
        return int(len(change) - 1 - np.argmin(change[::-1]))

    def add(self, piece: tuple) -> list | None:
        """Place a piece (doc_id, start, ids, doc_tokens); the window's pieces if that fills it."""
        length = len(piece[2]) // 4
        level = self.place(length)
        if level:
            window = self.open[level].pop()
            self.counts[level] -= 1
        else:
            window = []
        window.append(piece)
        if level + length == self.size:
            return window
        self.open[level + length].append(window)
        self.counts[level + length] += 1
        return None

    def numbered(self, window: list) -> Iterator[tuple]:
        offset = 0
        for doc_id, start, ids, total in window:
            yield doc_id, start, ids, total, self.next_id, offset
            offset += len(ids) // 4
        self.next_id += 1

    def drained(self) -> Iterator[list]:
        """The open windows' pieces in full windows, then in power-of-two ones."""
        pieces = [p for level in self.open for w in level for p in w][::-1]
        left = sum(len(p[2]) // 4 for p in pieces)
        while left:
            room = self.size if left >= self.size else 1 << (left.bit_length() - 1)
            left -= room
            window = []
            while room:
                doc_id, start, ids, total = pieces.pop()
                take = min(room, len(ids) // 4)
                window.append((doc_id, start, ids[:4 * take], total))
                if 4 * take < len(ids):
                    pieces.append((doc_id, start + take, ids[4 * take:], total))
                room -= take
            yield window


def pack_task(batches, path: str, size: int, end_id: int, rows: int) -> Iterator[pa.RecordBatch]:
    end = np.array([end_id], "<u4").tobytes()
    windows = Windows(size, TaskContext.get().partitionId() << 40)
    done: list[tuple] = []

    def packed() -> pa.RecordBatch:
        columns = [pa.array(c, t.type) for c, t in zip(zip(*done), PIECE)]
        done.clear()
        return pa.RecordBatch.from_arrays(columns, schema=PIECE)

    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            part = batch.slice(k, rows)
            texts = encoder(path).encode([t or "" for t in part["text"].to_pylist()])
            for doc_id, ids in zip(part["doc_id"].to_pylist(), texts):
                ids += end
                total = len(ids) // 4
                for start in range(0, total, size):
                    full = windows.add((doc_id, start, ids[4 * start:4 * (start + size)], total))
                    if full:
                        done.extend(windows.numbered(full))
            if done:
                yield packed()
    for window in windows.drained():
        done.extend(windows.numbered(window))
    if done:
        yield packed()


def pack(docs: DataFrame, path: str, size: int = 2048, end_id: int = 1,
         rows: int = 256) -> DataFrame:
    """Pieces of documents in windows of at most ``size`` ids: doc_id, start, ids (little-endian
    unsigned 32-bit), doc_tokens, sequence_id, offset.

    A document is its ids and ``end_id``. Null and empty texts are that id alone; rows that share a
    doc_id are documents of their own, and a null doc_id stays null. Long documents are cut, an empty
    table gives no rows, and other columns are not read, whatever their names. Nothing is shuffled, and a task
    holds fewer than ``size`` times ``size`` ids, whatever its share of documents. Window numbers
    hold the partition, so a repeated task gives the same numbers.
    """
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        lambda batches: pack_task(batches, path, size, end_id, rows), from_arrow_schema(PIECE))
