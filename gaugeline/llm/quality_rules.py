"""Quality rules: word and line counts, and compression bands.

Repetitive text compresses too well, noise not at all. The zstandard ratio (bytes in over bytes out)
of a whole document must lie inside the band for its length, for short text compresses worse than
long text of the same kind. Fixed chunks are held against the band of a chunk's length, so that a
passage of either sort is seen inside a long document whose overall ratio is ordinary.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

SYMBOLS = b"#*$%&|<>"
JUDGED = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("word_chars", pa.int64()),
    ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()),
    ("base_failed", pa.bool_()), ("ratio", pa.float64()), ("bad_chunk_share", pa.float64()),
    ("kept", pa.bool_())])


@dataclass(frozen=True)
class Bands:
    """Limits by length in bytes, and how chunks count.

    ``sizes`` are the lengths at which the next band begins; band k holds ratios from ``low[k]`` to
    ``high[k]``. Prose in Latin script has 1.4 to 2 at 500 bytes and 2.2 to 3 at 50,000; two-byte
    scripts reach 4.5 and markup 6. Random letters and digits stay under 1.35 at any length. A document
    fails if more than ``share`` of its bytes lie in chunks outside their band.
    """

    sizes: tuple[int, ...] = (512, 1_024, 4_096, 16_384, 131_072)
    low: tuple[float, ...] = (1.1, 1.2, 1.35, 1.45, 1.45, 1.45)
    high: tuple[float, ...] = (3.0, 3.5, 5.0, 6.5, 8.0, 10.0)
    chunk: int = 2_048
    share: float = 0.25
    level: int = 3

    def __post_init__(self) -> None:
        if not len(self.sizes) + 1 == len(self.low) == len(self.high):
            raise ValueError("one more band than sizes at which one begins")
        if self.chunk < 1:
            raise ValueError("chunks have at least one byte")

    def holds(self, size: int, ratio: float) -> bool:
        band = bisect_right(self.sizes, size)
        return self.low[band] <= ratio <= self.high[band]


class Compression:
    """Ratios of whole texts and of their chunks; one compressor serves a task."""

    def __init__(self, bands: Bands):
        self.bands = bands
        self.compressor = zstandard.ZstdCompressor(level=bands.level)

    def ratio(self, data: bytes) -> float:
        return len(data) / len(self.compressor.compress(data)) if data else 0.0

    def judge(self, text: bytes) -> tuple[float, float, bool]:
        """(ratio, share of bytes in chunks outside their band, verdict)."""
        ratio, size = self.ratio(text), self.bands.chunk
        if len(text) <= size:
            inside = self.bands.holds(len(text), ratio)
            return ratio, 0.0 if inside or not text else 1.0, inside
        bad = 0
        for k in range(0, len(text), size):
            part = text[k:k + size]
            if not self.bands.holds(len(part), self.ratio(part)):
                bad += len(part)
        share = bad / len(text)
        return ratio, share, share <= self.bands.share and self.bands.holds(len(text), ratio)


def repeated_words(words: list[bytes], width: int = 3) -> int:
    """Words covered by the ``width``-word windows that the list holds twice or more.

    Windows are numbered exactly, by extending numbered shorter ones one word at a time.
    """
    if len(words) <= width:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    window = ids
    for k in range(1, width):
        window = window[:-1] * len(known) + ids[k:]
        if k + 1 < width:
            window = np.unique(window, return_inverse=True)[1]
    _, number, times = np.unique(window, return_inverse=True, return_counts=True)
    twice = times[number] > 1
    covered = np.zeros(len(words), bool)
    for k in range(width):
        covered[k:len(twice) + k] |= twice
    return int(covered.sum())


def code_points(text: bytes) -> int:
    """Bytes that begin a character."""
    return int(((np.frombuffer(text, np.uint8) & 0xC0) != 0x80).sum())


def judged(text: bytes, compression: Compression, least_words: int, most_repeated: int) -> tuple:
    """The values of ``JUDGED`` after doc_id."""
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    repeated = repeated_words(words)
    failed = len(words) < least_words or 100 * repeated > most_repeated * len(words)
    ratio, share, inside = compression.judge(text)
    return (len(words), code_points(b"".join(words)), sum(text.count(c) for c in SYMBOLS),
            len(lines) - len(set(lines)), repeated, failed, ratio, share, inside and not failed)


def judge_task(batches, bands: Bands, least_words: int, most_repeated: int
               ) -> Iterator[pa.RecordBatch]:
    compression = Compression(bands)
    for batch in batches:
        rows = [judged(text.as_py() or b"", compression, least_words, most_repeated)
                for text in batch["text"]]
        columns = zip(*rows) if rows else [()] * (len(JUDGED) - 1)
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], *(pa.array(c, f.type) for c, f in zip(columns, list(JUDGED)[1:]))],
            schema=JUDGED)


def judge_quality(docs: DataFrame, bands: Bands = Bands(), least_words: int = 50,
                  most_repeated: int = 50) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, ratio, bad_chunk_share, kept.

    Words are white-space words. ``base_failed``: fewer than ``least_words`` words, or more than
    ``most_repeated`` per cent of them in repeated 3-word windows. ``kept`` needs that to be false and
    the compression bands to hold. A null or empty text has no words, ratio 0 and is not kept; texts of
    any length are read whole, with memory in proportion to the longest. Rows are judged one by one:
    repeated rows and ids get equal verdicts, a null doc_id stays null, an empty table gives an empty
    result, and other columns of ``docs``, whatever their names, are not read. One pass, no shuffle.
    """
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
    return texts.mapInArrow(lambda batches: judge_task(batches, bands, least_words, most_repeated),
                            from_arrow_schema(JUDGED))
